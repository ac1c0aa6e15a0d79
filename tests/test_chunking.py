import random

from pyspark.sql import functions as F

import brute
from folio.operators.chunking import paragraph_chunks, sentence_chunks, store_records

#: text, budget, chunks: one case for each rule
SENTENCES = [
    ("", 5, [""]),                                          # no sentence: the text itself
    ("   ", 5, ["   "]),
    ("no end here", 5, ["no end here."]),
    ("One. Two. Three.", 6, ["One. Two. Three."]),          # all fit exactly
    ("One. Two. Three.", 5, ["One. Two.", "Three."]),       # one token too many
    ("One. Two. Three.", 2, ["One.", "Two.", "Three."]),
    ("a. . . b.", 8, ["a. b."]),                            # empty pieces go
    ("Line one\nline two. End", 20, ["Line one line two. End."]),
]
PARAGRAPHS = [
    ("p1\n\n\n\np2", 1010, ["p1\n\n\n\np2"]),               # a text that fits stays as it is
    ("a b c\n\nd e f", 1006, ["a b c\n\nd e f"]),           # exactly the budget
    ("a b c\n\nd e f", 1005, ["a b c", "d e f"]),           # one above
]


def _random_texts(n, seed=7):
    rnd = random.Random(seed)
    words = ["alpha", "beta", "gamma,", "delta;", "eps", "zeta!", "eta?", "theta", "a", "longerword", "x1", "é"]
    out = []
    for _ in range(n):
        paras = []
        for _ in range(rnd.randint(1, 4)):
            sents = []
            for _ in range(rnd.randint(0, 8)):
                sents.append(" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 30))))
            paras.append(". ".join(sents))
        out.append(rnd.choice(["\n\n", "\n", " "]).join(paras))
    return out


def test_sentence_chunks(spark):
    df = spark.createDataFrame(SENTENCES, "t string, b int, want array<string>")
    for r in df.select("*", sentence_chunks(F.col("t"), F.col("b")).alias("got")).collect():
        assert r.got == r.want, (r.t, r.b)


def test_sentence_chunk_invariants(spark):
    texts = _random_texts(40, seed=3)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", sentence_chunks(F.col("t"), 10).alias("c")).collect():
        for c in r.c:
            assert brute.tokens(c) <= 10 or len(c.split()) == 1 or not c.strip(". ")
        joined = " ".join(r.c).replace(".", " ").split()
        original = r.t.replace("\n", " ").replace(".", " ").split()
        assert joined == original or not original


def test_paragraph_chunks(spark):
    for text, limit, want in PARAGRAPHS:
        df = spark.createDataFrame([(text,)], "t string")
        assert df.select(paragraph_chunks(F.col("t"), limit).alias("c")).first().c == want, (text, limit)


def test_paragraph_chunks_keep_all_words(spark):
    texts = _random_texts(60, seed=11)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", paragraph_chunks(F.col("t"), 1010).alias("c")).collect():
        assert " ".join(r.c).replace(".", " ").split() == r.t.replace(".", " ").split()


def test_store_records_ids(spark):
    long_text = ". ".join(["word " * 8] * 20)
    df = spark.createDataFrame([("a1", "T", "short text."), ("a2", "Title", long_text)], "id string, title string, content string")
    recs = store_records(df, max_tokens=30).orderBy("id").collect()
    short = [r for r in recs if r.article_id == "a1"]
    assert len(short) == 1 and short[0].id == "a1" and short[0].document == "T\n\nshort text." and short[0].total_chunks == 1
    longs = [r for r in recs if r.article_id == "a2"]
    assert len(longs) > 1
    assert sorted(r.chunk_index for r in longs) == list(range(len(longs)))
    assert all(r.id == f"a2_chunk_{r.chunk_index}" and r.total_chunks == len(longs) for r in longs)
    assert all(r.document.startswith("Title\n\n") for r in longs)
    # the title and a margin of 10 leave 19 of 30 tokens: two sentences of 8 words and a period
    assert all(r.document.count("word") <= 16 for r in longs)
    assert sum(r.document.count("word") for r in longs) == 160
