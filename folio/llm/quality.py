"""Quality rules: a threshold table compiled into one projection.

Every measure is a built-in column expression over the whole text.  Words are
split once per row and their hashes shared by the measures that need them;
:data:`RULES` then becomes one conjunction over the measures, so a change of
rules changes a table and not code.

Stop words are counted only where the declared language of a text has a list
(:data:`STOP_WORDS`, all lists together, as texts quote other languages); a text of
another language, or of none, is not judged by them: the ratio is null, and a null
measure passes its rule.

Defined cases: a null or blank text has no words, zero counts, ratios of zero
and is not kept.  Repeated rows are measured one by one.  Other columns of the
input pass through; a column that already has the name of a measure is
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.base import words
from folio.operators.chunking import let

# --- fixed values -----------------------------------------------------------
NOT_BLANK = r"[^\x20\x09-\x0D]"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
STOP_WORDS = {
    "en": "the of and to in is that it for with as was on be by are this from at a an or",
    "fr": "le la les de des et en un une du que qui dans pour au sur par est pas",
    "es": "el los las y lo del se su con por para como no",
    "de": "der die das und ist von zu den mit sich dem im nicht ein eine auf als auch",
    "it": "il di che e la per un non sono gli della con una",
    "pt": "o os da do em que para com uma dos mais na",
    "nl": "het een van en dat niet voor zijn op met aan",
    "pl": "w i na z do nie się że to jest od przez jak",
    "ru": "и в не на что с по как это из к но",
}
#: measure, least value, greatest value (None: no bound)
RULES = (
    ("mean_word_chars", 2.5, 9.0),
    ("symbols_per_word", None, 0.1),
    ("stop_word_ratio", 0.05, None),  # null, and no bound, where the language has no list
    ("upper_ratio", None, 0.25),
    ("letter_ratio", 0.6, None),
    ("dup_line_ratio", None, 0.5),
    ("echo_ratio", None, 0.3),
)
# ----------------------------------------------------------------------------

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _pairs(hashes: Column, shift: int) -> Column:
    """Hash of each element with the one ``shift`` places on; shorter by ``shift``."""
    return let(hashes, lambda h: F.zip_with(
        F.slice(h, 1, F.greatest(F.size(h) - shift, F.lit(0))),
        F.slice(h, shift + 1, F.greatest(F.size(h) - shift, F.lit(0))),
        lambda a, b: F.xxhash64(a, b)))


def _covered(windows: Column) -> Column:
    """Words that lie in a window whose hash occurs twice or more."""
    keyed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    def starts(k: Column) -> Column:
        n = F.size(k)
        prev = F.concat(F.array(F.lit(None).cast("bigint")), F.transform(F.slice(k, 1, n - 1), lambda x: x["h"]))
        after = F.concat(F.transform(F.slice(k, 2, n - 1), lambda x: x["h"]), F.array(F.lit(None).cast("bigint")))
        z = F.arrays_zip(k.alias("k"), prev.alias("p"), after.alias("a"))
        hit = F.filter(z, lambda x: x["k"]["h"].eqNullSafe(x["p"]) | x["k"]["h"].eqNullSafe(x["a"]))
        return F.array_sort(F.transform(hit, lambda x: x["k"]["i"]))
    def total(s: Column) -> Column:
        gaps = F.zip_with(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1),
                          lambda a, b: F.least(b - a, F.lit(WINDOW)))
        return F.aggregate(gaps, F.lit(WINDOW), lambda acc, g: acc + g)
    return let(keyed, lambda k: let(starts(k), total))


def _repeat_words(hashes: Column) -> Column:
    """The hashes of 8-word windows come from three rounds of doubling; only texts
    with a repeated one are sorted."""
    windows = _pairs(_pairs(_pairs(hashes, 1), 2), 4)
    return let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(_covered(w)))


def _count(text: Column, others: str) -> Column:
    """Code points of ``text`` outside the class ``others``."""
    return F.char_length(F.regexp_replace(text, others, ""))


def has_list(lang: Column) -> Column:
    """Whether the language (a code, with or without a region) has a list of stop words."""
    return F.coalesce(F.lower(F.regexp_extract(lang.cast("string"), "^[A-Za-z]+", 0)).isin(list(STOP_WORDS)), F.lit(False))


def measures(text: Column, lang: Column) -> Column:
    """A struct with the measures of one text in a declared language."""
    every = sorted({w for ws in STOP_WORDS.values() for w in ws.split()})
    text = F.coalesce(text, F.lit(""))

    def of_words(w: Column, h: Column, t: Column, odd: Column) -> Column:
        n = F.size(w)
        lines = F.filter(F.split(t, "\n", -1), lambda s: s.rlike(NOT_BLANK))
        word_chars = F.char_length(F.array_join(w, ""))
        stop_hits = F.size(F.filter(w, lambda x: x.isin(every)))
        symbols = _count(odd, "[^#*$%&|<>]+")
        letters = word_chars - _count(odd, r"\p{L}+")
        caps = _count(odd, r"[^\p{Lu}]+")
        echoes = F.size(F.filter(F.zip_with(F.slice(h, 1, F.greatest(n - 1, F.lit(0))),
                                            F.slice(h, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: a == b), lambda x: x))
        return let(lines, lambda ls: F.struct(
            n.cast("bigint").alias("n_words"),
            word_chars.cast("bigint").alias("word_chars"),
            symbols.cast("bigint").alias("n_symbols"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("bigint").alias("n_dup_lines"),
            _repeat_words(h).cast("bigint").alias("n_repeat_words"),
            _ratio(word_chars, n).alias("mean_word_chars"),
            _ratio(symbols, n).alias("symbols_per_word"),
            F.when(has_list(lang), _ratio(stop_hits, n)).alias("stop_word_ratio"),
            _ratio(caps, word_chars).alias("upper_ratio"),
            _ratio(letters, word_chars).alias("letter_ratio"),
            _ratio(F.size(ls) - F.size(F.array_distinct(ls)), F.size(ls)).alias("dup_line_ratio"),
            _ratio(echoes, n).alias("echo_ratio"),
        ))

    odd = F.regexp_replace(text, r"[\p{Ll}\x20\x09-\x0D]+", "")  # the few characters that the counts below look at
    return let(words(text), lambda w: let(F.transform(w, lambda x: F.xxhash64(x)),
                                          lambda h: let(odd, lambda o: of_words(w, h, text, o))))


def verdict(rules=RULES) -> Column:
    """The threshold table as one condition; a null measure passes."""
    ok = F.lit(True)
    for name, least, most in rules:
        if least is not None:
            ok = ok & F.coalesce(F.col(name) >= F.lit(float(least)), F.lit(True))
        if most is not None:
            ok = ok & F.coalesce(F.col(name) <= F.lit(float(most)), F.lit(True))
    return ok


def quality(docs: DataFrame, text: str = "text", lang: str | None = "lang", rules=RULES) -> DataFrame:
    """``docs`` with the measures of each text, ``base_failed`` and ``kept``.

    ``lang`` names the column of the declared language (None: no text has one).
    """
    made = set(MEASURES) | {r[0] for r in RULES} | {"base_failed", "kept"}
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in made]
    out = docs.select(*rest, F.inline(F.array(measures(F.col(f"`{text}`"), F.col(f"`{lang}`") if lang else F.lit(None)))))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict(rules))


def op8_quality(spark, sf_dir: str) -> DataFrame:
    out = quality(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang"))
    return out.select("doc_id", *MEASURES, "base_failed", "kept", *[r[0] for r in RULES])
