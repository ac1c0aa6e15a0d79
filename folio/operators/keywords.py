"""Top-k keywords per text by frequency, ties by first appearance.

A text is one row, so the whole computation stays inside the row (no
shuffle): the lower-cased words are tagged with their position, stop words
are dropped, the (word, position) pairs are sorted, run starts are found in
one pass (a run is one distinct word; its first element carries the word's
first position), run lengths are the frequencies, and the runs are ordered
by (frequency desc, first position) and cut to k.  Cost per text is
O(n log n) in its word count and independent of every other text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.text import STOP_WORDS, lit_re
from folio.operators.chunking import let

# Words of 3+ ASCII letters bounded by non-word characters (Unicode sense).
WORD_PATTERN = r"(?U)\b[a-zA-Z]{3,}\b"
MAX_KEYWORDS = 10


def top_keywords(text: Column, k: int = MAX_KEYWORDS, stop_words=tuple(STOP_WORDS)) -> Column:
    """Array of ``struct(word, freq)`` in rank order."""
    stop = list(stop_words)
    words = F.regexp_extract_all(F.lower(text), lit_re(WORD_PATTERN), 0)
    tagged = F.filter(
        F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("pos"))),
        lambda x: ~x["word"].isin(stop),
    )

    def runs(s: Column) -> Column:
        n = F.size(s)
        idx = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        starts = F.filter(idx, lambda i: F.when(i == 0, F.lit(True)).otherwise(s[i]["word"] != s[i - 1]["word"]))

        def ranked(st: Column) -> Column:
            r = F.transform(st, lambda b, j: F.struct(
                (b - F.coalesce(F.try_element_at(st, j + 2), n)).alias("neg_freq"),
                s[b]["pos"].alias("first_pos"),
                s[b]["word"].alias("word"),
            ))
            best = F.slice(F.sort_array(r), 1, k)
            return F.transform(best, lambda x: F.struct(x["word"].alias("word"), (-x["neg_freq"]).cast("int").alias("freq")))

        return let(starts, ranked)

    return let(F.array_sort(tagged), runs)


def keywords(df: DataFrame, key: str, text: str, k: int = MAX_KEYWORDS,
             stop_words=tuple(STOP_WORDS)) -> DataFrame:
    """One row per (text, rank): ``key, rank, word, freq``."""
    out = df.select(F.col(key), F.posexplode(top_keywords(F.col(text), k, stop_words)).alias("_r", "_kw"))
    return out.select(key, (F.col("_r") + 1).cast("int").alias("rank"), F.col("_kw.word").alias("word"),
                      F.col("_kw.freq").alias("freq"))
