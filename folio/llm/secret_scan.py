"""Secret scan: fixed patterns, and two character Markov models for the rest.

The fixed patterns (assignment, access key, hex) are found with Spark's own
regular expressions; positions are running sums of the lengths of the matches and
of what lies between them (one split of the text by the same pattern), taken in
blocks of the square root of their number, so a text with very many matches stays
cheap.  Other long tokens are scored by the log-likelihood
ratio of two first-order character models, one of random strings and one of
ordinary identifiers.  Both are trained here by a grouped count of character
pairs; the result is a square table over a fixed alphabet, so its size is
fixed.  Everything is built-in functions.

Training samples, all labelled by how they are made:

* random: hex, base-64, base-64 without its signs, and upper-case renderings
  of digests of ``0 .. TRAIN_STRINGS - 1``;
* ordinary: the words of about ``TRAIN_DOCS`` rows of the input, chosen by a
  hash of their id, and identifiers made of two or three neighbouring words in
  snake, upper snake, camel, kebab, dotted and file-path style; numbers, dates and
  versions; and rulers, which are one digit or sign repeated.

A random span must not overlap a span of the fixed patterns.

Defined cases: a null text has no spans.  Rows are scanned one by one, so
repeated rows give repeated results and null ids pass through.  An empty table
gives no rows.  Offsets are code points, ends exclusive.
"""

from __future__ import annotations


import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.base import unused, words
from folio.operators.chunking import let

# --- fixed values -----------------------------------------------------------
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i:(?=[pstaPSTA])(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
TOKEN = r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
# ----------------------------------------------------------------------------

TRAIN_STRINGS = 4096
TRAIN_DOCS = 400
RULERS = 100
SMOOTHING = 0.5
#: Least ratio of a random string: in all, and for each pair of characters (natural logarithms).
#: Trained on sf0.01, the second finds 0.998 or more of random strings of 20 characters of
#: letters, digits or base 64 (0.946 of upper-case hex), and takes none of 23,413 identifiers made of
#: words of other documents for random, but 4 % of 34,694 of English words, which the texts do not have.
LEAST_TOTAL = 12.0
LEAST_PER_PAIR = 1.5


def _random_strings(spark, n: int) -> DataFrame:
    digest = F.unhex(F.sha2(F.col("id").cast("string"), 256))
    b64 = F.base64(digest)
    made = F.array(F.lower(F.hex(digest)), b64, F.regexp_replace(b64, "[+/=]", ""),
                   F.upper(F.regexp_replace(b64, "[+/=]", "")))
    return spark.range(n).select(F.explode(made).alias("s"))


def _ordinary(docs: DataFrame, id_col: str, text: str, n: int) -> DataFrame:
    every = F.greatest(F.lit(1), F.floor(F.lit(docs.count()) / F.lit(n)))
    some = docs.where(F.pmod(F.xxhash64(F.col(id_col)), every) == 0)
    plain = F.filter(F.transform(words(F.col(text)), lambda w: F.regexp_replace(w, "[^A-Za-z0-9]+", "")),
                     lambda w: F.length(w) > 1)
    some = some.select(plain.alias("w"))
    rest = lambda k: F.slice("w", k + 1, F.greatest(F.size("w") - k, F.lit(0)))
    joined = F.zip_with(F.zip_with(F.col("w"), rest(1), lambda a, b: F.struct(a.alias("a"), b.alias("b"))), rest(2),
                        lambda p, c: F.when(c.isNotNull(), F.struct(p["a"].alias("a"), p["b"].alias("b"), c.alias("c"))))

    def styles(p: Column) -> Column:
        a, b, c = p["a"], p["b"], p["c"]
        number = F.pmod(F.xxhash64(b), F.lit(10_000_000)).cast("string")
        file = F.concat_ws("/", F.lower(a), F.substring(number, 1, 4), F.concat(F.upper(b), F.lit("_"), F.lpad(number, 7, "0"), F.lit("."), F.substring(c, 1, 3)))
        return F.array(a, F.concat_ws("_", a, b), F.concat(a, F.initcap(b)), F.concat_ws("-", a, b),
                       F.concat_ws(".", a, b), F.concat_ws("/", a, b), F.concat(a, F.lit("="), b),
                       F.concat(a, F.substring(number, 1, 2)), F.upper(F.concat_ws("_", a, b, c)),
                       F.concat(F.initcap(a), F.initcap(b), F.initcap(c)), file)
    pairs = some.select(F.explode(joined).alias("p")).where("p is not null")
    return pairs.select(F.explode(styles(F.col("p"))).alias("s"))


def _numbers_and_rulers(spark, n: int) -> DataFrame:
    i = F.col("id")
    number = F.pmod(F.xxhash64(i), F.lit(10**12)).cast("string")
    day = F.date_add(F.lit("2000-01-01").cast("date"), F.pmod(F.xxhash64(i), F.lit(10_000)).cast("int"))
    numbers = spark.range(n).select(F.explode(F.array(
        number, F.lpad(number, 16, "0"), day.cast("string"), F.date_format(day, "yyyy/MM/dd"),
        F.concat_ws(".", F.substring(number, 1, 1), F.substring(number, 2, 2), F.substring(number, 4, 3)))).alias("s"))
    signs = F.array(*[F.lit(c) for c in ALPHABET if not c.isalpha()])
    return numbers.unionAll(spark.range(RULERS).select(F.explode(F.transform(signs, lambda c: F.repeat(c, F.lit(30)))).alias("s")))


def _pair_counts(strings: DataFrame, label: str) -> DataFrame:
    at = F.sequence(F.lit(1), F.length("s") - 1)
    pairs = strings.where(F.length("s") > 1).select(F.explode(F.transform(at, lambda i: F.substring("s", i, F.lit(2)))).alias("p"))
    return pairs.groupBy("p").count().select(F.lit(label).alias("label"), "p", "count")


def train(docs: DataFrame, id_col: str = "doc_id", text: str = "text", n_strings: int = TRAIN_STRINGS,
          n_docs: int = TRAIN_DOCS) -> np.ndarray:
    """Table of log-likelihood ratios, random against ordinary, by pair of characters.

    At most one row for each pair of alphabet characters and label comes to
    the driver.
    """
    size = len(ALPHABET)
    counts = np.full((2, size, size), SMOOTHING)
    seen = _pair_counts(_random_strings(docs.sparkSession, n_strings), "random").unionAll(
        _pair_counts(_ordinary(docs, id_col, text, n_docs).unionAll(_numbers_and_rulers(docs.sparkSession, n_strings)), "ordinary"))
    for r in seen.where(F.col("p").rlike(r"^[A-Za-z0-9+/_.=-]{2}$")).collect():
        counts[int(r["label"] == "ordinary"), ALPHABET.index(r["p"][0]), ALPHABET.index(r["p"][1])] += r["count"]
    logs = np.log(counts / counts.sum(axis=2, keepdims=True))
    return logs[0] - logs[1]


def _running(values: Column, step, start: Column) -> Column:
    """Running ``step`` over an array of integers from ``start``, the own element included.

    Arrays that a fold grows are as long as the square root of ``values``.
    """
    def grow(xs: Column) -> Column:
        return F.aggregate(xs, F.array(start), lambda acc, x: F.concat(acc, F.array(step(F.element_at(acc, -1), x))))

    def by_blocks(xs: Column, width: Column) -> Column:
        at = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / width).cast("int"))
        blocks = F.transform(at, lambda k: let(grow(F.slice(xs, k * width + 1, width)), lambda g: F.slice(g, 2, F.size(g) - 1)))
        return let(blocks, lambda bs: let(grow(F.transform(bs, lambda x: F.element_at(x, -1))), lambda before: F.flatten(
            F.transform(bs, lambda x, k: let(F.get(before, k), lambda v: F.transform(x, lambda y: step(v, y)))))))

    return let(values, lambda xs: F.when(F.size(xs) == 0, xs).otherwise(
        let(F.ceil(F.sqrt(F.size(xs))).cast("int"), lambda width: by_blocks(xs, width))))


def _located(text: Column, pattern: str, found: Column) -> Column:
    """Spans (s, e, m) of the matches ``found`` of ``pattern``, which are all of the text, in order."""
    between = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    steps = let(between, lambda b: F.zip_with(F.slice(b, 1, F.size(b) - 1), found, lambda g, m: g + F.length(m)))
    ends = _running(steps, lambda a, b: a + b, F.lit(0))
    return F.zip_with(ends, found, lambda e, m: F.struct((e - F.length(m)).alias("s"), e.alias("e"), m.alias("m")))


def _together(base: Column, random: Column) -> Column:
    """``base`` spans and those ``random`` spans that overlap none of them, in order.

    A random span overlaps no base span if none that begins before it ends behind
    its start, and none that begins later begins before its end.
    """
    last = 2**31 - 1
    is_random = lambda x: x["kind"] == KINDS.index("random")

    def merged(every: Column) -> Column:
        ends = F.transform(every, lambda x: F.when(is_random(x), F.lit(0)).otherwise(x["end"]))
        starts = F.transform(F.reverse(every), lambda x: F.when(is_random(x), F.lit(last)).otherwise(x["start"]))
        reach = _running(ends, lambda a, b: F.greatest(a, b), F.lit(0))
        ahead = F.reverse(_running(starts, lambda a, b: F.least(a, b), F.lit(last)))
        seen = F.zip_with(F.zip_with(every, reach, lambda x, r: F.struct(x.alias("x"), r.alias("r"))), ahead,
                          lambda y, a: F.struct(y["x"].alias("x"), y["r"].alias("r"), a.alias("a")))
        kept = F.filter(seen, lambda y: ~is_random(y["x"]) | ((y["r"] <= y["x"]["start"]) & (y["a"] >= y["x"]["end"])))
        return F.transform(kept, lambda y: y["x"])

    return F.when(F.size(random) == 0, base).when(F.size(base) == 0, random).otherwise(
        let(F.array_sort(F.concat(base, random)), merged))


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def log_ratio(token: Column, table: np.ndarray) -> Column:
    """Sum of the table over the neighbouring characters of ``token``."""
    flat, n = F.lit(table.reshape(-1)), len(ALPHABET)
    place = lambda c: F.call_function("locate", c, F.lit(ALPHABET)) - 1
    return F.aggregate(F.sequence(F.lit(1), F.length(token) - 1), F.lit(0.0), lambda acc, i: acc + F.coalesce(
        F.get(flat, place(F.substring(token, i, F.lit(1))) * n + place(F.substring(token, i + 1, F.lit(1)))), F.lit(0.0)))


def scan(docs: DataFrame, table: np.ndarray, text: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans``: arrays of (start, kind, end), kind by its place in KINDS."""
    t_, a_, c_, h_, k_ = unused(docs, "t", "assign", "access", "hex", "token")
    t = F.col(t_)
    found = docs.withColumn(t_, F.coalesce(F.col(f"`{text}`"), F.lit("")))
    found = found.select("*", F.inline(F.array(F.struct(
        _all(t, ASSIGN).alias(a_), _all(t, ACCESS).alias(c_), _all(t, HEX).alias(h_), _all(t, TOKEN).alias(k_)))))

    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def spans(col: str, kind: int, pattern: str, keep=None) -> Column:
        at = _located(t, pattern, F.col(col))
        at = F.filter(at, keep) if keep else at
        return F.when(F.size(col) == 0, none).otherwise(
            F.transform(at, lambda x: F.struct(x["s"].alias("start"), F.lit(kind).alias("kind"), x["e"].alias("end"))))

    long_value = lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= 6
    base = F.when(F.size(a_) + F.size(c_) + F.size(h_) > 0, F.array_sort(F.concat(
        spans(a_, 0, ASSIGN, long_value), spans(c_, 1, ACCESS), spans(h_, 2, HEX)))).otherwise(none)
    def random_token(x: Column) -> Column:
        score = log_ratio(F.rtrim(x["m"], F.lit("=.")), table)
        return (score >= LEAST_TOTAL) & (score >= LEAST_PER_PAIR * (F.length(x["m"]) - 1))
    b_, m_ = unused(found, "base_spans", "method_spans")
    found = found.select("*", F.inline(F.array(F.struct(
        base.alias(b_), spans(k_, 3, TOKEN, random_token).alias(m_)))))
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("base_spans", "spans")]
    return found.select(*rest, F.col(b_).alias("base_spans"), _together(F.col(b_), F.col(m_)).alias("spans"))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")


def op7_secrets(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = scan(docs, train(docs))
    count = lambda k: F.size(F.filter("base_spans", lambda x: x["kind"] == k)).cast("bigint")
    return out.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                      F.sha2(_written(F.col("base_spans")), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))
