"""Language identification by Bayesian fusion of several kinds of evidence.

For each text: ``P(language | all)`` is in proportion to

* ``P(text | language)``: a model of hashed byte trigrams, tempered so that a
  long text counts as ``FULL_TRIGRAMS`` independent ones at most;
* ``P(declared | language)``: how often texts of a language carry the declared
  value (a markup attribute or a metadata column);
* ``P(language | host)``: the share of languages of the host's texts, smoothed
  towards the share under its address suffix, which is smoothed towards the
  share of all texts.

The last two come from one grouped sum of the text-only probabilities of all
rows; a hot host adds up before the shuffle.  Besides the trained languages
there is ``und``, where all trigrams are as likely, for text that is none.

The trigram model is fitted on about ``TRAIN_ROWS`` distinct texts of each label,
chosen by a hash of the text, and on all of a label that has fewer, so each label
has a class at every size; texts are scored whole.

Defined cases: a null or empty text, or one without letters, is ``und`` with
probability 1 and not kept.  Null or unseen declared values, hosts and suffixes
give no evidence.  Ties go to the first language in order.  Repeated rows are
scored one by one; null ids and extra columns pass through.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.base import in_small_batches, ship, stored, unused

ship(__name__)

TRAIN_ROWS = 2000
FULL_TRIGRAMS = 200
BUCKETS = 1 << 16
SMOOTHING = 0.5
PRIOR_ROWS = 20.0          # weight of the level above, in rows
DECLARED_ROWS = 5.0
LEAST_POSTERIOR = 0.5
UNKNOWN = "und"

_LETTER = np.array([chr(b).isalpha() or b >= 128 for b in range(256)])
_FOLD = np.array([b if _LETTER[b] else 32 for b in range(256)], np.uint8)


def trigrams(text: str | None) -> np.ndarray:
    """Buckets of the byte trigrams of a text that hold a letter; other characters count as blanks."""
    buf = np.frombuffer((" " + (text or "").lower() + " ").encode("utf-8", "surrogatepass"), np.uint8)
    b = _FOLD[buf].astype(np.uint32)
    key = b[:-2] << 16 | b[1:-1] << 8 | b[2:]
    key = key[(b[:-2] != 32) | (b[1:-1] != 32) | (b[2:] != 32)]
    return (key * np.uint32(2654435761)) >> np.uint32(16)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out: dict[str, np.ndarray] = {}
        for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
            counts = out.setdefault(lang, np.zeros(BUCKETS, np.int64))
            counts += np.bincount(trigrams(text.as_py()), minlength=BUCKETS)
        for lang, counts in out.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])],
                                             names=["lang", "bucket", "n"])


def train(rows: DataFrame, label: str, text: str, n: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages (with UNKNOWN last) and their log-probabilities by bucket.

    At most BUCKETS rows a language come to the driver.
    """
    some = rows.where(F.col(label).isNotNull() & (F.col(label) != UNKNOWN) & F.col(text).isNotNull())
    some = some.select(F.col(label).alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("hash"))
    sizes = {r["lang"]: r["n"] for r in some.groupBy("lang").agg(F.approx_count_distinct("hash").alias("n")).collect()}
    # a label of up to n texts is taken whole, whatever the error of the count
    shares = [F.lit(x) for lang, size in sizes.items() if size > 2 * n for x in (lang, n / size)]
    share = F.coalesce(F.element_at(F.create_map(*shares), F.col("lang")), F.lit(1.0)) if shares else F.lit(1.0)
    chosen = some.where(F.pmod("hash", F.lit(1 << 30)) < share * float(1 << 30))
    chosen = chosen.groupBy("lang", "hash").agg(F.first("text").alias("text"))       # repeated texts count once
    counts = chosen.select("lang", "text").mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = counts.collect()
    langs = sorted({r["lang"] for r in got})
    table = np.full((len(langs) + 1, BUCKETS), SMOOTHING)
    for r in got:
        table[langs.index(r["lang"]), r["bucket"]] += r["n"]
    table[-1] = 1.0
    return [*langs, UNKNOWN], np.ascontiguousarray(np.log(table / table.sum(axis=1, keepdims=True)).T.astype(np.float32))


def _likelihoods(table: np.ndarray):
    def run(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            k = trigrams(t)
            if len(k):
                out.append((table[k].sum(axis=0, dtype=np.float64) * min(1.0, FULL_TRIGRAMS / len(k))).tolist())
            else:
                out.append(None)
        return pd.Series(out)
    return F.pandas_udf(run, "array<double>")


def _softmax(logs: Column) -> Column:
    """Probabilities from an array of logarithms."""
    def of(p: Column) -> Column:
        return F.transform(p, lambda x: x / F.aggregate(p, F.lit(0.0), lambda a, b: a + b))
    def shifted(z: Column) -> Column:
        return F.transform(F.array(F.transform(z, lambda x: F.exp(x - F.array_max(z)))), of)[0]
    return F.transform(F.array(logs), shifted)[0]


def _levels(rows: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Tables of log-evidence by host and by declared value, from rows (host, suffix, declared, p)."""
    sums = [F.sum(F.get("p", F.lit(i))).alias(f"s{i}") for i in range(k)]
    cells = stored(rows.where("p is not null").groupBy("host", "suffix", "declared").agg(*sums), "lang-cells")
    again = [F.sum(f"s{i}").alias(f"s{i}") for i in range(k)]
    total = np.array([x or 0.0 for x in cells.agg(*again).first()])
    share = (total + 1.0) / (total + 1.0).sum()
    n = sum((F.col(f"s{i}") for i in range(1, k)), F.col("s0"))

    suffixes = cells.groupBy("suffix").agg(*again).select("suffix", *[
        F.when(F.col("suffix").isNull(), F.lit(float(share[i]))).otherwise((F.col(f"s{i}") + PRIOR_ROWS * float(share[i])) / (n + PRIOR_ROWS)).alias(f"q{i}")
        for i in range(k)])
    hosts = cells.where("host is not null").groupBy("host", "suffix").agg(*again)
    hosts = hosts.join(suffixes, hosts["suffix"].eqNullSafe(suffixes["suffix"])).select(
        F.col("host").alias("host_key"), hosts["suffix"].alias("suffix_key"),
        F.array(*[F.log((F.col(f"s{i}") + PRIOR_ROWS * F.col(f"q{i}")) / (n + PRIOR_ROWS)) for i in range(k)]).alias("host_log"))
    said = cells.where("declared is not null").groupBy("declared").agg(*again)
    said = said.select(F.col("declared").alias("declared_key"), F.array(*[
        F.log((F.col(f"s{i}") + DECLARED_ROWS * n / float(max(total.sum(), 1.0))) / float(total[i] + DECLARED_ROWS)) for i in range(k)]).alias("declared_log"))
    return stored(hosts, "lang-hosts"), stored(said, "lang-declared")


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))


def identify(docs: DataFrame, text: str = "text", declared: Column | None = None, host: Column | None = None,
             suffix: Column | None = None, label: Column | None = None) -> DataFrame:
    """``docs`` with ``language``, ``posterior``, ``declared_agrees`` and ``kept``.

    ``label`` is the column that the text model is trained on (the declared
    one if not given).  ``suffix`` is a host's address suffix.
    """
    none = F.lit(None).cast("string")
    t_, d_, h_, s_, l_, p_ = unused(docs, "t", "declared", "host", "suffix", "label", "p")
    rows = in_small_batches(docs).select("*", F.col(f"`{text}`").alias(t_), (none if declared is None else declared).cast("string").alias(d_),
                       (none if host is None else F.nullif(host, F.lit(""))).cast("string").alias(h_),
                       (none if suffix is None else F.nullif(suffix, F.lit(""))).cast("string").alias(s_),
                       (declared if label is None else label).cast("string").alias(l_))
    langs, table = train(rows.select(l_, t_), l_, t_)
    rows = rows.drop(l_).withColumn(p_, _likelihoods(table)(F.col(t_)))
    hosts, said = _levels(rows.select(F.col(h_).alias("host"), F.col(s_).alias("suffix"), F.col(d_).alias("declared"),
                                      _softmax(F.col(p_)).alias("p")), len(langs))
    hk_, sk_, hl_, dk_, dl_ = unused(rows, "host_key", "suffix_key", "host_log", "declared_key", "declared_log")
    hosts, said = hosts.toDF(hk_, sk_, hl_), said.toDF(dk_, dl_)
    out = rows.join(hosts, F.col(h_).eqNullSafe(F.col(hk_)) & F.col(s_).eqNullSafe(F.col(sk_)), "left")
    out = out.join(said, F.col(d_) == F.col(dk_), "left")
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    zero = F.array(*[F.lit(0.0)] * len(langs))
    logs = add(add(F.col(p_), F.coalesce(F.col(hl_), zero)), F.coalesce(F.col(dl_), zero))
    out = out.withColumn(p_, F.when(F.col(p_).isNotNull(), _softmax(logs)))
    best = F.array_max(p_)
    language = F.coalesce(F.get(F.array(*map(F.lit, langs)), (F.array_position(p_, best) - 1).cast("int")), F.lit(UNKNOWN))
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("language", "posterior", "declared_agrees", "kept")]
    out = out.select(*rest, language.alias("language"), F.coalesce(best, F.lit(1.0)).alias("posterior"), F.col(d_).alias(d_))
    kept = (F.col("language") != UNKNOWN) & (F.col("posterior") >= LEAST_POSTERIOR)
    return out.withColumn("declared_agrees", F.lower(F.substring(d_, 1, 2)) == F.col("language")).withColumn("kept", kept).drop(d_)


def identify_documents(docs: DataFrame) -> DataFrame:
    """``documents``: the language column is the declared value, the source the host."""
    return identify(docs, "text", F.col("lang"), F.col("source"))


def page_language(spark, sf_dir: str) -> DataFrame:
    """``pages``: markup language, host and address suffix of each page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    body = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"<[^>]*>", " ")
    declared = F.nullif(F.lower(F.regexp_extract("html", r"(?i)<html[^>]*\blang\s*=\s*[\"']?([A-Za-z]+)", 1)), F.lit(""))
    host = host_of(F.col("url"))
    rows = pages.select("page_id", body.alias("text"), declared.alias("lang"), host.alias("host"), F.regexp_extract(host, r"([^.]+)$", 1).alias("suffix"))
    return identify(rows, "text", F.col("lang"), F.col("host"), F.col("suffix")).select(
        "page_id", "language", F.round("posterior", 6).alias("posterior"), "declared_agrees", "kept")


def op5_language(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    return identify_documents(docs).select("doc_id", "language", F.round("posterior", 6).alias("posterior"), "declared_agrees", "kept")
