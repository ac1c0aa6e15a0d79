"""Chunk-store operations as DataFrame transformations.

The store is a table of records ``(id, article_id, chunk_index, total_chunks,
document, <metadata columns>, embedding)``.  These functions are pure: they
take the current store and return the new one (or a lookup result);
:mod:`folio.sources.store` persists them in versions.

Joins against the store are keyed on ``id``.  The request side (ids to get
or delete, newly arriving records) has no size bound of its own, so no
broadcast is forced: with adaptive execution Spark measures the request
side's shuffle output at run time and switches to a broadcast hash join when
it is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``, and keeps the
sort-merge join otherwise.  That is the size check, made on real data
instead of a second pass over it.  A store written by
:mod:`folio.sources.store` is partitioned by a hash bucket of the article id;
its own lookups filter on the buckets of the ids asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# --- fixed values -----------------------------------------------------------
STORE_BUCKETS = 64
# ---------------------------------------------------------------------------


def bucket_of(article_id: Column, buckets: int = STORE_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(article_id), F.lit(buckets)).cast("int")


def article_of(record_id: Column) -> Column:
    """The article id inside a record id (``<article>`` or ``<article>_chunk_<i>``)."""
    return F.regexp_replace(record_id, "_chunk_[0-9]+$", "")


def iso_time(ts: Column) -> Column:
    """``datetime.isoformat()`` of a naive timestamp: fraction only when non-zero."""
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(ts, "SSSSSS")
    return F.when(ts.isNull(), F.lit(None)).otherwise(
        F.when(frac != "000000", F.concat(base, F.lit("."), frac)).otherwise(base)
    )


def metadata(records: DataFrame) -> DataFrame:
    """Flat metadata of each record (ISO times, JSON lists, optional keys NULL).

    Lists use Spark's compact JSON (``["a","b"]``); optional keys
    (publish_date, top_image, meta_description, summary) are NULL when empty.
    """
    def opt(c: str) -> Column:
        return F.nullif(F.col(c), F.lit(""))

    return records.select(
        "id",
        F.col("chunk_index").cast("int").alias("chunk_index"),
        F.col("total_chunks").cast("int").alias("total_chunks"),
        "url", "title", "source_domain",
        F.col("word_count").cast("int").alias("word_count"),
        iso_time(F.col("scraped_at")).alias("scraped_at"),
        F.to_json(F.coalesce(F.col("authors"), F.array().cast("array<string>"))).alias("authors"),
        F.to_json(F.coalesce(F.col("meta_keywords"), F.array().cast("array<string>"))).alias("meta_keywords"),
        F.to_json(F.coalesce(F.col("topics"), F.array().cast("array<string>"))).alias("topics"),
        iso_time(F.col("publish_date")).alias("publish_date"),
        opt("top_image").alias("top_image"),
        opt("meta_description").alias("meta_description"),
        opt("summary").alias("summary"),
    )


def insert_new(store: DataFrame, incoming: DataFrame) -> DataFrame:
    """Records of articles that are not stored yet (a stored article is left as it is).

    An article is whole or absent: comparing record ids would add the surplus
    chunks of a longer new version to the stored one.  Only the store's article
    ids cross the shuffle (or, for a small batch, AQE broadcasts the batch side).
    """
    return incoming.join(store.select("article_id").distinct(), "article_id", "left_anti").select(*incoming.columns)


def storable() -> Column:
    """True if an article has something to embed (title and content are not empty)."""
    return (F.length(F.coalesce(F.col("title"), F.lit(""))) > 0) & (F.length(F.coalesce(F.col("content"), F.lit(""))) > 0)


def outcome(incoming_articles: DataFrame) -> DataFrame:
    """One row of success / failed counts of a batch that is not written; an empty batch gives zeros."""
    ok = storable()
    return incoming_articles.agg(
        F.count_if(ok).cast("bigint").alias("success"),
        F.count_if(~ok).cast("bigint").alias("failed"),
    )


def get(store: DataFrame, ids: DataFrame) -> DataFrame:
    """Records with exactly these ids (no row for an unknown id)."""
    return store.join(ids.select("id"), "id", "left_semi")


def by_article(ids: DataFrame) -> DataFrame:
    """Distinct record ids by the article in them: ``(article_id, _ids, _numbers)``, with the numbers of those that are ids of chunks."""
    article = article_of(F.col("id"))
    number = F.nullif(F.regexp_extract("id", r"_chunk_(0|[1-9][0-9]{0,8})\z", 1), F.lit("")).cast("int")
    rows = ids.where("id is not null").select("id", article.alias("article_id"), number.alias("n"))
    return rows.groupBy("article_id").agg(F.collect_set("id").alias("_ids"), F.collect_set("n").alias("_numbers"))


def exists(ids: DataFrame, store: DataFrame) -> DataFrame:
    """A10: each requested id with a stored / not stored flag.

    The store is only semi-joined against the requested ids (the side a small
    request can broadcast), and the flag join runs on ids found, which are no
    more than the requests.
    """
    req = ids.select("id").distinct()
    found = store.select("id").join(req, "id", "left_semi").distinct().withColumn("_hit", F.lit(True))
    return req.join(found, "id", "left").select("id", F.coalesce(F.col("_hit"), F.lit(False)).alias("exists"))


def list_records(store: DataFrame, limit: int | None = None) -> DataFrame:
    """All records ordered by id, optionally the first ``limit``."""
    out = store.orderBy("id")
    return out.limit(limit) if limit is not None else out


def delete(store: DataFrame, ids: DataFrame, by: str = "id") -> DataFrame:
    """The store without the given ids (absent ids are not an error).

    ``by="article_id"`` deletes every chunk of the given articles.
    """
    return store.join(ids.select(F.col(by)), by, "left_anti")


def count(store: DataFrame, records: Column | None = None) -> DataFrame:
    """Number of records (chunks) and of distinct articles; ``records`` is the number of records in a row, if not one."""
    return store.agg(
        F.coalesce(F.sum(F.lit(1) if records is None else records), F.lit(0)).cast("bigint").alias("records"),
        F.countDistinct("article_id").cast("bigint").alias("articles"),
    )


def reset(store: DataFrame) -> DataFrame:
    """An empty store with the same schema."""
    return store.limit(0)
