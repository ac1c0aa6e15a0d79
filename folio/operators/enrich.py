"""Batch language-model enrichment as tables.

The reference calls a model once per article or part.  On Spark the calls
leave the query plan: :func:`prompt_requests` writes a request table (any
batch inference job can answer it) and the response table comes back as an
input.  Parsing and merging are column expressions and two small aggregates
keyed by article, whose groups are bounded by the number of parts.

JSON is read with the VARIANT type (``try_parse_json``), which tells a
missing key from a JSON ``null`` and a string topic from a number; ``from_json``
cannot do either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.text import py_strip
from folio.operators.common import computed

# --- fixed values -----------------------------------------------------------
NO_SUMMARY = "No summary available."
FAILED = "Could not generate summary."
FAILED_FINAL = "Could not generate final summary."
FAILED_PART = "Could not generate summary for part {}."
# Our own prompt wording; only the JSON reply contract matters downstream.
PROMPT_TEMPLATE = (
    "Read the news text below{context}. Reply with JSON only, in the form "
    '{{"summary": "<two or three sentences>", "topics": ["<topic>", "..."]}}.\n\n'
    "Text:\n"
)
# ---------------------------------------------------------------------------


def prompt_requests(routed: DataFrame, id_col: str = "id", content: str = "content") -> DataFrame:
    """One request per single article, one per part otherwise.

    ``part`` is 1-based; the prompt names "(Part i of n)" only when n > 1.
    """
    pieces = F.when(F.col("route") == "single", F.array(F.col(content))).otherwise(F.col("parts"))
    exploded = routed.select(
        F.col(id_col).alias("request_id"), "route",
        F.size(pieces).alias("parts"),
        F.posexplode(pieces).alias("_i", "_text"),
    )
    part = (F.col("_i") + 1).cast("int")
    context = F.when(
        F.col("parts") > 1, F.format_string(" (Part %d of %d)", part, F.col("parts"))
    ).otherwise(F.lit(""))
    head = F.replace(F.lit(PROMPT_TEMPLATE.replace("{{", "{").replace("}}", "}")), F.lit("{context}"), context)
    return exploded.select(
        "request_id", part.alias("part"), F.col("parts").cast("int").alias("parts"), "route",
        F.concat(head, F.col("_text")).alias("prompt"),
    )


def _truthy(x: Column) -> Column:
    """Truth value of a JSON value the way Python reads the decoded object.

    Missing, null, "", 0, false, [] and {} are false; everything else is true.
    """
    k = F.schema_of_variant(x)
    return (
        F.when(x.isNull() | (k == "VOID"), F.lit(False))
        .when(k == "STRING", F.try_variant_get(x, "$", "string") != "")
        .when(k == "BOOLEAN", F.try_variant_get(x, "$", "boolean"))
        .when(k.startswith("ARRAY"), F.size(F.try_variant_get(x, "$", "array<variant>")) > 0)
        .when(k.startswith("OBJECT"), k != "OBJECT<>")
        .otherwise(F.coalesce(F.try_variant_get(x, "$", "double") != 0, F.lit(True)))
    )


def _with_reply(responses: DataFrame, body: str) -> DataFrame:
    """``responses`` with the stripped reply and its JSON value, both made once per row."""
    return computed(computed(responses, _reply=py_strip(F.col(body))), _json=F.try_parse_json("_reply"))


def _parsed() -> dict[str, Column]:
    """Reply fields; topics iterate like Python: list items, string characters, object keys."""
    text, v = F.col("_reply"), F.col("_json")
    is_obj = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    s_var = F.try_variant_get(v, "$.summary", "variant")
    t_var = F.try_variant_get(v, "$.topics", "variant")
    t_kind = F.coalesce(F.schema_of_variant(t_var), F.lit(""))
    t_arr = F.try_variant_get(v, "$.topics", "array<variant>")
    all_strings = F.coalesce(F.forall(t_arr, lambda e: F.schema_of_variant(e) == "STRING"), F.lit(False))
    items = (
        F.when(t_kind.startswith("ARRAY"), F.transform(t_arr, lambda e: e.cast("string")))
        .when(t_kind == "STRING", F.split(F.try_variant_get(v, "$.topics", "string"), ""))
        .when(t_kind.startswith("OBJECT"), F.json_object_keys(F.get_json_object(text, "$.topics")))
    )
    iterable = (
        F.when(t_kind.startswith("ARRAY"), all_strings)
        .when((t_kind == "STRING") | t_kind.startswith("OBJECT"), F.lit(True))
        .otherwise(F.lit(False))
    )
    cleaned = F.coalesce(F.filter(F.transform(items, py_strip), lambda t: t != ""), F.array().cast("array<string>"))
    return dict(is_obj=is_obj, has_s=s_var.isNotNull(), has_t=t_var.isNotNull(),
                s_true=_truthy(s_var), t_true=_truthy(t_var),
                s_str=F.try_variant_get(v, "$.summary", "string"), iterable=iterable, cleaned=cleaned)


def parse_single(responses: DataFrame, body: str = "body") -> DataFrame:
    """Both keys required; a false summary (null, "", 0, ...) gives the default text
    and false topics give none.  True topics must iterate to strings: a list of
    strings, the characters of a string, or the keys of an object.

    Bad JSON, a missing key, a non-object reply or topics that fail to iterate
    give the fallback summary and no topics (``ok`` = false).
    """
    return _with_reply(responses, body).select(*responses.columns, *_single(_parsed()))


def _single(p: dict[str, Column]) -> list[Column]:
    ok = p["is_obj"] & p["has_s"] & p["has_t"] & (~p["t_true"] | p["iterable"])
    summary = F.when(p["s_true"], p["s_str"]).otherwise(F.lit(NO_SUMMARY))
    topics = F.when(p["t_true"], p["cleaned"]).otherwise(F.array().cast("array<string>"))
    return _or_failed(ok, summary, topics, F.lit(FAILED))


def _or_failed(ok: Column, summary: Column, topics: Column, failed: Column) -> list[Column]:
    return [
        F.when(ok, summary).otherwise(failed).alias("summary"),
        F.when(ok, topics).otherwise(F.array().cast("array<string>")).alias("topics"),
        ok.alias("ok"),
    ]


def parse_part(responses: DataFrame, body: str = "body", part: str = "part") -> DataFrame:
    """Defaults for *missing* keys only; an empty summary stays empty.

    Present topics must iterate to strings (null, a number or a boolean do
    not); otherwise the part gives "Could not generate summary for part N."
    and no topics.
    """
    return _with_reply(responses, body).select(*responses.columns, *_part(_parsed(), part))


def _part(p: dict[str, Column], part: str) -> list[Column]:
    ok = p["is_obj"] & (~p["has_t"] | p["iterable"])
    summary = F.when(~p["has_s"], F.lit(NO_SUMMARY)).otherwise(F.coalesce(p["s_str"], F.lit("")))
    topics = F.when(~p["has_t"], F.array().cast("array<string>")).otherwise(p["cleaned"])
    return _or_failed(ok, summary, topics, F.format_string(FAILED_PART.replace("{}", "%d"), F.col(part)))


def merge_summaries(parts: DataFrame, key: str = "request_id", part: str = "part") -> DataFrame:
    """The merge request text ("Section i: ..." by blank lines) and the
    fallback summary (part summaries joined by a space, stripped)."""
    ordered = parts.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct(F.col(part).alias("p"), F.col("summary").alias("s")))).alias("_xs")
    )
    sections = F.transform(F.col("_xs"), lambda x, i: F.concat(F.lit("Section "), (i + 1).cast("string"), F.lit(": "), x["s"]))
    fallback = py_strip(F.array_join(F.transform(F.col("_xs"), lambda x: x["s"]), " "))
    n = F.size("_xs")
    return ordered.select(
        key,
        n.cast("int").alias("n_parts"),
        F.when(n > 0, F.array_join(sections, "\n\n")).alias("merge_prompt"),
        F.when(n > 0, fallback).otherwise(F.lit(FAILED)).alias("summary"),
    )


def merge_topics(parts: DataFrame, key: str = "request_id", part: str = "part") -> DataFrame:
    """E5: topics of all parts in order, distinct ignoring case, first spelling kept.

    One aggregate per article (a group holds that article's parts); the
    ordered, case-insensitive distinct runs inside the row.
    """
    per = parts.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct(F.col(part).alias("p"), F.col("topics").alias("t")))).alias("_xs"))
    return per.select(key, _dedup_ci(F.flatten(F.transform(F.col("_xs"), lambda x: x["t"]))).alias("topics"))


def _dedup_ci(topics: Column) -> Column:
    """Case-insensitive distinct keeping the first spelling, in order (bounded arrays)."""
    def body(lows: Column) -> Column:
        return F.filter(topics, lambda t, i: F.array_position(lows, F.lower(t)) == i + 1)
    return F.transform(F.array(F.transform(topics, F.lower)), body)[0]


def enrich(requests: DataFrame, responses: DataFrame, merge_replies: DataFrame | None = None) -> DataFrame:
    """Request table + response tables -> one (summary, topics) per article.

    Requests without a response count as failed calls (left join).  Every reply
    is parsed once, then a single aggregate per request orders its parts (a
    group holds one article's parts) and merges topics inside the row.

    ``merge_replies(request_id, body)`` answers the merge requests of
    :func:`merge_summaries`, at most one row a request: its text is the summary
    of an article in parts.  An empty or null reply gives the fixed text
    ``FAILED_FINAL``; without a reply the part summaries are joined.
    """
    joined = requests.join(responses, ["request_id", "part"], "left")
    single, parted = F.struct(*_single(_parsed())), F.struct(*_part(_parsed(), "part"))
    per_reply = _with_reply(joined, "body").select(
        "request_id", "part", "route", F.when(F.col("route") == "single", single).otherwise(parted).alias("_out"))
    per_req = per_reply.groupBy("request_id").agg(
        F.first("route").alias("route"),
        F.sort_array(F.collect_list(F.struct("part", "_out.summary", "_out.topics"))).alias("_xs"),
    )
    xs = F.col("_xs")
    merged = F.array_join(F.transform(xs, lambda x: x["summary"]), " ")
    if merge_replies is not None:
        replies = merge_replies.select("request_id", F.coalesce(F.nullif("body", F.lit("")), F.lit(FAILED_FINAL)).alias("_final"))
        per_req = per_req.join(replies, "request_id", "left")
        merged = F.coalesce("_final", merged)
    single_route = F.col("route") == "single"
    return per_req.select(
        "request_id", "route",
        F.when(single_route, xs[0]["summary"]).otherwise(py_strip(merged)).alias("summary"),
        F.when(single_route, xs[0]["topics"]).otherwise(_dedup_ci(F.flatten(F.transform(xs, lambda x: x["topics"])))).alias("topics"),
    )
