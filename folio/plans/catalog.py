"""The registered queries: one per operator row of the inventory.

Each entry is ``(spark, sf_dir) -> DataFrame`` and reads whole tables (or
data Spark derives from them).  Array results are rendered with ``|`` joins
so that the DuckDB twins in :mod:`folio.plans.oracle` compare exactly.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions import text as X
from folio.functions import urls as U
from folio.operators import cells
from folio.operators import enrich as E
from folio.operators import pages as P
from folio.operators import reports as R
from folio.operators import retrieval as Q
from folio.operators import store as S
from folio.operators.chunking import paragraph_chunks as paragraph_chunks_col
from folio.operators.chunking import sentence_chunks as sentence_chunks_col
from folio.operators.chunking import store_records
from folio.operators.keywords import keywords
from folio.operators.routing import analysis_route, context_limit
from folio.plans import derived as D
from folio.session import work_dir
from folio.sources.export import export
from folio.sources.store import ChunkStore, open_store
from folio.sources.urllist import read_url_run

Query = Callable[[SparkSession, str], DataFrame]

# --- fixed values -----------------------------------------------------------
CHUNK_BUDGET = 200            # sentence chunker budget used on documents
LONG_TEXT_MAX_TOKENS = 1200   # paragraph chunker budget on conversations (limit 200)
STORE_TEST_MAX_TOKENS = 200   # store record budget for the store queries
BATCH_SIZE = 3                # pages per batch in batch_assign
PACK_BUDGET = 400             # context pack budget (tokens)
# Model names assigned to documents for routing (exact names and rule cases).
MODEL_CANDIDATES = (
    "gpt-3.5-turbo", "gpt-4", "gpt-4o-mini", "text-davinci-003", "code-davinci-002", "gpt-5-nano",
    "GPT-4O-Custom", "my-gpt-4-1106-x", "gpt-4-32k", "gpt-3.5-turbo-instruct", "code-davinci-edit",
    "text-davinci-001", "local-model",
)
# ---------------------------------------------------------------------------


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return D.table(spark, sf, name)


def _bar(col) -> F.Column:
    return F.array_join(col, "|")


def _page_scraped_at(page_id) -> F.Column:
    return D.scraped_at(page_id)


# ---------------------------------------------------------------- A / B: pages, urls
def url_list_scan(spark, sf):
    return P.url_list_scan(D.url_lines(_t(spark, sf, "pages")))


def url_valid(spark, sf):
    lines = D.url_lines(_t(spark, sf, "pages"))
    v = F.col("value")
    return lines.select("line_no", U.strict_valid(v).alias("strict_valid"), U.prefix_valid(v).alias("prefix_valid"),
                        U.trim_url(v).alias("trimmed"))


def url_normalize(spark, sf):
    lines = D.url_lines(_t(spark, sf, "pages"))
    return lines.select("line_no", U.normalize(F.col("value")).alias("normalized"))


def url_dedup(spark, sf):
    pages = _t(spark, sf, "pages")
    return pages.groupBy(U.normalize(F.col("url")).alias("normalized")).agg(
        F.min("page_id").alias("first_page_id"), F.count(F.lit(1)).cast("bigint").alias("copies"))


def url_domain(spark, sf):
    pages = _t(spark, sf, "pages")
    return pages.groupBy(U.netloc(F.col("url")).alias("domain")).agg(F.count(F.lit(1)).cast("bigint").alias("pages"))


def page_fields(spark, sf):
    f = P.page_fields(_t(spark, sf, "pages"))
    return f.select("page_id", F.col("raw_title").alias("title"), F.col("raw_text").alias("text"),
                    _bar(F.col("authors")).alias("authors"), "top_image", "meta_description",
                    _bar(F.col("meta_keywords")).alias("meta_keywords"))


def drop_incomplete(spark, sf):
    f = P.drop_incomplete(P.page_fields(_t(spark, sf, "pages")))
    return f.select("page_id", "url")


def articles(spark, sf):
    fields = P.drop_incomplete(P.page_fields(P.fetchable(_t(spark, sf, "pages"))))
    fields = fields.withColumn("_sa", _page_scraped_at(F.col("page_id")))
    a = P.assemble(fields, F.col("_sa"), keep=("page_id",))
    return a.select("page_id", "id", "url", "title", "content", "source_domain", "word_count",
                    _bar(F.col("authors")).alias("authors"), _bar(F.col("meta_keywords")).alias("meta_keywords"),
                    "meta_description", "top_image", _bar(F.col("topics")).alias("topics"), "summary",
                    S.iso_time(F.col("scraped_at")).alias("scraped_at"))


def ingest_outcome(spark, sf):
    return P.ingest_outcome(_t(spark, sf, "pages"))


def ingest_order(spark, sf):
    pages = _t(spark, sf, "pages")
    listed = read_url_run(spark, D.url_files(pages, work_dir(spark, "url-files")))
    arts = P.one_per_id(P.assemble(P.drop_incomplete(P.page_fields(P.fetchable(pages))), F.lit(None).cast("timestamp_ntz"), keep=("page_id",)))
    return P.ordered_outcome(listed, arts)


def page_links(spark, sf):
    return P.page_links(_t(spark, sf, "pages")).select("page_id", "pos", "href")


def page_links_abs(spark, sf):
    return P.resolve_links(P.page_links(_t(spark, sf, "pages"))).select("page_id", "pos", "link")


def page_links_same_domain(spark, sf):
    links = P.same_domain_links(P.resolve_links(P.page_links(_t(spark, sf, "pages"))))
    return links.select("page_id", "pos", "link")


def article_links(spark, sf):
    links = D.hub_links(_t(spark, sf, "orders"))
    return P.article_links(links, key="url").select(
        F.col("url").alias("hub"), "link", F.col("first_pos").cast("bigint"), F.col("n_refs").cast("bigint"))


# ---------------------------------------------------------------- C: text
def clean_text(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", X.clean_text(F.col("text")).alias("cleaned"))


def truncate_text(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", X.truncate_text(F.col("text")).alias("truncated"))


def keywords_q(spark, sf):
    return keywords(_t(spark, sf, "documents"), "doc_id", "text")


def word_count(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", X.word_count(F.col("text")).alias("words"))


def token_count(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", X.token_count(F.col("text")).alias("tokens"))


def email_audit(spark, sf):
    return R.email_audit(_t(spark, sf, "documents"))


def export_key(spark, sf):
    f = P.page_fields(_t(spark, sf, "pages"))
    return f.select("page_id", X.file_key(F.col("url")).alias("url_key"),
                    X.file_key(X.py_strip(F.col("raw_title"))).alias("title_key"))


def export_write(spark, sf):
    """Page titles written to a folder for each domain and read back."""
    pages = _t(spark, sf, "pages")
    f = P.page_fields(pages).select("page_id", "url", X.py_strip(F.col("raw_title")).alias("title"), U.netloc(F.col("url")).alias("domain"))
    return export(f, work_dir(spark, "export"), "domain")


def batch_assign(spark, sf):
    pages = _t(spark, sf, "pages").select("page_id", U.netloc(F.col("url")).alias("domain"))
    return R.batch_assign(pages, "domain", "page_id", BATCH_SIZE).select("page_id", "domain", "batch_no", "batch_pos")


def size_report(spark, sf):
    return R.size_report(_t(spark, sf, "pages"))


def duration_report(spark, sf):
    return R.duration_report(_t(spark, sf, "events"))


# ---------------------------------------------------------------- D: chunking, routing
def _doc_articles(spark, sf):
    return D.doc_articles(_t(spark, sf, "documents"))


def storage_gate(spark, sf):
    recs = store_records(_doc_articles(spark, sf))
    return recs.select("id", "article_id", "chunk_index", "total_chunks", "document")


def sentence_chunks(spark, sf):
    docs = _t(spark, sf, "documents").select("doc_id", "text")
    # explode the expression itself: exploding a bound column lets Spark infer a
    # size() > 0 filter that re-runs the whole fold below the projection
    ch = docs.select("doc_id", F.posexplode(sentence_chunks_col(F.col("text"), CHUNK_BUDGET)).alias("chunk_index", "chunk"))
    return ch.select(
        "doc_id", "chunk_index", "chunk", X.token_count(F.col("chunk")).alias("tokens"))


def chunk_records(spark, sf):
    recs = store_records(_doc_articles(spark, sf), max_tokens=STORE_TEST_MAX_TOKENS)
    return recs.select("id", "article_id", "chunk_index", "total_chunks", "document")


def paragraph_chunks(spark, sf):
    texts = D.long_texts(_t(spark, sf, "conversations"))
    return texts.select("conv_id", F.posexplode(paragraph_chunks_col(F.col("content"), LONG_TEXT_MAX_TOKENS)).alias(
        "chunk_index", "chunk"))


def _model_of(doc_id) -> F.Column:
    names = F.array(*[F.lit(m) for m in MODEL_CANDIDATES])
    return F.element_at(names, (F.pmod(doc_id, F.lit(len(MODEL_CANDIDATES))) + 1).cast("int"))


def context_limit_q(spark, sf):
    docs = _t(spark, sf, "documents").select("doc_id")
    return docs.select("doc_id", _model_of(F.col("doc_id")).alias("model")).withColumn(
        "context_limit", context_limit(F.col("model")))


def _routed(spark, sf):
    arts = _doc_articles(spark, sf)
    return analysis_route(arts, _model_of(F.col("doc_id")))


def analysis_route_q(spark, sf):
    r = _routed(spark, sf)
    return r.select("id", "model", "n_tokens", "context_limit", "route",
                    F.coalesce(F.size("parts"), F.lit(1)).cast("int").alias("n_parts"))


# ---------------------------------------------------------------- E: enrichment
def prompt_requests(spark, sf):
    return E.prompt_requests(_routed(spark, sf))


def _single_responses(spark, sf):
    docs = _t(spark, sf, "documents")
    return docs.select("doc_id", D.planted_body(F.col("doc_id"), F.lit(1), F.col("lang"), F.col("source")).alias("body"))


def parse_single(spark, sf):
    out = E.parse_single(_single_responses(spark, sf))
    return out.select("doc_id", "summary", _bar(F.col("topics")).alias("topics"), "ok")


def _part_responses(spark, sf):
    docs = _t(spark, sf, "documents").select("doc_id", "lang", "source", "text")
    parts = docs.select("doc_id", "lang", "source", F.posexplode(
        sentence_chunks_col(F.col("text"), CHUNK_BUDGET)).alias("_i", "_c")).withColumn(
        "part", (F.col("_i") + 1).cast("int"))
    return parts.select("doc_id", "part",
                        D.planted_body(F.col("doc_id"), F.col("part"), F.col("lang"), F.col("source")).alias("body"))


def parse_part(spark, sf):
    out = E.parse_part(_part_responses(spark, sf))
    return out.select("doc_id", "part", "summary", _bar(F.col("topics")).alias("topics"), "ok")


def merge_summaries(spark, sf):
    parsed = E.parse_part(_part_responses(spark, sf))
    return E.merge_summaries(parsed, key="doc_id")


def merge_topics(spark, sf):
    parsed = E.parse_part(_part_responses(spark, sf))
    docs = _t(spark, sf, "documents").select("doc_id")
    merged = E.merge_topics(parsed, key="doc_id")
    return docs.join(merged, "doc_id", "left").select(
        "doc_id", F.coalesce(_bar(F.col("topics")), F.lit("")).alias("topics"))


def _request_responses(spark, sf, requests: DataFrame, *keep: str) -> DataFrame:
    arts = _doc_articles(spark, sf).select(F.col("id").alias("request_id"), "doc_id", "lang", "source")
    return requests.select("request_id", "part").join(arts, "request_id").select(
        "request_id", "part", D.planted_body(F.col("doc_id"), F.col("part"), F.col("lang"), F.col("source")).alias("body"), *keep)


def enrich_articles(spark, sf):
    reqs = E.prompt_requests(_routed(spark, sf))
    resp = _request_responses(spark, sf, reqs)
    out = E.enrich(reqs, resp, D.merge_replies(_doc_articles(spark, sf)))
    return out.select("request_id", "route", "summary", _bar(F.col("topics")).alias("topics"))


# ---------------------------------------------------------------- F: retrieval
def _vectors(spark, sf):
    return _t(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")


def _queries(spark, sf):
    return _t(spark, sf, "embeddings").select(F.col("vec_id").alias("qid"), "embedding")


def _round6(df):
    return df.withColumn("distance", F.round("distance", 6))


def knn_topk(spark, sf):
    return _round6(Q.knn(_vectors(spark, sf), _queries(spark, sf), k=Q.DEFAULT_K))


def knn_approx(spark, sf):
    """Every hundredth vector as a query against an index of all vectors, with the probes that its data need."""
    store = _vectors(spark, sf)
    queries = _queries(spark, sf).where(F.col("qid") % 100 == 0)
    index = cells.build_cells(store, work_dir(spark, "cells"))
    return _round6(index.search(queries, Q.DEFAULT_K, index.probes_for(queries, Q.DEFAULT_K)))


KNN_WHERE = {"$or": [{"label": {"$in": [1, 2]}}, {"label": {"$gte": 7}}]}


def knn_filtered(spark, sf):
    return _round6(Q.knn(_vectors(spark, sf), _queries(spark, sf), k=Q.DEFAULT_K, where=KNN_WHERE))


def _doc_store(spark, sf):
    arts = _doc_articles(spark, sf)
    vecs = _t(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    return arts.join(vecs, "doc_id").select("id", "doc_id", "title", F.col("content").alias("document"), "embedding",
                                            X.token_count(F.col("content")).alias("n_tokens"))


def _hydrated(spark, sf, k):
    return Q.knn_hydrated(_doc_store(spark, sf), _queries(spark, sf), ["title", "document", "n_tokens"], k=k)


def knn_hydrated(spark, sf):
    return _round6(_hydrated(spark, sf, Q.DEFAULT_K).select("qid", "rank", "id", "title", "distance"))


def retrieval_report(spark, sf):
    return Q.report(_hydrated(spark, sf, Q.QUESTION_K))


def _questions(spark, sf):
    conv = _t(spark, sf, "conversations").where(F.col("role") == "user")
    vecs = _t(spark, sf, "embeddings").select(F.col("vec_id").alias("conv_id"), "embedding")
    q = conv.select("conv_id", "turn", F.col("text").alias("question")).join(vecs, "conv_id")
    return Q.clean_questions(q).select(Q.question_id(), "question", "embedding")


def batch_questions(spark, sf):
    qs = _questions(spark, sf)
    hits = Q.knn(_vectors(spark, sf), qs, k=Q.QUESTION_K)
    return _round6(hits.join(qs.select("qid", "question"), "qid").select("qid", "question", "rank", "id", "distance"))


def context_pack(spark, sf):
    return Q.context_pack(_hydrated(spark, sf, Q.DEFAULT_K), PACK_BUDGET, tokens_col="n_tokens")


# ---------------------------------------------------------------- A6-A14: store
def _articles(spark, sf, version: str = "a"):
    arts = _doc_articles(spark, sf)
    if version == "b":
        # a re-scrape whose text gained a sentence
        arts = arts.withColumn("content", F.concat(F.col("content"), F.lit(" Updated.")))
    return arts


def article_metadata(spark, sf):
    return S.metadata(store_records(_articles(spark, sf), max_tokens=STORE_TEST_MAX_TOKENS))


def _written(spark, articles: DataFrame) -> ChunkStore:
    """A new store on the shared folder that holds the articles' records."""
    store = open_store(spark, work_dir(spark, "store"))
    store.append_articles(articles, STORE_TEST_MAX_TOKENS)
    return store


def store_append(spark, sf):
    store = _written(spark, _articles(spark, sf, "a").where(F.col("lang") == "en"))
    store.append_articles(_articles(spark, sf, "b"), STORE_TEST_MAX_TOKENS)
    return store.df().select("id", "article_id", "chunk_index", "document")


def store_outcome(spark, sf):
    docs = D.doc_fields(_t(spark, sf, "documents"))
    arts = P.assemble(docs.withColumn("_sa", D.scraped_at(F.col("doc_id"))), F.col("_sa"))
    return open_store(spark, work_dir(spark, "store")).store_articles(arts, STORE_TEST_MAX_TOKENS)


def _requested_ids(spark, sf):
    arts = _doc_articles(spark, sf)
    return arts.select("id").unionByName(arts.select(F.concat(F.col("id"), F.lit("_chunk_0")).alias("id")))


def store_get(spark, sf):
    return _written(spark, _articles(spark, sf)).get(_doc_articles(spark, sf).select("id")).select("id", "document")


def store_exists(spark, sf):
    return _written(spark, _articles(spark, sf)).exists(_requested_ids(spark, sf))


def store_list(spark, sf):
    return _written(spark, _articles(spark, sf)).list(columns=["id", "title"])


def store_delete(spark, sf):
    store = _written(spark, _articles(spark, sf))
    arts = _doc_articles(spark, sf)
    store.delete(arts.where(F.col("lang") == "de").select(F.col("id").alias("article_id")), by="article_id")
    store.vacuum()   # the store is the query's own
    store.delete(arts.select(F.concat(F.col("id"), F.lit("_chunk_1")).alias("id")))
    return store.df().select("id", "article_id")


def store_count(spark, sf):
    return _written(spark, _articles(spark, sf)).count()


def store_reset(spark, sf):
    store = _written(spark, _articles(spark, sf))
    before = store.count().select(F.col("records").alias("before"), F.lit(None).cast("bigint").alias("after"))
    store.reset()
    after = store.count().select(F.lit(None).cast("bigint").alias("before"), F.col("records").alias("after"))
    return before.unionByName(after).agg(F.max("before").alias("before"), F.max("after").alias("after"))


# ---------------------------------------------------------------- G: streaming
def stream_ingest(spark, sf):
    from folio.streaming.ingest import run_ingest_from_table
    return run_ingest_from_table(spark, sf, max_tokens=STORE_TEST_MAX_TOKENS)


def stream_questions(spark, sf):
    from folio.streaming.questions import run_questions_from_table
    return run_questions_from_table(spark, sf, k=Q.QUESTION_K)


def stream_enrich(spark, sf):
    from folio.streaming.replies import run_replies
    root = work_dir(spark, "stream-enrich")
    store = _written(spark, _articles(spark, sf))
    requests = E.prompt_requests(_routed(spark, sf)).select("request_id", "part", "parts", "route")
    replies = _request_responses(spark, sf, requests, "doc_id")
    run_replies(store, D.request_files(requests, f"{root}/requests"), D.reply_files(replies, f"{root}/replies"), f"{root}/run", vacuum=True)
    return store.df().where("chunk_index = 0").select(F.col("article_id").alias("request_id"), "summary", _bar(F.col("topics")).alias("topics"))


QUERIES: dict[str, Query] = {
    "url_list_scan": url_list_scan,
    "url_valid": url_valid,
    "url_normalize": url_normalize,
    "url_dedup": url_dedup,
    "url_domain": url_domain,
    "page_fields": page_fields,
    "drop_incomplete": drop_incomplete,
    "articles": articles,
    "ingest_outcome": ingest_outcome,
    "ingest_order": ingest_order,
    "page_links": page_links,
    "page_links_abs": page_links_abs,
    "page_links_same_domain": page_links_same_domain,
    "article_links": article_links,
    "clean_text": clean_text,
    "truncate_text": truncate_text,
    "keywords": keywords_q,
    "word_count": word_count,
    "token_count": token_count,
    "email_audit": email_audit,
    "export_key": export_key,
    "export_write": export_write,
    "batch_assign": batch_assign,
    "size_report": size_report,
    "duration_report": duration_report,
    "storage_gate": storage_gate,
    "sentence_chunks": sentence_chunks,
    "chunk_records": chunk_records,
    "paragraph_chunks": paragraph_chunks,
    "context_limit": context_limit_q,
    "analysis_route": analysis_route_q,
    "prompt_requests": prompt_requests,
    "parse_single": parse_single,
    "parse_part": parse_part,
    "merge_summaries": merge_summaries,
    "merge_topics": merge_topics,
    "enrich_articles": enrich_articles,
    "knn_topk": knn_topk,
    "knn_filtered": knn_filtered,
    "knn_approx": knn_approx,
    "knn_hydrated": knn_hydrated,
    "retrieval_report": retrieval_report,
    "batch_questions": batch_questions,
    "context_pack": context_pack,
    "article_metadata": article_metadata,
    "store_append": store_append,
    "store_outcome": store_outcome,
    "store_get": store_get,
    "store_exists": store_exists,
    "store_list": store_list,
    "store_delete": store_delete,
    "store_count": store_count,
    "store_reset": store_reset,
    "stream_ingest": stream_ingest,
    "stream_questions": stream_questions,
    "stream_enrich": stream_enrich,
}
