"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default: the headline set below, "all" for every query).
Each query runs to completion into Spark's ``noop`` sink (nothing is
collected to the driver); the time is wall-clock seconds of that action.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from folio.plans.catalog import QUERIES  # noqa: E402
from folio.session import local_session  # noqa: E402

HEADLINE = [
    "articles", "page_links_abs", "article_links", "url_normalize", "clean_text", "keywords",
    "email_audit", "batch_assign", "size_report", "duration_report",
    "sentence_chunks", "chunk_records", "paragraph_chunks", "analysis_route", "enrich_articles",
    "knn_topk", "knn_hydrated", "context_pack", "store_append", "store_delete", "stream_ingest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "")
    if names == "all":
        selected = list(QUERIES)
    elif names:
        selected = [n for n in names.split(",") if n in QUERIES]
    else:
        selected = HEADLINE
    spark = local_session(cpus=cpus, shuffle_partitions=max(8, int(cpus) * 2), app="folio-bench")
    # warm the JVM and the Python workers once, outside the timings
    QUERIES["word_count"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.range(8).mapInPandas(lambda it: it, "id long").write.format("noop").mode("overwrite").save()
    timings: dict[str, float] = {}
    for name in selected:
        t0 = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
