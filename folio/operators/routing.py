"""Model context limits and analysis routing.

The exact-name table is a literal map evaluated inside the projection (no
join at all); the name rules are an ordered ``CASE`` on the lower-cased name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.text import token_count
from folio.operators.chunking import ANALYSIS_RESERVE, TokenFn, add_paragraph_chunks

# --- fixed values -----------------------------------------------------------
# Known context sizes by exact model name.
MODEL_LIMITS = {
    "gpt-5-nano": 400_000,
    "gpt-3.5-turbo": 16_385,
    "gpt-3.5-turbo-16k": 16_385,
    "gpt-3.5-turbo-1106": 16_385,
    "gpt-3.5-turbo-0125": 16_385,
    "gpt-4": 8192,
    "gpt-4-0314": 8192,
    "gpt-4-0613": 8192,
    "gpt-4-turbo": 128_000,
    "gpt-4-turbo-preview": 128_000,
    "gpt-4-1106-preview": 128_000,
    "gpt-4-0125-preview": 128_000,
    "gpt-4-turbo-2024-04-09": 128_000,
    "gpt-4o": 128_000,
    "gpt-4o-2024-05-13": 128_000,
    "gpt-4o-2024-08-06": 128_000,
    "gpt-4o-mini": 128_000,
    "gpt-4o-mini-2024-07-18": 128_000,
    "text-davinci-003": 4097,
    "text-davinci-002": 4097,
    "code-davinci-002": 8001,
}
# Ordered substring rules on the lower-cased name, then the fallback.
MODEL_RULES = (
    (("gpt-4o",), 128000),
    (("gpt-4-turbo", "gpt-4-1106", "gpt-4-0125"), 128000),
    (("gpt-4",), 8192),
    (("gpt-3.5-turbo",), 16385),
)
DAVINCI_CODE, DAVINCI_TEXT, DEFAULT_LIMIT = 8001, 4097, 4096
# ---------------------------------------------------------------------------


def context_limit(model: Column) -> Column:
    """Exact name first (case-sensitive), then the ordered rules, else 4096."""
    table = F.create_map(*[x for k, v in MODEL_LIMITS.items() for x in (F.lit(k), F.lit(v))])
    low = F.lower(model)
    rule = None
    for needles, limit in MODEL_RULES:
        cond = None
        for n in needles:
            c = low.contains(n)
            cond = c if cond is None else cond | c
        rule = F.when(cond, F.lit(limit)) if rule is None else rule.when(cond, F.lit(limit))
    rule = (
        rule.when(low.contains("davinci") & low.contains("code"), F.lit(DAVINCI_CODE))
        .when(low.contains("davinci"), F.lit(DAVINCI_TEXT))
        .otherwise(F.lit(DEFAULT_LIMIT))
    )
    return F.coalesce(F.try_element_at(table, model), rule).cast("int")


def analysis_route(articles: DataFrame, model: Column, content: str = "content",
                   tokens: TokenFn = token_count, reserve: int = ANALYSIS_RESERVE) -> DataFrame:
    """D7 (+D5 for long texts): ``single`` when tokens <= limit - reserve, else ``parts``.

    ``parts`` holds the paragraph chunks (computed with the model limit as
    budget) for long texts and is NULL for single requests.
    """
    routed = articles.withColumn("model", model).withColumn("context_limit", context_limit(F.col("model")))
    routed = routed.withColumn("n_tokens", tokens(F.col(content)))
    routed = routed.withColumn(
        "route",
        F.when(F.col("n_tokens") <= F.col("context_limit") - F.lit(reserve), F.lit("single")).otherwise(F.lit("parts")),
    )
    return add_paragraph_chunks(routed, content, F.col("context_limit"), "parts", tokens, reserve,
                                only=F.col("route") == "parts")
