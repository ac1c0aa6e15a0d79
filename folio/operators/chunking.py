"""Token-budgeted chunking (D1-D5) and greedy packing.

All chunkers are *narrow*: one input row (one text) becomes an array of
chunks through higher-order functions evaluated inside the row, so there is
no shuffle and no Python.  Each text is first turned into an array of units
``struct(text, tok, ...)`` (tokens counted once per unit), then a single
``aggregate`` fold walks the units and records only the unit index at which
each chunk starts.  Chunk texts are cut from the unit array afterwards with
``slice`` + ``array_join``, so the fold never copies growing strings.

A skewed corpus (a few 20,000-word texts) costs more per row but cannot
overload a task beyond the size of its largest row; repartition by the text
key (never by language or source) if rows are unevenly spread over files.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.text import py_split_words, py_strip, token_count

TokenFn = Callable[[Column], Column]

# --- fixed values -----------------------------------------------------------
STORE_MAX_TOKENS = 8000        # record budget of the chunk store
TITLE_MARGIN = 10              # kept free next to the title on the long path
TITLE_SEP = "\n\n"             # between title and text of a document
ANALYSIS_MAX_TOKENS = 3000     # default budget of the paragraph chunker
ANALYSIS_RESERVE = 1000        # kept free for prompt and reply
# ---------------------------------------------------------------------------

def _as_col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    Higher-order functions re-evaluate any outer expression they mention for
    every element, and the optimizer may inline helper columns back into
    them; binding through a one-element ``transform`` pins a single
    evaluation per row.
    """
    return F.transform(F.array(value), body)[0]


def sentence_units(text: Column, budget, tokens: TokenFn = token_count) -> Column:
    """Units of the sentence chunker.

    Sentences are the pieces between ``". "`` (newlines read as spaces),
    stripped, empty ones skipped, a period added unless present.  A sentence
    of more than ``budget`` tokens is replaced by its words, tagged with the
    sentence number (``grp`` > 0) so the fold keeps them apart.
    """
    budget = _as_col(budget)
    sents = F.split(F.replace(text, F.lit("\n"), F.lit(" ")), r"\. ")
    sents = F.filter(F.transform(sents, py_strip), lambda s: s != "")
    sents = F.transform(sents, lambda s: F.when(s.endswith("."), s).otherwise(F.concat(s, F.lit("."))))
    counted = F.transform(sents, lambda s: F.struct(s.alias("text"), tokens(s).alias("tok")))
    nested = F.transform(
        counted,
        lambda x, i: F.when(
            x["tok"] > budget,
            F.transform(
                py_split_words(x["text"]),
                lambda w: F.struct(w.alias("text"), tokens(w).alias("tok"), (i + 1).alias("grp")),
            ),
        ).otherwise(F.array(F.struct(x["text"].alias("text"), x["tok"].alias("tok"), F.lit(0).alias("grp")))),
    )
    return F.flatten(nested)


def _starts(units: Column, new_chunk: Callable[[Column, Column], Column]) -> Column:
    """Fold over units; returns the 0-based unit indexes where chunks start."""
    init = F.struct(
        F.array().cast("array<int>").alias("starts"),
        F.lit(0).alias("total"),
        F.lit(0).alias("grp"),
        F.lit(False).alias("nonempty"),
        F.lit(0).alias("i"),
    )

    def step(acc: Column, u: Column) -> Column:
        new = (acc["i"] == 0) | new_chunk(acc, u)
        return F.struct(
            F.when(new, F.concat(acc["starts"], F.array(acc["i"]))).otherwise(acc["starts"]).alias("starts"),
            F.when(new, u["tok"]).otherwise(acc["total"] + u["tok"] + u["cost"] * acc["nonempty"].cast("int")).alias("total"),
            u["grp"].alias("grp"),
            F.when(new, u["text"] != "").otherwise(acc["nonempty"] | (u["text"] != "")).alias("nonempty"),
            (acc["i"] + 1).alias("i"),
        )

    return F.aggregate(units, init, step, lambda acc: acc["starts"])


def _cut(units: Column, starts: Column, render: Callable[[Column], Column]) -> Column:
    """Chunk texts from unit slices ``[start_j, start_{j+1})``."""
    n = F.size(units)
    ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(1))), F.array(n))
    ends = F.when(F.size(starts) > 1, ends).otherwise(F.array(n))
    return F.zip_with(starts, ends, lambda s, e: render(F.slice(units, s + 1, e - s)))


def _with_cost(units: Column, cost: Column | None = None) -> Column:
    return F.transform(
        units,
        lambda u: F.struct(
            u["text"].alias("text"), u["tok"].alias("tok"), u["grp"].alias("grp"),
            (cost if cost is not None else F.lit(0)).alias("cost"),
        ),
    )


def sentence_chunks(text: Column, budget, tokens: TokenFn = token_count) -> Column:
    """D2 + D3: greedy sentence packing with word fallback; an array of chunk texts.

    A new chunk starts when the unit group changes (entering or leaving an
    over-long sentence, whose word tail is never merged with what follows) or
    when the running token sum would pass ``budget``.  Text with no sentence at
    all gives one chunk of its first ``budget`` characters.
    """
    def with_budget(b: Column) -> Column:
        def with_units(u: Column) -> Column:
            starts = _starts(u, lambda acc, x: (x["grp"] != acc["grp"]) | (acc["total"] + x["tok"] > b))
            chunks = let(starts, lambda st: _cut(u, st, lambda sl: F.array_join(F.transform(sl, lambda x: x["text"]), " ")))
            return F.when(F.size(u) > 0, chunks).otherwise(F.array(text.substr(F.lit(1), b)))
        return let(_with_cost(sentence_units(text, b, tokens)), with_units)
    return let(_as_col(budget).cast("int"), with_budget)


def pack(units: Column, budget, sep: str = "\n\n") -> Column:
    """greedy packing of counted pieces ``struct(text, tok)`` in order."""
    b = _as_col(budget)

    def with_units(u: Column) -> Column:
        starts = _starts(u, lambda acc, x: acc["total"] + x["tok"] > b)
        return let(starts, lambda st: _cut(u, st, lambda sl: F.struct(
            F.array_join(F.transform(sl, lambda x: x["text"]), sep).alias("text"),
            F.aggregate(sl, F.lit(0), lambda a, x: a + x["tok"]).alias("tok"),
            F.size(sl).alias("n"),
        )))

    return let(F.transform(units, lambda x: F.struct(
        x["text"].alias("text"), x["tok"].alias("tok"), F.lit(0).alias("grp"), F.lit(0).alias("cost"))), with_units)


def paragraph_units(content: Column, limit, tokens: TokenFn = token_count) -> Column:
    """Units of the paragraph chunker: paragraphs, or sentences of a long one.

    ``grp``: 0 paragraph, 1 first sentence of an over-long paragraph, 2 a later
    sentence.  ``sep`` is what joins the unit to a non-empty chunk before it;
    ``cost`` the tokens that separator adds (``". "`` adds the period).
    """
    limit = _as_col(limit)
    paras = F.transform(F.split(content, "\n\n"), lambda p: F.struct(p.alias("text"), tokens(p).alias("tok")))
    nested = F.transform(
        paras,
        lambda p: F.when(
            p["tok"] > limit,
            F.transform(
                F.split(p["text"], r"\. "),
                lambda s, j: F.struct(
                    s.alias("text"), tokens(s).alias("tok"),
                    F.when(j == 0, F.lit(1)).otherwise(F.lit(2)).alias("grp"),
                    F.lit(1).alias("cost"), F.lit(". ").alias("sep"),
                ),
            ),
        ).otherwise(F.array(F.struct(
            p["text"].alias("text"), p["tok"].alias("tok"), F.lit(0).alias("grp"),
            F.lit(0).alias("cost"), F.lit("\n\n").alias("sep"),
        ))),
    )
    return F.flatten(nested)


def paragraph_chunks(content: Column, max_tokens=ANALYSIS_MAX_TOKENS, tokens: TokenFn = token_count,
                     reserve: int = ANALYSIS_RESERVE) -> Column:
    """Pack paragraphs on blank lines; an over-long paragraph packs on ``". "``.

    Effective limit is ``max_tokens - reserve``.  A long paragraph first closes
    the pending chunk; its sentences pack among themselves (separator ``". "``
    kept inside a chunk, lost at a cut, no period added); the last piece stays
    open for the next paragraphs.  A single sentence over the limit is emitted
    as it is.  Empty chunks are not emitted, so an empty text gives none, and
    a paragraph whose pieces were all emitted is not emitted again.
    """
    def render(sl: Column) -> Column:
        def body(flags: Column) -> Column:
            first = F.array_position(flags, True)  # 1-based, 0 when none
            pieces = F.transform(
                sl,
                lambda x, j: F.concat(F.when((first > 0) & (j + 1 > first), x["sep"]).otherwise(F.lit("")), x["text"]),
            )
            return F.array_join(pieces, "")
        return let(F.transform(sl, lambda x: x["text"] != ""), body)

    def with_limit(limit: Column) -> Column:
        def new_chunk(acc: Column, x: Column) -> Column:
            with_sep = acc["total"] + x["tok"] + x["cost"] * acc["nonempty"].cast("int")
            return (x["grp"] == 1) | (with_sep > limit)

        def with_units(u: Column) -> Column:
            return let(_starts(u, new_chunk), lambda st: F.filter(_cut(u, st, render), lambda c: c != ""))

        return let(paragraph_units(content, limit, tokens), with_units)

    return let((_as_col(max_tokens) - F.lit(reserve)).cast("int"), with_limit)


def add_paragraph_chunks(df: DataFrame, content: str, max_tokens=ANALYSIS_MAX_TOKENS, out: str = "chunks",
                         tokens: TokenFn = token_count, reserve: int = ANALYSIS_RESERVE,
                         only: Column | None = None) -> DataFrame:
    """DataFrame form of :func:`paragraph_chunks`; rows where ``only`` is false get NULL."""
    col = paragraph_chunks(F.col(content), max_tokens, tokens, reserve)
    return df.withColumn(out, col if only is None else F.when(only, col))


def _cut_article(max_tokens: int, tokens: TokenFn) -> Column:
    """``struct(whole, texts)`` of an article: its content, or the chunks of a content that is too long."""
    title, content = F.col("title"), F.col("content")

    def with_title_tokens(tt: Column) -> Column:
        # the default counter is additive over the blank-line join: no second pass
        full_tokens = (tt + tokens(content)) if tokens is token_count else tokens(F.concat(title, F.lit(TITLE_SEP), content))
        budget = F.lit(max_tokens) - tt - F.lit(TITLE_MARGIN)
        return F.when(full_tokens <= max_tokens, F.struct(F.lit(True).alias("whole"), F.array(content).alias("texts"))) \
            .otherwise(F.struct(F.lit(False).alias("whole"), sentence_chunks(content, budget, tokens).alias("texts")))

    return let(tokens(title), with_title_tokens)


def chunk_id(article_id: Column, chunk_index: Column) -> Column:
    """The record id of a chunk."""
    return F.concat(article_id, F.lit("_chunk_"), chunk_index.cast("string"))


def titled(text: Column) -> Column:
    """The document of a record: title, blank line, text."""
    return F.concat(F.col("title"), F.lit(TITLE_SEP), text)


def store_records(articles: DataFrame, max_tokens: int = STORE_MAX_TOKENS, tokens: TokenFn = token_count,
                  id_col: str = "id") -> DataFrame:
    """D1 + D4: one store record per article, or one per chunk when it is too long.

    ``title + blank line + content`` of at most ``max_tokens`` tokens is stored
    whole under the article id.  Otherwise the content alone is chunked with
    budget ``max_tokens - tokens(title) - 10`` and every chunk is stored as
    ``title + blank line + chunk`` under ``<id>_chunk_<i>``.  Adds
    ``article_id``, ``chunk_index``, ``total_chunks`` and ``document``.
    """
    def records(p: Column) -> Column:
        return F.transform(p["texts"], lambda c, i: F.struct(
            i.alias("chunk_index"), F.size(p["texts"]).alias("total_chunks"), c.alias("_text"), p["whole"].alias("_whole"),
        ))

    # inline is a generator, so the fold runs once per article whatever the later projections need;
    # the title is put before each text after it, so no row holds all copies of its title
    return (
        articles.select("*", F.inline(let(_cut_article(max_tokens, tokens), records)))
        .withColumn("document", titled(F.col("_text")))
        .withColumn("article_id", F.col(id_col))
        .withColumn(id_col, F.when(F.col("_whole"), F.col(id_col)).otherwise(chunk_id(F.col(id_col), F.col("chunk_index"))))
        .drop("_whole", "_text")
    )


def packed_records(articles: DataFrame, max_tokens: int = STORE_MAX_TOKENS, tokens: TokenFn = token_count,
                   id_col: str = "id") -> DataFrame:
    """The records of :func:`store_records`, the chunks of an article in one row.

    ``_parts`` holds ``(i, text)`` of each chunk in the order of the record ids, and is
    null for an article that is whole; what differs between chunks (id, chunk_index,
    document) is null where ``_parts`` is not.  So a title is there once, not once a chunk.
    """
    def row(p: Column) -> Column:
        # ids of one article differ in the digits at their end
        parts = F.array_sort(F.transform(p["texts"], lambda c, i: F.struct(i.cast("string").alias("k"), i.alias("i"), c.alias("text"))))
        return F.struct(
            F.when(p["whole"], F.element_at(p["texts"], 1)).alias("_text"), F.size(p["texts"]).alias("total_chunks"),
            F.when(~p["whole"], F.transform(parts, lambda x: F.struct(x["i"].alias("i"), x["text"].alias("text")))).alias("_parts"),
        )

    whole = F.col("_parts").isNull()
    return (
        articles.select("*", F.inline(F.array(let(_cut_article(max_tokens, tokens), row))))
        .where(F.col("total_chunks") > 0)
        .withColumn("chunk_index", F.when(whole, F.lit(0)))
        .withColumn("document", F.when(whole, titled(F.col("_text"))))
        .withColumn("article_id", F.col(id_col))
        .withColumn(id_col, F.when(whole, F.col(id_col)))
        .drop("_text")
    )


def unpacked(rows: DataFrame) -> DataFrame:
    """One row per record of rows some of which are packed (see :func:`packed_records`)."""
    many = F.col("_p").isNotNull()
    kinds = {f.name: f.dataType for f in rows.schema}
    made = {"id": chunk_id(F.col("article_id"), F.col("_p.i")), "chunk_index": F.col("_p.i"), "document": titled(F.col("_p.text"))}
    names = [c for c in rows.columns if c != "_parts"]
    out = rows.select(*names, F.explode_outer("_parts").alias("_p"))
    return out.select(*[F.when(many, made[c]).otherwise(F.col(c)).cast(kinds[c]).alias(c) if c in made else F.col(c) for c in names])
