"""Text column functions (C1, C2, C4-C7, C9, C10 and the shared helpers).

Every function takes and returns a :class:`~pyspark.sql.Column` and compiles to
built-in expressions, so it stays inside whole-stage codegen.  Regular
expressions are written so that Java's engine (Spark) and RE2 (the DuckDB
oracle) read them the same way: no ``\\s`` / ``\\b`` shorthands whose meaning
differs between engines, explicit character classes instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Characters that Python's str.split()/str.strip() treat as whitespace, written
# as a character-class body valid in both Java regex and RE2.
WS = r"\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}"
# Default token estimate: runs of letters/digits/underscore, plus every other
# non-space character on its own.
TOKEN_PATTERN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_" + WS + r"]"
# Stop words of the keyword extractor, in the order the reference lists them.
STOP_WORDS = (
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with", "by",
    "from", "as", "is", "was", "are", "were", "be", "been", "have", "has", "had", "do", "does",
    "did", "will", "would", "could", "should", "may", "might", "must", "can", "this", "that",
    "these", "those", "i", "you", "he", "she", "it", "we", "they", "me", "him", "her", "us",
    "them", "my", "your", "his", "our", "their",
)
# E-mail shape accepted by the validator.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
# Characters replaced by '_' in file keys.
FILE_KEY_INVALID = r'[<>:"/\\|?*]'
FILE_KEY_DEFAULT = "untitled"
SIZE_UNITS = ("B", "KB", "MB", "GB", "TB", "PB")
# ---------------------------------------------------------------------------


def lit_re(pattern: str) -> Column:
    return F.lit(pattern)


def py_strip(col: Column) -> Column:
    """``str.strip()``: remove Unicode whitespace at both ends."""
    return F.regexp_replace(col, rf"\A[{WS}]+|[{WS}]+\z", "")


def py_split_words(col: Column) -> Column:
    """``str.split()`` with no argument: whitespace-separated words, no empties."""
    return F.regexp_extract_all(col, lit_re(rf"[^{WS}]+"), 0)


def word_count(col: Column) -> Column:
    """C4: number of whitespace-separated words (``len(text.split())``)."""
    return F.coalesce(F.regexp_count(col, lit_re(rf"[^{WS}]+")), F.lit(0)).cast("int")


def token_count(col: Column) -> Column:
    """C5 default estimate: matches of :data:`TOKEN_PATTERN`.

    Additive over whitespace joins, which the chunkers rely on.  A different
    counter can be passed to the chunkers as any ``Column -> Column`` function
    (for example a pandas UDF wrapping a real tokenizer, see
    :func:`folio.functions.tokens.pandas_token_counter`).
    """
    return F.coalesce(F.regexp_count(col, lit_re(TOKEN_PATTERN)), F.lit(0)).cast("int")


def clean_text(col: Column) -> Column:
    """Collapse whitespace, drop ``[..]`` and ``(..)``, straighten quotes/dashes."""
    t = F.regexp_replace(col, rf"[{WS}]+", " ")
    t = F.regexp_replace(t, r"\[.*?\]", "")
    t = F.regexp_replace(t, r"\(.*?\)", "")
    t = F.replace(t, F.lit("\u00a0"), F.lit(" "))
    t = F.translate(t, "\u2019\u201c\u201d\u2013", "'\"\"-")
    t = F.replace(t, F.lit("\u2014"), F.lit("--"))
    return F.when(col.isNull(), F.lit("")).otherwise(py_strip(t))


def truncate_text(col: Column, max_length: int = 100, suffix: str = "...") -> Column:
    """Cut at ``max_length - len(suffix)``, back off to a late space, add suffix."""
    head = F.substring(col, 1, max_length - len(suffix))
    # 0-based index of the last space in head, -1 when none
    last_space = F.when(F.instr(head, " ") > 0, F.length(F.regexp_replace(head, r" [^ ]*\z", ""))).otherwise(-1)
    cut = F.when(last_space > F.lit(max_length * 0.7), F.substring(head, 1, last_space)).otherwise(head)
    return F.when(F.length(col) <= max_length, col).otherwise(F.concat(cut, F.lit(suffix)))


def is_email(col: Column) -> Column:
    """Full match of the e-mail shape."""
    return col.rlike(EMAIL_PATTERN)


def file_key(col: Column) -> Column:
    """Safe file / partition key: invalid characters to '_', trim '. ', default."""
    s = F.regexp_replace(col, FILE_KEY_INVALID, "_")
    s = F.regexp_replace(s, r"\A[. ]+|[. ]+\z", "")
    return F.coalesce(F.nullif(s, F.lit("")), F.lit(FILE_KEY_DEFAULT))


def fmt1(value: Column) -> Column:
    """One-decimal rendering that rounds the exact binary value (like ``'%.1f'``)."""
    return F.replace(F.format_number(value, 1), F.lit(","), F.lit(""))


def human_size(num_bytes: Column) -> Column:
    """Bytes as ``<x.y><unit>`` with binary steps, up to PB."""
    b = num_bytes.cast("double")
    expr = None
    for i, unit in enumerate(SIZE_UNITS[:-1]):
        scaled = b / F.lit(1024.0 ** i)
        cond = scaled < F.lit(1024.0)
        val = F.concat(fmt1(scaled), F.lit(unit))
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    last = F.concat(fmt1(b / F.lit(1024.0 ** (len(SIZE_UNITS) - 1))), F.lit(SIZE_UNITS[-1]))
    return expr.otherwise(last)


def human_duration(seconds: Column) -> Column:
    """Seconds as ``x.ys`` under a minute, ``x.ym`` under an hour, else ``x.yh``."""
    s = seconds.cast("double")
    return (
        F.when(s < 60, F.concat(fmt1(s), F.lit("s")))
        .when(s < 3600, F.concat(fmt1(s / F.lit(60.0)), F.lit("m")))
        .otherwise(F.concat(fmt1(s / F.lit(3600.0)), F.lit("h")))
    )


def first_line(col: Column) -> Column:
    """Text up to the first newline (the whole text when it has none)."""
    return F.substring_index(col, "\n", 1)
