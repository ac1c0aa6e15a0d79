"""C5 hook: token counts from a real tokenizer, as an Arrow-batched pandas UDF.

The default counter (:func:`folio.functions.text.token_count`) is a JVM-side
regular expression.  A function that counts the tokens of a text with another
tokenizer is wrapped here and applied to whole Arrow batches.

Note: Python UDFs cannot run inside higher-order functions, so the chunkers
use Column-expression counters only; this hook is for counting columns.
"""

from __future__ import annotations

from typing import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def pandas_token_counter(count: Callable[[str], int]) -> Callable[[Column], Column]:
    """Turn a ``str -> int`` function into a ``Column -> Column`` counter."""

    @F.pandas_udf(T.IntegerType())
    def _count(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else int(count(t))).astype("Int32")

    return lambda col: _count(col)
