"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed(df: DataFrame, **cols: Column) -> DataFrame:
    """Add expensive columns that are evaluated exactly once per row.

    The optimizer may copy a projected expression into every place that uses
    it (filters pushed below the projection, nested-field aliases).  A
    generator is a barrier to both, so the values are produced by ``inline``
    over a one-element array of one struct.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))
