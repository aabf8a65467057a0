"""Set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recprep.functions.arrays import list_difference


def unique(df: DataFrame, *cols: str) -> DataFrame:
    """G1: distinct rows over ``cols``."""
    return df.select(*cols).distinct() if cols else df.distinct()


def array_difference(df: DataFrame, a: str, b: str, out: str = "difference") -> DataFrame:
    """Row-wise set difference of two array columns (draw order kept)."""
    return df.withColumn(out, list_difference(a, b))


def repeat_epochs(df: DataFrame, n: int, name: str = "epoch") -> DataFrame:
    """The data set repeated ``n`` times, tagged 1..n (finite only)."""
    if n < 1:
        raise ValueError("n must be >= 1")
    return df.withColumn(name, F.explode(F.sequence(F.lit(1), F.lit(n))))  # narrow: keeps input splits
