"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recprep.operators.joins import maybe_broadcast

# The ranking example layout written by the reference.
RANKING_COLUMNS = [
    "user_id", "item_id", "language", "is_ebook", "format", "publisher",
    "pub_decade", "avg_rating", "num_pages", "is_read", "is_reviewed", "label",
]
FEATURE_COLUMNS = RANKING_COLUMNS[:9]
POSITIVE_RATING = 4


def filter_by_activity(df: DataFrame, key: str = "user_id", lo: int | None = 10,
                       hi: int | None = 250, broadcast_rows: int | None = None) -> DataFrame:
    """B1: keep keys with ``lo..hi`` rows (inclusive; either bound optional).

    Counted with a group-by (map-side partial counts, so a key holding a
    third of the rows costs one small partial per task). The kept keys are
    written once (one row per key) and semi-joined back, so the input is
    read twice: once to count, once to filter. When their number is under the broadcast bound
    (counted, not assumed) the semi join is a map-side broadcast filter: a
    hot key above ``hi`` is dropped where it is read and never reaches a
    shuffle, rows with a null key count as one group, and every later per-key shuffle sees groups of at most ``hi``
    rows. Above the bound it is a shuffle semi join (AQE splits skewed
    partitions where the plan allows).
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_act_n"))
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col("_act_n") >= lo)
    if hi is not None:
        cond = cond & (F.col("_act_n") <= hi)
    # written once by the size check; the join then reads that small table
    # instead of counting the input again
    kept = counts.where(cond).select(F.col(key).alias("_act_key"))
    return df.join(maybe_broadcast(kept, max_rows=broadcast_rows),
                   F.col(key).eqNullSafe(F.col("_act_key")), "left_semi")


def binarize(df: DataFrame, col: str = "rating", threshold: int = POSITIVE_RATING,
             out: str = "label", drop_source: bool = True) -> DataFrame:
    """B2: ``col >= threshold`` -> 1, else (also null) 0, as tinyint."""
    res = df.withColumn(out, F.when(F.col(col) >= threshold, 1).otherwise(0).cast("tinyint"))
    return res.drop(col) if drop_source and col != out else res


def select_output(df: DataFrame, item_key: str = "book_id",
                  columns=tuple(RANKING_COLUMNS)) -> DataFrame:
    """Rename the item key and fix the column list and order."""
    return df.withColumnRenamed(item_key, "item_id").select(*columns)


def drop_null_rows(df: DataFrame, subset=None) -> DataFrame:
    """Drop rows with any null."""
    return df.dropna(how="any", subset=subset)


def take_rows(df: DataFrame, ids: DataFrame, index_col: str = "row_idx") -> DataFrame:
    """Gather rows whose index is in the one-column ``ids`` frame
    (both sides distributed; never a driver list)."""
    return df.join(ids.select(F.col(ids.columns[0]).alias(index_col)).distinct(),
                   index_col, "left_semi")


def slice_rows(df: DataFrame, offset: int, n: int, index_col: str = "row_idx") -> DataFrame:
    """Contiguous index range ``[offset, offset + n)``."""
    return df.where((F.col(index_col) >= offset) & (F.col(index_col) < offset + n))


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    """B12."""
    return df.drop(*cols)


def with_constants(df: DataFrame, **typed) -> DataFrame:
    """Typed literal columns, ``name=(value, "type")``."""
    for name, (value, dtype) in typed.items():
        df = df.withColumn(name, F.lit(value).cast(dtype))
    return df
