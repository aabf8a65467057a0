"""Window functions and per-user splits."""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recprep.operators.indexing import rank_within, running_sum
from recprep.operators.joins import maybe_broadcast

TRAIN, EVAL, TEST = "train", "eval", "test"


def count_over(*keys) -> Column:
    """E1 as a column: group size on every row (nulls counted, as
    ``count(1)``). A group is held by one task; use it for bounded groups and
    ``with_group_size`` otherwise."""
    return F.count(F.lit(1)).over(Window.partitionBy(*keys))


def with_group_size(df: DataFrame, keys, name: str = "n") -> DataFrame:
    """Group size on every row, for groups of any size. Sizes come from a
    partial aggregate and are joined back (nulls are one group), so a hot key's
    rows stay where they are, or are split by AQE if there are too many keys to
    broadcast."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_gs_n"))
    sizes = maybe_broadcast(sizes.select(*[F.col(c).alias(f"_gs_k{i}") for i, c in enumerate(keys)], "_gs_n"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_gs_k{i}")) for i, c in enumerate(keys)])
    out = [F.col(c) for c in df.columns if c != name]
    return df.join(sizes, same).select(*out, F.col("_gs_n").alias(name))


def sort_within(df: DataFrame, key: str, col: str, pos: str = "pos",
                positional: bool = False, input_order: str | None = None,
                method: str = "auto") -> DataFrame:
    """Order ``col`` inside each ``key``.

    Default keeps every row whole and adds its 0-based position. With
    ``positional=True`` only ``col`` is re-ordered and the j-th smallest value
    is attached to the row that was j-th in ``input_order`` -- the reference's
    behaviour when it sorts one column over a group (other columns keep their
    row slots). Rows with a null key are one group. ``method`` as in
    ``rank_within``: large groups are ranked by global range sorts, and slots
    and values meet by (key, position), which no hot key can skew.
    """
    if not positional:
        return rank_within(df, key, [col], pos=pos, size="_sw_n", method=method).drop("_sw_n")
    if input_order is None:
        raise ValueError("positional=True needs input_order (the rows' original order)")
    slots = rank_within(df, key, [input_order], pos=pos, size="_sw_n", method=method).drop("_sw_n", col)
    values = rank_within(df.select(key, col), key, [col], pos="_sw_pos", size="_sw_n", method=method).select(
        F.col(key).alias("_sw_key"), F.col(col), "_sw_pos")
    joined = slots.join(values, F.col(key).eqNullSafe(F.col("_sw_key")) & (F.col(pos) == F.col("_sw_pos")))
    return joined.select(key, pos, *[c for c in slots.columns if c not in (key, pos)], col)


def split_by_ratio(df: DataFrame, key: str, order, ratio: float = 0.8,
                   split_col: str = "split", method: str = "auto") -> DataFrame:
    """First ``ceil(n * ratio)`` rows of each key (in ``order``) are
    ``train``, the rest ``eval``; one pass tags both instead of two scans."""
    if not 0.0 <= ratio <= 1.0:
        raise ValueError("ratio must be in [0, 1]")
    r = rank_within(df, key, order, pos="_sp_pos", size="_sp_n", method=method)
    cut = F.ceil(F.col("_sp_n") * F.lit(float(ratio)))
    return (r.withColumn(split_col, F.when(F.col("_sp_pos") < cut, F.lit(TRAIN))
                                     .otherwise(F.lit(EVAL)))
             .drop("_sp_pos", "_sp_n"))


def split_leave_last(df: DataFrame, key: str, order, k: int = 2, role_col: str = "role",
                     pos: str = "pos", size: str = "n", method: str = "auto") -> DataFrame:
    """E4 (row form): all but the last ``k`` rows are ``train``; of the last
    two, the earlier is ``eval`` and the last is ``test``. Keeps ``pos`` and
    the group size ``n`` for the sequence operators."""
    if k != 2:
        raise ValueError("only the leave-last-two split is defined")
    r = rank_within(df, key, order, pos=pos, size=size, method=method)
    role = (F.when(F.col(pos) == F.col(size) - 1, F.lit(TEST))
             .when(F.col(pos) == F.col(size) - 2, F.lit(EVAL))
             .otherwise(F.lit(TRAIN)))
    return r.withColumn(role_col, role)


def flag_last(df: DataFrame, pos: str = "pos", size: str = "n", name: str = "is_last") -> DataFrame:
    """E5: flag the last element of each sequence from its position and size
    (replaces the reference's global cumulative-length indexing)."""
    return df.withColumn(name, F.col(pos) == F.col(size) - 1)


def running_offsets(df: DataFrame, len_col: str, order, partition_by=None,
                    name: str = "offset") -> DataFrame:
    """Exclusive cumulative sum of ``len_col``.

    With ``partition_by`` (for example a batch id) it is a per-group window;
    without, the distributed global running sum (no single-task window).
    """
    if partition_by is None:
        return running_sum(df, order, len_col, name=name, inclusive=False)
    order = [order] if isinstance(order, (str, Column)) else list(order)
    w = (Window.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
               .orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn(name, F.coalesce(F.sum(len_col).over(w), F.lit(0)))


def train_size(n: int, ratio: float = 0.8) -> int:
    """Q7: the train count rule, in float arithmetic like the reference."""
    return math.ceil(n * ratio)
