"""Dense row indexes and running sums without a single-partition window
(K2, E6).

A ``row_number()`` over a window with no ``partitionBy`` moves every row to
one task. Instead rows are range-partitioned on the order key and sorted
inside each partition; the layout is written as Parquet (range bounds come from
a sample, so it must be frozen; counting reads one column of it); then each partition's row count (one row per
partition, a proven-small table) gives its start offset, broadcast back.
Cost: one range shuffle of the rows and one write; besides, only one row per
partition is exchanged.
"""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recprep.session import ship_package, staged

_PID, _LOCAL, _OFF, _SUM = "_rx_pid", "_rx_local", "_rx_off", "_rx_sum"
_LOW33 = (1 << 33) - 1


def _cols(order) -> list:
    if isinstance(order, (str, Column)):
        return [order]
    return list(order)


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _sorted_layout(df: DataFrame, order: Sequence, num_partitions: int | None) -> DataFrame:
    """Range-partition + sort, record partition id and position, checkpoint.

    The range exchange has an explicit count (the session's shuffle
    partitions unless given), so the checkpointed layout keeps that
    parallelism for every later stage that reads it. (Letting AQE merge the
    ranges was measured slower at sf0.1: the readers inherit few tasks.)
    """
    n = _partitions(df, num_partitions)
    s = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
           .withColumn(_PID, F.spark_partition_id())
           .withColumn(_LOCAL, F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW33))))
    return staged(s, "sorted-layout")


ROWS_PER_SPREAD_TASK = 1_000_000


def spread(df: DataFrame, num_partitions: int | None = None,
           expected_rows: int | None = None) -> DataFrame:
    """Spread a small driving table before an explode that multiplies its
    rows (draws, candidate lists). AQE sizes post-shuffle partitions by input
    bytes and would otherwise fold a tiny per-user table -- and every row it
    explodes into -- into one task. Round-robin with an explicit count: a
    hash repartition on keys the child is already partitioned by would be
    dropped by the planner, and AQE does not coalesce an explicit count.

    The count is ``num_partitions`` if given, else sized for about one
    million exploded rows per task (``expected_rows``), and never below two
    tasks per core of the cluster (``2 * defaultParallelism``).
    """
    return df.repartition(num_partitions or spread_tasks(df, expected_rows))


def spread_tasks(df: DataFrame, expected_rows: int | None = None) -> int:
    """The task count that ``spread`` takes for so many exploded rows."""
    floor = 2 * df.sparkSession.sparkContext.defaultParallelism
    need = -(-expected_rows // ROWS_PER_SPREAD_TASK) if expected_rows else 0
    return max(floor, need, 1)


def with_row_index(df: DataFrame, order, name: str = "row_idx", start: int = 0,
                   num_partitions: int | None = None) -> DataFrame:
    """K2: add a dense ``start``-based index in ``order``.

    ``order`` must be a total order (add a unique tie-breaker) for the index to
    be reproducible across runs.
    """
    order = _cols(order)
    s = _sorted_layout(df, order, num_partitions)
    counts = s.groupBy(_PID).agg(F.count(F.lit(1)).alias("_rx_cnt"))
    # at most one row per partition: a single-task window is safe here
    w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PID, F.coalesce(F.sum("_rx_cnt").over(w), F.lit(0)).alias(_OFF))
    return (s.join(F.broadcast(offsets), _PID)
             .withColumn(name, (F.col(_OFF) + F.col(_LOCAL) + F.lit(start)).cast("bigint"))
             .drop(_PID, _LOCAL, _OFF))


def _summed_layout(df: DataFrame, order: Sequence, value: str, num_partitions: int | None,
                   inclusive: bool) -> DataFrame:
    """The sorted layout with the running sum of ``value`` inside each range
    partition (``_SUM``, nulls as 0), computed on the way to the file: a range
    partition arrives sorted, batch by batch, so no further exchange is due."""
    n = _partitions(df, num_partitions)
    whole = isinstance(df.schema[value].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    s = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn(_PID, F.spark_partition_id())
    out = T.StructType([*s.schema.fields, T.StructField(_SUM, T.LongType() if whole else T.DoubleType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0 if whole else 0.0
        for b in batches:
            v = pc.fill_null(b.column(b.schema.get_field_index(value)).cast(pa.int64() if whole else pa.float64()), 0)
            v = v.to_numpy(zero_copy_only=False)
            total = before + np.cumsum(v)
            if len(v):
                before = total[-1]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(total if inclusive else total - v)],
                                             names=[*b.schema.names, _SUM])

    ship_package(df.sparkSession)
    return staged(s.mapInArrow(add, out), "summed-layout")


def running_sum(df: DataFrame, order, value: str, name: str = "running",
                inclusive: bool = False, num_partitions: int | None = None) -> DataFrame:
    """E6 (global form): running total of ``value`` in ``order``, with one
    range exchange of the rows. Nulls count as 0.

    ``inclusive=False`` gives offsets (sum of the rows before), the form used
    for cumulative ranges and jagged offsets. Whole numbers sum to bigint,
    others to double.
    """
    order = _cols(order)
    s = _summed_layout(df, order, value, num_partitions, inclusive)
    # one row per partition
    part = s.groupBy(_PID).agg(F.sum(value).alias("_rx_tot"))
    w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = part.select(_PID, F.coalesce(F.sum("_rx_tot").over(w), F.lit(0)).alias(_OFF))
    kind = s.schema[_SUM].dataType
    return (s.join(F.broadcast(offsets), _PID)
             .withColumn(name, (F.col(_OFF) + F.col(_SUM)).cast(kind))
             .drop(_PID, _SUM, _OFF))


DEFAULT_WINDOW_GROUP_ROWS = 5_000_000


def largest_group(df: DataFrame, keys) -> int:
    """Row count of the largest key group (partial aggregate + max)."""
    keys = _cols(keys)
    m = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_g")).agg(F.max("_g")).first()[0]
    return int(m or 0)


def rank_within(df: DataFrame, keys, order, pos: str = "pos", size: str = "n",
                method: str = "auto") -> DataFrame:
    """0-based position of each row inside its key group, plus the group size.

    ``method="window"``: one hash exchange on the keys; each group is held by
    one task, so use it when groups are bounded (the pipelines bound users
    with ``filter_by_activity``).
    ``method="global"``: a global range sort on (keys, order) splits a hot key
    over many tasks; the position is the global index minus the group's first
    index (a partial aggregate). Safe for a key holding a third of all rows.
    Both put rows with a null key into one group of their own.
    ``method="auto"`` measures the largest group and uses the window path
    only under ``recprep.window.maxGroupRows`` (default 5M rows).
    """
    keys, order = _cols(keys), _cols(order)
    if method == "auto":
        conf = df.sparkSession.conf.get("recprep.window.maxGroupRows", None)
        bound = int(conf) if conf else DEFAULT_WINDOW_GROUP_ROWS
        method = "window" if largest_group(df, keys) <= bound else "global"
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(*order)
        # the same order for both, so that one pass over a group does
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return df.withColumns({pos: F.row_number().over(w) - 1, size: F.count(F.lit(1)).over(whole)})
    if method != "global":
        raise ValueError("method must be 'window' or 'global'")
    from recprep.operators.joins import maybe_broadcast

    idx = with_row_index(df, keys + order, name="_rx_idx")
    names = list(keys)
    stats = idx.groupBy(*names).agg(F.min("_rx_idx").alias("_rx_first"),
                                   F.count(F.lit(1)).alias(size))
    # one row per key: broadcast under the bound, so hot keys' rows stay put
    stats = stats.select(*[F.col(c).alias(f"_rx_k{i}") for i, c in enumerate(names)], "_rx_first", size)
    same = [F.col(c).eqNullSafe(F.col(f"_rx_k{i}")) for i, c in enumerate(names)]
    return (idx.join(maybe_broadcast(stats), reduce(and_, same))
               .withColumn(pos, (F.col("_rx_idx") - F.col("_rx_first")).cast("int"))
               .withColumn(size, F.col(size).cast("bigint"))
               .drop("_rx_idx", "_rx_first", *[f"_rx_k{i}" for i in range(len(names))]))
