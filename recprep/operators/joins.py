"""Joins (C1-C5) and the size-checked broadcast they share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recprep.session import staged

DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 256 << 20
#: what a row and an array element take at least once broadcast, and how much
#: a Parquet file grows
ROW_BYTES, ELEMENT_BYTES, FILE_GROWTH = 16, 8, 4


def _limit(df: DataFrame, name: str, default: int) -> int:
    conf = df.sparkSession.conf.get(f"recprep.broadcast.{name}", None)
    return int(conf) if conf else default


def broadcast_limit(df: DataFrame) -> int:
    return _limit(df, "maxRows", DEFAULT_BROADCAST_ROWS)


def broadcast_bytes_limit(df: DataFrame) -> int:
    return _limit(df, "maxBytes", DEFAULT_BROADCAST_BYTES)


def _fixed_width(schema: T.StructType) -> int | None:
    """Bytes of a row if all its columns are of fixed size, else None."""
    sizes = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8, T.FloatType: 4,
             T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8, T.DecimalType: 16}
    each = [sizes.get(type(f.dataType)) for f in schema.fields]
    return None if None in each else ROW_BYTES + sum(each)


def _file_bytes(df: DataFrame) -> int:
    """What the optimizer knows of a table that is read straight from files:
    their size."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def maybe_broadcast(df: DataFrame, max_rows: int | None = None,
                    known_rows: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Broadcast ``df`` only when both its rows and its bytes are proven below
    a bound (``recprep.broadcast.maxRows`` and ``maxBytes``).

    With ``known_rows`` and columns of fixed size both follow from the schema.
    Otherwise ``df`` is written once to the shared folder, so that its plan is
    not run again, and is measured there: rows from the files' footers; bytes
    from their size times FILE_GROWTH, but no less than the fixed-size columns
    and all strings and array elements take (a repeated value hardly shows in
    a file). Above a bound the join shuffles (AQE splits skewed partitions).
    """
    rows_limit = max_rows if max_rows is not None else broadcast_limit(df)
    bytes_limit = max_bytes if max_bytes is not None else broadcast_bytes_limit(df)
    if known_rows is not None and known_rows > rows_limit:
        return df
    width = _fixed_width(df.schema)
    if known_rows is not None and width is not None:
        return F.broadcast(df) if known_rows * width <= bytes_limit else df
    df = staged(df, "broadcast-side")
    rows = known_rows if known_rows is not None else df.count()
    if rows > rows_limit:
        return df
    return F.broadcast(df) if table_bytes(df, rows) <= bytes_limit else df


def table_bytes(df: DataFrame, rows: int) -> int:
    """Bytes that a table read straight from files takes in memory, at least."""
    width = _fixed_width(df.schema)
    size = max(FILE_GROWTH * _file_bytes(df), rows * (width or ROW_BYTES))
    if width is None:
        size = max(size, df.agg(F.sum(_row_bytes(df.schema))).first()[0] or 0)
    return size


def _row_bytes(schema: T.StructType) -> Column:
    """Bytes of a row; nested columns by their JSON text."""
    total = F.lit(ROW_BYTES).cast("bigint")
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            n = F.octet_length(c)
        elif isinstance(f.dataType, T.ArrayType) and not isinstance(
                f.dataType.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType, T.MapType)):
            n = F.size(c) * ELEMENT_BYTES
        elif isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            n = F.octet_length(F.to_json(F.struct(c)))
        else:
            n = F.lit(ELEMENT_BYTES)
        total = total + ELEMENT_BYTES + F.greatest(F.lit(0), F.coalesce(n, F.lit(0)))
    return total


def attach_internal_id(id_map: DataFrame, metadata: DataFrame,
                       on: str = "book_original_id", drop_key: bool = True) -> DataFrame:
    """Id map LEFT JOIN metadata on the original id."""
    out = id_map.join(maybe_broadcast(metadata), on, "left")
    return out.drop(on) if drop_key else out


def attach_features(examples: DataFrame, features: DataFrame, on: str = "book_id",
                    broadcast_rows: int | None = None) -> DataFrame:
    """Examples LEFT JOIN item features (features broadcast when the item
    table is proven small, else a shuffle join; a hot item is split by AQE)."""
    return examples.join(maybe_broadcast(features, known_rows=broadcast_rows), on, "left")


def attach_labels(rows: DataFrame, interactions: DataFrame, on=("user_id", "book_id")) -> DataFrame:
    """Split rows JOIN interactions on (user, item).

    The reference left-joins per slice and drops nulls, i.e. an inner join;
    k duplicates of a pair on both sides give k*k rows, as there.
    """
    return rows.join(interactions, list(on), "inner")


def lookup(df: DataFrame, col: str, mapping: DataFrame, key: str = "value",
           value: str = "id", default=None, out: str | None = None,
           dtype: str | None = None, known_rows: int | None = None) -> DataFrame:
    """C4: dictionary replace through a join on a mapping table; unmapped ->
    ``default`` (null unless given). The mapping is broadcast only under the
    bounds of ``maybe_broadcast``."""
    out = out or col
    m = mapping.select(F.col(key).alias("_lk_key"), F.col(value).alias("_lk_val"))
    res = df.join(maybe_broadcast(m, known_rows=known_rows), df[col] == F.col("_lk_key"), "left")
    v = F.col("_lk_val") if default is None else F.coalesce(F.col("_lk_val"), F.lit(default))
    if dtype:
        v = v.cast(dtype)
    if out in df.columns:
        return res.select(*[v.alias(c) if c == out else F.col(c) for c in df.columns])
    return res.select(*[F.col(c) for c in df.columns], v.alias(out))


def exclude_positives(candidates: DataFrame, positives: DataFrame,
                      on=("user_id", "book_id")) -> DataFrame:
    """Drop candidates the user already has (anti join on user and item)."""
    return candidates.join(positives.select(*on), list(on), "left_anti")
