"""Encoding (I1-I3): values to dense ids in sorted order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recprep.functions.scalar import blank_to_unknown
from recprep.operators.aggregates import check_dense_ids
from recprep.operators.indexing import with_row_index
from recprep.operators.joins import lookup

PAD_ID = 0

# Categorical item columns and their stored integer types.
CATEGORY_COLUMNS = [
    ("language", "smallint"),
    ("is_ebook", "tinyint"),
    ("format", "smallint"),
    ("publisher", "int"),
    ("pub_decade", "tinyint"),
]


def fit_index(df: DataFrame, col: str, start: int = 0, value: str = "value",
              id_col: str = "id") -> DataFrame:
    """Mapping table (value, id), ids dense from ``start`` in byte order of
    the value. Distinct values are indexed with the distributed row index, so
    a vocabulary of any size never sits in one task or the driver."""
    vals = df.select(F.col(col).alias(value)).where(F.col(value).isNotNull()).distinct()
    return with_row_index(vals, [value], name=id_col, start=start)


def fit_indexes(df: DataFrame, cols, start: int = 0, written: bool = False) -> DataFrame:
    """I1 for several columns in one pass: (column, value, id), ids dense
    from ``start`` per column in byte order of the value. All vocabularies
    share one distributed index (one range shuffle, one checkpoint); each
    column's ids are its global index minus the column's first index (a
    per-column minimum: as many rows as columns, so broadcast).

    ``written``: ``df`` is read straight from files, so the distinct values of
    each column come from a scan of that column alone."""
    cols = list(cols)
    kinds = dict(df.dtypes)
    if len({kinds[c] for c in cols}) > 1:
        # each type in its own order; the values meet as strings afterwards
        parts = [fit_indexes(df, [c for c in cols if kinds[c] == t], start, written)
                 for t in dict.fromkeys(kinds[c] for c in cols)]
        parts = [p.select("column", F.col("value").cast("string").alias("value"), "id") for p in parts]
        return reduce(DataFrame.unionByName, parts)
    vtype = kinds[cols[0]]
    if written:
        stacked = reduce(DataFrame.unionByName, [
            df.select(F.col(c).cast(vtype).alias("value")).where(F.col("value").isNotNull()).distinct()
              .select(F.lit(c).alias("column"), "value") for c in cols])
    else:
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"),
                                             F.col(c).cast(vtype).alias("value"))
                                    for c in cols])).alias("_kv")
        stacked = (df.select(pairs).select("_kv.*").where(F.col("value").isNotNull()).distinct())
    idx = with_row_index(stacked, ["column", "value"], name="_gidx")
    first = idx.groupBy("column").agg(F.min("_gidx").alias("_first"))
    return (idx.join(F.broadcast(first), "column")
               .select("column", "value",
                       (F.col("_gidx") - F.col("_first") + F.lit(start)).alias("id")))


def encode_column(df: DataFrame, col: str, dtype: str, mapping: DataFrame | None = None) -> tuple:
    """One categorical column: blank -> "unknown" -> id (0-based), typed.
    Returns (encoded frame, mapping)."""
    cleaned = df.withColumn(col, blank_to_unknown(col))
    mapping = mapping if mapping is not None else fit_index(cleaned, col, start=0)
    return lookup(cleaned, col, mapping, default=None, dtype=dtype), mapping


def encode_categoricals(df: DataFrame, cols=tuple(CATEGORY_COLUMNS)) -> tuple:
    """Blank -> "unknown" -> 0-based id for every categorical column,
    typed per column; returns (frame, {col: mapping(value, id)})."""
    cols = list(cols)
    for col, _ in cols:
        df = df.withColumn(col, blank_to_unknown(col))
    all_maps = fit_indexes(df, [c for c, _ in cols], start=0)
    # vocabulary sizes in one small job (one row per column); they bound
    # each mapping's broadcast
    sizes = {r["column"]: r["n"] for r in
             all_maps.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    maps = {}
    for col, dtype in cols:
        maps[col] = all_maps.where(F.col("column") == col).select("value", "id")
        df = lookup(df, col, maps[col], default=None, dtype=dtype,
                    known_rows=sizes.get(col, 0))
    return df, maps


def reindex_ids(df: DataFrame, user: str = "user_id", item: str = "book_id", written: bool = False) -> dict:
    """Users and items to dense 1..n ids (0 stays the pad id).

    Returns ``{"data", "user_map", "item_map", "n_users", "n_items",
    "mask_id"}``; ``mask_id = n_items + 1`` (vocabulary ``n_items + 2``).
    Counts are the only driver values. ``written`` as in ``fit_indexes``.
    """
    both = fit_indexes(df, [user, item], start=1, written=written)
    user_map = both.where(F.col("column") == user).select("value", "id")
    item_map = both.where(F.col("column") == item).select("value", "id")
    sizes = {r["column"]: r["n"] for r in
             both.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_users, n_items = sizes.get(user, 0), sizes.get(item, 0)
    data = lookup(df, user, user_map, default=PAD_ID, dtype="int", known_rows=n_users)
    data = lookup(data, item, item_map, default=PAD_ID, dtype="int", known_rows=n_items)
    return {"data": data, "user_map": user_map, "item_map": item_map,
            "n_users": n_users, "n_items": n_items, "mask_id": n_items + 1}


def check_reindexed(res: dict, user: str = "user_id", item: str = "book_id") -> DataFrame:
    """D7 applied to both id columns of ``reindex_ids``."""
    u = check_dense_ids(res["data"], user, res["n_users"]).withColumn("column", F.lit(user))
    i = check_dense_ids(res["data"], item, res["n_items"]).withColumn("column", F.lit(item))
    return u.unionByName(i)
