"""Aggregations (D1-D3, D5-D8). Every aggregate runs with map-side partial
aggregation, so a hot key costs one partial row per task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recprep.operators.indexing import running_sum, with_row_index


def item_popularity(df: DataFrame, item: str = "book_id", total: int | None = None) -> DataFrame:
    """Rows per item and its share of all rows.

    The total is a driver count (no cross join with a one-row frame).
    """
    n = total if total is not None else df.count()
    return (df.groupBy(item).agg(F.count(F.lit(1)).alias("count"))
              .withColumn("prob", F.col("count") / F.lit(float(n))))


def popularity_rank(pop: DataFrame, item: str = "book_id", name: str = "pop_rank") -> DataFrame:
    """F1 on D1: 1-based rank by count descending, item ascending, as a dense
    distributed index (no single-partition sort)."""
    return with_row_index(pop, [F.desc("count"), F.asc(item)], name=name, start=1)


def _valid(col: str, max_valid: float):
    v = F.when(F.col(col) != "", F.col(col).try_cast("float")).cast("double")
    return F.when(v <= max_valid, v)


def order_stats(df: DataFrame, name: str = "column", value: str = "value") -> DataFrame:
    """Exact (``name``, min, max, median) of the non-null doubles of each name,
    null without any; a name is a column's, so there are few.

    The rows are counted by value, the counts get their running sums in value
    order (one range exchange of the distinct values), and the median is the
    mean of the two values whose spans hold the middle places: no task sees
    all values of a name.
    """
    counts = df.groupBy(name, value).agg(F.sum((F.col(value).isNotNull()).cast("bigint")).alias("_n"))
    spans = running_sum(counts, [F.asc(name), F.asc_nulls_first(value)], "_n", name="_start")
    totals = spans.groupBy(name).agg(F.min(value).alias("min"), F.max(value).alias("max"),
                                     F.sum("_n").alias("_all"), F.min("_start").alias("_base"))
    t = totals.withColumnRenamed(name, "_name")              # one row per name
    low = F.col("_base") + F.floor((F.col("_all") - 1) / 2)
    high = F.col("_base") + F.floor(F.col("_all") / 2)

    def at(place):
        return F.max(F.when((F.col("_n") > 0) & (F.col("_start") <= place) & (place < F.col("_start") + F.col("_n")),
                            F.col(value)))

    return (spans.join(F.broadcast(t), spans[name].eqNullSafe(t["_name"])).groupBy(name, "min", "max")
                 .agg(((at(low) + at(high)) / 2).alias("median")))


def continuous_stats(df: DataFrame, col: str, max_valid: float = 2000.0,
                     exact: bool = True, accuracy: int = 100000) -> DataFrame:
    """Min, max and median (rounded to 4) of a string column's numeric
    values, ignoring blanks, unparsable values and values above
    ``max_valid``. One row. ``exact=False`` uses ``percentile_approx``."""
    x = _valid(col, max_valid)
    if not exact:
        return df.agg(F.min(x).alias("min"), F.max(x).alias("max"),
                      F.round(F.percentile_approx(x, 0.5, accuracy), 4).alias("median"))
    stats = order_stats(df.select(F.lit(col).alias("column"), x.alias("value")))
    return stats.agg(F.max("min").alias("min"), F.max("max").alias("max"), F.round(F.max("median"), 4).alias("median"))


def continuous_stats_many(df: DataFrame, cols, max_valid: float = 2000.0,
                          exact: bool = True, accuracy: int = 100000) -> dict:
    """D2 for several columns over one scan -> {col: (min, max, median)}."""
    cols = list(cols)
    if not exact:
        aggs = []
        for c in cols:
            v = _valid(c, max_valid)
            aggs += [F.min(v).alias(f"{c}__min"), F.max(v).alias(f"{c}__max"),
                     F.round(F.percentile_approx(v, 0.5, accuracy), 4).alias(f"{c}__median")]
        row = df.agg(*aggs).first()
        return {c: tuple(row[f"{c}__{k}"] for k in ("min", "max", "median")) for c in cols}
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), _valid(c, max_valid).alias("value"))
                                         for c in cols])).alias("x")).select("x.*")
    found = {r["column"]: r for r in order_stats(long).withColumn("median", F.round("median", 4)).collect()}
    return {c: (found[c]["min"], found[c]["max"], found[c]["median"]) if c in found else (None, None, None)
            for c in cols}


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """D3 / G1: distinct values (a shuffle with partial de-duplication)."""
    return df.select(col).distinct()


def masked_ratio(df: DataFrame, col: str, mask_id) -> DataFrame:
    """Share of tokens equal to ``mask_id``."""
    m = mask_id if not isinstance(mask_id, (int, float)) else F.lit(mask_id)
    return df.agg(F.avg((F.col(col) == m).cast("double")).alias("masked_ratio"))


def null_counts(df: DataFrame) -> DataFrame:
    """Number of nulls per column, one row."""
    return df.agg(*[F.sum(F.col(c).isNull().cast("bigint")).alias(c) for c in df.columns])


def check_dense_ids(df: DataFrame, col: str, n) -> DataFrame:
    """Min, max, distinct count and whether ids are exactly 1..n."""
    n = F.lit(n) if isinstance(n, int) else n
    agg = df.agg(F.min(col).alias("min_id"), F.max(col).alias("max_id"),
                 F.count_distinct(col).alias("n_distinct"))
    return agg.withColumn("dense", (F.col("min_id") == 1) & (F.col("max_id") == n)
                          & (F.col("n_distinct") == n))


def cardinalities(tables: dict) -> DataFrame:
    """``{name: (df, col)}`` -> long table (name, size) of distinct counts
    (``col=None`` counts rows)."""
    parts = []
    for name, (df, col) in tables.items():
        size = F.count(F.lit(1)) if col is None else F.count_distinct(col)
        parts.append(df.agg(size.cast("bigint").alias("size"))
                       .select(F.lit(name).alias("name"), "size"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
