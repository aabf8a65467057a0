"""Ranking-feature plan (I4, H5 and the minimum slice of section 3.1).

interactions -> filter users by activity -> binarize rating -> per-user
split by item order -> attach item features -> fixed output columns,
tagged ``train`` / ``eval`` in one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recprep.functions.scalar import OUTLIER_LIMIT, clip_outlier_to, decade_of, impute_blank
from recprep.operators.aggregates import (
    cardinalities, continuous_stats, continuous_stats_many, null_counts,
)
from recprep.operators.encoding import CATEGORY_COLUMNS, encode_categoricals
from recprep.operators.filters import RANKING_COLUMNS, binarize, filter_by_activity
from recprep.operators.joins import attach_features, attach_internal_id
from recprep.operators.windows import split_by_ratio
from recprep.session import materialize, staged

CONTINUOUS_COLUMNS = ["avg_rating", "num_pages"]


def project_books(books: DataFrame) -> DataFrame:
    """A3's projection: eight raw fields renamed as the features use them."""
    return books.select(
        F.col("book_id").alias("book_original_id"),
        F.col("language_code").alias("language"),
        "is_ebook",
        F.col("average_rating").alias("avg_rating"),
        "format", "publisher", "num_pages",
        F.col("publication_year").alias("pub_year"),
    )


def minmax_scale(df: DataFrame, col: str, max_valid: float = OUTLIER_LIMIT,
                 stats: tuple | None = None) -> DataFrame:
    """H5: blank -> median, outlier -> median, then (x - min) / (max - min).

    Stats are one aggregate row fetched as three scalars (or passed in);
    min == max gives null (``try_divide``) instead of a division error.
    """
    if stats is None:
        st = continuous_stats(df, col, max_valid).first()
        stats = (st["min"], st["max"], st["median"])
    lo, hi, med = stats
    if lo is None:
        return df.withColumn(col, F.lit(None).cast("float"))
    med_f = F.lit(med).cast("float")
    x = impute_blank(col, med_f, "float")
    x = clip_outlier_to(x, max_valid, med_f).cast("double")
    scaled = F.try_divide(x - F.lit(lo), F.lit(hi) - F.lit(lo))
    return df.withColumn(col, scaled.cast("float"))


def build_item_features(book_map: DataFrame, books: DataFrame, user_map: DataFrame | None = None):
    """I4: item feature table keyed by the internal ``book_id`` plus the
    cardinality table (D8). Returns ``(features, size_map)``."""
    b = project_books(books).withColumn("pub_decade", decade_of("pub_year")).drop("pub_year")
    stats = continuous_stats_many(b, CONTINUOUS_COLUMNS)   # one job, raw strings
    b, maps = encode_categoricals(b, CATEGORY_COLUMNS)
    for c in CONTINUOUS_COLUMNS:
        b = minmax_scale(b, c, stats=stats[c])
    # item table: small next to the interactions and reused by the size
    # check and the join, so it is computed once
    feats = materialize(attach_internal_id(book_map, b, on="book_original_id"))
    sizes = {}
    if user_map is not None:
        sizes["user"] = (user_map, None)
    sizes["item"] = (book_map, None)
    for col, _ in CATEGORY_COLUMNS:
        sizes[col] = (maps[col], None)
    return feats, cardinalities(sizes)


def check_features(features: DataFrame) -> DataFrame:
    """D6 over the feature table, which must hold no null: raises ValueError
    naming the columns that do, else returns the table."""
    counts = null_counts(features).first().asDict()
    bad = {c: n for c, n in counts.items() if n}
    if bad:
        raise ValueError(f"nulls in the item features: {bad}")
    return features


def ranking_examples(interactions: DataFrame, features: DataFrame, lo: int = 10,
                     hi: int | None = 250, ratio: float = 0.8, method: str | None = None) -> DataFrame:
    """Minimum slice: labelled, split, feature-joined examples (one pass).

    With an upper activity bound every user group has at most ``hi`` rows,
    so the split is a per-user window; without one the rank method is
    chosen from the measured largest group. The interactions are written
    once, as the activity filter reads them twice."""
    method = method or ("window" if hi is not None else "auto")
    data = filter_by_activity(staged(interactions, "interactions"), "user_id", lo, hi)
    data = binarize(data, "rating", 4, "label")
    data = split_by_ratio(data, "user_id", ["book_id"], ratio, method=method)
    data = attach_features(data, features, on="book_id")
    return data.withColumnRenamed("book_id", "item_id").select(*RANKING_COLUMNS, "split")


# The reference's raw file names and part count.
INTERACTIONS_FILE = "goodreads_interactions.csv"
USER_MAP_FILE = "user_id_map.csv"
BOOK_MAP_FILE = "book_id_map.csv"
BOOKS_FILE = "goodreads_books.json"
RANKING_PARTS = 8


def prepare_ranking_dataset(spark, data_dir: str, out_dir: str, write_format: str = "parquet",
                            n_parts: int = RANKING_PARTS, seed: int = 42, lo: int = 10,
                            hi: int | None = 250, ratio: float = 0.8, check_nulls: bool = True) -> dict:
    """Section 3.1 end to end: raw files -> item features and size map ->
    labelled, split, feature-joined examples -> ``train`` (shuffled) and
    ``eval`` parts in Parquet or GZIP TFRecord, plus the size-map and
    data-size sidecars. Returns the output paths and row counts.

    ``check_nulls``: item features that hold a null (an item of the id map
    without metadata, say) stop the job before anything is written."""
    from recprep.sources import files, tfrecord

    if write_format not in ("parquet", "tfrecord"):
        raise ValueError("write_format must be 'parquet' or 'tfrecord'")
    base = data_dir.rstrip("/")
    inter = files.read_interactions(spark, f"{base}/{INTERACTIONS_FILE}")
    user_map = files.read_id_map(spark, f"{base}/{USER_MAP_FILE}",
                                 ["user_id", "user_original_id"], {"user_id": "int"})
    book_map = files.read_id_map(spark, f"{base}/{BOOK_MAP_FILE}",
                                 ["book_id", "book_original_id"], {"book_id": "int"})
    books = files.read_item_metadata(spark, f"{base}/{BOOKS_FILE}")
    feats, sizes = build_item_features(book_map, books, user_map)
    if check_nulls:
        check_features(feats)
    files.write_size_map(sizes, f"{out_dir}/size_map")
    # the tagged rows are made once; both splits and their counts read them back
    ex = staged(ranking_examples(inter, feats, lo, hi, ratio), "ranking-examples")
    cols = [c for c in ex.columns if c != "split"]
    rows = {r["split"]: r["count"] for r in ex.groupBy("split").count().collect()}
    out = {"size_map": f"{out_dir}/size_map"}
    for split, shuffle in (("train", True), ("eval", False)):
        part = ex.where(F.col("split") == split).select(*cols)
        if write_format == "parquet":
            out[split] = files.write_parts(part, f"{out_dir}/parquet", split, n_parts,
                                           shuffle=shuffle, seed=seed, keys=["user_id", "item_id"],
                                           order=["user_id", "item_id"], rows=rows.get(split, 0))
        else:
            tfrecord.register(spark)
            from recprep.operators.batching import shuffle_key
            typed = part.select(*[F.col(c).cast("bigint") for c in RANKING_COLUMNS[:7]],
                                *[F.col(c).cast("float") for c in ("avg_rating", "num_pages", "label")])
            tasks = n_parts * files.files_per_part(rows.get(split, 0), n_parts)
            if shuffle:
                typed = (typed.withColumn("_k", shuffle_key(seed, 0, "user_id", "item_id"))
                              .repartitionByRange(tasks, "_k").sortWithinPartitions("_k").drop("_k"))
            else:
                typed = typed.repartitionByRange(tasks, "user_id", "item_id")
            path = f"{out_dir}/tfrecord/{split}"
            typed.write.format("tfrecord").mode("overwrite").save(path)
            out[split] = path
        n = rows.get(split, 0)
        files.write_data_size(spark, n, f"{out_dir}/{write_format}/{split}_data_size", split)
        out[f"{split}_rows"] = n
    return out
