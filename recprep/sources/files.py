"""File sources and sinks.

CSV schemas are declared by column *name* in the reference, while Spark's CSV
schema is positional: files are read as strings with the header and then
cast by name, so a different column order in the file still types correctly.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from recprep.operators.batching import shuffle_key
from recprep.session import shuffles_end_with_writes

# Interaction column types by name.
INTERACTION_TYPES = {
    "user_id": "int",
    "book_id": "int",
    "is_read": "tinyint",
    "is_reviewed": "tinyint",
    "rating": "tinyint",
}
# The eight metadata fields read from the item file.
ITEM_FIELDS = ["book_id", "language_code", "is_ebook", "average_rating", "format",
               "publisher", "num_pages", "publication_year"]


def read_interactions(spark: SparkSession, path: str, types: dict = INTERACTION_TYPES) -> DataFrame:
    """A1: header CSV, each known column cast by name."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c)
                       for c in df.columns])


def read_id_map(spark: SparkSession, path: str, names, types: dict | None = None) -> DataFrame:
    """A2: CSV id map, columns renamed by position, then typed."""
    df = spark.read.option("header", True).csv(path).toDF(*names)
    types = types or {}
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c)
                       for c in names])


def read_item_metadata(spark: SparkSession, path: str) -> DataFrame:
    """A3: newline-delimited JSON (``.gz`` read natively) with an explicit
    all-string schema, so only the eight fields are parsed."""
    schema = StructType([StructField(c, StringType()) for c in ITEM_FIELDS])
    return spark.read.schema(schema).json(path)


def dataset_size(spark: SparkSession, path: str) -> int:
    """A4: row count over Parquet parts (footer counts, no data read)."""
    return spark.read.parquet(path).count()


def read_examples(spark: SparkSession, path: str, feature_cols, label_col: str | None = "label") -> DataFrame:
    """A5: Parquet parts projected to features (+ label); the projection
    reaches the scan, so other columns are never read."""
    cols = list(feature_cols) + ([label_col] if label_col else [])
    return spark.read.parquet(path).select(*cols)


#: rows that one written file holds (about)
ROWS_PER_FILE = 5_000_000


#: compressed bytes that one written file holds (about)
BYTES_PER_FILE = 256 << 20


def files_per_part(rows: int, n_parts: int) -> int:
    """How many files (and tasks) each part gets for this many rows."""
    return max(1, -(-rows // (n_parts * ROWS_PER_FILE)))


def files_for_bytes(table: DataFrame, n_parts: int) -> int:
    """How many files (and tasks) each part gets, by the bytes of a table read
    straight from files (``staged``): no pass over the rows."""
    size = int(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(1, -(-size // (n_parts * BYTES_PER_FILE)))


def write_parts(df: DataFrame, out_dir: str, prefix: str, n_parts: int, shuffle: bool = False,
                seed: int = 42, keys=None, order=None, mode: str = "overwrite",
                rows: int | None = None, files: int | None = None) -> str:
    """Write ``n_parts`` near-equal Parquet parts under ``out_dir/prefix``.

    ``shuffle=True`` orders rows by a seeded J9 key over ``keys`` (the train
    prefix); otherwise by ``order``. Range partitioning on that key gives the
    equal parts; file names are Spark's.

    A part is one file while that is enough. With ``files`` per part, or
    ``rows`` (the row count) asking for more than one, the parts are folders
    ``part=0 ...`` of so many files, each written by a task of its own, and
    readers see a ``part`` column besides the others.
    """
    path = os.path.join(out_dir, prefix)
    each = files or files_per_part(rows or 0, n_parts)
    tasks = n_parts * each
    if shuffle:
        keys = [keys] if isinstance(keys, str) else list(keys or df.columns)
        df = df.withColumn("_part_key", shuffle_key(seed, 0, *keys))
        order = ["_part_key", *keys]
    elif order is not None:
        order = [order] if isinstance(order, str) else list(order)
    data = df.repartitionByRange(tasks, *order) if order else df.repartition(tasks)
    if each > 1:
        data = data.withColumn("part", F.floor(F.spark_partition_id() / each).cast("int"))
        order = ["part", *(order or [])]
    if order:
        data = data.sortWithinPartitions(*order)
    writer = data.drop("_part_key").write.mode(mode)
    with shuffles_end_with_writes(df.sparkSession):
        (writer.partitionBy("part") if each > 1 else writer).parquet(path)
    return path


def write_size_map(df: DataFrame, path: str) -> str:
    """The (name, size) cardinality table as one small JSON file.
    The table has one row per feature, so one task writes it."""
    df.select("name", F.col("size").cast("bigint")).coalesce(1).write.mode("overwrite").json(path)
    return path


def read_size_map(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("name string, size bigint").json(path)


def write_data_size(spark: SparkSession, n: int, path: str, prefix: str) -> str:
    """A10: row-count sidecar ``{prefix}_data_size``."""
    spark.createDataFrame([(f"{prefix}_data_size", int(n))], "name string, size bigint") \
         .coalesce(1).write.mode("overwrite").json(path)
    return path


def read_data_size(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("name string, size bigint").json(path)


def size_map_dict(df: DataFrame) -> dict:
    """The sidecar as a Python dict (a handful of scalars)."""
    return {r["name"]: int(r["size"]) for r in df.collect()}


def size_map_json(df: DataFrame) -> str:
    return json.dumps(size_map_dict(df), indent=4)
