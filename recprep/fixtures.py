"""Stand-in inputs built from the driver's TPC-H-like tables.

These only reshape the given tables into the schemas the recommender
operators expect (interactions, id maps, item metadata, scored rows); they do
none of the operators' work. Definitions follow FIXTURES.md, so the same
views can be written in SQL for the DuckDB oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def interactions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, book_id, rating, is_read, is_reviewed); duplicates kept."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_partkey").cast("int").alias("book_id"),
        (F.lit(1) + F.floor((F.col("l_quantity") - 1) / 10)).cast("tinyint").alias("rating"),
        F.when(F.col("l_returnflag") != "N", 1).otherwise(0).cast("tinyint").alias("is_read"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).cast("tinyint").alias("is_reviewed"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o.hint("shuffle_hash"), li.l_orderkey == o.o_orderkey)
    return j.select(F.col("o_custkey").cast("int").alias("user_id"), "book_id", "rating", "is_read", "is_reviewed")


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (user_id, book_id)."""
    return (interactions_raw(spark, sf_dir).groupBy("user_id", "book_id")
            .agg(F.max("rating").alias("rating"), F.max("is_read").alias("is_read"),
                 F.max("is_reviewed").alias("is_reviewed")))


def book_id_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").cast("int").alias("book_id"),
                    F.concat(F.lit("B"), F.col("p_partkey").cast("string")).alias("book_original_id"))


def user_id_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("int").alias("user_id"),
                    F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("user_original_id"))


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw item metadata, every field a string (blanks, outliers, bad years)."""
    p = table(spark, sf_dir, "part")
    k, size = F.col("p_partkey"), F.col("p_size")

    def blank_if(mod, value):
        return F.when(k % mod == 0, F.lit("")).otherwise(value)

    avg = F.concat((F.lit(1) + size % 4).cast("string"), F.lit("."), (k % 100).cast("string"))
    pages = (F.when(k % 13 == 0, F.lit("")).when(k % 97 == 0, F.lit("5000"))
              .otherwise((size * 20).cast("string")))
    year = (F.when(k % 9 == 0, F.lit("")).when(k % 17 == 0, F.lit("abcd"))
             .otherwise((F.lit(1895) + k % 140).cast("string")))
    return p.select(
        F.concat(F.lit("B"), k.cast("string")).alias("book_id"),
        blank_if(7, F.col("p_brand")).alias("language_code"),
        F.when(size % 2 == 0, F.lit("true")).otherwise(F.lit("false")).alias("is_ebook"),
        blank_if(11, avg).alias("average_rating"),
        blank_if(19, F.col("p_type")).alias("format"),
        blank_if(23, F.col("p_name")).alias("publisher"),
        pages.alias("num_pages"),
        year.alias("publication_year"),
    )


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows (event_id, user_id, logit, label) for log-loss and AUC."""
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id", "user_id",
        ((F.col("value") - 25) / 10).alias("logit"),
        F.when(F.col("event_type").isin("purchase", "click"), 1).otherwise(0).alias("label"),
    )


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
