"""One key holding a third of all rows."""

import math

from pyspark.sql import functions as F

from recprep.operators.aggregates import item_popularity
from recprep.operators.filters import filter_by_activity
from recprep.operators.indexing import rank_within
from recprep.operators.sampling import popularity_draws, popularity_table
from recprep.operators.windows import split_by_ratio


def _skewed(spark, n=3000):
    # user 0 holds a third of the rows; item 7 a third of the rows
    return spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(1 + F.col("id") % 97).cast("int").alias("user_id"),
        F.when(F.col("id") % 3 == 1, 7).otherwise(F.col("id") % 500).cast("int").alias("book_id"),
        F.col("id").alias("ts"))


def test_hot_user_dropped_before_any_row_shuffle(spark):
    df = _skewed(spark)
    kept = filter_by_activity(df, "user_id", 5, 250)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    users = {r[0] for r in kept.select("user_id").distinct().collect()}
    assert 0 not in users and len(users) == 97


def test_auto_rank_switches_to_global_for_hot_key(spark):
    df = _skewed(spark)
    spark.conf.set("recprep.window.maxGroupRows", "500")
    try:
        plan_auto = rank_within(df, "user_id", ["ts"], method="auto")
        got = sorted((r["user_id"], r["ts"], r["pos"], r["n"]) for r in plan_auto.collect())
        p = plan_auto._jdf.queryExecution().executedPlan().toString()
        # global path: dense index + per-key aggregate; the only window is the
        # index's offsets over one row per partition, none per user
        assert "windowspecdefinition(user_id" not in p
    finally:
        spark.conf.unset("recprep.window.maxGroupRows")
    want = sorted((r["user_id"], r["ts"], r["pos"], r["n"])
                  for r in rank_within(df, "user_id", ["ts"], method="window").collect())
    assert got == want
    split = split_by_ratio(df, "user_id", ["ts"], 0.8, method="global")
    hot = split.where("user_id = 0").groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in hot} == {"train": 800, "eval": 200}


def test_hot_item_spreads_over_buckets(spark):
    df = _skewed(spark)
    total = df.count()
    table = popularity_table(item_popularity(df, "book_id", total), "book_id", total)
    users = spark.range(0, 300).select(F.col("id").cast("int").alias("user_id"),
                                       F.lit(100).alias("m"))
    draws = popularity_draws(users, table, 11)
    share = draws.where("book_id = 7").count() / draws.count()
    assert abs(share - 1 / 3) < 0.02
    hot_buckets = table.ranges.where("book_id = 7").count()
    assert hot_buckets >= math.floor(table.n_items / 3) - 1   # the hot item spans many buckets
