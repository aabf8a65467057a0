"""Plans and results of the operators that meet hot keys, wide tables and
global order: medians, group sizes, positions, running sums, broadcasts."""

import random
import re

import pytest
from pyspark.sql import functions as F

from recprep.operators import joins
from recprep.operators.aggregates import continuous_stats, continuous_stats_many, order_stats
from recprep.operators.indexing import running_sum
from recprep.operators.joins import lookup, maybe_broadcast
from recprep.operators.metrics import roc_auc
from recprep.operators.windows import sort_within, with_group_size


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan as adaptive execution ran it."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("values,want", [
    ([], (None, None, None)), (["", None, "x", "NaN"], (None, None, None)), (["3"], (3.0, 3.0, 3.0)),
    (["1", "2"], (1.0, 2.0, 1.5)), (["2", "1", "9", "9", "", "2001"], (1.0, 9.0, 5.5)),
    (["5"] * 7 + ["1"], (1.0, 5.0, 5.0)), (["0.1", "0.2", "0.3"], (0.10000000149011612, 0.30000001192092896, 0.2))])
def test_median_of_few_values(spark, values, want):
    df = spark.createDataFrame([(v, "7") for v in values], "a string, b string")
    row = continuous_stats(df, "a").first()
    assert tuple(row) == pytest.approx(want) if want[0] is not None else tuple(row) == want
    many = continuous_stats_many(df, ["a", "b"])
    assert many["a"] == tuple(row) and many["b"] == ((7.0, 7.0, 7.0) if values else (None, None, None))


def test_median_is_exact_and_spread(spark):
    rnd = random.Random(4)
    rows = [(c, rnd.choice([None, float(rnd.randint(0, 40)), rnd.random()])) for c in "xyz" for _ in range(501)]
    df = spark.createDataFrame(rows, "column string, value double")
    out = order_stats(df)
    for r in out.collect():
        v = sorted(x for c, x in rows if c == r["column"] and x is not None)
        n = len(v)
        assert (r["min"], r["max"]) == (v[0], v[-1])
        assert r["median"] == pytest.approx((v[(n - 1) // 2] + v[n // 2]) / 2)
    text = plan(continuous_stats(df.select(F.col("value").cast("string").alias("s")), "s"))
    assert not re.search(r"\b(median|percentile)\(", text)


def hot(spark, n=3000):
    # a third of all rows under one key, another tenth under null
    return spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 != 1, 1 + F.col("id") % 97).cast("int").alias("k"),
        (F.col("id") * 7919 % n).alias("v"), F.col("id").alias("ord"))


def test_group_size_keeps_hot_rows_where_they_are(spark):
    df = hot(spark)
    out = with_group_size(df, "k")
    assert "Window" not in plan(out) and "BroadcastHashJoin" in plan(out)
    sizes = {}
    for r in df.collect():
        sizes[r.k] = sizes.get(r.k, 0) + 1
    got = out.collect()
    assert len(got) == 3000 and all(r.n == sizes[r.k] for r in got) and sizes[0] == 1000
    two = with_group_size(df.withColumn("n", F.lit("old")), ["k", "v"])
    assert two.columns == ["k", "v", "ord", "n"] and two.agg(F.max("n")).first()[0] == 1
    assert with_group_size(df.limit(0), "k").collect() == []


def test_group_size_of_many_keys_splits_the_hot_one(spark):
    """Above the broadcast bound the join shuffles, and adaptive execution cuts
    the hot key's partition."""
    # sizes in bytes, so that this small table counts as skewed
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "recprep.broadcast.maxRows": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {c: spark.conf.get(c, None) for c in conf}
    for c, v in conf.items():
        spark.conf.set(c, v)
    try:
        df = spark.range(0, 120000, 1, 24).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(1 + F.col("id") % 997).alias("k"), F.uuid().alias("pad"))
        out = with_group_size(df, "k")
        text = final_plan(out)
        assert "skew=true" in text and out.where("k = 0").select("n").distinct().collect()[0].n == 40000
    finally:
        for c, v in before.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)


@pytest.mark.parametrize("method", ["window", "global", "auto"])
def test_sort_within_hot_and_null_keys(spark, method):
    df = hot(spark)
    rows = df.collect()
    groups = {}
    for r in rows:
        groups.setdefault(r.k, []).append(r)
    got = {(r.k, r.ord): r for r in sort_within(df, "k", "v", method=method).collect()}
    pairs = sort_within(df, "k", "v", positional=True, input_order="ord", method=method)
    assert pairs.columns == ["k", "pos", "ord", "v"]
    moved = {(r.k, r.ord): r for r in pairs.collect()}
    assert len(got) == len(moved) == len(rows)
    for k, g in groups.items():
        values = sorted(r.v for r in g)
        for i, r in enumerate(sorted(g, key=lambda r: r.ord)):
            assert moved[k, r.ord].pos == i and moved[k, r.ord].v == values[i]
            assert got[k, r.ord].pos == values.index(r.v)
    if method == "global":
        assert "windowspecdefinition(k" not in plan(sort_within(df, "k", "v", method=method))


def test_running_sum_moves_rows_once(spark):
    df = spark.range(0, 500).select(F.col("id"), F.when(F.col("id") % 7 != 0, F.col("id") % 11).alias("x"),
                                    F.array("id").alias("list"))
    for inclusive in (False, True):
        out = running_sum(df, ["id"], "x", inclusive=inclusive, num_partitions=5)
        assert out.schema["running"].dataType.simpleString() == "bigint"
        total = 0
        for r in out.orderBy("id").collect():
            now = total + (r.x or 0)
            assert r.running == (now if inclusive else total) and r.list == [r.id]
            total = now
        # the rows were moved before the file was written; what is read back
        # exchanges partition totals only
        text = plan(out)
        assert "rangepartitioning" not in text
        assert all("_rx_pid" in x or "SinglePartition" in x or "HashedRelation" in x
                   for x in text.split("\n") if "Exchange" in x)
        assert text.count("windowspecdefinition") == 1 and "_rx_local" not in text   # of the totals
    halves = running_sum(df.select("id", (F.col("x") / 2).alias("h")), [F.desc("id")], "h", inclusive=True)
    assert halves.where("id = 0").first().running == sum(r.x / 2 for r in df.collect() if r.x)
    assert running_sum(df.limit(0), ["id"], "x").collect() == []


def test_auc_moves_rows_once(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1), (0.4, 1)], "logit double, label int")
    assert roc_auc(df).first()[0] == pytest.approx((1 + 2 + 1.5) / 6)
    assert "_rx_local" not in plan(roc_auc(df))


def test_wide_rows_are_not_broadcast(spark):
    narrow = spark.range(0, 300).select("id", (F.col("id") * 2).alias("v"))
    wide = spark.range(0, 300).select("id", F.array_repeat(F.col("id").cast("double"), 1000).alias("v"))
    # repeated values: small in a file, not in memory
    dull = spark.range(0, 300).select("id", F.repeat(F.lit("same"), 2000).alias("v"))
    for df, fits in ((narrow, True), (wide, False), (dull, False)):
        for known in (None, 300):
            got = maybe_broadcast(df, known_rows=known, max_bytes=1 << 20)
            hinted = "ResolvedHint" in got._jdf.queryExecution().analyzed().toString()
            assert hinted == fits, (df.schema, known)
            assert got.count() == 300
    assert "ResolvedHint" not in maybe_broadcast(narrow, max_rows=299)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in maybe_broadcast(dull)._jdf.queryExecution().analyzed().toString()


def test_measured_side_runs_once(spark):
    """The plan of a side of unknown size runs once: the join reads what was
    written to measure it."""
    runs = spark.sparkContext.accumulator(0)

    def seen(x):
        runs.add(1)
        return x

    side = spark.range(0, 20).select(F.col("id").alias("value"), F.udf(seen, "long")("id").alias("id2"))
    out = lookup(spark.range(0, 40).toDF("c"), "c", side, "value", "id2", default=-1)
    assert sorted(r.c for r in out.collect()) == [-1] * 20 + list(range(20))
    assert runs.value == 20
    assert joins.broadcast_limit(side) == joins.DEFAULT_BROADCAST_ROWS
