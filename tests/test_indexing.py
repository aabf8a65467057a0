from pyspark.sql import Window
from pyspark.sql import functions as F

from recprep.operators.indexing import rank_within, running_sum, with_row_index
from conftest import SF_SMALL


def test_row_index_is_dense_and_ordered(spark):
    df = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]
    got = with_row_index(df, order, name="ix")
    rows = got.orderBy("ix").collect()
    assert [r["ix"] for r in rows] == list(range(df.count()))
    keys = [tuple(r[c] for c in order) for r in rows]
    assert keys == sorted(keys)


def test_row_index_same_for_any_partition_count(spark):
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_custkey")
    results = []
    for n in (1, 8, 64):
        got = with_row_index(df, ["o_custkey", "o_orderkey"], num_partitions=n)
        results.append(sorted((r[0], r[1], r[2]) for r in got.collect()))
    assert results[0] == results[1] == results[2]


def test_running_sum_exclusive_and_inclusive(spark):
    df = spark.createDataFrame([(i, i % 3 + 1) for i in range(40)], "k int, v int")
    ex = {r["k"]: r["s"] for r in running_sum(df, ["k"], "v", name="s").collect()}
    inc = {r["k"]: r["s"] for r in running_sum(df, ["k"], "v", name="s", inclusive=True).collect()}
    acc = 0
    for k in range(40):
        assert ex[k] == acc
        acc += k % 3 + 1
        assert inc[k] == acc


def test_global_rank_equals_window_rank(spark):
    # one hot key holding most rows, plus small groups
    rows = [(0, i) for i in range(300)] + [(k, i) for k in range(1, 20) for i in range(k)]
    df = spark.createDataFrame(rows, "u int, item int")
    a = rank_within(df, "u", ["item"], method="window").collect()
    b = rank_within(df, "u", ["item"], method="global").collect()
    key = lambda r: (r["u"], r["item"], r["pos"], r["n"])
    assert sorted(map(key, a)) == sorted(map(key, b))


def test_index_plan_broadcasts_offsets_only(spark):
    df = spark.range(0, 1000).withColumnRenamed("id", "k")
    plan = with_row_index(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    # rows come from the checkpoint and meet the per-partition offsets in a
    # broadcast join: no further shuffle of the rows themselves
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan
