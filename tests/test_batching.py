import collections

from pyspark.sql import functions as F

from recprep.operators.batching import (
    assign_batches, plan_steps, shard_even, shard_rows, shuffle_rows,
)


def _rows(spark, n):
    return spark.range(0, n).select(F.col("id").cast("int").alias("k"))


def test_shuffle_is_a_permutation_and_seeded(spark):
    a = {r["k"]: r["row_idx"] for r in shuffle_rows(_rows(spark, 500), 42, 1, ["k"]).collect()}
    b = {r["k"]: r["row_idx"] for r in shuffle_rows(_rows(spark, 500), 42, 1, ["k"]).collect()}
    c = {r["k"]: r["row_idx"] for r in shuffle_rows(_rows(spark, 500), 42, 2, ["k"]).collect()}
    assert sorted(a.values()) == list(range(500))
    assert a == b and a != c


def test_batches_and_drop_last(spark):
    for n in (0, 1, 15, 16, 17):
        df = _rows(spark, n)
        kept = assign_batches(df, 16, drop_last=True, order=["k"]).collect()
        assert len(kept) == (n // 16) * 16
        allb = assign_batches(df, 16, order=["k"]).collect()
        sizes = collections.Counter(r["batch_id"] for r in allb)
        assert len(sizes) == plan_steps(n, 16, drop_last=False)
        assert all(v == 16 for b, v in sizes.items() if b < n // 16)


def test_shards_partition_rows(spark):
    idx = shuffle_rows(_rows(spark, 103), 7, 0, ["k"])
    shards = shard_rows(idx, 4).collect()
    assert sorted(r["k"] for r in shards) == list(range(103))
    assert len(shard_rows(idx, 4, rank=1).collect()) == 26


def test_shard_even_pads_with_first_rows(spark):
    for n, world in ((10, 4), (3, 8), (16, 4)):
        out = shard_even(_rows(spark, n), world, 1, 0, ["k"]).collect()
        total = -(-n // world) * world
        assert len(out) == total
        sizes = collections.Counter(r["shard"] for r in out)
        assert set(sizes.values()) == {total // world}
        assert {r["k"] for r in out} == set(range(n))
        assert sorted(r["position"] for r in out) == list(range(total))


def test_plan_steps():
    assert plan_steps(100, 32, True) == 3
    assert plan_steps(100, 32, False) == 4


def test_to_jagged_values_lengths_offsets(spark):
    from recprep.operators.batching import to_jagged
    df = spark.createDataFrame([(0, 0, [5, 6, 0]), (0, 1, [7, 0, 0]), (0, 2, [8, 9, 4]),
                                (1, 3, [1, 0, 0])], "b int, i int, v array<int>")
    out = {r["b"]: r for r in to_jagged(df, "b", "i", "v").collect()}
    assert out[0]["values"] == [5, 6, 7, 8, 9, 4]
    assert out[0]["lengths"] == [2, 1, 3] and out[0]["offsets"] == [0, 2, 3]
    assert out[1]["values"] == [1] and out[1]["offsets"] == [0]
