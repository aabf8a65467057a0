import math

from pyspark.sql import functions as F

from recprep.operators.filters import binarize, filter_by_activity
from recprep.operators.sequences import split_leave_last_lists
from recprep.operators.windows import sort_within, split_by_ratio, split_leave_last

SIZES = [1, 2, 3, 9, 10, 15, 250, 251]


def _users(spark, sizes):
    rows = [(u, 1000 - i) for u, n in enumerate(sizes) for i in range(n)]
    return spark.createDataFrame(rows, "user_id int, book_id int")


def test_activity_bounds_inclusive(spark):
    df = _users(spark, SIZES)
    kept = {r[0] for r in filter_by_activity(df, "user_id", 10, 250).select("user_id").distinct().collect()}
    assert kept == {u for u, n in enumerate(SIZES) if 10 <= n <= 250}
    only_lo = {r[0] for r in filter_by_activity(df, "user_id", 3, None).select("user_id").distinct().collect()}
    assert only_lo == {u for u, n in enumerate(SIZES) if n >= 3}


def test_ratio_split_counts_and_order(spark):
    df = _users(spark, SIZES)
    for method in ("window", "global"):
        out = split_by_ratio(df, "user_id", ["book_id"], 0.8, method=method).collect()
        for u, n in enumerate(SIZES):
            rows = sorted((r["book_id"], r["split"]) for r in out if r["user_id"] == u)
            k = math.ceil(n * 0.8)
            assert [s for _, s in rows] == ["train"] * k + ["eval"] * (n - k)


def test_leave_last_two_short_histories(spark):
    df = _users(spark, [1, 2, 3, 20])
    lists = {r["user_id"]: r for r in split_leave_last_lists(df).collect()}
    assert lists[0]["train_interactions"] == [] and lists[0]["eval_interactions"] is None
    assert lists[0]["test_interactions"] == 1000
    assert lists[1]["train_interactions"] == [] and lists[1]["eval_interactions"] == 999
    assert lists[2]["train_interactions"] == [998] and lists[2]["test_interactions"] == 1000
    rows = split_leave_last(df, "user_id", ["book_id"]).where("user_id = 3").collect()
    roles = [r["role"] for r in sorted(rows, key=lambda r: r["book_id"])]
    assert roles == ["train"] * 18 + ["eval", "test"]


def test_binarize_null_is_zero(spark):
    df = spark.createDataFrame([(5,), (4,), (3,), (None,)], "rating tinyint")
    assert [r[0] for r in binarize(df).collect()] == [1, 1, 0, 0]


def test_positional_sort_detaches_columns(spark):
    # input order within the user: items 3, 1, 2 with labels a, b, c
    df = spark.createDataFrame([(1, 3, "a", 0), (1, 1, "b", 1), (1, 2, "c", 2)],
                               "user_id int, book_id int, label string, ord int")
    pos = {r["pos"]: (r["book_id"], r["label"]) for r in
           sort_within(df, "user_id", "book_id", positional=True, input_order="ord").collect()}
    assert pos == {0: (1, "a"), 1: (2, "b"), 2: (3, "c")}
    whole = {r["book_id"]: r["label"] for r in sort_within(df, "user_id", "book_id").collect()}
    assert whole == {3: "a", 1: "b", 2: "c"}


def test_minmax_zero_range_gives_null_not_error(spark):
    from recprep.plans.ranking import minmax_scale
    df = spark.createDataFrame([("5",), ("5",), ("",)], "v string")
    assert [r[0] for r in minmax_scale(df, "v").collect()] == [None, None, None]
    df2 = spark.createDataFrame([("1",), ("3",), ("",), ("9000",)], "v string")
    got = [r[0] for r in minmax_scale(df2, "v").collect()]
    assert got == [0.0, 1.0, 0.5, 0.5]        # blank and outlier -> median 2.0


def test_items_missing_from_metadata_show_in_null_counts(spark):
    from recprep.operators.aggregates import null_counts
    from recprep.operators.joins import attach_features, attach_internal_id
    id_map = spark.createDataFrame([(1, "B1"), (2, "B2")], "book_id int, book_original_id string")
    meta = spark.createDataFrame([("B1", 7)], "book_original_id string, language int")
    feats = attach_internal_id(id_map, meta)
    ex = spark.createDataFrame([(10, 1), (11, 2), (12, 3)], "user_id int, book_id int")
    joined = attach_features(ex, feats)
    counts = null_counts(joined).first().asDict()
    assert counts == {"book_id": 0, "user_id": 0, "language": 2}
