"""Null keys, one-class input, typed vocabularies, steep popularity and the
range of the reproducible draw."""

import collections

import pytest
from pyspark.sql import functions as F

from recprep.functions.random import uniform
from recprep.operators.aggregates import item_popularity
from recprep.operators.encoding import reindex_ids
from recprep.operators.filters import filter_by_activity
from recprep.operators.indexing import rank_within
from recprep.operators.metrics import masked_cross_entropy, roc_auc, roc_auc_thresholded
from recprep.operators.sampling import popularity_table, sample_negatives, sample_negatives_excluding


def test_null_keys_rank_alike_with_both_methods(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), (1, 2), (1, 9), (2, 5), (None, 7)], "k int, v int")
    rows = [sorted(map(str, rank_within(df, "k", ["v"], method=m).select("k", "v", "pos", "n").collect()))
            for m in ("window", "global")]
    assert rows[0] == rows[1] and len(rows[0]) == 6


def test_activity_counts_null_as_a_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 1), (2, 1), (2, 2), (2, 3)], "user_id int, b int")
    got = filter_by_activity(df, "user_id", 2, 2).collect()
    assert [(r.user_id, r.b) for r in sorted(got, key=lambda r: r.b)] == [(None, 1), (None, 2)]
    assert filter_by_activity(df, "user_id", 2, 2, broadcast_rows=0).count() == 2


def test_draws_reach_positions_beyond_32_bits(spark):
    total = float(1 << 40)
    r = spark.range(2000).select(F.floor(uniform(1, "id") * total).cast("long").alias("r")).collect()
    assert len({x.r % 256 for x in r}) == 256          # low bits vary: not multiples of 2^8
    assert 0 <= min(r).r and max(r).r < total


def test_one_class_has_no_auc(spark):
    df = spark.createDataFrame([(0.5, 1), (1.5, 1)], "logit double, label int")
    assert roc_auc(df).first()[0] is None and roc_auc_thresholded(df).first()[0] is None


def test_label_outside_its_classes_raises(spark):
    df = spark.createDataFrame([(1, 1, 0.5, 9), (1, 2, 0.1, 9)], "token int, class int, logit double, label int")
    with pytest.raises(Exception, match="none of its classes"):
        masked_cross_entropy(df).collect()
    assert masked_cross_entropy(df.withColumn("label", F.lit(0))).first()[0] is None


def test_typed_vocabularies_keep_their_order(spark):
    df = spark.createDataFrame([(2, "a10"), (10, "a9"), (9, "b")], "user_id int, book_id string")
    got = {r.user_id: r.book_id for r in reindex_ids(df)["data"].collect()}
    assert got == {1: 1, 2: 3, 3: 2}                   # 2 < 9 < 10 and a10 < a9 < b


@pytest.mark.parametrize("n_items", [60, 700])
def test_steep_popularity_still_gives_k(spark, n_items):
    pop = spark.range(n_items).select(F.col("id").cast("int").alias("book_id"),
                                      F.greatest(F.lit(1), F.floor(F.lit(1e6) / F.pow(F.col("id") + 1, 3)))
                                      .cast("long").alias("count"))
    table = popularity_table(pop, "book_id")
    users = spark.range(6).select(F.col("id").cast("int").alias("user_id"), F.lit(3).cast("long").alias("n_pos"))
    taken = users.select("user_id", F.explode(F.array(*[F.lit(i) for i in (0, 1, 5)])).alias("book_id"))
    free = collections.Counter(r.user_id for r in sample_negatives(users, table, 50, 4).collect())
    assert set(free.values()) == {50}
    for most in (None, 3):
        got = sample_negatives_excluding(users, taken, table, 50, 4, max_positives=most).collect()
        by = collections.defaultdict(list)
        for r in got:
            by[r.user_id].append((r.neg_rank, r.book_id))
        for rows in by.values():
            assert [n for n, _ in sorted(rows)] == list(range(1, 51))
            assert len({b for _, b in rows}) == 50 and not {b for _, b in rows} & {0, 1, 5}
        # the law is kept: popular items come first far more often than late
        first = [dict(sorted(r))[1] for r in by.values()]
        assert sorted(first)[len(first) // 2] < n_items / 4
    all_of_it = sample_negatives_excluding(users, taken, table, 10 ** 6, 4, oversample=0)
    assert all_of_it.count() == 6 * (n_items - 3)


def test_item_popularity_skips_nothing(spark):
    df = spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "user_id int, book_id int")
    assert {r.book_id: r["count"] for r in item_popularity(df, "book_id", 3).collect()} == {1: 2, 2: 1}
