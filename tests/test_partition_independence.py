"""Same result whatever the number of shuffle partitions (1, 8, 64)."""

from pyspark.sql import functions as F

from recprep import fixtures as fx
from recprep.operators.aggregates import item_popularity
from recprep.operators.batching import shuffle_rows
from recprep.operators.sampling import popularity_table, sample_negatives_excluding
from recprep.operators.sequences import mask_tokens
from recprep.plans import sequences as seqplan
from conftest import SF_SMALL


def _with_partitions(spark, n, fn):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        return fn()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_negatives_and_masks_do_not_depend_on_partitioning(spark):
    def run():
        sd = seqplan.prepare(fx.interactions(spark, SF_SMALL), lo=5, hi=200)
        pop = item_popularity(sd.rows, "book_id", sd.total)
        table = popularity_table(pop, "book_id", sd.total)
        pos = sd.rows.where(F.col("role") != "test")
        users = pos.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_pos"))
        negs = sample_negatives_excluding(users, pos.select("user_id", "book_id"), table, 20, 42)
        masked = mask_tokens(seqplan.train_rows(sd), 0.2, sd.mask_id, 42)
        return (sorted(tuple(r) for r in negs.collect()),
                sorted(tuple(r) for r in masked.select("user_id", "pos", "train_interactions",
                                                       "labels").collect()))
    results = [_with_partitions(spark, n, run) for n in (1, 8, 64)]
    assert results[0] == results[1] == results[2]
    assert len(results[0][0]) > 0


def test_shuffle_permutation_does_not_depend_on_partitioning(spark):
    def run():
        pairs = fx.interactions(spark, SF_SMALL).select("user_id", "book_id")
        return sorted(tuple(r) for r in shuffle_rows(pairs, 42, 3, ["user_id", "book_id"]).collect())
    results = [_with_partitions(spark, n, run) for n in (1, 8, 64)]
    assert results[0] == results[1] == results[2]
