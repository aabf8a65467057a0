"""The fronts of both plans read their input once, candidates are moved once,
and what negatives are drawn from goes out packed."""

import pytest
from pyspark.sql import functions as F

from recprep.operators import sampling
from recprep.operators.encoding import fit_indexes
from recprep.operators.indexing import rank_within
from recprep.operators.metrics import candidate_labels, ranking_metrics
from recprep.operators.sampling import popularity_draws, popularity_table, sample_negatives_excluding
from recprep.operators.sequences import candidate_lists
from recprep.plans import ranking, sequences
from recprep.session import staged


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def counted(spark, n_users=3, each=25):
    """Interactions whose rows are counted as they are made."""
    runs = spark.sparkContext.accumulator(0)

    def seen(x):
        runs.add(1)
        return x

    rows = spark.range(0, n_users * each).select(
        (F.col("id") / each).cast("int").alias("user_id"),
        F.udf(seen, "int")((F.col("id") % each).cast("int")).alias("book_id"),
        *[F.lit(1).cast("tinyint").alias(c) for c in ("rating", "is_read", "is_reviewed")])
    return rows, runs


def test_ranking_examples_read_their_input_once(spark):
    rows, runs = counted(spark)
    feats = spark.range(0, 25).select(F.col("id").cast("int").alias("book_id"), *[
        F.lit(1).alias(c) for c in ranking.RANKING_COLUMNS[2:9]])
    ex = ranking.ranking_examples(rows, feats)
    assert ex.groupBy("split").count().collect() and runs.value == 75


def test_sequences_read_their_input_once(spark):
    rows, runs = counted(spark)
    sd = sequences.prepare(rows)
    assert (sd.total, sd.n_users, sd.n_items, runs.value) == (75, 3, 25, 75)


def test_position_and_size_take_one_window(spark):
    df = spark.createDataFrame([(1, 5), (1, 3), (None, 2), (1, 4), (None, 2)], "k int, v int")
    out = rank_within(df, "k", ["v"], method="window")
    assert final_plan(out).count("windowspecdefinition(") == 2      # two functions of
    assert final_plan(out).count("Window [") == 1                   # one node
    assert sorted((r.k or 0, r.v, r.pos, r.n) for r in out.collect()) == [
        (0, 2, 0, 2), (0, 2, 1, 2), (1, 3, 0, 3), (1, 4, 1, 3), (1, 5, 2, 3)]


def test_vocabularies_of_a_written_table(spark):
    df = staged(spark.createDataFrame([(2, 9), (2, None), (None, 7), (1, 9)], "a int, b int"), "vocabulary")
    one, two = (sorted(map(tuple, fit_indexes(df, ["a", "b"], 1, written=w).collect())) for w in (False, True))
    assert one == two == [("a", 1, 1), ("a", 2, 2), ("b", 7, 1), ("b", 9, 2)]


def test_metrics_find_candidates_in_place(spark):
    lists = spark.range(0, 40).select(F.col("id").cast("int").alias("user_id"), F.sequence(
        F.lit(5), F.lit(11)).alias("candidate_items"))
    long = candidate_labels(lists).withColumn("score", -F.col("position"))
    assert long.count() == 280
    plan = final_plan(ranking_metrics(long, ks=(1,), per_row=True))
    assert plan.count("hashpartitioning(user_id") == 1 and "RoundRobin" not in plan


def test_packed_ranges_give_the_same_draws(spark):
    # one range over many buckets, and many ranges in one
    pop = spark.createDataFrame([(i, 700 if i == 9 else 1 + i % 5) for i in range(500)], "book_id int, count long")
    table = popularity_table(pop, "book_id")
    users = spark.range(0, 50).selectExpr("cast(id as int) user_id", "40 m")
    want = sorted(map(tuple, popularity_draws(users, table, 3).collect()))
    spark.conf.set("recprep.broadcast.maxRows", "300")
    try:
        draws = popularity_draws(users, table, 3)
        plan = final_plan(draws)
        assert "BroadcastHashJoin" in plan and "ShuffledHashJoin" not in plan
        assert sorted(map(tuple, draws.collect())) == want
    finally:
        spark.conf.unset("recprep.broadcast.maxRows")


def _steep(spark):
    pop = spark.createDataFrame([(i, 10 ** 5 if i < 4 else 1) for i in range(3000)], "book_id int, count long")
    users = spark.range(0, 9).select(F.col("id").cast("int").alias("user_id"), F.lit(2).cast("long").alias("n_pos"))
    pos = users.select("user_id", F.explode(F.array(F.lit(0), F.lit(9))).alias("book_id"))
    return popularity_table(pop, "book_id"), users, pos


def test_users_of_few_positives_are_sampled_by_lists(spark, monkeypatch):
    """Without a bound, too; only users of many positives take the rows' way,
    and all get the same sample."""
    table, users, pos = _steep(spark)
    want = sorted(map(tuple, sample_negatives_excluding(users, pos, table, 10, 2, max_positives=5).collect()))
    assert len(want) == 90
    rows_way, asked = sampling._complete, []
    monkeypatch.setattr(sampling, "_complete", lambda users, *a: asked.append(users.count()) or rows_way(users, *a))
    assert sorted(map(tuple, sample_negatives_excluding(users, pos, table, 10, 2).collect())) == want and not asked
    more = users.withColumn("n_pos", F.when(F.col("user_id") == 3, 90_000).otherwise(F.col("n_pos")).cast("long"))
    many = sample_negatives_excluding(more, pos, table, 10, 2)
    # user 3 makes more draws; the others' samples are the same
    got = sorted(map(tuple, many.collect()))
    assert asked == [1] and [r for r in got if r[0] != 3] == [r for r in want if r[0] != 3] and len(got) == 90


def test_top_up_by_lists_equals_top_up_by_rows(spark):
    table, users, pos = _steep(spark)
    short = users.select("user_id", F.lit(1).cast("long").alias("_have"))
    chosen = users.select("user_id", F.lit(2).alias("book_id"), F.lit(1).alias("neg_rank"))
    one, two = (sorted(map(tuple, f(short, chosen, pos, table, 10, "user_id", "neg_rank", 5).collect()))
                for f in (sampling._top_up, sampling._top_up_rows))
    assert one == two and len(one) == 81


def test_lists_of_negatives(spark):
    table, users, pos = _steep(spark)
    rows = sample_negatives_excluding(users, pos, table, 10, 2, max_positives=5)
    lists = sample_negatives_excluding(users, pos, table, 10, 2, max_positives=5, as_lists=True)
    answers = users.select("user_id", F.lit(7).alias("eval_interactions")).unionByName(
        spark.createDataFrame([(99, 7)], "user_id int, eval_interactions int"))
    one, two = ({r.user_id: r.candidate_items for r in candidate_lists(answers, n).collect()} for n in (rows, lists))
    assert one == two and len(one[3]) == 11 and one[99] == [7]
    with pytest.raises(ValueError):
        sample_negatives_excluding(users, pos, table, 10, 2, as_lists=True)
