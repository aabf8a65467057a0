import collections

from pyspark.sql import functions as F

from recprep import fixtures as fx
from recprep.operators.aggregates import item_popularity
from recprep.operators.sampling import (
    popularity_draws, popularity_table, sample_negatives, sample_negatives_excluding,
)
from conftest import SF_SMALL


def _catalogue(spark):
    # 30 items, item i has i+1 interactions spread over 40 users
    rows = [(u, i) for i in range(30) for u in range(i + 1)]
    return spark.createDataFrame(rows, "user_id int, book_id int")


def test_draws_follow_popularity(spark):
    data = _catalogue(spark)
    total = data.count()
    table = popularity_table(item_popularity(data, "book_id", total), "book_id", total)
    users = spark.range(0, 200).select(F.col("id").cast("int").alias("user_id"),
                                       F.lit(200).alias("m"))
    draws = popularity_draws(users, table, seed=3).collect()
    assert len(draws) == 200 * 200
    counts = collections.Counter(r["book_id"] for r in draws)
    for i in range(30):
        share = counts[i] / len(draws)
        assert abs(share - (i + 1) / total) < 0.01


def test_exactly_k_distinct_excluding_positives(spark):
    data = _catalogue(spark)
    total = data.count()
    table = popularity_table(item_popularity(data, "book_id", total), "book_id", total)
    pos = data  # each user's own items are positives
    users = pos.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_pos"))
    negs = sample_negatives_excluding(users, pos, table, k=10, seed=1).collect()
    seen = collections.defaultdict(set)
    for r in pos.collect():
        seen[r["user_id"]].add(r["book_id"])
    by_user = collections.defaultdict(list)
    for r in negs:
        by_user[r["user_id"]].append((r["neg_rank"], r["book_id"]))
    for u, lst in by_user.items():
        items = [i for _, i in sorted(lst)]
        expect = min(10, 30 - len(seen[u]))
        assert len(items) == expect == len(set(items))
        assert sorted(r for r, _ in lst) == list(range(1, expect + 1))
        assert not set(items) & seen[u]


def test_user_who_saw_all_but_five(spark):
    data = _catalogue(spark)
    total = data.count()
    table = popularity_table(item_popularity(data, "book_id", total), "book_id", total)
    pos = spark.createDataFrame([(999, i) for i in range(25)], "user_id int, book_id int")
    users = spark.createDataFrame([(999, 25)], "user_id int, n_pos long")
    got = sorted(r["book_id"] for r in sample_negatives_excluding(users, pos, table, 10, 5).collect())
    assert got == [25, 26, 27, 28, 29]
    bounded = sample_negatives_excluding(users, pos, table, 10, 5, max_positives=25).collect()
    assert sorted(r["book_id"] for r in bounded) == [25, 26, 27, 28, 29]
    assert sorted(r["neg_rank"] for r in bounded) == [1, 2, 3, 4, 5]


def test_sample_negatives_allows_positives_and_is_distinct(spark):
    data = _catalogue(spark)
    total = data.count()
    table = popularity_table(item_popularity(data, "book_id", total), "book_id", total)
    users = spark.range(0, 20).select(F.col("id").cast("int").alias("user_id"))
    negs = sample_negatives(users, table, 25, 9).collect()
    by_user = collections.defaultdict(list)
    for r in negs:
        by_user[r["user_id"]].append(r["book_id"])
    assert len(by_user) == 20
    assert all(len(v) == 25 == len(set(v)) for v in by_user.values())


def test_no_cartesian_product_in_negative_sampling(spark):
    data = fx.interactions(spark, SF_SMALL).select("user_id", "book_id")
    total = data.count()
    table = popularity_table(item_popularity(data, "book_id", total), "book_id", total)
    users = data.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_pos"))
    negs = sample_negatives_excluding(users, data, table, 20, 42)
    plan = negs._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_bounded_array_path_equals_anti_join_path(spark):
    data = fx.interactions(spark, SF_SMALL).select("user_id", "book_id")
    total = data.count()
    table = popularity_table(item_popularity(data, "book_id", total), "book_id", total)
    users = data.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_pos"))
    a = sample_negatives_excluding(users, data, table, 30, 7).collect()
    b = sample_negatives_excluding(users, data, table, 30, 7, max_positives=250).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def _steep(spark, n_items=60, users=1):
    # item i has about 2 ** (i / 2) rows: most draws repeat the last few items
    return spark.createDataFrame([(i, int(2 ** (i / 2)) + 1) for i in range(n_items)], "book_id int, count long")


def test_short_users_never_meet_the_catalogue(spark, monkeypatch):
    """Rows made for a short user stay under a multiple of k and its excluded
    items, however many items there are."""
    from recprep.operators import sampling
    pop = spark.createDataFrame([(i, 10 ** 6 if i < 4 else 1) for i in range(20000)], "book_id int, count long")
    table = popularity_table(pop, "book_id")
    users = spark.range(0, 7).select(F.col("id").cast("int").alias("user_id"), F.lit(3).cast("long").alias("n_pos"))
    pos = users.select("user_id", F.explode(F.array(F.lit(0), F.lit(9), F.lit(-5))).alias("book_id"))
    asked, plain = [], sampling.spread
    monkeypatch.setattr(sampling, "spread", lambda df, expected_rows=None: asked.append(expected_rows) or plain(
        df, expected_rows=expected_rows))
    k = 10
    got = sample_negatives_excluding(users, pos, table, k=k, seed=2).collect()
    assert len(got) == 7 * k == len({(r.user_id, r.book_id) for r in got})
    assert not {r.book_id for r in got} & {0, 9}
    assert len(asked) >= 3                            # draws, head, arrivals
    # item -5 is not in the catalogue: 2 excluded items count
    assert asked[1] == 7 * (sampling.HEAD_FACTOR * k + 2) and asked[2] == 7 * sampling.TAIL_FACTOR * k
    by_user = collections.defaultdict(list)
    for r in got:
        by_user[r.user_id].append(r.neg_rank)
    assert all(sorted(v) == list(range(1, k + 1)) for v in by_user.values())


def test_top_up_follows_the_law_of_sampling_without_replacement(spark, monkeypatch):
    """First items by share, and every item's chance to be among the k, as in
    a simulation that draws without replacement; head and tail are both small,
    and arrivals often end too early."""
    import random
    from recprep.operators import sampling
    monkeypatch.setattr(sampling, "HEAD_FACTOR", 1)
    monkeypatch.setattr(sampling, "TAIL_FACTOR", 1)
    counts = {i: c for i, c in enumerate([400, 200, 90, 50, 30, 20, 10, 8, 5, 4, 3, 2])}
    table = popularity_table(spark.createDataFrame(list(counts.items()), "book_id int, count long"), "book_id")
    n, k = 4000, 3
    short = spark.range(0, n).select(F.col("id").cast("int").alias("user_id"), F.lit(0).cast("long").alias("_have"))
    pos = short.select("user_id", F.lit(1).alias("book_id"))
    none = short.select("user_id", F.lit(0).alias("book_id"), F.lit(1).alias("neg_rank")).limit(0)
    got = sampling._top_up(short, none, pos, table, k, "user_id", "neg_rank", 5).collect()
    assert len(got) == n * k == len({(r.user_id, r.book_id) for r in got})
    left = {i: c for i, c in counts.items() if i != 1}
    first = collections.Counter(r.book_id for r in got if r.neg_rank == 1)
    for i, c in left.items():
        assert abs(first[i] / n - c / sum(left.values())) < 0.025
    rnd, inside, trials = random.Random(1), collections.Counter(), 20000
    for _ in range(trials):
        pool = dict(left)
        for _ in range(k):
            i = rnd.choices(list(pool), pool.values())[0]
            inside[i] += 1
            del pool[i]
    have = collections.Counter(r.book_id for r in got)
    assert set(have) <= set(left) and 1 not in have
    assert all(abs(have[i] / n - inside[i] / trials) < 0.035 for i in left)


def test_draws_do_not_depend_on_how_arrivals_are_cut(spark, monkeypatch):
    from recprep.operators import sampling
    table = popularity_table(_steep(spark), "book_id")
    users = spark.range(0, 40).select(F.col("id").cast("int").alias("user_id"))
    monkeypatch.setattr(sampling, "HEAD_FACTOR", 2)
    results = []
    for factor in (1, 2, 16):
        monkeypatch.setattr(sampling, "TAIL_FACTOR", factor)
        results.append(sorted(map(tuple, sample_negatives(users, table, 12, 4).collect())))
    assert results[0] == results[1] == results[2] and len(results[0]) == 40 * 12


def test_most_users_make_only_the_first_part_of_their_draws(spark, monkeypatch):
    """A flat catalogue: the first part holds k distinct items, whichever path
    is taken; the sample is that of all draws made at once."""
    from recprep.operators import sampling
    pop = spark.createDataFrame([(i, 3) for i in range(5000)], "book_id int, count long")
    table = popularity_table(pop, "book_id")
    users = spark.createDataFrame([(u, 2) for u in range(20)] + [(99, 4990)], "user_id int, n_pos long")
    pos = spark.createDataFrame([(u, i) for u in range(20) for i in (u, u + 1)] + [(99, i) for i in range(4990)],
                                "user_id int, book_id int")
    made = []
    draws = sampling.popularity_draws

    def counted(users, *args, first=0, **kw):
        made.append(users.selectExpr(f"sum(greatest(m - {first}, 0))").first()[0] or 0)
        return draws(users, *args, first=first, **kw)

    def samples():
        return [sorted(map(tuple, sample_negatives_excluding(users, pos, table, 20, 3, max_positives=bound).collect()))
                for bound in (None, 5000)]

    monkeypatch.setattr(sampling, "popularity_draws", counted)
    got = samples()
    assert sum(made) <= 2 * (21 * 25 + 80 + 2 * 4990)
    monkeypatch.setattr(sampling, "FIRST_DRAWS", 10_000)
    assert got == samples() and got[0] == got[1] and len(got[0]) == 20 * 20 + 10


def test_ranges_above_the_broadcast_bound_are_hashed(spark):
    pop = spark.createDataFrame([(i, 3) for i in range(500)], "book_id int, count long")
    table = popularity_table(pop, "book_id")
    users = spark.range(0, 50).selectExpr("cast(id as int) user_id", "40 m")
    want = sorted(map(tuple, popularity_draws(users, table, 3).collect()))
    spark.conf.set("recprep.broadcast.maxRows", "10")
    try:
        draws = popularity_draws(users, table, 3)
        plan = draws._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
        assert sorted(map(tuple, draws.collect())) == want
    finally:
        spark.conf.unset("recprep.broadcast.maxRows")
