import math

import numpy as np
from pyspark.sql import functions as F

from recprep.operators import scoring
from recprep.operators.scoring import (
    assemble_item_vector, dot_score, embedding_lookup, embedding_lookup_seq, mean_vector,
    score_candidates, tower_transform,
)


def _table(spark):
    return spark.createDataFrame([(i, [float(i), float(i) / 2, 1.0]) for i in range(1, 10)],
                                 "vec_id int, embedding array<float>")


def test_lookup_and_sequence_lookup_keep_order(spark):
    t = _table(spark)
    df = spark.createDataFrame([(1, [3, 0, 5, 2])], "user_id int, seq array<int>")
    got = embedding_lookup_seq(df, "user_id", "seq", t).first()["seq_vecs"]
    assert [v[0] for v in got] == [3.0, 5.0, 2.0]
    one = embedding_lookup(spark.createDataFrame([(4,), (99,)], "k int"), "k", t).collect()
    assert {r["k"]: r["k_vec"] for r in one} == {4: [4.0, 2.0, 1.0], 99: None}


def test_mean_vector_dot_and_assemble(spark):
    df = spark.createDataFrame([(1, [[1.0, 2.0], [3.0, 6.0]], [0.5, 0.25])],
                               "k int, vs array<array<double>>, v array<double>")
    r = dot_score(mean_vector(df, "k", "vs", out="m"), "m", "v").first()
    assert r["m"] == [2.0, 4.0] and math.isclose(r["logit"], 2.0)
    a = assemble_item_vector(df.withColumn("x", F.lit(7)), ["v", "v"], ["x"]).first()["item_vec"]
    assert a == [0.5, 0.25, 0.5, 0.25, 7.0]


def test_tower_transform_matches_numpy(spark):
    rng = np.random.default_rng(1)
    w = (rng.normal(size=(3, 4)), rng.normal(size=4), rng.normal(size=(4, 2)), rng.normal(size=2))
    df = _table(spark)
    got = {r["vec_id"]: r["tower"] for r in tower_transform(df, "embedding", w).collect()}
    for i in range(1, 10):
        x = np.array([i, i / 2, 1.0])
        h = x @ w[0] + w[1]
        h = h / (1 + np.exp(-h))
        np.testing.assert_allclose(got[i], h @ w[2] + w[3], rtol=1e-9)


def test_score_candidates_builtin_and_model_fn(spark):
    t = _table(spark)
    df = spark.createDataFrame([(1, [0, 2, 4, 10], [3, 5, 7])],
                               "user_id int, eval_seqs array<int>, candidate_items array<int>")
    got = {r["position"]: (r["item"], r["score"]) for r in
           score_candidates(df, item_vectors=t, mask_id=10).collect()}
    u = np.mean([[2, 1, 1], [4, 2, 1]], axis=0)
    for p, item in enumerate([3, 5, 7]):
        assert got[p][0] == item
        assert math.isclose(got[p][1], float(u @ np.array([item, item / 2, 1.0])), rel_tol=1e-12)

    def make():
        def predict(seqs, cands):
            return (cands * 1.0 + seqs[:, -1:]).astype(np.float64)
        return predict

    user = score_candidates(df, model_fn=make, seq_len=4, n_cands=3).collect()
    assert sorted((r["position"], r["item"], r["score"]) for r in user) == \
        [(0, 3, 13.0), (1, 5, 15.0), (2, 7, 17.0)]


def test_large_tables_are_scored_by_cells(spark, monkeypatch):
    """Above the broadcast bounds: the same scores, and no exchange carries a
    candidate with a vector; null and unknown items, users without a history
    and repeated users and vectors as before."""
    t = spark.createDataFrame([(i, [i / 7, i / 3, 1.0]) for i in [*range(1, 200), 5]], "vec_id int, embedding array<float>")
    rows = [(u, [0, 1 + u % 60, 2 + u % 50, 300], [1 + (u * 7 + j) % 199 for j in range(30)] + [5, 999, None])
            for u in range(60)]
    rows += [(60, [0, 0, 0, 300], [3, 4]), (61, [1, 2, 3, 300], []), (7, [0, 0, 9, 300], [5, 6])]
    df = spark.createDataFrame(rows, "user_id int, eval_seqs array<int>, candidate_items array<int>")

    plans, write = {}, scoring.staged

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(scoring, "staged", noted)

    def scores():
        return score_candidates(df, item_vectors=t, mask_id=300).collect()

    def key(r):
        return r["user_id"], r["position"], r["item"] is None, r["item"] or 0, r["score"] is None, r["score"] or 0.0

    want = scores()
    assert list(plans) == ["item-vectors"]
    spark.conf.set("recprep.broadcast.maxRows", "10")
    try:
        got = scores()
    finally:
        spark.conf.unset("recprep.broadcast.maxRows")
    want, got = sorted(map(key, want)), sorted(map(key, got))
    assert [w[:5] for w in want] == [g[:5] for g in got]
    np.testing.assert_allclose([w[5] for w in want], [g[5] for g in got], rtol=1e-12)
    plan = plans["grid-scores"]
    top = plan[:plan.index("REPARTITION_BY_NUM")]
    assert "ShuffledHashJoin" in top and "ENSURE_REQUIREMENTS" not in top
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
