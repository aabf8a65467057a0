"""End-to-end plans, plan-shape checks and the driver contract."""

import re

import __spark_entry__ as entry
from pyspark.sql import functions as F

from recprep import fixtures as fx
from recprep.plans import ranking
from recprep.plans import sequences as seqplan
from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "split" in df.columns and "label" in df.columns


def test_registered_queries_have_oracles_mostly():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    # the optional training-data queries bring brute-force tests of their own
    missing = {n for n in set(q) - set(o) if n != "pipeline" and not re.match(r"op\d+_", n)}
    assert not missing


def test_ranking_examples_has_no_python_eval(spark):
    feats, _ = ranking.build_item_features(fx.book_id_map(spark, SF_SMALL), fx.books(spark, SF_SMALL))
    ex = ranking.ranking_examples(fx.interactions(spark, SF_SMALL), feats)
    plan = _plan(ex)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan


def test_split_window_reuses_one_partitioning(spark):
    from recprep.operators.windows import split_by_ratio
    df = fx.interactions(spark, SF_SMALL)
    plan = _plan(split_by_ratio(df, "user_id", ["book_id"], 0.8))
    # row_number and the group count share one hash exchange on the key
    import re
    assert len(re.findall(r"Exchange hashpartitioning\(user_id#\d+, \d+\)", plan)) == 1


def test_sequence_sets_shapes(spark):
    sd = seqplan.prepare(fx.interactions(spark, "/root/testdata/sf0.01"))
    train = seqplan.bert_train_set(sd)
    ev = seqplan.bert_eval_set(sd)
    assert {r[0] for r in train.select(F.size("train_interactions")).distinct().collect()} == {20}
    sizes = ev.select(F.size("eval_seqs").alias("a"), F.size("candidate_items").alias("b")) \
              .distinct().collect()
    assert [(r["a"], r["b"]) for r in sizes] == [(20, 101)]
    assert ev.count() == sd.n_users
