"""Raw files -> prepared datasets -> evaluation, as a user of the scripts runs it."""

import math

import pytest
from pyspark.sql import functions as F

from recprep import fixtures as fx
from recprep.operators.models import fit_ranker
from recprep.plans import evaluation, ranking
from recprep.plans import sequences as seqplan
from recprep.session import staging_path
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def raw_dir(spark):
    d = staging_path(spark, "raw")
    fx.interactions(spark, SF_SMALL).write.option("header", True).csv(
        f"{d}/{ranking.INTERACTIONS_FILE}")
    fx.user_id_map(spark, SF_SMALL).write.option("header", True).csv(f"{d}/{ranking.USER_MAP_FILE}")
    fx.book_id_map(spark, SF_SMALL).write.option("header", True).csv(f"{d}/{ranking.BOOK_MAP_FILE}")
    fx.books(spark, SF_SMALL).write.json(f"{d}/{ranking.BOOKS_FILE}")
    return d


def _rows(df, cols):
    return sorted(tuple(round(v, 5) if isinstance(v, float) else v for v in r)
                  for r in df.select(*cols).collect())


@pytest.mark.parametrize("fmt", ["parquet", "tfrecord"])
def test_ranking_dataset_matches_in_memory_plan(spark, raw_dir, fmt):
    out_dir = staging_path(spark, f"ranking-{fmt}")
    out = ranking.prepare_ranking_dataset(spark, raw_dir, out_dir, write_format=fmt, n_parts=4)
    feats, _ = ranking.build_item_features(fx.book_id_map(spark, SF_SMALL), fx.books(spark, SF_SMALL),
                                           fx.user_id_map(spark, SF_SMALL))
    ex = ranking.ranking_examples(fx.interactions(spark, SF_SMALL), feats)
    cols = ["user_id", "item_id", "language", "publisher", "pub_decade", "avg_rating", "label"]
    if fmt == "parquet":
        got = spark.read.parquet(out["train"])
    else:
        from recprep.sources import tfrecord
        got = spark.read.format("tfrecord").schema(tfrecord.RANKING_TFRECORD_SCHEMA).load(out["train"])
    want = ex.where(F.col("split") == "train")
    assert _rows(got.select([F.col(c).cast("double") for c in cols]), cols) == \
        _rows(want.select([F.col(c).cast("double") for c in cols]), cols)
    assert out["train_rows"] == want.count()
    sizes = {r["name"]: r["size"] for r in spark.read.json(out["size_map"]).collect()}
    assert sizes["user"] == 150 and sizes["item"] == 200


def test_sequence_dataset_and_evaluation(spark, raw_dir):
    out_dir = staging_path(spark, "seq")
    out = seqplan.prepare_sequence_dataset(spark, raw_dir, out_dir)
    sd = seqplan.prepare(fx.interactions(spark, SF_SMALL))
    want = seqplan.bert_eval_set(sd)
    got = spark.read.parquet(out["eval"])
    key = ["user_id", "eval_seqs", "candidate_items"]
    assert sorted(tuple(map(str, r)) for r in got.select(*key).collect()) == \
        sorted(tuple(map(str, r)) for r in want.select(*key).collect())
    emb = fx.embeddings(spark, SF_SMALL)
    n = emb.count()
    items = sd.rows.select(F.col("book_id").alias("vec_id")).distinct()
    vecs = items.join(emb.withColumnRenamed("vec_id", "src"),
                      F.pmod("vec_id", F.lit(n)) == F.col("src")).drop("src")
    m = evaluation.evaluate_sequences(spark, out["eval"], item_vectors=vecs,
                                      mask_id=out["n_items"] + 1).first()
    assert 0.0 <= m["recall_10"] <= m["recall_20"] <= m["recall_50"] <= 1.0
    assert 0.0 <= m["ndcg_10"] <= 1.0


def test_evaluate_ranker(spark, raw_dir):
    out_dir = staging_path(spark, "ranking-eval")
    out = ranking.prepare_ranking_dataset(spark, raw_dir, out_dir, n_parts=2)
    model = fit_ranker(spark.read.parquet(out["train"]), max_iter=2, num_features=1 << 12)
    r = evaluation.evaluate_ranker(spark, model, out["eval"]).first()
    assert r["log_loss"] > 0 and 0 <= r["roc_auc"] <= 1 and abs(r["roc_auc"] - r["roc_auc_200"]) < 0.05


def test_cli_sequence_prep(spark, raw_dir, capsys):
    import json
    from recprep import cli
    out_dir = staging_path(spark, "cli")
    cli.main(["sequence-prep", "--data-dir", raw_dir, "--out-dir", out_dir])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["n_users"] > 0 and spark.read.parquet(out["train"]).count() > 0


def test_evaluate_sequences_with_user_model(spark, raw_dir):
    import numpy as np
    out_dir = staging_path(spark, "seq-model")
    out = seqplan.prepare_sequence_dataset(spark, raw_dir, out_dir)

    def make():
        def predict(seqs, cands):
            # a "model" that prefers the answer slot: position 0 scores highest
            s = np.zeros(cands.shape, dtype=np.float64)
            s[:, 0] = 1.0
            return s
        return predict

    m = evaluation.evaluate_sequences(spark, out["eval"], model_fn=make).first()
    assert m["recall_10"] == 1.0 and m["ndcg_10"] == 1.0
