"""Section 3.3: read written parts, batch and shard them, score and report.

``evaluate_ranker`` gives log-loss and AUC (exact and 200-threshold) for a
fitted ranker on example parts; ``evaluate_sequences`` gives Recall@K and
NDCG@K for eval sequences, with the built-in embedding scorer or a user
model function.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recprep.operators.filters import FEATURE_COLUMNS
from recprep.operators.metrics import (
    log_loss, ranking_metrics, ranking_metrics_arrays, roc_auc, roc_auc_thresholded,
)
from recprep.operators.models import predict_logits
from recprep.operators.scoring import candidate_score_arrays, score_candidates, scored_lists, write_vectors
from recprep.session import staged
from recprep.sources.files import read_examples


def evaluate_ranker(spark, model, examples_path: str) -> DataFrame:
    """One row: log_loss, roc_auc (exact), roc_auc_200 (thresholded)."""
    ex = read_examples(spark, examples_path, FEATURE_COLUMNS, "label")
    scored = predict_logits(model, ex).select("logit", F.col("label").cast("int").alias("label"))
    scored = staged(scored, "ranker-scores")
    row = {
        "log_loss": log_loss(scored).first()[0],
        "roc_auc": roc_auc(scored).first()[0],
        "roc_auc_200": roc_auc_thresholded(scored).first()[0],
    }
    return spark.createDataFrame([row], "log_loss double, roc_auc double, roc_auc_200 double")


def evaluate_sequences(spark, eval_path: str, item_vectors: DataFrame | None = None,
                       model_fn=None, mask_id: int | None = None, seq_len: int = 20,
                       n_cands: int = 101, ks=(10, 20, 50)) -> DataFrame:
    """Recall@K / NDCG@K means over eval rows (answer at position 0).

    A user model scores whole candidate arrays, so its metrics are computed
    row-wise on the arrays; so are those of the built-in scorer where it
    scores whole lists (vectors above the broadcast bounds) and no user
    repeats. Else it joins candidate embeddings and uses the long form."""
    ev = spark.read.parquet(eval_path).select("user_id", "eval_seqs", "candidate_items")
    if model_fn is not None:
        scored = candidate_score_arrays(ev, model_fn, seq_len=seq_len, n_cands=n_cands)
        return ranking_metrics_arrays(scored, "scores", ks=ks)
    vectors = write_vectors(item_vectors)
    if vectors.large and _one_row_each(ev, "user_id"):
        lists = scored_lists(ev, vectors, skip=(0,) if mask_id is None else (0, mask_id), written=True)
        if lists is not None:
            ranked = _ranked_answers(lists.where(F.size("scores") > 0))
            return ranking_metrics_arrays(ranked, "scores", "labels", ks=ks)
    scores = score_candidates(ev, item_vectors=vectors.table, mask_id=mask_id, seq_len=seq_len, n_cands=n_cands)
    # the answer is the candidate at position 0: no join is needed for labels
    return ranking_metrics(scores.withColumn("label", (F.col("position") == 0).cast("int")), ks=ks)


def _one_row_each(df: DataFrame, key: str) -> bool:
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("keys")).first()
    return row.rows == row.keys


def _ranked_answers(lists: DataFrame) -> DataFrame:
    """``labels`` in order of rank, as ``ranking_metrics`` ranks (NaN first,
    null last, ties by position), and falling ``scores``."""
    order = F.array_sort(F.transform("scores", lambda s, i: F.struct(
        s.isNull().alias("a"), (~F.coalesce(F.isnan(s), F.lit(False))).alias("b"), (-s).alias("c"), i.alias("pos"))))
    labels = F.transform(order, lambda t: F.when(t["pos"] == 0, 1).otherwise(0))
    return lists.select(labels.alias("labels")).withColumn(
        "scores", F.transform("labels", lambda x, i: (-i).cast("double")))
