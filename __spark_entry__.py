"""

Every registered query reads the driver tables (or data Spark derives from
them through ``recprep.fixtures``) and runs the library's operators over the
whole tables. Float outputs are rounded to 6 digits and typed alike on both
sides so the order-insensitive value hash compares values, not formatting.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

# importable however this file is loaded (by path, from any directory)
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recprep import fixtures as fx
from recprep.functions.arrays import padding_mask
from recprep.functions.random import uniform_sql
from recprep.operators.aggregates import item_popularity, masked_ratio
from recprep.operators.encoding import check_reindexed, reindex_ids
from recprep.operators.filters import filter_by_activity
from recprep.operators.sampling import (
    popularity_draws, popularity_table, sample_negatives, sample_negatives_excluding,
)
from recprep.operators.sequences import (
    eval_sequences, mask_tokens, sliding_sequences, split_leave_last_lists,
)
from recprep.functions.random import uniform
from recprep.operators.batching import (
    assign_batches, epoch_positions, epoch_positions_sql, shard_batches, shard_even, shard_rows, shuffle_rows,
    steps_frame, to_jagged,
)
from recprep.operators.indexing import with_row_index
from recprep.operators.metrics import (
    candidate_labels, log_loss, masked_cross_entropy, metrics_by_batch, ranking_metrics,
    ranking_metrics_arrays, roc_auc, roc_auc_thresholded,
)
from recprep.operators.models import (
    fit_ranker, load_model, objective_history, predict_logits, save_model,
)
from recprep.operators.ordering import topk_candidates
from recprep.operators.scoring import (
    assemble_item_vector, dot_score, embedding_lookup, score_candidates, tower_transform,
)
from recprep.functions.scalar import (
    blank_to_unknown, clip_outlier_to, decade_of, fill_null, impute_blank, parse_year,
)
from recprep.operators.aggregates import (
    continuous_stats, distinct_values, null_counts, popularity_rank,
)
from recprep.operators.encoding import fit_index
from recprep.operators.filters import (
    FEATURE_COLUMNS, binarize, drop_columns, drop_null_rows, slice_rows, take_rows,
    with_constants,
)
from recprep.operators.joins import attach_labels, exclude_positives
from recprep.operators.ordering import head_per_group
from recprep.operators.sequences import (
    collect_sequence_chunks, collect_sequences, split_leave_last_chunks,
)
from recprep.operators.setops import array_difference, repeat_epochs
from recprep.operators.windows import (
    flag_last, running_offsets, sort_within, split_by_ratio, with_group_size,
)
from recprep.plans import evaluation, ranking
from recprep.plans import sequences as seqplan
from recprep.session import shuffles_end_with_writes, staged, staging_path
from recprep.sources import files, tfrecord
from recprep.streaming import streams

# The training-data operators and their pipeline are optional: only their
# absence is forgiven, any other import error is raised.
try:
    import corpus_pipeline
    from recprep.llm import queries as llm_queries
except ModuleNotFoundError as _e:
    if (_e.name or "").split(".")[0] != "corpus_pipeline" and not (_e.name or "").startswith("recprep.llm"):
        raise
    corpus_pipeline = llm_queries = None

SF_SMOKE = "/root/testdata/sf0.001"


def _r6(col: str) -> F.Column:
    """Round to 6 digits; a rounded zero is always +0.0 (no signed zero)."""
    r = F.round(F.col(col).cast("double"), 6)
    return F.when(r == 0, F.lit(0.0)).otherwise(r).alias(col)


# --------------------------------------------------------------------------
# Spark side
# --------------------------------------------------------------------------

def _features(spark, sf):
    feats, _ = ranking.build_item_features(fx.book_id_map(spark, sf), fx.books(spark, sf),
                                           fx.user_id_map(spark, sf))
    return feats


def q_ranking_examples(spark: SparkSession, sf: str) -> DataFrame:
    """Minimum slice: B1(10..250) -> B2 -> E3(0.8) -> C2 with I4 -> B7, tagged."""
    ex = ranking.ranking_examples(fx.interactions(spark, sf), _features(spark, sf))
    return ex.select(*[c for c in ex.columns if c not in ("avg_rating", "num_pages")],
                     _r6("avg_rating"), _r6("num_pages"))


def _r6c(c: F.Column, name: str) -> F.Column:
    r = F.round(c.cast("double"), 6)
    return F.when(r == 0, F.lit(0.0)).otherwise(r).alias(name)


def _arr(col: str) -> F.Column:
    """Array column as a comma-joined string (engine-neutral for the hash)."""
    return F.array_join(F.col(col).cast("array<string>"), ",").alias(col)


def _seq_data(spark, sf):
    return seqplan.prepare(fx.interactions(spark, sf))


def q_e4_split_leave_last(spark, sf):
    data = filter_by_activity(fx.interactions(spark, sf), "user_id", 20, 200)
    out = split_leave_last_lists(data, "user_id", "book_id", "book_id")
    return out.select("user_id", _arr("train_interactions"), "eval_interactions",
                      "test_interactions")


def q_e4_split_leave_last_chunks(spark, sf):
    """E4's lists in rows of at most seven items, by the global rank."""
    data = filter_by_activity(fx.interactions(spark, sf), "user_id", 20, 200)
    out = split_leave_last_chunks(data, "user_id", "book_id", "book_id", chunk=7, method="global")
    last = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select("user_id", "chunk", _arr("train_interactions"), last("eval_interactions"),
                      last("test_interactions"))


def q_d4_sequence_chunks(spark, sf):
    out = collect_sequence_chunks(fx.interactions(spark, sf), "user_id", ["book_id"], ["book_id", "rating"],
                                  chunk=7, method="global")
    return out.select("user_id", "chunk", _arr("book_id"), _arr("rating"))


def q_i3_reindex_ids(spark, sf):
    return _seq_data(spark, sf).rows.select("user_id", "book_id")


def q_d7_check_dense_ids(spark, sf):
    data = filter_by_activity(fx.interactions(spark, sf).select("user_id", "book_id"),
                              "user_id", 20, 200)
    return check_reindexed(reindex_ids(data))


def q_d1_item_popularity(spark, sf):
    sd = _seq_data(spark, sf)
    pop = item_popularity(sd.rows, "book_id", sd.total)
    return pop.select("book_id", "count", _r6("prob"))


def _masked(spark, sf):
    sd = _seq_data(spark, sf)
    return sd, mask_tokens(seqplan.train_rows(sd), 0.2, sd.mask_id, 42)


def q_j1_mask_tokens(spark, sf):
    _, m = _masked(spark, sf)
    return m.select("user_id", "pos", "train_interactions", "labels")


def q_d5_masked_ratio(spark, sf):
    sd, m = _masked(spark, sf)
    return masked_ratio(m, "train_interactions", sd.mask_id).select(_r6("masked_ratio"))


def q_j2_sliding_sequences(spark, sf):
    sd = _seq_data(spark, sf)
    w = sliding_sequences(seqplan.train_rows(sd), 5, 3, cols=["book_id"])
    return w.select("user_id", "window_start", _arr("book_id"))


def q_j7_bert_train_set(spark, sf):
    t = seqplan.bert_train_set(_seq_data(spark, sf))
    return t.select("user_id", "window_start", _arr("train_interactions"), _arr("labels"))


def q_j3_eval_sequences(spark, sf):
    sd = _seq_data(spark, sf)
    ev = sd.rows.where(F.col("role") == "eval").select(
        "user_id", F.col("book_id").alias("eval_interactions"))
    out = eval_sequences(seqplan.train_rows(sd), ev, 20, sd.mask_id)
    return out.select("user_id", "eval_interactions", _arr("eval_seqs"))


def _pop_table(sd):
    return popularity_table(item_popularity(sd.rows, "book_id", sd.total), "book_id", sd.total)


def q_j8_popularity_draws(spark, sf):
    sd = _seq_data(spark, sf)
    users = sd.rows.select("user_id").distinct().withColumn("m", F.lit(30))
    return popularity_draws(users, _pop_table(sd), 42).select("user_id", "draw", "book_id")


def q_j4_sample_negatives(spark, sf):
    sd = _seq_data(spark, sf)
    users = sd.rows.select("user_id").distinct()
    return sample_negatives(users, _pop_table(sd), 100, 42)


def q_j5_sample_negatives_excluding(spark, sf):
    sd = _seq_data(spark, sf)
    pos = sd.rows.where(F.col("role") != "test")
    users = pos.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_pos"))
    return sample_negatives_excluding(users, pos.select("user_id", "book_id"), _pop_table(sd),
                                      100, 42)


def _skewed(spark, sf):
    """Interactions whose item popularity is steep: item numbers cubed and
    rescaled, so that most of them meet in the low ones."""
    n = F.lit(spark.read.parquet(f"{sf}/part.parquet").agg(F.max("p_partkey")).first()[0]).cast("long")
    b = F.col("book_id").cast("long")
    return fx.interactions_raw(spark, sf).select(
        "user_id", (1 + F.floor(b * b * b / (n * n))).cast("int").alias("book_id")).distinct()


def q_j5_negatives_skewed(spark, sf):
    """J5 on steep popularity: short users draw further rounds."""
    sd = seqplan.prepare(_skewed(spark, sf))
    pos = sd.rows.where(F.col("role") != "test")
    users = pos.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_pos"))
    return sample_negatives_excluding(users, pos.select("user_id", "book_id"), _pop_table(sd),
                                      100, 42)


def q_e3_split_global(spark, sf):
    """E3 over the global rank, with a group of null users."""
    x = fx.interactions(spark, sf).select(
        F.col("user_id").alias("was"), F.when(F.col("user_id") % 17 != 0, F.col("user_id")).alias("user_id"),
        "book_id")
    return split_by_ratio(x, "user_id", ["book_id", "was"], 0.8, method="global")


def q_b1_null_key(spark, sf):
    """B1 where some users are null: they are one group."""
    x = fx.interactions(spark, sf).select(
        F.when(F.col("user_id") % 400 != 0, F.col("user_id")).alias("user_id"), "book_id")
    return filter_by_activity(x, "user_id", 20, 200)


def q_i3_reindex_mixed_types(spark, sf):
    """I3 with integer users and text items, each in its own order."""
    x = fx.interactions(spark, sf).select(
        "user_id", F.concat(F.lit("B"), F.col("book_id").cast("string")).alias("book_id"))
    return reindex_ids(x)["data"].select("user_id", "book_id")


def q_l2_one_class(spark, sf):
    """Exact and bucketed AUC of rows of one class: null."""
    x = fx.interactions(spark, sf).select((F.col("book_id") % 7 - 3.0).cast("double").alias("logit"),
                                          F.lit(1).alias("label"))
    return roc_auc(x).withColumnRenamed("roc_auc", "exact").crossJoin(
        roc_auc_thresholded(x).withColumnRenamed("roc_auc", "bucketed"))


def q_j7_bert_eval_set(spark, sf):
    e = seqplan.bert_eval_set(_seq_data(spark, sf))
    return e.select("user_id", _arr("eval_seqs"), _arr("candidate_items"))


# ---- batching, metrics, scoring ------------------------------------------

def _pairs(spark, sf):
    return fx.interactions(spark, sf).select("user_id", "book_id")


def q_k1_shuffle_rows(spark, sf):
    return shuffle_rows(_pairs(spark, sf), 42, 1, ["user_id", "book_id"])


def q_k1_epoch_positions(spark, sf):
    """Two more epochs over one dense index, written once: no sort, no shuffle."""
    rows = staged(with_row_index(_pairs(spark, sf), ["user_id", "book_id"]), "row-index")
    n = rows.count()
    for epoch in (1, 2):
        rows = epoch_positions(rows, n, 42, epoch, name=f"epoch_{epoch}")
    return rows


def q_k3_assign_batches(spark, sf):
    return assign_batches(_pairs(spark, sf), 2048, drop_last=True, order=["user_id", "book_id"])


def q_k4_shard_rows(spark, sf):
    sh = shuffle_rows(_pairs(spark, sf), 42, 1, ["user_id", "book_id"])
    return shard_rows(sh, 8).select("user_id", "book_id", "shard")


def q_k4_shard_of_rank(spark, sf):
    rows = with_row_index(_pairs(spark, sf), ["user_id", "book_id"])
    return shard_rows(rows, 8, rank=3).select("user_id", "book_id", "row_idx", "shard")


def q_k5_shard_even_unshuffled(spark, sf):
    users = fx.interactions(spark, sf).select("user_id").distinct()
    return shard_even(users, 16, 42, 0, ["user_id"], shuffle=False).select("user_id", "position", "shard",
                                                                           "local_pos")


def q_k5_shard_even(spark, sf):
    users = fx.interactions(spark, sf).select("user_id").distinct()
    return shard_even(users, 16, 42, 0, ["user_id"]).select("user_id", "position", "shard",
                                                            "local_pos")


def q_k6_plan_steps(spark, sf):
    ex = ranking.ranking_examples(fx.interactions(spark, sf), _features(spark, sf))
    return steps_frame(ex.where(F.col("split") == "train"), 2048, 1)


def _scored(spark, sf, digits=None):
    e = seqplan.bert_eval_set(_seq_data(spark, sf))
    c = candidate_labels(e, items="candidate_items")
    sc = uniform(7, "user_id", "position")
    if digits is not None:
        sc = F.round(sc, digits)
    return c.withColumn("score", sc)


def q_l5_candidate_labels(spark, sf):
    return _scored(spark, sf).select("user_id", "position", "item", "label")


def q_f3_topk_candidates(spark, sf):
    t = topk_candidates(_scored(spark, sf), "user_id", 10, score="score", pos="position")
    return t.select("user_id", "position", F.col("rank").cast("int").alias("rank"))


def _r6_all(df):
    return df.select(*[_r6(c) for c in df.columns])


def q_l3_l4_ranking_metrics(spark, sf):
    return _r6_all(ranking_metrics(_scored(spark, sf)))


def q_l3_l4_ranking_metrics_arrays(spark, sf):
    """The same metrics on array-form candidates: J9 scores per position,
    ranked inside each row (no explode, no shuffle)."""
    e = seqplan.bert_eval_set(_seq_data(spark, sf))
    sc = e.withColumn("scores", F.transform(
        F.sequence(F.lit(0), F.size("candidate_items") - 1),
        lambda p: uniform(7, "user_id", p)))
    return _r6_all(ranking_metrics_arrays(sc, "scores"))


def q_l3_l4_ranking_metrics_ties(spark, sf):
    return _r6_all(ranking_metrics(_scored(spark, sf, digits=2)))


def q_l6_metrics_by_batch(spark, sf):
    per = ranking_metrics(_scored(spark, sf), ks=(10,), per_row=True)
    idx = with_row_index(per, ["user_id"])
    b = shard_batches(idx, 2, 16)
    return _r6_all(metrics_by_batch(b, ["recall_10", "ndcg_10"]))


def q_l7_masked_cross_entropy(spark, sf):
    sc = _scored(spark, sf)
    answer = sc.where(F.col("position") == 0).select("user_id", F.col("item").alias("label"))
    rows = sc.drop("label").join(answer, "user_id").select(
        F.col("user_id").alias("token"), F.col("item").alias("class"),
        (F.col("score") * 4).alias("logit"), "label")
    return _r6_all(masked_cross_entropy(rows))


def q_l1_log_loss(spark, sf):
    return _r6_all(log_loss(fx.logits(spark, sf)))


def q_l2_roc_auc(spark, sf):
    return _r6_all(roc_auc(fx.logits(spark, sf)))


def q_l2_roc_auc_thresholded(spark, sf):
    return _r6_all(roc_auc_thresholded(fx.logits(spark, sf)))


def _vectors(spark, sf):
    emb = fx.embeddings(spark, sf)
    return emb, emb.count()


def q_m1_embedding_lookup(spark, sf):
    emb, n = _vectors(spark, sf)
    items = fx.book_id_map(spark, sf).select("book_id").withColumn(
        "vec_id", F.pmod(F.col("book_id"), F.lit(n)))
    v = embedding_lookup(items, "vec_id", emb, out="vec", table_rows=n)
    sq = F.aggregate(F.transform(F.col("vec").cast("array<double>"), lambda x: x * x),
                     F.lit(0.0), lambda a, x: a + x)
    return v.select("book_id", F.size("vec").alias("dim"),
                    F.round(F.sqrt(sq), 6).alias("l2"),
                    F.round(F.get("vec", 0).cast("double"), 6).alias("first"))


def q_m3_dot_score(spark, sf):
    emb, n = _vectors(spark, sf)
    p = _pairs(spark, sf).withColumn("uvec_id", F.pmod("user_id", F.lit(n))) \
                         .withColumn("ivec_id", F.pmod("book_id", F.lit(n)))
    p = embedding_lookup(p, "uvec_id", emb, out="u", table_rows=n)
    p = embedding_lookup(p, "ivec_id", emb, out="v", table_rows=n)
    return dot_score(p, "u", "v").select("user_id", "book_id", _r6("logit"))


def q_m2_assemble_item_vector(spark, sf):
    emb, n = _vectors(spark, sf)
    feats = _features(spark, sf)
    cols = ["book_id", "language", "is_ebook", "format", "publisher", "pub_decade"]
    for c in cols:
        feats = feats.withColumn(f"_k_{c}", F.pmod(F.col(c).cast("int"), F.lit(n)))
        feats = embedding_lookup(feats, f"_k_{c}", emb, out=f"e_{c}", table_rows=n)
    v = assemble_item_vector(feats, [f"e_{c}" for c in cols], ["avg_rating", "num_pages"])
    total = F.aggregate("item_vec", F.lit(0.0), lambda a, x: a + x)
    return v.select("book_id", F.size("item_vec").alias("dim"), F.round(total, 6).alias("total"))


def _tower_weights(dim: int = 64, width: int = 16):
    """Fixed caller-supplied weights for the M4 query (seeded; a parameter
    of the query, not data)."""
    import numpy as np
    rng = np.random.default_rng(0)
    return (rng.normal(0, dim ** -0.5, (dim, width)), rng.normal(0, 0.1, width),
            rng.normal(0, width ** -0.5, (width, width)), rng.normal(0, 0.1, width))


def q_m4_tower_transform(spark, sf):
    emb, n = _vectors(spark, sf)
    users = fx.interactions(spark, sf).select("user_id").distinct() \
              .withColumn("vec_id", F.pmod("user_id", F.lit(n)))
    users = embedding_lookup(users, "vec_id", emb, out="vec", table_rows=n)
    out = tower_transform(users, "vec", _tower_weights())
    total = F.aggregate("tower", F.lit(0.0), lambda a, x: a + x)
    return out.select("user_id", F.size("tower").alias("dim"), _r6c(total, "tower_sum"),
                      _r6c(F.get("tower", 0), "tower_first"))


def q_m5_score_candidates(spark, sf):
    emb, n = _vectors(spark, sf)
    sd = _seq_data(spark, sf)
    e = seqplan.bert_eval_set(sd)
    items = sd.rows.select(F.col("book_id").alias("vec_id")).distinct()
    vecs = items.join(emb.withColumnRenamed("vec_id", "src"),
                      F.pmod(F.col("vec_id"), F.lit(n)) == F.col("src")).drop("src")
    sc = score_candidates(e, item_vectors=vecs, mask_id=sd.mask_id)
    return sc.select("user_id", "position", "item", _r6("score"))


def q_m5_score_candidates_model(spark, sf):
    """M5 with a user's model function over Arrow batches."""
    def make():
        def predict(seqs, cands):
            return ((seqs.sum(axis=1, keepdims=True) + 7 * cands) % 101) / 101.0
        return predict

    e = seqplan.bert_eval_set(_seq_data(spark, sf))
    sc = score_candidates(e, model_fn=make, seq_len=20, n_cands=101)
    return sc.select("user_id", "position", "item", _r6("score"))


def q_m6_fit_ranker(spark, sf):
    """M6 and M7: fit with the defaults, score the eval rows, save, load and
    score again; what must hold of any right fit. The label is one that the
    features explain (the parity of the language code), so a fit that learns
    ranks far better than chance."""
    ex = ranking.ranking_examples(fx.interactions(spark, sf), _features(spark, sf))
    ex = staged(ex.withColumn("label", (F.col("language") % 2).cast("tinyint")), "ranker-examples")
    model = fit_ranker(ex.where(F.col("split") == "train"))
    objective = objective_history(model)
    path = staging_path(spark, "ranker")
    save_model(model, path)
    held = ex.where(F.col("split") == "eval")
    keys = ["user_id", "item_id"]
    scored = staged(predict_logits(model, held).select(*keys, "logit", "label"), "ranker-scores")
    again = predict_logits(load_model(path), held).select(*keys, F.col("logit").alias("again"))
    auc = roc_auc(scored.select("logit", F.col("label").cast("int").alias("label")))
    return scored.join(again, keys).agg(
        F.count("*").alias("eval_rows"),
        F.sum((~F.isnan("logit") & (F.abs("logit") < 1e300)).cast("long")).alias("finite_logits"),
        F.sum((F.abs(F.col("logit") - F.col("again")) > 1e-9).cast("long")).alias("reload_mismatches"),
    ).crossJoin(auc.select((F.col("roc_auc") >= 0.8).alias("auc_above_floor"))).withColumn(
        "objective_fell", F.lit(bool(objective[-1] <= objective[0])))


# ---- sources, sinks, streams ----------------------------------------------

def q_a1_read_interactions(spark, sf):
    path = staging_path(spark, "interactions-csv")
    fx.interactions(spark, sf).write.option("header", True).csv(path)
    return files.read_interactions(spark, path)


def q_a2_read_id_map(spark, sf):
    path = staging_path(spark, "book-map-csv")
    fx.book_id_map(spark, sf).toDF("id", "orig").write.option("header", True).csv(path)
    return files.read_id_map(spark, path, ["book_id", "book_original_id"], {"book_id": "int"})


def q_a3_read_item_metadata(spark, sf):
    path = staging_path(spark, "books-json")
    fx.books(spark, sf).write.option("compression", "gzip").json(path)
    return files.read_item_metadata(spark, path)


def _written_examples(spark, sf):
    ex = ranking.ranking_examples(fx.interactions(spark, sf), _features(spark, sf))
    out = staging_path(spark, "ranking-parquet")
    cols = [c for c in ex.columns if c != "split"]
    files.write_parts(ex.where(F.col("split") == "train").select(*cols), out, "train", 8,
                      shuffle=True, keys=["user_id", "item_id"])
    files.write_parts(ex.where(F.col("split") == "eval").select(*cols), out, "eval", 8,
                      order=["user_id", "item_id"])
    return out


def _rounded_examples(df):
    return df.select(*[c for c in df.columns if c not in ("avg_rating", "num_pages")],
                     _r6("avg_rating"), _r6("num_pages"))


def q_a6_write_parts(spark, sf):
    out = _written_examples(spark, sf)
    return _both_splits(spark, {p: f"{out}/{p}" for p in ("train", "eval")})


def _both_splits(spark, paths):
    parts = [spark.read.parquet(paths[p]).withColumn("split", F.lit(p)) for p in ("train", "eval")]
    return _rounded_examples(parts[0].unionByName(parts[1]))


def q_a4_dataset_size(spark, sf):
    out = _written_examples(spark, sf)
    rows = [(p, files.dataset_size(spark, f"{out}/{p}")) for p in ("train", "eval")]
    return spark.createDataFrame(rows, "split string, n_rows bigint")


def q_a5_read_examples(spark, sf):
    out = _written_examples(spark, sf)
    return _rounded_examples(files.read_examples(spark, f"{out}/eval", FEATURE_COLUMNS, "label"))


def q_a7_a8_tfrecord_roundtrip(spark, sf):
    tfrecord.register(spark)
    ex = ranking.ranking_examples(fx.interactions(spark, sf), _features(spark, sf))
    typed = ex.select(*[F.col(c).cast("bigint").alias(c) for c in FEATURE_COLUMNS[:7]],
                      F.col("avg_rating").cast("float"), F.col("num_pages").cast("float"),
                      F.col("label").cast("float"))
    typed = staged(typed, "ranking-typed")
    path = staging_path(spark, "ranking-tfrecord")
    tasks = ranking.RANKING_PARTS * files.files_for_bytes(typed, ranking.RANKING_PARTS)
    typed.repartitionByRange(tasks, "user_id", "item_id").write.format("tfrecord") \
         .mode("overwrite").save(path)
    back = spark.read.format("tfrecord").schema(tfrecord.RANKING_TFRECORD_SCHEMA).load(path)
    return back.select(*FEATURE_COLUMNS[:7], _r6("avg_rating"), _r6("num_pages"), _r6("label"))


def q_a9_size_map(spark, sf):
    _, sizes = ranking.build_item_features(fx.book_id_map(spark, sf), fx.books(spark, sf),
                                           fx.user_id_map(spark, sf))
    path = staging_path(spark, "size-map")
    files.write_size_map(sizes, path)
    return files.read_size_map(spark, path)


def q_a10_data_size(spark, sf):
    ex = ranking.ranking_examples(fx.interactions(spark, sf), _features(spark, sf))
    path = staging_path(spark, "data-size")
    files.write_data_size(spark, ex.where(F.col("split") == "train").count(), path, "train")
    return files.read_data_size(spark, path)


def q_n1_stream_examples(spark, sf):
    out = _written_examples(spark, sf)
    schema = spark.read.parquet(f"{out}/eval").schema
    sink = staging_path(spark, "stream-sink")
    streams.stream_to_table(streams.stream_examples(spark, f"{out}/eval", schema, 2), sink)
    return _rounded_examples(spark.read.parquet(sink))


def q_n2_stream_metrics(spark, sf):
    src = staging_path(spark, "logit-files")
    fx.logits(spark, sf).repartition(5).write.parquet(src)
    schema = spark.read.parquet(src).schema
    state = streams.run_stream_metrics(streams.stream_examples(spark, src, schema, 1))
    return _r6_all(streams.metrics_from_state(spark, state))


def q_ranking_dataset_from_raw_files(spark, sf):
    """Raw CSV/JSON files -> A1-A3 readers -> I4 + the ranking slice ->
    shuffled train and ordered eval parts (A6) -> both read back (A5)."""
    raw = staging_path(spark, "raw-ranking")
    fx.interactions(spark, sf).write.option("header", True).csv(f"{raw}/{ranking.INTERACTIONS_FILE}")
    fx.user_id_map(spark, sf).write.option("header", True).csv(f"{raw}/{ranking.USER_MAP_FILE}")
    fx.book_id_map(spark, sf).write.option("header", True).csv(f"{raw}/{ranking.BOOK_MAP_FILE}")
    fx.books(spark, sf).write.json(f"{raw}/{ranking.BOOKS_FILE}")
    out = ranking.prepare_ranking_dataset(spark, raw, staging_path(spark, "ranking-dataset"))
    return _both_splits(spark, out)


def q_sequence_dataset_from_raw_files(spark, sf):
    """Raw CSV -> J7's two sets -> parts (A6) -> both read back; eval rows have
    no window and give -1."""
    raw = staging_path(spark, "raw-sequences")
    fx.interactions(spark, sf).write.option("header", True).csv(f"{raw}/{ranking.INTERACTIONS_FILE}")
    out = seqplan.prepare_sequence_dataset(spark, raw, staging_path(spark, "sequence-parts"))
    train = spark.read.parquet(out["train"]).select(
        F.lit("train").alias("split"), "user_id", "window_start",
        _arr("train_interactions").alias("items"), _arr("labels").alias("targets"))
    ev = spark.read.parquet(out["eval"]).select(
        F.lit("eval").alias("split"), "user_id", F.lit(-1).alias("window_start"),
        _arr("eval_seqs").alias("items"), _arr("candidate_items").alias("targets"))
    return train.unionByName(ev)


def q_evaluate_sequence_dataset(spark, sf):
    """Raw CSV -> prepared sequence dataset (A1, J7, A6) -> written eval parts
    scored by the built-in scorer (M5) -> Recall/NDCG@10/20/50 (L3, L4)."""
    raw = staging_path(spark, "raw-interactions")
    with shuffles_end_with_writes(spark):
        fx.interactions(spark, sf).write.option("header", True).option("compression", "gzip").csv(
            f"{raw}/{ranking.INTERACTIONS_FILE}")
    out = seqplan.prepare_sequence_dataset(spark, raw, staging_path(spark, "seq-dataset"))
    emb, n = _vectors(spark, sf)
    items = spark.range(1, out["n_items"] + 1).select(F.col("id").cast("int").alias("vec_id"))
    vecs = items.join(emb.withColumnRenamed("vec_id", "src"),
                      F.pmod(F.col("vec_id"), F.lit(n)) == F.col("src")).drop("src")
    m = evaluation.evaluate_sequences(spark, out["eval"], item_vectors=vecs,
                                      mask_id=out["n_items"] + 1)
    return _r6_all(m)


# ---- projections, joins, aggregates, windows, sets, arrays ----------------

def q_b2_binarize(spark, sf):
    return binarize(fx.interactions(spark, sf)).select("user_id", "book_id", "label")


def q_b3_decade_of(spark, sf):
    b = fx.books(spark, sf)
    return b.select("book_id", "publication_year",
                    decade_of("publication_year").alias("decade"),
                    decade_of("publication_year", calendar=True).alias("calendar_decade"))


def q_b5_b6_impute_clip(spark, sf):
    b = fx.books(spark, sf)
    x = impute_blank("num_pages", 100.0, "float")
    return b.select("book_id", blank_to_unknown("language_code").alias("language"),
                    F.round(x.cast("double"), 6).alias("pages_imputed"),
                    F.round(clip_outlier_to(x, 2000, 100.0).cast("double"), 6).alias("pages_clipped"))


def q_b8_drop_null_rows(spark, sf):
    b = fx.books(spark, sf).select("book_id", parse_year("publication_year").alias("year"),
                                   F.col("num_pages").try_cast("int").alias("pages"))
    return drop_null_rows(b)


def q_b9_fill_null(spark, sf):
    b = fx.books(spark, sf)
    return b.select("book_id", fill_null(parse_year("publication_year"), 1900).alias("year"),
                    fill_null(F.col("num_pages").try_cast("int"), F.length("publisher")).alias("pages"))


def q_h11_padding_mask(spark, sf):
    t = seqplan.bert_train_set(_seq_data(spark, sf))
    m = t.withColumn("mask", F.transform(padding_mask("train_interactions"), lambda x: x.cast("int")))
    return m.select("user_id", "window_start", _arr("mask"))


def q_b10_take_rows(spark, sf):
    pairs = with_row_index(_pairs(spark, sf), ["user_id", "book_id"])
    split = split_by_ratio(pairs, "user_id", ["book_id"], 0.8)
    ids = split.where(F.col("split") == "train").select("row_idx")
    return take_rows(pairs, ids).select("row_idx", "user_id", "book_id")


def q_b11_slice_rows(spark, sf):
    pairs = with_row_index(_pairs(spark, sf), ["user_id", "book_id"])
    unit = -(-pairs.count() // 8)
    # eight contiguous slices are one division of the index
    return slice_rows(pairs, 0, 8 * unit).select(
        "user_id", "book_id", (F.floor(F.col("row_idx") / unit) + 1).cast("int").alias("part"))


def q_b13_with_constants(spark, sf):
    t = with_constants(_pairs(spark, sf), pad=(0, "int"), mask=(-1, "int"), flag=(1, "tinyint"))
    return drop_columns(t, "mask")


def q_i4_item_features(spark, sf):
    return _features(spark, sf).select(
        "book_id", "language", "is_ebook", "format", "publisher", "pub_decade",
        _r6("avg_rating"), _r6("num_pages"))


def q_i1_fit_index(spark, sf):
    b = fx.books(spark, sf).withColumn("publisher", blank_to_unknown("publisher"))
    return fit_index(b, "publisher", start=0)


def q_c3_attach_labels_raw(spark, sf):
    raw = fx.interactions_raw(spark, sf)
    act = filter_by_activity(raw, "user_id", 10, 250)
    split = split_by_ratio(act.select("user_id", "book_id"), "user_id", ["book_id"], 0.8)
    return attach_labels(split, act, ["user_id", "book_id"]).select(
        "user_id", "book_id", "split", "rating", "is_read")


def q_c5_exclude_positives(spark, sf):
    sd = _seq_data(spark, sf)
    users = sd.rows.select("user_id").distinct().withColumn("m", F.lit(30))
    d = popularity_draws(users, _pop_table(sd), 42)
    return exclude_positives(d, sd.rows, ["user_id", "book_id"])


def q_d2_continuous_stats(spark, sf):
    b = ranking.project_books(fx.books(spark, sf))
    parts = [continuous_stats(b, c).withColumn("column", F.lit(c))
             for c in ("avg_rating", "num_pages")]
    both = parts[0].unionByName(parts[1])
    return both.select("column", _r6("min"), _r6("max"), _r6("median"))


def q_d3_distinct_values(spark, sf):
    b = fx.books(spark, sf).withColumn("format", blank_to_unknown("format"))
    return distinct_values(b, "format")


def q_d6_null_counts(spark, sf):
    ex = ranking.ranking_examples(fx.interactions(spark, sf), _features(spark, sf))
    return null_counts(ex)


def q_e1_count_over(spark, sf):
    return with_group_size(_pairs(spark, sf), "user_id")


def q_e2_sort_within_positional(spark, sf):
    li = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                                 "l_quantity")
    o = fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    rows = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").cast("int").alias("user_id"),
        F.col("l_partkey").cast("int").alias("book_id"),
        F.col("l_quantity").alias("qty"), "l_orderkey", "l_linenumber")
    # file order stand-in; rows tied on all four are identical in the output
    rows = with_row_index(rows, ["l_orderkey", "l_linenumber", "book_id", "qty"],
                          name="input_order")
    out = sort_within(rows, "user_id", "book_id", positional=True, input_order="input_order")
    return out.select("user_id", "pos", "book_id", "qty")


def q_e2_sort_within(spark, sf):
    """E2, default form, by the global rank."""
    x = fx.interactions(spark, sf).select(
        F.when(F.col("user_id") % 17 != 0, F.col("user_id")).alias("user_id"),
        (F.col("book_id").cast("long") * 100000 + F.col("user_id")).alias("book_id"))
    return sort_within(x, "user_id", "book_id", method="global")


def q_e5_flag_last(spark, sf):
    sd = _seq_data(spark, sf)
    return flag_last(sd.rows).select("user_id", "book_id", "is_last")


def q_e6_running_offsets(spark, sf):
    t = seqplan.bert_train_set(_seq_data(spark, sf))
    lens = t.select("user_id", "window_start",
                    F.size(F.filter("train_interactions", lambda x: x != 0)).alias("len"))
    return running_offsets(lens, "len", ["user_id", "window_start"])


def q_f1_popularity_rank(spark, sf):
    sd = _seq_data(spark, sf)
    pop = item_popularity(sd.rows, "book_id", sd.total).drop("prob")
    return popularity_rank(pop)


def q_f2_tail_per_group(spark, sf):
    data = filter_by_activity(_pairs(spark, sf), "user_id", 20, 200)
    return head_per_group(data, "user_id", ["book_id"], 2, tail=True)


def q_f2_head_per_group(spark, sf):
    data = with_group_size(filter_by_activity(_pairs(spark, sf), "user_id", 20, 200), "user_id")
    return head_per_group(data, "user_id", ["book_id"], F.ceil(F.col("n") * 0.25))


def q_g2_array_difference(spark, sf):
    sd = _seq_data(spark, sf)
    users = sd.rows.select("user_id").distinct().withColumn("m", F.lit(30))
    d = popularity_draws(users, _pop_table(sd), 42)
    drawn = collect_sequences(d, "user_id", ["draw"], ["book_id"], suffix="_drawn")
    seen = collect_sequences(sd.rows, "user_id", ["pos"], ["book_id"], suffix="_seen")
    j = array_difference(drawn.join(seen, "user_id"), "book_id_drawn", "book_id_seen")
    return j.select("user_id", _arr("difference"))


def q_g3_repeat_epochs(spark, sf):
    return repeat_epochs(_pairs(spark, sf), 3)


def q_h12_to_jagged(spark, sf):
    t = seqplan.bert_train_set(_seq_data(spark, sf))
    b = assign_batches(t, 16, order=["user_id", "window_start"])
    j = to_jagged(b, "batch_id", "row_idx", "train_interactions")
    return j.select("batch_id", F.size("values").alias("n_values"), _arr("values"), _arr("lengths"),
                    _arr("offsets"))


def entry(spark: SparkSession) -> DataFrame:
    return q_ranking_examples(spark, SF_SMOKE)


def _library_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "ranking_examples": q_ranking_examples,
        "e4_split_leave_last": q_e4_split_leave_last,
        "e4_split_leave_last_chunks": q_e4_split_leave_last_chunks,
        "d4_sequence_chunks": q_d4_sequence_chunks,
        "b9_fill_null": q_b9_fill_null,
        "h11_padding_mask": q_h11_padding_mask,
        "f2_head_per_group": q_f2_head_per_group,
        "k1_epoch_positions": q_k1_epoch_positions,
        "k4_shard_of_rank": q_k4_shard_of_rank,
        "k5_shard_even_unshuffled": q_k5_shard_even_unshuffled,
        "m5_score_candidates_model": q_m5_score_candidates_model,
        "sequence_dataset_from_raw_files": q_sequence_dataset_from_raw_files,
        "i3_reindex_ids": q_i3_reindex_ids,
        "d7_check_dense_ids": q_d7_check_dense_ids,
        "d1_item_popularity": q_d1_item_popularity,
        "j1_mask_tokens": q_j1_mask_tokens,
        "d5_masked_ratio": q_d5_masked_ratio,
        "j2_sliding_sequences": q_j2_sliding_sequences,
        "j7_bert_train_set": q_j7_bert_train_set,
        "j3_eval_sequences": q_j3_eval_sequences,
        "j8_popularity_draws": q_j8_popularity_draws,
        "j4_sample_negatives": q_j4_sample_negatives,
        "j5_sample_negatives_excluding": q_j5_sample_negatives_excluding,
        "j5_negatives_skewed": q_j5_negatives_skewed,
        "e3_split_global": q_e3_split_global,
        "b1_null_key": q_b1_null_key,
        "i3_reindex_mixed_types": q_i3_reindex_mixed_types,
        "l2_one_class": q_l2_one_class,
        "j7_bert_eval_set": q_j7_bert_eval_set,
        "k1_shuffle_rows": q_k1_shuffle_rows,
        "k3_assign_batches": q_k3_assign_batches,
        "k4_shard_rows": q_k4_shard_rows,
        "k5_shard_even": q_k5_shard_even,
        "k6_plan_steps": q_k6_plan_steps,
        "l5_candidate_labels": q_l5_candidate_labels,
        "f3_topk_candidates": q_f3_topk_candidates,
        "l3_l4_ranking_metrics": q_l3_l4_ranking_metrics,
        "l3_l4_ranking_metrics_ties": q_l3_l4_ranking_metrics_ties,
        "l3_l4_ranking_metrics_arrays": q_l3_l4_ranking_metrics_arrays,
        "l6_metrics_by_batch": q_l6_metrics_by_batch,
        "l7_masked_cross_entropy": q_l7_masked_cross_entropy,
        "l1_log_loss": q_l1_log_loss,
        "l2_roc_auc": q_l2_roc_auc,
        "l2_roc_auc_thresholded": q_l2_roc_auc_thresholded,
        "m1_embedding_lookup": q_m1_embedding_lookup,
        "m2_assemble_item_vector": q_m2_assemble_item_vector,
        "m3_dot_score": q_m3_dot_score,
        "m4_tower_transform": q_m4_tower_transform,
        "m5_score_candidates": q_m5_score_candidates,
        "m6_fit_ranker": q_m6_fit_ranker,
        "a1_read_interactions": q_a1_read_interactions,
        "a2_read_id_map": q_a2_read_id_map,
        "a3_read_item_metadata": q_a3_read_item_metadata,
        "a4_dataset_size": q_a4_dataset_size,
        "a5_read_examples": q_a5_read_examples,
        "a6_write_parts": q_a6_write_parts,
        "a7_a8_tfrecord_roundtrip": q_a7_a8_tfrecord_roundtrip,
        "a9_size_map": q_a9_size_map,
        "a10_data_size": q_a10_data_size,
        "n1_stream_examples": q_n1_stream_examples,
        "n2_stream_metrics": q_n2_stream_metrics,
        "b2_binarize": q_b2_binarize,
        "b3_decade_of": q_b3_decade_of,
        "b5_b6_impute_clip": q_b5_b6_impute_clip,
        "b8_drop_null_rows": q_b8_drop_null_rows,
        "b10_take_rows": q_b10_take_rows,
        "b11_slice_rows": q_b11_slice_rows,
        "b13_with_constants": q_b13_with_constants,
        "i4_item_features": q_i4_item_features,
        "i1_fit_index": q_i1_fit_index,
        "c3_attach_labels_raw": q_c3_attach_labels_raw,
        "c5_exclude_positives": q_c5_exclude_positives,
        "d2_continuous_stats": q_d2_continuous_stats,
        "d3_distinct_values": q_d3_distinct_values,
        "d6_null_counts": q_d6_null_counts,
        "e1_count_over": q_e1_count_over,
        "e2_sort_within_positional": q_e2_sort_within_positional,
        "e2_sort_within": q_e2_sort_within,
        "e5_flag_last": q_e5_flag_last,
        "e6_running_offsets": q_e6_running_offsets,
        "f1_popularity_rank": q_f1_popularity_rank,
        "f2_tail_per_group": q_f2_tail_per_group,
        "g2_array_difference": q_g2_array_difference,
        "g3_repeat_epochs": q_g3_repeat_epochs,
        "h12_to_jagged": q_h12_to_jagged,
        "evaluate_sequence_dataset": q_evaluate_sequence_dataset,
        "ranking_dataset_from_raw_files": q_ranking_dataset_from_raw_files,
    }


# --------------------------------------------------------------------------
# DuckDB oracles
# --------------------------------------------------------------------------

FIX_INTERACTIONS_RAW = """
interactions_raw AS (
  SELECT CAST(o.o_custkey AS INT) AS user_id,
         CAST(l.l_partkey AS INT) AS book_id,
         CAST(1 + floor((l.l_quantity - 1) / 10) AS TINYINT) AS rating,
         CAST(CASE WHEN l.l_returnflag <> 'N' THEN 1 ELSE 0 END AS TINYINT) AS is_read,
         CAST(CASE WHEN l.l_linestatus = 'F' THEN 1 ELSE 0 END AS TINYINT) AS is_reviewed
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

FIX_INTERACTIONS = FIX_INTERACTIONS_RAW + """,
interactions AS (
  SELECT user_id, book_id, max(rating) AS rating,
         max(is_read) AS is_read, max(is_reviewed) AS is_reviewed
  FROM interactions_raw GROUP BY user_id, book_id)"""

FIX_SKEWED = FIX_INTERACTIONS_RAW + """,
interactions AS (
  SELECT DISTINCT user_id, CAST(1 + CAST(book_id AS BIGINT) * book_id * book_id // (n * n) AS INT) AS book_id
  FROM interactions_raw, (SELECT CAST(max(p_partkey) AS BIGINT) AS n FROM part) m)"""

FIX_BOOK_MAP = """
book_id_map AS (
  SELECT CAST(p_partkey AS INT) AS book_id,
         'B' || CAST(p_partkey AS VARCHAR) AS book_original_id FROM part)"""

FIX_USER_MAP = """
user_id_map AS (
  SELECT CAST(c_custkey AS INT) AS user_id,
         'U' || CAST(c_custkey AS VARCHAR) AS user_original_id FROM customer)"""

FIX_BOOKS = """
books AS (
  SELECT 'B' || CAST(p_partkey AS VARCHAR) AS book_id,
    CASE WHEN p_partkey % 7 = 0 THEN '' ELSE p_brand END AS language_code,
    CASE WHEN p_size % 2 = 0 THEN 'true' ELSE 'false' END AS is_ebook,
    CASE WHEN p_partkey % 11 = 0 THEN ''
         ELSE CAST(1 + p_size % 4 AS VARCHAR) || '.' || CAST(p_partkey % 100 AS VARCHAR)
    END AS average_rating,
    CASE WHEN p_partkey % 19 = 0 THEN '' ELSE p_type END AS format,
    CASE WHEN p_partkey % 23 = 0 THEN '' ELSE p_name END AS publisher,
    CASE WHEN p_partkey % 13 = 0 THEN '' WHEN p_partkey % 97 = 0 THEN '5000'
         ELSE CAST(p_size * 20 AS VARCHAR) END AS num_pages,
    CASE WHEN p_partkey % 9 = 0 THEN '' WHEN p_partkey % 17 = 0 THEN 'abcd'
         ELSE CAST(1895 + p_partkey % 140 AS VARCHAR) END AS publication_year
  FROM part)"""


def _decade_sql(col: str) -> str:
    y = (f"(CASE WHEN regexp_full_match(trim({col}), '[0-9]{{4}}') "
         f"THEN TRY_CAST(trim({col}) AS INT) END)")
    return (f"(CASE WHEN {y} BETWEEN 1900 AND 2030 THEN "
            f"CAST(CAST(greatest(1900, floor(({y} - 1) / 10) * 10) AS INT) AS VARCHAR) || 's' "
            f"ELSE 'unknown' END)")


def _unknown_sql(col: str) -> str:
    return f"(CASE WHEN {col} IS NULL OR {col} = '' THEN 'unknown' ELSE {col} END)"


def _stats_sql(col: str) -> str:
    return f"""
st_{col} AS (
  SELECT min(v) AS mn, max(v) AS mx, round(median(v), 4) AS med
  FROM (SELECT CAST(CASE WHEN {col} <> '' THEN TRY_CAST({col} AS FLOAT) END AS DOUBLE) AS v FROM bp)
  WHERE v IS NOT NULL AND v <= 2000.0)"""


def _scaled_sql(col: str) -> str:
    x = (f"COALESCE(CASE WHEN bp.{col} <> '' THEN TRY_CAST(bp.{col} AS FLOAT) END, "
         f"CAST(st_{col}.med AS FLOAT))")
    x = f"CAST(CASE WHEN {x} > 2000.0 THEN CAST(st_{col}.med AS FLOAT) ELSE {x} END AS DOUBLE)"
    return f"CAST(({x} - st_{col}.mn) / (st_{col}.mx - st_{col}.mn) AS FLOAT)"


FEATURES_SQL = FIX_BOOK_MAP + "," + FIX_BOOKS + """,
bp AS (
  SELECT book_id AS book_original_id, language_code AS language, is_ebook,
         average_rating AS avg_rating, format, publisher, num_pages,
         publication_year AS pub_year FROM books),""" + _stats_sql("avg_rating") + "," + \
    _stats_sql("num_pages") + f""",
enc AS (
  SELECT bp.book_original_id,
    CAST(dense_rank() OVER (ORDER BY {_unknown_sql('bp.language')}) - 1 AS SMALLINT) AS language,
    CAST(dense_rank() OVER (ORDER BY {_unknown_sql('bp.is_ebook')}) - 1 AS TINYINT) AS is_ebook,
    CAST(dense_rank() OVER (ORDER BY {_unknown_sql('bp.format')}) - 1 AS SMALLINT) AS format,
    CAST(dense_rank() OVER (ORDER BY {_unknown_sql('bp.publisher')}) - 1 AS INT) AS publisher,
    CAST(dense_rank() OVER (ORDER BY {_decade_sql('bp.pub_year')}) - 1 AS TINYINT) AS pub_decade,
    {_scaled_sql('avg_rating')} AS avg_rating,
    {_scaled_sql('num_pages')} AS num_pages
  FROM bp, st_avg_rating, st_num_pages),
features AS (
  SELECT m.book_id, e.language, e.is_ebook, e.format, e.publisher, e.pub_decade,
         e.avg_rating, e.num_pages
  FROM book_id_map m LEFT JOIN enc e ON m.book_original_id = e.book_original_id)"""

RANKING_SQL = "WITH " + FIX_INTERACTIONS + "," + FEATURES_SQL + """,
active AS (SELECT user_id FROM interactions GROUP BY user_id HAVING count(*) BETWEEN 10 AND 250),
r AS (
  SELECT user_id, book_id, is_read, is_reviewed,
         CAST(CASE WHEN rating >= 4 THEN 1 ELSE 0 END AS TINYINT) AS label,
         row_number() OVER (PARTITION BY user_id ORDER BY book_id) AS rn,
         count(*) OVER (PARTITION BY user_id) AS n
  FROM interactions WHERE user_id IN (SELECT user_id FROM active))
SELECT r.user_id, r.book_id AS item_id, f.language, f.is_ebook, f.format, f.publisher,
       f.pub_decade, round(CAST(f.avg_rating AS DOUBLE), 6) AS avg_rating,
       round(CAST(f.num_pages AS DOUBLE), 6) AS num_pages,
       r.is_read, r.is_reviewed, r.label,
       CASE WHEN r.rn <= ceil(r.n * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'eval' END AS split
FROM r LEFT JOIN features f ON r.book_id = f.book_id
"""


# Sequence data: users with 20..200 rows, dense 1-based ids, positions.
SEQ_BASE = "WITH " + FIX_INTERACTIONS + """,
act AS (SELECT user_id FROM interactions GROUP BY user_id HAVING count(*) BETWEEN 20 AND 200),
base AS (SELECT user_id, book_id FROM interactions WHERE user_id IN (SELECT user_id FROM act)),
umap AS (SELECT user_id, CAST(row_number() OVER (ORDER BY user_id) AS INT) AS uid
         FROM (SELECT DISTINCT user_id FROM base) t),
imap AS (SELECT book_id, CAST(row_number() OVER (ORDER BY book_id) AS INT) AS iid
         FROM (SELECT DISTINCT book_id FROM base) t),
seq AS (SELECT umap.uid AS user_id, imap.iid AS book_id FROM base
        JOIN umap ON base.user_id = umap.user_id JOIN imap ON base.book_id = imap.book_id),
consts AS (SELECT (SELECT count(*) FROM seq) AS total, (SELECT count(*) FROM imap) AS n_items,
                  (SELECT count(*) FROM imap) + 1 AS mask_id),
srows AS (SELECT user_id, book_id,
                 CAST(row_number() OVER (PARTITION BY user_id ORDER BY book_id) - 1 AS INT) AS pos,
                 count(*) OVER (PARTITION BY user_id) AS n FROM seq),
train AS (SELECT user_id, book_id, pos, CAST(n - 2 AS INT) AS n_train FROM srows WHERE pos < n - 2),
masked AS (
  SELECT t.user_id, t.pos, t.n_train,
    CAST(CASE WHEN """ + uniform_sql(42, "t.user_id", "t.pos") + """ <= CAST(0.2 AS DOUBLE)
              OR t.pos = t.n_train - 1 THEN c.mask_id ELSE t.book_id END AS INT) AS train_interactions,
    CAST(CASE WHEN """ + uniform_sql(42, "t.user_id", "t.pos") + """ <= CAST(0.2 AS DOUBLE)
              OR t.pos = t.n_train - 1 THEN t.book_id ELSE 0 END AS INT) AS labels
  FROM train t, consts c),
ev AS (SELECT user_id, book_id AS eval_interactions FROM srows WHERE pos = n - 2),
tails AS (SELECT user_id, list(book_id ORDER BY pos) AS l FROM train
          WHERE pos >= n_train - 19 GROUP BY user_id),
eseq AS (
  SELECT ev.user_id, ev.eval_interactions,
         list_slice(list_concat(list_resize(CAST([] AS INT[]), 20, 0),
                                coalesce(tails.l, CAST([] AS INT[])),
                                CAST([c.mask_id] AS INT[])), -20, -1) AS eval_seqs
  FROM ev LEFT JOIN tails ON ev.user_id = tails.user_id, consts c),
pop AS (SELECT book_id, count(*) AS cnt FROM seq GROUP BY book_id),
cum AS (SELECT book_id, cnt,
               sum(cnt) OVER (ORDER BY book_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
               - cnt AS start FROM pop),
prank AS (SELECT book_id, row_number() OVER (ORDER BY cnt DESC, book_id) AS pop_rank FROM pop)"""


def _windows_sql(src: str, cols: list[str], seq_len: int, step: int) -> str:
    lists = ", ".join(f"list(s.{c} ORDER BY s.pos) AS l_{c}" for c in cols)
    outs = ", ".join(f"array_to_string(list_resize(l_{c}, {seq_len}, 0), ',') AS {c}" for c in cols)
    return f"""
SELECT user_id, CAST(window_start AS INT) AS window_start, {outs} FROM (
  SELECT w.user_id, w.window_start, {lists}
  FROM (SELECT user_id, unnest(range(0, n_train, {step})) AS window_start
        FROM (SELECT DISTINCT user_id, n_train FROM {src}) d) w
  JOIN {src} s ON s.user_id = w.user_id AND s.pos >= w.window_start
              AND s.pos < w.window_start + {seq_len}
  GROUP BY w.user_id, w.window_start) x"""


def _draws_sql(users: str, m_expr: str, seed: int = 42, round_no: int = 0) -> str:
    u = uniform_sql(seed, round_no, "d.user_id", "d.draw")
    return f"""
SELECT d.user_id, d.draw, cum.book_id FROM (
  SELECT d.user_id, d.draw, CAST(floor({u} * c.total) AS BIGINT) AS r
  FROM (SELECT user_id, CAST(unnest(range({m_expr})) AS INT) AS draw FROM {users}) d, consts c) d
JOIN cum ON d.r >= cum.start AND d.r < cum.start + cum.cnt"""


def _negatives_sql(excluding: bool, k: int = 100, base: str = "") -> str:
    """Draws; what a user lacks comes by exponential waiting times, of the head
    one by one, of the tail by 8k arrivals of a Poisson process (``_top_up``)."""
    if excluding:
        users = ("nusers AS (SELECT user_id, count(*) AS n_pos FROM srows "
                 "WHERE pos < n - 1 GROUP BY user_id),\n"
                 "posi AS (SELECT user_id, book_id FROM srows WHERE pos < n - 1),\n"
                 "gone AS (SELECT user_id, count(DISTINCT book_id) AS gone FROM posi GROUP BY user_id),")
        m_expr = f"{4 * k} + 2 * n_pos"
        anti = "AND NOT EXISTS (SELECT 1 FROM posi p WHERE p.user_id = x.user_id AND p.book_id = x.book_id)"
    else:
        users = ("nusers AS (SELECT DISTINCT user_id, 0 AS n_pos FROM srows),\n"
                 "gone AS (SELECT user_id, 0 AS gone FROM nusers),")
        m_expr = f"{4 * k}"
        anti = ""
    return (base or SEQ_BASE) + f""",
{users}
draws AS ({_draws_sql("nusers", m_expr)}),
firsts AS (SELECT user_id, book_id, min(draw) AS draw FROM draws x WHERE TRUE {anti}
           GROUP BY user_id, book_id),
chosen AS (SELECT user_id, book_id, CAST(neg_rank AS INT) AS neg_rank FROM (
             SELECT user_id, book_id, row_number() OVER (PARTITION BY user_id ORDER BY draw) AS neg_rank
             FROM firsts) t WHERE neg_rank <= {k}),
ranks AS (SELECT p.book_id, p.cnt, r.pop_rank,
                 CAST(sum(p.cnt) OVER (ORDER BY r.pop_rank) AS BIGINT) AS upto
          FROM pop p JOIN prank r ON p.book_id = r.book_id),
short AS (SELECT u.user_id, coalesce(h.have, 0) AS have, least(c.n_items, {8 * k} + coalesce(g.gone, 0)) AS head,
                 least({k}, c.n_items - coalesce(g.gone, 0)) - coalesce(h.have, 0) AS need
          FROM nusers u CROSS JOIN consts c
          LEFT JOIN (SELECT user_id, count(*) AS have FROM chosen GROUP BY user_id) h ON u.user_id = h.user_id
          LEFT JOIN gone g ON u.user_id = g.user_id
          WHERE coalesce(h.have, 0) < least({k}, c.n_items - coalesce(g.gone, 0))),
cut AS (SELECT s.*, r.upto AS cut, c.total - r.upto AS rate FROM short s JOIN ranks r ON r.pop_rank = s.head, consts c),
arrive AS (SELECT user_id, cut, rate, draw,
                  sum(-ln(1 - {uniform_sql(42, "'step'", "user_id", "draw")}) / rate)
                    OVER (PARTITION BY user_id ORDER BY draw) AS t
           FROM (SELECT *, CAST(unnest(range({8 * k})) AS INT) AS draw FROM cut WHERE rate > 0) d),
tail AS (SELECT a.user_id, r.book_id, a.t FROM (
           SELECT *, cut + CAST(floor({uniform_sql(42, "'tail'", "user_id", "draw")} * rate) AS BIGINT) AS r
           FROM arrive) a JOIN ranks r ON a.r >= r.upto - r.cnt AND a.r < r.upto),
waits AS (SELECT user_id, book_id, min(t) AS t FROM tail GROUP BY user_id, book_id
          UNION ALL
          SELECT s.user_id, r.book_id, -ln(1 - {uniform_sql(42, "'head'", "s.user_id", "r.book_id")}) / r.cnt AS t
          FROM short s JOIN ranks r ON r.pop_rank <= s.head),
more AS (SELECT t.user_id, t.book_id, CAST(s.have + rn AS INT) AS neg_rank FROM (
           SELECT x.user_id, x.book_id, row_number() OVER (PARTITION BY x.user_id ORDER BY x.t, x.book_id) AS rn
           FROM waits x WHERE NOT EXISTS (SELECT 1 FROM chosen q WHERE q.user_id = x.user_id
                                          AND q.book_id = x.book_id) {anti}) t
         JOIN short s ON t.user_id = s.user_id WHERE rn <= s.need),
negs AS (SELECT * FROM chosen UNION ALL SELECT * FROM more)"""


E4_SQL = "WITH " + FIX_INTERACTIONS + """,
act AS (SELECT user_id FROM interactions GROUP BY user_id HAVING count(*) BETWEEN 20 AND 200),
l AS (SELECT user_id, list(book_id ORDER BY book_id) AS l FROM interactions
      WHERE user_id IN (SELECT user_id FROM act) GROUP BY user_id)
SELECT user_id, array_to_string(l[1:len(l) - 2], ',') AS train_interactions,
       l[len(l) - 1] AS eval_interactions, l[len(l)] AS test_interactions FROM l"""

E4_CHUNKS_SQL = "WITH " + FIX_INTERACTIONS + """,
r AS (SELECT user_id, book_id, row_number() OVER (PARTITION BY user_id ORDER BY book_id) - 1 AS p,
             count(*) OVER (PARTITION BY user_id) AS n FROM interactions),
c AS (SELECT *, least(p, n - 3) // 7 AS chunk FROM r WHERE n BETWEEN 20 AND 200)
SELECT user_id, CAST(chunk AS INT) AS chunk,
       string_agg(CAST(book_id AS VARCHAR), ',' ORDER BY p) FILTER (p < n - 2) AS train_interactions,
       coalesce(max(CASE WHEN p = n - 2 THEN book_id END), 0) AS eval_interactions,
       coalesce(max(CASE WHEN p = n - 1 THEN book_id END), 0) AS test_interactions
FROM c GROUP BY user_id, chunk"""

D7_SQL = SEQ_BASE + """
SELECT 'user_id' AS "column", min(user_id) AS min_id, max(user_id) AS max_id,
       count(DISTINCT user_id) AS n_distinct,
       min(user_id) = 1 AND max(user_id) = (SELECT count(*) FROM umap)
         AND count(DISTINCT user_id) = (SELECT count(*) FROM umap) AS dense FROM seq
UNION ALL
SELECT 'book_id', min(book_id), max(book_id), count(DISTINCT book_id),
       min(book_id) = 1 AND max(book_id) = (SELECT count(*) FROM imap)
         AND count(DISTINCT book_id) = (SELECT count(*) FROM imap) FROM seq"""


PAIRS = "WITH " + FIX_INTERACTIONS + ",\npairs AS (SELECT user_id, book_id FROM interactions)"

K5_SQL = "WITH " + FIX_INTERACTIONS + """,
u AS (SELECT DISTINCT user_id FROM interactions),
p AS (SELECT user_id, row_number() OVER (ORDER BY """ + uniform_sql(42, 0, "user_id") + """, user_id) - 1 AS idx
      FROM u),
c AS (SELECT count(*) AS n, CAST(ceil(count(*) / 16.0) * 16 AS BIGINT) AS total FROM u),
pos AS (SELECT p.user_id, p.idx AS position FROM p
        UNION ALL
        SELECT p.user_id, p.idx + r.k * c.n FROM p, c,
               (SELECT unnest(range(1, 17)) AS k) r
        WHERE p.idx + r.k * c.n < c.total)
SELECT user_id, CAST(position AS BIGINT) AS position, CAST(position % 16 AS INT) AS shard,
       CAST(position // 16 AS BIGINT) AS local_pos FROM pos"""

SCORED = _negatives_sql(True) + """,
cands AS (SELECT user_id, 0 AS position, eval_interactions AS item FROM eseq
          UNION ALL SELECT user_id, neg_rank, book_id FROM negs),
scored0 AS (SELECT user_id, CAST(position AS INT) AS position, CAST(item AS INT) AS item,
                   CAST(position = 0 AS INT) AS label,
                   """ + uniform_sql(7, "user_id", "position") + """ AS score FROM cands)"""


def _metrics_sql(score_expr: str = "score", ks=(10, 20, 50), per_row: bool = False,
                 src: str = "scored0") -> str:
    sums = []
    outs = []
    for k in ks:
        sums.append(f"sum(CASE WHEN rk <= {k} THEN label ELSE 0 END) AS h{k}")
        sums.append(f"sum(CASE WHEN rk <= {k} THEN label / log2(rk + 1) ELSE 0 END) AS d{k}")
        ideal = f"list_sum(list_transform(range(1, least(ans, {k}) + 1), lambda i: 1 / log2(i + 1)))"
        if per_row:
            outs.append(f"h{k} / least(ans, {k}) AS recall_{k}")
            outs.append(f"d{k} / {ideal} AS ndcg_{k}")
        else:
            outs.append(f"round(avg(h{k} / least(ans, {k})), 6) AS recall_{k}")
            outs.append(f"round(avg(d{k} / {ideal}), 6) AS ndcg_{k}")
    head = "user_id, " if per_row else ""
    return f""",
scored AS (SELECT user_id, position, item, label, {score_expr} AS score FROM {src}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, position) AS rk
           FROM scored),
per AS (SELECT user_id, CAST(sum(label) AS BIGINT) AS ans, {", ".join(sums)} FROM ranked GROUP BY user_id),
met AS (SELECT {head}{", ".join(outs)} FROM per)"""


L6_SQL = SCORED + _metrics_sql(ks=(10,), per_row=True) + """,
ix AS (SELECT *, row_number() OVER (ORDER BY user_id) - 1 AS idx FROM met),
b AS (SELECT idx % 2 AS shard, (idx // 2) // 16 AS batch_id, recall_10, ndcg_10 FROM ix),
bm AS (SELECT shard, batch_id, avg(recall_10) AS r, avg(ndcg_10) AS d FROM b GROUP BY ALL),
sm AS (SELECT shard, avg(r) AS r, avg(d) AS d FROM bm GROUP BY shard)
SELECT round(avg(r), 6) AS recall_10, round(avg(d), 6) AS ndcg_10 FROM sm"""

L7_SQL = SCORED + """,
t AS (SELECT s.user_id AS token, s.item AS class, s.score * 4 AS logit, a.item AS label
      FROM scored0 s JOIN (SELECT user_id, item FROM scored0 WHERE position = 0) a
      ON s.user_id = a.user_id),
m AS (SELECT token, max(logit) AS mx FROM t GROUP BY token),
per AS (SELECT t.token, any_value(t.label) AS y, any_value(m.mx) AS mx,
               sum(exp(t.logit - m.mx)) AS se,
               max(CASE WHEN t.class = t.label THEN t.logit END) AS zy, avg(t.logit) AS mz
        FROM t JOIN m ON t.token = m.token GROUP BY t.token)
SELECT round(avg(mx + ln(se) - 0.9 * zy - 0.1 * mz), 6) AS cross_entropy FROM per WHERE y <> 0"""

LOGITS = """WITH logits AS (
  SELECT event_id, user_id, (value - 25) / 10 AS logit,
         CASE WHEN event_type IN ('purchase', 'click') THEN 1 ELSE 0 END AS label FROM events)"""

AUC_SQL = LOGITS + """,
g AS (SELECT logit, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos,
             sum(CASE WHEN label <> 1 THEN 1 ELSE 0 END) AS neg FROM logits GROUP BY logit),
c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY logit ROWS BETWEEN UNBOUNDED PRECEDING
                                        AND 1 PRECEDING), 0) AS below FROM g)
SELECT round(sum(pos * (below + neg * 0.5)) / (sum(pos) * sum(neg)), 6) AS roc_auc FROM c"""

AUC_T_SQL = LOGITS + """,
bk AS (SELECT least(198, greatest(0, ceil((1.0 / (1.0 + exp(-logit))) * 199) - 1)) AS bucket,
              label FROM logits),
lab AS (SELECT j.j, coalesce(sum(CASE WHEN bk.label = 1 THEN 1 ELSE 0 END), 0) AS pos,
               coalesce(sum(CASE WHEN bk.label <> 1 THEN 1 ELSE 0 END), 0) AS neg
        FROM (SELECT unnest(range(200)) AS j) j LEFT JOIN bk ON bk.bucket = j.j GROUP BY j.j),
pts AS (SELECT j, sum(pos) OVER (ORDER BY j DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                  / sum(pos) OVER () AS tpr,
                  sum(neg) OVER (ORDER BY j DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                  / sum(neg) OVER () AS fpr FROM lab),
terms AS (SELECT (fpr - lead(fpr) OVER (ORDER BY j)) * (tpr + lead(tpr) OVER (ORDER BY j)) / 2 AS t
          FROM pts)
SELECT round(sum(t), 6) AS roc_auc FROM terms"""

NVEC = "(SELECT count(*) FROM embeddings)"


def _r6sql(expr: str) -> str:
    """round(expr, 6) with signed zero folded to +0.0, as ``_r6`` does."""
    return f"(CASE WHEN round({expr}, 6) = 0 THEN 0.0 ELSE round({expr}, 6) END)"


def _dot_sql(u: str, v: str) -> str:
    return (f"list_reduce(list_transform(range(1, len({u}) + 1), "
            f"lambda i: CAST({u}[i] AS DOUBLE) * CAST({v}[i] AS DOUBLE)), lambda a, b: a + b)")


M1_SQL = "WITH " + FIX_BOOK_MAP + """
SELECT m.book_id, CAST(len(e.embedding) AS INT) AS dim,
       round(sqrt(list_reduce(list_transform(e.embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)),
                              lambda a, b: a + b)), 6) AS l2,
       round(CAST(e.embedding[1] AS DOUBLE), 6) AS first
FROM book_id_map m LEFT JOIN embeddings e ON e.vec_id = m.book_id % """ + NVEC

M3_SQL = "WITH " + FIX_INTERACTIONS + """
SELECT i.user_id, i.book_id, """ + _r6sql(_dot_sql("u.embedding", "v.embedding")) + """ AS logit
FROM interactions i
LEFT JOIN embeddings u ON u.vec_id = i.user_id % """ + NVEC + """
LEFT JOIN embeddings v ON v.vec_id = i.book_id % """ + NVEC

M2_SQL = "WITH " + FEATURES_SQL + """,
v AS (
  SELECT f.book_id,
         list_concat(
           list_transform(e1.embedding, lambda x: CAST(x AS DOUBLE)),
           list_transform(e2.embedding, lambda x: CAST(x AS DOUBLE)),
           list_transform(e3.embedding, lambda x: CAST(x AS DOUBLE)),
           list_transform(e4.embedding, lambda x: CAST(x AS DOUBLE)),
           list_transform(e5.embedding, lambda x: CAST(x AS DOUBLE)),
           list_transform(e6.embedding, lambda x: CAST(x AS DOUBLE)),
           [CAST(f.avg_rating AS DOUBLE), CAST(f.num_pages AS DOUBLE)]) AS item_vec
  FROM features f
  LEFT JOIN embeddings e1 ON e1.vec_id = f.book_id % """ + NVEC + """
  LEFT JOIN embeddings e2 ON e2.vec_id = f.language % """ + NVEC + """
  LEFT JOIN embeddings e3 ON e3.vec_id = f.is_ebook % """ + NVEC + """
  LEFT JOIN embeddings e4 ON e4.vec_id = f.format % """ + NVEC + """
  LEFT JOIN embeddings e5 ON e5.vec_id = f.publisher % """ + NVEC + """
  LEFT JOIN embeddings e6 ON e6.vec_id = f.pub_decade % """ + NVEC + """)
SELECT book_id, CAST(len(item_vec) AS INT) AS dim,
       round(list_reduce(item_vec, lambda a, b: a + b), 6) AS total FROM v"""

K6_SQL = RANKING_SQL.rsplit("SELECT r.user_id", 1)[0] + """
SELECT count(*) AS n_rows, CAST(2048 AS BIGINT) AS global_batch,
       CAST(count(*) // 2048 AS BIGINT) AS steps_drop_last,
       CAST(ceil(count(*) / 2048.0) AS BIGINT) AS steps_keep_last
FROM r WHERE r.rn <= ceil(r.n * CAST(0.8 AS DOUBLE))"""


RANK_PREFIX = RANKING_SQL.rsplit("SELECT r.user_id", 1)[0]
RANK_ROWS = RANK_PREFIX + """
ex AS (SELECT r.user_id, r.book_id AS item_id, f.language, f.is_ebook, f.format, f.publisher,
       f.pub_decade, f.avg_rating, f.num_pages, r.is_read, r.is_reviewed, r.label,
       CASE WHEN r.rn <= ceil(r.n * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'eval' END AS split
       FROM r LEFT JOIN features f ON r.book_id = f.book_id)"""
RANK_ROWS = RANK_ROWS.replace("FROM interactions WHERE user_id IN (SELECT user_id FROM active))\n",
                              "FROM interactions WHERE user_id IN (SELECT user_id FROM active)),\n")
EX_COLS = """user_id, item_id, language, is_ebook, format, publisher, pub_decade,
       round(CAST(avg_rating AS DOUBLE), 6) AS avg_rating,
       round(CAST(num_pages AS DOUBLE), 6) AS num_pages"""

A9_SQL = "WITH " + FEATURES_SQL + """
SELECT 'user' AS name, (SELECT count(*) FROM customer) AS size
UNION ALL SELECT 'item', (SELECT count(*) FROM part)
UNION ALL SELECT 'language', count(DISTINCT """ + _unknown_sql("language") + """) FROM bp
UNION ALL SELECT 'is_ebook', count(DISTINCT """ + _unknown_sql("is_ebook") + """) FROM bp
UNION ALL SELECT 'format', count(DISTINCT """ + _unknown_sql("format") + """) FROM bp
UNION ALL SELECT 'publisher', count(DISTINCT """ + _unknown_sql("publisher") + """) FROM bp
UNION ALL SELECT 'pub_decade', count(DISTINCT """ + _decade_sql("pub_year") + """) FROM bp"""

N2_SQL = AUC_T_SQL.replace("SELECT round(sum(t), 6) AS roc_auc FROM terms", """
SELECT round(sum(t), 6) AS roc_auc,
       round((SELECT avg(greatest(logit, 0) - logit * label + ln(1 + exp(-abs(logit))))
              FROM logits), 6) AS log_loss FROM terms""")

B3_SQL = "WITH " + FIX_BOOKS + """,
y AS (SELECT book_id, publication_year,
             CASE WHEN regexp_full_match(trim(publication_year), '[0-9]{4}')
                  THEN TRY_CAST(trim(publication_year) AS INT) END AS y FROM books)
SELECT book_id, publication_year, """ + _decade_sql("publication_year") + """ AS decade,
       CASE WHEN y BETWEEN 1900 AND 2029 THEN CAST(CAST(floor(y / 10) * 10 AS INT) AS VARCHAR) || 's'
            ELSE 'unknown' END AS calendar_decade FROM y"""

B5_SQL = "WITH " + FIX_BOOKS + """,
x AS (SELECT book_id, language_code,
             COALESCE(CASE WHEN num_pages <> '' THEN TRY_CAST(num_pages AS FLOAT) END,
                      CAST(100.0 AS FLOAT)) AS x FROM books)
SELECT book_id, """ + _unknown_sql("language_code") + """ AS language,
       round(CAST(x AS DOUBLE), 6) AS pages_imputed,
       round(CASE WHEN x > 2000 THEN 100.0 ELSE CAST(x AS DOUBLE) END, 6) AS pages_clipped FROM x"""

B8_SQL = "WITH " + FIX_BOOKS + """,
x AS (SELECT book_id,
             CASE WHEN regexp_full_match(trim(publication_year), '[0-9]{4}')
                  THEN TRY_CAST(trim(publication_year) AS INT) END AS year,
             TRY_CAST(num_pages AS INT) AS pages FROM books)
SELECT * FROM x WHERE book_id IS NOT NULL AND year IS NOT NULL AND pages IS NOT NULL"""

PAIR_IDX = PAIRS + """,
ix AS (SELECT user_id, book_id, row_number() OVER (ORDER BY user_id, book_id) - 1 AS row_idx
       FROM pairs)"""

B10_SQL = PAIR_IDX + """,
sp AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY book_id) AS rn,
              count(*) OVER (PARTITION BY user_id) AS n FROM ix)
SELECT row_idx, user_id, book_id FROM sp WHERE rn <= ceil(n * CAST(0.8 AS DOUBLE))"""

B11_SQL = PAIR_IDX + """,
u AS (SELECT CAST(ceil(count(*) / 8.0) AS BIGINT) AS unit FROM pairs)
SELECT user_id, book_id, CAST(row_idx // unit + 1 AS INT) AS part FROM ix, u
WHERE row_idx < 8 * unit"""

C3_SQL = "WITH " + FIX_INTERACTIONS_RAW + """,
act AS (SELECT user_id FROM interactions_raw GROUP BY user_id HAVING count(*) BETWEEN 10 AND 250),
a AS (SELECT * FROM interactions_raw WHERE user_id IN (SELECT user_id FROM act)),
sp AS (SELECT user_id, book_id,
              CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY book_id)
                        <= ceil(count(*) OVER (PARTITION BY user_id) * CAST(0.8 AS DOUBLE))
                   THEN 'train' ELSE 'eval' END AS split FROM a)
SELECT sp.user_id, sp.book_id, sp.split, a.rating, a.is_read
FROM sp JOIN a ON sp.user_id = a.user_id AND sp.book_id = a.book_id"""

D2_SQL = "WITH " + FIX_BOOKS + """,
bp AS (SELECT average_rating AS avg_rating, num_pages FROM books),""" + \
    _stats_sql("avg_rating") + "," + _stats_sql("num_pages") + """
SELECT round(mn, 6) AS min, round(mx, 6) AS max, round(med, 6) AS median,
       'avg_rating' AS "column" FROM st_avg_rating
UNION ALL
SELECT round(mn, 6), round(mx, 6), round(med, 6), 'num_pages' FROM st_num_pages"""

D6_COLS = ["user_id", "item_id", "language", "is_ebook", "format", "publisher", "pub_decade",
           "avg_rating", "num_pages", "is_read", "is_reviewed", "label", "split"]
D6_SQL = RANK_ROWS + "\nSELECT " + ", ".join(
    f"CAST(count(*) - count({c}) AS BIGINT) AS {c}" for c in D6_COLS) + " FROM ex"

E2_SQL = """WITH rows AS (
  SELECT CAST(o.o_custkey AS INT) AS user_id, CAST(l.l_partkey AS INT) AS book_id,
         l.l_quantity AS qty, l.l_orderkey, l.l_linenumber
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
slots AS (SELECT user_id, qty,
                 row_number() OVER (PARTITION BY user_id
                                    ORDER BY l_orderkey, l_linenumber, book_id, qty) - 1 AS pos
          FROM rows),
vals AS (SELECT user_id, book_id,
                row_number() OVER (PARTITION BY user_id ORDER BY book_id) - 1 AS pos FROM rows)
SELECT s.user_id, CAST(s.pos AS INT) AS pos, v.book_id, s.qty
FROM slots s JOIN vals v ON s.user_id = v.user_id AND s.pos = v.pos"""

WINS = """,
wins AS (SELECT user_id, CAST(window_start AS INT) AS window_start,
                CAST(least(20, n_train - window_start) AS INT) AS len
         FROM (SELECT user_id, n_train, unnest(range(0, n_train, 10)) AS window_start
               FROM (SELECT DISTINCT user_id, n_train FROM masked) d) w)"""

E6_SQL = SEQ_BASE + WINS + """
SELECT user_id, window_start, len,
       CAST(coalesce(sum(len) OVER (ORDER BY user_id, window_start
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
         AS "offset"
FROM wins"""

H12_SQL = SEQ_BASE + WINS + """,
wl AS (SELECT w.user_id, w.window_start, w.len,
              list(m.train_interactions ORDER BY m.pos) AS vals,
              row_number() OVER (ORDER BY w.user_id, w.window_start) - 1 AS row_idx
       FROM wins w JOIN masked m ON m.user_id = w.user_id AND m.pos >= w.window_start
                                 AND m.pos < w.window_start + 20
       GROUP BY w.user_id, w.window_start, w.len),
wo AS (SELECT *, row_idx // 16 AS b,
              sum(len) OVER (PARTITION BY row_idx // 16 ORDER BY row_idx) - len AS begins FROM wl)
SELECT CAST(b AS BIGINT) AS batch_id, CAST(sum(len) AS INT) AS n_values,
       string_agg(array_to_string(vals, ','), ',' ORDER BY row_idx) AS "values",
       string_agg(CAST(len AS VARCHAR), ',' ORDER BY row_idx) AS lengths,
       string_agg(CAST(CAST(begins AS BIGINT) AS VARCHAR), ',' ORDER BY row_idx) AS offsets
FROM wo GROUP BY b"""

G2_SQL = SEQ_BASE + ",\nnusers AS (SELECT DISTINCT user_id FROM srows),\ndraws AS (" + \
    _draws_sql("nusers", "30") + """),
dd AS (SELECT user_id, book_id, min(draw) AS fd FROM draws d
       WHERE NOT EXISTS (SELECT 1 FROM srows s WHERE s.user_id = d.user_id AND s.book_id = d.book_id)
       GROUP BY user_id, book_id),
dl AS (SELECT user_id, array_to_string(list(book_id ORDER BY fd), ',') AS difference
       FROM dd GROUP BY user_id)
SELECT u.user_id, coalesce(dl.difference, '') AS difference
FROM nusers u LEFT JOIN dl ON u.user_id = dl.user_id"""


M5_SQL = SCORED + """,
hist AS (SELECT user_id, p, item FROM (
           SELECT user_id, generate_subscripts(eval_seqs, 1) AS p, unnest(eval_seqs) AS item
           FROM eseq) t, consts c
         WHERE item <> 0 AND item <> c.mask_id),
hv AS (SELECT h.user_id, list(e.embedding ORDER BY h.p) AS vecs
       FROM hist h JOIN embeddings e ON e.vec_id = h.item % """ + NVEC + """
       GROUP BY h.user_id),
uv AS (SELECT user_id,
              list_transform(range(1, len(vecs[1]) + 1),
                lambda d: list_reduce(list_transform(vecs, lambda v: CAST(v[d] AS DOUBLE)),
                                      lambda a, b: a + b) / len(vecs)) AS u
       FROM hv)
SELECT s.user_id, s.position, s.item,
       """ + _r6sql(_dot_sql("uv.u", "e.embedding")) + """ AS score
FROM scored0 s LEFT JOIN uv ON s.user_id = uv.user_id
LEFT JOIN embeddings e ON e.vec_id = s.item % """ + NVEC


def _m4_sql() -> str:
    w1, b1, w2, b2 = _tower_weights()
    rows = lambda vals: ", ".join(vals)
    w1v = rows(f"({i}, {j}, {float(w1[i, j])!r})" for i in range(w1.shape[0]) for j in range(w1.shape[1]))
    b1v = rows(f"({j}, {float(b1[j])!r})" for j in range(b1.shape[0]))
    w2v = rows(f"({j}, {k}, {float(w2[j, k])!r})" for j in range(w2.shape[0]) for k in range(w2.shape[1]))
    b2v = rows(f"({k}, {float(b2[k])!r})" for k in range(b2.shape[0]))
    out = "o"
    return "WITH " + FIX_INTERACTIONS + f""",
w1(i, j, w) AS (VALUES {w1v}),
b1(j, b) AS (VALUES {b1v}),
w2(j, k, w) AS (VALUES {w2v}),
b2(k, b) AS (VALUES {b2v}),
u AS (SELECT DISTINCT user_id FROM interactions),
x AS (SELECT user_id, i, xv FROM (
        SELECT u.user_id, generate_subscripts(e.embedding, 1) - 1 AS i, unnest(e.embedding) AS xv
        FROM u JOIN embeddings e ON e.vec_id = u.user_id % """ + NVEC + f""") t),
h AS (SELECT x.user_id, w1.j, sum(CAST(x.xv AS DOUBLE) * w1.w) + any_value(b1.b) AS h
      FROM x JOIN w1 ON w1.i = x.i JOIN b1 ON b1.j = w1.j GROUP BY x.user_id, w1.j),
a AS (SELECT user_id, j, h / (1.0 + exp(-h)) AS a FROM h),
o AS (SELECT a.user_id, w2.k, sum(a.a * w2.w) + any_value(b2.b) AS {out}
      FROM a JOIN w2 ON w2.j = a.j JOIN b2 ON b2.k = w2.k GROUP BY a.user_id, w2.k)
SELECT user_id, CAST(count(*) AS INT) AS dim,
       {_r6sql("list_reduce(list(o ORDER BY k), lambda p, q: p + q)")} AS tower_sum,
       {_r6sql("max(CASE WHEN k = 0 THEN o END)")} AS tower_first
FROM o GROUP BY user_id"""


EVAL_SEQ_SQL = M5_SQL.rsplit("SELECT s.user_id, s.position, s.item,", 1)[0].rstrip() + """,
m5s AS (SELECT s.user_id, s.position, s.item, s.label,
               """ + _dot_sql("uv.u", "e.embedding") + """ AS mscore
        FROM scored0 s LEFT JOIN uv ON s.user_id = uv.user_id
        LEFT JOIN embeddings e ON e.vec_id = s.item % """ + NVEC + ")" + \
    _metrics_sql("mscore", src="m5s") + " SELECT * FROM met"


K1_EPOCHS_SQL = PAIR_IDX + ",\none AS (" + epoch_positions_sql(
    "ix", "row_idx", "(SELECT count(*) FROM pairs)", 42, 1, name="epoch_1") + ")\n" + epoch_positions_sql(
    "one", "row_idx", "(SELECT count(*) FROM pairs)", 42, 2, name="epoch_2")

SEQUENCE_PARTS_SQL = _negatives_sql(True) + """,
cl AS (SELECT user_id, list(book_id ORDER BY neg_rank) AS l FROM negs GROUP BY user_id)
SELECT 'eval' AS split, e.user_id, CAST(-1 AS INT) AS window_start, array_to_string(e.eval_seqs, ',') AS items,
       array_to_string(list_concat([e.eval_interactions], coalesce(cl.l, CAST([] AS INT[]))), ',') AS targets
FROM eseq e LEFT JOIN cl ON e.user_id = cl.user_id
UNION ALL SELECT 'train', user_id, window_start, train_interactions, labels FROM (""" + _windows_sql(
    "masked", ["train_interactions", "labels"], 20, 10) + ") w"


def _library_sql() -> dict[str, str]:
    return {
        "ranking_examples": RANKING_SQL,
        "e4_split_leave_last": E4_SQL,
        "e4_split_leave_last_chunks": E4_CHUNKS_SQL,
        "d4_sequence_chunks": "WITH " + FIX_INTERACTIONS + """,
r AS (SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY book_id) - 1) // 7 AS chunk FROM interactions)
SELECT user_id, CAST(chunk AS INT) AS chunk, string_agg(CAST(book_id AS VARCHAR), ',' ORDER BY book_id) AS book_id,
       string_agg(CAST(rating AS VARCHAR), ',' ORDER BY book_id) AS rating FROM r GROUP BY user_id, chunk""",
        "b9_fill_null": "WITH " + FIX_BOOKS + """
SELECT book_id, coalesce(CASE WHEN regexp_full_match(trim(publication_year), '[0-9]{4}')
                              THEN TRY_CAST(trim(publication_year) AS INT) END, 1900) AS year,
       CAST(coalesce(TRY_CAST(num_pages AS INT), length(publisher)) AS INT) AS pages FROM books""",
        "h11_padding_mask": SEQ_BASE + WINS + """
SELECT user_id, window_start, array_to_string(list_concat(list_resize(CAST([] AS INT[]), len, 1),
       list_resize(CAST([] AS INT[]), 20 - len, 0)), ',') AS mask FROM wins""",
        "f2_head_per_group": "WITH " + FIX_INTERACTIONS + """,
r AS (SELECT user_id, book_id, count(*) OVER (PARTITION BY user_id) AS n,
             row_number() OVER (PARTITION BY user_id ORDER BY book_id) AS rn FROM interactions)
SELECT user_id, book_id, n FROM r WHERE n BETWEEN 20 AND 200 AND rn <= ceil(n * CAST(0.25 AS DOUBLE))""",
        "k1_epoch_positions": K1_EPOCHS_SQL,
        "k4_shard_of_rank": PAIR_IDX + "\nSELECT user_id, book_id, row_idx, CAST(3 AS INT) AS shard FROM ix WHERE row_idx % 8 = 3",
        "k5_shard_even_unshuffled": K5_SQL.replace(uniform_sql(42, 0, "user_id") + ", ", ""),
        "m5_score_candidates_model": SCORED + """
SELECT s.user_id, s.position, s.item,
       round(((list_sum(e.eval_seqs) + 7 * s.item) % 101) / CAST(101 AS DOUBLE), 6) AS score
FROM scored0 s JOIN eseq e ON e.user_id = s.user_id""",
        "sequence_dataset_from_raw_files": SEQUENCE_PARTS_SQL,
        "i3_reindex_ids": SEQ_BASE + " SELECT user_id, book_id FROM seq",
        "d7_check_dense_ids": D7_SQL,
        "d1_item_popularity": SEQ_BASE + """
SELECT book_id, cnt AS "count", round(cnt / CAST(c.total AS DOUBLE), 6) AS prob
FROM pop, consts c""",
        "j1_mask_tokens": SEQ_BASE + " SELECT user_id, pos, train_interactions, labels FROM masked",
        "d5_masked_ratio": SEQ_BASE + """
SELECT round(avg(CASE WHEN m.train_interactions = c.mask_id THEN 1.0 ELSE 0.0 END), 6)
       AS masked_ratio FROM masked m, consts c""",
        "j2_sliding_sequences": SEQ_BASE + _windows_sql("train", ["book_id"], 5, 3),
        "j7_bert_train_set": SEQ_BASE + _windows_sql("masked", ["train_interactions", "labels"], 20, 10),
        "j3_eval_sequences": SEQ_BASE + """
SELECT user_id, eval_interactions, array_to_string(eval_seqs, ',') AS eval_seqs FROM eseq""",
        "j8_popularity_draws": SEQ_BASE + ",\nnusers AS (SELECT DISTINCT user_id FROM srows)" + _draws_sql("nusers", "30"),
        "j4_sample_negatives": _negatives_sql(False) + " SELECT user_id, book_id, neg_rank FROM negs",
        "j5_negatives_skewed": _negatives_sql(True, base=SEQ_BASE.replace(FIX_INTERACTIONS, FIX_SKEWED))
            + " SELECT user_id, book_id, neg_rank FROM negs",
        "e3_split_global": "WITH " + FIX_INTERACTIONS + """,
x AS (SELECT user_id AS was, CASE WHEN user_id % 17 <> 0 THEN user_id END AS user_id, book_id FROM interactions),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY book_id, was) - 1 AS p,
             count(*) OVER (PARTITION BY user_id) AS n FROM x)
SELECT was, user_id, book_id, CASE WHEN p < ceil(n * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'eval' END AS split FROM r""",
        "b1_null_key": "WITH " + FIX_INTERACTIONS + """,
x AS (SELECT CASE WHEN user_id % 400 <> 0 THEN user_id END AS user_id, book_id FROM interactions),
r AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM x)
SELECT user_id, book_id FROM r WHERE n BETWEEN 20 AND 200""",
        "i3_reindex_mixed_types": "WITH " + FIX_INTERACTIONS + """
SELECT CAST(dense_rank() OVER (ORDER BY user_id) AS INT) AS user_id,
       CAST(dense_rank() OVER (ORDER BY 'B' || CAST(book_id AS VARCHAR)) AS INT) AS book_id FROM interactions""",
        "m6_fit_ranker": RANK_ROWS + """
SELECT count(*) AS eval_rows, count(*) AS finite_logits, CAST(0 AS BIGINT) AS reload_mismatches,
       TRUE AS auc_above_floor, TRUE AS objective_fell FROM ex WHERE split = 'eval'""",
        "l2_one_class": """SELECT CAST(CASE WHEN count(*) < 0 THEN 0 END AS DOUBLE) AS "exact",
CAST(CASE WHEN count(*) < 0 THEN 0 END AS DOUBLE) AS bucketed FROM lineitem""",
        "j5_sample_negatives_excluding": _negatives_sql(True) + " SELECT user_id, book_id, neg_rank FROM negs",
        "k1_shuffle_rows": PAIRS + """
SELECT user_id, book_id, row_number() OVER (ORDER BY """ + uniform_sql(42, 1, "user_id", "book_id")
            + """, user_id, book_id) - 1 AS row_idx FROM pairs""",
        "k3_assign_batches": PAIRS + """,
ix AS (SELECT user_id, book_id, row_number() OVER (ORDER BY user_id, book_id) - 1 AS row_idx FROM pairs)
SELECT user_id, book_id, row_idx, CAST(row_idx // 2048 AS BIGINT) AS batch_id FROM ix
WHERE row_idx < (SELECT count(*) // 2048 * 2048 FROM pairs)""",
        "k4_shard_rows": PAIRS + """,
ix AS (SELECT user_id, book_id, row_number() OVER (ORDER BY """ + uniform_sql(42, 1, "user_id", "book_id")
            + """, user_id, book_id) - 1 AS row_idx FROM pairs)
SELECT user_id, book_id, CAST(row_idx % 8 AS INT) AS shard FROM ix""",
        "k5_shard_even": K5_SQL,
        "k6_plan_steps": K6_SQL,
        "l5_candidate_labels": SCORED + " SELECT user_id, position, item, label FROM scored0",
        "f3_topk_candidates": SCORED + """
SELECT user_id, position, CAST(rk AS INT) AS rank FROM (
  SELECT user_id, position, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, position) AS rk
  FROM scored0) t WHERE rk <= 10""",
        "l3_l4_ranking_metrics": SCORED + _metrics_sql() + " SELECT * FROM met",
        "l3_l4_ranking_metrics_ties": SCORED + _metrics_sql("round(score, 2)") + " SELECT * FROM met",
        "l3_l4_ranking_metrics_arrays": SCORED + _metrics_sql() + " SELECT * FROM met",
        "l6_metrics_by_batch": L6_SQL,
        "l7_masked_cross_entropy": L7_SQL,
        "l1_log_loss": LOGITS + """
SELECT round(avg(greatest(logit, 0) - logit * label + ln(1 + exp(-abs(logit)))), 6) AS log_loss
FROM logits""",
        "l2_roc_auc": AUC_SQL,
        "l2_roc_auc_thresholded": AUC_T_SQL,
        "m1_embedding_lookup": M1_SQL,
        "m2_assemble_item_vector": M2_SQL,
        "m3_dot_score": M3_SQL,
        "m5_score_candidates": M5_SQL,
        "m4_tower_transform": _m4_sql(),
        "evaluate_sequence_dataset": EVAL_SEQ_SQL,
        "ranking_dataset_from_raw_files": RANK_ROWS + f" SELECT {EX_COLS}, is_read, is_reviewed, label, split FROM ex",
        "a1_read_interactions": "WITH " + FIX_INTERACTIONS + " SELECT * FROM interactions",
        "a2_read_id_map": "WITH " + FIX_BOOK_MAP + " SELECT * FROM book_id_map",
        "a3_read_item_metadata": "WITH " + FIX_BOOKS + " SELECT * FROM books",
        "a4_dataset_size": RANK_ROWS + " SELECT split, count(*) AS n_rows FROM ex GROUP BY split",
        "a5_read_examples": RANK_ROWS + f" SELECT {EX_COLS}, label FROM ex WHERE split = 'eval'",
        "a6_write_parts": RANK_ROWS + f" SELECT {EX_COLS}, is_read, is_reviewed, label, split FROM ex",
        "a7_a8_tfrecord_roundtrip": RANK_ROWS + """
SELECT CAST(user_id AS BIGINT) AS user_id, CAST(item_id AS BIGINT) AS item_id,
       CAST(language AS BIGINT) AS language, CAST(is_ebook AS BIGINT) AS is_ebook,
       CAST(format AS BIGINT) AS format, CAST(publisher AS BIGINT) AS publisher,
       CAST(pub_decade AS BIGINT) AS pub_decade,
       round(CAST(avg_rating AS DOUBLE), 6) AS avg_rating,
       round(CAST(num_pages AS DOUBLE), 6) AS num_pages,
       round(CAST(label AS DOUBLE), 6) AS label FROM ex""",
        "a9_size_map": A9_SQL,
        "a10_data_size": RANK_ROWS + """
SELECT 'train_data_size' AS name, count(*) AS size FROM ex WHERE split = 'train'""",
        "n1_stream_examples": RANK_ROWS + f" SELECT {EX_COLS}, is_read, is_reviewed, label FROM ex WHERE split = 'eval'",
        "n2_stream_metrics": N2_SQL,
        "b2_binarize": "WITH " + FIX_INTERACTIONS + """
SELECT user_id, book_id, CAST(CASE WHEN rating >= 4 THEN 1 ELSE 0 END AS TINYINT) AS label
FROM interactions""",
        "b3_decade_of": B3_SQL,
        "b5_b6_impute_clip": B5_SQL,
        "b8_drop_null_rows": B8_SQL,
        "b10_take_rows": B10_SQL,
        "b11_slice_rows": B11_SQL,
        "b13_with_constants": PAIRS + """
SELECT user_id, book_id, CAST(0 AS INT) AS pad, CAST(1 AS TINYINT) AS flag FROM pairs""",
        "i4_item_features": "WITH " + FEATURES_SQL + """
SELECT book_id, language, is_ebook, format, publisher, pub_decade,
       round(CAST(avg_rating AS DOUBLE), 6) AS avg_rating,
       round(CAST(num_pages AS DOUBLE), 6) AS num_pages FROM features""",
        "i1_fit_index": "WITH " + FIX_BOOKS + """,
v AS (SELECT DISTINCT """ + _unknown_sql("publisher") + """ AS value FROM books)
SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS BIGINT) AS id FROM v""",
        "c3_attach_labels_raw": C3_SQL,
        "c5_exclude_positives": SEQ_BASE + ",\nnusers AS (SELECT DISTINCT user_id FROM srows),\ndraws AS ("
            + _draws_sql("nusers", "30") + """)
SELECT user_id, draw, book_id FROM draws d
WHERE NOT EXISTS (SELECT 1 FROM srows s WHERE s.user_id = d.user_id AND s.book_id = d.book_id)""",
        "d2_continuous_stats": D2_SQL,
        "d3_distinct_values": "WITH " + FIX_BOOKS + " SELECT DISTINCT " + _unknown_sql("format")
            + " AS format FROM books",
        "d6_null_counts": D6_SQL,
        "e1_count_over": PAIRS + " SELECT user_id, book_id, count(*) OVER (PARTITION BY user_id) AS n FROM pairs",
        "e2_sort_within_positional": E2_SQL,
        "e2_sort_within": "WITH " + FIX_INTERACTIONS + """
SELECT CASE WHEN user_id % 17 <> 0 THEN user_id END AS user_id, CAST(book_id AS BIGINT) * 100000 + user_id AS book_id,
       CAST(row_number() OVER (PARTITION BY CASE WHEN user_id % 17 <> 0 THEN user_id END
                               ORDER BY CAST(book_id AS BIGINT) * 100000 + user_id) - 1 AS INT) AS pos
FROM interactions""",
        "e5_flag_last": SEQ_BASE + " SELECT user_id, book_id, pos = n - 1 AS is_last FROM srows",
        "e6_running_offsets": E6_SQL,
        "f1_popularity_rank": SEQ_BASE + """
SELECT p.book_id, p.cnt AS "count", CAST(r.pop_rank AS BIGINT) AS pop_rank
FROM pop p JOIN prank r ON p.book_id = r.book_id""",
        "f2_tail_per_group": "WITH " + FIX_INTERACTIONS + """,
act AS (SELECT user_id FROM interactions GROUP BY user_id HAVING count(*) BETWEEN 20 AND 200)
SELECT user_id, book_id FROM (
  SELECT user_id, book_id, row_number() OVER (PARTITION BY user_id ORDER BY book_id DESC) AS rn
  FROM interactions WHERE user_id IN (SELECT user_id FROM act)) t WHERE rn <= 2""",
        "g2_array_difference": G2_SQL,
        "g3_repeat_epochs": PAIRS + """
SELECT user_id, book_id, CAST(unnest(range(1, 4)) AS INT) AS epoch FROM pairs""",
        "h12_to_jagged": H12_SQL,
        "j7_bert_eval_set": _negatives_sql(True) + """,
cl AS (SELECT user_id, list(book_id ORDER BY neg_rank) AS l FROM negs GROUP BY user_id)
SELECT e.user_id, array_to_string(e.eval_seqs, ',') AS eval_seqs,
       array_to_string(list_concat([e.eval_interactions], coalesce(cl.l, CAST([] AS INT[]))), ',')
         AS candidate_items
FROM eseq e LEFT JOIN cl ON e.user_id = cl.user_id""",
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All registered queries; those of the optional package come last."""
    out = _library_queries()
    if llm_queries is not None:
        out |= llm_queries.queries() | {"pipeline": corpus_pipeline.run}
    return out


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express."""
    out = _library_sql()
    if llm_queries is not None:
        out |= llm_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
