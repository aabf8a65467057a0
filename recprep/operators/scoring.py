"""Scoring (M1-M5): embedding lookups, vector assembly, dot scores, user
model functions over Arrow batches."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from recprep.operators import list_scoring
from recprep.operators.joins import broadcast_bytes_limit, broadcast_limit, maybe_broadcast, table_bytes
from recprep.session import staged

#: bytes of the item vectors that one cell of the scoring grid holds (about),
#: and cells per core
BLOCK_BYTES, CELLS_PER_CORE = 256 << 20, 4


def embedding_lookup(df: DataFrame, id_col: str, table: DataFrame, key: str = "vec_id",
                     vec: str = "embedding", out: str | None = None,
                     table_rows: int | None = None) -> DataFrame:
    """M1: id -> vector by an equi-join; the table is broadcast only under
    the bounds of rows and bytes, otherwise both sides shuffle on the id (a hot
    id is split by AQE skew handling)."""
    out = out or f"{id_col}_vec"
    t = table.select(F.col(key).alias("_emb_key"), F.col(vec).alias(out))
    t = maybe_broadcast(t, known_rows=table_rows)
    return df.join(t, df[id_col] == F.col("_emb_key"), "left").drop("_emb_key")


def embedding_lookup_seq(df: DataFrame, key: str, seq_col: str, table: DataFrame,
                         vec_key: str = "vec_id", vec: str = "embedding",
                         out: str | None = None, skip=(0,)) -> DataFrame:
    """M1 for id sequences: one vector per element, order kept; ids in
    ``skip`` (pad) are dropped. Each list is re-gathered from its own
    elements only."""
    out = out or f"{seq_col}_vecs"
    ex = df.select(key, F.posexplode(seq_col).alias("_p", "_id"))
    if skip:
        ex = ex.where(~F.col("_id").isin(*skip))
    ex = embedding_lookup(ex, "_id", table, vec_key, vec, out="_v").where(F.col("_v").isNotNull())
    g = ex.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_p", "_v"))).alias("_s"))
    return g.select(key, F.transform("_s", lambda x: x["_v"]).alias(out))


def assemble_item_vector(df: DataFrame, vec_cols, scalar_cols, out: str = "item_vec") -> DataFrame:
    """M2: concatenate embedding arrays and scalar features (as doubles)."""
    arrays = [F.col(c).cast("array<double>") for c in vec_cols]
    scalars = F.array(*[F.col(c).cast("double") for c in scalar_cols])
    return df.withColumn(out, F.concat(*arrays, scalars))


def dot(u, v):
    """Row-wise inner product in double, summed left to right."""
    uc = F.col(u).cast("array<double>") if isinstance(u, str) else u.cast("array<double>")
    vc = F.col(v).cast("array<double>") if isinstance(v, str) else v.cast("array<double>")
    return F.aggregate(F.zip_with(uc, vc, lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)


def dot_score(df: DataFrame, u: str, v: str, out: str = "logit") -> DataFrame:
    """M3: the logit as the inner product of two vector columns."""
    return df.withColumn(out, dot(u, v))


def mean_vector(df: DataFrame, key: str, vecs: str, out: str = "mean_vec") -> DataFrame:
    """Element-wise mean of a list of vectors (per row, JVM-side)."""
    n = F.size(vecs)
    dim = F.size(F.element_at(vecs, 1))
    summed = F.transform(F.sequence(F.lit(0), dim - 1),
                         lambda i: F.aggregate(F.col(vecs), F.lit(0.0),
                                               lambda acc, v: acc + v[i].cast("double")))
    return df.withColumn(out, F.transform(summed, lambda s: s / n))


def tower_transform(df: DataFrame, vec_col: str, weights, out: str = "tower",
                    batch_size: int = 4096) -> DataFrame:
    """M4: two dense layers, swish then linear, on vector rows via Arrow
    batches. ``weights = (W1, b1, W2, b2)`` are supplied by the caller.
    Apply it to distinct ids (users or items), then join, so each vector is
    computed once rather than per example."""
    from pyspark.ml.functions import predict_batch_udf

    from recprep.session import ship_package

    ship_package(df.sparkSession)
    w1, b1, w2, b2 = (np.asarray(w, dtype=np.float64) for w in weights)
    dim = w1.shape[0]

    def make_predict():
        def predict(x: np.ndarray) -> np.ndarray:
            h = x.astype(np.float64) @ w1 + b1
            h = h / (1.0 + np.exp(-h))
            return h @ w2 + b2
        return predict

    fn = predict_batch_udf(make_predict, return_type=ArrayType(DoubleType()),
                           batch_size=batch_size, input_tensor_shapes=[[dim]])
    return df.withColumn(out, fn(F.col(vec_col).cast("array<double>")))


def candidate_score_arrays(df: DataFrame, model_fn: Callable, seq: str = "eval_seqs",
                           cands: str = "candidate_items", seq_len: int | None = None,
                           n_cands: int | None = None, out: str = "scores",
                           batch_size: int = 1024) -> DataFrame:
    """M5 with a user model: ``model_fn`` is a ``make_predict_fn`` for
    ``predict_batch_udf`` taking (seqs, candidates) Arrow batches and
    returning one score per candidate; adds the score array ``out``."""
    from pyspark.ml.functions import predict_batch_udf

    from recprep.session import ship_package

    ship_package(df.sparkSession)
    fn = predict_batch_udf(model_fn, return_type=ArrayType(DoubleType()), batch_size=batch_size,
                           input_tensor_shapes=[[seq_len], [n_cands]])
    return df.withColumn(out, fn(F.col(seq), F.col(cands)))


@dataclass
class WrittenVectors:
    """Item vectors (vec_id, embedding) read from files, with their measures."""
    table: DataFrame
    rows: int
    size: int
    large: bool              # above the broadcast bounds


def write_vectors(item_vectors: DataFrame, vec_key: str = "vec_id", vec: str = "embedding") -> WrittenVectors:
    """Write the vectors once and measure them."""
    table = staged(item_vectors.select(F.col(vec_key).alias("vec_id"), F.col(vec).alias("embedding")), "item-vectors")
    rows = table.count()
    size = table_bytes(table, rows)
    return WrittenVectors(table, rows, size, rows > broadcast_limit(table) or size > broadcast_bytes_limit(table))


def scored_lists(df: DataFrame, vectors: WrittenVectors, key: str = "user_id", seq: str = "eval_seqs",
                 cands: str = "candidate_items", skip: tuple = (0,), written: bool = False) -> DataFrame | None:
    """M5's built-in scores as lists (key, ``cands``, ``scores``) where the
    vectors are above the broadcast bounds and have plain ids, one vector each
    (``list_scoring``); else None. ``written``: ``df`` is read from files."""
    if not vectors.large or not list_scoring.can_score(df, seq, cands):
        return None
    dim = list_scoring.vector_length(vectors.table)
    if dim is None:
        return None
    rows = df.select(key, seq, cands)
    rows = rows if written else staged(rows, "candidate-lists")
    layout = list_scoring.lay_out(vectors.table, dim, vectors.size)
    return list_scoring.score_lists(rows, layout, key, seq, cands, skip)


def score_candidates(df: DataFrame, key: str = "user_id", seq: str = "eval_seqs",
                     cands: str = "candidate_items", item_vectors: DataFrame | None = None,
                     model_fn: Callable | None = None, seq_len: int | None = None,
                     n_cands: int | None = None, pad: int = 0, mask_id: int | None = None,
                     vec_key: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """M5: score every candidate of every row -> (key, position, item, score).

    Built-in scorer: mean embedding of the history (pad and mask dropped)
    dotted with each candidate's embedding. Or pass ``model_fn`` -- a
    ``make_predict_fn`` for ``predict_batch_udf`` taking (seqs, candidates)
    batches and returning one score per candidate.

    The vectors are written once. Under the broadcast bounds every candidate
    meets its vector where it is; above them each task reads the vectors
    (``scored_lists``), or, if ids repeat or vectors are ragged, both meet by
    ``_grid_scores``.
    """
    if model_fn is not None:
        scored = candidate_score_arrays(df, model_fn, seq, cands, seq_len, n_cands, out="_scores")
        return scored.select(key, F.posexplode(F.arrays_zip(F.col(cands).alias("item"),
                                                            F.col("_scores").alias("score")))
                             .alias("position", "_z")) \
                     .select(key, "position", F.col("_z.item").alias("item"),
                             F.col("_z.score").alias("score"))
    skip = (pad,) if mask_id is None else (pad, mask_id)
    vectors = write_vectors(item_vectors, vec_key, vec)
    table, rows = vectors.table, vectors.rows
    lists = scored_lists(df, vectors, key, seq, cands, skip)
    if lists is not None:
        z = F.posexplode(F.arrays_zip(F.col(cands).alias("item"), F.col("scores").alias("score")))
        return lists.select(key, z.alias("position", "_z")).select(
            key, "position", F.col("_z.item").alias("item"), F.col("_z.score").alias("score"))
    hist = embedding_lookup_seq(df.select(key, seq), key, seq, table, out="_hv", skip=skip)
    hist = mean_vector(hist, key, "_hv", out="_user_vec").select(key, "_user_vec")
    # the user vector joins one row per user, before the explode
    c = df.select(key, F.col(cands).alias("_cands")).join(hist, key, "left")
    if vectors.large:
        return _grid_scores(c, key, table, vectors.size)
    c = c.select(key, "_user_vec", F.posexplode("_cands").alias("position", "item"))
    c = embedding_lookup(c, "item", table, out="_iv", table_rows=rows)
    return c.select(key, "position", "item", dot("_user_vec", "_iv").alias("score"))


def _grid_scores(users: DataFrame, key: str, table: DataFrame, size: int) -> DataFrame:
    """Scores of ``users`` (key, ``_user_vec``, ``_cands``) against a table of
    ``size`` bytes that is too large to broadcast.

    A cell of the grid is a block of items and a share of the users. A user's
    vector goes once into each block that holds a candidate of the user, with
    the positions and items of these, and each block goes into every share:
    what is shuffled does not grow with the candidates times the vector. Both
    sides are partitioned by cell, so pairs are made after the exchange, where
    the block is hashed; the scores are written there.
    """
    cores = users.sparkSession.sparkContext.defaultParallelism
    blocks = max(2, -(-size // BLOCK_BYTES))
    shares = max(1, -(-CELLS_PER_CORE * cores // blocks))

    def block(c):
        return F.pmod(F.xxhash64(c.cast("string")), F.lit(blocks)).cast("int")

    placed = F.transform("_cands", lambda x, i: F.struct(i.alias("position"), x.alias("item"), block(x).alias("b")))
    left = users.select(key, "_user_vec", placed.alias("_placed"))
    left = left.select(key, "_user_vec", "_placed",
                       F.explode(F.array_distinct(F.transform("_placed", lambda x: x["b"]))).alias("_b"))
    share = F.pmod(F.xxhash64(F.col(key)), F.lit(shares)).cast("int")
    left = left.select(key, "_user_vec", (F.col("_b") * shares + share).alias("_cell"), F.transform(
        F.filter("_placed", lambda x: x["b"] == F.col("_b")),
        lambda x: F.struct(x["position"].alias("position"), x["item"].alias("item"))).alias("_pairs"))
    left = left.repartition(blocks * shares, "_cell").select(key, "_user_vec", "_cell", F.inline("_pairs"))
    right = table.select(F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("_s"), "vec_id", "embedding")
    right = right.select((block(F.col("vec_id")) * shares + F.col("_s")).alias("_at"), "vec_id",
                         F.col("embedding").alias("_iv")).repartition(blocks * shares, "_at")
    scored = left.join(right.hint("shuffle_hash"), (F.col("_cell") == F.col("_at")) & (F.col("item") == F.col("vec_id")),
                       "left")
    scored = scored.select(key, "position", "item", dot("_user_vec", "_iv").alias("score"))
    # both sides lie by cell, which is part of the join's keys: no exchange by all of them
    conf, name = users.sparkSession.conf, "spark.sql.requireAllClusterKeysForCoPartition"
    before = conf.get(name)
    conf.set(name, "false")
    try:
        return staged(scored, "grid-scores")
    finally:
        conf.set(name, before)
