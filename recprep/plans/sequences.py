"""Sequence plan (J7, section 3.2): BERT-style train windows and eval sets.

filter users (20..200) -> dense 1-based ids -> item popularity -> leave-last-
two split -> mask train items -> sliding windows (train set); last window of
train items + mask, and [eval item] + k weighted negatives that exclude the
user's train and eval items (eval set). Arrays are collected from at most
``seq_len`` or ``k`` rows, or from a whole history, which the user filter
bounds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recprep.operators.aggregates import item_popularity
from recprep.operators.encoding import reindex_ids
from recprep.operators.filters import filter_by_activity
from recprep.operators.sampling import popularity_table, sample_negatives_excluding
from recprep.operators.sequences import (
    candidate_lists, eval_sequences, mask_tokens, sliding_sequences,
)
from recprep.operators.windows import EVAL, TEST, TRAIN, split_leave_last
from recprep.session import staged

# The reference's sequence settings.
MIN_INTERACTIONS, MAX_INTERACTIONS = 20, 200
SEQ_LEN, SLIDING_STEP, MASK_PROB = 20, 10, 0.2
EVAL_NEG_NUM, SEED = 100, 42


@dataclass
class SequenceData:
    rows: DataFrame          # user_id, book_id (dense), pos, n, role
    n_users: int
    n_items: int
    mask_id: int
    total: int
    max_rows_per_user: int | None = None   # the activity filter's upper bound


def prepare(interactions: DataFrame, lo: int = MIN_INTERACTIONS, hi: int | None = MAX_INTERACTIONS,
            method: str | None = None) -> SequenceData:
    """Filter, re-index and split; the shared front of both sets. Groups are
    bounded by ``hi``, so the split is a per-user window (``auto`` without
    an upper bound)."""
    method = method or ("window" if hi is not None else "auto")
    # the filter reads the pairs twice, and the filtered ones feed two
    # vocabularies, counts and the split: each is written once, as columns
    pairs = staged(interactions.select("user_id", "book_id"), "pairs")
    data = staged(filter_by_activity(pairs, "user_id", lo, hi), "active-pairs")
    ids = reindex_ids(data, "user_id", "book_id", written=True)
    rows = staged(split_leave_last(ids["data"], "user_id", ["book_id"], method=method), "sequence-rows")
    total = rows.count()
    return SequenceData(rows, ids["n_users"], ids["n_items"], ids["mask_id"], total, hi)


def train_rows(sd: SequenceData) -> DataFrame:
    return (sd.rows.where(F.col("role") == TRAIN)
                   .withColumn("n_train", (F.col("n") - 2).cast("int")))


def bert_train_set(sd: SequenceData, seq_len: int = SEQ_LEN, step: int = SLIDING_STEP,
                   mask_prob: float = MASK_PROB, seed: int = SEED) -> DataFrame:
    """(user_id, window_start, train_interactions[L], labels[L])."""
    masked = mask_tokens(train_rows(sd), mask_prob, sd.mask_id, seed)
    return sliding_sequences(masked, seq_len, step, max_len=sd.max_rows_per_user)


def bert_eval_set(sd: SequenceData, seq_len: int = SEQ_LEN, k: int = EVAL_NEG_NUM,
                  seed: int = SEED, exclude_test: bool = False) -> DataFrame:
    """(user_id, eval_seqs[L], candidate_items[k + 1])."""
    rows = sd.rows
    eval_items = rows.where(F.col("role") == EVAL).select(
        "user_id", F.col("book_id").alias("eval_interactions"))
    seqs = eval_sequences(train_rows(sd), eval_items, seq_len, sd.mask_id)
    pos = rows if exclude_test else rows.where(F.col("role") != TEST)
    users = pos.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_pos"))
    pop = item_popularity(rows, "book_id", sd.total)
    table = popularity_table(pop, "book_id", sd.total)
    negs = sample_negatives_excluding(users, pos.select("user_id", "book_id"), table, k, seed,
                                      max_positives=sd.max_rows_per_user, as_lists=True)
    cands = candidate_lists(seqs, negs)
    return cands.select("user_id", "eval_seqs", "candidate_items")


def size_map(sd: SequenceData, spark) -> DataFrame:
    """A9 content for the sequence data: n_users, n_items."""
    return spark.createDataFrame([("n_users", sd.n_users), ("n_items", sd.n_items)],
                                 "name string, size bigint")


# Fixed value: the reference's part count.
SEQUENCE_PARTS = 2


def prepare_sequence_dataset(spark, data_dir: str, out_dir: str, n_parts: int = SEQUENCE_PARTS,
                             seq_len: int = SEQ_LEN, step: int = SLIDING_STEP,
                             mask_prob: float = MASK_PROB, k: int = EVAL_NEG_NUM,
                             seed: int = SEED, lo: int = MIN_INTERACTIONS,
                             hi: int | None = MAX_INTERACTIONS) -> dict:
    """Section 3.2 end to end: raw interactions -> train windows (shuffled
    parts) and eval sequences with candidates (parts), plus the
    ``n_users`` / ``n_items`` size map. Both sets are written once, and their
    bytes say how many files a part gets (``write_parts``)."""
    from recprep.plans.ranking import INTERACTIONS_FILE
    from recprep.sources import files

    inter = files.read_interactions(spark, f"{data_dir.rstrip('/')}/{INTERACTIONS_FILE}")
    sd = prepare(inter, lo, hi)
    files.write_size_map(size_map(sd, spark), f"{out_dir}/size_map_bert4rec")
    train = staged(bert_train_set(sd, seq_len, step, mask_prob, seed).select(
        "user_id", "train_interactions", "labels", "window_start"), "train-windows")
    ev = staged(bert_eval_set(sd, seq_len, k, seed), "eval-sequences")
    out = {
        "train": files.write_parts(train, f"{out_dir}/parquet_bert4rec", "train", n_parts,
                                   shuffle=True, seed=seed, keys=["user_id", "window_start"],
                                   files=files.files_for_bytes(train, n_parts)),
        "eval": files.write_parts(ev, f"{out_dir}/parquet_bert4rec", "eval", n_parts,
                                  order=["user_id"], files=files.files_for_bytes(ev, n_parts)),
        "size_map": f"{out_dir}/size_map_bert4rec",
        "n_users": sd.n_users, "n_items": sd.n_items,
    }
    return out
