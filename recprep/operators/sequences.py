"""Sequence preparation (D4, E4 list form, J1-J3, J6, H10-H12 uses).

Scale note: the train windows (J2), eval sequences (J3) and candidate lists
(J6) are built from *rows* carrying their position in the user's history, and
each output array is collected from at most ``seq_len`` (or ``k + 1``) rows.
No operator gathers a user's whole history into one array unless asked to
(``collect_sequences``), so a long history never becomes one huge value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recprep.functions.arrays import pad_left, pad_right
from recprep.functions.random import uniform
from recprep.operators.indexing import rank_within

PAD_ID = 0
#: items that one row of a segmented list holds at most
CHUNK = 65_536


def _field(name: str):
    """One-argument lambda for ``transform`` (a second argument would be
    taken as the element index)."""
    return lambda x: x[name]


def collect_sequences(df: DataFrame, key: str, order, cols, suffix: str = "") -> DataFrame:
    """Per key, ordered lists of aligned columns (sorted on ``order``; a
    struct sort, never relying on ``collect_list`` order)."""
    order = [order] if isinstance(order, str) else list(order)
    cols = [cols] if isinstance(cols, str) else list(cols)
    fields = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)] + [F.col(c) for c in cols]
    s = df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("_seq"))
    return s.select(key, *[F.transform("_seq", _field(c)).alias(c + suffix) for c in cols])


def collect_sequence_chunks(df: DataFrame, key: str, order, cols, chunk: int = CHUNK,
                            method: str = "auto") -> DataFrame:
    """D4 for keys of any length: ``collect_sequences`` cut into rows (key,
    ``chunk`` from 0, lists of at most ``chunk`` elements), so no task gathers a
    whole key. ``order`` must tell a key's rows apart; rows equal in it and in
    ``cols`` may change places unseen. Null keys form one key, as in D4."""
    order = [order] if isinstance(order, str) else list(order)
    cols = [cols] if isinstance(cols, str) else list(cols)
    rows = rank_within(df, key, [*order, *[c for c in cols if c not in order]], pos="_pos", size="_n", method=method)
    return _gathered(rows, key, cols, F.floor(F.col("_pos") / chunk).cast("int"))


def _gathered(rows: DataFrame, key: str, cols: list[str], number, *others) -> DataFrame:
    fields = [F.col("_pos"), *[F.col(c) for c in cols]]
    s = rows.groupBy(key, number.alias("chunk")).agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias("_seq"), *others)
    kept = [c for c in s.columns if c not in (key, "chunk", "_seq")]
    return s.select(key, "chunk", *[F.transform("_seq", _field(c)).alias(c) for c in cols], *kept)


def split_leave_last_chunks(df: DataFrame, key: str = "user_id", order: str = "book_id",
                            item: str = "book_id", chunk: int = CHUNK, method: str = "auto") -> DataFrame:
    """E4 (list form) for keys of any length: rows (key, ``chunk``,
    ``train_interactions`` of at most ``chunk`` items); a key's last chunk also
    has ``eval_interactions`` and ``test_interactions``, the others null."""
    ordered = [order] if order == item else [order, item]
    rows = rank_within(df, key, ordered, pos="_pos", size="_n", method=method)
    at, left = F.col("_pos"), F.col("_n") - F.col("_pos")
    # the last two rows fall into the chunk of the last train item
    place = F.greatest(F.least(at, F.col("_n") - 3), F.lit(0))
    rows = rows.withColumn("_item", F.when(left > 2, F.col(item)))
    return _gathered(rows, key, ["_item"], F.floor(place / chunk).cast("int"),
                     F.max(F.when(left == 2, F.col(item))).alias("eval_interactions"),
                     F.max(F.when(left == 1, F.col(item))).alias("test_interactions"),
                     F.sum((left > 2).cast("int")).alias("_train")).select(
        key, "chunk", F.slice("_item", F.lit(1), F.col("_train").cast("int")).alias("train_interactions"),
        "eval_interactions", "test_interactions")


def split_leave_last_lists(df: DataFrame, key: str = "user_id", order: str = "book_id",
                           item: str = "book_id") -> DataFrame:
    """E4 (list form): ``train_interactions`` = all but the last two items,
    ``eval_interactions`` = second last, ``test_interactions`` = last."""
    seqs = collect_sequences(df, key, [order], [item], suffix="_seq")
    a = F.col(item + "_seq")
    return seqs.select(
        key,
        F.slice(a, 1, F.greatest(F.size(a) - 2, F.lit(0))).alias("train_interactions"),
        F.try_element_at(a, F.lit(-2)).alias("eval_interactions"),
        F.try_element_at(a, F.lit(-1)).alias("test_interactions"),
    )


def mask_tokens(rows: DataFrame, prob: float, mask_id: int, seed: int, key: str = "user_id",
                pos: str = "pos", length: str = "n_train", item: str = "book_id",
                out_item: str = "train_interactions", out_label: str = "labels") -> DataFrame:
    """BERT-style masking of train rows.

    A row is masked when its uniform draw (J9 on seed, user, position) is
    ``<= prob``, and the last item of every sequence is always masked.
    Masked rows carry ``mask_id`` and keep the item as label; others get
    label ``PAD_ID``.
    """
    u = uniform(seed, key, pos)
    masked = (u <= F.lit(float(prob))) | (F.col(pos) == F.col(length) - 1)
    return rows.withColumn(out_label, F.when(masked, F.col(item)).otherwise(F.lit(PAD_ID)).cast("int")) \
               .withColumn(out_item, F.when(masked, F.lit(mask_id)).otherwise(F.col(item)).cast("int"))


def sliding_sequences(rows: DataFrame, seq_len: int, step: int, key: str = "user_id",
                      pos: str = "pos", cols=("train_interactions", "labels"),
                      start_col: str = "window_start", max_len: int | None = None) -> DataFrame:
    """Windows starting at 0, step, 2*step, ... (< n), each ``seq_len``
    long and right-padded with ``PAD_ID``; all ``cols`` windowed together.

    Without a length bound each row is sent to the windows that contain it
    (``ceil(seq_len/step)`` at most) and each window gathers at most
    ``seq_len`` rows. With ``max_len`` (a proven bound on a user's rows, such
    as the activity filter's ``hi``) each history is gathered once -- one
    shuffle of the rows instead of about ``seq_len/step`` copies -- and the
    windows are array slices.
    """
    if seq_len < step:
        raise ValueError("seq_len must be >= step")
    cols = list(cols)
    if max_len is not None:
        g = rows.groupBy(key).agg(F.array_sort(F.collect_list(
            F.struct(F.col(pos).alias("_p"), *cols))).alias("_s"))
        starts = F.sequence(F.lit(0), F.size("_s") - 1, F.lit(step))
        ex = g.select(key, "_s", F.explode(starts).alias("_start"))
        return ex.select(
            key, F.col("_start").cast("int").alias(start_col),
            *[pad_right(F.slice(F.transform("_s", _field(c)), F.col("_start") + 1, seq_len),
                        seq_len, PAD_ID).alias(c) for c in cols])
    p = F.col(pos)
    i_lo = F.greatest(F.lit(0), F.ceil((p - F.lit(seq_len - 1)) / F.lit(step)).cast("int"))
    i_hi = F.floor(p / F.lit(step)).cast("int")
    ex = rows.select(key, pos, *cols, F.explode(F.sequence(i_lo, i_hi)).alias("_win"))
    g = ex.groupBy(key, "_win").agg(
        F.array_sort(F.collect_list(F.struct(F.col(pos).alias("_p"), *cols))).alias("_w"))
    return g.select(key, (F.col("_win") * step).cast("int").alias(start_col),
                    *[pad_right(F.transform("_w", _field(c)), seq_len, PAD_ID).alias(c)
                      for c in cols])


def eval_sequences(train_rows: DataFrame, users: DataFrame, seq_len: int, mask_id: int,
                   key: str = "user_id", pos: str = "pos", length: str = "n_train",
                   item: str = "book_id", out: str = "eval_seqs") -> DataFrame:
    """Last ``seq_len`` of (pads + train items + mask), left-padded.

    ``users`` has one row per evaluated user (key plus any columns to keep);
    only each user's last ``seq_len - 1`` train rows are gathered.
    """
    tail = train_rows.where(F.col(pos) >= F.col(length) - (seq_len - 1))
    g = tail.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct(F.col(pos).alias("_p"), F.col(item).alias("_i"))))
         .alias("_t"))
    j = users.join(g, key, "left")
    items = F.coalesce(F.transform("_t", lambda x: x["_i"]), F.array().cast("array<int>"))
    seq = pad_left(F.concat(items, F.array(F.lit(mask_id))), seq_len, PAD_ID)
    return j.withColumn(out, seq.cast("array<int>")).drop("_t")


def candidate_lists(eval_items: DataFrame, negatives: DataFrame, key: str = "user_id",
                    answer: str = "eval_interactions", item: str = "book_id",
                    rank: str = "neg_rank", out: str = "candidate_items") -> DataFrame:
    """``[answer] + negatives`` in negative rank order; position 0 is the
    answer. Each list gathers at most k negatives. ``negatives`` has a row per
    negative or, without ``rank``, one list of them per key."""
    if rank in negatives.columns:
        negatives = negatives.groupBy(key).agg(
            F.array_sort(F.collect_list(F.struct(F.col(rank).alias("_r"), F.col(item).alias("_i")))).alias("_n")
        ).select(key, F.transform("_n", lambda x: x["_i"]).alias("_n"))
    else:
        negatives = negatives.select(key, F.col(item).alias("_n"))
    j = eval_items.join(negatives, key, "left")
    negs = F.coalesce("_n", F.array().cast("array<int>"))
    return j.withColumn(out, F.concat(F.array(F.col(answer)), negs).cast("array<int>")).drop("_n")
