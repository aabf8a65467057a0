from pyspark.sql import functions as F

from recprep.operators.sequences import eval_sequences, mask_tokens, sliding_sequences
from recprep.operators.windows import split_leave_last

L, STEP, MASK = 20, 10, 999


def _train_rows(spark, lengths):
    rows = [(u, p, 100 + p, n) for u, n in enumerate(lengths) for p in range(n)]
    return spark.createDataFrame(rows, "user_id int, pos int, book_id int, n_train int")


def _reference_windows(seq, seq_len, step):
    border = (len(seq) - 1) // step * step
    padded = seq + [0] * (border + seq_len - len(seq))
    return [padded[i:i + seq_len] for i in range(0, len(seq), step)]


def test_window_count_and_padding(spark):
    lengths = [1, 5, 20, 21, 30, 40]
    df = _train_rows(spark, lengths)
    out = sliding_sequences(df, L, STEP, cols=["book_id"]).collect()
    for u, n in enumerate(lengths):
        got = [r["book_id"] for r in sorted((r for r in out if r["user_id"] == u),
                                            key=lambda r: r["window_start"])]
        assert got == _reference_windows([100 + p for p in range(n)], L, STEP)


def test_windows_rebuild_sequence_when_step_equals_length(spark):
    df = _train_rows(spark, [7, 23])
    out = sliding_sequences(df, 5, 5, cols=["book_id"]).collect()
    for u, n in enumerate([7, 23]):
        ws = sorted((r for r in out if r["user_id"] == u), key=lambda r: r["window_start"])
        flat = [x for r in ws for x in r["book_id"] if x != 0]
        assert flat == [100 + p for p in range(n)]


def test_step_longer_than_window_rejected(spark):
    import pytest
    with pytest.raises(ValueError):
        sliding_sequences(_train_rows(spark, [3]), 5, 6)


def test_masking_last_always_and_ratio(spark):
    lengths = [50] * 200
    df = _train_rows(spark, lengths)
    m = mask_tokens(df, 0.2, MASK, seed=42).collect()
    last = [r for r in m if r["pos"] == r["n_train"] - 1]
    assert all(r["train_interactions"] == MASK and r["labels"] == r["book_id"] for r in last)
    others = [r for r in m if r["pos"] != r["n_train"] - 1]
    assert all((r["labels"] == 0) == (r["train_interactions"] != MASK) for r in others)
    ratio = sum(r["train_interactions"] == MASK for r in m) / len(m)
    expected = 0.2 + 0.8 * 200 / len(m)
    assert abs(ratio - expected) < 0.02


def test_eval_sequences_left_padded(spark):
    df = _train_rows(spark, [0, 3, 25])
    users = spark.createDataFrame([(0, 7), (1, 8), (2, 9)], "user_id int, eval_interactions int")
    out = {r["user_id"]: r["eval_seqs"] for r in
           eval_sequences(df, users, 5, MASK).collect()}
    assert out[0] == [0, 0, 0, 0, MASK]
    assert out[1] == [0, 100, 101, 102, MASK]
    assert out[2] == [121, 122, 123, 124, MASK]


def test_bounded_history_windows_equal_row_windows(spark):
    lengths = [1, 5, 20, 21, 30, 40]
    df = _train_rows(spark, lengths)
    a = sliding_sequences(df, L, STEP, cols=["book_id"]).collect()
    b = sliding_sequences(df, L, STEP, cols=["book_id"], max_len=40).collect()
    key = lambda r: (r["user_id"], r["window_start"], tuple(r["book_id"]))
    assert sorted(map(key, a)) == sorted(map(key, b))
    for u, n in enumerate(lengths):
        got = [r["book_id"] for r in sorted((r for r in b if r["user_id"] == u),
                                            key=lambda r: r["window_start"])]
        assert got == _reference_windows([100 + p for p in range(n)], L, STEP)
