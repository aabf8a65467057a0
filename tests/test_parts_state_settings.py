"""Column-wise Example decoding, input packing, committed stream states,
settings, segmented sequences and epochs without a sort."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recprep import cli
from recprep.operators.batching import epoch_positions
from recprep.operators.indexing import with_row_index
from recprep.operators.sequences import collect_sequence_chunks, split_leave_last_chunks, split_leave_last_lists
from recprep.plans.ranking import check_features
from recprep.session import staged, staging_path
from recprep.sources import tfrecord
from recprep.sources.example_columns import decode_columns
from recprep.streaming import streams

SCHEMA = pa.schema([("a", pa.int64()), ("f", pa.float32()), ("s", pa.string()), ("l", pa.list_(pa.int32())),
                    ("x", pa.float64()), ("b", pa.bool_()), ("gone", pa.int16())])
KINDS = dict(a="int", f="float", s="bytes", l="int", x="float", b="int", gone="int")


def _one_by_one(payloads):
    cols = {f.name: [] for f in SCHEMA}
    for ex in map(tfrecord.decode_example, payloads):
        for f in SCHEMA:
            v = ex.get(f.name)
            if v is None or f.name == "l":
                cols[f.name].append(v)
            else:
                one = v[0] if v else None
                cols[f.name].append(one.decode() if f.name == "s" and v else bool(one) if f.name == "b" and v else one)
    return pa.RecordBatch.from_pydict(cols, schema=SCHEMA)


def _payloads(n, holes, seed=3):
    draw = random.Random(seed)
    out = []
    for _ in range(n):
        f = {"a": ("int", [draw.choice([0, 5, -1, 1 << 40, -(1 << 63), (1 << 63) - 1])]),
             "other": ("bytes", [b"not asked for"]),
             "f": ("float", [draw.random()]), "x": ("float", [1.5, 2.5]), "b": ("int", [draw.randint(0, 1)]),
             "s": ("bytes", [draw.choice([b"", b"x", "é".encode(), b"y" * 300])]),
             "l": ("int", [draw.randint(-5, 500) for _ in range(draw.randint(0, 5))])}
        if holes:
            f = {k: v for k, v in f.items() if draw.random() > 0.1}
        out.append(tfrecord.encode_example(f))
    return out


@pytest.mark.parametrize("n,holes", [(0, False), (3, False), (1000, False), (2000, True)])
def test_columns_decode_as_records_do(n, holes):
    payloads = _payloads(n, holes)
    assert decode_columns(payloads, SCHEMA, KINDS, tfrecord.feature_order, _one_by_one).equals(_one_by_one(payloads))


def test_one_layout_needs_no_record_decoder():
    def never(payloads):
        raise AssertionError("record by record")
    payloads = _payloads(500, False)
    assert decode_columns(payloads, SCHEMA, KINDS, tfrecord.feature_order, never).num_rows == 500


def test_damaged_and_unpacked_records_take_the_record_decoder():
    payloads = _payloads(100, False)
    # an Example whose int list is not packed: tag 0x08 before each value
    entry = tfrecord._name_field("a") + tfrecord._len_field(2, tfrecord._len_field(3, b"\x08\x07"))
    payloads[17] = tfrecord._len_field(1, tfrecord._len_field(1, entry))
    payloads[40] = b""
    got = decode_columns(payloads, SCHEMA, KINDS, tfrecord.feature_order, _one_by_one)
    assert got.equals(_one_by_one(payloads)) and got.column("a")[17].as_py() == 7


def test_small_files_share_a_partition_and_large_ones_do_not():
    mb = 1 << 20
    paths = [f"p{i}" for i in range(1000)]
    groups = tfrecord.pack_files(paths, [1000] * 1000, 8)
    assert sorted(sum(groups, [])) == sorted(paths) and 8 <= len(groups) < 100
    assert len(tfrecord.pack_files(paths[:8], [300_000] * 8, 8)) == 8
    assert len(tfrecord.pack_files(paths[:3], [500 * mb] * 3, 1)) == 3


def test_state_is_whole_replayed_epochs_change_nothing(spark):
    path = staging_path(spark, "state")
    state = lambda n: spark.createDataFrame([(0, n, n, float(n))], streams.STATE_SCHEMA)
    assert streams.read_state(spark, path).count() == 0
    streams.save_state(state(1), 0, path)
    streams.save_state(state(2), 1, path)
    streams.save_state(state(99), 1, path)                       # the same epoch once more
    assert [r.pos for r in streams.read_state(spark, path).collect()] == [2]
    before = streams.read_state(spark, path)                     # planned before the next write ...
    state(77).write.parquet(f"{path}/epoch-2")                   # ... which fails before its commit
    assert [r.pos for r in streams.read_state(spark, path).collect()] == [2]
    streams.save_state(state(3), 2, path)                        # and runs again
    assert [r.pos for r in before.collect()] == [2]
    assert [r.pos for r in streams.read_state(spark, path).collect()] == [3]
    for e in range(3, 14):
        streams.save_state(state(e + 1), e, path, keep=4)
    assert [r.pos for r in streams.read_state(spark, path).collect()] == [14]
    import os
    assert sum(n.startswith("epoch-") for n in os.listdir(path.removeprefix("file:"))) == 4


def test_settings_come_from_file_and_command_line(tmp_path):
    toml = tmp_path / "run.toml"
    toml.write_text('[sequence-prep]\nseq_len = 30\nmask_prob = 0.1\n[ranking-prep]\nratio = 0.9\n')
    assert cli.settings("sequence-prep", str(toml), ["seq_len=40", "k=7"]) == {
        "seq_len": 40, "mask_prob": 0.1, "k": 7}
    assert cli.settings("ranking-prep", str(toml), ["write_format=tfrecord"]) == {
        "ratio": 0.9, "write_format": "tfrecord"}
    with pytest.raises(ValueError, match="unknown"):
        cli.settings("ranking-prep", None, ["seq_len=3"])
    with pytest.raises(ValueError, match="pair"):
        cli.settings("ranking-prep", None, ["seed"])


def test_features_with_nulls_are_refused(spark):
    good = spark.createDataFrame([(1, 2)], "book_id int, format int")
    assert check_features(good) is good
    with pytest.raises(ValueError, match="format"):
        check_features(spark.createDataFrame([(1, None)], "book_id int, format int"))


def test_segmented_sequences_equal_the_lists(spark):
    rows = [(u, (i * 7919) % 1000 + i) for u, n in ((1, 25), (2, 1), (3, 2), (None, 9)) for i in range(n)]
    df = spark.createDataFrame(rows, "user_id int, book_id int")
    for method in ("window", "global"):
        whole, last = {}, {}
        parts = split_leave_last_chunks(df, chunk=4, method=method).orderBy("user_id", "chunk").collect()
        for r in parts:
            assert len(r.train_interactions) <= 4
            whole.setdefault(r.user_id, []).extend(r.train_interactions)
            last[r.user_id] = (r.eval_interactions, r.test_interactions)
        want = split_leave_last_lists(df).collect()
        assert whole == {r.user_id: r.train_interactions for r in want}
        assert last == {r.user_id: (r.eval_interactions, r.test_interactions) for r in want}
        d4 = collect_sequence_chunks(df, "user_id", "book_id", ["book_id"], chunk=4, method=method).collect()
        assert max(len(r.book_id) for r in d4) == 4 and sum(len(r.book_id) for r in d4) == len(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 97, 1000])
def test_epoch_positions_are_bijections_that_differ(spark, n):
    df = spark.range(n).withColumnRenamed("id", "row_idx")
    a, b = (epoch_positions(df, n, 42, e).collect() for e in (1, 2))
    for rows in (a, b):
        assert sorted(r.position for r in rows) == list(range(n))
    if n >= 97:
        assert sum(r.position == s.position for r, s in zip(a, b)) < n / 10
        near = sum(abs(r.position - s.position) == 1 for r, s in zip(a, a[1:]))
        assert near < n / 10


def test_a_later_epoch_has_no_exchange(spark):
    rows = staged(with_row_index(spark.range(500).withColumnRenamed("id", "k"), ["k"]), "index")
    plan = epoch_positions(rows, 500, 1, 2).select("position")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
