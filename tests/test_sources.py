import gzip
import io
import json
import os
import struct

import pytest
from pyspark.sql import functions as F

from recprep.session import staging_path
from recprep.sources import files, tfrecord


def test_csv_types_by_name_not_position(spark, tmp_path):
    p = tmp_path / "inter.csv"
    p.write_text("rating,book_id,user_id,is_read,is_reviewed\n5,10,1,1,0\n3,11,2,0,1\n")
    df = files.read_interactions(spark, str(p))
    assert dict(df.dtypes) == {"rating": "tinyint", "book_id": "int", "user_id": "int",
                               "is_read": "tinyint", "is_reviewed": "tinyint"}
    assert sorted(tuple(r) for r in df.select("user_id", "book_id", "rating").collect()) == \
        [(1, 10, 5), (2, 11, 3)]


def test_id_map_renamed_by_position(spark, tmp_path):
    p = tmp_path / "map.csv"
    p.write_text("a,b\n0,xyz\n1,abc\n")
    df = files.read_id_map(spark, str(p), ["book_id", "book_original_id"], {"book_id": "int"})
    assert df.dtypes == [("book_id", "int"), ("book_original_id", "string")]


def test_item_metadata_json_gz_strings(spark, tmp_path):
    p = tmp_path / "books.json.gz"
    recs = [{"book_id": "1", "language_code": "eng", "is_ebook": "false", "average_rating": "4.1",
             "format": "", "publisher": "P", "num_pages": 300, "publication_year": "2001",
             "ignored": [1, 2]}]
    with gzip.open(p, "wt") as fh:
        for r in recs:
            fh.write(json.dumps(r) + "\n")
    df = files.read_item_metadata(spark, str(p))
    row = df.first()
    assert row["num_pages"] == "300" and row["format"] == "" and "ignored" not in df.columns


def test_write_parts_equal_and_shuffled(spark):
    df = spark.range(0, 1000).select(F.col("id").cast("int").alias("k"))
    out = staging_path(spark, "parts")
    path = files.write_parts(df, out, "train", 8, shuffle=True, keys=["k"])
    back = spark.read.parquet(path)
    assert sorted(r[0] for r in back.collect()) == list(range(1000))
    sizes = [r[1] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) < 80
    assert files.dataset_size(spark, path) == 1000


def test_crc32c_vector():
    assert tfrecord.crc32c(b"123456789") == 0xE3069283
    chunks = [b"", b"a", b"123456789", os.urandom(300)]
    assert list(tfrecord.masked_crcs(chunks)) == [tfrecord.masked_crc(c) for c in chunks]


def test_example_codec_hand_bytes():
    ex = tfrecord.encode_example({"a": ("int", [1, -2]), "b": ("float", [0.5]),
                                  "c": ("bytes", [b"hi"])})
    got = tfrecord.decode_example(ex)
    assert got == {"a": [1, -2], "b": [0.5], "c": [b"hi"]}
    # Example{features{feature{key:"a" value{int64_list{value:[1]}}}}}, packed
    one = tfrecord.encode_example({"a": ("int", [1])})
    assert one == bytes([0x0A, 0x0C, 0x0A, 0x0A, 0x0A, 0x01, 0x61, 0x12, 0x05,
                         0x1A, 0x03, 0x0A, 0x01, 0x01])
    buf = io.BytesIO()
    tfrecord.write_records(buf, [ex, one])
    buf.seek(0)
    assert [p for chunk in tfrecord.read_record_chunks(buf) for p in chunk] == [ex, one]
    bad = bytearray(buf.getvalue())
    bad[-1] ^= 0xFF
    with pytest.raises(ValueError):
        list(tfrecord.read_record_chunks(io.BytesIO(bytes(bad))))


def test_tfrecord_roundtrip(spark):
    tfrecord.register(spark)
    df = spark.createDataFrame(
        [(1, 2.5, "x", [1, 2]), (2, -1.0, None, []), (3, 0.0, "z", [7])],
        "id bigint, v float, s string, l array<bigint>")
    path = staging_path(spark, "tfr")
    df.repartition(2).write.format("tfrecord").mode("overwrite").save(path)
    back = spark.read.format("tfrecord").schema("id bigint, v float, s string, l array<bigint>") \
                .load(path)
    assert sorted(tuple(r) for r in back.collect()) == \
        [(1, 2.5, "x", [1, 2]), (2, -1.0, None, []), (3, 0.0, "z", [7])]


def test_tfrecord_commit_drops_uncommitted_attempts(spark):
    from pyspark.sql.types import LongType, StructField, StructType
    schema = StructType([StructField("id", LongType())])
    path = staging_path(spark, "tfr-attempts")
    w = tfrecord.TFRecordWriter(schema, {"path": path}, overwrite=False)
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"id": pa.array([1, 2], pa.int64())})
    good = w.write(iter([batch]))
    stray = w.write(iter([batch]))               # a retried attempt of the same task
    w.commit([good])
    tfrecord.register(spark)
    back = spark.read.format("tfrecord").schema("id bigint").load(path)
    assert sorted(r[0] for r in back.collect()) == [1, 2]
    assert not os.path.exists(stray.path)


def test_tfrecord_through_a_file_uri_and_column_encoder(spark):
    import math
    import pyarrow as pa
    tfrecord.register(spark)
    df = spark.createDataFrame([(1, 0.0, "x", [1, 2], True), (2, -0.0, None, None, None), (-3, 1e30, "", [], False),
                                (2, float("inf"), "x", [7], True)],
                               "id bigint, v float, s string, l array<bigint>, b boolean")
    path = staging_path(spark, "tfr-uri")
    uri = path if path.startswith("file:") else "file://" + path
    df.write.format("tfrecord").mode("overwrite").save(uri)
    schema = "id bigint, v float, s string, l array<bigint>, b boolean"
    for where in (uri, uri.removeprefix("file://").removeprefix("file:")):
        back = spark.read.format("tfrecord").schema(schema).load(where).collect()
        assert sorted(map(str, back)) == sorted(map(str, df.collect()))
    enc = [tfrecord.ColumnEncoder("a", "int", False, most=2), tfrecord.ColumnEncoder("f", "float", False)]
    a, f = [5, -1, None, 5, 9], [0.0, -0.0, 2.5, None, 0.0]
    for _ in range(3):
        got = tfrecord.encode_batch([pa.array(a), pa.array(f, pa.float32())], enc)
        for x, y, e in zip(a, f, got):
            want = {k: (t, [v]) for k, t, v in (("a", "int", x), ("f", "float", y)) if v is not None}
            assert e == tfrecord.encode_example(want)
            back = tfrecord.decode_example(e).get("f")
            assert back is None or math.copysign(1, back[0]) == math.copysign(1, y)


def test_parts_of_several_files_stay_equal(spark):
    from recprep.sources import files
    df = spark.range(0, 4000).selectExpr("id", "id % 7 AS k")
    out = staging_path(spark, "parts")
    for prefix, extra in (("train", {"shuffle": True, "keys": ["id"]}), ("eval", {"order": ["id"]})):
        path = files.write_parts(df, out, prefix, 4, files=3, **extra)
        back = spark.read.parquet(path)
        sizes = [r["count"] for r in back.groupBy("part").count().collect()]
        assert len(sizes) == 4 and min(sizes) > 700 and sum(sizes) == 4000
        assert len(back.inputFiles()) == 12
        assert back.select("id").distinct().count() == 4000
    assert files.files_per_part(5_000_000 * 8 + 1, 8) == 2 and files.files_per_part(10, 8) == 1


def test_fast_and_general_decoders_agree():
    import random
    rnd = random.Random(3)
    for _ in range(300):
        feats = {}
        for j in range(rnd.randint(0, 6)):
            kind = rnd.choice(["int", "float", "bytes"])
            k = rnd.randint(0, 4)
            if kind == "int":
                vals = [rnd.randint(-2**63, 2**63 - 1) for _ in range(k)]
            elif kind == "float":
                vals = [float(struct.unpack("<f", struct.pack("<f", rnd.uniform(-1e6, 1e6)))[0])
                        for _ in range(k)]
            else:
                vals = [bytes(rnd.getrandbits(8) for _ in range(rnd.randint(0, 200)))
                        for _ in range(k)]
            feats[f"f{j}_{'x' * rnd.randint(0, 150)}"] = (kind, vals)
        ex = tfrecord.encode_example(feats)
        assert tfrecord._decode_fast(ex) == tfrecord._decode_general(ex)
        assert tfrecord.decode_example(ex) == {k: v for k, (_, v) in feats.items()}
