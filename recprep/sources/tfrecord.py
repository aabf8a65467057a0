"""TFRecord source and sink as a PySpark Python Data Source.

``df.write.format("tfrecord").save(dir)`` writes one GZIP TFRecord file per
task, one ``tf.train.Example`` per row; ``spark.read.format("tfrecord")
.schema(ddl).load(dir)`` reads whole files, small ones together in one input
partition, and decodes a chunk of records column by column. Integer and
boolean columns become ``int64_list`` features, float/double ``float_list``,
string/binary ``bytes_list``; arrays of those become multi-value features.
Records carry masked CRC-32C checksums of the length and of the payload.
Files are opened through Arrow's file systems, so any store that they know
(local, HDFS, S3, GCS) can be written and read.
"""

from __future__ import annotations

import gzip
import io
import math
import os
import struct
import uuid
from collections import defaultdict
from typing import Iterator
from urllib.parse import urlparse

import numpy as np

from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage,
)
from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, ByteType, DoubleType, FloatType, IntegerType,
    LongType, ShortType, StringType, StructType,
)

from recprep.sources.example_columns import decode_columns

# ---------------------------------------------------------------- CRC-32C
_CRC_POLY = 0x82F63B78  # Castagnoli, reflected
_MASK_DELTA = 0xA282EAD8


def _crc_table() -> list:
    table = []
    for i in range(256):
        c = i
        for _ in range(8):
            c = (c >> 1) ^ _CRC_POLY if c & 1 else c >> 1
        table.append(c)
    return table


_TABLE = _crc_table()


def crc32c(data: bytes) -> int:
    crc = 0xFFFFFFFF
    t = _TABLE
    for b in data:
        crc = t[(crc ^ b) & 0xFF] ^ (crc >> 8)
    return crc ^ 0xFFFFFFFF


def masked_crc(data: bytes) -> int:
    c = crc32c(data)
    return (((c >> 15) | (c << 17)) + _MASK_DELTA) & 0xFFFFFFFF


_NP_TABLE = np.array(_TABLE, dtype=np.uint32)


def masked_crcs(chunks: list) -> np.ndarray:
    """Masked CRC-32C of many byte strings at once: strings of equal length
    are stacked and the table step runs column by column over all of them."""
    out = np.empty(len(chunks), dtype=np.uint32)
    groups = defaultdict(list)
    for i, c in enumerate(chunks):
        groups[len(c)].append(i)
    for length, idx in groups.items():
        crc = np.full(len(idx), 0xFFFFFFFF, dtype=np.uint32)
        if length:
            arr = np.frombuffer(b"".join(chunks[i] for i in idx), dtype=np.uint8)
            arr = arr.reshape(len(idx), length)
            for j in range(length):
                crc = _NP_TABLE[(crc ^ arr[:, j]) & 0xFF] ^ (crc >> np.uint32(8))
        crc ^= np.uint32(0xFFFFFFFF)
        rot = (crc >> np.uint32(15)) | (crc << np.uint32(17))
        out[np.asarray(idx)] = rot + np.uint32(_MASK_DELTA)
    return out


# ---------------------------------------------------------------- protobuf
_ONE_BYTE = [bytes([i]) for i in range(128)]
_TAGS = {1: b"\x0a", 2: b"\x12", 3: b"\x1a"}   # field number, wire type 2
_NAME_PREFIX: dict = {}


def _varint(n: int) -> bytes:
    if 0 <= n < 128:
        return _ONE_BYTE[n]
    n &= (1 << 64) - 1
    out = bytearray()
    while True:
        b = n & 0x7F
        n >>= 7
        if n:
            out.append(b | 0x80)
        else:
            out.append(b)
            return bytes(out)


def _read_varint(buf: bytes, i: int):
    b = buf[i]
    if b < 128:
        return b, i + 1
    shift = result = 0
    while True:
        b = buf[i]
        i += 1
        result |= (b & 0x7F) << shift
        if not b & 0x80:
            return result, i
        shift += 7


def _len_field(num: int, payload: bytes) -> bytes:
    tag = _TAGS.get(num) or _varint((num << 3) | 2)
    return tag + _varint(len(payload)) + payload


def _name_field(name: str) -> bytes:
    """Map-entry key field for a feature name (cached per name)."""
    got = _NAME_PREFIX.get(name)
    if got is None:
        got = _NAME_PREFIX[name] = _len_field(1, name.encode())
    return got


def _feature(kind: str, values) -> bytes:
    if kind == "int":
        packed = b"".join(_varint(int(v)) for v in values)
        return _len_field(3, _len_field(1, packed))
    if kind == "float":
        packed = struct.pack(f"<{len(values)}f", *values)
        return _len_field(2, _len_field(1, packed))
    body = b"".join(_len_field(1, v if isinstance(v, bytes) else str(v).encode()) for v in values)
    return _len_field(1, body)


def encode_example(features: dict) -> bytes:
    """``{name: (kind, [values])}`` -> serialized Example."""
    entries = b"".join(
        _len_field(1, _name_field(name) + _len_field(2, _feature(kind, vals)))
        for name, (kind, vals) in features.items())
    return _len_field(1, entries)


class ColumnEncoder:
    """The serialized map entries of one column, a batch at a time; entries of
    scalar values are remembered, up to ``most`` of them."""

    def __init__(self, name: str, kind: str, is_list: bool, most: int = 50_000):
        self.name, self.kind, self.is_list, self.most = name, kind, is_list, most
        self.known: dict = {None: b""}

    def _entry(self, values) -> bytes:
        return _len_field(1, _name_field(self.name) + _len_field(2, _feature(self.kind, values)))

    def __call__(self, column) -> list[bytes]:
        values = column.to_pylist()
        if self.is_list:
            return [b"" if v is None else self._entry(v) for v in values]
        known = self.known
        if self.kind == "float":                      # 0.0 and -0.0 are equal keys
            values = [v if v != 0 or v is None else (math.copysign(1.0, v), 0.0) for v in values]
        if len(known) > self.most:
            known = self.known = {None: b""}
        for v in set(values) - known.keys():
            known[v] = self._entry([math.copysign(0.0, v[0]) if isinstance(v, tuple) else v])
        return list(map(known.__getitem__, values))


def encode_batch(columns: list, encoders: list[ColumnEncoder]) -> list[bytes]:
    """Serialized Examples of the rows of one batch, encoded column by column."""
    heads: dict[int, bytes] = {}
    out = []
    for body in map(b"".join, zip(*[e(c) for e, c in zip(encoders, columns)])):
        head = heads.get(len(body))
        if head is None:
            head = heads[len(body)] = _TAGS[1] + _varint(len(body))
        out.append(head + body)
    return out


def _fields(buf: bytes):
    i, n = 0, len(buf)
    while i < n:
        key, i = _read_varint(buf, i)
        num, wire = key >> 3, key & 7
        if wire == 2:
            ln, i = _read_varint(buf, i)
            yield num, wire, buf[i:i + ln]
            i += ln
        elif wire == 0:
            v, i = _read_varint(buf, i)
            yield num, wire, v
        elif wire == 5:
            yield num, wire, buf[i:i + 4]
            i += 4
        elif wire == 1:
            yield num, wire, buf[i:i + 8]
            i += 8
        else:
            raise ValueError(f"unsupported wire type {wire}")


def _signed64(v: int) -> int:
    return v - (1 << 64) if v >= 1 << 63 else v


def _decode_list(kind: int, body: bytes) -> list:
    vals = []
    for num, wire, v in _fields(body):
        if num != 1:
            continue
        if kind == 3:  # int64
            if wire == 2:
                j = 0
                while j < len(v):
                    x, j = _read_varint(v, j)
                    vals.append(_signed64(x))
            else:
                vals.append(_signed64(v))
        elif kind == 2:  # float
            if wire == 2:
                vals.extend(struct.unpack(f"<{len(v) // 4}f", v))
            else:
                vals.append(struct.unpack("<f", v)[0])
        else:
            vals.append(bytes(v))
    return vals


class _Unexpected(Exception):
    pass


def _decode_fast(buf: bytes) -> dict:
    """Index-based parser for the standard Example layout (every message
    field length-delimited, list values packed or not); raises _Unexpected
    on anything else so the general parser takes over."""
    rv = _read_varint
    out = {}
    i, n = 0, len(buf)
    while i < n:
        tag = buf[i]
        ln, i = rv(buf, i + 1)
        end = i + ln
        if tag != 0x0A:                      # unknown Example field
            if tag & 7 != 2:
                raise _Unexpected
            i = end
            continue
        while i < end:                       # Features: map entries
            if buf[i] != 0x0A:
                raise _Unexpected
            el, i = rv(buf, i + 1)
            e_end = i + el
            name, fs, fe = None, 0, 0
            while i < e_end:
                t = buf[i]
                fl, i = rv(buf, i + 1)
                if t == 0x0A:
                    name = buf[i:i + fl].decode()
                elif t == 0x12:
                    fs, fe = i, i + fl
                elif t & 7 != 2:
                    raise _Unexpected
                i += fl
            vals = []
            j = fs
            while j < fe:                    # Feature: one list message
                kt = buf[j]
                kl, j = rv(buf, j + 1)
                kind, k_end = kt >> 3, j + kl
                while j < k_end:
                    vt = buf[j]
                    j += 1
                    wire = vt & 7
                    if kind == 3:
                        if wire == 2:
                            pl, j = rv(buf, j)
                            p_end = j + pl
                            while j < p_end:
                                x, j = rv(buf, j)
                                vals.append(x - (1 << 64) if x >= 1 << 63 else x)
                        elif wire == 0:
                            x, j = rv(buf, j)
                            vals.append(x - (1 << 64) if x >= 1 << 63 else x)
                        else:
                            raise _Unexpected
                    elif kind == 2:
                        if wire == 2:
                            pl, j = rv(buf, j)
                            vals.extend(struct.unpack_from(f"<{pl // 4}f", buf, j))
                            j += pl
                        elif wire == 5:
                            vals.append(struct.unpack_from("<f", buf, j)[0])
                            j += 4
                        else:
                            raise _Unexpected
                    elif kind == 1 and wire == 2:
                        pl, j = rv(buf, j)
                        vals.append(bytes(buf[j:j + pl]))
                        j += pl
                    else:
                        raise _Unexpected
            out[name] = vals
    return out


def decode_example(buf: bytes) -> dict:
    """Serialized Example -> ``{name: [values]}``."""
    try:
        return _decode_fast(buf)
    except (_Unexpected, IndexError, struct.error):
        return _decode_general(buf)


def feature_order(buf: bytes) -> list[tuple[str, str]]:
    """(name, kind) of a record's features, in its order; [] if it has none
    or one without a value list."""
    out = []
    for num, _, feats in _fields(buf):
        for fnum, _, entry in _fields(feats) if num == 1 else ():
            parts = {enum: ev for enum, _, ev in _fields(entry)} if fnum == 1 else {}
            kind = [k for k, _, _ in _fields(parts.get(2, b""))]
            if 1 not in parts or len(kind) != 1 or kind[0] not in _KIND_NAMES:
                return []
            out.append((bytes(parts[1]).decode(), _KIND_NAMES[kind[0]]))
    return out


_KIND_NAMES = {1: "bytes", 2: "float", 3: "int"}


def _decode_general(buf: bytes) -> dict:
    out = {}
    for num, _, feats in _fields(buf):
        if num != 1:
            continue
        for fnum, _, entry in _fields(feats):
            if fnum != 1:
                continue
            name, feature = None, b""
            for enum, _, ev in _fields(entry):
                if enum == 1:
                    name = bytes(ev).decode()
                elif enum == 2:
                    feature = ev
            for kind, _, body in _fields(feature):
                out[name] = _decode_list(kind, body)
    return out


def write_records(fh, payloads: list) -> None:
    """Frame and write a chunk of records with vectorised checksums."""
    heads = [struct.pack("<Q", len(p)) for p in payloads]
    hc, pc = masked_crcs(heads), masked_crcs(payloads)
    fh.write(b"".join(h + struct.pack("<I", int(a)) + p + struct.pack("<I", int(b))
                      for h, a, p, b in zip(heads, hc, payloads, pc)))


def read_record_chunks(fh, chunk: int = 4096, verify: bool = True) -> Iterator[list]:
    """Yield lists of payloads; checksums verified a chunk at a time."""
    heads, hcs, payloads, pcs = [], [], [], []
    while True:
        head = fh.read(12)
        if head:
            if len(head) < 12:
                raise ValueError("truncated TFRecord header")
            length = struct.unpack("<Q", head[:8])[0]
            payload = fh.read(length)
            tail = fh.read(4)
            if len(payload) < length or len(tail) < 4:
                raise ValueError("truncated TFRecord record")
            heads.append(head[:8])
            hcs.append(struct.unpack("<I", head[8:])[0])
            payloads.append(payload)
            pcs.append(struct.unpack("<I", tail)[0])
        if payloads and (not head or len(payloads) >= chunk):
            if verify and (np.any(masked_crcs(heads) != np.asarray(hcs, dtype=np.uint32))
                           or np.any(masked_crcs(payloads) != np.asarray(pcs, dtype=np.uint32))):
                raise ValueError("TFRecord checksum mismatch")
            yield payloads
            heads, hcs, payloads, pcs = [], [], [], []
        if not head:
            return


# ---------------------------------------------------------------- Spark glue
CHUNK_RECORDS = 4096


def store(path: str, default_fs: str | None = None):
    """(file system, path inside it) of a path or URI, as Spark resolves it: a
    path without a scheme lies on the default file system."""
    from pyarrow import fs

    scheme = urlparse(path).scheme
    if not scheme and default_fs and urlparse(default_fs).scheme not in ("", "file"):
        path = default_fs.rstrip("/") + "/" + path.lstrip("/")
    elif not scheme:
        return fs.LocalFileSystem(), os.path.abspath(path)
    elif scheme == "file":
        return fs.LocalFileSystem(), urlparse(path).path
    return fs.FileSystem.from_uri(path)


def _listed(files, where: str) -> list[str]:
    """Paths of the plain files right under ``where`` (none if it's missing)."""
    from pyarrow import fs

    found = files.get_file_info(fs.FileSelector(where, allow_not_found=True))
    return sorted(f.path for f in found if f.type == fs.FileType.File)


_INTS = (ByteType, ShortType, IntegerType, LongType, BooleanType)
_FLOATS = (FloatType, DoubleType)


def _kind(dt) -> str:
    if isinstance(dt, ArrayType):
        return _kind(dt.elementType)
    if isinstance(dt, _INTS):
        return "int"
    if isinstance(dt, _FLOATS):
        return "float"
    if isinstance(dt, (StringType, BinaryType)):
        return "bytes"
    raise TypeError(f"unsupported type for tfrecord: {dt}")


class _Commit(WriterCommitMessage):
    def __init__(self, path: str, rows: int):
        self.path, self.rows = path, rows


class TFRecordWriter(DataSourceArrowWriter):
    """One file per task, named ``part-<partition>-<job>-<attempt>``. Files
    are written under a temporary name and renamed when complete; on commit
    the driver keeps exactly the files named in the task commit messages, so
    retried or speculative task attempts leave no duplicate rows."""

    def __init__(self, schema: StructType, options: dict, overwrite: bool,
                 default_fs: str | None = None):
        self.job = uuid.uuid4().hex[:12]
        self.schema = schema
        if not options.get("path"):
            raise ValueError("tfrecord writer needs a path")
        self.path, self.default_fs = options.get("path"), default_fs
        self.level = int(options.get("compressionLevel", "6"))
        self.overwrite = overwrite

    def write(self, iterator) -> _Commit:
        """``iterator`` yields Arrow record batches (columns in schema order)."""
        from pyspark import TaskContext
        ctx = TaskContext.get()
        pid = ctx.partitionId() if ctx else 0
        files, where = store(self.path, self.default_fs)
        files.create_dir(where, recursive=True)
        target = f"{where.rstrip('/')}/part-{pid:05d}-{self.job}-{uuid.uuid4().hex[:8]}.tfrecord.gz"
        encoders = [ColumnEncoder(f.name, _kind(f.dataType), isinstance(f.dataType, ArrayType))
                    for f in self.schema.fields]
        n = 0
        with files.open_output_stream(target + ".inprogress", compression=None) as raw, \
                gzip.GzipFile(fileobj=raw, mode="wb", compresslevel=self.level) as fh:
            for batch in iterator:
                for at in range(0, batch.num_rows, CHUNK_RECORDS):
                    part = batch.slice(at, CHUNK_RECORDS)
                    write_records(fh, encode_batch(part.columns, encoders))
                    n += part.num_rows
        files.move(target + ".inprogress", target)
        return _Commit(target, n)

    def commit(self, messages) -> None:
        """Keep the committed files; drop this job's other attempts and, in
        overwrite mode, the record files of earlier writes."""
        keep = {m.path for m in messages if m is not None}
        files, where = store(self.path, self.default_fs)
        for f in _listed(files, where):
            name = os.path.basename(f)
            if name.startswith("part-") and ".tfrecord.gz" in name and f not in keep and (
                    f"-{self.job}-" in name or self.overwrite):
                files.delete_file(f)
        return None

    def abort(self, messages) -> None:
        files, where = store(self.path, self.default_fs)
        for f in _listed(files, where):
            if os.path.basename(f).startswith("part-") and f"-{self.job}-" in f:
                files.delete_file(f)


class TFRecordReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict, default_fs: str | None = None,
                 parallelism: int = 1):
        self.schema, self.parallelism = schema, parallelism
        self.path, self.default_fs = options.get("path"), default_fs
        self.verify = options.get("verifyChecksums", "true").lower() == "true"

    def partitions(self):
        from pyarrow import fs

        files, where = store(self.path, self.default_fs)
        whole = files.get_file_info(where).type == fs.FileType.File
        found = [where] if whole else [f for f in _listed(files, where)
                                       if f.endswith((".tfrecord.gz", ".tfrecord"))]
        if not found:
            return []
        sizes = [i.size or 0 for i in files.get_file_info(found)]
        return [InputPartition(group) for group in pack_files(found, sizes, self.parallelism)]

    def read(self, partition):
        """Yields Arrow record batches (one per chunk of records)."""
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        fields = [(f.name, f.dataType) for f in self.schema.fields]
        arrow_schema = to_arrow_schema(self.schema)
        files, _ = store(self.path, self.default_fs)
        kinds = {name: _kind(dt) for name, dt in fields}

        def one_by_one(payloads):
            cols = {name: [] for name, _ in fields}
            for payload in payloads:
                ex = decode_example(payload)
                for name, dt in fields:
                    vals = ex.get(name)
                    if vals is None:
                        cols[name].append(None)
                    elif isinstance(dt, ArrayType):
                        cols[name].append([_convert(v, dt.elementType) for v in vals])
                    else:
                        cols[name].append(_convert(vals[0], dt) if vals else None)
            return pa.RecordBatch.from_pydict(cols, schema=arrow_schema)

        for name in partition.value:
            with files.open_input_stream(name, compression=None) as raw, \
                    (gzip.GzipFile(fileobj=raw) if name.endswith(".gz")
                     else io.BufferedReader(raw, 1 << 20)) as fh:
                for payloads in read_record_chunks(fh, verify=self.verify):
                    yield decode_columns(payloads, arrow_schema, kinds, feature_order, one_by_one)


#: what a task reads at most of small files, and what opening a file is worth
MAX_TASK_BYTES, OPEN_BYTES = 128 << 20, 4 << 20


def pack_files(paths: list[str], sizes: list[int], parallelism: int) -> list[list[str]]:
    """Files grouped into input partitions, largest first: small files share
    one while every core gets work; a file is never cut (GZIP)."""
    total = sum(s + OPEN_BYTES for s in sizes)
    limit = min(MAX_TASK_BYTES, max(OPEN_BYTES, -(-total // max(1, parallelism))))
    out, held = [], limit + 1
    for path, size in sorted(zip(paths, sizes), key=lambda x: (-x[1], x[0])):
        if held + size + OPEN_BYTES > limit:
            out.append([])
            held = 0
        out[-1].append(path)
        held += size + OPEN_BYTES
    return out


def _convert(v, dt):
    if isinstance(dt, BooleanType):
        return bool(v)
    if isinstance(dt, _INTS):
        return int(v)
    if isinstance(dt, _FLOATS):
        return float(v)
    if isinstance(dt, StringType):
        return v.decode() if isinstance(v, bytes) else str(v)
    return v


class TFRecordDataSource(DataSource):
    """``format("tfrecord")``: a schema is required for reading."""

    default_fs: str | None = None                     # both set by ``register``
    parallelism: int = 1

    @classmethod
    def name(cls):
        return "tfrecord"

    def schema(self):
        raise ValueError("tfrecord reads need an explicit schema: .schema('a bigint, ...')")

    def reader(self, schema: StructType):
        return TFRecordReader(schema, self.options, self.default_fs, self.parallelism)

    def writer(self, schema: StructType, overwrite: bool):
        return TFRecordWriter(schema, self.options, overwrite, self.default_fs)


def register(spark) -> None:
    """Register the ``tfrecord`` format on this session (and ship the
    package to the Python workers that run the reader and writer)."""
    from recprep.session import ship_package

    ship_package(spark)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    bound = type("TFRecordDataSource", (TFRecordDataSource,), {
        "default_fs": conf.get("fs.defaultFS"), "parallelism": spark.sparkContext.defaultParallelism})
    spark.dataSource.register(bound)


# The ranking examples as the reference serialises them
# (is_read and is_reviewed are left out).
RANKING_TFRECORD_SCHEMA = (
    "user_id bigint, item_id bigint, language bigint, is_ebook bigint, format bigint, "
    "publisher bigint, pub_decade bigint, avg_rating float, num_pages float, label float")
