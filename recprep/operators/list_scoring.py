"""M5 for item vectors that are too many to broadcast: every task reads the
vectors itself, in order of their ids, and scores whole candidate lists.

What crosses the network are lists of ids, never a vector for each of them: a
task holds as many users as CHUNK_BYTES take, goes over the vectors once for
the histories and once for the candidates, and keeps one mean vector a user.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recprep.session import ship_package, shuffles_end_with_writes, staging_path

#: bytes that a task's users take at once, what an id takes of them, and how
#: many ids meet their vectors at a time
CHUNK_BYTES, ID_BYTES, SLICE = 192 << 20, 32, 1 << 15
#: bytes of the vectors in one file and in one row group, which is read whole
FILE_BYTES, GROUP_BYTES = 256 << 20, 16 << 20

_IDS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMBERS = (*_IDS, T.FloatType, T.DoubleType)


@dataclass
class Layout:
    """Vectors in files under ``path`` in order of their ids: (file, row group,
    least and greatest id) of every row group, and the length of a vector."""
    path: str
    default_fs: str | None
    groups: list
    dim: int


def _is_list(kind, of) -> bool:
    return isinstance(kind, T.ArrayType) and isinstance(kind.elementType, of)


def vector_length(table: DataFrame) -> int | None:
    """The length of the vectors of ``table`` (vec_id, embedding) if its ids
    are whole numbers, no id repeats and all vectors are alike in length and
    without nulls, else None."""
    if not isinstance(table.schema["vec_id"].dataType, _IDS) or not _is_list(table.schema["embedding"].dataType, _NUMBERS):
        return None
    row = table.agg(F.count_distinct("vec_id").alias("ids"), F.count("vec_id").alias("rows"),
                    F.min(F.size("embedding")).alias("least"), F.max(F.size("embedding")).alias("most"),
                    F.max(F.exists("embedding", lambda x: x.isNull())).alias("gaps")).first()
    plain = row.ids == row.rows and row.least == row.most and (row.least or 0) > 0 and not row.gaps
    return row.least if plain else None


def lay_out(table: DataFrame, dim: int, size: int) -> Layout:
    """Write the vectors (``size`` bytes) in order of their ids."""
    import pyarrow.parquet as pq

    from recprep.sources.tfrecord import _listed, store

    spark = table.sparkSession
    path = staging_path(spark, "item-layout")
    with shuffles_end_with_writes(spark):
        (table.where("vec_id is not null").repartitionByRange(max(1, -(-size // FILE_BYTES)), "vec_id")
              .sortWithinPartitions("vec_id").write.option("compression", "zstd")
              .option("parquet.block.size", GROUP_BYTES)
              .option("parquet.enable.dictionary", "false").parquet(path))
    default_fs = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")
    files, where = store(path, default_fs)
    groups = []
    for name in _listed(files, where):
        if name.endswith(".parquet"):
            meta = pq.read_metadata(name, filesystem=files)
            for g in range(meta.num_row_groups):
                ids = meta.row_group(g).column(0).statistics
                if meta.row_group(g).num_rows:
                    groups.append((name, g, ids.min, ids.max))
    return Layout(path, default_fs, groups, dim)


def can_score(df: DataFrame, seq: str, cands: str) -> bool:
    return all(_is_list(df.schema[c].dataType, _IDS) for c in (seq, cands))


def score_lists(df: DataFrame, layout: Layout, key: str, seq: str, cands: str, skip: tuple) -> DataFrame:
    """(key, ``cands``, ``scores``) of every row of ``df`` (read from files)
    that has candidates: their inner products with the mean vector of the key's
    histories, ids in ``skip`` left out. A candidate without a vector, a null
    key and a key without a history give null scores."""
    spark = df.sparkSession
    ship_package(spark)
    lists = F.coalesce(F.size(seq), F.lit(0)) + F.coalesce(F.size(cands), F.lit(0))
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.greatest(lists, F.lit(0))).alias("ids")).first()
    held = row.rows * layout.dim * 8 + (row.ids or 0) * ID_BYTES
    cores = spark.sparkContext.defaultParallelism
    tasks = cores * max(1, -(-held // (CHUNK_BYTES * cores)))
    tasks += tasks == int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the rows of a key share their histories; null keys have none and are dealt out
    alone = F.when(F.col(key).isNull(), F.xxhash64(cands)).alias("_alone")
    users = df.select(key, seq, cands, alone).repartition(tasks, key, "_alone").groupBy(key, "_alone").agg(
        F.flatten(F.collect_list(seq)).alias("_history"), F.collect_list(cands).alias("_lists"))
    users = users.select(key, F.when(F.col(key).isNotNull(), F.col("_history")).alias("_history"), "_lists")
    out = T.StructType([df.schema[key], T.StructField(cands, df.schema[cands].dataType),
                        T.StructField("scores", T.ArrayType(T.DoubleType()))])
    return users.mapInArrow(_scorer(layout, key, cands, skip), out)


def _scorer(layout: Layout, key: str, cands: str, skip: tuple):
    """The function that scores the users of a task, a chunk at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, used = [], 0
        for b in batches:
            held.append(b)
            used += b.num_rows * layout.dim * 8 + sum(
                len(pc.list_flatten(c)) for c in (b.column(1), pc.list_flatten(b.column(2)))) * ID_BYTES
            if used >= CHUNK_BYTES:
                whole, held, used = held, [], 0
                yield from _scored(whole, layout, key, cands, skip)
        if held:
            yield from _scored(held, layout, key, cands, skip)
    return run


def _scored(batches: list, layout: Layout, key: str, cands: str, skip: tuple) -> Iterator[pa.RecordBatch]:
    t = pa.Table.from_batches(batches).combine_chunks()
    if not t.num_rows:
        return
    keys, history, lists = (t.column(i).chunk(0) for i in range(3))
    owner, ids, there = _flat(history)
    there &= ~np.isin(ids, skip)
    sums, n = np.zeros((t.num_rows, layout.dim)), np.zeros(t.num_rows, dtype=np.int64)
    for rows, vectors in _meet(ids, there, layout):
        users = owner[rows]
        np.add.at(sums, users, vectors)
        n += np.bincount(users, minlength=len(n))
    with np.errstate(invalid="ignore"):
        means = sums / n[:, None]
    of = pc.list_parent_indices(lists)                     # the key of each list
    lists = pc.list_flatten(lists)
    owner, ids, there = _flat(lists)
    owner = of.to_numpy()[owner]
    there &= n[owner] > 0
    scores, known = np.zeros(len(ids)), np.zeros(len(ids), dtype=bool)
    for rows, vectors in _meet(ids, there, layout):
        scores[rows] = np.einsum("ij,ij->i", means[owner[rows]], vectors)
        known[rows] = True
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
    all_keys = keys.take(of)
    for a in range(0, len(lists), 4096):
        b = min(a + 4096, len(lists))
        x, y = ends[a], ends[b]
        got = pa.ListArray.from_arrays(pa.array(ends[a:b + 1] - x, pa.int32()), pa.array(scores[x:y], mask=~known[x:y]))
        yield pa.RecordBatch.from_arrays([all_keys[a:b], lists[a:b], got], names=[key, cands, "scores"])


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each element of a list of ids: its list, the id (null: 0) and whether it is one."""
    ids = pc.list_flatten(lists)
    return (pc.list_parent_indices(lists).to_numpy(), pc.fill_null(ids, 0).to_numpy(),
            np.array(pc.is_valid(ids).to_numpy(zero_copy_only=False)))


def _meet(ids: np.ndarray, there: np.ndarray, layout: Layout) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions in ``ids``, their vectors), some at a time, of those ``there``
    that have a vector."""
    import pyarrow.parquet as pq

    from recprep.sources.tfrecord import store

    files, _ = store(layout.path, layout.default_fs)
    places = np.flatnonzero(there)
    places = places[np.argsort(ids[places], kind="stable")]
    ordered = ids[places]
    for name, group, least, most in layout.groups:
        a, b = int(np.searchsorted(ordered, least)), int(np.searchsorted(ordered, most, side="right"))
        if a == b:
            continue
        with pq.ParquetFile(name, filesystem=files) as f:
            block = f.read_row_group(group).combine_chunks()
        block = block.filter(pc.is_valid(block.column(1))).combine_chunks()
        if not block.num_rows:
            continue
        known = block.column(0).chunk(0).to_numpy()
        vectors = pc.list_flatten(block.column(1).chunk(0)).to_numpy().reshape(len(known), layout.dim)
        for x in range(a, b, SLICE):
            y = min(x + SLICE, b)
            at = np.minimum(np.searchsorted(known, ordered[x:y]), len(known) - 1)
            found = known[at] == ordered[x:y]
            yield places[x:y][found], vectors[at[found]].astype(np.float64)
