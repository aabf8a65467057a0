"""Operator 8: near-duplicate vectors by randomised-rotation binary codes.

A unit vector o is rotated at random; its code is the signs of the rotated
coordinates, so the quantised vector is x = sign(Po) / sqrt(D) and the stored
correction factor is <x, Po>. For a unit vector q, <x, Pq> / <x, Po> estimates
<o, q> without bias, with an error of about sqrt((1 - f^2) / f^2) / sqrt(D - 1)
for f = <x, Po>. Pairs whose estimate plus ERRORS such errors stays below the
threshold are passed over; all others are recomputed exactly in double
precision, and only exact results link.

Candidate pairs come from such codes as well. Their bits are cut into segments;
near vectors agree in at least one segment with very high probability (see
``plan``, which takes more bits and more tables as the data grow). Vectors that
share a label and a segment meet in a bucket; a bucket of more than CELL rows
is cut into cells, and every pair of cells meets in a group of its own, so no
task holds a large bucket. A pair that shares several segments counts in the
first of them only. Equal vectors are one row with a count. Groups return
counts and a spanning forest of their links, never their pairs.

Groups meet twice. First they get codes, factors and rotated vectors of a byte
per component, and tell which of their rows have a pair that the estimates do
not rule out; then those rows alone come back with their exact vectors.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recprep.llm.common import append_columns, staged
from recprep.llm.components import components
from recprep.session import ship_package

SEED = 20240521
#: probability that a pair just at the threshold shares no segment
MISS = 1e-3
#: rows of a bucket that meet at once
CELL = 1024
#: standard errors of an estimate that are allowed for
ERRORS = 4.0


@lru_cache(maxsize=8)
def rotation(dim: int, number: int) -> np.ndarray:
    """A random orthogonal matrix, the same for the same arguments."""
    q, r = np.linalg.qr(np.random.default_rng([SEED, dim, number]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def plan(rows: int, threshold: float, miss: float = MISS) -> tuple[int, int]:
    """(bits, tables) for the rows of the largest label: enough bits that a
    bucket of unrelated vectors has about CELL rows, and enough tables that a
    pair at the threshold shares no segment with probability at most ``miss``
    (a bit differs with probability angle / pi)."""
    bits = max(1, math.ceil(math.log2(max(2.0, rows / CELL))))
    agree = 1 - math.acos(threshold) / math.pi
    return bits, math.ceil(math.log(miss) / math.log(1 - agree ** bits))


def _matrix(vectors: pa.Array) -> np.ndarray:
    """The rows of a list column without nulls, all of one length."""
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)


def _bytes(rows: np.ndarray) -> pa.Array:
    """A binary value per row of a matrix."""
    flat = np.ascontiguousarray(rows)
    width = flat.shape[1] * flat.itemsize
    return pa.Array.from_buffers(pa.binary(), len(flat), [
        None, pa.py_buffer(np.arange(len(flat) + 1, dtype=np.int32) * width), pa.py_buffer(flat.tobytes())])


def encode(df: DataFrame, vector_col: str, dim: int, bits: int, tables: int) -> DataFrame:
    """Append ``signs`` (under all rotations, packed; the first ``dim`` are the
    code), ``factor`` (the code's correction factor), ``turned`` (the vector
    under the first rotation in steps of ``step``, a byte each), ``unit`` (the
    unit vector, exact) and ``segments`` (one number per table)."""
    turns = math.ceil(tables * bits / dim)
    fields = [T.StructField("signs", T.BinaryType()), T.StructField("factor", T.DoubleType()),
              T.StructField("turned", T.BinaryType()), T.StructField("step", T.DoubleType()),
              T.StructField("unit", T.BinaryType()), T.StructField("segments", T.ArrayType(T.LongType()))]

    def make():
        rotations = [rotation(dim, k) for k in range(turns)]

        def rows(vectors):
            x = _matrix(vectors)
            # by a power of two, which is exact, so that no square overflows or vanishes
            x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            turned = [x @ r.T for r in rotations]
            signs = np.concatenate([t > 0 for t in turned], axis=1)
            factor = np.abs(turned[0]).sum(axis=1) / math.sqrt(dim)
            step = np.abs(turned[0]).max(axis=1) / 127
            near = np.rint(turned[0] / step[:, None]).astype(np.int8)
            segments = segments_of(signs, bits, tables)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(x) + 1, dtype=np.int32) * tables), pa.array(segments.ravel()))
            return [_bytes(np.packbits(signs, axis=1)), pa.array(factor), _bytes(near), pa.array(step),
                    _bytes(x), lists]
        return rows

    return append_columns(df, [vector_col], fields, make, raw=True)


def segments_of(signs: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """The number that each table's bits make, row by row."""
    return signs[:, :tables * bits].reshape(len(signs), tables, bits) @ (1 << np.arange(bits, dtype=np.int64))


class Cell:
    """One side of a group: ids, codes, rotated vectors and segments and, at
    the second meeting, weights and exact unit vectors."""

    def __init__(self, t: pa.Table, dim: int, bits: int, tables: int):
        def rows(name, kind):
            return np.frombuffer(b"".join(t.column(name).to_pylist()), kind).reshape(t.num_rows, -1)

        self.id = t.column("id").to_numpy()
        self.factor, self.step = t.column("factor").to_numpy(), t.column("step").to_numpy()
        signs = np.unpackbits(rows("signs", np.uint8), axis=1) if t.num_rows else np.zeros((0, dim), np.uint8)
        self.code = (signs[:, :dim].astype(np.float32) * 2 - 1) / np.float32(math.sqrt(dim))
        self.segments = segments_of(signs, bits, tables) if t.num_rows else np.zeros((0, tables), np.int64)
        # only rows that ask carry it: those of the low cell
        self.turned = rows("turned", np.int8) if t.num_rows and not t.column("turned").null_count else None
        if "unit" in t.schema.names and t.num_rows:
            self.x, self.weight = rows("unit", np.float64), t.column("copies").to_numpy()


def open_pairs(a: Cell, b: Cell, table: int, threshold: float, same: bool):
    """Rows (i of a, j of b), some at a time, of the pairs that meet first in
    segment ``table`` and whose estimate leaves it open whether they link."""
    dim = b.code.shape[1]
    sure = ERRORS * np.sqrt(np.maximum(1 - b.factor ** 2, 0) / max(1, dim - 1))
    for at in range(0, len(a.id), 256):
        step = a.step[at:at + 256, None]
        dot = (a.turned[at:at + 256].astype(np.float32) @ b.code.T) * step
        # half a step of rounding in every component; and of the single-precision product
        maybe = dot + sure + step * math.sqrt(dim) / 2 + 1e-5 >= threshold * b.factor
        if same:
            maybe &= np.arange(at, at + len(dot))[:, None] < np.arange(len(b.id))[None, :]
        i, j = np.nonzero(maybe)
        i += at
        first = (a.segments[i] == b.segments[j]).argmax(axis=1) == table
        if first.any():
            yield i[first], j[first]


def linked_pairs(a: Cell, b: Cell, table: int, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i of a, j of b) of all pairs at or above the threshold that meet
    first in segment ``table``."""
    found_i, found_j = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for i, j in open_pairs(a, b, table, threshold, same):
        exact = np.einsum("ij,ij->i", a.x[i], b.x[j]) >= threshold
        found_i.append(i[exact])
        found_j.append(j[exact])
    return np.concatenate(found_i), np.concatenate(found_j)


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> tuple[list, list]:
    """A spanning forest of the links between n rows."""
    up = list(range(n))

    def root(k):
        while up[k] != k:
            up[k] = up[up[k]]
            k = up[k]
        return k

    a, b = [], []
    for p, q in zip(i.tolist(), j.tolist()):
        r, s = root(p), root(q)
        if r != s:
            up[s] = r
            a.append(p)
            b.append(q)
    return a, b


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", threshold: float = 0.93, miss: float = MISS) -> DataFrame:
    """One row per row of ``df``: the id, ``n_links`` (other rows linked
    directly), ``component_id`` (smallest id reachable, its own included) and
    ``kept`` (id = component_id).

    Rows link when their labels are equal and not null and their cosine in
    double precision is at least ``threshold``. Rows without a label, and
    vectors that are null, empty, zero, or hold null or non-finite components,
    link with nothing. Vectors of different lengths never link. Repeated rows
    count as vectors of their own; rows with a null id link but give no
    component its name (one of null ids alone has a null name, kept is null).
    Other columns are ignored; an empty table gives no rows.
    """
    spark = df.sparkSession
    ship_package(spark)
    src = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"),
                    F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    fine = (F.col("label").isNotNull() & (F.size("vector") > 0)
            & F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
            & F.exists("vector", lambda v: v != 0))
    rows = src.withColumn("fine", F.coalesce(fine, F.lit(False)))
    # equal vectors are one node; its number stands for (label, vector)
    nodes = rows.where("fine").groupBy("label", "vector").agg(
        F.min("id").alias("first"), F.count("*").alias("copies"))
    nodes = staged(nodes.withColumn("id", F.monotonically_increasing_id()), "vectors")
    dims = [r[0] for r in nodes.select(F.size("vector").alias("d")).distinct().collect()]
    stars = [_link(nodes.where(F.size("vector") == d), d, threshold, miss) for d in dims]
    if stars:
        found = stars[0]
        for s in stars[1:]:
            found = found.union(s)
        found = staged(found, "vector-links")
        links = found.where("b is null").groupBy(F.col("a").alias("n")).agg(F.sum("links").alias("links"))
        roots = components(found.where("b is not null"), "a", "b")
        rooted = nodes.join(roots, nodes["id"] == roots["node"], "left").select(
            nodes["id"], "first", "copies", F.coalesce("root", "id").alias("root"))
        names = rooted.groupBy(F.col("root").alias("r")).agg(F.min("first").alias("name"))
        named = (rooted.join(names, F.col("root") == F.col("r"))
                       .join(links, F.col("id") == F.col("n"), "left")
                       .select(F.col("id").alias("node"), "name",
                               (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links")))
    else:
        named = nodes.select(F.col("id").alias("node"), F.col("first").alias("name"), F.lit(0).cast("long").alias("links"))
    # vectors meet here once; names and links then come by the node's number
    member = rows.where("fine").join(nodes.select(F.col("label").alias("l"), F.col("vector").alias("v"),
                                                  F.col("id").alias("of")),
                                     (F.col("label") == F.col("l")) & (F.col("vector") == F.col("v"))).select("id", "of")
    good = member.join(named, F.col("of") == F.col("node")).select("id", "links", "name")
    rest = rows.where("not fine").select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("name"))
    return good.union(rest).select(F.col("id").alias(id_col), F.col("links").alias("n_links"),
                                   F.col("name").alias("component_id"),
                                   (F.col("id") == F.col("name")).alias("kept"))


def _link(nodes: DataFrame, dim: int, threshold: float, miss: float) -> DataFrame:
    """(a, b, links): with a null b, rows of a's other linked rows in one
    group; else an edge of a spanning forest."""
    key = ["label", "table", "segment", "low", "high"]
    most = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = plan(most, threshold, miss)
    coded = staged(encode(nodes.select("id", "label", "copies", "vector"), "vector", dim, bits, tables),
                   "vector-codes")
    spots = coded.select("id", "label", "signs", "factor", "turned", "step",
                         F.posexplode("segments").alias("table", "segment"))
    # how many cells each large bucket needs; the others are one cell
    buckets = (coded.select("label", F.posexplode("segments").alias("table", "segment"))
                    .groupBy(F.col("label").alias("bl"), F.col("table").alias("bt"), F.col("segment").alias("bs"))
                    .agg(F.count("*").alias("n")).where(F.col("n") > CELL)
                    .withColumn("n_cells", F.ceil(F.col("n") / CELL).cast("int")))
    placed = spots.join(buckets, (F.col("label") == F.col("bl")) & (F.col("table") == F.col("bt"))
                        & (F.col("segment") == F.col("bs")), "left").withColumn(
        "cells", F.coalesce("n_cells", F.lit(1))).withColumn(
        "cell", F.pmod(F.xxhash64("id"), F.col("cells")).cast("int"))
    # a row joins one group per pair of cells that its own cell is part of
    groups = F.transform(F.sequence(F.lit(0), F.col("cells") - 1), lambda o: F.struct(
        F.least(F.col("cell"), o).alias("low"), F.greatest(F.col("cell"), o).alias("high")))
    met = placed.withColumn("g", F.explode(groups)).select(
        "label", "table", "segment", F.col("g.low").alias("low"), F.col("g.high").alias("high"), "cell",
        "id", "signs", "factor", F.when(F.col("cell") == F.col("g.low"), F.col("turned")).alias("turned"), "step")

    def sides(t: pa.Table) -> tuple[Cell, Cell, int]:
        low, high, table = (t.column(c)[0].as_py() for c in ("low", "high", "table"))
        cell = t.column("cell").to_numpy()
        a = Cell(t.filter(pa.array(cell == low)), dim, bits, tables)
        return a, a if low == high else Cell(t.filter(pa.array(cell == high)), dim, bits, tables), table

    def ask(t: pa.Table) -> pa.Table:
        a, b, table = sides(t)
        in_a, in_b = np.zeros(len(a.id), dtype=bool), np.zeros(len(b.id), dtype=bool)
        if len(a.id) and len(b.id):
            for i, j in open_pairs(a, b, table, threshold, a is b):
                in_a[i] = True
                in_b[j] = True
        ids = a.id[in_a | in_b] if a is b else np.concatenate([a.id[in_a], b.id[in_b]])
        low, high, segment = (t.column(c)[0].as_py() for c in ("low", "high", "segment"))
        cell = np.full(len(ids), high, dtype=np.int32)
        cell[:len(ids) if a is b else in_a.sum()] = low
        same = lambda v, kind: pa.array(np.full(len(ids), v), kind)
        return pa.table({"k": pa.array(ids, pa.int64()), "table": same(table, pa.int32()),
                         "segment": same(segment, pa.int64()), "low": same(low, pa.int32()),
                         "high": same(high, pa.int32()), "cell": pa.array(cell, pa.int32())})

    # dealt by the whole group key: the cells of a large bucket go to many tasks
    asked = met.repartition(*key).groupBy(*key).applyInArrow(
        ask, "k long, table int, segment long, low int, high int, cell int")
    again = asked.join(coded.drop("segments", "vector"), F.col("k") == F.col("id")).drop("k").repartition(*key)

    def run(t: pa.Table) -> pa.Table:
        a, b, table = sides(t)
        if not len(a.id) or not len(b.id):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()),
                             "links": pa.array([], pa.int64())})
        i, j = linked_pairs(a, b, table, threshold, a is b)
        if a is b:
            ids, weight, p, q = a.id, a.weight, i, j
        else:
            ids, weight = np.concatenate([a.id, b.id]), np.concatenate([a.weight, b.weight])
            p, q = i, j + len(a.id)
        count = np.bincount(p, weights=weight[q], minlength=len(ids)) + np.bincount(
            q, weights=weight[p], minlength=len(ids))
        some = np.flatnonzero(count)
        x, y = _forest(p, q, len(ids))
        return pa.table({
            "a": pa.array(np.concatenate([ids[some], ids[x]]).astype(np.int64)),
            "b": pa.array([None] * len(some) + ids[y].tolist(), pa.int64()),
            "links": pa.array(np.concatenate([count[some], np.zeros(len(x))]).astype(np.int64))})

    return again.groupBy(*key).applyInArrow(run, "a long, b long, links long")
