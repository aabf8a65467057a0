"""Operator 1: quality by the perplexity of an n-gram model of trusted text.

One interpolated modified Kneser-Ney model per language, over UTF-16 code
units, of order ORDER (four units fit a 64-bit key exactly). Highest-order
counts come from all trusted text; lower orders count distinct left
neighbours. A model row has, for an n-gram, the discounted part of its
probability and the weight that its continuations leave to the next lower
order.

The model grows with the corpus, so it is neither broadcast nor collected.
Documents are put into blocks of about BLOCK_BYTES and written once to a
bucketed table in the shared folder. Every block asks for its distinct n-grams
only; the questions join the model by (language, n-gram), spread over all
tasks, and the answers meet their block again without moving its text. The
same table gives the trusted rows for counting.

A document's perplexity is judged against a quantile, per language, of the
perplexities of trusted documents kept out of training.
"""

from __future__ import annotations

import uuid
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recprep.llm.common import slices, staged
from recprep.session import ship_package, staging_path

ORDER = 4
BLOCK_BYTES = 12 << 20
#: share of trusted documents, by language, that lie under the threshold
QUANTILE = 0.99
#: one in so many trusted documents is kept out of training, for the threshold
HELD_OUT = 5

#: code units that no text has: begin, end, and what stands for U+0000
_BEGIN, _END, _NUL = 0xFFFE, 0xFFFF, 0xFFFD
#: key of the row that has a language's uniform probability
_UNIFORM = -1


def gram_keys(text: str | None) -> np.ndarray:
    """The keys of all highest-order n-grams of a text, one per code unit and
    one for its end: ORDER 16-bit lanes, the last unit lowest."""
    units = np.frombuffer((text or "").encode("utf-16-le", "surrogatepass"), dtype="<u2")
    u = np.empty(len(units) + ORDER, dtype=np.uint64)
    u[:ORDER - 1] = _BEGIN
    u[ORDER - 1:-1] = units
    u[-1] = _END
    u[u == 0] = _NUL
    key = u[:len(u) - ORDER + 1].copy()
    for k in range(1, ORDER):
        key <<= np.uint64(16)
        key |= u[k:len(u) - ORDER + 1 + k]
    return key


def _lower(keys: np.ndarray, lanes: int) -> np.ndarray:
    return keys & np.uint64((1 << 16 * lanes) - 1)


def _questions(top: np.ndarray) -> np.ndarray:
    """All keys whose model rows are needed to score the n-grams in ``top``."""
    every = [top, np.array([0, 0xFFFFFFFFFFFFFFFF], dtype=np.uint64)]
    for n in range(ORDER, 0, -1):
        g = np.unique(_lower(top, n))
        every += [g, g >> np.uint64(16)]
    return np.unique(np.concatenate(every))


def _log_probabilities(top: np.ndarray, keys: np.ndarray, part: np.ndarray,
                       weight: np.ndarray) -> np.ndarray:
    """Natural log of the interpolated probability of each key in ``top``,
    from the answered model rows (sorted by key)."""
    def find(k: np.ndarray, values: np.ndarray, missing: float) -> np.ndarray:
        at = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
        return np.where(keys[at] == k, values[at], missing)

    p = find(np.full(len(top), 0xFFFFFFFFFFFFFFFF, dtype=np.uint64), part, 0.0)
    for n in range(1, ORDER + 1):
        g = _lower(top, n)
        p = find(g, part, 0.0) + find(g >> np.uint64(16), weight, 1.0) * p
    return np.log(p)


def _pack(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(
            compression=pa.Codec("zstd", 9))) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(blob: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(blob).read_all().combine_chunks().to_batches()[0]


def _blocks(df: DataFrame, id_col: str, text_col: str, lang_col: str) -> str:
    """Write the bucketed table of blocks and return its name. Columns: ``block``, ``blob`` (its rows), ``ids``,
    and ``lang`` / ``keys``, the n-grams it asks for in each language."""
    spark = df.sparkSession
    ship_package(spark)
    id_type = df.schema[id_col].dataType
    out = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("blob", T.BinaryType()),
        T.StructField("ids", T.ArrayType(id_type)),
        T.StructField("asks", T.ArrayType(T.StructType([
            T.StructField("lang", T.StringType()), T.StructField("keys", T.ArrayType(T.LongType()))])))])
    kinds = _arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []

        def block():
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held.clear()
            seen: dict[str, list] = {}
            for text, lang in zip(whole.column(names.index(text_col)), whole.column(names.index(lang_col))):
                lang = lang.as_py()
                if lang is not None:
                    parts = seen.setdefault(lang, [])
                    parts.append(gram_keys(text.as_py()))
                    if len(parts) >= 512:
                        parts[:] = [np.unique(np.concatenate(parts))]
            asks = [{"lang": lang, "keys": _questions(np.unique(np.concatenate(parts))).view(np.int64)}
                    for lang, parts in seen.items()]
            return pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.array([_pack(whole)], pa.binary()),
                pa.array([whole.column(names.index(id_col)).to_pylist()], kinds.field("ids").type),
                pa.array([asks], kinds.field("asks").type)], schema=kinds)

        names: list[str] = []
        size = 0
        for b in batches:
            names = b.schema.names
            for part in slices(b, [text_col]):
                if held and size + part.nbytes > BLOCK_BYTES:
                    yield block()
                    number, size = number + 1, 0
                held.append(part)
                size += part.nbytes
        if held:
            yield block()

    name = f"quality_blocks_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.mapInArrow(run, out).write.bucketBy(n, "block").option("compression", "zstd")
       .option("path", staging_path(spark, "quality-blocks")).saveAsTable(name))
    return name


def _arrow_schema(s: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(s)


def _count_grams(blocks: DataFrame, trusted: DataFrame, id_col: str, text_col: str,
                 lang_col: str) -> DataFrame:
    """(lang, key, c): highest-order counts over the trusted training rows."""
    ids = blocks.select("block", F.posexplode("ids").alias("row", "id")).where(
        F.col("id").isNotNull() & ~_held_out(F.col("id")))
    rows = (ids.join(trusted.select(F.col(id_col).alias("t")).distinct(), F.col("id") == F.col("t"),
                     "left_semi")
               .groupBy(F.col("block").alias("to")).agg(F.collect_list("row").alias("rows")))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        langs, keys, counts = [], [], []
        if left.num_rows and right.num_rows:
            data = _unpack(left.column("blob")[0].as_py())
            data = data.take(pa.array(sorted(right.column("rows")[0].as_py()), pa.int64()))
            parts: dict[str, list] = {}
            texts = data.column(data.schema.get_field_index(text_col))
            for text, lang in zip(texts, data.column(data.schema.get_field_index(lang_col)).to_pylist()):
                if lang is not None:
                    parts.setdefault(lang, []).append(gram_keys(text.as_py()))
            for lang, p in parts.items():
                k, c = np.unique(np.concatenate(p), return_counts=True)
                langs += [lang] * len(k)
                keys.append(k.view(np.int64))
                counts.append(c)
        join = lambda a: np.concatenate(a) if a else np.zeros(0, np.int64)
        return pa.table({"lang": pa.array(langs, pa.string()), "key": pa.array(join(keys), pa.int64()),
                         "c": pa.array(join(counts).astype(np.int64), pa.int64())})

    grams = blocks.select("block", "blob").groupBy("block").cogroup(rows.groupBy("to")).applyInArrow(
        run, "lang string, key long, c long")
    return grams.groupBy("lang", "key").agg(F.sum("c").alias("c"))


def _held_out(id_col) -> F.Column:
    return F.crc32(id_col.cast("string")) % HELD_OUT == 0


def fit(top: DataFrame) -> DataFrame:
    """The model rows (lang, key, part, weight) from highest-order counts.

    ``part``: max(c - D(c), 0) / total of the context; ``weight``: what the
    discounts of a context leave to the lower order. Discounts D1, D2, D3+ per
    language and order from the counts of counts.
    """
    top = staged(top, "quality-counts")
    orders, level = [top.select("lang", F.lit(ORDER).alias("n"), "key", "c")], top
    for n in range(ORDER - 1, 0, -1):
        level = level.groupBy("lang", F.col("key").bitwiseAND(F.lit((1 << 16 * n) - 1)).alias("key")).agg(
            F.count("*").alias("c"))
        orders.append(level.select("lang", F.lit(n).alias("n"), "key", "c"))
    grams = orders[0]
    for o in orders[1:]:
        grams = grams.union(o)
    grams = staged(grams, "quality-grams")

    def many(k):
        return F.sum(F.when(F.col("c") == k, 1.0).otherwise(0.0))

    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))

    def discount(k: int, fallback: float):
        a, b = F.col(f"n{k}"), F.col(f"n{k + 1}")
        d = k - (k + 1) * y * b / a
        ok = (F.col("n1") > 0) & (F.col("n2") > 0) & (a > 0)
        return F.when(ok, F.greatest(F.lit(0.0), F.least(F.lit(float(k)), d))).otherwise(F.lit(fallback))

    stats = grams.groupBy("lang", "n").agg(*[many(k).alias(f"n{k}") for k in (1, 2, 3, 4)],
                                           F.count("*").alias("kinds"))
    # a row per language and order
    d = stats.select(F.col("lang").alias("dl"), F.col("n").alias("dn"), "kinds", discount(1, 0.5).alias("d1"),
                     discount(2, 1.0).alias("d2"), discount(3, 1.5).alias("d3"))
    cut = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
    full = grams.join(F.broadcast(d), (F.col("lang") == F.col("dl")) & (F.col("n") == F.col("dn"))).select(
        "lang", "key", F.shiftrightunsigned("key", 16).alias("ctx"), "c", cut.alias("cut"))
    contexts = full.groupBy(F.col("lang").alias("cl"), F.col("ctx").alias("ck")).agg(
        F.sum("c").alias("total"), F.sum("cut").alias("left"))
    parts = full.join(contexts, (F.col("lang") == F.col("cl")) & (F.col("ctx") == F.col("ck"))).select(
        "lang", "key", (F.greatest(F.col("c") - F.col("cut"), F.lit(0.0)) / F.col("total")).alias("part"),
        F.lit(None).cast("double").alias("weight"))
    weights = contexts.select(F.col("cl").alias("lang"), F.col("ck").alias("key"),
                              F.lit(None).cast("double").alias("part"),
                              (F.col("left") / F.col("total")).alias("weight"))
    uniform = d.where(F.col("dn") == 1).select(F.col("dl").alias("lang"), F.lit(_UNIFORM).cast("long").alias("key"),
                                               (1.0 / (F.col("kinds") + 1)).alias("part"),
                                               F.lit(None).cast("double").alias("weight"))
    return parts.union(weights).union(uniform).groupBy("lang", "key").agg(
        F.coalesce(F.max("part"), F.lit(0.0)).alias("part"),
        F.coalesce(F.max("weight"), F.lit(1.0)).alias("weight"))


def _score(blocks: DataFrame, model: DataFrame, schema: T.StructType, text_col: str, lang_col: str,
           keep: list[str]) -> DataFrame:
    """The kept columns of all rows and their ``perplexity``."""
    asks = (blocks.select("block", F.explode("asks").alias("a"))
                  .select("block", F.col("a.lang").alias("al"), F.explode("a.keys").alias("ak")))
    asks = asks.hint("merge")     # sized by the optimizer like the blocks' lists before they are exploded: no broadcast
    answers = asks.join(model, (F.col("al") == F.col("lang")) & (F.col("ak") == F.col("key"))).select(
        F.col("block").alias("to"), "lang", "key", F.col("part").cast("float"), F.col("weight").cast("float"))
    out = T.StructType([schema[c] for c in keep] + [T.StructField("perplexity", T.DoubleType())])
    kinds = _arrow_schema(out)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return kinds.empty_table()
        data = _unpack(left.column("blob")[0].as_py())
        langs = np.array(right.column("lang").to_pylist(), dtype=object)
        keys = right.column("key").to_numpy().view(np.uint64)
        part = right.column("part").to_numpy().astype(np.float64)
        weight = right.column("weight").to_numpy().astype(np.float64)
        rows_lang = data.column(data.schema.get_field_index(lang_col)).to_pylist()
        texts = data.column(data.schema.get_field_index(text_col))
        result: list = [None] * data.num_rows
        for lang in sorted({x for x in rows_lang if x is not None}):
            mine = np.flatnonzero(langs == lang)
            if not len(mine):
                continue                              # no trusted text of this language
            order = mine[np.argsort(keys[mine])]
            k, a, w = keys[order], part[order], weight[order]
            rows = [i for i, x in enumerate(rows_lang) if x == lang]
            for at in range(0, len(rows), 256):
                some = rows[at:at + 256]
                grams = [gram_keys(texts[i].as_py()) for i in some]
                flat = np.concatenate(grams)
                top, where = np.unique(flat, return_inverse=True)
                logs = _log_probabilities(top, k, a, w)[where]
                starts = np.cumsum([0] + [len(g) for g in grams[:-1]])
                mean = np.add.reduceat(logs, starts) / np.array([len(g) for g in grams])
                for i, m in zip(some, np.exp(-mean).tolist()):
                    result[i] = m
        arrays = [data.column(data.schema.get_field_index(c)) for c in keep]
        return pa.Table.from_arrays(arrays + [pa.array(result, pa.float64())], schema=kinds)

    return blocks.select("block", "blob").groupBy("block").cogroup(answers.groupBy("to")).applyInArrow(run, out)


def classify(df: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", keep: list[str] | None = None, quantile: float = QUANTILE) -> DataFrame:
    """The ``keep`` columns (all by default) of every row, and ``perplexity``
    (per code unit), ``threshold`` (of its language) and ``kept``.

    ``trusted`` has the ids of trusted documents; ids repeat freely. Null text
    counts as empty. A null language, and a language without trusted text to
    train on or to set a threshold with, give null figures and kept = true: it
    can't be judged. Rows with a null id are judged but never trusted. Repeated
    rows are judged alike; an input column named like a result is replaced; an
    empty table gives no rows.
    """
    results = {"perplexity", "threshold", "kept"}
    cols = [c for c in df.columns if c not in results]
    keep = [c for c in (keep or cols) if c not in results]
    src = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, id_col, text_col, lang_col])])
    spark = df.sparkSession
    name = _blocks(src, id_col, text_col, lang_col)
    blocks = spark.table(name)
    model = staged(fit(_count_grams(blocks, trusted, id_col, text_col, lang_col)), "quality-model")
    wanted = list(dict.fromkeys([*keep, id_col, lang_col]))
    scored = staged(_score(blocks, model, src.schema, text_col, lang_col, wanted), "quality-scores")
    spark.sql(f"DROP TABLE {name}")                          # the catalog's entry; all that follows reads the scores
    held = scored.where(F.col(id_col).isNotNull() & _held_out(F.col(id_col))).select(
        F.col(id_col).alias("h"), F.col(lang_col).alias("tl"), "perplexity")
    limits = (held.join(trusted.select(F.col(id_col).alias("t")).distinct(), F.col("h") == F.col("t"), "left_semi")
                  .where("perplexity is not null and tl is not null").groupBy("tl")
                  .agg(F.percentile_approx("perplexity", quantile, 10000).alias("threshold")))
    out = scored.join(F.broadcast(limits), scored[lang_col] == limits["tl"], "left").drop("tl")
    return out.select(*keep, "perplexity", "threshold",
                      (F.col("perplexity").isNull() | F.col("threshold").isNull()
                       | (F.col("perplexity") <= F.col("threshold"))).alias("kept"))
