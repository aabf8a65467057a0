"""Operator 12: toxicity by a character n-gram linear classifier whose
features are scaled by naive Bayes log-count ratios.

The features of a text are the distinct n-grams of SIZES characters of its
lower-cased text, white space as one space, hashed to DIMS numbers. Of every
feature, all labelled texts that may teach give the share of texts of each
class that have it; r is the log of the ratio of the two, both smoothed by
SMOOTHING texts of the overall make-up, so that an unseen feature has r = 0.
Features whose shares differ by less than SIGNIFICANCE standard errors, or by
less than a factor of LEAST_RATIO, are left out (r = 0): they would only let
the fit learn its texts by heart, or their lengths.

A text is the vector with r in the places of its features, and logistic
regression (Spark ML, ridge penalty) is fitted on such vectors of all labelled
texts that may teach; the penalty costs a feature less, the better it tells
the classes apart. A score is the logistic function of the sum of weight x r
over the features of the whole text. The model is DIMS numbers at most.
"""

from __future__ import annotations

import math
import re
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recprep.llm.common import append_columns, slices, staged
from recprep.session import ship_package, staging_path

BITS = 20
DIMS = 1 << BITS
SIZES = (2, 3, 4, 5, 6)
#: texts, of the overall make-up, added to each class before the ratio
SMOOTHING = 20.0
SIGNIFICANCE = 4.0
LEAST_RATIO = 2.0
RIDGE = 0.0003
ROUNDS = 100
#: bits of the table that tells which ids may have a label: two to this power
ID_BITS = 24
#: characters whose n-grams are made at once
_CHUNK = 1 << 18

_SPACE = re.compile(r"\s+")


def _hashes(text: str | None) -> Iterator[np.ndarray]:
    """The numbers of the n-grams of a text, repeats included, part by part."""
    s = _SPACE.sub(" ", (text or "").lower()).strip()
    if not s:
        return
    c = np.frombuffer(f" {s} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    for at in range(0, len(c), _CHUNK):
        h = part = c[at:at + _CHUNK + max(SIZES) - 1] * np.uint32(0x9E3779B1)
        for n in range(2, max(SIZES) + 1):
            if len(part) < n:
                break
            h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + part[n - 1:]
            if n in SIZES:
                yield (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE3D) >> np.uint32(32 - BITS)


def features(text: str | None, use: np.ndarray | None = None) -> np.ndarray:
    """The sorted numbers of the distinct n-grams, with ``use`` (a flag per
    number) only those; none for a text that is null, empty or white space."""
    if use is None:
        seen = np.zeros(DIMS, dtype=bool)
        for h in _hashes(text):
            seen[h] = True
        return np.flatnonzero(seen)
    return np.unique(np.concatenate([np.zeros(0, np.uint32), *[h[use[h]] for h in _hashes(text)]]))


def _ratios(learn: DataFrame) -> DataFrame:
    """(idx, r) of the features that are used, and a row with idx -1 whose r
    is the share of texts of class 1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, DIMS + 1), dtype=np.int64)
        for whole in batches:
            for b in slices(whole, ["text"]):
                for text, label in zip(*[c.to_pylist() for c in b.columns]):
                    n[label, features(text)] += 1
                    n[label, -1] += 1
        at = np.flatnonzero(n.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.where(at == DIMS, -1, at), pa.int32()),
                                          pa.array(n[0, at], pa.int64()), pa.array(n[1, at], pa.int64())],
                                         names=["idx", "c0", "c1"])

    counts = staged(learn.mapInArrow(run, "idx int, c0 long, c1 long").groupBy("idx").agg(
        F.sum("c0").alias("c0"), F.sum("c1").alias("c1")), "toxicity-counts")
    whole = counts.where("idx = -1").select(F.col("c0").cast("double").alias("n0"),
                                            F.col("c1").cast("double").alias("n1"))
    # one row
    c = counts.crossJoin(F.broadcast(whole))
    n = F.col("n0") + F.col("n1")
    p0, p1, p = F.col("c0") / F.col("n0"), F.col("c1") / F.col("n1"), (F.col("c0") + F.col("c1")) / n
    error = F.sqrt(p * (1 - p) * (1 / F.col("n0") + 1 / F.col("n1")))
    some = SMOOTHING / n
    r = F.log((p1 + some) / (p0 + some))
    used = c.where((F.col("idx") >= 0) & (F.col("n0") > 0) & (F.col("n1") > 0)
                   & (F.abs(p1 - p0) > SIGNIFICANCE * error) & (F.abs(r) >= math.log(LEAST_RATIO)))
    return used.select("idx", r.alias("r")).union(
        whole.select(F.lit(-1).alias("idx"), F.col("n1") / n))


def _vectors(learn: DataFrame, at: np.ndarray, r: np.ndarray) -> DataFrame:
    """(label, features): a sparse vector over the used features for Spark ML.
    It is written by its parts and read back under its type."""
    spark = learn.sparkSession
    shared = spark.sparkContext.broadcast((at, r))           # DIMS numbers at most
    parts = VectorUDT.sqlType()

    def make():
        at, r = shared.value
        use = np.zeros(DIMS, dtype=bool)
        use[at] = True

        def rows(texts):
            out = []
            for t in texts:
                i = np.searchsorted(at, features(t, use))
                out.append({"type": 0, "size": len(at), "indices": i.astype(np.int32), "values": r[i]})
            return [out]
        return rows

    path = staging_path(spark, "toxicity-vectors")
    done = append_columns(learn, ["text"], [T.StructField("features", parts, False)], make)
    done.select(F.col("label").cast("double"), "features").write.option("compression", "zstd").parquet(path)
    kind = T.StructType([T.StructField("label", T.DoubleType()), T.StructField("features", VectorUDT())])
    return spark.read.schema(kind).parquet(path)


def fit(learn: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """(feature numbers, their weight x r, intercept) from (text, label);
    labels are 0 or 1, other rows teach nothing. With one class only, or no
    feature that tells them apart, the score is the share of class 1, kept
    off 0 and 1; without rows it is 0.5."""
    ship_package(learn.sparkSession)
    learn = learn.where("label in (0, 1)").select("text", F.col("label").cast("int").alias("label"))
    found = _ratios(learn).toArrow()                         # DIMS rows at most
    idx, r = found.column("idx").to_numpy(), found.column("r").to_numpy()
    share = r[idx < 0]
    r, idx = r[idx >= 0], idx[idx >= 0]
    order = np.argsort(idx)
    idx, r = idx[order], r[order]
    if not len(idx):
        share = min(max(float(share[0]), 0.001), 0.999) if len(share) else 0.5
        return idx, r, float(np.log(share / (1 - share)))
    model = LogisticRegression(maxIter=ROUNDS, regParam=RIDGE, standardization=False, tol=1e-7).fit(
        _vectors(learn, idx, r))
    return idx, model.coefficients.toArray() * r, float(model.intercept)


def score(df: DataFrame, model: tuple[np.ndarray, np.ndarray, float], text_col: str = "text") -> DataFrame:
    """Append ``score`` (0 to 1) and ``predicted`` (1 if it is 0.5 at least)."""
    shared = df.sparkSession.sparkContext.broadcast(model)   # DIMS numbers at most

    def make():
        at, weight, intercept = shared.value
        use, w = np.zeros(DIMS, dtype=bool), np.zeros(DIMS)
        use[at], w[at] = True, weight

        def rows(texts):
            x = np.array([intercept + w[features(t, use)].sum() for t in texts])
            p = 1 / (1 + np.exp(-np.clip(x, -500, 500)))
            return [p.tolist(), (p >= 0.5).astype(int).tolist()]
        return rows

    return append_columns(df, [text_col], [T.StructField("score", T.DoubleType(), False),
                                           T.StructField("predicted", T.IntegerType(), False)], make)


def _labelled(rows: DataFrame, known: DataFrame) -> DataFrame:
    """(text, label) of the rows (id, text) whose id is in ``known`` (known,
    label). Texts are long and mostly unlabelled, so they are first held
    against a table of 2 ** ID_BITS bits, one set by each labelled id: most
    texts without a label never reach the shuffle."""
    def place(c):
        return F.pmod(F.xxhash64(c), F.lit(1 << ID_BITS))

    bits = known.select(place("known").alias("p")).select(
        F.floor(F.col("p") / 64).alias("word"), F.expr("shiftleft(1L, cast(p % 64 as int))").alias("bit")).groupBy(
        "word").agg(F.bit_or("bit").alias("bits"))           # 2 ** ID_BITS / 64 rows at most
    maybe = (rows.withColumn("p", place("id"))
                 .join(F.broadcast(bits), F.floor(F.col("p") / 64) == F.col("word"))
                 .where(F.expr("(bits & shiftleft(1L, cast(p % 64 as int))) != 0")))
    return maybe.join(known, F.col("id") == F.col("known")).select("text", "label")


def classify(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "label", keep: list[str] | None = None) -> DataFrame:
    """Learn from the labelled rows whose crc32(id as text) mod 5 is not 0,
    then judge every row: the ``keep`` columns (all by default), ``held_out``,
    ``score`` and ``predicted``.

    ``labels`` has ids and labels; an id that is labelled more than once counts
    as 1 if any of its labels is. A null id or label teaches nothing; a null id
    is held out. A null text counts as empty; texts without a used feature get
    the score of the intercept. Repeated rows are judged alike, and each of
    them teaches. Without rows to learn from every score is 0.5. A column named
    like a result is replaced; an empty table gives no rows.
    """
    results = {"held_out", "score", "predicted"}
    keep = [c for c in (keep or df.columns) if c not in results]
    ident = F.col(f"`{id_col}`")
    held = F.coalesce(F.crc32(ident.cast("string")) % 5 == 0, F.lit(True))
    known = labels.where(F.col(label_col).isin(0, 1)).groupBy(
        F.col(id_col).cast(df.schema[id_col].dataType).alias("known")).agg(
        F.max(label_col).alias("label"))
    rows = df.where(~held).select(ident.alias("id"), F.col(f"`{text_col}`").alias("text"))
    learn = staged(_labelled(rows, known.where("known is not null")), "toxicity-learn")
    model = fit(learn)
    cols = list(dict.fromkeys([*keep, text_col]))
    src = df.select(*[F.col(f"`{c}`") for c in cols], held.alias("held_out"))
    return score(src, model, text_col).select(*keep, "held_out", "score", "predicted")
