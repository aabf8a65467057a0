"""Operator 7: language by nearest centroid.

A text becomes a normalised TF-IDF vector of hashed character n-grams (one to
three letters, words padded with spaces). Each language has several centroids,
clustered by cosine. A text gets the language of its nearest centroid; it is
rejected when it lies farther away than nearly all texts of that language and
of about its length do.

Document frequencies and the rejection distances come from all learned rows;
the centroids from a sample of about SAMPLE rows per language, picked by a
hash of the row. The distances are those of texts that centroids have not seen:
the learned texts are dealt to two halves by a hash of the text, each half gets
centroids of its own, and a text is measured by those of the other half. The
model is a fixed number of floats per language.
"""

from __future__ import annotations

import re
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recprep.llm.common import append_columns, slices, staged
from recprep.session import ship_package

BITS = 14
DIMS = 1 << BITS
#: rows per language (about) that the centroids are fitted on
SAMPLE = 400
CENTROIDS = 4
#: share of unseen texts of a language and length band within the distance that is accepted
QUANTILE = 0.995
#: rows that a limit is taken from, at least, if there are so many
LEAST = 100
UNKNOWN = "und"
_ROWS = 128

_OTHER = re.compile(r"[\W\d_]+")


def _counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed n-grams; None if the text has no letter."""
    if not text:
        return None
    s = _OTHER.sub(" ", text.lower()).strip()
    if not s or not any(map(str.isalpha, s)):
        return None
    c = np.frombuffer(f" {s} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    h = c * np.uint32(0x9E3779B1)
    out = np.bincount(h >> np.uint32(32 - BITS), minlength=DIMS)
    for _ in range(2):
        h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + c[len(c) - len(h) + 1:] * np.uint32(0x9E3779B1)
        out += np.bincount((h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE3D) >> np.uint32(32 - BITS),
                           minlength=DIMS)
    return out


def _vectors(counts: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    x = np.array(counts, dtype=np.float32) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def half_of(text: Column) -> Column:
    """The half (0 or 1) that a learned text is in; equal texts are in one."""
    return F.pmod(F.xxhash64(text), F.lit(2)).cast("int")


def _learn_pass(learn: DataFrame, share: DataFrame) -> DataFrame:
    """Rows of two kinds: document frequencies (``lang`` null) and the sampled
    rows' sparse counts."""
    schema = "lang string, idx int, df long, half int, at binary, n binary"
    rows = learn.join(F.broadcast(share), learn["lang"] == share["l"]).select(
        "lang", "text", (F.pmod(F.xxhash64("lang", "text", "id"), F.lit(1 << 30)) < F.col("share") * (1 << 30))
        .alias("picked"), half_of(F.col("text")).alias("half"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(DIMS + 1, dtype=np.int64)       # the last: documents
        kinds = pa.schema([("lang", pa.string()), ("idx", pa.int32()), ("df", pa.int64()),
                           ("half", pa.int32()), ("at", pa.binary()), ("n", pa.binary())])
        for whole in batches:
            for b in slices(whole, ["text"]):
                out = []
                for lang, text, picked, half in zip(*[c.to_pylist() for c in b.columns]):
                    c = _counts(text)
                    if c is None:
                        continue
                    df[:-1] += c > 0
                    df[-1] += 1
                    if picked:
                        at = np.flatnonzero(c)
                        out.append({"lang": lang, "half": half, "at": at.astype("<u2").tobytes(),
                                    "n": c[at].astype("<u4").tobytes()})
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=kinds)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([
            pa.nulls(len(some), pa.string()), pa.array(some, pa.int32()), pa.array(df[some], pa.int64()),
            pa.nulls(len(some), pa.int32()), pa.nulls(len(some), pa.binary()), pa.nulls(len(some), pa.binary())], schema=kinds)

    return rows.mapInArrow(run, schema)


def _cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; the first centre is the mean direction, each further
    one starts at the row farthest from those before it."""
    centres = [x.mean(axis=0)]
    for _ in range(min(k, len(x)) - 1):
        c = np.array(centres)
        near = (x @ (c / np.linalg.norm(c, axis=1, keepdims=True)).T).max(axis=1)
        centres.append(x[int(np.argmin(near))])
    c = np.array(centres)
    for _ in range(rounds):
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        to = (x @ c.T).argmax(axis=1)
        c = np.array([x[to == j].mean(axis=0) if (to == j).any() else c[j] for j in range(len(c))])
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)


class Model:
    """``langs`` (sorted), ``idf`` and, row by row, ``centroids`` and the index
    of the language each belongs to; ``halves``: such (centroids, owner) of
    each half of the learned texts."""

    def __init__(self, langs: list[str], idf: np.ndarray, centroids: np.ndarray, owner: np.ndarray,
                 halves: list[tuple[np.ndarray, np.ndarray]] | None = None):
        self.langs, self.idf, self.centroids, self.owner = langs, idf, centroids, owner
        self.halves = halves or []

    def _best(self, x: np.ndarray, centroids: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Cosine of each row to the nearest centroid of each language; -1 if
        a language has none."""
        near = x @ centroids.T
        best = np.full((len(x), len(self.langs)), -1.0)
        for j, o in enumerate(owner):
            best[:, o] = np.maximum(best[:, o], near[:, j])
        return best

    def predict(self, texts: list) -> tuple[list, list]:
        """Languages and scores."""
        return self.judge(texts, [None] * len(texts), [None] * len(texts))[:2]

    def judge(self, texts: list, known: list, halves: list) -> tuple[list, list, list, list]:
        """Languages, scores, length bands and, for texts of a known language in
        a half, the distance to that language's centroids of the other half."""
        n = len(texts)
        langs, scores, bands, apart = [UNKNOWN] * n, [0.0] * n, [None] * n, [None] * n
        if not self.langs:
            return langs, scores, bands, apart
        rows, counts = [], []

        def flush():
            x = _vectors(counts, self.idf)
            best = self._best(x, self.centroids, self.owner)
            for i, b in zip(rows, best):
                o = int(b.argmax())                   # ties: the first language in order
                langs[i], scores[i] = self.langs[o], min(1.0, max(0.0, float(b[o])))
            for half, (centroids, owner) in enumerate(self.halves):
                at = [k for k, i in enumerate(rows) if halves[i] == 1 - half and known[i] in self.langs]
                if at and len(centroids):
                    for k, b in zip(at, self._best(x[at], centroids, owner)):
                        c = float(b[self.langs.index(known[rows[k]])])
                        apart[rows[k]] = None if c < 0 else max(0.0, 1.0 - c)
            rows.clear()
            counts.clear()

        for i, t in enumerate(texts):
            c = _counts(t)
            if c is not None:
                bands[i] = int(c.sum()).bit_length()
                rows.append(i)
                counts.append(c)
                if len(rows) == _ROWS:
                    flush()
        if rows:
            flush()
        return langs, scores, bands, apart


def fit(learn: DataFrame, sample: int = SAMPLE, centroids: int = CENTROIDS) -> Model:
    """Learn from (id, text, lang); rows with a null lang or without a letter
    teach nothing. No rows give a model that knows no language."""
    ship_package(learn.sparkSession)
    learn = learn.where("lang is not null")
    share = learn.groupBy(F.col("lang").alias("l")).agg(
        F.least(F.lit(1.0), sample / F.count("*")).alias("share"))
    found = staged(_learn_pass(learn, share), "language-counts")
    df = np.zeros(DIMS + 1)
    for r in found.where("lang is null").groupBy("idx").agg(F.sum("df").alias("df")).collect():
        df[r.idx] = r.df
    idf = (np.log((df[-1] + 1) / (df[:-1] + 1)) + 1).astype(np.float32)
    langs: list[str] = []
    fits: list[tuple[list, list]] = [([], []), ([], []), ([], [])]      # both halves, the first, the second
    for (lang,) in found.where("lang is not null").select("lang").distinct().orderBy("lang").collect():
        # about ``sample`` rows; never more than four times as many reach the driver
        rows = (found.where(F.col("lang") == lang).select("at", "n", "half").distinct()
                     .orderBy("at", "n", "half").limit(4 * sample).collect())
        counts = []
        for r in rows:
            c = np.zeros(DIMS, dtype=np.int64)
            c[np.frombuffer(r[0], "<u2")] = np.frombuffer(r[1], "<u4")
            counts.append(c)
        x, half = _vectors(counts, idf), np.array([r[2] for r in rows])
        for (parts, owner), mine in zip(fits, (half >= 0, half == 0, half == 1)):
            if mine.any():
                c = _cluster(x[mine], centroids)
                owner += [len(langs)] * len(c)
                parts.append(c)
        langs.append(lang)
    whole, *halves = [(np.concatenate(parts).astype(np.float32) if parts else np.zeros((0, DIMS), np.float32),
                       np.array(owner, dtype=int)) for parts, owner in fits]
    return Model(langs, idf, *whole, halves)


def predict(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Append ``lang_pred`` (UNKNOWN for null texts and texts without a letter)
    and ``score``, the cosine to the nearest centroid (0 for UNKNOWN)."""
    shared = df.sparkSession.sparkContext.broadcast(model)   # fixed floats per language

    def make():
        return lambda texts: list(shared.value.predict(texts))

    return append_columns(df, [text_col], [T.StructField("lang_pred", T.StringType(), False),
                                           T.StructField("score", T.DoubleType(), False)], make)


def limits(distances: dict[tuple[str, int], dict[float, int]], quantile: float = QUANTILE,
           least: int = LEAST) -> dict[tuple[str, int], float]:
    """The farthest distance that is accepted, by language and length band,
    from counts of distances of unseen texts by language and band: the
    ``quantile``, or the largest where fewer than 1 / (1 - quantile) are known.

    A band of fewer than ``least`` texts takes in its neighbours on both sides,
    then the band's texts of all languages (how far a text lies depends on its
    length more than on its language), then theirs of one more band on both
    sides at a time.
    """
    out = {}
    langs = sorted({name for name, _ in distances})
    for lang in langs:
        for band in range(65):
            for names, reach in [([lang], 0), ([lang], 1)] + [(langs, r) for r in range(65)]:
                near = [d for (name, b), d in distances.items() if name in names and abs(b - band) <= reach]
                rows = sum(sum(d.values()) for d in near)
                if rows >= least:
                    break
            left = max(1.0, rows * (1 - quantile))
            for far, n in sorted(((x, n) for d in near for x, n in d.items()), reverse=True):
                left -= n
                if left <= 1e-9:
                    break
            out[lang, band] = far
    return out


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             keep: list[str] | None = None) -> DataFrame:
    """Learn from the rows whose crc32(id as text) mod 5 is not 0, then judge
    every row: the ``keep`` columns (all by default), ``held_out``,
    ``lang_pred``, ``score`` and ``rejected``.

    ``rejected``: the language is UNKNOWN, or the distance 1 - score exceeds
    the limit (``limits``) of the predicted language at the text's length; a
    language learned from one text alone has no limit. Null ids: held out, so
    that they teach nothing. Repeated rows are judged alike; an input column
    named like a result is replaced; an empty table gives no rows.
    """
    spark = df.sparkSession
    results = {"held_out", "lang_pred", "score", "rejected"}
    keep = [c for c in (keep or df.columns) if c not in results]
    fold = F.crc32(F.col(f"`{id_col}`").cast("string")) % 5
    held = F.coalesce(fold == 0, F.lit(True))
    learn = df.where(~held).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
                                   F.col(f"`{lang_col}`").alias("lang"))
    shared = spark.sparkContext.broadcast(fit(learn))        # fixed floats per language
    cols = list(dict.fromkeys([*keep, text_col]))
    src = df.select(*[F.col(f"`{c}`") for c in cols], held.alias("held_out"),
                    F.when(~held, F.col(f"`{lang_col}`")).alias("__known"),
                    F.when(~held, half_of(F.col(f"`{text_col}`"))).alias("__half"))

    def make():
        return lambda texts, known, halves: list(shared.value.judge(texts, known, halves))

    judged = staged(append_columns(src, [text_col, "__known", "__half"], [
        T.StructField("lang_pred", T.StringType(), False), T.StructField("score", T.DoubleType(), False),
        T.StructField("__band", T.IntegerType()), T.StructField("__apart", T.DoubleType())], make).select(
        *keep, "__known", "held_out", "lang_pred", "score", "__band", "__apart"), "language-judged")
    # a count per language, band and thousandth: bounded by the number of languages
    counts: dict[tuple[str, int], dict[float, int]] = {}
    for r in (judged.where((F.col("lang_pred") == F.col("__known")) & F.col("__apart").isNotNull())
                    .groupBy("lang_pred", "__band", F.ceil(F.col("__apart") * 1000).alias("far")).count().collect()):
        counts.setdefault((r[0], r[1]), {})[r[2] / 1000] = r[3]
    far = spark.createDataFrame([(lang, band, x) for (lang, band), x in sorted(limits(counts).items())],
                                "l string, b int, limit double")
    out = judged.join(F.broadcast(far), (judged["lang_pred"] == far["l"]) & (judged["__band"] == far["b"]), "left")
    return out.select(*keep, "held_out", "lang_pred", "score",
                      ((F.col("lang_pred") == UNKNOWN)
                       | F.coalesce(1 - F.col("score") > F.col("limit"), F.lit(False))).alias("rejected"))
