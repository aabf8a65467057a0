"""Operator 9: SimHash near-duplicates by multi-index hashing.

A fingerprint has a bit where over half of a text's shingle hashes have it.
To find all pairs within ``max_bits`` differing bits, the 64 bits are cut into
segments. With ``m`` segments and ``max_bits = m * r + a``, a near pair differs
by at most ``r`` bits in one of the first ``a + 1`` segments or by at most
``r - 1`` in one of the others. So every fingerprint probes, per segment, the
table of that segment's values with the small Hamming ball around its own
value; matches are verified over all 64 bits. Only distinct fingerprints are
compared, so groups of copies cost one row each.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recprep.llm.common import append_columns, staged
from recprep.llm.components import components

#: Fixed value: the seed of the shingle hash (Spark's own xxhash64 uses it too).
SEED = 42
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_STEP = 1 << 14


def fingerprint(text: str | None, words: int = 3) -> int:
    """The 64-bit fingerprint of a text (null or without words: 0)."""
    import xxhash

    w = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not w:
        return 0
    joined = b" ".join(w)
    starts = np.zeros(len(w) + 1, dtype=np.int64)
    np.cumsum(np.fromiter(map(len, w), dtype=np.int64, count=len(w)) + 1, out=starts[1:])
    n = max(1, len(w) - words + 1)
    begin, end = starts[:n].tolist(), (starts[min(words, len(w)):][:n] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, n, _STEP):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(begin[k:k + _STEP], end[k:k + _STEP])],
                     dtype=">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(df: DataFrame, text_col: str = "text", words: int = 3,
                 out_col: str = "fingerprint") -> DataFrame:
    """Append the fingerprint as a bigint (the unsigned value's two's
    complement). Lower-cases A-Z only; words are runs of anything but ASCII
    white space; a text of fewer words than a shingle is one shingle."""
    def make():
        def rows(texts):
            v = np.array([fingerprint(t, words) for t in texts], dtype=np.uint64)
            return [pa.array(v.view(np.int64))]
        return rows
    return append_columns(df, [text_col], [T.StructField(out_col, T.LongType(), False)], make)


def _segments(max_bits: int, segment_bits: int = 32) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of each segment; a negative radius is left out."""
    m = 64 // segment_bits
    r, a = divmod(max_bits, m)
    plan = [(i * segment_bits, segment_bits, r if i <= a else r - 1) for i in range(m)]
    return [p for p in plan if p[2] >= 0]


def _ball(width: int, radius: int) -> list[int]:
    """All masks of at most ``radius`` set bits."""
    return [sum(1 << i for i in c) for k in range(radius + 1) for c in combinations(range(width), k)]


def near_fingerprints(fps: DataFrame, col: str, max_bits: int) -> DataFrame:
    """All pairs (a < b) of the distinct values in ``col`` that differ in 1 to
    ``max_bits`` bits."""
    tables, probes = None, None
    for k, (shift, width, radius) in enumerate(_segments(max_bits)):
        value = F.shiftrightunsigned(F.col(col), shift).bitwiseAND(F.lit((1 << width) - 1))
        t = fps.select(F.lit(k).alias("segment"), value.alias("key"), F.col(col).alias("b"))
        masks = F.array(*[F.lit(m).cast("long") for m in _ball(width, radius)])
        p = fps.select(F.col(col).alias("a"), value.alias("v"), F.explode(masks).alias("mask")).select(
            F.lit(k).alias("segment"), F.col("v").bitwiseXOR(F.col("mask")).alias("key"), "a")
        tables = t if tables is None else tables.union(t)
        probes = p if probes is None else probes.union(p)
    if tables is None:
        return fps.select(F.col(col).alias("a"), F.col(col).alias("b")).limit(0)
    # the optimizer sizes the probes like the fingerprints they come from, a
    # ball smaller than they are; without the hint it would broadcast them
    p, t = probes.hint("merge").alias("p"), tables.alias("t")
    pairs = p.join(t, (F.col("p.segment") == F.col("t.segment")) & (F.col("p.key") == F.col("t.key"))
                   & (F.col("a") != F.col("b"))
                   & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def as_hex(fingerprint: Column) -> Column:
    """A bigint fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                    max_bits: int = 2) -> DataFrame:
    """One row per row of ``df``: its id, ``fingerprint`` (16 lower-case hex
    digits), ``component_id``, the smallest id reachable over links of at most
    ``max_bits`` differing bits, its own included, and ``component_key``, a
    fingerprint that names the component.

    Equal fingerprints link, those of empty and null texts (zero) too. Repeated
    rows are kept. Null ids take no part in the smallest id; a component of
    null ids alone has a null one. Other columns are ignored; an empty table
    gives no rows.
    """
    src = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    marked = staged(fingerprints(src, "text", words, "fp").select("id", "fp"), "fingerprints")
    distinct = staged(marked.groupBy("fp").agg(F.min("id").alias("first")), "distinct-fingerprints")
    roots = components(near_fingerprints(distinct, "fp", max_bits), "a", "b")
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select(F.col("fp").alias("k"), "component_id", "root")
    out = marked.join(named, marked["fp"] == named["k"])
    return out.select(F.col("id").alias(id_col), as_hex(F.col("fp")).alias("fingerprint"),
                      "component_id", as_hex(F.col("root")).alias("component_key"))
