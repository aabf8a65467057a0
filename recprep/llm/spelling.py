"""Operator 11: spelling variants by dense prefix-suffix tiling.

Two words differ by exactly one inserted, deleted or replaced code point just
when their common prefix plus their common suffix reach the longer length
minus one. Words are laid out as matrices of code points, padded once on the
right and once on the left; tiles of TILE x TILE rows are compared position by
position, which gives the prefix and suffix lengths of all their pairs.

Only tiles that can hold a pair are compared. With L the longer length, the
prefix or the suffix has at least L // 2 code points, so a word goes to the
groups of its first and of its last L // 2 code points, once as the longer
word (L its length) and once as the shorter (L one more). A pair whose halves
both agree counts in the prefix group only. A group of more than BLOCK words
is cut into blocks by a hash of the word, and its pairs of blocks are dealt to
different tasks; no list of pairs leaves a task, only each word's number of
near words and the best of them.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recprep.llm.common import staged
from recprep.operators.joins import maybe_broadcast
from recprep.session import ship_package

MIN_LENGTH = 7
MIN_COUNT = 2
#: a form is at least so many times as frequent as the variant
RATIO = 10
#: words of a group that one task holds, twice at most
BLOCK = 4096
#: rows of a tile, and pairs that are compared at once (about)
TILE = 32
PAIRS = 1 << 19

_CELL = ["longer", "side", "key", "lo", "hi"]
_SCHEMA = "word string, n long, near long, best_n long, best string"


def word_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT, drop_every: int | None = None) -> DataFrame:
    """(word, n) of all words of ``min_length`` code points and ``min_count``
    occurrences at least. Words are maximal runs of A-Z, a-z and U+00C0 to
    U+00FF in the whole texts; only A-Z are lower-cased.

    With ``drop_every``, let h be the crc32 of ``<id>:<run>``: if it is a
    multiple of ``drop_every``, the run loses its code point h % length. A null
    id counts as the empty text there. Null and empty texts have no words; a
    repeated row counts each time.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = F.translate(F.col(f"`{text_col}`"), upper, upper.lower())
    # a run that is too short stays too short
    runs = df.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), F.explode(
        F.regexp_extract_all(lowered, F.lit(f"([a-zÀ-ÿ]{{{min_length},}})"), F.lit(1))).alias("word"))
    if drop_every:
        runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "word")))
        at = (F.col("h") % F.char_length("word")).cast("int")
        less = F.concat(F.left("word", at), F.substring("word", at + 2, F.char_length("word")))
        runs = runs.withColumn("word", F.when(F.col("h") % drop_every == 0, less).otherwise(F.col("word")))
        runs = runs.where(F.char_length("word") >= min_length)
    return runs.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _cells(words: DataFrame, block: int) -> DataFrame:
    """Every word once for each pair of blocks that it takes part in."""
    def group(extra: int, side: int):
        longer = F.char_length("word") + extra
        half = (longer / 2).cast("int")
        part = F.left("word", half) if side == 0 else F.right("word", half)
        return F.struct(longer.alias("longer"), F.lit(side).alias("side"), F.xxhash64(part).alias("key"))

    rows = words.select("word", "n", F.explode(F.array(*[group(e, s) for e in (0, 1) for s in (0, 1)]))
                        .alias("g")).select("word", "n", "g.*")
    # at most 4 / block of the words
    large = (rows.groupBy("longer", "side", "key").agg(F.count("*").alias("size")).where(F.col("size") > block)
                 .select("longer", "side", "key", F.ceil(F.col("size") / block).cast("int").alias("blocks")))
    rows = (rows.join(maybe_broadcast(large), ["longer", "side", "key"], "left")
                .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
                .withColumn("block", F.pmod(F.xxhash64("word", F.lit(1)), F.col("blocks")).cast("int"))
                .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    return rows.select("longer", "side", "key", F.least("block", "other").alias("lo"),
                       F.greatest("block", "other").alias("hi"), "block", "word", "n")


def _matrix(words: list[str], sizes: np.ndarray, width: int, left: bool) -> np.ndarray:
    """Code points + 1, by position and row, in whole tiles; 0 is padding."""
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4") + 1
    kind = np.uint8 if not len(points) or points.max() < 256 else np.uint16 if points.max() < 65536 else np.uint32
    out = np.zeros((width, -(-len(words) // TILE) * TILE), dtype=kind)
    row = np.repeat(np.arange(len(words)), sizes)
    pos = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[pos if left else width - np.repeat(sizes, sizes) + pos, row] = points
    return out.reshape(width, -1, TILE)


def _agreeing(m: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Leading positions that agree, for all pairs of the tiles x and y."""
    alive = np.ones((len(x), TILE, TILE), dtype=bool)
    count = np.zeros(alive.shape, dtype=np.uint8 if len(m) < 256 else np.int32)
    for row in m:
        alive &= row[x][:, :, None] == row[y][:, None, :]
        if not alive.any():
            break
        count += alive
    return count


def near_pairs(words: list[str], cell: np.ndarray, block: np.ndarray, same: np.ndarray, width: int,
               side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (a, b), a < b, of all near pairs whose longer word has
    ``width`` code points. Rows are sorted by cell, then block; a pair lies in
    one cell, and in two blocks unless ``same`` holds for the cell."""
    n = len(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=n)
    left, right = _matrix(words, sizes, width, True), _matrix(words, sizes, width, False)[::-1]
    tiles = left.shape[1]

    def tiled(values: np.ndarray, fill) -> np.ndarray:
        out = np.full(tiles * TILE, fill, dtype=values.dtype)
        out[:n] = values
        return out.reshape(tiles, TILE)

    cells, blocks, long = tiled(cell, -1), tiled(block, 0), tiled(sizes == width, False)
    alike, sides = tiled(same, True), tiled(side, 0)
    first = cell[np.arange(tiles) * TILE]
    last = cell[np.minimum(np.arange(tiles) * TILE + TILE, n) - 1]
    reach = np.searchsorted(first, last, side="right") - np.arange(tiles)
    x = np.repeat(np.arange(tiles), reach)
    y = x + np.arange(len(x)) - np.repeat(np.cumsum(reach) - reach, reach)
    # both tiles inside one block of a cell that compares two blocks
    inner = (first == last) & (blocks == blocks[:, :1]).all(axis=1)
    use = ~(inner[x] & inner[y] & (first[x] == first[y]) & (blocks[x, 0] == blocks[y, 0]) & ~alike[x, 0])
    x, y = x[use], y[use]
    found_a, found_b = [], []
    later = np.arange(TILE)[:, None] < np.arange(TILE)[None, :]
    step = max(1, PAIRS // (TILE * TILE))
    for at in range(0, len(x), step):
        p, q = x[at:at + step], y[at:at + step]
        ok = cells[p][:, :, None] == cells[q][:, None, :]
        ok &= (p != q)[:, None, None] | later
        ok &= long[p][:, :, None] | long[q][:, None, :]
        ok &= alike[p][:, :, None] | (blocks[p][:, :, None] != blocks[q][:, None, :])
        front, back = _agreeing(left, p, q), _agreeing(right, p, q)
        ok &= front.astype(np.int32) + back >= width - 1
        ok &= (front >= width // 2) == (sides[p][:, :, None] == 0)
        k, i, j = np.nonzero(ok)
        found_a.append(p[k] * TILE + i)
        found_b.append(q[k] * TILE + j)
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    a, b = join(found_a), join(found_b)
    real = (a < n) & (b < n)
    return a[real], b[real]


def _summary(rows: pa.Table) -> pa.RecordBatch:
    """Near words counted, and the best one, of the rows of whole cells; words
    without one come out of their home cell only."""
    words, n = rows.column("word").to_pylist(), rows.column("n").to_numpy()
    col = {c: rows.column(c).to_numpy() for c in [*_CELL, "block"]}
    size = len(words)
    new = np.zeros(size, dtype=bool)
    for c in _CELL:
        new[1:] |= col[c][1:] != col[c][:-1]
    cell = np.cumsum(new)
    same = col["lo"] == col["hi"]
    ends = np.flatnonzero(np.diff(col["longer"])) + 1
    pairs = []
    for lo, hi in zip([0, *ends], [*ends, size]):
        a, b = near_pairs(words[lo:hi], cell[lo:hi] - cell[lo], col["block"][lo:hi], same[lo:hi],
                          int(col["longer"][lo]), col["side"][lo:hi])
        pairs += [(a + lo, b + lo), (b + lo, a + lo)]
    mine = np.concatenate([p[0] for p in pairs])
    near = np.concatenate([p[1] for p in pairs])
    counts = np.bincount(mine, minlength=size)
    best = np.full(size, -1)
    if len(mine):
        rank = np.empty(size, dtype=np.int64)
        rank[sorted(range(size), key=words.__getitem__)] = np.arange(size)
        order = np.lexsort((rank[near], -n[near], mine))
        mine, near = mine[order], near[order]
        head = np.flatnonzero(np.diff(mine, prepend=-1))
        best[mine[head]] = near[head]
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=size)
    home = same & (col["side"] == 0) & (col["longer"] == sizes)
    out = np.flatnonzero(home | (counts > 0))
    return pa.RecordBatch.from_arrays([
        pa.array([words[i] for i in out], pa.string()), pa.array(n[out], pa.int64()),
        pa.array(counts[out], pa.int64()),
        pa.array([int(n[b]) if b >= 0 else None for b in best[out]], pa.int64()),
        pa.array([words[b] if b >= 0 else None for b in best[out]], pa.string())],
        names=["word", "n", "near", "best_n", "best"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole cells, in order; the last cell of a batch waits for the next."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        key = [b.column(c).to_numpy() for c in _CELL]
        old = [held[-1].column(c)[-1].as_py() for c in _CELL] if held else None
        changed = np.zeros(b.num_rows, dtype=bool)
        changed[0] = held and any(k[0] != o for k, o in zip(key, old))
        for k in key:
            changed[1:] |= k[1:] != k[:-1]
        cut = np.flatnonzero(changed)
        if not len(cut):
            held.append(b)
            continue
        whole = held + ([b.slice(0, cut[-1])] if cut[-1] else [])
        if whole:
            yield _summary(pa.Table.from_batches(whole))
        held = [b.slice(cut[-1])]
    if held:
        yield _summary(pa.Table.from_batches(held))


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n, n_near, best, best_n) of every row of ``words`` (word, n; each
    word once, none null): how many others are near, and of those the one with
    the largest n (ties: the first in code-point order), or null."""
    ship_package(words.sparkSession)
    cells = _cells(words, block).repartition(*_CELL).sortWithinPartitions(*_CELL, "block")
    return (cells.mapInArrow(_compare, _SCHEMA).groupBy("word")
                 .agg(F.max("n").alias("n"), F.sum("near").alias("n_near"),
                      F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("m"), "best")))
                      .alias("b"))
                 .select("word", "n", "n_near", F.col("b.best").alias("best"), (-F.col("b.m")).alias("best_n")))


def _roots(links: DataFrame) -> DataFrame:
    """(word, root): each word's last form. Every step multiplies n, so a
    chain is short; each round doubles the steps taken."""
    far = staged(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = far.select(F.col("word").alias("w"), F.col("root").alias("r"))
        far = staged(far.join(step, far["root"] == step["w"], "left").select(
            "word", F.coalesce("r", "root").alias("root"), F.col("r").isNotNull().alias("moved")), "spelling-roots")
        if far.where("moved").isEmpty():
            return far.select("word", "root")
        far = far.drop("moved")


def spelling_variants(words: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """``words`` (word, n; each word once) with ``form``, the best near word if
    it is at least ``ratio`` times as frequent, ``root``, the end of the chain
    of forms (the word itself without one), ``n_near`` and ``form_n``. Null
    words go; no words give no rows."""
    words = staged(words.where("word is not null").select("word", F.col("n").cast("long").alias("n")),
                   "spelling-words")
    better = F.col("best_n") >= ratio * F.col("n")
    near = staged(near_words(words, block).select(
        "word", "n", "n_near", F.when(better, F.col("best")).alias("form"),
        F.when(better, F.col("best_n")).alias("form_n")), "spelling-near")
    roots = _roots(near.where("form is not null")).select(F.col("word").alias("w"), "root")
    return near.join(roots, near["word"] == roots["w"], "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
