"""Operator 13: tokens of two tokenizers aligned by diagonal run skipping.

Both tokenizations of a text are arrays of the byte offsets where tokens end.
From a common offset, slices of both arrays at the current index shift are
compared, doubling their length while they agree and halving it after a
mismatch: a stretch of one-to-one tokens is jumped in a few comparisons. At
the mismatch the two arrays are walked, the lesser end first, to the next
common offset; the tokens passed are one irregular group, every step of the
walk is a link, and the shift changes by what the sides differ.

A link is a pair of token occurrences whose byte ranges overlap; how often a
pair of ids is linked is counted over the whole corpus. Documents are
tokenized once and go into blocks of about BLOCK_BYTES of text: a block keeps
each document's pairs as numbers into its own distinct pairs, with their
counts. Only the distinct pairs are summed over blocks, and only their totals
come back to the block.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from struct import pack
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recprep.llm.bpe import byte_alphabet
from recprep.llm.common import append_columns, slices, staged
from recprep.llm.packing import fast_tokenizer
from recprep.session import ship_package

BLOCK_BYTES = 12 << 20
#: tokens of one side that a walk holds as Python numbers (more for one longer group)
WINDOW = 1 << 16
#: words remembered per Python worker, and the length from which none is
MEMO_ENTRIES = 400_000
MEMO_LENGTH = 100
#: U+2581, which stands for a space in the second vocabulary
MARK = "▁"


def align(ends_a: np.ndarray, ends_b: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """Groups and links of two arrays of token ends, both strictly increasing
    up to the same last end.

    Returns (group_a, group_b, link_a, link_b): how many tokens of A and of B
    each group ends after, and the token numbers of each link, in order.
    """
    # one-to-one stretches (tokens before, length), and irregular groups' ends
    run_a: list[int] = []
    run_b: list[int] = []
    run_n: list[int] = []
    odd_a: list[int] = []
    odd_b: list[int] = []
    link_a: list[int] = []
    link_b: list[int] = []
    i = j = 0
    size = window
    while i < len(ends_a):
        a, b = ends_a[i:i + size].tolist(), ends_b[j:j + size].tolist()
        na, nb = len(a), len(b)
        x = y = 0
        while x < na and y < nb:
            if a[x] == b[y]:
                left = min(na - x, nb - y)
                k, step = 1, 1
                while k + step <= left and a[x + k:x + k + step] == b[y + k:y + k + step]:
                    k += step
                    step *= 2
                while step > 1:
                    step >>= 1
                    if k + step <= left and a[x + k:x + k + step] == b[y + k:y + k + step]:
                        k += step
                run_a.append(i + x)
                run_b.append(j + y)
                run_n.append(k)
                x += k
                y += k
                continue
            u, v, mark = x, y, len(link_a)
            while u < na and v < nb:
                link_a.append(i + u)
                link_b.append(j + v)
                d = a[u] - b[v]
                if d < 0:
                    u += 1
                elif d > 0:
                    v += 1
                else:
                    break
            else:                                     # the group goes on behind the window
                del link_a[mark:], link_b[mark:]
                break
            x, y = u + 1, v + 1
            odd_a.append(i + x)
            odd_b.append(j + y)
        size = window if x else 2 * size
        i += x
        j += y
    n = np.array(run_n, dtype=np.int64)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    one_a = np.repeat(np.array(run_a, dtype=np.int64), n) + at
    one_b = np.repeat(np.array(run_b, dtype=np.int64), n) + at
    merged = [np.sort(np.concatenate([one, np.array(odd, dtype=np.int64)]), kind="stable")
              for one, odd in ((one_a + 1, odd_a), (one_b + 1, odd_b), (one_a, link_a), (one_b, link_b))]
    return tuple(merged)


class Aligner:
    """Tokenizes texts both ways and aligns the tokens."""

    def __init__(self, tokenizer_json: str, piece_model: bytes):
        import sentencepiece

        self.json, self.slow = tokenizer_json, None
        self.fast = fast_tokenizer(tokenizer_json)
        alpha = byte_alphabet()
        spec = json.loads(tokenizer_json)
        vocab = spec["model"]["vocab"]
        self.bytes_a = [b""] * (1 + max(vocab.values()))
        for p, i in vocab.items():
            self.bytes_a[i] = bytes(alpha[c] for c in p) if all(c in alpha for c in p) else p.encode("utf-8")
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.vocab_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace(MARK, " ").encode("utf-8")
                        for i, p in enumerate(names)]
        #: no piece goes on over a space: words can be encoded apart
        self.by_word = not any(MARK in p.lstrip(MARK) for p in names)
        self.odd_space = re.compile(r" \s|\s ").search
        #: word -> packed ids of both sides after a space, None if bytes differ
        self.words: dict[str, tuple[bytes, bytes] | None] = {}
        self.size_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        self.names = [f"{i}{mark}" for mark in ",|" for i in range(len(self.bytes_a))] + [
            f"{i}{mark}" for mark in ",;" for i in range(len(self.bytes_b))]

    def _first(self, text: str) -> list[int]:
        """Ids of A; special strings are plain text."""
        if len(text) <= MEMO_LENGTH:
            return self.fast.encode_ordinary(text)
        try:
            return self.fast.encode_to_numpy(text, allowed_special=set(), disallowed_special=()).tolist()
        except ValueError as e:
            if "Max stack size exceeded" not in str(e):
                raise
        if self.slow is None:                         # long runs of white space
            import tokenizers
            self.slow = tokenizers.Tokenizer.from_str(self.json)
            self.slow.no_truncation()
            self.slow.no_padding()
            self.slow.encode_special_tokens = True
        return self.slow.encode(text, add_special_tokens=False).ids

    def _encode(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Packed ids of both sides of each text; None if the bytes of either
        side are not those of the space and the text."""
        out: list = []
        of_a, of_b = self.bytes_a.__getitem__, self.bytes_b.__getitem__
        for text, b in zip(texts, self.pieces.encode(texts, num_threads=1)):
            text = " " + text
            a, raw = self._first(text), text.encode("utf-8")
            same = b"".join(map(of_a, a)) == raw and b"".join(map(of_b, b)) == raw
            out.append((pack(f"<{len(a)}I", *a), pack(f"<{len(b)}I", *b)) if same else None)
        return out

    def tokens(self, texts: list) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides of each text; none if it is null or empty, or if
        either side does not give it back."""
        if len(self.words) > MEMO_ENTRIES:
            self.words.clear()
        known, parts, new, long = self.words, [], set(), {}
        for text in texts:
            split = text and self.by_word and not (self.odd_space(text) or text[0] == " " or text[-1] == " ")
            found = text.split(" ") if split else [text] if text else []
            parts.append((found, split))
            if split:
                new.update(w for w in found if w not in known and len(w) < MEMO_LENGTH)
        new = list(new)
        known.update(zip(new, self._encode(new)))
        none = np.zeros(0, dtype="<u4"), np.zeros(0, dtype="<u4")
        out = []
        for found, split in parts:
            got = [known[w] if split and len(w) < MEMO_LENGTH else self._encode([w])[0] for w in found]
            if not got or None in got:
                out.append(none)
            else:
                out.append(tuple(np.frombuffer(b"".join([g[k] for g in got]), dtype="<u4") for k in (0, 1)))
        return out

    def __call__(self, texts: list) -> Iterator[tuple[np.ndarray, ...]]:
        """(ids a, ids b, group ends a, b, links a, b) of each text."""
        for a, b in self.tokens(texts):
            yield (a, b, *align(np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])))

    def notation(self, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> str:
        """The groups as text: ``a1,a2|b1;a3|b2,b3``."""
        # the groups before a token say where it stands
        before_a = np.concatenate([[0], group_a])
        before_b = np.concatenate([[0], group_b])
        of_a = np.repeat(np.arange(len(group_a)), np.diff(before_a))
        of_b = np.repeat(np.arange(len(group_b)), np.diff(before_b))
        name_a, name_b = a.astype(np.int64), b.astype(np.int64) + 2 * len(self.bytes_a)
        name_a[group_a - 1] += len(self.bytes_a)
        name_b[group_b - 1] += len(self.bytes_b)
        order = np.empty(len(a) + len(b), dtype=np.int64)
        order[np.arange(len(a)) + before_b[of_a]] = name_a
        order[np.arange(len(b)) + before_a[of_b + 1]] = name_b
        return "".join(map(self.names.__getitem__, order.tolist()))[:-1]


_ALIGNER: dict[int, Aligner] = {}


def _sharer(spark, tokenizer_path: str, piece_path: str):
    """A function that gives the worker's aligner of two vocabulary files; the
    files (a few MB) are read on the driver and broadcast."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    with open(piece_path, "rb") as f:
        model = f.read()
    key = zlib.crc32(model, zlib.crc32(spec.encode("utf-8")))
    shared = spark.sparkContext.broadcast((spec, model))

    def get() -> Aligner:
        if key not in _ALIGNER:
            _ALIGNER.clear()
            _ALIGNER[key] = Aligner(*shared.value)
        return _ALIGNER[key]
    return get


def align_texts(df: DataFrame, tokenizer_path: str, piece_path: str, text_col: str = "text",
                groups_col: str = "groups") -> DataFrame:
    """Append ``groups_col`` (array of struct<a, b>: the ids of each group of
    both tokenizers, in order). Null and empty texts, and texts that either
    tokenizer does not give back byte for byte, have none. Every row and other
    column is kept; equal texts give equal groups."""
    get = _sharer(df.sparkSession, tokenizer_path, piece_path)
    ids = T.ArrayType(T.IntegerType(), False)
    field = T.StructField(groups_col, T.ArrayType(T.StructType([
        T.StructField("a", ids, False), T.StructField("b", ids, False)]), False), False)

    def make():
        aligner = get()

        def rows(texts):
            out = []
            for a, b, group_a, group_b, _, _ in aligner(texts):
                cut = zip([0, *group_a[:-1]], group_a, [0, *group_b[:-1]], group_b)
                out.append([{"a": a[i:j].tolist(), "b": b[k:m].tolist()} for i, j, k, m in cut])
            return [out]
        return rows

    return append_columns(df, [text_col], [field], make)


def _blob(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(
            compression=pa.Codec("zstd", 3))) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def _steps(numbers: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rising numbers of consecutive lists as differences, each list anew."""
    out = np.diff(numbers, prepend=0)
    heads = ends[:-1][ends[:-1] < ends[1:]]
    out[heads] = numbers[heads]
    return out


def _unstep(steps: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.cumsum(steps)
    before = np.concatenate([[0], total])[ends[:-1]]
    return total - np.repeat(before, np.diff(ends))


_BLOCK_SCHEMA = "block long, blob binary, pairs array<long>, counts array<long>"


def _blocks(src: DataFrame, get, keep: list[str]) -> DataFrame:
    """Blocks of documents: the rows' results and, numbered within the block,
    their pairs; and the block's distinct pairs with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = get()
        number = TaskContext.get().partitionId() << 32
        kept: list[pa.RecordBatch] = []
        rows: list[tuple] = []
        pairs: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        size = 0

        def block() -> pa.RecordBatch:
            flat = np.concatenate(pairs)
            times = np.concatenate(counts)
            ends = np.cumsum([0] + [len(p) for p in pairs])
            distinct, at = np.unique(flat, return_inverse=True)
            sums = np.bincount(at, times, len(distinct)).astype(np.int64)
            table = pa.Table.from_batches(kept)
            for k, name in enumerate(("n_a", "n_b", "n_groups", "n_links")):
                table = table.append_column(name, pa.array([r[k] for r in rows], pa.int64()))
            table = table.append_column("groups_sha256", pa.array([r[4] for r in rows], pa.string()))
            at = _steps(at, ends)
            for name, values in (("pair", at), ("times", times)):
                table = table.append_column(name, pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(values.astype(np.uint32))))
            for part in (kept, rows, pairs, counts):
                part.clear()
            return pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.array([_blob(table.combine_chunks())], pa.binary()),
                pa.array([distinct], pa.list_(pa.int64())), pa.array([sums], pa.list_(pa.int64()))],
                names=["block", "blob", "pairs", "counts"])

        for whole in batches:
            for b in slices(whole, ["__text"]):
                texts = b.column(b.schema.get_field_index("__text")).to_pylist()
                kept.append(b.select(keep))
                for text, (ids_a, ids_b, group_a, group_b, la, lb) in zip(texts, aligner(texts)):
                    sha = hashlib.sha256(aligner.notation(ids_a, ids_b, group_a, group_b).encode()).hexdigest()
                    key, times = np.unique(ids_a[la].astype(np.int64) << 32 | ids_b[lb], return_counts=True)
                    pairs.append(key)
                    counts.append(times)
                    rows.append((len(ids_a), len(ids_b), len(group_a), len(la), sha if len(ids_a) else ""))
                    size += len(text or "")
                if size >= BLOCK_BYTES:
                    yield block()
                    number, size = number + 1, 0
        if rows:
            yield block()

    return src.mapInArrow(run, _BLOCK_SCHEMA)


def _fields(schema: T.StructType, keep: list[str]) -> T.StructType:
    long = [T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    return T.StructType([schema[c] for c in keep] + long + [T.StructField("groups_sha256", T.StringType())])


def link_counts(df: DataFrame, tokenizer_path: str, piece_path: str, text_col: str = "text",
                keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (all by default) of every row and ``n_a``, ``n_b``
    (tokens), ``n_groups``, ``n_links``, ``n_best`` (links whose pair is the
    most counted of its B id over the corpus, ties included), ``count_sum``
    (the counts of the links' pairs, summed over links) and ``groups_sha256``
    (of ``a1,a2|b1;a3|b2,b3``; '' without tokens).

    Texts as in ``align_texts``; without tokens all numbers are 0. Repeated
    rows are counted each; a column named like a result is replaced; an empty
    table gives no rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = df.sparkSession
    ship_package(spark)
    results = {"n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"}
    keep = [c for c in (keep or df.columns) if c not in results]
    src = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias("__text"))
    blocks = staged(_blocks(src, _sharer(spark, tokenizer_path, piece_path), keep), "alignment-blocks")
    asks = blocks.select("block", F.explode(F.arrays_zip("pairs", "counts")).alias("p")).select(
        "block", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n"))
    totals = staged(asks.groupBy("pair").agg(F.sum("n").alias("total")), "alignment-pairs")
    # one row per id of the second vocabulary
    most = totals.groupBy(F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b")).agg(
        F.max("total").alias("most"))
    judged = (totals.join(F.broadcast(most), F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)) == F.col("b"))
                    .select(F.col("pair").alias("key"), "total", (F.col("total") == F.col("most")).alias("best")))
    answers = asks.select(F.col("block").alias("to"), "pair").join(judged, F.col("pair") == F.col("key")).select(
        "to", "pair", "total", "best")
    out = _fields(src.schema, keep)
    kinds = to_arrow_schema(out)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return kinds.empty_table()
        rows = pa.ipc.open_stream(left.column("blob")[0].as_py()).read_all().combine_chunks()
        order = np.argsort(right.column("pair").to_numpy())
        total, best = right.column("total").to_numpy()[order], right.column("best").to_numpy()[order]
        pair, times = (rows.column(c).combine_chunks() for c in ("pair", "times"))
        ends = np.concatenate([[0], np.cumsum(pair.value_lengths().to_numpy())]).astype(np.int64)
        at = _unstep(pair.flatten().to_numpy().astype(np.int32).astype(np.int64), ends)
        n = times.flatten().to_numpy().astype(np.int64)

        def per_row(values: np.ndarray) -> pa.Array:
            running = np.concatenate([[0], np.cumsum(values)])
            return pa.array(running[ends[1:]] - running[ends[:-1]], pa.int64())

        new = {"n_best": per_row(n * best[at]), "count_sum": per_row(n * total[at])}
        return pa.Table.from_arrays([new.get(f.name, rows[f.name] if f.name not in new else None)
                                     for f in kinds], schema=kinds)

    return blocks.select("block", "blob").groupBy("block").cogroup(answers.groupBy("to")).applyInArrow(score, out)
