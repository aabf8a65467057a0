"""Operator 2: packing examples into sequences by vector bin packing.

An example is a vector of three demands: tokens, segments (one per piece) and
loss-bearing tokens. A sequence is a bin with one limit for each. Among the
waiting examples that fit, the open sequence takes the one with the largest
dot product of its demands with what the sequence has left (both as fractions
of the limits), which prefers examples whose shape matches the free space.

Examples longer than a sequence are cut into full sequences first; what is
left, and no more of it, waits in a window of WINDOW examples. Where cutting is allowed, a
sequence that no waiting example fits is filled up with the front of the
largest one, so padding is left only in the last sequence of a task and where
the segment or loss limit stops a sequence.

Every task packs its own rows: no shuffle, no state beyond one window, and a
lost task is packed again in the same way.
"""

from __future__ import annotations

import json
import zlib
from dataclasses import dataclass
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from recprep.llm.bpe import SPLIT_PATTERN, byte_alphabet
from recprep.llm.common import slices
from recprep.session import ship_package

#: examples that wait at most while a task packs
WINDOW = 1024
#: sequences that one task may number
SEQUENCES_PER_TASK = 1 << 33


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold at most."""
    tokens: int = 1024
    segments: int = 256
    loss_tokens: int = 1024


class Packer:
    """Places examples as they come. ``emit(key, start, length, sequence,
    offset)`` is called once for every piece. What waits is ``trim(key, start,
    length)`` in place of the key, so that of a long example only the part that
    waits is held."""

    def __init__(self, limits: Limits, emit: Callable, cut: bool = True, window: int = WINDOW,
                 trim: Callable = lambda key, start, length: key):
        self.top, self.emit, self.cut, self.window, self.trim = limits, emit, cut, window, trim
        self.next_sequence = 0
        self.waiting: list = [None] * window          # (key, start, running loss from ``first`` or None, first)
        self.tokens = np.zeros(window, dtype=np.int64)
        self.loss = np.zeros(window, dtype=np.int64)
        self.free = list(range(window - 1, -1, -1))
        self._open()

    def _open(self) -> None:
        self.sequence, self.used, self.segments, self.lossy = None, 0, 0, 0

    def _number(self) -> int:
        self.next_sequence += 1
        return self.next_sequence - 1

    @staticmethod
    def _loss_of(running, start: int, length: int) -> int:
        return length if running is None else int(running[start + length] - running[start])

    @staticmethod
    def _front(running, start: int, tokens: int, loss: int) -> int:
        """The longest front of at most ``tokens`` with at most ``loss``."""
        if running is None:
            return min(tokens, loss)
        most = int(np.searchsorted(running, running[start] + loss, side="right")) - 1 - start
        return min(tokens, most)

    def add(self, key, length: int, running=None) -> None:
        """One example of ``length`` tokens; ``running[i]`` counts the
        loss-bearing ones among its first i (None: all are)."""
        top, start = self.top, 0
        if not self.cut and (length > top.tokens
                             or self._loss_of(running, 0, length) > top.loss_tokens):
            raise ValueError("an example exceeds the limits of a sequence and may not be cut")
        while True:
            take = self._front(running, start, min(length - start, top.tokens), top.loss_tokens)
            if take == top.tokens:                    # fills a sequence alone
                self.emit(key, start, take, self._number(), 0)
            elif take or length == 0:
                self._wait(key, start, take, running)
            else:
                raise ValueError("a single token exceeds the limits of a sequence")
            start += take
            if start >= length:
                return

    def _wait(self, key, start: int, length: int, running) -> None:
        while not self.free:
            self._step()
        i = self.free.pop()
        self.tokens[i], self.loss[i] = length, self._loss_of(running, start, length)
        if running is not None:
            running = running[start:start + length + 1].copy()
        self.waiting[i] = (self.trim(key, start, length), start, running, start)

    def _step(self) -> None:
        """Put one waiting example, or a front of it, into the open sequence."""
        top = self.top
        left, left_loss = top.tokens - self.used, top.loss_tokens - self.lossy
        held = np.ones(self.window, dtype=bool)
        held[self.free] = False
        fits = held & (self.tokens <= left) & (self.loss <= left_loss)
        # the segment demand is 1 / limit for every example and decides nothing
        score = (self.tokens * (left / top.tokens ** 2)
                 + self.loss * (left_loss / top.loss_tokens ** 2))
        i = int(np.argmax(np.where(fits, score, -1.0)))
        if fits[i]:
            self._place(i, int(self.tokens[i]))
        elif self.cut:
            i = int(np.argmax(np.where(held, self.tokens, -1)))
            _, start, running, first = self.waiting[i]
            take = self._front(running, start - first, min(left, int(self.tokens[i])), left_loss)
            if take > 0:
                self._place(i, take)
            self._open()
        else:
            self._open()
        if self.used == top.tokens or self.segments == top.segments:
            self._open()

    def _place(self, i: int, take: int) -> None:
        key, start, running, first = self.waiting[i]
        if self.sequence is None:
            self.sequence = self._number()
        self.emit(key, start, take, self.sequence, self.used)
        loss = self._loss_of(running, start - first, take)
        self.used, self.segments, self.lossy = self.used + take, self.segments + 1, self.lossy + loss
        if take == self.tokens[i]:
            self.waiting[i] = None
            self.free.append(i)
        else:
            self.waiting[i] = (key, start + take, running, first)
            self.tokens[i] -= take
            self.loss[i] -= loss

    def flush(self) -> None:
        while len(self.free) < self.window:
            self._step()


PIECE_FIELDS = [("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType()),
                ("doc_tokens", T.LongType()), ("sequence_id", T.LongType()),
                ("offset", T.LongType()), ("loss_tokens", T.LongType())]


def pack(df: DataFrame, key_cols: list[str], input_cols: list[str],
         make: Callable[[], Callable[..., list]], limits: Limits = Limits(),
         cut: bool = True) -> DataFrame:
    """One row per piece: the key columns and PIECE_FIELDS.

    ``make()`` runs once per task and returns a function from the input
    columns (lists) to a list of (ids as uint32 array, loss flags or None), one
    per row. ``offset`` is gapless from 0 in each ``sequence_id``; sequence ids
    are unique over the whole result. A row without ids gives one empty piece.
    Key columns may hold anything, repeats and nulls included; a key column
    named like a piece field is replaced. An empty table gives no rows.
    """
    ship_package(df.sparkSession)
    names = {n for n, _ in PIECE_FIELDS}
    keys = [c for c in key_cols if c not in names]
    src = df.select(*[df[c] for c in keys], *[df[c].alias(f"__in_{i}")
                                              for i, c in enumerate(input_cols)])
    ins = [f"__in_{i}" for i in range(len(input_cols))]
    out = T.StructType([src.schema[c] for c in keys] + [T.StructField(n, t) for n, t in PIECE_FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() * SEQUENCES_PER_TASK
        fn = make()
        rows: list[tuple] = []
        key_types = []

        def emit(key, start, length, sequence, offset):
            k, ids, flags, base, total = key          # the ids from ``base`` on, of ``total``
            span = slice(start - base, start - base + length)
            rows.append((k, start, length, zlib.crc32(ids[span]), total, first + sequence, offset,
                         length if flags is None else int(flags[span].sum())))

        def trim(key, start, length):
            k, ids, flags, base, total = key
            span = slice(start - base, start - base + length)
            return k, ids[span].copy(), None if flags is None else flags[span].copy(), start, total

        packer = Packer(limits, emit, cut, trim=trim)

        def drain():
            arrays = [pa.array([r[0][j] for r in rows], type=t) for j, t in enumerate(key_types)]
            arrays += [pa.array([r[j] for r in rows], type=pa.int64()) for j in range(1, 8)]
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, names=out.names)

        for whole in batches:
            key_types = [whole.schema.field(c).type for c in keys]
            for b in slices(whole, ins):
                k = list(zip(*[b.column(i).to_pylist() for i in range(len(keys))])) or [()] * b.num_rows
                values = fn(*[b.column(b.schema.get_field_index(c)).to_pylist() for c in ins])
                for key, (ids, flags) in zip(k, values):
                    running = None
                    if flags is not None:
                        flags = np.asarray(flags, dtype=np.int64)
                        running = np.concatenate([[0], np.cumsum(flags)])
                    packer.add((key, np.ascontiguousarray(ids, dtype="<u4"), flags, 0, len(ids)), len(ids), running)
                if rows:
                    yield drain()
        packer.flush()
        if rows:
            yield drain()

    return src.mapInArrow(run, out)


def pack_examples(df: DataFrame, key_cols: list[str], ids_col: str = "ids",
                  loss_col: str | None = None, limits: Limits = Limits(),
                  cut: bool = False) -> DataFrame:
    """Pack tokenized instruction data: ``ids_col`` is array<int>, ``loss_col``
    (0/1 per id) marks the loss-bearing tokens. Null ids count as none, a null
    mask as all ones; a mask of another length raises."""
    def make():
        def rows(ids, masks=None):
            out = []
            for i, x in enumerate(ids):
                x = np.array(x or [], dtype="<u4")
                m = masks[i] if masks is not None else None
                if m is not None and len(m) != len(x):
                    raise ValueError("the loss mask and the ids differ in length")
                out.append((x, m))
            return out
        return rows
    return pack(df, key_cols, [ids_col] + ([loss_col] if loss_col else []), make, limits, cut)


def fast_tokenizer(tokenizer_json: str):
    """The byte-level BPE of a ``tokenizer.json`` text as a tiktoken encoding:
    the same ids, special strings included, several times faster."""
    import tiktoken

    spec = json.loads(tokenizer_json)
    alpha = byte_alphabet()
    specials = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
    vocab = {p: i for p, i in spec["model"]["vocab"].items()
             if p not in specials and all(c in alpha for c in p)}
    ranks = {bytes(alpha[c] for c in p): i for p, i in vocab.items()}
    merged = [vocab[a + b] for a, b in (m.split(" ") if isinstance(m, str) else m
                                        for m in spec["model"]["merges"])]
    if any(a >= b for a, b in zip(merged, merged[1:])):
        raise ValueError("ids do not follow the order of the merges")
    return tiktoken.Encoding("packing", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks,
                             special_tokens=specials)


def robust_encoder(tokenizer_json: str) -> Callable[[str], np.ndarray]:
    """Text to ids (uint32) by ``fast_tokenizer``. Its regex engine gives up on
    white-space runs of about a million characters; such a text is encoded by
    the tokenizers library, which has no such limit and gives the same ids."""
    fast, slow = fast_tokenizer(tokenizer_json), []

    def encode(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, allowed_special="all")
        except ValueError as e:
            if "Max stack size exceeded" not in str(e):
                raise
        if not slow:
            import tokenizers
            slow.append(tokenizers.Tokenizer.from_str(tokenizer_json))
        return np.array(slow[0].encode(text, add_special_tokens=False).ids, dtype=np.uint32)
    return encode


_TOKENIZER: dict[int, Callable[[str], np.ndarray]] = {}


def pack_documents(df: DataFrame, tokenizer_path: str, key_col: str = "doc_id",
                   text_col: str = "text", limits: Limits = Limits(segments=Limits.tokens)) -> DataFrame:
    """Tokenize whole texts (null: empty), end each with id 0 and pack them,
    cutting freely: each id lies in exactly one piece. Repeated rows are
    packed each on its own. Unless told otherwise, a sequence takes as many
    texts as it has tokens for."""
    spark = df.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    key = zlib.crc32(spec.encode("utf-8"))
    shared = spark.sparkContext.broadcast(spec)              # a vocabulary file: a few MB

    def make():
        if key not in _TOKENIZER:
            _TOKENIZER.clear()
            _TOKENIZER[key] = robust_encoder(shared.value)
        encode = _TOKENIZER[key]
        end = np.zeros(1, dtype=np.uint32)
        return lambda texts: [(np.concatenate([encode(t or ""), end]), None) for t in texts]

    return pack(df, [key_col], [text_col], make, limits, cut=True)
