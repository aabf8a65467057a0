"""Operator 4: byte-level BPE encoding and decoding with a merge automaton.

The merges are compiled, in rank order, into a deterministic automaton over
token labels. It starts with one state that loops on all 256 byte tokens. The
gadget of merge ``(u, v) -> uv`` forbids ``v`` after ``u``: the state that
``u`` leads to is split, the copy loses its ``v`` arc and now receives all
``u`` arcs, and every state with a ``u`` arc gets a ``uv`` arc to where ``v``
led. All arcs with the same label lead to one state, so the whole table is
three integers per state (what it was copied from, the label it lost, when it
was made) and three per token (its two parts, the state it leads to); whether
a state has an arc follows from them. A word has exactly one accepted token
path, and that path is what the merges give.

Text is split into words by the public GPT-style pattern, words are encoded
by table-driven transitions (longest arc first, dead ends remembered), and
decoding emits the arc labels.
"""

from __future__ import annotations

import json
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from recprep.llm.common import append_columns

#: Fixed value: the pattern that splits text before the merges.
SPLIT_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

#: answers about arcs remembered per Python worker: two to this power
ARC_BITS = 21

#: bytes of chunks and their ids remembered per Python worker (about), what one
#: entry takes besides, and the longest chunk that is remembered
MEMO_BYTES = 96 << 20
ENTRY_BYTES = 140
LONGEST_CHUNK = 100


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files:
    printable Latin-1 bytes stand for themselves, the rest for 256, 257, ..."""
    keep = [b for lo, hi in ((33, 126), (161, 172), (174, 255)) for b in range(lo, hi + 1)]
    out = {chr(b): b for b in keep}
    rest = [b for b in range(256) if b not in set(keep)]
    out.update({chr(256 + i): b for i, b in enumerate(rest)})
    return out


class MergeAutomaton:
    """The compiled automaton. ``specials`` are strings matched in the raw
    text before anything else."""

    def __init__(self, label: dict[bytes, int], merges: list[tuple[bytes, bytes]],
                 specials: dict[str, int] | None = None):
        size = 1 + max([*label.values(), *(specials or {}).values(), 0])
        self.labels: list[bytes] = [b""] * size
        for b, i in label.items():
            self.labels[i] = b
        for s, i in (specials or {}).items():
            self.labels[i] = s.encode("utf-8")
        self.specials = dict(specials or {})
        self.left = [-1] * size
        self.born = [-2] * size              # -2: no arc has this label
        self.leads = [0] * size              # token -> state
        self.base, self.lost, self.made = [-1], [-1], [-1]
        self.arc: dict[bytes, int] = {}
        for b in range(256):
            t = label.get(bytes([b]))
            if t is not None:
                self.born[t] = -1
                self.arc[bytes([b])] = t
        for rank, (a, b) in enumerate(merges):
            self._gadget(rank, label[a], label[b], label[a + b])
        self.longest = max(map(len, self.arc), default=1)

    def _gadget(self, rank: int, u: int, v: int, uv: int) -> None:
        if self.born[u] == -2 or self.born[v] == -2 or self.born[uv] != -2:
            return
        old, after_v = self.leads[u], self.leads[v]
        if not self.has_arc(old, v):
            return                            # v never follows u: nothing to merge
        self.base.append(old)
        self.lost.append(v)
        self.made.append(rank)
        self.leads[u] = len(self.base) - 1
        self.leads[uv], self.left[uv], self.born[uv] = after_v, u, rank
        self.arc[self.labels[uv]] = uv

    def has_arc(self, state: int, token: int) -> bool:
        """Whether ``state`` has an arc labelled ``token``."""
        base, lost, made, left, born = self.base, self.lost, self.made, self.left, self.born
        when = born[token]
        while True:
            if made[state] <= when:           # the arc was added to this very state
                if when < 0:
                    return True
                token = left[token]
                when = born[token]
            elif lost[state] == token:
                return False
            else:
                state = base[state]


def load_automaton(tokenizer_json: str) -> MergeAutomaton:
    """Compile the text of a ``tokenizer.json`` file (byte-level BPE)."""
    spec = json.loads(tokenizer_json)
    model = spec["model"]
    if model["type"] != "BPE" or model.get("byte_fallback") or model.get("ignore_merges"):
        raise ValueError("only plain byte-level BPE models are supported")
    alpha = byte_alphabet()
    specials = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}

    def raw(piece: str) -> bytes:
        return bytes(alpha[c] for c in piece)

    label = {raw(p): i for p, i in model["vocab"].items()
             if p not in specials and all(c in alpha for c in p)}
    merges = [tuple(map(raw, m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    return MergeAutomaton(label, merges, specials)


class Encoder:
    """Encodes texts with an automaton, many words at a time.

    Every prefix of a word has exactly one accepted path, so one pass from
    left to right over table transitions finds the state at each byte. Words
    already encoded are remembered, about MEMO_BYTES of them, long ones never.
    """

    def __init__(self, auto: MergeAutomaton):
        import regex

        self.auto = auto
        self.split = regex.compile(SPLIT_PATTERN).findall
        self.odd_space = re.compile(r" \s|\s ").search
        names = sorted(auto.specials, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        #: chunk between single spaces -> packed ids of the chunk after a space
        self.chunks: dict[str, bytes] = {}
        self.held, self.long = 0, []         # bytes remembered; chunks to forget after this call
        self.leads = np.array(auto.leads, dtype=np.int64)
        self.size = np.array([len(b) for b in auto.labels], dtype=np.int64)
        # prefix tree of the labels: rows of 256 children, nodes without children last
        child: dict[int, int] = {}
        token = [-1]
        for label, t in auto.arc.items():
            node = 0
            for c in label:
                nxt = child.get(node << 8 | c)
                if nxt is None:
                    nxt = child[node << 8 | c] = len(token)
                    token.append(-1)
                node = nxt
            token[node] = t
        inner = sorted({k >> 8 for k in child} | {0})
        rank = {n: i for i, n in enumerate(inner)}
        for n in range(len(token)):
            rank.setdefault(n, len(rank))
        self.inner = len(inner)
        self.tree = np.full((self.inner, 256), -1, dtype=np.int32)
        for k, n in child.items():
            self.tree[rank[k >> 8], k & 255] = rank[n]
        self.token = np.full(len(token), -1, dtype=np.int32)
        for n, i in rank.items():
            self.token[i] = token[n]
        # direct-mapped memory of has_arc: (state << 20 | token) -> answer
        self.keys = np.full(1 << ARC_BITS, -1, dtype=np.int64)
        self.answers = np.zeros(1 << ARC_BITS, dtype=bool)

    def _has_arcs(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        key = state << 20 | token
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                >> np.uint64(64 - ARC_BITS)).astype(np.int64)
        ok = self.answers[slot]
        wrong = np.flatnonzero(self.keys[slot] != key)
        if len(wrong):
            new, back = np.unique(key[wrong], return_inverse=True)
            got = np.fromiter((self.auto.has_arc(k >> 20, k & 0xFFFFF) for k in new.tolist()),
                              dtype=bool, count=len(new))
            ok[wrong] = got[back]
            self.keys[slot[wrong]] = key[wrong]
            self.answers[slot[wrong]] = ok[wrong]
        return ok

    def words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as little-endian unsigned 32-bit."""
        out: list = [b""] * len(words)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        low = 0
        for top in (4, 8, 12, 16, 24, 32, 48, 64):
            rows = np.flatnonzero((lengths > low) & (lengths <= top))
            low = top
            for k in range(0, len(rows), 1 << 16):
                part = rows[k:k + (1 << 16)]
                for i, ids in zip(part.tolist(), self._block([words[i] for i in part], top)):
                    out[i] = ids
        for i in np.flatnonzero(lengths > low).tolist():
            out[i] = self._long(words[i])
        return out

    def _block(self, words: list[bytes], width: int) -> list[bytes]:
        """Words of at most ``width`` bytes, side by side."""
        n = len(words)
        b = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8)
        b = b.reshape(n, width)
        length = np.fromiter(map(len, words), dtype=np.int64, count=n)
        state = np.zeros((n, width + 1), dtype=np.int64)
        last = np.full((n, width + 1), -1, dtype=np.int64)
        for i in range(width):
            rows = np.flatnonzero(length > i)
            node = np.zeros(len(rows), dtype=np.int32)
            for j in range(i, width):
                node = self.tree[node, b[rows, j]]
                on = node >= 0
                if j >= i:
                    on &= length[rows] > j
                rows, node = rows[on], node[on]
                t = self.token[node].astype(np.int64)
                hit = t >= 0
                r, t = rows[hit], t[hit]
                ok = self._has_arcs(state[r, i], t)
                r, t = r[ok], t[ok]
                last[r, j + 1] = t
                state[r, j + 1] = self.leads[t]
                on = node < self.inner
                rows, node = rows[on], node[on]
                if not len(rows):
                    break
        # walk back from the end; columns come out last token first
        columns, pos, every = [], length.copy(), np.arange(n)
        while pos.any():
            t = last[every, pos]
            if (t[pos > 0] < 0).any():
                raise ValueError("the vocabulary lacks a byte of this text")
            t = np.where(pos > 0, t, -1)
            columns.append(t)
            pos = pos - np.where(t >= 0, self.size[t], 0)
        grid = np.stack(columns[::-1], axis=1)
        taken = grid >= 0
        ends = (4 * np.cumsum(taken.sum(axis=1))).tolist()
        flat = grid[taken].astype("<u4").tobytes()
        return [flat[a:e] for a, e in zip([0] + ends[:-1], ends)]

    def _long(self, b: bytes) -> bytes:
        """One long word, byte by byte: work and memory grow with its length."""
        auto, tree, token, inner = self.auto, self.tree, self.token, self.inner
        n = len(b)
        state, last = [0] * (n + 1), [-1] * (n + 1)
        known: dict[int, bool] = {}
        for i in range(n):
            node, at = 0, state[i]
            if i and last[i] < 0:
                raise ValueError("the vocabulary lacks a byte of this text")
            for j in range(i, n):
                node = tree.item(node, b[j])
                if node < 0:
                    break
                t = token.item(node)
                if t >= 0:
                    ok = known.get(at << 20 | t)
                    if ok is None:
                        ok = known[at << 20 | t] = auto.has_arc(at, t)
                    if ok:
                        last[j + 1], state[j + 1] = t, auto.leads[t]
                if node >= inner:
                    break
        path, pos = [], n
        while pos:
            path.append(last[pos])
            pos -= len(auto.labels[last[pos]])
        return struct.pack(f"<{len(path)}I", *path[::-1])

    def _pieces(self, text: str) -> tuple[list[str], list[str]]:
        """A plain text as (words before the first single space, chunks after
        it); all words and no chunks if spaces stand together."""
        if not text:
            return [], []
        if self.odd_space(text) or text[0] == " " or text[-1] == " ":
            return self.split(text), []
        first, _, rest = text.partition(" ")
        return self.split(first), rest.split(" ") if rest else []

    def _learn(self, chunks: set[str], words: set[str]) -> dict[str, bytes]:
        """Encode new chunks into the memory; return the other words' ids."""
        letters, ended, odd = [], [], {}
        for c in chunks:
            if c.isalpha():
                letters.append(c)
            elif c[-1] in ".,;:!?" and c[:-1].isalpha():
                ended.append(c)
            else:
                odd[c] = self.split(" " + c)
        known = self.chunks
        stems = {c[:-1] for c in ended}.difference(letters, known)
        letters += stems
        others = list(words.union(".,;:!?", *odd.values()))
        ids = self.words([(" " + c).encode("utf-8") for c in letters] + [w.encode("utf-8") for w in others])
        known.update(zip(letters, ids))
        alone = dict(zip(others, ids[len(letters):]))
        known.update([(c, known[c[:-1]] + alone[c[-1]]) for c in ended])
        known.update([(c, b"".join([alone[w] for w in p])) for c, p in odd.items()])
        new = [*letters, *ended, *odd]
        self.long = [c for c in new if len(c) > LONGEST_CHUNK]
        self.held += sum(ENTRY_BYTES + len(c) + len(known[c]) for c in new if len(c) <= LONGEST_CHUNK)
        return alone

    def __call__(self, texts: list[str]) -> list[bytes]:
        """All ids of each text as little-endian unsigned 32-bit integers."""
        plan, chunks, words = [], set(), set()
        for text in texts:
            sections = []
            found = self.special.split(text) if self.special is not None else [text]
            for i, part in enumerate(found):
                if i % 2:
                    sections.append(struct.pack("<I", self.auto.specials[part]))
                else:
                    got = self._pieces(part)
                    words.update(got[0])
                    chunks.update(got[1])
                    sections.append(got)
            plan.append(sections)
        if self.held > MEMO_BYTES:
            self.chunks = {c: self.chunks[c] for c in chunks if c in self.chunks}
            self.held = sum(ENTRY_BYTES + len(c) + len(i) for c, i in self.chunks.items())
        alone = self._learn({c for c in chunks if c not in self.chunks}, words)
        word, chunk, out = alone.__getitem__, self.chunks.__getitem__, []
        for sections in plan:
            out.append(b"".join([s if isinstance(s, bytes) else
                                 b"".join(map(word, s[0])) + b"".join(map(chunk, s[1]))
                                 for s in sections]))
        for c in self.long:
            self.chunks.pop(c, None)
        return out


_CACHE: dict[int, tuple] = {}


def worker_encoder(key: int, auto) -> Encoder:
    """One encoder (with its memory of words) per Python worker and vocabulary."""
    if key not in _CACHE:
        _CACHE.clear()
        _CACHE[key] = Encoder(auto.value)
    return _CACHE[key]


def share_automaton(spark, tokenizer_path: str):
    """The vocabulary's key and its automaton, compiled once on the driver and
    broadcast: the size is bounded by the
    vocabulary file (a few MB), whatever the corpus."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    return zlib.crc32(spec.encode("utf-8")), spark.sparkContext.broadcast(load_automaton(spec))


def id_lists(packed: list[bytes]) -> pa.Array:
    """Packed ids of many texts -> one Arrow array of integer lists."""
    ends = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(
        np.frombuffer(b"".join(packed), dtype="<u4").astype(np.int32)))


def emit_labels(labels: list[bytes], ids: list[int]) -> str:
    """The arc labels of the ids, as text."""
    return b"".join(map(labels.__getitem__, ids)).decode("utf-8", "replace")


def encode(df: DataFrame, tokenizer_path: str, text_col: str = "text", ids_col: str = "ids",
           decoded_col: str | None = None) -> DataFrame:
    """Append ``ids_col`` (array<int>): the token ids of each whole text, and
    with ``decoded_col`` also the text that the ids decode to.

    Null or empty text: an empty list. Special strings of the vocabulary
    found in a text give their id, as the tokenizers library does. Every row
    and other column is kept; equal texts give equal ids.
    """
    key, shared = share_automaton(df.sparkSession, tokenizer_path)

    def make():
        enc = worker_encoder(key, shared)
        labels = enc.auto.labels

        def rows(texts):
            packed = enc([t or "" for t in texts])
            out = [id_lists(packed)]
            if decoded_col:
                out.append([emit_labels(labels, np.frombuffer(p, dtype="<u4").tolist()) for p in packed])
            return out
        return rows

    fields = [T.StructField(ids_col, T.ArrayType(T.IntegerType(), False), False)]
    if decoded_col:
        fields.append(T.StructField(decoded_col, T.StringType(), False))
    return append_columns(df, [text_col], fields, make)


def decode(df: DataFrame, tokenizer_path: str, ids_col: str = "ids",
           text_col: str = "decoded") -> DataFrame:
    """Append ``text_col``: the arc labels of the ids, as text (bytes that are
    not valid UTF-8 become U+FFFD). Null or empty ids: the empty text. Null
    or unknown ids inside a list raise."""
    _, shared = share_automaton(df.sparkSession, tokenizer_path)

    def make():
        labels = shared.value.labels

        def texts(lists: pa.ListArray) -> list:
            ids = lists.flatten().to_numpy(zero_copy_only=False).tolist()
            out, at = [], 0
            for n in lists.value_lengths().fill_null(0).to_pylist():
                out.append(emit_labels(labels, ids[at:at + n]))
                at += n
            return [out]
        return texts

    return append_columns(df, [ids_col], [T.StructField(text_col, T.StringType(), False)], make,
                          raw=True)
