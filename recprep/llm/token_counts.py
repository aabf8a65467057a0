"""Operator 5: token counts of a unigram tokenizer, without the tokens.

Text is cut before every space (written as the mark U+2581, one put in front
unless there is one). In each word Aho-Corasick enumerates all vocabulary
matches, and dynamic programming over their ends carries the best score and
the number of pieces on that path; no path is kept.

Ties go the tokenizer's way: of equal scores at an end the piece that starts
first wins, because only a greater score replaces one. A character that no
one-character piece matches costs the least score of the vocabulary less
UNKNOWN_PENALTY; neighbouring unknown characters are one unknown piece, which
counts as one token per byte where the vocabulary has byte pieces for them.
"""

from __future__ import annotations

import math
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from recprep.llm.common import append_columns

#: Fixed values of the tokenizer's rules.
MARK = "▁"
UNKNOWN_PENALTY = 10.0

#: words remembered per Python worker
MEMO_ENTRIES = 200_000


def sentencepiece_vocabulary(path: str) -> tuple[list[tuple[str, float]], int]:
    """((piece, score) by id, id of the unknown piece) of a model file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.vocab_size())], sp.unk_id()


class Counter:
    """Counts tokens of words with one vocabulary."""

    def __init__(self, pieces: list[tuple[str, float]], unknown: int | None):
        import ahocorasick

        self.match = ahocorasick.Automaton()
        score: dict[str, float] = {}
        for p, s in pieces:
            if p:
                score[p] = s                          # a repeated piece: the last score
        for p, s in score.items():
            self.match.add_word(p, (len(p), s))
        if score:
            self.match.make_automaton()
        self.single = {p for p in score if len(p) == 1}
        self.unknown = unknown
        self.penalty = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.bytes = {b for b in range(256) if f"<0x{b:02X}>" in score}
        self.memo: dict[str, tuple[int, float]] = {}

    def word(self, w: str) -> tuple[int, float]:
        """(tokens, score) of one word."""
        got = self.memo.get(w)
        if got is None:
            got = self._best(w)
            if len(w) < 100:
                if len(self.memo) >= MEMO_ENTRIES:
                    self.memo.clear()
                self.memo[w] = got
        return got

    def _best(self, w: str) -> tuple[int, float]:
        n = len(w)
        if self.single.issuperset(w):                 # no unknown character: every end is reached
            best, count = [0.0] + [-math.inf] * n, [0] * (n + 1)
            # matches come by end, the longest first: an earlier start wins a tie
            for end, (length, score) in self.match.iter(w):
                v = best[end + 1 - length] + score
                if v > best[end + 1]:
                    best[end + 1], count[end + 1] = v, count[end + 1 - length] + 1
            return count[n], best[n]
        return self._best_with_unknown(w)

    def _best_with_unknown(self, w: str) -> tuple[int, float]:
        n = len(w)
        by_end: dict[int, list] = {}
        if len(self.match):
            for end, hit in self.match.iter(w):
                by_end.setdefault(end, []).append(hit)
        best = [0.0] + [None] * n                     # best score of the text up to here
        count = [0] * (n + 1)                         # tokens on that path
        # unknown characters in a row just before here: (their bytes, all have pieces)
        run: list = [None] * (n + 1)
        for i in range(n):
            end = i + 1
            hits = by_end.get(i, ())
            for length, score in hits:
                start = end - length
                v = best[start] + score
                if best[end] is None or v > best[end]:
                    best[end], count[end], run[end] = v, count[start] + 1, None
            if w[i] not in self.single:
                if self.unknown is None:
                    if best[end] is None:
                        raise ValueError("a character has no piece and there is no unknown piece")
                    continue
                v = best[i] + self.penalty
                if best[end] is None or v > best[end]:
                    raw = w[i].encode("utf-8", "surrogatepass")
                    before = run[i] or (0, True)
                    now = (before[0] + len(raw), before[1] and self.bytes.issuperset(raw))
                    base = count[i] - (self._unknown(before) if run[i] else 0)
                    best[end], run[end] = v, now
                    count[end] = base + self._unknown(now)
        return count[n], best[n]

    @staticmethod
    def _unknown(run: tuple[int, bool]) -> int:
        """Tokens of one unknown piece."""
        return run[0] if run[1] else 1

    def text(self, text: str | None) -> tuple[int, float]:
        """(tokens, score) of a whole text."""
        if not text:
            return 0, 0.0
        t = text.replace(" ", MARK)
        words = t.split(MARK)
        known = self.memo.get
        tokens, score = 0, 0.0
        if not words[0]:
            words = words[1:]                         # the text begins with a mark
        for w in words:
            w = MARK + w
            c, s = known(w) or self.word(w)
            tokens += c
            score += s
        return tokens, score


_CACHE: dict[int, Counter] = {}


def count_tokens(df: DataFrame, pieces: list[tuple[str, float]], unknown: int | None,
                 text_col: str = "text") -> DataFrame:
    """Append ``n_tokens`` and ``best_score`` (the sum over its words) of every
    whole text; null or empty: 0 and 0.0. Every row and other column is kept."""
    key = zlib.crc32(repr((pieces, unknown)).encode("utf-8", "surrogatepass"))
    shared = df.sparkSession.sparkContext.broadcast((pieces, unknown))   # a vocabulary: a few MB

    def make():
        if key not in _CACHE:
            _CACHE.clear()
            _CACHE[key] = Counter(*shared.value)
        count = _CACHE[key].text

        def rows(texts):
            got = list(map(count, texts))
            return [pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.float64())]
        return rows

    return append_columns(df, [text_col], [T.StructField("n_tokens", T.LongType(), False),
                                           T.StructField("best_score", T.DoubleType(), False)], make)
