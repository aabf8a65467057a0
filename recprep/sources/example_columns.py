"""Column-wise decoding of serialized Examples.

The records of a chunk are one byte array with a cursor per record. Records
that list the same features in the same order take the same steps, so a step
(a tag, a length, a name, a value list) is checked for all of them at once and
the cursors move together. A record that doesn't follow the order leaves the
group; the rest are tried with the order of the first one left, and after
MAX_LAYOUTS orders record by record.
"""

from __future__ import annotations

from typing import Callable

import numpy as np
import pyarrow as pa

#: orders of features that a chunk is tried with
MAX_LAYOUTS = 8
#: fewer records than this are decoded one by one
MIN_GROUP = 16

#: wire tags: a length-delimited field 1, 2 and 3
_ONE, _TWO, _THREE = 0x0A, 0x12, 0x1A
_KIND_TAG = {"bytes": _ONE, "float": _TWO, "int": _THREE}
_PAD = 16


class Cursors:
    """A position in ``data`` per record; ``ok`` tells who still follows."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.data, self.at, self.ends = data, starts.copy(), ends
        self.ok = np.ones(len(starts), dtype=bool)
        self.last = len(data) - _PAD

    def _hold(self) -> None:
        # those that left stay inside the array
        np.minimum(self.at, self.last, out=self.at)

    def byte(self, value: int) -> None:
        self.ok &= self.data[self.at] == value
        self.at += 1
        self._hold()

    def varint(self) -> np.ndarray:
        first = self.data[self.at].astype(np.int64)
        out = first & 0x7F
        size = np.ones(len(out), dtype=np.int64)
        more = np.flatnonzero(first >= 0x80)
        shift = 7
        while len(more) and shift < 35:               # lengths, at most five bytes
            b = self.data[np.minimum(self.at[more] + shift // 7, self.last)].astype(np.int64)
            out[more] |= (b & 0x7F) << shift
            size[more] += 1
            more = more[b >= 0x80]
            shift += 7
        self.ok[more] = False
        self.at += size
        self._hold()
        return out

    def literal(self, text: bytes) -> None:
        if text:
            want = np.frombuffer(text, dtype=np.uint8)
            at = np.minimum(self.at[:, None] + np.arange(len(want)), self.last)
            self.ok &= (self.data[at] == want).all(axis=1)
        self.at += len(text)
        self._hold()

    def skip(self, size: np.ndarray) -> None:
        self.at += np.where(self.ok, size, 0)
        self._hold()


def gather(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The byte ranges, one after the other."""
    total = int(size.sum())
    first = np.cumsum(size) - size
    return data[np.repeat(at - first, size) + np.arange(total)]


def varints(body: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """The signed values packed in consecutive ranges of ``size`` bytes, how
    many each range holds, and whether all of them are well formed."""
    if not len(body):
        return np.zeros(0, dtype=np.int64), np.zeros(len(size), dtype=np.int64), True
    stop = body < 0x80
    ends = np.flatnonzero(stop)
    bound = np.cumsum(size)
    full = bound[size > 0] - 1
    if not len(ends) or not stop[full].all():
        return np.zeros(0, dtype=np.int64), np.zeros(len(size), dtype=np.int64), False
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = ends - starts + 1
    if width.max() > 10:
        return np.zeros(0, dtype=np.int64), np.zeros(len(size), dtype=np.int64), False
    place = np.arange(len(body)) - np.repeat(starts, width)
    parts = (body & 0x7F).astype(np.uint64) << (7 * place).astype(np.uint64)
    values = np.bitwise_or.reduceat(parts, starts).view(np.int64)
    seen = np.concatenate([[0], np.cumsum(stop)])
    return values, seen[bound] - seen[bound - size], True


def _layout(payload: bytes, decode: Callable, kinds: dict[str, str]) -> list[tuple[str, str]] | None:
    """(name, kind) of the features in the order of this record; None if it
    holds features whose kind can't be told or differs from the column's."""
    out = []
    for name, kind in decode(payload):
        if name in kinds and kinds[name] != kind:
            return None
        out.append((name, kind))
    return out if len({n for n, _ in out}) == len(out) else None


def _follow(c: Cursors, layout: list[tuple[str, str]], wanted: set[str]) -> dict[str, tuple]:
    """Walk all records along the layout; (start, length) of the value list of
    every wanted feature."""
    found = {}
    c.byte(_ONE)
    size = c.varint()
    c.ok &= c.at + size == c.ends
    for name, kind in layout:
        raw = name.encode()
        c.byte(_ONE)
        size = c.varint()
        entry_end = c.at + size
        c.byte(_ONE)
        c.ok &= c.varint() == len(raw)
        c.literal(raw)
        c.byte(_TWO)
        size = c.varint()
        c.ok &= c.at + size == entry_end
        c.byte(_KIND_TAG[kind])
        size = c.varint()
        c.ok &= c.at + size == entry_end
        # one packed list, or one byte string, which fills the entry
        c.byte(_ONE)
        size = c.varint()
        c.ok &= c.at + size == entry_end
        if name in wanted:
            found[name] = (c.at.copy(), size)
        c.skip(size)
    c.ok &= c.at == c.ends
    return found


def _column(data: np.ndarray, at: np.ndarray, size: np.ndarray, kind: str, as_list: bool,
            target: pa.DataType) -> pa.Array | None:
    """The Arrow column of value lists at these ranges; None if malformed."""
    if kind == "bytes":
        offsets = np.concatenate([[0], np.cumsum(size)])
        if offsets[-1] >= 1 << 31:
            return None
        body = pa.py_buffer(gather(data, at, size).tobytes())
        flat = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets.astype(np.int32)), body])
        counts = np.ones(len(size), dtype=np.int64)
    elif kind == "float":
        if (size % 4).any():
            return None
        flat, counts = pa.array(gather(data, at, size).view("<f4")), size // 4
    else:
        values, counts, fine = varints(gather(data, at, size), size)
        if not fine:
            return None
        flat = pa.array(values)
    inner = target.value_type if as_list else target
    if pa.types.is_boolean(inner) and kind == "int":
        flat = pa.array(flat.to_numpy() != 0)
    else:
        flat = flat.cast(inner)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    if as_list:
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), flat, type=target)
    if (counts == 1).all():
        return flat
    # the first value of each list; an empty list is null
    return flat.take(pa.array(offsets[:-1], mask=counts == 0))


def decode_columns(payloads: list[bytes], schema: pa.Schema, kinds: dict[str, str],
                   order_of: Callable, slow: Callable) -> pa.RecordBatch:
    """The records of a chunk as one batch, rows in the order of the payloads.

    ``kinds``: int, float or bytes per column; ``order_of(payload)`` yields a
    record's (name, kind) pairs; ``slow(payloads)`` decodes records one by one
    into a batch, which is how records of rare layouts are read.
    """
    size = np.fromiter(map(len, payloads), dtype=np.int64, count=len(payloads))
    ends = np.cumsum(size)
    data = np.frombuffer(b"".join(payloads) + bytes(_PAD), dtype=np.uint8)
    left = np.arange(len(payloads))
    batches, order = [], []
    for _ in range(MAX_LAYOUTS):
        if len(left) < MIN_GROUP:
            break
        layout = _layout(payloads[left[0]], order_of, kinds)
        if layout is None:
            break
        c = Cursors(data, ends[left] - size[left], ends[left])
        found = _follow(c, layout, set(schema.names))
        if not c.ok.any():
            break
        columns = []
        for f in schema:
            if f.name not in found:
                columns.append(pa.nulls(int(c.ok.sum()), f.type))
                continue
            at, length = found[f.name]
            columns.append(_column(data, at[c.ok], length[c.ok], kinds[f.name], pa.types.is_list(f.type), f.type))
        if any(x is None for x in columns):
            break
        batches.append(pa.RecordBatch.from_arrays(columns, schema=schema))
        order.append(left[c.ok])
        left = left[~c.ok]
    if len(left):
        batches.append(slow([payloads[i] for i in left]))
        order.append(left)
    if not batches:
        return slow([])
    if len(batches) == 1:
        return batches[0]
    table = pa.Table.from_batches(batches).take(pa.array(np.argsort(np.concatenate(order), kind="stable")))
    return table.combine_chunks().to_batches()[0]
