"""Array column functions (H6-H12, G2). Higher-order functions run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def list_len(arr) -> Column:
    """H6: length."""
    return F.size(_c(arr))


def list_get(arr, index: int) -> Column:
    """H6: 0-based get, negative counts from the end; out of range -> null."""
    if index >= 0:
        return F.get(_c(arr), index)
    return F.try_element_at(_c(arr), F.lit(index))


def list_head(arr, n) -> Column:
    """H7: first n elements (fewer if short)."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.slice(_c(arr), F.lit(1), F.greatest(n, F.lit(0)))


def list_tail(arr, n) -> Column:
    """H7: last n elements (fewer if short)."""
    a = _c(arr)
    n = n if isinstance(n, Column) else F.lit(n)
    k = F.least(n, F.size(a))
    return F.when(k <= 0, F.slice(a, 1, 0)).otherwise(F.slice(a, -k, k))


def concat_scalar(arr, *scalars) -> Column:
    """H8: append scalars to an array."""
    return F.concat(_c(arr), F.array(*[_c(s) if isinstance(s, (Column, str)) else F.lit(s)
                                        for s in scalars]))


def pad_right(arr, length: int, pad: int = 0) -> Column:
    """H9: right-pad with ``pad`` to ``length`` (longer arrays are truncated)."""
    a = _c(arr)
    fill = F.array_repeat(F.lit(pad), F.greatest(F.lit(length) - F.size(a), F.lit(0)))
    return F.slice(F.concat(a, fill), 1, length)


def pad_left(arr, length: int, pad: int = 0) -> Column:
    """H9: keep the last ``length`` elements, left-padded with ``pad``."""
    a = _c(arr)
    fill = F.array_repeat(F.lit(pad), F.lit(length))
    return F.slice(F.concat(fill, a), -length, length)


def padding_mask(arr, pad: int = 0) -> Column:
    """True where the position holds a real item."""
    return F.transform(_c(arr), lambda x: x != F.lit(pad))


def to_padded(values, length: int, pad: int = 0) -> Column:
    """Jagged row -> fixed length: right-pad or truncate."""
    return pad_right(values, length, pad)


def list_difference(a, b) -> Column:
    """Elements of ``a`` not in ``b``, first occurrences, order kept."""
    return F.array_except(_c(a), _c(b))
