"""Sort, limit and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def order_by(df: DataFrame, col: str, desc: bool = True, tiebreak=()) -> DataFrame:
    """global sort (a range shuffle); ties broken by ``tiebreak``."""
    first = F.desc(col) if desc else F.asc(col)
    return df.orderBy(first, *tiebreak)


def head_per_group(df: DataFrame, key: str, order, n, tail: bool = False,
                   name: str = "_hp_rn") -> DataFrame:
    """first (or last) ``n`` rows of each group in ``order``; ``n`` may be
    a Column (for example ``ceil(size * 0.8)``)."""
    order = [order] if isinstance(order, str) else list(order)
    if tail:
        order = [F.col(c).desc() if isinstance(c, str) else c.desc() for c in order]
    w = Window.partitionBy(key).orderBy(*order)
    limit = n if not isinstance(n, int) else F.lit(n)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= limit).drop(name)


def topk_candidates(df: DataFrame, row_key, k: int, score: str = "score",
                    pos: str = "position", rank: str = "rank") -> DataFrame:
    """rank candidates of each row by score (desc; ties by position) and
    keep the top ``k``. Groups are candidate lists (bounded length)."""
    keys = [row_key] if isinstance(row_key, str) else list(row_key)
    w = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(pos))
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)
