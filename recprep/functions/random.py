"""Reproducible randomness.

``rand(seed)`` depends on how rows fall into partitions, so a re-run on a
different cluster, or a retried task, could draw other numbers. Instead every
random value here is a pure function of the row's keys: the first 52 bits of
``md5(seed|key1|key2|...)`` divided by 2^52, which a double holds exactly, so
``floor(u * total)`` reaches every position up to 2^52. The same expression can be written
in any SQL engine, which gives sampled operators an exact oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_52 = 4503599627370496.0


def _as_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def uniform(seed: int, *keys) -> Column:
    """U[0, 1) as a deterministic function of ``seed`` and the key columns.

    Keys are column names, Columns, or Python ints (literals). They are
    rendered as decimal strings and joined with ``|`` before hashing, so only
    integer or string keys give engine-independent values.
    """
    parts = [F.lit(str(seed))]
    for k in keys:
        if isinstance(k, int):
            parts.append(F.lit(str(k)))
        else:
            parts.append(_as_col(k).cast("string"))
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(TWO_POW_52)


def uniform_sql(seed: int, *keys: str) -> str:
    """The same draw as SQL text (DuckDB / Spark SQL), for oracles."""
    inner = " || '|' || ".join([f"'{seed}'"] + [f"CAST({k} AS VARCHAR)" for k in keys])
    return f"(CAST('0x' || substr(md5({inner}), 1, 13) AS BIGINT) / 4503599627370496.0)"
