"""Scalar column functions for feature cleaning and losses (B3-B6, B9, H1-H4,
H13, H14). All are built-in Spark expressions, so they stay inside
whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values from the reference's feature rules.
UNKNOWN = "unknown"
FIRST_DECADE = 1900          # earliest decade bucket
LAST_DECADE = 2020           # latest decade bucket ("2020s")
OUTLIER_LIMIT = 2000.0       # continuous values above this are outliers


def _c(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def parse_year(col) -> Column:
    """H1: a 4-digit year string -> int, anything else -> null (non-strict)."""
    c = F.trim(_c(col).cast("string"))
    return F.when(c.rlike("^[0-9]{4}$"), c.try_cast("int"))


def decade_of(col, calendar: bool = False) -> Column:
    """Year string -> decade label such as ``"1990s"``.

    Default follows the reference's rule: buckets are inclusive at both ends
    and the first match wins, so 1910 -> "1900s" and 2000 -> "1990s"; only
    1900 starts its own bucket. Years outside 1900..2030, or values that are
    not 4 digits, give ``"unknown"``. ``calendar=True`` gives true decades
    (1900..2029).
    """
    y = parse_year(col)
    if calendar:
        start = F.floor(y / 10) * 10
        ok = y.between(FIRST_DECADE, LAST_DECADE + 9)
    else:
        start = F.greatest(F.lit(FIRST_DECADE), F.floor((y - 1) / 10) * 10)
        ok = y.between(FIRST_DECADE, LAST_DECADE + 10)
    label = F.concat(start.cast("int").cast("string"), F.lit("s"))
    return F.when(y.isNotNull() & ok, label).otherwise(F.lit(UNKNOWN))


def blank_to_unknown(col) -> Column:
    """B4: "" (or null) -> "unknown"."""
    c = _c(col)
    return F.when(c.isNull() | (c == ""), F.lit(UNKNOWN)).otherwise(c)


def impute_blank(col, value, dtype: str = "float") -> Column:
    """blank/null/unparsable string -> ``value``, then cast to ``dtype``."""
    c = _c(col)
    parsed = F.when(c != "", c.try_cast(dtype))
    return F.coalesce(parsed, _c(value).cast(dtype) if isinstance(value, Column)
                      else F.lit(value).cast(dtype))


def clip_outlier_to(col, limit, value) -> Column:
    """Values above ``limit`` are replaced by ``value``."""
    c = _c(col)
    v = value if isinstance(value, Column) else F.lit(value)
    return F.when(c > F.lit(limit), v).otherwise(c)


def fill_null(col, value) -> Column:
    """Null -> default."""
    return F.coalesce(_c(col), value if isinstance(value, Column) else F.lit(value))


def sigmoid(logit) -> Column:
    z = _c(logit).cast("double")
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def logistic_loss(logit, label) -> Column:
    """Numerically stable sigmoid cross-entropy on a logit."""
    z = _c(logit).cast("double")
    y = _c(label).cast("double")
    return F.greatest(z, F.lit(0.0)) - z * y + F.log1p(F.exp(-F.abs(z)))


def dcg_discount(rank) -> Column:
    """1 / log2(rank + 1) for a 1-based rank."""
    return F.lit(1.0) / F.log2(_c(rank).cast("double") + F.lit(1.0))
