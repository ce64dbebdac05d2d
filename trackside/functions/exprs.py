"""Metric expressions shared by the analytics queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trackside.schema import TOC_NAMES, UNKNOWN_COMPANY


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def count_when(cond: Column) -> Column:
    """COUNT(CASE WHEN cond THEN 1 END): a NULL condition is not counted."""
    return F.count_if(cond)


def round_half_away(x, digits: int) -> Column:
    """ROUND(x, digits) on the binary DOUBLE value, halves away from zero.

    Spark's ``round`` on a DOUBLE rounds its shortest decimal text, so
    1.005 -> 1.01, while SQL warehouses scale the binary value first
    (1.005 * 100 = 100.49999...) and get 1.0.  Scaling first and rounding to
    an integer makes both agree: Spark's integer rounding of a double is
    exact on which side of .5 it lies.
    """
    x = _c(x)
    if digits == 0:
        return F.round(x, 0)
    scale = float(10 ** digits)
    return F.round(x * F.lit(scale), 0) / F.lit(scale)


def pct(num, den, digits: int = 2) -> Column:
    """ROUND(num * 100 / den, 2) in DOUBLE; NULL when den is 0 or NULL."""
    return round_half_away(F.try_divide(_c(num) * F.lit(100.0), _c(den)), digits)


def delay_ms(actual_ts="actual_timestamp", planned_ms="planned_timestamp") -> Column:
    """Actual minus planned time in milliseconds (planned is epoch-ms text); NULL on overflow."""
    return F.try_subtract(F.unix_millis(_c(actual_ts)), _c(planned_ms).try_cast("bigint"))


def delay_minutes(actual_ts="actual_timestamp", planned_ms="planned_timestamp") -> Column:
    """Delay in minutes as DOUBLE (negative = early)."""
    return delay_ms(actual_ts, planned_ms) / F.lit(60000.0)


def toc_name(code="toc_id") -> Column:
    """Operating-company name from its code; other codes and NULL -> Unknown.

    A CASE chain stays inside whole-stage codegen and needs no join; the map
    is data (``schema.TOC_NAMES``) so adding a company is a one-line change.
    """
    code = _c(code)
    expr = None
    for k, name in TOC_NAMES.items():
        expr = (F.when(code == k, F.lit(name)) if expr is None
                else expr.when(code == k, F.lit(name)))
    return expr.otherwise(F.lit(UNKNOWN_COMPANY))
