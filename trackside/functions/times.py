"""Feed time handling: epoch-millisecond text -> instant -> London wall clock.

The feed carries times as epoch milliseconds in text.  The stored instant is
a TIMESTAMP; London values are derived from it with ``from_utc_timestamp``,
which is exact across both daylight-saving changes when the session zone is
UTC (see ``trackside.session``).  The instant stays the truth: in the
repeated autumn hour two different instants share a London wall clock, and
the ISO text tells them apart by its offset.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trackside.schema import LONDON


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The instants a TIMESTAMP can name: years 1 to 9999, a day short at either end
# so that the London wall clock stays inside as well.
MIN_MS, MAX_MS = -62_135_510_400_000, 253_402_214_399_999


def valid_ms(ms) -> Column:
    """Epoch milliseconds (text or number) -> BIGINT; bad text or a time out of range -> NULL."""
    n = _try_bigint(ms)
    return F.when(n.between(MIN_MS, MAX_MS), n)


def ms_to_ts(ms) -> Column:
    """Epoch milliseconds (text or number) -> TIMESTAMP; bad text or out of range -> NULL."""
    return F.timestamp_millis(valid_ms(ms))


def _try_bigint(c) -> Column:
    c = _c(c)
    return c.try_cast("bigint")


def ts_to_ms(ts) -> Column:
    """TIMESTAMP -> epoch milliseconds (truncating sub-millisecond digits)."""
    return F.unix_millis(_c(ts))


def epoch_seconds(ms) -> Column:
    """Epoch milliseconds -> epoch seconds as DOUBLE (the ``timestamp`` column)."""
    return _try_bigint(ms) / F.lit(1000.0)


def to_london(ts, tz: str = LONDON) -> Column:
    """Instant -> London wall clock (a TIMESTAMP holding local time)."""
    return F.from_utc_timestamp(_c(ts), tz)


def london_date(ts, tz: str = LONDON) -> Column:
    """London calendar date of an instant (the lake and table partition)."""
    return F.to_date(to_london(ts, tz))


def iso_london(ts, tz: str = LONDON) -> Column:
    """ISO-8601 London text with offset, e.g. ``2024-07-01T00:30:00+01:00``.

    Fractional seconds are printed as six digits only when non-zero; the
    offset is the difference between the London wall clock and UTC, so it is
    right on both sides of each clock change.
    """
    ts = _c(ts)
    local = to_london(ts, tz)
    offset = F.unix_seconds(local) - F.unix_seconds(ts)
    absoff = F.abs(offset)
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    frac = F.when(micros == 0, F.lit("")).otherwise(
        F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0")))
    sign = F.when(offset < 0, F.lit("-")).otherwise(F.lit("+"))
    return F.when(ts.isNotNull(), F.concat(
        F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), frac, sign,
        F.lpad((absoff / 3600).cast("int").cast("string"), 2, "0"), F.lit(":"),
        F.lpad(((absoff % 3600) / 60).cast("int").cast("string"), 2, "0")))


def partition_keys(ts, tz: str = LONDON) -> list[Column]:
    """Lake partition keys from the London date: year, month (2 digits), day (2 digits)."""
    local = to_london(ts, tz)
    return [F.year(local).alias("year"),
            F.lpad(F.month(local).cast("string"), 2, "0").alias("month"),
            F.lpad(F.dayofmonth(local).cast("string"), 2, "0").alias("day")]


def object_name(ts, toc, tz: str = LONDON) -> Column:
    """Lake object name ``yyyyMMdd-HHmmss-<toc>.json`` (a null code prints ``None``)."""
    return F.concat(F.date_format(to_london(ts, tz), "yyyyMMdd-HHmmss"), F.lit("-"),
                    F.coalesce(_c(toc), F.lit("None")), F.lit(".json"))
