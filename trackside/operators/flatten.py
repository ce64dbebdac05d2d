"""Daily-load shaping: flatten the raw body, type the columns, gate and filter.

All per-row: one bad timestamp nulls only its own row (the load then drops
it as incomplete), never the batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackside.functions.times import epoch_seconds, iso_london, london_date, ms_to_ts
from trackside.schema import (FLATTENED_BODY_FIELDS, KEY_COLUMNS, MOVEMENTS_SCHEMA,
                              STAGING_ONLY_FIELDS, TABLE_COLUMNS)


class MissingColumns(ValueError):
    pass


def require_columns(df: DataFrame, columns: list[str]) -> None:
    """Abort (driver-side, no data read) when the input lacks a needed column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumns(f"missing required columns: {missing}")


def flatten(envelopes: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Envelope rows (``raw_data`` map) -> the typed movements columns + ``uk_date``.

    Body values are already text (JSON ``true`` reads as ``"true"``); the
    actual time becomes an instant; envelope fields missing in the bare
    layout are derived from the actual time.
    """
    require_columns(envelopes, ["event_type", "toc_id", "variation_status", "raw_data"])
    raw = F.col("raw_data")
    ms = raw.getItem("actual_timestamp")
    ts = ms_to_ts(ms)

    def top(c, fallback):
        return F.coalesce(F.col(c), fallback) if c in envelopes.columns else fallback

    cols = {
        "event_type": F.coalesce(F.col("event_type"), raw.getItem("event_type")),
        "toc_id": F.coalesce(F.col("toc_id"), raw.getItem("toc_id")),
        "variation_status": F.coalesce(F.col("variation_status"),
                                       raw.getItem("variation_status")),
        "uk_datetime": top("uk_datetime", iso_london(ts)),
        "timestamp": top("timestamp", epoch_seconds(ms)),
        "processed_at": F.col("processed_at") if "processed_at" in envelopes.columns
        else F.lit(None),
        "actual_timestamp": ts,
        "uk_date": london_date(ts),
    }
    for f in FLATTENED_BODY_FIELDS + STAGING_ONLY_FIELDS:
        cols.setdefault(f, raw.getItem(f))
    return envelopes.select(*(keep or []), *[cols[c].cast(MOVEMENTS_SCHEMA[c].dataType).alias(c)
                                             for c in TABLE_COLUMNS])


def complete_rows(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Keep rows whose key columns (train, actual time, operator) are all present."""
    cond = F.lit(True)
    for k in keys or KEY_COLUMNS:
        cond = cond & F.col(k).isNotNull()
    return df.where(cond)
