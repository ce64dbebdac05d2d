"""Accepted and rejected elements side by side (S1, P10): one decode, one write, two lanes.

Below one root, ``lane=movements`` is a lake of movements like any other and ``lane=rejects`` holds what could not be
taken: the reason (``bad_time``, ``bad_element``, ``bad_frame``), the frame's place in the input, the
element's position in the frame, and its text (of a ``bad_frame`` the whole frame).  Both are
written by the same job, so each micro-batch commits them together and a batch that runs again replaces
them together.  Rejects have no date of their own: they lie below day zero.  Messages of other types
are no rejects; they are counted as skipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackside.operators.decode import processed_stamp, to_envelope
from trackside.session import path_exists
from trackside.sinks.arrivals import ORDER, arrival
from trackside.sinks.lake import lake_rows

REASONS = ["bad_time", "bad_element", "bad_frame"]
REJECT_SCHEMA = "reason string, frame string, pos int, text string, rejected_at string, batch string"
_ZERO = {"year": "0000", "month": "00", "day": "00"}


def movements_lane(root: str) -> str:
    return f"{root.rstrip('/')}/lane=movements"


def rejects_lane(root: str) -> str:
    return f"{root.rstrip('/')}/lane=rejects"


def reject_text() -> "F.Column":
    """The text of an element that is rejected (nothing for others)."""
    return F.when(F.col("status").isin(REASONS), F.col("element")).alias("text")


def lane_rows(decoded: DataFrame, run: str, processed_at=None) -> DataFrame:
    """Decoded elements (with ``frame_order`` and ``text``) -> rows of both lanes, by ``lane``; each leaves the other's columns null."""
    kept = decoded.where(F.col("status").isin("ok", *REASONS)).withColumn("arrival", arrival(run))
    ok = F.col("status") == "ok"
    rows = lake_rows(to_envelope(kept, processed_at, ["status", ORDER, "pos", "text", "arrival"]), extra=["status", ORDER, "pos", "text"])
    own = {"reason": F.col("status"), "frame": F.col(ORDER), "pos": F.col("pos"), "text": F.col("text"),
           "rejected_at": processed_stamp(processed_at)}
    shared = [c for c in rows.columns if c not in ("status", ORDER, "pos", "text", *_ZERO)]
    return rows.select(F.when(ok, "movements").otherwise("rejects").alias("lane"),
                       *[F.when(ok, F.col(c)).alias(c) for c in shared],
                       *[F.when(~ok, c).alias(n) for n, c in own.items()],
                       *[F.when(ok, F.col(c).cast("string")).otherwise(z).alias(c) for c, z in _ZERO.items()])


def read_rejects(spark: SparkSession, root: str, fmt: str = "json") -> DataFrame:
    """The rejected elements of all batches below ``root``."""
    path = rejects_lane(root)
    if not path_exists(spark, path):
        return spark.createDataFrame([], REJECT_SCHEMA)
    return spark.read.schema(REJECT_SCHEMA).option("basePath", path).format(fmt).load(path).select(
        "reason", "frame", "pos", "text", "rejected_at", "batch")
