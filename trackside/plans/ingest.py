"""Batch ingest: feed frames -> decoded movements -> London-date lake.

One narrow pass: decode, count every status with ``observe`` and write the
movement envelopes.  Nothing is collected; the counters come back with the
write.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from trackside.operators.decode import (STATUSES, decode_frames, only_movements,
                                        to_envelope)
from trackside.operators.dedup import dedup_object_key
from trackside.sinks.arrivals import ORDER, arrival, claim, ordered
from trackside.sinks.lake import lake_rows, refuse_sink_log, write_lake


def ingest_frames(frames: DataFrame, lake_base: str, processed_at=None,
                  compat: bool = False, value: str = "value", keep: list[str] | None = None,
                  mode: str = "append", last_writer_wins: bool = False,
                  order_cols: list[str] | None = None, lake_format: str = "json") -> dict:
    """Decode frames and append the movements to the lake; return the counters.

    ``last_writer_wins`` reproduces the object-per-key lake, where a second
    movement of one operator in one London second replaced the first, in arrival order (or
    that of ``order_cols``).  Off by default: both movements are kept.

    Every object gets its ``arrival`` (``sinks.arrivals``): this run's number, the frame's place (its ``frame_order``,
    or else the ``keep`` columns) and the element's position.
    """
    keep = keep or []
    frames = ordered(frames, keep)
    refuse_sink_log(frames.sparkSession, lake_base)
    run = claim(frames.sparkSession, lake_base, "run", uuid.uuid4().hex)
    obs = Observation("ingest")
    decoded = decode_frames(frames, value, compat, [*keep, *[c for c in (ORDER,) if c not in keep]]).observe(
        obs, *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES],
        # frames with at least one element, plus unparseable frames
        F.count_if((F.col("pos") == 0) | ~F.col("frame_ok")).alias("frames"))
    moves = only_movements(decoded).withColumn("arrival", arrival(run))
    env = to_envelope(moves, processed_at, keep + ["pos", "arrival"])
    landed = Observation("landed")
    count = F.count(F.lit(1)).alias("written")
    if last_writer_wins:
        order = order_cols or ["arrival"]
        rows = dedup_object_key(lake_rows(env, extra=order), order)
        (rows.drop(*[c for c in order if c != "arrival"]).observe(landed, count).write.mode(mode).partitionBy("year", "month", "day")
         .format(lake_format).save(lake_base))
    else:
        write_lake(env.observe(landed, count), lake_base, mode=mode, fmt=lake_format)
    stats = dict(obs.get)
    # the consumer's counters: movements processed, messages in error, objects
    # written (counted at the writer) and failed: the write commits as a whole or
    # raises, so what was to be written and is not was replaced by a later object
    written = landed.get.get("written", 0)
    stats.update(processed=stats.get("ok", 0), errors=stats.get("bad_time", 0), written=written,
                 replaced=stats.get("ok", 0) - written, failed=0)
    return stats
