"""Streaming lanes.

* ``stream_ingest`` (T1/T2): frames -> movement envelopes -> London-date
  lake.  Each micro-batch has a directory of its own below its days, named by
  the stream's persistent id and the batch's number: a batch that runs again
  after a restart replaces itself, so each frame is landed exactly once, and
  no other stream, checkpoint or batch job can touch it (the feed client
  acknowledged before processing and could lose a frame).
* ``stream_to_table`` (T3): each micro-batch is first landed in the lake
  in the same way, then every London day the batch touched is re-loaded whole from
  the lake and replaces its table partition.  Late movements are therefore
  never dropped: they re-open their day.  Only the touched-day list (a few
  dates per batch) reaches the driver.
* ``stream_to_table_append`` (T3, O(batch)): the complete movements of each
  micro-batch go straight into the day-partitioned table, below each day into a
  directory of the batch's own.  A late movement is appended to its own old day,
  a batch that runs again replaces itself, and each trigger costs only its own
  rows: they are rebalanced by day first, so that a small batch makes one file a day, not one for
  each task and day, and ``plans.compact`` packs the files of settled batches.  Use
  this table on its own: days that ``load_day`` replaces have no batches below them.
* ``dedup_stream`` (T4): ``dropDuplicatesWithinWatermark`` on the movement
  keys; the watermark bounds the state.  Rows arriving after the watermark
  are dropped by Spark's stateful operators, so this is for live views alone
  and no lane to a table uses it; the day load (T3) de-duplicates exactly
  per day instead (``dedup_keys``).
* ``ingest_observed`` (T6): status counters via ``observe``; each
  micro-batch's values appear in ``query.lastProgress["observedMetrics"]``.

Beside it: ``streaming.exact`` (T4 without loss), ``streaming.gauge`` (Q17 live) and
``streaming.progress`` (all progress reports as a table).
"""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trackside.operators.decode import (STATUSES, decode_frames, explode_messages,
                                        only_movements, to_envelope)
from trackside.plans.load_day import load_days
from trackside.sinks.arrivals import ORDER, arrival, claim, numbered, ordered
from trackside.sinks.lake import lake_rows, land_batch, refuse_sink_log
from trackside.sinks.lanes import lane_rows, movements_lane, reject_text

DEDUP_KEYS = ["train_id", "loc_stanox", "event_type", "actual_timestamp"]


def _status_counts() -> list:
    return [F.count_if(F.col("status") == s).alias(s) for s in STATUSES]


def ingest_observed(frames: DataFrame, name: str = "ingest", compat: bool = False,
                    keep: list[str] | None = None) -> DataFrame:
    """Decoded elements with live status counters attached (T6)."""
    return decode_frames(frames, compat=compat, keep=keep).observe(name, *_status_counts())


def started(writer, checkpoint: str, trigger: dict | None):
    """Start a stream's writer on its checkpoint; without a trigger it takes what is there and ends."""
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def stream_ingest(frames: DataFrame, lake_base: str, checkpoint: str,
                  processed_at=None, compat: bool = False, trigger: dict | None = None,
                  query_name: str | None = None, lake_format: str = "json",
                  counters: str | None = None, lanes: bool = False):
    """Start frames -> lake (a directory for each batch, exactly once).  Returns the StreamingQuery.

    ``lake_format="parquet"`` lands the columnar lake (see ``sinks.lake``).  With
    ``counters``, each micro-batch's status counts, observed in its own write, are kept below that folder
    under the batch's name, for ``counter_totals``: a query's progress reports are only its last ones.
    With ``lanes``, ``lake_base`` is the root of two lanes and rejected elements are kept too (``sinks.lanes``).
    Objects carry their arrival (``sinks.arrivals``).
    """
    refuse_sink_log(frames.sparkSession, lake_base)
    decoded = ingest_observed(ordered(frames), compat=compat, keep=[ORDER])
    # a batch is handed over as rows: what is not needed is left out before
    text = [reject_text()] if lanes else []
    decoded = decoded.select("status", ORDER, "pos", "msg_type", "actual_ms",
                             F.when(F.col("status") == "ok", F.col("body")).alias("body"), *text)

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = batch_name(spark, checkpoint, batch_id)
        run = claim(spark, movements_lane(lake_base) if lanes else lake_base, *name.rsplit("-", 1))
        counted = Observation()
        batch = numbered(batch).observe(counted, *_status_counts())
        if lanes:
            rows = lane_rows(batch, run, processed_at)
        else:
            moves = only_movements(batch).withColumn("arrival", arrival(run))
            rows = lake_rows(to_envelope(moves, processed_at, ["arrival"]))
        land_batch(rows, lake_base, name, lake_format)
        if counters:
            counts = counted.get
            (spark.createDataFrame([tuple(counts[s] for s in STATUSES)], ", ".join(f"{s} bigint" for s in STATUSES))
             .coalesce(1).write.mode("overwrite").parquet(f"{counters.rstrip('/')}/batch={name}"))

    w = decoded.writeStream.foreachBatch(each)
    if query_name:
        w = w.queryName(query_name)
    return started(w, checkpoint, trigger)


def counter_totals(spark: SparkSession, counters: str) -> DataFrame:
    """One row: the status counts of all micro-batches below ``counters``."""
    counts = spark.read.schema(", ".join(f"{s} bigint" for s in STATUSES)).parquet(counters)
    return counts.agg(*[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in STATUSES])


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The stream's persistent id, kept in its checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def batch_name(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """A name no other batch has: numbers start anew in each checkpoint."""
    return f"{stream_id(spark, checkpoint)}-{batch_id}"


def replace_touched_days(spark: SparkSession, env: DataFrame, batch: str, lake_base: str,
                         table_path: str, **load_kw):
    """One micro-batch of envelopes -> lake (own directory) -> re-load touched days."""
    rows = lake_rows(env).persist()
    try:
        land_batch(rows, lake_base, batch)
        touched = rows.select("year", "month", "day").distinct().collect()
    finally:
        rows.unpersist()
    days = sorted(_dt.date(int(r["year"]), int(r["month"]), int(r["day"])).isoformat()
                  for r in touched)
    if days:
        return load_days(spark, lake_base, table_path, days, **load_kw)
    return None


def stream_to_table(frames: DataFrame, lake_base: str, table_path: str, checkpoint: str,
                    processed_at=None, compat: bool = False, trigger: dict | None = None,
                    **load_kw):
    """Start frames -> lake -> day-replaced table via ``foreachBatch`` (T3).

    The lake below ``lake_base`` may have other writers (streams with their own
    checkpoints, batch ingest): a day is always re-loaded with all its objects.
    """
    spark = frames.sparkSession
    env = to_envelope(only_movements(decode_frames(ordered(frames), compat=compat, keep=[ORDER])), processed_at,
                      [ORDER, "pos"])

    def each(batch: DataFrame, batch_id: int) -> None:
        name = batch_name(spark, checkpoint, batch_id)
        run = claim(spark, lake_base, *name.rsplit("-", 1))
        replace_touched_days(spark, numbered(batch).withColumn("arrival", arrival(run)), name, lake_base,
                             table_path, verify=False, **load_kw)

    return started(env.writeStream.foreachBatch(each), checkpoint, trigger)


def stream_to_table_append(frames: DataFrame, table_path: str, checkpoint: str,
                           processed_at=None, compat: bool = False,
                           trigger: dict | None = None):
    """Start frames -> typed complete movements -> table, append-only (T3); late rows are kept."""
    from trackside.operators.flatten import complete_rows, flatten
    from trackside.schema import TABLE_COLUMNS
    env = to_envelope(only_movements(decode_frames(frames, compat=compat)), processed_at)
    refuse_sink_log(frames.sparkSession, table_path)

    def each(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, table_path, batch_name(batch.sparkSession, checkpoint, batch_id))

    rows = complete_rows(flatten(env)).select(*TABLE_COLUMNS)
    return started(rows.writeStream.foreachBatch(each), checkpoint, trigger)


def append_batch(rows: DataFrame, table_path: str, batch: str) -> None:
    """Rows (table columns) of one micro-batch into its directories ``uk_date=/batch=``, which they replace."""
    from trackside.schema import documented
    (documented(rows).withColumn("batch", F.lit(batch)).hint("rebalance", "uk_date")
     .sortWithinPartitions("uk_date", "actual_timestamp")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("uk_date", "batch").parquet(table_path))


def stream_publish(frames: DataFrame, checkpoint: str, sink: dict, fmt: str = "kafka",
                   trigger: dict | None = None):
    """First stage of the topic lane (T5): every message of every frame, unfiltered.

    ``fmt="kafka"`` needs ``sink`` with ``kafka.bootstrap.servers`` and
    ``topic``; a file format (``text``) with ``path`` gives the same records
    for tests.  The second stage is ``stream_ingest`` over
    ``single_message_frames(read_topic(...))``.
    """
    records = (explode_messages(frames).where(F.col("is_object"))
               .select(F.col("element").alias("value")))
    return started(records.writeStream.format(fmt).options(**sink), checkpoint, trigger)


def dedup_stream(movements: DataFrame, keys: list[str] | None = None,
                 delay: str = "2 hours", event_time: str = "actual_timestamp") -> DataFrame:
    """Drop repeated movements within the watermark delay (T4)."""
    return (movements.withWatermark(event_time, delay)
            .dropDuplicatesWithinWatermark(keys or DEDUP_KEYS))
