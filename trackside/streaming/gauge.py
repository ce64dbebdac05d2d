"""The live gauge (Q17 over a stream): punctuality of each UTC day, kept up to date.

Movements are counted by day in a windowed streaming aggregation.  Its state holds one row for each day
that the watermark has not passed, however many movements the day has; ``delay`` (over a year by default)
says how late a movement may come and still be counted, and bounds the state to as many days.  The query
runs in update mode: a micro-batch hands on the new totals of the days it changed, and these replace
the days' rows in the gauge table.

The table is partitioned by date and by the stream's persistent id, one row each.  A micro-batch overwrites just
the partitions of its days with totals, not with increments, so a batch that runs again after a
failure writes what it wrote before, and a restart goes on from the state in the checkpoint.  Streams
with checkpoints of their own (different frames) may feed one gauge: a day's counts are added over them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackside.functions.exprs import pct
from trackside.operators.analytics import ON_TIME
from trackside.operators.decode import decode_frames, only_movements, to_envelope
from trackside.operators.flatten import complete_rows, flatten
from trackside.session import path_exists
from trackside.streaming.ingest import started, stream_id

GAUGE_SCHEMA = "movements bigint, on_time bigint, batch bigint, date date, stream string"
#: How late a movement may come and still move its day's gauge.
DELAY = "400 days"


def day_counts(movements: DataFrame, delay: str = DELAY) -> DataFrame:
    """Streaming movements -> (date, movements, on_time) by UTC day."""
    return (movements.withWatermark("actual_timestamp", delay)
            .groupBy(F.window("actual_timestamp", "1 day").alias("day"))
            .agg(F.count(F.lit(1)).alias("movements"),
                 F.count_if(F.col("variation_status") == ON_TIME).alias("on_time"))
            .select(F.to_date("day.start").alias("date"), "movements", "on_time"))


def upsert_days(totals: DataFrame, gauge_path: str, stream: str, batch_id: int) -> None:
    """Replace the rows of the days in ``totals`` (a few: those that one micro-batch changed)."""
    (totals.select("movements", "on_time", F.lit(batch_id).cast("bigint").alias("batch"), "date",
                   F.lit(stream).alias("stream"))
     .coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date", "stream").parquet(gauge_path))


def stream_gauge(frames: DataFrame, gauge_path: str, checkpoint: str, delay: str = DELAY,
                 compat: bool = False, trigger: dict | None = None):
    """Start frames -> gauge table.  Returns the StreamingQuery."""
    env = to_envelope(only_movements(decode_frames(frames, compat=compat)))
    counts = day_counts(complete_rows(flatten(env)), delay)

    def each(batch: DataFrame, batch_id: int) -> None:
        upsert_days(batch, gauge_path, stream_id(batch.sparkSession, checkpoint), batch_id)

    return started(counts.writeStream.outputMode("update").foreachBatch(each), checkpoint, trigger)


def gauge_days(spark: SparkSession, gauge_path: str, date: str | None = None) -> DataFrame:
    """(date, movements, on_time, current_punctuality_percentage) of all days, or of one (no row if it has none)."""
    there = f"{gauge_path.rstrip('/')}/date={date}" if date else gauge_path
    if path_exists(spark, there):
        rows = spark.read.schema(GAUGE_SCHEMA).option("basePath", gauge_path).parquet(there)
    else:
        rows = spark.createDataFrame([], GAUGE_SCHEMA)
    return (rows.groupBy("date").agg(F.sum("movements").alias("movements"), F.sum("on_time").alias("on_time"))
            .withColumn("current_punctuality_percentage", pct("on_time", "movements")))


def live_gauge(spark: SparkSession, gauge_path: str, as_of_date: str) -> DataFrame:
    """One row like ``analytics.realtime_gauge``: NULL for a day without movements; that day's directory alone is read."""
    return gauge_days(spark, gauge_path, as_of_date).agg(
        F.max("current_punctuality_percentage").alias("current_punctuality_percentage"))
