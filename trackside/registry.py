"""Named queries for the driver: each takes (spark, sf_dir) -> DataFrame.

Every query reads the driver's tables under ``sf_dir`` (``events``), derives
the stand-in movements with Spark and runs one operator of the package on
them; nothing is capped, sampled or pre-filtered to keep the check cheap.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackside.operators import analytics as A
from trackside.operators import views as V
from trackside.operators.decode import (decode_frames, explode_messages,
                                        frames_to_envelopes, only_movements)
from trackside.operators.dedup import dedup_object_key
from trackside.operators.describer import td_berth_events
from trackside.operators.flatten import complete_rows, flatten
from trackside.operators.summary import charts, dashboard
from trackside.operators.quality import (accepted_failures, ingest_stats, quality_report,
                                         run_checks)
from trackside.operators.rollups import Rollups
from trackside.plans.compact import compact
from trackside.plans.ingest import ingest_frames
from trackside.plans.load_day import append_table, load_day, load_days, report_frame
from trackside.plans.migrate import migrate_table, migration_frame
from trackside.schema import EVENT_TYPES, TABLE_COLUMNS, VARIATION_STATUSES
from trackside.session import scratch_dir, use_utc
from trackside.sinks.lake import lake_rows, publish_messages, write_ndjson, write_objects
from trackside.sinks.lanes import movements_lane, read_rejects
from trackside.sources.feed import read_frames, read_topic, single_message_frames
from trackside.sources.lake import last_writer, read_lake, read_ndjson
from trackside.sources.standin import (plant_quality_failures, standin_bad_time_frames,
                                       standin_frames, standin_full_frames,
                                       standin_movements, standin_td_frames)
from trackside.streaming.exact import stream_to_table_exact
from trackside.streaming.gauge import gauge_days, live_gauge, stream_gauge
from trackside.streaming.progress import ProgressTable, progress_totals, read_progress, settled
from trackside.streaming.ingest import (DEDUP_KEYS, counter_totals, dedup_stream, stream_ingest, stream_publish,
                                        stream_to_table, stream_to_table_append)

AS_OF = "2024-01-31 00:00:00"
GAUGE_DATE = "2024-01-30"

Query = Callable[[SparkSession, str], DataFrame]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    return standin_movements(events(spark, sf_dir))


def as_ntz(df: DataFrame) -> DataFrame:
    """Report TIMESTAMP columns as TIMESTAMP_NTZ (UTC wall clock).

    The oracle's timestamps carry no zone; with the session pinned to UTC
    the cast keeps the same wall-clock value.
    """
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
                       for f in df.schema.fields])


def _on_m(fn, **kw) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return as_ntz(fn(movements(spark, sf_dir), **kw))
    q.__name__ = fn.__name__
    return q


def _on_mart(fn) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        mart = V.operating_company_performance(V.stg_movements(movements(spark, sf_dir)))
        return as_ntz(fn(mart))
    q.__name__ = fn.__name__
    return q


RUN_SQL_TEXT = """
SELECT toc_id, COUNT(*) AS movement_count, MAX(actual_timestamp) AS last_movement
FROM movements WHERE variation_status = :status AND event_type = :event
GROUP BY toc_id"""


def _run_sql_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    V.register_views(spark, movements(spark, sf_dir))
    return as_ntz(A.run_sql(spark, RUN_SQL_TEXT, {"status": "LATE", "event": "ARRIVAL"}))


def analytics_queries() -> dict[str, Query]:
    return {
        "basic_stats": _on_m(A.basic_stats),
        "movements_by_toc": _on_m(A.movements_by_toc),
        "punctuality_share": _on_m(A.punctuality_share),
        "hourly_patterns": _on_m(A.hourly_patterns),
        "recent_movements": _on_m(A.recent_movements, as_of=AS_OF, hours=24),
        "top_toc": _on_m(A.top_toc),
        "event_type_distribution": _on_m(A.event_type_distribution),
        "punctuality_distribution": _on_m(A.punctuality_distribution),
        "toc_ranking": _on_m(A.toc_ranking),
        "toc_status_heatmap": _on_m(A.toc_status_heatmap),
        "daily_trends": _on_m(A.daily_trends),
        "weekly_calendar": _on_m(A.weekly_calendar),
        "top_stations": _on_m(A.top_stations),
        "route_performance": _on_m(A.route_performance),
        "delay_distribution": _on_m(A.delay_distribution),
        "toc_hour_matrix": _on_m(A.toc_hour_matrix),
        "realtime_gauge": _on_m(A.realtime_gauge, as_of_date=GAUGE_DATE),
        "leaderboard": _on_m(A.leaderboard),
        "kpi_scorecard": _on_m(A.kpi_scorecard),
        "network_health": _on_m(A.network_health),
        "journey_flow": _on_m(A.journey_flow),
        "row_count": _on_m(A.row_count),
        "sample_rows": _on_m(A.sample_rows),
        "run_sql_passthrough": _run_sql_passthrough,
        "operating_company_performance": _on_mart(lambda mart: mart),
        "company_tree": _on_mart(A.company_tree),
        "company_ranking": _on_mart(A.company_ranking),
    }


# --- feed codec, lake, load, quality, streaming ------------------------------

PROCESSED_AT = "2024-01-31T00:00:00"
REPLAY_DAY = "2024-01-15"
SUMMER_SHIFT_DAYS = 150


def _table(df: DataFrame) -> DataFrame:
    return as_ntz(complete_rows(df).select(*TABLE_COLUMNS))


def _frames(spark, sf_dir, **kw) -> DataFrame:
    use_utc(spark)
    return standin_frames(events(spark, sf_dir), **kw)


def _envelopes(spark, sf_dir, shift_days: int = 0) -> DataFrame:
    return frames_to_envelopes(_frames(spark, sf_dir, shift_days=shift_days),
                               processed_at=PROCESSED_AT, keep=["frame_id"])


def q_frames_to_movements(spark, sf_dir):
    return _table(flatten(_envelopes(spark, sf_dir)))


def q_rejected_frames(spark, sf_dir):
    d = decode_frames(_frames(spark, sf_dir))
    return d.groupBy("status").agg(F.count(F.lit(1)).alias("messages"))


def q_ingest_stats(spark, sf_dir):
    return ingest_stats(decode_frames(_frames(spark, sf_dir)))


def q_uk_datetime_text(spark, sf_dir):
    t = complete_rows(flatten(_envelopes(spark, sf_dir, SUMMER_SHIFT_DAYS)))
    return as_ntz(t.select("actual_timestamp", "uk_datetime", "timestamp", "uk_date"))


def q_partition_keys(spark, sf_dir):
    rows = lake_rows(_envelopes(spark, sf_dir, SUMMER_SHIFT_DAYS))
    return rows.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("movements"))


def q_object_names(spark, sf_dir):
    rows = lake_rows(_envelopes(spark, sf_dir))
    return rows.groupBy("object_name").agg(F.count(F.lit(1)).alias("movements"))


def q_object_key_dedup(spark, sf_dir):
    rows = lake_rows(_envelopes(spark, sf_dir), extra=["frame_id", "pos"])
    kept = dedup_object_key(rows, order_cols=["frame_id", "pos"])
    return kept.select("object_name", "toc_id",
                       F.col("raw_data").getItem("train_id").alias("train_id"),
                       "variation_status")


def _lake(spark, sf_dir) -> str:
    base = scratch_dir(spark, "lake")
    ingest_frames(_frames(spark, sf_dir), base, processed_at=PROCESSED_AT)
    return base


def q_lake_roundtrip_day(spark, sf_dir):
    base = _lake(spark, sf_dir)
    return _table(flatten(read_lake(spark, base, REPLAY_DAY)))


def q_parquet_lake_load(spark, sf_dir):
    """The columnar lake option: frames -> Parquet lake -> load all days -> table."""
    lake, table = scratch_dir(spark, "plake"), scratch_dir(spark, "ptable")
    ingest_frames(_frames(spark, sf_dir), lake, processed_at=PROCESSED_AT,
                  lake_format="parquet")
    load_days(spark, lake, table, lake_format="parquet", verify=None)
    return as_ntz(spark.read.parquet(table).select(*TABLE_COLUMNS))


def q_ndjson_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "ndjson")
    write_ndjson(lake_rows(_envelopes(spark, sf_dir)), path)
    return _table(flatten(read_ndjson(spark, path)))


def q_topic_lane(spark, sf_dir):
    path = scratch_dir(spark, "topic")
    publish_messages(explode_messages(_frames(spark, sf_dir)), path)
    records = read_topic(spark, {"path": path}, streaming=False, fmt="text")
    env = frames_to_envelopes(single_message_frames(records), processed_at=PROCESSED_AT)
    return _table(flatten(env))


def q_flatten_complete(spark, sf_dir):
    """Older lane: bare movement bodies (no envelope) -> flatten -> key filter."""
    path = scratch_dir(spark, "bare")
    msgs = only_movements(decode_frames(_frames(spark, sf_dir)))
    msgs.select(F.to_json("body").alias("value")).write.mode("overwrite").text(path)
    return _table(flatten(read_ndjson(spark, path)))


def _load_replay(spark, sf_dir):
    base = _lake(spark, sf_dir)
    table = scratch_dir(spark, "table")
    load_days(spark, base, table)
    report = load_day(spark, base, table, REPLAY_DAY, verify="table")
    return table, report


def q_load_day_replay(spark, sf_dir):
    table, _ = _load_replay(spark, sf_dir)
    return as_ntz(spark.read.parquet(table).select(*TABLE_COLUMNS))


def q_load_report(spark, sf_dir):
    _, report = _load_replay(spark, sf_dir)
    return report_frame(spark, report)


def q_quality_report(spark, sf_dir):
    return quality_report(flatten(_envelopes(spark, sf_dir)))


def q_stg_movements(spark, sf_dir):
    return as_ntz(V.stg_movements(movements(spark, sf_dir)))


# Declared data tests per model: (not_null columns, accepted values).
DATA_TESTS = {
    "stg_movements": (["event_type", "variation_status"],
                      {"event_type": EVENT_TYPES, "variation_status": VARIATION_STATUSES}),
    "operating_company_performance": (
        ["actual_timestamp", "train_operating_company", "variation_status"],
        {"variation_status": VARIATION_STATUSES}),
    "stg_movements_keys": (["event_type", "actual_timestamp", "train_id", "toc_id"],
                           {"event_type": EVENT_TYPES}),
}


def _planted_models(spark, sf_dir) -> dict[str, DataFrame]:
    stg = V.stg_movements(plant_quality_failures(movements(spark, sf_dir)))
    return {"stg_movements": stg,
            "operating_company_performance": V.operating_company_performance(stg),
            "stg_movements_keys": stg}


def q_not_null_failures(spark, sf_dir):
    models = _planted_models(spark, sf_dir)
    out = None
    for name, (nn, _) in DATA_TESTS.items():
        r = run_checks(models[name], name, nn, {})
        out = r if out is None else out.unionByName(r)
    return out


def q_accepted_value_failures(spark, sf_dir):
    models = _planted_models(spark, sf_dir)
    out = None
    for name, (_, acc) in DATA_TESTS.items():
        r = accepted_failures(models[name], name, acc)
        out = r if out is None else out.unionByName(r)
    return out


def q_td_berth_events(spark, sf_dir):
    use_utc(spark)
    return td_berth_events(standin_td_frames(events(spark, sf_dir)))


def _frames_dir(spark, sf_dir, label: str, part=None) -> str:
    path = scratch_dir(spark, label)
    f = _frames(spark, sf_dir)
    if part is not None:
        f = f.where(part)
    f.select("value").write.mode("append").text(path)
    return path


def q_stream_ingest_available_now(spark, sf_dir):
    src = _frames_dir(spark, sf_dir, "frames")
    lake, ckpt = scratch_dir(spark, "slake"), scratch_dir(spark, "sckpt")
    q = stream_ingest(read_frames(spark, src, streaming=True), lake, ckpt,
                      processed_at=PROCESSED_AT)
    q.awaitTermination()
    return _table(flatten(read_lake(spark, lake)))


def q_stream_late_day_replay(spark, sf_dir):
    """Two runs of one stream: the second run brings movements of days already loaded."""
    src = scratch_dir(spark, "frames")
    lake, table, ckpt = (scratch_dir(spark, "slake"), scratch_dir(spark, "stable"),
                         scratch_dir(spark, "sckpt"))
    f = _frames(spark, sf_dir).select("frame_id", "value")
    for run, part in enumerate([F.col("frame_id") % 3 != 0, F.col("frame_id") % 3 == 0]):
        f.where(part).select("value").write.mode("append").text(f"{src}/run={run}")
        q = stream_to_table(read_frames(spark, f"{src}/run=*", streaming=True), lake, table,
                            ckpt, processed_at=PROCESSED_AT)
        q.awaitTermination()
    return as_ntz(spark.read.parquet(table).select(*TABLE_COLUMNS))


def q_stream_table_append(spark, sf_dir):
    """Two runs of one append-only stream; the second brings late movements."""
    src = scratch_dir(spark, "frames")
    table, ckpt = scratch_dir(spark, "atable"), scratch_dir(spark, "sckpt")
    f = _frames(spark, sf_dir).select("frame_id", "value")
    for run, part in enumerate([F.col("frame_id") % 3 != 0, F.col("frame_id") % 3 == 0]):
        f.where(part).select("value").write.mode("append").text(f"{src}/run={run}")
        q = stream_to_table_append(read_frames(spark, f"{src}/run=*", streaming=True), table,
                                   ckpt, processed_at=PROCESSED_AT)
        q.awaitTermination()
    return as_ntz(spark.read.parquet(table).select(*TABLE_COLUMNS))


def q_stream_dedup(spark, sf_dir):
    """Every frame delivered twice; the stream keeps one movement per key."""
    src = scratch_dir(spark, "frames")
    f = _frames(spark, sf_dir).select("value")
    f.write.mode("append").text(f"{src}/copy=0")
    f.write.mode("append").text(f"{src}/copy=1")
    out, ckpt = scratch_dir(spark, "dedup"), scratch_dir(spark, "sckpt")
    env = frames_to_envelopes(read_frames(spark, f"{src}/copy=*", streaming=True),
                              processed_at=PROCESSED_AT)
    moves = complete_rows(flatten(env))
    q = (dedup_stream(moves, delay="40 days").select(*DEDUP_KEYS)
         .writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return as_ntz(spark.read.parquet(out))


def _half_frames(spark, sf_dir, keep) -> str:
    return _frames_dir(spark, sf_dir, "frames", keep)


def q_stream_new_checkpoint(spark, sf_dir):
    """Two streams with checkpoints of their own land on one lake and load one table."""
    lake, table = scratch_dir(spark, "slake"), scratch_dir(spark, "stable")
    for part in (F.col("frame_id") % 3 != 0, F.col("frame_id") % 3 == 0):
        src = _half_frames(spark, sf_dir, part)
        stream_to_table(read_frames(spark, src, streaming=True), lake, table, scratch_dir(spark, "sckpt"),
                        processed_at=PROCESSED_AT).awaitTermination()
    return as_ntz(spark.read.parquet(table).select(*TABLE_COLUMNS))


def q_mixed_lane_lake(spark, sf_dir):
    """A stream and a batch ingest share a lake; all of it is read."""
    lake = scratch_dir(spark, "mlake")
    src = _half_frames(spark, sf_dir, F.col("frame_id") % 2 == 0)
    stream_ingest(read_frames(spark, src, streaming=True), lake, scratch_dir(spark, "sckpt"),
                  processed_at=PROCESSED_AT).awaitTermination()
    ingest_frames(_frames(spark, sf_dir).where(F.col("frame_id") % 2 != 0), lake, processed_at=PROCESSED_AT)
    return _table(flatten(read_lake(spark, lake)))


def q_topic_lane_streams(spark, sf_dir):
    """Both stages of the topic lane as streams: publish every message, then land the movements."""
    src, topic, lake = _frames_dir(spark, sf_dir, "frames"), scratch_dir(spark, "topic"), scratch_dir(spark, "lake")
    stream_publish(read_frames(spark, src, streaming=True), scratch_dir(spark, "ck1"), {"path": topic},
                   fmt="text").awaitTermination()
    records = read_topic(spark, {"path": topic}, streaming=True, fmt="text")
    stream_ingest(single_message_frames(records), lake, scratch_dir(spark, "ck2"),
                  processed_at=PROCESSED_AT).awaitTermination()
    return _table(flatten(read_lake(spark, lake)))


def q_live_counters(spark, sf_dir):
    """The stream's own status counters, summed over its micro-batches."""
    src = _frames_dir(spark, sf_dir, "frames")
    counters = scratch_dir(spark, "counters")
    stream_ingest(read_frames(spark, src, streaming=True, max_files_per_trigger=1), scratch_dir(spark, "lake"),
                  scratch_dir(spark, "ck"), processed_at=PROCESSED_AT, counters=counters).awaitTermination()
    return counter_totals(spark, counters).select("ok", "skipped", "bad_time", "bad_element", "bad_frame")


def q_bad_times(spark, sf_dir):
    """Status counts of frames with unusable times, and the rows that are left."""
    use_utc(spark)
    d = decode_frames(standin_bad_time_frames(events(spark, sf_dir)))
    landed = flatten(frames_to_envelopes(standin_bad_time_frames(events(spark, sf_dir)), processed_at=PROCESSED_AT))
    counts = d.groupBy("status").agg(F.count(F.lit(1)).alias("messages"))
    times = landed.agg(F.lit("latest ms").alias("status"), F.max(F.unix_millis("actual_timestamp")).alias("messages"))
    return counts.unionByName(times)


def q_full_body_fields(spark, sf_dir):
    """All 29 body fields, JSON booleans, numbers and nulls among them, through decode and flatten."""
    use_utc(spark)
    return _table(flatten(frames_to_envelopes(standin_full_frames(events(spark, sf_dir)), processed_at=PROCESSED_AT)))


def q_full_body_staging(spark, sf_dir):
    return as_ntz(V.stg_movements(complete_rows(flatten(frames_to_envelopes(
        standin_full_frames(events(spark, sf_dir)), processed_at=PROCESSED_AT)))))


def q_ndjson_bad_lines(spark, sf_dir):
    """An NDJSON file with blank and damaged lines: objects and bad lines."""
    path = scratch_dir(spark, "ndjson")
    rows = lake_rows(_envelopes(spark, sf_dir), extra=["frame_id", "pos"])
    text = F.to_json(F.struct(*[c for c in rows.columns if c not in ("frame_id", "pos")]))
    line = F.when(F.col("pos") % 10 == 3, F.substr(text, F.lit(1), F.lit(40))).otherwise(text)
    rows.select(F.concat(line, F.when(F.col("pos") % 7 == 2, F.lit("\n   \n")).otherwise(F.lit("")))
                .alias("value")).write.mode("overwrite").text(path)
    return read_ndjson(spark, path).groupBy("ok").agg(F.count(F.lit(1)).alias("lines"))


def q_whole_objects_load(spark, sf_dir):
    """A lake of one pretty-printed object a file, both layouts, some damaged: the load's counts."""
    lake, table = scratch_dir(spark, "wlake"), scratch_dir(spark, "wtable")
    rows = lake_rows(_envelopes(spark, sf_dir), extra=["frame_id", "pos"])
    pretty = {"pretty": "true"}
    whole = F.to_json(F.struct("message_type", "event_type", "toc_id", "variation_status", "uk_datetime",
                               "timestamp", "processed_at", "raw_data"), pretty)
    n = F.col("pos") % 10
    text = F.when(n == 4, F.to_json("raw_data", pretty)).when(n == 8, F.substr(whole, F.lit(1), F.lit(60))).otherwise(whole)
    write_objects(rows, lake, text, F.concat_ws("-", F.lit("object"), "frame_id", "pos"))
    report = load_days(spark, lake, table, whole_objects=True)
    cols = ["status", "invalid_objects", "total_rows", "valid_rows", "written", "deleted", "day_rows"]
    return report_frame(spark, report).select(*cols)


def q_load_report_partial(spark, sf_dir):
    """Two days loaded again with exact de-duplication: one is there twice over, one is absent."""
    lake, table = _lake(spark, sf_dir), scratch_dir(spark, "table")
    ingest_frames(_frames(spark, sf_dir), lake, processed_at=PROCESSED_AT)     # every object twice
    load_days(spark, lake, table, verify=None)
    report = load_days(spark, lake, table, [REPLAY_DAY, "2031-01-01"], dedup_keys=DEDUP_KEYS)
    cols = ["days", "status", "day_status", "total_rows", "written", "deleted", "day_rows"]
    return report_frame(spark, report).select(*cols)


def q_object_overwrite_two_runs(spark, sf_dir):
    """Two runs write objects of the same names; each name's last object counts."""
    lake, frames = scratch_dir(spark, "olake"), _frames(spark, sf_dir)
    for part in (F.lit(True), F.col("frame_id") % 2 == 0):
        ingest_frames(frames.where(part), lake, processed_at=PROCESSED_AT, last_writer_wins=True, keep=["frame_id"])
    return last_writer(read_lake(spark, lake)).select(
        "object_name", "toc_id", F.col("raw_data").getField("train_id").alias("train_id"), "variation_status")


def _parts(spark, frames: DataFrame, label: str, part) -> str:
    """Some of the frames as text files in their order (by file name, then line)."""
    path = scratch_dir(spark, label)
    (frames.where(part).select("frame_id", "value").repartitionByRange("frame_id").sortWithinPartitions("frame_id")
     .select("value").write.mode("append").text(path))
    return path


def q_arrival_order_objects(spark, sf_dir):
    """A batch run, then two micro-batches of a stream, each with objects of the same names; every object
    is kept, the one of each name that arrived last counts."""
    lake, ckpt, frames = scratch_dir(spark, "olake"), scratch_dir(spark, "sckpt"), _frames(spark, sf_dir)
    third = F.pmod(F.col("frame_id"), F.lit(3))
    ingest_frames(read_frames(spark, _parts(spark, frames, "frames", third == 0)), lake, processed_at=PROCESSED_AT)
    src = scratch_dir(spark, "frames")
    for k in (1, 2):
        (frames.where(third == k).select("frame_id", "value").repartitionByRange("frame_id").sortWithinPartitions("frame_id")
         .select("value").write.mode("append").text(f"{src}/run={k}"))
        stream_ingest(read_frames(spark, f"{src}/run=*", streaming=True), lake, ckpt,
                      processed_at=PROCESSED_AT).awaitTermination()
    return last_writer(read_lake(spark, lake)).select(
        "object_name", "toc_id", F.col("raw_data").getField("train_id").alias("train_id"), "variation_status")


def q_stream_gauge(spark, sf_dir):
    """The live gauge of every day and of a day without movements, after a restart with late movements."""
    src, gauge, ckpt = scratch_dir(spark, "frames"), scratch_dir(spark, "gauge"), scratch_dir(spark, "sckpt")
    f = _frames(spark, sf_dir).select("frame_id", "value")
    for run, part in enumerate([F.col("frame_id") % 3 != 0, F.col("frame_id") % 3 == 0]):
        f.where(part).select("value").write.mode("append").text(f"{src}/run={run}")
        stream_gauge(read_frames(spark, f"{src}/run=*", streaming=True, max_files_per_trigger=4), gauge, ckpt).awaitTermination()
    days = gauge_days(spark, gauge).select("date", "movements", "current_punctuality_percentage")
    empty = live_gauge(spark, gauge, "2031-01-01").select(
        F.lit("2031-01-01").cast("date").alias("date"), F.lit(0).cast("bigint").alias("movements"), "current_punctuality_percentage")
    return days.unionByName(empty)


def q_stream_dedup_exact(spark, sf_dir):
    """Every frame delivered three times over three runs, the last in an order of days that no watermark would
    outlast: each movement is in the table once, none is lost."""
    src, table, ckpt = scratch_dir(spark, "frames"), scratch_dir(spark, "xtable"), scratch_dir(spark, "sckpt")
    f = _frames(spark, sf_dir).select("frame_id", "value")
    for run, part in enumerate([F.col("frame_id") % 3 != 0, F.lit(True), F.col("frame_id") % 3 != 1]):
        f.where(part).select("value").write.mode("append").text(f"{src}/run={run}")
        stream_to_table_exact(read_frames(spark, f"{src}/run=*", streaming=True), table, ckpt,
                              processed_at=PROCESSED_AT).awaitTermination()
    return as_ntz(spark.read.parquet(table).select(*DEDUP_KEYS))


def q_quarantine_lanes(spark, sf_dir):
    """Frames with unusable times, elements and texts through one stream: what was accepted and what was rejected, why and where."""
    use_utc(spark)
    src, root = scratch_dir(spark, "frames"), scratch_dir(spark, "lanes")
    for k, f in enumerate([standin_frames(events(spark, sf_dir)), standin_bad_time_frames(events(spark, sf_dir))]):
        f.select("value").write.mode("append").text(f"{src}/feed={k}")
    stream_ingest(read_frames(spark, f"{src}/feed=*", streaming=True), root, scratch_dir(spark, "sckpt"),
                  processed_at=PROCESSED_AT, lanes=True).awaitTermination()
    taken = read_lake(spark, movements_lane(root)).agg(F.lit("accepted").alias("reason"), F.count(F.lit(1)).alias("elements"),
                                                       F.lit(None).cast("bigint").alias("positions"))
    refused = read_rejects(spark, root).groupBy("reason").agg(F.count("text").alias("elements"), F.sum("pos").alias("positions"))
    return taken.unionByName(refused)


def q_stream_progress(spark, sf_dir):
    """The ingest counters out of the progress reports, which a listener files as a table."""
    src, reports = _frames_dir(spark, sf_dir, "frames"), scratch_dir(spark, "progress")
    listener = ProgressTable(spark, reports)
    spark.streams.addListener(listener)
    try:
        q = stream_ingest(read_frames(spark, src, streaming=True, max_files_per_trigger=1), scratch_dir(spark, "lake"),
                          scratch_dir(spark, "ck"), processed_at=PROCESSED_AT)
        q.awaitTermination()
        settled(spark)
    finally:
        spark.streams.removeListener(listener)
    return progress_totals(read_progress(spark, reports).where(F.col("query") == str(q.id)))


def _rollups(spark, sf_dir) -> Rollups:
    """Rollups kept by the load: all days, then one day is replaced."""
    lake, table, path = _lake(spark, sf_dir), scratch_dir(spark, "table"), scratch_dir(spark, "rollups")
    load_days(spark, lake, table, rollup_path=path, verify=None)
    load_day(spark, lake, table, REPLAY_DAY, rollup_path=path, verify=None)
    return Rollups(spark, path)


def q_rollup_scorecards(spark, sf_dir):
    """Q1, Q19 and Q20 out of the kept rollups: distinct trains and operators from merged bitmaps."""
    return as_ntz(_rollups(spark, sf_dir).scorecards())


def q_rollup_charts(spark, sf_dir):
    """Q13, Q15 and Q21 out of the kept rollups."""
    r = _rollups(spark, sf_dir)
    stations = r.top_stations().select(F.lit("station").alias("chart"), F.col("station_code").alias("label"), F.col("movement_count").alias("n"),
                                       F.col("punctuality_percentage").alias("value"))
    delays = r.delay_distribution().select(F.lit("delay"), F.lit(None).cast("string"), "frequency", "delay_minutes")
    flow = r.journey_flow().select(F.lit("flow"), "event_type", "movement_count", "avg_delay_minutes")
    return stations.union(delays).union(flow)


def q_catalog_table_views(spark, sf_dir):
    """The mart view of a reporting schema over the staging view of another, over the catalog table that loads keep."""
    lake, table, home = _lake(spark, sf_dir), scratch_dir(spark, "table"), scratch_dir(spark, "catalog")
    tag = home.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS warehouse_{tag} LOCATION '{home}/warehouse'")
    name = f"warehouse_{tag}.movements"
    days = [r["d"] for r in read_lake(spark, lake).select(F.concat_ws("-", "year", "month", "day").alias("d")).distinct().toLocalIterator()]
    load_days(spark, lake, table, sorted(days)[:10], verify=None, catalog_table=name)
    load_days(spark, lake, table, verify=None, catalog_table=name)
    _, mart = V.register_catalog_views(spark, None, home, f"staging_{tag}", f"reporting_{tag}", catalog_table=name)
    return as_ntz(spark.table(mart))


def q_compacted_stream_table(spark, sf_dir):
    """A stream's table in small batches, packed, then fed further: the rows of every batch once, few files a day."""
    src, table, ckpt = scratch_dir(spark, "frames"), scratch_dir(spark, "atable"), scratch_dir(spark, "sckpt")
    f = _frames(spark, sf_dir).select("frame_id", "value")
    for run in range(3):
        f.where(F.pmod(F.col("frame_id"), F.lit(3)) == run).select("value").write.mode("append").text(f"{src}/run={run}")
        stream_to_table_append(read_frames(spark, f"{src}/run=*", streaming=True), table, ckpt,
                               processed_at=PROCESSED_AT).awaitTermination()
        compact(spark, table)
    return as_ntz(spark.read.parquet(table).select(*TABLE_COLUMNS))


def q_migrated_table(spark, sf_dir):
    """A table with bodies as text (every thirteenth damaged), migrated day by day, over two calls: counts by day."""
    old, table = scratch_dir(spark, "old"), scratch_dir(spark, "table")
    rows = lake_rows(_envelopes(spark, sf_dir), extra=["frame_id", "pos"])
    text = F.to_json("raw_data")
    body = F.when((F.col("frame_id") * 50 + F.col("pos")) % 13 == 5, F.substr(text, F.lit(1), F.lit(30))).otherwise(text)
    (rows.select("event_type", "toc_id", "variation_status", "processed_at", body.alias("raw_data"),
                 F.concat_ws("-", "year", "month", "day").alias("uk_date")).write.mode("append").partitionBy("uk_date").parquet(old))
    migrate_table(spark, old, table, [REPLAY_DAY])
    return migration_frame(spark, migrate_table(spark, old, table))


def q_append_table(spark, sf_dir):
    """Typed append in two parts, one without a column of the schema."""
    table, m = scratch_dir(spark, "atable"), movements(spark, sf_dir)
    append_table(m.where("event_type = 'ARRIVAL'"), table)
    append_table(m.where("event_type = 'DEPARTURE'").drop("route"), table)
    return as_ntz(spark.read.parquet(table).select(*TABLE_COLUMNS))


def feed_and_load_queries() -> dict[str, Query]:
    return {
        "frames_to_movements": q_frames_to_movements,
        "rejected_frames": q_rejected_frames,
        "ingest_stats": q_ingest_stats,
        "uk_datetime_text": q_uk_datetime_text,
        "partition_keys": q_partition_keys,
        "object_names": q_object_names,
        "object_key_dedup": q_object_key_dedup,
        "lake_roundtrip_day": q_lake_roundtrip_day,
        "ndjson_roundtrip": q_ndjson_roundtrip,
        "parquet_lake_load": q_parquet_lake_load,
        "topic_lane": q_topic_lane,
        "flatten_complete": q_flatten_complete,
        "load_day_replay": q_load_day_replay,
        "load_report": q_load_report,
        "quality_report": q_quality_report,
        "stg_movements": q_stg_movements,
        "not_null_failures": q_not_null_failures,
        "accepted_value_failures": q_accepted_value_failures,
        "td_berth_events": q_td_berth_events,
        "stream_ingest_available_now": q_stream_ingest_available_now,
        "stream_late_day_replay": q_stream_late_day_replay,
        "stream_dedup": q_stream_dedup,
        "stream_table_append": q_stream_table_append,
        "stream_new_checkpoint": q_stream_new_checkpoint,
        "mixed_lane_lake": q_mixed_lane_lake,
        "topic_lane_streams": q_topic_lane_streams,
        "live_counters": q_live_counters,
        "bad_times": q_bad_times,
        "full_body_fields": q_full_body_fields,
        "full_body_staging": q_full_body_staging,
        "ndjson_bad_lines": q_ndjson_bad_lines,
        "whole_objects_load": q_whole_objects_load,
        "load_report_partial": q_load_report_partial,
        "append_table": q_append_table,
        "object_overwrite_two_runs": q_object_overwrite_two_runs,
        "arrival_order_objects": q_arrival_order_objects,
        "stream_gauge": q_stream_gauge,
        "stream_dedup_exact": q_stream_dedup_exact,
        "quarantine_lanes": q_quarantine_lanes,
        "stream_progress": q_stream_progress,
        "rollup_scorecards": q_rollup_scorecards,
        "rollup_charts": q_rollup_charts,
        "catalog_table_views": q_catalog_table_views,
        "compacted_stream_table": q_compacted_stream_table,
        "migrated_table": q_migrated_table,
        "maintained_summary_toc_ranking": q_maintained_summary_toc_ranking,
    }


# --- the count-only charts over the one-pass movement summary ----------------

SUMMARY_QUERIES = ["movements_by_toc", "top_toc", "punctuality_share", "hourly_patterns",
                   "event_type_distribution", "punctuality_distribution", "toc_ranking",
                   "toc_status_heatmap", "daily_trends", "weekly_calendar",
                   "route_performance", "toc_hour_matrix", "realtime_gauge", "leaderboard",
                   "row_count", "company_tree", "company_ranking"]


def _via_summary(name: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return as_ntz(dashboard(spark, movements(spark, sf_dir), GAUGE_DATE)[name])
    q.__name__ = f"summary_{name}"
    return q


def summary_queries() -> dict[str, Query]:
    return {f"summary_{n}": _via_summary(n) for n in SUMMARY_QUERIES}


def q_maintained_summary_toc_ranking(spark, sf_dir):
    """Ranking from the summary the daily load keeps (all days, then a replay)."""
    base = _lake(spark, sf_dir)
    table, summ = scratch_dir(spark, "table"), scratch_dir(spark, "summary")
    load_days(spark, base, table, summary_path=summ, verify=None)
    load_day(spark, base, table, REPLAY_DAY, summary_path=summ, verify=None)
    return charts(spark.read.parquet(summ), GAUGE_DATE)["toc_ranking"]


def queries() -> dict[str, Query]:
    return {**analytics_queries(), **feed_and_load_queries(), **summary_queries()}
