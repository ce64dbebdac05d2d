"""Live gauge, exact duplicate control, quarantine lanes and the progress table."""

import json
import os

import pytest
from pyspark.sql import functions as F

from trackside.operators import analytics as A
from trackside.operators.decode import decode_frames, frames_to_envelopes
from trackside.operators.flatten import complete_rows, flatten
from trackside.schema import TABLE_COLUMNS
from trackside.sinks.lanes import movements_lane, read_rejects
from trackside.sources.feed import read_frames
from trackside.sources.lake import read_lake
from trackside.streaming import exact
from trackside.streaming.exact import append_new, stream_to_table_exact
from trackside.streaming.gauge import gauge_days, live_gauge, stream_gauge, upsert_days
from trackside.streaming.ingest import DEDUP_KEYS, batch_name, counter_totals, stream_ingest
from trackside.streaming.progress import ProgressTable, progress_totals, read_progress, settled

DAY = 86_400_000
T0 = 1704067200000      # 2024-01-01


def movement(ms, train="T1", status="ON TIME", **body):
    return {"header": {"msg_type": "0003"}, "body": {"actual_timestamp": str(ms), "toc_id": "88", "train_id": train,
                                                     "variation_status": status, **body}}


def put(src, name, *frames):
    with open(f"{src.replace('file:', '')}/{name}", "w") as f:
        f.writelines((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in frames)


def batch_gauge(spark, src):
    m = complete_rows(flatten(frames_to_envelopes(read_frames(spark, src))))
    return m, sorted((r.date, r.movements, r.on_time) for r in m.groupBy(F.to_date("actual_timestamp").alias("date")).agg(
        F.count("*").alias("movements"), F.count_if(F.col("variation_status") == "ON TIME").alias("on_time")).collect())


def test_gauge_follows_late_frames_and_restarts(spark, scratch):
    src, gauge, ck = scratch("frames"), scratch("gauge"), scratch("ck")

    def run():
        stream_gauge(read_frames(spark, src, streaming=True, max_files_per_trigger=1), gauge, ck).awaitTermination()
        m, want = batch_gauge(spark, src)
        assert sorted(tuple(r)[:3] for r in gauge_days(spark, gauge).collect()) == want
        for day in ("2024-01-01", "2024-01-03", "2024-02-10", "2031-01-01"):
            assert live_gauge(spark, gauge, day).collect() == A.realtime_gauge(m, day).collect()

    put(src, "1.txt", [movement(T0), movement(T0 + DAY - 1, status="LATE"), movement(T0 + 2 * DAY)])
    run()
    put(src, "2.txt", [movement(T0 + 40 * DAY, status="LATE")], "not json")
    put(src, "3.txt", [movement(T0 + 5, status="LATE"), 5, {"header": {"msg_type": "0001"}}])    # 40 days late
    run()
    put(src, "4.txt", [movement(T0 + 2 * DAY + 1, status=None), movement(T0 + 40 * DAY)])
    run()
    run()     # nothing new


def test_gauge_rows_are_replaced_not_added(spark, scratch):
    gauge = scratch("gauge")
    rows = spark.createDataFrame([("2024-01-01", 5, 2)], "d string, movements long, on_time long").select(
        F.to_date("d").alias("date"), "movements", "on_time")
    upsert_days(rows, gauge, "s1", 0)
    upsert_days(rows, gauge, "s1", 0)         # the batch ran again
    upsert_days(rows.withColumn("movements", F.lit(8).cast("long")), gauge, "s1", 1)
    upsert_days(rows, gauge, "s2", 0)         # another stream, other frames
    assert [tuple(r)[1:] for r in gauge_days(spark, gauge).collect()] == [(13, 4, 30.77)]


def test_gauge_state_is_bounded_by_the_delay(spark, scratch):
    """Days that the watermark has passed leave the state; what comes for them later is counted as dropped."""
    src, gauge, ck, progress = scratch("frames"), scratch("gauge"), scratch("ck"), scratch("progress")
    for k in range(6):
        put(src, f"{k}.txt", [movement(T0 + 10 * k * DAY)])
    listener = ProgressTable(spark, progress)
    spark.streams.addListener(listener)
    try:
        stream_gauge(read_frames(spark, src, streaming=True, max_files_per_trigger=1), gauge, ck, delay="1 day").awaitTermination()
        put(src, "late.txt", [movement(T0)])
        q = stream_gauge(read_frames(spark, src, streaming=True), gauge, ck, delay="1 day")
        q.awaitTermination()
        settled(spark)
    finally:
        spark.streams.removeListener(listener)
    reports = read_progress(spark, progress).where(F.col("query") == str(q.id))
    most, dropped = reports.agg(F.max("state_rows"), F.sum("dropped_late")).first()
    assert most <= 3 and dropped >= 1
    assert gauge_days(spark, gauge).count() == 7 - dropped      # files of one moment may come in any order


def test_gauge_of_an_absent_table(spark, scratch):
    path = scratch("gauge") + "/none"
    assert gauge_days(spark, path).collect() == []
    assert live_gauge(spark, path, "2024-01-01").collect()[0][0] is None


# -- exact duplicate control ---------------------------------------------------------------

def test_duplicates_later_than_any_watermark(spark, scratch):
    src, table, ck = scratch("frames"), scratch("table"), scratch("ck")
    once = [movement(T0 + k, train=f"T{k}", loc_stanox=None if k % 2 else "1") for k in range(6)]

    def run():
        stream_to_table_exact(read_frames(spark, src, streaming=True, max_files_per_trigger=1), table, ck, "P").awaitTermination()
        return sorted(r.train_id for r in spark.read.parquet(table).collect())

    put(src, "1.txt", once[:4], once[:2])                          # repeated inside a batch
    assert run() == ["T0", "T1", "T2", "T3"]
    put(src, "2.txt", [movement(T0 + 400 * DAY, train="late")])     # time moves on
    put(src, "3.txt", once, [movement(T0 + 1, train="T1", event_type="ARRIVAL")])
    assert run() == ["T0", "T1", "T1", "T2", "T3", "T4", "T5", "late"]
    put(src, "4.txt", [movement(T0 + 400 * DAY, train="late")], once)
    assert len(run()) == 8


def test_a_batch_that_runs_again_lands_once(spark, scratch):
    table = scratch("table")
    rows = complete_rows(flatten(frames_to_envelopes(spark.createDataFrame(
        [(json.dumps([movement(T0 + k, train=f"T{k}") for k in range(5)]),)], "value string"), processed_at="P"))).select(*TABLE_COLUMNS)
    for batch in ("s-0", "s-0", "s-1", "s-0"):
        append_new(rows, table, batch)
        assert spark.read.parquet(table).select(*DEDUP_KEYS).count() == 5


@pytest.mark.parametrize("sent", [0, 200_000])
def test_small_and_large_batches_keep_the_same_rows(spark, scratch, monkeypatch, sent):
    """Null keys, repeats inside a batch (the smallest row stays) and keys of the table, by either way."""
    monkeypatch.setattr(exact, "SENT_ROWS", sent)
    table = scratch("table")
    rows = lambda *ms: complete_rows(flatten(frames_to_envelopes(spark.createDataFrame(
        [(json.dumps(ms),)], "value string"), processed_at="P"))).select(*TABLE_COLUMNS)
    exact.append_new(rows(movement(T0, train="A", loc_stanox=None), movement(T0, train="B", route="2"),
                          movement(T0, train="B", route="1")), table, "s-0")
    exact.append_new(rows(movement(T0, train="A", loc_stanox=None, route="0"), movement(T0, train="B", route="0"),
                          movement(T0, train="C", route="4"), movement(T0, train="C", route="3")), table, "s-1")
    got = {(r.train_id, r.route, r.batch) for r in spark.read.parquet(table).collect()}
    assert {(t, b) for t, _, b in got} == {("A", "s-0"), ("B", "s-0"), ("C", "s-1")} and len(got) == 3
    assert {(t, r) for t, r, _ in got if t != "A"} == {("B", "1"), ("C", "3")}


def test_whole_rows_are_dealt_by_key_once(spark):
    """Repeats inside the batch and keys that are there fall out in one exchange, not one each."""
    rows = spark.range(10).selectExpr(*[f"{'id' if c in DEDUP_KEYS else 'null'} AS {c}" for c in TABLE_COLUMNS])
    new = exact.new_rows(rows, rows.where("train_id < 4").select(*DEDUP_KEYS), DEDUP_KEYS)
    plan = new._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Join") == 0 and new._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted(r.train_id for r in new.collect()) == [4, 5, 6, 7, 8, 9]


def test_only_touched_days_are_read(spark, scratch, monkeypatch):
    """A damaged file in another day does not matter: that day is not opened."""
    src, table, ck = scratch("frames"), scratch("table"), scratch("ck")
    put(src, "1.txt", [movement(T0)])
    stream_to_table_exact(read_frames(spark, src, streaming=True), table, ck, "P").awaitTermination()
    other = f"{table.replace('file:', '')}/uk_date=2023-12-01/batch=x"
    os.makedirs(other)
    with open(f"{other}/part-0.parquet", "w") as f:
        f.write("damaged")
    put(src, "2.txt", [movement(T0), movement(T0 + 1)])
    stream_to_table_exact(read_frames(spark, src, streaming=True), table, ck, "P").awaitTermination()
    assert spark.read.option("basePath", table).parquet(f"{table}/uk_date=2024-01-01").count() == 2


# -- quarantine lanes ----------------------------------------------------------------------

@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_lanes_hold_every_element_once(spark, scratch, fmt, monkeypatch):
    src, root, ck, counters = scratch("frames"), scratch("root"), scratch("ck"), scratch("counters")
    put(src, "1.txt", [movement(T0), 5, movement("soon"), {"header": {"msg_type": "0001"}, "body": {}}], "not [json")
    put(src, "2.txt", [movement(T0 + DAY, train="T2"), None, movement(None)], "{}")

    def run():
        stream_ingest(read_frames(spark, src, streaming=True), root, ck, "P", lake_format=fmt, lanes=True,
                      counters=counters).awaitTermination()

    from trackside.streaming import ingest
    land = ingest.land_batch

    def fails_after_writing(*a):
        land(*a)
        raise RuntimeError("lost after its write")

    monkeypatch.setattr(ingest, "land_batch", fails_after_writing)
    with pytest.raises(Exception):
        run()
    monkeypatch.setattr(ingest, "land_batch", land)
    run()                                           # the batch runs again
    put(src, "3.txt", [movement(T0, train="T3"), "x"])
    run()
    taken = read_lake(spark, movements_lane(root), fmt=fmt)
    assert sorted(r.raw_data["train_id"] for r in taken.collect()) == ["T1", "T2", "T3"]
    refused = read_rejects(spark, root, fmt).collect()
    assert sorted(((r.reason, r.pos, r.text) for r in refused if r.reason != "bad_time"), key=str) == [
        ("bad_element", 1, "5"), ("bad_element", 1, "x"), ("bad_element", 1, None),     # a JSON null has no text
        ("bad_frame", None, "not [json"), ("bad_frame", None, "{}")]
    late = [r for r in refused if r.reason == "bad_time"]
    assert sorted(json.loads(r.text)["body"]["actual_timestamp"] for r in late) == ["None", "soon"]
    assert {r.pos for r in late} == {2} and all(".txt#" in r.frame and r.rejected_at == "P" for r in refused)
    c = counter_totals(spark, counters).first()
    assert (c.ok, c.bad_time, c.bad_element, c.bad_frame, c.skipped) == (3, 2, 3, 2, 1)
    assert taken.count() + len(refused) + c.skipped == decode_frames(read_frames(spark, src)).count()
    days = read_lake(spark, movements_lane(root), "2024-01-02", fmt=fmt).collect()
    assert [r.raw_data["train_id"] for r in days] == ["T2"]


def test_no_rejects_no_lane(spark, scratch):
    src, root = scratch("frames"), scratch("root")
    put(src, "1.txt", [movement(T0)])
    stream_ingest(read_frames(spark, src, streaming=True), root, scratch("ck"), "P", lanes=True).awaitTermination()
    assert read_rejects(spark, root).collect() == []


# -- progress table ------------------------------------------------------------------------

def test_progress_of_more_batches_than_a_query_remembers(spark, scratch):
    src, progress, counters = scratch("frames"), scratch("progress"), scratch("counters")
    for k in range(112):
        put(src, f"{k:03}.txt", [movement(T0 + k), k] if k % 3 else "not json")
    listener = ProgressTable(spark, progress)
    spark.streams.addListener(listener)
    try:
        q = stream_ingest(read_frames(spark, src, streaming=True, max_files_per_trigger=1), scratch("lake"), scratch("ck"),
                          "P", counters=counters, query_name="many")
        q.awaitTermination()
        settled(spark)
    finally:
        spark.streams.removeListener(listener)
    rows = read_progress(spark, progress).where(F.col("query") == str(q.id))
    assert sorted(r.batch for r in rows.collect()) == list(range(112)) and rows.select("name").distinct().first()[0] == "many"
    assert progress_totals(rows).collect() == counter_totals(spark, counters).collect()
    assert rows.agg(F.sum("input_rows")).first()[0] == 112 and rows.where("duration_ms IS NULL").count() == 0


def test_progress_of_nothing(spark, scratch):
    assert read_progress(spark, scratch("p") + "/none").collect() == []


def test_batch_names_differ(spark, scratch):
    src, ck = scratch("frames"), scratch("ck")
    put(src, "1.txt", [movement(T0)])
    stream_ingest(read_frames(spark, src, streaming=True), scratch("lake"), ck, "P").awaitTermination()
    assert batch_name(spark, ck, 0) != batch_name(spark, ck, 1)
