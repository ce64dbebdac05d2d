"""Streaming lanes (availableNow) and the train-describer projection."""

import json


from trackside.operators.describer import td_berth_events
from trackside.sources.feed import read_frames
from trackside.streaming.ingest import ingest_observed


def test_stream_counters_in_progress(spark, scratch):
    src = scratch("frames").replace("file:", "")
    with open(f"{src}/f.txt", "w") as f:
        f.write(json.dumps([{"header": {"msg_type": "0003"}, "body": {"actual_timestamp": "1"}},
                            {"header": {"msg_type": "0001"}, "body": {}}, 5]) + "\n")
        f.write("not json\n")
    stream = ingest_observed(read_frames(spark, src, streaming=True), name="live")
    q = (stream.writeStream.format("noop").option("checkpointLocation", scratch("ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    metrics = q.lastProgress["observedMetrics"]["live"]
    assert (metrics["ok"], metrics["skipped"], metrics["bad_element"], metrics["bad_frame"]) \
        == (1, 1, 1, 1)


def test_td_berth_projection(spark):
    frame = json.dumps([
        {"CA_MSG": {"msg_type": "CA", "time": "1719790200000", "area_id": "AB",
                    "descr": "1A01", "from": "0101", "to": "0103"}},
        {"CB_MSG": {"msg_type": "CB", "time": "1719790200000", "area_id": "AB", "from": "0101"}},
        {"CT_MSG": {"msg_type": "CT", "time": "1719790200000", "area_id": "AB"}},
        {"SF_MSG": {"msg_type": "SF", "time": "1719790200000", "area_id": "AB"}},
    ])
    df = spark.createDataFrame([(frame,)], "value string")
    rows = td_berth_events(df).collect()
    assert [(r.msg_type, r.descr, r.from_berth, r.to_berth) for r in rows] == [
        ("CA", "1A01", "0101", "0103"), ("CB", "", "0101", "")]
    assert rows[0].uk_time == "2024-07-01 00:30:00"      # 23:30 UTC in summer time


def test_topic_lane_two_stages(spark, scratch):
    """Stage 1 publishes every message (unfiltered); stage 2 lands the movements."""
    from trackside.sources.feed import kafka_options, read_topic, single_message_frames
    from trackside.streaming.ingest import stream_ingest, stream_publish
    from trackside.sources.lake import read_lake
    src = scratch("frames").replace("file:", "")
    msgs = [{"header": {"msg_type": "0003"},
             "body": {"actual_timestamp": "1704067207179", "toc_id": "88", "train_id": "T1"}},
            {"header": {"msg_type": "0001"}, "body": {}}]
    with open(f"{src}/f.txt", "w") as f:
        f.write(json.dumps(msgs + [5]) + "\n")
    topic = scratch("topic")
    q = stream_publish(read_frames(spark, src, streaming=True), scratch("ck1"),
                       {"path": topic}, fmt="text")
    q.awaitTermination()
    assert spark.read.text(topic).count() == 2            # both messages, not the 5
    records = read_topic(spark, {"path": topic}, streaming=True, fmt="text")
    lake = scratch("lake")
    q = stream_ingest(single_message_frames(records), lake, scratch("ck2"), processed_at="P")
    q.awaitTermination()
    rows = read_lake(spark, lake).collect()
    assert [r.raw_data["train_id"] for r in rows] == ["T1"]
    opts = kafka_options("broker:9092", "movements", group_id="g")
    assert opts["subscribe"] == "movements" and opts["startingOffsets"] == "earliest"


def test_stream_restart_is_exactly_once(spark, scratch):
    """A restart on the same checkpoint lands only the new frames (T2)."""
    from trackside.sources.lake import read_lake
    from trackside.streaming.ingest import stream_ingest
    src = scratch("frames").replace("file:", "")
    lake, ck = scratch("lake"), scratch("ck")

    def frame(train):
        return json.dumps([{"header": {"msg_type": "0003"},
                            "body": {"actual_timestamp": "1704067207179", "toc_id": "88",
                                     "train_id": train}}]) + "\n"

    def run():
        q = stream_ingest(read_frames(spark, src, streaming=True), lake, ck, processed_at="P")
        q.awaitTermination()

    with open(f"{src}/a.txt", "w") as f:
        f.write(frame("A") + frame("B"))
    run()
    run()                                        # nothing new: nothing landed twice
    assert read_lake(spark, lake).count() == 2
    with open(f"{src}/b.txt", "w") as f:
        f.write(frame("C"))
    run()
    got = sorted(r.raw_data["train_id"] for r in read_lake(spark, lake).collect())
    assert got == ["A", "B", "C"]


def test_append_table_late_rows_and_restart(spark, scratch):
    """Append-only table: a late movement lands in its old day; restarts add nothing twice."""
    from trackside.streaming.ingest import stream_to_table_append
    src = scratch("frames").replace("file:", "")
    table, ck = scratch("table"), scratch("ck")

    def frame(train, ms):
        return json.dumps([{"header": {"msg_type": "0003"},
                            "body": {"actual_timestamp": str(ms), "toc_id": "88",
                                     "train_id": train, "event_type": "ARRIVAL"}}]) + "\n"

    def run():
        stream_to_table_append(read_frames(spark, src, streaming=True), table, ck,
                               processed_at="P").awaitTermination()

    with open(f"{src}/a.txt", "w") as f:
        f.write(frame("A", 1719871200000))             # 2024-07-01 22:00 UTC
    run()
    with open(f"{src}/b.txt", "w") as f:
        f.write(frame("LATE", 1719784800000))          # 2024-06-30, arrives later
    run()
    run()
    t = spark.read.parquet(table)
    got = sorted((r.train_id, r.uk_date.isoformat()) for r in t.collect())
    assert got == [("A", "2024-07-01"), ("LATE", "2024-06-30")]
    assert t.where("uk_date = '2024-06-30'").count() == 1          # partition pruning works


def test_td_bad_frames_are_counted_and_bad_times_are_null(spark):
    from trackside.operators.describer import td_frame_counts
    far = json.dumps([{"CA_MSG": {"msg_type": "CA", "time": "9223372036854775807", "area_id": "AB"}}])
    df = spark.createDataFrame([(far,), ("not json",), ('{"CA_MSG": {}}',), ("[]",)], "value string")
    assert tuple(td_frame_counts(df).first()) == (4, 2, 1)
    assert [r.uk_time for r in td_berth_events(df).collect()] == [None]


def _movement(train, ms=1704067207179):
    return json.dumps([{"header": {"msg_type": "0003"},
                        "body": {"actual_timestamp": str(ms), "toc_id": "88", "train_id": train}}]) + "\n"


def test_a_new_checkpoint_and_a_batch_leave_the_lake_whole(spark, scratch):
    from trackside.plans.ingest import ingest_frames
    from trackside.sources.lake import read_lake
    from trackside.streaming.ingest import stream_ingest, stream_to_table
    lake, table = scratch("lake"), scratch("table")
    for train in "AB":
        src = scratch("frames").replace("file:", "")
        with open(f"{src}/f.txt", "w") as f:
            f.write(_movement(train))
        stream_to_table(read_frames(spark, src, streaming=True), lake, table, scratch("ck"),
                        processed_at="P").awaitTermination()
    assert sorted(r.train_id for r in spark.read.parquet(table).collect()) == ["A", "B"]
    ingest_frames(spark.createDataFrame([(_movement("C"),)], "value string"), lake, processed_at="P")
    src = scratch("frames").replace("file:", "")
    with open(f"{src}/f.txt", "w") as f:
        f.write(_movement("D"))
    stream_ingest(read_frames(spark, src, streaming=True), lake, scratch("ck"), processed_at="P").awaitTermination()
    assert sorted(r.raw_data["train_id"] for r in read_lake(spark, lake).collect()) == ["A", "B", "C", "D"]


def test_no_other_writer_into_a_file_sinks_lake(spark, scratch):
    import pytest
    from trackside.plans.ingest import ingest_frames
    lake = scratch("lake")
    spark.createDataFrame([("x",)], "value string").write.text(lake + "/_spark_metadata")
    with pytest.raises(ValueError, match="file sink"):
        ingest_frames(spark.createDataFrame([(_movement("C"),)], "value string"), lake, processed_at="P")


def test_out_of_range_times_are_bad_and_do_not_stop_a_stream(spark, scratch):
    from trackside.sources.lake import read_lake
    from trackside.streaming.ingest import stream_ingest
    src = scratch("frames").replace("file:", "")
    with open(f"{src}/f.txt", "w") as f:
        for ms in ("9223372036854775807", "-9223372036854775808", "253402300800000", "1704067207179"):
            f.write(_movement("T", ms))
    lake = scratch("lake")
    q = stream_ingest(read_frames(spark, src, streaming=True), lake, scratch("ck"), processed_at="P")
    q.awaitTermination()
    assert read_lake(spark, lake).count() == 1
    seen = [p["observedMetrics"]["ingest"] for p in q.recentProgress if p["observedMetrics"].get("ingest")]
    assert sum(m["bad_time"] for m in seen) == 3


def test_live_counters_count_batches_whose_reports_are_gone(spark, monkeypatch):
    from conftest import SF_SMALL
    from trackside import registry
    from trackside.operators.decode import decode_frames
    from trackside.session import scratch_dir

    def five_files(spark, sf_dir, label):
        path = scratch_dir(spark, label)
        registry._frames(spark, sf_dir).select("value").repartition(5).write.mode("append").text(path)
        return path

    monkeypatch.setattr(registry, "_frames_dir", five_files)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        got = registry.queries()["live_counters"](spark, SF_SMALL).first().asDict()
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    want = {r.status: r["count"] for r in decode_frames(registry._frames(spark, SF_SMALL)).groupBy("status").count().collect()}
    assert {k: v for k, v in got.items() if v} == want and want["ok"] > 0
