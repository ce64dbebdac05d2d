"""Last writer wins by arrival (K2): inside a run, over micro-batches, over runs, whatever the files' times."""

import json
import os
import shutil
import time

from pyspark.sql import functions as F

from trackside.plans.ingest import ingest_frames
from trackside.plans.load_day import load_days
from trackside.sinks.arrivals import claim
from trackside.sources.feed import read_frames
from trackside.sources.lake import last_writer, read_lake
from trackside.streaming.ingest import stream_ingest

MS = 1704067207179


def frame(*trains, ms=MS, toc="88"):
    return json.dumps([{"header": {"msg_type": "0003"},
                        "body": {"actual_timestamp": str(ms), "toc_id": toc, "train_id": t}} for t in trains]) + "\n"


def put(folder, name, *frames):
    with open(f"{folder}/{name}", "w") as f:
        f.writelines(frames)


def last(spark, lake):
    return [r.raw_data["train_id"] for r in last_writer(read_lake(spark, lake)).collect()]


def test_one_run_by_file_line_and_position(spark, scratch):
    src, lake = scratch("frames").replace("file:", ""), scratch("lake")
    put(src, "a.txt", frame("A1", "A2"), frame("A3", "A4"))
    put(src, "b.txt", frame("B1"), frame("B2", "B3"))
    ingest_frames(read_frames(spark, src), lake, processed_at="P")
    rows = read_lake(spark, lake).orderBy("arrival").collect()
    assert [r.raw_data["train_id"] for r in rows] == ["A1", "A2", "A3", "A4", "B1", "B2", "B3"]
    assert last(spark, lake) == ["B3"]


def test_frames_without_places_have_no_ties(spark, scratch):
    lake = scratch("lake")
    frames = spark.createDataFrame([(frame(f"T{k:02}"),) for k in range(40)], "value string").coalesce(1)
    ingest_frames(frames, lake, processed_at="P")
    assert read_lake(spark, lake).select("arrival").distinct().count() == 40
    assert last(spark, lake) == ["T39"]


def test_the_run_keeps_the_last_of_each_name(spark, scratch):
    src, lake = scratch("frames").replace("file:", ""), scratch("lake")
    put(src, "a.txt", *[frame(f"T{k}") for k in range(9)], frame("other", toc="20"))
    stats = ingest_frames(read_frames(spark, src), lake, processed_at="P", last_writer_wins=True)
    assert (stats["written"], stats["replaced"]) == (2, 8)
    assert sorted(r.raw_data["train_id"] for r in read_lake(spark, lake).collect()) == ["T8", "other"]


def test_two_micro_batches_two_runs_and_a_stream_between(spark, scratch):
    src, more, lake, ck = (scratch("frames").replace("file:", ""), scratch("more").replace("file:", ""), scratch("lake"), scratch("ck"))

    def stream():
        stream_ingest(read_frames(spark, src, streaming=True), lake, ck, processed_at="P").awaitTermination()

    put(src, "z.txt", frame("first"))
    stream()
    put(src, "a.txt", frame("second"))       # a smaller name, a later batch
    stream()
    assert last(spark, lake) == ["second"]
    put(more, "0.txt", frame("third"))
    ingest_frames(read_frames(spark, more), lake, processed_at="A")
    assert last(spark, lake) == ["third"]
    put(src, "0.txt", frame("fourth"))
    stream()
    assert last(spark, lake) == ["fourth"]
    assert len(read_lake(spark, lake).collect()) == 4


def test_copied_files_with_other_times_give_the_same(spark, scratch):
    src, lake = scratch("frames").replace("file:", ""), scratch("lake")
    for k in range(4):
        put(src, "f.txt", frame(f"T{k}", f"U{k}"), frame(f"V{k}"))
        ingest_frames(read_frames(spark, f"{src}/f.txt"), lake, processed_at="P")
    copy = scratch("copy")
    shutil.copytree(lake.replace("file:", ""), copy.replace("file:", ""), dirs_exist_ok=True)
    files = sorted((p, f) for p, _, names in os.walk(copy.replace("file:", "")) for f in names if f.endswith(".json"))
    for k, (p, f) in enumerate(reversed(files)):
        os.utime(f"{p}/{f}", (time.time() - 1000 * k,) * 2)
    assert last(spark, lake) == last(spark, copy) == ["V3"]
    table = scratch("table")
    load_days(spark, copy, table, last_writer_wins=True)
    assert [r.train_id for r in spark.read.parquet(table).collect()] == ["V3"]


def test_a_number_is_kept_and_grows(spark, scratch):
    base = scratch("lake")
    one = claim(spark, base, "s", "0")
    assert claim(spark, base, "s", "0") == one < claim(spark, base, "run", "x") < claim(spark, base, "s", "1")
    two = claim(spark, base, "s", "1")
    assert claim(spark, base, "s", "2") > two
    assert len(os.listdir(f"{base.replace('file:', '')}/_arrivals")) <= 4   # one for each writer (and checksum files)


def test_objects_from_before_arrivals_come_first(spark, scratch):
    lake = scratch("lake")
    old = spark.createDataFrame([("0003", "88", "P", {"actual_timestamp": str(MS), "train_id": "old"}, "20240101-000007-88.json")],
                                "message_type string, toc_id string, processed_at string, raw_data map<string,string>, object_name string")
    (old.withColumns({"year": F.lit("2024"), "month": F.lit("01"), "day": F.lit("01")}).write.mode("append")
     .partitionBy("year", "month", "day").json(lake))
    ingest_frames(spark.createDataFrame([(frame("new"),)], "value string"), lake, processed_at="A")
    assert len(read_lake(spark, lake).collect()) == 2 and last(spark, lake) == ["new"]
