"""Compaction: the same rows in few sorted files, whatever comes meanwhile or breaks."""

import json
import os

import pytest
from pyspark.sql import functions as F

from trackside.plans import compact as C
from trackside.schema import TABLE_COLUMNS
from trackside.session import jvm_path
from trackside.sources.feed import read_frames
from trackside.streaming.exact import stream_to_table_exact
from trackside.streaming.ingest import append_batch, stream_to_table_append

T0, DAY = 1704067200000, 86_400_000


def frame(k, days=2):
    return json.dumps([{"header": {"msg_type": "0003"}, "body": {"actual_timestamp": str(T0 + d * DAY + 1000 * (97 * k % 89) + k), "toc_id": "88",
                                                                 "train_id": f"T{k}"}} for d in range(days)]) + "\n"


def stream(spark, src, table, ck, start=stream_to_table_append):
    start(read_frames(spark, src, streaming=True, max_files_per_trigger=1), table, ck, "P").awaitTermination()


def put(src, *names):
    for k in names:
        with open(f"{src.replace('file:', '')}/{k:03}.txt", "w") as f:
            f.write(frame(k))


def rows(spark, table):
    return sorted((r.train_id, r.actual_timestamp, r.uk_date) for r in spark.read.parquet(table).select(*TABLE_COLUMNS).collect())


def count_files(spark, table):
    return {d: len(C.day_files(spark, table, d)) for d in C.table_days(spark, table)}


@pytest.mark.parametrize("start", [stream_to_table_append, stream_to_table_exact])
def test_stream_table_is_packed_and_batches_may_run_again(spark, scratch, start):
    src, table, ck = scratch("frames"), scratch("table"), scratch("ck")
    put(src, *range(8))
    stream(spark, src, table, ck, start)
    want = rows(spark, table)
    assert len(want) == 16 and count_files(spark, table) == {"2024-01-01": 8, "2024-01-02": 8}     # one file a batch and day
    assert C.compact(spark, table) == {"2024-01-01": (7, 1), "2024-01-02": (7, 1)}    # the newest batch stays as it is
    assert rows(spark, table) == want and count_files(spark, table) == {"2024-01-01": 2, "2024-01-02": 2}
    (stream_name, number), = C.newest_batches(spark, table)
    again = spark.read.parquet(table).where(F.col("batch") == f"{stream_name}-{number}").drop("batch").select(*TABLE_COLUMNS).cache()
    again.count()
    append_batch(again, table, f"{stream_name}-{number}")       # the last batch runs again
    assert rows(spark, table) == want
    put(src, 8, 9)
    stream(spark, src, table, ck, start)
    assert len(rows(spark, table)) == 20
    C.compact(spark, table, ["2024-01-02", "2031-01-01"])
    assert len(rows(spark, table)) == 20 and count_files(spark, table) == {"2024-01-01": 4, "2024-01-02": 2}
    assert C.compact(spark, table, ["2024-01-02"]) == {}
    for day in ("2024-01-01", "2024-01-02"):
        for n in C.day_files(spark, table, day):
            times = [r[0] for r in spark.read.parquet(f"{table}/uk_date={day}/{n}").select("actual_timestamp").collect()]
            assert times == sorted(times)


def test_files_are_as_many_as_their_bytes_need(spark, scratch):
    table = scratch("table")
    df = spark.range(4000).select(F.timestamp_millis(F.lit(T0) + F.pmod(F.col("id") * 7919, F.lit(80_000_000))).alias("actual_timestamp"),
                                  F.sha2(F.col("id").cast("string"), 256).alias("train_id"), F.lit("2024-01-01").cast("date").alias("uk_date"))
    df.repartition(20).write.partitionBy("uk_date").parquet(table + "/t")
    sizes = C.day_files(spark, table + "/t", "2024-01-01")
    target = sum(sizes.values()) // 3
    before, after = C.compact(spark, table + "/t", target_bytes=target)["2024-01-01"]
    assert (before, after) == (20, 4) and count_files(spark, table + "/t") == {"2024-01-01": 4}
    assert spark.read.parquet(table + "/t").exceptAll(df.select("actual_timestamp", "train_id", "uk_date")).count() == 0
    assert spark.read.parquet(table + "/t").count() == 4000


def test_files_that_come_meanwhile_stay(spark, scratch, monkeypatch):
    src, table, ck = scratch("frames"), scratch("table"), scratch("ck")
    put(src, *range(4))
    stream(spark, src, table, ck)
    swap = C._swap

    def late(*a):
        if a[2] == "2024-01-01":
            put(src, 4)
            stream(spark, src, table, ck)
        swap(*a)

    monkeypatch.setattr(C, "_swap", late)
    C.compact(spark, table)
    assert len(rows(spark, table)) == 10


@pytest.mark.parametrize("steps", [0, 1, 2, 3])
def test_a_swap_that_breaks_is_completed(spark, scratch, monkeypatch, steps):
    src, table, ck = scratch("frames"), scratch("table"), scratch("ck")
    put(src, *range(4))
    stream(spark, src, table, ck)
    want = rows(spark, table)

    class Dies:
        """A file system that fails after some renames and deletes."""

        def __init__(self, fs):
            self.fs, self.left = fs, steps

        def __getattr__(self, name):
            if name in ("rename", "delete"):
                if not self.left:
                    raise OSError("gone")
                self.left -= 1
            return getattr(self.fs, name)

    real, dies = jvm_path, []

    def path(s, p):
        fs, at = real(s, p)
        if not dies:
            dies.append(Dies(fs))
        return dies[0], at

    with monkeypatch.context() as mp:
        swap = C._swap

        def breaks(*a):
            mp.setattr(C, "jvm_path", path)
            swap(*a)

        mp.setattr(C, "_swap", breaks)
        with pytest.raises(OSError):
            C.compact(spark, table, ["2024-01-01"])
    C.finish_swaps(spark, table)
    assert rows(spark, table) == want
    C.compact(spark, table)
    assert rows(spark, table) == want and set(count_files(spark, table).values()) == {2}
    assert not os.listdir(f"{table.replace('file:', '')}/{C.WORK}")


def test_a_rewrite_that_breaks_is_forgotten(spark, scratch):
    src, table, ck = scratch("frames"), scratch("table"), scratch("ck")
    put(src, *range(3))
    stream(spark, src, table, ck)
    os.makedirs(f"{table.replace('file:', '')}/{C.WORK}/2024-01-01-x/new")
    want = rows(spark, table)
    C.compact(spark, table)
    assert rows(spark, table) == want


def test_nothing_to_do(spark, scratch):
    assert C.compact(spark, scratch("none") + "/t") == {}
