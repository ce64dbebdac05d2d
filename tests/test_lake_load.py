"""Lake layouts, NDJSON, and the daily load with day replacement."""

import json

import pytest
from pyspark.sql import functions as F

from trackside.plans.ingest import ingest_frames
from trackside.plans.load_day import ensure_compatible, load_day, load_days
from trackside.sources.lake import read_lake, read_ndjson, read_objects
from trackside.sources.standin import standin_frames, standin_movements
from trackside.operators.flatten import complete_rows, flatten

from conftest import SF_SMALL


def _local(path: str) -> str:
    return path.replace("file:", "")


@pytest.fixture(scope="module")
def lake(spark):
    from trackside.session import scratch_dir
    base = scratch_dir(spark, "lake")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    stats = ingest_frames(standin_frames(ev), base, processed_at="P")
    return base, stats, standin_movements(ev, processed_at="P")


def test_ingest_counts(lake):
    _, stats, _ = lake
    assert stats["ok"] == 801 and stats["bad_frame"] == 1 and stats["bad_element"] == 20


def test_day_read_lists_that_day_alone(spark, lake):
    base, _, _ = lake
    df = read_lake(spark, base, "2024-01-05")
    assert {p.split("/day=")[1][:2] for p in df.inputFiles()} == {"05"}
    assert [tuple(r) for r in df.select("year", "month", "day").distinct().collect()] == [("2024", "01", "05")]
    d = flatten(df).select("uk_date").distinct().collect()
    assert [r.uk_date.isoformat() for r in d] == ["2024-01-05"]


def test_load_two_days_replay_one_keeps_other(spark, lake, scratch):
    base, _, m = lake
    table = scratch("table")
    r1 = load_days(spark, base, table, ["2024-01-05", "2024-01-06"], verify="table")
    want5 = m.where("uk_date = '2024-01-05'").count()
    want6 = m.where("uk_date = '2024-01-06'").count()
    assert r1.written == want5 + want6 and r1.table_rows == want5 + want6
    r2 = load_day(spark, base, table, "2024-01-05")
    assert r2.deleted == want5 and r2.written == want5 == r2.day_rows
    assert r2.table_rows is None
    t = spark.read.parquet(table)
    assert t.schema["train_id"].metadata["comment"]          # docs survive the write
    assert t.where("uk_date = '2024-01-06'").count() == want6
    assert t.count() == want5 + want6
    # replay = first load, row for row
    assert t.exceptAll(m.where("uk_date in ('2024-01-05','2024-01-06')")).count() == 0


def test_empty_day_keeps_old_data(spark, lake, scratch):
    base, _, m = lake
    table = scratch("table")
    load_days(spark, base, table, ["2024-01-07"])
    before = spark.read.parquet(table).count()
    empty = scratch("emptylake")
    r = load_day(spark, empty, table, "2024-01-07")
    assert r.status.startswith("aborted") and r.deleted == 0
    assert spark.read.parquet(table).count() == before


def test_incompatible_table_dropped_only_on_request(spark, scratch):
    table = scratch("oldtable")
    spark.createDataFrame([("x", "{}")], "event_type string, raw_data string") \
        .write.mode("overwrite").parquet(table)
    with pytest.raises(ValueError):
        ensure_compatible(spark, table)
    assert ensure_compatible(spark, table, allow_drop=True) == "dropped"
    assert ensure_compatible(spark, table) == "absent"


def test_whole_objects_both_layouts_and_damage(spark, scratch):
    d = _local(scratch("objects"))
    body = {"event_type": "ARRIVAL", "toc_id": "88", "variation_status": "LATE",
            "train_id": "T9", "actual_timestamp": "1704067207179", "train_terminated": "true"}
    env = {"message_type": "0003", "event_type": "ARRIVAL", "toc_id": "88",
           "variation_status": "LATE", "uk_datetime": "2024-01-01T00:00:07.179000+00:00",
           "timestamp": 1704067207.179, "processed_at": "P", "raw_data": body}
    with open(f"{d}/a.json", "w") as f:
        f.write(json.dumps(env, indent=2))
    with open(f"{d}/b.json", "w") as f:
        f.write(json.dumps(dict(body, train_id="T10"), indent=2))   # bare body layout
    with open(f"{d}/c.json", "w") as f:
        f.write('{"message_type": "0003", "raw_data": {')              # damaged
    objs = read_objects(spark, d)
    assert objs.where(~F.col("ok")).count() == 1
    rows = complete_rows(flatten(objs.where("ok"))).orderBy("train_id").collect()
    assert [r.train_id for r in rows] == ["T10", "T9"]
    assert rows[0].uk_datetime == rows[1].uk_datetime
    assert rows[0].timestamp == rows[1].timestamp == 1704067207.179
    assert rows[0].processed_at is None and rows[1].processed_at == "P"


def test_ndjson_blank_and_bad_lines(spark, scratch):
    d = _local(scratch("nd"))
    lines = [json.dumps({"event_type": "ARRIVAL", "raw_data": {"train_id": "A",
                                                                "actual_timestamp": "1"}}),
             "", "   ", "{broken", json.dumps({"event_type": "DEPARTURE",
                                               "raw_data": {"train_id": "B"}})]
    with open(f"{d}/day.json", "w") as f:
        f.write("\n".join(lines) + "\n")
    df = read_ndjson(spark, d)
    assert df.count() == 3
    assert df.where(~F.col("ok")).count() == 1
    assert sorted(r.event_type for r in df.where("ok").collect()) == ["ARRIVAL", "DEPARTURE"]


def test_append_then_replace(spark, lake, scratch):
    from trackside.plans.load_day import append_table, read_table
    base, _, m = lake
    table = scratch("append")
    day = m.where("uk_date = '2024-01-08'")
    append_table(day.drop("route"), table)          # missing column -> NULL, schema kept
    t = read_table(spark, table)
    assert t.count() == day.count() and t.where("route IS NOT NULL").count() == 0
    load_day(spark, base, table, "2024-01-08")      # replacement restores the full rows
    assert read_table(spark, table).exceptAll(day).count() == 0


def test_summer_midnight_goes_to_next_london_day(spark, scratch):
    """Delete, load and partition all use the London date (no UTC/London split)."""
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    base, table = scratch("slake"), scratch("stable")
    ingest_frames(standin_frames(ev, shift_days=150), base, processed_at="P")
    m = standin_movements(ev, processed_at="P", shift_days=150)
    late = m.where(F.hour("actual_timestamp") == 23)          # 00:xx London, next day
    assert late.where(F.to_date("actual_timestamp") != F.col("uk_date")).count() == late.count() > 0
    load_days(spark, base, table)
    day = late.select("uk_date").first().uk_date.isoformat()
    r = load_day(spark, base, table, day)                     # replay that London day
    t = spark.read.parquet(table)
    assert r.deleted == r.written == m.where(F.col("uk_date") == day).count()
    assert t.count() == m.count() and t.exceptAll(m).count() == 0


def test_catalog_views_over_table(spark, lake, scratch):
    from trackside.operators.views import register_catalog_views
    base, _, m = lake
    table = scratch("vtable")
    load_days(spark, base, table)
    names = register_catalog_views(spark, table, scratch("dbs"))
    stg = spark.table(names[0])
    assert stg.count() == m.count() and len(stg.columns) == 29
    got = {r[0] for r in spark.table(names[1]).select("train_operating_company").distinct()
           .collect()}
    assert "Unknown" in got and "Southeastern" in got


def test_ndjson_write_reports_empty(spark, scratch):
    from trackside.sinks.lake import write_ndjson
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    assert write_ndjson(df, scratch("nd1")) is not None
    assert write_ndjson(df.limit(0), scratch("nd2")) is None


def test_ingest_counters(lake):
    _, stats, _ = lake
    assert stats["processed"] == stats["written"] == stats["ok"] and stats["failed"] == 0
    assert stats["frames"] == 21                  # 20 frames of movements + the bad frame


def test_parquet_lake_loads_the_same_table(spark, scratch):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    lake, table = scratch("plake"), scratch("ptable")
    ingest_frames(standin_frames(ev), lake, processed_at="P", lake_format="parquet")
    r = load_days(spark, lake, table, lake_format="parquet")
    m = standin_movements(ev, processed_at="P")
    t = spark.read.parquet(table)
    assert r.written == m.count() == t.count() and t.exceptAll(m).count() == 0
    assert read_lake(spark, lake, "2024-01-05", fmt="parquet").count() > 0


def test_summary_maintained_by_the_load(spark, lake, scratch):
    from trackside.operators import analytics as A
    from trackside.operators.summary import movement_summary
    base, _, m = lake
    table, summ = scratch("stable"), scratch("summary")
    load_days(spark, base, table, summary_path=summ)
    load_day(spark, base, table, "2024-01-05", summary_path=summ)      # replay one day
    kept = spark.read.parquet(summ)
    fresh = movement_summary(spark.read.parquet(table))
    assert kept.count() == fresh.count() == movement_summary(m.drop("uk_date")).count()
    for f in [A.toc_ranking, A.weekly_calendar, A.daily_trends]:
        assert f(kept).exceptAll(f(m)).count() == 0 == f(m).exceptAll(f(kept)).count()


def test_a_missing_lake_loads_nothing(spark, scratch):
    table = scratch("table")
    r = load_day(spark, scratch("none") + "/not/there", table, "2024-01-07")
    assert (r.status, r.total_rows, r.written, r.day_rows) == ("aborted: no rows", 0, 0, 0)


def test_pretty_objects_need_the_switch_and_damage_is_counted(spark, scratch):
    d = _local(scratch("objects"))
    import os
    os.makedirs(f"{d}/year=2024/month=01/day=01")
    body = {"event_type": "ARRIVAL", "toc_id": "88", "train_id": "T9", "actual_timestamp": "1704067207179"}
    for name, text in {"a": json.dumps({"raw_data": body}, indent=2), "b": json.dumps(body, indent=2),
                       "c": '{"raw_data": {'}.items():
        with open(f"{d}/year=2024/month=01/day=01/{name}.json", "w") as f:
            f.write(text)
    r = load_days(spark, d, scratch("t1"), ["2024-01-01"], whole_objects=True)
    assert (r.status, r.written, r.invalid_objects) == ("loaded", 2, 1)
    r = load_days(spark, d, scratch("t2"), ["2024-01-01"])
    assert r.written == 0 and r.invalid_objects > 2          # said, not silent


def test_counters_after_dedup_and_last_writer(spark, scratch):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    base, table = scratch("dlake"), scratch("dtable")
    for _ in range(2):
        ingest_frames(standin_frames(ev), base, processed_at="P")
    m = standin_movements(ev, processed_at="P")
    r = load_days(spark, base, table, dedup_keys=["train_id", "loc_stanox", "event_type", "actual_timestamp"])
    assert r.written == spark.read.parquet(table).count() < 2 * m.count() and r.deleted == 0
    again = load_days(spark, base, table, ["2024-01-05", "2031-01-01"])
    assert again.status == "partly loaded"
    assert again.day_status == {"2024-01-05": "loaded", "2031-01-01": "aborted: no complete row"}
    assert again.deleted < again.written == 2 * m.where("uk_date = '2024-01-05'").count()
    last = scratch("llake")
    s = ingest_frames(standin_frames(ev), last, processed_at="P", last_writer_wins=True)
    assert s["written"] + s["replaced"] == s["ok"] and s["written"] == read_lake(spark, last).count()


def test_a_whole_lake_load_scans_the_lake_once(spark, scratch, monkeypatch):
    """Files that land after the scan change neither the table nor the report; dates far off are named too."""
    import json
    from trackside.plans import load_day as L
    from trackside.plans.ingest import ingest_frames
    ms = {"2024-01-01": 1704067207179, "2024-01-03": 1704240007179, "1950-06-01": -618105600000, "2100-01-01": 4102444800000}

    def land(lake, *days):
        text = json.dumps([{"header": {"msg_type": "0003"}, "body": {"actual_timestamp": str(ms[d]), "toc_id": "88", "train_id": "T"}} for d in days])
        ingest_frames(spark.createDataFrame([(text,)], "value string"), lake, processed_at="P")

    lake, table = scratch("lake"), scratch("table")
    land(lake, "2024-01-01", "2024-01-01", "2024-01-03")
    get = L.days_of

    def late(observed):
        land(lake, "2100-01-01", "2024-01-03")       # lands when the table is written, before the report is made
        return get(observed)

    monkeypatch.setattr(L, "days_of", late)
    r = L.load_days(spark, lake, table)
    assert r.day_status == {"2024-01-01": "loaded", "2024-01-03": "loaded"} and (r.written, r.day_rows) == (3, 3)
    monkeypatch.undo()
    land(lake, "1950-06-01")
    r = L.load_days(spark, lake, table)
    assert sorted(r.day_status) == sorted(ms) and r.written == 6 and r.deleted == 3
