"""The command-line jobs, end to end on files."""

from trackside import jobs
from trackside.sources.standin import standin_frames

from conftest import SF_SMALL


def test_jobs_end_to_end(spark, scratch):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    frames = scratch("frames")
    standin_frames(ev).select("value").write.mode("overwrite").text(frames)
    lake, table, ck, summ = scratch("lake"), scratch("table"), scratch("ck"), scratch("s")
    jobs.main(["ingest", "--frames", frames, "--lake", lake, "--checkpoint", ck, "--once"])
    r = jobs.main(["load-day", "--lake", lake, "--table", table, "--ds", "2024-01-05",
                   "--ds", "2024-01-06", "--summary", summ])
    assert r["status"] == "loaded" and r["written"] == r["day_rows"] > 0
    out = jobs.main(["query", "--table", table, "--name", "toc_ranking", "--out", scratch("q1")])["out"]
    assert "punctuality_percentage" in spark.read.json(out).columns
    out = jobs.main(["query", "--table", table, "--format", "parquet", "--out", scratch("q2"), "--sql",
                     "SELECT * FROM stg_movements"])["out"]
    assert spark.read.parquet(out).count() == r["written"]
    jobs.main(["refresh-summary", "--table", table, "--summary", summ, "--ds", "2024-01-05"])
    assert spark.read.parquet(summ).count() > 0


def test_every_named_query_runs(spark, scratch):
    import pytest
    from trackside.sources.standin import standin_movements
    ev, table = spark.read.parquet(f"{SF_SMALL}/events.parquet"), scratch("table")
    standin_movements(ev).write.mode("append").partitionBy("uk_date").parquet(table)
    given = {"recent_movements": ["as_of=2024-01-31 00:00:00", "hours=48", "limit=7"], "realtime_gauge": ["as_of_date=2024-01-30"],
             "top_stations": ["min_count=2"], "kpi_scorecard": ["approx=0.05"], "sample_rows": ["ordered=false", "n=3"]}
    for name in jobs.QUERIES:
        args = [x for a in given.get(name, []) for x in ("--arg", a)]
        out = jobs.main(["query", "--table", table, "--name", name, "--out", scratch(name), "--format", "parquet", *args])["out"]
        rows = spark.read.parquet(out).collect()
        assert rows, name
        if name in ("recent_movements", "sample_rows"):
            assert len(rows) == {"recent_movements": 7, "sample_rows": 3}[name]
    for bad in (["--name", "recent_movements"], ["--name", "top_toc", "--arg", "x=1"], ["--name", "_pre_counted"], ["--name", "F"]):
        with pytest.raises(SystemExit):
            jobs.main(["query", "--table", table, "--out", scratch("bad"), *bad])
    out = jobs.main(["query", "--table", table, "--out", scratch("sql"), "--arg", "toc=20", "--sql",
                     "SELECT count(*) AS n FROM movements WHERE toc_id = :toc"])["out"]
    assert spark.read.json(out).first().n == standin_movements(ev).where("toc_id = '20'").count()


def test_streaming_and_table_jobs(spark, scratch):
    from trackside.sinks.lanes import movements_lane, read_rejects
    from trackside.sources.lake import read_lake
    from trackside.streaming.ingest import counter_totals
    from trackside.streaming.progress import progress_totals, read_progress
    ev, frames, topic = spark.read.parquet(f"{SF_SMALL}/events.parquet"), scratch("frames"), scratch("topic")
    standin_frames(ev).select("value").repartition(4).write.mode("append").text(frames)
    feed = ["--frames", frames, "--once", "--max-files", "2"]
    jobs.main(["publish", *feed, "--checkpoint", scratch("c1"), "--to", topic])
    assert spark.read.text(topic).count() == ev.count()
    root, counters, progress = scratch("root"), scratch("counters"), scratch("progress")
    jobs.main(["ingest", *feed, "--checkpoint", scratch("c2"), "--lake", root, "--lanes", "--counters", counters, "--progress", progress])
    assert read_rejects(spark, root).count() > 0
    assert counter_totals(spark, counters).collect() == progress_totals(read_progress(spark, progress)).collect()
    lake, table, rollups = movements_lane(root), scratch("table"), scratch("rollups")
    r = jobs.main(["load-day", "--lake", lake, "--table", table, "--last-writer-wins", "--rollups", rollups, "--dedup", "train_id",
                   "--dedup", "loc_stanox", "--dedup", "event_type", "--dedup", "actual_timestamp"])
    assert r["days"] == "*" and 0 < r["written"] <= read_lake(spark, lake).count()
    gauge, app, exact = scratch("gauge"), scratch("app"), scratch("exact")
    jobs.main(["ingest", *feed, "--checkpoint", scratch("c3"), "--gauge", gauge])
    assert jobs.main(["gauge", "--gauge", gauge, "--as-of-date", "2024-01-30"])["current_punctuality_percentage"] > 0
    assert jobs.main(["gauge", "--gauge", gauge, "--as-of-date", "2031-01-01"])["current_punctuality_percentage"] is None
    jobs.main(["ingest", *feed, "--checkpoint", scratch("c4"), "--table", app])
    jobs.main(["ingest", *feed, "--checkpoint", scratch("c5"), "--table", exact, "--exact"])
    n = spark.read.parquet(app).count()
    assert n == spark.read.parquet(exact).count()
    jobs.main(["compact", "--table", app])
    assert spark.read.parquet(app).count() == n
    both = scratch("both")
    jobs.main(["ingest", *feed, "--checkpoint", scratch("c6"), "--lake", scratch("l6"), "--table", both, "--compat"])
    assert spark.read.parquet(both).count() == n
    old, new = scratch("old"), scratch("new")
    (spark.read.parquet(app).where("uk_date = '2024-01-05'").selectExpr("toc_id", "event_type", "variation_status", "uk_date",
     "to_json(struct(train_id, cast(unix_millis(actual_timestamp) as string) as actual_timestamp)) as raw_data")
     .write.mode("append").partitionBy("uk_date").parquet(old))
    (day,) = jobs.main(["migrate", "--old-table", old, "--table", new])["days"]
    assert day["written"] == spark.read.parquet(new).count() > 0


def test_dashboard_job_writes_every_chart(spark, scratch):
    from trackside.operators import analytics as A
    from trackside.plans.ingest import ingest_frames
    from trackside.plans.load_day import load_days
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    lake, table, summ, out = scratch("lake"), scratch("table"), scratch("s"), scratch("out")
    ingest_frames(standin_frames(ev), lake, processed_at="P")
    load_days(spark, lake, table, summary_path=summ)
    paths = jobs.main(["dashboard", "--summary", summ, "--out", out,
                       "--as-of-date", "2024-01-30"])
    assert len(paths) == 17
    m = spark.read.parquet(table)
    got = spark.read.parquet(paths["toc_ranking"])
    assert got.exceptAll(A.toc_ranking(m)).count() == 0 == A.toc_ranking(m).exceptAll(got).count()


def test_parquet_lake_through_the_jobs(spark, scratch):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    frames = scratch("frames")
    standin_frames(ev).select("value").write.mode("overwrite").text(frames)
    lake, table, ck = scratch("lake"), scratch("table"), scratch("ck")
    jobs.main(["ingest", "--frames", frames, "--lake", lake, "--checkpoint", ck, "--once",
               "--lake-format", "parquet"])
    r = jobs.main(["load-day", "--lake", lake, "--table", table, "--ds", "2024-01-05",
                   "--lake-format", "parquet"])
    assert r["status"] == "loaded" and r["written"] > 0
