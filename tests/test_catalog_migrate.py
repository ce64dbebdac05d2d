"""The catalog table (partitions, pruning, statistics, views) and the migration of text bodies."""

import json

import pytest

from conftest import SF_SMALL
from trackside.operators.views import register_catalog_views
from trackside.plans.catalog import catalog_movements, create_table, day_statistics, measure
from trackside.plans.ingest import ingest_frames
from trackside.plans.load_day import load_days
from trackside.plans.migrate import migrate_table
from trackside.schema import COLUMN_DOCS, TABLE_COLUMNS
from trackside.sources.standin import standin_frames, standin_movements


@pytest.fixture()
def warehouse(spark, scratch):
    home = scratch("home")
    db = "w" + home.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {db} LOCATION '{home}/db'")
    yield home, db
    for name in (db, f"s_{db}", f"r_{db}"):
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


def test_a_load_keeps_the_catalog_table(spark, scratch, warehouse, events):
    home, db = warehouse
    name, lake, table = f"{db}.movements", scratch("lake"), scratch("table")
    ingest_frames(standin_frames(events), lake, processed_at="P")
    load_days(spark, lake, table, ["2024-01-05", "2024-01-06"], catalog_table=name, verify=None)
    t = catalog_movements(spark, name)
    assert t.columns == TABLE_COLUMNS and t.count() == spark.read.parquet(table).count() > 0
    r = load_days(spark, lake, table, ["2024-01-07"], catalog_table=name, verify=None)
    days = {x[0] for x in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    assert days == {f"uk_date=2024-01-0{k}" for k in (5, 6, 7)}
    assert day_statistics(spark, name, "2024-01-07").endswith(f"{r.written} rows")
    one = catalog_movements(spark, name).where("uk_date = '2024-01-07'")
    assert one.count() == r.written
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(uk_date" in plan and "uk_date=2024-01-05" not in plan
    measure(spark, name)
    stats = {x.col_name: x.data_type for x in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}["Statistics"]
    assert stats.endswith(f"{spark.read.parquet(table).count()} rows")
    comments = {x.col_name: x.comment for x in spark.sql(f"DESCRIBE {name}").collect() if x.comment}
    assert comments["train_id"] == COLUMN_DOCS["train_id"]
    # a replaced day is seen at once
    load_days(spark, lake, table, ["2024-01-07"], catalog_table=name, dedup_keys=["toc_id"], verify=None)
    one = catalog_movements(spark, name).where("uk_date = '2024-01-07'")
    assert one.select("toc_id").distinct().count() == one.count() < r.written


def test_views_over_the_catalog_table(spark, warehouse, scratch, events):
    home, db = warehouse
    table = scratch("table")
    standin_movements(events).write.mode("append").partitionBy("uk_date").parquet(table)
    create_table(spark, f"{db}.movements", table)
    stg, mart = register_catalog_views(spark, None, home, f"s_{db}", f"r_{db}", catalog_table=f"{db}.movements")
    assert spark.table(stg).count() == spark.table(mart).count() == standin_movements(events).count()
    assert spark.table(mart).columns == ["actual_timestamp", "train_operating_company", "variation_status"]


def test_a_catalog_table_of_nothing(spark, warehouse, scratch):
    _, db = warehouse
    create_table(spark, f"{db}.empty", scratch("none"))
    assert catalog_movements(spark, f"{db}.empty").count() == 0


# -- migration -----------------------------------------------------------------------------

T0 = 1704067207179


def old_table(spark, path):
    def body(**x):
        return json.dumps({"actual_timestamp": str(T0), "train_id": "T", "event_type": "ARRIVAL", **x})

    rows = [("88", body(train_id="T1", train_terminated=True, division_code=7), "2024-01-01"),
            ("88", body(train_id="T2", platform=None), "2024-01-01"), ("88", "{broken", "2024-01-01"), ("88", "[1]", "2024-01-01"),
            ("88", None, "2024-01-01"), ("88", "5", "2024-01-01"), (None, body(toc_id="20", train_id="T3"), "2024-01-01"),
            (None, body(train_id="T4"), "2024-01-01"), ("88", body(actual_timestamp=str(T0 + 86_400_000)), "2024-01-02"),
            ("88", "x", "2024-01-03")]
    spark.createDataFrame(rows, "toc_id string, raw_data string, uk_date string").write.mode("append").partitionBy("uk_date").parquet(path)


def test_text_bodies_are_typed(spark, scratch):
    old, table = scratch("old"), scratch("table")
    old_table(spark, old)
    done = {d.day: d for d in migrate_table(spark, old, table)}
    assert [(d.rows, d.bad_bodies, d.incomplete, d.written) for d in done.values()] == [(8, 4, 1, 3), (1, 0, 0, 1), (1, 1, 0, 0)]
    got = {r.train_id: r for r in spark.read.parquet(table).collect()}
    assert set(got) == {"T1", "T2", "T3", "T"} and spark.read.parquet(table).columns == TABLE_COLUMNS
    assert (got["T1"].train_terminated, got["T1"].division_code, got["T2"].platform, got["T3"].toc_id) == ("true", "7", None, "20")
    assert str(got["T"].uk_date) == "2024-01-02"


def test_a_migration_goes_on_where_it_broke(spark, scratch, monkeypatch):
    old, table = scratch("old"), scratch("table")
    old_table(spark, old)
    from trackside.plans import migrate as M
    parse, calls = M.parsed_bodies, []

    def breaks(rows):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("gone")
        return parse(rows)

    monkeypatch.setattr(M, "parsed_bodies", breaks)
    with pytest.raises(RuntimeError):
        migrate_table(spark, old, table)
    done = migrate_table(spark, old, table)
    assert len(calls) == 4 and [d.written for d in done] == [3, 1, 0]      # the first day was not read again
    assert spark.read.parquet(table).count() == 4 and spark.read.parquet(old).count() == 10


def test_migrated_equals_loaded(spark, scratch, events):
    lake, old, table, fresh = (scratch(x) for x in ("lake", "old", "table", "fresh"))
    ingest_frames(standin_frames(events), lake, processed_at="P")
    load_days(spark, lake, fresh, verify=None)
    rows = spark.read.json(lake).selectExpr("event_type", "toc_id", "variation_status", "uk_datetime", "cast(timestamp as double) as timestamp",
                                            "processed_at", "to_json(raw_data) as raw_data", "to_date(substr(uk_datetime, 1, 10)) as uk_date")
    rows.write.mode("append").partitionBy("uk_date").parquet(old)
    migrate_table(spark, old, table)
    a, b = (spark.read.parquet(p).select(*TABLE_COLUMNS) for p in (table, fresh))
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0
