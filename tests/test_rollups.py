"""Kept rollups: every answer equals the one over the movements, also after days are replaced."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from trackside.operators import analytics as A
from trackside.operators.rollups import Rollups, number_values, refresh_rollups
from trackside.sources.standin import plant_quality_failures, standin_movements

ANSWERS = ["basic_stats", "kpi_scorecard", "network_health", "top_stations", "delay_distribution", "journey_flow"]


def write(m, path):
    (m.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("uk_date").parquet(path))


def same(spark, rollups, m):
    for name in ANSWERS:
        got, want = getattr(rollups, name)(), getattr(A, name)(m)
        assert got.columns == want.columns
        assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str), name


@pytest.fixture(scope="module")
def movements(spark):
    return standin_movements(spark.read.parquet(f"{SF_SMALL}/events.parquet"))


def test_answers_before_and_after_a_day_is_replaced(spark, scratch, movements):
    table, path = scratch("table"), scratch("rollups")
    write(movements, table)
    refresh_rollups(spark, table, path)
    same(spark, Rollups(spark, path), spark.read.parquet(table))
    day = dt.date(2024, 1, 15)
    new = (movements.where(F.col("uk_date") == day).where("loc_stanox > '00500'")
           .withColumn("train_id", F.concat(F.lit("new"), "train_id")).withColumn("toc_id", F.lit("77")))
    write(new, table)
    refresh_rollups(spark, table, path, ["2024-01-15", "2031-01-01"])
    same(spark, Rollups(spark, path), spark.read.parquet(table))
    refresh_rollups(spark, table, path, ["2024-01-15"])
    same(spark, Rollups(spark, path), spark.read.parquet(table))
    some = ["2024-01-14", "2024-01-15"]
    same(spark, Rollups(spark, path, some), spark.read.parquet(table).where(F.col("uk_date").isin(some)))
    ids = spark.read.parquet(f"{path}/ids")
    assert ids.count() == ids.select("kind", "value").distinct().count() == ids.select("kind", "id").distinct().count()


def test_nulls_everywhere(spark, scratch, movements):
    table, path = scratch("table"), scratch("rollups")
    m = (plant_quality_failures(movements).withColumn("planned_timestamp", F.when(F.col("loc_stanox") > "01000", F.col("planned_timestamp")))
         .withColumn("toc_id", F.when(F.col("toc_id") != "20", F.col("toc_id"))))
    write(m, table)
    refresh_rollups(spark, table, path, sketch=True)
    m = spark.read.parquet(table)
    same(spark, Rollups(spark, path), m)
    exact = dict(Rollups(spark, path).distinct_counts().collect())
    assert exact == {"train": m.select("train_id").dropna().distinct().count(), "toc": m.select("toc_id").dropna().distinct().count()}
    for kind, n in Rollups(spark, path).approximate_counts().collect():
        assert abs(n - exact[kind]) <= 0.05 * exact[kind]


def test_a_day_without_movements(spark, scratch, movements):
    table, path = scratch("table"), scratch("rollups")
    write(movements, table)
    refresh_rollups(spark, table, path)
    same(spark, Rollups(spark, path, ["2031-01-01"]), spark.read.parquet(table).where("uk_date = '2031-01-01'"))


def test_many_values_fill_several_bitmaps(spark, scratch):
    path = scratch("ids")
    values = spark.range(70_000).select(F.lit("train").alias("kind"), F.concat(F.lit("T"), F.col("id").cast("string")).alias("value"))
    assert number_values(spark, values, path).count() == 70_000
    ids = number_values(spark, values.unionByName(values.withColumn("value", F.concat("value", F.lit("x")))), path)
    assert ids.count() == ids.select("id").distinct().count() == 140_000
    assert ids.agg(F.max("id")).first()[0] < 1.2 * 140_000     # numbers stay dense


def test_refresh_reads_only_its_days(spark, scratch, movements):
    import os
    table, path = scratch("table"), scratch("rollups")
    write(movements.where("uk_date = '2024-01-15'"), table)
    os.makedirs(f"{table.replace('file:', '')}/uk_date=2023-01-01")
    with open(f"{table.replace('file:', '')}/uk_date=2023-01-01/part-0.parquet", "w") as f:
        f.write("damaged")
    refresh_rollups(spark, table, path, ["2024-01-15"])
    assert Rollups(spark, path).basic_stats().first()["unique_dates"] == 1
