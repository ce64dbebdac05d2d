"""Rollups kept beside the movements: the questions that a count by operator and hour cannot answer.

Two tables, both partitioned by ``uk_date``, so that a replaced day replaces its own rows alone:

* ``facets``: one pass of GROUPING SETS over a day's movements - by station and status, by whole minutes of
  delay, by event type (with the exact sums that a mean needs) and by UTC date and status.  Every column is a sum, a
  minimum or a maximum, so days are merged by adding them up (Q13, Q15, Q21 and the counts of Q1, Q19, Q20).
* ``distinct``: which trains and operators a day has, as bitmaps.  A distinct count cannot be added over
  days, but bitmaps can be merged: the union over any days is exact (Q1, Q19, Q20).  Values get a number from
  the table ``ids`` when they first come, and keep it; numbers are dense but for the
  skew of a hash, so a bitmap of 4 KB covers 32,768 values.  ``sketch=True`` adds HyperLogLog sketches, which need no numbers.

One writer at a time: two refreshes at once could number a value twice.  A refresh that fails leaves
numbers without use and is run again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackside.functions.exprs import delay_minutes, delay_ms, pct, round_half_away
from trackside.operators.analytics import LATE, ON_TIME
from trackside.session import path_exists

#: Kinds of values that are counted distinct, and their column.
COUNTED = {"train": "train_id", "toc": "toc_id"}
#: New values are numbered in so many groups at once.
GROUPS = 64


def facets(m: DataFrame) -> DataFrame:
    """Movements (with ``uk_date``) -> one row for each day, facet and key."""
    late = F.col("variation_status") == LATE
    timed = late & F.col("actual_timestamp").isNotNull() & F.col("planned_timestamp").isNotNull()
    rows = m.select(
        "uk_date", "actual_timestamp", "loc_stanox", "variation_status", "event_type",
        F.to_date("actual_timestamp").alias("date"), timed.alias("timed"),
        F.when(timed, round_half_away(delay_minutes(), 0)).alias("delay_minutes"),
        F.when(late, delay_ms()).otherwise(F.lit(0).cast("bigint")).alias("value_ms"))
    keys = ["loc_stanox", "delay_minutes", "event_type", "date", "variation_status", "timed"]
    sets = {"station": ["loc_stanox", "variation_status"], "delay": ["timed", "delay_minutes"], "event": ["event_type"],
            "date": ["date", "variation_status"]}
    grouped = rows.groupingSets([[F.col("uk_date"), *map(F.col, s)] for s in sets.values()], "uk_date", *keys).agg(
        *[F.grouping(k).alias(f"_{k}") for k in ("loc_stanox", "timed", "event_type", "date")],
        F.count(F.lit(1)).alias("movements"), F.sum("value_ms").alias("sum_ms"), F.count("value_ms").alias("n_ms"),
        F.min("actual_timestamp").alias("first"), F.max("actual_timestamp").alias("last"))
    facet = (F.when(F.col("_loc_stanox") == 0, "station").when(F.col("_timed") == 0, "delay")
             .when(F.col("_event_type") == 0, "event").otherwise("date"))
    return grouped.select(facet.alias("facet"), *keys, "movements", "sum_ms", "n_ms", "first", "last", "uk_date")


def _values(m: DataFrame) -> DataFrame:
    """(uk_date, kind, value): the distinct values of each day."""
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("value")) for k, c in COUNTED.items()])
    return m.select("uk_date", F.explode(pairs).alias("x")).select("uk_date", "x.*").where("value IS NOT NULL").distinct()


def number_values(spark: SparkSession, values: DataFrame, path: str) -> DataFrame:
    """(kind, value, id) of all values seen so far; those in ``values`` that are new get their numbers."""
    schema = "kind string, value string, id bigint"
    old = spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)
    new = values.select("kind", "value").distinct().join(old.select("kind", "value"), ["kind", "value"], "left_anti")
    # groups are numbered side by side: n-th value of group g is n * GROUPS + g
    group = F.pmod(F.xxhash64("value"), F.lit(GROUPS))
    nth = F.row_number().over(Window.partitionBy("kind", "g").orderBy("value")) - 1
    start = old.groupBy("kind").agg((F.max("id") + 1).alias("start"))   # one row a kind
    numbered = (new.withColumn("g", group).withColumn("id", nth * GROUPS + F.col("g"))
                .join(F.broadcast(start), "kind", "left")
                .select("kind", "value", (F.col("id") + F.coalesce("start", F.lit(0))).cast("bigint").alias("id")))
    numbered.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def bitmaps(values: DataFrame, ids: DataFrame, sketch: bool = False) -> DataFrame:
    """(kind, bucket, bitmap, uk_date) of each day's values, and with ``sketch`` a mergeable sketch."""
    rows = values.join(ids, ["kind", "value"])
    out = rows.groupBy("uk_date", "kind", F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bitmap"),
        *([F.hll_sketch_agg("value").alias("sketch")] if sketch else []))
    return out.select("kind", "bucket", "bitmap", *(["sketch"] if sketch else []), "uk_date")


def refresh_rollups(spark: SparkSession, table_path: str, path: str, days: list[str] | None = None,
                    sketch: bool = False) -> None:
    """Roll up the given London days of the table (all: None) and replace their rows below ``path``.

    A day that the table no longer has keeps its rows, as its partition would."""
    base, root = table_path.rstrip("/"), path.rstrip("/")
    there = [p for p in (f"{base}/uk_date={d}" for d in days) if path_exists(spark, p)] if days else [base]
    if not there:
        return
    m = spark.read.option("basePath", base).parquet(*there)
    values = _values(m)
    ids = number_values(spark, values, f"{root}/ids")
    # the rows of a day are few (stations, minutes, bitmaps), one file holds them
    for name, rows in (("facets", facets(m)), ("distinct", bitmaps(values, ids, sketch))):
        (rows.repartition("uk_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("uk_date").parquet(f"{root}/{name}"))


class Rollups:
    """The kept rollups of all days, or of some; every answer equals that of ``analytics`` over the same movements."""

    def __init__(self, spark: SparkSession, path: str, days: list[str] | None = None):
        keep = F.col("uk_date").isin(list(days)) if days else F.lit(True)   # pruned to the days' directories
        self._facets = spark.read.parquet(f"{path.rstrip('/')}/facets").where(keep)
        self._bitmaps = spark.read.parquet(f"{path.rstrip('/')}/distinct").where(keep)

    def facet(self, name: str) -> DataFrame:
        return self._facets.where(F.col("facet") == name)

    def distinct_counts(self) -> DataFrame:
        """(kind, n): exact distinct counts over the days."""
        merged = self._bitmaps.groupBy("kind", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        return merged.groupBy("kind").agg(F.sum(F.bitmap_count("bitmap")).alias("n"))

    def approximate_counts(self) -> DataFrame:
        """(kind, n) out of the sketches."""
        return self._bitmaps.groupBy("kind").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n"))

    def _totals(self) -> DataFrame:
        """One row: the counts, the distinct ones among them."""
        status = F.col("variation_status")
        rows = self.facet("date").select(
            "movements", F.when(status == ON_TIME, F.col("movements")).alias("on_time"),
            F.when(status != LATE, F.col("movements")).alias("not_late"), "date", "first", "last",
            *[F.lit(None).cast("bigint").alias(k) for k in COUNTED])
        kinds = self.distinct_counts().select(*[F.lit(None).cast(t).alias(c) for c, t in rows.dtypes[:6]],
                                              *[F.when(F.col("kind") == k, F.col("n")).alias(k) for k in COUNTED])
        def whole(c: str) -> Column:
            return F.coalesce(F.sum(c), F.lit(0).cast("bigint")).alias(c)

        return rows.unionByName(kinds).agg(*map(whole, ["movements", "on_time", "not_late", *COUNTED]),
                                           F.count_distinct("date").alias("dates"), F.min("first").alias("first"),
                                           F.max("last").alias("last"))

    def scorecards(self, diversity_base: int = 50) -> DataFrame:
        """One row with the columns of ``basic_stats``, ``kpi_scorecard`` and ``network_health``."""
        return self._totals().select(
            F.col("movements").alias("total_movements"), F.col("train").alias("unique_trains"), F.col("toc").alias("unique_tocs"),
            F.col("dates").alias("unique_dates"), F.col("first").alias("earliest_movement"), F.col("last").alias("latest_movement"),
            F.col("toc").alias("active_tocs"), pct("on_time", "movements").alias("overall_punctuality_percentage"),
            pct("on_time", "movements").alias("punctuality_score"), pct("train", "movements").alias("coverage_score"),
            pct("not_late", "movements").alias("reliability_score"), pct(F.col("toc"), F.lit(diversity_base)).alias("diversity_score"))

    def basic_stats(self) -> DataFrame:
        return self.scorecards().select("total_movements", "unique_trains", "unique_tocs", "unique_dates", "earliest_movement",
                                        "latest_movement")

    def kpi_scorecard(self) -> DataFrame:
        return self.scorecards().select("total_movements", "unique_trains", "active_tocs", "overall_punctuality_percentage")

    def network_health(self, diversity_base: int = 50) -> DataFrame:
        return self.scorecards(diversity_base).select("punctuality_score", "coverage_score", "reliability_score", "diversity_score")

    def top_stations(self, min_count: int = 5, limit: int = 20) -> DataFrame:
        on_time = F.when(F.col("variation_status") == ON_TIME, F.col("movements")).otherwise(0)
        return (self.facet("station").where("loc_stanox IS NOT NULL").groupBy(F.col("loc_stanox").alias("station_code"))
                .agg(F.sum("movements").alias("movement_count"), F.sum(on_time).alias("on_time_count"))
                .where(F.col("movement_count") > min_count)
                .withColumn("punctuality_percentage", pct("on_time_count", "movement_count"))
                .orderBy(F.desc("movement_count"), F.asc("station_code")).limit(limit))

    def delay_distribution(self) -> DataFrame:
        return (self.facet("delay").where("timed").groupBy("delay_minutes").agg(F.sum("movements").alias("frequency"))
                .orderBy("delay_minutes"))

    def journey_flow(self) -> DataFrame:
        mean = F.try_divide(F.sum("sum_ms") / F.lit(60000.0), F.sum("n_ms"))
        return self.facet("event").groupBy("event_type").agg(F.sum("movements").alias("movement_count"),
                                                             round_half_away(mean, 2).alias("avg_delay_minutes"))
