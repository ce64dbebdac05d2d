"""Dashboard and report queries over the movements table (``m``).

Every function is DataFrame -> DataFrame and uses only native expressions,
so each plan is: Parquet scan (pruned columns, pushed filters) -> partial
HashAggregate -> one small Exchange on the group keys -> final aggregate ->
TakeOrderedAndProject where a top-k is part of the question.  The group keys
(operator, status, hour, day, station, route) are low-cardinality, so the
partial aggregate collapses each input split to a handful of rows before the
shuffle and a hot operator cannot skew the exchange.

Conventions: times are UTC (date and hour of the stored instant, as the
warehouse functions give; pass ``tz`` for another zone); percentages are
``pct`` (DOUBLE, rounded half away from zero on the binary value); every
top-k has a full tie-break so results are deterministic.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from trackside.functions.exprs import (count_when, delay_minutes, delay_ms, pct,
                                       round_half_away)
from trackside.functions.times import to_london

ON_TIME = "ON TIME"
LATE = "LATE"


# Column holding the row weight of a pre-aggregated movement summary
# (``operators.summary``); every count below is a sum of it when present, so
# the count-only queries run unchanged over the summary.
WEIGHT = "movements"


def _ts(tz: str) -> Column:
    ts = F.col("actual_timestamp")
    return ts if tz.upper() == "UTC" else to_london(ts, tz)


def _weighted(m: DataFrame) -> bool:
    return WEIGHT in m.columns


def _rows(m: DataFrame) -> Column:
    """COUNT(*) - or the summed weight of a summary (0 on empty input)."""
    if _weighted(m):
        return F.coalesce(F.sum(WEIGHT), F.lit(0).cast("bigint"))
    return F.count(F.lit(1))


def _rows_when(m: DataFrame, cond: Column) -> Column:
    """COUNT(CASE WHEN cond THEN 1 END) - a NULL condition is not counted."""
    if _weighted(m):
        return F.coalesce(F.sum(F.when(cond, F.col(WEIGHT)).otherwise(F.lit(0).cast("bigint"))),
                          F.lit(0).cast("bigint"))
    return count_when(cond)


def _on_time(m: DataFrame) -> Column:
    return _rows_when(m, F.col("variation_status") == ON_TIME)


def summary_tz(s: DataFrame) -> str:
    """The zone whose dates and hours a summary holds."""
    return s.schema["hour_of_day"].metadata.get("tz", "UTC")


def _hour(m: DataFrame, tz: str) -> Column:
    if "hour_of_day" in m.columns and "actual_timestamp" not in m.columns:
        _same_zone(m, tz)
        return F.col("hour_of_day").cast("int")   # without the column's metadata
    _require_utc(m)
    return F.hour(_ts(tz))


def _date(m: DataFrame, tz: str) -> Column:
    if "date" in m.columns and "actual_timestamp" not in m.columns:
        _same_zone(m, tz)
        return F.col("date").cast("date")
    _require_utc(m)
    return F.to_date(_ts(tz))


def _same_zone(s: DataFrame, tz: str) -> None:
    if summary_tz(s).upper() != tz.upper():
        raise ValueError(f"the summary holds dates and hours of {summary_tz(s)}, not of {tz}")


def _require_utc(m: DataFrame) -> None:
    """Dates and hours are taken in the session's zone, which must therefore be UTC."""
    zone = m.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone.upper() not in ("UTC", "ETC/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"the session's zone is {zone}; call trackside.session.use_utc first")


def _day_window(m: DataFrame, lo: Column | None, hi: Column | None = None) -> DataFrame:
    """Add a partition predicate on ``uk_date`` implied by a time predicate.

    The London date of an instant and its date in any other zone differ by
    at most one day, so ``uk_date`` within one day of the wanted range never
    drops a qualifying row - and lets a table partitioned by ``uk_date``
    list and read only those directories (``PartitionFilters``) instead of
    every file footer of the table.
    """
    if "uk_date" not in m.columns:
        return m
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col("uk_date") >= F.date_sub(lo, 1))
    if hi is not None:
        cond = cond & (F.col("uk_date") <= F.date_add(hi, 1))
    return m.where(cond)


def _distinct(col, approx: float | None) -> Column:
    """Exact COUNT(DISTINCT); with ``approx`` (relative error) HyperLogLog++.

    The approximate form needs no exchange of distinct values, only one
    fixed-size sketch per task.
    """
    return F.approx_count_distinct(col, approx) if approx else F.count_distinct(col)


def _pre_counted(m: DataFrame, *keys) -> DataFrame:
    """Movements counted by train and operator (and ``keys``).

    Several distinct counts need several copies of their input rows; these are
    copied instead of the movements themselves, and only they are shuffled.
    """
    return m.groupBy("train_id", "toc_id", *keys).agg(
        F.count(F.lit(1)).alias("_n"), _on_time(m).alias("_on_time"),
        count_when(F.col("variation_status") != LATE).alias("_not_late"),
        F.min("actual_timestamp").alias("_first"), F.max("actual_timestamp").alias("_last"))


def _summed(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0).cast("bigint"))


def _asof(value) -> Column:
    """An as-of instant.  Text is parsed by Spark in the session zone (UTC);
    a naive Python datetime would be converted in the driver process's
    local zone instead, so it is passed on as text too."""
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        value = value.isoformat(sep=" ")
    return F.to_timestamp(F.lit(str(value)))


# --- Q1 ---------------------------------------------------------------------
def basic_stats(m: DataFrame, approx: float | None = None) -> DataFrame:
    """Rows, distinct trains / operators / UTC dates, first and last movement."""
    _require_utc(m)
    if approx:
        per, n = m.withColumn("_date", F.to_date("actual_timestamp")), F.count(F.lit(1))
        first, last = F.min("actual_timestamp"), F.max("actual_timestamp")
    else:
        per, n = _pre_counted(m, F.to_date("actual_timestamp").alias("_date")), _summed("_n")
        first, last = F.min("_first"), F.max("_last")
    return per.agg(
        n.alias("total_movements"),
        _distinct("train_id", approx).alias("unique_trains"),
        _distinct("toc_id", approx).alias("unique_tocs"),
        _distinct("_date", approx).alias("unique_dates"),
        first.alias("earliest_movement"),
        last.alias("latest_movement"))


# --- Q2 / Q6 ----------------------------------------------------------------
def movements_by_toc(m: DataFrame, limit: int = 20) -> DataFrame:
    """Movements, departures and arrivals per operator; busiest first."""
    return (m.groupBy("toc_id")
            .agg(_rows(m).alias("movement_count"),
                 _rows_when(m, F.col("event_type") == "DEPARTURE").alias("departures"),
                 _rows_when(m, F.col("event_type") == "ARRIVAL").alias("arrivals"))
            .orderBy(F.desc("movement_count"), F.asc_nulls_last("toc_id"))
            .limit(limit))


def top_toc(m: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` operators of ``movements_by_toc`` (chart data set)."""
    return movements_by_toc(m, limit=n)


# --- Q3 ---------------------------------------------------------------------
def punctuality_share(m: DataFrame) -> DataFrame:
    """Count and percentage of the grand total per variation status.

    The window runs over the aggregated rows (one per status), never over
    the movements, so its single partition holds a handful of rows.
    """
    per_status = m.groupBy("variation_status").agg(_rows(m).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return (per_status.withColumn("percentage", pct(F.col("count"), total))
            .orderBy(F.desc("count"), F.asc_nulls_last("variation_status")))


# --- Q4 ---------------------------------------------------------------------
def hourly_patterns(m: DataFrame, tz: str = "UTC") -> DataFrame:
    """Movements, departures and arrivals per hour of day (0-23)."""
    return (m.groupBy(_hour(m, tz).alias("hour_of_day"))
            .agg(_rows(m).alias("total_movements"),
                 _rows_when(m, F.col("event_type") == "DEPARTURE").alias("departures"),
                 _rows_when(m, F.col("event_type") == "ARRIVAL").alias("arrivals"))
            .orderBy("hour_of_day"))


# --- Q5 ---------------------------------------------------------------------
def recent_movements(m: DataFrame, as_of, hours: int = 24, limit: int = 50) -> DataFrame:
    """Newest movements of the last ``hours`` before ``as_of``, with delay.

    ``as_of`` is injected (the reference uses the wall clock); the time
    filter is a plain range on the stored instant, pushed to the scan.
    """
    since = _asof(as_of) - F.make_dt_interval(F.lit(0), F.lit(hours))
    return (_day_window(m, F.to_date(since)).where(F.col("actual_timestamp") >= since)
            .select("train_id", "event_type", "toc_id", "variation_status",
                    "actual_timestamp", "loc_stanox", "planned_timestamp",
                    round_half_away(delay_minutes(), 2).alias("delay_minutes"))
            .orderBy(F.desc("actual_timestamp"), F.asc_nulls_last("train_id"),
                     F.asc_nulls_last("event_type"), F.asc_nulls_last("loc_stanox"))
            .limit(limit))


# --- Q7 / Q8 ----------------------------------------------------------------
def event_type_distribution(m: DataFrame) -> DataFrame:
    return m.groupBy("event_type").agg(_rows(m).alias("count"))


def punctuality_distribution(m: DataFrame) -> DataFrame:
    return (m.groupBy("variation_status").agg(_rows(m).alias("movement_count"))
            .orderBy(F.desc("movement_count"), F.asc_nulls_last("variation_status")))


# --- Q9 / Q18 ---------------------------------------------------------------
def toc_ranking(m: DataFrame, min_total: int = 10, limit: int = 20,
                key: str = "toc_id") -> DataFrame:
    """Punctuality per operator with strictly more than ``min_total`` movements."""
    return (m.groupBy(key)
            .agg(_rows(m).alias("total_movements"), _on_time(m).alias("on_time_count"))
            .where(F.col("total_movements") > min_total)
            .withColumn("punctuality_percentage",
                        pct(F.col("on_time_count"), F.col("total_movements")))
            .orderBy(F.desc("punctuality_percentage"), F.asc_nulls_last(key))
            .limit(limit))


def leaderboard(m: DataFrame, min_total: int = 20, limit: int = 15) -> DataFrame:
    return toc_ranking(m, min_total, limit).select(
        "toc_id", "total_movements", "punctuality_percentage")


# --- Q10 --------------------------------------------------------------------
def toc_status_heatmap(m: DataFrame) -> DataFrame:
    return (m.groupBy("toc_id", "variation_status")
            .agg(_rows(m).alias("movement_count"))
            .orderBy(F.asc_nulls_last("toc_id"), F.asc_nulls_last("variation_status")))


# --- Q11 --------------------------------------------------------------------
def daily_trends(m: DataFrame, limit: int = 30, tz: str = "UTC") -> DataFrame:
    """Movements per date x status, newest date first; ``limit`` counts rows."""
    return (m.groupBy(_date(m, tz).alias("date"), "variation_status")
            .agg(_rows(m).alias("movement_count"))
            .orderBy(F.desc("date"), F.asc_nulls_last("variation_status"))
            .limit(limit))


# --- Q12 --------------------------------------------------------------------
def weekly_calendar(m: DataFrame, tz: str = "UTC") -> DataFrame:
    """Punctuality per weekday (1 = Sunday) x hour."""
    return (m.groupBy(F.dayofweek(_date(m, tz)).alias("day_of_week"),
                      _hour(m, tz).alias("hour_of_day"))
            .agg(pct(_on_time(m), _rows(m)).alias("punctuality_percentage"))
            .orderBy("day_of_week", "hour_of_day"))


# --- Q13 --------------------------------------------------------------------
def top_stations(m: DataFrame, min_count: int = 5, limit: int = 20) -> DataFrame:
    return (m.where(F.col("loc_stanox").isNotNull())
            .groupBy(F.col("loc_stanox").alias("station_code"))
            .agg(F.count(F.lit(1)).alias("movement_count"), _on_time(m).alias("on_time_count"))
            .where(F.col("movement_count") > min_count)
            .withColumn("punctuality_percentage",
                        pct(F.col("on_time_count"), F.col("movement_count")))
            .orderBy(F.desc("movement_count"), F.asc("station_code"))
            .limit(limit))


# --- Q14 --------------------------------------------------------------------
def route_performance(m: DataFrame) -> DataFrame:
    return (m.where(F.col("route").isNotNull() & (F.col("route") != "0"))
            .groupBy("toc_id", "route", "variation_status")
            .agg(_rows(m).alias("movement_count"))
            .orderBy(F.asc_nulls_last("toc_id"), "route", F.asc_nulls_last("variation_status")))


# --- Q15 --------------------------------------------------------------------
def delay_distribution(m: DataFrame) -> DataFrame:
    """Histogram of LATE delays in whole minutes (half away from zero)."""
    return (m.where((F.col("variation_status") == LATE)
                    & F.col("actual_timestamp").isNotNull()
                    & F.col("planned_timestamp").isNotNull())
            .groupBy(round_half_away(delay_minutes(), 0).alias("delay_minutes"))
            .agg(F.count(F.lit(1)).alias("frequency"))
            .orderBy("delay_minutes"))


# --- Q16 --------------------------------------------------------------------
def toc_hour_matrix(m: DataFrame, min_count: int = 5, tz: str = "UTC") -> DataFrame:
    return (m.groupBy("toc_id", _hour(m, tz).alias("hour_of_day"))
            .agg(_rows(m).alias("_n"), _on_time(m).alias("_on"))
            .where(F.col("_n") > min_count)
            .select("toc_id", "hour_of_day",
                    pct(F.col("_on"), F.col("_n")).alias("punctuality_percentage"))
            .orderBy(F.asc_nulls_last("toc_id"), "hour_of_day"))


# --- Q17 --------------------------------------------------------------------
def realtime_gauge(m: DataFrame, as_of_date, tz: str = "UTC") -> DataFrame:
    """Punctuality of one date; one row, NULL when the date has no movements.

    ``to_date(ts) = d`` is rewritten by the optimizer into a half-open range
    on the instant and pushed to the Parquet scan.
    """
    d = F.lit(as_of_date).cast("date") if not isinstance(as_of_date, Column) else as_of_date
    return (_day_window(m, d, d).where(_date(m, tz) == d)
            .agg(pct(_on_time(m), _rows(m)).alias("current_punctuality_percentage")))


# --- Q19 --------------------------------------------------------------------
def kpi_scorecard(m: DataFrame, approx: float | None = None) -> DataFrame:
    if not approx:
        return _pre_counted(m).agg(
            _summed("_n").alias("total_movements"), F.count_distinct("train_id").alias("unique_trains"),
            F.count_distinct("toc_id").alias("active_tocs"),
            pct(_summed("_on_time"), _summed("_n")).alias("overall_punctuality_percentage"))
    return m.agg(
        F.count(F.lit(1)).alias("total_movements"),
        _distinct("train_id", approx).alias("unique_trains"),
        _distinct("toc_id", approx).alias("active_tocs"),
        pct(_on_time(m), F.count(F.lit(1))).alias("overall_punctuality_percentage"))


# --- Q20 --------------------------------------------------------------------
def network_health(m: DataFrame, diversity_base: int = 50,
                   approx: float | None = None) -> DataFrame:
    """Four 0-100 scores; a NULL status is not counted as 'not LATE'."""
    if not approx:
        n = _summed("_n")
        return _pre_counted(m).agg(
            pct(_summed("_on_time"), n).alias("punctuality_score"),
            pct(F.count_distinct("train_id"), n).alias("coverage_score"),
            pct(_summed("_not_late"), n).alias("reliability_score"),
            pct(F.count_distinct("toc_id"), F.lit(diversity_base)).alias("diversity_score"))
    n = F.count(F.lit(1))
    return m.agg(
        pct(_on_time(m), n).alias("punctuality_score"),
        pct(_distinct("train_id", approx), n).alias("coverage_score"),
        pct(count_when(F.col("variation_status") != LATE), n).alias("reliability_score"),
        pct(_distinct("toc_id", approx), F.lit(diversity_base)).alias("diversity_score"))


# --- Q21 --------------------------------------------------------------------
def journey_flow(m: DataFrame) -> DataFrame:
    """Rows and mean delay per event type.

    Non-LATE rows count as a delay of 0; a LATE row without a planned time
    is left out of the mean.  The mean is taken over exact integer
    milliseconds and divided once, so it does not depend on summation order.
    """
    is_late = F.col("variation_status") == LATE
    d = delay_ms()
    value_ms = F.when(is_late, d).otherwise(F.lit(0).cast("bigint"))
    return (m.groupBy("event_type")
            .agg(F.count(F.lit(1)).alias("movement_count"),
                 F.sum(value_ms).alias("_sum_ms"), F.count(value_ms).alias("_n"))
            .select("event_type", "movement_count",
                    round_half_away(F.try_divide(F.col("_sum_ms") / F.lit(60000.0), F.col("_n")), 2)
                    .alias("avg_delay_minutes")))


# --- Q22 / Q23 / Q24 --------------------------------------------------------
def row_count(m: DataFrame) -> DataFrame:
    return m.agg(_rows(m).alias("total_rows"))


def sample_rows(m: DataFrame, n: int = 5, ordered: bool = True) -> DataFrame:
    """``n`` rows, earliest first; ``ordered=False`` gives any ``n`` rows.

    The ordered form is deterministic (what the checks compare) but reads
    every row to find the earliest; unordered, it is a ``CollectLimit``
    that stops after the first splits - the quick look a plain LIMIT gives
    on a large table.
    """
    if not ordered:
        return m.limit(n)
    return m.orderBy(F.asc_nulls_last("actual_timestamp"), F.asc_nulls_last("train_id"),
                     F.asc_nulls_last("event_type"), F.asc_nulls_last("loc_stanox")).limit(n)


def column_check(spark: SparkSession, m: DataFrame) -> DataFrame:
    """Column name and SQL type in ordinal order (schema metadata, no scan)."""
    rows = [(f.name, f.dataType.simpleString().upper(), i + 1)
            for i, f in enumerate(m.schema.fields)]
    return spark.createDataFrame(rows, "column_name string, data_type string, "
                                       "ordinal_position int").orderBy("ordinal_position")


# --- Q25 --------------------------------------------------------------------
def run_sql(spark: SparkSession, sql: str, args: dict | None = None) -> DataFrame:
    """Ad-hoc SQL over the registered views, with named parameters (``:name``)."""
    return spark.sql(sql, args=args or None)


# --- Q26 / Q27 (over the operating-company mart) ----------------------------
def company_tree(mart: DataFrame) -> DataFrame:
    """Movements by company, then status, with subtotals (ROLLUP).

    ``level`` tells the rows apart: 0 a company's status (which may be NULL), 1 a
    company's subtotal, 3 the total.  The movements are counted first; only
    those few counts are rolled up.
    """
    counts = (mart.groupBy("train_operating_company", "variation_status")
              .agg(_rows(mart).alias("_n")))
    return (counts.rollup("train_operating_company", "variation_status")
            .agg(_summed("_n").alias("movement_count"), F.grouping_id().cast("int").alias("level"))
            .orderBy(F.asc_nulls_last("train_operating_company"),
                     F.asc_nulls_last("variation_status"), "level"))


def company_ranking(mart: DataFrame, min_total: int = 10, limit: int = 20) -> DataFrame:
    return toc_ranking(mart, min_total, limit, key="train_operating_company")
