"""Movement summary: the dashboard's count-only questions from one pass.

Sixteen of the analytics queries only count movements by some of operator,
status, event type, route, UTC date and hour.  ``movement_summary`` groups
the movements once by all six (partial aggregation, one small exchange) and
the count queries in ``analytics`` accept the result directly: their counts
become sums of the ``movements`` weight.  A dashboard refresh then reads the
fact table once instead of once per chart, and the summary is small enough
(operators x 4 statuses x 2 types x routes x days x 24) to keep as a table.

The queries that need a movement's own columns - distinct trains, stations,
delays, the newest rows - still read the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackside.functions.exprs import toc_name
from trackside.functions.times import to_london
from trackside.operators import analytics as A
from trackside.session import scratch_dir

SUMMARY_KEYS = ["toc_id", "variation_status", "event_type", "route", "date", "hour_of_day"]


def movement_summary(m: DataFrame, tz: str = "UTC") -> DataFrame:
    """Movements counted by operator, status, event type, route, date and hour.

    When the input carries the table's ``uk_date`` partition column it is
    kept as a key: a London day starts on a UTC hour boundary, so every
    (date, hour) cell lies in one London day and the extra key adds no rows,
    while it lets the summary be partitioned - and maintained - by day.
    """
    ts = F.col("actual_timestamp")
    ts = ts if tz.upper() == "UTC" else to_london(ts, tz)
    keys = [F.col(c) for c in ["toc_id", "variation_status", "event_type", "route"]]
    zone = {"tz": tz}    # kept with the columns, in files too: charts refuse another zone
    keys += [F.to_date(ts).alias("date"), F.hour(ts).alias("hour_of_day")]
    if "uk_date" in m.columns:
        keys.append(F.col("uk_date"))
    s = m.groupBy(*keys).agg(F.count(F.lit(1)).alias(A.WEIGHT))
    return s.select(*[F.col(c).alias(c, metadata=zone) if c in ("date", "hour_of_day") else F.col(c)
                      for c in s.columns])


def refresh_summary(spark: SparkSession, table_path: str, summary_path: str,
                    days: list[str] | None = None) -> None:
    """Re-summarise the given London days of the table into the summary table.

    Reads only those day partitions of the facts and replaces only the same
    partitions of the summary (dynamic overwrite), so keeping the dashboard
    current costs one day's scan per daily load, not a scan of the table.
    """
    import datetime as _dt
    if days:
        m = spark.read.option("basePath", table_path).parquet(
            *[f"{table_path.rstrip('/')}/uk_date={_dt.date.fromisoformat(d)}" for d in days])
    else:
        m = spark.read.parquet(table_path)
    # The summary of a day is small and bounded (operators x statuses x types
    # x routes x 24 hours), so gathering each day into one task is a cheap
    # shuffle and leaves one file per day instead of one per task per day.
    (movement_summary(m).repartition("uk_date").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("uk_date").parquet(summary_path))


def company_summary(summary: DataFrame) -> DataFrame:
    """The summary with the operating-company name (the mart's dimension)."""
    return summary.withColumn("train_operating_company", toc_name("toc_id"))


def materialize_summary(spark: SparkSession, m: DataFrame, path: str | None = None,
                        tz: str = "UTC") -> DataFrame:
    """Write the summary below the shared checkpoint folder and read it back.

    Writing cuts the lineage: every chart then reads the small table, and a
    lost executor never forces a re-scan of the movements.
    """
    path = path or scratch_dir(spark, "summary")
    movement_summary(m, tz).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def dashboard(spark: SparkSession, m: DataFrame, as_of_date, path: str | None = None,
              tz: str = "UTC") -> dict[str, DataFrame]:
    """The count-only charts, all over one materialised summary."""
    return charts(materialize_summary(spark, m, path, tz), as_of_date)


def charts(s: DataFrame, as_of_date) -> dict[str, DataFrame]:
    """The count-only charts over a summary (fresh, or kept by ``load_days``)."""
    c = company_summary(s)
    tz = A.summary_tz(s)
    return {
        "movements_by_toc": A.movements_by_toc(s),
        "top_toc": A.top_toc(s),
        "punctuality_share": A.punctuality_share(s),
        "hourly_patterns": A.hourly_patterns(s, tz),
        "event_type_distribution": A.event_type_distribution(s),
        "punctuality_distribution": A.punctuality_distribution(s),
        "toc_ranking": A.toc_ranking(s),
        "toc_status_heatmap": A.toc_status_heatmap(s),
        "daily_trends": A.daily_trends(s, tz=tz),
        "weekly_calendar": A.weekly_calendar(s, tz),
        "route_performance": A.route_performance(s),
        "toc_hour_matrix": A.toc_hour_matrix(s, tz=tz),
        "realtime_gauge": A.realtime_gauge(s, as_of_date, tz),
        "leaderboard": A.leaderboard(s),
        "row_count": A.row_count(s),
        "company_tree": A.company_tree(c),
        "company_ranking": A.company_ranking(c),
    }


def write_charts(charts_by_name: dict[str, DataFrame], out_dir: str,
                 max_workers: int = 8) -> dict[str, str]:
    """Write every chart's result below ``out_dir/<name>``, jobs in parallel.

    The charts are small independent jobs over the same summary; Spark runs
    jobs submitted from separate threads concurrently, so a refresh takes
    about as long as its slowest chart instead of the sum.  Each result is
    bounded by its keys (operators x hours, 30 rows, 168 cells ...), so one
    output file per chart is enough.
    """
    from concurrent.futures import ThreadPoolExecutor

    def one(item):
        name, df = item
        path = f"{out_dir.rstrip('/')}/{name}"
        df.coalesce(1).write.mode("overwrite").parquet(path)
        return name, path

    with ThreadPoolExecutor(max_workers=max_workers) as pool:
        return dict(pool.map(one, charts_by_name.items()))
