"""Analytics edge semantics: rounding, empty gauge, ties, delay means, rollup."""

import datetime as dt

import pytest

from trackside.functions.exprs import pct, round_half_away
from trackside.operators import analytics as A
from trackside.operators import views as V

SCHEMA = ("toc_id string, variation_status string, event_type string, "
          "actual_timestamp timestamp, planned_timestamp string, train_id string, "
          "loc_stanox string, route string")


def _m(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _ts(s):
    return dt.datetime.fromisoformat(s)


def _ms(s):
    return str(int(_ts(s).replace(tzinfo=dt.timezone.utc).timestamp() * 1000))


def test_round_on_binary_value(spark):
    df = spark.createDataFrame([(1.005,), (2.5,), (-2.5,), (0.125,)], "x double")
    got = [r[0] for r in df.select(round_half_away("x", 2)).collect()]
    assert got == [1.0, 2.5, -2.5, 0.13]            # 1.005 is 1.00499.. in binary
    got0 = [r[0] for r in df.select(round_half_away("x", 0)).collect()]
    assert got0 == [1.0, 3.0, -3.0, 0.0]


def test_pct_is_null_on_zero(spark):
    df = spark.createDataFrame([(1, 0), (1, 3)], "a long, b long")
    assert [r[0] for r in df.select(pct("a", "b")).collect()] == [None, 33.33]


def test_gauge_empty_day_is_null(spark):
    m = _m(spark, [("20", "ON TIME", "ARRIVAL", _ts("2024-01-01 10:00:00"), None, "T", "1", "1")])
    assert A.realtime_gauge(m, "2024-01-02").first()[0] is None
    assert A.realtime_gauge(m, "2024-01-01").first()[0] == 100.0


def test_journey_flow_delay_mean(spark):
    t = "2024-01-01 10:00:00"
    rows = [("20", "LATE", "ARRIVAL", _ts(t), _ms("2024-01-01 09:57:00"), "A", "1", "1"),
            ("20", "LATE", "ARRIVAL", _ts(t), None, "B", "1", "1"),        # left out of mean
            ("20", "ON TIME", "ARRIVAL", _ts(t), _ms(t), "C", "1", "1"),   # counts as 0
            ("20", "EARLY", "DEPARTURE", _ts(t), _ms("2024-01-01 10:01:00"), "D", "1", "1")]
    got = {r.event_type: (r.movement_count, r.avg_delay_minutes)
           for r in A.journey_flow(_m(spark, rows)).collect()}
    assert got == {"ARRIVAL": (3, 1.5), "DEPARTURE": (1, 0.0)}


def test_ranking_threshold_is_strict_and_ties_break_on_code(spark):
    t = _ts("2024-01-01 10:00:00")
    rows = [(c, "ON TIME", "ARRIVAL", t, None, "T", "1", "1") for c in ["b", "a"] for _ in range(11)]
    rows += [("c", "ON TIME", "ARRIVAL", t, None, "T", "1", "1")] * 10
    got = [r.toc_id for r in A.toc_ranking(_m(spark, rows)).collect()]
    assert got == ["a", "b"]


def test_daily_trends_limit_counts_rows(spark):
    rows = [("20", s, "ARRIVAL", _ts(f"2024-01-{d:02d} 10:00:00"), None, "T", "1", "1")
            for d in range(1, 21) for s in ["ON TIME", "LATE"]]
    out = A.daily_trends(_m(spark, rows)).collect()
    assert len(out) == 30 and out[0].date == dt.date(2024, 1, 20)


def test_company_tree_subtotals(spark):
    t = _ts("2024-01-01 10:00:00")
    rows = [("20", "LATE", "ARRIVAL", t, None, "T", "1", "1"),
            ("20", "ON TIME", "ARRIVAL", t, None, "T", "1", "1"),
            (None, "ON TIME", "ARRIVAL", t, None, "T", "1", "1")]
    mart = V.operating_company_performance(_m(spark, rows))
    got = {(r[0], r[1]): r[2] for r in A.company_tree(mart).collect()}
    assert got[(None, None)] == 3
    assert got[("TransPennine Express", None)] == 2
    assert got[("Unknown", "ON TIME")] == 1


def test_local_zone_option(spark):
    m = _m(spark, [("20", "ON TIME", "ARRIVAL", _ts("2024-06-30 23:30:00"), None, "T", "1", "1")])
    assert A.hourly_patterns(m).first().hour_of_day == 23
    assert A.hourly_patterns(m, tz="Europe/London").first().hour_of_day == 0


def test_summary_counts_equal_direct_counts(spark):
    from trackside.operators.summary import movement_summary, company_summary
    from trackside.registry import movements
    from conftest import SF_SMALL
    m = movements(spark, SF_SMALL)
    s = movement_summary(m)
    assert s.count() < m.count()
    for f in [A.toc_ranking, A.hourly_patterns, A.weekly_calendar, A.daily_trends,
              A.route_performance, A.punctuality_share, A.row_count]:
        a, b = f(m), f(s)
        assert a.schema == b.schema and a.exceptAll(b).count() == 0 == b.exceptAll(a).count()
    mart = V.operating_company_performance(V.stg_movements(m))
    assert A.company_tree(mart).exceptAll(A.company_tree(company_summary(s))).count() == 0
    assert A.realtime_gauge(s.limit(0), "2024-01-02").first()[0] is None


def test_as_of_is_session_zone_not_process_zone(spark):
    import os
    import time as _time
    m = _m(spark, [("20", "ON TIME", "ARRIVAL", _ts("2024-01-30 23:30:00"), None, "T", "1", "1")])
    old = os.environ.get("TZ")
    os.environ["TZ"] = "America/New_York"
    _time.tzset()
    try:
        for as_of in ["2024-01-31 00:00:00", dt.datetime(2024, 1, 31),
                      dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc)]:
            assert A.recent_movements(m, as_of=as_of, hours=1).count() == 1
    finally:
        if old is None:
            os.environ.pop("TZ", None)
        else:
            os.environ["TZ"] = old
        _time.tzset()


def test_a_summary_answers_in_its_own_zone_alone(spark):
    from trackside.operators.summary import charts, movement_summary
    from trackside.sources.standin import standin_movements
    m = standin_movements(spark.read.parquet("/root/testdata/sf0.001/events.parquet"), shift_days=150)
    london = movement_summary(m, "Europe/London")
    with pytest.raises(ValueError, match="Europe/London"):
        A.hourly_patterns(london)
    assert A.hourly_patterns(london, "Europe/London").collect() == A.hourly_patterns(m, "Europe/London").collect()
    assert charts(london, "2024-06-10")["hourly_patterns"].collect() == A.hourly_patterns(m, "Europe/London").collect()


def test_a_foreign_session_zone_is_refused(spark):
    m = spark.createDataFrame([("1",)], "toc_id string").selectExpr("toc_id", "timestamp'2024-01-15 00:00:00' AS actual_timestamp")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError, match="New_York"):
            A.hourly_patterns(m)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_delays_that_overflow_are_null(spark):
    m = spark.sql("SELECT 'LATE' AS variation_status, 'ARRIVAL' AS event_type, timestamp'2024-01-15 00:00:00' AS "
                  "actual_timestamp, '-9223372036854775808' AS planned_timestamp")
    assert [r.delay_minutes for r in A.delay_distribution(m).collect()] == [None]
    assert A.journey_flow(m).first().avg_delay_minutes is None
