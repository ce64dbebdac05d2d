"""Views, company mapping and the declared data tests."""

from pyspark.sql import functions as F

from trackside.operators import analytics as A
from trackside.operators import views as V
from trackside.operators.quality import (check_accepted, check_not_null, quality_report,
                                         run_checks)
from trackside.schema import STAGING_COLUMNS, TOC_NAMES, VARIATION_STATUSES


def _m(spark, rows):
    return spark.createDataFrame(rows, "toc_id string, variation_status string, "
                                       "event_type string, actual_timestamp timestamp")


def test_company_names_and_unknown(spark):
    df = spark.createDataFrame([(c,) for c in list(TOC_NAMES) + ["98", None]], "toc_id string")
    got = [r[0] for r in V.with_company(df).select("train_operating_company").collect()]
    assert got[:8] == list(TOC_NAMES.values()) and got[8:] == ["Unknown", "Unknown"]


def test_not_null_and_accepted_values(spark):
    m = _m(spark, [("20", "ON TIME", "ARRIVAL", None), ("20", "CANCELLED", "PASS", None),
                   ("20", None, "ARRIVAL", None), ("20", "CANCELLED", "ARRIVAL", None)])
    assert check_not_null(m, "variation_status").count() == 1
    acc = {r.variation_status: r.n_records
           for r in check_accepted(m, "variation_status", VARIATION_STATUSES).collect()}
    assert acc == {"CANCELLED": 2}          # null is not an accepted-values failure
    res = {(r.test, r.column_name): r.failures for r in run_checks(
        m, "x", ["variation_status", "actual_timestamp"],
        {"event_type": ["ARRIVAL", "DEPARTURE"]}).collect()}
    assert res == {("not_null", "variation_status"): 1, ("not_null", "actual_timestamp"): 4,
                   ("accepted_values", "event_type"): 1}


def test_quality_report_counts(spark):
    df = spark.createDataFrame([("T1", None, "20", "A"), (None, None, None, None),
                                ("T3", None, "20", "A")],
                               "train_id string, actual_timestamp timestamp, "
                               "toc_id string, event_type string")
    df = df.withColumn("actual_timestamp", F.when(F.col("train_id") == "T1",
                                                  F.current_timestamp()))
    r = quality_report(df).first().asDict()
    assert r["total_rows"] == 3 and r["valid_rows"] == 1
    assert r["non_null_toc_id"] == 2 and r["null_actual_timestamp"] == 2


def test_staging_view_and_registration(spark):
    from trackside.registry import movements
    from conftest import SF_SMALL
    m = movements(spark, SF_SMALL)
    views = V.register_views(spark, m, prefix="t_")
    assert views["t_stg_movements"].columns == STAGING_COLUMNS
    n = spark.sql("SELECT COUNT(*) FROM t_operating_company_performance").first()[0]
    assert n == m.count() == 743
    # Q25: parameterised ad-hoc SQL over the views
    r = A.run_sql(spark, "SELECT COUNT(*) AS n FROM t_movements WHERE toc_id = :t",
                  {"t": "88"}).first()
    assert r.n == m.where("toc_id = '88'").count()


def test_column_check_in_order(spark):
    from trackside.registry import movements
    from conftest import SF_SMALL
    m = movements(spark, SF_SMALL)
    cc = A.column_check(spark, m).collect()
    assert [r.column_name for r in cc] == m.columns
    assert cc[4].data_type == "DOUBLE" and cc[6].data_type == "TIMESTAMP"
    assert m.schema["route"].metadata["comment"]
