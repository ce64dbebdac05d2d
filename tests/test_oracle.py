"""Every registered query against its independent DuckDB SQL (sf0.001)."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from trackside import registry

TABLES = ["events"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None).isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _canon(df: pd.DataFrame):
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in r) for r in df[cols].astype(object).itertuples(index=False)]
    return cols, sorted(rows, key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    missing = set(registry.queries()) - set(E.oracle_sql())
    assert missing == set()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "PythonUDF" not in plan and "InPandas" not in plan
    got = df.toPandas()
    want = duck.sql(E.oracle_sql()[name]).to_arrow_table().to_pandas(date_as_object=True)
    gc, gr = _canon(got)
    wc, wr = _canon(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["toc_id", "total_movements", "on_time_count",
                          "punctuality_percentage"]
    assert df.count() >= 0


@pytest.mark.parametrize("name", ["hourly_patterns", "daily_trends", "uk_datetime_text",
                                  "realtime_gauge"])
def test_queries_pin_utc_in_a_foreign_session_zone(spark, duck, name):
    """A driver's session may run in another zone; the queries pin UTC themselves."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = E.queries()[name](spark, SF_SMALL).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    want = duck.sql(E.oracle_sql()[name]).to_arrow_table().to_pandas(date_as_object=True)
    assert _canon(got) == _canon(want)
