"""The queries of the training-data operators against independent DuckDB SQL (sf0.001)."""

import math

import duckdb
import pytest

from trackside.llm import queries as Q

SF_SMALL = "/root/testdata/sf0.001"


def canon(df):
    cols = sorted(df.columns)

    def plain(v):
        if v is None or v != v:
            return None
        v = v.item() if hasattr(v, "item") else v
        return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v

    return cols, sorted((tuple(map(plain, r)) for r in df[cols].astype(object).itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    got = Q.queries()[name](spark, SF_SMALL).toPandas()
    want = duck.sql(Q.oracle_sql()[name]).df()
    assert canon(got) == canon(want)


def test_every_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in Q.queries())
    assert numbers == list(range(1, len(numbers) + 1))


@pytest.mark.parametrize("name", ["op1_quality_rules", "op9_pii_surrogates"])
def test_native_operators_run_no_python(spark, name):
    plan = Q.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
