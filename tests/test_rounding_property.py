"""round_half_away(x, n) in Spark == ROUND(x, n) in DuckDB on the same DOUBLE."""

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from trackside.functions.exprs import pct, round_half_away

# decimal ties (x.xx5), near-ties and ordinary values, both signs
ties = st.integers(-10**7, 10**7).map(lambda k: (2 * k + 1) / 2000)
values = st.one_of(ties, st.floats(-1e6, 1e6, allow_nan=False), st.just(1.005),
                   st.just(-2.675), st.just(0.125))


@settings(max_examples=10, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(values, min_size=1, max_size=200), st.sampled_from([0, 1, 2]))
def test_round_matches_duckdb(spark, xs, digits):
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(xs)], "i int, x double")
    got = {r.i: r.y for r in df.select("i", round_half_away("x", digits).alias("y")).collect()}
    con = duckdb.connect()
    want = dict(con.execute(
        f"SELECT i, ROUND(x, {digits}) FROM (SELECT UNNEST(?) AS x, "
        f"UNNEST(range(?)) AS i)", [list(map(float, xs)), len(xs)]).fetchall())
    assert got == want


@settings(max_examples=10, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(1, 10**6)), min_size=1,
                max_size=200))
def test_percentages_match_duckdb(spark, pairs):
    pairs = [(min(a, b), b) for a, b in pairs]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)],
                               "i int, a long, b long")
    got = {r.i: r.p for r in df.select("i", pct("a", "b").alias("p")).collect()}
    con = duckdb.connect()
    want = dict(con.execute(
        "SELECT i, ROUND(a * 100e0 / b, 2) FROM (SELECT UNNEST(?) AS a, UNNEST(?) AS b, "
        "UNNEST(range(?)) AS i)",
        [[a for a, _ in pairs], [b for _, b in pairs], len(pairs)]).fetchall())
    assert got == want
