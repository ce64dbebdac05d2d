"""Data-quality operators: declared column tests, load report, ingest statistics.

Each check is one pass with native aggregates; failing rows come back as a
DataFrame (zero rows = pass), so a check at scale never pulls data to the
driver beyond its small summary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackside.operators.decode import STATUSES
from trackside.schema import CRITICAL_FIELDS, KEY_COLUMNS


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    """Rows where ``col`` is NULL (the not_null test fails when any exist)."""
    return df.where(F.col(col).isNull())


def check_accepted(df: DataFrame, col: str, values: list[str]) -> DataFrame:
    """Values of ``col`` outside ``values`` with their counts; NULL is not a failure."""
    return (df.where(F.col(col).isNotNull() & ~F.col(col).isin(values))
            .groupBy(col).agg(F.count(F.lit(1)).alias("n_records")))


def accepted_failures(df: DataFrame, model: str, accepted: dict[str, list[str]]) -> DataFrame:
    """Failing values of several columns with their counts, in one pass over the model.

    Only a row's failing values leave the scan: model, column_name, value, n_records.
    """
    tested = F.array(*[F.when(F.col(c).isNotNull() & ~F.col(c).isin(vals),
                              F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")))
                       for c, vals in accepted.items()])
    return (df.select(F.explode(F.array_compact(tested)).alias("t"))
            .groupBy("t.column_name", "t.value").agg(F.count(F.lit(1)).alias("n_records"))
            .select(F.lit(model).alias("model"), "column_name", "value", "n_records"))


def run_checks(df: DataFrame, model: str, not_null: list[str],
               accepted: dict[str, list[str]]) -> DataFrame:
    """All declared tests of one model in a single aggregate pass.

    Returns one row per test: model, test, column, failures.
    """
    aggs, names = [], []
    for c in not_null:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"nn_{c}"))
        names.append(("not_null", c, f"nn_{c}"))
    for c, vals in accepted.items():
        aggs.append(F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(vals)).alias(f"av_{c}"))
        names.append(("accepted_values", c, f"av_{c}"))
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(t).alias("test"), F.lit(c).alias("column_name"),
                              F.col(a).alias("failures")) for t, c, a in names])
    return (wide.select(F.inline(rows))
            .select(F.lit(model).alias("model"), "test", "column_name", "failures"))


def quality_aggs(keys: list[str] | None = None, critical: list[str] | None = None) -> list[Column]:
    keys = keys or KEY_COLUMNS
    critical = critical or CRITICAL_FIELDS
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    out = [F.count(F.lit(1)).alias("total_rows")]
    out += [F.count(F.col(k)).alias(f"non_null_{k}") for k in keys]
    out += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in critical]
    out.append(F.count_if(complete).alias("valid_rows"))
    return out


def quality_report(df: DataFrame, keys: list[str] | None = None,
                   critical: list[str] | None = None) -> DataFrame:
    """Load quality in one aggregate: totals, non-null keys, null criticals, valid rows."""
    return df.agg(*quality_aggs(keys, critical))


def ingest_stats(decoded: DataFrame) -> DataFrame:
    """Processed / error counters of a decode run, one row.

    ``frames`` counts distinct frames only when a ``frame_id`` is carried;
    the status counts are exact either way.
    """
    aggs = [F.count_if(F.col("status") == s).alias(s) for s in STATUSES]
    aggs.append(F.count_if(F.col("status") != "bad_frame").alias("elements"))
    return decoded.agg(*aggs)
