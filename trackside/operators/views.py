"""Staging and mart views over the movements table, and their registration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackside.functions.exprs import toc_name
from trackside.schema import STAGING_COLUMNS, documented


def stg_movements(m: DataFrame) -> DataFrame:
    """Staging view: the 29 feed columns, projection only (pruned at the scan)."""
    return m.select(*STAGING_COLUMNS)


def with_company(df: DataFrame, code: str = "toc_id",
                 out: str = "train_operating_company") -> DataFrame:
    """Add the operating-company name for an operator code (Unknown otherwise)."""
    return df.withColumn(out, toc_name(code))


def operating_company_performance(stg: DataFrame) -> DataFrame:
    """Mart view: instant, operating-company name, variation status."""
    return stg.select("actual_timestamp",
                      toc_name("toc_id").alias("train_operating_company"),
                      "variation_status")


def document(df: DataFrame, docs: dict | None = None) -> DataFrame:
    """Attach column comments (StructField metadata) to a DataFrame."""
    if docs is None:
        return documented(df)
    return df.select(*[F.col(c).alias(c, metadata={"comment": docs[c]}) if c in docs
                       else F.col(c) for c in df.columns])


def register_views(spark: SparkSession, movements: DataFrame,
                   prefix: str = "") -> dict[str, DataFrame]:
    """Register ``movements``, the staging view and the mart view as temp views.

    Views are expanded at read time, so a query over the mart still prunes
    columns and pushes filters down to the movements scan.
    """
    stg = stg_movements(movements)
    mart = operating_company_performance(stg)
    views = {f"{prefix}movements": movements,
             f"{prefix}stg_movements": stg,
             f"{prefix}operating_company_performance": mart}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views


def register_catalog_views(spark: SparkSession, table_path: str | None, location: str,
                           staging_db: str = "staging", reporting_db: str = "reporting",
                           catalog_table: str | None = None) -> list[str]:
    """Catalog views in a staging and a reporting schema over the table path, or over a catalog table.

    The views are SQL over the Parquet path, so every read expands them
    against the current files (a replaced day is visible at once) and keeps
    pruning and pushdown.  ``location`` holds the databases' own folders.
    """
    from trackside.schema import TOC_NAMES, UNKNOWN_COMPANY
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {staging_db} LOCATION '{location}/{staging_db}'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {reporting_db} "
              f"LOCATION '{location}/{reporting_db}'")
    cols = ", ".join(STAGING_COLUMNS)
    src = catalog_table or f"parquet.`{table_path}`"
    spark.sql(f"CREATE OR REPLACE VIEW {staging_db}.stg_movements AS SELECT {cols} FROM {src}")
    cases = " ".join(f"WHEN toc_id = '{k}' THEN '{v}'" for k, v in TOC_NAMES.items())
    spark.sql(f"CREATE OR REPLACE VIEW {reporting_db}.operating_company_performance AS "
              f"SELECT actual_timestamp, CASE {cases} ELSE '{UNKNOWN_COMPANY}' END "
              f"AS train_operating_company, variation_status FROM {staging_db}.stg_movements")
    return [f"{staging_db}.stg_movements", f"{reporting_db}.operating_company_performance"]
