"""The movements table in the catalog (S7, V4): an external table with its partitions and statistics.

The files stay where the load writes them.  The catalog knows the days: a load adds those it has written
(``load_days(catalog_table=...)``), so a query lists no directory, and a filter on ``uk_date`` is answered by the
catalog.  Row counts and sizes are kept for each day and for the table, for the planner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trackside.plans.compact import table_days
from trackside.schema import COLUMN_DOCS, MOVEMENTS_SCHEMA

#: Days that one statement adds.
CHUNK = 200


def create_table(spark: SparkSession, name: str, table_path: str) -> None:
    """``name`` (schema.table) over the table's files, with column comments; days that are there already are added."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()} COMMENT '{COLUMN_DOCS[f.name]}'" for f in MOVEMENTS_SCHEMA.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet PARTITIONED BY (uk_date) LOCATION '{table_path}'")
    add_days(spark, name, table_days(spark, table_path))


def add_days(spark: SparkSession, name: str, days: list[str]) -> None:
    """Make written days known, and measure them anew."""
    for k in range(0, len(days), CHUNK):
        parts = " ".join(f"PARTITION (uk_date = '{d}')" for d in days[k:k + CHUNK])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
    spark.catalog.refreshTable(name)
    for d in days:
        spark.sql(f"ANALYZE TABLE {name} PARTITION (uk_date = '{d}') COMPUTE STATISTICS")


def measure(spark: SparkSession, name: str) -> None:
    """Statistics of the whole table (its rows are counted from file footers)."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")


def day_statistics(spark: SparkSession, name: str, day: str) -> str:
    """The catalog's note on a day, e.g. ``1234 bytes, 56 rows`` (empty: none)."""
    rows = spark.sql(f"DESCRIBE EXTENDED {name} PARTITION (uk_date = '{day}')").where("col_name = 'Partition Statistics'")
    return "".join(r["data_type"] for r in rows.toLocalIterator())


def catalog_movements(spark: SparkSession, name: str) -> DataFrame:
    """The movements as the catalog has them; filters on ``uk_date`` select days there."""
    return spark.table(name)
