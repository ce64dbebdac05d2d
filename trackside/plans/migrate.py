"""Migration of a table whose bodies are text (K8): rewritten day by day instead of dropped.

An older table held each movement's body as JSON text in ``raw_data``.  Dropping it, which the load
would otherwise need, loses every day that the lake no longer has.  Here each day is parsed, flattened and typed like
a lake object and written into the new table.  A body that is no JSON object is counted and left out of the new table; the
old one is not touched.  A day is marked when it is done, so that a migration which broke goes on with the next day.
"""

from __future__ import annotations

import dataclasses
import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trackside.operators.flatten import complete_rows, flatten
from trackside.plans.compact import table_days
from trackside.schema import STAGING_COLUMNS, TABLE_COLUMNS, documented
from trackside.session import jvm_path, path_exists

MARKS = "_migrated"


@dataclasses.dataclass
class DayMigration:
    """Counts of one day: rows read, bodies that are no object, rows without a key, rows written."""

    day: str
    rows: int
    bad_bodies: int
    incomplete: int
    written: int


def parsed_bodies(rows: DataFrame) -> DataFrame:
    """Rows with ``raw_data`` as text -> envelopes with ``body_ok``; the body's fields are text, whatever JSON type they had."""
    body = F.from_json("raw_data", f"struct<{', '.join(f'`{c}`: string' for c in STAGING_COLUMNS)}, _corrupt: string>",
                       {"columnNameOfCorruptRecord": "_corrupt"})
    top = [c for c in ("event_type", "toc_id", "variation_status", "uk_datetime", "timestamp", "processed_at")]
    rows = rows.withColumn("body", body)
    ok = F.coalesce(F.startswith(F.ltrim("raw_data"), F.lit("{")) & F.col("body").isNotNull() & F.col("body._corrupt").isNull(), F.lit(False))
    return rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in top],
                       ok.alias("body_ok"), F.col("body").alias("raw_data"))


def migrate_table(spark: SparkSession, old_path: str, table_path: str, days: list[str] | None = None) -> list[DayMigration]:
    """Rewrite the days of a text-bodied table (all: None) into the movements table; the counts of every day, also of
    those that an earlier call has done."""
    old, new, out = old_path.rstrip("/"), table_path.rstrip("/"), []
    for day in table_days(spark, old) if days is None else days:
        mark = f"{new}/{MARKS}/{day}.json"
        if path_exists(spark, mark):
            out.append(DayMigration(**json.loads("".join(r[0] for r in spark.read.text(mark).toLocalIterator()))))
            continue
        seen, written = Observation(), Observation()
        rows = parsed_bodies(spark.read.parquet(f"{old}/uk_date={day}")).observe(
            seen, F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("body_ok")).alias("bad"))
        clean = complete_rows(flatten(rows.where("body_ok"))).observe(written, F.count(F.lit(1)).alias("rows"))
        (documented(clean.select(*TABLE_COLUMNS)).sortWithinPartitions("uk_date", "actual_timestamp")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("uk_date").parquet(new))
        total, bad, n = seen.get["rows"], seen.get["bad"], written.get["rows"]
        out.append(DayMigration(day, total, bad, total - bad - n, n))
        fs, p = jvm_path(spark, mark)
        to = fs.create(p, True)
        to.write(bytearray(json.dumps(dataclasses.asdict(out[-1])).encode()))
        to.close()
    return out


def migration_frame(spark: SparkSession, done: list[DayMigration]) -> DataFrame:
    """A migration's counts as a DataFrame, one row a day."""
    return spark.createDataFrame([dataclasses.astuple(d) for d in done],
                                 "day string, rows bigint, bad_bodies bigint, incomplete bigint, written bigint")
