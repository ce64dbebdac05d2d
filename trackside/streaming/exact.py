"""Exact duplicate control for streams (T4): no movement is lost, however late it comes.

A watermark drops what comes after it, duplicate or not.  Here each micro-batch is compared with what is
already in the table instead: the keys of the days it touches, read from the table's own partitions, are
dealt by key together with the batch, and of each key that only the batch has one row is kept.  A small batch
cuts the days' keys down to its own before.  The table itself is the state, so nothing is kept in a state store.

The table is partitioned by London date and batch; a batch that runs again leaves its own directories out of
the comparison and overwrites them, so a retry lands once.  Equal keys have equal times, hence one
date, so a duplicate is always in a touched day.  Null keys count as equal.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackside.operators.decode import decode_frames, only_movements, to_envelope
from trackside.operators.flatten import complete_rows, flatten
from trackside.schema import TABLE_COLUMNS
from trackside.session import path_exists
from trackside.streaming.ingest import DEDUP_KEYS, append_batch, batch_name, started


#: Batches of up to so many rows are sent to the table's keys; for larger ones both are dealt by key.
SENT_ROWS = 200_000


def new_rows(rows: DataFrame, old: DataFrame | None, keys: list[str]) -> DataFrame:
    """The smallest row of each key that is not among ``old`` (its key columns), in one pass dealt by key:
    duplicates inside the batch and keys that are there already fall out together."""
    rest = [c for c in rows.columns if c not in keys]
    rows = rows.select(*keys, F.struct(F.lit(True).alias("_new"), *rest).alias("_row"))
    if old is not None:
        rows = rows.unionByName(old.select(*keys), allowMissingColumns=True)
    # rows of the table have no _row: a key that counts one is not new
    return (rows.groupBy(*keys).agg(F.min("_row").alias("_row"), F.max(F.col("_row").isNull()).alias("_old"))
            .where(~F.col("_old")).select(*keys, *[F.col("_row").getField(c).alias(c) for c in rest]))


def append_new(rows: DataFrame, table_path: str, batch: str, keys: list[str] | None = None) -> None:
    """Append those rows (of one micro-batch, table columns) whose keys the table does not have yet."""
    keys = keys or DEDUP_KEYS
    spark = rows.sparkSession
    rows = rows.select(*TABLE_COLUMNS).persist()   # the batch is read twice: for its days, then for its rows
    # a few dates; their directories alone are listed and read
    days = {r["uk_date"].isoformat(): r["count"] for r in rows.groupBy("uk_date").count().collect()}
    old, there = None, [p for p in (f"{table_path.rstrip('/')}/uk_date={d}" for d in days) if path_exists(spark, p)]
    if there:
        old = spark.read.option("basePath", table_path).parquet(*there).where(F.col("batch") != batch).select(*keys)
        if sum(days.values()) <= SENT_ROWS:
            # a small batch meets the day's keys first, so that the day is not dealt by key
            mine = rows.select(*keys)
            old = old.join(F.broadcast(mine), reduce(and_, [old[k].eqNullSafe(mine[k]) for k in keys]), "left_semi")
    append_batch(new_rows(rows, old, keys).select(*TABLE_COLUMNS), table_path, batch)
    rows.unpersist()


def stream_to_table_exact(frames: DataFrame, table_path: str, checkpoint: str, processed_at=None,
                          keys: list[str] | None = None, compat: bool = False, trigger: dict | None = None):
    """Start frames -> typed complete movements -> table, each key once.  Returns the StreamingQuery."""
    env = to_envelope(only_movements(decode_frames(frames, compat=compat)), processed_at)

    def each(batch: DataFrame, batch_id: int) -> None:
        append_new(batch, table_path, batch_name(batch.sparkSession, checkpoint, batch_id), keys)

    rows = complete_rows(flatten(env)).select(*TABLE_COLUMNS)
    return started(rows.writeStream.foreachBatch(each), checkpoint, trigger)
