"""Progress of streaming queries as a table (V9, T6).

A query keeps its last progress reports only (100 by default).  ``ProgressTable`` is a listener that files each
report as it comes, as one JSON object named by query and batch, so that a report which comes
again replaces itself.  A report has the rows read, the rows in and dropped from the state, the
durations and what the query observes (the ingest counters, say).  Reports are small and come once a
micro-batch; they are written by the driver, where Spark delivers them.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from trackside.operators.decode import STATUSES
from trackside.session import jvm_path, path_exists

PROGRESS_SCHEMA = ("query string, run string, name string, batch bigint, at string, input_rows bigint, state_rows bigint, "
                   "dropped_late bigint, duration_ms bigint, observed map<string,bigint>")


class ProgressTable(StreamingQueryListener):
    """Files every progress report of the session's queries below ``path``.

    Use: ``listener = ProgressTable(spark, path)``, ``spark.streams.addListener(listener)``.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        observed = {k: v for row in (p.observedMetrics or {}).values() for k, v in row.asDict().items() if isinstance(v, int)}
        report = {"query": str(p.id), "run": str(p.runId), "name": p.name, "batch": p.batchId, "at": p.timestamp,
                  "input_rows": p.numInputRows, "state_rows": sum(s.numRowsTotal for s in p.stateOperators),
                  "dropped_late": sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
                  "duration_ms": (p.durationMs or {}).get("triggerExecution"), "observed": observed}
        # an idle trigger reports its batch again, without rows: what the batch did stays
        kind = "batch" if p.numInputRows or observed else "idle"
        fs, at = jvm_path(self._spark, f"{self._path}/{p.id}-{p.batchId}.{kind}.json")
        out = fs.create(at, True)
        out.write(bytearray(json.dumps(report).encode()))
        out.close()


def settled(spark: SparkSession, seconds: int = 60) -> None:
    """Wait until the session's listeners have all events so far (before a finished query's table is read)."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(seconds * 1000)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """All filed reports, one row for each batch of each query."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], PROGRESS_SCHEMA)
    return spark.read.schema(PROGRESS_SCHEMA).option("pathGlobFilter", "*.batch.json").json(path)


def progress_totals(progress: DataFrame) -> DataFrame:
    """One row: the status counts of all batches, like ``ingest.counter_totals``."""
    return progress.agg(*[F.coalesce(F.sum(F.col("observed").getItem(s)), F.lit(0)).alias(s) for s in STATUSES])
