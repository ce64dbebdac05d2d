"""Daily load: one or more London days of the lake -> the movements table.

One Spark job per call, whatever the number of days:

    lake scan (partition-pruned to the days) -> parse -> flatten -> observe
    (quality counts) -> key filter -> write ``partitionBy(uk_date)`` with
    dynamic partition overwrite

* Day replacement is the overwrite of exactly the ``uk_date`` partitions
  present in the output: a replay of a day equals a first load, other days
  are untouched, and a day with no complete row writes nothing, so the old
  data stays (the "abort" of the load gates, without a delete-then-load gap).
* One date definition (the London date) drives the lake directory, the
  table partition and the replacement.
* The lake is read once, for a list of days and for all of it alike: which days were written,
  and what the report counts, is observed in the write itself, so files that land
  meanwhile are either in the table and in the report or in neither.  Objects of a file each are
  packed into a few files first, by the tasks: their number never reaches the driver.
* Only the directories of the days are opened, in the lake and in the table,
  and each once: a load costs its own days, whatever lies beside them.
* The quality report is collected with ``observe`` during the same pass,
  so the day is read once; the input size never reaches the driver.
* Executor loss is handled by task retry and the output commit protocol:
  a partition appears only when its job commits.
"""

from __future__ import annotations

import dataclasses
import datetime as _dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trackside.operators.dedup import dedup_exact
from trackside.operators.flatten import complete_rows, flatten, require_columns
from trackside.operators.quality import quality_aggs
from trackside.schema import KEY_COLUMNS, MOVEMENTS_SCHEMA, TABLE_COLUMNS, documented
from trackside.session import jvm_path, path_exists
from trackside.sources.lake import last_writer, pack_objects, read_lake_objects, read_packed


@dataclasses.dataclass
class LoadReport:
    """Counts of one load.  ``status``: ``loaded`` (every day), ``partly loaded``, or why nothing
    was; ``day_status`` says it for each day.  ``deleted`` counts the old rows of the days that
    were replaced, ``written`` the rows in their place."""

    days: list[str] | None
    status: str
    day_status: dict = dataclasses.field(default_factory=dict)
    invalid_objects: int = 0
    total_rows: int = 0
    valid_rows: int = 0
    written: int = 0
    misfiled: int = 0
    deleted: int = 0
    day_rows: int | None = None
    table_rows: int | None = None
    non_null: dict = dataclasses.field(default_factory=dict)
    nulls: dict = dataclasses.field(default_factory=dict)

    def to_row(self) -> dict:
        row = {"days": ",".join(self.days) if self.days else "*", "status": self.status,
               "day_status": ",".join(f"{d}: {s}" for d, s in sorted(self.day_status.items())),
               "invalid_objects": self.invalid_objects,
               "total_rows": self.total_rows, "valid_rows": self.valid_rows,
               "written": self.written, "misfiled": self.misfiled, "deleted": self.deleted,
               "day_rows": self.day_rows, "table_rows": self.table_rows}
        row.update({f"non_null_{k}": v for k, v in self.non_null.items()})
        row.update({f"null_{k}": v for k, v in self.nulls.items()})
        return row


def _entries(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a directory, hidden files aside (none if it is not there)."""
    fs, p = jvm_path(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(n for n in names if n[0] not in "._")


def table_exists(spark: SparkSession, path: str) -> bool:
    return bool(_entries(spark, path))


def _read_days(spark: SparkSession, table_path: str, days: list[str] | None) -> DataFrame | None:
    """The table's rows of some days (all: None), their directories opened alone; None if there are none."""
    if days is None:
        return spark.read.parquet(table_path) if table_exists(spark, table_path) else None
    there = [f"{table_path.rstrip('/')}/uk_date={d}" for d in days]
    there = [d for d in there if path_exists(spark, d)]
    return spark.read.option("basePath", table_path).parquet(*there) if there else None


def ensure_compatible(spark: SparkSession, table_path: str, allow_drop: bool = False) -> str:
    """Check an existing table's schema against the load schema.

    Returns ``"absent"``, ``"ok"`` or ``"dropped"``; an incompatible table
    (e.g. ``raw_data`` stored as text) is removed only with ``allow_drop``.
    """
    entries = _entries(spark, table_path)
    if not entries:
        return "absent"
    # all days have one schema: one of them tells it
    existing = spark.read.parquet(f"{table_path.rstrip('/')}/{entries[-1]}").schema
    want = {f.name: f.dataType for f in MOVEMENTS_SCHEMA.fields}
    have = {f.name: f.dataType for f in existing.fields}
    bad = [n for n, t in have.items() if n in want and t != want[n]]
    bad += [n for n in have if n == "raw_data"]
    if not bad:
        return "ok"
    if not allow_drop:
        raise ValueError(f"table at {table_path} has incompatible columns {bad}; "
                         "pass allow_drop=True to replace it")
    fs, p = jvm_path(spark, table_path)
    fs.delete(p, True)
    return "dropped"


#: The days that a bitmap has a place for, from the first on (to 2059-09-18).
_BITMAP_DAYS, _FIRST = 32_768, _dt.date(1970, 1, 1)


def _day_number(date: str) -> Column:
    return F.datediff(F.col(date), F.lit(_FIRST))


def written_days(date: str = "uk_date") -> list[Column]:
    """Aggregates for ``observe``: the ``rows``, which dates they hold (a bitmap, a bit for each date), and how many
    rows have a date that the bitmap has no place for."""
    n = _day_number(date)
    here = n.between(0, _BITMAP_DAYS - 1)
    return [F.count(F.lit(1)).alias("rows"), F.bitmap_construct_agg(F.when(here, n)).alias("days"),
            F.count_if(~here).alias("elsewhere")]


def days_of(observed: dict) -> list[str]:
    """The dates in the bitmap of ``written_days``, in order."""
    return [(_FIRST + _dt.timedelta(8 * i + j)).isoformat()
            for i, byte in enumerate(observed.get("days") or b"") if byte for j in range(8) if byte >> j & 1]


def load_days(spark: SparkSession, lake_base: str, table_path: str,
              days: list[str] | None = None, whole_objects: bool = False,
              dedup_keys: list[str] | None = None, verify: str | bool | None = "days",
              allow_drop: bool = False, lake_format: str = "json",
              summary_path: str | None = None, last_writer_wins: bool = False,
              rollup_path: str | None = None, catalog_table: str | None = None) -> LoadReport:
    """Load the given London days (all lake days when ``None``) into the table.

    ``whole_objects`` reads lakes of one (pretty-printed) object a file.  Objects that
    are no JSON object are counted (``invalid_objects``) and skipped.  A lake or a day
    that is not there loads nothing and leaves the table as it was.

    ``last_writer_wins``: of objects with one name, written by any number of runs, the
    last alone is loaded (as in a lake that keeps one object for each name).

    With ``summary_path`` the movement summary of the loaded days is
    refreshed after the write (one day's scan, see ``operators.summary``), with ``rollup_path`` the
    rollups (``operators.rollups``); ``catalog_table`` names a table whose days they become (``plans.catalog``).

    ``verify``: ``"days"`` (default) counts the rows now in the loaded days,
    a partition-pruned count; ``"table"`` also counts the whole table, which
    on a large table means reading every file footer; ``None`` skips both.
    """
    ensure_compatible(spark, table_path, allow_drop)
    found = Observation("objects")
    packed = pack_objects(spark, lake_base, days) if whole_objects and lake_format != "parquet" else None
    objects = (read_packed(spark, packed) if packed
               else read_lake_objects(spark, lake_base, days, whole_objects, lake_format))
    require_columns(objects, ["event_type", "toc_id", "variation_status", "raw_data"])
    objects = objects.observe(found, F.count_if(~F.col("ok")).alias("invalid")).where("ok")
    flat = flatten(last_writer(objects) if last_writer_wins else objects)
    day_set = [_dt.date.fromisoformat(d) for d in days] if days else None
    in_days = F.col("uk_date").isin(day_set) if day_set else F.lit(True)
    complete = F.lit(True)
    for k in KEY_COLUMNS:
        complete = complete & F.col(k).isNotNull()
    obs = Observation("load_day")
    observed = flat.observe(obs, *quality_aggs(),
                            F.count_if(complete & ~in_days).alias("misfiled"))
    clean = complete_rows(observed).where(in_days)
    if dedup_keys:
        clean = dedup_exact(clean, dedup_keys)
    if whole_objects:
        # every task reads objects of all days: without this each of them writes files of its own to the table
        clean = clean.hint("rebalance", "uk_date")
    # what is written is counted at the writer: the rows, and the days as a bitmap
    landed = Observation("landed")
    clean = clean.observe(landed, *written_days())

    old = _read_days(spark, table_path, days)
    before = {r.uk_date.isoformat(): r["count"] for r in old.groupBy("uk_date").count().collect()} if old else {}

    # Sorting each task's rows by (uk_date, actual_timestamp) is the sort the
    # partitioned writer needs anyway, extended by the time: row groups then
    # hold narrow time ranges, and time filters skip them by min/max stats.
    # column comments are attached here, at the table boundary (Parquet keeps them)
    (documented(clean.select(*TABLE_COLUMNS)).sortWithinPartitions("uk_date", "actual_timestamp")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("uk_date").parquet(table_path))
    m, w = obs.get, landed.get
    written = w.get("rows", 0)
    why = "aborted: no rows" if m.get("total_rows", 0) == 0 else "aborted: no complete row"
    replaced = days_of(w)
    if w.get("elsewhere", 0):
        # dates before 1970 or after 2059 (a clock gone wrong): these few rows are looked up again
        odd = clean.where(~_day_number("uk_date").between(0, _BITMAP_DAYS - 1)).select("uk_date").distinct().collect()
        replaced = sorted([*replaced, *[r.uk_date.isoformat() for r in odd]])
    if packed:
        fs, p = jvm_path(spark, packed)
        fs.delete(p, True)
    # a whole-lake load replaces the days that it wrote
    day_status = {d: "loaded" if d in replaced else why for d in days or replaced}
    status = why if not written else "loaded" if not days or len(replaced) == len(days) else "partly loaded"
    report = LoadReport(
        days=days, status=status, day_status=day_status, invalid_objects=found.get.get("invalid", 0),
        total_rows=m.get("total_rows", 0), valid_rows=m.get("valid_rows", 0), written=written,
        misfiled=m.get("misfiled", 0), deleted=sum(before.get(d, 0) for d in replaced),
        non_null={k: m.get(f"non_null_{k}", 0) for k in KEY_COLUMNS},
        nulls={k: v for k, v in ((c[5:], m[c]) for c in m if c.startswith("null_"))})
    if summary_path and written:
        from trackside.operators.summary import refresh_summary
        refresh_summary(spark, table_path, summary_path, replaced if days else None)
    if rollup_path and written:
        from trackside.operators.rollups import refresh_rollups
        refresh_rollups(spark, table_path, rollup_path, replaced)
    if catalog_table and written:
        from trackside.plans.catalog import add_days, create_table
        if spark.catalog.tableExists(catalog_table):
            add_days(spark, catalog_table, replaced)
        else:
            create_table(spark, catalog_table, table_path)
    if verify:
        now = _read_days(spark, table_path, days)
        report.day_rows = now.count() if now else 0
        if verify == "table" or verify is True:
            report.table_rows = spark.read.parquet(table_path).count() if table_exists(spark, table_path) else 0
    return report


def load_day(spark: SparkSession, lake_base: str, table_path: str, ds: str,
             **kw) -> LoadReport:
    """Replace one London day (``ds`` = YYYY-MM-DD) of the table from the lake."""
    return load_days(spark, lake_base, table_path, [ds], **kw)


def report_frame(spark: SparkSession, report: LoadReport) -> DataFrame:
    """A load report as a one-row DataFrame."""
    row = report.to_row()
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) else 'bigint'}"
                       for k, v in row.items())
    return spark.createDataFrame([tuple(row.values())], schema)


def append_table(df: DataFrame, table_path: str) -> None:
    """Typed append under the fixed schema (K5): columns cast, ``uk_date`` partitions."""
    cols = [(F.col(c) if c in df.columns else F.lit(None))
            .cast(MOVEMENTS_SCHEMA[c].dataType).alias(c) for c in TABLE_COLUMNS]
    (documented(df.select(*cols)).sortWithinPartitions("uk_date", "actual_timestamp")
     .write.mode("append").partitionBy("uk_date").parquet(table_path))


def read_table(spark: SparkSession, table_path: str) -> DataFrame:
    """The movements table (S7); filters on ``uk_date`` prune directories."""
    return spark.read.parquet(table_path)
