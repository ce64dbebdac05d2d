"""Compaction of a day-partitioned table: many small files of a day become few large ones (K5, T3).

A day whose files could be packed into fewer of ``target_bytes`` is rewritten, sorted by time as the load sorts it.  The
new files are made beside the table; then the day's directory is swapped for them by renames.  Files that
came meanwhile, and the newest batch of each stream (which may run again and must replace itself), are no part of
the rewrite and are carried over.  A list of what a rewrite took is kept until the swap is done, so that a job that dies
in it is completed by the next call; until then no row is lost.  Rows, columns and statistics stay those of the table.

Two layouts are known: files right below a day, and ``batch=`` directories below it.  A table of a streaming
file sink is refused: its readers know the files of its log alone.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import SparkSession

from trackside.session import jvm_path, path_exists
from trackside.sinks.lake import refuse_sink_log

TARGET_BYTES = 128 << 20
#: Hidden folder below the table: what is being rewritten.
WORK = "_compact"


def day_files(spark: SparkSession, table_path: str, day: str) -> dict[str, int]:
    """Sizes of a day's data files, by their path below the day."""
    at = f"{table_path.rstrip('/')}/uk_date={day}"
    if not path_exists(spark, at):
        return {}
    fs, p = jvm_path(spark, at)
    root, found, out = fs.makeQualified(p).toString(), fs.listFiles(p, True), {}
    while found.hasNext():
        f = found.next()
        name = f.getPath().toString()[len(root) + 1:]
        if not any(part[0] in "._" for part in name.split("/")):
            out[name] = f.getLen()
    return out


def table_days(spark: SparkSession, table_path: str) -> list[str]:
    fs, p = jvm_path(spark, table_path)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(n[8:] for n in names if n.startswith("uk_date="))


def _batch_of(name: str) -> tuple[str, int] | None:
    """The stream and number of the batch directory that a file lies in."""
    first = name.split("/")[0]
    stream, _, number = first[6:].rpartition("-") if first.startswith("batch=") else ("", "", "")
    return (stream, int(number)) if stream and number.isdigit() else None


def newest_batches(spark: SparkSession, table_path: str) -> set[tuple[str, int]]:
    """The last batch of each stream, over all days (directories are listed, no file is opened)."""
    last: dict[str, int] = {}
    for day in table_days(spark, table_path):
        fs, p = jvm_path(spark, f"{table_path.rstrip('/')}/uk_date={day}")
        for s in fs.listStatus(p):
            batch = _batch_of(s.getPath().getName() + "/")
            if batch:
                last[batch[0]] = max(batch[1], last.get(batch[0], 0))
    return set(last.items())


def compact(spark: SparkSession, table_path: str, days: list[str] | None = None,
            target_bytes: int = TARGET_BYTES) -> dict[str, tuple[int, int]]:
    """Compact the given days (all: None); returns for each rewritten day the number of files before and after."""
    refuse_sink_log(spark, table_path)
    finish_swaps(spark, table_path)
    base, done = table_path.rstrip("/"), {}
    keep = newest_batches(spark, base)
    for day in table_days(spark, base) if days is None else days:
        files = {n: size for n, size in day_files(spark, base, day).items() if _batch_of(n) not in keep}
        want = max(1, math.ceil(sum(files.values()) / target_bytes))
        if len(files) <= want:
            continue
        run = uuid.uuid4().hex
        work = f"{base}/{WORK}/{day}-{run}"
        batches = any("/" in n for n in files)
        rows = spark.read.parquet(*[f"{base}/uk_date={day}/{n}" for n in sorted(files)])
        (rows.repartitionByRange(want, "actual_timestamp").sortWithinPartitions("actual_timestamp")
         .write.parquet(f"{work}/new/batch=compacted_{run}" if batches else f"{work}/new"))
        _write_lines(spark, f"{work}/taken", files)
        _swap(spark, base, day, work)
        done[day] = (len(files), want)
    return done


def _write_lines(spark: SparkSession, path: str, lines) -> None:
    fs, p = jvm_path(spark, path)
    out = fs.create(p, True)
    out.write(bytearray("\n".join(lines).encode()))
    out.close()


def _swap(spark: SparkSession, base: str, day: str, work: str) -> None:
    """Put ``work/new`` in the day's place; every step may be met again after a failure."""
    fs, live = jvm_path(spark, f"{base}/uk_date={day}")
    new, old, taken = (jvm_path(spark, f"{work}/{x}")[1] for x in ("new", "old", "taken"))
    if fs.exists(new):
        if not fs.exists(old):
            fs.rename(live, old)
        if fs.exists(live):    # a writer has begun the day anew: its files go with the others that came meanwhile
            fs.rename(live, jvm_path(spark, f"{work}/came")[1])
        fs.rename(new, live)
    gone = {r[0] for r in spark.read.text(f"{work}/taken").toLocalIterator()} if fs.exists(taken) else set()
    for place in ("old", "came"):
        root = jvm_path(spark, f"{work}/{place}")[1]
        if not fs.exists(root):
            continue
        prefix, found, names = fs.makeQualified(root).toString(), fs.listFiles(root, True), []
        while found.hasNext():
            names.append(found.next().getPath().toString()[len(prefix) + 1:])
        for n in names:
            if n not in gone and n.split("/")[-1][0] not in "._":
                target = jvm_path(spark, f"{base}/uk_date={day}/{n}")[1]
                fs.mkdirs(target.getParent())
                fs.rename(jvm_path(spark, f"{work}/{place}/{n}")[1], target)
    fs.delete(jvm_path(spark, work)[1], True)


def finish_swaps(spark: SparkSession, table_path: str) -> None:
    """Complete the swaps, and forget the rewrites, that an earlier call left behind."""
    base = table_path.rstrip("/")
    fs, p = jvm_path(spark, f"{base}/{WORK}")
    for s in fs.listStatus(p) if fs.exists(p) else []:
        name = s.getPath().getName()
        work = f"{base}/{WORK}/{name}"
        if path_exists(spark, f"{work}/taken"):       # the rewrite is whole
            _swap(spark, base, name[:10], work)
        else:
            fs.delete(s.getPath(), True)
