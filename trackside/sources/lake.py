"""Lake sources: day-partition scan, whole-object JSON, NDJSON.

The lake is partitioned ``year=YYYY/month=MM/day=DD`` by the London date of
each movement; below a day, a stream's micro-batches have directories of
their own.  A day is read by opening its directory, so only its files are
listed, whatever the size of the lake; ``year``, ``month`` and ``day`` come from
the path.  A lake that a file sink wrote (it has a ``_spark_metadata`` log) is
read through that log, which knows the committed files.

Two object layouts are read by one parser: the envelope (8 keys with the
body under ``raw_data``) and the bare body of the older topic lane.

A lake of one object a file, on a local or mounted file system, is listed and
opened by the tasks, which pack it into few files that the JSON reader then reads
(``pack_objects``): Spark's readers keep every file of a scan on the driver.
"""

from __future__ import annotations

import datetime as _dt
import itertools
import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from trackside.operators.dedup import dedup_object_key
from trackside.schema import STAGING_COLUMNS
from trackside.session import jvm_path, path_exists, scratch_dir

_ENVELOPE_KEYS = ["message_type", "event_type", "toc_id", "variation_status", "uk_datetime",
                  "timestamp", "processed_at", "object_name", "arrival"]
_BARE_KEYS = [c for c in STAGING_COLUMNS if c not in _ENVELOPE_KEYS]
CORRUPT = "_corrupt_record"
# Names that Spark's readers do not list, and endings of files that they decompress.
_PASSED_OVER = re.compile(r"(?!_metadata|_common_metadata)(\.|_[^=]*$|.*\._COPYING_$)", re.S)
# A packed lake: what ends an object, and the key that tells the day and the time of its file.
_SEPARATOR, _MARK = "\x1e", "_packed from"
_COMPRESSED = r"\.(gz|bz2|deflate|snappy|lz4|zst)$"

# Read schema of lake objects: envelope keys, the raw body, and the body
# fields at top level for the bare layout.  Every scalar is read as text
# (a number where text is expected must not void the whole object), typed
# later per row with try_cast.  The body is read as a struct of the known
# feed fields: the reader fills each slot directly, where a map would cost
# a key scan per field per row in the flatten (about half its time).
BODY_STRUCT = T.StructType([T.StructField(c, T.StringType()) for c in STAGING_COLUMNS])
LAKE_READ_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in _ENVELOPE_KEYS]
    + [T.StructField("raw_data", BODY_STRUCT)]
    + [T.StructField(c, T.StringType()) for c in _BARE_KEYS]
    + [T.StructField(CORRUPT, T.StringType())])


def day_predicate(ds: str) -> Column:
    d = _dt.date.fromisoformat(ds)
    return ((F.col("year").cast("int") == d.year) & (F.col("month").cast("int") == d.month)
            & (F.col("day").cast("int") == d.day))


def day_dir(base: str, ds: str) -> str:
    d = _dt.date.fromisoformat(ds)
    return f"{base.rstrip('/')}/year={d.year}/month={d.month:02}/day={d.day:02}"


def has_sink_log(spark: SparkSession, base: str) -> bool:
    """Was this directory written by a streaming file sink?"""
    return path_exists(spark, f"{base.rstrip('/')}/_spark_metadata")


def _files(spark: SparkSession, base: str, days: list[str] | None) -> list[str]:
    """The directories to open: those of the days that are there, or the whole lake."""
    wanted = [day_dir(base, d) for d in days] if days else [base]
    return [p for p in wanted if path_exists(spark, p)]


def _path_keys(path: str = "_metadata.file_path") -> list[Column]:
    """The day of an object and when its file was written."""
    return [*[F.regexp_extract(path, f"/{k}=([0-9]+)/", 1).alias(k) for k in ("year", "month", "day")],
            F.col("_metadata.file_modification_time").alias("landed")]


def _folders(roots: list[str], levels: int) -> list[tuple[str, bool]]:
    """What the tasks list: the folders of the upper ``levels``, their own files alone, and those below, with all they hold."""
    found = []
    for _ in range(levels):
        below = []
        for root in roots:
            found.append((root, False))
            if os.path.isdir(root):
                with os.scandir(root) as entries:
                    below += [e.path for e in entries if not _PASSED_OVER.match(e.name) and e.is_dir()]
        roots = below
    return found + [(root, True) for root in roots]


def _object_files(spark: SparkSession, folders: list[tuple[str, bool]]) -> DataFrame:
    """The files of some folders and when they were written (ms), listed by the tasks."""
    def files(root: str, deep: bool) -> Iterator[tuple[str, int]]:
        if not os.path.isdir(root):
            yield root, os.stat(root).st_mtime_ns // 1_000_000
            return
        todo = [root]
        while todo:
            with os.scandir(todo.pop()) as entries:
                for e in entries:
                    if _PASSED_OVER.match(e.name):
                        continue
                    try:
                        if not e.is_dir():
                            yield e.path, e.stat().st_mtime_ns // 1_000_000
                        elif deep:
                            todo.append(e.path)
                    except FileNotFoundError:   # gone since the folder was opened
                        pass

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.to_pylist():
                found = files(**folder)
                while some := list(itertools.islice(found, 10_000)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([f for f, _ in some], pa.string()), pa.array([t for _, t in some], pa.int64())],
                        names=["file", "landed"])

    return spark.createDataFrame(folders, "root string, deep boolean").mapInArrow(listed, "file string, landed long")


def _records(files: DataFrame, tasks: int) -> DataFrame:
    """Each object of some ``file``s as a line for the JSON reader, opened by ``tasks`` tasks.

    The text stays as it is; ``mark`` becomes the object's first key.  An empty file has no object, an array has one for
    each element.  What is no object, or holds the separator (no JSON may), comes as a damaged line.
    """
    space, opening = b" \t\r\n", re.compile(rb"[ \t\r\n]*\{[ \t\r\n]*")
    gap = re.compile(r"[ \t\r\n]*")

    def utf8(data: bytes) -> bytes:
        code = json.detect_encoding(data)   # by the first bytes, as the JSON reader does
        if code in ("utf-8", "utf-8-sig"):
            return data.removeprefix(b"\xef\xbb\xbf")
        try:
            return data.decode(code).encode()
        except UnicodeError:
            return b"\0"

    def elements(text: str) -> list[bytes]:
        scan, found, sound, at = json.JSONDecoder().raw_decode, [], True, gap.match(text, text.index("[") + 1).end()
        while text[at] != "]" or found:
            value, end = scan(text, at)
            if not isinstance(value, dict):
                return [b"\0"]
            sound = sound and isinstance(value.get("raw_data"), dict | None)
            found.append(text[at:end].encode())
            at = gap.match(text, end).end()
            if text[at] == "]":
                break
            if text[at] != ",":
                return [b"\0"]
            at = gap.match(text, at + 1).end()
        return found if sound else [b"\0"] * len(found)   # the reader refuses an array as a whole

    def objects(data: bytes) -> list[bytes]:
        text = utf8(data).replace(_SEPARATOR.encode(), b"\0")
        start = text.lstrip(space)
        if not start.startswith(b"["):
            return [text] if start else []
        try:
            return elements(text.decode())
        except (ValueError, IndexError, RecursionError):
            return [b"\0"]

    def line(mark: str, text: bytes) -> bytes:
        head, found = f'{{"{_MARK}":"{mark}"'.encode(), opening.match(text)
        if not found:
            return head + b",\0"
        rest = text[found.end():]
        return head + (b"" if rest.startswith(b"}") else b",") + rest

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, size = [], 0
            for file, mark in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with open(file, "rb", buffering=0) as f:
                    new = [line(mark, text) for text in objects(f.readall())]
                lines += new
                size += sum(map(len, new))
                if size >= 4 << 20:
                    yield pa.RecordBatch.from_pydict({"value": lines}, pa.schema([("value", pa.binary())]))
                    lines, size = [], 0
            yield pa.RecordBatch.from_pydict({"value": lines}, pa.schema([("value", pa.binary())]))

    return files.select("file", "mark").repartition(tasks, "file").mapInArrow(opened, "value binary")


def pack_objects(spark: SparkSession, base: str, days: list[str] | None = None) -> str | None:
    """Copy a lake of one object a file into few files below the checkpoint folder, for ``read_packed``.

    The tasks list and open the files, so the driver never holds a list of them.  None where they cannot do as Spark's
    reader does: a file sink's log, another than a local or mounted file system, compressed files, or nothing there.
    """
    paths = [] if has_sink_log(spark, base) else _files(spark, base, days)
    at = [jvm_path(spark, path) for path in paths]
    if not at or any(fs.getScheme() != "file" for fs, _ in at):
        return None
    files = _object_files(spark, _folders([p.toUri().getPath() for _, p in at], 0 if days else 3))
    if files.agg(F.max(F.col("file").rlike(_COMPRESSED))).first()[0]:
        return None
    files = files.select("file", F.concat_ws("/", *_path_keys("file")[:3], "landed").alias("mark"))
    packed = scratch_dir(spark, "packed")
    (_records(files, int(spark.conf.get("spark.sql.shuffle.partitions"))).select(F.col("value").cast("string"))
     .write.option("lineSep", _SEPARATOR).mode("append").text(packed))
    return packed


def read_packed(spark: SparkSession, packed: str) -> DataFrame:
    """The objects that ``pack_objects`` copied, as ``read_lake_objects`` has them."""
    schema = T.StructType([T.StructField(_MARK, T.StringType()), *LAKE_READ_SCHEMA])
    raw = (spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
           .option("lineSep", _SEPARATOR).json(packed))
    # of a damaged object the parser keeps nothing, its line has the mark
    mark = F.split(F.coalesce(F.col(_MARK), F.regexp_extract(CORRUPT, f'^\\{{"{_MARK}":"([^"]*)"', 1)), "/")
    return normalize_objects(raw.select(
        *LAKE_READ_SCHEMA.fieldNames(), *[mark[i].alias(k) for i, k in enumerate(("year", "month", "day"))],
        F.timestamp_millis(mark[3].cast("long")).alias("landed")))


def last_writer(objects: DataFrame) -> DataFrame:
    """Of the objects of one name (one operator in one London second), however many runs wrote them, the one
    that arrived last (``sinks.arrivals``).  Objects of a lake from before arrivals were kept come
    before all others, by the time their file was written, then by their processing stamp."""
    return dedup_object_key(objects, [c for c in ("arrival", "landed", "processed_at") if c in objects.columns])


def read_json_objects(spark: SparkSession, path: str, multiline: bool = False,
                      base: str | None = None) -> DataFrame:
    """Lake objects through the JSON reader: one parse per object, ``ok`` flag.

    ``multiline`` reads each file as one (pretty-printed) object; otherwise
    one object per line, blank lines skipped.  A damaged object keeps only
    ``ok = false``.  Both layouts come out as envelopes: a bare body becomes
    its own ``raw_data`` (fields it does not carry stay absent).
    """
    r = (spark.read.schema(LAKE_READ_SCHEMA).option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", CORRUPT)
         .option("multiLine", "true" if multiline else "false"))
    if base:
        r = r.option("basePath", base)
    return normalize_objects(r.json(path))


def normalize_objects(df: DataFrame) -> DataFrame:
    bare = F.struct(*[F.col(c) for c in STAGING_COLUMNS])
    parts = [c for c in df.columns if c not in LAKE_READ_SCHEMA.fieldNames()]
    # ``ok`` also reads a body field: the JSON reader refuses (or, after
    # pruning, cannot judge) a query whose only column is the corrupt-record
    # one, so the flag must make the reader parse the object.
    ok = F.col(CORRUPT).isNull() & (
        F.length(F.coalesce(F.col("raw_data")["train_id"], F.lit(""))) >= 0)
    return df.select(
        *parts, ok.alias("ok"),
        *[F.col(c) for c in ["message_type", "event_type", "toc_id", "variation_status",
                             "uk_datetime"]],
        F.col("timestamp").try_cast("double").alias("timestamp"),
        "processed_at", "object_name", "arrival",
        F.when(F.col("raw_data").isNotNull(), F.col("raw_data"))
         .when(F.col(CORRUPT).isNull(), bare).alias("raw_data"))


def read_lake_objects(spark: SparkSession, base: str, days: list[str] | None = None,
                      whole_objects: bool = False, fmt: str = "json") -> DataFrame:
    """Objects of some London days (or all) of the lake, with ``ok`` (false: not a JSON object).

    ``whole_objects`` reads each file as one (pretty-printed) object, else each line.
    ``fmt="parquet"`` reads a columnar lake written by ``write_lake``.  A day or a lake
    that is not there has no objects.
    """
    if has_sink_log(spark, base):
        if fmt == "parquet":
            df = spark.read.option("basePath", base).parquet(base).withColumn("ok", F.lit(True))
        else:
            df = read_json_objects(spark, base, multiline=whole_objects, base=base)
        if days is not None:
            cond = F.lit(False)
            for d in days:
                cond = cond | day_predicate(d)
            df = df.where(cond if "year" in df.columns else F.lit(False))
        return df
    paths = _files(spark, base, days)
    if not paths or (fmt == "parquet" and not _holds_files(spark, paths)):
        return normalize_objects(spark.createDataFrame([], LAKE_READ_SCHEMA))
    r = spark.read.option("recursiveFileLookup", "true")
    if fmt == "parquet":
        return r.parquet(*paths).select("*", *_path_keys(), F.lit(True).alias("ok"))
    packed = pack_objects(spark, base, days) if whole_objects else None
    if packed:
        return read_packed(spark, packed)
    raw = (r.schema(LAKE_READ_SCHEMA).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", CORRUPT)
           .option("multiLine", "true" if whole_objects else "false").json(paths))
    return normalize_objects(raw.select("*", *_path_keys()))


def _holds_files(spark: SparkSession, paths: list[str]) -> bool:
    """Is there anything below? (A Parquet read needs a file to know its schema.)"""
    for path in paths:
        fs, p = jvm_path(spark, path)
        found = fs.listFiles(p, True)
        while found.hasNext():
            if found.next().getPath().getName().endswith(".parquet"):
                return True
    return False


def read_lake(spark: SparkSession, base: str, ds: str | None = None,
              whole_objects: bool = False, fmt: str = "json") -> DataFrame:
    """Envelopes of one London day (or all days) of the lake; invalid objects dropped."""
    return read_lake_objects(spark, base, [ds] if ds else None, whole_objects, fmt).where("ok")


def read_objects(spark: SparkSession, path: str) -> DataFrame:
    """Whole-object read (one pretty-printed JSON object per file) with ``ok`` flag."""
    return read_json_objects(spark, path, multiline=True)


def read_ndjson(spark: SparkSession, path: str) -> DataFrame:
    """NDJSON day file: one object per line; blank lines skipped, bad lines flagged."""
    return read_json_objects(spark, path)

