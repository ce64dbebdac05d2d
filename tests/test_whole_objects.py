"""Lakes of one object a file: how they are written, and what a load makes of many of them."""

import gzip
import json
import os

from pyspark.sql import functions as F

from trackside.plans.load_day import load_days
from trackside.session import checkpoint_root
from trackside.sinks.lake import write_objects
from trackside.sources.lake import _folders, read_json_objects, read_lake_objects

COLUMNS = "year string, month string, day string, k int, text string"


def _local(path: str) -> str:
    return path.replace("file:", "")


def _files(path: str) -> list[str]:
    return sorted(os.path.relpath(os.path.join(d, f), _local(path)) for d, _, fs in os.walk(_local(path)) for f in fs)


def _objects(n: int) -> list[tuple]:
    rows = []
    for k in range(n):
        body = {"event_type": "ARRIVAL", "toc_id": "20", "variation_status": "LATE", "train_id": f"Té{k}",
                "actual_timestamp": str(1_704_100_000_000 + 86_400_000 * (k % 2))}
        text = json.dumps(body, indent=1, ensure_ascii=False)
        rows.append(("2024", "01", f"0{1 + k % 2}", k, "{\n damaged" if k == 7 else text))
    return rows


def test_one_file_an_object_and_a_second_run_replaces_it(spark, scratch):
    lake, rows = scratch("wlake"), _objects(12)
    df = spark.createDataFrame([*rows, ("2024", "01", None, 99, None)], COLUMNS).repartition(3)
    for _ in range(2):   # as a task that runs twice
        write_objects(df, lake, F.col("text"), F.concat(F.lit("o"), "k"))
    got = {f: open(f"{_local(lake)}/{f}", encoding="utf-8", newline="").read() for f in _files(lake)}
    want = {f"year=2024/month=01/day={r[2]}/o{r[3]}.json": r[4] + "\n" for r in rows}
    assert got == want | {"year=2024/month=01/day=__HIVE_DEFAULT_PARTITION__/o99.json": "\n"}
    assert read_lake_objects(spark, lake, ["2024-01-01", "2024-01-02"], whole_objects=True).where("ok").count() == 11


def test_a_load_of_many_objects_writes_few_files(spark, scratch):
    lake, table = scratch("wlake"), scratch("wtable")
    write_objects(spark.createDataFrame(_objects(40), COLUMNS), lake, F.col("text"), F.concat(F.lit("o"), "k"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")   # an object a task
    try:
        r = load_days(spark, lake, table, whole_objects=True)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert (r.status, r.invalid_objects, r.total_rows, r.written, r.day_rows) == ("loaded", 1, 39, 39, 39)
    files = [f for f in _files(table) if f.endswith(".parquet")]
    assert {f.split("/")[0] for f in files} == {"uk_date=2024-01-01", "uk_date=2024-01-02"} and len(files) <= 4


def test_the_driver_holds_no_list_of_the_objects(spark, scratch):
    """Spark's reader keeps every file of a scan on the driver; the tasks pack them into a few, which a load removes."""
    lake, table = scratch("wlake"), scratch("wtable")
    write_objects(spark.createDataFrame(_objects(200), COLUMNS), lake, F.col("text"), F.concat(F.lit("o"), "k"))
    df = read_lake_objects(spark, lake, whole_objects=True)
    assert len(df.inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions")) < 200
    assert sorted(tuple(r) for r in df.groupBy("year", "month", "day", "ok").count().collect()) == [
        ("2024", "01", "01", True, 100), ("2024", "01", "02", False, 1), ("2024", "01", "02", True, 99)]
    month = f"{_local(lake)}/year=2024/month=01"
    assert sorted(_folders([_local(lake)], 3)) == [
        (_local(lake), False), (os.path.dirname(month), False), (month, False), *[(f"{month}/day=0{d}", True) for d in (1, 2)]]
    there = set(os.listdir(f"{_local(checkpoint_root(spark))}/trackside"))
    r = load_days(spark, lake, table, ["2024-01-02", "2031-01-01"], whole_objects=True)
    assert (r.status, r.invalid_objects, r.total_rows, r.written, r.day_rows) == ("partly loaded", 1, 99, 99, 99)
    assert set(os.listdir(f"{_local(checkpoint_root(spark))}/trackside")) == there


def test_packed_objects_are_parsed_as_the_files_themselves(spark, scratch):
    text = '{\n "event_type": "ARRIVAL",\n "train_id": "Té"\n}'
    body = text.replace("ARRIVAL", "DEPARTURE").replace("\n}", ',\n "toc_id": 7.50\n}')
    cut = body[:20]
    texts = [body, cut, "", " \n", "{}", "{ }", "5", "null", body + "x", f"{body}\n{body}", f"[{body},\n{body}]", f"[{cut}", "[]", "[ ]",
             f"[{body},5]", f"[{body}]x", f"[{body}", '"a":1}', '{"raw_data":"x"}', f'[{body},{{"raw_data":1}}]', "{'toc_id':'1'}",
             '{"toc_id":[1, 2],"timestamp":NaN}', '{"toc_id":"a\x1eb"}', '{"toc_id":"\\ud800"}', "{\x1e}", "\x1e"]
    data = [t.encode() for t in texts] + [text.encode(c) for c in ("latin-1", "utf-16", "utf-16-le", "utf-32", "utf-8-sig")]
    data += [body.encode() + b"\xff", b'{"toc_id":"\xed\xa0\x80"}']
    lake = scratch("wlake")
    for k, d in enumerate(data):
        folder = f"{_local(lake)}/year=2024/month=01/day={10 + k}"
        os.makedirs(folder)
        for name in ("o.json", "_o.json", ".o.json"):
            with open(f"{folder}/{name}", "wb") as f:
                f.write(d)
    cols = [F.col("day").cast("int"), "ok",
            F.when(F.col("ok"), F.struct("toc_id", "event_type", "timestamp", "raw_data")).cast("string")]
    want = read_json_objects(spark, lake, multiline=True, base=lake).select(*cols).collect()
    got = read_lake_objects(spark, lake, whole_objects=True)
    assert got.where("year = '2024' and month = '01' and landed > '2024-01-01'").count() == len(want) == 31
    want, got = ({d: sorted(str(r) for r in rows if r.day == 10 + k) for k, d in enumerate(data)}
                 for rows in (want, got.select(*cols).collect()))
    assert got == want


def test_compressed_objects_are_left_to_the_reader(spark, scratch):
    lake = scratch("wlake")
    os.makedirs(f"{_local(lake)}/year=2024/month=01/day=02")
    with gzip.open(f"{_local(lake)}/year=2024/month=01/day=02/o.json.gz", "wt") as f:
        f.write(_objects(1)[0][-1])
    df = read_lake_objects(spark, lake, whole_objects=True)
    assert [tuple(r) for r in df.select("day", "ok", "toc_id").collect()] == [("02", True, "20")]
