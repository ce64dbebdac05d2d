"""Command-line jobs, for ``spark-submit`` or ``python -m trackside.jobs``.

    ingest         feed frame files or a topic -> London-date lake, table or live gauge (streaming)
    publish        every message of the frames -> topic (or text files), unfiltered (streaming)
    load-day       replace London day(s) of the movements table from the lake, or load all of it
    compact        pack the small files of a table's days
    migrate        rewrite a table whose bodies are text, day by day
    gauge          the live gauge of one day
    refresh-summary  rebuild the kept movement summary for some days
    dashboard      write the 17 count-only charts from the kept summary
    query          run one analytics query or ad-hoc SQL over the table, whole result to --out

The scheduler passes the run date (``--ds``); every job reads the cluster's
own session settings and ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from trackside.session import use_utc


def _spark() -> SparkSession:
    return use_utc(SparkSession.builder.appName("trackside").getOrCreate())


def _frames(spark, a):
    """Feed frames of files or of a topic, as streams, bounded to so many files or offsets a trigger."""
    from trackside.sources.feed import kafka_options, read_frames, read_topic, single_message_frames
    if a.bootstrap:
        extra = {"maxOffsetsPerTrigger": str(a.max_offsets)} if a.max_offsets else None
        return single_message_frames(read_topic(spark, kafka_options(a.bootstrap, a.topic, a.group_id, extra=extra)))
    return read_frames(spark, a.frames, streaming=True, max_files_per_trigger=a.max_files)


def _run(spark, a, start) -> dict:
    """Run a stream to its end (``--once``) or for ever, its progress kept as a table with ``--progress``."""
    from trackside.streaming.progress import ProgressTable, settled
    if a.progress:
        listener = ProgressTable(spark, a.progress)
        spark.streams.addListener(listener)
    try:
        q = start({"availableNow": True} if a.once else {"processingTime": a.every})
        q.awaitTermination()
    finally:
        if a.progress:
            settled(spark)
            spark.streams.removeListener(listener)
    return {"query": q.name or str(q.id), "progress": q.lastProgress}


def cmd_ingest(a) -> dict:
    from trackside.streaming import exact, gauge, ingest
    spark = _spark()
    frames = _frames(spark, a)
    if a.gauge:
        return _run(spark, a, lambda t: gauge.stream_gauge(frames, a.gauge, a.checkpoint, trigger=t, compat=a.compat))
    if a.table and a.exact:
        return _run(spark, a, lambda t: exact.stream_to_table_exact(frames, a.table, a.checkpoint, trigger=t, compat=a.compat))
    if a.table and not a.lake:
        return _run(spark, a, lambda t: ingest.stream_to_table_append(frames, a.table, a.checkpoint, trigger=t, compat=a.compat))
    if a.table:
        return _run(spark, a, lambda t: ingest.stream_to_table(frames, a.lake, a.table, a.checkpoint, trigger=t, compat=a.compat,
                                                               last_writer_wins=a.last_writer_wins))
    return _run(spark, a, lambda t: ingest.stream_ingest(frames, a.lake, a.checkpoint, trigger=t, lake_format=a.lake_format, compat=a.compat,
                                                         counters=a.counters, lanes=a.lanes))


def cmd_publish(a) -> dict:
    from trackside.streaming.ingest import stream_publish
    spark = _spark()
    sink, fmt = ({"kafka.bootstrap.servers": a.to_bootstrap, "topic": a.to_topic}, "kafka") if a.to_bootstrap else ({"path": a.to}, "text")
    return _run(spark, a, lambda t: stream_publish(_frames(spark, a), a.checkpoint, sink, fmt, trigger=t))


def cmd_load_day(a) -> dict:
    from trackside.plans.load_day import load_days
    r = load_days(_spark(), a.lake, a.table, a.ds, lake_format=a.lake_format, whole_objects=a.whole_objects, summary_path=a.summary,
                  rollup_path=a.rollups, catalog_table=a.catalog_table, dedup_keys=a.dedup or None,
                  last_writer_wins=a.last_writer_wins, allow_drop=a.allow_drop, verify="days")
    return r.to_row()


def cmd_compact(a) -> dict:
    from trackside.plans.compact import compact
    return {"days": compact(_spark(), a.table, a.ds, a.target_mb << 20)}


def cmd_migrate(a) -> dict:
    from trackside.plans.migrate import migrate_table
    return {"days": [vars(d) for d in migrate_table(_spark(), a.old_table, a.table, a.ds)]}


def cmd_gauge(a) -> dict:
    from trackside.streaming.gauge import live_gauge
    (row,) = live_gauge(_spark(), a.gauge, a.as_of_date).toLocalIterator()     # one row
    return {"date": a.as_of_date, **row.asDict()}


def cmd_refresh_summary(a) -> dict:
    from trackside.operators.summary import refresh_summary
    refresh_summary(_spark(), a.table, a.summary, a.ds)
    return {"summary": a.summary, "days": a.ds or "*"}


def cmd_dashboard(a) -> dict:
    from trackside.operators.summary import charts, write_charts
    spark = _spark()
    return write_charts(charts(spark.read.parquet(a.summary), a.as_of_date), a.out)


#: The questions that ``query --name`` answers, and over what: the movements, the company mart or the schema.
QUERIES = {
    **{n: "movements" for n in (
        "basic_stats", "movements_by_toc", "top_toc", "punctuality_share", "hourly_patterns", "recent_movements", "event_type_distribution",
        "punctuality_distribution", "toc_ranking", "toc_status_heatmap", "daily_trends", "weekly_calendar", "top_stations", "route_performance",
        "delay_distribution", "toc_hour_matrix", "realtime_gauge", "leaderboard", "kpi_scorecard", "network_health", "journey_flow", "row_count",
        "sample_rows")},
    "company_tree": "mart", "company_ranking": "mart", "column_check": "schema"}


def query_arguments(fn, given: list[str]) -> dict:
    """``name=value`` texts as arguments of ``fn``: numbers and true/false where its default is one."""
    import inspect
    known, out = inspect.signature(fn).parameters, {}
    for text in given:
        name, eq, value = text.partition("=")
        if not eq or name not in known or name in ("m", "mart", "spark"):
            raise SystemExit(f"{fn.__name__} has no argument {text!r}; it has {sorted(set(known) - {'m', 'mart', 'spark'})}")
        default = known[name].default
        if isinstance(default, bool):
            out[name] = value.lower() in ("true", "1", "yes")
        elif isinstance(default, int):
            out[name] = int(value)
        else:
            out[name] = float(value) if name == "approx" else value
    lacking = [n for n, p in known.items() if p.default is p.empty and n not in out and n not in ("m", "mart", "spark")]
    if lacking:
        raise SystemExit(f"{fn.__name__} needs --arg {' --arg '.join(n + '=...' for n in lacking)}")
    return out


def cmd_query(a) -> dict:
    from trackside.operators import analytics as A
    from trackside.operators import views as V
    if not a.sql:
        args = query_arguments(getattr(A, a.name), a.arg)
    spark = _spark()
    m = spark.read.parquet(a.table)
    if a.sql:
        V.register_views(spark, m)
        df = A.run_sql(spark, a.sql, dict(x.split("=", 1) for x in a.arg) or None)
    else:
        over = {"movements": lambda: (m,), "mart": lambda: (V.operating_company_performance(V.stg_movements(m)),),
                "schema": lambda: (spark, m)}[QUERIES[a.name]]()
        df = getattr(A, a.name)(*over, **args)
    # the whole result goes to files; nothing passes through the driver
    df.write.mode("overwrite").format(a.format).save(a.out)
    return {"out": a.out, "format": a.format}


def _feed_options(s) -> None:
    s.add_argument("--frames"), s.add_argument("--bootstrap"), s.add_argument("--topic"), s.add_argument("--group-id")
    s.add_argument("--max-files", type=int), s.add_argument("--max-offsets", type=int)
    s.add_argument("--checkpoint", required=True), s.add_argument("--every", default="1 minute")
    s.add_argument("--once", action="store_true"), s.add_argument("--progress")


def main(argv: list[str] | None = None):
    p = argparse.ArgumentParser(prog="trackside")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("ingest")
    _feed_options(s)
    s.add_argument("--lake"), s.add_argument("--table"), s.add_argument("--gauge"), s.add_argument("--exact", action="store_true")
    s.add_argument("--lake-format", default="json"), s.add_argument("--counters"), s.add_argument("--lanes", action="store_true")
    s.add_argument("--compat", action="store_true"), s.add_argument("--last-writer-wins", action="store_true")
    s = sub.add_parser("publish")
    _feed_options(s)
    s.add_argument("--to"), s.add_argument("--to-bootstrap"), s.add_argument("--to-topic")
    s = sub.add_parser("load-day")
    s.add_argument("--lake", required=True), s.add_argument("--table", required=True)
    s.add_argument("--ds", action="append", help="a day; without one the whole lake is loaded")
    s.add_argument("--lake-format", default="json"), s.add_argument("--summary"), s.add_argument("--rollups"), s.add_argument("--catalog-table")
    s.add_argument("--whole-objects", action="store_true"), s.add_argument("--dedup", action="append", help="a key column of exact duplicates")
    s.add_argument("--last-writer-wins", action="store_true"), s.add_argument("--allow-drop", action="store_true")
    s = sub.add_parser("compact")
    s.add_argument("--table", required=True), s.add_argument("--ds", action="append"), s.add_argument("--target-mb", type=int, default=128)
    s = sub.add_parser("migrate")
    s.add_argument("--old-table", required=True), s.add_argument("--table", required=True), s.add_argument("--ds", action="append")
    s = sub.add_parser("gauge")
    s.add_argument("--gauge", required=True), s.add_argument("--as-of-date", required=True)
    s = sub.add_parser("refresh-summary")
    s.add_argument("--table", required=True), s.add_argument("--summary", required=True)
    s.add_argument("--ds", action="append")
    s = sub.add_parser("dashboard")
    s.add_argument("--summary", required=True), s.add_argument("--out", required=True)
    s.add_argument("--as-of-date", required=True)
    s = sub.add_parser("query")
    s.add_argument("--table", required=True), s.add_argument("--name", default="toc_ranking", choices=sorted(QUERIES))
    s.add_argument("--sql"), s.add_argument("--arg", action="append", default=[], help="name=value"), s.add_argument("--out", required=True)
    s.add_argument("--format", default="json")
    a = p.parse_args(argv)
    out = {"ingest": cmd_ingest, "publish": cmd_publish, "load-day": cmd_load_day, "compact": cmd_compact, "migrate": cmd_migrate,
           "gauge": cmd_gauge, "refresh-summary": cmd_refresh_summary, "dashboard": cmd_dashboard, "query": cmd_query}[a.cmd](a)
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
