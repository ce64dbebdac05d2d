"""Stand-in movements derived from the driver's ``events`` table.

The movement feed itself is not available offline, so every query in this
repo runs on movements that Spark derives row by row from ``events`` with
the fixed rules below (FIXTURES.md section 6).  The derivation is a narrow
projection: no shuffle, no Python, column-pruned by Catalyst, so its cost
grows linearly with ``events`` and it parallelises with the scan.

Two shapes are produced from the same expressions:

* ``standin_messages`` - one feed message per event (header + body fields),
  used to build feed frames, topic records and lake objects;
* ``standin_movements`` - the typed movements table those messages load into
  (the fast path the analytics read).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackside.functions.times import epoch_seconds, iso_london, london_date
from trackside.schema import (MOVEMENT_MSG_TYPE, MOVEMENTS_SCHEMA, STAGING_COLUMNS, TABLE_COLUMNS,
                              documented)

# ---------------------------------------------------------------------------
# FIXED VALUES (stand-in rules, FIXTURES.md section 6)
# ---------------------------------------------------------------------------
# Operator code by user_id mod 10 (position 9 has no operator).
STANDIN_TOC_BY_USER = ["20", "23", "28", "29", "61", "71", "80", "88", "99", None]
# event_id mod 1000 equal to this value is operator 98.
STANDIN_TOC98_RESIDUE = 7
# Event type of events that become non-movement messages.
STANDIN_OTHER_TYPE_EVENT = "signup"
STANDIN_OTHER_MSG_TYPE = "0001"
# Fixed processing stamp of the stand-in table (injectable).
STANDIN_PROCESSED_AT = "2024-01-31T00:00:00"

# Body fields that carry a value in the stand-in; all others are absent.
STANDIN_BODY_FIELDS = ["event_type", "variation_status", "actual_timestamp",
                       "planned_timestamp", "toc_id", "loc_stanox", "train_id",
                       "route"]


def _ms(shift_days: int = 0) -> Column:
    # epoch microseconds of ts, integer-divided to milliseconds (+ optional shift)
    ms = F.expr("unix_micros(CAST(ts AS TIMESTAMP)) div 1000")
    return ms + F.lit(shift_days * 86_400_000) if shift_days else ms


def standin_fields(events: DataFrame, shift_days: int = 0) -> DataFrame:
    """events -> (event_id, _ms, msg_type, body fields) by the stand-in rules.

    ``shift_days`` moves every time forward (the summer-time variant).
    """
    k = F.get_json_object("props", "$.k").cast("int")
    uid, eid = F.col("user_id"), F.col("event_id")
    ms = _ms(shift_days)
    base = events.select(eid, uid, F.col("event_type").alias("_src"),
                         k.alias("_k"), ms.alias("_ms"))
    k = F.col("_k")
    status = (F.when(k % 10 < 5, "ON TIME").when(k % 10 < 8, "LATE")
              .when(k % 10 == 8, "EARLY").otherwise("OFF ROUTE"))
    delay_s = (F.when(k % 10 < 5, F.lit(0))
               .when(k % 10 < 8, 30 * (1 + k))
               .when(k % 10 == 8, -30 * (1 + k % 7))).cast("bigint")
    toc_arr = F.array(*[F.lit(t).cast("string") for t in STANDIN_TOC_BY_USER])
    toc = (F.when(eid % 1000 == STANDIN_TOC98_RESIDUE, F.lit("98"))
           .otherwise(F.element_at(toc_arr, (uid % 10 + 1).cast("int"))))
    null_s = F.lit(None).cast("string")
    return base.select(
        "event_id", "_ms",
        F.when(F.col("_src") == STANDIN_OTHER_TYPE_EVENT, F.lit(STANDIN_OTHER_MSG_TYPE))
         .otherwise(F.lit(MOVEMENT_MSG_TYPE)).alias("msg_type"),
        F.when(eid % 2 == 0, F.lit("ARRIVAL")).otherwise(F.lit("DEPARTURE")).alias("event_type"),
        status.alias("variation_status"),
        F.col("_ms").cast("string").alias("actual_timestamp"),
        (F.col("_ms") - 1000 * delay_s).cast("string").alias("planned_timestamp"),
        toc.alias("toc_id"),
        F.when(k == 99, null_s)
         .otherwise(F.lpad(((37 * uid + k) % 2000).cast("string"), 5, "0")).alias("loc_stanox"),
        F.concat(F.lit("T"), F.lpad(((31 * uid + eid % 30) % 1000).cast("string"), 9, "0"))
         .alias("train_id"),
        F.when(k % 25 == 24, null_s).otherwise((k % 4).cast("string")).alias("route"))


def standin_messages(events: DataFrame, shift_days: int = 0) -> DataFrame:
    """One feed message per event: ``event_id``, ``message`` (JSON object text).

    Absent body fields are left out of the JSON (``to_json`` drops NULL
    struct fields), exactly like a feed message that does not carry them.
    """
    f = standin_fields(events, shift_days)
    header = F.struct(F.col("msg_type"),
                      F.col("_ms").cast("string").alias("msg_queue_timestamp"))
    body = F.struct(*[F.col(c) for c in STANDIN_BODY_FIELDS])
    return f.select("event_id",
                    F.to_json(F.struct(header.alias("header"), body.alias("body")))
                    .alias("message"))


def standin_movements(events: DataFrame, processed_at: str = STANDIN_PROCESSED_AT,
                      shift_days: int = 0) -> DataFrame:
    """The movements table the stand-in feed loads into (32 columns + uk_date).

    Equivalent to frames -> decode -> lake -> load_day, minus the codec; the
    codec path is checked against it in the tests.
    """
    f = standin_fields(events, shift_days).where(F.col("msg_type") == MOVEMENT_MSG_TYPE)
    ts = F.timestamp_millis(F.col("_ms"))
    cols = {
        "event_type": F.col("event_type"),
        "toc_id": F.col("toc_id"),
        "variation_status": F.col("variation_status"),
        "uk_datetime": iso_london(ts),
        "timestamp": epoch_seconds(F.col("_ms")),
        "processed_at": F.lit(processed_at),
        "actual_timestamp": ts,
        "loc_stanox": F.col("loc_stanox"),
        "planned_timestamp": F.col("planned_timestamp"),
        "train_id": F.col("train_id"),
        "route": F.col("route"),
        "uk_date": london_date(ts),
    }
    out = f.select(*[cols.get(c, F.lit(None)).cast(MOVEMENTS_SCHEMA[c].dataType).alias(c)
                     for c in TABLE_COLUMNS])
    # key-completeness: train_id and actual_timestamp are always present here
    return documented(out.where(F.col("toc_id").isNotNull()))


# Frame fixtures -------------------------------------------------------------
# A feed frame holds FRAME_SIZE consecutive messages and one planted non-object
# element; one extra frame is not JSON at all.
FRAME_SIZE = 50
PLANTED_ELEMENT = "5"
PLANTED_BAD_FRAME = "not json"


def _frames_of(items: DataFrame, size: int, planted: str | None) -> DataFrame:
    """Group (event_id, message) rows into JSON-array frames of ``size`` ids.

    The grouping is a hash shuffle on ``event_id div size``: each group is
    bounded by ``size`` rows, so no task ever collects more than one frame.
    """
    tail = f",{planted}]" if planted else "]"
    return (items.groupBy(F.expr(f"event_id div {size}").alias("frame_id"))
            .agg(F.sort_array(F.collect_list(F.struct("event_id", "message"))).alias("_items"))
            .select("frame_id",
                    F.concat(F.lit("["),
                             F.array_join(F.transform("_items", lambda x: x["message"]), ","),
                             F.lit(tail)).alias("value")))


def standin_frames(events: DataFrame, size: int = FRAME_SIZE, plant: bool = True,
                   shift_days: int = 0) -> DataFrame:
    """Feed frames (``frame_id``, ``value``) built from the stand-in messages."""
    frames = _frames_of(standin_messages(events, shift_days), size,
                        PLANTED_ELEMENT if plant else None)
    if plant:
        bad = events.sparkSession.range(1).select(F.lit(-1).cast("bigint").alias("frame_id"),
                                                  F.lit(PLANTED_BAD_FRAME).alias("value"))
        frames = frames.unionByName(bad)
    return frames


# Train-describer message types assigned by event_id mod 4.
STANDIN_TD_TYPES = ["CA", "CB", "CC", "SF"]


def standin_td_frames(events: DataFrame, size: int = FRAME_SIZE) -> DataFrame:
    """Train-describer frames: one ``{"<type>_MSG": {...}}`` element per event."""
    k = F.get_json_object("props", "$.k").cast("int")
    uid, eid = F.col("user_id"), F.col("event_id")
    t = F.element_at(F.array(*[F.lit(x) for x in STANDIN_TD_TYPES]), (eid % 4 + 1).cast("int"))
    null_s = F.lit(None).cast("string")
    inner = F.struct(
        t.alias("msg_type"), _ms().cast("string").alias("time"),
        F.concat(F.lit("A"), F.lpad((uid % 100).cast("string"), 2, "0")).alias("area_id"),
        F.when(k % 5 == 0, null_s).otherwise(F.lpad(k.cast("string"), 4, "0")).alias("descr"),
        F.when(t.isin("CA", "CB"), F.lpad(((7 * uid + k) % 10000).cast("string"), 4, "0"))
         .otherwise(null_s).alias("from"),
        F.when(t.isin("CA", "CC"), F.lpad(((11 * uid + k) % 10000).cast("string"), 4, "0"))
         .otherwise(null_s).alias("to"))
    msg = F.to_json(F.create_map(F.concat(t, F.lit("_MSG")), inner))
    return _frames_of(events.select("event_id", msg.alias("message")), size, None)


# Planted data-quality failures (a movement is hit when its epoch ms is a
# multiple of the modulus), used to exercise the declared column tests.
PLANT_MODULI = {"pass_event": 97, "cancelled": 89, "null_status": 83, "null_train": 79,
                "null_time": 73, "null_event": 71}


def plant_quality_failures(m: DataFrame) -> DataFrame:
    """Movements with planted bad values: event type PASS, status CANCELLED and NULLs."""
    p = PLANT_MODULI
    t = F.unix_millis("actual_timestamp")
    null_s = F.lit(None).cast("string")
    repl = {
        "event_type": F.when(t % p["null_event"] == 0, null_s)
                       .when(t % p["pass_event"] == 0, F.lit("PASS"))
                       .otherwise(F.col("event_type")),
        "variation_status": F.when(t % p["null_status"] == 0, null_s)
                             .when(t % p["cancelled"] == 0, F.lit("CANCELLED"))
                             .otherwise(F.col("variation_status")),
        "train_id": F.when(t % p["null_train"] == 0, null_s).otherwise(F.col("train_id")),
        "actual_timestamp": F.when(t % p["null_time"] == 0, F.lit(None).cast("timestamp"))
                             .otherwise(F.col("actual_timestamp")),
    }
    return m.select(*[repl[c].alias(c) if c in repl else F.col(c) for c in m.columns])


# Planted times, by event_id mod 11: a movement's actual time is this text, or null, or absent.
PLANTED_TIMES = {3: "9223372036854775807", 4: "-9223372036854775808", 5: None, 6: "soon",
                 7: "253402300800000"}
PLANTED_TIME_ABSENT = 8


def standin_bad_time_frames(events: DataFrame, size: int = FRAME_SIZE) -> DataFrame:
    """Frames whose movements partly carry unusable actual times."""
    f = standin_fields(events)
    r = F.col("event_id") % 11
    time = F.col("actual_timestamp")
    for residue, text in PLANTED_TIMES.items():
        time = F.when(r == residue, F.lit(text)).otherwise(time)
    header = F.struct("msg_type")
    with_time = F.struct(time.alias("actual_timestamp"), "train_id", "toc_id")
    without = F.struct("train_id", "toc_id")
    message = F.when(r == PLANTED_TIME_ABSENT, F.to_json(F.struct(header.alias("header"), without.alias("body")))) \
        .otherwise(F.to_json(F.struct(header.alias("header"), with_time.alias("body")), {"ignoreNullFields": "false"}))
    return _frames_of(f.select("event_id", message.alias("message")), size, None)


# The variant with every body field: text fields hold their own name and the event's id; these
# are JSON booleans and numbers; platform is a JSON null for every fifth event; and every
# FULL_BODY_TEXT-th event's body is a text.
FULL_BOOLEANS = ["train_terminated", "offroute_ind", "correction_ind", "auto_expected"]
FULL_NUMBERS = ["division_code", "next_report_run_time", "line_ind"]
FULL_BODY_TEXT = 50
FULL_KEPT = ["event_type", "variation_status", "actual_timestamp", "planned_timestamp", "toc_id", "train_id"]


def standin_full_frames(events: DataFrame, size: int = FRAME_SIZE) -> DataFrame:
    """Frames of movements whose bodies carry all 29 fields, with values of several JSON types."""
    f = standin_fields(events)
    eid = F.col("event_id")
    fields = []
    for k, c in enumerate(STAGING_COLUMNS):
        if c in FULL_KEPT:
            value = F.col(c)
        elif c in FULL_BOOLEANS:
            value = (eid + k) % 2 == 0
        elif c in FULL_NUMBERS:
            value = eid * 100 + k
        else:
            value = F.concat(F.lit(f"{c}-"), eid.cast("string"))
            value = F.when(eid % 5 != 0, value) if c == "platform" else value
        fields.append(value.alias(c))
    header = F.struct("msg_type").alias("header")
    message = F.when(eid % FULL_BODY_TEXT == 0, F.to_json(F.struct(header, F.lit("no object").alias("body")))) \
        .otherwise(F.to_json(F.struct(header, F.struct(*fields).alias("body")), {"ignoreNullFields": "false"}))
    return _frames_of(f.select("event_id", message.alias("message")), size, None)
