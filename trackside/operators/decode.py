"""Feed frame decoding: frame text -> messages -> movement envelopes.

A frame is the text of one feed delivery, a JSON array of messages.  The
decoder is a narrow plan (no shuffle): ``from_json(value, array<string>)``
splits the array while keeping each element as its own JSON text, so one
damaged element never sinks its neighbours, and each element is then parsed
into ``header``/``body`` maps.  Every element keeps a ``status``:

* ``ok``          - a movement (msg_type 0003) with a usable actual time;
* ``skipped``     - any other message type (silently ignored by the feed lane);
* ``bad_time``    - a movement whose actual time is null, not a number or outside
                    the years 1 to 9999, or absent (unless ``compat``: absent
                    then reads as 0, 1970);
* ``bad_element`` - an element that is not a JSON object (``5``, ``null``...);
* ``bad_frame``   - the frame itself is not a JSON array (one row per frame).

Why the split: parsing a frame straight to ``array<struct<header, body>>``
nulls the whole frame when one element is not an object (checked on Spark
4.1.2 with ``spark.sql.json.enablePartialResults`` on), and a Variant parse
measured slower; ``array<string>`` keeps each element apart.

Limit: splitting with ``array<string>`` returns an object element as its
JSON text and a string element as its content, so a string whose content is
itself a valid message object is taken as that object.  Malformed text, a
non-object header or body, numbers and plain strings are all caught.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackside.functions.times import epoch_seconds, iso_london, valid_ms
from trackside.schema import MOVEMENT_MSG_TYPE

STATUSES = ["ok", "skipped", "bad_time", "bad_element", "bad_frame"]


# Element parse schema: a message is an object whose header and body are
# objects.  The corrupt-record field catches everything else - a number, a
# string, malformed text, a header that is not an object - in the same parse.
_CORRUPT = "_corrupt_record"
_ELEMENT_DDL = f"struct<header: map<string,string>, body: map<string,string>, {_CORRUPT}: string>"
_PARSE_OPTS = {"columnNameOfCorruptRecord": _CORRUPT}


def explode_messages(frames: DataFrame, value: str = "value",
                     keep: list[str] | None = None) -> DataFrame:
    """One row per array element: ``frame_ok, pos, element, is_object, header, body``.

    Columns in ``keep`` (e.g. a frame id or arrival order) are carried along.
    An empty array yields no rows; a frame that is not an array yields one
    row with ``frame_ok = false`` and its whole text as ``element``.

    Each element is parsed inside ``transform`` before the explode, so the
    parsed maps are generator outputs: later filters on the status read them
    instead of re-parsing the element text (a filter pushed through a
    projection would otherwise inline and repeat ``from_json``).
    """
    keep = keep or []
    arr = F.from_json(F.col(value).cast("string"), "array<string>")
    parsed = F.transform(arr, lambda x: F.struct(
        x.alias("element"), F.from_json(x, _ELEMENT_DDL, _PARSE_OPTS).alias("m")))
    items = F.transform(parsed, lambda p: F.struct(
        p["element"].alias("element"),
        (F.coalesce(F.startswith(F.ltrim(p["element"]), F.lit("{")), F.lit(False))
         & p["m"][_CORRUPT].isNull()).alias("is_object"),
        p["m"]["header"].alias("header"), p["m"]["body"].alias("body"),
        F.lit(True).alias("frame_ok")))
    null_map = F.lit(None).cast("map<string,string>")
    bad_frame = F.array(F.struct(
        F.col(value).cast("string").alias("element"), F.lit(False).alias("is_object"),
        null_map.alias("header"), null_map.alias("body"), F.lit(False).alias("frame_ok")))
    it = F.col("_it")
    return (frames.select(*keep, F.posexplode(F.coalesce(items, bad_frame)).alias("_pos", "_it"))
            .select(*keep, it.getField("frame_ok").alias("frame_ok"),
                    F.when(it.getField("frame_ok"), F.col("_pos")).alias("pos"),
                    it.getField("element").alias("element"),
                    it.getField("is_object").alias("is_object"),
                    it.getField("header").alias("header"),
                    it.getField("body").alias("body")))


def classify(msgs: DataFrame, compat: bool = False) -> DataFrame:
    """Add ``msg_type``, ``actual_ms`` (BIGINT) and ``status`` to exploded messages."""
    body = F.col("body")
    msg_type = F.col("header").getItem("msg_type")
    has_key = F.coalesce(F.map_contains_key(body, F.lit("actual_timestamp")), F.lit(False))
    raw = body.getItem("actual_timestamp")
    parsed = valid_ms(raw)
    actual_ms = F.when(has_key, parsed).otherwise(F.lit(0 if compat else None).cast("bigint"))
    status = (F.when(~F.col("frame_ok"), F.lit("bad_frame"))
              .when(~F.col("is_object"), F.lit("bad_element"))
              .when(F.coalesce(msg_type, F.lit("")) != MOVEMENT_MSG_TYPE, F.lit("skipped"))
              .when(actual_ms.isNull(), F.lit("bad_time"))
              .otherwise(F.lit("ok")))
    return msgs.select("*", msg_type.alias("msg_type"), actual_ms.alias("actual_ms"),
                       status.alias("status"))


def only_movements(msgs: DataFrame) -> DataFrame:
    """Keep the movement messages (msg_type 0003) that decoded cleanly."""
    return msgs.where(F.col("status") == "ok")


def processed_stamp(processed_at: str | Column | None = None) -> Column:
    """Processing-time text; injectable so tests and replays are deterministic."""
    if processed_at is None:
        return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return processed_at if isinstance(processed_at, Column) else F.lit(processed_at)


def to_envelope(movements: DataFrame, processed_at: str | Column | None = None,
                keep: list[str] | None = None) -> DataFrame:
    """Movement envelope: the 8 lake fields, plus ``actual_ts`` for partitioning."""
    keep = keep or []
    body = F.col("body")
    ts = F.timestamp_millis(F.col("actual_ms"))
    return movements.select(
        *keep,
        F.col("msg_type").alias("message_type"),
        body.getItem("event_type").alias("event_type"),
        body.getItem("toc_id").alias("toc_id"),
        body.getItem("variation_status").alias("variation_status"),
        iso_london(ts).alias("uk_datetime"),
        epoch_seconds(F.col("actual_ms")).alias("timestamp"),
        processed_stamp(processed_at).alias("processed_at"),
        body.alias("raw_data"),
        ts.alias("actual_ts"))


def decode_frames(frames: DataFrame, value: str = "value", compat: bool = False,
                  keep: list[str] | None = None) -> DataFrame:
    """explode + classify in one call (all elements, every status)."""
    return classify(explode_messages(frames, value, keep), compat=compat)


def frames_to_envelopes(frames: DataFrame, processed_at=None, compat: bool = False,
                        value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Feed frames -> movement envelopes (status ok only).

    ``keep`` names frame-level columns to carry (e.g. ``frame_id``); the
    element position ``pos`` is always carried, so (frame, pos) gives the
    arrival order of each movement.
    """
    keep = keep or []
    return to_envelope(only_movements(decode_frames(frames, value, compat, keep)),
                       processed_at, keep + ["pos"])
