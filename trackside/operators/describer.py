"""Train-describer feed: berth steps, cancels and interposes.

Each frame is a JSON array of one-key objects such as ``{"CA_MSG": {...}}``;
the inner object is the value of that single key.  Only C-class berth
messages are kept; a missing description or berth reads as ``''``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackside.functions.times import ms_to_ts, to_london
from trackside.schema import TD_BERTH_TYPES

TD_ELEMENT_DDL = "map<string, map<string,string>>"


def explode_td(frames: DataFrame, value: str = "value") -> DataFrame:
    """One row per element: ``pos``, ``wrapper`` key, inner ``msg`` map."""
    arr = F.from_json(F.col(value).cast("string"), "array<string>")
    el = F.from_json(F.col("element"), TD_ELEMENT_DDL)
    return (frames.select(F.posexplode(arr).alias("pos", "element"))
            .select("pos", el.alias("_m"))
            .select("pos", F.map_keys("_m").getItem(0).alias("wrapper"),
                    F.map_values("_m").getItem(0).alias("msg")))


def td_frame_counts(frames: DataFrame, value: str = "value") -> DataFrame:
    """Frames by whether they are a JSON array, one row: ``frames``, ``bad_frames``, ``elements``.

    A frame that is no array has no events; here it is counted."""
    arr = F.from_json(F.col(value).cast("string"), "array<string>")
    return frames.select(arr.alias("a")).agg(
        F.count(F.lit(1)).alias("frames"), F.count_if(F.col("a").isNull()).alias("bad_frames"),
        F.coalesce(F.sum(F.when(F.col("a").isNotNull(), F.size("a"))), F.lit(0)).cast("bigint").alias("elements"))


def td_berth_events(frames: DataFrame, value: str = "value") -> DataFrame:
    """C-class berth events with London time text and '' defaults."""
    m = F.col("msg")
    ts = ms_to_ts(m.getItem("time"))
    return (explode_td(frames, value)
            .where(m.getItem("msg_type").isin(TD_BERTH_TYPES))
            .select(F.date_format(to_london(ts), "yyyy-MM-dd HH:mm:ss").alias("uk_time"),
                    m.getItem("msg_type").alias("msg_type"),
                    m.getItem("area_id").alias("area_id"),
                    F.coalesce(m.getItem("descr"), F.lit("")).alias("descr"),
                    F.coalesce(m.getItem("from"), F.lit("")).alias("from_berth"),
                    F.coalesce(m.getItem("to"), F.lit("")).alias("to_berth")))
