"""Feed sources: frame text (file or stream), topic records, train-describer frames.

A frame source has one STRING column ``value`` holding a JSON array of
messages; a Kafka record's ``value`` cast to STRING has the same shape, so
every decoder here takes either.  The Kafka connector jar is not part of
this install: ``read_topic`` builds the reader from options and is exercised
in tests through the file source of the same one-column shape.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackside.sinks.arrivals import ORDER, file_order


def read_frames(spark: SparkSession, path: str, streaming: bool = False,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """One row per frame from text files (one frame per line): ``value`` and its place, ``frame_order``."""
    if streaming:
        r = spark.readStream.format("text")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        lines = r.load(path)
    else:
        lines = spark.read.text(path)
    return lines.select("value", file_order(lines=not streaming).alias(ORDER))


def kafka_options(bootstrap: str, topic: str, group_id: str | None = None,
                  starting_offsets: str = "earliest", extra: dict | None = None) -> dict:
    """Reader options for a topic of one message per record, replayed from earliest.

    Offsets that the broker has already dropped fail the query (an operator may
    decide otherwise through ``extra``): nothing is skipped in silence.
    The topic name comes from the deployment (the feed lane publishes every
    movement message to it, one message per record).
    """
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": starting_offsets, "failOnDataLoss": "true"}
    if group_id:
        opts["kafka.group.id"] = group_id
    opts.update(extra or {})
    return opts


def read_topic(spark: SparkSession, options: dict, streaming: bool = True,
               fmt: str = "kafka") -> DataFrame:
    """Topic records as ``value`` STRING (plus key/offset columns when Kafka).

    ``fmt`` may name a file format of the same one-column shape for tests.
    """
    if fmt != "kafka":
        path = options["path"]
        return (spark.readStream.format(fmt).load(path) if streaming
                else spark.read.format(fmt).load(path))
    r = spark.readStream if streaming else spark.read
    df = r.format("kafka").options(**options).load()
    return df.select(F.col("value").cast("string").alias("value"), "topic", "partition",
                     "offset", "timestamp")


def single_message_frames(records: DataFrame, value: str = "value") -> DataFrame:
    """Topic records carry one message each: wrap as one-element frames."""
    return records.select(F.concat(F.lit("["), F.col(value).cast("string"), F.lit("]"))
                          .alias("value"), *[c for c in records.columns if c != value])
