"""Arrival order of lake objects (K2).

A lake that kept one object for each name kept the one written last.  Here every object is kept and carries
``arrival``, a text that sorts by when it came: the number of its run or micro-batch, then its frame's place
in the input (file, block, line; or partition and offset of a topic; a micro-batch numbers its
elements in that order), then its position in the frame.  No two objects share it, and it does not depend on file times, so copying or rewriting a lake
changes nothing.

Numbers are handed out by the lake: a hidden folder holds one empty file for each writer, named by
the number and the writer's last part.  A micro-batch that runs again finds its number there.  Writers that start
at the same moment may get one number; their names then decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackside.session import jvm_path

#: Column with a frame's place in the input, and the folder of the numbers.
ORDER, CLAIMS = "frame_order", "_arrivals"


def padded(c: Column, digits: int = 20) -> Column:
    """A number (not negative) as text that sorts like it."""
    return F.lpad(c.cast("string"), digits, "0")


def file_order(lines: bool = True) -> Column:
    """The place of a text file's line: file, block in the file and (not in a stream, see ``numbered``) line in the block."""
    meta = F.col("_metadata")
    line = [padded(F.monotonically_increasing_id())] if lines else []
    return F.concat_ws("#", meta["file_path"], padded(meta["file_block_start"], 15), *line)


def numbered(batch: DataFrame) -> DataFrame:
    """A micro-batch's elements with their number added to ``frame_order``: rows of one block come in its order."""
    return batch.withColumn(ORDER, F.concat_ws("#", ORDER, padded(F.monotonically_increasing_id())))


def ordered(frames: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``frames`` with ``frame_order``: as it is there, or by the given columns, by partition and offset of a
    topic, or by the rows' present order (in a stream: ``numbered`` adds it)."""
    if ORDER in frames.columns:
        return frames
    if not by and {"partition", "offset"} <= set(frames.columns):
        by = ["partition", "offset"]
    numbers = [f.name for f in frames.schema.fields if isinstance(f.dataType, T.NumericType)]
    parts = [padded(F.col(c)) if c in numbers else F.col(c).cast("string") for c in by or []]
    return frames.withColumn(ORDER, F.concat_ws("#", *parts) if parts else F.lit("") if frames.isStreaming
                             else padded(F.monotonically_increasing_id()))


def claim(spark: SparkSession, base: str, writer: str, part: str) -> str:
    """The sortable name of a part (run, micro-batch) of a writer: the same one however often it is asked for."""
    fs, folder = jvm_path(spark, f"{base.rstrip('/')}/{CLAIMS}")
    fs.mkdirs(folder)
    held = sorted(s.getPath().getName() for s in fs.listStatus(folder))
    name = f"{writer}-{part}"
    mine = [h for h in held if h.partition(".")[2] == name]
    if not mine:
        number = 1 + max((int(h.partition(".")[0]) for h in held), default=0)
        mine = [f"{number:012d}.{name}"]
        fs.createNewFile(jvm_path(spark, f"{base.rstrip('/')}/{CLAIMS}/{mine[0]}")[1])
        for h in held:  # the writer's earlier parts are done
            if h.partition(".")[2].startswith(f"{writer}-"):
                fs.delete(jvm_path(spark, f"{base.rstrip('/')}/{CLAIMS}/{h}")[1], False)
    return mine[0]


def arrival(run: str) -> Column:
    """The arrival of an element (``frame_order``, ``pos``) in a run."""
    return F.concat_ws("/", F.lit(run), F.col(ORDER), padded(F.col("pos"), 9)).alias("arrival")
