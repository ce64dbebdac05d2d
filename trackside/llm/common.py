"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackside.session import checkpoint_root

#: ASCII capitals and what they become; all other letters keep their case.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytes of word characters (digits, a-z, all non-ASCII) stay, A-Z become small,
#: every other byte becomes a space.  On UTF-8 this is the character rule, since
#: every byte of a non-ASCII character is above 0x7F.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A
    else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
    else 0x20
    for b in range(256))

#: Text handled at once inside a task, whatever the size of Spark's batch.
SLICE_BYTES = 16 << 20


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def others(df: DataFrame, names) -> list[str]:
    """Columns of ``df`` that no name in ``names`` replaces (case is ignored, as in Spark)."""
    low = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in low]


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder (``spark.checkpoint.dir``;
    a folder is chosen only where that is unset, as in tests)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def slices(batch: pa.RecordBatch, at: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose text column holds about ``limit`` bytes (one row at least)."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes.astype(np.int64)) // limit
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    for a, b in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(int(a), int(b - a))


def add_columns(df: DataFrame, text: str, fields: list[T.StructField],
                make: Callable[[list], list[pa.Array]], limit: int = SLICE_BYTES) -> DataFrame:
    """``df`` with columns that ``make`` derives from column ``text``.

    ``make`` gets the texts of some rows (about ``limit`` bytes) as UTF-8 bytes (None for null) and
    returns an Arrow array for each of ``fields``; every row is whole in one
    call.  The other columns pass through unseen; an input column that bears
    the name of a new one is replaced.
    """
    keep = others(df, [f.name for f in fields])
    names = [*keep, *[f.name for f in fields]]
    # the text travels once more under its own position, so that it may itself be replaced
    extra = text not in keep
    src = df.select(*map(quoted, keep), *([F.col(quoted(text))] if extra else []))
    at = len(keep) if extra else keep.index(text)
    schema = T.StructType([*(src.schema[c] for c in keep), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at, limit):
                texts = part.column(at).cast(pa.binary()).to_pylist()
                made = make(texts)
                yield pa.RecordBatch.from_arrays([*part.columns[:len(keep)], *made], names=names)

    return src.mapInArrow(run, schema)


def byte_words(text: bytes | None) -> list[bytes]:
    """Words of letters, digits and non-ASCII characters, A-Z made small (null: none)."""
    return text.translate(WORD_BYTES).split() if text else []
