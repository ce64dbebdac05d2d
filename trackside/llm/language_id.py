"""Language identification with hyperdimensional profiles.

Vectors.  Every letter has a fixed random vector of ``dims`` signs, drawn from its code point alone.
A vector is permuted by shifting it; three letters in a row are bound to one vector, the product
of the first shifted twice, the second shifted once and the third.  Signs are kept as bits, so
that binding is an exclusive or.  A text's vector bundles (adds) those of all its
triples; words are parted by one space, which is a letter of its own, and stand
between spaces.  A language's prototype bundles all its training texts.

Prediction.  A text gets the language whose prototype has the largest cosine with its
vector (ties: the smallest name); the score is that cosine, or 0 where it is negative.
Only the text is read.

Letters are what Unicode calls letters and marks, in lower case; everything else is space.

Bounds.  Whatever a text holds, a task has the triples of some texts (about ``SLICE_BYTES``, one text at
least), ``GRAMS`` vectors and ``CELLS`` counts at once.  Training sends one vector a language from each
task; they are added in two steps, so that no task gets more than ``SALTS`` of them, or a share
of the tasks.  Prototypes are sent to the tasks in blocks of at most ``PROTOTYPE_BYTES``.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and teaches nothing;
so is every text if nothing could be learned.  Training rows with a null language are
not learned from; the empty string is a language like others.  Repeated rows are learned as often
as they occur.  Very long texts are read whole.  Other columns pass through; those named
like a result are replaced.  An empty table has no rows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackside.llm.common import add_columns, checkpointed, quoted, slices
from trackside.llm.near_dedup import mixed

DIMS = 2048
SLICE_BYTES = 1 << 20
#: Vectors of triples that are held at once, and counts of triples by text.
GRAMS, CELLS = 8192, 8_000_000
#: Tasks' vectors of a language are added in so many groups first.
SALTS = 256
PROTOTYPE_BYTES = 16 << 20
UNKNOWN = "und"

_SPACE = 32


class Letters:
    """Letters by code point; filled as they are met."""

    def __init__(self):
        self.of = np.full(0x110000, -1, np.int32)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        got = self.of[points]
        if (got < 0).any():
            for c in np.unique(points[got < 0]).tolist():
                self.of[c] = c if unicodedata.category(chr(c))[0] in "LM" else _SPACE
            got = self.of[points]
        return got


def triples(texts: list[bytes | None], letters: Letters) -> tuple[np.ndarray, np.ndarray]:
    """(text, triple) of all triples of letters, by text; a triple is one number."""
    row, code = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for k, text in enumerate(texts):
        if not text:
            continue
        s = letters(np.frombuffer(f" {text.decode('utf-8', 'replace').lower()} ".encode("utf-32-le", "replace"), np.uint32)).astype(np.int64)
        s = s[np.concatenate(([True], (s[1:] != _SPACE) | (s[:-1] != _SPACE)))]
        if len(s) > 2:  # a letter at least
            code.append(s[:-2] << 42 | s[1:-1] << 21 | s[2:])
            row.append(np.full(len(s) - 2, k, np.int64))
    return np.concatenate(row), np.concatenate(code)


def letter_bits(points: np.ndarray, dims: int) -> np.ndarray:
    """A row of ``dims`` random bits for each letter."""
    n = np.arange(dims // 64, dtype=np.uint64)
    words = mixed(mixed(points.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))[:, None] + n * np.uint64(0xD1342543DE82EF95))
    return np.unpackbits(words.astype("<u8").view(np.uint8), axis=1, bitorder="little")


def vectors(codes: np.ndarray, dims: int) -> np.ndarray:
    """The bound vectors of triples, as signs."""
    points, at = np.unique(np.concatenate([codes >> 42, codes >> 21 & 0x1FFFFF, codes & 0x1FFFFF]), return_inverse=True)
    bits = letter_bits(points, dims)
    first, second, third = at.reshape(3, -1)
    twice, once, plain = (np.packbits(np.roll(bits, k, axis=1), axis=1) for k in (2, 1, 0))
    bound = np.unpackbits(twice[first] ^ once[second] ^ plain[third], axis=1)
    return 1 - 2 * bound.astype(np.float32)


def bundles(row: np.ndarray, code: np.ndarray, rows: int, dims: int) -> np.ndarray:
    """For each row the sum of its triples' vectors; ``row`` rises."""
    out = np.zeros((rows, dims), np.float32)
    grams, at = np.unique(code, return_inverse=True)
    for g in range(0, len(grams), GRAMS):
        part = grams[g:g + GRAMS]
        v = vectors(part, dims)
        here = (at >= g) & (at < g + len(part)) if len(grams) > GRAMS else slice(None)
        r, c = row[here], at[here] - g
        step = max(1, CELLS // len(part))
        for a in range(0, rows, step):
            b = min(a + step, rows)
            lo, hi = np.searchsorted(r, (a, b))
            counts = np.bincount((r[lo:hi] - a) * len(part) + c[lo:hi], minlength=(b - a) * len(part))
            out[a:b] += counts.reshape(b - a, len(part)).astype(np.float32) @ v
    return out


def learn(docs: DataFrame, training: Column, dims: int = DIMS, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, vector) of the languages of the rows for which ``training`` holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, sums = Letters(), {}

        def table() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.list_(pa.int64()))],
                                              names=["lang", "vector"])

        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                row, code = triples(part.column(1).cast(pa.binary()).to_pylist(), letters)
                names, of = np.unique(np.array(part.column(0).to_pylist(), object), return_inverse=True)
                order = np.argsort(of[row], kind="stable")
                made = bundles(of[row][order], code[order], len(names), dims)
                for name in np.unique(of[row]).tolist():
                    sums[names[name]] = sums.get(names[name], 0) + made[name].astype(np.int64)
                if len(sums) * dims * 8 > PROTOTYPE_BYTES:
                    yield table()
                    sums = {}
        yield table()

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": pdf["lang"].iloc[:1], "vector": [np.stack(pdf["vector"].to_list()).sum(0)]})

    parts = (docs.where(training & F.col(quoted(lang)).isNotNull())
             .select(F.col(quoted(lang)).cast("string").alias("lang"), F.col(quoted(text)).cast("string").alias("text"))
             .mapInArrow(run, "lang string, vector array<long>"))
    salted = parts.withColumn("salt", F.spark_partition_id() % SALTS)
    some = salted.groupBy("lang", "salt").applyInPandas(lambda pdf: added(pdf), "lang string, vector array<long>")
    return some.groupBy("lang").applyInPandas(lambda pdf: added(pdf), "lang string, vector array<long>")


def predict(docs: DataFrame, prototypes: DataFrame, dims: int = DIMS, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score."""
    spark = docs.sparkSession
    known = checkpointed(prototypes)
    count = known.count()
    blocks = max(1, -(-count * dims * 8 // PROTOTYPE_BYTES))
    block = F.pmod(F.xxhash64("lang"), F.lit(blocks))
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    out = docs
    for k in range(blocks):
        # PROTOTYPE_BYTES or so, whatever the number of languages
        rows = sorted((r["lang"], np.array(r["vector"], np.float64)) for r in known.where(block == k).collect())
        names = [r[0] for r in rows]
        units = np.array([v / max(1.0, np.sqrt((v * v).sum())) for _, v in rows]).reshape(len(rows), dims)
        sent = spark.sparkContext.broadcast((names, units))

        def make(texts: list, sent=sent, letters=[]) -> list[pa.Array]:
            names, units = sent.value
            if not letters:
                letters.append(Letters())
            row, code = triples(texts, letters[0])
            some = np.unique(row)
            pred, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            if names and len(some):
                v = bundles(np.searchsorted(some, row), code, len(some), dims).astype(np.float64)
                cosine = v @ units.T / np.maximum(1e-300, np.sqrt((v * v).sum(1)))[:, None]
                best = cosine.argmax(1)
                pred[some] = np.array(names, object)[best]
                score[some] = np.clip(cosine[np.arange(len(some)), best], 0, 1)
            return [pa.array(pred.tolist(), pa.string()), pa.array(score)]

        if blocks == 1:
            return add_columns(docs, text, fields, make, SLICE_BYTES)
        got = add_columns(out.select("*", F.col(quoted(text)).alias("__text")) if k == 0 else
                          out.withColumnsRenamed({"lang_pred": "__lang", "score": "__score"}), "__text", fields, make, SLICE_BYTES)
        if k:
            better = (F.col("lang_pred") != UNKNOWN) & ((F.col("__lang") == UNKNOWN) | (F.col("score") > F.col("__score"))
                                                        | ((F.col("score") == F.col("__score")) & (F.col("lang_pred") < F.col("__lang"))))
            got = got.withColumns({"lang_pred": F.when(better, F.col("lang_pred")).otherwise(F.col("__lang")),
                                   "score": F.when(better, F.col("score")).otherwise(F.col("__score"))}).drop("__lang", "__score")
        out = checkpointed(got)
    return out.drop("__text")
