"""Spelling variants of the words of a corpus, by Bloom-guided neighbourhoods.

Words.  ``count_words`` counts maximal runs of the letters A-Z, a-z and U+00C0 to U+00FF, A-Z made
small, and keeps those of at least ``least_chars`` code points and ``least_count`` occurrences.

Neighbours.  Two words are near if one inserted, deleted or replaced code point makes one of
the other.  Of each word all deletions, and all replacements of a letter by a larger one of
those that the vocabulary uses, are generated as hashes (a polynomial in the code points, so
that each edit costs a few operations however long the word is).  The edits are probed
against blocked Bloom filters of the vocabulary, a shard for each length: one block of 512
bits and eight bits in it for a word.  Only positives are written out as words and shuffled to
an exact join with the vocabulary, which removes the false ones.  Insertions and
replacements by smaller letters are these pairs seen from the other side, so every near
pair is met exactly once.

Bounds.  The filters are built in tasks, in segments of ``SEGMENT`` blocks, and sent to all tasks in
rounds of at most ``FILTER_BYTES``; a shard that is larger is split by block over
rounds.  A longer word has more edits and gets more bits.  A word has at most 46 positives a
code point, whatever the texts hold, so no key of the join is hot.  Tasks count words in
tables of at most ``TABLE_WORDS`` entries that are summed by a shuffle.

Forms.  A word's form is its near word of largest count (ties: smallest in code-point order)
if that count is at least ``factor`` times its own; its root is reached by following forms to the
last.  Counts grow tenfold a step, so pointers are doubled a few times only.

Defined cases: a null or empty text has no words; a null id is an empty text to ``change``.
Repeated rows count as often as they occur.  Very long texts are counted whole, very long runs
are words like others.  An empty table has no rows.  Extra columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackside.llm.common import checkpointed, quoted, slices
from trackside.llm.near_dedup import mixed

LEAST_CHARS, LEAST_COUNT, FACTOR = 7, 2, 10
#: Entries of a task's table of counts.
TABLE_WORDS = 200_000
#: Bytes of Bloom filters sent at once; a block has 64 of them.
FILTER_BYTES = 32 << 20
BLOCK_BITS, BLOCK_WORDS = 512, 8
#: Blocks that are built by one task.
SEGMENT = 512
#: Edits that are held at once.
EDITS = 1_000_000

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


# -- words ---------------------------------------------------------------------------------

def count_words(docs: DataFrame, change: Callable[[str, list[str]], list[str]] | None = None,
                least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT,
                text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(word, n) of all texts.  ``change`` gets a document's id as text and its distinct runs (small letters,
    ``least_chars`` or more) and returns what each of them counts as (fewer code points at most)."""
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % least_chars)

    def table(counts: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                          names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in batches:
            for part in slices(batch, 1):
                for name, body in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                    if not body:
                        continue
                    found: dict[str, int] = {}
                    # the lower case of bytes changes A-Z alone
                    for m in runs.finditer(body.lower().decode("utf-8", "replace")):
                        w = m.group()
                        found[w] = found.get(w, 0) + 1
                    words = list(found)
                    for w, n in zip(change(name or "", words) if change else words, found.values()):
                        if len(w) >= least_chars:
                            counts[w] = counts.get(w, 0) + n
                    if len(counts) >= TABLE_WORDS:
                        yield table(counts)
                        counts = {}
        yield table(counts)

    return (docs.select(F.col(quoted(doc_id)).cast("string"), F.col(quoted(text)).cast("string"))
            .mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least_count))


# -- hashes and filters --------------------------------------------------------------------

def powers(n: int) -> np.ndarray:
    """1, b, b^2, ... of the polynomial's base."""
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, _ODD, np.uint64))))


def by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, positions in ``words``, code points) for each length."""
    sizes = np.array([len(w) for w in words])
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)
        # code points, four bytes each
        points = np.frombuffer("".join(words[i] for i in at).encode("utf-32-le"), np.uint32).reshape(len(at), n)
        yield int(n), at, points


def polynomial(points: np.ndarray) -> np.ndarray:
    return (points.astype(np.uint64) * powers(points.shape[1] - 1)).sum(1, dtype=np.uint64)


def places(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The block (of ``blocks``) and the eight bits in it (six bits of the second number each) of words of one length."""
    g = mixed(h + np.uint64(0x632BE59BD9B4E019))
    return ((g >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64), mixed(g ^ np.uint64(_ODD))


def bits_of(g: np.ndarray, k: int) -> np.ndarray:
    return np.uint64(1) << (g >> np.uint64(6 * k) & np.uint64(63))


class Filters:
    """The blocks from ``first`` to ``last`` of all shards, laid one after another by length."""

    def __init__(self, shards: dict[int, tuple[int, int]], first: int, last: int, segments: dict[int, bytes]):
        self.shards, self.first, self.last = shards, first, last
        self.bits = np.zeros((last - first, BLOCK_WORDS), np.uint64)
        for k, data in segments.items():
            part = np.frombuffer(data, np.uint64).reshape(-1, BLOCK_WORDS)
            self.bits[k * SEGMENT:k * SEGMENT + len(part)] = part[:last - first - k * SEGMENT]

    def positive(self, length: int, h: np.ndarray) -> np.ndarray:
        """Positions of the hashes that may be words of ``length``."""
        if length not in self.shards:
            return np.empty(0, np.int64)
        start, blocks = self.shards[length]
        block, g = places(h, blocks)
        block += start - self.first
        at = np.flatnonzero((block >= 0) & (block < len(self.bits)))
        for k in range(BLOCK_WORDS):
            at = at[self.bits[block[at], k] & bits_of(g[at], k) != 0]
        return at


def edits(points: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(length, hashes, word, position, letter) of words of one length, some positions at a time.

    Letter 0 is a deletion (of the first of equal letters), else a replacement by a larger letter."""
    words, n = points.shape
    power = powers(n)
    terms = points.astype(np.uint64) * power[:n]
    total = terms.sum(1, dtype=np.uint64)
    before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
    step = max(1, EDITS // (words * max(1, len(alphabet))))
    letters = alphabet.astype(np.uint64)
    for a in range(0, n, step):
        here = points[:, a:a + step]
        # what stands behind the position moves one place to the front
        h = before[:, a:a + step] + (total[:, None] - before[:, a:a + step] - terms[:, a:a + step]) * np.uint64(_INVERSE)
        fresh = np.ones(here.shape, bool)
        fresh[:, 0] = True if a == 0 else points[:, a] != points[:, a - 1]
        fresh[:, 1:] = here[:, 1:] != here[:, :-1]
        w, i = np.nonzero(fresh)
        yield n - 1, h[w, i], w, i + a, np.zeros(len(w), np.uint32)
        larger = letters[None, None, :] > here[:, :, None]
        w, i, c = np.nonzero(larger)
        i += a
        yield n, total[w] + (letters[c] - points[w, i]) * power[i], w, i, alphabet[c]


def segments_of(shards: dict[int, tuple[int, int]], first: int, last: int):
    """A mapInArrow function: (segment, block in it, bits) of the words whose block lies between ``first`` and ``last``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, _, points in by_length(batch.column(0).to_pylist()) if batch.num_rows else ():
                start, blocks = shards[length]
                block, g = places(polynomial(points), blocks)
                block += start
                keep = (block >= first) & (block < last)
                block, g = block[keep] - first, g[keep]
                yield pa.RecordBatch.from_arrays([pa.array((block // SEGMENT).astype(np.int32)), pa.array((block % SEGMENT).astype(np.int32)),
                                                  pa.array(g.view(np.int64))], names=["segment", "block", "bits"])

    return run


def segment(pdf: pd.DataFrame) -> pd.DataFrame:
    bits = np.zeros((SEGMENT, BLOCK_WORDS), np.uint64)
    block, g = pdf["block"].to_numpy(), pdf["bits"].to_numpy().view(np.uint64)
    for k in range(BLOCK_WORDS):
        np.bitwise_or.at(bits[:, k], block, bits_of(g, k))
    return pd.DataFrame({"segment": pdf["segment"].iloc[:1], "bits": [bits.tobytes()]})


def positives(filters, alphabet: np.ndarray):
    """A mapInArrow function: (word, n, edit) for the edits of (word, n) that the filters hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = filters.value
        for batch in batches:
            words, counts = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for n, at, points in by_length(words) if words else ():
                rows = max(1, EDITS // (n * max(1, len(alphabet))))
                for a in range(0, len(at), rows):
                    for length, h, w, i, letter in edits(points[a:a + rows], alphabet):
                        hit = f.positive(length, h)
                        if not len(hit):
                            continue
                        mine = at[a + w[hit]]
                        made = [words[j][:p] + (chr(c) if c else "") + words[j][p + 1:]
                                for j, p, c in zip(mine.tolist(), i[hit].tolist(), letter[hit].tolist())]
                        yield pa.RecordBatch.from_arrays([pa.array([words[j] for j in mine.tolist()], pa.string()),
                                                          pa.array(counts[mine]), pa.array(made, pa.string())],
                                                         names=["word", "n", "edit"])

    return run


# -- pairs, forms, roots -------------------------------------------------------------------

def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): each near pair of the (checkpointed) ``words`` once."""
    spark = words.sparkSession
    # one row a length, one a letter
    sizes = sorted((r["size"], r["k"]) for r in words.groupBy(F.length("word").alias("size")).agg(F.count("*").alias("k")).collect())
    alphabet = np.array(sorted(ord(r[0]) for r in words.select(F.explode(F.array_distinct(F.split("word", ""))))
                               .distinct().collect() if r[0]), np.uint32)
    shards, total = {}, 0
    for size, k in sizes:
        blocks = -(-k * max(16, 2 * size) // BLOCK_BITS)
        shards[size] = total, blocks
        total += blocks
    a_round = FILTER_BYTES * 8 // BLOCK_BITS
    out = spark.createDataFrame([], "word string, n long, edit string")
    for first in range(0, total, a_round):
        last = min(total, first + a_round)
        built = (words.select("word").mapInArrow(segments_of(shards, first, last), "segment int, block int, bits long")
                 .groupBy("segment").applyInPandas(segment, "segment int, bits binary").collect())  # FILTER_BYTES at most
        sent = spark.sparkContext.broadcast(Filters(shards, first, last, {r["segment"]: bytes(r["bits"]) for r in built}))
        out = out.unionByName(checkpointed(words.mapInArrow(positives(sent, alphabet), "word string, n long, edit string")))
        sent.unpersist()
    return out.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")),
                    F.col("edit") == F.col("other")).drop("edit")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the last word that following forms leads to."""
    now = checkpointed(forms.select("word", F.col("form").alias("root")))
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("far"))
        moved = checkpointed(now.join(step, "root", "left"))
        if moved.where("far IS NOT NULL").isEmpty():
            return now
        now = moved.select("word", F.coalesce("far", "root").alias("root"))


def group_variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """(word, n, form, form_n, n_near, root) for distinct ``words`` with their counts n."""
    words = checkpointed(words)
    both = near_pairs(words).select(F.explode(F.array(
        F.struct("word", "n", F.col("other").alias("near"), F.col("other_n").alias("near_n")),
        F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")),
    )).alias("x")).select("x.*")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("k"), "near")).alias("b"))
    enough = -F.col("b.k") >= factor * F.col("n")
    found = checkpointed(words.join(best, "word", "left").select(
        "word", "n", F.when(enough, F.col("b.near")).alias("form"), F.when(enough, -F.col("b.k")).alias("form_n"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near")))
    root = roots(found.where("form IS NOT NULL"))
    return found.join(root, "word", "left").withColumn("root", F.coalesce("root", "word"))
