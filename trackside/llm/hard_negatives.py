"""Hard negatives by coordinate pruning in length buckets (after LEMP).

Scores.  Vectors are scaled and rounded down to integers; a score is an integer inner
product, so ties are exact: higher scores come first, then smaller ids.  For each anchor
its ``positives`` best other rows of the same label are found, and for each of these
the ``negatives`` best rows of another label whose score lies between ``low`` and
``high`` percent of the positive's.

Buckets.  All rows are ranged by label and falling length; a bucket is a run of them with
one label and lengths within a tenth of its longest (short runs are joined).  It holds
for every coordinate the list of its unit vectors' values, sorted.

Pruning.  An anchor needs rows of a score t or more (its last best row so far, or the
least score a negative may have).  Of a bucket whose longest row has length l only
unit vectors with a cosine of t / (l |q|) or more can reach it: if that is above one the
bucket is passed over; else a row's value in a coordinate must lie within an interval
that follows from the anchor's value there.  For the anchor's ``FOCUS`` largest
coordinates these intervals are looked up in the sorted lists and the candidate sets
intersected; what is left is verified exactly.  Where no list leaves less than half
of a bucket, its scores are computed as one matrix product instead.

Distribution.  Anchors are taken in blocks of at most ``BLOCK_BYTES``, each of which is sent to
all tasks; each task keeps the best rows of the block's anchors over its own buckets, and
a window merges the tasks' few rows.  A block's results are checkpointed before the next is
sent.  Rows are shuffled once, by (label, length, hash of the id), so equal vectors or a
label with a third of the rows are split like any others.

Defined cases: a row with a null id, label or vector, or any null or non-finite component,
takes no part.  An empty vector is all zeros, shorter vectors are filled with zeros.  Rows
of an id other than the anchor's are its "other rows"; a repeated row counts as
often as it occurs, as a candidate and as an anchor.  A positive of negative score has no
negatives.  A vector of (scaled) length 2**26 or more, whose scores could be inexact,
ends the run with an error.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackside.llm.common import checkpointed, quoted

#: Bytes of an anchor block, as it is sent to every task.
BLOCK_BYTES = 16 << 20
#: Rows of a bucket, at most and (before it is closed for its label or length) at least.
BUCKET_ROWS, LEAST_ROWS = 8192, 256
#: A bucket's rows are this share of its longest row's length, or longer.
LENGTH_SHARE = 0.9
#: Coordinates of an anchor whose lists are looked up.
FOCUS = 3
#: Anchors whose scores with a whole bucket are held at once.
ANCHOR_ROWS = 64
#: Scores are exact for vectors shorter than this.
LONGEST = float(1 << 26)

NONE = -np.inf


class Bucket:
    """Rows of like length, by id; ``labels`` are codes of the block's labels (-1: another one)."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.rows = ids[order], labels[order], rows[order]
        length = np.sqrt((self.rows ** 2).sum(1))
        self.top = length.max()
        self.unit = self.rows / np.where(length, length, 1)[:, None]
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """Coordinate f: the rows by value, and the values."""
        if f not in self._lists:
            order = np.argsort(self.unit[:, f], kind="stable")
            self._lists[f] = order, self.unit[order, f]
        return self._lists[f]


class Anchors:
    """A block of anchors: vectors, ids, label codes, focus coordinates."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray, labels: list[str], rows: np.ndarray):
        self.codes = {x: k for k, x in enumerate(sorted(set(labels)))}
        self.keys, self.ids, self.rows = keys, ids, rows
        self.labels = np.array([self.codes[x] for x in labels], np.int64)
        self.length = np.sqrt((rows ** 2).sum(1))
        self.unit = rows / np.where(self.length, self.length, 1)[:, None]
        self.focus = np.argsort(-np.abs(self.unit), axis=1, kind="stable")[:, :FOCUS]


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as rows of ``width`` numbers, filled with zeros."""
    n = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(n), width))
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)] = vectors.flatten().to_numpy()
    return out


def buckets(batches: Iterator[pa.RecordBatch], anchors: Anchors) -> Iterator[Bucket]:
    """The buckets of rows (id, label, length, vector) that come by label and falling length."""
    width = anchors.rows.shape[1]
    for batch in batches:
        names = batch.column(1).dictionary_encode()
        code = np.array([anchors.codes.get(x, -1) for x in names.dictionary.to_pylist()], np.int64)
        label = names.indices.to_numpy()
        ids, length = batch.column(0).to_numpy(), batch.column(2).to_numpy()
        start = 0
        while start < batch.num_rows:
            end = min(start + BUCKET_ROWS, batch.num_rows)
            change = (label[start:end] != label[start]) | (length[start:end] < LENGTH_SHARE * length[start])
            change[:LEAST_ROWS] = False
            if change.any():
                end = start + int(change.argmax())
            yield Bucket(ids[start:end], code[label[start:end]], matrix(batch.column(3).slice(start, end - start), width))
            start = end


def feasible(bucket: Bucket, anchors: Anchors, which: np.ndarray, least: np.ndarray) -> Iterator[tuple]:
    """(anchors, rows) that together hold all pairs of ``which`` and the bucket that can score ``least``.

    rows None stands for the whole bucket."""
    bound = anchors.length[which] * bucket.top
    open_end = (least <= 0) | (bound == 0)
    t = np.divide(least, bound, out=np.zeros(len(which)), where=~open_end) * (1 - 1e-9)
    reached = open_end | (t <= 1)
    which, t, open_end = which[reached], t[reached], open_end[reached]
    n = len(bucket.ids)
    spread = np.sqrt(np.maximum(0, 1 - t * t))
    from_, to = np.zeros((len(which), FOCUS), np.int64), np.full((len(which), FOCUS), n)
    low, high = np.full((len(which), FOCUS), -2.0), np.full((len(which), FOCUS), 2.0)
    for k in range(anchors.focus.shape[1]):
        f = anchors.focus[which, k]
        q = anchors.unit[which, f]
        half = np.sqrt(np.maximum(0, 1 - q * q)) * spread
        low[:, k] = np.where(open_end | (q < -t), -2, q * t - half - 1e-9)
        high[:, k] = np.where(open_end | (q > t), 2, q * t + half + 1e-9)
        for x in np.unique(f[~open_end]):
            mine = (f == x) & ~open_end
            values = bucket.sorted_list(int(x))[1]
            from_[mine, k] = np.searchsorted(values, low[mine, k], "left")
            to[mine, k] = np.searchsorted(values, high[mine, k], "right")
    best = (to - from_).argmin(1)
    at = np.arange(len(which))
    sparse = 2 * (to - from_)[at, best] <= n
    if (~sparse).any():
        yield which[~sparse], None
    for i in np.flatnonzero(sparse):
        a, k = which[i], best[i]
        rows = bucket.sorted_list(int(anchors.focus[a, k]))[0][from_[i, k]:to[i, k]]
        for j in range(anchors.focus.shape[1]):
            if j != k:
                v = bucket.unit[rows, anchors.focus[a, j]]
                rows = rows[(v >= low[i, j]) & (v <= high[i, j])]
        if len(rows):
            yield np.array([a]), np.sort(rows)


class Best:
    """The k best (score, id) of each slot; each anchor has ``slots`` of them, each with its own range of scores."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.low, self.high, self.k = low, high, k
        self.score = np.full((*low.shape, k), NONE)
        self.id = np.zeros((*low.shape, k), np.int64)

    def least(self, which: np.ndarray) -> np.ndarray:
        """For each slot the score below which nothing can enter it any more."""
        return np.maximum(self.low[which], self.score[which, :, -1])

    def offer(self, which: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Scores of the anchors ``which`` (rows) with rows of ids that rise (columns)."""
        least, high = self.least(which), self.high[which]
        at = np.arange(len(which))
        top = score.max(1)
        for j in range(least.shape[1]):
            live = at[top >= least[:, j]]
            if not len(live):
                continue
            s = score[live]
            s = np.where((s >= least[live, j, None]) & (s <= high[live, j, None]), s, NONE)
            new_score, new_id = np.full((len(live), self.k), NONE), np.zeros((len(live), self.k), np.int64)
            row = np.arange(len(live))
            for r in range(min(self.k, s.shape[1])):
                col = s.argmax(1)  # of equal scores the first, which has the smallest id
                new_score[:, r], new_id[:, r] = s[row, col], ids[col]
                s[row, col] = NONE
                if (new_score[:, r] == NONE).all():
                    break
            a = which[live]
            both, both_id = np.hstack([self.score[a, j], new_score]), np.hstack([self.id[a, j], new_id])
            order = np.lexsort((both_id, -both))[:, :self.k]
            self.score[a, j] = np.take_along_axis(both, order, 1)
            self.id[a, j] = np.take_along_axis(both_id, order, 1)

    def rows(self, anchors: Anchors) -> pa.RecordBatch:
        a, j, r = np.nonzero(self.score > NONE)
        return pa.RecordBatch.from_arrays(
            [pa.array(anchors.keys[a]), pa.array(anchors.ids[a]), pa.array(j.astype(np.int32)),
             pa.array(self.score[a, j, r].astype(np.int64)), pa.array(self.id[a, j, r])],
            names=["anchor", "anchor_id", "slot", "score", "id"])


FOUND = "anchor long, anchor_id long, slot int, score long, id long"


def search(anchors: Anchors, low: np.ndarray, high: np.ndarray, k: int, same: bool):
    """A mapInArrow function: each anchor's best rows of a label that is the ``same`` or another."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(low, high, k)
        some = np.flatnonzero((high > NONE).any(1))
        for bucket in buckets(batches, anchors):
            here = np.isin(anchors.labels[some], bucket.labels) if same else \
                ~np.all(anchors.labels[some, None] == np.unique(bucket.labels), axis=1)
            which = some[here]
            for group, rows in feasible(bucket, anchors, which, best.least(which).min(1)):
                ids, labels = (bucket.ids, bucket.labels) if rows is None else (bucket.ids[rows], bucket.labels[rows])
                vectors = bucket.rows if rows is None else bucket.rows[rows]
                for g in range(0, len(group), ANCHOR_ROWS):
                    part = group[g:g + ANCHOR_ROWS]
                    score = anchors.rows[part] @ vectors.T
                    equal = anchors.labels[part, None] == labels
                    score[~equal if same else equal] = NONE
                    if same:
                        score[anchors.ids[part, None] == ids] = NONE
                    best.offer(part, score, ids)
        yield best.rows(anchors)

    return run


def merged(found: DataFrame, k: int) -> DataFrame:
    """Of the tasks' rows the k best of each slot, with their rank."""
    w = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def prepared(rows: DataFrame, is_anchor: Column, vec_id: str, label: str, vector: str, scale: int) -> DataFrame:
    """(id, label, length, vector, is_anchor) of the rows that take part."""
    x = F.col(quoted(vector))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long"))
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))
    return (rows.where(F.col(quoted(vec_id)).isNotNull() & F.col(quoted(label)).isNotNull() & x.isNotNull() & finite)
            .select(F.col(quoted(vec_id)).cast("long").alias("id"), F.col(quoted(label)).cast("string").alias("label"),
                    whole.alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
            .select("id", "label", F.when(length < LONGEST, length).otherwise(F.raise_error(F.lit(
                "a vector is too long for exact scores"))).alias("length"), "vector", "is_anchor"))


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         scale: int = 256, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every anchor."""
    laid = checkpointed(prepared(rows, is_anchor, vec_id, label, vector, scale)
                        .repartitionByRange("label", F.desc("length"), F.xxhash64("id"))
                        .sortWithinPartitions("label", F.desc("length"), "id")
                        .withColumn("key", F.monotonically_increasing_id()))
    size = laid.agg(F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("width"),
                    F.count_if("is_anchor").alias("anchors")).first()
    data = laid.select("id", "label", "length", "vector")
    width = max(1, size["width"])
    blocks = max(1, -(-size["anchors"] * width * 8 // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("key"), F.lit(blocks))
    out = []
    for k in range(blocks):
        got = laid.where(F.col("is_anchor") & (block == k)).select("key", "id", "label", "vector").toArrow()
        if got.num_rows:
            out.append(_block(data, got, width, positives, negatives, low, high))
    if not out:
        return _named(laid.limit(0).select(*[F.lit(0).cast("long").alias(c) for c in (
            "anchor_id", "positive_id", "rank", "id", "positive_score", "score")]))
    done = out[0]
    for more in out[1:]:
        done = done.unionByName(more)
    return done


def _block(data: DataFrame, got: pa.Table, width: int, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """The results of one block of anchors, checkpointed."""
    spark = data.sparkSession
    anchors = Anchors(got.column("key").to_numpy(), got.column("id").to_numpy(), got.column("label").to_pylist(),
                      matrix(got.column("vector").combine_chunks(), width))
    sent = spark.sparkContext.broadcast(anchors)
    any_ = np.full((len(anchors.ids), 1), np.inf)
    near = checkpointed(merged(data.mapInArrow(
        lambda it: search(sent.value, -any_, any_, positives, True)(it), FOUND), positives))
    first = near.select("anchor", "rank", "score").toArrow()  # at most ``positives`` rows for each anchor of the block
    spot = {key: i for i, key in enumerate(anchors.keys.tolist())}
    row = np.array([spot[x] for x in first.column("anchor").to_pylist()], np.int64)
    slot = first.column("rank").to_numpy().astype(np.int64) - 1
    score = first.column("score").to_numpy()
    # a slot without a positive, or with one of negative score, takes nothing
    from_, to = np.full((len(anchors.ids), positives), np.inf), np.full((len(anchors.ids), positives), NONE)
    fits = score >= 0
    from_[row[fits], slot[fits]] = -(-low * score[fits] // 100)
    to[row[fits], slot[fits]] = high * score[fits] // 100
    ranges = spark.sparkContext.broadcast((from_, to))
    far = merged(data.mapInArrow(lambda it: search(sent.value, *ranges.value, negatives, False)(it), FOUND), negatives)
    asked = near.select("anchor", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"),
                        F.col("score").alias("positive_score"))
    done = checkpointed(_named(far.join(asked, ["anchor", "slot"])))
    for x in (sent, ranges):
        x.unpersist()
    return done


def _named(rows: DataFrame) -> DataFrame:
    return rows.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                       "positive_score", F.col("score").alias("negative_score"))
