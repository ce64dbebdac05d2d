"""Language-model scores by Katz backoff over word pairs.

Model.  Tokens are words (runs of characters other than space and \\t to \\r, A-Z made
small) and one end for each text; a text begins after a start mark.  Seen pairs get their
count with Good-Turing's discount (counts up to ``K``; larger ones give up the fixed share
``RESERVE``, so that every context keeps something for unseen words):

    p(w | u) = d(c(u,w)) c(u,w) / c(u)           where the pair was seen in training
             = alpha(u) p(w)                     else (alpha(u) = 1 for an unseen context)
    p(w)     = d(c(w)) c(w) / N, and what that leaves for the unknown word

alpha(u) is what the seen pairs of u leave, divided by what their words leave of p: the
sum over all words is exactly 1.  Where the counts of counts give no valid discount for
some count, fewer counts are discounted by Good-Turing; with none, absolute
discounting by one half takes its place.

Jobs.  Texts are read in blocks (rows of one task, bounded in bytes).
1. Words: each block's distinct words with their counts, summed in the unigram table, which is stored.
   It gives N, the number of words, the counts of counts and the hot words (more than a
   quarter of a bucket's share; at most 4 for each bucket: the only list that is broadcast).
2. Pairs: each block sends every bucket one row with the distinct pairs it has there and the
   documents they stand in.  A pair's bucket is that of its second word, for a hot word that
   of the pair; so a task holds all places of its pairs, whole counts, and all there is to know of
   its words, about ``PLACES`` places however large the input.  Each place is
   scored there as far as its pair and word say; the rest are the pair discounts, five unknown
   factors by which places are only counted, and alpha(u) where the pair is unseen.
   What a bucket finds is stored, in tables partitioned by context and by block.
3. Contexts: the sums over the seen pairs of each context meet the places that need its alpha.
4. Blocks: the parts of each document are summed.
Pairs and words are known by 64-bit hashes.

Defined cases: a null text is empty, and consists of the end alone; rows with a null id train;
repeated rows all count and are all scored; without training texts every token has
probability 1, and an empty table gives an empty result.  Only the id, the text and the
training flag are used; other columns are not carried.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackside.llm.common import quoted, slices
from trackside.session import scratch_dir

K = 5
RESERVE = 0.01
PLACES = 2_500_000
BLOCK_BYTES, BLOCK_ROWS = 16 << 20, 50_000
END, START = 1, 2   # hashes of the two marks; a word's hash is above them
DOCS, PART, CONTEXT, EVENT, HIST, VALUE = range(6)


# -- texts to numbers ------------------------------------------------------------------------

def block_tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a block: hash of each local word (END first, then START), the local words of all
    texts in order with an end behind each text, and the text of each token."""
    numbers: dict[bytes, int] = {}
    number = numbers.setdefault
    ids, sizes = [], []
    for t in texts:
        words = t.lower().split() if t else ()
        ids += [number(w, len(numbers) + 2) for w in words]
        ids.append(0)
        sizes.append(len(words) + 1)
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter((END, START, *(max(digest(w), START + 1) for w in numbers)), np.uint64, len(numbers) + 2)
    return hashes, np.array(ids, np.int64), np.repeat(np.arange(len(texts)), sizes)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The blocks of a task with ids that a repeated task finds again."""
    n = TaskContext.get().partitionId() << 32
    for batch in batches:
        for part in slices(batch, 1, BLOCK_BYTES):
            for at in range(0, part.num_rows, BLOCK_ROWS):
                yield n, part.slice(at, BLOCK_ROWS)
                n += 1


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, block in _blocks(batches):
        hashes, ids, text = block_tokens(block.column(1).to_pylist())
        trains = block.column(2).to_numpy(zero_copy_only=False)
        count = np.bincount(ids[trains[text]], minlength=len(hashes))
        seen = count > 0
        yield pa.RecordBatch.from_arrays([pa.array(hashes[seen].view(np.int64)), pa.array(count[seen])], names=["word", "n"])


def _send_pairs(buckets: int, hot: np.ndarray):
    """Rows (bucket, block, payload) of each block: its pairs by bucket, and its documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in _blocks(batches):
            hashes, w, text = block_tokens(rows.column(1).to_pylist())
            trains = rows.column(2).to_numpy(zero_copy_only=False)
            u = np.concatenate(([1], w[:-1]))
            u[u == 0] = 1
            by_word = (hashes % np.uint64(buckets)).astype(np.int64)
            bucket = by_word[w]
            at_hot = np.isin(hashes, hot)[w]
            mixed = hashes[u[at_hot]] * np.uint64(0x9E3779B97F4A7C15) ^ hashes[w[at_hot]]
            bucket[at_hot] = ((mixed ^ mixed >> np.uint64(29)) % np.uint64(buckets)).astype(np.int64)
            size = len(hashes)
            pair = (bucket * size + w) * size + u
            order = np.argsort(pair, kind="stable")
            pair, text = pair[order], text[order].astype(np.uint16)
            first = np.flatnonzero(np.diff(pair, prepend=-1))
            pair, places = pair[first], np.diff(first, append=len(text)).astype(np.uint32)
            pair_u, pair_w, pair_b = pair % size, pair // size % size, pair // size // size
            edge = np.searchsorted(pair_b, np.arange(buckets + 1))
            at = np.append(first, len(text))[edge]
            for b in range(buckets):
                if edge[b] == edge[b + 1]:
                    continue
                here = slice(edge[b], edge[b + 1])
                new = np.flatnonzero(np.diff(pair_w[here], prepend=-1))
                payload = (hashes[pair_w[here][new]], np.diff(new, append=edge[b + 1] - edge[b]).astype(np.uint32),
                           hashes[pair_u[here]], places[here], text[at[b]:at[b + 1]], trains)
                yield _row(b, PART, block, payload)
            names = pa.RecordBatch.from_arrays([rows.column(0)], names=["doc_id"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, names.schema) as out:
                out.write_batch(names)
            yield _row(block % buckets, DOCS, block, (sink.getvalue().to_pybytes(), trains))
    return run


_SENT = "bucket int, kind int, block long, payload binary"


def _row(bucket: int, kind: int, block: int, payload) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([bucket], pa.int32()), pa.array([kind], pa.int32()), pa.array([block], pa.int64()),
         pa.array([pickle.dumps(payload, protocol=5)], pa.binary())], names=["bucket", "kind", "block", "payload"])


# -- the model's constants -------------------------------------------------------------------

def discounts(n: list[float]) -> np.ndarray:
    """Factors for counts 0 to K, and at K + 1 the one for all larger counts.

    ``n[r]`` is the number of different items with count r, r from 1 to K + 1."""
    above = 1 - RESERVE
    for k in range(K, 0, -1):
        if min(n[1:k + 2]) <= 0:
            continue
        a = (k + 1) * n[k + 1] / n[1]
        d = [((r + 1) * n[r + 1] / (n[r] * r) - a) / (1 - a) if a < 1 else -1.0 for r in range(1, k + 1)]
        if all(0 < x < 1 for x in d):
            return np.array([0.0, *d, *[above] * (K + 1 - k)])
    return np.array([0.0, *[1 - 0.5 / r for r in range(1, K + 1)], above])


class Words:
    """What the unigram table says: N, the number of words, hot words and p."""

    def __init__(self, total: int, different: int, texts: int, n: list[float], hot: dict[int, int]):
        self.total, self.different, self.texts, self.hot = total, different, texts, hot
        self.d = discounts(n)
        known = sum(n[r] * r * self.d[r] for r in range(1, K + 1)) + self.d[K + 1] * (
            total - sum(n[r] * r for r in range(1, K + 1)))
        self.unknown = 1.0 if not total else 1 - known / total

    def p(self, c: np.ndarray) -> np.ndarray:
        c = c.astype(float)
        return np.where(c > 0, self.d[np.minimum(c, K + 1).astype(int)] * c / max(self.total, 1), self.unknown)


# -- a bucket of pairs -----------------------------------------------------------------------

def _score_bucket(rows: list[tuple[int, tuple]], words: Words, buckets: int) -> Iterator[pa.RecordBatch]:
    """What all places of a bucket's pairs say (rows: block and payload of _send_pairs)."""
    blocks = np.array([b for b, _ in rows], np.int64)
    docs = np.array([len(p[5]) for _, p in rows])
    base = np.concatenate(([0], np.cumsum(docs)))
    w = np.concatenate([np.repeat(p[0], p[1]) for _, p in rows])
    u = np.concatenate([p[2] for _, p in rows])
    places = np.concatenate([p[3] for _, p in rows]).astype(np.int64)
    doc = np.concatenate([p[4].astype(np.int32) + np.int32(o) for (_, p), o in zip(rows, base)])
    trains = np.concatenate([p[5] for _, p in rows])
    rows.clear()
    in_training = np.add.reduceat(trains[doc].astype(np.int64), np.concatenate(([0], np.cumsum(places)[:-1])))

    order = np.lexsort((u, w))
    sw, su = w[order], u[order]
    new_w = np.concatenate(([True], sw[1:] != sw[:-1]))
    new_pair = new_w | np.concatenate(([True], su[1:] != su[:-1]))
    pair_of, word_of = np.cumsum(new_pair) - 1, np.cumsum(new_w) - 1
    c_pair = np.bincount(pair_of, weights=in_training[order]).astype(np.int64)
    c_word = np.bincount(word_of, weights=in_training[order]).astype(np.int64)
    which = sw[new_w]
    for i in np.flatnonzero(np.isin(which, np.fromiter(words.hot, np.uint64, len(words.hot)))):
        c_word[i] = words.hot[int(which[i])]
    p_word = words.p(c_word)

    # types: a row for each different pair
    t_first = np.flatnonzero(new_pair)
    t_u, t_p, t_c = su[t_first], p_word[word_of[t_first]], c_pair
    seen = t_c > 0
    hist = np.bincount(np.minimum(t_c, K + 2), minlength=K + 3)
    for r in range(1, K + 2):
        yield _row(int(hist[r]), HIST, r, None)
    ctx, at = np.unique(t_u[seen], return_inverse=True)
    c, n = t_c[seen], len(ctx)
    sums = [np.bincount(at, weights=(c == r), minlength=n).astype(np.uint32) for r in range(1, K + 1)]
    sums += [np.bincount(at, weights=np.where(c > K, c, 0), minlength=n).astype(np.int64),
             np.bincount(at, weights=t_p[seen], minlength=n)]
    yield from _by_context(ctx, sums, CONTEXT, buckets)

    # entries: a row for each pair of a block, in the order received; then places
    e_c, e_w, e_p = np.empty(len(w), np.int64), np.empty(len(w), np.int64), np.empty(len(w))
    e_c[order], e_w[order], e_p[order] = c_pair[pair_of], c_word[word_of], p_word[word_of]
    known = e_w > 0
    logs = np.where(known & (w != END), -np.log10(np.maximum(e_w, 1)), 0.0)
    logs += np.where(e_c > K, np.log10(np.maximum(e_c, 1)), np.where(e_c == 0, np.log10(e_p), 0.0))
    at_place = np.repeat(np.arange(len(w), dtype=np.int32), places)
    total = base[-1]

    def by_doc(value: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights=value[at_place], minlength=total)

    sums = [by_doc(np.log10(e_w + 1.0)), by_doc(logs), by_doc(known.astype(float)).astype(np.uint32),
            by_doc((e_c > K).astype(float)).astype(np.uint32),
            *[by_doc((e_c == r).astype(float)).astype(np.uint32) for r in range(1, K + 1)],
            np.bincount(doc, minlength=total).astype(np.uint32)]
    for i, block in enumerate(blocks):
        here = slice(base[i], base[i + 1])
        some = np.flatnonzero(sums[-1][here])
        yield _row(0, PART, block, (some.astype(np.uint16), *[s[here][some] for s in sums]))

    unseen = (e_c == 0)[at_place]
    e_doc = doc[unseen]
    e_block = np.searchsorted(base, e_doc, "right") - 1
    yield from _by_context(u[at_place[unseen]], [blocks[e_block], (e_doc - base[e_block]).astype(np.uint16)],
                           EVENT, buckets)


def _by_context(u: np.ndarray, columns: list[np.ndarray], kind: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """A row for each bucket of contexts."""
    to = (u % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((u, to))
    edge = np.searchsorted(to[order], np.arange(buckets + 1))
    for b in range(buckets):
        if edge[b] < edge[b + 1]:
            part = order[edge[b]:edge[b + 1]]
            yield _row(b, kind, b, (u[part], *[x[part] for x in columns]))


def _score_buckets(words: Words, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for bucket, kind, block, payload in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if kind == DOCS:
                    yield _row(0, DOCS, block, pickle.loads(payload))
                else:
                    held.setdefault(bucket, []).append((block, pickle.loads(payload)))
        for bucket in list(held):
            # the order in which rows arrive plays no part in the sums
            yield from _score_bucket(sorted(held.pop(bucket), key=lambda x: x[0]), words, buckets)
    return run


# -- contexts and documents ------------------------------------------------------------------

def context_weights(contexts: list[tuple], d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Contexts in order and log10(alpha(u) c(u)) of each (payloads of kind CONTEXT)."""
    u, at = np.unique(np.concatenate([p[0] for p in contexts]), return_inverse=True)
    small = [np.bincount(at, weights=np.concatenate([p[r] for p in contexts])) for r in range(1, K + 1)]
    large = np.bincount(at, weights=np.concatenate([p[K + 1] for p in contexts]))
    p = np.bincount(at, weights=np.concatenate([p[K + 2] for p in contexts]))
    left = sum(small[r - 1] * r * (1 - d[r]) for r in range(1, K + 1)) + large * (1 - d[K + 1])
    return u, np.log10(left / (1 - p))


def _weigh_events(d: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts, events = [], []
        for batch in batches:
            for kind, payload in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist()):
                (contexts if kind == CONTEXT else events).append(pickle.loads(payload))
        if not contexts or not events:
            return
        u, weight = context_weights(contexts, d)
        eu, block, doc = (np.concatenate([e[i] for e in events]) for i in range(3))
        at = np.minimum(np.searchsorted(u, eu), len(u) - 1)
        value = np.where(u[at] == eu, weight[at], 0.0)
        names, which = np.unique(block, return_inverse=True)
        key = which.astype(np.int64) << 16 | doc
        keys, back = np.unique(key, return_inverse=True)
        sums = np.bincount(back, weights=value)
        edge = np.searchsorted(keys >> 16, np.arange(len(names) + 1))
        for i, name in enumerate(names):
            here = slice(edge[i], edge[i + 1])
            yield _row(0, VALUE, name, ((keys[here] & 0xFFFF).astype(np.uint16), sums[here]))
    return run


def _sum_block(d: np.ndarray, words: Words, held_out: str):
    log_d = np.log10(np.maximum(d, 1e-300))
    columns = ["doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["kind", "bucket"], kind="stable")
        payloads = [(k, pickle.loads(p)) for k, p in zip(rows["kind"], rows["payload"])]
        names, trains = next(p for k, p in payloads if k == DOCS)
        n = len(trains)
        base, score, known, tokens = np.zeros(n), np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for kind, p in payloads:
            if kind == PART:
                at = p[0]
                base[at] += p[1]
                known[at] += p[3]
                tokens[at] += p[-1]
                score[at] += p[2] + p[4] * log_d[K + 1] + sum(p[4 + r] * (log_d[r] + np.log10(r)) for r in range(1, K + 1))
            elif kind == VALUE:
                score[p[0]] += p[1]
        if words.texts:
            score -= np.log10(words.texts)
        base -= tokens * np.log10(words.total + words.different + 1)
        ids = pa.ipc.open_stream(names).read_all().column(0)
        return pd.DataFrame(dict(zip(columns, (ids.to_pandas(types_mapper=pd.ArrowDtype), ~trains, tokens, known,
                                               np.full(n, words.total), base, score))))
    return run


def score_documents(docs: DataFrame, trains: Column, text: str = "text", doc_id: str = "doc_id",
                    places: int = PLACES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    ``trains`` says which rows the model learns from; all are scored.  base_score is that of
    single words with one added to each count; both are log10 probabilities of the text."""
    spark = docs.sparkSession
    rows = docs.select(F.col(quoted(doc_id)).alias("doc_id"), F.col(quoted(text)).cast("binary").alias("text"),
                       F.coalesce(trains, F.lit(True)).alias("trains"))
    where = scratch_dir(spark, "katz")
    (rows.mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
     .write.parquet(f"{where}/unigrams"))
    unigrams = spark.read.parquet(f"{where}/unigrams")
    got = unigrams.agg(F.sum("n"), F.count("*"), F.sum(F.when(F.col("word") == END, F.col("n"))),
                       *[F.sum(F.when(F.col("n") == r, 1).otherwise(0)) for r in range(1, K + 2)]).first()
    total = got[0] or 0
    buckets = max(1, -(-total * 7 // (6 * places)))
    # at most 4 for each bucket
    hot = {r.word % (1 << 64): r.n for r in unigrams.where(F.col("n") * 4 * buckets > total).collect()} if buckets > 1 else {}
    words = Words(total, got[1], got[2] or 0, [0, *[x or 0 for x in got[3:]]], hot)

    sent = rows.mapInArrow(_send_pairs(buckets, np.fromiter(hot, np.uint64, len(hot))), _SENT)
    (sent.repartitionById(buckets, F.col("bucket")).mapInArrow(_score_buckets(words, buckets), _SENT)
     .write.parquet(f"{where}/found"))
    found = spark.read.parquet(f"{where}/found")
    # of a HIST row, block is a count and bucket says how many pairs have it
    hist = dict(found.where(F.col("kind") == HIST).groupBy("block").agg(F.sum("bucket")).collect())
    d = discounts([hist.get(r, 0) for r in range(K + 2)])
    values = (found.where(F.col("kind").isin(CONTEXT, EVENT)).repartitionById(buckets, F.col("bucket"))
              .mapInArrow(_weigh_events(d), _SENT))
    kind = docs.schema[doc_id].dataType.simpleString()
    return (found.where(F.col("kind").isin(DOCS, PART)).unionByName(values).groupBy("block").applyInPandas(
        _sum_block(d, words, "held_out"),
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))
