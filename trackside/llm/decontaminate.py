"""Benchmark decontamination with suffix arrays over the training texts.

Training texts are cut into shards (some rows of one task, bounded in bytes).
Each shard's words become one sequence, and its suffixes are sorted by their
first ``window`` words.  Every suffix of every benchmark item is looked up in
every shard by binary search; the range it hits holds all places where these
words stand verbatim.  Places of one item that follow each other on a diagonal
(next word of the item at the next word of the text) are joined, which gives the
longest verbatim matches and where they lie.  A suffix enters the array only if
its first two words stand in the benchmark side by side (its first, for items of
one word): no other suffix can be the answer to any search.

A row's text lies in one shard whole, so nothing is shuffled, and identity and
order of the rows play no part.  The benchmark goes to the tasks in blocks of at
most about ``block_chars`` characters, whose texts are sent and indexed by each worker, one pass over the
texts for each block.  A block's matches are kept in the checkpoint folder, by a hash of the text, and its
broadcast is destroyed before the next block is read; so driver and tasks hold one block at a time,
however large the benchmark is.  A benchmark of one block needs no such table.

Words: A-Z made small; letters, digits and non-ASCII characters.  A window is
``window`` consecutive words of an item; an item with fewer, but not none, is one
window.

Defined cases: a null text, or one without words, has no words and no match; so
has an item.  A null item_id is listed as null and is an item like others; rows
that repeat an item_id are one item.  Ids may be of any type that text can be cast back to.  Empty tables give no match.  Extra columns
pass through; those named like a result are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackside.llm.common import add_columns, byte_words, checkpointed, quoted

WINDOW = 10
MATCH = T.StructType([T.StructField("item_id", T.StringType()),
                      T.StructField("doc_word", T.LongType()),
                      T.StructField("item_word", T.LongType()),
                      T.StructField("n_words", T.LongType())])
ARROW_MATCH = pa.list_(pa.struct([("item_id", pa.string()), ("doc_word", pa.int64()), ("item_word", pa.int64()), ("n_words", pa.int64())]))


class Items:
    """A block of benchmark items, ready for searches: words as numbers from 1,
    the distinct windows as sorted keys, and where each window stands."""

    def __init__(self, texts: list[bytes | None], window: int):
        self.window = window
        self.numbers: dict[bytes, int] = {}
        keys: dict[bytes, list[tuple[int, int]]] = {}
        pairs, firsts, alone = set(), set(), set()
        for item, text in enumerate(texts):
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in byte_words(text)]
            if not ids:
                continue
            for at in range(max(1, len(ids) - window + 1)):
                part = ids[at:at + window]
                keys.setdefault(np.array(part, ">u4").tobytes(), []).append((item, at))
                firsts.add(part[0])
                if len(part) > 1:
                    pairs.add(part[0] << 32 | part[1])
                else:
                    alone.add(part[0])
        self.keys = list(keys)
        self.places = list(keys.values())
        self.pairs = np.array(sorted(pairs), np.int64)
        self.is_first = np.zeros(len(self.numbers) + 1, bool)
        self.is_first[list(firsts)] = True
        self.is_alone = np.zeros(len(self.numbers) + 1, bool)
        self.is_alone[list(alone)] = True
        width = 4 * window
        # a short window's range runs from its words to its words and the largest numbers
        self.low = np.array([k.ljust(width, b"\0") for k in self.keys], f"V{width}")
        self.high = np.array([k.ljust(width, b"\xff") for k in self.keys], f"V{width}")
        self.sizes = np.array([len(k) // 4 for k in self.keys], np.int64)

    def occurrences(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the shard's words and the number of the window at each.

        ``ids`` has 0 for words outside the block and between texts."""
        none = np.empty(0, np.int64)
        if not self.keys or not len(ids):
            return none, none
        start = np.flatnonzero(self.is_first[ids])
        nxt = np.append(ids, 0)[start + 1]
        pair = ids[start].astype(np.int64) << 32 | nxt
        start = start[np.isin(pair, self.pairs) | self.is_alone[ids[start]]]
        if not len(start):
            return none, none
        padded = np.append(ids, np.zeros(self.window, ids.dtype)).astype(">u4")
        heads = np.lib.stride_tricks.sliding_window_view(padded, self.window)[start]
        # the suffix array: starts in the order of what follows; equal heads get one rank
        heads = np.ascontiguousarray(heads).view(f"S{4 * self.window}").ravel()
        order = np.argsort(heads, kind="stable")
        suffixes, heads = start[order], heads[order]
        low = np.searchsorted(heads, self.low.view(f"S{4 * self.window}"), "left")
        high = np.searchsorted(heads, self.high.view(f"S{4 * self.window}"), "right")
        found = np.maximum(high - low, 0)
        window = np.repeat(np.arange(len(found)), found)
        first = np.repeat(low - np.concatenate(([0], np.cumsum(found)[:-1])), found)
        return suffixes[first + np.arange(len(window))], window

    def search(self, texts: list[bytes | None]):
        """For each text: words, words hit, longest matches (item, text word, item word, words)."""
        words = [byte_words(t) for t in texts]
        sizes = np.array([len(w) for w in words], np.int64)
        begin = np.concatenate(([0], np.cumsum(sizes + 1)))
        ids = np.zeros(begin[-1], np.uint32)
        number = self.numbers.get
        for w, b in zip(words, begin):
            ids[b:b + len(w)] = [number(x, 0) for x in w]
        places, window = self.occurrences(ids)
        edge = np.zeros(len(ids) + 1, np.int64)
        np.add.at(edge, places, 1)
        np.add.at(edge, places + self.sizes[window] if len(window) else places, -1)
        hit = np.concatenate(([0], np.cumsum(np.cumsum(edge[:-1]) > 0)))
        n_hit = hit[begin[1:]] - hit[begin[:-1]]
        return sizes, n_hit, self._longest(places, window, begin)

    def _longest(self, places: np.ndarray, window: np.ndarray, begin: np.ndarray) -> list[list[tuple]]:
        rows: list[list[tuple]] = [[] for _ in range(len(begin) - 1)]
        if not len(places):
            return rows
        count = np.array([len(self.places[w]) for w in window])
        spot = [p for w in window for p in self.places[w]]
        item, at = np.array(spot, np.int64).T
        place, size = np.repeat(places, count), np.repeat(self.sizes[window], count)
        order = np.lexsort((place, place - at, item))
        item, at, place, size = item[order], at[order], place[order], size[order]
        new = np.ones(len(item), bool)
        new[1:] = (np.diff(item) != 0) | (np.diff(place - at) != 0) | (np.diff(place) != 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(item)) - 1
        doc = np.searchsorted(begin, place[first], "right") - 1
        for d, i, p, a, n in zip(doc.tolist(), item[first].tolist(), (place[first] - begin[doc]).tolist(),
                                 at[first].tolist(), (place[last] + size[last] - place[first]).tolist()):
            rows[d].append((i, p, a, n))
        return rows




def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW,
                       block_chars: int = 8_000_000) -> DataFrame:
    """``docs`` with n_words, n_hit (words inside any occurrence of a window), items
    (distinct item_ids with occurring windows, sorted as strings) and matches (the
    longest verbatim ones: item_id, doc_word, item_word, n_words), in text order."""
    id_type = benchmark.schema["item_id"].dataType.simpleString()
    bench = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    chars = bench.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    body = F.col(quoted(text))
    key = [F.xxhash64(body).alias(_KEY[0]), F.xxhash64(F.lit(1), body).alias(_KEY[1])]
    # all blocks but the last: the matches of each text that has any, by 128 bits of its hash
    stored = []
    for block in range(blocks - 1):
        sent, found = _searched(docs.select(*key, body.alias("text")), _block(bench, blocks, block), "text", window)
        stored.append(checkpointed(found.where(F.size("matches") > 0).groupBy(*_KEY).agg(F.first("matches").alias("matches"))))
        sent.destroy()
    if not stored:
        _, found = _searched(docs, _block(bench, 1, 0), text, window)
    else:
        _, found = _searched(docs.select("*", *key), _block(bench, blocks, blocks - 1), text, window)
        others_ = stored[0]
        for more in stored[1:]:
            others_ = others_.unionByName(more)
        # one list a block and text
        others_ = others_.groupBy(*_KEY).agg(F.flatten(F.collect_list("matches")).alias(_EARLIER))
        both = F.concat(F.coalesce(_EARLIER, F.array().cast(others_.schema[_EARLIER].dataType)), F.col("matches"))
        found = (found.join(others_, list(_KEY), "left").withColumn("matches", F.array_sort(both, _by_place))
                 .withColumn("n_hit", _union_size("matches")).drop(*_KEY, _EARLIER))
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: F.coalesce(m["item_id"], F.lit("null")))))
    typed = F.transform("matches", lambda m: F.struct(m["item_id"].cast(id_type).alias("item_id"), *[m[f.name] for f in MATCH.fields[1:]]))
    return found.withColumn("items", items).withColumn("matches", typed).select(
        *[c for c in found.columns if c not in ("matches", "items")], "items", "matches")


_KEY, _EARLIER = ("__text_hash", "__text_hash_2"), "__earlier_blocks"
#: The index of the block that this worker searched last, by the number of its broadcast.
_INDEX: dict[int, Items] = {}


def _block(bench: DataFrame, blocks: int, block: int) -> list[tuple]:
    """The items of a block: some ``block_chars`` characters."""
    rows = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
    return [(r.item_id, r.text.encode() if r.text else None) for r in rows]


def _searched(docs: DataFrame, block: list[tuple], text: str, window: int) -> tuple[Broadcast, DataFrame]:
    """``docs`` with n_words, n_hit and matches of one block, whose texts are sent; each worker indexes them itself."""
    sent = docs.sparkSession.sparkContext.broadcast(block)
    number = sent._jbroadcast.id()

    def make(texts: list) -> list[pa.Array]:
        ids = [i for i, _ in sent.value]
        if number not in _INDEX:
            _INDEX.clear()
            _INDEX[number] = Items([t for _, t in sent.value], window)
        sizes, n_hit, longest = _INDEX[number].search(texts)
        return [pa.array(sizes), pa.array(n_hit),
                pa.array([[{"item_id": ids[i], "doc_word": p, "item_word": a, "n_words": n}
                           for i, p, a, n in sorted(m, key=lambda x: x[1])] for m in longest], ARROW_MATCH)]

    return sent, add_columns(docs, text, [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
                                          T.StructField("matches", T.ArrayType(MATCH))], make)


def _by_place(a, b):
    return F.when(a["doc_word"] < b["doc_word"], -1).when(a["doc_word"] > b["doc_word"], 1).otherwise(0)


def _union_size(matches: str):
    """Words covered by matches that are sorted by place."""
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("total"))

    def add(s, m):
        stop = m["doc_word"] + m["n_words"]
        return F.struct(F.greatest(s["end"], stop).alias("end"),
                        (s["total"] + F.greatest(F.lit(0).cast("long"), stop - F.greatest(m["doc_word"], s["end"]))
                         ).alias("total"))

    return F.aggregate(matches, start, add, lambda s: s["total"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any occurrence of a benchmark window, columns as they were."""
    kept = docs.select(F.struct(*map(quoted, docs.columns)).alias("row"), F.col(quoted(text)).alias("text"))
    return find_contamination(kept, benchmark, "text", window).where("n_hit = 0").select("row.*")
