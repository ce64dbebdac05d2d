"""Near duplicates by one-permutation MinHash with optimal densification.

Sets.  Words are runs of characters other than space and \\t to \\r, A-Z made small;
a text's set holds its distinct shingles of five words (one of all words, where there
are fewer), as 64-bit hashes.  Two texts are linked when their sets have a
Jaccard similarity of at least ``percent`` / 100, confirmed on the full sets.

Sketch.  One hash of each shingle says both its bin and its value; a bin keeps its
smallest value, and an empty bin takes the value of the first non-empty one in an
order of its own that is the same for all texts (optimal densification).  ``BANDS``
bands of ``ROWS`` bins are the buckets a text falls into.  At similarity 0.75 two texts
share no bucket with a probability of 5e-6.  Sets of one or two shingles can be
linked to equal sets only and need no buckets.

Groups of copies.  Texts with equal sets have one digest and are one node from the
start (rows of a group are counted before the shuffle, so their number is free).

Candidates.  In each bucket the smallest node is the centre of a star; only its pairs
with the others are confirmed.  A bucket whose nodes are then in one component is
done, whatever links are left inside it.  Buckets that still hold several components
(near copies of one text that are too far from its centre, say) go into an exact second
step: nodes that such buckets connect are a group, and in each group every node outside
the group's largest component is compared with all its nodes.  These comparisons are
counted as matrix products over blocks of bounded size, one task for each pair of
blocks; no row is made for a pair, and what comes out is at most one link for each node and
component.  So no link is lost, and a group of near copies costs about as many
rows as it has members.

Defined cases: a null text, or one without words, has an empty set, is linked with
nothing and kept.  Rows with a null id belong to the group of their text but do not
name it; a group without any id has a null component_id.  Repeated rows have one
component; a document repeated with its id is kept once by ``drop_near_duplicates``.
Extra columns pass through; those named like a result are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackside.llm.common import add_columns, checkpointed, quoted
from trackside.llm.components import connected_components

SHINGLE = 5
BANDS, ROWS = 32, 4
BINS = BANDS * ROWS
PERCENT = 75
LEAST_FOR_BANDS = 3
#: Digests that are broadcast at most; more are joined by a shuffle.
BROADCAST_DIGESTS = 1_000_000
#: Text whose shingles are held at once in a task (one text at least).
SHINGLE_BYTES = 4 << 20
#: A block of nodes that are compared with another block in one task.
BLOCK_ROWS, BLOCK_SHINGLES = 2000, 1_000_000

_MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[bytes | None]) -> list[np.ndarray]:
    """For each text its sorted distinct shingle hashes."""
    numbers: dict[bytes, int] = {}
    rows = [[numbers.setdefault(w, len(numbers)) for w in t.lower().split()] if t else [] for t in texts]
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter((digest(w) for w in numbers), np.uint64, len(numbers))
    out = []
    for ids in rows:
        h = hashes[ids] if ids else np.empty(0, np.uint64)
        n = min(SHINGLE, len(h))
        if not n:
            out.append(h)
            continue
        s = np.full(len(h) - n + 1, n, np.uint64)
        for k in range(n):
            s = mixed(s * _MIX + h[k:len(h) - n + 1 + k])
        out.append(np.unique(s))
    return out


def _detours(attempts: int) -> np.ndarray:
    """For each attempt and bin, the bin to borrow from; the same for all texts."""
    n = np.arange(attempts * BINS, dtype=np.uint64).reshape(attempts, BINS)
    return (mixed(n * _MIX + np.uint64(77)) % np.uint64(BINS)).astype(np.int64)


_DETOURS = _detours(256)


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """A row of BANDS bucket keys for each (non-empty) set."""
    sizes = np.array([len(s) for s in sets])
    h = mixed(np.concatenate(sets) ^ np.uint64(0x5851F42D4C957F2D))
    row = np.repeat(np.arange(len(sets)), sizes)
    slot = row * BINS + ((h >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    flat = np.full(len(sets) * BINS, empty)
    np.minimum.at(flat, slot, h)
    bins = flat.reshape(len(sets), BINS)
    full = bins.copy()
    rows, cols = np.nonzero(bins == empty)
    attempt = 0
    while len(rows):
        # beyond the table the detours go round in steps that reach every bin
        source = _DETOURS[attempt, cols] if attempt < len(_DETOURS) else (cols + attempt) % BINS
        value = bins[rows, source]
        found = value != empty
        full[rows[found], cols[found]] = value[found]
        rows, cols = rows[~found], cols[~found]
        attempt += 1
    full = full.reshape(len(sets), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) + np.uint64(1), (len(sets), BANDS)).copy()
    for k in range(ROWS):
        key = mixed(key * _MIX + full[:, :, k])
    return key.view(np.int64)


def add_digest(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with n_shingles and digest, which equal sets share (null for the empty set)."""
    def make(texts: list) -> list[pa.Array]:
        sets = shingle_sets(texts)
        return [pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary())]

    return add_columns(docs, text, [T.StructField("n_shingles", T.LongType()),
                                    T.StructField("digest", T.BinaryType())], make, SHINGLE_BYTES)


def add_sketch(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with n_shingles, digest and bands (null for sets too small to need them)."""
    def make(texts: list) -> list[pa.Array]:
        sets = shingle_sets(texts)
        wide = [s for s in sets if len(s) >= LEAST_FOR_BANDS]
        keys = iter(band_keys(wide)) if wide else iter(())
        return [pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                pa.array([next(keys) if len(s) >= LEAST_FOR_BANDS else None for s in sets], pa.list_(pa.int64()))]

    return add_columns(docs, text, [T.StructField("n_shingles", T.LongType()),
                                    T.StructField("digest", T.BinaryType()),
                                    T.StructField("bands", T.ArrayType(T.LongType()))], make, SHINGLE_BYTES)


def _sets(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """(digest, shingles) of the wanted (distinct) digests.

    Texts are read again and only those that are wanted go on: a shuffle of all
    texts is spared as long as the list is small enough to be sent to them."""
    if wanted.count() <= BROADCAST_DIGESTS:
        wanted = F.broadcast(wanted)
    one = (add_digest(docs.select(F.col(quoted(text)).cast("binary").alias("text")), "text")
           .join(wanted, "digest", "left_semi").groupBy("digest").agg(F.first("text").alias("text")))

    def make(texts: list) -> list[pa.Array]:
        return [pa.array([s.view(np.int64) for s in shingle_sets(texts)], pa.list_(pa.int64()))]

    return add_columns(one, "text", [T.StructField("shingles", T.ArrayType(T.LongType()))], make, SHINGLE_BYTES).drop("text")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    a = sets.select(F.col("digest").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("digest").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(a, "a").join(b, "b")
            .where(100 * both >= percent * (F.size("sa") + F.size("sb") - both)).select("a", "b"))


def _pairs(met: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs of (centre, n, member, n) whose sizes allow the similarity."""
    return (met.where((100 * F.least("cn", "n") >= percent * F.greatest("cn", "n")) & (F.col("centre") != F.col("digest")))
            .select(F.least("centre", "digest").alias("a"), F.greatest("centre", "digest").alias("b")).distinct())


def link_digests(sketch: DataFrame, docs: DataFrame, text: str, percent: int = PERCENT) -> DataFrame:
    """(digest, root) of the digests that are linked to another."""
    per_digest = (sketch.where("bands IS NOT NULL").groupBy("digest")
                  .agg(F.first("n_shingles").alias("n"), F.first("bands").alias("bands")))
    member = per_digest.select(F.explode("bands").alias("key"), "digest", "n")
    star = (member.groupBy("key").agg(F.min(F.struct("digest", "n")).alias("c"), F.count("*").alias("size"))
            .where("size > 1").select("key", F.col("c.digest").alias("centre"), F.col("c.n").alias("cn")))
    # the members of buckets that hold two or more: all that later rounds need
    met = checkpointed(member.join(star, "key"))
    sets = checkpointed(_sets(docs, text, checkpointed(met.select("digest").distinct())))
    links = checkpointed(_confirmed(_pairs(met, percent), sets, percent))
    root = connected_components(links)

    named = (met.select("key", "digest", "n").join(root.withColumnRenamed("node", "digest"), "digest", "left")
             .withColumn("root", F.coalesce("root", "digest")))
    several = named.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key")
    left = checkpointed(named.join(several, "key", "left_semi"))
    if left.isEmpty():
        return root
    links = checkpointed(_links_in_groups(left, sets, percent))
    return root if links.isEmpty() else _merged(root, links)


def _links_in_groups(left: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components of the nodes that buckets connect; ``left`` has key, digest, n, root."""
    centre = left.groupBy("key").agg(F.min("digest").alias("b"))
    group = connected_components(left.join(centre, "key").select(F.col("digest").alias("a"), "b"))
    node = checkpointed(left.select("digest", "n", "root").distinct()
                        .join(group.select(F.col("node").alias("digest"), F.col("root").alias("grp")), "digest"))
    main = (node.groupBy("grp", "root").agg(F.count("*").alias("size"))
            .groupBy("grp").agg(F.max(F.struct("size", "root")).alias("m")).select("grp", F.col("m.root").alias("main")))
    node = node.join(main, "grp").withColumn("outside", F.col("root") != F.col("main"))

    def blocks(inside) -> DataFrame:
        """How many blocks of bounded rows and shingles the nodes of a group make."""
        return F.greatest(F.ceil(F.count_if(inside) / BLOCK_ROWS),
                          F.ceil(F.sum(F.when(inside, F.col("n")).otherwise(0)) / BLOCK_SHINGLES)).cast("long")

    counts = node.groupBy("grp").agg(blocks(F.col("outside")).alias("rows"), blocks(F.lit(True)).alias("cols"))
    node = node.join(counts, "grp").join(sets, "digest")
    spot = F.xxhash64("digest", F.lit(1))
    a = node.where("outside").select("grp", "digest", "root", "shingles", F.lit(True).alias("is_row"),
                                     F.pmod(spot, F.col("rows")).alias("i"),
                                     F.explode(F.sequence(F.lit(0).cast("long"), F.col("cols") - 1)).alias("j"))
    b = node.select("grp", "digest", "root", "shingles", F.lit(False).alias("is_row"),
                    F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)).alias("i"),
                    F.pmod(spot, F.col("cols")).alias("j"))
    return (a.select(*b.columns).unionByName(b).groupBy("grp", "i", "j")
            .applyInPandas(lambda pdf: _block_links(pdf, percent), "a binary, b binary"))


def _block_links(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links between the rows and the columns of a pair of blocks, one for each row and component."""
    rows, cols = pdf[pdf["is_row"]], pdf[~pdf["is_row"]]
    if not len(rows) or not len(cols):
        return pd.DataFrame({"a": [], "b": []})
    both = common_counts(list(rows["shingles"]), list(cols["shingles"]))
    n_rows, n_cols = rows["shingles"].map(len).to_numpy(), cols["shingles"].map(len).to_numpy()
    root_of = {r: k for k, r in enumerate(pd.unique(pdf["root"]))}
    row_root, col_root = rows["root"].map(root_of).to_numpy(), cols["root"].map(root_of).to_numpy()
    r, c = np.nonzero((100 * both >= percent * (n_rows[:, None] + n_cols[None, :] - both))
                      & (row_root[:, None] != col_root[None, :]))
    _, first = np.unique(r * len(root_of) + col_root[c], return_index=True)
    return pd.DataFrame({"a": rows["digest"].to_numpy()[r[first]], "b": cols["digest"].to_numpy()[c[first]]})


def common_counts(rows: list[np.ndarray], cols: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of ``rows`` shares with each of ``cols``.

    Elements that are common on both sides are counted as a product of 0/1 matrices,
    some thousand at a time, the others one pair of places after another."""
    def postings(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])

    (rv, ri), (cv, ci) = postings(rows), postings(cols)
    shared = np.intersect1d(rv, cv)
    out = np.zeros((len(rows), len(cols)), np.float32)
    if not len(shared):
        return out.astype(np.int64)
    keep_r, keep_c = np.isin(rv, shared), np.isin(cv, shared)
    rk, ri = np.searchsorted(shared, rv[keep_r]), ri[keep_r]
    ck, ci = np.searchsorted(shared, cv[keep_c]), ci[keep_c]
    pairs = np.bincount(rk, minlength=len(shared)) * np.bincount(ck, minlength=len(shared))
    dense = pairs * 64 >= out.size
    place = np.cumsum(dense) - 1
    width = 2048
    for start in range(0, int(dense.sum()), width):
        def matrix(k: np.ndarray, i: np.ndarray, n: int) -> np.ndarray:
            m = np.zeros((n, width), np.float32)
            here = dense[k] & (place[k] >= start) & (place[k] < start + width)
            m[i[here], place[k[here]] - start] = 1
            return m

        out += matrix(rk, ri, len(rows)) @ matrix(ck, ci, len(cols)).T
    few_r, few_c = ~dense[rk], ~dense[ck]
    rk, ri, ck, ci = rk[few_r], ri[few_r], ck[few_c], ci[few_c]
    order = np.argsort(ck, kind="stable")
    ck, ci = ck[order], ci[order]
    low, n = np.searchsorted(ck, rk, "left"), np.searchsorted(ck, rk, "right")
    n = n - low
    step = 4_000_000
    cut = np.concatenate(([0], np.flatnonzero(np.diff(np.cumsum(n) // step)) + 1, [len(n)]))
    for a, b in zip(cut, cut[1:]):
        m = n[a:b]
        col = np.repeat(low[a:b] - np.cumsum(m) + m, m) + np.arange(m.sum())
        np.add.at(out, (np.repeat(ri[a:b], m), ci[col]), 1)
    return out.astype(np.int64)


def _merged(root: DataFrame, links: DataFrame) -> DataFrame:
    """The components after further links: those between roots decide."""
    def of(side: str) -> DataFrame:
        return root.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root"))

    ends = (links.join(of("a"), "a", "left").join(of("b"), "b", "left")
            .select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b")))
    over = connected_components(ends).withColumnRenamed("root", "over").withColumnRenamed("node", "root")
    moved = root.join(over, "root", "left").select("node", F.coalesce("over", "root").alias("root"))
    new = over.select(F.col("root").alias("node"), F.col("over").alias("root"))
    return moved.unionByName(new.join(root.select("node"), "node", "left_anti"))


def components(sketch: DataFrame, docs: DataFrame, text: str, doc_id: str, percent: int = PERCENT) -> DataFrame:
    """(digest, root, component_id, keeper): for every digest its component, the smallest
    doc_id in it, and whether this digest's smallest id is that one (one digest of each)."""
    nodes = sketch.where("digest IS NOT NULL").groupBy("digest").agg(F.min(quoted(doc_id)).alias("id"))
    root = link_digests(sketch, docs, text, percent)
    named = checkpointed(nodes.join(root.withColumnRenamed("node", "digest"), "digest", "left")
                         .withColumn("root", F.coalesce("root", "digest")))
    best = named.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "digest")).alias("best"))
    return named.join(best, "root").select("digest", "root", F.col("best.id").alias("component_id"),
                                           (F.col("best.digest") == F.col("digest")).alias("keeper"))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    sketch = checkpointed(add_sketch(docs.select(F.col(quoted(doc_id)).alias("doc_id"), F.col(quoted(text)).alias("text")),
                                     "text").drop("text"))
    found = components(sketch, docs, text, "doc_id", percent).select("digest", "component_id")
    rows = sketch.select("doc_id", "n_shingles", "digest")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return (rows.join(found, "digest", "left")
            .select("doc_id", "n_shingles", component.alias("component_id"),
                    F.col("doc_id").eqNullSafe(component).alias("kept")))


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group, that with the smallest id; columns as they were.

    Rows are known by 128 bits of hashes of id and text, so that their shingles need not be made once more."""
    id_, body = F.col(quoted(doc_id)), F.col(quoted(text))
    same = [F.xxhash64(id_, body).alias("h1"), F.xxhash64(F.lit(1), body, id_).alias("h2")]
    sketch = checkpointed(add_sketch(docs.select(id_.alias("doc_id"), body.alias("text"), *same), "text").drop("text"))
    keepers = (components(sketch, docs, text, "doc_id", percent).where("keeper")
               .select(F.col("digest").alias("kd"), F.col("component_id").alias("kid")))
    # of texts with one set and one id (they differ in case or spaces, say) one stays
    kept = (sketch.where("digest IS NOT NULL")
            .join(keepers, (F.col("digest") == F.col("kd")) & F.col("doc_id").eqNullSafe(F.col("kid")))
            .groupBy("digest").agg(F.min(F.struct("h1", "h2")).alias("h")).select("h.*"))
    row = docs.select(F.struct(*map(quoted, docs.columns)).alias("row"), *same,
                      F.coalesce(body.rlike(r"[^\x09-\x0D\x20]"), F.lit(False)).alias("has_words"))
    with_words = row.where("has_words").groupBy("h1", "h2").agg(F.first("row").alias("row")).join(kept, ["h1", "h2"], "left_semi")
    return with_words.select("row.*").unionByName(row.where("NOT has_words").select("row.*"))
