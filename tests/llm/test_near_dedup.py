"""Near duplicates against brute force; stars that need several rounds; edge cases."""

import itertools
import random

import numpy as np
import pytest

from trackside.llm import near_dedup as N
from trackside.llm.components import connected_components


def sets_of(texts):
    out = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        n = min(5, len(w))
        out[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set()
    return out


def plain(texts, percent=75):
    sets, up = sets_of(texts), {}
    find = lambda x: x if up.setdefault(x, x) == x else find(up[x])
    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            up[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def corpus():
    r = random.Random(8)
    vocabulary = [f"w{i}" for i in range(3000)]
    some = lambda n: [r.choice(vocabulary) for _ in range(n)]
    out = []
    for size in (12, 40, 150, 600):
        base = some(size)
        for k in range(25):   # copies that drift further from the first: chains of links
            w = list(base)
            for _ in range(k * size // 300 + k % 3):
                w[r.randrange(size)] = r.choice(vocabulary)
            out.append(" ".join(w))
    drift = some(200)
    for _ in range(25):       # each near only to its neighbours in time
        for _ in range(4):
            drift[r.randrange(200)] = r.choice(vocabulary)
        out.append(" ".join(drift))
    out += [" ".join(some(100))] * 30 + ["One two three", "one TWO\tthree", "a b c d", "a b c d e f g", "a b c d e f g h", "a b c d e f",
                                        None, None, "", " \n", "x", "x", "  X ", "b " * 500, "b " * 700]
    out += [" ".join(some(r.randint(5, 60))) for _ in range(60)]
    r.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("sent", [N.BROADCAST_DIGESTS, 0])
def test_matches_brute_force(spark, sent, monkeypatch):
    monkeypatch.setattr(N, "BROADCAST_DIGESTS", sent)
    data = corpus()
    want = plain(data)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in N.near_duplicates(df).collect()}
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


@pytest.mark.parametrize("rows", [N.BLOCK_ROWS, 7])
def test_groups_find_links_that_the_first_centre_misses(spark, monkeypatch, rows):
    """One bucket for all texts: everything rests on the second step, in one block or many."""
    monkeypatch.setattr(N, "BLOCK_ROWS", rows)
    monkeypatch.setattr(N, "add_sketch", lambda docs, text: _one_bucket(docs, text))
    r = random.Random(9)
    drift = [f"w{r.randrange(5000)}" for _ in range(60)]
    data = []
    for i in range(40):
        drift[r.randrange(60)] = f"v{i}"
        data.append((i, " ".join(drift)))
    data += [(100 + i, " ".join(f"u{i}_{k}" for k in range(20))) for i in range(5)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_duplicates(df).collect()}
    assert got == plain(data)


_real = N.add_sketch


def _one_bucket(docs, text):
    from pyspark.sql import functions as F
    return _real(docs, text).withColumn("bands", F.array(F.lit(1).cast("long")))


def test_common_counts():
    r = np.random.default_rng(4)
    for size in (3, 40, 400):
        rows = [np.unique(r.integers(0, size * 4, size)) for _ in range(30)] + [np.empty(0, int)]
        cols = [np.unique(np.concatenate([rows[k % 30][:size // 2], r.integers(0, size * 9, size)])) for k in range(50)]
        got = N.common_counts(rows, cols)
        assert (got == [[len(set(a) & set(b)) for b in cols] for a in rows]).all()


def test_bucket_probability_and_densification():
    r = np.random.default_rng(1)
    missed = 0
    for _ in range(60):
        n = int(r.integers(8, 400))
        common = r.integers(1, 2**63, n, dtype=np.uint64)
        extra = max(1, n // 8)
        a = np.unique(np.concatenate([common, r.integers(1, 2**63, extra, dtype=np.uint64)]))
        b = np.unique(np.concatenate([common, r.integers(1, 2**63, extra, dtype=np.uint64)]))
        keys = N.band_keys([a, b])
        missed += not (keys[0] == keys[1]).any()
    assert missed == 0
    one = np.array([5], np.uint64)
    assert (N.band_keys([one, one])[0] == N.band_keys([one])[0]).all()


def test_clashing_columns_null_ids_and_repeated_rows(spark):
    text = "the same words stand here twice or more often"
    data = [(1, text, "a"), (1, text, "a"), (2, text.upper(), "b"), (None, text, "c"), (None, "alone in the world it stands", "d"),
            (None, "alone in the world it stands", "d"), (5, None, "e"), (5, None, "e"), (6, "", "f")]
    df = spark.createDataFrame(data, "doc_id long, text string, digest string").withColumnRenamed("digest", "bands")
    got = sorted(map(str, [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in N.near_duplicates(df).collect()]))
    assert got == sorted(map(str, [(1, 5, 1, True)] * 2 + [(2, 5, 1, False), (None, 5, 1, False)] + [(None, 2, None, True)] * 2
                             + [(5, 0, 5, True)] * 2 + [(6, 0, 6, True)]))
    left = N.drop_near_duplicates(df)
    assert left.columns == df.columns
    assert sorted(map(str, [tuple(r) for r in left.collect()])) == sorted(map(str, [
        data[0], data[4], data[6], data[7], data[8]]))
    assert N.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("n,edges", [
    (30, [(i, i + 1) for i in range(29)]), (40, [(0, i) for i in range(1, 40)]),
    (50, [(i, (i * 7 + 3) % 50) for i in range(50)]), (3, [])])
def test_components(spark, n, edges):
    up = list(range(n))
    find = lambda x: x if up[x] == x else find(up[x])
    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        up[y] = x
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for e in edges for x in e if e[0] != e[1] or any(x in f for f in edges if f[0] != f[1])}
