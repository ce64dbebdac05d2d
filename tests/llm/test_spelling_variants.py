"""Spelling variants against a plain count of all pairs, and the filters' probes."""

import random
import re
import zlib

import numpy as np
import pytest

from trackside.llm import queries as Q
from trackside.llm import spelling_variants as S


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_counts(docs, change=None, least_chars=7, least_count=2):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n = {}
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            w = change(i, run) if change else run
            if len(w) >= least_chars:
                n[w] = n.get(w, 0) + 1
    return {w: k for w, k in n.items() if k >= least_count}


def brute_groups(n, factor=10):
    out = {}
    for w, k in n.items():
        around = sorted((-n[v], v) for v in n if near(w, v))
        form = around[0][1] if around and -around[0][0] >= factor * k else None
        out[w] = [w, k, form, n[form] if form else None, len(around)]
    for row in out.values():
        root = row[0]
        while out[root][2]:
            root = out[root][2]
        row.append(root)
    return sorted(map(tuple, out.values()))


def dropped(i, run):
    h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
    return run if h % 31 else run[:h % len(run)] + run[h % len(run) + 1:]


def groups(spark, n, **how):
    df = spark.createDataFrame(sorted(n.items()), "word string, n long")
    return sorted(tuple(r) for r in S.group_variants(df, **how).select("word", "n", "form", "form_n", "n_near", "root").collect())


def vocabulary(seed, count=400, letters="abcéÿ"):
    r = random.Random(seed)
    return {"".join(r.choice(letters) for _ in range(r.choice((7, 7, 8, 9)))): int(10 ** r.uniform(0.4, 5)) for _ in range(count)}


def test_groups_match_brute_force(spark):
    n = vocabulary(1, letters="ab")
    assert groups(spark, n) == brute_groups(n)
    n = vocabulary(2)
    assert groups(spark, n) == brute_groups(n)


def test_filters_in_many_rounds(spark, monkeypatch):
    monkeypatch.setattr(S, "FILTER_BYTES", 128)
    monkeypatch.setattr(S, "SEGMENT", 1)
    monkeypatch.setattr(S, "EDITS", 40)
    n = vocabulary(3, 120)
    assert groups(spark, n) == brute_groups(n)


def test_chains_and_ties(spark):
    n = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2000, "aaabbbb": 20_000, "aabbbbb": 200_000,
         "zzzzzzz": 3, "zzzzzzy": 30, "zzzzzzx": 30, "qqqqqqq": 5, "qqqqqqqq": 49}
    got = groups(spark, n)
    assert got == brute_groups(n)
    by = {r[0]: r for r in got}
    assert by["aaaaaaa"][5] == "aabbbbb" and by["zzzzzzz"][2] == "zzzzzzx" and by["qqqqqqq"][2] is None


DOCS = [(1, "Example example EXAMPLE exampel, examplesÉtranger Étranger étranger"), (2, None), (None, "example example"), (3, ""),
        (4, "sixsix SevenSe sevense x" + "y" * 4000 + " " + "y" * 4001), (4, "sevense " + "y" * 4000 + " " + "y" * 4001),
        (5, "cafécafé×café İstanbul 1234567 a_bcdefgh \U0001f600emojiemoji emojiemoji")]


def test_words_of_odd_texts(spark):
    df = spark.createDataFrame([(i, t, 1, "w") for i, t in DOCS], "doc_id long, text string, n int, word string")
    got = {r["word"]: r["n"] for r in S.count_words(df).collect()}
    assert got == brute_counts(DOCS)
    assert groups(spark, got) == brute_groups(got)


def test_long_texts_and_small_tables_count_the_same(spark, monkeypatch):
    monkeypatch.setattr(S, "TABLE_WORDS", 3)
    r = random.Random(5)
    docs = [(i, " ".join(r.choice(("absence", "absense", "presence", "presense", "Prescience")) for _ in range(k)))
            for i, k in enumerate((0, 1, 50, 20_000))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {x["word"]: x["n"] for x in S.count_words(df).collect()} == brute_counts(docs)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.group_variants(S.count_words(df)).collect() == []


def test_query_matches_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in Q.table(spark, "/root/testdata/sf0.001", "documents").collect()]
    got = Q.op12_spelling_variants(spark, "/root/testdata/sf0.001")
    assert dict(got.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    want = brute_groups(brute_counts(docs, dropped))
    assert len(want) > 500 and any(r[2] for r in want)
    assert sorted(tuple(r) for r in got.select("word", "n", "form", "form_n", "n_near", "root").collect()) == want


@pytest.mark.parametrize("word", ["aaaaaaa", "abcabca", "zyxwvut", "ééabcÿÿx"])
def test_edits_are_those_of_the_word(word):
    alphabet = np.array(sorted({ord(c) for c in word + "mn"}), np.uint32)
    points = np.array([[ord(c) for c in word]], np.uint32)
    got = set()
    for length, h, _, i, c in S.edits(points, alphabet):
        for x, p, letter in zip(h.tolist(), i.tolist(), c.tolist()):
            made = word[:p] + (chr(letter) if letter else "") + word[p + 1:]
            assert len(made) == length and made not in got
            assert S.polynomial(np.array([[ord(y) for y in made]], np.uint32))[0] == x
            got.add(made)
    deleted = {word[:i] + word[i + 1:] for i in range(len(word))}
    replaced = {word[:i] + chr(c) + word[i + 1:] for i in range(len(word)) for c in alphabet if chr(c) > word[i]}
    assert got == deleted | replaced
