"""Decontamination against brute force over random texts; edge cases."""

import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from trackside.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string"


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, items, window=10):
    """Words, words hit, and the items (by place in the list) with an occurring window."""
    w = words(text)
    hit, found = set(), set()
    for k, item in enumerate(items):
        iw = words(item)
        n = min(window, len(iw))
        wins = {tuple(iw[i:i + n]) for i in range(len(iw) - n + 1)} if n else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i:i + n]) in wins:
                hit |= set(range(i, i + n))
                found.add(k)
    return len(w), len(hit), found


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 5), st.lists(st.lists(st.integers(0, 4), max_size=25), max_size=4),
       st.lists(st.lists(st.integers(0, 5), max_size=60), min_size=1, max_size=5))
def test_search_matches_brute_force(window, items, docs):
    item_texts = [" ".join(f"w{x}" for x in i) for i in items]
    doc_texts = [" ".join(f"W{x}" for x in d) for d in docs]
    sizes, n_hit, longest = D.Items([t.encode() for t in item_texts], window).search([t.encode() for t in doc_texts])
    for k, t in enumerate(doc_texts):
        n, hit, found = plain(t, item_texts, window)
        assert (sizes[k], n_hit[k], {m[0] for m in longest[k]}) == (n, hit, found)
        w, covered = words(t), set()
        for item, at, from_, size in longest[k]:
            iw = words(item_texts[item])
            assert w[at:at + size] == iw[from_:from_ + size]
            covered |= set(range(at, at + size))
            # longest: neither end can be moved (an item shorter than a window stands for itself)
            if len(iw) >= window:
                assert at == 0 or from_ == 0 or w[at - 1] != iw[from_ - 1]
                assert at + size == len(w) or from_ + size == len(iw) or w[at + size] != iw[from_ + size]
        assert len(covered) == hit


def test_blocks_edge_cases_and_columns(spark):
    r = random.Random(2)
    vocabulary = [f"word{i}é" for i in range(40)]
    some = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    bench = [(i, some(r.randint(1, 40))) for i in range(12)] + [(3, some(15)), (20, None), (21, ""), (None, some(14))]
    docs = [(1, None), (2, ""), (3, "!!"), (4, some(3000)), (5, some(30) + " " + bench[4][1].upper().replace("É", "é") + " " + some(9)),
            (5, bench[12][1]), (6, bench[15][1]), (7, "word1é"), (8, some(5000))]
    b = spark.createDataFrame(bench, "item_id long, text string")
    d = spark.createDataFrame([(*x, "keep", 7) for x in docs], "doc_id long, text string, n_hit string, extra int")
    one = D.find_contamination(d, b).collect()
    many = D.find_contamination(d, b, block_chars=300)
    assert many.columns == ["doc_id", "text", "extra", "n_words", "n_hit", "items", "matches"]
    as_rows = lambda x: sorted((r.doc_id, r.text or "", r.n_words, r.n_hit, tuple(r.items),
                                tuple(sorted(map(str, r.matches)))) for r in x)
    assert as_rows(one) == as_rows(many.collect())
    for row in one:
        n, hit, found = plain(row.text, [t for _, t in bench])
        assert (row.n_words, row.n_hit) == (n, hit)
        assert row.items == sorted({str(bench[k][0]).replace("None", "null") for k in found})
    left = D.decontaminate(d, b)
    assert left.columns == d.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(r.doc_id for r in one if not r.n_hit)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c")], SCHEMA)
    b = spark.createDataFrame([], "item_id long, text string")
    assert [(r.n_words, r.n_hit, r.items, r.matches) for r in D.find_contamination(d, b).collect()] == [(3, 0, [], [])]
    assert D.find_contamination(d.limit(0), b).count() == 0


def test_ids_of_other_types(spark):
    text = "one two three four five six seven eight nine ten eleven"
    d = spark.createDataFrame([(1, text), (1, text), (2, "none")], SCHEMA)
    for kind in ("smallint", "decimal(5,1)", "date", "string"):
        b = spark.createDataFrame([("2024-01-02" if kind == "date" else "7", text), (None, "a " + text)], "item_id string, text string").selectExpr(
            f"cast(item_id as {kind}) as item_id", "text")
        for chars in (8_000_000, 60):
            rows = D.find_contamination(d, b, block_chars=chars).collect()
            want = b.selectExpr("item_id", "cast(item_id as string) as s").where("s IS NOT NULL").first()
            for r in rows:
                assert r.items == ([want.s, "null"] if r.doc_id == 1 else []) and r.n_hit == (11 if r.doc_id == 1 else 0)
                assert {m.item_id for m in r.matches} == ({want.item_id, None} if r.doc_id == 1 else set())
