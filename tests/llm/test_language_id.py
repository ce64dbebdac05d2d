"""Language profiles: a plain twin of the vectors, held-out accuracy, odd rows."""

import random
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackside.llm import language_id as L
from trackside.llm import queries as Q

DIMS = 128


def letters(text):
    """Small letters, parted by one space."""
    kept = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in (text or "").lower())
    return f" {' '.join(kept.split())} "


def plain_vector(text, dims=DIMS):
    s = letters(text)
    sign = {c: [1 - 2 * int(b) for b in L.letter_bits(np.array([ord(c)]), dims)[0]] for c in set(s)}
    out = [0] * dims
    for a, b, c in zip(s, s[1:], s[2:]):
        for d in range(dims):
            out[d] += sign[a][(d - 2) % dims] * sign[b][(d - 1) % dims] * sign[c][d]
    return out


def cosine(a, b):
    return sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) * sum(y * y for y in b)) ** 0.5


TEXTS = ["The cat sat on the mat.", "a", "ÀÉÎ  öü\n\tß", "x1y2z3", "mot à mot", "नमस्ते दुनिया", "日本語のテキスト", "İI"]
ODD = [None, "", "123 !?", " \n"]


def test_vectors_are_those_of_the_plain_twin():
    texts = [t.encode() for t in TEXTS]
    row, code = L.triples([None, *texts, b"12"], L.Letters())
    made = L.bundles(row - 1, code, len(texts), DIMS)
    for k, t in enumerate(TEXTS):
        assert made[k].tolist() == plain_vector(t), t


@pytest.mark.parametrize("grams, cells", [(3, 4), (7, 1), (8192, 10)])
def test_vectors_in_small_steps(monkeypatch, grams, cells):
    row, code = L.triples([t.encode() for t in TEXTS], L.Letters())
    want = L.bundles(row, code, len(TEXTS), DIMS)
    monkeypatch.setattr(L, "GRAMS", grams)
    monkeypatch.setattr(L, "CELLS", cells)
    assert (L.bundles(row, code, len(TEXTS), DIMS) == want).all()


def corpus(count, seed, langs=("aa", "bb", "cc")):
    r = random.Random(seed)
    parts = {x: [r.choice("bcdfgh") + r.choice("aeiouäé") + r.choice(("", "r", "n")) for _ in range(8)] for x in langs}
    return [(i, " ".join("".join(r.choice(parts[x]) for _ in range(3)) for _ in range(r.randint(1, 40))), x)
            for i in range(count) for x in [r.choice(langs)]]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "kept", "replaced", 0.5) for r in rows],
                                 "doc_id long, text string, lang string, vector string, Lang_Pred string, Score double")


def expected(rows):
    sums = {}
    for i, t, x in rows:
        if i % 2 and x is not None and letters(t).strip():
            sums[x] = [a + b for a, b in zip(sums.get(x, [0] * DIMS), plain_vector(t))]
    out = []
    for i, t, x in rows:
        if not letters(t).strip() or not sums:
            out.append((i, "und", 0.0))
            continue
        v = plain_vector(t)
        best = max(sorted(sums), key=lambda x: round(cosine(v, sums[x]), 12))
        out.append((i, best, max(0.0, cosine(v, sums[best]))))
    return out


def found(spark, rows):
    df = frame(spark, rows)
    got = L.predict(df, L.learn(df, F.col("doc_id") % 2 == 1, DIMS), DIMS)
    assert sorted(got.columns) == ["doc_id", "lang", "lang_pred", "score", "text", "vector"]
    return got


def agree(got, want):
    got = sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in got.collect())
    want = sorted(want)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want])


def test_predictions_match_the_plain_twin(spark):
    rows = corpus(60, 1) + [(100 + k, t, "dd") for k, t in enumerate(ODD + TEXTS)] + [(201, "zzz zzz", None), (203, "abc", "")] * 2
    agree(found(spark, rows), expected(rows))


def test_prototypes_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(L, "PROTOTYPE_BYTES", 8 * DIMS)
    rows = corpus(40, 2, ("aa", "bb", "cc", "dd", "ee"))
    agree(found(spark, rows), expected(rows))


def test_nothing_learned_and_no_rows(spark):
    rows = [(2, "some words", "aa"), (4, None, "aa"), (7, "12", "aa"), (9, "words", None)]
    agree(found(spark, rows), [(i, "und", 0.0) for i, _, _ in rows])
    assert found(spark, []).collect() == []


def test_very_long_texts(spark):
    r = random.Random(3)
    text = " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(200_000))
    rows = [(1, text, "aa"), (3, "kk ll mm " * 9, "bb"), (2, text[::-1], None), (4, "mm ll kk", None)]
    got = {x["doc_id"]: x for x in found(spark, rows).collect()}
    assert got[1]["score"] == pytest.approx(1) and got[4]["lang_pred"] == "bb"


def test_held_out_documents_of_the_query(spark):
    docs = Q.table(spark, "/root/testdata/sf0.01", "documents")
    got = Q.op13_language_id(spark, "/root/testdata/sf0.01")
    assert dict(got.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count() and all(0 <= x["score"] <= 1 for x in rows)
    held = [x for x in rows if x["held_out"]]
    assert len(held) > 100 and sum(x["lang"] == x["lang_pred"] for x in held) >= 0.98 * len(held)


def test_language_and_id_are_no_inputs_of_a_prediction(spark):
    rows = corpus(30, 4)
    profiles = L.learn(frame(spark, rows), F.lit(True), DIMS)
    plain = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in L.predict(frame(spark, rows), profiles, DIMS).collect()}
    other = {-r["doc_id"]: (r["lang_pred"], r["score"])
             for r in L.predict(frame(spark, [(-i, t, "cc") for i, t, _ in rows]), profiles, DIMS).collect()}
    assert plain == other
