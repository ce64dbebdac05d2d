"""Katz scores against a plain model; normalisation; held-out gain; edge cases."""

import collections
import math
import random

import pytest
from pyspark.sql import functions as F

from trackside.llm import katz as K


class Plain:
    def __init__(self, training):
        self.c1, self.c2, self.cu = collections.Counter(), collections.Counter(), collections.Counter()
        for w in training:
            before = ["<s>", *w[:-1]]
            self.c1.update(w)
            self.c2.update(zip(before, w))
            self.cu.update(before)
        hist = lambda c: [0, *[sum(1 for x in c.values() if x == r) for r in range(1, K.K + 2)]]
        self.n, self.v = sum(self.c1.values()), len(self.c1)
        self.d1, self.d2 = K.discounts(hist(self.c1)), K.discounts(hist(self.c2))
        self.unknown = 1 - sum(self.cut(c, self.d1) for c in self.c1.values()) / self.n if self.n else 1.0
        after = collections.defaultdict(list)
        for (u, w), c in self.c2.items():
            after[u].append((w, c))
        self.alpha = {u: (1 - sum(self.cut(c, self.d2) for _, c in ws) / self.cu[u]) / (1 - sum(self.p1(w) for w, _ in ws))
                      for u, ws in after.items()}

    def cut(self, c, d):
        return c * d[min(c, K.K + 1)]

    def p1(self, w):
        return self.cut(self.c1[w], self.d1) / self.n if self.c1[w] else self.unknown

    def p(self, u, w):
        c = self.c2[u, w]
        return self.cut(c, self.d2) / self.cu[u] if c else self.alpha.get(u, 1.0) * self.p1(w)

    def score(self, w):
        return sum(math.log10(self.p(u, x)) for u, x in zip(["<s>", *w[:-1]], w))

    def base(self, w):
        return sum(math.log10((self.c1[x] + 1) / (self.n + self.v + 1)) for x in w)


def tokens(text):
    return [*(text or "").encode().lower().split(), "</s>"]


def corpus():
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(200)]
    some = lambda n: " ".join(vocabulary[min(int(r.expovariate(0.03)), 199)] for _ in range(n))
    rows = [(i, some(r.randint(1, 120))) for i in range(150)]
    hot = some(40)
    rows += [(200 + i, hot) for i in range(60)]   # counts above K only
    rows += [(300, None), (301, ""), (302, "unheard words only"), (303, hot + " w0 " + some(30)), (304, some(9000)),
             (303, "repeated id"), (None, "no id")]
    return [(i, t, i is None or i % 7 != 2) for i, t in rows]


@pytest.mark.parametrize("places", [K.PLACES, 700])
def test_scores_match_the_plain_model(spark, places, monkeypatch):
    data = corpus()
    df = spark.createDataFrame(data, "doc_id long, text string, t boolean").withColumn("score", F.lit("clash"))
    got = collections.Counter()
    model = Plain([tokens(t) for _, t, trains in data if trains])
    for r in K.score_documents(df.repartition(4), F.col("t"), places=places).collect():
        got[r.doc_id, not r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)] += 1
    want = collections.Counter()
    for i, t, trains in data:
        w = tokens(t)
        want[i, trains, len(w), sum(model.c1[x] > 0 for x in w), model.n, round(model.base(w), 6), round(model.score(w), 6)] += 1
    assert got == want
    for u in ("<s>", b"w0", b"w7", *[u for u, _ in list(model.c2)[-3:]]):
        total = sum(model.p(u, w) for w in model.c1) + model.alpha.get(u, 1.0) * model.unknown
        assert math.isclose(total, 1, rel_tol=1e-9)


def test_pairs_help_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = K.score_documents(docs, F.crc32(F.col("doc_id").cast("string")) % 7 != 2).where("held_out").agg(
        F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert got.s > 0.8 * got.b > 1.3 * got.s   # logs are negative: the model is clearly better


def test_no_training_texts_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [(r.n_tokens, r.train_tokens, r.base_score, r.score) for r in
            K.score_documents(df, F.lit(False)).collect()] == [(3, 0, 0.0, 0.0)]
    assert K.score_documents(df.limit(0), F.lit(True)).count() == 0


def test_discounts_fall_back():
    assert all(0 < x < 1 for x in K.discounts([0, 1000, 300, 150, 90, 60, 42])[1:])
    assert K.discounts([0] * 7)[1] == 0.5
