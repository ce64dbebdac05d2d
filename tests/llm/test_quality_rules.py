"""Quality rules: counts and the fitted model against plain Python; edge cases; labels."""

import math
import random
import re

from pyspark.sql import functions as F

from trackside.llm import quality_rules as Q

GOOD = "The river ran past the old mill and the children watched the boats go by. "


def texts():
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdeimnorst") for _ in range(r.randint(2, 8)))
    sentence = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    out = [None, "", " \n\t ", "one", "a b c d e", "x " * 30, GOOD, "Only nine words stand here in this short text"]
    out += ["\n".join(sentence(r.randint(8, 15)) for _ in range(r.randint(3, 9))) for _ in range(60)]
    out += [" ".join(word() + r.choice(["###", "$$$", "&&&"]) for _ in range(60)) for _ in range(8)]
    line = sentence(9)
    out += ["\n".join([sentence(7)] + [line] * 6 + [sentence(12)]) for _ in range(4)]
    out += ["a b c d e f a b c d e g h", "w1 w2 w3 w4 w5 w6 \x0b w1 w2", "long " + "z" * 100_000,
            " ".join(word() for _ in range(6000))]
    return out


def plain_counts(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    hit = set()
    for i, g in enumerate(grams):
        if grams.count(g) > 1 if len(grams) < 500 else False:
            hit |= set(range(i, i + 5))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


def test_counts_and_verdicts_match_plain_python(spark):
    data = texts()
    df = spark.createDataFrame(list(enumerate(data)), "doc_id long, text string")
    got = {r.doc_id: r for r in Q.quality_rules(df).collect()}
    assert len(got) == len(data)
    for i, t in enumerate(data):
        r = got[i]
        want = plain_counts(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, t
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert r.kept == (not r.base_failed and r.p_good >= 0.5)
    junk = [i for i, t in enumerate(data) if t and "###" in t]
    clean = range(8, 68)
    assert junk and not any(got[i].kept for i in junk)
    assert all(got[i].kept for i in clean)


def plain_fit(patterns, iterations=30):
    k = len(Q.RULES)
    good, model = Q.START_GOOD, [Q.START_RULE] * k

    def posterior(v):
        odds = math.log(good / (1 - good))
        for x, (h, lo, bh, bl) in zip(v, model):
            odds += math.log(h / bh if x == 1 else lo / bl if x == -1 else (1 - h - lo) / (1 - bh - bl))
        return 1 / (1 + math.exp(-odds))

    for _ in range(iterations):
        q = {v: posterior(v) for v in patterns}
        g = sum(n * q[v] for v, n in patterns.items())
        b = sum(n * (1 - q[v]) for v, n in patterns.items())
        new = []
        for j in range(k):
            share = lambda vote, of, total: (sum(n * of(q[v]) for v, n in patterns.items() if v[j] == vote) + 1) / (total + 3)
            h, lo = share(1, lambda x: x, g), share(-1, lambda x: x, g)
            bh, bl = share(1, lambda x: 1 - x, b), share(-1, lambda x: 1 - x, b)
            new.append((h, min(lo, bl), min(h, bh), bl))
        good, model = (g + 1) / (g + b + 2), new
    return {v: posterior(v) for v in patterns}


def test_expectation_maximisation_matches_plain_python(spark):
    r = random.Random(1)
    patterns = {}
    for _ in range(40):
        patterns[tuple(r.choice([1, 1, 1, 0, -1]) for _ in Q.RULES)] = r.randint(1, 500)
    df = spark.createDataFrame([(list(v), n) for v, n in patterns.items()], "votes array<int>, n long")
    want = plain_fit(patterns)
    got = {tuple(x.votes): x.p_good for x in Q.fit(df).collect()}
    assert set(got) == set(want)
    assert all(math.isclose(got[v], want[v], rel_tol=1e-9, abs_tol=1e-12) for v in want)


def test_clashing_and_extra_columns_repeated_rows_empty_table(spark):
    df = spark.createDataFrame([(1, GOOD * 4, "x", True)] * 3, "doc_id long, text string, votes string, kept boolean")
    out = Q.quality_rules(df.withColumn("counts", F.lit(3)).withColumn("row", F.lit("r")))
    assert out.columns == ["doc_id", "text", "votes", "counts", "row", *Q.COUNTS, "p_good", "base_failed", "kept"]
    got = out.collect()
    assert len(got) == 3 and len({r.p_good for r in got}) == 1
    assert Q.quality_rules(df.limit(0)).count() == 0
    assert Q.keep_good(df).columns == df.columns


def test_held_out_labels(spark):
    """The labels are never used to fit; the verdicts agree with almost all of them."""
    sf = "/root/testdata/sf0.01"
    out = Q.quality_rules(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))
    got = out.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("n_words >= 10").select(
        F.avg(((F.col("quality") == 1) == F.col("kept")).cast("int")).alias("agree"),
        F.avg(F.when(F.col("quality") == 1, F.col("kept").cast("int"))).alias("recall")).first()
    assert got.agree > 0.97 and got.recall > 0.97
