"""The pipeline against its stages' own rules, stage by stage, in plain Python."""

import hashlib
import importlib.util
import random
import re

import pytest

import corpus_pipeline as P

_spec = importlib.util.spec_from_file_location("plain_decontamination", __file__.replace("pipeline", "decontaminate"))
_plain = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(_plain)
_spec = importlib.util.spec_from_file_location("plain_dedup", __file__.replace("pipeline", "near_dedup"))
_dedup = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(_dedup)

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def words(r, n):
    return [r.choice(("river", "mill", "stone", "garden", "boat", "lantern", "window", "orchard", "bridge", "harvest"))
            + r.choice(("", "s", "ing", "ed", "er", "y")) + r.choice("abcdefghij") for _ in range(n)]


def sentence_text(r, n):
    out, w = [], words(r, n)
    while w:
        k = r.randint(8, 14)
        out.append(" ".join(w[:k]).capitalize() + ".")
        w = w[k:]
    return "\n".join(out)


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    r = random.Random(12)
    bench = [(i, " ".join(words(r, 14))) for i in range(6)]
    clean = [sentence_text(r, 120) for _ in range(80)]
    rows = list(clean)
    rows += [clean[3], clean[3], clean[4].upper().lower().capitalize() + " extra"]              # copies, near copies
    rows += [clean[5] + "\n" + bench[1][1].capitalize() + "."]                                  # a benchmark passage
    rows += [clean[6] + "\nCall +1 (212) 555-0188 or mail jo@mail.example.com."]                # near copy with personal data
    rows += [sentence_text(r, 90) + "\nServer 10.1.2.3 and card 4111 1111 1111 1111."]
    rows += [" ".join(w + "###" for w in words(r, 80)) for _ in range(10)]                      # junk
    rows += ["too short", "", None, None]
    docs = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(rows)]
    docs += [docs[0], (None, sentence_text(r, 100), None, None, None)]                          # a repeated row, a null id
    sf = str(tmp_path_factory.mktemp("corpus"))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    return sf, docs, bench


def test_stages_and_run(spark, corpus):
    sf, docs, bench = corpus
    frame = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for name, stage in P.STAGES[:-1]:
        frame = stage(spark, frame, sf)
        assert frame.columns == COLUMNS, name
        rows = [tuple(x) for x in frame.collect()]
        frame = spark.createDataFrame(rows, frame.schema)
        kept[name] = rows

    good = kept["quality rules"]
    assert {x[1] for x in good} == {t for _, t, *_ in docs if t and len(t.split()) >= 10 and "###" not in t}
    # one of each group, that with the smallest id
    named = [(x[0], x[1]) for x in good if x[0] is not None]
    groups = _dedup.plain(sorted(set(named)))
    one = kept["near duplicates"]
    assert sorted(x[0] for x in one if x[0] is not None) == sorted({c for _, c in groups.values()})
    assert sum(x[0] is None for x in one) == 1
    clean = kept["decontamination"]
    items = [t for _, t in bench]
    assert sorted(map(str, clean)) == sorted(str(x) for x in one if not _plain.plain(x[1], items)[1])
    private = kept["personal data"]
    before = {x[0]: x[1] for x in clean}
    for x in private:
        found = re.search(r"10\.1\.2\.3|4111 1111|555-0188|jo@mail", before[x[0]])
        assert (x[1] != before[x[0]]) == bool(found)
        assert not re.search(r"10\.1\.2\.3|4111 1111|555-0188|jo@mail", x[1])

    out = P.run(spark, sf)
    assert out.columns == [*COLUMNS, "ids", "round_trip"]
    got = out.collect()
    digest = lambda rows: sorted(hashlib.sha256(repr(tuple(r)[:5]).encode()).hexdigest() for r in rows)
    assert digest(got) == digest(private)
    assert all(r.round_trip and r.ids for r in got)


def test_empty_tables(spark, corpus, tmp_path):
    sf, *_ = corpus
    for t in ("documents", "benchmark"):
        spark.read.parquet(f"{sf}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
