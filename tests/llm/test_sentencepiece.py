"""Viterbi encoding against an unshared search and the library; exact round trips."""

import itertools

import pytest

from trackside.llm import sentencepiece_viterbi as S

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def content():
    with open(MODEL, "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def model(content):
    return S.Model(content)


@pytest.fixture(scope="module")
def sample(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").limit(60)
    return [r.text for r in df.select("text").collect()]


def best_score(model, word):
    """The best sum of scores, by the plain forward recursion over one word."""
    best = [0.0]
    for end in range(1, len(word) + 1):
        options = [best[s] + model.pieces[word[s:end]][1] for s in range(max(0, end - 16), end) if word[s:end] in model.pieces]
        if word[end - 1] not in model.pieces:
            options.append(best[end - 1] + model.unknown)
        best.append(max(options))
    return best[-1]


def score(model, ids):
    of = {i: s for i, s in model.pieces.values()}
    total, i = 0.0, 0
    while i < len(ids):
        if ids[i] in of:
            total, i = total + of[ids[i]], i + 1
        else:   # the bytes of one unknown character
            total += model.unknown
            i += next(n for n in range(1, 5) if _is_char(b"".join(model.bytes_of[x] for x in ids[i:i + n])))
    return total


def _is_char(raw):
    try:
        return len(raw.decode()) == 1
    except UnicodeDecodeError:
        return False


def test_shared_prefixes_change_nothing(model, sample):
    import numpy as np
    words = sorted({w for t in sample for w in S.WORD.findall(" " + t)})[:4000] + [" ", "\n", "  x", " \U0001F600a▁b", "aaaaaaaaaaaaaaaaaaaaaaaaaa" * 40]
    together = model.segment(words)
    for w in words:
        ids = np.frombuffer(together[w], np.int32).tolist()
        assert b"".join(model.bytes_of[i] for i in ids) == w.encode()
        assert score(model, ids) == pytest.approx(best_score(model, w), rel=1e-9)
    assert all(model.segment([w])[w] == together[w] for w in words[::37])


def test_as_likely_as_the_library_on_a_unigram_model(content, sample):
    """The same vocabulary as a unigram model: the library's own Viterbi is never better."""
    sentencepiece = pytest.importorskip("sentencepiece")
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    proto = pb.ModelProto()
    proto.ParseFromString(content)
    proto.trainer_spec.model_type = 1
    ranks = sentencepiece.SentencePieceProcessor(model_proto=content)
    import math
    for i, piece in enumerate(proto.pieces):
        if piece.type in (1, 4):
            piece.score = -math.log(S.RANK_OFFSET - ranks.get_score(i))
    unigram = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    own = S.Model(proto.SerializeToString())
    same = total = 0
    for text in sample:
        text = text[:300].replace("\n", " ")
        words = S.WORD.findall(" " + text)
        import numpy as np
        found = own.segment(sorted(set(words)))
        ids = list(itertools.chain.from_iterable(np.frombuffer(found[w], np.int32).tolist() for w in words))
        theirs = unigram.encode(text)
        assert score(own, ids) >= score(own, theirs) - 1e-2
        same += ids == theirs
        total += 1
    assert same >= 0.9 * total


def test_round_trips_and_edge_cases(spark, content, sample):
    texts = [None, "", " ", "  two  spaces ", "\n\n a\t\r\n", "▁ mark ▁▁", "emoji \U0001F600 é ﬁ", "z" * 60_000, "w " * 9000, *sample]
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)] + [(0, None, 5)], "doc_id long, text string, IDS int")
    coded = S.encode(df, content)
    assert coded.columns == ["doc_id", "text", "ids"]
    for r in S.decode(coded, content).collect():
        assert r.decoded == r.text
        assert (r.ids is None) == (r.text is None) and (r.text != "" or r.ids == [])
    assert S.decode(S.encode(df.limit(0), content), content).count() == 0


def test_id_slices_hold_every_row_once(monkeypatch):
    import numpy as np
    monkeypatch.setattr(S, "DECODE_IDS", 10)
    for sizes in ([], [0], [3, 30, 0, 0, 4, 4, 4, 25], [100], [1] * 35):
        got = S.id_slices(np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))))
        assert [i for a, b in got for i in range(a, b)] == list(range(len(sizes)))
        assert all(b - a == 1 or sum(sizes[a:b - 1]) <= 20 for a, b in got)


def test_round_trip_column_is_that_of_decoding(spark, content, sample):
    df = spark.createDataFrame([(t,) for t in [None, "", "x" * 3000, *sample[:20], "é\n "]], "text string")
    df = df.unionByName(df.limit(0)).selectExpr("text", "cast(x'41ff42' as string) as broken")
    both = S.decode(S.encode(df, content, round_trip="same"), content)
    assert both.where("NOT same OR NOT decoded <=> text").count() == 0
    assert S.encode(df.limit(1), content, text="broken", round_trip="same").first().same is False
    assert S.encode(df.limit(0), content, round_trip="same").count() == 0


def test_long_words_keep_a_bounded_state(model):
    import random
    import tracemalloc

    import numpy as np
    r = random.Random(2)
    words = ["z" * 200_000, "".join(r.choice("abcdeé\U0001F600") for _ in range(200_000))]
    tracemalloc.start()
    together = model.segment([*words, words[0][:-1] + "y", words[1][:300], words[1][:70] + "q"])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20
    for w, ids in together.items():
        assert b"".join(model.bytes_of[i] for i in np.frombuffer(ids, np.int32).tolist()) == w.encode()
        if len(w) < 1000:
            assert model.segment([w])[w] == ids and score(model, np.frombuffer(ids, np.int32).tolist()) == pytest.approx(best_score(model, w))


def test_full_cache_changes_nothing(model, content, sample, monkeypatch, spark):
    df = spark.createDataFrame([(t,) for t in sample], "text string").coalesce(1)
    want = [r.ids for r in S.encode(df, content).collect()]
    import numpy as np
    monkeypatch.setattr(S, "CACHE_WORDS", 10)
    known = {}
    for t, ids in zip(sample, want):
        coded = S.encode_texts(model, known, [t and t.encode()])
        assert np.frombuffer(coded[0], np.int32).tolist() == (ids or []) and len(known) <= 10
    words = sorted({w for t in sample for w in S.WORD.findall(" " + t)})
    half = model.segment(words[: len(words) // 2]) | model.segment(words[len(words) // 2:])
    import numpy as np
    got = [[i for w in (S.WORD.findall(" " + t) if t else []) for i in np.frombuffer(half[w], np.int32).tolist()] for t in sample]
    assert got == want
