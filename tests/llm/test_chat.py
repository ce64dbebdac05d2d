"""Chat formatting: exact read-back, expansion of every assistant turn, edge cases."""

import hashlib
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from trackside.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(turns):
    """Per conversation the turns in order, nulls first."""
    out = {}
    key = lambda x: (x is not None, x)
    for c, t, r, x in turns:
        out.setdefault(c, []).append((t, r or "", x or ""))
    return {c: [(r, x) for _, r, x in sorted(rows, key=lambda y: (key(y[0]), y[1], y[2]))] for c, rows in out.items()}


def conversations():
    r = random.Random(7)
    bits = ["<|im_end|>", "<|im_start|>assistant", "\n", "\\", "<\\|", "<", "|", "ok", "é\U0001F600", "\\n", " "]
    turns = []
    for c in [*range(30), None]:
        for t in range(r.randint(1, 12)):
            turns.append((c, t, r.choice(["user", "assistant", "system", None, "a\nb", "<|x"]),
                          "".join(r.choice(bits) for _ in range(r.randint(0, 12)))))
    turns += [(50, 0, "user", "no reply"), (51, None, "assistant", None), (51, 3, "assistant", "x"), (51, 3, "assistant", "x"),
              (51, 3, "assistant", "a"), (52, 0, "assistant", "long " * 20_000)]
    r.shuffle(turns)
    return turns


def test_read_back_and_examples(spark):
    turns = conversations()
    df = spark.createDataFrame([(*t, "x") for t in turns], SCHEMA + ", segment string").repartition(3)
    segments = C.format_turns(df)
    want = plain(turns)
    got = {r.conv_id: r for r in C.read_back(segments).collect()}
    assert set(got) == set(want)
    for c, rows in want.items():
        r = got[c]
        replies = [x for role, x in rows if role == "assistant"]
        assert r.n_turns == len(rows) and r.n_examples == len(replies)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in rows).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len("".join(replies)), hashlib.sha256("".join(replies).encode()).hexdigest())

    # written out: the k-th example is all turns up to the k-th reply, and trains on that reply alone
    written = {}
    for e in C.write_out(segments).collect():
        written.setdefault(e.conv_id, {})[e.example] = e
    for c, rows in want.items():
        ends = [i for i, (role, _) in enumerate(rows) if role == "assistant"]
        assert sorted(written.get(c, {})) == list(range(len(ends)))
        for k, i in enumerate(ends):
            e = written[c][k]
            parts = e.text.split(C.END + "\n")
            assert parts[-1] == "" and [C.parse_segment(p + C.END + "\n") for p in parts[:-1]] == rows[:i + 1]
            assert C.unescape(e.text[e.loss_start:e.loss_end]) == rows[i][1]
        assert sum(len(e.text) for e in written.get(c, {}).values()) == got[c].example_chars
    spans = {(e.conv_id, e.example): (e.loss_start, e.loss_end, e.n_chars) for e in C.examples(segments).collect()}
    assert spans == {(c, k): (e.loss_start, e.loss_end, len(e.text)) for c, es in written.items() for k, e in es.items()}


@given(st.text())
def test_unescape_is_the_inverse(text):
    assert C.unescape(text.replace("\\", "\\\\").replace("<|", "<\\|")) == text


def test_empty_table(spark):
    segments = C.format_turns(spark.createDataFrame([], SCHEMA))
    assert C.read_back(segments).count() == C.write_out(segments).count() == C.examples(segments).count() == 0


def test_the_digests_come_from_the_written_examples(spark):
    """Other words in a written example, or a context that is not the one before it, show in what is read back."""
    turn = lambda role, text: f"{C.START}{role}\n{text}{C.END}\n"
    first, whole = turn("user", "a") + turn("assistant", "b"), turn("user", "a") + turn("assistant", "b") + turn("assistant", "c")
    at = lambda text, of: text.rindex(f"{of}{C.END}")

    def read(one, two):
        rows = [(5, 0, one, at(one, "b"), at(one, "b") + 1), (5, 1, two, at(two, "c"), at(two, "c") + 1), (5, None, two, None, None)]
        return C.read_examples(spark.createDataFrame(rows, "conv_id long, example int, text string, loss_start long, loss_end long")
                               .coalesce(1)).collect()

    r, = read(first, whole)
    assert (r.n_turns, r.n_examples, r.loss_chars, r.formatted_chars) == (3, 2, 2, len(whole))
    assert r.loss_sha256 == hashlib.sha256(b"bc").hexdigest() and r.example_chars == len(first) + len(whole)
    with pytest.raises(Exception, match="does not start with the one before it"):
        read(first.replace("a", "x", 1), whole)


def test_read_back_runs_on_the_expansion(spark):
    turns = [(1, t, "assistant" if t % 2 else "user", f"t{t}") for t in range(6)] + [(2, 0, "user", "no reply")]
    segments = C.format_turns(spark.createDataFrame(turns, SCHEMA))
    plan = C.read_back(segments)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInPandas") == 2   # the examples are written out, then read
    assert {r.conv_id: r.example_chars for r in C.read_back(segments).collect()} == {
        1: sum(len(e.text) for e in C.write_out(segments).collect()), 2: 0}
