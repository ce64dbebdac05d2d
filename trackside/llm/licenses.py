"""License scans: one Aho-Corasick automaton for tags and notices, a shunting-yard
parser for licence expressions.

A text is brought to words of letters, digits and non-ASCII characters, A-Z made
small, one space between them; the automaton holds every notice phrase and the
words of the identifier tag, a space at either end, and reads each text once,
whatever the number of phrases.  Behind each tag the expression is read from the
raw text and parsed: ``with`` binds before ``and``, ``and`` before ``or``.

Verdicts.  Each licence has a class; ``and`` takes the strictest of its sides,
``or`` the freest, ``with`` turns strong copyleft into weak (an exception frees
the using work).  The score of a text is that of the strictest licence found:
1 permissive, 0.6 weak copyleft, 0.3 strong copyleft, 0.1 reserved or unknown;
0 where none is stated.

Defined cases: a null text has no words, places or labels, and score 0; repeated
rows give repeated results; an expression that does not parse counts as unknown
and is kept as null among the expressions.  Extra columns pass through; those
that bear a result's name are replaced.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from trackside.llm.common import add_columns, byte_words

PERMISSIVE, WEAK, STRONG, UNKNOWN = 0, 1, 2, 3
SCORES = (1.0, 0.6, 0.3, 0.1)

# The phrases and labels every scan counts as base.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Further notice phrases and their labels.
MORE_PHRASES = {
    "all rights reserved": "reserved",
    "bsd license": "bsd",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "cc0": "cc0",
    "eclipse public license": "epl",
    "gnu affero general public license": "agpl",
    "gnu lesser general public license": "lgpl",
    "isc license": "isc",
    "mozilla public license": "mpl",
    "public domain": "public-domain",
    "unlicense": "unlicense",
}
# Classes of labels and of identifiers without version.
CLASSES = {
    "0bsd": PERMISSIVE, "agpl": STRONG, "apache": PERMISSIVE, "bsd": PERMISSIVE, "bsl": PERMISSIVE,
    "cc-by": PERMISSIVE, "cc-by-nc": UNKNOWN, "cc-by-nd": UNKNOWN, "cc-by-sa": WEAK, "cc0": PERMISSIVE,
    "epl": WEAK, "gpl": STRONG, "isc": PERMISSIVE, "lgpl": WEAK, "mit": PERMISSIVE, "mpl": WEAK,
    "public-domain": PERMISSIVE, "reserved": UNKNOWN, "unlicense": PERMISSIVE, "zlib": PERMISSIVE,
}
TAG = "spdx license identifier"
TAG_VALUE = re.compile(rb"SPDX-License-Identifier[ \t]*:[ \t]*([^\r\n]*)", re.I)
TOKEN = re.compile(r"\s*([()]|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
BINDS = {"or": 1, "and": 2, "with": 3}

FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()),
    T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.StringType()),
    T.StructField("labels", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("expressions", T.ArrayType(T.StringType())),
]


def licence_class(identifier: str) -> int:
    """Class of ``Apache-2.0``, ``gpl-3.0-or-later``, ``mit``: the name before the version."""
    name = identifier.lower().rstrip("+")
    while name and name not in CLASSES:
        name = name.rpartition("-")[0]
    return CLASSES.get(name, UNKNOWN)


def to_postfix(expression: str) -> list[str]:
    """The expression's identifiers and operators in postfix order; ValueError if malformed.

    Reading stops at the first character that cannot belong to an expression
    (the end of a comment, say)."""
    out, held, at, operand = [], [], 0, True
    while m := TOKEN.match(expression, at):
        word, low, before = m[1], m[1].lower(), at
        if word == "(":
            if not operand:
                raise ValueError(expression)
            held.append(word)
        elif word == ")":
            if operand:
                raise ValueError(expression)
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                raise ValueError(expression)
            held.pop()
        elif low in BINDS:
            if operand:
                raise ValueError(expression)
            while held and BINDS.get(held[-1], 0) >= BINDS[low]:
                out.append(held.pop())
            held.append(low)
            operand = True
        else:
            if not operand:
                break
            out.append(word)
            operand = False
        at = m.end()
        if at == before:
            break
    if operand or "(" in held:
        raise ValueError(expression)
    return out + held[::-1]


def evaluate(postfix: list[str]) -> tuple[int, str, set[str]]:
    """Class, normal form (fully bracketed) and identifiers of an expression."""
    stack: list[tuple[int, str, set[str]]] = []
    for word in postfix:
        if word not in BINDS:
            stack.append((licence_class(word), word, {word.lower()}))
            continue
        (b_class, b, b_ids), (a_class, a, a_ids) = stack.pop(), stack.pop()
        if word == "with":
            stack.append((WEAK if a_class == STRONG else a_class, f"{a} WITH {b}", a_ids))
        else:
            pick = max if word == "and" else min
            stack.append((pick(a_class, b_class), f"({a} {word.upper()} {b})", a_ids | b_ids))
    return stack.pop()


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase, label in {**MORE_PHRASES, **BASE_PHRASES, TAG: None}.items():
        found.add_word(f" {phrase} ", (len(phrase) + 2, phrase in BASE_PHRASES, label))
    found.make_automaton()
    return found


def scan_text(text: bytes | None) -> tuple:
    """A row of FIELDS for one text."""
    words = byte_words(text)
    line = f" {b' '.join(words).decode('latin-1')} "
    base, labels, classes, tagged, place, seen, n_base = set(), set(), [], False, -1, 0, 0
    first = last = None
    for end, (size, is_base, label) in _automaton().iter(line):
        if label is None:
            tagged = True
            continue
        labels.add(label)
        classes.append(CLASSES[label])
        if is_base:
            base.add(label)
            start = end - size + 1
            # phrases end in order, but a long one may start before the last place
            place, seen = (place + line.count(" ", seen, start + 1), start + 1) if start + 1 >= seen \
                else (place - line.count(" ", start + 1, seen), start + 1)
            n_base += 1
            first = place if first is None else min(first, place)
            last = place if last is None else max(last, place)
    expressions = []
    for m in TAG_VALUE.finditer(text) if tagged else ():
        try:
            level, normal, ids = evaluate(to_postfix(m[1].decode("utf-8", "replace")))
        except ValueError:
            level, normal, ids = UNKNOWN, None, set()
        expressions.append(normal)
        labels |= ids
        classes.append(level)
    return (len(words), n_base, first, last, ",".join(sorted(base)), ",".join(sorted(labels)),
            SCORES[max(classes)] if classes else 0.0, expressions)


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_base (all places of base phrases), first_word and
    last_word (their smallest and largest start, in words from 0; else null),
    base_labels and labels (distinct, sorted, comma-joined), score and expressions."""
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(),
             pa.list_(pa.string())]

    def make(texts: list) -> list[pa.Array]:
        rows = [scan_text(t) for t in texts]
        return [pa.array(column, type=kind) for column, kind in zip(zip(*rows), types)]

    return add_columns(docs, text, FIELDS, make)
