"""Licence scans against a plain word search; the expression parser; edge cases."""

import random
import re

import pytest

from trackside.llm import licenses as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places = sorted((i, label) for p, label in L.BASE_PHRASES.items() for i in range(len(w))
                    if w[i:i + len(p.split())] == p.split())
    starts = [i for i, _ in places]
    return (len(w), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in places})))


def test_places_and_base_labels_match_a_word_search(spark):
    r = random.Random(4)
    parts = ["Apache", "License", "MIT", "license", "cc", "BY", "by-nc", "GNU", "general", "public", "é", "x", "lesser", ",", "\n"]
    data = [None, "", "...", "MIT License MIT license mit license", "cc by by cc-by", "Released under the MIT\nLicense.",
            "a" * 50_000 + " gnu general public license", "gnu general public license mit license gnu general public licenses"]
    data += ["".join(r.choice(parts) + r.choice([" ", "-", "  "]) for _ in range(r.randint(1, 80))) for _ in range(200)]
    df = spark.createDataFrame([(i, t, "l", 1) for i, t in enumerate(data)] + [(0, None, "l", 1)],
                               "doc_id long, text string, Labels string, extra int")
    out = L.scan_licenses(df)
    assert out.columns == ["doc_id", "text", "extra", *[f.name for f in L.FIELDS]]
    got = out.collect()
    assert len(got) == len(data) + 1
    for row in got:
        assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == plain(row.text), row.text
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(","))
        assert 0 <= row.score <= 1
    assert L.scan_licenses(df.limit(0)).count() == 0


@pytest.mark.parametrize("text,normal,level", [
    ("MIT", "MIT", L.PERMISSIVE),
    ("MIT OR GPL-3.0-only", "(MIT OR GPL-3.0-only)", L.PERMISSIVE),
    ("MIT and GPL-3.0-only", "(MIT AND GPL-3.0-only)", L.STRONG),
    ("MIT OR Apache-2.0 AND GPL-2.0-or-later WITH Classpath-exception-2.0",
     "(MIT OR (Apache-2.0 AND GPL-2.0-or-later WITH Classpath-exception-2.0))", L.PERMISSIVE),
    ("(MIT OR LGPL-2.1+) AND BSD-3-Clause", "((MIT OR LGPL-2.1+) AND BSD-3-Clause)", L.PERMISSIVE),
    ("GPL-2.0-only WITH Classpath-exception-2.0 */", "GPL-2.0-only WITH Classpath-exception-2.0", L.WEAK),
    ("LicenseRef-own", "LicenseRef-own", L.UNKNOWN),
    ("MIT MIT", "MIT", L.PERMISSIVE),
])
def test_expressions(text, normal, level):
    found, form, _ = L.evaluate(L.to_postfix(text))
    assert (form, found) == (normal, level)


@pytest.mark.parametrize("text", ["", "AND MIT", "MIT OR", "(MIT", "MIT)", "()", "MIT AND OR Zlib", "MIT (Zlib)"])
def test_malformed_expressions(text):
    with pytest.raises(ValueError):
        L.to_postfix(text)


def test_tags_add_labels_and_bound_the_score(spark):
    data = ["// SPDX-License-Identifier: MIT OR GPL-3.0-only\ncode", "# spdx-license-identifier : (Apache-2.0\n",
            "SPDX-License-Identifier: MIT\nSPDX-License-Identifier: GPL-2.0-only", "spdx license identifier MIT"]
    got = [r for r in L.scan_licenses(spark.createDataFrame([(t,) for t in data], "text string").coalesce(1)).collect()]
    assert [(r.labels, r.expressions, r.score) for r in got] == [
        ("gpl-3.0-only,mit", ["(MIT OR GPL-3.0-only)"], 1.0), ("", [None], 0.1),
        ("gpl-2.0-only,mit", ["MIT", "GPL-2.0-only"], 0.3), ("", [], 0.0)]
