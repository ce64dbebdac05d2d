"""WARC derivatives: links, digests, text; files written and read again; edge cases."""

import base64
import hashlib
import random
import re
import time

import pytest

from trackside.llm import warc as W

PAGE = ("<!DOCTYPE html><html lang='fr'><head><title>A &amp; B\n&#233;</title><style>p{}</style></head><body><script>var t=\"</p>\";"
        "</script><!-- <p>hidden</p> --><h1>One</h1><p>two <b>thr</b>ee &lt;tag&gt; &#x41;&#66;&amp;lt;<br>four</p>"
        "<ul><li>a<li>b</ul><a href=\"/x?a=1&amp;b=2\">link</a> a < b</body></html>")


def sha(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_records_link_to_their_source(spark):
    df = spark.createDataFrame([(1, "http://a.org/", PAGE)], "page_id long, url string, html string")
    source = W.responses_from_pages(df, keep=["page_id"])
    s = source.first()
    got = {r.record_type: r for r in W.derive(source, keep=["page_id"]).collect()}
    assert set(got) == {"metadata", "conversion"}
    for r in got.values():
        fields, block = next(W.parse_warc(r.record.encode()))
        assert fields["WARC-Refers-To"] == r.refers_to == s.record_id
        assert re.fullmatch(r"<urn:uuid:[0-9a-f]{8}-[0-9a-f]{4}-5[0-9a-f]{3}-a[0-9a-f]{3}-[0-9a-f]{12}>", r.record_id)
        assert fields["WARC-Record-ID"] == r.record_id and fields["WARC-Type"] == r.record_type
        assert fields["WARC-Target-URI"] == "http://a.org/" and fields["WARC-Date"] == s.date
        assert fields["WARC-Block-Digest"] == r.block_digest == sha(block)
        assert fields["WARC-Source-Payload-Digest"] == r.source_digest == sha(PAGE.encode())
        assert int(fields["Content-Length"]) == r.content_length == len(block)
    _, text = next(W.parse_warc(got["conversion"].record.encode()))
    assert text.decode() == "One\ntwo three <tag> AB&lt;\nfour\na\nb\nlink a < b"
    _, meta = next(W.parse_warc(got["metadata"].record.encode()))
    lines = meta.decode().split("\r\n")
    assert lines[:4] == ["title: A & B é", "language: fr", "charset: utf-8", "http-status: 200"]
    assert "http-header: Content-Type: text/html; charset=utf-8" in lines and "outlink: /x?a=1&b=2" in lines
    assert f"conversion: {got['conversion'].record_id}" in lines
    assert f"conversion-digest: {sha(text)}" in lines


def test_files_round_trip_and_feed_the_builder(spark, scratch):
    pages = spark.createDataFrame([(i, f"http://a.org/{i}", PAGE + "é" * i) for i in range(5)], "page_id long, url string, html string")
    made = W.derive(W.responses_from_pages(pages))
    path = scratch("warc") + "/files"
    W.write_warc(made, path)
    back = {r.record_id: r for r in W.read_warc(spark, path).collect()}
    want = made.collect()
    assert len(back) == len(want) == 10
    for r in want:
        b = back[r.record_id]
        assert (b.record_type, b.target_uri, b.date, b.refers_to) == (r.record_type, r.target_uri, r.date, r.refers_to)
        assert r.record.encode().endswith(b"\r\n\r\n" + bytes(b.block))
    # a response read from a file gives the same records as the page itself
    s = W.responses_from_pages(pages).first()
    block = f"{s.http_headers}\r\n\r\n{s.payload}".encode()
    record = (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: {s.record_id}\r\nWARC-Target-URI: {s.target_uri}\r\n"
              f"WARC-Date: {s.date}\r\nContent-Length: {len(block)}\r\n\r\n").encode() + block
    spark.createDataFrame([(record.decode(),)], "record string").write.option("lineSep", "\r\n\r\n").option(
        "compression", "gzip").text(path + "-in")
    read = W.read_warc(spark, path + "-in").where("record_type = 'response'")
    assert {r.record for r in W.derive(read).collect()} == {r.record for r in want if r.refers_to == s.record_id}


def test_edge_cases(spark):
    data = [(1, None, None), (1, None, None), (2, "http://a.org/\r\nX: y", ""), (3, "u", "plain text only"), (4, "u", "<p>" + "w " * 50_000),
            (5, "u", "<script>never closed <p>x"), (6, "u", "&#0;&#1114112;&#xD800;&unknown;&")]
    df = spark.createDataFrame([(*x, "m") for x in data], "page_id long, url string, html string, record string")
    got = W.derive(W.responses_from_pages(df, keep=["page_id"]), keep=["page_id"])
    rows = got.collect()
    assert len(rows) == 2 * len(data)
    by = {(r.page_id, r.record_type): r for r in rows}
    assert "WARC-Target-URI" not in by[1, "metadata"].record and by[1, "conversion"].content_length == 0
    assert by[2, "metadata"].target_uri == "http://a.org/ X: y"
    assert by[3, "conversion"].record.endswith("\r\n\r\nplain text only")
    assert by[6, "conversion"].record.endswith("\r\n\r\n&#0;&#1114112;&#xD800;&unknown;&")
    assert len({r.record for r in rows if r.page_id == 1}) == 2
    assert W.derive(W.responses_from_pages(df.limit(0))).count() == 0


# The rules as single patterns, which take time that grows with the square of a broken page.
BLOCK = rf"(?ai) ?</?(?:{W.BLOCKS})\b[^>]*> ?"


def by_pattern(html):
    t = re.sub(rf"(?ais)<!--.*?-->|<({W.HIDDEN})\b.*?</\1\s*>", " ", html)
    t = re.sub(BLOCK, "\n", re.sub(r"(?a)\s+", " ", t))
    t = W.unescape_entities(re.sub(r"<[a-zA-Z/!?][^>]*>", "", t))
    head = re.search(r"(?ais)<title\b[^>]*>(.*?)</title\s*>", html)
    lang = re.search(r"""(?ai)<html\b[^>]*\blang\s*=\s*["']?([^"'\s>]*)""", html)
    links = re.findall(r"""(?ai)<a\b[^>]*?\bhref\s*=\s*["']?([^"'\s>]*)""", html)
    return (re.sub(r" *\n[ \n]*", "\n", t).strip(" \n"), W.unescape_entities(head[1]) if head else "", lang[1] if lang else "",
            [W.unescape_entities(x) for x in links])


PARTS = ["<!--", "-->", "<script>", "</script >", "<SCRIPT x>", "<style", "</style>", "<head>", "</head>", "<header>", "<p", "<p>", "</P>", "<br/>",
         "<b>", "</b", ">", "<", " ", "\n", "\x0b", "\u00a0", "x", "é", "ſ", "&amp;", "&#65;", "&lt", "<title>", "<title ", "</title>", "<html", " lang=",
         " lang='de'", " LANG = fr", " data-lang=q", "<a", "<a ", " href=", " href = '/u", "\"", "'", "/v&amp;w", "<area href=z", "<td>", "<template>", "</template>"]


def test_scans_agree_with_the_patterns():
    r = random.Random(1)
    for _ in range(20_000):
        html = "".join(r.choice(PARTS) for _ in range(r.randint(0, 25)))
        assert (W.plain_text(html), W.title_of(html), W.language_of(html), W.links_of(html)) == by_pattern(html), html


@pytest.mark.parametrize("part", ["<script>", "<script>x", "<!--", "<!--x", "<a ", "<a href=", "<title ", "<title>", "<html ", "<html lang=", "<p ", "<p",
                                  "<", "<b ", "</script ", "&#", "&", "<a href=x ", " ", "\n ", "<head><style><!--", "<template></templat"])
def test_very_long_broken_pages(part):
    html = part * (1_000_000 // len(part))
    began = time.perf_counter()
    W.plain_text(html), W.title_of(html), W.language_of(html), W.links_of(html)
    assert time.perf_counter() - began < 5


def test_clashing_names_stay(spark):
    df = spark.createDataFrame([(1, "u", "<p>x", "mine", "also", "text")], "page_id long, url string, html string, record_type string, refers_to string, text string")
    made = W.derive(W.responses_from_pages(df, keep=["record_type", "text"]), keep=["record_type", "text"])
    assert made.columns[:2] == ["record_type", "text"] and made.count() == 2
    assert {r[0] for r in made.collect()} == {"mine"} and {r[1] for r in made.collect()} == {"text"}


def test_only_text_is_converted(spark):
    head = "HTTP/1.1 404 Not Found\r\nContent-Type: {}"
    df = spark.createDataFrame([("r1", "u", "d", head.format("application/pdf"), "%PDF"), ("r2", "u", "d", head.format("text/plain"), "a <b> c"),
                                ("r3", "u", "d", None, "x")],
                               "record_id string, target_uri string, date string, http_headers string, payload string")
    got = {(r.refers_to, r.record_type): r.record for r in W.derive(df).collect()}
    assert set(got) == {("r1", "metadata"), ("r2", "metadata"), ("r2", "conversion"), ("r3", "metadata")}
    assert got["r2", "conversion"].endswith("a <b> c") and "http-status: 404" in got["r1", "metadata"]
