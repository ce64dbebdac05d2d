"""URL filters against brute force; nested rules, hot hosts, edge cases."""

import random

from trackside.llm import url_filter as U

RULES = "host string, path string, verdict string"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    path = rest[end:]
    stop = min((path.index(c) for c in "?#" if c in path), default=len(path))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end]), path[:stop]


def plain(url, rules, default="allow"):
    host, path = split(url)
    best = None
    for h, p, v in rules:
        p = p or ""
        if h and (host == h or host.endswith("." + h)) and path.startswith(p):
            rank = (len(h + p), len(h), v == "block")
            if best is None or rank > best[0]:
                best = (rank, h + p, v)
    return host, path, best and best[1], best[2] if best else default


def test_matches_brute_force_with_hot_keys_and_salts(spark):
    r = random.Random(6)
    hosts = ["a.example.org", "example.org", "EXAMPLE.org", "b.a.example.org", "notexample.org", "x.com", "org", "", "a..org",
             "deep." * 30 + "example.org"]
    paths = ["", "/", "/en", "/en/1", "/en/12/x", "/es/", "/en/1?x=/es/", "#/en", "?/en/1", "/é", "/en/1/2/3"]
    urls = [f"http{r.choice(['', 's'])}://{r.choice(hosts)}{r.choice(paths)}" for _ in range(500)]
    urls += ["http://a.example.org/en/%d" % i for i in range(300)] + ["http://a.example.org/en/1"] * 400
    urls += [None, "", "no url", "://x.com/en", "http://a.example.org\n/en/1"]
    rules = [("org", "/", "allow"), ("example.org", "/en", "block"), ("example.org", "/en/1", "allow"),
             ("a.example.org", "/en/1", "block"), ("example.org", "/en/12", "block"), ("x.com", None, "block"),
             ("example.org", "/es/", "allow"), ("example.org", "/es/", "block"), (None, "/", "block"), ("", "/", "block")]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, Host string")
    out = U.filter_urls(pages, spark.createDataFrame(rules, RULES), rows_per_salt=7)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    got = out.collect()
    assert len(got) == len(urls)
    for row in got:
        assert (row.host, row.path, row.rule, row.verdict) == plain(row.url, rules), row.url


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    none = spark.createDataFrame([], RULES)
    assert [(r.rule, r.verdict) for r in U.filter_urls(pages, none, default="block").collect()] == [(None, "block")]
    some = spark.createDataFrame([("org", "/", "allow")], RULES)
    assert U.filter_urls(pages.limit(0), some).count() == 0
