"""URL filters: nested allow and block rules found by a sorted sweep.

A rule is a host and a path.  It fits an URL when the URL's host is the rule's
host or one of its subdomains and the URL's path starts with the rule's path;
of several, the longest (host and path together; on a tie the longer host) wins.

Method.  A host's labels are reversed (``www.example.org`` -> ``org.example.www``),
so that a host and all above it are prefixes of one key.  Each distinct URL
stands under those of its host's prefixes that some rule bears, at most as many
labels deep as the deepest rule.  Under one key, a rule covers the interval of
paths that begin with its own; intervals nest or are apart.  Rules and URLs are
merged by (key, path) with one sort, and a sweep keeps the stack of the rules
that are open at the current path: its top is the longest that fits.  Only the
stack is held, never a group.

A hot key (one host with a third of all URLs) is dealt over salts in proportion
to its count, and its rules are repeated under each salt.  Rules are never
broadcast by force, so their number is free.

Defined cases: null URL or no ``://``: host and path empty, no rule fits.
Repeated URLs get the same verdict; of equal rules with different verdicts,
block wins.  A rule with a null or empty host fits nothing; a null path is
empty.  Empty tables give empty results, and no rules the default for all.
Input columns named host, path, rule or verdict are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackside.llm.common import lower_ascii, others, quoted

ALLOW, BLOCK = "allow", "block"


def url_host(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(_rest(url), r"\A[^/?#]*", 0)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"\A[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def reversed_labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by (key, salt, path, is_url): the open rule for each URL."""
    group, stack = None, []
    for batch in batches:
        out = []
        for key, salt, path, is_url, host, rule, verdict in batch.itertuples(index=False, name=None):
            if group != (key, salt):
                group, stack = (key, salt), []
            while stack and not path.startswith(stack[-1][0]):
                stack.pop()
            if not is_url:
                stack.append((path, rule, verdict))
            elif stack:
                out.append((host, path, len(key), stack[-1][1], stack[-1][2]))
        yield pd.DataFrame(out, columns=["host", "path", "key_len", "rule", "verdict"])


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = ALLOW,
                rows_per_salt: int = 100_000) -> DataFrame:
    """``pages`` with host, path, rule (host and path of the winner, or null) and verdict.

    ``rules`` has columns host, path and verdict.  ``rows_per_salt`` bounds the
    distinct URLs of one key that are swept in one run.
    """
    new = ("host", "path", "rule", "verdict")
    row = pages.select(*map(quoted, others(pages, new)),
                       url_host(F.col(quoted(url))).alias("host"),
                       url_path(F.col(quoted(url))).alias("path"))

    rules = (rules.where(F.col("host") != "")
             .groupBy(lower_ascii("host").alias("host"), F.coalesce("path", F.lit("")).alias("path"))
             .agg(F.min(F.col("verdict") != BLOCK).alias("allows"))
             .select(F.array_join(reversed_labels(F.col("host")), ".").alias("key"),
                     F.size(F.split("host", r"\.")).alias("labels"), "path",
                     F.concat("host", "path").alias("rule"),
                     F.when(F.col("allows"), ALLOW).otherwise(BLOCK).alias("verdict")))
    deepest = rules.agg(F.max("labels")).first()[0] or 0

    labels = reversed_labels(F.col("host"))
    under = (row.where(F.col("host") != "").select("host", "path").distinct()
             .select("host", "path", F.explode(F.transform(
                 F.sequence(F.lit(1), F.least(F.size(labels), F.lit(max(deepest, 1)))),
                 lambda k: F.array_join(F.slice(labels, F.lit(1), k), "."))).alias("key"))
             .join(rules.select("key").distinct(), "key", "left_semi"))
    salts = under.groupBy("key").agg(F.ceil(F.count("*") / rows_per_salt).cast("int").alias("salts"))
    urls = (under.join(salts, "key")
            .select("key", F.pmod(F.xxhash64("path", "host"), F.col("salts")).cast("int").alias("salt"),
                    "path", F.lit(True).alias("is_url"), "host",
                    F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict")))
    opened = (rules.join(salts, "key")
              .select("key", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
                      "path", F.lit(False).alias("is_url"), F.lit(None).cast("string").alias("host"),
                      "rule", "verdict"))
    swept = (urls.unionByName(opened).repartition("key", "salt")
             .sortWithinPartitions("key", "salt", "path", "is_url")
             .mapInPandas(_sweep, "host string, path string, key_len int, rule string, verdict string"))
    best = swept.groupBy("host", "path").agg(
        F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), "key_len")).alias("best"))
    return (row.join(best, ["host", "path"], "left")
            .select(*map(quoted, others(row, ("host", "path"))), "host", "path",
                    F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
