"""Quality rules as weak supervision.

Each rule looks at one property of a text and votes high (+1) or low (-1), or
abstains (0) between its two bounds.  Nothing is known about the rules beforehand:
expectation-maximisation over all texts estimates how each rule votes on good and
on bad texts, and how many texts are good; a text is kept when its posterior
probability of being good is at least ``keep_at``.  So one weak rule cannot reject
a text that all the others vouch for, and rules that often err count little.  A
rule is never believed to be worse than chance.

Texts with the same votes are alike to the model, so the votes are counted first
(at most 3**rules patterns, whatever the number of texts), and the iterations run
over those counts inside one row, as one expression.  Every text then looks up
its pattern's posterior in that same bounded table, which is the only thing that is
broadcast.  All expressions are Spark's own.

Counts (they are results too): words are runs of characters other than space and
\\t to \\r; ``word_chars`` counts code points in words; ``n_symbols`` counts
``#*$%&|<>``; ``n_dup_lines`` counts lines with a word that equal an earlier line;
``n_repeat_words`` counts words in five-word windows that stand twice or more in
the text, the first included (windows are compared by 64-bit hashes, within one text).

Base rule: fewer than 10 words, or over 20 % repeated words, fails whatever the votes.

Defined cases: a null text counts as empty and fails; repeated rows get the same
verdict and each counts; an empty table gives an empty result.  Extra columns pass
through, those named like a result are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackside.llm.common import let, others, quoted
from trackside.session import scratch_dir

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: name: (property, bounds of a high vote, bounds of a low vote); bounds are closed.
RULES = {
    "symbols": (lambda f: f["n_symbols"] / f["word_chars"], (0.0, 0.005), (0.05, math.inf)),
    "symbol_runs": (lambda f: f["n_symbol_runs"] / f["n_words"], (0.0, 0.02), (0.15, math.inf)),
    "repeats": (lambda f: f["n_repeat_words"] / f["n_words"], (0.0, 0.05), (0.15, math.inf)),
    "dup_lines": (lambda f: f["n_dup_lines"] / f["n_lines"], (0.0, 0.02), (0.2, math.inf)),
    "capitals": (lambda f: f["n_capitals"] / f["word_chars"], (0.0, 0.1), (0.3, math.inf)),
    "doubled_marks": (lambda f: f["n_doubled_marks"] / f["n_words"], (0.0, 0.01), (0.1, math.inf)),
    "line_ends": (lambda f: f["n_ended"] / f["n_lines"], (0.8, 1.0), (0.0, 0.3)),
    "length": (lambda f: f["n_words"].cast("double"), (40.0, math.inf), (0.0, 10.0)),
}


def _repeat_words(words: Column) -> Column:
    """Words of the array inside a window of WINDOW words that it holds twice or more."""
    def covered(g: Column) -> Column:
        def starts(s: Column) -> Column:
            return F.array_sort(F.array_compact(F.transform(s, lambda x, k: F.when(
                (x["g"] == F.get(s, k + 1)["g"]) | (x["g"] == F.get(s, k - 1)["g"]), x["i"]))))

        def add(state: Column, i: Column) -> Column:
            return F.struct((i + WINDOW).alias("end"),
                            (state["n"] + F.least(F.lit(WINDOW), i + WINDOW - state["end"])).alias("n"))

        zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        sorted_windows = F.array_sort(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))
        return F.aggregate(let(sorted_windows, starts), zero, add, lambda s: s["n"])

    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.greatest(F.size(h) - WINDOW, F.lit(0))),
                           lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))

    n = let(F.transform(words, lambda x: F.xxhash64(x)), lambda h: F.when(F.size(h) > WINDOW, let(
        windows(h), lambda g: F.when(F.size(F.array_distinct(g)) < F.size(g), covered(g)))))
    return F.coalesce(n, F.lit(0)).cast("long")


def text_counts(text: Column) -> Column:
    """A struct of COUNTS and of further counts for the rules."""
    text = F.coalesce(text.cast("string"), F.lit(""))

    def of_words(words: Column) -> Column:
        return F.struct(F.size(words).cast("long").alias("n_words"),
                        F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
                        _repeat_words(words).alias("n_repeat_words"))

    def of_lines(lines: Column) -> Column:
        ended = F.filter(lines, lambda x: x.rlike(r"[.!?:;][\x20\x09-\x0D]*\z"))
        return F.struct(F.size(lines).cast("long").alias("n_lines"),
                        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
                        F.size(ended).cast("long").alias("n_ended"))

    def of_symbols(s: Column) -> Column:
        """Of the symbols, a space for each stretch of other characters."""
        return F.struct(F.char_length(F.replace(s, F.lit(" "))).cast("long").alias("n_symbols"),
                        F.size(F.array_remove(F.split(s, " "), "")).cast("long").alias("n_symbol_runs"))

    words = let(F.array_remove(F.split(text, SPACE), ""), of_words)
    lines = let(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), of_lines)
    symbols = let(F.regexp_replace(text, r"[^#*$%&|<>]+", " "), of_symbols)
    return let(words, lambda w: let(lines, lambda x: let(symbols, lambda s: F.struct(
        w["n_words"].alias("n_words"), w["word_chars"].alias("word_chars"), s["n_symbols"].alias("n_symbols"),
        x["n_dup_lines"].alias("n_dup_lines"), w["n_repeat_words"].alias("n_repeat_words"),
        x["n_lines"].alias("n_lines"), x["n_ended"].alias("n_ended"), s["n_symbol_runs"].alias("n_symbol_runs"),
        F.char_length(F.regexp_replace(text, r"[^A-Z]+", "")).cast("long").alias("n_capitals"),
        F.regexp_count(text, F.lit(r"[!?]{2,}")).cast("long").alias("n_doubled_marks")))))


def votes(counts: Column) -> Column:
    """An array with each rule's vote: 1, -1 or 0; a property without a value abstains."""
    class Counts:
        def __getitem__(self, name: str) -> Column:
            c = counts[name]
            return F.nullif(c, F.lit(0)) if name in ("word_chars", "n_lines") else c

    class Shares(Counts):
        """No share of nothing: a text without words has no shares."""
        def __getitem__(self, name: str) -> Column:
            c = super().__getitem__(name)
            return F.nullif(c, F.lit(0)) if name == "n_words" else c

    out = []
    for name, (value, high, low) in RULES.items():
        v = value(Counts() if name == "length" else Shares())
        out.append(F.when(v.between(*high), 1).when(v.between(*low), -1).otherwise(0))
    return F.array(*out)


def fit(patterns: DataFrame, iterations: int = 30) -> DataFrame:
    """Posterior of each pattern: ``patterns`` has votes and n, their number of texts.

    State of the iterations: the share of good texts (``good``), and for each rule the
    shares of high and low votes on good texts and on bad texts (``model``, four
    numbers a rule; the rest abstain).  Shares are smoothed by one text each way."""
    k = len(RULES)
    zeros = F.array(*[F.lit(0.0)] * (4 * k + 2))

    def posterior(state: Column, v: Column) -> Column:
        odds = F.aggregate(F.sequence(F.lit(0), F.lit(k - 1)), F.log(state["good"] / (1 - state["good"])), lambda s, j: s + let(
            F.slice(state["model"], j * 4 + 1, F.lit(4)), lambda m: F.log(
                F.when(F.get(v, j) == 1, m[0] / m[2]).when(F.get(v, j) == -1, m[1] / m[3])
                .otherwise((1 - m[0] - m[1]) / (1 - m[2] - m[3])))))
        return 1 / (1 + F.exp(-odds))

    def weights(r: Column, q: Column) -> Column:
        """What a pattern adds to the sums: texts good and bad; by rule, high and low votes on each."""
        good, bad = r["n"] * q, r["n"] * (1 - q)
        return F.concat(F.array(good, bad), F.flatten(F.transform(r["v"], lambda x: F.array(*[
            F.when(x == vote, w).otherwise(0.0) for w in (good, bad) for vote in (1, -1)]))))

    def step(state: Column, seen: Column) -> Column:
        sums = F.aggregate(seen, zeros, lambda s, r: F.zip_with(
            s, let(posterior(state, r["v"]), lambda q: weights(r, q)), lambda a, b: a + b))

        def shares(s: Column) -> Column:
            def rule(j: Column) -> Column:
                at = j * 4 + 2
                high, low = (F.get(s, at) + 1) / (s[0] + 3), (F.get(s, at + 1) + 1) / (s[0] + 3)
                bad_high, bad_low = (F.get(s, at + 2) + 1) / (s[1] + 3), (F.get(s, at + 3) + 1) / (s[1] + 3)
                # never worse than chance: high votes at least as common on good texts, low ones on bad
                return F.array(high, F.least(low, bad_low), F.least(high, bad_high), bad_low)

            return F.struct(((s[0] + 1) / (s[0] + s[1] + 2)).alias("good"),
                            F.flatten(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), rule)).alias("model"))

        return let(sums, shares)

    start = F.struct(F.lit(START_GOOD).alias("good"), F.array(*[F.lit(x) for x in START_RULE] * k).alias("model"))
    seen = patterns.agg(F.array_sort(F.collect_list(F.struct(
        F.col("votes").alias("v"), F.col("n").cast("double").alias("n")))).alias("seen"))
    model = seen.select("seen", F.aggregate(F.sequence(F.lit(1), F.lit(iterations)), start,
                                            lambda s, _: step(s, F.col("seen"))).alias("model"))
    return model.select("model", F.explode("seen").alias("r")).select(
        F.col("r.v").alias("votes"), posterior(F.col("model"), F.col("r.v")).alias("p_good"))


#: Where the iterations start: most texts are good; shares of high and low votes on good texts, then on bad ones.
START_GOOD = 0.8
START_RULE = (0.7, 0.03, 0.4, 0.3)


def judge(counted: DataFrame, counts: str = "counts", keep_at: float = 0.5) -> DataFrame:
    """``counted`` (with a struct column of text_counts) and p_good, base_failed and kept."""
    rows = counted.select(F.struct(*map(quoted, counted.columns)).alias("row"),
                          votes(F.col(quoted(counts))).alias("votes"))
    posterior = fit(rows.groupBy("votes").agg(F.count("*").alias("n")))
    c = F.col("row")[counts]
    failed = (c["n_words"] < 10) | (100 * c["n_repeat_words"] > 20 * c["n_words"])
    # at most 3**rules rows, however many texts
    return (rows.join(F.broadcast(posterior), "votes", "left")
            .select(*[F.col("row")[x].alias(x) for x in others(counted, ("p_good", "base_failed", "kept"))],
                    "p_good", failed.alias("base_failed"), (~failed & (F.col("p_good") >= keep_at)).alias("kept")))


def quality_rules(docs: DataFrame, text: str = "text", keep_at: float = 0.5) -> DataFrame:
    """``docs`` with the counts, p_good, base_failed and kept.

    The texts are read twice: for the counts of votes, and for each text's own."""
    new = (*COUNTS, "p_good", "base_failed", "kept")
    row = docs.select(F.struct(*map(quoted, docs.columns)).alias("row"),
                      text_counts(F.col(quoted(text))).alias("counts"))
    return judge(row, "counts", keep_at).select(
        *[F.col("row")[x].alias(x) for x in others(docs, new)],
        *[F.col("counts")[x].alias(x) for x in COUNTS], "p_good", "base_failed", "kept")


def keep_good(docs: DataFrame, text: str = "text", keep_at: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns as they were.

    Rows and counts are written to the shared folder first: counting takes longer than that by far, and both the
    votes of all rows and each row's verdict need the counts."""
    spark = docs.sparkSession
    at = f"{scratch_dir(spark, 'counted')}/rows"
    (docs.select(F.struct(*map(quoted, docs.columns)).alias("row"), text_counts(F.col(quoted(text))).alias("counts"))
     .write.parquet(at))
    return judge(spark.read.parquet(at), "counts", keep_at).where("kept").select("row.*")
