"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example: all preceding turns are its context
and only its own text is trainable.  ``format_turns`` makes one segment of each
turn, with its place in the conversation; ``examples`` names the prefix each example
consists of: example k of a conversation is the segments 0..seq of its target, its
trainable characters lie at [loss_start, loss_end) of that prefix.  ``write_out``
expands them to full texts, and ``read_back`` reads those: each reply out of its own
example, the turns out of the whole conversation that closes its examples.

The examples of one conversation hold each turn once for every later reply, so what is
written grows with the square of its turns.  A task holds one conversation's text and
the examples it hands over next (BATCH_CHARS, or one example if that is longer).

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn.  Inside role and
text a backslash is doubled and ``<|`` becomes ``<\\|`` (and in a role a line feed
``\\n``), so no control string can stem from a text, and ``parse_segment``
gives back exactly what went in.

Defined cases: turns are ordered by turn, null first, then role and text, so that
ties and repeated rows have one order; repeated rows stay.  Null role and text
are empty; null conv_id is a conversation of its own.  A conversation without
assistant turns has segments and no example.  Extra columns are not carried.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"
BATCH_CHARS = 4_000_000


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(s: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], s)


def parse_segment(segment: str) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    if not (segment.startswith(START) and segment.endswith(END + "\n")):
        raise ValueError("not a formatted turn")
    role, _, text = segment[len(START):-len(END) - 1].partition("\n")
    if "<|" in text or "<|" in role:
        raise ValueError("control string inside a turn")
    return unescape(role), unescape(text)


def format_turns(turns: DataFrame) -> DataFrame:
    """One row for each turn: conv_id, seq, segment, its place in the conversation's
    text (char_start, char_end), and for assistant turns example (from 0) and the
    trainable characters loss_start and loss_end."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(START), F.replace(escape(role), F.lit("\n"), F.lit("\\n")), F.lit("\n"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    sofar = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    trained = F.col("role") == TRAINED
    return (turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
            .withColumns({"head": head, "body": escape(F.col("text"))})
            .withColumn("segment", F.concat("head", "body", F.lit(END + "\n")))
            .withColumns({"seq": F.row_number().over(order) - 1,
                          "char_end": F.sum(F.length("segment").cast("long")).over(sofar),
                          "examples": F.sum(F.when(trained, 1).otherwise(0)).over(sofar)})
            .withColumn("char_start", F.col("char_end") - F.length("segment"))
            .select("conv_id", "seq", "segment", "char_start", "char_end",
                    F.when(trained, F.col("examples") - 1).alias("example"),
                    F.when(trained, F.col("char_start") + F.length("head")).alias("loss_start"),
                    F.when(trained, F.col("char_start") + F.length("head") + F.length("body")).alias("loss_end")))


def examples(segments: DataFrame) -> DataFrame:
    """One row for each assistant turn: its prefix of segments and its trainable span."""
    return segments.where(F.col("example").isNotNull()).select(
        "conv_id", "example", F.col("seq").alias("target_seq"), F.col("char_end").alias("n_chars"),
        "loss_start", "loss_end")


def write_out(segments: DataFrame) -> DataFrame:
    """The examples with their whole text: as many characters as all prefixes together."""
    return _expand(segments, closed=False)


def _expand(segments: DataFrame, closed: bool) -> DataFrame:
    """The written examples of each conversation in order; if ``closed``, then the whole
    conversation as one more row without example and span."""
    cols = ["conv_id", "example", "text", "loss_start", "loss_end"]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=cols).astype({"example": "Int32", "loss_start": "Int64", "loss_end": "Int64"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, text, rows, size = None, None, [], 0
        for batch in batches:
            for r in batch.itertuples(index=False):
                if r.seq == 0:
                    if closed and text is not None:
                        rows.append((conv, None, text, None, None))
                        size += len(text)
                    conv, text = None if pd.isna(r.conv_id) else r.conv_id, ""
                text += r.segment
                if not pd.isna(r.example):
                    rows.append((conv, int(r.example), text, int(r.loss_start), int(r.loss_end)))
                    size += len(text)
                if size >= BATCH_CHARS:
                    yield frame(rows)
                    rows, size = [], 0
        if closed and text is not None:
            rows.append((conv, None, text, None, None))
        if rows:
            yield frame(rows)

    return (segments.repartition("conv_id").sortWithinPartitions("conv_id", "seq")
            .mapInPandas(run, f"conv_id {segments.schema['conv_id'].dataType.simpleString()}, "
                              "example int, text string, loss_start long, loss_end long"))


def read_back(segments: DataFrame) -> DataFrame:
    """Digests of what the written examples say.

    n_turns; turns_sha256 of role, line feed, text, line feed for each turn;
    loss_chars and loss_sha256 of the trainable text, unescaped; formatted_chars;
    n_examples and example_chars, the characters of all examples.
    """
    return read_examples(_expand(segments, closed=True))


def read_examples(written: DataFrame) -> DataFrame:
    """The digests of ``read_back`` out of written examples, each conversation's in order and closed
    by its whole text.  An example that does not continue the one before it is refused."""
    kind = written.schema["conv_id"].dataType.simpleString()
    cols = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars",
            "n_examples", "example_chars"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context, loss, loss_chars, n_examples, example_chars = "", hashlib.sha256(), 0, 0, 0
        for batch in batches:
            done = []
            for r in batch.itertuples(index=False):
                if not r.text.startswith(context):
                    raise ValueError("an example does not start with the one before it")
                if not pd.isna(r.example):
                    under = unescape(r.text[int(r.loss_start):int(r.loss_end)])
                    loss.update(under.encode())
                    context, loss_chars = r.text, loss_chars + len(under)
                    n_examples, example_chars = n_examples + 1, example_chars + len(r.text)
                    continue
                turns, n_turns = hashlib.sha256(), 0
                *formatted, after = r.text.split(END + "\n")
                if after:
                    raise ValueError("not a formatted conversation")
                for segment in formatted:
                    role, text = parse_segment(segment + END + "\n")
                    turns.update(f"{role}\n{text}\n".encode())
                    n_turns += 1
                done.append((None if pd.isna(r.conv_id) else r.conv_id, n_turns, turns.hexdigest(), loss_chars,
                             loss.hexdigest(), len(r.text), n_examples, example_chars))
                context, loss, loss_chars, n_examples, example_chars = "", hashlib.sha256(), 0, 0, 0
            if done:
                yield pd.DataFrame(done, columns=cols)

    return written.mapInPandas(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
                                    "loss_sha256 string, formatted_chars long, n_examples long, example_chars long")
