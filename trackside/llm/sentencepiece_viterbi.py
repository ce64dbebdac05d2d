"""SentencePiece encoding and decoding by a shared-prefix Viterbi search.

A text gets a space in front, and is cut into marked words: the spaces before a
word belong to it (they are the marks), a line feed stands alone.  No piece of the
model crosses such a cut, so words are segmented on their own, each distinct one
of a run of rows once.  The distinct words are sorted and taken as a trie that is
walked depth-first: the forward scores of a word are a stack over its characters,
and the next word keeps those of the prefix it shares with the one before.  For
each new character the best segmentation that ends there is found over all pieces
that end there.  A character that no piece covers is split into its byte pieces.

The segmentation is the one with the highest sum of piece scores; of equal ones,
that whose last piece is longest.  A unigram model's scores are log probabilities
and are taken as they are.  A BPE model's scores are the ranks of its merges; by
Zipf's law a piece of rank r gets -log(r + ``RANK_OFFSET``).  The search then gives
the likeliest segmentation, which may differ from the one that merging gives;
decoding is exact for either.  Only the vocabulary file is read, nothing is trained.

Decoding joins the pieces, turns marks into spaces and byte pieces into bytes and
drops the leading space.  A mark character (U+2581) in a text is not a space: it
is encoded by bytes, so every text comes back unchanged.

The work stays in the tasks that read the rows (no shuffle): memory is bounded by
the words of some ``SLICE_BYTES`` of text (one text at least), by ``DECODE_IDS`` ids and by a cache of at most
``CACHE_WORDS`` words.  Of a word, the pieces begun at each character are kept for the first ``STACK``
characters, which later words may share; behind them a character takes 16 bytes.  ``encode`` can say in the
same pass whether the ids decode to the text; a worker that only decodes holds no trie.

Defined cases: a null text has null ids and decodes to null, an empty text has no
ids.  Bytes that are not UTF-8 become U+FFFD before encoding.  Repeated rows give
repeated results.  Extra columns pass through; those named like a result are replaced.
"""

from __future__ import annotations

import itertools
import math
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from trackside.llm.common import add_columns

MARK = "▁"
WORD = re.compile(r" *[^ \n]+| +|\n")
#: Bounds of what a task holds: text encoded at once, words kept for later, ids decoded at once (one row at least).
SLICE_BYTES, CACHE_WORDS, DECODE_IDS = 2 << 20, 100_000, 500_000
#: Characters of a word whose search state later words may go on from.
STACK = 64
RANK_OFFSET = 100


class Pieces:
    """Pieces and scores of a model file's content, marks written as spaces; decoding."""

    def __init__(self, content: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=content)
        self.pieces: dict[str, tuple[int, float]] = {}
        self.bytes_of: list[bytes] = []
        self.byte_ids = [-1] * 256
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            out = b""
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                out = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                marked = piece.replace(MARK, " ")
                self.pieces[marked] = (i, sp.get_score(i))
                out = marked.encode()
            self.bytes_of.append(out)
        self.sizes = np.array([len(b) for b in self.bytes_of])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.all_bytes = np.frombuffer(b"".join(self.bytes_of), np.uint8)

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The bytes of each row of ids; ``ends`` are the rows' ends among all ids, after a 0."""
        size = self.sizes[ids]
        stop = np.cumsum(size)
        place = np.arange(stop[-1] if len(stop) else 0) + np.repeat(self.starts[ids] - (stop - size), size)
        text = self.all_bytes[place].tobytes()
        cut = np.concatenate(([0], stop))[ends].tolist()
        return [text[a + text.startswith(b" ", a, b):b] for a, b in zip(cut, cut[1:])]


class Model(Pieces):
    """The pieces as a trie, for encoding."""

    def __init__(self, content: bytes):
        super().__init__(content)
        if -1 in self.byte_ids:
            raise ValueError("the model needs byte pieces, or unknown characters would be lost")
        if any("\n" in p or " " in p.lstrip(" ") for p in self.pieces):
            raise ValueError("a piece crosses the end of a word")
        if all(s == int(s) for _, s in self.pieces.values()):
            self.pieces = {p: (i, -math.log(RANK_OFFSET - s)) for p, (i, s) in self.pieces.items()}
        self.unknown = min(s for _, s in self.pieces.values()) - 10
        #: the pieces as a trie: a node is [children by character, id (-1: no piece), score]
        self.root: list = [{}, -1, 0.0]
        for piece, (i, score) in self.pieces.items():
            node = self.root
            for c in piece:
                node = node[0].setdefault(c, [{}, -1, 0.0])
            node[1:] = i, score

    def segment(self, words: list[str]) -> dict[str, bytes]:
        """Ids (32-bit) of each of some distinct words.

        At each depth stand the best score of the prefix, the start and id of its last
        piece, and (to depth ``STACK``) the pieces begun in it that may go on: (their start's score, start, node)."""
        out = {}
        first = self.root[0]
        score, back, ids, begun = array("d", [0.0]), array("l", [0]), array("i", [-1]), [()]
        last = ""
        for word in sorted(words):
            shared = 0
            for a, b in zip(last[:STACK], word):
                if a != b:
                    break
                shared += 1
            del score[shared + 1:], back[shared + 1:], ids[shared + 1:], begun[shared + 1:]
            state = begun[shared]
            for at in range(shared, len(word)):
                c = word[at]
                best, start, piece, going = None, at, -1, []
                for s, from_, node in state:   # those that began first come first
                    node = node[0].get(c)
                    if node is not None:
                        if node[1] >= 0 and (best is None or s + node[2] > best):
                            best, start, piece = s + node[2], from_, node[1]
                        if node[0]:
                            going.append((s, from_, node))
                node = first.get(c)
                if node is not None:
                    s = score[at]
                    if node[1] >= 0 and (best is None or s + node[2] > best):
                        best, start, piece = s + node[2], at, node[1]
                    if node[0]:
                        going.append((s, at, node))
                if (node is None or node[1] < 0) and (best is None or score[at] + self.unknown > best):
                    best, start, piece = score[at] + self.unknown, at, -1
                score.append(best)
                back.append(start)
                ids.append(piece)
                state = going
                if at < STACK:
                    begun.append(going)
            path, end = [], len(word)
            while end:
                if ids[end] >= 0:
                    path.append(ids[end])
                else:
                    path.extend(self.byte_ids[b] for b in reversed(word[end - 1].encode()))
                end = back[end]
            path.reverse()
            out[word] = array("i", path).tobytes()
            last = word
        return out


@lru_cache(maxsize=2)
def _pieces(content: bytes) -> Pieces:
    return Pieces(content)


@lru_cache(maxsize=2)
def _model(content: bytes) -> tuple[Model, dict[str, bytes]]:
    return Model(content), {}


def read_model(spark: SparkSession, path: str) -> bytes:
    """The model file's content, read by Spark (any file system it knows)."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def encode(df: DataFrame, model: bytes, text: str = "text", ids: str = "ids", round_trip: str | None = None) -> DataFrame:
    """``df`` with the array of piece ids of column ``text``, and (if ``round_trip`` names a column) whether
    decoding them gives the text's very bytes back (null ids give a null text back)."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def make(texts: list) -> list[pa.Array]:
        m, known = _model(sent.value)
        coded = encode_texts(m, known, texts)
        ends = np.cumsum([0, *[len(c) // 4 for c in coded]]).astype(np.int32)
        flat = np.frombuffer(b"".join(coded), np.int32)
        made = [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat), mask=pa.array([t is None for t in texts]))]
        if round_trip:
            same = [back == (t or b"")
                    for (a, b) in id_slices(ends) for back, t in zip(m.decode_all(flat[ends[a]:ends[b]], ends[a:b + 1] - ends[a]), texts[a:b])]
            made.append(pa.array(same, pa.bool_()))
        return made

    fields = [T.StructField(ids, T.ArrayType(T.IntegerType())), *([T.StructField(round_trip, T.BooleanType())] if round_trip else [])]
    return add_columns(df, text, fields, make, SLICE_BYTES)


def encode_texts(model: Model, known: dict[str, bytes], texts: list[bytes | None]) -> list[bytes]:
    """The ids (32-bit) of each text; ``known`` are the words segmented before, ``CACHE_WORDS`` at most between calls."""
    numbers: dict[str, int] = {}
    number = numbers.setdefault
    rows = [[number(w, len(numbers)) for w in WORD.findall(" " + t.decode("utf-8", "replace"))] if t else () for t in texts]
    known.update(model.segment([w for w in numbers if w not in known]))
    parts = [known[w] for w in numbers]
    if len(known) > CACHE_WORDS:
        # words of these rows are the likeliest to come again
        known.clear()
        known.update(itertools.islice(zip(numbers, parts), CACHE_WORDS))
    return [b"".join([parts[i] for i in row]) for row in rows]


def id_slices(ends: np.ndarray) -> list[tuple[int, int]]:
    """Runs of rows with about ``DECODE_IDS`` ids together; ``ends`` are the rows' ends among all ids, after a 0."""
    starts = np.flatnonzero(np.diff(ends[:-1] // DECODE_IDS, prepend=-1)).tolist()
    return list(zip(starts, [*starts[1:], len(ends) - 1]))


def decode(df: DataFrame, model: bytes, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text that the ids of column ``ids`` stand for."""
    sent = df.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in df.columns if c.lower() != text.lower()]
    src = df.select(*[f"`{c}`" for c in keep])
    at = keep.index(ids)

    def run(batches):
        m = _pieces(sent.value)
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(at)), 0).to_numpy()
            for a, b in id_slices(np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))):
                part = batch.slice(a, b - a)
                rows = part.column(at)
                ends = np.concatenate(([0], np.cumsum(sizes[a:b], dtype=np.int64)))
                texts = m.decode_all(rows.flatten().to_numpy(), ends)
                made = pa.array([t.decode("utf-8", "replace") if ok else None
                                 for t, ok in zip(texts, rows.is_valid().to_pylist())], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=[*keep, text])

    return src.mapInArrow(run, T.StructType([*src.schema.fields, T.StructField(text, T.StringType())]))
