"""WARC derivatives: responses become linked metadata and plain-text conversion records.

For each response record the builder makes
- a metadata record (application/warc-fields): title, language, charset, outlinks,
  the status and all header lines of the source, its payload digest and the digest
  of the converted text;
- a conversion record (text/plain; charset=utf-8): the visible text, one line for
  each block of the page, entities resolved.  Responses that are neither HTML nor
  plain text get none.
Both bear WARC-Refers-To with the response's id, its target URI and date, a
WARC-Block-Digest of their own and the source's payload digest
(WARC-Source-Payload-Digest); the metadata record names its conversion record.
Ids are derived from the source's id (name-based UUIDs), so a lost task makes the
same records when it runs again.  No shuffle; a page's title, language, links, text and digests come out of one
linear scan each in Arrow batches of bounded bytes, the records are column expressions.
Elements, comments and tags that are never closed cost no more than others: once an end is not found,
it is not looked for again.

``write_warc`` writes records as WARC files through Spark's text writer (each
record ends with two line ends, which is the writer's line separator), on any
file system Spark knows; ``read_warc`` parses them, whole files at a time.

Defined cases: a null URL gives records without WARC-Target-URI; null content is
an empty page; an empty text gives an empty conversion record; equal rows give equal
records with equal ids; line ends inside header values become spaces.  Title, language and links are
those of HTML pages.  Only the named columns are used; extra ones stay with ``keep``, also those that bear the
name of a result.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackside.llm.common import let, quoted, slices

CRLF = "\r\n"
CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

# Elements that hide their content, and those that end a line.
HIDDEN = "head|noscript|script|style|template"
BLOCKS = ("address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|"
          "h1|h2|h3|h4|h5|h6|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul")
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&amp;": "&"}


def digest(block: Column) -> Column:
    """``sha1:`` and the base-32 form, as WARC writes digests (60, 60 and 40 bits in turn)."""
    def part(h: Column, at: int, n: int) -> Column:
        return F.lpad(F.conv(F.substring(h, at, n), 16, 32), n * 4 // 5, "0")

    return let(F.sha1(block), lambda h: F.concat(F.lit("sha1:"), F.translate(
        F.concat(part(h, 1, 15), part(h, 16, 15), part(h, 31, 10)), CONV32, BASE32)))


def record_id(*parts: Column) -> Column:
    """A name-based UUID of the parts."""
    return let(F.sha1(F.concat_ws("\n", *parts)), lambda h: F.concat(
        F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"),
        F.substring(h, 14, 3), F.lit("-a"), F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12),
        F.lit(">")))


def one_line(c: Column) -> Column:
    return F.regexp_replace(c, r"[\r\n]+", " ")


#: All patterns read ASCII letters and blanks alone, and match in one scan: none runs on to the end of a page and fails.
_ASCII = re.ASCII | re.IGNORECASE
_HIDE = re.compile(rf"<(?:!--|({HIDDEN})\b)", _ASCII)
_HIDE_END = {"": re.compile("-->"), **{n: re.compile(rf"</{n}\s*>", _ASCII) for n in HIDDEN.split("|")}}
_SPACE = re.compile(r"\s+", re.ASCII)
_BLOCK = re.compile(rf" ?</?(?:{BLOCKS})\b[^>]*> ?", _ASCII)
_TAG = re.compile(r"<[a-zA-Z/!?][^>]*>")
_LINES = re.compile(r" *\n[ \n]*")
_TITLE, _TITLE_END = re.compile(r"<title\b[^>]*>", _ASCII), re.compile(r"</title\s*>", _ASCII)
_LINK, _HREF = re.compile(r"<a\b", _ASCII), re.compile(r"""\bhref\s*=\s*["']?([^"'\s>]*)""", _ASCII)
_HTML, _LANG = re.compile(r"<html\b", _ASCII), re.compile(r"\blang\s*=", _ASCII)
_VALUE = re.compile(r"""\s*["']?([^"'\s>]*)""", _ASCII)
_NUMBER = re.compile(r"&#(?:([0-9]{1,7})|[xX]([0-9a-fA-F]{1,6}));")


def without_hidden(html: str) -> str:
    """Comments and hidden elements become spaces; one that is never closed hides nothing."""
    out, at, open_ends = [], 0, set()
    start = _HIDE.search(html)
    while start:
        name = (start[1] or "").lower()
        end = None if name in open_ends else _HIDE_END[name].search(html, start.end())
        if end:
            out += [html[at:start.start()], " "]
            at = end.end()
        else:
            open_ends.add(name)  # no later one is closed either
        start = _HIDE.search(html, at if end else start.end())
    return "".join([*out, html[at:]])


def plain_text(html: str) -> str:
    """The visible text: hidden elements and tags gone, blocks on lines of their own."""
    t = _SPACE.sub(" ", without_hidden(html))
    # behind the last ">" nothing is a tag, and before it every tag has an end
    t = closed(t, lambda x: _BLOCK.sub("\n", x))
    t = closed(t, lambda x: _TAG.sub("", x))
    return _LINES.sub("\n", unescape_entities(t)).strip(" \n")


def closed(t: str, change: Callable[[str], str]) -> str:
    end = t.rfind(">") + 1
    # a blank behind the last tag may belong to it
    end += t[end:end + 1] == " "
    return change(t[:end]) + t[end:]


def unescape_entities(text: str) -> str:
    if "&" not in text:
        return text
    text = _NUMBER.sub(_character, text)
    for name, char in ENTITIES.items():
        text = text.replace(name, char)
    return text


def _character(m: re.Match) -> str:
    """The character of a numeric entity (itself, where the number is none)."""
    code = int(m[1]) if m[1] else int(m[2], 16)
    return chr(code) if 0 < code < 0x110000 and not 0xD800 <= code < 0xE000 else m[0]


def title_of(html: str) -> str:
    start = _TITLE.search(html, 0, html.rfind(">") + 1)
    end = _TITLE_END.search(html, start.end()) if start else None
    return unescape_entities(html[start.end():end.start()]) if end else ""


def tags(html: str, tag: re.Pattern, read: Callable[[int, int], tuple[str, int] | None]) -> Iterator[str]:
    """What ``read`` finds between a tag's name and its end, or the page's; it says where to go on.

    Where it finds nothing there is nothing for the tags inside these bounds either."""
    start = tag.search(html)
    while start:
        end = html.find(">", start.end())
        end = len(html) if end < 0 else end
        found = read(start.end(), end)
        if found:
            yield found[0]
        start = tag.search(html, found[1] if found else end)


def links_of(html: str) -> list[str]:
    """The first link of each anchor."""
    def first(a: int, b: int) -> tuple[str, int] | None:
        m = _HREF.search(html, a, b)
        return m and (m[1], m.end())

    return [unescape_entities(x) for x in tags(html, _LINK, first)]


def language_of(html: str) -> str:
    """The last language of the first html tag that has one."""
    def last(a: int, b: int) -> tuple[str, int] | None:
        found = [m.end() for m in _LANG.finditer(html, a, b)]
        return (_VALUE.match(html, found[-1])[1], b) if found else None

    return next(tags(html, _HTML, last), "")


def base32_digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


FACTS = T.StructType([T.StructField(n, T.StringType()) for n in ("source_digest", "title", "language", "text", "text_digest")]
                     + [T.StructField("links", T.ArrayType(T.StringType()))])


def with_facts(pages: DataFrame) -> DataFrame:
    """``pages`` with what their payload says; only those with ``is_page`` are read as HTML."""
    names = pages.columns
    at, flag = names.index("payload"), names.index("is_page")

    def facts(body: bytes, is_page: bool) -> tuple:
        if not is_page:
            return base32_digest(body), "", "", None, None, []
        html = body.decode("utf-8", "replace")
        text = plain_text(html)
        return base32_digest(body), title_of(html), language_of(html), text, base32_digest(text.encode()), links_of(html)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at):
                rows = [facts(b, p) for b, p in zip(part.column(at).cast(pa.binary()).to_pylist(), part.column(flag).to_pylist())]
                made = [pa.array(c, pa.list_(pa.string()) if f.name == "links" else pa.string())
                        for c, f in zip(zip(*rows), FACTS)]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*names, *FACTS.names])

    return pages.mapInArrow(run, T.StructType([*pages.schema, *FACTS]))


def responses_from_pages(pages: DataFrame, date: str = "1970-01-01T00:00:00Z", keep=()) -> DataFrame:
    """Response records of pages (url, html): record_id, target_uri, date, http_headers, payload."""
    body = F.coalesce(F.col("html").cast("string"), F.lit(""))
    uri = one_line(F.col("url"))
    return pages.select(*map(quoted, keep),
                        record_id(F.lit("response"), F.coalesce(uri, F.lit("")), F.sha1(body)).alias("record_id"),
                        uri.alias("target_uri"), F.lit(date).alias("date"),
                        F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"
                                       "Content-Length: "), F.octet_length(body).cast("string")).alias("http_headers"),
                        body.alias("payload"))


def derive(responses: DataFrame, keep=()) -> DataFrame:
    """Metadata and conversion records of responses.

    Columns: ``keep``, record_type, record_id, refers_to, target_uri, date,
    content_type, source_digest, block_digest, content_length, and record (the
    whole record: header lines, an empty line, block)."""
    kept = [f"keep_{k}" for k in range(len(keep))]
    kind = F.coalesce(F.lower(F.regexp_extract("http_headers", r"(?im)^content-type:[ \t]*([^;\s]*)", 1)), F.lit(""))
    page = with_facts(responses.select(
        *[F.col(quoted(c)).alias(k) for c, k in zip(keep, kept)], "record_id", "target_uri", "date",
        F.coalesce("http_headers", F.lit("")).alias("http_headers"),
        F.coalesce(F.col("payload").cast("string"), F.lit("")).alias("payload"),
        kind.isin("text/html", "application/xhtml+xml").alias("is_page"), (kind == "text/plain").alias("is_text")))
    page = (page.withColumn("text_digest", F.when(F.col("is_text"), F.col("source_digest")).otherwise(F.col("text_digest")))
            .withColumn("text", F.when(F.col("is_text"), F.col("payload")).otherwise(F.col("text")))
            .withColumn("meta_id", record_id(F.lit("metadata"), F.col("record_id")))
            .withColumn("text_id", record_id(F.lit("conversion"), F.col("record_id"))))

    fields = F.concat(
        _field("title", F.trim(one_line(F.col("title")))),
        _field("language", F.col("language")),
        _field("charset", F.regexp_extract("http_headers", r"(?im)^content-type:.*?charset=([^;\s]*)", 1)),
        _field("http-status", F.regexp_extract("http_headers", r"\A\S+ ([0-9]{3})", 1)),
        F.array_join(F.transform(F.filter(F.split("http_headers", r"\r?\n"), lambda x: F.contains(x, F.lit(":"))),
                                 lambda x: _field("http-header", x)), ""),
        _field("source-payload-digest", F.col("source_digest")),
        F.when(F.col("text").isNotNull(), F.concat(_field("conversion", F.col("text_id")),
                                                   _field("conversion-digest", F.col("text_digest"))))
        .otherwise(F.lit("")),
        F.array_join(F.transform("links", lambda x: _field("outlink", x)), ""))
    meta = F.struct(F.lit("metadata").alias("record_type"), F.col("meta_id").alias("record_id"),
                    F.lit("application/warc-fields").alias("content_type"), fields.alias("block"),
                    F.lit(None).cast("string").alias("digest"))
    text = F.struct(F.lit("conversion").alias("record_type"), F.col("text_id").alias("record_id"),
                    F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("text").alias("block"),
                    F.col("text_digest").alias("digest"))
    out = page.select(*kept, F.col("record_id").alias("refers_to"), "target_uri", "date", "source_digest",
                      F.explode(F.filter(F.array(meta, text), lambda r: r["block"].isNotNull())).alias("r"))
    out = out.withColumn("block_digest", F.coalesce(F.col("r.digest"), digest(F.col("r.block"))))
    size = F.octet_length("r.block").cast("long")
    header = F.concat_ws(CRLF, F.lit("WARC/1.1"),
                         _header("WARC-Type", F.col("r.record_type")),
                         _header("WARC-Record-ID", F.col("r.record_id")),
                         _header("WARC-Refers-To", F.col("refers_to")),
                         _header("WARC-Target-URI", F.col("target_uri")),
                         _header("WARC-Date", F.col("date")),
                         _header("WARC-Block-Digest", F.col("block_digest")),
                         _header("WARC-Source-Payload-Digest", F.col("source_digest")),
                         _header("Content-Type", F.col("r.content_type")),
                         _header("Content-Length", size.cast("string")))
    return out.select(*[F.col(k).alias(c) for c, k in zip(keep, kept)], "r.record_type", "r.record_id", "refers_to", "target_uri", "date",
                      "r.content_type", "source_digest", "block_digest", size.alias("content_length"),
                      F.concat(header, F.lit(CRLF + CRLF), F.col("r.block")).alias("record"))


def _field(name: str, value: Column) -> Column:
    return F.when(F.coalesce(value, F.lit("")) == "", F.lit("")) \
        .otherwise(F.concat(F.lit(f"{name}: "), one_line(value), F.lit(CRLF)))


def _header(name: str, value: Column) -> Column:
    """Null without a value, so that the line is left out."""
    return F.concat(F.lit(f"{name}: "), value)


def write_warc(records: DataFrame, path: str) -> None:
    """The column ``record`` as WARC files, one for each partition."""
    records.select("record").write.option("lineSep", CRLF + CRLF).text(path)


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of a WARC file, plain or gzip."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    at = 0
    while (start := content.find(b"WARC/", at)) >= 0:
        end = content.index(b"\r\n\r\n", start)
        lines = content[start:end].decode("utf-8", "replace").split(CRLF)[1:]
        fields = {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        at = end + 4 + int(fields["Content-Length"])
        yield fields, content[end + 4:at]


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files: type, record_id, target_uri, date, refers_to, fields and
    block; of responses also http_headers and payload.  A task holds one file."""
    names = ["record_type", "record_id", "target_uri", "date", "refers_to", "fields", "block",
             "http_headers", "payload"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                for f, block in parse_warc(bytes(content)):
                    http, _, body = block.partition(b"\r\n\r\n") if f.get("WARC-Type") == "response" else (None, 0, None)
                    yield pd.DataFrame([(f.get("WARC-Type"), f.get("WARC-Record-ID"), f.get("WARC-Target-URI"),
                                         f.get("WARC-Date"), f.get("WARC-Refers-To"), f, block,
                                         None if http is None else http.decode("utf-8", "replace"), body)],
                                       columns=names)

    return (spark.read.format("binaryFile").load(path).select("content")
            .mapInPandas(run, "record_type string, record_id string, target_uri string, date string, "
                              "refers_to string, fields map<string,string>, block binary, "
                              "http_headers string, payload binary"))
