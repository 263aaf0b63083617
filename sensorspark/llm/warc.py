"""WARC derivatives: responses become linked metadata and plain-text conversion records.

Every response gives two records that refer to it by its identifier, target and date, and to
each other: a `metadata` record (title, language, outlinks, the response's own headers and
payload digest) and a `conversion` record, the page's text. Record identifiers follow from the
response and the type, so a retried task writes the same ones. `write` stores records as
gzipped WARC files through Spark's text sink, whose line separator is the blank line between records.

Rows are independent and nothing is shuffled. Markup is read by the standard library's parser in
Arrow batches; headers, digests and record layout are built-in expressions.

Edge cases: a missing payload is an empty page (both records exist, with an empty text); missing
targets and dates leave their headers out; repeated rows give the same records again; line
breaks inside header values become blanks; other columns of the input are never read.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EOL = "\r\n"
DEFAULT_DATE = "1970-01-01T00:00:00Z"
_HIDDEN = {"script", "style", "noscript", "template", "title"}
_BLOCKS = {"address", "article", "aside", "blockquote", "br", "dd", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer",
           "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "li", "main", "nav", "ol", "p", "pre", "section", "table",
           "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "option", "body", "html", "head"}


class _Page(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.title: list[str] = []
        self.links: list[str] = []
        self.lang: str | None = None
        self.hidden: list[str] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _HIDDEN:
            self.hidden.append(tag)
        elif tag in _BLOCKS:
            self.parts.append("\n")
        values = dict(attrs)
        if tag in ("a", "area") and values.get("href"):
            self.links.append(" ".join(values["href"].split()))
        if tag == "html" and values.get("lang"):
            self.lang = values["lang"]

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag in _HIDDEN:
            self.hidden.pop()

    def handle_endtag(self, tag: str) -> None:
        if tag in self.hidden:
            while self.hidden.pop() != tag:
                pass
        elif tag in _BLOCKS:
            self.parts.append("\n")

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.parts.append(data)
        elif self.hidden[-1] == "title":
            self.title.append(data)


def read_page(html: str) -> tuple[str, str, str | None, list[str]]:
    """(text, title, language, links) of a page; one line per block, blanks collapsed."""
    page = _Page()
    page.feed(html)
    page.close()
    lines = (" ".join(line.split()) for line in "".join(page.parts).split("\n"))
    return "\n".join(line for line in lines if line), " ".join("".join(page.title).split()), page.lang, page.links


_PAGE = T.StructType([T.StructField("text", T.StringType()), T.StructField("title", T.StringType()),
                      T.StructField("lang", T.StringType()), T.StructField("links", T.ArrayType(T.StringType()))])


@F.arrow_udf(_PAGE)
def _pages(payloads: pa.Array) -> pa.Array:
    kind = pa.struct([("text", pa.string()), ("title", pa.string()), ("lang", pa.string()), ("links", pa.list_(pa.string()))])
    rows = [dict(zip(("text", "title", "lang", "links"), read_page(p.as_py() or ""), strict=True)) for p in payloads]
    return pa.array(rows, kind)


def urn(*parts: Column) -> Column:
    """Identifier that follows from the parts, in the form of a version 3 UUID."""
    h = F.md5(F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))
    piece = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), piece(1, 8), F.lit("-"), piece(9, 4), F.lit("-3"), piece(14, 3), F.lit("-a"), piece(18, 3),
                    F.lit("-"), piece(21, 12), F.lit(">"))


def digest(block: Column) -> Column:
    """SHA-1 in base 32, as WARC files label it; each five hexadecimal digits are four of base 32."""
    digits = F.transform(F.sequence(F.lit(1), F.lit(36), F.lit(5)), lambda i: F.lpad(
        F.conv(F.substr(F.sha1(block.cast("binary")), i, F.lit(5)), 16, 32), 4, "0"))
    return F.concat(F.lit("sha1:"), F.translate(F.upper(F.array_join(digits, "")), "0123456789ABCDEFGHIJKLMNOPQRSTUV",
                                                "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"))


def _field(name: str, value: Column) -> Column:
    """A header line, or NULL without a value."""
    return F.when(value.isNotNull() & (value != ""), F.concat(F.lit(f"{name}: "), F.regexp_replace(value, r"[\r\n]+", " "), F.lit(EOL)))


def responses(pages: DataFrame, date: str = DEFAULT_DATE) -> DataFrame:
    """(page_id, record_id, target_uri, date, http_headers, payload, payload_digest) for (page_id, url, html)."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    headers = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "),
                       F.octet_length(payload).cast("string"), F.lit(EOL))
    shown = pages.select(F.col("page_id"), F.col("url").alias("target_uri"), F.lit(date).alias("date"), headers.alias("http_headers"),
                         payload.alias("payload"), digest(payload).alias("payload_digest"))
    return shown.withColumn("record_id", urn(F.lit("response"), F.col("page_id"), F.col("target_uri"), F.col("payload_digest")))


def derive(source: DataFrame) -> DataFrame:
    """Two records per response row: (page_id, warc_type, record_id, concurrent_to, refers_to, target_uri, date, content_type,
    source_headers, source_digest, block, block_digest, content_length)."""
    meta_id, text_id = urn(F.lit("metadata"), F.col("record_id")), urn(F.lit("conversion"), F.col("record_id"))
    read = source.withColumn("_page", _pages(F.coalesce(F.col("payload"), F.lit(""))))
    page = F.col("_page")
    http = F.filter(F.split(F.coalesce("http_headers", F.lit("")), r"\r?\n"), lambda h: F.trim(h) != "")
    fields = F.concat_ws(
        "", _field("title", page["title"]), _field("language", page["lang"]), _field("conversion", text_id),
        _field("source-record", F.col("record_id")), _field("source-payload-digest", F.col("payload_digest")),
        F.array_join(F.transform(http, lambda h: F.concat(F.lit("source-header: "), h, F.lit(EOL))), ""),
        F.array_join(F.transform(page["links"], lambda u: F.concat(F.lit("outlink: "), u, F.lit(f" L a/@href{EOL}"))), ""))
    record = lambda kind, own, other, mime, block: F.struct(
        F.lit(kind).alias("warc_type"), own.alias("record_id"), other.alias("concurrent_to"), F.lit(mime).alias("content_type"), block.alias("block"))
    both = F.array(record("metadata", meta_id, text_id, "application/warc-fields", fields),
                   record("conversion", text_id, meta_id, "text/plain; charset=utf-8", page["text"]))
    out = read.select("page_id", F.col("record_id").alias("refers_to"), "target_uri", "date", F.col("http_headers").alias("source_headers"),
                      F.col("payload_digest").alias("source_digest"), F.inline(both))
    return out.withColumns({"block_digest": digest(F.col("block")), "content_length": F.octet_length("block").cast("bigint")})


def record_text(source: DataFrame) -> DataFrame:
    """(value): each derived record as it stands in a file, without the blank line that ends it."""
    head = F.concat_ws(
        "", F.lit(f"WARC/1.1{EOL}"), *[_field(name, F.col(c).cast("string")) for name, c in (
            ("WARC-Type", "warc_type"), ("WARC-Record-ID", "record_id"), ("WARC-Date", "date"), ("WARC-Target-URI", "target_uri"),
            ("WARC-Refers-To", "refers_to"), ("WARC-Refers-To-Target-URI", "target_uri"), ("WARC-Refers-To-Date", "date"),
            ("WARC-Concurrent-To", "concurrent_to"), ("WARC-Block-Digest", "block_digest"), ("WARC-Payload-Digest", "block_digest"),
            ("Content-Type", "content_type"), ("Content-Length", "content_length"))])
    return source.select(F.concat(head, F.lit(EOL), F.col("block")).alias("value"))


def write(source: DataFrame, path: str, compression: str = "gzip") -> None:
    """Derived records as WARC files, one per partition."""
    record_text(source).write.option("lineSep", EOL + EOL).option("compression", compression).text(path)
