"""Derived WARC records: from responses to linked metadata and plain-text conversion records.

A response is a record id, target URI, date, HTTP header and payload. From each come two records
that refer to it by ``WARC-Refers-To`` and to each other by ``WARC-Concurrent-To``, with its
URI, date and payload digest: metadata (title, language, character set, the source's headers
and its links, resolved) and conversion (the readable text below the title). Record ids are derived from the
source id and the kind, so a second run gives the same records.

Pages are independent, so there is no shuffle, and a page of any kind is one row's work.
Records are written as text whose line end is the WARC record end, so Spark's writer makes
WARC files in any store.

Defined results: a null page is an empty payload with an empty conversion; a null URL leaves
the URI header out and links unresolved; repeated rows give repeated records with equal ids;
an empty table gives none; columns of other names are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import urldefrag, urljoin

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from kvartal.llm.frames import bounded_batches
from kvartal.llm.words import utf8

VERSION = "WARC/1.1"
RECORD_END = "\r\n\r\n"
#: date of responses that are made from a table without dates
DATE = "2026-01-01T00:00:00Z"
#: records read from a file that are held at a time
RECORDS_AT_ONCE = 1000
NAMES = uuid.uuid5(uuid.NAMESPACE_URL, "urn:derived-records")

RESPONSES = (
    "page_id long, record_id string, target_uri string, date string, http_header string, "
    "payload string, payload_digest string"
)
RECORDS = (
    "page_id long, record_type string, record_id string, refers_to string, target_uri string, "
    "content_type string, payload_digest string, block_digest string, content_length long, "
    "header string, block string"
)

_HIDDEN = "script|style|template|noscript|svg|iframe|object"
#: not shown; the second and fourth group say that nothing closes it
_SKIPPED = re.compile(
    rf"(<!--).*?(?:-->|(\Z))|<({_HIDDEN})\b[^>]*+>.*?(?:</\3\s*+>|(\Z))|<[!?][^>]*+>", re.S | re.I
)
_TITLE = re.compile(r"<title\b[^>]*>(.*?)(?:</title\s*>|\Z)", re.S | re.I)
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]++)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""")
#: tags that end a line of text
_LINES = frozenset(
    "address article aside blockquote body br caption dd div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol option p pre section "
    "table tbody td tfoot th thead title tr ul".split()
)
#: tags with links, and the attribute
_LINKS = {"a": "href", "area": "href", "link": "href", "img": "src", "source": "src", "form": "action"}


# ---------------------------------------------------------------- one page


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_name(source: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'{source} {kind}')}>"


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape(next((v for v in values if v), "")))
    return found


def _resolved(base: str | None, link: str) -> str:
    link = " ".join(link.split())
    try:
        return urldefrag(urljoin(base or "", link)).url
    except ValueError:  # no address at all; kept as written
        return link


def _one_line(value: str) -> str:
    """Without line breaks and other control characters, which would begin fields of their own."""
    return " ".join(re.sub(r"[\x00-\x1f\x7f-\x9f\u2028\u2029]", " ", value).split())


def _shown(page: str) -> tuple[str, int]:
    """The page without hidden parts, and the end of its last tag.

    Markup ends before the last angle bracket, so patterns that look for one always find it and
    none is looked for twice.
    """
    end, opened = page.rfind(">") + 1, False

    def skipped(found: re.Match) -> str:
        nonlocal opened
        opened = found[2] is not None or found[4] is not None
        return " "

    visible = _SKIPPED.sub(skipped, page[:end])
    rest = "" if opened else page[end:].partition("<!--")[0]
    return visible + rest, len(visible)


def read_page(page: str, url: str | None) -> dict:
    """Title, language, character set, links in order without repeats, and readable text."""
    title = _TITLE.search(page, 0, page.rfind(">") + 1)
    visible, end = _shown(page)
    lang, charset, base, links, parts, done = "", "", url, {}, [], 0
    in_title = 0
    for tag in _TAG.finditer(visible, 0, visible.rfind(">", 0, end) + 1):
        if not in_title:
            parts.append(visible[done : tag.start()])
        done = tag.end()
        closes, name = tag[1], tag[2].lower()
        if name in _LINES:
            parts.append("\n")
        if name == "title":
            in_title = not closes
        if closes:
            continue
        if name in _LINKS or name in ("html", "meta", "base"):
            attributes = _attributes(tag[3])
            if name == "html":
                lang = lang or attributes.get("lang", "")
            elif name == "meta":
                charset = charset or attributes.get("charset", "")
            elif name == "base":
                base = _resolved(url, attributes.get("href", ""))
            elif link := attributes.get(_LINKS[name]):
                links.setdefault((_resolved(base, link), f"{name}/@{_LINKS[name]}"))
    if not in_title:
        parts.append(visible[done:])
    lines = (" ".join(html.unescape(line).split()) for line in "".join(
        re.sub(r"\s", " ", part) if part != "\n" else part for part in parts
    ).split("\n"))
    return {
        "title": " ".join(html.unescape(title[1]).split()) if title else "",
        "lang": lang, "charset": charset, "links": list(links),
        "text": "\n".join(line for line in lines if line),
    }


def _record(kind: str, source, content_type: str, block: str, beside: str) -> tuple:
    name = record_name(source.record_id, kind)
    data = utf8(block)
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", source.date),
        ("WARC-Target-URI", source.target_uri), ("WARC-Refers-To", source.record_id),
        ("WARC-Concurrent-To", record_name(source.record_id, beside)),
        ("WARC-Source-Payload-Digest", source.payload_digest),
        ("WARC-Block-Digest", digest(data)), ("Content-Type", content_type),
        ("Content-Length", str(len(data))),
    ]
    header = "\r\n".join([VERSION, *(f"{k}: {_one_line(v)}" for k, v in fields if v)])
    return (
        source.page_id, kind, name, source.record_id, source.target_uri, content_type,
        source.payload_digest, digest(data), len(data), header, block,
    )


def derived(source) -> list[tuple]:
    """The two records of one response."""
    page = read_page(source.payload, source.target_uri)
    source_fields = [
        (f"source-{name.strip().lower()}", value.strip())
        for name, sep, value in (line.partition(":") for line in source.http_header.splitlines())
        if sep
    ]
    fields = [
        ("title", page["title"]), ("language", page["lang"]), ("charset", page["charset"]),
        *source_fields, *(("outlink", f"{link} {how}") for link, how in page["links"]),
    ]
    block = "".join(f"{_one_line(k)}: {_one_line(v)}\r\n" for k, v in fields if v)
    return [
        _record("metadata", source, "application/warc-fields", block, "conversion"),
        _record("conversion", source, "text/plain; charset=utf-8", page["text"], "metadata"),
    ]


# ---------------------------------------------------------------- tables


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Response records of pages(page_id, url, html), as a crawl would have stored them."""

    def respond(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [field.split()[0] for field in RESPONSES.split(", ")]
        for batch in batches:
            rows = []
            for page_id, url, page in zip(batch["page_id"], batch["url"], batch["html"], strict=True):
                data = utf8(page)
                seal = digest(data)
                rows.append((
                    page_id, record_name(f"{url} {seal}", "response"), url, date,
                    f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(data)}",
                    page or "", seal,
                ))
            yield pd.DataFrame(rows, columns=names)

    return _with_ids(pages.select("page_id", "url", "html"), respond, RESPONSES)


def _with_ids(table: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInPandas`` with page_id as a text, because pandas rounds numbers beside missing ones."""
    bounded_batches(table.sparkSession)
    texts = table.withColumn("page_id", F.col("page_id").cast("long").cast("string"))
    found = texts.mapInPandas(function, schema.replace("page_id long", "page_id string"))
    return found.withColumn("page_id", F.col("page_id").cast("long"))


def derive(found: DataFrame) -> DataFrame:
    """Metadata and conversion records of responses: see RECORDS."""

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [field.split()[0] for field in RECORDS.split(", ")]
        for batch in batches:
            rows = [record for source in batch.itertuples(index=False) for record in derived(source)]
            yield pd.DataFrame(rows, columns=names)

    return _with_ids(found, records, RECORDS)


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """WARC files: header, blank line, block, and the record end as line end."""
    records.select(F.concat("header", F.lit(RECORD_END), "block").alias("value")).write.option(
        "lineSep", RECORD_END
    ).option("compression", compression).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """record_type, record_id, refers_to, block of every record of WARC files, compressed by gzip or not."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                if content[:2] == b"\x1f\x8b":
                    content = gzip.decompress(content)
                rows, at = [], 0
                while at < len(content):
                    head = content.index(b"\r\n\r\n", at)
                    lines = content[at:head].decode().split("\r\n")[1:]
                    fields = dict(line.split(": ", 1) for line in lines)
                    start = head + 4
                    end = start + int(fields["Content-Length"])
                    rows.append((fields["WARC-Type"], fields["WARC-Record-ID"],
                                 fields["WARC-Refers-To"], content[start:end].decode()))
                    at = end + 4
                    if len(rows) == RECORDS_AT_ONCE:
                        yield pd.DataFrame(rows, columns=["record_type", "record_id", "refers_to", "block"])
                        rows = []
                yield pd.DataFrame(rows, columns=["record_type", "record_id", "refers_to", "block"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(
        parse, "record_type string, record_id string, refers_to string, block string"
    )


def derived_records(pages: DataFrame) -> DataFrame:
    """Both records of every page, with the digest and length of the text instead of it all."""
    return derive(responses(pages)).select(
        "page_id", "record_type", "record_id", "refers_to", "target_uri", "content_type",
        "payload_digest", "block_digest", "content_length",
        F.sha2("block", 256).alias("block_sha256"),
        F.char_length("block").cast("long").alias("block_chars"),
    )
