"""WARC derivatives (operator 2): metadata and plain-text conversion records of responses.

Each response record gives two records (WARC/1.1): `metadata` (application/warc-fields: the
source record's headers and digests, title, language, outlinks, and the conversion's id) and `conversion`
(text/plain, the visible text).  Both name the response they come from in
WARC-Refers-To with its URI and date, and have block digests of their own; the conversion
also has its payload digest.  Record ids are name-based UUIDs of the source's id and the
record's type, so a task that runs again writes the same records.

`responses` makes response records of a table of pages; `derive` takes any table of
responses; `write_warc` writes records as WARC files with Spark's writer, one record after another, gzip by
file; `parse_record` reads one record back.

The visible text leaves out comments and the elements `script`, `style`, `noscript`, `noframes`, `template`
and `title`; one that is not closed runs to the end of the page, as in browsers.

A map over the rows: no shuffle, one batch in memory.

Defined results: a null or empty body has an empty conversion and a metadata record; a null URL leaves out
the URI headers; a null id is an id like any other; repeated rows give repeated records with the same ids; an empty table gives no
record; other columns are not read.
"""

from __future__ import annotations

import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import frame, table

DATE = "2024-01-01T00:00:00Z"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL namespace of RFC 4122
SLICE = 500

# inside a tag a > may stand in a quoted value; a name ends at white space, / or >, so `title-bar` is no `title`
INSIDE = r"(?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^>])*+"
ENDS = r"(?=[\s/>])"
# a head may be left unclosed, so not the head goes but what of it is not shown; <!--> and <!---> are whole comments
UNSEEN = re.compile(rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<(script|style|noscript|noframes|template|title){ENDS}{INSIDE}(?:>.*?(?:</\1{ENDS}[^>]*>|\Z)|\Z)", re.S | re.I)
BLOCKS = re.compile(rf"</?(?:p|div|br|hr|h[1-6]|ul|ol|li|table|tr|section|article|nav|header|footer|blockquote|pre|body|html|main|aside|title|dl|dt|dd|form){ENDS}{INSIDE}>", re.I)
TAGS = re.compile(rf"<[a-zA-Z/!?]{INSIDE}>")
TITLE = re.compile(rf"<title{ENDS}{INSIDE}>(.*?)</title\s*>", re.S | re.I)
LANGUAGE = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", re.I)
LINKS = re.compile(r"<a(?=[\s/>])[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
SPACES = re.compile(r"[ \t\r\f\v\xa0]+")
LINES = re.compile(r" ?\n[ \n]*")


def plain_text(body: str) -> str:
    """The visible text: block elements end a line, white space is one space."""
    text = TAGS.sub("", BLOCKS.sub("\n", UNSEEN.sub("", body)))
    return LINES.sub("\n", SPACES.sub(" ", html.unescape(text))).strip()


def one_line(text: str) -> str:
    return " ".join(html.unescape(TAGS.sub("", text)).split())


def digest(block: bytes) -> str:
    return "sha256:" + hashlib.sha256(block).hexdigest()


def record_id(*parts) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, chr(31).join('' if p is None else str(p) for p in parts))}>"


def header_text(fields: list[tuple[str, str | None]]) -> str:
    """The header of a record; fields without a value are left out, line breaks in values are spaces."""
    return "WARC/1.1\r\n" + "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in fields if v is not None)


RESPONSE = pa.schema([("source_id", pa.int64()), ("record_id", pa.string()), ("target_uri", pa.string()), ("date", pa.string()), ("http_headers", pa.string()), ("body", pa.string()), ("payload_digest", pa.string()), ("block_digest", pa.string())])
RECORD = pa.schema([("source_id", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()), ("target_uri", pa.string()), ("content_type", pa.string()),
                    ("content_length", pa.int64()), ("block_digest", pa.string()), ("source_payload_digest", pa.string()), ("header", pa.string()), ("block", pa.string())])


def ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'string'}" for f in schema)


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", date: str = DATE) -> DataFrame:
    """Response records of pages that were fetched with status 200."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                rows = []
                for i, url, body in zip(*(batch.column(c).to_pylist() for c in (id_col, url_col, body_col))):
                    payload = (body or "").encode()
                    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
                    rows.append((i, record_id(i, url, date, digest(payload)), url, date, head, body or "", digest(payload), digest(head.encode() + payload)))
                yield frame(RESPONSE, **dict(zip(RESPONSE.names, map(list, zip(*rows)))))

    return pages.select(id_col, url_col, body_col).mapInArrow(run, ddl(RESPONSE))


def derivatives(source_id, source: str, uri: str | None, date: str | None, http: str | None, body: str, payload: str, block: str) -> list[tuple]:
    """The metadata and the conversion record of one response."""
    body = body or ""
    text = plain_text(body)
    ids = {kind: record_id(source, kind) for kind in ("metadata", "conversion")}
    found = [next(x for x in m if x) for m in LINKS.findall(body) if any(m)]
    title, language = TITLE.search(body), LANGUAGE.search(body)
    headers = [tuple(x.split(":", 1)) for x in (http or "").split("\r\n")[1:] if ":" in x]
    fields = [("source-record", source), ("source-payload-digest", payload), ("source-block-digest", block), ("source-status", (http or "").split("\r\n")[0] or None)]
    fields += [(f"source-http-{k.strip().lower()}", v) for k, v in headers]
    fields += [("conversion-record", ids["conversion"]), ("title", one_line(title[1]) if title else None), ("language", language[1] if language else None), ("outlink-count", str(len(found)))]
    fields += [("outlink", html.unescape(x)) for x in found]
    meta = "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in fields if v is not None)
    out = []
    for kind, content, block_text in (("metadata", "application/warc-fields", meta), ("conversion", "text/plain; charset=utf-8", text)):
        raw = block_text.encode("utf-8", "replace")
        own = digest(raw)
        header = header_text([("WARC-Type", kind), ("WARC-Record-ID", ids[kind]), ("WARC-Date", date), ("WARC-Target-URI", uri), ("WARC-Refers-To", source), ("WARC-Refers-To-Target-URI", uri), ("WARC-Refers-To-Date", date),
                              ("WARC-Block-Digest", own), ("WARC-Payload-Digest", own if kind == "conversion" else None), ("Content-Type", content), ("Content-Length", str(len(raw)))])
        out.append((source_id, kind, ids[kind], source, uri, content, len(raw), own, payload, header, raw.decode()))
    return out


def derive(records: DataFrame) -> DataFrame:
    """Metadata and conversion records of response records (the columns of `responses`)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                rows = [r for row in zip(*(batch.column(c).to_pylist() for c in RESPONSE.names)) for r in derivatives(*row)]
                yield frame(RECORD, **dict(zip(RECORD.names, map(list, zip(*rows)))))

    return records.select(*RESPONSE.names).mapInArrow(run, ddl(RECORD))


def write_warc(records: DataFrame, path: str) -> None:
    """Records as gzip-compressed WARC files in a new folder `path`, one file for each partition."""
    whole = F.concat("header", F.lit("\r\n"), "block").alias("record")
    records.select(whole).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def parse_record(raw: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(header fields, block, where the next record starts) of the record at `at`."""
    end = raw.index(b"\r\n\r\n", at)
    lines = raw[at:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError(f"no WARC record at byte {at}")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    size = int(fields["Content-Length"])
    return fields, raw[end + 4:end + 4 + size], end + 4 + size + 4


def op2_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every page."""
    return derive(responses(table(spark, sf_dir, "pages")))
