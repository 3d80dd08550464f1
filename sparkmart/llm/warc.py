"""WARC derivatives: linked metadata and plain-text conversion records of response records.

Both derivatives of a response name it in WARC-Refers-To and each other in WARC-Concurrent-To. Their
ids follow from the response's, so a rerun writes the same records. The metadata record carries the
response's HTTP headers and digests as they were, and says whether those digests hold.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkmart.llm.common import whole
from sparkmart.llm.html_text import ATTRIBUTE, Page, entities, tokens
from sparkmart.llm.scan import by_bytes

Headers = list[tuple[str, str]]
#: Namespace of ids that follow from other ids.
IDS = uuid.uuid5(uuid.NAMESPACE_URL, "urn:warc-derivatives")

RECORD = "record_id string, warc_type string, target_uri string, warc_date string, headers array<struct<name:string,value:string>>, block binary"
DERIVED = (
    "record_id string, warc_type string, refers_to string, concurrent_to string, target_uri string, warc_date string, content_type string, content_length long, block_digest string, "
    "payload_digest string, source_block_digest string, source_payload_digest string, source_headers array<struct<name:string,value:string>>, block binary"
)


def digest_of(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def named(headers: Headers, name: str) -> str | None:
    """First value of a header, whatever the case of its name."""
    return next((v for k, v in headers if k.lower() == name.lower()), None)


def id_from(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(IDS, chr(0).join(parts))}>"


def wire(headers: Headers, block: bytes) -> bytes:
    """A record as it stands in a file."""
    head = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return b"WARC/1.1\r\n" + head.encode("utf-8", "replace") + b"\r\n" + block + b"\r\n\r\n"


def head_lines(data: bytes) -> Headers:
    """Name and value of header lines; continued lines are joined."""
    out: Headers = []
    for line in data.decode("utf-8", "replace").replace("\r\n", "\n").split("\n"):
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif ":" in line:
            k, v = line.split(":", 1)
            out.append((k.strip(), v.strip()))
    return out


def records(data: bytes) -> Iterator[tuple[Headers, bytes]]:
    """Headers and block of every record of a file, compressed by gzip or not. What is no record is passed over."""
    stream = io.BytesIO(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data)
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        head = []
        while (line := stream.readline()).strip():
            head.append(line)
        headers = head_lines(b"".join(head))
        size = named(headers, "Content-Length") or "0"
        yield headers, stream.read(int(size) if size.isdigit() else 0)


def http(block: bytes) -> tuple[str, Headers, bytes]:
    """Status line, headers and stored payload of an HTTP response; without a status line all is payload."""
    if not block.startswith(b"HTTP/"):
        return "", [], block
    head, _, payload = block.partition(b"\r\n\r\n") if b"\r\n\r\n" in block else block.partition(b"\n\n")
    status, _, rest = head.partition(b"\n")
    return status.decode("latin-1").strip(), head_lines(rest), payload


def unchunked(data: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = data.find(b"\r\n", at)
        size = re.match(rb"[0-9A-Fa-f]+", data[at:end]) if end >= 0 else None
        n = int(size[0], 16) if size else 0
        if not n:
            return b"".join(out) if out or size else data
        out.append(data[end + 2 : end + 2 + n])
        at = end + 4 + n


def readable(headers: Headers, payload: bytes) -> bytes:
    """The payload without transfer and content coding; as it is where a coding does not hold or is not known."""
    if "chunked" in (named(headers, "Transfer-Encoding") or "").lower():
        payload = unchunked(payload)
    coding = (named(headers, "Content-Encoding") or "").lower()
    try:
        if "gzip" in coding:
            return gzip.decompress(payload)
        if "deflate" in coding:
            return zlib.decompress(payload)
    except (OSError, EOFError, zlib.error):
        pass
    return payload


def characters(headers: Headers, data: bytes) -> tuple[str, str]:
    """Text and charset: of the header, else of the page, else UTF-8; bytes that do not fit are replaced."""
    said = re.search(r"charset=[\"']?([\w.:-]+)", named(headers, "Content-Type") or "", re.I)
    found = said[1] if said else None
    if not found and (meta := re.search(rb"<meta[^>]+charset=[\"']?([\w.:-]+)", data[:4096], re.I)):
        found = meta[1].decode("ascii")
    try:
        return data.decode(found or "utf-8", "replace"), (found or "utf-8").lower()
    except LookupError:
        return data.decode("utf-8", "replace"), "utf-8"


def page_facts(source: str, uri: str) -> tuple[str, str, list[str]]:
    """Title, language and outgoing links, each once, in page order."""
    title = re.search(r"<title[^>]*>(.*?)</title", source, re.I | re.S)
    lang, links = "", []
    for m in tokens(source):
        tag = (m[2] or "").lower()
        if m[1] or tag not in ("html", "a"):
            continue
        given = {k.lower(): entities.unescape(a or b or c or "") for k, a, b, c in ATTRIBUTE.findall(m[3] or "")}
        if tag == "html":
            lang = lang or given.get("lang", "")
        elif given.get("href") and not given["href"].startswith(("#", "javascript:")):
            try:
                links.append(urljoin(uri, given["href"].strip()))
            except ValueError:
                links.append(given["href"].strip())
    return " ".join(entities.unescape(title[1]).split()) if title else "", lang, list(dict.fromkeys(links))


def field_line(name: str, value: str) -> str:
    return f"{name}: {' '.join(value.split())}\r\n"


def derivatives(record_id: str, uri: str, date: str, headers: Headers, block: bytes) -> list[dict]:
    """The metadata and the conversion record of one response."""
    status, head, payload = http(block)
    html, charset = characters(head, readable(head, payload))
    kind = named(head, "Content-Type") or ""
    markup = "html" in kind.lower() or (not kind and "<" in html)
    text = "\n".join(said for said, _, _ in Page(html).blocks) if markup else html
    title, lang, links = page_facts(html, uri) if markup else ("", "", [])
    stated = {"block": named(headers, "WARC-Block-Digest"), "payload": named(headers, "WARC-Payload-Digest")}
    true = {"block": digest_of(block), "payload": digest_of(payload)}
    source = {k: stated[k] or true[k] for k in true}
    ids = {k: id_from(record_id, k) for k in ("metadata", "conversion")}
    facts = field_line("status", status) + field_line("charset", charset) + (field_line("title", title) if title else "") + (field_line("language", lang) if lang else "")
    facts += "".join(field_line("http-header", f"{k}: {v}") for k, v in head)
    for k in ("block", "payload"):
        facts += field_line(f"source-{k}-digest", source[k])
        if stated[k] and stated[k].lower().startswith("sha1:"):
            facts += field_line(f"source-{k}-digest-holds", str(stated[k].lower() == true[k].lower()).lower())
    facts += field_line("conversion", ids["conversion"]) + "".join(field_line("outlink", x) for x in links)
    out = []
    for warc_type, content_type, body in (("metadata", "application/warc-fields", facts.encode("utf-8", "replace")), ("conversion", "text/plain; charset=utf-8", text.encode("utf-8", "replace"))):
        other = "conversion" if warc_type == "metadata" else "metadata"
        out.append(
            {"record_id": ids[warc_type], "warc_type": warc_type, "refers_to": record_id, "concurrent_to": ids[other], "target_uri": uri, "warc_date": date, "content_type": content_type, "content_length": len(body)}
            | {"block_digest": digest_of(body), "payload_digest": digest_of(body), "source_block_digest": source["block"], "source_payload_digest": source["payload"]}
            | {"source_headers": [{"name": k, "value": v} for k, v in head], "block": body}
        )
    return out


def record_headers(row: dict) -> Headers:
    """WARC headers of a derived record."""
    out = [("WARC-Type", row["warc_type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", row["warc_date"]), ("WARC-Refers-To", row["refers_to"]), ("WARC-Concurrent-To", row["concurrent_to"])]
    if row["target_uri"]:
        out += [("WARC-Target-URI", row["target_uri"]), ("WARC-Refers-To-Target-URI", row["target_uri"])]
    out += [("WARC-Refers-To-Date", row["warc_date"]), ("WARC-Block-Digest", row["block_digest"]), ("WARC-Payload-Digest", row["payload_digest"])]
    return out + [("Content-Type", row["content_type"]), ("Content-Length", str(row["content_length"]))]


def responses(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Response records of a table of pages (page_id, url, html); NULL url and html count as empty. page_id stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "html"):
            rows = []
            for page, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                payload = (html or "").encode("utf-8", "replace")
                block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
                headers = [("WARC-Block-Digest", digest_of(block)), ("WARC-Payload-Digest", digest_of(payload)), ("Content-Type", "application/http; msgtype=response")]
                rows.append((page, id_from("page", str(page), url or ""), "response", url or "", date, [{"name": k, "value": v} for k, v in headers], block))
            yield _batch(rows, f"page_id long, {RECORD}")

    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id long, {RECORD}")


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    pairs = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    named_kinds = [c.strip().split(" ", 1) for c in re.split(r",\s*(?=\w+ )", schema)]
    columns = list(zip(*rows)) if rows else [()] * len(named_kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(k, pairs)) for c, (_, k) in zip(columns, named_kinds)], [n for n, _ in named_kinds])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files, plain or gzipped, of any folder Spark reads. One task holds one file at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content").to_pylist():
                rows, held = [], 0
                for headers, block in records(data):
                    rows.append((named(headers, "WARC-Record-ID"), named(headers, "WARC-Type"), named(headers, "WARC-Target-URI") or "", named(headers, "WARC-Date"), [{"name": k, "value": v} for k, v in headers], block))
                    held += len(block)
                    if held > 8 << 20:
                        yield _batch(rows, RECORD)
                        rows, held = [], 0
                yield _batch(rows, RECORD)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORD)


def derive(found: DataFrame) -> DataFrame:
    """Metadata and conversion records of the response records; other types and records without an id give none.

    A page_id column, if there is one, stays. Repeated responses give repeated derivatives with equal ids.
    """
    keep = ["page_id"] if "page_id" in found.columns else []
    schema = ("page_id long, " if keep else "") + DERIVED

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "block", 4 << 20):
            rows = []
            held = [batch.column(c).to_pylist() for c in ("record_id", "target_uri", "warc_date", "headers", "block", *keep)]
            for record_id, uri, date, headers, block, *page in zip(*held):
                pairs = [(h["name"], h["value"]) for h in headers or []]
                rows += [(*page, *row.values()) for row in derivatives(record_id, uri or "", date or "", pairs, block or b"")]
            yield _batch(rows, schema)

    return found.filter("warc_type = 'response' AND record_id IS NOT NULL").select("record_id", "target_uri", "warc_date", "headers", "block", *keep).mapInArrow(run, schema)


def with_wire(derived: DataFrame) -> DataFrame:
    """Add `wire`: each derived record as its bytes in a WARC file."""
    fields = [f.name for f in derived.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "block"):
            out = [wire(record_headers(row), row["block"]) for row in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*fields, "wire"])

    return derived.mapInArrow(run, type(derived.schema)([*derived.schema.fields]).add("wire", "binary"))


def digest(pages: DataFrame) -> DataFrame:
    """Both derivatives of every page."""
    out = derive(responses(pages.select("page_id", whole("url").alias("url"), whole("html").alias("html"))))
    return out.withColumn("block", F.col("block").cast("string")).drop("source_headers")
