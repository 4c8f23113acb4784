"""WARC derivatives: metadata and plain-text conversion records made from response records.

``derive`` parses each response record (its WARC headers, HTTP head and body) and yields two linked records. Both carry
WARC-Refers-To with the response's id, its target URI and date; the metadata record keeps the source's other WARC headers,
its HTTP status and headers, its digests, and the id of the conversion; the conversion holds the visible text. Record ids
are derived from the source's id, so a task that runs again makes the same records.

Defined cases: a null or empty body gives an empty text; pages of any length are read in one pass, whatever they leave open;
control characters of a URL are percent-encoded; a record that isn't a response, or is broken, gives one row of
type ``skipped`` with the reason as its block; a null URL leaves the URI header out; repeated rows give repeated records;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import quoted, ship

CAPTURED = "2024-01-01T00:00:00Z"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the public UUID name space for URLs
#: One piece of markup; a quote counts only after "=", and an open one ends with the page, as browsers read it.
_TAG = re.compile(r"<(?:!--|(/?)([a-zA-Z][^\s/>]*+)([^>=]*+(?:=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|)[^>=]*+)*+)(?:>|\Z)|[!?/])")
_INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp small span strong sub sup time tt u var".split())
#: Elements without visible text. Those of TO_THE_END hide the rest of the page if they aren't closed; others hide nothing then.
_TO_THE_END = frozenset(("script", "style", "title"))
_HIDDEN = {n: re.compile(rf"</{n}(?=[\s/>])", re.IGNORECASE) for n in ("script", "style", "title", "noscript", "iframe")}
#: Elements without visible text that may hold themselves; the empty form of svg ends at once.
_NESTED = {n: re.compile(rf"<(/?){n}(?=[\s/>])([^>]*+)", re.IGNORECASE) for n in ("svg", "template")}
_LANG = re.compile(r"(?:^|[\s/\"'])lang\s*=\s*[\"']?([A-Za-z0-9-]+)", re.IGNORECASE)
_HREF = re.compile(r"(?:^|[\s/\"'])href\s*=\s*(?:\"([^\"]*)|'([^']*)|([^\s\"'>]+))", re.IGNORECASE)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, chr(10).join(parts))}>"


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC/1.0 record."""
    lines = [("WARC-Type", kind), *headers, ("WARC-Block-Digest", digest(block)), ("Content-Length", str(len(block)))]
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + block + b"\r\n\r\n"


def response(url: str | None, body: str | None, key: str, date: str = CAPTURED) -> bytes:
    """A response record for a page as a crawler would have kept it."""
    payload = (body or "").encode()
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else url  # a line break would end the header
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    target = [("WARC-Target-URI", url)] if url else []
    headers = [("WARC-Record-ID", record_id("response", key, url or "", digest(payload))), *target, ("WARC-Date", date), ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", digest(payload))]
    return record("response", headers, head + payload)


def _head(data: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """First line, headers (continued lines joined) and what follows the empty line."""
    head, found, rest = data.partition(b"\r\n\r\n")
    if not found:
        head, found, rest = data.partition(b"\n\n")
    if not found:
        raise ValueError("no end of the headers")
    first, *lines = head.decode("utf-8", "replace").replace("\r\n", "\n").split("\n")
    headers: list[tuple[str, str]] = []
    for line in lines:
        if line[:1] in " \t" and headers:
            headers[-1] = (headers[-1][0], f"{headers[-1][1]} {line.strip()}")
        elif ":" in line:
            k, _, v = line.partition(":")
            headers.append((k.strip(), v.strip()))
    return first, headers, rest


def parse(data: bytes) -> tuple[list[tuple[str, str]], bytes]:
    """WARC headers and block of a record."""
    first, headers, rest = _head(data)
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    length = {k.lower(): v for k, v in headers}.get("content-length", "")
    if not length.isdigit() or int(length) > len(rest):
        raise ValueError("the block is shorter than its length")
    return headers, rest[: int(length)]


@dataclass
class Page:
    """What a page shows and says of itself."""

    text: str
    title: str | None
    language: str | None
    links: list[str]


def _squeezed(x: str) -> str:
    return " ".join(html.unescape(x).split())


def _closed(page: str, name: str, at: int) -> int | None:
    """Where the element that began before ``at`` ends: at its closing tag, or behind it if it may hold itself; None if it isn't closed."""
    if name in _HIDDEN:
        found = _HIDDEN[name].search(page, at)
        return found.start() if found else None
    depth = 1
    for m in _NESTED[name].finditer(page, at):
        depth += -1 if m[1] else 0 if name == "svg" and m[2].endswith("/") else 1
        if not depth:
            return page.find(">", m.end()) + 1 or len(page)
    return None


def read_page(page: str) -> Page:
    """One pass over a page: blocks on lines of their own, white space collapsed, no comments, scripts, styles, titles or drawings.

    Every character is read a bounded number of times, whatever is left open. A head needs no closing tag, since nothing
    in it but its title is text.
    """
    page = page.replace("\n", " ").replace("\r", " ")
    out: list[str] = []
    links: list[str] = []
    title = language = None
    open_for_good: set[str] = set()
    at, size = 0, len(page)
    while at < size:
        m = _TAG.search(page, at)
        if m is None:
            out.append(page[at:])
            break
        out.append(page[at : m.start()])
        at, name = m.end(), m[2]
        if name is None:
            if m[0] == "<!--":
                end = page.find("-->", m.start() + 2)
                at = size if end < 0 else end + 3
            else:
                end = page.find(">", m.start())
                at = size if end < 0 else end + 1
            continue
        name = name.lower()
        if name not in _INLINE:
            out.append("\n")
        if m[1]:
            continue
        if name == "a":
            href = _HREF.search(m[3])
            if href:
                links.append(_squeezed(href[1] or href[2] or href[3] or ""))
        elif name == "html" and language is None:
            lang = _LANG.search(m[3])
            language = lang[1] if lang else None
        elif name in _HIDDEN or name in _NESTED:
            if name in open_for_good or (name == "svg" and m[3].endswith("/")):
                continue
            end = _closed(page, name, at)
            if end is None and name not in _TO_THE_END:
                open_for_good.add(name)
                continue
            end = size if end is None else end
            if name == "title" and title is None:
                title = _squeezed(page[at:end])
            at = end
    lines = (_squeezed(x) for x in "".join(out).split("\n"))
    return Page("\n".join(x for x in lines if x), title, language, links)


def visible_text(page: str) -> str:
    return read_page(page).text


def derivatives(data: bytes) -> list[tuple[str, str, str, bytes, bytes]]:
    """[(type, record id, refers-to, block, whole record)] of a response record: its metadata and its conversion."""
    headers, block = parse(data)
    have = {k.lower(): v for k, v in headers}
    if have.get("warc-type", "").lower() != "response":
        raise ValueError("not a response")
    source = have["warc-record-id"]
    status, http, body = _head(block)
    if not status.startswith("HTTP/"):
        raise ValueError("no HTTP response")
    if "chunked" in {k.lower(): v for k, v in http}.get("transfer-encoding", "").lower():
        body = _dechunked(body)
    page = read_page(body.decode(_charset(http), "replace"))
    text = page.text.encode()
    shared = [(k, v) for k, v in headers if k.lower() in ("warc-target-uri", "warc-date")]
    meta_id, text_id = record_id("metadata", source), record_id("conversion", source)
    fields = [("source-" + k.lower(), v) for k, v in headers if k.lower() not in ("warc-type", "warc-record-id", "warc-target-uri", "warc-date")]
    fields += [("source-payload-digest-computed", digest(body)), ("http-status", status), *(("http-header", f"{k}: {v}") for k, v in http)]
    fields += [("title", page.title)] if page.title is not None else []
    fields += [("language", page.language)] if page.language else []
    fields += [("outlink", x) for x in page.links]
    fields += [("conversion", text_id), ("conversion-digest", digest(text))]
    meta = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    linked = [*shared, ("WARC-Refers-To", source)]
    return [
        ("metadata", meta_id, source, meta, record("metadata", [("WARC-Record-ID", meta_id), *linked, ("Content-Type", "application/warc-fields")], meta)),
        ("conversion", text_id, source, text, record("conversion", [("WARC-Record-ID", text_id), *linked, ("WARC-Payload-Digest", digest(text)), ("Content-Type", "text/plain; charset=utf-8")], text)),
    ]


def _charset(http: list[tuple[str, str]]) -> str:
    found = re.search(r"charset=[\"']?([\w-]+)", {k.lower(): v for k, v in http}.get("content-type", ""))
    try:
        return found[1] if found and "x".encode(found[1]) else "utf-8"
    except LookupError:
        return "utf-8"


def _dechunked(body: bytes) -> bytes:
    out, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        size = int(body[at:end].split(b";")[0].strip() or b"0", 16)
        if not size:
            break
        out.append(body[end + 2 : end + 2 + size])
        at = end + 2 + size + 2
    return b"".join(out)


def responses(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """(key, record) with a response record of each page."""
    ship(pages.sparkSession)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([response(u, b, str(k)) for k, u, b in rows], pa.binary())], names=["key", "record"])

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(*(F.col(quoted(c)).alias(n) for c, n in ((key, "key"), (url, "url"), (body, "body")))).mapInArrow(made, f"`key` {kind}, record binary").withColumnRenamed("key", key)


def derive(records: DataFrame, key: str = "page_id", column: str = "record") -> DataFrame:
    """(key, record_type, record_id, refers_to, block, record): two rows a response."""
    ship(records.sparkSession)
    names = ["key", "record_type", "record_id", "refers_to", "block", "record"]

    def derived(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for k, data in enumerate(batch.column(1).to_pylist()):
                try:
                    found = derivatives(data or b"")
                except (ValueError, KeyError) as e:
                    found = [("skipped", None, None, str(e).encode(), None)]
                at += [k] * len(found)
                rows += found
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=names)

    kind = records.schema[key].dataType.simpleString()
    schema = f"`key` {kind}, record_type string, record_id string, refers_to string, block binary, record binary"
    return records.select(F.col(quoted(key)).alias("key"), F.col(quoted(column)).alias("record")).mapInArrow(derived, schema).withColumnRenamed("key", key)


def op7_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a derived record: its links, its content (warc-fields with the source's headers and digests, or the plain text),
    and its digests and lengths. Null, empty and repeated pages as the module states."""
    made = derive(responses(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    return made.select(
        "page_id", "record_type", "record_id", "refers_to", F.col("block").cast("string").alias("content"),
        F.octet_length("block").cast("long").alias("content_length"), F.sha2("block", 256).alias("block_sha256"),
        F.octet_length("record").cast("long").alias("record_length"), F.sha2("record", 256).alias("record_sha256"),
    )
