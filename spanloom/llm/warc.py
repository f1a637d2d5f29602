"""WARC derivative builder.

A response record becomes two linked records: *metadata* (the server's headers,
status and digests, as warc-fields) and *conversion* (the page's visible text).
Both name the response in WARC-Refers-To and keep its target, date and payload digest.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, SLICE_ROWS, append_columns
from .html_extract import visible_text

CRLF = b"\r\n"
#: Name space of the record ids, which depend on content only: a repeated run makes the same ids.
IDS = uuid.uuid5(uuid.NAMESPACE_URL, "urn:spanloom:warc")
FIELDS = "array<struct<record_type:string,record_id:string,refers_to:string,target_uri:string,warc_date:string,content_type:string,content_length:bigint,block_digest:string,payload_digest:string,record:binary>>"


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(kind: str, *parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(IDS, chr(10).join((kind, *parts)))}>"


def serialise(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A WARC/1.1 record; Content-Length is added.  Control characters in a value become percent escapes: no value ends its line."""
    clean = lambda v: v if v.isprintable() else "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in v)
    head = "".join(f"{k}: {clean(v)}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode("utf-8", "surrogatepass") + CRLF + block + CRLF + CRLF


def _headers(raw: bytes) -> list[tuple[str, str]]:
    """Header lines in order; a folded line belongs to the one before it."""
    out: list[tuple[str, str]] = []
    for line in raw.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif ":" in line:
            k, v = line.split(":", 1)
            out.append((k.strip(), v.strip()))
    return out


def _get(headers: list[tuple[str, str]], name: str, default: str = "") -> str:
    return next((v for k, v in headers if k.lower() == name.lower()), default)


def parse(data: bytes) -> tuple[list[tuple[str, str]], bytes] | None:
    """Headers and block of one record (plain or gzip); None if it isn't one or is cut short."""
    if data[:2] == b"\x1f\x8b":
        try:
            data = gzip.decompress(data)
        except (OSError, EOFError, zlib.error):
            return None
    if not data.startswith(b"WARC/"):
        return None
    head, found, rest = data.partition(CRLF + CRLF)
    headers = _headers(head.partition(CRLF)[2])
    length = _get(headers, "Content-Length")
    if not found or not length.isdigit() or len(rest) < int(length):
        return None
    return headers, rest[: int(length)]


def parse_http(block: bytes) -> tuple[int, list[tuple[str, str]], bytes]:
    """(status, headers, payload as sent); status 0 if the block isn't an HTTP response."""
    head, _, payload = block.partition(CRLF + CRLF)
    line, _, rest = head.partition(CRLF)
    m = re.match(rb"HTTP/\d(?:\.\d)? (\d{3})", line)
    return (int(m[1]), _headers(rest), payload) if m else (0, [], block)


def entity(headers: list[tuple[str, str]], payload: bytes) -> bytes:
    """The payload without transfer and content coding; what can't be decoded stays as sent."""
    if "chunked" in _get(headers, "Transfer-Encoding").lower():
        out, rest = b"", payload
        while True:
            size, found, rest = rest.partition(CRLF)
            try:
                n = int(size.split(b";")[0], 16)
            except ValueError:
                n = 0
            if not found or not n:
                break
            out, rest = out + rest[:n], rest[n + 2 :]
        payload = out or payload
    try:
        coding = _get(headers, "Content-Encoding").lower()
        if "gzip" in coding:
            return gzip.decompress(payload)
        if "deflate" in coding:
            return zlib.decompress(payload)
    except (OSError, EOFError, zlib.error):
        pass
    return payload


def text_of(headers: list[tuple[str, str]], body: bytes) -> str:
    kind = _get(headers, "Content-Type", "text/html").lower()
    charset = (re.search(r"charset=[\"']?([\w.-]+)", kind) or [None, "utf-8"])[1]
    try:
        text = body.decode(charset, "replace")
    except LookupError:
        text = body.decode("utf-8", "replace")
    if "html" in kind or "xml" in kind:
        return visible_text(text)
    return text if kind.startswith("text/") else ""


def response(url: str, page: str, date: str, number: str = "") -> bytes:
    """A response record of a stored page, as a crawler would have written it."""
    payload = page.encode("utf-8", "surrogatepass")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: " + str(len(payload)).encode() + CRLF + CRLF + payload
    return serialise(
        [("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", number, url, digest(payload))), ("WARC-Date", date), ("WARC-Target-URI", url), ("Content-Type", "application/http; msgtype=response"), ("WARC-Block-Digest", digest(http)), ("WARC-Payload-Digest", digest(payload))], http
    )


def derivatives(data: bytes | None) -> list[dict]:
    """The metadata and conversion records of one response record; none for any other record or broken data."""
    found = parse(data) if data else None
    if found is None or _get(found[0], "WARC-Type") != "response":
        return []
    warc, block = found
    status, http, payload = parse_http(block)
    source, target, date = (_get(warc, k) for k in ("WARC-Record-ID", "WARC-Target-URI", "WARC-Date"))
    payload_digest = _get(warc, "WARC-Payload-Digest") or digest(payload)
    fields = [("sourceRecord", source), ("sourceBlockDigest", _get(warc, "WARC-Block-Digest") or digest(block)), ("sourcePayloadDigest", payload_digest), ("digestVerified", str(payload_digest == digest(payload)).lower()), ("httpStatus", str(status))]
    fields += [(f"httpHeader-{k}", v) for k, v in http]
    made = [("metadata", "application/warc-fields", "".join(f"{k}: {v}\r\n" for k, v in fields).encode()), ("conversion", "text/plain; charset=utf-8", text_of(http, entity(http, payload)).encode("utf-8", "surrogatepass"))]
    ids = {kind: record_id(kind, source) for kind, _, _ in made}
    out = []
    for kind, media, body in made:
        other = "conversion" if kind == "metadata" else "metadata"
        head = [("WARC-Type", kind), ("WARC-Record-ID", ids[kind]), ("WARC-Refers-To", source), ("WARC-Concurrent-To", ids[other]), ("WARC-Date", date), ("WARC-Target-URI", target), ("WARC-Refers-To-Payload-Digest", payload_digest), ("Content-Type", media), ("WARC-Block-Digest", digest(body))]
        out.append({"record_type": kind, "record_id": ids[kind], "refers_to": source, "target_uri": target, "warc_date": date, "content_type": media, "content_length": len(body), "block_digest": digest(body), "payload_digest": payload_digest, "record": serialise(head, body)})
    return out


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """``pages`` plus ``record``: the bytes of each page's response record.  Null html is an empty page, null url an empty target."""
    from pyspark.sql import types as T

    own = "__number", "__target", "__html"
    named = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in zip((id_col, url_col, html_col), own, strict=True)]
    kept = [c for c in pages.columns if c != "record"]
    schema = T.StructType([*[pages.schema[c] for c in kept], T.StructField("record", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = max(1, batch.nbytes // max(1, len(batch)))
            step = max(1, min(SLICE_ROWS, SLICE_BYTES // size))
            for at in range(0, len(batch), step):
                part = batch.slice(at, step)
                number, target, page = (part.column(part.schema.get_field_index(c)).to_pylist() for c in own)
                made = [response(u, p, date, n) for n, u, p in zip(number, target, page, strict=True)]
                yield pa.RecordBatch.from_arrays([*[part.column(part.schema.get_field_index(c)) for c in kept], pa.array(made, pa.binary())], names=[*kept, "record"])

    return pages.select(*[F.col(f"`{c}`") for c in kept], *named).mapInArrow(run, schema)


def build_derivatives(records: DataFrame, record_col: str = "record") -> DataFrame:
    """Two rows for each response record: all columns of ``records`` but ``record_col``, then the fields of :data:`FIELDS`.

    ``record`` is the whole serialised record.  Null, empty, broken and cut
    records, and records of other types, give no rows.  Repeated records give
    the same ids.  Input columns named like an output are replaced.
    """

    def make():
        def run(rows: list) -> Iterable[list]:
            return [[derivatives(bytes(r) if r is not None else None) for r in rows]]

        return run

    done = append_columns(records, record_col, [("__made", FIELDS)], make, nulls=True)
    outs = ["record_type", "record_id", "refers_to", "target_uri", "warc_date", "content_type", "content_length", "block_digest", "payload_digest", "record"]
    kept = [F.col(f"`{c}`") for c in records.columns if c not in (record_col, *outs)]
    return done.select(*kept, F.explode("__made").alias("__r")).select(*kept, *[F.col(f"__r.{c}").alias(c) for c in outs])


def gzip_members(records: DataFrame, record_col: str = "record") -> DataFrame:
    """``records`` plus ``member``: each record as a gzip member of its own; members in any order, one after another, are a WARC file.  Null: null."""

    def make():
        def run(rows: list) -> list[list]:
            return [[gzip.compress(bytes(r), mtime=0) if r is not None else None for r in rows]]

        return run

    return append_columns(records, record_col, [("member", "binary")], make, nulls=True)
