"""Derivatives of WARC responses: linked metadata and plain-text conversion records.

A response is read as the bytes it is archived as: record headers, HTTP headers, payload.  From each
come two records that refer to it by its identifier: a metadata record with the source's headers,
digests, title and links as JSON, and a conversion record with the page's text.  Identifiers are
derived from the source's, so that a repeated run names the same records.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_arrow, text_of

RECORD = (
    "source_id string, record_id string, type string, refers_to string, target_uri string, date string, "
    "content_type string, content_length long, block_digest string, payload_digest string, digest_ok boolean, "
    "source_headers string, content string, record binary"
)

# a tag that nobody ends reaches to the end of the text, so no pattern tries the same text twice
DROPPED = re.compile(r"(?is)<(script|style|template|noscript)\b[^>]*(?:>|\Z).*?(?:</\1\s*+>|\Z)|<!--.*?(?:-->|\Z)")
BREAKS = re.compile(
    r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|"
    r"head|header|hr|html|li|main|nav|ol|option|p|pre|section|table|td|th|title|tr|ul)\b[^>]*(?:>|\Z)"
)
TAG = re.compile(r"</?[A-Za-z!?][^>]*>?")
TITLE = re.compile(r"(?is)<title\b[^>]*(?:>|\Z)(.*?)(?:(</title)|\Z)")
LINK = re.compile(r"""(?is)<(?:a|area|link)\b[^<>]*?\shref\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
LENGTH = re.compile("[0-9]{1,18}")


def plain_text(html: str) -> str:
    """Visible text, one line per block, blanks collapsed, references decoded; blank lines go."""
    text = TAG.sub("", BREAKS.sub("\n", DROPPED.sub(" ", html)))
    lines = (" ".join(line.split()) for line in unescape(text).split("\n"))
    return "\n".join(line for line in lines if line)


def links(html: str) -> list[str]:
    """Targets of links in page order, references decoded."""
    return [unescape(a or b or c) for a, b, c in LINK.findall(DROPPED.sub(" ", html))]


def _digest(data: bytes) -> str:
    return "sha256:" + hashlib.sha256(data).hexdigest()


def _verified(digest: str, payload: bytes) -> bool | None:
    """Whether a digest is the payload's: SHA-1 or SHA-256 in hex or Base32; None for any other."""
    kind, _, value = digest.partition(":")
    made = {"sha1": hashlib.sha1, "sha256": hashlib.sha256}.get(kind.lower())
    if made is None or (kind.lower() == "sha1" and len(value.rstrip("=")) not in (32, 40)):
        return None  # of another kind, or no whole SHA-1
    own = made(payload).digest()
    return value.lower() == own.hex() or value.upper().rstrip("=") == base64.b32encode(own).decode().rstrip("=")


def _headers(block: str) -> list[tuple[str, str]]:
    """Header fields in order; a line that begins with a blank goes on with the field before it."""
    fields: list[tuple[str, str]] = []
    for line in block.split("\r\n"):
        if line[:1] in (" ", "\t") and fields:
            fields[-1] = (fields[-1][0], f"{fields[-1][1]} {line.strip()}")
        elif ":" in line:
            name, _, value = line.partition(":")
            fields.append((name.strip(), value.strip()))
    return fields


def _get(fields: list[tuple[str, str]], name: str) -> str | None:
    return next((v for k, v in fields if k.lower() == name.lower()), None)


def read_response(record: bytes) -> dict | None:
    """Record headers, HTTP status line and headers, payload of a response; None where it is none."""
    head, blank, rest = record.partition(b"\r\n\r\n")
    version, _, lines = head.decode("utf-8", "replace").partition("\r\n")
    fields = _headers(lines)
    if not blank or not version.startswith("WARC/") or (_get(fields, "WARC-Type") or "").lower() != "response":
        return None
    length = _get(fields, "Content-Length") or ""
    block = rest[: int(length)] if LENGTH.fullmatch(length) else rest
    http, _, payload = block.partition(b"\r\n\r\n")
    status, _, http_lines = http.decode("utf-8", "replace").partition("\r\n")
    return {"warc": fields, "status": status, "http": _headers(http_lines), "payload": payload, "block": block}


def _record(source: dict, source_id: str, kind: str, content_type: str, content: str) -> dict:
    data = content.encode()
    # without an identifier the response is known by its content
    name = source_id or _digest(source["block"])
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name} {kind}')}>"),
        ("WARC-Refers-To", source_id),
        ("WARC-Target-URI", _get(source["warc"], "WARC-Target-URI") or ""),
        ("WARC-Date", _get(source["warc"], "WARC-Date") or ""),
        ("WARC-Block-Digest", _digest(data)),
        ("Content-Type", content_type),
        ("Content-Length", str(len(data))),
        ("WARC-Refers-To-Target-URI", _get(source["warc"], "WARC-Target-URI") or ""),
        ("WARC-Refers-To-Date", _get(source["warc"], "WARC-Date") or ""),
    ]
    head = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    payload_digest = _get(source["warc"], "WARC-Payload-Digest")
    return {
        "source_id": source_id,
        "record_id": fields[1][1],
        "type": kind,
        "refers_to": source_id,
        "target_uri": fields[3][1],
        "date": fields[4][1],
        "content_type": content_type,
        "content_length": len(data),
        "block_digest": fields[5][1],
        "payload_digest": payload_digest,
        "digest_ok": _verified(payload_digest or "", source["payload"]),
        "source_headers": json.dumps(source["http"], ensure_ascii=False),
        "content": content,
        "record": head.encode() + data + b"\r\n\r\n",
    }


def derive(record: bytes | None) -> list[dict]:
    """Metadata and conversion record of one response; nothing for null and other records."""
    source = read_response(record) if record else None
    if source is None:
        return []
    source_id = _get(source["warc"], "WARC-Record-ID") or ""
    html = source["payload"].decode("utf-8", "replace")
    title = TITLE.search(html)
    about = {
        "warc-headers": source["warc"],
        "http-status": source["status"],
        "http-headers": source["http"],
        "block-digest": _digest(source["block"]),
        "payload-digest": _digest(source["payload"]),
        "payload-length": len(source["payload"]),
        "title": " ".join(unescape(title[1]).split()) if title and title[2] else None,
        "links": links(html),
    }
    return [
        _record(source, source_id, "metadata", "application/json", json.dumps(about, ensure_ascii=False)),
        _record(source, source_id, "conversion", "text/plain; charset=utf-8", plain_text(html)),
    ]


def as_response(url: Column, html: Column, key: Column, date: str) -> Column:
    """A page as the bytes of a response record; null pages become empty payloads."""
    body = html.cast("binary")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    line = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]+", " ")
    name = F.md5(F.concat_ws(" ", F.lit("response"), key.cast("string"), line).cast("binary"))
    parts = [F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:"),
        F.concat_ws("-", *parts),
        F.lit(">\r\nWARC-Target-URI: "),
        line,
        F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Payload-Digest: sha256:"),
        F.sha2(body, 256),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + F.length(body)).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head, http, html, F.lit("\r\n\r\n")).cast("binary")


def responses(pages: DataFrame, date: str, url: str = "url", html: str = "html", key: str = "page_id") -> DataFrame:
    """All columns but the page itself, with ``warc``, the page as an archived response."""
    record = as_response(F.col(url), text_of(html), F.col(key), date)
    return pages.withColumn("warc", record).drop(html)


def derivatives(archived: DataFrame, warc: str = "warc", keep: tuple[str, ...] = ()) -> DataFrame:
    """Two rows per response with the columns of ``RECORD``, ``keep`` carried along.

    Rows whose record is null or no response give none.  A record without identifier is referred to
    by ''.  digest_ok tells whether the source's payload digest holds, null where there is none or it
    is not by SHA-256.  Repeated responses give repeated records of one identifier.
    Columns of ``keep`` must not have names of ``RECORD``.
    """
    rows = archived.select(*keep, F.col(warc).alias("__warc"))
    kept = list(keep)
    schema = rows.drop("__warc").schema
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    names = [part.split()[0] for part in RECORD.split(", ")]

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        made, places = [], []
        for i, record in enumerate(batch.column("__warc").to_pylist()):
            for one in derive(record):
                made.append(one)
                places.append(i)
        own = [batch.column(name).take(pa.array(places, pa.int64())) for name in kept]
        types = {"content_length": pa.int64(), "digest_ok": pa.bool_(), "record": pa.binary()}
        new = [pa.array([m[n] for m in made], types.get(n, pa.string())) for n in names]
        return pa.RecordBatch.from_arrays([*own, *new], names=[*kept, *names])

    return map_arrow(rows, f"{head}, {RECORD}" if head else RECORD, over)
