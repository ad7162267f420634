"""WARC derivatives: what is linked, kept and converted."""

import base64
import hashlib
import json
import time
from html.parser import HTMLParser

from tessera.llm import queries, warc

HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nX-Long: a\r\n b\r\n\r\n"
PAGE = "<html><head><title>A &amp; B</title><style>x</style></head><body><p>One<br>two <b>bo</b>ld &eacute;</p><!-- no --><a href='/x?a=1&amp;b=2'>go</a></body></html>".encode()


def response(**over) -> bytes:
    block = over.pop("block", HTTP + PAGE)
    fields = {
        "WARC-Type": "response", "WARC-Record-ID": "<urn:uuid:1>", "WARC-Target-URI": "http://e.org/", "WARC-Date": "2020-01-02T03:04:05Z",
        "WARC-Payload-Digest": "sha256:" + hashlib.sha256(PAGE).hexdigest(), "Content-Length": str(len(block)),
    } | over
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def test_two_linked_records():
    meta, text = warc.derive(response())
    assert (meta["type"], text["type"]) == ("metadata", "conversion")
    for r in (meta, text):
        assert r["refers_to"] == r["source_id"] == "<urn:uuid:1>" and r["record_id"] not in ("<urn:uuid:1>", "")
        assert r["date"] == "2020-01-02T03:04:05Z" and r["target_uri"] == "http://e.org/" and r["digest_ok"] is True
        data = r["content"].encode()
        assert r["block_digest"] == "sha256:" + hashlib.sha256(data).hexdigest() and r["content_length"] == len(data)
        again = warc._headers(r["record"].partition(b"\r\n\r\n")[0].decode())
        assert warc._get(again, "WARC-Refers-To") == "<urn:uuid:1>"
        assert r["record"].endswith(data + b"\r\n\r\n")
    assert meta["record_id"] != text["record_id"]
    assert text["content"] == "A & B\nOne\ntwo bold é\ngo"
    about = json.loads(meta["content"])
    assert about["title"] == "A & B" and about["links"] == ["/x?a=1&b=2"]
    assert about["http-headers"] == [["Content-Type", "text/html"], ["X-Long", "a b"]]
    assert json.loads(meta["source_headers"]) == about["http-headers"]


def test_odd_records():
    assert warc.derive(None) == [] == warc.derive(b"") and warc.derive(b"junk") == []
    assert warc.derive(response(**{"WARC-Type": "request"})) == []
    assert warc.derive(response(**{"WARC-Payload-Digest": "sha256:0"}))[0]["digest_ok"] is False
    assert warc.derive(response(**{"WARC-Payload-Digest": "sha1:AB"}))[0]["digest_ok"] is None
    assert [r["content"] for r in warc.derive(response(block=HTTP))][1] == ""
    assert warc.derive(response(block=HTTP + b"\xff\xfe<p>x" + b"y" * 300_000))[1]["content"].endswith("y" * 300_000)
    assert warc.derive(response()) == warc.derive(response())


class _Text(HTMLParser):
    """Plain text by the standard library's parser, as a check."""

    def __init__(self):
        super().__init__()
        self.parts, self.quiet = [], 0

    def handle_starttag(self, tag, attrs):
        self.quiet += tag in ("script", "style")
        if warc.BREAKS.fullmatch(f"<{tag}>"):
            self.parts.append("\n")

    def handle_endtag(self, tag):
        self.quiet -= tag in ("script", "style")
        if warc.BREAKS.fullmatch(f"<{tag}>"):
            self.parts.append("\n")

    def handle_data(self, data):
        if not self.quiet:
            self.parts.append(data)


def test_query_on_its_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = queries.op6_warc(spark, sf_dir).collect()
    assert len(rows) == 2 * len(pages) and len({r.record_id for r in rows}) == len(rows)
    for r in rows:
        page = pages[r.page_id]
        assert r.target_uri == page.url and r.digest_ok
        assert r.payload_digest == "sha256:" + hashlib.sha256(page.html.encode()).hexdigest()
        assert json.loads(r.source_headers)[0] == ["Content-Type", "text/html; charset=utf-8"]
        if r.type == "conversion":
            parser = _Text()
            parser.feed(page.html)
            parser.close()
            lines = (" ".join(line.split()) for line in "".join(parser.parts).split("\n"))
            assert r.content == "\n".join(line for line in lines if line)


def test_null_pages_and_empty_table(spark):
    pages = spark.createDataFrame([(1, None, None), (None, "u\r\nX: y", "<p>x"), (2, "u", "")], "page_id long, url string, html string")
    archived = warc.responses(pages, "2024-01-01T00:00:00Z")
    rows = warc.derivatives(archived, keep=("page_id",)).collect()
    assert len(rows) == 6 and all(r.digest_ok for r in rows)
    assert sorted(r.content for r in rows if r.type == "conversion") == ["", "", "x"]
    assert warc.derivatives(archived.limit(0)).count() == 0


def test_broken_lengths_and_unended_tags_end_no_job():
    for length in ("²", "٣", "-1", "", "9" * 40):
        assert len(warc.derive(response(**{"Content-Length": length}))) == 2
    for text in ("<title>", "<a ", "<p ", "<script ", "<style>", "</script ", "<!--", "<a href=x ", "<title"):
        took = []
        for n in (20_000, 80_000):
            start = time.perf_counter()
            warc.plain_text(text * n), warc.links(text * n), warc.TITLE.search(text * n)
            took.append(time.perf_counter() - start)
        assert took[1] < 2 + 12 * took[0], text


def test_digests_and_identifiers():
    sha1 = base64.b32encode(hashlib.sha1(PAGE).digest()).decode()
    for digest, ok in (("sha1:" + sha1, True), ("sha1:" + sha1[::-1], False), ("md5:x", None), ("sha256:", False)):
        assert warc.derive(response(**{"WARC-Payload-Digest": digest}))[0]["digest_ok"] is ok
    one, two = (warc.derive(response(**{"WARC-Record-ID": ""}, block=HTTP + page)) for page in (b"a", b"b"))
    assert len({r["record_id"] for r in one + two}) == 4
