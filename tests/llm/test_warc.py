import base64
import gzip
import hashlib
import io
import json
import random
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from cairnlake.llm import warc


class Plain(HTMLParser):
    """Words of a page as the standard parser sees them, and its links."""

    def __init__(self):
        super().__init__()
        self.words, self.links, self.hidden = [], [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "head", "noscript", "template", "title")
        if tag == "a" and dict(attrs).get("href") is not None:
            self.links.append(dict(attrs)["href"])

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "head", "noscript", "template", "title")

    def handle_data(self, data):
        if not self.hidden:
            self.words += data.split()


def test_derivatives_of_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    source = {r["page_id"]: r for r in warc.responses_from_pages(pages).collect()}
    rows = warc.derivatives(warc.responses_from_pages(pages), "page_id").collect()
    assert len(rows) == 2 * len(source) and len({r["record_id"] for r in rows}) == len(rows)
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    same = 0
    for r in rows:
        headers = dict(source[r["page_id"]]["headers"])
        assert r["refers_to"] == headers["WARC-Record-ID"] and r["source_block_digest"] == headers["WARC-Block-Digest"] and r["source_payload_digest"] == headers["WARC-Payload-Digest"] and dict(r["source_headers"]) == headers
        assert r["block_digest"] == warc.digest(r["block"].encode()) and r["content_length"] == len(r["block"].encode()) and r["target_uri"] == headers["WARC-Target-URI"]
        seen = Plain()
        seen.feed(html[r["page_id"]])
        if r["record_type"] == "metadata":
            about = json.loads(r["block"])
            assert about["source"] == headers and about["http"]["headers"]["content-type"] == "text/html; charset=utf-8" and len(about["links"]) == len(seen.links)
        else:
            same += r["block"].split() == seen.words
    assert same >= 0.95 * len(source)


class Rendered(HTMLParser):
    """Text and links by the standard parser, under the same rules for lines and hidden elements."""

    def __init__(self):
        super().__init__()
        self.out, self.links, self.hidden = [], [], 0

    def tag(self, tag, step):
        if tag in ("script", "style", "head", "noscript", "template", "title"):
            self.hidden += step
            self.out.append(" ")
        elif not self.hidden:
            self.out.append("\n" if tag in warc.BREAKS else "")

    def handle_starttag(self, tag, attrs):
        self.tag(tag, 1)
        if tag == "a" and not self.hidden and dict(attrs).get("href") is not None:
            self.links.append(dict(attrs)["href"].strip())

    def handle_endtag(self, tag):
        self.tag(tag, -1)

    def handle_comment(self, data):
        self.out.append(" ")

    handle_decl = handle_comment

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)


def test_every_page_as_the_standard_parser_reads_it(spark):
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    for page in [*pages, "<p a='>'>x<b>y</b>z</p>&amp;<a HREF=q>1</a>", "a < b", "<a href='x&amp;y' title=\"</a>\">t</a>"]:
        seen = Rendered()
        seen.feed(page)
        seen.close()
        text, links, _ = warc.read_page(page)
        assert text == warc.LINES.sub("\n", warc.SPACES.sub(" ", "".join(seen.out))).strip() and links == seen.links


def test_time_grows_with_the_page(spark):
    for part in ("<script>", "<!--", "<a<b ", "<a href='", '<a b="', "<", "<a ", "</", "<title>", "&#", "\n "):
        began = time.process_time()
        warc.read_page(part * (200_000 // len(part)))
        assert time.process_time() - began < 3, part


def record(number, block, more=""):
    return f"WARC/1.0\r\nWARC-Type: response\r\nX: a\r\nx: {number}\r\n{more}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def test_damaged_records_are_passed_over(spark, tmp_path):
    show = lambda data: [(h.get("X"), bytes(b), p) for h, b, p in warc.parse_warc(io.BytesIO(data))]
    whole = [("a, 1", b"one", None), ("a, 2", b"two", None)]
    one, two = record(1, b"one"), record(2, b"two")
    assert show(one + two) == show(gzip.compress(one) + gzip.compress(two)) == whole
    assert show(one + b"WARC/1.0\r\nContent-Length: zz\r\n\r\nx\r\n" + two) == [whole[0], (None, b"", "Content-Length is no number"), whole[1]]
    assert show(one + record(3, b"cut")[:-6]) == [whole[0], ("a, 3", b"", "the block is cut short")]
    rng = random.Random(1)
    bad = bytearray(gzip.compress(record(3, rng.randbytes(90_000))))
    bad[40_000:40_100] = bytes(100)
    assert [(x, p) for x, _, p in show(gzip.compress(one) + bytes(bad) + gzip.compress(two))][::2] == [("a, 1", None), ("a, 2", None)]
    assert show(b"") == show(b"nothing of the kind") == []
    (tmp_path / "x.warc.gz").write_bytes(gzip.compress(one) + gzip.compress(b"WARC/1.0\r\nContent-Length: -\r\n\r\n") + gzip.compress(two))
    read = warc.read_warc(spark, str(tmp_path), damaged=True)
    assert sorted(str(r["problem"]) for r in read.collect()) == ["Content-Length is no number", "None", "None"]
    assert warc.derivatives(read).count() == 4 and warc.read_warc(spark, str(tmp_path)).count() == 2


def test_codings_and_case_of_names(spark):
    page = "<p>café</p>".encode()
    packed = gzip.compress(page)
    chunks = b"%x\r\n%s\r\n%x;x=1\r\n%s\r\n0\r\n\r\n" % (5, packed[:5], len(packed) - 5, packed[5:])
    block = b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip\r\nTransfer-Encoding: chunked\r\n\r\n" + chunks
    df = spark.createDataFrame([({"warc-type": "Response", "WARC-record-id": "<urn:1>"}, bytearray(block)), ({"warc-type": "request"}, bytearray(b"GET"))], "headers map<string,string>, block binary")
    rows = warc.derivatives(df).collect()
    assert sorted(r["block"] for r in rows if r["record_type"] == "conversion") == ["café"] and {r["refers_to"] for r in rows} == {"<urn:1>"}
    assert all(r["source_payload_digest"] == "sha1:" + base64.b32encode(hashlib.sha1(chunks).digest()).decode() for r in rows)


def test_round_trip_through_files(spark, sf_dir, tmp_path):
    records = warc.derivatives(warc.responses_from_pages(spark.read.parquet(f"{sf_dir}/pages.parquet").limit(30))).cache()
    warc.write_warc(records, str(tmp_path / "out"))
    back = warc.read_warc(spark, str(tmp_path / "out/*.gz")).collect()
    want = sorted((r["record_id"], r["record_type"], r["refers_to"], r["block_digest"], r["block"]) for r in records.collect())
    assert sorted((h["WARC-Record-ID"], h["WARC-Type"], h["WARC-Refers-To"], h["WARC-Block-Digest"], b.decode()) for h, b in back) == want


def test_edges(spark):
    pages = spark.createDataFrame([(1, None, None), (1, "http://x/", ""), (2, "http://x/a/", "<p>A&amp;B<br>c</p><a href='../y'>z</a>"), (2, "http://x/a/", "<p>A&amp;B<br>c</p><a href='../y'>z</a>"), (None, "http://q/", "<" * 1000)], "page_id bigint, url string, html string").withColumn("headers", F.lit(0)).withColumn("block", F.lit(1))
    rows = warc.derivatives(warc.responses_from_pages(pages), "page_id").collect()
    assert len(rows) == 10
    text = [r["block"] for r in rows if r["page_id"] == 2 and r["record_type"] == "conversion"]
    assert text == ["A&B\nc\nz"] * 2
    assert json.loads(next(r["block"] for r in rows if r["page_id"] == 2 and r["record_type"] == "metadata"))["links"] == ["http://x/y"]
    assert [r["block"] for r in rows if r["target_uri"] is None and r["record_type"] == "conversion"] == [""]
    assert warc.derivatives(warc.responses_from_pages(pages.limit(0)), "page_id").count() == 0


def test_other_records_and_missing_headers(spark):
    block = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=iso-8859-1\r\nX: 1\r\nX: 2\r\n\r\n<title> T\n t</title><p>café</p>".encode("latin-1")
    df = spark.createDataFrame([({"WARC-Type": "request"}, bytearray(b"GET /")), ({"WARC-Type": "response"}, bytearray(block)), (None, None)], "headers map<string,string>, block binary")
    rows = warc.derivatives(df).collect()
    assert len(rows) == 4
    meta = json.loads(next(r["block"] for r in rows if r["record_type"] == "metadata" and "T t" in r["block"]))
    assert meta["title"] == "T t" and meta["http"]["headers"]["x"] == "1, 2"
    assert "café" in [r["block"] for r in rows]
    assert any(r["source_payload_digest"] == warc.digest(b"") for r in rows) and hashlib.sha1(b"").hexdigest()


def test_bodies_of_several_members():
    import zlib

    members = gzip.compress(b"one ") + gzip.compress(b"two")
    assert warc.inflated(members, 47) == b"one two" and warc.inflated(members + b"rest", 47) == b"one two" and warc.inflated(members[:-9], 47)[:4] == b"one "
    with pytest.raises(zlib.error):
        warc.inflated(b"plain", 47)
