"""WARC derivatives: metadata and plain-text conversion records linked to their responses.

A response record gives two records. Both carry WARC-Refers-To with the response's record id, its
target URI and date, and digests of their own; the metadata block (JSON) keeps all headers of the
source, WARC and HTTP, its block and payload digests, the page's title and links; the conversion block is the
page's text.

Pages are read from front to back once, whatever they hold: an unclosed tag, comment or script hides the rest of the page.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import json
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import urljoin

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SLICE_BYTES, saved, slices

# Elements of HTML that hide what they hold, that may stand in a head, and that end a line.
RAW = ("script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes")
UNSEEN_RAW = ("script", "style", "title", "iframe", "noembed", "noframes")
UNSEEN = ("head", "noscript", "template")
OF_HEAD = ("title", "meta", "link", "script", "style", "base", "basefont", "bgsound", "noscript", "template", "head", "html")
BREAKS = frozenset("p div br li ul ol tr table h1 h2 h3 h4 h5 h6 section article header footer nav main aside blockquote pre title body hr dd dt dl form figure".split())

NAME, ATTRIBUTE = re.compile(r"[^\s/>]*").match, re.compile(r"[\s/]*(?:([^\s/>=][^\s/>=]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*|(?=>)))?|(>)|(=))").match
#: A tag without surprises: quotes only around values, no "<" within.
EASY = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9]*+)(?=[\s/>])(?:[^<>\"'=]++|(?<![\s/])=\s*+(?:\"[^\"<]*+\"|'[^'<]*+'|(?=[^\"'\s=<>])))*+>").match
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I).search for name in RAW}
# Runs of spaces that aren't one plain space, and the ends of lines.
SPACES, LINES = re.compile(r" [ \t\r\f\v\u00a0]+|[\t\r\f\v\u00a0][ \t\r\f\v\u00a0]*"), re.compile(r" ?\n[ \n]*")
SCHEMA = "record_type string, record_id string, refers_to string, target_uri string, date string, content_type string, content_length bigint, block_digest string, source_block_digest string, source_payload_digest string, source_headers map<string,string>, block string"
DATE = "2024-01-01T00:00:00Z"
#: A record's head may be so long; a member of a compressed file is unpacked in steps of so many bytes.
HEAD_BYTES, STEP = 1_000_000, 1 << 20


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    """A record id that depends on its parts alone, so that a task that runs twice names records alike."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(chr(0).join(parts).encode()).digest()[:16], version=5)}>"


def tag_at(page: str, at: int) -> tuple[str, str | None, int]:
    """(name, href, end) of the tag whose name begins at `at`; end is -1 where the page ends within the tag."""
    name = NAME(page, at)
    at, href = name.end(), None
    while m := ATTRIBUTE(page, at):
        at = m.end()
        if m[3]:
            return name[0].lower(), href, at
        if m[1] and href is None and m[1].lower() == "href":
            value = m[2] or ""
            href = value[1:-1] if value[:1] in ("'", '"') else value
    # Not an attribute: the end of the page, or a quote that is never closed.
    return name[0].lower(), href, -1


def read_page(page: str) -> tuple[str, list[str], str | None]:
    """(text, link targets in order, title): the visible text, with no scripts, styles, comments or tags and one line for each block of the page."""
    out: list[str] = []
    links: list[str] = []
    title, at, size = None, 0, len(page)
    head, depth = 0, 0  # open heads, and open elements of the other kinds that hide
    opened = dict.fromkeys(UNSEEN, 0)
    while at < size:
        lt = page.find("<", at)
        if lt < 0 or lt + 1 >= size:
            lt = size
        if lt > at and not (head or depth):
            out.append(html.unescape(page[at:lt]))
        if lt == size:
            break
        if m := EASY(page, lt):
            closing, name, href, at = m[1], m[2].lower(), None, m.end()
            if name == "a" and not closing:
                href = tag_at(page, lt + 1)[1]
        else:
            after = page[lt + 1]
            if after in "!?" or (after == "/" and not page[lt + 2 : lt + 3].isalpha()):
                comment = page.startswith("<!--", lt)
                end = page.find("-->", lt + 2) if comment else page.find(">", lt)
                out.append(" ")
                if end < 0:
                    break
                at = end + (3 if comment else 1)
                continue
            if not (after == "/" or (after.isascii() and after.isalpha())):
                if not (head or depth):
                    out.append("<")
                at = lt + 1
                continue
            closing = "/" if after == "/" else ""
            name, href, at = tag_at(page, lt + 1 + len(closing))
            if at < 0:
                break
        if not closing and head and name not in OF_HEAD:
            head = 0  # what doesn't belong into a head ends it
        if name in UNSEEN:
            if name == "head":
                head = max(0, head - 1) if closing else head + 1
            elif not closing or opened[name]:
                step = -1 if closing else 1
                opened[name] += step
                depth += step
            out.append(" ")
        elif not (head or depth):
            if name in BREAKS:
                out.append("\n")
            elif name in RAW:
                out.append(" ")
            if href is not None and not closing:
                links.append(html.unescape(href).strip())
        if name in RAW and not closing:
            found = RAW_END[name](page, at)
            end = found.start() if found else size
            if name == "title" and title is None:
                title = " ".join(html.unescape(page[at:end]).split())
            if name not in UNSEEN_RAW and not (head or depth):
                out.append(html.unescape(page[at:end]))
            at = end
    return LINES.sub("\n", SPACES.sub(" ", "".join(out))).strip(), links, title


def text_of_html(page: str) -> str:
    return read_page(page)[0]


def links_of(page: str, base: str | None) -> list[str]:
    """Targets of the page's links in order, made absolute where the page's address is known; repeats stay."""
    return [absolute(target, base) for target in read_page(page)[1]]


def absolute(target: str, base: str | None) -> str:
    try:
        return urljoin(base, target) if base else target
    except ValueError:
        return target


def split_http(block: bytes) -> tuple[str, dict[str, str], bytes]:
    """Status line, headers (names in lower case, repeats joined by ", ") and payload of an HTTP response."""
    head, _, payload = block.partition(b"\r\n\r\n")
    status, *rest = head.decode("latin-1").split("\r\n")
    return status, {name.lower(): value for name, value in folded(rest, str.lower).values()}, payload


def folded(lines: list[str], key: Callable[[str], str]) -> dict[str, tuple[str, str]]:
    """(name, value) of header lines by the key of the name; the values of repeats are joined by ", " under the first spelling."""
    out: dict[str, tuple[str, str]] = {}
    for line in lines:
        name, _, value = line.partition(":")
        name, value = name.strip(), value.strip()
        known = out.get(key(name))
        out[key(name)] = (known[0], f"{known[1]}, {value}") if known else (name, value)
    return out


def body_of(http: dict[str, str], payload: bytes) -> bytes:
    """The payload without its transfer and content codings; as far as it can be decoded, and as it is under a coding that is unknown."""
    if "chunked" in http.get("transfer-encoding", "").lower():
        whole, at = [], 0
        while (end := payload.find(b"\r\n", at)) >= 0:
            try:
                size = int(payload[at:end].split(b";")[0].strip() or b"0", 16)
            except ValueError:
                return payload  # not chunked after all
            if size <= 0:
                break
            whole.append(payload[end + 2 : end + 2 + size])
            at = end + 2 + size + 2
        payload = b"".join(whole)
    for coding in reversed([x.strip().lower() for x in http.get("content-encoding", "").split(",")]):
        if coding in ("gzip", "x-gzip", "deflate"):
            for bits in (47, -15):  # with a header, or bare
                try:
                    payload = inflated(payload, bits)
                    break
                except zlib.error:
                    continue
    return payload


def inflated(data: bytes, bits: int) -> bytes:
    """All members of compressed data, one after another; of a member that ends too soon what is there, and what follows the last isn't read."""
    whole = []
    while data:
        one = zlib.decompressobj(bits)
        try:
            whole.append(one.decompress(data))
        except zlib.error:
            if not whole:
                raise
            break
        data = one.unused_data if bits > 0 else b""
    return b"".join(whole)


def responses_from_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = DATE) -> DataFrame:
    """Response records of crawled pages: (id, headers map, block binary). Null HTML is an empty page; a null URL gives a record without target."""
    rows = pages.select(F.col(id_col), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in (x for whole in batches for x in slices(whole)):
            heads, blocks = [], []
            for i, url, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                payload = page.encode()
                block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
                head = {"WARC-Type": "response", "WARC-Record-ID": record_id("response", str(i), url or "", digest(payload)), "WARC-Date": date, "Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block)), "WARC-Block-Digest": digest(block), "WARC-Payload-Digest": digest(payload)}
                heads.append(list((head | ({"WARC-Target-URI": url} if url is not None else {})).items()))
                blocks.append(block)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(heads, pa.map_(pa.string(), pa.string())), pa.array(blocks, pa.binary())], names=[id_col, "headers", "block"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, headers map<string,string>, block binary")


def derivatives(responses: DataFrame, id_col: str | None = None) -> DataFrame:
    """A metadata and a conversion record for each response record, other record types left out.

    responses: headers map<string,string>, block binary, id_col if given, which is passed on, and problem (string) where
    the table has it: damaged records are left out. Header names match in any case. A null block is empty; missing
    digests are computed from the block; a missing record id is made from target and digest. Transfer and content codings are
    undone for text and links. Bytes that aren't valid in the page's charset become U+FFFD. Equal responses give equal
    records, an empty table an empty result; a page of any length is read whole, in time that grows with its length.
    """
    lead = [id_col] if id_col else []
    fields = ", ".join(f"`{c}` {responses.schema[c].dataType.simpleString()}" for c in lead)
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def two(headers: list | dict | None, block: bytes | None) -> list[tuple]:
        source = dict(headers or {})
        spelt = {name.lower(): name for name in source}
        of = lambda name: source.get(spelt.get(name.lower(), name))
        block = block or b""
        status, http, payload = split_http(block)
        for name, value in (("WARC-Block-Digest", lambda: digest(block)), ("WARC-Payload-Digest", lambda: digest(payload)), ("WARC-Record-ID", lambda: record_id("response", of("WARC-Target-URI") or "", of("WARC-Block-Digest")))):
            if of(name) is None:
                source[spelt.setdefault(name.lower(), name)] = value()
        url, date, refers, ours, inner = map(of, ("WARC-Target-URI", "WARC-Date", "WARC-Record-ID", "WARC-Block-Digest", "WARC-Payload-Digest"))
        charset = re.search(r"charset=[\"']?([\w.:-]+)", http.get("content-type", ""))
        body = body_of(http, payload)
        try:
            page = body.decode(charset[1] if charset else "utf-8", "replace")
        except (LookupError, ValueError):
            page = body.decode("utf-8", "replace")
        text, links, title = read_page(page)
        about = {"source": source, "http": {"status": status, "headers": http}, "title": title, "links": [absolute(x, url) for x in links]}
        out = []
        for kind, content, body in (("metadata", "application/json", json.dumps(about, ensure_ascii=False, sort_keys=True)), ("conversion", "text/plain; charset=utf-8", text)):
            data = body.encode("utf-8", "replace")
            out.append((kind, record_id(kind, refers), refers, url, date, content, len(data), digest(data), ours, inner, list(source.items()), data.decode()))
        return out

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        kinds = [pa.int64() if n == "content_length" else pa.map_(pa.string(), pa.string()) if n == "source_headers" else pa.string() for n in names]
        for batch in batches:
            whole = batch.set_column(len(lead) + 1, "block", pc.fill_null(batch.column(len(lead) + 1), b""))
            for part in slices(whole):
                rows = [r for h, b in zip(part.column(len(lead)).to_pylist(), part.column(len(lead) + 1).to_pylist(), strict=True) for r in two(h, b)]
                again = pa.array([i // 2 for i in range(len(rows))], pa.int64())
                yield pa.RecordBatch.from_arrays([*(part.column(i).take(again) for i in range(len(lead))), *(pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True))], names=lead + names)

    if "problem" in responses.columns:
        responses = responses.where("problem is null")
    types = F.filter(F.map_entries("headers"), lambda e: F.lower(e["key"]) == "warc-type")
    kept = responses.where(F.coalesce(F.lower(F.get(types, F.lit(0))["value"]), F.lit("response")) == "response")
    return kept.select(*lead, "headers", "block").mapInArrow(run, ", ".join(x for x in (fields, SCHEMA) if x))


def write_warc(records: DataFrame, path: str) -> DataFrame:
    """Derivative records as gzipped WARC files, a member for each record and a file for each partition; (file, records) as a saved table.

    path is a URI that all executors can write (file, hdfs, s3, gs). A file is written under another name and renamed
    once whole, so that a task that runs twice does no harm. The records carry the source's digests.
    """
    fields = (("WARC-Type", "record_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"), ("WARC-Target-URI", "target_uri"), ("WARC-Date", "date"), ("WARC-Block-Digest", "block_digest"), ("Source-Block-Digest", "source_block_digest"), ("Source-Payload-Digest", "source_payload_digest"), ("Content-Type", "content_type"))
    path = path if "://" in path else f"file://{path}"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs
        from pyspark import TaskContext

        store, root = fs.FileSystem.from_uri(path)
        name, n = f"part-{TaskContext.get().partitionId():06d}.warc.gz", 0
        store.create_dir(root, recursive=True)
        with store.open_output_stream(side := f"{root}/.{name}.{uuid.uuid4().hex}", compression=None) as f:
            for batch in (x for whole in batches for x in slices(whole)):
                for *values, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    data = block.encode()
                    head = "".join(f"{field}: {value}\r\n" for (field, _), value in zip(fields, values, strict=True) if value is not None)
                    f.write(gzip.compress(f"WARC/1.0\r\n{head}Content-Length: {len(data)}\r\n\r\n".encode() + data + b"\r\n\r\n", mtime=0))
                    n += 1
        if n:
            store.move(side, f"{root}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n])], names=["file", "records"])
        else:
            store.delete_file(side)

    rows = records.select(*[c for _, c in fields], F.coalesce("block", F.lit("")).alias("block"))
    return saved(rows.mapInArrow(run, "file string, records bigint"), "warc-files")


def unpacked(f) -> Iterator[bytes | None]:
    """The bytes of an open file, gzipped or not, a step at a time; None where a damaged member is left for the next one that can be read."""
    data = f.read(STEP)
    if data[:2] != b"\x1f\x8b":
        while data:
            yield data
            data = f.read(STEP)
        return
    while data:
        member, whole = zlib.decompressobj(31), True
        try:
            while not member.eof and (data or (data := f.read(STEP))):
                # A step at a time on the far side too, however well the member is packed.
                if out := member.decompress(data, STEP):
                    yield out
                data = member.unconsumed_tail if not member.eof else member.unused_data
            whole = member.eof
        except zlib.error:
            whole, data = False, data[1:]
        if not whole:
            yield None
        # To the next member: at once, or past what is damaged or only fills the space between.
        data = data or f.read(STEP)
        while data and not data.startswith(b"\x1f\x8b\x08"):
            at = data.find(b"\x1f\x8b\x08", 1)
            more = b"" if at >= 0 else f.read(STEP)
            data = data[at:] if at >= 0 else data[-2:] + more if more else b""


def parse_warc(f) -> Iterator[tuple[dict[str, str], bytes, str | None]]:
    """(headers, block, problem) of each record of an open WARC file, gzipped or not, read from front to back.

    The values of a repeated header are joined by ", ". problem is null for a whole record; of a damaged one it says
    what is wrong, the headers are those that can be read and the block is empty, and reading goes on with the next record.
    """
    steps, held, at = unpacked(f), bytearray(), 0
    broken = False

    def more() -> bool:
        nonlocal at, held, broken
        step = next(steps, b"")
        if step is None:
            broken = True
        elif step:
            held = held[at:] + step
            at = 0
        return bool(step)

    while True:
        while (start := held.find(b"WARC/", at)) < 0 and (at := max(at, len(held) - 4), more())[1]:
            pass
        if start < 0:
            if not broken:
                return
            yield {}, b"", "a compressed member is damaged"
            broken, held, at = False, bytearray(), 0
            continue
        at, size = start, None
        while (end := held.find(b"\r\n\r\n", at)) < 0 and len(held) - at < HEAD_BYTES and more():
            pass
        headers: dict[str, str] = {}
        problem = None if end >= 0 else "a compressed member is damaged" if broken else "the head has no end"
        if end >= 0:
            headers = dict(folded(held[at:end].decode("utf-8", "replace").split("\r\n")[1:], str.lower).values())
            length = next((v for n, v in headers.items() if n.lower() == "content-length"), "0")
            size = int(length) if length.isascii() and length.isdigit() else None
            problem = None if size is not None else "Content-Length is no number"
        if problem is None:
            at = end + 4
            blocks, left = [held[at : at + size]], size
            left -= len(blocks[0])
            at += len(blocks[0])
            while left and (held := bytearray(), at := 0)[1] == 0 and more():
                blocks.append(held[:left])
                at = len(blocks[-1])
                left -= at
            problem = None if not left else "a compressed member is damaged" if broken else "the block is cut short"
            if problem is None:
                yield headers, b"".join(blocks), None
                continue
        else:
            at += 5
        yield headers, b"", problem
        if broken:
            broken, held, at = False, bytearray(), 0


def read_warc(spark: SparkSession, path: str, damaged: bool = False) -> DataFrame:
    """All whole records of WARC files: (headers map, block binary). With damaged, also those that are damaged, and problem, which says what is wrong with them and is null for whole ones.

    A file is streamed by one task, which holds one record at a time; files may have any size. Empty files give no rows.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            heads, blocks, problems = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array([list(h.items()) for h in heads], pa.map_(pa.string(), pa.string())), pa.array(blocks, pa.binary()), pa.array(problems, pa.string())], names=["headers", "block", "problem"])

        for batch in batches:
            for uri in batch.column(0).to_pylist():
                store, place = fs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:/", "file:///", 1))
                rows, held = [], 0
                with store.open_input_stream(place, compression=None) as f:
                    for row in parse_warc(f):
                        rows.append(row)
                        held += len(row[1]) + 1_000
                        if held >= SLICE_BYTES:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").load(path).select("path")
    rows = files.mapInArrow(run, "headers map<string,string>, block binary, problem string")
    return rows if damaged else rows.where("problem is null").drop("problem")
