"""WARC derivatives: responses become linked metadata and plain-text conversion records.

A response record is a header map and an HTTP message. Its metadata record is a warc-fields block with the source's own
headers, its title, its links' count and its digests; its conversion record is the page's plain text. Both name the
response in WARC-Refers-To, keep its target URI and date, carry their own block and payload digests (SHA-1 in base 32),
and have identifiers derived from the response's, so a rerun gives the same records. Every record depends on one row
alone: there is no shuffle, and a lost task is simply run again.

Defined cases: a null page becomes a response with an empty body, a null URL one without a target URI (no such header); a
page without text gives a conversion record with an empty block; repeated pages give repeated records with equal
identifiers; a page of any length is one record, held whole by its task; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html as html_entities
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlake.sources.store import located

#: Identifiers are name-based UUIDs below this one.
SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:loomlake:warc")
DATE = "2024-01-01T00:00:00Z"

_UNSEEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I)
_BREAK = re.compile(r"<(?:br|hr|/?(?:p|div|h[1-6]|li|ul|ol|table|tr|article|section|header|footer|nav|aside|main|blockquote|pre|form|figure|figcaption|dl|dt|dd|title|head|body|html))\b[^>]*>", re.I)
_TAG = re.compile(r"<[/!?a-zA-Z][^>]*>")
_BLANK = re.compile(r"[^\S\n]+")
_LINES = re.compile(r" ?\n[ \n]*")
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title", re.S | re.I)
_CONTROL = re.compile(r"[\x00-\x20\x7f]")
_LINK = re.compile(r"<a\b[^>]*\bhref\s*=", re.I)

SCHEMA = "page_id long, kind string, record_id string, refers_to string, target_uri string, headers string, block string, content_length long, block_digest string, payload_digest string"


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def identifier(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, name)}>"


def plain_text(page: str) -> str:
    """The text of an HTML page: block elements end lines, unseen elements vanish, entities are resolved."""
    body = _TAG.sub("", _BREAK.sub("\n", _UNSEEN.sub("", page)))
    return _LINES.sub("\n", _BLANK.sub(" ", html_entities.unescape(body))).strip()


def response(page_id: int | None, url: str | None, page: str | None) -> tuple[dict[str, str], bytes, bytes]:
    """Headers, HTTP head and payload of the response record of a page."""
    payload = (page or "").encode("utf-8", "replace")
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    whole = hashlib.sha1(head)
    whole.update(payload)
    headers = {"WARC-Type": "response", "WARC-Record-ID": identifier(f"{page_id} {url}"), "WARC-Date": DATE}
    if url is not None:
        # control characters and blanks would end or break the header
        headers["WARC-Target-URI"] = _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url)
    headers |= {"WARC-Payload-Digest": digest(payload), "WARC-Block-Digest": "sha1:" + base64.b32encode(whole.digest()).decode(), "Content-Type": "application/http; msgtype=response", "Content-Length": str(len(head) + len(payload))}
    return headers, head, payload


def _derived(source: dict[str, str], kind: str, content_type: str, block: bytes) -> dict[str, str]:
    headers = {"WARC-Type": kind, "WARC-Record-ID": identifier(f"{kind} of {source['WARC-Record-ID']}"), "WARC-Refers-To": source["WARC-Record-ID"], "WARC-Date": source["WARC-Date"]}
    if "WARC-Target-URI" in source:
        headers["WARC-Target-URI"] = source["WARC-Target-URI"]
    own = digest(block)
    return headers | {"WARC-Block-Digest": own, "WARC-Payload-Digest": own, "Content-Type": content_type, "Content-Length": str(len(block))}


def derivatives(source: dict[str, str], head: bytes, payload: bytes) -> list[tuple[dict[str, str], bytes]]:
    """The metadata and the conversion record of a response."""
    page = payload.decode("utf-8", "replace")
    title = _TITLE.search(page)
    fields = [("source-record-id", source["WARC-Record-ID"]), ("source-payload-digest", source["WARC-Payload-Digest"]), ("source-block-digest", source["WARC-Block-Digest"]), ("source-content-length", source["Content-Length"])]
    fields += [("http-" + n.lower(), v.strip()) for n, _, v in (line.partition(":") for line in head.decode("latin-1").split("\r\n")[1:] if line)]
    fields += [("title", " ".join(html_entities.unescape(title.group(1)).split()) if title else ""), ("outlinks", str(len(_LINK.findall(page))))]
    meta = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    text = plain_text(page).encode("utf-8", "replace")
    return [(_derived(source, "metadata", "application/warc-fields", meta), meta), (_derived(source, "conversion", "text/plain; charset=utf-8", text), text)]


def head_text(headers: dict[str, str]) -> str:
    return "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items()) + "\r\n"


def packed(headers: dict[str, str], block: bytes) -> bytes:
    """A record as a gzip member of a WARC file."""
    return gzip.compress(head_text(headers).encode() + block + b"\r\n\r\n", mtime=0)


def parsed(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and blocks of the records of a WARC file, compressed or not."""
    raw = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        lines = raw[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {k.strip(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        n = int(headers["Content-Length"])
        yield headers, raw[end + 4 : end + 4 + n]
        at = end + 4 + n + 4


def built(pages: DataFrame) -> DataFrame:
    """The metadata and conversion records of pages: page_id, url, html."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 512):
                rows = whole.slice(k, 512).to_pydict()
                out: list[tuple] = []
                for i, url, page in zip(rows["page_id"], rows["url"], rows["html"]):
                    for h, block in derivatives(*response(i, url, page)):
                        out.append((i, h["WARC-Type"], h["WARC-Record-ID"], h["WARC-Refers-To"], url, head_text(h), block.decode(), len(block), h["WARC-Block-Digest"], h["WARC-Payload-Digest"]))
                columns = list(zip(*out)) if out else [()] * 10
                kinds = [pa.int64(), *[pa.string()] * 6, pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[f.split()[0] for f in SCHEMA.split(", ")])

    return pages.selectExpr("cast(page_id as long) page_id", "url", "html").mapInArrow(run, SCHEMA)


def files(records: DataFrame, many: int = 16) -> DataFrame:
    """path, data: records dealt to `many` gzipped WARC files by their identifiers, so a rerun gives the same files.

    A file comes in rows of some records each, in the order of identifiers, which are joined end to end; rows stay small.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, heads, blocks = (batch.column(c).to_pylist() for c in ("path", "headers", "block"))
            data = [gzip.compress((h + b + "\r\n\r\n").encode(), mtime=0) for h, b in zip(heads, blocks, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(data, pa.binary())], names=["path", "data"])

    part = F.pmod(F.xxhash64("record_id"), F.lit(many))
    dealt = records.withColumn("path", F.format_string("part-%05d.warc.gz", part)).repartition("path").sortWithinPartitions("path", "record_id")
    return dealt.select("path", "headers", "block").mapInArrow(run, "path string, data binary")


def read_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, number, type, record_id, target_uri, date, headers, block of the records of WARC files, gzipped by record or plain.

    Each file is one stream of one task, which holds one record at a time; files are dealt to tasks one by one. A file that ends
    within a record raises.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, at = located(path)
                with store.open_input_stream(at, compression=None) as f:
                    for number, (headers, block) in enumerate(streamed(f)):
                        get = headers.get
                        row = (path, number, get("WARC-Type"), get("WARC-Record-ID"), get("WARC-Target-URI"), get("WARC-Date"), list(headers.items()), block)
                        kinds = [pa.string(), pa.int64(), *[pa.string()] * 4, pa.map_(pa.string(), pa.string()), pa.binary()]
                        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=[f.split()[0] for f in _RECORD.split(", ")])

    rows = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)))
    return rows.mapInArrow(run, _RECORD)


_RECORD = "path string, number long, type string, record_id string, target_uri string, date string, headers map<string,string>, block binary"


def streamed(f) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and blocks of the records of an open WARC file, compressed or not, a record at a time."""
    data, member, plain, ended = bytearray(), None, None, False

    def more() -> bool:
        nonlocal member, plain, ended
        got = f.read(1 << 20)
        if not got:
            ended = True
            return False
        if plain is None:
            plain = got[:2] != b"\x1f\x8b"
        while got and not plain:
            member = member or zlib.decompressobj(31)
            data.extend(member.decompress(got))
            got = member.unused_data
            if member.eof:
                member = None
        data.extend(got)
        return True

    while True:
        while (end := data.find(b"\r\n\r\n")) < 0 and more():
            pass
        if end < 0:
            if data.strip():
                raise ValueError("the file ends within a record's headers")
            return
        lines = data[:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("a record does not begin with its version")
        headers = {k.strip(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        whole = end + 4 + int(headers["Content-Length"])
        while len(data) < whole and more():
            pass
        if len(data) < whole:
            raise ValueError("the file ends within a record's block")
        yield headers, bytes(data[end + 4 : whole])
        while len(data) < whole + 4 and more():
            pass
        del data[: whole + 4]


def derived(records: DataFrame) -> DataFrame:
    """kind, record_id, refers_to, target_uri, headers, block and digests of the derivatives of the responses among records.

    Dates, addresses and HTTP headers are those of the records; digests that a response lacks are computed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for pairs, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                source = dict(pairs)
                head, _, payload = block.partition(b"\r\n\r\n")
                source = {"WARC-Payload-Digest": digest(payload), "WARC-Block-Digest": digest(block), "Content-Length": str(len(block))} | source
                for h, made in derivatives(source, head + b"\r\n\r\n", payload):
                    out.append((h["WARC-Type"], h["WARC-Record-ID"], h["WARC-Refers-To"], source.get("WARC-Target-URI"), head_text(h), made.decode(), len(made), h["WARC-Block-Digest"], h["WARC-Payload-Digest"]))
            names = [f.split()[0] for f in SCHEMA.split(", ")][1:]
            kinds = [*[pa.string()] * 6, pa.int64(), pa.string(), pa.string()]
            columns = list(zip(*out)) if out else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return records.where("type = 'response'").select("headers", "block").mapInArrow(run, SCHEMA.split(", ", 1)[1])
