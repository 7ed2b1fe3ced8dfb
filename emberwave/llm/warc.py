"""WARC derivatives: linked metadata and conversion records of responses.

A ``response`` record (a page as it was fetched) becomes a ``metadata`` record, which holds what is known
of it as fields, and a ``conversion`` record, which holds its plain text: all of it, title, navigation and
comments too, without markup and code, a line for each block. Both name the response's WARC-Record-ID in
WARC-Refers-To, keep its target, its date, its HTTP header block and its payload digest, and carry digests
of their own. Their ids are version-5 UUIDs of the response's id, so a rerun writes the same ones.

Files are read record by record, a file in a task, and written a file by each task; a manifest of the
files is committed as a table, so what a lost or repeated task left is in no manifest.
"""

from __future__ import annotations

import base64
import codecs
import gzip
import hashlib
import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberwave.llm.common import few, saved, slices
from emberwave.llm.html import visible_text
from emberwave.llm.tokenfile import open_path

CRLF = "\r\n"
#: Where the table has no date, records carry this one.
NO_DATE = "1970-01-01T00:00:00Z"
RESPONSES = "page_id long, record_type string, record_id string, target_uri string, date string, content_type string, payload_digest string, headers string, block binary"
RECORDS = (
    "page_id long, record_type string, record_id string, refers_to string, target_uri string, date string, content_type string, "
    "payload_digest string, block_digest string, source_status int, source_headers string, content_length long, block string"
)
FILES = "name string, n_records long"
_TYPES = {"page_id": pa.int64(), "source_status": pa.int32(), "content_length": pa.int64()}
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:warc:derivative")
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title>", re.IGNORECASE | re.DOTALL)
_LINK = re.compile(r"<a\s[^>]*?href\s*=\s*(?:\"([^\"]*)\"|'([^']*)')", re.IGNORECASE)
_META = re.compile(rb"<meta\s[^>]*?charset\s*=\s*[\"']?\s*([A-Za-z0-9_:.-]+)", re.IGNORECASE)
_HEAD_END = re.compile(rb"\r?\n\r?\n")
_BOMS = ((codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16"))


def digest(data: bytes) -> str:
    """SHA-1 in base 32, as WARC files usually give it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data, usedforsecurity=False).digest()).decode()


def record_id(kind: str, *about: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, chr(31).join((kind, *about)))}>"


def split_response(block: bytes) -> tuple[int | None, list[tuple[str, str]], bytes]:
    """Status, headers in order and body of an HTTP message; a block without a head is all body."""
    first = re.match(rb"HTTP/\d(?:\.\d)?\s+(\d{3})", block)
    end = _HEAD_END.search(block) if first else None
    if not end:
        return None, [], block
    lines = block[: end.start()].decode("latin-1").splitlines()
    pairs: list[tuple[str, str]] = []
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if line[:1] in " \t" and pairs:
            pairs[-1] = (pairs[-1][0], f"{pairs[-1][1]} {line.strip()}")
        elif colon:
            pairs.append((name.strip(), value.strip()))
    return int(first[1]), pairs, block[end.end() :]


def _unchunked(body: bytes) -> bytes:
    """The data of a body in chunks; from where it is not one, the rest as it is."""
    parts, at = [], 0
    while m := re.compile(rb"([0-9a-fA-F]+)[^\r\n]*\r?\n").match(body, at):
        size = int(m[1], 16)
        if not size:
            return b"".join(parts)
        parts.append(body[m.end() : m.end() + size])
        at = m.end() + size
        at += 2 if body[at : at + 2] == b"\r\n" else body[at : at + 1] == b"\n"
    return b"".join([*parts, body[at:]])


def _inflated(body: bytes, coding: str) -> bytes:
    """A body without its content coding, of all its members; what cannot be read of it stays as it is, or is cut where it ends."""
    for window in {"gzip": (31,), "x-gzip": (31,), "deflate": (15, -15)}.get(coding, ()):
        parts, rest = [], body
        while rest:
            member = zlib.decompressobj(window)
            try:
                parts.append(member.decompress(rest))
            except zlib.error:
                break
            # Members follow each other, with zeros between them at most; what is no member ends them.
            rest = member.unused_data.lstrip(b"\0") if member.eof and window == 31 else b""
        if parts:
            return b"".join(parts)
    return body


def decoded(headers: list[tuple[str, str]], body: bytes) -> tuple[str, str]:
    """The text of a body, out of its transfer and content codings, and the charset it was read by.

    A byte order mark comes first, then the header's charset, then the first that a meta element names, wherever it
    stands; without any, or where
    the name is unknown, the text is UTF-8, or Windows-1252 if it is none.
    """
    by_name = {n.lower(): v for n, v in headers}
    if "chunked" in by_name.get("transfer-encoding", "").lower():
        body = _unchunked(body)
    for coding in reversed(by_name.get("content-encoding", "").lower().split(",")):
        body = _inflated(body, coding.strip())
    named = re.search(r"charset\s*=\s*[\"']?([^\s\"';,]+)", by_name.get("content-type", ""), re.IGNORECASE)
    meta = _META.search(body)
    said = [named and named[1], meta and meta[1].decode("ascii")]
    for name in [name for mark, name in _BOMS if body.startswith(mark)] + [x for x in said if x]:
        try:
            known = codecs.lookup(name)
            # As browsers do: what says Latin-1 or ASCII is written in Windows-1252.
            name = "cp1252" if known.name in ("iso8859-1", "ascii") else name
            return body.decode(name, "replace"), known.name
        except (LookupError, ValueError):
            continue
    try:
        return body.decode("utf-8"), "utf-8"
    except UnicodeDecodeError:
        return body.decode("cp1252", "replace"), "cp1252"


def _line(text: object) -> str:
    """A field's value, which is one line."""
    return " ".join(str(text).split())


def derive(row: dict) -> Iterator[tuple]:
    """The metadata and the conversion record of one response, as rows of ``RECORDS``."""
    block, uri, date = row["block"] or b"", row["target_uri"] or "", row["date"] or NO_DATE
    status, headers, body = split_response(block)
    source_digest = row["payload_digest"] or digest(body)
    response = row["record_id"] or record_id("response", uri, date, source_digest)
    kind = next((v for n, v in headers if n.lower() == "content-type"), "text/html").split(";")[0].strip().lower()
    page, charset = decoded(headers, body)
    markup = "html" in kind or kind in ("application/xml", "text/xml")
    pieces = visible_text(page) if markup else [page] if kind.startswith("text/") else []
    title = _TITLE.search(page) if markup else None
    facts = [("source-record", response), ("target-uri", uri), ("source-payload-digest", source_digest), ("source-payload-length", len(body))]
    facts += [("http-status", status)] * (status is not None) + [("http-header", f"{n}: {v}") for n, v in headers]
    facts += [("content-type", kind), ("charset", charset)]
    if title:
        facts.append(("title", title[1]))
    facts += [("links", len(_LINK.findall(page)) if markup else 0), ("blocks", len(pieces)), ("conversion", record_id("conversion", response))]
    fields = "".join(f"{n}: {_line(v)}{CRLF}" for n, v in facts)
    kept = json.dumps(headers, ensure_ascii=False)
    for name, content_type, content in (("metadata", "application/warc-fields", fields), ("conversion", "text/plain", "\n".join(pieces))):
        data = content.encode("utf-8", "replace")
        yield row["page_id"], name, record_id(name, response), response, uri, date, content_type, source_digest, digest(data), status, kept, len(data), data.decode()


def warc_bytes(row: dict, compress: bool = True) -> bytes:
    """A record as it stands in a WARC file; compressed, it is a gzip member of its own."""
    data = row["block"].encode()
    fields = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": row["record_id"],
        "WARC-Refers-To": row["refers_to"],
        "WARC-Target-URI": row["target_uri"],
        "WARC-Date": row["date"],
        "WARC-Refers-To-Payload-Digest": row["payload_digest"],
        "WARC-Source-HTTP-Headers": row["source_headers"],
        "WARC-Block-Digest": row["block_digest"],
        "Content-Type": row["content_type"],
        "Content-Length": str(len(data)),
    }
    head = "WARC/1.1" + CRLF + "".join(f"{k}: {_line(v)}{CRLF}" for k, v in fields.items() if v is not None) + CRLF
    record = head.encode() + data + (CRLF * 2).encode()
    return gzip.compress(record, mtime=0) if compress else record


def read_warc(file: io.BufferedReader) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an open WARC file, plain or compressed, one record at a time.

    A file that ends inside a record gives what there is of it.
    """
    source = gzip.GzipFile(fileobj=file) if file.peek(2)[:2] == b"\x1f\x8b" else file
    while line := source.readline():
        if not line.startswith(b"WARC/"):
            continue
        fields: dict[str, str] = {}
        last = ""
        while (line := source.readline()).strip():
            text = line.decode("utf-8", "replace").rstrip(CRLF)
            name, _, value = text.partition(":")
            if text[:1] in " \t" and last:
                fields[last] += f" {text.strip()}"
            else:
                last = name.strip().lower()
                fields[last] = value.strip()
        size = fields.get("content-length", "0")
        yield fields, source.read(int(size) if size.isdigit() else 0)


class _Raw(io.RawIOBase):
    """A file of any store as Python's buffered readers take it."""

    def __init__(self, stream) -> None:
        self.stream = stream

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.stream.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)


def records(spark: SparkSession, path: str) -> DataFrame:
    """``RESPONSES``, a row per record of any type in the WARC files of ``path``, a folder or glob too.

    Spark lists the files, whose contents are not read for that, and each is read by one task, a record at
    a time; ``headers`` holds all WARC fields as JSON. A field that a record lacks is null, as is ``page_id``.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RESPONSES.split(", ")]
        kinds = [pa.int64()] + [pa.string()] * 7 + [pa.binary()]
        for name in (x for batch in batches for x in batch.column("path").to_pylist()):
            place, inside = open_path(name)
            with place.open_input_stream(inside, compression=None) as stream:
                for fields, block in read_warc(io.BufferedReader(_Raw(stream), 1 << 20)):
                    row = [None, *(fields.get(x) for x in ("warc-type", "warc-record-id", "warc-target-uri", "warc-date", "content-type", "warc-payload-digest")), json.dumps(fields, ensure_ascii=False), block]
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], names)

    return files.repartition(max(1, files.count())).mapInArrow(run, RESPONSES)


def _uuid(*about: Column) -> Column:
    """A version-5 style UUID of some columns, as a record id."""
    h = F.sha1(F.concat_ws("\x1f", *(F.coalesce(x.cast("string"), F.lit("\x00")) for x in about)))
    parts = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(F.lit("8"), F.substring(h, 18, 3)), F.substring(h, 21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def responses(pages: DataFrame) -> DataFrame:
    """``RESPONSES`` of a pages table (page_id, url, html), which has neither ids nor HTTP heads.

    A row's id comes from what it holds; rows that repeat another are counted, and all but the first are
    told apart by their place in the table. A null url is an empty one, a null page an empty one.
    """
    url, text = (F.coalesce(pages[x].cast("string"), F.lit("")) for x in ("url", "html"))
    own = pages.select(pages["page_id"].cast("long").alias("page_id"), url.alias("target_uri"), text.alias("html"), F.monotonically_increasing_id().alias("place"))
    own = own.withColumn("key", F.xxhash64("page_id", "target_uri", "html"))
    repeated = own.groupBy("key").agg(F.count("*").alias("n"), F.min("place").alias("first")).where("n > 1").select("key", "first")
    own = own.join(few(saved(repeated, "repeated")), "key", "left")
    again = F.when(F.col("place") > F.col("first"), F.col("place"))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length("html").cast("string"), F.lit(CRLF * 2))
    return own.select(
        "page_id",
        F.lit("response").alias("record_type"),
        _uuid(F.col("page_id"), F.col("target_uri"), F.sha1(F.col("html")), again).alias("record_id"),
        "target_uri",
        F.lit(NO_DATE).alias("date"),
        F.lit("application/http; msgtype=response").alias("content_type"),
        F.lit(None).cast("string").alias("payload_digest"),
        F.lit(None).cast("string").alias("headers"),
        F.concat(head, F.col("html")).cast("binary").alias("block"),
    )


def derivatives(fetched: DataFrame) -> DataFrame:
    """Two rows of ``RECORDS`` for each response or resource in ``fetched`` (columns of ``RESPONSES``).

    Records of other types give none; a null type is a response. The id and the payload digest of the source are
    kept; where it lacks them, they come from its address, date and payload. A null block is empty and has
    no status; a null address is empty; a null date is 1970's first second; a null page_id is passed on. Content
    that is no text gives an empty conversion. Equal ids give equal derived ids. Repeated rows give repeated
    records, an empty table none. Other columns are not read, whatever their names.
    """
    names = [x.split()[0] for x in RECORDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "block"):
            rows = [r for row in part.to_pylist() for r in derive(row)]
            yield pa.RecordBatch.from_arrays([pa.array(x, _TYPES.get(n, pa.string())) for n, x in zip(names, zip(*rows, strict=True), strict=True)], names)

    wanted = fetched.where("record_type IS NULL OR record_type IN ('response', 'resource')")
    return wanted.select("page_id", "record_id", "target_uri", "date", "payload_digest", "block").mapInArrow(run, RECORDS)


def warc_members(rows: DataFrame) -> DataFrame:
    """(page_id, record_type, member): each record as a gzip member; joined, members are a WARC file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "block"):
            yield pa.RecordBatch.from_pydict({"page_id": part.column("page_id"), "record_type": part.column("record_type"), "member": pa.array([warc_bytes(r) for r in part.to_pylist()], pa.binary())})

    return rows.mapInArrow(run, "page_id long, record_type string, member binary")


def write_warc(rows: DataFrame, path: str) -> DataFrame:
    """Writes ``RECORDS`` as compressed WARC files of ``path``, one by each task; returns the manifest (name, n_records)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, folder = open_path(path)
        place.create_dir(folder, recursive=True)
        name, n = f"part-{uuid.uuid4().hex}.warc.gz", 0
        with place.open_output_stream(f"{folder}/{name}", compression=None) as out:
            for part in slices(batches, "block"):
                for row in part.to_pylist():
                    out.write(warc_bytes(row))
                n += part.num_rows
        yield pa.RecordBatch.from_pydict({"name": [name], "n_records": pa.array([n], pa.int64())})

    rows.mapInArrow(run, FILES).write.parquet(f"{path}/manifest")
    return rows.sparkSession.read.schema(FILES).parquet(f"{path}/manifest")
