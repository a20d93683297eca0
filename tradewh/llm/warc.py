"""WARC archives: writing captures, and transaction assembly on reading.

Writing: one request, one response (or revisit) and one metadata record per
page, tied together by WARC-Concurrent-To, in gzip-per-record parts that tasks
stream to the shared folder. Records are compressed where the pages are read,
so what is shuffled is no more than what is written. Of pages with equal payloads of ``REVISIT_BYTES``
bytes and more, that with the largest page_id is a response, the others are
revisits that refer to it; equality is found by SHA-1 and length, in an
aggregate with map-side combination, so a payload that a third of all pages
share is one row per task. Pages meet their verdict by page_id, never by
payload, so a common payload makes no hot task.

Reading: parts are parsed record by record; ``assemble`` joins the request and
metadata records to their response or revisit through the concurrent-to
identifiers and gives one nested row per capture.

Defined results: a null html is an empty payload; null urls are written as an
empty target; of repeated rows of the response's page the first is the
response, the rest are revisits; rows without page_id take part and lose
against any with one (all rows of one payload without page_id are written by one
task, one after the other); payloads of any length are written whole; an empty table gives no captures.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tradewh.llm.common import pick, shared_folder, store
from tradewh.operators.materialize import materialize

REVISIT_BYTES = 1000
_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space of RFC 4122


# -- records -----------------------------------------------------------------

def record_id(role: str, page_id: int | None, digest: str, copy: int = 0) -> str:
    """The same page, payload and role always have the same identifier."""
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{role}/{page_id}/{digest}/{copy}')}>"


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC/1.1 record, compressed on its own."""
    lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in headers], f"Content-Length: {len(block)}", "", ""]
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + z.flush()


def capture(page_id: int | None, url: str | None, payload: bytes | None, n: int, digest: str, copy: int = 0,
            refers: tuple | None = None) -> bytes:
    """Request, response or revisit, and metadata of one page with a payload of
    ``n`` bytes; ``refers`` is the (page_id, digest) of the response that a
    revisit, which needs no payload, repeats."""
    uri = " ".join((url or "").split())
    host, _, path = uri.partition("://")[2].partition("/")
    role = "revisit" if refers else "response"
    head = record_id(role, page_id, digest, copy)
    b32 = base64.b32encode(bytes.fromhex(digest)).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    common = [("WARC-Date", _DATE), ("WARC-Target-URI", uri)]
    main = [("WARC-Type", role), ("WARC-Record-ID", head), *common, ("WARC-Payload-Digest", f"sha1:{b32}"),
            ("Content-Type", "application/http; msgtype=response")]
    if refers:
        main += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", record_id("response", *refers))]
    ask = [("WARC-Type", "request"), ("WARC-Record-ID", record_id("request/" + role, page_id, digest, copy)), *common,
           ("WARC-Concurrent-To", head), ("Content-Type", "application/http; msgtype=request")]
    meta = [("WARC-Type", "metadata"), ("WARC-Record-ID", record_id("metadata/" + role, page_id, digest, copy)), *common,
            ("WARC-Concurrent-To", head), ("Content-Type", "application/warc-fields")]
    fields = b"" if page_id is None else f"page-id: {page_id}\r\n".encode()
    return (record(ask, f"GET /{path} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode())
            + record(main, http + (b"" if refers else payload)) + record(meta, fields))


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a compressed or plain WARC stream.

    Header names come in lower case. Memory: one record and a read buffer.
    """
    lines = io.BufferedReader(_Inflate(stream), 1 << 20)
    while True:
        line = lines.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers: dict[str, str] = {}
        while (line := lines.readline().rstrip(b"\r\n")):
            k, _, v = line.decode("utf-8", "replace").partition(":")
            headers[k.strip().lower()] = v.strip()
        yield headers, lines.read(int(headers["content-length"]))


class _Inflate(io.RawIOBase):
    """The plain bytes of a stream of gzip members (or of a plain stream)."""

    def __init__(self, stream):
        self.stream, self.z, self.raw, self.plain = stream, None, b"", None

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while True:
            if not self.raw:
                self.raw = self.stream.read(1 << 18)
                if not self.raw:
                    return 0
            if self.plain is None:
                self.plain = self.raw[:2] != b"\x1f\x8b"
            if self.plain:
                out, self.raw = self.raw[:len(buffer)], self.raw[len(buffer):]
            else:
                self.z = self.z or zlib.decompressobj(31)
                out = self.z.decompress(self.raw, len(buffer))
                self.raw = self.z.unconsumed_tail
                if self.z.eof:
                    self.raw, self.z = self.z.unused_data, None
            if out:
                buffer[:len(out)] = out
                return len(out)


# -- writing -----------------------------------------------------------------

def plan(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, digest, n (bytes of payload), the capture as a response, and
    for pages of a repeated payload the page_id of its response (``is_copy``
    tells a null one from none)."""
    pages = pick(pages, page_id="long", url="string", html="string").select(
        "page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    pages = pages.select("page_id", "url", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("n"), "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "n", "digest")))
            done = pa.array([capture(*row) for row in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "url", "digest", "n")), done],
                                             ["page_id", "url", "digest", "n", "capture"])

    # One text for page and payload, so that the rows are shuffled once: the join
    # below and the writer find the rows of one page and payload together.
    key = F.concat(F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("/"), F.col("digest")).alias("key")
    rows = pages.mapInArrow(run, "page_id long, url string, digest string, n int, capture binary").select("*", key).repartition("key")
    slim = pages.where(F.col("n") >= revisit_bytes).select("page_id", "digest", "n")
    # One row per task and payload leaves the map side, however often it occurs.
    tops = slim.groupBy("digest", "n").agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("copies"))
    tops = tops.where("copies > 1").select("digest", "n", "top")
    copies = slim.join(tops, ["digest", "n"]).groupBy(key).agg(F.max("top").alias("top")).withColumn("is_copy", F.lit(True))
    return rows.join(copies, "key", "left").select(
        "page_id", "url", "digest", "n", "capture", "top", F.coalesce("is_copy", F.lit(False)).alias("is_copy"))


def write(pages: DataFrame, folder: str | None = None, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Write the archives; returns the manifest (folder, name, captures), a
    written table. Parts that it doesn't name belong to tasks that were lost."""
    folder = folder or shared_folder(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, out, n = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}.warc.gz", None, 0
        now, copy = None, 0
        for batch in batches:
            for page_id, url, digest, size, done, top, is_copy in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    fs, path = store(folder)
                    fs.create_dir(path, recursive=True)
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)  # records compress themselves
                    out.write(record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id("warcinfo", None, name)),
                                      ("WARC-Date", _DATE), ("Content-Type", "application/warc-fields")], b"format: WARC file version 1.1\r\n"))
                copy = copy + 1 if (page_id, digest) == now else 0
                now = (page_id, digest)
                if is_copy and (page_id != top or copy):
                    done = capture(page_id, url, None, size, digest, copy, (top, digest))
                elif copy:  # a page's row again: the same capture with identifiers of its own
                    payload = next(b for h, b in records(io.BytesIO(done)) if h["warc-type"] == "response").partition(b"\r\n\r\n")[2]
                    done = capture(page_id, url, payload, size, digest, copy)
                out.write(done)
                n += 1
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"folder": [folder], "name": [name], "captures": pa.array([n], pa.int64())})

    # Rows of one page and payload lie together and follow each other here, so
    # that repeats of it are told apart.
    rows = plan(pages, revisit_bytes).sortWithinPartitions("page_id", "digest", "url")
    return materialize(rows.mapInArrow(run, "folder string, name string, captures long"), "warc-parts")


# -- reading -----------------------------------------------------------------

_FIELDS = [("record_id", pa.string()), ("type", pa.string()), ("uri", pa.string()), ("date", pa.string()), ("concurrent_to", pa.string()),
           ("refers_to", pa.string()), ("digest", pa.string()), ("payload_bytes", pa.int64()), ("fields", pa.string()), ("payload", pa.binary())]


def _row(headers: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    kind, payload, fields = headers.get("warc-type"), None, None
    digest = headers.get("warc-payload-digest", "")
    digest = base64.b32decode(digest[5:]).hex() if digest.startswith("sha1:") else None
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if digest is not None and hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"payload of {headers.get('warc-record-id')} doesn't match its digest")
    elif kind == "metadata":
        fields = block.decode("utf-8", "replace")
    return (headers.get("warc-record-id"), kind, headers.get("warc-target-uri"), headers.get("warc-date"), headers.get("warc-concurrent-to"),
            headers.get("warc-refers-to"), digest, None if payload is None else len(payload), fields, payload if with_payload else None)


def read_records(parts: DataFrame, with_payload: bool = True) -> DataFrame:
    """A row per record of the parts (folder, name)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _FIELDS)], [f for f, _ in _FIELDS])

        rows, size = [], 0
        for batch in batches:
            for part in batch.to_pylist():
                fs, path = store(part["folder"])
                with fs.open_input_stream(f"{path}/{part['name']}", compression=None) as f:
                    for headers, block in records(f):
                        rows.append(_row(headers, block, with_payload))
                        size += len(block)
                        if len(rows) >= 5000 or size >= 1 << 24:
                            yield flush()
                            rows, size = [], 0
        if rows:
            yield flush()

    n = max(1, parts.count())
    return parts.select("folder", "name").repartitionByRange(n, "name").mapInArrow(
        run, "record_id string, type string, uri string, date string, concurrent_to string, refers_to string, digest string,"
             " payload_bytes long, fields string, payload binary")


def assemble(rows: DataFrame) -> DataFrame:
    """One nested row per capture: its response or revisit (``head``) and the
    request and metadata records that name it as concurrent."""
    head = rows.where("type IN ('response', 'revisit')").select(
        F.col("record_id").alias("capture_id"), F.struct(*[c for c in rows.columns if c not in ("concurrent_to", "fields")]).alias("head"))
    around = rows.where("type IN ('request', 'metadata') AND concurrent_to IS NOT NULL").select(
        F.col("concurrent_to").alias("capture_id"), "type", F.struct("record_id", "uri", "date", "fields").alias("r"))
    around = around.groupBy("capture_id").agg(F.min(F.when(F.col("type") == "request", F.col("r"))).alias("request"),
                                              F.min(F.when(F.col("type") == "metadata", F.col("r"))).alias("metadata"))
    return head.join(around, "capture_id", "left").select("capture_id", "request", "head", "metadata")


def page_digest(captures: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of each
    capture; a revisit has its payload's length from the response it refers to."""
    rows = captures.select(
        "capture_id", F.expr("cast(regexp_extract(metadata.fields, '(?m)^page-id: (-?[0-9]+)', 1) as string)").alias("page"),
        F.col("head.type").alias("record_type"), F.col("head.payload_bytes").alias("n"), F.col("head.digest").alias("payload_digest"),
        F.col("head.refers_to").alias("refers")).withColumn("page_id", F.nullif("page", F.lit("")).cast("long"))
    # From a table both sides of the join are shuffled by what is referred to, and
    # AQE splits the revisits of a response that a third of all pages repeat.
    rows = materialize(rows, "warc-captures")
    responses, revisits = rows.where("record_type = 'response'"), rows.where("record_type = 'revisit'")
    # Responses refer to nothing: only revisits are joined, with the responses.
    whole = responses.select(F.col("capture_id").alias("refers"), F.col("page_id").alias("refers_to"), F.col("n").alias("full"))
    found = revisits.join(whole, "refers", "left").select(
        "page_id", F.coalesce("n", "full").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
    return found.unionByName(responses.select("page_id", F.col("n").alias("payload_bytes"), "payload_digest", "record_type",
                                              F.lit(None).cast("long").alias("refers_to")))
