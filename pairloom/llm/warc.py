"""Web archives: a writer with payload deduplication and a splittable reader."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joins import fits_broadcast
from ..session import new_path, store

SPLIT_BYTES = 8 << 20
MAGIC = b"\x1f\x8b\x08"
_READ = 1 << 20
_HEAD = 4096
_DATE = "2000-01-01T00:00:00Z"


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(value: str | None) -> str:
    """A header value: line ends and other control characters are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value or "")


def record(kind: str, page_id: int | None, url: str | None, refers_to: int | None, digest: str, size: int, payload: bytes) -> bytes:
    """One record as a gzip member. A revisit holds the headers of the payload it refers to, not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {_DATE}", f"WARC-Target-URI: {_line(url)}",
        f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
    ]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {name(refers_to)}"]
    head.append(f"Content-Length: {len(http) + len(payload)}")
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + http + payload + b"\r\n\r\n", 6, mtime=0)


def _roles(pages: DataFrame, least_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(responses with payload, revisits without): of equal payloads of at least ``least_bytes`` bytes the row
    with the largest page_id (then url; nulls are smallest) is the response."""
    place = F.struct("page_id", "url")
    slim = pages.select("page_id", "url", "digest", "size")
    shared = F.col("size") >= least_bytes
    lead = slim.filter(shared).groupBy("digest").agg(F.max(place).alias("lead"), F.max("size").alias("size"))
    again = slim.filter(shared).join(lead.select("digest", "lead"), "digest").filter(~place.eqNullSafe(F.col("lead")))
    revisits = again.select("page_id", "url", "digest", "size", F.col("lead.page_id").alias("refers_to"))
    # rows that repeat the leading page_id, url and payload: one of them responds
    same = slim.filter(shared).groupBy("digest", "page_id", "url", "size").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    copies = same.join(lead.select("digest", "lead"), "digest").filter(place.eqNullSafe(F.col("lead")))
    copies = store(copies.select("page_id", "url", "digest", "size", "n"), "warc-copies")
    lead = store(lead.select("digest", F.col("lead.page_id").alias("p"), F.col("lead.url").alias("u")), "warc-leads")
    side = lead.withColumnRenamed("digest", "d")
    side = F.broadcast(side) if fits_broadcast(lead) else side
    found = pages.join(side, (F.col("digest") == F.col("d")) & F.col("page_id").eqNullSafe(F.col("p")) & F.col("url").eqNullSafe(F.col("u")))
    responses = found.select(*pages.columns)
    if copies.limit(1).count():
        responses = responses.dropDuplicates(["digest", "page_id", "url"])
        more = copies.select("page_id", "url", "digest", "size", F.col("page_id").alias("refers_to"), F.explode(F.sequence(F.lit(2), F.col("n"))).alias("k"))
        revisits = revisits.union(more.drop("k"))
    return responses.union(pages.filter(~shared)), revisits


def write_warc(pages: DataFrame, folder: str | None = None, *, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write one record per row of ``pages`` and return the manifest (path, size, n_records).

    The payload is the text in UTF-8, a null text an empty one. Of rows with equal payloads of at
    least ``least_bytes`` bytes, that with the largest page_id is a response and the others are revisits that refer to
    it; a null page_id counts as smallest, equal ids go by url, and of wholly repeated rows one responds. Each
    task writes one file under ``folder`` (default: below the shared folder) through a file system that all
    executors reach; a task that runs twice writes two files, and only the one in the manifest counts.
    """
    spark = pages.sparkSession
    folder = folder or new_path(spark, "warc")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.sha1(text).alias("digest"),
        F.octet_length(text).cast("bigint").alias("size"), text.alias("html"),
    )
    responses, revisits = _roles(rows, least_bytes)
    nothing = F.lit(None).cast("bigint")
    records = responses.select("page_id", "url", "digest", "size", "html", F.lit("response").alias("kind"), nothing.alias("refers_to")).union(
        revisits.select("page_id", "url", "digest", "size", F.lit("").alias("html"), F.lit("revisit").alias("kind"), "refers_to")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = pafs.FileSystem.from_uri(folder)
        path, size, n, out = None, 0, 0, None
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    system.create_dir(base, recursive=True)
                    path = f"{base}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
                    out = system.open_output_stream(path, compression=None)
                digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
                member = record(row["kind"], row["page_id"], row["url"], row["refers_to"], digest, row["size"], row["html"].encode())
                out.write(member)
                size += len(member)
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{path.rsplit('/', 1)[1]}"], "size": [size], "n_records": [n]})

    return store(records.mapInArrow(write, "path string, size bigint, n_records bigint"), "warc-manifest")


class _Window:
    """Bytes of a file from any position on, held only around the place being read."""

    def __init__(self, file):
        self.file, self.at, self.data = file, 0, b""

    def bytes_from(self, pos: int, n: int) -> bytes:
        if not self.at <= pos or pos + n > self.at + len(self.data):
            self.file.seek(pos)
            self.at, self.data = pos, self.file.read(max(n, _READ))
        return self.data[pos - self.at : pos - self.at + n]


def _member_at(window: _Window, pos: int) -> bool:
    """Whether a gzip member whose content begins a record starts at ``pos``."""
    try:
        return zlib.decompressobj(31).decompress(window.bytes_from(pos, _HEAD), 64).startswith(b"WARC/")
    except zlib.error:
        return False


def _next_member(window: _Window, pos: int, end: int) -> int:
    """The first record at or after ``pos`` that starts before ``end``; else ``end``."""
    while pos < end:
        data = window.bytes_from(pos, _READ)
        if not data:
            return end
        k = data.find(MAGIC)
        while k >= 0:
            if pos + k >= end:
                return end
            if _member_at(window, pos + k):
                return pos + k
            k = data.find(MAGIC, k + 1)
        pos += max(1, len(data) - len(MAGIC) + 1)
    return end


def _inflate(window: _Window, pos: int) -> tuple[bytes, int] | None:
    """The member at ``pos`` and the position after it; None if it is damaged or cut off."""
    inflate, parts = zlib.decompressobj(31), []
    while not inflate.eof:
        data = window.bytes_from(pos, 1 << 16)
        if not data:
            return None
        try:
            parts.append(inflate.decompress(data))
        except zlib.error:
            return None
        pos += len(data) - len(inflate.unused_data)
    return b"".join(parts), pos


def records_in(file, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of the records that start in [start, end), read to their ends beyond it.

    Candidates are the gzip magic bytes; one counts as a member when its first bytes inflate to a record's
    beginning. Damaged members are passed over: the search goes on behind their first byte.
    """
    window, pos = _Window(file), start
    while (pos := _next_member(window, pos, end)) < end:
        got = _inflate(window, pos)
        if got is None:
            pos += 1
            continue
        raw, after = got
        head, _, body = raw.partition(b"\r\n\r\n")
        lines = head.decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        length = int(headers["content-length"]) if headers.get("content-length", "").isdigit() else len(body)
        yield pos, headers, body[:length]
        pos = after


def read_warc(files: DataFrame, *, split_bytes: int = SPLIT_BYTES, payload: bool = True) -> DataFrame:
    """All records of gzipped archives: path, offset, record_type, record_id, target_uri, refers_to, payload_bytes,
    payload_digest and, unless switched off, payload.

    ``files`` is (path, size). Every range of ``split_bytes`` is a task's work of its own, so one large file is read by
    many tasks; a record belongs to the range in which it starts. The payload is what follows
    the HTTP headers; a revisit has none (null), and its size and digest are those its headers state.
    """
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(split_bytes).cast("bigint")))
    ranges = files.select("path", "size", starts.alias("start"))
    n = ranges.count()
    dealt = ranges.repartition(max(1, min(n, 100_000)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                system, path = pafs.FileSystem.from_uri(r["path"])
                with system.open_input_file(path) as file:
                    held, size = [], 0
                    for offset, head, block in records_in(file, r["start"], min(r["start"] + split_bytes, r["size"])):
                        held.append(_row(r["path"], offset, head, block, payload))
                        size += len(block) if payload else 200
                        if size > 1 << 22:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
                    if held:
                        yield pa.RecordBatch.from_pylist(held, schema)

    text = ("path", "record_type", "record_id", "target_uri", "refers_to", "payload_digest")
    schema = pa.schema([(c, pa.string()) for c in text] + [("offset", pa.int64()), ("payload_bytes", pa.int64())] + [("payload", pa.binary())] * payload)
    names = ", ".join(f"{c} string" for c in text) + ", offset bigint, payload_bytes bigint" + ", payload binary" * payload
    return dealt.mapInArrow(read, names)


def _row(path: str, offset: int, head: dict[str, str], block: bytes, with_payload: bool) -> dict:
    http, _, body = block.partition(b"\r\n\r\n")
    kind = head.get("warc-type")
    stated = re.search(rb"(?im)^content-length:\s*(\d+)", http)
    revisit = kind == "revisit"
    return {
        "path": path, "offset": offset, "record_type": kind, "record_id": head.get("warc-record-id"), "target_uri": head.get("warc-target-uri"),
        "refers_to": head.get("warc-refers-to"),
        "payload_bytes": int(stated[1]) if revisit and stated else len(body),
        "payload_digest": head.get("warc-payload-digest", "").removeprefix("sha1:") if revisit else digest_of(body),
    } | ({"payload": None if revisit else body} if with_payload else {})


def page_of(name: str | Column) -> Column:
    """The page id in a record's name; null if there is none."""
    c = F.col(name) if isinstance(name, str) else name
    return F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("bigint")


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write the archives of ``pages`` and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    back = read_warc(write_warc(pages, **options).select("path", "size"), payload=False)
    return back.select(page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of("refers_to").alias("refers_to"))


#: The same in DuckDB: the base32 form goes by groups of five bits.
SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) payload_bytes, sha1(h) x, max(page_id) OVER (PARTITION BY h) lead FROM p)
SELECT page_id, payload_bytes::BIGINT payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + ((('0x' || substr(x || '000', 1 + (5 * i) // 4, 3))::INTEGER >> (12 - 5 - (5 * i) % 4)) & 31), 1)), '') payload_digest,
    CASE WHEN page_id = lead THEN 'response' ELSE 'revisit' END record_type,
    CASE WHEN page_id <> lead THEN lead END refers_to
FROM d
"""
