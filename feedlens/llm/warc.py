"""Operator 8: WARC archives, written with one gzip member per record and read back by splits.

Writer: each task writes one archive under a temporary name in the shared folder and moves it
to its final, deterministic name when complete, so a retried or lost task leaves no partial file.

Reader: archives are cut into byte ranges that know nothing of record borders. A task looks for
gzip magic in its range, accepts a candidate only if its bytes inflate to a WARC header, and
owns every record that *starts* inside the range, reading past the range's end to finish the last one.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, fresh_folder, map_rows

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
#: Payloads of fewer bytes are never written as revisits.
MIN_REVISIT_BYTES = 0
#: Bytes of archive that one reading task owns.
SPLIT_BYTES = 8 << 20
READ_BYTES = 1 << 20
#: Bytes of archive inflated at a time.
INFLATE_BYTES = 64 << 10

HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
FILES = "file string, file_bytes bigint, records bigint"
RECORDS = ("record_type string, record_id string, url string, payload_digest string, payload_bytes bigint, "
           "refers_to string, payload binary")


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_leaders(pages: DataFrame, id_col: str, payload_col: str, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``leader``: for payloads shared by several pages, the smallest id among them; else null.

    Pages are grouped by SHA-1 and length with map-side combine, so that a payload held by a
    third of all pages is one row for each task; the join back has one row on its other side.
    """
    keyed = (pages.select(F.col(id_col).alias("page"), F.col("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("body"))
             .withColumns({"sha": F.sha1(F.col("body").cast("binary")), "size": F.octet_length("body").cast("long")}))
    leaders = (keyed.groupBy("sha", "size").agg(F.min("page").alias("leader"), F.count("*").alias("n"))
               .where((F.col("n") > 1) & (F.col("size") >= min_bytes)).drop("n", "size"))
    return keyed.join(leaders, "sha", "left").select("page", "url", "body", "leader")


def record(kind: str, page, url: str | None, payload: bytes, leader) -> bytes:
    """One gzip member. A revisit has no payload; its header keeps the payload's digest and length."""
    block = HTTP_HEAD + payload if kind == "response" else HTTP_HEAD
    target = (url or "").replace("\r", " ").replace("\n", " ")
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
            f"WARC-Target-URI: {target}", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Payload-Digest: sha1:{payload_digest(payload)}", f"X-Payload-Length: {len(payload)}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{leader}>"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = VERSION + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packer.compress(data) + packer.flush()


def write(pages: DataFrame, folder: str, id_col: str = "page_id", payload_col: str = "html") -> DataFrame:
    """Write every page as a record below ``folder``; one row per archive (file, bytes, records).

    Null payloads are empty. Among equal payloads the page with the smallest id is the response (each of its
    repeated rows), the others revisit it; pages with a null id come after all others. Null urls are empty.
    """
    def run(rows):
        context = TaskContext.get()
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        name = f"part-{context.partitionId() if context else 0:06d}.warc.gz"
        hidden = f"{base}/.{name}.{uuid.uuid4().hex}"
        size = count = 0
        with fs.open_output_stream(hidden) as out:
            for page, url, body, leader in rows:
                kind = "response" if leader is None or page == leader else "revisit"
                data = record(kind, page, url, body.encode(), leader)
                out.write(data)
                size, count = size + len(data), count + 1
        if count:
            fs.move(hidden, f"{base}/{name}")
            yield f"{folder}/{name}", size, count
        else:
            fs.delete_file(hidden)

    return map_rows(with_leaders(pages, id_col, payload_col), run, FILES)


def parse(data: bytes) -> tuple:
    """A whole inflated record as a row of ``RECORDS``; payloads are checked against their digests."""
    head, _, rest = data[len(VERSION):].partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n"))
    bare = lambda key: fields.get(key, "").removeprefix("<urn:page:").removesuffix(">") or None
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    payload = None
    if kind == "response":
        payload = rest[:int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]
        if payload_digest(payload) != digest:
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    size = len(payload) if payload is not None else int(fields["X-Payload-Length"])
    return kind, bare("WARC-Record-ID"), fields["WARC-Target-URI"] or None, digest, size, bare("WARC-Refers-To"), payload


class Window:
    """Bytes of a file from some offset on, read as far as asked."""

    def __init__(self, source, start: int, size: int):
        # bytes are added at the end and dropped at the front without copying the others
        self.source, self.size, self.base, self.data = source, size, start, bytearray()
        source.seek(start)

    def more(self) -> bool:
        got = self.source.read(READ_BYTES)
        self.data += got
        return bool(got)

    def drop(self, to: int) -> None:
        del self.data[:to - self.base]
        self.base = to


def member(window: Window, at: int) -> tuple[bytes, int] | None:
    """The record whose gzip member starts at ``at``, and where it ends; None if it is no record."""
    engine = zlib.decompressobj(31)
    out, fed, checked = [], at, False
    while not engine.eof:
        chunk = window.data[fed - window.base:fed - window.base + INFLATE_BYTES]
        if not chunk:
            if not window.more():
                return None
            continue
        try:
            out.append(engine.decompress(chunk))
        except zlib.error:
            return None
        fed += len(chunk)
        if not checked:
            start = b"".join(out)
            if start[:len(VERSION)] != VERSION[:len(start)]:
                return None
            head, ended, _ = start.partition(b"\r\n\r\n")
            if ended:
                if b"\r\nContent-Length: " not in head:
                    return None
                checked = True
            elif engine.eof:
                return None
    return b"".join(out), fed - len(engine.unused_data)


def records_in(source, size: int, start: int, end: int) -> Iterator[tuple]:
    """Rows of the records that start in [start, end)."""
    window, at = Window(source, start, size), start
    while at < end:
        found = window.data.find(MAGIC, at - window.base)
        if found < 0:
            keep = max(at, window.base + len(window.data) - len(MAGIC) + 1)
            if not window.more():
                return
            at = keep
            window.drop(at)
            continue
        at = window.base + found
        if at >= end:
            return
        window.drop(at)
        got = member(window, at)
        if got is None:
            at += 1
        else:
            yield parse(got[0])
            at = got[1]


def read(spark: SparkSession, files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records of the archives in ``files`` (columns file, file_bytes), each owned by exactly one byte range."""
    ranges = files.select("file", "file_bytes", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("file_bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"))

    def run(rows):
        for file, size, start in rows:
            fs, path = pafs.FileSystem.from_uri(file)
            with fs.open_input_file(path) as source:
                yield from records_in(source, size, start, min(size, start + split_bytes))

    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return map_rows(ranges.where("file_bytes > 0").repartition(n), run, RECORDS)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages as archives into the shared folder, read them back: one row per page, or an error."""
    spark = pages.sparkSession
    files = cut(write(pages, fresh_folder(spark, "warc")))
    found = cut(read(spark, files).select(
        F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to")))
    written, got = files.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0], found.count()
    if got != written:
        raise RuntimeError(f"{written} records written, {got} read")
    return found
