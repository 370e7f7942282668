"""WARC archives: one gzip member per record, written by tasks and read back in byte ranges."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from sparkloom.llm.workspace import Workspace

MAGIC = b"\x1f\x8b\x08"
BLOCK = 1 << 18
RANGE_BYTES = 16 << 20
DATE = "2024-01-01T00:00:00Z"
RECORDS = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, " \
          "record_type string, refers_to long"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(page_id, url, payload: bytes, refers_to) -> bytes:
    """One record as a gzip member. A revisit has the HTTP head only, with the full length."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>",
            f"WARC-Date: {DATE}"]
    if url is not None:
        safe = re.sub(r"[\x00-\x20%]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {safe}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    head += [f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def _write(batches, root: str):
    """Write one archive; its final name depends on the partition alone, so a retry replaces it."""
    store, base = fs.FileSystem.from_uri(root)
    context = TaskContext.get()
    name = f"{base}/part-{context.partitionId():06d}.warc.gz"
    trial, out, size = f"{name}.{context.taskAttemptId()}", None, 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            out = out or store.open_output_stream(trial)
            member = _record(row[0], row[1], (row[2] or "").encode(), row[3])
            out.write(member)
            size += len(member)
    if out:
        out.close()
        store.move(trial, name)
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size])], ["file", "bytes"])


def mark_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``(page_id, url, html, refers_to)``: the smallest id with an equal payload, if it is another.

    Payloads of fewer than ``least_bytes`` bytes are never revisits. Rows that share the smallest id
    are all responses, and so are rows whose payload no row with an id has.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html",
                         F.sha1(F.coalesce("html", F.lit(""))).alias("sha"))
    firsts = (pages.where(F.coalesce(F.octet_length("html"), F.lit(0)) >= least_bytes)
              .groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
              .where("n > 1").select("sha", "first"))
    other = ~F.col("page_id").eqNullSafe(F.col("first"))
    return pages.join(firsts, "sha", "left").select("page_id", "url", "html",
                                                    F.when(other, F.col("first")).alias("refers_to"))


def write_warc(pages: DataFrame, work: Workspace, least_bytes: int = 0) -> DataFrame:
    """Write a record per row of ``pages(page_id, url, html)``; the files as ``(file, bytes)``.

    A null html is an empty payload, a null url has no target header, and an empty table makes no file.
    Tasks write to the shared folder through its own file system and rename when complete.
    """
    store, base = fs.FileSystem.from_uri(f"{work.root}/warc")
    store.create_dir(base, recursive=True)
    rows = mark_revisits(pages, least_bytes)
    return work.keep("files", rows.mapInArrow(partial(_write, root=f"{work.root}/warc"),
                                              "file string, bytes long"))


def _member(file, at: int) -> tuple[bytes, int] | None:
    """The decoded record that starts at ``at`` and where it ends; None if there is no record."""
    unpack, parts = zlib.decompressobj(31), []
    file.seek(at)
    try:
        while not unpack.eof:
            block = file.read(BLOCK)
            if not block:
                return None
            at += len(block)
            if not parts:
                parts.append(unpack.decompress(block, 8))
                if len(parts[0]) < 8 or not parts[0].startswith(b"WARC/1."):
                    return None
                block = unpack.unconsumed_tail
            parts.append(unpack.decompress(block))
    except zlib.error:
        return None
    record = b"".join(parts)
    return (record, at - len(unpack.unused_data)) if b"\r\n\r\n" in record else None


def _headers(head: bytes) -> dict[str, str]:
    lines = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in lines}


def _page(value: str | None) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?\d+)>", value or "")
    return int(found[1]) if found else None


def records_in(store: fs.FileSystem, path: str, begin: int, end: int) -> Iterator[tuple]:
    """Records that start in ``[begin, end)``; the last may reach beyond.

    Bytes before the first member are scanned for the gzip magic. A candidate counts if it decodes to a
    WARC header; after it, reading goes on where it ends.
    """
    with store.open_input_file(path) as file:
        at = begin
        while at < end:
            file.seek(at)
            seen = file.read(min(BLOCK, end - at) + len(MAGIC) - 1)
            hit = seen.find(MAGIC)
            if hit < 0:
                at += max(1, len(seen) - len(MAGIC) + 1)
                continue
            at += hit
            if at >= end:
                return
            member = _member(file, at)
            if member is None:
                at += 1
                continue
            record, at = member
            head, _, rest = record.partition(b"\r\n\r\n")
            warc = _headers(head)
            block = rest[:int(warc["content-length"])]
            http, _, payload = block.partition(b"\r\n\r\n")
            revisit = warc["warc-type"] == "revisit"
            digest = warc["warc-payload-digest"].removeprefix("sha1:")
            if not revisit and digest != digest_of(payload):
                raise ValueError(f"{path}: a payload before byte {at} differs from its digest")
            url = warc.get("warc-target-uri")
            yield (_page(warc["warc-record-id"]),
                   None if url is None else re.sub(
                       r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), url),
                   None if revisit else payload,
                   int(_headers(http)["content-length"]), digest, warc["warc-type"],
                   _page(warc.get("warc-refers-to")))


def _read(batches, root: str):
    store, _ = fs.FileSystem.from_uri(root)
    names = [x.split()[0] for x in RECORDS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    for batch in batches:
        for path, begin, end in zip(*(c.to_pylist() for c in batch.columns)):
            rows, size = [], 0
            for row in records_in(store, path, begin, end):
                rows.append(row)
                size += len(row[2] or b"")
                if size > 4 * BLOCK or len(rows) == 1000:
                    yield batch_of(rows)
                    rows, size = [], 0
            if rows:
                yield batch_of(rows)


def read_warc(files: DataFrame, root: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of ``files(file, bytes)``, a task for each byte range of about ``range_bytes``.

    Columns are those of ``RECORDS``; the payload of a revisit is null, its length and digest are those
    of the full payload. ``root`` is any path of the store that holds the files.
    """
    begin = F.explode(F.sequence(F.lit(0), F.greatest(F.col("bytes") - 1, F.lit(0)),
                                 F.lit(range_bytes)))
    ranges = files.select("file", begin.alias("begin"), "bytes").select(
        "file", F.col("begin").cast("long").alias("begin"),
        F.least(F.col("begin") + range_bytes, "bytes").cast("long").alias("end"))
    parts = max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return ranges.repartition(parts, "file", "begin").mapInArrow(partial(_read, root=root), RECORDS)
