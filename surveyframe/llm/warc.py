"""Operator 7 - WARC: writing archives and a sequential reader.

Writer: each task writes archives of about ``ARCHIVE_BYTES``, one gzip member per
record, to the shared folder and returns their paths. Only what Spark commits
counts: the list of archives is a Parquet table, so files of lost or repeated
tasks are never read.

Reader: one archive per row; members are decompressed incrementally with zlib,
records are framed by Content-Length, and payload digests are verified. Nothing
larger than one record and one read block is held.

Equal payloads (of at least ``min_bytes``) are one group, found by their digest:
the record with the largest ``page_id`` is the response, the others revisit it.
The groups come from one aggregation that combines before it shuffles, so a
payload that a third of the pages share is one row per task there. Payloads shared by
more than ``HOT_ROWS`` pages (so there are at most pages / HOT_ROWS of them, a line of
a few hundred bytes each) are told to all tasks; only pages of other payloads are dealt by digest.

Reading back: one task per archive, whatever the size of the list.

Defined results: null html is an empty payload; a null ``page_id`` ranks below all
others; rows with the same page_id and payload: one is the response, the others
revisit it. Null urls are written as empty.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, stored, work_dir

ARCHIVE_BYTES = 64 << 20
READ_BYTES = 1 << 18
HOT_ROWS = 1 << 16
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def file_system(uri: str):
    """The file system of a folder name, and the path in it."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, rid: str, url: str, sha1: str, n: int, payload: bytes, refers: str | None) -> bytes:
    """One record: headers, blank line, block, two line ends."""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{rid}>", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{sha1}", f"X-Payload-Length: {n}"]
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers}>"]
    else:
        head += ["Content-Type: text/html; charset=utf-8"]
    head.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def members(read) -> Iterator[bytes]:
    """The decompressed gzip members of a stream, one after the other; ``read(n)`` gives bytes."""
    z, out, data = zlib.decompressobj(31), bytearray(), read(READ_BYTES)
    fresh = True
    while data:
        out += z.decompress(data)
        fresh = False
        if z.eof:
            yield bytes(out)
            data, z, out, fresh = z.unused_data, zlib.decompressobj(31), bytearray(), True
        else:
            data = b""
        data = data or read(READ_BYTES)
    if not fresh:
        raise ValueError("the archive ends inside a gzip member")


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of one record; checks its framing and digest."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not sep or not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {}
    for line in lines:
        name, _, value = line.partition(":")
        headers[name.lower()] = value.strip()
    n = int(headers["content-length"])
    block = rest[:n]
    if len(block) != n or rest[n:] != b"\r\n\r\n":
        raise ValueError("the record's length does not match its Content-Length")
    if headers["warc-type"] == "response" and headers["warc-payload-digest"] != f"sha1:{digest(block)}":
        raise ValueError("payload digest mismatch")
    return headers, block


def plan_records(pages: DataFrame, min_bytes: int = 0, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Pages with payload bytes, digest, record type and what a revisit refers to."""
    p = pages.select(F.col("page_id").cast("long"), F.coalesce("url", F.lit("")).alias("url"),
                     F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    p = p.select("*", F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("payload_bytes"),
                 F.monotonically_increasing_id().alias("row"))
    who = F.struct("page_id", "url", "row")
    top = (p.where(F.col("payload_bytes") >= min_bytes).groupBy("sha1")
           .agg(F.max(who).alias("top"), F.count(F.lit(1)).alias("copies")).where("copies > 1"))
    top = stored(top, "warc-groups")
    hot = F.broadcast(top.where(F.col("copies") > hot_rows).select("sha1", "top"))
    rest = top.where(F.col("copies") <= hot_rows).select("sha1", "top")
    j = p.join(hot, "sha1").unionByName(p.join(hot.select("sha1"), "sha1", "left_anti").join(rest, "sha1", "left"))
    same = (F.col("top.page_id").eqNullSafe(F.col("page_id")) & (F.col("top.row") == F.col("row")))
    revisit = F.col("top").isNotNull() & ~same & (F.col("payload_bytes") >= min_bytes)
    return j.select("page_id", "url", "payload", "payload_bytes", revisit.alias("revisit"),
                    F.when(revisit, F.col("top.page_id")).alias("refers_to"))


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the records as gzip archives under ``folder``; the stored list (path, records)."""

    def run(it):
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        out, path, size, n = None, None, 0, 0
        done = []
        for b in it:
            for pid, url, payload, nbytes, revisit, refers in zip(*(b.column(c).to_pylist() for c in (
                    "page_id", "url", "payload", "payload_bytes", "revisit", "refers_to"))):
                if out is None:
                    path = f"{root}/{uuid.uuid4().hex}.warc.gz"
                    out, size, n = fs.open_output_stream(path, compression=None), 0, 0
                url = url.replace("\r", "%0D").replace("\n", "%0A")
                raw = record("revisit" if revisit else "response", str(pid), url, digest(payload), nbytes,
                             b"" if revisit else payload, str(refers))
                z = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = z.compress(raw) + z.flush()
                out.write(data)
                size += len(data)
                n += 1
                if size >= archive_bytes:
                    out.close()
                    done.append((path, n))
                    out = None
        if out is not None:
            out.close()
            done.append((path, n))
        yield {"path": [d[0] for d in done], "records": [d[1] for d in done]}

    return stored(map_arrow(records, run, "path string, records long"), "warc-list")


RECORDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def read_archives(listing: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of the listed archives, in each archive's order."""

    def run(it):
        fs, _ = file_system(folder)
        names = [f.split()[0] for f in RECORDS.split(", ")]
        for b in it:
            for path, n in zip(b.column("path").to_pylist(), b.column("records").to_pylist()):
                seen, out, held = 0, {c: [] for c in names}, 0
                with fs.open_input_stream(path, compression=None) as f:
                    for raw in members(f.read):
                        h, block = parse(raw)
                        ident = lambda x: None if h[x][10:-1] == "None" else int(h[x][10:-1])
                        kind = h["warc-type"]
                        row = (ident("warc-record-id"), h["warc-target-uri"], kind, int(h["x-payload-length"]),
                               h["warc-payload-digest"].removeprefix("sha1:"),
                               ident("warc-refers-to") if kind == "revisit" else None, block if with_payload else None)
                        for c, v in zip(names, row):
                            out[c].append(v)
                        seen, held = seen + 1, held + len(block)
                        if held > (4 << 20):
                            yield out
                            out, held = {c: [] for c in names}, 0
                if seen != n:
                    raise ValueError(f"{path}: {seen} records instead of {n}")
                yield out

    # A stated number of parts: a list of a few kilobytes would otherwise be merged into one task.
    return map_arrow(listing.repartition(max(1, listing.count()), "path"), run, RECORDS)


def op7_query(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    folder = work_dir(pages.sparkSession, "warc")
    listing = write_archives(plan_records(pages, min_bytes), folder)
    return read_archives(listing, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
