"""WARC archives with a two-level capture index.

``write`` turns pages into WARC/1.1 records, one gzip member each, in one
archive file per task.  Of equal payloads of at least ``REVISIT_MIN``
bytes, the one with the smallest page_id is a response and the others are
revisits that name it; the decision is a join on the payload's digest.

The index holds one line per capture: the reversed-host URL key, the
page_id and the place of the record.  Lines are range-partitioned and
sorted by key and page_id; each partition is an index file of gzip blocks
of ``BLOCK_LINES`` lines with a sparse directory (first key and byte range
of each block) beside it.  The second level is the first key of each index
file, one row per file, known to the driver.

``Archive.lookup`` finds the file of each wanted key by binary search over
those first keys, the block by binary search over the file's directory,
and reads only that byte range.  ``read`` fetches records by byte range in
the order of the archive files, checks each payload against its digest,
and takes type and reference from the record's headers.

File names are unique per task attempt; only files listed by finished
tasks are read.

Edge cases: null html is an empty payload, null url an empty key; empty
and short payloads are responses; rows that repeat a page_id with the same
payload are all responses of it; a null page_id is kept and never referred
to while another page has that payload; an empty table gives no archive
and no row.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import bounded, new_file, open_fs, pylist, settle, shared_folder
from .urlfilter import host_of

REVISIT_MIN = 100
BLOCK_LINES = 1000
LEVEL = 3
DATE = "2000-01-01T00:00:00Z"

_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def capture_key(url: Column) -> Column:
    """``com,example,www)/path?query`` of a url; empty if it is null."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(.*)$", 1), F.lit(""))
    key = F.concat(F.array_join(F.reverse(F.split(host_of(url), r"\.")), ","), F.lit(")"), rest)
    return F.when(url.isNull(), F.lit("")).otherwise(key)


def _record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    target = _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url or "")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page_id}>",
            f"WARC-Target-URI: {target}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if refers_to is None:
        body = http + payload
        head.append("Content-Type: application/http;msgtype=response")
    else:
        body = http
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Truncated: length",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 "Content-Type: application/http;msgtype=response"]
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _gunzip(data: bytes) -> bytes:
    return zlib.decompress(data, 31)


def _order(key: str, page_id: int | None) -> tuple[str, bool, int]:
    return key, page_id is not None, page_id or 0


@dataclass
class Archive:
    """A written archive: its captures, and its index files (first_key, first_id, path, directory), one row per file."""

    captures: DataFrame
    files: DataFrame

    def lookup(self, wanted: DataFrame) -> DataFrame:
        """(page_id, file, offset, length) of every capture of the ``wanted`` (key, page_id), found through the index."""
        spark = wanted.sparkSession
        files = sorted(self.files.collect(), key=lambda r: _order(r["first_key"], r["first_id"]))  # one row per index file
        top = spark.sparkContext.broadcast(([_order(r["first_key"], r["first_id"]) for r in files],
                                            [(r["path"], r["directory"]) for r in files]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            firsts, paths = top.value
            part, starts, blocks, handle, at, lines = -1, [], [], None, -1, []
            for b in batches:
                out: list[tuple] = []
                for key, page_id in zip(pylist(b, "key"), pylist(b, "page_id")):
                    want = _order(key, page_id)
                    file = bisect_right(firsts, want) - 1
                    if file < 0:
                        continue
                    if file != part:
                        system, where = open_fs(paths[file][1])
                        with system.open_input_stream(where) as f:
                            directory = [json.loads(x) for x in f.read().splitlines()]
                        starts, blocks = [_order(d[0], d[1]) for d in directory], [(d[2], d[3]) for d in directory]
                        system, where = open_fs(paths[file][0])
                        part, handle, at = file, system.open_input_file(where), -1
                    # the first block that can hold the key: the one before the first start that is not smaller
                    k = max(0, _bisect_left(starts, want) - 1)
                    while k < len(blocks) and (starts[k] <= want):
                        if k != at:
                            offset, length = blocks[k]
                            lines = [json.loads(x) for x in _gunzip(handle.read_at(length, offset)).splitlines()]
                            lines = [(_order(x[0], x[1]), x) for x in lines]
                            at = k
                        i = _bisect_left(lines, (want,))
                        while i < len(lines) and lines[i][0] == want:
                            out.append(tuple(lines[i][1][1:]))
                            i += 1
                        if i < len(lines):
                            break
                        k += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[c] for o in out], t) for c, t in enumerate((pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                    names=["page_id", "file", "offset", "length"])
        sorted_keys = wanted.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")
        return bounded(sorted_keys).mapInArrow(run, "page_id long, file string, offset long, length long")


def _bisect_left(rows: list, want) -> int:
    lo, hi = 0, len(rows)
    while lo < hi:
        mid = (lo + hi) // 2
        if rows[mid] < want:
            lo = mid + 1
        else:
            hi = mid
    return lo


def write(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> Archive:
    """Write the archive and its index."""
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256)).withColumn("key", capture_key(F.col("url")))
    firsts = (rows.where(F.octet_length("html") >= REVISIT_MIN).groupBy("digest")
              .agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies")).where("copies > 1").drop("copies"))
    firsts = settle(firsts, "warc-firsts")  # its size is then known to Spark, which broadcasts it only if small
    decided = rows.join(firsts, "digest", "left").withColumn(
        "refers_to", F.expr("CASE WHEN first_id IS NOT NULL AND NOT (page_id <=> first_id) THEN first_id END"))
    folder = shared_folder(spark, "warc")

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, at = None, None, 0
        for b in batches:
            places = []
            for page_id, url, html, digest, refers in zip(*(pylist(b, c) for c in ("page_id", "url", "html", "digest", "refers_to"))):
                if out is None:
                    name = new_file(folder, f"part-{TaskContext.get().partitionId():06d}", ".warc.gz")
                    system, where = open_fs(name)
                    out = system.open_output_stream(where, compression=None)
                member = _gzip(_record(page_id, url, html.encode("utf-8", "surrogatepass"), digest, refers))
                out.write(member)
                places.append((at, len(member)))
                at += len(member)
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index("key")), b.column(b.schema.get_field_index("page_id")),
                 pa.array([name] * len(places), pa.string()), *(pa.array([p[k] for p in places], pa.int64()) for k in (0, 1))],
                names=["key", "page_id", "file", "offset", "length"])
        if out is not None:
            out.close()

    captures = settle(bounded(decided).select("page_id", "url", "html", "digest", "refers_to", "key").mapInArrow(
        archive, "key string, page_id long, file string, offset long, length long"), "warc-captures")

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: list[list] = []
        directory: list[list] = []
        out, path, at = None, None, 0

        def flush() -> None:
            nonlocal at
            block = _gzip(b"".join(json.dumps(x).encode() + b"\n" for x in lines))
            out.write(block)
            directory.append([lines[0][0], lines[0][1], at, len(block)])
            at += len(block)
            lines.clear()

        for b in batches:
            for row in zip(*(pylist(b, c) for c in ("key", "page_id", "file", "offset", "length"))):
                if out is None:
                    path = new_file(folder, f"index-{TaskContext.get().partitionId():06d}", ".cdx.gz")
                    system, where = open_fs(path)
                    out = system.open_output_stream(where, compression=None)
                lines.append(list(row))
                if len(lines) >= BLOCK_LINES:
                    flush()
        if out is not None:
            if lines:
                flush()
            out.close()
            system, where = open_fs(path + ".dir")
            with system.open_output_stream(where) as f:
                f.write(b"".join(json.dumps(d).encode() + b"\n" for d in directory))
            yield pa.RecordBatch.from_arrays([pa.array([directory[0][0]]), pa.array([directory[0][1]], pa.int64()), pa.array([path]),
                                              pa.array([path + ".dir"])], names=["first_key", "first_id", "path", "directory"])

    files = settle(bounded(captures).repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id", "file", "offset").mapInArrow(
        index, "first_key string, first_id long, path string, directory string"), "warc-index")
    return Archive(captures, files)


_ID = re.compile(r"<urn:page:(-?\d+)>")


def _parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, HTTP body) of a record."""
    head, _, body = record.partition(b"\r\n\r\n")
    headers = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = body[:int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")


def read(places: DataFrame) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, html) of records by file, offset and length.

    ``html`` is null for a revisit; its payload is that of the record it refers to.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, handle = None, None
        for b in batches:
            out = []
            for page_id, file, offset, length in zip(*(pylist(b, c) for c in ("page_id", "file", "offset", "length"))):
                if file != name:
                    system, where = open_fs(file)
                    name, handle = file, system.open_input_file(where)
                headers, (http, _, payload) = _parse(_gunzip(handle.read_at(length, offset)))
                digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                kind = headers["WARC-Type"]
                size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
                    raise ValueError(f"damaged record in {file} at {offset}")
                refers = _ID.search(headers.get("WARC-Refers-To", ""))
                out.append((page_id, headers["WARC-Target-URI"], size, digest, kind, int(refers[1]) if refers else None,
                            payload.decode("utf-8", "surrogatepass") if kind == "response" else None))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)],
                                             names=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "html"])
    in_order = places.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
    return bounded(in_order).mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
                                    "refers_to long, html string")
