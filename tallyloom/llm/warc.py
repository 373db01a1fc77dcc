"""WARC archives: writing pages as records, and reading archives block by block.

Files are read in blocks, without an index. A task reports for every place in its
block that looks like a record where the next record would begin, and where the chain
of records that starts there leaves the block. Only the start of a file is known to be
a record; pointer jumping from there over the blocks' exits finds the true entry of
each block. What looks like a record inside a payload is on no chain from the start.
Blocks are then read from their entries on.

Both plain files and files of one gzip member per record are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import batch, bounded_batches, byte_list, id_back, id_of, text_of
from tallyloom.llm.files import create, new_name, open_at, qualified
from tallyloom.sources.tables import stage, staging_path

BLOCK_BYTES = 8 << 20
CHUNK_BYTES = 64 << 10
HEAD_BYTES = 1 << 20
LEAST = 1000
DATE = "1970-01-01T00:00:00Z"
LEVEL = 3

# Fixed values of the format.
VERSION = b"WARC/1."
GZIP = b"\x1f\x8b\x08"
SAME_DIGEST = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAME = "urn:page:"


def record(page_id: int, url: str | None, payload: bytes, sha1: str, refers_to: int | None, date: str) -> bytes:
    """A response with its payload, or a revisit with the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    head = [
        "WARC/1.1",
        "WARC-Type: " + ("response" if refers_to is None else "revisit"),
        f"WARC-Record-ID: <{NAME}{page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    if refers_to is not None:
        head += [f"WARC-Profile: {SAME_DIGEST}", f"WARC-Refers-To: <{NAME}{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_pages(pages: DataFrame, folder: str | None = None, least: int = LEAST, packed: bool = True, date: str = DATE) -> DataFrame:
    """Write a record for every page (page_id, url, html), and return the files: file,
    size, records.

    Of pages with equal payloads of at least ``least`` bytes the one with the largest
    page_id keeps its payload, the others refer to it; rows that share this id keep it,
    too. Null html is an empty payload, a null url leaves its header out.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    place = qualified(spark, folder or staging_path(spark, "warc"))
    read = pages.select(id_of("page_id").alias("page_id"), F.col("url").cast("string").alias("url"), text_of("html").alias("html"))
    read = read.select("page_id", "url", "html", F.sha1("html").alias("sha1"), F.xxhash64("html").alias("text_key"))
    marks = stage(
        read.filter(F.octet_length("html") >= least).select("page_id", "sha1", "text_key"), "digests"
    )
    latest = marks.groupBy("sha1", "text_key").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("other")).filter("other < refers_to").drop("other")
    revisits = (
        marks.join(stage(latest, "latest"), ["sha1", "text_key"])
        .filter("page_id < refers_to")
        .select("page_id", "text_key", "refers_to")
        .distinct()
    )
    schema = pa.schema([("file", pa.string()), ("size", pa.int64()), ("records", pa.int64())])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, out, size, n = "", None, 0, 0
        for r in rows:
            urls, digests, refers = (r.column(i).to_pylist() for i in (1, 3, 4))
            for page_id, url, payload, sha1, to in zip(r.column(0).to_pylist(), urls, byte_list(r.column(2)), digests, refers):
                data = record(page_id, url, payload, sha1, to, date)
                if packed:
                    pack = zlib.compressobj(LEVEL, wbits=31)
                    data = pack.compress(data) + pack.flush()
                if out is None:
                    name = new_name(place, "pages", ".warc.gz" if packed else ".warc")
                    out = create(name)
                out.write(data)
                size, n = size + len(data), n + 1
        if out is not None:
            out.close()
            yield batch(schema, file=[name], size=[size], records=[n])

    joined = read.join(revisits, ["page_id", "text_key"], "left").select("page_id", "url", "html", "sha1", "refers_to")
    return stage(joined.mapInArrow(run, "file string, size long, records long"), "warc_files")


class Blocks:
    """Reads records and what looks like them from a file."""

    def __init__(self, path: str) -> None:
        self.path, self.file = path, open_at(path)
        self.size = self.file.size()
        self.packed = self.read(0, 3) == GZIP

    def read(self, at: int, size: int) -> bytes:
        return self.file.read_at(min(size, self.size - at), at) if at < self.size else b""

    def looks(self, begin: int, end: int) -> Iterator[tuple[int, int]]:
        """Places in [begin, end) that look like records, and the place after each."""
        magic = GZIP if self.packed else VERSION
        data = self.read(begin, end - begin + len(magic) - 1)
        for m in re.finditer(re.escape(magic), data):
            at = begin + m.start()
            after = self._member(at)[0] if self.packed else self._plain(at)[0]
            if after:
                yield at, after

    def record(self, at: int) -> tuple[int, bytes, bytes]:
        """The place after the record, its header and its block."""
        if self.packed:
            after, data = self._member(at, whole=True)
            head, split, rest = data.partition(b"\r\n\r\n")
            size = length_of(head)
            if after and split and size is not None and len(rest) == size + 4:
                return after, head, rest[:size]
        else:
            after, begin, head = self._plain(at)
            if after:
                return after, head, self.read(begin, after - 4 - begin)
        raise ValueError(f"no record at {at} of {self.path}")

    def _plain(self, at: int) -> tuple[int, int, bytes]:
        head, size = b"", CHUNK_BYTES
        while True:
            data = self.read(at, size)
            head, split, _ = data.partition(b"\r\n\r\n")
            if split or len(data) < size or size >= HEAD_BYTES:
                break
            size *= 4
        length = length_of(head) if split else None
        if length is None:
            return 0, 0, b""
        begin = at + len(head) + 4
        after = begin + length + 4
        return (after, begin, head) if after <= self.size else (0, 0, b"")

    def _member(self, at: int, whole: bool = False) -> tuple[int, bytes]:
        """The place after the gzip member at this place, 0 if it holds no record."""
        unpack = zlib.decompressobj(wbits=31)
        place, held, seen = at, [], b""
        try:
            while not unpack.eof:
                data = self.read(place, CHUNK_BYTES)
                if not data:
                    return 0, b""
                place += len(data)
                while data and not unpack.eof:
                    out = unpack.decompress(data, CHUNK_BYTES * 4)
                    data = unpack.unconsumed_tail
                    if whole:
                        held.append(out)
                    if len(seen) < len(VERSION):
                        seen += out[: len(VERSION)]
                        if not VERSION.startswith(seen[: len(VERSION)]):
                            return 0, b""
        except zlib.error:
            return 0, b""
        return place - len(unpack.unused_data), b"".join(held)


def length_of(head: bytes) -> int | None:
    if not head.startswith(VERSION):
        return None
    m = re.search(rb"\r\ncontent-length:[ \t]*(\d{1,18})[ \t]*(?:\r\n|$)", head, re.IGNORECASE)
    return int(m[1]) if m else None


def fields_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def candidates(files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """file, block, place, after, leaves of everything that looks like a record.

    ``leaves`` is where the chain that begins there first leaves the block, -1 if it
    breaks inside.
    """
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("place", pa.int64()), ("after", pa.int64()), ("leaves", pa.int64())])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in rows:
            for path, block in zip(r.column(0).to_pylist(), r.column(1).to_pylist()):
                end = (block + 1) * block_bytes
                found = list(Blocks(path).looks(block * block_bytes, end))
                leaves: dict[int, int] = {}
                for at, after in reversed(found):
                    leaves[at] = after if after >= end else leaves.get(after, -1)
                n = len(found)
                yield batch(
                    schema, file=[path] * n, block=[block] * n, place=[x[0] for x in found],
                    after=[x[1] for x in found], leaves=[leaves[x[0]] for x in found],
                )

    last = F.floor((F.col("size") - 1) / block_bytes)
    blocks = files.filter("size > 0").select("file", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
    number = files.agg(F.sum(last + 1)).first()[0] or 1
    return blocks.repartition(int(number), "file", "block").mapInArrow(run, "file string, block long, place long, after long, leaves long")


def entries(found: DataFrame, files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """file and place of the first true record of each block that has one."""
    starts = files.filter("size > 0").select("file", F.lit(0).cast("long").alias("place"))
    targets = found.filter("leaves >= 0").select("file", F.col("leaves").alias("place")).unionByName(starts).distinct()
    jump = stage(found.join(targets, ["file", "place"]).select("file", "place", "leaves"), "jumps")
    reached = stage(starts, "reached")
    largest = files.agg(F.max("size")).first()[0] or 0
    for _ in range((largest // block_bytes).bit_length() + 1):
        further = reached.join(jump, ["file", "place"]).filter("leaves >= 0").select("file", F.col("leaves").alias("place"))
        reached = stage(reached.unionByName(further).distinct(), "reached")
        second = jump.select("file", F.col("place").alias("leaves"), F.col("leaves").alias("beyond"))
        jump = stage(
            jump.join(second, ["file", "leaves"]).select("file", "place", F.col("beyond").alias("leaves")), "jumps"
        )
    return reached.join(files.select("file", "size"), "file").filter("place < size").select("file", "place")


def read_records(files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every record of the archives (file, size): file, place, head, block (binary).

    A file whose chain of records breaks off is an error.
    """
    schema = pa.schema([("file", pa.string()), ("place", pa.int64()), ("head", pa.binary()), ("block", pa.binary())])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in rows:
            for path, at in zip(r.column(0).to_pylist(), r.column(1).to_pylist()):
                blocks = Blocks(path)
                end = min((at // block_bytes + 1) * block_bytes, blocks.size)
                held, size = [], 0
                while at < end:
                    after, head, body = blocks.record(at)
                    held.append((path, at, head, body))
                    size += len(body)
                    at = after
                    if size >= 1 << 20:
                        yield batch(schema, **dict(zip(schema.names, zip(*held))))
                        held, size = [], 0
                if held:
                    yield batch(schema, **dict(zip(schema.names, zip(*held))))

    found = stage(candidates(files, block_bytes), "candidates")
    true = stage(entries(found, files, block_bytes), "entries")
    return true.repartition(max(1, true.count()), "file", "place").mapInArrow(run, "file string, place long, head binary, block binary")


def read_pages(files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The pages of archives that ``write_pages`` wrote: page_id, url (white space and
    characters outside ASCII escaped), payload_bytes, payload_digest, record_type, refers_to, html (null for revisits).

    The payload of a response must have the digest its header names.
    """
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("html", pa.string())]
    )

    def page(name: str | None) -> int | None:
        return int(name.strip("<>")[len(NAME) :]) if name else None

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in rows:
            out = []
            for head, block in zip(r.column(0).to_pylist(), r.column(1).to_pylist()):
                f = fields_of(head)
                http, _, payload = block.partition(b"\r\n\r\n")
                size = int(fields_of(http)["content-length"])
                sha1 = base64.b32decode(f["warc-payload-digest"].removeprefix("sha1:")).hex()
                kind, html = f["warc-type"], None
                if kind == "response":
                    if len(payload) != size or hashlib.sha1(payload).hexdigest() != sha1:
                        raise ValueError(f"the payload of {f['warc-record-id']} is damaged")
                    html = payload.decode()
                out.append((page(f["warc-record-id"]), f.get("warc-target-uri"), size, sha1, kind, page(f.get("warc-refers-to")), html))
            yield batch(schema, **dict(zip(schema.names, zip(*out) if out else [[]] * len(schema))))

    return (
        read_records(files, block_bytes)
        .select("head", "block")
        .mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, html string")
        .withColumn("page_id", id_back("page_id"))
    )
