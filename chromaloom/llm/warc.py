"""Web archives inside ZIP packages: writer, and reader by ranges (operator 6).

A package is a ZIP file whose members are all *stored*: ``archive/data.warc.gz``, one gzip
member per WARC record, and ``indexes/index.cdxj``, one line per record with its offset and
length.  The reader parses the end-of-central-directory record, its ZIP64 form and locator, the
central directory with ZIP64 extra fields and the local headers, and then reads records by byte
ranges: neighbouring records are fetched together, up to ``RANGE`` bytes, and nothing is extracted.

Packages lie in the shared folder and are written and read through ``pyarrow.fs``: on paths and
schemes that it knows (file, hdfs with libhdfs on the workers, s3 and s3a, gs, abfss); the driver checks the
folder first, and an unknown scheme raises an error.  A task names
its file uniquely and tells of it only when it is whole, so a repeated task leaves no trace in the
result.

Records with equal payloads of at least ``LEAST`` bytes are written once: that of the largest
page_id is the response, all others are revisit records that refer to it.

Defined results: a null html is an empty payload; a null url is written as ``urn:none``; a null
page_id counts as smaller than any other and stays null; rows that repeat the response's page_id
and payload are responses, too.  An empty table gives no package.  Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import urllib.parse
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import BROADCAST_ROWS, Workspace

LEAST = 1000
ROLL, RANGE = 64 << 20, 8 << 20
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


class StoredZip:
    """Writes stored members to a stream; with zip64, in the ZIP64 form whatever their size."""

    def __init__(self, out, zip64: bool = False):
        self.out, self.zip64, self.at, self.entries = out, zip64, 0, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, name: str, chunks: list[bytes]) -> None:
        size, crc = sum(map(len, chunks)), 0
        for x in chunks:
            crc = zlib.crc32(x, crc)
        wide = self.zip64 or size >= FULL32
        extra = struct.pack("<HHQQ", 1, 16, size, size) if wide else b""
        small = FULL32 if wide else size
        self.entries.append((name.encode(), crc, size, self.at))
        self._put(struct.pack("<IHHHHHIIIHH", 0x04034B50, 45 if wide else 20, 0x800, 0, 0, 0x21, crc, small, small, len(name.encode()), len(extra)) + name.encode() + extra)
        for x in chunks:
            self._put(x)

    def close(self) -> None:
        begin = self.at
        for name, crc, size, at in self.entries:
            wide = self.zip64 or size >= FULL32 or at >= FULL32
            extra = struct.pack("<HHQQQ", 1, 24, size, size, at) if wide else b""
            small, where = (FULL32, FULL32) if wide else (size, at)
            self._put(struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45 if wide else 20, 0x800, 0, 0, 0x21, crc, small, small, len(name), len(extra), 0, 0, 0, 0, where) + name + extra)
        length, end = self.at - begin, self.at
        count = len(self.entries)
        if wide := self.zip64 or begin >= FULL32 or count >= FULL16:
            self._put(struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, count, count, length, begin))
            self._put(struct.pack("<IIQI", 0x07064B50, 0, end, 1))
        self._put(struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, FULL16 if wide else count, FULL16 if wide else count, FULL32 if wide else length, FULL32 if wide else begin, 0))


def directory(read, size: int) -> dict[str, tuple[int, int]]:
    """Offset and length of the data of every stored member; read(at, n) gives bytes of the file."""
    reach = min(size, 22 + FULL16)
    tail = read(size - reach, reach)
    end = tail.rfind(b"PK\x05\x06")
    while end >= 0 and (len(tail) - end < 22 or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(b"PK\x05\x06", 0, end)
    if end < 0:
        raise ValueError("no end of a central directory")
    _, _, _, _, count, length, begin, _ = struct.unpack_from("<IHHHHIIH", tail, end)
    place = size - reach + end
    if FULL16 == count or FULL32 in (length, begin):
        mark, _, where, _ = struct.unpack("<IIQI", read(place - 20, 20)) if place >= 20 else (0, 0, 0, 0)
        if mark == 0x07064B50:
            mark, _, _, _, _, _, _, count, length, begin = struct.unpack("<IQHHIIQQQQ", read(where, 56))
            if mark != 0x06064B50:
                raise ValueError("no ZIP64 end of a central directory where its locator points")
    table, at, found = read(begin, length), 0, {}
    for _ in range(count):
        mark, _, _, flags, method, _, _, _, packed, plain, names, extras, notes, _, _, _, where = struct.unpack_from("<IHHHHHHIIIHHHHHII", table, at)
        if mark != 0x02014B50:
            raise ValueError("a central directory entry is damaged")
        name = table[at + 46 : at + 46 + names].decode()
        extra = table[at + 46 + names : at + 46 + names + extras]
        while len(extra) >= 4:
            kind, n = struct.unpack_from("<HH", extra)
            if kind == 1:  # the ZIP64 field holds, in this order, those values that are full
                wide = iter(struct.unpack(f"<{n // 8}Q", extra[4 : 4 + n // 8 * 8]))
                plain = next(wide) if plain == FULL32 else plain
                packed = next(wide) if packed == FULL32 else packed
                where = next(wide) if where == FULL32 else where
            extra = extra[4 + n :]
        at += 46 + names + extras + notes
        if method or flags & 1:
            raise ValueError(f"{name} is not stored plainly")
        mark, a, b = struct.unpack("<I22xHH", read(where, 30))
        if mark != 0x04034B50:
            raise ValueError(f"no local header of {name}")
        found[name] = (where + 30 + a + b, packed)
    return found


def _open(path: str):
    """The file system of a path, and the path in it."""
    from pyarrow import fs

    scheme, mark, rest = path.partition("://")
    return fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + mark + rest)


def record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    """A WARC record; revisits hold the HTTP head alone, which tells the payload's length."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {urllib.parse.quote(url, safe='%/:=&?~#+!$,;@()*[]') if url else 'urn:none'}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        *([f"X-Page-ID: {page_id}"] if page_id is not None else []),
        *(["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"] if revisit else []),
        *([f"X-Refers-To-Page-ID: {refers_to}"] if revisit and refers_to is not None else []),
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The fields of a record, and its payload (None for a revisit)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(":")[1]) for x in http.decode().split("\r\n") if x.lower().startswith("content-length:"))
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    if fields["warc-type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("a payload differs from its digest")
    number = lambda k: int(fields[k]) if k in fields else None
    return {
        "page_id": number("x-page-id"), "url": fields["warc-target-uri"], "payload_bytes": size, "payload_digest": digest,
        "record_type": fields["warc-type"], "refers_to": number("x-refers-to-page-id"), "payload": payload if fields["warc-type"] == "response" else None,
    }


def _writer(folder: str, zip64: bool):
    def finish(chunks, index):
        system, at = _open(folder)
        system.create_dir(at, recursive=True)
        name = f"pages-{uuid.uuid4().hex}.wacz"
        with system.open_output_stream(f"{at}/{name}") as out:
            package = StoredZip(out, zip64)
            package.add(DATA, chunks)
            package.add(INDEX, ["".join(index).encode()])
            package.close()
        return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": pa.array([len(index)], pa.int64())})

    def write(batches):
        chunks, index, size = [], [], 0
        for batch in batches:
            columns = [batch.column(x) for x in ("page_id", "url", "html", "digest", "keeper", "revisit")]
            for a in range(0, batch.num_rows, 256):
                for page_id, url, html, digest, keeper, revisit in zip(*[c.slice(a, 256).to_pylist() for c in columns]):
                    press = zlib.compressobj(1, wbits=31)
                    raw = record(page_id, url, html or b"", digest, keeper, revisit)
                    raw = press.compress(raw) + press.flush()
                    about = {"offset": size, "length": len(raw), "digest": digest, "filename": DATA}
                    index.append(f"{urllib.parse.quote(url or 'urn:none')} 19700101000000 {json.dumps(about)}\n")
                    chunks.append(raw)
                    size += len(raw)
                    if size >= ROLL:
                        yield finish(chunks, index)
                        chunks, index, size = [], [], 0
        if index:
            yield finish(chunks, index)

    return write


def write_packages(pages: DataFrame, folder: str, least: int = LEAST, zip64: bool = False, space: Workspace | None = None) -> DataFrame:
    """Write the pages as packages into a shared folder; a written table (path, records)."""
    space = space or Workspace(pages.sparkSession, "warc")
    _open(folder)  # an unknown scheme fails here, not in the tasks
    html = F.coalesce("html", F.lit("")).cast("binary")
    named = pages.select("page_id", "url", html.alias("html"), F.sha1(html).alias("digest"))
    same = named.filter(F.octet_length("html") >= least).groupBy("digest").agg(F.count("*").alias("n"), F.max("page_id").alias("keeper"))
    same = space.table(same.filter("n > 1").withColumn("known", F.lit(True)).drop("n"), "same")
    out = named.join(F.broadcast(same) if same.count() <= BROADCAST_ROWS else same, "digest", "left")
    revisit = F.coalesce("known", F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    out = out.select("page_id", "url", "html", "digest", "keeper", revisit.alias("revisit"))
    return space.table(out.mapInArrow(_writer(folder, zip64), "path string, records long"), "packages")


def _ranges(batches):
    """Of every package, the byte ranges of its data that hold neighbouring records."""
    for batch in batches:
        for path in batch.column("path").to_pylist():
            system, at = _open(path)
            with system.open_input_file(at) as file:
                members = directory(lambda a, n, f=file: f.read_at(n, a), file.size())
                begin, size = members[INDEX]
                lines = file.read_at(size, begin).decode().splitlines()
            base = members[DATA][0]
            found = [(x["offset"], x["length"]) for x in (json.loads(line.split(" ", 2)[2]) for line in lines)]
            found.sort()
            groups = [[]]
            for x in found:
                if groups[-1] and x[0] + x[1] - groups[-1][0][0] > RANGE:
                    groups.append([])
                groups[-1].append(x)
            groups = [g for g in groups if g]
            yield pa.RecordBatch.from_pydict({
                "path": pa.array([path] * len(groups), pa.string()),
                "begin": pa.array([base + g[0][0] for g in groups], pa.int64()),
                "lengths": pa.array([[n for _, n in g] for g in groups], pa.list_(pa.int64())),
                "offsets": pa.array([[a - g[0][0] for a, _ in g] for g in groups], pa.list_(pa.int64())),
            })


_SCHEMA = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload": pa.binary()}


def _reader(names: list[str]):
    def read(batches):
        for batch in batches:
            for path, begin, offsets, lengths in zip(*[batch.column(x).to_pylist() for x in ("path", "begin", "offsets", "lengths")]):
                system, at = _open(path)
                with system.open_input_file(at) as file:
                    data = memoryview(file.read_at(offsets[-1] + lengths[-1], begin))
                for a in range(0, len(offsets), 200):
                    rows = [parse(zlib.decompress(data[o : o + n], wbits=31)) for o, n in zip(offsets[a : a + 200], lengths[a : a + 200])]
                    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], _SCHEMA[k]) for k in names], names=names)

    return read


def read_packages(spark: SparkSession, packages: DataFrame, payload: bool = True) -> DataFrame:
    """Every record of the packages of a table (path, ...), read by ranges."""
    names = [k for k in _SCHEMA if payload or k != "payload"]
    kinds = {"int64": "long", "string": "string", "binary": "binary"}
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = packages.select("path").repartition(slots, "path").mapInArrow(_ranges, "path string, begin long, lengths array<long>, offsets array<long>")
    return ranges.repartition(slots, "path", "begin").mapInArrow(_reader(names), ", ".join(f"{k} {kinds[str(_SCHEMA[k])]}" for k in names))


def op6_warc_packages(spark, sf_dir: str) -> DataFrame:
    space = Workspace(spark, "warc")
    packages = write_packages(spark.read.parquet(f"{sf_dir}/pages.parquet"), f"{space.path}/files", space=space)
    return read_packages(spark, packages, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = r"""
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, octet_length(encode(html))::bigint as payload_bytes, sha1(html) as payload_digest from p),
k as (select payload_digest, max(page_id) as keeper from d where payload_bytes >= 1000 group by payload_digest having count(*) > 1)
select d.page_id, payload_bytes, d.payload_digest,
       case when k.payload_digest is not null and d.page_id is distinct from keeper then 'revisit' else 'response' end as record_type,
       case when k.payload_digest is not null and d.page_id is distinct from keeper then keeper end as refers_to
from d left join k on d.payload_digest = k.payload_digest
"""
