"""BAM as a Spark data source: indexed parts, written in two phases and read back through their index.

``df.write.format("bam")`` makes a folder of BAM files, one per partition, each whole by itself
(header, records, end mark).  Records in coordinate order get an index beside their part: bins with chunks
of virtual offsets, and a linear index of 16 kb windows, as the SAM specification defines them.  Parts are written under a
temporary folder, which readers pass over, and renamed when all tasks have ended.

``spark.read.format("bam")`` reads such folders with one task per part; ``region`` reads what the index tells to hold
some sequences and positions.  With the option ``pushdown`` the filters on rname and pos that Spark pushes
down (``spark.sql.python.filterPushdown.enabled``) choose the chunks that a task unpacks.  Rows are tested again either way, so the index
cannot change a result.  Paths are local or of a scheme that pyarrow knows.
"""

from __future__ import annotations

import functools
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pfs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

# Fixed values of the SAM specification: operations, bases by their codes, kinds of optional fields.
OPERATIONS, BASES = "MIDNSHP=X", "=ACMGRSVTWYHKDBN"
NUMBERS = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}
#: The end mark of a BGZF file: an empty block.
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
BLOCK = 0xFF00  # bytes packed into a block
#: Bins of 512 Mb, 64 Mb, ... 16 kb: shift and number of the first bin of each level.
LEVELS = [(29, 0), (26, 1), (23, 9), (20, 73), (17, 585), (14, 4681)]
WINDOW = 14
FAR = 1 << 29

COLUMNS = "qname string, flag int, rname string, pos long, mapq int, cigar string, rest string"
FIELDS = [("qname", pa.string()), ("flag", pa.int32()), ("rname", pa.string()), ("pos", pa.int64()), ("mapq", pa.int32()), ("cigar", pa.string()), ("rest", pa.string())]

_HEX = b"0123456789abcdef"
_TO_BASES = bytes.maketrans(_HEX, BASES.encode())
_TO_HEX = bytes.maketrans(bytes(range(256)), bytes(_HEX[BASES.find(chr(b).upper())] if b < 128 and chr(b).upper() in BASES else _HEX[15] for b in range(256)))
_SHOWN = bytes(min(q + 33, 126) for q in range(256))
_QUALITY = bytes(max(c - 33, 0) for c in range(256))


# ---------------------------------------------------------------- records


def bases_of(data, begin: int, count: int) -> str:
    """Letters of packed bases, by a table and without a step per base."""
    return bytes(data[begin : begin + (count + 1) // 2]).hex().encode().translate(_TO_BASES)[:count].decode() or "*"


def qualities_of(data, begin: int, count: int) -> str:
    raw = bytes(data[begin : begin + count])
    return "*" if not raw or raw[0] == 255 else raw.translate(_SHOWN).decode()


def bin_of(begin: int, end: int) -> int:
    """The smallest bin that holds [begin, end)."""
    last = max(end, begin + 1) - 1
    return next((first + (begin >> shift) for shift, first in reversed(LEVELS) if begin >> shift == last >> shift), 0)


def bins_over(begin: int, end: int) -> set[int]:
    """All bins that may hold records that overlap [begin, end)."""
    return {b for shift, first in LEVELS for b in range(first + (begin >> shift), first + ((min(end, FAR) - 1) >> shift) + 1)}


@functools.lru_cache(maxsize=65536)
def packed_cigar(cigar: str) -> tuple[bytes, int, int]:
    """(packed operations, their number, bases of the reference they cover)."""
    if cigar == "*":
        return b"", 0, 0
    out, covered, n = [], 0, ""
    for c in cigar:
        if c.isdigit():
            n += c
        else:
            k = int(n or 1)
            out.append(k << 4 | OPERATIONS.index(c))
            covered += k if c in "MDN=X" else 0
            n = ""
    return struct.pack(f"<{len(out)}I", *out), len(out), covered


def packed_tag(tag: str) -> bytes:
    name, kind, value = tag.split(":", 2)
    key = name.encode()
    if kind == "A":
        return key + b"A" + value.encode()
    if kind == "i":
        return key + (b"i" + struct.pack("<i", int(value)) if -(1 << 31) <= int(value) < 1 << 31 else b"I" + struct.pack("<I", int(value)))
    if kind == "f":
        return key + b"f" + struct.pack("<f", float(value))
    if kind == "B":
        of, *values = value.split(",")
        numbers = [float(v) if of == "f" else int(v) for v in values]
        return key + b"B" + of.encode() + struct.pack(f"<i{len(numbers)}{NUMBERS[of]}", len(numbers), *numbers)
    return key + kind.encode() + value.encode() + b"\0"  # Z and H


def packed_record(ids: dict[str, int], qname: str, flag: int, rname: str, pos: int, mapq: int, cigar: str, rest: str | None, tags: str | None) -> tuple[bytes, int, int, int]:
    """(record, number of its sequence, begin, end) from the fields of a SAM line."""
    more = [*(rest.split("\t") if rest else []), *(tags.split("\t") if tags else [])]
    mate, mpos, tlen, seq, qual = [*more[:5], *["*", "0", "0", "*", "*"][len(more[:5]) :]]
    ref = ids[rname] if rname != "*" else -1
    ops, count, covered = packed_cigar(cigar)
    n = 0 if seq == "*" else len(seq)
    raw = bytes.fromhex((seq.encode("latin-1", "replace").translate(_TO_HEX) + b"0" * (n % 2)).decode()) if n else b""
    quality = qual.encode("latin-1", "replace").translate(_QUALITY) if qual != "*" and len(qual) == n else b"\xff" * n
    name = qname.encode() + b"\0"
    other = ref if mate == "=" else ids[mate] if mate != "*" else -1
    end = pos - 1 + max(covered, 1)
    body = struct.pack("<iiBBHHHiiii", ref, pos - 1, len(name), mapq, bin_of(max(pos - 1, 0), max(end, 1)), count, flag, n, other, int(mpos) - 1, int(tlen))
    body += name + ops + raw + quality + b"".join(map(packed_tag, more[5:]))
    return struct.pack("<i", len(body)) + body, ref, pos - 1, end


# ---------------------------------------------------------------- writing


def bgzf_block(data: bytes) -> bytes:
    press = zlib.compressobj(6, wbits=-15)
    body = press.compress(data) + press.flush()
    return struct.pack("<BBBBIBBHBBHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


class PartWriter:
    """A BAM file and, as long as its records come in coordinate order, its index."""

    def __init__(self, out, header: list[str]):
        self.out, self.place, self.buffer = out, 0, bytearray()
        sizes = [dict(f.split(":", 1) for f in x.split("\t")[1:]) for x in header if x.startswith("@SQ\t")]
        self.ids = {s["SN"]: k for k, s in enumerate(sizes)}
        text = "".join(x + "\n" for x in header).encode()
        self._add(b"BAM\x01" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(sizes)))
        for s in sizes:
            name = s["SN"].encode() + b"\0"
            self._add(struct.pack("<i", len(name)) + name + struct.pack("<i", int(s.get("LN", 0))))
        self._flush(len(self.buffer))  # records begin with a block of their own
        self.last, self.ordered, self.loose = (0, -1), True, 0
        self.bins: list[dict[int, list[list[int]]]] = [{} for _ in sizes]
        self.windows: list[dict[int, int]] = [{} for _ in sizes]

    def _flush(self, count: int) -> None:
        while count:
            n = min(count, BLOCK)
            block = bgzf_block(bytes(self.buffer[:n]))
            self.out.write(block)
            self.place += len(block)
            del self.buffer[:n]
            count -= n

    def _add(self, data: bytes) -> None:
        self.buffer += data
        self._flush(len(self.buffer) // BLOCK * BLOCK)

    def add(self, record: bytes, ref: int, begin: int, end: int) -> None:
        start = self.place << 16 | len(self.buffer)
        self._add(record)
        stop = self.place << 16 | len(self.buffer)
        where = (ref if ref >= 0 else 1 << 40, begin)
        self.ordered &= where >= self.last
        self.last = where
        if ref < 0 or begin < 0:
            self.loose += ref < 0
            return
        chunks = self.bins[ref].setdefault(bin_of(begin, end), [])
        if chunks and chunks[-1][1] == start:
            chunks[-1][1] = stop
        else:
            chunks.append([start, stop])
        for w in range(begin >> WINDOW, (end - 1 >> WINDOW) + 1):
            self.windows[ref].setdefault(w, start)

    def close(self) -> bytes | None:
        """Ends the file; the bytes of its index, if the records came in order."""
        self._flush(len(self.buffer))
        self.out.write(END)
        if not self.ordered:
            return None
        out = [b"BAI\x01", struct.pack("<i", len(self.bins))]
        for bins, windows in zip(self.bins, self.windows):
            out.append(struct.pack("<i", len(bins)))
            for number, chunks in sorted(bins.items()):
                out.append(struct.pack("<Ii", number, len(chunks)) + b"".join(struct.pack("<QQ", *c) for c in chunks))
            # windows without a record get the offset of the next that has one
            line, then = [], 0
            for w in range(max(windows, default=-1), -1, -1):
                then = windows.get(w, then)
                line.append(then)
            out.append(struct.pack(f"<i{len(line)}Q", len(line), *line[::-1]))
        return b"".join(out) + struct.pack("<Q", self.loose)


def file_system(path: str) -> tuple[pfs.FileSystem, str]:
    if path.startswith("file:"):
        return pfs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pfs.FileSystem.from_uri(path) if "://" in path else (pfs.LocalFileSystem(), path)


class Written(WriterCommitMessage):
    def __init__(self, files: list[tuple[int, str]]):
        self.files = files


class BamWriter(DataSourceArrowWriter):
    """Rows with the columns of COLUMNS, ``tags``, and ``route``: which of the paths a row goes to."""

    def __init__(self, paths: list[str], headers: list[list[str]], overwrite: bool):
        self.paths, self.headers, self.overwrite = paths, headers, overwrite
        self.job = uuid.uuid4().hex

    def _draft(self, route: int) -> str:
        return f"{self.paths[route].rstrip('/')}/_temporary-{self.job}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}.bam"
        open_parts: dict[int, tuple] = {}
        files = []

        def finish(route: int) -> None:
            fs, at, out, part = open_parts.pop(route)
            index = part.close()
            out.close()
            files.append((route, name))
            if index is not None:
                with fs.open_output_stream(f"{at}.bai") as side:
                    side.write(index)
                files.append((route, f"{name}.bai"))

        names = ["route", "qname", "flag", "rname", "pos", "mapq", "cigar", "rest", "tags"]
        for batch in batches:
            for route, *fields in zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names]):
                if route not in open_parts:
                    for other in list(open_parts):  # rows are sorted by route: one part is open at a time
                        finish(other)
                    fs, folder = file_system(self._draft(route))
                    fs.create_dir(folder)
                    out = fs.open_output_stream(f"{folder}/{name}")
                    open_parts[route] = (fs, f"{folder}/{name}", out, PartWriter(out, self.headers[route]))
                part = open_parts[route][3]
                part.add(*packed_record(part.ids, *fields))
        for route in list(open_parts):
            finish(route)
        return Written(files)

    def commit(self, messages) -> None:
        for route, path in enumerate(self.paths):
            fs, folder = file_system(path.rstrip("/"))
            fs.create_dir(folder)
            new = {f for m in messages if m for r, f in m.files if r == route}
            old = [x.path for x in fs.get_file_info(pfs.FileSelector(folder)) if x.type == pfs.FileType.File]
            _, draft = file_system(self._draft(route))
            for f in sorted(new):
                fs.move(f"{draft}/{f}", f"{folder}/{f}")
            for x in old if self.overwrite else []:
                fs.delete_file(x)
            if not any(f.endswith(".bam") for f in new):  # no record: the header alone
                with fs.open_output_stream(f"{folder}/part-00000-none.bam") as out:
                    index = PartWriter(out, self.headers[route]).close()
                with fs.open_output_stream(f"{folder}/part-00000-none.bam.bai") as side:
                    side.write(index or b"")
            with fs.open_output_stream(f"{folder}/_SUCCESS"):
                pass
        self._clean()

    def abort(self, messages) -> None:
        self._clean()

    def _clean(self) -> None:
        for route in range(len(self.paths)):
            fs, draft = file_system(self._draft(route))
            if fs.get_file_info(draft).type == pfs.FileType.Directory:
                fs.delete_dir(draft)


# ---------------------------------------------------------------- reading


def read_index(data: bytes) -> list[tuple[dict[int, list[tuple[int, int]]], tuple[int, ...]]]:
    """(chunks by bin, linear index) of every sequence."""
    if data[:4] != b"BAI\x01":
        raise ValueError("not a BAM index")
    out, p = [], 8
    for _ in range(struct.unpack_from("<i", data, 4)[0]):
        bins, count = {}, struct.unpack_from("<i", data, p)[0]
        p += 4
        for _ in range(count):
            number, n = struct.unpack_from("<Ii", data, p)
            flat = struct.unpack_from(f"<{2 * n}Q", data, p + 8)
            bins[number] = list(zip(flat[::2], flat[1::2]))
            p += 8 + 16 * n
        n = struct.unpack_from("<i", data, p)[0]
        out.append((bins, struct.unpack_from(f"<{n}Q", data, p + 4)))
        p += 4 + 8 * n
    return out


def chunks_over(index, ref: int, begin: int, end: int) -> list[tuple[int, int]]:
    """Merged ranges of virtual offsets that hold all records of ``ref`` that overlap [begin, end)."""
    bins, line = index[ref]
    wanted = bins_over(begin, end)
    if not line or begin >> WINDOW >= len(line):
        return []
    least = line[begin >> WINDOW]
    found = sorted((max(a, least), b) for number in wanted & bins.keys() for a, b in bins[number] if b > least)
    out: list[tuple[int, int]] = []
    for a, b in found:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


class PartReader:
    """One BAM file: its header and records, or those of ranges of virtual offsets; ``opened`` counts unpacked blocks."""

    def __init__(self, source, parser):
        from .files import _bam_header

        self.source, self.opened = source, 0
        data, at = bytearray(), 0
        while True:
            more, at = self._block(at)
            if more is None:
                raise ValueError("not a whole BAM header")
            data += more
            try:
                self.text, known, self.begin = _bam_header(bytes(data))
            except (struct.error, UnicodeDecodeError):
                continue
            if self.begin <= len(data):
                break
        self.names = [name for name, _ in known]
        self.parse = parser(self.names)

    def _block(self, at: int) -> tuple[bytes | None, int]:
        """The unpacked block that begins at byte ``at``, and where the next begins; None at the end."""
        from .blocks import inflate

        head = self.source.read_at(18, at) if at < self.source.size() else b""
        if len(head) < 18:
            return None, at
        size = struct.unpack_from("<H", head, 16)[0] + 1
        self.opened += 1
        return inflate(self.source.read_at(size - 16, at + 16)), at + size

    def between(self, start: int, stop: int | None) -> Iterator[tuple]:
        """Records from one virtual offset to another, both where records begin or end (stop None: to the end)."""
        at, skip = start >> 16, start & 0xFFFF
        last, within = (stop >> 16, stop & 0xFFFF) if stop is not None else (1 << 60, 0)
        data = bytearray()
        while at < last or at == last and within:
            place, before = at, len(data)
            more, at = self._block(place)
            if more is None:
                if data:
                    raise ValueError("a record is cut off at the end of the file")
                return
            data += more[skip:]
            limit = before - skip + within if place == last else len(data)
            used, skip = 0, 0
            while used < limit and used + 4 <= len(data):
                end = used + 4 + struct.unpack_from("<i", data, used)[0]
                if end > len(data):
                    break
                yield self.parse(data, used, end)
                used = end
            del data[:used]
            if place == last:
                return

    def everything(self) -> Iterator[tuple]:
        at, left = 0, self.begin
        while True:  # the block in which records begin
            more, then = self._block(at)
            if more is None:
                return
            if left < len(more):
                break
            left -= len(more)
            at = then
        yield from self.between(at << 16 | left, None)

    def region(self, index, names: set[str], low: int, high: int) -> Iterator[tuple]:
        """Records of these sequences in chunks that may hold positions from low to high (1-based)."""
        for ref in [k for k, name in enumerate(self.names) if name in names]:
            for start, stop in chunks_over(index, ref, max(low - 1, 0), min(high, FAR)):
                yield from self.between(start, stop)


class Part(InputPartition):
    def __init__(self, path: str, index: str | None):
        self.path, self.index = path, index


class BamReader(DataSourceReader):
    """Parts, or what their indexes tell to hold these sequences (None: all) from position low to high."""

    def __init__(self, path: str, names: set[str] | None = None, low: int = 1, high: int = FAR):
        self.path, self.names, self.low, self.high = path, names, low, high

    def partitions(self):
        fs, path = file_system(self.path)
        info = fs.get_file_info(path)
        if info.type == pfs.FileType.NotFound:
            raise ValueError(f"{self.path} does not exist")
        files = [info] if info.type == pfs.FileType.File else fs.get_file_info(pfs.FileSelector(path))
        known = {x.path for x in files} if info.type != pfs.FileType.File else {path} | ({f"{path}.bai"} if fs.get_file_info(f"{path}.bai").type == pfs.FileType.File else set())
        return [Part(p, f"{p}.bai" if f"{p}.bai" in known else None) for p in sorted(known) if p.endswith(".bam")]

    def read(self, part: Part):
        from .files import _bam_parser

        fs, _ = file_system(self.path)
        with fs.open_input_file(part.path) as source:
            reader = PartReader(source, _bam_parser)
            if part.index and self.names is not None:
                with fs.open_input_stream(part.index) as side:
                    rows = reader.region(read_index(side.read()), self.names, self.low, self.high)
            else:
                rows = reader.everything()
            held = []
            for row in rows:
                held.append(row)
                if len(held) == 4096:
                    yield batch_of(held)
                    held = []
            if held:
                yield batch_of(held)


class PushdownReader(BamReader):
    def pushFilters(self, filters):
        """Notes bounds on rname and pos; all filters stay with Spark, too."""
        for f in filters:
            column = getattr(f, "attribute", ())
            if column == ("rname",) and isinstance(f, (EqualTo, In)):
                mine = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.names = mine if self.names is None else self.names & mine
            if column == ("pos",):
                if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                    self.low = max(self.low, f.value)
                if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                    self.high = min(self.high, f.value)
            yield f


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows), FIELDS)], names=[n for n, _ in FIELDS])


class BamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema) -> BamReader:
        if self.options.get("pushdown", "false").lower() == "true":
            return PushdownReader(self.options["path"])
        names = json.loads(self.options["names"]) if "names" in self.options else None
        return BamReader(self.options["path"], None if names is None else set(names), int(self.options.get("low", 1)), int(self.options.get("high", FAR)))

    def writer(self, schema, overwrite: bool) -> BamWriter:
        missing = {n for n, _ in FIELDS} | {"tags", "route"}
        if not missing <= set(schema.names):
            raise ValueError(f"columns {sorted(missing - set(schema.names))} are missing")
        paths = json.loads(self.options["paths"]) if "paths" in self.options else [self.options["path"]]
        headers = json.loads(self.options["headers"])
        return BamWriter(paths, headers, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(BamSource)


def region(spark: SparkSession, path: str, names: list[str], low: int = 1, high: int = FAR) -> DataFrame:
    """Records of these sequences that begin from ``low`` to ``high`` (1-based), of a folder of BAM parts."""
    register(spark)
    found = spark.read.format("bam").option("names", json.dumps(names)).option("low", low).option("high", high).load(path)
    return found.filter(F.col("rname").isin(*names) & (F.col("pos") >= low) & (F.col("pos") <= high))
