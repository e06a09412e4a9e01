"""Files of any size by splits: numbered lines of text, chunks of FASTA, records of BAM.

Spark's text reader deals out byte ranges of a file, whatever store it lies in.  What crosses the
edge of a range, or depends on what came before (line numbers, positions, records), is settled
by prefix sums over one row per range.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.tables import Workspace

BROADCAST_ROWS = 250_000
RUN = 12  # FASTA lines are summed in runs of 2^RUN


def _placed(lines: DataFrame) -> DataFrame:
    """file, block (where the line's byte range begins), k (grows within a range), value."""
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("k"))


def _joined(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return left.join(F.broadcast(right) if right.count() <= BROADCAST_ROWS else right, on)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line (its number within the file, from 0) and value of every line."""
    lines = _placed(spark.read.text(path))
    ranges = lines.groupBy("file", "block").agg(F.min("k").alias("_low"), F.count("*").alias("_n"))
    ranges = ranges.withColumn("_base", F.sum("_n").over(W.partitionBy("file").orderBy("block")) - F.col("_n"))
    return _joined(lines, ranges, ["file", "block"]).select("file", (F.col("_base") + F.col("k") - F.col("_low")).alias("line"), "value")


def fasta_chunks(spark: SparkSession, path: str, size: int, reach: int) -> DataFrame:
    """(seq_idx, name, chunk_start, bases, after) of one FASTA file, as ``chunked(read_fasta(path))`` gives them.

    Lines are cut into chunks where they stand: no sequence is ever a row of its own.  A line's
    sequence and position come from prefix sums over runs of lines.  A ``>`` within a line of bases
    begins a header, as in read_fasta.
    """
    raw = spark.read.text(path, lineSep="\n")
    if len(files := raw.inputFiles()) > 1:
        raise ValueError(f"{path}: one FASTA file is expected, not {len(files)}; their lines would have no order")
    lines = _placed(raw).withColumn("run", F.shiftright("k", RUN))
    bases = F.substring_index("value", ">", 1)
    head = F.when(F.col("value").contains(">"), F.expr("substring(value, length(substring_index(value, '>', 1)) + 2)"))
    lines = lines.select("block", "run", "k", bases.alias("bases"), head.alias("head"), F.length(bases).cast("long").alias("n"), head.isNotNull().cast("long").alias("h"))
    run = W.partitionBy("block", "run").orderBy("k")
    inner = lines.withColumn("upto", F.sum("n").over(run)).withColumn("heads", F.sum("h").over(run))
    # Bases of a line belong to the header before it; a header on the line itself comes after them.
    inner = inner.withColumn("since", F.max(F.when(F.col("h") > 0, F.col("upto"))).over(run.rowsBetween(W.unboundedPreceding, -1)))
    sums = lines.groupBy("block", "run").agg(F.sum("n").alias("total"), F.sum("h").alias("count"))
    last = inner.groupBy("block", "run").agg(F.max(F.when(F.col("h") > 0, F.col("upto"))).alias("at_head"))
    order = W.orderBy("block", "run").rowsBetween(W.unboundedPreceding, -1)  # one row per run of lines
    runs = sums.join(last, ["block", "run"]).withColumn("before", F.coalesce(F.sum("total").over(order), F.lit(0))).withColumn("heads_before", F.coalesce(F.sum("count").over(order), F.lit(0)))
    runs = runs.withColumn("origin", F.coalesce(F.max(F.col("before") + F.col("at_head")).over(order), F.lit(0))).select("block", "run", "before", "heads_before", "origin")
    placed = _joined(inner, runs, ["block", "run"])
    start = F.col("before") + F.col("upto") - F.col("n") - F.coalesce(F.col("before") + F.col("since"), F.col("origin"))
    seq = (F.col("heads_before") + F.col("heads") - F.col("h") - 1).cast("int")
    placed = placed.select(seq.alias("seq_idx"), start.alias("start"), "bases", "n", (F.col("heads_before") + F.col("heads") - 1).cast("int").alias("opened"), "head")
    # A line lies in one or more chunks; bases that a chunk begins with also follow the chunk before.
    mine = placed.filter("seq_idx >= 0 and n > 0").withColumn("chunk", F.explode(F.sequence(F.floor(F.col("start") / size), F.floor((F.col("start") + F.col("n") - 1) / size))))
    part = lambda low, high: F.struct(
        F.greatest("start", low).alias("at"),
        F.substr(F.col("bases"), (F.greatest("start", low) - F.col("start") + 1).cast("int"), (F.least(F.col("start") + F.col("n"), high) - F.greatest("start", low)).cast("int")).alias("text"),
    )
    low = F.col("chunk") * size
    own = mine.select("seq_idx", "chunk", part(low, low + size).alias("own"), F.lit(None).alias("next"))
    ahead = mine.filter((F.col("chunk") > 0) & (F.col("start") < low + reach)).select("seq_idx", (F.col("chunk") - 1).alias("chunk"), F.lit(None).alias("own"), part(low, low + reach).alias("next"))
    named = placed.filter("head is not null").select(F.col("opened").alias("seq_idx"), F.regexp_extract("head", r"^([^\x00-\x20]*)", 1).alias("name"))
    kind = own.schema["own"].dataType
    empty = named.select("seq_idx", F.lit(0).cast("long").alias("chunk"), F.lit(None).cast(kind).alias("own"), F.lit(None).cast(kind).alias("next"))
    every = own.withColumn("next", F.lit(None).cast(kind)).unionByName(ahead.withColumn("own", F.lit(None).cast(kind))).unionByName(empty)
    text = lambda c: F.array_join(F.transform(F.sort_array(F.collect_list(c)), lambda x: x["text"]), "")
    chunks = every.groupBy("seq_idx", "chunk").agg(text("own").alias("bases"), text("next").alias("after"))
    chunks = chunks.join(named, "seq_idx")  # one row per sequence
    return chunks.select("seq_idx", "name", (F.col("chunk") * size).alias("chunk_start"), "bases", "after")


#: The first bytes of a BGZF block, up to its size (fixed by the format, as written by its tools).
BGZF_MAGIC = "\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff\x06\x00BC\x02\x00"


def bgzf_blocks(spark: SparkSession, path: str) -> DataFrame:
    """file, block and value (bytes from the block's size on) of the BGZF blocks, in order within a range."""
    raw = spark.read.option("encoding", "ISO-8859-1").option("lineSep", BGZF_MAGIC).text(path)
    return raw.filter(F.length(F.col("value").cast("binary")) > 0).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value")
    )


def inflate(value: bytes) -> bytes:
    size = struct.unpack_from("<H", value)[0] + 1
    body = value[2 : size - 16]
    if len(value) != size - 16:
        raise ValueError("a BGZF block differs from its size")
    data = zlib.decompress(body[:-8], wbits=-15)
    if (zlib.crc32(data), len(data)) != struct.unpack("<II", body[-8:]):
        raise ValueError("a BGZF block differs from its checksum")
    return data


def _plausible(data, at: int, sequences: int) -> int:
    """Where the record that may begin here would end; 0 if none can, -1 if the data end too early to tell."""
    if at + 36 > len(data):
        return -1
    size, ref, pos, name, _, _, ops, _, bases, mref, mpos, _ = struct.unpack_from("<iiiBBHHHiiii", data, at)
    if not (-1 <= ref < sequences and -1 <= mref < sequences and pos >= -1 and mpos >= -1 and name > 0 and bases >= 0):
        return 0
    if size < 32 + name + 4 * ops + (bases + 1) // 2 + bases:
        return 0
    stop = at + 36 + name - 1
    if stop < len(data) and data[stop] != 0:
        return 0
    text = data[at + 36 : min(stop, len(data))]
    if any(not 33 <= c <= 126 for c in text):
        return 0
    return at + 4 + size


class Span:
    """The unpacked bytes of one byte range of a BAM file: what comes before its first record, and its records."""

    SURE = 4  # records in a row that show a boundary

    def __init__(self, file: str, block: int, sequences: int, header_end: Callable[[bytes], int | None]):
        self.file, self.block, self.sequences, self.header_end = file, block, sequences, header_end
        self.data, self.head, self.synced = bytearray(), b"", False

    def _boundary(self, ended: bool) -> int | None:
        if self.block == 0:
            return self.header_end(bytes(self.data))
        for begin in range(len(self.data)):
            at, seen = begin, 0
            while seen < self.SURE and 0 < (then := _plausible(self.data, at, self.sequences)) <= len(self.data):
                at, seen = then, seen + 1
            if seen == self.SURE or (seen and at == len(self.data) and ended):
                return begin
            # the bytes end within a chain: with more of them it may be sure
            if then != 0 and not ended:
                return None
            if then != 0 and seen:
                return begin
        return None

    def take(self, more: bytes, ended: bool = False) -> Iterator[tuple[int, int]]:
        """Ranges of whole records in ``data`` that ``more`` completes; call ``drop`` afterwards."""
        self.data += more
        if not self.synced:
            begin = self._boundary(ended)
            if begin is None:
                return
            self.synced, self.head = True, b"" if self.block == 0 else bytes(self.data[:begin])
            del self.data[:begin]
        self.used = 0
        while self.used + 4 <= len(self.data):
            end = self.used + 4 + struct.unpack_from("<i", self.data, self.used)[0]
            if end > len(self.data):
                break
            yield self.used, end
            self.used = end

    def drop(self) -> None:
        if self.synced:
            del self.data[: self.used]


def bam_rows(spark: SparkSession, path: str, sequences: int, header_end, parse, columns: list[tuple[str, pa.DataType, str]]) -> DataFrame:
    """line_no and the columns that ``parse(data, begin, end)`` gives of every record of BAM files.

    Every byte range finds its first record by itself: a place from which records follow one
    another.  The bytes between the last record of a range and the first of the next must be whole records, too,
    or else the reading fails: a boundary cannot be wrong unnoticed.
    """
    names = ["file", "block", "line_no", *[n for n, *_ in columns], "head", "tail", "synced"]
    kinds = [pa.string(), pa.int64(), pa.int64(), *[k for _, k, _ in columns], pa.binary(), pa.binary(), pa.bool_()]
    shape = "file string, block long, line_no long, " + ", ".join(f"{n} {s}" for n, _, s in columns) + ", head binary, tail binary, synced boolean"

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names) if rows else None

    def edge(span: Span):
        whole = span.synced
        return (span.file, span.block, None, *[None] * len(columns), span.head if whole else bytes(span.data), bytes(span.data) if whole else b"", whole)

    def decode(batches):
        span, rows, count = None, [], 0

        def records(more, ended=False):
            nonlocal count
            for begin, end in span.take(more, ended):
                rows.append((span.file, span.block, span.block * 32 + count, *parse(span.data, begin, end), None, None, None))
                count += 1
            span.drop()

        for batch in batches:
            for file, block, value in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), batch.column("value")):
                if span is None or (span.file, span.block) != (file, block):
                    if span is not None:
                        records(b"", True)
                        rows.append(edge(span))
                    span, count = Span(file, block, sequences, header_end), 0
                records(inflate(value.as_py()))
                if len(rows) >= 4096:
                    yield table(rows)
                    rows.clear()
        if span is not None:
            records(b"", True)
            rows.append(edge(span))
        if rows:
            yield table(rows)

    def settle(group: pa.Table) -> pa.Table:
        """Records that cross the edges of byte ranges, of one file."""
        rows, carry, headed = [], b"", True
        parts = sorted(group.to_pylist(), key=lambda r: r["block"])
        for part in [*parts, {"block": 1 << 56, "head": b"", "tail": b"", "synced": True, "file": parts[0]["file"]}]:
            carry += part["head"]
            if not part["synced"]:
                headed &= part["block"] > 0  # the header goes on beyond the first range
                continue
            own, at = [], 0 if headed else header_end(carry) or 0
            while at + 4 <= len(carry) and at < (end := at + 4 + struct.unpack_from("<i", carry, at)[0]) <= len(carry):
                own.append(parse(carry, at, end))
                at = end
            if at != len(carry):
                raise ValueError(f"{part['file']}: the bytes before byte {part['block']} are no whole records")
            rows += [(part["block"] * 32 - len(own) + k, *r) for k, r in enumerate(own)]
            carry, headed = part["tail"], True
        kept = list(zip(*rows)) if rows else [[] for _ in range(len(columns) + 1)]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(kept, [pa.int64(), *[k for _, k, _ in columns]])], names=["line_no", *[n for n, *_ in columns]])

    found = Workspace(spark, "bam").table(bgzf_blocks(spark, path).mapInArrow(decode, shape), "records")
    kept = ["line_no", *[n for n, *_ in columns]]
    edges = found.filter("synced is not null").select("file", "block", "head", "tail", "synced")
    crossing = edges.groupBy("file").applyInArrow(settle, "line_no long, " + ", ".join(f"{n} {s}" for n, _, s in columns))
    return found.filter("synced is null").select(*kept).unionByName(crossing)


def bam_heads(spark: SparkSession, path: str, header_end) -> list[tuple[str, bytes]]:
    """The unpacked bytes that hold the header, of each BAM file."""

    def begin(batches):
        data, done, file = bytearray(), False, None
        for batch in batches:
            for name, block, value in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), batch.column("value")):
                if name != file and file is not None and not done and data:
                    raise ValueError(f"{file}: not a whole BAM header")
                if name != file:
                    data, done, file = bytearray(), False, name
                if block or done:
                    continue
                data += inflate(value.as_py())
                if header_end(bytes(data)) is not None:
                    done = True
                    yield pa.RecordBatch.from_pydict({"file": [file], "data": pa.array([bytes(data)], pa.binary())})

    found = bgzf_blocks(spark, path).mapInArrow(begin, "file string, data binary").orderBy("file").collect()
    return [(r["file"], bytes(r["data"])) for r in found]
