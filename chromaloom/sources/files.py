"""Readers of sequence and alignment files.

Plain, gzip and bzip2 files are read by Spark's own codecs, by file ending.  BAM is decoded from
its BGZF blocks, by byte ranges.  CRAM is not read.
"""

from __future__ import annotations

import struct

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import blocks
from .bam import NUMBERS, OPERATIONS, bases_of, qualities_of

FIELDS = ["qname", "flag", "rname", "pos", "mapq", "cigar"]


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """seq_idx, name, seq, in file order.

    A record begins at ``>``; its name ends at the first blank or control character, the rest
    of that line is a comment; every byte of later lines is a base, line ends excepted.
    """
    parts = spark.read.text(path, lineSep=">").filter("value <> ''").withColumn("_at", F.monotonically_increasing_id())
    parts = parts.withColumn("_whole", F.col("value").contains("\n"))
    # A '>' inside a header line splits it: pieces without a line end belong to the next piece.
    if parts.filter(~F.col("_whole")).limit(1).count():
        order = W.orderBy("_at")
        parts = parts.withColumn("_group", F.coalesce(F.sum(F.col("_whole").cast("int")).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        parts = parts.groupBy("_group").agg(F.min("_at").alias("_at"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_at", "value"))), lambda x: x["value"]), ">").alias("value"))
    parts = parts.filter(F.col("value").rlike("[^\\n]"))
    index = parts.select("_at").withColumn("seq_idx", (F.row_number().over(W.orderBy("_at")) - 1).cast("int"))
    head = F.substring_index("value", "\n", 1)
    body = F.when(F.col("value").contains("\n"), F.expr("substring(value, length(substring_index(value, '\n', 1)) + 2)")).otherwise("")
    name = F.regexp_extract(head, r"^([^\x00-\x20]*)", 1)
    return parts.join(index, "_at").select("seq_idx", name.alias("name"), F.translate(body, "\n", "").alias("seq"))


def read_sam(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records, header, malformed) of a SAM text file.

    Records have line_no, qname, flag, rname, pos, mapq, cigar, rest (all further fields).  Header
    lines are the leading ones that begin with ``@``.  Lines without six fields or with junk in a
    number are malformed.  line_no grows with the place in the file, with gaps.
    """
    lines = spark.read.text(path).withColumn("line_no", F.monotonically_increasing_id())
    header_like = F.col("value").startswith("@")
    first = lines.filter(~header_like).agg(F.min("line_no")).first()[0]
    is_header = header_like & (F.col("line_no") < (first if first is not None else 2**62))
    header = lines.filter(is_header).select("line_no", "value")
    part = F.split("value", "\t", 7)
    number = lambda i, kind: F.get(part, i).try_cast(kind)
    rows = lines.filter(~is_header).select(
        "line_no", F.get(part, 0).alias("qname"), number(1, "int").alias("flag"), F.get(part, 2).alias("rname"), number(3, "long").alias("pos"),
        number(4, "int").alias("mapq"), F.get(part, 5).alias("cigar"), F.get(part, 6).alias("rest"), "value",
    )
    sound = F.col("flag").isNotNull() & F.col("pos").isNotNull() & F.col("mapq").isNotNull() & F.col("cigar").isNotNull()
    return rows.filter(sound).drop("value"), header, rows.filter(~sound).select("line_no", "value")


def read_fastq(spark: SparkSession, path: str, mate: int | None = None) -> DataFrame:
    """file, record_no, qname, comment, mate, seq, qual of four-line FASTQ files; mate None: interleaved.

    Plain and bzip2 files are split, gzip files are not.  Lines meet in their record by the number
    of the line within the file; an incomplete last record is left out.
    """
    lines = blocks.numbered_lines(spark, path).filter("value is not null")
    line = lambda k: F.first(F.when(F.col("line") % 4 == k, F.col("value")), ignorenulls=True)
    rows = lines.groupBy("file", F.floor(F.col("line") / 4).alias("record_no")).agg(F.count("*").alias("_n"), line(0).alias("_head"), line(1).alias("seq"), line(3).alias("qual"))
    head = F.substr(F.col("_head"), F.lit(2), F.length("_head"))
    name = F.regexp_extract(head, r"^\s*(\S*)", 1)
    comment = F.regexp_extract(head, r"^\s*\S+\s+(.*)$", 1)
    side = F.lit(mate).cast("int") if mate else (F.col("record_no") % 2 + 1).cast("int")
    return rows.filter("_n = 4").select("file", "record_no", F.regexp_replace(name, "/[12]$", "").alias("qname"), comment.alias("comment"), "seq", "qual", side.alias("mate"))


def sam_to_fastq(records: DataFrame, keep_tags: list[str] | None = None) -> DataFrame:
    """qname, mate, seq, qual, comment of primary records, as sequenced (reverse strands are turned)."""
    part = F.split("rest", "\t")
    seq, qual = F.get(part, 3), F.get(part, 4)
    turned = F.col("flag").bitwiseAND(16) != 0
    back = F.translate(F.reverse(seq), "ACGTUWSMKRYBDHVacgtuwsmkrybdhv", "TGCAAWSKMYRVHDBtgcaawskmyrvhdb")
    tags = F.filter(F.slice(part, 6, F.greatest(F.size(part) - 5, F.lit(0))), lambda t: F.substring(t, 1, 2).isin(*(keep_tags or [""])))
    mate = F.when(F.col("flag").bitwiseAND(0x40) != 0, 1).when(F.col("flag").bitwiseAND(0x80) != 0, 2).otherwise(0)
    return records.filter(F.col("flag").bitwiseAND(0x900) == 0).select(
        "qname", mate.alias("mate"), F.when(turned, back).otherwise(seq).alias("seq"), F.when(turned, F.reverse(qual)).otherwise(qual).alias("qual"), F.array_join(tags, "\t").alias("comment")
    )


def _bam_header(data: bytes):
    """(header text, names and lengths of sequences, where records begin) of unpacked bytes of a BAM file."""
    if data[:4] != b"BAM\x01"[: len(data)]:
        raise ValueError("not a BAM file")
    text = struct.unpack_from("<i", data, 4)[0]
    head = data[8 : 8 + text].rstrip(b"\0").decode()
    at = 8 + text
    known, count = [], struct.unpack_from("<i", data, at)[0]
    at += 4
    for _ in range(count):
        n = struct.unpack_from("<i", data, at)[0]
        known.append((data[at + 4 : at + 3 + n].decode(), struct.unpack_from("<i", data, at + 4 + n)[0]))
        at += 8 + n
    return head, known, at


def _bam_tags(data: bytes, p: int, end: int) -> list[str]:
    """The optional fields of a record, as SAM writes them."""
    tags = []
    shown = lambda kind, x: f"{x:g}" if kind == "f" else str(x)
    while p < end:
        tag, kind = data[p : p + 2].decode(), chr(data[p + 2])
        p += 3
        if kind == "A":
            value, p = chr(data[p]), p + 1
        elif kind in "ZH":
            stop = data.index(0, p)
            value, p = data[p:stop].decode(), stop + 1
        elif kind == "B":
            of, n = chr(data[p]), struct.unpack_from("<i", data, p + 1)[0]
            form = f"<{n}{NUMBERS[of]}"
            value = ",".join([of, *(shown(of, x) for x in struct.unpack_from(form, data, p + 5))])
            p += 5 + struct.calcsize(form)
        else:
            form = f"<{NUMBERS[kind]}"
            value, p = shown(kind, struct.unpack_from(form, data, p)[0]), p + struct.calcsize(form)
            kind = "f" if kind == "f" else "i"
        tags.append(f"{tag}:{kind}:{value}")
    return tags


def _header_end(data: bytes) -> int | None:
    """Where the records begin, or None if the header goes on beyond these bytes."""
    try:
        at = _bam_header(data)[2]
    except (struct.error, UnicodeDecodeError):
        return None
    return at if at <= len(data) else None


def _bam_parser(names: list[str]):
    """The fields of read_sam, from the bytes of a record."""

    def parse(data, begin: int, end: int) -> tuple:
        _, ref, pos, nl, mapq, _, ops, flag, bases, mref, mpos, tlen = struct.unpack_from("<iiiBBHHHiiii", data, begin)
        p = begin + 36
        qname = data[p : p + nl - 1].decode()
        p += nl
        cigar = "".join(f"{x >> 4}{OPERATIONS[x & 15]}" for x in struct.unpack_from(f"<{ops}I", data, p)) or "*"
        p += 4 * ops
        seq = bases_of(data, p, bases)
        p += (bases + 1) // 2
        qual = qualities_of(data, p, bases)
        name = lambda i: names[i] if i >= 0 else "*"
        mate = "=" if mref == ref and ref >= 0 else name(mref)
        return qname, flag, name(ref), pos + 1, mapq, cigar, "\t".join([mate, str(mpos + 1), str(tlen), seq, qual, *_bam_tags(data, p + bases, end)])

    return parse


def read_bam(spark: SparkSession, path: str) -> DataFrame:
    """Records of BAM files, as read_sam gives them; line_no grows with the place in its file.

    Files are read in byte ranges of BGZF blocks, by as many tasks as text of that size.  Files
    that are read together must list the same sequences.
    """
    heads = blocks.bam_heads(spark, path, _header_end)
    known = [[name for name, _ in _bam_header(data)[1]] for _, data in heads]
    if any(x != known[0] for x in known):
        raise ValueError("the BAM files list different sequences")
    names = known[0] if known else []
    columns = [("qname", pa.string(), "string"), ("flag", pa.int32(), "int"), ("rname", pa.string(), "string"), ("pos", pa.int64(), "long"), ("mapq", pa.int32(), "int"), ("cigar", pa.string(), "string"), ("rest", pa.string(), "string")]
    return blocks.bam_rows(spark, path, len(names), _header_end, _bam_parser(names), columns)


def read_bam_header(spark: SparkSession, path: str) -> list[str]:
    """Header lines of BAM files, each once; sequences without an @SQ line get one."""
    out: dict[str, None] = {}
    for _, data in blocks.bam_heads(spark, path, _header_end):
        head, known, _ = _bam_header(data)
        lines = head.splitlines()
        if not any(x.startswith("@SQ") for x in lines):
            lines += [f"@SQ\tSN:{name}\tLN:{length}" for name, length in known]
        out |= dict.fromkeys(lines)
    return list(out)
