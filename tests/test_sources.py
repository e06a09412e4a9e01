import bz2
import gzip
import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from chromaloom.functions.sites import RestrictionSite
from chromaloom.plans.facade import Pipeline, SettingError, load_stats
from chromaloom.operators import digest
from chromaloom.sources import blocks, files, header, sinks

FASTA = ">c1 a comment > with a mark\nACGT\nacgtNN\n>c2\n>c3\tx\nGATC GATC\r\nTT\n"


@pytest.mark.parametrize(("name", "pack"), [("a.fa", lambda b: b), ("a.fa.gz", gzip.compress), ("a.fa.bz2", bz2.compress)])
def test_fasta(spark, tmp_path, name, pack):
    (tmp_path / name).write_bytes(pack(FASTA.encode()))
    got = files.read_fasta(spark, str(tmp_path / name)).orderBy("seq_idx").collect()
    assert [tuple(r) for r in got] == [(0, "c1", "ACGTacgtNN"), (1, "c2", ""), (2, "c3", "GATC GATC\rTT")]


SAM = [
    "@HD\tVN:1.6", "@SQ\tSN:c1\tLN:300", "@PG\tID:x\tPN:x",
    "r1\t65\tc1\t5\t60\t20M\t=\t1\t0\tACGTACGTACGTACGTACGT\tIIIIIIIIIIIIIIIIIIIJ\tXX:i:1\tRG:Z:a", "r1\t129\tc1\t205\t60\t20M\t=\t1\t0\tAAAA\tIIII",
    "@odd\t0\tc1\t5\t60\t5M\t*\t0\t0\tA\tI", "r3\tx\tc1\t5\t60\t5M\t*\t0\t0\tA\tI", "short\t1",
]


def test_sam(spark, tmp_path):
    (tmp_path / "a.sam").write_text("\n".join(SAM) + "\n")
    records, head, bad = files.read_sam(spark, str(tmp_path / "a.sam"))
    assert [r["value"] for r in head.orderBy("line_no").collect()] == SAM[:3]
    got = records.orderBy("line_no").collect()
    assert [(r["qname"], r["flag"], r["pos"]) for r in got] == [("r1", 65, 5), ("r1", 129, 205), ("@odd", 0, 5)]
    assert got[0]["rest"].startswith("=\t1\t0\tACGT")
    assert bad.count() == 2


def test_header_only_sam(spark, tmp_path):
    (tmp_path / "a.sam").write_text("\n".join(SAM[:3]) + "\n")
    records, head, bad = files.read_sam(spark, str(tmp_path / "a.sam"))
    assert (records.count(), head.count(), bad.count()) == (0, 3, 0)


def test_fastq_projection(spark):
    rows = [("a", 64, "=\t1\t0\tAACG\tABCD\tBX:Z:q\tRG:Z:r"), ("b", 128 | 16, "=\t1\t0\tAACG\tABCD"), ("c", 256, "=\t1\t0\tA\tA"), ("d", 0x800, "=\t1\t0\tA\tA")]
    got = files.sam_to_fastq(spark.createDataFrame(rows, "qname string, flag int, rest string"), ["BX"]).orderBy("qname").collect()
    assert [tuple(r) for r in got] == [("a", 1, "AACG", "ABCD", "BX:Z:q"), ("b", 2, "CGTT", "DCBA", "")]


def test_fastq(spark, tmp_path):
    text = "@r1/1 note\nACGT\n+\nIIII\n@r1/2\nGG\n+\nJJ\n"
    (tmp_path / "a.fq.gz").write_bytes(gzip.compress(text.encode()))
    got = files.read_fastq(spark, str(tmp_path / "a.fq.gz")).orderBy("record_no").collect()
    assert [(r["qname"], r["comment"], r["mate"], r["seq"], r["qual"]) for r in got] == [("r1", "note", 1, "ACGT", "IIII"), ("r1", "", 2, "GG", "JJ")]


def bgzf(data):
    out = b""
    for part in [data[i : i + 100] for i in range(0, len(data), 100)] + [b""]:
        press = zlib.compressobj(wbits=-15)
        body = press.compress(part) + press.flush()
        out += struct.pack("<BBBBIBBHBBHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(part), len(part))
    return out


def test_bam(spark, tmp_path):
    text = b"@SQ\tSN:c1\tLN:9\n"
    data = b"BAM\x01" + struct.pack("<i", len(text)) + text + struct.pack("<i", 1) + struct.pack("<i", 3) + b"c1\0" + struct.pack("<i", 9)
    for name, flag, ref, bases in ((b"r1", 65, 0, 4), (b"r2", 77, -1, 0)):
        cigar = struct.pack("<I", 4 << 4) if bases else b""
        body = struct.pack("<iiBBHHHiiii", ref, 4 if bases else -1, len(name) + 1, 60, 0, len(cigar) // 4, flag, bases, ref, 7, 0) + name + b"\0" + cigar + (bytes([0x12, 0x48]) + bytes([30] * 4) if bases else b"")
        data += struct.pack("<i", len(body)) + body
    (tmp_path / "a.bam").write_bytes(bgzf(data))
    got = [tuple(r) for r in files.read_bam(spark, str(tmp_path / "a.bam")).collect()]
    assert got == [(0, "r1", 65, "c1", 5, 60, "4M", "=\t8\t0\tACGT\t????"), (1, "r2", 77, "*", 0, 60, "*", "*\t8\t0\t*\t*")]


def bam_of(lines, text, tags=b""):
    """A BAM file of SAM lines of 20 matched bases on c1, with tags after each."""
    data = b"BAM\x01" + struct.pack("<i", len(text)) + text + struct.pack("<i", 1) + struct.pack("<i", 3) + b"c1\0" + struct.pack("<i", 300)
    for name, flag, pos in lines:
        body = struct.pack("<iiBBHHHiiii", 0, pos - 1, len(name) + 1, 60, 0, 1, flag, 20, 0, 0, 0) + name + b"\0" + struct.pack("<I", 20 << 4) + bytes([0x12] * 10) + bytes([30] * 20) + tags
        data += struct.pack("<i", len(body)) + body
    return bgzf(data)


TAGS = b"XAAqXcc\xffXCC\xffXss\xfe\xffXSS\xff\xffXii\xfd\xff\xff\xffXII\xff\xff\xff\xffXff\x00\x00\xc0\x3fRGZa b\0XHH1AFF\0"
TAGS += b"XBBs" + struct.pack("<i2h", 2, -1, 300) + b"XFBf" + struct.pack("<if", 1, 0.5) + b"XEBC" + struct.pack("<i", 0) + b"NMC\x02"
SHOWN = ["XA:A:q", "Xc:i:-1", "XC:i:255", "Xs:i:-2", "XS:i:65535", "Xi:i:-3", "XI:i:4294967295", "Xf:f:1.5", "RG:Z:a b", "XH:H:1AFF", "XB:B:s,-1,300", "XF:B:f,0.5", "XE:B:C", "NM:i:2"]


def test_bam_optional_fields(spark, tmp_path):
    (tmp_path / "a.bam").write_bytes(bam_of([(b"r1", 65, 5), (b"r1", 129, 205)], b"", TAGS))
    records = files.read_bam(spark, str(tmp_path / "a.bam"))
    assert [r["rest"].split("\t")[5:] for r in records.collect()] == [SHOWN, SHOWN]
    assert [r["comment"] for r in files.sam_to_fastq(records, ["RG", "NM"]).collect()] == ["RG:Z:a b\tNM:i:2"] * 2


def test_bam_header_goes_to_the_output(spark, tmp_path):
    (tmp_path / "ref.fa").write_text(">c1\n" + "A" * 100 + "GATC" + "A" * 96 + "GATC" + "A" * 96 + "\n")
    long = "@CO\t" + "é" * 200
    for name, text, want in (("a", "\n".join([*SAM[:3], long]) + "\n", [*SAM[:2], long]), ("b", "@HD\tVN:1.6\n", SAM[:2])):
        (tmp_path / f"{name}.bam").write_bytes(bam_of([(b"r1", 65, 5), (b"r1", 129, 205)], text.encode()))
        p = Pipeline(spark)
        p.reference, p.restriction_sites = str(tmp_path / "ref.fa"), "DpnII"
        p.register_sam_input(str(tmp_path / f"{name}.bam"))
        p.register_output_file(str(tmp_path / f"{name}.sam"), ["valid_pairs"])
        p.run()
        lines = "".join(f.read_text() for f in sorted((tmp_path / f"{name}.sam").glob("part-*"))).splitlines()
        assert lines[: len(want)] == want
        assert [x.split("\t")[1] for x in lines if x.startswith("@PG")] == (["ID:x", "ID:chromaloom"] if name == "a" else ["ID:chromaloom"])


@pytest.fixture
def small_ranges(spark):
    """Byte ranges of 700 bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    was = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "700")
    yield
    for n, v in was.items():
        spark.conf.set(n, v)


def test_bam_by_ranges(spark, tmp_path, small_ranges):
    """Records cross blocks of 100 bytes and byte ranges; two files at once."""
    rng = random.Random(3)
    want = []
    for f in range(2):
        lines = [(f"read{f}.{i}".encode() + b"x" * rng.randrange(60), 65, 5 + i) for i in range(60 + f)]
        (tmp_path / f"{f}.bam").write_bytes(bam_of(lines, b"@HD\tVN:1.6\n" + b"@CO\tlong\n" * 50, TAGS if f else b""))
        want += [(n.decode(), pos) for n, _, pos in lines]
    records = files.read_bam(spark, str(tmp_path / "*.bam")).persist()
    assert sorted((r["qname"], r["pos"]) for r in records.collect()) == sorted(want)
    for f in range(2):
        mine = records.filter(F.col("qname").startswith(f"read{f}.")).orderBy("line_no").collect()
        assert [r["pos"] for r in mine] == list(range(5, 65 + f)) and len({r["line_no"] for r in mine}) == len(mine)
    assert files.read_bam_header(spark, str(tmp_path / "*.bam")) == ["@HD\tVN:1.6", "@CO\tlong", "@SQ\tSN:c1\tLN:300"]
    broken = bgzf(b"BAM\x01" + struct.pack("<iii", 0, 0, 500) + b"x" * 20)
    (tmp_path / "broken.bam").write_bytes(broken)
    with pytest.raises(Exception, match="no whole records"):
        files.read_bam(spark, str(tmp_path / "broken.bam")).collect()


@pytest.mark.parametrize("pack", [lambda b: b, gzip.compress, bz2.compress])
def test_fastq_by_ranges(spark, tmp_path, small_ranges, pack):
    end = {gzip.compress: ".gz", bz2.compress: ".bz2"}.get(pack, "")
    text = "".join(f"@r{i // 2}/{i % 2 + 1}\tnote {i}\n{'ACGT' * (i % 7 + 1)}\n+\n{'@+II' * (i % 7 + 1)}\n" for i in range(80))
    for f in range(2):
        (tmp_path / f"{f}.fq{end}").write_bytes(pack((text + "@cut\nA\n").encode()))
    got = files.read_fastq(spark, str(tmp_path / f"*.fq{end}")).orderBy("file", "record_no").collect()
    assert len(got) == 160 and [r["record_no"] for r in got[:80]] == list(range(80))
    for i, r in enumerate(got[80:]):
        assert (r["qname"], r["mate"], r["comment"], r["seq"], r["qual"]) == (f"r{i // 2}", i % 2 + 1, f"note {i}", "ACGT" * (i % 7 + 1), "@+II" * (i % 7 + 1))


def test_fasta_chunks(spark, tmp_path, small_ranges, monkeypatch):
    monkeypatch.setattr(blocks, "RUN", 3)
    rng = random.Random(5)
    texts = [FASTA, "", "junk\n>a\n\n\nAC\nGT\n>b>c d\nTTT>d\nACGT"]
    texts += ["".join(f">s{k} c\n" + "".join("".join(rng.choice("ACGTN") for _ in range(60)) + "\n" for _ in range(rng.randrange(12))) + "AC\n" * (k % 3) for k in range(12))]
    texts += [">one\n" + "ACGTT" * 600]
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.fa").write_text(text)
        path = str(tmp_path / f"{i}.fa")
        got = blocks.fasta_chunks(spark, path, 100, 20).orderBy("seq_idx", "chunk_start").collect()
        monkeypatch.setattr(digest, "REACH", 20)
        want = digest.chunked(files.read_fasta(spark, path).filter("name <> 'junk'"), 100).orderBy("seq_idx", "chunk_start").collect()
        low = min([r["seq_idx"] for r in want], default=0)
        assert [(r["seq_idx"], r["name"], r["chunk_start"], r["bases"]) for r in got] == [(r["seq_idx"] - low, r["name"], r["chunk_start"], r["bases"]) for r in want]
        assert [r["after"] for r in got] == [r["after"][:20] for r in want]


def test_program_graph():
    graph = header.ProgramGraph(["@PG\tID:a\tPN:a", "@PG\tID:b\tPP:a\tVN:1"])
    assert graph.run({"ID": "a", "PN": "again"}) == [{"ID": "a.1", "PN": "again", "PP": "b"}]
    assert graph.run({"ID": "a"}) == [{"ID": "a.2", "PP": "a.1"}]
    two = header.ProgramGraph(["@PG\tID:a", "@PG\tID:c.1", "@PG\tID:b\tPP:a"])
    assert two.run({"ID": "c"}) == [{"ID": "c", "PP": "c.1"}, {"ID": "c.2", "PP": "b"}]
    assert two.run({"ID": "d"}) == [{"ID": "d", "PP": "c"}, {"ID": "d.1", "PP": "c.2"}]
    assert header.ProgramGraph([]).run({"ID": "z"}) == [{"ID": "z"}]


def test_odd_programs():
    with pytest.raises(header.HeaderError):
        header.ProgramGraph(["@PG\tID:a\tPP:b", "@PG\tID:b\tPP:a"])
    # a cycle beside a chain, a tag given twice, a repeated ID, a record without one
    graph = header.ProgramGraph(["@PG\tID:a\tPP:b", "@PG\tID:b\tPP:a", "@PG\tID:c\tID:d", "@PG\tID:c", "@PG\tPN:none"])
    assert graph.run({"ID": "e"}) == [{"ID": "e", "PP": "c"}]


def test_header_of_an_output():
    sites = {RestrictionSite("GATC", 0, 4), RestrictionSite("A.", 1, 1)}
    lines = header.output_header(["@HD\tVN:1.6", "@PG\tID:x", "@CO\t@PG\tID:no"], "@PG\tID:own\tPN:own", ["FF", "RR"], 7, sites)
    assert lines == ["@HD\tVN:1.6", "@CO\t@PG\tID:no", "@PG\tID:x", "@PG\tID:own\tPN:own\tPP:x\tmq:7\trs:A.,1\trs:GATC,0\thc:FF\thc:RR"]


def test_routes():
    assert sinks.check_routes({"x": ["valid_pairs"], "y": ["DM", "UP"]})["FF"] == "x"
    with pytest.raises(sinks.RouteError):
        sinks.check_routes({"x": ["good_reads"], "y": ["valid_pairs"]})
    with pytest.raises(sinks.RouteError):
        sinks.classes_of("nothing")


def test_pipeline_object(spark, tmp_path):
    (tmp_path / "ref.fa").write_text(">c1\n" + "A" * 100 + "GATC" + "A" * 96 + "GATC" + "A" * 96 + "\n")
    (tmp_path / "a.sam").write_text("\n".join(SAM[:5]) + "\n")
    p = Pipeline(spark)
    with pytest.raises(SettingError):
        p.run()
    p.reference, p.restriction_sites, p.min_mapq = str(tmp_path / "ref.fa"), "DpnII", 10
    p.min_mapq = 10
    with pytest.raises(SettingError):
        p.min_mapq = 11
    p.save_stats_path = str(tmp_path / "stats")
    p.dense_contacts = True
    p.register_sam_input(str(tmp_path / "a.sam"))
    with pytest.raises(SettingError):
        p.register_alignment_index_only()
    p.register_output_file(str(tmp_path / "valid.sam"), ["valid_pairs"])
    p.register_output_file(str(tmp_path / "all"), ["bad_reads", "DM", "invalid_pairs"], sort=True)
    with pytest.raises(sinks.RouteError):
        p.register_output_file(str(tmp_path / "again"), ["FF"])
    stats = p.run()
    assert p.malformed == 0
    assert {r["type"]: r["counts"] for r in stats.pair_counts.collect()}["re-ligation"] == 0
    assert p.output("valid_pairs").count() == 2
    lines = "".join(f.read_text() for f in sorted((tmp_path / "valid.sam").glob("part-*"))).splitlines()
    assert lines[0] == "@HD\tVN:1.6" and any("hc:FF" in x and "mq:10" in x and "rs:GATC,0" in x and "PP:x" in x for x in lines[:4])
    assert lines[4].endswith("XX:i:1\tRG:Z:a\thc:Z:FF\trf:B:I,0,0,100") or lines[5].endswith("rf:B:I,0,0,100")
    tables = load_stats(spark, str(tmp_path / "stats"), ["reads", "valid_pairs"])
    assert tables["reads"].count() == 11 and tables["valid_pairs"].count() == 10
    assert stats.pair_count("c1", "c1").first()["count"] == 1.0
    sinks.write_csv(stats.reads, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 11


def test_programs_and_groups_are_carried_through_realignment(spark, tmp_path):
    (tmp_path / "ref.fa").write_text(">c1\n" + "A" * 100 + "GATC" + "A" * 96 + "GATC" + "A" * 96 + "\n")
    (tmp_path / "a.sam").write_text("\n".join([*SAM[:3], "@RG\tID:a\tSM:s", *SAM[3:5]]) + "\n")

    def aligner(reads, genome):
        assert genome.columns == ["seq_idx", "name", "seq"]
        flag = F.when(F.col("mate") == 1, 65).otherwise(129)
        return reads.select(F.col("mate").cast("long").alias("line_no"), "qname", flag.alias("flag"), F.lit("c1").alias("rname"), F.when(flag == 65, 5).otherwise(205).cast("long").alias("pos"),
                            F.lit(60).alias("mapq"), F.lit("20M").alias("cigar"), F.concat_ws("\t", F.lit("*\t0\t0"), "seq", "qual", "comment").alias("rest"))

    p = Pipeline(spark)
    p.reference, p.restriction_sites = str(tmp_path / "ref.fa"), "DpnII"
    p.register_alignment_sam_reads(str(tmp_path / "a.sam"), aligner, ["RG"])
    p.register_output_file(str(tmp_path / "out.sam"), ["valid_pairs"])
    p.run()
    lines = "".join(f.read_text() for f in sorted((tmp_path / "out.sam").glob("part-*"))).splitlines()
    assert lines[:2] == ["@RG\tID:a\tSM:s", "@PG\tID:x\tPN:x"] and "PP:x" in lines[2]
    assert len(lines) == 5 and sum("\tRG:Z:a\t" in x for x in lines) == 1


def test_command_line(spark, tmp_path):
    from chromaloom.__main__ import main

    (tmp_path / "ref.fa").write_text(">c1\n" + "A" * 100 + "GATC" + "A" * 96 + "GATC" + "A" * 96 + "\n")
    (tmp_path / "a.sam").write_text("\n".join(SAM[:5]) + "\n")
    main(["--reference", str(tmp_path / "ref.fa"), "--sites", "DpnII", "--sam", str(tmp_path / "a.sam"), "--out", f"valid-ff={tmp_path / 'ff'}", "--out", f"bad-reads={tmp_path / 'bad'}"])
    assert spark.read.parquet(str(tmp_path / "ff")).count() == 2
    p = Pipeline(spark)
    (tmp_path / "b.sam").write_text("\n".join(SAM) + "\n")
    p.reference, p.restriction_sites, p.save_stats_path = str(tmp_path / "ref.fa"), "DpnII", str(tmp_path / "sparse")
    p.register_sam_input(str(tmp_path / "b.sam"))
    stats = p.run()
    assert p.malformed == 2 and not (tmp_path / "sparse" / "valid_pairs").exists()
    assert stats.classified.count() == 3 and spark.read.parquet(str(tmp_path / "sparse" / "contacts")).count() == 1
    main(["--reference", str(tmp_path / "ref.fa"), "--sites", "DpnII", "--index-only", "--save-stats", str(tmp_path / "index")])
    (folder,) = (tmp_path / "index").iterdir()
    (table,) = folder.glob("aligned-*")
    assert spark.read.parquet(str(table)).count() == 3
