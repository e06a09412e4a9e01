"""Indexed BAM, outputs in one pass, and digests that are read again."""

import json
import random

import pyarrow.fs as pfs
import pytest
from pyspark.sql import functions as F

from chromaloom.functions.sites import compile_sites
from chromaloom.operators import digest
from chromaloom.operators.index import DigestIndex
from chromaloom.plans.facade import Pipeline
from chromaloom.sources import bam, files, sinks

HEADER = ["@HD\tVN:1.6\tSO:coordinate", "@SQ\tSN:c1\tLN:900000", "@SQ\tSN:c2\tLN:70000000", "@CO\té"]


def lines(n=4000, seed=1):
    """SAM fields with odd lengths, tags of all kinds, and records without a place."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        size = rng.randrange(0, 9) or rng.randrange(30, 160)
        seq = "".join(rng.choice("ACGTN=R") for _ in range(size)) or "*"
        qual = "".join(chr(rng.randrange(33, 100)) for _ in range(size)) if size and i % 5 else "*"
        name = rng.choice(["c1", "c2", "c2"])
        pos = rng.randrange(1, 800_000 if name == "c1" else 60_000_000)
        cigar = f"{size}M" if i % 3 else f"2S{max(size - 2, 1)}M{rng.randrange(1, 50_000)}N1="
        tags = ["NM:i:-3\tXA:A:q\tXI:i:4000000000", "XF:f:0.5\tRG:Z:a b:c\tXH:H:1AFF", "XB:B:s,-1,300\tXG:B:f,0.5,2\tXE:B:C", ""][i % 4]
        if i % 50 == 7:
            name, pos, cigar = "*", 0, "*"
        mate, mpos = rng.choice([("=", 5), ("c2" if name == "c1" else "c1", 77), ("*", 0)]) if name != "*" else ("*", 0)
        out.append((i, f"r{i}" + "x" * rng.randrange(40), rng.choice([0, 16, 65, 145]), name, pos, rng.randrange(61), cigar, "\t".join([mate, str(mpos), "12", seq, qual, *filter(None, [tags])]), f"hc:Z:FF\trf:B:I,{i},0,4294967295"))
    return out


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    """4000 records sorted into parts, and the same with smaller blocks."""
    path = str(tmp_path_factory.mktemp("bam") / "sorted.bam")
    rows = spark.createDataFrame(lines(), "line_no long, qname string, flag int, rname string, pos long, mapq int, cigar string, rest string, tags string").withColumn("route", F.lit(0))
    sequences = spark.createDataFrame([(0, "c1"), (1, "c2")], "seq_idx int, name string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else the parts are joined for their few bytes
    sinks.write_bams(sinks.coordinate_sorted(rows.repartition(3), sequences, ["route"]), [HEADER], [path])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return path


def fields(rows):
    return sorted((r["qname"], r["flag"], r["rname"], r["pos"], r["mapq"], r["cigar"], r["rest"]) for r in rows)


def expected():
    return sorted((q, f, n, p, m, c, f"{rest}\t{tags}") for _, q, f, n, p, m, c, rest, tags in lines())


def test_written_bam_reads_back(spark, written):
    assert fields(files.read_bam(spark, f"{written}/*.bam").collect()) == expected()
    assert fields(spark.read.format("bam").load(written).collect()) == expected()
    assert files.read_bam_header(spark, f"{written}/*.bam") == HEADER
    names = [x.base_name for x in pfs.LocalFileSystem().get_file_info(pfs.FileSelector(written))]
    parts = [n for n in names if n.endswith(".bam")]
    assert "_SUCCESS" in names and len(parts) > 1 and all(f"{n}.bai" in names for n in parts) and not any("temporary" in n for n in names)


REGIONS = [("c1", 1, 20_000), ("c1", 400_000, 400_900), ("c2", 59_000_000, 10**9), ("c2", 16_385, 16_385), ("c2", 33_554_000, 33_555_500), ("c1", 850_000, 890_000)]


@pytest.mark.parametrize("name,low,high", REGIONS)
def test_region_like_a_filter(spark, written, name, low, high):
    got = bam.region(spark, written, [name], low, high)
    assert fields(got.collect()) == [r for r in expected() if r[2] == name and low <= r[3] <= high]


def test_index_opens_only_its_blocks(spark, written, monkeypatch):
    """Pushed filters reach the reader; what it opens is a small part of the blocks."""
    reader = bam.PushdownReader(written)
    assert len(list(reader.pushFilters([bam.EqualTo(("rname",), "c2"), bam.GreaterThanOrEqual(("pos",), 30_000_000), bam.LessThan(("pos",), 30_100_000), bam.EqualTo(("flag",), 0)]))) == 4
    assert (reader.names, reader.low, reader.high) == ({"c2"}, 30_000_000, 30_100_000)
    found, opened, every = [], 0, 0
    for part in reader.partitions():
        with pfs.LocalFileSystem().open_input_file(part.path) as source:
            one = bam.PartReader(source, files._bam_parser)
            index = bam.read_index(open(part.index, "rb").read())
            found += [r for r in one.region(index, reader.names, reader.low, reader.high) if 30_000_000 <= r[3] < 30_100_000]
            opened += one.opened - 1  # the header's
            whole = bam.PartReader(source, files._bam_parser)
            assert len(list(whole.everything())) > 0
            every += whole.opened - 1
    assert sorted(r[0] for r in found) == [q for q, _, n, p, *_ in expected() if n == "c2" and 30_000_000 <= p < 30_100_000]
    assert 0 < 3 * opened <= every
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        got = spark.read.format("bam").option("pushdown", "true").load(written).filter("rname in ('c1', 'c9') and pos < 9000")
        assert fields(got.collect()) == [r for r in expected() if r[2] == "c1" and r[3] < 9000]
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_small_blocks(tmp_path, monkeypatch):
    """Records that cross blocks; every region of a file of blocks of 300 bytes."""
    monkeypatch.setattr(bam, "BLOCK", 300)
    rows = sorted((x for x in lines(600, 2) if x[3] != "*"), key=lambda x: (x[3], x[4]))
    with pfs.LocalFileSystem().open_output_stream(str(tmp_path / "a.bam")) as out:
        part = bam.PartWriter(out, HEADER)
        for _, *record in rows:
            part.add(*bam.packed_record(part.ids, *record))
        index = bam.read_index(part.close())
    with pfs.LocalFileSystem().open_input_file(str(tmp_path / "a.bam")) as source:
        reader = bam.PartReader(source, files._bam_parser)
        assert [r[0] for r in reader.everything()] == [r[1] for r in rows]
        rng = random.Random(3)
        for _ in range(60):
            name, low = rng.choice(["c1", "c2"]), rng.randrange(1, 800_000)
            high = low + rng.choice([0, 5_000, 50_000_000])
            got = [r[0] for r in reader.region(index, {name}, low, high) if low <= r[3] <= high]
            assert got == [r[1] for r in rows if r[3] == name and low <= r[4] <= high]


def test_unsorted_parts_have_no_index_and_failed_jobs_leave_nothing(spark, tmp_path):
    rows = spark.createDataFrame(lines(50), "line_no long, qname string, flag int, rname string, pos long, mapq int, cigar string, rest string, tags string").withColumn("route", F.lit(0))
    sinks.write_bams(rows.coalesce(1), [HEADER], [str(tmp_path / "a.bam")])
    assert not [x for x in (tmp_path / "a.bam").iterdir() if x.name.endswith(".bai")]
    before = fields(spark.read.format("bam").load(str(tmp_path / "a.bam")).filter("rname = 'c1' and pos > 10").collect())
    assert before
    with pytest.raises(Exception):
        sinks.write_bams(rows.coalesce(1).withColumn("rname", F.lit("unknown")), [HEADER], [str(tmp_path / "a.bam")])
    assert fields(spark.read.format("bam").load(str(tmp_path / "a.bam")).filter("rname = 'c1' and pos > 10").collect()) == before
    assert not [x for x in (tmp_path / "a.bam").iterdir() if "temporary" in x.name]


# ---------------------------------------------------------------- outputs in one pass


def reference(tmp_path, bases="A" * 100 + "GATC" + "A" * 96 + "GATC" + "A" * 96):
    (tmp_path / "ref.fa").write_text(f">c1\n{bases}\n")
    rng = random.Random(4)
    sam = ["@HD\tVN:1.6", "@SQ\tSN:c1\tLN:300"]
    for i in range(40):
        for flag in (65, 129):
            sam.append(f"q{i}\t{flag | rng.choice([0, 16, 4, 256, 1024])}\t{rng.choice(['c1', 'c1', 'c9'])}\t{rng.choice([5, 95, 120, 205])}\t{rng.choice([3, 60])}\t20M\t=\t1\t0\t{'ACGT' * 5}\t{'I' * 20}")
    (tmp_path / "a.sam").write_text("\n".join(sam) + "\n")


def pipeline(spark, tmp_path, index=None):
    p = Pipeline(spark)
    p.reference, p.restriction_sites = str(tmp_path / "ref.fa"), "DpnII"
    if index:
        p.index_path = str(index)
    p.register_sam_input(str(tmp_path / "a.sam"))
    return p


def plans(spark, since):
    store = spark._jsparkSession.sharedState().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    found = store.executionsList()
    return [found.apply(k).physicalPlanDescription() for k in range(since, found.size())], found.size()


def test_all_outputs_of_a_form_cost_one_scan(spark, tmp_path):
    reference(tmp_path)
    p = pipeline(spark, tmp_path)
    every = ["FF", "FR", "RF", "RR", "SC", "DE", "SS", "RL", "DM", "UP", "UM", "SE", "QC", "DP", "SP", "IR", "MQ", "RS"]
    for c in every[:9]:
        p.register_output_file(str(tmp_path / f"{c}.sam"), [c])
    for c in every[9:]:
        p.register_output_file(str(tmp_path / "more" / c), [c])
    _, before = plans(spark, 0)
    p.run()
    told, _ = plans(spark, before)
    assert sum("route" in x and "InsertIntoHadoopFsRelationCommand" in x and "staged" in x for x in told) == 2
    got = {}
    for c in every[:9]:
        text = "".join(f.read_text() for f in sorted((tmp_path / f"{c}.sam").glob("part-*"))).splitlines()
        assert text[:2] == ["@HD\tVN:1.6", "@SQ\tSN:c1\tLN:300"] and f"hc:{c}" in text[2]
        body = [x for x in text if not x.startswith("@")]
        assert all(f"hc:Z:{c}" in x for x in body)
        got[c] = len(body)
    for c in every[9:]:
        table = spark.read.parquet(str(tmp_path / "more" / c))
        assert "tags" in table.columns
        got[c] = table.count()
    want = {r["hc"]: r["count"] for r in p.tagged.groupBy("hc").count().collect()}
    assert {c: n for c, n in got.items() if n} == want and sum(got.values()) == 80
    assert not [x for x in tmp_path.iterdir() if "staged" in x.name]


def test_pipeline_writes_sorted_bam(spark, tmp_path):
    reference(tmp_path)
    p = pipeline(spark, tmp_path)
    p.register_output_file(str(tmp_path / "good.bam"), ["good_reads"], sort=True)
    p.register_output_file(str(tmp_path / "bad.bam"), ["IR"], sort=True)  # c9 is not in the header
    with pytest.raises(Exception):
        p.run()
    p = pipeline(spark, tmp_path)
    p.register_output_file(str(tmp_path / "good.bam"), ["good_reads"], sort=True)
    p.register_output_file(str(tmp_path / "low.bam"), ["QC"], sort=True)  # none
    p.run()
    got = spark.read.format("bam").load(str(tmp_path / "good.bam")).collect()
    assert [r["pos"] for r in got] == sorted(r["pos"] for r in got) and len(got) == p.output("good_reads").count() > 0
    assert spark.read.format("bam").load(str(tmp_path / "low.bam")).count() == 0
    assert files.read_bam_header(spark, str(tmp_path / "good.bam" / "*.bam"))[0] == "@HD\tVN:1.6\tSO:coordinate"
    again = Pipeline(spark)
    again.reference, again.restriction_sites = str(tmp_path / "ref.fa"), "DpnII"
    again.register_sam_input(str(tmp_path / "good.bam" / "*.bam"))
    again.run()
    assert again.output("good_reads").count() == len(got)


# ---------------------------------------------------------------- digests that are read again


def test_second_run_reads_no_base(spark, tmp_path):
    reference(tmp_path)
    first = pipeline(spark, tmp_path, tmp_path / "index")
    counts = sorted(map(tuple, first.run().reads.collect()))
    _, before = plans(spark, 0)
    second = pipeline(spark, tmp_path, tmp_path / "index")
    second.chunks = lambda: pytest.fail("the reference is read again")
    assert sorted(map(tuple, second.run().reads.collect())) == counts
    told, _ = plans(spark, before)
    assert told and not any("ref.fa" in x for x in told)


def test_what_makes_an_index_miss(spark, tmp_path):
    reference(tmp_path)
    path, sites = str(tmp_path / "ref.fa"), compile_sites("DpnII")
    make = lambda s=sites: DigestIndex(spark, str(tmp_path / "index"), path, s)
    table = spark.range(10).withColumn("x", F.lit("a"))
    assert make().get("t") is None
    kept = make().put("t", table)
    assert kept.count() == 10 and make().get("t").dtypes == table.dtypes
    assert make(compile_sites("MseI")).get("t") is None  # other sites
    folder = tmp_path / "index" / digest.cache_key(path, sites)
    known = json.loads((folder / "t.json").read_text())
    part = next(x for x in (folder / known["table"]).iterdir() if x.name.startswith("part-"))
    whole = part.read_bytes()
    part.write_bytes(whole + b"x")  # a file of another length
    assert make().get("t") is None
    part.write_bytes(whole)
    assert make().get("t").count() == 10
    part.rename(tmp_path / "lost")  # a file that is lost
    assert make().get("t") is None
    (folder / "t.json").write_text('{"identity":')  # a manifest cut short
    assert make().get("t") is None
    assert make().put("t", table).count() == 10
    (folder / "t.json").unlink()  # written, but not committed
    assert make().get("t") is None
    make().put("t", table)
    (tmp_path / "ref.fa").write_text(">c1\nACGT\n")  # another reference
    assert make().get("t") is None
    assert make().get_or_put("t", lambda: spark.range(3)).count() == 3 and make().get_or_put("t", lambda: pytest.fail("made again")).count() == 3


def test_index_only_makes_one_digest(spark, tmp_path):
    reference(tmp_path)
    p = Pipeline(spark)
    p.reference, p.restriction_sites, p.index_path = str(tmp_path / "ref.fa"), "DpnII", str(tmp_path / "index")
    p.register_alignment_index_only()
    assert p.run() is None
    (folder,) = (tmp_path / "index").iterdir()
    assert sorted(x.name.split("-")[0] for x in folder.iterdir() if not x.name.startswith(".")) == ["aligned", "aligned.json"]
    p.chunks = lambda: pytest.fail("the reference is read again")
    assert sorted(r["bases"] for r in p.aligned_digest().collect()) == sorted(["A" * 100 + "GATC", "GATC" + "A" * 96 + "GATC", "GATC" + "A" * 96])


# ---------------------------------------------------------------- alignment, trimming and the command line

GENOME = "A" * 60 + "CCGTTGCA" + "GATC" + "CATTCGGA" * 12 + "GATC" + "TGCCATGA" * 12 + "GATC" + "C" * 80


def exact_aligner(reads, genome):
    """Finds a read where it stands, or as much of its beginning as stands somewhere; the rest is clipped."""
    import pyarrow as pa

    known = [(r["name"], r["seq"]) for r in genome.collect()]

    def align(batches):
        for batch in batches:
            rows = []
            for name, mate, seq, qual, comment in zip(*[batch.column(c).to_pylist() for c in ("qname", "mate", "seq", "qual", "comment")]):
                size, place = next(((n, (s, g.index(seq[:n]))) for n in range(len(seq), 9, -1) for s, g in known if seq[:n] in g), (0, None))
                flag = 65 if mate == 1 else 129
                clip = f"{len(seq) - size}S" if size < len(seq) else ""
                tail = "\t".join(["*\t0\t0", seq, qual, *([comment] if comment else [])])
                rows.append((mate, name, flag if place else flag | 4, place[0] if place else "*", place[1] + 1 if place else 0, 60, f"{size}M{clip}" if place else "*", tail))
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string()]
            names = ["line_no", "qname", "flag", "rname", "pos", "mapq", "cigar", "rest"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return reads.mapInArrow(align, "line_no long, qname string, flag int, rname string, pos long, mapq int, cigar string, rest string")


def fastq(tmp_path):
    """A read that runs over a junction of two places, which only its trimmed part explains, and one that does not."""
    junction = GENOME[40:72] + GENOME[3:23]
    pairs = [(junction, GENOME[180:220]), (GENOME[80:120], GENOME[185:225])]
    for k in (0, 1):
        (tmp_path / f"{k + 1}.fq").write_text("".join(f"@q{i} x\n{p[k]}\n+\n{'I' * len(p[k])}\n" for i, p in enumerate(pairs)))
    return [str(tmp_path / "1.fq"), str(tmp_path / "2.fq")], junction


@pytest.mark.parametrize("trim", [False, True])
def test_alignment_in_two_passes(spark, tmp_path, trim):
    (tmp_path / "ref.fa").write_text(f">c1\n{GENOME}\n")
    paths, junction = fastq(tmp_path)
    p = Pipeline(spark)
    p.reference, p.restriction_sites = str(tmp_path / "ref.fa"), "DpnII"
    p.register_alignment(paths, exact_aligner, trim=trim)
    p.run()
    got = {(r["qname"], r["line_no"]): (r["cigar"], r["rest"].split("\t")[3]) for r in p.tagged.collect()}
    cigar, seq = got["q0", 1]
    # a forward read keeps nothing of the filled overhang at its fragment's end
    assert (cigar, seq) == (("28M", junction[:28]) if trim else ("32M20S", junction))
    assert got["q1", 1] == ("40M", GENOME[80:120]) and len(got) == 4


def test_command_line_aligns_sorts_and_indexes(spark, tmp_path, monkeypatch):
    from chromaloom.__main__ import main

    (tmp_path / "ref.fa").write_text(f">c1\n{GENOME}\n")
    paths, _ = fastq(tmp_path)
    base = ["--reference", str(tmp_path / "ref.fa"), "--sites", "DpnII"]
    monkeypatch.syspath_prepend(str(__import__("pathlib").Path(__file__).parent))
    main([*base, "--fastq", *paths, "--aligner", "test_outputs:exact_aligner", "--trim", "--mark-duplicates", "--index", str(tmp_path / "index"), "--out", f"all-reads={tmp_path / 'all.bam'}:sort"])
    assert spark.read.format("bam").load(str(tmp_path / "all.bam")).count() == 4
    assert list((tmp_path / "all.bam").glob("*.bai")) and list((tmp_path / "index").rglob("aligned.json")) and list((tmp_path / "index").rglob("fragments.json"))
    main([*base, "--sam-reads", str(tmp_path / "all.bam" / "*.bam"), "--aligner", "test_outputs:exact_aligner", "--keep-tag", "hc", "--out", f"all-reads={tmp_path / 'again'}"])
    again = spark.read.parquet(str(tmp_path / "again"))
    assert again.count() == 4 and again.filter(F.col("rest").contains("hc:Z:")).count() == 4
    for wrong in (["--sam", "x.sam", "--aligner", "a:b"], ["--fastq", "x.fq"], ["--sam", "x.sam", "--trim"]):
        with pytest.raises(SystemExit):
            main([*base, *wrong])


def test_one_fasta_file_is_expected(spark, tmp_path):
    from chromaloom.sources import blocks

    for k in (0, 1):
        (tmp_path / f"{k}.fa").write_text(">a\nACGT\n")
    with pytest.raises(ValueError, match="one FASTA file"):
        blocks.fasta_chunks(spark, str(tmp_path / "*.fa"), 16, 3)
