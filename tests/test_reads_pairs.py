import random

import pytest
from pyspark.sql import functions as F

from chromaloom.functions.alignments import query_length, reference_length
from chromaloom.functions.sites import compile_sites
from chromaloom.operators import digest, pairs, reads, stats

COLUMNS = "line_no long, qname string, flag int, rname string, pos long, mapq int, cigar string"


@pytest.mark.parametrize(
    ("cigar", "ref", "query"),
    [("10M", 10, 10), ("M", 1, 1), ("5S10M2D3I4=1X6H", 17, 23), ("*", 0, 0), ("3N", 3, 0), ("2P", 0, 0), ("", 0, 0), (None, 0, 0)],
)
def test_cigar(spark, cigar, ref, query):
    row = spark.createDataFrame([(cigar,)], "c string").select(reference_length(F.col("c")), query_length(F.col("c"))).first()
    assert tuple(row) == (ref, query)


@pytest.fixture(scope="module")
def digested(spark):
    seqs = ["A" * 100 + "GATC" + "A" * 96 + "GATC" + "A" * 96, "C" * 50]
    genome = spark.createDataFrame([(i, f"c{i}", s) for i, s in enumerate(seqs)], "seq_idx int, name string, seq string")
    chunks = digest.chunked(genome, 64)
    return digest.lengths(chunks).persist(), digest.fragments(chunks, compile_sites("DpnII")).persist()


READS = [
    # (flag, rname, pos, mapq, cigar), class, distance
    ((65, "c0", 101, 10, "10M"), None, 0),
    ((65, "c0", 101, 9, "10M"), "MQ", None),
    ((65, "c9", 101, 60, "10M"), "IR", None),
    ((0, "c0", 101, 60, "10M"), "UP", None),
    ((4 | 0x400 | 1, "c0", 101, 60, "10M"), "DP", None),
    ((0xFFF, "c0", 101, 60, "10M"), "SP", None),
    ((65, "c0", 150, 60, "20M"), "RS", None),
    ((65, "c0", 151, 60, "26M"), None, 50),
    ((65, "c0", 151, 60, "25M"), "RS", None),
    ((65, "c0", 152, 60, "26M"), None, -49),
    ((81, "c0", 92, 60, "10M"), None, 0),
    ((81, "c0", 91, 60, "10M"), None, -1),
    ((65, "c0", 290, 60, "50M"), None, 89),
    ((65, "c0", 0, 60, "50M"), "RS", None),
    ((65, "c0", 101, 60, "*"), "RS", None),
    ((65, "c1", 20, 60, "10M"), None, 19),
]


def test_read_classes(spark, digested):
    names, frags = digested
    df = spark.createDataFrame([(i, f"q{i}", *r[0]) for i, r in enumerate(READS)], COLUMNS)
    for strategy in ("bin", "window", "broadcast"):
        got = sorted(reads.classify(df, names, frags, strategy=strategy).collect(), key=lambda r: r["line_no"])
        assert [(r["hc"], r["site_dist"]) for r in got] == [(c, d) for _, c, d in READS], strategy
        assert all((r["frag_id"] is None) == (r["hc"] is not None) for r in got)


def test_without_digest_nothing_is_too_far(spark, digested):
    names, _ = digested
    df = spark.createDataFrame([(i, f"q{i}", *r[0]) for i, r in enumerate(READS)], COLUMNS)
    got = reads.classify(df, names, None).filter("hc = 'RS'").collect()
    assert [r["cigar"] for r in got] == ["*"]  # a query without bases is never near


def test_flags_count_in_every_class(spark):
    df = spark.createDataFrame([(4 | 0x400 | 1,), (0,), (0x800,)], "flag int")
    assert reads.flag_counts(df).first().asDict() == {"reads": 3, "UP": 2, "UM": 1, "SE": 0, "QC": 0, "DP": 1, "SP": 1}


def machine(sides):
    """Two waiting slots: (pairs, dumped)."""
    slot, out, gone = {}, [], []
    for line, one in enumerate(sides):
        if one in slot:
            gone.append(slot[one])
        slot[one] = line
        if len(slot) == 2:
            out.append((slot[True], slot[False]))
            slot = {}
    return sorted(out), sorted(gone + list(slot.values()))


def test_mates_like_a_state_machine(spark):
    rng = random.Random(1)
    runs = [[True, True, False, False], [False, True], [True], [True, False, True], [False, False, True, True, False, True, False]]
    runs += [[rng.random() < 0.5 for _ in range(rng.randint(1, 14))] for _ in range(200)]
    rows = [(f"q{i}", k, one, 0, 10 * k, 0, 0, None, 1, False) for i, run in enumerate(runs) for k, one in enumerate(run)]
    schema = "qname string, line_no long, is_read1 boolean, seq_idx int, read_start long, frag_id long, frag_start long, frag_next long, site_dist long, is_reverse boolean"
    rng.shuffle(rows)
    good = spark.createDataFrame(rows, schema)
    got = pairs.mated(good).collect()
    for i, run in enumerate(runs):
        mine = [r for r in got if r["qname"] == f"q{i}"]
        one = sorted((r["line_no"], r["mate"]["line_no"]) if r["is_read1"] else (r["mate"]["line_no"], r["line_no"]) for r in mine if r["closes"])
        assert (one, sorted(r["line_no"] for r in mine if r["mate"] is None)) == machine(run), run


def test_resolve_agrees_with_pairing(spark):
    """One shuffle gives the classes of reads and the pairs, bad reads among them or not."""
    rng = random.Random(8)
    rows = []
    for q in range(150):
        for k in range(rng.randint(1, 9)):
            start, seq = rng.randrange(0, 400), rng.randrange(2)
            frag = start // 100
            good = rng.random() < 0.8
            placed = (seq, start, seq * 10 + frag, frag * 100, frag * 100 + 100 if frag < 3 else None, 1) if good else (None,) * 6
            rows.append((k, f"q{q}", rng.choice([65, 129]) | rng.choice([0, 16]), "x", *placed, None if good else rng.choice(["MQ", "UM"])))
    rng.shuffle(rows)
    schema = "line_no long, qname string, flag int, rest string, seq_idx int, read_start long, frag_id long, frag_start long, frag_next long, site_dist long, hc string"
    classified = spark.createDataFrame(rows, schema)
    done = pairs.resolve(classified).persist()
    found = pairs.pair_reads(reads.good_reads(classified))
    assert done.columns == [*classified.columns, "pair"]
    assert sorted(map(str, pairs.pairs_of(done).select(*found.columns).collect())) == sorted(map(str, found.collect())) and found.count() > 50
    of_pair = {(r["qname"], r[f"{e}_line_no"]): r["hc"] for r in found.collect() for e in ("r1", "r2")}
    want = {(q, k): hc or of_pair.get((q, k), "DM") for k, q, *_, hc in rows}
    assert {(r["qname"], r["line_no"]): r["hc"] for r in done.collect()} == want
    back = done.drop("pair").withColumn("hc", F.when(F.col("hc").isin("MQ", "UM"), F.col("hc")))
    assert sorted(map(str, back.collect())) == sorted(map(str, classified.collect()))


def test_duplicates_by_quality_and_unclipped_ends(spark):
    rest = lambda q: "=\t1\t0\t" + "A" * len(q) + "\t" + q
    rows = [
        # a and b: equal ends once clips count; b has the better bases; c has the same with bases below 15 only
        ("a", 65, 105, "5S10M", rest("0" * 15)), ("a", 145, 300, "10M5S", rest("0" * 15)),
        ("b", 65, 100, "15M", rest("I" * 15)), ("b", 145, 295, "20M", rest("I" * 20)),
        ("c", 65, 103, "3H12M", rest("/" * 12)), ("c", 145, 300, "15M", rest("/" * 15)),
        ("d", 65, 100, "15M", rest("I" * 15)), ("d", 145, 296, "20M", rest("I" * 20)),  # another end
        ("e", 65, 100, "15M", "*\t0\t0\t*\t*"),  # a single read
        ("f", 65, 100, "15M", "*\t0\t0\t*\t*"), ("f", 321, 100, "15M", "*\t0\t0\t*\t*"), ("g", 69, 100, "15M", "short"),
    ]
    table = spark.createDataFrame([(i, q, f, "c1", p, 60, c, r) for i, (q, f, p, c, r) in enumerate(rows)], COLUMNS + ", rest string")
    got = pairs.mark_duplicates(table).collect()
    assert {r["qname"] for r in got if r["flag"] & 0x400} == {"a", "c", "f"}
    assert sorted(r["flag"] & ~0x400 for r in got) == sorted(f for _, f, *_ in rows)
    assert pairs.mark_duplicates(table.drop("rest")).filter("flag & 1024 <> 0").count() == 5


GOOD = "qname string, line_no long, is_read1 boolean, seq_idx int, read_start long, frag_id long, frag_start long, frag_next long, site_dist long, is_reverse boolean"


@pytest.mark.parametrize(
    ("one", "two", "want"),
    [
        ((0, 5, 0, 0, 100, False), (0, 50, 0, 0, 100, True), ("DE", True, 45, -100)),
        ((0, 5, 0, 0, 100, True), (0, 50, 0, 0, 100, False), ("SC", True, 45, -100)),
        ((0, 5, 0, 0, 100, True), (0, 50, 0, 0, 100, True), ("SS", True, 45, -100)),
        ((0, 5, 0, 0, 100, False), (0, 150, 1, 100, 200, False), ("RL", True, 145, 0)),
        ((0, 150, 1, 100, 200, False), (0, 5, 0, 0, 100, True), ("RL", True, 145, 0)),
        ((0, 5, 0, 0, 100, False), (0, 250, 2, 200, None, True), ("FR", True, 245, 100)),
        ((0, 250, 2, 200, None, True), (0, 5, 0, 0, 100, False), ("FR", True, 245, 100)),
        ((0, 5, 0, 0, 100, True), (1, 250, 3, 100, None, False), ("RF", False, None, None)),
        ((1, 250, 3, 100, None, False), (0, 5, 0, 0, 100, True), ("FR", False, None, None)),
        ((0, 7, None, None, None, True), (0, 7, None, None, None, True), ("RR", True, 0, 0)),
    ],
)
def test_pair_classes(spark, one, two, want):
    rows = [("q", k, k == 0, s, p, f, a, n, 3, r) for k, (s, p, f, a, n, r) in enumerate((one, two))]
    row = pairs.pair_reads(spark.createDataFrame(rows, GOOD)).first()
    assert (row["hc"], row["intra"], row["pair_sep"], row["frag_sep"]) == want


def test_five_end(spark):
    schema = "qname string, line_no long, flag int, cigar string"
    rows = [
        ("a", 0, 64, "10M5S"), ("b", 0, 64, "5S10M"), ("c", 0, 64, "5S10M"), ("c", 1, 64 | 2048, "10M5S"), ("d", 0, 64, "10M"), ("d", 1, 64 | 2048, "10M"),
        ("e", 0, 64, "3S4M"), ("e", 1, 64, "4M"), ("e", 2, 64, "3S4M"), ("f", 0, 68, "10M"), ("g", 0, 80, "5S10M"),
    ]
    got = {(r["qname"], r["line_no"], r["flag"]) for r in pairs.five_end(spark.createDataFrame(rows, schema)).collect()}
    assert got == {("a", 0, 64), ("b", 0, 68), ("c", 1, 64), ("d", 0, 68), ("e", 0, 68), ("f", 0, 68), ("g", 0, 80)}


def test_stream_pairs_like_batch(spark, tmp_path):
    from chromaloom.streaming.pairing import pair_stream

    rows = [("a", 0, True), ("a", 1, True), ("a", 2, False), ("b", 0, False), ("b", 1, True), ("c", 0, True)]
    spark.createDataFrame(rows, "qname string, line_no long, is_read1 boolean").write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema("qname string, line_no long, is_read1 boolean").parquet(str(tmp_path / "in"))
    run = pair_stream(source, waits=None).writeStream.format("memory").queryName("paired").outputMode("append").option("checkpointLocation", str(tmp_path / "state")).start()
    run.processAllAvailable()
    run.stop()
    got = {tuple(r) for r in spark.table("paired").collect()}
    assert got == {("a", 0, None), ("a", 1, 2), ("b", 1, 0)}


def test_reads_leave_the_stream_after_their_wait(spark, tmp_path):
    import time

    from chromaloom.streaming.pairing import pair_stream

    schema = "qname string, line_no long, is_read1 boolean"
    spark.createDataFrame([("a", 0, True), ("b", 1, True), ("b", 2, False)], schema).write.parquet(str(tmp_path / "in"))
    paired = pair_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), waits=1.0)
    run = paired.writeStream.format("memory").queryName("waited").outputMode("append").option("checkpointLocation", str(tmp_path / "state")).start()
    end = time.time() + 60
    while time.time() < end and spark.table("waited").count() < 2:
        time.sleep(0.5)
    run.stop()
    assert {tuple(r) for r in spark.table("waited").collect()} == {("b", 1, 2), ("a", 0, None)}


def test_dense_frame_of_unmerged_sequences(spark):
    sequences = spark.createDataFrame([(k, f"c{k}", n) for k, n in enumerate((10, 20, 0, 40))], "seq_idx int, name string, length long")
    held = {(0, 0, "FF"): 3, (0, 1, "FF"): 1, (0, 1, "RR"): 4, (1, 3, "FR"): 2, (3, 3, "RF"): 5}
    contacts = spark.createDataFrame([(*k, n) for k, n in held.items()], "seq1 int, seq2 int, hc string, count long")
    got = stats.valid_pairs_dense(contacts, sequences).collect()
    size, want = (10, 20, 0, 40), {}
    for a in range(4):
        for b in range(a, 4):
            for kind in ("FF", "FR", "RF", "RR", "total"):
                n = sum(x for (i, j, hc), x in held.items() if (i, j) == (a, b) and kind in (hc, "total"))
                want[f"c{a}", f"c{b}", kind.lower(), False] = float(n)
                want[f"c{a}", f"c{b}", kind.lower(), True] = n / (size[a] * size[b]) if size[a] * size[b] else None
    assert len(got) == len(want) and {tuple(r)[:4]: r["count"] for r in got} == want


def test_duplicates_of_supplementary_records_and_optical_copies(spark):
    """Against brute force: five sets, tiles and distances on both sides of the limit, names without coordinates."""
    import random

    rng = random.Random(11)
    rows, templates = [], []
    for i in range(120):
        at = rng.randrange(5)
        name = f"n{i}" if i % 10 == 0 else f"m:1:f:1:{rng.randrange(2)}:{rng.randrange(0, 1200, 50)}:{rng.randrange(0, 800, 100)}{rng.choice(['', '#ACGT', '/1'])}"
        if name in {t[0] for t in templates}:
            continue
        quality = rng.randrange(20, 40)
        templates.append((name, at, quality))
        shown = "*\t0\t0\t*\t" + chr(quality + 33) * 10
        rows += [(name, 65, "c", 10 + at, "10M", shown), (name, 129, "c", 300, "10M", shown), (name, 65 | 2048, "c", 50, "10M", shown), (name, 65 | 256, "c", 50, "10M", shown)]
    places = {t[0]: __import__("re").fullmatch(r"(.*):(\d+):(\d+)([#/].*)?", t[0]) for t in templates}
    want = {}
    for name, at, _ in templates:
        members = [t for t in templates if t[1] == at]
        stays = min(members, key=lambda t: (-t[2], t[0]))[0]
        if name == stays:
            continue
        near = False
        for other, *_ in members:
            a, b = places[name], places[other]
            if other != name and a and b and a[1] == b[1]:
                near |= abs(int(a[2]) - int(b[2])) <= 100 and abs(int(a[3]) - int(b[3])) <= 100
        want[name] = "SQ" if near else "LB"
    table = spark.createDataFrame(rows, "qname string, flag int, rname string, pos long, cigar string, rest string")
    assert {r["qname"]: r["dt"] for r in pairs.duplicates(table).collect()} == want and set(want.values()) == {"SQ", "LB"}
    marked = pairs.mark_duplicates(table).filter("flag & 1024 <> 0").collect()
    assert len(marked) == 3 * len(want) and not any(r["flag"] & 256 for r in marked) and sum(r["flag"] & 2048 > 0 for r in marked) == len(want)
    assert {(r["qname"], r["rest"].rsplit("\t", 1)[1]) for r in marked} == {(q, f"dt:Z:{k}") for q, k in want.items()}
    assert pairs.mark_duplicates(table, supplementary=False).filter("flag & 1024 <> 0").count() == 2 * len(want)
    closer = {r["qname"]: r["dt"] for r in pairs.duplicates(table, optical=0).collect()}
    assert set(closer) == set(want) and sum(k == "SQ" for k in closer.values()) < sum(k == "SQ" for k in want.values())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_records_of_a_bad_flag_need_no_lookup(spark, digested):
    names, frags = digested
    df = spark.createDataFrame([(i, f"q{i}", *r[0]) for i, r in enumerate(READS)], COLUMNS)
    whole = reads.classify(df, names, frags)
    able, rejected = reads.by_flags(df)
    rest = reads.flagged(rejected)
    assert "Join" not in plan_of(rest) and "Exchange" not in plan_of(rest)
    parts = reads.classify(able, names, frags).unionByName(rest)
    assert parts.columns == whole.columns and parts.dtypes == whole.dtypes
    assert sorted(map(str, parts.collect())) == sorted(map(str, whole.collect())) and 0 < rest.count() < whole.count()
    good = reads.good_reads(reads.classify(reads.candidates(df), names, frags))
    assert sorted(map(str, good.collect())) == sorted(map(str, reads.good_reads(whole).collect()))


@pytest.mark.parametrize("digest_given", [True, False])
def test_good_reads_alone_are_those_of_all(spark, digested, digest_given):
    names, frags = digested
    df = spark.createDataFrame([(i, f"q{i}", *r[0]) for i, r in enumerate(READS)], COLUMNS)
    whole = reads.classify(df, names, frags if digest_given else None)
    good = reads.classify(df, names, frags if digest_given else None, good_only=True)
    want = whole.filter("hc is null")
    assert good.dtypes == whole.dtypes and 0 < want.count() < whole.count()
    assert sorted(map(str, good.collect())) == sorted(map(str, want.collect()))


def test_classes_without_details(spark):
    """The classes of reads are the same without the pairs, and nothing else is carried for them."""
    places = [(0, 5, 0, 0, 100), (0, 205, 2, 200, 300), (0, 105, 1, 100, 200), (1, 40, 10, 0, None)]
    rows = [(line, f"q{i}{j}{k}", flag | k, *at, 5, None) for i, a in enumerate(places) for j, b in enumerate(places) for k in (0, 16) for line, (flag, at) in enumerate(((65, a), (129 | 16, b), (65, b)))]
    rows.append((9, "q000", 129, *(None,) * 6, "MQ"))
    schema = "line_no long, qname string, flag int, seq_idx int, read_start long, frag_id long, frag_start long, frag_next long, site_dist long, hc string"
    classified = spark.createDataFrame(rows, schema)
    done, slim = pairs.resolve(classified), pairs.resolve(classified, details=False)
    assert slim.columns == classified.columns
    assert sorted(map(str, slim.collect())) == sorted(map(str, done.drop("pair").collect()))
    assert {r["hc"] for r in slim.collect()} >= {"DE", "SS", "RL", "RR", "FR", "DM", "MQ"}
    held = lambda df: any("site_dist#" in line and "Scan" not in line for line in plan_of(df).splitlines())
    assert held(done.select("qname", "hc")) and not held(slim.select("qname", "hc"))


def test_lookup_of_reads_joins_names_and_fragments_only(spark, digested, monkeypatch):
    """Also beyond the bounds of broadcasts, where each further join would shuffle every read."""
    from chromaloom.operators import asof

    names, frags = digested
    df = spark.createDataFrame([(i, f"q{i}", *r[0]) for i, r in enumerate(READS)], COLUMNS)
    monkeypatch.setattr(asof, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(reads, "BROADCAST_ROWS", 0)
    got = reads.classify(df, names, frags)
    told = got._jdf.queryExecution().optimizedPlan().toString()
    assert told.count("Join ") == 2
    assert [(r["hc"], r["site_dist"]) for r in got.orderBy("line_no").collect()] == [(c, d) for _, c, d in READS]


def test_resolve_shuffles_only_what_is_asked_for(spark):
    schema = "line_no long, qname string, flag int, rest string, seq_idx int, read_start long, frag_id long, frag_start long, frag_next long, site_dist long, hc string"
    classified = spark.createDataFrame([], schema)
    done = pairs.resolve(classified)
    held = lambda df: any("rest#" in line and "Scan" not in line for line in plan_of(df).splitlines())
    assert held(done) and not held(done.select("qname", "hc"))


def test_read_summary_in_one_pass(spark):
    schema = "line_no long, qname string, flag int, seq_idx int, read_start long, frag_id long, frag_start long, frag_next long, site_dist long, hc string"
    rows = [(0, "a", 65, 0, 5, 0, 0, 100, 5, None), (1, "a", 129, 0, 205, 2, 200, 300, 5, None), (0, "b", 65, 0, 5, 0, 0, 100, 5, None), (1, "b", 65 | 0x800, *(None,) * 6, "SP"), (2, "b", 129, *(None,) * 6, "MQ")]
    classified = spark.createDataFrame(rows, schema)
    done = pairs.resolve(classified)
    one = stats.read_summary(done)
    assert plan_of(one).count("Window [") == plan_of(done).count("Window [")
    want = stats.read_summary(classified, pairs.pair_reads(reads.good_reads(classified)))
    assert sorted(map(str, one.collect())) == sorted(map(str, want.collect()))
    assert {r["type"]: r["counts"] for r in one.collect() if r["counts"]} == {"good read": 2, "dumped": 1, "supplementary": 1, "mapping quality too low": 1}


def test_optical_copies_ask_around_only_if_alone_in_their_cell(spark):
    rng = random.Random(4)
    places = {f"t:{rng.randrange(2)}:{rng.randrange(700)}:{rng.randrange(700)}#{k}": rng.choice("IJK") for k in range(120)}
    rows = [(k, q, 65, "c", 10, 60, "5M", "=\t1\t0\tACGTA\t" + c * 5) for k, (q, c) in enumerate(places.items())]
    found = pairs.duplicates(spark.createDataFrame(rows, COLUMNS + ", rest string"))
    assert any("/cells" in path for path in found.inputFiles())  # counts of cells, not nine rows per template
    at = {q: (q.split(":")[1], *map(int, q.split("#")[0].split(":")[2:])) for q in places}
    close = lambda a, b: a[0] == b[0] and abs(a[1] - b[1]) <= 100 and abs(a[2] - b[2]) <= 100
    first = min(places, key=lambda q: (-ord(places[q]), q))
    want = {(q, first, "SQ" if any(close(at[q], at[r]) for r in places if r != q) else "LB") for q in places if q != first}
    assert {tuple(r) for r in found.collect()} == want and {dt for *_, dt in want} == {"SQ", "LB"}


def test_qualities_are_summed_from_fifteen_on(spark):
    shown = spark.createDataFrame([(x,) for x in ["*", None, "", "/0I", "!!!", "~*"]], "q string").repartition(2)
    got = {r["q"]: r["s"] for r in shown.select("q", pairs._quality_sum(F.coalesce("q", F.lit("*"))).alias("s")).collect()}
    assert got == {"*": 0, None: 0, "": 0, "/0I": 15 + 40, "!!!": 0, "~*": 93}
