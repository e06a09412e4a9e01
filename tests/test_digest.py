import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chromaloom.functions.sites import compile_sites
from chromaloom.operators import asof, digest

SITES = compile_sites("Arima_v2")


def brute_cuts(seq, sites):
    out = {0}
    for s in [*sites, *digest.scan_patterns(sites)[-2:]]:
        out |= {m.start() + s.loc for m in re.finditer(f"(?=({s.pattern}))", seq, re.I)}
    return sorted(out)


CASES = ["GATCAAGATC", "gatcGATC", "TTAATTAA", "A" * 30, "GA", "", "NNNAGATCNN", "GATC" * 12, "GAATCTTAACTTAGN" * 4]


def genome(spark, seqs):
    return spark.createDataFrame([(i, f"c{i}", s) for i, s in enumerate(seqs)], "seq_idx int, name string, seq string")


@pytest.mark.parametrize("size", [4, 7, 16384])
def test_cuts_do_not_depend_on_chunks(spark, size):
    got = digest.cuts(digest.chunked(genome(spark, CASES), size), SITES).collect()
    for i, seq in enumerate(CASES):
        assert sorted(r["cut"] for r in got if r["seq_idx"] == i) == brute_cuts(seq, SITES), seq


@pytest.mark.parametrize("block", [2, 4, 22])
def test_fragments_tile(spark, monkeypatch, block):
    monkeypatch.setattr(digest, "BLOCK", block)
    chunks = digest.chunked(genome(spark, CASES), 5)
    rows = digest.fragments(chunks, SITES).orderBy("frag_id").collect()
    assert [r["frag_id"] for r in rows] == list(range(len(rows)))
    for i, seq in enumerate(CASES):
        own = [r for r in rows if r["seq_idx"] == i]
        assert own[0]["frag_start"] == 0 and own[-1]["frag_end"] == len(seq) and own[-1]["frag_next"] is None
        assert all(a["frag_next"] == b["frag_start"] == a["frag_end"] for a, b in zip(own, own[1:]))
    table = {r["name"]: r for r in digest.sequence_table(chunks, digest.fragments(chunks, SITES)).collect()}
    assert table["c0"]["n_sites"] == len(brute_cuts(CASES[0], SITES)) - 1
    assert [r["length"] for _, r in sorted(table.items())] == [len(s) for s in CASES]


@settings(max_examples=60, deadline=None)
@given(st.text("ACGTNacgt", max_size=60), st.integers(3, 20))
def test_scan_against_lookahead(seq, size):
    import numpy as np

    patterns = [(digest._tables(s.pattern), s.loc) for s in digest.scan_patterns(SITES)]
    found = {0}
    for at in range(0, len(seq), size):
        data = np.frombuffer(seq[at : at + size + digest.REACH].encode(), np.uint8)
        found |= {int(x) + at for x in digest.find_all(data, min(size, len(seq) - at), patterns)}
    assert sorted(found) == brute_cuts(seq, SITES)


def test_texts_are_scanned_together_and_bytes_looked_up_once_per_set():
    class Told(np.ndarray):
        lookups = 0

        def __getitem__(self, key):
            Told.lookups += 1
            return np.asarray(self)[key]

    patterns = [([t.view(Told) for t in digest._tables(s.pattern)], s.loc) for s in digest.scan_patterns(SITES)]
    texts = [x.encode() for x in [*CASES, "GA", "TC", "TTA"]]
    begins = np.array([max(len(x) - 1, 0) for x in texts])
    text, cut = digest.find_each(texts, begins, patterns)
    sets = {t.tobytes() for places, _ in patterns for t in places}
    assert Told.lookups == len(sets) < sum(len(places) for places, _ in patterns)
    for k, x in enumerate(texts):
        assert cut[text == k].tolist() == digest.find_all(np.frombuffer(x, np.uint8), int(begins[k]), patterns).tolist()
    assert not digest.find_each([b""], np.zeros(1, int), patterns)[0].size


@pytest.mark.parametrize("strategy", ["bin", "merge", "window", "broadcast"])
def test_lookup_strategies(spark, strategy):
    seqs = ["GATCAAGATC" * 20, "A" * 50, "TTAACC" * 100]
    frags = digest.fragments(digest.chunked(genome(spark, seqs), 64), SITES).persist()
    points = [(i, i % 4, (i * 37) % 700 - 5) for i in range(300)]
    df = spark.createDataFrame(points, "id int, seq_idx int, at long")
    table = [(r["seq_idx"], r["frag_start"], r["frag_id"]) for r in frags.collect()]
    want = {i: max(((a, f) for s, a, f in table if s == q and a <= p), default=(None, None)) for i, q, p in points}
    got = {r["id"]: (r["frag_start"], r["frag_id"]) for r in asof.lookup(df, frags, "at", strategy, shift=4).collect()}
    assert got == want


def test_merge_splits_a_hot_place(spark):
    """All points on one base of one sequence, some before and behind all fragments, others on unknown sequences."""
    frags = digest.fragments(digest.chunked(genome(spark, ["GATCAAGATC" * 20, "A" * 50]), 64), SITES).persist()
    points = [(i, 0, 105) for i in range(4000)] + [(5000 + i, i % 3 if i % 3 < 2 else None, i * 17 - 40) for i in range(60)] + [(6000, 7, 5), (6001, 0, None)]
    df = spark.createDataFrame(points, "id int, seq_idx int, at long")
    want = {(r["id"], r["frag_id"], r["frag_end"]) for r in asof.lookup(df, frags, "at", "window").collect()}
    assert {(r["id"], r["frag_id"], r["frag_end"]) for r in asof.lookup(df, frags, "at", "merge").collect()} == want and len(want) == len(points)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        slim = frags.select("seq_idx", *asof.FOUND)
        sizes = [r["count"] for r in asof.merged_ranges(df, slim, "at").groupBy("part").count().collect()]
        assert len(sizes) == 4 and max(sizes) < 2 * sum(sizes) / 4
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    empty = df.filter("false")
    assert asof.lookup(empty, frags, "at", "merge").count() == 0
    assert asof.lookup(df, frags.filter("false"), "at", "merge").filter("frag_id is null").count() == len(points)


def test_aligner_digest_overhangs(spark):
    chunks = lambda seq: digest.chunked(genome(spark, [seq]))
    five = digest.aligner_digest(chunks("AAGATCAA"), compile_sites("^GATC_")).collect()
    assert [(r["frag_name"], r["bases"]) for r in five] == [("c0_0_0-_4+", "AAGATC"), ("c0_2_4-_0-", "GATCAA")]
    three = digest.aligner_digest(chunks("AACATGAA"), compile_sites("_CATG^")).collect()
    assert [(r["frag_name"], r["bases"]) for r in three] == [("c0_0_0-_4-", "AACATG"), ("c0_6_4+_0-", "CATGAA")]


def aligned(seq, sites):
    """The digest as one scan of a string."""
    at = [(0, 0, ""), (len(seq), 0, "")]
    for s in sorted(sites, key=lambda s: (s.pattern, s.loc)):
        low, high = sorted((s.loc, s.rev_loc))
        side = (s.loc < s.rev_loc) - (s.rev_loc < s.loc)
        at += [(m.start() + s.loc, side, m.group()[low:high]) for m in re.finditer(s.pattern, seq)]
    at.sort(key=lambda x: x[0])
    for (a, left, head), (b, right, tail) in zip(at, at[1:]):
        yield a, b, len(head), left < 0, len(tail), right > 0, (head if left < 0 else "") + seq[a:b] + (tail if right > 0 else "")


RUNS = ["TTAATTAATTAA" * 9, "GCGC" * 30 + "GCG" + "CGCG" * 9, "A" * 90 + "CAAA" * 20, "", "GA", "GATC", "gatcGATCNN", "GCGCGATCGCGATC" * 13, "C" * 70 + "GCGCGC" * 5 + "T" * 200]


@pytest.mark.parametrize("size", [3, 7, 64, 16384])
@pytest.mark.parametrize("spec", ["Arima_v2", "G_CG^C,A^AA_A", "^GCGNNNGCG_,NN^AA_NN,_CATG^"])
def test_unbroken_scan_in_chunks(spark, monkeypatch, size, spec):
    """Matches that overlap are taken from the left, across the edges of chunks and of blocks of 32 bases."""
    from chromaloom.operators import overhangs

    monkeypatch.setattr(overhangs, "BLOCK", 5)
    sites = compile_sites(spec)
    got = digest.aligner_digest(digest.chunked(genome(spark, RUNS), size), sites, size).collect()
    for i, seq in enumerate(RUNS):
        mine = [tuple(r)[2:8] + (r["bases"],) for r in got if r["seq_idx"] == i]
        assert sorted(mine) == sorted(aligned(seq, sites)), seq
        assert all(r["frag_name"].startswith(f"c{i}_{r['frag_start']}_") for r in got if r["seq_idx"] == i)


def test_no_row_holds_a_sequence(spark):
    plan = digest.aligner_digest(digest.chunked(genome(spark, ["GATC" * 100]), 64), SITES, 64)
    assert "seq#" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_which_sites_overlap_themselves():
    from chromaloom.operators.overhangs import overlaps_itself

    assert not any(overlaps_itself(s.pattern) for s in SITES)
    assert overlaps_itself("GCGC") and overlaps_itself("A[ACGT]A") and not overlaps_itself("GATC") and not overlaps_itself("A")


def test_wide_patterns(spark):
    """A pattern of 100 bases is an error where it would be lost, and found where chunks reach far enough."""
    from chromaloom.functions.sites import SiteError

    wide = compile_sites("^G" + "N" * 98 + "C_")
    seq = "A" * 40 + "G" + "T" * 98 + "C" + "A" * 60
    assert digest.reach_of(wide) == 99
    with pytest.raises(SiteError):
        digest.fragments(digest.chunked(genome(spark, [seq]), 50), wide)
    with pytest.raises(SiteError):
        digest.aligner_digest(digest.chunked(genome(spark, [seq]), 50), wide, 50)
    chunks = digest.chunked(genome(spark, [seq]), 50, 99)
    assert sorted(r["cut"] for r in digest.cuts(chunks, wide, 99).collect()) == [0, 40]
    assert sorted(r["frag_start"] for r in digest.aligner_digest(chunks, wide, 50, 99).collect()) == [0, 40]


def test_cache_key_ignores_order():
    assert digest.cache_key("/x/ref.fa", compile_sites("DpnII,MseI")) == digest.cache_key("/y/ref.fa", compile_sites("MseI,DpnII"))
    assert digest.cache_key("ref.fa", compile_sites("DpnII")) != digest.cache_key("ref.fa", compile_sites("MseI"))


def test_measured_aligner_digest_has_the_lengths_of_the_bases(spark):
    from chromaloom.functions.sites import compile_sites

    sites = compile_sites("Arima_v2")
    chunks = digest.chunked(genome(spark, ["AAGATCTTAAGACTCTTAAGATC" * 5, "", "CTAAGNNGATC"]), 16)
    whole = digest.aligner_digest(chunks, sites, 16)
    measured = digest.aligner_digest(chunks, sites, 16, measured=True)
    want = whole.selectExpr("frag_name", "frag_start", "frag_end", "front", "end", "cast(length(bases) as long) as length")
    assert sorted(map(str, measured.select(*want.columns).collect())) == sorted(map(str, want.collect())) and want.count() > 10


@pytest.mark.parametrize("block", [2, 4, 22])
def test_cuts_are_shuffled_as_arrays_of_blocks(spark, monkeypatch, block):
    """One row for each block of a sequence, whatever its cuts; the next cut comes from the array, not from a window over cuts."""
    monkeypatch.setattr(digest, "BLOCK", block)
    chunks = digest.chunked(genome(spark, CASES), 5)
    rows = digest.scanned(chunks, SITES).collect()
    assert len(rows) == len({(r["seq_idx"], r["block"]) for r in rows})
    for i, seq in enumerate(CASES):
        own = sorted((r for r in rows if r["seq_idx"] == i), key=lambda r: r["block"])
        assert [x for r in own for x in r["cuts"]] == brute_cuts(seq, SITES) and sum(r["bases"] for r in own) == len(seq)
        assert all(x >> block == r["block"] for r in own for x in r["cuts"])


def test_cuts_of_chunks_by_block():
    text, cut, start = np.array([0, 0, 1, 1]), np.array([3, 9, 12, 17]), np.array([0, 8, 16])
    of, block, cuts, offsets = digest._by_block(text, cut, start, 3)
    assert [(int(k), int(b), cuts[i:j].tolist()) for k, b, i, j in zip(of, block, offsets, offsets[1:])] == [(0, 0, [0, 3]), (0, 1, [9]), (1, 1, [12]), (1, 2, [17]), (2, 2, [])]


@pytest.mark.parametrize("group", [0, 1, 10])
def test_no_task_numbers_all_sequences(spark, monkeypatch, group):
    monkeypatch.setattr(digest, "GROUP", group)
    sizes = [(i, b, 1 + (i * 7 + b) % 5) for i in (0, 1, 2, 5, 6, 7, 40, 3000) for b in range(1 + i % 3)]
    found = digest._cuts_before(spark.createDataFrame(sizes, "seq_idx int, block long, n int"))
    assert {r["seq_idx"]: r["base"] for r in found.collect()} == {i: sum(n for j, _, n in sizes if j < i) for i, _, _ in sizes}
    windows = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in line]
    assert len(windows) == 2 and not any("windowspecdefinition(seq_idx#" in line for line in windows)
    monkeypatch.setattr(digest, "BLOCK", 2)
    rows = digest.fragments(digest.chunked(genome(spark, CASES), 5), SITES).collect()
    assert [(r["frag_id"], r["seq_idx"]) for r in sorted(rows, key=lambda r: (r["seq_idx"], r["frag_start"]))] == [(k, i) for k, i in enumerate(i for i, seq in enumerate(CASES) for _ in brute_cuts(seq, SITES))]
