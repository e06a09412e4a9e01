import pytest

from chromaloom.functions import sites

from chromaloom.functions.sites import ENZYMES, RestrictionSite, SiteError, compile_sites, expand, read_catalogue, reverse_complement, scan_patterns


def listed(spec, **kw):
    return sorted((s.pattern, s.loc, s.rev_loc) for s in compile_sites(spec, **kw))


@pytest.mark.parametrize(
    ("spec", "want"),
    [
        ("^GATC", [("GATC", 0, 4)]),
        ("G^AATTC", [("GAATTC", 1, 5)]),
        ("gatc^", [("GATC", 4, 0)]),
        ("GA^TC", [("GATC", 2, 2)]),
        ("DNASE", []),
        ("omni-c", []),
        ("G^ANT_C", [("GA[ACGT]TC", 1, 4)]),
        ("DpnII, Sau3AI,MboI", [("GATC", 0, 4)]),
        ("Arima_v2", [("CT[ACGT]AG", 1, 4), ("GATC", 0, 4), ("GA[ACGT]TC", 1, 4), ("TTAA", 1, 3)]),
    ],
)
def test_specifications(spec, want):
    assert listed(spec) == sorted(want)


def test_not_palindromic_gives_both_strands():
    assert listed("AC^GGA_T") == [("ACGGAT", 2, 5), ("ATCCGT", 1, 4)]


def test_compat_keeps_the_off_by_one():
    assert len(listed("GATC^")) == 1
    assert len(listed("GATC^", compat=True)) == 2


@pytest.mark.parametrize("spec", ["GATC", "AC^GGAT", "dpnii", "nothing", ""])
def test_errors(spec):
    with pytest.raises(SiteError):
        compile_sites(spec)


def test_cut_outside_of_the_site():
    with pytest.raises(SiteError):
        RestrictionSite("GATC", 5, 0)


def test_helpers():
    assert reverse_complement("G^ANT_C") == "G^ANT_C"
    assert expand("RNY") == "[AG][ACGT][CT]"
    assert scan_patterns(frozenset()) == []
    assert len(scan_patterns(compile_sites("Arima_v2"))) == 6
    assert all(compile_sites(e) for e in ENZYMES)


# Literal expectations, written out from the vendors' pages: enzyme, pattern, forward and reverse cut.
LITERAL = [
    ("EcoRI", "GAATTC", 1, 5), ("HindIII", "AAGCTT", 1, 5), ("NcoI", "CCATGG", 1, 5), ("DpnII", "GATC", 0, 4), ("NlaIII", "CATG", 4, 0), ("MseI", "TTAA", 1, 3),
    ("HinfI", "GA[ACGT]TC", 1, 4), ("DdeI", "CT[ACGT]AG", 1, 4), ("HincII", "GT[CT][AG]AC", 3, 3), ("StyI", "CC[AT][AT]GG", 1, 5), ("KpnI", "GGTACC", 5, 1), ("ApoI", "[AG]AATT[CT]", 1, 5),
    ("NotI", "GCGGCCGC", 2, 6), ("SmaI", "CCCGGG", 3, 3), ("PacI", "TTAATTAA", 5, 3), ("BstEII", "GGT[ACGT]ACC", 1, 6), ("AccI", "GT[AC][GT]AC", 2, 4), ("Sau96I", "GG[ACGT]CC", 1, 4),
]


@pytest.mark.parametrize(("enzyme", "pattern", "forward", "reverse"), LITERAL)
def test_enzymes_as_the_vendors_list_them(enzyme, pattern, forward, reverse):
    assert listed(enzyme) == [(pattern, forward, reverse)]


def test_codes_as_the_standard_lists_them():
    assert expand("ACGTWSMKRYBDHVN") == "ACGT[AT][CG][AC][GT][AG][CT][CGT][AGT][ACT][ACG][ACGT]"
    assert reverse_complement("ACGTWSMKRYBDHVN^") == "_NBDHVRYMKSWACGT"


def test_enzyme_that_cuts_twice():
    any_ = "[ACGT]"
    core = "CGA" + any_ * 6 + "TGC"
    assert ("BcgI" in ENZYMES) and len(listed("BcgI")) == 4
    assert (any_ * 12 + core, 2, 0) in listed("BcgI") and (core + any_ * 12, 24, 22) in listed("BcgI")


def test_catalogue_of_a_table():
    table = """# name site length cuts blunt c1 c2 c3 c4
EcoRI\tGAATTC\t6\t2\t0\t1\t5\t0\t0
EcoRV\tGATATC\t6\t2\t1\t3\t3\t0\t0
MboI\tGATC\t4\t2\t0\t-1\t4\t0\t0
BcgI\tCGANNNNNNTGC\t12\t4\t0\t-11\t-13\t24\t22
FokI\tGGATG\t5\t2\t0\t14\t18\t0\t0
Unknown\tACGT\t4\t0\t0\t0\t0\t0\t0
"""
    found = read_catalogue(table.splitlines())
    assert found == {"EcoRI": "G^AATT_C", "EcoRV": "GAT^_ATC", "MboI": "^GATC_", "BcgI": ENZYMES["BcgI"], "FokI": "GGATGNNNNNNNNN^NNNN_"}
    assert compile_sites("FokI", catalogue=found) and compile_sites("BcgI", catalogue=found) == compile_sites("BcgI")
    with pytest.raises(SiteError):
        compile_sites("FokI")


def test_columns_of_sites_like_the_compiler(spark):
    from pyspark.sql import functions as F

    every = sorted({x for v in sites.ENZYMES.values() for x in v.split(",")})
    df = spark.createDataFrame([(x,) for x in every], "site string")
    for r in df.select("site", sites.reverse_complement_of(F.col("site")).alias("r"), sites.pattern_of(F.col("site")).alias("p")).collect():
        assert (r["r"], r["p"]) == (sites.reverse_complement(r["site"]), sites.expand(r["site"]))
