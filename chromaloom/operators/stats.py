"""Summaries of reads, pairs and contacts, as long tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.alignments import bad_flags
from .tables import Workspace

# Labels of the summary rows, with class codes.
READ_ROWS = [
    ("invalid reference", "IR"), ("un-paired", "UP"), ("supplementary", "SP"), ("duplicate", "DP"), ("QC-failed", "QC"), ("secondary", "SE"),
    ("un-mapped", "UM"), ("mapping quality too low", "MQ"), ("too far from restriction site", "RS"), ("dumped", "DM"), ("good read", "good"),
]
PAIR_ROWS = [
    ("self-circle", "SC"), ("dangling-end", "DE"), ("same fragment and strand", "SS"), ("re-ligation", "RL"),
    ("valid_pairs ff", "FF"), ("valid_pairs fr", "FR"), ("valid_pairs rf", "RF"), ("valid_pairs rr", "RR"),
]
SEQUENCE_ROWS = [
    ("restriction sites", "n_sites", False, False), ("self-circle pairs", "SC", False, True), ("dangling-end pairs", "DE", False, True),
    ("same fragment and strand pairs", "SS", False, True), ("re-ligated pairs", "RL", False, True), ("total invalid", "invalid", True, True),
]
VALID, INVALID = ["FF", "FR", "RF", "RR"], ["SC", "DE", "SS", "RL"]
CLASS_ORDER = ["ff", "fr", "rf", "rr", "sc", "de", "ss", "rl"]


def _long(one: DataFrame, rows: list[tuple[Column, ...]], names: list[str]) -> DataFrame:
    """Rows of literals and columns from a table of one row (or one per key)."""
    keys = [c for c in one.columns if c == "name"]
    return one.select(*keys, F.inline(F.array(*[F.struct(*[c.alias(n) for c, n in zip(row, names)]) for row in rows])))


def read_summary(classified: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """type, counts, class: flags count in every class that holds, so rows do not add up to the reads.

    Records that ``resolve`` gave hold their pairs, which are then counted in the same pass.
    """
    counts = {code: F.count_if(holds) for code, holds in bad_flags(F.col("flag")).items()}
    counts |= {code: F.count_if(F.col("hc") == code) for code in ("IR", "MQ", "RS")}
    passed = F.col("hc").isNull() | F.col("hc").isin(*VALID, *INVALID, "DM")  # before and after pairing
    own = [(F.count("pair") * 2).alias("good")] if pairs is None else []
    one = classified.agg(*[c.alias(k) for k, c in counts.items()], F.count_if(passed).alias("passed"), *own)
    one = one if pairs is None else one.join(pairs.agg((F.count("*") * 2).alias("good")))
    one = one.withColumn("DM", F.col("passed") - F.col("good"))
    rows = [(F.lit(label), F.col(code), F.lit("valid_pairs" if code == "good" else "invalid")) for label, code in READ_ROWS]
    return _long(one, rows, ["type", "counts", "class"])


def pair_summary(pairs: DataFrame) -> DataFrame:
    one = pairs.agg(*[F.count_if(F.col("hc") == code).alias(code) for _, code in PAIR_ROWS])
    rows = [(F.lit(label), F.col(code), F.lit("valid_pairs" if code in VALID else "invalid")) for label, code in PAIR_ROWS]
    return _long(one, rows, ["type", "counts", "class"])


def valid_percentages(pairs: DataFrame) -> DataFrame:
    """hc, percent of valid pairs; null without any."""
    one = pairs.agg(*[F.count_if(F.col("hc") == code).alias(code) for code in VALID])
    total = sum((F.col(c) for c in VALID), F.lit(0))
    return _long(one, [(F.lit(c), F.try_divide(F.lit(100.0) * F.col(c), total)) for c in VALID], ["hc", "percent"])


def intra_inter(pairs: DataFrame) -> DataFrame:
    one = pairs.agg(*[F.count_if((F.col("hc") == c) & (F.col("intra") == k)).alias(f"{c}{k}") for c in VALID for k in (True, False)])
    rows = [(F.lit(c.lower()), F.lit("intra" if k else "inter"), F.col(f"{c}{k}")) for k in (True, False) for c in VALID]
    return _long(one, rows, ["class", "type", "count"])


def class_totals(summary: DataFrame) -> DataFrame:
    """Sum of counts of each class of a summary."""
    return summary.groupBy("class").agg(F.sum("counts").alias("counts"))


def invalid_per_sequence(pairs: DataFrame, sequences: DataFrame) -> DataFrame:
    """seq_idx, name and the invalid pairs of each class, by the sequence of the first read."""
    counts = pairs.filter(F.col("hc").isin(INVALID)).groupBy(F.col("r1_seq_idx").alias("seq_idx")).agg(*[F.count_if(F.col("hc") == c).alias(c) for c in INVALID])
    return sequences.select("seq_idx", "name").join(counts, "seq_idx", "left").fillna(0, INVALID)


def contact_matrix(pairs: DataFrame) -> DataFrame:
    """Sparse upper triangle: seq1 <= seq2, hc, count of valid pairs."""
    low, high = F.least("r1_seq_idx", "r2_seq_idx"), F.greatest("r1_seq_idx", "r2_seq_idx")
    return pairs.filter(F.col("hc").isin(VALID)).groupBy(low.alias("seq1"), high.alias("seq2"), "hc").agg(F.count("*").alias("count"))


def sequence_stats(pairs: DataFrame, sequences: DataFrame) -> DataFrame:
    """13 rows per sequence: name, statistic, count, type, total, pair."""
    wide = sequences.join(invalid_per_sequence(pairs, sequences).drop("name"), "seq_idx").withColumn("invalid", sum((F.col(c) for c in INVALID), F.lit(0)))
    number = lambda c: F.col(c).cast("double")
    rows = [(F.lit("length"), number("length"), F.lit("basic"), F.lit(False), F.lit(False))]
    for norm in (False, True):
        rows += [(F.lit(label), F.try_divide(number(c), number("length")) if norm else number(c), F.lit("norm count" if norm else "raw count"), F.lit(total), F.lit(pair)) for label, c, total, pair in SEQUENCE_ROWS]
    return _long(wide, rows, ["statistic", "count", "type", "total", "pair"])


def to_groups(contacts: DataFrame, sequences: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Contacts and sequences merged into scaffolds; groups: (seq_idx, group_idx, group_name)."""
    one = groups.select(F.col("seq_idx").alias("seq1"), F.col("group_idx").alias("g1"))
    two = groups.select(F.col("seq_idx").alias("seq2"), F.col("group_idx").alias("g2"))
    merged = contacts.join(one, "seq1").join(two, "seq2").groupBy(F.least("g1", "g2").alias("seq1"), F.greatest("g1", "g2").alias("seq2"), "hc").agg(F.sum("count").alias("count"))
    table = sequences.join(groups, "seq_idx").groupBy(F.col("group_idx").alias("seq_idx"), F.col("group_name").alias("name"))
    return merged, table.agg(F.sum("length").alias("length"), F.sum("n_sites").alias("n_sites"))


def valid_pairs_dense(contacts: DataFrame, sequences: DataFrame) -> DataFrame:
    """id1, id2, type, norm, count over the whole upper triangle, zeros included.

    Its size is the square of the number of sequences: for thousands of contigs merge them into
    scaffolds first (``to_groups``), or use the sparse ``contact_matrix``.
    """
    one = sequences.select(F.col("seq_idx").alias("seq1"), F.col("name").alias("id1"), F.col("length").alias("l1"))
    two = sequences.select(F.col("seq_idx").alias("seq2"), F.col("name").alias("id2"), F.col("length").alias("l2"))
    wide = contacts.groupBy("seq1", "seq2").agg(*[F.sum(F.when(F.col("hc") == c, F.col("count"))).alias(c) for c in VALID])
    every = one.join(two, F.col("seq1") <= F.col("seq2")).join(wide, ["seq1", "seq2"], "left").fillna(0, VALID)
    every = every.withColumn("total", sum((F.col(c) for c in VALID), F.lit(0)))
    rows = [F.struct(F.lit(c.lower()).alias("type"), F.lit(norm).alias("norm"), (F.try_divide(F.col(c).cast("double"), F.col("l1").cast("double") * F.col("l2")) if norm else F.col(c).cast("double")).alias("count")) for c in [*VALID, "total"] for norm in (False, True)]
    return every.select("id1", "id2", F.inline(F.array(*rows)))


def pair_count(dense: DataFrame, one: str, two: str, kind: str = "total", norm: bool = False) -> DataFrame:
    """The count of one pair of sequences, in either order."""
    either = F.col("id1").isin(one, two) & F.col("id2").isin(one, two) & ((F.col("id1") == F.col("id2")) == F.lit(one == two))
    return dense.filter(either & (F.col("type") == kind) & (F.col("norm") == norm)).select("count")


def inter_sequence_index(contacts: DataFrame, sequences: DataFrame) -> DataFrame:
    """name, index = genome length * contacts to others / (contacts * length); null without contacts."""
    out = contacts.filter("seq1 <> seq2").groupBy(F.col("seq2").alias("seq1"), F.col("seq1").alias("seq2")).agg(F.sum("count").alias("count"))
    both = contacts.groupBy("seq1", "seq2").agg(F.sum("count").alias("count")).unionByName(out)
    sums = both.groupBy(F.col("seq1").alias("seq_idx")).agg(F.sum("count").alias("n"), F.sum(F.when(F.col("seq1") != F.col("seq2"), F.col("count")).otherwise(0)).alias("ni"))
    genome = sequences.agg(F.sum("length").alias("genome"))
    table = sequences.select("seq_idx", "name", "length").join(sums, "seq_idx", "left").join(genome)
    index = F.try_divide(F.col("genome").cast("double") * F.col("ni"), F.col("n").cast("double") * F.col("length"))
    return table.select("name", index.alias("index"))


def site_distance_frame(pairs: DataFrame) -> DataFrame:
    """class, valid, dir, id, dis: both ends of every pair.

    Pairs are numbered by class in CLASS_ORDER, then by query name and record.  They are dealt out in ranges
    of this order, whose bounds are sampled, and written; the number is a place within the range plus a
    prefix sum over the ranges, so no class or prefix of names meets in one task.
    """
    cls = F.lower("hc")
    rank = F.array_position(F.array(*map(F.lit, CLASS_ORDER)), cls).cast("int")
    named = pairs.select(cls.alias("class"), rank.alias("_rank"), "qname", F.col("r1_line_no").alias("_line"), "r1_site_dist", "r2_site_dist", "r1_is_reverse", "r2_is_reverse")
    space = Workspace(pairs.sparkSession, "distances")
    slots = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = space.table(named, "named")  # the bounds are sampled from this table, so that pairs are made once
    dealt = space.table(named.repartitionByRange(slots, "_rank", "qname", "_line").withColumn("_range", F.spark_partition_id()), "dealt")
    ahead = dealt.groupBy("_range").agg(F.count("*").alias("_c"))
    ahead = ahead.select("_range", (F.sum("_c").over(W.orderBy("_range")) - F.col("_c")).alias("_base"))  # one row per range
    within = W.partitionBy("_range").orderBy("_rank", "qname", "_line")
    named = dealt.join(F.broadcast(ahead), "_range").withColumn("id", (F.col("_base") + F.row_number().over(within) - 1).cast("long"))
    direction = lambda r: F.when(F.col("class").isin("ss", "rl"), "UKN").when(F.col(f"{r}_is_reverse"), "R").otherwise("F")
    ends = F.array(*[F.struct(direction(r).alias("dir"), F.col(f"{r}_site_dist").alias("dis")) for r in ("r1", "r2")])
    return named.select("class", F.col("class").isin(*[c.lower() for c in VALID]).alias("valid"), "id", F.inline(ends))


def strand_distances(frame: DataFrame, valid: bool, direction: str) -> DataFrame:
    """Distances of one strand, of valid pairs or of self circles and dangling ends."""
    kind = F.col("valid") if valid else F.col("class").isin("sc", "de")
    return frame.filter(kind & (F.col("dir") == direction)).select("class", "id", "dis")


def separations(pairs: DataFrame, column: str = "pair_sep") -> DataFrame:
    """class, dis of valid pairs within a sequence."""
    return pairs.filter(F.col("intra") & F.col("hc").isin(VALID)).select(F.lower("hc").alias("class"), F.col(column).alias("dis"))


def genome_totals(sequences: DataFrame) -> DataFrame:
    return sequences.agg(F.count("*").alias("n_sequences"), F.sum("length").alias("total_length"))
