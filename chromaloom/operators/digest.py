"""In-silico digestion of a genome: cuts, fragments and their statistics.

The genome is a table ``seq_idx, name, chunk_start, bases, after`` of chunks; ``after`` holds the
bases that follow the chunk, as many as a pattern can reach over.  A chunk finds the matches that
begin in it, so no match is lost or found twice at an edge.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.sites import RestrictionSite, SiteError, scan_patterns
from .overhangs import CHUNK, aligner_digest
from .tables import Workspace

__all__ = ["CHUNK", "aligner_digest"]

REACH = 63  # bases of `after`; a pattern has one base more at most
SCANNED = 1 << 20  # bases that are scanned at once, about
BLOCK = 22  # cuts are numbered in blocks of 2^BLOCK bases
GROUP = 10  # sequences are numbered in groups of 2^GROUP
BROADCAST_ROWS = 250_000


def reach_of(sites: frozenset[RestrictionSite]) -> int:
    """Bases behind a chunk that these sites need."""
    return max([REACH, *(s.width - 1 for s in sites)])


def chunked(genome: DataFrame, size: int = CHUNK, reach: int = REACH) -> DataFrame:
    """(seq_idx, name, chunk_start, bases, after) of a table (seq_idx, name, seq); ``reach`` bases are in ``after``."""

    def cut(batches):
        for batch in batches:
            rows = [[], [], [], [], []]
            for idx, name, seq in zip(*[batch.column(x).to_pylist() for x in ("seq_idx", "name", "seq")]):
                seq = seq or ""
                for at in range(0, max(len(seq), 1), size):
                    for column, value in zip(rows, (idx, name, at, seq[at : at + size], seq[at + size : at + size + reach])):
                        column.append(value)
                if len(rows[0]) >= 1024:
                    yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.string()), pa.array(rows[4], pa.string())], names=["seq_idx", "name", "chunk_start", "bases", "after"])
                    rows = [[], [], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.string()), pa.array(rows[4], pa.string())], names=["seq_idx", "name", "chunk_start", "bases", "after"])

    return genome.select("seq_idx", "name", "seq").mapInArrow(cut, "seq_idx int, name string, chunk_start long, bases string, after string")


def _tables(pattern: str) -> list[np.ndarray]:
    """For each place of a pattern, which bytes it accepts, in either case."""
    out = []
    for part in re.findall(r"\[[^\]]*\]|.", pattern):
        table = np.zeros(256, bool)
        letters = part.strip("[]")
        table[list((letters.upper() + letters.lower()).encode())] = True
        out.append(table)
    return out


def _matches(data: np.ndarray, patterns: list[tuple[list[np.ndarray], int]]):
    """For each pattern, the offsets of its matches and its cut; bytes are looked up once per set of accepted ones."""
    looked_up = {}

    def accepted(table: np.ndarray) -> np.ndarray:
        key = table.tobytes()
        if key not in looked_up:
            looked_up[key] = table[data]
        return looked_up[key]

    for places, loc in patterns:
        count = len(data) - len(places) + 1
        if count > 0:
            match = accepted(places[0])[:count].copy()
            for k, table in enumerate(places[1:], 1):
                match &= accepted(table)[k : k + count]
            yield np.flatnonzero(match), loc


def find_all(data: np.ndarray, begin: int, patterns: list[tuple[list[np.ndarray], int]]) -> np.ndarray:
    """Cut offsets of every match, overlapping ones included, that begins before ``begin``."""
    found = [at[at < begin] + loc for at, loc in _matches(data, patterns)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def find_each(texts: list[bytes], begins: np.ndarray, patterns: list[tuple[list[np.ndarray], int]]) -> tuple[np.ndarray, np.ndarray]:
    """The same of many texts at once: numbers of texts, and cut offsets in them.

    Texts are scanned as one, with a byte between them that no pattern accepts.
    """
    data = np.frombuffer(b"\0".join(texts), np.uint8)
    starts = np.cumsum([0, *[len(x) + 1 for x in texts[:-1]]])
    which, cut = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at, loc in _matches(data, patterns):
        text = np.searchsorted(starts, at, "right") - 1
        inner = at - starts[text]
        own = inner < begins[text]
        which.append(text[own])
        cut.append(inner[own] + loc)
    text, inner = np.concatenate(which), np.concatenate(cut)
    reach = int(inner.max(initial=0)) + 1
    return np.divmod(np.unique(text * reach + inner), reach)


def scanned(chunks: DataFrame, sites: frozenset[RestrictionSite], reach: int = REACH) -> DataFrame:
    """(seq_idx, name, block, cuts, bases): the distinct cuts of every block, ascending, and the bases of the chunks that begin in it.

    Chunks are dealt out evenly before they are scanned, whatever files they came from.  ``reach`` is that of
    the chunks; a pattern that is wider would be lost where chunks meet, and is an error.  A chunk gives one row for each
    block that its cuts lie in, so that cuts are shuffled as arrays; what matches found twice in it is found out per block.
    """
    if reach_of(sites) > reach:
        raise SiteError(f"sites of {reach_of(sites) + 1} bases need chunks that reach {reach_of(sites)} bases ahead, not {reach}")
    patterns, shift = [(_tables(s.pattern), s.loc) for s in scan_patterns(sites)], BLOCK

    def scan(batches):
        for batch in batches:
            rows = list(zip(*[batch.column(x).to_pylist() for x in ("seq_idx", "name", "chunk_start", "bases", "after")]))
            if not rows:
                continue
            upto = np.cumsum([len(r[3]) for r in rows]) // SCANNED
            for part in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(upto)) + 1):
                seq, names, start, bases, after = zip(*[rows[k] for k in part])
                size, start = np.array([len(x) for x in bases], np.int64), np.array(start, np.int64)
                text, cut = find_each([(x + y).encode("latin-1", "replace") for x, y in zip(bases, after)], size, patterns)
                of, row, cuts, offsets = _by_block(text, cut + start[text], start, shift)
                held = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(cuts, pa.int64()))
                own = row == start[of] >> shift
                columns = [pa.array(seq, pa.int32()).take(pa.array(of)), pa.array(names, pa.string()).take(pa.array(of)), pa.array(row), held, pa.array(np.where(own, size[of], 0))]
                yield pa.RecordBatch.from_arrays(columns, names=["seq_idx", "name", "block", "cuts", "bases"])

    # a fixed number of tasks: by size alone, adaptive execution would join them for their few bytes
    dealt = chunks.repartition(int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")), "seq_idx", "chunk_start")
    found = dealt.mapInArrow(scan, "seq_idx int, name string, block long, cuts array<long>, bases long").groupBy("seq_idx", "name", "block")
    return found.agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("cuts")))).alias("cuts"), F.sum("bases").alias("bases"))


def _by_block(text: np.ndarray, cut: np.ndarray, start: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cuts of chunks in rows of (chunk, block): the rows' chunks and blocks, all cuts in their order, and where each row's begin and end.

    Every chunk has a row for the block it begins in; a sequence's first has the cut 0.
    """
    first, every = np.flatnonzero(start == 0), np.arange(len(start))
    text, cut = np.concatenate([text, first]), np.concatenate([cut, np.zeros(len(first), np.int64)])
    order = np.lexsort((cut, text))
    text, cut = text[order], cut[order]
    ahead = (cut >> shift) - (start[text] >> shift)  # blocks from the chunk's own
    width = int(ahead.max(initial=0)) + 1
    code = text * width + ahead
    rows = np.union1d(code, every * width)
    of, step = np.divmod(rows, width)
    return of, (start[of] >> shift) + step, cut, np.append(np.searchsorted(code, rows), len(code))


def cuts(chunks: DataFrame, sites: frozenset[RestrictionSite], reach: int = REACH) -> DataFrame:
    """Distinct (seq_idx, cut), the start 0 of every sequence included."""
    return scanned(chunks, sites, reach).select("seq_idx", F.explode("cuts").alias("cut"))


def lengths(chunks: DataFrame) -> DataFrame:
    """(seq_idx, name, length) of every sequence."""
    return chunks.groupBy("seq_idx", "name").agg(F.sum(F.length("bases")).cast("long").alias("length"))


def _cuts_before(blocks: DataFrame) -> DataFrame:
    """(seq_idx, base): the cuts in all sequences before each, by prefix sums within groups of sequences and over the groups."""
    per = blocks.groupBy("seq_idx").agg(F.sum("n").alias("cuts")).withColumn("_group", F.shiftright("seq_idx", GROUP))
    groups = per.groupBy("_group").agg(F.sum("cuts").alias("all"))  # one row for 2^GROUP sequences
    groups = groups.withColumn("ahead", F.sum("all").over(W.orderBy("_group")) - F.col("all")).drop("all")
    inner = F.sum("cuts").over(W.partitionBy("_group").orderBy("seq_idx")) - F.col("cuts")
    return per.withColumn("inner", inner).join(groups, "_group").select("seq_idx", (F.col("ahead") + F.col("inner")).alias("base"))


def fragments(chunks: DataFrame, sites: frozenset[RestrictionSite], reach: int = REACH) -> DataFrame:
    """frag_id, seq_idx, name, frag_start, frag_next (null for the last), frag_end.

    Written as a table: one scan of the genome.  Cuts are numbered by their places in the arrays of blocks; the ids
    add prefix sums over the blocks and the sequences, and the next cut of a block's last is the first of the next
    block, so no window runs over a whole chromosome or over all sequences, and none over cuts.
    """
    space = Workspace(chunks.sparkSession, "digest")
    found = scanned(chunks, sites, reach).withColumns({"n": F.size("cuts"), "first": F.get("cuts", F.lit(0))})
    found = space.table(found, "cuts")
    sizes = found.groupBy("seq_idx").agg(F.sum("bases").alias("length"))
    # One row per block: a chromosome has some hundred.
    blocks = found.filter("n > 0").select("seq_idx", "block", "n", "first")
    per = _cuts_before(blocks)
    order = W.partitionBy("seq_idx").orderBy("block")
    blocks = blocks.withColumn("then", F.lead("first").over(order)).withColumn("inner", F.sum("n").over(order) - F.col("n"))
    blocks = space.table(blocks.join(per, "seq_idx").join(sizes, "seq_idx").select("seq_idx", "block", "then", (F.col("base") + F.col("inner")).alias("before"), "length"), "blocks")
    side = F.broadcast(blocks) if blocks.count() <= BROADCAST_ROWS else blocks
    out = found.filter("n > 0").select("seq_idx", "name", "block", "cuts", "n").join(side, ["seq_idx", "block"])
    out = out.withColumn("next", F.concat(F.slice("cuts", F.lit(2), F.col("n")), F.array("then")))
    out = out.select("seq_idx", "name", "before", "length", F.posexplode(F.arrays_zip("cuts", "next")).alias("_n", "cut"))
    out = out.select(
        (F.col("before") + F.col("_n")).cast("long").alias("frag_id"), "seq_idx", "name",
        F.col("cut.cuts").alias("frag_start"), F.col("cut.next").alias("frag_next"), F.coalesce("cut.next", "length").alias("frag_end"),
    )
    out = space.table(out, "fragments")
    space.drop("cuts", "blocks")
    return out


def sequence_table(chunks: DataFrame, frags: DataFrame | None) -> DataFrame:
    """seq_idx, name, length, n_sites (fragments but one; 0 without a digest)."""
    if frags is None:
        return lengths(chunks).withColumn("n_sites", F.lit(0).cast("long"))
    return frags.groupBy("seq_idx", "name").agg(F.max("frag_end").alias("length"), (F.count("*") - 1).alias("n_sites"))


def site_summary(sequences: DataFrame) -> DataFrame:
    """Sequences, sites, mean sites per sequence and bases per site, of the whole genome."""
    total = sequences.agg(F.count("*").alias("n_sequences"), F.sum("n_sites").alias("n_sites"), F.sum("length").alias("bases"))
    return total.select("n_sequences", "n_sites", "bases", F.try_divide("n_sites", "n_sequences").alias("mean_sites"), F.try_divide("bases", "n_sites").alias("bases_per_site"))


def cache_key(reference: str, sites: frozenset[RestrictionSite]) -> str:
    """Name of a digest kept on disk: depends on the reference's base name and the sites, not their order."""
    parts = [reference.rsplit("/", 1)[-1], *(f"{s.pattern},{s.loc},{s.rev_loc}" for s in sites)]
    return f"{sum(int(hashlib.sha256(x.encode()).hexdigest(), 16) for x in parts) % 2**64:016x}"
