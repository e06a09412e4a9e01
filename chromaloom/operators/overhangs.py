"""Digest with filled overhangs, as a reference for aligners: an unbroken scan, in parallel over chunks.

Matches of a site do not overlap: which of them count depends on all before.  What a chunk needs to know of the past is one
number, the carry: how many of its first bases a match begun earlier still covers (0 to width - 1).
So a chunk is a small function from carry in to carry out.  Functions are composed over the
chunks of a block, blocks over a sequence, and the carries handed back down; then every chunk picks its matches on its
own.  Sites that cannot overlap themselves skip all this.  No sequence is a row or a task of its own.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.sites import RestrictionSite, SiteError
from .tables import Workspace

CHUNK = 16_384
BLOCK = 22  # functions are composed, and cuts linked, in blocks of 2^BLOCK bases
BROADCAST_ROWS = 250_000


def letter_sets(pattern: str) -> list[frozenset[str]]:
    """The letters that each place of a pattern accepts."""
    return [frozenset(part.strip("[]")) for part in re.findall(r"\[[^\]]*\]|.", pattern)]


def overlaps_itself(pattern: str) -> bool:
    """Whether two matches can share bases."""
    places = letter_sets(pattern)
    return any(all(a & b for a, b in zip(places[k:], places)) for k in range(1, len(places)))


def match_starts(data: np.ndarray, begin: int, places: list[np.ndarray]) -> np.ndarray:
    """Where matches begin before ``begin``, those that overlap included."""
    count = min(begin, len(data) - len(places) + 1)
    if count <= 0:
        return np.zeros(0, np.int64)
    found = np.ones(count, bool)
    for k, table in enumerate(places):
        found &= table[data[k : k + count]]
    return np.flatnonzero(found)


def _following(at: np.ndarray, width: int) -> np.ndarray:
    """For each match, the first that does not overlap it."""
    return np.searchsorted(at, at + width, "left")


def carry_function(at: np.ndarray, width: int, size: int) -> np.ndarray:
    """Carry out of a chunk of ``size`` bases with matches ``at``, for every carry in from 0 to width - 1."""
    then, out = _following(at, width), np.zeros(len(at), np.int64)
    for i in range(len(at) - 1, -1, -1):
        out[i] = out[then[i]] if then[i] < len(at) else max(0, at[i] + width - size)
    carries = np.arange(width)
    first = np.searchsorted(at, carries, "left")
    passed = np.maximum(carries - size, 0)
    return np.where(first < len(at), out[np.minimum(first, len(at) - 1)], passed) if len(at) else passed


def picked(at: np.ndarray, width: int, carry: int) -> np.ndarray:
    """The matches that a scan from the left takes if it comes in with this carry."""
    then, i, taken = _following(at, width), int(np.searchsorted(at, carry, "left")), []
    while i < len(at):
        taken.append(i)
        i = int(then[i])
    return np.array(taken, np.int64)


def _scanned(chunks: DataFrame, order: list[RestrictionSite]) -> DataFrame:
    """Per chunk and site: matches (``at``), their overhangs, and the carry function of sites that overlap themselves."""
    letters = [letter_sets(s.pattern) for s in order]
    tables = [[np.isin(np.arange(256), [ord(x) for x in place]) for place in places] for places in letters]
    bounds = [sorted((s.loc, s.rev_loc)) for s in order]
    wide = [overlaps_itself(s.pattern) for s in order]

    def scan(batches):
        for batch in batches:
            seq, start, site, at, hang, function = [], [], [], [], [], []
            for idx, begin, bases, after in zip(*[batch.column(x).to_pylist() for x in ("seq_idx", "chunk_start", "bases", "after")]):
                text = bases + after
                data = np.frombuffer(text.encode("latin-1", "replace"), np.uint8)
                for k, places in enumerate(tables):
                    found = match_starts(data, len(bases), places)
                    if not len(found) and not wide[k]:
                        continue
                    low, high = bounds[k]
                    seq.append(idx)
                    start.append(begin)
                    site.append(k)
                    at.append(found)
                    hang.append([text[x + low : x + high] for x in found.tolist()])
                    function.append(carry_function(found, len(places), len(bases)) if wide[k] else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(seq, pa.int32()), pa.array(start, pa.int64()), pa.array(site, pa.int32()), pa.array(at, pa.list_(pa.int32())), pa.array(hang, pa.list_(pa.string())), pa.array(function, pa.list_(pa.int32()))],
                names=["seq_idx", "chunk_start", "site", "at", "hang", "function"],
            )

    dealt = chunks.repartition(int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")), "seq_idx", "chunk_start")
    return dealt.select("seq_idx", "chunk_start", "bases", "after").mapInArrow(scan, "seq_idx int, chunk_start long, site int, at array<int>, hang array<string>, function array<int>")


def _composed(functions: Column) -> Column:
    """Composition of an array of structs with a field ``function``, first to last."""
    same = F.sequence(F.lit(0), F.size(functions[0]["function"]) - 1)
    return F.aggregate(functions, same, lambda g, x: F.transform(g, lambda c: F.get(x["function"], c)))


def _carries(functions: Column, first: Column) -> Column:
    """The carry into each element of such an array, if ``first`` comes into the first."""
    start = F.struct(first.cast("int").alias("carry"), F.array().cast("array<int>").alias("into"))
    step = lambda s, x: F.struct(F.get(x["function"], s["carry"]).alias("carry"), F.array_append(s["into"], s["carry"]).alias("into"))
    return F.aggregate(functions, start, step, lambda s: s["into"])


def carries(functions: DataFrame, space: Workspace) -> DataFrame:
    """(seq_idx, site, chunk_start, carry) of a table (seq_idx, site, chunk_start, function): a prefix scan in two levels."""
    listed = functions.withColumn("block", F.shiftright("chunk_start", BLOCK)).groupBy("seq_idx", "site", "block")
    blocks = space.table(listed.agg(F.sort_array(F.collect_list(F.struct("chunk_start", "function"))).alias("chunks")), "blocks")
    whole = blocks.select("seq_idx", "site", F.struct("block", _composed(F.col("chunks")).alias("function")).alias("b"))
    whole = whole.groupBy("seq_idx", "site").agg(F.sort_array(F.collect_list("b")).alias("bs"))  # some hundred blocks at most
    into = F.arrays_zip(F.transform("bs", lambda b: b["block"]).alias("block"), _carries(F.col("bs"), F.lit(0)).alias("carry"))
    into = whole.select("seq_idx", "site", F.inline(into).alias("block", "first"))
    met = blocks.join(into, ["seq_idx", "site", "block"])
    each = F.arrays_zip(F.transform("chunks", lambda x: x["chunk_start"]).alias("a"), _carries(F.col("chunks"), F.col("first")).alias("b"))
    return met.select("seq_idx", "site", F.inline(each).alias("chunk_start", "carry"))


def _chosen(found: DataFrame, order: list[RestrictionSite]) -> DataFrame:
    """(seq_idx, chunk_start, site, at, hang) of sites that overlap themselves, by the carry of their chunk."""
    widths = [s.width for s in order]

    def choose(batches):
        for batch in batches:
            rows = [batch.column(x).to_pylist() for x in ("site", "at", "hang", "carry")]
            at, hang = [], []
            for site, places, hangs, carry in zip(*rows):
                keep = picked(np.array(places, np.int64), widths[site], carry).tolist()
                at.append([places[i] for i in keep])
                hang.append([hangs[i] for i in keep])
            yield pa.RecordBatch.from_arrays(
                [batch.column("seq_idx"), batch.column("chunk_start"), batch.column("site"), pa.array(at, pa.list_(pa.int32())), pa.array(hang, pa.list_(pa.string()))], names=["seq_idx", "chunk_start", "site", "at", "hang"]
            )

    return found.mapInArrow(choose, "seq_idx int, chunk_start long, site int, at array<int>, hang array<string>")


def _linked(cuts: DataFrame, space: Workspace) -> DataFrame:
    """Every cut with the one that follows it in its sequence, as ``then``; the last has none and is left out."""
    one = F.struct("spot", "o", "side", "hang")
    cuts = space.table(cuts.withColumn("block", F.shiftright("spot", BLOCK)), "cuts")
    firsts = cuts.groupBy("seq_idx", "block").agg(F.min(one).alias("first"))
    firsts = space.table(firsts.select("seq_idx", "block", F.lead("first").over(W.partitionBy("seq_idx").orderBy("block")).alias("beyond")), "firsts")
    side = F.broadcast(firsts) if firsts.count() <= BROADCAST_ROWS else firsts
    within = W.partitionBy("seq_idx", "block").orderBy("spot", "o")
    out = cuts.withColumn("then", F.lead(one).over(within)).join(side, ["seq_idx", "block"])
    return out.withColumn("then", F.coalesce("then", "beyond")).filter("then is not null").drop("block", "beyond")


def aligner_digest(chunks: DataFrame, sites: frozenset[RestrictionSite], size: int = CHUNK, reach: int = 63, measured: bool = False) -> DataFrame:
    """Fragments with filled overhangs; matches are case-sensitive and do not overlap within a site.

    ``chunks``: (seq_idx, name, chunk_start, bases, after) in chunks of ``size`` bases, as ``chunked`` gives them.  Columns: seq_idx,
    name, frag_start, frag_end, front, front_fwd, end, end_fwd, frag_name, bases.  Cuts at one place are in
    the order start, end, sites by pattern; a fragment between them is empty.  If ``measured``, the length of
    the bases stands in their place, and fragments do not meet the chunks again.  Patterns wider than ``reach`` + 1 are an error.
    """
    if any(s.width > reach + 1 for s in sites):
        raise SiteError(f"a site is wider than the {reach} bases that chunks reach ahead and one more")
    space = Workspace(chunks.sparkSession, "aligner")
    order = sorted(sites, key=lambda s: (s.pattern, s.loc))
    chunks = space.table(chunks, "chunks")
    columns = ["seq_idx", "chunk_start", "site", "at", "hang"]
    found = space.table(_scanned(chunks, order), "found")
    taken = found.filter("function is null").select(*columns)
    if any(overlaps_itself(s.pattern) for s in order):
        wide = found.filter("function is not null")
        into = carries(wide.select("seq_idx", "site", "chunk_start", "function"), space)
        taken = taken.unionByName(_chosen(wide.select(*columns).join(into, ["seq_idx", "site", "chunk_start"]), order))
    cuts = taken.select("seq_idx", "chunk_start", "site", F.inline(F.arrays_zip("at", "hang")).alias("at", "hang"))
    # five-prime overhangs count as 1, three-prime as -1
    site = F.array(*[F.struct(F.lit(s.loc).alias("loc"), F.lit((s.loc < s.rev_loc) - (s.rev_loc < s.loc)).alias("side")) for s in order]) if order else F.array(F.struct(F.lit(0).alias("loc"), F.lit(0).alias("side")))
    cuts = cuts.withColumn("s", F.get(site, F.col("site")))
    cuts = cuts.select("seq_idx", (F.col("chunk_start") + F.col("at") + F.col("s.loc")).cast("long").alias("spot"), (F.col("site") + 2).alias("o"), F.col("s.side").alias("side"), "hang")
    names = space.table(chunks.groupBy("seq_idx", "name").agg(F.sum(F.length("bases")).cast("long").alias("length")), "names")
    end = lambda spot, o: F.struct(spot.cast("long").alias("spot"), F.lit(o).alias("o"), F.lit(0).alias("side"), F.lit("").alias("hang"))
    ends = names.select("seq_idx", F.inline(F.array(end(F.lit(0), 0), end(F.col("length"), 1))))
    frags = _linked(cuts.unionByName(ends), space)
    small = F.broadcast(names) if names.count() <= BROADCAST_ROWS else names
    front, back = F.col("side") < 0, F.col("then.side") > 0
    sign = lambda c: F.when(c, "+").otherwise("-")
    text = lambda x: x.cast("string")
    shown = F.concat("name", F.lit("_"), text(F.col("spot")), F.lit("_"), text(F.length("hang")), sign(front), F.lit("_"), text(F.length("then.hang")), sign(back))

    def told(whole: DataFrame, last: Column) -> DataFrame:
        return whole.join(small.drop("length"), "seq_idx").select(
            "seq_idx", "name", F.col("spot").alias("frag_start"), F.col("then.spot").alias("frag_end"), F.length("hang").cast("int").alias("front"), front.alias("front_fwd"),
            F.length("then.hang").cast("int").alias("end"), back.alias("end_fwd"), shown.alias("frag_name"), last,
        )

    if measured:
        filled = F.when(front, F.length("hang")).otherwise(0) + F.when(back, F.length("then.hang")).otherwise(0)
        return told(frags, (F.col("then.spot") - F.col("spot") + filled).cast("long").alias("length"))
    # Bases: a fragment meets the chunks it lies in; pieces are put together only where there are several.
    last = F.greatest(F.col("then.spot") - 1, F.col("spot"))
    frags = frags.withColumn("low", F.floor(F.col("spot") / size)).withColumn("high", F.floor(last / size))
    parts = frags.withColumn("chunk", F.explode(F.sequence("low", "high")))
    raw = chunks.select("seq_idx", F.floor(F.col("chunk_start") / size).alias("chunk"), F.encode("bases", "ISO-8859-1").alias("raw"))
    met = parts.join(raw, ["seq_idx", "chunk"], "left")
    begin = F.greatest(F.col("spot") - F.col("chunk") * size, F.lit(0))
    many = F.greatest(F.least(F.col("then.spot") - F.col("chunk") * size, F.lit(size)) - begin, F.lit(0))
    piece = F.coalesce(F.decode(F.substring("raw", (begin + 1).cast("int"), many.cast("int")), "ISO-8859-1"), F.lit(""))
    keys = ["seq_idx", "spot", "o", "side", "hang", "then"]
    met = met.select(*keys, "chunk", piece.alias("piece"), (F.col("low") == F.col("high")).alias("alone"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "piece"))), lambda x: x["piece"]), "")
    several = met.filter("not alone").groupBy(*keys).agg(joined.alias("piece"))
    whole = met.filter("alone").select(*keys, "piece").unionByName(several)
    bases = F.concat(F.when(front, F.col("hang")).otherwise(""), "piece", F.when(back, F.col("then.hang")).otherwise(""))
    return told(whole, bases.alias("bases"))
