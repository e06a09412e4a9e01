"""Pairing of good reads and classification of pairs.

Within a query name, in record order, a read waits for one of the other side; a later one of its
own side takes its place, and a pair clears both.  So pairs form where the side changes, unless
the last read before the change was itself consumed by the change before.  In runs of equal
sides that can only happen to runs of one read, which makes it a question of parity: window
functions over one ordering decide it, without collecting the reads of a name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..functions.alignments import unclipped_five_prime
from .tables import Workspace

CARRIED = ["line_no", "seq_idx", "read_start", "frag_id", "frag_start", "frag_next", "site_dist", "is_reverse"]
#: What the class of a pair depends on.
DECIDING = ["seq_idx", "read_start", "frag_id", "frag_start", "frag_next", "is_reverse"]


def mated(good: DataFrame) -> DataFrame:
    """Adds ``mate`` (the record of the read's partner, or null) and ``closes`` (the later of two)."""
    return _mated(good, W.partitionBy("qname").orderBy("line_no"))


def _mated(good: DataFrame, order, carried: list[str] = CARRIED) -> DataFrame:
    past = order.rowsBetween(W.unboundedPreceding, -1)
    other = F.struct(*carried, "is_read1")
    out = good.withColumn("_first", F.coalesce(F.lag("is_read1").over(order) != F.col("is_read1"), F.lit(True)))
    out = out.withColumn("_last", F.coalesce(F.lead("_first").over(order), F.lit(True)))
    out = out.withColumn("_run", F.sum(F.col("_first").cast("int")).over(order.rowsBetween(W.unboundedPreceding, 0)))
    # The latest earlier run of two or more reads: its last read always waits when the side changes.
    reset = F.max(F.when(~F.col("_first") | ~F.col("_last"), F.col("_run"))).over(past)
    since = F.col("_run") - 1 - F.coalesce(reset, F.lit(0))
    out = out.withColumn("closes", F.col("_first") & F.when(reset.isNull(), since % 2 == 1).otherwise(since % 2 == 0))
    opens = F.coalesce(F.lead("closes").over(order), F.lit(False)) & F.col("_last")
    mate = F.when(F.col("closes"), F.lag(other).over(order)).when(opens, F.lead(other).over(order))
    return out.withColumn("mate", mate).drop("_first", "_last", "_run")


def _settled(df: DataFrame, keep: tuple[str, ...], *columns) -> DataFrame:
    """A projection that the optimizer does not merge with the next, which would repeat its expressions.

    The columns ``keep`` stay outside of it, so that those not asked for are not read.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*columns))))


def classify_pairs(mates: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per read with a mate that closes: qname, hc, intra, pair_sep, frag_sep, and CARRIED of both reads.

    r1_* is read 1, unless both reads lie on one sequence and read 2 begins before it.  ``keep``
    names columns of the read itself to keep.
    """
    return _classified(mates.filter("closes").filter(F.col("is_read1") != F.col("mate.is_read1")), keep)


def _classified(pairs: DataFrame, keep: tuple[str, ...], carried: list[str] = CARRIED) -> DataFrame:
    mine = F.col("is_read1")
    ends = [F.when(mine == first, F.col(c)).otherwise(F.col(f"mate.{c}")).alias(f"{r}_{c}") for r, first in (("a", True), ("b", False)) for c in carried]
    pairs = _settled(pairs, keep, F.col("qname"), *ends)
    intra = F.col("a_seq_idx") == F.col("b_seq_idx")
    swap = intra & (F.col("a_read_start") > F.col("b_read_start"))
    pairs = pairs.withColumns({"intra": intra, "_swap": swap})
    turned = [F.when(F.col("_swap"), F.col(f"{y}_{c}")).otherwise(F.col(f"{x}_{c}")).alias(f"{r}_{c}") for r, x, y in (("r1", "a", "b"), ("r2", "b", "a")) for c in carried]
    pairs = _settled(pairs, keep, F.col("qname"), F.col("intra"), *turned)
    sep = F.col("r2_read_start") - F.col("r1_read_start")
    frag_sep = F.when(F.col("r1_frag_id").isNull(), sep).when(F.col("r1_frag_next").isNull(), F.lit(0).cast("long")).otherwise(F.col("r2_frag_start") - F.col("r1_frag_next"))
    rev1, rev2 = F.col("r1_is_reverse"), F.col("r2_is_reverse")
    hc = (
        F.when(F.col("r1_frag_id") == F.col("r2_frag_id"), F.when(rev1 & ~rev2, "SC").when(~rev1 & rev2, "DE").otherwise("SS"))
        .when(F.col("intra") & (F.col("r1_frag_next") == F.col("r2_frag_start")), "RL")
        .otherwise(F.concat(F.when(rev1, "R").otherwise("F"), F.when(rev2, "R").otherwise("F")))
    )
    both = [f"{r}_{c}" for r in ("r1", "r2") for c in carried]
    return pairs.select(*keep, "qname", hc.alias("hc"), "intra", F.when(F.col("intra"), sep).alias("pair_sep"), F.when(F.col("intra"), frag_sep).alias("frag_sep"), *both)


def pair_reads(good: DataFrame) -> DataFrame:
    return classify_pairs(mated(good))


def dumped(good: DataFrame) -> DataFrame:
    """Good reads without a mate."""
    return mated(good).filter("mate is null").drop("mate", "closes")


def resolve(classified: DataFrame, details: bool = True) -> DataFrame:
    """``classified`` with hc set for good reads, too (their pair's class, or DM), and ``pair``.

    ``pair`` holds the pair, as pair_reads gives it, in the record that closes it, and is null in
    all others: ``pairs_of`` reads it back.  One shuffle on (query name, good or not), of the columns that are
    asked for; write the result once, and everything else is derived from it.  Without ``details`` there is
    no ``pair``, and only what classes depend on is shuffled beside the columns that are asked for.
    """
    carried = CARRIED if details else DECIDING
    strand = {"is_reverse": F.col("flag").bitwiseAND(0x10) != 0, "is_read1": F.col("flag").bitwiseAND(0x40) != 0}
    named = classified.withColumns(strand | {"_good": F.col("hc").isNull()})
    mates = _mated(named, W.partitionBy("qname", "_good").orderBy("line_no"), carried)
    # Reads without a mate are paired with themselves, so that one expression serves all; the result is not used.
    lone = F.col("mate").isNull() | ~F.col("_good")
    mates = mates.withColumn("_lone", lone).withColumn("mate", F.when(lone, F.struct(*carried, (~F.col("is_read1")).alias("is_read1"))).otherwise(F.col("mate")))
    own = {f"_own_{c}": F.col(c) for c in classified.columns}
    kept = (*own, "_lone", "closes")
    done = _classified(mates.withColumns(own), kept, carried)
    pair = [F.when(~F.col("_lone") & F.col("closes"), F.struct(*[c for c in done.columns if c not in kept])).alias("pair")] if details else []
    hc = F.coalesce("_own_hc", F.when(F.col("_lone"), "DM").otherwise(F.col("hc")))
    columns = [hc.alias("hc") if c == "hc" else F.col(f"_own_{c}").alias(c) for c in classified.columns]
    return done.select(*columns, *pair)


def unpaired(rejected: DataFrame, resolved: DataFrame) -> DataFrame:
    """Records that no pair can hold, in the form of ``resolve``."""
    return rejected.withColumn("pair", F.lit(None).cast(resolved.schema["pair"].dataType)).select(*resolved.columns)


def pairs_of(resolved: DataFrame) -> DataFrame:
    """The pairs that ``resolve`` found."""
    return resolved.filter("pair is not null").select("pair.*")


def five_end(records: DataFrame) -> DataFrame:
    """The alignment of each read whose 5' end is aligned (X9); flag loses the supplementary bit.

    Alignments of one (qname, is_read1) in record order: a single one, or one of two, with an
    aligned 5' end stays; of all others the first stays, marked unmapped.
    """
    flag = F.col("flag")
    forward = flag.bitwiseAND(16) == 0
    five = (flag.bitwiseAND(4) == 0) & F.when(forward, F.col("cigar").rlike("^[0-9]*M")).otherwise(F.col("cigar").rlike("M$"))
    named = records.withColumn("_side", flag.bitwiseAND(64) != 0).withColumn("_five", F.coalesce(five, F.lit(False)).cast("int"))
    by = W.partitionBy("qname", "_side")
    named = named.withColumn("_n", F.count("*").over(by)).withColumn("_fives", F.sum("_five").over(by)).withColumn("_at", F.row_number().over(by.orderBy("line_no")))
    whole = (F.col("_n") <= 2) & (F.col("_fives") == 1)
    kept = named.filter(F.when(whole, F.col("_five") == 1).otherwise(F.col("_at") == 1))
    flag = F.when(whole, F.col("flag")).otherwise(F.col("flag").bitwiseOR(4)).bitwiseAND(~2048)
    return kept.withColumn("flag", flag.cast("int")).drop("_side", "_five", "_n", "_fives", "_at")


#: A name with coordinates on a flow cell: what comes before x is the tile.
PLACE = r"^(.*):([0-9]{1,9}):([0-9]{1,9})(?:[#/].*)?$"
OPTICAL = 100


@F.arrow_udf(LongType())
def _quality_sum(shown: pa.Array) -> pa.Array:
    """Sum of the qualities of 15 and more of each text of qualities; 0 of '*'."""
    text = pc.fill_null(shown.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1] if len(text) else np.zeros(1, np.int64)
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    value = data.astype(np.int64) - 33
    upto = np.append(0, np.cumsum(np.where(value >= 15, value, 0)))
    sums = np.diff(upto[offsets - offsets[0]])
    return pa.array(np.where(pc.equal(text, b"*").to_numpy(zero_copy_only=False), 0, sums), pa.int64())


def templates_of(reads: DataFrame) -> DataFrame:
    """(qname, quality, low, high, single) of every template: both 5' ends in order, and the sum of base qualities.

    5' ends count clipped bases; qualities of 15 and more count, from ``rest``, if there is such a column.
    """
    primary = reads.filter(F.col("flag").bitwiseAND(0x904) == 0)
    end = F.struct("rname", unclipped_five_prime(F.col("pos"), F.col("flag"), F.col("cigar")).alias("at"), (F.col("flag").bitwiseAND(16) != 0).alias("rev"))
    shown = F.coalesce(F.get(F.split("rest", "\t"), 4), F.lit("*")) if "rest" in reads.columns else F.lit("*")
    ends = primary.select("qname", _quality_sum(shown).alias("quality"), (F.col("flag").bitwiseAND(64) != 0).alias("one"), end.alias("end"))
    found = ends.groupBy("qname").agg(F.min(F.when(F.col("one"), F.col("end"))).alias("a"), F.min(F.when(~F.col("one"), F.col("end"))).alias("b"), F.sum("quality").alias("quality"))
    return found.select("qname", "quality", F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"), (F.col("a").isNull() | F.col("b").isNull()).alias("single"))


def duplicates(reads: DataFrame, optical: int = OPTICAL) -> DataFrame:
    """(qname, original, dt) of the templates whose 5' ends and strands are those of another that stays.

    The template with the highest sum of qualities stays; ties go to the least name.  ``dt`` is SQ (a copy
    made in sequencing) if another template of the set, the one that stays included, lies on the same tile
    within ``optical`` in x and in y, by the coordinates in the names; LB (made in the library) otherwise.
    Places are met by cells of a grid with sides of ``optical`` + 1.  Templates that share a cell are near each other, which
    a count tells; only those alone in their cell are looked for around it, by a semi-join on (set, tile, cell) without pairs.
    """
    space = Workspace(reads.sparkSession, "duplicates")
    templates = space.table(templates_of(reads), "templates")
    best = templates.groupBy(F.col("low").alias("_low"), F.col("high").alias("_high"), F.col("single").alias("_single"))
    best = best.agg(F.min(F.struct(-F.col("quality"), "qname")).alias("best"), F.count("*").alias("n")).filter("n > 1")
    same = templates.join(best, (F.col("low") == F.col("_low")) & (F.col("high") == F.col("_high")) & (F.col("single") == F.col("_single")))
    same = same.select("qname", F.col("best.qname").alias("original"))
    part = lambda k: F.regexp_extract("qname", PLACE, k)
    cell = lambda c: F.floor(F.col(c) / (optical + 1))
    members = same.select("qname", "original", part(1).alias("tile"), part(2).try_cast("long").alias("x"), part(3).try_cast("long").alias("y"))
    members = space.table(members.withColumns({"cx": cell("x"), "cy": cell("y")}), "members")
    placed = members.filter("cx is not null and cy is not null")
    cells = space.table(placed.groupBy("original", "tile", "cx", "cy").agg(F.count("*").alias("n"), F.min("qname").alias("qname"), F.min("x").alias("x"), F.min("y").alias("y")), "cells")
    shared = F.col("n") > 1
    around = F.explode(F.array(*[F.struct((F.col("cx") + i).alias("cx"), (F.col("cy") + j).alias("cy")) for i in (0, -1, 1) for j in (0, -1, 1) if i or j]))
    alone = cells.filter(~shared & (F.col("qname") != F.col("original"))).select("qname", "original", "tile", "x", "y", around.alias("c"))
    alone = alone.select("qname", "original", "tile", "x", "y", "c.cx", "c.cy").alias("l")
    near = (F.abs(F.col("l.x") - F.col("r.x")) <= optical) & (F.abs(F.col("l.y") - F.col("r.y")) <= optical)
    equal = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("original", "tile", "cx", "cy")]
    found = alone.join(placed.alias("r"), [*equal, near], "left_semi").select("qname").distinct()
    # what is near another, as cells and as templates alone in theirs
    near_cells = cells.filter(shared).select("original", "tile", "cx", "cy", F.lit(True).alias("_near"))
    near_cells = near_cells.unionByName(cells.join(found, "qname", "left_semi").select("original", "tile", "cx", "cy", F.lit(True).alias("_near")))
    out = members.filter("qname <> original").join(near_cells, ["original", "tile", "cx", "cy"], "left")
    return out.select("qname", "original", F.when(F.col("_near"), "SQ").otherwise("LB").alias("dt"))


def mark_duplicates(reads: DataFrame, supplementary: bool = True, optical: int = OPTICAL) -> DataFrame:
    """Sets bit 0x400 on the primary records of duplicates, and on their supplementary ones unless told not to.

    If there is a column ``rest``, marked records get a tag dt:Z with the kind of their duplicate.
    """
    found = duplicates(reads, optical).select("qname", "dt")
    out = reads.join(found, "qname", "left")
    flag = F.col("flag")
    kind = flag.bitwiseAND(0x904)
    marked = F.col("dt").isNotNull() & ((kind == 0) | (F.lit(supplementary) & (kind == 0x800)))
    new = {"flag": F.when(marked, flag.bitwiseOR(0x400)).otherwise(flag).cast("int")}
    if "rest" in reads.columns:
        new["rest"] = F.when(marked, F.concat_ws("\t", "rest", F.concat(F.lit("dt:Z:"), "dt"))).otherwise(F.col("rest"))
    return out.select(*[new[c].alias(c) if c in new else F.col(c) for c in reads.columns])
