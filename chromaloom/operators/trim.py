"""Clipping of reads that were aligned to single fragments, to the part inside the fragment.

Fragment names end in ``_<front><+/->_<end><+/->``: the lengths of the overhangs and whether they
are filled on the forward strand.  Everything is folded over the CIGAR operations of one read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NAME = r"^(.*)_([0-9]+)_([0-9]+)([+-])_([0-9]+)([+-])$"


def parse_fragment_names(header: DataFrame) -> DataFrame:
    """(rname, length, front, front_fwd, end, end_fwd) of a table (rname, length)."""
    part = lambda i: F.regexp_extract("rname", NAME, i)
    return header.filter(F.col("rname").rlike(NAME)).select(
        "rname", "length", part(3).cast("long").alias("front"), (part(4) == "+").alias("front_fwd"), part(5).cast("long").alias("end"), (part(6) == "+").alias("end_fwd")
    )


def let(value: Column, then) -> Column:
    return F.get(F.transform(F.array(value), then), 0)


def _operations(cigar: Column) -> Column:
    number = F.regexp_extract_all(cigar, F.lit("([0-9]*)[MIDNSHPX=]"), F.lit(1))
    kind = F.regexp_extract_all(cigar, F.lit("[0-9]*([MIDNSHPX=])"), F.lit(1))
    return F.zip_with(number, kind, lambda n, k: F.struct(F.when(n == "", 1).otherwise(n.cast("long")).cast("long").alias("n"), k.alias("k")))


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is computed once per row: the optimizer does not copy it to where it is used."""
    return df.select("*", F.inline(F.array(F.struct(value.alias(name)))))


def trim(reads: DataFrame, frags: DataFrame) -> DataFrame:
    """``reads`` (with seq and qual) clipped to their fragment of ``frags`` (as parse_fragment_names gives them)."""
    fields = [F.col(c) for c in HELD]
    held = frags.select(F.col("rname").alias("_r"), F.struct(*fields).alias("_held"))
    return clip(reads.join(held, F.col("rname") == F.col("_r"), "left").drop("_r"))


#: What ``clip`` needs of a fragment.
HELD = ["length", "front", "front_fwd", "end", "end_fwd"]


def clip(reads: DataFrame) -> DataFrame:
    """Reads that carry their fragment in a struct ``_held`` (or null), clipped to it; those without a base left are dropped.

    Reads of unknown fragments, at position 0 or without a CIGAR pass unchanged.  ``pos`` is not
    rewritten.  Primary alignments only are meant: filter flag & 0x900 = 0 first.
    """
    held = lambda c: F.col(f"_held.{c}")
    zero = F.lit(0).cast("long")
    above = lambda a, b: F.greatest(a - b, zero)
    reverse = F.col("flag").bitwiseAND(16) != 0
    front = F.when(reverse == held("front_fwd"), zero).otherwise(held("front").cast("long"))
    end = F.when(reverse == held("end_fwd"), zero).otherwise(held("end").cast("long"))
    # Lengths of operations before the first that consumes the reference.
    lead = lambda ops: F.aggregate(
        ops, F.struct(zero.alias("sum"), F.lit(False).alias("hit")),
        lambda s, o: F.when(s["hit"] | o["k"].isin("M", "D", "N", "=", "X"), F.struct(s["sum"].alias("sum"), F.lit(True).alias("hit"))).otherwise(F.struct((s["sum"] + o["n"]).alias("sum"), F.lit(False).alias("hit"))),
        lambda s: s["sum"],
    )
    out = _once(reads, "_ops", _operations(F.col("cigar"))).withColumn("_front", front).withColumn("_end", end)
    out = _once(out, "_skip", above(lead(F.col("_ops")) + F.col("_front"), F.col("pos") - 1))
    out = out.withColumn("_at", F.when(F.col("_skip") > 0, zero).otherwise(F.col("pos") - 1 - F.col("_front")))
    out = out.withColumn("_keep", above(above(above(held("length"), F.col("_front")), F.col("_end")), F.col("_at")))

    def step(s: Column, o: Column) -> Column:
        query = o["k"].isin("M", "I", "S", "=", "X")
        cut = F.least(s["skip"], o["n"])
        left, skip = o["n"] - cut, s["skip"] - cut
        # an operation that is used up by the skipping, with more to skip, takes nothing of the rest
        taken = F.when(skip > 0, zero).otherwise(F.least(left, s["keep"]))
        lost = F.when(skip > 0, zero).otherwise(left - taken)
        return F.struct(
            skip.alias("skip"), (s["keep"] - taken).alias("keep"),
            (s["head"] + F.when(query, cut).otherwise(zero)).alias("head"), (s["tail"] + F.when(query, lost).otherwise(zero)).alias("tail"),
            F.concat(s["cigar"], F.when(taken > 0, F.concat(taken.cast("string"), o["k"])).otherwise(F.lit(""))).alias("cigar"),
        )

    start = F.struct(F.col("_skip").alias("skip"), F.col("_keep").alias("keep"), zero.alias("head"), zero.alias("tail"), F.lit("").alias("cigar"))
    out = _once(out, "_clip", F.aggregate("_ops", start, step))
    known = F.coalesce(F.col("_held").isNotNull() & (F.col("pos") > 0) & (F.col("cigar") != "*"), F.lit(False))
    left = F.length("seq") - F.col("_clip.head") - F.col("_clip.tail")
    out = out.filter(~known | ((F.col("_keep") > 0) & (left > 0)))
    part = lambda c: F.when(known, F.substr(F.col(c), (F.col("_clip.head") + 1).cast("int"), left.cast("int"))).otherwise(F.col(c))
    new = {"cigar": F.when(known, F.col("_clip.cigar")).otherwise(F.col("cigar")), "seq": part("seq"), "qual": part("qual")}
    return out.select(*[new[c].alias(c) if c in new else F.col(c) for c in reads.columns if c != "_held"])
