"""Backward as-of lookup: for each point, the interval that holds it.

Intervals of one key tile a range; a point belongs to the one with the greatest start not above
it.  Four strategies give the same rows:

* ``bin`` (default): intervals are listed under every bin of 2^shift positions they overlap, so
  the lookup is an equality join on (key, bin) with a range test.  Broadcast if the binned table
  is small enough, else shuffled on (key, bin), which spreads one long sequence over many tasks;
* ``merge``: both sides in ranges of (key, position, salt) with the same sampled bounds, each merged in one pass; a
  range takes the interval it begins in from the ranges before it.  Neither a key nor a position is a task: points at one
  place are split by their salt;
* ``window``: union of both sides and the last interval seen, per key; for keys that one task can
  sort (contigs), not for chromosomes with a large share of all points;
* ``broadcast``: sorted starts are sent to workers for binary search, after a check of their size.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from .tables import Workspace

#: Most rows of a table that is broadcast.
BROADCAST_ROWS = 500_000
SHIFT = 12


def binned(fragments: DataFrame, shift: int = SHIFT) -> DataFrame:
    """Fragments, once per bin they overlap; the last of a sequence is in one bin more at least."""
    last = F.when(F.col("frag_next").isNull(), F.greatest(F.col("frag_end"), F.col("frag_start"))).otherwise(F.col("frag_next") - 1)
    bins = F.sequence(F.shiftright("frag_start", shift), F.greatest(F.shiftright(last, shift), F.shiftright("frag_start", shift)))
    return fragments.withColumn("bin", F.explode(bins))


FOUND = ["frag_id", "frag_start", "frag_next", "frag_end"]


def _merger(points: list[str]):
    """Sorted rows of both sides to points with their interval; and, as the last row, the interval that the range ends in.

    ``open`` marks points before the first interval of the range, ``edge`` that last row.
    """
    inner = ["_f_seq", *[f"_f_{c}" for c in FOUND]]

    def merge(batches):
        part, carry, kinds = TaskContext.get().partitionId(), None, None
        for batch in batches:
            kinds = batch.schema
            begins = batch.column("_side").to_numpy() == 0
            table = pa.Table.from_batches([batch])
            pool = table.filter(pa.array(begins)).select(inner)
            pool = pool if carry is None else pa.concat_tables([carry, pool])
            at = (np.cumsum(begins) - 1 + (carry is not None))[~begins]
            mine = table.filter(pa.array(~begins)).select(["seq_idx", *points])
            seen = at >= 0
            found = pool.take(pa.array(at, mask=~seen))
            same = pc.fill_null(pc.equal(found.column("_f_seq"), mine.column("seq_idx")), False)
            found = pool.take(pa.array(at, mask=~same.to_numpy() | ~seen))
            columns = [*[mine.column(c) for c in points], *[found.column(c) for c in inner], pa.array(np.full(len(at), part, np.int32)), pa.array(~seen), pa.array(np.zeros(len(at), bool))]
            yield from pa.Table.from_arrays(columns, names=[*points, *inner, "part", "open", "edge"]).combine_chunks().to_batches()
            if pool.num_rows:
                carry = pool.slice(pool.num_rows - 1).combine_chunks()
        if carry is not None:
            none = [pa.nulls(1, kinds.field(c).type) for c in points]
            last = [*none, *[carry.column(c) for c in inner], pa.array([part], pa.int32()), pa.array([False]), pa.array([True])]
            yield from pa.Table.from_arrays(last, names=[*points, *inner, "part", "open", "edge"]).combine_chunks().to_batches()

    return merge


def merged_ranges(points: DataFrame, slim: DataFrame, at: str) -> DataFrame:
    """A written table of the merged ranges: ``points`` under p_*, the interval under _f_*, part, open, edge."""
    space = Workspace(points.sparkSession, "merge")
    named = [f"p_{c}" for c in points.columns]
    frag = [F.col("seq_idx").alias("_f_seq"), *[F.col(c).alias(f"_f_{c}") for c in FOUND]]
    left = slim.select("seq_idx", F.col("frag_start").cast("long").alias("_pos"), F.lit(0).alias("_side"), F.lit(0).cast("long").alias("_salt"), *frag)
    right = points.select("seq_idx", F.col(at).cast("long").alias("_pos"), F.lit(1).alias("_side"), F.xxhash64(*points.columns).alias("_salt"), *[F.col(c).alias(f"p_{c}") for c in points.columns])
    both = left.unionByName(right, allowMissingColumns=True)
    order = ["seq_idx", "_pos", "_side", "_salt"]
    count = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = both.repartitionByRange(count, *order).sortWithinPartitions(*order)
    optional = [StructField(f.name, f.dataType, True) for c in [*named, "_f_seq", *[f"_f_{x}" for x in FOUND]] for f in [both.schema[c]]]
    shape = StructType([*optional, StructField("part", IntegerType()), StructField("open", BooleanType()), StructField("edge", BooleanType())])
    return space.table(ranged.mapInArrow(_merger(named), shape), "merged")


def _merge(points: DataFrame, slim: DataFrame, at: str) -> DataFrame:
    merged = merged_ranges(points, slim, at)
    inner = ["_f_seq", *[f"_f_{c}" for c in FOUND]]
    ranges = merged.groupBy("part").agg(F.max(F.when(F.col("edge"), F.struct(*inner))).alias("last"))  # one row per range
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    ranges = ranges.select(F.col("part").alias("_part"), F.last("last", ignorenulls=True).over(before).alias("_before"))
    rows = merged.filter("not edge")
    sure = rows.filter("not open").select(*[F.col(f"p_{c}").alias(c) for c in points.columns], *[F.col(f"_f_{c}").alias(c) for c in FOUND])
    early = rows.filter("open").join(F.broadcast(ranges), F.col("part") == F.col("_part"), "left")
    own = F.col("_before._f_seq") == F.col("p_seq_idx")
    early = early.select(*[F.col(f"p_{c}").alias(c) for c in points.columns], *[F.when(own, F.col(f"_before._f_{c}")).alias(c) for c in FOUND])
    return sure.unionByName(early)


def lookup(points: DataFrame, fragments: DataFrame, at: str, strategy: str = "bin", shift: int = SHIFT, length: str | None = None) -> DataFrame:
    """``points`` (with seq_idx and the column ``at``) left-joined to their fragment.

    Adds frag_id, frag_start, frag_next and frag_end; null where no fragment holds the point, that is
    below the first start or with an unknown seq_idx.  Points beyond the end of a sequence belong to its last fragment.
    ``length`` names a column of the points with the length of their sequence, which saves ``bin`` a join for it.
    """
    slim = fragments.select("seq_idx", "frag_id", "frag_start", "frag_next", "frag_end")
    if strategy == "bin":
        # Points past the end fall in the bin of the end; only their lookup key is clamped.
        table = binned(slim, shift)
        # rows of the binned table: one per fragment and one per edge of a bin
        size = slim.agg(F.count("*") + F.sum(F.col("frag_end") - F.col("frag_start")) / (1 << shift)).first()[0] or 0
        small = F.broadcast(table) if size <= BROADCAST_ROWS else table
        if length is None:
            ends = slim.filter("frag_next is null").select(F.col("seq_idx").alias("_s"), F.shiftright(F.greatest("frag_end", "frag_start"), shift).alias("_top"))
            small_ends = F.broadcast(ends) if ends.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else ends
            keyed = points.join(small_ends, F.col("seq_idx") == F.col("_s"), "left")
        else:
            keyed = points.withColumn("_top", F.shiftright(length, shift))
        keyed = keyed.withColumn("_bin", F.least(F.shiftright(at, shift), F.col("_top")))
        held = (keyed[at] >= small["frag_start"]) & (small["frag_next"].isNull() | (keyed[at] < small["frag_next"]))
        out = keyed.join(small, (keyed["seq_idx"] == small["seq_idx"]) & (keyed["_bin"] == small["bin"]) & held, "left")
        return out.select(*[keyed[c] for c in points.columns], "frag_id", "frag_start", "frag_next", "frag_end")
    if strategy == "merge":
        return _merge(points, slim, at)
    if strategy == "window":
        frag = F.struct("frag_id", "frag_start", "frag_next", "frag_end")
        left = slim.select("seq_idx", F.col("frag_start").alias("_pos"), F.lit(0).alias("_side"), frag.alias("_frag"), F.lit(None).alias("_point"))
        right = points.select("seq_idx", F.col(at).alias("_pos"), F.lit(1).alias("_side"), F.lit(None).alias("_frag"), F.struct(*points.columns).alias("_point"))
        left = left.withColumn("_point", F.lit(None).cast(right.schema["_point"].dataType))
        right = right.withColumn("_frag", F.lit(None).cast(left.schema["_frag"].dataType))
        order = W.partitionBy("seq_idx").orderBy("_pos", "_side").rowsBetween(W.unboundedPreceding, 0)
        both = left.unionByName(right).withColumn("_found", F.last("_frag", ignorenulls=True).over(order)).filter("_side = 1")
        return both.select("_point.*", "_found.frag_id", "_found.frag_start", "_found.frag_next", "_found.frag_end")
    if strategy == "broadcast":
        if slim.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
            return lookup(points, fragments, at, "bin", shift, length)
        table = slim.orderBy("seq_idx", "frag_start").toPandas()
        starts = points.sparkSession.sparkContext.broadcast(
            {s: (g["frag_start"].to_numpy(), g["frag_id"].to_numpy()) for s, g in table.groupby("seq_idx")}
        )

        @F.pandas_udf("long")
        def find(seq: pd.Series, pos: pd.Series) -> pd.Series:
            out = pd.Series([None] * len(seq), dtype="Int64", index=seq.index)
            for s, rows in pos.dropna().groupby(seq):
                if s in starts.value:
                    begin, ids = starts.value[s]
                    i = np.searchsorted(begin, rows.to_numpy(), "right") - 1
                    out.loc[rows.index[i >= 0]] = ids[i[i >= 0]]
            return out

        named = points.withColumn("_id", find(F.col("seq_idx"), F.col(at)))
        frags = F.broadcast(slim.drop("seq_idx"))
        out = named.join(frags, named["_id"] == frags["frag_id"], "left")
        return out.select(*points.columns, "frag_id", "frag_start", "frag_next", "frag_end")
    raise ValueError(f"no strategy {strategy}")
