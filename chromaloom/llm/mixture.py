"""Mixing sources to target weights (operator 2).

Sources in code point order, null last, weigh ``WEIGHTS`` in turn and share the total number of
words; a target above ``EPOCHS`` times its source is clamped there and the excess is shared
again by weight.  The fixed point is a water level: with sources in the order of cap over weight,
a source takes min(cap, level * weight).  It is computed on the table of sources.

A source whose target is r times its size takes each document floor(r) times, and a seeded part
of its documents once more: documents in the order of md5(seed, doc_id), as long as the middle of
the document lies within the remaining words.  The order is cut with a histogram of the first
three hexadecimal digits; only documents of the one bucket per source that the cut falls in are
sorted, so no source meets in one task.

Defined results: null and wordless texts have size 0 and take 0; a null source is a source of
its own; a source without words has target 0.  Rows equal in doc_id, source and size are
interchangeable.  Extra columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import BROADCAST_ROWS, Workspace

WEIGHTS = (5, 2, 1)
EPOCHS = 3
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, target) from the table (source, source_size): one row per source.

    Its windows run over one row per source, whatever the number of documents.
    """
    rank = F.row_number().over(W.orderBy(F.col("source").isNull(), "source")) - 1
    weigh = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int")).cast("long")
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    order = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    return (
        sources.withColumn("weight", weigh).withColumn("cap", F.col("source_size") * epochs)
        .withColumn("total", F.sum("source_size").over(every))
        .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double")
                    / F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing)))
        # the first source in this order that the level leaves below its cap sets the level of all after it
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source", F.col("level").alias("v")))).over(every)["v"])
        .select("source", "source_size", F.when((F.col("cap") / F.col("weight")) <= F.col("level"), F.col("cap").cast("double")).otherwise(F.col("level") * F.col("weight")).alias("target"))
    )


def mix_sources(docs: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken.

    ``copies`` is how often the mix holds the document: repeat its row so often to build it.
    """
    space = Workspace(docs.sparkSession, "mix")
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    order = F.md5(F.concat(F.lit(seed + "|"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    slim = docs.select("doc_id", "source", size.alias("size"), order.alias("order"))
    slim = space.table(slim.withColumn("bucket", F.substring("order", 1, 3)), "slim")
    sums = space.table(slim.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "sums")
    plan = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, epochs)
    whole = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0))
    plan = plan.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = plan.withColumnRenamed("source", "_source")
    plan = space.table(plan, "plan")
    # Where each source's remaining words end: the last bucket that begins within them.
    running = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    begun = sums.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
    cut = begun.join(plan, F.col("source").eqNullSafe(F.col("_source"))).filter("before <= rest").groupBy("_source")
    cut = cut.agg(F.max_by(F.struct("bucket", "before"), "bucket").alias("cut"))
    plan = space.table(plan.join(cut.withColumnRenamed("_source", "s"), F.col("_source").eqNullSafe(F.col("s"))).select(plan["*"], "cut.bucket", "cut.before"), "cuts")
    plan = plan.withColumnRenamed("bucket", "cut")
    small = F.broadcast(plan) if plan.count() <= BROADCAST_ROWS else plan
    told = slim.join(small, slim["source"].eqNullSafe(plan["_source"]))
    inner = W.partitionBy("source").orderBy("order", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    edge = told.filter("bucket = cut").withColumn("into", F.col("before") + F.coalesce(F.sum("size").over(inner), F.lit(0)) + F.col("size") / 2)
    edge = edge.withColumn("extra", (F.col("into") <= F.col("rest")).cast("long")).drop("into")
    out = edge.unionByName(told.filter("bucket <> cut").withColumn("extra", (F.col("bucket") < F.col("cut")).cast("long")))
    copies = (F.col("whole") + F.when(F.col("size") > 0, F.col("extra")).otherwise(0)).cast("long")
    return out.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"))


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         md5('mix-1|' || coalesce(doc_id::varchar, '')) as o
  from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (select source, source_size, 3 * source_size as cap,
             ([5, 2, 1])[((row_number() over (order by source is null, encode(source)) - 1) % 3 + 1)::int] as weight,
             sum(source_size) over () as total from s),
v as (select *, (total - coalesce(sum(cap) over (q rows between unbounded preceding and 1 preceding), 0))::double
               / sum(weight) over (q rows between current row and unbounded following) as lv,
             row_number() over q as rn
      from w window q as (order by cap::double / weight, source is null, encode(source))),
l as (select arg_min(lv, rn) filter (where lv <= cap::double / weight) as level from v),
p as (select source, source_size,
             case when cap::double / weight <= level then cap::double else level * weight end as target
      from v, l),
x as (select *, case when source_size = 0 then 0 else floor(target / source_size) end as whole from p),
j as (select d.doc_id, d.size, x.source_size, x.target, x.whole::bigint as whole,
             x.target - x.whole * x.source_size as rest,
             coalesce(sum(d.size) over (partition by d.source order by d.o, d.doc_id, d.size
                      rows between unbounded preceding and 1 preceding), 0) as before
      from d join x on d.source is not distinct from x.source)
select doc_id, size, source_size, target,
       (size * (whole + case when before + size / 2 <= rest then 1 else 0 end))::bigint as taken
from j
"""
