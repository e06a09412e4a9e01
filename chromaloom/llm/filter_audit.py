"""Audit of how filters interact under every order of application (operator 11).

One pass over whole texts gives each document a mask with a bit per filter that it fails; masks
are counted per part before anything else, so all that follows depends on parts and masks, not on
documents.  In long form every mask meets every step of every order; a running bit-or over the
steps before tells whether the document is gone already.  Joined to the counted cells,
conditional sums give each step's figures, and a window over (part, filter) what a filter removes in all orders.

Filters of the query: A fewer than 200 words; B distinct words under half of the words; C more
than 2 % of the code points are ``A-Z``; D one of ``#$%&*|`` occurs; E the text equals that of a smaller doc_id.

Defined results: a null text counts as empty, so it fails A, and E if a smaller doc_id has no text either.
A null source is the part "".  A null doc_id is no original and no copy for E and has no labels.  Repeated rows count as
rows; rows of one doc_id are no copies of each other.  Of several labels of a doc_id any 1 counts.  Extra
columns are ignored.  An empty table gives no row.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import Workspace, arrow_text, join_checked, mix, parts_of, pieces, separators, words_of

FILTERS = "ABCDE"
MIN_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 2
PIECE = 1 << 18

_INSIDE = separators()
_CAPITAL = ~separators(bytes(range(65, 91)))
_SIGN = ~separators(b"#$%&*|")
_COUNTS = ("words", "distinct", "capitals", "points", "signs")


def _sums(table: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(table))
    return total[ends[1:]] - total[ends[:-1]]


def _measure(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The _COUNTS of rows (distinct words left at 0), and row and hash of every word."""
    out = np.zeros((len(_COUNTS), len(ends) - 1), np.int64)
    _, row, word = words_of(data, ends, _INSIDE)
    out[0] = np.bincount(row, minlength=len(ends) - 1)
    out[2], out[3], out[4] = _sums(_CAPITAL[data], ends), _sums((data & 0xC0) != 0x80, ends), _sums(_SIGN[data], ends)
    return out, row, word


def _measure_long(text: bytes) -> np.ndarray:
    """The _COUNTS of one long text, part by part; only hashes of its distinct words are kept."""
    out, known, fresh = np.zeros(len(_COUNTS), np.int64), np.zeros(0, np.uint64), []
    for part in parts_of(text, PIECE):
        counts, _, word = _measure(np.frombuffer(part, np.uint8), np.array([0, len(part)]))
        out += counts[:, 0]
        fresh.append(np.unique(word))
        if sum(map(len, fresh)) > len(known) + PIECE:
            known, fresh = np.unique(np.concatenate([known, *fresh])), []
    out[1] = len(np.unique(np.concatenate([known, *fresh])))
    return out


def measure(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The _COUNTS of every row, [counts, rows]."""
    blocks = [np.zeros((len(_COUNTS), 0), np.int64)]
    for a, b in pieces(ends, PIECE):
        if ends[b] - ends[a] > 2 * PIECE:
            blocks.append(_measure_long(data[ends[a] : ends[b]].tobytes())[:, None])
            continue
        counts, row, word = _measure(data[ends[a] : ends[b]], ends[a : b + 1] - ends[a])
        _, once = np.unique(word ^ mix(row.astype(np.uint64)), return_index=True)  # words of different rows differ
        counts[1] = np.bincount(row[once], minlength=b - a)
        blocks.append(counts)
    return np.concatenate(blocks, 1)


def _masked(batches):
    for batch in batches:
        words, distinct, capitals, points, signs = measure(*arrow_text(batch.column("text")))
        fails = [words < MIN_WORDS, 100 * distinct < DISTINCT_PERCENT * words, 100 * capitals > CAPITAL_PERCENT * points, signs > 0]
        mask = sum(f.astype(np.int32) << k for k, f in enumerate(fails))
        keep = [batch.column(x) for x in ("doc_id", "part", "digest")]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(mask, pa.int32())], names=["doc_id", "part", "digest", "mask"])


def failures(docs: DataFrame, space: Workspace) -> DataFrame:
    """Written table doc_id, part, mask: bit k is set if the k-th of FILTERS fails."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce("text", F.lit(""))
    read = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"))
    own = space.table(read.mapInArrow(_masked, f"doc_id {kind}, part string, digest binary, mask int"), "own")
    first = own.groupBy(F.col("digest").alias("_digest")).agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    first = space.table(first, "first")
    joined = join_checked(own, first, [("digest", "_digest")], "left")
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int")
    return space.table(joined.select("doc_id", "part", F.col("mask").bitwiseOR(F.shiftleft(copy, 4)).alias("mask")), "masks")


def steps(spark, filters: str = FILTERS) -> DataFrame:
    """mask, filter_order, step, filter, bit, fails, earlier: what becomes of every mask at every step of every order.

    2^f masks times f! orders of f steps: fixed, whatever the documents.
    """
    orders = ["".join(p) for p in itertools.permutations(filters)]
    long = spark.range(1).select(F.explode(F.array(*map(F.lit, orders))).alias("filter_order"))
    long = long.select("filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))).alias("step"))
    long = long.withColumn("filter", F.substr("filter_order", F.col("step"), F.lit(1)))
    bit = F.call_function("shiftleft", F.lit(1), (F.instr(F.lit(filters), F.col("filter")) - 1).cast("int"))
    cells = long.withColumn("bit", bit).withColumn("mask", F.explode(F.sequence(F.lit(0), F.lit((1 << len(filters)) - 1))))
    failed = F.col("mask").bitwiseAND(F.col("bit"))
    before = W.partitionBy("mask", "filter_order").orderBy("step").rowsBetween(W.unboundedPreceding, -1)
    return cells.withColumn("fails", failed != 0).withColumn("earlier", F.coalesce(F.bit_or(failed).over(before), F.lit(0)) != 0)


def audit(cells: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order and step of a table (part, mask, n, good, toxic) of counted masks."""
    met = cells.join(F.broadcast(steps(cells.sparkSession, filters)), "mask")
    total = lambda what, holds: F.sum(F.when(holds, F.col(what)).otherwise(0)).cast("long")
    now, gone = F.col("fails") & ~F.col("earlier"), F.col("earlier")
    out = met.groupBy("part", "filter_order", "step", "filter").agg(
        total("n", ~gone & ~F.col("fails")).alias("kept"), total("n", now).alias("removed"), total("n", gone & F.col("fails")).alias("redundant"),
        total("n", F.col("mask") == F.col("bit")).alias("unique_fails"), total("good", now).alias("good_lost"), total("toxic", now).alias("toxic_lost"),
    )
    return out.withColumn("shapley", F.sum("removed").over(W.partitionBy("part", "filter")))


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of FILTERS over documents and their labels."""
    space = Workspace(docs.sparkSession, "audit")
    masks = failures(docs, space)
    one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int")).alias(c)
    named = labels.filter("doc_id is not null").groupBy(F.col("doc_id").alias("_labelled")).agg(one("quality"), one("toxic")).filter("quality + toxic > 0")
    met = join_checked(masks, space.table(named, "labels"), [("doc_id", "_labelled")], "left")
    count = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias({"quality": "good"}.get(c, c))
    cells = met.groupBy("part", "mask").agg(F.count("*").alias("n"), count("quality"), count("toxic"))
    return audit(space.table(cells, "cells"))


def op11_filter_audit(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return audit_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


ORACLE = r"""
with d as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
e as (select text, min(doc_id) as first from d group by text),
b as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id),
f as (select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
             (len(w) < 200)::int + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::int + 4 * (100 * len(regexp_extract_all(d.text, '[A-Z]')) > 2 * length(d.text))::int
             + 8 * regexp_matches(d.text, '[#$%&*|]')::int + 16 * (d.doc_id > first)::int as mask
      from d join e on d.text = e.text left join b on d.doc_id = b.doc_id),
c as (select part, mask, good, toxic, count(*) as n from f group by all),
l(x) as (values ('A'), ('B'), ('C'), ('D'), ('E')),
o as (select a.x || b.x || c.x || d.x || e.x as filter_order from l a, l b, l c, l d, l e
      where a.x not in (b.x, c.x, d.x, e.x) and b.x not in (c.x, d.x, e.x) and c.x not in (d.x, e.x) and d.x <> e.x),
s as (select filter_order, step::int as step, substring(filter_order, step, 1) as filter, (1 << (ascii(substring(filter_order, step, 1)) - 65))::int as bit from o, range(1, 6) r(step)),
u as (select c.*, s.*, coalesce(bit_or(mask & bit) over (partition by part, mask, good, toxic, filter_order order by step rows between unbounded preceding and 1 preceding), 0) <> 0 as earlier from c, s),
g as (select part, filter_order, step, filter,
             coalesce(sum(n) filter (where mask & bit = 0 and not earlier), 0)::bigint as kept, coalesce(sum(n) filter (where mask & bit <> 0 and not earlier), 0)::bigint as removed,
             coalesce(sum(n) filter (where mask & bit <> 0 and earlier), 0)::bigint as redundant, coalesce(sum(n) filter (where mask = bit), 0)::bigint as unique_fails,
             coalesce(sum(n) filter (where mask & bit <> 0 and not earlier and good), 0)::bigint as good_lost, coalesce(sum(n) filter (where mask & bit <> 0 and not earlier and toxic), 0)::bigint as toxic_lost
      from u group by all)
select *, (sum(removed) over (partition by part, filter))::bigint as shapley from g
"""
