"""Quality rules with adaptive thresholds (operator 5).

One pass over whole texts measures each document.  Mergeable quantile sketches (logarithmic
buckets of relative width ``GROWTH``, merged by adding counts) hold the distribution of each
measure per language and source.  To each group's sketch that of its language is added as if it
were ``PRIOR`` more documents, to that of a language the sketch of all documents in the same way: a small
group leans on its language, a large one on itself, without a switch at some size.  From its sketch every
group gets its own fences; the thresholds are joined to the documents and filter them.

* Marks, capitals and word length: from the quartiles q1 and q3, q3 + ``REACH`` (q3 - q1 + slack) and,
  for word length, also q1 - REACH (q3 - q1 + slack).
* Symbols, repeated lines and repeated triples are 0 in most documents of most groups.  Their fence is the geometric mean of
  the group's 90th percentile among documents that have any, and of a scale that tells what is much
  in itself; and q3 + REACH (q3 - q1), if that is more.  So a group whose documents use some symbols, or many, gets another fence
  than one where only junk has any.

Measures: symbols, repeated lines, words in repeated triples, punctuation marks and capitals,
each as a share, and characters per word.

Defined results: a null, empty or wordless text has counts 0 and fails the base rules.  A null
language or source is a group of its own.  Repeated rows are measured alike.  Only documents
that pass the base rules enter the sketches.  Extra columns are ignored.  An empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import BROADCAST_ROWS, arrow_text, mix, pieces, separators, words_of, Workspace

MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of words
GROWTH = 1.02
PRIOR = 100  # documents
REACH = 3.0
#: Percentile of the documents with any that sparse measures go by.
UPPER = 90
#: Measure: column expression, slack (scale of sparse measures), whether low values fail too.
MEASURES: dict[str, tuple[str, float, bool]] = {
    "symbols": ("n_symbols / word_chars", 0.01, False),
    "dup_lines": ("n_dup_lines / n_lines", 1.0, False),
    "repeats": ("n_repeat_words / n_words", 1.0, False),
    "marks": ("n_marks / word_chars", 0.01, False),
    "capitals": ("n_capitals / word_chars", 0.02, False),
    "word_length": ("word_chars / n_words", 0.5, True),
}

SPARSE = ("symbols", "dup_lines", "repeats")

_INSIDE, _IN_LINE = separators(), separators(b"\n")
_SYMBOL = ~separators(b"#*$%&|<>")
_MARK = ~separators(b"!\"'()+,-./:;=?@[\\]^_`{}~")
_CAPITAL = ~separators(bytes(range(65, 91)))
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_marks", "n_capitals"]


def _per_row(flag: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(flag))
    return total[ends[1:]] - total[ends[:-1]]


def _seen(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur twice or more, and which have occurred before."""
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice, before = np.zeros(len(key), bool), np.zeros(len(key), bool)
    before[order[1:]] = same
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    return twice, before


def measure(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The COUNTS of each row, [counts, rows]."""
    rows = len(ends) - 1
    out = np.zeros((len(COUNTS), rows), np.int64)
    starts, row, word = words_of(data, ends, _INSIDE)
    if not len(row):
        return out
    out[0] = np.bincount(row, minlength=rows)
    out[1] = _per_row(_INSIDE[data] & ((data & 0xC0) != 0x80), ends)
    out[2], out[6], out[7] = (_per_row(table[data], ends) for table in (_SYMBOL, _MARK, _CAPITAL))
    line_start, line_row, line = words_of(data, ends, _IN_LINE)
    # a line has a word if some word begins in it: words do not cross line ends
    filled = np.bincount(np.searchsorted(line_start, starts, "right") - 1, minlength=len(line)) > 0
    line, line_row = line[filled], line_row[filled]
    out[5] = np.bincount(line_row, minlength=rows)
    _, before = _seen(line ^ mix(line_row.astype(np.uint64)))
    out[3] = np.bincount(line_row[before], minlength=rows)
    if len(word) >= 3:
        at = np.flatnonzero(row[2:] == row[:-2])
        triple = mix(word[at] * np.uint64(3) + mix(word[at + 1]) * np.uint64(5) + mix(word[at + 2] ^ np.uint64(9)))
        twice, _ = _seen(triple ^ mix(row[at].astype(np.uint64)))
        covered = np.zeros(len(word), bool)
        for k in range(3):
            covered[at[twice] + k] = True
        out[4] = np.bincount(row[covered], minlength=rows)
    return out


def _measured(batches):
    for batch in batches:
        data, ends = arrow_text(batch.column("text"))
        parts = [measure(data[ends[a] : ends[b]], ends[a : b + 1] - ends[a]) for a, b in pieces(ends)]
        counts = np.concatenate(parts, 1) if parts else np.zeros((len(COUNTS), 0), np.int64)
        keep = [batch.column(x) for x in ("doc_id", "lang", "source")]
        yield pa.RecordBatch.from_arrays([*keep, *map(pa.array, counts)], names=["doc_id", "lang", "source", *COUNTS])


def measured(docs: DataFrame) -> DataFrame:
    kinds = ", ".join(f"{x} {docs.schema[x].dataType.simpleString()}" for x in ("doc_id", "lang", "source"))
    out = docs.select("doc_id", "lang", "source", "text").mapInArrow(_measured, f"{kinds}, {', '.join(f'{x} long' for x in COUNTS)}")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def bucket_of(value: Column) -> Column:
    """Bucket of a sketch: 0 holds zero, k > 0 holds values in (GROWTH^(k-1), GROWTH^k] millionths."""
    return F.when(value <= 0, 0).otherwise(F.greatest(F.lit(1), F.ceil(F.log(value * 1e6) / np.log(GROWTH)).cast("int")))


def sketches(table: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): the sketch of every group, as rows that merge by sum."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("measure"), bucket_of(F.expr(x)).alias("bucket")) for k, (x, _, _) in MEASURES.items()]))
    return table.filter("not base_failed").select("lang", "source", each.alias("e")).groupBy("lang", "source", "e.measure", "e.bucket").agg(F.count("*").alias("n"))


def thresholds(sketch: DataFrame, groups: DataFrame) -> DataFrame:
    """One row per (lang, source) with a lower and an upper fence for every measure.

    All windows run over buckets of one sketch, whose number does not depend on the documents.
    Weights are whole numbers: counts times the size of the sketch above, so that sums are exact.
    """
    whole = lambda c: c.cast("decimal(38,0)")
    every = sketch.groupBy("measure", "bucket").agg(F.sum("n").alias("na"))
    langs = sketch.groupBy("lang", "measure", "bucket").agg(F.sum("n").alias("nl"))
    size_all = sketch.groupBy(F.col("measure").alias("_m")).agg(whole(F.sum("n")).alias("size_a"))
    size_lang = sketch.groupBy(F.col("lang").alias("_l"), F.col("measure").alias("_m2")).agg(whole(F.sum("n")).alias("size_l"))
    size_own = sketch.groupBy(F.col("lang").alias("_l3"), F.col("source").alias("_s3"), F.col("measure").alias("_m3")).agg(whole(F.sum("n")).alias("size_o"))
    every = every.join(size_all, F.col("measure") == F.col("_m")).drop("_m")
    # Every group has all buckets of the sketch of all documents.
    table = (
        groups.select("lang", "source", F.explode(F.array(*map(F.lit, MEASURES))).alias("measure"))
        .join(size_lang, F.col("lang").eqNullSafe(F.col("_l")) & (F.col("measure") == F.col("_m2")), "left")
        .join(size_own, F.col("lang").eqNullSafe(F.col("_l3")) & F.col("source").eqNullSafe(F.col("_s3")) & (F.col("measure") == F.col("_m3")), "left")
        .select("lang", "source", "measure", F.coalesce("size_l", whole(F.lit(0))).alias("size_l"), F.coalesce("size_o", whole(F.lit(0))).alias("size_o"))
        .join(every, "measure")
    )
    langs = langs.select(F.col("lang").alias("_l"), F.col("measure").alias("_m"), F.col("bucket").alias("_b"), "nl")
    own = sketch.select(F.col("lang").alias("_l2"), F.col("source").alias("_s2"), F.col("measure").alias("_m2"), F.col("bucket").alias("_b2"), "n")
    table = table.join(langs, F.col("lang").eqNullSafe(F.col("_l")) & (F.col("measure") == F.col("_m")) & (F.col("bucket") == F.col("_b")), "left")
    table = table.join(own, F.col("lang").eqNullSafe(F.col("_l2")) & F.col("source").eqNullSafe(F.col("_s2")) & (F.col("measure") == F.col("_m2")) & (F.col("bucket") == F.col("_b2")), "left")
    zero = F.lit(0).cast("long")
    of_lang = F.coalesce("nl", zero) * F.col("size_a") + PRIOR * F.col("na")
    scale = F.col("size_a") * (F.col("size_l") + PRIOR)
    table = table.withColumn("weight", whole(F.coalesce("n", zero) * whole(scale) + PRIOR * whole(of_lang))).withColumn("all", whole(whole(scale) * (F.col("size_o") + PRIOR)))
    key = ["lang", "source", "measure"]
    table = table.withColumn("upto", whole(F.sum("weight").over(W.partitionBy(*key).orderBy("bucket"))))
    value = F.when(F.col("bucket") == 0, 0.0).otherwise(F.pow(F.lit(GROWTH), F.col("bucket") - 0.5) / 1e6)
    quartile = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("all") * q, value))
    table = table.withColumn("none", F.sum(F.when(F.col("bucket") == 0, F.col("weight")).otherwise(whole(F.lit(0)))).over(W.partitionBy(*key)))
    upper = F.min(F.when((F.col("bucket") > 0) & ((F.col("upto") - F.col("none")) * 100 >= (F.col("all") - F.col("none")) * UPPER), value))
    fences = table.groupBy(*key).agg(quartile(1).alias("q1"), quartile(3).alias("q3"), upper.alias("upper"))
    slack = F.create_map(*[F.lit(y) for k, (_, s, _) in MEASURES.items() for y in (k, s)])[F.col("measure")]
    low = F.create_map(*[F.lit(y) for k, (_, _, b) in MEASURES.items() for y in (k, b)])[F.col("measure")]
    reach = REACH * (F.col("q3") - F.col("q1") + slack)
    sparse = F.greatest(F.col("q3") + REACH * (F.col("q3") - F.col("q1")), F.sqrt(slack * F.coalesce("upper", F.lit(0.0))))
    fences = fences.withColumn("high", F.when(F.col("measure").isin(*SPARSE), sparse).otherwise(F.col("q3") + reach)).withColumn("low", F.when(low, F.col("q1") - reach))
    return fences.groupBy(F.col("lang").alias("_lang"), F.col("source").alias("_source")).agg(
        *[F.max(F.when(F.col("measure") == k, F.col(side))).alias(f"{k}_{side}") for k in MEASURES for side in ("low", "high")]
    )


def apply_rules(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the counts, base_failed, kept and the measure that failed first."""
    space = Workspace(docs.sparkSession, "quality")
    table = space.table(measured(docs), "table")
    sketch = space.table(sketches(table), "sketch")
    limits = space.table(thresholds(sketch, table.select("lang", "source").distinct()), "limits")
    small = F.broadcast(limits) if limits.count() <= BROADCAST_ROWS // 4 else limits
    out = table.join(small, table["lang"].eqNullSafe(limits["_lang"]) & table["source"].eqNullSafe(limits["_source"]), "left")
    fails = [F.when((F.expr(x) > F.col(f"{k}_high")) | (F.expr(x) < F.col(f"{k}_low")), F.lit(k)) for k, (x, _, _) in MEASURES.items()]
    failed = F.when(~F.col("base_failed"), F.coalesce(*fails))
    return out.select("doc_id", "lang", "source", *COUNTS, "base_failed", (~F.col("base_failed") & failed.isNull()).alias("kept"), failed.alias("failed_measure"))


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    return apply_rules(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("n_lines", "n_marks", "n_capitals", "lang", "source")


def _oracle() -> str:
    """DuckDB SQL of op5: the same counts, buckets, blended sketches and fences."""
    unpivot = "\n  union all ".join(f"select doc_id, lang, source, base_failed, {i} as o, '{k}' as measure, ({x.replace(' / ', '::double / ')}) as v, {s} as slack, {str(b).lower()} as two from b" for i, (k, (x, s, b)) in enumerate(MEASURES.items()))
    return r"""
with d as (select doc_id, lang, source, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
l as (select doc_id, unnest(string_split(text, chr(10))) as line from d),
ln as (select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines from l where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id),
t as (select doc_id, i, w[i] as x, w[i + 1] as y, w[i + 2] as z from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from d where len(w) >= 3)),
r as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, x, y, z) as k from t) where k > 1),
rw as (select doc_id, count(*) as n_repeat_words from (select distinct doc_id, i + o as i from r, (values (0), (1), (2)) v(o)) group by doc_id),
c as (select d.doc_id, lang, source, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols, coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
             coalesce(n_repeat_words, 0)::bigint as n_repeat_words, coalesce(n_lines, 0)::bigint as n_lines,
             len(regexp_extract_all(text, '[!"''()+,\-./:;=?@\[\\\]^_`{}~]'))::bigint as n_marks, len(regexp_extract_all(text, '[A-Z]'))::bigint as n_capitals
      from d left join ln on d.doc_id = ln.doc_id left join rw on d.doc_id = rw.doc_id),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from c),
m as (""" + unpivot.replace(" from b", " from b where not base_failed") + r"""),
k as (select *, case when v <= 0 then 0 else greatest(1, ceil(ln(v * 1e6) / ln(1.02::double)))::int end as bucket from m),
o as (select lang, source, measure, bucket, count(*)::hugeint as n from k group by all),
la as (select lang, measure, bucket, sum(n)::hugeint as n from o group by all),
al as (select measure, bucket, sum(n)::hugeint as n from o group by all),
so as (select lang, source, measure, sum(n)::hugeint as n from o group by all),
sl as (select lang, measure, sum(n)::hugeint as n from o group by all),
sa as (select measure, sum(n)::hugeint as n from o group by all),
g as (select distinct lang, source, measure, slack, two from k),
qq as (select g.*, al.bucket, coalesce(o.n, 0) * sa.n * (sl.n + 100) + 100 * (coalesce(la.n, 0) * sa.n + 100 * al.n) as weight, sa.n * (sl.n + 100) * (so.n + 100) as total,
             case when al.bucket = 0 then 0 else pow(1.02::double, al.bucket - 0.5) / 1e6 end as val
      from g join sa on sa.measure = g.measure join al on al.measure = g.measure
      join sl on sl.lang is not distinct from g.lang and sl.measure = g.measure
      join so on so.lang is not distinct from g.lang and so.source is not distinct from g.source and so.measure = g.measure
      left join la on la.lang is not distinct from g.lang and la.measure = g.measure and la.bucket = al.bucket
      left join o on o.lang is not distinct from g.lang and o.source is not distinct from g.source and o.measure = g.measure and o.bucket = al.bucket),
q as (select *, sum(weight) over (partition by lang, source, measure order by bucket) as upto, sum(case when bucket = 0 then weight else 0 end) over (partition by lang, source, measure) as none from qq),
f as (select lang, source, measure, slack, two, min(case when upto * 4 >= total then val end) as q1, min(case when upto * 4 >= total * 3 then val end) as q3,
             min(case when bucket > 0 and (upto - none) * 100 >= (total - none) * 90 then val end) as upper
      from q group by all),
h as (select *, case when measure in ('symbols', 'dup_lines', 'repeats') then greatest(q3 + 3 * (q3 - q1), sqrt(slack * coalesce(upper, 0))) else q3 + 3 * (q3 - q1 + slack) end as high, case when two then q1 - 3 * (q3 - q1 + slack) end as low from f),
x as (select k.doc_id, k.o, k.measure, h.high, h.low, v
      from k join h on h.lang is not distinct from k.lang and h.source is not distinct from k.source and h.measure = k.measure),
w as (select doc_id, arg_min(measure, o) as failed_measure from x where v > high or v < low group by doc_id)
select b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and failed_measure is null as kept, failed_measure
from b left join w on b.doc_id = w.doc_id
"""


ORACLE = _oracle()
