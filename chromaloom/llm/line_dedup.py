"""Removal of repeated passages of three lines (operator 1), with DataFrame functions only.

Lines are the ``\\n``-split parts of a text; their surrounding blanks are ignored when they are
compared, and lines of blanks only are passed over.  Every three consecutive remaining lines are
a window.  A window that occurs more than once keeps its first occurrence in the order of
(doc_id, xxhash64(text), position); the lines covered by later ones, merged where windows
overlap, are removed with their line ends.

Defined results: null texts stay null and have no lines.  Texts of fewer than three lines that
are not blank are unchanged.  Rows equal in doc_id and text are one document: both get the same
result.  A null doc_id sorts first.  Windows are compared by 128 bits of hash.  Columns of the
input other than ``text`` and ``n_chars`` pass unchanged; names starting with ``_ld_`` are refused.
An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import BROADCAST_ROWS, Workspace, join_checked, refuse

BLANKS = " \t\x0b\x0c\r"


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """Bind a value that a lambda uses, so that it is not computed again for every element."""
    return F.get(F.transform(F.array(value), then), 0)


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _blank(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS)) == ""


def _windows(text: Column) -> Column:
    """(i, h, g) of every window of a text: its ordinal and two hashes."""
    filled = F.filter(F.transform(_lines(text), lambda x: F.btrim(x, F.lit(BLANKS))), lambda x: x != "")

    def hashed(lines: Column) -> Column:
        triple = lambda i: [F.get(lines, i + k) for k in range(3)]
        every = F.when(F.size(lines) >= 3, F.sequence(F.lit(0), F.size(lines) - 3))
        return F.transform(every, lambda i: F.struct(i.alias("i"), F.xxhash64(*triple(i)).alias("h"), F.xxhash64(F.lit(1), *triple(i)).alias("g")))

    return let(filled, hashed)


def _rest(text: Column, covered: Column) -> Column:
    """The text without the lines whose ordinals among those that are not blank are covered."""

    def without(lines: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(lines) - 1)
        filled = F.filter(every, lambda i: ~_blank(F.get(lines, i)))
        gone = let(filled, lambda f: F.transform(covered, lambda k: F.get(f, k)))
        return F.array_join(F.transform(F.array_except(every, gone), lambda i: F.get(lines, i)), "\n")

    return let(_lines(text), without)


def removed_lines(docs: DataFrame, space: Workspace) -> DataFrame:
    """Written table (_ld_id, _ld_lx, covered): ordinals of the lines to remove, per document."""
    windows = docs.select("doc_id", F.xxhash64("text").alias("x"), F.inline(_windows(F.col("text"))))
    windows = space.table(windows, "windows")
    first = F.min(F.struct("doc_id", "x", "i"))
    repeats = space.table(windows.groupBy("h", "g").agg(F.count("*").alias("n"), first.alias("first")).filter("n > 1").drop("n"), "repeats")
    small = F.broadcast(repeats) if repeats.count() <= BROADCAST_ROWS else repeats
    own = F.struct("doc_id", "x", "i")
    later = windows.join(small, ["h", "g"]).filter(~own.eqNullSafe(F.col("first"))).groupBy("doc_id", "x").agg(F.collect_set("i").alias("at"))
    merged = F.array_distinct(F.flatten(F.transform("at", lambda i: F.array(i, i + 1, i + 2))))
    out = space.table(later.select(F.col("doc_id").alias("_ld_id"), F.col("x").alias("_ld_lx"), merged.alias("covered")), "covered")
    space.drop("windows", "repeats")
    return out


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines removed, and _ld_lines, _ld_removed, _ld_all (nothing is left).

    ``n_chars``, if there is such a column, follows the text.
    """
    refuse(docs, "_ld_")
    space = Workspace(docs.sparkSession, "lines")
    covered = removed_lines(docs.select("doc_id", "text"), space)
    positions = covered.agg(F.sum(F.size("covered"))).first()[0] or 0
    named = docs.withColumn("_ld_x", F.xxhash64("text"))
    out = join_checked(named, covered, [("doc_id", "_ld_id"), ("_ld_x", "_ld_lx")], "left", rows=positions // 4)  # positions take 4 bytes
    lines = _lines(F.col("text"))
    text = _rest(F.col("text"), F.col("covered"))
    filled = F.size(F.filter(lines, lambda x: ~_blank(x)))
    touched = F.col("covered").isNotNull()
    return (
        out.withColumn("_ld_lines", F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long"))
        .withColumn("_ld_removed", F.when(touched, F.size("covered")).otherwise(0).cast("long"))
        .withColumn("_ld_all", F.when(touched, F.size("covered") == filled).otherwise(F.lit(False)))
        .withColumn("text", F.when(touched, text).otherwise(F.col("text")))
        .withColumns({"n_chars": F.when(touched, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))} if "n_chars" in docs.columns else {})
        .select(*docs.columns, "_ld_lines", "_ld_removed", "_ld_all")
    )


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "text", F.col("_ld_lines").alias("n_lines"), F.col("_ld_removed").alias("n_removed"))


ORACLE = r"""
with l as (
  select doc_id, unnest(string_split(text, chr(10))) as line,
         generate_subscripts(string_split(text, chr(10)), 1) as p
  from documents where text is not null),
t as (select *, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) as s from l),
k as (select doc_id, p, s, row_number() over (partition by doc_id order by p) as k from t where s <> ''),
w as (select doc_id, k, s, lead(s) over d as s2, lead(s, 2) over d as s3 from k
      window d as (partition by doc_id order by k)),
r as (select doc_id, k, row_number() over (partition by s, s2, s3 order by doc_id, k) as rn
      from w where s3 is not null),
c as (select distinct doc_id, k + o as k from r, (values (0), (1), (2)) v(o) where rn > 1),
g as (select k.doc_id, k.p from k join c using (doc_id, k)),
kept as (select l.doc_id, string_agg(l.line, chr(10) order by l.p) as text
         from l anti join g on l.doc_id = g.doc_id and l.p = g.p group by l.doc_id),
n as (select doc_id, count(*) as n from g group by doc_id)
select d.doc_id, case when d.text is null then null else coalesce(kept.text, '') end as text,
       coalesce(len(string_split(d.text, chr(10))), 0)::bigint as n_lines,
       coalesce(n.n, 0)::bigint as n_removed
from documents d left join kept on d.doc_id = kept.doc_id left join n on d.doc_id = n.doc_id
"""
