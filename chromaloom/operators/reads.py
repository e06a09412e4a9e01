"""Classification of reads: flags, reference, mapping quality and distance to the nearest site.

Input: a table of records with ``line_no, qname, flag, rname, pos, mapq, cigar`` (others pass
unchanged).  Conditions are cheap columns; only reads that pass them carry a key into the
interval lookup, and the others get scattered keys that match nothing, so neither unmapped
reads nor one sequence pile up in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.alignments import bad_flags, five_prime, flag_class, has, query_length, reference_length
from .asof import BROADCAST_ROWS, lookup

MIN_MAPQ = 10


def site_distance(start: Column, frag_start: Column, frag_next: Column) -> Column:
    """Signed distance to the nearest cut: negative if that is the next one; ties go to the start."""
    back, ahead = start - frag_start, frag_next - start
    return F.when(ahead < back, -ahead).otherwise(back)


def classify(reads: DataFrame, sequences: DataFrame, fragments: DataFrame | None, min_mapq: int = MIN_MAPQ, strategy: str = "bin", good_only: bool = False) -> DataFrame:
    """Adds ref_len, query_len, seq_idx, read_start, frag_id, frag_start, frag_next, frag_end, site_dist, hc.

    ``hc`` is null for good reads, and the columns from seq_idx on are set for good reads only.
    Without ``fragments`` nothing is digested: no read is too far from a site.  With ``good_only`` bad reads are
    left out, each where it is found out: what is bad by its flag, quality or name is not shuffled for the lookup.
    """
    if good_only:
        reads = candidates(reads, min_mapq)
    names = sequences.select(F.col("name").alias("_name"), F.col("seq_idx").alias("_seq"), F.col("length").alias("_length"))
    small = F.broadcast(names) if names.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else names
    out = reads.join(small, reads["rname"] == small["_name"], "inner" if good_only else "left")
    early = F.lit(None).cast("string") if good_only else F.coalesce(flag_class(F.col("flag")), F.when(F.col("_seq").isNull(), "IR"), F.when(F.coalesce("mapq", F.lit(0)) < min_mapq, "MQ"))
    out = (
        out.withColumn("_early", early).withColumn("ref_len", reference_length(F.col("cigar"))).withColumn("query_len", query_length(F.col("cigar")))
        .withColumn("_start", five_prime(F.col("pos"), F.col("flag"), F.col("ref_len")))
    )
    if fragments is None:
        out = out.withColumns({"seq_idx": F.col("_seq"), "_dist": F.lit(0).cast("long"), "frag_id": F.lit(None).cast("long"), "frag_start": F.lit(None).cast("long"), "frag_next": F.lit(None).cast("long"), "frag_end": F.lit(None).cast("long")})
    else:
        # the key is the sequence of every read that can be good, so that is not carried beside it
        key = F.when(F.col("_early").isNull(), F.col("_seq")).otherwise(-1 - F.pmod(F.hash("qname"), F.lit(4096)))
        out = lookup(out.withColumn("seq_idx", key), fragments, "_start", strategy, length="_length")
        out = out.withColumn("_dist", site_distance(F.col("_start"), F.col("frag_start"), F.col("frag_next")))
    near = F.coalesce(F.abs("_dist") < 2 * F.col("query_len"), F.lit(False))
    hc = F.coalesce("_early", F.when(~near, "RS"))
    good = hc.isNull()
    if good_only:
        out, hc = out.filter(good), F.lit(None).cast("string")
    kept = {"seq_idx": "seq_idx", "read_start": "_start", "frag_id": "frag_id", "frag_start": "frag_start", "frag_next": "frag_next", "frag_end": "frag_end", "site_dist": "_dist"}
    return out.select(*reads.columns, "ref_len", "query_len", *[F.when(good, F.col(c)).alias(n) for n, c in kept.items()], hc.alias("hc"))


def by_flags(reads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records that can be good by their flags, and the others, whose class is known without a lookup."""
    kind = flag_class(F.col("flag"))
    return reads.filter(kind.isNull()), reads.filter(kind.isNotNull())


def flagged(reads: DataFrame) -> DataFrame:
    """Records of a bad flag in the form of ``classify``, which would give the same."""
    kept = {"seq_idx": "int", "read_start": "long", "frag_id": "long", "frag_start": "long", "frag_next": "long", "frag_end": "long", "site_dist": "long"}
    none = [F.lit(None).cast(t).alias(c) for c, t in kept.items()]
    return reads.select("*", reference_length(F.col("cigar")).alias("ref_len"), query_length(F.col("cigar")).alias("query_len"), *none, flag_class(F.col("flag")).alias("hc"))


def candidates(reads: DataFrame, min_mapq: int = MIN_MAPQ) -> DataFrame:
    """Records that can be good by flags and quality; the good reads of all are those of these."""
    return by_flags(reads)[0].filter(F.coalesce("mapq", F.lit(0)) >= min_mapq)


def flag_counts(reads: DataFrame) -> DataFrame:
    """One row: reads with each bad flag; a read with several counts in each."""
    return reads.agg(F.count("*").alias("reads"), *[F.count_if(holds).alias(code) for code, holds in bad_flags(F.col("flag")).items()])


def good_reads(classified: DataFrame) -> DataFrame:
    strand = {"is_reverse": has(F.col("flag"), 0x10), "is_read1": has(F.col("flag"), 0x40)}
    return classified.filter("hc is null").withColumns(strand)


def fragment_tag(frag_id: Column, start: Column, end: Column) -> Column:
    return F.concat(F.lit("rf:B:I,"), F.concat_ws(",", frag_id.cast("string"), start.cast("string"), end.cast("string")))


def tags(classified: DataFrame) -> DataFrame:
    """Adds ``tags``: hc:Z:<class>, and for reads with a fragment its id, start and end."""
    fragment = F.when(F.col("frag_id").isNotNull(), fragment_tag(F.col("frag_id"), F.col("frag_start"), F.col("frag_end")))
    return classified.withColumn("tags", F.concat_ws("\t", F.concat(F.lit("hc:Z:"), F.col("hc")), fragment))
