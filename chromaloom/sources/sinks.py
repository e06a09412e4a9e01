"""Sinks: classes routed to outputs in one pass, coordinate sort, tagged SAM text, BAM, Parquet and CSV."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.alignments import ALIASES, OUTPUTS
from . import bam


BROADCAST_ROWS = 250_000


class RouteError(ValueError):
    """A class that is sent to two outputs, or an unknown one."""


def classes_of(name: str) -> list[str]:
    if name in ALIASES:
        return ALIASES[name]
    if name in OUTPUTS:
        return OUTPUTS[name]
    if name in ALIASES["all_reads"]:
        return [name]
    raise RouteError(f"{name} is no class of reads")


def route(records: DataFrame, name: str) -> DataFrame:
    """The records of a class or of a group of classes."""
    return records.filter(F.col("hc").isin(*classes_of(name)))


def check_routes(outputs: dict[str, list[str]]) -> dict[str, str]:
    """Path by class; a class may go to one path only, a path may take many."""
    where: dict[str, str] = {}
    for path, names in outputs.items():
        for code in (c for n in names for c in classes_of(n)):
            if where.setdefault(code, path) != path:
                raise RouteError(f"{code} is sent to {where[code]} and {path}")
    return where


def routed(records: DataFrame, routes: list[list[str]]) -> DataFrame:
    """The records of all routes (a list of classes each), with ``route``: the number of theirs."""
    where = F.lit(None).cast("int")
    for k, names in enumerate(routes):
        where = F.when(F.col("hc").isin(*[c for n in names for c in classes_of(n)]), F.lit(k)).otherwise(where)
    return records.withColumn("route", where).filter("route is not null")


def coordinate_sorted(records: DataFrame, sequences: DataFrame, first: list[str] | None = None) -> DataFrame:
    """Records by sequence and position, unmapped ones last: a range-partitioned global sort, after the columns ``first``."""
    order = sequences.select(F.col("name").alias("_n"), F.col("seq_idx").alias("_s"))
    small = F.broadcast(order) if order.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else order
    out = records.join(small, F.col("rname") == F.col("_n"), "left")
    return out.orderBy(*(first or []), F.col("_s").asc_nulls_last(), "pos", "qname", "line_no").drop("_n", "_s")


def sam_lines(records: DataFrame, *keep: str | Column) -> DataFrame:
    """One text column: the fields of each record, its rest and its tags; and the columns to keep."""
    return records.select(*keep, F.concat_ws("\t", "qname", F.col("flag").cast("string"), "rname", F.col("pos").cast("string"), F.col("mapq").cast("string"), "cigar", "rest", "tags").alias("value"))


def _fs(spark, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _staged(records: DataFrame, paths: list[str], inner: list[str], write) -> None:
    """One job for all routes: written by route into a folder beside the first, then each moved to its path.

    What was at a path goes when its new content is whole.
    """
    spark = records.sparkSession
    stage = f"{paths[0].rstrip('/')}.staged-{uuid.uuid4().hex}"
    write(records.write.mode("errorifexists").partitionBy("route", *inner), stage)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for k, path in enumerate(paths):
        fs, source = _fs(spark, f"{stage}/route={k}")
        there, target = _fs(spark, path.rstrip("/"))
        there.delete(target, True)
        if target.getParent() is not None:
            there.mkdirs(target.getParent())
        if not fs.exists(source):  # no record of these classes
            write(records.limit(0).drop("route").write, path)
        elif fs.getUri().equals(there.getUri()):
            if not fs.rename(source, target):
                raise OSError(f"{path}: its records stay in {stage}")
        else:
            spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, source, there, target, True, conf)
    fs, place = _fs(spark, stage)
    fs.delete(place, True)


def write_sams(records: DataFrame, headers: list[list[str]], paths: list[str]) -> None:
    """Folders of SAM text, of records with a route; a header is a part of its own, ``part-.header.sam``, that sorts before all others."""
    spark = records.sparkSession
    lines = sam_lines(records, "route")
    _staged(lines, paths, [], lambda writer, at: writer.text(at))
    for header, path in zip(headers, paths):
        fs, place = _fs(spark, f"{path}/part-.header.sam")
        out = fs.create(place, True)
        out.write(bytearray("".join(x + "\n" for x in header).encode()))
        out.close()


def write_parquets(records: DataFrame, paths: list[str], by_class: bool = True) -> None:
    """Folders of Parquet, of records with a route."""
    _staged(records, paths, ["hc"] if by_class else [], lambda writer, at: writer.parquet(at))


def write_bams(records: DataFrame, headers: list[list[str]], paths: list[str]) -> None:
    """Folders of BAM parts, of records sorted by route; sorted by coordinate within, they get an index each."""
    bam.register(records.sparkSession)
    columns = ["route", *[n for n, _ in bam.FIELDS], "tags"]
    records.select(*columns).write.format("bam").option("paths", json.dumps(paths)).option("headers", json.dumps(headers)).mode("overwrite").save()


def write_csv(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").option("compression", "bzip2").csv(path, header=True)
