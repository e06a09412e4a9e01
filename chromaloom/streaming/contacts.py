"""Pairs and contact counts over a stream of good reads, with an exact restart.

Query names are dealt into buckets; a bucket keeps the reads that wait for their mate in one list of its state, so a
micro-batch costs two accesses to the state per bucket, whatever the number of names.  Timers let reads go that have waited too long.
Every micro-batch writes its counts under its own number and overwrites them when it is run again, so a batch that is
replayed after a stop counts once.

The state needs Spark's RocksDB provider: ``spark.sql.streaming.stateStore.providerClass``.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.pairs import CARRIED, _classified
from ..operators.stats import contact_matrix

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BUCKETS = 1024
KINDS = {"line_no": "long", "seq_idx": "int", "read_start": "long", "frag_id": "long", "frag_start": "long", "frag_next": "long", "site_dist": "long", "is_reverse": "boolean"}
READ = ["qname", "is_read1", *CARRIED]
_READ_DDL = "qname string, is_read1 boolean, " + ", ".join(f"{c} {KINDS[c]}" for c in CARRIED)
#: A read and its mate (m_*), or a read that stays without one.
OUTPUT = _READ_DDL + ", " + ", ".join(f"m_{c} {KINDS[c]}" for c in CARRIED)
_PANDAS = {"long": "Int64", "int": "Int32", "boolean": "boolean"}
_TYPES = {"qname": "object", "is_read1": "boolean"} | {f"{p}{c}": _PANDAS[KINDS[c]] for p in ("", "m_") for c in CARRIED}


_CASTS = [str, bool, *[bool if KINDS[c] == "boolean" else int for c in CARRIED]]


def _plain(values) -> tuple:
    """A row of pandas as Python values: columns of whole numbers with nulls come as floats."""
    return tuple(None if pd.isna(v) else cast(v) for v, cast in zip(values, _CASTS))


class Waiting(StatefulProcessor):
    """The two slots of every name of a bucket: a read waits for one of the other side, and a later one of its own takes its place."""

    def __init__(self, waits: float | None):
        self.waits = waits

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.reads = handle.getListState("waiting", _READ_DDL + ", since long")

    def _keep(self, held: dict[str, tuple]) -> None:
        if held:
            self.reads.put(list(held.values()))
        else:
            self.reads.clear()

    def _rows(self, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        if rows:
            yield pd.DataFrame(rows, columns=list(_TYPES)).astype(_TYPES)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = {r[0]: tuple(r) for r in self.reads.get()} if self.reads.exists() else {}
        now, out = int(time.time() * 1000), []
        new = pd.concat(list(rows))[READ].sort_values(["qname", "line_no"])
        nothing = (None,) * len(CARRIED)
        for read in map(_plain, new.itertuples(index=False, name=None)):
            other = held.get(read[0])
            if other is None or other[1] == read[1]:
                if other is not None:  # replaced
                    out.append((*other[:-1], *nothing))
                held[read[0]] = (*read, now)
            else:
                out.append((*read, *other[2:-1]))
                del held[read[0]]
        self._keep(held)
        if held and self.waits is not None:
            self.handle.registerTimer(now + int(self.waits * 1000))
        yield from self._rows(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = {r[0]: tuple(r) for r in self.reads.get()} if self.reads.exists() else {}
        last = expiredTimerInfo.getExpiryTimeInMs() - int((self.waits or 0) * 1000)
        gone = [r for r in held.values() if r[-1] <= last]
        self._keep({k: r for k, r in held.items() if r[-1] > last})
        yield from self._rows([(*r[:-1], *(None,) * len(CARRIED)) for r in gone])

    def close(self) -> None:
        pass


def paired_stream(good: DataFrame, waits: float | None = 3600.0, buckets: int = BUCKETS) -> DataFrame:
    """A stream of OUTPUT: reads with their mates as pairs close, and reads that stay without one.

    ``good``: a stream of reads as ``good_reads`` gives them.  ``waits`` is in seconds; None lets reads wait without end.
    """
    spark = good.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != PROVIDER:
        raise ValueError(f"spark.sql.streaming.stateStore.providerClass must be {PROVIDER}")
    slim = good.select("qname", "is_read1", *[F.col(c).cast(KINDS[c]).alias(c) for c in CARRIED])
    named = slim.withColumn("bucket", F.pmod(F.xxhash64("qname"), F.lit(buckets)).cast("int"))
    mode = "None" if waits is None else "ProcessingTime"
    return named.groupBy("bucket").transformWithStateInPandas(Waiting(waits), OUTPUT, "Append", mode)


def classified_pairs(paired: DataFrame) -> DataFrame:
    """The pairs of OUTPUT, as ``pair_reads`` gives them."""
    mate = F.struct(*[F.col(f"m_{c}").alias(c) for c in CARRIED], (~F.col("is_read1")).alias("is_read1"))
    return _classified(paired.filter("m_line_no is not null").withColumn("mate", mate), ())


def count_contacts(good: DataFrame, path: str, checkpoint: str, waits: float | None = 3600.0, buckets: int = BUCKETS, **trigger) -> StreamingQuery:
    """Counts contacts and pair classes of a stream below ``path``; ``trigger`` goes to the stream's writer."""

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            pairs = classified_pairs(batch)
            contact_matrix(pairs).write.mode("overwrite").parquet(f"{path}/contacts/batch={number}")
            lone = batch.filter("m_line_no is null").groupBy(F.lit("DM").alias("hc")).agg(F.count("*").alias("count"))
            classes = pairs.groupBy("hc").agg(F.count("*").alias("count")).unionByName(lone)
            classes.write.mode("overwrite").parquet(f"{path}/classes/batch={number}")
        finally:
            batch.unpersist()

    writer = paired_stream(good, waits, buckets).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def contacts_so_far(spark: SparkSession, path: str) -> DataFrame:
    """The contact matrix of all batches."""
    return spark.read.schema("seq1 int, seq2 int, hc string, count long").parquet(f"{path}/contacts").groupBy("seq1", "seq2", "hc").agg(F.sum("count").alias("count"))


def classes_so_far(spark: SparkSession, path: str) -> DataFrame:
    """(hc, count): pairs of each class, and reads that went without a mate."""
    return spark.read.schema("hc string, count long").parquet(f"{path}/classes").groupBy("hc").agg(F.sum("count").alias("count"))
