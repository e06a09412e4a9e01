"""Contacts of a stream, against the batch, through stops and replays."""

import random
import time

import pytest

from chromaloom.operators import pairs, stats
from chromaloom.streaming import contacts

GOOD = "qname string, is_read1 boolean, line_no long, seq_idx int, read_start long, frag_id long, frag_start long, frag_next long, site_dist long, is_reverse boolean"


@pytest.fixture
def rocks(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    was = spark.conf.get(name)
    spark.conf.set(name, contacts.PROVIDER)
    yield spark
    spark.conf.set(name, was)


def reads(n=240, names=70):
    rng = random.Random(12)
    out = []
    for i in range(n):
        frag = rng.randrange(12)
        out.append((f"q{rng.randrange(names)}", rng.random() < 0.5, i, frag // 4, frag * 100 + rng.randrange(100), frag, frag * 100, None if frag % 4 == 3 else frag * 100 + 100, rng.randrange(-40, 40), rng.random() < 0.5))
    return out


def wanted(spark, rows):
    found = pairs.pair_reads(spark.createDataFrame(rows, GOOD)).persist()
    return {tuple(r) for r in stats.contact_matrix(found).collect()}, {r["hc"]: r["count"] for r in found.groupBy("hc").count().collect()}


def test_stream_like_batch_through_a_replay(rocks, tmp_path):
    """Six batches; after the third the stream stops, and its last batch is replayed as if it had not been committed."""
    spark, rows = rocks, reads()
    for k in range(3):
        spark.createDataFrame(rows[40 * k : 40 * k + 40], GOOD).coalesce(1).write.parquet(str(tmp_path / "in"), mode="append")
    source = lambda: spark.readStream.schema(GOOD).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    start = lambda: contacts.count_contacts(source(), str(tmp_path / "out"), str(tmp_path / "state"), None, 8, availableNow=True)
    start().awaitTermination()
    first = {tuple(r) for r in contacts.contacts_so_far(spark, str(tmp_path / "out")).collect()}
    assert first == wanted(spark, rows[:120])[0]
    commits = sorted((tmp_path / "state" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    assert len(commits) >= 3
    for name in (commits[-1].name, f".{commits[-1].name}.crc"):
        (tmp_path / "state" / "commits" / name).unlink(missing_ok=True)
    for k in range(3, 6):
        spark.createDataFrame(rows[40 * k : 40 * k + 40], GOOD).coalesce(1).write.parquet(str(tmp_path / "in"), mode="append")
    start().awaitTermination()
    matrix, classes = wanted(spark, rows)
    assert {tuple(r) for r in contacts.contacts_so_far(spark, str(tmp_path / "out")).collect()} == matrix
    got = {r["hc"]: r["count"] for r in contacts.classes_so_far(spark, str(tmp_path / "out")).collect()}
    assert {k: n for k, n in got.items() if k != "DM"} == classes


def test_reads_that_wait_too_long_are_let_go(rocks, tmp_path):
    spark = rocks
    lone = ("a", True, 0, 0, 5, 1, 0, 10, 5, False)
    spark.createDataFrame([lone, ("b", True, *lone[2:]), ("b", False, 3, 0, 250, 3, 200, None, 50, True)], GOOD).write.parquet(str(tmp_path / "in"))
    run = contacts.count_contacts(spark.readStream.schema(GOOD).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state"), 1.0, 4, processingTime="1 second")
    end, got = time.time() + 90, {}
    while time.time() < end and got != {"FR": 1, "DM": 1}:
        time.sleep(1)
        if (tmp_path / "out" / "classes").exists():
            got = {r["hc"]: r["count"] for r in contacts.classes_so_far(spark, str(tmp_path / "out")).collect()}
    run.stop()
    assert got == {"FR": 1, "DM": 1}


def test_the_state_store_is_asked_for(spark, tmp_path):
    spark.createDataFrame([], GOOD).write.parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError, match="RocksDB"):
        contacts.paired_stream(spark.readStream.schema(GOOD).parquet(str(tmp_path / "in")))
