"""Near-duplicates by SimHash under a generalised pigeonhole (operator 13).

Texts are lower-cased (A-Z only); their words ``[^\\x20\\x09-\\x0D]+`` give three-word shingles, repeats
included (a text of fewer words is one shingle).  A bit of the 64-bit fingerprint is set if more
than half of the shingles' XXH64 (seed 42) have it.  Texts without words have fingerprint 0.
Fingerprints are linked if at most ``TAU`` bits differ.  Steps, over distinct fingerprints:

1. counts of bits that are set together, summed over all fingerprints, give correlations; correlated bits
   are grouped into four blocks of 16;
2. counts of the blocks' values give, for every value, how many fingerprints lie within 0 to TAU bits of it;
3. two indexes: the four blocks, and two halves of two blocks.  If the thresholds of p parts add up to
   TAU - p + 1, every fingerprint within TAU of a query is within its threshold in some part (-1 leaves a part out).  For each
   fingerprint dynamic programming picks thresholds, unequal where counts are, and the cheaper index.  So
   few fingerprints are met by blocks, and many by halves, without a switch;
4. values within a threshold are probed by an equality join that verifies all 64 bits.  Keys with many
   fingerprints are compared in blocks of ``CHUNK`` x ``CHUNK``, which return a forest, not pairs: a fingerprint that is found
   linked is not compared again;
5. components are found by alternating star contraction on written tables.

Nothing is sampled: every link of two fingerprints is found or implied by a path of links.

Defined results: null, empty and blank texts have fingerprint 0, linked like any other.  ``component_id`` is the
smallest doc_id reachable, null if there is none but null.  Equal fingerprints and repeated rows are one node.  Extra
columns are ignored.  An empty table gives no row.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ngram_join import components
from .shared import Workspace, arrow_binaries, join_checked, parts_of

SHINGLE = 3
SEED = 42
TAU = 3
BLOCKS, WIDTH = 4, 16
#: What a probe costs, in comparisons.
PROBE = 4
#: Parts of the two indexes, as blocks.
INDEXES = (((0,), (1,), (2,), (3,)), ((0, 1), (2, 3)))
#: Products of a key's fingerprints and probes up to which pairs are joined.
SMALL = 64 * 64
CHUNK = 4096


def ones_of(words: list[bytes]) -> tuple[int, np.ndarray]:
    """Number of shingles of these words, and how many have each bit."""
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = (ends - size).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :].tolist())]
    bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return len(hashes), bits.sum(0, dtype=np.int64)


def fingerprint(text: bytes) -> int:
    count, ones, tail = 0, np.zeros(64, np.int64), []
    for part in parts_of(text):
        words = tail + part.lower().split()
        if len(words) >= SHINGLE:
            n, held = ones_of(words)
            count, ones = count + n, ones + held
        tail = words[1 - SHINGLE :]
    if not count:
        if not tail:
            return 0
        return xxhash.xxh64_intdigest(b" ".join(tail), SEED)
    return int.from_bytes(np.packbits(2 * ones > count, bitorder="little").tobytes(), "little")


def _printed(batches):
    for batch in batches:
        column = batch.column("text").cast(pa.large_binary()).fill_null(b"")
        prints = np.array([fingerprint(x.tobytes()) for x in arrow_binaries(column)], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view(np.int64))], names=["doc_id", "fp"])


def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fp).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _together(batches):
    """How many fingerprints have both of two bits: one row per pair of bits and task."""
    total = np.zeros((64, 64), np.int64)
    for batch in batches:
        bits = _bits(batch.column("fp").to_numpy()).astype(np.float32)  # counts of a batch are exact
        total += (bits.T @ bits).astype(np.int64)
    i, j = np.triu_indices(64)
    yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "n"])


def group_bits(together: np.ndarray, count: int) -> np.ndarray:
    """The 64 bits in BLOCKS rows: each block starts from the most correlated pair left and takes what correlates most with it."""
    share = together / max(count, 1)
    p = np.diag(share)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    phi = np.abs((share - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(phi, 0)
    left, rows = list(range(64)), []
    for _ in range(BLOCKS):
        free = phi[np.ix_(left, left)]
        a, b = np.unravel_index(int(free.argmax()), free.shape)
        block = sorted({left[a], left[b]}) if a != b else left[:2]
        while len(block) < WIDTH:
            rest = [x for x in left if x not in block]
            block.append(rest[int(phi[np.ix_(rest, block)].sum(1).argmax())])
        left = [x for x in left if x not in block]
        rows.append(sorted(block))
    return np.array(rows)


def block_values(fp: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """[blocks, fingerprints]: the bits of each block as a number."""
    bits = _bits(fp)
    return np.stack([bits[:, row].astype(np.int64) @ (1 << np.arange(len(row), dtype=np.int64)) for row in blocks])


def spheres(counts: np.ndarray) -> np.ndarray:
    """[blocks, TAU + 1, values]: fingerprints at exactly 0 to TAU bits of each value of each block."""
    out = np.zeros((len(counts), TAU + 1, counts.shape[1]), np.float64)
    out[:, 0] = counts
    value = np.arange(counts.shape[1])
    for k in range(WIDTH):
        turned = out[:, :, value ^ (1 << k)]
        out[:, 1:] += turned[:, :-1]
    return out


def flips(width: int, most: int) -> np.ndarray:
    """All numbers of ``width`` bits with at most ``most`` bits set."""
    return np.array([sum(1 << b for b in c) for k in range(most + 1) for c in itertools.combinations(range(width), k)], np.int64)


_FLIPS = {(n, t): flips(n * WIDTH, t) for n in (1, 2) for t in range(TAU + 1)}


def part_costs(values: np.ndarray, part: tuple[int, ...], near: np.ndarray) -> np.ndarray:
    """[thresholds -1 to TAU, fingerprints]: probes and estimated candidates of one part.

    Blocks of a part are taken as independent for the estimate.
    """
    exact = near[part[0]][:, values[part[0]]]
    if len(part) == 2:
        total = max(near[part[0], 0].sum(), 1.0)
        other = near[part[1]][:, values[part[1]]]
        exact = np.stack([sum(exact[e] * other[d - e] for e in range(d + 1)) / total for d in range(TAU + 1)])
    probes = np.array([len(_FLIPS[len(part), t]) for t in range(TAU + 1)], np.float64)
    return np.concatenate([np.zeros((1, exact.shape[1])), np.cumsum(exact, 0) + PROBE * probes[:, None]])


def allot(costs: list[np.ndarray], total: int) -> tuple[np.ndarray, np.ndarray]:
    """Thresholds [parts, fingerprints] of least cost that add up to ``total``, and that cost."""
    count = costs[0].shape[1]
    reach = {0: np.zeros(count)}
    picked = []
    for cost in costs:
        new: dict[int, np.ndarray] = {}
        step: dict[int, np.ndarray] = {}
        for got, before in reach.items():
            for t in range(-1, TAU + 1):
                value = before + cost[t + 1]
                if got + t not in new:
                    new[got + t], step[got + t] = value, np.full(count, t)
                else:
                    better = value < new[got + t]
                    new[got + t] = np.where(better, value, new[got + t])
                    step[got + t] = np.where(better, t, step[got + t])
        reach = new
        picked.append(step)
    at, chosen = np.full(count, total), []
    for step in reversed(picked):
        t = np.zeros(count, np.int64)
        for s, held in step.items():
            t = np.where(at == s, held, t)
        chosen.append(t)
        at = at - t
    return np.stack(chosen[::-1]), reach[total]


def _keyed(blocks: np.ndarray, near_of):
    """Entries and probes of a batch of fingerprints: key, fp, whether it is a probe."""

    def keyed(batches):
        near = near_of()
        for batch in batches:
            every = batch.column("fp").to_numpy()
            for begin in range(0, len(every), 4096):
                fp = every[begin : begin + 4096]
                values = block_values(fp, blocks)
                key_of = lambda part: values[part[0]] if len(part) == 1 else values[part[0]] << WIDTH | values[part[1]]
                plans = [allot([part_costs(values, part, near) for part in index], TAU - len(index) + 1) for index in INDEXES]
                cheapest = np.argmin([cost for _, cost in plans], 0)
                keys, who, probe, number = [], [], [], 0
                for k, index in enumerate(INDEXES):
                    for p, part in enumerate(index):
                        keys.append(key_of(part) | number << 40)
                        who.append(fp)
                        probe.append(np.zeros(len(fp), bool))
                        for t in range(TAU + 1):
                            asks = np.flatnonzero((cheapest == k) & (plans[k][0][p] == t))
                            turns = _FLIPS[len(part), t]
                            keys.append(((key_of(part)[asks, None] ^ turns) | number << 40).ravel())
                            who.append(np.repeat(fp[asks], len(turns)))
                            probe.append(np.ones(len(asks) * len(turns), bool))
                        number += 1
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, who, probe)], names=["key", "fp", "probe"])

    return keyed


def _forest(table: pa.Table) -> pa.Table:
    """Spanning links of the fingerprints of a block: breadth first, each is compared with those not reached yet."""
    fp = np.unique(table.column("fp").to_numpy())
    left = fp.copy()
    a, b = [], []
    while len(left):
        root, left = left[0], left[1:]
        queue = [root]
        while queue and len(left):
            one = queue.pop()
            close = np.bitwise_count((left ^ one).view(np.uint64)) <= TAU
            if close.any():
                met = left[close]
                left = left[~close]
                queue.extend(met)
                a.append(met)
                b.append(np.full(len(met), root))
    none = np.zeros(0, np.int64)
    return pa.Table.from_arrays([pa.array(np.concatenate(a or [none])), pa.array(np.concatenate(b or [none]))], names=["a", "b"])


def _differing(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links_of(prints: DataFrame, space: Workspace) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (column fp) within TAU bits."""
    spark = prints.sparkSession
    rows = prints.mapInArrow(_together, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()  # 2,080 rows
    together = np.zeros((64, 64))
    for i, j, n in rows:
        together[i, j] = together[j, i] = n
    blocks = group_bits(together, prints.count())

    def counted(batches):
        for batch in batches:
            values = block_values(batch.column("fp").to_numpy(), blocks)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(BLOCKS), values.shape[1])), pa.array(values.ravel())], names=["block", "value"])

    # At most BLOCKS * 2^WIDTH counts, whatever the number of fingerprints.
    found = prints.mapInArrow(counted, "block long, value long").groupBy("block", "value").agg(F.count("*").alias("n")).toArrow()
    counts = np.zeros((BLOCKS, 1 << WIDTH))
    counts[found.column("block").to_numpy(), found.column("value").to_numpy()] = found.column("n").to_numpy()
    held = spark.sparkContext.broadcast(counts)
    keyed = space.table(prints.mapInArrow(_keyed(blocks, lambda: spheres(held.value)), "key long, fp long, probe boolean"), "keyed")
    sizes = keyed.groupBy("key").agg(F.count_if(~F.col("probe")).alias("entries"), F.count_if("probe").alias("probes"))
    wide = space.table(sizes.filter(F.col("entries") * F.col("probes") > SMALL).select(F.col("key").alias("wide"), "entries", "probes"), "wide")
    marked = space.table(join_checked(keyed, wide, [("key", "wide")], "left"), "marked")
    few = marked.filter("wide is null")
    asked, there = few.filter("probe").select("key", F.col("fp").alias("a")), few.filter("not probe").select("key", F.col("fp").alias("b"))
    # Every fingerprint asks for itself, so that the lesser of two is enough.
    joined = asked.join(there, (asked["key"] == there["key"]) & (F.col("a") < F.col("b")) & (_differing(F.col("a"), F.col("b")) <= TAU))
    joined = joined.select("a", "b").distinct()
    chunks = lambda c: F.ceil(F.col(c) / CHUNK).cast("int")
    mine, others = F.when(F.col("probe"), chunks("probes")).otherwise(chunks("entries")), F.when(F.col("probe"), chunks("entries")).otherwise(chunks("probes"))
    dealt = marked.filter("wide is not null").withColumn("own", F.pmod(F.xxhash64("fp", "probe"), mine).cast("int")).withColumn("with", F.explode(F.sequence(F.lit(0), others - 1)))
    dealt = dealt.select("key", "fp", F.when(F.col("probe"), F.col("own")).otherwise(F.col("with")).alias("asks"), F.when(F.col("probe"), F.col("with")).otherwise(F.col("own")).alias("holds"))
    met = dealt.groupBy("key", "asks", "holds").applyInArrow(_forest, "a long, b long")
    return space.table(joined.unionByName(met), "links")


def near_components(docs: DataFrame) -> DataFrame:
    """doc_id, fp (signed long) and component_id of every row."""
    space = Workspace(docs.sparkSession, "simhash")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = space.table(docs.select("doc_id", "text").mapInArrow(_printed, f"doc_id {kind}, fp long"), "rows")
    prints = space.table(rows.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")), "prints")
    found = components(links_of(prints.select("fp"), space), space)
    roots = found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())  # roots are no nodes there
    named = prints.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp")).filter("n > 1 or node is not null")
    lows = named.groupBy("root").agg(F.min("low").alias("component"))
    told = space.table(named.join(lows, "root").select(F.col("fp").alias("_fp"), "component"), "told")
    out = join_checked(rows, told, [("fp", "_fp")], "left")
    return out.select("doc_id", "fp", F.when(F.col("_fp").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"))


def op13_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return near_components(docs).select("doc_id", shown.alias("fingerprint"), "component_id")
