"""N-gram Jaccard join with Bayesian pruning of candidates (operator 3).

Similarity is the Jaccard index of the sets of five-word shingles of two texts; words are
``[^\\x20\\x09-\\x0D]+``.  A text of one to four words is one shingle.  Steps:

1. one pass over the texts gives each a 128-bit-derived text id and MinHash values; equal
   word sequences collapse into one text with a count, so copies are never paired;
2. banded MinHash buckets give candidates.  Buckets of up to ``SMALL`` texts emit pairs,
   larger ones are compared in blocks of ``CHUNK`` x ``CHUNK`` texts that return only
   counts and spanning links, never pairs;
3. MinHash values are compared a few at a time; a pair is dropped as soon as the posterior
   probability (uniform prior) that it reaches the threshold is below ``TOLERANCE``;
4. survivors are verified exactly on their shingle sets;
5. classes are the connected components of links, found by alternating star contraction on
   written tables.

A pair at exactly 0.8 shares no band with probability (1 - 0.8^4)^30 = 1.4e-7.

Defined results: a null or wordless text has no shingle, is linked to nothing and is its own
class.  Rows with equal words, repeated rows included, are linked to each other.  ``n_links``
counts other rows; ``class_id`` is the smallest non-null doc_id of the class (null if there is
none).  Extra columns are not touched; names starting with ``_nj_`` are refused.  An empty table
gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Workspace, arrow_binaries, arrow_text, firsts, join_checked, mix, pieces, powers, refuse, separators, words_of

WORDS = 5
THRESHOLD = 0.8
TOLERANCE = 1e-6
ROWS, BANDS = 4, 30
HASHES = ROWS * BANDS
STEP = 8
SMALL, CHUNK = 32, 1024
BLOCK_BYTES = 2 << 20
SLACK = 1e-6  # counts are whole numbers: only keeps pairs at exactly the threshold from rounding

_INSIDE = separators()
_rng = np.random.default_rng(3)
_FACTORS = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _rng.integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles_of(row: np.ndarray, word: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every shingle; rows of fewer words than ``size`` have one."""
    count = len(word)
    if not count:
        return row, word
    begin = firsts(row)
    length = np.diff(np.append(begin, count))
    left = np.repeat(begin + length, length) - np.arange(count)  # words from here to the row's end
    total = np.zeros(count, np.uint64)
    for k in range(min(size, count)):
        there = np.zeros(count, np.uint64)
        there[: count - k] = word[k:] * _PLACE[k]
        total += np.where(left > k, there, np.uint64(0))
    first = np.zeros(count, bool)
    first[begin] = True
    keep = (left >= size) | (first & (left < size))
    return row[keep], mix(total[keep])


def _signed(batches):
    """Text id, number of shingle positions and MinHash values of each row."""
    for batch in batches:
        data, ends = arrow_text(batch.column("_nj_text"))
        count = batch.num_rows
        tid, n, sig = np.zeros(count, np.uint64), np.zeros(count, np.int64), np.zeros((count, HASHES), np.uint32)
        for a, b in pieces(ends):
            base = ends[a]
            _, row, word = words_of(data[base : ends[b]], ends[a : b + 1] - base, _INSIDE)
            if not len(row):
                continue
            begin = firsts(row)
            place = np.arange(len(row)) - np.repeat(begin, np.diff(np.append(begin, len(row))))
            of = row[begin] + a
            one = np.add.reduceat(word * powers(int(place.max()) + 1)[place], begin)
            two = np.add.reduceat(mix(word ^ np.uint64(77)) * (place.astype(np.uint64) * np.uint64(2) + np.uint64(1)), begin)
            tid[of] = mix(one ^ mix(two))
            row, shingle = shingles_of(row, word)
            begin = firsts(row)
            n[of] = np.diff(np.append(begin, len(row)))
            for k in range(HASHES):
                sig[of, k] = np.minimum.reduceat(shingle * _FACTORS[k], begin) >> np.uint64(32)
        has = n > 0
        flat = pa.py_buffer(np.ascontiguousarray(sig).tobytes())
        values = pa.Array.from_buffers(pa.binary(HASHES * 4), count, [None, flat]).cast(pa.binary())
        keep = [batch.column(name) for name in ("doc_id", "_nj_x")]
        yield pa.RecordBatch.from_arrays(
            [*keep, pa.array(tid.view(np.int64), mask=~has), pa.array(n), values], names=["doc_id", "_nj_x", "tid", "n", "sig"]
        )


def _shingle_sets(batches):
    for batch in batches:
        data, ends = arrow_text(batch.column("_nj_text"))
        out = []
        for a, b in pieces(ends):
            base = ends[a]
            _, row, word = words_of(data[base : ends[b]], ends[a : b + 1] - base, _INSIDE)
            row, shingle = shingles_of(row, word)
            cuts = np.searchsorted(row, np.arange(b - a + 1))
            out += [np.unique(shingle[x:y]).tobytes() for x, y in zip(cuts[:-1], cuts[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("tid"), pa.array(out, pa.binary())], names=["tid", "shingles"])


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """For each number of compared values, the fewest matches with which a pair stays.

    With a uniform prior, m matches in k give Beta(m + 1, k - m + 1); its mass above the
    threshold is a binomial tail: P(J >= t) = P(Binomial(k + 1, t) <= m).
    """
    out = {}
    for k in range(STEP, HASHES + 1, STEP):
        p, below, m = (1 - threshold) ** (k + 1), 0.0, 0
        while (below := below + p) < tolerance:
            p *= (k + 1 - m) / (m + 1) * threshold / (1 - threshold)
            m += 1
        out[k] = m
    return out


def bayes_alive(left: np.ndarray, right: np.ndarray, need: dict[int, int]) -> np.ndarray:
    """Which rows of two arrays of MinHash values survive the incremental comparison."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    for k in range(0, HASHES, STEP):
        matches += (left[alive, k : k + STEP] == right[alive, k : k + STEP]).sum(1)
        stays = matches >= need[k + STEP]
        alive, matches = alive[stays], matches[stays]
    return alive


def _values(column) -> np.ndarray:
    """The MinHash values of an Arrow column of signatures, as a view."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, HASHES), np.uint32)
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    first = int(np.frombuffer(offsets, np.int64)[column.offset])
    return np.frombuffer(data, np.uint32, len(column) * HASHES, first).reshape(-1, HASHES)


def _pruner(threshold: float, tolerance: float):
    need = least_matches(threshold, tolerance)

    def prune(batches):
        for batch in batches:
            a, b = _values(batch.column("sig_a")), _values(batch.column("sig_b"))
            wide = batch.column("wide_a").to_numpy(zero_copy_only=False).astype(np.int64)
            elsewhere = np.zeros(len(a), bool)  # pairs that meet in a large bucket are counted there
            if wide.any():
                for band in range(BANDS):
                    same = (a[:, band * ROWS : (band + 1) * ROWS] == b[:, band * ROWS : (band + 1) * ROWS]).all(1)
                    elsewhere |= same & ((wide >> band) & 1 > 0)
            mine = np.flatnonzero(~elsewhere)
            yield batch.select(["a", "b"]).take(pa.array(mine[bayes_alive(a[mine], b[mine], need)]))

    return prune


def _verifier(threshold: float):
    def verify(batches):
        for batch in batches:
            good = []
            for i, (x, y) in enumerate(zip(arrow_binaries(batch.column("set_a")), arrow_binaries(batch.column("set_b")))):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if min(len(x), len(y)) >= threshold * max(len(x), len(y)) - SLACK:
                    same = len(np.intersect1d(x, y, assume_unique=True))
                    if same >= threshold * (len(x) + len(y) - same) - SLACK:
                        good.append(i)
            yield batch.select(["a", "b"]).take(pa.array(good, pa.int64()))

    return verify


def _blocks(threshold: float, tolerance: float):
    need = least_matches(threshold, tolerance)

    def block(table: pa.Table) -> pa.Table:
        """Compare two chunks of one bucket (or one with itself): counts and spanning links."""
        band, low, high = (table.column(x)[0].as_py() for x in ("band", "low", "high"))
        tid, own, wide, copies = (table.column(x).to_numpy() for x in ("tid", "chunk", "wide", "m"))
        sig, shingles = _values(table.column("sig")), table.column("shingles").combine_chunks()
        shaped = lambda *columns: pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["tid", "links", "root"])
        one, two = np.flatnonzero(own == low), np.flatnonzero(own == high)
        found_a, found_b = [], []
        for i in one:
            other = two[two > i] if low == high else two
            first = np.ones(len(other), bool)  # counted in the first large bucket that both share
            for earlier in range(band):
                if wide[i] >> earlier & 1:
                    cut = slice(earlier * ROWS, (earlier + 1) * ROWS)
                    first &= ~(sig[other, cut] == sig[i, cut]).all(1)
            other = other[first]
            other = other[bayes_alive(np.broadcast_to(sig[i], (len(other), HASHES)), sig[other], need)]
            found_a.append(np.full(len(other), i))
            found_b.append(other)
        a, b = np.concatenate(found_a or [[]]).astype(int), np.concatenate(found_b or [[]]).astype(int)
        if not len(a):
            return shaped([], [], [])
        used = np.unique(np.append(a, b))
        place = np.zeros(len(tid), int)
        place[used] = np.arange(len(used))
        sets = [x.view(np.uint64) for x in arrow_binaries(shingles.take(pa.array(used)))]
        size = np.array([len(x) for x in sets])
        # Exact sizes of intersections: products of slices of the incidence matrix.
        _, code = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(used)), size)
        by = np.argsort(code, kind="stable")
        code, owner = code[by], owner[by]
        shared = np.zeros((len(used), len(used)), np.float32)  # counts below 2^24 are exact
        for begin in range(0, int(code[-1]) + 1, 4096):
            x, y = np.searchsorted(code, [begin, begin + 4096])
            held = np.zeros((len(used), 4096), np.float32)
            held[owner[x:y], code[x:y] - begin] = 1
            shared += held @ held.T
        same = shared[place[a], place[b]]
        good = same >= threshold * (size[place[a]] + size[place[b]] - same) - SLACK
        a, b = a[good], b[good]
        links = np.bincount(a, copies[b], len(tid)) + np.bincount(b, copies[a], len(tid))
        root = np.arange(len(tid))
        while True:  # least label along links, with jumps
            new = root.copy()
            np.minimum.at(new, a, root[b])
            np.minimum.at(new, b, root[a])
            new = new[new]
            if (new == root).all():
                break
            root = new
        keep = np.flatnonzero(links > 0)
        return shaped(tid[keep], links[keep].astype(np.int64), tid[root[keep]])

    return block


def components(edges: DataFrame, space: Workspace, name: str = "stars") -> DataFrame:
    """(node, root) of every node of the edges (a, b): alternating large and small stars.

    The root is the least node of the component.  Every round is a written table; nothing but
    its number of rows and a checksum reaches the driver.
    """
    now = space.table(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}0")
    seen, k = None, 0
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("low").alias("v")), F.struct("u", F.col("low").alias("v")))).alias("e"))
        k += 1
        now = space.table(small.select("e.u", "e.v").filter("u <> v").distinct(), f"{name}{k}")
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        space.drop(f"{name}{k - 1}")
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state


def _bands(sig: Column) -> Column:
    return F.array(*[F.struct(F.lit(k).alias("band"), F.xxhash64(F.substring(sig, k * ROWS * 4 + 1, ROWS * 4), F.lit(k)).alias("key")) for k in range(BANDS)])


def chunks_of(size: Column, total: Column) -> Column:
    """Chunks of a bucket of ``size`` texts with ``total`` shingles: each text is copied as often, whatever the longest has."""
    return F.greatest(F.ceil(size / CHUNK), F.ceil(total * 8 / BLOCK_BYTES)).cast("int")


def near_classes(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, n_links, and the row that leads the class.

    ``_nj_x`` is xxhash64 of the row's own text; ``leads`` tells whether the row has the
    smallest (doc_id, text hash) of its class.
    """
    space = Workspace(docs.sparkSession, "near")
    texts = docs.select("doc_id", F.xxhash64("text").alias("_nj_x"), F.col("text").alias("_nj_text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = space.table(texts.mapInArrow(_signed, f"doc_id {kind}, _nj_x long, tid long, n long, sig binary"), "rows")
    lead = F.min(F.struct("doc_id", "_nj_x"))
    reps = space.table(
        rows.filter("tid is not null").groupBy("tid").agg(F.count("*").alias("m"), F.first("n").alias("n"), lead.alias("lead"), F.min("doc_id").alias("low"), F.first("sig").alias("sig")),
        "reps",
    )
    entries = reps.select("tid", "n", F.explode(_bands(F.col("sig"))).alias("e")).select("tid", "n", "e.band", "e.key")
    buckets = space.table(
        entries.groupBy("key").agg(F.count("*").alias("size"), F.min("tid").alias("a"), F.max("tid").alias("b"), F.sum("n").alias("total")).filter("size >= 2"), "buckets"
    )
    several = buckets.filter("size >= 3").select("key", "size", "total")
    members = space.table(entries.drop("n").join(several, "key"), "members")
    few = members.filter(F.col("size") <= SMALL)
    pairs = (
        few.select("key", F.col("tid").alias("a")).join(few.select("key", F.col("tid").alias("b")), "key").filter("a < b").select("a", "b")
        .unionByName(buckets.filter("size = 2").select("a", "b")).distinct()
    )
    pairs = space.table(pairs, "pairs")
    wide = members.filter(F.col("size") > SMALL)
    masks = wide.groupBy("tid").agg(F.bit_or(F.expr("shiftleft(1L, band)")).alias("wide"))
    named = pairs.select(F.explode(F.array("a", "b")).alias("tid")).unionByName(wide.select("tid")).distinct()
    cand = space.table(reps.drop("low").join(space.table(named, "named"), "tid").join(masks, "tid", "left").fillna({"wide": 0}), "cand")
    signed = lambda x: cand.select(F.col("tid").alias(x), F.col("sig").alias(f"sig_{x}"), F.col("wide").alias(f"wide_{x}"))
    alive = space.table(
        pairs.join(signed("a"), "a").join(signed("b").drop("wide_b"), "b").mapInArrow(_pruner(threshold, tolerance), "a long, b long"), "alive"
    )
    # Texts of what is still a candidate, each read once.
    needed = alive.select(F.explode(F.array("a", "b")).alias("tid")).unionByName(cand.filter("wide <> 0").select("tid")).distinct()
    leads = space.table(cand.join(needed, "tid").select("tid", F.col("lead.doc_id").alias("_nj_id"), F.col("lead._nj_x").alias("_nj_lx")), "leads")
    found = join_checked(texts, leads, [("doc_id", "_nj_id"), ("_nj_x", "_nj_lx")])
    sets = found.select("tid", "_nj_text").mapInArrow(_shingle_sets, "tid long, shingles binary")
    repeated = rows.groupBy("doc_id", "_nj_x").count().filter("count > 1").limit(1).count() > 0
    sets = space.table(sets.dropDuplicates(["tid"]) if repeated else sets, "sets")
    named_set = lambda x: sets.select(F.col("tid").alias(x), F.col("shingles").alias(f"set_{x}"))
    links = space.table(alive.join(named_set("a"), "a").join(named_set("b"), "b").mapInArrow(_verifier(threshold), "a long, b long"), "links")
    dealt = (
        wide.withColumn("chunks", chunks_of(F.col("size"), F.col("total"))).withColumn("chunk", F.pmod(F.xxhash64(F.lit("chunk"), "tid"), F.col("chunks")).cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("key", "band", "tid", "chunk", F.least("chunk", "with").alias("low"), F.greatest("chunk", "with").alias("high"))
        .join(cand.select("tid", "sig", "wide", "m"), "tid").join(sets, "tid")
    )
    blocks = space.table(dealt.groupBy("key", "low", "high").applyInArrow(_blocks(threshold, tolerance), "tid long, links long, root long"), "blocks")
    edges = links.unionByName(blocks.select(F.col("tid").alias("a"), F.col("root").alias("b")))
    roots = components(edges, space)
    copies = reps.select(F.col("tid"), "m")
    partners = (
        links.join(copies.withColumnRenamed("tid", "b"), "b").select(F.col("a").alias("tid"), F.col("m").alias("links"))
        .unionByName(links.join(copies.withColumnRenamed("tid", "a"), "a").select(F.col("b").alias("tid"), F.col("m").alias("links")))
        .unionByName(blocks.select("tid", "links")).groupBy("tid").agg(F.sum("links").alias("links"))
    )
    grouped = (
        reps.select("tid", "m", "lead", "low").join(roots.withColumnRenamed("node", "tid"), "tid", "left").join(partners, "tid", "left")
        .withColumn("root", F.coalesce("root", "tid")).withColumn("links", F.coalesce("links", F.lit(0)) + F.col("m") - 1)
        .filter("links > 0")
    )
    grouped = space.table(grouped, "grouped")
    classes = grouped.groupBy("root").agg(F.min("lead").alias("class_lead"), F.min("low").alias("class_low"))
    told = space.table(grouped.join(classes, "root").select(F.col("tid").alias("_nj_tid"), "links", "class_lead", "class_low"), "told")
    space.drop("reps", "buckets", "members", "pairs", "named", "cand", "alive", "leads", "sets", "links", "blocks", "grouped")
    out = join_checked(rows.select("doc_id", "_nj_x", "tid"), told, [("tid", "_nj_tid")], "left")
    alone = F.col("links").isNull()
    return out.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_low")).alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        "_nj_x",
        (alone | (F.col("class_lead.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("class_lead._nj_x") == F.col("_nj_x")))).alias("leads"),
    )


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The documents without all but one of each class: that with the least (doc_id, text hash) stays.

    Of repeated rows with words one stays, too.  Texts without words all stay.
    """
    refuse(docs, "_nj_")
    space = Workspace(docs.sparkSession, "kept")
    drop = near_classes(docs).filter("not leads or n_links > 0").groupBy("doc_id", "_nj_x").agg(F.count("*").alias("_nj_n"), F.max("leads").alias("_nj_leads"))
    drop = space.table(drop.filter("not _nj_leads or _nj_n > 1").withColumnRenamed("doc_id", "_nj_id").withColumnRenamed("_nj_x", "_nj_lx"), "drop")
    named = docs.withColumn("_nj_x", F.xxhash64("text"))
    out = join_checked(named, drop, [("doc_id", "_nj_id"), ("_nj_x", "_nj_lx")], "left")
    kept = out.filter("_nj_n is null").select(*docs.columns)
    if drop.filter("_nj_leads").limit(1).count():  # repeated rows: they are equal in doc_id and text
        again = out.filter("_nj_leads").dropDuplicates(["doc_id", "_nj_x"]).select(*docs.columns)
        kept = kept.unionByName(again)
    return kept


def op3_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_classes(docs).select("doc_id", "class_id", "n_links")


ORACLE = r"""
with recursive d as (select doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w from documents),
s as (select doc_id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                 when len(w) > 0 then [array_to_string(w, ' ')] end) as sh from d),
u as (select distinct doc_id, sh from s),
n as (select doc_id, count(*) as n from u group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as k from u a join u b on a.sh = b.sh and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from p join n x on a = x.doc_id join n y on b = y.doc_id where 5 * k >= 4 * (x.n + y.n - k)),
e as (select a, b from l union all select b, a from l),
r as (select doc_id as node, doc_id as root from documents union select e.b, r.root from r join e on r.node = e.a),
c as (select node, min(root) as class_id from r group by node),
k as (select a, count(*) as n_links from e group by a)
select doc_id, class_id, coalesce(n_links, 0)::bigint as n_links
from documents join c on doc_id = c.node left join k on doc_id = k.a
"""
