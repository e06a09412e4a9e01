"""Benchmark decontamination by edit distance (operator 9).

A document leaks an item if some stretch of its words is within edit distance
``floor(0.2 * words of the item)`` of the whole item.  Words are runs of letters, digits and
non-ASCII characters of the lower-cased text.

The CGK random walk embeds a sequence of words so that a small edit distance becomes a small
Hamming distance: at each step the word under the pointer is emitted, and the pointer advances if
the word's hash bit of that step is set.  Windows of the documents begin at every ``stride``-th
word; those of an item, which reach to its end, at each of its first ``edits + stride`` words, so
some pair is aligned even if the head of the item was cut off.  Items form classes of doubling
length, which set the stride (a sixteenth) and the number of steps.  Coordinates of the embedding
are sampled in runs of ``RUN`` steps: two walks that have met agree over a whole run, so a
run is met far more often than as many scattered coordinates, and long items with many edits are
not lost.  ``WALKS`` walks with ``RUNS`` runs each reach a recall of 0.95 for items of any
length with the greatest allowed number of edits (tested from 1 to 1000 words).  Equal keys give
candidates, whose words get the exact semi-global edit distance.

Windows that cannot hold an item are not embedded: an edit breaks at most two pairs of neighbouring words,
so a leak keeps ``words - 1 - 2 * edits`` pairs of its item, and regions with fewer known pairs are passed over
without loss.

Items are handled in blocks of ``BLOCK_WORDS`` words, built and searched one after the other, so
what the driver holds and what is sent to the workers (about 20 MB) has a fixed bound however many
items there are; each block reads the documents once.

Defined results: null or wordless documents and items never match.  Repeated rows each get their
own results.  Items of equal text all match.  Items without an id match like others, under a null
item_id.  Columns other than ids and texts are not touched; names starting with ``_dc_`` are refused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Workspace, arrow_text, firsts, join_checked, mix, pieces, refuse, separators, words_of

RATE = 0.2
WALKS, RUNS, RUN = 3, 24, 6
BLOCK_WORDS = 1 << 16
PIECE = 1 << 20  # bytes of text that are searched at a time
AT_ONCE, REGIONS = 1 << 18, 1 << 10  # candidates that are sifted, and compared, at a time
WINDOWS = 1 << 12  # windows that walk at a time

_ASCII_BETWEEN = bytes(x for x in range(128) if not chr(x).isalnum())
_INSIDE = separators(_ASCII_BETWEEN)


def edits_of(words):
    """The most edits of an item of so many words."""
    return (RATE * words).astype(np.int64) if isinstance(words, np.ndarray) else int(RATE * words)


class Walk:
    """The embedding of one class: items of 2^power to 2^(power + 1) - 1 words."""

    def __init__(self, power: int):
        self.power = power
        self.stride = max(1, (1 << power) // 16)
        self.run = min(RUN, 1 << power)
        # The pointer advances at every other step: these steps end near the end of the longest item.
        steps = max(1, int(1.7 * (2 << power)) - self.run) if power > 2 else 2 << power
        rng = np.random.default_rng([9, power])
        # One run begins in each of RUNS equal parts; the first always at the first step.
        edges = np.linspace(0, steps, min(RUNS, steps) + 1)[:-1]
        jitter = rng.random((WALKS, len(edges))) * (steps / len(edges))
        self.begins = [np.unique(np.append(0, (edges + x).astype(int))) for x in jitter]
        self.odd = rng.integers(1, 1 << 62, (WALKS, steps + self.run + 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.place = rng.integers(1, 1 << 62, self.run, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def runs(self, word: np.ndarray, begin: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For every run of every walk: its key, and its first and last place, of each window."""
        padded = np.append(word, np.zeros(self.odd.shape[1], np.uint64))
        for walk, begins in enumerate(self.begins):
            at, open_runs = begin.copy(), {}
            wanted = set(begins.tolist())
            for step in range(int(begins[-1]) + self.run):
                seen = padded[at]
                if step in wanted:
                    open_runs[step] = (np.full(len(begin), (walk << 32) + step, np.uint64), at.copy())
                for first in list(open_runs):
                    key, where = open_runs[first]
                    key += seen * self.place[step - first]
                    if step - first == self.run - 1:
                        yield mix(key), where, at
                        del open_runs[first]
                at = at + ((seen * self.odd[walk, step]) >> np.uint64(63)).astype(np.int64)


def _pairs(word: np.ndarray) -> np.ndarray:
    return mix(word[:-1]) + word[1:]


def _marks(key: np.ndarray, bits: int) -> np.ndarray:
    """A table of bits with the places of some keys set."""
    held = np.zeros(1 << bits, bool)
    held[mix(key) >> np.uint64(64 - bits)] = True
    return held


class Items:
    """A block of items with the keys of their windows, for the workers."""

    def __init__(self, ids: list, words: list[np.ndarray]):
        self.ids, self.words = ids, words
        self.size = np.array([len(x) for x in words], np.int64)
        self.known = np.zeros((len(words), 1024), bool)  # by the first ten bits of a word's hash
        for i, x in enumerate(words):
            self.known[i, x >> np.uint64(54)] = True
        self.classes: dict[int, tuple] = {}
        for power in sorted({len(x).bit_length() - 1 for x in words if len(x)}):
            walk = Walk(power)
            members = np.array([i for i, x in enumerate(words) if len(x).bit_length() - 1 == power])
            flat = np.concatenate([words[i] for i in members])
            size = self.size[members]
            base = np.cumsum(size) - size
            offsets = np.minimum(edits_of(size) + walk.stride, size)
            item = np.repeat(np.arange(len(members)), offsets)
            begin = base[item] + np.arange(len(item)) - np.repeat(np.cumsum(offsets) - offsets, offsets)
            keys, owners, places = [], [], []
            for key, first, last in walk.runs(flat, begin):
                inside = last < base[item] + size[item]
                keys.append(key[inside])
                owners.append(members[item[inside]])
                places.append((first - base[item])[inside])
            key, owner, place = np.concatenate(keys), np.concatenate(owners), np.concatenate(places)
            order = np.lexsort((place, owner, key))
            key, owner, place = key[order], owner[order], place[order]
            new = np.append(True, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1]) | (place[1:] != place[:-1]))
            key, owner, place = key[new], owner[new].astype(np.int32), place[new].astype(np.int32)
            bits = max(12, int(8 * len(key)).bit_length())
            pairs = [_pairs(words[i]) for i in members]
            pair_bits = max(12, int(16 * sum(map(len, pairs))).bit_length())
            self.classes[power] = (walk, np.unique(size), pair_bits, _marks(np.concatenate(pairs), pair_bits), bits, _marks(key, bits), key, owner, place)


def edit_distances(regions: np.ndarray, words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Least edit distance of each item, a row of ``words`` with its size, to any stretch of its region.

    Sizes must not grow from row to row: the rows that a word is left of are then the first ones.
    """
    columns = np.arange(regions.shape[1] + 1, dtype=np.int32)
    row = np.zeros((len(regions), len(columns)), np.int32)
    for j in range(int(sizes[0]) if len(sizes) else 0):
        some = int(np.searchsorted(-sizes, -j, "left"))
        old = row[:some]
        new = np.empty_like(old)
        new[:, 0] = j + 1
        np.minimum(old[:, 1:] + 1, old[:, :-1] + (regions[:some] != words[:some, j, None]), out=new[:, 1:])
        new -= columns
        np.minimum.accumulate(new, axis=1, out=new)
        np.add(new, columns, out=old)
    return row.min(1)


def _able(pair: np.ndarray, grid: np.ndarray, held: np.ndarray, bits: int, sizes: np.ndarray, stride: int) -> np.ndarray:
    """Which windows lie where enough known pairs of words do for an item of one of these sizes."""
    known = np.append(0, np.cumsum(held[mix(pair) >> np.uint64(64 - bits)]))

    def holds(grid, words, edits, needed):
        low = np.maximum(grid - 2 * edits - stride, 0)
        high = np.minimum(grid + words + edits, len(pair))
        return known[high] - known[np.minimum(low, high)] >= needed

    needed = sizes - 1 - 2 * edits_of(sizes)
    grid = grid[holds(grid, int(sizes[-1]), edits_of(int(sizes[-1])), int(needed.min()))]
    able = np.zeros(len(grid), bool)
    for words, least in zip(sizes.tolist(), needed.tolist()):
        able |= holds(grid, words, edits_of(words), least)
    return grid[able]


def _candidates(batch_word: np.ndarray, row: np.ndarray, items: Items):
    """Arrays of item, row and place where the item may begin, of runs that are met."""
    begin = firsts(row)
    place = np.arange(len(row)) - np.repeat(begin, np.diff(np.append(begin, len(row))))
    pair = _pairs(batch_word)
    for walk, sizes, pair_bits, pair_held, bits, held, keys, item, offset in items.classes.values():
        grid = _able(pair, np.flatnonzero(place % walk.stride == 0), pair_held, pair_bits, sizes, walk.stride)
        for part in range(0, len(grid), WINDOWS):
            met = []
            for key, first, last in walk.runs(batch_word, grid[part : part + WINDOWS]):
                hit = np.flatnonzero(held[mix(key) >> np.uint64(64 - bits)] & (last < len(row)))
                low, high = np.searchsorted(keys, key[hit], "left"), np.searchsorted(keys, key[hit], "right")
                same = high > low
                met.append((first[hit[same]], low[same], (high - low)[same]))
            at, low, count = map(np.concatenate, zip(*met))
            for a, b in pieces(np.append(0, np.cumsum(count)), AT_ONCE):
                n = count[a:b]
                which = np.repeat(low[a:b] - np.cumsum(n) + n, n) + np.arange(n.sum())
                where = np.repeat(at[a:b], n)
                yield item[which].astype(np.int64), row[where], where - offset[which]


def _search(batch_word: np.ndarray, row: np.ndarray, items: Items):
    """Distance of every item that is near some stretch of a row's words, by (row, item)."""
    best: dict[tuple[int, int], int] = {}
    code = (batch_word >> np.uint64(54)).astype(np.int64)
    for item, home, at in _candidates(batch_word, row, items):
        most = edits_of(items.size)[item]
        # An alignment within `most` edits that holds the run begins within `most` of `at`,
        # which is rounded down to a multiple of `most`.
        grid = np.maximum(most, 1)
        at = at // grid * grid
        width = items.size[item] + 2 * most + grid - 1
        order = np.lexsort((at, home, item, -width))
        item, home, at, most, width = item[order], home[order], at[order], most[order], width[order]
        new = np.append(True, (item[1:] != item[:-1]) | (home[1:] != home[:-1]) | (at[1:] != at[:-1]))
        item, home, at, most, width = item[new], home[new], at[new], most[new], width[new]
        # Within `most` edits, all but `most` of an item's words are matched by a word of the region.
        matched, of, begin = np.zeros(len(item), np.int64), item * 1024, at - most
        for j in range(int(width[0])):
            m = int(np.searchsorted(-width, -j, "left"))  # those that are wider than j
            matched[:m] += items.known.ravel()[of[:m] + code[np.clip(begin[:m] + j, 0, len(row) - 1)]]
        able = np.flatnonzero(matched >= items.size[item] - most)
        able = able[np.argsort(-items.size[item[able]], kind="stable")]
        for part in np.array_split(able, len(able) // REGIONS + 1):
            size, span = items.size[item[part]], int(width[part].max(initial=0))
            words = np.zeros((len(part), int(size.max(initial=0))), np.uint64)
            for k, i in enumerate(item[part].tolist()):
                words[k, : len(items.words[i])] = items.words[i]
            index = begin[part, None] + np.arange(span)
            inside = (index >= 0) & (index < len(row)) & (np.arange(span) < width[part, None])
            index = np.clip(index, 0, len(row) - 1)
            region = np.where(inside & (row[index] == home[part, None]), batch_word[index], np.uint64(0))
            distance = edit_distances(region, words, size)
            for k in np.flatnonzero(distance <= most[part]).tolist():
                key, d = (int(home[part[k]]), int(item[part[k]])), int(distance[k])
                best[key] = min(d, best.get(key, d))
    return best


def _searcher(items: Items):
    def search(batches):
        for batch in batches:
            data, ends = arrow_text(batch.column("_dc_text"))
            rows, ids, distances, sizes = [], [], [], []
            for a, b in pieces(ends, PIECE):
                base = ends[a]
                _, row, word = words_of(data[base : ends[b]], ends[a : b + 1] - base, _INSIDE)
                if len(row):
                    for (r, i), d in _search(word, row, items).items():
                        rows.append(r + a)
                        ids.append(items.ids[i])
                        distances.append(d)
                        sizes.append(len(items.words[i]))
            keep = [batch.column(x).take(pa.array(rows, pa.int64())) for x in ("doc_id", "_dc_x")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(ids, pa.int64()), pa.array(distances, pa.int32()), pa.array(sizes, pa.int32())],
                names=["doc_id", "_dc_x", "item_id", "distance", "item_words"],
            )

    return search


def item_blocks(benchmark: DataFrame, most: int = BLOCK_WORDS):
    """Blocks of items (id, words), each of at most ``most`` words or one item."""
    ids, words, held = [], [], 0
    for item_id, text in benchmark.select("item_id", F.lower("text")).sort("item_id", F.lower("text")).toLocalIterator():
        data = np.frombuffer((text or "").encode(), np.uint8)
        _, _, word = words_of(data, np.array([0, len(data)]), _INSIDE)
        if held and held + len(word) > most:
            yield Items(ids, words)
            ids, words, held = [], [], 0
        ids.append(item_id)
        words.append(word)
        held += len(word)
    if held:
        yield Items(ids, words)


HITS = "doc_id {0}, _dc_x long, item_id long, distance int, item_words int"


def leaks(docs: DataFrame, benchmark: DataFrame, space: Workspace | None = None, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, _dc_x, item_id, distance, item_words) of every leak; _dc_x is xxhash64(text).

    The hits of each block of items are a written table before the next block is built.
    """
    space = space or Workspace(docs.sparkSession, "leaks")
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.xxhash64("text").alias("_dc_x"), F.lower("text").alias("_dc_text"))
    out = docs.sparkSession.createDataFrame([], HITS.format(kind))
    for k, items in enumerate(item_blocks(benchmark, block_words)):
        out = out.unionByName(space.table(texts.mapInArrow(_searcher(items), HITS.format(kind)), f"block{k}"))
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that leak no item, with all their columns."""
    refuse(docs, "_dc_")
    space = Workspace(docs.sparkSession, "clean")
    bad = leaks(docs, benchmark, space).select(F.col("doc_id").alias("_dc_id"), F.col("_dc_x").alias("_dc_lx")).distinct()
    bad = space.table(bad, "bad")
    named = docs.withColumn("_dc_x", F.xxhash64("text"))
    return join_checked(named, bad, [("doc_id", "_dc_id"), ("_dc_x", "_dc_lx")], "left_anti").select(*docs.columns)


def op9_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("_dc_x")
