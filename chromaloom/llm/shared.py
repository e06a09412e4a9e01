"""Helpers shared by the training-data operators.

``join_checked`` broadcasts a side only after its rows were counted.
``arrow_text`` and ``words_of`` turn an Arrow string column into word tables with numpy,
without making a Python object for each word.
"""

from __future__ import annotations

import functools
import operator
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.tables import Workspace, shared_dir

__all__ = ["Workspace", "shared_dir"]

#: Most rows of a side that is broadcast; with rows of at most 64 bytes that is 16 MB.
BROADCAST_ROWS = 250_000

#: Logarithm of the rows of the filter that joins beyond that sift with: 2^18 rows of 64 bits, 4 MB.
SIFT = 18

#: Bytes that end a word: U+0020 and U+0009 to U+000D.
SPACES = b" \t\n\x0b\x0c\r"


def refuse(docs: DataFrame, prefix: str) -> None:
    """Columns of the input must not clash with those that an operator adds."""
    clash = [c for c in docs.columns if c.lower().startswith(prefix)]
    if clash:
        raise ValueError(f"columns {clash} clash: names starting with {prefix} are reserved")


def join_checked(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], how: str = "inner", rows: int | None = None) -> DataFrame:
    """Null-safe join on pairs of column names that broadcasts ``right`` only if it was counted to be small.

    ``right`` is a written table, so that the count (or ``rows``, if its size is told by something
    else) reads only Parquet footers.  Beyond ``BROADCAST_ROWS`` the join is shuffled, and
    adaptive execution splits its skewed partitions; rows of ``left`` that a filter of fixed size shows to
    have no partner stay out of the shuffle.  ``how`` is inner, left or left_anti.
    """
    match = lambda x: functools.reduce(operator.and_, [x[a].eqNullSafe(right[b]) for a, b in pairs])
    if (right.count() if rows is None else rows) <= BROADCAST_ROWS:
        return left.join(F.broadcast(right), match(left), how)
    place = lambda names: F.xxhash64(*names).bitwiseAND((64 << SIFT) - 1)
    words = lambda h: F.shiftright(h, 6).cast("int")
    mine, theirs = place([a for a, _ in pairs]), place([b for _, b in pairs])
    bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(63).cast("int"))
    table = right.groupBy(words(theirs).alias("_sift_word")).agg(F.bit_or(bit(theirs)).alias("_sift_bits"))  # at most 2^SIFT rows
    marked = left.withColumn("_sift_at", words(mine)).join(F.broadcast(table), F.col("_sift_at") == F.col("_sift_word"), "left")
    maybe = F.coalesce(F.col("_sift_bits").bitwiseAND(bit(mine)) != 0, F.lit(False))
    some = marked.filter(maybe).select(*left.columns)
    met = some.join(right, match(some), how)
    if how == "inner":
        return met
    rest = marked.filter(~maybe).select(*left.columns)
    lacking = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields] if how == "left" else []
    return met.unionByName(rest.select("*", *lacking))


def arrow_text(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string column, and where each row starts (one more than rows)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = int(ends[0]) if len(ends) else 0
    return data[first : int(ends[-1]) if len(ends) else 0], ends - first


def arrow_binaries(column) -> list[np.ndarray]:
    """The bytes of each row of an Arrow binary column, as views that copy nothing."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return [data[a:b] for a, b in zip(ends[:-1], ends[1:])]


def pieces(ends: np.ndarray, most: int = 1 << 18):
    """Ranges of rows with about ``most`` bytes, at least one row each."""
    rows, at = len(ends) - 1, 0
    while at < rows:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
        yield at, min(to, rows)
        at = min(to, rows)


_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def parts_of(text: bytes, most: int = 1 << 18):
    """A long text in parts of about ``most`` bytes that end at blanks: no word is cut."""
    at = 0
    while at < len(text):
        found = _BLANK.search(text, at + most) if len(text) - at > most else None
        to = found.end() if found else len(text)
        yield text[at:to]
        at = to


_rng = np.random.default_rng(20)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """Powers of an odd number, modulo 2^64."""
    global _powers
    if len(_powers) < n:
        step = np.full(max(n, 1024), 0xD6E8FEB86659FD93, np.uint64)
        step[0] = 1
        _powers = np.cumprod(step)
    return _powers[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def separators(text: bytes | None = None) -> np.ndarray:
    """Table of the bytes that belong to words: all but SPACES, or else all but those given."""
    table = np.ones(256, bool)
    table[list(SPACES if text is None else text)] = False
    return table


def words_of(data: np.ndarray, ends: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, row and 64-bit hash of every word of some rows' bytes."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    held = inside[data]
    before = np.empty_like(held)
    before[0] = False
    before[1:] = held[:-1]
    edges = ends[:-1]
    before[edges[edges < len(data)]] = False
    starts = np.flatnonzero(held & ~before)
    if not len(starts):
        return starts, starts, np.zeros(0, np.uint64)
    lengths = np.diff(np.append(starts, len(data)))
    at = np.arange(starts[0], len(data), dtype=np.int32) - np.repeat(starts.astype(np.int32), lengths)
    value = np.where(held[starts[0] :], _BYTE[data[starts[0] :]], np.uint64(0)) * powers(int(lengths.max()))[at]
    hashes = mix(np.add.reduceat(value, starts - starts[0]))
    return starts, np.searchsorted(ends, starts, "right") - 1, hashes


def firsts(row: np.ndarray) -> np.ndarray:
    """Where each run of equal row numbers begins."""
    return np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
