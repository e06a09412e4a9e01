"""Token counts of sections by offset-mapped attribution (operator 10).

Every whole document is encoded once.  The byte spans of its tokens are joined to the spans of its
sections (by default its lines, each with its line end) as sorted intervals.  A token that crosses
a boundary is allocated by ``rule``: ``first`` gives it to the section in which it begins,
``last`` to that in which it ends, ``share`` to each section by its part of the token's bytes.

The vocabulary is a rank file of a public byte-level tokenizer; its path is a parameter.  The driver
reads it and broadcasts it (a few MB at most); workers need no copy on their disks.

Defined results: null and empty texts have one section, 0, without tokens.  Repeated rows each
get their own rows.  Ill-formed characters cannot occur in Spark strings.  Extra columns are
ignored.  An empty table gives no row.
"""

from __future__ import annotations

import base64
import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import Workspace, arrow_text

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pattern that the vocabulary was made for (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.lru_cache(1)
def _encoding(table: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, table.splitlines())}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), sizes


def encoder(path: str):
    """The tokenizer and the number of bytes of each token id."""
    with open(path, "rb") as file:
        return _encoding(file.read())


def _table(spark, path: str) -> bytes:
    """The bytes of a rank file: on the driver's disk, or in a store that Spark reads."""
    if "://" in path:
        return bytes(spark.read.format("binaryFile").load(path).first()["content"])
    with open(path, "rb") as file:
        return file.read()


def line_sections(data: np.ndarray) -> np.ndarray:
    """Byte offsets at which the lines of a text begin."""
    return np.append(0, np.flatnonzero(data == 10) + 1)


def attribute(token_ends: np.ndarray, begins: np.ndarray, size: int, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens allocated to each section, and tokens that touch it."""
    count = len(begins)
    if not len(token_ends):
        return np.zeros(count), np.zeros(count, np.int64)
    token_begins = np.append(0, token_ends[:-1])
    first = np.searchsorted(begins, token_begins, "right") - 1
    last = np.searchsorted(begins, token_ends - 1, "right") - 1
    # A token touches every section from its first to its last: difference sums.
    steps = np.bincount(first, minlength=count + 1) - np.bincount(last + 1, minlength=count + 1)
    touching = np.cumsum(steps)[:count]
    touching[np.append(begins[1:], size) == begins] = 0
    if rule == "first":
        return np.bincount(first, minlength=count).astype(float), touching
    if rule == "last":
        return np.bincount(last, minlength=count).astype(float), touching
    # share: tokens before an offset grow linearly within a token
    edges = np.append(begins, size)
    before = np.interp(edges, np.append(0, token_ends), np.arange(len(token_ends) + 1))
    return np.diff(before), touching


def _counter(handle, rule: str):
    def count(batches):
        encoding, sizes = _encoding(handle.value)
        for batch in batches:
            data, ends = arrow_text(batch.column("text"))
            rows, parts = [], []
            for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
                raw = data[a:b]
                tokens = np.asarray(encoding.encode_to_numpy(raw.tobytes().decode("utf-8"), disallowed_special=()), np.int64)
                token_ends = np.cumsum(sizes[tokens])
                begins = line_sections(raw)
                if len(begins) > 1 and begins[-1] == len(raw):
                    begins = begins[:-1]  # a final line end begins no section
                given, touching = attribute(token_ends, begins, len(raw), rule)
                chars = np.append(0, np.cumsum((raw & 0xC0) != 0x80))
                edges = chars[np.append(begins, len(raw))]
                rows.append(np.full(len(begins), i))
                parts.append((np.arange(len(begins)), edges[:-1], edges[1:], given, touching, np.full(len(begins), len(tokens))))
            if not rows:
                continue
            columns = [np.concatenate(x) for x in zip(*parts)]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            at, of = np.concatenate(rows), batch.column("doc_id")
            for x in range(0, len(at), 10_000):
                piece = slice(x, x + 10_000)
                yield pa.RecordBatch.from_arrays(
                    [of.take(pa.array(at[piece])), *[pa.array(c[piece], k) for c, k in zip(columns, kinds)]],
                    names=["doc_id", "section", "char_begin", "char_end", "n_tokens", "n_touching", "doc_tokens"],
                )

    return count


def section_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, rule: str = "first") -> DataFrame:
    """A written table with one row per section: doc_id, section, char_begin, char_end, n_tokens, n_touching, doc_tokens."""
    if rule not in ("first", "last", "share"):
        raise ValueError(f"rule is first, last or share, not {rule}")
    kind = docs.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, section long, char_begin long, char_end long, n_tokens double, n_touching long, doc_tokens long"
    handle = docs.sparkSession.sparkContext.broadcast(_table(docs.sparkSession, vocabulary))
    return Workspace(docs.sparkSession, "tokens").table(docs.select("doc_id", "text").mapInArrow(_counter(handle, rule), shape), "sections")


def op10_token_counts(spark, sf_dir: str) -> DataFrame:
    return section_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
