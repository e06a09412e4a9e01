"""Toxicity scores from subword-bag embeddings under a linear softmax (operator 7).

Texts are lower-cased and cut into segments of ``SEGMENT`` words.  A segment is the average of the
embeddings of the character 3- to 5-grams of its words (with a blank at both ends, hashed into
``BUCKETS`` rows); a linear softmax over the average gives its class.  Embeddings and softmax are
trained jointly in numpy with AdaGrad.  Labels belong to documents, so after a first epoch
each toxic document is represented by its most toxic segments only.  The document's score is a
logistic calibration of its highest segment, fitted at the labels' own base rate.

The trained model acts on text only through one number per n-gram (softmax weights applied to
its embedding), and just this table of fixed size, 512 KB, is sent to the workers, which score
every whole text.

Training takes at most ``MOST[label]`` labelled documents per label, those with the least
md5(seed, doc_id), one text of each (that with the least hash among rows that repeat a doc_id), and of
all at most about ``SEGMENTS[label]`` segments, as many of each document, drawn by seed; a segment of more than
``LONGEST`` characters counts as several of that length.  Executors cut and draw the segments and score the documents for the
calibration; the driver gets segments (about 12 MB) and one number per document.  Rows with
crc32(doc_id as text) mod 4 = 2 are never used.  Labels, lang, source and doc_id are no inputs.

Defined results: a null or wordless text scores the base rate of the labels; so does every text
if the labels of the documents there are of one class or none (base rate 0 without labels).  A doc_id labelled more
than once counts as toxic if any label says so; null labels are ignored.  Repeated rows count once
in training and score alike.  Texts of any length are read in parts of about ``PIECE`` characters that end where segments do; one
segment that is longer is summed over parts.  Columns of the input are not touched; names starting with ``_tx_`` are refused.
An empty table gives no row.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import SPACES, Workspace, arrow_text, mix, pieces, refuse

BUCKETS, WIDTH, SEGMENT = 1 << 17, 8, 16
GRAMS = (3, 4, 5)
MOST = {1: 2000, 0: 4000}
SEGMENTS = {1: 60_000, 0: 32_000}
LONGEST = 4096
PIECE = 1 << 18
EPOCHS, UPDATES, BATCH, RATE = 6, 150, 256, 1.0
THRESHOLD = 0.3
SEED = "tox-1"

_rng = np.random.default_rng(7)
_FACTOR = _rng.integers(1, 1 << 62, max(GRAMS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.array(list(SPACES) + [0x85, 0xA0], np.uint32)
_WORD = re.compile("[^" + re.escape("".join(map(chr, _SPACE))) + "]+")


def _gram_ids(value: np.ndarray, space: np.ndarray, n: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and ids of the n-grams that begin in the first ``count`` places and have no blank inside."""
    total = np.zeros(count, np.uint64)
    whole = np.ones(count, bool)
    for k in range(n):
        total += value[k : k + count] * _FACTOR[k]
        if 0 < k < n - 1:
            whole &= ~space[k : k + count]
    at = np.flatnonzero(whole)
    return at, (mix(total[at] + np.uint64(n)) >> np.uint64(64 - 17)).astype(np.int32)


def grams_of(texts: list[str]):
    """n-gram ids of some texts: (list of (positions, ids) per n, word of each position, row of each word)."""
    joined = " " + " ".join(texts) + " "
    code = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    space = np.isin(code, _SPACE)
    begins = np.flatnonzero(~space[1:] & space[:-1]) + 1
    word = np.cumsum(~space & np.append(True, space[:-1])) - 1  # blanks carry the word before
    edge = np.cumsum([1] + [len(t) + 1 for t in texts])
    row = np.searchsorted(edge, begins, "right") - 1
    value = mix(np.where(space, 32, code).astype(np.uint64))
    out = []
    for n in GRAMS:
        count = len(code) - n + 1
        if count <= 0:
            continue
        at, ids = _gram_ids(value, space, n, count)
        out.append((word[at + space[at]], ids))  # one that begins with a blank belongs to the next word
    return out, row


def segments_of(row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Segment of each word, and row of each segment."""
    if not len(row):
        return row, row
    begin = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    place = np.arange(len(row)) - np.repeat(begin, np.diff(np.append(begin, len(row))))
    head = place % SEGMENT == 0
    return np.cumsum(head) - 1, row[head]


def highest(texts: list[str], table: np.ndarray) -> np.ndarray:
    """The highest segment's logit of each text; nan where there is no word."""
    grams, row = grams_of(texts)
    best = np.full(len(texts), np.nan)
    segment, of = segments_of(row)
    if len(of):
        total, count = np.zeros(len(row)), np.zeros(len(row))
        for word, ids in grams:
            total += np.bincount(word, table[ids], len(row))[: len(row)]
            count += np.bincount(word, minlength=len(row))[: len(row)]
        value = np.bincount(segment, total) / np.maximum(np.bincount(segment, count), 1)
        begin = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        best[of[begin]] = np.maximum.reduceat(value, begin)
    return best


def parts_of_text(text: str):
    """A text in parts that end where segments do: of about PIECE characters, or one segment that is longer."""
    start = segment = words = 0
    for found in _WORD.finditer(text):
        if words % SEGMENT == 0:
            segment = found.start()
        words += 1
        if words % SEGMENT == 0:
            end = found.end()
            if end - segment > PIECE and segment > start:
                yield text[start:segment]
                start = segment
            if end - start >= PIECE:
                yield text[start:end]
                start = end
    if words % SEGMENT and len(text) - segment > PIECE and segment > start:
        yield text[start:segment]
        start = segment
    yield text[start:]


def _segment_logit(text: str, table: np.ndarray) -> float:
    """The logit of one long segment, summed over parts: n-grams are looked for where they begin."""
    joined, total, count = f" {text} ", 0.0, 0
    for a in range(0, len(joined), PIECE):
        code = np.frombuffer(joined[a : a + PIECE + max(GRAMS) - 1].encode("utf-32-le", "replace"), np.uint32)
        space = np.isin(code, _SPACE)
        value = mix(np.where(space, 32, code).astype(np.uint64))
        for n in GRAMS:
            size = min(PIECE, len(code) - n + 1)
            if size > 0:
                ids = _gram_ids(value, space, n, size)[1]
                total, count = total + float(table[ids].sum(dtype=np.float64)), count + len(ids)
    return total / max(count, 1) if _WORD.search(text) else np.nan


def highest_of_long(text: str, table: np.ndarray) -> float:
    """``highest`` of one text of any length."""
    tops = [_segment_logit(part, table) if len(part) > 2 * PIECE else float(highest([part], table)[0]) for part in parts_of_text(text)]
    known = [x for x in tops if not np.isnan(x)]
    return max(known) if known else np.nan


def _segments_in(text: str):
    """The segments that training draws from, one at a time."""
    words: list[str] = []
    for found in _WORD.finditer(text):
        words.append(found[0])
        if len(words) == SEGMENT:
            yield from _cut(" ".join(words))
            words = []
    if words:
        yield from _cut(" ".join(words))


def _cut(segment: str):
    return (segment[a : a + LONGEST] for a in range(0, len(segment), LONGEST))


def drawn(text: str, share: int, seed: int) -> list[str]:
    """Up to ``share`` segments of a text, in order, drawn by seed."""
    count = sum(1 for _ in _segments_in(text))
    if count <= share:
        return list(_segments_in(text))
    taken = set(np.random.default_rng(seed).choice(count, share, replace=False).tolist())
    return [x for i, x in enumerate(_segments_in(text)) if i in taken]


class Bags:
    """n-gram ids of training segments, flat."""

    def __init__(self, segments: list[list[str]]):
        texts = [x for several in segments for x in several]
        self.doc = np.repeat(np.arange(len(segments)), [len(x) for x in segments])
        ids, size = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for a in range(0, len(texts), 1024):
            part = texts[a : a + 1024]
            grams, row = grams_of(part)
            segment = np.concatenate([row[w] for w, _ in grams])
            flat = np.concatenate([i for _, i in grams])
            ids.append(flat[np.argsort(segment, kind="stable")])
            size.append(np.bincount(segment, minlength=len(part)))
        self.size = np.concatenate(size).astype(np.int64)
        self.ids, at = np.empty(sum(map(len, ids)), np.int32), 0
        for k, part in enumerate(ids):  # each part is let go as soon as it is copied
            self.ids[at : at + len(part)], at, ids[k] = part, at + len(part), None
        del part
        self.begin = np.cumsum(self.size) - self.size

    def means(self, value: np.ndarray) -> np.ndarray:
        """The mean of a number per n-gram over every segment, a slice of segments at a time."""
        out = np.zeros(len(self.size))
        for a in range(0, len(out), 1024):
            ids, seg = self.pick(np.arange(a, min(a + 1024, len(out))))
            part = self.size[a : a + 1024]
            out[a : a + 1024] = np.bincount(seg, value[ids], len(part)) / np.maximum(part, 1)
        return out

    def pick(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.size[which]
        at = np.repeat(self.begin[which] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return self.ids[at], np.repeat(np.arange(len(which)), size)


def train(segments: list[list[str]], label: np.ndarray, seed: int = 7) -> np.ndarray:
    """Fit embeddings and softmax jointly: the logit of each n-gram."""
    bags = Bags(segments)
    rng = np.random.default_rng(seed)
    target = label[bags.doc]
    table = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    soft, bias = rng.normal(0, 0.5, (WIDTH, 2)).astype(np.float32), np.zeros(2, np.float32)
    squares = [np.full_like(x, 1e-8) for x in (table, soft, bias)]
    full = np.flatnonzero(bags.size > 0)
    batches = len(full) // BATCH + 1
    for epoch in range(max(EPOCHS, min(40, UPDATES // batches))):  # small samples pass more often
        if epoch:  # toxic documents stand for their most toxic segments
            collapsed = table @ (soft[:, 1] - soft[:, 0])
            score = bags.means(collapsed) + bias[1] - bias[0]
            top = np.full(len(segments), -np.inf)
            np.maximum.at(top, bags.doc, np.where(bags.size > 0, score, -np.inf))
            chosen = full[(target[full] == 0) | (score[full] >= np.minimum(top[bags.doc[full]], 2.0))]
        else:
            chosen = full
        chosen = rng.permutation(chosen)
        weight = np.where(target == 1, max(1.0, 0.3 * (target[chosen] == 0).sum() / max(1, (target[chosen] == 1).sum())), 1.0)
        for a in range(0, len(chosen), BATCH):
            which = chosen[a : a + BATCH]
            ids, seg = bags.pick(which)
            size = bags.size[which].astype(np.float32)[:, None]
            begin = np.cumsum(bags.size[which]) - bags.size[which]
            hidden = np.add.reduceat(table[ids], begin, axis=0) / size
            logit = hidden @ soft + bias
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(which)), target[which]] -= 1
            p *= (weight[which] / len(which))[:, None].astype(np.float32)
            back = p @ soft.T / size
            grads = [
                np.stack([np.bincount(ids, back[seg, d], BUCKETS) for d in range(WIDTH)], 1).astype(np.float32),
                hidden.T @ p + 1e-5 * soft,
                p.sum(0),
            ]
            for x, g, s, rate in zip((table, soft, bias), grads, squares, (RATE, 0.05, 0.05)):
                s += g * g
                x -= rate * g / np.sqrt(s)
    return (table @ (soft[:, 1] - soft[:, 0])).astype(np.float32)


def calibrate(top: np.ndarray, label: np.ndarray, base: float) -> tuple[float, float]:
    """Slope and offset of a logistic function of the highest segments' logits."""
    known = ~np.isnan(top)
    x, y = top[known], label[known]
    # Each label weighs what it weighs among all labelled documents.
    w = np.where(y == 1, base / max(1, (y == 1).sum()), (1 - base) / max(1, (y == 0).sum()))
    middle, spread = float(np.mean(x)), float(np.std(x)) or 1.0
    z, (slope, offset) = (x - middle) / spread, (1.0, 0.0)
    for _ in range(50):  # Newton steps with a little ridge
        p = 1 / (1 + np.exp(-np.clip(slope * z + offset, -30, 30)))
        g = np.array([(w * (p - y) * z).sum() + 1e-4 * slope, (w * (p - y)).sum()])
        h = w * p * (1 - p)
        hess = np.array([[(h * z * z).sum() + 1e-4, (h * z).sum()], [(h * z).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(hess, g)
        step *= min(1.0, 2.0 / np.abs(step).max()) if np.abs(step).max() > 0 else 1.0
        slope, offset = slope - step[0], offset - step[1]
    return slope / spread, offset - slope * middle / spread


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """Train on a bounded sample of the labelled documents that are not held out."""
    told = labels.filter("doc_id is not null and toxic is not null").filter(~_held_out())
    told = told.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    counts = {r[0]: r[1] for r in told.groupBy("toxic").count().collect()}
    ones, zeros = counts.get(1, 0), counts.get(0, 0)
    base = ones / (ones + zeros) if ones + zeros else 0.0
    flat = {"table": np.zeros(BUCKETS, np.float32), "slope": 0.0, "offset": -30.0, "base": base, "flat": True}
    if not ones or not zeros:
        return flat
    order = F.md5(F.concat(F.lit(SEED), F.col("doc_id").cast("string")))
    told = told.withColumn("order", order)
    some = [told.filter(f"toxic = {k}").orderBy("order", "doc_id").limit(MOST[k]) for k in (0, 1)]
    some = F.broadcast(some[0].unionByName(some[1]))  # at most the sum of MOST
    space = Workspace(docs.sparkSession, "toxic")
    rows = docs.select("doc_id", F.lower("text").alias("text")).filter("text is not null").join(some, "doc_id")
    sample = space.table(rows.groupBy("doc_id", "toxic", "order").agg(F.min_by("text", F.xxhash64("text")).alias("text")), "sample")
    held = dict(sample.groupBy("toxic").count().collect())
    if len(held) < 2:
        return flat
    share = {k: max(4, SEGMENTS[k] // n) for k, n in held.items()}
    rows = space.table(sample.mapInArrow(_drawer(share), "toxic int, order string, segments array<string>"), "segments").orderBy("toxic", "order").collect()
    label = np.array([r["toxic"] for r in rows], int)
    model = flat | {"table": train([r["segments"] for r in rows], label)}
    handle = docs.sparkSession.sparkContext.broadcast(model)
    tops = space.table(sample.select("toxic", F.col("text").alias("_tx_text")).mapInArrow(_scorer(handle, raw=True), "toxic int, _tx_score double"), "tops").toArrow()
    space.drop("sample", "segments", "tops")
    top, label = (tops.column(x).to_numpy() for x in ("_tx_score", "toxic"))
    if len(np.unique(label[~np.isnan(top)])) < 2:
        return flat
    slope, offset = calibrate(top, label.astype(int), base)
    return model | {"slope": slope, "offset": offset, "flat": False}


def _drawer(share: dict[int, int]):
    def draw(batches):
        for batch in batches:
            toxic, order = batch.column("toxic").to_pylist(), batch.column("order").to_pylist()
            out = [drawn(text.as_py(), share[k], int(o[:15], 16)) for text, k, o in zip(batch.column("text"), toxic, order)]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), batch.column("order"), pa.array(out, pa.list_(pa.string()))], names=["toxic", "order", "segments"])

    return draw


def _held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def _scorer(handle, raw: bool = False):
    """Adds the score of ``_tx_text``, or the logit of its highest segment if raw."""

    def score(batches):
        model = handle.value
        for batch in batches:
            data, ends = arrow_text(batch.column("_tx_text"))
            out = []
            for a, b in pieces(ends):
                part = data[ends[a] : ends[b]].tobytes()
                cut = ends[a : b + 1] - ends[a]
                if len(part) > 2 * PIECE:  # one long text
                    top = np.array([highest_of_long(part.decode("utf-8", "replace"), model["table"])])
                else:
                    top = highest([part[x:y].decode("utf-8", "replace") for x, y in zip(cut[:-1], cut[1:])], model["table"])
                if raw:
                    out.append(top)
                    continue
                p = 1 / (1 + np.exp(-np.clip(model["slope"] * top + model["offset"], -30, 30)))
                out.append(np.full(len(top), model["base"]) if model.get("flat") else np.where(np.isnan(top), model["base"], p))
            yield pa.RecordBatch.from_arrays(
                [*[c for n, c in zip(batch.schema.names, batch.columns) if n != "_tx_text"], pa.array(np.concatenate(out) if out else np.zeros(0))],
                names=[*[n for n in batch.schema.names if n != "_tx_text"], "_tx_score"],
            )

    return score


def scored(docs: DataFrame, labels: DataFrame, carry: list[str]) -> DataFrame:
    """A written table of the columns ``carry`` of every document and its _tx_score."""
    return _scored(docs, labels, carry, Workspace(docs.sparkSession, "scored"), lambda x: x)


def _scored(docs: DataFrame, labels: DataFrame, carry: list[str], space: Workspace, keep) -> DataFrame:
    refuse(docs, "_tx_")
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    kinds = ", ".join(f"`{x}` {docs.schema[x].dataType.simpleString()}" for x in carry)
    texts = docs.select(*[F.col(f"`{x}`") for x in carry], F.lower("text").alias("_tx_text"))
    return space.table(keep(texts.mapInArrow(_scorer(model), f"{kinds}, _tx_score double")), "scored")


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with all their columns: a written table."""
    space = Workspace(docs.sparkSession, "clean")
    return _scored(docs, labels, docs.columns, space, lambda x: x.filter(F.col("_tx_score") < threshold).drop("_tx_score"))


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = scored(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ["doc_id"])
    return out.select("doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), F.col("_tx_score").alias("score"), (F.col("_tx_score") >= THRESHOLD).cast("int").alias("predicted"))
