import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from helpers import docs, prose

from chromaloom.llm import filter_audit as fa
from chromaloom.llm import importance as im
from chromaloom.llm import shared
from chromaloom.llm import simhash as sh
from chromaloom.operators.tables import Workspace


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# ---------------------------------------------------------------- operator 11


def audit_rows(rows, labels):
    masks = []
    for d, text, source in rows:
        text, w = text or "", words_of(text)
        fails = [
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), bool(re.search(r"[#$%&*|]", text)),
            d is not None and any(e is not None and e < d and (t or "") == text for e, t, _ in rows),
        ]
        good = any(x == d and q == 1 for x, q, _ in labels if d is not None)
        toxic = any(x == d and t == 1 for x, _, t in labels if d is not None)
        masks.append((source or "", dict(zip("ABCDE", fails)), good, toxic))
    out = {}
    for part in {m[0] for m in masks}:
        mine = [m for m in masks if m[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            alive = list(mine)
            for step, f in enumerate(order, 1):
                gone = [m for m in alive if m[1][f]]
                fail = sum(m[1][f] for m in mine)
                alive = [m for m in alive if not m[1][f]]
                only = sum(m[1][f] and sum(m[1].values()) == 1 for m in mine)
                out[part, order, step] = [len(alive), len(gone), fail - len(gone), only, sum(m[2] for m in gone), sum(m[3] for m in gone)]
        for f in "ABCDE":
            places = [k for k in out if k[0] == part and k[1][k[2] - 1] == f]
            total = sum(out[k][1] for k in places)
            for k in places:
                out[k].append(total)
    return out


def test_audit_like_brute_force(spark):
    rng = random.Random(1)
    texts = [prose(rng, 220), prose(rng, 30), " ".join(["same"] * 300), prose(rng, 205).upper(), prose(rng, 210) + " #", prose(rng, 10) + " $ A", "", None, " \n", "É" * 40 + " Q"]
    rows = [(i, texts[i % len(texts)], ["a", "b", None, ""][i % 4]) for i in range(45)]
    rows += [(None, texts[0], "a"), (3, texts[3], "b"), (3, "other words", "c"), (7, None, None)]
    labels = [(0, 1, 0), (1, 0, 1), (1, 1, 0), (12, 1, 1), (23, None, 1), (None, 1, 1), (999, 1, 1), (3, 1, 0), (13, 0, 0)]
    table = docs(spark, [(d, t, "en", s) for d, t, s in rows])
    got = fa.audit_documents(table, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    found = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")] for r in got.collect()}
    assert found == audit_rows(rows, labels)


def test_audit_of_nothing_and_of_other_filters(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert fa.audit_documents(docs(spark, []), labels).count() == 0
    cells = spark.createDataFrame([("p", 0b11, 4, 1, 0), ("p", 0b10, 2, 0, 2)], "part string, mask int, n long, good long, toxic long")
    got = {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["shapley"]) for r in fa.audit(cells, "XY").collect()}
    assert got == {("XY", 1): (2, 4, 0, 0, 4), ("XY", 2): (0, 2, 4, 2, 8), ("YX", 1): (0, 6, 0, 2, 8), ("YX", 2): (0, 0, 4, 0, 4)}


def test_long_texts_are_measured_in_parts(monkeypatch):
    rng = random.Random(2)
    texts = [prose(rng, 3000) + " Zé*", "x" * 5000, "A b " * 2000, ""]
    raw = [t.encode() for t in texts]
    data, ends = np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(x) for x in raw]))
    whole = fa.measure(data, ends)
    monkeypatch.setattr(fa, "PIECE", 256)
    assert (fa.measure(data, ends) == whole).all()
    assert whole[:, 0].tolist() == [3001, len(set(words_of(texts[0]))), 1, len(texts[0]), 1]


# ---------------------------------------------------------------- operator 12


def grams(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def resample_rows(rows, target):
    bucket = lambda g: zlib.crc32(g.encode()) % 10000
    ours = Counter(bucket(g) for _, t in rows for g in grams(t))
    theirs = Counter(bucket(g) for t in target for g in grams(t))
    s, t = sum(ours.values()), sum(theirs.values())
    gain = {b: math.floor(1000 * math.log((theirs[b] + 1) * (s + 10000) / ((n + 1) * (t + 10000)))) for b, n in ours.items()}
    out = []
    for d, text in rows:
        g = grams(text)
        weight = sum(gain[bucket(x)] for x in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= 39), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[: 25 * len(able) // 100], 1):
        r[4] = rank
    return sorted(map(str, out))


def test_resampling_like_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.choice([0, 1, 2, 19, 20, 21, 60]))) for i in range(90)]
    rows += [(200, None), (201, ""), (202, "...!"), (203, "Größe MASS " * 30), (204, "日本 " * 25), (None, prose(rng, 40)), (None, prose(rng, 40)), (205, "x" * 40000 + " y" * 30)]
    rows += [(206, rows[5][1])] * 2
    target = ["Größe mass and more", prose(rng, 50), None, ""]
    got = im.resample(docs(spark, rows), spark.createDataFrame([(t,) for t in target], "text string"))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(str(list(r)) for r in got.collect()) == resample_rows(rows, target)


def test_ranks_of_equal_scores_and_empty_tables(spark):
    empty = spark.createDataFrame([], "text string")
    assert im.resample(docs(spark, []), empty).count() == 0
    text = " ".join(["word"] * 30)
    got = im.resample(docs(spark, [(None, text)] * 8 + [(1, "short")]), empty).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2]


def test_words_are_not_shuffled(spark):
    plan = im.position_table(docs(spark, [(1, "a b")]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.index("Exchange") > plan.index("Generate")


# ---------------------------------------------------------------- operator 13


def plain_fingerprint(text):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = words_of(w)
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum((2 * sum(x >> k & 1 for x in h) > len(h)) << k for k in range(64)) if h else 0


def plain_components(prints):
    """prints: (id or None, fingerprint)."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(prints)), 2):
        if (prints[a][1] ^ prints[b][1]).bit_count() <= 3:
            root[find(a)] = find(b)
    low = {}
    for i, (d, _) in enumerate(prints):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [low.get(find(i)) for i in range(len(prints))]


def test_fingerprints_in_whole_and_in_parts(monkeypatch):
    rng = random.Random(6)
    texts = ["", " \t\n", "One", "one two", "One TWO three", "École ÉCOLE x " * 9, prose(rng, 500), "z" * 3000 + " a b c", prose(rng, 3)]
    assert [sh.fingerprint(t.encode()) for t in texts] == [plain_fingerprint(t) for t in texts]
    whole = shared.parts_of
    monkeypatch.setattr(sh, "parts_of", lambda text: whole(text, 40))
    assert [sh.fingerprint(t.encode()) for t in texts] == [plain_fingerprint(t) for t in texts]


def test_components_of_texts_like_brute_force(spark):
    rng = random.Random(7)
    rows, base = [], [prose(rng, n) for n in (1, 2, 3, 30, 200, 400, 800)]
    for i, text in enumerate(base):
        w = text.split()
        rows += [(10 * i + 5, text), (10 * i + 1, text.upper())]
        for k in range(4):
            edited = w[:]
            edited[rng.randrange(len(w))] = f"new{k}"
            rows.append((10 * i + 6 + k, " ".join(edited)))
    rows += [(900, None), (901, ""), (899, "\n"), (None, base[5]), (None, "nothing like it"), (3, base[4]), (3, base[4])]
    got = sh.near_components(docs(spark, rows)).collect()
    want = plain_components([(d, plain_fingerprint(t)) for d, t in rows])
    expected = sorted(str((d, plain_fingerprint(t), c)) for (d, t), c in zip(rows, want))
    assert sorted(str((r["doc_id"], r["fp"] % 2**64, r["component_id"])) for r in got) == expected
    assert sh.near_components(docs(spark, [])).count() == 0


@pytest.mark.parametrize("small,chunk", [(sh.SMALL, sh.CHUNK), (4, 16), (1 << 30, 16)])
def test_links_of_clustered_fingerprints(spark, monkeypatch, small, chunk):
    """Groups around centres, with bits that are set together: links join what brute force joins."""
    monkeypatch.setattr(sh, "SMALL", small)
    monkeypatch.setattr(sh, "CHUNK", chunk)
    rng = random.Random(8)
    prints = {0, 2**64 - 1, 1 << 63}
    for _ in range(25):
        centre = rng.getrandbits(64)
        centre = centre & ~0xFFFF | (0xFFFF if centre & 1 else 0)  # sixteen bits that go together
        for _ in range(rng.choice([1, 3, 20])):
            fp = centre
            for _ in range(rng.randint(0, 3)):
                fp ^= 1 << rng.randrange(64)
            prints.add(fp)
    nodes = sorted(x - (x >> 63 << 64) for x in prints)
    edges = sh.links_of(spark.createDataFrame([(x,) for x in nodes], "fp long"), Workspace(spark, "test")).collect()
    assert all(((a ^ b) % 2**64).bit_count() <= 3 or small < 1 << 30 for a, b in edges)
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[find(a)] = find(b)
    want = plain_components([(x, x % 2**64) for x in nodes])
    low = {}
    for x in nodes:
        low.setdefault(find(x), x)
    assert [low[find(x)] for x in nodes] == want


def test_thresholds_leave_no_pair_out():
    """Whatever the costs: a pair within TAU bits is within the threshold of some part."""
    rng = np.random.default_rng(9)
    for parts in (2, 4):
        costs = [np.concatenate([np.zeros((1, 300)), np.cumsum(rng.random((4, 300)) * rng.choice([1, 50], (4, 300)), 0)]) for _ in range(parts)]
        chosen, cost = sh.allot(costs, sh.TAU - parts + 1)
        assert (chosen.sum(0) == sh.TAU - parts + 1).all()
        assert np.allclose(cost, sum(c[chosen[k] + 1, np.arange(300)] for k, c in enumerate(costs)))
        every = min(sum(c[t + 1, 0] for c, t in zip(costs, ts)) for ts in itertools.product(range(-1, 4), repeat=parts) if sum(ts) == sh.TAU - parts + 1)
        assert np.isclose(cost[0], every)
        for spread in itertools.product(range(4), repeat=parts):
            if sum(spread) <= sh.TAU:
                assert (np.array(spread)[:, None] <= chosen).any(0).all()


def test_correlated_bits_share_a_block():
    rng = np.random.default_rng(10)
    bits = rng.integers(0, 2, (4000, 64))
    group = rng.permutation(64)[:16]
    bits[:, group] = bits[:, group[:1]] ^ (rng.random((4000, 16)) < 0.1)
    blocks = sh.group_bits((bits.T @ bits).astype(float), 4000)
    assert sorted(blocks.ravel()) == list(range(64)) and any(set(row) == set(group) for row in blocks)


def test_spheres_count_neighbours():
    counts = np.zeros((1, 1 << sh.WIDTH))
    counts[0, [0, 1, 3, 0xFFFF]] = [5, 2, 7, 1]
    near = sh.spheres(counts)
    assert near[0, :, 0].tolist() == [5, 2, 7, 0] and near[0, :, 1].tolist() == [2, 12, 0, 0] and near[0, :, 2].tolist() == [0, 12, 2, 0]
