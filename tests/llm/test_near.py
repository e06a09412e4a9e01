import itertools
import random
import re

import numpy as np
import pytest
from helpers import docs, prose
from pyspark.sql import functions as F

from chromaloom.llm import ngram_join as nj


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    links = [0] * len(rows)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        x, y = sets[a], sets[b]
        if x and y and len(x & y) >= 0.8 * len(x | y):
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    ids = [[rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None] for i in range(len(rows))]
    return sorted(((rows[i][0], min(ids[i]) if ids[i] else None, links[i]) for i in range(len(rows))), key=str)


def corpus():
    rng = random.Random(3)
    rows, base = [], [prose(rng, rng.choice([3, 8, 60, 300])) for _ in range(25)]
    for i, text in enumerate(base):
        words = text.split()
        rows += [(10 * i, text), (10 * i + 1, text)]
        for k in range(3):
            edited = words[:]
            for _ in range(rng.randint(1, 1 + len(words) // 40)):
                edited[rng.randrange(len(edited))] = "new" + str(rng.randrange(99))
            rows.append((10 * i + 2 + k, " ".join(edited)))
    rows += [(900, None), (901, ""), (902, " \n\t"), (903, None), (None, base[3]), (None, "alone in the world of words"), (904, base[4] + " "), (904, base[4] + " ")]
    return rows


def test_classes_like_brute_force(spark):
    rows = corpus()
    got = nj.near_classes(docs(spark, rows)).select("doc_id", "class_id", "n_links").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_large_group_goes_through_blocks(spark, monkeypatch):
    monkeypatch.setattr(nj, "SMALL", 4)
    monkeypatch.setattr(nj, "CHUNK", 8)
    rng = random.Random(5)
    words = prose(rng, 120).split()
    rows = []
    for i in range(60):
        edited = words[:]
        for _ in range(rng.randint(0, 5)):
            edited[rng.randrange(len(edited))] = "e" + str(rng.randrange(9999))
        rows.append((i, " ".join(edited)))
    got = nj.near_classes(docs(spark, rows)).select("doc_id", "class_id", "n_links").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_one_of_each_stays(spark):
    rows = corpus()
    kept = nj.keep_one_of_each(docs(spark, rows))
    assert kept.columns == docs(spark, rows).columns
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    by_class = {}
    for d, c, n in brute(rows):
        by_class.setdefault((c, d if n == 0 else None), []).append(d)
    assert len(got) == len(by_class)
    assert len([d for d, _ in got if d == 904]) <= 1


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "a")]])
def test_tiny_tables(spark, rows):
    got = [tuple(r) for r in nj.near_classes(docs(spark, rows)).select("doc_id", "class_id", "n_links").collect()]
    assert got == [(1, 1, 0) for _ in rows]
    assert nj.keep_one_of_each(docs(spark, rows)).count() == len(rows)


def test_pruning_keeps_what_can_reach_the_threshold():
    need = nj.least_matches()
    rng = np.random.default_rng(1)
    left = rng.integers(0, 2**32, (20000, nj.HASHES), dtype=np.uint32)
    right = np.where(rng.random(left.shape) < 0.8, left, left + np.uint32(1))
    assert len(nj.bayes_alive(left, right, need)) >= 19990
    right = np.where(rng.random(left.shape) < 0.4, left, left + np.uint32(1))
    assert len(nj.bayes_alive(left, right, need)) < 200


def test_long_chain_is_one_component(spark, tmp_path):
    from chromaloom.llm.shared import Workspace

    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (501, 502)], "a long, b long")
    got = {r["node"]: r["root"] for r in nj.components(edges, Workspace(spark, "test")).collect()}
    assert all(got[i] == 0 for i in range(1, 201)) and got[501] == got[502] == 500


def test_one_long_text_does_not_multiply_a_bucket(spark, monkeypatch):
    """A text of a million shingles among a thousand of a hundred: five chunks, not four thousand; and links are the same in tiny blocks."""
    row = spark.sql("select 1000L as size, 1000L * 100 + 1000000L as total").select(nj.chunks_of(F.col("size"), F.col("total"))).first()
    assert row[0] == 5
    monkeypatch.setattr(nj, "SMALL", 4)
    monkeypatch.setattr(nj, "BLOCK_BYTES", 8 * 700)
    rng = random.Random(15)
    words = prose(rng, 100).split()
    rows = []
    for i in range(40):
        edited = words[:]
        edited[rng.randrange(len(edited))] = f"e{i}"
        rows.append((i, " ".join(edited + ["end"] * (i % 7 == 0))))
    rows.append((99, " ".join(words * 30 + [f"t{k}" for k in range(2000)])))
    got = nj.near_classes(docs(spark, rows)).select("doc_id", "class_id", "n_links").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
