import collections
import re

import pytest
from helpers import docs

from chromaloom.llm import line_dedup, mixture


def brute(rows):
    """Lines left, by row; rows equal in id and text count once."""
    keys = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, gone = set(), collections.defaultdict(set)
    for key in keys:
        lines = key[1].split("\n")
        filled = [i for i, x in enumerate(lines) if x.strip(line_dedup.BLANKS)]
        for k in range(len(filled) - 2):
            window = tuple(lines[i].strip(line_dedup.BLANKS) for i in filled[k : k + 3])
            if window in seen:
                gone[key] |= set(filled[k : k + 3])
            seen.add(window)
    out = []
    for r in rows:
        if r[1] is None:
            out.append((r[0], None, 0, 0))
        else:
            lines = r[1].split("\n")
            out.append((r[0], "\n".join(x for i, x in enumerate(lines) if i not in gone[r]), len(lines), len(gone[r])))
    return sorted(out, key=str)


LINES = [f"line {i}" for i in range(12)]
ROWS = [
    (1, "\n".join(LINES)), (2, "\n".join(["new", *LINES[3:7], "end", "of text"])), (3, "\n\n".join([*LINES[:3], "x", *LINES[5:8], "x"])), (4, "\n".join(LINES[:2])),
    (5, None), (6, ""), (7, "\n\n\n\n\n"), (8, "a\na\na\na\na\na"), (9, "a\na\n a \nb"), (10, "\n".join(LINES)), (10, "\n".join(LINES)), (None, "q\nr\ns\nt"), (11, "q\nr\ns"),
    (12, "\n".join(LINES[4:9])), (13, "p\n" * 3000 + "q"),
]


def test_lines_like_brute_force(spark):
    out = line_dedup.dedup_lines(docs(spark, ROWS))
    got = sorted(((r["doc_id"], r["text"], r["_ld_lines"], r["_ld_removed"]) for r in out.collect()), key=str)
    assert got == brute(ROWS)
    assert {r["doc_id"] for r in out.filter("_ld_all").collect()} == {10, 11, 12}
    assert all(r["n_chars"] == len(r["text"]) for r in out.filter("text is not null").collect())


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "a\nb\nc")]])
def test_tiny_tables(spark, rows):
    assert line_dedup.dedup_lines(docs(spark, rows)).count() == len(rows)


def fill(sizes, weights=(5, 2, 1), cap=3):
    """Repeated sharing of the excess, as the operator's rule is told."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weigh = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = dict.fromkeys(names, 0.0), set(names), float(sum(sizes.values()))
    while free:
        total = sum(weigh[s] for s in free)
        over = [s for s in free if left * weigh[s] / total > cap * sizes[s]]
        if not over:
            for s in free:
                target[s] = left * weigh[s] / total
            break
        for s in over:
            target[s] = float(cap * sizes[s])
        left -= sum(target[s] for s in over)
        free -= set(over)
    return target


def test_mix(spark):
    rows = [(i, " ".join(["w"] * (i % 17 + 1)) + " x", "en", [None, "a", "b", "é", "z", "Z", "tiny"][i % 7 if i < 600 else 4]) for i in range(900)]
    rows += [(5000, None, "en", "a"), (5001, "", "en", "a"), (None, "one two", "en", "b"), (7, rows[7][1], "en", rows[7][3]), (5002, "", "en", "empty"), (5003, "only five words are here", "en", "few")]
    out = mixture.mix_sources(docs(spark, rows)).collect()
    assert sorted(map(str, out)) == sorted(map(str, mixture.mix_sources(docs(spark, rows).repartition(7)).collect()))
    assert len(out) == len(rows)
    sizes, taken = collections.Counter(), collections.Counter()
    for r in rows:
        sizes[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    want = fill(dict(sizes))
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6
        assert r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 9, s


def test_mix_of_nothing(spark):
    assert mixture.mix_sources(docs(spark, [])).count() == 0
    assert [r["taken"] for r in mixture.mix_sources(docs(spark, [(1, None), (2, "")])).collect()] == [0, 0]
