import collections
import random
import re
import zlib

import numpy as np
import pytest
from helpers import docs, prose
from pyspark.sql import functions as F

from chromaloom.llm import decontaminate, line_dedup, mixture, ngram_join, quality, shared, token_counts, toxicity, warc
from chromaloom.llm.shared import Workspace, mix, words_of

VOCABULARY = token_counts.VOCABULARY


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def least_distance(item, words):
    row = [0] * (len(words) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(words, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_leaks_like_brute_force(spark):
    rng = random.Random(4)
    items = [(i, prose(rng, n)) for i, n in enumerate([3, 6, 8, 14, 15, 22, 24, 31, 47, 48, 60, 100])] + [(50, None), (51, ""), (52, "...")]
    rows = [(100 + k, prose(rng, 200)) for k in range(20)]
    for i, text in items[:12]:
        words = text.split()
        for k in range(3):
            edited = words[:]
            for _ in range(int(len(words) * 0.1 * k)):
                p = rng.randrange(len(edited))
                edited[p : p + rng.randint(0, 1)] = [] if rng.random() < 0.3 else ["edit" + str(rng.randrange(9))]
            text = " ".join(edited)
            rows.append((1000 + 10 * i + k, prose(rng, rng.randint(0, 30)) + "\n" + (text.upper() if k == 0 else text) + ", " + prose(rng, 20)))
    rows += [(2000, None), (2001, ""), (2002, items[5][1]), (None, items[6][1]), (2003, items[7][1]), (2003, items[7][1])]
    got = collections.Counter((r["doc_id"], r["item_id"], r["distance"]) for r in decontaminate.leaks(docs(spark, rows), benchmark(spark, items)).collect())
    want = collections.Counter()
    for d, text in rows:
        words = tokens(text)
        for i, item in items:
            item = tokens(item)
            if item and words and (k := least_distance(item, words)) <= int(0.2 * len(item)):
                want[d, i, k] += 1
    assert len(got) >= 35
    lost = want - got
    assert not got - want
    assert sum(lost.values()) <= 0.05 * sum(want.values())
    assert not {x for x in lost if x[2] == 0}
    left = decontaminate.without_leaks(docs(spark, rows), benchmark(spark, items))
    assert {r["doc_id"] for r in left.collect()} == {d for d, _ in rows} - {d for d, _, _ in got}


def test_item_blocks_give_the_same(spark):
    rng = random.Random(6)
    items = [(i, prose(rng, 20)) for i in range(8)]
    rows = [(i, prose(rng, 10) + " " + items[i % 8][1]) for i in range(16)]
    one = sorted(map(tuple, decontaminate.leaks(docs(spark, rows), benchmark(spark, items)).collect()))
    assert one == sorted(map(tuple, decontaminate.leaks(docs(spark, rows), benchmark(spark, items), block_words=40).collect()))
    assert decontaminate.leaks(docs(spark, []), benchmark(spark, items)).count() == 0
    assert decontaminate.leaks(docs(spark, rows), benchmark(spark, [])).count() == 0


def test_items_without_an_id_leak_too(spark):
    rng = random.Random(8)
    items = [(None, prose(rng, 20)), (None, prose(rng, 30)), (1, prose(rng, 20)), (None, None)]
    rows = [(k, prose(rng, 10) + " " + items[k % 3][1]) for k in range(6)] + [(9, prose(rng, 40))]
    got = sorted((r["doc_id"], r["item_id"], r["item_words"]) for r in decontaminate.leaks(docs(spark, rows), benchmark(spark, items)).collect())
    assert got == [(k, (None, None, 1)[k % 3], (20, 30, 20)[k % 3]) for k in range(6)]
    assert [r["doc_id"] for r in decontaminate.without_leaks(docs(spark, rows), benchmark(spark, items)).collect()] == [9]


def distance_of(text, words):
    return decontaminate.edit_distances(text[None], words[None], np.array([len(words)]))[0]


@pytest.mark.parametrize("where", ["random", "head", "tail", "spread"])
@pytest.mark.parametrize("substituted", [1.0, 0.5])
def test_recall_at_the_greatest_distance(substituted, where):
    rng = np.random.default_rng(3)
    vocabulary = rng.integers(1, 2**63, 3000, dtype=np.uint64)
    sizes = [*range(1, 31), 48, 60, 63, 64, 96, 192, 384, 768, 1000] * 2
    items = decontaminate.Items(list(range(len(sizes))), [rng.choice(vocabulary, n) for n in sizes])
    found = 0
    for i, words in enumerate(items.words):
        most = int(0.2 * len(words))
        edited = [[x] for x in words]
        places = {"random": rng.choice(len(words), most, replace=False), "head": np.arange(most), "tail": np.arange(len(words) - most, len(words)), "spread": np.arange(most) * len(words) // max(1, most)}
        for p in places[where]:
            kind = 0 if rng.random() < substituted else rng.integers(1, 3)
            edited[p] = [[rng.choice(vocabulary)], [], [words[p], rng.choice(vocabulary)]][kind]
        text = np.concatenate([rng.choice(vocabulary, rng.integers(0, 40)), np.array(sum(edited, []), np.uint64), rng.choice(vocabulary, rng.integers(0, 40))])
        distance = distance_of(text, words)
        assert distance <= most
        found += decontaminate._search(text, np.zeros(len(text), int), items).get((0, i)) == distance
    assert found >= 0.95 * len(sizes)


def words_hashed(text):
    data = np.frombuffer((text or "").lower().encode(), np.uint8)
    return words_of(data, np.array([0, len(data)]), decontaminate._INSIDE)[2]


@pytest.mark.parametrize("block_words", [1 << 16, 300])
def test_recall_on_the_tables(spark, block_words):
    """Every leak of sf0.01, found by the distance of every item to every document."""
    there = "/root/testdata/sf0.01"
    texts, bench = (spark.read.parquet(f"{there}/{t}.parquet") for t in ("documents", "benchmark"))
    items = [(r["item_id"], words_hashed(r["text"])) for r in bench.collect()]
    width = np.array([len(w) for _, w in items])
    order = np.argsort(-width, kind="stable")
    padded = np.zeros((len(items), width.max()), np.uint64)
    for k, i in enumerate(order):
        padded[k, : width[i]] = items[i][1]
    want = {}
    for r in texts.collect():
        text = words_hashed(r["text"])
        distance = decontaminate.edit_distances(np.repeat(text[None], len(items), 0), padded, width[order])
        want |= {(r["doc_id"], items[i][0]): int(d) for i, d in zip(order, distance) if d <= int(0.2 * width[i])}
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in decontaminate.leaks(texts, bench, block_words=block_words).collect()}
    assert set(got) <= set(want) and all(want[k] == d for k, d in got.items())
    assert len(want) > 10 and len(got) >= 0.95 * len(want)


def test_measures_like_brute_force(spark):
    rng = random.Random(2)
    texts = [None, "", "  \n", "a", "a b a b a b", "x\nx\n x\n\n\nx", "#*$%&|<> é ü", "a b\x1cc\x85d", *(prose(rng, n) for n in (49, 50, 51, 200))]
    texts += ["\n".join(rng.choice(["one two three", "four", "", " "]) for _ in range(40)) for _ in range(5)]
    rows = [(i, t, rng.choice(["en", None]), rng.choice(["s", None])) for i, t in enumerate(texts)] + [(3, "a")]
    got = quality.apply_rules(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        text = dict((a, b) for a, b, *_ in rows)[r["doc_id"]] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        seen, repeated = set(), 0
        for line in text.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                repeated += line in seen
                seen.add(line)
        triples = collections.Counter(zip(words, words[1:], words[2:]))
        covered = {k + o for k in range(len(words) - 2) if triples[tuple(words[k : k + 3])] > 1 for o in range(3)}
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered), len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == want
        assert not (r["kept"] and r["base_failed"])


def test_adaptive_thresholds(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, 120), "en", f"s{i % 2}") for i in range(500)]
    rows += [(1000 + i, " ".join(w + "###" for w in prose(rng, 120).split()), "en", f"s{i % 2}") for i in range(20)]
    rows += [(2000 + i, prose(rng, 120).replace(" ", "$ "), "en", "code") for i in range(300)]  # symbols are usual here
    got = {r["doc_id"]: r["kept"] for r in quality.apply_rules(docs(spark, rows)).collect()}
    assert all(got[i] for i in range(500)) and not any(got[1000 + i] for i in range(20)) and all(got[2000 + i] for i in range(300))
    assert quality.apply_rules(docs(spark, [])).count() == 0


def test_equal_texts_in_other_groups(spark):
    """The same text stays where such texts are usual and goes where they are not; fences differ in every sparse measure."""
    rng = random.Random(13)
    lines = lambda n, k: "\n".join([prose(rng, 9) for _ in range(n - k)] + [prose(rng, 9)] * (k + 1))
    triples = lambda n, k: " ".join([prose(rng, n - 3 * k), *([prose(rng, 3)] * k)])
    signs = lambda k: " ".join(w + "$" * (i < k) for i, w in enumerate(prose(rng, 100).split()))
    rows = [(i, prose(rng, 120) if i % 4 else [signs(1), lines(20, 1), triples(120, 2)][i // 4 % 3], "en", "plain") for i in range(600)]
    for k in range(300):
        rows.append((1000 + k, signs(rng.randrange(30, 100)), "c", "code"))
        rows.append((2000 + k, lines(20, rng.randrange(3, 9)), "l", "lists"))
        rows.append((3000 + k, triples(120, rng.randrange(4, 17)), "f", "forms"))
    shared = {"symbols": (signs(70), "c", "code"), "dup_lines": (lines(20, 8), "l", "lists"), "repeats": (triples(120, 15), "f", "forms")}
    rows += [(5000 + 2 * i + j, text, *[(lang, usual), ("en", "plain")][j]) for i, (text, lang, usual) in enumerate(shared.values()) for j in (0, 1)]
    got = {r["doc_id"]: r for r in quality.apply_rules(docs(spark, rows)).collect()}
    for i, name in enumerate(shared):
        here, there = got[5000 + 2 * i], got[5001 + 2 * i]
        assert not here["base_failed"] and here["kept"] and not there["kept"] and there["failed_measure"] == name
    assert sum(got[i]["kept"] for i in range(600)) > 570
    table = quality.measured(docs(spark, rows))
    fences = quality.thresholds(quality.sketches(table), table.select("lang", "source").distinct()).collect()
    assert all(len({r[f"{m}_high"] for r in fences}) > 2 for m in quality.SPARSE)


def labelled(spark, n):
    rng = random.Random(7)
    bad = ["grobnik", "vilestump", "drecksack"]
    rows, labels = [], []
    for i in range(n):
        words = prose(rng, rng.randint(5, 150)).split()
        toxic = int(rng.random() < 0.2)
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(bad)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return rows, spark.createDataFrame(labels + [(None, 1, 1), (n + 1, 0, None)], "doc_id long, quality int, toxic int"), labels


def test_toxicity_on_held_out_documents(spark):
    rows, labels, told = labelled(spark, 900)
    rows += [(5000, prose(random.Random(1), 40) + " vilestumpp"), (5001, None), (5002, ""), (5003, " \n"), (None, "grobnik")]
    out = toxicity.scored(docs(spark, rows), labels, ["doc_id", "tid"]).collect()
    score = {r["doc_id"]: r["_tx_score"] for r in out}
    assert len(out) == len(rows) and all(0 <= s <= 1 for s in score.values())
    held = [(t, score[i] >= 0.3) for i, _, t in told if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([t == p for t, p in held]) > 0.95 and np.mean([p for t, p in held if t]) > 0.9
    assert score[5000] >= 0.3  # an unseen misspelling
    assert score[5001] == score[5002] == score[5003] < 0.3
    kept = toxicity.without_toxic(docs(spark, rows), labels)
    assert kept.columns == docs(spark, rows).columns and kept.count() == sum(s < 0.3 for s in score.values())


def test_repeated_rows_and_long_texts_do_not_change_toxicity(spark):
    rows, labels, told = labelled(spark, 900)
    clean = {i for i, _, t in told if not t}
    one = {r["doc_id"]: r["_tx_score"] for r in toxicity.scored(docs(spark, rows), labels, ["doc_id"]).collect()}
    more = rows + [r for r in rows if r[0] in clean for _ in range(7)] + [(7000, "w" * 300_000 + " " + "plain words " * 40_000), (7001, None)]
    again = toxicity.scored(docs(spark, more), labels, ["doc_id"]).collect()
    assert len(again) == len(more)
    for r in again:
        assert abs(one.get(r["doc_id"], r["_tx_score"]) - r["_tx_score"]) < 1e-9
    assert 0.5 * sum(t for *_, t in told) < sum(s >= 0.3 for s in one.values()) < 1.5 * sum(t for *_, t in told)


def test_scores_like_plain_python(spark):
    """The trained table applied word by word, n-gram by n-gram."""
    rng = np.random.default_rng(2)
    table = rng.normal(0, 1, toxicity.BUCKETS).astype(np.float32)

    def ids(word):
        code = [32, *map(ord, word), 32]
        value = mix(np.array(code, np.uint64))
        for n in toxicity.GRAMS:
            for k in range(len(code) - n + 1):
                total = np.uint64(0)
                for j in range(n):
                    total = total + value[k + j] * toxicity._FACTOR[j]
                yield int(mix(np.array([total + np.uint64(n)]))[0] >> np.uint64(64 - 17))

    with np.errstate(over="ignore"):
        for text in ["a", "ab cd", "one two\tthree\nünï 日本語", " ".join(f"w{i}x" for i in range(50)), ""]:
            words = text.split()
            best = [np.mean([table[x] for w in words[a : a + toxicity.SEGMENT] for x in ids(w)]) for a in range(0, len(words), toxicity.SEGMENT)]
            got = toxicity.highest(["other words", text, ""], table)[1]
            assert np.isnan(got) if not best else abs(got - max(best)) < 1e-4


@pytest.mark.parametrize("prefix, run", [
    ("_tx_text", lambda d, s: toxicity.scored(d, s.createDataFrame([], "doc_id long, toxic int"), ["doc_id"])),
    ("_dc_x", lambda d, s: decontaminate.without_leaks(d, benchmark(s, []))),
    ("_nj_x", lambda d, s: ngram_join.keep_one_of_each(d)),
    ("_ld_x", lambda d, s: line_dedup.dedup_lines(d)),
])
def test_clashing_names_are_refused(spark, prefix, run):
    with pytest.raises(ValueError, match=prefix):
        run(docs(spark, [(1, "a b")]).withColumn(prefix, F.lit(1)), spark)


def long_rows():
    rng = random.Random(9)
    text = prose(rng, 40_000)
    return [(1, text), (2, text + " more"), (3, "short text of a few words"), (4, "x" * 500_000), (5, None), (6, "\n".join(prose(rng, 3) for _ in range(20_000)))]


def test_very_long_texts(spark):
    table = docs(spark, long_rows())
    assert {r["doc_id"]: r["class_id"] for r in ngram_join.near_classes(table).collect()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6}
    measured = {r["doc_id"]: r["n_words"] for r in quality.apply_rules(table).collect()}
    assert measured == {i: len((t or "").split()) for i, t in long_rows()}
    item = " ".join(long_rows()[0][1].split()[30_000:30_020])
    assert {r["doc_id"] for r in decontaminate.leaks(table, benchmark(spark, [(7, item)])).collect()} == {1, 2}
    lines = {r["doc_id"]: r["_ld_removed"] for r in line_dedup.dedup_lines(table).collect()}
    assert lines == dict.fromkeys(range(1, 7), 0)


def test_the_shuffled_ways_give_the_same(spark, monkeypatch):
    """No side may be broadcast: every join falls back to a shuffle."""
    rng = random.Random(12)
    base = [prose(rng, 80) for _ in range(12)]
    rows = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(base)] + [(100 + i, t + " end", "en", f"s{i % 2}") for i, t in enumerate(base[:6])]
    rows += [(200 + i, "\n".join(["a b c", "d e f", "g h i", prose(rng, 4)]), "de", None) for i in range(5)]
    pages = spark.createDataFrame([(i, "u", base[i % 4] * 4) for i in range(12)], "page_id long, url string, html string")
    items = benchmark(spark, [(1, " ".join(base[2].split()[5:40])), (2, base[3])])

    def everything():
        table = docs(spark, rows)
        yield line_dedup.dedup_lines(table)
        yield mixture.mix_sources(table)
        yield ngram_join.near_classes(table)
        yield ngram_join.keep_one_of_each(table)
        yield quality.apply_rules(table)
        yield decontaminate.without_leaks(table, items)
        space = Workspace(spark, "pages")
        yield warc.read_packages(spark, warc.write_packages(pages, f"{space.path}/files", space=space)).drop("payload")

    usual = [sorted(map(str, x.collect())) for x in everything()]
    for module in (shared, line_dedup, mixture, quality, warc):
        monkeypatch.setattr(module, "BROADCAST_ROWS", -1)
    assert usual == [sorted(map(str, x.collect())) for x in everything()]


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, 1, 1)]])
def test_toxicity_without_two_classes(spark, labels):
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = toxicity.scored(docs(spark, [(1, "a b"), (2, None)]), table, ["doc_id"]).collect()
    assert len({r["_tx_score"] for r in out}) == 1
    assert toxicity.scored(docs(spark, []), table, ["doc_id"]).count() == 0


TEXTS = ["", None, "one line", "two lines\nof text\n", "\n\n a\n\nb", "ünï\ncödé 日本語\n text", "don't   stop\n\n\n  here", "x" * 3000 + "\n" + "y z " * 500]


@pytest.mark.parametrize("rule", ["first", "last", "share"])
def test_tokens_like_brute_force(spark, rule):
    encoding, sizes = token_counts.encoder(VOCABULARY)
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[3])]
    got = collections.defaultdict(list)
    for r in token_counts.section_tokens(docs(spark, rows), VOCABULARY, rule).orderBy("doc_id", "section").collect():
        got[r["doc_id"]].append(r)
    for i, text in enumerate(TEXTS):
        raw = (text or "").encode()
        spans, at = [], 0
        for t in encoding.encode_ordinary(text or ""):
            piece = encoding.decode_single_token_bytes(t)
            assert raw[at : at + len(piece)] == piece
            spans.append((at, at + len(piece)))
            at += len(piece)
        assert at == len(raw)
        cut = [0] + [k + 1 for k, x in enumerate(raw) if x == 10 and k + 1 < len(raw)] + [len(raw)]
        mine = got[i][:: 2 if i == 3 else 1]
        assert len(mine) == len(cut) - 1
        for k, r in enumerate(mine):
            a, b = cut[k], cut[k + 1]
            touch = [(s, e) for s, e in spans if s < b and e > a]
            want = {"first": sum(a <= s < b for s, _ in spans), "last": sum(a < e <= b for _, e in spans), "share": sum((min(e, b) - max(s, a)) / (e - s) for s, e in touch)}[rule]
            assert abs(r["n_tokens"] - want) < 1e-9 and r["n_touching"] == len(touch) and r["doc_tokens"] == len(spans)
            assert (text or "")[r["char_begin"] : r["char_end"]].encode() == raw[a:b]
    with pytest.raises(ValueError):
        token_counts.section_tokens(docs(spark, []), VOCABULARY, "middle")
    assert token_counts.section_tokens(docs(spark, []), VOCABULARY).count() == 0


def test_word_hashes_are_exact():
    text = "a b  c\n\tab é ab".encode() * 3
    data = np.frombuffer(text, np.uint8)
    starts, row, hashes = words_of(data, np.array([0, len(text) // 3, len(text)]), quality._INSIDE)
    assert len(starts) == len([w for part in (text[: len(text) // 3], text[len(text) // 3 :]) for w in part.split()])
    seen = {}
    for s, h in zip(starts, hashes):
        word = re.match(rb"[^\x20\x09-\x0D]+", text[s : len(text) // 3 if s < len(text) // 3 else None])[0]
        assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_long_texts_score_as_in_one_piece(monkeypatch):
    """Parts end where segments do; one segment longer than a part is summed over parts."""
    rng = random.Random(17)
    table = np.random.default_rng(2).normal(0, 1, toxicity.BUCKETS).astype(np.float32)
    word = lambda n: "".join(rng.choice("abcdeé ßx中") for _ in range(n)).replace(" ", "_")
    texts = [prose(rng, 500), " ".join(word(rng.choice([3, 9, 400])) for _ in range(120)), word(3000), word(900) + " " + prose(rng, 40) + "\n\n" + word(700), " \n ", "a b", prose(rng, 47) + " " + word(500)]
    whole = [float(toxicity.highest([t], table)[0]) for t in texts]
    monkeypatch.setattr(toxicity, "PIECE", 64)
    for text, want in zip(texts, whole):
        assert "".join(toxicity.parts_of_text(text)) == text
        assert np.isclose(toxicity.highest_of_long(text, table), want, rtol=1e-5, equal_nan=True)


def test_training_reads_long_segments():
    text = "x" * 10_000 + " " + " ".join(["w"] * 31)
    got = toxicity.drawn(text, 100, 1)
    assert [len(x) for x in got[:3]] == [4096, 4096, 10_030 - 2 * 4096] and len(got) == 4 and "".join(got[:3]).startswith("x" * 10_000)
    assert len(toxicity.drawn(text, 2, 1)) == 2
