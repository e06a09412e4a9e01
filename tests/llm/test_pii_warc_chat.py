import hashlib
import io
import random
import re
import time
import zipfile
from datetime import date, timedelta

import pytest
from helpers import docs, prose
from pyspark.sql import functions as F

from chromaloom.llm import chat, pseudonyms, warc


def luhn(number):
    digits = [int(x) for x in re.sub(r"\D", "", number)][::-1]
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0


def iban_valid(text):
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def card(rng, n=16):
    body = "4" + "".join(str(rng.randrange(10)) for _ in range(n - 2))
    return next(body + str(k) for k in range(10) if luhn(body + str(k)))


def test_pseudonyms_keep_formats_and_links(spark):
    rng = random.Random(1)
    values = [card(rng) for _ in range(60)] + [card(rng, 13), card(rng, 19)]
    values += [f"{c[:4]} {c[4:8]} {c[8:12]} {c[12:]}" for c in values[:3]]
    values += [f"{rng.randint(1850, 2150)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}" for _ in range(60)] + ["2000-02-29", "29/02/2000", "31.12.1999", "02/28/1984"]
    values += [".".join(str(rng.randrange(256)) for _ in range(4)) for _ in range(40)]
    values += [f"+1 ({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randrange(10000):04}" for _ in range(40)] + ["(212) 555-0199", "212-555-0199", "+49 30 1234567"]
    values += [f"{prose(rng, 1)}.{rng.randrange(10, 99)}@mail.example.com" for _ in range(40)] + ["A.b-9@x.org", "123-45-6789", "665-01-0001"]
    values += ["GB82WEST12345698765432", "DE89370400440532013000"]
    values = sorted(set(values))
    bad = ["4041894974608796", "300.1.1.1", "1985-02-29", "31/02/2000", "000-12-3456", "DE89370400440532013001", "1.2.3", "v1.2.3.4.5"]
    rows = [(i, f"see {v}, or {v}; {prose(rng, 3)}") for i, v in enumerate(values)] + [(1000 + i, f"the {v} stays") for i, v in enumerate(bad)]
    rows += [(2000, None), (2001, ""), (2002, "é" * 50), (2003, " ".join(values)), (2004, "a" * 200_000), (0, rows[0][1])]
    out = pseudonyms.pseudonymise(docs(spark, rows), "k1").persist()
    assert out.columns == [*docs(spark, []).columns, "_pii_found"]
    text = {r["doc_id"]: r["text"] for r in out.collect()}
    new = {}
    for i, v in enumerate(values):
        found = re.fullmatch(r"see (.*), or (.*); .*", text[i])
        assert found[1] == found[2] != v, v
        new[v] = found[1]
        assert re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]+", "9", v))).count("9") == re.sub("[0-9]+", "9", found[1]).count("9")
    assert len(set(new.values())) == len(values)
    for v, n in new.items():
        if re.fullmatch(r"[\d ]{13,23}", v):
            assert luhn(n) and len(n) == len(v)
        if iban := re.fullmatch(r"[A-Z]{2}\d\d[A-Z0-9]{11,}", v):
            assert iban_valid(n) and n[:2] == iban[0][:2]
        if re.fullmatch(r"\d{4}-\d\d-\d\d", v):
            assert re.fullmatch(r"\d{4}-\d\d-\d\d", n)
        if re.fullmatch(r"\d+\.\d+\.\d+\.\d+", v):
            assert all(int(x) < 256 for x in n.split("."))
    grouped = {re.sub(r"\D", "", v): re.sub(r"\D", "", n) for v, n in new.items() if re.fullmatch(r"[\d ]{19}", v) and " " in v}
    assert all(new[c] == n for c, n in grouped.items() if c in new)
    for i, v in enumerate(bad):
        assert text[1000 + i] == f"the {v} stays"
    assert text[2000] is None and text[2001] == "" and text[2003] == " ".join(new[v] for v in values)
    back = pseudonyms.pseudonymise(out.drop("_pii_found"), "k1", inverse=True)
    assert sorted(map(str, back.drop("_pii_found").collect())) == sorted(map(str, docs(spark, rows).collect()))
    other = pseudonyms.pseudonymise(docs(spark, rows), "another").filter("doc_id = 2003").first()["text"]
    assert other != text[2003]


def own_feistel(digits, radices, key):
    """The network as plain Python."""
    half = len(digits) // 2
    left, right = list(digits[:half]), list(digits[half:])
    for k in range(8):
        mac = lambda side: hashlib.sha256(f"{key}|{k}|{','.join(map(str, side))}".encode()).hexdigest()
        part = lambda h, i: int(h[i % 15 * 4 : i % 15 * 4 + 4], 16)
        if k % 2 == 0:
            h = mac(right)
            left = [(x + part(h, i)) % radices[i] for i, x in enumerate(left)]
        else:
            h = mac(left)
            right = [(x + part(h, i)) % radices[half + i] for i, x in enumerate(right)]
    return left + right


def own_characters(text, key):
    ranges = [(48, 10), (65, 26), (97, 26)]
    home = [next(((b, r) for b, r in ranges if b <= ord(c) < b + r), None) for c in text]
    new = iter(own_feistel([ord(c) - h[0] for c, h in zip(text, home) if h], [h[1] for h in home if h], key))
    return "".join(chr(h[0] + next(new)) if h else c for c, h in zip(text, home))


def own_day(n, key):
    zero = date(1800, 1, 1)
    low, high = (date.min - zero).days, (date.max - zero).days
    late = lambda x: (zero + timedelta(x)).day > 12
    side = late(n)
    while True:
        cycle, at = divmod(n, 146097)
        a, b = own_feistel([at // 773, at % 773], [189, 773], f"{key}{cycle}")
        n = cycle * 146097 + a * 773 + b
        if low <= n <= high and late(n) == side:
            return n


def own_phone(v, key):
    digits = re.sub(r"\D", "", v)
    known = 0 if v[0] != "+" else 1 if digits[0] in "17" else 2 if digits[:2] in pseudonyms.TWO_DIGITS else 3
    country, own = digits[:known] or "1", digits[known:]
    base = [(50, 8) if c >= "2" else (48, 2) if country == "1" and len(own) == 10 and i in (0, 3) else (48, 10) for i, c in enumerate(own)]
    base = [b if country == "1" and len(own) == 10 and i in (0, 3) else (48, 10) for i, b in enumerate(base)]
    new = own_feistel([ord(c) - b for c, (b, _) in zip(own, base)], [r for _, r in base], key + country)
    put = iter(digits[:known] + "".join(chr(b + x) for x, (b, _) in zip(new, base)))
    return "".join(next(put) if c.isdigit() else c for c in v)


def own_pseudonym(kind, v, key):
    key = f"{key}|{kind}"
    if kind == "phone":
        return own_phone(v, key)
    if kind == "date":
        form = "%Y-%m-%d" if v[4] == "-" else f"%d{v[2]}%m{v[2]}%Y" if int(v[3:5]) <= 12 else f"%m{v[2]}%d{v[2]}%Y"
        old = date(*time.strptime(v, form)[:3])
        new = date(1800, 1, 1) + timedelta(own_day((old - date(1800, 1, 1)).days, key))
        return form.replace("%Y", f"{new.year:04}").replace("%m", f"{new.month:02}").replace("%d", f"{new.day:02}")
    if kind == "ipv4":
        return ".".join(map(str, own_feistel(list(map(int, v.split("."))), [256] * 4, key)))
    if kind == "card":
        digits = re.sub(r"\D", "", v)
        head = own_characters(digits[:-1], key)
        whole = iter(next(head + str(k) for k in range(10) if luhn(head + str(k))))
        return "".join(next(whole) if c.isdigit() else c for c in v)
    if kind == "iban":
        account = own_characters(v[4:], key + v[:2])
        check = next(f"{k:02}" for k in range(2, 99) if iban_valid((v[:2] + f"{k:02}" + account).replace(" ", "")))
        return v[:2] + check + account
    if kind == "email":
        local, domain = v.split("@")
        return own_characters(local, key + domain.lower()) + "@" + domain
    if kind == "ssn":
        while True:
            v = own_characters(v, key)
            if not re.match("000|666|9", v) and "-00-" not in v and not v.endswith("-0000"):
                return v
    raise ValueError(kind)


#: Spellings of one number each.
PHONES = [
    ["+1 212-555-1234", "+1-212-555-1234", "212-555-1234", "(212) 555-1234", "+1 (212) 555-1234", "+12125551234", "212.555.1234"],
    ["+44 20 7946 0958", "+442079460958", "+44-20-7946-0958", "+44 2079 460958"],
    ["+49 30 1234567", "+49301234567"],
]
DAYS = [["2024-03-15", "15/03/2024", "15.03.2024", "03/15/2024"], ["1999-04-05", "05/04/1999", "05.04.1999"], ["0001-12-31", "12/31/0001"]]


def test_spellings_of_one_value_are_linked(spark):
    of = [(x, k) for k, spellings in enumerate(PHONES + DAYS) for x in spellings]
    table = docs(spark, [(i, f"at {x} now") for i, (x, _) in enumerate(of)])
    out = pseudonyms.pseudonymise(table, "secret").persist()
    got = {r["doc_id"]: r["text"][3:-4] for r in out.collect()}
    for k, spellings in enumerate(PHONES + DAYS):
        new = [(x, got[i]) for i, (x, own) in enumerate(of) if own == k]
        assert all(re.sub(r"\d", "9", x) == re.sub(r"\d", "9", y) and x != y for x, y in new)
        if k < len(PHONES):
            lone = {"1" * (x[0] != "+" and k == 0) + re.sub(r"\D", "", y) for x, y in new}
            assert len(lone) == 1, new
        else:
            days = {x: y for x, y in new}
            iso = days[spellings[0]]
            assert all({y[:4], y[5:7], y[8:]} == {iso[:4], iso[5:7], iso[8:]} if y[4] == "-" else sorted(re.split(r"\D", y)) == sorted(iso.split("-")) for y in days.values()), new
    back = pseudonyms.pseudonymise(out.drop("_pii_found"), "secret", inverse=True).drop("_pii_found")
    assert sorted(map(str, back.collect())) == sorted(map(str, table.collect()))


def test_pseudonyms_like_brute_force(spark):
    rng = random.Random(4)
    edges = ["0001-01-01", "0001-12-31", "0100-03-01", "0200-02-28", "9800-01-01", "9900-05-05", "9998-01-01", "9999-01-01", "9999-12-31", "1800-01-01", "2199-12-31", "2200-01-01"]
    of = [("date", x) for x in edges] + [("date", f"{rng.randint(1, 9999):04}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}") for _ in range(200)]
    of += [("ipv4", ".".join(str(rng.randrange(256)) for _ in range(4))) for _ in range(10)]
    of += [("card", x) for x in ("3782 822463 10005", "3782-822463-10005", "378282246310005", "4111 1111 1111 1111", "4222222222222", card(rng), card(rng, 19))]
    of += [("iban", x) for x in ("DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "GB82WEST12345698765432")]
    of += [("email", "Jane.Doe-42@Mail.example.org"), ("email", "x9@y.io"), ("ssn", "123-45-6789"), ("ssn", "665-01-0001")]
    of += [("date", x) for x in ("03/15/2024", "12/31/0001", "02.29.2000", "29/02/2000", "05/04/1999", "13.01.2020")]
    of += [("phone", x) for x in (*PHONES[0], *PHONES[1], *PHONES[2], "+7 495 123-45-67", "+351 21 123 4567", "100-020-3000", "+1 23456789")]
    table = docs(spark, [(i, f"on {v} ,") for i, (_, v) in enumerate(of)])
    out = pseudonyms.pseudonymise(table, "secret").persist()
    got = {r["doc_id"]: r["text"][3:-2] for r in out.collect()}
    for i, (kind, v) in enumerate(of):
        assert got[i] == own_pseudonym(kind, v, "secret"), (kind, v, got[i])
        assert kind == "ipv4" or len(got[i]) == len(v)
    named = {v: got[i] for i, (_, v) in enumerate(of)}
    assert named["DE89 3704 0044 0532 0130 00"].replace(" ", "") == named["DE89370400440532013000"]
    assert named["3782 822463 10005"].replace(" ", "") == named["378282246310005"] == named["3782-822463-10005"].replace("-", "")
    back = pseudonyms.pseudonymise(out.drop("_pii_found"), "secret", inverse=True).drop("_pii_found")
    assert sorted(map(str, back.collect())) == sorted(map(str, table.collect()))


def test_other_days_of_the_edges_come_back(spark):
    values = ["31.12.9999", "01/01/0001", "12/31/9999", "01/13/0001", "12/31/9900", "02.03.9850", "0000-01-01", "00.01.2000", "31/12/0000"]
    table = docs(spark, [(i, v) for i, v in enumerate(values)])
    out = pseudonyms.pseudonymise(table, "secret").persist()
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    for i, v in enumerate(values):
        assert (got[i] == v) == (i >= 6) and re.sub(r"\d", "9", got[i]) == re.sub(r"\d", "9", v)
    back = pseudonyms.pseudonymise(out.drop("_pii_found"), "secret", inverse=True)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == dict(enumerate(values))
    with pytest.raises(ValueError, match="_pii_new"):
        pseudonyms.pseudonymise(docs(spark, []).withColumn("_pii_new", F.lit(1)), "k")
    with pytest.raises(TypeError):
        pseudonyms.pseudonymise(table)


def test_feistel_is_a_permutation(spark):
    all_of_them = spark.range(6 * 7 * 5).select(F.array((F.col("id") % 6).cast("int"), (F.floor(F.col("id") / 6) % 7).cast("int"), (F.floor(F.col("id") / 42)).cast("int")).alias("d"))
    radices = F.array(*map(F.lit, (6, 7, 5)))
    new = all_of_them.select("d", pseudonyms.feistel(F.col("d"), radices, F.lit("k")).alias("n"))
    assert new.select("n").distinct().count() == 210
    assert new.filter(pseudonyms.feistel(F.col("n"), radices, F.lit("k"), inverse=True) != F.col("d")).count() == 0


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, path string")


@pytest.mark.parametrize("zip64", [False, True])
def test_packages_round_trip(spark, tmp_path, zip64):
    rng = random.Random(2)
    big, wide = prose(rng, 300), "é" * 600
    rows = [(i, f"http://x/{i} ä\r\n", prose(rng, rng.randint(0, 400))) for i in range(60)]
    rows += [(100, "u", big), (101, "v", big), (99, None, big), (102, "w", wide), (103, "w", wide), (104, "s", "short"), (105, "s", "short"), (106, "n", None), (107, "n", ""), (None, "z", big), (101, "v", big), (108, "e", "x" * 999), (109, "e", "x" * 999), (110, "f", "y" * 1000), (111, "f", "y" * 1000)]
    table = warc.write_packages(pages(spark, rows).repartition(3), str(tmp_path), zip64=zip64)
    assert sum(r["records"] for r in table.collect()) == len(rows)
    got = warc.read_packages(spark, table).collect()
    want = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == raw and p is not None]
        revisit = len(raw) >= 1000 and len([1 for _, _, h in rows if (h or "").encode() == raw]) > 1 and page_id != max(same)
        want.append((page_id, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", max(same) if revisit else None, None if revisit else raw))
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], r["payload"] if r["payload"] is None else bytes(r["payload"])) for r in got), key=str) == sorted(want, key=str)
    for r in table.collect():
        with zipfile.ZipFile(r["path"]) as package:  # an independent reader agrees
            assert package.testzip() is None and package.namelist() == [warc.DATA, warc.INDEX]
            assert all(x.compress_type == zipfile.ZIP_STORED for x in package.infolist())


def test_no_pages(spark, tmp_path):
    table = warc.write_packages(pages(spark, []), str(tmp_path))
    assert table.count() == 0 and warc.read_packages(spark, table).count() == 0


def reader(raw):
    return lambda at, n: raw[at : at + n]


def test_directory_of_foreign_archives():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as package:
        package.comment = b"a comment with PK\x05\x06 inside"
        for k in range(300):
            package.writestr(f"d/{k}.txt", f"data {k}")
        with package.open("forced.bin", "w", force_zip64=True) as f:
            f.write(b"zip64 " * 100)
    raw = out.getvalue()
    found = warc.directory(reader(raw), len(raw))
    assert len(found) == 301
    at, n = found["d/17.txt"]
    assert raw[at : at + n] == b"data 17"
    at, n = found["forced.bin"]
    assert raw[at : at + n] == b"zip64 " * 100
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as package:
        package.writestr("a", "a" * 1000)
    with pytest.raises(ValueError, match="stored"):
        warc.directory(reader(out.getvalue()), len(out.getvalue()))
    with pytest.raises(ValueError, match="central"):
        warc.directory(reader(b"nothing"), 7)


def test_many_members_need_zip64():
    out = io.BytesIO()
    package = warc.StoredZip(out)
    for k in range(70_000):
        package.add(f"{k}", [b"x"])
    package.close()
    raw = out.getvalue()
    assert len(warc.directory(reader(raw), len(raw))) == 70_000 == len(zipfile.ZipFile(io.BytesIO(raw)).namelist())


TURNS = [
    (1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "hello <|im_end|>"), (1, 3, "ann", None), (1, 3, "", "who"), (1, None, "bob", "late"),
    (2, 0, "system", "only"), (3, 0, None, "nobody"), (None, 0, "ann", "no id"), (4, 5, "bob", "x"), (4, 600, "bob", "y"), (4, 600, "bob", "y"), (4, -3, "bob", "before"),
    (5, 0, None, "same"), (5, 0, "unknown", "same"), (5, 1, "unknown", "mine"), (5, 2, None, "not mine"), (5, 3, "un\nkno|wn", "é" * 50_000),
    *((6, t, ("ann", "bob", "system")[t % 3], f"<|{t} é") for t in range(0, 1300, 7)), (6, None, "ann", "last"), (6, None, "ann", "last"),
]


def rendered():
    cast = {(c, r) for c, _, r, _ in TURNS if r not in (None, "", "system")}
    want = {}
    for c, who in cast:
        text, spans = "", []
        for _, turn, role, said in sorted((t for t in TURNS if t[0] == c), key=lambda t: (t[1] is None, t[1] or 0, t[2] or "unknown", t[3] or "", bool(t[2]))):
            shown = "system" if role == "system" else "assistant" if role == who else "user name=" + (role or "unknown").replace("\n", " ")
            text += f"<|im_start|>{shown}\n"
            body = (said or "").replace("<|", "<\\|") + "<|im_end|>"
            spans += [(len(text), len(text) + len(body))] if role == who else []
            text += body + "\n"
        want[c, who] = (text, spans)
    return want


@pytest.mark.parametrize("part", [4, 512, 100_000])
def test_rotation_like_a_loop(spark, part):
    df = spark.createDataFrame([(*t, 1) for t in TURNS], "conv_id long, turn long, role string, text string, part int")
    rows = chat.rotate(df, part).collect()
    want = rendered()
    assert len(rows) == len(want)
    for r in rows:
        assert (r["text"], [(s["begin"], s["end"]) for s in r["spans"]]) == want[r["conv_id"], r["participant"]]
        assert r["n_turns"] == sum(t[0] == r["conv_id"] for t in TURNS)
    assert ("unknown" in {r["participant"] for r in rows}) and not any(r["participant"] in ("", None) for r in rows)
    assert chat.rotate(df.limit(0)).count() == 0 == chat.rotate_parts(df.limit(0)).count()


@pytest.mark.parametrize("part", [4, 512])
def test_parts_join_to_the_whole_dialogue(spark, part):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    got = chat.rotate_parts(df, part).collect()
    for key, (text, spans) in rendered().items():
        parts = sorted((r for r in got if (r["conv_id"], r["participant"]) == key), key=lambda r: r["begin"])
        assert "".join(r["text"] for r in parts) == text
        assert [(s["begin"], s["end"]) for r in parts for s in r["spans"]] == spans
    assert len({(r["conv_id"], r["participant"], r["part"]) for r in got}) == len(got)
