"""Format-preserving pseudonyms of personal numbers, dates and addresses (operator 8).

Everything runs in DataFrame functions.  Candidates are found by ``PATTERN``, validated, and
permuted by a keyed Feistel network over their own format: a list of symbols with a radix for
each place, split in two halves that are shifted in turn by SHA-256 of key, kind, round and the
other half.  The map is a permutation of each format, so equal values get equal pseudonyms in all
documents, different ones stay different, and ``inverse=True`` with the key restores the text.

| kind | validated by | permuted |
|-|-|-|
| email | shape | letters and digits of the local part, case and marks kept |
| card | 13 to 19 digits, plain or in printed groups, Luhn | all digits but the last, which is computed anew |
| iban | letters, length, check digits mod 97, plain or in printed groups of four | letters and digits of the account, check computed anew |
| ssn | nnn-nn-nnnn, no reserved group | digits, walking until valid |
| phone | (nnn) nnn-nnnn or nnn-nnn-nnnn, with or without +1; or + and 8 to 15 digits | digits after the country code, whatever the marks between; without a code that of +1 |
| ipv4 | four numbers up to 255 | the four numbers |
| date | a real day as yyyy-mm-dd, dd/mm/yyyy or dd.mm.yyyy; or else mm/dd/yyyy; years 0001 to 9999 | the day within its cycle of 400 years, walking until the year has four digits and the day of the month is on the same side of the 12th |

Defined results: null stays null, texts without valid matches stay as they are; candidates that
fail validation are left alone (also a printed IBAN that runs on into a further group of capitals and
digits).  Repeated rows get equal results.  Columns other than the text pass unchanged; names
starting with ``_pii`` are refused.  An empty table gives no row.  Spellings of one phone number, card,
IBAN or day get the same new number or day, each in its own spelling.  IPv6 addresses, and social security numbers with other
marks than hyphens, are no kind.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import refuse

ROUNDS = 8

_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}"
_IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
_DATE = r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9/-])"
_IPV4 = r"(?<![0-9.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9]|\.[0-9])"
_CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{1,7}|[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{1,7}|[0-9]{4} [0-9]{6} [0-9]{5}|[0-9]{4}-[0-9]{6}-[0-9]{5})(?![0-9])"
_SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
_PHONE = r"(?:\+1[ .-]?)?\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])|(?<![0-9-])(?:\+1[ .-])?[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9])|\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9]|[/.-][0-9])"
PATTERN = "|".join([_EMAIL, _IBAN, _DATE, _IPV4, _CARD, _SSN, _PHONE])


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """Bind a value that is used more than once."""
    return F.get(F.transform(F.array(value), then), 0)


def feistel(digits: Column, radices: Column, key: Column, inverse: bool = False) -> Column:
    """Permute a list of digits, each below its radix: a Feistel network on its two halves."""
    half = F.floor(F.size(digits) / 2).cast("int")
    sign = -1 if inverse else 1

    def shift(mine: Column, other: Column, radix: Column, k: Column) -> Column:
        mac = F.sha2(F.concat_ws("|", key, k.cast("string"), F.array_join(other.cast("array<string>"), ",")), 256)
        # 15 numbers of 16 bits from each digest; longer halves use them again
        part = lambda h, i: F.conv(F.substr(h, (i % 15) * 4 + 1, F.lit(4)), 16, 10).cast("int")
        return let(mac, lambda h: F.transform(mine, lambda x, i: F.pmod(x + sign * part(h, i), F.get(radix, i))))

    def both(state: Column) -> Column:
        left, right = state["left"], state["right"]
        left_radix, right_radix = F.slice(radices, 1, half), F.slice(radices, half + 1, F.size(radices))

        def step(s: Column, k: Column) -> Column:
            even = k % 2 == 0
            new_left = F.when(even, shift(s["left"], s["right"], left_radix, k)).otherwise(s["left"])
            new_right = F.when(even, s["right"]).otherwise(shift(s["right"], s["left"], right_radix, k))
            return F.struct(new_left.alias("left"), new_right.alias("right"))

        order = F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)) if inverse else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
        return F.aggregate(order, F.struct(left.alias("left"), right.alias("right")), step, lambda s: F.concat(s["left"], s["right"]))

    return both(F.struct(F.slice(digits, 1, half).alias("left"), F.slice(digits, half + 1, F.size(digits)).alias("right")))


def walk(start: Column, once: Callable[[Column], Column], valid: Callable[[Column], Column]) -> Column:
    """Apply a permutation until the value is valid again (cycle walking)."""
    step = lambda s, _: F.when(s["done"], s).otherwise(let(once(s["v"]), lambda v: F.struct(v.alias("v"), valid(v).alias("done"))))
    return F.aggregate(F.sequence(F.lit(1), F.lit(64)), F.struct(start.alias("v"), F.lit(False).alias("done")), step, lambda s: s["v"])


def _characters(text: Column) -> Column:
    return F.split(text, "")


def _permuted(text: Column, fixed: Callable[[Column, Column], Column], key: Column, inverse: bool, low: Callable[..., tuple] | None = None) -> Column:
    """Permute letters and digits within their class; fixed(character, place) are kept."""
    chars = F.filter(_characters(text), lambda c: c != "")

    def info(c: Column, i: Column) -> Column:
        code = F.ascii(c)
        base = F.when((code >= 48) & (code <= 57), 48).when((code >= 65) & (code <= 90), 65).when((code >= 97) & (code <= 122), 97).otherwise(code)
        radix = F.when((code >= 48) & (code <= 57), 10).when((code >= 65) & (code <= 90) | (code >= 97) & (code <= 122), 26).otherwise(1)
        if low is not None:
            base, radix = low(base, radix, c, i)
        base, radix = F.when(fixed(c, i), code).otherwise(base), F.when(fixed(c, i), 1).otherwise(radix)
        return F.struct(base.alias("base"), radix.alias("radix"), (code - base).alias("digit"))

    def put(places: Column) -> Column:
        moving = F.filter(places, lambda p: p["radix"] > 1)
        new = feistel(F.transform(moving, lambda p: p["digit"]), F.transform(moving, lambda p: p["radix"]), key, inverse)
        # the j-th moving place takes the j-th new digit
        fold = lambda s, p: F.struct(
            F.when(p["radix"] > 1, s["j"] + 1).otherwise(s["j"]).alias("j"),
            F.concat(s["out"], F.char(p["base"] + F.when(p["radix"] > 1, F.get(s["new"], s["j"])).otherwise(F.lit(0)))).alias("out"),
            s["new"].alias("new"),
        )
        return F.aggregate(places, F.struct(F.lit(0).alias("j"), F.lit("").alias("out"), new.alias("new")), fold, lambda s: s["out"])

    return let(F.transform(chars, info), put)


def _never(c: Column, i: Column) -> Column:
    return F.lit(False)


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Luhn sum of a digit string; doubled: the parity, from the right, of places that count twice."""
    reverse = F.reverse(F.filter(_characters(digits), lambda c: c != ""))
    value = F.transform(reverse, lambda c, i: let(c.cast("int") * F.when(i % 2 == doubled, 2).otherwise(1), lambda x: F.when(x > 9, x - 9).otherwise(x)))
    return F.aggregate(value, F.lit(0), lambda a, x: a + x)


def _card(text: Column, key: Column, inverse: bool) -> Column:
    digits = F.regexp_replace(text, "[^0-9]", "")

    def change(d: Column) -> Column:
        head = _permuted(F.substr(d, F.lit(1), F.length(d) - 1), _never, key, inverse)
        whole = let(head, lambda h: F.concat(h, F.pmod(-_luhn_sum(h, 0), F.lit(10)).cast("string")))
        # separators return to their places: groups of four, or of four, six and five
        mark = F.regexp_extract(text, "[ -]", 0)
        cut = lambda w, *sizes: F.concat(*[y for i, n in enumerate(sizes) for y in (mark, F.substr(w, F.lit(1 + sum(sizes[:i])), F.lit(n)))][1:])
        three = text.rlike("^[0-9]{4}[ -][0-9]{6}[ -]")
        return let(whole, lambda w: F.when(mark == "", w).when(three, cut(w, 4, 6, 5)).otherwise(cut(w, 4, 4, 4, 7)))

    size = F.length(digits)
    return F.when((size >= 13) & (size <= 19) & (_luhn_sum(digits, 1) % 10 == 0), let(digits, change)).otherwise(text)


def _mod97(text: Column) -> Column:
    each = F.filter(_characters(text), lambda c: c != "")
    step = lambda a, c: let(F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55), lambda x: F.when(x > 9, (a * 100 + x) % 97).otherwise((a * 10 + x) % 97))
    return F.aggregate(each, F.lit(0), step)


def _iban(text: Column, key: Column, inverse: bool) -> Column:
    country, account = F.substr(text, F.lit(1), F.lit(2)), F.substr(text, F.lit(5), F.length(text))
    plain = lambda x: F.replace(x, F.lit(" "), F.lit(""))
    size = F.length(plain(text))
    valid = (size >= 15) & (size <= 34) & (_mod97(F.concat(plain(account), F.substr(text, F.lit(1), F.lit(4)))) == 1)

    def change(a: Column) -> Column:
        check = F.lpad((98 - _mod97(F.concat(plain(a), country, F.lit("00")))).cast("string"), 2, "0")
        return F.concat(country, check, a)

    return F.when(valid, let(_permuted(account, _never, F.concat(key, country), inverse), change)).otherwise(text)


def _ssn(text: Column, key: Column, inverse: bool) -> Column:
    valid = lambda v: ~v.rlike("^(000|666|9..)-") & ~v.rlike("-00-") & ~v.rlike("-0000$")
    return F.when(valid(text), walk(text, lambda v: _permuted(v, _never, key, inverse), valid)).otherwise(text)


# Country codes of one and of two digits (ITU-T E.164); all others have three.
ONE_DIGIT = ("1", "7")
TWO_DIGITS = ("20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "53", "54", "55", "56", "57", "58",
              "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98")


def _phone(text: Column, key: Column, inverse: bool) -> Column:
    digits = F.regexp_replace(text, "[^0-9]", "")
    part = lambda d, a, n: F.substr(d, F.lit(a), F.lit(n))
    known = F.when(~text.startswith("+"), 0).when(part(digits, 1, 1).isin(*ONE_DIGIT), 1).when(part(digits, 1, 2).isin(*TWO_DIGITS), 2).otherwise(3)
    # a number without a country is one of +1: its spellings are one number
    country = F.when(known == 0, "1").otherwise(F.substr(digits, F.lit(1), known))
    own = F.substr(digits, known + 1, F.length(digits))
    national = (country == "1") & (F.length(own) == 10)

    def low(base: Column, radix: Column, c: Column, i: Column):
        # first digits of area and exchange stay in 2 to 9, or else in 0 and 1
        first = national & ((i == 0) | (i == 3))
        high = F.ascii(c) >= 50
        return F.when(first, F.when(high, 50).otherwise(48)).otherwise(base), F.when(first, F.when(high, 8).otherwise(2)).otherwise(radix)

    def put(new: Column) -> Column:
        """The new digits in the places of the old; those of the country stay."""
        step = lambda s, c: F.struct(
            F.when(c.rlike("[0-9]"), s["j"] + 1).otherwise(s["j"]).alias("j"),
            F.concat(s["out"], F.when(c.rlike("[0-9]") & (s["j"] >= known), F.substr(new, s["j"] - known + 1, F.lit(1))).otherwise(c)).alias("out"),
        )
        return F.aggregate(F.filter(_characters(text), lambda c: c != ""), F.struct(F.lit(0).alias("j"), F.lit("").alias("out")), step, lambda s: s["out"])

    able = F.length(digits).between(8, 15)
    return F.when(able, let(_permuted(own, _never, F.concat(key, country), inverse, low), put)).otherwise(text)


def _ipv4(text: Column, key: Column, inverse: bool) -> Column:
    parts = F.split(text, r"\.").cast("array<int>")
    valid = F.forall(F.split(text, r"\."), lambda x: (x.cast("int") <= 255) & (x.cast("int").cast("string") == x))
    new = feistel(parts, F.array(*[F.lit(256)] * 4), key, inverse)
    return F.when(valid, F.array_join(new.cast("array<string>"), ".")).otherwise(text)


_DAY_0 = date(1800, 1, 1)
_FIRST, _LAST = (date.min - _DAY_0).days, (date.max - _DAY_0).days


def _day(year: Column, month: Column, day: Column) -> Column:
    """Days since 1800-01-01, or null if there is no such day in the years 0001 to 9999."""
    n = F.datediff(F.try_to_date(F.concat_ws("-", year, month, day), "yyyy-MM-dd"), F.lit(_DAY_0))
    return F.when(n.between(_FIRST, _LAST), n)


def _date(text: Column, key: Column, inverse: bool) -> Column:
    # A cycle of 400 years has 146097 = 189 * 773 days.
    iso = text.rlike("^[0-9]{4}-")
    sep = F.substr(text, F.lit(3), F.lit(1))
    cut = lambda a, n: F.substr(text, F.lit(a), F.lit(n))
    day = F.when(iso, _day(cut(1, 4), cut(6, 2), cut(9, 2))).otherwise(_day(cut(7, 4), cut(4, 2), cut(1, 2)))
    american = _day(cut(7, 4), cut(1, 2), cut(4, 2))

    def once(n: Column) -> Column:
        cycle = F.floor(n / 146097).cast("int")
        at = F.pmod(n, F.lit(146097))
        new = feistel(F.array(F.floor(at / 773).cast("int"), at % 773), F.array(F.lit(189), F.lit(773)), F.concat(key, cycle.cast("string")), inverse)
        return let(new, lambda d: cycle * 146097 + F.get(d, 0) * 773 + F.get(d, 1))

    shown = lambda n, form: F.date_format(F.date_add(F.lit(_DAY_0), n), form)
    european = lambda n: F.concat(shown(n, "dd"), sep, shown(n, "MM"), sep, shown(n, "yyyy"))
    # Of mm/dd/yyyy only days after the 12th can be told from dd/mm/yyyy: the walk stays on the side it comes from, in all forms.
    late = lambda n: shown(n, "dd").cast("int") > 12
    real = F.coalesce(day, F.when(~iso, american))
    new = walk(real, once, lambda n: n.between(_FIRST, _LAST) & (late(n) == late(real)))
    american_of = lambda n: F.concat(shown(n, "MM"), sep, shown(n, "dd"), sep, shown(n, "yyyy"))
    return F.when(real.isNotNull(), let(new, lambda n: F.when(iso, shown(n, "yyyy-MM-dd")).when(day.isNotNull(), european(n)).otherwise(american_of(n)))).otherwise(text)


def _email(text: Column, key: Column, inverse: bool) -> Column:
    local, domain = F.substring_index(text, "@", 1), F.substring_index(text, "@", -1)
    return F.concat(_permuted(local, _never, F.concat(key, F.lower(domain)), inverse), F.lit("@"), domain)


def pseudonym(match: Column, key: Column, inverse: bool = False) -> Column:
    """The pseudonym of one match of PATTERN, or the match itself if it is not valid."""
    whole = lambda p: match.rlike("^(?:" + p + ")$")
    kinds = [("email", _EMAIL, _email), ("iban", _IBAN, _iban), ("date", _DATE, _date), ("ipv4", _IPV4, _ipv4), ("card", _CARD, _card), ("ssn", _SSN, _ssn), ("phone", _PHONE, _phone)]
    out = match
    for name, pattern, change in reversed(kinds):
        out = F.when(whole(pattern), change(match, F.concat(key, F.lit("|" + name)), inverse)).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, key: str, column: str = "text", inverse: bool = False) -> DataFrame:
    """``docs`` with the matches in ``column`` replaced, and _pii_found, the number that changed."""
    refuse(docs, "_pii")
    text = F.col(column)
    likely = text.rlike("[0-9@]")
    found = F.when(likely, F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)))
    docs = docs.withColumn("_pii", found)
    some = F.size("_pii") > 0
    new = F.when(some, F.transform("_pii", lambda m: pseudonym(m, F.lit(key), inverse)))
    docs = docs.withColumn("_pii_new", new)
    between = F.split(text, PATTERN, -1)
    joined = F.array_join(F.zip_with(between, "_pii_new", lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    changed = F.size(F.filter(F.zip_with("_pii", "_pii_new", lambda a, b: a != b), lambda x: x))
    return docs.withColumn("_pii_found", F.when(some, changed).otherwise(0).cast("long")).withColumn(column, F.when(some, joined).otherwise(text)).drop("_pii", "_pii_new")


#: The query's key; whoever uses the operator brings a secret one.
QUERY_KEY = "pseudonym-key-1"


def op8_pseudonyms(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pseudonymise(docs, QUERY_KEY).select("doc_id", "text", F.col("_pii_found").alias("n_replaced"))
