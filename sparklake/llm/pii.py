"""PII: format-preserving Feistel pseudonyms.

Numbers and dates that pass their check are permuted, under a key, within the values of
their format: card numbers among those with a right check digit, phone numbers (ten digits that
punctuation or +1 marks, bare ones whose area and exchange begin with 2 to 9, and with + and a
country code other countries') among numbers of their length and country, social security numbers among valid ones, IPv4 addresses, and dates among the days of 1900
to 2099.  Spaces and punctuation stay.  The permutation is the same everywhere, so equal
values stay linked across documents and different ones stay apart.  Mail addresses get a keyed hash.

The permutation is an alternating Feistel network of ``ROUNDS`` rounds over two halves of
mixed radix, with HMAC-like SHA-256 as its round function; values outside a
format are walked on from (cycle walking).  Everything is DataFrame functions: matches
are array elements, so no text is shuffled.

Defined results: null text stays null; values that fail their check stay as
they are; overlapping candidates: the leftmost, then the earlier kind; repeated
rows get equal pseudonyms; an empty table gives an empty result; extra columns are
carried under their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparklake.llm.common import ROW, field, packed, unpacked

#: For tests and the registered query; a user passes a secret.
DEMO_KEY = "change me"
ROUNDS = 10
MOST_STEPS = 64

#: Candidates by kind, in the order in which they are tried at a place.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])",
    "date": r"(?<![0-9A-Za-z-])(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}(?![0-9A-Za-z-])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "phone": (r"(?<![0-9A-Za-z])(?:\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
              r"|(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}|[2-9][0-9]{2}[2-9][0-9]{6}"
              r"|\+[2-9](?:[ .-]?\(?[0-9]\)?){7,14})(?![0-9A-Za-z])"),
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?:(?: [0-9]{4}){3}|(?:-[0-9]{4}){3}|[ -][0-9]{6}[ -][0-9]{5}))(?![0-9A-Za-z])",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
KINDS = list(PATTERNS)
COUNTRY = "^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
DAYS = 73_049  # 1900-01-01 to 2099-12-31
FIRST_DAY = "1900-01-01"


def _is_card(digits: Column) -> Column:
    """The Luhn sum of the digits is a multiple of ten."""
    total = F.aggregate(F.transform(F.split(F.reverse(digits), ""), _luhn_term), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def _luhn_term(c: Column, i: Column) -> Column:
    v = F.coalesce(F.try_to_number(c, F.lit("9")).cast("int"), F.lit(0))
    twice = v * 2
    return F.when(i % 2 == 0, v).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))


def _round_value(key: str, kind: str, step: Column, half: Column) -> Column:
    text = F.concat_ws("|", F.lit(key), F.lit(kind), step.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.sha2(F.concat(F.lit(key), F.sha2(text, 256)), 256), 1, 14), 16, 10).cast("long")


def feistel(value: Column, radix_a: Column, radix_b: Column, key: str, kind: str) -> Column:
    """``value`` below radix_a * radix_b, permuted among those values."""
    # the quotient is whole and below 2^53, so rounding makes it exact
    start = F.struct(F.round((value - value % radix_b) / radix_b).cast("long").alias("a"), (value % radix_b).alias("b"))

    def one(s: Column, step: Column) -> Column:
        a = F.when(step % 2 == 0, (s["a"] + _round_value(key, kind, step, s["b"])) % radix_a).otherwise(s["a"])
        b = F.when(step % 2 == 1, (s["b"] + _round_value(key, kind, step, s["a"])) % radix_b).otherwise(s["b"])
        return F.struct(a.alias("a"), b.alias("b"))

    end = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, one)
    return end["a"] * radix_b + end["b"]


def walked(value: Column, radix_a, radix_b, key: str, kind: str, valid: Callable[[Column], Column]) -> Column:
    """The first valid value on the permutation's cycle after ``value``, which is valid."""
    a, b = F.lit(radix_a).cast("long"), F.lit(radix_b).cast("long")
    first = feistel(value, a, b, key, kind)
    return F.aggregate(F.sequence(F.lit(1), F.lit(MOST_STEPS)), first,
                       lambda x, _: F.when(valid(x), x).otherwise(feistel(x, a, b, key, kind)))


def _put_back(match: Column, digits: Column) -> Column:
    """``match`` with its digits replaced, in order, and all else kept."""
    def one(c: Column, i: Column) -> Column:
        upto = F.length(F.regexp_replace(F.substring(match, F.lit(1), i + 1), "[^0-9]", ""))
        return F.when(c.rlike("^[0-9]$"), F.substring(digits, upto, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(match, ""), one), "")


def _padded(value: Column, width: int) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def _email(match: Column, key: str) -> Column:
    return F.concat(F.substring(F.sha2(F.concat(F.lit(key + "|email|"), F.lower(match)), 256), 1, 16), F.lit("@mail.invalid"))


def _ip(match: Column, key: str) -> Column:
    value = F.aggregate(F.split(match, r"\."), F.lit(0).cast("long"), lambda a, x: a * 256 + x.cast("long"))
    moved = feistel(value, F.lit(65536).cast("long"), F.lit(65536).cast("long"), key, "ip")
    octets = [F.shiftright(moved, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)]
    return F.concat_ws(".", *octets)


def _date(match: Column, key: str) -> Column:
    day = F.datediff(F.try_to_date(match, "yyyy-MM-dd"), F.lit(FIRST_DAY).cast("date")).cast("long")
    moved = walked(day, 271, 270, key, "date", lambda x: x < DAYS)
    return F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), moved.cast("int")), "yyyy-MM-dd")


def _ssn_valid(x: Column) -> Column:
    area, group, serial = F.floor(x / 1_000_000), F.floor(x / 10_000) % 100, x % 10_000
    return (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)


def _ssn(match: Column, key: str) -> Column:
    value = F.regexp_replace(match, "[^0-9]", "").cast("long")
    return _put_back(match, _padded(walked(value, 100_000, 10_000, key, "ssn", _ssn_valid), 9))


def _phone(match: Column, key: str) -> Column:
    """Ten digits whose area and exchange begin with 2 to 9 are permuted among themselves, and so are all other ten."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    value = F.substring(digits, -10, 10).cast("long")

    def usual(x: Column) -> Column:
        return (F.floor(x / 1_000_000_000) > 1) & (F.floor(x / 1_000_000) % 10 > 1)

    moved = walked(value, 100_000, 100_000, key, "phone", lambda x: usual(x) == usual(value))
    country = F.when(F.length(digits) > 10, F.lit("1")).otherwise(F.lit(""))
    code = F.regexp_extract(digits, COUNTRY, 0)
    abroad = F.concat(code, _any_digits(F.substring(digits, F.length(code) + 1, F.length(digits)), key, "phone"))
    return _put_back(match, F.when(match.rlike("^[+][2-9]"), abroad).otherwise(F.concat(country, _padded(moved, 10))))


def _any_digits(digits: Column, key: str, kind: str) -> Column:
    """``digits`` permuted among all digits of that length."""
    size = F.length(digits)
    low = F.floor(size / 2)
    radix_a, radix_b = F.pow(F.lit(10), size - low).cast("long"), F.pow(F.lit(10), low).cast("long")
    return F.lpad(feistel(digits.cast("long"), radix_a, radix_b, key, kind).cast("string"), size, F.lit("0"))


def _card(match: Column, key: str) -> Column:
    """The digits before the check digit are permuted; the check digit follows from them."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    moved = _any_digits(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")
    total = F.aggregate(F.transform(F.split(F.concat(F.lit("0"), F.reverse(moved)), ""), _luhn_term), F.lit(0), lambda a, x: a + x)
    return _put_back(match, F.concat(moved, ((10 - total % 10) % 10).cast("string")))


def _replaced(match: Column, key: str) -> Column:
    """(kind, value) of a match; kind is null if it fails its check."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    octets = F.forall(F.split(match, r"\."), lambda x: x.cast("int") < 256)

    def whole(kind: str) -> Column:
        return match.rlike("^(?:" + PATTERNS[kind] + ")$")

    checks = [("email", match.contains("@"), _email), ("ip", whole("ip") & octets, _ip),
              ("date", whole("date") & F.try_to_date(match, "yyyy-MM-dd").isNotNull(), _date),
              ("ssn", whole("ssn") & _ssn_valid(F.try_to_number(F.lpad(digits, 9, "0"), F.lit("999999999")).cast("long")), _ssn),
              ("phone", whole("phone"), _phone), ("card", whole("card") & _is_card(digits), _card)]
    kind, value = F.lit(None).cast("string"), match
    for name, passes, change in reversed(checks):
        kind = F.when(passes, F.lit(name)).otherwise(kind)
        value = F.when(passes, change(match, key)).otherwise(value)
    return F.struct(kind.alias("kind"), value.alias("value"))


def pseudonymised(docs: DataFrame, key: str, carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with text replaced, and found: the kinds replaced, in the order of the text."""
    names = [c for c in (carry or docs.columns) if c not in ("text", "found")]
    text = field(docs, "text")
    hit = text.rlike(ANY)
    rows = docs.select(packed(docs.select(*names)), text.alias("text"), F.when(hit, F.split(text, ANY)).alias("gaps"),
                       F.when(hit, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).alias("matches"))
    rows = rows.withColumn("new", F.transform("matches", lambda m: _replaced(m, key)))
    parts = F.flatten(F.zip_with("gaps", "new", lambda g, n: F.array(g, F.coalesce(n["value"], F.lit("")))))
    found = F.transform(F.filter("new", lambda n: n["kind"].isNotNull()), lambda n: n["kind"])
    return rows.select(*unpacked(docs, names), F.when(F.col("new").isNull(), F.col("text")).otherwise(F.array_join(parts, "")).alias("text"),
                       F.coalesce(found, F.array().cast("array<string>")).alias("found"))


def digest(docs: DataFrame) -> DataFrame:
    done = pseudonymised(docs.select("doc_id", "text"), DEMO_KEY)

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda k: k == kind)).cast("long").alias(f"n_{kind}")

    return done.select("doc_id", *[count(k) for k in KINDS], "text")
