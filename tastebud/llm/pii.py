"""Personal data replaced by format-preserving Feistel pseudonyms, in DataFrame expressions only.

Values are found by pattern and validated: payment cards by length and Luhn sum, IPv4 addresses
by their octets, social security numbers by their excluded areas, dates by the calendar, phone
numbers by the plan of their format.  Each valid value is mapped to an integer domain of its
format, permuted by a keyed alternating Feistel network (modular addition, SHA-256 rounds) and
written back in the same format: separators, country code and the card's first digit stay, Luhn
digits are recomputed, dates stay calendar dates (day first where both orders can be, of ISO
timestamps the date is replaced and the time stays).  The permutation depends on key and kind only,
so equal values have equal pseudonyms in all documents, however they are punctuated, and
different values different ones; a phone number with its country code and the same number without
it are two values, as are e-mail addresses in different letter case.  E-mail names are permuted letter by letter and digit by digit
in two halves; their domain stays.

Defined cases: null text stays null and has no spans; empty text stays empty; invalid values
(failed Luhn sum, octet above 255, 31 February, area 000) are left alone; repeated rows are
treated one by one; an empty table gives an empty result; further columns pass through, those
named like a result column with ``_in`` appended to their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import spans as sp

ROUNDS = 10
KINDS = ("email", "date", "ssn", "phone", "ip", "card")

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,7}\.[A-Za-z]{2,24}(?![A-Za-z0-9-])"
_LEFT, _RIGHT = r"(?<![0-9A-Za-z.+-])", r"(?![0-9A-Za-z])(?![.-][0-9])"
ISO_DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
DATE = "(?:" + ISO_DATE + r"|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
PHONE = r"(?:\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}|\([2-9][0-9]{2}\) ?[2-9][0-9]{2}[ .-][0-9]{4}|[2-9][0-9]{2}([.-])[2-9][0-9]{2}\1[0-9]{4})"
IP = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"
CARD = r"(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\2[0-9]{4}\2[0-9]{1,7}|[0-9]{4}([ -])[0-9]{6}\3[0-9]{4,5})"
#: an ISO date may be followed by its time
NUMBERS = _LEFT.replace("+", "") + "(?:" + ISO_DATE + "(?=[Tt][0-9])|(?:" + "|".join([DATE, SSN, PHONE, IP, CARD]) + ")" + _RIGHT + ")"
ANY = "(?:" + EMAIL + ")|(?:" + NUMBERS + ")"
_FIRST_DAY = "1800-01-01"
#: 400 Gregorian years are 146,097 = 27 * 5,411 days
DAY_PARTS = (27, 5411)


def feistel(key: str, kind: Column, a: Column, b: Column, m: Column, n: Column) -> Column:
    """struct(a, b): a keyed permutation of {0..m-1} x {0..n-1}."""
    def step(s, r):
        odd = r % 2 == 1
        other = F.when(odd, s["b"]).otherwise(s["a"])
        digest = F.sha2(F.concat_ws("|", F.lit(key), kind, s["m"].cast("string"), s["n"].cast("string"), r.cast("string"), other.cast("string")), 256)
        value = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
        return F.struct(F.when(odd, F.pmod(s["a"] + value, s["m"])).otherwise(s["a"]).alias("a"),
                        F.when(odd, s["b"]).otherwise(F.pmod(s["b"] + value, s["n"])).alias("b"), s["m"].alias("m"), s["n"].alias("n"))

    start = F.struct(*[c.cast("long").alias(x) for c, x in ((a, "a"), (b, "b"), (m, "m"), (n, "n"))])
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: F.struct(s["a"].alias("a"), s["b"].alias("b")))


def _let(value: Column, f) -> Column:
    """``f(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _pad(x: Column, width) -> Column:
    return F.lpad(x.cast("string"), width, "0")


def _luhn_rest(body: Column) -> Column:
    """Luhn sum modulo 10 of the digits before the check digit."""
    reversed_ = F.transform(F.split(F.reverse(body), ""), lambda d: d.cast("int"))
    doubled = F.transform(reversed_, lambda d, i: F.when(i % 2 == 0, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d))
    return F.aggregate(F.filter(doubled, lambda d: d.isNotNull()), F.lit(0), lambda s, d: s + d) % 10


def _like(m: Column, digits: Column) -> Column:
    """``m`` with its digits replaced in order by ``digits``."""
    return F.aggregate(F.filter(F.split(m, ""), lambda c: c != ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("i")),
                       lambda s, c: F.when(c.rlike("[0-9]"), F.struct(F.concat(s["out"], F.substr(digits, s["i"], F.lit(1))).alias("out"), (s["i"] + 1).alias("i")))
                       .otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["i"].alias("i"))), lambda s: s["out"])


def _card(key, m):
    def body(d):
        middle = F.substr(d, F.lit(2), F.length(d) - 2)
        half = F.floor(F.length(middle) / 2).cast("int")
        rest = F.length(middle) - half
        p = feistel(key, F.lit("card"), F.substr(middle, F.lit(1), half).cast("long"), F.substr(middle, half + 1, rest).cast("long"),
                    F.pow(F.lit(10.0), half).cast("long"), F.pow(F.lit(10.0), rest).cast("long"))
        head = _let(p, lambda x: F.concat(F.substr(d, F.lit(1), F.lit(1)), _pad(x["a"], half), _pad(x["b"], rest)))
        return _let(head, lambda h: F.concat(h, F.pmod(10 - _luhn_rest(h), F.lit(10)).cast("string")))
    return _let(_digits(m), lambda d: _like(m, body(d)))


def _luhn_valid(m):
    return _let(_digits(m), lambda d: F.length(d).between(13, 19) & (F.pmod(_luhn_rest(F.substr(d, F.lit(1), F.length(d) - 1)) + F.right(d, F.lit(1)).cast("int"), F.lit(10)) == 0)
                & ~d.rlike(r"^(.)\1+$"))


def _phone(key, m):
    plus = m.startswith("+1")
    d = F.when(plus, F.substring(_digits(m), 2, 10)).otherwise(_digits(m))
    # with a country code any ten digits; without it area and exchange start with 2-9
    area, line = F.substring(d, 1, 3).cast("long"), F.substring(d, 4, 7).cast("long")
    a, b = F.when(plus, area).otherwise(area - 200), F.when(plus, line).otherwise(line - 2_000_000)
    p = feistel(key, F.when(plus, F.lit("phone+1")).otherwise(F.lit("phone")), a, b, F.when(plus, 1000).otherwise(800), F.when(plus, 10_000_000).otherwise(8_000_000))
    return _let(p, lambda x: _like(m, F.concat(F.when(plus, F.lit("1")).otherwise(F.lit("")), _pad(F.when(plus, x["a"]).otherwise(x["a"] + 200), 3),
                                              _pad(F.when(plus, x["b"]).otherwise(x["b"] + 2_000_000), 7))))


def _ssn(key, m):
    # areas 001-665 and 667-899, groups 01-99, serials 0001-9999
    area, group, serial = (F.substring(m, a, n).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    p = feistel(key, F.lit("ssn"), F.when(area < 666, area - 1).otherwise(area - 2), (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999))
    return _let(p, lambda x: F.concat_ws("-", _pad(F.when(x["a"] < 665, x["a"] + 1).otherwise(x["a"] + 2), 3),
                                        _pad(F.floor(x["b"] / 9999) + 1, 2), _pad(x["b"] % 9999 + 1, 4)))


def _ssn_valid(m):
    return ~m.rlike("^(?:000|666|9)") & ~m.rlike("-00-") & ~m.rlike("-0000$")


def _ip(key, m):
    o = F.transform(F.split(m, r"\."), lambda x: x.cast("long"))
    p = _let(o, lambda x: feistel(key, F.lit("ip"), x[0] * 256 + x[1], x[2] * 256 + x[3], F.lit(65536), F.lit(65536)))
    return _let(p, lambda x: F.concat_ws(".", *[c.cast("string") for c in (F.floor(x["a"] / 256), x["a"] % 256, F.floor(x["b"] / 256), x["b"] % 256)]))


def _ip_valid(m):
    return F.forall(F.split(m, r"\."), lambda x: (x.cast("int") <= 255) & ~x.rlike("^0[0-9]"))


def _month_first(m):
    """Whether a value that isn't an ISO date can only have the month first: the second number is no month."""
    return F.substring(m, 4, 2) > "12"


def _day(m):
    """The date of a value, day before month where both can be; null if there is none."""
    year, one, two = F.substring(m, 7, 4), F.substring(m, 1, 2), F.substring(m, 4, 2)
    other = F.when(_month_first(m), F.concat_ws("-", year, one, two)).otherwise(F.concat_ws("-", year, two, one))
    return F.try_to_date(F.when(m.rlike("^[0-9]{4}-"), m).otherwise(other), "yyyy-MM-dd")


def _date_valid(m):
    # lenient parsing would move 31 February to March: the text must come back
    return _let(_day(m), lambda d: d.isNotNull() & (_write_date(m, d) == m) & d.between(F.lit(_FIRST_DAY).cast("date"), F.lit("2199-12-31").cast("date")))


def _write_date(m, d):
    iso = F.date_format(d, "yyyy-MM-dd")
    sep, year, month, day = F.substring(m, 3, 1), F.substring(iso, 1, 4), F.substring(iso, 6, 2), F.substring(iso, 9, 2)
    # the month first only where ``_day`` reads it so: what is written reads as ``d``, and different dates differ
    return (F.when(m.rlike("^[0-9]{4}-"), iso).when(_month_first(m) & (day > "12"), F.concat(month, sep, day, sep, year))
            .otherwise(F.concat(day, sep, month, sep, year)))


def _date(key, m):
    a, b = DAY_PARTS
    number = F.datediff(_day(m), F.lit(_FIRST_DAY).cast("date"))
    p = _let(number, lambda x: feistel(key, F.lit("date"), F.floor(x / b), x % b, F.lit(a), F.lit(b)))
    return _let(p, lambda x: _write_date(m, F.date_add(F.lit(_FIRST_DAY).cast("date"), (x["a"] * b + x["b"]).cast("int"))))


def _shifted(key, mine: Column, other: Column, r: Column) -> Column:
    """Each letter or digit of ``mine`` moved within its class by a keyed hash of ``other``, round and position."""
    def move(c, i):
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), r.cast("string"), i.cast("string"), other), 256)
        by = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
        turn = lambda first, n: F.char(F.lit(first) + (F.ascii(c) - first + by) % n)
        return F.when(c.rlike("[a-z]"), turn(97, 26)).when(c.rlike("[A-Z]"), turn(65, 26)).when(c.rlike("[0-9]"), turn(48, 10)).otherwise(c)
    return F.array_join(F.transform(F.split(mine, ""), move), "")


def _email(key, m):
    name, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    half = F.floor(F.length(name) / 2).cast("int")
    start = F.struct(F.substr(name, F.lit(1), half).alias("a"), F.substr(name, half + 1, F.length(name)).alias("b"))

    def step(s, r):
        odd = r % 2 == 1
        return F.struct(F.when(odd, _shifted(key, s["a"], s["b"], r)).otherwise(s["a"]).alias("a"),
                        F.when(odd, s["b"]).otherwise(_shifted(key, s["b"], s["a"], r)).alias("b"))
    return F.concat(F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: F.concat(s["a"], s["b"])), F.lit("@"), domain)


def _kind(m: Column) -> Column:
    """The kind of a match, null if it fails its validation."""
    whole = lambda p: m.rlike("^(?:" + p + ")$")
    unnumbered = CARD.replace("([ -])", "[ -]").replace("\\2", "[ -]").replace("\\3", "[ -]")
    return (F.when(F.contains(m, F.lit("@")), F.lit("email"))
            .when(whole(DATE), F.when(_date_valid(m), F.lit("date"))).when(whole(SSN), F.when(_ssn_valid(m), F.lit("ssn")))
            .when(whole(IP), F.when(_ip_valid(m), F.lit("ip"))).when(whole(PHONE), F.lit("phone"))
            .when(whole(unnumbered), F.when(_luhn_valid(m), F.lit("card"))))


def _pseudonym(key: str, kind: Column, m: Column) -> Column:
    makers = {"email": _email, "date": _date, "ssn": _ssn, "phone": _phone, "ip": _ip, "card": _card}
    out = F.when(F.lit(False), m)
    for k, f in makers.items():
        out = out.when(kind == k, f(key, m))
    return out.otherwise(m)


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", into: str = "pseudonymised", spans_into: str = "pii_spans") -> DataFrame:
    """``docs`` plus the text with pseudonyms and the spans (start, end, kind, m, to) found in the input text."""
    docs, moved = sp.set_aside(docs, into, spans_into)
    text = F.col(f"`{moved.get(text_col, text_col)}`")
    found = F.transform(sp.matches(F.coalesce(text, F.lit("")), ANY), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), _kind(x["m"]).alias("kind"), x["m"].alias("m")))
    named = F.transform(found, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"), x["m"].alias("m"), _pseudonym(key, x["kind"], x["m"]).alias("to")))
    out = docs.withColumn(spans_into, named)
    # the pieces between the matches, each followed by what the match became (invalid ones stay)
    pairs = F.zip_with(F.split(text, ANY, -1), F.transform(spans_into, lambda x: x["to"]), lambda s, t: F.array(s, F.coalesce(t, F.lit(""))))
    out = out.withColumn(into, F.when(F.size(spans_into) == 0, text).otherwise(F.array_join(F.flatten(pairs), "")))
    return out.withColumn(spans_into, F.filter(spans_into, lambda x: x["kind"].isNotNull()))
