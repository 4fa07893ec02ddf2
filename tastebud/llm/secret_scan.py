"""Secret scans by patterns and by sliding-window entropy, in DataFrame expressions only.

Patterns find assignments (``token = ...``), access keys and long hex strings.  The entropy
method looks at candidate strings, runs of at least ``WINDOW`` characters of
``[A-Za-z0-9+/_=-]``.  A window slides over a candidate; the count of each of the 64 characters,
the sum of ``c * log2(c)`` (in integer millionths, so every order of updates gives the same
value) and the number of characters of each class are updated by the character that enters and
the one that leaves.  A window is suspicious if its Shannon entropy reaches the threshold of its
class: hex (only hex digits, one of them 0-9), letters (only letters, in both cases) or mixed (at
least two of lower, upper and digit).  The span covers the candidate from its first suspicious
window to the end of its last one.

The allow list works in two ways.  Allowed strings (placeholder words, alphabets, the caller's
``allowed``) are cut out of a candidate, so no window that touches one is suspicious, and what is
left on either side is a candidate of its own: a key after ``/sample/`` is still found.
Candidates that are as a whole of an allowed form (numbers, lower-case words, UUIDs with dashes)
are suppressed.

Defined cases: null or empty text has no spans; repeated rows are scanned one by one; an empty
table gives an empty result; positions are code points, ends exclusive; further columns pass
through, one named like the result with ``_in`` appended to its name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import spans as sp


def _any_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


KEYWORDS = "|".join(["password", "passwd", "secret", "token", "api_?key"])
ASSIGN = "(" + "|".join(_any_case(k) for k in KEYWORDS.split("|")) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{16,}"  # the maximal runs of 16 and more
MIN_ASSIGN, MIN_ACCESS = 12, 18

WINDOW = 20
#: names in camel case reach 4.0 bits in a window, seldom 4.1 (pangrams do); random letters of both cases pass it in most keys of 32
HEX_BITS, MIXED_BITS, LETTER_BITS = 3.0, 3.8, 4.1
SCALE = 1_000_000
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}+"
# allowed strings in either case, cut out of candidates in this order
ALLOW_WORDS = ("example", "placeholder", "dummy", "changeme", "sample", "your_", "your-", "xxxx", "0123456789", "abcdefghij")
# allowed forms of a whole candidate
ALLOW = (r"^[0-9+/_=-]+$", r"^[a-z_/=-]+$", r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$")
KINDS = ("assign", "access", "hex", "entropy")


def _most(bits: float) -> int:
    """The largest scaled sum of c*log2(c) of a window whose entropy is at least ``bits``."""
    return math.floor(SCALE * WINDOW * (math.log2(WINDOW) - bits))


_CLOG = [0] + [round(SCALE * c * math.log2(c)) for c in range(1, WINDOW + 2)]


def _literals(values) -> Column:
    return F.array(*[F.lit(int(v)) for v in values])


def suspicious_range(candidate: Column) -> Column:
    """struct(first, last): offsets of the first and last suspicious window of a candidate; -1 if there is none."""
    n = len(ALPHABET)
    codes = F.transform(F.split(candidate, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    steps = F.filter(F.arrays_zip(codes.alias("enters"), F.slice(F.concat(F.array_repeat(F.lit(0), WINDOW), codes), F.lit(1), F.length(candidate)).alias("leaves")), lambda x: x["enters"].isNotNull())
    clog = _literals(_CLOG)
    # character classes by code (1-based; 0 is no character)
    hexes = _literals([0] + [c in "0123456789abcdef" or c in "ABCDEF" for c in ALPHABET])
    digits, lowers, uppers = (_literals([0] + [f(c) for c in ALPHABET]) for f in (str.isdigit, str.islower, str.isupper))
    at = lambda a, i: F.element_at(a, i + 1)

    def step(s, x):
        a, b = x["enters"], x["leaves"]
        count = s["count"]
        old = F.element_at(count, F.greatest(b, F.lit(1)))
        # the leaving character first, so that the entering one sees the counts without it
        minus = F.when(b > 0, at(clog, old) - at(clog, old - 1)).otherwise(0)
        base = F.element_at(count, a) - F.when(a == b, 1).otherwise(0)
        total = s["sum"] - minus + at(clog, base + 1) - at(clog, base)
        moved = F.transform(count, lambda v, i: v + F.when(i + 1 == a, 1).otherwise(0) - F.when(i + 1 == b, 1).otherwise(0))
        tally = {k: s[k] + at(t, a) - at(t, b) for k, t in (("hex", hexes), ("digit", digits), ("lower", lowers), ("upper", uppers))}
        return F.struct(moved.alias("count"), total.alias("sum"), *[v.alias(k) for k, v in tally.items()], (s["i"] + 1).alias("i"), s["first"].alias("first"), s["last"].alias("last"))

    def note(s):
        some = lambda k: F.when(s[k] > 0, 1).otherwise(0)
        is_hex = (s["hex"] == WINDOW) & (s["digit"] > 0) & ((s["lower"] == 0) | (s["upper"] == 0))
        mixed = some("digit") + some("lower") + some("upper") >= 2
        most = F.when(is_hex, _most(HEX_BITS)).when(s["lower"] + s["upper"] == WINDOW, _most(LETTER_BITS)).otherwise(_most(MIXED_BITS))
        hot = (s["i"] >= WINDOW) & (is_hex | mixed) & (s["sum"] <= most)
        begin = s["i"] - WINDOW
        return s.withField("first", F.when(hot & (s["first"] < 0), begin).otherwise(s["first"])).withField("last", F.when(hot, begin).otherwise(s["last"]))

    zero = F.lit(0)
    start = F.struct(F.array_repeat(zero, n).alias("count"), zero.alias("sum"), *[zero.alias(k) for k in ("hex", "digit", "lower", "upper")], zero.alias("i"), F.lit(-1).alias("first"), F.lit(-1).alias("last"))
    # element_at over a one-element array lets the new state be named once
    run = F.aggregate(steps, start, lambda s, x: F.element_at(F.transform(F.array(step(s, x)), note), 1), lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))
    return run


def _tagged(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), x["end"].alias("end"), F.lit(kind).alias("kind")))


def secret_spans(text: Column, allowed: tuple[str, ...] = ()) -> dict[str, Column]:
    """Arrays of struct(start, rank, end, kind) by kind."""
    assign = F.filter(sp.matches(text, ASSIGN), lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= MIN_ASSIGN)
    access = F.filter(sp.matches(text, ACCESS), lambda x: F.length(x["m"]) >= MIN_ACCESS)

    def cut(x):
        m = x["m"]
        for w in ALLOW_WORDS:
            m = F.regexp_replace(m, _any_case(w), " " * len(w))
        for a in allowed:
            m = F.replace(m, F.lit(a), F.lit(" " * len(a)))
        return F.struct(x["start"].alias("start"), m.alias("m"))

    def is_candidate(x):
        ok = F.lit(True)
        for p in ALLOW:
            ok = ok & ~x["m"].rlike(p)
        return ok

    parts = F.transform(F.transform(sp.matches(text, CANDIDATE), cut),
                        lambda x: F.transform(sp.matches(x["m"], CANDIDATE), lambda y: F.struct((x["start"] + y["start"]).alias("start"), y["m"].alias("m"))))
    candidates = F.filter(F.flatten(parts), is_candidate)
    ranged = F.transform(candidates, lambda x: F.struct(x["start"].alias("start"), suspicious_range(x["m"]).alias("r")))
    entropy = F.transform(F.filter(ranged, lambda x: x["r"]["first"] >= 0),
                          lambda x: F.struct((x["start"] + x["r"]["first"]).alias("start"), (x["start"] + x["r"]["last"] + WINDOW).alias("end")))
    return {"assign": _tagged(assign, "assign"), "access": _tagged(access, "access"),
            "hex": _tagged(sp.matches(text, HEX), "hex"), "entropy": _tagged(entropy, "entropy")}


def scan_secrets(docs: DataFrame, text_col: str = "text", allowed: tuple[str, ...] = (), into: str = "secret_spans") -> DataFrame:
    """``docs`` plus a struct column ``into`` with one array of (start, rank, end, kind) per kind."""
    docs, moved = sp.set_aside(docs, into)
    text = F.coalesce(F.col(f"`{moved.get(text_col, text_col)}`"), F.lit(""))
    return docs.withColumn(into, F.struct(*[c.alias(k) for k, c in secret_spans(text, allowed).items()]))
