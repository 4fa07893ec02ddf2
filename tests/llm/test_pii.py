import datetime
import hashlib
import re

import pytest
from conftest import SF

from tastebud.llm import pii, queries

KEY = "k"


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def feistel(kind, a, b, m, n):
    for r in range(1, pii.ROUNDS + 1):
        other = b if r % 2 else a
        v = int(hashlib.sha256(f"{KEY}|{kind}|{m}|{n}|{r}|{other}".encode()).hexdigest()[:15], 16)
        a, b = ((a + v) % m, b) if r % 2 else (a, (b + v) % n)
    return a, b


def run(spark, texts):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, kind string, m int")
    rows = sorted(pii.pseudonymise(df, KEY).collect(), key=lambda r: r.doc_id)
    assert all((r.kind, r.m) == ("x", 1) for r in rows)
    return rows


CARDS = ["4785380592391139", "4111 1111 1111 1111", "3782-822463-10005", "5555-5555-5555-4444", "4222222222222"]


def test_formats_are_kept_and_values_valid(spark):
    texts = [f"<{x}>" for x in [*CARDS, "+1 (017) 555-7713", "+12125551234", "(212) 555-1234", "212-555-1234", "233.254.104.120", "0.0.0.0",
                                "123-45-6789", "1999-12-31", "29/02/2000", "31.01.2024", "john.doe99@mail.example.com", "É x@y.org é"]]
    for r in run(spark, texts):
        (s,) = r.pii_spans
        assert texts[r.doc_id][s.start:s.end] == s.m and s.to != s.m
        assert r.pseudonymised == texts[r.doc_id][:s.start] + s.to + texts[r.doc_id][s.end:]
        assert re.sub("[0-9]", "9", s.to) == re.sub("[0-9]", "9", s.m) or s.kind in ("ip", "email")
        if s.kind == "card":
            assert luhn(re.sub(r"\D", "", s.to)) and s.to[0] == s.m[0]
        if s.kind == "date":
            y, m, d = s.to.split("-") if s.to[4] == "-" else re.split(r"[/.]", s.to)[::-1]
            assert 1800 <= datetime.date(int(y), int(m), int(d)).year <= 2199
        if s.kind == "ip":
            assert all(0 <= int(x) <= 255 for x in s.to.split("."))
        if s.kind == "email":
            assert [len(x) for x in s.to.split("@")] == [len(x) for x in s.m.split("@")] and s.to.split("@")[1] == s.m.split("@")[1]
        if s.kind == "ssn":
            assert not re.match("000|666|9", s.to)


def test_invalid_values_stay(spark):
    texts = ["2123465659789240", "256.1.1.1", "1.2.3.4.5", "000-12-3456", "666-12-3456", "900-12-3456", "123-00-4567", "123-45-0000", "31/02/2000", "2023-02-29", "1799-01-01", "0000000000000000",
             "a@b", "version 4.0", "123456789012", "x4111111111111111", "41111111111111112222333", "01.02.03.04", "13/13/2001", None, "", "no data"]
    for r in run(spark, texts):
        assert r.pseudonymised == texts[r.doc_id] and not r.pii_spans, texts[r.doc_id]


def test_equal_values_stay_linked(spark):
    a, b, c, d = run(spark, ["card 4111111111111111, 10.1.2.3", "4111 1111 1111 1111 10.1.2.3 " * 3, "10.1.2.4", "1999-12-31 31/12/1999 31.12.1999"])
    assert a.pii_spans[0].to == b.pii_spans[0].to.replace(" ", "") and a.pii_spans[1].to == b.pii_spans[1].to == b.pii_spans[5].to
    assert c.pii_spans[0].to != a.pii_spans[1].to
    y, m, day = d.pii_spans[0].to.split("-")
    assert d.pii_spans[1].to == f"{day}/{m}/{y}" and d.pii_spans[2].to == f"{day}.{m}.{y}"


def test_month_first_dates_and_timestamps(spark):
    def read(x):
        if x[4] == "-":
            return datetime.date.fromisoformat(x)
        a, b, y = map(int, re.split(r"[/.]", x))
        return datetime.date(y, a, b) if b > 12 else datetime.date(y, b, a)

    days = [datetime.date(1985 + i % 30, 1 + i % 12, 13 + i % 16) for i in range(200)]
    rows = run(spark, [f"{d:%m/%d/%Y} {d:%m.%d.%Y} {d:%d/%m/%Y} {d} {d}T10:15:00Z, {d}t23:59" for d in days])
    seen = set()
    for d, r in zip(days, rows):
        assert [(s.kind, read(s.m)) for s in r.pii_spans] == [("date", d)] * 6
        (new,) = {read(s.to) for s in r.pii_spans}
        assert new != d and r.pseudonymised.endswith(f" {new}T10:15:00Z, {new}t23:59") and str(d) not in r.pseudonymised
        assert r.pii_spans[0].to == r.pii_spans[1].to.replace(".", "/")
        seen.add(new)
    assert len(seen) == len(set(days))
    texts = ["13/13/2001", "02/30/2000", "00/25/2000", "2023-02-29T10:00", "2021-03-04Tuesday", "2021-03-045"]
    assert [r.pseudonymised for r in run(spark, texts)] == texts


def test_network_against_brute_force(spark):
    texts = ["10.20.30.40", "1999-12-31", "123-45-6789", "+1 (212) 555-1234"]
    ip, date, ssn, phone = [r.pii_spans[0].to for r in run(spark, texts)]
    x, y = feistel("ip", 10 * 256 + 20, 30 * 256 + 40, 65536, 65536)
    assert ip == f"{x // 256}.{x % 256}.{y // 256}.{y % 256}"
    day = (datetime.date(1999, 12, 31) - datetime.date(1800, 1, 1)).days
    x, y = feistel("date", day // 5411, day % 5411, 27, 5411)
    assert date == str(datetime.date(1800, 1, 1) + datetime.timedelta(days=x * 5411 + y))
    x, y = feistel("ssn", 122, 44 * 9999 + 6788, 898, 99 * 9999)
    assert ssn == f"{x + 1 if x < 665 else x + 2:03}-{y // 9999 + 1:02}-{y % 9999 + 1:04}"
    x, y = feistel("phone+1", 212, 5551234, 1000, 10_000_000)
    line = f"{y:07}"
    assert phone == f"+1 ({x:03}) {line[:3]}-{line[3:]}"


def test_small_domain_is_a_permutation(spark):
    from pyspark.sql import functions as F
    ids = spark.range(35).select(F.floor(F.col("id") / 7).alias("a"), (F.col("id") % 7).alias("b"))
    out = ids.select(pii.feistel("key", F.lit("t"), F.col("a"), F.col("b"), F.lit(5), F.lit(7)).alias("p")).collect()
    assert {(r.p.a, r.p.b) for r in out} == {(a, b) for a in range(5) for b in range(7)}


def test_emails_are_a_permutation(spark):
    names = [f"{a}{b}@x.org" for a in "abcdefghijklmnopqrstuvwxyz" for b in "0123456789"]
    got = [r.pii_spans[0].to for r in run(spark, names)]
    assert sorted(got) == sorted(names) and got != names


@pytest.mark.parametrize("text", ["a" * 200_000, "1" * 200_000, "1." * 100_000, "a@" + "b." * 100_000, "4111 " * 50_000, "2000-" * 50_000])
def test_long_runs_are_no_trouble(spark, text):
    (r,) = run(spark, [text])
    assert r.pseudonymised is not None


def test_clashing_columns_are_set_aside(spark):
    df = spark.createDataFrame([("mine", "10.1.2.3", 5)], "pii_spans string, text string, pseudonymised int")
    row = pii.pseudonymise(df, KEY).first()
    assert row.pii_spans_in == "mine" and row.pseudonymised_in == 5 and [s.m for s in row.pii_spans] == ["10.1.2.3"] and row.pseudonymised != "10.1.2.3"


def test_no_python_in_the_plan(spark):
    plan = queries.op8_pii_pseudonyms(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_empty_table(spark):
    assert pii.pseudonymise(spark.createDataFrame([], "doc_id long, text string"), KEY).count() == 0


def test_query_hides_planted_values(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    seen = 0
    for r in queries.op8_pii_pseudonyms(spark, SF).collect():
        t = docs[r.doc_id]
        found = re.findall(r"\+1 \(\d{3}\) \d{3}-\d{4}|[\w.]+@mail\d\.example\.com|(?<!\d)\d{16}(?!\d)|(?<![\d.])\d+\.\d+\.\d+\.\d+(?![\d.])", t)
        found = [x for x in found if not re.fullmatch(r"\d{16}", x) or luhn(x)]
        assert not [x for x in found if x in r.text], (r.doc_id, found)
        assert len(r.text) >= len(t) - 20 * len(found)
        if not found:
            assert r.text == t and r.spans == ""
        seen += len(found)
    assert seen
