import hashlib
import random
import re

import pytest
from conftest import SF
from pyspark.sql import functions as F

from tastebud.llm import fingerprint as fp
from tastebud.llm import queries


def brute_sketch(text, fraction=0.25, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = [w[i:i + n] for i in range(len(w) - n + 1)] if len(w) >= n else ([w] if w else [])
    h = {hashlib.md5(" ".join(r).encode()).hexdigest()[:12] for r in runs}
    return sorted(x for x in h if int(x, 16) < fraction * 2 ** 48)


def near(a, b):
    return (1.0 if not b else 0.0) if not a else len(set(a) & set(b)) / len(a)


def brute(rows):
    """Rows (doc_id, text) in any order -> the operator's rows."""
    named = [(d, t or "") for d, t in rows]
    named.sort(key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5(f"{'-' if r[0] is None else r[0]} {r[1]}".encode()).hexdigest()))
    out = []
    for i, (d, t) in enumerate(named):
        nxt = named[(i + 1) % len(named)][1]
        m = len(t) // 3
        edited = t[: len(t) - m] + nxt[:m]
        a, b, c = brute_sketch(t), brute_sketch(edited), brute_sketch(nxt)
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), "".join(a), "".join(b), near(a, b), near(a, c)))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, key string, ask int").repartition(3)
    return sorted((tuple(r) for r in fp.fingerprint_edits(df).collect()), key=str)


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeéñ日") for _ in range(rnd.randint(1, 4)))
    rows = [(i * 13 % 101, rnd.choice(["", " ", "\n"]) + rnd.choice([" ", "  ", "\t\n"]).join(word() for _ in range(rnd.choice([0, 1, 3, 4, 5, 6, 40, 300])))) for i in range(40)]
    return rows + [(200, None), (201, ""), (202, " \n\t"), (203, "x")]


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, seed):
    rows = corpus(seed)
    assert run(spark, rows) == brute(rows)


def test_repeated_rows_and_ids(spark):
    """Copies of a row follow each other; ids may be null or shared by different texts."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text)] * 4 + [(5, "other " + text), (7, text), (None, text), (None, text), (None, "z " * 30), (-3, "short")]
    assert run(spark, rows) == brute(rows)


def test_one_document_follows_itself(spark):
    rows = [(1, "abc def " * 20)]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in queries.op11_document_fingerprints(spark, SF).collect()), key=str) == brute(rows)


def test_no_python_in_the_plan(spark):
    plan = queries.op11_document_fingerprints(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_fingerprints_merge_and_round_trip(spark):
    a, b = (" ".join(f"w{i}" for i in range(lo, lo + 400)) for lo in (0, 200))
    row = spark.createDataFrame([(a, b)], "x string, y string").select(
        fp.sketch(F.col("x")).alias("a"), fp.sketch(F.col("y")).alias("b"), fp.merged(fp.sketch(F.col("x")), fp.sketch(F.col("y"))).alias("ab"),
        fp.from_string(fp.to_string(fp.sketch(F.col("x")))).alias("back"), fp.from_string(F.lit("")).alias("none"),
        fp.jaccard(fp.sketch(F.col("x")), fp.sketch(F.col("y"))).alias("j"), fp.sketch(F.col("x"), fraction=1.0).alias("all")).first()
    assert row.ab == sorted(set(row.a) | set(row.b)) and row.back == row.a and row.none == []
    assert row.j == len(set(row.a) & set(row.b)) / len(row.ab)
    assert row["all"] == brute_sketch(a, 1.0)


def test_containment_of_unequal_texts(spark):
    """A page inside a book: the estimate holds however unequal the lengths."""
    rnd = random.Random(2)
    book = [f"{rnd.choice('abcd')}{i}" for i in range(20_000)]
    pages = [(i, " ".join(book[s: s + 400] + [f"own{i}x{j}" for j in range(100)])) for i, s in enumerate(range(0, 20_000, 1000))]
    docs = spark.createDataFrame(pages, "doc_id long, text string")
    books = spark.createDataFrame([("book", " ".join(book[:12_000])), ("book", " ".join(book[11_000:])), ("else", "nothing of that here at all")], "name string, text string")
    got = fp.collection_containment(docs, fp.sketch_rows(books, "name", fraction=0.5), fraction=0.5).collect()
    assert {r.key for r in got} == {"book"} and len(got) == len(pages)
    for r in got:
        assert abs(r.containment - 396 / 496) < 0.1 and r.containment == r.n_found / r.n_hashes


def test_collections_merge_by_union(spark):
    docs = spark.createDataFrame([("k", "a b c d e f g"), ("k", "a b c d e"), ("l", "a b c d e"), (None, "q r s t u")], "name string, text string")
    whole = fp.sketch_rows(docs, "name", fraction=1.0)
    parts = fp.sketch_rows(docs.limit(1), "name", fraction=1.0).union(fp.sketch_rows(docs.subtract(docs.limit(1)), "name", fraction=1.0)).distinct()
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))
    assert whole.count() == 4
