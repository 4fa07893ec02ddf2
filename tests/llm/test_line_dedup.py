import hashlib

import pytest
from conftest import SF
from pyspark.sql import functions as F

from tastebud.llm import line_dedup, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def brute(rows, min_chars=10):
    owners = {}
    for d, t in rows:
        if d is None:
            continue
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                owners.setdefault(key(line), set()).add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        gone = [d is not None and len(owners.get(key(x), ())) > 1 and min(owners[key(x)]) != d for x in lines]
        kept = "\n".join(x for x, g in zip(lines, gone) if not g)
        out.append((d, len(lines), sum(gone), kept))
    return sorted(out, key=str)


ROWS = [(5, "shared line here\nunique to five\nshared line here"), (2, "  SHARED line here\t\nx"), (9, "shared LINE here"), (9, "shared LINE here"),
        (3, None), (4, ""), (6, "\n\n"), (7, "short\nshort"), (8, "short"), (10, "éééééééééé\n" * 3), (11, "ÉÉÉÉÉÉÉÉÉÉ\néééééééééé "), (12, "\x0bnine char\x0c"),
        (13, "nine char"), (None, "shared line here"), (14, "a" * 200_000 + "\n" + "b" * 11), (15, "b" * 11 + "\r"), (16, "twice in one\ntwice in one"),
        (17, "\x1cshared line here"), (18, "no-break space "), (19, "no-break space")]


def test_against_brute_force(spark):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in ROWS], "doc_id long, text string, lines string, key int")
    got = line_dedup.dedup_lines(df).collect()
    assert sorted(((r.c0, r.n_lines, r.n_dropped, r.kept) for r in got), key=str) == brute(ROWS)
    stage = line_dedup.line_dedup_stage(df)
    assert stage.columns == df.columns and stage.count() == len(ROWS)


@pytest.mark.parametrize("bits", [1 << 16, 1 << 20])
def test_saturated_filter_loses_nothing(spark, monkeypatch, bits):
    monkeypatch.setattr(line_dedup, "filter_bits", lambda n: bits)
    rows = [(i, "\n".join(f"line number {(i * 7 + j * 13) % 5000} of text" for j in range(20))) for i in range(3000)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    assert sorted(((r.c0, r.n_lines, r.n_dropped, r.kept) for r in got), key=str) == brute(rows)


def test_hot_line_in_a_third_of_documents(spark):
    rows = [(i, ("the very same boiler plate\n" if i % 3 == 0 else "") + f"own line of {i}") for i in range(3000)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(9))
    assert got.agg(F.sum("n_dropped")).first()[0] == 999


def test_empty_table(spark):
    assert line_dedup.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = [(d, n, g, hashlib.sha256(k.encode()).hexdigest()) for d, n, g, k in brute(rows)]
    got = queries.op5_line_dedup(spark, SF).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in got), key=str) == sorted(want, key=str)
