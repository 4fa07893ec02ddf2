import random
import re

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from tastebud.llm import near_dup, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(t, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, threshold=0.8):
    """doc -> (class, links) over rows; pairs of rows, by an inverted index."""
    sets = [shingles(t) if d is not None else set() for d, t in rows]
    by = {}
    for i, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(i)
    shared = {}
    for ids in by.values():
        for a in range(len(ids)):
            for b in range(a):
                shared[ids[b], ids[a]] = shared.get((ids[b], ids[a]), 0) + 1
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    for (a, b), n in shared.items():
        if n >= threshold * (len(sets[a]) + len(sets[b]) - n) - 1e-9:
            links[a] += 1
            links[b] += 1
            parent[root(a)] = root(b)
    label = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            label[root(i)] = min(label.get(root(i), d), d)
    return sorted(((d, label[root(i)] if d is not None else None, links[i]) for i, (d, _) in enumerate(rows)), key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, class_id string, v int").repartition(3)
    return sorted(((r.doc_id, r.class_id, r.n_links) for r in near_dup.near_duplicates(df, **options).collect()), key=str)


def corpus(seed, groups=25):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 6)))
    rows = []
    for _ in range(groups):
        w = [word() for _ in range(rnd.choice([1, 3, 4, 6, 30, 80, 200]))]
        for _ in range(rnd.choice([1, 1, 2, 3, 9])):
            x = list(w)
            for _ in range(rnd.randint(0, max(1, len(w) // 40))):
                x[rnd.randrange(len(x))] = word()
            rows.append((len(rows) * 7 % 1009, rnd.choice([" ", "\n"]).join(x)))
            if rnd.random() < 0.2:
                rows.append((len(rows) * 7 % 1009, rows[-1][1].upper()))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rows = corpus(seed)
    assert run(spark, rows) == brute(rows)


def test_large_bucket_in_chunks(spark):
    rnd = random.Random(4)
    base = [f"word{i}" for i in range(60)]
    rows = []
    for i in range(300):
        x = list(base)
        x[rnd.randrange(60)] = f"edit{i}"
        rows.append((i, " ".join(x)))
    assert run(spark, rows, chunk=32) == brute(rows)


def test_recall_at_the_threshold(spark):
    """Pairs of similarity just above 0.8: the hardest to find."""
    rnd = random.Random(8)
    rows = []
    for i in range(400):
        w = [f"t{i}x{j}" for j in range(47)]
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join([*w[:-4], *(f"u{i}y{j}" for j in range(4))]))]
    rnd.shuffle(rows)
    want = brute(rows)
    found = run(spark, rows)
    assert sum(n for *_, n in want) == 800
    assert sum(n for *_, n in found) >= 0.995 * 800


def test_large_group_hides_no_missed_pairs(spark):
    """Isolated pairs of similarity exactly 0.8 beside a group whose links outnumber theirs by far."""
    rows = [(10_000 + i, " ".join([*(f"b{j}" for j in range(40)), f"e{i}"])) for i in range(500)]
    for i in range(400):
        w = [f"t{i}x{j}" for j in range(49)]
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join([*w[:-5], *(f"u{i}y{j}" for j in range(5))]))]
    found = {d: (c, n) for d, c, n in run(spark, rows)}
    assert all(found[10_000 + i] == (10_000, 499) for i in range(500))
    assert [i for i in range(400) if found[2 * i] != (2 * i, 1) or found[2 * i + 1] != (2 * i, 1)] == []


def test_defined_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a"), (5, "A"), (6, "a b c d"), (7, "a b c d"), (8, "a b c d e"), (None, "a b c d e"), (None, "a b c d e"), (9, "a b c d e f"), (10, "x " * 50_000), (11, "x " * 50_000), (12, "x " * 4)]
    got, want = run(spark, rows), brute(rows)
    # the same single shingle from different words: not copies, but linked
    assert got == want


def test_repeated_ids(spark):
    t = " ".join(f"w{i}" for i in range(40))
    assert run(spark, [(1, t), (1, t), (2, t + " z")]) == [(1, 1, 2), (1, 1, 2), (2, 1, 2)]
    got = run(spark, [(1, t), (1, "other text of the same id"), (2, t + " z"), (3, "other text of the same id")])
    assert sorted(n for *_, n in got) == [1, 1, 1, 1]


def test_hot_copies(spark):
    rows = [(i, "the same text in a third of all the documents" if i % 3 == 0 else f"own text number {i} with other words {i * 7} {i * 11}") for i in range(1200)]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.where("class_id = 0 AND n_links = 399 AND n_copies = 400").count() == 400


def test_stage_keeps_one_of_each_group(spark):
    rows = corpus(3)
    df = spark.createDataFrame([(d, t, "l") for d, t in rows], "doc_id long, text string, duplicate_doc string")
    left = near_dup.near_duplicate_stage(df)
    assert left.columns == df.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted({c for _, c, _ in brute(rows)})


def test_empty_table(spark):
    assert run(spark, []) == []


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101), (-5, 101)], "a long, b long")
    got = {r.v: r.label for r in near_dup.components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: -5, 101: -5, -5: -5}


def test_estimated_recall():
    assert near_dup.estimated_recall({}, 4, 20) == 0
    assert near_dup.estimated_recall({80: 100}, 4, 20) > 0.9999 > near_dup.estimated_recall({80: 100}, 6, 20)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op10_ngram_jaccard_join(spark, SF)
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got.collect()), key=str) == brute(rows)


def test_structured_runs_are_different_documents(spark):
    from tests_runs import complements
    texts = [t for size in (1024, 2048, 4096) for t in complements(size)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {tuple(r) for r in near_dup.near_duplicates(rows).collect()}
    assert got == {(i, i, 0, 1) for i in range(len(texts))}
    assert near_dup.near_duplicate_stage(rows).count() == len(texts)
