import random
import re

import pytest
from conftest import SF

from tastebud.llm import decontaminate, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))


def shingles(w, n):
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()


def brute(docs, items, n=5, threshold=0.8):
    out = set()
    for d, t in docs:
        w = words(t)
        for i, x in items:
            if d is None or i is None:
                continue
            y = words(x)
            k = min(n, len(y))
            a = shingles(y, k)
            both = a & shingles(w, k)
            if a and len(both) >= threshold * len(a) - 1e-9:
                out.add((d, i, len(a), len(both)))
    return out


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(*r, "k", 1) for r in docs], "doc_id long, text string, key string, size int").repartition(3)
    b = spark.createDataFrame([(*r, "k") for r in items], "item_id long, text string, shingle string")
    got = decontaminate.contaminated(d, b, **options).collect()
    assert len({(r.doc_id, r.item_id) for r in got}) == len(got)
    return {tuple(r) for r in got}


def corpus(seed):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["The", "the", "a", "é"]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, text(rnd.choice([1, 2, 3, 4, 5, 6, 9, 17, 40, 80]))) for i in range(40)]
    docs = []
    for i in range(150):
        w = words(text(rnd.randint(0, 60)))
        for _ in range(rnd.randint(0, 3)):
            x = words(rnd.choice(items)[1])
            for _ in range(rnd.randint(0, 3)):
                if x:
                    x[rnd.randrange(len(x))] = rnd.choice(vocab)
            at = rnd.randint(0, len(w))
            w[at:at] = x
        docs.append((i, rnd.choice([" ", "\n", "  \t"]).join(w).upper() if i % 9 == 0 else " ".join(w)))
    return docs, items


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed):
    docs, items = corpus(seed)
    assert run(spark, docs, items) == brute(docs, items)


def test_low_threshold_and_other_width(spark):
    docs, items = corpus(9)
    assert run(spark, docs, items, n=3, threshold=0.5) == brute(docs, items, 3, 0.5)


def test_short_item_in_a_long_document(spark):
    item = "one two three four five six seven"
    docs = [(1, "x " * 60_000 + item + " y" * 60_000), (2, "x " * 10), (3, item.replace("four", "FOUR")), (4, "seven six five four three two one")]
    assert {r[0] for r in run(spark, docs, [(7, item)])} == {1, 3}


def test_defined_cases(spark):
    docs = [(1, None), (2, ""), (3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (4, "a\x0bb\x0cc d e f"), (5, "a b")]
    items = [(1, None), (2, ""), (3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (4, "A B"), (5, "zz")]
    assert run(spark, docs, items) == brute(docs, items) == {(3, 3, 2, 2), (4, 3, 2, 2), (3, 4, 1, 1), (4, 4, 1, 1), (5, 4, 1, 1)}
    df = spark.createDataFrame([(*r, "extra") for r in docs], "doc_id long, text string, leaking_doc string")
    left = decontaminate.decontamination_stage(df, spark.createDataFrame(items, "item_id long, text string"))
    assert left.columns == df.columns and sorted(str(r.doc_id) for r in left.collect()) == ["1", "2", "None"]


def test_hot_item_and_empty_tables(spark):
    docs = [(i, ("alpha beta gamma delta epsilon zeta" if i % 3 == 0 else "nothing of it here at all") + f" {i}") for i in range(1500)]
    assert len(run(spark, docs, [(1, "alpha beta gamma delta epsilon zeta")])) == 500
    assert run(spark, [], [(1, "a b c d e")]) == set() == run(spark, docs[:5], [])


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert {tuple(r) for r in queries.op4_decontamination(spark, SF).collect()} == brute(docs, items)
