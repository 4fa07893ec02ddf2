import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import SF

from tastebud.llm import lexical, queries

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(t):
    return re.findall(TERM, (t or "").translate(LOWER))


def brute(docs, items, k=50):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    n = [sum(c.values()) for _, c in counts]
    n_docs, total = sum(x > 0 for x in n), sum(n)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for i, t in items:
        if i is not None:
            wanted.setdefault(i, set()).update(terms(t))
    out = []
    for i, ts in wanted.items():
        found = []
        for (d, c), length in zip(counts, n):
            s = 0
            for t in ts & c.keys():
                m = 50 + (50 * length * n_docs) // total
                s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 20 * m))
            if s > 0 and d is not None:
                found.append((-s, d))
        out += [(i, r, d, -s) for r, (s, d) in enumerate(sorted(found)[:k], start=1)]
    return sorted(out)


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, score int, term string").repartition(3)
    i = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, rank int")
    return sorted(map(tuple, lexical.rank_documents(d, i, **options).collect()))


def corpus(seed, n=150):
    rnd = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdeÉñ日" for b in ["", "1", "Z", "q", "ß"]]
    weights = [1 / (i + 1) for i in range(len(words))]
    text = lambda m: rnd.choice([" ", ", ", "\n", "-"]).join(rnd.choices(words, weights, k=m))
    docs = [(i * 37 % 1009, text(rnd.choice([0, 1, 2, 5, 20, 200]))) for i in range(n)]
    return docs + [(2000, None), (2001, "..."), (2002, "")], [(i, text(rnd.choice([1, 4, 20]))) for i in range(12)] + [(50, None), (51, "-- !"), (52, "absentterm")]


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, seed):
    docs, items = corpus(seed)
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs, items, k=3, block_postings=150) == brute(docs, items, 3)


def test_defined_cases(spark):
    docs, items = corpus(5, 40)
    docs += [docs[0], (docs[1][0], "another text a b c"), (None, "a b c d"), (3000, "a " * 5000)]
    items += [(1, "A1 Bq"), (None, "a b"), items[2]]
    assert run(spark, docs, items) == brute(docs, items)


def test_ties_go_by_id(spark):
    """Many copies with one score: the smallest ids, whatever block they are in."""
    docs = [(i, "same words here") for i in range(400, 0, -1)] + [(1000, "other words")]
    items = [(1, "same here"), (2, "words")]
    assert run(spark, docs, items, k=7, block_postings=60) == brute(docs, items, 7)


def test_items_in_slices(spark):
    docs, items = corpus(6)
    assert run(spark, docs, items, max_item_terms=20) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = corpus(1, 5)
    assert run(spark, [], items) == [] and run(spark, docs, []) == []


def test_query(spark):
    read = lambda t, i: [(r[i], r.text) for r in spark.read.parquet(f"{SF}/{t}.parquet").collect()]
    got = queries.op12_ranked_lexical_search(spark, SF)
    assert sorted(map(tuple, got.collect())) == brute(read("documents", "doc_id"), read("benchmark", "item_id"))


def make_block(seed=1, n=3000, vocabulary=40):
    rnd = np.random.default_rng(seed)
    counts = rnd.integers(0, 12, n)
    t, tf = [], []
    for c in counts:
        t.append(np.sort(rnd.choice(vocabulary, c, replace=False)))
        tf.append(rnd.integers(1, 9, c))
    length = np.array([x.sum() for x in tf]) + 3
    weights = rnd.integers(0, 4000, vocabulary)
    return lexical.Block(rnd.permutation(n) * 3, length, counts, np.concatenate(t).astype(np.int64), np.concatenate(tf).astype(np.int64), weights, n, int(length.sum()))


def test_range_maxima():
    block = make_block()
    rnd = np.random.default_rng(2)
    t = rnd.integers(0, 40, 500)
    low, high = block.first[t], block.first[t + 1]
    a = low + (rnd.random(500) * (high - low)).astype(np.int64)
    b = a + (rnd.random(500) * (high - a + 1)).astype(np.int64)
    position, value = block.most(a, b)
    for x, y, p, v in zip(a, b, position, value):
        assert v == (block.impact[x:y].max() if y > x else 0)
        assert y <= x or (x <= p < y and block.impact[p] == v)


def test_best_first_opens_few_intervals():
    """The bounds prune: far fewer intervals than documents are opened, and the best are right."""
    block = make_block(3, 20_000, 60)
    none = np.zeros(0, np.int64)
    for terms_ in ([3], [1, 5], [2, 7, 30]):
        scores, ids, opened = block.search(np.array(terms_), 10, none, none)
        total = np.zeros(block.size, np.int64)
        for t in terms_:
            at = slice(block.first[t], block.first[t + 1])
            np.add.at(total, block.doc[at], block.impact[at])
        order = np.lexsort((block.ids, -total))[:10]
        assert scores.tolist() == total[order].tolist() and ids.tolist() == block.ids[order].tolist()
        assert opened < block.size / 5
