import math
import random
from fractions import Fraction

import numpy as np
import pytest
from conftest import SF

from tastebud.llm import queries, whitening


def integers(rows, d):
    keep = [(i, v) for i, v in rows if v is not None and len(v) == d and all(c is not None and math.isfinite(c) for c in v)]
    return [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in keep]


def check(got, rows, d, float32=False):
    if float32:
        rows = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
    x = integers(rows, d)
    n = len(x)
    total = [sum(v[j] for _, v in x) for j in range(d)]
    centred = [[n * sum(v[j] * v[k] for _, v in x) - total[j] * total[k] for k in range(d)] for j in range(d)]
    cov = np.array([[float(Fraction(c, n * n)) for c in row] for row in centred])
    e, w = np.linalg.eigh(cov)
    e, w = e[::-1], w[:, ::-1]
    k = min(32, d)
    assert sorted((r.vec_id, r.component, r.n, int(r.deviation)) for r in got) == sorted(
        (i, c, n, sum((n * a - s) ** 2 for a, s in zip(v, total))) for i, v in x for c in range(1, k + 1))
    assert {(r.component, round(r.explained / (e[r.component - 1] / e.sum()), 9)) for r in got} == {(c, 1.0) for c in range(1, k + 1)}
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    y = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(v, total)] for _, v in x])
    for c in range(k):
        if min(abs(e[c] - e[o]) for o in range(len(e)) if o != c) < 1e-3 * e[c]:
            continue  # not one direction
        want = np.sort(y @ w[:, c] / np.sqrt(e[c]))
        have = np.sort([r.whitened for r in got if r.component == c + 1])
        assert min(np.abs(have - want).max(), np.abs(np.sort(-have) - want).max()) < 1e-6


def vectors(seed, n, d, scale=1.0):
    rnd = np.random.default_rng(seed)
    mix = rnd.normal(size=(d, d))
    return [(i, (scale * (rnd.normal(size=d) * (1 + np.arange(d))) @ mix).tolist()) for i in range(n)]


def run(spark, rows, kind="double"):
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], f"vec_id long, embedding array<{kind}>, n int, component int").repartition(3)
    return whitening.whiten(df).collect()


@pytest.mark.parametrize("n,d,scale", [(300, 5, 0.1), (200, 40, 1.0), (90, 3, 1e4)])
def test_against_exact_arithmetic(spark, n, d, scale):
    rows = vectors(n, n, d, scale)
    check(run(spark, rows), rows, d)


def test_defined_cases(spark):
    rows = vectors(7, 120, 4)
    rows += [(500, None), (501, []), (502, [1.0, None, 2.0, 3.0]), (503, [float("nan"), 0.0, 0.0, 0.0]), (504, [0.0, float("-inf"), 1.0, 1.0]),
             (505, [1.0, 2.0, 3.0]), (None, [0.5, -0.5, 0.25, 9.0]), rows[3], rows[3], (1, [0.0] * 4)]
    got = run(spark, rows)
    x = integers(rows, 4)
    assert len(got) == 4 * len(x) and {r.n for r in got} == {len(x)}
    assert sum(r.vec_id is None for r in got) == 4 and sum(r.vec_id == rows[3][0] for r in got) == 12


def test_constant_dimensions_and_few_vectors(spark):
    """What has no variance has no component; the others are still whitened."""
    rows = [(i, [*v, 3.0, -1e6]) for i, v in vectors(3, 80, 3)]
    got = run(spark, rows)
    assert {r.component for r in got} == {1, 2, 3} and got[0].identity_error < 1e-9
    few = run(spark, vectors(4, 4, 10))
    assert {r.component for r in few} == {1, 2, 3} and few[0].identity_error < 1e-9


def test_nothing_to_whiten(spark):
    assert run(spark, []) == [] and run(spark, [(1, [1.0, 2.0])] * 5) == [] and run(spark, [(1, None)]) == []


def test_very_wide_values(spark):
    """Values of 40 bits: several digits a dimension, deviations beyond 64 bits, still exact."""
    rows = vectors(11, 64, 3, 1e9)
    check(run(spark, rows), rows, 3)


def test_planes_give_exact_products():
    rnd = random.Random(1)
    x = np.array([[rnd.randrange(1 << b) for b in (1, 7, 16, 17, 40)] + [5] for _ in range(1000)], np.int64) + 1_000_000
    planes = whitening.Planes(x.min(axis=0), x.max(axis=0))
    import pyarrow as pa

    back = (x - whitening.OFFSET) / whitening.SCALE
    batch = pa.RecordBatch.from_arrays([pa.array(back.tolist())], names=["v"])
    (out,) = whitening._products([batch], 6, planes)
    sums, centred = whitening.centred_products(1000, zip(*(c.to_pylist() for c in out.columns)), planes, 6)
    u = [[int(a) for a in row] for row in (x - x.min(axis=0))]
    assert sums == [sum(r[j] for r in u) for j in range(6)]
    assert centred == [[1000 * sum(r[j] * r[k] for r in u) - sums[j] * sums[k] for k in range(6)] for j in range(6)]


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(queries.op13_embedding_whitening(spark, SF).collect(), rows, len(rows[0][1]))
