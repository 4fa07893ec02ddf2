"""Versioned model store, folding in many users, and the k-core's rounds."""
import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from planted import planted
from tastebud.operators import als, kcore, rank_mf
from tastebud.sources import store
from test_kcore_encode_split import _brute_kcore


def state(model):
    return sorted((r.feature, tuple(r.vec), r.bias, tuple(r.g2v)) for r in model.item_state.collect())


def test_saving_over_the_loaded_model(spark, tmp_path):
    """Load, resume, save to the same path, again and again; every load gives what was saved last."""
    path = str(tmp_path / "m")
    likes = planted(spark).cache()
    rank_mf.save_model(rank_mf.fit_rank_mf(likes, loss="bpr", dim=4, epochs=1, seed=1, method="strata"), path)
    for n in range(2, 2 + store.KEEP + 1):
        model = rank_mf.resume(rank_mf.load_model(spark, path), likes, 1)
        want = state(model)
        rank_mf.save_model(model, path)
        again = rank_mf.load_model(spark, path)
        assert again.epochs_done == n and state(again) == want and state(model) == want
    assert len(os.listdir(f"{path}/versions")) == store.KEEP


def test_failure_in_mid_write_keeps_the_last_version(spark, tmp_path):
    path = str(tmp_path / "m")
    likes = planted(spark)
    model = rank_mf.init_rank_mf(likes, 4, 1, loss="bpr", learning_rate=0.05, item_alpha=0.0, user_alpha=0.0, max_sampled=1, batches=1)
    rank_mf.save_model(model, path)
    bad = rank_mf.load_model(spark, path)
    bad.item_state = bad.item_state.withColumn("bias", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        rank_mf.save_model(bad, path)
    assert state(rank_mf.load_model(spark, path)) == state(model) and len(os.listdir(f"{path}/versions")) == 1
    os.makedirs(f"{path}/commits/0000000009")  # a commit that never finished
    assert state(rank_mf.load_model(spark, path)) == state(model)
    with pytest.raises(FileNotFoundError):
        rank_mf.load_model(spark, str(tmp_path / "none"))


def test_als_fit_over_itself(spark, tmp_path):
    rows = [(2 ** 40 + u, (u * 7 + k) % 25, float(1 + (u + k) % 5)) for u in range(20) for k in range(6)]
    fit = als.fit_als(spark.createDataFrame(rows, "user long, item long, rating double"), rank=3, iters=2, seed=1)
    path = str(tmp_path / "f")
    als.save_fit(fit, path)
    als.save_fit(als.load_fit(spark, path), path)
    got = als.load_fit(spark, path)
    assert got.user_map is not None and got.item_map is None
    read = lambda f: sorted((r.id, tuple(r.vec)) for r in als.als_factors(f)[0].collect())
    assert read(got) == read(fit)


def test_fold_in_of_a_table(spark):
    """Every user's factor solves its normal equations; the single-user form agrees; a hot user too."""
    rng = np.random.default_rng(1)
    y = rng.normal(size=(300, 6))
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(y)], "id long, vec array<double>")
    rated = [(f"u{u}", int(i), float(rng.integers(1, 6))) for u in range(60) for i in rng.choice(300, 1 + u % 7, replace=False)]
    rated += [("hot", i, 5.0) for i in range(300)] + [("cold", 9999, 1.0), ("part", 9999, 1.0), ("part", 3, 2.0)]
    liked = spark.createDataFrame(rated, "user string, item long, rating double").repartition(6)
    got = {r.user: (np.array(r.vec), r.n) for r in als.fold_in_users(items, liked, 0.1).collect()}
    by = {}
    for u, i, r in rated:
        if i < 300:
            by.setdefault(u, []).append((i, r))
    assert got.keys() == by.keys() and "cold" not in got and got["hot"][1] == 300
    for u, rows in by.items():
        m, r = y[[i for i, _ in rows]], np.array([r for _, r in rows])
        assert np.allclose(got[u][0], np.linalg.solve(m.T @ m + 0.1 * len(rows) * np.eye(6), m.T @ r))
    one = als.fold_in_user(items, liked.where("user = 'hot'").select("item"), 5.0, 0.1)
    assert np.allclose(one, got["hot"][0])


def test_fold_in_sends_rows_of_users_with_few():
    """Users with a row each send their rows, not sums of rank * rank / 2 numbers; a user with many sends one sum."""
    import pyarrow as pa
    k, n = 16, 500
    vecs = np.random.default_rng(2).normal(size=(2 * n, k))
    users = [*range(n), *[None] * n]
    batch = pa.RecordBatch.from_arrays([pa.array(users, pa.int64()), pa.array(np.ones(2 * n)), pa.array(vecs.tolist())], names=["user", "rating", "vec"])
    parts = list(als._normal_parts([batch]))
    assert sum(len(p.column(2).flatten()) for p in parts) <= n * (k + 1) + k * (k + 3) // 2
    order = pa.Table.from_batches(parts).take(pa.array([n, *range(n)])).to_batches(max_chunksize=7)  # one user after another, across batches
    got = [r for b in als._solved(order, 0.1) for r in b.to_pylist()]
    assert len(got) == n + 1 and sum(r["n"] for r in got) == 2 * n
    hot = next(r for r in got if r["user"] is None)
    assert np.allclose(hot["vec"], np.linalg.solve(vecs[n:].T @ vecs[n:] + 0.1 * n * np.eye(k), vecs[n:].sum(axis=0)))


def test_many_requests_at_once(spark):
    rows = [(u, (u * 7 + k) % 25, float(1 + (u + k) % 5)) for u in range(30) for k in range(6)]
    ratings = spark.createDataFrame(rows, "user long, item long, rating double")
    fit = als.fit_als(ratings, rank=3, reg=0.1, iters=3, seed=1)
    items = spark.createDataFrame([(i, f"t{i}", "g") for i in range(25)], "item long, title string, genres string")
    requests = spark.createDataFrame([(q, (q + k) % 25) for q in range(40) for k in range(1 + q % 3)], "request long, item long")
    got = als.recommend_for_requests(fit, requests, items, 5).collect()
    mine = {}
    for r in got:
        mine.setdefault(r.request, []).append((r["rank"], r.item))
    assert len(mine) == 40 and all(len(v) == 5 for v in mine.values())
    asked = {(r.request, r.item) for r in requests.collect()}
    assert not asked & {(r.request, r.item) for r in got}
    for q in (0, 7):
        one = als.recommend_for_liked(ratings, items, requests.where(F.col("request") == q).select("item"), 5, reg=0.05, mode="fold_in", fit=fit)
        assert [i for _, i in sorted(mine[q])] == [r.item for r in sorted(one.collect(), key=lambda r: r["rank"])]


@pytest.mark.parametrize("seed,least", [(1, (2, 3)), (2, (4, 2)), (3, (3, 3))])
def test_kcore_rounds_and_one_task_agree(spark, seed, least):
    rng = np.random.default_rng(seed)
    pairs = sorted({(int(u), int(i)) for u, i in zip(rng.zipf(1.4, 500) % 90, rng.integers(0, 70, 500))})
    df = spark.createDataFrame([*pairs, *pairs[:20], (None, 3), (4, None)], "user long, item long").withColumn("v", F.lit(1))
    want = _brute_kcore(set(pairs), *least)
    for bound in (0, 60, 10 ** 6):
        got = kcore.kcore(df, *least, finish_pairs=bound)
        assert {(r.user, r.item) for r in got.collect()} == want
        assert got.count() == len([p for p in pairs + pairs[:20] if p in want])


def test_long_chain_in_bounded_time(spark):
    chain = spark.createDataFrame([(i // 2 + i % 2, i // 2) for i in range(3000)], "user long, item long")
    began = time.time()
    assert kcore.kcore(chain, 2, 2).count() == 0
    assert time.time() - began < 20


def test_peel_of_a_long_chain_and_a_block():
    n = 20_000
    u = np.concatenate([np.arange(n) // 2 + np.arange(n) % 2, np.repeat(np.arange(5), 5) + n])
    i = np.concatenate([np.arange(n) // 2, np.tile(np.arange(5), 5) + n])
    assert np.flatnonzero(kcore.peel(u, i, 2, 2)).tolist() == list(range(n, n + 25))


def test_peel_against_brute_force():
    rng = np.random.default_rng(9)
    for _ in range(300):
        pairs = sorted({(int(a), int(b)) for a, b in zip(rng.integers(0, 30, 150), rng.integers(0, 25, 150))})
        u, i = (np.unique(np.array(c), return_inverse=True)[1] for c in zip(*pairs))
        least = int(rng.integers(1, 7)), int(rng.integers(1, 7))
        keep = kcore.peel(u, i, *least)
        assert {p for p, k in zip(pairs, keep) if k} == _brute_kcore(set(pairs), *least)
