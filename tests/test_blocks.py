import numpy as np
import pytest
from pyspark.sql import functions as F

from tastebud.operators.blocks import block_auc, block_top_k


def _vecs(spark, n, dim, seed, offset=0):
    rng = np.random.default_rng(seed)
    m = np.round(rng.normal(size=(n, dim)), 3)
    return m, spark.createDataFrame([(offset + i, m[i].tolist()) for i in range(n)], "id long, vec array<double>")


def _brute_topk(L, R, k, excl=(), self_excl=False, roff=0):
    s = np.round(L @ R.T, 6)
    out = {}
    for u in range(L.shape[0]):
        cand = [(-s[u, j], j + roff) for j in range(R.shape[0])
                if (u, j + roff) not in excl and not (self_excl and u == j + roff)]
        out[u] = [j for _, j in sorted(cand)[:k]]
    return out


@pytest.mark.parametrize("block_rows,slice_rows", [(7, 512), (1000, 512), (1000, 4)])
def test_block_top_k_matches_brute_force(spark, monkeypatch, block_rows, slice_rows):
    from tastebud.operators import blocks
    monkeypatch.setattr(blocks, "SLICE_ROWS", slice_rows)
    L, ldf = _vecs(spark, 30, 4, 1)
    R, rdf = _vecs(spark, 45, 4, 2, offset=100)
    excl = {(u, 100 + (u * 7) % 45) for u in range(30)}
    edf = spark.createDataFrame(sorted(excl), "u long, i long")
    got = block_top_k(ldf, rdf, 5, left_key="id", right_key="id", exclude=edf, block_rows=block_rows,
                      out_left="user", out_right="item")
    rows = got.collect()
    by_user = {}
    for r in sorted(rows, key=lambda r: (r.user, r["rank"])):
        by_user.setdefault(r.user, []).append(r.item)
    assert by_user == _brute_topk(L, R, 5, excl, roff=100)


def test_ties_break_by_id_and_self_excluded(spark):
    df = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(6)], "id long, vec array<double>")
    got = block_top_k(df, df, 3, left_key="id", right_key="id", exclude_self=True, block_rows=2,
                      out_left="item", out_right="nb").where("item = 0").orderBy("rank").collect()
    assert [r.nb for r in got] == [1, 2, 3]


def test_block_auc_matches_brute_force(spark, monkeypatch):
    from tastebud.operators import blocks
    monkeypatch.setattr(blocks, "SLICE_ROWS", 3)
    L, ldf = _vecs(spark, 12, 3, 3)
    R, rdf = _vecs(spark, 25, 3, 4)
    pos = {(u, (u * 3) % 25) for u in range(12)} | {(u, (u * 5 + 1) % 25) for u in range(12)}
    train = {(u, (u * 11 + 2) % 25) for u in range(12)} - pos
    got = {r.id: r.auc for r in block_auc(ldf, rdf, spark.createDataFrame(sorted(pos), "u long, i long"),
                                          left_key="id", right_key="id",
                                          train=spark.createDataFrame(sorted(train), "u long, i long"),
                                          block_rows=5, chunk=1).collect()}
    s = np.round(L @ R.T, 6)
    for u in range(12):
        p = [j for (uu, j) in pos if uu == u]
        n = [j for j in range(25) if (u, j) not in pos and (u, j) not in train]
        wins = sum(1.0 if s[u, a] > s[u, b] else 0.5 if s[u, a] == s[u, b] else 0.0 for a in p for b in n)
        assert got[u] == pytest.approx(wins / (len(p) * len(n)))


def test_vector_sum_paths_agree(spark):
    from tastebud.operators.similarity import vector_sum
    df = spark.createDataFrame([(k % 3, [float(k), 1.0, -k / 2.0], 0.5 + k) for k in range(20)],
                               "key long, vec array<double>, w double")
    a = {r.key: r.vec for r in vector_sum(df, "key", "vec", "w").collect()}
    b = {r.key: r.vec for r in vector_sum(df, "key", "vec", "w", dim=3).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k])


def test_empty_sides_and_empty_test(spark):
    from tastebud.operators import evaluate as ev
    _, df = _vecs(spark, 10, 3, 7)
    empty = df.where("id < 0")
    assert block_top_k(empty, df, 3, left_key="id", right_key="id").count() == 0
    assert block_top_k(df, empty, 3, left_key="id", right_key="id").count() == 0
    no_pairs = spark.createDataFrame([], "user long, item long")
    assert ev.precision_recall_at_k(df, df, no_pairs, 3).count() == 0
    assert ev.auc_per_user(df, df, no_pairs).count() == 0


def test_auc_invariant_to_monotone_score_map_and_bounded(spark):
    from tastebud.operators import evaluate as ev
    _, users = _vecs(spark, 15, 3, 11)
    _, items = _vecs(spark, 40, 3, 12, offset=100)
    test = spark.createDataFrame([(u, 100 + (u * 7 + k) % 40) for u in range(15) for k in range(3)],
                                 "user long, item long")
    scaled = users.select("id", F.transform("vec", lambda x: x * 3.0).alias("vec"))
    a = {r.user: r.auc for r in ev.auc_per_user(users, items, test, decimals=None).collect()}
    b = {r.user: r.auc for r in ev.auc_per_user(scaled, items, test, decimals=None).collect()}
    assert a.keys() == b.keys() and all(a[u] == pytest.approx(b[u]) for u in a)
    assert all(0.0 <= v <= 1.0 for v in a.values())
    pr = ev.precision_recall_at_k(users, items, test, 5).collect()
    assert all(0.0 <= r.precision <= 1.0 and 0.0 <= r.recall <= 1.0 for r in pr)


def test_right_rows_are_repeated_once_per_task_not_per_block(spark):
    """Rows sent grow with the tasks, not with the blocks of the other side."""
    from tastebud.operators import blocks
    a, b = blocks._layout(spark, 1_000_000, 2_000_000, blocks.LEFT_BLOCKS * blocks.DEFAULT_BLOCK_ROWS)
    assert b == 1 and a <= max(16, 2 * spark.sparkContext.defaultParallelism)


@pytest.mark.parametrize("kind,decimals", [("long", None), ("long", 1), ("string", 1)])
def test_streamed_best_against_all_scores(monkeypatch, kind, decimals):
    """Ties by key, repeated and null keys, exclusions and tiles that don't fit: as from the full score matrix."""
    import pyarrow as pa
    from tastebud.operators import blocks
    monkeypatch.setattr(blocks, "TILE_ROWS", 16)
    monkeypatch.setattr(blocks, "SLICE_ROWS", 5)
    rng = np.random.default_rng(3)
    L, R = rng.integers(-3, 4, (23, 3)) / 2, rng.integers(-3, 4, (211, 3)) / 2
    name = (lambda x: f"k{x:04d}") if kind == "string" else int
    lkeys, rkeys = [name(i) for i in range(22)] + [name(0)], [name(rng.integers(0, 10 ** 4)) for _ in range(209)] + [None, name(5)]
    gone = {(lkeys[i], rkeys[j]) for i in range(22) for j in rng.integers(0, 211, i * 10)} - {(x, None) for x in lkeys}
    typ = pa.string() if kind == "string" else pa.int64()
    best = blocks._Best(pa.array(lkeys, typ), L, 7, decimals, True)
    xl, xr = (pa.array([p[c] for p in sorted(gone)], typ) for c in (0, 1))
    for a in range(0, 211, 50):
        best.add(pa.array(rkeys[a:a + 50], typ), R[a:a + 50], xl, xr)
    got = {}
    for batch in best.rows(typ):
        for r in batch.to_pylist():
            got.setdefault(r["lk"], []).append((r["rk"], r["score"]))
    s = L @ R.T
    r = np.round(s, decimals) if decimals else s
    want = {}
    for i, x in enumerate(lkeys):
        order = sorted((-r[i, j], y is not None, y or name(0), float(s[i, j])) for j, y in enumerate(rkeys) if x != y and (x, y) not in gone)[:7]
        want.setdefault(x, []).extend((y if known else None, v) for _, known, y, v in order)
    assert {x: sorted(map(str, v)) for x, v in got.items()} == {x: sorted(map(str, v)) for x, v in want.items()}


@pytest.mark.parametrize("decimals", [None, 1, 6])
def test_few_wins_against_all_scores(monkeypatch, decimals):
    """Ties, excluded pairs and padded positives count as from the full score matrix."""
    from tastebud.operators import blocks
    monkeypatch.setattr(blocks, "TILE_ROWS", 24)
    rng = np.random.default_rng(4)
    L, R = rng.integers(-4, 5, (17, 3)) / 2, rng.integers(-4, 5, (100, 3)) / 2
    gone = sorted({(int(i), int(j)) for i, j in zip(rng.integers(0, 17, 200), rng.integers(0, 100, 200))})
    li, ri = (np.array([p[c] for p in gone]) for c in (0, 1))
    r = np.round(L @ R.T, decimals) if decimals is not None else L @ R.T
    pos = np.full((17, 5), -np.inf)
    for i in range(17):
        pos[i, :i % 6] = r[i, rng.integers(0, 100, i % 6)]
    left = np.ones(r.shape, bool)
    left[li, ri] = False
    want = [sum((r[i, left[i]] < p).sum() + 0.5 * (r[i, left[i]] == p).sum() for p in pos[i] if p > -np.inf) for i in range(17)]
    assert blocks._few_wins(L, R, pos, li, ri, decimals).tolist() == want


def test_whole_block_scores_are_bounded():
    from tastebud.operators import blocks
    assert blocks._slice_rows(blocks.DEFAULT_BLOCK_ROWS) * blocks.DEFAULT_BLOCK_ROWS <= blocks.SLICE_CELLS and blocks._slice_rows(10) == blocks.SLICE_ROWS
