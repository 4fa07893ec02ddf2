import numpy as np
import pytest
from pyspark.sql import functions as F

from tastebud.operators import encode, similarity
from tastebud.operators.blocks import block_top_k
from tastebud.operators.pruned import pruned_top_k


def _frame(spark, m, offset=0):
    return spark.createDataFrame([(offset + i, [float(x) for x in v]) for i, v in enumerate(m)], "id long, vec array<double>")


def _rows(df):
    return sorted((r.user, r["rank"], r.item, round(r.score, 9)) for r in df.collect())


def _both(left, right, k, **kw):
    want = block_top_k(left, right, k, left_key="id", right_key="id", out_left="user", out_right="item", **kw)
    got = pruned_top_k(left, right, k, left_key="id", right_key="id", out_left="user", out_right="item", block_rows=16, **kw)
    return got, _rows(got.rows), _rows(want)


@pytest.mark.parametrize("decimals", [None, 3])
def test_skewed_norms_give_the_same_rows_and_skip_blocks(spark, decimals):
    rng = np.random.default_rng(5)
    users = rng.normal(size=(60, 6))
    items = rng.normal(size=(700, 6)) / (1 + np.arange(700))[:, None] ** 0.7
    seen = spark.createDataFrame([(u, 1000 + i) for u in range(60) for i in range(u % 9)] + [(7, 1000 + i) for i in range(250)], "u long, i long")
    got, rows, want = _both(_frame(spark, users), _frame(spark, items, 1000), 5, exclude=seen, decimals=decimals)
    assert rows == want and len(rows) == 300
    assert got.total == 60 * 44 and 0.5 < got.skipped < 1.0


def test_equal_norms_skip_nothing_and_ties_go_to_the_smaller_key(spark):
    left = _frame(spark, [[1.0, 0.0], [0.0, 0.0]])
    right = _frame(spark, [[1.0, 0.0]] * 100, 10)
    got, rows, want = _both(left, right, 3)
    assert rows == want and [r[2] for r in rows] == [10, 11, 12, 10, 11, 12]
    assert got.scored == got.total == 2 * 7


def test_a_tie_behind_a_longer_vector_is_kept(spark):
    # a bound equal to the k-th score must not be skipped: the shorter vectors hold the smaller key
    left = _frame(spark, [[1.0, 0.0]], 500)
    right = spark.createDataFrame([(100 + i, [2.0, 5.0]) for i in range(16)] + [(i, [2.0, 0.0]) for i in range(20)], "id long, vec array<double>")
    _, rows, want = _both(left, right, 2)
    assert rows == want and [r[2] for r in rows] == [0, 1]


def test_few_candidates_negative_scores_and_self(spark):
    rng = np.random.default_rng(6)
    m = -np.abs(rng.normal(size=(50, 3))) * (1 + np.arange(50))[:, None]
    both = _frame(spark, np.vstack([m[:25], -m[25:]]))
    for k in (4, 80):
        _, rows, want = _both(both, both, k, exclude_self=True)
        assert rows == want and all(r[0] != r[2] for r in rows)
    all_seen = both.select(F.lit(0).cast("long").alias("u"), "id")
    _, rows, want = _both(both, both, 4, exclude=all_seen)
    assert rows == want and all(r[0] != 0 for r in rows)


def test_empty_sides_string_keys_and_bad_vectors(spark):
    some = _frame(spark, np.eye(4))
    none = some.where("id < 0")
    for a, b in ((some, none), (none, some), (none, none)):
        got = pruned_top_k(a, b, 2, left_key="id", right_key="id", out_right="o")
        assert got.rows.count() == 0 and got.skipped in (0.0, 1.0)
    text = some.select(F.concat(F.lit("k"), "id").alias("id"), "vec")
    got, rows, want = _both(text, text, 2, exclude=text.select("id", F.col("id").alias("o")))
    assert rows == want and len(rows) == 8
    with pytest.raises(ValueError):
        pruned_top_k(some, some, 0, left_key="id", right_key="id")
    broken = some.unionByName(_frame(spark, [[float("nan")] * 4], 9))
    with pytest.raises(Exception, match="not finite"):
        pruned_top_k(some, broken, 2, left_key="id", right_key="id", out_right="o").rows.count()


def test_recommend_unseen_agrees_with_and_without_pruning(spark):
    rng = np.random.default_rng(7)
    users, items = _frame(spark, rng.normal(size=(20, 4))), _frame(spark, rng.normal(size=(90, 4)) * rng.pareto(1, size=(90, 1)))
    seen = spark.createDataFrame([(u, (u * 3 + j) % 90, float(j)) for u in range(20) for j in range(5)], "user long, item long, v double")
    a, b = (similarity.recommend_unseen(users, items, seen, 6, threshold=1.0, value="v", prune=p, block_rows=8) for p in (False, True))
    assert _rows(a) == _rows(b)


@pytest.mark.parametrize("dim", [None, 3])
def test_representations_with_a_hot_feature(spark, dim):
    rng = np.random.default_rng(8)
    emb = {f: rng.normal(size=3) for f in ("hot", "a", "b", "unused")}
    rows = [(i, "hot", 0.5) for i in range(300)] + [(i, "ab"[i % 2], 1.0 + i) for i in range(0, 300, 3)] + [(1, "hot", 2.0), (2, "unknown", 1.0), (3, None, 1.0), (4, "a", None), (999, "unknown", 1.0)]
    feats = spark.createDataFrame(rows, "item long, feature string, weight double").withColumn("vec", F.lit("clash"))
    got = {r.item: r.vec for r in similarity.representations(feats, spark.createDataFrame([(f, v.tolist()) for f, v in emb.items()], "feature string, vec array<double>"), "item", dim=dim, parts=16).collect()}
    want = {}
    for i, f, w in rows:
        if f in emb and w is not None:
            want[i] = want.get(i, 0) + w * emb[f]
    assert got.keys() == want.keys() and 999 not in got
    assert all(got[i] == pytest.approx(want[i]) for i in want)


def test_sparse_vectors_run_in_the_jvm(spark):
    rows = [(1, 3, 0.1), (1, 0, 1 / 3), (1, 3, 0.25), (2, None, 1.0), (3, 4, 5e-324), (4, 0, 1.7976931348623157e308), (5, 1, None)]
    df = spark.createDataFrame(rows, "item long, feature_idx long, weight double")
    out = encode.features_to_vector(df, 5)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    got = {r.item: dict(zip(r.features.indices.tolist(), r.features.values.tolist())) for r in out.collect()}
    assert got == {1: {0: 1 / 3, 3: 0.35}, 2: {}, 3: {4: 5e-324}, 4: {0: 1.7976931348623157e308}, 5: {}}
    assert {r.features.size for r in out.collect()} == {5}
    assert encode.features_to_vector(df.where("item < 0"), 5).count() == 0
    for bad in ((9, 5, 1.0), (9, -1, 1.0), (9, 1, float("nan")), (9, 1, float("inf"))):
        with pytest.raises(Exception, match="feature index outside"):
            encode.features_to_vector(spark.createDataFrame([bad], df.schema), 5).collect()


def test_sparse_vectors_feed_an_mllib_estimator(spark):
    from pyspark.ml.feature import IDF
    df = spark.createDataFrame([(i, j, 1.0) for i in range(6) for j in range(i + 1)], "item long, feature_idx long, weight double")
    model = IDF(inputCol="features", outputCol="o").fit(encode.features_to_vector(df, 6))
    assert list(model.docFreq) == [6, 5, 4, 3, 2, 1]
