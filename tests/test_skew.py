"""A hot user holding a third of all rows and a hot item: results stay exact."""
import numpy as np
from pyspark.sql import functions as F

from tastebud.operators import blocks, kcore, rank_mf, split
from test_kcore_encode_split import _brute_kcore


def _skewed(spark):
    base = [(u, (u * 13 + k) % 300) for u in range(1, 200) for k in range(6)]
    hot_user = [(0, i) for i in range(300)] + [(0, i) for i in range(300, 600)]      # a third of the rows
    hot_item = [(u, 7) for u in range(1, 200)]
    rows = sorted(set(base + hot_user + hot_item))
    return rows, spark.createDataFrame(rows, "user long, item long").repartition(8)


def test_kcore_and_holdout_with_hot_keys(spark):
    rows, df = _skewed(spark)
    assert sum(1 for u, _ in rows if u == 0) * 3 >= len(rows) * 0.9
    got = {tuple(r) for r in kcore.kcore(df, 5, 3).collect()}
    assert got == _brute_kcore(set(rows), 5, 3)
    train, test, users = split.holdout_per_user(df, 4, None, 3)
    counts = {r.user: r["count"] for r in test.groupBy("user").count().collect()}
    assert set(counts.values()) == {4} and len(counts) == 200
    split.assert_disjoint(train, test)


def test_top_k_excludes_a_huge_history(spark):
    rows, df = _skewed(spark)
    users = spark.range(0, 10).select(F.col("id").alias("id"),
                                      F.array(F.lit(1.0), (F.col("id") % 3).cast("double")).alias("vec"))
    items = spark.range(0, 600).select(F.col("id").alias("id"),
                                       F.array((F.col("id") % 17).cast("double"), F.lit(0.5)).alias("vec"))
    seen = df.where("user < 10")
    out = blocks.block_top_k(users, items, 3, left_key="id", right_key="id", exclude=seen, block_rows=64,
                             out_left="user", out_right="item")
    got = {}
    for r in out.collect():
        got.setdefault(r.user, {})[r["rank"]] = r.item
    seen_set = set((u, i) for u, i in rows if u < 10)
    for u in range(10):
        s = [(-round(float(np.dot([1.0, u % 3], [i % 17, 0.5])), 6), i) for i in range(600) if (u, i) not in seen_set]
        want = [i for _, i in sorted(s)[:3]]
        assert [got.get(u, {}).get(k) for k in (1, 2, 3)] == (want + [None] * 3)[:3]


def test_training_runs_with_hot_user(spark):
    _, df = _skewed(spark)
    m = rank_mf.fit_rank_mf(df, loss="warp", dim=4, epochs=1, seed=1, max_sampled=3)
    assert m.user_reps().count() == 200
