import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tastebud.operators import encode, kcore, split


def test_kcore_docstring_example(spark):
    df = spark.createDataFrame([(1001, 2002), (1001, 2004), (1002, 2002)], "user long, item long")
    got = sorted(tuple(r) for r in kcore.kcore(df, user_min=2, item_min=1).collect())
    assert got == [(1001, 2002), (1001, 2004)]


def _brute_kcore(pairs, umin, imin):
    cur = set(pairs)
    while True:
        uc, ic = {}, {}
        for u, i in cur:
            uc[u] = uc.get(u, 0) + 1
        nxt = {(u, i) for u, i in cur if uc[u] >= umin}
        for u, i in nxt:
            ic[i] = ic.get(i, 0) + 1
        nxt = {(u, i) for u, i in nxt if ic[i] >= imin}
        if nxt == cur:
            return cur
        cur = nxt


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.sets(st.tuples(st.integers(0, 8), st.integers(0, 8)), min_size=1, max_size=40),
       st.integers(1, 3), st.integers(1, 3))
def test_kcore_matches_brute_force(spark, pairs, umin, imin):
    df = spark.createDataFrame(sorted(pairs), "user long, item long")
    got = {tuple(r) for r in kcore.kcore(df, umin, imin).collect()}
    assert got == _brute_kcore(pairs, umin, imin)


def test_index_ids_is_sorted_bijection_wide_ids(spark):
    ids = [2 ** 40 + 5, 3, 2 ** 33, 17, 3]
    df = spark.createDataFrame([(i,) for i in ids], "user long").repartition(5)
    got = sorted((r.user, r.idx) for r in encode.index_ids(df, "user", num_partitions=3).collect())
    assert got == [(v, k) for k, v in enumerate(sorted(set(ids)))]


def test_index_ids_partition_invariant(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 100003).alias("item"))
    a = {tuple(r) for r in encode.index_ids(df.coalesce(1), "item", num_partitions=1).collect()}
    b = {tuple(r) for r in encode.index_ids(df.repartition(8), "item", num_partitions=8).collect()}
    assert a == b and sorted(v for _, v in a) == list(range(1000))


def test_encode_features_collapses_duplicates(spark):
    side = spark.createDataFrame([(1, "tag", "Red"), (1, "tag", "red"), (2, "brand", "X")],
                                 "item long, type string, value string")
    got = sorted((r.item, r.feature, r.feature_idx, r.weight) for r in encode.encode_features(side).collect())
    assert got == [(1, "tag_red", 1, 1.0), (2, "brand_x", 0, 1.0)]


def test_hash_split_partitions_rows(spark):
    df = spark.range(2000).select((F.col("id") % 50).alias("user"), F.col("id").alias("item"))
    t = split.hash_split(df, 0.25, 7)
    n_test = t.where("split = 'test'").count()
    assert t.count() == 2000 and 400 < n_test < 600


def test_holdout_exact_counts_and_errors(spark):
    rows = [(u, i) for u in range(20) for i in range(u % 5 + 6)]
    df = spark.createDataFrame(rows, "user long, item long")
    train, test, users = split.holdout_per_user(df, 3, 0.5, seed=1)
    per_user = {r.user: r["count"] for r in test.groupBy("user").count().collect()}
    assert len(per_user) == 10 and set(per_user.values()) == {3}
    split.assert_disjoint(train, test)
    assert train.count() + test.count() == len(rows)
    with pytest.raises(ValueError):
        split.holdout_per_user(df, 4, 1.0, seed=1)  # 20 users wanted, only 12 have >= 8 items
    short = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "user long, item long")
    with pytest.raises(ValueError):
        split.holdout_per_user(short, 2)
    with pytest.raises(AssertionError):
        split.assert_disjoint(df, df)


def test_kcore_with_round_tables(spark):
    pairs = {(u, (u * 7 + k) % 23) for u in range(40) for k in range(u % 6 + 1)}
    df = spark.createDataFrame(sorted(pairs), "user long, item long")
    got = {tuple(r) for r in kcore.kcore(df, 3, 4, finish_pairs=0).collect()}
    assert got == _brute_kcore(pairs, 3, 4)
