import pytest
from pyspark.sql import functions as F

from tastebud.operators import relational as rel


def test_search_items_like_semantics(spark):
    items = spark.createDataFrame([(1, "Toy Story"), (2, "Story_Time"), (3, "100% Love"), (4, "Other")],
                                  "item long, title string")
    got = {r.item for r in rel.search_items(items, "story").collect()}
    assert got == {1, 2}
    # '_' and '%' are wildcards in LIKE mode, plain characters in literal mode
    assert {r.item for r in rel.search_items(items, "t_e").collect()} == {4}
    assert {r.item for r in rel.search_items(items, "t_e", literal=True).collect()} == set()
    assert {r.item for r in rel.search_items(items, "y%t").collect()} == {1, 2}
    assert {r.item for r in rel.search_items(items, "y%t", literal=True).collect()} == set()
    assert {r.item for r in rel.search_items(items, "0% l", literal=True).collect()} == {3}
    assert rel.search_items(items, "no such title").isEmpty()


def test_binarize_is_strict(spark):
    df = spark.createDataFrame([(1, 1, 2.0), (1, 2, 3.0)], "user long, item long, value double")
    got = sorted((r.item, r.value) for r in rel.binarize(df, 2.0).collect())
    assert got == [(1, 0), (2, 1)]


def test_known_likes_top_and_full(spark):
    df = spark.createDataFrame([(1, i, 1.0) for i in range(5)] + [(1, 9, 0.0)], "user long, item long, value double")
    top = rel.known_likes(df, 0.0, n=3).orderBy("pos").collect()
    assert [r.item for r in top] == [4, 3, 2] and [r.pos for r in top] == [1, 2, 3]
    assert [r.item for r in rel.known_likes(df).collect()] == [4, 3, 2, 1, 0]


def test_candidates_and_append(spark):
    items = spark.createDataFrame([(i,) for i in range(5)], "item long")
    seen = spark.createDataFrame([(1,), (3,)], "item long")
    c = rel.candidates(99, items, seen).collect()
    assert sorted(r.item for r in c) == [0, 2, 4] and {r.user for r in c} == {99}
    ratings = spark.createDataFrame([(1, 1, 3.0)], "user long, item long, rating double")
    out = rel.append_ratings(ratings, rel.next_user_id(ratings), seen).collect()
    assert sorted((r.user, r.item, r.rating) for r in out) == [(1, 1, 3.0), (2, 1, 5.0), (2, 3, 5.0)]


def test_popularity_counts_absent_as_zero(spark):
    df = spark.createDataFrame([(1, 10, 4.0), (2, 10, 2.0), (3, 11, 3.0)], "user long, item long, value double")
    got = {r.item: r.score for r in rel.popularity_baseline(df).collect()}
    assert got == {10: 2.0, 11: 1.0}


def test_indicator_resolution_and_checks(spark):
    assert rel.resolve_indicators("users") == "users"
    assert rel.resolve_indicators(True) == "both"
    with pytest.raises(ValueError):
        rel.resolve_indicators(0)
    vocab = spark.createDataFrame([("a",), ("b",)], "feature string")
    got = spark.createDataFrame([(1, "a"), (1, "b"), (1, "z")], "item long, feature string")
    assert sorted(r.feature for r in rel.align_features(got, vocab).collect()) == ["a", "b"]
    with pytest.raises(ValueError, match="missing"):
        rel.align_features(got.where(F.col("feature") != "b"), vocab)
    imap = spark.createDataFrame([(1, 0), (2, 1)], "item long, idx long")
    with pytest.raises(KeyError):
        rel.restrict_items(imap, spark.createDataFrame([(3,)], "item long"))
    labels = spark.createDataFrame([(1, "x")], "item long, title string")
    with pytest.raises(KeyError):
        rel.label(imap, labels, "item", strict=True)


def test_set_minus_and_dedup(spark):
    a = spark.createDataFrame([(1,), (2,), (2,), (3,)], "user long")
    b = spark.createDataFrame([(2,)], "user long")
    assert sorted(r.user for r in rel.set_minus(a, b).collect()) == [1, 3]
    assert rel.dedup(a).count() == 3
