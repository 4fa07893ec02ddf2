import pytest
from pyspark.sql import functions as F

from planted import planted
from tastebud.operators import als, evaluate as ev, rank_mf
from tastebud.operators import relational as rel
from tastebud.operators.split import holdout_per_user


@pytest.fixture(scope="module")
def planted_split(spark):
    likes = planted(spark).cache()
    train, test, _ = holdout_per_user(likes, 2, None, 42)
    return train.cache(), test.cache()


def _auc(model, train, test):
    uf, itf = model.scoring_factors()
    return ev.auc_per_user(uf, itf, test, train).agg(F.avg("auc")).first()[0]


def test_bpr_learns_planted_groups(spark, planted_split):
    train, test = planted_split
    m = rank_mf.fit_rank_mf(train, loss="bpr", dim=32, epochs=12, learning_rate=0.05, seed=1)
    auc = _auc(m, train, test)
    # popularity is flat on this data (AUC ~0.5): the model must find the groups
    pop = rel.popularity_baseline(train.withColumn("value", F.lit(1.0)))
    pop_f = pop.select(F.col("item").alias("id"), F.array(F.col("score")).alias("vec"))
    users = train.select(F.col("user").alias("id")).distinct().withColumn("vec", F.array(F.lit(1.0)))
    pop_auc = ev.auc_per_user(users, pop_f, test, train).agg(F.avg("auc")).first()[0]
    assert auc > 0.8 and auc > pop_auc + 0.2


def test_resume_zero_epochs_and_item_bias(spark, planted_split):
    train, _ = planted_split
    m = rank_mf.init_rank_mf(train, 8, 3, loss="bpr", learning_rate=0.05, item_alpha=0.0, user_alpha=0.0,
                             max_sampled=1, batches=1)
    same = rank_mf.resume(m, train, 0)
    assert same.epochs_done == 0 and same.item_state is m.item_state
    zero = rank_mf.drop_item_bias(rank_mf.resume(m, train, 1))
    assert zero.item_state.agg(F.max(F.abs("bias"))).first()[0] == 0.0


def test_validate_setup():
    with pytest.raises(ValueError):
        rank_mf.validate_setup("none", None, None)
    with pytest.raises(ValueError):
        rank_mf.validate_setup("users", object(), None)
    rank_mf.validate_setup("both", None, None)


def test_score_batch_cases(spark, planted_split):
    train, _ = planted_split
    uf = train.select("user").distinct().select("user", F.concat(F.lit("g"), (F.col("user") % 4).cast("string"))
                                                .alias("feature"), F.lit(1.0).alias("weight"))
    m = rank_mf.fit_rank_mf(train, loss="bpr", dim=8, epochs=1, seed=2, user_features=uf, indicators="both")
    req = spark.createDataFrame([(0, 0), (0, 5), (1000, 3)], "user long, item long")
    new_feats = spark.createDataFrame([(1000, "g1", 1.0)], "user long, feature string, weight double")
    got = rank_mf.score_batch(m, req, user_features=new_feats).collect()
    assert sorted((r.user, r.item) for r in got) == [(0, 0), (0, 5), (1000, 3)]
    # unknown user without features: error, or the baseline when asked
    with pytest.raises(ValueError):
        rank_mf.score_batch(m, req)
    base = spark.createDataFrame([(3, 0.7)], "item long, score double")
    got = {(r.user, r.item): r.score for r in rank_mf.score_batch(m, req, use_baseline=True, baseline=base).collect()}
    assert got[(1000, 3)] == 0.7 and (0, 0) in got
    # model without user features rejects passed features; items must be known
    plain = rank_mf.fit_rank_mf(train, loss="bpr", dim=8, epochs=1, seed=2)
    with pytest.raises(ValueError):
        rank_mf.score_batch(plain, req, user_features=new_feats)
    with pytest.raises(KeyError):
        rank_mf.score_batch(plain, spark.createDataFrame([(0, 99999)], "user long, item long"))
    # model with user features but only item indicators: known users need features
    m2 = rank_mf.fit_rank_mf(train, loss="bpr", dim=8, epochs=1, seed=2, user_features=uf,
                             item_features=train.select("item").distinct().select(
                                 "item", F.lit("all").alias("feature"), F.lit(1.0).alias("weight")),
                             indicators="items")
    with pytest.raises(ValueError):
        rank_mf.score_batch(m2, spark.createDataFrame([(0, 0)], "user long, item long"))


def test_als_wide_ids_and_pseudo_user(spark):
    rows = [(2 ** 35 + u, 10 + (u * 7 + k) % 30, float(1 + (u + k) % 5)) for u in range(40) for k in range(8)]
    ratings = spark.createDataFrame(rows, "user long, item long, rating double")
    fit = als.fit_als(ratings, rank=4, reg=0.1, iters=5, seed=1)
    assert fit.user_map is not None and fit.item_map is None
    recs = als.recommend_all_users(fit, 3)
    assert recs.count() == 120 and recs.agg(F.min("user")).first()[0] >= 2 ** 35
    items = spark.createDataFrame([(i, f"title {i}", "g") for i in range(10, 40)], "item long, title string, genres string")
    liked = spark.createDataFrame([(11,), (12,)], "item long")
    for mode in ("refit", "fold_in"):
        out = als.recommend_for_liked(ratings, items, liked, 5, rank=4, reg=0.1, iters=5, mode=mode).collect()
        assert len(out) == 5 and not {r.item for r in out} & {11, 12}
        assert {r.user for r in out} == {2 ** 35 + 40}
    assert als.recommend_by_title(ratings, items, "no such", 5, rank=4, iters=2).count() == 0


def test_hybrid_beats_cf_on_cold_items(spark):
    from planted import GROUPS, ITEMS_PER
    likes = planted(spark, seed=11).cache()
    cold = F.col("item") % 5 == 0
    # cold items keep one training like (their smallest user); the rest of their likes are test
    first = likes.where(cold).groupBy("item").agg(F.min("user").alias("user"))
    test = likes.where(cold).join(first, ["item", "user"], "left_anti")
    train = likes.join(test, ["user", "item"], "left_anti").cache()
    items = spark.range(GROUPS * ITEMS_PER).withColumnRenamed("id", "item")
    feats = items.select("item", F.concat(F.lit("group_"), (F.col("item") / ITEMS_PER).cast("int").cast("string"))
                         .alias("feature"), F.lit(1.0).alias("weight"))
    kw = dict(loss="bpr", dim=16, epochs=12, learning_rate=0.05, seed=3, items=items)
    cf = rank_mf.fit_rank_mf(train, **kw)
    hybrid = rank_mf.fit_rank_mf(train, item_features=feats, indicators="both", **kw)
    cf_auc, hy_auc = _auc(cf, train, test), _auc(hybrid, train, test)
    assert hy_auc > cf_auc and hy_auc > 0.75


def test_als_subsets_and_tuning(spark):
    rows = [(u, (u * 7 + k) % 25, float(1 + (u + k) % 5)) for u in range(30) for k in range(6)]
    ratings = spark.createDataFrame(rows, "user long, item long, rating double")
    fit = als.fit_als(ratings, rank=3, reg=0.1, iters=3, seed=1)
    items = spark.createDataFrame([(i, f"t{i}", "g") for i in range(25)], "item long, title string, genres string")
    recs = als.recommend_users(fit, spark.createDataFrame([(1,), (2,)], "user long"), 4, items)
    assert recs.select("user").distinct().count() == 2 and "title" in recs.columns
    by_item = als.recommend_all_items(fit, 2)
    assert by_item.groupBy("item").count().agg(F.max("count")).first()[0] == 2
    sub = als.recommend_for_items(fit, items.where("item < 3"), 5)
    assert {r.item for r in sub.collect()} == {0, 1, 2}
    grid = als.tune_als(ratings, [2, 3], [0.1], iters=2, seed=1)
    rows = grid.collect()
    assert len(rows) == 2 and sum(r.best for r in rows) == 1
    best = [r for r in rows if r.best][0]
    assert best.validation_rmse == min(r.validation_rmse for r in rows) and best.test_rmse is not None


def test_minibatches_and_sample_weights(spark, planted_split):
    train, test = planted_split
    weighted = train.withColumn("w", F.when(F.col("item") % 2 == 0, 2.0).otherwise(1.0))
    m = rank_mf.fit_rank_mf(weighted, loss="warp", dim=16, epochs=6, learning_rate=0.05, seed=4, batches=3,
                            sample_weight="w")
    assert m.epochs_done == 6
    assert _auc(m, train, test) > 0.65


def test_als_beats_global_mean_on_planted_ratings(spark):
    from planted import GROUPS, ITEMS_PER
    likes = planted(spark, seed=5, noise=0.3)
    ratings = likes.select("user", "item", F.when((F.col("item") / ITEMS_PER).cast("int") == F.col("user") % GROUPS, 5.0)
                           .otherwise(1.0).alias("rating"))
    from tastebud.operators.split import hash_split
    tagged = hash_split(ratings, 0.2, 1)
    train = tagged.where("split = 'train'").drop("split")
    test = tagged.where("split = 'test'").drop("split")
    fit = als.fit_als(train, rank=8, reg=0.1, iters=10, seed=1)
    model_rmse = als.als_rmse(fit, test).first()["rmse"]
    mean = train.agg(F.avg("rating")).first()[0]
    base = test.agg(F.sqrt(F.avg(F.pow(F.col("rating") - F.lit(mean), 2)))).first()[0]
    assert model_rmse < 0.8 * base


def test_logistic_learns_planted_groups(spark, planted_split):
    train, test = planted_split
    m = rank_mf.fit_rank_mf(train, loss="logistic", dim=32, epochs=12, learning_rate=0.05, seed=1)
    assert _auc(m, train, test) > 0.75


def test_tune_als_parallel_matches_sequential(spark):
    rows = [(u, (u * 7 + k) % 25, float(1 + (u + k) % 5)) for u in range(30) for k in range(6)]
    ratings = spark.createDataFrame(rows, "user long, item long, rating double")
    seq = sorted(tuple(r) for r in als.tune_als(ratings, [2, 3], [0.1, 0.3], iters=2, seed=1).collect())
    par = sorted(tuple(r) for r in als.tune_als(ratings, [2, 3], [0.1, 0.3], iters=2, seed=1, parallel=4).collect())
    assert seq == par


def test_random_search_parallel_matches_sequential(spark, planted_split):
    from tastebud.operators import tune
    train, test = planted_split
    space = [("epochs", 1, 2, False), ("learning_rate", 1e-2, 1e-1, True), ("dim", 4, 8, False),
             ("alpha", 1e-6, 1e-3, True)]
    seq = sorted(tuple(r) for r in tune.random_search(train, test, 2, 3, 5, "bpr", space).collect())
    par = sorted(tuple(r) for r in tune.random_search(train, test, 2, 3, 5, "bpr", space, parallel=2).collect())
    assert seq == par and sum(r[-1] for r in seq) == 1


def test_als_queries_read_their_ratings_from_one_table(spark):
    """The interactions are joined and grouped once, not once per pass of a fit."""
    from conftest import SF
    from tastebud.plans import flagship
    for df in (flagship._ratings(spark, SF), flagship._split(spark, SF)[0]):
        assert "Join" not in df._jdf.queryExecution().optimizedPlan().toString()
