"""Blocks of a fit are bounded in ratings, and tuning keeps no split in the executors' memory."""
from pyspark.sql import functions as F

from tastebud.operators import als


def _ratings(spark):
    return spark.range(400).select((F.col("id") % 23).cast("int").alias("user"), (F.col("id") * 7 % 31).cast("int").alias("item"), (F.col("id") % 5 + 1).cast("double").alias("rating"))


def test_blocks_grow_with_the_ratings(spark, monkeypatch):
    assert als.blocks_for(0) == als.blocks_for(36_000_000) == als.LEAST_BLOCKS  # as MLlib has them
    assert als.blocks_for(216_000_000) == 24
    found, estimator = [], als.als_estimator
    monkeypatch.setattr(als, "als_estimator", lambda *a, **kw: found.append(estimator(*a, **kw)) or found[-1])
    monkeypatch.setattr(als, "RATINGS_PER_BLOCK", 30)
    fit = als.fit_als(_ratings(spark), rank=3, iters=2)
    assert (found[0].getNumUserBlocks(), found[0].getNumItemBlocks()) == (14, 14)
    assert fit.model.userFactors.count() == 23 and fit.model.itemFactors.count() == 31


def test_tuning_caches_no_split(spark, monkeypatch):
    seen, fit = [], als.fit_als
    monkeypatch.setattr(als, "fit_als", lambda ratings, *a, **kw: seen.append(ratings.storageLevel) or fit(ratings, *a, **kw))
    out = als.tune_als(_ratings(spark), [2, 3], [0.1], iters=1)
    assert out.count() == 2 and [(s.useMemory, s.useDisk) for s in seen] == [(False, False)] * 2
