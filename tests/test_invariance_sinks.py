import os
import tempfile

from pyspark.sql import functions as F

from tastebud.operators import blocks, split
from tastebud.sources import files


def _data(spark, parts):
    df = spark.range(3000).select((F.col("id") % 97).alias("user"), (F.col("id") * 31 % 211).alias("item"))
    return df.distinct().repartition(parts)


def test_splits_partition_invariant(spark):
    a = {tuple(r) for r in split.hash_split(_data(spark, 1), 0.3, 5).collect()}
    b = {tuple(r) for r in split.hash_split(_data(spark, 8), 0.3, 5).collect()}
    assert a == b
    ta = {tuple(r) for r in split.holdout_per_user(_data(spark, 1), 3, 0.5, 9)[1].collect()}
    tb = {tuple(r) for r in split.holdout_per_user(_data(spark, 8), 3, 0.5, 9)[1].collect()}
    assert ta == tb


def test_top_k_partition_and_block_invariant(spark):
    vec = F.array(*[F.sin(F.col("id") * (d + 1)) for d in range(4)])
    df = spark.range(300).select("id", vec.alias("vec"))
    runs = []
    for parts, rows in ((1, 10_000), (8, 37)):
        out = blocks.block_top_k(df.repartition(parts), df.repartition(parts), 5, left_key="id", right_key="id",
                                 metric="cosine", exclude_self=True, block_rows=rows)
        runs.append(sorted((r[0], r[1], r["rank"], round(r["score"], 9)) for r in out.collect()))
    assert runs[0] == runs[1]


def test_dataset_and_factor_round_trip(spark):
    root = tempfile.mkdtemp(prefix="ds-")
    train = spark.createDataFrame([(1, 2, 1.0)], "user long, item long, value double")
    test = spark.createDataFrame([(1, 3, 1.0)], "user long, item long, value double")
    files.write_recs(train, os.path.join(root, "train"))
    files.write_recs(test, os.path.join(root, "test"))
    ds = files.load_dataset(spark, root)
    assert set(ds) == {"train", "test"} and ds["test"].first().item == 3
    files.save_factors({"users": train}, os.path.join(root, "model"))
    back = files.load_factors(spark, os.path.join(root, "model"), ["users"])["users"]
    assert back.collect() == train.collect()
