"""Train / test splits.

All draws are md5 of (seed, key): stable across retries, repartitioning and
engines, so a lost executor recomputes exactly the same split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import hex_threshold, md5_key
from ..session import cut_lineage
from .encode import index_by_order


def random_split(df: DataFrame, weights: list[float], seed: int | None = None) -> list[DataFrame]:
    """Bernoulli row split (Spark ``randomSplit``, as the reference)."""
    return df.randomSplit(weights, seed)


def hash_split(df: DataFrame, test_fraction: float, seed: int = 42, keys: tuple[str, ...] = ("user", "item"),
               col: str = "split") -> DataFrame:
    """Tag each row ``train`` / ``test``: test when the first 8 hex digits of
    md5(seed|keys) fall below ``test_fraction`` of the hex range."""
    bound = hex_threshold(test_fraction)
    h = F.substring(md5_key(seed, *keys), 1, 8)
    return df.withColumn(col, F.when(h < F.lit(bound), F.lit("test")).otherwise(F.lit("train")))


def hash_split3(df: DataFrame, fractions: tuple[float, float, float], seed: int = 42,
                keys: tuple[str, ...] = ("user", "item"), col: str = "split") -> DataFrame:
    """Three-way md5 split into train / validation / test (e.g. 0.6 / 0.2 / 0.2)."""
    a, b, _ = fractions
    lo, hi = hex_threshold(a), hex_threshold(a + b)
    h = F.substring(md5_key(seed, *keys), 1, 8)
    return df.withColumn(col, F.when(h < F.lit(lo), "train").when(h < F.lit(hi), "validation")
                         .otherwise("test"))


def holdout_per_user(df: DataFrame, n: int, fraction: float | None = None, seed: int = 42,
                     user: str = "user", item: str = "item") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Move exactly ``n`` items of each chosen user to test.

    With ``fraction``: floor(fraction * all users) users are chosen, lowest
    md5(seed|user) first, among users with at least 2n items; too few eligible users
    is an error.  Without: every user, and a user with fewer than ``n`` items is an
    error.  The test items of a user are its ``n`` lowest md5(seed|user|item).

    Returns ``(train, test, test_users)``.
    """
    df = cut_lineage(df)  # counted, ranked and split from one table
    pairs = df.select(user, item).distinct()
    counts = pairs.groupBy(user).agg(F.count(F.lit(1)).alias("_c"))
    if fraction:
        n_users, n_eligible = counts.agg(
            F.count(F.lit(1)), F.sum(F.when(F.col("_c") >= 2 * n, 1).otherwise(0))).first()
        k = int(fraction * n_users)
        eligible = counts.where(F.col("_c") >= 2 * n).select(user)
        if (n_eligible or 0) < k:
            raise ValueError(f"not enough users with >= {2 * n} interactions for fraction {fraction}")
        ranked = index_by_order(eligible.withColumn("_h", md5_key(seed, user)), ["_h", user], "_pos")
        chosen = ranked.where(F.col("_pos") < k).select(user)
    else:
        short = counts.where(F.col("_c") < n).limit(1).count()
        if short:
            raise ValueError(f"a user has fewer than {n} interactions")
        chosen = counts.select(user)
    w = Window.partitionBy(user).orderBy(md5_key(seed, user, item), F.col(item))
    test_pairs = (pairs.join(chosen, user, "left_semi")
                  .withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n)
                  .select(user, item))
    test = df.join(test_pairs, [user, item], "left_semi")
    train = df.join(test_pairs, [user, item], "left_anti")
    return train, test, chosen


def assert_disjoint(train: DataFrame, test: DataFrame, keys: tuple[str, ...] = ("user", "item")) -> None:
    if not train.select(*keys).join(test.select(*keys), list(keys), "left_semi").isEmpty():
        raise AssertionError("train and test share pairs")


def eval_train(train: DataFrame, test_users: DataFrame, user: str = "user") -> DataFrame:
    """Training rows of evaluated users only (for train-side metrics)."""
    return train.join(test_users.select(user), user, "left_semi")
