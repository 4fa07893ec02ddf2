"""Planted-signal interaction tables for model tests (FIXTURES §3), generated by hashes."""
from pyspark.sql import functions as F

GROUPS, USERS_PER, ITEMS_PER, LIKES_PER_USER = 4, 50, 50, 12


def planted(spark, seed: int = 7, noise: float = 0.1):
    """``user, item`` likes: user u in group u % G likes mostly items of its own group."""
    n_users, n_items = GROUPS * USERS_PER, GROUPS * ITEMS_PER
    u = spark.range(n_users).withColumnRenamed("id", "user")
    draws = u.select("user", F.explode(F.sequence(F.lit(0), F.lit(LIKES_PER_USER - 1))).alias("k"))
    h = F.xxhash64(F.lit(seed), "user", "k")
    own = (F.pmod(h, F.lit(1000)) >= int(noise * 1000))
    grp = F.when(own, F.col("user") % GROUPS).otherwise(F.pmod(F.xxhash64(F.lit(seed + 1), "user", "k"), F.lit(GROUPS)))
    pick = F.pmod(F.xxhash64(F.lit(seed + 2), "user", "k"), F.lit(ITEMS_PER))
    likes = draws.select("user", (grp * ITEMS_PER + pick).cast("long").alias("item")).distinct()
    return likes
