"""Offline bandit summaries over logged feedback (SURVEY 2.14; the reference only
links to these topics, so the semantics are the textbook ones).

* ``arm_scores``: pulls, mean reward and the UCB1 index
  ``mean + sqrt(2 ln N / n_arm)`` per arm, N = all pulls (a lazy scalar subquery,
  no cross join);
* ``replay_fixed_policy``: replay evaluation of a deterministic policy -- keep the
  logged events whose arm equals the policy's arm for that user, report matches
  and mean reward.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def arm_scores(log: DataFrame, arm: str = "arm", reward: str = "reward") -> DataFrame:
    total = log.select(F.count(F.lit(1))).scalar()
    per_arm = log.groupBy(arm).agg(F.count(F.lit(1)).alias("pulls"), F.avg(reward).alias("mean_reward"))
    return per_arm.withColumn(
        "ucb", F.col("mean_reward") + F.sqrt(F.lit(2.0) * F.log(total.cast("double")) / F.col("pulls")))


def replay_fixed_policy(log: DataFrame, policy: DataFrame, user: str = "user", arm: str = "arm",
                        reward: str = "reward") -> DataFrame:
    """``policy``: one row per user with the arm the policy would play."""
    matched = log.join(policy.select(user, F.col(arm).alias("_chosen")), user).where(F.col(arm) == F.col("_chosen"))
    return matched.agg(F.count(F.lit(1)).alias("matched"), F.avg(reward).alias("mean_reward"))


def greedy_policy(log: DataFrame, user: str = "user", arm: str = "arm", reward: str = "reward") -> DataFrame:
    """Per user, the arm with the best mean logged reward (ties: smallest arm)."""
    means = log.groupBy(user, arm).agg(F.avg(reward).alias("_m"))
    return means.groupBy(user).agg(
        F.min_by(F.col(arm), F.struct(-F.col("_m"), F.col(arm))).alias(arm))
