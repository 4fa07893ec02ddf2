"""Bipartite k-core thresholding of an interaction table.

Keep the largest set of pairs in which every user has at least ``user_min``
distinct items and every item at least ``item_min`` distinct users.  Deletion
order does not change that fixed point.

The distinct pairs are written once and never rewritten.  What a round keeps is the degree
of each id still in, and the ids gone so far:

* the frontier is the ids whose degree is below the minimum;
* the pairs it takes along (a semi-join with the frontier, an anti-join with the other
  side's gone ids: AQE broadcasts these lists once they are measured small, so the pairs
  aren't shuffled) are counted per id of the other side and subtracted from its degrees;
* the two sides take turns until neither has a frontier.

So a round counts only the pairs it removes.  Once at most ``FINISH_PAIRS`` pairs are left,
bounded work, the rest is peeled in one task by the same rule; long chains, which take a
round per link, end there.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, drop_table, materialize

#: pairs peeled in one task: some 100 bytes of its memory each
FINISH_PAIRS = 1_000_000

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need numpy and pandas only


def peel(u: np.ndarray, i: np.ndarray, user_min: int, item_min: int) -> np.ndarray:
    """Which pairs of two code columns survive; each pair is looked at once when it goes."""
    alive = np.ones(len(u), bool)
    minimum = (user_min, item_min)
    codes = (u, i)
    order = [np.argsort(c, kind="stable") for c in codes]
    start = [np.concatenate([[0], np.cumsum(np.bincount(c))]) for c in codes]
    degree = [np.diff(s) for s in start]
    gone = [np.zeros(len(d), bool) for d in degree]
    front = [np.flatnonzero(d < m) for d, m in zip(degree, minimum)]
    while len(front[0]) or len(front[1]):
        for side in (0, 1):
            f, front[side] = front[side], np.zeros(0, np.int64)
            f = np.unique(f[~gone[side][f]])  # an id may have been found low from the start and again
            if not len(f):
                continue
            gone[side][f] = True
            size = degree_of = start[side][f + 1] - start[side][f]
            stop = np.cumsum(size)
            pairs = order[side][np.repeat(start[side][f] - (stop - degree_of), size) + np.arange(int(stop[-1]))]
            pairs = pairs[alive[pairs]]
            alive[pairs] = False
            other, lost = np.unique(codes[1 - side][pairs], return_counts=True)
            degree[1 - side][other] -= lost
            low = other[(degree[1 - side][other] < minimum[1 - side]) & ~gone[1 - side][other]]
            front[1 - side] = np.concatenate([front[1 - side], low])
    return alive


def _finish(pairs: DataFrame, user_min: int, item_min: int) -> DataFrame:
    user, item = pairs.columns

    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        keep = peel(pd.factorize(pdf[user])[0], pd.factorize(pdf[item])[0], user_min, item_min)
        return pdf.loc[keep, [user, item]]

    return pairs.withColumn("_one", F.lit("all")).groupBy("_one").applyInPandas(kernel, pairs.schema)


def _round(pairs: DataFrame, side: dict, other: dict) -> tuple[dict, dict, list[str]] | None:
    """Remove one side's frontier: both sides' new degrees and gone ids, and tables no longer needed."""
    key, far = side["key"], other["key"]
    low, low_path = materialize(side["degree"].where(F.col("n") < side["min"]).select(key))
    if low.isEmpty():
        drop_table(pairs.sparkSession, low_path)
        return None
    taken = pairs.join(low, key, "left_semi").join(other["gone"], far, "left_anti")
    lost = taken.groupBy(far).agg(F.count(F.lit(1)).alias("lost"))
    less, less_path = materialize(other["degree"].join(lost, far, "left").select(far, (F.col("n") - F.coalesce("lost", F.lit(0))).alias("n")))
    rest, rest_path = materialize(side["degree"].join(low, key, "left_anti"))
    gone, gone_path = materialize(side["gone"].unionByName(low))
    old = [low_path, side["degree_path"], other["degree_path"], side["gone_path"]]
    return ({**side, "degree": rest, "degree_path": rest_path, "gone": gone, "gone_path": gone_path},
            {**other, "degree": less, "degree_path": less_path}, old)


def kcore(df: DataFrame, user_min: int, item_min: int, user: str = "user", item: str = "item",
          finish_pairs: int = FINISH_PAIRS) -> DataFrame:
    """Rows of ``df`` whose (user, item) pair survives thresholding.

    ``user_min`` bounds the distinct items per user and ``item_min`` the distinct
    users per item (the documented meaning; duplicates are counted once).  Rows without
    user or item are no pairs and are dropped.
    """
    spark = df.sparkSession
    src = cut_lineage(df.where(F.col(user).isNotNull() & F.col(item).isNotNull()))
    pairs, pairs_path = materialize(src.select(user, item).distinct())
    start = left = pairs.count()
    written = [pairs_path]
    if left > finish_pairs:
        sides = []
        for key, least in ((user, user_min), (item, item_min)):
            degree, degree_path = materialize(pairs.groupBy(key).agg(F.count(F.lit(1)).alias("n")))
            gone, gone_path = materialize(pairs.select(key).where(F.lit(False)))
            sides.append({"key": key, "min": least, "degree": degree, "degree_path": degree_path, "gone": gone, "gone_path": gone_path})
        idle = turn = 0
        while idle < 2 and left > finish_pairs:
            done = _round(pairs, sides[turn], sides[1 - turn])
            if done is None:
                idle += 1
            else:
                idle = 0
                sides[turn], sides[1 - turn], old = done
                for path in old:
                    drop_table(spark, path)
                left = int(sides[1 - turn]["degree"].agg(F.sum("n")).first()[0] or 0)
            turn = 1 - turn
        written += [s[p] for s in sides for p in ("degree_path", "gone_path")]
        pairs = pairs.join(sides[0]["gone"], user, "left_anti").join(sides[1]["gone"], item, "left_anti")
    if left <= finish_pairs:
        pairs, path = materialize(_finish(pairs, user_min, item_min))
        written.append(path)
        left = pairs.count()
    # durable result, independent of the tables released here
    result = src if left == start else cut_lineage(src.join(pairs, [user, item], "left_semi"))
    for path in written:
        drop_table(spark, path)
    return result
