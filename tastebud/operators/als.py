"""Explicit ALS and the recommendation queries built on it.

Training is MLlib's blocked ALS.  Around it:

* ids outside 32-bit range go through ``index_ids`` first (MLlib casts ids to INT
  and fails on overflow); the maps are kept and applied on the way out;
* every function is pure: a pseudo-user is appended to a *copy* of the ratings
  for one fit and never leaks into the next call;
* recommendations rank the factor tables with the blocked kernel (an equi-shuffle, where
  MLlib's own recommend calls plan a cartesian product of factor blocks) and are joined to
  titles by key, never zipped by position.
"""

from __future__ import annotations

import math
import sys
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import dot
from ..session import drop_table, ensure_checkpoint_dir, materialize
from ..sources import store
from . import relational as rel
from .blocks import block_top_k
from .encode import index_ids
from .split import hash_split3, random_split

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need numpy and pyarrow only

#: MLlib's own number of blocks, and the most ratings of a block: one task builds a block in memory
LEAST_BLOCKS, RATINGS_PER_BLOCK = 10, 9_000_000
INT_MIN, INT_MAX = -(2 ** 31), 2 ** 31 - 1


@dataclass
class AlsFit:
    model: ALSModel
    user_map: DataFrame | None  # user, idx   (None: ids used as-is)
    item_map: DataFrame | None  # item, idx

    # ---- id translation
    def to_model_ids(self, df: DataFrame, user: str | None = "user", item: str | None = "item") -> DataFrame:
        out = df
        if user and self.user_map is not None:
            out = out.join(self.user_map, user).drop(user).withColumnRenamed("idx", user)
        elif user:
            out = out.withColumn(user, F.col(user).try_cast("int")).where(F.col(user).isNotNull())
        if item and self.item_map is not None:
            out = out.join(self.item_map, item).drop(item).withColumnRenamed("idx", item)
        elif item:
            out = out.withColumn(item, F.col(item).try_cast("int")).where(F.col(item).isNotNull())
        return out

    def from_model_ids(self, df: DataFrame, user: str | None = "user", item: str | None = "item") -> DataFrame:
        out = df
        if user and self.user_map is not None:
            out = (out.withColumnRenamed(user, "_ui")
                   .join(self.user_map.withColumnRenamed("idx", "_ui"), "_ui").drop("_ui"))
        if item and self.item_map is not None:
            out = (out.withColumnRenamed(item, "_ii")
                   .join(self.item_map.withColumnRenamed("idx", "_ii"), "_ii").drop("_ii"))
        return out


def _need_maps(df: DataFrame, *cols: str) -> dict[str, bool]:
    """Which id columns don't fit MLlib's INT ids: none of INT type, all that aren't integers,
    BIGINT ones by their range (one pass over the data for all of them, if any)."""
    types = dict(df.dtypes)
    wide = [c for c in cols if types[c] == "bigint"]
    out = {c: types[c] not in ("int", "smallint", "tinyint", "bigint") for c in cols}
    if wide:
        span = df.agg(*[f(c).alias(f"{n}_{c}") for c in wide for n, f in (("lo", F.min), ("hi", F.max))]).first()
        for c in wide:
            lo, hi = span[f"lo_{c}"], span[f"hi_{c}"]
            out[c] = lo is not None and (lo < INT_MIN or hi > INT_MAX)
    return out


def blocks_for(n_ratings: int) -> int:
    """Number of MLlib's user and of its item blocks.  More blocks send a factor to more places, so there
    are no more than bound a block's ratings."""
    return max(LEAST_BLOCKS, math.ceil(n_ratings / RATINGS_PER_BLOCK))


def als_estimator(rank: int = 10, reg: float = 0.1, iters: int = 10, seed: int = 42,
                  implicit: bool = False, alpha: float = 1.0, nonnegative: bool = False,
                  cold_start: str = "drop", checkpoint_interval: int = 5, blocks: int = LEAST_BLOCKS) -> ALS:
    return ALS(numUserBlocks=blocks, numItemBlocks=blocks, rank=rank, regParam=reg, maxIter=iters, seed=seed, implicitPrefs=implicit, alpha=alpha,
               nonnegative=nonnegative, userCol="user", itemCol="item", ratingCol="rating",
               coldStartStrategy=cold_start, checkpointInterval=checkpoint_interval)


def fit_als(ratings: DataFrame, rank: int = 10, reg: float = 0.1, iters: int = 10, seed: int = 42,
            user: str = "user", item: str = "item", rating: str = "rating", **kw) -> AlsFit:
    """Fit explicit ALS on ``user, item, rating`` rows (columns renamed as needed)."""
    ensure_checkpoint_dir(ratings.sparkSession)
    df = ratings.select(F.col(user).alias("user"), F.col(item).alias("item"),
                        F.col(rating).cast("float").alias("rating"))
    need = _need_maps(df, "user", "item")
    umap = index_ids(df, "user") if need["user"] else None
    imap = index_ids(df, "item") if need["item"] else None
    shell = AlsFit(None, umap, imap)  # type: ignore[arg-type]
    train = shell.to_model_ids(df)
    kw.setdefault("blocks", blocks_for(df.count()))
    model = als_estimator(rank, reg, iters, seed, **kw).fit(train)
    return AlsFit(model, umap, imap)


def score_als(fit: AlsFit, pairs: DataFrame, user: str = "user", item: str = "item") -> DataFrame:
    """Predicted rating per (user, item); pairs with a cold user or item are dropped."""
    mapped = fit.to_model_ids(pairs.withColumnRenamed(user, "user").withColumnRenamed(item, "item"))
    pred = fit.model.transform(mapped).where(~F.isnan("prediction"))
    return fit.from_model_ids(pred)


def als_factors(fit: AlsFit, kind: str = "array<double>") -> tuple[DataFrame, DataFrame]:
    """Factor tables as ``id, vec`` in the caller's id space; MLlib's own factors are floats."""
    uf = fit.model.userFactors.select(F.col("id").alias("user"),
                                      F.col("features").cast(kind).alias("vec"))
    itf = fit.model.itemFactors.select(F.col("id").alias("item"),
                                       F.col("features").cast(kind).alias("vec"))
    uf = fit.from_model_ids(uf, user="user", item=None).withColumnRenamed("user", "id")
    itf = fit.from_model_ids(itf, user=None, item="item").withColumnRenamed("item", "id")
    return uf, itf


def als_rmse(fit: AlsFit, test: DataFrame, rating: str = "rating") -> DataFrame:
    pred = score_als(fit, test)
    return pred.agg(F.sqrt(F.avg(F.pow(F.col(rating) - F.col("prediction"), 2))).alias("rmse"),
                    F.count(F.lit(1)).alias("n"))


def _ranked(left: DataFrame, right: DataFrame, n: int, out_left: str, out_right: str) -> DataFrame:
    """Top ``n`` of ``right`` per row of ``left`` (``id, vec`` factors) through the blocked kernel."""
    return block_top_k(left, right, n, left_key="id", right_key="id", out_left=out_left, out_right=out_right, score_col="rating")


def recommend_all_users(fit: AlsFit, n: int = 10) -> DataFrame:
    """Top ``n`` items per user (seen items not removed): ``user, item, rating, rank``."""
    uf, itf = als_factors(fit, "array<float>")
    return _ranked(uf, itf, n, "user", "item")


def recommend_all_items(fit: AlsFit, n: int = 10) -> DataFrame:
    """Top ``n`` users per item: ``item, user, rating, rank``."""
    uf, itf = als_factors(fit, "array<float>")
    return _ranked(itf, uf, n, "item", "user")


def recommend_users(fit: AlsFit, users: DataFrame, n: int = 10, items: DataFrame | None = None) -> DataFrame:
    """Top ``n`` items for a subset of users, optionally with catalogue columns attached."""
    uf, itf = als_factors(fit, "array<float>")
    out = _ranked(uf.join(users.select(F.col("user").alias("id")), "id", "left_semi"), itf, n, "user", "item")
    return rel.enrich_with_items(out, items) if items is not None else out


def recommend_for_items(fit: AlsFit, items: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` users for a subset of items (e.g. the result of a title search)."""
    uf, itf = als_factors(fit, "array<float>")
    return _ranked(itf.join(items.select(F.col("item").alias("id")), "id", "left_semi"), uf, n, "item", "user")


# ---------------------------------------------------------------- saved fits

def save_fit(fit: AlsFit, path: str) -> None:
    """Write model and id maps as a new version below ``path``."""
    maps = {n: df for n, df in (("user_map", fit.user_map), ("item_map", fit.item_map)) if df is not None}

    def write(folder: str) -> None:
        fit.model.write().save(f"{folder}/model")
        for name, df in maps.items():
            df.write.parquet(f"{folder}/{name}")

    store.save(fit.model.userFactors.sparkSession, path, write, {"maps": sorted(maps)})


def load_fit(spark, path: str) -> AlsFit:
    """The fit last saved to ``path``."""
    folder, about = store.load(spark, path)
    maps = {n: spark.read.parquet(f"{folder}/{n}") if n in about["maps"] else None for n in ("user_map", "item_map")}
    return AlsFit(ALSModel.load(f"{folder}/model"), maps["user_map"], maps["item_map"])


# ---------------------------------------------------------------- tuning (2.10-3/4)

def train_als(ratings: DataFrame, rank: int = 20, reg: float = 0.05, iters: int = 10, seed: int = 42,
              fractions: tuple[float, float, float] = (0.6, 0.2, 0.2), hashed: bool = True) -> tuple[AlsFit, DataFrame]:
    """Fit on the training share and report validation RMSE (one-row DataFrame)."""
    train, val, _ = _three_way(ratings, fractions, seed, hashed)
    fit = fit_als(train, rank, reg, iters, seed)
    return fit, als_rmse(fit, val)


def _three_way(ratings, fractions, seed, hashed):
    if hashed:
        tagged = hash_split3(ratings, fractions, seed)
        return tuple(tagged.where(F.col("split") == s).drop("split") for s in ("train", "validation", "test"))
    return tuple(random_split(ratings, list(fractions), seed))


def tune_als(ratings: DataFrame, ranks: list[int], regs: list[float], iters: int = 10, seed: int = 42,
             fractions: tuple[float, float, float] = (0.6, 0.2, 0.2), hashed: bool = True,
             parallel: int = 1) -> DataFrame:
    """Exhaustive rank x reg grid; one row per trial with validation RMSE, the winner
    (lowest validation RMSE, first in grid order on ties) also scored on test.

    Splits are written once for the grid (cached, they would take the memory that blocks are built in); estimator and model stay separate objects, so
    every trial starts from a fresh estimator (the reference reused the model).
    ``parallel`` > 1 submits that many trials as concurrent Spark jobs (results are
    the same; the reference runs them one after another).
    """
    spark = ratings.sparkSession
    ensure_checkpoint_dir(spark)
    kept = [materialize(d) for d in _three_way(ratings, fractions, seed, hashed)]
    train, val, test = (d for d, _ in kept)
    grid = [(rank, float(reg)) for rank in ranks for reg in regs]

    def trial(point):
        rank, reg = point
        fit = fit_als(train, rank, reg, iters, seed)
        return rank, reg, float(als_rmse(fit, val).first()["rmse"]), fit

    try:
        if parallel > 1:
            with ThreadPoolExecutor(max_workers=parallel) as pool:
                results = list(pool.map(trial, grid))
        else:
            results = [trial(point) for point in grid]
        best = min(range(len(results)), key=lambda i: (results[i][2], i))
        b_rank, b_reg, _, b_fit = results[best]
        test_err = float(als_rmse(b_fit, test).first()["rmse"])
        rows = [(r, g, e, i == best, test_err if i == best else None) for i, (r, g, e, _) in enumerate(results)]
        return spark.createDataFrame(rows, "rank int, reg double, validation_rmse double, best boolean, test_rmse double")
    finally:
        for _, path in kept:
            drop_table(spark, path)


# ---------------------------------------------------------------- pseudo-user queries (2.10-5, 2.11-5/6)

def fold_in_user(item_factors: DataFrame, liked: DataFrame, rating: float, reg: float) -> list[float] | None:
    """Factor of a new user who gave ``rating`` to ``liked`` items, with item factors held
    fixed: solve (Y'Y + reg * n I) x = Y' r (MLlib's explicit ALS-WR normal equations).
    Only rank x rank numbers reach the driver.  No liked item with factors: None."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    y = item_factors.join(liked.select(F.col("item").alias("id")), "id")
    k = len(y.select("vec").first()[0]) if not y.isEmpty() else 0
    if k == 0:
        return None
    outer = F.flatten(F.transform("vec", lambda a: F.transform("vec", lambda b: a * b)))
    agg = y.agg(vector_to_array(Summarizer.sum(array_to_vector(outer))).alias("yty"),
                vector_to_array(Summarizer.sum(array_to_vector(F.transform("vec", lambda a: a * rating)))).alias("ytr"),
                F.count(F.lit(1)).alias("n")).first()
    yty = np.array(agg["yty"]).reshape(k, k)
    x = np.linalg.solve(yty + reg * agg["n"] * np.eye(k), np.array(agg["ytr"]))
    return [float(v) for v in x]


def fold_in_users(item_factors: DataFrame, liked: DataFrame, reg: float) -> DataFrame:
    """Factors of many new users at once, item factors (``id, vec``) held fixed: ``user, vec, n``.

    ``liked`` is ``user, item, rating``.  Each user's normal equations ``(Y'Y + reg n I) x = Y' r`` are
    summed and solved where its rows meet.  A user with few rows in a batch sends them as they are (rank
    numbers each); one with more than the rank / 2 rows that outweigh the sum sends the sum
    (rank * (rank + 3) / 2 numbers), so one with a third of all rows sends one sum a batch.  Rows are
    sorted by user and added as they stream by: a task holds one user's sum and a batch.  Users none of
    whose items has a factor get no row.
    """
    rows = liked.select("user", "item", F.col("rating").cast("double").alias("rating")).join(
        item_factors.select(F.col("id").alias("item"), F.col("vec").cast("array<double>").alias("vec")), "item").select("user", "rating", "vec")
    kind = dict(rows.dtypes)["user"]
    parts = rows.mapInArrow(_normal_parts, f"user {kind}, n long, s array<double>")
    return parts.repartition("user").sortWithinPartitions("user").mapInArrow(lambda it: _solved(it, reg), f"user {kind}, vec array<double>, n long")


def _runs(values) -> tuple[np.ndarray, np.ndarray]:
    """Codes of an Arrow column's values (null has its own) and where runs of equal ones start."""
    if hasattr(values, "combine_chunks"):
        values = values.combine_chunks()
    codes = values.dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
    return codes, np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))


def _lists(rows: list):
    import pyarrow as pa
    cuts = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(rows)))


def _normal_parts(batches):
    """``user, n, s`` of a batch: a row's factors and rating (n = 0), or of a user with many rows their number n
    and the upper triangle of Y'Y followed by Y'r."""
    import pyarrow as pa
    for batch in batches:
        if not batch.num_rows:
            continue
        codes, _ = _runs(batch.column(0))
        r = batch.column(1).to_numpy(zero_copy_only=False)
        y = np.asarray(batch.column(2).flatten()).reshape(batch.num_rows, -1)
        i, j = np.triu_indices(y.shape[1])
        many = np.bincount(codes)[codes] > (y.shape[1] + 3) // 2
        rows = np.flatnonzero(~many)
        if len(rows):
            flat = np.column_stack([y[rows], r[rows]])
            cuts = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * flat.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(np.zeros(len(rows), np.int64)), pa.ListArray.from_arrays(cuts, pa.array(flat.ravel()))], names=["user", "n", "s"])
        rows = np.flatnonzero(many)
        if len(rows):
            rows = rows[np.argsort(codes[rows], kind="stable")]
            cuts = np.append(np.flatnonzero(np.append(True, codes[rows][1:] != codes[rows][:-1])), len(rows))
            sums = []
            for a, b in zip(cuts, cuts[1:]):
                own, given = y[rows[a:b]], r[rows[a:b]]
                sums.append(np.concatenate([(own.T @ own)[i, j], own.T @ given]))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows[cuts[:-1]])), pa.array(np.diff(cuts).astype(np.int64)), _lists(sums)], names=["user", "n", "s"])


def _solved(batches, reg: float):
    """Solutions of the normal equations of users whose parts (``_normal_parts``) come one user after another."""
    import pyarrow as pa
    last, n, a, b = None, 0, None, None  # of the user whose rows may go on in the next batch
    users, ns, lefts, rights = [], [], [], []

    def solve():
        m = np.array(ns, np.int64)
        k = len(rights[0])
        low = np.linalg.cholesky(np.array(lefts) + reg * m[:, None, None] * np.eye(k))
        x = np.linalg.solve(low.transpose(0, 2, 1), np.linalg.solve(low, np.array(rights)[:, :, None]))[..., 0]
        out = pa.RecordBatch.from_arrays([pa.concat_arrays(users), _lists(list(x)), pa.array(m)], names=["user", "vec", "n"])
        for kept in (users, ns, lefts, rights):
            kept.clear()
        return out

    for batch in batches:
        if not batch.num_rows:
            continue
        who, sizes, s = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False), batch.column(2)
        at, values = s.offsets.to_numpy(), s.values.to_numpy(zero_copy_only=False)
        _, starts = _runs(who)
        for u, v in zip(starts, np.append(starts[1:], len(who))):
            if last is None or who[u].as_py() != last.as_py():
                if last is not None:
                    users.append(pa.array([last.as_py()], last.type))
                    ns.append(n), lefts.append(a), rights.append(b)
                    if len(ns) == 256:
                        yield solve()
                last, n, a, b = who[u], 0, 0.0, 0.0
            raw = u + np.flatnonzero(sizes[u:v] == 0)
            if len(raw):
                width = at[raw[0] + 1] - at[raw[0]]
                own = values[at[raw][:, None] + np.arange(width)]
                n, a, b = n + len(raw), a + own[:, :-1].T @ own[:, :-1], b + own[:, :-1].T @ own[:, -1]
            for x in u + np.flatnonzero(sizes[u:v] > 0):
                part = values[at[x]:at[x + 1]]
                k = (math.isqrt(9 + 8 * len(part)) - 3) // 2  # k (k + 3) / 2 numbers
                i, j = np.triu_indices(k)
                full = np.zeros((k, k))
                full[i, j] = full[j, i] = part[:len(i)]
                n, a, b = n + int(sizes[x]), a + full, b + part[len(i):]
    if last is not None:
        users.append(pa.array([last.as_py()], last.type))
        ns.append(n), lefts.append(a), rights.append(b)
        yield solve()


def recommend_for_requests(fit: AlsFit, requests: DataFrame, items: DataFrame, n: int = 10, rating: float = 5.0, reg: float = 0.05) -> DataFrame:
    """Top ``n`` unseen catalogue items of many pseudo-users in one job: ``request, item, prediction,
    rank, title, genres``.  ``requests`` is ``request, item`` (and ``rating``, else the given one)."""
    given = F.col("rating") if "rating" in requests.columns else F.lit(rating)
    liked = requests.select(F.col("request").alias("user"), "item", given.alias("rating")).dropDuplicates(["user", "item"])
    _, itf = als_factors(fit)
    new = fold_in_users(itf, liked, reg).select(F.col("user").alias("id"), "vec")
    seen = liked.select("user", "item")
    top = block_top_k(new, itf.join(items.select(F.col("item").alias("id")), "id", "left_semi"), n, left_key="id", right_key="id", exclude=seen,
                      out_left="request", out_right="item", score_col="prediction")
    return rel.enrich_with_items(top, items)


def fit_pseudo_user(ratings: DataFrame, liked: DataFrame, rating: float = 5.0, rank: int = 20,
                    reg: float = 0.05, iters: int = 10, seed: int = 42) -> tuple[AlsFit, Column]:
    """Refit ALS on all ratings plus a new user (``max(user) + 1``) who gave ``rating``
    to ``liked`` items.  Returns the fit and the new user's id (a lazy scalar)."""
    uid: Column = rel.next_user_id(ratings)
    fit = fit_als(rel.append_ratings(ratings, uid, liked, rating), rank, reg, iters, seed)
    return fit, uid


def recommend_for_liked(ratings: DataFrame, items: DataFrame, liked: DataFrame, n: int = 10,
                        rating: float = 5.0, rank: int = 20, reg: float = 0.05, iters: int = 10,
                        seed: int = 42, mode: str = "refit", fit: AlsFit | None = None) -> DataFrame:
    """Top ``n`` unseen catalogue items for a new user who rated ``liked`` items ``rating``.

    ``mode='refit'``: append the user to the ratings and refit ALS on all of them (the
    reference's semantics).  ``mode='fold_in'``: keep the item factors of ``fit`` (fitted
    here when not given, so one model serves many pseudo-users) and solve only the new
    user's factor.  Returns ``user, item, prediction, rank, title, genres``.
    """
    uid: Column = rel.next_user_id(ratings)
    unseen = rel.candidates(uid, items, liked)
    none = unseen.select("user", "item", F.lit(0.0).alias("prediction")).where(F.lit(False))
    if mode not in ("refit", "fold_in"):
        raise ValueError("mode must be 'refit' or 'fold_in'")
    if liked.isEmpty():  # nothing to go by: no fit, no rows
        pred = none
    elif mode == "refit":
        fit, _ = fit_pseudo_user(ratings, liked, rating, rank, reg, iters, seed)
        pred = score_als(fit, unseen)
    else:
        fit = fit or fit_als(ratings, rank, reg, iters, seed)
        _, itf = als_factors(fit)
        x = fold_in_user(itf, liked, rating, reg)
        pred = none if x is None else (
            unseen.join(itf.withColumnRenamed("id", "item"), "item")
            .select("user", "item", dot(F.array(*[F.lit(v) for v in x]), F.col("vec")).alias("prediction")))
    ranked = rel.top_n_per_key(pred, "user", [F.col("prediction").desc(), F.col("item").asc()], n)
    return rel.enrich_with_items(ranked, items)


def recommend_by_title(ratings: DataFrame, items: DataFrame, text: str, n: int = 10, **kw) -> DataFrame:
    """Title search -> pseudo-user -> unseen catalogue -> top ``n`` with titles.
    No title match gives an empty result."""
    liked = rel.search_items(items, text).select("item")
    return recommend_for_liked(ratings, items, liked, n, **kw)


def similar_by_pseudo_user(ratings: DataFrame, items: DataFrame, item_ids: DataFrame, n: int = 10,
                           **kw) -> DataFrame:
    """Items a user who liked ``item_ids`` would get next (same pipeline from ids)."""
    return recommend_for_liked(ratings, items, item_ids.select("item"), n, **kw)
