"""Relational operators over interaction / item / feature tables.

Conventions: ``U``, ``I``, ``V`` default to ``user``, ``item``, ``value``.  Every
function takes and returns DataFrames; checks that must fail loudly collect one
scalar (a count) and nothing else.  Membership lists are always DataFrames joined
with ``left_semi`` / ``left_anti``: AQE broadcasts them when their measured size is
small and falls back to a shuffle join otherwise, so no literal IN-list ever grows
with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import binarize_expr, feature_key


# ---------------------------------------------------------------- 2.2 projections, filters

def project(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols)


def _like_escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")


def search_items(items: DataFrame, text: str, title_col: str = "title",
                 literal: bool = False) -> DataFrame:
    """Items whose lower-cased title contains ``text`` (lower-cased).

    Default semantics equal SQL ``LIKE '%text%'`` (``%``/``_`` in ``text`` act as
    wildcards, as in the reference); ``literal=True`` matches the text verbatim.  No
    match gives an empty DataFrame.
    """
    needle = text.lower()
    title = F.lower(F.col(title_col))
    cond = title.contains(needle) if literal else title.like(f"%{needle}%")
    return items.where(cond)


def exclude_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is NOT IN ``ids``."""
    return df.join(ids.select(key), key, "left_anti")


def lookup_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` for the ids in ``ids``, keeping the columns of ``ids`` (scores, ranks)
    attached by key rather than by position."""
    return ids.join(df, key, "inner")


def binarize(df: DataFrame, threshold: float, col: str = "value", out: str | None = None) -> DataFrame:
    return df.withColumn(out or col, binarize_expr(col, threshold))


def known_likes(inter: DataFrame, threshold: float = 0.0, n: int | None = None,
                user: str = "user", item: str = "item", value: str = "value") -> DataFrame:
    """Items each user already likes (value > threshold), highest item id first.

    With ``n`` only the first ``n`` per user are kept (``pos`` 1..n); the per-user
    limit is a ``row_number <= n`` filter, which Spark runs as a partial
    WindowGroupLimit before the shuffle, so a user with a huge history never lands
    whole in one task.  Without ``n`` the full list is returned range-sorted.
    """
    liked = inter.where(F.col(value) > F.lit(threshold))
    if n is None:
        return liked.orderBy(F.col(user), F.col(item).desc())
    return top_n_per_key(liked, user, [F.col(item).desc()], n, rank_col="pos")


def drop_cold(pred: DataFrame, user_factors: DataFrame, item_factors: DataFrame,
              user: str = "user", item: str = "item") -> DataFrame:
    """Drop prediction rows whose user or item has no factors."""
    return (pred.join(user_factors.select(F.col("id").alias(user)), user, "left_semi")
            .join(item_factors.select(F.col("id").alias(item)), item, "left_semi"))


def features_with_prefix(vocab: DataFrame, prefix: str, col: str = "feature") -> DataFrame:
    return vocab.where(F.col(col).startswith(prefix))


def head(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()


# ---------------------------------------------------------------- 2.3 joins

def enrich_with_items(recs: DataFrame, items: DataFrame, item: str = "item") -> DataFrame:
    """Inner join USING(item): adds title / genres to recommendation rows."""
    return recs.join(items, item, "inner")


def label(df: DataFrame, labels: DataFrame, key: str, strict: bool = False) -> DataFrame:
    """Left join id -> name; ``strict`` raises when an id has no label."""
    out = df.join(labels, key, "left")
    if strict:
        missing = df.select(key).join(labels.select(key), key, "left_anti").limit(1).count()
        if missing:
            raise KeyError(f"ids without a label in column {key!r}")
    return out


def candidates(user_id: Column | int, items: DataFrame, seen: DataFrame,
               item: str = "item", user: str = "user") -> DataFrame:
    """One user's unseen catalogue: ``items`` minus ``seen`` (items of that user),
    tagged with ``user_id``.  Linear in the catalogue; multi-user scoring never
    materialises user x item candidates (see ``operators.blocks``)."""
    uid = user_id if isinstance(user_id, Column) else F.lit(user_id)
    return (items.select(item).join(seen.select(item), item, "left_anti")
            .select(uid.alias(user), F.col(item)))


def attach_side_info(item_map: DataFrame, side: DataFrame, item: str = "item") -> DataFrame:
    """Side rows of mapped items only; items without side rows simply have none."""
    return side.join(item_map.select(item), item, "left_semi")


def side_info_counts(item_map: DataFrame, side: DataFrame, item: str = "item") -> DataFrame:
    """Feature count per mapped item, 0 for items without side rows."""
    counts = side.groupBy(item).agg(F.count(F.lit(1)).alias("n_features"))
    return (item_map.select(item).join(counts, item, "left")
            .select(item, F.coalesce("n_features", F.lit(0)).cast("long").alias("n_features")))


def align_features(df: DataFrame, expected: DataFrame, col: str = "feature") -> DataFrame:
    """Keep exactly the training features: extra ones dropped, missing ones an error.

    ``expected`` holds the training vocabulary (one row per feature)."""
    got = df.select(col).distinct()
    missing = expected.select(col).join(got, col, "left_anti")
    if not missing.isEmpty():
        first = [r[0] for r in missing.orderBy(col).limit(20).collect()]
        raise ValueError(f"{missing.count()} features missing from input; the first are {first}")
    return df.join(expected.select(col), col, "left_semi")


def restrict_items(item_map: DataFrame, wanted: DataFrame, item: str = "item") -> DataFrame:
    """Mapped rows of the wanted items; every wanted item must exist."""
    unknown = wanted.select(item).join(item_map.select(item), item, "left_anti")
    if not unknown.isEmpty():
        raise KeyError("requested items are not in the model")
    return item_map.join(wanted.select(item).distinct(), item, "left_semi")


# ---------------------------------------------------------------- 2.4 aggregations

def next_user_id(ratings: DataFrame, user: str = "user") -> Column:
    """``max(user) + 1`` as a lazy scalar subquery (no collect, no cross join)."""
    return ratings.select((F.max(user) + 1).alias("next_user")).scalar()


def interaction_table(df: DataFrame, user: str = "user", item: str = "item",
                      value: str = "value", threshold: float | None = None) -> DataFrame:
    """Long-form interaction matrix: ``sum(value)`` per (user, item), zeros implicit.

    Partial aggregation runs map-side before the shuffle on (user, item), so a hot
    user is spread over as many reducers as it has items.
    """
    out = df.groupBy(user, item).agg(F.sum(value).alias(value))
    if threshold is not None:
        out = out.withColumn(value, binarize_expr(value, threshold))
    return out


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def interaction_stats(df: DataFrame, user: str = "user", item: str = "item") -> DataFrame:
    """users, items, rows and density % = rows / (users * items) * 100 (one pass)."""
    agg = df.agg(F.countDistinct(user).alias("n_users"), F.countDistinct(item).alias("n_items"),
                 F.count(F.lit(1)).alias("n_rows"))
    return agg.withColumn(
        "density_pct",
        F.col("n_rows") / (F.col("n_users").cast("double") * F.col("n_items")) * 100.0)


def popularity_baseline(df: DataFrame, user: str = "user", item: str = "item",
                        value: str = "value") -> DataFrame:
    """Per item: sum(value) / number of training users (absent pairs count as 0)."""
    n_users = df.select(F.countDistinct(user)).scalar()
    return (df.groupBy(item).agg(F.sum(value).alias("total"))
            .select(item, (F.col("total") / n_users).alias("score")))


def feature_vocab_stats(features: DataFrame, col: str = "feature") -> DataFrame:
    return features.agg(F.countDistinct(col).alias("n_features"))


def rmse(pred: DataFrame, label_col: str = "rating", pred_col: str = "prediction") -> DataFrame:
    return pred.agg(F.sqrt(F.avg(F.pow(F.col(label_col) - F.col(pred_col), 2))).alias("rmse"),
                    F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- 2.5 sorts and top-k

def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """Global top n (TakeOrderedAndProject: per-partition top n, then merge)."""
    return df.orderBy(*order).limit(n)


def top_n_per_key(df: DataFrame, key: str | list[str], order: list[Column], n: int,
                  rank_col: str = "rank") -> DataFrame:
    """First ``n`` rows per key by ``order`` with a deterministic rank column (BIGINT).

    ``row_number() <= n`` is planned as WindowGroupLimit on both sides of the
    shuffle, so each map task forwards at most ``n`` rows per key."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w))
            .where(F.col(rank_col) <= n)
            .withColumn(rank_col, F.col(rank_col).cast("long")))


def sort_scores(df: DataFrame, score: str = "score", tie: str = "item") -> DataFrame:
    return df.orderBy(F.col(score).desc(), F.col(tie).asc())


def rank_skip_self(df: DataFrame, key: str, other: str, score: str, n: int,
                   decimals: int | None = 6) -> DataFrame:
    """Top ``n`` neighbours per key, excluding the key itself (by id, not by position)."""
    s = F.round(score, decimals) if decimals is not None else F.col(score)
    return top_n_per_key(df.where(F.col(key) != F.col(other)), key,
                         [s.desc(), F.col(other).asc()], n)


# ---------------------------------------------------------------- 2.6 set operations

def append_ratings(ratings: DataFrame, user_id: Column | int, items: DataFrame,
                   rating: float = 5.0, item: str = "item") -> DataFrame:
    """UNION ALL of ``ratings`` and one user's rows (``rating`` for every given item)."""
    uid = user_id if isinstance(user_id, Column) else F.lit(user_id)
    user_type = dict(ratings.dtypes)["user"]
    new = items.select(uid.cast(user_type).alias("user"),
                       F.col(item).cast(dict(ratings.dtypes)["item"]).alias("item"),
                       F.lit(float(rating)).alias("rating"))
    return ratings.select("user", "item", "rating").unionByName(new)


def dedup(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def set_minus(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` not in ``b`` (set semantics on all columns of ``a``)."""
    return a.join(b.select(*a.columns), a.columns, "left_anti").distinct()


INDICATOR_SIDES = ("users", "items", "both", "none")


def resolve_indicators(indicators) -> str:
    """Map the indicator argument onto users/items/both/none.

    Known strings pass through; any other truthy value means ``both``; any other
    falsy value is an error (as in the reference)."""
    if isinstance(indicators, str) and indicators in INDICATOR_SIDES:
        return indicators
    if indicators:
        return "both"
    raise ValueError("indicators must be one of users/items/both/none or truthy")


def indicator_rows(ids: DataFrame, key: str) -> DataFrame:
    """One own-id feature per entity: ``(id, 'id:'||id, 1.0)``."""
    return ids.select(F.col(key), F.concat(F.lit("id:"), F.col(key).cast("string")).alias("feature"),
                      F.lit(1.0).alias("weight")).distinct()


def append_indicators(features: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Union the identity block into a ``key, feature, weight`` table."""
    return features.select(key, "feature", "weight").unionByName(indicator_rows(ids, key))


def features_from_side_info(side: DataFrame, key: str = "item") -> DataFrame:
    """``key, type, value`` side rows -> ``key, feature, weight`` (duplicates collapse to 1)."""
    return (side.select(F.col(key), feature_key("type", "value").alias("feature"))
            .distinct().withColumn("weight", F.lit(1.0)))
