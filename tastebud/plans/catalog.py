"""Registered queries over the driver's tables, each with an equivalent DuckDB SQL text.

Every query reads whole tables (or tables Spark derives from them).  Doubles that
depend on summation order are rounded to 6 places on both sides; rankings break
ties on the rounded score by id; counters are BIGINT on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import encode, kcore as kc, relational as rel, split
from ..sources import tables

Query = Callable[[SparkSession, str], DataFrame]

SEED = 42
# fixed values of the registered queries
SEARCH_TEXT = "ring"
BINARY_THRESHOLD = 25.0
KCORE_MIN = (20, 20)
HOLDOUT_N, HOLDOUT_FRACTION = 5, 0.2
TEST_FRACTION = 0.2
TOP_K = 10

I_CTE = """I AS (
  SELECT o.o_custkey AS "user", l.l_partkey AS item, SUM(l.l_quantity) AS value
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY o.o_custkey, l.l_partkey)"""

ITEMS_CTE = """items AS (SELECT p_partkey AS item, p_name AS title, p_type AS genres FROM part)"""

SIDE_CTE = """side AS (
  SELECT p_partkey AS item, 'brand' AS type, p_brand AS value FROM part
  UNION ALL SELECT p_partkey, 'type', p_type FROM part
  UNION ALL SELECT p_partkey, 'tag', unnest(string_split(p_name, ' ')) FROM part)"""

FEATURES_CTE = """feats AS (
  SELECT DISTINCT item, type || '_' || lower(value) AS feature FROM side)"""


def _r(c, d: int = 6):
    return F.round(F.col(c) if isinstance(c, str) else c, d)


def _md5_hex8(seed: int, *cols: str) -> str:
    inner = " || '|' || ".join([f"'{seed}'"] + [f"CAST({c} AS VARCHAR)" for c in cols])
    return f"substr(md5({inner}), 1, 8)"


# ------------------------------------------------------------------ interaction table family

def q_interaction_table(spark, d):
    return tables.interactions(spark, d)


def q_interaction_binary(spark, d):
    return rel.binarize(tables.interactions(spark, d), BINARY_THRESHOLD, "value", "value_bin") \
        .select("user", "item", "value_bin")


def q_interaction_stats(spark, d):
    return rel.interaction_stats(tables.interactions(spark, d)).withColumn("density_pct", _r("density_pct"))


def q_next_user_id(spark, d):
    return tables.interactions(spark, d).select((F.max("user") + 1).alias("next_user"))


def q_kcore_20_20(spark, d):
    return kc.kcore(tables.interactions(spark, d), *KCORE_MIN)


def q_popularity_baseline(spark, d):
    return rel.popularity_baseline(tables.interactions(spark, d)).withColumn("score", _r("score"))


def q_search_items(spark, d):
    return rel.search_items(tables.items(spark, d), SEARCH_TEXT).select("item", "title")


def q_known_likes(spark, d):
    return rel.known_likes(tables.interactions(spark, d), threshold=0.0, n=3)


def _pseudo_user_likes(spark, d):
    inter = tables.interactions(spark, d)
    liked = rel.search_items(tables.items(spark, d), SEARCH_TEXT).select("item")
    return inter, liked, rel.next_user_id(inter)


def q_candidates_unseen(spark, d):
    inter, liked, uid = _pseudo_user_likes(spark, d)
    return rel.candidates(uid, tables.items(spark, d), liked)


def q_append_ratings(spark, d):
    inter, liked, uid = _pseudo_user_likes(spark, d)
    ratings = inter.select("user", "item", (F.col("value") / 10.0).alias("rating"))
    return rel.append_ratings(ratings, uid, liked, 5.0)


def q_enrich_items(spark, d):
    return rel.enrich_with_items(tables.interactions(spark, d), tables.items(spark, d)) \
        .select("user", "item", "value", "title", "genres")


def q_dedup_likes(spark, d):
    return rel.dedup(tables.transactions(spark, d).select("user", "item"))


def q_label_strict(spark, d):
    return rel.label(tables.interactions(spark, d).select("user", "item"),
                     tables.items(spark, d).select("item", "title"), "item", strict=True)


# ------------------------------------------------------------------ encoding

def q_index_ids(spark, d):
    return encode.index_ids(tables.interactions(spark, d), "user")


def q_apply_index(spark, d):
    tx = tables.transactions(spark, d)
    um = encode.index_ids(tx, "user")
    im = encode.index_ids(tx, "item")
    return encode.apply_index(tx, um, im)


def q_encode_features(spark, d):
    return encode.encode_features(tables.item_side_info(spark, d))


def q_append_indicators(spark, d):
    feats = rel.features_from_side_info(tables.item_side_info(spark, d))
    return rel.append_indicators(feats, tables.items(spark, d), "item")


def q_feature_vocab_stats(spark, d):
    return rel.feature_vocab_stats(rel.features_from_side_info(tables.item_side_info(spark, d)))


def q_features_with_prefix(spark, d):
    vocab = rel.features_from_side_info(tables.item_side_info(spark, d)).select("feature").distinct()
    return rel.features_with_prefix(vocab, "tag_")


def q_side_info_counts(spark, d):
    return rel.side_info_counts(tables.interactions(spark, d).select("item").distinct(),
                                rel.features_from_side_info(tables.item_side_info(spark, d)))


# ------------------------------------------------------------------ splits

def q_hash_split(spark, d):
    return split.hash_split(tables.interactions(spark, d), TEST_FRACTION, SEED)


def _holdout(spark, d):
    return split.holdout_per_user(tables.interactions(spark, d), HOLDOUT_N, HOLDOUT_FRACTION, SEED)


def q_holdout_per_user(spark, d):
    train, test, _ = _holdout(spark, d)
    return (train.withColumn("split", F.lit("train"))
            .unionByName(test.withColumn("split", F.lit("test"))))


def q_eval_train(spark, d):
    train, _, users = _holdout(spark, d)
    return split.eval_train(train, users)


def q_set_minus_users(spark, d):
    inter = tables.interactions(spark, d)
    _, _, users = _holdout(spark, d)
    return rel.set_minus(inter.select("user"), users)


def q_rmse_item_mean(spark, d):
    tagged = split.hash_split(tables.ratings(spark, d), TEST_FRACTION, SEED)
    train = tagged.where(F.col("split") == "train")
    test = tagged.where(F.col("split") == "test")
    means = train.groupBy("item").agg(F.avg("rating").alias("prediction"))
    pred = test.join(means, "item")  # cold items dropped, like coldStartStrategy='drop'
    return rel.rmse(pred, "rating", "prediction").select(_r("rmse").alias("rmse"), "n")


def q_arm_scores(spark, d):
    from ..operators import bandit
    out = bandit.arm_scores(tables.event_log(spark, d))
    return out.select("arm", "pulls", _r("mean_reward").alias("mean_reward"), _r("ucb").alias("ucb"))


def q_replay_greedy_policy(spark, d):
    """Replay (in-sample) the per-user greedy policy over the whole event log."""
    from ..operators import bandit
    log = tables.event_log(spark, d)
    out = bandit.replay_fixed_policy(log, bandit.greedy_policy(log))
    return out.select("matched", _r("mean_reward").alias("mean_reward"))


def q_exclude_ids(spark, d):
    matched = rel.search_items(tables.items(spark, d), SEARCH_TEXT)
    return rel.exclude_ids(tables.interactions(spark, d), matched, "item")


def q_lookup_ids(spark, d):
    """Popularity score and rank of the items a title search returns, attached by key."""
    pop = rel.popularity_baseline(tables.interactions(spark, d)).withColumn("_s", F.round("score", 6))
    # global rank without a single-partition window: range-partitioned dense positions
    ranked = encode.index_by_order(pop, [F.col("_s").desc(), F.col("item")], "_pos") \
        .withColumn("rank", F.col("_pos") + 1).drop("_pos", "_s")
    matched = rel.search_items(tables.items(spark, d), SEARCH_TEXT).select("item", "title")
    return rel.lookup_ids(ranked, matched, "item").select("item", "title", _r("score").alias("score"), "rank")


def q_attach_side_info(spark, d):
    side = tables.item_side_info(spark, d)
    return rel.attach_side_info(tables.interactions(spark, d).select("item").distinct(), side)


def q_distinct_items(spark, d):
    return rel.distinct_values(tables.interactions(spark, d), "item")


def q_top_items(spark, d):
    pop = rel.popularity_baseline(tables.interactions(spark, d))
    return rel.top_n(pop.select("item", _r("score").alias("score")), [F.col("score").desc(), F.col("item")], TOP_K)


def q_item_dictionary(spark, d):
    """Genre -> title of its last item (highest part key): last duplicate wins."""
    part = tables.table(spark, d, "part").select(F.col("p_type").alias("genres"),
                                                  F.col("p_name").alias("title"),
                                                  F.col("p_partkey").alias("row_order"))
    return encode.item_dictionary(part, "genres", "title", "row_order")


def q_feature_options(spark, d):
    feats = rel.features_from_side_info(tables.item_side_info(spark, d))
    out = encode.feature_options(feats, min_items=100, normalise=True)
    return out.select("item", "feature", _r("weight").alias("weight"))


def q_features_to_vector(spark, d):
    """The stored cells of each item's sparse vector (weights 1 / number of the item's features)."""
    coded = encode.feature_options(encode.encode_features(tables.item_side_info(spark, d)), normalise=True)
    n_features = coded.agg(F.max("feature_idx")).first()[0]
    vectors = encode.features_to_vector(coded, 0 if n_features is None else n_features + 1)
    v = vectors.select("item", F.unwrap_udt("features").alias("v"))
    cells = v.select("item", F.col("v.size").alias("size"), F.explode(F.arrays_zip(
        F.col("v.indices").alias("i"), F.col("v.values").alias("w"))).alias("c"))
    return cells.select("item", "size", F.col("c.i").alias("feature_idx"), F.col("c.w").alias("weight"))


QUERIES: dict[str, Query] = {
    "interaction_table": q_interaction_table,
    "interaction_binary": q_interaction_binary,
    "interaction_stats": q_interaction_stats,
    "next_user_id": q_next_user_id,
    "kcore_20_20": q_kcore_20_20,
    "popularity_baseline": q_popularity_baseline,
    "search_items": q_search_items,
    "known_likes": q_known_likes,
    "candidates_unseen": q_candidates_unseen,
    "append_ratings": q_append_ratings,
    "enrich_items": q_enrich_items,
    "dedup_likes": q_dedup_likes,
    "label_strict": q_label_strict,
    "index_ids": q_index_ids,
    "apply_index": q_apply_index,
    "encode_features": q_encode_features,
    "append_indicators": q_append_indicators,
    "feature_vocab_stats": q_feature_vocab_stats,
    "features_with_prefix": q_features_with_prefix,
    "side_info_counts": q_side_info_counts,
    "hash_split": q_hash_split,
    "holdout_per_user": q_holdout_per_user,
    "eval_train": q_eval_train,
    "set_minus_users": q_set_minus_users,
    "rmse_item_mean": q_rmse_item_mean,
    "exclude_ids": q_exclude_ids,
    "lookup_ids": q_lookup_ids,
    "attach_side_info": q_attach_side_info,
    "distinct_items": q_distinct_items,
    "top_items": q_top_items,
    "item_dictionary": q_item_dictionary,
    "feature_options": q_feature_options,
    "features_to_vector": q_features_to_vector,
    "arm_scores": q_arm_scores,
    "replay_greedy_policy": q_replay_greedy_policy,
}


def _kcore_sql(rounds: int) -> str:
    umin, imin = KCORE_MIN
    steps = ["k0 AS (SELECT DISTINCT \"user\", item FROM I)"]
    for r in range(1, rounds + 1):
        p = f"k{r - 1}"
        steps.append(
            f"u{r} AS (SELECT * FROM {p} WHERE \"user\" IN "
            f"(SELECT \"user\" FROM {p} GROUP BY \"user\" HAVING count(*) >= {umin}))")
        steps.append(
            f"k{r} AS (SELECT * FROM u{r} WHERE item IN "
            f"(SELECT item FROM u{r} GROUP BY item HAVING count(*) >= {imin}))")
    return ("WITH " + I_CTE + ",\n" + ",\n".join(steps) +
            f"\nSELECT I.\"user\", I.item, I.value FROM I SEMI JOIN k{rounds} USING (\"user\", item)")


def _holdout_sql() -> str:
    n, frac = HOLDOUT_N, HOLDOUT_FRACTION
    return f"""WITH {I_CTE},
cnt AS (SELECT "user", count(*) AS c FROM I GROUP BY "user"),
k AS (SELECT CAST(floor({frac} * count(*)) AS BIGINT) AS k FROM cnt),
elig AS (SELECT "user", row_number() OVER (ORDER BY md5('{SEED}' || '|' || CAST("user" AS VARCHAR)), "user") AS pos
         FROM cnt WHERE c >= {2 * n}),
chosen AS (SELECT "user" FROM elig WHERE pos <= (SELECT k FROM k)),
ranked AS (SELECT I."user", I.item, row_number() OVER (PARTITION BY I."user"
             ORDER BY md5('{SEED}' || '|' || CAST(I."user" AS VARCHAR) || '|' || CAST(I.item AS VARCHAR)), I.item) AS r
           FROM I SEMI JOIN chosen USING ("user")),
test AS (SELECT "user", item FROM ranked WHERE r <= {n})"""


SQL: dict[str, str] = {
    "exclude_ids": f'''WITH {I_CTE}, {ITEMS_CTE} SELECT "user", item, value FROM I
        WHERE item NOT IN (SELECT item FROM items WHERE lower(title) LIKE '%{SEARCH_TEXT}%')''',
    "lookup_ids": f'''WITH {I_CTE}, {ITEMS_CTE},
        pop AS (SELECT item, round(sum(value) / (SELECT count(DISTINCT "user") FROM I), 6) AS score FROM I GROUP BY item),
        r AS (SELECT item, score, CAST(row_number() OVER (ORDER BY score DESC, item) AS BIGINT) AS rank FROM pop)
        SELECT r.item, items.title, r.score, r.rank FROM r JOIN items USING (item) WHERE lower(items.title) LIKE '%{SEARCH_TEXT}%' ''',
    "attach_side_info": f'''WITH {I_CTE}, {SIDE_CTE} SELECT item, type, value FROM side WHERE item IN (SELECT item FROM I)''',
    "distinct_items": f'WITH {I_CTE} SELECT DISTINCT item FROM I',
    "top_items": f'''WITH {I_CTE}, pop AS (SELECT item, round(sum(value) / (SELECT count(DISTINCT "user") FROM I), 6) AS score
        FROM I GROUP BY item) SELECT item, score FROM pop ORDER BY score DESC, item LIMIT {TOP_K}''',
    "item_dictionary": 'SELECT p_type AS genres, arg_max(p_name, p_partkey) AS title FROM part GROUP BY p_type',
    "feature_options": f'''WITH {SIDE_CTE}, {FEATURES_CTE},
        keep AS (SELECT feature FROM feats GROUP BY feature HAVING count(DISTINCT item) >= 100),
        f AS (SELECT * FROM feats WHERE feature IN (SELECT feature FROM keep)),
        k AS (SELECT item, count(*) AS n FROM f GROUP BY item)
        SELECT item, feature, round(1.0 / n, 6) AS weight FROM f JOIN k USING (item)''',
    "arm_scores": """WITH ev AS (SELECT event_type AS arm, value AS reward FROM events)
        SELECT arm, count(*) AS pulls, round(avg(reward), 6) AS mean_reward,
        round(avg(reward) + sqrt(2.0 * ln((SELECT count(*) FROM ev)) / count(*)), 6) AS ucb FROM ev GROUP BY arm""",
    "replay_greedy_policy": """WITH ev AS (SELECT user_id AS "user", event_type AS arm, value AS reward FROM events),
        m AS (SELECT "user", arm, avg(reward) AS mr FROM ev GROUP BY "user", arm),
        pol AS (SELECT "user", arm FROM (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY mr DESC, arm) AS r FROM m) WHERE r = 1)
        SELECT count(*) AS matched, round(avg(reward), 6) AS mean_reward FROM ev JOIN pol USING ("user", arm)""",
    "interaction_table": f'WITH {I_CTE} SELECT "user", item, value FROM I',
    "interaction_binary": f'WITH {I_CTE} SELECT "user", item, CASE WHEN value > {BINARY_THRESHOLD} THEN 1 ELSE 0 END AS value_bin FROM I',
    "interaction_stats": f'''WITH {I_CTE} SELECT count(DISTINCT "user") AS n_users, count(DISTINCT item) AS n_items,
        count(*) AS n_rows,
        round(count(*) / (CAST(count(DISTINCT "user") AS DOUBLE) * count(DISTINCT item)) * 100.0, 6) AS density_pct FROM I''',
    "next_user_id": f'WITH {I_CTE} SELECT max("user") + 1 AS next_user FROM I',
    "kcore_20_20": _kcore_sql(8),
    "popularity_baseline": f'''WITH {I_CTE} SELECT item, round(sum(value) / (SELECT count(DISTINCT "user") FROM I), 6) AS score
        FROM I GROUP BY item''',
    "search_items": f"WITH {ITEMS_CTE} SELECT item, title FROM items WHERE lower(title) LIKE '%{SEARCH_TEXT}%'",
    "known_likes": f'''WITH {I_CTE}, r AS (SELECT "user", item, value,
        row_number() OVER (PARTITION BY "user" ORDER BY item DESC) AS pos FROM I WHERE value > 0)
        SELECT "user", item, value, CAST(pos AS BIGINT) AS pos FROM r WHERE pos <= 3''',
    "candidates_unseen": f'''WITH {I_CTE}, {ITEMS_CTE}
        SELECT (SELECT max("user") + 1 FROM I) AS "user", item FROM items
        WHERE item NOT IN (SELECT item FROM items WHERE lower(title) LIKE '%{SEARCH_TEXT}%')''',
    "append_ratings": f'''WITH {I_CTE}, {ITEMS_CTE}
        SELECT "user", item, value / 10.0 AS rating FROM I
        UNION ALL SELECT (SELECT max("user") + 1 FROM I), item, 5.0 FROM items WHERE lower(title) LIKE '%{SEARCH_TEXT}%' ''',
    "enrich_items": f'WITH {I_CTE}, {ITEMS_CTE} SELECT "user", item, value, title, genres FROM I JOIN items USING (item)',
    "dedup_likes": '''SELECT DISTINCT o.o_custkey AS "user", l.l_partkey AS item
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey''',
    "label_strict": f'WITH {I_CTE}, {ITEMS_CTE} SELECT I.item, I."user", items.title FROM I LEFT JOIN items USING (item)',
    "index_ids": f'''WITH {I_CTE} SELECT "user", CAST(row_number() OVER (ORDER BY "user") - 1 AS BIGINT) AS idx
        FROM (SELECT DISTINCT "user" FROM I)''',
    "apply_index": '''WITH tx AS (SELECT o.o_custkey AS "user", l.l_partkey AS item
          FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
        um AS (SELECT "user", row_number() OVER (ORDER BY "user") - 1 AS "row" FROM (SELECT DISTINCT "user" FROM tx)),
        im AS (SELECT item, row_number() OVER (ORDER BY item) - 1 AS col FROM (SELECT DISTINCT item FROM tx))
        SELECT CAST("row" AS BIGINT) AS "row", CAST(col AS BIGINT) AS col, sum(1.0)::DOUBLE AS value
        FROM tx JOIN um USING ("user") JOIN im USING (item) GROUP BY "row", col''',
    "encode_features": f'''WITH {SIDE_CTE}, {FEATURES_CTE},
        vocab AS (SELECT feature, CAST(row_number() OVER (ORDER BY feature) - 1 AS BIGINT) AS feature_idx
                  FROM (SELECT DISTINCT feature FROM feats))
        SELECT item, feature, feature_idx, 1.0::DOUBLE AS weight FROM feats JOIN vocab USING (feature)''',
    "features_to_vector": f'''WITH {SIDE_CTE}, {FEATURES_CTE},
        vocab AS (SELECT feature, row_number() OVER (ORDER BY feature) - 1 AS i FROM (SELECT DISTINCT feature FROM feats)),
        k AS (SELECT item, count(*) AS k FROM feats GROUP BY item)
        SELECT item, CAST((SELECT count(*) FROM vocab) AS INTEGER) AS size, CAST(i AS INTEGER) AS feature_idx, 1.0::DOUBLE / k AS weight
        FROM feats JOIN vocab USING (feature) JOIN k USING (item)''',
    "append_indicators": f'''WITH {SIDE_CTE}, {FEATURES_CTE}
        SELECT item, feature, 1.0::DOUBLE AS weight FROM feats
        UNION ALL SELECT DISTINCT p_partkey, 'id:' || CAST(p_partkey AS VARCHAR), 1.0::DOUBLE FROM part''',
    "feature_vocab_stats": f'WITH {SIDE_CTE}, {FEATURES_CTE} SELECT count(DISTINCT feature) AS n_features FROM feats',
    "features_with_prefix": f"WITH {SIDE_CTE}, {FEATURES_CTE} SELECT DISTINCT feature FROM feats WHERE starts_with(feature, 'tag_')",
    "side_info_counts": f'''WITH {I_CTE}, {SIDE_CTE}, {FEATURES_CTE}
        SELECT i.item, CAST(coalesce(c.n, 0) AS BIGINT) AS n_features
        FROM (SELECT DISTINCT item FROM I) i LEFT JOIN (SELECT item, count(*) AS n FROM feats GROUP BY item) c USING (item)''',
    "hash_split": f'''WITH {I_CTE} SELECT "user", item, value,
        CASE WHEN {_md5_hex8(SEED, '"user"', 'item')} < '{format(int(TEST_FRACTION * 16 ** 8), '08x')}' THEN 'test' ELSE 'train' END AS split FROM I''',
    "holdout_per_user": _holdout_sql() + '''
        SELECT I."user", I.item, I.value, CASE WHEN t.item IS NULL THEN 'train' ELSE 'test' END AS split
        FROM I LEFT JOIN test t ON I."user" = t."user" AND I.item = t.item''',
    "eval_train": _holdout_sql() + '''
        SELECT I."user", I.item, I.value FROM I SEMI JOIN chosen USING ("user")
        ANTI JOIN test USING ("user", item)''',
    "set_minus_users": _holdout_sql() + '''
        SELECT DISTINCT "user" FROM I WHERE "user" NOT IN (SELECT "user" FROM chosen)''',
    "rmse_item_mean": f'''WITH {I_CTE},
        r AS (SELECT "user", item, value / 10.0 AS rating,
              {_md5_hex8(SEED, '"user"', 'item')} < '{format(int(TEST_FRACTION * 16 ** 8), '08x')}' AS is_test FROM I),
        means AS (SELECT item, avg(rating) AS prediction FROM r WHERE NOT is_test GROUP BY item)
        SELECT round(sqrt(avg(power(rating - prediction, 2))), 6) AS rmse, count(*) AS n
        FROM r JOIN means USING (item) WHERE is_test''',
}


def all_queries() -> dict[str, Query]:
    from . import fixed, flagship, io_queries, rank_queries, step_queries
    return {**QUERIES, **fixed.QUERIES, **flagship.QUERIES, **io_queries.QUERIES, **rank_queries.QUERIES, **step_queries.QUERIES}


def all_sql() -> dict[str, str]:
    from . import fixed, io_queries, step_queries
    return {**SQL, **fixed.SQL, **io_queries.SQL, **step_queries.SQL}
