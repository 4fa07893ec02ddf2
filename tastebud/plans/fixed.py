"""Registered vector queries on a fixed factor model built from ``embeddings``.

Every vector is a user and an item; a pair with itself is no candidate.  Observed
pairs are the interaction-table pairs whose user and item both have a vector
(semi-joins on the factor tables, not id lists); an md5 split puts half of them in
``train`` (seen) and half in ``test``.  Tag features are the labels: the embedding
of ``tag_<label>`` is the sum of the vectors carrying that label, and an item's
representation is its own vector.  Rankings compare scores rounded to 6 places, as
the SQL does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..operators import similarity as sim
from ..operators.encode import index_by_order
from ..operators.relational import features_from_side_info
from ..operators.split import hash_split
from ..session import cut_lineage
from ..sources import tables
from .catalog import FEATURES_CTE, I_CTE, SEED, SIDE_CTE, TOP_K

FIXED_TEST_FRACTION = 0.5
DECIMALS = 6
TAG_PREFIX = "tag_"


def _r(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def fixed_model(spark, d):
    users, items = tables.fixed_factors(spark, d)
    return users.select("id", "vec"), items.select("id", "vec")


def fixed_pairs(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, test, taken): the split, written once, and what may not be ranked (train and self pairs)."""
    users, items = fixed_model(spark, d)
    inter = tables.interactions(spark, d).select("user", "item").where("user <> item")
    pairs = (inter.join(users.select(F.col("id").alias("user")), "user", "left_semi")
             .join(items.select(F.col("id").alias("item")), "item", "left_semi"))
    tagged = cut_lineage(hash_split(pairs, FIXED_TEST_FRACTION, SEED))
    train = tagged.where(F.col("split") == "train").select("user", "item")
    test = tagged.where(F.col("split") == "test").select("user", "item")
    return train, test, train.unionByName(users.select(F.col("id").alias("user"), F.col("id").alias("item")))


def tag_embeddings(spark, d) -> DataFrame:
    emb = tables.embedding_vectors(spark, d)
    labelled = emb.select(F.concat(F.lit(TAG_PREFIX), F.col("label").cast("string")).alias("feature"), "vec")
    return sim.vector_sum(labelled, "feature", "vec")


def item_tags(spark, d) -> DataFrame:
    emb = tables.embedding_vectors(spark, d)
    return emb.select(F.col("id").alias("item"),
                      F.concat(F.lit(TAG_PREFIX), F.col("label").cast("string")).alias("feature"))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("score", _r("score"))


def q_item_similarity_top10(spark, d):
    emb = tables.embedding_vectors(spark, d)
    return _rounded(sim.item_similarity(emb, TOP_K, decimals=DECIMALS))


def q_similar_items(spark, d):
    emb = tables.embedding_vectors(spark, d)
    labels = emb.select(F.col("id").alias("neighbour"), F.col("label").alias("neighbour_label"))
    out = sim.similar_items(sim.item_similarity(emb, 5, decimals=DECIMALS), 5, labels=labels)
    return _rounded(out).select("item", "neighbour", "score", "rank", "neighbour_label")


def q_recommend_unseen_fixed(spark, d):
    users, items = fixed_model(spark, d)
    _, _, taken = fixed_pairs(spark, d)
    return _rounded(sim.recommend_unseen(users, items, taken, TOP_K, decimals=DECIMALS))


def q_recommend_unseen_pruned(spark, d):
    """Unseen items by dot product with vectors shortened by popularity: the item bought by the
    r-th most users counts 1 / sqrt(r).  Blocks of short vectors are skipped."""
    users, items = fixed_model(spark, d)
    _, _, taken = fixed_pairs(spark, d)
    buyers = tables.interactions(spark, d).groupBy(F.col("item").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    counted = items.join(buyers, "id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    ranked = index_by_order(counted, [F.col("n").desc(), F.col("id")], "r")
    prior = ranked.select("id", F.transform("vec", lambda x: x / F.sqrt(F.col("r") + 1)).alias("vec"))
    return _rounded(sim.recommend_unseen(users, prior, taken, TOP_K, decimals=DECIMALS, prune=True, block_rows=256))


def q_recommend_users_for_item(spark, d):
    users, items = fixed_model(spark, d)
    return _rounded(sim.recommend_users_for_item(users, items, 5, exclude_self=True, decimals=DECIMALS))


def q_precision_recall_at_10(spark, d):
    users, items = fixed_model(spark, d)
    _, test, taken = fixed_pairs(spark, d)
    pr = ev.precision_recall_at_k(users, items, test, TOP_K, taken, decimals=DECIMALS)
    return pr.select("user", _r("precision").alias("precision"), _r("recall").alias("recall"))


def q_auc_per_user(spark, d):
    users, items = fixed_model(spark, d)
    _, test, taken = fixed_pairs(spark, d)
    return ev.auc_per_user(users, items, test, taken, decimals=DECIMALS).select("user", _r("auc").alias("auc"))


def q_items_for_feature(spark, d):
    reps = tables.embedding_vectors(spark, d).select(F.col("id").alias("item"), "vec")
    return _rounded(sim.items_for_feature(reps, tag_embeddings(spark, d), TOP_K, decimals=DECIMALS))


def q_items_for_summed_features(spark, d):
    """Items for each brand: a feature's embedding is the sum of the vectors of its items, an item's
    representation the weighted sum of its features' embeddings (brand, type and tags, weight 1 / their number)."""
    emb = tables.embedding_vectors(spark, d).select(F.col("id").alias("item"), "vec")
    feats = features_from_side_info(tables.item_side_info(spark, d)).select("item", "feature")
    feature_emb = cut_lineage(sim.vector_sum(feats.join(emb, "item"), "feature", "vec"))
    n = feats.groupBy("item").agg((F.lit(1.0) / F.count(F.lit(1))).alias("weight"))
    reps = cut_lineage(sim.representations(feats.join(n, "item"), feature_emb, "item"))
    brands = feature_emb.where(F.col("feature").startswith("brand_"))
    return _rounded(sim.items_for_feature(reps, brands, TOP_K, decimals=DECIMALS))


def q_suggest_features(spark, d):
    reps = tables.embedding_vectors(spark, d).select(F.col("id").alias("item"), "vec")
    return _rounded(sim.suggest_features(reps, tag_embeddings(spark, d), item_tags(spark, d), 3,
                                         prefix=TAG_PREFIX, decimals=DECIMALS))


def q_similar_features(spark, d):
    return _rounded(sim.similar_features(tag_embeddings(spark, d), 3, decimals=DECIMALS))


def q_item_features_of(spark, d):
    """Features of every item that some tag query returned in its top 10."""
    reps = tables.embedding_vectors(spark, d).select(F.col("id").alias("item"), "vec")
    wanted = sim.items_for_feature(reps, tag_embeddings(spark, d), TOP_K, decimals=DECIMALS).select("item").distinct()
    return sim.item_features_of(item_tags(spark, d), wanted)


def q_report_fixed(spark, d):
    """Mean precision@10, recall@10 and AUC over users (test split, train excluded)."""
    users, items = fixed_model(spark, d)
    _, test, taken = fixed_pairs(spark, d)
    out = ev.report(users, items, taken, test, TOP_K, decimals=DECIMALS, splits=("test",))
    return out.select(_r("precision").alias("precision"), _r("recall").alias("recall"), _r("auc").alias("auc"))


def q_als_fold_in_table(spark, d):
    """Every user who rated items with a vector is folded in at once; ``solved`` recomputes the
    residual of each user's normal equations from its rows."""
    from ..operators import als
    from ..functions.vectors import dot
    _, items = fixed_model(spark, d)
    reg = 0.05
    liked = cut_lineage(tables.ratings(spark, d).join(items.select(F.col("id").alias("item")), "item", "left_semi").select("user", "item", "rating"))
    found = cut_lineage(als.fold_in_users(items, liked, reg))
    rows = (liked.join(found.withColumnRenamed("vec", "x"), "user").join(items.select(F.col("id").alias("item"), "vec"), "item")
            .withColumn("off", dot("x", "vec") - F.col("rating") ))
    residual = sim.vector_sum(rows.select("user", F.transform("vec", lambda v: v * F.col("off")).alias("vec")), "user", "vec")
    joined = residual.withColumnRenamed("vec", "r").join(found, "user")
    worst = F.array_max(F.zip_with("r", F.transform("vec", lambda x: x * reg * F.col("n")), lambda a, b: F.abs(a + b)))
    return joined.select("user", F.col("n").alias("n_liked"), (worst < 1e-8).alias("solved"))


QUERIES = {
    "als_fold_in_table": q_als_fold_in_table,
    "item_similarity_top10": q_item_similarity_top10,
    "similar_items": q_similar_items,
    "recommend_unseen_fixed": q_recommend_unseen_fixed,
    "recommend_unseen_pruned": q_recommend_unseen_pruned,
    "recommend_users_for_item": q_recommend_users_for_item,
    "precision_recall_at_10": q_precision_recall_at_10,
    "auc_per_user": q_auc_per_user,
    "items_for_feature": q_items_for_feature,
    "items_for_summed_features": q_items_for_summed_features,
    "suggest_features": q_suggest_features,
    "similar_features": q_similar_features,
    "item_features_of": q_item_features_of,
    "report_fixed": q_report_fixed,
}

E_CTE = "e AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec, label FROM embeddings)"
ROLES_CTE = """fu AS (SELECT id, vec FROM e),
fi AS (SELECT id, vec FROM e)"""
PAIRS_CTE = f"""pairs AS (SELECT DISTINCT I."user", I.item FROM I
    WHERE I."user" <> I.item AND I."user" IN (SELECT id FROM fu) AND I.item IN (SELECT id FROM fi)),
tagged AS (SELECT "user", item,
    substr(md5('{SEED}' || '|' || CAST("user" AS VARCHAR) || '|' || CAST(item AS VARCHAR)), 1, 8) < '80000000' AS is_test
    FROM pairs),
train AS (SELECT "user", item FROM tagged WHERE NOT is_test),
test AS (SELECT "user", item FROM tagged WHERE is_test),
scores AS (SELECT fu.id AS "user", fi.id AS item, list_inner_product(fu.vec, fi.vec) AS score FROM fu JOIN fi ON fu.id <> fi.id)"""
TAGS_CTE = """u AS (SELECT label, unnest(range(1, len(vec) + 1)) AS pos, unnest(vec) AS x FROM e),
tags AS (SELECT 'tag_' || CAST(label AS VARCHAR) AS feature, list(x ORDER BY pos) AS vec
         FROM (SELECT label, pos, sum(x) AS x FROM u GROUP BY label, pos) GROUP BY label),
itags AS (SELECT id AS item, 'tag_' || CAST(label AS VARCHAR) AS feature FROM e)"""


def _topk_sql(src: str, key: str, other: str, k: int, extra: str = "") -> str:
    return f"""SELECT {key}, {other}, score, CAST(rank AS BIGINT) AS rank{extra} FROM (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY score DESC, {other}) AS rank
  FROM (SELECT {key}, {other}, round(score, 6) AS score{extra} FROM {src}) x) y WHERE rank <= {k}"""


SQL = {
    "als_fold_in_table": f"""WITH {I_CTE} SELECT "user", count(*) AS n_liked, true AS solved FROM I
WHERE item IN (SELECT vec_id FROM embeddings) GROUP BY "user" """,
    "report_fixed": f"""WITH {I_CTE}, {E_CTE}, {ROLES_CTE}, {PAIRS_CTE},
c AS (SELECT * FROM scores s WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t."user" = s."user" AND t.item = s.item)),
top AS (SELECT "user", item FROM (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY round(score, 6) DESC, item) AS r FROM c) WHERE r <= {TOP_K}),
hits AS (SELECT "user", count(*) AS h FROM top JOIN test USING ("user", item) GROUP BY "user"),
npos AS (SELECT "user", count(*) AS n FROM test GROUP BY "user"),
pr AS (SELECT npos."user", coalesce(h, 0) / {float(TOP_K)} AS precision, coalesce(h, 0) / n AS recall FROM npos LEFT JOIN hits USING ("user")),
pos AS (SELECT s."user", s.item, round(s.score, 6) AS score FROM scores s JOIN test USING ("user", item)),
neg AS (SELECT s."user", s.item, round(s.score, 6) AS score FROM scores s
        WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p."user" = s."user" AND p.item = s.item)),
auc AS (SELECT p."user", sum(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0.0 END) / count(*) AS auc
        FROM pos p JOIN neg n ON p."user" = n."user" GROUP BY p."user")
SELECT round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall, round((SELECT avg(auc) FROM auc), 6) AS auc FROM pr""",
    "item_similarity_top10": f"""WITH {E_CTE},
s AS (SELECT a.id AS item, b.id AS neighbour, list_cosine_similarity(a.vec, b.vec) AS score
      FROM e a JOIN e b ON a.id <> b.id)
{_topk_sql('s', 'item', 'neighbour', TOP_K)}""",
    "similar_items": f"""WITH {E_CTE},
s AS (SELECT a.id AS item, b.id AS neighbour, list_cosine_similarity(a.vec, b.vec) AS score,
      b.label AS neighbour_label FROM e a JOIN e b ON a.id <> b.id)
{_topk_sql('s', 'item', 'neighbour', 5, ', neighbour_label')}""",
    "recommend_unseen_fixed": f"""WITH {I_CTE}, {E_CTE}, {ROLES_CTE}, {PAIRS_CTE},
c AS (SELECT * FROM scores s WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t."user" = s."user" AND t.item = s.item))
{_topk_sql('c', '"user"', 'item', TOP_K)}""",
    "recommend_unseen_pruned": f"""WITH {I_CTE}, {E_CTE}, {ROLES_CTE}, {PAIRS_CTE},
n AS (SELECT e.id, count(I.item) AS n FROM e LEFT JOIN I ON I.item = e.id GROUP BY e.id),
r AS (SELECT id, row_number() OVER (ORDER BY n DESC, id) AS r FROM n),
fp AS (SELECT e.id, list_transform(e.vec, lambda x: x / sqrt(r.r)) AS vec FROM e JOIN r USING (id)),
c AS (SELECT fu.id AS "user", fp.id AS item, list_inner_product(fu.vec, fp.vec) AS score FROM fu JOIN fp ON fu.id <> fp.id
      WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t."user" = fu.id AND t.item = fp.id))
{_topk_sql('c', '"user"', 'item', TOP_K)}""",
    "recommend_users_for_item": f"""WITH {E_CTE}, {ROLES_CTE},
s AS (SELECT fi.id AS item, fu.id AS "user", list_inner_product(fu.vec, fi.vec) AS score FROM fu JOIN fi ON fu.id <> fi.id)
{_topk_sql('s', 'item', '"user"', 5)}""",
    "precision_recall_at_10": f"""WITH {I_CTE}, {E_CTE}, {ROLES_CTE}, {PAIRS_CTE},
c AS (SELECT * FROM scores s WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t."user" = s."user" AND t.item = s.item)),
top AS (SELECT "user", item FROM (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY round(score, 6) DESC, item) AS r FROM c) WHERE r <= {TOP_K}),
hits AS (SELECT "user", count(*) AS h FROM top JOIN test USING ("user", item) GROUP BY "user"),
npos AS (SELECT "user", count(*) AS n FROM test GROUP BY "user")
SELECT npos."user", round(coalesce(h, 0) / {float(TOP_K)}, 6) AS precision, round(coalesce(h, 0) / n, 6) AS recall
FROM npos LEFT JOIN hits USING ("user")""",
    "auc_per_user": f"""WITH {I_CTE}, {E_CTE}, {ROLES_CTE}, {PAIRS_CTE},
pos AS (SELECT s."user", s.item, round(s.score, 6) AS score FROM scores s JOIN test USING ("user", item)),
neg AS (SELECT s."user", s.item, round(s.score, 6) AS score FROM scores s
        WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p."user" = s."user" AND p.item = s.item)),
cmp AS (SELECT p."user", sum(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0.0 END) AS wins,
        count(*) AS n_cmp FROM pos p JOIN neg n ON p."user" = n."user" GROUP BY p."user")
SELECT "user", round(wins / n_cmp, 6) AS auc FROM cmp""",
    "items_for_feature": f"""WITH {E_CTE}, {TAGS_CTE},
s AS (SELECT t.feature, e.id AS item, list_cosine_similarity(t.vec, e.vec) AS score FROM tags t, e)
{_topk_sql('s', 'feature', 'item', TOP_K)}""",
    "items_for_summed_features": f"""WITH {E_CTE}, {SIDE_CTE}, {FEATURES_CTE},
u AS (SELECT id AS item, unnest(range(1, len(vec) + 1)) AS pos, unnest(vec) AS x FROM e),
fe AS (SELECT feature, pos, sum(x) AS x FROM feats JOIN u USING (item) GROUP BY feature, pos),
w AS (SELECT item, 1.0::DOUBLE / count(*) AS w FROM feats GROUP BY item),
ie AS (SELECT item, pos, sum(w * x) AS x FROM feats JOIN w USING (item) JOIN fe USING (feature) GROUP BY item, pos),
fv AS (SELECT feature, list(x ORDER BY pos) AS vec FROM fe WHERE starts_with(feature, 'brand_') GROUP BY feature),
iv AS (SELECT item, list(x ORDER BY pos) AS vec FROM ie GROUP BY item),
s AS (SELECT feature, item, list_cosine_similarity(fv.vec, iv.vec) AS score FROM fv, iv)
{_topk_sql('s', 'feature', 'item', TOP_K)}""",
    "suggest_features": f"""WITH {E_CTE}, {TAGS_CTE},
s AS (SELECT e.id AS item, t.feature, list_cosine_similarity(e.vec, t.vec) AS score FROM e, tags t
      WHERE NOT EXISTS (SELECT 1 FROM itags x WHERE x.item = e.id AND x.feature = t.feature))
{_topk_sql('s', 'item', 'feature', 3)}""",
    "similar_features": f"""WITH {E_CTE}, {TAGS_CTE},
s AS (SELECT a.feature, b.feature AS neighbour, list_cosine_similarity(a.vec, b.vec) AS score
      FROM tags a JOIN tags b ON a.feature <> b.feature)
{_topk_sql('s', 'feature', 'neighbour', 3)}""",
    "item_features_of": f"""WITH {E_CTE}, {TAGS_CTE},
s AS (SELECT t.feature, e.id AS item, list_cosine_similarity(t.vec, e.vec) AS score FROM tags t, e),
top AS ({_topk_sql('s', 'feature', 'item', TOP_K)})
SELECT item, feature FROM itags WHERE item IN (SELECT item FROM top)""",
}
