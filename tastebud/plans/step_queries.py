"""One training step of the ranking models from fixed state, with the whole step in SQL.

State: every vector of ``embeddings`` is a user and an item; items have small biases, and for WARP
each item also has its tag (the label) as a second feature of weight 0.5.  Accumulators start at 1,
so that a step depends smoothly on its gradient.  Pairs are the interactions whose user and item
have vectors, weighted by item; for the logistic loss a fifth of them are explicit negatives.
Draws are md5 prefixes.  Rows: one per side, feature and component (0 is the bias).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rank_mf
from ..operators.encode import index_ids
from ..session import cut_lineage
from ..sources import tables
from .catalog import I_CTE, SEED
from .fixed import E_CTE, TAG_PREFIX

LR, USER_ALPHA, ITEM_ALPHA, DRAWS, TAG_WEIGHT, TAG_BIAS = 0.05, 0.01, 0.02, 10, 0.5, 0.05
LOSSES = ("bpr", "logistic", "warp")


def _state(rows):
    """``feature, vec, bias`` with accumulators of 1."""
    return cut_lineage(rows.select("feature", "vec", "bias", F.transform("vec", lambda x: F.lit(1.0)).alias("g2v"), F.lit(1.0).alias("g2b")))


def _components(state, side):
    parts = F.posexplode(F.arrays_zip(F.concat(F.array("bias"), "vec").alias("x"), F.concat(F.array("g2b"), "g2v").alias("g2")))
    return state.select(F.lit(side).alias("side"), F.col("feature").cast("string").alias("feature"), parts.alias("component", "v")).select(
        "side", "feature", "component", F.round("v.x", 6).alias("value"), F.round("v.g2", 6).alias("grad2"))


def _step(spark, d, loss):
    emb = tables.embedding_vectors(spark, d)
    users = emb.select(F.col("id").alias("feature"), "vec", F.lit(0.0).alias("bias"))
    bias = ((F.pmod("id", F.lit(7)) - 3) * F.lit(0.1)).alias("bias")
    own = emb.select(F.col("id").cast("string").alias("feature") if loss == "warp" else F.col("id").alias("feature"), "vec", bias)
    features = None
    if loss == "warp":
        tag = F.concat(F.lit(TAG_PREFIX), F.col("label").cast("string"))
        own = own.unionByName(emb.groupBy(tag.alias("feature")).agg(F.min_by("vec", "id").alias("vec"), F.lit(TAG_BIAS).alias("bias")))
        item = F.col("id").alias("item")
        features = cut_lineage(emb.select(item, F.col("id").cast("string").alias("feature"), F.lit(1.0).alias("weight"))
                               .unionByName(emb.select(item, tag.alias("feature"), F.lit(TAG_WEIGHT).alias("weight"))))
    index = index_ids(emb.select(F.col("id").alias("item")), "item")
    size = emb.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dim")).first()
    params = dict(dim=size.dim, loss=loss, learning_rate=LR, seed=SEED, user_alpha=USER_ALPHA, item_alpha=ITEM_ALPHA, max_sampled=DRAWS, draw_hash="md5")
    model = rank_mf.RankMF(_state(users), _state(own), None, features, index, size.n, None, params)
    ids = emb.select("id")
    pairs = (tables.likes(spark, d).join(ids.select(F.col("id").alias("user")), "user", "left_semi").join(ids.select(F.col("id").alias("item")), "item", "left_semi")
             .withColumn("w", F.lit(1.0) + F.pmod("item", F.lit(3)) * F.lit(0.5)))
    if loss == "logistic":
        pairs = pairs.withColumn("y", F.when(F.pmod(F.col("user") + F.col("item"), F.lit(5)) == 0, -1).otherwise(1))
    model = rank_mf.training_step(model, pairs, "w", "y" if loss == "logistic" else None)
    return _components(model.user_state, "user").unionByName(_components(model.item_state, "item"))


QUERIES = {f"{loss}_step_fixed": (lambda spark, d, loss=loss: _step(spark, d, loss)) for loss in LOSSES}


def _sql(loss: str) -> str:
    warp = loss == "warp"
    y = "CASE WHEN (\"user\" + item) % 5 = 0 THEN -1 ELSE 1 END" if loss == "logistic" else "1"
    tag = f"'{TAG_PREFIX}' || CAST(label AS VARCHAR)"
    tag_state = f" UNION ALL SELECT {tag}, arg_min(vec, id), {TAG_BIAS}::DOUBLE FROM e GROUP BY label" if warp else ""
    tag_features = f" UNION ALL SELECT id, {tag}, {TAG_WEIGHT}::DOUBLE FROM e" if warp else ""
    sig = lambda x: f"1.0::DOUBLE / (1.0::DOUBLE + exp(-({x})))"
    ci, cj = {"bpr": (f"-{sig('sj - si')}", sig("sj - si")), "logistic": (f"-{sig('-si')}", sig("sj")),
              "warp": ("-ln(greatest(1.0, floor((n - 1)::DOUBLE / (t + 1))))", "ln(greatest(1.0, floor((n - 1)::DOUBLE / (t + 1))))")}[loss]
    margin = " AND sj > si - 1.0" if warp else ""
    against = f" UNION ALL SELECT \"user\", item, item, {sig('si')} * w, 0.0::DOUBLE FROM s WHERE y < 0" if loss == "logistic" else ""
    return f"""WITH {I_CTE}, {E_CTE},
lab AS (SELECT "user", item, {y} AS y, 1.0::DOUBLE + (item % 3) * 0.5::DOUBLE AS w
        FROM (SELECT DISTINCT "user", item FROM I WHERE "user" IN (SELECT id FROM e) AND item IN (SELECT id FROM e))),
idx AS (SELECT id AS item, row_number() OVER (ORDER BY id) - 1 AS idx, count(*) OVER () AS n FROM e),
st AS (SELECT CAST(id AS VARCHAR) AS feature, vec, ((id % 7) - 3) * 0.1::DOUBLE AS bias FROM e{tag_state}),
ist AS (SELECT feature, unnest(range(0, len(vec) + 1)) AS pos, unnest(list_concat([bias], vec)) AS x FROM st),
ust AS (SELECT id AS "user", unnest(range(0, len(vec) + 1)) AS pos, unnest(list_concat([0.0::DOUBLE], vec)) AS x FROM e),
feats AS (SELECT id AS item, CAST(id AS VARCHAR) AS feature, 1.0::DOUBLE AS weight FROM e{tag_features}),
irep AS (SELECT item, pos, sum(weight * x) AS x FROM feats JOIN ist USING (feature) GROUP BY item, pos),
iv AS (SELECT item, list(x ORDER BY pos) FILTER (WHERE pos > 0) AS vec, sum(CASE WHEN pos = 0 THEN x END) AS bias FROM irep GROUP BY item),
s AS (SELECT lab.*, e.vec AS uv, list_inner_product(e.vec, iv.vec) + iv.bias AS si FROM lab JOIN e ON e.id = lab."user" JOIN iv ON iv.item = lab.item),
drawn AS (SELECT *, CAST('0x' || substr(md5('{SEED}|0|0|' || CAST("user" AS VARCHAR) || '|' || CAST(item AS VARCHAR) || '|' || CAST(t AS VARCHAR)), 1, 15) AS BIGINT)
            % (SELECT count(*) FROM e) AS jidx FROM (SELECT *, unnest(range(0, {DRAWS if warp else 1})) AS t FROM s WHERE y > 0)),
c AS (SELECT d."user", d.item, d.w, d.si, d.t, idx.n, idx.item AS j, list_inner_product(d.uv, iv.vec) + iv.bias AS sj
      FROM drawn d JOIN idx ON idx.idx = d.jidx JOIN iv ON iv.item = idx.item),
v AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM lab WHERE lab.y > 0 AND lab."user" = c."user" AND lab.item = c.j){margin}),
f AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY "user", item ORDER BY t) = 1),
g AS (SELECT "user", item, j, {ci} * w AS ci, {cj} * w AS cj FROM f{against}),
il AS (SELECT item, pos, CASE WHEN pos = 0 THEN 1.0 ELSE x END AS x FROM irep),
ul AS (SELECT "user", pos, CASE WHEN pos = 0 THEN 1.0 ELSE x END AS x FROM ust),
ug AS (SELECT "user", pos, sum(d) AS d FROM (SELECT g."user", pos, ci * x AS d FROM g JOIN il USING (item)
       UNION ALL SELECT g."user", pos, cj * x FROM g JOIN il ON il.item = g.j) GROUP BY "user", pos),
ig AS (SELECT feature, pos, sum(weight * d) AS d FROM (SELECT g.item, pos, ci * x AS d FROM g JOIN ul USING ("user")
       UNION ALL SELECT g.j, pos, cj * x FROM g JOIN ul USING ("user")) JOIN feats USING (item) GROUP BY feature, pos),
a AS (SELECT 'user' AS side, CAST("user" AS VARCHAR) AS feature, pos, x, d + CASE WHEN pos = 0 THEN 0 ELSE {USER_ALPHA}::DOUBLE * x END AS d FROM ust LEFT JOIN ug USING ("user", pos)
      UNION ALL SELECT 'item', feature, pos, x, d + CASE WHEN pos = 0 THEN 0 ELSE {ITEM_ALPHA}::DOUBLE * x END FROM ist LEFT JOIN ig USING (feature, pos))
SELECT side, feature, component, CASE WHEN value = 0 THEN 0.0 ELSE value END AS value, grad2 FROM (
SELECT side, feature, CAST(pos AS INTEGER) AS component,
  round(CASE WHEN d IS NULL THEN x ELSE x - {LR}::DOUBLE * d / (sqrt(1.0::DOUBLE + d * d) + 1e-6::DOUBLE) END, 6) AS value,
  round(CASE WHEN d IS NULL THEN 1.0::DOUBLE ELSE 1.0::DOUBLE + d * d END, 6) AS grad2 FROM a)"""


SQL = {f"{loss}_step_fixed": _sql(loss) for loss in LOSSES}
