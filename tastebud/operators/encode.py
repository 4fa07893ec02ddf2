"""Id mapping and feature encoding.

``index_by_order`` is the distributed replacement for a global
``row_number() OVER (ORDER BY k)`` (which Spark would run in one partition):
range-partition on the key, sort inside each partition, checkpoint, count rows per
partition, and add each partition's offset.  The offsets table has one row per
partition, so broadcasting it is bounded by the partition count, not the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import feature_key
from ..session import cut_lineage


def index_by_order(df: DataFrame, order: list[Column | str], out: str = "idx",
                   num_partitions: int | None = None) -> DataFrame:
    """Attach a 0-based position in the total order ``order`` (rows must be distinct on it)."""
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    # Without an explicit count AQE may coalesce the range partitions; it only merges
    # adjacent ranges, so partition order still follows the key order.
    ranged = (df.repartitionByRange(num_partitions, *order_cols) if num_partitions
              else df.repartitionByRange(*order_cols))
    ranged = (ranged.sortWithinPartitions(*order_cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    # Freeze partition ids / local positions before reading them twice.
    ranged = cut_lineage(ranged)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (ranged.join(F.broadcast(offsets), "_pid")
            .withColumn(out, (F.col("_off") + local).cast("long"))
            .drop("_pid", "_mid", "_off"))


def index_ids(df: DataFrame, col: str, out: str = "idx", num_partitions: int | None = None) -> DataFrame:
    """Bijection ``col`` <-> 0..n-1 in sorted id order; one table serves both directions."""
    ids = df.select(col).distinct()
    return index_by_order(ids, [col], out, num_partitions).select(col, out)


def apply_index(df: DataFrame, user_map: DataFrame, item_map: DataFrame,
                user: str = "user", item: str = "item", value: str | None = None) -> DataFrame:
    """(row, col, value) triples on the mapped indices; duplicate pairs add up
    (value 1.0 per row when ``value`` is None, as a COO matrix of ones)."""
    v = F.col(value).cast("double") if value else F.lit(1.0)
    return (df.select(user, item, v.alias("_v"))
            .join(user_map.select(user, F.col("idx").alias("row")), user)
            .join(item_map.select(item, F.col("idx").alias("col")), item)
            .groupBy("row", "col").agg(F.sum("_v").alias("value")))


def item_dictionary(items: DataFrame, key: str = "item", name: str = "title",
                    order: str = "row_order") -> DataFrame:
    """id -> name where the last duplicate (highest ``order``) wins."""
    return items.groupBy(key).agg(F.max_by(name, order).alias(name))


def encode_features(side: DataFrame, item_map: DataFrame | None = None, key: str = "item") -> DataFrame:
    """One-hot item features from ``key, type, value`` rows.

    Feature name = ``type_`` + lower(value); duplicates collapse to weight 1; the
    vocabulary is sorted by name and indexed 0..F-1.  With ``item_map`` only mapped
    items are kept.
    """
    rows = side
    if item_map is not None:
        rows = rows.join(item_map.select(key), key, "left_semi")
    pairs = rows.select(F.col(key), feature_key("type", "value").alias("feature")).distinct()
    vocab = index_by_order(pairs.select("feature").distinct(), ["feature"], "feature_idx")
    return (pairs.join(vocab, "feature")
            .select(key, "feature", "feature_idx", F.lit(1.0).alias("weight")))


def features_to_vector(df: DataFrame, n_features: int, key: str = "item",
                       idx: str = "feature_idx", weight: str = "weight") -> DataFrame:
    """``key, features``: one MLlib sparse vector per entity, for MLlib estimators, built in the JVM.

    Weights of repeated (entity, index) rows add up, as in a COO matrix, and sums of 0 stay stored;
    rows with a null index or weight don't count, an entity with no others has an empty vector.  An
    index outside 0..n_features-1 is an error, as is a weight that isn't finite.  The vector is read from its fields with
    ``from_json`` under MLlib's own type (doubles are written with all their digits), so no Python runs.
    """
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql import types as T

    i, w = F.col(idx).cast("long"), F.col(weight).cast("double")
    finite = ~F.isnan(w) & (F.abs(w) < float("inf"))
    checked = F.when((i >= 0) & (i < n_features) & finite, i.cast("int")).otherwise(F.raise_error(F.concat(
        F.lit(f"feature index outside 0..{n_features - 1} or weight not finite: "), i.cast("string"), F.lit(", "), w.cast("string"))).cast("int"))
    known = i.isNotNull() & w.isNotNull()
    cells = (df.select(F.col(key), F.when(known, checked).alias("_i"), F.when(known, w).alias("_w"))
             .groupBy(key, "_i").agg(F.sum("_w").alias("_w")))
    # structs with a null index are dropped by the conditional, which collect_list skips
    rows = F.array_sort(F.collect_list(F.when(F.col("_i").isNotNull(), F.struct("_i", "_w"))))
    grouped = cells.groupBy(key).agg(rows.alias("_r"))
    fields = F.struct(F.struct(F.lit(0).alias("type"), F.lit(n_features).alias("size"),
                               F.col("_r._i").alias("indices"), F.col("_r._w").alias("values")).alias("features"))
    schema = T.StructType([T.StructField("features", VectorUDT())])
    return grouped.select(key, F.from_json(F.to_json(fields), schema, {"mode": "FAILFAST"})["features"].alias("features"))


def feature_options(features: DataFrame, min_items: int | None = None, normalise: bool = False,
                    max_item_interactions: int | None = None, inter: DataFrame | None = None,
                    key: str = "item") -> DataFrame:
    """Optional feature treatments named in the reference's prose:

    * ``min_items``: keep features used by at least that many items;
    * ``normalise``: weight = 1 / number of features of the item;
    * ``max_item_interactions``: features only for items with at most that many
      interactions in ``inter`` (cold items).
    """
    out = features
    if min_items is not None:
        keep = (out.groupBy("feature").agg(F.countDistinct(key).alias("_n"))
                .where(F.col("_n") >= min_items).select("feature"))
        out = out.join(keep, "feature", "left_semi")
    if max_item_interactions is not None:
        if inter is None:
            raise ValueError("max_item_interactions needs the interaction table")
        counts = inter.groupBy(key).agg(F.count(F.lit(1)).alias("_c"))
        hot = counts.where(F.col("_c") > max_item_interactions).select(key)
        out = out.join(hot, key, "left_anti")
    if normalise:
        per_item = out.groupBy(key).agg(F.count(F.lit(1)).alias("_k"))
        out = out.join(per_item, key).withColumn("weight", F.lit(1.0) / F.col("_k")).drop("_k")
    return out

