"""Exact top-k by inner product that skips blocks which can't hold a winner.

``blocks.block_top_k`` scores every pair.  Here the right rows are sorted by falling norm and cut
into blocks, so that by Cauchy-Schwarz no row of a block scores above ``|left| * (norm of the
block's first row)``.  Blocks are visited in rounds of growing width: the first block, then
``growth`` times as many, and so on.  After a round each left row knows its ``k``-th best score so
far, and it goes on only to those blocks whose bound reaches that score; as the bounds fall, these
are a prefix of the blocks left.  A left row that reaches none is finished and doesn't move again.

The result equals that of ``block_top_k``: a block is skipped only when its bound is *below* the
``k``-th score (equal scores may still win by their key), bounds get a relative margin for the
rounding of norms, and where scores are compared after rounding to ``decimals`` a step of the last
place.  Left rows with fewer than ``k`` candidates visit every block.

Cost: a round shuffles its open left rows once per block they need and its right rows once per
block of open left rows.  With equal norms (cosine) nothing can be skipped and ``block_top_k`` is
the better choice.  State between rounds is written to the checkpoint folder; the driver reads one
number per block and two sums per round.  A hot left key's exclusions are spread over the blocks
of its items.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectors import l2_norm
from ..session import cut_lineage
from .blocks import MIN_BLOCK_ROWS, _block, _local_best, _masked_scores, _pair_cols, _prepare, _sliced
from .encode import index_by_order

RIGHT_BLOCK_ROWS = 4096
LEFT_BLOCK_ROWS = 16384
GROWTH = 4
NORM_MARGIN = 1e-9  # relative: far above the rounding of a norm, far below any useful difference

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class PrunedTopK:
    """``rows`` as of ``block_top_k``; ``scored`` of ``total`` (left row, right block) pairs were scored."""

    rows: DataFrame
    scored: int
    total: int

    @property
    def skipped(self) -> float:
        return 1.0 - self.scored / self.total if self.total else 0.0


def _kernel(k: int, decimals: int | None, exclude_self: bool, slack: float, out_schema: T.StructType):
    names = out_schema.names

    def one_slice(lpdf, start: int, right):
        part, lkeys, rkeys, s, valid = _masked_scores(lpdf, start, right, exclude_self)
        valid &= s >= (part["floor"].to_numpy() - slack)[:, None]
        return _local_best(lkeys, rkeys, s, valid, k, decimals, names)

    return _sliced(one_slice, names)


def _norm_blocks(rside: DataFrame, block_rows: int) -> tuple[DataFrame, list[float]]:
    """Right rows with ``blk`` (0 holds the longest vectors), written, and each block's largest norm."""
    ordered = index_by_order(rside.withColumn("norm", l2_norm("vec")), [F.col("norm").desc(), F.col("rk")], "_i")
    ranked = cut_lineage(ordered.select("rk", "vec", "norm", F.floor(F.col("_i") / block_rows).cast("int").alias("blk")))
    heads = ranked.groupBy("blk").agg(F.max("norm").alias("head")).orderBy("blk").collect()
    return ranked, [float(r["head"]) for r in heads]


def _reach(heads: list[float], slack: float):
    """Number of the given blocks (falling norms) whose bound reaches the row's floor."""
    bounds = F.split(F.lit(",".join(map(repr, heads))), ",").cast("array<double>")
    return F.size(F.filter(bounds, lambda h: h * F.col("norm") * (1.0 + NORM_MARGIN) + slack >= F.col("floor")))


def _left_blocks(n_open: int, n_right: int, block_rows: int, tasks: int) -> int:
    fewest = max(1, math.ceil(n_open / block_rows))
    most = max(fewest, n_open // MIN_BLOCK_ROWS)
    return min(most, max(fewest, math.ceil(tasks / n_right)))


def pruned_top_k(left: DataFrame, right: DataFrame, k: int, *, left_key: str, right_key: str,
                 left_vec: str = "vec", right_vec: str = "vec", exclude: DataFrame | None = None,
                 exclude_self: bool = False, decimals: int | None = None,
                 block_rows: int = RIGHT_BLOCK_ROWS, left_block_rows: int = LEFT_BLOCK_ROWS, growth: int = GROWTH,
                 out_left: str | None = None, out_right: str | None = None,
                 score_col: str = "score", rank_col: str = "rank") -> PrunedTopK:
    """Top ``k`` right rows per left row by inner product; arguments, ties and columns as ``block_top_k``.

    Left keys are distinct.  Vectors that aren't finite raise: an infinite or undefined norm sorts
    first, and the first block is scored by every left row.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    if block_rows <= 0 or left_block_rows <= 0 or growth < 1:
        raise ValueError("block_rows and left_block_rows must be positive, growth at least 1")
    out_left, out_right = out_left or left_key, out_right or right_key
    lside, rside = _prepare(left, right, left_key, right_key, left_vec, right_vec, "dot")
    lk_type, rk_type = lside.schema["lk"].dataType, rside.schema["rk"].dataType
    schema = T.StructType([T.StructField("lk", lk_type), T.StructField("rk", rk_type),
                           T.StructField("score", T.DoubleType())])
    slack = 10.0 ** -decimals if decimals is not None else 0.0
    spark = left.sparkSession
    ranked, heads = _norm_blocks(rside, block_rows)
    placeholder = F.lit("").cast(lk_type) if isinstance(lk_type, T.StringType) else F.lit(0).cast(lk_type)
    routed = None
    if exclude is not None:
        ex = _pair_cols(exclude).select(F.col("lk").cast(lk_type).alias("xl"), F.col("rk").cast(rk_type).alias("rk"))
        routed = cut_lineage(ex.join(ranked.select("rk", "blk"), "rk"))
    compared = F.round("score", decimals) if decimals is not None else F.col("score")
    best_first = Window.partitionBy("lk").orderBy(compared.desc(), F.col("rk").asc())
    open_rows = cut_lineage(lside.select("lk", "vec", l2_norm("vec").alias("norm"), F.lit(float("-inf")).alias("floor")))
    top = spark.createDataFrame([], schema).withColumn("rank", F.lit(0))
    n_left, scored, lo, width = None, 0, 0, 1
    while lo < len(heads):
        hi = min(lo + width, len(heads))
        reach = _reach(heads[lo:hi], slack)
        n_open, pairs = open_rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(reach), F.lit(0))).first()
        n_left = n_open if n_left is None else n_left
        if not pairs:
            break
        scored += pairs
        a = _left_blocks(n_open, hi - lo, left_block_rows, 2 * spark.sparkContext.defaultParallelism)
        lrep = (open_rows.withColumn("_n", reach).where("_n > 0").withColumn("lb", _block("lk", a))
                .select("lb", F.explode(F.sequence(F.lit(lo), F.lit(lo - 1) + F.col("_n"))).alias("rb"), "lk", "vec", "floor"))
        rrep = (ranked.where(F.col("blk").between(lo, hi - 1))
                .select(F.explode(F.sequence(F.lit(0), F.lit(a - 1))).alias("lb"), F.col("blk").alias("rb"), "rk", "vec",
                        F.lit(False).alias("ex"), placeholder.alias("xl")))
        if routed is not None:
            here = routed.where(F.col("blk").between(lo, hi - 1))
            if lo:  # of rows still open only
                here = here.join(open_rows.select(F.col("lk").alias("xl")), "xl", "left_semi")
            rrep = rrep.unionByName(here.select(_block("xl", a).alias("lb"), F.col("blk").alias("rb"), "rk",
                                                F.lit(None).cast("array<double>").alias("vec"), F.lit(True).alias("ex"), "xl"))
        found = (lrep.groupBy("lb", "rb").cogroup(rrep.groupBy("lb", "rb"))
                 .applyInPandas(_kernel(k, decimals, exclude_self, slack, schema), schema))
        merged = top.select("lk", "rk", "score").unionByName(found)
        top = cut_lineage(merged.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k))
        if hi == len(heads):
            break
        floors = top.where(F.col("rank") == k).select("lk", F.col("score").alias("floor"))
        nxt = (open_rows.drop("floor").join(floors, "lk", "left")
               .withColumn("floor", F.coalesce("floor", F.lit(float("-inf")))))
        open_rows = cut_lineage(nxt.where(_reach(heads[hi:hi + 1], slack) > 0))
        lo, width = hi, width * growth
    rows = top.select(F.col("lk").alias(out_left), F.col("rk").alias(out_right), F.col("score").alias(score_col),
                      F.col("rank").cast("long").alias(rank_col))
    return PrunedTopK(rows, int(scored), int(n_left or 0) * len(heads))
