"""Blocked all-pairs scoring with a local top-k.

Scoring every user against every item is inherently |U| x |I| multiply-adds; what
must not happen is materialising those pairs as rows or holding one side in one task.
``block_top_k``:

* left rows are dealt into A groups by a hash of their key, at most ``LEFT_BLOCKS * block_rows``
  each and about twice as many groups as the cluster runs tasks at once; right rows are repeated
  once per group (where A groups are too few, right rows are dealt into B parts as well).  So a side
  is shuffled about as often as there are tasks, not once per block of the other;
* a group's task holds its left rows and the best ``k`` of each; right rows stream by, sorted into
  steps of about ``STEP_ROWS`` by a hash of their key, and leave nothing behind but new bests;
* optional exclusion pairs (items a user already has) travel to the step of their right key, so a
  user with a huge history is spread over all steps;
* pairs are scored in single precision first; only those within its error bound of the left row's
  ``k``-th best so far are scored again in double precision and ranked.  A group returns ``k`` rows
  per left row, and the final ``row_number <= k`` per left key only has to merge the B parts.

``block_auc`` and ``block_metrics`` cut both sides into hash blocks of about ``block_rows`` rows and
co-group them on ``(lb, rb)``; a task holds one block of each side and scores at most
``SLICE_CELLS`` pairs at a time.

Ties: equal scores are broken by the right key ascending -- the same rule in the numpy
kernels and in the final window, so the local cut never drops a row the global ranking would
keep.  With ``decimals`` scores are compared after rounding (what SQL comparisons need); the
default compares them as they are.  A score that is not finite is an error: it means a
diverged model.
"""

from __future__ import annotations

import math
import sys
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectors import normalize
from ..session import cut_lineage

DEFAULT_BLOCK_ROWS = 16384
MIN_BLOCK_ROWS = 256
LEFT_BLOCKS = 4  # blocks of left rows that a group of block_top_k holds at most
STEP_ROWS, TILE_ROWS = 4096, 1024  # right rows that it meets at once, and that one matrix product scores
SLICE_ROWS = 512  # left rows scored per matrix product inside a group at most,
SLICE_CELLS = 1 << 20  # and scores of one product where a whole right block is scored: bound task memory
MANY_POSITIVES = 8  # left rows with more of them have their negatives sorted

# The pandas kernels below run on executors; ship this module's code with them so
# executors need numpy/pandas only, not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _n_blocks(n_rows: int, block_rows: int) -> int:
    return max(1, math.ceil(n_rows / block_rows))


def _block(col: str, n: int):
    return F.pmod(F.xxhash64(F.col(col)), F.lit(n)).cast("int")


def _prepare(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_vec: str,
             right_vec: str, metric: str, keep_floats: bool = False) -> tuple[DataFrame, DataFrame]:
    kinds = {dict(left.dtypes)[left_vec], dict(right.dtypes)[right_vec]}
    kind = "array<float>" if keep_floats and kinds == {"array<float>"} else "array<double>"
    lv = normalize(left_vec) if metric == "cosine" else F.col(left_vec).cast(kind)
    rv = normalize(right_vec) if metric == "cosine" else F.col(right_vec).cast(kind)
    return (left.select(F.col(left_key).alias("lk"), lv.alias("vec")),
            right.select(F.col(right_key).alias("rk"), rv.alias("vec")))


def _sizes(left: DataFrame, right: DataFrame, n_left: int | None, n_right: int | None) -> tuple[int, int]:
    if n_left is None and n_right is None:
        with ThreadPoolExecutor(max_workers=2) as pool:  # two independent count jobs
            fl, fr = pool.submit(left.count), pool.submit(right.count)
            return fl.result(), fr.result()
    return n_left if n_left is not None else left.count(), n_right if n_right is not None else right.count()


def _layout(spark, nl: int, nr: int, left_rows: int, right_rows: int | None = None) -> tuple[int, int]:
    """Block counts (A, B): blocks of at most ``left_rows`` and ``right_rows`` rows (None: any number),
    then split further (left side first: it only costs replicating the right side once more per block)
    until there are about twice as many groups as the cluster runs tasks at once,
    never below ``MIN_BLOCK_ROWS`` rows per block."""
    a, b = _n_blocks(nl, left_rows), _n_blocks(nr, right_rows) if right_rows else 1
    target = 2 * spark.sparkContext.defaultParallelism
    while a * b < target:
        if nl / (a + 1) >= MIN_BLOCK_ROWS:
            a += 1
        elif nr / (b + 1) >= MIN_BLOCK_ROWS:
            b += 1
        else:
            break
    return a, b


def spread_keys(spark, blocks: int) -> list[int]:
    """One key per block such that hash partitioning into ``blocks`` deals each its own partition."""
    keys: dict[int, int] = {}
    start, size = 0, 20 * blocks + 20
    while len(keys) < blocks:
        ids = spark.range(start, start + size).select(F.col("id").cast("int").alias("k"))
        for r in ids.groupBy(F.pmod(F.hash("k"), F.lit(blocks)).alias("p")).agg(F.min("k").alias("k")).collect():  # one row per block
            keys.setdefault(r.p, r.k)
        start, size = start + size, 2 * size
    return [keys[p] for p in range(blocks)]


def _replicate(df: DataFrame, own: str, own_n: int, other: str, other_n: int, key: str) -> DataFrame:
    out = df.withColumn(own, _block(key, own_n))
    if other_n == 1:
        return out.withColumn(other, F.lit(0))
    return out.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(other_n - 1))))


def _right_side(rside: DataFrame, exclude: DataFrame | None, a: int, b: int, lk_type: T.DataType) -> DataFrame:
    """Right factor rows (``ex`` false) plus exclusion pairs (``ex`` true, ``xl`` = left key).

    ``xl`` is never null (a typed placeholder on factor rows): a nullable integer
    column would reach pandas as float64 and lose ids above 2**53."""
    placeholder = F.lit("").cast(lk_type) if isinstance(lk_type, T.StringType) else F.lit(0).cast(lk_type)
    rows = _replicate(rside, "rb", b, "lb", a, "rk").select(
        "lb", "rb", "rk", "vec", F.lit(False).alias("ex"), placeholder.alias("xl"))
    if exclude is None:
        return rows
    ex = exclude.select(F.col("lk").cast(lk_type).alias("xl"),
                        F.col("rk").cast(dict(rows.dtypes)["rk"]).alias("rk"))
    ex = ex.select(_block("xl", a).alias("lb"), _block("rk", b).alias("rb"), "rk",
                   F.lit(None).cast("array<double>").alias("vec"), F.lit(True).alias("ex"), "xl")
    return rows.unionByName(ex)


def _pair_cols(pairs: DataFrame) -> DataFrame:
    """Pair tables are positional: first column = left key, second = right key."""
    a, b = pairs.columns[:2]
    return pairs.select(F.col(a).alias("lk"), F.col(b).alias("rk"))


def _stack(vecs: pd.Series) -> np.ndarray:
    return np.vstack([np.asarray(v, dtype=np.float64) for v in vecs.values])


def _right_data(lpdf: pd.DataFrame, rpdf: pd.DataFrame):
    """Per group, once: right keys, right matrix, and the excluded (left row, right row) positions by left row."""
    is_ex = rpdf["ex"].to_numpy(dtype=bool)
    items = rpdf[~is_ex]
    if len(items) == 0 or len(lpdf) == 0:
        return None
    rkeys = items["rk"].to_numpy()
    ex = rpdf[is_ex][["xl", "rk"]]
    if len(ex):
        # left keys may repeat (one row per chunk of positives): map through a merge
        rpos = pd.DataFrame({"rk": rkeys, "ri": np.arange(len(rkeys))})
        lpos = pd.DataFrame({"xl": lpdf["lk"].to_numpy(), "li": np.arange(len(lpdf))})
        hit = ex.merge(lpos, on="xl").merge(rpos, on="rk").sort_values("li")
        out = hit["li"].to_numpy(), hit["ri"].to_numpy()
    else:
        out = np.zeros(0, np.int64), np.zeros(0, np.int64)
    return rkeys, _stack(items["vec"]), out


def _slice_rows(n_right: int) -> int:
    return max(1, min(SLICE_ROWS, SLICE_CELLS // max(n_right, 1)))


def _masked_scores(lpdf: pd.DataFrame, start: int, right, exclude_self: bool):
    """Left keys, scores and validity of the left rows from ``start`` on (one slice)."""
    rkeys, rmat, (li, ri) = right
    part = lpdf.iloc[start:start + _slice_rows(len(rkeys))]
    lkeys = part["lk"].to_numpy()
    s = _stack(part["vec"]) @ rmat.T
    if not np.isfinite(s).all():
        raise ValueError("scores are not finite: the factors have diverged")
    valid = lkeys[:, None] != rkeys[None, :] if exclude_self else np.ones(s.shape, dtype=bool)
    a, b = np.searchsorted(li, [start, start + len(part)])
    valid[li[a:b] - start, ri[a:b]] = False
    return part, lkeys, rkeys, s, valid


def _sliced(one_slice, names):
    def kernel(lpdf: pd.DataFrame, rpdf: pd.DataFrame) -> pd.DataFrame:
        right = _right_data(lpdf, rpdf)
        if right is None:
            return pd.DataFrame({n: [] for n in names})
        parts = [one_slice(lpdf, i, right) for i in range(0, len(lpdf), _slice_rows(len(right[0])))]
        return pd.concat(parts, ignore_index=True)
    return kernel


def _local_best(lkeys, rkeys, s, valid, k: int, decimals: int | None, names) -> pd.DataFrame:
    """The best ``k`` valid right rows of each left row by (score desc, key asc)."""
    r = np.round(s, decimals) if decimals is not None else s.copy()
    r[~valid] = -np.inf
    if r.shape[1] > k:
        # k-th best rounded score per row; keep everything at least that good
        # (ties included), then order exactly by (score desc, key asc).
        kth = -np.partition(-r, k - 1, axis=1)[:, k - 1]
        keep = (r >= kth[:, None]) & valid
    else:
        keep = valid
    rows, cols = np.nonzero(keep)
    cand = pd.DataFrame({"row": rows, "r": r[rows, cols], "rk": rkeys[cols], "s": s[rows, cols]})
    cand = cand.sort_values(["row", "r", "rk"], ascending=[True, False, True], kind="mergesort")
    cand = cand.groupby("row", sort=False).head(k)
    return pd.DataFrame({names[0]: lkeys[cand["row"].to_numpy()], names[1]: cand["rk"].to_numpy(),
                         names[2]: cand["s"].to_numpy()})


def _key_array(keys) -> np.ndarray:
    """Integers as int64, anything else (and null) as objects."""
    if pa.types.is_integer(keys.type) and not keys.null_count:
        return keys.to_numpy(zero_copy_only=False).astype(np.int64)
    return np.array([*keys.to_pylist(), None], dtype=object)[:-1]


def _matrix(vecs) -> np.ndarray:
    if vecs.null_count:
        raise ValueError("a vector is null")
    return np.asarray(vecs.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(vecs), -1)


def _at_set(mask: np.ndarray) -> np.ndarray:
    """Flat positions of the set cells of a mask most of whose bytes are 0: eight are looked at at once."""
    if mask.shape[1] % 8:
        return np.flatnonzero(mask)
    some = np.flatnonzero(mask.view(np.uint64))
    return (some[:, None] * 8 + np.arange(8))[mask.reshape(-1, 8)[some]]


class _Best:
    """The best ``k`` right rows met so far of each left row of a group."""

    def __init__(self, lkeys, lmat: np.ndarray, k: int, decimals: int | None, exclude_self: bool):
        n = len(lkeys)
        self.lkeys, self.lmat, self.k, self.decimals, self.exclude_self = lkeys, lmat, k, decimals, exclude_self
        self.own = _key_array(lkeys) if exclude_self else None
        self.norms, self.single = np.sqrt(np.einsum("nd,nd->n", lmat, lmat)), lmat.astype(np.float32)
        self.rounded, self.scores = np.full((n, k), -np.inf), np.zeros((n, k))
        self.keys = np.zeros((n, k), np.int64)
        self.least = np.full(n, -np.inf)  # a row's k-th best, -inf while it has fewer

    def _excluded(self, xl, xr, rkeys) -> np.ndarray:
        """Sorted left row * right rows + right row of the excluded pairs (keys may repeat on either side)."""
        if not len(xl):
            return np.zeros(0, np.int64)
        sides = []
        for keys, mine, name in ((xl, self.lkeys, "l"), (xr, rkeys, "r")):
            codes = pa.concat_arrays([mine, keys]).dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
            sides.append((codes[len(mine):], pd.DataFrame({name: codes[:len(mine)], f"{name}i": np.arange(len(mine))})))
        (l, lpos), (r, rpos) = sides
        hit = pd.DataFrame({"l": l, "r": r}).merge(rpos, on="r").merge(lpos, on="l")
        return np.sort(hit["li"].to_numpy(np.int64) * len(rkeys) + hit["ri"].to_numpy(np.int64))

    def add(self, rkeys, rmat: np.ndarray, xl, xr) -> None:
        """Right rows that stream by, and the excluded pairs of their step."""
        if not len(self.lkeys) or not len(rkeys):
            return
        with np.errstate(over="ignore", invalid="ignore"):
            reach = float(np.sqrt(np.einsum("nd,nd->n", rmat, rmat)).max())
            bound = self.norms * reach
        if not bound.max() < 1e300:
            for a in range(0, len(self.lmat), SLICE_ROWS):
                if not np.isfinite(self.lmat[a:a + SLICE_ROWS] @ rmat.T).all():
                    raise ValueError("scores are not finite: the factors have diverged")
        gone, keys, dim = self._excluded(xl, xr, rkeys), _key_array(rkeys), rmat.shape[1]
        if keys.dtype == object and self.keys.dtype != object:
            self.keys = self.keys.astype(object)
        # how far a first score, or one that rounds up to a row's k-th best, may be below it
        half = 0.51 * 10.0 ** -self.decimals if self.decimals is not None else 0.0
        small = max(bound.max(), reach, self.norms.max()) < 1e30
        fine = half + (dim + 4) * 2.0 ** -51 * bound
        rough = half + (dim + 4) * 2.0 ** -23 * bound + dim * 1.2e-38 * (reach + self.norms + 1.0) if small else fine
        left, right = (self.single, rmat.astype(np.float32)) if small else (self.lmat, rmat)
        found = []
        for c in range(0, len(rmat), TILE_ROWS):
            tile = np.ascontiguousarray(right[c:c + TILE_ROWS].T)
            for a in range(0, len(self.lmat), SLICE_ROWS):
                rows = np.arange(a, min(a + SLICE_ROWS, len(self.lmat)))
                fresh = self.least[rows] == -np.inf
                if fresh.any():  # fewer than k so far: cut by the k-th best of the tile
                    new = rows[fresh]
                    s = self.lmat[new] @ rmat[c:c + TILE_ROWS].T
                    pairs = (new[:, None] * len(keys) + np.arange(c, c + s.shape[1])).ravel()
                    ok = ~self._left_out(pairs, gone, keys).reshape(s.shape)
                    s[~ok] = -np.inf
                    if s.shape[1] > self.k:
                        kth = -np.partition(-s, self.k - 1, axis=1)[:, self.k - 1]
                        ok &= s >= (kth - 2 * fine[new])[:, None]
                    self._merge(pairs[np.flatnonzero(ok)], keys, rmat)
                    rows = rows[~fresh]
                    if not len(rows):
                        continue
                    s = left[rows] @ tile
                else:
                    s = left[a:a + SLICE_ROWS] @ tile
                hit = s >= (self.least[rows] - rough[rows]).astype(s.dtype)[:, None]
                at = _at_set(hit)
                if len(at):
                    found.append(rows[at // s.shape[1]] * len(keys) + c + at % s.shape[1])
            if sum(map(len, found)) > 4 * len(self.lmat):
                self._merge(np.concatenate(found), keys, rmat, gone)
                found = []
        if found:
            self._merge(np.concatenate(found), keys, rmat, gone)

    def _left_out(self, pairs: np.ndarray, gone: np.ndarray, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(pairs), bool)
        if len(gone):
            at = np.searchsorted(gone, pairs)
            out = gone[np.minimum(at, len(gone) - 1)] == pairs
        if self.exclude_self:
            out |= np.asarray(self.own[pairs // len(keys)] == keys[pairs % len(keys)], dtype=bool)
        return out

    def _merge(self, pairs: np.ndarray, keys: np.ndarray, rmat: np.ndarray, gone: np.ndarray | None = None) -> None:
        """Score ``pairs`` exactly and put the best in their places; ``gone`` unless it was applied."""
        if gone is not None:
            pairs = pairs[~self._left_out(pairs, gone, keys)]
        for a in range(0, len(pairs), 1 << 18):  # bounds the gathered vectors
            part = pairs[a:a + (1 << 18)]
            row, col = part // len(keys), part % len(keys)
            s = np.einsum("nd,nd->n", self.lmat[row], rmat[col])
            r = np.round(s, self.decimals) if self.decimals is not None else s
            good = r >= self.least[row]
            row, col, s, r = row[good], col[good], s[good], r[good]
            if not len(row):
                continue
            met = np.unique(row)
            old = np.flatnonzero(self.rounded[met].ravel() > -np.inf)
            row = np.concatenate([met[old // self.k], row])
            r, s = np.concatenate([self.rounded[met].ravel()[old], r]), np.concatenate([self.scores[met].ravel()[old], s])
            key = np.concatenate([self.keys[met].ravel()[old], keys[col].astype(self.keys.dtype)])
            if key.dtype == object:
                by = pd.DataFrame({"row": row, "r": -r, "key": key}).sort_values(["row", "r", "key"], na_position="first", kind="mergesort").index.to_numpy()
            else:
                by = np.lexsort((key, -r, row))
            row, r, s, key = row[by], r[by], s[by], key[by]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            kept = place < self.k
            row, place = row[kept], place[kept]
            self.rounded[row, place], self.scores[row, place], self.keys[row, place] = r[kept], s[kept], key[kept]
            self.least[met] = self.rounded[met, self.k - 1]

    def rows(self, rk_type):
        """``lk, rk, score`` batches."""
        for a in range(0, len(self.lkeys), 8192):
            row, col = np.nonzero(self.rounded[a:a + 8192] > -np.inf)
            if len(row):
                row = row + a
                keys = self.keys[row, col]
                yield pa.RecordBatch.from_arrays([self.lkeys.take(pa.array(row)), pa.array(keys.tolist() if keys.dtype == object else keys).cast(rk_type),
                                                  pa.array(self.scores[row, col])], names=["lk", "rk", "score"])


LEFT, GONE, RIGHT = 0, 1, 2


def _stream_kernel(k: int, decimals: int | None, exclude_self: bool):
    """Rows ``g, step, kind, lk, rk, vec`` sorted by the first three: the left rows of a group, then step
    by step its exclusions and right rows."""
    def join(parts, empty):
        return pa.concat_arrays(parts) if parts else empty

    def kernel(batches):
        group, step, best, left, xl, xr, rk_type = None, None, None, [], [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            g, st, kind = (batch.column(c).to_numpy() for c in range(3))
            rk_type = batch.column(4).type
            starts = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (st[1:] != st[:-1]) | (kind[1:] != kind[:-1])]))
            for a, b in zip(starts, np.append(starts[1:], batch.num_rows)):
                if g[a] != group:
                    if best is not None:
                        yield from best.rows(rk_type)
                    group, step, best, left, xl, xr = g[a], None, None, [], [], []
                if st[a] != step:
                    step, xl, xr = st[a], [], []
                lk, rk, vec = (batch.column(c).slice(a, b - a) for c in (3, 4, 5))
                if kind[a] == LEFT:
                    left.append((lk, _matrix(vec)))
                elif kind[a] == GONE:
                    xl.append(lk), xr.append(rk)
                elif left:
                    if best is None:
                        best = _Best(pa.concat_arrays([x for x, _ in left]), np.concatenate([m for _, m in left]), k, decimals, exclude_self)
                        left = [None]
                    for c in range(0, len(rk), STEP_ROWS):
                        best.add(rk.slice(c, STEP_ROWS), _matrix(vec.slice(c, STEP_ROWS)), join(xl, lk[:0]), join(xr, rk[:0]))
        if best is not None:
            yield from best.rows(rk_type)

    return kernel


def block_top_k(left: DataFrame, right: DataFrame, k: int, *, left_key: str, right_key: str,
                left_vec: str = "vec", right_vec: str = "vec", metric: str = "dot",
                exclude: DataFrame | None = None, exclude_self: bool = False,
                decimals: int | None = None, block_rows: int = DEFAULT_BLOCK_ROWS,
                n_left: int | None = None, n_right: int | None = None,
                out_left: str | None = None, out_right: str | None = None,
                score_col: str = "score", rank_col: str = "rank") -> DataFrame:
    """Top ``k`` right rows per left row by dot product or cosine.

    ``exclude``: optional pairs (first column left key, second right key) that may not be returned
    (seen items).  ``exclude_self`` drops pairs with equal keys (item-item lists).
    Returns ``out_left, out_right, score, rank`` (rank 1..k, BIGINT).
    """
    if k <= 0:
        raise ValueError("k must be positive")
    out_left = out_left or left_key
    out_right = out_right or right_key
    lside, rside = _prepare(left, right, left_key, right_key, left_vec, right_vec, metric, keep_floats=True)
    spark = left.sparkSession
    nl, nr = _sizes(lside, rside, n_left, n_right)
    a, b = _layout(spark, nl, nr, LEFT_BLOCKS * block_rows)
    steps = b * _n_blocks(nr, b * min(block_rows, STEP_ROWS))
    lk_type = lside.schema["lk"].dataType
    rk_type = rside.schema["rk"].dataType
    deal = F.array(*[F.lit(x) for x in spread_keys(spark, a * b)])  # a task for every group
    group = lambda lb, rb: F.element_at(deal, lb * b + rb + 1).alias("g")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    at = _block("rk", steps)
    step, part = F.floor(at / b).cast("int").alias("step"), (at % b).alias("rb")
    rows = (lside.withColumn("rb", each(b)).select(group(_block("lk", a), F.col("rb")), F.lit(-1).alias("step"), F.lit(LEFT).alias("kind"),
                                                   "lk", F.lit(None).cast(rk_type).alias("rk"), "vec")
            .unionByName(rside.select("rk", "vec", step, part, each(a).alias("lb"))
                         .select(group(F.col("lb"), F.col("rb")), "step", F.lit(RIGHT).alias("kind"), F.lit(None).cast(lk_type).alias("lk"), "rk", "vec")))
    if exclude is not None:
        gone = _pair_cols(exclude).select(F.col("lk").cast(lk_type).alias("lk"), F.col("rk").cast(rk_type).alias("rk"))
        rows = rows.unionByName(gone.select(group(_block("lk", a), part), step, F.lit(GONE).alias("kind"), "lk", "rk",
                                            F.lit(None).cast(lside.schema["vec"].dataType).alias("vec")))
    schema = T.StructType([T.StructField("lk", lk_type), T.StructField("rk", rk_type),
                           T.StructField("score", T.DoubleType())])
    local = (rows.repartition(a * b, "g").sortWithinPartitions("g", "step", "kind")
             .mapInArrow(_stream_kernel(k, decimals, exclude_self), schema))
    ordered = F.round("score", decimals) if decimals is not None else F.col("score")
    w = Window.partitionBy("lk").orderBy(ordered.desc(), F.col("rk").asc())
    return (local.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)
            .select(F.col("lk").alias(out_left), F.col("rk").alias(out_right),
                    F.col("score").alias(score_col), F.col(rank_col).cast("long").alias(rank_col)))


def _set_in_rows(mask: np.ndarray) -> np.ndarray:
    if mask.shape[1] % 8:
        return np.count_nonzero(mask, axis=1)
    return np.bitwise_count(mask.view(np.uint64)).sum(axis=1, dtype=np.int64)


def _few_wins(left: np.ndarray, right: np.ndarray, pos: np.ndarray, li: np.ndarray, ri: np.ndarray, decimals: int | None) -> np.ndarray:
    """Wins of each left row's positives (``pos``: their scores, padded with -inf) over the right rows but the
    excluded pairs ``li, ri``.  Single precision decides all pairs but those within its error bound of a
    positive, which are scored again."""
    wins = np.zeros(len(left))
    if not len(left) or not len(right) or not pos.shape[1]:
        return wins

    def exact(row, col):
        r = np.einsum("nd,nd->n", left[row], right[col])
        return np.round(r, decimals) if decimals is not None else r

    def won(row, r, p):  # the pairs' part in the wins of positives p
        return np.bincount(row, (r < p) + 0.5 * (r == p), len(left))

    half = 0.51 * 10.0 ** -decimals if decimals is not None else 0.0
    norms, reach = np.sqrt(np.einsum("nd,nd->n", left, left)), float(np.sqrt(np.einsum("nd,nd->n", right, right)).max())
    small = max((norms * reach).max(), norms.max(), reach, np.abs(pos[np.isfinite(pos)]).max(initial=0.0)) < 1e30
    dim, kind = left.shape[1], np.float32 if small else np.float64
    off = half + (dim + 4) * (2.0 ** -22 if small else 2.0 ** -50) * norms * reach + dim * 1.2e-38 * (reach + norms + 1.0)
    ls, rs = left.astype(kind), right.astype(kind)
    for c in range(0, len(right), TILE_ROWS):
        s = ls @ np.ascontiguousarray(rs[c:c + TILE_ROWS].T)
        for x in range(pos.shape[1]):
            p = pos[:, x]
            below = s < (p - off).astype(kind)[:, None]
            upto = s <= (p + off).astype(kind)[:, None]
            n = _set_in_rows(below)
            wins += n
            if (_set_in_rows(upto) != n).any():
                at = _at_set(upto ^ below)
                row = at // s.shape[1]
                wins += won(row, exact(row, c + at % s.shape[1]), p[row])
    gone = exact(li, ri)
    for x in range(pos.shape[1]):
        wins -= won(li, gone, pos[li, x])
    return wins


def _auc_kernel(decimals: int | None, out_schema: T.StructType):
    names = out_schema.names

    def kernel(lpdf: pd.DataFrame, rpdf: pd.DataFrame) -> pd.DataFrame:
        right = _right_data(lpdf, rpdf)
        if right is None:
            return pd.DataFrame({n: [] for n in names})
        many = lpdf["pos"].map(len).to_numpy() > MANY_POSITIVES
        done = [few(lpdf[~many], right, np.flatnonzero(~many))] if not many.all() else []
        if many.any():
            mine = lpdf[many].reset_index(drop=True)
            rkeys, rmat, (li, ri) = right
            kept = many[li]
            place = np.cumsum(many) - 1
            own = rkeys, rmat, (place[li[kept]], ri[kept])
            done += [one_slice(mine, i, own) for i in range(0, len(mine), _slice_rows(len(rkeys)))]
        return pd.concat(done, ignore_index=True)

    def few(part: pd.DataFrame, right, at: np.ndarray) -> pd.DataFrame:
        rkeys, rmat, (li, ri) = right
        left = _stack(part["vec"])
        with np.errstate(over="ignore", invalid="ignore"):
            if not np.sqrt((left ** 2).sum(axis=1).max() * (rmat ** 2).sum(axis=1).max()) < 1e300:
                raise ValueError("scores are not finite: the factors have diverged")
        wins = np.zeros(len(part))
        sizes = part["pos"].map(len).to_numpy()
        place = np.full(at[-1] + 1, -1)
        place[at] = np.arange(len(at))
        mine = (li < len(place))
        mine[mine] = place[li[mine]] >= 0
        # a user's parts may share a block: count each pair once
        li, ri = np.divmod(np.unique(place[li[mine]] * len(rkeys) + ri[mine]), len(rkeys))
        for a in range(0, len(part), SLICE_ROWS):
            b = min(a + SLICE_ROWS, len(part))
            pos = np.full((b - a, sizes[a:b].max()), -np.inf)
            for x, values in enumerate(part["pos"].iloc[a:b]):
                pos[x, :len(values)] = values
            if decimals is not None:
                pos = np.round(pos, decimals)
            x, y = np.searchsorted(li, [a, b])
            wins[a:b] = _few_wins(left[a:b], rmat, pos, li[x:y] - a, ri[x:y], decimals)
        return pd.DataFrame({names[0]: part["lk"].to_numpy(), names[1]: wins})

    def one_slice(lpdf: pd.DataFrame, start: int, right):
        part, lkeys, _, s, valid = _masked_scores(lpdf, start, right, False)
        r = np.round(s, decimals) if decimals is not None else s
        # chunks of one left row have the same scores: sort each left row's negatives once
        _, first, which = np.unique(lkeys, return_index=True, return_inverse=True)
        negatives = np.sort(np.where(valid[first], r[first], np.inf), axis=1)
        count = valid[first].sum(axis=1)
        wins = np.zeros(len(lkeys))
        for i, positives in enumerate(part["pos"]):
            neg = negatives[which[i], :count[which[i]]]
            pos = np.asarray(positives, dtype=np.float64)
            if decimals is not None:
                pos = np.round(pos, decimals)
            lo = np.searchsorted(neg, pos, side="left")
            hi = np.searchsorted(neg, pos, side="right")
            wins[i] = float(np.sum(lo) + 0.5 * np.sum(hi - lo))
        return pd.DataFrame({names[0]: lkeys, names[1]: wins})

    return kernel


def block_auc(left: DataFrame, right: DataFrame, positives: DataFrame, *, left_key: str,
              right_key: str, left_vec: str = "vec", right_vec: str = "vec",
              train: DataFrame | None = None, decimals: int | None = None,
              block_rows: int = DEFAULT_BLOCK_ROWS, chunk: int = 1024, chunks_per_part: int = 8,
              n_right: int | None = None) -> DataFrame:
    """Per-left-row AUC: share of (positive, negative) right pairs ranked right, ties 1/2.

    Negatives are all right rows except the row's positives and its ``train`` pairs.
    Each positive's score is computed by a key join; positives travel to the blocks
    as arrays of about ``chunk`` scores per row (a user with many positives is split
    into several rows by a hash of the item).  Every ``chunks_per_part`` such rows of a
    user are a part, and blocks are cut by (user, part), so a user with a third of all
    positives is spread over many blocks; its exclusions go to each of its parts.  Each
    block only returns one win count per (user, chunk).  Users without positives or
    negatives get no row.
    """
    lside, rside = _prepare(left, right, left_key, right_key, left_vec, right_vec, "dot")
    pos_pairs = _pair_cols(positives).distinct()
    lk_type = lside.schema["lk"].dataType
    from ..functions.vectors import dot
    scored = (pos_pairs.join(lside.withColumnRenamed("vec", "lv"), "lk")
              .join(rside.withColumnRenamed("vec", "rv"), "rk")
              .select("lk", "rk", dot("lv", "rv").alias("ps")))
    per_user = scored.groupBy("lk").agg(F.count(F.lit(1)).alias("_p"))
    chunks = (scored.join(per_user, "lk")
              .withColumn("_c", F.pmod(F.xxhash64("rk"), F.ceil(F.col("_p") / chunk)))
              .groupBy("lk", "_c").agg(F.collect_list("ps").alias("pos")))
    # one row per (user, chunk) with the user's vector: written once, counted and scored from there
    luse = cut_lineage(chunks.join(lside, "lk").withColumn("part", F.floor(F.col("_c") / chunks_per_part).cast("int")))
    parts = luse.groupBy("lk").agg(F.max("part").alias("_last"))
    excl = pos_pairs
    if train is not None:
        excl = excl.unionByName(_pair_cols(train)).distinct()
    excl = excl.join(parts, "lk")  # of scored users only
    n_right = rside.count() if n_right is None else n_right
    a, b = _layout(luse.sparkSession, luse.count(), n_right, block_rows, block_rows)
    own = F.pmod(F.xxhash64("lk", "part"), F.lit(a)).cast("int")
    lrep = luse.withColumn("lb", own).withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(b - 1)))).select("lb", "rb", "lk", "vec", "pos")
    rrep = _right_side(rside, None, a, b, lk_type)
    routed = (excl.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("_last")))).withColumn("lb", own)
              .select("lb", _block("rk", b).alias("rb"), F.col("rk").cast(dict(rrep.dtypes)["rk"]).alias("rk"),
                      F.lit(None).cast("array<double>").alias("vec"), F.lit(True).alias("ex"), F.col("lk").cast(lk_type).alias("xl")))
    rrep = rrep.unionByName(routed)
    schema = T.StructType([T.StructField("lk", lk_type), T.StructField("wins", T.DoubleType())])
    wins = (lrep.groupBy("lb", "rb").cogroup(rrep.groupBy("lb", "rb"))
            .applyInPandas(_auc_kernel(decimals, schema), schema)
            .groupBy("lk").agg(F.sum("wins").alias("wins")))
    excluded = (excl.select("lk", "rk").join(rside.select("rk"), "rk", "left_semi")
                .groupBy("lk").agg(F.count(F.lit(1)).alias("_x")))
    out = (wins.join(per_user, "lk").join(excluded, "lk")
           .withColumn("_n", F.lit(n_right) - F.col("_x"))
           .where(F.col("_n") > 0)
           .select(F.col("lk").alias(left_key),
                   (F.col("wins") / (F.col("_p") * F.col("_n"))).alias("auc")))
    return out


# ---------------------------------------------------------------- several models and metrics in one pass

def _metrics_kernel(k: int, dims: list[int], exclude: list[bool], decimals: int | None, out_schema: T.StructType):
    """Per block pair and model: win counts of the left rows' positives, and the best ``k`` right
    rows of each user's first row."""
    names = out_schema.names
    cuts = np.concatenate([[0], np.cumsum(dims)])

    def kernel(lpdf: pd.DataFrame, rpdf: pd.DataFrame) -> pd.DataFrame:
        kinds = rpdf["ex"].to_numpy()
        items = rpdf[kinds == 0]
        if not len(items) or not len(lpdf):
            return pd.DataFrame({n: [] for n in names})
        lpdf = lpdf.reset_index(drop=True)
        rkeys, right, rhave = items["rk"].to_numpy(), _stack(items["vec"]), items["have"].to_numpy()
        out_pairs = rpdf[kinds > 0][["xl", "rk", "ex"]]
        rpos = pd.DataFrame({"rk": rkeys, "ri": np.arange(len(rkeys))})
        lpos = pd.DataFrame({"xl": lpdf["lk"].to_numpy(), "li": np.arange(len(lpdf))})
        hit = out_pairs.merge(lpos, on="xl").merge(rpos, on="rk").sort_values("li")
        li, ri, ex = (hit[c].to_numpy() for c in ("li", "ri", "ex"))
        done = []
        rows_at_once = _slice_rows(len(rkeys))
        for start in range(0, len(lpdf), rows_at_once):
            part = lpdf.iloc[start:start + rows_at_once]
            lkeys, left, lhave, head = part["lk"].to_numpy(), _stack(part["vec"]), part["have"].to_numpy(), part["head"].to_numpy(dtype=bool)
            positives = [np.array([[np.nan if x is None else x for x in p] for p in ps], np.float64) for ps in part["pos"]]
            a, b = np.searchsorted(li, [start, start + len(part)])
            row, col, kind = li[a:b] - start, ri[a:b], ex[a:b]
            _, first, which = np.unique(lkeys, return_index=True, return_inverse=True)
            for m, leave_out in enumerate(exclude):
                r = left[:, cuts[m]:cuts[m + 1]] @ right[:, cuts[m]:cuts[m + 1]].T
                if not np.isfinite(r).all():
                    raise ValueError("scores are not finite: the factors have diverged")
                s = np.round(r, decimals) if decimals is not None else r
                has = (rhave >> m) & 1 == 1
                own = (lhave >> m) & 1 == 1
                # negatives of the AUC: neither positives nor, where asked, train pairs
                valid = np.repeat(has[None, :], len(part), axis=0)
                no = (kind & (3 if leave_out else 1)) > 0
                valid[row[no], col[no]] = False
                negatives = np.sort(np.where(valid[first], s[first], np.inf), axis=1)
                count = valid[first].sum(axis=1)
                wins = np.zeros(len(part))
                for x in np.flatnonzero(own):
                    pos = positives[x][:, m]
                    pos = pos[~np.isnan(pos)]
                    pos = np.round(pos, decimals) if decimals is not None else pos
                    neg = negatives[which[x], :count[which[x]]]
                    lo, hi = np.searchsorted(neg, pos, side="left"), np.searchsorted(neg, pos, side="right")
                    wins[x] = float(np.sum(lo) + 0.5 * np.sum(hi - lo))
                done.append(pd.DataFrame({names[0]: 0, names[1]: m, names[2]: lkeys[own], names[3]: rkeys[:1].repeat(int(own.sum())), names[4]: wins[own]}))
                # the ranking: all but, where asked, train pairs
                top = np.flatnonzero(own & head)
                if not len(top):
                    continue
                ranked = np.where(has[None, :], s[top], -np.inf)
                if leave_out:
                    place = np.full(len(part), -1)
                    place[top] = np.arange(len(top))
                    no = ((kind & 2) > 0) & (place[row] >= 0)
                    ranked[place[row[no]], col[no]] = -np.inf
                keep = ranked > -np.inf
                if ranked.shape[1] > k:
                    keep &= ranked >= -np.partition(-ranked, k - 1, axis=1)[:, k - 1][:, None]
                y, x = np.nonzero(keep)
                cand = pd.DataFrame({"row": y, "s": ranked[y, x], "rk": rkeys[x]}).sort_values(["row", "s", "rk"], ascending=[True, False, True], kind="mergesort")
                cand = cand.groupby("row", sort=False).head(k)
                done.append(pd.DataFrame({names[0]: 1, names[1]: m, names[2]: lkeys[top[cand["row"].to_numpy()]], names[3]: cand["rk"].to_numpy(), names[4]: cand["s"].to_numpy()}))
        return pd.concat(done, ignore_index=True)

    return kernel


def stacked_factors(tables: list[DataFrame], dims: list[int], key: str) -> DataFrame:
    """``key, vec, have``: the models' vectors end to end (zeros where a model hasn't the id; bit m of
    ``have`` says that model m has it)."""
    rows = None
    for m, t in enumerate(tables):
        one = t.select(F.col("id").alias(key), F.lit(m).alias("m"), F.col("vec").cast("array<double>").alias("vec"))
        rows = one if rows is None else rows.unionByName(one)
    own = lambda m: F.first(F.when(F.col("m") == m, F.col("vec")), ignorenulls=True).alias(f"v{m}")
    wide = rows.groupBy(key).agg(*[own(m) for m in range(len(tables))])
    have = sum((F.when(F.col(f"v{m}").isNotNull(), 1 << m).otherwise(0) for m in range(len(tables))), F.lit(0))
    vec = F.concat(*[F.coalesce(f"v{m}", F.array_repeat(F.lit(0.0), d)) for m, d in enumerate(dims)])
    return wide.select(key, vec.alias("vec"), have.cast("int").alias("have"))


def block_metrics(left: DataFrame, right: DataFrame, dims: list[int], exclude: list[bool], positives: DataFrame, k: int,
                  train: DataFrame | None = None, decimals: int | None = None, block_rows: int = DEFAULT_BLOCK_ROWS,
                  chunk: int = 1024, chunks_per_part: int = 8) -> tuple[DataFrame, DataFrame]:
    """AUC and top ``k`` of several models from one all-pairs pass.

    ``left`` / ``right`` are ``stacked_factors`` keyed ``lk`` / ``rk``; ``exclude[m]`` takes ``train``
    pairs out of model m's ranking and negatives.  Returns ``lk, m, auc`` (users with positives and
    negatives) and ``lk, m, rk`` (the top k of the users with a scored positive).  The layout is that of
    ``block_auc``: positives travel in chunks, so a hot user is spread over many blocks.
    """
    from ..functions.vectors import dot
    cuts = [0]
    for d in dims:
        cuts.append(cuts[-1] + d)
    models = range(len(dims))
    pos_pairs = _pair_cols(positives).distinct()
    lk_type, rk_type = left.schema["lk"].dataType, right.schema["rk"].dataType
    both = F.col("lh").bitwiseAND(F.col("rh"))
    score = lambda m: F.when(both.bitwiseAND(F.lit(1 << m)) > 0, dot(F.slice("lv", cuts[m] + 1, dims[m]), F.slice("rv", cuts[m] + 1, dims[m])))
    scored = (pos_pairs.join(left.select("lk", F.col("vec").alias("lv"), F.col("have").alias("lh")), "lk")
              .join(right.select("rk", F.col("vec").alias("rv"), F.col("have").alias("rh")), "rk")
              .select("lk", "rk", F.array(*[score(m) for m in models]).alias("ps")))
    per_user = scored.groupBy("lk").agg(F.count(F.lit(1)).alias("_p"), *[F.count(F.col("ps")[m]).alias(f"_p{m}") for m in models])
    chunks = (scored.join(per_user.select("lk", "_p"), "lk").withColumn("_c", F.pmod(F.xxhash64("rk"), F.ceil(F.col("_p") / chunk)))
              .groupBy("lk", "_c").agg(F.collect_list("ps").alias("pos")))
    heads = chunks.groupBy("lk").agg(F.min("_c").alias("_first"))
    luse = cut_lineage(chunks.join(heads, "lk").join(left, "lk").select(
        "lk", "vec", "have", "pos", (F.col("_c") == F.col("_first")).alias("head"), F.floor(F.col("_c") / chunks_per_part).cast("int").alias("part")))
    parts = luse.groupBy("lk").agg(F.max("part").alias("_last"))
    excl = pos_pairs.withColumn("ex", F.lit(1))
    if train is not None and any(exclude):
        excl = excl.unionByName(_pair_cols(train).distinct().withColumn("ex", F.lit(2)))
    excl = excl.groupBy("lk", "rk").agg(F.sum("ex").cast("int").alias("ex")).join(parts, "lk")  # of scored users only
    n_right = right.agg(F.count(F.lit(1)).alias("all"), *[F.sum(F.col("have").bitwiseAND(F.lit(1 << m)) / (1 << m)).alias(f"n{m}") for m in models]).first()
    a, b = _layout(luse.sparkSession, luse.count(), n_right["all"], block_rows, block_rows)
    own = F.pmod(F.xxhash64("lk", "part"), F.lit(a)).cast("int")
    lrep = (luse.withColumn("lb", own).withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(b - 1))))
            .select("lb", "rb", "lk", "vec", "have", "pos", "head"))
    placeholder = F.lit("").cast(lk_type) if isinstance(lk_type, T.StringType) else F.lit(0).cast(lk_type)
    rrep = _replicate(right, "rb", b, "lb", a, "rk").select("lb", "rb", "rk", "vec", "have", F.lit(0).alias("ex"), placeholder.alias("xl"))
    routed = (excl.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("_last")))).withColumn("lb", own)
              .select("lb", _block("rk", b).alias("rb"), F.col("rk").cast(rk_type).alias("rk"), F.lit(None).cast("array<double>").alias("vec"),
                      F.lit(0).alias("have"), "ex", F.col("lk").cast(lk_type).alias("xl")))
    schema = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("m", T.IntegerType()), T.StructField("lk", lk_type),
                           T.StructField("rk", rk_type), T.StructField("value", T.DoubleType())])
    local = cut_lineage(lrep.groupBy("lb", "rb").cogroup(rrep.unionByName(routed).groupBy("lb", "rb"))
                        .applyInPandas(_metrics_kernel(k, dims, exclude, decimals, schema), schema))
    ordered = F.round("value", decimals) if decimals is not None else F.col("value")
    w = Window.partitionBy("lk", "m").orderBy(ordered.desc(), F.col("rk").asc())
    top = (local.where(F.col("kind") == 1).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).select("lk", "m", "rk"))
    wins = local.where(F.col("kind") == 0).groupBy("lk", "m").agg(F.sum("value").alias("wins"))
    left_out = lambda m: F.sum(((F.col("have").bitwiseAND(F.lit(1 << m)) > 0) & (F.col("ex").bitwiseAND(F.lit(3 if exclude[m] else 1)) > 0)).cast("long"))
    gone = excl.join(right.select("rk", "have"), "rk").groupBy("lk").agg(*[left_out(m).alias(f"_x{m}") for m in models])
    pick = lambda prefix: F.element_at(F.array(*[F.col(f"{prefix}{m}") for m in models]), F.col("m") + 1)
    n_of = F.element_at(F.array(*[F.lit(int(n_right[f"n{m}"] or 0)) for m in models]), F.col("m") + 1)
    auc = (wins.join(per_user, "lk").join(gone, "lk").withColumn("_np", pick("_p")).withColumn("_nn", n_of - pick("_x"))
           .where((F.col("_np") > 0) & (F.col("_nn") > 0)).select("lk", "m", (F.col("wins") / (F.col("_np") * F.col("_nn"))).alias("auc")))
    return auc, top
