"""Key and hash expressions shared by splits, samplers and feature encoding.

Sampling is always by ``md5`` of a seed and the row's key, never ``rand()``: the
draw of a row is then the same after a retry, a repartition, or in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def md5_key(seed: int, *cols) -> Column:
    """Hex md5 of ``seed|c1|c2...`` (all cast to string)."""
    parts = [F.lit(str(seed))] + [_col(c).cast("string") for c in cols]
    return F.md5(F.concat_ws("|", *parts))


def hex_threshold(fraction: float, digits: int = 8) -> str:
    """Hex prefix bound so that ``substr(md5, 1, digits) < bound`` holds for ``fraction``
    of keys (string order on equal-length lower-case hex = numeric order)."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must lie in [0, 1]")
    top = 16 ** digits
    value = min(int(fraction * top), top)
    if value >= top:
        return "g" * digits  # sorts after every hex string
    return format(value, f"0{digits}x")


def feature_key(type_col, value_col) -> Column:
    """Feature name ``type_value`` with the value lower-cased (type kept as given)."""
    return F.concat_ws("_", _col(type_col), F.lower(_col(value_col).cast("string")))


def binarize_expr(value_col, threshold: float) -> Column:
    """1 when value > threshold else 0 (strictly greater, as the reference)."""
    return F.when(_col(value_col) > F.lit(threshold), F.lit(1)).otherwise(F.lit(0))
