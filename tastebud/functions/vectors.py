"""Vector expressions on ``ARRAY<DOUBLE>`` columns.

All are higher-order SQL functions, so they stay inside whole-stage codegen and
never cross into Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a, b, dim: int | None = None) -> Column:
    """Inner product of two equal-length arrays.

    With ``dim`` known the sum is unrolled into per-component products, which
    whole-stage codegen compiles; the generic form is a higher-order function,
    which Spark evaluates interpreted."""
    if dim is not None:
        ca, cb = _col(a), _col(b)
        terms = [ca.getItem(d) * cb.getItem(d) for d in range(dim)]
        out = terms[0]
        for t in terms[1:]:
            out = out + t
        return out
    return F.aggregate(F.zip_with(_col(a), _col(b), lambda x, y: x * y), F.lit(0.0),
                       lambda acc, x: acc + x)


def axpy(ca, a, cb=None, b=None, dim: int | None = None) -> Column:
    """``ca * a (+ cb * b)`` for scalar columns ``ca``, ``cb`` and vectors ``a``, ``b``
    (unrolled when ``dim`` is known)."""
    if dim is not None:
        comps = []
        for d in range(dim):
            v = ca * _col(a).getItem(d)
            if b is not None:
                v = v + cb * _col(b).getItem(d)
            comps.append(v)
        return F.array(*comps)
    if b is None:
        return F.transform(_col(a), lambda x: ca * x)
    return F.zip_with(_col(a), _col(b), lambda x, y: ca * x + cb * y)


def l2_norm(a) -> Column:
    return F.sqrt(F.aggregate(F.transform(_col(a), lambda x: x * x), F.lit(0.0),
                              lambda acc, x: acc + x))


def normalize(a) -> Column:
    """Unit-length copy of ``a`` (zero vectors stay zero)."""
    n = l2_norm(a)
    return F.transform(_col(a), lambda x: F.when(n > 0, x / n).otherwise(F.lit(0.0)))


def cosine(a, b) -> Column:
    """Cosine similarity: dot / (|a| |b|); null when either vector is zero."""
    den = l2_norm(a) * l2_norm(b)
    return F.when(den > 0, dot(a, b) / den)


def scale(a, factor) -> Column:
    f = _col(factor) if not isinstance(factor, (int, float)) else F.lit(float(factor))
    return F.transform(_col(a), lambda x: x * f)


def add(a, b) -> Column:
    return F.zip_with(_col(a), _col(b), lambda x, y: x + y)


def sub(a, b) -> Column:
    return F.zip_with(_col(a), _col(b), lambda x, y: x - y)


def hashed_uniform_vector(seed: int, key, dim: int, scale_by: float) -> Column:
    """Deterministic initial vector: component d is uniform(-0.5, 0.5) * scale_by, drawn
    from ``xxhash64(seed, key, d)``; identical on every retry and partitioning.
    (One literal expression per component: no lambda, so nothing to re-bind.)"""
    k = _col(key)
    return F.array(*[
        ((F.pmod(F.xxhash64(F.lit(seed), k, F.lit(d)), F.lit(1 << 30)) / float(1 << 30)) - 0.5) * scale_by
        for d in range(dim)])
