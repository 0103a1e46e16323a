"""Row-wise Column expressions shared by the operators (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO32 = 4294967296.0


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def uniform(*parts) -> Column:
    """Deterministic U[0,1) from the md5 of the concatenated parts.

    Same double as ``cast(('0x'||substr(md5(s),1,8)) as bigint)/2^32`` in DuckDB.
    """
    s = F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("double") / F.lit(TWO32)


def hash_order(*parts) -> Column:
    """Deterministic 60-bit integer from md5, used as a total order key."""
    s = F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(s), 1, 15), 16, 10).cast("long")


def clip(c, lo: float, hi: float) -> Column:
    return F.least(F.greatest(col(c), F.lit(lo)), F.lit(hi))


def safe_div(num, den) -> Column:
    """num/den, NULL when den is 0 or NULL."""
    den = col(den)
    return F.when(den != 0, col(num) / den)


def logit(p, eps: float = 1e-7) -> Column:
    pc = clip(p, eps, 1.0 - eps)
    return F.log(pc / (F.lit(1.0) - pc))


def sigmoid(x) -> Column:
    """Numerically stable logistic function."""
    x = col(x)
    return F.when(x >= 0, F.lit(1.0) / (F.lit(1.0) + F.exp(-x))).otherwise(F.exp(x) / (F.lit(1.0) + F.exp(x)))


def softplus(x) -> Column:
    """log(1+exp(x)) without overflow."""
    x = col(x)
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def bernoulli_entropy(p, eps: float = 1e-12) -> Column:
    """Entropy of Bernoulli(p) in nats, p clipped to [eps, 1-eps]."""
    pc = clip(p, eps, 1.0 - eps)
    return -(pc * F.log(pc) + (F.lit(1.0) - pc) * F.log(F.lit(1.0) - pc))


def wilson(p, n, z: float = 1.96) -> tuple[Column, Column]:
    """Wilson score interval (lo, hi) for a proportion p over n trials."""
    p, n = col(p), col(n)
    z2 = z * z
    denom = F.lit(1.0) + F.lit(z2) / n
    centre = (p + F.lit(z2) / (F.lit(2.0) * n)) / denom
    half = F.lit(z) * F.sqrt((p * (F.lit(1.0) - p) + F.lit(z2) / (F.lit(4.0) * n)) / n) / denom
    return centre - half, centre + half


def r6(c) -> Column:
    return F.round(col(c), 6)


def count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def bin_index(p, edges: list[float]) -> Column:
    """Number of inner edges <= p (numpy ``digitize(p, inner, right=False)``)."""
    p = col(p)
    if not edges:
        return F.lit(0)
    expr = None
    for e in edges:
        term = F.when(p >= F.lit(float(e)), 1).otherwise(0)
        expr = term if expr is None else expr + term
    return expr


def linspace_inner(n_bins: int) -> list[float]:
    """Inner edges of ``numpy.linspace(0, 1, n_bins + 1)``."""
    step = 1.0 / n_bins
    return [i * step for i in range(1, n_bins)]
