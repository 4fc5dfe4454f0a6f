"""Column expressions over ARRAY<FLOAT|DOUBLE> vectors (JVM-side higher-order functions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dot(a, b) -> Column:
    """sum_i a[i]*b[i], elements widened to double first."""
    prods = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0), lambda acc, v: acc + v)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a, b) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def l2_squared(a, b) -> Column:
    diffs = F.zip_with(_c(a), _c(b), lambda x, y: F.pow(x.cast("double") - y.cast("double"), 2))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, v: acc + v)


def normalize(a) -> Column:
    n = norm(a)
    return F.transform(_c(a), lambda x: x.cast("double") / n)
