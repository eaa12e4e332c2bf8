"""Vector expressions on array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(v: Column) -> Column:
    return F.sqrt(
        F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    )


def l2_normalize(v: Column, norm: Column) -> Column:
    """Unit vector; NULL for a zero vector. ``norm`` should be a column already computed from ``v``."""
    return F.when(norm > 0, F.transform(v, lambda x: x.cast("double") / norm))
