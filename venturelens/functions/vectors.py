"""Dense vectors held as array<float>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def l2_norm(v: Column) -> Column:
    total = F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    return F.sqrt(total)


def l2_normalize(v: Column) -> Column:
    """Unit length; a zero vector stays as it is."""
    norm = l2_norm(v)
    return F.when(norm > 0, F.transform(v, lambda x: x.cast("double") / norm)).otherwise(
        F.transform(v, lambda x: x.cast("double"))
    )


def dot(a: Column, b: Column) -> Column:
    """Inner product in double, for vectors of any size.

    (A flat sum of 64 products is several times slower: its generated method is too long to be compiled.)
    """
    pairs = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x)
