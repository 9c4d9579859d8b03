"""Expressions on numeric arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a, b) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda acc, v: acc + v,
    )


def norm(a) -> Column:
    return F.sqrt(
        F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double"))
    )


def cosine(a, b, norm_a=None, norm_b=None) -> Column:
    """Cosine similarity, 0 when a vector has no length."""
    na = norm(a) if norm_a is None else norm_a
    nb = norm(b) if norm_b is None else norm_b
    return F.when((na == 0) | (nb == 0), F.lit(0.0)).otherwise(dot(a, b) / (na * nb))


def blend(a, b) -> Column:
    """Unit-length mean of two vectors; a zero mean is left as it is."""
    mean = F.zip_with(a, b, lambda x, y: (x.cast("double") + y.cast("double")) / 2.0)
    size = norm(mean)
    return F.transform(mean, lambda v: v / F.when(size == 0, F.lit(1.0)).otherwise(size))


def jaccard(a, b) -> Column:
    """Overlap of two sets given as arrays; two empty sets agree fully."""
    empty = F.array().cast("array<string>")
    left, right = F.coalesce(a, empty), F.coalesce(b, empty)
    union = F.size(F.array_union(left, right))
    return F.when(union == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(left, right)) / union
    )
