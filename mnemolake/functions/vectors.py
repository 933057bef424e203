"""Vector column functions over ``array<float>``, computed in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    """L2 norm."""
    squares = F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return F.sqrt(squares)


def cosine_from(product: Column, norm_a: Column, norm_b: Column) -> Column:
    """Cosine similarity from a dot product and two norms; NaN when a norm is zero."""
    scale = norm_a * norm_b
    bounded = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), product / F.nullif(scale, F.lit(0.0))))
    # greatest and least pass over NULL, so a missing vector needs its own branch.
    return F.when(scale == 0, F.lit(float("nan"))).when(product.isNotNull() & scale.isNotNull(), bounded)


def cosine(a: Column, b: Column) -> Column:
    """``1 - cosine distance``. A zero vector has no direction: the result is NaN."""
    return cosine_from(dot(a, b), norm(a), norm(b))


def zero_vector(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0).cast("float"), dim)


def is_zero(v: Column) -> Column:
    """True for an all-zero (or empty) vector, NULL for a missing one."""
    return F.forall(v, lambda x: x == 0)


def check_width(v: Column, dim: int) -> Column:
    """True only for a present vector of the expected width."""
    return F.coalesce(F.size(v) == dim, F.lit(False)) & v.isNotNull()


def parse_vector(text: Column) -> Column:
    """``'[1,2,3]'`` to a vector; NULL when the text is no list of numbers."""
    return F.from_json(text, "array<float>")
