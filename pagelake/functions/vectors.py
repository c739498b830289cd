"""Vector column helpers: validity, norm, dot product, cosine (V3, V4).

Vectors are ``array<double>`` columns (``array<float>`` inputs are cast first
so that all arithmetic is in double).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_vector(c) -> Column:
    return _c(c).cast("array<double>")


def is_valid_vector(c) -> Column:
    """V3: a vector exists when it is not NULL and not empty."""
    v = _c(c)
    return v.isNotNull() & (F.size(v) > 0)


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(as_vector(a), as_vector(b), lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def l2norm(a) -> Column:
    return F.sqrt(F.aggregate(as_vector(a), F.lit(0.0), lambda s, x: s + x * x))


def cosine(a, b, strict: bool = True) -> Column:
    """V4: cosine similarity; -1 when a side is missing/empty or has norm 0.

    Vectors of different length are an error (``strict``) or NULL.
    """
    a, b = _c(a), _c(b)
    na, nb = l2norm(a), l2norm(b)
    mismatch = F.size(a) != F.size(b)
    on_mismatch = F.raise_error(F.lit("vector length mismatch")).cast("double") if strict else F.lit(None).cast("double")
    return (
        F.when(~is_valid_vector(a) | ~is_valid_vector(b), F.lit(-1.0))
        .when((na == 0) | (nb == 0), F.lit(-1.0))
        .when(mismatch, on_mismatch)
        .otherwise(dot(a, b) / (na * nb))
    )
