"""Vector expressions over ``array<float>`` columns, computed in double precision.

All of these are built-in higher-order functions, so they stay in the JVM; the
matching operator uses them only for pairwise checks, not for the all-pairs
search (see ``semjoin.operators.match``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dot(a, b) -> Column:
    """Inner product; NULL when either side is NULL or the lengths differ."""
    a, b = _c(a), _c(b)
    prod = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    s = F.aggregate(prod, F.lit(0.0).cast("double"), lambda acc, x: acc + x)
    return F.when(F.size(a) == F.size(b), s)


def l2_norm(a) -> Column:
    a = _c(a)
    return F.sqrt(F.aggregate(a, F.lit(0.0).cast("double"),
                              lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine_similarity(a, b) -> Column:
    """``1 - (a <=> b)``. NULL for a zero vector or a length mismatch (never NaN)."""
    return F.try_divide(dot(a, b), l2_norm(a) * l2_norm(b))


def cosine_distance(a, b) -> Column:
    return F.lit(1.0) - cosine_similarity(a, b)


def normalize(a) -> Column:
    """Unit-length copy as ``array<double>``; NULL for a zero or NULL vector."""
    a = _c(a)
    n = l2_norm(a)
    return F.when(n > 0, F.transform(a, lambda x: x.cast("double") / n))


def vector_dim_ok(a, dim: int) -> Column:
    """True when the vector has exactly ``dim`` elements and no NULL element."""
    a = _c(a)
    return (F.size(a) == F.lit(dim)) & ~F.exists(a, lambda x: x.isNull())


def vector_to_text(a) -> Column:
    """``[v1,v2,...]`` text form used to hand vectors to a vector store."""
    a = _c(a)
    return F.concat(F.lit("["), F.array_join(F.transform(a, lambda x: x.cast("string")), ","), F.lit("]"))


def text_to_vector(t, dim: int | None = None) -> Column:
    """Parse ``[v1,...]`` text into ``array<float>``; NULL if malformed or of the wrong length."""
    v = F.from_json(_c(t), "array<float>")
    if dim is None:
        return v
    return F.when(vector_dim_ok(v, dim), v)
