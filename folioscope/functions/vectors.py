"""Dense vectors held as numeric arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscope.functions.text import let


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """``a`` scaled to length 1 as doubles; a zero vector stays zero."""
    return let(
        norm(a),
        lambda n: F.transform(
            a, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0))
        ),
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 when either vector is zero."""
    return let(
        norm(a) * norm(b), lambda n: F.when(n > 0, dot(a, b) / n).otherwise(F.lit(0.0))
    )


def has_dims(a: Column, dims: int) -> Column:
    return F.coalesce(F.size(a) == dims, F.lit(False))


def is_complete(a: Column, dims: int) -> Column:
    """Whether ``a`` has exactly ``dims`` values and none of them is null."""
    return has_dims(a, dims) & ~F.coalesce(F.exists(a, F.isnull), F.lit(False))
