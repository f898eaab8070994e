"""Vector expressions on ARRAY<DOUBLE> columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm(vector: str | Column) -> Column:
    """Euclidean length."""
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x))


def l2_normalise(vector: str | Column) -> Column:
    """Unit-length vector; a zero vector stays as it is.

    The length is bound once, as the variable of an outer lambda: written out inside the inner one it would be
    computed again for every element.
    """
    v = F.col(vector) if isinstance(vector, str) else vector
    scaled = F.transform(F.array(norm(v)), lambda length: F.when(length > 0, F.transform(v, lambda x: x / length)).otherwise(v))
    return F.get(scaled, F.lit(0))
