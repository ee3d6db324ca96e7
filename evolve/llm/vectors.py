"""Columns of vectors: which take part in a comparison, and their form in a shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Whether a vector is there, has only finite components and is not all zero."""
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists(F.col(vector), lambda x: x != 0)
    return F.coalesce(F.col(vector).isNotNull() & finite & some, F.lit(False))
