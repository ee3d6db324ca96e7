"""Filters whose treatment of NULL matters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evolve.operators.joins import attach


def compare(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which a comparison is true; unknown drops the row."""
    return df.where(predicate)


def is_blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def in_list(c: Column, values: Sequence) -> Column:
    return c.isin(list(values))


def not_in_list(c: Column, values: Sequence) -> Column:
    """NOT IN: a NULL input is neither in nor out, so the row is dropped."""
    return ~c.isin(list(values))


def is_distinct(a: Column, b: Column) -> Column:
    """IS DISTINCT FROM."""
    return ~a.eqNullSafe(b)


def active_rows(df: DataFrame, active: Column, group: Sequence[str] = (), fallback: bool = False) -> DataFrame:
    """Visible rows only; with ``fallback`` a group that has none keeps all its rows."""
    if not fallback:
        return df.where(active)
    flags = df.groupBy(*group).agg(F.bool_or(F.coalesce(active, F.lit(False))).alias("__any"))
    if not group:
        return df.where(F.coalesce(active, F.lit(False)) | ~F.coalesce(flags.scalar(), F.lit(False)))
    tagged = attach(df, flags, list(group), ["__any"], null_safe=True)
    return tagged.where(active | ~F.col("__any")).drop("__any")
