"""Aggregates written back, picks per group, sorts and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evolve.operators.joins import attach, update_from
from evolve.operators.ordered import collect_aligned, first_per_key


def exact_sum(c: Column, scale: int = 4) -> Column:
    """A sum that does not depend on the order of the rows, as double."""
    return F.sum(c.cast(f"decimal(18,{scale})")).cast("double")


def aggregate_onto(
    parent: DataFrame, child: DataFrame, on: tuple[str, str], aggregates: Mapping[str, Column]
) -> DataFrame:
    """Aggregate the children per key and write the result to their parent.

    Aggregation comes before the join, so at most one row per parent is joined.
    """
    pk, ck = on
    totals = child.groupBy(ck).agg(*[a.alias(f"__a_{n}") for n, a in aggregates.items()])
    sets = {n: F.col(f"s.__a_{n}") for n in aggregates}
    return update_from(parent, totals, [(pk, ck)], sets, reduced=True)


def aggregate_by(df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggregates.items()])


def coalesce_mins(df: DataFrame, keys: Sequence[str], cols: Sequence[str], dst: str) -> DataFrame:
    """Collapse a fan-out to one value per key: the least of the first column that has any."""
    return df.groupBy(*keys).agg(F.coalesce(*[F.min(c) for c in cols]).alias(dst))


def all_equal(df: DataFrame, keys: Sequence[str], col: str, value, dst: str) -> DataFrame:
    """Per group: do all rows have this value? NULL says no."""
    same = F.coalesce(F.col(col) == F.lit(value), F.lit(False))
    return df.groupBy(*keys).agg(F.every(same).alias(dst))


def any_and_all(
    df: DataFrame, keys: Sequence[str], any_: Mapping[str, Column], all_: Mapping[str, Column]
) -> DataFrame:
    """Per group, whether any row and whether all rows hold; named predicates, one pass. Unknown does not hold."""
    def holds(predicate: Column) -> Column:
        return F.coalesce(predicate, F.lit(False))

    return df.groupBy(*keys).agg(
        *[F.bool_or(holds(p)).alias(name) for name, p in any_.items()],
        *[F.bool_and(holds(p)).alias(name) for name, p in all_.items()],
    )


def most_frequent(df: DataFrame, keys: Sequence[str], value: str, dst: str) -> DataFrame:
    """The commonest value per group; NULL counts as a value, ties go to the least."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    top = first_per_key(counts, keys, [F.col("__n").desc(), F.col(value).asc_nulls_last()])
    return top.select(*keys, F.col(value).alias(dst))


def ratio_of_sums(df: DataFrame, keys: Sequence[str], num: Column, den: Column, dst: str) -> DataFrame:
    """SUM(num) / SUM(den) where SUM(den) is not zero."""
    sums = df.groupBy(*keys).agg(exact_sum(num).alias("__n"), exact_sum(den).alias("__d"))
    return sums.where("__d <> 0").select(*keys, (F.col("__n") / F.col("__d")).alias(dst))


def exists_flags(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """One row, a boolean for each named predicate: does any row match?"""
    return df.agg(*[F.coalesce(F.bool_or(p), F.lit(False)).alias(name) for name, p in predicates.items()])


def exists_flag(df: DataFrame, predicate: Column, dst: str = "found") -> DataFrame:
    """One row, one boolean: does any row match?"""
    return exists_flags(df, {dst: predicate})


def latest_per_group(df: DataFrame, keys: Sequence[str], at: str, tie: Sequence[str]) -> DataFrame:
    """The newest row of each group; an unknown date counts as newest."""
    order = [F.col(at).desc_nulls_first(), *[F.col(c).desc() for c in tie]]
    return first_per_key(df, keys, order)


def with_group_max(df: DataFrame, keys: Sequence[str], col: str, dst: str) -> DataFrame:
    """The group's maximum beside every row: aggregate and join, so a hot group stays split."""
    top = df.groupBy(*keys).agg(F.max(col).alias("__max"))
    return attach(df, top, list(keys), {dst: "__max"}, null_safe=True)


def sorted_distinct_list(
    df: DataFrame, keys: Sequence[str], value: str, dst: str, chunk: int, sep: str = ",", spread: bool = True
) -> DataFrame:
    """Sorted text list of the distinct values of each group: one row per (keys.., chunk) of at most ``chunk`` values."""
    members = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("string").alias(value)).distinct()
    packed = collect_aligned(members, keys, [value], [value], dst, chunk, spread=spread)
    return packed.withColumn(dst, F.array_join(F.transform(dst, lambda x: x[value]), sep))


def resort_model(df: DataFrame, order: Sequence[tuple[str, bool]]) -> DataFrame:
    """Apply a stored default order given as (column, descending)."""
    return df.orderBy(*[F.col(c).desc_nulls_first() if d else F.col(c).asc_nulls_last() for c, d in order])


def top_one(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    return df.orderBy(*order).limit(1)


def append(a: DataFrame, b: DataFrame) -> DataFrame:
    """UNION ALL by column name."""
    return a.unionByName(b)


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that are not in ``b``; NULL equals NULL."""
    return a.subtract(b)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def multiset_difference(a: DataFrame, b: DataFrame, side: str = "side") -> DataFrame:
    """Rows, duplicates counted, that only one side has; empty when both are equal.

    One aggregation over both sides instead of two set differences.
    """
    columns = a.columns
    tagged = a.withColumn("__d", F.lit(1)).unionByName(b.select(*columns).withColumn("__d", F.lit(-1)))
    surplus = tagged.groupBy(*columns).agg(F.sum("__d").alias("__n")).where("__n <> 0")
    return surplus.select(
        *columns,
        F.when(F.col("__n") > 0, F.lit("left")).otherwise(F.lit("right")).alias(side),
        F.abs("__n").cast("long").alias("copies"),
    )
