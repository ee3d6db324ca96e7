"""Stored tables: scan, snapshot, append, clear, relation tables, pinned mappings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evolve.dataset import Dataset
from evolve.naming import legacy_name
from evolve.storage import mapping_table as _mapping_table


def scan(ds: Mapping[str, DataFrame], table: str, columns: Sequence[str], where: Column | None = None) -> DataFrame:
    """Chosen columns of a table; filter and projection reach the file scan."""
    df = ds[table]
    return (df if where is None else df.where(where)).select(*columns)


def snapshot(ds: Dataset, table: str, columns: Sequence[str], as_name: str | None = None) -> Dataset:
    """Keep chosen columns of a table as they are now under a legacy name.

    Frames do not change, so the copy is one more entry; ``write`` stores it.
    """
    return ds.put(as_name or legacy_name(table), ds[table].select(*columns))


def write(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists") -> None:
    """Store a table as parquet."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def save_table(
    df: DataFrame, name: str, bucket_by: Sequence[str] = (), buckets: int = 0, mode: str = "errorifexists"
) -> None:
    """Store a table in the catalog; buckets on a join key save its shuffle later."""
    writer = df.write.mode(mode)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(name)


def append_select(target: DataFrame, rows: DataFrame) -> DataFrame:
    """INSERT INTO .. SELECT: target columns the rows do not name become NULL."""
    extra = [c for c in rows.columns if c not in target.columns]
    if extra:
        raise ValueError(f"the target has no column {', '.join(extra)}")
    types = {f.name: f.dataType for f in target.schema.fields}
    typed = rows.select(*[F.col(c).cast(types[c]).alias(c) for c in rows.columns])
    return target.unionByName(typed, allowMissingColumns=True)


def clear_table(df: DataFrame) -> DataFrame:
    """Delete every row, keep the schema; folds to an empty relation."""
    return df.where(F.lit(False))


def create_relation(spark: SparkSession, left: str, right: str) -> DataFrame:
    """An empty table of id pairs."""
    schema = T.StructType([T.StructField(left, T.LongType()), T.StructField(right, T.LongType())])
    return spark.createDataFrame([], schema)


def mapping_table(spark: SparkSession, mapping: Mapping[str, str], old: str = "old", new: str = "new") -> DataFrame:
    """A pinned old-name to new-name table."""
    return _mapping_table(spark, mapping.items(), f"{old} string, {new} string")
