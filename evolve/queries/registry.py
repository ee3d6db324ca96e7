"""Check queries: each operator over the test tables, with equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from evolve.session import tune

# The test tables.
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


# Reading a schema costs a job; the test tables do not change.
_SCHEMAS: dict[str, StructType] = {}


class Tables:
    """The test tables of one folder, read on first use: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        df = self.spark.read.schema(_SCHEMAS[path]).parquet(path)
        setattr(self, name, df)
        return df


class Section:
    """Queries and SQL of one section of the operator list."""

    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None):
        def register(fn: Callable[[Tables], DataFrame]):
            self.queries[name] = lambda spark, folder: fn(Tables(tune(spark), folder))
            if sql is not None:
                self.sql[name] = sql
            return fn

        return register
