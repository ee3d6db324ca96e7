"""A dataset is a named set of DataFrames plus the metadata of its models."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from evolve.naming import legacy_name


class Dataset(Mapping):
    """Immutable mapping of table name to DataFrame.

    Every change returns a new Dataset, so a step never disturbs the frames an
    earlier step handed out and all of them stay lazy.
    """

    def __init__(self, tables: Mapping[str, DataFrame]):
        self._tables = dict(tables)

    @classmethod
    def read(cls, spark: SparkSession, folder: str, names: Iterable[str]) -> "Dataset":
        return cls({n: spark.read.parquet(f"{folder}/{n}.parquet") for n in names})

    @classmethod
    def from_catalog(cls, spark: SparkSession, names: Iterable[str]) -> "Dataset":
        return cls({n: spark.table(n) for n in names})

    def write(self, folder: str, names: Iterable[str] | None = None, mode: str = "errorifexists") -> None:
        """Store tables as parquet, to be read back by ``read``."""
        for name in self._tables if names is None else names:
            self._tables[name].write.mode(mode).parquet(f"{folder}/{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        return self._tables[name]

    def __iter__(self):
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)

    def put(self, name: str, df: DataFrame) -> "Dataset":
        return Dataset({**self._tables, name: df})

    def without(self, name: str) -> "Dataset":
        return Dataset({n: df for n, df in self._tables.items() if n != name})

    def has_table(self, name: str) -> bool:
        return name in self._tables

    def has_column(self, table: str, column: str) -> bool:
        return table in self._tables and column in self._tables[table].columns

    def rename_tables(self, renames: Iterable[tuple[str, str | None]]) -> "Dataset":
        """Rename tables; ``None`` moves a table to its legacy name.

        A table that is absent is skipped, so a rerun is safe.
        """
        tables = dict(self._tables)
        for old, new in renames:
            if old in tables:
                target = new or legacy_name(old)
                if target in tables:
                    raise ValueError(f"table {target} exists already")
                tables[target] = tables.pop(old)
        return Dataset(tables)
