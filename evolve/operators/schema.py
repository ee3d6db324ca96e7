"""Columns and field metadata: rename, add, copy, cast, keep."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evolve.dataset import Dataset
from evolve.naming import legacy_name
from evolve.operators.joins import attach
from evolve.storage import mapping_table


def rename_columns(df: DataFrame, renames: Iterable[tuple[str, str | None]]) -> DataFrame:
    """Rename columns; ``None`` moves one to its legacy name. Absent ones are skipped."""
    return df.withColumnsRenamed({old: new or legacy_name(old) for old, new in renames if old in df.columns})


def rename_fields(ds: Dataset, renames: Sequence[tuple[str, str, str, str]], fields: str = "fields") -> Dataset:
    """Rename fields given as (model, table, old, new): the columns and their metadata."""
    out = ds
    for table in {t for _, t, _, _ in renames}:
        if ds.has_table(table):
            pairs = [(o, n) for _, t, o, n in renames if t == table]
            out = out.put(table, rename_columns(ds[table], pairs))
    if ds.has_table(fields):
        meta = ds[fields]
        names = mapping_table(
            meta.sparkSession, [(m, o, n) for m, _, o, n in renames], "model string, old string, new string"
        )
        named = attach(meta, names, ["model", ("name", "old")], {"__new": "new"})
        out = out.put(fields, named.withColumn("name", F.coalesce("__new", "name")).drop("__new"))
    return out


def rename_values(df: DataFrame, columns: Sequence[str], mapping: DataFrame) -> DataFrame:
    """Rename names held as data in the given columns; ``mapping`` is (old, new)."""
    out = df
    for c in columns:
        out = attach(out, mapping, [(c, "old")], {"__new": "new"})
        out = out.withColumn(c, F.coalesce("__new", c)).drop("__new")
    return out.select(*df.columns)


def rename_models(
    ds: Dataset, renames: Sequence[tuple[str, str]], columns: Mapping[str, Sequence[str]]
) -> Dataset:
    """Rename a model wherever its name is stored: ``columns`` is table to column list."""
    out = ds
    for table, names in columns.items():
        if ds.has_table(table):
            df = ds[table]
            mapping = mapping_table(df.sparkSession, renames, "old string, new string")
            out = out.put(table, rename_values(df, names, mapping))
    return out


def add_columns(ds: Dataset, columns: Sequence[tuple[str, str, str, object]]) -> Dataset:
    """Add typed columns (table, column, type, default); one projection per table."""
    out = ds
    for table in dict.fromkeys(t for t, _, _, _ in columns):
        new = {c: F.lit(d).cast(ty) for t, c, ty, d in columns if t == table}
        out = out.put(table, out[table].withColumns(new))
    return out


def add_column_if_absent(df: DataFrame, name: str, type_: str, default=None) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(default).cast(type_))


def copy_columns(df: DataFrame, copies: Sequence[tuple[str, str | None, str | None]]) -> DataFrame:
    """Copy columns (source, target or None, type or None); None keeps the legacy copy."""
    new: dict[str, Column] = {}
    for src, dst, type_ in copies:
        new[dst or legacy_name(src)] = F.col(src).cast(type_) if type_ else F.col(src)
    return df.withColumns(new)


def cast_columns(df: DataFrame, types: Mapping[str, str], on_error: str = "null") -> DataFrame:
    """Change column types; a value that does not fit becomes NULL or stops the run."""
    if on_error not in ("null", "raise"):
        raise ValueError("on_error is null or raise")
    if on_error == "null":
        return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})
    # An expression fails on the executor that meets the value, ANSI mode or not.
    return df.withColumns(
        {
            c: F.when(
                F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(),
                F.raise_error(F.concat(F.lit(f"{c}: cannot cast to {t}: "), F.col(c).cast("string"))).cast(t),
            ).otherwise(F.col(c).try_cast(t))
            for c, t in types.items()
        }
    )


# A whole name that is not part of a longer one nor an attribute of another.
_NAME = r"(?<![\w.])\w+"


def rename_field_references(
    df: DataFrame, col: str, renames: Sequence[tuple[str, str, str]], model_col: str
) -> DataFrame:
    """Rewrite field names (model, old, new) inside stored expressions of that model.

    Every name is looked up once, so renames do not chain and may swap names.
    Of several renames of one name the first counts.
    """
    by_model: dict[str, dict[str, str]] = {}
    for model, old, new in renames:
        by_model.setdefault(model, {}).setdefault(old, new)
    if not by_model:
        return df
    maps = F.create_map(*[
        part for model, names in by_model.items()
        for part in (F.lit(model), F.create_map(*[F.lit(word) for pair in names.items() for word in pair]))
    ])
    names = F.regexp_extract_all(F.col(col), F.lit(_NAME), F.lit(0))
    known = F.try_element_at(maps, F.col(model_col))
    renamed = F.transform(names, lambda n: F.coalesce(F.try_element_at(known, n), n))
    between = F.split(F.col(col), _NAME, -1)
    joined = F.concat_ws("", F.flatten(F.zip_with(between, renamed, lambda gap, name: F.array(gap, F.coalesce(name, F.lit(""))))))
    return df.withColumn(col, F.when(known.isNotNull() & F.col(col).isNotNull(), joined).otherwise(F.col(col)))


def retain_dropped(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Never drop: columns that only the old frame has come back, joined by key."""
    kept = [c for c in old.columns if c not in new.columns]
    return attach(new, old, list(key), kept) if kept else new


def retain_tables(before: Mapping[str, DataFrame], after: Mapping[str, DataFrame]) -> Dataset:
    """Never drop: tables that only the old dataset has stay beside the new ones."""
    return Dataset({**before, **after})


def catalog_rows(spark: SparkSession, module: str, ds: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column of a dataset, as schema differences take it: (module, model, field, type)."""
    rows = [(module, t, f.name, f.dataType.simpleString()) for t, df in ds.items() for f in df.schema.fields]
    return spark.createDataFrame(rows, "module string, model string, field string, type string")


def retained_report(before: Mapping[str, DataFrame], after: Mapping[str, DataFrame]) -> DataFrame | None:
    """One message per table or column of ``before`` that ``after`` no longer has.

    Each says how much is kept: the rows of a table, the values of a column.
    One pass per table; None when nothing was dropped.
    """
    reports = []
    for table, df in before.items():
        if table not in after:
            gone = [("table", table, f"table {table} is kept", F.count(F.lit(1)))]
        else:
            gone = [
                ("column", f"{table}.{c}", f"column {c} of table {table} is kept", F.count(c))
                for c in df.columns
                if c not in after[table].columns
            ]
        if gone:
            counts = df.agg(*[n.alias(f"n{i}") for i, (*_, n) in enumerate(gone)])
            rows = F.array(
                *[
                    F.struct(
                        F.lit(kind).alias("kind"), F.lit(name).alias("name"),
                        F.col(f"n{i}").alias("kept_values"), F.lit(message).alias("message"),
                    )
                    for i, (kind, name, message, _) in enumerate(gone)
                ]
            )
            reports.append(counts.select(F.inline(rows)))
    return reduce(DataFrame.unionByName, reports) if reports else None
