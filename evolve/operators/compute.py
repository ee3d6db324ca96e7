"""User functions over records, in bounded Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def recompute(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], columns: Mapping[str, str], needs: Sequence[str],
    chunk: int = 10_000,
) -> DataFrame:
    """Run a vectorised compute function over records in chunks of at most ``chunk`` rows.

    ``fn`` gets the columns it ``needs`` and returns the new ``columns`` (name to
    type) in their order. All other columns pass through unconverted. Rows need no
    neighbours, so nothing is shuffled.
    """
    names = [c for c in df.columns if c not in columns]
    kinds = ", ".join(f"`{c}` {t}" for c, t in columns.items())
    types = to_arrow_schema(StructType.fromDDL(kinds))

    def apply(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, chunk):
                part = batch.slice(start, chunk)
                new = fn(part.select(list(needs)).to_pandas())
                made = [pa.Array.from_pandas(new[f.name], type=f.type) for f in types]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), *made], names=[*names, *columns])

    old = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in names]
    return df.mapInArrow(apply, ", ".join([*old, kinds]))


def recompute_where(df: DataFrame, columns: Mapping[str, Column], predicate: Column) -> DataFrame:
    """The same call when the function is an expression: only matching rows change."""
    return df.withColumns(
        {c: F.when(predicate, v).otherwise(F.col(c) if c in df.columns else F.lit(None)) for c, v in columns.items()}
    )
