"""Proofs that nothing changed that should not have.

Two tables are compared from the top. Every row has a digest of 128 bits, and the digests
of a bucket of rows add up to one of the bucket whatever their order, so that a bucket
costs one row per task in the shuffle. Buckets that are equal on both sides hold the same
rows and are done. Only the others are joined, and of their rows only the keys, short
values and digests of long ones move. Digests are compared by chance: two different
buckets pass as equal with a probability of about 2^-100.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType, VariantType

from evolve.operators.groups import multiset_difference
from evolve.operators.joins import attach, drop_related

# Buckets of a comparison, and so the rows of the table that names the unequal ones: 128 KB.
BUCKETS = 1 << 14


def _same_key(keys: Sequence[str]) -> list[Column]:
    """Equal keys, where a NULL part equals a NULL part."""
    return [F.col(f"b.`{k}`").eqNullSafe(F.col(f"a.`{k}`")) for k in keys]


def _hashable(c: Column, kind: DataType) -> Column:
    """A value whose hash tells every part of it: nested ones become text, since hashes pass over NULLs in them."""
    return F.to_json(F.struct(c), {"ignoreNullFields": "false"}) if isinstance(kind, (ArrayType, MapType, StructType, VariantType)) else c


def digest(df: DataFrame, columns: Sequence[str], salt: int = 0) -> Column:
    """64 bits of the named columns, NULLs told apart from their neighbours' values."""
    parts = [F.lit(salt)]
    for c in columns:
        col = F.col(f"`{c}`")
        parts += [col.isNull(), _hashable(col, df.schema[c].dataType)]
    return F.xxhash64(*parts)


def bucket_digests(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """bucket, rows, d1 to d4: rows fall into buckets by a hash of ``by``; d1 to d4 are sums over their digests.

    A digest is summed in halves, which keeps the sums below 64 bits for up to 2^31 rows in a bucket.
    """
    both = df.select(_bucket(df, by).alias("bucket"), digest(df, columns, 1).alias("x"), digest(df, columns, 2).alias("y"))
    halves = [h for c in ("x", "y") for h in (F.col(c).bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(c, 32))]
    return both.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), *[F.sum(h).alias(f"d{i + 1}") for i, h in enumerate(halves)])


def _bucket(df: DataFrame, by: Sequence[str]) -> Column:
    return F.pmod(digest(df, by), F.lit(BUCKETS)).cast("int")


def _comparable(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> bool:
    """Whether digests can tell: the values of both sides have to be of the same types."""
    return all(before.schema[c].dataType == after.schema[c].dataType for c in columns)


def _unequal(before: DataFrame, after: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """bucket, of those that do not hold the same rows on both sides."""
    b, a = bucket_digests(before, by, columns).alias("b"), bucket_digests(after, by, columns).alias("a")
    sums = ["rows", "d1", "d2", "d3", "d4"]
    differ = reduce(or_, [~F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}")) for c in sums])
    return b.join(a, F.col("b.bucket") == F.col("a.bucket"), "full").where(differ).select(F.coalesce("b.bucket", "a.bucket").alias("__unequal"))


def _in_unequal(df: DataFrame, by: Sequence[str], unequal: DataFrame, inside: bool = True) -> DataFrame:
    """Rows in unequal buckets, or all others. At most ``BUCKETS`` numbers are sent to the tasks."""
    return df.join(F.broadcast(unequal), _bucket(df, by) == F.col("__unequal"), "leftsemi" if inside else "leftanti")


def _short(df: DataFrame, keys: Sequence[str], columns: Sequence[str], same_types: bool) -> DataFrame:
    """Keys, and the other columns in a form that is compared as the values are: long values as digests."""
    def form(c: str) -> Column:
        kind, col = df.schema[c].dataType, F.col(f"`{c}`")
        if isinstance(kind, (StringType, BinaryType)) and same_types:
            col = F.when(col.isNotNull(), digest(df, [c]))
        elif isinstance(kind, MapType):
            col = F.array_sort(F.map_entries(col))
        elif isinstance(kind, VariantType):
            col = F.to_json(col)
        return col.alias(c)

    return df.select(*[F.col(f"`{k}`") for k in keys], *[form(c) for c in columns])


def _joined(before: DataFrame, after: DataFrame, keys: Sequence[str], shared: Sequence[str], how: str = "full") -> DataFrame:
    same = _comparable(before, after, shared)
    b, a = (_short(df, keys, shared, same) for df in (before, after))
    return b.withColumn("__b", F.lit(True)).alias("b").join(a.withColumn("__a", F.lit(True)).alias("a"), _same_key(keys), how)


def with_unique_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``, or a failing run if a key occurs twice. One aggregate over 128 bits of every key."""
    marks = df.select(digest(df, keys, 1).alias("x"), digest(df, keys, 2).alias("y")).groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
    most = marks.agg(F.max("n").alias("n"))
    refused = F.raise_error(F.lit(f"keys {', '.join(keys)} are not unique")).cast("boolean")
    return df.where(F.when(F.coalesce(most.scalar(), F.lit(0)) > 1, refused).otherwise(True))


def _shared(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in before.columns if c in after.columns and c not in keys]


def _compared(before: DataFrame, after: DataFrame, keys: Sequence[str], unique: bool) -> tuple[DataFrame, DataFrame, DataFrame | None, list[str]]:
    """Both sides cut down to unequal buckets, those buckets (None where digests cannot tell), and the shared columns."""
    shared = _shared(before, after, keys)
    if unique:
        before, after = with_unique_keys(before, keys), with_unique_keys(after, keys)
    if not _comparable(before, after, [*keys, *shared]):
        return before, after, None, shared
    unequal = _unequal(before, after, keys, [*keys, *shared])
    return _in_unequal(before, keys, unequal), _in_unequal(after, keys, unequal), unequal, shared


def _status(shared: Sequence[str]) -> tuple[Column, Column]:
    """Status of a joined row, and the columns that differ."""
    changed = F.concat_ws(
        ",", *[F.when(~F.col(f"b.`{c}`").eqNullSafe(F.col(f"a.`{c}`")), F.lit(c)) for c in shared]
    ) if shared else F.lit("")
    status = (
        F.when(F.col("__a").isNull(), "only before").when(F.col("__b").isNull(), "only after")
        .when(changed != "", "differs").otherwise("same")
    )
    return status, F.when(status == "differs", changed)


def snapshot_diff(before: DataFrame, after: DataFrame, keys: Sequence[str], unique: bool = False) -> DataFrame:
    """Per row: same, differs, only before or only after; with the columns that differ.

    Keys are unique on each side; with ``unique`` a run where they are not fails. A NULL part of a key equals
    a NULL part. Rows of equal buckets are the same, without a join.
    """
    b, a, unequal, shared = _compared(before, after, keys, unique)
    status, changed = _status(shared)
    out = _joined(b, a, keys, shared).select(
        *[F.coalesce(F.col(f"b.`{k}`"), F.col(f"a.`{k}`")).alias(k) for k in keys], status.alias("status"), changed.alias("changed"),
    )
    if unequal is None:
        return out
    rest = _in_unequal(before, keys, unequal, inside=False)
    return out.unionByName(rest.select(*[F.col(f"`{k}`") for k in keys], F.lit("same").alias("status"), F.lit(None).cast("string").alias("changed")))


def _equal_rows(before: DataFrame, keys: Sequence[str], unequal: DataFrame) -> DataFrame:
    """One row, n: how many rows lie in equal buckets; only keys are read."""
    return _in_unequal(before, keys, unequal, inside=False).agg(F.count(F.lit(1)).alias("n"))


def snapshot_summary(before: DataFrame, after: DataFrame, keys: Sequence[str], unique: bool = False) -> DataFrame:
    """Rows per status, and whether anything moved at all."""
    b, a, unequal, shared = _compared(before, after, keys, unique)
    counted = _joined(b, a, keys, shared).groupBy(_status(shared)[0].alias("status")).agg(F.count(F.lit(1)).alias("rows"))
    if unequal is not None:
        same = _equal_rows(before, keys, unequal).select(F.lit("same").alias("status"), F.col("n").alias("rows")).where("rows > 0")
        counted = counted.unionByName(same).groupBy("status").agg(F.sum("rows").alias("rows"))
    return counted.withColumn("delta", F.col("status") != "same")


def column_changes(before: DataFrame, after: DataFrame, keys: Sequence[str], unique: bool = False) -> DataFrame:
    """How many of the rows on both sides changed, per shared column: one row each."""
    b, a, unequal, shared = _compared(before, after, keys, unique)
    counts = _joined(b, a, keys, shared, "inner").agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(~F.col(f"b.`{c}`").eqNullSafe(F.col(f"a.`{c}`"))).alias(c) for c in shared],
    )
    total = F.col("__rows") if unequal is None else F.col("__rows") + _equal_rows(before, keys, unequal).scalar()
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("changed"), total.alias("rows")) for c in shared])
    return counts.select(F.inline(rows))


def offending_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that break multiset equality, duplicates counted. Rows of equal buckets never move."""
    if set(a.columns) != set(b.columns) or not _comparable(a, b, a.columns):
        return multiset_difference(a, b)
    unequal = _unequal(a, b, a.columns, a.columns)
    return multiset_difference(*(_in_unequal(df, a.columns, unequal) for df in (a, b.select(*[F.col(f"`{c}`") for c in a.columns]))))


def assert_same_rows(a: DataFrame, b: DataFrame) -> None:
    sample = offending_rows(a, b).take(5)
    if sample:
        raise AssertionError(f"rows differ, e.g. {sample}")


def check_rows(df: DataFrame, name: str, predicate: Column) -> DataFrame:
    """Rows that break a declared rule; unknown counts as broken."""
    return df.where(~F.coalesce(predicate, F.lit(False))).withColumn("rule", F.lit(name))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def orphan_rows(child: DataFrame, parent: DataFrame, on: tuple[str, str]) -> DataFrame:
    """Rows whose reference has no target; no reference is no orphan."""
    ck, pk = on
    return drop_related(child.where(F.col(ck).isNotNull()), parent, [(ck, pk)])


# The levels of a log, the last three of which matter.
LOG_LEVELS = ("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL")


def gate_log(lines: DataFrame, text: str, ignore: Sequence[str], level: str | None = None) -> DataFrame:
    """Log lines at warning or above that match none of the ignore patterns.

    Without a ``level`` column the level is the first one named in the text.
    """
    named = F.regexp_extract(text, rf"\b({'|'.join(LOG_LEVELS)})\b", 1) if level is None else F.col(level)
    out = lines.where(named.isin(*LOG_LEVELS[2:]))
    if ignore:
        pattern = "|".join(f"(?:{p})" for p in ignore)
        out = out.where(~F.coalesce(F.col(text).rlike(pattern), F.lit(False)))
    return out


def isolate_failures(
    df: DataFrame, fn: Callable[[pa.RecordBatch], Mapping[str, Sequence | pa.Array]], error_col: str = "error"
) -> DataFrame:
    """Apply a function to whole Arrow batches; a row that fails stays as it was and carries its error.

    ``fn`` returns the columns it changes. A batch that fails is halved until the
    rows that fail stand alone, so a batch without failures costs one call. A
    result that does not fit its column counts as a failure. Prefer ``try_cast``
    and its kin (``isolate_cast``) where an expression can say it.
    """
    def changed(batch: pa.RecordBatch) -> pa.RecordBatch:
        new = fn(batch)
        made = []
        for field in batch.schema:
            values = new.get(field.name, batch.column(field.name))
            made.append(values.cast(field.type) if isinstance(values, pa.Array) else pa.array(values, field.type))
        return pa.RecordBatch.from_arrays([*made, pa.nulls(batch.num_rows, pa.string())], names=[*batch.schema.names, error_col])

    def attempt(batch: pa.RecordBatch):
        try:
            done = changed(batch)
        except Exception as failure:  # the point: one bad row must not end the run
            if batch.num_rows == 1:
                error = pa.array([f"{type(failure).__name__}: {failure}"])
                yield pa.RecordBatch.from_arrays([*batch.columns, error], names=[*batch.schema.names, error_col])
            else:
                half = batch.num_rows // 2
                yield from attempt(batch.slice(0, half))
                yield from attempt(batch.slice(half))
            return
        yield done

    def apply(batches):
        for batch in batches:
            if batch.num_rows:
                yield from attempt(batch)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(apply, f"{fields}, `{error_col}` string")


def isolate_cast(df: DataFrame, col: str, type_: str, dst: str) -> tuple[DataFrame, DataFrame]:
    """Split by whether a text converts: (ok with ``dst``, failed as they were)."""
    value = F.col(col).try_cast(type_)
    bad = value.isNull() & F.col(col).isNotNull()
    return df.where(~bad).withColumn(dst, value), df.where(bad)


def expectation_mismatches(
    result: DataFrame, expected: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Expected values per record against the result: (keys.., column, expected, actual)."""
    marked = result.withColumn("__hit", F.lit(True))
    named = {f"__a_{c}": c for c in columns}
    joined = attach(expected, marked, list(keys), {**named, "__hit": "__hit"})
    checks = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"), F.col(c).cast("string").alias("expected"),
                F.col(f"__a_{c}").cast("string").alias("actual"),
            )
            for c in columns
        ]
    )
    wrong = F.filter(checks, lambda x: ~x["expected"].eqNullSafe(x["actual"]))
    return joined.select(*keys, F.inline(wrong))
