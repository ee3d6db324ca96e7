"""Numbering, running values and look-back over an order, without one big task.

A plain window gathers a whole group in one task, and a global one gathers the
whole table. So rows are range-partitioned by (group, order), which spreads a hot
group over many partitions, and each partition works on its own stretch. Callers
whose groups are small by nature (the lines of an order) may say ``spread=False``
for a plain window, which stores nothing. Both ways give the same results.

What a stretch needs from the ones before it is one row per stretch at most: a
group continues into a partition only if it is the first group there. That carry
frame is bounded by the number of partitions and is broadcast.

The order is fixed by storing the sorted rows; a row's position is its file and its
place in it, which the reader knows, so nothing is stored for it. A caller who names a
unique ``key`` has only the groups, that key and the values stored and sorted, and the
results joined back to the table by it; without one the whole rows are the result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType
from pyspark.sql.window import Window

from evolve.storage import stored

_POS, _SEG = "__pos", "__seg"


@dataclass(frozen=True)
class Running:
    """One running value: count, sum, max, lag, last (last non-NULL) or before (last non-NULL above)."""

    kind: str
    column: str | None = None


def _content_hash(df: DataFrame) -> Column:
    """Breaks ties by what a row holds, so that equal keys still spread and stay repeatable."""
    plain = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*[F.col(f"`{c}`") for c in plain])


# What one task of a sort gets of its input, if that asks for more tasks than the session's setting.
TASK_BYTES = 128 << 20


def _width(df: DataFrame) -> int | None:
    """Partitions that the size of the input asks for, if more than the session's setting; known sizes only."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    wanted = sum(n for n in sizes if n < 1 << 60) // TASK_BYTES
    return wanted if wanted > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def _lay_out(df: DataFrame, order: Sequence[Column | str], columns: Sequence[str]) -> DataFrame:
    """Sort globally and fix the order by storing ``columns``: adds the stretch, and the position over all of them."""
    width = _width(df)
    spread = df.repartitionByRange(width, *order) if width else df.repartitionByRange(*order)
    # Values that a caller adds for the occasion are named like the marks here, never like columns of a table.
    laid = stored(spread.sortWithinPartitions(*order).select(*[F.col(f"`{c}`") for c in dict.fromkeys(columns)]))
    part = F.regexp_extract("_metadata.file_path", r"part-(\d+)", 1).cast("long")
    placed = laid.select("*", part.alias(_SEG), F.col("_metadata.row_index").alias("__row"))
    return placed.withColumn(_POS, F.shiftleft(F.col(_SEG), 33) + F.col("__row")).drop("__row")


def _joined_back(df: DataFrame, found: DataFrame, key: Sequence[str], dst: Sequence[str]) -> DataFrame:
    """Results by a unique key beside their rows; a NULL part of a key equals a NULL part."""
    on = reduce(and_, [F.col(f"t.`{k}`").eqNullSafe(F.col(f"s.`{k}`")) for k in key])
    return df.alias("t").join(found.alias("s"), on, "left").select(
        *[F.col(f"t.`{c}`") for c in df.columns if c not in dst], *[F.col(f"s.`{d}`") for d in dst])


def _local(spec: Running, window) -> Column:
    if spec.kind == "count":
        return F.row_number().over(window).cast("long")
    rows = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if spec.kind == "sum":
        return F.sum(spec.column).over(rows)
    if spec.kind == "max":
        return F.max(spec.column).over(rows)
    if spec.kind == "last":
        return F.last(spec.column, ignorenulls=True).over(rows)
    if spec.kind == "before":
        return F.last(spec.column, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, -1))
    if spec.kind == "lag":
        return F.lag(F.struct(F.col(spec.column).alias("v"))).over(window)
    raise ValueError(f"unknown running value {spec.kind}")


def _total(spec: Running) -> Column:
    """What one stretch hands on."""
    if spec.kind == "count":
        return F.count(F.lit(1))
    if spec.kind == "sum":
        return F.sum(spec.column)
    if spec.kind == "max":
        return F.max(spec.column)
    if spec.kind in ("last", "before"):
        return F.max_by(spec.column, F.when(F.col(spec.column).isNotNull(), F.col(_POS)))
    return F.max_by(F.struct(F.col(spec.column).alias("v")), F.col(_POS))


def _fold(spec: Running, total: str, before) -> Column:
    """Totals of the stretches before this one, folded to one value."""
    if spec.kind in ("count", "sum"):
        return F.sum(total).over(before)
    if spec.kind == "max":
        return F.max(total).over(before)
    return F.last(total, ignorenulls=True).over(before)


def _combine(spec: Running, local: Column, carry: Column) -> Column:
    if spec.kind in ("count", "sum"):
        return F.when(carry.isNull(), local).when(local.isNull(), carry).otherwise(local + carry)
    if spec.kind == "max":
        return F.greatest(local, carry)
    both = F.coalesce(local, carry)
    return both["v"] if spec.kind == "lag" else both


def running(
    df: DataFrame, by: Sequence[str], order: Sequence[Column | str], values: Mapping[str, Running],
    unique: bool = False, spread: bool = True, key: Sequence[str] | None = None,
) -> DataFrame:
    """Add running values per group ``by`` in ``order`` (rows up to and including this one).

    With ``spread=False`` every group is worked on by one task. Sums are of whole
    numbers and decimals only, since a sum of floats depends on how rows are cut.
    Ties are broken by the unique ``key``, else by the content of the rows unless
    the order is ``unique`` in its group.
    """
    for spec in values.values():
        if spec.kind == "sum" and isinstance(df.schema[spec.column].dataType, (FloatType, DoubleType)):
            raise TypeError(f"{spec.column}: sum decimals or whole numbers, cast first")
    by, ties = list(by), [] if unique else [*key] if key else [_content_hash(df)]
    order = [*order, *ties]
    if by and not spread:
        window = Window.partitionBy(*by).orderBy(*order)
        plain = {d: _local(s, window) for d, s in values.items()}
        return df.select(
            *[c for c in df.columns if c not in values],
            *[(c["v"] if values[d].kind == "lag" else c).alias(d) for d, c in plain.items()],
        )
    carried = [s.column for s in values.values() if s.column is not None]
    laid = _lay_out(df, [*by, *order], [*by, *key, *carried] if key else df.columns)
    here = Window.partitionBy(*by, _SEG).orderBy(_POS)
    local = laid.select("*", *[_local(s, here).alias(f"__l_{d}") for d, s in values.items()])

    totals = laid.groupBy(*by, _SEG).agg(*[_total(s).alias(f"__t_{d}") for d, s in values.items()])
    stretches = Window.partitionBy(*by).orderBy(_SEG)
    before = stretches.rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        totals.select(
            *[F.col(b).alias(f"__b_{i}") for i, b in enumerate(by)],
            F.col(_SEG).alias("__s"),
            F.row_number().over(stretches).alias("__n"),
            *[_fold(s, f"__t_{d}", before).alias(f"__c_{d}") for d, s in values.items()],
        )
        .where("__n > 1")
        .drop("__n")
    )
    same = [F.col(b).eqNullSafe(F.col(f"__b_{i}")) for i, b in enumerate(by)]
    on = reduce(and_, [F.col(_SEG) == F.col("__s"), *same])
    joined = local.join(F.broadcast(carry), on, "left")
    results = [_combine(s, F.col(f"__l_{d}"), F.col(f"__c_{d}")).alias(d) for d, s in values.items()]
    if key:
        return _joined_back(df, joined.select(*[F.col(f"`{k}`") for k in key], *results), key, list(values))
    return joined.select(*[c for c in df.columns if c not in values], *results)


def sequence_over(
    df: DataFrame, order: Sequence[Column | str], dst: str, start: Column | int = 1, unique: bool = False,
    key: Sequence[str] | None = None,
) -> DataFrame:
    """Number all rows 1, 2, 3 .. in a global order.

    Only the count of each partition meets in one task. With a unique ``key``
    only that is stored, and the numbers are joined to the rows by it.
    """
    ties = [] if unique else [*key] if key else [_content_hash(df)]
    laid = _lay_out(df, [*order, *ties], key or df.columns)
    counts = laid.groupBy(F.col(_SEG).alias("__s")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__s", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o"))
    first = F.col("__o") + F.col(_POS) - F.shiftleft(F.col(_SEG), 33)
    start = start if isinstance(start, Column) else F.lit(start)
    numbered = (
        laid.join(F.broadcast(offsets), F.col(_SEG) == F.col("__s"))
        .withColumn(dst, (first + start).cast("long"))
        .drop(_POS, _SEG, "__s", "__o")
    )
    return _joined_back(df, numbered, key, [dst]) if key else numbered


def number_within(
    df: DataFrame, by: Sequence[str], order: Sequence[Column | str], dst: str, spread: bool = True,
    key: Sequence[str] | None = None,
) -> DataFrame:
    """Number the rows of each group 1, 2, 3 .. in an order."""
    return running(df, by, order, {dst: Running("count")}, spread=spread, key=key)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group (DISTINCT ON).

    Each map task keeps one row per key before the shuffle, so a hot key costs
    no more than one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(window)).where("__rn = 1").drop("__rn")


def fill_down(
    df: DataFrame, by: Sequence[str], order: Sequence[Column | str], col: str, dst: str, spread: bool = True,
    key: Sequence[str] | None = None,
) -> DataFrame:
    """Carry the last non-NULL value down to the rows that follow."""
    return running(df, by, order, {dst: Running("last", col)}, spread=spread, key=key)


def group_changes(
    df: DataFrame, by: Sequence[str], order: Sequence[Column | str], key: str, spread: bool = True,
    row_key: Sequence[str] | None = None,
) -> DataFrame:
    """Rows whose ``key`` differs from the row before them in their group; ``row_key`` is unique."""
    tagged = df.withColumn("__k", F.struct(F.col(key).alias("k")))
    previous = running(tagged, by, order, {"__prev": Running("lag", "__k")}, spread=spread, key=row_key)
    return previous.where(~F.col("__prev").eqNullSafe(F.col("__k"))).drop("__prev", "__k")


def running_ratio(
    df: DataFrame, partition: Sequence[str], time: str, num: str, den: str, dst: str, scale: int = 4,
    spread: bool = True,
) -> DataFrame:
    """Sum of ``num`` up to each time over the sum of ``den`` up to it.

    One row per (partition, time): rows of equal time are peers and enter
    together, so they are summed before the shuffle. NULL keys form a group of
    their own. Times whose running ``den`` is zero are left out.
    """
    def exact(c: str) -> Column:
        return F.sum(F.col(c).cast(f"decimal(18,{scale})")).cast(f"decimal(28,{scale})")

    per_time = df.groupBy(*partition, time).agg(exact(num).alias("__num"), exact(den).alias("__den"))
    sums = running(
        per_time, partition, [time], {"__num": Running("sum", "__num"), "__den": Running("sum", "__den")},
        unique=True, spread=spread,
    )
    ratio = F.try_divide(F.col("__num").cast("double"), F.col("__den").cast("double"))
    return sums.where("__den <> 0").select(*partition, time, ratio.alias(dst))


def collect_aligned(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], cols: Sequence[str], dst: str,
    chunk: int, chunk_col: str = "chunk", spread: bool = True,
) -> DataFrame:
    """Several columns of a group as ordered arrays of structs.

    One row per (keys.., chunk): an array holds at most ``chunk`` items and a
    longer group goes on in the next chunk, so no task ever holds an unbounded
    group. Join on the keys and chunk, or see ``whole_arrays`` for one row per key.
    """
    if all(isinstance(o, str) for o in order):
        df = df.select(*dict.fromkeys([*keys, *order, *cols]))
    numbered = number_within(df, keys, order, "__rn", spread)
    cut = numbered.withColumn(chunk_col, F.floor((F.col("__rn") - 1) / chunk).cast("long"))
    item = F.struct("__rn", *cols)
    packed = cut.groupBy(*keys, chunk_col).agg(F.array_sort(F.collect_list(item)).alias(dst))
    return packed.withColumn(
        dst, F.transform(dst, lambda x: F.struct(*[x[c].alias(c) for c in cols]))
    )


def whole_arrays(packed: DataFrame, keys: Sequence[str], col: str, chunk_col: str = "chunk") -> DataFrame:
    """The chunks of each group put together: one row per key, for groups that one task can hold."""
    parts = packed.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(chunk_col, col))).alias(col))
    return parts.withColumn(col, F.flatten(F.transform(col, lambda x: x[col])))


def explode_aligned(df: DataFrame, col: str) -> DataFrame:
    """Walk an array of structs row by row."""
    rest = [c for c in df.columns if c != col]
    return df.select(*rest, F.inline(F.col(col)))
