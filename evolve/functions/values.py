"""Row-wise value changes. All are projections: no shuffle, whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evolve.operators.joins import attach
from evolve.storage import small

KEEP = object()

# Longer maps are joined as a mapping table instead of a chain of conditions; only the plan differs.
WHEN_CHAIN = 32


def _lit(value) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(None if value is False else value)


def _key(old, type_: T.DataType) -> Column:
    """An old value in the type of the column; NULL, which matches nothing, where it has no equal there."""
    key = F.lit(old).try_cast(type_)
    if isinstance(old, (int, float)) and not isinstance(old, bool):
        return F.when(key.try_cast("double") == F.lit(old).cast("double"), key)
    return key


def _common_type(df: DataFrame, values: Sequence[Column], rest: Column) -> T.DataType:
    return df.select(F.coalesce(*values, rest).alias("v")).schema["v"].dataType


def map_values(df: DataFrame, src: str, dst: str, pairs: Iterable[tuple], default=KEEP) -> DataFrame:
    """Set ``dst`` from ``src`` through a value map.

    Unmapped values leave ``dst`` as it is, or take ``default``. A map to
    ``None`` or ``False`` stores NULL. Old values are taken in the type of
    ``src`` (one that has no equal there matches nothing); the result has the
    common type of the new values and of what unmapped rows keep.
    """
    # As in a chain of conditions, the first pair of an old value decides.
    pairs = list({old: (old, new) for old, new in reversed(list(pairs))}.values())[::-1]
    if default is not KEEP:
        rest = _lit(default)
    else:
        rest = F.col(dst) if dst in df.columns else F.lit(None)
    if not pairs:
        return df.withColumn(dst, rest)
    # One value of each kind tells the common type.
    kinds = {type(new): _lit(new) for _, new in pairs if not isinstance(new, Column)}
    own = [new for _, new in pairs if isinstance(new, Column)]
    result, key_type = _common_type(df, [*kinds.values(), *own], rest), df.schema[src].dataType
    rest = rest.cast(result)
    if len(pairs) <= WHEN_CHAIN or own:
        chain = F
        for old, new in pairs:
            hit = F.col(src).isNull() if old is None else F.col(src) == _key(old, key_type)
            chain = chain.when(hit, _lit(new).cast(result))
        return df.withColumn(dst, chain.otherwise(rest))
    table = F.array(*[
        F.struct(_key(old, key_type).alias("__old"), _lit(new).cast(result).alias("__new"), F.lit(old is None).alias("__none"), F.lit(at).alias("__at"))
        for at, (old, new) in enumerate(pairs)
    ])
    # Two old values may be equal in the type of the column; the first decides here too.
    mapping = df.sparkSession.range(1).select(F.inline(table)).where("__old IS NOT NULL OR __none")
    mapping = mapping.groupBy("__old").agg(F.min_by(F.struct("__new"), "__at")["__new"].alias("__new")).withColumn("__hit", F.lit(True))
    mapping = small(len(pairs), mapping, sum(len(str(old)) + len(str(new)) for old, new in pairs))
    looked_up = attach(df, mapping, [(src, "__old")], ["__new", "__hit"], null_safe=True)
    mapped = F.when(F.col("__hit"), F.col("__new")).otherwise(rest)
    columns = df.columns if dst in df.columns else [*df.columns, dst]
    return looked_up.withColumn(dst, mapped).select(*columns)


def map_in_place(df: DataFrame, col: str, pairs: Iterable[tuple]) -> DataFrame:
    """Map a column onto itself; every value is looked up once, maps do not chain."""
    return map_values(df, col, col, pairs)


def clamp_to_domain(df: DataFrame, col: str, domain: Sequence, default=None) -> DataFrame:
    """Values outside ``domain`` become ``default``; NULL stays NULL."""
    c = F.col(col)
    return df.withColumn(col, F.when(c.isNull() | c.isin(list(domain)), c).otherwise(F.lit(default)))


def set_where(df: DataFrame, values: Mapping[str, object], predicate: Column) -> DataFrame:
    """Set constants or expressions on the rows that match."""
    return df.withColumns(
        {
            c: F.when(predicate, v if isinstance(v, Column) else F.lit(v)).otherwise(
                F.col(c) if c in df.columns else F.lit(None)
            )
            for c, v in values.items()
        }
    )


def case_map(df: DataFrame, col: str, branches: Sequence[tuple[Column, object]], else_=None) -> DataFrame:
    """Ordered conditional: the first branch that holds decides."""
    chain = F
    for predicate, value in branches:
        chain = chain.when(predicate, value if isinstance(value, Column) else F.lit(value))
    return df.withColumn(col, chain.otherwise(else_ if isinstance(else_, Column) else F.lit(else_)))


def copy_value(df: DataFrame, src: str, dst: str) -> DataFrame:
    return df.withColumn(dst, F.col(src))


def fill_null(df: DataFrame, col: str, value, also_empty: bool = False) -> DataFrame:
    """Fill only what is NULL, and with ``also_empty`` also blank text."""
    current = F.nullif(F.trim(F.col(col)), F.lit("")) if also_empty else F.col(col)
    filler = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(col, F.when(current.isNotNull(), F.col(col)).otherwise(filler))


def invert_flag(df: DataFrame, col: str, dst: str | None = None) -> DataFrame:
    """Boolean NOT in which NULL counts as false, so NULL becomes true."""
    return df.withColumn(dst or col, ~F.col(col).eqNullSafe(F.lit(True)))


def all_present_flag(df: DataFrame, cols: Sequence[str], dst: str) -> DataFrame:
    return df.withColumn(dst, reduce(and_, [F.col(c).isNotNull() for c in cols]))


def split_sign(
    df: DataFrame, col: str, dst: str, neg, pos, where: Column | None = None
) -> DataFrame:
    """A signed number becomes a direction and an absolute amount."""
    chosen = F.lit(True) if where is None else where
    side = F.when(F.col(col) < 0, F.lit(neg)).when(F.col(col).isNotNull(), F.lit(pos))
    old_side = F.col(dst) if dst in df.columns else F.lit(None)
    return df.withColumns(
        {
            dst: F.when(chosen, side).otherwise(old_side),
            col: F.when(chosen, F.abs(F.col(col))).otherwise(F.col(col)),
        }
    )


def scale(df: DataFrame, col: str, factor: float, dst: str | None = None) -> DataFrame:
    """Unit scaling, e.g. ``factor=1 / 60`` for minutes to hours."""
    return df.withColumn(dst or col, F.col(col) * F.lit(float(factor)))


def ratio_or_inverse(
    df: DataFrame, type_col: str, factor_col: str, direct: Sequence[str], dst: str
) -> DataFrame:
    """The factor itself for the types in ``direct``, its inverse for all others."""
    factor = F.col(factor_col).cast("double")
    return df.withColumn(
        dst,
        F.when(F.col(type_col).isin(list(direct)), factor).otherwise(
            F.try_divide(F.lit(1.0), factor)
        ),
    )


# Seconds in one unit.
UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def add_interval(
    df: DataFrame, ts: str, amount: str, unit: str, dst: str, default=0, sign: int = 1
) -> DataFrame:
    """Timestamp plus a duration held in a column; 0 and NULL mean ``default``."""
    number = F.coalesce(F.nullif(F.col(amount).cast("double"), F.lit(0.0)), F.lit(float(default)))
    seconds = (number * F.lit(sign * UNIT_SECONDS[unit])).cast("decimal(18,6)")
    span = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return df.withColumn(dst, F.col(ts) + span)


def local_date(df: DataFrame, ts: str, zone: Column | str, dst: str, default_zone: str = "UTC") -> DataFrame:
    """Calendar date of a UTC instant in the row's own zone.

    The stored value has no zone and is read as UTC, whatever the session zone.
    """
    zone = F.col(zone) if isinstance(zone, str) else zone
    instant = F.col(ts).cast("timestamp_ntz")
    local = F.convert_timezone(F.lit("UTC"), F.coalesce(zone, F.lit(default_zone)), instant)
    return df.withColumn(dst, local.cast("date"))


def agree_or_null(df: DataFrame, a: str, b: str, dst: str) -> DataFrame:
    """The common value where two columns agree, else NULL."""
    return df.withColumn(dst, F.when(F.col(a) == F.col(b), F.col(a)))


def normalise_false(df: DataFrame, col: str, dst: str | None = None) -> DataFrame:
    """Text 'false' becomes NULL; the column may be boolean or text."""
    return df.withColumn(dst or col, F.nullif(F.col(col).cast("string"), F.lit("false")))


def set_if_default(df: DataFrame, current: Mapping[str, object], then: Mapping[str, object]) -> DataFrame:
    """Change a setting only while all of it still has its old default."""
    untouched = reduce(and_, [F.col(c).eqNullSafe(F.lit(v)) for c, v in current.items()])
    return set_where(df, then, untouched)


def offset_sequence(df: DataFrame, base: str, value: str | None, plus: int, dst: str) -> DataFrame:
    """Sequence arithmetic in which NULL counts as 0."""
    number = F.coalesce(F.col(base), F.lit(0)) + F.lit(plus)
    if value is not None:
        number = number + F.coalesce(F.col(value), F.lit(0))
    return df.withColumn(dst, number)


def move_field_key(df: DataFrame, key_col: str, where: Column, new_key: str) -> DataFrame:
    """Hand stored payload to another field by rewriting the key beside it."""
    return set_where(df, {key_col: new_key}, where)
