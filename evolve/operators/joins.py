"""Setting columns from other tables, and filtering by them.

No broadcast is forced here: the sides grow with the data, so the planner
decides from statistics.

A hot key on the left is split by adaptive execution, which does so only where
both join inputs come straight from a shuffle made for the join. A source that
was reduced to one row per key already sits on a shuffle by that key and would
be joined as it is, with the hot key in one task. Such a source is therefore
joined by null-safe equality, after its NULL keys are dropped: same result, but
its keys are shuffled for the join. Only the reduced rows pay for that.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evolve.operators.ordered import first_per_key

Keys = Sequence[str | tuple[str, str]]


def _pairs(on: Keys) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else (k[0], k[1]) for k in on]


def _condition(on: Keys, left: str, right: str, null_safe: bool = False) -> Column:
    terms = []
    for a, b in _pairs(on):
        x, y = F.col(f"{left}.`{a}`"), F.col(f"{right}.`{b}`")
        terms.append(x.eqNullSafe(y) if null_safe else x == y)
    return reduce(and_, terms)


def _filled_keys(df: DataFrame, on: Keys) -> DataFrame:
    return df.where(reduce(and_, [F.col(f"`{s}`").isNotNull() for _, s in _pairs(on)]))


def attach(
    df: DataFrame, other: DataFrame, on: Keys, columns: Sequence[str] | Mapping[str, str],
    null_safe: bool = False, reduced: bool = False,
) -> DataFrame:
    """Left join of columns from a frame that is unique on its key.

    ``columns`` may be a mapping of new name to source column. ``reduced`` says
    that ``other`` was made unique by an aggregate or a pick on that key.
    """
    named = columns if isinstance(columns, Mapping) else {c: c for c in columns}
    if reduced and not null_safe:
        other = _filled_keys(other, on)
    return (
        df.alias("t")
        .join(other.alias("s"), _condition(on, "t", "s", null_safe or reduced), "left")
        .select(
            *[F.col(f"t.`{c}`") for c in df.columns if c not in named],
            *[F.col(f"s.`{src}`").alias(dst) for dst, src in named.items()],
        )
    )


def update_from(
    target: DataFrame,
    source: DataFrame,
    on: Keys,
    sets: Mapping[str, Column],
    where: Column | None = None,
    pick: Sequence[Column] | None = None,
    unique: bool = False,
    only_null: bool = False,
    null_safe: bool = False,
    reduced: bool = False,
) -> DataFrame:
    """UPDATE .. FROM: set columns from the matching row of another frame.

    Expressions may name target columns as ``t.x`` and source columns as
    ``s.x``. Several source rows for one key need a rule: ``pick`` orders them
    and the first wins, before the join; ``unique=True`` states that there is
    one at most, ``reduced=True`` that an aggregate by the key made it so.
    ``where`` limits the joined rows that are changed; a condition
    on the source alone belongs on ``source`` itself. Rows without a match stay
    as they are, and ``only_null`` changes NULLs only.
    """
    keys = [s for _, s in _pairs(on)]
    if pick is not None:
        source, reduced = first_per_key(source, keys, pick), True
    elif not (unique or reduced):
        raise ValueError("the source may match more than once: give pick= or unique=True")
    if reduced and not null_safe:
        source = _filled_keys(source, on)
    hit = F.col("s.__hit").isNotNull()
    if where is not None:
        hit = hit & where
    joined = target.alias("t").join(
        source.withColumn("__hit", F.lit(True)).alias("s"), _condition(on, "t", "s", null_safe or reduced), "left"
    )
    out = []
    for c in [*target.columns, *[c for c in sets if c not in target.columns]]:
        old = F.col(f"t.`{c}`") if c in target.columns else F.lit(None)
        if c not in sets:
            out.append(old)
        elif only_null:
            out.append(F.coalesce(old, F.when(hit, sets[c])).alias(c))
        else:
            out.append(F.when(hit, sets[c]).otherwise(old).alias(c))
    return joined.select(*out)


def fallback_chain(
    df: DataFrame, dst: str, hops: Sequence[tuple[DataFrame, Keys, str]], default=None
) -> DataFrame:
    """First non-NULL of several optional parents, each given as (frame, keys, column)."""
    names = []
    out = df
    for i, (parent, on, column) in enumerate(hops):
        names.append(f"__f{i}")
        out = attach(out, parent, on, {names[-1]: column})
    value = F.coalesce(*[F.col(n) for n in names], F.lit(default))
    return out.withColumn(dst, value).drop(*names)


def update_on_first_key(
    target: DataFrame, source: DataFrame, candidates: Sequence[str], key: str, sets: Mapping[str, Column]
) -> DataFrame:
    """Join on the first non-NULL of several foreign keys of the target."""
    keyed = target.withColumn("__key", F.coalesce(*[F.col(c) for c in candidates]))
    return update_from(keyed, source, [("__key", key)], sets, unique=True).drop("__key")


def update_wildcard(
    target: DataFrame, source: DataFrame, on: tuple[str, str], sets: Mapping[str, Column],
    pick: Sequence[Column],
) -> DataFrame:
    """Keys equal, or a NULL target key that matches every source row.

    An update keeps one match, so a NULL key takes the first source row of all.
    That row is added under a NULL key and one null-safe equi join serves both.
    """
    tk, sk = on
    keyed = first_per_key(source.where(F.col(sk).isNotNull()), [sk], pick)
    best = keyed.orderBy(*pick).limit(1).withColumn(sk, F.lit(None).cast(source.schema[sk].dataType))
    both = keyed.unionByName(best)
    return update_from(target, both, [(tk, sk)], sets, unique=True, null_safe=True)


def _key_set(related: DataFrame, on: Keys) -> DataFrame:
    """The distinct keys of a frame: a key that repeats is sent once per map task."""
    return _filled_keys(related, on).select(*[s for _, s in _pairs(on)]).distinct()


def keep_related(df: DataFrame, related: DataFrame, on: Keys) -> DataFrame:
    """IN (subquery) and EXISTS: rows whose key occurs in ``related``."""
    keys = _key_set(related, on)
    return df.alias("t").join(keys.alias("s"), _condition(on, "t", "s", null_safe=True), "left_semi")


def flag_related(df: DataFrame, related: DataFrame, on: Keys, dst: str) -> DataFrame:
    """Like ``keep_related``, but all rows stay and carry a flag."""
    marks = _key_set(related, on).withColumn("__hit", F.lit(True))
    marked = attach(df, marks, on, {dst: "__hit"}, reduced=True)
    return marked.withColumn(dst, F.coalesce(F.col(dst), F.lit(False)))


def drop_related(df: DataFrame, related: DataFrame, on: Keys) -> DataFrame:
    """NOT EXISTS: rows whose key does not occur; a NULL key stays."""
    keys = _key_set(related, on)
    return df.alias("t").join(keys.alias("s"), _condition(on, "t", "s", null_safe=True), "left_anti")


def not_in(df: DataFrame, related: DataFrame, key: str, related_key: str) -> DataFrame:
    """NOT IN as SQL defines it: one NULL in ``related`` leaves no row at all."""
    holds_null = F.coalesce(F.bool_or(F.col(related_key).isNull()), F.lit(False))
    facts = related.agg(F.struct(holds_null.alias("nulls"), (F.count(F.lit(1)) > 0).alias("some")).alias("f")).scalar()
    kept = drop_related(df, related, [(key, related_key)])
    return kept.where(~facts["nulls"] & (F.col(key).isNotNull() | ~facts["some"]))


def best_match(
    left: DataFrame, right: DataFrame, on: Keys, order: Sequence[Column], columns: Mapping[str, str]
) -> DataFrame:
    """The first matching right row of every left row, by an order."""
    best = first_per_key(right, [s for _, s in _pairs(on)], order)
    return attach(left, best, on, columns, reduced=True)


def join_with_rule(left: DataFrame, right: DataFrame, on: Keys, rule: Column) -> DataFrame:
    """Equi join on the shared key with the alternatives of ``rule`` as residual filter."""
    return left.alias("t").join(right.alias("s"), _condition(on, "t", "s") & rule)


def flag_tuple(df: DataFrame, reference: DataFrame, columns: Keys, dst: str) -> DataFrame:
    """Flag rows whose column tuple equals one of the reference tuples, all in one pass."""
    return flag_related(df, reference, columns, dst)


def relate(start: DataFrame, hops: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Follow references: each hop is (next table, key here, key there).

    Semi joins keep the size at the target's; nothing fans out.
    """
    rows = start
    for table, here, there in hops:
        rows = keep_related(table, rows, [(there, here)])
    return rows


def pair_from_condition(
    a: DataFrame, b: DataFrame, on: Keys, columns: Mapping[str, Column], where: Column | None = None,
    distinct: bool = True,
) -> DataFrame:
    """Pairs of a relation table made by a join plus a condition."""
    joined = a.alias("t").join(b.alias("s"), _condition(on, "t", "s"))
    if where is not None:
        joined = joined.where(where)
    pairs = joined.select(*[c.alias(n) for n, c in columns.items()])
    return pairs.distinct() if distinct else pairs


def resolve_default(
    df: DataFrame, defaults: DataFrame, key: str, owner: str, dst: str
) -> DataFrame:
    """The owner's stored default, else the global one (whose owner is NULL).

    ``defaults`` has columns key, owner, value and is unique on (key, owner).
    """
    own = defaults.where("owner IS NOT NULL")
    common = defaults.where("owner IS NULL")
    out = attach(df, own, [(key, "key"), (owner, "owner")], {"__own": "value"}, reduced=True)
    out = attach(out, common, [(key, "key")], {"__all": "value"}, reduced=True)
    return out.withColumn(dst, F.coalesce("__own", "__all")).drop("__own", "__all")
