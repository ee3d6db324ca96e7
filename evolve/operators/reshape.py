"""Making rows: pairs, clones, headers, children, merged and split entities."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evolve.naming import legacy_name
from evolve.operators.joins import attach, drop_related, keep_related, update_from
from evolve.operators.ordered import first_per_key, sequence_over


def next_ids(
    df: DataFrame, id_col: str, order: Sequence[Column | str], taken: DataFrame, taken_col: str, key: Sequence[str] | None = None,
) -> DataFrame:
    """Give new rows the ids after the highest one taken, in a stable order; a unique ``key`` spares storing them whole."""
    top = taken.agg(F.coalesce(F.max(taken_col), F.lit(0)).alias("top"))
    return sequence_over(df, order, id_col, start=top.scalar() + 1, key=key)


def m2o_to_x2m(df: DataFrame, id_col: str, old_column: str, names: tuple[str, str]) -> DataFrame:
    """A single reference becomes a pair table; ``id_col`` is unique, so the pairs are."""
    return df.where(F.col(old_column).isNotNull()).select(
        F.col(id_col).alias(names[0]), F.col(old_column).alias(names[1])
    )


def clone_rows(
    df: DataFrame, overrides: Mapping[str, Column], id_col: str, order: Sequence[Column | str],
    taken: DataFrame, origin_col: str | None = None, key: Sequence[str] | None = None,
) -> DataFrame:
    """Copies of the given rows with new ids and some fields replaced.

    ``origin_col`` remembers which row a copy was made from. ``key`` names
    columns that no two of the given rows have in common.
    """
    origin = origin_col or legacy_name(id_col)
    marked = df.withColumn(origin, F.col(id_col))
    named = [origin if k == id_col else k for k in key] if key else None
    in_order = [origin if o == id_col else o for o in order] if all(isinstance(o, str) for o in order) else order
    numbered = next_ids(marked, id_col, in_order, taken, id_col, named)
    copies = numbered.withColumns(dict(overrides)) if overrides else numbered
    return copies.select(*df.columns, origin)


def pairs_to_parent(
    child: DataFrame, pairs: DataFrame, id_col: str, pair_child: str, pair_parent: str, parent_col: str
) -> DataFrame:
    """Many-to-many becomes a parent pointer.

    A child keeps its least parent; every further parent gets a clone of the
    child with a new id. Children without any parent stay, with a NULL pointer.
    """
    origin = legacy_name(id_col)
    first = pairs.groupBy(pair_child).agg(F.min(pair_parent).alias("__first"))
    kept = attach(child, first, [(id_col, pair_child)], {parent_col: "__first"}, reduced=True)
    further = (
        attach(pairs, first, [pair_child], ["__first"], reduced=True)
        .where(F.col(pair_parent) != F.col("__first"))
        .select(F.col(pair_child).alias("__child"), F.col(pair_parent).alias("__parent")).distinct()
    )
    pair = [id_col, "__parent"]
    sources = child.join(further, F.col(id_col) == F.col("__child"))
    clones = clone_rows(
        sources, {parent_col: F.col("__parent")}, id_col, pair, child, origin, pair
    ) if parent_col in child.columns else clone_rows(
        sources.withColumn(parent_col, F.col("__parent")), {}, id_col, pair, child, origin, pair
    )
    columns = kept.columns
    no_origin = F.lit(None).cast(child.schema[id_col].dataType).alias(origin)
    return kept.select(*columns, no_origin).unionByName(clones.select(*columns, origin))


def clone_last(
    parent: DataFrame, child: DataFrame, on: tuple[str, str], order: Sequence[Column],
    id_col: str, overrides: Mapping[str, Column],
) -> DataFrame:
    """Copy the last child of each given parent; overrides may use the parent's columns.

    ``order`` sorts the last child first.
    """
    pk, ck = on
    last = first_per_key(keep_related(child, parent, [(ck, pk)]), [ck], order)
    with_parent = last.alias("c").join(parent.alias("p"), F.col(f"c.`{ck}`") == F.col(f"p.`{pk}`"))
    values = with_parent.select(
        *[F.col(f"c.`{c}`") for c in child.columns if c not in overrides],
        *[v.alias(n) for n, v in overrides.items()],
    )
    return clone_rows(values.select(*child.columns), {}, id_col, [id_col], child, key=[id_col])


def insert_headers_and_lines(
    lines: DataFrame, options: DataFrame, parent: str, id_col: str, sequence: str, option_id: str,
    line_link: str | None, header: Mapping[str, Column], own_sequence: str | None,
) -> DataFrame:
    """Fold optional rows into the lines of their parents.

    Each parent with options gets one header row at its highest sequence + 1.
    The options follow at + 2 plus their own sequence; with
    ``own_sequence=None`` all of them stand at + 2. An option already placed
    (``line_link`` names its line) only moves that line.
    """
    top = lines.groupBy(parent).agg(F.max(sequence).alias("__top"))
    placed = attach(options, top, [parent], ["__top"], reduced=True)
    base = F.coalesce(F.col("__top"), F.lit(0))
    own = F.coalesce(F.col(own_sequence), F.lit(0)) if own_sequence else F.lit(0)
    placed = placed.withColumn("__seq", (base + 2 + own).cast(lines.schema[sequence].dataType))

    moved, fresh = lines, placed
    if line_link is not None:
        moves = placed.where(F.col(line_link).isNotNull()).select(line_link, option_id, "__seq")
        moved = update_from(
            lines, moves, [(id_col, line_link)], {sequence: F.col("s.__seq")},
            pick=[F.col(option_id).desc()],
        )
        fresh = placed.where(F.col(line_link).isNull())

    def as_line(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
        return df.select(
            *[
                (values[f.name] if f.name in values else F.col(f.name) if f.name in df.columns else F.lit(None))
                .cast(f.dataType).alias(f.name)
                for f in lines.schema.fields if f.name != id_col
            ],
            (F.col(option_id) if option_id in df.columns else F.lit(None)).alias("__option"),
        )

    parents = options.select(parent).distinct()
    headers = as_line(
        attach(parents, top, [parent], ["__top"]).withColumn("__seq", base + 1),
        {**header, sequence: F.col("__seq")},
    )
    added = headers.unionByName(as_line(fresh, {sequence: F.col("__seq")}))
    order = [parent, F.col("__option").asc_nulls_first()]
    numbered = next_ids(added, id_col, order, lines, id_col, [parent, "__option"])
    return moved.unionByName(numbered.select(*lines.columns))


def cross_children(
    members: DataFrame, catalog: DataFrame, on: tuple[str, str], levels: DataFrame, kind: str,
    level_id: str, rank: Sequence[Column], dst: str,
) -> DataFrame:
    """A child row per (parent, member) pair with the default level of the member's kind.

    ``catalog`` gives each member its kind, ``levels`` lists the levels of a
    kind, ``rank`` puts the default level first.
    """
    typed = attach(members, catalog, [on], [kind])
    default = first_per_key(levels, [kind], rank).select(kind, level_id)
    return attach(typed, default, [kind], {dst: level_id}, reduced=True)


def insert_missing_child(
    parent: DataFrame, child: DataFrame, on: tuple[str, str], values: Mapping[str, Column]
) -> DataFrame:
    """Append one default child for every parent that has none."""
    missing = drop_related(parent, child, [on])
    added = missing.select(
        *[v.cast(child.schema[n].dataType).alias(n) for n, v in values.items()]
    )
    return child.unionByName(added, allowMissingColumns=True)


def entities_from_references(
    referrers: DataFrame, ref_col: str, source: DataFrame, source_id: str, columns: Sequence[str],
    dst: str, id_col: str = "id", taken: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """A new entity per source row that is referred to, and the referrers repointed.

    Returns (entities, referrers). The entity keeps the source id in a legacy
    column, the referrer gets the new id in ``dst``.
    """
    link = legacy_name(source_id)
    used = keep_related(source, referrers.where(F.col(ref_col).isNotNull()), [(source_id, ref_col)])
    named = used.select(F.col(source_id).alias(link), *columns)
    if taken is None:
        entities = sequence_over(named, [link], id_col, key=[link])
    else:
        entities = next_ids(named, id_col, [link], taken, id_col, [link])
    pointed = update_from(referrers, entities, [(ref_col, link)], {dst: F.col(f"s.{id_col}")}, unique=True)
    return entities, pointed


def override_if_differs(
    groups: DataFrame, group_id: str, settings: Sequence[str], default: DataFrame, id_col: str, dst: str
) -> tuple[DataFrame, DataFrame]:
    """Groups with the default's settings use it; every other gets its own copy.

    ``default`` holds the one default entity with ``id_col`` and ``settings``.
    Returns (entities, groups): the default plus one copy per differing group,
    and the groups with ``dst`` pointing to theirs.
    """
    wanted = default.select(F.struct(id_col, *settings).alias("d")).scalar()
    differs = F.lit(False)
    for c in settings:
        differs = differs | ~F.col(c).eqNullSafe(wanted[c])
    own = groups.where(differs).select(F.col(group_id).alias("owner"), *settings)
    copies = next_ids(own, id_col, ["owner"], default, id_col, ["owner"])
    base = default.select(id_col, F.lit(None).cast(groups.schema[group_id].dataType).alias("owner"), *settings)
    entities = base.unionByName(copies.select(id_col, "owner", *settings))
    linked = attach(groups, copies, [(group_id, "owner")], {dst: id_col})
    linked = linked.withColumn(dst, F.coalesce(F.col(dst), wanted[id_col]))
    return entities, linked


def split_source(
    source: DataFrame, predicate: Column, given: Mapping[str, Column], computed: Mapping[str, Column]
) -> DataFrame:
    """One source feeds two inserts: rows where ``predicate`` holds, and the others."""
    holds = F.coalesce(predicate, F.lit(False))
    return source.select(
        *[F.when(holds, given[n]).otherwise(computed[n]).alias(n) for n in given]
    )


def link_through_entity(
    df: DataFrame, left: str, right: str, names: tuple[str, str], flags: Mapping[str, Column]
) -> DataFrame:
    """A direct link becomes an entity of its own that keeps a flag."""
    return df.where(F.col(left).isNotNull() & F.col(right).isNotNull()).select(
        F.col(left).alias(names[0]), F.col(right).alias(names[1]),
        *[c.alias(n) for n, c in flags.items()],
    )


def merge_entity(
    target: DataFrame, source: DataFrame, on: tuple[str, str], columns: Mapping[str, str]
) -> DataFrame:
    """Fold one entity into another: ``columns`` maps target names to source columns."""
    sets = {dst: F.col(f"s.`{src}`") for dst, src in columns.items()}
    return update_from(target, source, [on], sets, unique=True)


def ensure_children(
    parent: DataFrame, parent_id: str, existing: DataFrame, on: tuple[str, str],
    specs: Sequence[Mapping[str, object]], keep_existing: bool = True,
) -> DataFrame:
    """A fixed set of default children per parent; ``on`` is (parent key, spec key) in ``existing``.

    The specs are a literal array exploded on each parent, so nothing is joined.
    """
    fk, key = on
    literal = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in s.items()]) for s in specs])
    wanted = parent.select(F.col(parent_id).alias(fk), F.inline(literal))
    if not keep_existing:
        others = drop_related(existing, wanted, [fk, key])
        return others.unionByName(wanted, allowMissingColumns=True)
    return existing.unionByName(drop_related(wanted, existing, [fk, key]), allowMissingColumns=True)
