"""Record identities and upkeep of reference data.

An identity row is (module, name, model, res_id, noupdate).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evolve.dataset import Dataset
from evolve.functions.documents import keep_languages
from evolve.functions.values import set_where
from evolve.operators.joins import attach, drop_related, flag_related, keep_related, update_from
from evolve.operators.ordered import first_per_key
from evolve.operators.units import unit_roots
from evolve.storage import stored


def rename_ids(identity: DataFrame, renames: DataFrame) -> DataFrame:
    """Change module and name; ``renames`` is (old_module, old_name, new_module, new_name)."""
    out = attach(
        identity, renames, [("module", "old_module"), ("name", "old_name")],
        {"__m": "new_module", "__n": "new_name"},
    )
    out = out.withColumns({"module": F.coalesce("__m", "module"), "name": F.coalesce("__n", "name")})
    return out.select(*identity.columns)


def merge_ids(identity: DataFrame, renames: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rename with collisions allowed: several old records become one.

    Returns (identity, id_map). The survivor is the record that already had the
    name, else the least id; ``id_map`` is (model, old_id, new_id) for the rest.
    """
    old_name = identity.withColumn("__had", F.struct("module", "name"))
    renamed = rename_ids(old_name, renames)
    renamed = renamed.withColumn("__moved", F.struct("module", "name") != F.col("__had")).drop("__had")
    winner = first_per_key(renamed, ["module", "name"], [F.col("__moved").asc(), F.col("res_id").asc()])
    survivors = winner.select("module", "name", F.col("res_id").alias("__new"))
    mapped = attach(renamed, survivors, ["module", "name"], ["__new"], reduced=True)
    id_map = mapped.where("res_id <> __new").select(
        "model", F.col("res_id").alias("old_id"), F.col("__new").alias("new_id")
    )
    return winner.select(*identity.columns), id_map


def repoint(df: DataFrame, col: str, id_map: DataFrame) -> DataFrame:
    """Rewrite references through an (old_id, new_id) map that is unique on old_id."""
    return update_from(df, id_map, [(col, "old_id")], {col: F.col("s.new_id")}, reduced=True)


def lookup_id(df: DataFrame, col: str, identity: DataFrame, dst: str, missing: str = "null") -> DataFrame:
    """Resolve 'module.name' to a row id; a name that is missing gives NULL or stops the run."""
    named = identity.select(F.concat_ws(".", "module", "name").alias("__full"), "res_id")
    out = attach(df, named, [(col, "__full")], {dst: "res_id"})
    if missing == "raise":
        unknown = F.raise_error(F.concat(F.lit("unknown record "), F.col(col))).cast("long")
        out = out.withColumn(dst, F.when(F.col(col).isNotNull() & F.col(dst).isNull(), unknown).otherwise(F.col(dst)))
    return out


def set_noupdate(identity: DataFrame, names: DataFrame, flag: bool) -> DataFrame:
    """Protect or unprotect listed (module, name) records from later upserts."""
    marked = flag_related(identity, names, ["module", "name"], "__listed")
    return set_where(marked, {"noupdate": flag}, F.col("__listed")).drop("__listed")


def rename_modules(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """Move all records of a module to another; ``mapping`` is (old, new)."""
    out = attach(df, mapping, [(column, "old")], {"__new": "new"})
    return out.withColumn(column, F.coalesce("__new", column)).drop("__new").select(*df.columns)


def merge_modules(df: DataFrame, column: str, mapping: DataFrame, key: Sequence[str], keep: Sequence[Column]) -> DataFrame:
    """Like ``rename_modules``, but names that now collide keep one row by ``keep``."""
    return first_per_key(rename_modules(df, column, mapping), [column, *key], keep)


def merge_models(
    references: DataFrame, model_col: str, id_col: str, old: str, new: str, id_map: DataFrame
) -> DataFrame:
    """Repoint generic (model, id) references from a merged model to the survivor.

    ``id_map`` is (old_id, new_id), read off the survivor's reference column.
    A reference whose record was not merged stays.
    """
    return update_from(
        references, id_map, [(id_col, "old_id")],
        {model_col: F.lit(new), id_col: F.col("s.new_id")},
        where=F.col(f"t.`{model_col}`") == old, reduced=True,
    )


def closed_merges(maps: Sequence[DataFrame]) -> DataFrame:
    """One map (model, old_id, new_id) of several lists of merges: every record leads to the one that is left at the end.

    The lists belong together, so a record that one list merges into another may be merged on by any list. One that
    two lists merge into different records, and a circle, stop the run.
    """
    edges = stored(reduce(DataFrame.unionByName, [m.select("model", "old_id", "new_id") for m in maps]).where("old_id <> new_id").distinct())
    twice = edges.groupBy("model", "old_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("model", "old_id").take(3)
    if twice:
        raise ValueError(f"merged into several records: {[tuple(r) for r in twice]}")
    node = lambda c: F.to_json(F.struct(F.col("model"), F.col(c).alias("id")))
    pointers = edges.select(node("old_id").alias("id"), node("new_id").alias("up"))
    ends = drop_related(pointers.select(F.col("up").alias("id")).distinct(), pointers, ["id"]).withColumn("up", F.lit(None).cast("string"))
    roots = unit_roots(pointers.unionByName(ends), "id", "up")
    named = edges.select("model", "new_id", node("new_id").alias("__end")).distinct()
    led = attach(edges.select("model", "old_id", node("old_id").alias("__node")), roots, [("__node", "id")], {"__end": "root"})
    return attach(led, named, ["model", "__end"], ["new_id"]).select("model", "old_id", "new_id")


def repoint_all(ds: Dataset, references: Sequence[tuple[str, str, str]], id_map: DataFrame) -> Dataset:
    """Rewrite every referring column (table, column, model) once through a closed map (model, old_id, new_id)."""
    out = ds
    for table, column, model in references:
        out = out.put(table, repoint(out[table], column, id_map.where(F.col("model") == model).select("old_id", "new_id")))
    return out


def peel(doomed: DataFrame, uses: DataFrame) -> DataFrame:
    """Which doomed records have to stay: (model, id, uses), with the number of uses that hold each.

    ``uses`` is (model, id, to_model, to_id): a row and the record it refers to; rows that are no records have a
    NULL model. Records go in rounds, first those that nothing refers to, then those that only these referred to.
    What is used by a row that stays, stays, and so does what it refers to; records that refer to each
    other in a circle hold each other. Uses are counted before they are shuffled, so a record that a third of
    all rows refer to costs one row per task.
    """
    left = stored(doomed.select("model", "id").distinct())
    pairs = [("to_model", "model"), ("to_id", "id")]
    aimed = keep_related(uses.where("not (model <=> to_model and id <=> to_id)"), left, pairs)
    # Of a row that stays it does not matter which it is.
    inside = flag_related(aimed, left, ["model", "id"], "__inside")
    source = F.when(F.col("__inside"), F.col("id")).alias("id")
    held = stored(inside.select(F.when(F.col("__inside"), F.col("model")).alias("model"), source, "to_model", "to_id")
                  .groupBy("model", "id", "to_model", "to_id").agg(F.count(F.lit(1)).alias("n")))
    while True:
        free = stored(left.alias("t").join(held.select("to_model", "to_id").distinct().alias("s"), F.expr("t.model <=> s.to_model and t.id <=> s.to_id"), "left_anti"))
        if free.isEmpty():
            break
        left = stored(drop_related(left, free, ["model", "id"]))
        held = stored(held.alias("t").join(free.alias("s"), F.expr("t.model = s.model and t.id = s.id"), "left_anti"))
    counts = held.groupBy("to_model", "to_id").agg(F.sum("n").alias("uses"))
    return attach(left, counts, [("model", "to_model"), ("id", "to_id")], ["uses"], reduced=True)


def delete_in_order(
    ds: Dataset, ids: Mapping[str, str], doomed: DataFrame, references: Sequence[tuple[str, str, str]],
) -> tuple[Dataset, DataFrame]:
    """Delete records of several tables that may refer to each other; what is still in use stays and is reported.

    ``ids`` names the id column of each table, ``doomed`` is (model, id), with tables as models, and ``references``
    are (table, column, table it refers to). Returns (dataset, blocked), the second as (model, id, uses).
    """
    text = lambda c: F.col(f"`{c}`").cast("string")
    uses = [
        ds[table].where(F.col(f"`{column}`").isNotNull()).select(
            F.lit(table if table in ids else None).cast("string").alias("model"), (text(ids[table]) if table in ids else F.lit(None).cast("string")).alias("id"),
            F.lit(to).alias("to_model"), text(column).alias("to_id"))
        for table, column, to in references
    ]
    known = [ds[table].select(F.lit(table).alias("model"), text(column).alias("id")) for table, column in ids.items()]
    listed = keep_related(reduce(DataFrame.unionByName, known), doomed.select("model", F.col("id").cast("string").alias("id")), ["model", "id"])
    listed = stored(listed)
    blocked = stored(peel(listed, reduce(DataFrame.unionByName, uses))) if uses else listed.limit(0).withColumn("uses", F.lit(0).cast("long"))
    gone = drop_related(listed, blocked, ["model", "id"])
    out = ds
    for table, column in ids.items():
        mine = gone.where(F.col("model") == table).select(F.col("id").cast(ds[table].schema[column].dataType).alias("__gone"))
        out = out.put(table, drop_related(out[table], mine, [(column, "__gone")]))
    return out, blocked


def delete_records_safely(
    records: DataFrame, id_col: str, doomed: DataFrame, references: Sequence[tuple[DataFrame, str] | tuple[DataFrame, str, str]],
) -> tuple[DataFrame, DataFrame]:
    """Delete by id; a record still in use stays and is reported.

    Returns (kept, blocked). A reference is (table, column), or (table, column, id column) for rows that are
    such records themselves: those that go do not hold others. Without any of the second kind all referring
    columns are reduced to one set of used ids; both flags are joined on the same partitioning of the records.
    """
    id_type = records.schema[id_col].dataType
    if any(len(r) == 3 for r in references):
        uses = [
            table.where(F.col(f"`{column}`").isNotNull()).select(
                F.lit("r" if own else None).cast("string").alias("model"), (F.col(f"`{own[0]}`") if own else F.lit(None)).cast(id_type).alias("id"),
                F.lit("r").alias("to_model"), F.col(f"`{column}`").cast(id_type).alias("to_id"))
            for table, column, *own in references
        ]
        listed = keep_related(records.select(F.lit("r").alias("model"), F.col(id_col).alias("id")), doomed.select(F.col(id_col).alias("id")), ["id"])
        listed = stored(listed)
        held = stored(peel(listed, reduce(DataFrame.unionByName, uses)).select(F.col("id").alias(id_col)))
        gone = drop_related(listed.select(F.col("id").alias(id_col)), held, [id_col])
        return drop_related(records, gone, [id_col]), held
    used = [table.select(F.col(column).cast(id_type).alias(id_col)) for table, column in references]
    used = reduce(DataFrame.unionByName, used) if used else records.select(id_col).where(F.lit(False))
    marked = flag_related(flag_related(records, doomed, [id_col], "__doomed"), used, [id_col], "__used")
    kept = marked.where(~F.col("__doomed") | F.col("__used")).drop("__doomed", "__used")
    return kept, keep_related(doomed.select(id_col), used, [id_col])


def drop_translations(
    df: DataFrame, id_col: str, ids: DataFrame, columns: Sequence[str], keep: str = "en_US"
) -> DataFrame:
    """Keep only the source language in translated columns of the listed records."""
    listed = flag_related(df, ids, [id_col], "__listed")
    return set_where(
        listed, {c: keep_languages(F.col(c), [keep]) for c in columns}, F.col("__listed")
    ).drop("__listed")


def clear_transient(ds: Dataset, models: DataFrame | Sequence[str]) -> Dataset:
    """Empty the tables of short-lived models, keeping their schema."""
    out = ds
    for table in models:
        if out.has_table(table):
            out = out.put(table, out[table].where(F.lit(False)))
    return out


def disable_invalid_filters(
    filters: DataFrame, id_col: str, text_col: str, model_col: str, pattern: str, fields: DataFrame, active: str
) -> DataFrame:
    """Deactivate saved filters that name a field their model no longer has.

    ``pattern`` has one group that captures a field name; ``fields`` is (model, name).
    """
    named = filters.select(
        id_col, F.col(model_col).alias("model"),
        F.explode(F.array_distinct(F.regexp_extract_all(F.col(text_col), F.lit(pattern), F.lit(1)))).alias("name"),
    )
    broken = drop_related(named, fields, ["model", "name"]).select(id_col)
    marked = flag_related(filters, broken, [id_col], "__broken")
    return set_where(marked, {active: False}, F.col("__broken")).drop("__broken")


def clear_demo_flag(modules: DataFrame, condition: Column, flag: str) -> DataFrame:
    """Unmark every module when some row meets ``condition`` (the base one is older and marked)."""
    due = modules.agg(F.coalesce(F.bool_or(condition), F.lit(False)).alias("due"))
    return set_where(modules, {flag: False}, due.scalar())


def propagate_auto_install(
    modules: DataFrame, deps: DataFrame, name: str, state: str, auto: str,
    present: Sequence[str], skip_prefix: str, to: str = "to install",
) -> DataFrame:
    """Mark uninstalled auto-install modules whose dependencies are all present.

    One round; a module without dependencies qualifies. ``deps`` is (module, depends_on).
    """
    states = modules.select(F.col(name).alias("__dep"), F.col(state).alias("__state"))
    met = attach(deps, states, [("depends_on", "__dep")], ["__state"]).groupBy("module").agg(
        F.bool_and(F.coalesce(F.col("__state").isin(list(present)), F.lit(False))).alias("__met")
    )
    judged = attach(modules, met, [(name, "module")], ["__met"], reduced=True)
    ready = (
        F.col(auto) & (F.col(state) == "uninstalled")
        & F.coalesce("__met", F.lit(True)) & ~F.col(name).startswith(skip_prefix)
    )
    return set_where(judged, {state: to}, ready).drop("__met")


def exclude_versions(steps: DataFrame, excluded: DataFrame) -> DataFrame:
    """Drop the listed (module, version) steps."""
    return drop_related(steps, excluded, ["module", "version"])


def mark_unmodified(
    copies: DataFrame, upstream: DataFrame, on: tuple[str, str], text: str, flag: str
) -> DataFrame:
    """Flag copies whose text equals the upstream text, blank runs aside; only digests of the texts are joined."""
    def digest(c: str) -> Column:
        return F.coalesce(F.sha2(F.trim(F.regexp_replace(c, r"\s+", " ")).cast("binary"), 256), F.lit("none"))

    ck, uk = on
    out = attach(copies, upstream.select(uk, digest(text).alias("__up")), [(ck, uk)], ["__up"])
    return out.withColumn(flag, F.coalesce(F.col("__up") == digest(text), F.lit(False))).drop("__up")


def follow_upstream(
    copies: DataFrame, upstream: DataFrame, on: tuple[str, str], text: str, flag: str
) -> DataFrame:
    """Give the flagged copies the new upstream text."""
    return update_from(
        copies, upstream, [on], {text: F.col(f"s.`{text}`")}, where=F.col(f"t.`{flag}`"), unique=True
    )


def reassign_reference(df: DataFrame, col: str, old, new, fill: tuple[str, object] | None = None) -> DataFrame:
    """Repoint rows from a retiring record to another and fill an empty text on them."""
    moved = F.col(col) == F.lit(old)
    values: dict[str, object] = {col: new}
    if fill is not None:
        name, text = fill
        values[name] = F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit(text))
    return set_where(df, values, moved)


def unlink_member(pairs: DataFrame, members: DataFrame, left: str, right: str) -> DataFrame:
    """Remove listed (left, right) members of a relation."""
    return drop_related(pairs, members, [left, right])


def set_members(pairs: DataFrame, members: DataFrame, owners: DataFrame, left: str) -> DataFrame:
    """Replace the whole member list of the given owners."""
    return drop_related(pairs, owners, [left]).unionByName(members)


def clear_column(df: DataFrame, id_col: str, ids: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Reset columns of the listed records to NULL."""
    listed = flag_related(df, ids, [id_col], "__listed")
    return set_where(listed, {c: F.lit(None) for c in columns}, F.col("__listed")).drop("__listed")


def delete_where_related(df: DataFrame, col: str, parents: DataFrame, parent_id: str) -> DataFrame:
    """Delete rows that point to one of the given parents."""
    return drop_related(df, parents, [(col, parent_id)])


def fill_from_template(
    entities: DataFrame, template_col: str, templates: DataFrame, columns: Sequence[str],
) -> tuple[DataFrame, DataFrame]:
    """Fill unset settings from the entity's named template (``templates.template``).

    Returns (entities, unknown): the second lists template names nobody knows,
    with the number of entities skipped for it.
    """
    sets = {c: F.col(f"s.`{c}`") for c in columns}
    filled = update_from(
        entities, templates, [(template_col, "template")], sets, reduced=True, only_null=True
    )
    unknown = (
        drop_related(entities.where(F.col(template_col).isNotNull()), templates, [(template_col, "template")])
        .groupBy(F.col(template_col).alias("template")).agg(F.count(F.lit(1)).alias("skipped"))
    )
    return filled, unknown
