"""Record patches: edit them, apply them to a table, apply relation commands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evolve.operators.joins import attach, drop_related


def transform_patch(
    patch: DataFrame,
    drop_records: DataFrame | None = None,
    drop_fields: DataFrame | None = None,
    drop_everywhere: Sequence[str] = (),
    set_attributes: DataFrame | None = None,
) -> DataFrame:
    """Edit a patch before it is applied.

    ``drop_records`` holds record_id, ``drop_fields`` (record_id, field),
    ``drop_everywhere`` field names, ``set_attributes`` (record_id, forcecreate).
    """
    out = patch
    if drop_everywhere:
        out = out.where(~F.col("field").isin(list(drop_everywhere)))
    if drop_records is not None:
        out = drop_related(out, drop_records, ["record_id"])
    if drop_fields is not None:
        out = drop_related(out, drop_fields, ["record_id", "field"])
    if set_attributes is not None:
        out = attach(out, set_attributes, ["record_id"], {"__force": "forcecreate"})
        out = out.withColumn("forcecreate", F.coalesce("__force", "forcecreate")).drop("__force")
    return out.select(*patch.columns)


def _named_record(value: Column) -> Column:
    """The record a ref(..) call names."""
    return F.nullif(F.regexp_extract(value, r"ref\(\s*['\"]([^'\"]+)['\"]", 1), F.lit(""))


_REF = r"ref\(\s*['\"]([^'\"]+)['\"][^)]*\)"


def _inner_references(patch: DataFrame, names: DataFrame) -> DataFrame:
    """Text of a str(..) call with every ref(..) inside replaced by its record id; NULL if one has none."""
    inner = F.regexp_extract("value", r"(?s)^\s*str\((.*)\)\s*$", 1)
    calls = patch.withColumn("__row", F.monotonically_increasing_id()).withColumn("__text", inner)
    named = calls.select("__row", "module", F.posexplode(F.regexp_extract_all("__text", F.lit(_REF), F.lit(1))).alias("__at", "__name"))
    full = F.when(F.col("__name").contains("."), F.col("__name")).otherwise(F.concat_ws(".", "module", "__name"))
    found = attach(named.withColumn("__ref", full), names, [("__ref", "__full")], ["__id"])
    ids = found.groupBy("__row").agg(F.array_sort(F.collect_list(F.struct("__at", "__id"))).alias("__ids"))
    gaps = F.split("__text", _REF, -1)
    put = F.zip_with(gaps, "__ids", lambda gap, i: F.concat(gap, F.when(i.isNull(), F.lit("")).otherwise(i["__id"])))
    whole = F.when(F.exists(put, lambda x: x.isNull()), F.lit(None)).otherwise(F.array_join(put, ""))
    joined = calls.join(ids, "__row", "left")
    return joined.withColumn("value", F.when(F.col("__ids").isNull(), F.col("__text")).otherwise(whole)).select(*patch.columns)


def resolve_values(
    patch: DataFrame, identity: DataFrame, booleans: Sequence[str] = (), files: DataFrame | None = None
) -> DataFrame:
    """Turn the literals of a patch into plain values: (.., value, kind) to (.., value).

    References become record ids, NULL where nobody has the name; a name without
    a module belongs to the patch's. None and False become NULL, but False stays
    for the fields in ``booleans``. Quoted text loses its quotes; the text of a
    str(..) call keeps its form, with ids for the references inside. Lists of
    member commands are left out: see ``member_commands``. A field held in a file
    takes the content that ``files`` (path, content) has for it; without one it is
    left out, so that what is stored stays.
    """
    names = identity.select(F.concat_ws(".", "module", "name").alias("__full"), F.col("res_id").cast("string").alias("__id"))
    called = (F.col("kind") == "eval") & F.coalesce(F.col("value").rlike(r"^\s*str\("), F.lit(False))
    texts = _inner_references(patch.where(called), names).drop("kind")
    held = patch.where("kind = 'file'").drop("kind")
    loaded = held.where("false")
    if files is not None:
        content = files.select(F.col("path").alias("__path"), F.col("content").alias("__content"))
        loaded = held.join(content, F.col("value") == F.col("__path")).withColumn("value", F.col("__content")).select(*held.columns)
    patch = patch.where("kind <> 'file'").where(~called)
    value, evaluated = F.col("value"), F.col("kind") == "eval"
    name = F.when(F.col("kind") == "ref", value).when(evaluated & value.startswith("ref("), _named_record(value))
    full = F.when(name.contains("."), name).otherwise(F.concat_ws(".", F.col("module"), name))
    plain = patch.where(~(evaluated & value.startswith("["))).withColumn("__ref", F.when(name.isNotNull(), full))
    found = attach(plain, names, [("__ref", "__full")], ["__id"])
    quoted = F.regexp_extract(value, r"(?s)^\s*'(.*)'\s*$", 1)
    literal = (
        F.when(value == "None", F.lit(None))
        .when(value == "False", F.when(F.col("field").isin(list(booleans)), F.lit("false")))
        .when(value == "True", F.lit("true"))
        .when(value.rlike(r"(?s)^\s*'.*'\s*$"), F.replace(quoted, F.lit("\\n"), F.lit("\n")))
        .otherwise(value)
    )
    resolved = F.when(F.col("__ref").isNotNull(), F.col("__id")).when(evaluated, literal).otherwise(value)
    values = found.withColumn("value", resolved).select(*[c for c in patch.columns if c != "kind"])
    return values.unionByName(texts).unionByName(loaded)


# The heads of member commands, by number or by name.
_HEAD = r"\(\s*([0-9])\s*[,)]|Command\.([a-z]+)\("
_COMMANDS = {"3": "remove", "unlink": "remove", "4": "add", "link": "add", "5": "replace", "clear": "replace", "6": "replace", "set": "replace"}


def member_commands(patch: DataFrame) -> DataFrame:
    """Relation values of a patch: (.., command, member), one row per named member.

    A command adds, removes or replaces; in a list that replaces, what is added
    belongs to the replacement. A replacement without members gives one row whose
    member is NULL. Any other command stops the run.
    """
    rows = patch.where((F.col("kind") == "eval") & F.col("value").startswith("["))
    by_number, by_name = (F.regexp_extract_all("value", F.lit(_HEAD), F.lit(k)) for k in (1, 2))
    heads = F.zip_with(by_number, by_name, lambda a, b: F.concat(a, b))
    commands = F.create_map(*[F.lit(w) for pair in _COMMANDS.items() for w in pair])
    named = F.transform(heads, lambda h: F.coalesce(
        F.try_element_at(commands, h), F.raise_error(F.concat(F.lit("unknown member command "), h)).cast("string")))
    bodies = F.slice(F.split("value", _HEAD, -1), 2, 2**31 - 2)
    parts = F.zip_with(named, bodies, lambda c, body: F.struct(
        c.alias("command"), F.regexp_extract_all(body, F.lit(r"ref\(\s*['\"]([^'\"]+)['\"]"), F.lit(1)).alias("names")))
    listed = rows.withColumn("__parts", parts).withColumn("__replaces", F.exists("__parts", lambda p: p["command"] == "replace"))
    members = F.flatten(F.transform("__parts", lambda p: F.transform(p["names"], lambda n: F.struct(
        F.when(F.col("__replaces") & (p["command"] == "add"), "replace").otherwise(p["command"]).alias("command"), n.alias("name")))))
    none = F.array(F.struct(F.lit("replace").alias("command"), F.lit(None).cast("string").alias("name")))
    empty = F.col("__replaces") & ~F.exists("__members", lambda m: m["command"] == "replace")
    listed = listed.withColumn("__members", members).withColumn("__members", F.when(empty, F.concat("__members", none)).otherwise(F.col("__members")))
    out = listed.select(*[c for c in patch.columns if c not in ("value", "kind", "forcecreate")], F.explode("__members").alias("__m"))
    name = F.col("__m.name")
    full = F.when(name.contains("."), name).otherwise(F.when(name.isNotNull(), F.concat_ws(".", "module", name)))
    return out.withColumns({"command": F.col("__m.command"), "member": full}).drop("__m")


def upsert_records(
    target: DataFrame, patch: DataFrame, key: str, create: str = "auto", protected: Column | None = None,
    position: str | None = None,
) -> DataFrame:
    """Apply patch rows (key, field, value as text, optional forcecreate) by record key.

    Only the listed fields change, also when the new value is NULL. A record
    that is missing is inserted: always, never, or (auto) unless its
    forcecreate is false. Existing rows for which ``protected`` holds stay. A
    field may be listed twice for a record if a ``position`` column tells which
    comes last; without one that stops the run. A patch row without a key names
    no record and is left out.

    The target is joined from its side only, so it is not shuffled for a patch
    that is small enough to be sent to it; new records are the patch's keys
    without those that the target has.
    """
    if create not in ("auto", "always", "never"):
        raise ValueError("create is auto, always or never")
    fields = [f for f in target.schema.fields if f.name != key]

    def chosen(name: str) -> Column:
        listed = F.col("field") == name
        if position is None:
            twice = F.raise_error(F.lit(f"{name} is listed twice for a record: say which comes last by position")).cast("string")
            return F.when(F.count_if(listed) > 1, twice).otherwise(F.max(F.when(listed, F.col("value"))))
        return F.max_by(F.struct("value"), F.when(listed, F.col(position)))["value"]

    force = F.bool_and(F.coalesce("forcecreate", F.lit(True))) if "forcecreate" in patch.columns else F.bool_and(F.lit(True))
    wide = patch.where(F.col(key).isNotNull()).groupBy(F.col(key).cast(target.schema[key].dataType).alias("__key")).agg(
        force.alias("__force"),
        *[F.bool_or(F.col("field") == f.name).alias(f"__has_{f.name}") for f in fields],
        *[chosen(f.name).alias(f"__new_{f.name}") for f in fields],
    )
    known = target.withColumn("__fixed", F.coalesce(protected, F.lit(False)) if protected is not None else F.lit(False))
    changed = known.join(wide, F.col(key) == F.col("__key"), "left").select(
        *[
            F.col(key) if f.name == key
            else F.when(F.col(f"__has_{f.name}") & ~F.col("__fixed"), F.col(f"__new_{f.name}").cast(f.dataType))
            .otherwise(F.col(f.name)).alias(f.name)
            for f in target.schema.fields
        ]
    )
    if create == "never":
        return changed
    there = target.select(F.col(key).alias("__there")).join(wide.select("__key"), F.col("__there") == F.col("__key"))
    new = wide if create == "always" else wide.where("__force")
    new = new.join(there.select("__there").distinct(), F.col("__key") == F.col("__there"), "leftanti").select(
        *[(F.col("__key") if f.name == key else F.col(f"__new_{f.name}").cast(f.dataType)).alias(f.name) for f in target.schema.fields]
    )
    return changed.unionByName(new)


def apply_member_commands(pairs: DataFrame, patch: DataFrame, left: str, right: str) -> DataFrame:
    """Relation values of a patch (left, command, right): add or remove a member, or replace the list.

    A replace with NULL as its member empties the list.
    """
    replaced = patch.where("command = 'replace'").select(left)
    removed = patch.where("command = 'remove'").select(left, right)
    kept = drop_related(drop_related(pairs, replaced, [left]), removed, [left, right])
    members = patch.where(F.col("command").isin("add", "replace") & F.col(right).isNotNull()).select(left, right)
    return kept.select(left, right).unionByName(members).distinct()
