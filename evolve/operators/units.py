"""Units of measure: reference trees, conversion, and reuse of existing units."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from evolve.operators.joins import attach, drop_related, keep_related
from evolve.operators.ordered import Running, first_per_key, running
from evolve.operators.reshape import next_ids
from evolve.storage import checkpointed, stored


def flatten_units(units: DataFrame) -> DataFrame:
    """Point every unit at its category's reference unit, with the ratio to it.

    ``units`` is (id, category_id, factor, uom_type, owned, ..). Reference units
    and units owned by a module get no pointer here. A category with several
    references uses the least id. Adds relative_id and relative_factor.
    """
    reference = (
        units.where((F.col("uom_type") == "reference") & F.col("category_id").isNotNull())
        .groupBy("category_id").agg(F.min("id").alias("__ref"))
    )
    out = attach(units, reference, ["category_id"], ["__ref"], reduced=True)
    custom = (F.col("uom_type") != "reference") & ~F.coalesce(F.col("owned"), F.lit(False)) & F.col("__ref").isNotNull()
    ratio = F.when(F.col("uom_type") == "bigger", F.col("factor")).otherwise(F.try_divide(F.lit(1.0), F.col("factor")))
    return out.withColumns(
        {"relative_id": F.when(custom, F.col("__ref")), "relative_factor": F.when(custom, ratio)}
    ).drop("__ref")


# Trees of up to this many units are walked by one task, a few MB; larger ones by rounds of joins.
SMALL_TREES = 100_000


def unit_roots(units: DataFrame, id_col: str, parent_col: str, factor_col: str | None = None) -> DataFrame:
    """Root of every unit's tree, and the factor from the unit to that root.

    A pointer to a unit that is not there ends the chain like no pointer, as does one to the unit itself. A cycle
    never ends and is an error. Returns (id, root, factor).
    """
    factor = F.col(factor_col).cast("double") if factor_col else F.lit(1.0)
    edges = stored(units.select(F.col(id_col).alias("id"), F.col(parent_col).alias("up"), factor.alias("f")))
    if edges.limit(SMALL_TREES + 1).count() <= SMALL_TREES:
        return _walked_at_once(edges)
    linked = keep_related(edges.where("up <> id"), edges.select(F.col("id").alias("__id")), [("up", "__id")])
    roots = drop_related(edges, linked, ["id"]).select("id", F.col("id").alias("root"), F.lit(1.0).alias("factor"))
    return stored(roots.unionByName(_doubled(linked)))


def _walked_at_once(edges: DataFrame) -> DataFrame:
    """Every chain of a bounded frame followed in one task, each unit once."""
    def walk(batches):
        up: dict = {}
        for batch in batches:
            up.update(zip(batch.column("id").to_pylist(), zip(batch.column("up").to_pylist(), batch.column("f").to_pylist(), strict=True), strict=True))
        done: dict = {}
        for unit in up:
            chain = []
            while unit not in done:
                chain.append(unit)
                to, _ = up[unit]
                if to is None or to == unit or to not in up:
                    done[unit] = (unit, 1.0)
                elif len(chain) > len(up):
                    # A cycle: no unit of it, nor any that leads to it, has a root.
                    done.update((u, (None, None)) for u in chain)
                unit = to
                if unit is None or unit not in up:
                    break
            for unit in reversed(chain):
                if unit not in done:
                    to, f = up[unit]
                    root, rest = done[to]
                    done[unit] = (root, None if f is None or rest is None else rest * f)
        if done:
            ids, ends = list(done), list(done.values())
            kind = schema["id"]
            yield pa.record_batch([pa.array(ids, kind), pa.array([e[0] for e in ends], kind), pa.array([e[1] for e in ends], pa.float64())], names=["id", "root", "factor"])

    schema = {"id": to_arrow_type(edges.schema["id"].dataType)}
    kind = edges.schema["id"].dataType.simpleString()
    same = edges.select("id", F.col("up").cast(kind).alias("up"), "f").where("id is not null")
    walked = stored(same.coalesce(1).mapInArrow(walk, f"id {kind}, root {kind}, factor double"))
    if not walked.where("root is null").isEmpty():
        raise ValueError("the units form a cycle")
    return walked


def _doubled(linked: DataFrame) -> DataFrame:
    """Pointer doubling: each round a unit jumps to where its target points, so a chain of depth d takes log2(d) rounds.

    A unit is done once it points to a root, or jumped to where a unit that is done points; it then leaves the join.
    """
    moving = checkpointed(linked.withColumn("done", F.lit(False)))
    rounds = max(1, math.ceil(math.log2(max(2, moving.count()))) + 1)
    for _ in range(rounds):
        there = moving.select(
            F.col("id").alias("__id"), F.col("up").alias("__up"), F.col("f").alias("__f"), F.col("done").alias("__done")
        )
        active = moving.where("NOT done")
        stepped = (
            active.join(there, F.col("up") == F.col("__id"), "left")
            .select(
                "id", F.coalesce("__up", "up").alias("up"),
                (F.col("f") * F.when(F.col("__id").isNull(), F.lit(1.0)).otherwise(F.col("__f"))).alias("f"),
                F.coalesce("__done", F.lit(True)).alias("done"),
            )
        )
        moving = checkpointed(moving.where("done").unionByName(stepped))
        if moving.where("NOT done").isEmpty():
            break
    else:
        raise ValueError("the units form a cycle")
    return moving.select("id", F.col("up").alias("root"), F.col("f").alias("factor"))


def unit_family(units: DataFrame, id_col: str, parent_col: str, dst: str = "family") -> DataFrame:
    """Give every unit the id of the family it is linked to by parents and children."""
    return attach(units, unit_roots(units, id_col, parent_col), [(id_col, "id")], {dst: "root"})


def convert_quantity(
    df: DataFrame, qty: str, from_unit: str, to_unit: str, roots: DataFrame, dst: str
) -> DataFrame:
    """Convert between units of one tree through its root; NULL across trees."""
    out = attach(df, roots, [(from_unit, "id")], {"__r1": "root", "__f1": "factor"})
    out = attach(out, roots, [(to_unit, "id")], {"__r2": "root", "__f2": "factor"})
    value = F.try_divide(F.col(qty) * F.col("__f1"), F.col("__f2"))
    return out.withColumn(dst, F.when(F.col("__r1") == F.col("__r2"), value)).drop("__r1", "__f1", "__r2", "__f2")


# Sizes are the same if they differ by no more than this share of the larger one.
TOLERANCE = 1e-9


def _cell(c: Column) -> Column:
    """Sign and logarithmic cell of a size, wider than the tolerance: same sizes lie in one cell or in neighbours."""
    return F.struct(F.signum(c).cast("int").alias("sign"), F.when(c == 0, 0).otherwise(F.floor(F.ln(F.abs(c)) / (4 * TOLERANCE))).cast("long").alias("cell"))


def _same(a: Column, b: Column) -> Column:
    return F.abs(a - b) <= TOLERANCE * F.greatest(F.abs(a), F.abs(b))


def nearest_sizes(wanted: DataFrame, known: DataFrame) -> DataFrame:
    """group, size, id: for sizes of ``wanted`` (group, size) the nearest one of ``known`` (group, size, id), if it is the same.

    Of equally near ones the least id counts. Each size looks into its own cell and both neighbours.
    """
    there = known.select(F.col("group").alias("__group"), F.col("size").alias("__size"), "id", _cell(F.col("size")).alias("__at"))
    here = wanted.select("group", "size").distinct().withColumn("at", _cell(F.col("size")))
    look = here.withColumn("step", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))).where("size <> 0 or step = 0")
    look = look.withColumn("cell", F.col("at.cell") + F.col("step"))
    on = (F.col("group") == F.col("__group")) & (F.col("at.sign") == F.col("__at.sign")) & (F.col("cell") == F.col("__at.cell"))
    near = look.join(there, on).where(_same(F.col("size"), F.col("__size")))
    return near.groupBy("group", "size").agg(F.min_by("id", F.struct(F.abs(F.col("size") - F.col("__size")), "id")).alias("id"))


def size_runs(sizes: DataFrame, spread: bool = False) -> DataFrame:
    """group, size, run: sizes of a group in ascending order, a new run wherever one is not the same as the one before."""
    distinct = sizes.select("group", "size").distinct()
    lagged = running(distinct, ["group"], ["size"], {"before": Running("lag", "size")}, unique=True, spread=spread)
    marked = lagged.withColumn("starts", F.when(F.col("before").isNotNull() & _same(F.col("size"), F.col("before")), 0).otherwise(1))
    return running(marked, ["group"], ["size"], {"run": Running("sum", "starts")}, unique=True, spread=spread).select("group", "size", "run")


def match_or_create_unit(
    packs: DataFrame, products: DataFrame, units: DataFrame, roots: DataFrame, spread: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Give every pack a unit of its product's family that is as big as the pack.

    ``packs`` is (id, name, product_id, qty), ``products`` (id, unit_id),
    ``units`` (id, name, relative_id, relative_factor). A pack takes the unit nearest
    to its size, within ``TOLERANCE`` of it, so rounding noise is ignored at any magnitude.
    Packs that fit no unit create one; packs of the same family and size share it, named after the
    first of them. A pack without a quantity or a known product gets no unit. ``spread`` says that a
    family may have more sizes than one task sorts. Returns (packs with unit_id, units with the new ones).
    """
    sized = attach(packs, products, [("product_id", "id")], {"__unit": "unit_id"})
    sized = attach(sized, roots, [("__unit", "id")], {"group": "root", "__f": "factor"})
    sized = stored(sized.withColumn("size", F.col("qty").cast("double") * F.col("__f")))
    known = sized.where(F.col("group").isNotNull() & F.col("size").isNotNull())
    existing = stored(nearest_sizes(known, roots.where("factor is not null").select(F.col("root").alias("group"), F.col("factor").alias("size"), "id")))
    needed = drop_related(known, existing, ["group", "size"])
    runs = stored(size_runs(needed, spread))
    first = first_per_key(attach(needed, runs, ["group", "size"], ["run"]), ["group", "run"], [F.col("id").asc()])
    created = next_ids(
        first.select(
            F.col("name"), F.col("__unit").alias("relative_id"), F.col("qty").alias("relative_factor"),
            "group", "run", F.col("id").alias("__pack"),
        ),
        "id", ["__pack"], units, "id", ["__pack"],
    )
    named = attach(runs, created, ["group", "run"], {"id": "id"}).select("group", "size", "id")
    matched = attach(sized, existing.unionByName(named.select(*existing.columns)), ["group", "size"], {"unit_id": "id"}, reduced=True)
    return matched.select(*packs.columns, "unit_id"), units.unionByName(created.select(*units.columns))
