"""Differences between two schema catalogs, both held as frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evolve.operators.joins import attach, drop_related
from evolve.operators.schema import rename_values


def diff_models(old: DataFrame, new: DataFrame, renames: DataFrame | None = None) -> DataFrame:
    """New, obsolete, renamed and moved models.

    Catalogs are (module, model, kind), unique on model; kind is NULL, transient
    or abstract. ``renames`` is (old, new). Returns (model, change, detail, kind).
    """
    before = old.withColumn("__was", F.col("model"))
    if renames is not None:
        before = rename_values(before, ["model"], renames)
    o, n = before.alias("o"), new.alias("n")
    both = o.join(n, F.col("o.model") == F.col("n.model"), "full")
    change = (
        F.when(F.col("o.model").isNull(), "new")
        .when(F.col("n.model").isNull(), "obsolete")
        .when(F.col("o.__was") != F.col("n.model"), "renamed")
        .when(F.col("o.module") != F.col("n.module"), "moved")
    )
    detail = F.when(change == "renamed", F.col("o.__was")).when(change == "moved", F.col("o.module"))
    return both.select(
        F.coalesce("n.model", "o.__was").alias("model"), change.alias("change"), detail.alias("detail"),
        F.coalesce("n.kind", "o.kind").alias("kind"),
    ).where("change IS NOT NULL")


def diff_fields(old: DataFrame, new: DataFrame) -> DataFrame:
    """New and deleted fields of two catalogs unique on (module, model, field).

    The other columns describe the field and come from the side that has it.
    """
    key = ["module", "model", "field"]
    facts = [c for c in new.columns if c not in key]
    o, n = old.withColumn("__o", F.lit(True)).alias("o"), new.withColumn("__n", F.lit(True)).alias("n")
    on = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in key]
    both = o.join(n, on, "full")
    return both.where("__o IS NULL OR __n IS NULL").select(
        *[F.coalesce(f"n.{k}", f"o.{k}").alias(k) for k in key],
        F.when(F.col("__n").isNull(), "DEL").otherwise("NEW").alias("change"),
        *[F.when(F.col("__n").isNull(), F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c) for c in facts],
    )


def diff_attributes(old: DataFrame, new: DataFrame, key: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """Changed attributes of the keys both sides have: (key.., attribute, old, new)."""
    o, n = old.alias("o"), new.alias("n")
    both = o.join(n, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in key])
    changes = F.array(
        *[
            F.struct(
                F.lit(a).alias("attribute"),
                F.col(f"o.{a}").cast("string").alias("old"), F.col(f"n.{a}").cast("string").alias("new"),
            )
            for a in attributes
        ]
    )
    differing = F.filter(changes, lambda c: ~c["old"].eqNullSafe(c["new"]))
    return both.select(*[F.col(f"o.{k}") for k in key], F.inline(differing))


def diff_selection_keys(old: DataFrame, new: DataFrame, key: Sequence[str], keys_col: str) -> DataFrame:
    """Selection keys added and removed, as sorted lists, where any were."""
    o, n = old.alias("o"), new.alias("n")
    both = o.join(n, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in key])
    def only(a, b):
        return F.array_join(F.array_sort(F.array_except(F.col(f"{a}.{keys_col}"), F.col(f"{b}.{keys_col}"))), ", ")

    return both.select(
        *[F.col(f"o.{k}") for k in key], only("n", "o").alias("added"), only("o", "n").alias("removed")
    ).where("added <> '' OR removed <> ''")


def diff_records(old: DataFrame, new: DataFrame, modules: DataFrame | None = None) -> DataFrame:
    """New, deleted and changed reference records.

    Catalogs are (module, name, model, definition, noupdate), unique on (module,
    name); ``modules`` is (old, new), applied to the old side first.
    Returns (model, module, name, change, was_module, noupdate).
    """
    before = old.withColumn("__was", F.col("module"))
    if modules is not None:
        before = rename_values(before, ["module"], modules)
    o, n = before.withColumn("__o", F.lit(True)).alias("o"), new.withColumn("__n", F.lit(True)).alias("n")
    both = o.join(n, F.col("o.module").eqNullSafe(F.col("n.module")) & F.col("o.name").eqNullSafe(F.col("n.name")), "full")
    change = (
        F.when(F.col("__o").isNull(), "NEW")
        .when(F.col("__n").isNull(), "DEL")
        .when(F.col("o.__was") != F.col("n.module"), "renamed")
        .when(~F.col("o.definition").eqNullSafe(F.col("n.definition")), "changed definition")
        .when(~F.col("o.noupdate").eqNullSafe(F.col("n.noupdate")), "noupdate switched")
    )
    return both.select(
        F.coalesce("n.model", "o.model").alias("model"), F.coalesce("n.module", "o.__was").alias("module"),
        F.coalesce("n.name", "o.name").alias("name"), change.alias("change"),
        F.when(change == "renamed", F.col("o.__was")).alias("was_module"),
        F.coalesce("n.noupdate", "o.noupdate").alias("noupdate"),
    ).where("change IS NOT NULL")


def classify_noise(diff: DataFrame, rules: DataFrame) -> DataFrame:
    """Flag differences that need no work; ``rules`` is (change, attribute), NULL attribute for any."""
    exact = rules.where("attribute IS NOT NULL").select("change", "attribute", F.lit(True).alias("__hit")).distinct()
    broad = rules.where("attribute IS NULL").select("change", F.lit(True).alias("__hit")).distinct()
    out = attach(diff, exact, ["change", "attribute"], {"__exact": "__hit"}, reduced=True)
    out = attach(out, broad, ["change"], {"__broad": "__hit"}, reduced=True)
    noise = F.coalesce("__exact", "__broad", F.lit(False))
    return out.withColumn("noise", noise).drop("__exact", "__broad")


def work_coverage(diff: DataFrame, answered: DataFrame, module: str, key: Sequence[str]) -> DataFrame:
    """Lines, answered lines and their share per module."""
    marks = answered.select(*key).distinct().withColumn("__hit", F.lit(1))
    joined = attach(diff, marks, list(key), ["__hit"], reduced=True)
    counted = joined.groupBy(module).agg(F.count(F.lit(1)).alias("lines"), F.count("__hit").alias("answered"))
    return counted.withColumn("share", F.round(F.col("answered") / F.col("lines"), 4))


def unclaimed_modules(modules: DataFrame, claims: Sequence[tuple[DataFrame, str]], module: str) -> DataFrame:
    """Modules that occur in none of the lists."""
    out = modules
    for frame, column in claims:
        out = drop_related(out, frame, [(module, column)])
    return out
