"""A migration: ordered steps in the phases pre, post and end."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evolve.dataset import Dataset
from evolve.storage import checkpointed

# The phases in their order.
PHASES = ("pre", "post", "end")


@dataclass(frozen=True)
class Step:
    """One function over a dataset, with the tables it reads and writes."""

    module: str
    phase: str
    fn: Callable[[Dataset], Dataset]
    reads: Sequence[str] = ()
    writes: Sequence[str] = ()
    version: str = ""

    def __post_init__(self):
        if self.phase not in PHASES:
            raise ValueError(f"phase is one of {', '.join(PHASES)}")


@dataclass
class Plan:
    steps: list[Step] = field(default_factory=list)

    def step(self, module: str, phase: str, reads=(), writes=(), version: str = ""):
        """Decorator that registers a function as a step."""
        def register(fn):
            self.steps.append(Step(module, phase, fn, reads, writes, version))
            return fn

        return register

    def ordered(self) -> list[Step]:
        """Steps by phase; within a phase in the order given."""
        return sorted(self.steps, key=lambda s: PHASES.index(s.phase))

    def excluding(self, versions: Iterable[tuple[str, str]]) -> "Plan":
        """The plan without the listed (module, version) steps."""
        gone = set(versions)
        return Plan([s for s in self.steps if (s.module, s.version) not in gone])

    def missing_reads(self, ds: Dataset) -> list[tuple[str, str, str]]:
        """(module, phase, table) of reads that no table or earlier step provides."""
        known, missing = set(ds), []
        for s in self.ordered():
            missing += [(s.module, s.phase, t) for t in s.reads if t not in known]
            known |= set(s.writes)
        return missing


def run(ds: Dataset, plan: Plan, cut_between_phases: bool = False) -> Dataset:
    """Fold the steps over a dataset; lazy, one logical plan per output table.

    ``cut_between_phases`` checkpoints the tables a phase wrote, for plans that
    grow long or tables that are read many times afterwards.
    """
    missing = plan.missing_reads(ds)
    if missing:
        raise ValueError(f"steps read tables nobody provides: {missing}")
    steps = plan.ordered()
    for phase in PHASES:
        written: list[str] = []
        for s in steps:
            if s.phase == phase:
                ds = s.fn(ds)
                written += s.writes
        if cut_between_phases and phase != PHASES[-1]:
            for table in dict.fromkeys(written):
                if ds.has_table(table):
                    ds = ds.put(table, checkpointed(ds[table]))
    return ds


def guarded(condition: bool, step: Callable[[DataFrame], DataFrame], df: DataFrame) -> DataFrame:
    """Apply a step when a fact of the schema (table or column present) holds."""
    return step(df) if condition else df


def guard_exists(
    df: DataFrame, predicate: Column, values: dict[str, Column], among: DataFrame | None = None, negate: bool = False
) -> DataFrame:
    """Set columns only if some row (with ``negate``: no row) of ``among`` meets a predicate.

    The fact is a scalar subquery, evaluated once inside the plan.
    """
    found = (df if among is None else among).agg(F.coalesce(F.bool_or(predicate), F.lit(False)).alias("found")).scalar()
    due = ~found if negate else found
    return df.withColumns(
        {c: F.when(due, v).otherwise(F.col(c) if c in df.columns else F.lit(None)) for c, v in values.items()}
    )


def guard_changed(matches: DataFrame, df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """A follow-up update that runs only if the first one touched a row.

    ``matches`` holds the rows the first update changed.
    """
    touched = matches.agg((F.count(F.lit(1)) > 0).alias("touched")).scalar()
    return df.withColumns(
        {c: F.when(touched, v).otherwise(F.col(c) if c in df.columns else F.lit(None)) for c, v in values.items()}
    )
