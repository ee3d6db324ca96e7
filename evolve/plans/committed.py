"""Running a plan phase by phase, so that a run that fails goes on where it stopped.

After each phase the tables that it changed are written, and a manifest says which write
holds every table. A phase is known by a digest of the input's name, its steps and all
phases before it; where the manifest of that digest is whole, the phase is read and not
run. A changed step, or another input, has other digests from there on.

    <folder>/<n>_<phase>_<digest>/<table>/*.parquet
    <folder>/<n>_<phase>_<digest>/manifest/*.txt, _SUCCESS
"""

from __future__ import annotations

import hashlib
import json
import types
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from evolve.dataset import Dataset
from evolve.plans.plan import PHASES, Plan, Step
from evolve.storage import list_folder

# Tables of a phase that are written at a time; they have no part in each other.
WRITERS = 4


@dataclass(frozen=True)
class Phase:
    """What a run did with a phase: its folder, whether it was read back, and the tables it wrote."""

    name: str
    folder: str
    resumed: bool
    written: tuple[str, ...]


def _told(value: object) -> object:
    """What a step's code or closure says, without anything that changes from run to run."""
    if isinstance(value, types.CodeType):
        return [value.co_code.hex(), [_told(c) for c in value.co_consts], list(value.co_names)]
    if isinstance(value, (str, int, float, bool, type(None))):
        return value
    if isinstance(value, (list, tuple)):
        return [_told(v) for v in value]
    if isinstance(value, (set, frozenset)):
        return sorted(repr(_told(v)) for v in value)
    if isinstance(value, Mapping):
        return [[_told(k), _told(v)] for k, v in value.items()]
    if isinstance(value, types.FunctionType):
        cells = [_told(c.cell_contents) for c in value.__closure__ or ()]
        return [value.__qualname__, _told(value.__code__), _told(value.__defaults__), cells]
    return type(value).__qualname__


def step_digest(step: Step) -> str:
    """Names the step by its place, what it declares and its code."""
    text = json.dumps([step.module, step.phase, step.version, list(step.reads), list(step.writes), _told(step.fn)])
    return hashlib.sha256(text.encode()).hexdigest()


def _read(spark: SparkSession, held: Mapping[str, list[str]]) -> Dataset:
    return Dataset({t: spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(path) for t, (path, schema) in held.items()})


def run_committed(ds: Dataset, plan: Plan, folder: str, source: str) -> tuple[Dataset, list[Phase]]:
    """Run a plan, committing every phase under ``folder``; the dataset, and what was done.

    ``source`` names the input and its version: the folder keeps what was made of it, and another name starts
    anew. Tables that no phase writes stay as they were given. What a step changes without declaring it is
    found by its frame and written too.
    """
    missing = plan.missing_reads(ds)
    if missing:
        raise ValueError(f"steps read tables nobody provides: {missing}")
    session = next(iter(ds.values())).sparkSession
    state, done, held = hashlib.sha256(source.encode()).hexdigest(), [], {}
    # Before any step runs: what steps share may change on the way.
    digests = {id(s): step_digest(s) for s in plan.steps}
    for number, name in enumerate(PHASES):
        steps = [s for s in plan.ordered() if s.phase == name]
        if not steps:
            continue
        state = hashlib.sha256("".join([state, *(digests[id(s)] for s in steps)]).encode()).hexdigest()
        at = f"{folder.rstrip('/')}/{number}_{name}_{state[:16]}"
        if "_SUCCESS" in list_folder(session, f"{at}/manifest"):
            manifest = json.loads(session.read.text(f"{at}/manifest", wholetext=True).first()[0])
            # Tables that are gone, those that some phase wrote, and the given ones.
            kept = {t: df for t, df in ds.items() if t in manifest["tables"] and t not in manifest["held"]}
            held = manifest["held"]
            ds = Dataset({**kept, **_read(session, held)})
            done.append(Phase(name, at, True, tuple(manifest["written"])))
            continue
        before = ds
        for s in steps:
            ds = s.fn(ds)
        changed = [t for t in ds if t not in before or ds[t] is not before[t]]
        with ThreadPoolExecutor(WRITERS) as pool:
            list(pool.map(lambda t: ds[t].write.mode("overwrite").parquet(f"{at}/{t}"), changed))
        held = {t: v for t, v in held.items() if t in ds} | {t: [f"{at}/{t}", ds[t].schema.json()] for t in changed}
        text = json.dumps({"held": held, "tables": list(ds), "written": changed})
        session.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{at}/manifest")
        ds = Dataset({**{t: df for t, df in ds.items() if t not in held}, **_read(session, held)})
        done.append(Phase(name, at, False, tuple(changed)))
    return ds, done
