"""Hard negatives by shared candidate lists of anchor clusters, exact.

For an anchor the other rows of its label that are most like it are its positives, and
the rows of other labels that are nearly as like it as a positive are that positive's
hard negatives. Likeness is the inner product of vectors in whole numbers,
``floor(SCALE * x)`` per component.

Clusters. Anchors are put to the nearest of a few directions, found by spherical k-means
on a sample of ``SAMPLE`` anchors. If a candidate stands at an angle t from a cluster's
direction and no anchor of the cluster at more than b, then no anchor u of the cluster has
an inner product with the candidate above |u| |x| cos(max(0, t - b)). So one order of the
candidates, by |x| cos(max(0, t - b)), serves all members of the cluster: every member
walks the list from its top, and stops where the bound falls below the last score that it
still needs. What lies behind is certified not to matter, so nothing is missed. The
directions decide only how soon a walk ends.

Distribution. Lists are cut into blocks by a hash of the id and clusters into groups; a
group of anchors walks each block in a task of its own, and the best of all blocks are
merged. Walks start from the scores found among ``SEEDS`` rows that every task has: the
last of these is a lower bound of the last one needed. Candidates below all bounds of a
cluster are not sent to it. The same walk serves both passes, positives first; in the
second the positives' scores are upper ends.

Defined results: rows without id or label, and vectors that are null, empty or hold null
or non-finite components, take no part, nor do those whose components leave the range of
doubles when scaled; all-zero vectors take part; vectors of different dimension do not
meet; ties go to the smaller id; equal rows count once, different rows of one id are
candidates of their own, and of an anchor's rows that with the smallest hash asks; scores
beyond 64 bits count as the ends of that range; an anchor without positives, and a
positive without negatives in its range, has no rows; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evolve.llm.blocks import grouped, runs
from evolve.storage import stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
# A negative scores between these hundredths of its positive.
LOW, HIGH = 80, 100
SAMPLE = 2048
PER_CLUSTER = 128
SEEDS = 4096
SEED_BYTES = 8 << 20
GROUP = 2048
BLOCK = 4096
STEP = 512

_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
# Angles and bounds are doubles; they are widened by more than their rounding.
_ANGLE = 1e-6


def products(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers, exactly, cut off at 64 bits."""
    if not (len(a) and len(x)):
        return np.zeros((len(a), len(x)), dtype=np.int64)
    if np.abs(a).max() * np.abs(x).max() * a.shape[1] < 1 << 53:
        return (a @ x.T).astype(np.int64)
    whole = [np.array([[int(v) for v in row] for row in m.tolist()], dtype=object) for m in (a, x)]
    return np.clip(whole[0] @ whole[1].T, _LEAST, _MOST).astype(np.int64)


def _vectors(column: pa.Array) -> np.ndarray:
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), dtype="<f8").reshape(len(raw), -1)


def _angles(x: np.ndarray, norm: np.ndarray, towards: np.ndarray) -> np.ndarray:
    """Angle of each row with each direction; all-zero rows have none, and 0 is as good as any."""
    cosine = x / np.maximum(norm, 1e-300)[:, None] @ towards.T
    return np.where(norm[:, None] > 0, np.arccos(np.clip(cosine, -1, 1)), 0.0)


def directions(x: np.ndarray, many: int) -> np.ndarray:
    """Unit directions of ``many`` clusters by spherical k-means, started from the first rows."""
    unit = x / np.sqrt((x * x).sum(axis=1))[:, None]
    centre = unit[:many].copy()
    for _ in range(12):
        near = (unit @ centre.T).argmax(axis=1)
        for c in range(len(centre)):
            total = unit[near == c].sum(axis=0)
            size = np.sqrt(total @ total)
            if size > 1e-9:
                centre[c] = total / size
    return centre


class _Best:
    """The best scores of each (anchor, slot) so far: highest first, ties to the smaller id."""

    def __init__(self, floors: np.ndarray, caps: np.ndarray, many: int):
        self.floors, self.caps, self.many = floors, caps, many
        self.owner = self.ids = self.scores = np.zeros(0, dtype=np.int64)
        self.least = floors.copy()

    def add(self, rows: np.ndarray, score: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        """``score``: anchors ``rows`` x candidates ``ids``; only where ``allowed``."""
        slots = self.caps.shape[1]
        hits = [(self.owner, self.ids, self.scores)]
        for k in range(slots):
            i, j = np.nonzero(allowed & (score <= self.caps[rows, k, None]) & (score >= self.least[rows, k, None]))
            if len(i):
                hits.append((rows[i] * slots + k, ids[j], score[i, j]))
        if len(hits) == 1:
            return
        owner, found, value = (np.concatenate(c) for c in zip(*hits, strict=True))
        order = np.lexsort((found, ~value, owner))
        owner, found, value = owner[order], found[order], value[order]
        first = np.searchsorted(owner, owner)
        kept = np.arange(len(owner)) - first < self.many
        last = np.arange(len(owner)) - first == self.many - 1
        at = owner[last]
        self.least[at // slots, at % slots] = np.maximum(value[last], self.floors[at // slots, at % slots])
        self.owner, self.ids, self.scores = owner[kept], found[kept], value[kept]


def _prepared(rows: DataFrame, is_anchor: Column, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """id, label, asks, dim, norm, vec: the rows that take part, components scaled and floored, stored."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = rows.where(F.col(key).isNotNull() & F.col(label).isNotNull() & (F.size(vector) > 0) & fine)
    kept = kept.select(F.col(key).cast("long").alias("id"), F.col(label).alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("asks"), F.col(vector).cast("array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v")
            ends = v.offsets.to_numpy()
            with np.errstate(over="ignore"):
                flat = np.floor(v.values.to_numpy(zero_copy_only=False) * scale)
                norms = [np.sqrt(p @ p) for p in (flat[a:b] for a, b in zip(ends, ends[1:], strict=False))]
            sound = np.isfinite(norms) if norms else np.zeros(0, dtype=bool)
            raw = [flat[a:b].astype("<f8").tobytes() for a, b in zip(ends, ends[1:], strict=False)]
            out = [batch.column(c) for c in ("id", "label", "asks")]
            yield pa.record_batch([*out, pa.array(np.diff(ends).astype(np.int32)), pa.array(norms, pa.float64()), pa.array(raw, pa.binary())], names=["id", "label", "asks", "dim", "norm", "vec"]).filter(pa.array(sound))

    kind = kept.schema["label"].dataType.simpleString()
    return stored(kept.mapInArrow(run, f"id long, label {kind}, asks boolean, dim int, norm double, vec binary"))


def _floors(anchors: DataFrame, seeds: dict[int, tuple], same: bool, many: int) -> DataFrame:
    """``anchors`` with their floors raised to the last of the best scores among the seeds."""
    sent = anchors.sparkSession.sparkContext.broadcast(seeds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dim, floors = batch.column("dim").to_numpy(), batch.column("floors").to_pylist()
            ids, caps, labels = batch.column("id").to_numpy(), batch.column("caps").to_pylist(), batch.column("label").to_numpy(zero_copy_only=False)
            for d in np.unique(dim).tolist():
                if d not in sent.value:
                    continue
                own = np.flatnonzero(dim == d)
                other, other_labels, x = sent.value[d]
                for part in range(0, len(own), STEP):
                    rows = own[part:part + STEP]
                    best = _Best(np.array([floors[i] for i in rows], dtype=np.int64), np.array([caps[i] for i in rows], dtype=np.int64), many)
                    alike = labels[rows][:, None] == other_labels[None, :]
                    allowed = (alike == same) & (ids[rows][:, None] != other[None, :])
                    best.add(np.arange(len(rows)), products(_vectors(batch.column("vec").take(pa.array(rows))), x), other, allowed)
                    for i, least in zip(rows.tolist(), best.least.tolist(), strict=True):
                        floors[i] = least
            yield batch.set_column(batch.schema.get_field_index("floors"), "floors", pa.array(floors, pa.list_(pa.int64())))

    return anchors.mapInArrow(run, anchors.schema)


def _walk(anchors: DataFrame, kept: DataFrame, blocks: int, towards: dict[int, np.ndarray], same: bool, many: int) -> DataFrame:
    """anchor, slot, id, score: the ``many`` best candidates of each block for every slot of every anchor.

    A slot k takes scores from ``floors[k]`` to ``caps[k]``, of rows of the anchor's label or of others.
    """
    context = anchors.sparkSession.sparkContext
    # By cluster: its widest angle, its size, and the least bound that any of its anchors can use.
    need = F.when(F.col("norm") > 0, F.array_min("floors") / F.col("norm")).otherwise(F.when(F.array_min("floors") <= 0, F.lit(float("-inf"))).otherwise(F.lit(float("inf"))))
    shape = anchors.groupBy("dim", "cluster").agg(F.max("angle").alias("angle"), F.ceil(F.count("*") / GROUP).cast("int").alias("groups"), F.min(need).alias("need"))
    clusters: dict[int, list] = {}
    for r in shape.orderBy("dim", "cluster").collect():
        clusters.setdefault(r["dim"], []).append((r["cluster"], r["angle"], r["groups"], r["need"]))
    sent = context.broadcast((towards, clusters))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, shapes = sent.value
        for batch in batches:
            dim = batch.column("dim").to_numpy()
            for d in np.unique(dim).tolist():
                own = batch.take(pa.array(np.flatnonzero(dim == d)))
                if d not in shapes:
                    continue
                norm = own.column("norm").to_numpy()
                angle = _angles(_vectors(own.column("vec")), norm, known[d]) if d in known else np.zeros((len(norm), 1))
                for cluster, widest, groups, least in shapes[d]:
                    bound = norm * np.cos(np.clip(angle[:, cluster] - widest - _ANGLE, 0, np.pi)) if d in known else norm
                    some = np.flatnonzero(bound + 1e-9 * np.abs(bound) + 1e-6 >= least)
                    part = own.take(pa.array(some))
                    yield pa.record_batch(
                        [pa.array(np.full(len(some), cluster, dtype=np.int32)), pa.array(np.full(len(some), groups, dtype=np.int32)), pa.array(-bound[some]),
                         *(part.column(c) for c in ("dim", "id", "label", "norm", "vec"))],
                        names=["cluster", "groups", "down", "dim", "id", "label", "norm", "vec"],
                    )

    kind = kept.schema["label"].dataType.simpleString()
    none = F.lit(None).cast("array<bigint>")
    candidates = kept.mapInArrow(listed, f"cluster int, groups int, down double, dim int, id long, label {kind}, norm double, vec binary")
    candidates = candidates.withColumns({
        "group": F.explode(F.sequence(F.lit(0), F.col("groups") - 1)), "block": F.pmod(F.xxhash64("id", F.lit(3)), F.lit(blocks)).cast("int"),
        "kind": F.lit(1), "caps": none, "floors": none,
    }).drop("groups")
    groups = shape.select("dim", "cluster", "groups")
    asked = anchors.join(F.broadcast(groups), ["dim", "cluster"]).withColumns({
        "group": F.pmod(F.xxhash64("id", F.lit(5)), F.col("groups")).cast("int"), "block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))), "kind": F.lit(0), "down": F.lit(0.0),
    }).select(*candidates.columns)
    keys = ["dim", "cluster", "group", "block"]
    together = grouped(candidates.unionByName(asked), keys, ("kind", "down", "id"))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, starts in runs(batches, keys):
            asks = batch.column("kind").to_numpy() == 0
            ids, norm, down = (batch.column(c).to_numpy() for c in ("id", "norm", "down"))
            _, label = np.unique(batch.column("label").to_numpy(zero_copy_only=False), return_inverse=True)
            out: list[tuple] = []
            for a, b in zip(starts, starts[1:], strict=False):
                split = a + int(asks[a:b].sum())
                if split in (a, b):
                    continue
                u = _vectors(batch.column("vec").slice(a, split - a))
                floors, caps = (np.array(batch.column(c).slice(a, split - a).to_pylist(), dtype=np.int64) for c in ("floors", "caps"))
                best = _Best(floors, caps, many)
                at = split
                while at < b:
                    # The highest bound left, for each anchor; a tie could still have a smaller id.
                    upper = -down[at] * norm[a:split]
                    active = np.flatnonzero((best.least <= (upper + 1e-9 * np.abs(upper) + 1e-6)[:, None]).any(axis=1))
                    if not len(active):
                        break
                    upto = min(b, at + STEP)
                    x = _vectors(batch.column("vec").slice(at, upto - at))
                    # An equal row of one id stands next to it in the list.
                    again = (ids[at:upto] == ids[at - 1:upto - 1]) & (label[at:upto] == label[at - 1:upto - 1]) & (np.arange(at, upto) > split)
                    for k in np.flatnonzero(again).tolist():
                        again[k] = batch.column("vec")[at + k] == batch.column("vec")[at + k - 1]
                    allowed = ((label[a:split][active][:, None] == label[None, at:upto]) == same) & (ids[a:split][active][:, None] != ids[None, at:upto]) & ~again[None, :]
                    best.add(active, products(u[active], x), ids[at:upto], allowed)
                    at = upto
                if len(best.owner):
                    slots = caps.shape[1]
                    out.append((ids[a:split][best.owner // slots], best.owner % slots, best.ids, best.scores))
            if out:
                yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["anchor", "slot", "id", "score"])

    return together.mapInArrow(walk, "anchor long, slot long, id long, score long")


def mine(
    rows: DataFrame, is_anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label", positives: int = POSITIVES,
    negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE, block: int = BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    For every anchor and each of its ``positives`` best rows of the same label, the ``negatives`` best rows of
    other labels with low <= 100 negative_score / positive_score <= high.
    """
    kept = _prepared(rows, is_anchor, key, vector, label, scale)
    total = kept.count()
    blocks = max(1, -(-total // block))
    asked = kept.where("asks").groupBy("id").agg(F.min_by(F.struct("label", "dim", "norm", "vec"), F.xxhash64("label", "vec")).alias("one")).select("id", "one.*")
    # A bounded sample of anchors gives the clusters' directions, by dimension.
    chosen = asked.where("norm > 0").orderBy(F.xxhash64("id", F.lit(7)), "id").limit(SAMPLE).select("dim", "vec").toArrow()
    dim = chosen.column("dim").to_numpy()
    towards = {}
    for d in np.unique(dim).tolist():
        x = _vectors(chosen.column("vec").take(pa.array(np.flatnonzero(dim == d))))
        towards[d] = directions(x, max(1, len(x) // PER_CLUSTER))
    context = rows.sparkSession.sparkContext
    sent = context.broadcast(towards)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dim, norm = batch.column("dim").to_numpy(), batch.column("norm").to_numpy()
            cluster, angle = np.zeros(len(dim), dtype=np.int32), np.zeros(len(dim))
            for d in np.unique(dim).tolist():
                if d in sent.value:
                    own = np.flatnonzero(dim == d)
                    angles = _angles(_vectors(batch.column("vec").take(pa.array(own))), norm[own], sent.value[d])
                    cluster[own] = angles.argmin(axis=1)
                    angle[own] = angles.min(axis=1)
            yield pa.record_batch([*batch.columns, pa.array(cluster), pa.array(angle)], names=[*batch.schema.names, "cluster", "angle"])

    kind = kept.schema["label"].dataType.simpleString()
    anchors = stored(asked.select("id", "label", "dim", "norm", "vec").mapInArrow(placed, f"id long, label {kind}, dim int, norm double, vec binary, cluster int, angle double"))
    # Rows whose scores give every walk its start: a bounded sample, by rows and bytes.
    widest = kept.agg(F.max("dim")).first()[0] or 1
    some = kept.dropDuplicates(["id"]) if total <= SEEDS else kept.where(F.pmod(F.xxhash64("id", F.lit(9)), F.lit(total)) < SEEDS).dropDuplicates(["id"])
    rows_sent = some.select("id", "label", "dim", "vec").orderBy(F.xxhash64("id"), "id").limit(max(1, min(SEEDS, SEED_BYTES // (8 * widest)))).toArrow()
    seeds: dict[int, tuple] = {}
    dim = rows_sent.column("dim").to_numpy()
    for d in np.unique(dim).tolist():
        own = rows_sent.take(pa.array(np.flatnonzero(dim == d)))
        seeds[d] = own.column("id").to_numpy(), own.column("label").to_numpy(), _vectors(own.column("vec"))

    open_ = anchors.withColumns({"caps": F.array(F.lit(_MOST).cast("long")), "floors": F.array(F.lit(_LEAST).cast("long"))})
    found = _walk(stored(_floors(open_, seeds, True, positives)), kept, blocks, towards, True, positives)
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    best = stored(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= positives).select("anchor", "rank", "id", "score"))

    # Scores of a positive's negatives: from low to high hundredths of its own, in whole numbers.
    exact = "decimal(38,0)"
    hundredths = lambda part: F.expr(f"cast(score as {exact}) * {part}bd")
    least = F.ceil(hundredths(low) / 100).cast(exact)
    most = F.floor(hundredths(high) / 100).cast(exact)
    ends = best.withColumns({"low": F.greatest(least, F.lit(_LEAST).cast(exact)).cast("long"), "high": F.least(most, F.lit(_MOST).cast(exact)).cast("long")}).where("low <= high")
    slots = ends.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score", "low", "high"))).alias("slots"))
    bounded = stored(anchors.join(slots, anchors["id"] == slots["anchor"]).withColumns({"caps": _filled("high", F.lit(_LEAST), positives), "floors": _filled("low", F.lit(_MOST), positives)}))
    columns = [*anchors.columns, "caps", "floors"]
    near = _walk(stored(_floors(bounded.select(*columns), seeds, False, negatives)), kept, blocks, towards, False, negatives)
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    named = bounded.select("anchor", F.posexplode("slots").alias("slot", "positive")).select("anchor", F.col("slot").cast("long").alias("slot"), "positive.id", "positive.score")
    named = named.toDF("anchor", "slot", "positive_id", "positive_score")
    return ranked.join(named, ["anchor", "slot"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _filled(field: str, rest: Column, many: int) -> Column:
    """The field of every slot, and ``rest`` for slots that are not there: an empty range."""
    return F.concat(F.transform("slots", lambda s: s[field]), F.array_repeat(rest.cast("long"), F.lit(many) - F.size("slots")))
