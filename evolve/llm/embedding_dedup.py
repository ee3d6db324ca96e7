"""Near-duplicate embeddings by Euclidean p-stable hashing.

Normalised vectors are projected on Gaussian directions and the projections cut into
cells of one width; vectors that share all cells of a table and their label are
candidates, and the exact cosine in double precision decides. For two unit vectors at
distance c one projection agrees with probability
1 - 2 P(Z < -w/c) - 2c / (sqrt(2 pi) w) (1 - exp(-w^2 / 2c^2)); with w = 1.6, ten
projections and forty tables a pair at the threshold of 0.98 (c = 0.2) is missed with a
probability of 4e-8, while unrelated vectors share a table with one of 1e-4.

Equal vectors of one label are one class and are compared once. A bucket is compared in
blocks; a pair counts in the first table that brings it together. No pair leaves a
block: only each vector's number of links and its smallest reachable class.

Defined results: vectors that are null, all zero or hold null or non-finite components,
and rows with a null label or null id, link with nothing; vectors of different
dimension do not link; repeated rows are vectors of their own and link with each other;
an empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evolve.llm.blocks import block_pairs, grouped, matrix, roots, runs
from evolve.llm.components import components
from evolve.llm.vectors import usable
from evolve.llm.words import mix
from evolve.storage import stored

THRESHOLD = 0.98
TABLES = 40
PROJECTIONS = 10
WIDTH = 1.6


def _cells(unit: np.ndarray, tables: int, projections: int, width: float) -> np.ndarray:
    """Bucket of each vector in each table, as 64-bit integers."""
    rng = np.random.default_rng([20, unit.shape[1]])
    direction = rng.standard_normal((unit.shape[1], tables * projections))
    shift = rng.uniform(0, width, tables * projections)
    cell = np.floor((unit @ direction + shift) / width).astype(np.int64).reshape(len(unit), tables, projections)
    bucket = np.broadcast_to(np.arange(tables, dtype=np.uint64), (len(unit), tables))
    for p in range(projections):
        bucket = mix(bucket * np.uint64(31) + cell[:, :, p].astype(np.uint64))
    return bucket


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows at length one. A power of two is taken out first, so that squares neither overflow nor vanish; other rows are not changed by it."""
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def linked_classes(classes: DataFrame, threshold: float, tables: int, projections: int, width: float) -> DataFrame:
    """rep, links (weight of the classes linked to it), root (smallest rep reachable in one block); several rows per rep.

    ``classes``: rep, weight, group (pairs need equal ones), vec (doubles, little-endian).
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column("vec").to_pylist()])
            for size in np.unique(sizes).tolist():
                own = batch.filter(pa.array(sizes == size))
                cells = _cells(_unit(matrix(own.column("vec"))), tables, projections, width)
                group = own.column("group").to_numpy().view(np.uint64)
                keys = mix(cells + mix(group + np.uint64(size))[:, None]).view(np.int64)
                rep = np.repeat(own.column("rep").to_numpy(), tables)
                yield pa.record_batch([pa.array(keys.reshape(-1)), pa.array(rep)], names=["bucket", "rep"])

    at = stored(classes.select("rep", "group", "vec").mapInArrow(hashed, "bucket long, rep long"))
    shared = at.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = at.join(shared, "bucket").join(classes, "rep")
    spread = grouped(block_pairs(members, F.col("n"), "rep").drop("n"), ["bucket", "lo", "hi"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, starts in runs(batches, ["bucket", "lo", "hi"]):
            rep, weight, group, side, lo, hi, bucket = (batch.column(c).to_numpy() for c in ("rep", "weight", "group", "side", "lo", "hi", "bucket"))
            raw = batch.column("vec").to_pylist()
            out: tuple[list, list, list] = ([], [], [])
            for a, b in zip(starts, starts[1:], strict=False):
                if b - a < 2 or len({len(v) for v in raw[a:b]}) > 1:
                    continue
                unit = _unit(np.frombuffer(b"".join(raw[a:b]), dtype="<f8").reshape(b - a, -1))
                near = (unit @ unit.T >= threshold) & (group[a:b, None] == group[None, a:b])
                np.fill_diagonal(near, False)
                if lo[a] != hi[a]:
                    near &= side[a:b, None] != side[None, a:b]
                if not near.any():
                    continue
                some = np.flatnonzero(near.any(axis=1))
                near, own = near[np.ix_(some, some)], unit[some]
                # A pair counts in the first table whose bucket it shares, which may be an earlier one than this.
                cells = _cells(own, tables, projections, width)
                size = len(raw[a])
                keys = mix(cells + mix(group[a:b][some].view(np.uint64) + np.uint64(size))[:, None]).view(np.int64)
                here = int(np.flatnonzero(keys[0] == bucket[a])[0]) if (keys[0] == bucket[a]).any() else tables
                first = near.copy()
                for t in range(here):
                    first &= keys[:, t, None] != keys[None, :, t]
                if first.any():
                    label = roots(first)
                    kept = first.any(axis=1)
                    reps = rep[a:b][some]
                    # The smallest rep of each part stands for it.
                    order = np.argsort(reps, kind="stable")
                    least = np.full(len(reps), np.iinfo(np.int64).max)
                    np.minimum.at(least, label[order], reps[order])
                    out[0].append(reps[kept])
                    out[1].append((first @ weight[a:b][some])[kept])
                    out[2].append(least[label][kept])
            if out[0]:
                yield pa.record_batch([pa.array(np.concatenate(c).astype(np.int64)) for c in out], names=["rep", "links", "root"])

    return spread.mapInArrow(compare, "rep long, links long, root long")


def near_duplicates(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD,
    tables: int = TABLES, projections: int = PROJECTIONS, width: float = WIDTH,
) -> DataFrame:
    """One row per vector: key, n_links, component_id (smallest key reachable), kept."""
    takes_part = usable(vector) & F.col(label).isNotNull() & F.col(key).isNotNull()
    vec = F.transform(F.col(vector), lambda x: x.cast("double"))
    all_rows = rows.select(
        F.col(key).cast("long").alias("key"), takes_part.alias("takes_part"),
        F.when(takes_part, F.xxhash64(F.col(label))).alias("group"), F.when(takes_part, vec).alias("v"),
    )
    classes = all_rows.where("takes_part").groupBy("group", "v").agg(F.min("key").alias("rep"), F.count("*").alias("weight"))
    # The class of a row, without its vector.
    name = F.xxhash64("group", "v")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs = [np.asarray(v, dtype="<f8").tobytes() for v in batch.column("v").to_pylist()]
            yield pa.record_batch([batch.column("rep"), batch.column("weight"), batch.column("group"), pa.array(vecs, pa.binary())], names=["rep", "weight", "group", "vec"])

    packed_classes = stored(classes.select("rep", "weight", "group", "v").mapInArrow(packed, "rep long, weight long, group long, vec binary"))
    found = stored(linked_classes(packed_classes, threshold, tables, projections, width))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    reached = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    by_rep = packed_classes.select("rep", "weight").join(links, "rep", "left").join(reached.withColumnRenamed("node", "rep"), "rep", "left")
    per_class = classes.select("group", "v", "rep").withColumn("name", name)
    members = all_rows.withColumn("name", F.when(F.col("takes_part"), name)).select("key", "name")
    by_name = per_class.select("name", "rep").join(by_rep, "rep")
    return members.join(by_name, "name", "left").select(
        F.col("key").alias(key),
        F.coalesce(F.col("weight") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "rep", "key").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))


def miss_probability(cosine: float, tables: int = TABLES, projections: int = PROJECTIONS, width: float = WIDTH) -> float:
    """How likely a pair of this cosine shares no table."""
    c = math.sqrt(2 - 2 * cosine)
    r = width / c
    one = 1 - math.erfc(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))
    return (1 - one ** projections) ** tables
