"""Comparing the members of buckets in blocks of bounded size.

Rows that share a bucket are dealt into blocks by a hash, and every pair of blocks
is a group of its own, so a bucket that holds a third of all rows is worked on by
many tasks. A task reads its partition sorted by group and sees one group at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 2048


def block_pairs(rows: DataFrame, size: Column, member: str, block: int = BLOCK) -> DataFrame:
    """Each row once for every pair of blocks its block is in: adds ``side`` (its block), ``lo`` and ``hi``.

    ``size`` is the number of rows in the row's bucket, ``member`` what deals them out.
    """
    blocks = F.ceil(size / block).cast("int")
    return (
        rows.withColumn("blocks", blocks)
        .withColumn("side", F.pmod(F.xxhash64(member, F.lit(17)), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"lo": F.least("side", "other"), "hi": F.greatest("side", "other")}).drop("other", "blocks")
    )


def grouped(rows: DataFrame, keys: list[str], order: tuple[str, ...] = ()) -> DataFrame:
    """Rows of a group next to each other, in one partition."""
    return rows.repartition(*keys).sortWithinPartitions(*keys, *order)


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.RecordBatch, list[int]]]:
    """Batches of whole groups with the row numbers where groups start, and the end."""
    pending: list[pa.RecordBatch] = []

    def split(batch: pa.RecordBatch) -> np.ndarray:
        change = np.zeros(max(batch.num_rows - 1, 0), dtype=bool)
        for k in keys:
            v = batch.column(k).to_numpy(zero_copy_only=False)
            change |= v[1:] != v[:-1]
        return np.flatnonzero(change) + 1

    def whole() -> pa.RecordBatch:
        return pending[0] if len(pending) == 1 else pa.Table.from_batches(pending).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        if pending:
            last = pending[-1]
            same = all(last.column(k)[last.num_rows - 1] == batch.column(k)[0] for k in keys)
            if not same:
                done = whole()
                yield done, [0, *split(done).tolist(), done.num_rows]
                pending = []
        starts = split(batch)
        if len(starts):
            cut = int(starts[-1])
            pending.append(batch.slice(0, cut))
            done = whole()
            yield done, [0, *split(done).tolist(), done.num_rows]
            pending = [batch.slice(cut)]
        else:
            pending.append(batch)
    if pending:
        done = whole()
        yield done, [0, *split(done).tolist(), done.num_rows]


def matrix(column: pa.Array, kind: str = "<f8") -> np.ndarray:
    """A column of equally long binary vectors as rows of doubles."""
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), dtype=kind).astype(np.float64).reshape(len(raw), -1)


def roots(linked: np.ndarray) -> np.ndarray:
    """For a symmetric matrix of links, each row's smallest reachable row."""
    label = np.arange(len(linked))
    while True:
        near = np.where(linked, label[None, :], len(linked)).min(axis=1, initial=len(linked))
        new = np.minimum(label, near)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new
