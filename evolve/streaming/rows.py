"""Row-wise steps on streams, and record patches applied batch by batch.

Operators of the columns and values kind hold no state, so the same function
serves a streaming frame. Upserts need their target and run per micro-batch: into a
table of hash buckets, of which a batch rewrites only those that it touches, or by
functions of the caller that read and write a whole target.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from evolve.operators.records import upsert_records
from evolve.sources.buckets import BucketedTable


def apply_steps(stream: DataFrame, steps: Sequence[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    out = stream
    for step in steps:
        out = step(out)
    return out


def upsert_stream(
    patches: DataFrame, read_target: Callable[[int], DataFrame], write_target: Callable[[DataFrame, int], None],
    key: str, checkpoint: str, position: str, create: str = "auto",
) -> StreamingQuery:
    """Apply a stream of patch rows to a stored table, one rewrite per micro-batch.

    Two changes to one field in one batch are normal; ``position`` is the column
    that tells which is the later one.

    Reading and writing get the batch number: a batch that is run again after a
    failure must read the version before it and write the same version again.
    """
    def apply(batch: DataFrame, number: int) -> None:
        write_target(upsert_records(read_target(number), batch, key, create, position=position), number)

    return (
        patches.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def upsert_buckets(
    patches: DataFrame, table: BucketedTable, checkpoint: str, position: str, create: str = "auto", name: str | None = None,
) -> StreamingQuery:
    """Apply a stream of patch rows to a bucketed table; a micro-batch costs what its buckets hold.

    The table knows the last batch of each stream, by ``name`` (its checkpoint folder if there is none), so
    a batch that is run again after a failure changes nothing.
    """
    stream = name or checkpoint

    def apply(batch: DataFrame, number: int) -> None:
        table.upsert(batch, create, position=position, stream=stream, batch=number)

    return (
        patches.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
