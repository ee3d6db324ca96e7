"""Which values can be frequent, from counts in a fixed number of cells.

Values fall into cells by a hash, and a cell's count is never below that of a value in
it: what lies in a cell below the threshold is certainly not frequent. A task counts in
one table of its own and hands it on in chunks, each count cut off at the threshold: the
sum of counts cut off reaches it exactly when the sum of the whole ones does. So memory,
and what leaves a task, is bounded by the number of cells, and the result does not depend
on how rows are dealt to tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from evolve.llm.blocks import grouped

CHUNK = 1 << 16


def heavy_cells(rows: DataFrame, fill: Callable[[Iterator[pa.RecordBatch], np.ndarray], None], cells: int, least: int) -> bytes:
    """A bit for each of ``cells`` cells (a multiple of 8): whether its count over all rows is ``least`` or more.

    ``fill`` adds the rows of a task to a table of 32-bit counts.
    """
    kind = "<u1" if least < 256 else "<u4"
    chunk = min(CHUNK, cells)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(cells, dtype=np.uint32)
        fill(batches, table)
        np.minimum(table, least, out=table)
        coder = zstandard.ZstdCompressor(level=1)
        for k in range(0, cells, chunk):
            part = table[k:k + chunk]
            if part.any():
                yield pa.record_batch([pa.array([k // chunk], pa.int64()), pa.array([coder.compress(part.astype(kind).tobytes())], pa.binary())], names=["chunk", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, here, total = zstandard.ZstdDecompressor(), None, np.zeros(0, dtype=np.uint64)

        def bits() -> pa.RecordBatch:
            return pa.record_batch([pa.array([here], pa.int64()), pa.array([np.packbits(total >= least, bitorder="little").tobytes()], pa.binary())], names=["chunk", "bits"])

        for batch in batches:
            for k, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                more = np.frombuffer(coder.decompress(counts), dtype=kind)
                if k != here:
                    if here is not None:
                        yield bits()
                    here, total = k, np.zeros(len(more), dtype=np.uint64)
                np.minimum(total + more, least, out=total)
        if here is not None:
            yield bits()

    counted = rows.mapInArrow(count, "chunk long, counts binary")
    out = np.zeros(-(-cells // 8), dtype=np.uint8)
    for row in grouped(counted, ["chunk"]).mapInArrow(add, "chunk long, bits binary").toLocalIterator():
        part = np.frombuffer(row["bits"], dtype=np.uint8)
        out[row["chunk"] * chunk // 8:row["chunk"] * chunk // 8 + len(part)] = part
    return out.tobytes()


def is_heavy(bits: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """Whether each of the cells has its bit set."""
    return (bits[cell >> 3] >> (cell & 7)) & 1 > 0
