"""What the operators share: reading tables, slices of Arrow batches, vocabulary files."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from evolve.session import tune

# Rows and bytes of text that one Python step holds at a time.
SLICE_ROWS = 512
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table, with the session settings that the operators expect."""
    return tune(spark).read.parquet(f"{folder}/{name}.parquet")


def slices(batches: Iterable[pa.RecordBatch], text: str | None = None) -> Iterator[pa.RecordBatch]:
    """Cut batches into pieces of bounded rows and bytes; a row is never cut."""
    for batch in batches:
        size = batch.nbytes if text is None else batch.column(text).nbytes
        rows = max(1, min(SLICE_ROWS, batch.num_rows * SLICE_BYTES // max(size, 1)))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file, looked up where the task runs."""
    import public_tokenizers

    return public_tokenizers.path(name)


_TOKENIZERS: dict[str, object] = {}


def tokenizer(name: str):
    """The library's tokenizer of a vocabulary file, once per Python worker; a path may stand for a name."""
    if name not in _TOKENIZERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(name if os.path.isabs(name) else vocabulary(name))
        made.no_truncation()
        made.no_padding()
        _TOKENIZERS[name] = made
    return _TOKENIZERS[name]


def byte_of_char() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabularies: themselves where printable, else from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
