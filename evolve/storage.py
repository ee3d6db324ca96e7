"""Cutting lineage, and the size checks behind every broadcast hint."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType, StructType

# A mapping written out in the plan is broadcast up to this many rows and
# characters; beyond either the join is left to the planner, which shuffles or
# broadcasts by statistics.
BROADCAST_ROWS = 10_000
BROADCAST_CHARS = 4_000_000


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="evolve-checkpoint-")
    context.setCheckpointDir(configured)


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it from there.

    Used where a value must not change between two uses (positions, ids) and
    between rounds of an iteration. Survives the loss of executors.
    """
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table to the shared checkpoint folder and read it from there.

    Like ``checkpointed``, and whoever reads it afterwards reads only the
    columns it needs.
    """
    path = scratch_folder(df.sparkSession)
    # A column that is an untyped NULL has no form in a file.
    untyped = [f.name for f in df.schema.fields if isinstance(f.dataType, NullType)]
    kept = df.drop(*untyped)
    kept.write.parquet(path)
    back = df.sparkSession.read.schema(kept.schema).parquet(path)
    return back.withColumns({c: F.lit(None) for c in untyped}).select(*df.columns) if untyped else back


_SCRATCH: list[str] = []


def clear_stored(spark: SparkSession) -> int:
    """Delete every table and folder that this session has put under the checkpoint folder; how many there were.

    For the end of a job: frames read from them no longer work afterwards.
    """
    done = 0
    while _SCRATCH:
        delete_folder(spark, _SCRATCH.pop())
        done += 1
    return done


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def list_folder(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder of the store that Spark writes to; none if it is not there."""
    path, files = _path(spark, folder)
    return [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []


def delete_folder(spark: SparkSession, folder: str) -> bool:
    path, files = _path(spark, folder)
    return files.delete(path, True)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder under the shared checkpoint folder, for streams and stored versions."""
    _ensure_checkpoint_dir(spark)
    _SCRATCH.append(f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}")
    return _SCRATCH[-1]


def small(rows: int, df: DataFrame, chars: int = 0) -> DataFrame:
    """Hint a broadcast when the known bounds of ``df`` allow it."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS and chars <= BROADCAST_CHARS else df


def mapping_table(spark: SparkSession, rows: Iterable[tuple], schema: str | StructType) -> DataFrame:
    """A pinned mapping (old name to new name and the like) as a joinable frame."""
    rows = list(rows)
    return small(len(rows), spark.createDataFrame(rows, schema), sum(len(str(v)) for r in rows for v in r))
