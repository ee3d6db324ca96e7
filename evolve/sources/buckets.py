"""A table in hash buckets, of which a batch of changes rewrites only those that it touches.

Rows lie in the bucket that a hash of their key names. A version is a manifest: which
earlier write holds each bucket. A write puts new files beside the old ones and becomes
visible by its manifest, which is whole once its ``_SUCCESS`` is there; a write that
fails halfway leaves the version before it as it was and is overwritten by the next one.
Readers of a version are not disturbed by later ones until it expires. One writer at a
time, as with the sink of a stream.

    <path>/data/v=<write>/__bucket=<k>/*.parquet
    <path>/manifest/v=<version>/*.txt, _SUCCESS
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from evolve.operators.records import upsert_records
from evolve.storage import delete_folder, list_folder, stored

BUCKET = "__bucket"


@dataclass(frozen=True)
class Manifest:
    """Where the buckets of a version are, and the last batch of every stream that is in it."""

    version: int
    key: str
    buckets: int
    schema: str
    held: dict[int, int]
    applied: dict[str, int] = field(default_factory=dict)

    def to_text(self) -> str:
        return json.dumps(self.__dict__)

    @classmethod
    def of_text(cls, text: str) -> Manifest:
        values = json.loads(text)
        return cls(**values | {"held": {int(k): v for k, v in values["held"].items()}})


class BucketedTable:
    """A keyed table under a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def create(cls, df: DataFrame, path: str, key: str, buckets: int) -> BucketedTable:
        """Store ``df`` as version 0. Rows without a key lie in a bucket like all others."""
        table = cls(df.sparkSession, path)
        if table.versions():
            raise ValueError(f"{path} holds a table already")
        empty = Manifest(0, key, buckets, df.schema.json(), {})
        table._commit(replace(empty, held=table._write(df, empty, 0)))
        return table

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        named = (n for n in list_folder(self.spark, f"{self.path}/manifest") if n.startswith("v="))
        whole = (n for n in named if "_SUCCESS" in list_folder(self.spark, f"{self.path}/manifest/{n}"))
        return sorted(int(n[2:]) for n in whole)

    def manifest(self, version: int | None = None) -> Manifest:
        if version is None:
            committed = self.versions()
            if not committed:
                raise ValueError(f"{self.path} holds no table")
            version = committed[-1]
        return Manifest.of_text(self.spark.read.text(f"{self.path}/manifest/v={version}", wholetext=True).first()[0])

    def read(self, version: int | None = None, only: Iterable[int] | None = None) -> DataFrame:
        """The rows of a version, the newest if none is named; ``only`` some buckets."""
        now = self.manifest(version)
        return self._rows(now, now.held if only is None else [b for b in only if b in now.held])

    def _rows(self, now: Manifest, buckets: Iterable[int]) -> DataFrame:
        schema = StructType.fromJson(json.loads(now.schema))
        paths = [f"{self.path}/data/v={now.held[b]}/{BUCKET}={b}" for b in sorted(buckets)]
        reader = self.spark.read.schema(schema)
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _bucket(self, now: Manifest) -> Column:
        kind = StructType.fromJson(json.loads(now.schema))[now.key].dataType
        return F.pmod(F.xxhash64(F.col(now.key).cast(kind)), F.lit(now.buckets)).cast("int")

    def _write(self, df: DataFrame, now: Manifest, version: int) -> dict[int, int]:
        """Store rows as a new write; which buckets have any."""
        folder = f"{self.path}/data/v={version}"
        df.withColumn(BUCKET, self._bucket(now)).repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
        names = (n for n in list_folder(self.spark, folder) if n.startswith(f"{BUCKET}="))
        return {int(n[len(BUCKET) + 1:]): version for n in names}

    def _commit(self, manifest: Manifest) -> None:
        text = self.spark.createDataFrame([(manifest.to_text(),)], "value string").coalesce(1)
        text.write.mode("overwrite").text(f"{self.path}/manifest/v={manifest.version}")

    def upsert(
        self, patch: DataFrame, create: str = "auto", protected: Column | None = None, position: str | None = None,
        stream: str | None = None, batch: int | None = None,
    ) -> int:
        """Apply patch rows as ``upsert_records`` does, rewriting the buckets of their keys; the version that has them.

        A ``batch`` of a ``stream`` that is in the table already changes nothing: the manifest that shows its rows
        also holds its number. Only the numbers of touched buckets come to the driver.
        """
        now = self.manifest()
        if stream is not None and batch is not None and now.applied.get(stream, -1) >= batch:
            return now.version
        rows = stored(patch.where(F.col(now.key).isNotNull()))
        touched = {r[0] for r in rows.select(self._bucket(now)).distinct().collect()}
        applied = now.applied | ({} if stream is None or batch is None else {stream: batch})
        version, held = now.version + 1, now.held
        if touched:
            old = self._rows(now, touched & held.keys())
            new = upsert_records(old, rows, now.key, create, protected, position)
            held = {b: v for b, v in held.items() if b not in touched} | self._write(new, now, version)
        elif applied == now.applied:
            return now.version
        self._commit(replace(now, version=version, held=held, applied=applied))
        return version

    def expire(self, keep: int = 1) -> int:
        """Delete what only versions before the last ``keep`` use; how many writes went."""
        committed = self.versions()
        kept = [self.manifest(v) for v in committed[-keep:]]
        for version in committed[:-keep]:
            delete_folder(self.spark, f"{self.path}/manifest/v={version}")
        used = {v for m in kept for v in m.held.values()}
        # A write that is not committed yet is newer than all versions.
        old = [v for v in (int(n[2:]) for n in list_folder(self.spark, f"{self.path}/data") if n.startswith("v=")) if v not in used and v <= committed[-1]]
        for version in old:
            delete_folder(self.spark, f"{self.path}/data/v={version}")
        return len(old)
