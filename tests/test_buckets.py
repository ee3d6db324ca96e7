"""Tables in hash buckets: what a batch rewrites, what a repeated or failed one leaves."""

import pathlib

import pytest
from pyspark.sql import functions as F

from evolve.sources import buckets as B
from evolve.sources.buckets import BucketedTable
from evolve.streaming.rows import upsert_buckets
from tests.conftest import rows

PATCH = "id long, field string, value string"


@pytest.fixture
def table(spark, tmp_path):
    df = spark.range(2000).select("id", F.concat(F.lit("n"), "id").alias("name"), (F.col("id") % 7).alias("n"))
    return BucketedTable.create(df, str(tmp_path / "t"), "id", buckets=64)


def files(table):
    return {str(p.relative_to(table.path)): p.stat().st_mtime_ns for p in pathlib.Path(table.path, "data").rglob("*.parquet")}


def test_one_key_rewrites_one_bucket(table, frame):
    before = files(table)
    assert table.upsert(frame([(77, "name", "new")], PATCH)) == 1
    after = files(table)
    assert {f: after[f] for f in before} == before and len(set(after) - set(before)) == 1
    old, new = table.manifest(0), table.manifest(1)
    assert sum(old.held[b] != new.held[b] for b in range(64)) == 1 and len(new.held) == 64
    assert rows(table.read().where("name = 'new'")) == [(77, "new", 0)] and table.read().count() == 2000
    # The version before is still there, and one bucket can be read by itself.
    assert table.read(0).where("name = 'new'").count() == 0
    assert sum(table.read(only=[b]).count() for b in range(64)) == 2000


def test_a_repeated_batch_changes_nothing(table, frame):
    patch = frame([(1, "name", "a"), (5000, "name", "b"), (None, "name", "lost")], PATCH)
    assert table.upsert(patch, stream="s", batch=0) == 1
    before = files(table)
    assert table.upsert(patch, stream="s", batch=0) == 1 and files(table) == before
    assert table.upsert(patch.where("false"), stream="s", batch=1) == 2 and files(table) == before
    assert table.upsert(patch.where("false")) == 2
    assert table.manifest().applied == {"s": 1}
    assert table.upsert(frame([(1, "n", "9")], PATCH), stream="other", batch=0) == 3
    assert table.manifest().applied == {"s": 1, "other": 0}
    assert rows(table.read().where("id in (1, 5000) or id is null")) == [(1, "a", 9), (5000, "b", None)]


def test_a_failed_write_leaves_the_version_before_it(table, frame, monkeypatch):
    def fail(self, manifest):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(B.BucketedTable, "_commit", fail)
        with pytest.raises(RuntimeError):
            table.upsert(frame([(3, "name", "x")], PATCH), stream="s", batch=0)
    assert table.versions() == [0] and table.read().where("name = 'x'").count() == 0
    # A manifest without its mark does not count either.
    pathlib.Path(table.path, "manifest", "v=1").mkdir()
    pathlib.Path(table.path, "manifest", "v=1", "part-0.txt").write_text("{")
    assert table.upsert(frame([(3, "name", "y")], PATCH), stream="s", batch=0) == 1
    assert rows(table.read().where("id = 3")) == [(3, "y", 3)]


def test_old_versions_expire(table, frame):
    for k in range(4):
        table.upsert(frame([(k, "name", f"v{k}")], PATCH))
    everything = rows(table.read())
    assert table.expire(keep=2) <= 3 and table.versions() == [3, 4]
    assert rows(table.read()) == everything and table.read(3).count() == 2000
    table.expire()
    assert table.versions() == [4] and rows(table.read()) == everything
    with pytest.raises(ValueError):
        BucketedTable.create(table.read(), table.path, "id", 4)


def test_empty_tables_and_buckets(spark, tmp_path, frame):
    table = BucketedTable.create(frame([], "id string, bucket int, __x string"), str(tmp_path / "e"), "id", buckets=8)
    assert table.read().count() == 0 and table.manifest().held == {}
    table.upsert(frame([("a", "bucket", "4"), ("b", "__x", "z")], "id string, field string, value string"))
    assert rows(table.read()) == [("a", 4, None), ("b", None, "z")]
    with pytest.raises(ValueError):
        BucketedTable(spark, str(tmp_path / "none")).read()


def test_a_stream_rewrites_the_buckets_of_each_batch(spark, table, tmp_path):
    schema = "id long, field string, value string, at int"
    source = tmp_path / "in"
    for k in range(3):
        spark.createDataFrame([(k, "name", f"late{k}", 2), (k, "name", f"early{k}", 1)], schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).parquet(str(source))
        upsert_buckets(stream, table, str(tmp_path / "state"), "at", name="patches").awaitTermination()
        new, old = table.manifest(), table.manifest(k)
        assert new.version == k + 1 and new.applied == {"patches": k}
        assert sum(new.held[b] != old.held[b] for b in new.held) == 1
    assert rows(table.read().where("id < 3").select("name")) == [("late0",), ("late1",), ("late2",)]
    # The checkpoint is lost, so the same batches come again.
    upsert_buckets(spark.readStream.schema(schema).parquet(str(source)), table, str(tmp_path / "other"), "at", name="patches").awaitTermination()
    assert table.versions()[-1] == 3
