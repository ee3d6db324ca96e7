import time

import pytest
from pyspark.sql import functions as F

from evolve.dataset import Dataset
from evolve.operators import schema as S
from evolve.operators.joins import update_from
from evolve.operators.schemadiff import diff_attributes, diff_fields
from evolve.sources import tables as T
from evolve.storage import BROADCAST_ROWS, mapping_table
from tests.conftest import rows


def test_rename_round_trip_and_legacy(frame):
    df = frame([(1, "a")], "id int, name string")
    assert S.rename_columns(df, [("name", None), ("gone", "x")]).columns == ["id", "legacy__name"]
    assert S.rename_columns(S.rename_columns(df, [("id", "i")]), [("i", "id")]).columns == df.columns


def test_rename_fields_changes_column_and_metadata(frame):
    meta = frame([("sale", "a"), ("sale", "b"), ("other", "a")], "model string, name string")
    ds = Dataset({"sale": frame([(1, 2)], "a int, b int"), "fields": meta})
    out = S.rename_fields(ds, [("sale", "sale", "a", "x")])
    assert out["sale"].columns == ["x", "b"]
    assert rows(out["fields"].select("model", "name")) == [("other", "a"), ("sale", "b"), ("sale", "x")]


def test_rename_tables_is_safe_to_rerun(frame):
    ds = Dataset({"a": frame([(1,)], "x int")})
    once = ds.rename_tables([("a", "b")])
    assert set(once.rename_tables([("a", "b")])) == {"b"}
    with pytest.raises(ValueError):
        Dataset({"a": ds["a"], "b": ds["a"]}).rename_tables([("a", "b")])


def test_cast_columns_null_or_raise(frame):
    df = frame([("1",), ("x",)], "s string")
    assert rows(S.cast_columns(df, {"s": "int"})) == [(1,), (None,)]
    with pytest.raises(Exception, match="cannot cast"):
        S.cast_columns(df, {"s": "int"}, on_error="raise").collect()


def test_add_and_copy(frame):
    ds = S.add_columns(Dataset({"t": frame([(1,)], "a int")}), [("t", "b", "string", "x"), ("t", "c", "double", None)])
    assert rows(ds["t"]) == [(1, "x", None)]
    again = S.add_column_if_absent(ds["t"], "b", "int")
    assert again.schema["b"].dataType.simpleString() == "string"
    assert S.copy_columns(ds["t"], [("a", None, None), ("a", "d", "string")]).columns == ["a", "b", "c", "legacy__a", "d"]


def test_field_references_respect_word_edges_and_model(frame):
    df = frame([("m", "[('date','=',1),('date_end','=',2),('x.date','=',3)]"), ("n", "date")], "model string, domain string")
    out = S.rename_field_references(df, "domain", [("m", "date", "day")], "model")
    assert rows(out) == [("m", "[('day','=',1),('date_end','=',2),('x.date','=',3)]"), ("n", "date")]


def test_field_references_do_not_chain_and_many_are_planned_quickly(frame):
    df = frame([("m", "a b x.a a_b"), ("n", "a b"), (None, "a"), ("m", None)], "model string, domain string")
    out = S.rename_field_references(df, "domain", [("m", "a", "b"), ("m", "b", "c"), ("n", "a", "b"), ("n", "b", "a")], "model")
    assert rows(out) == sorted([("m", "b c x.a a_b"), ("n", "b a"), (None, "a"), ("m", None)], key=repr)
    start = time.perf_counter()
    many = S.rename_field_references(df, "domain", [("m", f"f{i}", f"g{i}") for i in range(200)] + [("m", "a", "z")], "model")
    assert len(rows(many)) == 4 and time.perf_counter() - start < 5
    assert ("m", "z b x.a a_b") in rows(many)


def test_retain_dropped_and_report(frame):
    old, new = frame([(1, "a", 2), (2, "b", None)], "id int, s string, n int"), frame([(1, "z"), (3, "y")], "id int, s string")
    assert rows(S.retain_dropped(old, new, ["id"])) == [(1, "z", 2), (3, "y", None)]
    report = S.retained_report({"t": old, "u": old}, {"t": new})
    assert [r[1:3] for r in rows(report)] == [("t.n", 1), ("u", 2)]
    assert S.retained_report({"t": old}, {"t": old}) is None
    assert sorted(S.retain_tables({"t": old, "u": old}, {"t": new})) == ["t", "u"]


def test_catalogs_of_two_datasets_can_be_compared(spark, frame):
    old, new = {"t": frame([(1, "a")], "id int, s string")}, {"t": frame([(1, 2)], "id long, n int")}
    a, b = S.catalog_rows(spark, "m", old), S.catalog_rows(spark, "m", new)
    assert [(r.field, r.change) for r in diff_fields(a, b).orderBy("field").collect()] == [("n", "NEW"), ("s", "DEL")]
    changed = diff_attributes(a, b, ["module", "model", "field"], ["type"])
    assert rows(changed) == [("m", "t", "id", "type", "int", "bigint")]


def test_tables(frame, spark, tmp_path):
    ds = Dataset({"t": frame([(1, "a"), (2, "b")], "id int, s string")})
    assert rows(T.scan(ds, "t", ["s"], ds["t"].id > 1)) == [("b",)]
    assert rows(T.snapshot(ds, "t", ["id"])["legacy__t"]) == [(1,), (2,)]
    assert rows(T.append_select(ds["t"], frame([(3,)], "id int"))) == [(1, "a"), (2, "b"), (3, None)]
    with pytest.raises(ValueError):
        T.append_select(ds["t"], frame([(3,)], "nope int"))
    assert T.clear_table(ds["t"]).count() == 0 and T.clear_table(ds["t"]).columns == ["id", "s"]
    ds.write(str(tmp_path))
    assert rows(Dataset.read(spark, str(tmp_path), ["t"])["t"]) == rows(ds["t"])
    assert T.create_relation(spark, "a", "b").dtypes == [("a", "bigint"), ("b", "bigint")]


def test_bucketed_tables_join_without_a_shuffle(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        T.save_table(spark.range(100).withColumnRenamed("id", "k"), "left_side", ["k"], 4, mode="overwrite")
        T.save_table(spark.range(50).selectExpr("id AS k", "id AS v"), "right_side", ["k"], 4, mode="overwrite")
        ds = Dataset.from_catalog(spark, ["left_side", "right_side"])
        out = update_from(ds["left_side"], ds["right_side"], ["k"], {"v": F.col("s.v")}, unique=True)
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
        assert out.where("v IS NULL").count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_mappings_are_broadcast_only_up_to_the_bound(spark):
    def hinted(n):
        df = mapping_table(spark, [(str(i), "x") for i in range(n)], "old string, new string")
        return "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString()

    assert hinted(3) and not hinted(BROADCAST_ROWS + 1)
