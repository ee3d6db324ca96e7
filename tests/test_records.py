import random

import pytest
from pyspark.sql import functions as F

from evolve.dataset import Dataset
from evolve.operators import identity as K
from evolve.operators import records as R
from evolve.sources import records as X
from evolve.sources import reports as P
from tests.conftest import rows

XML = """<?xml version='1.0' encoding='utf-8'?>
<data>
  <!-- <record id="commented" model="m"><field name="x">1</field></record>
  <record id="commented2" model="m"><field name="x">1</field></record> <record id="c3" model="m"/> -->
  <record id="cm" model="unit" forcecreate="False">
    <field name="factor" eval="0.0"/>
    <field name="name">Centi &amp; metre</field>
    <field name="parent" ref="base.mm"/><!-- a note -->
    <field name="body" type="html"><p>a <b>b</b></p></field>
  </record>
  <record id="empty" model="unit"/>
  <record id="other.km" model="unit"><field name="active" eval="None"/></record>
  <template id="t1"><h1>Hi</h1></template>
</data>
"""


def test_read_records(spark, tmp_path):
    (tmp_path / "p.xml").write_text(XML)
    got = rows(X.read_records(spark, str(tmp_path / "p.xml"), "uom"))
    assert got == [
        ("other", "km", "unit", None, "active", "None", "eval"),
        ("uom", "cm", "unit", False, "body", "<p>a <b>b</b></p>", "markup"),
        ("uom", "cm", "unit", False, "factor", "0.0", "eval"),
        ("uom", "cm", "unit", False, "name", "Centi & metre", "text"),
        ("uom", "cm", "unit", False, "parent", "base.mm", "ref"),
    ]
    assert rows(X.read_templates(spark, str(tmp_path / "p.xml"), "uom")) == [
        ("uom", "t1", "template", None, "arch", "<h1>Hi</h1>", "markup")]


def test_large_patch_files_are_read_in_splits(spark, tmp_path):
    parts = []
    for i in range(600):
        record = f'<record id="r{i}" model="m"><field name="n" eval="{i}"/><field name="s">text {i}</field></record>'
        if i % 100 == 50:
            record = "<!-- " + record
        if i % 100 == 60:
            record = record + " -->"
        parts.append(record)
    (tmp_path / "big.xml").write_text("<data>\n" + "\n".join(parts) + "\n</data>\n")
    kept = [i for i in range(600) if not 50 <= i % 100 <= 60]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
        df = X.read_records(spark, str(tmp_path / "big.xml"), "mod")
        assert sorted(int(r.value) for r in df.where("field = 'n'").collect()) == kept
        assert df.count() == 2 * len(kept)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_transform_patch(frame):
    patch = frame([("a", True, "x", "1"), ("a", True, "y", "2"), ("b", True, "x", "3"), ("c", True, "z", "4")],
                  "record_id string, forcecreate boolean, field string, value string")
    out = R.transform_patch(
        patch, drop_records=frame([("b",)], "record_id string"), drop_fields=frame([("a", "x")], "record_id string, field string"),
        drop_everywhere=["z"], set_attributes=frame([("a", False)], "record_id string, forcecreate boolean"),
    )
    assert rows(out) == [("a", False, "y", "2")]


def test_upsert_sets_only_listed_fields_and_null_overwrites(frame):
    target = frame([("a", 1, "x"), ("b", 2, "y"), ("p", 3, "z")], "id string, n int, s string")
    patch = frame(
        [("a", True, "s", None), ("new", True, "n", "7"), ("lazy", False, "n", "8"), ("p", True, "n", "0")],
        "id string, forcecreate boolean, field string, value string",
    )
    auto = R.upsert_records(target, patch, "id", protected=F.col("id") == "p")
    assert rows(auto) == [("a", 1, None), ("b", 2, "y"), ("new", 7, None), ("p", 3, "z")]
    assert [r[0] for r in rows(R.upsert_records(target, patch, "id", create="always"))] == ["a", "b", "lazy", "new", "p"]
    assert [r[0] for r in rows(R.upsert_records(target, patch, "id", create="never"))] == ["a", "b", "p"]
    assert rows(R.upsert_records(auto, patch, "id", protected=F.col("id") == "p")) == rows(auto)


def test_later_listing_of_a_field_wins_by_position(frame):
    target = frame([("a", 1)], "id string, n int")
    patch = frame([("a", "n", "9", 1), ("a", "n", "3", 2), ("b", "n", "4", 1), ("b", "n", None, 2)], "id string, field string, value string, at int")
    assert rows(R.upsert_records(target, patch, "id", position="at")) == [("a", 3), ("b", None)]


def test_patch_literals(frame):
    patch = frame(
        [("m", "r1", "f", "ref('b.x', raise_if_not_found=False)", "eval"), ("m", "r2", "f", "x", "ref"), ("m", "r3", "f", "None", "eval"),
         ("m", "r4", "f", "False", "eval"), ("m", "r4", "flag", "False", "eval"), ("m", "r5", "f", "'a\\nb'", "eval"),
         ("m", "r6", "f", "1.5", "eval"), ("m", "r7", "f", "False", "text"), ("m", "r8", "f", "[(4, ref('x')), (4, ref('b.x'))]", "eval"),
         ("m", "r9", "f", "[Command.set([])]", "eval"), ("m", "r9", "g", "[(6, 0, [ref('x')])]", "eval")],
        "module string, record_id string, field string, value string, kind string",
    )
    ids = frame([("b", "x", 7), ("m", "x", 8)], "module string, name string, res_id long")
    got = {(r.record_id, r.field): r.value for r in R.resolve_values(patch, ids, booleans=["flag"]).collect()}
    assert got == {("r1", "f"): "7", ("r2", "f"): "8", ("r3", "f"): None, ("r4", "f"): None, ("r4", "flag"): "false",
                   ("r5", "f"): "a\nb", ("r6", "f"): "1.5", ("r7", "f"): "False"}
    assert rows(R.member_commands(patch).select("record_id", "field", "command", "member")) == [
        ("r8", "f", "add", "b.x"), ("r8", "f", "add", "m.x"), ("r9", "f", "replace", None), ("r9", "g", "replace", "m.x")]


def test_file_fields_are_their_own_kind(frame):
    xml = '<record id="p" model="m"><field name="image" type="base64" file="static/a.png"/><field name="n">x</field></record>'
    got = X.parse_records(frame([(xml,)], "xml string"), "xml", F.lit("m"))
    assert rows(got.select("field", "value", "kind")) == [("image", "static/a.png", "file"), ("n", "x", "text")]


def test_texts_around_references_and_files(frame):
    patch = frame([
        ("m", "r1", "f", "str([('a', 'in', [ref('x'), ref('b.y')])])", "eval"), ("m", "r2", "f", "str([ref('gone')])", "eval"),
        ("m", "r3", "f", "str(1)", "eval"), ("m", "r4", "f", "static/a.png", "file"), ("m", "r5", "f", "static/none.png", "file"),
    ], "module string, record_id string, field string, value string, kind string")
    ids = frame([("m", "x", 7), ("b", "y", 8)], "module string, name string, res_id long")
    files = frame([("static/a.png", "AAAA")], "path string, content string")
    got = {r.record_id: r.value for r in R.resolve_values(patch, ids, files=files).collect()}
    assert got == {"r1": "[('a', 'in', [7, 8])]", "r2": None, "r3": "1", "r4": "AAAA"}
    assert "r4" not in {r.record_id for r in R.resolve_values(patch, ids).collect()}


def test_member_commands_are_told_apart(frame):
    def commands(value):
        patch = frame([("m", "r", "f", value, "eval")], "module string, record_id string, field string, value string, kind string")
        return rows(R.member_commands(patch).select("command", "member"))

    assert commands("[(3, ref('x')), (4, ref('b.y'))]") == [("add", "b.y"), ("remove", "m.x")]
    assert commands("[(5,), (4, ref('y'))]") == [("replace", "m.y")]
    assert commands("[Command.unlink(ref('x'))]") == [("remove", "m.x")]
    with pytest.raises(Exception, match="unknown member command 0"):
        commands("[(0, 0, {'a': 1})]")
    pairs = frame([(1, 10), (1, 11)], "l int, r int")
    assert rows(R.apply_member_commands(pairs, frame([(1, "remove", 10)], "l int, command string, r int"), "l", "r")) == [(1, 11)]


def test_a_small_patch_does_not_shuffle_the_target(spark, frame, tmp_path):
    target = spark.range(0, 100_000, 1, 4).select(F.col("id"), (F.col("id") % 7).cast("string").alias("v"))
    frame([(5, "v", "new"), (-1, "v", "added")], "id long, field string, value string").write.parquet(str(tmp_path / "patch"))
    patch = spark.read.parquet(str(tmp_path / "patch"))
    for create in ("auto", "always"):
        out = R.upsert_records(target, patch, "id", create=create)
        assert out.count() == 100_001
        df = out.where("v IN ('new', 'added')")
        assert rows(df) == [(-1, "added"), (5, "new")]
        plan = df._jdf.queryExecution().executedPlan().toString()
        # Only the few keys of the patch meet in a shuffle.
        assert "SortMergeJoin [id" not in plan and "FullOuter" not in plan and "BroadcastHashJoin [id" in plan


def test_a_field_listed_twice_needs_an_order(frame):
    target = frame([(1, "a")], "id int, v string")
    patch = frame([(1, "v", "z", 1), (1, "v", "b", 2)], "id int, field string, value string, at int")
    with pytest.raises(Exception, match="listed twice"):
        R.upsert_records(target, patch, "id").collect()
    assert rows(R.upsert_records(target, patch, "id", position="at")) == [(1, "b")]


def test_member_commands(frame):
    pairs = frame([(1, 10), (1, 11), (2, 10), (3, 10)], "l int, r int")
    patch = frame([(1, "add", 12), (1, "add", 10), (2, "replace", 20), (3, "replace", None)], "l int, command string, r int")
    assert rows(R.apply_member_commands(pairs, patch, "l", "r")) == [(1, 10), (1, 11), (1, 12), (2, 20)]


IDENTITY = "module string, name string, model string, res_id long, noupdate boolean"


def test_rename_and_merge_ids(frame):
    ids = frame([("a", "x", "m", 1, True), ("a", "y", "m", 2, True), ("b", "z", "m", 3, False)], IDENTITY)
    renames = frame([("a", "x", "b", "z"), ("a", "y", "b", "y2")], "old_module string, old_name string, new_module string, new_name string")
    assert [(r[0], r[1]) for r in rows(K.rename_ids(ids, renames))] == [("b", "y2"), ("b", "z"), ("b", "z")]
    merged, id_map = K.merge_ids(ids, renames)
    assert [r[:4] for r in rows(merged)] == [("b", "y2", "m", 2), ("b", "z", "m", 3)]
    assert rows(id_map) == [("m", 1, 3)]
    assert rows(K.repoint(frame([(9, 1), (8, 2)], "id long, ref long"), "ref", id_map)) == [(8, 2), (9, 3)]


def test_lookup_and_protect(frame):
    ids = frame([("a", "x", "m", 1, True), ("a", "y", "m", 2, True)], IDENTITY)
    asked = frame([("a.x",), ("a.none",), (None,)], "ref string")
    assert rows(K.lookup_id(asked, "ref", ids, "id")) == [("a.none", None), ("a.x", 1), (None, None)]
    try:
        K.lookup_id(asked, "ref", ids, "id", missing="raise").collect()
    except Exception as failure:
        assert "unknown record a.none" in str(failure)
    else:
        raise AssertionError("a missing name must stop the run")
    out = K.set_noupdate(ids, frame([("a", "y")], "module string, name string"), False)
    assert [(r.name, r.noupdate) for r in out.orderBy("name").collect()] == [("x", True), ("y", False)]


def test_safe_delete_keeps_what_is_used(frame):
    recs = frame([(1,), (2,), (3,)], "id long")
    used = frame([(2,), (2,), (None,)], "ref long")
    kept, blocked = K.delete_records_safely(recs, "id", recs.where("id < 3"), [(used, "ref"), (used, "ref")])
    assert rows(kept) == [(2,), (3,)] and rows(blocked) == [(2,)]
    kept, blocked = K.delete_records_safely(recs, "id", recs, [])
    assert kept.count() == 0 and blocked.count() == 0


def test_generic_references_of_a_merged_model(frame):
    refs = frame([(1, "candidate", 5), (2, "candidate", 6), (3, "other", 5)], "id long, model string, res_id long")
    out = K.merge_models(refs, "model", "res_id", "candidate", "applicant", frame([(5, 50)], "old_id long, new_id long"))
    assert rows(out) == [(1, "applicant", 50), (2, "candidate", 6), (3, "other", 5)]


def test_auto_install_one_round(frame):
    mods = frame([("base", "installed", False), ("a", "uninstalled", True), ("b", "uninstalled", True), ("free", "uninstalled", True),
                  ("test_x", "uninstalled", True), ("c", "uninstalled", False)], "name string, state string, auto boolean")
    deps = frame([("a", "base"), ("b", "base"), ("b", "a"), ("c", "base"), ("test_x", "base")], "module string, depends_on string")
    out = K.propagate_auto_install(mods, deps, "name", "state", "auto", ["installed"], "test_")
    assert [r[0] for r in rows(out.where("state = 'to install'"))] == ["a", "free"]


def test_site_copies_follow_upstream(frame):
    copies = frame([(1, "k", "a  b"), (2, "k", "changed"), (3, "gone", "a b")], "id int, key string, text string")
    marked = K.mark_unmodified(copies, frame([("k", "a b")], "key string, text string"), ("key", "key"), "text", "same")
    assert [r.same for r in marked.orderBy("id").collect()] == [True, False, False]
    out = K.follow_upstream(marked, frame([("k", "new")], "key string, text string"), ("key", "key"), "text", "same")
    assert [r.text for r in out.orderBy("id").collect()] == ["new", "changed", "a b"]


def test_translations_filters_templates(frame):
    df = frame([(1, {"en_US": "a", "fr_FR": "b"}), (2, {"fr_FR": "c"})], "id long, t map<string,string>")
    out = K.drop_translations(df, "id", frame([(1,)], "id long"), ["t"])
    assert [r.t for r in out.orderBy("id").collect()] == [{"en_US": "a"}, {"fr_FR": "c"}]
    filters = frame([(1, "[('ok','=',1)]", "m", True), (2, "[('ok','=',1),('bad','=',1)]", "m", True), (3, "[]", "m", True)],
                    "id long, domain string, model string, active boolean")
    fields = frame([("m", "ok")], "model string, name string")
    fixed = K.disable_invalid_filters(filters, "id", "domain", "model", r"\('(\w+)'", fields, "active")
    assert [r.active for r in fixed.orderBy("id").collect()] == [True, False, True]
    companies = frame([(1, "es", None, 5), (2, "es", 7, None), (3, "xx", None, None), (4, None, None, None)],
                      "id int, template string, income int, expense int")
    filled, unknown = K.fill_from_template(companies, "template", frame([("es", 1, 2)], "template string, income int, expense int"), ["income", "expense"])
    assert [tuple(r)[2:] for r in filled.orderBy("id").collect()] == [(1, 5), (7, 2), (None, None), (None, None)]
    assert rows(unknown) == [("xx", 1)]


REPORT = """---Models in module 'garden'---
obsolete model garden.plot
obsolete model seed.lot (renamed to seed.batch)
model rain.entry (moved to weather) [transient]
---Fields in module 'garden'---
garden       / garden.plot             / label (char)                   : DEL required

# nothing to be done

garden       / garden.bed                  / _order                        : _order is now 'depth' ('label')
garden       / garden.bed                  / depth (float)              : not stored anymore
garden       / garden.bed                  / row_count (integer)            : NEW

# DONE: kept in a legacy column

---XML records in module 'garden'---
NEW measure: garden.ph [renamed from soil module] (noupdate)
constraint: garden.c7 (changed definition: is now 'a' ('b'))
DEL gate.rule: garden.r9
"""


def test_schema_diff_and_annotations(spark, tmp_path):
    (tmp_path / "w.txt").write_text(REPORT)
    got = [tuple(r)[1:] for r in P.read_schema_diff(spark, str(tmp_path / "w.txt")).collect()]
    assert sorted(got, key=repr) == sorted([
        ("garden", "Models", "garden.plot", None, None, "obsolete", None),
        ("garden", "Models", "seed.lot", None, None, "obsolete", "renamed to seed.batch"),
        ("garden", "Models", "rain.entry", None, None, "changed", "moved to weather; transient"),
        ("garden", "Fields", "garden.plot", "label", "char", "DEL", "required"),
        ("garden", "Fields", "garden.bed", "_order", None, "changed", "_order is now 'depth' ('label')"),
        ("garden", "Fields", "garden.bed", "depth", "float", "changed", "not stored anymore"),
        ("garden", "Fields", "garden.bed", "row_count", "integer", "NEW", None),
        ("garden", "XML records", "measure", "garden.ph", None, "NEW", "renamed from soil module; noupdate"),
        ("garden", "XML records", "constraint", "garden.c7", None, "changed", "changed definition: is now 'a' ('b')"),
        ("garden", "XML records", "gate.rule", "garden.r9", None, "DEL", None),
    ], key=repr)
    notes = {r.text.split(":")[0].strip(): r.note for r in P.read_annotations(spark, str(tmp_path / "w.txt")).collect()}
    by_line = {" ".join(k.split()): v for k, v in notes.items()}
    assert by_line["garden / garden.plot / label (char)"] == "nothing to be done"
    assert by_line["garden / garden.bed / row_count (integer)"] == "DONE: kept in a legacy column"
    assert by_line["DEL gate.rule"] is None


def test_lines_of_split_files_keep_their_order(spark, tmp_path):
    lines = [f"{i:06d} " + "x" * 50 for i in range(4000)]
    (tmp_path / "big.txt").write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        df = P.read_lines(spark, str(tmp_path / "big.txt"))
        assert df.rdd.getNumPartitions() > 3
        assert [r.text for r in df.orderBy("file", "at").collect()] == lines
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_status_grid(spark, tmp_path):
    (tmp_path / "g.rst").write_text(
        "+-----+----+----+\n| Module | Status + Extra |\n+=====+====+====+\n| ledger |Done | |\n+-----+\n"
        "| |del| ledger_x | |Merged into ledger. |\n| |new| ledger_y | | |\n")
    assert rows(P.read_status_grid(spark, str(tmp_path / "g.rst"))) == [
        ("ledger", None, "Done", None), ("ledger_x", "del", None, "Merged into ledger."), ("ledger_y", "new", None, None)]


def test_records_go_in_the_order_of_their_references(spark, frame):
    # 1 <- 2 <- 3 (all doomed), 4 <- 5 (5 stays), 6 <-> 7 in a circle, 8 refers to itself.
    recs = frame([(1, None), (2, 1), (3, 2), (4, None), (5, 4), (6, 7), (7, 6), (8, 8), (9, 6)], "id int, up int")
    doomed = recs.where("id not in (5, 99)")
    kept, blocked = K.delete_records_safely(recs, "id", doomed, [(recs, "up", "id")])
    assert [r.id for r in kept.orderBy("id").collect()] == [4, 5, 6, 7] and [r.id for r in blocked.orderBy("id").collect()] == [4, 6, 7]
    other = frame([(3,), (None,)], "ref int")
    kept, blocked = K.delete_records_safely(recs, "id", doomed, [(recs, "up", "id"), (other, "ref")])
    assert [r.id for r in blocked.orderBy("id").collect()] == [1, 2, 3, 4, 6, 7]


@pytest.mark.parametrize("seed", range(4))
def test_peeling_agrees_with_deleting_one_by_one(spark, frame, seed):
    rng = random.Random(seed)
    a = [(i, rng.choice([None, *range(12)]), rng.choice([None, *range(8)])) for i in range(12)]
    b = [(i, rng.choice([None, *range(12)])) for i in range(8)]
    log = [(rng.choice([None, *range(12)]),) for _ in range(2)]
    doomed = [("a", i) for i in range(12) if rng.random() < 0.8] + [("b", i) for i in range(8) if rng.random() < 0.8] + [("a", 77)]
    ds = Dataset({"a": frame(a, "id int, up int, b int"), "b": frame(b, "id int, a int"), "log": frame(log, "a int")})
    refs = [("a", "up", "a"), ("a", "b", "b"), ("b", "a", "a"), ("log", "a", "a")]
    out, blocked = K.delete_in_order(ds, {"a": "id", "b": "id"}, frame(doomed, "model string, id int"), refs)
    uses = [(("a", i), ("a", up)) for i, up, _ in a] + [(("a", i), ("b", x)) for i, _, x in a] + [(("b", i), ("a", x)) for i, x in b] + [(None, ("a", x)) for x, in log]
    uses = [(f, t) for f, t in uses if t[1] is not None and f != t]
    left = {d for d in doomed if d[1] != 77}
    while free := {d for d in left if not any(t == d for _, t in uses)}:
        left -= free
        uses = [(f, t) for f, t in uses if f not in free]
    gone = {d for d in doomed if d[1] != 77} - left
    assert {(r.model, int(r.id), r.uses) for r in blocked.collect()} == {(*d, sum(t == d for _, t in uses)) for d in left}
    assert {r.id for r in out["a"].collect()} == {i for i, *_ in a if ("a", i) not in gone}
    assert {r.id for r in out["b"].collect()} == {i for i, _ in b if ("b", i) not in gone}


def test_merges_of_several_lists_are_closed(frame):
    kind = "model string, old_id long, new_id long"
    lists = [frame([("m", 1, 2), ("m", 5, 5), ("n", 1, 7)], kind), frame([("m", 2, 3), ("m", 9, 3), ("m", 1, 2)], kind), frame([("m", 3, 4)], kind)]
    closed = K.closed_merges(lists)
    assert rows(closed) == [("m", 1, 4), ("m", 2, 4), ("m", 3, 4), ("m", 9, 4), ("n", 1, 7)]
    ds = K.repoint_all(Dataset({"t": frame([(1, 1), (9, 1), (None, 8)], "a long, b long")}), [("t", "a", "m"), ("t", "b", "n")], closed)
    assert rows(ds["t"]) == [(4, 7), (4, 7), (None, 8)]
    with pytest.raises(ValueError, match="several"):
        K.closed_merges([lists[0], frame([("m", 1, 6)], kind)])
    with pytest.raises(ValueError, match="cycle"):
        K.closed_merges([lists[0], lists[1], frame([("m", 3, 1)], kind)])
