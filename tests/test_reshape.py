import pytest
from pyspark.sql import functions as F

from evolve.operators import reshape as R
from evolve.operators import units as U
from tests.conftest import rows


def test_server_actions_get_one_parent_each(frame):
    actions = frame([(1, "child 1"), (2, "child 2"), (3, "child 3"), (8, "parent 1"), (9, "parent 2")], "id long, name string")
    pairs = frame([(1, 8), (2, 8), (1, 9), (2, 9), (3, 9)], "action long, server long")
    out = R.pairs_to_parent(actions, pairs, "id", "action", "server", "parent_id")
    children = lambda p: sorted(r.name for r in out.where(F.col("parent_id") == p).collect())
    assert children(8) == ["child 1", "child 2"]
    assert children(9) == ["child 1", "child 2", "child 3"]
    assert out.count() == 7 and out.select("id").distinct().count() == 7
    assert [r[:] for r in out.where("legacy__id IS NOT NULL").orderBy("id").select("id", "legacy__id").collect()] == [(10, 1), (11, 2)]


def test_clone_last_partial_reconciliation(frame):
    full = frame([(1, 500), (2, None)], "id long, exchange_move_id long")
    partial = frame([(10, 1, None), (11, 1, None), (12, 2, None)], "id long, full_id long, exchange_move_id long")
    out = R.clone_last(
        full.where("exchange_move_id IS NOT NULL"), partial, ("id", "full_id"), [F.col("id").desc()], "id",
        {"exchange_move_id": F.col("p.exchange_move_id")},
    )
    assert rows(out) == [(13, 1, 500, 11)]


LINE = "id long, order_id long, name string, sequence long, is_optional boolean, display_type string"


def test_order_options_become_lines_under_a_header(frame):
    lines = frame([(1, 1, "a", 10, False, None), (2, 1, "b", 11, False, None), (3, 2, "c", None, False, None)], LINE)
    options = frame([(1, 1, "o1", 1, None), (2, 1, "o2", None, None), (3, 1, "placed", 5, 2), (4, 2, "o3", 0, None)],
                    "option long, order_id long, name string, rank long, line_id long")
    header = {"name": F.lit("/"), "is_optional": F.lit(True), "display_type": F.lit("line_section")}
    out = R.insert_headers_and_lines(lines, options, "order_id", "id", "sequence", "option", "line_id", header, "rank")
    got = [tuple(r) for r in out.orderBy("order_id", "sequence", "id").select("order_id", "name", "sequence", "is_optional").collect()]
    assert got == [
        (1, "a", 10, False), (1, "/", 12, True), (1, "o2", 13, None), (1, "o1", 14, None), (1, "b", 18, False),
        (2, "c", None, False), (2, "/", 1, True), (2, "o3", 2, None)]
    assert out.select("id").distinct().count() == 8


def test_template_options_all_stand_after_the_header(frame):
    lines = frame([(1, 1, "a", 10, False, None)], LINE)
    options = frame([(1, 1, "some option"), (2, 1, "another option")], "option long, order_id long, name string")
    out = R.insert_headers_and_lines(
        lines, options, "order_id", "id", "sequence", "option", None, {"name": F.lit("/")}, None)
    assert [tuple(r) for r in out.orderBy("id").select("id", "name", "sequence").collect()] == [
        (1, "a", 10), (2, "/", 11), (3, "some option", 12), (4, "another option", 12)]


def test_fiscal_positions_become_pairs(frame):
    t = frame([(1, 10, 20), (2, 10, 21), (3, 10, None)], "id long, src long, dest long")
    assert rows(R.m2o_to_x2m(t, "id", "dest", ("map_id", "tax_id"))) == [(1, 20), (2, 21)]


def test_overtime_rules_copy_only_what_differs(frame):
    default = frame([(5, 30, 15)], "id long, employer int, employee int")
    companies = frame([(1, 30, 15), (2, 60, 15), (3, None, 15)], "company long, employer int, employee int")
    entities, linked = R.override_if_differs(companies, "company", ["employer", "employee"], default, "id", "rule_id")
    assert rows(entities) == [(5, None, 30, 15), (6, 2, 60, 15), (7, 3, None, 15)]
    assert [(r.company, r.rule_id) for r in linked.orderBy("company").collect()] == [(1, 5), (2, 6), (3, 7)]


def test_entities_and_children(frame):
    groups = frame([(1, "g1"), (2, "g2"), (3, "unused")], "id long, name string")
    orders = frame([(10, 1), (11, 1), (12, 2), (13, None)], "order_id long, group_id long")
    made, pointed = R.entities_from_references(orders, "group_id", groups, "id", ["name"], "production_id")
    assert rows(made.select("id", "legacy__id", "name")) == [(1, 1, "g1"), (2, 2, "g2")]
    assert [r.production_id for r in pointed.orderBy("order_id").collect()] == [1, 1, 2, None]
    jobs = frame([(1, 7), (1, 8)], "job long, skill long")
    skills, levels = frame([(7, "x"), (8, "y")], "skill long, kind string"), frame([(1, "x", 5), (2, "x", 1)], "level long, kind string, rank int")
    out = R.cross_children(jobs, skills, ("skill", "skill"), levels, "kind", "level", [F.col("rank").asc()], "level_id")
    assert sorted((r.skill, r.level_id) for r in out.collect()) == [(7, 2), (8, None)]
    kids = R.insert_missing_child(groups, frame([(1, 5)], "parent long, n int"), ("id", "parent"), {"parent": F.col("id")})
    assert rows(kids) == [(1, 5), (2, None), (3, None)]


def test_default_children(frame):
    parents, have = frame([(1,), (2,)], "id long"), frame([(1, "a", "mine")], "parent long, code string, title string")
    specs = [{"code": "a", "title": "A"}, {"code": "b", "title": "B"}]
    kept = R.ensure_children(parents, "id", have, ("parent", "code"), specs)
    assert rows(kept) == [(1, "a", "mine"), (1, "b", "B"), (2, "a", "A"), (2, "b", "B")]
    assert rows(R.ensure_children(parents, "id", kept, ("parent", "code"), specs)) == rows(kept)
    replaced = R.ensure_children(parents, "id", have, ("parent", "code"), specs, keep_existing=False)
    assert (1, "a", "A") in rows(replaced) and replaced.count() == 4


def _length_units(frame):
    return frame(
        [(1, 1, 1.0, "reference", True), (2, 1, 10.0, "smaller", False), (3, 1, 1e6, "bigger", False),
         (4, 2, 1.0, "reference", False), (5, 2, 1000.0, "smaller", False), (6, 2, 1e6 / 1e0, "bigger", False), (7, 1, 2.0, "bigger", True)],
        "id long, category_id long, factor double, uom_type string, owned boolean",
    )


def test_units_convert_through_their_reference(frame):
    units = U.flatten_units(_length_units(frame))
    assert [(r.id, r.relative_id) for r in units.orderBy("id").collect()] == [(1, None), (2, 1), (3, 1), (4, None), (5, 4), (6, 4), (7, None)]
    roots = U.unit_roots(units.fillna(1.0, ["relative_factor"]), "id", "relative_id", "relative_factor")
    asked = frame([(2, 3), (3, 2), (5, 6), (6, 5), (2, 5)], "a long, b long").withColumn("q", F.lit(1.0))
    got = {(r.a, r.b): r.out for r in U.convert_quantity(asked, "q", "a", "b", roots, "out").collect()}
    assert got[(2, 3)] == pytest.approx(1e-7) and got[(3, 2)] == pytest.approx(1e7)
    assert got[(5, 6)] == pytest.approx(1e-9) and got[(6, 5)] == pytest.approx(1e9)
    assert got[(2, 5)] is None


@pytest.mark.parametrize("at_once", [0, 100_000])
def test_roots_of_long_chains_and_cycles(spark, frame, monkeypatch, at_once):
    monkeypatch.setattr(U, "SMALL_TREES", at_once)
    chain = spark.range(1, 200).select("id", F.when(F.col("id") > 1, F.col("id") - 1).alias("up"), F.lit(1.01).alias("f"))
    out = U.unit_roots(chain, "id", "up", "f")
    assert out.select("root").distinct().collect()[0][0] == 1
    assert out.where("id = 199").first().factor == pytest.approx(1.01 ** 198)
    dangling = frame([(1, 99), (2, 1), (3, 3)], "id long, up long")
    assert rows(U.unit_roots(dangling, "id", "up").select("id", "root")) == [(1, 1), (2, 1), (3, 3)]
    with pytest.raises(ValueError, match="cycle"):
        U.unit_roots(frame([(1, 2), (2, 3), (3, 1), (4, 1)], "id long, up long"), "id", "up")
    assert U.unit_roots(frame([], "id long, up long"), "id", "up").count() == 0


def test_packs_reuse_units(frame):
    units = frame([(1, "Unit", None, 1.0), (2, "Pack of 6", 1, 6.0)], "id long, name string, relative_id long, relative_factor double")
    roots = U.unit_roots(units, "id", "relative_id", "relative_factor")
    products = frame([(1, 1), (2, 1)], "id long, unit_id long")
    tiny = frame([(1, "g", None, 1.0), (2, "ng", 1, 1e-9)], "id long, name string, relative_id long, relative_factor double")
    small = frame([(1, "p", 1, 1e-9), (2, "q", 1, 2e-9), (3, "none", 1, None)], "id long, name string, product_id long, qty double")
    got, made = U.match_or_create_unit(small, frame([(1, 1)], "id long, unit_id long"), tiny, U.unit_roots(tiny, "id", "relative_id", "relative_factor"))
    assert [r.unit_id for r in got.orderBy("id").collect()] == [2, 3, None] and made.count() == 3
    packs = frame([(1, "Sixpack", 1, 6.0), (2, "Thirteenpack", 1, 13.0), (3, "Thirteen too", 2, 13.0), (4, "no product", 9, 3.0)],
                  "id long, name string, product_id long, qty double")
    for spread in (True, False):
        matched, all_units = U.match_or_create_unit(packs, products, units, roots, spread)
        assert [r.unit_id for r in matched.orderBy("id").collect()] == [2, 3, 3, None]
    assert [tuple(r) for r in all_units.where("id > 2").collect()] == [(3, "Thirteenpack", 1, 13.0)]


def test_sizes_on_both_sides_of_a_rounding_border_match(frame):
    unit, pack = 1.0000000004999999, 1.0000000005
    units = frame([(1, "Unit", None, 1.0), (2, "odd", 1, unit), (3, "far", 1, 1.00000001), (4, "none", 1, 0.0), (5, "minus", 1, -2.0)],
                  "id long, name string, relative_id long, relative_factor double")
    roots = U.unit_roots(units, "id", "relative_id", "relative_factor")
    qty = [pack, unit, 1 + 2.0 ** -52, 0.0, -2.0 * (1 + 2.0 ** -52), 2.0, 7e20, 7e20 * (1 + 2.0 ** -51), 7e20 * (1 - 2.0 ** -51), 7.1e20, 3e-300, 3e-300 * (1 + 2.0 ** -52)]
    packs = frame([(i, f"p{i}", 1, q) for i, q in enumerate(qty)], "id long, name string, product_id long, qty double")
    for spread in (False, True):
        got, made = U.match_or_create_unit(packs, frame([(1, 1)], "id long, unit_id long"), units, roots, spread)
        assert [r.unit_id for r in got.orderBy("id").collect()] == [2, 2, 1, 4, 5, 6, 7, 7, 7, 8, 9, 9]
        assert [r.name for r in made.where("id > 5").orderBy("id").collect()] == ["p5", "p6", "p9", "p10"]
