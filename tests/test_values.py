import datetime as dt

import pytest
from pyspark.sql import functions as F

from evolve.functions import documents as D
from evolve.functions import predicates as P
from evolve.functions import text as X
from evolve.functions import values as V
from tests.conftest import rows


def test_map_values_keeps_unmapped_and_stores_null(frame):
    df = frame([("a", "x"), ("b", "x"), ("c", "x"), (None, "x")], "src string, dst string")
    out = V.map_values(df, "src", "dst", [("a", "A"), ("b", False)])
    assert rows(out) == [("a", "A"), ("b", None), ("c", "x"), (None, "x")]
    assert rows(V.map_values(df, "src", "dst", [("a", "A"), (None, "N")], default=None)) == [
        ("a", "A"), ("b", None), ("c", None), (None, "N")]


def test_long_maps_use_a_lookup_with_the_same_result(frame):
    pairs = [(f"k{i}", f"v{i}") for i in range(100)] + [("gone", None)]
    df = frame([("k5", "x"), ("gone", "x"), ("other", "x"), (None, "x")], "src string, dst string")
    out = V.map_values(df, "src", "dst", pairs)
    assert rows(out) == [("gone", None), ("k5", "v5"), ("other", "x"), (None, "x")]
    assert out.columns == ["src", "dst"]
    again = V.map_values(df, "src", "src", [("k5", "first"), *pairs, (None, "was null")], default="other")
    assert sorted(r.src for r in again.collect() if r.src) == ["first", "other", "was null"]


@pytest.mark.parametrize("length", [32, 33, 1000])
def test_maps_of_any_length_behave_alike(frame, length):
    def mapped(pairs, schema="src int, dst int", **more):
        pad = [(10_000 + i, pairs[0][1]) for i in range(length - len(pairs))]
        return V.map_values(frame([(1, 7), (2, 7), (None, 7)], schema), "src", "dst", [*pairs, *pad], **more)

    def got(df):
        return rows(df), df.schema["dst"].dataType.simpleString()

    assert got(mapped([("1", 5), ("x", 6)])) == ([(1, 5), (2, 7), (None, 7)], "int")
    assert got(mapped([(1.0, 5), (1.5, 6), (2.0, 8)])) == ([(1, 5), (2, 8), (None, 7)], "int")
    assert got(mapped([(1, 5), (2, 0.5)])) == ([(1, 5.0), (2, 0.5), (None, 7.0)], "double")
    assert got(mapped([(1, None), (2, False)])) == ([(1, None), (2, None), (None, 7)], "int")
    assert got(mapped([(None, 3), (1, 4)])) == ([(1, 4), (2, 7), (None, 3)], "int")
    assert got(mapped([("1", 3), (1, 4)])) == ([(1, 3), (2, 7), (None, 7)], "int")
    assert got(mapped([(1, 4)], default=9)) == ([(1, 4), (2, 9), (None, 9)], "int")


def test_map_in_place_does_not_chain(frame):
    df = frame([("a",), ("b",)], "c string")
    assert rows(V.map_in_place(df, "c", [("a", "b"), ("b", "c")])) == [("b",), ("c",)]


def test_map_and_inverse_map_round_trip(frame):
    df = frame([("a",), ("b",), (None,)], "c string")
    there = V.map_in_place(df, "c", [("a", "x"), ("b", "y")])
    assert rows(V.map_in_place(there, "c", [("x", "a"), ("y", "b")])) == rows(df)


def test_clamp_leaves_null_alone(frame):
    df = frame([(1,), (9,), (None,)], "c int")
    assert rows(V.clamp_to_domain(df, "c", [1, 2], default=0)) == [(0,), (1,), (None,)]


def test_set_where_unknown_predicate_changes_nothing(frame):
    df = frame([(1, "a"), (None, "b")], "n int, s string")
    assert rows(V.set_where(df, {"s": "z"}, F.col("n") > 0)) == [(1, "z"), (None, "b")]


def test_fill_null_and_blank(frame):
    df = frame([("a",), ("  ",), (None,)], "s string")
    assert rows(V.fill_null(df, "s", "f")) == [("  ",), ("a",), ("f",)]
    assert rows(V.fill_null(df, "s", "f", also_empty=True)) == [("a",), ("f",), ("f",)]


def test_invert_flag_takes_null_for_false(frame):
    df = frame([(True,), (False,), (None,)], "b boolean")
    assert rows(V.invert_flag(df, "b")) == [(False,), (True,), (True,)]


def test_split_sign_reads_direction_before_the_value_changes(frame):
    df = frame([(-3.0,), (2.0,), (0.0,), (None,)], "n double")
    assert rows(V.split_sign(df, "n", "side", "neg", "pos")) == [
        (0.0, "pos"), (2.0, "pos"), (3.0, "neg"), (None, None)]


def test_add_interval_defaults_zero_and_null(frame):
    t = dt.datetime(2024, 1, 1)
    df = frame([(t, 2.5), (t, 0.0), (t, None)], "ts timestamp_ntz, h double")
    got = [r.due for r in V.add_interval(df, "ts", "h", "hour", "due", default=1).collect()]
    assert got == [t + dt.timedelta(hours=2.5), t + dt.timedelta(hours=1), t + dt.timedelta(hours=1)]


def test_local_date_at_the_day_edge_in_any_session_zone(spark, frame):
    df = frame([(dt.datetime(2024, 7, 1, 23, 30), "Europe/Madrid"), (dt.datetime(2024, 7, 1, 23, 30), None)], "ts timestamp_ntz, z string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [r.d for r in V.local_date(df, "ts", "z", "d").collect()]
            assert got == [dt.date(2024, 7, 2), dt.date(2024, 7, 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_ratio_or_inverse_of_zero_is_null(frame):
    df = frame([("bigger", 4.0), ("smaller", 4.0), ("smaller", 0.0)], "t string, f double")
    assert [r.r for r in V.ratio_or_inverse(df, "t", "f", ["bigger"], "r").collect()] == [4.0, 0.25, None]


def test_set_if_default_and_agree_and_false(frame):
    df = frame([("a", 1), ("a", 2), (None, 1)], "s string, n int")
    assert rows(V.set_if_default(df, {"s": "a", "n": 1}, {"s": "b"})) == [("a", 2), ("b", 1), (None, 1)]
    two = frame([(1, 1), (1, 2), (None, 1)], "a int, b int")
    assert [r.c for r in V.agree_or_null(two, "a", "b", "c").collect()] == [1, None, None]
    flags = frame([(True,), (False,), (None,)], "b boolean")
    assert [r.b for r in V.normalise_false(flags, "b").collect()] == ["true", None, None]


def test_append_text_forms(frame):
    df = frame([("a", "b"), ("a", "a"), ("a", ""), ("", "b"), (None, "b"), ("a", None)], "d string, s string")
    assert [r.d for r in X.append_text(df, "d", "s", " / ").collect()] == ["a / b", "a", "a", "b", "b", "a"]
    assert X.append_text(df, "d", "s", "/", skip_equal=False).collect()[1].d == "a/a"


def test_compose_regex_expected_patterns(frame):
    df = frame(
        [("contains", "hello world"), ("not_contains", "hello world"), ("match_regex", "hello world"), ("contains", None)],
        "mode string, param string",
    )
    got = df.select(X.compose_regex(F.col("mode"), F.col("param"), [F.lit("hello"), F.lit("world")]).alias("r")).collect()
    assert [r.r for r in got] == [
        r"(?=.*hello\ world.*)(hello)|(world)", r"(?!hello\ world)(hello)|(world)", "(?=hello world)(hello)|(world)", "(hello)|(world)"]


def test_escaped_literal_matches_itself(frame):
    odd = r"a.b*c [d] (e) {f} ^g$ |h\i +j? #k &l ~m -n"
    df = frame([(odd,)], "s string").select("s", X.escape_literal(F.col("s")).alias("p"))
    assert df.where(F.expr("s rlike concat('^', p, '$')")).count() == 1


def test_html_both_ways(frame):
    df = frame([("a < b & c\nd",)], "s string").select(X.text_to_html(F.col("s")).alias("h"))
    assert df.first().h == "<p>a &lt; b &amp; c<br/>d</p>"
    assert df.select(X.html_to_text(F.col("h")).alias("t")).first().t == "a < b & c\nd"
    marks = frame([("<p><br/></p>",), ("<p> x</p>",), ("<img src='a'/>",), (None,)], "h string")
    assert [r.e for r in marks.select(X.is_html_empty(F.col("h")).alias("e")).collect()] == [True, False, False, True]


def test_csv_set_and_suffix_and_template(frame):
    df = frame([("b,a",), (None,), ("",)], "s string")
    assert [r.s for r in X.merge_csv_set(df, "s", ["c", "a"]).collect()] == ["a,b,c", None, "a,c"]
    names = frame([("x_vat",), ("x_vat_y",)], "s string")
    assert [r.s for r in X.replace_in_text(names, "s", "vat", "tax", "_vat").collect()] == ["x_tax", "x_vat_y"]
    parts = frame([("m", "p"), ("m", None)], "a string, b string")
    assert [r.n for r in X.name_from_template(parts, "n", "%s (%s)", ["a", "b"]).collect()] == ["m (p)", None]


def test_merge_maps_right_wins_and_null_left_is_empty(frame):
    df = frame([('{"a":"1","b":"2"}', '{"b":"9","c":"3"}'), (None, '{"x":"1"}'), ('{"x":"1"}', None)], "a string, b string")
    got = [r.m for r in D.merge_json(df, "m", F.col("a"), F.col("b")).collect()]
    assert got == ['{"a":"1","b":"9","c":"3"}', '{"x":"1"}', '{"x":"1"}']


def test_company_values_change_in_one_pass(frame):
    df = frame([({"1": "manual", "2": "auto"},)], "m map<string,string>")
    assert df.select(D.json_set_where(F.col("m"), "manual", "periodic").alias("m")).first().m == {"1": "periodic", "2": "auto"}


def test_applicant_properties_merge(frame):
    a = frame([({"a": "1"}, {"b": "2"}), (None, {"b": "2"})], "a map<string,string>, c map<string,string>")
    assert [r.m for r in a.select(D.merge_maps(F.col("a"), F.col("c")).alias("m")).collect()] == [{"a": "1", "b": "2"}, {"b": "2"}]
    kind = "array<struct<name:string,type:string>>"
    d = frame([([("x", "char")], [("y", "char"), ("x", "char")]), (None, [("y", "char")])], f"a {kind}, b {kind}")
    assert [len(r.c) for r in d.select(D.concat_arrays(F.col("a"), F.col("b")).alias("c")).collect()] == [3, 1]


def test_language_fallback(frame):
    texts = D.language_map({"en_US": "Optional", "fr_FR": "Optionnel"})
    df = frame([("fr_FR",), ("de_DE",), (None,)], "lang string")
    assert [r.t for r in df.select(D.in_language(texts, F.col("lang"), "en_US").alias("t")).collect()] == ["Optionnel", "Optional", "Optional"]


def test_not_in_list_drops_null_and_is_distinct_does_not(frame):
    df = frame([("a",), ("b",), (None,)], "s string")
    assert rows(df.where(P.not_in_list(F.col("s"), ["a"]))) == [("b",)]
    assert rows(df.where(P.is_distinct(F.col("s"), F.lit("a")))) == [("b",), (None,)]


def test_archived_project_types_fall_back(frame):
    df = frame([(1, True), (1, False), (2, False), (None, False)], "type int, active boolean")
    assert rows(P.active_rows(df, F.col("active"), ["type"], fallback=True)) == [(1, True), (2, False), (None, False)]
    assert rows(P.active_rows(df, F.col("active"))) == [(1, True)]
    assert P.active_rows(df.where("type = 2"), F.col("active"), fallback=True).count() == 1
