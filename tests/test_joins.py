import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from evolve.operators import groups as G
from evolve.operators import joins as J
from evolve.operators.domains import filter_domain
from evolve.session import SETTINGS, tune
from tests.conftest import rows


def test_update_needs_a_rule_for_many_matches(frame):
    t, s = frame([(1, "x")], "id int, v string"), frame([(1, "a"), (1, "b")], "id int, v string")
    with pytest.raises(ValueError, match="pick"):
        J.update_from(t, s, ["id"], {"v": F.col("s.v")})
    assert rows(J.update_from(t, s, ["id"], {"v": F.col("s.v")}, pick=[F.col("v").desc()])) == [(1, "b")]


def test_update_leaves_unmatched_rows_and_null_keys(frame):
    t = frame([(1, "x"), (2, "y"), (None, "z")], "id int, v string")
    s = frame([(1, None), (None, "n")], "id int, w string")
    sets = {"v": F.col("s.w")}
    assert rows(J.update_from(t, s, ["id"], sets, unique=True)) == [(1, None), (2, "y"), (None, "z")]
    assert rows(J.update_from(t, s, ["id"], sets, reduced=True)) == [(1, None), (2, "y"), (None, "z")]
    assert rows(J.update_from(t, s, ["id"], sets, unique=True, null_safe=True)) == [(1, None), (2, "y"), (None, "n")]


def test_update_only_null_and_where(frame):
    t = frame([(1, None, True), (2, "y", True), (3, None, False)], "id int, v string, ok boolean")
    s = frame([(1, "a"), (2, "b"), (3, "c")], "id int, w string")
    sets = {"v": F.col("s.w")}
    assert [r[1] for r in rows(J.update_from(t, s, ["id"], sets, unique=True, only_null=True))] == ["a", "y", "c"]
    assert [r[1] for r in rows(J.update_from(t, s, ["id"], sets, unique=True, where=F.col("t.ok")))] == ["a", "b", None]


def test_update_twice_changes_nothing_more(frame):
    t = frame([(1, None), (2, "y")], "id int, v string")
    s = frame([(1, "a"), (2, "b")], "id int, w string")

    def once(df):
        return J.update_from(df, s, ["id"], {"v": F.col("s.w")}, unique=True, only_null=True)

    assert rows(once(once(t))) == rows(once(t))


def test_hot_keys_are_split_when_the_source_was_reduced(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    old = {k: spark.conf.get(k, None) for k in (*settings, *SETTINGS)}
    try:
        for k, v in settings.items():
            tune(spark).conf.set(k, v)
        n = 300000
        t = spark.range(0, n, 1, 8).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
        s = spark.range(0, n, 1, 8).select((F.col("id") % 5000).alias("k"), F.col("id").alias("v"))
        for df in (
            J.update_from(t, s, ["k"], {"v": F.col("s.v")}, pick=[F.col("v").desc()]),
            J.keep_related(t, s, ["k"]), J.drop_related(t, s, ["k"]), G.with_group_max(t, ["k"], "id", "top"),
        ):
            df.collect()
            assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
        # A chain of updates on one key is split at every join.
        chain = J.update_from(t, s, ["k"], {"v": F.col("s.v")}, pick=[F.col("v").desc()])
        chain = J.update_from(chain, s, ["k"], {"w": F.col("s.v")}, pick=[F.col("v").asc()])
        chain.collect()
        final = chain._jdf.queryExecution().executedPlan().toString().split("== Initial")[0]
        assert final.count("SortMergeJoin(skew=true)") == 2
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_wildcard_takes_one_match(frame):
    t = frame([(1, 10), (2, None), (3, 99)], "id int, company int")
    s = frame([(10, "a", 5), (10, "b", 7), (20, "c", 1)], "company int, name string, rank int")
    out = J.update_wildcard(t, s, ("company", "company"), {"name": F.col("s.name")}, [F.col("rank").asc()])
    assert rows(out) == [(1, 10, "a"), (2, None, "c"), (3, 99, None)]


def test_anti_join_and_not_in_differ_on_null(frame):
    t = frame([(1,), (2,), (None,)], "id int")
    with_null, plain, none = frame([(1,), (None,)], "k int"), frame([(1,)], "k int"), frame([], "k int")
    assert rows(J.drop_related(t, with_null, [("id", "k")])) == [(2,), (None,)]
    assert rows(J.not_in(t, with_null, "id", "k")) == []
    assert rows(J.not_in(t, plain, "id", "k")) == [(2,)]
    assert rows(J.not_in(t, none, "id", "k")) == [(1,), (2,), (None,)]


def test_semi_join_and_flag(frame):
    t, s = frame([(1,), (2,), (None,)], "id int"), frame([(1,), (1,), (None,)], "k int")
    assert rows(J.keep_related(t, s, [("id", "k")])) == [(1,)]
    assert rows(J.flag_related(t, s, [("id", "k")], "hit")) == [(1, True), (2, False), (None, False)]


def test_attendance_zone_is_the_first_that_is_known(frame):
    t = frame([(1, 1), (2, 2), (3, 3)], "id int, resource int")
    a, b = frame([(1, "Europe/Madrid"), (2, None)], "id int, tz string"), frame([(2, "Asia/Tokyo")], "id int, tz string")
    out = J.fallback_chain(t, "tz", [(a, [("resource", "id")], "tz"), (b, [("resource", "id")], "tz")], "UTC")
    assert [r[2] for r in rows(out)] == ["Europe/Madrid", "Asia/Tokyo", "UTC"]


def test_default_account_falls_back_to_the_global_one(frame):
    t = frame([(1, "p"), (2, "p"), (3, "q")], "company int, field string")
    d = frame([("p", 1, "100"), ("p", None, "999")], "key string, owner int, value string")
    assert [r[2] for r in rows(J.resolve_default(t, d, "field", "company", "v"))] == ["100", "999", None]


def test_filter_domain_joins_a_path_once(spark, frame):
    ds = {
        "line": frame([(1, 10, 5), (2, 20, 5), (3, None, 5)], "id int, company_id int, n int"),
        "company": frame([(10, True, "a"), (20, False, "a")], "id int, storno boolean, name string"),
    }
    refs = {("line", "company"): ("company_id", "company", "id")}
    out = filter_domain(ds, "line", [("company.storno", "=", True), ("company.name", "=", "a"), ("n", ">", 1)], refs)
    assert rows(out) == [(1, 10, 5)]
    assert rows(filter_domain(ds, "line", [("company_id", "=", False)], refs)) == [(3, None, 5)]
    assert rows(filter_domain(ds, "line", [("id", "not in", [1])], refs)) == [(2, 20, 5), (3, None, 5)]


def test_fan_out_and_package_use(frame):
    t = frame([(1, "reusable"), (1, "reusable"), (2, "reusable"), (2, None), (3, "disposable"), (None, "reusable")], "type int, use string")
    assert rows(G.all_equal(t, ["type"], "use", "reusable", "ok")) == [(1, True), (2, False), (3, False), (None, True)]


def test_most_frequent_counts_null_as_a_value(frame):
    t = frame([(1, None), (1, None), (1, "a"), (2, "b"), (2, "a")], "k int, v string")
    assert rows(G.most_frequent(t, ["k"], "v", "v")) == [(1, None), (2, "a")]


def test_latest_row_takes_unknown_dates_first(frame):
    t = frame([(1, 1, 10), (1, 2, None), (2, 3, 5), (2, 4, 5)], "k int, id int, at int")
    assert rows(G.latest_per_group(t, ["k"], "at", ["id"])) == [(1, 2, None), (2, 4, 5)]


def test_ratio_of_sums_leaves_out_zero(frame):
    t = frame([(1, 3.0, 2.0), (1, 1.0, 2.0), (2, 1.0, 0.0)], "k int, a double, b double")
    assert rows(G.ratio_of_sums(t, ["k"], F.col("a"), F.col("b"), "r")) == [(1, 1.0)]


def test_multiset_difference_counts_duplicates(frame):
    a, b = frame([(1,), (1,), (None,)], "x int"), frame([(1,), (None,), (2,)], "x int")
    assert rows(G.multiset_difference(a, b)) == [(1, "left", 1), (2, "right", 1)]


def test_sorted_list_is_cut_into_chunks(frame):
    t = frame([(1, "c"), (1, "a"), (1, "a"), (1, "b"), (1, None)], "k int, v string")
    assert rows(G.sorted_distinct_list(t, ["k"], "v", "l", chunk=2)) == [(1, 0, "a,b"), (1, 1, "c")]


keys = st.one_of(st.none(), st.integers(0, 3))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(keys, max_size=12), st.lists(st.tuples(keys, st.integers(0, 50)), max_size=12, unique_by=lambda p: p[1]))
def test_updates_and_filters_agree_with_brute_force(spark, left, right):
    t = spark.createDataFrame([(i, k, -1) for i, k in enumerate(left)], "id int, k int, v int")
    s = spark.createDataFrame(right, "k int, w int")
    best = {}
    for k, w in right:
        best[k] = max(w, best.get(k, w))
    sets, pick = {"v": F.col("s.w")}, [F.col("w").desc()]
    plain = {r.id: r.v for r in J.update_from(t, s, ["k"], sets, pick=pick).collect()}
    assert plain == {i: -1 if k is None else best.get(k, -1) for i, k in enumerate(left)}
    safe = {r.id: r.v for r in J.update_from(t, s, ["k"], sets, pick=pick, null_safe=True).collect()}
    assert safe == {i: best.get(k, -1) for i, k in enumerate(left)}
    has = {i for i, k in enumerate(left) if k is not None and k in best}
    assert {r.id for r in J.keep_related(t, s, ["k"]).collect()} == has
    assert {r.id for r in J.drop_related(t, s, ["k"]).collect()} == set(range(len(left))) - has
    not_in = set() if None in best else {i for i, k in enumerate(left) if (k is not None or not best) and i not in has}
    assert {r.id for r in J.not_in(t, s, "k", "k").collect()} == not_in
