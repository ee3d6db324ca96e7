import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from evolve.operators import ordered as O
from tests.conftest import rows


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([None, 1, 1, 1, 2]), st.one_of(st.none(), st.integers(0, 5))), min_size=0, max_size=60))
def test_running_values_agree_with_a_plain_pass(spark, data):
    check_running(spark, data, False)
    check_running(spark, data, True)


def check_running(spark, data, spread):
    """Compare with one pass in Python."""
    numbered = [(g, i, v) for i, (g, v) in enumerate(data)]
    df = spark.createDataFrame(numbered, "g int, at int, v int").repartition(5)
    values = {
        "n": O.Running("count"), "total": O.Running("sum", "v"), "high": O.Running("max", "v"),
        "seen": O.Running("last", "v"), "above": O.Running("before", "v"), "lagged": O.Running("lag", "v"),
    }
    ways = [O.running(df, ["g"], ["at"], values, unique=True, spread=spread).collect(), O.running(df, ["g"], ["at"], values, spread=spread, key=["at"]).collect()]
    got, keyed = ({r.at: (r.n, r.total, r.high, r.seen, r.above, r.lagged) for r in out} for out in ways)
    assert got == keyed
    state, want = {}, {}
    for g, at, v in numbered:
        n, total, high, seen, last = state.get(g, (0, None, None, None, None))
        above = seen
        if v is not None:
            total, high, seen = (total or 0) + v, v if high is None else max(high, v), v
        state[g] = (n + 1, total, high, seen, v)
        want[at] = (n + 1, total, high, seen, above, last)
    assert got == want


@pytest.fixture(params=[False, True])
def spread(request):
    """Both ways of ordered work: by whole groups, and as for groups too large for a task."""
    return request.param


def test_a_hot_group_is_spread_and_still_numbered_right(spark):
    df = spark.range(0, 40000, 1, 8).select(F.when(F.col("id") % 3 < 2, 7).otherwise(F.col("id")).alias("k"), (F.lit(40000) - F.col("id")).alias("at"))
    out = O.number_within(df, ["k"], ["at"], "n").where("k = 7")
    assert out.agg(F.max("n"), F.countDistinct("n"), F.count("n")).first()[:] == (26667, 26667, 26667)
    wrong = out.alias("a").join(out.alias("b"), F.expr("b.n = a.n + 1")).where("b.at <= a.at")
    assert wrong.count() == 0


def test_sequence_over_is_gapless_and_repeatable_with_ties(spark):
    df = spark.range(0, 5000, 1, 8).select("id", (F.col("id") % 3).alias("d"))
    first = rows(O.sequence_over(df, ["d"], "n"))
    again = rows(O.sequence_over(df.repartition(3), ["d"], "n"))
    assert first == again
    assert sorted(r[2] for r in first) == list(range(1, 5001))
    by_number = sorted(first, key=lambda r: r[2])
    assert [r[1] for r in by_number] == sorted(r[1] for r in first)


def test_only_keys_and_order_are_stored(spark, monkeypatch, tmp_path):
    import pathlib

    df = spark.range(0, 200_000, 1, 8).select("id", F.xxhash64("id").alias("at"), (F.col("id") % 5).alias("g"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 3).alias("text"))
    df.select("g", "id", "at").write.parquet(str(tmp_path / "narrow"))
    size = lambda folder: sum(p.stat().st_size for p in pathlib.Path(folder).rglob("*.parquet"))
    made = []
    real = O.stored

    def kept(frame):
        out = real(frame)
        made.append(sum(size(f.removeprefix("file:")) if not f.endswith(".parquet") else pathlib.Path(f.removeprefix("file://")).stat().st_size for f in out.inputFiles()))
        return out

    monkeypatch.setattr(O, "stored", kept)
    out = O.sequence_over(df, [F.col("at").desc()], "n", key=["id"])
    assert out.columns == ["id", "at", "g", "text", "n"]
    wrong = out.alias("a").join(out.alias("b"), F.expr("b.n = a.n + 1")).where("b.at >= a.at")
    assert out.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first()[:] == (1, 200_000, 200_000) and wrong.isEmpty()
    by_group = O.number_within(df, ["g"], [F.col("at").desc()], "n", key=["id"])
    assert by_group.groupBy("g").agg(F.max("n").alias("n"), F.countDistinct("n").alias("m")).where("n <> 40000 or m <> 40000").isEmpty()
    assert len(made) == 2 and all(n <= 1.2 * size(tmp_path / "narrow") for n in made)


def test_the_width_of_a_sort_follows_the_input(spark, monkeypatch, tmp_path):
    spark.range(100_000).write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    assert O._width(df) is None and O._width(spark.createDataFrame([(1,)], "a int")) is None
    monkeypatch.setattr(O, "TASK_BYTES", 20_000)
    assert O._width(df) >= 10
    out = O.sequence_over(df, [F.col("id").desc()], "n", key=["id"])
    assert out.where("id + n <> 100000").isEmpty() and out.count() == 100_000


def test_null_parts_of_a_key_are_numbered(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, None, "b"), (None, 2, "c")], "k int, l int, t string")
    out = O.sequence_over(df, [F.col("t").desc()], "n", key=["k", "l"])
    assert rows(out.select("t", "n")) == [("a", 3), ("b", 2), ("c", 1)]


def test_untyped_nulls_and_maps_can_be_numbered(spark):
    df = spark.range(3).select("id", F.lit(None).alias("nothing"), F.create_map(F.lit("k"), F.col("id")).alias("m"))
    out = O.sequence_over(df, [F.col("id").desc()], "n")
    assert [tuple(r) for r in out.orderBy("n").collect()] == [(2, None, {"k": 2}, 1), (1, None, {"k": 1}, 2), (0, None, {"k": 0}, 3)]


def test_empty_input(spark, spread):
    df = spark.createDataFrame([], "g int, at int, v int")
    assert O.number_within(df, ["g"], ["at"], "n", spread).count() == 0
    assert O.sequence_over(df, ["at"], "n").count() == 0
    assert O.first_per_key(df, ["g"], [F.col("at")]).count() == 0


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = O.first_per_key(df, ["k"], [F.col("id").asc()])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_group_changes_and_fill_down(frame, spread):
    df = frame([(1, 1, "a"), (1, 2, "a"), (1, 3, None), (1, 4, "b"), (2, 1, None)], "g int, at int, k string")
    assert rows(O.group_changes(df, ["g"], ["at"], "k", spread)) == [(1, 1, "a"), (1, 3, None), (1, 4, "b"), (2, 1, None)]
    assert [r[3] for r in rows(O.fill_down(df, ["g"], ["at"], "k", "f", spread))] == ["a", "a", "a", "b", None]


def test_running_ratio_counts_peers_together_and_null_lots_apart(frame, spread):
    df = frame(
        [(1, None, 1, 40.0, 2.0), (1, None, 2, 44.0, 2.0), (1, None, 2, 0.0, 1.0), (1, 5, 1, 10.0, 1.0), (2, None, 1, 5.0, 0.0)],
        "p int, lot int, t int, v double, q double",
    )
    got = rows(O.running_ratio(df, ["p", "lot"], "t", "v", "q", "r", spread=spread))
    assert got == [(1, 5, 1, 10.0), (1, None, 1, 20.0), (1, None, 2, pytest.approx(84 / 5))]


def test_aligned_arrays_are_chunked_and_lossless(spark, spread):
    df = spark.range(25).select((F.col("id") % 2).alias("k"), "id", (-F.col("id")).alias("m"))
    packed = O.collect_aligned(df, ["k"], ["id"], ["id", "m"], "items", chunk=4, spread=spread)
    assert packed.agg(F.max(F.size("items"))).first()[0] == 4
    assert rows(O.explode_aligned(packed, "items").select("k", "id", "m")) == rows(df)
    whole = O.whole_arrays(packed, ["k"], "items")
    assert [(r.k, [x.id for x in r["items"]]) for r in whole.orderBy("k").collect()] == [(k, list(range(k, 25, 2))) for k in (0, 1)]


def test_sums_of_floats_are_refused_and_decimals_do_not_depend_on_the_cut(spark):
    df = spark.range(20_000).select(F.lit(1).alias("g"), "id", (F.col("id") * 0.1 + 1e7).alias("x"))
    with pytest.raises(TypeError, match="cast first"):
        O.running(df, ["g"], ["id"], {"s": O.Running("sum", "x")})
    exact = df.withColumn("x", F.col("x").cast("decimal(20,4)"))
    sums = [{r.id: r.s for r in O.running(exact, ["g"], ["id"], {"s": O.Running("sum", "x")}, spread=s).collect()} for s in (False, True)]
    assert sums[0] == sums[1]


def test_ordered_work_starts_no_job_for_sizes(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("sizes", "")
    O.number_within(df, ["k"], ["id"], "n", spread=False)
    assert tracker.getJobIdsForGroup("sizes") == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
