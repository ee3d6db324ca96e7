import collections
import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from evolve.dataset import Dataset
from evolve.functions.values import map_in_place
from evolve.operators import compute as O
from evolve.operators import schemadiff as M
from evolve.operators import validate as N
from evolve.plans.committed import run_committed
from evolve.plans.plan import Plan, Step, guard_changed, guard_exists, run
from evolve.streaming.rows import apply_steps, upsert_stream
from tests.conftest import rows


def test_snapshot_diff_of_itself_shows_no_delta(frame):
    df = frame([(1, "a", None), (2, None, 3)], "id int, s string, n int")
    assert rows(N.snapshot_diff(df, df, ["id"])) == [(1, "same", None), (2, "same", None)]
    assert rows(N.snapshot_summary(df, df, ["id"])) == [("same", 2, False)]
    after = frame([(1, "b", 1), (3, "c", 1)], "id int, s string, n int")
    assert rows(N.snapshot_diff(df, after, ["id"])) == [(1, "differs", "s,n"), (2, "only before", None), (3, "only after", None)]
    assert rows(N.column_changes(df, after, ["id"])) == [("n", 1, 1), ("s", 1, 1)]


def shuffled(df):
    """Bytes that the exchanges of a run moved, without adaptive execution, which forgets those of empty sides."""
    conf = df.sparkSession.conf
    before = conf.get("spark.sql.adaptive.enabled")
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df.collect()
        todo, total = [df._jdf.queryExecution().executedPlan()], 0
    finally:
        conf.set("spark.sql.adaptive.enabled", before)
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "ShuffleExchangeExec":
            total += node.metrics().apply("dataSize").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_equal_tables_move_only_digests(spark):
    df = spark.range(1_000_000).select((F.col("id") % 1000).alias("k"), (F.col("id") / 1000).cast("int").alias("l"), F.repeat(F.col("id").cast("string"), 20).alias("text"))
    df.write.mode("overwrite").saveAsTable("proof_of_same")
    stored = spark.table("proof_of_same")
    whole = shuffled(stored.repartition(3, "k", "l"))
    assert whole > 120_000_000
    summary = N.snapshot_summary(stored, stored, ["k", "l"])
    assert rows(summary) == [("same", 1_000_000, False)]
    assert shuffled(N.snapshot_summary(stored, stored, ["k", "l"])) < 0.2 * whole
    few = stored.withColumn("text", F.when(F.col("k") + F.col("l") == 5, "x").otherwise(F.col("text")))
    assert rows(N.column_changes(stored, few, ["k", "l"])) == [("text", 6, 1_000_000)]
    assert shuffled(N.snapshot_diff(stored, few, ["k", "l"]).where("status <> 'same'")) < 0.2 * whole
    assert N.offending_rows(stored, few).count() == 12
    spark.sql("DROP TABLE proof_of_same")


def test_digests_tell_nested_and_null_values_apart(frame):
    kind = "id int, a array<int>, s struct<x: int, y: int>, m map<string, int>, t string, u string, b binary"
    base = (1, [None, 1], (None, 2), {"a": 1}, None, "x", b"1")
    for at, other in ((1, [1, None]), (1, [1]), (2, (2, None)), (3, {"a": None}), (3, {}), (4, ""), (6, None)):
        changed = base[:at] + (other,) + base[at + 1:]
        assert rows(N.snapshot_diff(frame([base], kind), frame([changed], kind), ["id"])) == [(1, "differs", "asmtub"[at - 1])]
    swapped = base[:4] + ("x", None, b"1")
    assert rows(N.snapshot_diff(frame([base], kind), frame([swapped], kind), ["id"])) == [(1, "differs", "t,u")]
    assert rows(N.snapshot_diff(frame([base], kind), frame([base], kind), ["id"])) == [(1, "same", None)]
    # Types that differ are compared by value.
    a, b = frame([(1, 5, "x"), (2, 6, "y")], "id int, n int, t string"), frame([(1, 5, "x"), (2, 7, "y")], "id long, n long, t string")
    assert rows(N.snapshot_diff(a, b, ["id"])) == [(1, "same", None), (2, "differs", "n")]
    assert rows(N.snapshot_summary(a, b, ["id"])) == [("differs", 1, True), ("same", 1, False)]


def test_duplicates_in_equal_buckets_are_refused_on_demand(frame):
    df = frame([(1, "a"), (1, "a"), (None, "b")], "id int, v string")
    assert rows(N.snapshot_summary(df, df, ["id"])) == [("same", 3, False)]
    for proof in (N.snapshot_diff, N.snapshot_summary, N.column_changes):
        with pytest.raises(Exception, match="not unique"):
            proof(df, df, ["id"], unique=True).collect()
        assert proof(df.distinct(), df.distinct(), ["id"], unique=True).count()


def test_proofs_agree_with_brute_force(spark, frame):
    rng = random.Random(5)
    kind = "k int, l string, x double, t string"
    keys = [(rng.choice([None, *range(30)]), rng.choice([None, "a", "b"])) for _ in range(200)]
    before = {key: (rng.choice([None, 0.0, 1.5, float("nan")]), rng.choice([None, "", "x"])) for key in keys}
    after = {key: v if rng.random() < 0.7 else (rng.choice([None, 2.0]), rng.choice([None, "x", "y"])) for key, v in before.items() if rng.random() < 0.9}
    after[(99, "new")] = (None, None)
    same = lambda a, b: a == b or (a != a and b != b)
    want = []
    for key in before.keys() | after.keys():
        b, a = before.get(key), after.get(key)
        changed = [] if None in (a, b) else [c for c, x, y in zip("xt", b, a, strict=True) if not same(x, y)]
        want.append((*key, "only after" if b is None else "only before" if a is None else "differs" if changed else "same", ",".join(changed) or None))
    left, right = (frame([(*key, *v) for key, v in side.items()], kind) for side in (before, after))
    assert rows(N.snapshot_diff(left, right, ["k", "l"], unique=True)) == sorted(want, key=repr)
    counts = collections.Counter(w[2] for w in want)
    assert rows(N.snapshot_summary(left, right, ["k", "l"])) == sorted(((s, n, s != "same") for s, n in counts.items()), key=repr)
    both = counts["same"] + counts["differs"]
    assert rows(N.column_changes(left, right, ["k", "l"])) == sorted(((c, sum(c in (w[3] or "") for w in want), both) for c in "xt"), key=repr)


def test_same_rows(frame):
    a, b = frame([(1,), (2,)], "x int"), frame([(2,), (1,)], "x int")
    N.assert_same_rows(a, b)
    with pytest.raises(AssertionError):
        N.assert_same_rows(a, a.union(a))


def test_rules_orphans_and_log_gate(frame):
    df = frame([(1, 5), (2, None), (2, 9)], "id int, n int")
    assert rows(N.check_rows(df, "small", F.col("n") < 8)) == [(2, 9, "small"), (2, None, "small")]
    assert rows(N.duplicate_keys(df, ["id"])) == [(2, 2)]
    assert rows(N.orphan_rows(frame([(1,), (7,), (None,)], "ref int"), df, ("ref", "id"))) == [(7,)]
    log = frame([("INFO", "a"), ("WARNING", "b 0 failed"), ("ERROR", "c"), ("WARNING", None)], "level string, text string")
    assert rows(N.gate_log(log, "text", [r"0 failed", "zzz"], level="level")) == [("ERROR", "c"), ("WARNING", None)]
    raw = frame([("10:00 INFO ok WARNING",), ("10:01 WARNING db: invalid option x",), ("10:02 ERROR db: broken",)], "text string")
    assert rows(N.gate_log(raw, "text", [r"WARNING .* invalid option"])) == [("10:02 ERROR db: broken",)]


def test_a_refused_update_keeps_its_row_and_the_rest_goes_on(frame):
    df = frame([(1, "unit"), (2, "dozen")], "id long, uom string")

    def change(batch):
        if 2 in batch.column("id").to_pylist():
            raise ValueError("in use")
        return {"uom": ["pack"] * batch.num_rows}

    assert rows(N.isolate_failures(df, change)) == [(1, "pack", None), (2, "dozen", "ValueError: in use")]
    typed = frame([(1, None, dt.datetime(9999, 12, 31)), (2, 5, dt.datetime(2024, 1, 1))], "id long, n long, at timestamp_ntz")
    seen = N.isolate_failures(typed, lambda batch: {"n": ["word" if n else 0 for n in batch.column("n").to_pylist()]})
    assert [(r.id, r.n, r.at, r.error is None) for r in seen.orderBy("id").collect()] == [
        (1, 0, dt.datetime(9999, 12, 31), True), (2, 5, dt.datetime(2024, 1, 1), False)]
    ok, failed = N.isolate_cast(frame([("1",), ("x",), (None,)], "s string"), "s", "int", "n")
    assert rows(ok) == [("1", 1), (None, None)] and rows(failed) == [("x",)]


def test_expense_states(frame):
    from evolve.functions.values import case_map

    df = frame([(1, "draft", "not_paid"), (2, "done", "paid"), (3, "post", "not_paid")], "id int, state string, payment string")
    out = case_map(df, "state", [(F.col("payment") == "paid", "paid"), (F.col("state") == "post", "posted")], F.col("state"))
    expected = frame([(1, "draft"), (2, "paid"), (3, "paid"), (4, "paid")], "id int, state string")
    assert rows(N.expectation_mismatches(out, expected, ["id"], ["state"])) == [(3, "state", "paid", "posted"), (4, "state", "paid", None)]


def test_recompute_in_bounded_chunks(spark):
    sizes = []

    def double(chunk):
        assert len(chunk) <= 10
        return pd.DataFrame({"y": chunk["id"] * 2})

    df = spark.range(0, 95, 1, 2)
    assert [r.y for r in O.recompute(df, double, {"y": "long"}, ["id"], chunk=10).orderBy("id").collect()] == [i * 2 for i in range(95)]
    assert sizes == []


def test_only_a_failing_batch_is_halved(spark):
    calls = spark.sparkContext.accumulator(0)

    def change(batch):
        calls.add(1)
        if 700 in batch.column("id").to_pylist():
            raise ValueError("no")
        return {}

    df = spark.range(0, 1024, 1, 2)
    assert N.isolate_failures(df, change).where("error IS NOT NULL").count() == 1
    assert calls.value <= 2 + 2 * 9


def test_untouched_columns_pass_recompute_as_they_are(frame):
    end, huge = dt.datetime(9999, 12, 31), 2**62 + 1
    df = frame([(1, end, huge, None), (2, None, None, 2.0)], "id int, until timestamp_ntz, big long, x double")
    out = O.recompute(df, lambda part: pd.DataFrame({"y": part["x"] * 2}), {"y": "double"}, ["x"])
    assert rows(out) == [(1, end, huge, None, None), (2, None, None, 2.0, 4.0)]


def test_null_key_parts_are_equal_and_duplicates_can_be_refused(frame):
    df = frame([(1, None, "a"), (None, 2, "b"), (None, None, "c")], "k int, l int, v string")
    assert {r.status for r in N.snapshot_diff(df, df, ["k", "l"]).collect()} == {"same"}
    after = df.replace("c", "d")
    assert rows(N.column_changes(df, after, ["k", "l"])) == [("v", 1, 3)]
    fields = frame([(None, "m", "f", "int"), ("a", "m", "g", "int")], "module string, model string, field string, type string")
    assert M.diff_fields(fields, fields).count() == 0
    assert N.with_unique_keys(df, ["k", "l"]).count() == 3
    with pytest.raises(Exception, match="not unique"):
        N.with_unique_keys(df.union(df), ["k", "l"]).collect()


def test_schema_diffs(frame):
    cat = "module string, model string, kind string"
    old, new = frame([("m", "a", None), ("m", "b", None), ("m", "d", None), ("m", "e", None)], cat), frame(
        [("m", "a", None), ("m", "c", "transient"), ("n", "d", None), ("m", "f", None)], cat)
    renames = frame([("b", "f")], "old string, new string")
    assert rows(M.diff_models(old, new, renames)) == [
        ("c", "new", None, "transient"), ("d", "moved", "m", None), ("e", "obsolete", None, None), ("f", "renamed", "b", None)]
    fld = "module string, model string, field string, type string"
    a, b = frame([("m", "x", "f1", "char"), ("m", "x", "f2", "int")], fld), frame([("m", "x", "f1", "text"), ("m", "x", "f3", "int")], fld)
    assert [(r.field, r.change) for r in M.diff_fields(a, b).orderBy("field").collect()] == [("f2", "DEL"), ("f3", "NEW")]
    assert rows(M.diff_attributes(a, b, ["module", "model", "field"], ["type"])) == [("m", "x", "f1", "type", "char", "text")]
    ka, kb = frame([("f", ["a", "b"]), ("g", ["a"])], "f string, k array<string>"), frame([("f", ["b", "d", "c"]), ("g", ["a"])], "f string, k array<string>")
    assert rows(M.diff_selection_keys(ka, kb, ["f"], "k")) == [("f", "c, d", "a")]
    rec = "module string, name string, model string, definition string, noupdate boolean"
    r1 = frame([("a", "x", "m", "1", False), ("a", "y", "m", "1", False), ("a", "z", "m", "1", False), ("c", "w", "m", "1", False)], rec)
    r2 = frame([("b", "x", "m", "1", False), ("c", "w", "m", "2", False), ("c", "v", "m", "2", True)], rec)
    got = M.diff_records(r1, r2, frame([("a", "b")], "old string, new string"))
    assert [(r.name, r.change, r.was_module) for r in got.orderBy("name").collect()] == [
        ("v", "NEW", None), ("w", "changed definition", None), ("x", "renamed", "a"), ("y", "DEL", None), ("z", "DEL", None)]
    cover = M.work_coverage(frame([("m", 1), ("m", 2), ("n", 3)], "module string, id int"), frame([(1,), (1,)], "id int"), "module", ["id"])
    assert rows(cover) == [("m", 2, 1, 0.5), ("n", 1, 0, 0.0)]
    assert rows(M.unclaimed_modules(frame([("m",), ("n",)], "module string"), [(frame([("m",)], "x string"), "x")], "module")) == [("n",)]


def test_guards(frame):
    df = frame([("1",), ("4",)], "p string")
    values = {"p": F.lit("x")}
    assert rows(guard_exists(df, F.col("p") == "9", values)) == rows(df)
    assert rows(guard_exists(df, F.col("p") == "9", values, negate=True)) == [("x",), ("x",)]
    assert rows(guard_changed(df.where("p = '9'"), df, values)) == rows(df)
    assert rows(guard_changed(df.where("p = '1'"), df, values)) == [("x",), ("x",)]


def _mark(table, value):
    return lambda ds: ds.put(table, map_in_place(ds[table], "p", [("1", value), ("pre", value)]))


def test_plan_runs_phases_in_order_and_checks_reads(frame):
    ds = Dataset({"t": frame([("1",)], "p string")})
    plan = Plan([
        Step("a", "end", _mark("t", "late"), ["t"], ["t"]), Step("a", "pre", _mark("t", "pre"), ["t"], ["t"], "1.0"),
    ])
    assert rows(run(ds, plan)["t"]) == [("late",)]
    assert rows(run(ds, plan, cut_between_phases=True)["t"]) == [("late",)]
    assert len(plan.excluding([("a", "1.0")]).steps) == 1
    with pytest.raises(ValueError, match="nobody"):
        run(ds, Plan([Step("a", "pre", lambda d: d, ["missing"])]))
    with pytest.raises(ValueError):
        Step("a", "later", lambda d: d)


def test_a_failed_run_goes_on_where_it_stopped(frame, tmp_path):
    ds = Dataset({"t": frame([("1", 1)], "p string, n int"), "u": frame([(1,)], "x int"), "old": frame([(0,)], "x int")})
    calls = []

    def step(name, fn):
        def run_step(d):
            calls.append(name)
            return fn(d)

        return run_step

    def plan(last, mark="pre"):
        return Plan([
            Step("a", "pre", step("pre", _mark("t", mark)), ["t"], ["t"]),
            Step("a", "pre", step("drop", lambda d: d.without("old")), ["old"]),
            Step("a", "post", step("post", lambda d: d.put("v", d["u"].withColumn("y", F.col("x") + 1))), ["u"], ["v"]),
            Step("a", "end", step("end", last), ["t", "v"], ["t"]),
        ])

    def fails(d):
        raise RuntimeError("lost")

    good = lambda d: d.put("t", d["t"].withColumn("n", F.col("n") + 10))
    folder = str(tmp_path / "run")
    with pytest.raises(RuntimeError):
        run_committed(ds, plan(fails), folder, "v1")
    assert calls == ["pre", "drop", "post", "end"]
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "run").rglob("*.parquet")}
    calls.clear()
    out, phases = run_committed(ds, plan(good), folder, "v1")
    assert calls == ["end"] and [(p.name, p.resumed, p.written) for p in phases] == [("pre", True, ("t",)), ("post", True, ("v",)), ("end", False, ("t",))]
    assert {p: p.stat().st_mtime_ns for p in files} == files
    assert sorted(out) == ["t", "u", "v"] and rows(out["t"]) == [("pre", 11)] and rows(out["v"]) == [(1, 2)]
    calls.clear()
    again, phases = run_committed(ds, plan(good), folder, "v1")
    assert not calls and all(p.resumed for p in phases) and rows(again["t"]) == [("pre", 11)]
    # Another input or another step is another run from there on. What a step holds on to counts, this list too.
    calls.clear()
    assert not any(p.resumed for p in run_committed(ds, plan(good), folder, "v2")[1])
    calls.clear()
    out, phases = run_committed(ds, plan(good, "zero"), folder, "v1")
    assert not any(p.resumed for p in phases) and rows(out["t"]) == [("zero", 11)]
    # A phase whose manifest is not whole is run again.
    (tmp_path / "run" / phases[-1].folder.rsplit("/", 1)[1] / "manifest" / "_SUCCESS").unlink()
    calls.clear()
    assert [p.resumed for p in run_committed(ds, plan(good, "zero"), folder, "v1")[1]] == [True, True, False]


def test_rerun_of_a_guarded_step_changes_nothing(frame):
    def step(df):
        return guard_exists(df, F.col("p").isin("2", "3"), {"p": F.when(F.col("p") == "1", "3").otherwise(F.col("p"))}, negate=True)

    df = frame([("0",), ("1",)], "p string")
    assert rows(step(df)) == [("0",), ("3",)]
    assert rows(step(step(df))) == rows(step(df))


def test_streamed_steps_equal_batch_steps(spark, frame, tmp_path):
    src = str(tmp_path / "in")
    batch = frame([(1, "a"), (2, "b")], "id long, p string")
    batch.write.parquet(src)
    steps = [lambda d: map_in_place(d, "p", [("a", "z")])]
    stream = apply_steps(spark.readStream.schema(batch.schema).parquet(src), steps)
    stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(apply_steps(batch, steps))


def test_streamed_patches_apply_batch_by_batch(spark, frame, tmp_path):
    frame([("a", 1), ("b", 2)], "id string, n int").write.parquet(str(tmp_path / "v0"))
    patch = "id string, field string, value string, at int"
    for row in ([("a", "n", "9", 1), ("a", "n", "5", 2)], [("c", "n", "7", 1)]):
        frame(row, patch).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(patch).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    upsert_stream(
        stream, lambda n: spark.read.parquet(str(tmp_path / f"v{n}")),
        lambda df, n: df.write.mode("overwrite").parquet(str(tmp_path / f"v{n + 1}")), "id", str(tmp_path / "cp"), position="at",
    ).awaitTermination()
    last = max(int(p.name[1:]) for p in tmp_path.glob("v*"))
    assert last >= 2
    assert rows(spark.read.parquet(str(tmp_path / f"v{last}"))) == [("a", 5), ("b", 2), ("c", 7)]


def test_what_a_session_stored_can_be_cleared(spark):
    from evolve import storage

    storage.clear_stored(spark)
    df = storage.stored(spark.range(10))
    path = storage._SCRATCH[-1]
    assert df.count() == 10 and storage.clear_stored(spark) == 1
    again = storage.scratch_folder(spark)
    assert again != path and storage.clear_stored(spark) == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
