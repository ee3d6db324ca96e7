"""Schema difference, validation, user functions, plans and streams."""

import pyarrow.compute as pc
from pyspark.sql import functions as F

from evolve.dataset import Dataset
from evolve.functions.values import fill_null, map_in_place, map_values, set_where
from evolve.operators import schemadiff as M
from evolve.operators import validate as N
from evolve.operators.compute import recompute, recompute_where
from evolve.operators.joins import update_from
from evolve.operators.schema import copy_columns
from evolve.plans.committed import run_committed
from evolve.plans.plan import Plan, Step, run
from evolve.queries.joins import LINE
from evolve.queries.registry import Section
from evolve.sources.buckets import BucketedTable
from evolve.storage import mapping_table, scratch_folder
from evolve.streaming.rows import apply_steps, upsert_buckets

section = Section()


def _models(t, where, promo, module):
    kind = F.when(F.col("p_type") == "PROMO", promo).otherwise(F.lower("p_type"))
    return t.part.where(where).select(
        F.when(F.col("p_type") == "SMALL", module).otherwise(F.col("p_brand")).alias("module"),
        F.concat_ws(".", kind, F.col("p_partkey").cast("string")).alias("model"),
        F.when(F.col("p_size") > 45, "transient").alias("kind"),
    )


@section.query("m1_diff_models", """
WITH p AS (SELECT *, CASE WHEN p_size <= 10 THEN 'obsolete' WHEN p_size > 30 THEN 'new' WHEN p_type = 'PROMO' THEN 'renamed'
  WHEN p_type = 'SMALL' THEN 'moved' END AS change FROM part)
SELECT CASE WHEN p_type = 'PROMO' AND change <> 'obsolete' THEN 'deal' ELSE lower(p_type) END || '.' || p_partkey AS model, change,
  CASE change WHEN 'renamed' THEN 'promo.' || p_partkey WHEN 'moved' THEN 'base' END AS detail,
  CASE WHEN p_size > 45 THEN 'transient' END AS kind FROM p WHERE change IS NOT NULL
""")
def _(t):
    key = F.col("p_partkey").cast("string")
    renames = t.part.where("p_type = 'PROMO'").select(F.concat_ws(".", F.lit("promo"), key).alias("old"), F.concat_ws(".", F.lit("deal"), key).alias("new"))
    return M.diff_models(_models(t, "p_size <= 30", "promo", "base"), _models(t, "p_size > 10", "deal", "web"), renames)


def _fields(t, where, kind):
    return t.part.where(where).select(
        F.col("p_brand").alias("module"), F.lower("p_type").alias("model"), F.concat(F.lit("f_"), F.col("p_partkey").cast("string")).alias("field"),
        F.lit(kind).alias("type"), (F.col("p_size") > 40).alias("required"),
    )


@section.query("m2_diff_fields", """
SELECT p_brand AS module, lower(p_type) AS model, 'f_' || p_partkey AS field, CASE WHEN p_size <= 10 THEN 'DEL' ELSE 'NEW' END AS change,
  CASE WHEN p_size <= 10 THEN 'char' ELSE 'text' END AS type, p_size > 40 AS required FROM part WHERE p_size <= 10 OR p_size > 30
""")
def _(t):
    return M.diff_fields(_fields(t, "p_size <= 30", "char"), _fields(t, "p_size > 10", "text"))


def _attributes(t):
    changed = t.part.withColumns(
        {"p_size": F.when(F.col("p_type") == "PROMO", F.col("p_size") * 2).otherwise(F.col("p_size")),
         "p_name": F.when(F.col("p_type") != "SMALL", F.col("p_name"))}
    )
    return M.diff_attributes(t.part, changed, ["p_partkey"], ["p_name", "p_size", "p_brand"])


_ATTRIBUTES = """
SELECT p_partkey, 'p_size' AS attribute, CAST(p_size AS VARCHAR) AS old, CAST(p_size * 2 AS VARCHAR) AS new FROM part WHERE p_type = 'PROMO'
UNION ALL SELECT p_partkey, 'p_name', p_name, NULL FROM part WHERE p_type = 'SMALL'
"""


@section.query("m3_diff_attributes", _ATTRIBUTES)
def _(t):
    return _attributes(t)


@section.query("m4_diff_selection_keys", """
WITH k AS (SELECT DISTINCT p_brand, p_type, p_size <= 12 AS o, p_size > 35 AS n FROM part),
f AS (SELECT p_brand, p_type, bool_or(o) AS o, bool_or(n) AS n FROM k GROUP BY 1, 2),
s AS (SELECT p_brand, coalesce(string_agg(p_type, ', ' ORDER BY p_type) FILTER (n AND NOT o), '') AS added,
  coalesce(string_agg(p_type, ', ' ORDER BY p_type) FILTER (o AND NOT n), '') AS removed, bool_or(o) AND bool_or(n) AS paired FROM f GROUP BY 1)
SELECT p_brand, added, removed FROM s WHERE paired AND (added <> '' OR removed <> '')
""")
def _(t):
    def keys(where):
        return t.part.where(where).groupBy("p_brand").agg(F.collect_set("p_type").alias("keys"))

    return M.diff_selection_keys(keys("p_size <= 12"), keys("p_size > 35"), ["p_brand"], "keys")


def _records(t, where, definition, flag):
    return t.customer.where(where).select(
        F.col("c_mktsegment").alias("module"), F.col("c_name").alias("name"), F.lit("customer").alias("model"),
        definition.alias("definition"), flag.alias("noupdate"),
    )


@section.query("m5_diff_records", """
WITH c AS (SELECT *, c_acctbal < 5000 AS o, c_acctbal > 0 AS n, CASE c_mktsegment WHEN 'BUILDING' THEN 'HOUSING' ELSE c_mktsegment END AS m FROM customer),
d AS (SELECT *, CASE WHEN n AND NOT o THEN 'NEW' WHEN o AND NOT n THEN 'DEL' WHEN c_mktsegment = 'BUILDING' THEN 'renamed'
  WHEN c_nationkey = 3 THEN 'changed definition' WHEN c_nationkey = 4 THEN 'noupdate switched' END AS change FROM c WHERE o OR n)
SELECT 'customer' AS model, CASE WHEN change = 'DEL' THEN c_mktsegment ELSE m END AS module, c_name AS name, change,
  CASE WHEN change = 'renamed' THEN 'BUILDING' END AS was_module, change <> 'DEL' AND c_nationkey = 4 AS noupdate FROM d WHERE change IS NOT NULL
""")
def _(t):
    old = _records(t, "c_acctbal < 5000", F.lit("x"), F.lit(False))
    new = _records(t, "c_acctbal > 0", F.when(F.col("c_nationkey") == 3, "y").otherwise("x"), F.col("c_nationkey") == 4)
    new = new.withColumn("module", F.when(F.col("module") == "BUILDING", "HOUSING").otherwise(F.col("module")))
    return M.diff_records(old, new, mapping_table(t.spark, [("BUILDING", "HOUSING")], "old string, new string"))


@section.query("m6_classify_noise", """
SELECT p_partkey, change, attribute, change = 'grown' OR attribute = 'p_name' AND change = 'cleared' AS noise FROM (
  SELECT p_partkey, attribute, CASE WHEN new IS NULL THEN 'cleared' WHEN CAST(new AS INTEGER) > 60 THEN 'grown' ELSE 'changed' END AS change FROM ("""
               + _ATTRIBUTES + "))")
def _(t):
    change = F.when(F.col("new").isNull(), "cleared").when(F.col("new").try_cast("int") > 60, "grown").otherwise("changed")
    diff = _attributes(t).select("p_partkey", change.alias("change"), "attribute")
    rules = mapping_table(t.spark, [("cleared", "p_name"), ("grown", None), ("changed", "p_brand")], "change string, attribute string")
    return M.classify_noise(diff, rules)


@section.query("m7_work_coverage", """
SELECT source, count(*) AS lines, count(l.doc_id) AS answered, round(count(l.doc_id) / count(*), 4) AS share
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY 1
""")
def _(t):
    return M.work_coverage(t.documents.select("source", "doc_id"), t.labels, "source", ["doc_id"])


@section.query("m7_unclaimed_modules", """
SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND doc_id NOT IN (SELECT page_id * 3 FROM pages)
""")
def _(t):
    claims = [(t.labels, "doc_id"), (t.pages.select((F.col("page_id") * 3).alias("doc_id")), "doc_id")]
    return M.unclaimed_modules(t.documents.select("doc_id", "source"), claims, "doc_id")


def _after(t):
    """Orders after a map: two statuses renamed, open cheap orders gone, customers' orders added."""
    after = map_values(t.orders, "o_orderstatus", "o_orderstatus", [("F", "done")])
    after = after.where("NOT (o_orderstatus = 'O' AND o_totalprice < 50000)")
    after = set_where(after, {"o_totalprice": 0.0}, F.col("o_orderpriority") == "5-LOW")
    added = t.customer.where("c_acctbal < 0").select(
        (F.lit(-1) - F.col("c_custkey")).alias("o_orderkey"), F.col("c_custkey").alias("o_custkey"), F.lit("N").alias("o_orderstatus")
    )
    return after.unionByName(added, allowMissingColumns=True)


_DIFF = """
WITH d AS (SELECT o_orderkey, o_orderstatus = 'O' AND o_totalprice < 50000 AS gone, o_orderstatus = 'F' AS s,
  o_orderpriority = '5-LOW' AND o_totalprice <> 0 AS p FROM orders),
r AS (SELECT o_orderkey, CASE WHEN gone THEN 'only before' WHEN s OR p THEN 'differs' ELSE 'same' END AS status,
  CASE WHEN NOT gone AND (s OR p) THEN concat_ws(',', CASE WHEN s THEN 'o_orderstatus' END, CASE WHEN p THEN 'o_totalprice' END) END AS changed FROM d
  UNION ALL SELECT -1 - c_custkey, 'only after', NULL FROM customer WHERE c_acctbal < 0)
"""


@section.query("n1_snapshot_diff", _DIFF + "SELECT o_orderkey, status, changed FROM r")
def _(t):
    return N.snapshot_diff(t.orders, _after(t), ["o_orderkey"])


@section.query("n1_snapshot_summary", _DIFF + "SELECT status, count(*) AS rows, status <> 'same' AS delta FROM r GROUP BY 1")
def _(t):
    return N.snapshot_summary(t.orders, _after(t), ["o_orderkey"])


@section.query("n1_column_changes", _DIFF + """
SELECT c AS "column", count(*) FILTER (changed LIKE '%' || c || '%') AS changed, count(*) AS rows FROM r
CROSS JOIN (VALUES ('o_custkey'), ('o_orderstatus'), ('o_totalprice'), ('o_orderdate'), ('o_orderpriority')) v(c)
WHERE status IN ('same', 'differs') GROUP BY 1
""")
def _(t):
    return N.column_changes(t.orders, _after(t), ["o_orderkey"])


@section.query("n2_same_rows", """
SELECT c_custkey, c_mktsegment, 'left' AS side, CAST(1 AS BIGINT) AS copies FROM customer WHERE c_nationkey = 5 AND c_mktsegment <> 'X'
UNION ALL SELECT c_custkey, 'X', 'right', CAST(1 AS BIGINT) FROM customer WHERE c_nationkey = 5
""")
def _(t):
    before = t.customer.select("c_custkey", "c_mktsegment")
    after = t.customer.select("c_custkey", F.when(F.col("c_nationkey") == 5, "X").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    return N.offending_rows(before, after)


@section.query("n1_few_changes", """
SELECT nullif(o_orderkey % 3, 0) AS k1, o_orderkey AS k2, CASE WHEN o_custkey % 500 = 7 THEN 'differs' ELSE 'only before' END AS status,
  CASE WHEN o_custkey % 500 = 7 THEN 'o_orderpriority' END AS changed FROM orders WHERE o_custkey % 500 = 7 OR o_custkey % 500 = 8
UNION ALL SELECT nullif(o_orderkey % 3, 0), -o_orderkey, 'only after', NULL FROM orders WHERE o_custkey % 500 = 9 AND o_orderkey <> 0
""")
def _(t):
    """Few of the buckets differ; a part of the key is NULL in a third of the rows."""
    before = t.orders.withColumns({"k1": F.nullif(F.col("o_orderkey") % 3, F.lit(0)), "k2": F.col("o_orderkey")}).drop("o_orderkey")
    last = F.col("o_custkey") % 500
    after = before.where(last != 8).withColumn("o_orderpriority", F.when(last == 7, F.concat("o_orderpriority", F.lit("!"))).otherwise(F.col("o_orderpriority")))
    after = after.unionByName(before.where((last == 9) & (F.col("k2") != 0)).withColumn("k2", -F.col("k2")))
    return N.snapshot_diff(before, after, ["k1", "k2"], unique=True).where("status <> 'same'")


@section.query("n2_duplicates_and_nulls", """
WITH l AS (SELECT l_returnflag, nullif(l_linenumber, 3) AS l_linenumber, l_quantity FROM lineitem),
a AS (SELECT *, count(*) AS n FROM l GROUP BY ALL),
b AS (SELECT *, count(*) AS n FROM (SELECT * FROM l WHERE l_quantity <> 7 UNION ALL SELECT * FROM l WHERE l_quantity = 11 AND l_linenumber IS NULL) GROUP BY ALL)
SELECT l_returnflag, l_linenumber, l_quantity, CASE WHEN sum(d) > 0 THEN 'left' ELSE 'right' END AS side, CAST(abs(sum(d)) AS BIGINT) AS copies
FROM (SELECT *, n AS d FROM a UNION ALL SELECT *, -n FROM b) GROUP BY 1, 2, 3 HAVING sum(d) <> 0
""")
def _(t):
    before = t.lineitem.select("l_returnflag", F.nullif("l_linenumber", F.lit(3)).alias("l_linenumber"), "l_quantity")
    again = before.where((F.col("l_quantity") == 11) & F.col("l_linenumber").isNull())
    return N.offending_rows(before, before.where("l_quantity <> 7").unionByName(again))


@section.query("n3_check_rows", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'quantity' AS rule FROM lineitem
WHERE NOT coalesce(l_quantity > 5 AND nullif(l_returnflag, 'A') <> 'X', false)
""")
def _(t):
    rule = (F.col("l_quantity") > 5) & (F.nullif("l_returnflag", F.lit("A")) != "X")
    return N.check_rows(t.lineitem, "quantity", rule).select(*LINE, "rule")


@section.query("n3_duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def _(t):
    return N.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@section.query("n4_orphan_rows", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
""")
def _(t):
    return N.orphan_rows(t.lineitem, t.orders.where("o_orderstatus = 'F'"), ("l_orderkey", "o_orderkey")).select(*LINE)


@section.query("n5_gate_log", r"""
SELECT event_id, text FROM (SELECT event_id, CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'WARNING' ELSE 'INFO' END AS level,
  CASE event_type WHEN 'error' THEN 'ERROR ' WHEN 'view' THEN 'WARNING ' ELSE 'INFO ' END || event_type || ' by ' || user_id || ': ' || props AS text FROM events)
WHERE level <> 'INFO' AND NOT regexp_matches(text, 'WARNING.* view by 1\d\b') AND NOT regexp_matches(text, '"k": [1-4]')
""")
def _(t):
    kind = F.col("event_type")
    level = F.when(kind == "error", "ERROR").when(kind == "view", "WARNING").otherwise("INFO")
    text = F.concat(level, F.lit(" "), kind, F.lit(" by "), F.col("user_id").cast("string"), F.lit(": "), F.col("props"))
    lines = t.events.select("event_id", text.alias("text"))
    return N.gate_log(lines, "text", [r"WARNING.* view by 1\d\b", r'"k": [1-4]'])


@section.query("n6_isolate_failures", """
SELECT p_partkey, CASE WHEN p_size = 13 THEN p_name ELSE upper(p_name) END AS p_name, p_size,
  CASE WHEN p_size = 13 THEN 'ValueError: size 13 is refused' END AS error FROM part
""")
def _(t):
    def rename(batch):
        if 13 in batch.column("p_size").to_pylist():
            raise ValueError("size 13 is refused")
        return {"p_name": pc.utf8_upper(batch.column("p_name"))}

    return N.isolate_failures(t.part.select("p_partkey", "p_name", "p_size"), rename)


@section.query("n6_isolate_cast", """
SELECT p_partkey, word, TRY_CAST(word AS INTEGER) AS number, TRY_CAST(word AS INTEGER) IS NULL AS failed FROM (
  SELECT p_partkey, CASE WHEN p_type = 'LARGE' THEN p_name ELSE CAST(p_size AS VARCHAR) END AS word FROM part)
""")
def _(t):
    word = F.when(F.col("p_type") == "LARGE", F.col("p_name")).otherwise(F.col("p_size").cast("string"))
    ok, failed = N.isolate_cast(t.part.select("p_partkey", word.alias("word")), "word", "int", "number")
    bad = failed.withColumns({"number": F.lit(None).cast("int"), "failed": F.lit(True)})
    return ok.withColumn("failed", F.lit(False)).unionByName(bad)


@section.query("n7_expected_values", """
SELECT o_orderkey, 'state' AS "column", 'closed' AS expected, CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS actual
FROM orders WHERE o_totalprice > 300000 AND o_orderstatus <> 'F'
""")
def _(t):
    result = map_in_place(t.orders.withColumnRenamed("o_orderstatus", "state"), "state", [("F", "closed"), ("O", "open")])
    expected = t.orders.where("o_totalprice > 300000").select("o_orderkey", F.lit("closed").alias("state"))
    return N.expectation_mismatches(result, expected, ["o_orderkey"], ["state"])


@section.query("o1_recompute", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount * 100 > l_linenumber AS is_storno,
  CASE WHEN l_returnflag = 'R' THEN 'back' ELSE 'kept' END AS state FROM lineitem
""")
def _(t):
    def storno(chunk):
        return (chunk[["l_discount"]] * 100).gt(chunk["l_linenumber"], axis=0).rename(columns={"l_discount": "is_storno"})

    lines = t.lineitem.select(*LINE, "l_discount", "l_returnflag", F.lit("kept").alias("state"))
    out = recompute(lines, storno, {"is_storno": "boolean"}, needs=["l_discount", "l_linenumber"])
    return recompute_where(out, {"state": F.lit("back")}, F.col("l_returnflag") == "R").select(*LINE, "is_storno", "state")


def migration() -> Plan:
    """Keep the old priority, map it, then flag orders from the customers."""
    plan = Plan()

    @plan.step("sales", "post", reads=["orders", "customer"], writes=["orders"])
    def flag(ds):
        source = ds["customer"].where("c_mktsegment = 'BUILDING'")
        sets = {"o_orderstatus": F.lit("B")}
        return ds.put("orders", update_from(ds["orders"], source, [("o_custkey", "c_custkey")], sets, unique=True))

    @plan.step("sales", "pre", reads=["orders"], writes=["orders"])
    def remap(ds):
        kept = copy_columns(ds["orders"], [("o_orderpriority", None, None)])
        codes = [("1-URGENT", "3"), ("2-HIGH", "2"), ("3-MEDIUM", "1"), ("5-LOW", None)]
        return ds.put("orders", map_values(kept, "legacy__o_orderpriority", "o_orderpriority", codes))

    return plan


@section.query("o3_plan_steps", """
SELECT o_orderkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'B' ELSE o_orderstatus END AS o_orderstatus,
  CASE o_orderpriority WHEN '1-URGENT' THEN '3' WHEN '2-HIGH' THEN '2' WHEN '3-MEDIUM' THEN '1' WHEN '5-LOW' THEN NULL ELSE o_orderpriority END AS o_orderpriority,
  o_orderpriority AS legacy__o_orderpriority FROM orders LEFT JOIN customer ON c_custkey = o_custkey
""")
def _(t):
    ds = run(Dataset({"orders": t.orders, "customer": t.customer}), migration())
    return ds["orders"].select("o_orderkey", "o_orderstatus", "o_orderpriority", "legacy__o_orderpriority")


@section.query("o3_committed_phases", """
WITH o AS (SELECT o_orderkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'B' ELSE o_orderstatus END AS o_orderstatus,
  CASE o_orderpriority WHEN '1-URGENT' THEN '3' WHEN '2-HIGH' THEN '2' WHEN '3-MEDIUM' THEN '1' WHEN '5-LOW' THEN NULL ELSE o_orderpriority END AS o_orderpriority
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey)
SELECT o_orderstatus, o_orderpriority, count(*) AS orders, 'pre' AS resumed FROM o GROUP BY 1, 2
""")
def _(t):
    """The last phase fails at first; the run after that reads the first phase back and does the rest."""
    ds, folder = Dataset({"orders": t.orders, "customer": t.customer}), scratch_folder(t.spark)

    def fail(d):
        raise RuntimeError("no space left")

    broken = Plan([s if s.phase == "pre" else Step(s.module, s.phase, fail, s.reads, s.writes) for s in migration().steps])
    try:
        run_committed(ds, broken, folder, t.folder)
    except RuntimeError:
        out, phases = run_committed(ds, migration(), folder, t.folder)
    resumed = ",".join(p.name for p in phases if p.resumed)
    return out["orders"].groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("orders")).withColumn("resumed", F.lit(resumed))


@section.query("flagship_migration", """
SELECT 'o_custkey' AS "column", CAST(0 AS BIGINT) AS changed, count(*) AS rows FROM orders
UNION ALL SELECT 'o_orderdate', 0, count(*) FROM orders UNION ALL SELECT 'o_totalprice', 0, count(*) FROM orders
UNION ALL SELECT 'o_orderstatus', count(*) FILTER (c_mktsegment = 'BUILDING'), count(*) FROM orders LEFT JOIN customer ON c_custkey = o_custkey
UNION ALL SELECT 'o_orderpriority', count(*) FILTER (o_orderpriority <> '4-NOT SPECIFIED'), count(*) FROM orders
""")
def _(t):
    before = Dataset({"orders": t.orders, "customer": t.customer})
    return N.column_changes(before["orders"], run(before, migration())["orders"], ["o_orderkey"])


def _stream(t, table, like):
    """A test table as a stream; the pattern fits a file as well as a folder of that name."""
    return t.spark.readStream.schema(like.schema).parquet(f"{t.folder}/{table}.parque[t]")


@section.query("p1_stream_steps", """
SELECT event_id, CASE event_type WHEN 'click' THEN 'press' ELSE event_type END AS event_type,
  CASE WHEN event_type = 'error' THEN 0.0 ELSE value END AS value FROM events
""")
def _(t):
    steps = [
        lambda df: set_where(df, {"value": F.lit(None)}, F.col("event_type") == "error"),
        lambda df: map_in_place(df, "event_type", [("click", "press")]),
        lambda df: fill_null(df, "value", 0.0),
    ]
    folder = scratch_folder(t.spark)
    out = apply_steps(_stream(t, "events", t.events).select("event_id", "event_type", "value"), steps)
    query = (
        out.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return t.spark.read.parquet(f"{folder}/out")


@section.query("p2_stream_upsert", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, CASE WHEN s_suppkey IS NOT NULL THEN s_name ELSE c_mktsegment END AS c_mktsegment
FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey
""")
def _(t):
    folder = scratch_folder(t.spark)
    changes = F.array(F.struct(F.lit(1).alias("at"), F.lit("zulu").alias("value")), F.struct(F.lit(2).alias("at"), F.col("s_name").alias("value")))
    patches = _stream(t, "supplier", t.supplier).select(
        F.col("s_suppkey").alias("c_custkey"), F.lit("c_mktsegment").alias("field"), F.inline(changes)
    )
    target = BucketedTable.create(t.customer, f"{folder}/customer", "c_custkey", buckets=16)
    upsert_buckets(patches, target, f"{folder}/state", position="at", create="never").awaitTermination()
    return target.read()


@section.query("p3_bucket_upsert", """
WITH patch AS (SELECT s_suppkey AS k, s_name FROM supplier WHERE s_suppkey % 3 = 0
  UNION ALL SELECT s_suppkey + (SELECT max(c_custkey) FROM customer), s_name FROM supplier WHERE s_suppkey % 7 = 0)
SELECT coalesce(c_custkey, k) AS c_custkey, c_name, c_nationkey, c_acctbal, CASE WHEN k IS NOT NULL THEN s_name ELSE c_mktsegment END AS c_mktsegment
FROM customer FULL JOIN patch ON k = c_custkey
""")
def _(t):
    """Known and new records in one batch, which is then run again."""
    target = BucketedTable.create(t.customer, f"{scratch_folder(t.spark)}/customer", "c_custkey", buckets=16)
    last = t.customer.agg(F.max("c_custkey")).scalar()
    named = lambda key, every: t.supplier.where(F.col("s_suppkey") % every == 0).select(key.alias("c_custkey"), F.lit("c_mktsegment").alias("field"), F.col("s_name").alias("value"))
    patch = named(F.col("s_suppkey"), 3).unionByName(named(F.col("s_suppkey") + last, 7))
    for _ in range(2):
        target.upsert(patch, stream="suppliers", batch=0)
    return target.read()
