"""Schema operators."""

from pyspark.sql import functions as F

from evolve.dataset import Dataset
from evolve.functions.values import map_in_place
from evolve.naming import legacy_name
from evolve.operators.domains import rename_paths
from evolve.operators.schema import (
    add_column_if_absent, add_columns, cast_columns, copy_columns, rename_columns, rename_field_references,
    rename_fields, rename_models, retain_dropped, retained_report,
)
from evolve.plans.plan import guarded
from evolve.queries.registry import Section

section = Section()


@section.query("b1_rename_columns", """
SELECT c_custkey AS id, c_name AS legacy__c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
""")
def _(t):
    return rename_columns(t.customer, [("c_name", None), ("c_custkey", "id"), ("not_there", "x")])


@section.query("b2_rename_fields", """
SELECT o_orderkey AS id, o_custkey AS partner_id, o_orderstatus AS state, o_totalprice, o_orderpriority,
  CASE WHEN o_orderstatus = 'F' THEN 'id' WHEN o_orderstatus = 'O' THEN 'state' ELSE 'o_totalprice' END AS field FROM orders
""")
def _(t):
    status = F.col("o_orderstatus")
    name = F.when(status == "F", "o_orderkey").when(status == "O", "o_orderstatus").otherwise("o_totalprice")
    meta = t.orders.select(F.lit("shop.order").alias("model"), name.alias("name"), F.col("o_orderkey").alias("key"))
    ds = Dataset({"orders": t.orders, "fields": meta})
    renames = [("o_orderkey", "id"), ("o_custkey", "partner_id"), ("o_orderstatus", "state")]
    ds = rename_fields(ds, [("shop.order", "orders", o, n) for o, n in renames])
    renamed = ds["fields"].select(F.col("key").alias("id"), F.col("name").alias("field"))
    return ds["orders"].drop("o_orderdate").join(renamed, "id")


@section.query("b3_rename_tables", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def _(t):
    ds = Dataset({"supplier": t.supplier, "part": t.part}).rename_tables([("supplier", "vendor"), ("part", None)])
    assert ds.has_table(legacy_name("part")) and not ds.has_table("supplier")
    return ds["vendor"]


@section.query("b4_rename_models", """
SELECT event_id, CASE event_type WHEN 'click' THEN 'press' WHEN 'view' THEN 'show' ELSE event_type END AS event_type,
       user_id FROM events
""")
def _(t):
    ds = rename_models(Dataset({"events": t.events}), [("click", "press"), ("view", "show")], {"events": ["event_type"]})
    return ds["events"].select("event_id", "event_type", "user_id")


@section.query("b5_add_columns", """
SELECT o_orderkey, o_totalprice, 'pending' AS won_status, CAST(0 AS BIGINT) AS sequence, CAST(NULL AS VARCHAR) AS note
FROM orders
""")
def _(t):
    ds = add_columns(
        Dataset({"orders": t.orders}),
        [("orders", "won_status", "string", "pending"), ("orders", "sequence", "bigint", 0), ("orders", "note", "string", None)],
    )
    return ds["orders"].select("o_orderkey", "o_totalprice", "won_status", "sequence", "note")


@section.query("b6_add_column_if_absent", """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(NULL AS VARCHAR) AS legacy__link FROM lineitem
""")
def _(t):
    once = add_column_if_absent(t.lineitem, legacy_name("link"), "string")
    twice = add_column_if_absent(once, legacy_name("link"), "string", default="never")
    return twice.select("l_orderkey", "l_linenumber", "l_partkey", "legacy__link")


@section.query("b7_copy_columns", """
SELECT o_orderkey, o_orderstatus, o_orderstatus AS legacy__o_orderstatus,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS valid_from
FROM orders
""")
def _(t):
    out = copy_columns(t.orders, [("o_orderstatus", None, None), ("o_orderdate", "valid_from", "date")])
    return out.select("o_orderkey", "o_orderstatus", "legacy__o_orderstatus", F.col("valid_from").cast("string"))


@section.query("b8_cast_columns", """
SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, CAST(NULL AS INTEGER) AS p_name,
       TRY_CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS p_brand
FROM part
""")
def _(t):
    bare = t.part.withColumn("p_brand", F.replace("p_brand", F.lit("Brand#"), F.lit("")))
    out = cast_columns(bare, {"p_size": "double", "p_name": "int"})
    return cast_columns(out, {"p_brand": "int"}, on_error="raise").select("p_partkey", "p_size", "p_name", "p_brand")


@section.query("b9_legacy_name", "SELECT s_suppkey, s_name AS legacy__s_name, s_acctbal AS legacy__s_acctbal FROM supplier")
def _(t):
    return t.supplier.select(
        "s_suppkey", F.col("s_name").alias(legacy_name("s_name")), F.col("s_acctbal").alias(legacy_name(legacy_name("s_acctbal")))
    )


@section.query("b10_has_column", """
SELECT c_custkey, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'HOME' ELSE c_mktsegment END AS c_mktsegment FROM customer
""")
def _(t):
    ds = Dataset({"customer": t.customer})
    df = ds["customer"]
    df = guarded(ds.has_column("customer", "c_color"), lambda d: map_in_place(d, "c_color", [("red", "r")]), df)
    df = guarded(ds.has_column("customer", "c_mktsegment"), lambda d: map_in_place(d, "c_mktsegment", [("HOUSEHOLD", "HOME")]), df)
    return df.select("c_custkey", "c_mktsegment")


@section.query("b11_has_table", "SELECT p_partkey, p_name, p_brand FROM part")
def _(t):
    ds = Dataset({"part": t.part})
    for old, new in (("contract", "version"), ("part", "product")):
        if ds.has_table(old):
            ds = ds.rename_tables([(old, new)])
    return ds["product"].select("p_partkey", "p_name", "p_brand")


@section.query("b12_rename_field_references", """
SELECT event_id, CASE WHEN event_type = 'click' THEN replace(props, '"k"', '"key"') ELSE props END AS props,
  user_id || CASE event_type WHEN 'click' THEN ': [b, x.a, a_b, a]' WHEN 'view' THEN ': [b, x.a, a_b, c]' ELSE ': [a, x.a, a_b, b]' END AS domain
FROM events
""")
def _(t):
    events = t.events.withColumn("domain", F.concat(F.col("user_id").cast("string"), F.lit(": [a, x.a, a_b, b]")))
    out = rename_field_references(events, "props", [("click", "k", "key"), ("none", "k", "x")], "event_type")
    swaps = [("click", "a", "b"), ("click", "b", "a"), ("view", "a", "b"), ("view", "b", "c")]
    return rename_field_references(out, "domain", swaps, "event_type").select("event_id", "props", "domain")


@section.query("b12_domain_paths", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F'
  THEN '[''|'', (''day'', ''='', ''date''), ("customer_id.nation.title", "ilike", "date"), (''customer_id.unknown.date'', ''!='', False), (''lines.date'', ''in'', [' || o_custkey || '])]'
  WHEN o_orderstatus = 'O' THEN '[''|'', (''title'', ''='', ''date''), ("customer_id.nation.name", "ilike", "date"), (''customer_id.unknown.date'', ''!='', False), (''lines.date'', ''in'', [' || o_custkey || '])]'
  ELSE '[''|'', (''date'', ''='', ''date''), ("customer_id.nation.name", "ilike", "date"), (''customer_id.unknown.date'', ''!='', False), (''lines.date'', ''in'', [' || o_custkey || '])]' END AS domain,
  CASE WHEN o_orderstatus = 'F' THEN '[''day:month'', ''customer_id.nation.title'']' WHEN o_orderstatus = 'O' THEN '[''title:month'', ''customer_id.nation.name'']' ELSE '[''date:month'', ''customer_id.nation.name'']' END AS grouped,
  CASE WHEN o_orderstatus = 'F' THEN 'On {{ object.day }}: {{ object.customer_id.nation.title.upper() }}, date' WHEN o_orderstatus = 'O' THEN 'On {{ object.title }}: {{ object.customer_id.nation.name.upper() }}, date'
  ELSE 'On {{ object.date }}: {{ object.customer_id.nation.name.upper() }}, date' END AS body
FROM orders
""")
def _(t):
    """Names change at the step whose model they belong to; values, unknown paths and other models keep theirs."""
    spark = t.spark
    fields = spark.createDataFrame([
        ("F", "date", None), ("F", "customer_id", "partner"), ("F", "lines", "line"), ("line", "date", None), ("partner", "nation", "country"), ("partner", "date", None),
        ("country", "name", None), ("O", "date", None), ("O", "customer_id", "gone"), ("line", "name", None),
    ], "model string, name string, relation string")
    renames = spark.createDataFrame([("F", "date", "day"), ("country", "name", "title"), ("O", "date", "title"), ("partner", "date", "since")], "model string, old string, new string")
    domain = F.concat(
        F.lit("""['|', ('date', '=', 'date'), ("customer_id.nation.name", "ilike", "date"), ('customer_id.unknown.date', '!=', False), ('lines.date', 'in', ["""),
        F.col("o_custkey").cast("string"), F.lit("])]"))
    rows = t.orders.select(
        "o_orderkey", "o_orderstatus", domain.alias("domain"), F.lit("['date:month', 'customer_id.nation.name']").alias("grouped"),
        F.lit("On {{ object.date }}: {{ object.customer_id.nation.name.upper() }}, date").alias("body"))
    for column, form in (("domain", "domain"), ("grouped", "list"), ("body", "template")):
        rows = rename_paths(rows, "o_orderkey", column, "o_orderstatus", fields, renames, form)
    return rows.drop("o_orderstatus")


@section.query("b13_retain_dropped", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _(t):
    return retain_dropped(t.customer, t.customer.select("c_custkey", "c_mktsegment"), ["c_custkey"])


@section.query("b14_retained_report", """
SELECT 'column' AS kind, 'orders.o_orderpriority' AS name, count(o_orderpriority) AS kept_values,
       'column o_orderpriority of table orders is kept' AS message FROM orders
UNION ALL
SELECT 'column', 'orders.o_totalprice', count(o_totalprice), 'column o_totalprice of table orders is kept' FROM orders
UNION ALL
SELECT 'table', 'events', count(*), 'table events is kept' FROM events
""")
def _(t):
    before = {"orders": t.orders, "events": t.events}
    return retained_report(before, {"orders": t.orders.drop("o_orderpriority", "o_totalprice")})
