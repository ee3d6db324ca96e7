"""Scans, sources and sinks."""

from pyspark.sql import functions as F

from evolve.dataset import Dataset
from evolve.functions.values import map_values
from evolve.operators.joins import attach
from evolve.operators.records import (
    apply_member_commands, member_commands, resolve_values, transform_patch, upsert_records,
)
from evolve.queries.registry import Section
from evolve.sources.records import parse_records, read_records
from evolve.sources.reports import (
    attach_notes, parse_diff_lines, parse_status_lines, read_annotations, read_schema_diff, read_status_grid,
)
from evolve.sources.tables import append_select, clear_table, create_relation, mapping_table, scan, snapshot
from evolve.storage import scratch_folder

section = Section()


@section.query("a1_scan", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
""")
def _(t):
    ds = Dataset({"orders": t.orders})
    return scan(ds, "orders", ["o_orderkey", "o_custkey", "o_totalprice"], F.col("o_orderstatus") == "F")


def _written(t, lines):
    """Lines in several text files of a scratch folder."""
    folder = scratch_folder(t.spark)
    lines.write.text(folder)
    return folder


_RECORDS = """
WITH r AS (
  SELECT 'customer_' || c_custkey AS record_id, c_name, c_mktsegment,
         CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS bal, c_acctbal < 0 AS neg
  FROM customer
)
SELECT 'sales' AS module, record_id, 'customer' AS model,
       CASE WHEN neg THEN 'false' END AS forcecreate, field, value, kind
FROM (
  SELECT record_id, neg, 'name' AS field, c_name AS value, 'text' AS kind FROM r
  UNION ALL SELECT record_id, neg, 'segment', 'base.' || c_mktsegment, 'ref' FROM r
  UNION ALL SELECT record_id, neg, 'balance', bal, 'eval' FROM r
  UNION ALL SELECT record_id, neg, 'note', '<p>' || c_name || '</p>', 'markup' FROM r
  UNION ALL SELECT record_id, neg, 'image', 'sales/static/' || record_id || '.png', 'file' FROM r
)
"""


def _record_xml():
    return F.concat(
        F.lit('<record id="customer_'), F.col("c_custkey").cast("string"), F.lit('" model="customer"'),
        F.when(F.col("c_acctbal") < 0, F.lit(' forcecreate="False"')).otherwise(F.lit("")),
        F.lit('><field name="name">'), F.col("c_name"),
        F.lit('</field><field name="segment" ref="base.'), F.col("c_mktsegment"),
        F.lit('"/><field name="balance" eval="'), F.col("c_acctbal").cast("decimal(18,2)").cast("string"),
        F.lit('"/><field name="note" type="html"><p>'), F.col("c_name"),
        F.lit('</p></field><field name="image" type="base64" file="sales/static/customer_'), F.col("c_custkey").cast("string"),
        F.lit('.png"/></record>'),
    )


@section.query("a2_read_records", _RECORDS)
def _(t):
    rows = parse_records(t.customer.select(_record_xml().alias("xml")), "xml", F.lit("sales"))
    return rows.withColumn("forcecreate", F.col("forcecreate").cast("string"))


@section.query("a2_read_record_files", _RECORDS)
def _(t):
    folder = _written(t, t.customer.select(_record_xml().alias("text")).repartition(3))
    return read_records(t.spark, folder, "sales").withColumn("forcecreate", F.col("forcecreate").cast("string"))


def _part_patch(t):
    fields = F.array(
        *[
            F.struct(F.lit(f).alias("field"), F.col(c).cast("string").alias("value"))
            for f, c in (("brand", "p_brand"), ("type", "p_type"), ("size", "p_size"))
        ]
    )
    return t.part.select(
        F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("record_id"),
        F.lit(True).alias("forcecreate"), F.inline(fields),
    )


@section.query("a3_transform_patch", """
SELECT 'part_' || p_partkey AS record_id, p_type <> 'SMALL' AS forcecreate, f.field AS field,
       CASE f.field WHEN 'brand' THEN p_brand ELSE p_type END AS value
FROM part CROSS JOIN (VALUES ('brand'), ('type')) f(field)
WHERE p_size <= 40 AND NOT (p_type = 'PROMO' AND f.field = 'brand')
""")
def _(t):
    def ids(where):
        return t.part.where(where).select(F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("record_id"))

    return transform_patch(
        _part_patch(t),
        drop_records=ids("p_size > 40"),
        drop_fields=ids("p_type = 'PROMO'").withColumn("field", F.lit("brand")),
        drop_everywhere=["size"],
        set_attributes=ids("p_type = 'SMALL'").withColumn("forcecreate", F.lit(False)),
    )


@section.query("a4_upsert_records", """
SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_nationkey END AS c_nationkey, c_acctbal,
       CASE WHEN c_acctbal < 0 THEN 'REVIEW' ELSE c_mktsegment END AS c_mktsegment
FROM customer
UNION ALL
SELECT -1 - s_suppkey, s_name, s_nationkey, NULL, 'SUPPLIER' FROM supplier WHERE s_acctbal >= 0
""")
def _(t):
    def field(name, value):
        return F.struct(F.lit(name).alias("field"), value.cast("string").alias("value"))

    old = t.customer.where("c_acctbal < 0").select(
        "c_custkey", F.lit(True).alias("forcecreate"),
        F.inline(F.array(field("c_mktsegment", F.lit("REVIEW")), field("c_nationkey", F.lit(None)))),
    )
    new = t.supplier.select(
        (F.lit(-1) - F.col("s_suppkey")).alias("c_custkey"), (F.col("s_acctbal") >= 0).alias("forcecreate"),
        F.inline(F.array(
            field("c_name", F.col("s_name")), field("c_nationkey", F.col("s_nationkey")),
            field("c_mktsegment", F.lit("ZULU")), field("c_mktsegment", F.lit("SUPPLIER")),
        )),
    )
    patch = old.unionByName(new).withColumn("at", F.when(F.col("value") == "ZULU", 0).otherwise(1))
    return upsert_records(t.customer, patch, "c_custkey", create="auto", position="at")


@section.query("a4_resolve_values", r"""
SELECT 'sales' AS module, o_orderkey AS record_id, 'note' AS field, CASE o_orderpriority
  WHEN '1-URGENT' THEN CAST(c_custkey AS VARCHAR) WHEN '3-MEDIUM' THEN CAST(c_custkey AS VARCHAR)
  WHEN '4-NOT SPECIFIED' THEN o_orderstatus || chr(10) || 'x' WHEN '5-LOW' THEN CASE WHEN o_orderstatus = 'F' THEN NULL ELSE 'None' END END AS value
FROM orders LEFT JOIN customer ON c_custkey = o_custkey
UNION ALL SELECT 'sales', o_orderkey, 'domain', '[(' || chr(39) || 'owner' || chr(39) || ', ' || chr(39) || 'in' || chr(39) || ', [' || c_custkey || ', ' || c_custkey || '])]'
FROM orders JOIN customer ON c_custkey = o_custkey
UNION ALL SELECT 'sales', o_orderkey, 'image', 'bytes of ' || o_orderkey FROM orders WHERE o_orderstatus = 'O'
""")
def _(t):
    priority, name = F.col("o_orderpriority"), F.format_string("Customer#%09d", "o_custkey")
    literal = (
        F.when(priority == "1-URGENT", F.concat(F.lit("base."), name)).when(priority == "2-HIGH", F.lit("nobody"))
        .when(priority == "3-MEDIUM", F.concat(F.lit("ref('base."), name, F.lit("', raise_if_not_found=False)")))
        .when(priority == "4-NOT SPECIFIED", F.concat(F.lit("'"), F.col("o_orderstatus"), F.lit("\\nx'")))
        .otherwise("None")
    )
    kind = (
        F.when(priority.isin("1-URGENT", "2-HIGH"), "ref")
        .when((priority == "5-LOW") & (F.col("o_orderstatus") != "F"), "text").otherwise("eval")
    )
    patch = t.orders.select(
        F.lit("sales").alias("module"), F.col("o_orderkey").alias("record_id"), F.lit("note").alias("field"),
        literal.alias("value"), kind.alias("kind"),
    )
    identity = t.customer.select(F.lit("base").alias("module"), F.col("c_name").alias("name"), F.col("c_custkey").alias("res_id"))
    ref = F.concat(F.lit("ref('base."), name, F.lit("')"))
    known = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"), "leftsemi")
    domain = F.concat(F.lit("str([('owner', 'in', ["), ref, F.lit(", "), ref, F.lit("])])"))
    path = F.concat(F.lit("static/"), F.col("o_orderkey").cast("string"))
    base = [F.lit("sales").alias("module"), F.col("o_orderkey").alias("record_id")]
    domains = known.select(*base, F.lit("domain").alias("field"), domain.alias("value"), F.lit("eval").alias("kind"))
    images = t.orders.select(*base, F.lit("image").alias("field"), path.alias("value"), F.lit("file").alias("kind"))
    files = t.orders.where("o_orderstatus = 'O'").select(path.alias("path"), F.concat(F.lit("bytes of "), F.col("o_orderkey").cast("string")).alias("content"))
    return resolve_values(patch.unionByName(domains).unionByName(images), identity, files=files)


@section.query("a5_snapshot", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS o_orderstatus,
       o_orderstatus AS status_before
FROM orders
""")
def _(t):
    ds = snapshot(Dataset({"orders": t.orders}), "orders", ["o_orderkey", "o_orderstatus"])
    ds = ds.put("orders", map_values(ds["orders"], "o_orderstatus", "o_orderstatus", [("F", "done"), ("O", "open")]))
    now = ds["orders"].select("o_orderkey", "o_orderstatus")
    return attach(now, ds["legacy__orders"], ["o_orderkey"], {"status_before": "o_orderstatus"})


@section.query("a6_append_select", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, NULL, NULL FROM supplier
""")
def _(t):
    rows = t.supplier.select(
        F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_nationkey").alias("c_nationkey")
    )
    return append_select(t.customer, rows)


@section.query("a7_clear_table", "SELECT CAST(0 AS BIGINT) AS rows_left, count(*) AS rows_before FROM orders")
def _(t):
    left = clear_table(t.orders).agg(F.count(F.lit(1)).alias("n"))
    return t.orders.agg(F.count(F.lit(1)).alias("rows_before")).select(left.scalar().alias("rows_left"), "rows_before")


@section.query("a8_create_relation", """
SELECT l_orderkey AS order_id, l_partkey AS part_id, count(*) AS copies FROM lineitem GROUP BY 1, 2
""")
def _(t):
    empty = create_relation(t.spark, "order_id", "part_id")
    pairs = t.lineitem.select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("part_id"))
    return empty.unionByName(pairs).groupBy("order_id", "part_id").agg(F.count(F.lit(1)).alias("copies"))


_DIFF = """
SELECT p_brand AS file, p_brand AS module, 'Fields' AS section, lower(p_type) || '.model' AS model,
       'f_' || p_partkey AS field, 'char' AS type,
       CASE WHEN p_size <= 20 THEN 'NEW' WHEN p_size <= 40 THEN 'DEL' ELSE 'changed' END AS change,
       CASE WHEN p_size <= 20 THEN 'required' WHEN p_size <= 40 THEN NULL ELSE 'is now stored' END AS detail
FROM part
UNION ALL
SELECT p_brand, p_brand, 'XML records', lower(p_type) || '.model', p_brand || '.rec_' || p_partkey, NULL,
       CASE WHEN p_size <= 20 THEN 'NEW' ELSE 'DEL' END, CASE WHEN p_size <= 20 THEN 'noupdate' END
FROM part
"""


def _diff_lines(t):
    part = t.part.withColumn("__m", F.concat(F.lower("p_type"), F.lit(".model")))
    key = F.col("p_partkey").cast("string")
    note = F.when(F.col("p_size") <= 20, "NEW required").when(F.col("p_size") <= 40, "DEL ").otherwise("is now stored")
    fields = part.select(
        F.col("p_brand").alias("file"), F.lit(1).alias("part"), F.col("p_partkey").alias("at"),
        F.concat(F.col("p_brand"), F.lit("     / "), F.col("__m"), F.lit("    / f_"), key, F.lit(" (char)   : "), note).alias("text"),
    )
    records = part.select(
        F.col("p_brand").alias("file"), F.lit(3).alias("part"), F.col("p_partkey").alias("at"),
        F.concat(
            F.when(F.col("p_size") <= 20, "NEW ").otherwise("DEL "), F.col("__m"), F.lit(": "),
            F.col("p_brand"), F.lit(".rec_"), key, F.when(F.col("p_size") <= 20, " (noupdate)").otherwise(""),
        ).alias("text"),
    )
    brands = part.select(F.col("p_brand").alias("file")).distinct()

    def heading(title, place):
        return brands.select(
            "file", F.lit(place).alias("part"), F.lit(0).cast("long").alias("at"),
            F.concat(F.lit(f"---{title} in module '"), F.col("file"), F.lit("'---")).alias("text"),
        )

    lines = fields.unionByName(records).unionByName(heading("Fields", 0)).unionByName(heading("XML records", 2))
    return lines


@section.query("a9_read_schema_diff", _DIFF)
def _(t):
    return parse_diff_lines(_diff_lines(t), ["file"], ["part", "at"])


@section.query("a9_read_schema_diff_files", f"SELECT * EXCLUDE (file) FROM ({_DIFF})")
def _(t):
    ordered = _diff_lines(t).repartition(3, "file").sortWithinPartitions("file", "part", "at").select("text")
    return read_schema_diff(t.spark, _written(t, ordered)).drop("file")


@section.query("a10_read_annotations", """
WITH c AS (
  SELECT *, sum(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS n
  FROM conversations
)
SELECT u.conv_id, u.turn, u.text, a.text AS answer
FROM c u LEFT JOIN c a ON a.conv_id = u.conv_id AND a.role = 'assistant' AND a.n = u.n + 1
WHERE u.role IS DISTINCT FROM 'assistant'
""")
def _(t):
    noted = attach_notes(t.conversations, ["conv_id"], ["turn"], F.col("role") == "assistant", F.col("text"), "answer")
    return noted.select("conv_id", "turn", "text", "answer")


@section.query("a10_read_annotation_files", """
WITH c AS (SELECT *, sum(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations)
SELECT u.conv_id || ':' || u.turn AS line, coalesce('answer ' || u.conv_id || ':' || a.turn, 'end of ' || u.conv_id) AS note
FROM c u LEFT JOIN c a ON a.conv_id = u.conv_id AND a.role = 'assistant' AND a.n = u.n + 1
WHERE u.role IS DISTINCT FROM 'assistant'
""")
def _(t):
    said = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    text = F.when(F.col("role") == "assistant", F.concat(F.lit("# answer "), said)).otherwise(said)
    ends = t.conversations.select("conv_id").distinct().select(
        "conv_id", F.lit(None).cast("long").alias("turn"), F.concat(F.lit("# end of "), F.col("conv_id").cast("string")).alias("text"))
    lines = t.conversations.select("conv_id", "turn", text.alias("text")).unionByName(ends)
    ordered = lines.repartition(3, "conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_last()).select("text")
    return read_annotations(t.spark, _written(t, ordered)).select(F.col("text").alias("line"), "note")


_GRID = """
SELECT replace(p_name, ' ', '_') || '_' || p_partkey AS module,
       CASE WHEN p_type = 'PROMO' THEN 'new' WHEN p_type = 'SMALL' THEN 'del' END AS change,
       CASE WHEN p_size > 25 THEN 'Done' END AS status, 'By ' || p_brand || '.' AS note
FROM part
"""


def _grid_lines(t):
    lines = t.part.select(
        F.concat(
            F.lit("| "), F.when(F.col("p_type") == "PROMO", "|new| ").when(F.col("p_type") == "SMALL", "|del| ").otherwise(""),
            F.replace(F.col("p_name"), F.lit(" "), F.lit("_")), F.lit("_"), F.col("p_partkey").cast("string"),
            F.lit("     |"), F.when(F.col("p_size") > 25, "Done ").otherwise("     "), F.lit("|By "), F.col("p_brand"), F.lit(".  |"),
        ).alias("text")
    )
    rule = t.part.select(F.lit("+------+------+------+").alias("text"))
    return lines.unionByName(rule)


@section.query("a11_read_status_grid", _GRID)
def _(t):
    return parse_status_lines(_grid_lines(t))


@section.query("a11_read_status_grid_files", _GRID)
def _(t):
    return read_status_grid(t.spark, _written(t, _grid_lines(t).repartition(3)))


@section.query("a12_mapping_table", """
SELECT o_orderkey, m.new AS code FROM orders LEFT JOIN
  (VALUES ('1-URGENT', 'u'), ('2-HIGH', 'h'), ('3-MEDIUM', 'm'), ('5-LOW', 'l')) m(old, new)
  ON o_orderpriority = m.old
""")
def _(t):
    codes = mapping_table(t.spark, {"1-URGENT": "u", "2-HIGH": "h", "3-MEDIUM": "m", "5-LOW": "l"})
    return attach(t.orders, codes, [("o_orderpriority", "old")], {"code": "new"}).select("o_orderkey", "code")


@section.query("a13_member_commands", """
SELECT 'base' AS module, o_orderkey AS record_id, CASE WHEN o_orderstatus = 'F' THEN 'replace' ELSE 'add' END AS command,
  'base.c_' || o_custkey AS member FROM orders WHERE o_orderstatus IN ('F', 'O')
UNION ALL SELECT 'base', o_orderkey, 'add', 'other.x' FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'base', o_orderkey, 'replace', NULL FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 200000
""")
def _(t):
    status, key = F.col("o_orderstatus"), F.col("o_custkey").cast("string")
    text = (
        F.when(status == "F", F.concat(F.lit("[Command.set([ref('c_"), key, F.lit("')])]")))
        .when(status == "O", F.concat(F.lit("[(4, ref('base.c_"), key, F.lit("')), (4, ref('other.x'))]")))
        .when(F.col("o_totalprice") > 200000, F.lit("[Command.set([])]")).otherwise("True")
    )
    patch = t.orders.select(F.lit("base").alias("module"), F.col("o_orderkey").alias("record_id"), text.alias("value"), F.lit("eval").alias("kind"))
    return member_commands(patch)


@section.query("a13_apply_member_commands", """
WITH r AS (SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT c_nationkey AS owner, c_custkey AS member FROM customer JOIN r ON n_nationkey = c_nationkey
WHERE r_name NOT IN ('ASIA', 'EUROPE')
UNION
SELECT s_nationkey, -1 - s_suppkey FROM supplier JOIN r ON n_nationkey = s_nationkey
WHERE r_name IN ('ASIA', 'AFRICA')
""")
def _(t):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    pairs = t.customer.select(F.col("c_nationkey").alias("owner"), F.col("c_custkey").alias("member"))
    command = F.when(F.col("r_name") == "ASIA", "replace").when(F.col("r_name") == "AFRICA", "add")
    patch = (
        t.supplier.join(places, F.col("s_nationkey") == F.col("n_nationkey")).where(command.isNotNull())
        .select(F.col("s_nationkey").alias("owner"), command.alias("command"), (F.lit(-1) - F.col("s_suppkey")).alias("member"))
    )
    lists = places.where(F.col("r_name").isin("EUROPE", "ASIA")).select(
        F.col("n_nationkey").alias("owner"), F.lit("replace").alias("command"), F.lit(None).cast("long").alias("member")
    )
    return apply_member_commands(pairs, patch.unionByName(lists), "owner", "member")
