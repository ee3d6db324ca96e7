"""Record identity and upkeep of reference data."""

from pyspark.sql import functions as F

from evolve.dataset import Dataset
from evolve.functions import documents as D
from evolve.operators import identity as K
from evolve.operators.domains import broken_paths, disable_broken_filters
from evolve.queries.registry import Section
from evolve.storage import mapping_table

section = Section()


def _identity(t):
    """Parts as records: module is the brand, name is made from type and key."""
    return t.part.select(
        F.col("p_brand").alias("module"), F.concat_ws("_", F.lower("p_type"), F.col("p_partkey").cast("string")).alias("name"),
        F.lit("part").alias("model"), F.col("p_partkey").alias("res_id"), (F.col("p_size") > 40).alias("noupdate"),
    )


@section.query("k1_rename_ids", """
SELECT CASE WHEN p_size = 7 THEN 'base' ELSE p_brand END AS module,
       CASE WHEN p_size = 7 THEN 'moved_' || p_partkey ELSE lower(p_type) || '_' || p_partkey END AS name,
       'part' AS model, p_partkey AS res_id, p_size > 40 AS noupdate FROM part
""")
def _(t):
    key = F.col("p_partkey").cast("string")
    renames = t.part.where("p_size = 7").select(
        F.col("p_brand").alias("old_module"), F.concat_ws("_", F.lower("p_type"), key).alias("old_name"),
        F.lit("base").alias("new_module"), F.concat(F.lit("moved_"), key).alias("new_name"),
    )
    return K.rename_ids(_identity(t), renames)


def _merged(t):
    """Parts of one brand and size collapse onto one name; the first key survives."""
    renames = t.part.where("p_type = 'PROMO'").select(
        F.col("p_brand").alias("old_module"),
        F.concat_ws("_", F.lower("p_type"), F.col("p_partkey").cast("string")).alias("old_name"),
        F.col("p_brand").alias("new_module"), F.concat(F.lit("promo_size_"), F.col("p_size").cast("string")).alias("new_name"),
    )
    return K.merge_ids(_identity(t), renames)


@section.query("k2_merged_identity", """
SELECT p_brand AS module, CASE WHEN p_type = 'PROMO' THEN 'promo_size_' || p_size ELSE lower(p_type) || '_' || p_partkey END AS name,
       min(p_partkey) AS res_id FROM part GROUP BY 1, 2
""")
def _(t):
    return _merged(t)[0].select("module", "name", "res_id")


@section.query("k2_merge_ids", """
SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice, CASE WHEN p_type = 'PROMO' THEN first ELSE l_partkey END AS l_partkey
FROM lineitem JOIN (SELECT *, min(p_partkey) OVER (PARTITION BY p_brand, p_size, p_type) AS first FROM part) ON p_partkey = l_partkey
""")
def _(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_partkey")
    return K.repoint(lines, "l_partkey", _merged(t)[1])


@section.query("k3_lookup_id", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_returnflag <> 'R' THEN l_partkey END AS found FROM lineitem
""")
def _(t):
    names = _identity(t).select(F.concat_ws(".", "module", "name").alias("__full"), F.col("res_id").alias("__id"))
    lines = t.lineitem.join(names, F.col("l_partkey") == F.col("__id"))
    ref = F.when(F.col("l_returnflag") != "R", F.col("__full")).otherwise("nowhere.nothing")
    lines = lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", ref.alias("ref"))
    return K.lookup_id(lines, "ref", _identity(t), "found").drop("ref")


@section.query("k4_set_noupdate", """
SELECT p_partkey AS res_id, CASE WHEN p_type = 'SMALL' THEN false ELSE p_size > 40 END AS noupdate FROM part
""")
def _(t):
    names = _identity(t).where(F.col("name").startswith("small_"))
    return K.set_noupdate(_identity(t), names, False).select("res_id", "noupdate")


@section.query("k5_rename_modules", """
SELECT doc_id, CASE source WHEN 'src0' THEN 'web' WHEN 'src1' THEN 'web' WHEN 'src2' THEN 'book' ELSE source END AS source FROM documents
""")
def _(t):
    mapping = mapping_table(t.spark, [("src0", "web"), ("src1", "web"), ("src2", "book")], "old string, new string")
    return K.rename_modules(t.documents.select("doc_id", "source"), "source", mapping)


@section.query("k5_merge_modules", """
SELECT CASE WHEN source IN ('src0', 'src1') THEN 'src3' ELSE source END AS source, n_chars, min(doc_id) AS doc_id FROM documents GROUP BY 1, 2
""")
def _(t):
    mapping = mapping_table(t.spark, [("src0", "src3"), ("src1", "src3")], "old string, new string")
    return K.merge_modules(t.documents.select("source", "n_chars", "doc_id"), "source", mapping, ["n_chars"], [F.col("doc_id").asc()])


@section.query("k6_merge_models", """
WITH m AS (SELECT o_custkey, max(o_orderkey) AS new_id FROM orders GROUP BY 1),
r AS (SELECT event_id, CASE WHEN event_type = 'click' THEN 'customer' ELSE 'other' END AS model, user_id AS res_id FROM events)
SELECT event_id, CASE WHEN model = 'customer' AND new_id IS NOT NULL THEN 'orders' ELSE model END AS model,
       CASE WHEN model = 'customer' AND new_id IS NOT NULL THEN new_id ELSE res_id END AS res_id
FROM r LEFT JOIN m ON o_custkey = res_id
""")
def _(t):
    references = t.events.select(
        "event_id", F.when(F.col("event_type") == "click", "customer").otherwise("other").alias("model"), F.col("user_id").alias("res_id")
    )
    id_map = t.orders.groupBy(F.col("o_custkey").alias("old_id")).agg(F.max("o_orderkey").alias("new_id"))
    return K.merge_models(references, "model", "res_id", "customer", "orders", id_map)


def _deleted(t):
    return K.delete_records_safely(
        t.orders.select("o_orderkey", "o_orderstatus"), "o_orderkey", t.orders.where("o_orderstatus = 'F'"),
        [(t.lineitem.where("l_returnflag = 'R'"), "l_orderkey"), (t.lineitem.where("l_quantity > 45"), "l_orderkey")],
    )


@section.query("k7_delete_records_safely", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'
  OR o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' OR l_quantity > 45)
""")
def _(t):
    return _deleted(t)[0]


@section.query("k7_blocked_records", """
SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' OR l_quantity > 45)
""")
def _(t):
    return _deleted(t)[1]


_TREE = """
WITH RECURSIVE tree AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey > 1 THEN s_suppkey // 2 END AS parent, s_suppkey % 5 <> 0 AS doomed FROM supplier),
line AS (SELECT l_orderkey AS id, min(l_suppkey) AS supplier, min(l_quantity) < 3 AS doomed FROM lineitem GROUP BY 1),
used AS (SELECT supplier AS id, count(*) AS n FROM line WHERE NOT doomed AND id % 200 = 7 GROUP BY 1),
blocked AS (SELECT id, parent FROM tree WHERE doomed AND (id IN (SELECT id FROM used) OR id IN (SELECT parent FROM tree WHERE NOT doomed AND parent IS NOT NULL))
  UNION SELECT t.id, t.parent FROM tree t JOIN blocked b ON b.parent = t.id WHERE t.doomed)
"""


def _peeled(t):
    """Suppliers as a tree, doomed but for each fifth, and lines of some orders that refer to them, some doomed too."""
    tree = t.supplier.select(F.col("s_suppkey").alias("id"), F.when(F.col("s_suppkey") > 1, F.floor(F.col("s_suppkey") / 2).cast("long")).alias("parent"))
    line = t.lineitem.groupBy(F.col("l_orderkey").alias("id")).agg(F.min("l_suppkey").alias("supplier"), (F.min("l_quantity") < 3).alias("doomed"))
    line = line.where("doomed or id % 200 = 7")
    doomed = tree.where("id % 5 <> 0").select(F.lit("tree").alias("model"), "id").unionByName(line.where("doomed").select(F.lit("line").alias("model"), "id"))
    ds = Dataset({"tree": tree, "line": line})
    return K.delete_in_order(ds, {"tree": "id", "line": "id"}, doomed, [("tree", "parent", "tree"), ("line", "supplier", "tree")])


@section.query("k7_delete_in_order", _TREE + """
SELECT 'tree' AS model, id FROM tree WHERE NOT doomed OR id IN (SELECT id FROM blocked) UNION ALL SELECT 'line', id FROM line WHERE NOT doomed AND id % 200 = 7
""")
def _(t):
    ds, _ = _peeled(t)
    return ds["tree"].select(F.lit("tree").alias("model"), "id").unionByName(ds["line"].select(F.lit("line").alias("model"), "id"))


@section.query("k7_blocked_in_order", _TREE + """
SELECT b.id, coalesce(any_value(u.n), 0) + count(c.id) AS uses FROM blocked b LEFT JOIN used u ON u.id = b.id
LEFT JOIN tree c ON c.parent = b.id AND (NOT c.doomed OR c.id IN (SELECT id FROM blocked)) GROUP BY 1
""")
def _(t):
    return _peeled(t)[1].select(F.col("id").cast("long").alias("id"), "uses")


@section.query("k2_closed_merges", """
WITH RECURSIVE e AS (SELECT p_partkey AS old_id, p_partkey // 2 AS new_id FROM part WHERE p_partkey % 3 <> 0 AND p_partkey > 0 AND p_partkey <> p_partkey // 2),
w AS (SELECT old_id, new_id FROM e UNION ALL SELECT w.old_id, e.new_id FROM w JOIN e ON w.new_id = e.old_id),
ends AS (SELECT old_id, new_id FROM w WHERE new_id NOT IN (SELECT old_id FROM e))
SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice, coalesce(new_id, l_partkey) AS l_partkey FROM lineitem LEFT JOIN ends ON old_id = l_partkey
""")
def _(t):
    """Merges of odd and of even numbers come in two lists, and go on through both."""
    merges = t.part.where("p_partkey % 3 <> 0 and p_partkey > 0").select(
        F.lit("part").alias("model"), F.col("p_partkey").alias("old_id"), F.floor(F.col("p_partkey") / 2).cast("long").alias("new_id"))
    closed = K.closed_merges([merges.where("old_id % 2 = 1"), merges.where("old_id % 2 = 0")])
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_partkey")
    return K.repoint_all(Dataset({"line": lines}), [("line", "l_partkey", "part")], closed)["line"]


@section.query("k8_drop_translations", """
SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000) THEN '{"en_US":"' || c_name || '"}'
  ELSE '{"en_US":"' || c_name || '","fr_FR":"' || c_mktsegment || '"}' END AS label FROM customer
""")
def _(t):
    texts = F.create_map(F.lit("fr_FR"), F.col("c_mktsegment"), F.lit("en_US"), F.col("c_name"))
    base = t.customer.select("c_custkey", texts.alias("label"))
    listed = t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    out = K.drop_translations(base, "c_custkey", listed, ["label"])
    return out.select("c_custkey", D.sorted_json(F.col("label")).alias("label"))


@section.query("k9_clear_transient", """
SELECT 'events' AS name, CAST(0 AS BIGINT) AS rows_left, count(*) AS rows_before FROM events
UNION ALL SELECT 'labels', CAST(0 AS BIGINT), count(*) FROM labels UNION ALL SELECT 'part', count(*), count(*) FROM part
""")
def _(t):
    before = Dataset({"events": t.events, "labels": t.labels, "part": t.part})
    after = K.clear_transient(before, ["events", "labels", "absent"])
    rows = None
    for name in before:
        left = after[name].agg(F.count(F.lit(1)).alias("n")).scalar()
        row = before[name].agg(F.count(F.lit(1)).alias("rows_before")).select(F.lit(name).alias("name"), left.alias("rows_left"), "rows_before")
        rows = row if rows is None else rows.unionByName(row)
    return rows


@section.query("k10_disable_invalid_filters", r"""
WITH w AS (SELECT p_partkey, p_brand, unnest(string_split(p_name, ' ')) AS word FROM part),
known AS (SELECT p_brand, unnest(string_split(p_name, ' ')) AS word FROM part WHERE p_size > 12)
SELECT p_partkey, p_partkey NOT IN (SELECT p_partkey FROM w WHERE NOT EXISTS
  (SELECT 1 FROM known k WHERE k.p_brand = w.p_brand AND k.word = w.word)) AS active FROM part
""")
def _(t):
    text = F.concat(F.lit("[('"), F.replace("p_name", F.lit(" "), F.lit("', '=', 1), ('")), F.lit("', '=', 1)]"))
    filters = t.part.select("p_partkey", "p_brand", text.alias("domain"), F.lit(True).alias("active"))
    fields = t.part.where("p_size > 12").select(F.col("p_brand").alias("model"), F.explode(F.split("p_name", " ")).alias("name"))
    out = K.disable_invalid_filters(filters, "p_partkey", "domain", "p_brand", r"\('(\w+)'", fields.distinct(), "active")
    return out.select("p_partkey", "active")


_PATHS = """
WITH f AS (SELECT p_partkey, p_brand, p_type, list_value('size', 'supplier.' || lower(p_type), 'supplier.nation.name') AS paths FROM part),
p AS (SELECT p_partkey, p_brand, unnest(paths) AS path FROM f),
r AS (SELECT DISTINCT p_partkey, path, CASE WHEN path = 'size' AND p_brand LIKE '%1' THEN 'size' WHEN path LIKE 'supplier.%' AND p_brand LIKE '%2' THEN 'supplier'
    WHEN path = 'supplier.promo' THEN 'promo' WHEN path = 'supplier.nation.name' AND p_brand LIKE '%3' THEN 'name' END AS step,
  CASE WHEN path = 'size' OR p_brand LIKE '%2' THEN p_brand WHEN path = 'supplier.promo' THEN CASE WHEN p_brand LIKE '%3' THEN 'vendor' ELSE 'supplier' END ELSE 'region' END AS on_model FROM p)
"""


def _filters(t):
    """Saved filters of every part, and the fields that the models of its brand know."""
    text = F.concat(F.lit("[('size', '>', 1), '|', ('supplier."), F.lower("p_type"), F.lit("', '=', 'size'), ('supplier.nation.name', 'in', ['supplier.gone'])]"))
    filters = t.part.select("p_partkey", "p_brand", text.alias("domain"), F.lit(True).alias("active"))
    brands = t.part.select(F.col("p_brand").alias("model")).distinct()
    last = F.right("model", F.lit(1))
    own = brands.where(last != "1").select("model", F.lit("size").alias("name"), F.lit(None).cast("string").alias("relation"))
    ref = brands.where(last != "2").select("model", F.lit("supplier").alias("name"), F.when(last == "3", "vendor").otherwise("supplier").alias("relation"))
    types = t.part.select(F.lower("p_type").alias("name")).distinct().where("name <> 'promo'")
    both = F.explode(F.array(F.lit("supplier"), F.lit("vendor")))
    kinds = types.select(both.alias("model"), "name", F.lit(None).cast("string").alias("relation"))
    rest = t.spark.createDataFrame([("supplier", "nation", "nation"), ("vendor", "nation", "region"), ("nation", "name", None)], "model string, name string, relation string")
    fields = own.unionByName(ref).unionByName(kinds).unionByName(rest)
    return filters, fields


@section.query("k10_broken_paths", _PATHS + "SELECT p_partkey, path, step, on_model FROM r WHERE step IS NOT NULL")
def _(t):
    """The first step of each path that is gone, with the model it was looked for in."""
    filters, fields = _filters(t)
    return broken_paths(filters, "p_partkey", "domain", "p_brand", fields)


@section.query("k10_disable_broken_paths", _PATHS + "SELECT p_partkey, p_partkey NOT IN (SELECT p_partkey FROM r WHERE step IS NOT NULL) AS active FROM part")
def _(t):
    filters, fields = _filters(t)
    return disable_broken_filters(filters, "p_partkey", "domain", "p_brand", fields, "active").select("p_partkey", "active")


@section.query("k11_clear_demo_flag", """
SELECT p_partkey, CASE WHEN EXISTS (SELECT 1 FROM part WHERE p_name = 'red widget' AND p_size > 10) THEN false ELSE p_size > 25 END AS demo FROM part
""")
def _(t):
    modules = t.part.select("p_partkey", "p_name", "p_size", (F.col("p_size") > 25).alias("demo"))
    due = (F.col("p_name") == "red widget") & (F.col("p_size") > 10)
    return K.clear_demo_flag(modules, due, "demo").select("p_partkey", "demo")


@section.query("k12_propagate_auto_install", """
WITH m AS (SELECT p_partkey, p_name, CASE WHEN p_size > 30 THEN 'installed' ELSE 'uninstalled' END AS state, p_type <> 'LARGE' AS auto,
  p_brand || '.' || p_partkey AS name FROM part),
d AS (SELECT DISTINCT l_partkey AS part, l_suppkey AS dep FROM lineitem)
SELECT m.p_partkey, CASE WHEN auto AND state = 'uninstalled' AND name NOT LIKE 'Brand#1%' AND NOT EXISTS (
  SELECT 1 FROM d LEFT JOIN m q ON q.p_partkey = d.dep WHERE d.part = m.p_partkey AND q.state IS DISTINCT FROM 'installed')
  THEN 'to install' ELSE state END AS state FROM m
""")
def _(t):
    names = t.part.select("p_partkey", F.concat_ws(".", "p_brand", F.col("p_partkey").cast("string")).alias("name"))
    modules = t.part.select(
        "p_partkey", F.when(F.col("p_size") > 30, "installed").otherwise("uninstalled").alias("state"),
        (F.col("p_type") != "LARGE").alias("auto"), F.concat_ws(".", "p_brand", F.col("p_partkey").cast("string")).alias("name"),
    )
    lines = t.lineitem.select("l_partkey", "l_suppkey").distinct()
    a, b = names.alias("a"), names.alias("b")
    deps = (
        lines.join(a, F.col("l_partkey") == F.col("a.p_partkey"))
        .join(b, F.col("l_suppkey") == F.col("b.p_partkey"), "left")
        .select(F.col("a.name").alias("module"), F.col("b.name").alias("depends_on"))
    )
    out = K.propagate_auto_install(modules, deps, "name", "state", "auto", ["installed", "to install"], "Brand#1")
    return out.select("p_partkey", "state")


@section.query("k13_exclude_versions", """
SELECT DISTINCT l_partkey AS module, l_suppkey AS version FROM lineitem
EXCEPT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A'
""")
def _(t):
    steps = t.lineitem.select(F.col("l_partkey").alias("module"), F.col("l_suppkey").alias("version"), "l_returnflag")
    return K.exclude_versions(steps.drop("l_returnflag").distinct(), steps.where("l_returnflag = 'A'"))


@section.query("k14_follow_upstream", r"""
WITH up AS (SELECT source, min(doc_id) AS doc FROM documents GROUP BY 1),
u AS (SELECT up.source, d.text FROM up JOIN documents d ON d.doc_id = up.doc)
SELECT d.doc_id, trim(regexp_replace(d.text, '\s+', ' ', 'g')) = trim(regexp_replace(u.text, '\s+', ' ', 'g')) AS unmodified,
  CASE WHEN trim(regexp_replace(d.text, '\s+', ' ', 'g')) = trim(regexp_replace(u.text, '\s+', ' ', 'g')) THEN upper(u.source) ELSE d.text END AS text
FROM documents d JOIN u ON u.source = d.source
""")
def _(t):
    first = t.documents.groupBy("source").agg(F.min("doc_id").alias("__doc"))
    upstream = t.documents.join(first.drop("source"), F.col("doc_id") == F.col("__doc"), "left_semi").select("source", "text")
    copies = t.documents.select("doc_id", "source", "text")
    marked = K.mark_unmodified(copies, upstream, ("source", "source"), "text", "unmodified")
    fresh = upstream.withColumn("text", F.upper("source"))
    out = K.follow_upstream(marked, fresh, ("source", "source"), "text", "unmodified")
    return out.select("doc_id", "unmodified", "text")


@section.query("k15_reassign_reference", """
SELECT c_custkey, CASE c_nationkey WHEN 3 THEN 4 ELSE c_nationkey END AS c_nationkey,
  CASE WHEN c_nationkey = 3 AND c_mktsegment = 'BUILDING' THEN 'moved' WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END AS note FROM customer
""")
def _(t):
    base = t.customer.select(
        "c_custkey", "c_nationkey", F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment")).alias("note")
    )
    return K.reassign_reference(base, "c_nationkey", 3, 4, fill=("note", "moved"))


@section.query("k16_unlink_and_set_members", """
SELECT c_nationkey AS owner, c_custkey AS member FROM customer WHERE c_acctbal >= 0
  AND c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)
UNION ALL SELECT s_nationkey, s_suppkey FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE n_regionkey = 2
""")
def _(t):
    pairs = t.customer.select(F.col("c_nationkey").alias("owner"), F.col("c_custkey").alias("member"))
    leaving = t.customer.where("c_acctbal < 0").select(F.col("c_nationkey").alias("owner"), F.col("c_custkey").alias("member"))
    left = K.unlink_member(pairs, leaving, "owner", "member")
    owners = t.nation.where("n_regionkey = 2").select(F.col("n_nationkey").alias("owner"))
    members = t.supplier.select(F.col("s_nationkey").alias("owner"), F.col("s_suppkey").alias("member"))
    members = members.join(owners, "owner", "left_semi")
    return K.set_members(left, members, owners, "owner")


@section.query("k17_clear_column", """
SELECT c_custkey, CASE WHEN c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000) THEN c_nationkey END AS c_nationkey,
  c_mktsegment FROM customer
""")
def _(t):
    listed = t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return K.clear_column(t.customer.select("c_custkey", "c_nationkey", "c_mktsegment"), "c_custkey", listed, ["c_nationkey"])


@section.query("k18_delete_where_related", """
SELECT event_id, user_id, event_type FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3)
""")
def _(t):
    parents = t.customer.where("c_nationkey = 3")
    return K.delete_where_related(t.events, "user_id", parents, "c_custkey").select("event_id", "user_id", "event_type")


def _templated(t):
    """Part types as templates of orders; the other priorities name a template nobody knows."""
    templates = t.part.where("p_size > 40").groupBy(F.upper("p_type").alias("template")).agg(F.max("p_name").alias("account"), F.max("p_brand").alias("income"))
    kind = F.when(F.col("o_orderpriority") == "5-LOW", "SMALL").when(F.col("o_orderpriority") == "2-HIGH", "PROMO").otherwise(F.col("o_orderpriority"))
    entities = t.orders.select(
        "o_orderkey", kind.alias("template"), F.when(F.col("o_orderstatus") == "F", "set").alias("account"), F.lit(None).cast("string").alias("income")
    )
    return K.fill_from_template(entities, "template", templates, ["account", "income"])


_TEMPLATED = """
WITH tpl AS (SELECT upper(p_type) AS template, max(p_name) AS account, max(p_brand) AS income FROM part WHERE p_size > 40 GROUP BY 1),
e AS (SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN 'SMALL' WHEN '2-HIGH' THEN 'PROMO' ELSE o_orderpriority END AS template,
  CASE WHEN o_orderstatus = 'F' THEN 'set' END AS account FROM orders)
"""


@section.query("k19_fill_from_template", _TEMPLATED + """
SELECT o_orderkey, e.template, coalesce(e.account, tpl.account) AS account, tpl.income FROM e LEFT JOIN tpl ON tpl.template = e.template
""")
def _(t):
    return _templated(t)[0]


@section.query("k19_unknown_templates", _TEMPLATED + """
SELECT template, count(*) AS skipped FROM e WHERE template NOT IN (SELECT template FROM tpl) GROUP BY 1
""")
def _(t):
    return _templated(t)[1]
