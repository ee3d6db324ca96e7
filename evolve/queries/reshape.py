"""Row generation, entity reshaping, and units of measure."""

from pyspark.sql import functions as F

from evolve.operators import ordered as O
from evolve.operators import reshape as R
from evolve.operators import units as U
from evolve.operators.joins import attach
from evolve.queries.joins import LINE, TIE
from evolve.queries.registry import Section

section = Section()


@section.query("j1_m2o_to_x2m", "SELECT o_orderkey AS order_id, o_custkey AS customer_id FROM orders WHERE o_orderstatus <> 'P'")
def _(t):
    flagged = t.orders.withColumn("buyer", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")))
    return R.m2o_to_x2m(flagged, "o_orderkey", "buyer", ("order_id", "customer_id"))


@section.query("j2_pairs_to_parent", """
WITH pairs AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_suppkey) AS rn FROM pairs),
top AS (SELECT max(p_partkey) AS m FROM part)
SELECT p_partkey, p_name, l_suppkey AS parent_id, NULL AS legacy__p_partkey FROM part LEFT JOIN r ON l_partkey = p_partkey AND rn = 1
UNION ALL
SELECT m + row_number() OVER (ORDER BY p_partkey, l_suppkey), p_name, l_suppkey, p_partkey
FROM part JOIN r ON l_partkey = p_partkey AND rn > 1, top
""")
def _(t):
    pairs = t.lineitem.select("l_partkey", "l_suppkey").distinct()
    return R.pairs_to_parent(t.part.select("p_partkey", "p_name"), pairs, "p_partkey", "l_partkey", "l_suppkey", "parent_id")


@section.query("j3_clone_rows", """
SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY c_custkey) AS c_custkey,
       c_name || ' (copy)' AS c_name, c_nationkey, c_acctbal, 'CLONE' AS c_mktsegment, c_custkey AS legacy__c_custkey
FROM customer WHERE c_acctbal > 5000
""")
def _(t):
    chosen = t.customer.where("c_acctbal > 5000")
    changes = {"c_name": F.concat("c_name", F.lit(" (copy)")), "c_mktsegment": F.lit("CLONE")}
    return R.clone_rows(chosen, changes, "c_custkey", ["c_custkey"], t.customer)


@section.query("j4_clone_last", """
WITH last AS (SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_totalprice FROM orders ORDER BY o_custkey, o_orderdate DESC, o_orderkey DESC)
SELECT (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY o_orderkey) AS o_orderkey, o_custkey, o_totalprice,
       c_name AS o_orderpriority, o_orderkey AS legacy__o_orderkey
FROM last JOIN customer ON c_custkey = o_custkey WHERE c_acctbal > 0
""")
def _(t):
    out = R.clone_last(
        t.customer.where("c_acctbal > 0"), t.orders, ("c_custkey", "o_custkey"),
        [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], "o_orderkey", {"o_orderpriority": F.col("p.c_name")},
    )
    return out.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "legacy__o_orderkey")


def _options(t):
    """Orders as lines of their customer; large ones are options, some of them already placed."""
    lines = t.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("parent"), F.col("o_orderpriority").alias("name"),
        F.length("o_orderpriority").cast("long").alias("sequence"), F.lit(False).alias("is_optional"),
        F.lit(None).cast("string").alias("display_type"),
    )
    options = t.orders.where("o_totalprice > 250000").select(
        F.col("o_orderkey").alias("option"), F.col("o_custkey").alias("parent"),
        F.concat(F.lit("opt "), F.col("o_orderstatus")).alias("name"),
        F.when(F.col("o_orderstatus") != "P", F.floor(F.col("o_totalprice") / 100000)).alias("rank"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")).alias("line_id"),
    )
    return lines, options


def _options_sql(sequence: str, placed: bool) -> str:
    moved = "o_orderstatus = 'F'" if placed else "false"
    return f"""
WITH l AS (SELECT o_orderkey AS id, o_custkey AS parent, o_orderpriority AS name, length(o_orderpriority) AS sequence FROM orders),
top AS (SELECT parent, max(sequence) AS top FROM l GROUP BY 1),
o AS (SELECT o_orderkey AS option, o_custkey AS parent, 'opt ' || o_orderstatus AS name, {sequence} AS seq, {moved} AS placed
      FROM orders JOIN top ON top.parent = o_custkey WHERE o_totalprice > 250000),
fresh AS (
  SELECT parent, NULL AS option, '/' AS name, top + 1 AS seq, true AS opt, 'line_section' AS kind
  FROM top WHERE parent IN (SELECT parent FROM o)
  UNION ALL SELECT parent, option, name, seq, NULL, NULL FROM o WHERE NOT placed)
SELECT l.id, l.parent, l.name, coalesce(o.seq, l.sequence) AS sequence, 'false' AS is_optional, NULL AS display_type
FROM l LEFT JOIN o ON o.option = l.id AND o.placed
UNION ALL
SELECT (SELECT max(id) FROM l) + row_number() OVER (ORDER BY parent, option NULLS FIRST), parent, name, seq, CAST(opt AS VARCHAR), kind FROM fresh
"""


def _folded(t, link, own):
    lines, options = _options(t)
    header = {"name": F.lit("/"), "is_optional": F.lit(True), "display_type": F.lit("line_section")}
    out = R.insert_headers_and_lines(lines, options, "parent", "id", "sequence", "option", link, header, own)
    return out.withColumn("is_optional", F.col("is_optional").cast("string"))


@section.query("j5_insert_headers_and_lines", _options_sql(
    "top + 2 + CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice / 100000) AS BIGINT) ELSE 0 END", True))
def _(t):
    return _folded(t, "line_id", "rank")


@section.query("j5_insert_template_lines", _options_sql("top + 2", False))
def _(t):
    return _folded(t, None, None)


@section.query("j6_cross_children", """
WITH level AS (SELECT DISTINCT ON (p_brand) p_brand, p_partkey FROM part ORDER BY p_brand, p_size, p_partkey)
SELECT DISTINCT o_custkey AS job_id, l_partkey AS skill_id, part.p_brand, level.p_partkey AS level_id
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON part.p_partkey = l_partkey JOIN level ON level.p_brand = part.p_brand
""")
def _(t):
    members = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(F.col("o_custkey").alias("job_id"), F.col("l_partkey").alias("skill_id")).distinct()
    )
    return R.cross_children(
        members, t.part, ("skill_id", "p_partkey"), t.part, "p_brand", "p_partkey",
        [F.col("p_size").asc(), F.col("p_partkey").asc()], "level_id",
    )


@section.query("j7_insert_missing_child", """
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM lineitem
UNION ALL SELECT o_orderkey, 1, NULL, 'D' FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
""")
def _(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    values = {"l_orderkey": F.col("o_orderkey"), "l_linenumber": F.lit(1), "l_returnflag": F.lit("D")}
    return R.insert_missing_child(t.orders, lines, ("o_orderkey", "l_orderkey"), values)


def _groups(t):
    referrers = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_custkey"))
    return R.entities_from_references(referrers, "o_custkey", t.customer, "c_custkey", ["c_name"], "group_id")


@section.query("j8_entities_from_references", """
SELECT row_number() OVER (ORDER BY c_custkey) AS id, c_custkey AS legacy__c_custkey, c_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus <> 'P')
""")
def _(t):
    return _groups(t)[0]


@section.query("j8_referrers_repointed", """
WITH e AS (SELECT row_number() OVER (ORDER BY c_custkey) AS id, c_custkey FROM customer
  WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus <> 'P')),
r AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey FROM orders)
SELECT o_orderkey, o_custkey, e.id AS group_id FROM r LEFT JOIN e ON c_custkey = o_custkey
""")
def _(t):
    return _groups(t)[1]


@section.query("j9_explode_arrays", "SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem")
def _(t):
    packed = O.collect_aligned(t.lineitem, ["l_orderkey"], TIE, ["l_partkey", "l_suppkey"], "items", chunk=4, spread=False)
    return O.explode_aligned(packed, "items").select("l_orderkey", "l_partkey", "l_suppkey")


def _tolerances(t):
    default = t.part.where(F.col("p_partkey") == t.part.agg(F.min("p_partkey").alias("m")).scalar())
    default = default.select(F.lit(1).cast("long").alias("rule_id"), "p_size", "p_type")
    groups = t.part.select("p_partkey", "p_size", "p_type")
    return R.override_if_differs(groups, "p_partkey", ["p_size", "p_type"], default, "rule_id", "rule_id")


_TOLERANCES = """
WITH d AS (SELECT p_size, p_type FROM part ORDER BY p_partkey LIMIT 1),
g AS (SELECT p.*, p.p_size IS DISTINCT FROM d.p_size OR p.p_type IS DISTINCT FROM d.p_type AS differs FROM part p, d),
c AS (SELECT *, 1 + row_number() OVER (ORDER BY p_partkey) AS rule_id FROM g WHERE differs)
"""


@section.query("j10_override_entities", _TOLERANCES + """
SELECT 1 AS rule_id, NULL AS owner, p_size, p_type FROM d UNION ALL SELECT rule_id, p_partkey, p_size, p_type FROM c
""")
def _(t):
    return _tolerances(t)[0]


@section.query("j10_override_if_differs", _TOLERANCES + """
SELECT g.p_partkey, g.p_size, g.p_type, coalesce(c.rule_id, 1) AS rule_id FROM g LEFT JOIN c ON c.p_partkey = g.p_partkey
""")
def _(t):
    return _tolerances(t)[1]


@section.query("j11_split_source", """
SELECT event_id, CASE WHEN value > 20 THEN value ELSE -1.0 END AS value, CASE WHEN value > 20 THEN 'given' ELSE event_type END AS origin FROM events
""")
def _(t):
    given = {"event_id": F.col("event_id"), "value": F.col("value"), "origin": F.lit("given")}
    computed = {"event_id": F.col("event_id"), "value": F.lit(-1.0), "origin": F.col("event_type")}
    return R.split_source(t.events, F.col("value") > 20, given, computed)


@section.query("j12_link_through_entity", """
SELECT l_orderkey AS order_id, l_partkey AS part_id, l_returnflag = 'R' AS returned FROM lineitem
""")
def _(t):
    return R.link_through_entity(t.lineitem, "l_orderkey", "l_partkey", ("order_id", "part_id"), {"returned": F.col("l_returnflag") == "R"})


@section.query("j13_merge_entity", """
SELECT o_orderkey, o_custkey, c_name AS partner_name, c_name AS label, c_mktsegment AS segment FROM orders JOIN customer ON c_custkey = o_custkey
""")
def _(t):
    columns = {"partner_name": "c_name", "label": "c_name", "segment": "c_mktsegment"}
    return R.merge_entity(t.orders.select("o_orderkey", "o_custkey"), t.customer, ("o_custkey", "c_custkey"), columns)


_SPECS = [{"code": "F", "title": "closed"}, {"code": "O", "title": "open"}, {"code": "X", "title": "other"}]


@section.query("j14_ensure_children", """
WITH e AS (SELECT o_custkey AS parent, o_orderstatus AS code, min(o_orderpriority) AS title FROM orders GROUP BY 1, 2)
SELECT parent, code, title FROM e UNION ALL
SELECT c_custkey, s.code, s.title FROM customer CROSS JOIN (VALUES ('F', 'closed'), ('O', 'open'), ('X', 'other')) s(code, title)
WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.parent = c_custkey AND e.code = s.code)
""")
def _(t):
    existing = t.orders.groupBy(F.col("o_custkey").alias("parent"), F.col("o_orderstatus").alias("code")).agg(F.min("o_orderpriority").alias("title"))
    return R.ensure_children(t.customer, "c_custkey", existing, ("parent", "code"), _SPECS)


# Parts as units: a part points to the part of half its key when both are of one type.
def _units(t):
    up = t.part.select(F.col("p_partkey").alias("__k"), F.col("p_type").alias("__t"))
    half = t.part.withColumn("__half", F.floor(F.col("p_partkey") / 2).cast("long"))
    linked = attach(half, up, [("__half", "__k")], ["__t"])
    same = (F.col("__t") == F.col("p_type")) & (F.col("__half") != F.col("p_partkey"))
    return linked.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
        F.when(same, F.col("__half")).alias("relative_id"), F.col("p_size").cast("double").alias("relative_factor"),
    )


_UNITS = """
WITH RECURSIVE u AS (SELECT p.p_partkey AS id, p.p_name AS name, CASE WHEN q.p_type = p.p_type AND q.p_partkey <> p.p_partkey THEN q.p_partkey END AS up,
  CAST(p.p_size AS DOUBLE) AS f FROM part p LEFT JOIN part q ON q.p_partkey = p.p_partkey // 2),
r(id, root, factor) AS (SELECT id, id, CAST(1 AS DOUBLE) FROM u WHERE up IS NULL
  UNION ALL SELECT u.id, r.root, r.factor * u.f FROM u JOIN r ON u.up = r.id)
"""


@section.query("l1_flatten_units", """
WITH u AS (SELECT p_partkey, p_brand, CAST(p_size AS DOUBLE) AS f, p_partkey = min(p_partkey) OVER (PARTITION BY p_brand) AS reference,
  p_type = 'PROMO' AS bigger, p_type = 'SMALL' AS owned, min(p_partkey) OVER (PARTITION BY p_brand) AS ref FROM part)
SELECT p_partkey AS id, CASE WHEN NOT reference AND NOT owned THEN ref END AS relative_id,
       round(CASE WHEN reference OR owned THEN NULL WHEN bigger THEN f ELSE 1.0 / f END, 8) AS relative_factor FROM u
""")
def _(t):
    first = t.part.groupBy("p_brand").agg(F.min("p_partkey").alias("first"))
    parts = attach(t.part, first, ["p_brand"], ["first"])
    kind = F.when(F.col("p_partkey") == F.col("first"), "reference").when(F.col("p_type") == "PROMO", "bigger").otherwise("smaller")
    units = parts.select(
        F.col("p_partkey").alias("id"), F.col("p_brand").alias("category_id"), F.col("p_size").cast("double").alias("factor"),
        kind.alias("uom_type"), (F.col("p_type") == "SMALL").alias("owned"),
    )
    return U.flatten_units(units).select("id", "relative_id", F.round("relative_factor", 8).alias("relative_factor"))


@section.query("l2_unit_family", _UNITS + "SELECT id, root AS family FROM r")
def _(t):
    return U.unit_family(_units(t), "id", "relative_id").select("id", "family")


@section.query("l3_convert_quantity", _UNITS + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(CASE WHEN a.root = b.root THEN l_quantity * a.factor / b.factor END, 6) AS quantity
FROM lineitem LEFT JOIN r a ON a.id = l_partkey LEFT JOIN r b ON b.id = l_partkey // 2
""")
def _(t):
    roots = U.unit_roots(_units(t), "id", "relative_id", "relative_factor")
    lines = t.lineitem.select(*LINE, "l_quantity", F.floor(F.col("l_partkey") / 2).cast("long").alias("to_unit"))
    out = U.convert_quantity(lines, "l_quantity", "l_partkey", "to_unit", roots, "quantity")
    return out.select(*LINE, F.round("quantity", 6).alias("quantity"))


def _packs(t):
    """Orders as packs; a third of them is off by rounding noise."""
    units = _units(t)
    roots = U.unit_roots(units, "id", "relative_id", "relative_factor")
    noise = F.when(F.col("o_orderkey") % 3 == 0, F.lit(1 + 2.0 ** -50)).otherwise(F.lit(1.0))
    packs = t.orders.select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("pack "), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("o_custkey").alias("product_id"), (F.floor(F.col("o_totalprice") / 10000).cast("double") * noise).alias("qty"),
    )
    products = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("unit_id"))
    return U.match_or_create_unit(packs, products, units, roots)


_PACKS = _UNITS + """, pack AS (SELECT o_orderkey AS id, 'pack ' || o_orderkey AS name, o_custkey AS unit,
  floor(o_totalprice / 10000) * CASE WHEN o_orderkey % 3 = 0 THEN 1 + pow(2.0, -50) ELSE 1.0 END AS qty, qty * factor AS size, root FROM orders JOIN r ON r.id = o_custkey),
best AS (SELECT DISTINCT ON (pack.id) pack.id, r.id AS unit_id FROM pack JOIN r ON r.root = pack.root
  AND abs(r.factor - pack.size) <= 1e-9 * greatest(abs(r.factor), abs(pack.size)) ORDER BY pack.id, abs(r.factor - pack.size), r.id),
need AS (SELECT *, lag(size) OVER (PARTITION BY root ORDER BY size, id) AS before FROM pack WHERE id NOT IN (SELECT id FROM best)),
runs AS (SELECT *, sum(CASE WHEN size - before <= 1e-9 * greatest(abs(size), abs(before)) THEN 0 ELSE 1 END)
  OVER (PARTITION BY root ORDER BY size, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM need),
made AS (SELECT (SELECT max(id) FROM u) + row_number() OVER (ORDER BY id) AS unit_id, * FROM (SELECT DISTINCT ON (root, run) * FROM runs ORDER BY root, run, id))
"""


@section.query("l4_match_or_create_unit", _PACKS + """
SELECT pack.id, pack.name, coalesce(best.unit_id, made.unit_id) AS unit_id FROM pack
LEFT JOIN best ON best.id = pack.id LEFT JOIN runs ON runs.id = pack.id LEFT JOIN made ON made.root = runs.root AND made.run = runs.run
""")
def _(t):
    return _packs(t)[0].select("id", "name", "unit_id")


@section.query("l4_created_units", _PACKS + """
SELECT id, name, up AS relative_id, f AS relative_factor FROM u UNION ALL SELECT unit_id, name, unit, qty FROM made
""")
def _(t):
    return _packs(t)[1]
