"""Joins, aggregates, windows, sorts and set operations."""

from pyspark.sql import functions as F

from evolve.operators import groups as G
from evolve.operators import joins as J
from evolve.operators import ordered as O
from evolve.queries.registry import Section

section = Section()

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
# Lines have no key; this order is unique over whole rows.
TIE = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity"]
TIE_SQL = ", ".join(TIE)


def _day(c):
    return F.date_format(c, "yyyy-MM-dd")


def _ten_thousandths(c):
    """Cut, not rounded: engines differ on how they round a tie."""
    return F.floor(F.col(c) * 10000).cast("long").alias(c)


@section.query("e1_update_from", """
SELECT o_orderkey, o_orderstatus, CASE WHEN c_mktsegment = 'BUILDING' AND o_orderstatus = 'F' THEN c_name ELSE 'none' END AS buyer
FROM orders LEFT JOIN customer ON c_custkey = o_custkey
""")
def _(t):
    target = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.lit("none").alias("buyer"))
    source = t.customer.where("c_mktsegment = 'BUILDING'")
    out = J.update_from(
        target, source, [("o_custkey", "c_custkey")], {"buyer": F.col("s.c_name")},
        where=F.col("t.o_orderstatus") == "F", unique=True,
    )
    return out.drop("o_custkey")


@section.query("e2_update_over_hops", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, n_name FROM lineitem
JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
""")
def _(t):
    source = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("o_orderkey", "n_name")
    )
    return J.update_from(
        t.lineitem.select(*LINE), source, [("l_orderkey", "o_orderkey")], {"n_name": F.col("s.n_name")}, unique=True
    )


@section.query("e3_fallback_chain", """
SELECT c_custkey, coalesce(n_name, s_name, 'none') AS zone FROM customer
LEFT JOIN (SELECT * FROM nation WHERE n_regionkey = 2) n ON n_nationkey = c_nationkey
LEFT JOIN supplier ON s_suppkey = c_custkey
""")
def _(t):
    hops = [
        (t.nation.where("n_regionkey = 2"), [("c_nationkey", "n_nationkey")], "n_name"),
        (t.supplier, [("c_custkey", "s_suppkey")], "s_name"),
    ]
    return J.fallback_chain(t.customer, "zone", hops, "none").select("c_custkey", "zone")


@section.query("e4_join_on_several_keys", """
WITH m AS (SELECT l_partkey, l_suppkey, l_returnflag, max(l_extendedprice) AS top FROM lineitem GROUP BY 1, 2, 3)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, m.top FROM lineitem l
JOIN m ON m.l_partkey = l.l_partkey AND m.l_suppkey = l.l_suppkey AND m.l_returnflag = l.l_returnflag
""")
def _(t):
    keys = ["l_partkey", "l_suppkey", "l_returnflag"]
    best = G.aggregate_by(t.lineitem, keys, {"best": F.max("l_extendedprice")})
    out = J.update_from(t.lineitem.select(*LINE, "l_returnflag"), best, keys, {"top": F.col("s.best")}, reduced=True)
    return out.drop("l_returnflag")


@section.query("e5_range_self_join", """
SELECT a.l_orderkey, a.l_linenumber, a.l_partkey, a.l_suppkey,
  CAST(floor(CAST(sum(CAST(b.l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) / CAST(sum(CAST(b.l_quantity AS DECIMAL(18,4))) AS DOUBLE) * 10000) AS BIGINT) AS ratio
FROM (SELECT *, row_number() OVER () AS row FROM lineitem) a JOIN lineitem b ON a.l_partkey = b.l_partkey AND a.l_shipdate >= b.l_shipdate
GROUP BY a.l_orderkey, a.l_linenumber, a.l_partkey, a.l_suppkey, a.l_shipdate, a.l_extendedprice, a.l_quantity, a.row
""")
def _(t):
    per_time = O.running_ratio(t.lineitem, ["l_partkey"], "l_shipdate", "l_extendedprice", "l_quantity", "ratio")
    out = J.attach(t.lineitem, per_time, ["l_partkey", "l_shipdate"], ["ratio"], null_safe=True)
    return out.select(*LINE, _ten_thousandths("ratio"))


@section.query("e6_null_safe_join", """
SELECT event_id, m.top FROM (SELECT event_id, nullif(event_type, 'click') AS kind FROM events) e
JOIN (SELECT nullif(event_type, 'click') AS kind, max(value) AS top FROM events GROUP BY 1) m ON e.kind IS NOT DISTINCT FROM m.kind
""")
def _(t):
    events = t.events.select("event_id", F.nullif("event_type", F.lit("click")).alias("kind"), "value")
    best = G.aggregate_by(events, ["kind"], {"best": F.max("value")})
    out = J.update_from(events, best, ["kind"], {"top": F.col("s.best")}, reduced=True, null_safe=True)
    return out.select("event_id", "top")


@section.query("e7_wildcard_key", """
WITH s AS (SELECT s_suppkey, CASE WHEN s_acctbal >= 0 THEN s_nationkey END AS place FROM supplier),
c AS (SELECT c_nationkey, c_name, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn,
      row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS overall FROM customer)
SELECT s_suppkey, c_name AS partner FROM s LEFT JOIN c ON (place = c_nationkey AND rn = 1) OR (place IS NULL AND overall = 1)
""")
def _(t):
    target = t.supplier.select("s_suppkey", F.when(F.col("s_acctbal") >= 0, F.col("s_nationkey")).alias("place"))
    pick = [F.col("c_acctbal").desc(), F.col("c_custkey").asc()]
    out = J.update_wildcard(target, t.customer, ("place", "c_nationkey"), {"partner": F.col("s.c_name")}, pick)
    return out.select("s_suppkey", "partner")


@section.query("e8_coalesced_key", """
SELECT c_custkey, n_name FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey
LEFT JOIN nation ON n_nationkey = coalesce(s_nationkey, c_nationkey)
""")
def _(t):
    keyed = J.attach(t.customer, t.supplier, [("c_custkey", "s_suppkey")], ["s_nationkey"])
    out = J.update_on_first_key(keyed, t.nation, ["s_nationkey", "c_nationkey"], "n_nationkey", {"n_name": F.col("s.n_name")})
    return out.select("c_custkey", "n_name")


@section.query("e9_semi_join", """
SELECT o_orderkey, o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AS returned
FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
""")
def _(t):
    used = J.keep_related(t.orders.select("o_orderkey"), t.lineitem, [("o_orderkey", "l_orderkey")])
    return J.flag_related(used, t.lineitem.where("l_returnflag = 'R'"), [("o_orderkey", "l_orderkey")], "returned")


@section.query("e10_exists_with_join", """
SELECT p_partkey, p_name FROM part WHERE EXISTS (
  SELECT 1 FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
  JOIN region ON r_regionkey = n_regionkey WHERE l_partkey = p_partkey AND l_returnflag = 'R' AND r_name = 'ASIA')
""")
def _(t):
    asian = (
        t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region.where("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    returned = J.keep_related(t.lineitem.where("l_returnflag = 'R'"), asian, [("l_suppkey", "s_suppkey")])
    return J.keep_related(t.part, returned, [("p_partkey", "l_partkey")]).select("p_partkey", "p_name")


@section.query("e11_anti_join", """
SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
""")
def _(t):
    return J.drop_related(t.orders, t.lineitem, [("o_orderkey", "l_orderkey")]).select("o_orderkey")


@section.query("e11_not_in", """
SELECT nullif(o_orderpriority, '5-LOW') AS priority, o_orderkey FROM orders
WHERE nullif(o_orderpriority, '5-LOW') NOT IN (SELECT '2-HIGH' FROM lineitem WHERE l_quantity > 10)
  AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
""")
def _(t):
    orders = t.orders.select(F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"), "o_orderkey")
    high = t.lineitem.where("l_quantity > 10").select(F.lit("2-HIGH").alias("p"))
    out = J.not_in(orders, high, "priority", "p")
    return J.not_in(out, t.lineitem.where("l_returnflag = 'R'"), "o_orderkey", "l_orderkey")


@section.query("e12_best_match", f"""
SELECT o_orderkey, l_partkey AS part, l_linenumber AS line FROM orders LEFT JOIN (
  SELECT DISTINCT ON (l_orderkey) l_orderkey, l_partkey, l_linenumber FROM lineitem
  ORDER BY l_orderkey, l_shipdate DESC, {TIE_SQL}) ON l_orderkey = o_orderkey
""")
def _(t):
    order = [F.col("l_shipdate").desc(), *[F.col(c).asc() for c in TIE]]
    out = J.best_match(
        t.orders.select("o_orderkey"), t.lineitem, [("o_orderkey", "l_orderkey")], order,
        {"part": "l_partkey", "line": "l_linenumber"},
    )
    return out


@section.query("e13_update_only_null", """
SELECT event_id, CASE WHEN event_type = 'error' THEN m.top ELSE value END AS value FROM events e
LEFT JOIN (SELECT user_id, max(value) AS top FROM events WHERE event_type <> 'error' GROUP BY 1) m ON m.user_id = e.user_id
""")
def _(t):
    holes = t.events.withColumn("value", F.when(F.col("event_type") != "error", F.col("value"))).select("event_id", "user_id", "value")
    best = G.aggregate_by(holes, ["user_id"], {"best": F.max("value")})
    return J.update_from(holes, best, ["user_id"], {"value": F.col("s.best")}, reduced=True, only_null=True).drop("user_id")


@section.query("e14_conditional_join", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey
AND ((o_orderstatus = 'F' AND l_returnflag = 'R') OR (o_orderstatus = 'O' AND l_linestatus = 'O') OR (o_orderstatus = 'P' AND l_quantity > 30))
""")
def _(t):
    status, c = F.col("s.o_orderstatus"), F.col
    rule = (
        ((status == "F") & (c("t.l_returnflag") == "R")) | ((status == "O") & (c("t.l_linestatus") == "O"))
        | ((status == "P") & (c("t.l_quantity") > 30))
    )
    return J.join_with_rule(t.lineitem, t.orders, [("l_orderkey", "o_orderkey")], rule).select(*LINE, "o_custkey")


@section.query("e15_match_tuple", """
SELECT p_partkey, EXISTS (SELECT 1 FROM part q WHERE q.p_retailprice < 950 AND q.p_brand = p.p_brand AND q.p_size = p.p_size) AS cheap_pair FROM part p
""")
def _(t):
    cheap = t.part.where("p_retailprice < 950")
    return J.flag_tuple(t.part, cheap, ["p_brand", "p_size"], "cheap_pair").select("p_partkey", "cheap_pair")


@section.query("e16_relate", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey
  JOIN supplier ON s_suppkey = l_suppkey WHERE s_acctbal < 0)
""")
def _(t):
    start = t.supplier.where("s_acctbal < 0")
    hops = [(t.lineitem, "s_suppkey", "l_suppkey"), (t.orders, "l_orderkey", "o_orderkey"), (t.customer, "o_custkey", "c_custkey")]
    return J.relate(start, hops).select("c_custkey", "c_name")


@section.query("e17_pair_from_condition", """
SELECT DISTINCT n_nationkey AS nation_id, s_suppkey AS supplier_id FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
JOIN nation ON n_nationkey = s_nationkey WHERE s_acctbal > 0 AND l_returnflag = 'R'
""")
def _(t):
    lines = t.lineitem.where("l_returnflag = 'R'").select("l_suppkey")
    located = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return J.pair_from_condition(
        lines, located, [("l_suppkey", "s_suppkey")],
        {"nation_id": F.col("s.n_nationkey"), "supplier_id": F.col("s.s_suppkey")}, where=F.col("s.s_acctbal") > 0,
    )


@section.query("e18_metadata_default", """
WITH d AS (SELECT c_mktsegment AS key, c_nationkey AS owner, max(c_name) AS value FROM customer WHERE c_acctbal > 9000 GROUP BY 1, 2
  UNION ALL SELECT c_mktsegment, NULL, min(c_name) FROM customer WHERE c_mktsegment <> 'BUILDING' GROUP BY 1)
SELECT c_custkey, coalesce(a.value, b.value) AS account FROM customer
LEFT JOIN d a ON a.key = c_mktsegment AND a.owner = c_nationkey LEFT JOIN d b ON b.key = c_mktsegment AND b.owner IS NULL
""")
def _(t):
    key = F.col("c_mktsegment").alias("key")
    own = t.customer.where("c_acctbal > 9000").groupBy(key, F.col("c_nationkey").alias("owner")).agg(F.max("c_name").alias("value"))
    common = t.customer.where("c_mktsegment <> 'BUILDING'").groupBy(key).agg(F.min("c_name").alias("value"))
    defaults = own.unionByName(common.withColumn("owner", F.lit(None).cast("int")))
    return J.resolve_default(t.customer, defaults, "c_mktsegment", "c_nationkey", "account").select("c_custkey", "account")


@section.query("e19_update_with_pick", """
SELECT c_custkey, c_name, o_orderpriority AS priority, strftime(o_orderdate, '%Y-%m-%d') AS last_date FROM customer LEFT JOIN (
  SELECT DISTINCT ON (o_custkey) * FROM orders ORDER BY o_custkey, o_orderdate DESC, o_orderkey DESC) ON o_custkey = c_custkey
""")
def _(t):
    return J.update_from(
        t.customer.select("c_custkey", "c_name"), t.orders, [("c_custkey", "o_custkey")],
        {"priority": F.col("s.o_orderpriority"), "last_date": _day(F.col("s.o_orderdate"))},
        pick=[F.col("o_orderdate").desc(), F.col("o_orderkey").desc()],
    )


@section.query("f1_sum_by_key", """
SELECT o_orderkey, CAST(sum(CAST(l_quantity AS DECIMAL(18,4))) AS DOUBLE) AS quantity, count(l_orderkey) AS lines
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1
""")
def _(t):
    out = G.aggregate_onto(
        t.orders.select("o_orderkey", F.lit(0).cast("long").alias("lines")), t.lineitem, ("o_orderkey", "l_orderkey"),
        {"quantity": G.exact_sum(F.col("l_quantity")), "lines": F.count(F.lit(1))},
    )
    return out


@section.query("f2_max_by_key", "SELECT l_orderkey, max(l_linenumber) AS last_line FROM lineitem GROUP BY 1")
def _(t):
    return G.aggregate_by(t.lineitem, ["l_orderkey"], {"last_line": F.max("l_linenumber")})


@section.query("f3_coalesce_of_mins", """
SELECT user_id, coalesce(min(CASE WHEN event_type = 'error' AND value > 30 THEN value END), min(CASE WHEN event_type = 'signup' THEN value END), min(value)) AS first_value
FROM events GROUP BY 1
""")
def _(t):
    kind, value = F.col("event_type"), F.col("value")
    parts = t.events.select(
        "user_id", F.when((kind == "error") & (value > 30), value).alias("a"), F.when(kind == "signup", value).alias("b"), "value"
    )
    return G.coalesce_mins(parts, ["user_id"], ["a", "b", "value"], "first_value")


@section.query("f4_parallel_arrays", f"""
SELECT l_orderkey, CAST((rn - 1) // 4 AS BIGINT) AS chunk, string_agg(l_partkey || ':' || l_suppkey, ',' ORDER BY rn) AS pairs
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {TIE_SQL}) AS rn FROM lineitem) GROUP BY 1, 2
""")
def _(t):
    packed = O.collect_aligned(t.lineitem, ["l_orderkey"], TIE, ["l_partkey", "l_suppkey"], "items", chunk=4, spread=False)
    text = F.transform("items", lambda x: F.concat_ws(":", x["l_partkey"].cast("string"), x["l_suppkey"].cast("string")))
    return packed.select("l_orderkey", "chunk", F.array_join(text, ",").alias("pairs"))


@section.query("f5_all_equal", """
SELECT l_orderkey, bool_and(coalesce(nullif(l_linestatus, 'X') = 'O' AND l_returnflag <> 'A', false)) AS reusable FROM lineitem GROUP BY 1
""")
def _(t):
    use = t.lineitem.select("l_orderkey", F.when(F.col("l_returnflag") != "A", F.col("l_linestatus")).alias("use"))
    return G.all_equal(use, ["l_orderkey"], "use", "O", "reusable")


@section.query("f6_any_and_all", """
SELECT o_custkey, bool_or(o_totalprice > 400000) AS any_large, bool_and(o_totalprice > 50000) AS all_large FROM orders GROUP BY 1
""")
def _(t):
    price = F.col("o_totalprice")
    return G.any_and_all(t.orders, ["o_custkey"], {"any_large": price > 400000}, {"all_large": price > 50000})


@section.query("f7_most_frequent", """
SELECT o_custkey, priority FROM (SELECT o_custkey, priority, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, priority ASC NULLS LAST) AS rn
  FROM (SELECT o_custkey, nullif(o_orderpriority, '5-LOW') AS priority, count(*) AS n FROM orders GROUP BY 1, 2)) WHERE rn = 1
""")
def _(t):
    base = t.orders.select("o_custkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("p"))
    return G.most_frequent(base, ["o_custkey"], "p", "priority")


@section.query("f8_ratio_of_sums", """
SELECT l_partkey, CAST(floor(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) / CAST(sum(CAST(l_quantity AS DECIMAL(18,4))) AS DOUBLE) * 10000) AS BIGINT) AS price
FROM lineitem GROUP BY 1 HAVING sum(l_quantity) <> 0
""")
def _(t):
    out = G.ratio_of_sums(t.lineitem, ["l_partkey"], F.col("l_extendedprice"), F.col("l_quantity"), "price")
    return out.select("l_partkey", _ten_thousandths("price"))


@section.query("f9_count", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2")
def _(t):
    return G.aggregate_by(t.orders, ["o_orderstatus", "o_orderpriority"], {"n": F.count(F.lit(1))})


@section.query("f10_exists_flag", """
SELECT bool_or(o_totalprice > 400000) AS large, coalesce(bool_or(o_orderpriority = '9'), false) AS unknown FROM orders
""")
def _(t):
    return G.exists_flags(t.orders, {"large": F.col("o_totalprice") > 400000, "unknown": F.col("o_orderpriority") == "9"})


@section.query("f11_latest_row", """
SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM
  (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS written FROM orders)
ORDER BY o_custkey, written DESC NULLS FIRST, o_orderkey DESC
""")
def _(t):
    base = t.orders.withColumn("written", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")))
    out = G.latest_per_group(base, ["o_custkey"], "written", ["o_orderkey"])
    return out.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


@section.query("f12_group_max_per_row", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, max(l_linenumber) OVER (PARTITION BY l_orderkey) - l_linenumber AS to_go FROM lineitem
""")
def _(t):
    out = G.with_group_max(t.lineitem, ["l_orderkey"], "l_linenumber", "top")
    return out.select(*LINE, (F.col("top") - F.col("l_linenumber")).alias("to_go"))


@section.query("g1_sequence_over", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS sequence FROM orders
""")
def _(t):
    return O.sequence_over(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], "sequence", unique=True).drop("o_orderdate")


@section.query("g1_wide_sequence", """
SELECT doc_id, text, lang, source, n_chars, 100 + row_number() OVER (ORDER BY n_chars DESC, doc_id) AS sequence FROM documents
""")
def _(t):
    """Whole texts beside their numbers; only ids and lengths are sorted and stored."""
    return O.sequence_over(t.documents, [F.col("n_chars").desc(), "doc_id"], "sequence", start=101, key=["doc_id"])


@section.query("g2_first_row", f"""
SELECT DISTINCT ON (l_orderkey) l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem ORDER BY l_orderkey, {TIE_SQL}
""")
def _(t):
    return O.first_per_key(t.lineitem, ["l_orderkey"], [F.col(c).asc() for c in TIE]).select(*LINE)


@section.query("g3_last_row", "SELECT DISTINCT ON (l_orderkey) l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem ORDER BY l_orderkey, "
               + ", ".join(f"{c} DESC" for c in TIE))
def _(t):
    return O.first_per_key(t.lineitem, ["l_orderkey"], [F.col(c).desc() for c in TIE]).select(*LINE)


@section.query("g4_group_change", """
SELECT event_id, user_id, event_type FROM (SELECT *, lag(event_type) OVER w AS before, row_number() OVER w AS rn FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE rn = 1 OR before IS DISTINCT FROM event_type
""")
def _(t):
    out = O.group_changes(t.events, ["user_id"], ["ts", "event_id"], "event_type", row_key=["event_id"])
    return out.select("event_id", "user_id", "event_type")


@section.query("g5_running_ratio", """
SELECT DISTINCT l_partkey, strftime(l_shipdate, '%Y-%m-%d') AS day, CAST(floor(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) OVER w AS DOUBLE)
  / CAST(sum(CAST(l_quantity AS DECIMAL(18,4))) OVER w AS DOUBLE) * 10000) AS BIGINT) AS ratio
FROM lineitem WINDOW w AS (PARTITION BY l_partkey ORDER BY l_shipdate RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def _(t):
    out = O.running_ratio(t.lineitem, ["l_partkey"], "l_shipdate", "l_extendedprice", "l_quantity", "ratio")
    return out.select("l_partkey", _day("l_shipdate").alias("day"), _ten_thousandths("ratio"))


@section.query("g6_first_and_rest", f"""
SELECT l_orderkey, l_partkey, l_suppkey, CASE WHEN rn = 1 THEN 'update' ELSE 'insert' END AS action
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {TIE_SQL}) AS rn FROM lineitem)
""")
def _(t):
    numbered = O.number_within(t.lineitem, ["l_orderkey"], TIE, "rn", spread=False)
    action = F.when(F.col("rn") == 1, "update").otherwise("insert")
    return numbered.select("l_orderkey", "l_partkey", "l_suppkey", action.alias("action"))


@section.query("h1_order_by", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey")
def _(t):
    return G.resort_model(t.orders.select("o_orderkey", "o_orderdate", "o_totalprice"), [("o_totalprice", True), ("o_orderkey", False)])


@section.query("h2_top_one", "SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC LIMIT 1")
def _(t):
    return G.top_one(t.orders, [F.col("o_orderdate").desc_nulls_first(), F.col("o_orderkey").desc()]).select("o_orderkey", "o_orderstatus")


@section.query("h3_sorted_distinct_list", """
SELECT p_size, CAST((rn - 1) // 10 AS BIGINT) AS chunk, string_agg(p_brand, ',' ORDER BY rn) AS brands FROM (
  SELECT p_size, p_brand, row_number() OVER (PARTITION BY p_size ORDER BY p_brand) AS rn FROM (SELECT DISTINCT p_size, p_brand FROM part)) GROUP BY 1, 2
""")
def _(t):
    return G.sorted_distinct_list(t.part, ["p_size"], "p_brand", "brands", chunk=10, spread=False)


@section.query("h4_resort_model", "SELECT p_partkey, p_size, p_brand FROM part ORDER BY p_size DESC, p_brand, p_partkey")
def _(t):
    return G.resort_model(t.part.select("p_partkey", "p_size", "p_brand"), [("p_size", True), ("p_brand", False), ("p_partkey", False)])


@section.query("i1_append", """
SELECT event_id, value, 'given' AS origin FROM events WHERE event_type = 'purchase'
UNION ALL SELECT event_id, -value, 'made' FROM events WHERE event_type <> 'purchase'
""")
def _(t):
    given = t.events.where("event_type = 'purchase'").select("event_id", "value", F.lit("given").alias("origin"))
    made = t.events.where("event_type <> 'purchase'").select("event_id", F.lit("made").alias("origin"), (-F.col("value")).alias("value"))
    return G.append(given, made)


@section.query("i2_distinct", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def _(t):
    return G.distinct_rows(t.lineitem, ["l_partkey", "l_suppkey"])


@section.query("i3_difference", "SELECT o_orderkey AS k FROM orders EXCEPT SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'")
def _(t):
    return G.difference(t.orders.select(F.col("o_orderkey").alias("k")), t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("k")))


@section.query("i4_union_distinct", """
SELECT c_nationkey AS place, c_mktsegment AS kind FROM customer UNION SELECT s_nationkey, 'SUPPLIER' FROM supplier
""")
def _(t):
    suppliers = t.supplier.select(F.col("s_nationkey").alias("place"), F.lit("SUPPLIER").alias("kind"))
    return G.union_distinct(t.customer.select(F.col("c_nationkey").alias("place"), F.col("c_mktsegment").alias("kind")), suppliers)


@section.query("i5_multiset_equality", """
WITH a AS (SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY 1, 2),
b AS (SELECT p_brand, p_size, count(*) AS n FROM part WHERE p_type <> 'PROMO' GROUP BY 1, 2)
SELECT a.p_brand, a.p_size, 'left' AS side, a.n - coalesce(b.n, 0) AS copies FROM a LEFT JOIN b USING (p_brand, p_size) WHERE a.n <> coalesce(b.n, 0)
""")
def _(t):
    return G.multiset_difference(t.part.select("p_brand", "p_size"), t.part.where("p_type <> 'PROMO'").select("p_brand", "p_size"))
