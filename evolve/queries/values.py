"""Projections, scalar functions, filters and predicates."""

from pyspark.sql import functions as F

from evolve.dataset import Dataset
from evolve.functions import documents as D
from evolve.functions import predicates as P
from evolve.functions import text as X
from evolve.functions import values as V
from evolve.operators.groups import with_group_max
from evolve.operators.domains import Step, Tree, filter_domain, read_domain
from evolve.operators.joins import attach
from evolve.plans.plan import guard_changed, guard_exists
from evolve.queries.registry import Section

section = Section()


@section.query("c1_map_values", """
SELECT o_orderkey, o_orderpriority,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'u' WHEN '2-HIGH' THEN 'h' WHEN '3-MEDIUM' THEN NULL ELSE 'old' END AS code
FROM orders
""")
def _(t):
    base = t.orders.select("o_orderkey", "o_orderpriority", F.lit("old").alias("code"))
    return V.map_values(base, "o_orderpriority", "code", [("1-URGENT", "u"), ("2-HIGH", "h"), ("3-MEDIUM", False)])


@section.query("c2_map_in_place", """
SELECT c_custkey, CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'MACHINERY'
                       WHEN c_mktsegment = 'MACHINERY' THEN 'TOOLS' ELSE c_mktsegment END AS c_mktsegment
FROM customer
""")
def _(t):
    pairs = [("HOUSEHOLD", "MACHINERY"), ("FURNITURE", "MACHINERY"), ("MACHINERY", "TOOLS")]
    return V.map_in_place(t.customer.select("c_custkey", "c_mktsegment"), "c_mktsegment", pairs)


@section.query("c3_clamp_to_domain", """
SELECT p_partkey, CASE WHEN p_size BETWEEN 1 AND 25 THEN p_size END AS p_size, p_size AS legacy__p_size FROM part
""")
def _(t):
    kept = t.part.select("p_partkey", "p_size", F.col("p_size").alias("legacy__p_size"))
    return V.clamp_to_domain(kept, "p_size", list(range(1, 26)))


@section.query("c4_set_where", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE 'draft' END AS state,
       CASE WHEN o_orderstatus = 'F' THEN 0.0 ELSE o_totalprice END AS o_totalprice
FROM orders
""")
def _(t):
    base = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", F.lit("draft").alias("state"))
    out = V.set_where(base, {"state": "done", "o_totalprice": 0.0}, F.col("o_orderstatus") == "F")
    return out.select("o_orderkey", "state", "o_totalprice")


@section.query("c5_case_map", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 300000 THEN 'large'
  WHEN o_orderstatus = 'F' THEN 'closed' WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'soon'
  WHEN round(o_totalprice / 100000, 0) <> 0 THEN 'later' END AS state
FROM orders
""")
def _(t):
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    return V.case_map(
        t.orders, "state",
        [
            ((status == "F") & (price > 300000), "large"), (status == "F", "closed"),
            (F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "soon"), (F.round(price / 100000, 0) != 0, "later"),
        ],
    ).select("o_orderkey", "state")


@section.query("c6_copy_value", "SELECT o_orderkey, o_totalprice, o_totalprice AS technical_price FROM orders")
def _(t):
    return V.copy_value(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", "technical_price")


@section.query("c7_fill_null", """
SELECT event_id, CASE WHEN event_type = 'error' THEN CAST(user_id AS DOUBLE) ELSE value END AS value,
       CASE WHEN event_type = 'view' THEN 'none' ELSE event_type END AS label
FROM events
""")
def _(t):
    holes = t.events.select(
        "event_id", "user_id",
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        F.when(F.col("event_type") == "view", "  ").otherwise(F.col("event_type")).alias("label"),
    )
    out = V.fill_null(holes, "value", F.col("user_id").cast("double"))
    return V.fill_null(out, "label", "none", also_empty=True).drop("user_id")


@section.query("c8_invert_flag", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       (CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag = 'R' END) IS DISTINCT FROM true AS kept
FROM lineitem
""")
def _(t):
    flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag") == "R")
    return V.invert_flag(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", flag.alias("kept")), "kept")


@section.query("c9_all_present_flag", """
SELECT d.doc_id, quality IS NOT NULL AND toxic IS NOT NULL AS labelled FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
""")
def _(t):
    joined = attach(t.documents.select("doc_id"), t.labels, ["doc_id"], ["quality", "toxic"])
    return V.all_present_flag(joined, ["quality", "toxic"], "labelled").select("doc_id", "labelled")


@section.query("c10_append_text", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_mktsegment WHEN c_acctbal < 0 THEN c_mktsegment
                       ELSE c_name || ' // ' || c_mktsegment END AS c_name
FROM customer
""")
def _(t):
    name = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_mktsegment")).when(F.col("c_acctbal") >= 0, F.col("c_name"))
    base = t.customer.select("c_custkey", F.coalesce(name, F.lit("")).alias("c_name"), "c_mktsegment")
    return X.append_text(base, "c_name", "c_mktsegment", " // ").select("c_custkey", "c_name")


@section.query("c11_split_sign", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'before' ELSE 'after' END AS side, abs(c_acctbal) AS c_acctbal FROM customer
""")
def _(t):
    return V.split_sign(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", "side", "before", "after")


@section.query("c12_scale", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_quantity / 60, 4) AS hours FROM lineitem
""")
def _(t):
    out = V.scale(t.lineitem, "l_quantity", 1 / 60, "hours")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round("hours", 4).alias("hours"))


@section.query("c13_ratio_or_inverse", """
SELECT p_partkey, round(CASE WHEN p_type IN ('LARGE', 'ECONOMY') THEN p_size ELSE 1.0 / p_size END, 6) AS ratio FROM part
""")
def _(t):
    out = V.ratio_or_inverse(t.part, "p_type", "p_size", ["LARGE", "ECONOMY"], "ratio")
    return out.select("p_partkey", F.round("ratio", 6).alias("ratio"))


@section.query("c14_add_interval", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       strftime(l_shipdate + to_hours(CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE l_quantity END AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS due,
       strftime(l_shipdate - to_days(CAST(l_linenumber AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS early
FROM lineitem
""")
def _(t):
    hours = t.lineitem.withColumn("h", F.when(F.col("l_returnflag") == "R", 0).otherwise(F.col("l_quantity")))
    out = V.add_interval(hours, "l_shipdate", "h", "hour", "due", default=1)
    out = V.add_interval(out, "l_shipdate", "l_linenumber", "day", "early", sign=-1)
    shown = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("due", "early")]
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *shown)


@section.query("c15_local_date", """
SELECT event_id, CAST(CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE
  (CASE WHEN user_id < 50 THEN 'Europe/Madrid' WHEN user_id < 100 THEN 'America/New_York' ELSE 'UTC' END) AS DATE) AS VARCHAR) AS day
FROM events
""")
def _(t):
    zone = F.when(F.col("user_id") < 50, "Europe/Madrid").when(F.col("user_id") < 100, "America/New_York")
    return V.local_date(t.events, "ts", zone, "day").select("event_id", F.col("day").cast("string"))


@section.query("c16_build_json", """
SELECT c_custkey, '{"' || c_custkey || '":{"name":"' || c_name || '","segment":"' || c_mktsegment || '"}}' AS settings FROM customer
""")
def _(t):
    fields = {"name": F.col("c_name"), "segment": F.col("c_mktsegment")}
    return D.build_json(t.customer, "settings", F.col("c_custkey"), fields).select("c_custkey", "settings")


@section.query("c17_merge_json", """
SELECT event_id, CASE event_type
  WHEN 'click' THEN '{"k":"click"}' WHEN 'view' THEN '{"a":"view","k":"' || json_extract_string(props, '$.k') || '"}'
  WHEN 'error' THEN '{"a":"error"}' ELSE '{"k":"' || json_extract_string(props, '$.k') || '"}' END AS props
FROM events
""")
def _(t):
    kind = F.col("event_type")
    right = F.when(kind == "click", F.to_json(F.create_map(F.lit("k"), kind))).when(
        kind.isin("view", "error"), F.to_json(F.create_map(F.lit("a"), kind))
    )
    left = F.when(kind != "error", F.col("props"))
    return D.merge_json(t.events, "props", left, right).select("event_id", "props")


@section.query("c18_concat_json_arrays", """
SELECT p_partkey, CASE WHEN p_size > 25
  THEN '[{"name":"size","type":"int"},{"name":"' || p_brand || '","type":"' || p_type || '"}]'
  ELSE '[{"name":"' || p_brand || '","type":"' || p_type || '"}]' END AS definition
FROM part
""")
def _(t):
    def item(name, type_):
        return F.array(F.struct(name.alias("name"), type_.alias("type")))

    left = F.when(F.col("p_size") > 25, item(F.lit("size"), F.lit("int")))
    both = D.concat_arrays(left, item(F.col("p_brand"), F.col("p_type")))
    return t.part.select("p_partkey", F.to_json(both).alias("definition"))


@section.query("c19_json_get", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.none') AS none FROM events
""")
def _(t):
    out = D.json_get(D.json_get(t.events, "k", "props", "k", "bigint"), "none", "props", "none")
    return out.select("event_id", "k", "none")


@section.query("c20_json_set_where", """
SELECT event_id, '{"k":"' || CASE json_extract_string(props, '$.k') WHEN '69' THEN 'manual' WHEN '70' THEN 'none'
  ELSE json_extract_string(props, '$.k') END || '"}' AS props FROM events
""")
def _(t):
    swapped = D.json_set_where(D.parse_map(F.col("props")), "69", "manual")
    swapped = D.json_set_key_where(swapped, "k", "70", "none")
    return t.events.select("event_id", D.sorted_json(swapped).alias("props"))


@section.query("c21_compose_regex", r"""
SELECT p_partkey, CASE p_type
    WHEN 'ECONOMY' THEN '(?=.*' || regexp_replace(p_name, '([\s#$&()*+.?\[\]^{|}~\\-])', '\\\1', 'g') || '.*)'
    WHEN 'SMALL' THEN '(?!' || regexp_replace(p_name, '([\s#$&()*+.?\[\]^{|}~\\-])', '\\\1', 'g') || ')'
    WHEN 'PROMO' THEN '(?=' || p_name || ')' ELSE '' END
  || CASE WHEN p_size > 10 THEN '(' || p_brand || ')|(' || p_name || ')' ELSE '(' || p_brand || ')' END AS pattern
FROM part
""")
def _(t):
    mode = F.when(F.col("p_type") == "ECONOMY", "contains").when(F.col("p_type") == "SMALL", "not_contains").when(
        F.col("p_type") == "PROMO", "match_regex"
    )
    second = F.when(F.col("p_size") > 10, F.col("p_name")).otherwise("")
    pattern = X.compose_regex(mode, F.col("p_name"), [F.col("p_brand"), second])
    return t.part.select("p_partkey", pattern.alias("pattern"))


def _lines_sql(text: str) -> str:
    """SQL: the lines of a text with its blank runs as one space, without empty lines."""
    words = "string_split(translate(l, chr(9) || chr(11) || chr(12) || chr(13), '    '), ' ')"
    line = f"array_to_string(list_filter({words}, lambda w: w <> ''), ' ')"
    return f"array_to_string(list_filter(list_transform(string_split({text}, chr(10)), lambda l: {line}), lambda m: m <> ''), chr(10))"


# Cut at every tag; what stands inside scripts and styles is left out by counting; entities as they occur in the pages.
@section.query("c22_html_to_text", f"""
WITH cut AS (SELECT page_id, unnest(string_split(html, '<')) AS piece, generate_subscripts(string_split(html, '<'), 1) AS i FROM pages),
counted AS (SELECT *, string_split(piece, '>')[1] AS tag, sum(CASE
    WHEN i > 1 AND (piece LIKE 'script%' OR piece LIKE 'style%') THEN 1 WHEN piece LIKE '/script%' OR piece LIKE '/style%' THEN -1 ELSE 0 END)
  OVER (PARTITION BY page_id ORDER BY i) AS inside FROM cut),
shown AS (SELECT page_id, i, CASE
    WHEN inside = 0 AND i > 1 AND tag IN ('br', '/p', '/div', '/li', '/ul', '/h1', '/article', '/footer', '/nav', '/title') THEN chr(10) ELSE ' ' END AS sep,
  CASE WHEN i = 1 THEN piece WHEN inside > 0 OR strpos(piece, '>') = 0 THEN '' WHEN piece LIKE '!--%' THEN substr(piece, strpos(piece, '-->') + 3)
    ELSE substr(piece, strpos(piece, '>') + 1) END AS text FROM counted),
said AS (SELECT page_id, string_agg(sep || translate(text, chr(10) || chr(13), '  '), '' ORDER BY i) AS text FROM shown GROUP BY 1),
plain AS (SELECT page_id, replace(replace(replace(replace(text, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&') AS text FROM said)
SELECT page_id, {_lines_sql("p.text")} AS text, NOT (html LIKE '%<img%' OR html LIKE '%<video%' OR html LIKE '%<iframe%') AND {_lines_sql("p.text")} = '' AS empty
FROM plain p JOIN pages USING (page_id)
""")
def _(t):
    html = F.col("html")
    return t.pages.select("page_id", X.html_to_text(html).alias("text"), X.is_html_empty(html).alias("empty"))


@section.query("c22_entities_and_breaks", """
SELECT p_partkey, CASE p_partkey % 4
  WHEN 0 THEN p_name || ' café ’x' || chr(39) || chr(10) || p_brand || chr(10) || 'ü €'
  WHEN 1 THEN 'a &lt; ' || p_name || ' &amp; &nosuch; ∑ 😀'
  WHEN 2 THEN 'x' || chr(10) || p_name
  ELSE p_name || ' < ' || p_brand END AS text FROM part
""")
def _(t):
    name, brand = F.col("p_name"), F.col("p_brand")
    case = F.col("p_partkey") % 4
    listed = F.lit("</li></ul><script>if (a < b) '</p>y';</script><style>p {}</style><!-- <p>z</p> -->")
    html = (
        F.when(case == 0, F.concat(F.lit("<p>"), name, F.lit(" caf&eacute; &#8217;x&#x27;</p>\n<p>"), brand, F.lit("<br/>&uuml;&nbsp;&euro;</p>")))
        .when(case == 1, F.concat(F.lit("a &amp;lt; <b>"), name, F.lit("</b> &amp;amp; &nosuch; &sum; &#x1F600;")))
        .when(case == 2, F.concat(F.lit("<ul><li>x</li>\n <li>"), name, listed))
        .otherwise(F.concat(name, F.lit("  &lt;\n"), brand))
    )
    return t.part.select("p_partkey", X.html_to_text(html).alias("text"))


@section.query("c22_quoted_attributes", """
SELECT p_partkey, p_name || CASE p_partkey % 3 WHEN 0 THEN ' x' WHEN 1 THEN ' x 2' ELSE ' x=' END AS text FROM part
""")
def _(t):
    """The end of a tag is not the sign inside a quoted value; a quote elsewhere opens nothing."""
    name = F.col("p_name")
    html = (
        F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit('<p title="a > b" class=\'c>"d\'>'), name, F.lit('</b  ><img alt = "->"> x')))
        .when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("<a it's href=x>"), name, F.lit("</a> x<img data-a='1>2")))
        .otherwise(F.concat(F.lit('<i a="">'), name, F.lit("</i> x=<b\n title = '>\n'></b>")))
    )
    return t.part.select("p_partkey", X.html_to_text(html).alias("text"))


@section.query("c22_text_to_html", r"""
SELECT doc_id, '<p>' || regexp_replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'),
  '\r?\n', '<br/>', 'g') || '</p>' AS html FROM documents
""")
def _(t):
    texts = F.create_map(F.col("lang"), F.col("text"))
    return t.documents.select("doc_id", X.translations_to_html(texts)[F.col("lang")].alias("html"))


@section.query("o2_scalar_text_functions", f"SELECT doc_id, {_lines_sql('text')} AS text, {_lines_sql('text')} = '' AS empty FROM documents")
def _(t):
    html = X.text_to_html(F.col("text"))
    return t.documents.select("doc_id", X.html_to_text(html).alias("text"), X.is_html_empty(html).alias("empty"))


@section.query("c23_merge_csv_set", """
SELECT p_partkey, CASE WHEN p_size > 5 THEN array_to_string(list_sort(list_distinct(list_concat(
  string_split(p_name, ' '), ['lang_id', 'red']))), ' ') END AS words
FROM part
""")
def _(t):
    base = t.part.select("p_partkey", F.when(F.col("p_size") > 5, F.col("p_name")).alias("words"))
    return X.merge_csv_set(base, "words", ["lang_id", "red"], sep=" ")


@section.query("c24_agree_or_null", """
SELECT c_custkey, CASE WHEN c_nationkey = s_nationkey THEN c_nationkey END AS common
FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey
""")
def _(t):
    both = attach(t.customer, t.supplier, [("c_custkey", "s_suppkey")], ["s_nationkey"])
    return V.agree_or_null(both, "c_nationkey", "s_nationkey", "common").select("c_custkey", "common")


@section.query("c25_replace_in_text", """
SELECT p_partkey, CASE WHEN p_name LIKE '% ring' THEN replace(p_name, 'ring', 'band') ELSE p_name END AS p_name FROM part
""")
def _(t):
    return X.replace_in_text(t.part.select("p_partkey", "p_name"), "p_name", "ring", "band", " ring")


@section.query("c26_name_from_template", """
SELECT c_custkey, c_name || ' (' || n_name || ')' AS label FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
""")
def _(t):
    named = attach(t.customer, t.nation, [("c_nationkey", "n_nationkey")], ["n_name"])
    return X.name_from_template(named, "label", "%s (%s)", ["c_name", "n_name"]).select("c_custkey", "label")


@section.query("c27_language_map", """
SELECT doc_id, CASE lang WHEN 'fr' THEN 'Section' WHEN 'de' THEN 'Abschnitt' ELSE 'Heading' END AS label,
       'Heading' AS source_label FROM documents
""")
def _(t):
    texts = D.language_map({"en": "Heading", "fr": "Section", "de": "Abschnitt"})
    only = D.keep_languages(texts, ["en"])
    return t.documents.select(
        "doc_id", D.in_language(texts, F.col("lang"), "en").alias("label"),
        D.in_language(only, F.col("lang"), "en").alias("source_label"),
    )


@section.query("c28_normalise_false", """
SELECT doc_id, CASE WHEN toxic = 1 THEN 'true' END AS toxic, CASE WHEN quality = 1 THEN 'yes' END AS quality FROM labels
""")
def _(t):
    base = t.labels.select(
        "doc_id", (F.col("toxic") == 1).alias("toxic"), F.when(F.col("quality") == 1, "yes").otherwise("false").alias("quality")
    )
    return V.normalise_false(V.normalise_false(base, "toxic"), "quality")


@section.query("c29_set_if_default", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN '4-NOT SPECIFIED' ELSE o_orderpriority END AS o_orderpriority
FROM orders
""")
def _(t):
    out = V.set_if_default(t.orders, {"o_orderstatus": "O", "o_orderpriority": "5-LOW"}, {"o_orderpriority": "4-NOT SPECIFIED"})
    return out.select("o_orderkey", "o_orderpriority")


@section.query("c30_offset_sequence", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(max(l_linenumber) OVER (PARTITION BY l_orderkey) + 2 + CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_linenumber END AS BIGINT) AS seq
FROM lineitem
""")
def _(t):
    own = F.when(F.col("l_returnflag") != "R", F.col("l_linenumber"))
    topped = with_group_max(t.lineitem.withColumn("own", own), ["l_orderkey"], "l_linenumber", "top")
    out = V.offset_sequence(topped, "top", "own", 2, "seq")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("seq").cast("long"))


@section.query("c31_move_field_key", """
SELECT event_id, CASE WHEN event_type = 'signup' AND value > 10 THEN 'join' ELSE event_type END AS event_type, props FROM events
""")
def _(t):
    moved = V.move_field_key(t.events, "event_type", (F.col("event_type") == "signup") & (F.col("value") > 10), "join")
    return moved.select("event_id", "event_type", "props")


LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@section.query("d1_comparison", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE (l_returnflag = 'R' OR l_discount >= 0.05) AND NOT l_quantity < 10 AND l_linestatus <> 'O'
""")
def _(t):
    c = F.col
    rule = ((c("l_returnflag") == "R") | (c("l_discount") >= 0.05)) & ~(c("l_quantity") < 10) & (c("l_linestatus") != "O")
    return P.compare(t.lineitem, rule).select(*LINE)


@section.query("d2_null_and_empty", """
SELECT d.doc_id, l.quality IS NULL AS unlabelled FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
WHERE l.toxic IS NULL OR d.text = '' OR l.quality IS NOT NULL AND l.quality = 1
""")
def _(t):
    joined = attach(t.documents.select("doc_id", "text"), t.labels, ["doc_id"], ["quality", "toxic"])
    good = F.col("quality").isNotNull() & (F.col("quality") == 1)
    rule = F.col("toxic").isNull() | P.is_blank(F.col("text")) | good
    return P.compare(joined, rule).select("doc_id", F.col("quality").isNull().alias("unlabelled"))


@section.query("d3_in_and_not_in", """
SELECT o_orderkey, o_orderpriority FROM orders
WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') AND o_orderstatus IN ('F', 'O') AND nullif(o_orderpriority, '5-LOW') NOT IN ('x')
""")
def _(t):
    rule = (
        P.not_in_list(F.col("o_orderpriority"), ["1-URGENT", "2-HIGH"]) & P.in_list(F.col("o_orderstatus"), ["F", "O"])
        & P.not_in_list(F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")), ["x"])
    )
    return P.compare(t.orders, rule).select("o_orderkey", "o_orderpriority")


@section.query("d4_is_distinct", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE nullif(l_returnflag, 'N') IS DISTINCT FROM 'R'
""")
def _(t):
    return P.compare(t.lineitem, P.is_distinct(F.nullif("l_returnflag", F.lit("N")), F.lit("R"))).select(*LINE)


@section.query("d5_like", """
SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'red%' OR p_name LIKE '%bolt' AND p_brand NOT LIKE 'Brand#1%'
""")
def _(t):
    rule = F.col("p_name").like("red%") | (F.col("p_name").endswith("bolt") & ~F.col("p_brand").startswith("Brand#1"))
    return P.compare(t.part, rule).select("p_partkey", "p_name")


@section.query("d6_filter_domain", """
SELECT c_custkey, c_name FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
WHERE r_name = 'ASIA' AND n_name <> 'NATION_2' AND c_acctbal >= 100
""")
def _(t):
    ds = Dataset({"customer": t.customer, "nation": t.nation, "region": t.region})
    references = {
        ("customer", "nation"): ("c_nationkey", "nation", "n_nationkey"),
        ("nation", "region"): ("n_regionkey", "region", "r_regionkey"),
    }
    domain = [("nation.region.r_name", "=", "ASIA"), ("nation.n_name", "!=", "NATION_2"), ("c_acctbal", ">=", 100)]
    return filter_domain(ds, "customer", domain, references).select("c_custkey", "c_name")


def _sales(t):
    """Customers with their nation, region and orders, and suppliers as a tree: number 3n + 1 to 3n + 3 lie below n."""
    suppliers = t.supplier.withColumn("parent", F.when(F.col("s_suppkey") > 1, F.floor((F.col("s_suppkey") - 2) / 3).cast("long") + 1))
    ds = Dataset({"customer": t.customer, "nation": t.nation, "region": t.region, "orders": t.orders, "lineitem": t.lineitem, "supplier": suppliers})
    references = {
        ("customer", "nation"): ("c_nationkey", "nation", "n_nationkey"),
        ("nation", "region"): ("n_regionkey", "region", "r_regionkey"),
        ("customer", "orders"): Step("c_custkey", "orders", "o_custkey", many=True),
        ("orders", "customer"): Step("o_custkey", "customer", "c_custkey"),
        ("orders", "lines"): Step("o_orderkey", "lineitem", "l_orderkey", many=True),
        ("lineitem", "supplier"): ("l_suppkey", "supplier", "s_suppkey"),
    }
    return ds, references, {("lineitem", "l_suppkey"): Tree("supplier", "s_suppkey", "parent"), ("supplier", "s_suppkey"): Tree("supplier", "s_suppkey", "parent")}


@section.query("d6_or_and_not", """
SELECT c_custkey, c_name FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
WHERE (r_name = 'ASIA' OR (c_mktsegment = 'BUILDING' AND NOT (contains(n_name, '_1') OR c_acctbal < 1000))) AND NOT c_acctbal > 9000
""")
def _(t):
    ds, references, _ = _sales(t)
    text = """['|', ('nation.region.r_name', '=', 'ASIA'), '&', ('c_mktsegment', 'in', [segment]),
        '!', '|', ('nation.n_name', 'like', '_1'), ('c_acctbal', '<', 1000), '!', ('c_acctbal', '>', 9000)]"""
    return filter_domain(ds, "customer", read_domain(text, {"segment": "BUILDING"}), references).select("c_custkey", "c_name")


@section.query("d6_to_many", """
SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')
  AND (c_acctbal < 0 OR NOT EXISTS (SELECT 1 FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_custkey = c_custkey AND l_quantity >= 48))
""")
def _(t):
    ds, references, _ = _sales(t)
    domain = [("orders.o_orderstatus", "=", "F"), "|", ("c_acctbal", "<", 0), "!", ("orders.lines.l_quantity", ">=", 48)]
    return filter_domain(ds, "customer", domain, references).select("c_custkey")


@section.query("d6_child_of", """
WITH RECURSIVE s AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey > 1 THEN CAST(floor((s_suppkey - 2) / 3) AS BIGINT) + 1 END AS parent FROM supplier),
below AS (SELECT id FROM s WHERE id = 3 UNION SELECT s.id FROM s JOIN below ON s.parent = below.id),
above AS (SELECT id, parent FROM s WHERE id = 9 UNION SELECT s.id, s.parent FROM s JOIN above ON above.parent = s.id)
SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_suppkey IN (SELECT id FROM below))
  AND NOT EXISTS (SELECT 1 FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_orderkey = o_orderkey AND s_suppkey IN (SELECT id FROM above))
""")
def _(t):
    ds, references, trees = _sales(t)
    domain = [("lines.l_suppkey", "child_of", [3]), "!", ("lines.supplier.s_suppkey", "parent_of", 9)]
    return filter_domain(ds, "orders", domain, references, trees).select("o_orderkey")


@section.query("d7_guard_exists", """
SELECT o_orderkey, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_orderpriority = '9-NONE') THEN o_orderpriority
   ELSE left(o_orderpriority, 1) END AS code,
   CASE WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_quantity > 49) THEN 'bulk' END AS note
FROM orders
""")
def _(t):
    base = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("code"))
    out = guard_exists(base, F.col("code") == "9-NONE", {"code": F.left("code", F.lit(1))}, negate=True)
    return guard_exists(out, F.col("l_quantity") > 49, {"note": F.lit("bulk")}, among=t.lineitem)


@section.query("d8_guard_changed", """
SELECT s_suppkey, CASE WHEN EXISTS (SELECT 1 FROM customer WHERE c_acctbal < 0) THEN upper(s_name) ELSE s_name END AS s_name,
       CASE WHEN EXISTS (SELECT 1 FROM customer WHERE c_acctbal < -100000) THEN 'x' END AS note
FROM supplier
""")
def _(t):
    touched, untouched = t.customer.where("c_acctbal < 0"), t.customer.where("c_acctbal < -100000")
    out = guard_changed(touched, t.supplier.select("s_suppkey", "s_name"), {"s_name": F.upper("s_name")})
    return guard_changed(untouched, out, {"note": F.lit("x")})


@section.query("d9_active_rows", """
SELECT p_partkey, p_brand, p_size FROM part p
WHERE p_size = 50 OR NOT EXISTS (SELECT 1 FROM part q WHERE q.p_brand = p.p_brand AND q.p_size = 50)
""")
def _(t):
    return P.active_rows(t.part.select("p_partkey", "p_brand", "p_size"), F.col("p_size") == 50, ["p_brand"], fallback=True)
