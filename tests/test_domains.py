"""Domains against a plain evaluation, paths in stored texts."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from evolve.operators import domains as D
from evolve.operators.domains import Step, Tree, filter_domain, nested, read_domain
from tests.conftest import rows


def test_prefix_notation_and_texts():
    assert nested(["|", ("a", "=", 1), "!", ("b", "=", 2), ("c", "=", 3)]) == ("&", [("|", [("a", "=", 1), ("!", ("b", "=", 2))]), ("c", "=", 3)])
    chain = ["|"] * 2000 + [("a", "=", i) for i in range(2001)]
    assert nested(chain) == ("&", [("|", [("a", "=", i) for i in range(2001)])])
    for bad in (["|", ("a", "=", 1)], ["!"], ["^", ("a", "=", 1)], [("a", "=")]):
        with pytest.raises(ValueError):
            nested(bad)
    text = """['|', ('a.b', 'in', ['x', user.id] + ids), '&', ["c", "=", -1.5], ('d', '!=', False)]"""
    assert read_domain(text, {"user.id": 7, "ids": [8]}) == ["|", ("a.b", "in", ["x", 7, 8]), "&", ("c", "=", -1.5), ("d", "!=", False)]
    with pytest.raises(ValueError, match="user.id"):
        read_domain("[('a', '=', user.id)]")


TEAMS = [(1, "red", None), (2, "Blue", 1), (3, None, 2), (4, "red", 9), (5, "green", 5)]
PEOPLE = [(1, 1, 5, None), (2, 2, None, 1), (3, None, 7, 1), (4, 9, 1, 2), (5, 3, 7, 4), (6, 1, 2, 5)]
TAGS = [(1, "a"), (1, "b"), (2, "a"), (5, None), (5, "B"), (99, "a")]
REFS = {
    ("person", "team"): ("team_id", "team", "id"), ("person", "tags"): Step("id", "tag", "person_id", many=True), ("tag", "person"): Step("person_id", "person", "id"),
    ("team", "members"): Step("id", "person", "team_id", many=True),
}
TREES = {("person", "team_id"): Tree("team", "id", "up"), ("person", "id"): Tree("person", "id", "boss")}


@pytest.fixture(scope="module")
def ds(spark):
    return {
        "team": spark.createDataFrame(TEAMS, "id int, name string, up int"),
        "person": spark.createDataFrame(PEOPLE, "id int, team_id int, n int, boss int"),
        "tag": spark.createDataFrame(TAGS, "person_id int, name string"),
    }


def holds(value, op, v):
    if op in ("=", "!="):
        same = value is None if v is False else value == v
        return same == (op == "=")
    if op in ("in", "not in"):
        return any(value is None if x is False else value is not None and value == x for x in v) == (op == "in")
    if op in ("like", "not like", "ilike"):
        found = value is not None and (v in value if op != "ilike" else v.lower() in value.lower())
        return not found if op == "not like" else found
    return value is not None and {"<": value < v, "<=": value <= v, ">": value > v, ">=": value >= v}[op]


def family(table, ids, up):
    parent = {r[0]: r[-1] for r in table}
    if up:
        found, todo = set(), list(ids)
        while todo:
            i = todo.pop()
            if i is not None and i not in found:
                found.add(i)
                todo.append(parent.get(i))
        return found & parent.keys()
    below = set(ids) & parent.keys()
    while more := {i for i, p in parent.items() if p in below} - below:
        below |= more
    return below


def judge(person, leaf):
    path, op, v = leaf
    teams = {t[0]: t for t in TEAMS}
    if path in ("team_id", "id") and op in ("child_of", "parent_of"):
        table = TEAMS if path == "team_id" else PEOPLE
        return person[1 if path == "team_id" else 0] in family(table, v, op == "parent_of")
    if path == "tags.name":
        return any(holds(name, op, v) for p, name in TAGS if p == person[0])
    if path == "team.members.n":
        return person[1] in teams and any(holds(q[2], op, v) for q in PEOPLE if q[1] == person[1])
    if path == "team.name":
        return holds(teams.get(person[1], (None, None))[1], op, v)
    return holds(person[{"id": 0, "team_id": 1, "n": 2}[path]], op, v)


LEAF = st.one_of(
    st.tuples(st.sampled_from(["n", "team_id", "team.members.n"]), st.sampled_from(["=", "!=", "<", "<=", ">", ">="]), st.integers(0, 9)),
    st.tuples(st.sampled_from(["n", "team.name", "tags.name", "team_id"]), st.sampled_from(["=", "!="]), st.just(False)),
    st.tuples(st.sampled_from(["team.name", "tags.name"]), st.sampled_from(["=", "!=", "like", "not like", "ilike"]), st.sampled_from(["a", "red", "b", "blue"])),
    st.tuples(st.sampled_from(["id", "n"]), st.sampled_from(["in", "not in"]), st.lists(st.sampled_from([1, 2, 5, 7, False]), max_size=3)),
    st.tuples(st.sampled_from(["team_id", "id"]), st.sampled_from(["child_of", "parent_of"]), st.lists(st.integers(1, 6), min_size=1, max_size=2)),
)
TERM = st.recursive(LEAF.map(lambda leaf: [leaf]), lambda t: st.one_of(t.map(lambda x: ["!", *x]), st.tuples(st.sampled_from("&|"), t, t).map(lambda x: [x[0], *x[1], *x[2]])), max_leaves=5)


def evaluate(person, terms):
    stack = []
    for t in reversed(terms):
        if t == "!":
            stack.append(not stack.pop())
        elif t in ("&", "|"):
            a, b = stack.pop(), stack.pop()
            stack.append((a and b) if t == "&" else (a or b))
        else:
            stack.append(judge(person, t))
    return all(stack)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(TERM, min_size=0, max_size=2))
def test_domains_agree_with_a_plain_evaluation(ds, terms):
    domain = [x for t in terms for x in t]
    got = [r[0] for r in rows(filter_domain(ds, "person", domain, REFS, TREES))]
    assert got == [p[0] for p in PEOPLE if evaluate(p, domain)]


def test_rows_come_once_and_wrong_promises_stop(ds):
    assert rows(filter_domain(ds, "person", [("tags.name", "!=", "zzz"), (1, "=", 1)], REFS).select("id")) == [(1,), (2,), (5,)]
    assert filter_domain(ds, "person", [(0, "=", 1)], REFS).count() == 0
    lies = {("person", "tags"): ("id", "tag", "person_id")}
    with pytest.raises(Exception, match="not unique"):
        filter_domain(ds, "person", [("tags.name", "=", "a")], lies).collect()
    with pytest.raises(ValueError, match="no tree"):
        filter_domain(ds, "person", [("n", "child_of", 1)], REFS, TREES)


FIELDS = [("sale", "date", None), ("sale", "partner_id", "partner"), ("partner", "date", None), ("partner", "country_id", "country"), ("country", "name", None), ("sale", "a", None), ("sale", "b", None)]


def test_names_are_renamed_on_their_own_model_only(frame):
    fields = frame(FIELDS, "model string, name string, relation string")
    renames = frame([("sale", "date", "day"), ("country", "name", "title"), ("sale", "a", "b"), ("sale", "b", "a")], "model string, old string, new string")
    texts = [
        "[('name','=','date'),('partner_id.date','>',1)]", "[('date','=','date'), [\"partner_id.country_id.name\" , 'ilike', 'date']]",
        "['&', ('a','=','b'),('b','in',['a','b', 'date'])]", "[('date', 'child_of', \"it's (date\")", "date", "", None, "[('partner_id.gone.date', '=', 1), ('date.date','=',1)]",
        "[('x\\'', '=', 'date'), ('date','!=','" + "y" * 30000 + "')]",
    ]
    df = frame([(i, "sale", t) for i, t in enumerate(texts)] + [(90, "other", texts[1]), (91, None, texts[1])], "id int, model string, domain string")
    out = dict(rows(D.rename_paths(df, "id", "domain", "model", fields, renames).select("id", "domain")))
    assert [out[i] for i in range(len(texts))] == [
        texts[0], "[('day','=','date'), [\"partner_id.country_id.title\" , 'ilike', 'date']]", "['&', ('b','=','b'),('a','in',['a','b', 'date'])]",
        "[('day', 'child_of', \"it's (date\")", "date", "", None, "[('partner_id.gone.date', '=', 1), ('day.date','=',1)]",
        "[('x\\'', '=', 'date'), ('day','!=','" + "y" * 30000 + "')]",
    ]
    assert out[90] == out[91] == texts[1]
    lists = frame([(1, "sale", "['date:month', 'partner_id.date', 'date desc', 'to date']")], "id int, model string, t string")
    assert D.rename_paths(lists, "id", "t", "model", fields, renames, "list").first()["t"] == "['day:month', 'partner_id.date', 'day desc', 'to date']"
    mails = frame([(1, "sale", "date {{ object.date }} ${object.partner_id.country_id.name.upper()} objects.date")], "id int, model string, t string")
    assert D.rename_paths(mails, "id", "t", "model", fields, renames, "template").first()["t"] == "date {{ object.day }} ${object.partner_id.country_id.title.upper()} objects.date"


def test_broken_paths_name_the_step_that_is_gone(frame):
    fields = frame(FIELDS, "model string, name string, relation string")
    texts = ["[('date','=','nothing')]", "[('partner_id.nothing.x','=',1),('date','=',1)]", "[('partner_id.country_id.nothing','=',1)]", "[('date.x','=',1)]", "[('nothing','=',1)]", None]
    df = frame([(i, "sale", t, True) for i, t in enumerate(texts)], "id int, model string, domain string, active boolean")
    assert rows(D.broken_paths(df, "id", "domain", "model", fields)) == [
        (1, "partner_id.nothing.x", "nothing", "partner"), (2, "partner_id.country_id.nothing", "nothing", "country"), (3, "date.x", "x", None), (4, "nothing", "nothing", "sale")]
    out = D.disable_broken_filters(df, "id", "domain", "model", fields, "active")
    assert rows(out.select("id", "active")) == [(0, True), (1, False), (2, False), (3, False), (4, False), (5, True)]
    assert D.broken_paths(df.limit(0), "id", "domain", "model", fields).count() == 0
