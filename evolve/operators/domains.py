"""Stored filters: conditions along paths of references, and the paths in their texts.

A domain is a list of conditions (path, operator, value) in prefix notation: '|' and '&'
take the two terms that follow, '!' the next one, and whatever stands side by side must
all hold. A path walks references: every step but the last names one, the last a column.

A condition holds or does not; NULL decides nothing, so '!' is the exact opposite of what
follows it. Along references to one row a missing row counts as all NULL. Along one to
many rows a condition holds if it does for some of them.
"""

from __future__ import annotations

import ast
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evolve.functions.values import set_where
from evolve.operators.joins import attach, drop_related, flag_related, keep_related
from evolve.storage import stored

# The operators of a filter domain, as they compare a column with a value.
OPERATORS = {
    "=": lambda c, v: c.isNull() if v is False or v is None else c == F.lit(v),
    "!=": lambda c, v: c.isNotNull() if v is False or v is None else c.isNull() | (c != F.lit(v)),
    "<": lambda c, v: c < F.lit(v),
    "<=": lambda c, v: c <= F.lit(v),
    ">": lambda c, v: c > F.lit(v),
    ">=": lambda c, v: c >= F.lit(v),
    "=?": lambda c, v: F.lit(True) if v is False or v is None else c == F.lit(v),
    "in": lambda c, v: _among(c, v),
    "not in": lambda c, v: ~_among(c, v),
    "like": lambda c, v: c.contains(v),
    "not like": lambda c, v: c.isNull() | ~c.contains(v),
    "ilike": lambda c, v: F.lower(c).contains(v.lower()),
    "not ilike": lambda c, v: c.isNull() | ~F.lower(c).contains(v.lower()),
    "=like": lambda c, v: c.like(v),
    "=ilike": lambda c, v: c.ilike(v),
}
_TREES = ("child_of", "parent_of")
_TRUE, _FALSE = (1, "=", 1), (0, "=", 1)


def _among(c: Column, values: Iterable) -> Column:
    """Membership of a list; False in it stands for NULL."""
    values = list(values)
    some = [v for v in values if v is not False and v is not None]
    found = F.coalesce(c.isin(some), F.lit(False)) if some else F.lit(False)
    return found | c.isNull() if len(some) < len(values) else found


@dataclass(frozen=True)
class Step:
    """A reference: rows of ``table`` whose ``key`` equals this table's ``own``; ``many`` of them, or one at most."""

    own: str
    table: str
    key: str
    many: bool = False


@dataclass(frozen=True)
class Tree:
    """What a column refers to in conditions on descendants and ancestors: a table whose rows point to their parents."""

    table: str
    id: str
    parent: str


def read_domain(text: str, names: Mapping[str, object] | None = None) -> list:
    """The domain that a text holds; a dotted name in it stands for its value in ``names``."""
    def value(node: ast.expr):
        if isinstance(node, ast.Constant):
            return node.value
        if isinstance(node, (ast.List, ast.Tuple)):
            made = [value(x) for x in node.elts]
            return made if isinstance(node, ast.List) else tuple(made)
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.USub):
            return -value(node.operand)
        if isinstance(node, ast.BinOp) and isinstance(node.op, ast.Add):
            return value(node.left) + value(node.right)
        name = ast.unparse(node)
        if name not in (names or {}):
            raise ValueError(f"no value for {name}")
        return names[name]

    terms = value(ast.parse(text.strip(), mode="eval").body)
    return [tuple(t) if isinstance(t, list) else t for t in terms]


def nested(domain: Sequence) -> tuple:
    """The domain as ('&' or '|', [parts]), ('!', part) and conditions. Long chains become one node."""
    stack: list[tuple] = []
    for term in reversed(domain):
        if term == "!":
            if not stack:
                raise ValueError("'!' has nothing to negate")
            stack.append(("!", stack.pop()))
        elif term in ("&", "|"):
            if len(stack) < 2:
                raise ValueError(f"{term!r} needs two terms")
            parts: list = []
            for part in (stack.pop(), stack.pop()):
                parts += part[1] if part[0] == term and len(part) == 2 else [part]
            stack.append((term, parts))
        elif isinstance(term, (tuple, list)) and len(term) == 3:
            stack.append(tuple(term))
        else:
            raise ValueError(f"{term!r} is no condition")
    return ("&", stack[::-1])


def _all_of(columns: Sequence[Column], both) -> Column:
    """Columns put together two by two, so that a long list does not nest deeply."""
    columns = list(columns)
    while len(columns) > 1:
        columns = [both(*columns[i:i + 2]) if i + 1 < len(columns) else columns[i] for i in range(0, len(columns), 2)]
    return columns[0] if columns else F.lit(True)


def descendants(df: DataFrame, id_col: str, parent_col: str, ids: Iterable, upwards: bool = False) -> DataFrame:
    """id: the rows of a tree at or below the given ids (or at or above them).

    One round per level, each a semi join with the rows found last; rows on a cycle are found once.
    """
    kind = df.schema[id_col].dataType.simpleString()
    edges = df.select(F.col(id_col).alias("id"), F.col(parent_col).cast(kind).alias("up"))
    start = df.sparkSession.createDataFrame([(i,) for i in dict.fromkeys(ids)], f"id {kind}")
    found = last = stored(keep_related(edges.select("id"), start, ["id"]).distinct())
    while not last.isEmpty():
        near = keep_related(edges, last, ["id"]).select(F.col("up").alias("id")).where("id is not null") if upwards else keep_related(edges, last, [("up", "id")]).select("id")
        last = stored(drop_related(near.distinct(), found, ["id"]))
        found = found.union(last)
    return keep_related(edges.select("id"), found, ["id"]).distinct() if upwards else found


def filter_domain(
    ds: Mapping[str, DataFrame], table: str, domain: Sequence,
    references: Mapping[tuple[str, str], Step | tuple[str, str, str]], trees: Mapping[tuple[str, str], Tree] | None = None,
) -> DataFrame:
    """The rows of a table that a domain selects, each once.

    ``references`` maps (table, step) to a ``Step`` or, for one row at most, to (own column, table, key);
    a key that is there twice then stops the run. ``trees`` maps (table, column) to the tree that
    child_of and parent_of look at. A path shared by several conditions is joined once.
    """
    df = ds[table]
    columns = df.columns
    tree = nested(domain)
    conditions = list(dict.fromkeys(_frozen(leaf) for leaf in _leaves(tree)))
    paths = {leaf: leaf[0].split(".") for leaf in conditions if isinstance(leaf[0], str)}
    walks = {leaf: _walk(table, path, references) for leaf, path in paths.items()}
    joined: dict[tuple[str, ...], str] = {}
    # What is read of the row at the end of each path of single references.
    wanted: dict[tuple[str, ...], set[str]] = {}
    for walk in walks.values():
        for i, (_, step, _) in enumerate(walk.steps):
            wanted.setdefault(walk.steps[i - 1][0] if i else (), set()).add(step.own)
        wanted.setdefault(walk.steps[-1][0] if walk.steps else (), set()).add(walk.column)
    for walk in walks.values():
        for at, step, before in walk.steps:
            if at not in joined:
                alias = "__" + "_".join(at) + "__"
                side = _one_per_key(ds[step.table], step.key, sorted(wanted[at]), alias)
                df = df.join(side, F.col(joined.get(before, "") + step.own) == F.col(alias + "__key"), "left")
                joined[at] = alias
    holds: dict[tuple, Column] = {}
    for i, leaf in enumerate(conditions):
        if leaf in ((*_TRUE,), (*_FALSE,)):
            holds[leaf] = F.lit(leaf == _TRUE)
            continue
        walk, flag = walks[leaf], f"__leaf{i}"
        end = joined[walk.steps[-1][0]] if walk.steps else ""
        column, operator, value = F.col(end + walk.column), leaf[1], leaf[2]
        if walk.rest is not None:
            step, rest = walk.rest
            there = filter_domain(ds, step.table, [(rest, operator, value)], references, trees)
            df = flag_related(df, there.select(F.col(step.key).alias("__there")), [(end + walk.column, "__there")], flag)
            holds[leaf] = F.col(flag)
        elif operator in _TREES:
            where = (trees or {}).get((walk.table, walk.column))
            if where is None:
                raise ValueError(f"no tree for {walk.column} of {walk.table}")
            ids = value if isinstance(value, (tuple, list)) else [value]
            among = descendants(ds[where.table], where.id, where.parent, ids, operator == "parent_of")
            df = flag_related(df, among.select(F.col("id").alias("__there")), [(end + walk.column, "__there")], flag)
            holds[leaf] = F.col(flag)
        else:
            holds[leaf] = F.coalesce(OPERATORS[operator](column, value), F.lit(False))

    def column_of(node: tuple) -> Column:
        if node[0] == "!" and len(node) == 2:
            return ~column_of(node[1])
        if node[0] in ("&", "|") and len(node) == 2:
            return _all_of([column_of(n) for n in node[1]], (lambda a, b: a & b) if node[0] == "&" else (lambda a, b: a | b))
        return holds[_frozen(node)]

    return df.where(column_of(tree)).select(*[F.col(f"`{c}`") for c in columns])


def _frozen(leaf: tuple) -> tuple:
    return (leaf[0], leaf[1], tuple(leaf[2]) if isinstance(leaf[2], (list, set, tuple)) else leaf[2])


def _leaves(node: tuple) -> list[tuple]:
    if node[0] == "!" and len(node) == 2:
        return _leaves(node[1])
    if node[0] in ("&", "|") and len(node) == 2:
        return [leaf for n in node[1] for leaf in _leaves(n)]
    return [node]


@dataclass(frozen=True)
class _Walk:
    """A path: steps to one row each (path, step, path before), then a column of a table, or the step to many and what follows."""

    steps: tuple
    table: str
    column: str
    rest: tuple[Step, str] | None = None


def _walk(table: str, path: list[str], references) -> _Walk:
    steps, at, before = [], table, ()
    for i, name in enumerate(path[:-1]):
        step = references[(at, name)]
        step = step if isinstance(step, Step) else Step(*step)
        if step.many:
            return _Walk(tuple(steps), at, step.own, (step, ".".join(path[i + 1:])))
        here = (*before, name)
        steps.append((here, step, before))
        at, before = step.table, here
    return _Walk(tuple(steps), at, path[-1])


def _one_per_key(df: DataFrame, key: str, columns: Sequence[str], alias: str) -> DataFrame:
    """The named columns by key under other names; a key that is there twice stops the run when its row is used."""
    twice = F.raise_error(F.lit(f"{key} is not unique: say that the reference is to many rows"))
    rows = df.where(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").alias(alias + "__key"))
    values = [F.when(F.count(F.lit(1)) > 1, twice.cast(df.schema[c].dataType)).otherwise(F.first(F.col(f"`{c}`"))).alias(alias + c) for c in columns]
    return rows.agg(*values)


# The parts of a stored expression, each with the white space after it.
_TOKEN = r"(?s)(?:'[^'\\]*+(?:\\.[^'\\]*+)*+'|\"[^\"\\]*+(?:\\.[^\"\\]*+)*+\"|[A-Za-z_]\w*+(?:\.[A-Za-z_]\w*+)*+|\s++|.)\s*+"
_STRING = r"(?s)^(['\"])([A-Za-z_]\w*(?:\.[A-Za-z_]\w*)*)((?::\w+| (?:asc|desc))?)\1(\s*)$"
_TEMPLATE = r"(?s)^(object\.)([A-Za-z_]\w*(?:\.[A-Za-z_]\w*)*)()(\s*)$"
_COMPARES = [*OPERATORS, *_TREES]


def path_tokens(df: DataFrame, key: str, text: str, model: str, form: str) -> DataFrame:
    """key, model, at (the token's place), path: the paths in stored texts.

    ``form`` tells where paths stand: first in the terms of a "domain", in every string of a "list" (a unit or a
    direction may follow it), behind ``object.`` in a "template". Values are never paths.
    """
    tokens = F.regexp_extract_all(F.col(text), F.lit(_TOKEN), F.lit(0))
    listed = df.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(model).alias("model"), tokens.alias("tokens"))
    pattern = _TEMPLATE if form == "template" else _STRING
    token = F.col("token")
    if form == "domain":
        at = lambda i: F.btrim(F.coalesce(F.get("tokens", F.col("at") + i), F.lit("")))
        operator = at(F.lit(2))
        compares = operator.isin([f"{q}{o}{q}" for o in _COMPARES for q in ("'", '"')])
        here = at(F.lit(-1)).isin("(", "[") & (at(F.lit(1)) == ",") & compares & (at(F.lit(3)) == ",")
    elif form in ("list", "template"):
        here = F.lit(True)
    else:
        raise ValueError("form is domain, list or template")
    placed = listed.select("key", "model", "tokens", F.posexplode("tokens").alias("at", "token"))
    path = F.regexp_extract(token, pattern, 2)
    return placed.where(here & (path != "")).select("key", "model", "at", path.alias("path"))


def walked(paths: DataFrame, fields: DataFrame, renames: DataFrame | None = None) -> DataFrame:
    """model, path, new_path, step, on_model: each distinct path under its new names, and the first step that is gone.

    ``fields`` is (model, name, relation): the columns of every model, and the model that a reference leads to.
    ``renames`` is (model, old, new), of names in ``fields``. All paths go one step further in each round; what
    moves is one row per path. ``step`` and ``on_model`` are NULL where the whole path is known.
    """
    known = stored(fields.select(F.col("model").alias("__m"), F.col("name").alias("__n"), "relation").distinct())
    if renames is not None:
        known = attach(known, renames, [("__m", "model"), ("__n", "old")], {"__new": "new"})
    else:
        known = known.withColumn("__new", F.lit(None).cast("string"))
    now = stored(paths.select("model", "path").distinct().withColumns({
        "at": F.col("model"), "names": F.split("path", r"\."), "done": F.array().cast("array<string>"), "step": F.lit(None).cast("string"), "on_model": F.lit(None).cast("string"),
    }))
    longest = now.agg(F.max(F.size("names"))).first()[0] or 0
    for i in range(longest):
        name = F.get("names", F.lit(i))
        looked = now.withColumn("__name", name).withColumn("__look", F.when(F.col("step").isNull(), F.col("at")))
        found = attach(looked, known.withColumn("__there", F.lit(True)), [("__look", "__m"), ("__name", "__n")], {"__to": "relation", "__new": "__new", "__there": "__there"})
        missing = F.col("__name").isNotNull() & F.col("step").isNull() & F.col("__there").isNull()
        now = found.select(
            "model", "path", F.coalesce("__to", F.lit("")).alias("at"), "names",
            F.when(F.col("__name").isNull(), F.col("done")).otherwise(F.concat("done", F.array(F.coalesce("__new", "__name")))).alias("done"),
            F.when(missing, F.col("__name")).otherwise(F.col("step")).alias("step"), F.when(missing, F.nullif("at", F.lit(""))).otherwise(F.col("on_model")).alias("on_model"),
        )
    return now.select("model", "path", F.array_join("done", ".").alias("new_path"), "step", "on_model")


def rename_paths(
    df: DataFrame, key: str, text: str, model: str, fields: DataFrame, renames: DataFrame, form: str = "domain",
) -> DataFrame:
    """Field names renamed inside the paths of stored texts, at every step by the model it is on.

    ``key`` is unique; ``fields`` (model, name, relation) and ``renames`` (model, old, new) go by the old names.
    Names are looked up once, so renames may swap. Strings that are values stay, and what is not a known path.
    """
    found = stored(path_tokens(df, key, text, model, form))
    moved = walked(found, fields, renames).where("new_path <> path")
    changed = found.join(moved.select(F.col("model").alias("__m"), F.col("path").alias("__p"), "new_path"), (F.col("model").eqNullSafe(F.col("__m"))) & (F.col("path") == F.col("__p")))
    # At most the paths of one text come together.
    per_row = changed.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("at", "new_path"))).alias("__to"))
    out = attach(df, per_row, [(key, "key")], ["__to"], reduced=True)
    tokens = F.regexp_extract_all(F.col(text), F.lit(_TOKEN), F.lit(0))
    pattern = _TEMPLATE if form == "template" else _STRING

    def put(token: Column, at: Column) -> Column:
        to = F.try_element_at("__to", at)
        part = lambda i: F.regexp_extract(token, pattern, i)
        closing = part(4) if form == "template" else F.concat(part(3), part(1), part(4))
        return F.when(to.isNotNull(), F.concat(part(1), to, closing)).otherwise(token)

    return out.withColumn(text, F.when(F.col("__to").isNull(), F.col(text)).otherwise(F.array_join(F.transform(tokens, put), ""))).select(*[F.col(f"`{c}`") for c in df.columns])


def broken_paths(df: DataFrame, key: str, text: str, model: str, fields: DataFrame, form: str = "domain") -> DataFrame:
    """key, path, step, on_model: paths of stored texts that lead nowhere, with the first step that is gone and its model."""
    found = stored(path_tokens(df, key, text, model, form))
    gone = walked(found, fields).where("step is not null").select(F.col("model").alias("__m"), F.col("path").alias("__p"), "step", "on_model")
    joined = found.join(gone, F.col("model").eqNullSafe(F.col("__m")) & (F.col("path") == F.col("__p")))
    return joined.select(F.col("key").alias(key), "path", "step", "on_model").distinct()


def disable_broken_filters(df: DataFrame, key: str, text: str, model: str, fields: DataFrame, active: str, form: str = "domain") -> DataFrame:
    """Deactivate saved filters of which some path leads nowhere."""
    broken = broken_paths(df, key, text, model, fields, form).select(F.col(key).alias("__broken_key"))
    marked = flag_related(df, broken, [(key, "__broken_key")], "__broken")
    return set_where(marked, {active: False}, F.col("__broken")).drop("__broken")
