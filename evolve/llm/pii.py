"""Personal data by weak supervision, in DataFrame operations only.

Patterns find candidate spans of six kinds. Five labelers vote on each (for, against or
not at all): its kind's exact rule, words before it, gazetteers (domains, card prefixes,
country codes, key prefixes, given names), its shape, and whether it stands alone.
Expectation-maximisation over the counts of vote patterns estimates, per kind, how
reliable each labeler is, and so how likely each pattern is personal data. Those
likelihoods train the final classifier, a logistic curve over votes and span features.
Spans that follow the exact rule of the four base kinds always stay; the classifier adds
others. The counts of patterns are bounded by kinds, votes and features, never by rows,
and are the only thing that comes to the driver.

Positions are code points. A kind's matches are leftmost and do not overlap; those that
fail its rule are dropped, and the search goes on behind them.

Defined results: a null text is taken as empty and has no spans; repeated rows give
repeated results; without any candidate the classifier adds nothing; an empty table
gives an empty one.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evolve.storage import stored

KINDS = ("email", "ip", "card", "phone", "secret", "person")
BASE = 4
# The base patterns, with possessive loops and run starts that match the same
# spans in time linear in the text.
_LOCAL = "A-Za-z0-9._%+-"
GIVEN = (
    "James", "Mary", "John", "Patricia", "Robert", "Jennifer", "Michael", "Linda", "David", "Elizabeth", "Anna", "Maria", "Peter",
    "Hans", "Pierre", "Carlos", "Sophie", "Thomas", "Laura", "Daniel",
)
PATTERNS = (
    rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[ -]?[0-9]){13,}+",
    r"\+[0-9][ ().0-9-]+[0-9]",
    r"(?:AKIA|ghp_|sk_live_)[0-9A-Za-z]{10,}+|(?:[Pp]ass(?:word|wd)|[Ss]ecret|[Tt]oken|[Aa]pi[_-]?[Kk]ey) ?[=:] ?[\"']?[0-9A-Za-z_/+-]{8,}+",
    rf"(?<![A-Za-z])(?:(?:Mr|Mrs|Ms|Dr|Prof)\.?|{'|'.join(GIVEN)}) [A-Z][a-z]++(?![A-Za-z])",
)
# Labelers: what speaks for a span in the characters before it, and the gazetteers.
BEFORE = (
    r"(?i)(mail|contact|write|reach)\W*$", r"(?i)(ip|host|server|address|from)\W*$", r"(?i)(card|visa|pay|account)\W*$",
    r"(?i)(phone|tel|call|mobile|fax)\W*$", r"(?i)(key|login|credential|auth)\W*$", r"(?i)(name|dear|author|contact|by)\W*$",
)
GAZETTEER = (
    r"@(?:[a-z0-9-]+\.)*(?:example|gmail|yahoo|outlook|hotmail|web|orange)\.[a-z]+$", r"^(?:10|127|172|192)\.", r"^(?:4|5[1-5]|34|37|6011|65)",
    r"^\+(?:1|33|34|44|49)(?![0-9])", r"^(?:AKIA|ghp_|sk_live_)|^[Pp]ass", rf"^(?:{'|'.join(GIVEN)}) ",
)
CONTEXT = 24
LABELERS = 5
ROUNDS = 40
_BLOCK = 256


def _matches(text: Column, pattern: str) -> Column:
    """Structs of start, end, match, before and after for every match, each computed once per text."""
    none = F.array().cast("array<struct<start:int,end:int,match:string,before:string,after:string>>")

    def placed(found: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        both = F.transform(F.array(F.struct(found.alias("m"), gaps.alias("g"))), lambda s: F.struct(
            s["m"].alias("m"), s["g"].alias("g"), F.zip_with(s["g"], s["m"], lambda g, m: F.length(g) + F.coalesce(F.length(m), F.lit(0))).alias("n")))
        # Starts are sums of what stands before; in blocks, so that many matches do not cost the square of their number.
        total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)
        block = F.transform(both, lambda s: F.struct(s["m"].alias("m"), s["g"].alias("g"), s["n"].alias("n"), F.transform(
            F.sequence(F.lit(0), F.floor(F.size(s["m"]) / _BLOCK).cast("int")),
            lambda b: total(F.slice(s["n"], b * _BLOCK + 1, F.lit(_BLOCK)))).alias("b")))
        block = F.transform(block, lambda s: F.struct(s["m"].alias("m"), s["g"].alias("g"), s["n"].alias("n"), F.transform(
            s["b"], lambda _, i: total(F.slice(s["b"], F.lit(1), i))).alias("before")))

        def one(s: Column, i: Column) -> Column:
            start = (
                F.get(s["before"], F.floor(i / _BLOCK).cast("int")) + total(F.slice(s["n"], F.floor(i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK))
                + F.length(F.get(s["g"], i))
            )
            return F.struct(
                start.alias("start"), (start + F.length(F.get(s["m"], i))).alias("end"), F.get(s["m"], i).alias("match"),
                F.right(F.get(s["g"], i), F.lit(CONTEXT)).alias("before"), F.left(F.get(s["g"], i + 1), F.lit(CONTEXT)).alias("after"),
            )

        return F.get(F.transform(block, lambda s: F.transform(s["m"], lambda _, i: one(s, i))), F.lit(0))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.get(F.transform(F.array(found), lambda m: F.when(F.size(m) == 0, none).otherwise(placed(m))), F.lit(0))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    value = lambda i: F.substring(digits, i, 1).cast("int")

    def term(i: Column) -> Column:
        twice = value(i) * 2
        return F.when((F.length(digits) - i) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(value(i))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + term(i)) % 10 == 0


def _follows_rule(kind: int, match: Column) -> Column:
    """The exact rule of a kind; the added kinds' rule is their pattern."""
    if kind == 1:
        return ~match.rlike(r"(?:^|\.)0*+(?:[1-9][0-9]{3}|[3-9][0-9]{2}|2[6-9][0-9]|25[6-9])")
    if kind == 2:
        return F.get(F.transform(F.array(_digits(match)), lambda d: F.length(d).between(14, 19) & _luhn(d)), F.lit(0))
    if kind == 3:
        return F.length(_digits(match)).between(10, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _judged(kind: int, s: Column) -> Column:
    """A candidate with its votes and features."""
    match, before, after = s["match"], s["before"], s["after"]
    valid = _follows_rule(kind, match)
    alone = ~before.rlike(r"[0-9A-Za-z.@]$") & ~after.rlike(r"^[0-9A-Za-z@]")
    digits = F.length(_digits(match))
    shape = {
        0: _vote(F.length(match).between(6, 64), F.length(match) > 96), 1: _vote(F.length(match) >= 9, F.length(match) > 15),
        2: _vote(digits.isin(15, 16), digits > 19), 3: _vote(digits.between(10, 13), digits < 8),
        4: _vote(match.rlike("[0-9]") & match.rlike("[A-Za-z]{2}"), ~match.rlike("[0-9]")), 5: _vote(F.length(match).between(6, 40), F.length(match) > 60),
    }[kind]
    votes = (
        _vote(valid, ~valid) if kind < BASE else F.lit(1), _vote(before.rlike(BEFORE[kind]), F.lit(False)),
        _vote(match.rlike(GAZETTEER[kind]), F.lit(False)), shape, _vote(alone, ~alone),
    )
    return F.struct(
        s["start"].cast("long").alias("start"), F.lit(kind).alias("kind"), s["end"].cast("long").alias("end"), valid.alias("valid"),
        *[v.cast("int").alias(f"v{j}") for j, v in enumerate(votes)],
        F.least(F.floor(F.length(match) / 8), F.lit(4)).cast("int").alias("size"), F.least(F.floor(4 * digits / F.length(match)), F.lit(3)).cast("int").alias("digits"),
    )


def _found(body: Column) -> Column:
    """All candidates of a text with their votes and features."""
    return F.concat(*[F.transform(_matches(body, p), partial(_judged, k)) for k, p in enumerate(PATTERNS)])


def candidates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key and ``spans``, every candidate with its votes and features."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key), _found(body).alias("spans"))


@dataclass
class Model:
    """The classifier: weights per kind of (bias, votes), and of size and digit share."""

    kinds: np.ndarray
    size: np.ndarray
    digits: np.ndarray

    def accepts(self, s: Column) -> Column:
        at = lambda values, i: F.element_at(F.array(*[F.lit(float(v)) for v in values]), i + 1)
        total = at(self.kinds[:, 0], s["kind"]) + at(self.size, s["size"]) + at(self.digits, s["digits"])
        for j in range(LABELERS):
            total = total + at(self.kinds[:, 1 + j], s["kind"]) * s[f"v{j}"]
        # A match that fails the exact rule of a base kind is never added.
        return (total >= 0) & (s["valid"] | (s["kind"] >= BASE))


def reliabilities(votes: np.ndarray, many: np.ndarray) -> np.ndarray:
    """How likely each vote pattern is true, by expectation-maximisation over counted patterns (rows of -1, 0, 1)."""
    weight = np.maximum(many, 0).astype(float)
    likely = np.clip(0.5 + 0.2 * votes.sum(axis=1), 0.05, 0.95)
    # The exact rule is the one labeler that is right more often than not by construction.
    likely = np.where(votes[:, 0] < 0, np.minimum(likely, 0.2), likely)
    for _ in range(ROUNDS):
        share = (weight @ likely + 1) / (weight.sum() + 2)
        log_yes, log_no = np.full(len(votes), np.log(share)), np.full(len(votes), np.log(1 - share))
        for j in range(votes.shape[1]):
            for v in (-1, 0, 1):
                here = votes[:, j] == v
                yes = ((weight * likely)[here].sum() + (2 if v > 0 else 0.5)) / ((weight * likely).sum() + 3)
                no = ((weight * (1 - likely))[here].sum() + (2 if v < 0 else 0.5)) / ((weight * (1 - likely)).sum() + 3)
                log_yes[here] += np.log(yes)
                log_no[here] += np.log(no)
        likely = 1 / (1 + np.exp(np.clip(log_no - log_yes, -30, 30)))
    return likely


def fit(found: DataFrame) -> Model:
    """Learn from the vote patterns of all candidates."""
    names = [f"v{j}" for j in range(LABELERS)]
    rows = (
        found.select(F.explode("spans").alias("s")).select("s.kind", *[f"s.{n}" for n in names], "s.size", "s.digits")
        .groupBy("kind", *names, "size", "digits").count().collect()
    )
    by_kind = defaultdict(list)
    for r in rows:
        by_kind[r["kind"]].append(r)
    kinds, size, digits = np.zeros((len(KINDS), 1 + LABELERS)), np.zeros(5), np.zeros(4)
    kinds[:, 0] = -1.0
    design, target, weight = [], [], []
    width = kinds.size + len(size) + len(digits)
    for kind, own in sorted(by_kind.items()):
        own.sort(key=lambda r: tuple(r))
        votes = np.array([[r[n] for n in names] for r in own])
        patterns, of = np.unique(votes, axis=0, return_inverse=True)
        many = np.array([r["count"] for r in own], dtype=float)
        likely = reliabilities(patterns, np.bincount(of.reshape(-1), weights=many))[of.reshape(-1)]
        for r, v, p, m in zip(own, votes, likely, many, strict=True):
            x = np.zeros(width)
            x[kind * (1 + LABELERS):(kind + 1) * (1 + LABELERS)] = [1, *v]
            x[kinds.size + r["size"]] = x[kinds.size + len(size) + r["digits"]] = 1
            design.append(x)
            target.append(p)
            weight.append(m)
    if not design:
        return Model(kinds, size, digits)
    x, y, m = np.array(design), np.array(target), np.array(weight)
    w = np.zeros(width)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (m * p * (1 - p))[:, None]).T @ x + np.eye(width), x.T @ (m * (y - p)) - w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return Model(w[:kinds.size].reshape(kinds.shape), w[kinds.size:kinds.size + 5], w[kinds.size + 5:])


def detect(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key and ``spans`` (start, kind, end, base) in order: all that follow a base rule, and those added."""
    found = stored(candidates(docs, text, key))
    model = fit(found)
    base = lambda s: (s["kind"] < BASE) & s["valid"]
    kept = F.filter("spans", lambda s: base(s) | model.accepts(s))
    return found.select(key, F.array_sort(F.transform(kept, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), base(s).alias("base")))).alias("spans"))


def _named(s: Column) -> Column:
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1)
    return F.concat_ws(":", kind, s["start"].cast("string"), s["end"].cast("string"))


def summary(detected: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the digest of the base spans and the list of all spans."""
    many = lambda k: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == k))).cast("long")
    listed = lambda c: F.array_join(F.transform(c, _named), ",")
    return detected.select(
        key, *[many(k).alias(f"n_{KINDS[k]}") for k in range(BASE)],
        F.sha2(listed(F.filter("spans", lambda s: s["base"])).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; overlapping spans become one, of the first kind.

    Spans are found and replaced in one row; nothing is joined.
    """
    model = fit(stored(candidates(docs, text, key)))
    body = F.coalesce(F.col(text), F.lit(""))
    found = _found(body)
    kept = F.array_sort(F.transform(
        F.filter(found, lambda s: ((s["kind"] < BASE) & s["valid"]) | model.accepts(s)),
        lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(acc: Column, s: Column) -> Column:
        piece = F.concat(F.substring(body, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit("<"),
                         F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1), F.lit(">"))
        return F.when(s["start"] < acc["at"], F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))).otherwise(
            F.struct(F.concat(acc["out"], F.array(piece)).alias("out"), s["end"].alias("at")))

    done = lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(body, (acc["at"] + 1).cast("int"), F.lit(2**31 - 1)))
    replaced = F.get(F.transform(F.array(kept), lambda k: F.when(F.size(k) == 0, F.col(text)).otherwise(F.aggregate(k, start, step, done))), F.lit(0))
    return docs.withColumn(text, replaced)
