"""Licence scans by a positional index of rare words.

The templates' words are the vocabulary. How many documents hold each of them gives its
weight (IDF over all documents). A file's words of that vocabulary are its postings. A
template is looked up by the rarest word of its mandatory key phrase: an occurrence says
where the template would start, and the postings of the phrase's other words are
intersected with that at their relative positions. The template's further words are
compared at their places, and the share of its weight that agrees is the coverage. A
template is found where the coverage reaches its threshold and its key phrase stands at
its place, byte for byte; since the phrase has to stand there, no such place is missed.

Defined results: a null text is taken as empty: no words, no places, empty label lists,
score 0; repeated rows give repeated results; an empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evolve.llm.common import slices
from evolve.llm.words import Words, words


@dataclass(frozen=True)
class Template:
    """A licence text: its label, its words, the key phrase that must stand in it, the least coverage."""

    label: str
    text: str
    key: str
    least: float = 1.0


# The base phrases and their labels.
BASE = (
    Template("gpl", "gnu general public license", "gnu general public license"),
    Template("apache", "apache license", "apache license"),
    Template("cc-by", "cc by", "cc by"),
    Template("mit", "mit license", "mit license"),
)
NOTICES = (
    Template("gpl-3.0", "licensed under the gnu general public license version 3", "public license version 3", 0.7),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", "public license version 2", 0.7),
    Template("lgpl", "gnu lesser general public license", "lesser general public license", 0.8),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2", 0.7),
    Template("mit-notice", "released under the mit license", "mit license", 0.8),
    Template("cc-by-nc", "cc by nc", "cc by nc"),
    Template("cc-by-sa", "cc by sa", "cc by sa"),
    Template("cc0", "cc0 1 0 universal public domain dedication", "cc0", 0.6),
    Template("mpl-2.0", "mozilla public license version 2 0", "mozilla public license", 0.8),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms", 0.7),
    Template("all-rights-reserved", "all rights reserved", "all rights reserved"),
)

class Index:
    """The templates' words with their weights, and the key phrases with their rarest word first."""

    def __init__(self, templates: tuple[Template, ...], holders: dict[str, int], documents: int):
        self.templates = templates
        self.known, self.hashes = vocabulary_of(templates)
        idf = {w: math.log((1 + documents) / (1 + holders.get(w, 0))) + 1e-3 for w in self.known}
        self.posts = []
        for t in templates:
            terms, key = t.text.split(), t.key.split()
            ids = np.array([self.known[w] for w in terms])
            weight = np.array([idf[w] for w in terms])
            at = next(j for j in range(len(terms)) if terms[j:j + len(key)] == key)
            looked = sorted(range(at, at + len(key)), key=lambda j: (-weight[j], j))
            self.posts.append((ids, weight / weight.sum(), looked, at, [w.encode() for w in key]))

    def postings(self, ids: np.ndarray) -> list[np.ndarray]:
        """For each word of the vocabulary where it stands, ascending."""
        hits = np.flatnonzero(ids >= 0)
        hits = hits[np.argsort(ids[hits], kind="stable")]
        return np.split(hits, np.searchsorted(ids[hits], np.arange(1, len(self.known))))

    def places(self, found: Words, ids: np.ndarray, postings: list[np.ndarray], text_of: np.ndarray, which: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts (word numbers) of one template and the coverage at each."""
        terms, weight, looked, key_at, key = self.posts[which]
        n = len(ids)
        starts = postings[terms[looked[0]]] - looked[0]
        for j in looked[1:]:
            starts = starts[np.isin(starts + j, postings[terms[j]], assume_unique=True)]
        # The text is the one that the key phrase stands in.
        home = starts + key_at
        starts = starts[(home >= 0) & (home + len(key) <= n)]
        if not len(starts):
            return starts, np.zeros(0)
        home = text_of[starts + key_at]
        covered = np.zeros(len(starts))
        for j, (term, w) in enumerate(zip(terms.tolist(), weight.tolist(), strict=True)):
            at = np.clip(starts + j, 0, n - 1)
            same = (ids[at] == term) & (starts + j == at) & (text_of[at] == home)
            if key_at <= j < key_at + len(key):
                covered = np.where(same, covered, -np.inf)
            covered = covered + np.where(same, w, 0.0)
        good = covered >= self.templates[which].least - 1e-9
        good[good] = [all(found.word(s + key_at + j) == w for j, w in enumerate(key)) for s in starts[good].tolist()]
        return starts[good], np.minimum(covered[good], 1.0)


def vocabulary_of(templates: tuple[Template, ...]) -> tuple[dict[str, int], np.ndarray]:
    """The templates' words numbered in hash order, and those hashes."""
    terms = sorted({w for t in templates for w in t.text.split()})
    found = words([" ".join(terms)])
    hashes = found.hashes()[0]
    order = np.argsort(hashes)
    return {terms[k]: n for n, k in enumerate(order.tolist())}, hashes[order]


def _numbered(found: Words, hashes: np.ndarray) -> np.ndarray:
    """For each word its number in the vocabulary, or -1."""
    own = found.hashes()[0]
    at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
    return np.where(hashes[at] == own, at, -1)


def document_frequencies(docs: DataFrame, templates: tuple[Template, ...], text: str = "text") -> tuple[dict[str, int], int]:
    """In how many documents each word of the templates occurs, and the number of documents."""
    known, hashes = vocabulary_of(templates)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(len(hashes), dtype=np.int64), 0
        for batch in slices(batches, "text"):
            found = words(batch.column("text").to_pylist())
            ids = _numbered(found, hashes)
            hit = ids >= 0
            pairs = np.unique(found.text_of()[hit] * len(hashes) + ids[hit])
            total += np.bincount(pairs % len(hashes), minlength=len(hashes))
            rows += batch.num_rows
        yield pa.record_batch([pa.array([*range(len(hashes)), -1]), pa.array([*total.tolist(), rows])], names=["word", "n"])

    kept = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    sums = {r["word"]: r["n"] for r in kept.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return {w: sums.get(n, 0) for w, n in known.items()}, sums.get(-1, 0)


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id", templates: tuple[Template, ...] = BASE + NOTICES) -> DataFrame:
    """Per row: key, n_words, and ``found``: label, first word, words, coverage of every place of every template."""
    index = Index(templates, *document_frequencies(docs, templates, text))
    kept = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    place = pa.struct([("label", pa.string()), ("start", pa.int64()), ("words", pa.int64()), ("coverage", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = words(batch.column("text").to_pylist())
            ids, text_of = _numbered(found, index.hashes), found.text_of()
            out: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            if (ids >= 0).any():
                postings = index.postings(ids)
                for which, t in enumerate(index.templates):
                    starts, covered = index.places(found, ids, postings, text_of, which)
                    home = text_of[starts + index.posts[which][3]] if len(starts) else starts
                    for s, c, d in zip(starts.tolist(), covered.tolist(), home.tolist(), strict=True):
                        out[d].append({"label": t.label, "start": s - int(found.first[d]), "words": len(index.posts[which][0]), "coverage": c})
            yield pa.record_batch([batch.column("key"), pa.array(np.diff(found.first), pa.int64()), pa.array(out, pa.list_(place))], names=[key, "n_words", "found"])

    kind = kept.schema["key"].dataType.simpleString()
    return kept.mapInArrow(run, f"`{key}` {kind}, n_words long, found array<struct<label string, start long, words long, coverage double>>")


def summary(scanned: DataFrame, key: str = "doc_id", base: tuple[Template, ...] = BASE) -> DataFrame:
    """Per row the places of the base phrases (number, first, last) and the labels, base ones and all."""
    names = F.array(*[F.lit(t.label) for t in base])
    places = F.filter("found", lambda p: F.array_contains(names, p["label"]))
    labels = lambda c: F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda p: p["label"]))), ",")
    return scanned.select(
        key, "n_words", F.size(places).cast("long").alias("n_base"),
        F.array_min(F.transform(places, lambda p: p["start"])).alias("first_word"),
        F.array_max(F.transform(places, lambda p: p["start"])).alias("last_word"),
        labels(places).alias("base_labels"), labels(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda p: p["coverage"])), F.lit(0.0)).alias("score"),
    )
