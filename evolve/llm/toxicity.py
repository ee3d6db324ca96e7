"""Toxic passages as maximum-scoring segments.

Every word has a log-odds score: how much more often it stands in documents labelled
toxic. The share of toxic documents among a word's occurrences has a Dirichlet prior
centred on the share of its prefix (6, 5, then 4 bytes, then all words), so words never
seen are judged by their family and rare words stay near it. A linear-time scan over
the scores finds all maximal segments, each a passage whose score no shorter or longer
neighbour beats. Extreme-value statistics (Karlin-Altschul) turn a segment's score and
its document's length into an E-value: how many such segments chance alone would give.
A document's evidence is the sum of -ln E over its significant segments, and a logistic
curve fitted on the labelled documents makes it a score.

Scores depend on the text alone. Labels are learned from at most ``SAMPLE`` labelled
documents (chosen by a hash of the id, so every run takes the same). The model holds
every word and prefix that stands at least ``FEWEST`` times in them, 16 bytes each; the
sample alone bounds what is sent to the tasks. A labelled document never judges itself:
its own words are taken out of the counts first.

Defined results: a null or empty text has no segments and the lowest score; several
label rows of one document count as toxic if any is; without both kinds of label every
score is the share of toxic labels (0.5 at most, exclusive, when there are none);
repeated rows give repeated results; an empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evolve.llm.common import slices
from evolve.llm.words import mix, words
from evolve.storage import stored

SAMPLE = 100_000
FEWEST = 3
PREFIXES = (4, 5, 6)
PRIOR = 8.0
DRIFT = 1.0
BINS = 400
SPAN = 10.0


@dataclass
class Model:
    """Word and prefix counts by level (whole words first), and the calibration."""

    keys: list[np.ndarray]
    toxic: list[np.ndarray]
    clean: list[np.ndarray]
    share: float
    lam: float = 1.0
    k: float = 1.0
    weight: float = 0.0
    bias: float = -1.0

    def scores(self, hashes: list[np.ndarray], own: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """Score of each word: log-odds less the drift. ``own``: text number and label of each word, taken out of the counts."""
        share = np.full(len(hashes[0]), self.share)
        # From the shortest prefix to the whole word, each level's prior is the level above.
        for level in (*range(1, len(hashes)), 0):
            t, c = _look_up(self.keys[level], hashes[level], self.toxic[level], self.clean[level])
            if own is not None and len(t):
                text_of, label = own
                pairs = mix(hashes[level] + mix(text_of.astype(np.uint64) + np.uint64(1)))
                _, inverse, many = np.unique(pairs, return_inverse=True, return_counts=True)
                mine = many[inverse]
                t, c = np.maximum(t - mine * (label == 1), 0), np.maximum(c - mine * (label == 0), 0)
            share = (t + PRIOR * share) / (t + c + PRIOR)
        odds = lambda s: math.log(s / (1 - s)) if np.isscalar(s) else np.log(s / (1 - s))
        return np.clip(odds(np.clip(share, 1e-6, 1 - 1e-6)) - odds(self.share) - DRIFT, -SPAN, SPAN)


def _look_up(keys: np.ndarray, wanted: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    if not len(keys):
        return [np.zeros(len(wanted)) for _ in values]
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    found = keys[at] == wanted
    return [np.where(found, v[at], 0.0) for v in values]


def segments(score: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, past the last, score), in time linear in the words."""
    up = np.flatnonzero(score > 0)
    if not len(up):
        return []
    total = np.concatenate(([0.0], np.cumsum(score)))
    # Each kept segment: first word, past the last, sum before it, sum after it.
    # A stack of those whose sum before is below that of all later ones.
    kept: list[list] = []
    for i in up.tolist():
        here = [i, i + 1, total[i], total[i + 1]]
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= here[2]:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= here[3]:
                kept.append([*here, j])
                break
            here = [kept[j][0], here[1], kept[j][2], here[3]]
            del kept[j:]
    return [(a, b, float(after - before)) for a, b, before, after, _ in kept]


def labelled(docs: DataFrame, labels: DataFrame, key: str, text: str, sample: int, learn_from) -> DataFrame:
    """At most about ``sample`` labelled rows: text, toxic. ``learn_from``: a condition on the key."""
    marked = labels.where(F.col("toxic").isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max("toxic").cast("int").alias("toxic"))
    marked = marked.where(learn_from(F.col("key")))
    many = marked.count()
    share = min(1.0, sample / max(many, 1))
    marked = marked.where(F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    # At most about ``sample`` keys and flags: 2 MB for the default.
    return docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(marked), "key").select("text", "toxic")


def fit(rows: DataFrame) -> Model:
    """Learn word scores and their calibration from rows of text and toxic (0 or 1)."""
    levels = 1 + len(PREFIXES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Level -1 counts documents, the other levels words and prefixes.
        for batch in slices(batches, "text"):
            found, label = words(batch.column("text").to_pylist()), batch.column("toxic").to_numpy()
            marks = label[found.text_of()]
            yield _counted(-1, np.zeros(1, dtype=np.uint64), np.zeros(len(label), dtype=np.int64), label)
            for level, h in enumerate(found.hashes(*PREFIXES)):
                keys, inverse = np.unique(h, return_inverse=True)
                yield _counted(level, keys, inverse, marks)

    counts = rows.mapInArrow(count, "level long, word long, toxic long, clean long").groupBy("level", "word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counts = stored(counts.withColumn("all_t", F.when(F.col("level") == 0, F.col("toxic"))).withColumn("all_c", F.when(F.col("level") == 0, F.col("clean"))))
    sums = counts.agg(F.sum("all_t").alias("t"), F.sum("all_c").alias("c"), F.sum(F.when(F.col("level") < 0, F.col("toxic"))).alias("dt"), F.sum(F.when(F.col("level") < 0, F.col("clean"))).alias("dc"), F.max(F.greatest("toxic", "clean")).alias("most")).first()
    t, c, docs_t, docs_c = (sums[k] or 0 for k in ("t", "c", "dt", "dc"))
    none = [np.zeros(0, dtype=np.uint64)] * levels
    if not (t and c and docs_t and docs_c):
        base = min(max(docs_t / max(docs_t + docs_c, 1), 1e-3), 0.499)
        return Model(none, none, none, 0.5, bias=math.log(base / (1 - base)))
    # A feature informs when it is frequent enough to leave its prior; all of those are kept, as plain arrays.
    whole = "int" if sums["most"] < 1 << 31 else "long"
    kept = counts.where(f"level >= 0 and toxic + clean >= {FEWEST}").select(F.col("level").cast("byte"), "word", F.col("toxic").cast(whole), F.col("clean").cast(whole)).toArrow()
    at, word, in_toxic, in_clean = (kept.column(k).to_numpy() for k in ("level", "word", "toxic", "clean"))
    keys, toxic, clean = [], [], []
    for level in range(levels):
        own = np.flatnonzero(at == level)
        own = own[np.argsort(word[own].view(np.uint64))]
        keys.append(word[own].view(np.uint64))
        toxic.append(in_toxic[own])
        clean.append(in_clean[own])
    model = Model(keys, toxic, clean, t / (t + c))
    sent = rows.sparkSession.sparkContext.broadcast(model)
    edges = np.linspace(-SPAN, SPAN, BINS + 1)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A row for each document: label, words, segment scores; and one for each slice: the clean words' scores by bin.
        for batch in slices(batches, "text"):
            found, label = words(batch.column("text").to_pylist()), batch.column("toxic").to_numpy()
            text_of = found.text_of()
            score = sent.value.scores(found.hashes(*PREFIXES), (text_of, label[text_of]))
            segs = [[s for *_, s in segments(score[found.first[d]:found.first[d + 1]])] for d in range(len(label))]
            many = np.histogram(score[label[text_of] == 0], edges)[0].tolist()
            n = len(label)
            yield pa.record_batch(
                [pa.array([*label.tolist(), None], pa.int32()), pa.array([*np.diff(found.first).tolist(), 0], pa.int64()),
                 pa.array([*segs, []], pa.list_(pa.float64())), pa.array([None] * n + [many], pa.list_(pa.int64()))],
                names=["toxic", "n", "segments", "bins"],
            )

    scanned = stored(rows.mapInArrow(scan, "toxic int, n long, segments array<double>, bins array<long>"))
    by_bin = scanned.where("bins is not null").select(F.posexplode("bins").alias("bin", "n")).groupBy("bin").agg(F.sum("n").alias("n")).collect()
    many = np.zeros(BINS)
    for r in by_bin:
        many[r["bin"]] = r["n"]
    model.lam = _decay((edges[:-1] + edges[1:]) / 2, many)
    per_doc = scanned.where("toxic is not null")
    best = F.coalesce(F.array_max("segments"), F.lit(0.0))
    sums = per_doc.where("toxic = 0 and n > 0").agg(F.sum(F.col("n") * F.exp(-model.lam * best)).alias("total"), F.count("*").alias("n")).first()
    model.k = max(sums["n"] or 0, 1) / max(sums["total"] or 0.0, 1e-9)
    base = F.log(F.greatest(F.lit(model.k) * F.col("n"), F.lit(1e-9)))
    gain = F.aggregate("segments", F.lit(0.0), lambda acc, x: acc + F.greatest(F.lit(model.lam) * x - base, F.lit(0.0)))
    bin_ = F.least((gain / EVIDENCE_STEP).cast("long"), F.lit(BINS - 1))
    table = np.zeros((2, BINS))
    for r in per_doc.groupBy("toxic", bin_.alias("bin")).count().collect():
        table[r["toxic"], r["bin"]] = r["count"]
    model.weight, model.bias = _logistic((np.arange(BINS) + 0.5) * EVIDENCE_STEP, table)
    return model


def _counted(level: int, keys: np.ndarray, inverse: np.ndarray, marks: np.ndarray) -> pa.RecordBatch:
    """A row for each key: in how many places marked 1 and 0 it stands."""
    t = np.bincount(inverse, weights=marks, minlength=len(keys)).astype(np.int64)
    n = np.bincount(inverse, minlength=len(keys)).astype(np.int64)
    return pa.record_batch([pa.array(np.full(len(keys), level)), pa.array(keys.view(np.int64)), pa.array(t), pa.array(n - t)], names=["level", "word", "toxic", "clean"])


EVIDENCE_STEP = 0.1


def _decay(score: np.ndarray, many: np.ndarray) -> float:
    """The positive root of sum p exp(lambda score) = 1, if scores drift down and can rise."""
    p = many / max(many.sum(), 1)
    if (p * score).sum() >= 0 or not (p[score > 0] > 0).any():
        return 1.0
    low, high = 0.0, 1.0
    while (p * np.exp(high * score)).sum() < 1 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if (p * np.exp(mid * score)).sum() < 1 else (low, mid)
    return high


def _logistic(x: np.ndarray, table: np.ndarray) -> tuple[float, float]:
    """Weight and bias of a logistic curve by Newton's method, with a weak pull to zero that keeps it finite."""
    w = np.zeros(2)
    design = np.stack([x, np.ones_like(x)], axis=1)
    many, hits = table.sum(axis=0), table[1]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (hits - many * p) - 0.01 * w
        hessian = (design * (many * p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def _evidence(model: Model, score: np.ndarray) -> tuple[float, list[tuple[int, int, float, float]]]:
    """Sum of -ln E over the significant segments, and those segments with their E-values."""
    found, total = [], 0.0
    base = math.log(max(model.k * len(score), 1e-9)) if len(score) else 0.0
    for a, b, s in segments(score):
        gain = model.lam * s - base
        if gain > 0:
            total += gain
            found.append((a, b, s, math.exp(-gain)))
    return total, found


def score(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, score (0 to 1) and ``passages``: first word, past the last, score and E-value of each significant one."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    passage = pa.struct([("first", pa.int64()), ("past", pa.int64()), ("score", pa.float64()), ("e_value", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in slices(batches, "text"):
            found = words(batch.column("text").to_pylist())
            values = known.scores(found.hashes(*PREFIXES))
            out, passages = [], []
            for d in range(batch.num_rows):
                x, segs = _evidence(known, values[found.first[d]:found.first[d + 1]])
                out.append(1 / (1 + math.exp(-max(min(known.weight * x + known.bias, 30.0), -30.0))))
                passages.append([dict(zip(("first", "past", "score", "e_value"), s, strict=True)) for s in segs])
            yield pa.record_batch([batch.column("key"), pa.array(out, pa.float64()), pa.array(passages, pa.list_(passage))], names=[key, "score", "passages"])

    kind = kept.schema["key"].dataType.simpleString()
    return kept.mapInArrow(run, f"`{key}` {kind}, score double, passages array<struct<first long, past long, score double, e_value double>>")


def held_out(key: Column) -> Column:
    """Rows that are never learned from: crc32 of the key as text divides by five."""
    return F.crc32(key.cast("string")) % 5 == 0


def fit_on(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", sample: int = SAMPLE) -> Model:
    """The model of all rows that are not held out."""
    return fit(labelled(docs, labels, key, text, sample, lambda k: ~held_out(k)))
