"""Near-duplicate documents by improved consistent weighted sampling.

A document is the set of its five-word shingles, weighted by TF-IDF. Consistent weighted
sampling draws from it samples that two documents share with a probability equal to
their weighted Jaccard similarity; bands of samples are buckets, and documents that
share a bucket are compared by the exact weighted Jaccard similarity, at least 0.8.

Weights. tf is 1 + ln(count). idf runs from 1 for a shingle in every document to
``1 + IDF`` for one in at most ``RARE`` of them, by the logarithm of its share. Which
shingles are more frequent than that, and how frequent, is counted exactly over all
documents in two passes: the first counts cells of shingles, by ``TABLES`` hashes, and the
second counts the shingles all of whose cells reach the threshold. At most (mean shingles
per document) / RARE entries result, whatever the number of tasks; that bounds what is
sent to them.

Groups. Documents of one word sequence are one class. Each class is first compared with
the nearest (by its samples) of the centres of its buckets, two per bucket: the class that
shares most buckets with others, which in a group of edited copies is the one with the
fewest edits, and one by chance. Whoever is linked forms components. Then all pairs that
share a bucket but not a component are looked at in blocks inside the tasks: first by their
samples, which tells the classes whose texts are needed, then exactly. No pair leaves a
task unless it is a link, so a group of thousands of copies does not become as many rows.

Defined results: a document without words (null text among them) or without id links
with nothing; with fewer than five words it has one shingle of all its words; documents
of equal words are one group whatever their punctuation or case; repeated rows share one
result; an empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evolve.llm.blocks import block_pairs, grouped, runs
from evolve.llm.cells import heavy_cells, is_heavy
from evolve.llm.common import slices
from evolve.llm.components import components
from evolve.llm.words import mix, sequence_hashes, shingles, words
from evolve.storage import stored

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 16
ROWS = 4
IDF = 0.25
RARE = 1e-3
# Tables of cells, cells for each entry that could be frequent, and their bounds in a table: 4 to 64 MB of counts.
TABLES = 3
CELLS_PER_ENTRY = 8
LEAST_CELLS, MOST_CELLS = 1 << 20, 1 << 24
COUNT_BLOCK = 1_000_000
# Pairs whose samples agree less than this are not compared exactly: 4 deviations below the threshold.
LEAST_AGREEMENT = 0.6
MEMBERS = 1000
BLOCK = 512

_GRID = 1 << 16


def _gamma_quantiles() -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution, whose tail is (1 + x) exp(-x), by Newton's method."""
    tail = 1 - (np.arange(_GRID) + 0.5) / _GRID
    x = np.maximum(-np.log(tail), 1e-3) + 1
    for _ in range(60):
        x = np.maximum(x + ((1 + x) * np.exp(-x) - tail) / (x * np.exp(-x)), 1e-6)
    return x


class Weights:
    """Shingle weights: frequent shingles with their documents, sorted; all others count as rare."""

    def __init__(self, known: np.ndarray, holders: np.ndarray, documents: int):
        self.known = known
        share = np.minimum(holders / max(documents, 1), 1.0)
        self.idf = 1 + IDF * np.clip(np.log(np.maximum(share, RARE)) / math.log(RARE), 0, 1)

    def of(self, h: np.ndarray, count: np.ndarray) -> np.ndarray:
        idf = np.full(len(h), 1 + IDF)
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
            idf = np.where(self.known[at] == h, self.idf[at], idf)
        return (1 + np.log(count)) * idf


def _cells(h: np.ndarray, table: int, cells: int) -> np.ndarray:
    """The cells of shingles in one of the tables, all of which lie in one array."""
    return (mix(h ^ mix(np.full(1, table + 1, dtype=np.uint64))) % np.uint64(cells)).astype(np.int64) + table * cells


def weights(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> Weights:
    """Counts, over all rows, in how many documents the frequent shingles are."""
    kept = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = kept.agg(F.count("*").alias("n"), F.avg(F.octet_length("text")).alias("bytes")).first()
    documents, least = size["n"], max(2, math.ceil(size["n"] * RARE))
    # Some times as many cells as frequent shingles could fill, for words of eight bytes and more or less.
    cells = int(min(max((size["bytes"] or 0) / 8 / RARE * CELLS_PER_ENTRY, LEAST_CELLS), MOST_CELLS)) // 8 * 8

    def fill(batches: Iterator[pa.RecordBatch], table: np.ndarray) -> None:
        for batch in slices(batches, "text"):
            _, h, _ = shingles(words(batch.column("text").to_pylist()), shingle)
            for t in range(TABLES):
                np.add.at(table, _cells(h, t, cells), np.uint32(1))

    heavy = docs.sparkSession.sparkContext.broadcast(heavy_cells(kept, fill, TABLES * cells, least))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, held, size = np.frombuffer(heavy.value, dtype=np.uint8), [], 0

        def counted() -> pa.RecordBatch:
            known, many = np.unique(np.concatenate(held), return_counts=True)
            return pa.record_batch([pa.array(known.astype(np.int64)), pa.array(many)], names=["h", "n"])

        for batch in slices(batches, "text"):
            _, h, _ = shingles(words(batch.column("text").to_pylist()), shingle)
            for t in range(TABLES):
                h = h[is_heavy(bits, _cells(h, t, cells))]
            held.append(h)
            size += len(h)
            if size >= COUNT_BLOCK:
                yield counted()
                held, size = [], 0
        if size:
            yield counted()

    exact = kept.mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least).orderBy("h").toPandas()
    return Weights(exact["h"].to_numpy().astype(np.uint64), exact["n"].to_numpy().astype(float), documents)


def samples(text_of: np.ndarray, h: np.ndarray, w: np.ndarray, texts: int, many: int, tables=None) -> np.ndarray:
    """Improved consistent weighted sampling: ``many`` samples of each text as 32-bit codes (0 without shingles)."""
    r, inverse, log_c = tables if tables is not None else _tables()
    out = np.zeros((texts, many), dtype=np.uint32)
    if not len(h):
        return out
    starts = np.flatnonzero(np.concatenate(([True], text_of[1:] != text_of[:-1])))
    owner = text_of[starts]
    size = np.diff(np.concatenate((starts, [len(h)])))
    log_w, base = np.log(w).astype(np.float32), mix(h)
    rng = np.random.default_rng(9)
    shift = rng.integers(0, 1 << 63, many, dtype=np.uint64)
    factor = rng.integers(0, 1 << 63, many, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for k in range(many):
        bits = (base ^ shift[k]) * factor[k]
        bits ^= bits >> np.uint64(32)
        bits *= factor[k]
        # The upper three 16-bit parts choose the rate, c and the offset of this shingle in this sample.
        part = bits.view(np.uint16).reshape(-1, 4)
        at = part[:, 3].astype(np.intp)
        beta = part[:, 1] * np.float32(1 / _GRID)
        t = np.floor(log_w * inverse[at] + beta)
        score = log_c[part[:, 2].astype(np.intp)] - r[at] * (t - beta + np.float32(1))
        least = np.minimum.reduceat(score, starts)
        best = np.flatnonzero(score == np.repeat(least, size))
        # The first of equal ones; their order is that of the hashes, the same in every text.
        first = best[np.searchsorted(best, starts)]
        code = mix(h[first] + mix(t[first].astype(np.int64).view(np.uint64) + np.uint64(k)))
        out[owner, k] = (code >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    return out


_MADE: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rates, their inverses, and logarithms of the c values, once per worker."""
    if not _MADE:
        x = _gamma_quantiles()
        _MADE.append(tuple(a.astype(np.float32) for a in (x, 1 / x, np.log(x))))
    return _MADE[0]


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two sorted shingle sets with weights: sum of the smaller weights over that of the larger."""
    at = np.minimum(np.searchsorted(b[0], a[0]), max(len(b[0]) - 1, 0))
    both = b[0][at] == a[0] if len(b[0]) else np.zeros(len(a[0]), bool)
    low = np.minimum(a[1][both], b[1][at[both]]).sum()
    high = a[1].sum() + b[1].sum() - low
    return float(low / high) if high > 0 else 0.0


def sketched(docs: DataFrame, model: Weights, text: str, key: str, shingle: int, many: int) -> DataFrame:
    """Per row: id, s1 and s2 (hashes of its words in order, 0 without words), sample (32-bit codes)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables()
        for big in slices(batches, "text"):
            # Small steps keep the arrays of one in the processor's cache.
            step = max(1, min(big.num_rows, (big.num_rows << 20) // max(big.nbytes, 1)))
            for start in range(0, big.num_rows, step):
                batch = big.slice(start, step)
                found = words(batch.column("text").to_pylist())
                text_of, h, count = shingles(found, shingle)
                codes = samples(text_of, h, sent.value.of(h, count), batch.num_rows, many, tables)
                s1, s2 = sequence_hashes(found)
                yield pa.record_batch(
                    [batch.column("id"), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)), pa.array([c.tobytes() for c in codes], pa.binary())],
                    names=["id", "s1", "s2", "sample"],
                )

    return kept.mapInArrow(run, "id long, s1 long, s2 long, sample binary")


def _buckets(classes: DataFrame, bands: int, rows: int) -> DataFrame:
    """rep, band and bucket, for every band."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.frombuffer(b"".join(batch.column("sample").to_pylist()), dtype="<u4").reshape(-1, bands, rows).astype(np.uint64)
            keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), codes.shape[:2])
            for k in range(rows):
                keys = mix(keys * np.uint64(31) + codes[:, :, k])
            band = np.tile(np.arange(bands), batch.num_rows)
            yield pa.record_batch([pa.array(np.repeat(batch.column("rep").to_numpy(), bands)), pa.array(band), pa.array(keys.reshape(-1).view(np.int64))], names=["rep", "band", "bucket"])

    return classes.select("rep", "sample").mapInArrow(run, "rep long, band long, bucket long")


def _agreement(pairs: DataFrame, codes: DataFrame) -> DataFrame:
    """Adds ``agree``: the share of samples that both classes of a pair (a, b) have in common."""
    with_both = pairs.join(codes.select(F.col("rep").alias("a"), F.col("sample").alias("sa")), "a").join(
        codes.select(F.col("rep").alias("b"), F.col("sample").alias("sb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sa, sb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype="<u4").reshape(batch.num_rows, -1) for c in ("sa", "sb"))
            yield pa.record_batch([batch.column("a"), batch.column("b"), pa.array((sa == sb).mean(axis=1) if batch.num_rows else np.zeros(0))], names=["a", "b", "agree"])

    return with_both.mapInArrow(run, "a long, b long, agree double")


def verified(pairs: DataFrame, texts: DataFrame, model: Weights, shingle: int, threshold: float) -> DataFrame:
    """Those of the distinct pairs (a, b) whose weighted Jaccard similarity reaches the threshold.

    ``texts``: rep, text. A task reads a centre ``b`` and then the texts compared with it, one at a time; the
    members of a frequent centre are dealt to several tasks, each with the centre's text.
    """
    sent = pairs.sparkSession.sparkContext.broadcast(model)
    pairs = stored(pairs)
    parts = pairs.groupBy("b").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("parts"))
    members = (
        pairs.join(parts, "b").withColumn("part", F.pmod(F.xxhash64("a", F.lit(5)), F.col("parts")).cast("int"))
        .join(texts, pairs["a"] == texts["rep"]).select(F.col("b").alias("centre"), "part", F.lit(1).alias("kind"), F.col("a").alias("member"), "text")
    )
    centres = (
        parts.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).join(texts, parts["b"] == texts["rep"])
        .select(F.col("b").alias("centre"), "part", F.lit(0).alias("kind"), F.col("b").alias("member"), "text")
    )
    together = grouped(members.union(centres), ["centre", "part"], ("kind",))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, centre, here = sent.value, None, None
        for batch in slices(batches, "text"):
            found = words(batch.column("text").to_pylist())
            text_of, h, count = shingles(found, shingle)
            w = known.of(h, count)
            ends = np.searchsorted(text_of, np.arange(batch.num_rows + 1))
            out: tuple[list, list] = ([], [])
            for i, (c, part, kind, member) in enumerate(zip(*(batch.column(n).to_pylist() for n in ("centre", "part", "kind", "member")), strict=True)):
                own = h[ends[i]:ends[i + 1]], w[ends[i]:ends[i + 1]]
                if kind == 0:
                    centre, here = (c, part), own
                elif centre == (c, part) and weighted_jaccard(here, own) >= threshold:
                    out[0].append(member)
                    out[1].append(c)
            yield pa.record_batch([pa.array(o, pa.int64()) for o in out], names=["a", "b"])

    return together.mapInArrow(compare, "a long, b long")


def _near_in_blocks(batch: pa.RecordBatch, starts: list[int], bands: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """For every row of a block group the later rows that it has to be compared with: start of the group, row, rows.

    Those of another component (and, in a pair of blocks, of the other block), whose samples agree enough, and
    whose first shared band is this group's, so that a pair that shares several is compared once.
    """
    comp, side, lo, hi, band = (batch.column(c).to_numpy() for c in ("comp", "side", "lo", "hi", "band"))
    raw = batch.column("sample").to_pylist()
    for a, b in zip(starts, starts[1:], strict=False):
        if b - a < 2:
            continue
        code = np.frombuffer(b"".join(raw[a:b]), dtype="<u4").reshape(b - a, -1)
        for i in range(b - a - 1):
            later = np.arange(i + 1, b - a)
            later = later[comp[a + i + 1:b] != comp[a + i]]
            if lo[a] != hi[a]:
                later = later[side[a + later] != side[a + i]]
            if not len(later):
                continue
            same = code[later] == code[i]
            near = same.mean(axis=1) >= LEAST_AGREEMENT
            near &= same.reshape(len(later), bands, -1).all(axis=2).argmax(axis=1) == band[a]
            if near.any():
                yield a, i, later[near]


def _across(members: DataFrame, codes: DataFrame, texts: DataFrame, model: Weights, shingle: int, threshold: float, bands: int) -> DataFrame:
    """Links (a, b) between classes that share a bucket but no component, compared in blocks inside the tasks.

    ``members``: rep, bucket, band, comp, n (size of the bucket).
    """
    keys = ["bucket", "lo", "hi"]
    rows = block_pairs(members.join(codes, "rep"), F.col("n"), "rep", BLOCK).drop("n")

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, starts in runs(batches, keys):
            some = np.zeros(batch.num_rows, dtype=bool)
            for a, i, later in _near_in_blocks(batch, starts, bands):
                some[a + i] = some[a + later] = True
            yield batch.filter(pa.array(some))

    kept = grouped(rows, keys)
    wanted = stored(kept.mapInArrow(needed, kept.schema))
    sent = members.sparkSession.sparkContext.broadcast(model)
    with_text = grouped(wanted.join(texts, "rep"), keys)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch, starts in runs(batches, keys):
            rep, body = batch.column("rep").to_numpy(), batch.column("text")
            sets: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            group = -1

            def of(row: int) -> tuple[np.ndarray, np.ndarray]:
                if row not in sets:
                    _, h, count = shingles(words([body[row].as_py()]), shingle)
                    sets[row] = h, known.of(h, count)
                return sets[row]

            out: tuple[list, list] = ([], [])
            for a, i, later in _near_in_blocks(batch, starts, bands):
                if a != group:
                    group, sets = a, {}
                for j in later.tolist():
                    if weighted_jaccard(of(a + i), of(a + j)) >= threshold:
                        out[0].append(int(rep[a + i]))
                        out[1].append(int(rep[a + j]))
            yield pa.record_batch([pa.array(o, pa.int64()) for o in out], names=["a", "b"])

    return with_text.mapInArrow(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """One row per document: key, component_id (smallest key of its group), kept (whether it is that one)."""
    model = weights(docs, text, shingle)
    sketches = stored(sketched(docs, model, text, key, shingle, bands * rows))
    some = sketches.where("s1 <> 0 and id is not null")
    classes = some.groupBy("s1", "s2").agg(F.min("id").alias("rep"))
    codes = stored(some.join(classes.select(F.col("rep").alias("id"), "s1", "s2"), ["id", "s1", "s2"]).dropDuplicates(["id"]).select(F.col("id").alias("rep"), "s1", "sample"))
    at = _buckets(codes, bands, rows)
    at = stored(at)
    shared = at.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(at.join(shared, "bucket"))
    partners = members.select("rep").distinct().join(codes, "rep")
    texts = stored(
        docs.select(F.col(key).cast("long").alias("rep"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .join(partners.select("rep"), "rep", "leftsemi").dropDuplicates(["rep"])
    )
    partner_codes = stored(partners.select("rep", "sample"))
    # The class that shares most buckets with others leads each of its buckets; another leads by chance.
    shares = members.groupBy("rep").agg(F.sum("n").alias("shares"))
    rank = F.xxhash64("rep", "bucket")
    centres = members.join(shares, "rep").groupBy("bucket").agg(F.max_by("rep", F.struct("shares", "rep")).alias("c1"), F.min_by("rep", rank).alias("c2"))
    tried = members.join(centres, "bucket").select(F.col("rep").alias("a"), F.explode(F.array_distinct(F.array("c1", "c2"))).alias("b")).where("a <> b").distinct()
    near = _agreement(tried, partner_codes).where(F.col("agree") >= LEAST_AGREEMENT)
    # Each class is compared with the centre that its samples are nearest to.
    links = stored(verified(near.groupBy("a").agg(F.max_by("b", F.struct("agree", "b")).alias("b")), texts, model, shingle, threshold))
    comp = components(links)
    now = members.join(comp, members["rep"] == comp["node"], "left").select("rep", "bucket", "band", "n", F.coalesce("component", "rep").alias("comp"))
    # Buckets that lie within one component have nothing left to compare.
    open_ = now.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("bucket")
    more = stored(_across(now.join(open_, "bucket"), partner_codes, texts, model, shingle, threshold, bands))
    comp = components(links.union(more))
    by_rep = classes.join(comp, classes["rep"] == comp["node"], "left").select("s1", "s2", F.coalesce("component", "rep").alias("component"))
    out = sketches.select("id", "s1", "s2").join(by_rep, ["s1", "s2"], "left")
    return out.select(
        F.col("id").alias(key), F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))
