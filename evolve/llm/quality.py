"""Text quality by compression with two dictionaries.

One zstandard dictionary is built from texts labelled good and one from texts labelled
bad. A text is cut into pieces of ``PIECE`` bytes, so that a long text cannot become its
own dictionary, and every piece is compressed with both. The text resembles the class
whose dictionary makes it smaller: the evidence is the difference of the two compressed
sizes, divided by their sum. A second measure is the logarithm of the smaller one over
the plain size, which tells apart what both dictionaries know nothing of but which
repeats itself. A logistic curve over both, fitted on labelled texts that the dictionaries
have not seen, makes them a score from 0 to 1.

Scores depend on the bytes of the text alone. Labels are learned from at most about
``SAMPLE`` labelled documents, chosen by a hash of the id; a hash of the text deals them
to dictionaries and curve, so equal texts are on one side. A dictionary is trained on at
most ``PIECES`` distinct pieces, those with the smallest hashes, 8 MB; the counts for the
curve come in a grid of at most ``2 * 400 * 120`` cells. That is all the driver sees.

Defined results: a null or empty text has no pieces and gets what the curve says of no
evidence; several label rows of one document count as good only if all are; labels other
than 0 and 1 do not count; without both kinds of label every score is the share of good
ones (0.5 without any); a class with too few pieces for training lends its pieces
themselves as dictionary; equal texts get equal scores, in repeated rows too; further
columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evolve.llm.common import slices
from evolve.llm.toxicity import held_out

SAMPLE = 50_000
PIECES = 16_384
PIECE = 512
DICTIONARY = 128 << 10
LEVEL = 3
# Cells of the curve's grid: difference in steps of 1/400 within +-0.5, logarithm in steps of 0.05 from -5 to 1.
GRID = ((-0.5, 0.0025, 400), (-5.0, 0.05, 120))


@dataclass
class Model:
    """The dictionaries' bytes by label (0 and 1), whether they were trained, and the curve: difference, logarithm, bias."""

    dictionaries: tuple[bytes, bytes]
    trained: tuple[bool, bool]
    curve: tuple[float, float, float]

    def coders(self) -> list[zstandard.ZstdCompressor]:
        """A compressor for each label, with nothing but the data in its frames."""
        out = []
        for raw, trained in zip(self.dictionaries, self.trained, strict=True):
            known = None
            if raw:
                known = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)
                known.precompute_compress(level=LEVEL)
            out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=False, write_content_size=False, write_dict_id=False))
        return out


def pieces(text: bytes) -> list[memoryview]:
    whole = memoryview(text)
    return [whole[i:i + PIECE] for i in range(0, len(text), PIECE)]


def sizes(text: bytes, coders: list[zstandard.ZstdCompressor]) -> tuple[int, int]:
    """Compressed bytes with the dictionary of bad texts and with that of good ones."""
    cut = pieces(text)
    bad, good = (sum(len(c.compress(p)) for p in cut) for c in coders)
    return bad, good


def evidence(plain: int, bad: int, good: int) -> tuple[float, float]:
    """The normalised difference, positive for good texts, and the logarithm of how far the text shrinks."""
    return (bad - good) / max(bad + good, 1), math.log((min(bad, good) + 8) / (plain + 8))


def labelled(docs: DataFrame, labels: DataFrame, key: str, text: str, sample: int, learn_from: Callable[[Column], Column]) -> DataFrame:
    """At most about ``sample`` labelled documents: text (bytes), quality. ``learn_from``: a condition on the key."""
    marked = labels.where(F.col(key).isNotNull() & F.col("quality").isin(0, 1)).groupBy(F.col(key).alias("key")).agg(F.min("quality").cast("int").alias("quality"))
    marked = marked.where(learn_from(F.col("key")))
    share = min(1.0, sample / max(marked.count(), 1))
    marked = marked.where(F.pmod(F.xxhash64("key", F.lit(11)), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    # About ``sample`` keys and labels, 1 MB for the default.
    return docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text")).join(F.broadcast(marked), "key").select("text", "quality")


def train(found: list[bytes]) -> tuple[bytes, bool]:
    """A dictionary of the pieces, and whether it was trained; of few pieces, their own bytes."""
    try:
        return zstandard.train_dictionary(min(DICTIONARY, max(256, sum(map(len, found)) // 4)), found, level=LEVEL).as_bytes(), True
    except zstandard.ZstdError:
        return b"".join(found)[-DICTIONARY:], False


def fit(rows: DataFrame) -> Model:
    """Dictionaries and curve from rows of text (bytes) and quality (0 or 1)."""
    dealt = rows.withColumn("half", F.pmod(F.xxhash64("text", F.lit(5)), F.lit(2)))
    shares = {r["quality"]: r["n"] for r in rows.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    total = sum(shares.values())
    if len(shares) < 2:
        share = shares.get(1, 0) / total if total else 0.5
        share = min(max(share, 1e-3), 1 - 1e-3)
        return Model((b"", b""), (False, False), (0.0, 0.0, math.log(share / (1 - share))))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [(q, p.tobytes()) for t, q in zip(batch.column("text").to_pylist(), batch.column("quality").to_pylist(), strict=True) for p in pieces(t)]
            yield pa.record_batch([pa.array([q for q, _ in found], pa.int32()), pa.array([p for _, p in found], pa.binary())], names=["quality", "piece"])

    cuts = dealt.where("half = 0").select("text", "quality").mapInArrow(cut, "quality int, piece binary")
    trained = []
    for label in (0, 1):
        chosen = cuts.where(F.col("quality") == label).select(F.xxhash64("piece").alias("h"), "piece").dropDuplicates(["h"]).orderBy("h").limit(PIECES)
        trained.append(train(chosen.toArrow().column("piece").to_pylist()))
    model = Model(tuple(t[0] for t in trained), tuple(t[1] for t in trained), (0.0, 0.0, 0.0))
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = sent.value.coders()
        for batch in slices(batches, "text"):
            at = [evidence(len(t), *sizes(t, coders)) for t in batch.column("text").to_pylist()]
            cells = [pa.array([min(max(int((e[k] - low) / step), 0), many - 1) for e in at], pa.int64()) for k, (low, step, many) in enumerate(GRID)]
            yield pa.record_batch([batch.column("quality"), *cells], names=["quality", "d", "s"])

    grid = dealt.where("half = 1").select("text", "quality").mapInArrow(measure, "quality int, d long, s long")
    cells = grid.groupBy("quality", "d", "s").agg(F.count("*").alias("n")).toArrow()
    quality, d, s, n = (cells.column(c).to_numpy() for c in ("quality", "d", "s", "n"))
    (low_d, step_d, _), (low_s, step_s, _) = GRID
    model.curve = curve(np.stack([low_d + (d + 0.5) * step_d, low_s + (s + 0.5) * step_s, np.ones(len(d))], axis=1), quality, n)
    return model


def curve(design: np.ndarray, hits: np.ndarray, many: np.ndarray) -> tuple[float, float, float]:
    """Weights of a logistic curve over counted cells by Newton's method, with a weak pull to zero that keeps them finite."""
    w, pull = np.zeros(3), np.array([1e-4, 1e-2, 1e-2])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (many * (hits - p)) - pull * w
        hessian = (design * (many * p * (1 - p))[:, None]).T @ design + np.diag(pull)
        step = np.clip(np.linalg.solve(hessian, gradient), -10, 10)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1]), float(w[2])


def score(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, score (0 to 1, higher is better), n_bytes, bad_bytes and good_bytes (compressed with each dictionary)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders, (a, b, bias) = sent.value.coders(), sent.value.curve
        for batch in slices(batches, "text"):
            plain, bad, good, out = [], [], [], []
            for t in batch.column("text").to_pylist():
                size = sizes(t, coders)
                d, s = evidence(len(t), *size)
                plain.append(len(t))
                bad.append(size[0])
                good.append(size[1])
                out.append(1 / (1 + math.exp(-max(min(a * d + b * s + bias, 30.0), -30.0))))
            yield pa.record_batch([batch.column("key"), pa.array(out, pa.float64()), *(pa.array(c, pa.int64()) for c in (plain, bad, good))], names=[key, "score", "n_bytes", "bad_bytes", "good_bytes"])

    kind = kept.schema["key"].dataType.simpleString()
    return kept.mapInArrow(run, f"`{key}` {kind}, score double, n_bytes long, bad_bytes long, good_bytes long")


def fit_on(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", sample: int = SAMPLE) -> Model:
    """The model of all rows that are not held out."""
    return fit(labelled(docs, labels, key, text, sample, lambda k: ~held_out(k)))
