"""Collocations: phrases of two to five words that stand together far more often than chance.

Top-order marginalisation. Every word opens one window: itself and the words that follow
it in its piece of text, up to the longest phrase, padded where the piece ends. Only these
longest windows are counted; a ROLLUP over their columns sums them to every shorter
prefix, and the count of a prefix is the count of that phrase, overlaps included. No
explosion per phrase length takes place.

Windows end early where no frequent phrase can go on. A phrase is at least as rare as any
part of it, so a first pass counts all words and pairs of neighbours, and a second one all
longer runs whose pairs are frequent, each in a table of ``CELLS`` cells chosen by a hash.
A cell's sum is never below the count of what falls in it: what is in a cell below
``LEAST`` is certainly rare. Windows are padded from the word on with which they become
rare; rare words open none. That loses no candidate and changes no count of one, whatever
the hash; full cells only leave more windows to be counted. The tasks get one bit per
cell, 2 MB a table.

Words are told apart by their bytes, never by hashes. Counts are whole numbers and scores
are divided in decimals of 38 digits, so the arithmetic is exact.

Defined results: a null text is empty and a null language is ``und``; empty texts and
texts of separators alone have no words; several rows of one document all count; a
language without candidates has no rows; ties in score go to the higher count, then to
the smaller phrase in UTF-8 byte order; further columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evolve.llm.cells import heavy_cells, is_heavy
from evolve.llm.common import slices
from evolve.llm.words import mix
from evolve.storage import stored

LONGEST = 5
LEAST = 100
TOP = 2000
# A phrase goes when a longer one that holds it is at least this many per cent as frequent.
COVER = 100
SCALE = 1000
CELLS = 1 << 24
# Texts are worked on in segments of about so many bytes.
SEGMENT = 2 << 20

# What ends a piece, and what ends a word.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
WORD_ENDS = b" \t"
BORDER = b"."
_PLAIN = bytearray(range(256))
_PLAIN[65:91] = bytes(range(97, 123))
for _b in PIECE_ENDS:
    _PLAIN[_b] = BORDER[0]
for _b in WORD_ENDS:
    _PLAIN[_b] = 32
_PLAIN = bytes(_PLAIN)


@dataclass
class _Words:
    """Words of some texts of one language: the distinct ones, their hashes, and which stands where.

    Number 0 is the border between pieces; the texts begin and end with one.
    """

    lang: str
    distinct: np.ndarray
    hashes: np.ndarray
    at: np.ndarray


def _segments(raw: bytes) -> Iterator[bytes]:
    """Pieces of text together, cut at borders only."""
    start = 0
    while len(raw) - start > SEGMENT:
        # A segment starts with the border that it was cut at, which cannot be its end too.
        end = raw.rfind(BORDER, start + 1, start + SEGMENT)
        if end < 0:
            end = raw.find(BORDER, start + SEGMENT)
        if end < 0:
            break
        yield raw[start:end]
        start = end
    yield raw[start:]


def _worded(batches: Iterable[pa.RecordBatch]) -> Iterator[_Words]:
    for batch in slices(batches, "text"):
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            for part in _segments(BORDER.join(texts).translate(_PLAIN)):
                found = pa.array([BORDER, *part.replace(BORDER, b" . ").split(), BORDER], pa.large_binary()).dictionary_encode()
                distinct = found.dictionary.to_numpy(zero_copy_only=False)
                hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct.tolist()), dtype=np.uint64, count=len(distinct))
                yield _Words(lang, distinct, hashes, found.indices.to_numpy())


def _runs(words: _Words, longest: int, tables: list[np.ndarray], cells: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Size, first words and cells of the runs of words that no table knows to be rare, from single words up.

    ``tables``: bits of frequent cells, for words and pairs, then for longer runs; a table that is not there knows nothing.
    """
    salt = np.uint64(xxhash.xxh3_64_intdigest(words.lang.encode()))
    drop = np.uint64(65 - cells.bit_length())
    at = words.at
    h = words.hashes[at]
    starts = np.flatnonzero(at)
    key = mix(h[starts] ^ salt)
    for size in range(1, longest + 1):
        if size > 1:
            # A run ends before a border.
            inside = at[starts + size - 1] > 0
            starts = starts[inside]
            key = mix(key[inside] * np.uint64(0x9E3779B97F4A7C15) + h[starts + size - 1])
        cell = (key >> drop).astype(np.int64)
        yield size, starts, cell
        which = 0 if size < 3 else 1
        if which < len(tables):
            frequent = is_heavy(tables[which], cell)
            starts, key = starts[frequent], key[frequent]


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))


def frequent_cells(texts: DataFrame, known: list[bytes], longest: int = LONGEST, least: int = LEAST, cells: int = CELLS) -> bytes:
    """A bit for each cell: whether the runs of words in it are ``least`` or more together.

    Without ``known`` tables words and pairs are counted, else longer runs whose pairs may be frequent.
    """
    low, high = (3, longest) if known else (1, min(2, longest))
    sent = texts.sparkSession.sparkContext.broadcast(known)

    def fill(batches: Iterator[pa.RecordBatch], table: np.ndarray) -> None:
        tables = [np.frombuffer(t, dtype=np.uint8) for t in sent.value]
        for words in _worded(batches):
            for size, _, cell in _runs(words, high, tables, cells):
                if size >= low:
                    np.add.at(table, cell, np.uint32(1))

    return heavy_cells(texts, fill, cells, least)


def windows(texts: DataFrame, tables: list[bytes], longest: int = LONGEST) -> DataFrame:
    """lang, w1 to w<longest> (padded with empty words), n: padded longest windows and how often they stand, by part of a task.

    Rows of padding alone carry the number of all words of the language.
    """
    sent = texts.sparkSession.sparkContext.broadcast(tables)
    names = [f"w{k + 1}" for k in range(longest)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [np.frombuffer(t, dtype=np.uint8) for t in sent.value]
        for words in _worded(batches):
            at = words.at
            lead = np.zeros((longest, len(at)), dtype=np.int64)
            for size, starts, cell in _runs(words, longest, known, 8 * len(sent.value[0])):
                kept = starts[is_heavy(known[0 if size < 3 else 1], cell)]
                lead[size - 1, kept] = at[kept + size - 1]
            distinct, n = _counted(lead[:, lead[0] > 0])
            total = np.zeros((longest, 1), dtype=np.int64)
            distinct, n = np.concatenate([distinct, total], axis=1), np.append(n, np.count_nonzero(at))
            used, place = np.unique(distinct, return_inverse=True)
            # Padding is number 0.
            pool = pa.array(["", *(w.decode("utf-8", "replace") for w in words.distinct[used[1:]].tolist())], pa.string())
            place = place.reshape(distinct.shape)
            out = [pool.take(pa.array(place[k])) for k in range(longest)]
            for low in range(0, len(n), 50_000):
                part = slice(low, low + 50_000)
                size = len(n[part])
                yield pa.record_batch([pa.array([words.lang] * size, pa.string()), *(c.slice(low, 50_000) for c in out), pa.array(n[part])], names=["lang", *names, "n"])

    return texts.mapInArrow(run, "lang string, " + ", ".join(f"{c} string" for c in names) + ", n long")


def _counted(columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct columns of a matrix and how often each is there; a hash sorts them and every column is compared with its first."""
    if not columns.shape[1]:
        return columns, np.zeros(0, dtype=np.int64)
    key = np.zeros(columns.shape[1], dtype=np.uint64)
    for row in columns:
        key = mix(key * np.uint64(31) + row.astype(np.uint64))
    _, first, place, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    if (columns == columns[:, first][:, place]).all():
        return columns[:, first], n
    return np.unique(columns, axis=1, return_counts=True)


def counts(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST, cells: int = CELLS) -> tuple[DataFrame, DataFrame]:
    """Phrases of up to ``longest`` words that stand ``least`` times or more (lang, words, phrase, f), and all words per language (lang, n)."""
    texts = _texts(docs, text, lang)
    names = [f"w{k + 1}" for k in range(longest)]
    tables = [frequent_cells(texts, [], longest, least, cells)]
    if longest > 2:
        tables.append(frequent_cells(texts, tables, longest, least, cells))
    longest_only = windows(texts, tables, longest).groupBy("lang", *names).agg(F.sum("n").alias("n"))
    # In a row of the ROLLUP the last word that is not NULL ends the phrase; where it is padding, a shorter row has the phrase.
    rolled = longest_only.rollup("lang", *names).agg(F.sum("n").alias("f")).where("lang is not null and w1 is not null")
    last = F.coalesce(*reversed(names))
    kept = stored(rolled.where(((last != "") & (F.col("f") >= least)) | ((F.col("w1") == "") & (F.lit(True) if longest == 1 else F.col("w2").isNull()))))
    words = F.filter(F.array(*names), lambda w: w.isNotNull())
    return (
        kept.where("w1 <> ''").select("lang", words.alias("words"), F.concat_ws(" ", *names).alias("phrase"), "f"),
        kept.where("w1 = ''").select("lang", F.col("f").alias("n")),
    )


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST, top: int = TOP, cover: int = COVER, cells: int = CELLS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases.

    ``score`` is floor(1000 a n / (l r)) for the cut into two parts with the lowest one.
    """
    frequent, totals = counts(docs, text, lang, longest, least, cells)
    size = F.size("words")
    candidates = frequent.where(size >= 2).withColumnRenamed("f", "a")
    joined = lambda start, length: F.array_join(F.slice("words", start, length), " ")
    cuts = candidates.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("head"), joined(F.col("k") + 1, size - F.col("k")).alias("tail"))
    heads = frequent.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = frequent.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    whole = "decimal(38,0)"
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(totals, "lang").withColumn(
        "score", F.expr(f"(cast({SCALE} * cast(a as {whole}) * n as {whole}) div cast(cast(l as {whole}) * r as {whole}))").cast("long"))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "n", "a")).alias("cut")).select("lang", "phrase", "cut.*")
    # The longest count of a phrase that holds another: at most nine parts of a phrase of five words.
    parts = candidates.where(size >= 3).select("lang", "a", "words", F.explode(F.sequence(F.lit(2), size - 1)).alias("part"))
    parts = parts.select("lang", "a", "words", "part", F.explode(F.sequence(F.lit(1), size - F.col("part") + 1)).alias("start"))
    inside = parts.select("lang", joined(F.col("start"), F.col("part")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = best.join(inside, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.expr("longer * 100bd") < F.expr(f"a * {cover}bd")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
