"""Packing documents into token sequences of one length.

Shortest-pack-first over the length histogram: only how many pieces there are of
each length matters for a plan, so lengths are placed longest first, each into the
open pack with the most room, by updating the counts of packing patterns. The work
on the driver depends on the sequence length alone, never on the number of rows.
What is still open then is closed by taking the emptiest patterns apart and cutting
their pieces to fill the gaps of the others; the rest of that ends in sequences
whose lengths are powers of two. So no sequence needs padding.

Pieces find their place by rank: the k-th piece of a length belongs to the pattern
whose range of ranks holds k. Ranks are counted per stored partition and offset by
the counts before it, so no length is ever ordered in one task.

Defined results: a null text is taken as empty, which gives one piece of the closing
id alone; repeated rows are packed as often as they occur; an empty table gives none.
"""

from __future__ import annotations

import json
import os
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evolve.llm.common import byte_of_char, slices, tokenizer, vocabulary
from evolve.llm.wordpieces import PieceCache, latin_words, pieces
from evolve.storage import stored

VOCABULARY = "word_bpe_49k.json"
LENGTH = 2048
CLOSING = 1


@dataclass
class Plan:
    """Where the pieces go. Every array is sorted; sizes depend on the sequence length only.

    ``runs`` has a row for each length and range of ranks: length, first rank, pieces
    per sequence, first offset, first sequence, and for taken-apart patterns the start
    of the first piece in the stream of cut pieces and its step from sequence to
    sequence (else -1, 0). ``gaps`` has a row for each group of equal gaps: start in
    that stream, gap size, first sequence, offset.
    """

    runs: np.ndarray
    gaps: np.ndarray


def plan(histogram: dict[int, int], length: int) -> Plan:
    """Shortest-pack-first over ``histogram`` (piece length to count)."""
    # room -> groups of [packs, ((piece length, pieces), ...)]
    open_: dict[int, list[list]] = defaultdict(list)
    top = 0
    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        room = length
        while left:
            while room >= size and not open_[room]:
                room -= 1
            if room < size:
                each = length // size
                if left >= each:
                    open_[length - each * size].append([left // each, ((size, each),)])
                if left % each:
                    open_[length - left % each * size].append([1, ((size, left % each),)])
                break
            packs, parts = open_[room].pop()
            used = min(packs, left)
            if used < packs:
                open_[room].append([packs - used, parts])
            last = parts[-1]
            parts = (*parts[:-1], (size, last[1] + 1)) if last[0] == size else (*parts, (size, 1))
            open_[room - size].append([used, parts])
            left -= used
    groups = [(room, packs, parts) for room in sorted(open_, reverse=True) for packs, parts in open_[room]]

    # Take the emptiest apart until what they hold fills the gaps of the others.
    gap_sum, held = sum(room * packs for room, packs, _ in groups), 0
    whole, apart = [], []
    for room, packs, parts in groups:
        taken = min(packs, -(-(gap_sum - held) // length)) if gap_sum > held else 0
        if taken:
            apart.append((room, taken, parts))
            held += taken * (length - room)
            gap_sum -= taken * room
        if packs > taken:
            whole.append((room, packs - taken, parts))

    runs, gaps, ranks = [], [], defaultdict(int)
    sequence = stream = 0
    for room, packs, parts in whole:
        offset = 0
        for size, each in parts:
            runs.append((size, ranks[size], each, offset, sequence, -1, 0))
            ranks[size] += packs * each
            offset += size * each
        if room:
            gaps.append((stream, room, sequence, offset))
            stream += room * packs
        sequence += packs
    # What is left beyond the gaps: whole sequences, then one for each power of two.
    rest = held - stream
    if rest >= length:
        gaps.append((stream, length, sequence, 0))
        sequence += rest // length
        stream += rest // length * length
        rest %= length
    for bit in reversed(range(rest.bit_length())):
        if rest >> bit & 1:
            gaps.append((stream, 1 << bit, sequence, 0))
            sequence += 1
            stream += 1 << bit
    at = 0
    for room, packs, parts in apart:
        inside = 0
        for size, each in parts:
            runs.append((size, ranks[size], each, 0, 0, at + inside, length - room))
            ranks[size] += packs * each
            inside += size * each
        at += packs * (length - room)
    as_rows = lambda rows, width: np.array(sorted(rows), dtype=np.int64).reshape(-1, width)
    return Plan(as_rows(runs, 7), as_rows(gaps, 4))


def place(plan: Plan, size: np.ndarray, rank: np.ndarray) -> list[list[tuple[int, int, int, int]]]:
    """For each piece its cuts: (start in the piece, length, sequence, offset)."""
    by_size: dict[int, np.ndarray] = {}
    out = []
    gap_starts = plan.gaps[:, 0]
    for n, k in zip(size.tolist(), rank.tolist(), strict=True):
        if n not in by_size:
            by_size[n] = plan.runs[plan.runs[:, 0] == n]
        runs = by_size[n]
        _, first, each, offset, sequence, stream, step = runs[np.searchsorted(runs[:, 1], k, side="right") - 1].tolist()
        copy, nth = divmod(k - first, each)
        if stream < 0:
            out.append([(0, n, sequence + copy, offset + nth * n)])
            continue
        at, done, cuts = stream + copy * step + nth * n, 0, []
        while done < n:
            start, gap, seq, off = plan.gaps[np.searchsorted(gap_starts, at + done, side="right") - 1].tolist()
            slot, inside = divmod(at + done - start, gap)
            cut = min(n - done, gap - inside)
            cuts.append((done, cut, seq + slot, off + inside))
            done += cut
        out.append(cuts)
    return out


_CACHES: dict[str, tuple[PieceCache, int]] = {}


# Ends a word in the strings given to the coder, and stands for the vocabulary's word end.
_STOP = "\x01"


class WordEndCoder:
    """Ids of pieces for a byte-level vocabulary with word ends.

    Words are handed over closed by a stop byte. A single byte and the stop merge before
    anything else, which is how the vocabulary starts: with the word's last byte marked.
    """

    def __init__(self, name: str):
        import tiktoken

        with open(name if os.path.isabs(name) else vocabulary(name)) as f:
            spec = json.load(f)
        end, byte = spec["model"]["end_of_word_suffix"], byte_of_char()
        special = {t["content"] for t in spec["added_tokens"]}
        ranks, self.closes = {}, np.zeros(1 + max(spec["model"]["vocab"].values()), dtype=bool)
        for token, i in spec["model"]["vocab"].items():
            if token in special:
                continue
            body = token.removesuffix(end)
            ranks[bytes(byte[c] for c in body) + (_STOP.encode() if body != token else b"")] = i
            self.closes[i] = body != token
        self.coder = tiktoken.Encoding("words", pat_str=f"[^{_STOP}]+{_STOP}", mergeable_ranks=ranks, special_tokens={})
        self.library = tokenizer(name)
        self.width = 2 if len(self.closes) <= 1 << 16 else 4
        self.kind = f"<u{self.width}"

    def ids(self, batch: list[str]) -> list[bytes]:
        """For each piece its ids, little-endian and ``width`` bytes each."""
        kind, width = self.kind, self.width
        out: list[bytes] = [b""] * len(batch)
        cut = [latin_words(p) for p in batch]
        plain = [k for k, w in enumerate(cut) if w]
        for start in range(0, len(plain), 4096):
            group = plain[start:start + 4096]
            joined = "".join([w + _STOP for k in group for w in cut[k]])
            ids = np.array(self.coder.encode_ordinary(joined), dtype=kind)
            past = np.flatnonzero(self.closes[ids]) + 1
            ends = past[np.cumsum([len(cut[k]) for k in group]) - 1].tolist()
            raw, at = ids.tobytes(), 0
            for k, end in zip(group, ends, strict=True):
                out[k], at = raw[width * at:width * end], end
        rest = [k for k, w in enumerate(cut) if w is None]
        for start in range(0, len(rest), 4096):
            group = rest[start:start + 4096]
            for k, e in zip(group, self.library.encode_batch_fast([batch[k] for k in group], add_special_tokens=False), strict=True):
                out[k] = np.array(e.ids, dtype=kind).tobytes()
        return out


def _piece_ids(name: str) -> tuple[PieceCache, int]:
    """The ids of pieces, and how many bytes each id takes."""
    if name not in _CACHES:
        coder = WordEndCoder(name)
        _CACHES[name] = PieceCache(coder.ids), coder.width
    return _CACHES[name]


def token_ids(docs: DataFrame, text: str, key: str, vocab: str, closing: int, length: int) -> DataFrame:
    """Per row: key, ids (little-endian), n, bytes per id; its partition and the ranks of its pieces there."""
    kept = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (cache, width), part = _piece_ids(vocab), TaskContext.get().partitionId()
        end = closing.to_bytes(width, "little")
        ranks, row = np.zeros(length + 1, dtype=np.int64), 0
        for batch in slices(batches, "text"):
            values = cache.values([pieces(t) for t in batch.column("text").to_pylist()])
            ids = [b"".join(v) + end for v in values]
            whole_rank, rest_rank = [], []
            for i in ids:
                whole, rest = divmod(len(i) // width, length)
                whole_rank.append(int(ranks[length]))
                ranks[length] += whole
                rest_rank.append(int(ranks[rest]))
                ranks[rest] += 1
            n = batch.num_rows
            yield pa.record_batch(
                [batch.column("key"), pa.array([part << 33 | (row + k) for k in range(n)], pa.int64()), pa.array([part] * n, pa.int64()),
                 pa.array([len(i) // width for i in ids], pa.int64()), pa.array(whole_rank, pa.int64()), pa.array(rest_rank, pa.int64()),
                 pa.array(ids, pa.binary())],
                names=["key", "row", "part", "n", "whole_rank", "rest_rank", "ids"],
            )
            row += n

    kind = kept.schema["key"].dataType.simpleString()
    return kept.mapInArrow(encode, f"key {kind}, row long, part long, n long, whole_rank long, rest_rank long, ids binary")


def pack(
    docs: DataFrame, text: str = "text", key: str = "doc_id", vocab: str = VOCABULARY, closing: int = CLOSING, length: int = LENGTH,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids unless told otherwise.

    ``ids`` and their checksum are over little-endian unsigned 32-bit integers.

    The token ids are written once to the shared checkpoint folder, so that ranks and
    pieces come from the same rows even when tasks run again.
    """
    docs_ids = stored(token_ids(docs, text, key, vocab, closing, length))
    # Pieces per partition and length: at most ``length`` rows for each partition.
    per_part = (
        docs_ids.select("part", F.explode(F.array(
            F.struct(F.lit(length).cast("long").alias("size"), F.expr(f"n div {length}").alias("many")),
            F.struct(F.expr(f"n % {length}").alias("size"), F.lit(1).cast("long").alias("many")),
        )).alias("p"))
        .select("part", "p.size", "p.many").where("size > 0 and many > 0")
        .groupBy("part", "size").agg(F.sum("many").alias("many"))
    )
    per_part = stored(per_part)
    histogram = {r["size"]: r["many"] for r in per_part.groupBy("size").agg(F.sum("many").alias("many")).collect()}
    found = plan(histogram, length)
    earlier = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_part.select("part", "size", F.coalesce(F.sum("many").over(earlier), F.lit(0)).alias("base"))
    whole = bases.where(F.col("size") == length).select("part", F.col("base").alias("whole_base"))
    rest = bases.where(F.col("size") < length).select("part", F.col("size").alias("rest"), F.col("base").alias("rest_base"))
    ranked = (
        docs_ids.select("row", "part", "n", "whole_rank", "rest_rank", F.expr(f"n % {length}").alias("rest"))
        .join(whole, "part", "left").join(rest, ["part", "rest"], "left")
        .select("row", (F.col("whole_rank") + F.coalesce("whole_base", F.lit(0))).alias("whole_at"),
                (F.col("rest_rank") + F.coalesce("rest_base", F.lit(0))).alias("rest_at"))
    )
    joined = docs_ids.select("row", "key", "n", "ids").join(ranked, "row").drop("row")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ids"):
            out = defaultdict(list)
            n, whole_at, rest_at = (batch.column(c).to_numpy() for c in ("n", "whole_at", "rest_at"))
            n_whole, rest_n = n // length, n % length
            owner = np.repeat(np.arange(len(n)), n_whole + (rest_n > 0))
            nth = np.arange(len(owner)) - np.repeat(np.cumsum(n_whole + (rest_n > 0)) - (n_whole + (rest_n > 0)), n_whole + (rest_n > 0))
            is_whole = nth < n_whole[owner]
            size = np.where(is_whole, length, rest_n[owner])
            rank = np.where(is_whole, whole_at[owner] + nth, rest_at[owner])
            ids, keys = batch.column("ids").to_pylist(), batch.column("key")
            ids = [np.frombuffer(i, dtype=f"<u{len(i) // k}").astype("<u4").tobytes() for i, k in zip(ids, n.tolist(), strict=True)]
            rows = []
            for doc, first, cuts in zip(owner.tolist(), (nth * length).tolist(), place(found, size, rank), strict=True):
                for start, many, sequence, offset in cuts:
                    rows.append(doc)
                    out["start"].append(first + start)
                    out["length"].append(many)
                    out["ids"].append(ids[doc][4 * (first + start):4 * (first + start + many)])
                    out["sequence_id"].append(sequence)
                    out["offset"].append(offset)
            at = pa.array(rows, pa.int64())
            long = lambda c: pa.array(out[c], pa.int64())
            crc = pa.array([zlib.crc32(i) for i in out["ids"]], pa.int64())
            columns = [keys.take(at), long("start"), long("length"), crc, batch.column("n").take(at), long("sequence_id"), long("offset")]
            names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                columns, names = [*columns, pa.array(out["ids"], pa.binary())], [*names, "ids"]
            yield pa.record_batch(columns, names=names)

    kind = docs_ids.schema["key"].dataType.simpleString()
    schema = f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return joined.mapInArrow(cut, schema + ", ids binary" * with_ids)
