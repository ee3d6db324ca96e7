"""Byte-level BPE of whole texts by content-defined chunks.

A rolling hash over the last sixteen bytes decides where a text is cut, so a passage
that many documents share is cut alike in all of them. Each distinct chunk is encoded
once by a worker and its ids are kept (bounded by bytes). A chunk's ids hold only
where no word can reach across its ends, so the joins are repaired: the text between
the last sure word border of one chunk and the first of the next is encoded anew; a
chunk without a sure border joins that stretch, until both sides agree. A space
between two characters that are no white space is such a border: no word of the
vocabulary's pattern goes across it, and none looks further back or ahead.

Defined results: a null text is taken as empty and has no ids; special tokens inside
a text become their own ids, as the library's default; repeated rows give repeated
results; an empty table gives an empty one.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evolve.llm.common import byte_of_char, slices, vocabulary

VOCABULARY = "byte_bpe_50k.json"
# Fixed value: the word pattern of byte-level vocabularies of this kind.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Fixed value: white space as the pattern means it.
_BLANK = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# The pattern's engine keeps a place for every blank of a run; longer runs are cut out before it.
BLANK_RUN = 10_000

SHORTEST, LONGEST, CUT_BITS = 96, 4096, 9
KEPT_BYTES = 32 << 20
_BORDER = re.compile(r"(?<=\S) (?=\S)")
_GEAR = np.random.default_rng(5).integers(0, 1 << 32, 256, dtype=np.uint32)


class ByteBpe:
    """Encodes short strings by the merges of a vocabulary file; ids order its merges."""

    def __init__(self, name: str):
        import tiktoken

        with open(name if os.path.isabs(name) else vocabulary(name)) as f:
            spec = json.load(f)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        byte = byte_of_char()
        ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        self.coder = tiktoken.Encoding("byte", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=self.special)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.room = KEPT_BYTES

    def ids(self, piece: str) -> bytes:
        """Ids of a piece as little-endian unsigned 32-bit integers, encoded once while kept."""
        found = self.young.get(piece)
        if found is not None:
            return found
        found = self.old.get(piece)
        if found is None:
            if _long_blanks().search(piece):
                ids = self._with_long_blanks(piece)
            elif any(s in piece for s in self.special):
                ids = self.coder.encode(piece, allowed_special="all")
            else:
                ids = self.coder.encode_ordinary(piece)
            found = np.array(ids, dtype="<u4").tobytes()
        self.room -= len(found) + 2 * len(piece) + 200
        if self.room < 0:
            self.young, self.old, self.room = {}, self.young, KEPT_BYTES
        self.young[piece] = found
        return found

    def _with_long_blanks(self, piece: str) -> list[int]:
        """Ids of a piece with long runs of blanks, which the pattern takes as one word but for the last blank before other text."""
        ids: list[int] = []
        for i, part in enumerate(self.cut_special.split(piece) if self.cut_special else [piece]):
            if i % 2:
                ids.append(self.special[part])
                continue
            start = 0
            for run in _long_blanks().finditer(part):
                # The last blank goes with what follows; at the end of the text the run is one word.
                end = run.end() - (run.end() < len(part))
                ids += self.coder.encode_ordinary(part[start:run.start()])
                ids += self.coder._encode_single_piece(part[run.start():end].encode())
                start = end
            ids += self.coder.encode_ordinary(part[start:])
        return ids

    def encode(self, text: str, cuts: list[int]) -> bytes:
        """Ids of a whole text, given where its chunks end."""
        out, pending, start = [], "", 0
        for end in cuts:
            chunk = text[start:end]
            start = end
            first = _BORDER.search(chunk)
            if first is None:
                pending += chunk
                continue
            first, last = first.start(), _last_border(chunk)
            out.append(self.ids(pending + chunk[:first]))
            out.append(self.ids(chunk[first:last]))
            pending = chunk[last:]
        out.append(self.ids(pending) if pending else b"")
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return self.coder.decode_bytes(np.frombuffer(ids, dtype="<u4").tolist())


_RUNS: dict[int, re.Pattern] = {}


def _long_blanks() -> re.Pattern:
    """Runs of more than ``BLANK_RUN`` blanks, none of them next to another blank."""
    if BLANK_RUN not in _RUNS:
        _RUNS[BLANK_RUN] = re.compile(f"(?<![{_BLANK}])[{_BLANK}]{{{BLANK_RUN},}}+")
    return _RUNS[BLANK_RUN]


def _last_border(chunk: str) -> int:
    at = len(chunk)
    while True:
        at = chunk.rfind(" ", 0, at)
        if at > 0 and _BORDER.match(chunk, at):
            return at


def chunk_ends(texts: list[str]) -> list[list[int]]:
    """Where the chunks of each text end, in code points.

    A cut follows every place whose last sixteen bytes hash to zero in the leading bits, not
    before SHORTEST bytes; a stretch without such a place is cut after LONGEST bytes.
    """
    raw = [t.encode() for t in texts]
    whole = np.frombuffer(b"".join(raw), dtype=np.uint8)
    h = _GEAR[whole]
    for step in (1, 2, 4, 8):
        h[step:] += h[:-step] << np.uint32(step)
    found = np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1
    starts = (whole & 0xC0) != 0x80
    found = found[found < len(whole)]
    found = found[starts[found]]
    out, base = [], 0
    for text, data in zip(texts, raw, strict=True):
        end = base + len(data)
        inside = found[np.searchsorted(found, base):np.searchsorted(found, end)].tolist()
        cuts, last = [], base
        for place in [*inside, end]:
            while place - last > LONGEST:
                last += LONGEST
                while not starts[last]:
                    last -= 1
                cuts.append(last)
            if place - last >= SHORTEST or place == end:
                cuts.append(place)
                last = place
        if len(data) == len(text):
            out.append([c - base for c in cuts])
        else:
            count = np.cumsum(starts[base:end])
            out.append(count[np.array(cuts) - base - 1].tolist() if data else [0])
        base = end
    return out


_MADE: dict[str, ByteBpe] = {}


def byte_bpe(name: str) -> ByteBpe:
    if name not in _MADE:
        _MADE[name] = ByteBpe(name)
    return _MADE[name]


def encode(docs: DataFrame, text: str = "text", key: str = "doc_id", vocab: str = VOCABULARY) -> DataFrame:
    """Per row its key and ``ids``: little-endian unsigned 32-bit integers."""
    kept = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(vocab)
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            ids = [bpe.encode(t, cuts) for t, cuts in zip(texts, chunk_ends(texts), strict=True)]
            yield pa.record_batch([batch.column("key"), pa.array(ids, pa.binary())], names=[key, "ids"])

    kind = kept.schema["key"].dataType.simpleString()
    return kept.mapInArrow(run, f"`{key}` {kind}, ids binary")


def decode(encoded: DataFrame, key: str = "doc_id", vocab: str = VOCABULARY) -> DataFrame:
    """Per row its key, ``ids`` and ``text``, the text that the ids stand for; null ids are taken as none."""
    kept = encoded.select(F.col(key).alias("key"), F.coalesce("ids", F.lit(b"")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(vocab)
        for batch in slices(batches, "ids"):
            texts = [bpe.decode(i).decode("utf-8", "replace") for i in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("key"), batch.column("ids"), pa.array(texts, pa.string())], names=[key, "ids", "text"])

    kind = kept.schema["key"].dataType.simpleString()
    return kept.mapInArrow(run, f"`{key}` {kind}, ids binary, text string")


def digests(decoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row its key, n_tokens, and SHA-256 of the ids and of the decoded text."""
    return decoded.select(
        key, F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
