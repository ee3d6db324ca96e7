"""Token counts by dynamic programming over prefixes.

For a word-end vocabulary the tokens of a text are those of its words. Within a
word, the encoding of every prefix is found from shorter ones: exactly one token
can end it, the one that follows the encoding of what stands before it without a
merge across the two. So one pass over a word gives the exact token count of each
of its prefixes, and with the counts of the words before it the exact count of
every prefix of the text. How many tokens a cut text has, and how much of a text
fits a budget, are then look-ups.

Defined results: a null text is taken as empty and has 0 tokens; repeated rows give
repeated results; further columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evolve.llm.common import byte_of_char, slices, tokenizer, vocabulary
from evolve.llm.wordpieces import PieceCache, latin_words, pieces

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048


class PrefixBpe:
    """Prefix counts of single pieces for a byte-level vocabulary with word ends."""

    def __init__(self, name: str):
        with open(name if os.path.isabs(name) else vocabulary(name)) as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.library = tokenizer(name)
        self.stand_in = {b: c for c, b in byte_of_char().items()}
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.cut_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        # A merge makes one token; its rank decides, and single symbols have none.
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b, c = self.ids[left], self.ids[right], self.ids[left + right]
            self.rank[a, b] = rank
            self.made.setdefault(c, (rank, a, b))
        self.longest = max(len(t.removesuffix(self.end)) for t in self.ids)
        self.open = {t: i for t, i in self.ids.items() if not t.endswith(self.end) and self._stands(i)}
        self.closed = {t.removesuffix(self.end): i for t, i in self.ids.items() if t.endswith(self.end) and self._stands(i)}
        self.agree: dict[tuple[int, int], bool] = {}

    def _stands(self, token: int) -> bool:
        """Whether merging the token's own symbols gives the token back."""
        if token not in self.made:
            return True
        rank, left, right = self.made[token]
        return self._stands(left) and self._stands(right) and self._apart(left, right, rank)

    def _apart(self, left: int, right: int, before: float = float("inf")) -> bool:
        """Whether no merge of a rank below ``before`` joins the two tokens while each is built.

        Goes back through both tokens' own merges, latest first, and looks at the
        two tokens that touch at the border at each of those times.
        """
        made, rank = self.made, self.rank
        while True:
            joined = rank.get((left, right))
            if joined is not None and joined < before:
                return False
            a, b = made.get(left), made.get(right)
            if a is None and b is None:
                return True
            # Of equal ranks the left merge comes first, so the right one is undone first.
            if b is None or a is not None and a[0] > b[0]:
                before, left = a[0], a[2]
            else:
                # A border merge of the same rank as the right token's would be applied first.
                before, right = b[0] + 1, b[1]

    def counts(self, word: str, every: bool) -> list[int]:
        """Tokens of the prefixes of one word; only of the whole word unless ``every``."""
        n, agree = len(word), self.agree
        last, used = [None] * (n + 1), [0] * (n + 1)
        out = []
        for i in range(1, n + 1):
            ends = ((self.open, False),) if i < n and not every else ((self.closed, True),) if i == n else ((self.open, False), (self.closed, True))
            for tokens, closes in ends:
                for j in range(i - 1, max(0, i - self.longest) - 1, -1):
                    token = tokens.get(word[j:i])
                    if token is None:
                        continue
                    if j:
                        before = last[j]
                        if before is None:
                            continue
                        fits = agree.get((before, token))
                        if fits is None:
                            if len(agree) > 1_000_000:
                                agree.clear()
                            fits = agree[before, token] = self._apart(before, token)
                        if not fits:
                            continue
                    if closes:
                        out.append(used[j] + 1)
                    else:
                        last[i], used[i] = token, used[j] + 1
                    break
        return out

    def words(self, text: str) -> list[str]:
        """The byte-level words of a text without special tokens, as the library cuts them."""
        plain = latin_words(text)
        if plain is not None:
            return plain if text.isascii() else [w.encode().decode("latin-1").translate(self.stand_in) for w in plain]
        lib = self.library
        return [w for w, _ in lib.pre_tokenizer.pre_tokenize_str(lib.normalizer.normalize_str(text))]

    def total(self, piece: str) -> int:
        """Tokens of a text or piece, special tokens inside included."""
        if "<|" not in piece or self.cut_special is None:
            return sum(self.counts(w, False)[-1] for w in self.words(piece))
        parts = self.cut_special.split(piece)
        return sum(1 if k % 2 else self.total_plain(p) for k, p in enumerate(parts))

    def total_plain(self, part: str) -> int:
        return sum(self.counts(w, False)[-1] for w in self.words(part))

    def prefixes(self, text: str) -> list[int]:
        """Tokens of every prefix of a text, by code points from 0 to its length.

        Code points that the library's normaliser joins or splits, white space runs
        and special tokens are settled by counting the prefix of that piece anew.
        """
        out, done, start = [0], 0, 0
        for piece in re.split(r"([ \t\n\r\f\v]+)", text):
            if not piece or piece[0] in " \t\n\r\f\v":
                out += [done] * len(piece)
                continue
            plain = "<|" not in piece and piece.isascii()
            if plain:
                here: list[int] = []
                for w in self.words(piece):
                    settled = here[-1] if here else 0
                    here += [settled + c for c in self.counts(w, True)]
                # A contraction is one word only when whole, so such prefixes are counted directly.
                if "'" in piece:
                    here = [self.total(piece[:k]) for k in range(1, len(piece) + 1)]
            else:
                here = [self.total(piece[:k]) for k in range(1, len(piece) + 1)]
            out += [done + c for c in here]
            done += here[-1]
            start += len(piece)
        return out


_MADE: dict[str, PrefixBpe] = {}
_CACHES: dict[str, PieceCache] = {}


def _prefix_bpe(name: str) -> PrefixBpe:
    if name not in _MADE:
        _MADE[name] = PrefixBpe(name)
    return _MADE[name]


def _totals(name: str) -> PieceCache:
    if name not in _CACHES:
        bpe = _prefix_bpe(name)
        _CACHES[name] = PieceCache(lambda words: [bpe.total(w) for w in words])
    return _CACHES[name]


def token_counts(docs: DataFrame, text: str = "text", key: str = "doc_id", vocab: str = VOCABULARY) -> DataFrame:
    """Per row its key, n_bytes (UTF-8) and n_tokens, the count at the last prefix."""
    kept = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = _totals(vocab)
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            tokens = [sum(v) for v in totals.values([pieces(t) for t in texts])]
            size = [len(t) if t.isascii() else len(t.encode()) for t in texts]
            yield pa.record_batch([batch.column("key"), pa.array(size, pa.int64()), pa.array(tokens, pa.int64())], names=[key, "n_bytes", "n_tokens"])

    kind = kept.schema["key"].dataType.simpleString()
    return kept.mapInArrow(count, f"`{key}` {kind}, n_bytes long, n_tokens long")


def prefix_counts(docs: DataFrame, text: str = "text", key: str = "doc_id", vocab: str = VOCABULARY) -> DataFrame:
    """Per row its key and ``counts``: the exact tokens of every prefix of the text, by code points from 0."""
    kept = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _prefix_bpe(vocab)
        for batch in slices(batches, "text"):
            found = [bpe.prefixes(t) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("key"), pa.array(found, pa.list_(pa.int32()))], names=[key, "counts"])

    kind = kept.schema["key"].dataType.simpleString()
    return kept.mapInArrow(count, f"`{key}` {kind}, counts array<int>")


def within_budget(prefixes: DataFrame, budget: int) -> DataFrame:
    """Adds ``fits``: the code points of the longest prefix with at most ``budget`` tokens, from stored counts."""
    longest = F.expr(f"array_max(filter(transform(counts, (c, i) -> if(c <= {int(budget)}, i, -1)), i -> i >= 0))")
    return prefixes.withColumn("fits", longest.cast("long"))


def over_limit(counts: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Adds ``over_limit``: more than ``limit`` tokens."""
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
