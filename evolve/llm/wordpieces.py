"""Texts cut at white space, for vocabularies whose tokens never span it.

With a word-end vocabulary every token lies within one piece between two runs of
white space, so the tokens of a text are the tokens of its pieces in order. Pieces
repeat far more often than texts, so their results are kept in a bounded cache.
"""

from __future__ import annotations

import re
from collections.abc import Callable

# Python's split() also cuts at these four; the vocabulary's white space does not hold them.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_SPACES = re.compile(r"[ \t\n\r\f\v]+")

# About 200 bytes each; a worker of the packing takes 0.2 GB with all of them, and two run beside a heap.
CACHE_ENTRIES = 450_000
LONGEST_KEPT = 48

# Printable ASCII, line ends and Latin letters, which the vocabulary's normaliser only makes lower case.
_LATIN_TEXT = re.compile("[ -~\n\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]*")


def pieces(text: str) -> list[str]:
    """The pieces of a text between white space; lower case when that cannot change its tokens."""
    if "<|" not in text and (text.isascii() or _LATIN_TEXT.fullmatch(text)):
        text = text.lower()
    if _SEPARATORS.search(text):
        return [p for p in _SPACES.split(text) if p]
    return text.split()

# Printable ASCII and Latin letters, which the vocabulary's normaliser only makes lower case.
_LATIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]*")
# Fixed value: the vocabulary's own word pattern, for such text in lower case.
_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+|[0-9]|[!-/:-`{-~]+")


def latin_words(piece: str) -> list[str] | None:
    """The vocabulary's words in a piece of Latin text; None where the library has to cut it."""
    if "<|" in piece or not _LATIN.fullmatch(piece):
        return None
    return _WORDS.findall(piece.lower())


class PieceCache:
    """piece -> value, computed in groups for those not yet known.

    Holds two generations of at most CACHE_ENTRIES / 2 each; when the younger is full it
    becomes the older one, so pieces in use stay.
    """

    def __init__(self, compute: Callable[[list[str]], list]):
        self.compute, self.young, self.old = compute, {}, {}

    def values(self, cut: list[list[str]]) -> list[list]:
        """For each list of pieces the list of their values."""
        young, old = self.young, self.old
        new = set().union(*cut).difference(young)
        here = {p: old[p] for p in new if p in old}
        missing = list(new.difference(here))
        if missing:
            here.update(zip(missing, self.compute(missing), strict=True))
        kept = {p: v for p, v in here.items() if len(p) <= LONGEST_KEPT}
        young.update(kept)
        if len(kept) == len(here):
            out = [list(map(young.__getitem__, words)) for words in cut]
        else:
            out = [[young[p] if p in young else here[p] for p in words] for words in cut]
        if len(young) > CACHE_ENTRIES // 2:
            self.young, self.old = {}, young
        return out
