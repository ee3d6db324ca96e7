import hashlib
import random
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from evolve.llm import bpe, packing, token_counts
from evolve.llm.common import tokenizer
from evolve.llm.wordpieces import PieceCache, pieces
from evolve.session import tune
from tests.llm.conftest import ODD

ALPHABET = st.text(alphabet=st.sampled_from("ab'tsrelvd12 .,!|<>éÀß×Σİ中 \n\t\x01\x1c\x85́\U0001F600"), max_size=60)


def ids_of(name, text):
    return tokenizer(name).encode(text or "", add_special_tokens=False).ids


def test_counts_agree_with_the_library(odd):
    got = {r["doc_id"]: r for r in token_counts.over_limit(token_counts.token_counts(odd)).collect()}
    for i, t in enumerate(ODD):
        assert got[i]["n_tokens"] == len(ids_of(token_counts.VOCABULARY, t))
        assert got[i]["n_bytes"] == len((t or "").encode())
        assert got[i]["over_limit"] == (got[i]["n_tokens"] > 2048)


def test_empty_tables(no_documents):
    assert token_counts.token_counts(no_documents).count() == 0
    assert bpe.decode(bpe.encode(no_documents)).count() == 0
    assert packing.pack(no_documents).count() == 0


@settings(max_examples=300, deadline=None)
@given(ALPHABET)
def test_every_prefix_count_is_exact(text):
    name = token_counts.VOCABULARY
    assert token_counts._prefix_bpe(name).prefixes(text) == [len(ids_of(name, text[:k])) for k in range(len(text) + 1)]


def test_budget_takes_the_longest_prefix(documents):
    text = "the worthless ofthwhndwh don't stop 123"
    row = token_counts.within_budget(token_counts.prefix_counts(documents([(1, text)])), 5).first()
    fits = [k for k in range(len(text) + 1) if len(ids_of(token_counts.VOCABULARY, text[:k])) <= 5]
    assert row["fits"] == max(fits)


@settings(max_examples=300, deadline=None)
@given(ALPHABET)
def test_piece_ids_agree_with_the_library(text):
    cache, width = packing._piece_ids(packing.VOCABULARY)
    assert np.frombuffer(b"".join(cache.values([pieces(text)])[0]), f"<u{width}").tolist() == ids_of(packing.VOCABULARY, text)


def test_a_full_cache_of_pieces_is_bounded_and_right():
    cache, often = PieceCache(lambda some: [p.encode() for p in some]), [f"often{i}" for i in range(100)]
    most = 0
    for start in range(0, 1_500_000, 5000):
        cut = [often, [f"piece{i}" for i in range(start, start + 5000)], ["x" * 60, f"piece{start}"], []]
        assert cache.values(cut) == [[p.encode() for p in one] for one in cut]
        held = [cache.young, cache.old]
        if start % 100_000 == 0:
            most = max(most, sum(sys.getsizeof(d) + sum(sys.getsizeof(p) + sys.getsizeof(v) for p, v in d.items()) for d in held))
        assert all(p in cache.young for p in often) or not cache.young
        assert "x" * 60 not in cache.young
    assert most < 90_000_000


def test_python_steps_get_batches_of_bounded_size(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes]), pa.array([batch.num_rows])], names=["n", "rows"])

    long = tune(spark).range(0, 5000, 1, 1).selectExpr("repeat('x', 4000) as text")
    got = long.mapInArrow(sizes, "n long, rows long").collect()
    assert sum(r["rows"] for r in got) == 5000 and max(r["n"] for r in got) < 5 << 20


@settings(max_examples=300, deadline=None)
@given(ALPHABET)
def test_byte_ids_agree_whatever_the_chunks(text):
    name, coder = bpe.VOCABULARY, bpe.byte_bpe(bpe.VOCABULARY)
    want = ids_of(name, text)
    rng = random.Random(text)
    cuts = sorted({*rng.sample(range(len(text) + 1), min(len(text), 8)), len(text)})
    got = coder.encode(text, cuts)
    assert np.frombuffer(got, "<u4").tolist() == want
    assert coder.decode(got).decode() == tokenizer(name).decode(want, skip_special_tokens=False)


def test_byte_digests(odd):
    got = {r["doc_id"]: r for r in bpe.digests(bpe.decode(bpe.encode(odd))).collect()}
    for i, t in enumerate(ODD):
        ids = ids_of(bpe.VOCABULARY, t)
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


@pytest.mark.parametrize("text", [" " * 2_000_000, "\n" * 2_000_000, "a" + "\t" * 1_000_000 + "b", "x" + " " * 1_000_000 + "<|endoftext|> y", "中文字" * 200_000], ids=range(5))
def test_endless_runs_are_encoded(text):
    got = bpe.byte_bpe(bpe.VOCABULARY).encode(text, bpe.chunk_ends([text])[0])
    assert np.frombuffer(got, dtype="<u4").tolist() == ids_of(bpe.VOCABULARY, text)


def test_long_blanks_agree_with_the_library(monkeypatch):
    monkeypatch.setattr(bpe, "BLANK_RUN", 5)
    rng, coder = random.Random(1), bpe.byte_bpe(bpe.VOCABULARY)
    bits = ["a", "Bc", " ", "  ", " " * 6, "\n", "\n" * 7, "\t" * 6, "\u3000" * 7, "\x1c" * 6, "<|endoftext|>", "'s", "1", "\x85" * 6, "é", " " * 9 + "\n"]
    for _ in range(1500):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 9)))
        got = coder.encode(text, bpe.chunk_ends([text])[0])
        assert np.frombuffer(got, dtype="<u4").tolist() == ids_of(bpe.VOCABULARY, text)
        coder.young.clear(), coder.old.clear()


def test_chunks_follow_content():
    rng = random.Random(4)
    shared = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(600))
    (a, b) = bpe.chunk_ends(["x" * 333 + shared, "yy " + shared])
    assert len({e - 333 for e in a} & {e - 3 for e in b}) > 0.7 * len(b)


def test_pieces_hold_every_id_once_and_fill_every_sequence(odd):
    rows = packing.pack(odd).collect()
    want = {i: [*ids_of(packing.VOCABULARY, t), 1] for i, t in enumerate(ODD)}
    covered, sequences = Counter(), {}
    for r in rows:
        ids = want[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(ids) == r["length"] and r["doc_tokens"] == len(want[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        covered.update((r["doc_id"], k) for k in range(r["start"], r["start"] + r["length"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    times = Counter(i for i, _ in enumerate(ODD))
    times[5] = 2
    assert covered == Counter({(i, k): times[i] for i, ids in want.items() for k in range(len(ids))})
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 2048 or at & (at - 1) == 0


@pytest.mark.parametrize("seed", range(30))
def test_plans_place_every_piece_without_padding(seed):
    rng = random.Random(seed)
    length = rng.choice([8, 16, 64])
    histogram = {n: rng.randint(1, 40) for n in rng.sample(range(1, length + 1), rng.randint(1, length))}
    found = packing.plan(histogram, length)
    filled = {}
    for n, many in histogram.items():
        cuts = packing.place(found, np.full(many, n), np.arange(many))
        for own in cuts:
            assert [c[0] for c in own] == [0, *np.cumsum([c[1] for c in own])[:-1].tolist()] and sum(c[1] for c in own) == n
            for _, size, sequence, offset in own:
                filled.setdefault(sequence, []).append((offset, size))
    assert sorted(filled) == list(range(len(filled)))
    for parts in filled.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at == length or at & (at - 1) == 0
    assert len(filled) <= -(-sum(n * m for n, m in histogram.items()) // length) + length.bit_length()
