"""Quality scores, hard negatives and collocations against brute force, on odd and clashing rows."""

import collections
import math
import random
import re
from itertools import islice

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from evolve.llm import hard_negatives, phrases, quality
from evolve.llm.toxicity import held_out
from tests.llm.conftest import ODD

# Quality


def made(rng, good):
    words = [f"{rng.choice('bdfgklmnprst')}{rng.choice('aeiou')}{rng.choice('lmnrst')}" for _ in range(rng.randint(20, 400))]
    return " ".join(words if good else [w + rng.choice(["###", "&&&", "$$$"]) for w in words])


@pytest.fixture(scope="module")
def judged():
    rng = random.Random(4)
    rows = [(100 + i, made(rng, i % 5 != 0)) for i in range(700)]
    return rows, [(i, int((i - 100) % 5 != 0)) for i, _ in rows]


def test_quality_is_told_apart_when_held_out(spark, documents, odd, judged):
    rows, labels = judged
    docs = documents(rows).withColumns({"quality": F.lit(9), "score": F.lit("x"), "n_bytes": F.lit(None).cast("string")})
    marks = spark.createDataFrame([*labels, labels[0], (101, None), (None, 1), (9_999, 1), (102, 7)], "doc_id long, quality int")
    model = quality.fit_on(docs, marks)
    assert all(model.trained) and max(map(len, model.dictionaries)) <= quality.DICTIONARY
    both = docs.select("doc_id", "text").union(odd)
    got = quality.score(both, model).withColumn("out", held_out(F.col("doc_id"))).collect()
    assert len(got) == len(rows) + len(ODD) + 1 and all(0 <= r["score"] <= 1 for r in got)
    truth = dict(labels)
    right = [(r["score"] >= 0.3) == bool(truth[r["doc_id"]]) for r in got if r["out"] and r["doc_id"] in truth]
    assert len(right) > 80 and sum(right) >= 0.97 * len(right)
    # Against the sizes that the library itself gives, piece by piece.
    texts = dict(rows) | dict(enumerate(ODD))
    for r in got[::50] + got[-len(ODD):]:
        raw = (texts[r["doc_id"]] or "").encode()
        sizes = []
        for d in model.dictionaries:
            known = zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_checksum=False, write_content_size=False, write_dict_id=False)
            sizes.append(sum(len(known.compress(raw[i:i + 512])) for i in range(0, len(raw), 512)))
        assert (r["n_bytes"], [r["bad_bytes"], r["good_bytes"]]) == (len(raw), sizes)
        x = model.curve[0] * (sizes[0] - sizes[1]) / max(sum(sizes), 1) + model.curve[1] * math.log((min(sizes) + 8) / (len(raw) + 8)) + model.curve[2]
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-max(min(x, 30), -30))))
    assert len({r["score"] for r in got if r["doc_id"] in (0, 1)}) == 1


def test_quality_learns_nothing_from_held_out_rows(spark, documents, judged):
    rows, labels = judged
    docs = documents(rows)
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    turned = marks.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.fit_on(docs, marks) == quality.fit_on(docs, turned)


def test_quality_with_few_or_no_labels(spark, documents, odd, no_documents):
    schema = "doc_id long, quality int"
    none = spark.createDataFrame([], schema)
    assert {r["score"] for r in quality.score(odd, quality.fit_on(odd, none)).collect()} == {0.5}
    assert quality.score(no_documents, quality.fit_on(no_documents, none)).count() == 0
    ones = spark.createDataFrame([(i, 1) for i in range(20)], schema)
    assert all(r["score"] > 0.99 for r in quality.score(odd, quality.fit_on(odd, ones)).collect())
    # Too little of either kind for training: the pieces themselves are the dictionaries.
    few = documents([(i, f"{'abc' if i % 2 else 'xyz'} {i}") for i in range(24)])
    model = quality.fit_on(few, spark.createDataFrame([(i, i % 2) for i in range(24)], schema))
    assert not any(model.trained) and len(quality.score(few, model).collect()) == 24


# Collocations

WORD_ENDS, PIECE_ENDS = re.compile("[\x20\x09]+"), re.compile("[.,;:!?\x0a-\x0d]")


def brute(rows, longest, least, top, cover):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in PIECE_ENDS.split(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = [w for w in WORD_ENDS.split(piece) if w]
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    found = {p: c for p, c in f.items() if c >= least and len(p[1]) > 1}
    out = collections.defaultdict(list)
    for (lang, p), a in found.items():
        longer = [c for (other, q), c in found.items() if other == lang and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
        if any(100 * c >= cover * a for c in longer):
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, best in out.items() for i, (s, a, p, left, right) in enumerate(sorted(best)[:top])}


@pytest.mark.parametrize(("longest", "least", "top", "cover", "cells"), [(5, 4, 2000, 100, 1 << 16), (5, 3, 7, 80, 8), (3, 300, 50, 100, 64), (2, 2, 40, 100, 1 << 12)])
def test_collocations_agree_with_brute_force(spark, longest, least, top, cover, cells):
    rng = random.Random(longest)
    bits = ["Red", "red", "blue", "é", "ÉÀ", "x-y", "\U0001F600", "w1", "w2", "w3", "the quick brown fox", "the quick brown fox jumps", ",", ". ", "\t", "\n", "\x0b\x0c\r", ";", "?!", ":", "\xa0", "\x1c"]
    rows = [(rng.choice(["en", "en", "de", None, "und", "", "zh"]), rng.choice([" ", "  ", "\t"]).join(rng.choice(bits) for _ in range(rng.randint(0, 60)))) for _ in range(150)]
    rows += [("en", t) for t in [*ODD, ODD[5]]] + [("one", "a a a a a a a a"), ("none", "..."), ("long", "p q r s t u. " * 30 + "p q r s t " * 20)]
    docs = spark.createDataFrame([(lang, t, 1, "w", 5, "x") for lang, t in rows], "lang string, text string, n int, w1 string, f int, phrase string")
    got = phrases.collocations(docs, longest=longest, least=least, top=top, cover=cover, cells=cells)
    assert dict(got.dtypes) == {"lang": "string", "phrase": "string"} | dict.fromkeys(("rank", "a", "l", "r", "n", "score"), "bigint")
    want = brute(rows, longest, least, top, cover)
    assert len(want) > 1 and {tuple(r) for r in got.collect()} == want


def test_texts_are_cut_at_borders_only(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SEGMENT", 10)
    text = b"aaa bbb.cc dd ee ff gg hh ii.j.k"
    assert b"".join(phrases._segments(text)) == text
    assert all(p.startswith(b".") for p in list(phrases._segments(text))[1:])
    assert list(phrases._segments(b"x" * 50)) == [b"x" * 50]


def test_a_long_stretch_behind_a_border_is_one_segment(monkeypatch):
    monkeypatch.setattr(phrases, "SEGMENT", 10)
    stretch = b"." + b"x" * 50
    assert list(islice(phrases._segments(b"a" + stretch + b".b"), 9)) == [b"a", stretch, b".b"]
    assert list(islice(phrases._segments(stretch), 9)) == [stretch]
    assert list(islice(phrases._segments(b"." * 25), 9)) == [b"." * 9, b"." * 9, b"." * 7]


def test_colliding_windows_are_kept_apart(monkeypatch):
    rows = np.array([[1, 2, 1, 3], [5, 6, 5, 6]])
    monkeypatch.setattr(phrases, "mix", lambda h: h * np.uint64(0))
    distinct, n = phrases._counted(rows)
    assert sorted(zip(distinct.T.tolist(), n.tolist(), strict=True)) == [([1, 5], 2), ([2, 6], 1), ([3, 6], 1)]


def test_no_texts_no_phrases(spark):
    assert phrases.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
    assert phrases.collocations(spark.createDataFrame([("en", None), (None, "")], "lang string, text string"), least=1).count() == 0


# Hard negatives

SCHEMA = "vec_id long, embedding array<double>, label string, id long, score long, rank string"


def score_of(v, w):
    return max(min(sum(a * b for a, b in zip(v, w, strict=True)), (1 << 63) - 1), -(1 << 63))


def negatives_of(rows, is_anchor, positives, negatives):
    sound = {(i, tuple(math.floor(256 * x) for x in v), label) for i, v, label, *_ in rows
             if i is not None and label is not None and v and all(x is not None and math.isfinite(x) and math.isfinite(256 * x) for x in v)}
    out = set()
    for i, v, label in sound:
        if not is_anchor(i):
            continue
        scores = [(-score_of(v, w), j, other) for j, w, other in sound if j != i and len(w) == len(v)]
        best = sorted((s, j) for s, j, other in scores if other == label)[:positives]
        for ps, p in best:
            near = sorted((s, j) for s, j, other in scores if other != label and 80 * -ps <= 100 * -s <= 100 * -ps)[:negatives]
            out |= {(i, p, k + 1, j, -ps, -s) for k, (s, j) in enumerate(near)}
    return out


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    rows, n = [], 0
    for _ in range(14):
        centre = rng.standard_normal(12)
        for _ in range(40):
            rows.append((n, (centre + 0.4 * rng.standard_normal(12)).tolist(), rng.choice(["a", "b", "c"])))
            n += 1
    twin = rows[7][1]
    rows += [(n + k, twin, "ab"[k % 2]) for k in range(30)]
    rows += [rows[0], rows[0], rows[3], (1000, None, "a"), (1001, [], "a"), (1002, [math.nan] * 12, "a"), (1003, [None] * 12, "a"), (1004, [math.inf] * 12, "b"), (1005, [0.0] * 12, "a"),
             (None, twin, "a"), (1006, twin, None), (1008, [1.0, 2.0], "a"), (1010, [1.0, 2.1], "a"), (1012, [1.0, 1.9], "b"), (1014, [3.0], "q"), (1015, [1e308] * 12, "a")]
    return [(i, v, str(label) if label is not None else None, 1, 2, "x") for i, v, label in rows]


@pytest.mark.parametrize("settings", [{}, {"PER_CLUSTER": 20, "SEEDS": 30, "GROUP": 16, "STEP": 8, "block": 64}, {"PER_CLUSTER": 3, "SEEDS": 1, "GROUP": 1000, "STEP": 64, "block": 200}])
def test_hard_negatives_agree_with_brute_force(spark, vectors, monkeypatch, settings):
    block = settings.get("block", hard_negatives.BLOCK)
    for name in set(settings) - {"block"}:
        monkeypatch.setattr(hard_negatives, name, settings[name])
    got = hard_negatives.mine(spark.createDataFrame(vectors, SCHEMA).repartition(5), F.col("vec_id") % 2 == 0, block=block)
    want = negatives_of(vectors, lambda i: i % 2 == 0, 5, 5)
    assert len(want) > 2000 and {tuple(r) for r in got.collect()} == want
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_scores_beyond_doubles_are_exact(spark):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) * 10 ** rng.choice([0, 5, 9, 12]) for _ in range(4)], rng.choice("ab"), 0, 0, "") for i in range(120)]
    rows += [(200, [1e30, 1.0, 0.0, 0.0], "a", 0, 0, ""), (201, [1e30, 2.0, 0.0, 0.0], "a", 0, 0, ""), (202, [1e30, 3.0, 0.0, 0.0], "b", 0, 0, "")]
    got = hard_negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 4 == 0)
    want = negatives_of(rows, lambda i: i % 4 == 0, 5, 5)
    assert len(want) > 50 and {tuple(r) for r in got.collect()} == want


def test_walks_end_early_among_clusters():
    # One cluster's direction and a list ordered by its bounds: members stop long before its end.
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.standard_normal(24) + 0.1 * rng.standard_normal((50, 24)) for _ in range(40)])
    x = np.floor(256 * x / np.sqrt((x * x).sum(axis=1))[:, None])
    norm = np.sqrt((x * x).sum(axis=1))
    towards = hard_negatives.directions(x[::5], 40)
    angle = hard_negatives._angles(x, norm, towards)
    member = np.flatnonzero(angle.argmin(axis=1) == angle[0].argmin())
    bound = norm * np.cos(np.clip(angle[:, angle[0].argmin()] - angle[member, angle[0].argmin()].max() - 1e-6, 0, np.pi))
    exact = hard_negatives.products(x[member], x)
    assert (exact <= norm[member][:, None] * bound[None, :] + 1e-6).all()
    fifth = np.sort(exact, axis=1)[:, -5]
    assert ((norm[member][:, None] * bound[None, :] >= fifth[:, None]).mean(axis=1) < 0.2).all()


def test_no_vectors_no_negatives(spark):
    assert hard_negatives.mine(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 2 == 0).count() == 0
    assert hard_negatives.mine(spark.createDataFrame([(1, [1.0], "a", 0, 0, "")], SCHEMA), F.col("vec_id") % 2 == 0).count() == 0
