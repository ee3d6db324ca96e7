import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from evolve.llm import licenses, line_dedup, near_duplicates, pii, queries, toxicity
from evolve.llm.words import shingles, words
from tests.llm.conftest import ODD

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randint(0, vocabulary)}q" for _ in range(n))


# Words

def test_words_and_hashes():
    texts = ["Ab, cd-ÉF 12x", "", "..", "cd ab"]
    found = words(texts)
    assert [[found.word(i).decode() for i in range(found.first[d], found.first[d + 1])] for d in range(4)] == [WORD.findall(lower(t)) for t in texts]
    whole, two = found.hashes(2)
    assert whole[0] == whole[5] and whole[1] == whole[4] and len(set(whole.tolist())) == 4
    assert two[0] == whole[0] != two[1]


@pytest.mark.parametrize("seed", range(5))
def test_shingles_are_runs_of_words(seed):
    rng = random.Random(seed)
    texts = [prose(rng, rng.randint(0, 30), 3) for _ in range(20)]
    text_of, h, count = shingles(words(texts), 5)
    for d, t in enumerate(texts):
        w = t.split()
        want = collections.Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else collections.Counter()
        assert sorted(count[text_of == d].tolist()) == sorted(want.values())
    same = shingles(words([texts[0], "x " + texts[0]]), 5)
    assert set(same[1][same[0] == 0].tolist()) <= set(same[1][same[0] == 1].tolist()) or len(texts[0].split()) < 5


# Licences

PHRASES = {t.text: t.label for t in licenses.BASE}


def test_licence_places_agree_with_brute_force(spark, documents, odd):
    rng = random.Random(2)
    bits = ["GNU General", "Public License", "public", "mit", "MIT License", "apache", "License,", "CC-BY", "cc by nc", "(cc) by", "word", "GNU lesser general public license", "é", "\n"]
    rows = [(i, " ".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))) for i in range(400)]
    got = licenses.summary(licenses.scan(documents(rows).union(odd))).collect()
    texts = dict(rows) | dict(enumerate(ODD))
    by_text = collections.Counter()
    for r in got:
        candidates = [texts[r["doc_id"]]] if r["doc_id"] >= len(ODD) else [rows[r["doc_id"]][1], ODD[r["doc_id"]]]
        wants = []
        for t in candidates:
            w = WORD.findall(lower(t))
            places = [(i, label) for p, label in PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
            starts = [i for i, _ in places]
            wants.append((len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))))
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) in wants
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1
        by_text[r["labels"]] += 1
    assert any("lgpl" in x for x in by_text) and any("cc-by-nc" in x for x in by_text)


def test_places_of_all_templates_agree_with_brute_force(documents, odd):
    rng = random.Random(7)
    templates = licenses.BASE + licenses.NOTICES
    rows = []
    for i in range(500):
        parts = []
        for _ in range(rng.randint(0, 4)):
            w = rng.choice(templates).text.split()
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(["other", "license", "public", "and", "É"])
            parts.append(rng.choice([" ", ", ", "\n"]).join(w[rng.randint(0, 2):]))
        rows.append((100 + i, f" {rng.choice(['', 'x', 'the gnu'])} ".join(parts)))
    docs = documents(rows).union(odd)
    got = collections.Counter((r["doc_id"], p["label"], p["start"], round(p["coverage"], 6)) for r in licenses.scan(docs).collect() for p in r["found"])
    held, many = licenses.document_frequencies(docs, templates)
    want = collections.Counter()
    for i, t in [*rows, *enumerate(ODD), (5, ODD[5])]:
        w = WORD.findall(lower(t))
        for template in templates:
            terms, key = template.text.split(), template.key.split()
            weight = np.array([np.log((1 + many) / (1 + held[x])) + 1e-3 for x in terms])
            at = next(j for j in range(len(terms)) if terms[j:j + len(key)] == key)
            for start in range(-len(terms), len(w)):
                if start + at >= 0 and w[start + at:start + at + len(key)] == key:
                    same = [0 <= start + j < len(w) and w[start + j] == x for j, x in enumerate(terms)]
                    covered = (weight * same).sum() / weight.sum()
                    if covered >= template.least - 1e-9:
                        want[i, template.label, start, round(min(covered, 1.0), 6)] += 1
    assert got == want and len({x[1] for x in want}) == len(templates) and sum(c[3] < 1 for c in want) > 50


def test_licence_notices_survive_a_changed_word(documents):
    text = "Licensed beneath the Apache License, Version 2.0."
    assert "apache-2.0" in licenses.summary(licenses.scan(documents([(1, text), (2, "plain words")]))).where("doc_id = 1").first()["labels"]


# Toxicity

def test_segments_are_the_maximal_ones():
    rng = np.random.default_rng(5)
    for _ in range(200):
        score = rng.integers(-4, 4, rng.integers(1, 25)).astype(float)
        found = toxicity.segments(score)
        total = np.concatenate(([0], np.cumsum(score)))
        assert max((s for *_, s in found), default=0) == max(0, max(total[b] - total[a] for a in range(len(total)) for b in range(a, len(total))))
        for (_, b, _), (a, _, _) in zip(found, found[1:], strict=False):
            assert b <= a
        for a, b, s in found:
            assert s == total[b] - total[a] > 0
            assert all(total[k] > total[a] for k in range(a + 1, b + 1)) and all(total[k] < total[b] for k in range(a, b))
        inside = np.zeros(len(score), dtype=bool)
        for a, b, _ in found:
            inside[a:b] = True
        assert not (score[~inside] > 0).any()


def test_toxic_documents_are_told_apart_when_held_out(spark, documents, odd):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        text, bad = prose(rng, rng.randint(5, 300)), i % 4 == 0
        if bad:
            at = rng.randint(0, len(text))
            text = f"{text[:at]} vilex{rng.randint(0, 40)} {rng.choice(['stupido', 'trashy'])} {text[at:]}"
        rows.append((100 + i, text))
        labels.append((100 + i, int(bad)))
    docs, marks = documents(rows), spark.createDataFrame([*labels, labels[0], (101, None), (None, 1), (9_999, 1)], "doc_id long, toxic int")
    model = toxicity.fit_on(docs, marks)
    got = toxicity.score(docs.union(odd), model).withColumn("out", toxicity.held_out(F.col("doc_id"))).collect()
    truth = dict(labels)
    judged = [(r["score"] >= 0.5) == bool(truth[r["doc_id"]]) for r in got if r["out"] and r["doc_id"] in truth]
    assert len(judged) > 60 and sum(judged) >= 0.97 * len(judged)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert [r["score"] for r in got if r["doc_id"] == 0][0] < 0.5
    passage = next(r for r in got if truth.get(r["doc_id"]) and r["passages"])
    text = dict(rows)[passage["doc_id"]].split()
    assert any("vilex" in w or w in ("stupido", "trashy") for p in passage["passages"] for w in text[p["first"]:p["past"]])


def test_toxicity_without_labels(spark, odd, no_documents):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert all(r["score"] < 0.5 for r in toxicity.score(odd, toxicity.fit_on(odd, none)).collect())
    assert toxicity.score(no_documents, toxicity.fit_on(no_documents, none)).count() == 0


def test_the_model_keeps_every_feature_of_its_sample(spark):
    # More than 200,000 words and prefixes, most of them in clean documents only.
    rng = random.Random(8)
    pool = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=9)) for _ in range(64_000)]
    rows = [(" ".join(pool[k::320]), int(k % 8 == 0)) for k in range(320) for _ in range(3)]
    model = toxicity.fit(spark.createDataFrame(rows, "text string, toxic int"))
    found = words([t for t, _ in rows])
    bad = np.array([x for _, x in rows])[found.text_of()]
    sizes = []
    for level, h in enumerate(found.hashes(*toxicity.PREFIXES)):
        keys, at = np.unique(h, return_inverse=True)
        every, toxic = np.bincount(at), np.bincount(at, weights=bad)
        kept = every >= toxicity.FEWEST
        assert (model.keys[level] == keys[kept]).all()
        assert (model.toxic[level] == toxic[kept]).all() and (model.clean[level] == (every - toxic)[kept]).all()
        sizes.append(kept.sum())
    assert sum(sizes) > 200_000


# Personal data

RULES = [re.compile(p) for p in (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text):
    out = []
    for k, rule in enumerate(RULES):
        for m in rule.finditer(text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if (True, k == 1 and all(int(p) <= 255 for p in m[0].split(".")), 14 <= len(d) <= 19 and luhn(d), 10 <= len(d) <= 15)[k]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_agree_with_the_patterns(documents):
    rng = random.Random(3)
    bits = ["a", "b.", "@", "c@d.e", "4111111111111111", "4111 1111-1111 1111", " ", "-", "1.2.3.4", "300.1.1.1", "0001.02.3.4", "1.2.3.4.5", "é", "\U0001F600",
            "+1 (555) 123-4567", "+", "(", ")", "12", "\n", "x_y%z@q-r.s.t", "4.", "_d@e.f", 'token = "abcdef0123456789"', "password=abc12345xyz", "."]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))) for i in range(1500)]
    rows += [(10_000 + i, t) for i, t in enumerate([*ODD, "1 " * 60_000, "4111111111111111," * 2000, "a@" * 50_000, "+1" * 50_000, "1." * 50_000, "9" * 100_000])]
    texts = dict(rows)
    got = pii.summary(pii.detect(documents(rows))).collect()
    assert len(got) == len(rows)
    for r in got:
        spans = base_spans(texts[r["doc_id"]])
        listed = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans]
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS[:4]] == [sum(1 for _, x, _ in spans if x == k) for k in range(4)]
        everything = [s for s in r["spans"].split(",") if s]
        assert set(listed) <= set(everything)
        order = [(int(s.split(":")[1]), pii.KINDS.index(s.split(":")[0])) for s in everything]
        assert order == sorted(order)
        assert all(s in listed for s in everything if s.split(":")[0] in pii.KINDS[:4])


def test_secrets_are_added_and_redacted(documents, no_documents):
    rows = [(i, f"say AKIA{'ABCDEFGHIJ234567'[i % 4:]}XYZW now, or password={'0a1b2c3d4e5f'[i % 5:]}9z to me@site.org") for i in range(40)]
    found = pii.summary(pii.detect(documents(rows))).collect()
    assert all(r["spans"].count("secret:") == 2 and r["n_email"] == 1 for r in found)
    texts = [r["text"] for r in pii.redact(documents([*rows, (99, None), (100, "clean")])).orderBy("doc_id").collect()]
    assert texts[0] == "say <secret> now, or <secret> to <email>" and texts[-2:] == [None, "clean"]
    assert pii.detect(no_documents).count() == 0


def test_reliabilities_follow_the_better_labelers():
    rng = np.random.default_rng(8)
    truth = rng.random(4000) < 0.4
    votes = np.stack([np.where(rng.random(4000) < right, truth, ~truth) * 2 - 1 for right in (0.9, 0.8, 0.85, 0.6)], axis=1)
    patterns, of, many = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    likely = pii.reliabilities(patterns, many)[of.reshape(-1)]
    assert ((likely > 0.5) == truth).mean() > 0.92


# Near duplicates

def jaccard_groups(rows, model):
    texts = [t or "" for _, t in rows]
    text_of, h, count = shingles(words(texts), 5)
    w = model.of(h, count)
    sets = [(h[text_of == d], w[text_of == d]) for d in range(len(rows))]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i][0]) and len(sets[j][0]) and near_duplicates.weighted_jaccard(sets[i], sets[j]) >= 0.8:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(rows))]


def test_near_duplicates_agree_with_brute_force(documents):
    rng = random.Random(12)
    rows = []
    for _ in range(12):
        source = prose(rng, rng.randint(3, 120)).split()
        for _ in range(rng.randint(1, 9)):
            w = list(source)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = f"new{rng.randint(0, 99)}"
            rows.append((len(rows), " ".join(w)))
    rows += [(len(rows), rows[0][1].upper() + "!"), (len(rows) + 1, None), (len(rows) + 2, ""), (len(rows) + 3, "..."), (len(rows) + 4, "one two")]
    docs = documents([*rows, rows[3]])
    got = near_duplicates.near_duplicates(docs).collect()
    assert len(got) == len(rows) + 1
    groups = jaccard_groups(rows, near_duplicates.weights(docs))
    component = {r["doc_id"]: r["component_id"] for r in got}
    assert [component[i] for i, _ in rows] == groups
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert len(set(groups)) < len(rows) - 10


def test_frequent_shingles_are_counted_exactly(documents):
    rng = random.Random(13)
    rows = [(i, "a common passage of seven words " * (i % 3 > 0) + prose(rng, 20, 9)) for i in range(300)]
    model = near_duplicates.weights(documents(rows))
    text_of, h, _ = shingles(words([t for _, t in rows]), 5)
    want = {k: n for k, n in collections.Counter(h.tolist()).items() if n >= 2}
    assert model.known.tolist() == sorted(want)
    share = np.array([want[k] for k in sorted(want)]) / 300
    assert np.allclose(model.idf, 1 + near_duplicates.IDF * np.clip(np.log(share) / np.log(1e-3), 0, 1))


@pytest.mark.parametrize("cells", [64, 1 << 14])
def test_weights_do_not_depend_on_partitions(documents, monkeypatch, cells):
    monkeypatch.setattr(near_duplicates, "RARE", 0.02)
    monkeypatch.setattr(near_duplicates, "LEAST_CELLS", cells)
    monkeypatch.setattr(near_duplicates, "MOST_CELLS", cells)
    rng = random.Random(14)
    rows = [(i, "a common passage of seven words " * (i % 9 == 0) + prose(rng, rng.choice([0, 3, 40]), 3)) for i in range(800)]
    found = {}
    for d, h in zip(*shingles(words([t for _, t in rows]), 5)[:2], strict=True):
        found.setdefault(int(h), set()).add(int(d))
    want = {h: len(d) for h, d in sorted(found.items()) if len(d) >= 16}
    assert 5 < len(want) < len(found) / 3
    seen = []
    real = near_duplicates.heavy_cells
    monkeypatch.setattr(near_duplicates, "heavy_cells", lambda *a: seen.append(real(*a)) or seen[-1])
    for parts in (1, 4, 10, 40, 211):
        model = near_duplicates.weights(documents(rows).repartition(parts))
        assert model.known.tolist() == list(want)
        assert np.allclose(model.idf, 1 + near_duplicates.IDF * np.clip(np.log(np.array(list(want.values())) / 800) / np.log(0.02), 0, 1))
    # The same cells come out, and not many more of them than there are frequent shingles.
    assert len(set(seen)) == 1 and (cells == 64 or np.unpackbits(np.frombuffer(seen[0], dtype=np.uint8)).sum() <= 8 * len(want))


def test_samples_agree_as_often_as_the_weighted_similarity():
    rng = np.random.default_rng(0)
    h = np.sort(rng.choice(1 << 47, 300, replace=False)).astype(np.uint64)
    a = rng.uniform(0.5, 3, 300)
    b = a * rng.uniform(0.6, 1.4, 300)
    both = near_duplicates.samples(np.repeat([0, 1], 300), np.concatenate([h, h]), np.concatenate([a, b]), 2, 3000)
    assert abs((both[0] == both[1]).mean() - near_duplicates.weighted_jaccard((h, a), (h, b))) < 0.04


def test_near_duplicates_of_odd_texts(odd, no_documents):
    got = near_duplicates.near_duplicates(odd).collect()
    assert len(got) == len(ODD) + 1 and all(r["kept"] for r in got)
    assert near_duplicates.near_duplicates(no_documents).count() == 0


# Lines

def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def groups_of(places, near):
    """The number of each place's group: that of its first member."""
    parent = list(range(len(places)))

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for i in range(len(places)):
        for j in range(i):
            if find(i) != find(j) and near(places[i], places[j]):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(places))]


def near_lines(a, b):
    return a == b or (min(len(a), len(b)) >= 24 and abs(len(a) - len(b)) <= 2 and distance(a, b) <= 2)


@pytest.mark.parametrize(("hot", "block", "small", "exact"), [(256, 256, 32, None), (32, 8, 4, 3), (2, 3, 1, 1), (1, 1, 1, None)])
def test_line_decisions_agree_with_brute_force(documents, monkeypatch, hot, block, small, exact):
    for name, value in (("HOT", hot), ("BLOCK", block), ("SMALL", small), ("LOOKING", 2 * block)):
        monkeypatch.setattr(line_dedup, name, value)
    rng = random.Random(21)
    pool = ["".join(rng.choice("abé ") for _ in range(rng.randint(24, 34))).strip().ljust(24, "z") for _ in range(25)]
    ends = " \t\r\x0b\x0c\x85\xa0\u2003\u3000"

    def edited(line):
        chars = list(line)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(chars))
            chars[at:at + rng.randint(0, 1)] = rng.choice(["", "x", "y"])
        return rng.choice(ends) * rng.randint(0, 2) + "".join(chars) + rng.choice(ends) * rng.randint(0, 1)

    rows = [(i, "\n".join([edited(rng.choice(pool)) if rng.random() < 0.8 else rng.choice(["short", "ab", "} ", "\t", ""]) for _ in range(rng.randint(1, 6))])) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n")]
    docs = documents(rows)
    dropped = line_dedup.decisions(docs, exact=exact)
    got = {r["doc"]: r["dropped"] for r in dropped.collect()}
    places = [(i, p, l.strip(ends)) for i, t in rows if t is not None for p, l in enumerate(t.split("\n")) if len(l.strip(ends)) >= (exact or 24)]
    first = groups_of([l for *_, l in places], near_lines)
    want, stays = collections.defaultdict(list), collections.defaultdict(list)
    for i, (doc, p, _) in enumerate(places):
        if first[i] != i:
            want[doc].append(p)
            stays[doc].append("{}:{}".format(*places[first[i]]))
    assert got == dict(want)
    cut = {r["doc_id"]: r["text"] for r in line_dedup.apply(docs, dropped).collect()}
    for i, t in rows:
        assert cut[i] == (None if t is None else "\n".join(l for p, l in enumerate(t.split("\n")) if p not in want.get(i, ())))
    counted = {r["doc_id"]: r for r in line_dedup.report(docs, dropped).collect()}
    assert counted[100]["n_lines"] == 0 and counted[102]["n_lines"] == 3
    assert all(counted[i]["n_dropped"] == len(want.get(i, ())) and counted[i]["stays"] == ",".join(stays.get(i, ())) for i, _ in rows)


@pytest.mark.parametrize("settings", [{}, {"HOT": 16, "BLOCK": 32, "SMALL": 4, "LOOKING": 64}])
def test_families_of_lines_make_few_links(spark, documents, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(line_dedup, name, value)
    stem = "the quick brown fox jumps over the lazy dog and runs"
    letters = "abcdefghijklmnopqrstuvwxyz"
    family = [f"{stem[:20]}{letters[i % 26]}{stem[21:40]}{letters[i // 26]}{stem[41:]}" for i in range(600)]
    # A template: one segment of all of them is equal, nothing else.
    rng = random.Random(4)
    template = [f"Posted by the editors    {''.join(rng.choices(letters, k=50))}" for _ in range(300)]
    template += [t[:60] + "0" + t[61:] for t in template[:50]]
    seen = []
    real = line_dedup.stored

    def counted(df):
        out = real(df)
        if out.columns == ["a", "b"]:
            seen.append((out.count(), out.select("a").distinct().count()))
        return out

    monkeypatch.setattr(line_dedup, "stored", counted)
    got = {r["doc"] for r in line_dedup.decisions(documents(list(enumerate(family + template)))).collect()}
    assert got == set(range(1, 600)) | set(range(900, 950))
    assert len(seen) >= 2 and all(n <= 4 * lines and lines <= 950 for n, lines in seen)


def test_lines_that_only_share_a_segment_are_not_paired(documents, monkeypatch):
    # Buckets below SMALL, each of lines that have nothing in common but its segment.
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789"
    heads = ["".join(rng.choices(letters, k=20)) for _ in range(12)]
    rows = [head + "".join(rng.choices(letters, k=40)) for head in heads for _ in range(24)]
    rows += [r[:30] + "É" + r[31:50] + r[51:] for r in rows[5::24]]
    compared, plans = [], []
    verified, stored = line_dedup._verified, line_dedup.stored
    monkeypatch.setattr(line_dedup, "_verified", lambda pairs, *more: compared.append(pairs.distinct().count()) or verified(pairs, *more))
    monkeypatch.setattr(line_dedup, "stored", lambda df: plans.append(df._jdf.queryExecution().toString()) or stored(df))
    got = {r["doc"] for r in line_dedup.decisions(documents(list(enumerate(rows)))).collect()}
    assert got == set(range(288, 300))
    # One centre for a line, and next to nothing more.
    assert sum(compared) <= 2 * len(rows)
    # Texts are put together by hash, without being sorted.
    assert "HashAggregate" in plans[0] and "SortAggregate" not in plans[0]


def test_marks_of_near_lines_are_near(spark):
    rng = random.Random(9)
    pairs = []
    for _ in range(400):
        line = "".join(rng.choice("abc dé中\U0001F600\U0001F601") for _ in range(rng.randint(0, 40)))
        other = list(line)
        for _ in range(2):
            at = rng.randint(0, len(other))
            other[at:at + rng.randint(0, 1)] = rng.choice(["", "x", "\U0001F602"])
        pairs.append((line, "".join(other)))
    both = spark.createDataFrame(pairs, "a string, b string").select(line_dedup.marks("a").alias("ma"), line_dedup.marks("b").alias("mb"))
    assert both.where(~line_dedup._alike(F.col("ma"), F.col("mb"), 2)).count() == 0
    far = spark.range(200).selectExpr("sha2(string(id), 256) as a", "sha2(string(id + 1), 256) as b")
    assert far.where(line_dedup._alike(line_dedup.marks("a"), line_dedup.marks("b"), 2)).count() == 0


def test_places_are_told_from_one_number(spark):
    want = [(-(2**63), 0), (-3, 2**31 - 1), (-1, 0), (0, 0), (0, 7), (5, 1), (2**63 - 1, 2**31 - 1)]
    made = spark.createDataFrame(want, "doc long, pos int").withColumn("place", line_dedup._place("doc", "pos"))
    got = made.orderBy("place").select(line_dedup._doc_pos("place").alias("at")).collect()
    assert [tuple(r["at"]) for r in got] == want


def test_segments_are_found_in_lines_of_any_bytes(spark):
    # The second line has the first's segments, but characters of several bytes before and after them.
    rows = [(0, "abcdefghijklmnopqrstuvwxyz12"), (1, "ébcdefghijklmnopqrstuvwxyz1中")]
    index = line_dedup.buckets(spark.createDataFrame(rows, "id long, line string").withColumn("n", F.length("line")), 2, True)
    assert {r["id"] for r in index.groupBy("bucket").agg(F.count("*").alias("k"), F.min("id").alias("id")).where("k = 2").collect()} == {0}


def test_lines_of_odd_texts(odd, no_documents):
    assert line_dedup.apply(odd, line_dedup.decisions(odd)).count() == len(ODD) + 1
    assert line_dedup.decisions(no_documents).count() == 0


def test_short_lines_that_repeat_are_dropped_by_the_query(spark, tmp_path):
    # Equal but for white space at the ends; one character off is another line; blank lines stay.
    texts = ["Menu\nHome\n\n}\n\t\n" + "a long line that is long enough", " Menu \nhome\n\n}\n\t\nHome", "Menu\t\n\nMenu\r\nÉ", "Menus\nÉ", None, "", "\u00a0\n\u00a0\nabout a long line that is long"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["dropped"]) for r in queries.op10_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {0: (6, 0, ""), 1: (6, 3, "0,3,5"), 2: (4, 2, "0,2"), 3: (2, 1, "1"), 4: (0, 0, ""), 5: (1, 0, ""), 6: (3, 0, "")}
