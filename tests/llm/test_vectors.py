import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from evolve.llm import embedding_dedup, neighbours
from evolve.llm.components import components

SCHEMA = "vec_id long, embedding array<float>, label int, rep long, bucket string"


def cluster(rng, centre, many, noise):
    return [np.asarray(centre + noise * rng.standard_normal(len(centre)), dtype=np.float32) for _ in range(many)]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    out, n = [], 0
    for label in (0, 1, None):
        for _ in range(12):
            for v in cluster(rng, rng.standard_normal(16), 6, 0.12):
                out.append((n, v.tolist(), label, 5, "x"))
                n += 1
    twin = out[0]
    out += [(n, twin[1], 0, 5, "x"), (n + 1, twin[1], 1, 5, "x"), (n + 2, [2 * x for x in twin[1]], 0, 5, "x"), (n + 3, None, 0, 5, "x"),
            (n + 4, [0.0] * 16, 0, 5, "x"), (n + 5, [float("nan")] * 16, 0, 5, "x"), (n + 6, [None] * 16, 0, 5, "x"), (n + 7, [math.inf] * 16, 0, 5, "x"),
            (n + 8, [], 0, 5, "x"), (n + 9, [1.0, 2.0], 0, 5, "x"), (n + 10, [1.0, 2.0], 0, 5, "x"), (None, twin[1], 0, 5, "x")]
    return out


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def test_links_and_groups_agree_with_brute_force(spark, rows):
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == len(rows)
    good = [(i, np.float32(v).astype(float), label) for i, v, label, *_ in rows if usable(v) and label is not None and i is not None]
    near = {i: set() for i, *_ in good}
    for i, v, a in good:
        for j, w, b in good:
            if i != j and a == b and len(v) == len(w) and v @ w / math.sqrt(v @ v) / math.sqrt(w @ w) >= 0.98:
                near[i].add(j)
    assert sum(map(len, near.values())) > 50
    for i, *_ in rows:
        reached, todo = {i}, [i]
        while todo:
            for j in near.get(todo.pop(), ()):
                if j not in reached:
                    reached.add(j)
                    todo.append(j)
        want = (i, len(near.get(i, ())), min(reached, default=None) if i is not None else None)
        assert (i, got[i]["n_links"], got[i]["component_id"]) == want
        assert got[i]["kept"] == (i is None or want[2] == i)


def test_a_large_bucket_is_compared_in_blocks(spark, monkeypatch):
    from evolve.llm import blocks

    rng = np.random.default_rng(2)
    centre = rng.standard_normal(16)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(cluster(rng, centre, 60, 0.02))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    whole = sorted(map(tuple, embedding_dedup.near_duplicates(df).collect()))
    monkeypatch.setattr(blocks.block_pairs, "__defaults__", (7,))
    assert sorted(map(tuple, embedding_dedup.near_duplicates(df).collect())) == whole
    assert {r[2] for r in whole} == {0} and min(r[1] for r in whole) > 40


def test_a_pair_at_the_threshold_is_hardly_ever_missed():
    assert embedding_dedup.miss_probability(0.98) < 1e-6


@pytest.mark.parametrize("module", [embedding_dedup])
def test_empty_table(spark, module):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert module.near_duplicates(df).count() == 0
    assert neighbours.search(df, F.col("vec_id") % 20 == 0).count() == 0


def test_nearest_neighbours_are_ranked_exactly_and_found(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = neighbours.search(df, F.col("vec_id") % 5 == 0, nearest=8).collect()
    good = {i: np.float32(v).astype(float) for i, v, *_ in rows if i is not None and usable(v)}
    found = wanted = 0
    for q in [i for i in good if i % 5 == 0]:
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [r[0] for r in own] == list(range(1, len(own) + 1))
        same = {j: float((good[q] * w).sum()) for j, w in good.items() if j != q and len(w) == len(good[q])}
        for _, j, score in own:
            assert score == pytest.approx(same[j], abs=1e-12)
        assert [(-s, j) for _, j, s in own] == sorted((-s, j) for _, j, s in own)
        best = sorted(same, key=lambda j: (-same[j], j))[:8]
        found += len(set(best) & {r[1] for r in own})
        wanted += len(best)
    assert found >= 0.9 * wanted


def test_blocks_of_a_bucket_give_the_same_neighbours(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    ask = F.col("vec_id") % 5 == 0
    assert sorted(map(tuple, neighbours.search(df, ask, block=9).collect())) == sorted(map(tuple, neighbours.search(df, ask).collect()))


def test_queries_of_a_hot_bucket_are_dealt_too(spark, monkeypatch):
    rng = np.random.default_rng(5)
    common = rng.standard_normal(16)
    rows = [(i, (common if i % 3 == 0 else rng.standard_normal(16)).tolist()) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    seen = spark.sparkContext.accumulator(0)
    real = neighbours.runs

    def counted(batches, keys):
        for batch, starts in real(batches, keys):
            if max(b - a for a, b in zip(starts, starts[1:])) > 60:
                seen.add(1)
            yield batch, starts

    whole = neighbours.search(df, F.col("vec_id") % 2 == 0, nearest=5).collect()
    monkeypatch.setattr(neighbours, "runs", counted)
    dealt = neighbours.search(df, F.col("vec_id") % 2 == 0, nearest=5, block=9).collect()
    # 100 queries and 200 points are one vector: groups of about 9 and 9 of them, not of 300.
    assert sorted(map(tuple, dealt)) == sorted(map(tuple, whole)) and len(whole) > 1400 and seen.value == 0


def test_lengths_at_the_ends_of_doubles(spark):
    rows = [(0, [1e-200, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1e200, 0.0], 1), (3, [0.0, 1e-300], 1), (4, [0.0, 1e300], 1), (5, [-1e200, 1e150], 1), (6, [5e-324, 0.0], 1), (20, [1e200, 1e200], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r["component_id"] for r in embedding_dedup.near_duplicates(df).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: 5, 6: 0, 20: 20}
    found = neighbours.search(df, F.col("vec_id") % 20 == 0, nearest=3).collect()
    by_query = {q: [(r["vec_id"], r["score"]) for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (0, 20)}
    assert by_query[0][0] == (2, 1.0) and by_query[20][:2] == [(2, math.inf), (4, math.inf)]


def test_components_of_random_graphs(spark):
    rng = random.Random(3)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1060)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    for n in {n for a, b in edges for n in (a, b) if a != b}:
        assert got[n] == find(n)
