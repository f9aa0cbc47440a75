"""The permutation index against a search of all pairs."""

import math

import numpy as np
import pytest

from tripspark.llm import queries, vector_search


def dot(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += float(x) * float(y)
    return total


def plain(rows, k=20, every=20):
    """{query_id: [(vec_id, score), ...]} by comparing all; ids are distinct."""
    matrix = np.array([v for _, v in rows], np.float64)
    out = {}
    for n, (q, v) in enumerate(rows):
        if q % every:
            continue
        near = np.argsort(-(matrix @ matrix[n]), kind="stable")[:k + 60]
        scored = sorted((-dot(v, rows[i][1]), rows[i][0]) for i in near if i != n)
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, true):
    hits = [len({i for i, _ in got.get(q, ())} & {i for i, _ in near}) / len(near)
            for q, near in true.items() if near]
    return sum(hits) / len(hits)


@pytest.mark.parametrize("scale", ["0.01", "0.1"])
def test_recall_on_the_test_tables(spark, scale):
    folder = f"/root/testdata/sf{scale}"
    rows = [(r["vec_id"], list(r["embedding"])) for r in
            spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got, true = found(queries.op12_nearest_neighbours(spark, folder)), plain(rows)
    assert got.keys() == true.keys() and all(len(x) == 20 for x in got.values())
    assert recall(got, true) >= 0.9
    vectors = dict(rows)
    assert all(s == dot(vectors[q], vectors[i]) and i != q for q, near in got.items() for i, s in near)


def test_clusters_read_few_lists(spark, monkeypatch):
    """Where vectors lie in groups, few lists hold what is near; blocks split a crowded list."""
    monkeypatch.setattr(vector_search, "LIST", 60)
    monkeypatch.setattr(vector_search, "BLOCK", 50)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 16)) * 3
    rows = [(i, (centres[0 if i % 3 == 0 else rng.integers(30)] + rng.normal(size=16) * .3).tolist())
            for i in range(3000)]
    seen = []
    settings = vector_search._settings
    monkeypatch.setattr(vector_search, "_settings", lambda *a: seen.append((
        settings(*a), a[1].heads)) or seen[-1][0])
    got = found(vector_search.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    assert recall(got, plain(rows)) >= 0.9
    (probes, share), heads = seen[0]
    assert probes < heads and share < 0.6


def test_copies_and_ties(spark):
    """A third of all rows are one vector; of equal scores the smaller ids come first."""
    rows = [(i, [1.0, 2.0, 0.0] if i % 3 == 0 else [float(i % 7), 1.0, float(i % 5)])
            for i in range(400)]
    got = found(vector_search.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")))
    true = {}
    for q, v in rows:
        if q % 20 == 0:
            near = sorted((-dot(v, w), i) for i, w in rows if i != q)[:20]
            true[q] = [(i, -s) for s, i in near]
    assert recall(got, true) >= 0.9
    for q, near in got.items():
        assert near == sorted(near, key=lambda x: (-x[1], x[0])) and q not in dict(near)


def test_few_rows_give_all(spark):
    rows = [(i, [math.cos(i), math.sin(i)]) for i in range(15)]
    got = found(vector_search.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"),
                                      queries="vec_id % 2 = 0"))
    assert got == plain(rows, every=2) and all(len(x) == 14 for x in got.values())


def test_edges(spark):
    kind = "vec_id long, embedding array<float>, point string, no long, list int"
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], "p", 1, 1), (1, [0.5, 1.0], "p", 1, 1), (2, None, None, None, None),
            (3, [0.0, 0.0], "", 0, 0), (4, [nan, 1.0], "", 0, 0), (5, [1.0, inf], "", 0, 0),
            (6, [None, 1.0], "", 0, 0), (7, [], "", 0, 0), (8, [1.0], "", 0, 0),
            (None, [3.0, 3.0], "", 0, 0), (20, [1.0, 0.5], "", 0, 0), (20, [1.0, 0.5], "", 0, 0),
            (40, [-1.0, 0.0], "", 0, 0), (1, [2.0, 2.0], "", 0, 0)]
    got = found(vector_search.nearest(spark.createDataFrame(rows, kind)))
    assert got == {0: [(1, 3.0), (20, 1.25), (20, 1.25), (1, 1.0), (40, -1.0)],
                   20: [(1, 3.0), (0, 1.25), (20, 1.25), (1, 1.0), (40, -1.0)],
                   40: [(1, -0.5), (0, -1.0), (20, -1.0), (20, -1.0), (1, -2.0)]}
    assert found(vector_search.nearest(spark.createDataFrame(rows[:0], kind))) == {}
    assert found(vector_search.nearest(spark.createDataFrame(rows[:1], kind))) == {}


@pytest.mark.parametrize("dim,scale", [(8, 1.0), (8, 1e-160), (8, 1e200), (700, 1.0)])
def test_only_what_can_reach_is_compared_in_full(dim, scale):
    """As plain search of all pairs finds them, with few products in full, with and without floors."""
    rng = np.random.default_rng(dim)
    shape = vector_search.Pivots(rng.normal(size=(40, dim)), 5, 16)
    entries, queries = rng.normal(size=(3000, dim)) * scale, rng.normal(size=(30, dim))
    entries[1000:1100] = entries[:100]
    orders, weights = shape.orders(queries)[0], np.ascontiguousarray(
        shape.weights(shape.orders(entries)[0]).T)
    own = shape.weights(orders)
    like = np.array([np.minimum(w[:, None], weights).sum(0) for w in own])
    assert (vector_search.likeness(own, weights) == like).all()
    least = np.sort(like, 1)[:, 1500]
    with np.errstate(all="ignore"):
        score = np.array([vector_search.inner_products(np.tile(q, (3000, 1)), entries) for q in queries])
    floor = np.where(np.arange(30) % 3, np.sort(score, 1)[:, 2800], -np.inf)
    x, y = vector_search.reaching(shape, queries, orders, least, floor, entries, weights, 21)
    # Where squares overflow nothing is known, and all stay in.
    assert (len(x) <= 30 * 30 or scale > 1e150) and (np.diff(x) >= 0).all()
    for q in range(30):
        true = [e for e in range(3000) if like[q, e] >= least[q] and score[q, e] >= floor[q]]
        true = sorted(true, key=lambda e: (-score[q, e], e))[:21]
        assert set(true) <= set(y[x == q].tolist()) and (like[q, y[x == q]] >= least[q]).all()
