import math

import numpy as np
import pytest

from affinity.llm import embed_join, topk

NAN, INF = float("nan"), float("inf")


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, n_links string, score int")


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


def brute_links(rows, t):
    """(vec_id, n_links, component_id, kept) by all pairs; ids may repeat or be null."""
    live = [i for i, r in enumerate(rows) if usable(r[1]) and any(r[1])]
    root, n = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in live:
        for b in live:
            x, y = rows[a][1], rows[b][1]
            if a < b and len(x) == len(y):
                x, y = np.array(x) / max(map(abs, x)), np.array(y) / max(map(abs, y))
                if np.dot(x, y) / (np.linalg.norm(x) * np.linalg.norm(y)) >= t:
                    n[a] += 1
                    n[b] += 1
                    root[find(a)] = find(b)
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((r[0], n[i], least, r[0] is None or least is None or r[0] == least))
    return sorted(out, key=str)


def links(spark, rows, t=0.95, **options):
    found = embed_join.embedding_components(frame(spark, rows), t, **options)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def clustered(rng, families, size, dims, spread):
    rows = []
    for _ in range(families):
        c = rng.normal(size=dims)
        rows += [c * rng.uniform(0.1, 9) + rng.normal(size=dims) * spread for _ in range(size)]
    return [(int(i) * 3 % 10007, v.tolist(), "x", i) for i, v in enumerate(rows)]


@pytest.mark.parametrize("tile_rows", [7, 64, 2048])
def test_links_against_all_pairs(spark, tile_rows):
    rows = clustered(np.random.default_rng(tile_rows), 30, 8, 6, 0.35)
    got = links(spark, rows, tile_rows=tile_rows, leading=3)
    assert got == brute_links(rows, 0.95)
    assert 50 < sum(r[1] for r in got)


def test_links_at_the_threshold_and_edge_cases(spark):
    c = 0.95
    rows = [
        (4, [1.0, 0.0], None, 1), (9, [c, math.sqrt(1 - c * c)], None, 1), (2, [3e300, 0.0], None, 1),
        (7, [5e-300, 0.0], None, 1), (1, None, None, 1), (3, [0.0, 0.0], None, 1), (5, [1.0, None], None, 1),
        (6, [NAN, 1.0], None, 1), (8, [INF, 1.0], None, 1), (10, [], None, 1), (11, [1.0, 0.0, 0.0], None, 1),
        (12, [2.0, 0.0, 0.0], None, 1), (None, [1.0, 0.0], None, 1), (4, [1.0, 0.0], None, 1), (13, [-1.0, 0.0], None, 1),
    ]
    got = links(spark, rows)
    assert got == brute_links(rows, 0.95)
    assert (11, 1, 11, True) in got and (13, 0, 13, True) in got
    assert links(spark, []) == []


def test_hot_vector(spark):
    hot = [0.5, 0.25, -1.0]
    rows = [(i, hot, None, 1) for i in range(400)] + [(1000 + i, [1.0, 0.1 * i, 3.0], None, 1) for i in range(20)]
    assert links(spark, rows, tile_rows=8) == brute_links(rows, 0.95)


def brute_top(rows, k, queries=lambda i: i % 20 == 0):
    live = [(r[0], [math.floor(64 * x) for x in r[1]]) for r in rows if usable(r[1]) and r[0] is not None]
    out = []
    for q, x in live:
        if queries(q):
            best = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in live if i != q and len(x) == len(y))
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(best[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("tile_rows,query_rows", [(5, 2), (64, 8), (8192, 1024)])
def test_top_k_against_all_scores(spark, tile_rows, query_rows):
    rows = clustered(np.random.default_rng(5), 25, 10, 20, 0.4)
    got = topk.top_k(frame(spark, rows), k=20, tile_rows=tile_rows, query_tile_rows=query_rows)
    assert sorted(tuple(r) for r in got.collect()) == brute_top(rows, 20)


def test_top_k_ties_and_edge_cases(spark):
    rows = [(i, [1.0, 1.0], None, 1) for i in range(60)]  # all tie
    rows += [(100, None, None, 1), (120, [NAN, 1.0], None, 1), (140, [1.0, None], None, 1), (160, [], None, 1)]
    rows += [(180, [0.0, 0.0], None, 1), (None, [1.0, 2.0], None, 1), (200, [1.0, 2.0, 3.0], None, 1), (201, [1.0, 0.0, 0.0], None, 1)]
    got = sorted(tuple(r) for r in topk.top_k(frame(spark, rows), k=20, tile_rows=16).collect())
    assert got == brute_top(rows, 20)
    assert (200, 1, 201, 64 * 64) in got
    assert topk.top_k(frame(spark, [])).count() == 0
    with pytest.raises(Exception, match="2\\^26"):
        topk.top_k(frame(spark, [(0, [1e9], None, 1), (1, [1.0], None, 1)])).collect()


def test_top_k_of_long_vectors_and_large_components(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in np.round(rng.normal(0, 1, 1536), 3)], None, 1) for i in range(40)]
    rows += [(100 + i, [float(x) for x in rng.integers(-(2**24), 2**24, 3)], None, 1) for i in range(30)]  # scaled, up to 2^30
    got = topk.top_k(frame(spark, rows), k=5, tile_rows=16).collect()
    assert sorted(tuple(r) for r in got) == brute_top(rows, 5)
    assert max(abs(r["score"]) for r in got) > 2**54
    for bad in ([2.0**25], [1.5 * 2.0**24, 1.5 * 2.0**24], [1e308, 0.0]):  # scaled, a squared norm of 2^62 and more
        with pytest.raises(Exception, match="2\\^62"):
            topk.top_k(frame(spark, [(0, bad, None, 1), (1, [1.0] * len(bad), None, 1)])).collect()


def test_bound_keeps_every_candidate_that_can_tie():
    rng = np.random.default_rng(9)
    for _ in range(60):
        m, dims, k = int(rng.integers(1, 80)), int(rng.integers(1, 40)), int(rng.integers(1, 9))
        data = rng.integers(-4, 5, (dims, m)) * (1 << int(rng.integers(0, 24)))
        q = rng.integers(-4, 5, dims) * (rng.random(dims) < 0.5)
        ids = rng.permutation(m)
        own = np.array([0]) if m > 1 else np.zeros(0, np.int64)
        got, scores = topk.best_in_tile(q, data, np.einsum("ij,ij->j", data, data), ids, own, k)
        score = q @ data
        want = sorted((-int(score[j]), int(ids[j])) for j in range(m) if j not in own)[:k]
        assert list(zip((-scores).tolist(), got.tolist())) == want
