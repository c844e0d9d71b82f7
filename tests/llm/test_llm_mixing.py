import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from affinity.llm import mixing, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_exponent(tokens, entropy, repeats, budget=None):
    """Smallest exponent at which both limits hold, by plain bisection."""
    total = sum(tokens)
    p = np.array([t / total for t in tokens if t])

    def fine(t):
        w = p**t / (p**t).sum()
        h = -(w * np.log(w)).sum()
        b = budget / total if budget is not None else (p / w).max()
        return (entropy is None or h <= entropy * math.log(len(p)) + 1e-12) and (repeats is None or (b * w / p).max() <= repeats + 1e-12)

    low, high = 0.0, 1.0
    if fine(low):
        return low
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (low, mid) if fine(mid) else (mid, high)
    return high


def docs_of(spark, sizes, seed=0, parts=4):
    rng = np.random.default_rng(seed)
    rows, i = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            rows.append((i, " ".join(["w"] * int(rng.integers(0, 60))), s, "c"))
            i += 1
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string, source string, block string").repartition(parts)


def tokens_of(rows):
    t = Counter()
    for _, text, s, *_ in rows:
        t[s] += len(WORD.findall(text or ""))
    return t


@pytest.mark.parametrize("entropy,repeats,cover", [(0.95, 3.0, False), (0.9, None, True), (None, 2.0, True), (1.0, 50.0, False)])
def test_weights_budgets_and_permutations(spark, entropy, repeats, cover):
    rows, docs = docs_of(spark, {"a": 900, "b": 200, "c": 60, "d": 15})
    out = mixing.mix(docs, target_entropy=entropy, max_repeats=repeats, cover_all=cover)
    assert out.columns == [*docs.columns, "__tokens", "__copy", "__block", "__position"]
    got = out.collect()
    tokens = tokens_of(rows)
    total = sum(tokens.values())
    t = slow_exponent(list(tokens.values()), entropy, repeats, None if cover else total)
    z = sum((n / total) ** t for n in tokens.values())
    weight = {s: (n / total) ** t / z for s, n in tokens.items()}
    budget = max(n / weight[s] for s, n in tokens.items()) if cover else total
    size = {r[0]: len(WORD.findall(r[1])) for r in rows}
    spent, passes = Counter(), defaultdict(lambda: defaultdict(list))
    for r in got:
        assert r["__tokens"] == size[r["doc_id"]]
        spent[r["source"]] += r["__tokens"]
        passes[r["source"]][r["__copy"]].append((r["__position"], r["doc_id"], r["__tokens"]))
    for s, n in tokens.items():
        quota = weight[s] * budget
        assert quota - 61 <= spent[s] <= quota + 1  # no document fits into what is left of the budget
        whole = int((quota + 1e-6 * n) // n)
        ids = sorted(r[0] for r in rows if r[2] == s)
        for copy in range(1, whole + 1):
            assert sorted(d for _, d, _ in passes[s][copy]) == ids
        assert set(passes[s]) <= set(range(1, whole + 2))
        orders = [tuple(d for _, d, _ in sorted(p)) for p in passes[s].values() if len(p) > 10]
        assert len(set(orders)) == len(orders)  # each pass is a permutation of its own
        if cover:
            assert whole >= 1


def test_the_end_of_a_pass_by_brute_force(spark):
    rows, docs = docs_of(spark, {"a": 700, "b": 300}, seed=4)
    got = mixing.mix(docs, target_entropy=None, max_repeats=None, budget_tokens=9_000.0).collect()
    whole = mixing.mix(docs, target_entropy=None, max_repeats=None, budget_tokens=1e9)
    place = {(r["source"], r["doc_id"]): r["__position"] for r in whole.where("__copy = 1").collect()}
    size = {r[0]: len(WORD.findall(r[1])) for r in rows}
    for s in "ab":
        order = sorted((p, d) for (x, d), p in place.items() if x == s)
        left, want = 4_500, []
        for _, d in order:
            if size[d] > left:
                break
            left -= size[d]
            want.append(d)
        assert sorted(r["doc_id"] for r in got if r["source"] == s) == sorted(want)


def test_exponent_against_bisection(spark):
    rng = np.random.default_rng(2)
    for _ in range(4):
        n = rng.integers(1, 10_000, 12)
        shares = spark.createDataFrame([(float(x / n.sum()),) for x in n], "p double")
        t, _, _ = mixing.find_exponent(shares, 0.9 * math.log(12), 5.0, 1.0)
        assert t == pytest.approx(slow_exponent(n.tolist(), 0.9, 5.0, float(n.sum())), abs=2e-7)


def test_edge_cases(spark):
    schema = "doc_id bigint, text string, source string, whole string, end int, t double"
    rows = [(1, "a b", None), (2, None, "x"), (3, "", "empty"), (4, "c " * 5000, "x"), (4, "c " * 5000, "x"), (None, "d", "y")]
    rows = [(*r, "k", None, 0.5) for r in rows]
    docs = spark.createDataFrame(rows, schema)
    got = mixing.mix(docs, cover_all=True, max_repeats=None).collect()
    assert {(r["doc_id"], r["source"]) for r in got} == {(r[0], r[2]) for r in rows}
    assert sum(r["doc_id"] == 3 for r in got) == 1
    one = Counter((r["__copy"], r["__position"]) for r in got if r["doc_id"] == 4)
    assert set(one.values()) == {2}
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mix(docs.where("doc_id = 3")).count() == 1
    assert mixing.mix(docs, budget_tokens=0.0, max_repeats=None).where("source <> 'empty'").count() == 0
    for bad in ({"target_entropy": 0.0}, {"max_repeats": 0.5}, {"budget_tokens": -1.0}):
        with pytest.raises(ValueError):
            mixing.mix(docs, **bad)


def test_query_meets_its_target(spark):
    got = queries.QUERIES["op10_temperature_mixing"](spark, "/root/testdata/sf0.001").collect()
    assert {r["copy"] for r in got} >= {1} and max(r["copy"] for r in got) <= 5


def sharpened(tokens, entropy):
    """Exponent above 1 at which the entropy falls to the target, and the weights, by plain bisection."""
    p = np.array([t / sum(tokens) for t in tokens])

    def mixed(t):
        w = (p / p.max()) ** t / ((p / p.max()) ** t).sum()
        return -(w * np.log(w)).sum() / math.log(len(p)), w

    low, high = 1.0, 100.0
    assert mixed(low)[0] > entropy > mixed(high)[0]
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if mixed(mid)[0] > entropy else (low, mid)
    return high, mixed(high)[1]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_spends_what_its_target_says(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    size = {r[0]: len(WORD.findall(r[1] or "")) for r in rows}
    tokens = {s: n for s, n in tokens_of(rows).items() if n}
    names, total = sorted(tokens), sum(tokens.values())
    _, w = sharpened([tokens[s] for s in names], 0.98)
    assert max(w * total / [tokens[s] for s in names]) <= 4.0
    got, spent = defaultdict(set), Counter()
    for r in queries.QUERIES["op10_temperature_mixing"](spark, f"/root/testdata/{sf}").collect():
        got[r["source"], r["copy"]].add(r["doc_id"])
        spent[r["source"]] += r["n_tokens"]
    every = mixing.mix(docs, target_entropy=None, max_repeats=None, budget_tokens=20.0 * total)
    place = {(r["source"], r["__copy"], r["doc_id"]): r["__position"] for r in every.where("__copy <= 5").collect()}
    for s, weight in zip(names, w):
        left, copy = round(weight * total), 0
        quota, ids = left, {r[0] for r in rows if r[2] == s}
        while left >= tokens[s]:
            copy, left = copy + 1, left - tokens[s]
            assert got[s, copy] == ids
        want = set()
        for d in sorted(ids, key=lambda d: place[s, copy + 1, d]) if left else []:
            if size[d] > left:
                break
            left -= size[d]
            want.add(d)
        assert got[s, copy + 1] == want and not got[s, copy + 2]
        assert spent[s] == quota - left


def test_limits_that_contradict_each_other(spark):
    _, docs = docs_of(spark, {"a": 400, "b": 390, "c": 380, "d": 370}, seed=3)
    with pytest.raises(ValueError, match="cannot be spent"):
        mixing.mix(docs, budget_tokens=1e6, max_repeats=4.0)
    with pytest.raises(ValueError, match="repeated"):
        mixing.mix(docs, target_entropy=0.5, max_repeats=1.5)
    equal = spark.createDataFrame([(i, "a b c", "xyz"[i % 3]) for i in range(30)], "doc_id bigint, text string, source string")
    with pytest.raises(ValueError, match="no exponent"):
        mixing.mix(equal, target_entropy=0.9)
    with pytest.raises(ValueError, match="on_conflict"):
        mixing.mix(equal, on_conflict="ignore")
    with pytest.warns(UserWarning, match="no exponent"):
        assert mixing.mix(equal, target_entropy=0.9, cover_all=True, on_conflict="nearest").count() == 30


def test_nearest_mix_keeps_coverage_and_repeats(spark):
    rows, docs = docs_of(spark, {"a": 400, "b": 390, "c": 380, "d": 300}, seed=5)
    tokens = tokens_of(rows)
    with pytest.warns(UserWarning, match="above the limit of 2"):
        got = mixing.mix(docs, target_entropy=0.7, max_repeats=2.0, cover_all=True, on_conflict="nearest").collect()
    spent, first = Counter(), Counter()
    for r in got:
        spent[r["source"]] += r["__tokens"]
        first[r["doc_id"]] += r["__copy"] == 1
    assert set(first.values()) == {1} and len(first) == len(rows)
    top, least = max(tokens.values()), min(tokens.values())
    t = 1 + math.log(2.0) / math.log(top / least)
    for s, n in tokens.items():
        quota = n * (n / least) ** (t - 1)
        assert quota - 61 <= spent[s] <= quota + 1 <= 2 * n + 2


def test_exponents_far_above_one(spark):
    shares = spark.createDataFrame([(0.25 + d,) for d in (2e-5, 1e-5, -1e-5, -2e-5)], "p double")
    t, log_z, share = mixing.solve_exponent(shares, 0.9 * math.log(4), None, 1.0)
    p = 0.25 + np.array([2e-5, 1e-5, -1e-5, -2e-5])
    w = np.exp(t * np.log(p) - log_z)
    assert w.sum() == pytest.approx(1) and -(w * np.log(w)).sum() == pytest.approx(0.9 * math.log(4), abs=1e-6)
    assert share == 1.0 and t > 1000


def test_columns_of_any_name_pass_through(spark):
    names = ["__end", "__whole", "__planned", "__source", "__row", "c0", "c1", "a.b", "__tokens", "__copy", "t"]
    rows = [(i, "a b c " * (1 + i % 4), "xyz"[i % 3], *[100 * i + k for k in range(len(names))]) for i in range(40)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "source", *names])
    got = mixing.mix(docs, target_entropy=None, cover_all=True)
    assert got.columns == ["doc_id", "text", "source", *names[:8], "t", "__tokens", "__copy", "__block", "__position"]
    plain = mixing.mix(docs.select("doc_id", "text", "source"), target_entropy=None, cover_all=True)
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(r["doc_id"] for r in plain.collect())
    for r in got.collect():
        assert r["__end"] == 100 * r["doc_id"] and r["a.b"] == 100 * r["doc_id"] + 7 and r["__tokens"] == 3 * (1 + r["doc_id"] % 4)


def test_registered_query_takes_equal_sources(spark, tmp_path):
    from affinity.llm import queries

    docs = spark.createDataFrame([(i, "a b c", "xyz"[i % 3]) for i in range(30)], "doc_id bigint, text string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    with pytest.warns(UserWarning):
        got = queries.QUERIES["op10_temperature_mixing"](spark, str(tmp_path))
    assert got.count() == 30
