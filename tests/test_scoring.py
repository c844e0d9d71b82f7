"""R1-R5 on E9, ties, unmodelled customers, and block sizes."""

import math

import pytest
from pyspark.sql import functions as F

from affinity.operators import scoring as R


def factors(spark, rows, k=1):
    cols = ", ".join(f"f{i} double" for i in range(k))
    return spark.createDataFrame(rows, f"id long, {cols}, bias double")


@pytest.fixture
def e9(spark):
    cust = factors(spark, [(0, 1.0, 0.0)])
    arts = factors(spark, [(1, math.log(0.9), 0.0), (2, math.log(0.8), 0.0), (3, math.log(0.1), 0.0)])
    history = spark.createDataFrame(
        [(0, 1, 5), (0, 2, 40), (0, 7, 0)], "customer_int long, article_int long, days_since_last_purchase int"
    )
    cutoffs = spark.createDataFrame(
        [(1, 10.0), (2, 10.0), (7, 10.0)], "article_int long, p50 double"
    )
    return cust, arts, history, cutoffs


def test_e9_suppression(e9):
    cust, arts, history, cutoffs = e9
    ex = R.excluded_articles(history, cutoffs, "p50", arts)
    assert [(r.customer_int, r.article_int) for r in ex.collect()] == [(0, 1)]


@pytest.mark.parametrize("n,expected", [(2, [2, 3]), (3, [2, 3, 1]), (5, [2, 3, 1])])
def test_e9_top_n(e9, n, expected):
    cust, arts, history, cutoffs = e9
    ex = R.excluded_articles(history, cutoffs, "p50", arts)
    top = R.top_n_scored(cust, arts, 0.0, 1, n, ex).orderBy("rank").collect()
    assert [r.article_int for r in top] == expected
    assert [r.suppressed for r in top][-1] == (n >= 3)


def test_unmodelled_customer_gets_fallback_unchanged(spark, e9):
    cust, arts, history, cutoffs = e9
    ex = R.excluded_articles(history, cutoffs, "p50", arts)
    fb = R.fallback_list(R.fallback_scores(cust, arts, 0.0, 1), 3)
    who = spark.createDataFrame([(0,), (9,)], "customer_int long")
    got = {r.customer_int: list(r.recommendations) for r in R.recommend(who, cust, arts, 0.0, 1, 3, ex, fb).collect()}
    assert got == {0: [2, 3, 1], 9: [1, 2, 3]}


def test_equal_scores_lower_article_first(spark):
    cust = factors(spark, [(0, 1.0, 0.0)])
    arts = factors(spark, [(5, 0.3, 0.0), (2, 0.3, 0.0), (9, 0.1, 0.0), (4, 0.3, 0.0)])
    top = R.top_n_scored(cust, arts, 0.0, 1, 3).orderBy("rank").collect()
    assert [r.article_int for r in top] == [2, 4, 5]


def test_invalid_percentile(e9):
    cust, arts, history, cutoffs = e9
    with pytest.raises(ValueError):
        R.excluded_articles(history, cutoffs, "p42", arts)


def test_blocked_catalogue_equals_single_block(spark):
    k = 3
    ids = spark.range(0, 60)
    expr = [((F.col("id") * (7 + i)) % 13 / 13.0 - 0.5).alias(f"f{i}") for i in range(k)]
    arts = ids.select("id", *expr, ((F.col("id") % 5) / 10.0).alias("bias"))
    cust = spark.range(100, 140).select("id", *expr, F.lit(0.0).alias("bias"))
    ex = spark.range(100, 140).select(F.col("id").alias("customer_int"), (F.col("id") % 60).alias("article_int"))
    one = R.top_n_scored(cust, arts, -0.5, k, 7, ex)
    many = R.top_n_scored(cust, arts, -0.5, k, 7, ex, article_block_rows=9, customer_block_rows=7)
    key = ["customer_int", "rank", "article_int", "suppressed"]
    assert sorted(tuple(r[c] for c in key) for r in one.collect()) == sorted(
        tuple(r[c] for c in key) for r in many.collect()
    )
    assert one.count() == 40 * 7
    # top-N has no duplicates per customer
    assert many.groupBy("customer_int", "article_int").count().where("count > 1").count() == 0


def test_top_rows_matches_full_sort_with_ties_and_suppression():
    import numpy as np

    rng = np.random.default_rng(0)
    e = rng.integers(0, 6, size=(300, 40)).astype(float)  # many exact ties
    sup = rng.random((300, 40)) < 0.3
    sup[:5] = True  # rows with fewer than n unsuppressed
    for n in (1, 7, 40, 45):
        got = R._top_rows(e, sup, n)
        for r in range(300):
            # suppressed articles all score -1.0: among them only the id orders
            full = sorted(range(40), key=lambda c: (sup[r, c], 0.0 if sup[r, c] else -e[r, c], c))[:n]
            assert list(got[r]) == full


def test_lists_equal_in_single_and_blocked_paths(spark):
    k = 2
    expr = [((F.col("id") * (5 + i)) % 11 / 11.0 - 0.5).alias(f"f{i}") for i in range(k)]
    arts = spark.range(0, 40).select("id", *expr, ((F.col("id") % 3) / 10.0).alias("bias"))
    cust = spark.range(200, 230).select("id", *expr, F.lit(0.1).alias("bias"))
    ex = spark.range(200, 230).select(F.col("id").alias("customer_int"), (F.col("id") % 40).alias("article_int"))
    one = {r.customer_int: list(r.recommendations) for r in R.top_n_lists(cust, arts, 0.0, k, 6, ex).collect()}
    many = {r.customer_int: list(r.recommendations)
            for r in R.top_n_lists(cust, arts, 0.0, k, 6, ex, article_block_rows=9, customer_block_rows=7).collect()}
    assert one == many and len(one) == 30 and all(len(v) == 6 for v in one.values())


def plain(e, sup, ids, n):
    """Ranking rule written out: scorable by exponent, then suppressed, then NaN, ids within ties."""
    kind = [2 if math.isnan(x) else int(s) for x, s in zip(e, sup)]
    order = sorted(range(len(ids)), key=lambda c: (kind[c], -e[c] if kind[c] == 0 else 0.0, ids[c]))
    return [ids[c] for c in order[:n]]


@pytest.mark.parametrize("blocks", [1, 4, 5, 100])
def test_fewer_scorable_articles_than_asked_for(spark, blocks):
    cust = factors(spark, [(0, 1.0, 0.0), (1, -1.0, 0.0)])
    e = [float(i) / 7 for i in range(12)]
    arts = factors(spark, [(i, x, 0.0) for i, x in enumerate(e)])
    ex = spark.createDataFrame(
        [(c, a) for c in (0, 1) for a in range(10)] * 2, "customer_int long, article_int long"
    )
    top = R.top_n_lists(cust, arts, 0.0, 1, 6, ex, article_block_rows=blocks, customer_block_rows=1)
    assert {r.customer_int: list(r.recommendations) for r in top.collect()} == {
        0: [11, 10, 0, 1, 2, 3], 1: [10, 11, 0, 1, 2, 3]
    }


@pytest.mark.parametrize("blocks", [2, 100])
def test_nan_scores_rank_last(spark, blocks):
    nan = float("nan")
    e = [nan, nan, 0.5, nan, 0.9, nan, nan, nan]
    arts = factors(spark, [(i, x, 0.0) for i, x in enumerate(e)])
    cust = factors(spark, [(3, 1.0, 0.0)])
    ex = spark.createDataFrame([(3, 2)], "customer_int long, article_int long")
    for n in (1, 4, 8):
        got = R.top_n_lists(cust, arts, 0.0, 1, n, ex, article_block_rows=blocks).first()
        assert list(got.recommendations) == plain(e, [i == 2 for i in range(8)], list(range(8)), n)


def test_fallback_is_the_mean_over_any_sample_and_block_size(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    u, v = rng.normal(size=(150, 3)), rng.normal(size=(40, 3))
    cust = factors(spark, [(i, *map(float, r)) for i, r in enumerate(u)], 2)
    arts = factors(spark, [(i, *map(float, r)) for i, r in enumerate(v)], 2)
    want = np.exp(u[:, :2] @ v[:, :2].T + u[:, 2:] + v[:, 2][None, :] - 0.3).mean(axis=0)
    for rows in (7, 1000):
        got = R.fallback_scores(cust, arts, -0.3, 2, customer_block_rows=rows, article_block_rows=rows)
        assert {r.article_int: r.score for r in got.collect()} == {i: pytest.approx(x) for i, x in enumerate(want)}
    assert R.fallback_scores(cust.limit(0), arts, 0.0, 2).count() == 0


def test_no_article_or_customer(spark):
    cust, arts = factors(spark, [(0, 1.0, 0.0)]), factors(spark, [(1, 1.0, 0.0)])
    assert R.top_n_scored(cust.limit(0), arts, 0.0, 1, 3).count() == 0
    assert R.top_n_scored(cust, arts.limit(0), 0.0, 1, 3).count() == 0


def brute_force(cust, arts, ex, n, g):
    """The N best of every article, scored one by one and ranked by the rule written out."""
    out = {}
    for c in cust:
        e = []
        for a in arts:
            total = c[1] * a[1]
            for x, y in zip(c[2:-1], a[2:-1]):
                total = total + x * y
            e.append(((total + c[-1]) + a[-1]) + g)
        out[c[0]] = plain(e, [(c[0], a[0]) in ex for a in arts], [a[0] for a in arts], n)
    return out


@pytest.mark.parametrize("block,n", [(1, 3), (7, 12), (1000, 12)])
def test_pruned_lists_equal_brute_force(spark, block, n):
    """Norms that fall steeply, so that most blocks are left out, ties at the N-th place, NaN, infinite and
    suppressed articles, and customers that cannot prune."""
    import numpy as np

    rng = np.random.default_rng(n)
    arts = []
    for i in range(300):
        v = rng.normal(size=3) * 10.0 ** -(i // 60)
        v = np.round(v, 1) if i % 2 else v
        arts.append((i, *map(float, v), float(rng.choice([0.0, 0.0, 0.5, -0.25]))))
    arts[17], arts[250] = (17, float("nan"), 0.0, 0.0, 0.0), (250, 0.0, 0.0, 0.0, float("nan"))
    arts[299], arts[280] = (299, 0.0, 0.0, 0.0, float("inf")), (280, 0.0, 0.0, 0.0, 9.0)
    cust = [(i, *map(float, np.round(rng.normal(size=3), 1)), float(rng.normal())) for i in range(60)]
    cust += [(60, 0.0, 0.0, 0.0, 0.0), (61, float("nan"), 0.0, 0.0, 0.0), (62, 1e200, 1e200, 0.0, 0.0)]
    ex = {(int(c), int(a)) for c, a in zip(rng.integers(0, 63, 900), rng.integers(0, 300, 900))} | {(5, a) for a in range(297)}
    exclusions = spark.createDataFrame(sorted(ex), "customer_int long, article_int long")
    top = R.top_n_lists(factors(spark, cust, 3), factors(spark, arts, 3), -0.3, 3, n, exclusions, article_block_rows=block, customer_block_rows=16)
    assert {r.customer_int: list(r.recommendations) for r in top.collect()} == brute_force(cust, arts, ex, n, -0.3)


def test_blocks_out_of_reach_are_not_scored(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    arts = [(i, *map(float, rng.normal(size=2) * (5.0 if i < 50 else 0.01)), 0.0) for i in range(1000)]
    cust = [(i, *map(float, rng.normal(size=2)), 0.0) for i in range(200)]
    seen = R.top_n_scored(factors(spark, cust, 2), factors(spark, arts, 2), 0.0, 2, 5, article_block_rows=50, report=True)
    row = seen.agg(F.sum("scored").alias("scored"), F.sum("pairs").alias("pairs")).first()
    assert row.pairs == 200_000 and row.scored < 0.2 * row.pairs


def test_blocks_of_equal_norms_are_left_out(spark):
    """Factors of one size and many ties: only where in space a block lies tells that it is out of reach."""
    import numpy as np

    rng = np.random.default_rng(3)
    arts = [(i, *map(float, np.round(x / np.linalg.norm(x), 2)), float(i % 3) / 10) for i, x in enumerate(rng.normal(size=(3000, 3)))]
    cust = [(i, *map(float, rng.normal(size=3)), 0.0) for i in range(120)]
    ex = {(int(c), int(a)) for c, a in zip(rng.integers(0, 120, 4000), rng.integers(0, 3000, 4000))}
    tables = factors(spark, cust, 3), factors(spark, arts, 3), 0.0, 3, 5
    seen = R.top_n_scored(*tables, article_block_rows=20, report=True)
    row = seen.agg(F.sum("scored").alias("scored"), F.sum("pairs").alias("pairs")).first()
    assert row.pairs == 360_000 and row.scored < 0.15 * row.pairs
    exclusions = spark.createDataFrame(sorted(ex), "customer_int long, article_int long")
    top = R.top_n_lists(*tables, exclusions, article_block_rows=20, customer_block_rows=16)
    assert {r.customer_int: list(r.recommendations) for r in top.collect()} == brute_force(cust, arts, ex, 5, 0.0)
