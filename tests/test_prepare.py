"""Preparation operators on the hand-worked cases E1, E2, E4-E7 and the Q-row decisions."""

import pytest
from pyspark.sql import functions as F

from affinity.operators import prepare as P
from affinity.operators.ids import dense_ids
from conftest import d


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_e1_enrichment_drops_unknown_ids_and_assigns_dense_ids(e1_enriched):
    got = rows(e1_enriched, "row", "customer_int", "article_int")
    assert [r[0] for r in got] == [1, 2, 3, 4, 5, 6, 7, 8]  # rows 9 (Z) and 10 (9999) drop
    ids = {r[0]: (r[1], r[2]) for r in got}
    assert ids[1] == (0, 0) and ids[4] == (1, 0) and ids[5] == (1, 1) and ids[7] == (2, 0)
    assert "customer_id" not in e1_enriched.columns and "article_id" not in e1_enriched.columns


def test_dense_ids_contiguous_sorted_and_partition_independent(spark):
    keys = spark.range(0, 997).select(F.format_string("k%05d", (F.col("id") * 7919) % 997).alias("k"))
    keys = keys.union(keys)  # duplicates get one id
    a = dense_ids(keys, "k", "i", num_partitions=3).orderBy("k").collect()
    b = dense_ids(keys.repartition(11), "k", "i", num_partitions=17).orderBy("k").collect()
    assert [r.i for r in a] == list(range(997))
    assert [(r.k, r.i) for r in a] == [(r.k, r.i) for r in b]


def test_split_n7_and_n0(e1_enriched):
    train, holdout = P.split_transactions(e1_enriched, 7)
    assert [r[0] for r in rows(train, "row")] == [1, 2, 3, 4, 5, 6]
    assert [r[0] for r in rows(holdout, "row")] == [7, 8]
    train0, holdout0 = P.split_transactions(e1_enriched, 0)
    assert train0.count() == 8 and holdout0.count() == 0


def test_split_is_a_partition_of_the_input(e1_enriched):
    for n in (0, 3, 7, 30):
        train, holdout = P.split_transactions(e1_enriched, n)
        assert train.count() + holdout.count() == e1_enriched.count()
        assert train.join(holdout, "row").count() == 0


def test_max_prices_and_holdout_counts(e1_enriched):
    train, holdout = P.split_transactions(e1_enriched, 7)
    assert rows(P.max_prices(train), "article_int", "max_price") == [(0, 10.0), (1, 4.0)]
    assert rows(P.holdout_counts(holdout), "customer_int", "article_int", "count") == [
        (0, 1, 1),
        (2, 0, 1),
    ]


@pytest.mark.parametrize(
    "k,s,expected",
    [
        (0.0, 0.0, {(0, 0): 3.0, (0, 1): 1.0, (1, 0): 1.0, (1, 1): 1.0}),
        (0.0, 0.5, {(0, 0): 2.9, (0, 1): 1.0, (1, 0): 0.75, (1, 1): 1.0}),
        (0.1, 1.0, {(0, 0): 1.298364, (0, 1): 1.0, (1, 0): 0.248293, (1, 1): 0.818731}),
    ],
)
def test_e2_weights(e1_enriched, k, s, expected):
    train, _ = P.split_transactions(e1_enriched, 7)
    got = {(r.customer_int, r.article_int): r.weight for r in P.weighted_interactions(train, k, s).collect()}
    assert set(got) == set(expected)
    for key, v in expected.items():
        assert got[key] == pytest.approx(v, abs=1e-6)


def test_weights_with_no_discount_sum_to_row_count(e1_enriched):
    train, _ = P.split_transactions(e1_enriched, 7)
    total = P.weighted_interactions(train).agg(F.sum("weight")).first()[0]
    assert total == train.count()


def test_weights_never_increase_with_decay(e1_enriched):
    train, _ = P.split_transactions(e1_enriched, 7)
    lo = {(r[0], r[1]): r[2] for r in rows(P.weighted_interactions(train, 0.01, 0.3), "customer_int", "article_int", "weight")}
    hi = {(r[0], r[1]): r[2] for r in rows(P.weighted_interactions(train, 0.2, 0.3), "customer_int", "article_int", "weight")}
    assert all(hi[k] <= lo[k] + 1e-12 for k in hi)


def test_e4_price_edge_cases(spark):
    day = d("2020-01-01")
    nan = float("nan")
    tx = spark.createDataFrame(
        [
            (day, 0, 10, 0.0), (day, 0, 11, nan), (day, 1, 11, 5.0), (day, 0, 12, 0.0),
            (day, 1, 12, 4.0), (day, 0, 13, None),
        ],
        "t_dat date, customer_int long, article_int long, price double",
    )
    got = {(r.customer_int, r.article_int): r.weight for r in P.weighted_interactions(tx, 0.0, 1.0).collect()}
    # 0/0 -> 1.0; NaN price -> 1.0; 0/4 -> weight 0 dropped; NULL price dropped
    assert got == {(0, 10): 1.0, (0, 11): 1.0, (1, 11): 1.0, (1, 12): 1.0}
    # external price table without the article -> ratio 1.0
    ext = spark.createDataFrame([(1, 3.0)], "customer_int long, price double").select(
        F.lit(day).alias("t_dat"), "customer_int", F.lit(99).cast("long").alias("article_int"), "price"
    )
    prices = spark.createDataFrame([(10, 5.0)], "article_int long, max_price double")
    assert P.weighted_interactions(ext, 0.0, 1.0, prices).first().weight == 1.0


def test_e4_underflow_is_dropped(spark):
    tx = spark.createDataFrame(
        [(d("2000-01-01"), 0, 1, 1.0), (d("2020-01-01"), 0, 2, 1.0)],
        "t_dat date, customer_int long, article_int long, price double",
    )
    got = {r.article_int: r.weight for r in P.weighted_interactions(tx, 1.0, 0.0).collect()}
    assert got == {2: 1.0}  # exp(-7305) underflows to 0 and is filtered (Q10)


def test_e5_recency(e1_enriched):
    train, _ = P.split_transactions(e1_enriched, 7)
    got = rows(P.days_since_last_purchase(train), "customer_int", "article_int", "days_since_last_purchase")
    assert got == [(0, 0, 5), (0, 1, 0), (1, 0, 7), (1, 1, 2)]


@pytest.mark.parametrize("n,expected", [(7, [1, 2, 3, 4, 5]), (5, [1, 2, 3, 4]), (0, [])])
def test_e6_first_n_days(e1_enriched, n, expected):
    train, _ = P.split_transactions(e1_enriched, 7)
    out = P.transactions_first_n_days(train, n)
    assert [r[0] for r in rows(out, "row")] == expected
    if expected:
        assert {"t_dat_first", "days_since_first_t"} <= set(out.columns)


def test_e7_new_customers_in_holdout(e1_enriched):
    train, holdout = P.split_transactions(e1_enriched, 7)
    assert [r[0] for r in rows(P.holdout_new_customer_transactions(train, holdout), "row")] == [7]


def test_known_customers_is_sorted_unique_intersection(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (5,)], "customer_int long")
    b = spark.createDataFrame([(5,), (2,), (2,), (7,)], "customer_int long")
    assert rows(P.known_customers(a, b), "customer_int") == [(2,), (5,)]


def test_q24_duplicate_dimension_keys_do_not_multiply_rows(spark, e1):
    tx, customers, articles = e1
    dup = customers.union(customers)
    cmap = dense_ids(dup, "customer_id", "customer_int")
    amap = dense_ids(articles, "article_id", "article_int")
    assert P.enrich_transactions(tx, cmap, amap).count() == 8
    assert cmap.count() == 4


def test_max_date_on_empty_input(spark):
    empty = spark.createDataFrame([], "t_dat date, customer_int long")
    train, holdout = P.split_transactions(empty, 7)
    assert train.count() == 0 and holdout.count() == 0


def test_dense_ids_partition_count_follows_key_count(spark):
    keys = spark.range(0, 1000).select((F.col("id") * 7).cast("string").alias("k"))
    got = dense_ids(keys, "k", "i", keys_per_partition=90).orderBy("k").collect()
    assert [r.i for r in got] == list(range(1000))
    assert [r.k for r in got] == sorted(str(i * 7) for i in range(1000))


def test_weight_grid_equals_single_variants(e1_enriched, spark, scratch):
    from affinity.sources.writers import read_weighted_interactions, write_weighted_interaction_grid

    train, _ = P.split_transactions(e1_enriched, 7)
    grid = [(0.0, 0.0), (0.1, 1.0), (0.0001, 0.5)]
    out = P.weighted_interaction_grid(train, grid)
    write_weighted_interaction_grid(out, f"{scratch}/w", grid)
    for k, s in grid:
        one = {(r.customer_int, r.article_int): r.weight for r in P.weighted_interactions(train, k, s).collect()}
        sub = out.where((F.col("t_discount") == k) & (F.col("price_discount") == s))
        got = {(r.customer_int, r.article_int): r.weight for r in sub.collect()}
        assert got.keys() == one.keys() and all(abs(got[x] - one[x]) < 1e-12 for x in one)
        back = read_weighted_interactions(spark, f"{scratch}/w", k, s)
        assert back.count() == len(one)


@pytest.mark.parametrize("strengths", [(-0.1, 0.0), (0.0, 2.0), (0.0, -1.0), (float("nan"), 0.0)])
def test_strengths_out_of_range_are_errors(e1_enriched, strengths):
    with pytest.raises(ValueError):
        P.weighted_interactions(e1_enriched, *strengths)
    with pytest.raises(ValueError):
        P.weighted_interaction_grid(e1_enriched, [strengths])


def test_negative_days_are_errors(e1_enriched):
    with pytest.raises(ValueError):
        P.split_transactions(e1_enriched, -1)
    with pytest.raises(ValueError):
        P.transactions_first_n_days(e1_enriched, -1)


def test_null_customers_are_not_known(spark):
    a = spark.createDataFrame([(1,), (None,), (2,)], "customer_int long")
    b = spark.createDataFrame([(2,), (None,), (2,)], "customer_int long")
    assert [r[0] for r in P.known_customers(a, b).collect()] == [2]
