"""A5 quantile modes on E3 and C3 on E1."""

import pytest
from pyspark.sql import functions as F

from affinity.operators import prepare as P
from affinity.operators import quantiles as Q
from affinity.operators.quantiles import NAMES, group_quantiles, repeat_gap_quantiles

E3 = {
    "nearest": [1, 2, 3, 3, 10],
    "disc": [1, 1, 2, 3, 10],
    "linear": [1.3, 1.75, 2.5, 4.75, 7.9],
}


@pytest.mark.parametrize("mode", list(E3))
def test_e3_modes(spark, mode):
    df = spark.createDataFrame([(1, g) for g in (1, 2, 3, 10)], "a long, g int")
    row = group_quantiles(df, "a", "g", mode=mode).first()
    assert [row[n] for n in NAMES] == pytest.approx(E3[mode])


def test_nearest_matches_brute_force_on_random_groups(spark):
    import random

    rnd = random.Random(7)
    data = [(a, rnd.randint(1, 40)) for a in range(30) for _ in range(rnd.randint(1, 60))]
    df = spark.createDataFrame(data, "a long, g int")
    got = {r.a: [r[n] for n in NAMES] for r in group_quantiles(df, "a", "g").collect()}
    for a in range(30):
        vals = sorted(g for x, g in data if x == a)
        n = len(vals)
        want = [vals[int((q * (n - 1)) + 0.5)] for q in (0.1, 0.25, 0.5, 0.75, 0.9)]
        assert got[a] == want


def test_quantiles_are_ordered(spark):
    df = spark.range(0, 500).select((F.col("id") % 13).alias("a"), ((F.col("id") * 37) % 101).alias("g"))
    for mode in ("nearest", "disc", "linear", "approx"):
        for r in group_quantiles(df, "a", "g", mode=mode).collect():
            vals = [r[n] for n in NAMES]
            assert vals == sorted(vals)


def test_c3_on_e1_only_article_with_positive_gap(e1_enriched):
    train, _ = P.split_transactions(e1_enriched, 7)
    out = repeat_gap_quantiles(train).collect()
    assert len(out) == 1 and out[0].article_int == 0
    assert [out[0][n] for n in NAMES] == [4.0] * 5  # same-day repeat (gap 0) dropped


def test_gaps_ignore_how_many_rows_share_a_day(spark):
    import datetime as dt

    base = dt.date(2020, 1, 1)
    # a hot pair: many rows on each of a few days -> gaps only between distinct days
    rows = [(base + dt.timedelta(days=d), 1, 1, 1.0) for d in (0, 0, 0, 3, 3, 10) for _ in range(50)]
    tx = spark.createDataFrame(rows, "t_dat date, customer_int long, article_int long, price double")
    gaps = sorted(r[0] for r in P.repeat_purchase_gaps(tx, out="g").select("g").collect())
    assert gaps == [3, 7]


def test_invalid_mode(spark):
    df = spark.createDataFrame([(1, 1)], "a long, g int")
    with pytest.raises(ValueError):
        group_quantiles(df, "a", "g", mode="median")


def test_disc_from_the_histogram_equals_percentile_disc(spark):
    import random

    rnd = random.Random(8)
    rows = [(g, rnd.randint(0, 30)) for g in range(40) for _ in range(rnd.randint(1, 25))]
    df = spark.createDataFrame(rows + [(0, None)], "g int, v int")
    got = {r[0]: list(r)[1:] for r in Q.group_quantiles(df, "g", "v", mode="disc").collect()}
    for g in range(40):
        v = sorted(x for k, x in rows if k == g)
        assert got[g] == [float(v[max(0, -(-round(q * 100) * len(v) // 100) - 1)]) for q in Q.LEVELS]
