"""A customer holding a third of all rows: results equal a pandas brute force, both with
broadcast joins where Spark chooses them and with all of them forced off (shuffle joins + AQE)."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from affinity.operators import prepare as P
from affinity.operators.quantiles import NAMES, repeat_gap_quantiles
from affinity.sources import starschema as X
from conftest import SF_SMALL

HOT = 1


@pytest.fixture(scope="module")
def hot_tx(spark):
    tx = X.tx_part(spark, SF_SMALL)
    # every third purchase (by a hash of its content) moves to one hot customer
    hot = F.pmod(F.hash("t_dat", "customer_int", "article_int", "price"), F.lit(3)) == 0
    return tx.withColumn("customer_int", F.when(hot, F.lit(HOT).cast("long")).otherwise(F.col("customer_int"))).persist()


@pytest.fixture(params=["broadcast", "shuffle"])
def mode(request, spark):
    if request.param == "shuffle":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.catalog.clearCache()


def brute_weights(pdf, k, s):
    mx = pdf.groupby("article_int")["price"].max().rename("max_price")
    df = pdf.join(mx, on="article_int")
    ratio = np.where(df["max_price"] == 0, 1.0, df["price"] / df["max_price"])
    days = (pd.to_datetime(df["t_dat"].max()) - pd.to_datetime(df["t_dat"])).dt.days
    df = df.assign(w=(ratio * s + (1 - s)) * np.exp(-k * days))
    g = df.groupby(["customer_int", "article_int"])["w"].sum()
    return {key: v for key, v in g.items() if v > 0}


def test_hot_customer(spark, hot_tx, mode):
    train, holdout = P.split_transactions(hot_tx, 365)
    pdf = train.toPandas()
    share = (pdf["customer_int"] == HOT).mean()
    assert 0.25 < share < 0.42

    got = {(r.customer_int, r.article_int): r.weight for r in P.weighted_interactions(train, 0.001, 1.0).collect()}
    want = brute_weights(pdf, 0.001, 1.0)
    assert set(got) == set(want)
    assert all(abs(got[key] - want[key]) < 1e-9 for key in want)

    first = pdf.groupby("customer_int")["t_dat"].transform("min")
    days = (pd.to_datetime(pdf["t_dat"]) - pd.to_datetime(first)).dt.days
    assert P.transactions_first_n_days(train, 30).count() == int((days < 30).sum())

    hpdf = holdout.toPandas()
    new = hpdf[~hpdf["customer_int"].isin(set(pdf["customer_int"]))]
    assert P.holdout_new_customer_transactions(train, holdout).count() == len(new)

    # nearest-rank gap quantiles per article against a direct computation
    srt = pdf.sort_values(["customer_int", "article_int", "t_dat"])
    prev = srt.groupby(["customer_int", "article_int"])["t_dat"].shift()
    gaps = (pd.to_datetime(srt["t_dat"]) - pd.to_datetime(prev)).dt.days
    srt = srt.assign(g=gaps)[gaps > 0]
    want_q = {}
    for a, grp in srt.groupby("article_int"):
        v = sorted(grp["g"].astype(int))
        want_q[a] = [float(v[int(q * (len(v) - 1) + 0.5)]) for q in (0.1, 0.25, 0.5, 0.75, 0.9)]
    got_q = {r.article_int: [r[n] for n in NAMES] for r in repeat_gap_quantiles(train).collect()}
    assert got_q == want_q
