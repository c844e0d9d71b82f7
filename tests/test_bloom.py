"""Bloom-filter reduction of semi joins."""

import pytest
from pyspark.sql import functions as F

from affinity.operators import bloom
from affinity.operators import prepare as P


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_no_key_is_lost_and_most_others_go(spark, kind):
    rows = spark.range(0, 20_000).select(F.col("id").cast(kind).alias("k"), (F.col("id") * 2).alias("v"))
    keys = spark.range(0, 20_000, 40).select(F.col("id").cast(kind).alias("k"))
    got = bloom.maybe_in(rows, keys, "k")
    assert got.columns == ["k", "v"]
    found = {r.k for r in got.collect()}
    wanted = {r.k for r in keys.collect()}
    assert wanted <= found and len(found) < len(wanted) + 20_000 / 8
    assert bloom.maybe_in(rows, keys.limit(0), "k").count() == 0


def test_a_full_filter_changes_no_result(spark, monkeypatch):
    monkeypatch.setattr(bloom, "MAX_BITS", 64)
    train = spark.range(0, 3000).select((F.col("id") % 700).alias("customer_int"))
    holdout = spark.range(0, 900).select((F.col("id") + 500).alias("customer_int"))
    known = {r.customer_int for r in P.known_customers(train, holdout).collect()}
    assert known == set(range(500, 700))
    new = sorted(r.customer_int for r in P.holdout_new_customer_transactions(train, holdout).collect())
    assert new == list(range(700, 1400))


def test_bits_follow_the_keys_up_to_the_bound():
    assert bloom.filter_bits(0) == 64 and bloom.filter_bits(100) == 2048
    assert bloom.filter_bits(10**12) == bloom.MAX_BITS


def test_train_is_reduced_before_its_shuffle(spark):
    """The exchange of train's customers lies above the join with the broadcast filter."""
    train = spark.range(0, 3000).select((F.col("id") % 700).alias("customer_int"))
    holdout = spark.range(0, 30).select((F.col("id") * 50).alias("customer_int"))
    plan = P.known_customers(train, holdout)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("getbit") > plan.index("Exchange") and "BroadcastHashJoin" in plan
