"""Plan shape checks: no Python UDFs in the preparation plans, no single-partition exchange
feeding a window, date bounds pushed to the scan."""

import contextlib
import io

import pytest

from affinity.operators import prepare as P
from affinity.operators.quantiles import repeat_gap_quantiles
from affinity.sources import starschema as X
from conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def split(spark):
    spark.catalog.clearCache()  # plans here must show the scans, not cached relations
    return P.split_transactions(X.tx_part(spark, SF_SMALL), 365)


def preparation_plans(split):
    train, holdout = split
    return {
        "C2": P.weighted_interactions(train, 0.001, 1.0),
        "C3": repeat_gap_quantiles(train),
        "C4": P.days_since_last_purchase(train),
        "C5": P.transactions_first_n_days(train, 7),
        "C6": P.holdout_new_customer_transactions(train, holdout),
        "A4": P.holdout_counts(holdout),
    }


def test_no_python_in_preparation(split):
    for name, df in preparation_plans(split).items():
        text = plan(df)
        for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas"):
            assert marker not in text, f"{name} plans {marker}"


def test_no_single_partition_window(split):
    for name, df in preparation_plans(split).items():
        lines = plan(df).splitlines()
        tree = [ln for ln in lines if ln.strip().startswith(("+-", ":-")) or "(" in ln]
        for i, ln in enumerate(tree):
            if "Window" in ln and "WindowGroupLimit" not in ln:
                below = " ".join(tree[i + 1 : i + 4])
                assert "SinglePartition" not in below, f"{name}: window over one partition"
        assert "Exchange SinglePartition" not in "\n".join(
            ln for ln in lines if "Window" in ln
        )


def test_time_split_bound_reaches_the_scan(split):
    train, _ = split
    pushed = [ln for ln in plan(train).splitlines() if "PushedFilters" in ln]
    assert any("LessThan(o_orderdate" in ln or "LessThanOrEqual(o_orderdate" in ln for ln in pushed), pushed


def test_gap_windows_run_on_distinct_days(split):
    train, _ = split
    text = plan(repeat_gap_quantiles(train))
    # the lag window runs after the (customer, article, day) de-duplication aggregate
    assert text.index("HashAggregate") < text.rindex("Window")


def test_scoring_shuffles_customers_only(spark):
    """No join, window or shuffle of blocks: customers are dealt once, article blocks are read from files."""
    from pyspark.sql import functions as F

    from affinity.operators import scoring as R

    arts = spark.range(0, 30).select("id", (F.col("id") / 30.0).alias("f0"), F.lit(0.0).alias("bias"))
    cust = spark.range(100, 110).select("id", F.lit(1.0).alias("f0"), F.lit(0.0).alias("bias"))
    text = plan(R.top_n_scored(cust, arts, 0.0, 1, 5, article_block_rows=7))
    assert "MapInArrow" in text and text.count("\n+- Exchange") + text.count("   +- Exchange") == 1
    assert "Join" not in text and "Window" not in text


def test_results_do_not_depend_on_shuffle_partitions(spark, split):
    train, _ = split
    old = spark.conf.get("spark.sql.shuffle.partitions")
    out = []
    try:
        for n in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            w = sorted((r.customer_int, r.article_int, round(r.weight, 9)) for r in P.weighted_interactions(train, 0.001, 1.0).collect())
            g = sorted(tuple(r) for r in repeat_gap_quantiles(train).collect())
            out.append((w, g))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert out[0] == out[1]
