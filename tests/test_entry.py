"""Driver contract: entry(), queries() and oracle_sql()."""

import __spark_entry__ as E

ROWS_ONLY = {"fit_factors", "fit_als"}


def test_registry_has_oracle_for_every_sql_expressible_query():
    own = lambda names: {n for n in names if n != "pipeline" and not n.startswith("op")}
    q, o = own(E.queries()), own(E.oracle_sql())
    assert set(o) <= set(q)
    assert set(q) - set(o) == ROWS_ONLY
    assert len(q) >= 35


def test_entry_runs_on_smallest_scale(spark):
    df = E.entry(spark)
    assert df.columns == ["customer_int", "article_int", "weight"]
    assert df.count() > 0


def test_a_few_queries_run_at_smallest_scale(spark):
    q = E.queries()
    for key in ("repeat_gap_quantiles", "recommendations", "mean_average_precision", "submission"):
        assert q[key](spark, "/root/testdata/sf0.001").count() > 0
