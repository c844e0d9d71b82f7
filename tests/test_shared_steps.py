"""Steps that the purchase queries share: as few passes and shuffles as they need, with the same rows."""

import datetime as dt

from pyspark.sql import functions as F

from affinity.operators import prepare as P
from affinity.sources import starschema as X


def test_enriching_two_tables_gives_the_rows_of_the_joined_one(spark):
    orders = spark.createDataFrame([(1, "A"), (2, "B"), (2, "C"), (3, "Z"), (None, "A")], "o bigint, customer_id string")
    lines = spark.createDataFrame(
        [(1, "x", 1), (1, "x", 1), (1, "y", 2), (2, "x", 3), (3, "x", 4), (9, "x", 5), (None, "x", 6), (1, None, 7)],
        "o bigint, article_id string, n int",
    )
    customers = spark.createDataFrame([("A", 0), ("B", 1), ("C", 2), ("C", 3)], "customer_id string, customer_int bigint")
    articles = spark.createDataFrame([("x", 0)], "article_id string, article_int bigint")
    whole = P.enrich_transactions(orders.join(lines, "o"), customers, articles)
    split = P.enrich_transactions(orders, customers, articles, lines=lines, on="o")
    columns = ["o", "n", "customer_int", "article_int"]
    assert sorted(split.select(columns).collect()) == sorted(whole.select(columns).collect())
    assert split.count() == 5


def test_weights_without_discounts_read_train_once(spark):
    rows = [(1, 1, dt.date(2020, 1, 1), 2.0), (1, 1, dt.date(2020, 1, 5), 0.0), (1, 2, None, 1.0), (2, 1, dt.date(2020, 1, 2), None),
            (2, 2, dt.date(2020, 1, 2), float("nan")), (3, 1, dt.date(2020, 1, 3), float("inf")), (None, 1, dt.date(2020, 1, 3), 1.0)]
    tx = spark.createDataFrame(rows, "customer_int bigint, article_int bigint, t_dat date, price double")
    out = P.weighted_interactions(tx)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "scalar-subquery" not in plan
    got = {(r.customer_int, r.article_int): r.weight for r in out.collect()}
    assert got == {(1, 1): 2.0, (2, 2): 1.0, (None, 1): 1.0}  # no date, no price: nothing; infinite: no number


def star(spark, folder, orders, lines):
    day = "timestamp'2020-01-01 10:00:00' + make_interval(0, 0, 0, day)"
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, day int").withColumn(
        "o_orderdate", F.expr(day)).drop("day").write.mode("overwrite").parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_quantity double, l_extendedprice double").write.mode(
        "overwrite").parquet(f"{folder}/lineitem.parquet")


def test_newest_purchase_is_that_of_the_join(spark, scratch):
    lines = [(k, 1, 1.0, 1.0) for k in (1, 1, 2, None)]
    for orders, expected in [
        ([(1, 1, 0), (2, 1, 900), (3, 1, 901), (4, 1, 1000), (None, 1, 1000)], dt.date(2020, 1, 1) + dt.timedelta(900)),
        ([(1, 1, 1000), (2, 1, 0)], dt.date(2020, 1, 1) + dt.timedelta(1000)),
        ([(1, 1, 5), (2, 1, None), (2, 1, 3)], dt.date(2020, 1, 6)),
        ([(8, 1, 0), (9, 1, 40)], None),
        ([(1, 1, None)], None),
    ]:
        star(spark, scratch, orders, lines)
        assert X.newest_purchase(spark, scratch) == expected == P.max_date(X.tx_part(spark, scratch))


def test_few_batches_are_written_without_a_shuffle_of_their_own(spark, monkeypatch):
    from affinity.operators import factors as M

    rows = [(c, a, float(1 + (c + a) % 3)) for c in range(12) for a in range(9) if (c * a) % 4 != 1]
    pairs = spark.createDataFrame(rows, "customer_int bigint, article_int bigint, weight double")
    options = dict(k=2, epochs=2, batch_share=0.5, validation_share=0.1, seed=3, init_scale=0.1, lr=0.01)
    values = lambda m: {(r.side, r.id): r[2:5] for r in M.to_params(m).select("side", "id", "f0", "f1", "bias").collect()}
    with monkeypatch.context() as m:  # as with many batches
        m.setattr("affinity.operators.param_log.FEW_BATCHES", 0)
        m.setattr("affinity.operators.factors.FEW_BATCHES", 0)
        dealt = values(M.fit_log_link_factors(pairs, **options))
    with monkeypatch.context() as m:
        m.setattr(type(pairs), "repartition", lambda *_: (_ for _ in ()).throw(AssertionError("shuffled")))
        found = values(M.fit_log_link_factors(pairs, **options))
    assert dealt.keys() == found.keys()
    assert all(abs(x - y) < 1e-9 for key in dealt for x, y in zip(dealt[key], found[key]))


def test_intermediate_tables_are_compressed(spark, scratch):
    from affinity.operators import factors as M
    from affinity.session import staged

    rows = spark.range(20)
    store = M.ParamStore(spark)
    tables = [staged(rows), store.put(rows, "x")]
    assert all(".zstd." in f for table in tables for f in table.inputFiles())
    assert all(table.count() == 20 for table in tables)
