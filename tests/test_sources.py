"""Readers and writers: CSV ids stay text, strict / lenient dates, S7 partitions, S12 resets,
F6 NULL for unknown pairs (Q19)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from affinity.operators.lookup import lookup_weights
from affinity.sources import readers as RD
from affinity.sources import writers as W


def write_text(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_csv_transactions_keep_leading_zeros_and_parse_dates(spark, scratch):
    p = f"{scratch}/tx.csv"
    write_text(p, "customer_id,till,t_dat,price,article_id\n00a,07,2020-09-01,0.5,0101\n")
    row = RD.read_transactions(spark, p).first()
    assert row.article_id == "0101" and row.customer_id == "00a"
    assert row.t_dat == dt.date(2020, 9, 1) and row.price == 0.5
    assert row.till == "07"  # columns are found by name, unknown ones pass through


def test_bad_dates_strict_fails_lenient_is_null(spark, scratch):
    p = f"{scratch}/bad.csv"
    write_text(p, "t_dat,customer_id,article_id,price\n2020-13-45,a,1,1.0\n")
    assert RD.read_transactions(spark, p, lenient_dates=True).first().t_dat is None
    with pytest.raises(Exception):
        RD.read_transactions(spark, p).collect()


def test_articles_csv_ids_are_text(spark, scratch):
    p = f"{scratch}/articles.csv"
    write_text(p, "article_id,name\n0000012345,x\n")
    assert RD.read_articles(spark, p).first().article_id == "0000012345"


def test_read_interactions_first_rows_by_key(spark, scratch):
    df = spark.createDataFrame([(2, 1, 1.0), (1, 5, 2.0), (1, 2, 3.0)], "customer_int long, article_int long, weight double")
    W.write_table(df, f"{scratch}/inter")
    got = [(r.customer_int, r.article_int) for r in RD.read_interactions(spark, f"{scratch}/inter", n_rows=2).collect()]
    assert got == [(1, 2), (1, 5)]


def test_s7_weights_partitioned_by_strengths(spark, scratch):
    a = spark.createDataFrame([(1, 1, 1.0)], "customer_int long, article_int long, weight double")
    b = spark.createDataFrame([(2, 2, 2.0)], "customer_int long, article_int long, weight double")
    W.write_weighted_interactions(a, f"{scratch}/w", 0.01, 0.0)
    W.write_weighted_interactions(b, f"{scratch}/w", 0.001, 1.0)
    W.write_weighted_interactions(b, f"{scratch}/w", 0.01, 0.0)  # replaces only its own folder
    assert W.strength_label(0.01) == "0-01" and W.strength_label(1) == "1-0"
    assert [r.customer_int for r in W.read_weighted_interactions(spark, f"{scratch}/w", 0.01, 0.0).collect()] == [2]
    assert W.read_weighted_interactions(spark, f"{scratch}/w", 0.001, 1.0).count() == 1
    assert W.area(7) == "dev" and W.area(0) == "submission"


def test_s12_metrics_reset_per_run(spark, scratch):
    for run in range(2):
        log = W.MetricsLog(spark, scratch, "mf", "v1")
        log.log_batch(0, 0, 1.0, 0.5)
        log.log_batch(0, 1, 0.8, 0.5)
        log.log_epoch(0, 0.9, 1.1)
        log.log_batch(1, 0, 0.7, 0.5)
        log.log_epoch(1, 0.7, 1.0)
    batches = W.read_metrics(spark, scratch, "batches")
    assert batches.count() == 3  # the second run replaced the first
    assert batches.where(F.col("loss") != F.col("pred_loss") + F.col("penalty_loss")).count() == 0
    assert W.read_metrics(spark, scratch, "epochs").count() == 2


def test_q19_unknown_pair_looks_up_null(spark):
    inter = spark.createDataFrame([(1, 1, 2.5)], "customer_int long, article_int long, weight double")
    pairs = spark.createDataFrame([(1, 1), (1, 9)], "customer_int long, article_int long")
    got = {(r.customer_int, r.article_int): r.weight for r in lookup_weights(pairs, inter).collect()}
    assert got == {(1, 1): 2.5, (1, 9): None}


def test_params_round_trip(spark, scratch):
    W.save_params(spark, scratch, "mf", "v1", {"lr": 0.03, "epochs": 20})
    assert W.load_params(spark, scratch, "mf", "v1") == {"epochs": 20, "lr": 0.03}


def test_interactions_from_csv_in_any_column_order(spark, scratch):
    p = f"{scratch}/train.csv"
    write_text(p, "weight,note,article_int,customer_int\n2.5,x,7,2\n1.0,y,3,1\n")
    df = RD.read_interactions(spark, p)
    assert df.dtypes == [("customer_int", "bigint"), ("article_int", "bigint"), ("weight", "double")]
    assert [tuple(r) for r in RD.read_interactions(spark, p, n_rows=1).collect()] == [(1, 3, 1.0)]


def test_derived_tables_from_csv_are_typed(spark, scratch):
    p = f"{scratch}/cuts.csv"
    write_text(p, "p50,article_int,days_since_last_purchase,shop\n3.5,7,4,x\n")
    df = RD.read_table(spark, p)
    assert dict(df.dtypes) == {"p50": "double", "article_int": "bigint", "days_since_last_purchase": "int", "shop": "string"}


def test_s12_starting_a_run_deletes_every_old_log(spark, scratch):
    log = W.MetricsLog(spark, scratch, "mf", "v1")
    log.log_batch(0, 0, 1.0, 0.5)
    log.log_epoch(0, 0.9, 1.1)
    log.log_param_changes(0, 0, spark.createDataFrame([("x", 1)], "parameter string, num_values_changed long"))
    other = W.MetricsLog(spark, scratch, "mf", "v2")
    other.log_epoch(0, 1.0, 1.0)
    W.MetricsLog(spark, scratch, "mf", "v1")
    assert W.read_metrics(spark, scratch, "epochs").count() == 1  # the other version's
    for kind in ("batches", "param_changes"):
        assert not __import__("os").path.exists(f"{scratch}/{kind}/model=mf/version=v1")


def test_s12_long_epochs_are_written_in_parts(spark, scratch):
    log = W.MetricsLog(spark, scratch, "mf", "v1")
    log.BUFFER = 3
    for b in range(7):
        log.log_batch(0, b, 1.0, 0.0)
    assert len(log._batches) == 1
    log.log_epoch(0, 1.0, 1.0)
    assert W.read_metrics(spark, scratch, "batches").count() == 7


def test_long_article_ids_stay_whole(spark):
    from affinity.sources.starschema import article_text_id

    df = spark.createDataFrame([(7,), (20000000000,), (20000000001,)], "k long")
    assert [r[0] for r in df.select(article_text_id(F.col("k"))).collect()] == ["0000000007", "20000000000", "20000000001"]


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_first_rows_are_selected_without_a_merge(spark, kind):
    import random

    rnd = random.Random(3)
    rows = [(rnd.choice([None, -5, 0, 7, 7, 7, 10**12, rnd.randint(0, 4000)]), rnd.choice([None, 1, 1, rnd.randint(-3, 9)]), float(i)) for i in range(500)]
    df = spark.createDataFrame(rows, "customer_int bigint, article_int bigint, weight double").repartition(7)
    df = df.withColumns({c: df[c].cast(kind) for c in ("customer_int", "article_int")})
    text = (lambda x: x) if kind == "bigint" else (lambda x: None if x is None else str(x))
    key = lambda r: tuple((x is not None, x) if x is not None else (False, 0 if kind == "bigint" else "") for x in r)
    ordered = sorted(((text(c), text(a)) for c, a, _ in rows), key=key)
    for n in (0, 1, 37, 38, 200, 201, 350, 499, 500, 600):
        got = RD.first_rows(df, n)
        assert sorted(((r[0], r[1]) for r in got.collect()), key=key) == ordered[:n]
        assert len({r.weight for r in got.collect()}) == min(n, 500)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrderedAndProject" not in plan
