import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="affinity-tests-")
    s = (
        SparkSession.builder.master("local[*]")
        .appName("affinity-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoints"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


# E1 base table: (row, t_dat, customer_id, article_id, price)
E1_ROWS = [
    (1, "2020-09-01", "A", "0101", 10.0),
    (2, "2020-09-01", "A", "0101", 10.0),
    (3, "2020-09-05", "A", "0101", 8.0),
    (4, "2020-09-03", "B", "0101", 5.0),
    (5, "2020-09-08", "B", "0202", 4.0),
    (6, "2020-09-10", "A", "0202", 4.0),
    (7, "2020-09-20", "C", "0101", 10.0),
    (8, "2020-09-21", "A", "0202", 2.0),
    (9, "2020-09-21", "Z", "0101", 9.0),
    (10, "2020-09-22", "A", "9999", 1.0),
]


@pytest.fixture(scope="session")
def e1(spark):
    """E1 as (transactions, customers, articles); transactions keep the row number."""
    tx = spark.createDataFrame(
        [(r, d(t), c, a, p) for r, t, c, a, p in E1_ROWS],
        "row int, t_dat date, customer_id string, article_id string, price double",
    )
    customers = spark.createDataFrame([(c,) for c in "ABCD"], "customer_id string")
    articles = spark.createDataFrame([("0101",), ("0202",), ("0303",)], "article_id string")
    return tx, customers, articles


@pytest.fixture(scope="session")
def e1_enriched(spark, e1):
    from affinity.operators.ids import dense_ids
    from affinity.operators.prepare import enrich_transactions

    tx, customers, articles = e1
    cmap = dense_ids(customers, "customer_id", "customer_int")
    amap = dense_ids(articles, "article_id", "article_int")
    return enrich_transactions(tx, cmap, amap).persist()
