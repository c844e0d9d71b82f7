"""Purchase tables derived from a TPC-H-like star schema (orders, lineitem, customer, part).

Mapping (one line item = one purchase):

- ``tx_part``: lineitem joined to orders; ``t_dat`` = order date, ``customer_int`` = o_custkey,
  ``article_int`` = l_partkey, ``price`` = l_extendedprice / l_quantity.
- ``tx_brand``: the same purchases with the article replaced by the dense id of the part's
  brand (few articles, many repeat purchases).
- ``customers`` / ``articles`` / ``transactions``: the raw, text-keyed layout the preparation
  stage starts from (customer_id text, article_id text, zero-padded to 10 characters).

Everything is a lazy join of the Parquet tables; column pruning and date filters reach the
scans.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.operators.bloom import maybe_in
from affinity.operators.ids import dense_ids
from affinity.session import staged
from affinity.sources import schemas as S

ARTICLE_ID_WIDTH = 10
PRICE_PARTS = ("l_extendedprice", "l_quantity")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders")
    return li.join(od, li["l_orderkey"] == od["o_orderkey"])


def tx_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _purchases(spark, sf_dir).select(
        F.col("o_orderdate").cast("date").alias(S.DATE),
        F.col("o_custkey").alias(S.CUSTOMER),
        F.col("l_partkey").alias(S.ARTICLE),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias(S.PRICE),
    )


def newest_purchase(spark: SparkSession, sf_dir: str) -> _dt.date | None:
    """A1 over ``tx_part`` without its join: the newest date of an order that has a line item.

    Only the orders of the last days are looked up among the line items, by a Bloom filter at the scan and an
    exact join; if none of them has one, those of ever more days, up to all orders."""
    od = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderdate").cast("date").alias(S.DATE))
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"))
    ends = od.agg(F.min(S.DATE).alias("first"), F.max(S.DATE).alias("last")).first()
    if ends["last"] is None:
        return None
    days, whole = 1, (ends["last"] - ends["first"]).days + 1
    while True:
        since = ends["last"] - _dt.timedelta(days=min(days, whole) - 1)
        recent = staged(od.where((F.col(S.DATE) >= F.lit(since)) & F.col("key").isNotNull()), "recent")
        found = maybe_in(li, recent, "key").join(recent, "key").agg(F.max(S.DATE)).first()[0]
        if found is not None or days >= whole:
            return found
        days *= 16


def brand_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense id per brand, in brand order."""
    return dense_ids(table(spark, sf_dir, "part"), "p_brand", "brand_int")


def tx_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    part_brand = part.join(brand_ids(spark, sf_dir), "p_brand")
    tx = tx_part(spark, sf_dir)
    return tx.join(part_brand, tx[S.ARTICLE] == part_brand["p_partkey"]).select(
        S.DATE, S.CUSTOMER, F.col("brand_int").alias(S.ARTICLE), S.PRICE
    )


def article_text_id(col) -> F.Column:
    """Zero-padded to ``ARTICLE_ID_WIDTH``; longer ids stay whole."""
    text = col.cast("string")
    return F.when(F.length(text) < ARTICLE_ID_WIDTH, F.lpad(text, ARTICLE_ID_WIDTH, "0")).otherwise(text)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("string").alias(S.CUSTOMER_ID), "c_name", "c_mktsegment")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(article_text_id(F.col("p_partkey")).alias(S.ARTICLE_ID), "p_name", "p_brand")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw purchases with text ids; ``l_orderkey`` and ``l_linenumber`` pass through."""
    return _purchases(spark, sf_dir).select(
        F.col("o_orderdate").cast("date").alias(S.DATE),
        F.col("o_custkey").cast("string").alias(S.CUSTOMER_ID),
        article_text_id(F.col("l_partkey")).alias(S.ARTICLE_ID),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias(S.PRICE),
        "l_orderkey",
        "l_linenumber",
    )


def order_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The two tables behind ``transactions``, with the key ``l_orderkey``: dates and customers, and line items
    (``PRICE_PARTS``, from which a purchase's price is taken once they are joined)."""
    od = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("date").alias(S.DATE),
        F.col("o_custkey").cast("string").alias(S.CUSTOMER_ID),
    )
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", article_text_id(F.col("l_partkey")).alias(S.ARTICLE_ID), *PRICE_PARTS
    )
    return od, li
