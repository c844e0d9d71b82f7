"""Transaction preparation (C1-C6 with F1-F5, J1-J4, A1-A4, A6, W1-W3).

All functions are ``DataFrame -> DataFrame`` and lazy, except ``max_date`` which returns one
value to the driver (a one-row aggregate) so that the time split filters on a literal and the
bound reaches the Parquet scan as a pushed filter, and the two that compare customers of holdout and
train, which write the holdout's customers first.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.functions.dates import days_between
from affinity.functions.weights import (
    combined_weight,
    positive_weight,
    price_ratio,
    price_weight,
    time_weight,
)
from affinity.operators.bloom import maybe_in
from affinity.session import staged
from affinity.sources import schemas as S


def enrich_transactions(
    transactions: DataFrame,
    customer_ids: DataFrame,
    article_ids: DataFrame,
    customer_key: str = S.CUSTOMER_ID,
    article_key: str = S.ARTICLE_ID,
    customer: str = S.CUSTOMER,
    article: str = S.ARTICLE,
    lines: DataFrame | None = None,
    on: str | None = None,
) -> DataFrame:
    """C1 (J1, J2, P4): swap text ids for surrogate ids; rows with unknown ids drop out.

    A map whose bytes lie under the session's broadcast threshold is broadcast, so the
    transactions (the largest table) are not shuffled; beyond it the join shuffles, and AQE
    splits a hot customer's partition.

    Transactions kept as two tables, ``transactions`` with the customers and ``lines`` with the articles,
    both with the key ``on``, are joined after each has swapped its own id: the text ids of an order's
    customer are then shuffled once an order and not once a line. The rows are those of the joined tables.
    """
    if lines is None:
        rows = transactions.join(customer_ids.select(customer_key, customer), customer_key)
        return rows.join(article_ids.select(article_key, article), article_key).drop(customer_key, article_key)
    heads = transactions.join(customer_ids.select(customer_key, customer), customer_key).drop(customer_key)
    items = lines.join(article_ids.select(article_key, article), article_key).drop(article_key)
    return heads.join(items, on)


def max_date(tx: DataFrame, date_col: str = S.DATE) -> _dt.date | None:
    """A1: newest date (one-row aggregate, map-side partial max)."""
    return tx.agg(F.max(date_col).alias("m")).first()["m"]


def max_date_column(tx: DataFrame, date_col: str = S.DATE) -> Column:
    """Newest date as a scalar subquery (evaluated once, used as a literal per row)."""
    return tx.agg(F.max(date_col)).scalar()


def split_transactions(
    tx: DataFrame, holdout_days: int, date_col: str = S.DATE, newest: _dt.date | None = None
) -> tuple[DataFrame, DataFrame]:
    """F1 (A1, X3): train = date <= newest - N days, holdout = date > newest - N days."""
    if int(holdout_days) < 0:
        raise ValueError("holdout_days must not be negative")
    if newest is None:
        newest = max_date(tx, date_col)
    if newest is None:
        return tx, tx.limit(0)
    cut = newest - _dt.timedelta(days=int(holdout_days))
    d = F.col(date_col)
    return tx.filter(d <= F.lit(cut)), tx.filter(d > F.lit(cut))


def max_prices(
    train: DataFrame, article: str = S.ARTICLE, price: str = S.PRICE, out: str = "max_price"
) -> DataFrame:
    """A2: canonical price = highest price per article, NaN prices ignored."""
    p = F.col(price)
    return train.groupBy(article).agg(F.max(F.when(~F.isnan(p), p)).alias(out))


def _check_strengths(t_discount: float, price_discount: float) -> None:
    if not t_discount >= 0.0:
        raise ValueError(f"t_discount_strength must not be negative: {t_discount}")
    if not 0.0 <= price_discount <= 1.0:
        raise ValueError(f"price_discount_strength must be between 0 and 1: {price_discount}")


def _priced(train, prices, customer, article, date_col, price):
    """Purchase rows with their article's ``max_price``, and the newest train date.

    Without ``prices`` one pass over train gives each article's canonical price and last date,
    and the newest date is the max over that per-article table.
    """
    if prices is None:
        p = F.col(price)
        stats = train.groupBy(article).agg(
            F.max(F.when(~F.isnan(p), p)).alias("max_price"), F.max(date_col).alias("_last")
        )
        newest = stats.agg(F.max("_last")).scalar()
        prices = stats
    else:
        newest = max_date_column(train, date_col)
    rows = train.select(customer, article, date_col, price)
    return rows.join(prices.select(article, "max_price"), article, "left"), newest


def weighted_interactions(
    train: DataFrame,
    t_discount_strength: float = 0.0,
    price_discount_strength: float = 0.0,
    prices: DataFrame | None = None,
    customer: str = S.CUSTOMER,
    article: str = S.ARTICLE,
    date_col: str = S.DATE,
    price: str = S.PRICE,
    weight: str = S.WEIGHT,
) -> DataFrame:
    """One row per (customer, article) with the summed decayed, price-discounted weight.

    ``prices`` (article, max_price) defaults to A2 over ``train``: one row per article, joined as
    AQE finds best. The decay is measured from the newest train date. Pairs whose summed weight is
    not > 0 are dropped. Strengths outside their range (decay >= 0, price 0 to 1) are an error.

    A strength of 0 needs neither canonical prices nor the newest date: no further pass over
    ``train`` and no join. A purchase without price or date still adds nothing.
    """
    _check_strengths(t_discount_strength, price_discount_strength)
    p, day = F.col(price), F.col(date_col)
    if prices is None and price_discount_strength == 0.0:
        rows = train.select(customer, article, date_col, price)
        newest = max_date_column(train, date_col) if t_discount_strength else day
        # of any number 1, as ratio * 0 + 1; an infinite price has no ratio and gives NaN
        by_price = price_weight(F.when(F.isnan(p), F.lit(1.0)).otherwise(p), 0.0)
    else:
        rows, newest = _priced(train, prices, customer, article, date_col, price)
        newest = newest if t_discount_strength else day
        by_price = price_weight(price_ratio(p, F.col("max_price")), price_discount_strength)
    w = combined_weight(by_price, time_weight(days_between(newest, day), t_discount_strength))
    return (
        rows.groupBy(customer, article)
        .agg(F.sum(w).alias(weight))
        .filter(positive_weight(F.col(weight)))
    )


def weighted_interaction_grid(
    train: DataFrame,
    strengths: list[tuple[float, float]],
    prices: DataFrame | None = None,
    customer: str = S.CUSTOMER,
    article: str = S.ARTICLE,
    date_col: str = S.DATE,
    price: str = S.PRICE,
    weight: str = S.WEIGHT,
    partitions: int | None = None,
) -> DataFrame:
    """C2 for several (t_discount_strength, price_discount_strength) pairs in one pass.

    One (customer, article) aggregation computes a sum per pair of strengths (map-side partial
    sums, a single shuffle), then the sums are unpivoted into rows
    ``t_discount, price_discount, customer, article, weight`` and non-positive weights dropped.
    Equal to calling ``weighted_interactions`` once per pair, with one scan instead of many.

    ``partitions`` deals the pairs to that many tasks or more, for callers that know the size of ``train``:
    what a task holds is then bounded whatever the session's number of shuffle partitions.
    """
    if not strengths:
        raise ValueError("strengths must not be empty")
    for pair in strengths:
        _check_strengths(*pair)
    rows, newest = _priced(train, prices, customer, article, date_col, price)
    ratio = price_ratio(F.col(price), F.col("max_price"))
    days = days_between(newest, F.col(date_col))
    sums = [
        F.sum(combined_weight(price_weight(ratio, s), time_weight(days, k))).alias(f"_w{i}")
        for i, (k, s) in enumerate(strengths)
    ]
    if partitions:
        rows = rows.repartition(int(partitions), customer, article)
    wide = rows.groupBy(customer, article).agg(*sums)
    variants = F.array(
        *[
            F.struct(
                F.lit(float(k)).alias("t_discount"),
                F.lit(float(s)).alias("price_discount"),
                F.col(f"_w{i}").alias(weight),
            )
            for i, (k, s) in enumerate(strengths)
        ]
    )
    long = wide.select(customer, article, F.explode(variants).alias("_v"))
    return long.select(
        "_v.t_discount", "_v.price_discount", customer, article, F.col(f"_v.{weight}").alias(weight)
    ).filter(positive_weight(F.col(weight)))


def holdout_counts(
    holdout: DataFrame, customer: str = S.CUSTOMER, article: str = S.ARTICLE
) -> DataFrame:
    """A4: purchases per (customer, article) in the holdout."""
    return holdout.groupBy(customer, article).agg(F.count(F.lit(1)).alias("count"))


def repeat_purchase_gaps(
    train: DataFrame,
    customer: str = S.CUSTOMER,
    article: str = S.ARTICLE,
    date_col: str = S.DATE,
    out: str = "days_since_last_purchase",
) -> DataFrame:
    """Positive day gaps between consecutive purchases of the same pair.

    Rows on the same day as the previous purchase give gap 0 and are dropped, so the positive
    gaps are exactly those between consecutive *distinct* purchase dates of a pair. Dates are
    therefore de-duplicated first (map-side), which bounds every window partition by the
    number of days covered, however many rows a hot pair has.
    """
    days = train.select(customer, article, date_col).distinct()
    prev = F.lag(date_col).over(Window.partitionBy(customer, article).orderBy(date_col))
    return (
        days.withColumn("_prev", prev)
        .filter(F.col("_prev").isNotNull())
        .select(customer, article, days_between(F.col(date_col), F.col("_prev")).alias(out))
        .filter(F.col(out) > 0)
    )


def days_since_last_purchase(
    train: DataFrame,
    customer: str = S.CUSTOMER,
    article: str = S.ARTICLE,
    date_col: str = S.DATE,
    out: str = "days_since_last_purchase",
) -> DataFrame:
    """C4 (A6, W3): days from each pair's last purchase to the newest date in train."""
    last = train.groupBy(customer, article).agg(F.max(date_col).alias("_last"))
    # the newest date of train is that of the per-pair maxima: no second scan (the plan reuses
    # the aggregation's exchange)
    newest = last.agg(F.max("_last")).scalar()
    return last.select(customer, article, days_between(newest, F.col("_last")).alias(out))


def transactions_first_n_days(
    train: DataFrame,
    first_n_days: int,
    customer: str = S.CUSTOMER,
    date_col: str = S.DATE,
) -> DataFrame:
    """C5 (W2, X2, F5): each customer's purchases in their first N days.

    First purchase = earliest date of the customer. It is computed as a grouped min (partial
    aggregation, skew-safe) and joined back, instead of a window over all of a customer's
    rows, so a hot customer never has to sit in one window partition; AQE broadcasts the
    per-customer table if its run-time size allows and else splits hot customers. Keeps
    ``t_dat_first`` and ``days_since_first_t``.
    """
    if int(first_n_days) < 0:
        raise ValueError("first_n_days must not be negative")
    first = train.groupBy(customer).agg(F.min(date_col).alias("t_dat_first"))
    return (
        train.join(first, customer)
        .withColumn("days_since_first_t", days_between(F.col(date_col), F.col("t_dat_first")))
        .filter(F.col("days_since_first_t") < int(first_n_days))
    )


def holdout_new_customer_transactions(
    train: DataFrame, holdout: DataFrame, customer: str = S.CUSTOMER
) -> DataFrame:
    """C6 (J4): holdout rows of customers never seen in train (left anti join).

    The holdout is short: a Bloom filter of its customers reduces train at the scan, the exact joins follow.
    """
    seen = known_customers(train, holdout, customer)
    return holdout.join(seen, customer, "left_anti")


def known_customers(
    modelled: DataFrame, holdout: DataFrame, customer: str = S.CUSTOMER
) -> DataFrame:
    """Distinct non-null customers present in both tables. The holdout's customers are written once;
    what a Bloom filter of them leaves of the other table is made distinct and joined exactly."""
    wanted = staged(holdout.select(customer).where(F.col(customer).isNotNull()).distinct(), "customers")
    rest = maybe_in(modelled.select(customer).where(F.col(customer).isNotNull()), wanted, customer).distinct()
    return wanted.join(rest, customer, "left_semi")
