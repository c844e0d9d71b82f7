"""The prepare-all job (and S9 lookups).

The enriched transactions (the big join, C1) are written once, sorted by purchase date within
each file, and every other output branches from that table: the join runs once, lineage is
cut, and the time split prunes Parquet row groups by their date statistics.

Outputs under ``out/<area>/`` (``dev`` when holdout_days > 0, else ``submission``):
``transactions``, ``prices``, ``days_between_purchase``, ``customer_days_since_last_purchase``,
``train`` (weights, partitioned by the two strengths), ``train_new_users/first_n_days=N`` and,
with a holdout, ``holdout`` and ``holdout_new_users``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from affinity.operators import prepare as P
from affinity.operators.ids import dense_ids
from affinity.operators.quantiles import repeat_gap_quantiles
from affinity.sources import schemas as S
from affinity.sources.writers import (
    area,
    write_table,
    write_weighted_interaction_grid,
    write_weighted_interactions,
)

WEIGHTS_PER_TASK = 2_000_000  # weights of all variants that one task aggregates and sorts for the write


def prepare_lookups(customers: DataFrame, articles: DataFrame, out: str) -> tuple[str, str]:
    """P1/P2 + S9: dense id maps for customers and articles, written as tables."""
    c_path, a_path = f"{out}/lookups/customer_ids", f"{out}/lookups/article_ids"
    write_table(dense_ids(customers, S.CUSTOMER_ID, S.CUSTOMER), c_path)
    write_table(dense_ids(articles, S.ARTICLE_ID, S.ARTICLE), a_path)
    return c_path, a_path


def prepare_training_data(
    spark: SparkSession,
    transactions: DataFrame,
    customer_ids: DataFrame,
    article_ids: DataFrame,
    out: str,
    holdout_days: int = 7,
    t_discount_strength: float = 0.0,
    price_discount_strength: float = 0.0,
    new_user_days: int = 7,
    gap_mode: str = "nearest",
    strengths: list[tuple[float, float]] | None = None,
) -> dict[str, str]:
    """``strengths`` (a list of (t_discount, price_discount) pairs) writes every weight variant
    from one pass over train; otherwise the single pair of strength arguments is used."""
    root = f"{out}/{area(holdout_days)}"
    paths = {"transactions": f"{root}/transactions"}
    enriched = P.enrich_transactions(transactions, customer_ids, article_ids)
    # sorted by date inside each output file: Parquet row-group min/max statistics then prune
    # the time split, without one folder per day (tasks x days small files at scale)
    # the newest date and the number of rows are taken from the rows as they are written
    seen = Observation("purchases")
    ordered = enriched.sortWithinPartitions(S.DATE).observe(seen, F.max(S.DATE).alias("newest"), F.count("*").alias("n"))
    write_table(ordered, paths["transactions"])
    tx = spark.read.parquet(paths["transactions"])

    train, holdout = P.split_transactions(tx, holdout_days, newest=seen.get["newest"])
    paths["prices"] = f"{root}/prices"
    write_table(P.max_prices(train), paths["prices"])
    prices = spark.read.parquet(paths["prices"])

    paths["days_between_purchase"] = f"{root}/days_between_purchase"
    write_table(repeat_gap_quantiles(train, gap_mode), paths["days_between_purchase"])

    paths["customer_days_since_last_purchase"] = f"{root}/customer_days_since_last_purchase"
    write_table(P.days_since_last_purchase(train), paths["customer_days_since_last_purchase"])

    paths["train"] = f"{root}/train"
    if strengths:
        tasks = math.ceil(seen.get["n"] * len(strengths) / WEIGHTS_PER_TASK)
        dealt = tasks if tasks > spark.sparkContext.defaultParallelism else None
        grid = P.weighted_interaction_grid(train, strengths, prices, partitions=dealt)
        write_weighted_interaction_grid(grid, paths["train"], strengths)
    else:
        weights = P.weighted_interactions(train, t_discount_strength, price_discount_strength, prices)
        write_weighted_interactions(weights, paths["train"], t_discount_strength, price_discount_strength)

    paths["train_new_users"] = f"{root}/train_new_users/first_n_days={int(new_user_days)}"
    write_table(P.transactions_first_n_days(train, new_user_days), paths["train_new_users"])

    if int(holdout_days) > 0:
        paths["holdout"] = f"{root}/holdout"
        write_table(P.holdout_counts(holdout), paths["holdout"])
        paths["holdout_new_users"] = f"{root}/holdout_new_users"
        write_table(P.holdout_new_customer_transactions(train, holdout), paths["holdout_new_users"])
    return paths
