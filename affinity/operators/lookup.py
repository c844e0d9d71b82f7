"""Pair lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame

from affinity.sources import schemas as S


def lookup_weights(
    pairs: DataFrame, interactions: DataFrame,
    customer: str = S.CUSTOMER, article: str = S.ARTICLE, weight: str = S.WEIGHT,
) -> DataFrame:
    """weight of each requested (customer, article) pair; NULL when the pair is unknown.

    One left join on both keys for any number of pairs (never one query per pair).
    """
    return pairs.join(interactions.select(customer, article, weight), [customer, article], "left")
