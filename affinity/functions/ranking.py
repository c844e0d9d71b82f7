"""Ranked-list expressions (Y1, Y5, X11), evaluated JVM-side with higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def top_k(predicted: Column, k: int) -> Column:
    """First k elements of a list."""
    return F.slice(predicted, 1, int(k))


def average_precision(actual: Column, predicted: Column, k: int = 10) -> Column:
    """AP@k of one (actual, predicted) pair of lists.

    Predictions are cut at k. Position i (1-based) is a hit when its element is in ``actual``
    and does not occur earlier in the predictions; each hit adds hits_so_far / i. The sum is
    divided by min(len(actual), k); duplicates in ``actual`` count in that length. An empty or
    missing ``actual`` gives 0.0.
    """
    k = int(k)
    pred = top_k(predicted, k)
    indexed = F.transform(pred, lambda x, i: F.struct(x.alias("v"), (i + 1).alias("pos")))
    init = F.struct(F.lit(0.0).alias("hits"), F.lit(0.0).alias("score"))

    def step(acc, e):
        hit = F.coalesce(
            F.array_contains(actual, e["v"]) & (F.array_position(pred, e["v"]) == e["pos"]),
            F.lit(False),
        )
        hits = acc["hits"] + F.when(hit, 1.0).otherwise(0.0)
        gain = F.when(hit, hits / e["pos"]).otherwise(0.0)
        return F.struct(hits.alias("hits"), (acc["score"] + gain).alias("score"))

    total = F.aggregate(indexed, init, step)["score"]
    n_actual = F.size(actual)
    return (
        F.when(actual.isNull() | (n_actual <= 0), F.lit(0.0))
        .otherwise(total / F.least(n_actual, F.lit(k)).cast("double"))
    )


def joined_ids(ids: Column, sep: str = " ") -> Column:
    """X11: list of ids -> one space-separated string, order kept."""
    return F.array_join(F.transform(ids, lambda x: x.cast("string")), sep)
