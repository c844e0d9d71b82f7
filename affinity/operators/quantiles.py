"""Per-group quantiles (A5) and the repeat-purchase cutoff table.

Modes:

- ``nearest`` (default): the value at 0-based rank ``floor(q * (n - 1) + 0.5)`` of the sorted
  values. Built as a (group, value) histogram -> running count per group -> first value whose
  running count passes the rank. A group's histogram has one row per distinct value (for day
  gaps: at most the number of days covered), so no group is ever gathered as a list, however
  many rows it has.
- ``disc``: SQL ``percentile_disc`` (first value whose cumulative share reaches q), from the same
  histogram.
- ``linear``: ``percentile`` (linear interpolation between closest ranks), one call for all levels.
- ``approx``: ``percentile_approx`` (bounded-memory sketch), one call for all levels.

Spark's exact percentile aggregate keeps a value -> frequency map per group and merges partial
maps, so it too is bounded by the number of distinct values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.operators.prepare import repeat_purchase_gaps
from affinity.sources import schemas as S

# Quantile levels and column names of the cutoff table.
LEVELS = (0.10, 0.25, 0.50, 0.75, 0.90)
NAMES = ("p10", "p25", "p50", "p75", "p90")
MODES = ("nearest", "disc", "linear", "approx")


def group_quantiles(
    df: DataFrame,
    group: str,
    value: str,
    levels=LEVELS,
    names=NAMES,
    mode: str = "nearest",
    approx_accuracy: int = 10000,
) -> DataFrame:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if any(not 0.0 <= float(q) <= 1.0 for q in levels):
        raise ValueError("levels must be between 0 and 1")
    v = F.col(value)
    if mode in ("linear", "approx"):  # one aggregate (one buffer) for all levels
        wanted = [float(q) for q in levels]
        if mode == "linear":
            all_levels = F.percentile(v, F.array(*[F.lit(q) for q in wanted]))
        else:
            all_levels = F.percentile_approx(v, wanted, approx_accuracy)
        out = df.where(v.isNotNull()).groupBy(group).agg(all_levels.alias("_q"))
        return out.select(group, *[F.col("_q")[i].cast("double").alias(n) for i, n in enumerate(names)])

    hist = df.where(v.isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("_c"))
    running = Window.partitionBy(group).orderBy(value).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    hist = hist.withColumns(
        {"_cum": F.sum("_c").over(running), "_n": F.sum("_c").over(Window.partitionBy(group))}
    )
    aggs = []
    for q, n in zip(levels, names):
        if mode == "disc":  # the smallest value whose cumulative share reaches the level
            reached = F.col("_cum") >= F.lit(float(q)) * F.col("_n") - F.lit(1e-9)
        else:
            reached = F.col("_cum") > F.floor(F.lit(float(q)) * (F.col("_n") - 1) + F.lit(0.5))
        aggs.append(F.min(F.when(reached, v)).cast("double").alias(n))
    return hist.groupBy(group).agg(*aggs)


def repeat_gap_quantiles(
    train: DataFrame,
    mode: str = "nearest",
    customer: str = S.CUSTOMER,
    article: str = S.ARTICLE,
    date_col: str = S.DATE,
) -> DataFrame:
    """Quantiles of the days between repeat purchases, per article.

    Only articles with at least one positive gap appear.
    """
    gaps = repeat_purchase_gaps(train, customer, article, date_col, out="_gap")
    return group_quantiles(gaps, article, "_gap", mode=mode)
