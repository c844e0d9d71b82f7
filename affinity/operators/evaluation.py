"""Evaluation and output formatting.

Two forms of AP@k:

- ``with_average_precision``: a column over (actual list, predicted list) pairs (Y3), with the
  higher-order-function expression of Y1;
- ``average_precision``: the same number computed by joins, for the batch scoring job. It
  never gathers a customer's purchases into one list: predictions (at most k per customer)
  are exploded and matched against the distinct holdout pairs, and only the count of actual
  purchases per customer is needed for the denominator. A customer holding a third of all
  holdout rows therefore costs one grouped count, not one giant array.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.functions.ranking import average_precision as ap_expr
from affinity.functions.ranking import joined_ids
from affinity.sources import schemas as S


def actuals(holdout: DataFrame, customer: str = S.CUSTOMER, article: str = S.ARTICLE) -> DataFrame:
    """Each customer's holdout purchases as a sorted list (duplicates kept).

    Rows are first counted per (customer, article) map-side, so the grouped list is built
    from at most one entry per distinct article of the customer and expanded afterwards.
    """
    pairs = holdout.groupBy(customer, article).agg(F.count(F.lit(1)).cast("int").alias("_n"))
    grouped = pairs.groupBy(customer).agg(
        F.sort_array(F.collect_list(F.struct(F.col(article).alias("a"), F.col("_n").alias("n")))).alias("_l")
    )
    expanded = F.flatten(F.transform(F.col("_l"), lambda x: F.array_repeat(x["a"], x["n"])))
    return grouped.select(customer, expanded.alias("actuals"))


def with_average_precision(
    df: DataFrame, k: int, actual: str = "actuals", predicted: str = "recommendations", out: str = "apk"
) -> DataFrame:
    """Add AP@k of the two list columns."""
    return df.withColumn(out, ap_expr(F.col(actual), F.col(predicted), k))


def average_precision(
    recommendations: DataFrame,
    holdout: DataFrame,
    k: int,
    customer: str = S.CUSTOMER,
    article: str = S.ARTICLE,
    predicted: str = "recommendations",
) -> DataFrame:
    """Y1/Y2 by joins: AP@k per holdout customer (0.0 when nothing was recommended)."""
    k = int(k)
    preds = recommendations.select(
        customer, F.posexplode(F.slice(F.col(predicted), 1, k)).alias("_pos", article)
    )
    # a repeated prediction never scores twice: keep its first position only
    first = preds.groupBy(customer, article).agg((F.min("_pos") + 1).alias("_pos"))
    bought = holdout.select(customer, article).distinct().withColumn("_hit", F.lit(1))
    marked = first.join(bought, [customer, article], "left").withColumn(
        "_hit", F.coalesce(F.col("_hit"), F.lit(0))
    )
    running = Window.partitionBy(customer).orderBy("_pos").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    marked = marked.withColumn("_cum", F.sum("_hit").over(running))
    gain = F.when(F.col("_hit") == 1, F.col("_cum") / F.col("_pos")).otherwise(F.lit(0.0))
    scores = marked.groupBy(customer).agg(F.sum(gain).alias("_s"))
    n_actual = holdout.groupBy(customer).agg(F.count(F.lit(1)).alias("_n"))
    apk = F.coalesce(F.col("_s"), F.lit(0.0)) / F.least(F.col("_n"), F.lit(k)).cast("double")
    return n_actual.join(scores, customer, "left").select(customer, apk.alias("apk"))


def mean_average_precision(apks: DataFrame, col: str = "apk") -> DataFrame:
    """A10: mean of AP over customers (one row)."""
    return apks.agg(F.avg(col).alias("map"), F.count(F.lit(1)).alias("n_customers"))


def format_submission(
    recommendations: DataFrame,
    customer_map: DataFrame,
    article_map: DataFrame,
    customer: str = S.CUSTOMER,
    article: str = S.ARTICLE,
    customer_id: str = S.CUSTOMER_ID,
    article_id: str = S.ARTICLE_ID,
    predicted: str = "recommendations",
) -> DataFrame:
    """R7 (J9, X11): (customer_id, prediction) with the article ids space-joined in rank order.

    Lists are exploded with their position, decoded by a left join to the article map and
    re-collected in position order (at most N items per customer), so the recommendations are
    computed once and every customer keeps a row, also with an empty list. An article or
    customer without a mapping stops the query with its id.
    """
    exploded = recommendations.select(customer, F.posexplode_outer(predicted).alias("_pos", article))

    def mapped(value, key, what):
        missing = F.raise_error(F.concat(F.lit(f"{what} without an id: "), F.col(key).cast("string")))
        return F.when(F.col(key).isNull() | F.col(value).isNotNull(), F.col(value)).otherwise(missing)

    decoded = exploded.join(article_map.select(article, article_id), article, "left").select(
        customer, "_pos", mapped(article_id, article, "article").alias("_id")
    )
    lists = decoded.groupBy(customer).agg(
        F.sort_array(F.collect_list(F.when(F.col("_pos").isNotNull(), F.struct("_pos", "_id")))).alias("_l")
    )
    text = joined_ids(F.transform(F.col("_l"), lambda x: x["_id"]))
    out = lists.join(customer_map.select(customer, customer_id), customer, "left")
    return out.select(mapped(customer_id, customer, "customer").alias(customer_id), text.alias("prediction"))
