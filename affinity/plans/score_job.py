"""R6 job: batch scoring of every customer at once.

Inputs: the customers to score with their actual purchases (the holdout table, or any customer
table in submission mode), the purchase history and repeat-gap cutoffs from the prepare job,
a saved model epoch, and the id maps. Outputs: the recommendation lists, per-customer AP and
MAP@k when actuals exist (dev), and the submission table ``(customer_id, prediction)``.

There is no per-customer driver loop: one plan scores all customers (blocks of customers against
blocks of articles), suppression is a join computed before scoring, and the fallback
list for unmodelled customers is a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from affinity.operators.evaluation import average_precision, format_submission, mean_average_precision
from affinity.operators.factors import Model
from affinity.operators.scoring import excluded_articles, fallback_for, recommend
from affinity.sources import schemas as S
from affinity.sources.readers import read_table
from affinity.sources.writers import load_model, write_table


def score(
    spark: SparkSession,
    customers: DataFrame,
    history: DataFrame,
    cutoffs: DataFrame,
    model: Model,
    customer_map: DataFrame,
    article_map: DataFrame,
    out: str,
    run: str,
    percentile: str = "p50",
    k: int = 12,
    sample_size: int = 1000,
    seed: int = 0,
    with_metrics: bool | None = None,
) -> dict:
    """``with_metrics`` None: AP and MAP@k are computed if ``customers`` has the article column, that
    is if it lists purchases. Results go to ``out/dev/<run>`` with metrics, else to
    ``out/submission/<run>``, so neither kind of run overwrites the other's."""
    if int(k) < 1 or int(sample_size) < 1:
        raise ValueError("k and sample_size must be positive")
    if with_metrics is None:
        with_metrics = S.ARTICLE in customers.columns
    out = f"{out}/{'dev' if with_metrics else 'submission'}/{run}"
    excl = excluded_articles(history, cutoffs, percentile, model.articles)
    fb = fallback_for(model.customers, model.articles, model.intercept, model.k, k, sample_size, seed)
    recs = recommend(customers, model.customers, model.articles, model.intercept, model.k, k, excl, fb)
    write_table(recs, f"{out}/recommendations")
    recs = spark.read.parquet(f"{out}/recommendations")
    result = {"recommendations": f"{out}/recommendations"}
    if with_metrics:
        apks = average_precision(recs, customers, k)
        write_table(apks, f"{out}/holdout_apks")
        row = mean_average_precision(spark.read.parquet(f"{out}/holdout_apks")).first()
        result.update(
            {"map": row["map"], "n_customers": row["n_customers"], "holdout_apks": f"{out}/holdout_apks"}
        )
    write_table(format_submission(recs, customer_map, article_map), f"{out}/submission", fmt="csv")
    result["submission"] = f"{out}/submission"
    return result


def score_saved(
    spark: SparkSession,
    data: str,
    models: str,
    model_name: str,
    model_version: str,
    epoch: int,
    out: str,
    holdout: str = "dev/holdout",
    history: str = "dev/customer_days_since_last_purchase",
    cutoffs: str = "dev/days_between_purchase",
    **kw,
) -> dict:
    """Read the tables (Parquet, or CSV by the path's ending) and a saved epoch, then score (paths
    relative to data)."""
    if int(epoch) < 0:
        raise ValueError("the epoch number must not be negative")
    model, _ = load_model(spark, models, model_name, model_version, epoch)

    def read(name: str) -> DataFrame:
        return read_table(spark, f"{data}/{name}")

    return score(
        spark, read(holdout), read(history), read(cutoffs),
        model, read("lookups/customer_ids"), read("lookups/article_ids"),
        out, f"{model_name}__{model_version}", **kw,
    )
