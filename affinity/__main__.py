"""Command line for the three stages (run with ``spark-submit -m affinity`` or
``python -m affinity``): ``lookups``, ``prepare``, ``train``, ``score``.

All paths are Spark paths under ``--data`` (any shared file system). The session comes from
the launcher (master, resources, ``spark.checkpoint.dir``); nothing is read from or written to
the driver's local disk.
"""

from __future__ import annotations

import argparse
import json

from affinity.session import get_session
from affinity.sources import readers as RD
from affinity.sources.writers import read_weighted_interactions


def _lookups(spark, a) -> dict:
    from affinity.plans.prepare_job import prepare_lookups

    customers = RD.read_customers(spark, f"{a.data}/{a.customers}", a.format)
    articles = RD.read_articles(spark, f"{a.data}/{a.articles}", a.format)
    c, ar = prepare_lookups(customers, articles, a.data)
    return {"customer_ids": c, "article_ids": ar}


def _prepare(spark, a) -> dict:
    from affinity.plans.prepare_job import prepare_training_data

    tx = RD.read_transactions(spark, f"{a.data}/{a.transactions}", a.format, lenient_dates=a.lenient_dates)
    return prepare_training_data(
        spark, tx,
        spark.read.parquet(f"{a.data}/lookups/customer_ids"),
        spark.read.parquet(f"{a.data}/lookups/article_ids"),
        a.data,
        holdout_days=0 if a.submission else a.holdout_days,
        t_discount_strength=a.t_discount_strength,
        price_discount_strength=a.price_discount_strength,
        new_user_days=a.new_user_days,
        gap_mode=a.gap_mode,
        strengths=_strengths(a.strengths),
    )


def _strengths(text: str | None):
    """``"0:0,0.01:0,0.01:1"`` -> [(0.0, 0.0), (0.01, 0.0), (0.01, 1.0)]."""
    if not text:
        return None
    return [tuple(float(x) for x in pair.split(":")) for pair in text.split(",")]


def _train(spark, a) -> dict:
    from affinity.plans.train_job import train

    path = f"{a.data}/{a.train}"
    inter = RD.read_table(spark, path)
    if {"t_discount", "price_discount"} <= set(inter.columns):  # written by the prepare stage
        inter = read_weighted_interactions(spark, path, a.t_discount_strength, a.price_discount_strength)
    else:
        inter = RD.read_interactions(spark, path)
    model = train(
        spark, inter, a.out or a.data, a.model_name, a.model_version,
        num_latent_features=a.num_latent_features, l2_lambda=a.l2_lambda,
        learning_rate=a.learning_rate, batch_size=a.batch_size, epochs=a.epochs,
        validation_share=a.val_perc, seed=a.seed, source=path, n_rows=a.n_rows,
        init_scale=a.init_scale, batch_share=a.batch_share, max_exponent=a.max_exponent,
        log_param_changes=a.log_param_changes, resume=a.resume,
    )
    return {"steps": model.step, "history": model.history}


def _score(spark, a) -> dict:
    from affinity.plans.score_job import score_saved

    root = a.out or a.data
    return score_saved(
        spark, a.data, f"{root}/saved_models", a.model_name, a.model_version, a.epoch_number,
        f"{root}/predictions",
        holdout=a.holdout, history=a.purchase_history, cutoffs=a.purchase_cutoffs,
        percentile=a.purchase_cutoff_percentile, k=a.evaluation_k, sample_size=a.sample_size,
        seed=a.seed, with_metrics={"auto": None, "yes": True, "no": False}[a.metrics],
    )


def _number(kind, low=None, high=None):
    """An argument type with a closed range."""

    def parse(text: str):
        value = kind(text)
        if not ((low is None or value >= low) and (high is None or value <= high)):
            raise argparse.ArgumentTypeError(f"{value} is not between {low} and {high}")
        return value

    return parse


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="affinity")
    sub = p.add_subparsers(dest="stage", required=True)

    def common(s):
        s.add_argument("--data", required=True, help="base path of inputs and outputs")
        s.add_argument("--format", default="csv", help="format of the raw inputs")
        s.add_argument("--out", default=None, help="base path for models and predictions")
        s.add_argument("--seed", type=int, default=0)

    s = sub.add_parser("lookups", help="dense id maps for customers and articles")
    common(s)
    s.add_argument("--customers", default="customers.csv")
    s.add_argument("--articles", default="articles.csv")

    s = sub.add_parser("prepare", help="split, weights, cutoffs, recency, cohorts")
    common(s)
    s.add_argument("--transactions", default="transactions_train.csv")
    s.add_argument("--submission", action="store_true", help="no holdout (holdout days 0)")
    s.add_argument("--holdout-days", type=_number(int, 0), default=7)
    s.add_argument("--t-discount-strength", type=_number(float, 0.0), default=0.0)
    s.add_argument("--price-discount-strength", type=_number(float, 0.0, 1.0), default=0.0)
    s.add_argument("--new-user-days", type=_number(int, 0), default=7)
    s.add_argument("--gap-mode", default="nearest", choices=["nearest", "disc", "linear", "approx"])
    s.add_argument("--strengths", default=None,
                   help="several weight variants in one pass, e.g. 0:0,0.01:0,0.001:0,0.01:1,0.001:1")
    s.add_argument("--lenient-dates", action="store_true")

    s = sub.add_parser("train", help="fit the log-link factor model")
    common(s)
    s.add_argument("--model-name", required=True)
    s.add_argument("--model-version", required=True)
    s.add_argument("--train", default="dev/train", help="weights: the prepare stage's folder, or any Parquet or CSV table")
    s.add_argument("--t-discount-strength", type=_number(float, 0.0), default=0.0)
    s.add_argument("--price-discount-strength", type=_number(float, 0.0, 1.0), default=0.0)
    s.add_argument("--n-rows", type=_number(int, 0), default=None)
    s.add_argument("--val-perc", type=_number(float, 0.005, 0.1), default=0.05)
    s.add_argument("--num-latent-features", type=int, default=10)
    s.add_argument("--l2-lambda", type=float, default=0.02)
    s.add_argument("--learning-rate", type=float, default=0.001)
    s.add_argument("--batch-size", type=int, default=100_000)
    s.add_argument("--epochs", type=int, default=200)
    s.add_argument("--init-scale", type=float, default=1.0)
    s.add_argument("--batch-share", type=float, default=None, help="batch size as a share of the pairs")
    s.add_argument("--max-exponent", type=float, default=None, help="bound on the exponent (default: none)")
    s.add_argument("--log-param-changes", action="store_true")
    s.add_argument("--resume", action="store_true", help="continue from the newest complete snapshot")

    s = sub.add_parser("score", help="recommend, evaluate and write the submission")
    common(s)
    s.add_argument("--model-name", required=True)
    s.add_argument("--model-version", required=True)
    s.add_argument("--epoch-number", type=_number(int, 0), required=True)
    s.add_argument("--holdout", default="dev/holdout")
    s.add_argument("--purchase-history", default="dev/customer_days_since_last_purchase")
    s.add_argument("--purchase-cutoffs", default="dev/days_between_purchase")
    s.add_argument("--purchase-cutoff-percentile", default="p50",
                   choices=["p10", "p25", "p50", "p75", "p90"])
    s.add_argument("--evaluation-k", type=_number(int, 1), default=12)
    s.add_argument("--sample-size", type=_number(int, 1), default=1000)
    s.add_argument("--metrics", default="auto", choices=["auto", "yes", "no"],
                   help="AP and MAP@k: auto computes them if the holdout table lists purchases")
    return p


STAGES = {"lookups": _lookups, "prepare": _prepare, "train": _train, "score": _score}


def main(argv=None, spark=None) -> dict:
    a = parser().parse_args(argv)
    spark = spark or get_session(app_name=f"affinity-{a.stage}")
    result = STAGES[a.stage](spark, a)
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    main()
