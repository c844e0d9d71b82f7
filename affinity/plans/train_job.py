"""M4 job: fit the log-link factor model on a weights table with metrics (S12), run
parameters (S13) and snapshots every ``snapshot_every`` epochs and at the last epoch (S13).

The loop itself is a driver loop of Spark jobs (``factors.fit_log_link_factors``); the state
that survives between steps lives in parameter tables written to the shared checkpoint folder,
not on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from affinity.operators.factors import (
    Model,
    fit_log_link_factors,
    model_changes,
)
from affinity.operators.ids import interaction_counts
from affinity.sources.readers import first_rows
from affinity.sources.writers import MetricsLog, complete_epochs, load_model, save_model, save_params


def train(
    spark: SparkSession,
    interactions: DataFrame,
    out: str,
    model_name: str,
    model_version: str,
    num_latent_features: int = 10,
    l2_lambda: float = 0.02,
    learning_rate: float = 0.001,
    batch_size: int = 100_000,
    epochs: int = 200,
    validation_share: float = 0.05,
    seed: int = 0,
    snapshot_every: int = 10,
    log_param_changes: bool = False,
    source: str | None = None,
    n_rows: int | None = None,
    init_scale: float = 1.0,
    batch_share: float | None = None,
    max_exponent: float | None = None,
    resume: bool = False,
) -> Model:
    """``resume`` continues from the newest complete snapshot of this model and version, if there is one:
    its parameters, moments and counters are read back, later log rows are dropped, and the epochs that
    are left run as they would have without the interruption.

    ``n_rows`` trains on the first rows only (T3); ``log_param_changes`` writes, per batch, how
    many values of each parameter moved (a join of two views of the fit's store per batch)."""
    if n_rows is not None:
        interactions = first_rows(interactions, n_rows)
    models = f"{out}/saved_models"
    done = complete_epochs(spark, models, model_name, model_version) if resume else []
    start = load_model(spark, models, model_name, model_version, done[-1])[0] if done else None
    log = MetricsLog(spark, f"{out}/training_logs", model_name, model_version, done[-1] if done else None)
    save_params(
        spark, models, model_name, model_version,
        {
            "train_source": source, "train_n_rows": n_rows,
            **interaction_counts(interactions).select("num_customers", "num_articles").first().asDict(),
            "num_latent_features": num_latent_features, "l2_lambda": l2_lambda,
            "learning_rate": learning_rate, "batch_size": batch_size, "batch_share": batch_share,
            "epochs": epochs, "validation_share": validation_share, "seed": seed,
            "init_scale": init_scale, "max_exponent": max_exponent,
        },
    )
    previous: dict[str, Model] = {}

    def on_batch(epoch, batch, metrics, model):
        log.log_batch(epoch, batch, metrics["pred_loss"], metrics["penalty_loss"])
        if log_param_changes:  # the view of the last batch stays readable while this one is compared
            now = model()
            if "m" in previous:
                log.log_param_changes(epoch, batch, model_changes(previous["m"], now))
            previous["m"] = now

    def on_epoch(epoch, train_pred, val_pred, model):
        log.log_epoch(epoch, train_pred, val_pred)
        if (epoch + 1) % snapshot_every == 0 or epoch == epochs - 1:
            save_model(model, models, model_name, model_version, epoch,
                       train_loss=train_pred, val_loss=val_pred)

    model = fit_log_link_factors(
        interactions, k=num_latent_features, l2=l2_lambda, lr=learning_rate, epochs=epochs,
        batch_size=batch_size, validation_share=validation_share, seed=seed,
        init_scale=init_scale, batch_share=batch_share, max_exponent=max_exponent,
        on_batch=on_batch, on_epoch=on_epoch, start=start, first_epoch=done[-1] + 1 if done else 0,
        batch_models=log_param_changes,
    )
    return model
