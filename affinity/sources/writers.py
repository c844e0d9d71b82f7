"""Sinks (S6-S9, S11-S13).

Executors write their partitions directly to the target folder; nothing is gathered on the
driver, and no output is squeezed into one file (``coalesce(1)`` is used only for one-row
parameter records). All paths are plain Spark paths, so any shared file system works.
"""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.operators.factors import Model
from affinity.session import staged
from affinity.sources import schemas as S


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by=None
) -> None:
    """Write a derived table; CSV gets a header line."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.save(path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder if it exists (through the file system of its path)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def strength_label(x: float) -> str:
    """Parameter value as a folder-safe label (``0.01`` -> ``0-01``)."""
    return str(float(x)).replace(".", "-")


def area(holdout_days: int) -> str:
    """Dev area when a holdout exists, submission area otherwise."""
    return "dev" if int(holdout_days) > 0 else "submission"


def write_weighted_interactions(
    df: DataFrame, base: str, t_discount_strength: float, price_discount_strength: float
) -> None:
    """Weights partitioned by their two parameters (Hive-style folders).

    Dynamic partition overwrite replaces only the folder of this parameter pair, so runs
    with other parameters stay.
    """
    out = df.withColumns(
        {
            "t_discount": F.lit(strength_label(t_discount_strength)),
            "price_discount": F.lit(strength_label(price_discount_strength)),
        }
    )
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("t_discount", "price_discount")
        .parquet(base)
    )


def write_weighted_interaction_grid(
    df: DataFrame, base: str, strengths: list[tuple[float, float]]
) -> None:
    """S7 for a grid of strengths in one write: the numeric ``t_discount`` / ``price_discount``
    columns become the same folder labels a single-variant write uses (X10)."""

    def labelled(col: str, values) -> F.Column:
        expr = F.lit(None).cast("string")
        for v in sorted(set(float(x) for x in values)):
            expr = F.when(F.col(col) == F.lit(v), F.lit(strength_label(v))).otherwise(expr)
        return expr

    out = df.withColumns(
        {
            "t_discount": labelled("t_discount", [k for k, _ in strengths]),
            "price_discount": labelled("price_discount", [s for _, s in strengths]),
        }
    )
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("t_discount", "price_discount")
        .parquet(base)
    )


def read_weighted_interactions(
    spark: SparkSession, base: str, t_discount_strength: float, price_discount_strength: float
) -> DataFrame:
    """Read one parameter pair back; the partition filter prunes the other folders."""
    df = spark.read.parquet(base)
    return df.where(
        (F.col("t_discount") == strength_label(t_discount_strength))
        & (F.col("price_discount") == strength_label(price_discount_strength))
    ).drop("t_discount", "price_discount")


# --------------------------------------------------------------------------------------------
# S12 training metrics


class MetricsLog:
    """Append-only batch / epoch / parameter-change tables under ``base/<kind>/model=/version=``.

    Starting a run deletes every log of that model and version; continuing one (``after_epoch``) keeps
    the rows up to that epoch and drops those of epochs that will run again. Batch rows are buffered on
    the driver and written once per epoch, or every ``BUFFER`` rows in a long epoch.
    """

    KINDS = ("batches", "epochs", "param_changes")
    BUFFER = 1000

    def __init__(self, spark: SparkSession, base: str, model: str, version: str, after_epoch: int | None = None):
        self.spark, self.base, self.model, self.version = spark, base, model, version
        self._batches: list[tuple] = []
        for kind in self.KINDS:
            if after_epoch is None:
                delete(spark, self.path(kind))
            elif exists(spark, self.path(kind)):
                rows = spark.read.parquet(self.path(kind))
                kept = staged(rows.where(F.col("epoch_number") <= int(after_epoch)), "log")
                kept.write.mode("overwrite").parquet(self.path(kind))

    def path(self, kind: str) -> str:
        return f"{self.base}/{kind}/model={self.model}/version={self.version}"

    def _write(self, kind: str, rows: list[tuple], schema) -> None:
        if not rows:
            return
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(self.path(kind))

    def log_batch(self, epoch: int, batch: int, pred_loss: float, penalty_loss: float) -> None:
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        self._batches.append(
            (now, int(epoch), int(batch), float(pred_loss), float(penalty_loss),
             float(pred_loss) + float(penalty_loss))
        )
        if len(self._batches) >= self.BUFFER:
            self._flush()

    def _flush(self) -> None:
        self._write("batches", self._batches, S.BATCH_METRICS)
        self._batches = []

    def log_epoch(self, epoch: int, train_pred_loss: float, val_pred_loss: float) -> None:
        self._flush()
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        self._write(
            "epochs", [(now, int(epoch), float(train_pred_loss), float(val_pred_loss))], S.EPOCH_METRICS
        )

    def log_param_changes(self, epoch: int, batch: int, changes: DataFrame) -> None:
        """A15 rows (parameter, num_values_changed) with a timestamp and position."""
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        rows = changes.withColumns(
            {"timestamp": F.lit(now), "epoch_number": F.lit(int(epoch)), "batch_number": F.lit(int(batch))}
        ).select("timestamp", "epoch_number", "batch_number", "parameter", "num_values_changed")
        rows.coalesce(1).write.mode("append").parquet(self.path("param_changes"))


def read_metrics(spark: SparkSession, base: str, kind: str) -> DataFrame:
    """Read metric rows of all runs (``model`` / ``version`` come back as columns)."""
    return spark.read.parquet(f"{base}/{kind}")


# --------------------------------------------------------------------------------------------
# S13 model state


def model_dir(base: str, name: str, version: str) -> str:
    return f"{base}/{name}__{version}"


def save_params(spark: SparkSession, base: str, name: str, version: str, params: dict) -> None:
    """Run parameters as one JSON record."""
    doc = json.dumps(params, sort_keys=True, default=str)
    spark.createDataFrame([(doc,)], "params string").coalesce(1).write.mode("overwrite").text(
        f"{model_dir(base, name, version)}/params"
    )


def load_params(spark: SparkSession, base: str, name: str, version: str) -> dict:
    row = spark.read.text(f"{model_dir(base, name, version)}/params").first()
    return json.loads(row[0]) if row else {}


def save_model(model: Model, base: str, name: str, version: str, epoch: int, **info) -> str:
    """Factor tables (with optimiser moments) and scalar state for one epoch.

    The state is deleted first and written last: an epoch with a finished state file is complete
    (``complete_epochs``), one that was interrupted half-way is not."""
    spark = model.customers.sparkSession
    root = f"{model_dir(base, name, version)}/epoch={int(epoch)}"
    delete(spark, f"{root}/state")
    model.customers.write.mode("overwrite").parquet(f"{root}/customers")
    model.articles.write.mode("overwrite").parquet(f"{root}/articles")
    state = {
        "intercept": model.intercept, "k": model.k, "step": model.step, "m_g": model.m_g,
        "v_g": model.v_g, "epoch": int(epoch), "history": model.history, **info,
    }
    doc = json.dumps(state, sort_keys=True, default=str)
    spark.createDataFrame([(doc,)], "state string").coalesce(1).write.mode("overwrite").text(
        f"{root}/state"
    )
    return root


def complete_epochs(spark: SparkSession, base: str, name: str, version: str) -> list[int]:
    """The saved epochs whose state was committed, ascending."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(model_dir(base, name, version))
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(root)]
    epochs = sorted(int(n[len("epoch=") :]) for n in names if n.startswith("epoch="))
    return [e for e in epochs if exists(spark, f"{model_dir(base, name, version)}/epoch={e}/state/_SUCCESS")]


def load_model(spark: SparkSession, base: str, name: str, version: str, epoch: int) -> tuple[Model, dict]:
    root = f"{model_dir(base, name, version)}/epoch={int(epoch)}"
    state = json.loads(spark.read.text(f"{root}/state").first()[0])
    model = Model(
        spark.read.parquet(f"{root}/customers"),
        spark.read.parquet(f"{root}/articles"),
        float(state["intercept"]),
        int(state["k"]),
        int(state["step"]),
        float(state["m_g"]),
        float(state["v_g"]),
        [tuple(h) for h in state.get("history", [])],
    )
    return model, state
