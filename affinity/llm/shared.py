"""Helpers shared by the operators: staged tables and files in the session's shared folder."""

from __future__ import annotations

import pickle
import uuid

from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.session import checkpoint_dir


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder (not yet created)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: a cut in the lineage that
    survives the loss of any executor."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``shared_folder`` once nothing reads it any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def in_fold(id_col: str, folds: int, fold: int) -> Column:
    """crc32(id as text) mod ``folds`` is ``fold``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold


def sent(spark: SparkSession, model) -> Broadcast:
    """A model of bounded size for all tasks, its class by value: workers need no copy of the package."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(model))


def received(model: Broadcast):
    """Inside a task: the model that ``sent`` broadcast."""
    return pickle.loads(model.value)


def slices_of(batch, column: int, rows: int = 256):
    """Python values of a batch's column, a few rows at a time (whole columns of texts are large)."""
    values = batch.column(column)
    for at in range(0, len(values), rows):
        yield values.slice(at, rows).to_pylist()


def open_store(uri: str):
    """(filesystem, path) for a folder that all executors share; works inside tasks.

    ``file:`` folders (a shared mount), ``hdfs:``, ``s3:`` and ``gs:`` URIs are understood.
    """
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)
