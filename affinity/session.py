"""Session construction and the shared checkpoint location.

On a cluster the checkpoint folder must be shared storage named by ``spark.checkpoint.dir``;
it is read from the session and never invented. Only a ``local[...]`` master without that
setting (tests, benchmarks, the smoke driver) gets a fresh scratch folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CODEC = "zstd"  # of intermediate tables: fewer bytes than the default

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def scale_conf(
    input_bytes: float,
    executors: int,
    cores_per_executor: int,
    shuffle_ratio: float = 0.5,
    target_partition_bytes: int = 256 * 1024**2,
) -> dict[str, str]:
    """Partition sizing for a cluster run.

    Shuffle partitions are sized so one reducer task handles about ``target_partition_bytes``
    of the largest shuffle (estimated as ``shuffle_ratio`` of the input, after map-side
    partial aggregation), rounded up to whole waves of task slots; scan splits stay at 256 MB
    (or smaller when the input is too small to fill every slot once). AQE then coalesces small
    partitions and splits skewed ones at run time. For 100 TB on 1,000 executors x 8 cores:
    192,000 shuffle partitions (24 waves of 8,000 slots) and 256 MB splits.
    """
    slots = max(1, executors * cores_per_executor)
    shuffle_bytes = input_bytes * shuffle_ratio
    parts = max(slots, int(shuffle_bytes // target_partition_bytes) + 1)
    parts = ((parts + slots - 1) // slots) * slots
    split = int(min(256 * 1024**2, max(16 * 1024**2, input_bytes // slots)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "affinity",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build or get the session.

    ``DEFAULT_CONF`` only fills settings the launcher left unset (``spark-submit --conf`` and
    spark-defaults win); ``shuffle_partitions`` and ``extra_conf`` are explicit and override.
    A local master without an explicit partition count uses one partition per core.
    """
    from pyspark import SparkConf

    launcher = SparkConf()
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {k: v for k, v in DEFAULT_CONF.items() if not launcher.contains(k)}
    if shuffle_partitions is None and master and master.startswith("local"):
        cores = master[len("local[") : -1] if master.startswith("local[") else "1"
        shuffle_partitions = os.cpu_count() if cores in ("*", "") else int(cores.split(",")[0])
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of this session, configuring it if needed.

    Order: an already-set SparkContext checkpoint dir, then ``spark.checkpoint.dir`` from the
    session conf, then (local master only) a new scratch folder. A non-local session without
    a configured folder is an error: a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: configure a shared folder for reliable checkpoints"
        )
    base = os.environ.get("AFFINITY_SCRATCH", tempfile.gettempdir())
    path = tempfile.mkdtemp(prefix="affinity-ckpt-", dir=base)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def staged(df, name: str = "table"):
    """Write ``df`` as Parquet to a fresh folder under the checkpoint folder and read it back.

    Cuts the lineage, survives the loss of any executor, and gives the planner the table's bytes (a
    small one is broadcast by Spark's own threshold)."""
    import uuid

    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", CODEC).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
