"""Surrogate ids.

Dense 0-based row numbers in the order of any columns, without a global single-task sort:

1. rows are range-partitioned on the order (sampled bounds, many tasks) and sorted within partitions;
2. they are written once to the shared checkpoint folder, so file after file the table is sorted;
3. reading back, a row's place in its file comes from the scan's own metadata, and the rows of the
   files before it are added: one offset per file, so broadcasting the offsets is safe.

``monotonically_increasing_id`` is not used: it leaves gaps and depends on partitioning.
Ids follow key order, not file order (Spark files have no row order).
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.session import checkpoint_dir

# Names Spark gives the files of a write: the task's number, then the file's number within the task.
PART_FILE = re.compile(r"part-(\d+)-.*?(?:-c|\.c)(\d+)")


def _file_place(name: str) -> tuple[int, int]:
    found = PART_FILE.match(name)
    if not found:
        raise ValueError(f"not a part file: {name}")
    return int(found[1]), int(found[2])


def numbered(
    df: DataFrame,
    order: list[Column],
    out: str,
    num_partitions: int | None = None,
    rows_per_file: int = 1_000_000,
) -> DataFrame:
    """``df`` with ``out`` = 0-based number of the row in ``order`` (rows equal in ``order`` in any order).

    The number of tasks is ``num_partitions`` or, by default, what adaptive execution makes of the
    bytes; a task's rows go to files of at most ``rows_per_file`` rows, so that scans split well.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(int(num_partitions), *order) if num_partitions else df.repartitionByRange(*order)
    path = f"{checkpoint_dir(spark).rstrip('/')}/numbered-{uuid.uuid4().hex}"
    ranged.sortWithinPartitions(*order).write.option("maxRecordsPerFile", int(rows_per_file)).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    sizes = back.groupBy(F.col("_metadata.file_name").alias("f")).agg(F.count("*").alias("n")).collect()
    before, offsets = 0, []
    for name, n in sorted(((r["f"], r["n"]) for r in sizes), key=lambda x: _file_place(x[0])):
        offsets.append((name, before))
        before += n
    places = F.broadcast(spark.createDataFrame(offsets, "__file string, __before bigint"))
    rows = back.select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    number = (F.col("__before") + F.col("__row")).cast("bigint")
    return rows.join(places, "__file").select(*[F.col(f"`{c}`") for c in df.columns], number.alias(out))


def dense_ids(
    df: DataFrame,
    key: str,
    id_col: str,
    num_partitions: int | None = None,
    keys_per_partition: int = 1_000_000,
) -> DataFrame:
    """``(key, id)`` for the sorted distinct non-null keys of ``df``, ids 0..n-1."""
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    return numbered(keys, [F.col(key)], id_col, num_partitions, keys_per_partition)


def encode_pairs(
    pairs: DataFrame,
    customer_map: DataFrame,
    article_map: DataFrame,
    customer: str = "customer_int",
    article: str = "article_int",
    customer_idx: str = "customer_idx",
    article_idx: str = "article_idx",
) -> DataFrame:
    """Replace (customer, article) by their contiguous indexes; other columns pass through.

    A map under the session's broadcast threshold is broadcast (AQE knows its run-time size), a
    larger one is shuffle-joined.
    """
    out = pairs.join(customer_map.select(customer, customer_idx), customer)
    out = out.join(article_map.select(article, article_idx), article)
    rest = [c for c in pairs.columns if c not in (customer, article)]
    return out.select(customer_idx, article_idx, *rest)


def interaction_counts(
    pairs: DataFrame, customer: str = "customer_int", article: str = "article_int"
) -> DataFrame:
    """One row with the number of rows, distinct customers and distinct articles.

    Each distinct count is its own aggregation of one column (partial de-duplication before the
    shuffle); counting both in one pass would triple the rows first.
    """

    def distinct(col: str):
        keys = pairs.select(col).where(F.col(col).isNotNull()).distinct()
        return keys.agg(F.count(F.lit(1))).scalar()

    return pairs.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", distinct(customer).alias("num_customers"), distinct(article).alias("num_articles")
    )
