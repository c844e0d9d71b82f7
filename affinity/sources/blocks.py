"""Tables kept as files of bounded blocks, for tasks that go through another table block by block.

A factor table is range-partitioned and written once, one file per block, with a manifest of the files: their
rows, the largest factor norm and the largest bias in them, and the range of each factor. A task gets the
manifest and reads the blocks it needs, one at a time, so what is shuffled does not grow with the number of pairs
of blocks.

By default the rows of a block lie close together: each factor and the bias is cut at its quantiles, and the rows
follow one another as the cells of that grid do in Gray-code order, in which neighbours differ in one bit of one
column. The ranges of a block are then narrow.

Runs in Python workers; the module is shipped by value.
"""

from __future__ import annotations

import math
import sys
import uuid
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.session import checkpoint_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Block:
    path: str
    rows: int
    norm: float  # the largest among rows without NaN; -1 if there is none
    bias: float
    low: tuple[float, ...]  # of each factor among those rows; 0 if there is none
    high: tuple[float, ...]


MAX_BITS, MAX_CODE_BITS, CELLS_PER_BLOCK = 4, 60, 8


def _close_together(table: DataFrame, columns: list[str], rows: int) -> DataFrame:
    """``table`` with ``_place``, the number of a row's grid cell in Gray-code order."""
    blocks = max(1, math.ceil(table.count() / rows))
    columns = columns[:MAX_CODE_BITS]
    bits = min(MAX_BITS, MAX_CODE_BITS // len(columns), math.ceil(math.log2(blocks * CELLS_PER_BLOCK) / len(columns)))
    if blocks == 1 or bits < 1:
        return table.withColumn("_place", F.lit(0).cast("long"))
    shares = [i / 2**bits for i in range(1, 2**bits)]
    cuts = table.stat.approxQuantile(columns, shares, 0.01)
    cell = [
        f"size(filter(array({', '.join(f'double({x!r})' if math.isfinite(x) else f'double({str(x)!r})' for x in at)}), x -> x < `{c}`))"
        f" AS _q{i}" if at else f"0 AS _q{i}"
        for i, (c, at) in enumerate(zip(columns, cuts))
    ]
    code = ", ".join(f"cast(shiftright(coalesce(_q{i}, 0), {b}) & 1 AS bigint)" for b in reversed(range(bits)) for i in range(len(columns)))
    # a bit of the place is the exclusive or of the code's bits down to it
    place = f"aggregate(array({code}), 0L, (r, b) -> shiftleft(r, 1) + ((r & 1L) ^ b)) AS _place"
    return table.selectExpr("*", *cell).selectExpr(*[f"`{c}`" for c in table.columns], place)


def write_blocks(factors: DataFrame, names: list[str], rows: int, order: list[Column] | None = None) -> list[Block]:
    """Write ``id`` and the factor columns ``names`` (the last one is the bias) in ``order`` (by default so that a
    block's rows lie close together) as files of at most ``rows`` rows; the manifest, a row per block, by falling norm."""
    spark = factors.sparkSession
    norm = F.sqrt(sum((F.col(n) * F.col(n) for n in names[1:-1]), F.col(names[0]) * F.col(names[0])))
    table = factors.select("id", *[F.col(n).cast("double").alias(n) for n in names], norm.alias("_norm"))
    if order is None:
        table, order = _close_together(table, [names[-1], *names[:-1]], max(1, int(rows))), [F.col("_place"), F.col("id")]
    path = f"{checkpoint_dir(spark).rstrip('/')}/blocks-{uuid.uuid4().hex}"
    sorted_rows = table.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_rows.write.option("maxRecordsPerFile", max(1, int(rows))).parquet(path)
    number = ~(F.isnan("_norm") | F.isnan(names[-1]))  # a row with NaN scores NaN: it bounds nothing
    files = (
        spark.read.schema(table.schema).parquet(path)
        .groupBy(F.col("_metadata.file_path").alias("path"))
        .agg(
            F.count("*").alias("n"),
            F.max(F.when(number, F.col("_norm"))).alias("norm"),
            F.max(F.when(number, F.col(names[-1]))).alias("bias"),
            *[f(F.when(number, F.col(n))).alias(f"{f.__name__}_{i}") for i, n in enumerate(names[:-1]) for f in (F.min, F.max)],
            F.min("id").alias("first"),
        )
        .collect()
    )
    zeros = (0.0,) * (len(names) - 1)

    def bounds(f):
        if f["norm"] is None:
            return -1.0, float("-inf"), zeros, zeros
        return f["norm"], f["bias"], *(tuple(f[f"{side}_{i}"] for i in range(len(zeros))) for side in ("min", "max"))

    found = [(Block(f["path"], f["n"], *bounds(f)), f["first"]) for f in files]
    return [b for b, _ in sorted(found, key=lambda x: (-x[0].norm, x[1]))]


def read_block(block: Block, names: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(ids, factors, biases)`` of a block, ids ascending. Inside a task."""
    from urllib.parse import unquote

    import pyarrow.parquet as pq
    from pyarrow import fs

    uri = block.path
    if uri.startswith("file:"):
        store, path = fs.LocalFileSystem(), "/" + unquote(uri[5:]).lstrip("/")
    else:
        store, path = fs.FileSystem.from_uri(uri)
    table = pq.read_table(path, columns=["id", *names], filesystem=store)
    ids = table.column("id").to_numpy()
    order = np.argsort(ids, kind="stable")
    values = np.stack([table.column(n).to_numpy()[order] for n in names], axis=1)
    return ids[order], np.ascontiguousarray(values[:, :-1]), values[:, -1]
