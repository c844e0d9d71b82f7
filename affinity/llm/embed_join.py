"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors with cosine >= t lie within eps = sqrt(2 - 2 t) of each other. Vectors are rotated to
principal axes, sorted by the grid cells (width eps) of the leading ones, and cut along that order into
tiles. The sequence of tiles joins itself recursively: an interval pair whose boxes are further apart
than eps is dropped, the others expand into the pairs of their child intervals, down to tile pairs. A
task joins one tile pair the same way over runs of rows, and computes cosines only for near runs.

Equal vectors are grouped first. A task returns sums of links per vector and a spanning set of
links, so a dense family costs rows in proportion to its vectors, not to its pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.components import components
from affinity.llm.shared import staged

FAN_OUT_BITS = 4
RUN_ROWS = 128


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows over their norms; the power-of-two scaling first keeps huge and tiny values exact."""
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def principal_axes(sample: np.ndarray, dims: int) -> np.ndarray:
    """Orthonormal columns, largest variance first (any basis gives right results)."""
    if len(sample) < 2:
        return np.eye(dims)
    u = unit_rows(sample)
    u = u - u.mean(axis=0)
    return np.ascontiguousarray(np.linalg.eigh(u.T @ u)[1][:, ::-1])


def _boxes(z: np.ndarray):
    at = np.arange(0, len(z), RUN_ROWS)
    return np.minimum.reduceat(z, at), np.maximum.reduceat(z, at)


def _near_runs(a: np.ndarray, b: np.ndarray, limit: float):
    """Pairs of row runs of two matrices in grid order whose boxes are within the limit (squared)."""
    lo_a, hi_a = _boxes(a)
    lo_b, hi_b = _boxes(b)
    for i in range(len(lo_a)):
        gap = np.maximum(0.0, np.maximum(lo_a[i] - hi_b, lo_b - hi_a[i]))
        for j in np.nonzero(np.einsum("ij,ij->i", gap, gap) <= limit)[0]:
            yield i * RUN_ROWS, int(j) * RUN_ROWS


def _spanning(hits: np.ndarray):
    """Row and column labels of the components of a bipartite hit matrix (-1: no hit)."""
    n = hits.shape[0] + hits.shape[1]
    rows = np.arange(hits.shape[0])
    while True:
        cols = np.where(hits, rows[:, None], n).min(axis=0)
        new = np.minimum(rows, np.where(hits, cols[None, :], n).min(axis=1))
        if (new == rows).all():
            return np.where(hits.any(axis=1), rows, -1), np.where(hits.any(axis=0), cols, -1)
        rows = new


def join_tiles(x: np.ndarray, y: np.ndarray | None, axes: np.ndarray, threshold: float):
    """``(i, j, hits)`` for the near runs of two tiles of raw vectors; ``y`` None joins ``x`` with itself
    (then each pair of rows appears once)."""
    u = unit_rows(x)
    v = u if y is None else unit_rows(y)
    other = x if y is None else y
    limit = max(0.0, 2 - 2 * threshold) + 1e-9
    for i, j in _near_runs(u @ axes, v @ axes, limit):
        if y is None and j < i:
            continue
        cos = u[i : i + RUN_ROWS] @ v[j : j + RUN_ROWS].T
        hits = cos >= threshold
        for a, b in zip(*np.nonzero(np.abs(cos - threshold) < 1e-9)):  # too close for a matrix product to tell
            p, q = x[i + a], other[j + b]
            p, q = np.ldexp(p, -math.frexp(np.abs(p).max())[1]), np.ldexp(q, -math.frexp(np.abs(q).max())[1])
            hits[a, b] = np.dot(p, q) / (np.linalg.norm(p) * np.linalg.norm(q)) >= threshold
        if y is None and i == j:
            hits &= np.tri(len(hits), k=-1, dtype=bool).T
        if hits.any():
            yield i, j, hits


def _tiles(nodes: DataFrame, axes: np.ndarray, eps: float, leading: int, tile_rows: int, parts: int) -> DataFrame:
    """Tiles along the grid order: ``part, number, lo_*, hi_*, nodes, copies, data``."""
    dims = len(axes)
    lead = min(leading, dims)
    cells = ", ".join(f"c{i} bigint" for i in range(lead))

    def gridded(batches):
        for batch in batches:
            x = np.array(batch.column(2).to_pylist(), np.float64).reshape(-1, dims)
            c = np.floor(unit_rows(x) @ axes[:, :lead] / eps).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(c[:, i]) for i in range(lead))],
                ["node", "copies", "x", *(f"c{i}" for i in range(lead))],
            )

    grid = nodes.select("node", "copies", "x").mapInArrow(gridded, f"node bigint, copies bigint, x array<double>, {cells}")
    order = [F.col(f"c{i}") for i in range(lead)] + [F.col("node")]
    ordered = staged(grid, "grid").repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def cut(batches):
        part, number, held = TaskContext.get().partitionId(), 0, [[], [], []]

        def flush():
            x = np.array(held[2], np.float64)
            z = unit_rows(x) @ axes[:, :lead]
            values = [part, number, *z.min(axis=0).tolist(), *z.max(axis=0).tolist()]
            values += [np.array(held[0], np.int64).tobytes(), np.array(held[1], np.int64).tobytes(), x.tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names)

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for column, value in zip(held, row):
                    column.append(value)
                if len(held[0]) == tile_rows:
                    yield flush()
                    number, held = number + 1, [[], [], []]
        if held[0]:
            yield flush()

    boxes = [f"{s}{i}" for s in ("lo", "hi") for i in range(lead)]
    names = ["part", "number", *boxes, "nodes", "copies", "data"]
    ddl = "part bigint, number bigint, " + ", ".join(f"{b} double" for b in boxes)
    return staged(ordered.mapInArrow(cut, f"{ddl}, nodes binary, copies binary, data binary"), "tiles")


def _tile_pairs(tiles: DataFrame, lead: int, limit: float) -> DataFrame:
    """``(tile_a, tile_b)``, a <= b, of tiles that can hold linked vectors: interval pairs expanded level by
    level, provably distant ones dropped."""
    boxes = [f"{s}{i}" for s in ("lo", "hi") for i in range(lead)]
    count = tiles.agg(F.max("tile")).first()[0] + 1
    levels = max(1, math.ceil(math.log2(max(2, count)) / FAN_OUT_BITS))
    gaps = [F.greatest(F.lit(0.0), F.col(f"a.lo{i}") - F.col(f"b.hi{i}"), F.col(f"b.lo{i}") - F.col(f"a.hi{i}")) for i in range(lead)]
    near = sum((g * g for g in gaps), F.lit(0.0)) <= limit
    pairs = None
    for level in reversed(range(levels)):
        own = F.shiftright("tile", FAN_OUT_BITS * level)
        nodes = tiles.groupBy(own.alias("id")).agg(
            *[(F.min if b.startswith("lo") else F.max)(b).alias(b) for b in boxes]
        )
        nodes = nodes.withColumn("parent", F.shiftright("id", FAN_OUT_BITS))
        if pairs is None:  # all children of the one root
            pairs = nodes.select(F.col("parent").alias("pa"), F.col("parent").alias("pb")).distinct()
        a, b = nodes.alias("a"), nodes.alias("b")
        pairs = (
            pairs.join(a, F.col("a.parent") == F.col("pa"))
            .join(b, F.col("b.parent") == F.col("pb"))
            .where((F.col("a.id") <= F.col("b.id")) & near)
            .select(F.col("a.id").alias("pa"), F.col("b.id").alias("pb"))
        )
        pairs = staged(pairs, "interval_pairs")
    return pairs.select(F.col("pa").alias("tile_a"), F.col("pb").alias("tile_b"))


def _links(nodes: DataFrame, dims: int, threshold: float, leading: int, tile_rows: int, sample_rows: int) -> DataFrame:
    """``(u, v, n)``: links counted per node (v null), and links that span the components (n null)."""
    spark = nodes.sparkSession
    sample = nodes.orderBy(F.xxhash64("node")).limit(sample_rows).select("x").collect()
    axes = principal_axes(np.array([r["x"] for r in sample], np.float64).reshape(-1, dims), dims)
    eps = math.sqrt(max(2 - 2 * threshold, 1e-6))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    tiles = _tiles(nodes, axes, eps, leading, tile_rows, parts)
    counts = {r["part"]: r["n"] for r in tiles.groupBy("part").agg(F.max("number").alias("n")).collect()}
    first, before = [], 0
    for p in range(max(counts, default=-1) + 1):  # as many numbers as range partitions
        first.append(before)
        before += counts.get(p, -1) + 1
    if not first:
        return spark.createDataFrame([], "u bigint, v bigint, n bigint")
    at = F.element_at(F.array(*[F.lit(n).cast("bigint") for n in first]), (F.col("part") + 1).cast("int"))
    tiles = tiles.withColumn("tile", at + F.col("number"))
    pairs = _tile_pairs(tiles, min(leading, dims), max(0.0, 2 - 2 * threshold) + 1e-9)
    body = ["nodes", "copies", "data"]
    a = tiles.select(F.col("tile").alias("tile_a"), *[F.col(c).alias(f"{c}_a") for c in body])
    b = tiles.select(F.col("tile").alias("tile_b"), *[F.col(c).alias(f"{c}_b") for c in body])
    work = pairs.repartition(parts, "tile_a", "tile_b").join(a, "tile_a").join(b, "tile_b")

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                same = r["tile_a"] == r["tile_b"]
                ids = [np.frombuffer(r[f"nodes_{s}"], np.int64) for s in "ab"]
                weight = [np.frombuffer(r[f"copies_{s}"], np.int64) for s in "ab"]
                x, y = (np.frombuffer(r[f"data_{s}"], np.float64).reshape(-1, dims) for s in "ab")
                sums = [np.zeros(len(i), np.int64) for i in ids]
                if same:
                    sums[1] = sums[0]
                edges = [[], []]
                for i, j, hits in join_tiles(x, None if same else y, axes, threshold):
                    h, w = hits.shape
                    sums[0][i : i + h] += hits @ weight[1][j : j + w]
                    sums[1][j : j + w] += weight[0][i : i + h] @ hits
                    rows, cols = _spanning(hits)
                    root_of = ids[0][i : i + h]
                    for label, own in ((rows, root_of), (cols, ids[1][j : j + w])):
                        linked = np.nonzero(label >= 0)[0]
                        edges[0].append(own[linked])
                        edges[1].append(root_of[label[linked]])
                for own, total in zip(ids[: 1 if same else 2], sums):
                    some = np.nonzero(total)[0]
                    yield _rows(own[some], None, total[some])
                if edges[0]:
                    u, v = np.concatenate(edges[0]), np.concatenate(edges[1])
                    pair = np.unique(np.stack([u, v], 1)[u != v], axis=0)
                    yield _rows(pair[:, 0], pair[:, 1], None)

    def _rows(u, v, n):
        none = pa.nulls(len(u), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(u), none if v is None else pa.array(v), none if n is None else pa.array(n)], ["u", "v", "n"]
        )

    columns = ["tile_a", "tile_b", *[f"{c}_{s}" for s in "ab" for c in body]]
    return work.select(*columns).mapInArrow(run, "u bigint, v bigint, n bigint")


def embedding_components(
    vectors: DataFrame,
    threshold: float = 0.95,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    leading: int = 8,
    tile_rows: int = 2048,
    sample_rows: int = 4096,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row.

    A link joins two vectors of equal length whose cosine, in double precision, is at least
    ``threshold``. Vectors that are null, empty, zero, or hold null or non-finite components link with
    nothing. Rows with equal vectors (also under one repeated id) link with each other; a null id
    never names a component. ``sample_rows`` bounds the rows that the principal axes are fitted on (they decide
    the order only, never the result). Other columns are ignored; empty tables give empty results.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    x = F.col(vector_col).cast("array<double>")
    usable = F.coalesce(
        F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
        & F.exists(x, lambda c: c != 0),
        F.lit(False),
    )
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.when(usable, x).alias("x"))
    nodes = rows.where("x is not null").groupBy("x").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
    nodes = staged(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    sizes = [r[0] for r in nodes.select(F.size("x")).distinct().limit(1001).collect()]
    if len(sizes) > 1000:
        raise ValueError("vectors have more than 1000 different lengths")
    links = vectors.sparkSession.createDataFrame([], "u bigint, v bigint, n bigint")
    for dims in sorted(sizes):
        links = links.union(_links(nodes.where(F.size("x") == dims), dims, threshold, leading, tile_rows, sample_rows))
    links = staged(links, "links")
    sums = links.where("v is null").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("n"))
    roots = components(links.where("v is not null").select("u", "v"))
    rooted = staged(
        nodes.join(roots, "node", "left")
        .join(sums, "node", "left")
        .select(
            "x",
            "first_id",
            F.coalesce("root", "node").alias("root"),
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "rooted",
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(least, "root").select("x", "n_links", "component_id")
    found = rows.join(named, "x", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(F.col("x").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
