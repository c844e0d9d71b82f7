"""Exact top-k search by integer inner product: columnar branch-and-bound.

Vectors lie in tiles of bounded size, stored vertically (one array per dimension). A query visits a
tile by blocks of its dimensions, largest absolute query components first: partial scores are
accumulated for the candidates still alive, then each candidate's upper bound (partial score
plus the product of the remaining norms) is held against the best k-th lower bound, and the survivors
are compacted. The bound never cuts a candidate that could tie, so ranks are exact.

Both sides are dealt as tiles and every (query tile, candidate tile) pair is one task input of bounded
size; each query keeps its own k best of a tile, and the k best over the tiles are merged.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm.shared import staged

DIMENSION_BLOCK = 8
TILE_VALUES = 1 << 23  # at most in a tile: long vectors make tiles of fewer rows


def best_in_tile(
    query: np.ndarray, columns: np.ndarray, rest: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """The k best ``(ids, scores)`` of one tile for one query, best first, smaller id first in ties.

    ``columns`` is dimensions x candidates; ``rest`` are the candidates' squared norms; ``own`` are the
    positions in the tile that the query leaves out. All sums are exact 64-bit integers.
    """
    order = np.argsort(-np.abs(query), kind="stable")
    alive = np.delete(np.arange(columns.shape[1]), own)
    partial = np.zeros(len(alive), np.int64)
    left = rest[alive].copy()
    q_left = int(query @ query)
    for at in range(0, len(order), DIMENSION_BLOCK):
        dims = order[at : at + DIMENSION_BLOCK]
        part = columns[np.ix_(dims, alive)] if len(alive) < columns.shape[1] else columns[dims]
        q = query[dims]
        partial += q @ part
        left -= np.einsum("ij,ij->j", part, part)
        q_left -= int(q @ q)
        if len(alive) <= k or at + DIMENSION_BLOCK >= len(order):
            continue
        # Cauchy-Schwarz on what is left, and more than the rounding of these floats
        reach = np.sqrt(left.astype(np.float64)) * math.sqrt(q_left) * (1 + 1e-9) + 1.0 + 1e-14 * np.abs(partial)
        floor = np.partition(partial - reach, len(alive) - k)[len(alive) - k]
        keep = partial + reach >= floor
        if not keep.all():
            alive, partial, left = alive[keep], partial[keep], left[keep]
    if len(alive) > k:
        kth = np.partition(partial, len(alive) - k)[len(alive) - k]
        keep = partial >= kth
        alive, partial = alive[keep], partial[keep]
    best = np.lexsort((ids[alive], -partial))[:k]
    return ids[alive[best]], partial[best]


def _tiles(rows: DataFrame, tile_rows: int, dims: int) -> DataFrame:
    """``(tile, ids, data)``: ids and the vertical int64 matrix of at most ``tile_rows`` vectors each."""

    def run(batches):
        tile, ids, vectors = TaskContext.get().partitionId() << 32, [], []

        def flush():
            m = np.ascontiguousarray(np.array(vectors, np.int64).reshape(-1, dims).T)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([tile], pa.int64()),
                    pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                    pa.array([m.tobytes()], pa.binary()),
                ],
                ["tile", "ids", "data"],
            )

        for batch in batches:
            for key, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(key)
                vectors.append(v)
                if len(ids) == tile_rows:
                    yield flush()
                    tile, ids, vectors = tile + 1, [], []
        if ids:
            yield flush()

    return rows.select("vec_id", "v").mapInArrow(run, "tile bigint, ids binary, data binary")


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``(vec_id, dims, v array<bigint>)`` with v = floor(scale * x); vectors that are null, empty or hold
    null or non-finite components take no part, nor do null ids. A squared norm of 2^62 or more is an
    error (1024 components of 2^26 reach it): below it every partial sum of a product fits 64 bits."""
    x = F.col(vector_col).cast("array<double>")
    usable = F.coalesce(
        (F.size(x) > 0) & F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))),
        F.lit(False),
    )
    too_large = F.raise_error(F.lit("a scaled vector's squared norm is 2^62 or more, as of 1024 components of 2^26"))

    def whole(c):
        return F.floor(c * F.lit(float(scale)))

    norm = F.aggregate(x, F.lit(0.0), lambda a, c: a + whole(c).cast("double") * whole(c).cast("double"))
    v = F.when(norm < F.lit(float(1 << 62)), F.transform(x, whole)).otherwise(too_large)
    return vectors.where(usable & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.size(x).alias("dims"), v.alias("v")
    )


def top_k(
    vectors: DataFrame,
    is_query: str = "vec_id % 20 = 0",
    k: int = 20,
    scale: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    tile_rows: int = 8192,
    query_tile_rows: int = 1024,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's k highest integer inner products.

    Queries are the rows for which ``is_query`` (SQL over ``vec_id``) holds; candidates are all rows but
    the query's own. Only vectors of equal length are compared. Ties go to the smaller id; a query with
    fewer than k candidates gets all. Repeated ids: rows are told apart by position, a query leaves out
    every row of its own id. Vectors that are null, empty or hold null or non-finite components take no
    part; other columns are ignored; an empty table gives an empty result. A vector whose squared norm after
    scaling is 2^62 or more is an error.
    """
    spark = vectors.sparkSession
    rows = staged(quantised(vectors, id_col, vector_col, scale), "quantised")
    sizes = [r["dims"] for r in rows.select("dims").distinct().orderBy("dims").limit(1001).collect()]
    if len(sizes) > 1000:
        raise ValueError("vectors have more than 1000 different lengths")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = None
    for dims in sizes or [1]:
        own = rows.where(F.col("dims") == dims)
        most = max(1, TILE_VALUES // dims)
        queries = _tiles(own.where(is_query).repartition(F.col("vec_id")), min(query_tile_rows, most), dims)
        candidates = _tiles(own, min(tile_rows, most), dims)
        part = _search(staged(queries, "query_tiles"), staged(candidates, "tiles"), dims, k, parts)
        found = part if found is None else found.union(part)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def _search(queries: DataFrame, candidates: DataFrame, dims: int, k: int, parts: int) -> DataFrame:
    """Every query tile meets every candidate tile: the search itself, in blocks of bounded size.

    Query tiles fall into groups by hash; every candidate tile's number is repeated for every group and
    meets the query tiles of that group by an equi-join. A task input is one tile pair.
    """
    groups = max(1, queries.count())
    group = F.pmod(F.xxhash64("q_tile"), F.lit(groups))
    q = queries.selectExpr("tile q_tile", "ids q_ids", "data q_data").withColumn("group", group)
    dealt = candidates.select("tile", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))).alias("group"))
    pairs = dealt.join(q.select("q_tile", "group"), "group").repartition(parts, "tile", "q_tile")
    pairs = (
        pairs.join(q.drop("group"), "q_tile").join(candidates, "tile").select("q_ids", "q_data", "ids", "data")
    )

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                q_ids, q_data, c_ids, c_data = (batch.column(j)[i].as_py() for j in range(4))
                q_ids, ids = np.frombuffer(q_ids, np.int64), np.frombuffer(c_ids, np.int64)
                q = np.frombuffer(q_data, np.int64).reshape(dims, -1).T
                columns = np.frombuffer(c_data, np.int64).reshape(dims, -1)
                norms = np.einsum("ij,ij->j", columns, columns)
                out = [[], [], []]
                for key, vector in zip(q_ids, q):
                    own = np.nonzero(ids == key)[0]
                    got, scores = best_in_tile(vector, columns, norms, ids, own, k)
                    out[0].append(np.full(len(got), key))
                    out[1].append(got)
                    out[2].append(scores)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).astype(np.int64)) for x in out], ["query_id", "vec_id", "score"]
                )

    return pairs.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")
