"""Built-in ALS as an alternative fitter (M4 alternative).

Spark's ALS has a linear link, no biases and a squared penalty, so it is not the objective of
``factors.fit_log_link_factors``. To stay close to an exponential link the fit works on
``log(weight)`` (weights are > 0): the global mean and customer / article mean offsets are
removed first (grouped means, map-side partial aggregation) and ALS factorises the residual.
The result is returned in the same factor-table layout as the log-link model, so scoring
``exp(u.v + b_c + b_a + g)`` and every downstream operator apply unchanged.

ALS needs 32-bit ids, so both sides are re-indexed densely (P6) whatever the ids: shifting them
does not change the fit. The numbers of blocks follow the number of ids and pairs.
"""

from __future__ import annotations

import math

from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.functions.scores import factor_names
from affinity.operators.factors import Model
from affinity.operators.ids import dense_ids
from affinity.session import staged
from affinity.sources import schemas as S


def number_of_blocks(n_pairs: int, n_ids: int, pairs_per_block: int = 2_000_000, ids_per_block: int = 500_000) -> int:
    """ALS blocks of one side (its tasks): Spark's own default of 10 at least."""
    return max(10, math.ceil(n_pairs / pairs_per_block), math.ceil(n_ids / ids_per_block))


def fit_als(
    interactions: DataFrame,
    rank: int = 10,
    max_iter: int = 10,
    reg: float = 0.1,
    seed: int = 0,
    customer: str = S.CUSTOMER,
    article: str = S.ARTICLE,
    weight: str = S.WEIGHT,
) -> Model:
    if rank < 1 or max_iter < 0 or reg < 0:
        raise ValueError("rank must be positive, max_iter and reg not negative")
    y = staged(
        interactions.where(F.col(weight) > 0).select(customer, article, F.log(F.col(weight)).alias("_y"))
    )
    total = y.agg(F.avg("_y").alias("mu"), F.count("*").alias("n")).first()
    mu = float(total["mu"] or 0.0)
    cb = y.groupBy(customer).agg((F.avg("_y") - F.lit(mu)).alias("_bc"))
    with_cb = y.join(cb, customer)
    ab = with_cb.groupBy(article).agg(F.avg(F.col("_y") - F.lit(mu) - F.col("_bc")).alias("_ba"))
    cmap = staged(dense_ids(y, customer, "_cu").join(cb, customer))
    amap = staged(dense_ids(y, article, "_ar").join(ab, article))
    resid = staged(
        y.join(cmap, customer)
        .join(amap, article)
        .withColumn("_r", F.col("_y") - F.lit(mu) - F.col("_bc") - F.col("_ba"))
        .select(F.col("_cu").cast("int"), F.col("_ar").cast("int"), "_r")
    )
    als = ALS(
        rank=rank, maxIter=max_iter, regParam=reg, userCol="_cu", itemCol="_ar", ratingCol="_r",
        implicitPrefs=False, coldStartStrategy="drop", seed=seed, nonnegative=False,
        numUserBlocks=number_of_blocks(total["n"], cmap.count()),
        numItemBlocks=number_of_blocks(total["n"], amap.count()),
    )
    fitted = als.fit(resid)
    names = factor_names(rank)

    def table(factors: DataFrame, idmap: DataFrame, idx: str, key: str, bcol: str):
        cols = [F.col("features")[i].cast("double").alias(n) for i, n in enumerate(names)]
        return (
            factors.select(F.col("id").cast("long").alias(idx), *cols)
            .join(idmap, idx)
            .select(F.col(key).alias("id"), *names, F.col(bcol).alias("bias"))
        )

    cust = table(fitted.userFactors, cmap, "_cu", customer, "_bc")
    arts = table(fitted.itemFactors, amap, "_ar", article, "_ba")
    return Model(cust, arts, mu, rank)
