"""Repeatable sampling, splitting and batching.

Every random choice is a hash of the row's key and a seed (``affinity.functions.hashing``),
so results do not depend on partitioning, task order or retries (a re-run task after an
executor loss makes exactly the same choice).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.functions.hashing import bucket, hash32, uniform
from affinity.sources import schemas as S


def sample_keys(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """T4: N distinct keys without replacement: the N smallest ``hash(key, seed)``.

    Asking for more than the population returns the whole population. Planned as a
    per-task top-N followed by one merge of at most N rows per task (the limit is the
    feature: a sample of a given size).
    """
    if int(n) < 0:
        raise ValueError("the sample size must not be negative")
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    return keys.orderBy(hash32(F.col(key), seed), F.col(key)).limit(int(n))


def validation_flags(
    pairs: DataFrame, validation_share: float, seed: int,
    customer: str = S.CUSTOMER, article: str = S.ARTICLE, out: str = "is_validation",
) -> DataFrame:
    """Mark a repeatable ~share of the pairs as validation (hash threshold).

    The share is approximate (each pair independently), never exact; share 0 puts every pair
    in training.
    """
    if not 0.0 <= float(validation_share) <= 1.0:
        raise ValueError("validation_share must be between 0 and 1")
    u = uniform(F.col(customer), F.col(article), seed, "val")
    return pairs.withColumn(out, u < F.lit(float(validation_share)))


def exact_validation_flags(
    pairs: DataFrame, validation_share: float, seed: int,
    customer: str = S.CUSTOMER, article: str = S.ARTICLE, out: str = "is_validation",
) -> DataFrame:
    """T6, exact size: the ``int(share * n)`` pairs with the smallest (hash, customer, article).

    The cut is found without sorting the table: a histogram of the hash's high 16 bits
    (at most 65,536 rows) locates the bucket holding the n-th smallest hash, a histogram of
    the low 16 bits inside that bucket locates the hash itself, and rows sharing exactly that
    hash (rare collisions) are ordered by key. Two small aggregation jobs (a third only when
    the cut hash is shared); only bounded histograms reach the driver.
    """
    if not 0.0 <= float(validation_share) <= 1.0:
        raise ValueError("validation_share must be between 0 and 1")
    h = hash32(F.col(customer), F.col(article), seed, "val")
    keyed = pairs.withColumn("_h", h)
    hi = F.shiftright(F.col("_h"), 16)
    top = sorted((r[0], r[1]) for r in keyed.groupBy(hi.alias("b")).count().collect())
    total = sum(c for _, c in top)
    n = int(float(validation_share) * total)
    if n <= 0:
        return pairs.withColumn(out, F.lit(False))
    if n >= total:
        return pairs.withColumn(out, F.lit(True))
    below, bucket_hi = 0, None
    for b, c in top:
        if below + c >= n:
            bucket_hi = b
            break
        below += c
    lo = F.col("_h").bitwiseAND(F.lit(0xFFFF))
    inner = keyed.where(hi == bucket_hi).groupBy(lo.alias("b")).count().collect()
    cut, rest, at_cut = None, n - below, 0
    for b, c in sorted((r[0], r[1]) for r in inner):
        if c >= rest:
            cut, at_cut = (bucket_hi << 16) + b, c
            break
        rest -= c
    if at_cut == rest:  # the usual case: no other row shares the cut hash
        return keyed.withColumn(out, F.col("_h") <= F.lit(cut)).drop("_h")
    # ``rest`` of the ``at_cut`` rows sharing the cut hash are still needed: first by key
    ties = (
        keyed.where(F.col("_h") == cut)
        .orderBy(customer, article)
        .limit(rest)
        .select(customer, article)
        .distinct()
        .withColumn("_tie", F.lit(True))
    )
    flagged = keyed.join(ties, [customer, article], "left")
    chosen = (F.col("_h") < F.lit(cut)) | F.coalesce(F.col("_tie"), F.lit(False))
    return flagged.withColumn(out, chosen).drop("_h", "_tie")


def number_of_batches(n_rows: int, batch_size: int) -> int:
    return max(1, math.ceil(n_rows / max(1, int(batch_size))))


def assign_batches(
    pairs: DataFrame, n_batches: int, seed: int, epoch: int,
    customer: str = S.CUSTOMER, article: str = S.ARTICLE, out: str = "batch",
) -> DataFrame:
    """T5: shuffled batches: batch = hash(pair, seed, epoch) mod n_batches (new order each epoch)."""
    return pairs.withColumn(out, bucket(n_batches, F.col(customer), F.col(article), seed, epoch))
