"""Repeatable pseudo-random numbers from keys.

``rand()`` depends on partitioning and task order, so every random choice here is a hash of the
key and a seed instead. The 32-bit value is the first 8 hex digits of md5 over the text
``key1:key2:...:seed``; the same number is ``('0x' || substr(md5(s), 1, 8))::BIGINT`` in SQL
engines that have md5, so these choices can be checked by an oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPACE = 4294967296.0  # 2**32


def hash_text(*parts) -> Column:
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.concat_ws(":", *[c.cast("string") for c in cols])


def hash32(*parts) -> Column:
    """Unsigned 32-bit hash of the parts, as bigint in [0, 2**32)."""
    return F.conv(F.substring(F.md5(hash_text(*parts)), 1, 8), 16, 10).cast("bigint")


def uniform(*parts) -> Column:
    """Repeatable uniform number in [0, 1)."""
    return hash32(*parts) / F.lit(HASH_SPACE)


def bucket(n_buckets: int, *parts) -> Column:
    """Repeatable bucket number in [0, n_buckets)."""
    return F.pmod(hash32(*parts), F.lit(int(n_buckets)))


def normal(*parts) -> Column:
    """Repeatable standard-normal draw (Box-Muller on two independent hashes)."""
    u1 = (hash32(*parts, "n1") + F.lit(1.0)) / F.lit(HASH_SPACE + 1.0)
    u2 = hash32(*parts, "n2") / F.lit(HASH_SPACE)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(6.283185307179586) * u2)
