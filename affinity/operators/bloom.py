"""Bloom-filter reduction of a large table before a semi join with a short list of keys.

A semi join that does not broadcast shuffles the large side whole. Here the keys are hashed into a bit set, held as
a table of 64-bit words, and rows whose bit is not set leave at the scan, before any shuffle. The exact join
follows, so rows that pass by chance change no result. The filter is sized from the number of keys and never
larger than ``MAX_BITS``, which bounds what is broadcast: a table of at most ``MAX_BITS / 64`` rows. Built-in
expressions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY, MAX_BITS = 16, 1 << 26


def filter_bits(n_keys: int) -> int:
    """A power of two of at least ``BITS_PER_KEY`` bits per key, up to ``MAX_BITS``."""
    return min(MAX_BITS, max(64, 1 << (max(1, n_keys * BITS_PER_KEY) - 1).bit_length()))


def filter_words(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """``(_word, _set)``: the words of the bit set that have a bit."""
    place = F.pmod(F.xxhash64(key), F.lit(bits)).alias("_place")
    words = keys.select(place).groupBy(F.shiftright("_place", 6).alias("_word"))
    return words.agg(F.bit_or(F.expr("shiftleft(1L, int(_place & 63))")).alias("_set"))


def maybe_in(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` may be among ``keys`` (all that are, and about one in ``BITS_PER_KEY`` of the others
    while the filter is below ``MAX_BITS``). ``keys`` is read twice, so it should be a written table."""
    bits = filter_bits(keys.count())
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    placed = rows.withColumn("_place", place).withColumn("_word", F.shiftright("_place", 6))
    found = placed.join(F.broadcast(filter_words(keys, key, bits)), "_word")
    return found.where("getbit(_set, int(_place & 63)) = 1").select(*rows.columns)
