"""SimHash near-duplicates through a byte-position inverted index with count filtering.

1. Every whole text becomes a 64-bit fingerprint (word shingles, XXH64, majority per bit). Equal
   fingerprints are grouped first, so a large group of copies is one entry of the index.
2. Index: a fingerprint is entered under its positional bytes. Two fingerprints at most ``b`` bits
   apart differ in at most ``b`` of the eight positions, so they share at least ``8 - b`` of them.
   The positions are split into ``b + 2`` runs; two whole runs are then always shared, and a
   posting list holds the fingerprints that agree in the positional bytes of two runs. Lists
   therefore stay short as the corpus grows (32 bits of selectivity for ``b = 2``).
3. Count filter: for each pair of a list the shared positional bytes are tallied, pairs under
   the guaranteed ``8 - b`` are dropped, the rest verified by their differing bits.
4. A list longer than ``dense_list`` (a family of near copies) is not expanded into pairs. Two
   fingerprints are at most ``2 r`` bits apart exactly when their radius-``r`` balls meet; its
   members are entered under the points of their balls over the free bits and linked to the least
   member of each point: the same links' closure from a bounded number of rows per member.
5. Components over the links (``components``); the label is the smallest doc_id reachable.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.components import components
from affinity.llm.shared import slices_of, staged

_BITS_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle_words: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit fingerprint of a text; 0 if it has no word.

    A-Z are lower-cased, words are runs of non-``[\\x20\\x09-\\x0D]``, shingles are joined by one space.
    """
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle_words:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: n - shingle_words + 1].tolist()
    ends = (ends[shingle_words - 1 :] - 1).tolist()
    digest, total, ones = xxhash.xxh64_intdigest, len(ends), np.zeros(64, np.int64)
    for at in range(0, total, _BITS_AT_ONCE):
        to = at + _BITS_AT_ONCE
        h = np.array([digest(joined[a:b], seed) for a, b in zip(starts[at:to], ends[at:to])], ">u8")
        ones += np.unpackbits(h.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > total).tobytes(), "big")


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3
) -> DataFrame:
    """``(doc_id, fp)`` for every row; ``fp`` is the fingerprint's 64 bits as a signed long."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            h = [fingerprint(t, shingle_words) for part in slices_of(batch, 1) for t in part]
            h = np.array(h, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(h)], ["doc_id", "fp"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, fp bigint"
    )


def _runs(max_bits: int) -> list[list[int]]:
    return [r.tolist() for r in np.array_split(np.arange(8), max_bits + 2)]


def _mask(positions) -> int:
    """The bits of the given byte positions as a signed long."""
    m = sum(0xFF << (8 * p) for p in positions)
    return m - (1 << 64) if m >> 63 else m


def fingerprint_links(prints: DataFrame, max_bits: int = 2, dense_list: int = 48) -> DataFrame:
    """Edges ``(u, v)`` between distinct fingerprints ``prints(fp)`` whose closure is that of all
    pairs at most ``max_bits`` (0 to 6) bits apart."""
    if not 0 <= max_bits <= 6:
        raise ValueError("max_bits must be 0 to 6")
    masks = [_mask(a + b) for a, b in combinations(_runs(max_bits), 2)]
    posting = F.explode(
        F.array(*[F.struct(F.lit(i).alias("list"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)])
    )
    index = prints.select("fp", posting.alias("p")).select("p.list", "p.key", "fp")
    sizes = index.groupBy("list", "key").agg(F.count("*").alias("size")).where("size > 1")
    index = staged(index.join(sizes, ["list", "key"]), "postings")

    short = index.where(F.col("size") <= dense_list)
    a = short.select("list", "key", F.col("fp").alias("u"))
    b = short.select("list", "key", F.col("fp").alias("v"))
    differ = F.col("u").bitwiseXOR(F.col("v"))
    tally = sum(F.when(differ.bitwiseAND(F.lit(_mask([p]))) == 0, 1).otherwise(0) for p in range(8))
    pairs = (
        a.join(b, ["list", "key"])
        .where("u < v")
        .where(tally >= 8 - max_bits)
        .where(F.bit_count(differ) <= max_bits)
        .select("u", "v")
    )

    dense = index.where(F.col("size") > dense_list)
    points = None
    for i, m in enumerate(masks):
        free = [p for p in range(64) if not (m >> p) & 1]
        flips = [0] + [sum(1 << p for p in c) for r in range(1, (max_bits + 1) // 2 + 1) for c in combinations(free, r)]
        flips = [f - (1 << 64) if f >> 63 else f for f in flips]
        at = dense.where(F.col("list") == i).select(
            "list", "fp", F.explode(F.array(*[F.lit(f) for f in flips])).alias("flip")
        )
        points = at if points is None else points.union(at)
    met = (
        points.select("list", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"), "fp")
        .groupBy("list", "point")
        .agg(F.min("fp").alias("u"), F.collect_set("fp").alias("all"))
        .where(F.size("all") > 1)
        .select("u", F.explode("all").alias("v"))
        .where("u <> v")
    )
    if max_bits % 2:  # balls of odd distances also meet one bit too far: check, or pair that point's members
        raise_to = F.bit_count(F.col("u").bitwiseXOR(F.col("v")))
        both = points.select("list", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"), F.col("fp"))
        left = both.withColumnRenamed("fp", "u")
        right = both.withColumnRenamed("fp", "v")
        met = left.join(right, ["list", "point"]).where("u < v").where(raise_to <= max_bits).select("u", "v")
    return pairs.union(met).distinct()


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 3,
    max_bits: int = 2,
    dense_list: int = 48,
) -> DataFrame:
    """``(doc_id, fp, component_id)`` per row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at most ``max_bits`` differing bits,
    itself included. Null and empty texts have fingerprint 0 and link like any other. Rows with a null
    id link too but never name a component (null if a component has no id at all). Repeated rows give
    repeated results. Other columns are ignored; an empty table gives an empty result.
    """
    marked = staged(fingerprints(docs, id_col, text_col, shingle_words), "prints")
    prints = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct_prints")
    roots = components(fingerprint_links(prints, max_bits, dense_list))
    rooted = prints.join(roots, prints["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    rooted = staged(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each component stays: the one with the smallest id, every column as it was.

    Rows that repeat that id all stay; a row with a null id stays (it can't be named as a copy).
    """
    found = simhash_components(docs, id_col, text_col, **options)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["__gone"], "left_anti")
