"""Target-distribution importance resampling over hashed n-gram features.

A document's features are its runs of 1 to ``n`` consecutive words; a feature falls into the bucket of its
CRC-32. Buckets are counted over all documents and over all target texts, a bucket's gain is the scaled log
ratio of the two smoothed shares, a document's weight the mean gain of its features. A seeded Gumbel draw per
document is added to the weight, and the highest sums are the sample: a draw without replacement in
proportion to the importance weights.

The CRCs are computed for the distinct features of a run of texts at once: features of equal length are the
rows of a two-dimensional uint8 array, every column updates the CRCs of all its rows by one table look-up, and
the results are scattered back to the features' places. Features over ``LONGEST_COLUMN`` bytes, whose columns
would hold next to no rows, take zlib's CRC-32 one by one: the same numbers.

Texts are read as bytes, so invalid UTF-8 is taken as it is. A very long text is cut between words into pieces
that share one word, so memory is bounded and no feature is lost.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm.shared import received, sent, staged
from affinity.operators.ids import numbered

#: bytes of texts taken together, bytes of one CRC matrix, longest feature that is a matrix row
RUN_BYTES, MATRIX_BYTES, LONGEST_COLUMN = 1 << 21, 1 << 22, 256


def crc_table() -> np.ndarray:
    """The 256 remainders of the reflected polynomial of CRC-32."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


def byte_classes() -> tuple[np.ndarray, np.ndarray]:
    """Per byte: whether it belongs to a word, and its lower-case form (A to Z only)."""
    byte = np.arange(256)
    upper = (byte >= 0x41) & (byte <= 0x5A)
    lower = np.where(upper, byte + 32, byte).astype(np.uint8)
    word = ((byte >= 0x30) & (byte <= 0x39)) | upper | ((byte >= 0x61) & (byte <= 0x7A)) | (byte >= 0x80)
    return word, lower


TABLE = crc_table()
IS_WORD, LOWER = byte_classes()
WORD = re.compile(rb"[0-9A-Za-z\x80-\xFF]+")


def crc32_of(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of the byte strings ``data[start : start + length]``."""
    out = np.empty(len(start), np.uint32)
    order = np.argsort(length, kind="stable")
    sizes, first = np.unique(length[order], return_index=True)
    for size, rows in zip(sizes.tolist(), np.split(order, first[1:])):
        if size > LONGEST_COLUMN:
            for i in rows.tolist():
                out[i] = zlib.crc32(data[start[i] : start[i] + size])
            continue
        at_once = max(1, MATRIX_BYTES // max(1, size))
        for k in range(0, len(rows), at_once):
            part = rows[k : k + at_once]
            matrix = data[start[part] + np.arange(size)[:, None]]  # one array row per byte place
            crc = np.full(len(part), 0xFFFFFFFF, np.uint32)
            for column in matrix:
                crc = TABLE[(crc ^ column) & 0xFF] ^ (crc >> np.uint32(8))
            out[part] = ~crc
    return out


def occurrence(codes: np.ndarray, n: int) -> np.ndarray:
    """For each of the codes 0..n-1, a place where it occurs."""
    place = np.empty(n, np.int64)
    place[codes] = np.arange(len(codes))
    return place


def _codes(values: pa.Array) -> tuple[np.ndarray, int]:
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(coded.dictionary)


def features_of(texts: list[bytes], carried: list[int], n: int, buckets: int):
    """``(owner, bucket)`` of every feature of a run of texts, and the words of each text.

    The first ``carried[i]`` words of text i were counted with the piece before it: features that end in
    them are left out.
    """
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    word = IS_WORD[raw]
    behind = np.zeros(len(raw), bool)
    behind[1:] = word[:-1] & ~word[1:]  # the byte behind a word becomes its one space
    data = np.where(word, LOWER[raw], 32).astype(np.uint8)[word | behind]
    end = np.nonzero(data == 32)[0]
    if not len(end):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    start = np.concatenate(([0], end[:-1] + 1))
    limits = np.cumsum([len(t) + 1 for t in texts])
    owner = np.searchsorted(limits, np.nonzero(behind)[0] - 1, side="right")
    words = np.bincount(owner, minlength=len(texts))
    place_in_text = np.arange(len(owner)) - (np.cumsum(words) - words)[owner]
    old = place_in_text < np.asarray(carried)[owner]
    # distinct words, then distinct runs of k words as pairs (run of k - 1 words, last word)
    offsets = np.concatenate((start, end[-1:] + 1)).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    ids, n_ids = _codes(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), buffers))
    codes, count = ids, n_ids
    owners, found = [], []
    for k in range(1, min(n, len(start)) + 1):
        if k > 1:
            codes, count = _codes(pa.array(codes[:-1] * n_ids + ids[k - 1 :]))
        at = occurrence(codes, count)
        crc = crc32_of(data, start[at], end[at + k - 1] - start[at])
        last = np.arange(k - 1, len(start))
        use = (owner[last] == owner[last - k + 1]) & ~old[last]
        owners.append(owner[last][use])
        found.append((crc % np.uint32(buckets)).astype(np.int64)[codes][use])
    return np.concatenate(owners), np.concatenate(found), words - np.bincount(owner[old], minlength=len(texts))


def pieces(text: bytes | None, n: int, size: int = RUN_BYTES):
    """``(bytes, carried words)``: a text, or a very long one cut between words so that each piece begins with
    the last ``n - 1`` words of the one before."""
    text = text or b""
    at, carried, cut = 0, 0, size
    while cut < len(text):
        within = WORD.match(text, cut - 1)
        cut = within.end() if within else cut
        starts = [m.start() for m in WORD.finditer(text, at, cut)]
        back = cut if n == 1 else starts[1 - n] if len(starts) >= n else at
        if back > at:  # else the piece grows
            yield text[at:cut], carried
            at, carried = back, n - 1
        cut += size
    yield text[at:], carried


def runs(batch: pa.RecordBatch, column: int, n: int):
    """Runs of texts of about ``RUN_BYTES`` bytes: ``(rows, texts, carried)``; a text's pieces follow each other."""
    rows, texts, carried, size = [], [], [], 0
    for i, value in enumerate(batch.column(column)):
        for text, again in pieces(value.as_py(), n):
            rows.append(i)
            texts.append(text)
            carried.append(again)
            size += len(text)
            if size >= RUN_BYTES:
                yield np.array(rows), texts, carried
                rows, texts, carried, size = [], [], [], 0
    if rows:
        yield np.array(rows), texts, carried


def bucket_counts(texts: DataFrame, text_col: str, n: int, buckets: int) -> np.ndarray:
    """Features per bucket over all texts. A task sends one row per bucket that occurs in it; the driver gets
    ``buckets`` sums."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, part, carried in runs(batch, 0, n):
                total += np.bincount(features_of(part, carried, n, buckets)[1], minlength=buckets)
        used = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    counted = texts.select(F.col(text_col).cast("string").cast("binary").alias("text")).mapInArrow(run, "bucket long, n long")
    found = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        found[row["bucket"]] = row["n"]
    return found


def bucket_gains(source: np.ndarray, target: np.ndarray, scale: float = 1000.0) -> np.ndarray:
    """Per bucket, the floor of ``scale`` times the log ratio of its add-one-smoothed shares in target and source."""
    n = len(source)
    s_all, t_all = float(source.sum() + n), float(target.sum() + n)
    pairs = zip(source.tolist(), target.tolist())
    return np.array([math.floor(scale * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in pairs], np.int64)


def weights(docs: DataFrame, gains: np.ndarray, id_col: str, text_col: str, n: int) -> DataFrame:
    """``(doc_id, n_words, n_features, weight)`` of every row: the floored mean gain of its features."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = sent(docs.sparkSession, gains)

    def run(batches):
        gain = received(shared)
        for batch in batches:
            words, count, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for rows, part, carried in runs(batch, 1, n):
                owner, bucket, own_words = features_of(part, carried, n, len(gain))
                np.add.at(words, rows, own_words)
                np.add.at(count, rows[owner], 1)
                np.add.at(total, rows[owner], gain[bucket])
            weight = np.where(count > 0, total // np.maximum(count, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, (words, count, weight))], ["doc_id", "n_words", "n_features", "weight"]
            )

    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text")
    ).mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def gumbel(id_col: str, seed: int, scale: float = 1000.0) -> Column:
    """A Gumbel draw, scaled and floored, from 32 bits of the SHA-256 of ``seed:id`` (a null id as empty text)."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("bigint")
    u = (h.cast("double") + 0.5) / 4294967296.0
    return F.floor(-scale * F.log(-F.log(u))).cast("bigint")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    min_words: int = 20,
    ngrams: int = 2,
    buckets: int = 10_000,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score, rank)``: one row per document, ``rank`` 1, 2, … for the
    ``percent`` per cent of the documents with at least ``min_words`` words that score highest, else null.

    Null and empty texts have no features and weight 0. Ties in score go to the smaller id, a null id last;
    rows equal in both are ranked by their features, then in any order. Repeated rows are documents of
    their own. Other columns are ignored. Without target texts every bucket's target share is equal; an
    empty table gives an empty result.

    The cut is found from a count per score (scores are scaled logs, so their number does not follow the
    input); only rows from the cut upwards are sorted, in range partitions.
    """
    if not 0 <= percent <= 100 or ngrams < 1 or buckets < 1:
        raise ValueError("percent must be 0 to 100, ngrams and buckets at least 1")
    gains = bucket_gains(
        bucket_counts(docs, text_col, ngrams, buckets), bucket_counts(target, target_col, ngrams, buckets)
    )
    scored = weights(docs, gains, id_col, text_col, ngrams).withColumn("score", F.col("weight") + gumbel("doc_id", seed))
    scored = staged(scored, "importance")
    eligible = F.col("n_words") >= min_words
    per_score = scored.where(eligible).groupBy("score").agg(F.count("*").alias("n"))
    tally = sorted(((r["score"], r["n"]) for r in per_score.collect()), reverse=True)
    wanted, seen, cut = percent * sum(n for _, n in tally) // 100, 0, None
    for score, n in tally:
        if seen >= wanted:
            break
        cut, seen = score, seen + n
    no_rank = F.lit(None).cast("bigint")
    if cut is None:
        return scored.withColumn("rank", no_rank)
    above = eligible & (F.col("score") >= cut)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    top = numbered(scored.where(above), order, "place")
    drawn = top.withColumn("rank", F.when(F.col("place") < wanted, F.col("place") + 1)).drop("place")
    return drawn.unionByName(scored.where(~above).withColumn("rank", no_rank))
