"""Language identification with language-bitmask n-gram filters.

One bit-sliced Bloom filter holds the n-grams of all languages: a cell is a bitmask with a bit per
language, and the AND of an n-gram's cells gives every language that contains it. A text's n-grams are
looked up, the bits counted per language, each count is corrected for the false positives that the
language's fill makes likely, and the corrected shares decide.

The filters are learnt from a bounded sample of labelled rows per language (``sample_docs``), chosen by
a hash of the id; counting, thresholds and the cells' OR run as one Spark job, and only the cells of the
filter (``2 ** cell_bits`` at most) come to the driver, which broadcasts them.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm.shared import in_fold, received, sent, slices_of

LETTERS = re.compile(r"[^\W\d_]+")
#: odd multipliers of the n-gram hash (arbitrary, fixed)
STEP, FOLD = np.uint64(0x100000001B3 * 0x9E37 | 1), np.uint64(0xFF51AFD7ED558CCD)
PIECE = 1 << 18
HASHES = 2


def letter_runs(text: str) -> list[str]:
    """Runs of letters; numbers that are no letters (½, ², Ⅷ) end a run."""
    runs = []
    for run in LETTERS.findall(text):  # the pattern takes any numeric character but decimal digits
        if run.isalpha():
            runs.append(run)
        else:
            runs += "".join(c if c.isalpha() else " " for c in run).split()
    return runs


def letter_codes(text: str | None) -> np.ndarray:
    """Code points of the lower-cased letter runs, one space around each; empty if there is no letter."""
    runs = letter_runs((text or "").lower())
    if not runs:
        return np.zeros(0, np.uint64)
    return np.frombuffer(f" {' '.join(runs)} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def gram_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every run of ``n`` codes."""
    m = len(codes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = codes[:m] + np.uint64(n)
    for j in range(1, n):
        h = h * STEP + codes[j : j + m]
    h ^= h >> np.uint64(33)
    h *= FOLD
    return h ^ (h >> np.uint64(29))


def cells_of(h: np.ndarray, cell_bits: int) -> list[np.ndarray]:
    mask = np.uint64((1 << cell_bits) - 1)
    return [((h >> np.uint64(i * 31)) & mask).astype(np.int64) for i in range(HASHES)]


def pieces(codes: np.ndarray, n_max: int):
    """A long text in overlapping pieces, so that memory is bounded; every n-gram of a size lies in one
    piece or, next to a border, is cut off at the same place for all sizes."""
    for at in range(0, max(1, len(codes) - n_max + 1), PIECE):
        yield codes[at : at + PIECE + n_max - 1]


class Filters:
    """The learnt bitmasks and what is needed to score with them."""

    def __init__(self, languages: list[str], table: np.ndarray, sizes: tuple[int, ...], cell_bits: int):
        self.languages, self.table, self.sizes, self.cell_bits = languages, table, sizes, cell_bits
        fill = self.bits(table).mean(axis=0) if len(languages) else np.zeros(0)
        self.false_rate = np.minimum(fill**HASHES, 0.99)

    def bits(self, masks: np.ndarray) -> np.ndarray:
        """0/1 matrix (masks x languages)."""
        raw = np.ascontiguousarray(masks).view(np.uint8).reshape(len(masks), -1)
        return np.unpackbits(raw, axis=1, bitorder="little")[:, : len(self.languages)]

    def counts(self, h: np.ndarray) -> np.ndarray:
        """Per language, the n-grams whose mask holds its bit."""
        masks = None
        for cell in cells_of(h, self.cell_bits):
            masks = self.table[cell] if masks is None else masks & self.table[cell]
        if masks.dtype == np.uint8:
            return np.bincount(masks, minlength=256) @ self.bits(np.arange(256, dtype=np.uint8)).astype(np.int64)
        return self.bits(masks).sum(axis=0, dtype=np.int64)

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score); ``und`` and 0 for a text without letters or without a learnt language."""
        codes = letter_codes(text)
        if not len(codes) or not self.languages:
            return "und", 0.0
        share = np.zeros(len(self.languages))
        for n in self.sizes:
            hits, total = np.zeros(len(self.languages)), 0
            for part in pieces(codes, max(self.sizes)):
                h = gram_hashes(part, n)
                if len(h):
                    hits += self.counts(h)
                    total += len(h)
            if total:  # expected false hits taken off, as a share of the n-grams
                share += np.clip((hits / total - self.false_rate) / (1 - self.false_rate), 0, 1)
        best = int(np.argmax(share))  # ties: the language that is first in sort order
        return self.languages[best], float(share[best] / share.sum()) if share.sum() else 0.0


def learn(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    train: Column | None = None,
    sizes: tuple[int, ...] = (2, 3, 4),
    cell_bits: int = 20,
    sample_docs: int = 1500,
    min_share: float = 3e-5,
) -> Filters:
    """Filters from rows where ``train`` holds and language and text are not null.

    At most about ``sample_docs`` rows per language are read (a hash of the id decides which). An n-gram
    belongs to a language if it makes up ``min_share`` of its n-grams of that size.
    """
    rows = docs.where(F.lit(True) if train is None else train).select(
        F.col(id_col).alias("id"),
        F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    )
    rows = rows.where("lang is not null")
    known = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(100_001).collect()}
    if len(known) > 100_000:
        raise ValueError("more than 100,000 languages")
    languages = sorted(known)
    width = max(1, (len(languages) + 7) // 8)
    width = next((w for w in (1, 2, 4, 8) if w >= width), -(-width // 8) * 8)
    table = np.zeros((1 << cell_bits, width), np.uint8)
    if languages:
        share = rows.sparkSession.createDataFrame(
            [(x, min(1.0, sample_docs / known[x]), i) for i, x in enumerate(languages)], "lang string, p double, bit int"
        )
        draw = F.pmod(F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(7)), F.lit(1 << 20)) / float(1 << 20)
        sample = rows.join(F.broadcast(share), "lang").where(draw < F.col("p")).select("bit", "text")

        def count(batches):
            held: dict[tuple[int, int], list] = {}
            size = 0

            def flush():
                for (bit, n), parts in held.items():
                    grams, times = np.unique(np.concatenate(parts), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(grams), bit, np.int32)),
                            pa.array(np.full(len(grams), n, np.int32)),
                            pa.array(grams.view(np.int64)),
                            pa.array(times.astype(np.int64)),
                        ],
                        ["bit", "n", "gram", "times"],
                    )
                held.clear()

            for batch in batches:
                for bit, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    for part in pieces(letter_codes(text), max(sizes)):
                        for n in sizes:
                            held.setdefault((bit, n), []).append(gram_hashes(part, n))
                        size += len(part)
                        if size > 1 << 22:
                            yield from flush()
                            size = 0
            yield from flush()

        grams = sample.mapInArrow(count, "bit int, n int, gram bigint, times bigint")
        grams = grams.groupBy("bit", "n", "gram").agg(F.sum("times").alias("times"))
        total = grams.groupBy("bit", "n").agg(F.sum("times").alias("total"))
        chosen = grams.join(F.broadcast(total), ["bit", "n"]).where(
            (F.col("times") >= 2) & (F.col("times") >= F.col("total") * min_share)
        )
        mask = (1 << cell_bits) - 1
        cells = F.array(*[F.shiftrightunsigned("gram", i * 31).bitwiseAND(F.lit(mask)) for i in range(HASHES)])
        word = F.floor(F.col("bit") / 8).cast("int")
        rows_in = (
            chosen.select(F.explode(cells).alias("cell"), word.alias("word"), F.expr("shiftleft(1, bit % 8)").alias("bit"))
            .groupBy("cell", "word")
            .agg(F.bit_or("bit").alias("mask"))
        ).toArrow()
        cell, at, value = (rows_in.column(c).to_numpy() for c in ("cell", "word", "mask"))
        table[cell, at] = value.astype(np.uint8)
    if width in (1, 2, 4, 8):
        table = table.view(f"<u{width}").reshape(-1)
    else:
        table = table.view("<u8")
    return Filters(languages, table, sizes, cell_bits)


def predict(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)`` for every whole text."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = sent(docs.sparkSession, filters)

    def run(batches):
        model = received(shared)
        for batch in batches:
            found = [model.predict(t) for part in slices_of(batch, 1) for t in part]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double"
    )


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    folds: int = 4,
    held_out_fold: int = 2,
    **options,
) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``: learn on the other folds, predict every whole text.

    A text that is null or has no letter is ``und`` with score 0, as is every text if nothing could be
    learnt. Rows with a null language are predicted but not learnt from; null and repeated ids are
    predicted like any others. Other columns are ignored; an empty table gives an empty result.
    """
    held = in_fold(id_col, folds, held_out_fold)
    filters = learn(docs, id_col, text_col, lang_col, train=~held, **options)
    found = predict(docs, filters, id_col, text_col)
    return found.select("doc_id", in_fold("doc_id", folds, held_out_fold).alias("held_out"), "lang_pred", "score")
