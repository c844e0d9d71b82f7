"""Quality classifier: a Gaussian kernel on document statistics, by random Fourier features.

Every text is described by a few statistics: length, shares of character classes, word lengths, and how much
it repeats itself. Statistics are sums over blocks of ``BLOCK`` words, so a very long text is read in pieces
with the same result, and vocabulary shares do not sink with the length of a text. The standardised
statistics are mapped to random cosines whose inner products approximate a Gaussian kernel; a ridge
regression of the labels on these features is solved from the normal equations, which every task sums over
its own rows; isotonic regression on labelled rows kept from the fit turns ridge scores into
probabilities.

The cosines are rounded to 1 / ``STEPS`` and kept as integers. So the sums of the normal equations are exact,
the model is the same however the rows are partitioned, and a text's score does not depend on the texts it
is scored with. All labelled rows take part; what reaches the driver has the size of the model.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.shared import in_fold, received, sent, staged

BLOCK, RUN_BYTES, STEPS, BINS = 1024, 1 << 21, 4096, 4096
SPACE, DIGIT, UPPER, LOWER, STOP, MARK, BEYOND = range(7)
COUNTS = "bytes words lines digit upper lower stop mark beyond distinct top repeats pairs odd bare capital squares".split()
N_STATS = 17


def byte_classes() -> np.ndarray:
    """The class of each byte; ``STOP`` are the full stop and comma, ``MARK`` any other ASCII sign."""
    byte = np.arange(256)
    kind = np.full(256, MARK)
    kind[(byte <= 32) | (byte == 127)] = SPACE
    kind[(byte >= ord("0")) & (byte <= ord("9"))] = DIGIT
    kind[(byte >= ord("A")) & (byte <= ord("Z"))] = UPPER
    kind[(byte >= ord("a")) & (byte <= ord("z"))] = LOWER
    kind[[ord("."), ord(",")]] = STOP
    kind[byte >= 128] = BEYOND
    return kind.astype(np.uint8)


CLASS = byte_classes()


def _codes(values: pa.Array) -> tuple[np.ndarray, int]:
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(coded.dictionary)


def counts_of(texts: list[bytes]) -> np.ndarray:
    """The counts ``COUNTS`` of each text; words are runs of anything but ASCII controls and spaces."""
    n = len(texts)
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    kind = CLASS[raw]
    sizes = np.array([len(t) for t in texts], np.int64)
    text_of = np.repeat(np.arange(n), sizes + 1)
    out = np.zeros((n, len(COUNTS)), np.int64)
    put = {name: k for k, name in enumerate(COUNTS)}
    per_class = np.bincount(text_of * 7 + kind, minlength=7 * n).reshape(n, 7)
    out[:, put["bytes"]] = sizes
    out[:, put["lines"]] = np.bincount(text_of[raw == 10], minlength=n)
    for name, k in (("digit", DIGIT), ("upper", UPPER), ("lower", LOWER), ("stop", STOP), ("mark", MARK), ("beyond", BEYOND)):
        out[:, put[name]] = per_class[:, k]
    word = kind != SPACE
    edge = np.diff(word.astype(np.int8), prepend=0)
    start, end = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
    if not len(start):
        return out
    owner, length = text_of[start], end - start
    words = np.bincount(owner, minlength=n)
    place = np.arange(len(owner)) - (np.cumsum(words) - words)[owner]
    block = owner * (int(words.max()) // BLOCK + 1) + place // BLOCK
    offsets = np.concatenate((start, [len(raw)])).astype(np.int64)
    spaced = np.where(word, raw, 32).astype(np.uint8)  # a word and the white space behind it are its entry ...
    keep = word.copy()
    keep[end] = True  # ... cut to one space
    offsets = np.concatenate(([0], np.cumsum(keep)))[offsets]
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(spaced[keep])]
    ids, n_ids = _codes(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), buffers))
    seen, times = np.unique(block * n_ids + ids, return_counts=True)
    seen_block = seen // n_ids
    first = np.concatenate(([0], np.nonzero(np.diff(seen_block))[0] + 1))
    block_text = np.empty(int(block[-1]) + 1, np.int64)
    block_text[block] = owner
    out[:, put["words"]] = words
    out[:, put["distinct"]] = np.bincount(block_text[seen_block], minlength=n)
    np.add.at(out[:, put["top"]], block_text[seen_block[first]], np.maximum.reduceat(times, first))
    same = block[1:] == block[:-1]
    out[:, put["repeats"]] = np.bincount(owner[1:][same & (ids[1:] == ids[:-1])], minlength=n)
    if same.any():
        pair, n_pairs = _codes(pa.array((ids[:-1] * n_ids + ids[1:])[same]))
        pair_seen = np.unique(block[1:][same] * n_pairs + pair) // n_pairs
        out[:, put["pairs"]] = np.bincount(block_text[pair_seen], minlength=n)
    letters = np.concatenate(([0], np.cumsum((kind == LOWER) | (kind == UPPER) | (kind == BEYOND) | (kind == DIGIT))))
    out[:, put["odd"]] = np.bincount(owner[kind[end - 1] == MARK], minlength=n)
    out[:, put["bare"]] = np.bincount(owner[letters[end] == letters[start]], minlength=n)
    out[:, put["capital"]] = np.bincount(owner[kind[start] == UPPER], minlength=n)
    np.add.at(out[:, put["squares"]], owner, np.minimum(length, 255) ** 2)
    return out


def statistics_of(counts: np.ndarray) -> np.ndarray:
    """``N_STATS`` numbers of a text from its counts; a text without words has zeros wherever words divide."""
    c = {name: counts[:, k].astype(np.float64) for k, name in enumerate(COUNTS)}
    size, words = np.maximum(c["bytes"], 1), np.maximum(c["words"], 1)
    word_bytes = c["digit"] + c["upper"] + c["lower"] + c["stop"] + c["mark"] + c["beyond"]
    mean = word_bytes / words
    columns = [
        np.log1p(c["words"]), np.log1p(mean), np.log1p(c["words"] / (c["lines"] + 1)),
        np.sqrt(c["digit"] / size), np.sqrt(c["upper"] / size), c["lower"] / size, c["stop"] / size,
        np.sqrt(c["mark"] / size), c["beyond"] / size,
        c["distinct"] / words, np.sqrt(c["top"] / words), np.sqrt(c["repeats"] / words), c["pairs"] / words,
        np.sqrt(c["odd"] / words), np.sqrt(c["bare"] / words), np.sqrt(c["capital"] / words),
        np.log1p(np.sqrt(c["squares"] / words)),
    ]
    return np.stack(columns, axis=1)


def pieces(text: bytes, size: int = RUN_BYTES):
    """A text, or parts of a very long one that hold whole blocks of words."""
    at = 0
    while len(text) - at > size:
        end = at + size
        while True:  # the last start of a block within the part
            word = CLASS[np.frombuffer(text, np.uint8, min(end, len(text)) - at, at)] != SPACE
            starts = np.nonzero(np.diff(word.astype(np.int8), prepend=0) == 1)[0]
            if len(starts) > BLOCK or end >= len(text):
                break
            end += size
        if len(starts) <= BLOCK:
            break
        cut = at + int(starts[(len(starts) - 1) // BLOCK * BLOCK])
        yield text[at:cut]
        at = cut
    yield text[at:]


def _runs(batch: pa.RecordBatch, column: int):
    """``(rows, texts)`` of about ``RUN_BYTES`` bytes at a time."""
    rows, texts, size = [], [], 0
    for i, value in enumerate(batch.column(column)):
        for text in pieces(value.as_py() or b""):
            rows.append(i)
            texts.append(text)
            size += len(text)
            if size >= RUN_BYTES:
                yield rows, texts
                rows, texts, size = [], [], 0
    if rows:
        yield rows, texts


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, x)`` of every row: its statistics over the whole text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            counts = np.zeros((batch.num_rows, len(COUNTS)), np.int64)
            for rows, texts in _runs(batch, 1):
                np.add.at(counts, rows, counts_of(texts))
            x = statistics_of(counts)
            values = pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), N_STATS).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), values], ["id", "x"])

    return docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text")
    ).mapInArrow(run, f"id {kind}, x array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATS)


@dataclass
class Features:
    """Random cosines over standardised statistics, as integers of at most ``STEPS``, and a constant."""

    mean: np.ndarray
    deviation: np.ndarray
    direction: np.ndarray  # statistics x cosines
    phase: np.ndarray

    @classmethod
    def drawn(cls, mean, deviation, n: int, width: float, seed: int) -> "Features":
        rng = np.random.default_rng(seed)
        return cls(mean, deviation, rng.normal(0, 1 / width, (len(mean), n)), rng.uniform(0, 2 * np.pi, n))

    def of(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.deviation, -8, 8)
        angle = np.broadcast_to(self.phase, (len(x), len(self.phase))).copy()
        for j in range(x.shape[1]):  # not a matrix product: its last digits follow the number of rows
            angle += x[:, j, None] * self.direction[j]
        z = np.rint(np.cos(angle) * STEPS).astype(np.int64)
        return np.concatenate([z, np.full((len(z), 1), STEPS)], axis=1)


@dataclass
class Model:
    features: Features | None
    weight: np.ndarray | None  # integers; a score is their product with the features over ``unit``
    unit: float
    knots: np.ndarray  # of the calibration curve: ridge scores and probabilities
    values: np.ndarray

    def ridge(self, x: np.ndarray) -> np.ndarray:
        found = [self.features.of(x[at : at + 4096]) @ self.weight for at in range(0, len(x), 4096)]
        return np.concatenate(found or [np.zeros(0, np.int64)]) / self.unit

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.features is None:
            return np.full(len(x), self.values[0])
        return np.interp(self.ridge(x), self.knots, self.values)


def moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of every statistic; the sums are over whole multiples of 1 / 1024, so exact."""

    def run(batches):
        total = np.zeros((3, N_STATS), np.int64)
        for batch in batches:
            x = np.rint(_matrix(batch.column(0)) * 1024).astype(np.int64)
            total += [x.sum(axis=0), (x * x).sum(axis=0), np.full(N_STATS, len(x))]
        yield pa.RecordBatch.from_arrays([pa.array(range(N_STATS), pa.int64()), *map(pa.array, total)], ["j", "s", "q", "n"])

    sums = rows.select("x").mapInArrow(run, "j long, s long, q long, n long")
    sums = sums.groupBy("j").agg(*[F.sum(F.col(c).cast("decimal(30,0)")).alias(c) for c in "sqn"])
    found = sorted((r["j"], int(r["s"]), int(r["q"]), int(r["n"])) for r in sums.collect())  # a row per statistic
    mean = np.array([s / n / 1024 for _, s, _, n in found])
    variance = np.array([(q * n - s * s) / n / n / 1024**2 for _, s, q, n in found])
    return mean, np.sqrt(np.maximum(variance, 1e-6))


def _added(rows: list[bytes]) -> bytes:
    return np.sum([np.frombuffer(r, np.int64) for r in rows], axis=0).tobytes()


def normal_equations(rows: DataFrame, features: Features) -> np.ndarray:
    """``M' M`` for M = (features, label), summed by tasks over their own rows, then over groups of tasks, then
    over the groups: no task adds up more than one matrix row of each group or task."""
    spark = rows.sparkSession
    shared = sent(spark, features)
    side = len(features.phase) + 2

    def run(batches):
        from pyspark import TaskContext

        own, total = received(shared), np.zeros((side, side))
        for batch in batches:
            x, y = _matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
            for at in range(0, len(x), 4096):
                z = own.of(x[at : at + 4096])
                m = np.concatenate([z, y[at : at + 4096, None] * STEPS], axis=1).astype(np.float64)
                total += m.T @ m  # whole numbers under 2^53 for up to 2^29 rows a task: exact
        salt = TaskContext.get().partitionId() % 512
        sums = [row.astype(np.int64).tobytes() for row in total]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(side), pa.int64()), pa.array([salt] * side, pa.int64()), pa.array(sums, pa.binary())],
            ["i", "salt", "sums"],
        )

    def add(table: pa.Table) -> pa.Table:
        merged = _added(table.column("sums").to_pylist())
        return pa.table({"i": table.column("i")[:1], "sums": pa.array([merged], pa.binary())})

    parts = rows.select("x", "y").mapInArrow(run, "i long, salt long, sums binary")
    grouped = parts.groupBy("i", "salt").applyInArrow(add, "i long, sums binary")
    whole = grouped.groupBy("i").applyInArrow(add, "i long, sums binary")
    found = sorted((r["i"], bytes(r["sums"])) for r in whole.collect())  # ``side`` rows of ``side`` numbers
    return np.stack([np.frombuffer(r, np.int64) for _, r in found])


def isotonic(x: np.ndarray, ones: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the rising curve nearest to the shares ``ones / n`` at rising ``x`` (pool adjacent violators); each
    pooled block is one knot at its mean."""
    blocks: list[list[float]] = []  # sum of x, ones, rows
    for a, b, c in zip((x * n).tolist(), ones.tolist(), n.tolist()):
        blocks.append([a, b, c])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [u + v for u, v in zip(blocks[-1], last)]
    return np.array([a / c for a, _, c in blocks]), np.array([(b + 0.01) / (c + 0.02) for _, b, c in blocks])


def fit(
    rows: DataFrame, n_features: int = 256, width: float = 3.0, penalty: float = 1e-3, seed: int = 11
) -> Model:
    """The classifier from labelled rows ``(id, x, y)``, y 0 or 1. Every fourth row, by a hash of its id,
    calibrates; the others enter the normal equations. Without both classes, the smoothed share of ones."""
    own = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(5)), F.lit(4))
    count = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    none = Model(None, None, 1.0, np.zeros(1), np.array([(count.get(1, 0) + 1) / (sum(count.values()) + 2)]))
    if len(count) < 2:
        return none
    mean, deviation = moments(rows)
    features = Features.drawn(mean, deviation, n_features, width, seed)
    both = normal_equations(rows.where(own != 3), features).astype(np.float64) / STEPS**2
    n = max(1.0, both[-2, -2])  # the constant's square summed: the number of rows
    gram, target = both[:-1, :-1] / n, both[:-1, -1] / n
    shrink = np.full(len(gram), penalty)
    shrink[-1] = 1e-9  # the constant is not shrunk
    weight = np.linalg.solve(gram + np.diag(shrink), target)
    scale = 2.0 ** np.floor(np.log2(2.0**51 / (STEPS * max(1e-9, np.abs(weight).sum()))))
    model = Model(features, np.rint(weight * scale).astype(np.int64), scale * STEPS, np.zeros(1), np.zeros(1))
    shared = sent(rows.sparkSession, model)

    def run(batches):
        ridge = received(shared).ridge
        for batch in batches:
            bins = np.clip(np.floor(ridge(_matrix(batch.column(0))) * BINS / 2), -BINS, 2 * BINS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column(1)], ["bin", "y"])

    def tally(part: DataFrame) -> list:
        binned = part.select("x", F.col("y").cast("long").alias("y")).mapInArrow(run, "bin long, y long")
        return sorted(tuple(r) for r in binned.groupBy("bin").agg(F.sum("y"), F.count("*")).collect())  # a row per bin

    found = tally(rows.where(own == 3))
    if not 0 < sum(f[1] for f in found) < sum(f[2] for f in found):
        found = tally(rows)
    at, ones, n_rows = (np.array(c, np.float64) for c in zip(*found))
    model.knots, model.values = isotonic((at + 0.5) * 2 / BINS, ones, n_rows)
    return model


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    folds: int = 5,
    held_out_fold: int = 0,
    threshold: float = 0.3,
    **options,
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``: learn on the other folds, score every whole text.

    The score is the probability of label 1. Null texts count as empty, and an empty text has the statistics
    of a text without words. Labels other than 0 and 1 and labels without an id are not used; several
    labels of an id are one (the largest), and every row of a repeated id is labelled alike. A null id is
    never labelled. Without labels of both classes every score is the smoothed share of ones (0.5 without
    any). Texts are read as bytes, so invalid UTF-8 is no error. Other columns are ignored; an empty table
    gives an empty result.
    """
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("y"))
        .where(~in_fold("id", folds, held_out_fold))
    )
    described = staged(statistics(docs, id_col, text_col), "statistics")
    model = fit(staged(described.join(known, "id"), "labelled"), **options)
    shared = sent(docs.sparkSession, model)

    def run(batches):
        own = received(shared)
        for batch in batches:
            scores = np.clip(own.score(_matrix(batch.column(1))), 0.0, 1.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc_id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return described.mapInArrow(run, f"doc_id {kind}, score double").select(
        "doc_id",
        in_fold("doc_id", folds, held_out_fold).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
