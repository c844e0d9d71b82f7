"""Cost-balanced packing of tokenized documents into sequences of a fixed length.

One pass, no shuffle: a task tokenizes its rows and packs them in groups of about ``group_tokens``
tokens. A group of T tokens gets floor(T / length) full sequences, and the rest of its tokens go to
sequences whose lengths are powers of two, which need no padding. A piece of n tokens is estimated
to cost ``linear * n + quadratic * n * n`` (the quadratic term is attention). Documents are placed in
descending length: whole sequences are cut off documents longer than one, then each remainder
goes to the sequence of lowest cost that still has room, cut where it ends.
"""

from __future__ import annotations

import heapq
import json

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.shared import slices_of

PIECES = (
    "start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
)


def load_encoder(path: str | None = None, special_as_text: bool = False):
    """``str -> uint32 ids`` for a byte-level BPE file of the ``tokenizers`` format.

    The vocabulary and the split pattern of that file run in ``tiktoken`` (several times faster);
    the tests compare the ids with those of ``tokenizers``.
    """
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    # the byte alphabet: printable bytes stand for themselves, the others for 256, 257, ...
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    coder = tiktoken.Encoding(
        "packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
    )
    allowed = set() if special_as_text else set(special)

    def encode(text: str) -> np.ndarray:
        return np.asarray(coder.encode_to_numpy(text, allowed_special=allowed, disallowed_special=()), "<u4")

    return encode


def split_points(text: str, at_most: int) -> list[int]:
    """Places to cut a long text where no token can span: before a single space between non-spaces."""
    cuts, last = [0], 0
    while len(text) - last > at_most:
        i = text.find(" ", last + at_most)
        while i >= 0 and (i + 1 >= len(text) or text[i - 1].isspace() or text[i + 1].isspace()):
            i = text.find(" ", i + 1)
        if i < 0:
            break
        cuts.append(i)
        last = i
    return [*cuts, len(text)]


def pack_lengths(lengths: list[int], size: int, linear: float, quadratic: float):
    """Pieces ``(document, start, length, sequence, offset)`` that hold every token once."""
    total = sum(lengths)
    pieces, rest = [], []
    n_full, left = divmod(total, size)
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    used = 0
    for i in order:
        start = 0
        while lengths[i] - start >= size:
            pieces.append((i, start, size, used, 0))
            used += 1
            start += size
        if start < lengths[i]:
            rest.append((lengths[i] - start, i, start))
    rest.sort(key=lambda r: (-r[0], r[1]))
    heap = [(0.0, s) for s in range(used, n_full)]
    filled = [0] * n_full
    tails = [(n_full + k, 1 << b) for k, b in enumerate(b for b in range(left.bit_length())[::-1] if left >> b & 1)]
    tails.reverse()
    tail_at = 0
    for n, i, start in rest:
        while n:
            if heap:
                cost, s = heapq.heappop(heap)
                take = min(n, size - filled[s])
                pieces.append((i, start, take, s, filled[s]))
                filled[s] += take
                if filled[s] < size:
                    heapq.heappush(heap, (cost + linear * take + quadratic * take * take, s))
            else:
                s, room = tails[-1]
                take = min(n, room - tail_at)
                pieces.append((i, start, take, s, tail_at))
                tail_at += take
                if tail_at == room:
                    tails.pop()
                    tail_at = 0
            n -= take
            start += take
    return pieces, n_full + bin(left).count("1")


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 1024,
    linear: float = 1.0,
    quadratic: float = 1 / 1024,
    group_tokens: int = 1 << 21,
    end_id: int = 0,
    tokenizer_path: str | None = None,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are little-endian unsigned 32-bit token ids. Each document is its tokens and ``end_id``; a
    null or empty text is ``end_id`` alone. Null and repeated ids are packed like any others, each row
    on its own; ties in length go by input order. ``length`` must be a power of two or any positive
    number; memory per task is bounded by ``group_tokens`` and the longest document. Other columns
    are ignored; an empty table gives an empty result. ``sequence_id`` is unique in the result.
    """
    if length < 1 or group_tokens < 1:
        raise ValueError("length and group_tokens must be positive")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        encode = load_encoder(tokenizer_path)
        first = TaskContext.get().partitionId() << 40
        ids, tokens, held = [], [], 0

        def flush():
            nonlocal first, ids, tokens, held
            pieces, n = pack_lengths([len(t) for t in tokens], length, linear, quadratic)
            for at in range(0, len(pieces), 4096):
                d, start, size, seq, offset = zip(*pieces[at : at + 4096])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[i] for i in d], id_type),
                        pa.array(start, pa.int64()),
                        pa.array(size, pa.int64()),
                        pa.array([tokens[i][s : s + k].tobytes() for i, s, k in zip(d, start, size)], pa.binary()),
                        pa.array([len(tokens[i]) for i in d], pa.int64()),
                        pa.array([first + s for s in seq], pa.int64()),
                        pa.array(offset, pa.int64()),
                    ],
                    ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
                )
            first += n
            ids, tokens, held = [], [], 0

        id_type, end = None, np.array([end_id], "<u4")
        for batch in batches:
            id_type = batch.schema.field(0).type
            keys = batch.column(0).to_pylist()
            for key, text in zip(keys, (t for part in slices_of(batch, 1) for t in part)):
                cuts = split_points(text or "", 1 << 20)
                found = [encode(text[a:b]) for a, b in zip(cuts, cuts[1:])] if text else []
                ids.append(key)
                tokens.append(np.concatenate([*found, end]))
                held += len(tokens[-1])
                if held >= group_tokens:
                    yield from flush()
        if held:
            yield from flush()

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, {PIECES}"
    )
