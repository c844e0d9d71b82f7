"""Substring dedup: a count-min prefilter, then exact grouping of the windows it calls repeated.

A window is ``window`` consecutive words of one document. Each word covered by a window whose word
sequence also starts earlier (smaller id, or same document and earlier start) is removed; windows are
judged on the input.

* The rows are stored once as block files of bounded size in the shared folder; later steps are dealt by
  block, and texts never enter a shuffle.
* First pass: each block sketches its windows. The sketch is split by window hash into shards; a shard
  has two counter rows, sent sparsely (the cells used, and whether more than once). The partition sketches
  of a shard are merged; counters can only overestimate. Each block gets back its cells counted twice or more.
* Second pass: each block picks the windows whose cells are all repeated (every really repeated one is among
  them), marks those that start earlier in the same block, and sends one entry per distinct window: a 96-bit
  hash and its first place. Grouped by hash, an entry that is not the first of its window goes back as a mark.

A hot passage is thus one entry per block, not one per document. The number of shards follows the number
of windows; ``block_bytes`` should grow with the corpus (256 MB for 100 TB), since a block sends a row
to every shard.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.shared import open_store, shared_folder, slices_of, staged

# odd multipliers of the window hash (arbitrary, fixed)
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
NO_ID = np.iinfo(np.int64).max


def words_of(text: str | None) -> list[bytes]:
    """Runs of non-``[\\x20\\x09-\\x0D]``, unchanged."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def _combine(x: np.ndarray, y: np.ndarray, step: int) -> np.ndarray:
    z = x * MIX[0] + ((y << np.uint64(31)) | (y >> np.uint64(33))) * MIX[1] + np.uint64(step)
    z ^= z >> np.uint64(32)
    z *= MIX[2]
    return z ^ (z >> np.uint64(29))


def window_hashes(words: np.ndarray, window: int) -> np.ndarray:
    """Hash of each run of ``window`` word hashes (shorter input: empty), built from runs of powers of two."""
    n = len(words) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, size, acc, at = words, 1, None, 0
    while size <= window:
        if window & size:  # the parts lie one behind the other, smallest first
            part = power[at : at + n]
            acc = part if acc is None else _combine(acc, part, size)
            at += size
        if size * 2 <= window:
            power = _combine(power[:-size], power[size:], size + 1)
        size *= 2
    return _combine(acc, acc, window)


class Block:
    """The windows of one block: places (index of the first word in the block) and hashes."""

    def __init__(self, texts: list, window: int):
        import xxhash

        digest, joined, sizes = xxhash.xxh3_128_digest, [], []
        for t in texts:
            words = words_of(t)
            sizes.append(len(words))
            joined.append(b"".join(map(digest, words)))
        pairs = np.frombuffer(b"".join(joined), np.uint64).reshape(-1, 2)
        del joined
        self.ends = np.cumsum(np.array(sizes, np.int64)) if sizes else np.zeros(0, np.int64)
        self.starts = self.ends - np.array(sizes, np.int64)
        inside = np.zeros(len(pairs) + 1, bool)
        for a, b in zip(self.starts, self.ends - window + 1):
            if b > a:
                inside[a:b] = True
        self.place = np.nonzero(inside[: max(0, len(pairs) - window + 1)])[0].astype(np.int64)
        self.hash = window_hashes(np.ascontiguousarray(pairs[:, 0]), window)[self.place]
        self.words, self.window = pairs, window

    def more(self) -> np.ndarray:
        """32 more bits of the windows' hashes, from the other half of the word hashes."""
        other = window_hashes(np.ascontiguousarray(self.words[:, 1]), self.window)
        return other[self.place].astype(np.uint32)

    def document(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, place, side="right")


def _cells(h: np.ndarray, width_bits: int) -> list[np.ndarray]:
    """A window's cell in each of the shard's two counter rows."""
    mask = np.uint64((1 << width_bits) - 1)
    other = (h ^ (h >> np.uint64(31))) * MIX[3]
    return [(h & mask).astype(np.uint32), ((other >> np.uint64(30)) & mask).astype(np.uint32)]


def _pack(values: np.ndarray) -> bytes:
    """Byte planes, compressed: sorted cells as gaps, anything else as it is."""
    import zstandard

    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes, dtype) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(dtype).reshape(-1)


def _pack_sorted(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=values.dtype.type(0)))


def _unpack_sorted(data: bytes, dtype) -> np.ndarray:
    return np.cumsum(_unpack(data, dtype), dtype=dtype)


def _leads(h: np.ndarray, more: np.ndarray) -> np.ndarray:
    """For sorted hashes, the index of the first entry of each entry's run of equal ones."""
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (more[1:] != more[:-1])
    return np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))


def _batch(schema: pa.Schema, rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def _load(path: str) -> pa.Table:
    store, name = open_store(path)
    with store.open_input_file(name) as f:
        return pa.ipc.open_file(f).read_all()


def _store_blocks(rows: DataFrame, folder: str, block_bytes: int, window: int) -> DataFrame:
    """Manifest ``(block, windows)`` of the block files written by the tasks; a file's name holds the task
    attempt, and only files in the staged manifest are read."""

    def run(batches):
        task, number = TaskContext.get(), 0
        held, size, windows = [], 0, 0
        store, base = open_store(folder)

        def flush():
            store.create_dir(base, recursive=True)
            name = f"block-{task.partitionId():06d}-{task.taskAttemptId()}-{number}.arrow"
            options = pa.ipc.IpcWriteOptions(compression="zstd")
            with store.open_output_stream(f"{base}/{name}") as out, pa.ipc.new_file(out, held[0].schema, options=options) as w:
                for b in held:
                    w.write_batch(b)
            return pa.RecordBatch.from_arrays(
                [pa.array([f"{folder}/{name}"]), pa.array([windows], pa.int64())], ["block", "windows"]
            )

        for batch in batches:
            first = 0
            for i, t in enumerate(t for part in slices_of(batch, batch.num_columns - 1) for t in part):
                size += len(t or "") + 64
                windows += max(0, len(words_of(t)) - window + 1)
                if size >= block_bytes:
                    held.append(batch.slice(first, i + 1 - first))
                    yield flush()
                    held, size, windows, number, first = [], 0, 0, number + 1, i + 1
            if first < batch.num_rows:
                held.append(batch.slice(first))
        if held:
            yield flush()

    return staged(rows.mapInArrow(run, "block string, windows bigint"), "blocks")


SKETCH = pa.schema([("shard", pa.int64()), ("block", pa.string())] + [(f"{k}{r}", pa.binary()) for r in (0, 1) for k in ("cells", "twice")])
CELLS = pa.schema([("block", pa.string()), ("shard", pa.int64()), ("cells0", pa.binary()), ("cells1", pa.binary())])
ENTRY = pa.schema([("shard", pa.int64()), ("block", pa.string())] + [(k, pa.binary()) for k in ("hash", "more", "doc", "start", "place")])
MARKS = pa.schema([("block", pa.string()), ("place", pa.binary())])


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "bigint", pa.string(): "string", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def _repeats(rows: DataFrame, window: int, block_bytes: int, shard_windows: int):
    """``(manifest, marks)``: the blocks of ``rows(..., __id, __text)`` and, per block, places of windows
    whose word sequence also starts earlier."""
    spark = rows.sparkSession
    folder = shared_folder(spark, "substring_blocks")
    manifest = _store_blocks(rows, folder, block_bytes, window)
    total, largest, n_blocks = manifest.agg(F.sum("windows"), F.max("windows"), F.count("*")).first()
    total = total or 0
    # a block's row for a shard should hold 256 windows or more
    shard_bits = max(0, math.ceil(math.log2(max(1, min(total / shard_windows, (largest or 0) / 256)))))
    width_bits = min(32, max(16, math.ceil(math.log2(max(1, total) / (1 << shard_bits) * 16))))
    parts = max(1, min(n_blocks or 1, 100_000))

    def shards(h):
        """Order by hash, and the slice of every shard that has windows."""
        order = np.argsort(h, kind="stable")
        shard = (h[order] >> np.uint64(64 - shard_bits)).astype(np.int64) if shard_bits else np.zeros(len(h), np.int64)
        cuts = np.nonzero(np.diff(shard, prepend=-1))[0]
        return order, [(int(shard[a]), a, b) for a, b in zip(cuts, [*cuts[1:], len(h)])]

    def block_windows(path):
        table = _load(path)
        return table, Block(table.column("__text").to_pylist(), window)

    def sketch(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                _, block = block_windows(path)
                order, spans = shards(block.hash)
                h, out = block.hash[order], []
                for shard, a, b in spans:
                    row = {"shard": shard, "block": path}
                    for r, cell in enumerate(_cells(h[a:b], width_bits)):
                        used, n = np.unique(cell, return_counts=True)
                        row |= {f"cells{r}": _pack_sorted(used), f"twice{r}": np.packbits(n > 1).tobytes()}
                    out.append(row)
                    if len(out) == 256:
                        yield _batch(SKETCH, out)
                        out = []
                if out:
                    yield _batch(SKETCH, out)

    def merge(table: pa.Table) -> pa.Table:
        rows, repeated = table.to_pylist(), []
        for r in (0, 1):
            once, cells = np.zeros(1 << width_bits, bool), [_unpack_sorted(x[f"cells{r}"], np.uint32) for x in rows]
            twice = np.zeros(1 << width_bits, bool)
            for x, c in zip(rows, cells):
                own = np.unpackbits(np.frombuffer(x[f"twice{r}"], np.uint8), count=len(c)).astype(bool)
                twice[c[own | once[c]]] = True
                once[c] = True
            repeated.append([c[twice[c]] for c in cells])
        out = [
            {"block": x["block"], "shard": x["shard"], "cells0": _pack_sorted(a), "cells1": _pack_sorted(b)}
            for x, a, b in zip(rows, *repeated)
            if len(a) and len(b)
        ]
        return pa.Table.from_pylist(out, CELLS)

    def entries(table: pa.Table) -> pa.Table:
        path = table.column("block")[0].as_py()
        source, block = block_windows(path)
        order, spans = shards(block.hash)
        span, out, local, more = {s: (a, b) for s, a, b in spans}, [], [], block.more()
        ids = np.array([NO_ID if x is None else x for x in source.column("__id").to_pylist()], np.int64)
        for x in table.to_pylist():
            a, b = span[x["shard"]]
            at = order[a:b]
            h, keep = block.hash[at], np.ones(b - a, bool)
            for r, cell in enumerate(_cells(h, width_bits)):
                known = _unpack_sorted(x[f"cells{r}"], np.uint32)
                spot = np.minimum(np.searchsorted(known, cell), len(known) - 1)
                keep &= known[spot] == cell
            at = at[keep]
            if not len(at):
                continue
            place = block.place[at]
            doc = block.document(place)
            key, start = ids[doc], place - block.starts[doc]
            by = np.lexsort((start, key, more[at], block.hash[at]))
            lead = _leads(block.hash[at][by], more[at][by])
            own = (key[by] == key[by][lead]) & (start[by] == start[by][lead])
            local.append(place[by][~own])
            by = by[own]  # the first place in the block (several only under a repeated id)
            out.append(
                {
                    "shard": x["shard"],
                    "block": path,
                    "hash": _pack_sorted(block.hash[at][by]),
                    "more": _pack(more[at][by]),
                    "doc": _pack(key[by].astype(np.int64)),
                    "start": _pack(start[by].astype(np.uint32)),
                    "place": _pack(place[by].astype(np.uint32)),
                }
            )
        local = np.sort(np.concatenate(local)).astype(np.uint32) if local else np.zeros(0, np.uint32)
        if len(local):  # repeats within the block need no grouping: a shard of their own hands them on
            none = dict.fromkeys(("hash", "more", "doc", "start"))
            out.append({"shard": -1 - zlib.crc32(path.encode()), "block": path, "place": _pack_sorted(local), **none})
        return pa.Table.from_pylist(out, ENTRY)

    def group(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        if rows[0]["shard"] < 0:
            return pa.Table.from_pylist([{"block": x["block"], "place": x["place"]} for x in rows], MARKS)
        join = lambda k, t, f=_unpack: [f(x[k], t) for x in rows]
        more = join("more", np.uint32)
        owner = np.repeat(np.arange(len(rows)), [len(m) for m in more])
        h, m = np.concatenate(join("hash", np.uint64, _unpack_sorted)), np.concatenate(more)
        doc, start, place = (np.concatenate(join(k, t)) for k, t in (("doc", np.int64), ("start", np.uint32), ("place", np.uint32)))
        by = np.lexsort((start, doc, m, h))
        lead = by[_leads(h[by], m[by])]
        later = by[(doc[by] != doc[lead]) | (start[by] != start[lead])]
        out = []
        for i in np.unique(owner[later]):
            out.append({"block": rows[i]["block"], "place": _pack_sorted(np.sort(place[later[owner[later] == i]]))})
        return pa.Table.from_pylist(out, MARKS)

    sketches = manifest.select("block").repartition(parts, "block").mapInArrow(sketch, _ddl(SKETCH))
    cells = sketches.groupBy("shard").applyInArrow(merge, _ddl(CELLS))
    # a task per block, whatever the (small) bytes that are shuffled: a block is long to process
    candidates = cells.repartition(parts, "block").groupBy("block").applyInArrow(entries, _ddl(ENTRY))
    marks = candidates.groupBy("shard").applyInArrow(group, _ddl(MARKS))
    return manifest.select("block").repartition(parts, "block"), marks.repartition(parts, "block")


def _deduplicated(docs: DataFrame, id_col: str, text_col: str, window: int, block_bytes: int, shard_windows: int):
    """All columns of ``docs`` and ``__n_words, __n_removed, __kept``."""
    if window < 1:
        raise ValueError("window must be positive")
    names = docs.columns
    carried = [F.col(c).alias(f"c{i}") for i, c in enumerate(names)]
    rows = docs.select(
        *carried, F.col(id_col).cast("bigint").alias("__id"), F.col(text_col).cast("string").alias("__text")
    )
    manifest, marks = _repeats(rows, window, block_bytes, shard_windows)
    schema = rows.drop("__id", "__text").schema
    ddl = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in schema), "__n_words bigint, __n_removed bigint, __kept string"])

    def finish(table: pa.Table, found: pa.Table) -> pa.Table:
        source = _load(table.column("block")[0].as_py())
        total, kept = [], []
        for t in source.column("__text").to_pylist():
            words = words_of(t)
            total.append(len(words))
            kept.append(b" ".join(words))
        ends = np.cumsum(np.array(total, np.int64))
        edge = np.zeros((int(ends[-1]) if len(ends) else 0) + 1, np.int64)
        for x in found.column("place").to_pylist():
            at = _unpack_sorted(x, np.uint32).astype(np.int64)  # each place comes once
            edge[at] += 1
            edge[at + window] -= 1
        gone = np.cumsum(edge[:-1]) > 0
        removed = [int(gone[b - n : b].sum()) for b, n in zip(ends, total)]
        for i, n in enumerate(removed):
            if n:
                out = gone[ends[i] - total[i] : ends[i]].tolist()
                kept[i] = b" ".join(w for w, x in zip(kept[i].split(), out) if not x)
        kept = [k.decode("utf-8", "surrogatepass") for k in kept]
        source = source.drop_columns(["__id", "__text"])
        for name, values, kind in (("__n_words", total, pa.int64()), ("__n_removed", removed, pa.int64()), ("__kept", kept, pa.string())):
            source = source.append_column(name, pa.array(values, kind))
        return source

    found = manifest.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(finish, ddl)
    return found.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "__n_words", "__n_removed", "__kept")


def repeated_windows_removed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 20,
    block_bytes: int = 16 << 20,
    shard_windows: int = 1 << 18,
) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_text)`` per row.

    ``kept_text`` holds the words that are left, joined by one space (empty text if none). A null or empty
    text has no words; texts under ``window`` words lose nothing. Rows that repeat an id are told apart only by
    their texts: equal windows at the same start of the same id do not remove each other. Null ids come
    after all others. Other columns are ignored; an empty table gives an empty result.
    """
    found = _deduplicated(docs.select(id_col, text_col), id_col, text_col, window, block_bytes, shard_windows)
    return found.select(
        F.col(id_col).alias("doc_id"),
        F.col("__n_words").alias("n_words"),
        F.col("__n_removed").alias("n_removed"),
        F.col("__kept").alias("kept_text"),
    )


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, block_bytes: int = 16 << 20
) -> DataFrame:
    """``docs`` with every column; texts that lost words hold what is left, the others are as they were."""
    found = _deduplicated(docs, id_col, text_col, window, block_bytes, 1 << 18)
    text = F.when(F.col("__n_removed") > 0, F.col("__kept")).otherwise(F.col(text_col))
    return found.withColumn(text_col, text).select(*docs.columns)
