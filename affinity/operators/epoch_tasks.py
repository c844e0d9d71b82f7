"""An epoch of many small optimiser steps as one Spark job (M4, T5).

A step of a small batch costs less than the start of a job, so here an epoch is one barrier stage, whose tasks all
run at once and go through the epoch's batches together. Spark deals the rows to the tasks and sorts them:

- every parameter row has one owner, the task its id's hash names; a task holds the rows it owns as arrays and
  writes them at the end of the epoch;
- the pairs are dealt by the hash of the pair, so a customer or article with many pairs does not make a task slow, and
  come sorted by batch: a task holds the pairs of one batch at a time, the others are in a file of its own.

In a step a task gets the rows of its pairs from their owners, computes the gradients, summed per row, and
returns these to the owners, which apply Adam. Rows that a batch lacks are not touched: their momentum steps are
replayed when they are next read, as in ``param_log``. So a step costs what its batch costs.

What tasks hand to one another in a step (at most the batch's rows) goes through files of the shared checkpoint
folder, each deleted as soon as all have read it; Spark's own ``barrier()`` looks once per second only, and its
``allGather()`` passes all through the driver. If a task fails, Spark runs the whole stage again, in a folder of its own.

Runs in Python workers; the module is shipped by value.
"""

from __future__ import annotations

import math
import sys
import tempfile
import time
import uuid

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.operators.param_log import replay_terms

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAIRS_PER_TASK = 10_000  # a step of fewer is not split further
MOST_PAIRS, MOST_ROWS = 1_000_000, 2_000_000  # of a batch and of the parameters that a task holds
FEW_STEPS = 8  # a fit of so few is not worth the start of the tasks
SIDES, LOG = ("c", "a"), "log"
SUMS = ("loss", "n", "gg", "sq_c", "sq_a")  # a batch's sums, as ``factors._sums`` names them
ROWS_OUT = 100_000  # of an Arrow batch written


def tasks_for(spark: SparkSession, steps: int, pairs: float, rows: int) -> int:
    """The tasks that share an epoch of a fit of ``steps`` steps with ``pairs`` pairs each and ``rows`` parameter rows; 0
    if each step had better be a job of its own: the fit is short, or a batch or the parameters are too large
    for the memory of the tasks that the session can run at once, or it may not hold tasks for each other."""
    context = spark.sparkContext
    if steps <= FEW_STEPS or context.getConf().get("spark.dynamicAllocation.enabled", "false").lower() == "true":
        return 0
    session = context._jsc.sc()
    slots = int(session.maxNumConcurrentTasks(session.resourceProfileManager().defaultResourceProfile()))
    if slots < 1 or pairs > MOST_PAIRS * slots or rows > MOST_ROWS * slots:
        return 0
    return min(slots, max(1, math.ceil(max(pairs / PAIRS_PER_TASK, rows / MOST_ROWS))))


def run_epoch(
    batched: DataFrame, state: DataFrame, k: int, tasks: int, folder: str, options: dict,
    customer: str, article: str, weight: str,
) -> DataFrame:
    """The rows of ``state`` (``side, id``, parameters, moments, up to date) after the steps of an epoch, and beside them
    a row per batch with its number as ``id`` and its ``sums``, null elsewhere (``SUMS``; a step in which the
    loss is no number is the last, and then there are no other rows). ``batched`` are unique pairs with ``_batch``."""
    values = [c for c in state.columns if c not in ("side", "id")]
    options = options | {"terms": replay_terms(options["beta1"])}  # what a task needs of modules it may not have
    bigint, home = "cast(`{}` AS bigint)".format, lambda *ids: f"pmod(hash({', '.join(ids)}), {tasks})"
    rows = state.selectExpr(
        f"{home(bigint('id'))} AS _task", "CASE WHEN side = 'c' THEN -2 ELSE -1 END AS _batch", f"{bigint('id')} AS c", "0L AS a",
        "0D AS w", "-1 AS hc", "-1 AS ha", f"array({', '.join(values)}) AS x",
    )
    ids = {"c": bigint(customer), "a": bigint(article)}
    # a pair has an empty list, not null: nulls before the end of an Arrow batch are gone through again with every row
    pairs = batched.where(F.col(weight) > 0).selectExpr(
        f"{home(*ids.values())} AS _task", "cast(_batch AS int) AS _batch", *[f"coalesce({x}, 0L) AS {n}" for n, x in ids.items()],
        f"cast(`{weight}` AS double) AS w", *[f"CASE WHEN {x} IS NULL THEN -1 ELSE {home(x)} END AS h{n}" for n, x in ids.items()],
        "cast(array() AS array<double>) AS x",
    )
    stream = rows.union(pairs).repartitionById(tasks, "_task").sortWithinPartitions("_batch").drop("_task")
    schema = ", ".join(["side string", "id bigint", *(f"{c} double" for c in values), "sums array<double>"])

    def task(batches):
        with np.errstate(all="ignore"), tempfile.TemporaryFile() as spool:
            yield from _task(_spooled(batches, spool), k, tasks, folder, options, values)

    return stream.mapInArrow(task, schema, barrier=True)


# --------------------------------------------------------------------------------------------
# Inside a task


def _spooled(stream, spool):
    """The whole stream, by way of a file of this task: Spark has sent all rows and freed their memory before the first
    step."""
    import pyarrow as pa

    writer = None
    for part in stream:
        writer = writer or pa.ipc.new_stream(spool, part.schema)
        writer.write_batch(part)
    if writer is not None:
        writer.close()
        spool.seek(0)
        yield from pa.ipc.open_stream(spool)


def _by_batch(stream):
    """``(batch, arrays)`` of the stream's rows, batch after batch."""
    import pyarrow as pa

    held, at = [], None
    for part in stream:
        numbers = part.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
        for i, j in zip(cuts, cuts[1:]):
            if held and i < j and numbers[i] != at:
                yield at, pa.Table.from_batches(held)
                held = []
            if i < j:
                at = int(numbers[i])
                held.append(part.slice(i, j - i))
    if held:
        yield at, pa.Table.from_batches(held)


class Rows:
    """The parameter rows of one side that a task owns: ids ascending, parameters, moments, last step."""

    def __init__(self, table, width: int, step: int, options: dict):
        ids = np.empty(0, np.int64) if table is None else table.column("c").to_numpy()
        flat = np.empty(0) if table is None else table.column("x").combine_chunks().flatten().to_numpy()
        order, self.options = np.argsort(ids, kind="stable"), options
        self.ids = ids[order]
        self.p, self.m, self.v = np.ascontiguousarray(flat.reshape(-1, 3, width)[order].transpose(1, 0, 2))
        self.last = np.full(len(ids), step, np.int64)

    def find(self, ids: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ids, ids)

    def catch_up(self, at: np.ndarray, step: int) -> None:
        """Replay the steps up to ``step`` that the rows missed (``param_log.replay_sql`` and ``shrunk_sql``)."""
        b1, b2, lr, eps = (self.options[x] for x in ("beta1", "beta2", "lr", "eps"))
        missed = step - self.last[at]
        order = np.argsort(-missed, kind="stable")[: np.count_nonzero(missed)]
        at, missed = at[order], missed[order]
        if not len(at):
            return
        p, m, v, last = self.p[at], self.m[at], self.v[at], self.last[at]
        moving = np.flatnonzero((m != 0).any(axis=1))  # without momentum a row stays where it is
        x, mm, vv, since = p[moving], m[moving], v[moving], last[moving].astype(float)
        terms = np.minimum(missed[moving], self.options["terms"])  # falling
        for j in range(1, int(terms[0]) + 1 if len(terms) else 1):
            n = int(np.searchsorted(-terms, -j, side="right"))
            fm = b1**j / (1 - b1 ** (since[:n] + j))
            fv = b2**j / (1 - b2 ** (since[:n] + j))
            x[:n] -= lr * (fm[:, None] * mm[:n]) / (np.sqrt(fv[:, None] * vv[:n]) + eps)
        p[moving] = x
        self.p[at] = p
        self.m[at] = m * (b1 ** missed.astype(float))[:, None]
        self.v[at] = v * (b2 ** missed.astype(float))[:, None]
        self.last[at] = step

    def adam(self, at: np.ndarray, grad: np.ndarray, step: int) -> None:
        """One step of rows that are up to date (``factors.adam_sql``)."""
        b1, b2, lr, eps = (self.options[x] for x in ("beta1", "beta2", "lr", "eps"))
        m = b1 * self.m[at] + (1.0 - b1) * grad
        v = b2 * self.v[at] + (1.0 - b2) * grad * grad
        self.p[at] -= lr * (m / (1.0 - b1**step)) / (np.sqrt(v / (1.0 - b2**step)) + eps)
        self.m[at], self.v[at], self.last[at] = m, v, step


class Exchange:
    """Hands arrays of 8-byte numbers from every task to every task. A message of a task is one file: where each
    task's part begins, a few numbers for all, the parts. A file appears whole, and goes when all have read it."""

    NUMBERS = 4

    def __init__(self, folder: str, me: int, tasks: int):
        from pyarrow import fs

        if folder.startswith("file:") or "://" not in folder:
            self.fs, self.path = fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
        else:
            self.fs, self.path = fs.FileSystem.from_uri(folder)
        self.me, self.tasks, self.sent = me, tasks, []
        self.fs.create_dir(self.path, recursive=True)

    def _file(self, name: str, task: int) -> str:
        return f"{self.path}/{name}-{task}"

    def send(self, name: str, numbers: list[float], parts: list[list[np.ndarray]]) -> None:
        """``parts`` has a list of arrays for each task."""
        blobs = [np.array([len(a) for a in part], np.int64).tobytes() + b"".join(a.tobytes() for a in part) for part in parts]
        begins = np.cumsum([8 * (self.tasks + 1 + self.NUMBERS), *map(len, blobs)], dtype=np.int64)
        own = self._file(name, self.me)
        with self.fs.open_output_stream(f"{own}.part") as f:
            f.write(begins.tobytes() + np.array([*numbers, *[0.0] * (self.NUMBERS - len(numbers))]).tobytes() + b"".join(blobs))
        self.fs.move(f"{own}.part", own)
        self.sent.append(own)

    def receive(self, name: str, kinds: str) -> tuple[np.ndarray, list[list[np.ndarray]]]:
        """The sum over the tasks of their numbers, and from each task its arrays for this one. ``kinds``: i or f for
        each array. All of the message before this one have been read by all."""
        from pyarrow import fs

        waiting, pause, found = [self._file(name, t) for t in range(self.tasks)], 0.0005, {}
        while waiting:
            there = {i.path for i in self.fs.get_file_info(waiting) if i.type == fs.FileType.File}
            found |= {path: self._read(path, kinds) for path in waiting if path in there}
            waiting = [path for path in waiting if path not in there]
            if waiting:
                time.sleep(pause)
                pause = min(0.02, pause * 1.3)
        for old in self.sent[:-1]:
            self.fs.delete_file(old)
        del self.sent[:-1]
        ordered = [found[self._file(name, t)] for t in range(self.tasks)]
        return np.sum([numbers for numbers, _ in ordered], axis=0), [arrays for _, arrays in ordered]

    def _read(self, path: str, kinds: str) -> tuple[np.ndarray, list[np.ndarray]]:
        with self.fs.open_input_file(path) as f:
            head = f.read_at(8 * (self.tasks + 1 + self.NUMBERS), 0)
            begins = np.frombuffer(head, np.int64, self.tasks + 1)
            blob = f.read_at(int(begins[self.me + 1] - begins[self.me]), int(begins[self.me]))
        arrays, place = [], 8 * len(kinds)
        for kind, n in zip(kinds, np.frombuffer(blob, np.int64, len(kinds))):
            arrays.append(np.frombuffer(blob, np.int64 if kind == "i" else np.float64, int(n), place))
            place += 8 * int(n)
        return np.frombuffer(head, np.float64, self.NUMBERS, 8 * (self.tasks + 1)), arrays


class Pairs:
    """The pairs of a batch that a task has, and which rows of which owners they need."""

    def __init__(self, table, tasks: int):
        none = np.empty(0, np.int64)
        c, a, w, hc, ha = (none,) * 5 if table is None else (table.column(n).to_numpy() for n in ("c", "a", "w", "hc", "ha"))
        whole = (hc >= 0) & (ha >= 0)  # a pair without one of its ids has no loss; its other row counts in the norm
        alone = [(x[(h >= 0) & ~whole], h[(h >= 0) & ~whole]) for x, h in ((c, hc), (a, ha))]
        self.lonely = [self._dealt(x, h, tasks)[0] for x, h in alone]
        order = np.lexsort((a[whole], c[whole]))  # so that sums do not follow the order in which rows arrived
        keys = [(x[whole][order], h[whole][order]) for x, h in ((c, hc), (a, ha))]
        self.w = w[whole][order]
        # per side: the ids by owner, and the row of each pair in the ids of all owners
        self.ids, self.at = zip(*(self._dealt(x, h, tasks) for x, h in keys))

    @staticmethod
    def _dealt(x, owner, tasks):
        """The distinct ids in ``x`` by owner, and the place among them of each ``x``."""
        ids, first, inverse = np.unique(x, return_index=True, return_inverse=True)
        order = np.argsort(owner[first], kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        cuts = np.searchsorted(owner[first][order], np.arange(tasks + 1))
        return [ids[order[i:j]] for i, j in zip(cuts, cuts[1:])], place[inverse]

    def asks(self, task: int) -> list[np.ndarray]:
        return [self.ids[0][task], self.ids[1][task], self.lonely[0][task], self.lonely[1][task]]

    def gradients(self, rows: list[np.ndarray], intercept: float, k: int, max_exponent: float | None):
        """From the parameter rows of both sides: the gradients of the squared error per row of each side, the squared
        error, the number of pairs and the gradient of the intercept (``factors.gradient_rows``)."""
        u, x = rows[0][self.at[0]], rows[1][self.at[1]]
        e = u[:, 0] * x[:, 0]
        for i in range(1, k):
            e = e + u[:, i] * x[:, i]
        e = e + u[:, k] + x[:, k] + intercept
        p = np.exp(e if max_exponent is None else np.clip(e, -max_exponent, max_exponent))
        r = p - self.w
        d = 2.0 * r * p
        if max_exponent is not None:
            d = np.where(np.abs(e) <= max_exponent, d, 0.0)
        out = []
        for side, other in ((0, x), (1, u)):
            n = len(rows[side])
            parts = [d * other[:, i] for i in range(k)] + [d]
            out.append(np.stack([np.bincount(self.at[side], part, n) for part in parts], axis=1))
        return out, [float((r * r).sum()), float(len(r)), float(d.sum())]


def _task(stream, k: int, tasks: int, folder: str, options: dict, values: list[str]):
    import pyarrow as pa
    from pyspark import BarrierTaskContext

    width, first, n_batches = k + 1, options["first_step"], options["n_batches"]
    context = BarrierTaskContext.get()
    exchange = Exchange(f"{folder}/{context.allGather(uuid.uuid4().hex)[0]}", context.partitionId(), tasks)
    tables, ahead = _by_batch(stream), None

    def taken(batch: int):
        """The rows of a batch; None without any."""
        nonlocal ahead
        ahead = next(tables, (math.inf, None)) if ahead is None else ahead
        if ahead[0] != batch:
            return None
        table, ahead = ahead[1], None
        return table

    own = [Rows(taken(number), width, first - 1, options) for number in (-2, -1)]
    pairs, none = Pairs(taken(0), tasks), np.empty(0)
    exchange.send("g0", [], [[none, none, *pairs.asks(t)] for t in range(tasks)])
    intercept, m_g, v_g = options["intercept"], options["m_g"], options["v_g"]
    b1, b2, lr, eps, l2 = (options[x] for x in ("beta1", "beta2", "lr", "eps", "l2"))
    logs, whole = [], True
    for b in range(n_batches + 1):
        totals, inbox = exchange.receive(f"g{b}", "ffiiii")
        if b:
            step = first + b - 1
            logs.append([*totals[:3], *squares[2:]])
            if not (math.isfinite(totals[0]) and math.isfinite(totals[2])):
                whole = False
                break
            for side in (0, 1):
                at, grad = graded[side], np.zeros((len(graded[side]), width))
                for asked_at, message in zip(asked[side], inbox):
                    grad[np.searchsorted(at, asked_at)] += message[side].reshape(-1, width)
                norm = math.sqrt(squares[side])
                if l2 and norm > 0:
                    grad[:, :k] += l2 / norm * own[side].p[at, :k]
                own[side].adam(at, grad, step)
            m_g = b1 * m_g + (1.0 - b1) * totals[2]
            v_g = b2 * v_g + (1.0 - b2) * totals[2] * totals[2]
            intercept -= lr * (m_g / (1.0 - b1**step)) / (math.sqrt(v_g / (1.0 - b2**step)) + eps)
        if b == n_batches:
            break
        asked = [[own[side].find(message[2 + side]) for message in inbox] for side in (0, 1)]
        graded = [np.unique(np.concatenate(x)) for x in asked]
        sent, norms, logged = [], [], []
        for side in (0, 1):
            lonely = own[side].find(np.concatenate([message[4 + side] for message in inbox]))
            present = np.union1d(graded[side], lonely)
            own[side].catch_up(present, first + b - 1)
            norms.append(float((own[side].p[present, :k] ** 2).sum()))
            logged.append(float((own[side].p[graded[side], :k] ** 2).sum()))
            sent.append([own[side].p[at].ravel() for at in asked[side]])
        exchange.send(f"r{b}", norms + logged, list(zip(*sent)))
        squares, inbox = exchange.receive(f"r{b}", "ff")
        rows = [np.concatenate([message[side] for message in inbox]).reshape(-1, width) for side in (0, 1)]
        grads, sums = pairs.gradients(rows, intercept, k, options["max_exponent"])
        cuts = [np.cumsum([0, *map(len, ids)]) for ids in pairs.ids]
        parts = [[grads[side][cuts[side][t] : cuts[side][t + 1]].ravel() for side in (0, 1)] for t in range(tasks)]
        pairs = Pairs(taken(b + 1) if b + 1 < n_batches else None, tasks)
        exchange.send(f"g{b + 1}", sums, [[*part, *pairs.asks(t)] for t, part in enumerate(parts)])

    names = ["side", "id", *values, "sums"]
    sums_type = pa.list_(pa.float64())
    if context.partitionId() == 0 and logs:
        nulls = [pa.nulls(len(logs), pa.float64())] * len(values)
        numbers = pa.array(range(len(logs)), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([LOG] * len(logs)), numbers, *nulls, pa.array(logs, sums_type)], names)
    for side, rows in zip(SIDES, own if whole else []):
        for i in range(0, len(rows.ids), ROWS_OUT):
            at = np.arange(i, min(i + ROWS_OUT, len(rows.ids)))
            rows.catch_up(at, first + n_batches - 1)
            columns = [pa.array(x[at, j]) for x in (rows.p, rows.m, rows.v) for j in range(width)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([side] * len(at)), pa.array(rows.ids[at]), *columns, pa.nulls(len(at), sums_type)], names
            )
