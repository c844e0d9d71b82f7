"""Log-structured parameter store of the factor fit (M4, T5).

Dense Adam moves every row in every step: a row without a gradient still moves with its momentum. Rewriting
all rows per step makes a step cost what all entities cost. Here a step reads and writes the rows of its own
batch only:

- which batches of an epoch a row takes part in is known when the epoch's batches are dealt, so every row
  carries that list (``uses``) and lies in the partition (``slot``) of the batch that reads it next;
- a step reads its slot, updates the rows and appends them to the slots of their next uses. Since the next
  use is known, the momentum steps that a row will miss until then are replayed as it is written: its
  parameters as the next batch will find them are further columns (``at_*``, null where no step is missed),
  beside the state after its last update (``last_step``). Rows already read are dead; the live rows are those in slots still to
  come, each exactly once, so nothing has to be merged to find the newest version;
- slots further ahead than the current window of ``window`` batches are held together, one partition per
  window, and dealt out when the window begins: a step writes to a bounded number of partitions however
  many batches an epoch has;
- at the end of an epoch all rows are brought up to date at once and written as the next epoch's start.

The replay is closed in the moments (``m`` and ``v`` shrink by powers of the two decays) and a sum of at most
``replay_terms`` steps in the parameter: the later ones add less than 2^-60 of the first.

Files are only ever appended, by committed writes, so a lost executor costs its tasks and nothing else, and
a view of the parameters after some batch stays readable until the end of the next epoch.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinity.session import CODEC

SLOT, USES, LAST, AT = "slot", "uses", "last_step", "at_"
WINDOW, ROWS_PER_FILE = 64, 1_000_000
FEW_BATCHES = 4  # an epoch of so few is written by the tasks that have the rows, a file per batch each


def replay_terms(beta1: float) -> int:
    """Steps after which a momentum step is below 2^-60 of the first."""
    return max(1, math.ceil(60 * math.log(2) / -math.log(beta1))) if beta1 > 0 else 1


def number(x: float) -> str:
    """A double as SQL text."""
    return f"{float(x)!r}D"


def replay_sql(params: list[str], cfg, missed: str) -> tuple[str, list[str]]:
    """SQL of a column ``_steps`` and, from it, of each parameter after ``missed`` steps without gradient that
    follow ``last_step``. The terms of ``_steps`` are what the moments are multiplied by, step after step."""
    b1, b2 = number(cfg.beta1), number(cfg.beta2)
    terms = f"least(int({missed}), {replay_terms(cfg.beta1)})"
    steps = (  # a row that missed nothing has no terms: sequence(1, 0) would count down
        f"CASE WHEN {missed} > 0 THEN transform(sequence(1, greatest({terms}, 1)), j -> struct("
        f"pow({b1}, j) / (1 - pow({b1}, {LAST} + j)) AS m, pow({b2}, j) / (1 - pow({b2}, {LAST} + j)) AS v)) END"
    )
    moved = [
        f"CASE WHEN _steps IS NULL THEN {p} ELSE aggregate(_steps, {p}, (x, f) -> "
        f"x - {number(cfg.lr)} * (f.m * m_{p}) / (sqrt(f.v * v_{p}) + {number(cfg.eps)})) END"
        for p in params
    ]
    return steps, moved


def shrunk_sql(params: list[str], cfg, missed: str) -> dict[str, str]:
    """SQL of the moments after ``missed`` steps without gradient."""
    return {
        f"{m}_{p}": f"CASE WHEN {missed} > 0 THEN {m}_{p} * pow({number(beta)}, {missed}) ELSE {m}_{p} END"
        for m, beta in (("m", cfg.beta1), ("v", cfg.beta2)) for p in params
    }


class ParamLog:
    """The parameters of one epoch at a time; see the module. ``params`` are the parameter columns, ``keys`` the
    columns that tell a row."""

    def __init__(self, spark: SparkSession, base: str, params: list[str], cfg, keys: list[str], window: int = WINDOW):
        self.spark, self.base, self.params, self.cfg, self.keys = spark, base, params, cfg, keys
        self.window, self.n_batches, self.path, self.first_step = max(1, int(window)), 0, None, 0
        self.schema, self.dealt = None, 0
        self.state = [*keys, *params, *(f"{m}_{p}" for m in "mv" for p in params)]

    def begin(self, epoch: int, state: DataFrame, uses: DataFrame, n_batches: int, step: int, n_rows: int) -> DataFrame:
        """Start an epoch from ``state`` (every one of ``n_rows`` rows up to date after ``step`` steps). ``uses`` has
        the keys and the sorted list of the batches a row takes part in. Returns the written state."""
        self.n_batches, self.path, self.first_step = n_batches, f"{self.base}/epoch_{epoch}", step + 1
        self.dealt = 0  # the window whose rows have been dealt to their batches
        rows = state.select(*self.state).join(uses, self.keys, "left")
        rows = rows.selectExpr(*self.state, f"coalesce({USES}, cast(array() AS array<int>)) AS {USES}", f"{step}L AS {LAST}")
        rows = self._ready(rows, str(self.first_step))
        self.schema = T.StructType([*rows.schema.fields, T.StructField(SLOT, T.IntegerType())])
        self._append(rows, 0, n_rows)
        return self._table().select(*self.state)

    def _table(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def _ready(self, rows: DataFrame, next_step: str) -> DataFrame:
        """Rows with ``at_*``, the parameters as their next use finds them (null: as they are); ``next_step`` is the
        SQL of the number of the first batch's step of the epoch."""
        missed = f"(coalesce(try_element_at({USES}, 1) + {next_step}, {LAST} + 1) - 1 - {LAST})"
        steps, moved = replay_sql(self.params, self.cfg, missed)
        at = [f"CASE WHEN _steps IS NOT NULL THEN {sql} END AS {AT}{p}" for sql, p in zip(moved, self.params)]
        more = [c for c in rows.columns if c not in (*self.state, USES, LAST)]
        return rows.selectExpr("*", f"{steps} AS _steps").selectExpr(*self.state, USES, LAST, *at, *more)

    def _append(self, rows: DataFrame, window: int, n_rows: int, observed: dict[str, str] | None = None) -> dict:
        """Add about ``n_rows`` rows to the slots of their next uses; ``window`` is the one of the current batch. A
        slot gets a file per ``ROWS_PER_FILE`` of the rows. ``observed`` are aggregates over the rows, collected by
        the tasks that write (whose counts Spark takes once, however often a task runs)."""
        use, end = f"coalesce(try_element_at({USES}, 1), {self.n_batches})", self.n_batches
        near = f"{use} = {end} OR int({use} / {self.window}) = {window}"
        # whole windows have negative numbers
        slot = f"int(CASE WHEN {near} THEN {use} ELSE -int({use} / {self.window}) - 1 END) AS {SLOT}"
        files = max(1, math.ceil(n_rows / ROWS_PER_FILE))
        tasks = max(files, self.spark.sparkContext.defaultParallelism)
        rows = rows.selectExpr("*", slot)
        if self.n_batches > FEW_BATCHES:
            rows = rows.repartition(tasks, SLOT, F.expr(f"pmod(hash({', '.join(self.keys)}), {files})"))
        seen = Observation() if observed else None
        if observed:
            rows = rows.observe(seen, *[F.expr(sql).alias(name) for name, sql in observed.items()])
        rows.select(*self.schema.names).write.mode("append").option("compression", CODEC).partitionBy(SLOT).parquet(self.path)
        return seen.get if observed else {}

    def _slot(self, slot: int) -> DataFrame | None:
        path = f"{self.path}/{SLOT}={slot}"
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if not hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
            return None
        return self.spark.read.schema(T.StructType(self.schema.fields[:-1])).parquet(path)

    def read(self, batch: int) -> DataFrame | None:
        """The rows that take part in ``batch``, each with the state after its last update and ``at_*``, the
        parameters as the batch finds them; None if there are none."""
        while self.dealt < batch // self.window:
            self.dealt += 1
            waiting = self._slot(-self.dealt - 1)
            if waiting is not None:
                self._append(waiting, self.dealt, waiting.count())
        rows = self._slot(batch)
        return rows if rows is None else rows.withColumns({f"{AT}{p}": F.coalesce(f"{AT}{p}", p) for p in self.params})

    def write(self, rows: DataFrame, batch: int, first_step: str, n_rows: int, observed: dict[str, str]) -> dict:
        """Append the updated rows of ``batch``, at most ``n_rows``, with their new ``last_step``, and return the
        ``observed`` aggregates over them (which may use further columns). ``first_step`` is the SQL of the
        number of the epoch's first step."""
        rows = rows.withColumn(USES, F.expr(f"slice({USES}, 2, greatest(size({USES}), 1))"))
        return self._append(self._ready(rows, first_step), batch // self.window, n_rows, observed)

    def live(self, batch: int, step: int) -> DataFrame:
        """All rows as they are after ``batch``, the one of step ``step``, without the store's own columns."""
        # a window's own partition is dead once the window has begun
        alive = f"{SLOT} > {batch} OR {SLOT} < {-(batch // self.window) - 1}"
        rows = self._table().where(alive)
        missed = f"({step} - {LAST})"
        steps, moved = replay_sql(self.params, self.cfg, missed)
        shrunk = shrunk_sql(self.params, self.cfg, missed)
        now = [f"{sql} AS {name}" for name, sql in zip([*self.params, *shrunk], [*moved, *shrunk.values()])]
        return rows.selectExpr("*", f"{steps} AS _steps").selectExpr(*self.keys, *now)
