"""Biased latent-factor model with an exponential link.

Model: ``w_hat(c, a) = exp(u_c . v_a + b_c + b_a + g)``. Objective on a batch of observed
pairs: ``sum (w_hat - w)^2 + lambda * (||U_B||_F + ||V_B||_F)`` where U_B / V_B are the factor
rows of the customers / articles present in the batch (unsquared norms, biases not penalised).

Storage: one factor table per side, ``id, f0..f{K-1}, bias`` plus Adam moments
``m_*, v_*`` for every parameter column; the global intercept and its moments are driver
scalars. Factors are scalar columns so every expression stays in whole-stage codegen.

Parameters start as unit-normal draws (``init_scale`` scales them), a pure function of id and seed.

One optimisation step is a Spark job over the batch's pairs:

- the pairs of an epoch are written once, laid out by batch, so a step reads only its batch;
- they join the factor rows of both sides (AQE picks the join by run-time size);
- ``delta = 2 (w_hat - w) w_hat`` per pair; both gradient sides are one grouped sum by (side, id)
  with map-side partial sums;
- Adam moves *every* factor row in every step, as dense optimiser state does: rows without a gradient
  move with their momentum. The fit keeps the rows in a log-structured store (``param_log``): a step
  reads and appends the rows of its batch only, and a row's missed steps are replayed when it is
  next read. So a step costs what its batch costs, not what all entities cost.
- all rows are brought up to date and written once per epoch, in the shared checkpoint folder; the
  state survives executor loss. At the end of a fit only the table of the final parameters is left.

An epoch of many small steps is one job instead, whose tasks go through its batches together (``epoch_tasks``): the
same steps, without a job's start for each.

``gradient_step`` alone is one dense step on two whole factor tables.

``batch_share`` fixes the number of steps per epoch whatever the data size; with ``batch_size``
(rows) it grows with the data, and so does an epoch's number of jobs.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.functions.hashing import normal
from affinity.functions.scores import factor_names, score_exponent
from affinity.operators import epoch_tasks
from affinity.operators.param_log import AT, FEW_BATCHES, LAST, USES, WINDOW, ParamLog, number, shrunk_sql
from affinity.session import CODEC, staged
from affinity.sources import schemas as S

# Deterministic test factors (integer arithmetic, one division by a double).
FIXED_FACTOR_MULT = 7919
FIXED_FACTOR_STEP = 104729
FIXED_FACTOR_MOD = 2001
FIXED_FACTOR_SHIFT = 1000
FIXED_FACTOR_DIV = 2000.0
FIXED_BIAS_MULT = 31
FIXED_BIAS_MOD = 101
FIXED_BIAS_SHIFT = 50
FIXED_BIAS_DIV = 500.0
FIXED_INTERCEPT = -1.0


def fixed_factors(ids: DataFrame, id_col: str, k: int) -> DataFrame:
    """Deterministic factor table for the distinct non-negative ids of ``ids`` (oracle input)."""
    i = F.col("id").cast("bigint")
    cols = [
        (
            (i * FIXED_FACTOR_MULT + j * FIXED_FACTOR_STEP) % FIXED_FACTOR_MOD - FIXED_FACTOR_SHIFT
        ).cast("double")
        / F.lit(FIXED_FACTOR_DIV)
        for j in range(k)
    ]
    bias = ((i * FIXED_BIAS_MULT) % FIXED_BIAS_MOD - FIXED_BIAS_SHIFT).cast("double") / F.lit(
        FIXED_BIAS_DIV
    )
    return (
        ids.select(F.col(id_col).alias("id"))
        .where(F.col("id").isNotNull())
        .distinct()
        .select("id", *[c.alias(n) for c, n in zip(cols, factor_names(k))], bias.alias("bias"))
    )


def init_factors(ids: DataFrame, id_col: str, k: int, seed: int, side: str, scale: float = 1.0):
    """M1: repeatable normal(0, scale) factors and biases, a pure function of (id, seed)."""
    idc = F.col("id")
    params = {n: normal(side, idc, n, seed) * F.lit(scale) for n in factor_names(k) + ["bias"]}
    return (
        ids.select(F.col(id_col).alias("id"))
        .where(idc.isNotNull())
        .distinct()
        .select("id", *[c.alias(n) for n, c in params.items()])
    )


def init_intercept(seed: int, scale: float = 1.0) -> float:
    """Global intercept draw for M1: the same normal(0, scale) draw as the factor tables."""
    def draw(tag):
        return int(hashlib.md5(f"global:{seed}:{tag}".encode()).hexdigest()[:8], 16)

    u1 = (draw("n1") + 1.0) / 4294967297.0
    u2 = draw("n2") / 4294967296.0
    return math.sqrt(-2.0 * math.log(u1)) * math.cos(6.283185307179586 * u2) * scale


def param_names(k: int) -> list[str]:
    return factor_names(k) + ["bias"]


def with_moments(factors: DataFrame, k: int) -> DataFrame:
    zeros = {f"{m}_{p}": F.lit(0.0) for m in ("m", "v") for p in param_names(k)}
    return factors.withColumns(zeros)


@dataclass
class Model:
    """Factor tables (with Adam moments), global intercept and its moments, step counter."""

    customers: DataFrame | None
    articles: DataFrame | None
    intercept: float | Column
    k: int
    step: int = 0
    m_g: float = 0.0
    v_g: float = 0.0
    history: list = field(default_factory=list)
    params: DataFrame | None = None  # both sides in one table (``side`` = c / a), when fitting
    max_exponent: float | None = None  # bound on the exponent (None: none), see ``bounded_exponent``


class ParamStore:
    """Written tables of a fit in a folder of its own under the shared checkpoint folder, used to cut
    lineage: each read-back is a fresh scan and survives executor loss."""

    def __init__(self, spark, name: str = "fit"):
        import uuid

        from affinity.session import checkpoint_dir

        self.spark = spark
        self.base = f"{checkpoint_dir(spark).rstrip('/')}/affinity-{name}-{uuid.uuid4().hex}"

    def put(self, df: DataFrame, name: str, partition_by=None) -> DataFrame:
        path = f"{self.base}/{name}"
        writer = df.write.mode("overwrite").option("compression", CODEC)
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _path(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def drop_one(self, name: str) -> None:
        """Delete one table, if it is there."""
        path, fs = self._path(name)
        fs.delete(path, True)

    def drop(self, keep: str) -> None:
        """Delete the store's tables, but for ``keep``."""
        path, fs = self._path(keep)
        for status in fs.listStatus(path.getParent()):
            if status.getPath().getName() != keep:
                fs.delete(status.getPath(), True)


@dataclass
class AdamConfig:
    lr: float = 0.001
    beta1: float = 0.9
    beta2: float = 0.999
    eps: float = 1e-8


# --------------------------------------------------------------------------------------------
# Scoring of given pairs (M2) and losses


def _u(k):
    return [F.col(f"u_{n}") for n in factor_names(k)]


def _v(k):
    return [F.col(f"a_{n}") for n in factor_names(k)]


def join_factors(
    pairs: DataFrame,
    customers: DataFrame,
    articles: DataFrame,
    k: int,
    customer: str = S.CUSTOMER,
    article: str = S.ARTICLE,
) -> DataFrame:
    """Attach customer factors (``u_*``) and article factors (``a_*``) to each pair.

    Plain equi-joins: a side under the session's broadcast threshold is broadcast, a larger one
    is shuffled, and AQE splits the partitions of a hot customer or article.
    """
    cu = customers.select(
        F.col("id").alias(customer), *[F.col(p).alias(f"u_{p}") for p in param_names(k)]
    )
    ar = articles.select(
        F.col("id").alias(article), *[F.col(p).alias(f"a_{p}") for p in param_names(k)]
    )
    return pairs.join(cu, customer).join(ar, article)


def exponent_col(k: int, intercept: float | Column) -> Column:
    g = intercept if isinstance(intercept, Column) else F.lit(float(intercept))
    return score_exponent(_u(k), _v(k), F.col("u_bias"), F.col("a_bias"), g)


def bounded_exponent(e: Column, max_exponent: float | None) -> Column:
    """The exponent, cut to +-``max_exponent`` if a bound is set. A cut exponent is constant: its
    slope in the parameters is 0 (``gradient_rows``), in training and validation loss alike."""
    if max_exponent is None:
        return e
    return F.least(F.greatest(e, F.lit(-float(max_exponent))), F.lit(float(max_exponent)))


def pair_scores(
    pairs: DataFrame, customers: DataFrame, articles: DataFrame, intercept: float, k: int,
    customer: str = S.CUSTOMER, article: str = S.ARTICLE,
) -> DataFrame:
    """M2 on given pairs: exponent and score ``exp(exponent)`` per (customer, article)."""
    j = join_factors(pairs.select(customer, article), customers, articles, k, customer, article)
    e = exponent_col(k, intercept)
    return j.select(customer, article, e.alias("exponent"), F.exp(e).alias("score"))


def losses(
    pairs: DataFrame, customers: DataFrame, articles: DataFrame, intercept: float, k: int,
    l2: float, customer: str = S.CUSTOMER, article: str = S.ARTICLE, weight: str = S.WEIGHT,
    max_exponent: float | None = None,
) -> DataFrame:
    """M3 = A11 + A12 on a batch, one row: pred_loss, penalty_loss, loss, n_pairs, mean_pred_loss.

    Only observed pairs with weight > 0 count (F9). The penalty uses the factor rows of the
    customers and articles that occur in the batch: ``gradient_rows`` brings the squared error
    of each pair and the squared norm of each row out of one join.
    """
    model = Model(customers, articles, intercept, k, max_exponent=max_exponent)
    rows = gradient_rows(unique_pairs(pairs, customer, article, weight), model, customer, article, weight)
    of_side = lambda side, col: F.sum(F.when(F.col(SIDE) == side, F.col(col)))
    sums = rows.agg(
        F.coalesce(F.sum("loss"), F.lit(0.0)).alias("pred_loss"),
        F.coalesce(F.sqrt(of_side(CUSTOMER_SIDE, "sq")), F.lit(0.0)).alias("nu"),
        F.coalesce(F.sqrt(of_side(ARTICLE_SIDE, "sq")), F.lit(0.0)).alias("na"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_pairs"),
    )
    penalty = F.lit(float(l2)) * (F.col("nu") + F.col("na"))
    return sums.select(
        "pred_loss",
        penalty.alias("penalty_loss"),
        (F.col("pred_loss") + penalty).alias("loss"),
        "n_pairs",
        F.when(F.col("n_pairs") > 0, F.col("pred_loss") / F.col("n_pairs")).alias("mean_pred_loss"),
    )


def unique_pairs(
    pairs: DataFrame, customer: str = S.CUSTOMER, article: str = S.ARTICLE, weight: str = S.WEIGHT
) -> DataFrame:
    """Repeated (customer, article) rows become one target, their weights summed."""
    return pairs.groupBy(customer, article).agg(F.sum(weight).alias(weight))


def sum_sq(cols: list[Column]) -> Column:
    acc = cols[0] * cols[0]
    for c in cols[1:]:
        acc = acc + c * c
    return acc


# --------------------------------------------------------------------------------------------
# Gradients (M4 building block)


SIDE = "side"
CUSTOMER_SIDE = "c"
ARTICLE_SIDE = "a"


def to_params(model: Model) -> DataFrame:
    """Both factor tables as one table with a ``side`` column (c = customer, a = article)."""
    if model.params is not None:
        return model.params
    return model.customers.withColumn(SIDE, F.lit(CUSTOMER_SIDE)).unionByName(
        model.articles.withColumn(SIDE, F.lit(ARTICLE_SIDE))
    )


def from_params(params: DataFrame | None, k: int, intercept: float, step: int = 0, m_g: float = 0.0,
                v_g: float = 0.0, history: list | None = None,
                max_exponent: float | None = None) -> Model:
    if params is None:  # the scalars only
        return Model(None, None, intercept, k, step, m_g, v_g, history if history is not None else [], None, max_exponent)
    return Model(
        params.where(F.col(SIDE) == CUSTOMER_SIDE).drop(SIDE),
        params.where(F.col(SIDE) == ARTICLE_SIDE).drop(SIDE),
        intercept, k, step, m_g, v_g, history if history is not None else [], params,
        max_exponent,
    )


def gradient_rows(
    batch: DataFrame, model: Model, customer: str = S.CUSTOMER, article: str = S.ARTICLE,
    weight: str = S.WEIGHT, squares: bool = True,
) -> DataFrame:
    """Per-entity gradients of the prediction loss on ``batch`` (without the penalty), both
    sides from one pass over the pairs.

    Each joined pair emits a customer-side and an article-side contribution; they are summed
    per (side, id) after map-side partial aggregation. Output: ``side, id, g_f0.., g_bias,
    loss, sq, n`` where ``sq`` is the entity's sum of squared factors (for the batch norm) and,
    on the customer side, ``loss`` / ``n`` are the entity's squared error and pair count. Without ``squares``
    no ``sq`` is shuffled, for callers that have the factor rows at hand.
    """
    k = model.k
    j = join_factors(
        batch.where(F.col(weight) > 0).select(customer, article, weight),
        model.customers, model.articles, k, customer, article,
    )
    raw = exponent_col(k, model.intercept)
    p = F.exp(bounded_exponent(raw, model.max_exponent))
    j = j.withColumn("_p", p).withColumn("_r", F.col("_p") - F.col(weight))
    slope = F.lit(2.0) * F.col("_r") * F.col("_p")
    if model.max_exponent is not None:
        slope = F.when(F.abs(raw) <= F.lit(float(model.max_exponent)), slope).otherwise(F.lit(0.0))
    j = j.withColumn("_d", slope)
    names = factor_names(k)

    def part(side, key, other, own, loss, n):
        grads = [f"_d * {other}_{x} AS g_{x}" for x in names]
        sq = " + ".join(f"{own}_{x} * {own}_{x}" for x in names)
        columns = [f"'{side}' AS {SIDE}", f"`{key}` AS id", *grads, "_d AS g_bias", f"{loss} AS loss", f"{n}L AS n"]
        columns += [f"{sq} AS sq"] if squares else []
        return f"struct({', '.join(columns)})"

    both = f"array({part(CUSTOMER_SIDE, customer, 'a', 'u', '_r * _r', 1)}, {part(ARTICLE_SIDE, article, 'u', 'a', '0D', 0)})"
    rows = j.selectExpr(f"explode({both}) AS _x").select("_x.*")
    sums = [f"sum(g_{x}) AS g_{x}" for x in (*names, "bias")]
    return rows.groupBy(SIDE, "id").agg(
        *map(F.expr, (*sums, "sum(loss) AS loss", *(["max(sq) AS sq"] if squares else []), "sum(n) AS n"))
    )


def gradients(
    batch: DataFrame, model: Model, customer: str = S.CUSTOMER, article: str = S.ARTICLE,
    weight: str = S.WEIGHT,
) -> tuple[DataFrame, DataFrame]:
    """(customer_grads, article_grads) of ``gradient_rows``, one table per side."""
    g = gradient_rows(batch, model, customer, article, weight)
    return (
        g.where(F.col(SIDE) == CUSTOMER_SIDE).drop(SIDE),
        g.where(F.col(SIDE) == ARTICLE_SIDE).drop(SIDE),
    )


def adam_update(
    factors: DataFrame, grads: DataFrame, k: int, t: int, cfg: AdamConfig, l2: float,
    norm: float | dict,
) -> DataFrame:
    """Apply one Adam step to every row of a factor table (one side, or both with ``side``).

    The penalty gradient ``l2 * f / norm`` is added for rows present in the batch (norm of the
    batch's factor rows of that side, given per side as a dict when both sides are updated;
    no penalty when the norm is 0). Rows without a gradient row get gradient 0 and still move
    with their momentum. Columns besides keys, parameters and moments are dropped.
    """
    keys = [SIDE, "id"] if SIDE in factors.columns else ["id"]
    j = factors.join(grads.select(*keys, *[f"g_{p}" for p in param_names(k)]), keys, "left")
    coef = number(_penalty(l2, norm)) if not isinstance(norm, dict) else "CASE " + " ".join(
        f"WHEN {SIDE} = '{side}' THEN {number(_penalty(l2, value))}" for side, value in norm.items()
    ) + " ELSE 0D END"
    fixes = [number(1.0 - beta ** t) for beta in (cfg.beta1, cfg.beta2)]
    return j.selectExpr(*keys, *[f"{sql} AS {n}" for n, sql in adam_sql(k, cfg, coef if l2 else None, *fixes).items()])


def _penalty(l2: float, norm: float | None) -> float:
    return l2 / norm if (l2 and norm and norm > 0) else 0.0


def adam_sql(
    k: int, cfg: AdamConfig, coef: str | None, fix1: str, fix2: str, old: dict[str, str] | None = None
) -> dict[str, str]:
    """SQL of the parameters and moments after one step, from rows with ``g_*`` (null: no gradient row). ``old``
    has the SQL of parameters and moments before the step, where that is not the column itself."""
    old, out = old or {}, {}
    b1, b2 = cfg.beta1, cfg.beta2
    for p in param_names(k):
        value, m, v = (old.get(c, c) for c in (p, f"m_{p}", f"v_{p}"))
        grad = f"coalesce(g_{p}, 0D)"
        if p != "bias" and coef is not None:
            grad = f"({grad} + CASE WHEN g_{p} IS NOT NULL THEN {coef} * {value} ELSE 0D END)"
        m = f"({number(b1)} * {m} + {number(1.0 - b1)} * {grad})"
        v = f"({number(b2)} * {v} + {number(1.0 - b2)} * {grad} * {grad})"
        out[p] = f"{value} - {number(cfg.lr)} * ({m} / {fix1}) / (sqrt({v} / {fix2}) + {number(cfg.eps)})"
        out[f"m_{p}"], out[f"v_{p}"] = m, v
    return out


def adam_scalar(value: float, grad: float, m: float, v: float, t: int, cfg: AdamConfig):
    m = cfg.beta1 * m + (1.0 - cfg.beta1) * grad
    v = cfg.beta2 * v + (1.0 - cfg.beta2) * grad * grad
    step = cfg.lr * (m / (1.0 - cfg.beta1 ** t)) / (math.sqrt(v / (1.0 - cfg.beta2 ** t)) + cfg.eps)
    return value - step, m, v


def _sums() -> dict[str, str]:
    """SQL of the aggregates over a step's rows that its log and the intercept need."""
    of = lambda side, col: f"sum(CASE WHEN {SIDE} = '{side}' THEN {col} END)"
    return {
        "loss": "sum(loss)", "n": "sum(n)", "gg": of(CUSTOMER_SIDE, "g_bias"),
        "sq_c": of(CUSTOMER_SIDE, "sq"), "sq_a": of(ARTICLE_SIDE, "sq"),
    }


def _summary(sums: dict, step: int, l2: float) -> dict:
    """The batch log, the norms per side and the intercept's gradient from the ``_sums`` of a step."""
    value = {name: float(x or 0.0) for name, x in sums.items()}
    if not (math.isfinite(value["loss"]) and math.isfinite(value["gg"])):
        raise FloatingPointError(
            f"the fit diverged in step {step}: loss {sums['loss']}; lower the learning rate or "
            "init_scale, or set max_exponent"
        )
    norms = {CUSTOMER_SIDE: math.sqrt(value["sq_c"]), ARTICLE_SIDE: math.sqrt(value["sq_a"])}
    log = {"pred_loss": value["loss"], "penalty_loss": float(l2) * sum(norms.values()), "n_pairs": int(value["n"])}
    log["loss"] = log["pred_loss"] + log["penalty_loss"]
    return {"log": log, "norms": norms, "gg": value["gg"]}


def gradient_step(
    batch: DataFrame, model: Model, l2: float, cfg: AdamConfig,
    customer: str = S.CUSTOMER, article: str = S.ARTICLE, weight: str = S.WEIGHT,
) -> tuple[Model, dict]:
    """M4 one dense step: gradients on ``batch``, Adam on all rows. Returns (new model, batch log).

    ``batch`` holds unique (customer, article) pairs (``unique_pairs``). Two jobs: one pass over the
    batch computes both gradient sides (persisted, small) together with the batch metrics; one job
    applies Adam to the whole parameter table and writes it.
    """
    params = to_params(model)
    grads = gradient_rows(batch, model, customer, article, weight).persist(StorageLevel.MEMORY_AND_DISK)
    t = model.step + 1
    try:
        sums = grads.agg(*[F.expr(sql).alias(name) for name, sql in _sums().items()])
        found = _summary(sums.first().asDict(), t, l2)
        new_params = staged(adam_update(params, grads, model.k, t, cfg, l2, found["norms"]), "step")
    finally:
        grads.unpersist()
    g, m_g, v_g = adam_scalar(model.intercept, found["gg"], model.m_g, model.v_g, t, cfg)
    new = from_params(new_params, model.k, g, t, m_g, v_g, model.history, model.max_exponent)
    return new, found["log"]


IS_CUSTOMER = f"{SIDE} = '{CUSTOMER_SIDE}'"


def by_reference(customer_value: str, article_value: str | None = None, row: str = IS_CUSTOMER) -> str:
    """SQL of a constant (one per side, or the same) that compiled code takes from a referenced array: the code
    of a stage stays the same from step to step and is compiled once."""
    values = f"{customer_value}, {customer_value if article_value is None else article_value}"
    return f"element_at(array({values}), CASE WHEN {row} THEN 1 ELSE 2 END)"


def logged_step(
    batch: DataFrame, log: ParamLog, batch_number: int, model: Model, l2: float, cfg: AdamConfig, n_rows: int,
    customer: str = S.CUSTOMER, article: str = S.ARTICLE, weight: str = S.WEIGHT,
) -> tuple[Model, dict]:
    """M4 one step of a fit: ``gradient_step`` on the at most ``n_rows`` rows of a batch in the store, one job.
    The norms of the penalty are an aggregate joined to the rows; the sums that the log and the intercept need
    are observed by the write. The returned model has the scalars only; ``log.live`` has the tables."""
    t, k = model.step + 1, model.k
    rows = log.read(batch_number)
    if rows is None:  # a batch without pairs: only the intercept's momentum moves
        return _scalar_step(model, {}, l2, cfg)
    found = [f"{AT}{p} AS {p}" for p in param_names(k)]
    intercept = by_reference(number(model.intercept), row=f"`{weight}` > 1")
    now = Model(
        rows.where(IS_CUSTOMER).selectExpr("id", *found), rows.where(f"NOT {IS_CUSTOMER}").selectExpr("id", *found),
        F.expr(intercept), k, max_exponent=model.max_exponent,
    )
    both = rows.join(gradient_rows(batch, now, customer, article, weight, squares=False), [SIDE, "id"], "left")
    coef, squares = None, " + ".join(f"{AT}{n} * {AT}{n}" for n in factor_names(k))
    if l2:
        norms = rows.groupBy(SIDE).agg(F.expr(f"sqrt(sum({squares})) AS _norm"))
        both = both.join(norms, SIDE, "left")
        coef = f"CASE WHEN _norm > 0 THEN {number(l2)} / _norm ELSE 0D END"
    step = by_reference(f"{t}L")
    old = {p: f"{AT}{p}" for p in param_names(k)} | shrunk_sql(param_names(k), cfg, f"({step} - 1 - {LAST})")
    fixes = [by_reference(number(1.0 - beta ** t)) for beta in (cfg.beta1, cfg.beta2)]
    new = [f"{sql} AS {name}" for name, sql in adam_sql(k, cfg, coef, *fixes, old).items()]
    sq = f"CASE WHEN g_bias IS NOT NULL THEN {squares} END AS sq"
    updated = both.selectExpr(SIDE, "id", *new, USES, f"{step} AS {LAST}", "loss", "n", "g_bias", sq)
    return _scalar_step(model, log.write(updated, batch_number, by_reference(f"{log.first_step}L"), n_rows, _sums()), l2, cfg)


def _scalar_step(model: Model, sums: dict, l2: float, cfg: AdamConfig) -> tuple[Model, dict]:
    """The scalars of the model after a step with these ``_sums``, and the batch log."""
    t = model.step + 1
    found = _summary({"loss": 0.0, "n": 0, "gg": 0.0, "sq_c": 0.0, "sq_a": 0.0} | sums, t, l2)
    g, m_g, v_g = adam_scalar(model.intercept, found["gg"], model.m_g, model.v_g, t, cfg)
    return from_params(None, model.k, g, t, m_g, v_g, model.history, model.max_exponent), found["log"]


def joint_steps(
    batched: DataFrame, state: DataFrame, store: ParamStore, name: str, model: Model, l2: float, cfg: AdamConfig,
    n_batches: int, tasks: int, customer: str = S.CUSTOMER, article: str = S.ARTICLE, weight: str = S.WEIGHT,
) -> tuple[DataFrame, list[tuple[Model, dict]]]:
    """M4 the steps of an epoch (``logged_step`` on each batch of ``batched``) in one job, see ``epoch_tasks``. Returns
    the table of all rows after them, written as ``name``, and the scalars and the log after each."""
    options = {
        "lr": cfg.lr, "beta1": cfg.beta1, "beta2": cfg.beta2, "eps": cfg.eps, "l2": l2, "max_exponent": model.max_exponent,
        "first_step": model.step + 1, "n_batches": n_batches, "intercept": model.intercept, "m_g": model.m_g, "v_g": model.v_g,
    }
    moments = [f"{m}_{p}" for m in "mv" for p in param_names(model.k)]
    rows = state.select(SIDE, "id", *param_names(model.k), *moments)
    exchange = f"exchange_{name}"
    run = epoch_tasks.run_epoch(batched, rows, model.k, tasks, f"{store.base}/{exchange}", options, customer, article, weight)
    written = store.put(run, name, [SIDE])
    store.drop_one(exchange)
    found = []
    for row in sorted(written.where(F.col(SIDE) == epoch_tasks.LOG).select("id", "sums").collect()):
        model, log = _scalar_step(model, dict(zip(epoch_tasks.SUMS, row["sums"])), l2, cfg)
        found.append((model, log))
    columns = [F.col("id").cast(rows.schema["id"].dataType) if c == "id" else c for c in rows.columns]
    return written.where(F.col(SIDE) != epoch_tasks.LOG).select(*columns), found


# --------------------------------------------------------------------------------------------
# A15 parameter changes between two snapshots


def snapshot_changes(
    before: DataFrame, after: DataFrame, k: int, tol: float = 1e-4, side: str = "customer"
) -> DataFrame:
    """A15 for one side: values of the factor table and of the biases that moved by more than
    ``tol`` between two snapshots, as rows ``(parameter, num_values_changed)``."""
    a = before.select("id", *[F.col(p).alias(f"b_{p}") for p in param_names(k)])
    b = after.select("id", *[F.col(p).alias(f"a_{p}") for p in param_names(k)])

    def moved(p):
        return F.count_if(F.abs(F.col(f"a_{p}") - F.col(f"b_{p}")) > F.lit(tol))

    factors = moved(factor_names(k)[0])
    for p in factor_names(k)[1:]:
        factors = factors + moved(p)
    wide = a.join(b, "id").agg(factors.alias("f"), moved("bias").alias("b"))
    return wide.selectExpr(
        f"stack(2, '{side}_factors', f, '{side}_intercepts', b) AS (parameter, num_values_changed)"
    ).withColumn("num_values_changed", F.col("num_values_changed").cast("bigint"))


def model_changes(before: Model, after: Model, tol: float = 1e-4) -> DataFrame:
    """One row per parameter of the model (both factor tables, both bias tables, the global
    intercept) with the number of values that moved by more than ``tol``."""
    spark = after.customers.sparkSession
    moved = int(abs(after.intercept - before.intercept) > tol)
    own = spark.createDataFrame([("global_intercept", moved)], "parameter string, num_values_changed bigint")
    return (
        snapshot_changes(before.customers, after.customers, after.k, tol, "customer")
        .unionByName(snapshot_changes(before.articles, after.articles, after.k, tol, "article"))
        .unionByName(own)
    )


# --------------------------------------------------------------------------------------------
# M4 / M5: the fit loop


WORD_BITS, MAX_WORDS = 62, 4  # batches that one long holds as bits, and at most so many longs


def batches_of(batched: DataFrame, customer: str, article: str, weight: str, n_batches: int | None = None) -> DataFrame:
    """``(side, id, uses)``: the sorted batches in which an entity has a pair with a weight above 0 (a list of
    at most all batches of an epoch). ``n_batches``, if few, are gathered as bits of longs, which aggregate
    without objects."""
    sides = F.array(
        F.struct(F.lit(CUSTOMER_SIDE).alias(SIDE), F.col(customer).alias("id")),
        F.struct(F.lit(ARTICLE_SIDE).alias(SIDE), F.col(article).alias("id")),
    )
    rows = batched.where(F.col(weight) > 0).select(F.explode(sides).alias("_x"), F.col("_batch").cast("int").alias("_b"))
    rows = rows.select("_x.*", "_b").groupBy(SIDE, "id")
    words = range(math.ceil((n_batches or 0) / WORD_BITS))
    if not 0 < len(words) <= MAX_WORDS:
        return rows.agg(F.sort_array(F.collect_set("_b")).alias(USES))
    bit = "CASE WHEN int(_b / {0}) = {1} THEN shiftleft(1L, _b % {0}) ELSE 0L END"
    masks = rows.agg(*[F.expr(f"bit_or({bit.format(WORD_BITS, w)}) AS _w{w}") for w in words])
    word = f"element_at(array({', '.join(f'_w{w}' for w in words)}), int(b / {WORD_BITS}) + 1)"
    uses = f"filter(sequence(0, {n_batches - 1}), b -> getbit({word}, b % {WORD_BITS}) = 1) AS {USES}"
    return masks.selectExpr(SIDE, "id", uses)


def _tables_later(params: ParamLog, batch: int, model: Model):
    """A function that makes the whole model after a batch, when it is called."""
    return lambda: from_params(
        params.live(batch, model.step), model.k, model.intercept, model.step, model.m_g, model.v_g,
        model.history, model.max_exponent,
    )


def fit_log_link_factors(
    interactions: DataFrame,
    k: int = 10,
    l2: float = 0.02,
    lr: float = 0.001,
    epochs: int = 200,
    batch_size: int = 100_000,
    validation_share: float = 0.05,
    seed: int = 0,
    init_scale: float = 1.0,
    exact_validation: bool = True,
    on_batch=None,
    on_epoch=None,
    batch_share: float | None = None,
    max_exponent: float | None = None,
    pairs_per_file: int = 2_000_000,
    start: Model | None = None,
    first_epoch: int = 0,
    window: int = WINDOW,
    batch_models: bool = True,
    customer: str = S.CUSTOMER,
    article: str = S.ARTICLE,
    weight: str = S.WEIGHT,
) -> Model:
    """Fit the exponential-link factor model with Adam over hash-shuffled batches.

    The validation split has exactly ``int(share * n)`` pairs (``exact_validation``) or,
    cheaper, an approximate share by hash threshold. A batch has about ``batch_size`` pairs, or
    ``batch_share`` of the training pairs if that is given. ``max_exponent`` bounds the exponent
    in gradients, training and validation loss (off by default; a fit that overflows stops with
    a ``FloatingPointError``).

    A fit of many steps with small batches runs each epoch as one job of tasks that go through its batches
    together (``epoch_tasks``). Otherwise a step is a job: each epoch's pairs are written once, partitioned by
    batch, so a step scans its own batch only; its parameter rows come from the log-structured store
    (``window``: see there). ``on_batch(epoch, batch,
    log, model)`` and ``on_epoch(epoch, train_pred_loss, val_pred_loss, model)`` receive the metrics (S12).
    ``on_epoch`` may snapshot its model (S13). ``on_batch`` gets a function that makes the model after the
    batch. Both models stay readable until the end of the next epoch. Without ``batch_models`` that function may
    be None, and ``on_batch`` called at the end of the epoch; with them and ``on_batch``, a step is a job.

    ``start`` (a loaded model with its moments) continues a fit at ``first_epoch``: the epochs up to
    ``epochs`` that are left give what the uninterrupted fit gives. Ids that ``start`` lacks are drawn as usual.
    """
    from affinity.operators.sampling import (
        assign_batches,
        exact_validation_flags,
        number_of_batches,
        validation_flags,
    )

    if k < 1 or epochs < 0 or batch_size < 1:
        raise ValueError("k and batch_size must be positive, epochs not negative")
    if not 0.0 <= validation_share < 1.0:
        raise ValueError("validation_share must be at least 0 and below 1")
    if batch_share is not None and not 0.0 < batch_share <= 1.0:
        raise ValueError("batch_share must be above 0 and at most 1")
    if lr <= 0 or l2 < 0 or (max_exponent is not None and max_exponent <= 0):
        raise ValueError("lr and max_exponent must be positive, l2 not negative")
    spark = interactions.sparkSession
    flag = exact_validation_flags if exact_validation else validation_flags
    store = ParamStore(spark)
    pairs = store.put(unique_pairs(interactions, customer, article, weight), "unique")
    data = store.put(flag(pairs, validation_share, seed, customer, article, "_val"), "pairs")
    counts = data.agg(F.count_if(~F.col("_val")).alias("t"), F.count_if(F.col("_val")).alias("v")).first()
    n_train, n_val = int(counts["t"]), int(counts["v"])

    cust = with_moments(init_factors(data, customer, k, seed, "customer", init_scale), k)
    arts = with_moments(init_factors(data, article, k, seed, "article", init_scale), k)
    drawn = cust.withColumn(SIDE, F.lit(CUSTOMER_SIDE)).unionByName(arts.withColumn(SIDE, F.lit(ARTICLE_SIDE)))
    if start is None:
        state = store.put(drawn, "init")
        model = from_params(state, k, init_intercept(seed, init_scale), max_exponent=max_exponent)
    else:
        if start.k != k:
            raise ValueError(f"the model to continue has {start.k} factors, not {k}")
        saved = to_params(start).select(*drawn.columns)
        state = store.put(saved.unionByName(drawn.join(saved, [SIDE, "id"], "left_anti")), "init")
        model = from_params(state, k, start.intercept, start.step, start.m_g, start.v_g, list(start.history), max_exponent)
    cfg = AdamConfig(lr=lr)

    train = data.where(~F.col("_val")).drop("_val").withColumn("_batch", F.lit(0))
    val = data.where(F.col("_val")).drop("_val")
    n_batches = math.ceil(1.0 / batch_share) if batch_share else number_of_batches(n_train, batch_size)
    per_batch, slots = n_train / n_batches, spark.sparkContext.defaultParallelism
    # files, so scan tasks, per batch: a small batch is split as far as there are slots
    spread = max(1, math.ceil(per_batch / pairs_per_file), min(slots, math.ceil(per_batch / 20_000)))
    n_entities = state.count()
    steps = n_batches * (int(epochs) - int(first_epoch))
    joint = not (on_batch is not None and batch_models) and dict(state.dtypes)["id"] in ("tinyint", "smallint", "int", "bigint")
    tasks = epoch_tasks.tasks_for(spark, steps, per_batch, n_entities) if joint else 0
    most_rows = min(n_entities, math.ceil(2 * per_batch))
    params = ParamLog(spark, store.base, param_names(k), cfg, [SIDE, "id"], window)

    def dealt(epoch: int) -> DataFrame:
        return assign_batches(train, n_batches, seed, epoch, customer, article, "_batch") if n_batches > 1 else train

    def begin(epoch: int, state: DataFrame, step: int) -> tuple[DataFrame, DataFrame]:
        """Deal an epoch's batches and start it in the store: its pairs by batch, and the written state."""
        batched = dealt(epoch)
        if n_batches > 1:
            if n_batches > FEW_BATCHES:
                place = F.pmod(F.hash(customer, article), F.lit(spread))
                batched = batched.repartition(n_batches * spread, F.col("_batch"), place)
            batched = store.put(batched, f"batches_{epoch % 2}", ["_batch"])
        return batched, params.begin(epoch, state, batches_of(batched, customer, article, weight, n_batches), n_batches, step, n_entities)

    if first_epoch < epochs and not tasks:
        batched, _ = begin(int(first_epoch), state, model.step)
    for epoch in range(int(first_epoch), int(epochs)):
        epoch_loss = 0.0
        if tasks:
            name = "final" if epoch + 1 == int(epochs) else f"epoch_{epoch}"
            state, found = joint_steps(dealt(epoch), state, store, name, model, l2, cfg, n_batches, tasks, customer, article, weight)
            for b, (model, log) in enumerate(found):
                epoch_loss += log["pred_loss"]
                if on_batch is not None:
                    on_batch(epoch, b, log, None)
        for b in range(0 if tasks else n_batches):
            batch = batched.where(F.col("_batch") == b).drop("_batch")
            model, log = logged_step(batch, params, b, model, l2, cfg, most_rows, customer, article, weight)
            epoch_loss += log["pred_loss"]
            if on_batch is not None:
                on_batch(epoch, b, log, _tables_later(params, b, model))
        if not tasks:
            state = params.live(n_batches - 1, model.step)
            if epoch + 1 < epochs:
                batched, state = begin(epoch + 1, state, model.step)
            else:
                state = store.put(state, "final")
        store.drop_one(f"epoch_{epoch - (2 if tasks else 1)}")
        model = from_params(state, k, model.intercept, model.step, model.m_g, model.v_g, model.history, max_exponent)
        train_pred = epoch_loss / n_train if n_train else float("nan")
        val_pred = float("nan")
        if n_val:
            row = losses(val, model.customers, model.articles, model.intercept, k, 0.0,
                         customer, article, weight, max_exponent).first()
            val_pred = float(row["pred_loss"]) / n_val
        model.history.append((epoch, train_pred, val_pred))
        if on_epoch is not None:
            on_epoch(epoch, train_pred, val_pred, model)
    store.drop(keep="final" if first_epoch < epochs else "init")
    return model
