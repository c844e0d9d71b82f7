"""Check queries of the jobs, sources and sinks: each writes given tables through a job into the
shared checkpoint folder and returns what is read back. Registered beside those of ``catalog``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from affinity.operators import factors as M
from affinity.operators import prepare as P
from affinity.operators import quantiles as Q
from affinity.plans import catalog as C
from affinity.plans.catalog import K, L2, SEED, TOL, VALIDATION_SHARE, r6, register, sql_hash
from affinity.session import checkpoint_dir
from affinity.sources import readers as RD
from affinity.sources import starschema as X
from affinity.sources import writers as W

STEP_SCALE = 0.1  # keeps the losses of the unrolled steps within the rounding of the comparison
PARAMS = M.param_names(K)


def shared_base(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# --------------------------------------------------------------------------------------------
# M4 / M5: one epoch of two batches, unrolled in SQL


def _sql_step(t: int, batch: str | None = None) -> str:
    """CTEs of optimiser step ``t``: params ``p{t-1}`` and intercept ``g{t-1}`` to ``p{t}``, ``g{t}``. ``batch``
    selects the pairs (by default batch ``t - 1``)."""
    batch = batch or f"b.batch = {t - 1}"
    a = C.ADAM
    dbl = lambda x: f"CAST({x!r} AS DOUBLE)"
    exponent = " + ".join(f"c.f{i} * a.f{i}" for i in range(K)) + " + c.bias + a.bias + g.g"
    grads = lambda other: ", ".join(f"sum(d * {other}f{i}) AS g_f{i}" for i in range(K))

    def moved(value, grad, m, v):
        m1 = f"({dbl(a.beta1)} * {m} + {dbl(1.0 - a.beta1)} * ({grad}))"
        v1 = f"({dbl(a.beta2)} * {v} + {dbl(1.0 - a.beta2)} * ({grad}) * ({grad}))"
        step = (
            f"{dbl(a.lr)} * ({m1} / {dbl(1.0 - a.beta1 ** t)})"
            f" / (sqrt({v1} / {dbl(1.0 - a.beta2 ** t)}) + {dbl(a.eps)})"
        )
        return f"{value} - {step}", m1, v1

    cols = []
    for p in PARAMS:
        grad = f"coalesce(gr.g_{p}, 0.0)"
        if p != "bias":
            grad += f" + CASE WHEN gr.id IS NULL THEN 0.0 ELSE {dbl(L2)} / n.norm * p.{p} END"
        for name, expr in zip((p, f"m_{p}", f"v_{p}"), moved(f"p.{p}", grad, f"p.m_{p}", f"p.v_{p}")):
            cols.append(f"{expr} AS {name}")
    new_g = moved("g.g", "s.gg", "g.m", "g.v")
    return f""",
j{t} AS MATERIALIZED (
  SELECT b.customer_int, b.article_int, exp({exponent}) - b.weight AS r,
         2.0::DOUBLE * (exp({exponent}) - b.weight) * exp({exponent}) AS d,
         {', '.join(f'c.f{i} AS uf{i}, a.f{i} AS af{i}' for i in range(K))}
  FROM tr b JOIN p{t - 1} c ON c.side = 'customer' AND c.id = b.customer_int
  JOIN p{t - 1} a ON a.side = 'article' AND a.id = b.article_int CROSS JOIN g{t - 1} g
  WHERE {batch}
),
gr{t} AS MATERIALIZED (
  SELECT 'customer' AS side, customer_int AS id, {grads('a')}, sum(d) AS g_bias FROM j{t} GROUP BY customer_int
  UNION ALL
  SELECT 'article', article_int, {grads('u')}, sum(d) FROM j{t} GROUP BY article_int
),
n{t} AS MATERIALIZED (
  SELECT p.side, sqrt(sum({' + '.join(f'p.f{i} * p.f{i}' for i in range(K))})) AS norm
  FROM p{t - 1} p JOIN gr{t} gr ON p.side = gr.side AND p.id = gr.id GROUP BY p.side
),
p{t} AS MATERIALIZED (
  SELECT p.side, p.id, {', '.join(cols)}
  FROM p{t - 1} p LEFT JOIN gr{t} gr ON p.side = gr.side AND p.id = gr.id JOIN n{t} n ON n.side = p.side
),
g{t} AS MATERIALIZED (
  SELECT {new_g[0]} AS g, {new_g[1]} AS m, {new_g[2]} AS v
  FROM g{t - 1} g CROSS JOIN (SELECT sum(d) AS gg FROM j{t}) s
)"""


_ZEROS = ", ".join(f"0.0::DOUBLE AS m_{p}, 0.0::DOUBLE AS v_{p}" for p in PARAMS)
SQL_START = (
    C.sql_model(C.with_tx())
    + f""",
hv AS (SELECT customer_int, article_int, weight,
              {sql_hash('customer_int', 'article_int', repr(str(SEED)), "'val'")} AS h FROM w),
rv AS (SELECT *, row_number() OVER (ORDER BY h, customer_int, article_int) AS rn, count(*) OVER () AS n FROM hv),
pairs AS MATERIALIZED (
  SELECT customer_int, article_int, weight,
         rn <= CAST(floor(CAST({VALIDATION_SHARE!r} AS DOUBLE) * n) AS BIGINT) AS val FROM rv
),
tr AS MATERIALIZED (
  SELECT *, {sql_hash('customer_int', 'article_int', repr(str(SEED)), "'0'")} % 2 AS batch FROM pairs WHERE NOT val
),
p0 AS MATERIALIZED (
  SELECT *, {_ZEROS} FROM (
    {C.sql_init('customer', 'SELECT DISTINCT customer_int AS id FROM pairs', STEP_SCALE)}
    UNION ALL
    {C.sql_init('article', 'SELECT DISTINCT article_int AS id FROM pairs', STEP_SCALE)}
  )
),
g0 AS MATERIALIZED (
  SELECT {C.sql_normal(repr('global'), repr(str(SEED)))} * {STEP_SCALE!r}::DOUBLE AS g, 0.0::DOUBLE AS m, 0.0::DOUBLE AS v
)"""
)
SQL_TWO_STEPS = SQL_START + _sql_step(1) + _sql_step(2)
SQL_TWO_EPOCHS = SQL_START + _sql_step(1, "true") + _sql_step(2, "true")  # of one batch each


def two_steps(spark, sf_dir, **callbacks):
    inter = C.ModelInputs(spark, sf_dir).weights
    return M.fit_log_link_factors(
        inter, k=K, l2=L2, lr=C.LR, epochs=1, batch_share=0.5, validation_share=VALIDATION_SHARE,
        seed=SEED, init_scale=STEP_SCALE, **callbacks,
    )


@register(
    "fit_two_steps",
    SQL_TWO_STEPS
    + f"""
SELECT side, id, {', '.join(f'round({p}, 6) + 0.0 AS {p}' for p in PARAMS)} FROM p2
UNION ALL
SELECT 'global', 0, {', '.join('NULL' for _ in range(K))}, round(g, 6) + 0.0 FROM g2""",
)
def q_fit_two_steps(spark, sf_dir):
    return C.model_rows(two_steps(spark, sf_dir))


_LOSS = " + ".join(f"c.f{i} * a.f{i}" for i in range(K)) + " + c.bias + a.bias + g.g"


@register(
    "validation_loss",
    SQL_TWO_STEPS
    + f""",
v AS (
  SELECT exp({_LOSS}) - b.weight AS r FROM pairs b
  JOIN p2 c ON c.side = 'customer' AND c.id = b.customer_int
  JOIN p2 a ON a.side = 'article' AND a.id = b.article_int CROSS JOIN g2 g WHERE b.val
)
SELECT 0 AS epoch_number,
       round(((SELECT sum(r * r) FROM j1) + (SELECT sum(r * r) FROM j2)) / (SELECT count(*) FROM tr), 6) AS train_pred_loss,
       round((SELECT sum(r * r) / count(*) FROM v), 6) AS val_pred_loss""",
)
def q_validation_loss(spark, sf_dir):
    model = two_steps(spark, sf_dir)
    out = spark.createDataFrame(model.history, "epoch_number int, train_pred_loss double, val_pred_loss double")
    return out.select("epoch_number", r6("train_pred_loss"), r6("val_pred_loss"))


# --------------------------------------------------------------------------------------------
# The training job's logs, and a fit that is interrupted and continued


def trained(spark, sf_dir, runs=({},), **options) -> str:
    """Base folder of one or more training runs of a model; by default one epoch with two batches."""
    from affinity.plans.train_job import train

    base = shared_base(spark, "train")
    inter = C.ModelInputs(spark, sf_dir).inter
    for run in runs:
        settings = {"batch_share": 0.5, "epochs": 1, **options, **run}
        train(
            spark, inter, base, "mf", "v1", num_latent_features=K, l2_lambda=L2, learning_rate=C.LR,
            validation_share=VALIDATION_SHARE, seed=SEED, init_scale=STEP_SCALE, **settings,
        )
    return base


#: one epoch, then a second run that finds it and continues
INTERRUPTED = ({"epochs": 1, "batch_share": 1.0}, {"epochs": 2, "batch_share": 1.0, "resume": True})
_RESULT = f"""
SELECT side, id, {', '.join(f'round({p}, 6) + 0.0 AS {p}' for p in PARAMS)} FROM p2
UNION ALL
SELECT 'global', 0, {', '.join('NULL' for _ in range(K))}, round(g, 6) + 0.0 FROM g2"""


@register("fit_resumed", SQL_TWO_EPOCHS + _RESULT)
def q_fit_resumed(spark, sf_dir):
    model, _ = W.load_model(spark, f"{trained(spark, sf_dir, INTERRUPTED)}/saved_models", "mf", "v1", 1)
    return C.model_rows(model)


@register(
    "training_log_epochs",
    SQL_TWO_EPOCHS
    + "\nUNION ALL\n".join(
        f"""
SELECT {t - 1} AS epoch_number, round((SELECT sum(r * r) / count(*) FROM j{t}), 6) AS train_pred_loss,
       round((SELECT sum(power(exp({_LOSS}) - b.weight, 2)) / count(*) FROM pairs b
              JOIN p{t} c ON c.side = 'customer' AND c.id = b.customer_int
              JOIN p{t} a ON a.side = 'article' AND a.id = b.article_int CROSS JOIN g{t} g WHERE b.val), 6) AS val_pred_loss"""
        for t in (1, 2)
    ),
)
def q_training_log_epochs(spark, sf_dir):
    logs = W.read_metrics(spark, f"{trained(spark, sf_dir, INTERRUPTED)}/training_logs", "epochs")
    return logs.select("epoch_number", r6("train_pred_loss"), r6("val_pred_loss"))


@register(
    "training_log_batches",
    SQL_TWO_STEPS
    + "\nUNION ALL\n".join(
        f"""
SELECT 0 AS epoch_number, {t - 1} AS batch_number, round((SELECT sum(r * r) FROM j{t}), 6) AS pred_loss,
       round(CAST({L2!r} AS DOUBLE) * (SELECT sum(norm) FROM n{t}), 6) AS penalty_loss"""
        for t in (1, 2)
    ),
)
def q_training_log_batches(spark, sf_dir):
    logs = W.read_metrics(spark, f"{trained(spark, sf_dir)}/training_logs", "batches")
    return logs.select("epoch_number", "batch_number", r6("pred_loss"), r6("penalty_loss"))


def _changed(cols) -> str:
    return " + ".join(f"count_if(abs(b.{c} - a.{c}) > {TOL!r})" for c in cols)


@register(
    "training_log_changes",
    SQL_TWO_STEPS
    + f"""
SELECT 0 AS epoch_number, 1 AS batch_number, a.side || '_factors' AS parameter,
       CAST({_changed(PARAMS[:-1])} AS BIGINT) AS num_values_changed
FROM p1 a JOIN p2 b ON a.side = b.side AND a.id = b.id GROUP BY a.side
UNION ALL
SELECT 0, 1, a.side || '_intercepts', CAST({_changed(['bias'])} AS BIGINT)
FROM p1 a JOIN p2 b ON a.side = b.side AND a.id = b.id GROUP BY a.side
UNION ALL
SELECT 0, 1, 'global_intercept', CAST(abs(g2.g - g1.g) > {TOL!r} AS BIGINT) FROM g1 CROSS JOIN g2""",
)
def q_training_log_changes(spark, sf_dir):
    base = trained(spark, sf_dir, log_param_changes=True)
    logs = W.read_metrics(spark, f"{base}/training_logs", "param_changes")
    return logs.select("epoch_number", "batch_number", "parameter", "num_values_changed")


@register("saved_model", SQL_TWO_STEPS + _RESULT)
def q_saved_model(spark, sf_dir):
    model, _ = W.load_model(spark, f"{trained(spark, sf_dir)}/saved_models", "mf", "v1", 0)
    return C.model_rows(model)


# --------------------------------------------------------------------------------------------
# CSV with reordered and extra columns


def csv_purchases(spark, sf_dir) -> str:
    base = shared_base(spark, "csv")
    W.write_table(X.customers(spark, sf_dir).select("c_name", "customer_id"), f"{base}/customers.csv", "csv")
    W.write_table(X.articles(spark, sf_dir).select("p_brand", "article_id"), f"{base}/articles.csv", "csv")
    tx = X.transactions(spark, sf_dir)
    tx = tx.select("l_orderkey", "article_id", "price", "customer_id", "t_dat", "l_linenumber")
    W.write_table(tx, f"{base}/transactions.csv", "csv")
    return base


@register("csv_transactions", C.ORACLE["enriched_transactions"])
def q_csv_transactions(spark, sf_dir):
    from affinity.plans.prepare_job import prepare_lookups

    base = csv_purchases(spark, sf_dir)
    maps = prepare_lookups(
        RD.read_customers(spark, f"{base}/customers.csv"), RD.read_articles(spark, f"{base}/articles.csv"), base
    )
    tx = RD.read_transactions(spark, f"{base}/transactions.csv")
    out = P.enrich_transactions(tx, *[RD.read_table(spark, m) for m in maps])
    return out.select(
        C.iso("t_dat"), "price", F.col("l_orderkey").cast("bigint").alias("l_orderkey"),
        F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "customer_int", "article_int",
    )


FIRST_ROWS = 1000


@register(
    "first_interactions",
    C.sql_model(C.with_tx())
    + f"""
SELECT customer_int, article_int, round(weight, 6) AS weight FROM w
ORDER BY customer_int, article_int LIMIT {FIRST_ROWS}""",
)
def q_first_interactions(spark, sf_dir):
    path = f"{shared_base(spark, 'weights')}/train.csv"
    W.write_table(C.interactions_part(spark, sf_dir).select("weight", "article_int", "customer_int"), path, "csv")
    out = RD.read_interactions(spark, path, n_rows=FIRST_ROWS)
    return out.select("customer_int", "article_int", r6("weight"))


# --------------------------------------------------------------------------------------------
# The prepare job

SQL_DENSE = "WITH " + C.SQL_ID_MAPS
_CUSTOMER = "JOIN cm ON cm.customer_id = CAST(x.customer_int AS VARCHAR)"
_ARTICLE = (
    "JOIN am ON am.article_id = lpad(CAST(x.article_int AS VARCHAR),"
    " CAST(greatest(10, length(CAST(x.article_int AS VARCHAR))) AS INTEGER), '0')"
)


def prepared(spark, sf_dir, **options) -> dict[str, str]:
    from affinity.plans.prepare_job import prepare_lookups, prepare_training_data

    base = shared_base(spark, "prepared")
    maps = prepare_lookups(X.customers(spark, sf_dir), X.articles(spark, sf_dir), base)
    return prepare_training_data(
        spark, X.transactions(spark, sf_dir), *[RD.read_table(spark, m) for m in maps], base,
        holdout_days=C.HOLDOUT_DAYS, new_user_days=C.FIRST_N_DAYS, **options,
    )


@register(
    "prepared_weights",
    SQL_DENSE
    + f""",
x AS ({C.sql_weights(0.001, 1.0)})
SELECT cm.customer_int, am.article_int, x.weight FROM x {_CUSTOMER} {_ARTICLE}""",
)
def q_prepared_weights(spark, sf_dir):
    paths = prepared(spark, sf_dir, strengths=[(0.0, 0.0), (0.001, 1.0)])
    out = W.read_weighted_interactions(spark, paths["train"], 0.001, 1.0)
    return out.select("customer_int", "article_int", r6("weight"))


def _with(sql: str, body: str) -> str:
    return f"({sql}\n{body})"


@register(
    "prepared_summaries",
    SQL_DENSE
    + f""",
price AS ({C.ORACLE['max_prices']}),
hold AS ({C.ORACLE['holdout_counts']}),
rec AS {_with(C.with_tx(), "SELECT customer_int, article_int, CAST((SELECT max(t_dat) FROM train) - max(t_dat) AS INTEGER) AS d FROM train GROUP BY 1, 2")},
cut AS ({(C.with_tx() + C.SQL_GAPS)} SELECT article_int, {C._nearest_col(0.5, 'p50')} FROM pos GROUP BY article_int),
fresh AS ({C.ORACLE['first_n_days']}),
news AS {_with(C.with_tx(), "SELECT customer_int, article_int FROM holdout h WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.customer_int = h.customer_int)")}
SELECT 'max_price' AS kind, -1 AS customer_int, am.article_int, round(x.max_price, 6) AS value FROM price x {_ARTICLE}
UNION ALL
SELECT 'holdout', cm.customer_int, am.article_int, CAST(x.count AS DOUBLE) FROM hold x {_CUSTOMER} {_ARTICLE}
UNION ALL
SELECT 'recency', cm.customer_int, am.article_int, CAST(x.d AS DOUBLE) FROM rec x {_CUSTOMER} {_ARTICLE}
UNION ALL
SELECT 'cutoff', -1, am.article_int, x.p50 FROM cut x {_ARTICLE}
UNION ALL
SELECT 'first_days', cm.customer_int, am.article_int, CAST(x.days_since_first_t AS DOUBLE) FROM fresh x {_CUSTOMER} {_ARTICLE}
UNION ALL
SELECT 'new_customers', cm.customer_int, am.article_int, 1.0 FROM news x {_CUSTOMER} {_ARTICLE}""",
)
def q_prepared_summaries(spark, sf_dir):
    paths = prepared(spark, sf_dir)
    none = F.lit(-1).cast("bigint").alias("customer_int")

    def rows(kind, path, customer, value):
        df = RD.read_table(spark, paths[path])
        return df.select(F.lit(kind).alias("kind"), customer, "article_int", value.cast("double").alias("value"))

    own = F.col("customer_int")
    parts = [
        rows("max_price", "prices", none, F.round("max_price", 6)),
        rows("holdout", "holdout", own, F.col("count")),
        rows("recency", "customer_days_since_last_purchase", own, F.col("days_since_last_purchase")),
        rows("cutoff", "days_between_purchase", none, F.col("p50")),
        rows("first_days", "train_new_users", own, F.col("days_since_first_t")),
        rows("new_customers", "holdout_new_users", own, F.lit(1.0)),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# --------------------------------------------------------------------------------------------
# The scoring job over saved tables


def scored(spark, sf_dir) -> dict:
    """Results of the scoring job on the fixed factors, the holdout read from CSV."""
    from affinity.plans.score_job import score_saved

    base = shared_base(spark, "score")
    own = C.ModelInputs(spark, sf_dir, True, C.NEW_CUSTOMER_HOLDOUT_DAYS)
    (train, raw_holdout), cf, af = own.split, own.cf, own.af
    W.write_table(P.holdout_counts(raw_holdout), f"{base}/dev/holdout.csv", "csv")
    W.write_table(P.days_since_last_purchase(train), f"{base}/dev/customer_days_since_last_purchase")
    W.write_table(Q.repeat_gap_quantiles(train), f"{base}/dev/days_between_purchase")
    customers, articles = C.submission_maps(spark, sf_dir)
    W.write_table(customers, f"{base}/lookups/customer_ids")
    W.write_table(articles, f"{base}/lookups/article_ids")
    model = M.Model(M.with_moments(cf, K), M.with_moments(af, K), M.FIXED_INTERCEPT, K)
    W.save_model(model, f"{base}/saved_models", "fixed", "v1", 3)
    return score_saved(
        spark, base, f"{base}/saved_models", "fixed", "v1", 3, f"{base}/predictions",
        holdout="dev/holdout.csv", k=C.TOP_N, sample_size=C.SAMPLE_SIZE, seed=SEED,
    )


@register("scored_submission", C.ORACLE["submission"])
def q_scored_submission(spark, sf_dir):
    return spark.read.option("header", True).csv(scored(spark, sf_dir)["submission"])


@register("scored_precision", C.ORACLE["average_precision"])
def q_scored_precision(spark, sf_dir):
    path = scored(spark, sf_dir)["holdout_apks"]
    return RD.read_table(spark, path).select("customer_int", r6("apk"))


# --------------------------------------------------------------------------------------------
# S8, R6 in submission mode: no holdout, every known customer is scored, no metrics


@register(
    "submission_area",
    C.sql_reco(C.with_txb(0), "SELECT CAST(c_custkey AS BIGINT) AS customer_int FROM customer") + C.SQL_SUBMISSION,
)
def q_submission_area(spark, sf_dir):
    """Prepare without holdout, save a model, score the table of customer ids, read the submission back."""
    from affinity.plans.prepare_job import prepare_training_data
    from affinity.plans.score_job import score_saved

    base = shared_base(spark, "submission")
    customers, articles = C.submission_maps(spark, sf_dir)
    W.write_table(customers, f"{base}/lookups/customer_ids")
    W.write_table(articles, f"{base}/lookups/article_ids")
    raw = X.tx_brand(spark, sf_dir).join(customers, "customer_int").join(articles, "article_int")
    raw = raw.select("t_dat", "customer_id", "article_id", "price")
    paths = prepare_training_data(spark, raw, customers, articles, base, holdout_days=0)
    inter = W.read_weighted_interactions(spark, paths["train"], 0.0, 0.0)
    factors = [M.with_moments(M.fixed_factors(inter, key, K), K) for key in ("customer_int", "article_int")]
    W.save_model(M.Model(*factors, M.FIXED_INTERCEPT, K), f"{base}/saved_models", "fixed", "v1", 0)
    found = score_saved(
        spark, base, f"{base}/saved_models", "fixed", "v1", 0, f"{base}/predictions",
        holdout="lookups/customer_ids", history="submission/customer_days_since_last_purchase",
        cutoffs="submission/days_between_purchase", k=C.TOP_N, sample_size=C.SAMPLE_SIZE, seed=SEED,
    )
    return spark.read.option("header", True).csv(found["submission"])
