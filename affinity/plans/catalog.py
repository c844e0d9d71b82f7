"""Registered check queries: one Spark builder and (where SQL can express it) one oracle SQL per

Comparison conventions (both sides): doubles whose value depends on evaluation order or on the
math library (sums, averages, ``exp``) are rounded to 6 places; single IEEE operations (a
division, a max) are bit-identical in every engine and are left alone, since rounding them can
flip exact half-way cases differently. Day differences are int, counts bigint, dates ISO text,
lists space-joined strings in a fixed order.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.operators import prepare as P
from affinity.operators import quantiles as Q
from affinity.session import staged
from affinity.sources import starschema as X

HOLDOUT_DAYS = 365
NEW_CUSTOMER_HOLDOUT_DAYS = 1200
FIRST_N_DAYS = 7

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def r6(col: str) -> F.Column:
    return F.round(F.col(col), 6).alias(col)


def iso(col: str) -> F.Column:
    """Dates leave the check queries as ISO text (same text in every engine)."""
    return F.col(col).cast("string").alias(col)


# --------------------------------------------------------------------------------------------
# Shared SQL fragments (DuckDB dialect).

SQL_TX = """
tx AS (
  SELECT CAST(o.o_orderdate AS DATE) AS t_dat, o.o_custkey AS customer_int,
         l.l_partkey AS article_int, l.l_extendedprice / l.l_quantity AS price
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""

SQL_TXB = (
    SQL_TX
    + """,
brands AS (
  SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS brand_int
  FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL)
),
txb AS (
  SELECT tx.t_dat, tx.customer_int, b.brand_int AS article_int, tx.price
  FROM tx JOIN part p ON tx.article_int = p.p_partkey JOIN brands b ON p.p_brand = b.p_brand
)"""
)


def sql_split(source: str, days: int) -> str:
    return f""",
cut AS (SELECT max(t_dat) - {int(days)} AS c FROM {source}),
train AS (SELECT * FROM {source} WHERE t_dat <= (SELECT c FROM cut)),
holdout AS (SELECT * FROM {source} WHERE t_dat > (SELECT c FROM cut))"""


def with_tx(days: int = HOLDOUT_DAYS) -> str:
    return "WITH " + SQL_TX + sql_split("tx", days)


def with_txb(days: int = HOLDOUT_DAYS) -> str:
    return "WITH " + SQL_TXB + sql_split("txb", days)


def kept(df: DataFrame) -> DataFrame:
    """Write an intermediate that several jobs of one query read to the shared folder, so the scans
    and joins behind it run once; it survives lost executors and its bytes are known."""
    return staged(df, "kept")


def split_part(spark: SparkSession, sf_dir: str, days: int = HOLDOUT_DAYS):
    return P.split_transactions(X.tx_part(spark, sf_dir), days, newest=X.newest_purchase(spark, sf_dir))


def split_brand(spark: SparkSession, sf_dir: str, days: int = HOLDOUT_DAYS):
    return P.split_transactions(X.tx_brand(spark, sf_dir), days)


# --------------------------------------------------------------------------------------------
# F1 time split


@register(
    "split_train",
    with_tx()
    + "\nSELECT CAST(t_dat AS VARCHAR) AS t_dat, customer_int, article_int,"
    " price FROM train",
)
def q_split_train(spark, sf_dir):
    train, _ = split_part(spark, sf_dir)
    return train.select(iso("t_dat"), "customer_int", "article_int", "price")


@register(
    "split_holdout",
    with_tx()
    + "\nSELECT CAST(t_dat AS VARCHAR) AS t_dat, customer_int, article_int,"
    " price FROM holdout",
)
def q_split_holdout(spark, sf_dir):
    _, holdout = split_part(spark, sf_dir)
    return holdout.select(iso("t_dat"), "customer_int", "article_int", "price")


# --------------------------------------------------------------------------------------------
# A2 canonical prices


@register(
    "max_prices",
    with_tx()
    + """
SELECT article_int, max(CASE WHEN NOT isnan(price) THEN price END) AS max_price
FROM train GROUP BY article_int""",
)
def q_max_prices(spark, sf_dir):
    train, _ = split_part(spark, sf_dir)
    return P.max_prices(train)


# --------------------------------------------------------------------------------------------
# C2 weighted interactions


def sql_weights(k: float, s: float) -> str:
    return (
        with_tx()
        + f""",
mp AS (
  SELECT article_int, max(CASE WHEN NOT isnan(price) THEN price END) AS max_price
  FROM train GROUP BY article_int
),
newest AS (SELECT max(t_dat) AS m FROM train),
w AS (
  SELECT t.customer_int, t.article_int,
    ((CASE WHEN t.price IS NULL THEN NULL
           WHEN isnan(t.price) OR mp.max_price IS NULL OR isnan(mp.max_price)
                OR mp.max_price = 0 THEN 1.0
           ELSE t.price / mp.max_price END) * CAST({float(s)!r} AS DOUBLE)
       + CAST({1.0 - float(s)!r} AS DOUBLE))
    * exp(CAST({-float(k)!r} AS DOUBLE) * CAST((newest.m - t.t_dat) AS DOUBLE)) AS w
  FROM train t LEFT JOIN mp ON t.article_int = mp.article_int CROSS JOIN newest
)
SELECT customer_int, article_int, round(sum(w), 6) AS weight
FROM w GROUP BY customer_int, article_int
HAVING sum(w) > 0 AND NOT isnan(sum(w))"""
    )


def weights_query(k: float, s: float) -> Builder:
    def build(spark, sf_dir):
        train, _ = split_part(spark, sf_dir)
        return P.weighted_interactions(train, k, s).select(
            "customer_int", "article_int", r6("weight")
        )

    return build


for _name, _k, _s in [
    ("weighted_interactions", 0.0, 0.0),
    ("weighted_interactions_decay", 0.001, 0.0),
    ("weighted_interactions_decay_price", 0.001, 1.0),
]:
    register(_name, sql_weights(_k, _s))(weights_query(_k, _s))


# The decay x price strength configurations the reference trains with.
GRID = [(0.0, 0.0), (0.01, 0.0), (0.001, 0.0), (0.01, 1.0), (0.001, 1.0)]


@register(
    "weighted_interactions_grid",
    "\nUNION ALL\n".join(
        f"SELECT CAST({k!r} AS DOUBLE) AS t_discount, CAST({s_!r} AS DOUBLE) AS price_discount, "
        f"customer_int, article_int, weight FROM ({sql_weights(k, s_)})"
        for k, s_ in GRID
    ),
)
def q_weighted_interactions_grid(spark, sf_dir):
    train, _ = split_part(spark, sf_dir)
    out = P.weighted_interaction_grid(train, GRID)
    return out.select("t_discount", "price_discount", "customer_int", "article_int", r6("weight"))


# --------------------------------------------------------------------------------------------
# A4 holdout counts


@register(
    "holdout_counts",
    with_tx()
    + """
SELECT customer_int, article_int, CAST(count(*) AS BIGINT) AS count
FROM holdout GROUP BY customer_int, article_int""",
)
def q_holdout_counts(spark, sf_dir):
    _, holdout = split_part(spark, sf_dir)
    return P.holdout_counts(holdout)


# --------------------------------------------------------------------------------------------
# C3 repeat-purchase gap quantiles (article = brand: dense repeats)

SQL_GAPS = """,
g AS (
  SELECT article_int,
         CAST(t_dat - lag(t_dat) OVER (PARTITION BY customer_int, article_int ORDER BY t_dat)
              AS INTEGER) AS gap
  FROM train
),
pos AS (
  SELECT article_int, gap,
         row_number() OVER (PARTITION BY article_int ORDER BY gap) - 1 AS rn,
         count(*) OVER (PARTITION BY article_int) AS n
  FROM g WHERE gap > 0
)"""


def _nearest_col(q: float, name: str) -> str:
    return (
        f"CAST(max(CASE WHEN rn = floor(CAST({q!r} AS DOUBLE) * (n - 1) + CAST(0.5 AS DOUBLE))"
        f" THEN gap END) AS DOUBLE) AS {name}"
    )


SQL_GAP_NEAREST = (
    with_txb()
    + SQL_GAPS
    + "\nSELECT article_int, "
    + ", ".join(_nearest_col(q, n) for q, n in zip(Q.LEVELS, Q.NAMES))
    + "\nFROM pos GROUP BY article_int"
)

SQL_GAP_DISC = (
    with_txb()
    + SQL_GAPS
    + "\nSELECT article_int, "
    + ", ".join(f"CAST(quantile_disc(gap, {q!r}) AS DOUBLE) AS {n}" for q, n in zip(Q.LEVELS, Q.NAMES))
    + "\nFROM pos GROUP BY article_int"
)

SQL_GAP_LINEAR = (
    with_txb()
    + SQL_GAPS
    + "\nSELECT article_int, "
    + ", ".join(f"round(quantile_cont(gap, {q!r}), 6) AS {n}" for q, n in zip(Q.LEVELS, Q.NAMES))
    + "\nFROM pos GROUP BY article_int"
)


def gap_query(mode: str, rounded: bool) -> Builder:
    def build(spark, sf_dir):
        train, _ = split_brand(spark, sf_dir)
        out = Q.repeat_gap_quantiles(train, mode=mode)
        if rounded:
            out = out.select("article_int", *[r6(n) for n in Q.NAMES])
        return out

    return build


register("repeat_gap_quantiles", SQL_GAP_NEAREST)(gap_query("nearest", False))
register("repeat_gap_quantiles_disc", SQL_GAP_DISC)(gap_query("disc", False))
register("repeat_gap_quantiles_linear", SQL_GAP_LINEAR)(gap_query("linear", True))
# with fewer distinct gaps per article than the sketch's accuracy (10,000) it is exact
register("repeat_gap_quantiles_approx", SQL_GAP_DISC)(gap_query("approx", False))


# --------------------------------------------------------------------------------------------
# C4 recency


@register(
    "recency",
    with_txb()
    + """,
last AS (SELECT customer_int, article_int, max(t_dat) AS l FROM train GROUP BY 1, 2)
SELECT customer_int, article_int,
       CAST((SELECT max(l) FROM last) - l AS INTEGER) AS days_since_last_purchase
FROM last""",
)
def q_recency(spark, sf_dir):
    train, _ = split_brand(spark, sf_dir)
    return P.days_since_last_purchase(train)


# --------------------------------------------------------------------------------------------
# C5 first N days of each customer


@register(
    "first_n_days",
    with_tx()
    + f""",
f AS (SELECT customer_int, min(t_dat) AS t_dat_first FROM train GROUP BY customer_int)
SELECT CAST(t.t_dat AS VARCHAR) AS t_dat, t.customer_int, t.article_int, t.price,
       CAST(f.t_dat_first AS VARCHAR) AS t_dat_first,
       CAST(t.t_dat - f.t_dat_first AS INTEGER) AS days_since_first_t
FROM train t JOIN f ON t.customer_int = f.customer_int
WHERE t.t_dat - f.t_dat_first < {FIRST_N_DAYS}""",
)
def q_first_n_days(spark, sf_dir):
    train, _ = split_part(spark, sf_dir)
    out = P.transactions_first_n_days(train, FIRST_N_DAYS)
    return out.select(
        iso("t_dat"), "customer_int", "article_int", "price", iso("t_dat_first"), "days_since_first_t"
    )


# --------------------------------------------------------------------------------------------
# C6 new customers in the holdout, J6 customers both modelled and in the holdout


@register(
    "holdout_new_customers",
    with_tx(NEW_CUSTOMER_HOLDOUT_DAYS)
    + """
SELECT CAST(h.t_dat AS VARCHAR) AS t_dat, h.customer_int, h.article_int, h.price
FROM holdout h
WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.customer_int = h.customer_int)""",
)
def q_holdout_new_customers(spark, sf_dir):
    train, holdout = split_part(spark, sf_dir, NEW_CUSTOMER_HOLDOUT_DAYS)
    out = P.holdout_new_customer_transactions(train, holdout)
    return out.select(iso("t_dat"), "customer_int", "article_int", "price")


@register(
    "known_customers",
    with_tx(NEW_CUSTOMER_HOLDOUT_DAYS)
    + """
SELECT DISTINCT customer_int FROM holdout
WHERE customer_int IN (SELECT customer_int FROM train)""",
)
def q_known_customers(spark, sf_dir):
    train, holdout = split_part(spark, sf_dir, NEW_CUSTOMER_HOLDOUT_DAYS)
    modelled = P.weighted_interactions(train)
    return P.known_customers(modelled, holdout)


# --------------------------------------------------------------------------------------------
# P1/P2 dense ids, C1 enriched transactions, P6/P7/P8 encoded interactions

SQL_ID_MAPS = """
cm AS (
  SELECT customer_id, row_number() OVER (ORDER BY customer_id) - 1 AS customer_int
  FROM (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS customer_id FROM customer)
),
am AS (
  SELECT article_id, row_number() OVER (ORDER BY article_id) - 1 AS article_int
  FROM (SELECT DISTINCT lpad(CAST(p_partkey AS VARCHAR), CAST(greatest(10, length(CAST(p_partkey AS VARCHAR))) AS INTEGER), '0') AS article_id FROM part)
)"""


def customer_map(spark, sf_dir):
    from affinity.operators.ids import dense_ids

    return dense_ids(X.customers(spark, sf_dir), "customer_id", "customer_int")


def article_map(spark, sf_dir):
    from affinity.operators.ids import dense_ids

    return dense_ids(X.articles(spark, sf_dir), "article_id", "article_int")


register("dense_ids_customer", "WITH " + SQL_ID_MAPS + "\nSELECT * FROM cm")(customer_map)
register("dense_ids_article", "WITH " + SQL_ID_MAPS + "\nSELECT * FROM am")(article_map)


@register(
    "enriched_transactions",
    "WITH "
    + SQL_ID_MAPS
    + """,
raw AS (
  SELECT CAST(o.o_orderdate AS DATE) AS t_dat, CAST(o.o_custkey AS VARCHAR) AS customer_id,
         lpad(CAST(l.l_partkey AS VARCHAR), CAST(greatest(10, length(CAST(l.l_partkey AS VARCHAR))) AS INTEGER), '0') AS article_id,
         l.l_extendedprice / l.l_quantity AS price, l.l_orderkey, l.l_linenumber
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)
SELECT CAST(r.t_dat AS VARCHAR) AS t_dat, r.price, r.l_orderkey, r.l_linenumber,
       cm.customer_int, am.article_int
FROM raw r JOIN cm ON r.customer_id = cm.customer_id JOIN am ON r.article_id = am.article_id""",
)
def q_enriched_transactions(spark, sf_dir):
    orders, lines = X.order_tables(spark, sf_dir)
    out = P.enrich_transactions(
        orders, customer_map(spark, sf_dir), article_map(spark, sf_dir), lines=lines, on="l_orderkey"
    )
    price = F.col(X.PRICE_PARTS[0]) / F.col(X.PRICE_PARTS[1])
    return out.select(
        iso("t_dat"), price.alias("price"), "l_orderkey", "l_linenumber", "customer_int", "article_int"
    )


SQL_ENCODED = (
    with_tx()
    + """,
w AS (SELECT customer_int, article_int, count(*) AS cnt FROM train GROUP BY 1, 2),
ci AS (SELECT customer_int, row_number() OVER (ORDER BY customer_int) - 1 AS customer_idx
       FROM (SELECT DISTINCT customer_int FROM w)),
ai AS (SELECT article_int, row_number() OVER (ORDER BY article_int) - 1 AS article_idx
       FROM (SELECT DISTINCT article_int FROM w))"""
)


def interactions_part(spark, sf_dir):
    train, _ = split_part(spark, sf_dir)
    return P.weighted_interactions(train)


@register(
    "encoded_interactions",
    SQL_ENCODED
    + """
SELECT ci.customer_idx, ai.article_idx, round(CAST(w.cnt AS DOUBLE), 6) AS weight
FROM w JOIN ci ON w.customer_int = ci.customer_int JOIN ai ON w.article_int = ai.article_int""",
)
def q_encoded_interactions(spark, sf_dir):
    from affinity.operators.ids import dense_ids, encode_pairs

    inter = kept(interactions_part(spark, sf_dir))
    cmap = dense_ids(inter, "customer_int", "customer_idx")
    amap = dense_ids(inter, "article_int", "article_idx")
    return encode_pairs(inter, cmap, amap).select("customer_idx", "article_idx", r6("weight"))


@register(
    "interaction_counts",
    SQL_ENCODED
    + """
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(DISTINCT customer_int) AS BIGINT) AS num_customers,
       CAST(count(DISTINCT article_int) AS BIGINT) AS num_articles
FROM w""",
)
def q_interaction_counts(spark, sf_dir):
    from affinity.operators.ids import interaction_counts

    return interaction_counts(kept(interactions_part(spark, sf_dir)))


# --------------------------------------------------------------------------------------------
# Latent-factor queries on deterministic factor tables (FIXTURES section 3)

from affinity.operators import evaluation as EV  # noqa: E402
from affinity.operators import factors as M  # noqa: E402
from affinity.operators import sampling as T  # noqa: E402
from affinity.operators import scoring as R  # noqa: E402

K = 5
L2 = 0.02
LR = 0.03
TOP_N = 12
SEED = 42
SAMPLE_SIZE = 1000  # the reference's sample for the fallback
BATCH_SIZE = 10_000
VALIDATION_SHARE = 0.05
TOL = 1e-4
ADAM = M.AdamConfig(lr=LR)


def sql_fixed(name: str, ids_sql: str) -> str:
    cols = ", ".join(
        f"CAST((id * {M.FIXED_FACTOR_MULT} + {i} * {M.FIXED_FACTOR_STEP}) % {M.FIXED_FACTOR_MOD}"
        f" - {M.FIXED_FACTOR_SHIFT} AS DOUBLE) / CAST({M.FIXED_FACTOR_DIV!r} AS DOUBLE) AS f{i}"
        for i in range(K)
    )
    bias = (
        f"CAST((id * {M.FIXED_BIAS_MULT}) % {M.FIXED_BIAS_MOD} - {M.FIXED_BIAS_SHIFT} AS DOUBLE)"
        f" / CAST({M.FIXED_BIAS_DIV!r} AS DOUBLE) AS bias"
    )
    return f"{name} AS (SELECT id, {cols}, {bias} FROM ({ids_sql}) WHERE id IS NOT NULL)"


def sql_exponent(c: str, a: str) -> str:
    dot = " + ".join(f"{c}.f{i} * {a}.f{i}" for i in range(K))
    return f"({dot} + {c}.bias + {a}.bias + CAST({M.FIXED_INTERCEPT!r} AS DOUBLE))"


def sql_sumsq(t: str) -> str:
    return " + ".join(f"{t}.f{i} * {t}.f{i}" for i in range(K))


def sql_model(source_with: str) -> str:
    """Interactions (decay 0, price 0 => counts) and fixed factors of their customers/articles."""
    return (
        source_with
        + """,
w AS (SELECT customer_int, article_int, CAST(count(*) AS DOUBLE) AS weight
      FROM train GROUP BY customer_int, article_int),
"""
        + sql_fixed("cf", "SELECT DISTINCT customer_int AS id FROM w")
        + ",\n"
        + sql_fixed("af", "SELECT DISTINCT article_int AS id FROM w")
    )


class ModelInputs:
    """The tables that the model queries read, each written once and only if a query asks for it."""

    def __init__(self, spark, sf_dir, brand: bool = False, days: int = HOLDOUT_DAYS):
        self._tx, self._days = (X.tx_brand if brand else X.tx_part)(spark, sf_dir), days
        self._newest = (lambda: None) if brand else (lambda: X.newest_purchase(spark, sf_dir))

    @cached_property
    def split(self):
        """Train and holdout; the purchases are kept: weights, history, cutoffs and dates all read them."""
        return P.split_transactions(kept(self._tx), self._days)

    @property
    def train(self):
        return self.split[0]

    @cached_property
    def weights(self):
        """The interactions, for a query that reads them once."""
        if "split" in self.__dict__:
            return P.weighted_interactions(self.train)
        return P.weighted_interactions(P.split_transactions(self._tx, self._days, newest=self._newest())[0])

    @cached_property
    def inter(self):
        return kept(self.weights)

    @cached_property
    def cf(self):
        return kept(M.fixed_factors(self.inter, "customer_int", K))

    @cached_property
    def af(self):
        return kept(M.fixed_factors(self.inter, "article_int", K))


@register(
    "pair_scores",
    sql_model(with_tx())
    + f"""
SELECT w.customer_int, w.article_int, {sql_exponent('c', 'a')} AS exponent,
       round(exp({sql_exponent('c', 'a')}), 6) AS score
FROM w JOIN cf c ON w.customer_int = c.id JOIN af a ON w.article_int = a.id""",
)
def q_pair_scores(spark, sf_dir):
    own = ModelInputs(spark, sf_dir)
    out = M.pair_scores(own.inter, own.cf, own.af, M.FIXED_INTERCEPT, K)
    return out.select("customer_int", "article_int", "exponent", r6("score"))


SQL_JOINED = f""",
j AS (
  SELECT w.customer_int, w.article_int, w.weight,
         {', '.join(f'c.f{i} AS uf{i}' for i in range(K))}, c.bias AS ub,
         {', '.join(f'a.f{i} AS af{i}' for i in range(K))}, a.bias AS ab,
         exp({sql_exponent('c', 'a')}) AS p
  FROM w JOIN cf c ON w.customer_int = c.id JOIN af a ON w.article_int = a.id
)"""


@register(
    "factor_loss",
    sql_model(with_tx())
    + SQL_JOINED
    + f""",
pen AS (SELECT CAST({L2!r} AS DOUBLE) * ((SELECT sqrt(sum({sql_sumsq('cf')})) FROM cf)
                    + (SELECT sqrt(sum({sql_sumsq('af')})) FROM af)) AS v)
SELECT round(sum((p - weight) * (p - weight)), 6) AS pred_loss,
       round(any_value(pen.v), 6) AS penalty_loss,
       round(sum((p - weight) * (p - weight)) + any_value(pen.v), 6) AS loss,
       CAST(count(*) AS BIGINT) AS n_pairs,
       round(sum((p - weight) * (p - weight)) / count(*), 6) AS mean_pred_loss
FROM j CROSS JOIN pen""",
)
def q_factor_loss(spark, sf_dir):
    own = ModelInputs(spark, sf_dir)
    out = M.losses(own.inter, own.cf, own.af, M.FIXED_INTERCEPT, K, L2)
    return out.select(
        r6("pred_loss"), r6("penalty_loss"), r6("loss"), "n_pairs", r6("mean_pred_loss")
    )


def sql_adam(x: str) -> str:
    """First Adam step for gradient expression x, with the same literals as the Spark side."""
    b1, b2 = ADAM.beta1, ADAM.beta2
    m = f"(CAST({1.0 - b1!r} AS DOUBLE) * ({x}))"
    v = f"(CAST({1.0 - b2!r} AS DOUBLE) * ({x}) * ({x}))"
    return (
        f"CAST({ADAM.lr!r} AS DOUBLE) * ({m} / CAST({1.0 - b1 ** 1!r} AS DOUBLE))"
        f" / (sqrt({v} / CAST({1.0 - b2 ** 1!r} AS DOUBLE)) + CAST({ADAM.eps!r} AS DOUBLE))"
    )


SQL_STEP = (
    sql_model(with_tx())
    + SQL_JOINED
    + f""",
d AS (SELECT *, CAST(2.0 AS DOUBLE) * (p - weight) * p AS dl FROM j),
gu AS (SELECT customer_int AS id, {', '.join(f'sum(dl * af{i}) AS g{i}' for i in range(K))},
              sum(dl) AS gb FROM d GROUP BY customer_int),
ga AS (SELECT article_int AS id, {', '.join(f'sum(dl * uf{i}) AS g{i}' for i in range(K))},
              sum(dl) AS gb FROM d GROUP BY article_int),
nu AS (SELECT CAST({L2!r} AS DOUBLE) / sqrt(sum({sql_sumsq('cf')})) AS c FROM cf),
na AS (SELECT CAST({L2!r} AS DOUBLE) / sqrt(sum({sql_sumsq('af')})) AS c FROM af),
step AS (
  SELECT 'customer' AS side, t.id,
         {', '.join(f't.f{i} - ' + sql_adam(f'g.g{i} + n.c * t.f{i}') + f' AS f{i}' for i in range(K))},
         t.bias - {sql_adam('g.gb')} AS bias
  FROM cf t JOIN gu g ON t.id = g.id CROSS JOIN nu n
  UNION ALL
  SELECT 'article' AS side, t.id,
         {', '.join(f't.f{i} - ' + sql_adam(f'g.g{i} + n.c * t.f{i}') + f' AS f{i}' for i in range(K))},
         t.bias - {sql_adam('g.gb')} AS bias
  FROM af t JOIN ga g ON t.id = g.id CROSS JOIN na n
)"""
)


def one_step(spark, sf_dir):
    own = ModelInputs(spark, sf_dir)
    inter, cf, af = own.inter, own.cf, own.af
    model = M.Model(M.with_moments(cf, K), M.with_moments(af, K), M.FIXED_INTERCEPT, K)
    new, _ = M.gradient_step(inter, model, L2, ADAM)
    return cf, af, new


@register(
    "factor_gradient_step",
    SQL_STEP
    + f"""
SELECT side, id, {', '.join(f'round(f{i}, 6) + 0.0 AS f{i}' for i in range(K))},
       round(bias, 6) + 0.0 AS bias
FROM step""",
)
def q_factor_gradient_step(spark, sf_dir):
    _, _, new = one_step(spark, sf_dir)
    cols = ["id", *[r6(f"f{i}") for i in range(K)], r6("bias")]
    return new.customers.select(F.lit("customer").alias("side"), *cols).unionByName(
        new.articles.select(F.lit("article").alias("side"), *cols)
    )


@register(
    "snapshot_changes",
    SQL_STEP
    + f""",
before AS (SELECT 'customer' AS side, * FROM cf UNION ALL SELECT 'article' AS side, * FROM af)
SELECT b.side || '_factors' AS parameter,
       CAST({' + '.join(f'count_if(abs(s.f{i} - b.f{i}) > {TOL!r})' for i in range(K))} AS BIGINT)
         AS num_values_changed
FROM before b JOIN step s ON b.side = s.side AND b.id = s.id GROUP BY b.side
UNION ALL
SELECT b.side || '_intercepts', CAST(count_if(abs(s.bias - b.bias) > {TOL!r}) AS BIGINT)
FROM before b JOIN step s ON b.side = s.side AND b.id = s.id GROUP BY b.side
UNION ALL
SELECT 'global_intercept', CAST(abs({sql_adam('gg')}) > {TOL!r} AS BIGINT)
FROM (SELECT sum(dl) AS gg FROM d)""",
)
def q_snapshot_changes(spark, sf_dir):
    cf, af, new = one_step(spark, sf_dir)
    return M.model_changes(M.Model(cf, af, M.FIXED_INTERCEPT, K), new, TOL)


# --------------------------------------------------------------------------------------------
# T4 sample, T5 batches, T6 validation split, F6 weight lookup


def sql_hash(*parts: str) -> str:
    text = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT)"


@register(
    "sample_customers",
    sql_model(with_tx())
    + f"""
SELECT id AS customer_int FROM cf
ORDER BY {sql_hash('id', repr(str(SEED)))}, id LIMIT {SAMPLE_SIZE}""",
)
def q_sample_customers(spark, sf_dir):
    return T.sample_keys(ModelInputs(spark, sf_dir).weights, "customer_int", SAMPLE_SIZE, SEED)


@register(
    "validation_split",
    sql_model(with_tx())
    + f"""
SELECT customer_int, article_int, round(weight, 6) AS weight,
       {sql_hash('customer_int', 'article_int', repr(str(SEED)), "'val'")} / CAST(4294967296.0 AS DOUBLE)
         < CAST({VALIDATION_SHARE!r} AS DOUBLE) AS is_validation
FROM w""",
)
def q_validation_split(spark, sf_dir):
    out = T.validation_flags(ModelInputs(spark, sf_dir).weights, VALIDATION_SHARE, SEED)
    return out.select("customer_int", "article_int", r6("weight"), "is_validation")


@register(
    "validation_split_exact",
    sql_model(with_tx())
    + f""",
h AS (SELECT customer_int, article_int, weight,
             {sql_hash('customer_int', 'article_int', repr(str(SEED)), "'val'")} AS hv FROM w),
r AS (SELECT *, row_number() OVER (ORDER BY hv, customer_int, article_int) AS rn,
             count(*) OVER () AS n FROM h)
SELECT customer_int, article_int, round(weight, 6) AS weight,
       rn <= CAST(floor(CAST({VALIDATION_SHARE!r} AS DOUBLE) * n) AS BIGINT) AS is_validation
FROM r""",
)
def q_validation_split_exact(spark, sf_dir):
    out = T.exact_validation_flags(ModelInputs(spark, sf_dir).inter, VALIDATION_SHARE, SEED)
    return out.select("customer_int", "article_int", r6("weight"), "is_validation")


@register(
    "batch_assignment",
    sql_model(with_tx())
    + f""",
nb AS (SELECT CAST(ceil(count(*) / CAST({BATCH_SIZE} AS DOUBLE)) AS BIGINT) AS n FROM w)
SELECT customer_int, article_int,
       CAST({sql_hash('customer_int', 'article_int', repr(str(SEED)), "'0'")} % nb.n AS BIGINT) AS batch
FROM w CROSS JOIN nb""",
)
def q_batch_assignment(spark, sf_dir):
    inter = ModelInputs(spark, sf_dir).inter
    n = T.number_of_batches(inter.count(), BATCH_SIZE)
    out = T.assign_batches(inter, n, SEED, 0)
    return out.select("customer_int", "article_int", "batch")


@register(
    "weight_lookup",
    sql_model(with_tx())
    + """,
pairs AS (SELECT DISTINCT customer_int, article_int FROM holdout)
SELECT p.customer_int, p.article_int, round(w.weight, 6) AS weight
FROM pairs p LEFT JOIN w ON p.customer_int = w.customer_int AND p.article_int = w.article_int""",
)
def q_weight_lookup(spark, sf_dir):
    from affinity.operators.lookup import lookup_weights

    train, holdout = split_part(spark, sf_dir)
    inter = P.weighted_interactions(train)
    pairs = holdout.select("customer_int", "article_int").distinct()
    return lookup_weights(pairs, inter).select("customer_int", "article_int", r6("weight"))


# --------------------------------------------------------------------------------------------
# R1-R5 recommendations, A7 actuals, Y1-Y3 / A10 evaluation, R7 submission

PERCENTILE = "p50"


def sql_reco(source_with: str, customers: str = "SELECT DISTINCT customer_int FROM holdout") -> str:
    """CTE chain ending in ``recs(customer_int, article_int, rk)``: brute-force all pairs. ``customers`` selects
    those to score."""
    return (
        sql_model(source_with)
        + SQL_GAPS
        + f""",
cuts AS (SELECT article_int, {_nearest_col(0.5, PERCENTILE)} FROM pos GROUP BY article_int),
last AS (SELECT customer_int, article_int, max(t_dat) AS l FROM train GROUP BY 1, 2),
hist AS (SELECT customer_int, article_int, CAST((SELECT max(l) FROM last) - l AS INTEGER) AS d
         FROM last),
excl AS (
  SELECT h.customer_int, h.article_int FROM hist h JOIN cuts c ON h.article_int = c.article_int
  WHERE h.d <= c.{PERCENTILE} AND h.article_int IN (SELECT id FROM af)
),
act_c AS ({customers}),
known AS (SELECT customer_int FROM act_c WHERE customer_int IN (SELECT id FROM cf)),
scored AS (  -- a suppressed article scores -1.0: all of them tie and order by id
  SELECT k.customer_int, a.id AS article_int, {sql_exponent('c', 'a')} AS e,
         (x.article_int IS NOT NULL) AS sup
  FROM known k JOIN cf c ON c.id = k.customer_int CROSS JOIN af a
  LEFT JOIN excl x ON x.customer_int = k.customer_int AND x.article_int = a.id
),
ranked AS (
  SELECT customer_int, article_int,
         row_number() OVER (PARTITION BY customer_int
                            ORDER BY sup, CASE WHEN sup THEN 0.0 ELSE e END DESC, article_int) AS rk
  FROM scored
),
samp AS (SELECT id FROM cf ORDER BY {sql_hash('id', repr(str(SEED)))}, id LIMIT {SAMPLE_SIZE}),
fb AS (
  SELECT a.id AS article_int, avg(exp({sql_exponent('c', 'a')})) AS s
  FROM samp JOIN cf c ON c.id = samp.id CROSS JOIN af a GROUP BY a.id
),
fbr AS (SELECT article_int, row_number() OVER (ORDER BY s DESC, article_int) AS rk FROM fb),
newc AS (SELECT customer_int FROM act_c WHERE customer_int NOT IN (SELECT id FROM cf)),
recs AS (
  SELECT customer_int, article_int, rk FROM ranked WHERE rk <= {TOP_N}
  UNION ALL
  SELECT n.customer_int, f.article_int, f.rk FROM newc n CROSS JOIN fbr f WHERE f.rk <= {TOP_N}
)"""
    )


SQL_AP = f""",
act AS (SELECT DISTINCT customer_int, article_int FROM holdout),
nact AS (SELECT customer_int, count(*) AS n FROM act GROUP BY customer_int),
hits AS (
  SELECT r.customer_int, r.rk, CASE WHEN a.article_int IS NULL THEN 0 ELSE 1 END AS hit
  FROM recs r LEFT JOIN act a ON r.customer_int = a.customer_int AND r.article_int = a.article_int
),
cum AS (
  SELECT customer_int, rk, hit,
         sum(hit) OVER (PARTITION BY customer_int ORDER BY rk
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ch
  FROM hits
),
sc AS (
  SELECT customer_int,
         sum(CASE WHEN hit = 1 THEN CAST(ch AS DOUBLE) / rk ELSE 0.0 END) AS s
  FROM cum GROUP BY customer_int
),
ap AS (
  SELECT n.customer_int, coalesce(sc.s, 0.0) / CAST(least(n.n, {TOP_N}) AS DOUBLE) AS apk
  FROM nact n LEFT JOIN sc ON n.customer_int = sc.customer_int
)"""


def reco_inputs(spark, sf_dir, brand: bool, days: int, **blocks):
    """Inputs of the scoring stage. As in the batch scoring job, the customers to score and
    their actual purchases come from the holdout summary (A4): one row per purchased pair."""
    own = ModelInputs(spark, sf_dir, brand, days)
    train, holdout = own.train, P.holdout_counts(own.split[1])
    cf, af = own.cf, own.af
    history = P.days_since_last_purchase(train)
    cutoffs = Q.repeat_gap_quantiles(train)
    excl = R.excluded_articles(history, cutoffs, PERCENTILE, af)
    sample = T.sample_keys(cf, "id", SAMPLE_SIZE, SEED)
    fb = R.fallback_list(
        R.fallback_scores(cf.join(sample, "id", "left_semi"), af, M.FIXED_INTERCEPT, K), TOP_N
    )
    recs = R.recommend(holdout, cf, af, M.FIXED_INTERCEPT, K, TOP_N, excl, fb, **blocks)
    return train, holdout, recs


def recs_text(recs: DataFrame) -> DataFrame:
    return recs.select(
        "customer_int",
        F.array_join(F.transform("recommendations", lambda x: x.cast("string")), " ").alias(
            "recommendations"
        ),
    )


SQL_RECS_TEXT = """
SELECT customer_int, string_agg(CAST(article_int AS VARCHAR), ' ' ORDER BY rk) AS recommendations
FROM recs GROUP BY customer_int"""


@register("recommendations", sql_reco(with_txb(NEW_CUSTOMER_HOLDOUT_DAYS)) + SQL_RECS_TEXT)
def q_recommendations(spark, sf_dir):
    _, _, recs = reco_inputs(spark, sf_dir, True, NEW_CUSTOMER_HOLDOUT_DAYS)
    return recs_text(recs)


@register("recommendations_blocked", sql_reco(with_txb(NEW_CUSTOMER_HOLDOUT_DAYS)) + SQL_RECS_TEXT)
def q_recommendations_blocked(spark, sf_dir):
    """The same lists out of many small blocks of customers and articles."""
    _, _, recs = reco_inputs(
        spark, sf_dir, True, NEW_CUSTOMER_HOLDOUT_DAYS, customer_block_rows=500, article_block_rows=6
    )
    return recs_text(recs)


@register("recommendations_part", sql_reco(with_tx()) + SQL_RECS_TEXT)
def q_recommendations_part(spark, sf_dir):
    _, _, recs = reco_inputs(spark, sf_dir, False, HOLDOUT_DAYS)
    return recs_text(recs)


@register(
    "suppressed_pairs",
    sql_reco(with_txb(NEW_CUSTOMER_HOLDOUT_DAYS)) + "\nSELECT customer_int, article_int FROM excl",
)
def q_suppressed_pairs(spark, sf_dir):
    own = ModelInputs(spark, sf_dir, True, NEW_CUSTOMER_HOLDOUT_DAYS)
    train, af = own.train, own.af
    return R.excluded_articles(
        P.days_since_last_purchase(train), Q.repeat_gap_quantiles(train), PERCENTILE, af
    )


@register(
    "fallback_scores",
    sql_reco(with_tx()) + "\nSELECT article_int, round(s, 6) AS score FROM fb",
)
def q_fallback_scores(spark, sf_dir):
    own = ModelInputs(spark, sf_dir)
    cf, af = own.cf, own.af
    sample = T.sample_keys(cf, "id", SAMPLE_SIZE, SEED)
    out = R.fallback_scores(cf.join(sample, "id", "left_semi"), af, M.FIXED_INTERCEPT, K)
    return out.select("article_int", r6("score"))


@register(
    "actuals",
    with_txb(NEW_CUSTOMER_HOLDOUT_DAYS)
    + """
SELECT customer_int, string_agg(CAST(article_int AS VARCHAR), ' ' ORDER BY article_int) AS actuals
FROM (SELECT DISTINCT customer_int, article_int FROM holdout) GROUP BY customer_int""",
)
def q_actuals(spark, sf_dir):
    _, holdout = split_brand(spark, sf_dir, NEW_CUSTOMER_HOLDOUT_DAYS)
    out = EV.actuals(P.holdout_counts(holdout))
    return out.select(
        "customer_int",
        F.array_join(F.transform("actuals", lambda x: x.cast("string")), " ").alias("actuals"),
    )


@register(
    "average_precision",
    sql_reco(with_txb(NEW_CUSTOMER_HOLDOUT_DAYS)) + SQL_AP
    + "\nSELECT customer_int, round(apk, 6) AS apk FROM ap",
)
def q_average_precision(spark, sf_dir):
    _, holdout, recs = reco_inputs(spark, sf_dir, True, NEW_CUSTOMER_HOLDOUT_DAYS)
    return EV.average_precision(recs, holdout, TOP_N).select("customer_int", r6("apk"))


@register(
    "average_precision_lists",
    sql_reco(with_txb(NEW_CUSTOMER_HOLDOUT_DAYS)) + SQL_AP
    + "\nSELECT customer_int, round(apk, 6) AS apk FROM ap",
)
def q_average_precision_lists(spark, sf_dir):
    """The list form (Y1, Y3, Y5) on (actual list, recommended list) pairs."""
    _, holdout, recs = reco_inputs(spark, sf_dir, True, NEW_CUSTOMER_HOLDOUT_DAYS)
    lists = EV.actuals(holdout).join(recs, "customer_int", "left")
    return EV.with_average_precision(lists, TOP_N).select("customer_int", r6("apk"))


@register(
    "mean_average_precision",
    sql_reco(with_txb(NEW_CUSTOMER_HOLDOUT_DAYS)) + SQL_AP
    + "\nSELECT round(avg(apk), 6) AS map, CAST(count(*) AS BIGINT) AS n_customers FROM ap",
)
def q_mean_average_precision(spark, sf_dir):
    _, holdout, recs = reco_inputs(spark, sf_dir, True, NEW_CUSTOMER_HOLDOUT_DAYS)
    out = EV.mean_average_precision(EV.average_precision(recs, holdout, TOP_N))
    return out.select(r6("map"), "n_customers")


SQL_SUBMISSION = """
SELECT CAST(c.c_custkey AS VARCHAR) AS customer_id,
       string_agg(b.p_brand, ' ' ORDER BY r.rk) AS prediction
FROM recs r JOIN brands b ON r.article_int = b.brand_int
JOIN customer c ON c.c_custkey = r.customer_int
GROUP BY c.c_custkey"""


@register("submission", sql_reco(with_txb(NEW_CUSTOMER_HOLDOUT_DAYS)) + SQL_SUBMISSION)
def q_submission(spark, sf_dir):
    _, _, recs = reco_inputs(spark, sf_dir, True, NEW_CUSTOMER_HOLDOUT_DAYS)
    return EV.format_submission(recs, *submission_maps(spark, sf_dir))


def submission_maps(spark, sf_dir):
    """(customer_id, customer_int) and (article_id, article_int) of the brand purchases."""
    cmap = X.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_custkey").alias("customer_int")
    )
    amap = X.brand_ids(spark, sf_dir).select(
        F.col("p_brand").alias("article_id"), F.col("brand_int").alias("article_int")
    )
    return cmap, amap


# --------------------------------------------------------------------------------------------
# M1 initial parameters, M4/M5 fits

FIT_EPOCHS = 20  # as the reference's training scripts


def sql_normal(*parts: str) -> str:
    """Standard-normal draw of ``functions.hashing.normal`` over the same parts."""
    u1 = f"(({sql_hash(*parts, repr('n1'))} + 1.0::DOUBLE) / 4294967297.0::DOUBLE)"
    u2 = f"({sql_hash(*parts, repr('n2'))} / 4294967296.0::DOUBLE)"
    return f"(sqrt(-2.0::DOUBLE * ln({u1})) * cos(6.283185307179586::DOUBLE * {u2}))"


def sql_init(side: str, ids_sql: str, scale: float) -> str:
    cols = ", ".join(
        f"{sql_normal(repr(side), 'id', repr(p), repr(str(SEED)))} * {scale!r}::DOUBLE AS {p}"
        for p in M.param_names(K)
    )
    return f"SELECT '{side}' AS side, id, {cols} FROM ({ids_sql})"


INIT_SCALE = 0.5


@register(
    "init_factors",
    sql_model(with_tx())
    + f"""
SELECT side, id, {', '.join(f'round({p}, 6) + 0.0 AS {p}' for p in M.param_names(K))} FROM (
  {sql_init('customer', 'SELECT id FROM cf', INIT_SCALE)}
  UNION ALL
  {sql_init('article', 'SELECT id FROM af', INIT_SCALE)}
)
UNION ALL
SELECT 'global', 0, {', '.join('NULL' for _ in range(K))},
       round({sql_normal(repr('global'), repr(str(SEED)))} * {INIT_SCALE!r}::DOUBLE, 6) + 0.0""",
)
def q_init_factors(spark, sf_dir):
    inter = ModelInputs(spark, sf_dir).inter
    cust = M.init_factors(inter, "customer_int", K, SEED, "customer", INIT_SCALE)
    arts = M.init_factors(inter, "article_int", K, SEED, "article", INIT_SCALE)
    return model_rows(M.Model(cust, arts, M.init_intercept(SEED, INIT_SCALE), K))


def model_rows(model) -> DataFrame:
    """All parameters of a model as rows: both sides, and the global intercept as one more bias."""
    cols = ["id", *[r6(f"f{i}") for i in range(model.k)], r6("bias")]
    spark = model.customers.sparkSession
    schema = "side string, id bigint, " + ", ".join(f"f{i} double" for i in range(model.k)) + ", bias double"
    own = spark.createDataFrame([("global", 0, *[None] * model.k, float(model.intercept))], schema)
    return (
        model.customers.select(F.lit("customer").alias("side"), *cols)
        .unionByName(model.articles.select(F.lit("article").alias("side"), *cols))
        .unionByName(own.select("side", *cols))
    )


@register("fit_factors")
def q_fit_factors(spark, sf_dir):
    inter = ModelInputs(spark, sf_dir).weights
    model = M.fit_log_link_factors(
        inter, k=K, l2=L2, lr=LR, epochs=FIT_EPOCHS, batch_size=150_000,
        validation_share=0.005, seed=SEED,
    )
    return model_rows(model)


@register("fit_als")
def q_fit_als(spark, sf_dir):
    from affinity.operators.als import fit_als

    own = ModelInputs(spark, sf_dir)
    holdout, inter = own.split[1], own.inter
    model = fit_als(inter, rank=K, max_iter=10, reg=0.1, seed=SEED)
    fb = R.fallback_for(
        model.customers, model.articles, model.intercept, K, TOP_N, SAMPLE_SIZE, SEED
    )
    recs = R.recommend(holdout, model.customers, model.articles, model.intercept, K, TOP_N, None, fb)
    return recs_text(recs)
