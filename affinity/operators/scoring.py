"""Scoring, suppression rules and top-N recommendations.

All-pairs scoring never materialises customer x article rows, never gathers a table on the driver and never
shuffles pairs of blocks. The articles are written once as files of blocks of articles that lie close together;
customers are dealt to tasks, and a task goes through the blocks with the best N articles so far of each of its
customers. A block can be left out for a customer whose N-th score it cannot reach: no score in it exceeds the sum
of ``u_i`` times the block's highest (``u_i`` < 0: lowest) factor i, nor by Cauchy-Schwarz ``|u| * largest norm``,
plus largest bias + b_c + g. A customer's block with the highest such bound is scored before all others, so that
the N-th score is high when they are judged. Blocks that no customer of a task needs are not even read. Leaving out
changes no result: a block is scored whenever a tie with the N-th score is possible, or a customer has fewer than N
scorable articles so far.

Ranking: scorable articles by exponent descending (``exp`` is monotone, so this is the score
order), then suppressed articles (they all score -1.0), then articles whose exponent is NaN;
article id ascending within ties. The exponent is summed left to right in the same order as the
SQL form, so ties break identically.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.functions.scores import factor_names
from affinity.operators.quantiles import NAMES as PERCENTILES
from affinity.sources import schemas as S
from affinity.sources.blocks import Block, read_block, write_blocks

# The functions below run in Python workers. Pickling this module by value ships them (and the
# numpy helpers they call) with each task, so executors need no copy of the package on their
# path; they only use numpy and pyarrow.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows scored together, rows of an article block, and customers of a task.
CUSTOMER_BLOCK_ROWS = 4096
ARTICLE_BLOCK_ROWS = 2048
CUSTOMER_BLOCKS_PER_TASK = 16
CHUNK_CELLS = 4_000_000

TOP_SCHEMA = "customer_int long, rank int, article_int long, exponent double, suppressed boolean"
# Classes of the ranking, and of a place that no article has taken yet.
SCORABLE, SUPPRESSED, NOT_A_NUMBER, FREE = range(4)


def excluded_articles(
    history: DataFrame,
    cutoffs: DataFrame,
    percentile: str = "p50",
    model_articles: DataFrame | None = None,
    customer: str = S.CUSTOMER,
    article: str = S.ARTICLE,
    days: str = "days_since_last_purchase",
) -> DataFrame:
    """R3 building block (J5, F8, J7): pairs bought within the article's repeat-gap cutoff.

    ``history`` = (customer, article, days since last purchase); ``cutoffs`` = per-article
    quantiles. Articles without a cutoff row are never excluded (inner join); articles
    outside the model are dropped.
    """
    if percentile not in PERCENTILES:
        raise ValueError(f"percentile must be one of {PERCENTILES}")
    cut = cutoffs.select(article, percentile)
    ex = history.join(cut, article).where(F.col(days) <= F.col(percentile))
    if model_articles is not None:
        ex = ex.join(model_articles.select(F.col("id").alias(article)), article, "left_semi")
    return ex.select(customer, article)


def _exponents(u: np.ndarray, bu: np.ndarray, mat: np.ndarray, ba: np.ndarray, g: float):
    """u.v + b_c + b_a + g for a block, added left to right like the SQL expression."""
    e = u[:, 0:1] * mat[:, 0][None, :]
    for i in range(1, u.shape[1]):
        e = e + u[:, i : i + 1] * mat[:, i][None, :]
    e = e + bu[:, None]
    e = e + ba[None, :]
    return e + g


def _top_rows(e: np.ndarray, sup: np.ndarray, n: int):
    """Indices of the best n columns of each row: (class, -e, column) ascending, where class is 0
    for scorable, 1 for suppressed and 2 for NaN columns.

    Columns are in ascending article-id order. The whole block is ranked at once, of ties at the n-th place
    the first columns; only rows with fewer than n scorable articles take a path of their own.
    """
    rows, a = e.shape
    kind = np.where(np.isnan(e), 2, np.where(sup, 1, 0)).astype(np.int8)
    key = np.where(kind > 0, -np.inf, e)
    if a <= n:
        return np.lexsort((np.broadcast_to(np.arange(a), key.shape), -key, kind), axis=1)
    thr = np.partition(key, a - n, axis=1)[:, a - n][:, None]
    above, tied = key > thr, key == thr
    chosen = above | (tied & (np.cumsum(tied, axis=1) <= n - above.sum(axis=1, keepdims=True)))
    part = np.nonzero(chosen)[1].reshape(rows, n)
    vals = np.take_along_axis(key, part, axis=1)
    out = np.take_along_axis(part, np.lexsort((part, -vals), axis=1), axis=1)
    for r in np.nonzero(np.isneginf(thr[:, 0]))[0]:
        out[r] = np.lexsort((np.arange(a), -key[r], kind[r]))[:n]
    return out


class _Best:
    """The best ``n`` articles so far of each customer of a task, in ranking order."""

    def __init__(self, customers: int, n: int):
        self.n = n
        self.kind = np.full((customers, n), FREE, np.int8)
        self.value = np.full((customers, n), -np.inf)
        self.article = np.zeros((customers, n), np.int64)

    def nth(self) -> np.ndarray:
        """The N-th score, -inf where fewer than N scorable articles are known."""
        return self.nth_of(slice(None))

    def nth_of(self, rows: np.ndarray) -> np.ndarray:
        return np.where(self.kind[rows, -1] == SCORABLE, self.value[rows, -1], -np.inf)

    def add(self, rows: np.ndarray, ids: np.ndarray, e: np.ndarray, sup: np.ndarray) -> None:
        """Merge the scores ``e`` of the articles ``ids`` into the lists of ``rows``."""
        columns = _top_rows(e, sup, self.n)
        at = np.arange(len(rows))[:, None]
        value = e[at, columns]
        kind = np.where(np.isnan(value), NOT_A_NUMBER, np.where(sup[at, columns], SUPPRESSED, SCORABLE))
        kind = np.concatenate([self.kind[rows], kind], axis=1)
        value = np.concatenate([self.value[rows], value], axis=1)
        article = np.concatenate([self.article[rows], ids[columns]], axis=1)
        key = np.where(kind == SCORABLE, value, -np.inf)
        order = np.lexsort((article, -key, kind), axis=1)[:, : self.n]
        self.kind[rows], self.value[rows], self.article[rows] = kind[at, order], value[at, order], article[at, order]


def _customers(batches, names: list[str]):
    """The customers of a task: ids, factors, biases, and their suppressed pairs as (row, article)."""
    table = pa.Table.from_batches(list(batches))
    ids = table.column("id").to_numpy()
    values = np.stack([table.column(n).to_numpy() for n in names], axis=1)
    rows = articles = np.zeros(0, np.int64)
    if "x" in table.column_names:
        lists = table.column("x").combine_chunks()
        sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        rows, articles = np.repeat(np.arange(len(ids)), sizes), lists.flatten().to_numpy(zero_copy_only=False)
    return ids, np.ascontiguousarray(values[:, :-1]), values[:, -1], rows, articles


def _scorer(names: list[str], n: int, g: float, blocks: list[Block], chunk_rows: int, report: bool = False):
    """The function of a task; ``chunk_rows`` customers are scored together. With ``report`` it gives the pairs scored and all pairs instead of the lists."""

    def run(batches):
        first = next(batches, None)
        if first is None:
            return
        ids, u, bu, x_row, x_article = _customers([first, *batches], names)
        if not len(ids):
            return
        length, best, scored = np.sqrt((u * u).sum(axis=1)), _Best(len(ids), n), 0
        by_article = np.argsort(x_article, kind="stable")
        x_row, x_article = x_row[by_article], x_article[by_article]
        sides = np.concatenate([np.maximum(u, 0.0), np.minimum(u, 0.0)], axis=1)
        norm, bias = np.array([b.norm for b in blocks]), np.array([b.bias for b in blocks])
        corners = np.array([[*b.high, *b.low] for b in blocks]).T
        together = max(1, min(1024, CHUNK_CELLS // len(ids)))
        groups = [slice(at, at + together) for at in range(0, len(blocks), together)]

        def bounds(some: slice) -> np.ndarray:
            """What no score of a customer (row) in a block (column) exceeds; NaN: unknown."""
            with np.errstate(invalid="ignore", over="ignore"):
                reach = length[:, None] * norm[None, some]
                size = np.abs(reach) + np.abs(bias[None, some]) + np.abs(bu)[:, None] + abs(g)
                most = np.minimum(reach, sides @ corners[:, some])
                return most + bias[None, some] + bu[:, None] + g + 1e-12 * size  # rounding of the sums included

        def score(block: Block, wanted: np.ndarray) -> int:
            """Merge the block's articles into the lists of the customers ``wanted``."""
            articles, v, ba = read_block(block, names)
            start, end = np.searchsorted(x_article, articles, "left"), np.searchsorted(x_article, articles, "right")
            times = end - start
            hit_column = np.repeat(np.arange(len(articles)), times)
            hit_row = x_row[np.repeat(end - np.cumsum(times), times) + np.arange(times.sum())]
            at_once = max(1, min(chunk_rows, CHUNK_CELLS // max(1, len(articles))))
            place = np.full(len(ids), -1)
            for at in range(0, len(wanted), at_once):
                rows = wanted[at : at + at_once]
                place[rows] = np.arange(len(rows))
                sup = np.zeros((len(rows), len(articles)), bool)
                here = place[hit_row] >= 0
                sup[place[hit_row[here]], hit_column[here]] = True
                place[rows] = -1
                e = _exponents(u[rows], bu[rows], v, ba, g)
                with np.errstate(invalid="ignore"):
                    top = np.where(sup | np.isnan(e), -np.inf, e).max(axis=1)
                    use = ~(top < best.nth_of(rows))
                if use.any():
                    best.add(rows[use], articles, e[use], sup[use])
            return len(wanted) * len(articles)

        first_block, highest = np.full(len(ids), -1), np.full(len(ids), -np.inf)
        for some in groups:
            bound = bounds(some)
            bound[np.isnan(bound)] = -np.inf
            at = bound.argmax(axis=1)
            bound = bound[np.arange(len(ids)), at]
            higher = bound > highest
            first_block[higher], highest[higher] = at[higher] + some.start, bound[higher]
        by_block = np.argsort(first_block, kind="stable")
        starts = np.searchsorted(first_block[by_block], np.arange(len(blocks) + 1))
        for i in np.nonzero(np.diff(starts))[0]:
            scored += score(blocks[i], by_block[starts[i] : starts[i + 1]])
        for some in groups:
            bound, nth = bounds(some), best.nth()
            possible = ~(bound < nth[:, None])  # NaN: wanted
            for i in np.nonzero(possible.any(axis=0))[0]:
                wanted = np.nonzero(possible[:, i])[0]
                open_ = ~(bound[wanted, i] < best.nth_of(wanted)) & (first_block[wanted] != some.start + i)
                if open_.any():
                    scored += score(blocks[some.start + i], wanted[open_])
        if report:
            total = len(ids) * sum(b.rows for b in blocks)
            yield pa.RecordBatch.from_pydict({"scored": [scored], "pairs": [total]})
            return
        row, place = np.nonzero(best.kind != FREE)
        for at in range(0, len(row), 1 << 20):
            r, p = row[at : at + (1 << 20)], place[at : at + (1 << 20)]
            value = best.value[r, p]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[r]), pa.array((p + 1).astype(np.int32)), pa.array(best.article[r, p]),
                    pa.array(value, mask=np.isnan(value)), pa.array(best.kind[r, p] == SUPPRESSED),
                ],
                ["customer_int", "rank", "article_int", "exponent", "suppressed"],
            )

    return run


def _dealt(table: DataFrame, rows_per_task: int) -> DataFrame:
    """Rows dealt to tasks by id: a task per slot or more, and at most about ``rows_per_task`` rows in one."""
    n = table.count()
    slots = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(max(1, math.ceil(n / rows_per_task), min(2 * slots, math.ceil(n / 64))), "id")


def top_n_scored(
    customer_factors: DataFrame,
    article_factors: DataFrame,
    intercept: float,
    k: int,
    n: int,
    exclusions: DataFrame | None = None,
    customer: str = S.CUSTOMER,
    article: str = S.ARTICLE,
    customer_block_rows: int = CUSTOMER_BLOCK_ROWS,
    article_block_rows: int = ARTICLE_BLOCK_ROWS,
    report: bool = False,
) -> DataFrame:
    """R1 + R3 + R4 for modelled customers, long form: customer_int, rank, article_int,
    exponent (null if it is not a number), suppressed (rank 1..N per customer).

    ``customer_factors`` has ``id, f0.., bias`` for the customers to score; ``exclusions`` has
    (customer, article) pairs to suppress. The block sizes bound a task's memory and change no result.
    ``report`` gives, per task, the pairs that were scored and all pairs instead: ``scored, pairs``.
    """
    names = [*factor_names(k), "bias"]
    rows = customer_factors.select(F.col("id").cast("long").alias("id"), *names)
    if exclusions is not None:
        pairs = exclusions.select(F.col(customer).cast("long").alias("id"), F.col(article).cast("long").alias("a"))
        rows = rows.join(pairs.groupBy("id").agg(F.collect_set("a").alias("x")), "id", "left")
    blocks = write_blocks(article_factors.withColumn("id", F.col("id").cast("long")), names, article_block_rows)
    run = _scorer(names, int(n), float(intercept), blocks, max(1, int(customer_block_rows)), report)
    dealt = _dealt(rows, max(1, int(customer_block_rows)) * CUSTOMER_BLOCKS_PER_TASK)
    return dealt.mapInArrow(run, "scored long, pairs long" if report else TOP_SCHEMA)


def top_n_lists(
    customer_factors: DataFrame,
    article_factors: DataFrame,
    intercept: float,
    k: int,
    n: int,
    exclusions: DataFrame | None = None,
    customer: str = S.CUSTOMER,
    article: str = S.ARTICLE,
    customer_block_rows: int = CUSTOMER_BLOCK_ROWS,
    article_block_rows: int = ARTICLE_BLOCK_ROWS,
) -> DataFrame:
    """R1 + R3 + R4 as one list per customer: ``customer, recommendations`` (best first)."""
    top = top_n_scored(customer_factors, article_factors, intercept, k, n, exclusions, customer,
                       article, customer_block_rows, article_block_rows)
    return to_lists(top, customer)


def fallback_scores(
    sample_factors: DataFrame,
    article_factors: DataFrame,
    intercept: float,
    k: int,
    customer_block_rows: int = CUSTOMER_BLOCK_ROWS,
    article_block_rows: int = ARTICLE_BLOCK_ROWS,
) -> DataFrame:
    """R2 + A9: mean predicted score of every article over a sample of customers of any size.

    Here the sample is written as blocks, the articles are dealt to tasks, and a task adds up the scores of
    its articles over the blocks.
    """
    names, g = [*factor_names(k), "bias"], float(intercept)
    blocks = write_blocks(sample_factors.select("id", *names), names, customer_block_rows, [F.col("id")])

    def run(batches):
        first = next(batches, None)
        if first is None or not blocks:
            return
        ids, v, ba, _, _ = _customers([first, *batches], names)
        total = np.zeros(len(ids))
        for block in blocks:
            _, u, bu = read_block(block, names)
            chunk = max(1, CHUNK_CELLS // max(1, len(ids)))
            for s in range(0, len(u), chunk):
                total += np.exp(_exponents(u[s : s + chunk], bu[s : s + chunk], v, ba, g)).sum(axis=0)
        scores = total / sum(b.rows for b in blocks)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(scores)], ["article_int", "score"])

    articles = article_factors.select(F.col("id").cast("long").alias("id"), *names)
    return _dealt(articles, max(1, int(article_block_rows)) * CUSTOMER_BLOCKS_PER_TASK).mapInArrow(
        run, "article_int long, score double"
    )


def fallback_list(fallback: DataFrame, n: int) -> DataFrame:
    """R2 -> R4: one row with the top-N fallback articles (score desc, id asc) as a list."""
    top = fallback.orderBy(F.col("score").desc(), F.col("article_int")).limit(int(n))
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("article_int").alias("a"))))
    return top.agg(F.transform(ordered, lambda x: x["a"]).alias("recommendations"))


def to_lists(top: DataFrame, customer: str = S.CUSTOMER) -> DataFrame:
    """Long top-N rows -> one list per customer in rank order (at most N per customer)."""
    ordered = F.sort_array(F.collect_list(F.struct(F.col("rank"), F.col("article_int"))))
    return top.groupBy(F.col("customer_int").alias(customer)).agg(
        F.transform(ordered, lambda x: x["article_int"]).alias("recommendations")
    )


def recommend(
    customers: DataFrame,
    customer_factors: DataFrame,
    article_factors: DataFrame,
    intercept: float,
    k: int,
    n: int,
    exclusions: DataFrame | None = None,
    fallback: DataFrame | None = None,
    customer: str = S.CUSTOMER,
    customer_block_rows: int = CUSTOMER_BLOCK_ROWS,
    article_block_rows: int = ARTICLE_BLOCK_ROWS,
) -> DataFrame:
    """Modelled customers get model scores with suppression; the others get the fallback
    list unchanged. Output: customer, recommendations (list of article ids, best first).
    """
    wanted = customers.select(customer).distinct()
    known = customer_factors.join(wanted.select(F.col(customer).alias("id")), "id", "left_semi")
    scored = top_n_lists(known, article_factors, intercept, k, n, exclusions, customer,
                         customer_block_rows=customer_block_rows, article_block_rows=article_block_rows)
    if fallback is None:
        return scored
    new = wanted.join(customer_factors.select(F.col("id").alias(customer)), customer, "left_anti")
    fb = fallback.select("recommendations").scalar()
    return scored.unionByName(new.select(customer, fb.alias("recommendations")))


def fallback_for(
    customer_factors: DataFrame,
    article_factors: DataFrame,
    intercept: float,
    k: int,
    n: int,
    sample_size: int = 1000,
    seed: int = 0,
) -> DataFrame:
    """R2 end to end: sample modelled customers (T4), average their scores, keep the top N."""
    from affinity.operators.sampling import sample_keys

    sample = sample_keys(customer_factors, "id", sample_size, seed)
    sampled = customer_factors.join(sample, "id", "left_semi")
    return fallback_list(fallback_scores(sampled, article_factors, intercept, k), n)
