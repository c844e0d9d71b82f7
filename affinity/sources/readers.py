"""Scans (S1-S5, S10).

Every reader is lazy and returns a DataFrame; nothing is collected. CSV files are read without
schema inference: ids stay text (leading zeros survive) and the known columns are cast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinity.functions.dates import parse_date
from affinity.operators.ids import numbered
from affinity.sources import schemas as S


def _read(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """CSV columns are bound by the header's names and read as text; other formats keep their
    own schema."""
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", True).option("inferSchema", False)
    return r.load(path)


def _typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the known columns; the others pass through. A missing known column is an error."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def read_customers(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Customers; ``customer_id`` as text, other columns pass through."""
    return _typed(_read(spark, path, fmt), {S.CUSTOMER_ID: "string"})


def read_articles(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Articles; ``article_id`` forced to text so leading zeros survive."""
    return _typed(_read(spark, path, fmt), {S.ARTICLE_ID: "string"})


def read_transactions(
    spark: SparkSession, path: str, fmt: str = "csv", lenient_dates: bool = False
) -> DataFrame:
    """S3 + X1: raw transactions with ``t_dat`` parsed as ``yyyy-MM-dd``.

    The four known columns are found by name, in any order; all others pass through.
    ``lenient_dates`` turns unparsable dates into NULL instead of failing.
    """
    df = _typed(
        _read(spark, path, fmt), {S.CUSTOMER_ID: "string", S.ARTICLE_ID: "string", S.PRICE: "double"}
    )
    return df.withColumn(S.DATE, parse_date(F.col(S.DATE), lenient=lenient_dates))


#: Types of the known columns of the derived tables, for formats that keep none (CSV).
DERIVED_TYPES = {
    S.CUSTOMER: "bigint",
    S.ARTICLE: "bigint",
    S.WEIGHT: "double",
    "count": "bigint",
    "max_price": "double",
    "days_since_last_purchase": "int",
    **{p: "double" for p in ("p10", "p25", "p50", "p75", "p90")},
}


def format_of(path: str) -> str:
    """``csv`` for a path that says so, else ``parquet``."""
    return "csv" if path.rstrip("/").lower().endswith(".csv") else "parquet"


def read_table(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """A derived table (holdout, history, cutoffs, id maps), Parquet or CSV."""
    fmt = fmt or format_of(path)
    df = _read(spark, path, fmt)
    if fmt != "csv":
        return df
    return _typed(df, {c: t for c, t in DERIVED_TYPES.items() if c in df.columns})


def read_interactions(
    spark: SparkSession, path: str, fmt: str | None = None, n_rows: int | None = None
) -> DataFrame:
    """S4 (+T3): weighted interactions from any table, optionally only the first ``n_rows``.

    Files have no row order in Spark, so "first" means first by (customer, article): a
    repeatable choice. The cap is the feature asked for, not a shortcut.
    """
    df = read_table(spark, path, fmt).select(S.CUSTOMER, S.ARTICLE, S.WEIGHT)
    return df if n_rows is None else first_rows(df, n_rows)


def first_rows(df: DataFrame, n_rows: int) -> DataFrame:
    """The first ``n_rows`` by (customer, article), null keys first, in that order; of rows equal in both
    keys, any.

    No task merges the rows: for whole-number keys the n-th customer, and within its rows the n-th
    article, are found by histograms over ever narrower ranges of the key (a few passes over one column,
    at most ``RANGES`` counts to the driver each), and the rows up to there are a filter. Keys of other types
    are numbered in range partitions. The order is that of a range-partitioned sort of the selected rows.
    """
    if int(n_rows) < 0:
        raise ValueError("n_rows must not be negative")
    return _selected(df, int(n_rows)).orderBy(F.col(S.CUSTOMER).asc_nulls_first(), F.col(S.ARTICLE).asc_nulls_first())


def _selected(df: DataFrame, n: int) -> DataFrame:
    if n == 0:
        return df.limit(0)
    keys = [S.CUSTOMER, S.ARTICLE]
    if not all(isinstance(df.schema[k].dataType, T.IntegralType) for k in keys):
        placed = numbered(df, [F.col(k).asc_nulls_first() for k in keys], "_place")
        return placed.where(F.col("_place") < n).drop("_place")
    customer = _nth(df, keys[0], n)
    if customer is None:
        return df
    value, before, here = customer
    within = df.where(F.col(keys[0]).eqNullSafe(value))
    article = _nth(within, keys[1], n - before) or (None, 0, 0)
    if before + here == n or article[0] is None and not article[2]:  # the customer's rows fit as a whole
        return df.where(_until(keys[0], value, True))
    last, before_last, equal = article
    below = _until(keys[0], value, False) | (F.col(keys[0]).eqNullSafe(value) & _until(keys[1], last, False))
    left = n - before - before_last
    if left == equal:
        return df.where(below | (F.col(keys[0]).eqNullSafe(value) & F.col(keys[1]).eqNullSafe(last)))
    return df.where(below).unionByName(within.where(F.col(keys[1]).eqNullSafe(last)).limit(left))


RANGES = 1024


def _until(key: str, value: int | None, included: bool) -> Column:
    """The key is below ``value`` (null is the lowest), or equal to it if ``included``. Never null."""
    if value is None:
        return F.col(key).isNull() if included else F.lit(False)
    upto = F.col(key) <= value if included else F.col(key) < value
    return F.col(key).isNull() | upto


def _nth(df: DataFrame, key: str, n: int) -> tuple[int | None, int, int] | None:
    """``(value, rows below it, rows of it)`` of the n-th smallest key (null is the lowest), or None if there are
    fewer rows than ``n``."""
    row = df.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count("*").alias("n"), F.count(key).alias("known")).first()
    if row["n"] < n:
        return None
    below = row["n"] - row["known"]
    if n <= below:
        return None, 0, below
    low, high, here = row["low"], row["high"], row["known"]
    while low < high:
        width = -(-(high - low + 1) // RANGES)
        part = df.select(key).where(F.col(key).between(low, high))
        place = F.floor((F.col(key).cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")) / F.lit(width).cast("decimal(20,0)"))
        counts = part.groupBy(place.cast("int").alias("place")).agg(F.count("*").alias("n")).collect()
        for place, here in sorted((r["place"], r["n"]) for r in counts):
            if below + here >= n:
                low, high = low + place * width, min(high, low + (place + 1) * width - 1)
                break
            below += here
    return low, below, here
