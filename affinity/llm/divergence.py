"""Source divergence audit: how far the term distributions of a language's sources lie apart.

Terms are runs of letters; a language keeps the terms that occur in enough of its documents. A group is the
documents of one source in one language. Every group and every language gives each kept term a smoothed share
``p = 1 + floor(scale * (count + a) / (N + a * V))``, an exact integer (N: the group's occurrences of kept terms,
V: the language's kept terms). Two questions are answered per group: how far is each other source of the
language (the sum of ``|p - q|`` over all kept terms), and which terms does it use more than its language does?

Both are answered on count cells instead of terms. All terms of a group with the same count in the group
and the same count in the other distribution have the same ``f = |p - q|``: the terms are grouped by that
pair of counts, ``f`` is evaluated once per cell, equal values are merged, and the cumulative multiplicity of
the higher values is a value's first rank. Only cells that reach the ranks asked for are expanded to terms, in
UTF-8 order. In the sums over two sources, terms of one source alone are counted from that source's
histogram of counts, so only terms that both sources use are paired.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm.shared import staged

#: runs of ASCII letters and of anything beyond ASCII, on lower-cased UTF-8 bytes
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
IN_TERM = np.array([bool(TERM.match(bytes([b]))) for b in range(256)])
#: bytes of texts counted together, bytes of a piece of a longer text, and rows held before they are added up
RUN_BYTES, PIECE_BYTES, HELD_ROWS = 1 << 21, 1 << 22, 1 << 19


def _texts(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def _codes(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def run_counts(texts: list[bytes], groups: list[int]) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """``(group, term, n, docs)`` of a run of texts; ``groups[i]`` is the number of text i's group."""
    raw = np.frombuffer(b" ".join(texts).lower() + b" ", np.uint8)  # of ASCII letters only
    inside = IN_TERM[raw]
    behind = np.zeros(len(raw), bool)
    behind[1:] = inside[:-1] & ~inside[1:]
    data = np.where(inside, raw, 32).astype(np.uint8)[inside | behind]  # terms, each with one space behind it
    end = np.nonzero(data == 32)[0]
    offsets = np.concatenate(([0], end + 1)).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    ids, spaced = _codes(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(end), buffers))
    terms = pc.binary_slice(spaced.cast(pa.binary()), 0, -1)
    limits = np.cumsum([len(t) + 1 for t in texts])
    owner = np.searchsorted(limits, np.nonzero(behind)[0] - 1, side="right")
    seen, in_text = _codes(pa.array(owner * max(1, len(terms)) + ids))
    in_text = in_text.to_numpy()
    times = np.bincount(seen, minlength=len(in_text))
    pair = np.asarray(groups)[in_text // max(1, len(terms))] * max(1, len(terms)) + in_text % max(1, len(terms))
    place, pairs = _codes(pa.array(pair))
    pairs = pairs.to_numpy()
    n = np.bincount(place, weights=times, minlength=len(pairs)).astype(np.int64)
    docs = np.bincount(place, minlength=len(pairs))
    return pairs // max(1, len(terms)), terms.take(pa.array(pairs % max(1, len(terms)))), n, docs


def long_counts(text: bytes) -> Counter:
    """The terms of one long text, in pieces that end between terms."""
    found: Counter = Counter()
    at = 0
    while at < len(text):
        to = at + PIECE_BYTES
        within = TERM.match(text, to - 1) if to < len(text) else None
        to = within.end() if within else to
        found.update(TERM.findall(text[at:to].lower()))
        at = to
    return found


def term_tally(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """``(lang, source, term, n, docs)``, counted within tasks; a term may have several rows."""

    def run(batches):
        number: dict = {}  # of the groups seen by the task
        held: list[pa.Table] = []

        def counted(groups, terms, n, in_docs):
            names = ["group", "term", "n", "docs"]
            held.append(pa.table([pa.array(groups, pa.int64()), terms, pa.array(n, pa.int64()), pa.array(in_docs, pa.int64())], names))

        def added() -> pa.Table:
            return pa.concat_tables(held).group_by(["group", "term"]).aggregate([("n", "sum"), ("docs", "sum")])

        def rows(table: pa.Table):
            keys = list(number)
            for part in table.to_batches(1 << 16):
                group = part.column("group").to_numpy()
                sides = [pa.array([k[i] for k in keys], pa.binary()).take(pa.array(group)) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [*sides, part.column("term"), part.column("n_sum"), part.column("docs_sum")],
                    ["lang", "source", "term", "n", "docs"],
                )

        for batch in batches:
            keys = zip(*(batch.column(i).to_pylist() for i in (0, 1)))
            groups = [number.setdefault(key, len(number)) for key in keys]
            texts, own, size = [], [], 0
            for i, value in enumerate(batch.column(2)):
                text = value.as_py()
                if len(text) > RUN_BYTES:
                    found = long_counts(text)
                    counted([groups[i]] * len(found), pa.array(list(found), pa.binary()), list(found.values()), [1] * len(found))
                else:
                    texts.append(text)
                    own.append(groups[i])
                    size += len(text)
                if texts and (size >= RUN_BYTES or i == batch.num_rows - 1):
                    counted(*run_counts(texts, own))
                    texts, own, size = [], [], 0
                if sum(t.num_rows for t in held) >= HELD_ROWS:
                    merged = added()
                    if merged.num_rows * 2 >= HELD_ROWS:  # adding up no longer helps
                        yield from rows(merged)
                        held.clear()
                    else:
                        held[:] = [merged.rename_columns({"n_sum": "n", "docs_sum": "docs"})]
        if held:
            yield from rows(added())

    counts = docs.select(
        _texts(F.col(lang_col)).cast("binary").alias("lang"),
        _texts(F.col(source_col)).cast("binary").alias("source"),
        _texts(F.col(text_col)).cast("binary").alias("text"),
    ).mapInArrow(run, "lang binary, source binary, term binary, n long, docs long")
    return counts.select(*[F.col(c).cast("string").alias(c) for c in ("lang", "source", "term")], "n", "docs")


def kept_counts(docs: DataFrame, min_docs: int, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """``(lang, source, term, n, n_lang, first)`` of the kept terms that occur in a group; ``first`` marks one
    row per term of a language. One shuffle, by language and term, serves the sums per group and language."""
    tally = term_tally(docs, text_col, lang_col, source_col).repartition("lang", "term")
    counts = tally.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_lang = Window.partitionBy("lang", "term")  # a row per source of the language
    counts = counts.withColumns(
        {
            "n_lang": F.sum("n").over(of_lang),
            "docs": F.sum("docs").over(of_lang),
            "first": F.row_number().over(of_lang.orderBy("source")) == 1,
        }
    )
    return counts.where(F.col("docs") >= min_docs).select("lang", "source", "term", "n", "n_lang", "first")


def share(count: Column, total: Column, terms: Column, smoothing: int, scale: int) -> Column:
    """The smoothed share as an exact integer (a decimal product: it may pass 64 bits); null without terms."""
    upper = (count + F.lit(smoothing)).cast("decimal(20,0)") * F.lit(scale).cast("decimal(18,0)")
    lower = (total + terms * F.lit(smoothing)).cast("decimal(20,0)")
    return F.when(terms > 0, F.lit(1) + F.call_function("div", upper, lower))


def audit(
    docs: DataFrame,
    min_docs: int = 30,
    top_terms: int = 50,
    smoothing: int = 5,
    scale: int = 1_000_000_000,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` for every group, as the module says.

    Part ``pair``: every other source of the language, by falling distance, all of them. Part ``term``: the
    terms with a larger share in the group than in its language, by falling difference, the first
    ``top_terms``. Equal values are ranked in the UTF-8 order of the item.

    Null texts, languages and sources count as empty. Repeated rows are documents of their own; ids are not
    read, other columns are ignored. A language without kept terms has distances of 0 and no terms; a source
    alone in its language has no pair. An empty table gives an empty result.
    """
    if min_docs < 1 or top_terms < 0 or smoothing < 1 or scale < 1:
        raise ValueError("min_docs, smoothing and scale must be positive, top_terms not negative")
    kept = staged(kept_counts(docs, min_docs, text_col, lang_col, source_col), "kept_terms")
    langs = kept.groupBy("lang").agg(F.count_if("first").alias("terms"), F.sum("n").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    occurring = docs.select(_texts(F.col(lang_col)).alias("lang"), _texts(F.col(source_col)).alias("source")).distinct()
    groups = occurring.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0)
    zero = share(F.lit(0).cast("bigint"), F.col("total"), F.col("terms"), smoothing, scale)
    groups = staged(groups.withColumn("zero", zero), "groups")  # a row per group
    pairs = _pair_values(kept, groups, smoothing, scale)
    terms = _term_values(kept, groups, top_terms, smoothing, scale)
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")


def _pair_values(kept: DataFrame, groups: DataFrame, smoothing: int, scale: int) -> DataFrame:
    """Sums of ``|p - q|`` over all kept terms for every two sources of a language.

    With ``d(c, e)`` the difference at counts c and e, the sum over all V terms is ``V d(0, 0)``, plus ``d(c, 0) -
    d(0, 0)`` over the terms of the one source and likewise of the other, plus ``d(c, e) - d(c, 0) - d(0, e) +
    d(0, 0)`` over the terms of both. The middle sums come from the sources' histograms of counts.
    """

    def side(name: str) -> DataFrame:
        columns = [F.col(c).alias(f"{name}_{c}") for c in ("source", "total", "zero")]
        return groups.select("lang", "terms", *columns) if name == "a" else groups.select("lang", *columns)

    def p(name: str) -> Column:
        return share(F.col(f"{name}_n"), F.col(f"{name}_total"), F.col("terms"), smoothing, scale)

    a_zero, b_zero = F.col("a_zero"), F.col("b_zero")
    low = F.least("a_source", "b_source").alias("low")
    high = F.greatest("a_source", "b_source").alias("high")
    ordered = side("a").join(side("b"), "lang").where(F.col("a_source") != F.col("b_source"))
    neither = ordered.where(F.col("a_source") < F.col("b_source")).select(
        "lang", low, high, F.coalesce(F.col("terms") * F.abs(a_zero - b_zero), F.lit(0)).alias("value")
    )
    histogram = kept.groupBy("lang", F.col("source").alias("a_source"), F.col("n").alias("a_n")).agg(
        F.count("*").alias("cells")
    )
    alone = histogram.join(ordered, ["lang", "a_source"]).select(
        "lang", low, high, (F.col("cells") * (F.abs(p("a") - b_zero) - F.abs(a_zero - b_zero))).alias("value")
    )

    def counts(name: str) -> DataFrame:
        return kept.select("lang", "term", F.col("source").alias(f"{name}_source"), F.col("n").alias(f"{name}_n"))

    both = counts("a").join(counts("b"), ["lang", "term"]).where(F.col("a_source") < F.col("b_source"))
    both = both.groupBy("lang", "a_source", "b_source", "a_n", "b_n").agg(F.count("*").alias("cells"))
    both = both.join(side("a"), ["lang", "a_source"]).join(side("b"), ["lang", "b_source"])
    both = both.withColumn("pa", p("a")).withColumn("pb", p("b"))
    extra = F.abs(F.col("pa") - F.col("pb")) - F.abs(F.col("pa") - b_zero) - F.abs(a_zero - F.col("pb")) + F.abs(a_zero - b_zero)
    both = both.select("lang", low, high, (F.col("cells") * extra).alias("value"))

    sums = neither.unionByName(alone).unionByName(both).groupBy("lang", "low", "high").agg(F.sum("value").alias("value"))
    ways = F.array(F.struct(F.col("low").alias("source"), F.col("high").alias("item")),
                   F.struct(F.col("high").alias("source"), F.col("low").alias("item")))
    rows = sums.select("lang", "value", F.explode(ways).alias("way")).select("lang", "way.*", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    return rows.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


def _term_values(kept: DataFrame, groups: DataFrame, top: int, smoothing: int, scale: int) -> DataFrame:
    """The first ``top`` terms of each group by ``p - q``: cells, values, first ranks, then the terms."""
    key = ["lang", "source"]
    cells = kept.groupBy(*key, "n", "n_lang").agg(F.count("*").alias("cells")).join(groups, key)
    p = share(F.col("n"), F.col("total"), F.col("terms"), smoothing, scale)
    q = share(F.col("n_lang"), F.col("lang_total"), F.col("terms"), smoothing, scale)
    cells = cells.select(*key, "n", "n_lang", "cells", (p - q).alias("value")).where("value > 0")
    falling = Window.partitionBy(*key).orderBy(F.col("value").desc())
    values = cells.groupBy(*key, "value").agg(F.sum("cells").alias("cells"))
    values = values.withColumn("place", F.row_number().over(falling)).where(F.col("place") <= top)  # each holds a term
    higher = F.sum("cells").over(falling.rowsBetween(Window.unboundedPreceding, -1))
    values = values.withColumn("higher", F.coalesce(higher, F.lit(0))).where(F.col("higher") < top)
    reached = cells.drop("cells").join(values.select(*key, "value", "higher"), [*key, "value"])
    terms = kept.select(*key, "term", "n", "n_lang").join(reached, [*key, "n", "n_lang"])
    within = F.row_number().over(Window.partitionBy(*key, "value").orderBy("term"))
    terms = terms.withColumn("within", within).where(F.col("within") <= top)
    rank = (F.col("higher") + F.col("within")).cast("int")
    return terms.select(*key, F.lit("term").alias("part"), F.col("term").alias("item"), "value", rank.alias("rank")).where(
        F.col("rank") <= top
    )
