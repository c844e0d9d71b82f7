"""Corpus pipeline over ``documents``: clean, deduplicate, mix and pack.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor kept and, but for the last,
returns the columns of ``documents``. ``run`` writes each stage's result to the shared checkpoint folder and
reads it back for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.llm import mixing, packing, simhash, substring, toxicity
from affinity.llm.shared import staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity network does not reject."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: 3-word shingles, at most 2 differing bits."""
    return simhash.keep_first(docs, shingle_words=3, max_bits=2)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of 20-word windows that start earlier elsewhere; ``n_chars`` follows."""
    return substring.without_repeats(docs, window=20).withColumn("n_chars", F.length("text").cast("bigint"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to 0.98 of the entropy of equal weights: every document at least once, no source more than
    twice. Where the two passes do not suffice for the entropy, it comes as near as they allow, with a warning."""
    mixed = mixing.mix(docs, target_entropy=0.98, max_repeats=2.0, cover_all=True, on_conflict="nearest")
    return mixed.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens."""
    return packing.pack(docs, length=1024).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]

# The stages include a trained network, XXH64 and a tokenizer, which SQL cannot express; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
