"""Column expressions: everything here returns a ``Column`` and runs JVM-side."""

from affinity.functions.dates import days_between, parse_date
from affinity.functions.hashing import bucket, hash32, normal, uniform
from affinity.functions.ranking import average_precision, joined_ids, top_k
from affinity.functions.scores import dot, factor_names, score_exponent
from affinity.functions.weights import (
    combined_weight,
    positive_weight,
    price_ratio,
    price_weight,
    time_weight,
)

__all__ = [
    "average_precision",
    "bucket",
    "combined_weight",
    "days_between",
    "dot",
    "factor_names",
    "hash32",
    "joined_ids",
    "normal",
    "parse_date",
    "positive_weight",
    "price_ratio",
    "price_weight",
    "score_exponent",
    "time_weight",
    "top_k",
    "uniform",
]
