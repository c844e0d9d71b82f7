"""Latent-factor score expressions.

Factors are K scalar columns (``f0..f{K-1}``) so the dot product stays inside whole-stage
codegen; the sum is written out left to right so every engine adds in the same order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def factor_names(k: int, prefix: str = "f") -> list[str]:
    return [f"{prefix}{i}" for i in range(k)]


def dot(left: list[Column], right: list[Column]) -> Column:
    """Dot product of two equally long lists of columns, summed left to right."""
    if len(left) != len(right) or not left:
        raise ValueError("dot product needs two non-empty lists of equal length")
    acc = left[0] * right[0]
    for a, b in zip(left[1:], right[1:]):
        acc = acc + a * b
    return acc


def score_exponent(
    u: list[Column], v: list[Column], bias_c: Column, bias_a: Column, intercept: Column
) -> Column:
    """``u.v + b_c + b_a + g`` (the exponent of X8)."""
    return dot(u, v) + bias_c + bias_a + intercept

