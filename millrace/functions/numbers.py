"""Numeric expressions: coercion, bins and encodings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Number words met in hand-typed columns.
SALARY_WORDS = {"SIXTY THOUSAND": 60000, "FIFTY THOUSAND": 50000, "SEVENTY THOUSAND": 70000}
AGE_WORDS = {"twenty": 20, "thirty": 30, "forty": 40, "fifty": 50}


def mapped(value: Column, mapping: dict, default=None) -> Column:
    """Look a value up in a small fixed map; unknown values give ``default``."""
    chain = None
    for key, result in mapping.items():
        test = value == F.lit(key)
        chain = F.when(test, F.lit(result)) if chain is None else chain.when(test, F.lit(result))
    return chain.otherwise(F.lit(default))


def to_number(text: Column, words: dict[str, int], lower: bool = False) -> Column:
    """Text to double: number words are mapped first, anything unreadable becomes null."""
    cleaned = F.trim(text.cast("string"))
    if lower:
        cleaned = F.lower(cleaned)
    spelled = mapped(cleaned, {k: float(v) for k, v in words.items()})
    return F.coalesce(spelled.cast("double"), cleaned.try_cast("double"))


def cut(value: Column, edges: list[float], labels: list[str]) -> Column:
    """Right-closed bins (a, b]; values outside the edges give null."""
    chain = F.when(value <= edges[0], F.lit(None).cast("string"))
    for edge, label in zip(edges[1:], labels):
        chain = chain.when(value <= edge, F.lit(label))
    return chain


def qcut(value: Column, inner_edges: list[Column], labels: list[str]) -> Column:
    """Quantile bins: the first holds everything up to the first inner edge, each closed on the right."""
    chain = None
    for edge, label in zip(inner_edges, labels):
        test = value <= edge
        chain = F.when(test, F.lit(label)) if chain is None else chain.when(test, F.lit(label))
    return chain.when(value.isNotNull(), F.lit(labels[-1]))


def clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), value))


def total_plus(columns: list[str], constant: int) -> Column:
    """Sum of columns plus a constant, e.g. family size from relatives aboard."""
    total = F.lit(constant)
    for name in columns:
        total = total + F.col(name)
    return total
