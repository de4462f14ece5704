"""Join shapes. Strategy is left to Spark's sizes and AQE."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordinal import with_ordinal
from millrace.operators.skew import salted_join, salted_outer_join


def inner(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right, on, "inner")


def left_outer(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right, on, "left")


def right_outer(left: DataFrame, right: DataFrame, on: list[str], salt_by: list[str] | None = None) -> DataFrame:
    """The right side kept. Spark cannot split hot keys of the left side here: name its row id in ``salt_by`` to spread them."""
    return salted_outer_join(left, right, on, salt_by, "right") if salt_by else left.join(right, on, "right")


def full_outer(left: DataFrame, right: DataFrame, on: list[str], salt_by: list[str] | None = None) -> DataFrame:
    """Both sides kept; joining by name coalesces the key columns. ``salt_by`` as in ``right_outer``."""
    return salted_outer_join(left, right, on, salt_by, "full") if salt_by else left.join(right, on, "full")


def star(fact: DataFrame, dimensions: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """Chain of joins from a fact to (dimension, key, how) entries."""
    for dimension, key, how in dimensions:
        fact = fact.join(dimension, key, how)
    return fact


def lookup_literal(fact: DataFrame, literal: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join to a dimension written in code; Spark knows its size and broadcasts it if it is small."""
    return fact.join(literal, on, how)


def having_match(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows with a match on the right (IN / EXISTS)."""
    return left.join(right, on, "left_semi")


def without_match(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows with no match on the right (NOT EXISTS)."""
    return left.join(right, on, "left_anti")


def update_from(target: DataFrame, source: DataFrame, key: str, sets: dict[str, Column]) -> DataFrame:
    """UPDATE ... FROM: set columns on target rows that have a source row, leave the others.

    ``source`` holds at most one row per key; expressions may use its columns.
    """
    extra = [c for c in source.columns if c != key]
    joined = target.join(
        source.select(key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"src_{c}") for c in extra]),
        key,
        "left",
    )
    return joined.select(
        *[
            F.when(F.col("_hit"), sets[c]).otherwise(F.col(c)).alias(c) if c in sets else F.col(c)
            for c in target.columns
        ]
    )


def beside(left: DataFrame, right: DataFrame, left_order: list[str], right_order: list[str], how: str = "full") -> DataFrame:
    """Put two tables side by side by row position in the stated total orders."""
    a = with_ordinal(left, left_order)
    b = with_ordinal(right, right_order)
    return a.join(b, "ordinal", how)


def two_hops(edges: DataFrame, people: DataFrame) -> DataFrame:
    """For each asked person, the friends of friends who are not yet friends.

    ``edges`` has (src, dst); ``people`` has (src), any number of them. Only the
    lists of people that an asked person knows are met, and the list of one who is
    known to many, or knows many, is spread over many tasks. Paths are reduced to
    distinct pairs before the anti join. ``edges`` is read several times, so store
    costly ones first.
    """
    links = edges.select("src", "dst").filter(F.col("src") != F.col("dst")).distinct()
    first = links.join(people.select("src").distinct(), "src", "left_semi")
    hop = links.select(F.col("src").alias("dst"), F.col("dst").alias("suggested"))
    hop = hop.join(first.select("dst").distinct(), "dst", "left_semi")
    paths = (
        salted_join(hop, first, ["dst"], salt_by=["suggested"])
        .filter(F.col("suggested") != F.col("src"))
        .select("src", "suggested")
        .distinct()
    )
    return paths.join(links.withColumnRenamed("dst", "suggested"), ["src", "suggested"], "left_anti")
