"""Joins whose big side may hold one key in a large share of its rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, on: list[str], share: float = 0.001) -> DataFrame:
    """Keys that hold more than ``share`` of the rows.

    There can be at most ``1 / share`` of them whatever the data size, so the
    result may be broadcast. Counting is combined map-side before it shuffles.
    """
    total = df.agg((F.count(F.lit(1)) * share).alias("n")).scalar()
    return df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > total).select(*on)


def salted_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    salt_by: list[str],
    how: str = "inner",
    salts: int = 64,
    share: float = 0.001,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi join that spreads the hot keys of ``big`` over ``salts`` tasks.

    ``salt_by`` names columns of ``big`` that differ between rows of one key (a
    row id), so a recomputed task salts its rows the same way. Only rows of
    ``small`` with a hot key are repeated, at most ``salts / share`` times the
    rows such a key has. The result equals the plain join: each ``big`` row
    meets every matching ``small`` row exactly once. ``big`` is read again to
    count its keys, so a costly one should be stored first; for several joins on
    one key, count once with ``hot_keys``, store the result, and pass it as ``hot``.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how} join cannot be salted on the left side")
    hot = hot_keys(big, on, share) if hot is None else hot
    hot = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    spread = F.pmod(F.xxhash64(*salt_by), F.lit(salts)).cast("int")
    # Rows with a null key match nothing; spreading them keeps them off one task.
    unmatched = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    left = big.join(hot, on, "left").withColumn(
        "_salt", F.when(F.col("_hot") | unmatched, spread).otherwise(F.lit(0))
    )
    right = small.join(hot, on, "left").withColumn(
        "_salt",
        F.explode(
            F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        ),
    )
    return left.drop("_hot").join(right.drop("_hot"), [*on, "_salt"], how).drop("_salt")


def salted_outer_join(
    left: DataFrame, right: DataFrame, on: list[str], salt_by: list[str], how: str, salts: int = 64, share: float = 0.001
) -> DataFrame:
    """Right or full outer join whose left side may have hot keys.

    An outer join cannot split the side it does not keep, so the matched part is
    a salted join and the right rows without a match are added by an anti join
    against the distinct left keys.
    """
    kept = {"right": "inner", "full": "left"}[how]
    matched = salted_join(left, right, on, salt_by, kept, salts, share)
    unmatched = right.join(left.select(*on).distinct(), on, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)
