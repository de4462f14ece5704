"""Row filters. Every predicate is a plain column expression, so it reaches the scan."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_eq(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def filter_in(df: DataFrame, **values: list) -> DataFrame:
    """Keep rows whose columns each hold one of the listed values."""
    for column, allowed in values.items():
        df = df.filter(F.col(column).isin(list(allowed)))
    return df


def filter_not_null(df: DataFrame, *columns: str) -> DataFrame:
    for column in columns:
        df = df.filter(F.col(column).isNotNull())
    return df


def filter_optional(df: DataFrame, upper: tuple[str, ...] = (), **wanted) -> DataFrame:
    """Apply each equality only when a value is given; ``upper`` columns are upper-cased first."""
    for column, value in wanted.items():
        if value is None or value == "":
            continue
        if column in upper:
            value = value.upper()
        df = df.filter(F.col(column) == F.lit(value))
    return df


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    """The row with this key, or no row."""
    return df.filter(F.col(key) == F.lit(value)).limit(1)


def scan_filter(df: DataFrame, column: str, value, limit: int | None = 10) -> DataFrame:
    """Scan by an attribute (a nested field path is fine) with an optional cap."""
    hits = df.filter(F.col(column) == F.lit(value))
    return hits if limit is None else hits.limit(limit)


def bool_mask(df: DataFrame, mask: Column | str, columns: list[str] | None = None) -> DataFrame:
    """Rows passing an ad-hoc expression, optionally with a column subset."""
    condition = F.expr(mask) if isinstance(mask, str) else mask
    hits = df.filter(condition)
    return hits.select(*columns) if columns else hits


def recent(df: DataFrame, ts: str, as_of: str, interval: str) -> DataFrame:
    """Rows not older than ``interval`` (e.g. ``30 DAYS``) before ``as_of``.

    The bound folds to a literal, so the comparison stays on the bare column
    and can be pushed down.
    """
    return df.filter(F.expr(f"{ts} >= TIMESTAMP_NTZ'{as_of}' - INTERVAL {interval}"))


def on_day(df: DataFrame, ts: str, day: str | date) -> DataFrame:
    """Rows of one calendar day as a half-open range; no cast on the column."""
    first = datetime.fromisoformat(str(day)[:10])
    after = first + timedelta(days=1)
    return df.filter(
        F.expr(f"{ts} >= TIMESTAMP_NTZ'{first}' AND {ts} < TIMESTAMP_NTZ'{after}'")
    )


def prefix_day(df: DataFrame, column: str, day: str) -> DataFrame:
    """Rows whose ISO text timestamp begins with this date."""
    return df.filter(F.col(column).startswith(day))


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def search_substring(
    df: DataFrame, text: str, columns: list[str], newest: list[Column], limit: int
) -> DataFrame:
    """Case-insensitive substring search over several columns, newest first."""
    wanted = text.lower()
    hit = _any([F.lower(F.col(c)).contains(wanted) for c in columns])
    return df.filter(hit).orderBy(*newest).limit(limit)


def words(column: str) -> Column:
    """Lower-cased words of a text column."""
    return F.split(F.lower(F.col(column)), r"[^\p{L}\p{N}]+")


def search_boosted(
    df: DataFrame,
    text: str,
    boosts: dict[str, float],
    order: list[Column],
    filters: Column | None = None,
    size: int = 10,
) -> DataFrame:
    """Word search over weighted fields.

    ``relevance`` is the best field's weight times the number of query words it
    holds; rows without a hit are dropped. ``order`` decides the ranking and may
    use ``relevance``.
    """
    hits = df if filters is None else df.filter(filters)
    query_words = sorted({w for w in text.lower().split() if w})
    scores = []
    for column, boost in boosts.items():
        found = words(column) if dict(df.dtypes)[column] == "string" else F.col(column)
        matched = sum(
            (F.array_contains(found, w).cast("int") for w in query_words), start=F.lit(0)
        )
        scores.append(F.coalesce(matched, F.lit(0)) * F.lit(float(boost)))
    relevance = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return (
        hits.withColumn("relevance", relevance)
        .filter(F.col("relevance") > 0)
        .orderBy(*order)
        .limit(size)
    )
