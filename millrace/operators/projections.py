"""Column-level rewrites: tiers, ratios, conditional updates, JSON expansion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def tier(value: Column, steps: list[tuple[float, str]], otherwise: str, closed: bool = False) -> Column:
    """Label by descending cut points: ``> cut``, or ``>= cut`` when ``closed``."""
    chain = None
    for cut, label in steps:
        test = value >= cut if closed else value > cut
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain.otherwise(otherwise)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """The ratio, or 0 where the denominator is not positive."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def expand_json(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Parse a JSON payload column and flatten it to top-level columns."""
    return df.select(F.from_json(F.col(column).cast("string"), schema).alias("d")).select("d.*")


def add_drop_rename(
    df: DataFrame,
    add: dict[str, Column] | None = None,
    drop: list[str] | None = None,
    rename: dict[str, str] | None = None,
) -> DataFrame:
    """Create columns, drop those present, rename; dropping an absent column is no error."""
    if add:
        df = df.withColumns(add)
    if drop:
        df = df.drop(*drop)
    return df.withColumnsRenamed(rename) if rename else df


def update_where(df: DataFrame, condition: Column, sets: dict[str, Column]) -> DataFrame:
    """Set columns on the rows meeting the condition; a null condition changes nothing."""
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in sets.items()})


def partial_update(
    df: DataFrame, updates: DataFrame, key: str, touched: str | None = None, now: Column | None = None
) -> DataFrame:
    """Overwrite only the supplied (non-null) fields of matching rows.

    ``updates`` holds one row per key. When ``touched`` is given it is set to
    ``now`` on the updated rows.
    """
    fields = [c for c in updates.columns if c != key]
    new = updates.select(
        F.col(key), F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in fields]
    )
    joined = df.join(new, key, "left")
    out = []
    for column in df.columns:
        if column == touched:
            out.append(F.when(F.col("_hit"), now).otherwise(F.col(column)).alias(column))
        elif column in fields:
            out.append(F.coalesce(F.col(f"_new_{column}"), F.col(column)).alias(column))
        else:
            out.append(F.col(column))
    return joined.select(*out)


def flatten_sentiment(df: DataFrame) -> DataFrame:
    """Bring nested or flat sentiment to two flat columns; null text, lists and counts get defaults."""
    columns = df.columns
    label, score = [], []
    if "sentiment" in columns:
        label.append(F.col("sentiment.label"))
        score.append(F.col("sentiment.compound"))
    if "sentiment_label" in columns:
        label.append(F.col("sentiment_label"))
    if "sentiment_score" in columns:
        score.append(F.col("sentiment_score"))
    out = df.withColumns(
        {
            "sentiment_label": F.coalesce(*label, F.lit("neutral")),
            "sentiment_score": F.coalesce(*score, F.lit(0.0)),
        }
    ).drop("sentiment")
    fills = {}
    for name, kind in out.dtypes:
        if kind == "string" and name != "sentiment_label":
            fills[name] = F.coalesce(F.col(name), F.lit(""))
        elif kind == "array<string>":
            fills[name] = F.coalesce(F.col(name), F.array().cast("array<string>"))
        elif name in ("score", "comments"):
            fills[name] = F.coalesce(F.col(name).cast("int"), F.lit(0))
    return out.withColumns(fills)
