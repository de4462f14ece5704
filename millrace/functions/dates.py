"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_key(ts: Column) -> Column:
    """``yyyy-MM``: the first seven characters of an ISO text, or of a timestamp's ISO form."""
    return F.substring(ts.cast("string"), 1, 7)


def day_text(ts: Column) -> Column:
    """First ten characters of an ISO text timestamp."""
    return F.substring(ts.cast("string"), 1, 10)


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


# The date layouts accepted by parse_mixed_date, tried in this order.
MIXED_DATE_FORMATS = (
    "yyyy-MM-dd",
    "yyyy/MM/dd",
    "MM/dd/yyyy",
    "dd-MM-yyyy",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "d MMM yyyy",
    "yyyy.MM.dd",
)


def parse_mixed_date(text: Column, formats: tuple[str, ...] = MIXED_DATE_FORMATS) -> Column:
    """The date under the first matching layout, or null."""
    cleaned = F.trim(text)
    return F.coalesce(*[F.to_date(F.try_to_timestamp(cleaned, F.lit(f))) for f in formats])


def epoch_to_iso(seconds: Column) -> Column:
    """Epoch seconds as ISO text in UTC; missing or 0 gives an empty text.

    Built from a fixed start without time zone, so the session zone plays no part.
    """
    utc = F.expr("TIMESTAMP_NTZ'1970-01-01'") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return F.when(
        seconds.isNotNull() & (seconds != 0), F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss")
    ).otherwise(F.lit(""))


def truncated(unit: str, ts: Column) -> Column:
    """Start of the hour, day, week ... as a timestamp without zone."""
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def years_since(day: Column, as_of: str) -> Column:
    """Whole days since a date over 365, one decimal."""
    return F.round(F.datediff(F.lit(as_of).cast("date"), day) / F.lit(365.0), 1)
