"""Calendar expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_key(ts: Column) -> Column:
    """Text month ``YYYY-MM``."""
    return F.date_format(ts, "yyyy-MM")


def iso_week(day: Column) -> Column:
    """Text ISO week ``YYYY-Www``."""
    year = F.extract(F.lit("YEAROFWEEK"), day)
    return F.concat(year.cast("string"), F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def month_start(month: Column) -> Column:
    """First day of a text month."""
    return F.to_date(F.concat(month, F.lit("-01")), "yyyy-MM-dd")


def day(value: date | str) -> Column:
    """A DATE literal."""
    return F.lit(str(value)).cast("date")
