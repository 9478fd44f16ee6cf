"""Helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 200_000


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def num(c: Column | str) -> Column:
    return col(c).cast("double")


def sum_if(flag: Column, value: Column) -> Column:
    return F.sum(F.when(flag, value).otherwise(F.lit(0)))


def count_if(flag: Column) -> Column:
    return F.count(F.when(flag, 1))


def ratio(top: Column, bottom: Column, otherwise: Column | float | None) -> Column:
    """``top / bottom`` where ``bottom > 0``, else a fixed value."""
    other = otherwise if isinstance(otherwise, Column) else F.lit(otherwise).cast("double")
    return F.when(bottom > 0, top / bottom).otherwise(other)


def pct_change(now: Column, before: Column) -> Column:
    return F.when(before > 0, (now - before) / before * 100)


def mean_money(c: Column | str) -> Column:
    """Mean from the exact decimal sum, so it does not depend on the order of rows."""
    return F.sum(col(c)).cast("double") / F.count(col(c))


def rolling_means(
    df: DataFrame, keys: list[str], order: str, columns: Sequence[str], spans: Sequence[int], unit: str
) -> DataFrame:
    """Add ``<column>_<span><unit>_avg``: means of money over the last ``span`` rows.

    Sums are DECIMAL over a bounded frame: exact, and without an end in the number of rows before. The frames
    run over rows of days or months. The columns must not be NULL.
    """
    means = {}
    for span in spans:
        frame = last_rows(keys, [order], span - 1)
        for c in columns:
            means[f"{c}_{span}{unit}_avg"] = F.sum(c).over(frame).cast("double") / F.count(F.lit(1)).over(frame)
    return df.withColumns(means)


def last_rows(keys: list[str], order: list[str], preceding: int) -> WindowSpec:
    base = Window.partitionBy(*keys) if keys else Window.partitionBy()
    return base.orderBy(*order).rowsBetween(-preceding, 0)


def savings_rate(income: Column | str, expenses: Column | str) -> Column:
    return ratio(num(income) - num(expenses), num(income), 0.0)


def rounded_rate(top: Column, bottom: Column, places: int = 4) -> Column:
    """Decimal ``top / bottom`` rounded half away from zero; 0 unless ``bottom > 0``."""
    return F.when(bottom > 0, F.round(top / bottom, places)).otherwise(F.lit(0)).cast("decimal(18,4)")


def small_side(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast after counting the rows; a larger frame is left to a shuffled join.

    Spark's own estimate of a derived frame is far too large, so it would shuffle
    the other side for it. The count stops at ``max_rows``.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
