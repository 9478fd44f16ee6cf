"""Ordered windows per key that do not put a hot key into one task.

``Window.partitionBy(key)`` sends all rows of a key to one task. With a handful
of categories, or one merchant that holds a third of the ledger, that task never
ends. The functions here give the same rows as the plain window:

* rows are counted by key and day, combined map-side; without a key above
  ``max_group_rows`` rows the plan is the plain window;
* else every row learns its piece. A piece is the whole key, for a key within the limit, or a
  day of a hot key, or a second of a day that is above the limit by itself. Only
  counts (or sums) of pieces travel to other pieces.

Counts are tables in the shared folder, joined null-safely; no list of keys is collected.
Rows are ordered by a timestamp and then by a unique hex id. NULL is a key like
any other; NULL timestamps and ids come first, where the plain window puts them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ledgermill.session import settle

MAX_GROUP_ROWS = 5_000_000
BLOCK_ROWS = 500_000
LAST_TAG = "\U0010ffff"
BEFORE = (Window.unboundedPreceding, -1)
PIECE = ["_day", "_sec", "_tag"]


@dataclass(frozen=True)
class Skew:
    """Days of hot keys (``_key, _day, _rows, _sum`` and what lies before), and whether one is too large itself."""

    days: DataFrame | None = None
    dense: bool = False
    limit: int = MAX_GROUP_ROWS


def find_skew(
    df: DataFrame,
    columns: Sequence[str],
    ts: str,
    max_group_rows: int = MAX_GROUP_ROWS,
    value: str | None = None,
) -> dict[str, Skew]:
    """The skew of each text column, from one pass over ``df``; sums are of ``value``."""
    entries = F.array(*[F.struct(F.lit(c).alias("_name"), F.col(c).alias("_key")) for c in columns])
    summed = F.col(value) if value else F.lit(None).cast("long")
    rows = df.select(F.to_date(F.col(ts)).alias("_day"), summed.alias("_value"), F.inline(entries))
    days = rows.groupBy("_name", "_key", "_day").agg(F.count("*").alias("_rows"), F.sum("_value").alias("_sum"))
    key = Window.partitionBy("_name", "_key")
    before = key.orderBy("_day").rowsBetween(*BEFORE)
    days = days.withColumns(
        {
            "_total": F.sum("_rows").over(key),
            "_rows_before": F.coalesce(F.sum("_rows").over(before), F.lit(0)),
            "_sum_before": F.sum("_sum").over(before),
        }
    )
    hot = settle(days.filter(F.col("_total") > max_group_rows), "hot-days")
    most = {r["_name"]: r["most"] for r in hot.groupBy("_name").agg(F.max("_rows").alias("most")).collect()}
    return {
        c: Skew(hot.filter(F.col("_name") == c).drop("_name", "_total"), most[c] > max_group_rows, max_group_rows)
        if c in most
        else Skew()
        for c in columns
    }


def _pieces(df: DataFrame, key: str, ts: str, row_id: str, skew: Skew) -> DataFrame:
    """Add ``_hot`` and the piece of each row; pieces keep the order (ts, row_id).

    Rows exactly on the second come before the rest of that second and
    are ordered by id alone, so a dense day cuts them by the first two digits of the id as
    well: date-only exports put a whole day on one timestamp.
    """
    days = skew.days.select("_key", "_day", (F.col("_rows") > skew.limit).alias("_dense"), "_rows_before", "_sum_before")
    same = F.col(key).eqNullSafe(F.col("_key")) & F.to_date(F.col(ts)).eqNullSafe(F.col("_day"))
    found = df.join(days, same, "left").drop("_key").withColumn("_hot", F.col("_dense").isNotNull())
    second = F.date_trunc("second", F.col(ts)).cast("timestamp_ntz")
    digits = F.coalesce(F.substring(F.col(row_id), 1, 2), F.lit(""))
    tag = F.when(F.col(ts).isNull() | (F.col(ts) == second), digits).otherwise(F.lit(LAST_TAG))
    return found.withColumns({"_sec": F.when(F.col("_dense"), second), "_tag": F.when(F.col("_dense"), tag)})


def _placed(df: DataFrame, key: str, ts: str, row_id: str, skew: Skew, value: str | None = None) -> DataFrame:
    """Rows with their pieces, and the rows and sums of all earlier pieces of the key."""
    cut = _pieces(df, key, ts, row_id, skew)
    if not skew.dense:
        return cut
    summed = F.col(value) if value else F.lit(None).cast("long")
    inner = cut.filter(F.col("_dense")).groupBy(F.col(key).alias("_key"), *PIECE).agg(F.count("*").alias("_n"), F.sum(summed).alias("_s"))
    before = Window.partitionBy("_key", "_day").orderBy("_sec", "_tag").rowsBetween(*BEFORE)
    inner = inner.select(
        "_key",
        *[F.col(c).alias(f"_in{c}") for c in PIECE],
        F.sum("_n").over(before).alias("_n"),
        F.sum("_s").over(before).alias("_s"),
    )
    inner = settle(inner, "pieces")
    same = F.col("_dense") & F.col(key).eqNullSafe(F.col("_key"))
    for c in PIECE:
        same = same & F.col(c).eqNullSafe(F.col(f"_in{c}"))
    joined = cut.join(inner, same, "left").drop("_key", *[f"_in{c}" for c in PIECE])
    both = F.col("_sum_before").isNotNull() | F.col("_s").isNotNull()
    whole_sum = F.when(both, F.coalesce("_sum_before", F.lit(0)) + F.coalesce("_s", F.lit(0)))
    return joined.withColumns(
        {"_rows_before": F.col("_rows_before") + F.coalesce("_n", F.lit(0)), "_sum_before": whole_sum}
    ).drop("_n", "_s")


def rolling_rows(
    df: DataFrame,
    key: str,
    ts: str,
    row_id: str,
    preceding: int,
    outputs: Mapping[str, Callable[[WindowSpec], Column]],
    skew: Skew | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Aggregates over ``ROWS BETWEEN preceding PRECEDING AND CURRENT ROW`` per key.

    ``outputs`` maps a column name to a function from the window to a Column.
    ``skew`` gives the result of ``find_skew`` if it is known already.

    With a hot key, rows get their position, positions of hot keys are cut into blocks of
    ``block_rows`` (another key is one block), and the last ``preceding`` rows of a block are copied into
    the next one, so that each window is complete inside its block. Placed rows are written to the
    shared folder, so what follows reads them once.
    """
    if block_rows < preceding:
        raise ValueError("block_rows must be at least preceding")
    skew = find_skew(df, [key], ts, max_group_rows)[key] if skew is None else skew
    if skew.days is None:
        plain = Window.partitionBy(key).orderBy(ts, row_id).rowsBetween(-preceding, 0)
        return df.withColumns({name: make(plain) for name, make in outputs.items()})

    in_piece = Window.partitionBy(key, "_hot", *PIECE).orderBy(ts, row_id)
    placed = _placed(df, key, ts, row_id, skew).withColumn("_rn", F.row_number().over(in_piece))
    position = F.coalesce("_rows_before", F.lit(0)) + F.col("_rn") - 1
    placed = settle(placed.withColumn("_pos", position).select(*df.columns, "_hot", "_pos"), "placed")
    block = F.when(F.col("_hot"), F.floor(F.col("_pos") / block_rows)).otherwise(F.lit(0)).cast("long")
    is_tail = F.col("_hot") & (F.col("_pos") % block_rows >= block_rows - preceding)
    placed = placed.withColumn("_home", block).withColumn(
        "_block",
        F.explode(F.when(is_tail, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))),
    )
    in_block = Window.partitionBy(key, "_block").orderBy("_pos").rowsBetween(-preceding, 0)
    placed = placed.withColumns({name: make(in_block) for name, make in outputs.items()})
    return placed.filter(F.col("_home") == F.col("_block")).select(*df.columns, *outputs)


def running_total(
    df: DataFrame,
    key: str,
    ts: str,
    row_id: str,
    value: str,
    name: str,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Cumulative sum of ``value`` per key; NULL until the key's first value."""
    skew = find_skew(df, [key], ts, max_group_rows, value)[key]
    to_here = Window.unboundedPreceding, 0
    plain = F.sum(value).over(Window.partitionBy(key).orderBy(ts, row_id).rowsBetween(*to_here))
    if skew.days is None:
        return df.withColumn(name, plain)

    wanted = df.withColumn(name, plain)
    in_piece = Window.partitionBy(key, "_hot", *PIECE).orderBy(ts, row_id).rowsBetween(*to_here)
    placed = _placed(df, key, ts, row_id, skew, value).withColumn("_in_piece", F.sum(value).over(in_piece))
    some = F.col("_in_piece").isNotNull() | F.col("_sum_before").isNotNull()
    whole = F.when(some, F.coalesce("_in_piece", F.lit(0)) + F.coalesce("_sum_before", F.lit(0))).cast(wanted.schema[name].dataType)
    return placed.withColumn(name, whole).select(*wanted.columns)
