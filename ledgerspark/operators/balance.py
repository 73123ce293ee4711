"""Group sums, running balances and the daily expansion of a ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ledger_sum(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sum ``measures`` per key. Rows with a null key vanish; a sum over nulls only is 0."""
    return (
        df.where(all_present(keys))
        .groupBy(*keys)
        .agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures])
    )


def all_present(cols: Sequence[str]) -> Column:
    """True where none of ``cols`` is null.

    Written as single null checks, which the optimizer knows when it plans joins on these columns:
    it then adds none of its own, and equal inputs keep equal plans.
    """
    present = F.col(cols[0]).isNotNull()
    for c in cols[1:]:
        present = present & F.col(c).isNotNull()
    return present


def running_balance(
    df: DataFrame,
    keys: Sequence[str],
    date: str = "date",
    change: str = "change",
    opening: str = "opening",
    closing: str = "closing",
) -> DataFrame:
    """Add the balance before and after each row of a key, starting from 0.

    Needs one row per key and date (see ``ledger_sum``), so a key is never longer than the calendar.
    """
    before = Window.partitionBy(*keys).orderBy(date).rowsBetween(Window.unboundedPreceding, -1)
    with_opening = df.withColumn(opening, F.coalesce(F.sum(change).over(before), F.lit(0)))
    return with_opening.withColumn(closing, F.col(opening) + F.col(change))


def key_totals(
    facts: DataFrame, keys: Sequence[str], change: str = "change", date: str = "date"
) -> DataFrame:
    """First and last date and the total change per key; a total over nulls only is 0."""
    return facts.groupBy(*keys).agg(
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        F.coalesce(F.sum(change), F.lit(0)).alias("total"),
    )


def daily_balances(
    facts: DataFrame,
    keys: Sequence[str],
    tails: DataFrame,
    *,
    measures: Sequence[str] = (),
    change: str = "change",
    date: str = "date",
) -> DataFrame:
    """Opening and closing balance of every key on every day it covers.

    ``facts`` holds one row per key and date on which something moved. A key covers each day from
    its first to its last fact. ``tails`` adds later days: per key its ``total`` and one row for
    each span ``s..e`` of days after its last fact.

    Balances are computed on the facts alone and only then spread over the quiet days, where
    nothing moves and the balance stands still. The daily rows come out of generators and are
    never shuffled or sorted.
    """
    by_date = Window.partitionBy(*keys).orderBy(date)
    balances = running_balance(facts, keys, date, change).withColumn("_next", F.lead(date).over(by_date))
    until_next = F.coalesce(F.date_sub("_next", 1), F.col(date))
    spread = balances.withColumn("_day", F.explode(F.sequence(date, until_next)))
    moved = F.col("_day") == F.col(date)
    movements = [*measures, change]
    lived = spread.select(
        *keys,
        F.col("_day").alias(date),
        *[F.when(moved, F.col(m)).otherwise(F.lit(0)).alias(m) for m in movements],
        F.when(moved, F.col("opening")).otherwise(F.col("closing")).alias("opening"),
        "closing",
    )
    after = tails.select(
        *keys,
        F.explode(F.sequence("s", "e")).alias(date),
        *[F.lit(0).cast(facts.schema[m].dataType).alias(m) for m in movements],
        F.col("total").alias("opening"),
        F.col("total").alias("closing"),
    )
    return lived.unionByName(after)
