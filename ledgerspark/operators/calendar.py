"""Calendar operators over keyed, dated rows.

Unless said otherwise they expect one row per key and date, as ``ledger_sum`` leaves them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .balance import ledger_sum


def last_date(df: DataFrame, keys: Sequence[str], date: str = "date", name: str = "last_date") -> DataFrame:
    """Latest date per key (any number of rows per key)."""
    return df.groupBy(*keys).agg(F.max(date).alias(name))


def date_gap(df: DataFrame, keys: Sequence[str], date: str = "date") -> DataFrame:
    """Days since the previous row of the key; null on the first."""
    previous = F.lag(date).over(Window.partitionBy(*keys).orderBy(date))
    return df.withColumn("gap_days", F.date_diff(F.col(date), previous))


def densify_calendar(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str], date: str = "date"
) -> DataFrame:
    """Insert the missing days between two rows of a key, with ``measures`` at 0."""
    previous = F.lag(date).over(Window.partitionBy(*keys).orderBy(date))
    start = F.coalesce(F.date_add(previous, 1), F.col(date))
    days = df.withColumn("_start", start).withColumn("_day", F.explode(F.sequence("_start", date)))
    quiet = {m: F.when(F.col("_day") == F.col(date), F.col(m)).otherwise(F.lit(0)) for m in measures}
    return days.withColumns({**quiet, date: F.col("_day")}).select(*df.columns)


def extend_to_group_end(
    df: DataFrame,
    group: Sequence[str],
    unit: Sequence[str],
    measures: Sequence[str],
    date: str = "date",
) -> DataFrame:
    """Repeat the last rows of units that end before their group, at the group's last date.

    ``unit`` is a source (all its rows of the last day are repeated) or a key (its last row is).
    The repeated rows carry ``measures`` at 0.
    """
    unit_keys = list(dict.fromkeys([*group, *unit]))
    ends = last_date(df, unit_keys, date, "_unit_last")
    group_ends = last_date(ends, group, "_unit_last", "_group_last")
    late = ends.join(group_ends, list(group)).where(F.col("_unit_last") < F.col("_group_last"))
    repeated = df.join(
        late.withColumnRenamed("_unit_last", date), [*unit_keys, date]
    ).withColumns({date: F.col("_group_last"), **{m: F.lit(0).cast(df.schema[m].dataType) for m in measures}})
    return df.unionByName(repeated.select(*df.columns))


def carry_forward_rows(
    df: DataFrame,
    group: Sequence[str],
    unit: Sequence[str],
    *,
    date: str = "date",
    change: str = "change",
    opening: str = "opening",
    closing: str = "closing",
) -> DataFrame:
    """Repeat all rows of a unit's last day on each later day up to the group's last date.

    Nothing moves on the added days: ``change`` is 0 and ``opening`` equals ``closing``.
    """
    unit_keys = list(dict.fromkeys([*group, *unit]))
    ends = last_date(df, unit_keys, date, "_unit_last")
    group_ends = last_date(ends, group, "_unit_last", "_group_last")
    late = ends.join(group_ends, list(group)).where(F.col("_unit_last") < F.col("_group_last"))
    repeated = (
        df.join(late.withColumnRenamed("_unit_last", date), [*unit_keys, date])
        .withColumn(date, F.explode(F.sequence(F.date_add(date, 1), F.col("_group_last"))))
        .withColumns({change: F.lit(0).cast(df.schema[change].dataType), opening: F.col(closing)})
    )
    return df.unionByName(repeated.select(*df.columns))


def distinct_items_per_day(
    df: DataFrame, scope: Sequence[str], items: Sequence[str], date: str = "date"
) -> DataFrame:
    """Which items a scope has on each day, as rows (any number of input rows per key)."""
    return df.select(*scope, date, *items).distinct()


def expand_seen_so_far(
    df: DataFrame,
    scope: Sequence[str],
    items: Sequence[str],
    measures: Sequence[str],
    date: str = "date",
) -> DataFrame:
    """Give every item, once seen, a row on each later date of its scope; missing rows hold 0.

    Dates are those present for the scope, so a gap of the whole scope stays a gap. The dates of a
    scope travel as one sorted array, never longer than the calendar; an item's first date is one of
    them, and only the part from there on is turned into rows.
    """
    first_seen = df.groupBy(*scope, *items).agg(F.min(date).alias("_first"))
    dates = (
        df.select(*scope, date)
        .distinct()
        .groupBy(*scope)
        .agg(F.sort_array(F.collect_list(date)).alias("_dates"))
    )
    later = F.slice("_dates", F.array_position("_dates", F.col("_first")), F.size("_dates"))
    zeros = (
        first_seen.join(dates, list(scope))
        .withColumn(date, F.explode(later))
        .select(*scope, *items, date, *[F.lit(0).cast(df.schema[m].dataType).alias(m) for m in measures])
    )
    rows = df.select(*scope, *items, date, *measures).unionByName(zeros)
    return ledger_sum(rows, [*scope, *items, date], measures)


def date_spans(
    df: DataFrame,
    scope: Sequence[str],
    start: str = "first_date",
    end: str = "last_date",
    name: str = "coverage",
) -> DataFrame:
    """Union of the day ranges ``start..end`` per scope, as an array of disjoint ascending spans.

    Ranges with the same start collapse before the window, so it sees at most one row per day.
    """
    ranges = df.groupBy(*scope, F.col(start).alias("s")).agg(F.max(end).alias("e"))
    by_start = Window.partitionBy(*scope).orderBy("s")
    reached = F.max("e").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reached.isNull() | (F.col("s") > F.date_add(reached, 1)), 1).otherwise(0)
    return (
        ranges.withColumn("_opens", opens)
        .withColumn("_span", F.sum("_opens").over(by_start))
        .groupBy(*scope, "_span")
        .agg(F.min("s").alias("s"), F.max("e").alias("e"))
        .groupBy(*scope)
        .agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias(name))
    )
