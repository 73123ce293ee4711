"""Profit lines of the profit-and-loss statement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import labels as L
from .balance import all_present, ledger_sum

INDICATOR_COLUMNS = {
    "revenue": L.REVENUE,
    "cost_of_sales": L.COST_OF_SALES,
    "commercial_costs": L.COMMERCIAL_COSTS,
    "administrative_costs": L.ADMINISTRATIVE_COSTS,
    "other_income": L.OTHER_INCOME,
    "other_costs": L.OTHER_COSTS,
    "income_tax": L.INCOME_TAX,
}

PROFIT_COLUMNS = {
    "gross_profit": L.GROSS_PROFIT,
    "sales_profit": L.SALES_PROFIT,
    "pre_tax_profit": L.PRE_TAX_PROFIT,
    "net_profit": L.NET_PROFIT,
}


def profit_base(df: DataFrame, group: Sequence[str] = ("grp",)) -> DataFrame:
    """Change per indicator, organisation and date."""
    return ledger_sum(df, [*group, "indicator", "org", "date"], ["change"])


def pivot_indicators(df: DataFrame, group: Sequence[str] = ("grp",)) -> DataFrame:
    """One column per indicator for each organisation and date that has rows; none counts as 0.

    The indicators are known, so this is a single map-side combined aggregation.
    """
    sums = [
        F.coalesce(F.sum(F.when(F.col("indicator") == label, F.col("change"))), F.lit(0)).alias(column)
        for column, label in INDICATOR_COLUMNS.items()
    ]
    return df.where(all_present([*group, "org", "date"])).groupBy(*group, "org", "date").agg(*sums)


def spread_to_group_dates(df: DataFrame, group: Sequence[str] = ("grp",)) -> DataFrame:
    """Give every organisation a row on every date its group has, 0 where it had none."""
    measures = [c for c in df.columns if c not in (*group, "org", "date")]
    dates = df.select(*group, "date").distinct().groupBy(*group).agg(F.collect_list("date").alias("_dates"))
    spine = (
        df.select(*group, "org")
        .distinct()
        .join(dates, list(group))
        .select(*group, "org", F.explode("_dates").alias("date"))
    )
    return spine.join(df, [*group, "org", "date"], "left").na.fill(0, subset=measures)


def profit_cascade(df: DataFrame) -> DataFrame:
    """Add the four profit lines to pivoted indicators; costs are negative already."""
    gross = F.col("revenue") + F.col("cost_of_sales")
    sales = F.col("gross_profit") + F.col("commercial_costs") + F.col("administrative_costs")
    pre_tax = F.col("sales_profit") + F.col("other_income") + F.col("other_costs")
    net = F.col("pre_tax_profit") + F.col("income_tax")
    return (
        df.withColumn("gross_profit", gross)
        .withColumn("sales_profit", sales)
        .withColumn("pre_tax_profit", pre_tax)
        .withColumn("net_profit", net)
    )


def profit_unpivot(df: DataFrame, group: Sequence[str] = ("grp",)) -> DataFrame:
    """The profit lines as rows: indicator and change."""
    lines = F.array(
        *[
            F.struct(F.lit(label).alias("indicator"), F.col(column).alias("change"))
            for column, label in PROFIT_COLUMNS.items()
        ]
    )
    return df.select(*group, "org", "date", F.inline(lines))


def profit_lines(df: DataFrame, bounds: DataFrame, group: Sequence[str] = ("grp",)) -> DataFrame:
    """The four profit lines of every organisation on every day of its group, with balances.

    ``df`` holds indicator rows on the days something moved, ``bounds`` the ``start_date`` and
    ``end_date`` per group. Sums and balances are computed on the days with movement; the quiet
    days before, between and after them come out of a generator at the end.
    """
    by_date = Window.partitionBy(*group, "org").orderBy("date")
    before = by_date.rowsBetween(Window.unboundedPreceding, -1)
    wide = profit_cascade(pivot_indicators(df, group)).select(*group, "org", "date", *PROFIT_COLUMNS)
    balances = wide.select(
        "*",
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_opening_{c}") for c in PROFIT_COLUMNS],
        F.lag("date").over(by_date).alias("_previous"),
        F.lead("date").over(by_date).alias("_next"),
    ).join(bounds, list(group))
    start = F.when(F.col("_previous").isNull(), F.col("start_date")).otherwise(F.col("date"))
    end = F.coalesce(F.date_sub("_next", 1), F.col("end_date"))
    days = balances.withColumn("_day", F.explode(F.sequence(start, end)))

    moved, earlier = F.col("_day") == F.col("date"), F.col("_day") < F.col("date")
    lines = []
    for column, label in PROFIT_COLUMNS.items():
        change, opening = F.col(column), F.col(f"_opening_{column}")
        closing = opening + change
        lines.append(
            F.struct(
                F.lit(label).alias("indicator"),
                F.when(moved, change).otherwise(F.lit(0)).alias("change"),
                F.when(moved | earlier, opening).otherwise(closing).alias("opening"),
                F.when(earlier, opening).otherwise(closing).alias("closing"),
            )
        )
    return days.select(*group, "org", F.col("_day").alias("date"), F.inline(F.array(*lines)))
