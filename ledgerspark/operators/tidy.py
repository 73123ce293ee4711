"""Filters, defaults, recodes, unions and profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.ledger import account_filter
from ..functions.parsing import DATE_FORMATS, DATETIME_FORMATS, parse_locale_number, parse_multi_date

ANY_DATE = (*DATE_FORMATS, *DATETIME_FORMATS)


def filter_account(
    df: DataFrame,
    *,
    prefix: str | None = None,
    equals: str | None = None,
    exclude: tuple[str, ...] = (),
    account: str = "account",
) -> DataFrame:
    return df.where(account_filter(account, prefix, equals, exclude))


def nonzero_movements(df: DataFrame, receipt: str = "receipt", payment: str = "payment") -> DataFrame:
    return df.where((F.col(receipt) != 0) | (F.col(payment) != 0))


def override_cash(
    df: DataFrame,
    cols: Sequence[str] = ("purpose", "counterparty", "op_type", "bank_account"),
    origin: str = "origin",
) -> DataFrame:
    """Cash-desk rows carry the cash label in the columns only bank rows know."""
    is_cash = F.col(origin) == L.CASH
    return df.withColumns({c: F.when(is_cash, F.lit(L.CASH)).otherwise(F.col(c)) for c in cols})


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.na.fill(dict(defaults))


def recode(df: DataFrame, col: str, mapping: Mapping[str, str]) -> DataFrame:
    """Replace listed values; others pass through."""
    return df.replace(dict(mapping), subset=[col])


def union_components(*dfs: DataFrame) -> DataFrame:
    """Union of like-shaped tables by column name."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_with_origin(parts: Mapping[str, DataFrame], origin: str = "origin") -> DataFrame:
    """Union of tables of different shape; the key of each part becomes its ``origin``."""
    labelled = [df.withColumn(origin, F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), labelled)


def rejects(*, dates: Sequence[str] = (), numbers: Sequence[str] = (), formats: Sequence[str] = ANY_DATE) -> Column:
    """The text cells of a row that are neither empty nor a date or number, as an array of ``column`` and ``text``."""
    parsed = {c: parse_multi_date(c, formats, strict=False) for c in dates}
    parsed |= {c: parse_locale_number(c, strict=False) for c in numbers}
    cells = [
        F.when(F.col(c).isNotNull() & value.isNull(), F.struct(F.lit(c).alias("column"), F.col(c).alias("text")))
        for c, value in parsed.items()
    ]
    return F.array_compact(F.array(*cells))


def rejected_cells(
    df: DataFrame, keys: Sequence[str], *, dates: Sequence[str] = (), numbers: Sequence[str] = (), formats: Sequence[str] = ANY_DATE
) -> DataFrame:
    """One row for every text cell that is neither empty nor a date or number: ``keys``, ``column`` and ``text``.

    The strict parsers fail a job on such cells; a caller that parses leniently lists here what it sets aside.
    """
    return df.select(*keys, F.inline(rejects(dates=dates, numbers=numbers, formats=formats)))


def profile_counts(df: DataFrame) -> DataFrame:
    """One row per column: its type, the row count and the non-null count, in a single pass."""
    kinds = dict(df.dtypes)
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"_n{i}") for i, c in enumerate(df.columns)],
    )
    profile = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.lit(kinds[c]).alias("dtype"),
                F.col("_rows").alias("rows"),
                F.col(f"_n{i}").alias("non_null"),
            )
            for i, c in enumerate(df.columns)
        ]
    )
    return counted.select(F.inline(profile))
