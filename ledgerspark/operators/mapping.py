"""Dictionary lookups and netting joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def map_dictionary(
    df: DataFrame,
    dictionary: DataFrame,
    key: str,
    attributes: Sequence[str],
    *,
    scope: Sequence[str] = ("grp", "company"),
    direction: str = "flow_type",
    order: str = "row_no",
    order_as: str = "dict_row_no",
    first_only: bool = False,
) -> DataFrame:
    """Look up ``attributes`` by ``key`` among the dictionary entries of the same scope and direction.

    Both directions are mapped in one join. A null key finds null entries. Several entries for a
    key give several rows, unless ``first_only`` keeps the one that comes first in the dictionary.
    Rows without an entry stay, with nulls. ``order_as`` holds the entry's position, -1 for none.
    The join carries no hint: Spark broadcasts the dictionary if its size allows.
    """
    entry_keys = [*scope, "direction", key]
    entries = dictionary.select(*entry_keys, F.struct(order, *attributes).alias("_entry"))
    if first_only:
        entries = entries.groupBy(*entry_keys).agg(F.min("_entry").alias("_entry"))
    entries = entries.select(
        *[F.col(c).alias(f"_dict_{c}") for c in entry_keys],
        F.col(f"_entry.{order}").alias("_dict_order"),
        *[F.col(f"_entry.{a}").alias(f"_entry_{a}") for a in attributes],
    )
    matched = [F.col(c) == F.col(f"_dict_{c}") for c in scope]
    matched.append(F.col(direction) == F.col("_dict_direction"))
    matched.append(F.col(key).eqNullSafe(F.col(f"_dict_{key}")))
    return df.join(entries, matched, "left").select(
        *[c for c in df.columns if c not in attributes],
        *[F.col(f"_entry_{a}").alias(a) for a in attributes],
        F.coalesce("_dict_order", F.lit(-1)).alias(order_as),
    )


def net_of(
    df: DataFrame,
    deductions: DataFrame,
    keys: Sequence[str],
    amount: str = "change",
    deduction: str = "change",
    rows: str | None = None,
) -> DataFrame:
    """Take the deductions with the same ``keys`` off ``amount``.

    A row that meets n deductions counts n times, each time less one of them. The deductions are
    summed per key first, so those n rows arrive as one, with their total in ``amount``: sums over
    any columns of ``df`` are the same, and no pairs are formed. ``rows`` names a count column when
    a row of ``df`` itself stands for several.
    """
    totals = deductions.groupBy(*[F.col(k).alias(f"_ded_{k}") for k in keys]).agg(
        F.count(F.lit(1)).alias("_times"), F.sum(deduction).alias("_total")
    )
    matched = [F.col(k).eqNullSafe(F.col(f"_ded_{k}")) for k in keys]
    each = F.lit(1) if rows is None else F.col(rows)
    net = F.col(amount) * F.coalesce("_times", F.lit(1)) - each * F.coalesce("_total", F.lit(0))
    return df.join(totals, matched, "left").withColumn(amount, net).select(*df.columns)
