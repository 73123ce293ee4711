"""Money movements: direction, sign and first appearance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from .balance import all_present


def split_two_way(
    df: DataFrame, receipt: str = "receipt", payment: str = "payment", direction: str = "flow_type"
) -> DataFrame:
    """A row with money both in and out becomes a receipt row and a payment row."""
    money = df.schema[receipt].dataType
    none = F.lit(0).cast(money)
    incoming = F.struct(F.lit(L.RECEIPT).alias(direction), F.col(receipt).alias("_r"), none.alias("_p"))
    outgoing = F.struct(F.lit(L.PAYMENT).alias(direction), none.alias("_r"), F.col(payment).alias("_p"))
    sides = (
        F.when((F.col(receipt) != 0) & (F.col(payment) != 0), F.array(incoming, outgoing))
        .when(F.col(receipt) != 0, F.array(incoming))
        .otherwise(F.array(outgoing))
    )
    others = [c for c in df.columns if c not in (receipt, payment, direction)]
    return df.select(*others, F.inline(sides)).withColumnsRenamed({"_r": receipt, "_p": payment})


def signed_flows(
    df: DataFrame, receipt: str = "receipt", payment: str = "payment", direction: str = "flow_type"
) -> DataFrame:
    """Add ``net_flow`` with its sign, and ``inflow`` or ``outflow`` on the side it belongs to."""
    amount = F.coalesce(F.col(receipt), F.lit(0)) + F.coalesce(F.col(payment), F.lit(0))
    incoming = F.col(direction) == L.RECEIPT
    return df.withColumns(
        {
            "net_flow": F.when(incoming, amount).otherwise(-amount),
            "inflow": F.when(incoming, amount),
            "outflow": F.when(F.col(direction) == L.PAYMENT, amount),
        }
    )


def flag_first_seen(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "is_new_counterparty"
) -> DataFrame:
    """Flag the first row of every key; ``order`` starts with the date and tells all rows apart.

    The first position per key is a map-side combined minimum, joined back on the whole position:
    a key that holds a large share of the rows is spread over all tasks on both sides.
    """
    position = [*keys, *order]
    firsts = (
        df.where(all_present([*keys, order[0]]))
        .groupBy(*keys)
        .agg(F.min(F.struct(*order)).alias("_first"))
        .select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(f"_first.{c}").alias(f"_k_{c}") for c in order])
    )
    matched = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in position]
    flag = F.when(F.col(f"_k_{order[0]}").isNotNull(), F.lit(L.YES)).otherwise(F.lit(L.NO))
    return df.join(firsts, matched, "left").withColumn(name, flag).select(*df.columns, name)
