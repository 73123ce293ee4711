"""Published tables: one folder per company group, with the headers the dashboard expects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Headers of the published tables, in their order.
HEADERS = {
    "date": "Дата",
    "org": "Организация",
    "item_kind": "Вид статьи",
    "item": "Статья",
    "indicator": "Показатель",
    "purpose": "Назначение платежа",
    "counterparty": "Контрагент",
    "op_type": "Вид операции",
    "bank_account": "Банковский счет",
    "flow_type": "Тип операции",
    "cf_item": "Статья движения денежных средств",
    "movement_kind": "Вид движения",
    "item_group": "Группа статей",
    "origin": "Источник",
    "net_flow": "Денежный поток",
    "inflow": "Денежный приток",
    "outflow": "Денежный отток",
    "is_new_counterparty": "Новый контрагент",
    "creditor": "Кредитор",
    "contract": "Договор",
    "debt_type": "Тип задолженности",
    "debt_part": "Структура задолженности",
    "debt_term": "Срочность задолженности",
    "opening": "Начальный остаток",
    "receipt": "Поступление",
    "payment": "Списание",
    "closing": "Конечный остаток",
    "change": "Изменение",
}

BALANCE = ["opening", "receipt", "payment", "closing", "change"]
REPORTS = {
    "ОДДС": [
        "date", "purpose", "counterparty", "op_type", "bank_account", "org", "flow_type", "cf_item", "movement_kind",
        "item_group", "origin", "net_flow", "inflow", "outflow", "is_new_counterparty",
    ],
    "ОСВ 50": ["org", "cf_item", "date", *BALANCE],
    "ОСВ 51": ["org", "bank_account", "date", *BALANCE],
    "ОСВ 50_51": ["org", "cf_item", "date", *BALANCE, "bank_account", "origin"],
    "ОСВ 66_67": ["org", "creditor", "contract", "date", "debt_type", "debt_part", "debt_term", *BALANCE],
    "ОФР": ["org", "item_kind", "item", "date", "change", "opening", "closing", "indicator"],
}


def published(df: DataFrame, report: str) -> DataFrame:
    """The columns of a report under their published headers, and ``grp``. Money is rounded to cents here and nowhere before."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    shown = {c: F.round(c, 2) if isinstance(kinds[c], DecimalType) else F.col(c) for c in REPORTS[report]}
    return df.select("grp", *[value.alias(HEADERS[c]) for c, value in shown.items()])


def write_report(df: DataFrame, folder: str, report: str, fmt: str = "csv") -> None:
    """Write a report as ``folder/report/grp=...``, replacing the groups it contains."""
    write_published(published(df, report), f"{folder.rstrip('/')}/{report}", fmt)


def write_published(shown: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write published rows by group.

    The rows are rebalanced by group before the write: small groups come out as one file, and a
    group too large for one task is split over several.
    """
    writer = shown.hint("rebalance", "grp").write.mode("overwrite").partitionBy("grp")
    writer = writer.option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
