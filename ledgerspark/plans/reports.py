"""The published reports, as configurations of the operators.

Every report is one lazy DataFrame. Those that read their facts more than once take a ``stage``: a
function that materialises the compact facts between the steps (see ``sources.staging``). Without
one, Spark derives the facts again for each use.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as X
from .. import operators as O
from ..functions import labels as L

Stage = Callable[[DataFrame], DataFrame]

FILE = ["grp", "company", "source_file"]
# Text dates, and dates that were date cells in the workbook.
ANY_DATE = (*X.DATE_FORMATS, *X.DATETIME_FORMATS)

DEBT_ITEM = ["creditor", "contract", "debt_type", "debt_part", "debt_term"]


def as_is(df: DataFrame) -> DataFrame:
    return df


MOVEMENTS = ["receipt", "payment"]


class Rejects:
    """Cells that cannot be read, set aside by the pass that reads the sheets.

    A report that is given one doesn't fail at such a cell: the cell's row takes no part in it, and is found in ``cells``
    (grp, company, source_file, row_no, column, text) under the name of its sheets. Sheets are staged with what was
    rejected in them, so the cells cost no scan of their own.
    """

    def __init__(self) -> None:
        self.tables: dict[str, DataFrame] = {}

    def __call__(
        self, name: str, rows: DataFrame, stage: Stage, *,
        dates: Sequence[str] = (), numbers: Sequence[str] = (), where: Column | None = None, keep: str | None = None,
    ) -> DataFrame:
        """The staged rows without those that have a rejected cell.

        Only rows for which ``where`` holds are looked at. Rows whose only rejected cells are of the column ``keep`` stay.
        """
        cells = O.rejects(dates=dates, numbers=numbers, formats=ANY_DATE)
        staged = stage(rows.withColumn("_rejected", cells if where is None else F.when(where, cells)))
        self.tables[name] = staged.where(F.size("_rejected") > 0).select(*FILE, "row_no", F.inline("_rejected"))
        bad = F.exists("_rejected", lambda cell: F.lit(True) if keep is None else cell["column"] != keep)
        return staged.where(~F.coalesce(bad, F.lit(False))).drop("_rejected")

    def cells(self) -> DataFrame | None:
        tables = [table.withColumn("sheet", F.lit(name)) for name, table in self.tables.items()]
        return O.union_components(*tables) if tables else None


def _with_movements(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: X.parse_locale_number(c) for c in MOVEMENTS})


def _read(rows: DataFrame, stage: Stage, rejects: Rejects | None, name: str) -> DataFrame:
    """Staged rows of a stacked sheet, whose dated rows have movements."""
    if rejects is None:
        return stage(rows)
    return rejects(name, rows, stage, numbers=MOVEMENTS, where=F.col("date").isNotNull())


# --- trial balances -------------------------------------------------------------------------


@dataclass(frozen=True)
class TrialBalance:
    """Which accounts of the shared trial balance a report shows, and what its items are called."""

    item: str
    account: dict


CASH_DESK = TrialBalance("cf_item", {"prefix": "50", "exclude": ("50.03", "50.23")})
BANK_ACCOUNTS = TrialBalance("bank_account", {"equals": "51"})
BOTH = {L.CASH: CASH_DESK, L.BANK: BANK_ACCOUNTS}
TRIAL_PREAMBLE = 4
DEBT_PREAMBLE = 6


def trial_balance_facts(
    sheet: DataFrame, reports: dict[str, TrialBalance], stage: Stage = as_is, rejects: Rejects | None = None
) -> DataFrame:
    """Receipts and payments per report (its label is ``origin``), organisation, item and date.

    ``sheet``: grp, company, source_file, row_no, stacked, dim, receipt, payment (text cells). All
    reports come out of one pass over it.
    """
    rows = O.classify_stacked(O.skip_preamble(sheet, TRIAL_PREAMBLE), X.cash_bank_rules)
    rows = rows.select(*FILE, "row_no", "account", "org", "date", F.col("dim").alias("item"), "receipt", "payment")
    rows = _read(rows, stage, rejects, L.TRIAL_BALANCE)
    rows = O.forward_fill_steps(rows, [(["account"], []), (["org", "item"], ["account"])], stage=stage)
    origin = F.lit(None).cast("string")
    for label, report in reports.items():
        origin = F.when(X.account_filter("account", **report.account), F.lit(label)).otherwise(origin)
    rows = rows.where(F.col("date").isNotNull()).withColumn("origin", origin)
    rows = O.fill_defaults(_with_movements(rows), {"item": L.MISSING_TEXT})
    return O.ledger_sum(rows, [*FILE, "origin", "org", "item", "date"], ["receipt", "payment"])


def debt_facts(sheet: DataFrame, stage: Stage = as_is, rejects: Rejects | None = None) -> DataFrame:
    """Receipts and payments per organisation, creditor, contract, debt class and date.

    ``sheet``: grp, company, source_file, row_no, stacked, creditor, receipt, payment (text cells).
    """
    rows = O.classify_stacked(O.skip_preamble(sheet, DEBT_PREAMBLE), X.debt_rules, "creditor")
    rows = rows.select(*FILE, "row_no", "account", "org", "creditor", "contract", "date", "receipt", "payment")
    rows = O.fill_from_headers(
        _read(rows, stage, rejects, L.DEBT_BALANCE),
        [(["account"], []), (["org", "creditor"], ["account"]), (["contract"], ["account", "creditor"])],
        stage=stage,
    )
    rows = _with_movements(rows.where(F.col("date").isNotNull()))
    rows = O.fill_defaults(rows, {"creditor": L.MISSING_TEXT}).withColumns(X.classify_debt("account"))
    return O.ledger_sum(rows, [*FILE, "org", *DEBT_ITEM, "date"], ["receipt", "payment"])


def balances_by_day(facts: DataFrame, items: Sequence[str], report: Sequence[str] = ()) -> DataFrame:
    """Daily balances of trial-balance facts; ``report`` tells several reports in ``facts`` apart.

    A source that ends before its group is extended to the group's last date, by the items of its
    own last day. Every item, once seen, has a row on each later date its organisation has.
    """
    keys = [*FILE, *report, "org", *items]
    changes = facts.withColumn("change", F.col("receipt") - F.col("payment"))
    totals = O.key_totals(changes, keys)
    tails = coverage_tails(totals, coverage_of(totals, report), keys, report)
    return O.daily_balances(changes, keys, tails, measures=["receipt", "payment"])


def coverage_of(totals: DataFrame, report: Sequence[str] = ()) -> DataFrame:
    """The days on which an organisation of a source has rows, as spans: those its items live, extended to the group's end."""
    source, group = [*FILE, *report], ["grp", *report]
    lives = totals.groupBy(*source, "org", "first_date").agg(F.max("last_date").alias("last_date"))
    source_ends = O.last_date(totals, source, "last_date", "source_last")
    group_ends = O.last_date(totals, group, "last_date", "group_last")
    at_source_end = F.col("last_date") == F.col("source_last")
    extended = (
        lives.join(source_ends, source)
        .join(group_ends, group)
        .withColumn("last_date", F.when(at_source_end, F.col("group_last")).otherwise(F.col("last_date")))
    )
    return O.date_spans(extended, [*source, "org"])


def coverage_tails(totals: DataFrame, coverage: DataFrame, keys: Sequence[str], report: Sequence[str] = ()) -> DataFrame:
    """The spans of days after an item's last movement on which its organisation has rows."""
    return (
        totals.join(coverage, [*FILE, *report, "org"])
        .select(*keys, "total", "last_date", F.inline("coverage"))
        .where(F.col("e") > F.col("last_date"))
        .withColumn("s", F.greatest("s", F.date_add("last_date", 1)))
    )


def trial_balance_daily(sheet: DataFrame, report: TrialBalance, stage: Stage = as_is, rejects: Rejects | None = None) -> DataFrame:
    return trial_report(stage(trial_balance_facts(sheet, {"": report}, stage, rejects)), report, "")


def trial_report(facts: DataFrame, report: TrialBalance, label: str) -> DataFrame:
    """Daily balances of the report whose facts carry the label as ``origin``."""
    own = facts.where(F.col("origin") == label).drop("origin")
    return balances_by_day(own, ["item"]).withColumnRenamed("item", report.item)


def debt_daily(sheet: DataFrame, stage: Stage = as_is, rejects: Rejects | None = None) -> DataFrame:
    return balances_by_day(stage(debt_facts(sheet, stage, rejects)), DEBT_ITEM)


def cash_and_bank_daily(sheet: DataFrame, stage: Stage = as_is) -> DataFrame:
    """Both trial-balance reports in one table, told apart by ``origin``."""
    return both_reports(stage(trial_balance_facts(sheet, BOTH, stage)))


def both_reports(facts: DataFrame) -> DataFrame:
    return named_items(balances_by_day(facts, ["item"], ["origin"]))


def named_items(daily: DataFrame) -> DataFrame:
    """The items of both reports in a column for each."""
    is_cash = F.col("origin") == L.CASH
    return daily.withColumns(
        {CASH_DESK.item: F.when(is_cash, F.col("item")), BANK_ACCOUNTS.item: F.when(~is_cash, F.col("item"))}
    ).drop("item")


# --- profit and loss ------------------------------------------------------------------------


@dataclass(frozen=True)
class Outline:
    """Shape of an outline report: title rows, the levels to keep and the leaf level."""

    preamble: int
    levels: dict
    leaf: str


COST_OUTLINE = Outline(6, {0: "org", 3: "item_kind", 4: "item", 5: "date"}, "date")
REVENUE_OUTLINE = Outline(8, {0: "org", 3: "item_kind", 4: "item", 5: "date", 7: "operation"}, "operation")
DEDUCTION_OUTLINE = Outline(6, {0: "org", 3: "date", 5: "operation"}, "operation")

# Indicators that count against profit, and those whose items read "name,tax id".
NEGATED = [L.COST_OF_SALES, L.COMMERCIAL_COSTS, L.ADMINISTRATIVE_COSTS, L.OTHER_COSTS, L.INCOME_TAX]
WITH_TAX_ID = [L.REVENUE, L.COST_OF_SALES]

# The sheets of the indicators that share the cost outline, in the table of rejected cells.
COSTS = "ОФР"

COMPONENT_KEYS = [*FILE, "indicator", "org", "item_kind", "item"]


def outline_rows(
    sheet: DataFrame, outline: Outline, stage: Stage = as_is, rejects: Rejects | None = None, name: str = ""
) -> DataFrame:
    """Leaf rows of outline reports with parsed date and amount.

    ``sheet``: grp, company, source_file, indicator, row_no, level, c0, c1. With ``rejects``, a leaf below a date that
    cannot be read has a null date.
    """
    body = O.skip_preamble(sheet, outline.preamble).select(*FILE, "indicator", "row_no", "level", "c0", "c1")
    if rejects is not None:
        level = {label: depth for depth, label in outline.levels.items()}
        cells = {"date": ("c0", level["date"]), "change": ("c1", level[outline.leaf])}
        body = body.withColumns({c: F.when(F.col("level") == depth, F.col(cell)) for c, (cell, depth) in cells.items()})
        # the row of a bad date stays: what lies below it must not go to the date above
        kept = rejects(name, body, stage, dates=["date"], numbers=["change"], keep="date")
        body = kept.drop("date", "change")
    rows = O.outline_flatten(body, outline.levels, outline.leaf)
    strict = rejects is None
    return rows.withColumns({"date": X.parse_multi_date("date", ANY_DATE, strict), "change": X.parse_locale_number("change", strict)})


def component_facts(
    sheet: DataFrame,
    outline: Outline = COST_OUTLINE,
    deductions: DataFrame | None = None,
    stage: Stage = as_is,
    rejects: Rejects | None = None,
) -> DataFrame:
    """Change per indicator, organisation, kind, item and date, signed as in the statement.

    All sheets of one outline go through together. ``deductions`` is the sheet whose operations
    are taken off the rows of the same company, organisation, date and operation.
    """
    name = L.REVENUE if deductions is not None else COSTS
    rows = O.fill_defaults(outline_rows(sheet, outline, stage, rejects, name), {"item": L.MISSING_TEXT})
    keys = [*COMPONENT_KEYS, "date"]
    if deductions is not None:
        rows = (
            rows.where(O.all_present(["org", "item_kind", "date"]))
            .groupBy(*keys, "operation")
            .agg(F.coalesce(F.sum("change"), F.lit(0)).alias("change"), F.count("change").alias("rows"))
        )
        operation = ["grp", "company", "org", "date", "operation"]
        rows = O.net_of(rows, outline_rows(deductions, DEDUCTION_OUTLINE, stage, rejects, L.DEDUCTIONS), operation, rows="rows")
    indicator = F.col("indicator")
    label = F.when(indicator.isin(WITH_TAX_ID), X.split_last_comma("item")).otherwise(F.col("item"))
    signed = F.when(indicator.isin(NEGATED), -F.col("change")).otherwise(F.col("change"))
    return O.ledger_sum(rows.withColumn("item", label), keys, ["change"]).withColumn("change", signed)


def component_balances(facts: DataFrame, totals: DataFrame, ends: DataFrame, on: Sequence[str]) -> DataFrame:
    """Daily balances of indicator facts; each key runs to the ``end_date`` of its ``on``."""
    tails = (
        totals.join(ends, list(on))
        .where(F.col("last_date") < F.col("end_date"))
        .select(*COMPONENT_KEYS, "total", F.date_add("last_date", 1).alias("s"), F.col("end_date").alias("e"))
    )
    return O.daily_balances(facts, COMPONENT_KEYS, tails)


def components_by_day(facts: DataFrame) -> DataFrame:
    """Daily balances; items run to the last date their indicator has in the group."""
    totals = O.key_totals(facts, COMPONENT_KEYS)
    ends = O.last_date(totals, ["grp", "indicator"], "last_date", "end_date")
    return component_balances(facts, totals, ends, ["grp", "indicator"])


def pnl_component(
    sheet: DataFrame,
    outline: Outline = COST_OUTLINE,
    deductions: DataFrame | None = None,
    stage: Stage = as_is,
) -> DataFrame:
    return components_by_day(stage(component_facts(sheet, outline, deductions)))


def statement_from_facts(facts: DataFrame) -> DataFrame:
    """The statement from the facts of all components.

    Every indicator runs to the last date of the whole group, whatever its own last date, and the
    profit lines cover each organisation on each day of the group.
    """
    totals = O.key_totals(facts, COMPONENT_KEYS)
    bounds = totals.groupBy("grp").agg(F.min("first_date").alias("start_date"), F.max("last_date").alias("end_date"))
    lines = O.profit_lines(facts, bounds)
    balances = component_balances(facts, totals, bounds, ["grp"])
    statement = balances.unionByName(lines, allowMissingColumns=True)
    return O.fill_defaults(statement, {"item_kind": L.MISSING_TEXT, "item": L.MISSING_TEXT})


def pnl_statement(
    revenue: DataFrame, deductions: DataFrame, others: DataFrame, stage: Stage = as_is, rejects: Rejects | None = None
) -> DataFrame:
    """The statement from its sheets; an indicator without a sheet counts as zeros.

    ``others`` holds the sheets of the six indicators that share the cost outline.
    """
    facts = O.union_components(
        component_facts(revenue, REVENUE_OUTLINE, deductions, stage, rejects), component_facts(others, COST_OUTLINE, None, stage, rejects)
    )
    return statement_from_facts(stage(facts))


# --- cash flow ------------------------------------------------------------------------------


def bank_rows(statements: DataFrame, stage: Stage = as_is, rejects: Rejects | None = None) -> DataFrame:
    """Parsed bank statement lines.

    ``statements``: grp, company, source_file, row_no, date, receipt, payment, purpose,
    counterparty, inn, op_type, org, bank_account (text cells).
    """
    if rejects is not None:
        statements = rejects(L.BANK_STATEMENTS, statements, stage, dates=["date"], numbers=MOVEMENTS)
    return statements.select(
        *FILE,
        "row_no",
        X.parse_multi_date("date", ANY_DATE).alias("date"),
        X.parse_locale_number("receipt").alias("receipt"),
        X.parse_locale_number("payment").alias("payment"),
        "purpose",
        X.label_with_id("counterparty", X.clean_tax_id("inn")).alias("counterparty"),
        "op_type",
        "bank_account",
        "org",
        X.flow_type("receipt").alias("flow_type"),
    )


def cash_desk_facts(sheet: DataFrame, stage: Stage = as_is) -> DataFrame:
    """Receipts and payments of the cash desk by cash-flow item."""
    facts = trial_balance_facts(sheet, {L.CASH: CASH_DESK}, stage)
    return facts.drop("origin").withColumnRenamed("item", CASH_DESK.item)


def cash_flow(
    statements: DataFrame, dictionary: DataFrame, sheet: DataFrame, stage: Stage = as_is
) -> DataFrame:
    return cash_flow_from_facts(statements, dictionary, stage(cash_desk_facts(sheet, stage)), stage)


def cash_flow_from_facts(
    statements: DataFrame, dictionary: DataFrame, cash_desk: DataFrame, stage: Stage = as_is, rejects: Rejects | None = None
) -> DataFrame:
    """Signed cash flow of bank accounts and cash desk, with first-seen counterparties flagged.

    ``dictionary``: grp, company, row_no, op_type, cf_item, movement_kind, item_group, direction.
    ``cash_desk`` are its facts from the trial balance. Its daily balances are not needed: they add
    rows without movement only, which do not count here.
    """
    entry = ["movement_kind", "item_group"]
    bank = O.map_dictionary(bank_rows(statements, stage, rejects), dictionary, "op_type", ["cf_item", *entry])
    desk = O.split_two_way(O.nonzero_movements(cash_desk))
    desk = O.map_dictionary(desk, dictionary, "cf_item", entry, first_only=True)

    flows = O.union_with_origin({L.BANK: bank, L.CASH: desk.drop("source_file")})
    flows = O.fill_defaults(
        O.override_cash(O.signed_flows(flows)),
        {
            **dict.fromkeys(
                ["purpose", "counterparty", "op_type", "bank_account", "cf_item", "movement_kind"], L.MISSING_TEXT
            ),
            "item_group": L.UNMAPPED_GROUP,
            "source_file": "",
            "row_no": -1,
        },
    )
    # Position of a row in the company's table: bank before cash desk, receipts before payments.
    flows = flows.withColumns(
        {
            "_from_cash": (F.col("origin") == L.CASH).cast("int"),
            "_is_payment": (F.col("flow_type") == L.PAYMENT).cast("int"),
        }
    )
    # Row numbers are a workbook's own, so the workbook is part of the position.
    order = ["date", "_from_cash", "_is_payment", "source_file", "row_no", "dict_row_no", "cf_item"]
    flows = O.flag_first_seen(stage(flows), ["grp", "company", "org", "counterparty"], order)
    return O.recode(flows, "item_group", L.ITEM_GROUPS).select(
        "grp",
        "company",
        "date",
        "purpose",
        "counterparty",
        "op_type",
        "bank_account",
        "org",
        "flow_type",
        "cf_item",
        "movement_kind",
        "item_group",
        "origin",
        "net_flow",
        "inflow",
        "outflow",
        "is_new_counterparty",
    )
