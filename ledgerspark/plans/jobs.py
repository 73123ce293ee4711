"""From landed rows to published reports."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels as L
from ..sources import workbooks as W
from ..sources.publication import Publication
from ..sources.staging import Staging
from . import reports as R

# What the published tables of unreadable cells are called, before the name of their sheets.
REJECTED = "Отклонённые ячейки"

OTHERS = [c for c in L.COMPONENTS if c != L.REVENUE]

# The workbooks each report reads.
NEEDS: dict[str, list[str]] = {
    "ОДДС": [L.BANK_STATEMENTS, L.CASH_FLOW_DICTIONARY, L.TRIAL_BALANCE],
    "ОСВ 50": [L.TRIAL_BALANCE],
    "ОСВ 51": [L.TRIAL_BALANCE],
    "ОСВ 50_51": [L.TRIAL_BALANCE],
    "ОСВ 66_67": [L.DEBT_BALANCE],
    "ОФР": [L.REVENUE, L.DEDUCTIONS, *OTHERS],
}


class Sources:
    """Landed rows and what several reports derive from them; both are written once.

    ``written`` rows are a table already and are not copied. ``rejects`` sets unreadable cells aside.
    """

    def __init__(self, landed: DataFrame, stage: R.Stage, reports: Iterable[str], written: bool = False, rejects: R.Rejects | None = None):
        kinds = sorted({k for r in reports for k in NEEDS[r]})
        rows = landed.where(F.col("kind").isin(*kinds))
        self.stage, self.rejects = stage, rejects
        self.rows = rows if written else stage(rows)

    @cached_property
    def trial_facts(self) -> DataFrame:
        """Cash desk and bank accounts out of one pass over the trial balances."""
        return self.stage(R.trial_balance_facts(W.trial_sheet(self.rows), R.BOTH, self.stage, self.rejects))


def _cash_flow(s: Sources) -> DataFrame:
    desk = s.trial_facts.where(F.col("origin") == L.CASH).drop("origin").withColumnRenamed("item", R.CASH_DESK.item)
    return R.cash_flow_from_facts(W.bank_statements(s.rows), W.dictionary(s.rows), desk, s.stage, s.rejects)


def _statement(s: Sources) -> DataFrame:
    revenue, deductions = W.outline_sheet(s.rows, L.REVENUE), W.outline_sheet(s.rows, L.DEDUCTIONS)
    return R.pnl_statement(revenue, deductions, W.outline_sheet(s.rows, *OTHERS), s.stage, s.rejects)


BUILD: dict[str, Callable[[Sources], DataFrame]] = {
    "ОДДС": _cash_flow,
    "ОСВ 50": lambda s: R.trial_report(s.trial_facts, R.CASH_DESK, L.CASH),
    "ОСВ 51": lambda s: R.trial_report(s.trial_facts, R.BANK_ACCOUNTS, L.BANK),
    "ОСВ 50_51": lambda s: R.both_reports(s.trial_facts),
    "ОСВ 66_67": lambda s: R.debt_daily(W.debt_sheet(s.rows), s.stage, s.rejects),
    "ОФР": _statement,
}


def reports_of(kinds: Iterable[str], reports: Iterable[str] | None = None) -> list[str]:
    """The reports that read a workbook of one of the kinds."""
    kinds = set(kinds)
    return [r for r in (BUILD if reports is None else reports) if kinds & set(NEEDS[r])]


Profile = list[tuple[str, str, int, int]]


def publish(
    spark: SparkSession,
    landed: DataFrame,
    out: str,
    reports: Iterable[str] | Mapping[str, Iterable[str]] | None = None,
    fmt: str = "csv",
    written: bool = False,
    build: Mapping[str, Callable[[Sources], DataFrame]] | None = None,
    set_aside: bool = False,
) -> dict[str, Profile]:
    """Build and publish the named reports, all by default; every landed workbook is read once.

    ``reports`` may name the groups that each report replaces; without, a report replaces all its groups. The reports
    become visible together, when the last one is built; a group without rows loses its folder. ``written`` says that
    ``landed`` is a written table, ``build`` has other builders of some reports. Without ``set_aside`` the job fails at a cell that
    cannot be read; with it, the cell's row is left out, and the cells are published with the reports, a table for each kind
    of sheet (REJECTED and the sheet's name). Returns the profile of every report (column, type, rows, non-null values).
    """
    build = {**BUILD, **(build or {})}
    groups: dict[str, list[str] | None]
    if isinstance(reports, Mapping):
        groups = {r: sorted(set(g)) for r, g in reports.items() if g}
    else:
        groups = dict.fromkeys(BUILD if reports is None else reports)
    if not groups:
        return {}
    with Staging(spark) as stage, Publication(spark, out, fmt) as publication:
        for names, wanted in by_groups(groups):
            own = landed if wanted is None else landed.where(F.col("grp").isin(wanted))
            rejects = R.Rejects() if set_aside else None
            sources = Sources(own, stage, names, written, rejects)
            for name in names:
                publication.write(build[name](sources), name, wanted)
            for sheet, cells in rejects.tables.items() if rejects else ():
                publication.add(cells, f"{REJECTED} {sheet}", wanted)
    return publication.profiles


def by_groups(groups: Mapping[str, list[str] | None]) -> list[tuple[list[str], list[str] | None]]:
    """Reports that replace the same groups, together: they share their sources."""
    together: dict[tuple[str, ...] | None, list[str]] = {}
    for report, wanted in groups.items():
        together.setdefault(None if wanted is None else tuple(wanted), []).append(report)
    return [(names, None if wanted is None else list(wanted)) for wanted, names in together.items()]
