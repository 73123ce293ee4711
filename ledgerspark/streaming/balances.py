"""Balances kept up to date with the landed workbooks, for the reports that show them."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels as L
from ..plans import jobs
from ..plans import reports as R
from ..plans.incremental import BalanceStore, Updated
from ..sources import workbooks as W
from ..sources.files import Files, partition_value
from ..sources.staging import Staging
from .landing import files, landed_rows

KNOWN = "known"
KNOWN_SCHEMA = "path string, source_file string, grp string"


class KeptBalances:
    """The balances of the trial balances and of the debt reports, each in a store below a folder.

    In a store a workbook goes by its path, which all its versions share; where several paths have one content, by the
    smallest of them.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _store(self, name: str, facts: DataFrame, items: list[str], report: list[str]) -> BalanceStore:
        return BalanceStore(self.spark, f"{self.folder}/{name}", facts.schema, items, report)

    @cached_property
    def trial(self) -> BalanceStore:
        nothing = W.trial_sheet(self.spark.createDataFrame([], W.LANDED))
        return self._store("trial", R.trial_balance_facts(nothing, R.BOTH), ["item"], ["origin"])

    @cached_property
    def debt(self) -> BalanceStore:
        nothing = W.debt_sheet(self.spark.createDataFrame([], W.LANDED))
        return self._store("debt", R.debt_facts(nothing), R.DEBT_ITEM, [])

    def sync(self, landed: str) -> dict[str, Updated]:
        """Take over what has changed among the landed workbooks; only the changed ones are read."""
        return {
            "trial": self._sync(landed, self.trial, L.TRIAL_BALANCE, lambda rows, stage: R.trial_balance_facts(W.trial_sheet(rows), R.BOTH, stage)),
            "debt": self._sync(landed, self.debt, L.DEBT_BALANCE, lambda rows, stage: R.debt_facts(W.debt_sheet(rows), stage)),
        }

    def _sync(self, landed: str, store: BalanceStore, kind: str, facts_of: Callable[[DataFrame, R.Stage], DataFrame]) -> Updated:
        spark, folder = self.spark, store.files
        with Staging(spark) as stage:
            now = files(spark, landed).where(F.col("kind") == kind).groupBy("grp", "source_file").agg(F.min("path").alias("path"))
            known = spark.read.schema(KNOWN_SCHEMA).parquet(f"{folder.root}/{KNOWN}") if folder.exists(KNOWN) else spark.createDataFrame([], KNOWN_SCHEMA)
            changed = stage(now.join(known, ["grp", "path", "source_file"], "left_anti").select("grp", "source_file", "path"))
            gone = stage(known.join(now, ["grp", "path"], "left_anti").select("grp", "path"))
            if changed.isEmpty() and gone.isEmpty():
                return Updated({}, 0)
            rows = landed_rows(spark, landed).where(F.col("kind") == kind).join(changed.drop("path"), ["grp", "source_file"], "left_semi").select(*W.LANDED_COLUMNS)
            facts = facts_of(rows, stage).join(changed, ["grp", "source_file"]).withColumn("source_file", F.col("path"))
            dropped = changed.select("grp", "path").unionByName(gone).withColumnRenamed("path", "source_file")
            done = store.update(facts, dropped)
            # written last: an interrupted run finds the same changes again
            _replace_known(folder, stage(now.select("path", "source_file", "grp")), stage(dropped.select("grp").distinct()))
        return done

    def reports(self) -> dict[str, Callable[[jobs.Sources], DataFrame]]:
        """Builders of the reports that are read off the stores."""
        trial = lambda report, label: self._named(self.trial.daily().where(F.col("origin") == label).drop("origin"), report)
        return {
            "ОСВ 50": lambda _: trial(R.CASH_DESK, L.CASH),
            "ОСВ 51": lambda _: trial(R.BANK_ACCOUNTS, L.BANK),
            "ОСВ 50_51": lambda _: R.named_items(self.trial.daily()),
            "ОСВ 66_67": lambda _: self.debt.daily(),
        }

    @staticmethod
    def _named(daily: DataFrame, report: R.TrialBalance) -> DataFrame:
        return daily.withColumnRenamed("item", report.item)


def _replace_known(folder: Files, now: DataFrame, groups: DataFrame) -> None:
    own = now.join(groups, "grp", "left_semi").select("path", "source_file", "grp")
    own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("grp").parquet(f"{folder.root}/{KNOWN}")
    left = {r["grp"] for r in own.select("grp").distinct().collect()}
    touched = {r["grp"] for r in groups.collect()}
    for name in folder.names(KNOWN):
        if name.startswith("grp=") and partition_value(name) in touched - left:
            folder.delete(f"{KNOWN}/{name}")
