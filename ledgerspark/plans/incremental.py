"""Daily balances that are kept: a changed workbook costs the days from its first change on, not the whole history.

The store holds, by group and month, the facts, the daily rows, and what every key brings into the month (the date of its
first and last fact, and its balance); by group, the totals of every key. An update replaces the facts of some sources.
The first day that it changes is the first one on which a fact differs, or on which an organisation has rows it had not,
or has not those it had. From the month of that day on, facts and what was brought into it make the daily rows anew.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import operators as O
from ..sources.files import Files, partition_value
from ..sources.staging import Staging
from . import reports as R

MOVEMENTS = ["receipt", "payment"]
FACTS, DAILY, CARRIED, TOTALS = "facts", "daily", "carried", "totals"


@dataclass(frozen=True)
class Updated:
    """The first month that was made anew for each group, and how many facts and carried balances were read for it."""

    since: dict[str, datetime.date]
    rows_read: int


def month_of(date: Column | str) -> Column:
    return F.trunc(date, "month")


class BalanceStore:
    """Balances of trial-balance facts, as ``reports.balances_by_day`` makes them, under a folder.

    ``facts`` is the schema of the facts: grp, company, source_file, the ``report`` columns, org, the ``items``, date,
    receipt and payment, one row per key and date. The name in source_file must be the same for all versions of a
    workbook. One update runs at a time. An update that is interrupted is made good by the same one again: facts and
    totals, which tell what has changed, are written last.
    """

    def __init__(self, spark: SparkSession, folder: str, facts: StructType, items: Sequence[str], report: Sequence[str] = ()):
        self.spark, self.files, self.items, self.report = spark, Files(spark, folder), list(items), list(report)
        self.source = [*R.FILE, *self.report]
        self.keys = [*self.source, "org", *self.items]
        self.columns = [*self.keys, "date", *MOVEMENTS]
        empty = spark.createDataFrame([], facts).select(*self.columns)
        changes = self._changes(empty)
        totals = O.key_totals(changes, self.keys)
        self.schemas = {
            FACTS: empty.withColumn("month", month_of("date")).schema,
            DAILY: R.balances_by_day(empty, self.items, self.report).withColumn("month", month_of("date")).schema,
            CARRIED: totals.withColumn("month", F.current_date()).schema,
            TOTALS: totals.schema,
        }

    @staticmethod
    def _changes(facts: DataFrame) -> DataFrame:
        return facts.withColumn("change", F.col("receipt") - F.col("payment"))

    def _read(self, name: str) -> DataFrame:
        schema = self.schemas[name]
        if not self.files.exists(name):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.files.root}/{name}").select(*schema.names)

    def daily(self) -> DataFrame:
        return self._read(DAILY).drop("month")

    def facts(self) -> DataFrame:
        return self._read(FACTS).drop("month")

    def update(self, facts: DataFrame, gone: DataFrame | None = None) -> Updated:
        """Replace the facts of all sources in ``facts``, and drop those in ``gone`` (grp, source_file).

        The groups of an update come to the driver, its rows don't.
        """
        with Staging(self.spark) as stage:
            new = stage(facts.select(*self.columns))
            replaced = new.select("grp", "source_file")
            if gone is not None:
                replaced = replaced.unionByName(gone.select("grp", "source_file"))
            replaced = stage(replaced.distinct())
            groups = sorted(r["grp"] for r in replaced.select("grp").distinct().collect())
            own = F.col("grp").isin(groups)
            old_totals = self._read(TOTALS).where(own)
            totals = stage(old_totals.join(replaced, ["grp", "source_file"], "left_anti").unionByName(O.key_totals(self._changes(new), self.keys)))
            coverage = stage(R.coverage_of(totals, self.report))
            cuts = self._first_changes(new, replaced, own, old_totals, coverage)
            if not cuts:
                return Updated({}, 0)
            cut = self.spark.createDataFrame(sorted(cuts.items()), "grp string, cut date")
            kept = self._read(FACTS).where(_in_months(cuts, ">=")).join(replaced, ["grp", "source_file"], "left_anti")
            late = new.join(cut, "grp").where(F.col("date") >= F.col("cut"))
            tail = stage(kept.select(*self.columns).unionByName(late.select(*self.columns)))
            before = stage(self._read(CARRIED).where(_in_months(cuts, "=")).drop("month"))
            daily = self._daily_since(tail, before, R.coverage_tails(totals, coverage, self.keys, self.report), cut)
            self._replace(DAILY, daily, cuts)
            self._replace(CARRIED, self._carried_after(tail, before, totals, cut), {g: _next_month(c) for g, c in cuts.items()})
            self._replace(FACTS, tail.withColumn("month", month_of("date")), cuts)
            self._replace(TOTALS, totals, dict.fromkeys(groups))
            return Updated(cuts, tail.count() + before.count())

    def _first_changes(self, new: DataFrame, replaced: DataFrame, own: Column, old_totals: DataFrame, coverage: DataFrame) -> dict[str, datetime.date]:
        """The month of the first changed day of each group that has one, and that the store has balances for."""
        old = self._read(FACTS).where(own).join(replaced, ["grp", "source_file"], "left_semi").select(*self.columns)
        signed = [F.sum(F.col("sign") * F.col(m)).alias(m) for m in MOVEMENTS]
        both = old.withColumn("sign", F.lit(-1)).unionByName(new.withColumn("sign", F.lit(1)))
        differs = both.groupBy(*self.keys, "date").agg(F.sum("sign").alias("n"), *signed).where((F.col("n") != 0) | (F.col(MOVEMENTS[0]) != 0) | (F.col(MOVEMENTS[1]) != 0))
        scope = [*self.source, "org"]
        spans = R.coverage_of(old_totals, self.report).withColumnRenamed("coverage", "was").join(coverage, scope, "full")
        days = differs.select("grp", "date").unionByName(spans.select("grp", _first_difference("was", "coverage").alias("date")))
        since = days.groupBy("grp").agg(F.min("date").alias("since")).where("since IS NOT NULL")
        ends = old_totals.groupBy("grp").agg(F.max("last_date").alias("end"))
        cut = F.least(month_of("since"), F.coalesce(month_of("end"), month_of("since")))
        return {r["grp"]: r["cut"] for r in since.join(ends, "grp", "left").select("grp", cut.alias("cut")).collect()}

    def _daily_since(self, tail: DataFrame, before: DataFrame, tails: DataFrame, cut: DataFrame) -> DataFrame:
        """The daily rows from the cut on: what was carried into it counts as one fact on the day before."""
        changes = self._changes(tail)
        kinds = changes.schema
        zeros = [F.lit(0).cast(kinds[m].dataType).alias(m) for m in MOVEMENTS]
        opened = before.join(cut, "grp").select(*self.keys, F.date_sub("cut", 1).alias("date"), *zeros, F.col("total").alias("change"))
        later = tails.join(cut, "grp").withColumn("s", F.greatest("s", "cut")).where(F.col("s") <= F.col("e")).drop("cut")
        rows = O.daily_balances(changes.unionByName(opened), self.keys, later, measures=MOVEMENTS)
        rows = rows.join(cut, "grp").where(F.col("date") >= F.col("cut")).withColumn("month", month_of("date"))
        return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schemas[DAILY].fields])

    def _carried_after(self, tail: DataFrame, before: DataFrame, totals: DataFrame, cut: DataFrame) -> DataFrame:
        """What every key brings into each month after the cut, up to the group's last."""
        by_month = self._changes(tail).groupBy(*self.keys, month_of("date").alias("month")).agg(
            F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.sum("change").alias("total")
        )
        brought = before.join(cut, "grp").withColumn("month", F.add_months("cut", -1)).drop("cut")
        so_far = Window.partitionBy(*self.keys).orderBy("month")
        upto = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        running = by_month.unionByName(brought).withColumns(
            {
                "first_date": F.min("first_date").over(upto),
                "last_date": F.max("last_date").over(upto),
                "total": F.sum("total").over(upto),
                "following": F.lead("month").over(so_far),
            }
        )
        ends = totals.groupBy("grp").agg(month_of(F.max("last_date")).alias("end"))
        into = running.join(ends, "grp").withColumns({"s": F.add_months("month", 1), "e": F.least(F.coalesce("following", "end"), "end")})
        rows = into.where("s <= e").withColumn("month", F.explode(F.sequence("s", "e", F.expr("interval 1 month"))))
        return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schemas[CARRIED].fields])

    def _replace(self, name: str, table: DataFrame, since: dict[str, datetime.date | None]) -> None:
        """Put a table's partitions in place of those of its groups, of the months from a group's date on where it has one."""
        beside = f"_next-{uuid.uuid4().hex}"
        by = ["grp"] if name == TOTALS else ["grp", "month"]
        table.write.partitionBy(*by).parquet(f"{self.files.root}/{beside}/{name}")
        for folder in self._partitions(name, by, since):
            self.files.delete(f"{name}/{folder}")
        for folder in self._partitions(f"{beside}/{name}", by, since):
            self.files.move(f"{beside}/{name}/{folder}", f"{name}/{folder}")
        self.files.delete(beside)

    def _partitions(self, name: str, by: list[str], since: dict[str, datetime.date | None]) -> list[str]:
        found = []
        for group in self.files.names(name):
            if group.startswith("grp=") and partition_value(group) in since:
                first = since[partition_value(group)]
                months = [m for m in self.files.names(f"{name}/{group}") if m.startswith("month=")] if len(by) > 1 else []
                found += [f"{group}/{m}" for m in months if first is None or partition_value(m) >= first.isoformat()] if len(by) > 1 else [group]
        return found


def _next_month(first: datetime.date) -> datetime.date:
    return (first + datetime.timedelta(days=32)).replace(day=1)


def _in_months(cuts: dict[str, datetime.date], relation: str) -> Column:
    """Partitions of each group from its month on, or of that month; groups of one month are named together."""
    together: dict[datetime.date, list[str]] = {}
    for grp, month in cuts.items():
        together.setdefault(month, []).append(grp)
    among = F.lit(False)
    for month, groups in together.items():
        here = F.col("month") == F.lit(month) if relation == "=" else F.col("month") >= F.lit(month)
        among = among | (F.col("grp").isin(groups) & here)
    return among


def _first_difference(a: str, b: str) -> Column:
    """The first day that is in one of two arrays of disjoint ascending spans and not in the other; null arrays are empty."""
    none = F.array().cast("array<struct<s: date, e: date>>")
    pairs = F.arrays_zip(F.coalesce(F.col(a), none).alias("x"), F.coalesce(F.col(b), none).alias("y"))
    pair = F.get(F.filter(pairs, lambda p: ~p["x"].eqNullSafe(p["y"])), F.lit(0))
    x, y = pair["x"], pair["y"]
    return F.when(x["s"] == y["s"], F.date_add(F.least(x["e"], y["e"]), 1)).otherwise(F.least(x["s"], y["s"]))
