"""Workbooks that arrive in a folder, published as they come.

Two streams share the work. One looks at the folder at every tick, lands the workbooks that are new or have changed, and
notes which kinds and groups that concerns. The other reads these notes and publishes: an arrived kind concerns the
reports that read it, for its group alone. A late or corrected workbook changes the balances of its group from that day
on: a report is built anew from all landed rows of its group, or, with kept balances, from the first changed month on.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.jobs import BUILD, NEEDS, publish, reports_of
from ..sources.files import Files
from .balances import KeptBalances
from .gate import due_reports
from .landing import ARRIVALS, ARRIVALS_SCHEMA, affected_groups, land, landed_groups, landed_rows, take, withdraw

__all__ = ["FolderStream", "affected_groups", "land", "refresh", "run_stream", "withdraw"]

# Workbooks of a batch, at most; the others wait for the next one.
BATCH_FILES = 1000


class FolderStream:
    """The two streams of a folder; the one that lands is None where all has been landed already."""

    def __init__(self, landing: StreamingQuery | None, publishing: StreamingQuery):
        self.landing, self.publishing = landing, publishing

    @property
    def isActive(self) -> bool:
        return self.publishing.isActive and (self.landing is None or self.landing.isActive)

    def awaitTermination(self, timeout: float | None = None) -> bool:
        """Wait until the publishing stream ends; with a timeout in seconds, say whether it has."""
        if timeout is None:
            self.publishing.awaitTermination()
            return True
        return bool(self.publishing.awaitTermination(timeout))

    def stop(self) -> None:
        if self.landing is not None:
            self.landing.stop()
        self.publishing.stop()


def run_stream(
    spark: SparkSession,
    landing: str,
    landed: str,
    out: str,
    checkpoint: str,
    *,
    reports: Sequence[str] | None = None,
    fmt: str = "csv",
    every: str | None = None,
    archive: str | None = None,
    settle: float | None = None,
    patience: float = 600,
    batch_files: int = BATCH_FILES,
    balances: str | None = None,
    set_aside: bool = False,
) -> FolderStream:
    """Land and publish what has arrived and stop, or look again ``every`` interval.

    Without ``every``, everything is landed before anything is published. With it, ``settle`` holds a report back until its
    group's workbooks are complete and none has come for so many seconds, for ``patience`` seconds at most (see ``gate``);
    without ``settle`` each batch is published at once. A batch lands ``batch_files`` workbooks at most. Landed workbooks stay
    where they are; ``archive`` moves them there. ``balances`` is a folder that keeps the balances of trial balances and debts
    between batches; they fail at cells that cannot be read, the other reports can set these aside (see ``jobs.publish``).
    """
    Files(spark, landed).make(ARRIVALS)
    names = list(BUILD if reports is None else reports)

    def look(ticks: DataFrame, _: int) -> None:
        for _changed in take(ticks.sparkSession, landing, landed, batch_files=batch_files, archive=archive):
            pass

    def show(batch: DataFrame, _: int) -> None:
        rows = batch.collect()  # one row for each group and report, or kind, of a batch
        refresh(batch.sparkSession, landed, out, [((r["report"],) if gated else reports_of([r["kind"]], names), r["grp"]) for r in rows], fmt, balances, set_aside)

    landing_query, trigger = None, {"processingTime": every} if every else {"availableNow": True}
    if every:
        ticks = spark.readStream.format("rate").load()
        landing_query = ticks.writeStream.foreachBatch(look).option("checkpointLocation", f"{checkpoint}/landing").trigger(**trigger).start()
    else:
        look(spark.range(0), 0)
    notes = spark.readStream.schema(ARRIVALS_SCHEMA).parquet(f"{landed}/{ARRIVALS}")
    gated = bool(every) and settle is not None
    if gated:
        notes = due_reports(notes, {r: NEEDS[r] for r in names}, settle, patience)
    writer = notes.writeStream.foreachBatch(show).option("checkpointLocation", f"{checkpoint}/{'gated' if gated else 'publishing'}")
    return FolderStream(landing_query, writer.trigger(**trigger).start())


def refresh(
    spark: SparkSession, landed: str, out: str, due: Sequence[tuple[Sequence[str], str]], fmt: str = "csv", balances: str | None = None, set_aside: bool = False
) -> Mapping[str, list[str]]:
    """Publish some reports of some groups from the landed rows; returns the groups of each report."""
    groups: dict[str, set[str]] = {}
    for reports, grp in due:
        for report in reports:
            groups.setdefault(report, set()).add(grp)
    wanted = {r: sorted(groups[r]) for r in BUILD if r in groups}
    if wanted:
        build = None
        if balances is not None:
            kept = KeptBalances(spark, balances)
            kept.sync(landed)
            build = kept.reports()
        rows = landed_groups(spark, landed, set().union(*groups.values()))
        publish(spark, rows, out, wanted, fmt, written=True, build=build, set_aside=set_aside)
    return wanted


def publish_landed(spark: SparkSession, landed: str, out: str, reports: Sequence[str] | None = None, fmt: str = "csv") -> None:
    """Publish everything that has landed; groups without rows go."""
    publish(spark, landed_rows(spark, landed), out, reports, fmt, written=True)
