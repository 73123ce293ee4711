"""Reports that become visible together, complete by group.

A run writes its reports beside the published ones. Its commit is one small file, the manifest, that lists which group
folders take the place of which, and which ones go because their group has no rows left. The folders are then moved; if
that is interrupted, the next publication, or ``recover``, finishes it from the manifest. A run that fails before its
manifest leaves the published reports as they were. One run publishes to a folder at a time.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .files import Files, partition_value
from .sinks import published, write_published

BESIDE = "_next-"
MANIFEST = "_manifest-"


class Publication:
    """One run's reports; as a context manager it commits at the end, or takes everything back on an error::

        with Publication(spark, out) as publication:
            publication.write(debt, "ОСВ 66_67", groups=["Альфа"])
    """

    def __init__(self, spark: SparkSession, out: str, fmt: str = "csv"):
        recover(spark, out)
        self.files, self.fmt, self.id = Files(spark, out), fmt, uuid.uuid4().hex
        self.groups: dict[str, set[str] | None] = {}
        self.profiles: dict[str, list[tuple[str, str, int, int]]] = {}

    def write(self, df: DataFrame, report: str, groups: Iterable[str] | None = None) -> None:
        """Write a report beside the published one.

        ``groups`` are the groups that it replaces: other rows are left out, and a group without rows loses its folder. None
        stands for all groups, those included that are published and no longer in ``df``. The report's profile (column, type,
        rows, non-null values) is counted by the write itself.
        """
        self.add(published(df, report), report, groups)

    def add(self, shown: DataFrame, report: str, groups: Iterable[str] | None = None) -> None:
        """Write a table that has the published columns already, and ``grp``."""
        if groups is not None:
            groups = set(groups)
            shown = shown.where(F.col("grp").isin(sorted(groups)))
        seen = Observation()
        counts = [F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(shown.columns)]
        beside = f"{BESIDE}{self.id}/{report}"
        write_published(shown.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), f"{self.files.root}/{beside}", self.fmt)
        # a plan that turns out to be empty is cut down, with its counters
        found = seen.get if group_folders(self.files, beside) else defaultdict(int)
        self.profiles[report] = [(c, kind, found["rows"], found[f"n{i}"]) for i, (c, kind) in enumerate(shown.dtypes)]
        self.groups[report] = groups

    def commit(self) -> None:
        """Make the written reports the published ones."""
        changes = {}
        for report, groups in self.groups.items():
            new = group_folders(self.files, f"{BESIDE}{self.id}/{report}")
            old = group_folders(self.files, report)
            gone = [f for f in old if f not in new and (groups is None or partition_value(f) in groups)]
            changes[report] = {"put": new, "drop": gone}
        self.files.write(f"{MANIFEST}{self.id}", json.dumps(changes))
        _apply(self.files, self.id)

    def __enter__(self) -> Publication:
        return self

    def __exit__(self, kind: type | None, *_: object) -> None:
        if kind is None:
            self.commit()
        elif f"{MANIFEST}{self.id}" not in self.files.names():
            self.files.delete(f"{BESIDE}{self.id}")


def group_folders(files: Files, folder: str) -> list[str]:
    return [n for n in files.names(folder) if n.startswith("grp=")]


def _apply(files: Files, run: str) -> None:
    """Carry out a manifest; what an interrupted run has already moved is not beside any more and stays."""
    for report, change in json.loads(files.read(f"{MANIFEST}{run}")).items():
        waiting = set(group_folders(files, f"{BESIDE}{run}/{report}"))
        for name in change["drop"]:
            files.delete(f"{report}/{name}")
        for name in change["put"]:
            if name in waiting:
                files.delete(f"{report}/{name}")
                files.move(f"{BESIDE}{run}/{report}/{name}", f"{report}/{name}")
    files.delete(f"{BESIDE}{run}")
    files.delete(f"{MANIFEST}{run}")


def recover(spark: SparkSession, out: str) -> None:
    """Finish publications that were committed and interrupted, and remove what uncommitted ones have left."""
    files = Files(spark, out)
    names = files.names()
    for name in names:
        if name.startswith(MANIFEST) and not name.endswith(".part"):
            _apply(files, name.removeprefix(MANIFEST))
    for name in files.names():
        if name.startswith((BESIDE, MANIFEST)):
            files.delete(name)
