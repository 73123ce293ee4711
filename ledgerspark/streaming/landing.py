"""The landed rows of all workbooks, and the table of the workbooks they come from.

Rows are kept by content: a workbook's identity is its name and digest. The table of files says which content each path
has now. Rows are read through it, so a content counts once however many paths have it, and goes when the last of them
has another one or is withdrawn.

    landed/kind=.../grp=.../    rows
    landed/_files/grp=.../      path, modified, length, source_file, kind, arrived
    landed/_arrivals/           kinds and groups that have changed, in the order of the batches
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parsing import file_group
from ..sources.files import Files, partition_value
from ..sources.staging import Staging
from ..sources.workbooks import LANDED, LANDED_COLUMNS, decode_workbooks, file_name, find_workbooks, identified, workbook_kind

LANDED_PARTITIONS = ["kind", "grp"]
FILES, ARRIVALS = "_files", "_arrivals"
FILES_SCHEMA = "path string, modified timestamp, length bigint, source_file string, kind string, arrived timestamp, grp string"
ARRIVALS_SCHEMA = "grp string, kind string, arrived timestamp"


def of_known_kind(files: DataFrame) -> DataFrame:
    named = files.withColumn("name", file_name("path")).withColumn("kind", workbook_kind("name"))
    return named.where(F.col("kind").isNotNull())


def arrived(batch: DataFrame) -> list:
    """The rows that the workbooks of a batch have in the table of files, of those that some report reads.

    They come to the driver: a batch has at most BATCH_FILES workbooks.
    """
    return of_known_kind(identified(of_known_kind(batch))).select(
        "path", F.col("modificationTime").alias("modified"), "length", "source_file", "kind",
        F.current_timestamp().alias("arrived"), file_group("name", strict=True).alias("grp"),
    ).collect()


def changed_paths(spark: SparkSession, folder: str, landed: str) -> DataFrame:
    """Paths of the folder's workbooks that are new, or that have another time or length than when they were landed.

    No workbook is opened. A corrected workbook is found under its old path, which a file stream would pass over.
    """
    now = of_known_kind(find_workbooks(spark, folder)).select("path", F.col("modificationTime").alias("modified"), "length")
    known = files(spark, landed).select("path", "modified", "length")
    return now.join(known, ["path", "modified", "length"], "left_anti").orderBy("modified", "path").select("path")


def take(spark: SparkSession, folder: str, landed: str, *, batch_files: int, archive: str | None = None) -> Iterator[list[tuple[str, str]]]:
    """Land what has changed in a folder, batch by batch; yields the kinds and groups that each batch has changed.

    Landed workbooks stay where they are, or go to the ``archive``, each into a folder of its content's digest.
    """
    paths = [r["path"] for r in changed_paths(spark, folder, landed).toLocalIterator()]
    for at in range(0, len(paths), batch_files):
        # in the reader's argument some characters would be a pattern
        plain = [re.sub(r"([{}\[\]*?\\])", r"\\\1", p) for p in paths[at : at + batch_files]]
        batch = spark.read.format("binaryFile").load(plain)
        changed = land(batch, landed)
        note_arrivals(spark, landed, changed)
        if archive is not None:
            _archive(spark, folder, landed, paths[at : at + batch_files], archive)
        yield changed


def _archive(spark: SparkSession, folder: str, landed: str, paths: list[str], archive: str) -> None:
    own = Files(spark, folder)
    path = own.jvm.org.apache.hadoop.fs.Path
    root = own.system.makeQualified(own.at()).toUri().getPath().rstrip("/")
    for row in files(spark, landed).where(F.col("path").isin(paths)).select("path", "source_file").collect():
        inside = path(row["path"]).toUri().getPath().removeprefix(root).lstrip("/")
        target = path(f"{archive.rstrip('/')}/{row['source_file'].rpartition('@')[2]}/{inside}")
        own.system.mkdirs(target.getParent())
        own.system.rename(path(row["path"]), target)


def land(batch: DataFrame, landed: str) -> list[tuple[str, str]]:
    """Take the workbooks of a batch in; returns the kinds and groups that have changed.

    A workbook that comes again under its path replaces what it was, also if it is empty now. One whose content is landed
    already, there or under another path, changes nothing.
    """
    return _update(batch.sparkSession, landed, arrived(batch), [], batch)


def withdraw(spark: SparkSession, landed: str, paths: Iterable[str]) -> list[tuple[str, str]]:
    """Take the workbooks of some paths out; returns the kinds and groups that have changed."""
    paths = sorted(set(paths))
    rows = files(spark, landed).where(F.col("path").isin(paths)).select("kind", "grp").distinct().collect() if paths else []
    return _update(spark, landed, [], [(r["kind"], r["grp"]) for r in rows], None, paths)


def _update(spark: SparkSession, landed: str, new: list, touched: list[tuple[str, str]], batch: DataFrame | None, gone: Iterable[str] = ()) -> list[tuple[str, str]]:
    groups = {f["grp"] for f in new} | {g for _, g in touched}
    if not groups:
        return []
    folder = Files(spark, landed)
    before = files(spark, landed).where(F.col("grp").isin(sorted(groups)))
    replaced = F.col("path").isin([f["path"] for f in new] + list(gone))
    with Staging(spark) as stage:
        kept = before.where(~replaced)
        after = stage(kept.unionByName(spark.createDataFrame([f.asDict() for f in new], FILES_SCHEMA)) if new else kept)
        # at most one identity for each path of the batch
        taken = {(r["kind"], r["grp"], r["source_file"]) for r in before.where(replaced).select("kind", "grp", "source_file").distinct().collect()}
        given = {(f["kind"], f["grp"], f["source_file"]) for f in new}
        both = [s for _, _, s in taken | given]
        had, has = (_identities(table, both) for table in (before, after))
        fresh, dead = {k for k in given if k[2] not in had}, {k for k in taken if k[2] not in has}
        changed = sorted({(kind, grp) for kind, grp, _ in fresh | dead})
        if changed:
            old = landed_rows(spark, landed).where(_of(changed) & ~F.col("source_file").isin([s for _, _, s in dead]))
            rows = old
            if fresh:
                one_path = {f["source_file"]: f["path"] for f in new}
                decoded = decode_workbooks(batch.where(F.col("path").isin([one_path[s] for _, _, s in fresh])))
                rows = old.where(~F.col("source_file").isin([s for _, _, s in fresh])).unionByName(decoded)
            _replace(folder, rows, LANDED_PARTITIONS, "", {f"kind={k}/grp={g}" for k, g in changed})
        # from here on the new rows count
        _replace(folder, after, ["grp"], FILES, {f"grp={g}" for g in groups})
    return changed


def _identities(table: DataFrame, of: list[str]) -> set[str]:
    return {r["source_file"] for r in table.where(F.col("source_file").isin(of)).select("source_file").distinct().collect()}


def _of(partitions: Iterable[tuple[str, str]]) -> Column:
    among = F.lit(False)
    for kind, grp in partitions:
        among = among | ((F.col("kind") == kind) & (F.col("grp") == grp))
    return among


def _replace(folder: Files, table: DataFrame, by: list[str], name: str, touched: set[str]) -> None:
    """Write a table in place of the touched partitions; those it has no rows of are deleted.

    It is written beside them first, as it may be read from them.
    """
    beside = f"_next-{uuid.uuid4().hex}"
    table.write.partitionBy(*by).parquet(f"{folder.root}/{beside}")
    for old in _folders(folder, name, len(by)):
        value = "/".join(f"{part.partition('=')[0]}={partition_value(part)}" for part in old)
        if value in touched:
            folder.delete("/".join([name, *old]).lstrip("/"))
    for new in _folders(folder, beside, len(by)):
        folder.move("/".join([beside, *new]), "/".join([name, *new]).lstrip("/"))
    folder.delete(beside)


def _folders(folder: Files, name: str, depth: int) -> list[list[str]]:
    """Partition folders below a folder, as lists of their names."""
    own = [n for n in folder.names(name) if "=" in n and not n.startswith((".", "_"))]
    if depth == 1:
        return [[n] for n in own]
    return [[n, *rest] for n in own for rest in _folders(folder, f"{name}/{n}".lstrip("/"), depth - 1)]


def files(spark: SparkSession, landed: str) -> DataFrame:
    """The table of files; without rows where nothing has landed."""
    if not Files(spark, landed).exists(FILES):
        return spark.createDataFrame([], FILES_SCHEMA)
    return spark.read.schema(FILES_SCHEMA).parquet(f"{landed}/{FILES}")


def landed_rows(spark: SparkSession, landed: str) -> DataFrame:
    """The rows of every content that some path has."""
    if not any(n.startswith("kind=") for n in Files(spark, landed).names()):
        return spark.createDataFrame([], LANDED)
    rows = spark.read.schema(LANDED).parquet(landed)
    live = files(spark, landed).select("source_file", "kind", "grp").distinct()
    return rows.join(live, ["source_file", "kind", "grp"], "left_semi").select(*LANDED_COLUMNS)


def landed_groups(spark: SparkSession, landed: str, groups: Iterable[str]) -> DataFrame:
    """Landed rows of some groups; only their partitions are read."""
    return landed_rows(spark, landed).where(F.col("grp").isin(sorted(groups)))


def affected_groups(batch: DataFrame, landed: str) -> DataFrame:
    """All landed rows of the groups that have a workbook in the batch."""
    return landed_groups(batch.sparkSession, landed, {f["grp"] for f in arrived(batch)})


def note_arrivals(spark: SparkSession, landed: str, changed: list[tuple[str, str]]) -> None:
    """Append what has changed to the arrivals, for those who publish."""
    if changed:
        rows = spark.createDataFrame([(g, k) for k, g in changed], "grp string, kind string")
        rows.withColumn("arrived", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{landed}/{ARRIVALS}")
