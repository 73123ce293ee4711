"""Written intermediate tables.

A staged table is Parquet in the shared folder the session names in ``spark.checkpoint.dir``. It is
computed once, read back column by column by everything that follows, and outlives the loss of
executors.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from .files import Files


def scratch_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. Where none is set: a temporary one in local mode, an error on a cluster."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured is None:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: there is no shared folder to write intermediate tables to")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerspark-"))
        configured = context.getCheckpointDir()
    return configured


class Staging:
    """A folder of staged tables for one job; calling it stages a DataFrame.

    As a context manager it deletes its folder at the end::

        with Staging(spark) as stage:
            write_report(debt_daily(sheet, stage=stage), path)

    Otherwise the folder goes with the ``scope`` that it was made in, or, as a lazy result may still read it, when the
    session's process ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{scratch_dir(spark).rstrip('/')}/staged-{uuid.uuid4().hex}"
        self.count = 0
        _SCOPES[-1].append(self)

    def __call__(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.path}/{self.count}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def folder(self) -> str:
        """The folder's path, for callers that write to it themselves."""
        return self.path

    def delete(self) -> None:
        Files(self.spark, self.path).delete()

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_: object) -> None:
        self.delete()


# Folders of open scopes; the first list is the process itself.
_SCOPES: list[list[Staging]] = [[]]


@contextmanager
def scope() -> Iterator[None]:
    """What is staged inside is deleted at the end: for steps whose result has been written by then."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for stage in _SCOPES.pop():
            stage.delete()


@atexit.register
def _delete_all() -> None:
    for stage in _SCOPES[0]:
        if stage.spark.sparkContext._jsc is not None:
            stage.delete()
