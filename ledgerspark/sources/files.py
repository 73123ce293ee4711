"""The few operations on folders that Spark's readers and writers don't have, on any Hadoop file system."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import SparkSession


class Files:
    """Folders and small files below a root folder, by their relative paths."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark._jvm
        self.root = root.rstrip("/")
        path = self.jvm.org.apache.hadoop.fs.Path(self.root)
        self.system = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, name: str = ""):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str = "") -> bool:
        return self.system.exists(self.at(name))

    def names(self, name: str = "") -> list[str]:
        """Names of what lies in a folder, none where it is missing."""
        return sorted(s.getPath().getName() for s in self.system.listStatus(self.at(name))) if self.exists(name) else []

    def make(self, name: str = "") -> None:
        self.system.mkdirs(self.at(name))

    def delete(self, name: str = "") -> None:
        self.system.delete(self.at(name), True)

    def move(self, source: str, target: str) -> None:
        target_path = self.at(target)
        self.system.mkdirs(target_path.getParent())
        if not self.system.rename(self.at(source), target_path):
            raise OSError(f"{self.root}: {source} could not be moved to {target}")

    def write(self, name: str, text: str) -> None:
        """A whole small file, visible at once: written under another name, then renamed."""
        out = self.system.create(self.at(f"{name}.part"), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.move(f"{name}.part", name)

    def read(self, name: str) -> str:
        stream = self.system.open(self.at(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()


def partition_value(folder: str) -> str:
    """The value in the name of a partition folder, as ``grp=...``."""
    return unquote(folder.partition("=")[2])
