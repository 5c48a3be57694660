"""Owned intermediate results: deleted through the file system that holds them, and remembered by the content they came from."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from basketry.session import shared_folder


def file_system(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """The Hadoop file system of a path, and the path for it."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder with all it holds; whether there was one."""
    system, there = file_system(spark, path)
    return bool(system.delete(there, True))


def listing(spark: SparkSession, paths: Sequence[str]) -> tuple[tuple[str, int, int], ...]:
    """(path, size, time of change) of files, in order. A file that is gone has size and time -1."""
    found = []
    for path in sorted(set(paths)):
        system, there = file_system(spark, path)
        if system.exists(there):
            status = system.getFileStatus(there)
            found.append((path, status.getLen(), status.getModificationTime()))
        else:
            found.append((path, -1, -1))
    return tuple(found)


def checkpoint_files(df: DataFrame) -> list[str]:
    """Folders of the checkpoints that a plan reads."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    found = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRDD" and leaf.rdd().getCheckpointFile().isDefined():
            found.append(leaf.rdd().getCheckpointFile().get())
    return found


def discard(*checkpointed: DataFrame) -> None:
    """Delete the checkpoints of tables that nobody reads any more.

    To be called once everything made from them is itself written or collected: what was not would fail from then on.
    """
    for df in checkpointed:
        for folder in checkpoint_files(df):
            delete(df.sparkSession, folder)


@dataclass
class Entry:
    name: str
    frames: tuple[DataFrame, ...]
    files: tuple[tuple[str, int, int], ...]
    value: Any
    folder: str | None
    readers: int = 0
    pinned: bool = False
    stale: bool = False


class Memo:
    """Results kept by content: the plans they were built from and the listing (path, size, time) of the files those read.

    Tables are written once to a folder of their own, other values are kept as they are. When files change, the next call builds
    anew and the older result goes once its last lease ends; `get` keeps its result until `close`, as a DataFrame made from it
    may be run at any time. `close` deletes all that was written.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/memo-{uuid.uuid4().hex}"
        self.entries: list[Entry] = []

    def _entry(self, name: str, frames: Sequence[DataFrame], build: Callable[[], Any]) -> Entry:
        files = listing(self.spark, [path for df in frames for path in df.inputFiles()])
        alike = [e for e in self.entries if e.name == name and _same(e.frames, frames)]
        for entry in alike:
            if entry.files == files:
                return entry
        value, folder = build(), None
        if isinstance(value, DataFrame):
            folder = f"{self.folder}/{name}-{uuid.uuid4().hex}"
            value.write.parquet(folder)
            value = self.spark.read.schema(value.schema).parquet(folder)
        for entry in alike:
            entry.stale = True
            self._drop_unused(entry)
        made = Entry(name, tuple(frames), files, value, folder)
        self.entries.append(made)
        return made

    def get(self, name: str, frames: Sequence[DataFrame], build: Callable[[], Any]) -> Any:
        """The result of `build` for the present content of `frames`, kept until `close`."""
        entry = self._entry(name, frames, build)
        entry.pinned = True
        return entry.value

    @contextmanager
    def lease(self, name: str, frames: Sequence[DataFrame], build: Callable[[], Any]) -> Iterator[Any]:
        """The same for as long as the block runs; results that newer ones replaced go with their last reader."""
        entry = self._entry(name, frames, build)
        entry.readers += 1
        try:
            yield entry.value
        finally:
            entry.readers -= 1
            self._drop_unused(entry)

    def _drop_unused(self, entry: Entry) -> None:
        if entry.stale and not entry.readers and not entry.pinned:
            self._drop(entry)

    def _drop(self, entry: Entry) -> None:
        self.entries.remove(entry)
        if entry.folder:
            delete(self.spark, entry.folder)
        elif hasattr(entry.value, "close"):
            entry.value.close()

    def close(self) -> None:
        for entry in list(self.entries):
            self._drop(entry)
        delete(self.spark, self.folder)


def _same(a: Sequence[DataFrame], b: Sequence[DataFrame]) -> bool:
    return len(a) == len(b) and all(x.sameSemantics(y) for x, y in zip(a, b, strict=True))
