"""Parquet tables that are replaced whole: a version is a list of folders, and it counts once its list is there.

Rows are written to a folder of their own first. Then a list of the folders that make up the table, by partition, is put in
place under the next version's number by one rename, which fails if another writer was faster. Readers take the highest number:
until the rename they see the older version, and a write that fails leaves nothing behind. A write may replace only the
partitions it has rows for; all others stay the folders they were.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.store import delete, file_system


class Conflict(RuntimeError):
    """Another writer put the next version in place first."""


class VersionedTable:
    """A table under `path`, partitioned by columns named at every write."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.lists = f"{self.path}/_versions"

    def versions(self) -> list[int]:
        system, there = file_system(self.spark, self.lists)
        if not system.exists(there):
            return []
        names = [status.getPath().getName() for status in system.listStatus(there)]
        return sorted(int(name.removesuffix(".json")) for name in names if name.removesuffix(".json").isdigit())

    def _list(self, version: int) -> dict:
        system, there = file_system(self.spark, f"{self.lists}/{version:012d}.json")
        stream = system.open(there)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def read(self, version: int | None = None) -> DataFrame:
        """The newest version, or the one named, as long as its folders are kept."""
        known = self.versions()
        if not known or version is not None and version not in known:
            raise FileNotFoundError(f"{self.path} has no version" + (f" {version}" if version is not None else ""))
        held = self._list(known[-1] if version is None else version)
        schema = T.StructType.fromJson(held["schema"])
        by_write: dict[str, list[str]] = {}
        for partition, write in sorted(held["partitions"].items()):
            by_write.setdefault(write, []).append(f"{self.path}/{write}/{partition}".rstrip("/"))
        reader = self.spark.read.schema(schema)
        parts = [reader.option("basePath", f"{self.path}/{write}").parquet(*folders) for write, folders in by_write.items()]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], schema)

    def write(self, df: DataFrame, partition_by: Sequence[str] = (), only_touched: bool = False, touched: Sequence[str] = ()) -> int:
        """Put `df` in place as the next version and return the rows written.

        With `only_touched` the partitions that `df` has rows for are replaced and the others stay; it must then have the columns
        and partitioning of the version before. `touched` names further partitions (`column=value/...`) that go if `df` has no rows
        for them. Fails as a whole or not at all.
        """
        before = self.versions()
        held = self._list(before[-1]) if before else None
        if only_touched and held and (held["by"] != list(partition_by) or held["columns"] != sorted(df.columns)):
            raise ValueError("touched partitions need the columns and partitioning of the table")
        write = f"write-{uuid.uuid4().hex}"
        seen = Observation()
        try:
            spread = df.hint("rebalance", *partition_by) if partition_by else df
            spread.observe(seen, F.count(F.lit(1)).alias("rows")).write.partitionBy(*partition_by).parquet(f"{self.path}/{write}")
            partitions = dict.fromkeys(self._partitions(write, len(partition_by)), write)
            if only_touched and held:
                partitions = {p: w for p, w in held["partitions"].items() if p not in touched} | partitions
            body = {"by": list(partition_by), "columns": sorted(df.columns), "schema": df.schema.jsonValue(), "partitions": partitions}
            self._commit((before[-1] if before else 0) + 1, json.dumps(body))
        except BaseException:
            delete(self.spark, f"{self.path}/{write}")
            raise
        return seen.get["rows"]

    def _partitions(self, write: str, depth: int) -> list[str]:
        """The innermost partition folders of a write, relative to it."""
        system, root = file_system(self.spark, f"{self.path}/{write}")
        level = [""]
        for _ in range(depth):
            below = []
            for folder in level:
                there = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{write}/{folder}".rstrip("/"))
                below += [f"{folder}/{s.getPath().getName()}".lstrip("/") for s in system.listStatus(there) if s.isDirectory()]
            level = below
        return level

    def _commit(self, version: int, body: str) -> None:
        """Write the list beside its place, then move it there unless the place is taken."""
        draft = f"{self.lists}/.{uuid.uuid4().hex}"
        system, there = file_system(self.spark, draft)
        stream = system.create(there)
        stream.write(bytearray(body.encode()))
        stream.close()
        fs = self.spark._jvm.org.apache.hadoop.fs
        files = fs.FileContext.getFileContext(there.toUri() if there.toUri().getScheme() else system.getUri(), self.spark._jsc.hadoopConfiguration())
        never = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(system.makeQualified(there), system.makeQualified(fs.Path(f"{self.lists}/{version:012d}.json")), never)
        except Exception as error:
            system.delete(there, False)
            if "FileAlreadyExists" in str(error):
                raise Conflict(f"{self.path} has a version {version} already") from error
            raise

    def vacuum(self, keep: int = 1) -> int:
        """Forget all but the newest `keep` versions and delete the writes that none of them needs; how many went.

        Readers of a forgotten version fail from then on, and so may a write that is under way.
        """
        known = self.versions()
        kept = known[-keep:] if keep else []
        needed = {write for version in kept for write in self._list(version)["partitions"].values()}
        for version in known[: len(known) - len(kept)]:
            delete(self.spark, f"{self.lists}/{version:012d}.json")
        system, root = file_system(self.spark, self.path)
        stray = [s.getPath() for s in system.listStatus(root) if s.getPath().getName().startswith("write-") and s.getPath().getName() not in needed]
        for folder in stray:
            system.delete(folder, True)
        return len(stray)


