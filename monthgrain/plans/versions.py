"""Tables whose partitions are replaced one by one, and whose changes are seen all at once.

A change writes new files for the partitions that it touches, under a version of its own, and then a manifest: for each
partition the version that holds it. Only a manifest makes files part of the table, and it appears by one
rename; so readers see a change whole or not at all, a failed change leaves the table as it was, and two changes made at
the same time can't both be kept. What a change reads and writes follows from the partitions touched, not from
the size of the table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.catalog import merge_upsert


class Conflict(Exception):
    """Another change was made since the version that this one started from."""


class Folder:
    """A folder in whatever store Spark keeps it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self.fs = self._of(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _of(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, below: str) -> list[str]:
        path = self._of(f"{self.path}/{below}")
        return [f.getPath().getName() for f in self.fs.listStatus(path)] if self.fs.exists(path) else []

    def text(self, name: str) -> str:
        stream = self.fs.open(self._of(f"{self.path}/{name}"))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> bool:
        """Writes a file that must not be there, so that it is there whole or not at all; False if it is there already."""
        whole, part = self._of(f"{self.path}/{name}"), self._of(f"{self.path}/{name}.{uuid.uuid4().hex}.tmp")
        stream = self.fs.create(part, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self.fs.exists(whole) and self.fs.rename(part, whole):
            return True
        self.fs.delete(part, False)
        return False

    def delete(self, below: str = "") -> None:
        self.fs.delete(self._of(f"{self.path}/{below}" if below else self.path), True)


class VersionedTable:
    """A Parquet table in root, partitioned by a column, with rows told apart by keys."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, by: str, keys: Sequence[str] = ()):
        self.spark, self.root, self.schema, self.by, self.keys = spark, root.rstrip("/"), schema, by, list(keys)
        self.folder = Folder(spark, self.root)

    @classmethod
    def open(cls, spark: SparkSession, root: str, by: str, keys: Sequence[str] = ()) -> VersionedTable:
        """A table that was written before, with the columns it had last."""
        table = cls(spark, root, StructType(), by, keys)
        if not table.versions():
            raise ValueError(f"no version of a table in {root}")
        table.schema = StructType.fromJson(table.manifest()["schema"])
        return table

    def versions(self) -> list[int]:
        """Those that have a manifest, the latest last."""
        return sorted(int(n[:-5]) for n in self.folder.names("manifest") if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """The latest one, or that of a version; an empty one for a table that was never written."""
        known = self.versions()
        if version is None and not known:
            return {"version": 0, "partitions": {}, "note": None}
        return json.loads(self.folder.text(f"manifest/{known[-1] if version is None else version:012d}.json"))

    def read(self, version: int | None = None) -> DataFrame:
        """The table's rows as of a version. Filters on the partition column choose folders."""
        return self._read(self.manifest(version)["partitions"])

    def _read(self, partitions: dict[str, int]) -> DataFrame:
        if not partitions:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.root}/data/version={v}/{folder}" for folder, v in sorted(partitions.items())]
        return self.spark.read.schema(self.schema).option("basePath", f"{self.root}/data").parquet(*paths).select(*self.schema.names)

    def replace(self, rows: DataFrame, slices: Sequence[str] | None = None, note: str | None = None, partitions: Sequence | None = None) -> int:
        """The version in which rows stand for all that the table has of the same slices (columns; the partition column if
        none are given). Other rows of the partitions touched are kept, other partitions aren't read. With partitions, these
        are touched, and one that rows has nothing of is emptied."""
        slices = list(slices or [self.by])

        def without(old: DataFrame) -> DataFrame:
            if slices == [self.by]:
                return rows
            held = rows.select(*(F.col(c).alias(f"_{c}") for c in slices)).distinct()
            same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in slices))
            return old.join(held, same, "left_anti").select(*self.schema.names).unionByName(rows.select(*self.schema.names))

        return self._change(rows, without, note, partitions)

    def merge(self, changes: DataFrame, defaults: dict | None = None, note: str | None = None) -> int:
        """The version with changes merged in by the keys (which hold no nulls): their columns win, the others keep their values or
        get a default."""
        return self._change(changes, lambda old: merge_upsert(old, changes, self.keys, defaults or {}), note)

    def _change(self, rows: DataFrame, make, note: str | None, partitions: Sequence | None = None) -> int:
        before = self.manifest()
        touched = [r[0] for r in rows.select(self.by).distinct().collect()] if partitions is None else list(partitions)  # as many as the table has partitions, at most
        if not touched:
            return before["version"]
        version = before["version"] + 1
        among = reduce(lambda a, b: a | b, (F.col(self.by).eqNullSafe(F.lit(v)) for v in touched)) if None in touched else F.col(self.by).isin(touched)
        after = make(self._read(before["partitions"]).filter(among)).filter(among)
        path = f"{self.root}/data/version={version}-{uuid.uuid4().hex[:8]}"
        after.select(*(F.col(f.name).cast(f.dataType) for f in self.schema)).hint("rebalance", F.col(self.by)).write.partitionBy(self.by).mode("errorifexists").parquet(path)
        written = [n for n in self.folder.names(path[len(self.root) + 1 :]) if n.startswith(f"{self.by}=")]
        gone = {f"{self.by}={v}" for v in touched}
        kept = {k: v for k, v in before["partitions"].items() if k not in written and k not in gone}
        made = {"version": version, "partitions": kept | {n: path.rpartition("version=")[2] for n in written}, "note": note, "schema": json.loads(self.schema.json())}
        if not self.folder.put(f"manifest/{version:012d}.json", json.dumps(made)):
            self.folder.delete(path[len(self.root) + 1 :])
            raise Conflict(f"version {version} of {self.root} was made meanwhile")
        return version

    def vacuum(self, keep: int = 1) -> int:
        """Deletes the manifests before the last `keep`, and files that no other needs; the number of deleted folders.
        Not to be run beside changes, whose files aren't in a manifest yet."""
        known = self.versions()
        needed = {(k, str(v)) for n in known[-keep:] for k, v in self.manifest(n)["partitions"].items()}
        gone = 0
        for n in known[:-keep]:
            self.folder.delete(f"manifest/{n:012d}.json")
        for folder in self.folder.names("data"):
            for part in self.folder.names(f"data/{folder}"):
                if part.startswith(f"{self.by}=") and (part, folder.removeprefix("version=")) not in needed:
                    self.folder.delete(f"data/{folder}/{part}")
                    gone += 1
        return gone
