"""Tables that are published whole.

A table is a folder with immutable batches and small manifests:

    <table>/data/_batch=<id>/...        parquet, partitioned as asked
    <table>/_manifest/00000003.json     the batches of version 3

Writers add a batch, check it, and publish by moving a finished manifest to
the next free number; readers take the highest manifest.  Until that move no
reader sees anything of the batch, so a write that dies, or whose rows fail
validation, leaves the last version as it was.  An append lists the earlier
batches and its own, without copying rows.  Two writers that race for one
number cannot both get it: the second one publishes on top of the first.

The driver only handles manifests (names and counts); rows are written and
counted by the tasks.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Validate = Callable[[DataFrame], object]


@dataclass(frozen=True)
class Version:
    number: int
    batches: tuple[str, ...]
    rows: int
    schema: str
    partition_by: tuple[str, ...]


class ConcurrentWrite(RuntimeError):
    """Another writer published between a read and the publish based on it."""


class _Files:
    """The few file calls a manifest needs, through Spark's own file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        p = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.fs.create(self.path(name), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def move_new(self, source: str, target: str) -> bool:
        """Rename that never replaces; False where ``target`` exists."""
        from py4j.protocol import Py4JJavaError

        fs = self.jvm.org.apache.hadoop.fs
        kind = getattr(fs, "Options$Rename")
        how = self.jvm.java.lang.reflect.Array.newInstance(kind.NONE.getClass(), 1)
        how[0] = kind.NONE
        try:
            fs.FileContext.getFileContext(self.path(target).toUri(), self.conf).rename(self.path(source), self.path(target), how)
        except Py4JJavaError as exc:
            if "FileAlreadyExists" in exc.java_exception.toString():
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.files = spark, path.rstrip("/"), _Files(spark, path)

    # reading ----------------------------------------------------------------
    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self.files.names(f"{self.path}/_manifest") if n.endswith(".json")]

    def version(self, number: int | None = None) -> Version | None:
        """The given version, or the latest (None if nothing was published)."""
        have = self.versions()
        if number is None:
            if not have:
                return None
            number = have[-1]
        elif number not in have:
            raise ValueError(f"{self.path} has no version {number}")
        m = json.loads(self.files.read(f"{self.path}/_manifest/{number:08d}.json"))
        return Version(number, tuple(m["batches"]), m["rows"], m["schema"], tuple(m["partition_by"]))

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of a version; partition filters prune in every batch."""
        v = self.version(number)
        if v is None:
            raise ValueError(f"nothing was published at {self.path}")
        return self._batches(v, v.batches)

    def _batches(self, v: Version, batches: tuple[str, ...]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(v.schema))
        if not batches:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/data/_batch={b}" for b in batches]
        # every batch has the columns of the table, its partition columns last
        stored = T.StructType([*schema.fields, T.StructField("_batch", T.StringType())])
        return self.spark.read.schema(stored).option("basePath", f"{self.path}/data").parquet(*paths).select(*[f"`{c}`" for c in schema.names])

    # writing ----------------------------------------------------------------
    def publish(self, df: DataFrame, mode: str = "overwrite", partition_by: list[str] | None = None,
                validate: Validate | None = None, on_version: int | None = None) -> Version:
        """Write ``df`` as a batch, check it and make it the next version
        (``overwrite``) or part of it (``append``).  ``validate`` reads the
        written batch and raises where it must not be published.  With
        ``on_version`` (0: none yet) the batch is only published on top of
        that version, else ``ConcurrentWrite`` is raised."""
        if "_batch" in df.columns:
            raise ValueError("_batch names the folders of a table")
        if mode not in ("overwrite", "append"):
            raise ValueError("mode must be 'overwrite' or 'append'")
        before = self.version()
        if mode == "append" and before is not None:
            if partition_by is not None and tuple(partition_by) != before.partition_by:
                raise ValueError(f"{self.path} is partitioned by {before.partition_by}")
            partition_by = list(before.partition_by)
            names = T.StructType.fromJson(json.loads(before.schema)).names
            if set(names) != set(df.columns):
                raise ValueError(f"columns {df.columns} are not those of {self.path}: {names}")
            df = df.select(*[f"`{c}`" for c in names])
        batch = uuid.uuid4().hex[:16]
        folder = f"{self.path}/data/_batch={batch}"
        seen = Observation(f"rows_{batch}")
        writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
        rows = int(seen.get["rows"])
        mine = Version(0, (batch,), rows, df.schema.json(), tuple(partition_by or ()))
        try:
            written = self._batches(mine, (batch,))
            if (stored := written.count()) != rows:
                raise RuntimeError(f"row count mismatch for {folder}: wrote {rows}, stored {stored}")
            if validate is not None:
                validate(written)
            return self._commit(mine, mode, on_version)
        except Exception:
            self.files.delete(folder)
            raise

    def _commit(self, mine: Version, mode: str, on_version: int | None) -> Version:
        draft = f"{self.path}/_manifest/.{mine.batches[0]}"
        while True:
            last = self.version()
            if on_version is not None and (last.number if last else 0) != on_version:
                raise ConcurrentWrite(f"{self.path} is no longer at version {on_version}")
            base = last if mode == "append" and last is not None else None
            new = Version(
                (last.number if last else 0) + 1, (base.batches if base else ()) + mine.batches,
                (base.rows if base else 0) + mine.rows, base.schema if base else mine.schema, mine.partition_by)
            self.files.write(draft, json.dumps({
                "batches": new.batches, "rows": new.rows, "schema": new.schema, "partition_by": new.partition_by}))
            if self.files.move_new(draft, f"{self.path}/_manifest/{new.number:08d}.json"):
                return new
            self.files.delete(draft)  # another writer was first: go on top of it

    def expire(self, keep: int = 2) -> list[str]:
        """Forget all but the last ``keep`` versions and delete the batches
        that only they used; batches never published are left alone, since
        their writer may still be at work."""
        numbers = self.versions()
        gone = [self.version(n) for n in numbers[:-keep]] if keep > 0 else []
        live = {b for n in numbers[-keep:] for b in self.version(n).batches}
        dead = sorted({b for v in gone for b in v.batches} - live)
        for v in gone:
            self.files.delete(f"{self.path}/_manifest/{v.number:08d}.json")
        for b in dead:
            self.files.delete(f"{self.path}/data/_batch={b}")
        return dead
