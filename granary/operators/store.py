"""A snapshot table store over Parquet: atomic commits, partition overwrite, merge, time travel, rollback.

A table is a folder.  ``data/<uuid>`` folders are written once and never changed; ``_log/<version>.json`` lists the
data folders that are live in a version.  A commit writes its data first, then the whole log entry under a name of its own, and then moves that
to the next version's name, which must not be there: readers see an entry whole or not at all, of two writers one fails, and a job that dies before that leaves nothing but unlisted files.  Data reaches and leaves the
store through Spark's readers and writers only; the log goes through Hadoop's file system, so a table can lie wherever Spark can write.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .cdc import merge


class CommitConflict(RuntimeError):
    """Another writer committed first."""


class Table:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm
        self._fs = self._jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # the log
    def _at(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def versions(self) -> list[int]:
        log = self._at("_log")
        if not self._fs.exists(log):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(log)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("_"))

    def _entry(self, version: int) -> dict:
        stream = self._fs.open(self._at("_log", f"{version:020d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _commit(self, operation: str, schema: str, partition_by: list[str], live: list[dict], parent: int | None, batch: str | None) -> int:
        version = 0 if parent is None else parent + 1
        entry = {"version": version, "parent": parent, "committed_at": time.time(), "operation": operation, "schema": schema, "partition_by": partition_by, "live": live, "batch_id": batch}
        log, draft = self._at("_log", f"{version:020d}.json"), self._at("_log", f"_{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        stream.write(bytearray(json.dumps(entry).encode()))
        stream.close()
        fs = self._jvm.org.apache.hadoop.fs
        files = fs.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            files.rename(self._fs.makeQualified(draft), self._fs.makeQualified(log), self.spark.sparkContext._gateway.new_array(fs.Options.Rename, 0))
        except Exception as e:
            self._fs.delete(draft, False)
            raise CommitConflict(f"version {version} of {self.path} is there already") from e
        return version

    def _current(self) -> dict | None:
        found = self.versions()
        return self._entry(found[-1]) if found else None

    @property
    def exists(self) -> bool:
        return bool(self.versions())

    # writing
    def _write(self, df: DataFrame, partition_by: list[str]) -> list[dict]:
        """New data folders, one for each partition value: the value as JSON text names it in the log."""
        folder = f"data/{uuid.uuid4().hex}"
        if not partition_by:
            df.write.parquet(f"{self.path}/{folder}")
            return [{"folder": folder, "values": None}]
        # the partition columns stay inside the files; a copy names the folders
        marked = df.withColumn("_p", F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in partition_by])))
        marked.write.partitionBy("_p").parquet(f"{self.path}/{folder}")
        out = []
        if self._fs.exists(self._at(folder)):
            for f in self._fs.listStatus(self._at(folder)):
                name = f.getPath().getName()
                if name.startswith("_p="):
                    value = self._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(name[3:])
                    out.append({"folder": f"{folder}/{name}", "values": json.loads(value)})
        return out

    def create(self, df: DataFrame, partition_by: list[str] | None = None, batch: str | None = None) -> int:
        return self._commit("create", df.schema.json(), partition_by or [], self._write(df, partition_by or []), None, batch)

    def ensure(self, schema: str, partition_by: list[str] | None = None) -> None:
        if not self.exists:
            empty = self.spark.createDataFrame([], schema)
            self._commit("create", empty.schema.json(), partition_by or [], [], None, None)

    def append(self, df: DataFrame, batch: str | None = None) -> int:
        now = self._current()
        if now is None:
            return self.create(df, batch=batch)
        return self._commit("append", now["schema"], now["partition_by"], now["live"] + self._write(self._shaped(df, now), now["partition_by"]), now["version"], batch)

    def overwrite(self, df: DataFrame, batch: str | None = None) -> int:
        """All rows replaced, history kept."""
        now = self._current()
        return self.create(df, batch=batch) if now is None else self._commit("overwrite", now["schema"], now["partition_by"], self._write(self._shaped(df, now), now["partition_by"]), now["version"], batch)

    def replace(self, df: DataFrame, partition_by: list[str] | None = None, batch: str | None = None) -> int:
        """A new schema and partitioning from here on; older versions stay readable."""
        now = self._current()
        return self._commit("replace", df.schema.json(), partition_by or [], self._write(df, partition_by or []), now["version"] if now else None, batch)

    def overwrite_partitions(self, df: DataFrame, batch: str | None = None) -> int:
        """Exactly the partitions that df has rows of are replaced; without rows nothing changes."""
        now = self._current()
        new = self._write(self._shaped(df, now), now["partition_by"])
        gone = [x["values"] for x in new]
        return self._commit("overwrite_partitions", now["schema"], now["partition_by"], [x for x in now["live"] if x["values"] not in gone] + new, now["version"], batch)

    def replace_partitions(self, values: dict, df: DataFrame, batch: str | None = None) -> int:
        """What stands in the partitions of these values goes and df's rows come, if it has any, in one commit."""
        now = self._current()
        new = self._write(self._shaped(df, now), now["partition_by"])
        gone = [x["values"] for x in new]
        stays = lambda x: x["values"] not in gone and not all((x["values"] or {}).get(k) == str(v) for k, v in values.items())
        return self._commit("replace_partitions", now["schema"], now["partition_by"], [x for x in now["live"] if stays(x)] + new, now["version"], batch)

    def delete(self, where: str, batch: str | None = None) -> int:
        """Rows that the condition holds for go; only folders that have such rows are written anew."""
        now, live = self._current(), []
        for x in now["live"]:
            rows = self._read(now, [x])
            if rows.where(where).limit(1).count():
                live += self._write(rows.where(f"NOT coalesce(({where}), false)"), now["partition_by"])
            else:
                live.append(x)
        return self._commit("delete", now["schema"], now["partition_by"], live, now["version"], batch)

    def replace_rows(self, where: str, df: DataFrame, batch: str | None = None) -> int:
        self.delete(where, batch)
        return self.append(df, batch)

    def merge(self, source: DataFrame, keys: list[str], batch: str | None = None) -> int:
        now = self._current()
        return self._commit("merge", now["schema"], now["partition_by"], self._write(self._shaped(merge(self.read(), source, keys), now), now["partition_by"]), now["version"], batch)

    def rollback(self, version: int) -> int:
        now, old = self._current(), self._entry(version)
        return self._commit("rollback", old["schema"], old["partition_by"], old["live"], now["version"], None)

    # reading
    def _schema(self, entry: dict):
        from pyspark.sql.types import StructType

        return StructType.fromJson(json.loads(entry["schema"]))

    def _shaped(self, df: DataFrame, entry: dict) -> DataFrame:
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self._schema(entry).fields])

    def _read(self, entry: dict, live: list[dict]) -> DataFrame:
        schema = self._schema(entry)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{x['folder']}" for x in live]) if live else self.spark.createDataFrame([], schema)

    def _found(self, version: int | None, timestamp: float | None, batch: str | None) -> dict | None:
        """The newest entry that is wanted; no more of the log is read than it takes to find it."""
        for v in reversed(self.versions()):
            if version is not None and v != version:
                continue
            entry = self._entry(v)
            if (timestamp is None or entry["committed_at"] <= timestamp) and (batch is None or (entry["batch_id"] is not None and entry["batch_id"] <= batch)):
                return entry
        return None

    def partition_values(self, column: str) -> list[str]:
        """The values of a partition column that have rows now, in order, from the log alone."""
        now = self._current()
        return sorted({x["values"][column] for x in now["live"] if x["values"] and x["values"].get(column) is not None}) if now else []

    def read(self, version: int | None = None, timestamp: float | None = None, batch: str | None = None, partitions: dict | None = None, between: tuple[str, str, str] | None = None) -> DataFrame | None:
        """The table now, at a version, at a time, or at the newest version of a batch up to ``batch``; None if there is none.

        ``partitions`` (values) and ``between`` (a column, its first and last value as text) prune in the log, before Spark plans.
        """
        found = self._found(version, timestamp, batch)
        if found is None:
            return None
        live = found["live"]
        if partitions:
            live = [x for x in live if all((x["values"] or {}).get(k) == str(v) for k, v in partitions.items())]
        if between:
            column, low, high = between
            live = [x for x in live if low <= ((x["values"] or {}).get(column) or "") <= high]
        return self._read(found, live)

    def history(self) -> DataFrame:
        rows = [(e["version"], e["parent"], e["committed_at"], e["operation"], e["batch_id"], len(e["live"])) for e in map(self._entry, self.versions())]
        return self.spark.createDataFrame(rows, "version long, parent long, committed_at double, operation string, batch_id string, folders int")


def difference(before: DataFrame, after: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows whose columns differ between two versions, old and new side by side."""
    b, a = before.alias("b"), after.alias("a")
    joined = b.join(a, [F.col(f"b.{k}") == F.col(f"a.{k}") for k in keys])
    changed = None
    for c in columns:
        one = ~F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}"))
        changed = one if changed is None else changed | one
    return joined.where(changed).select(*[F.col(f"a.{k}").alias(k) for k in keys], *[F.col(f"b.{c}").alias(f"old_{c}") for c in columns], *[F.col(f"a.{c}").alias(f"new_{c}") for c in columns])
