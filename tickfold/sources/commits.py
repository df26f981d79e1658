"""Tables with a log of commits: what a job adds becomes visible at once or not at all.

Rows are staged as a folder of their own. A commit then adds one small entry to the log, by a
rename that fails if the entry exists; the entry names all folders that make up each table, and
a state (a read position, counts). So a job that dies before its entry leaves no row and no moved
position, and one that runs again finds the state of what is really there.

An entry stands for itself: a reader lists the log and opens the last entry. When a table has
many folders a commit puts one in their place, so neither entries nor folders grow with the
number of commits.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tickfold.functions import millis_of
from tickfold.schema import LOGGED_SCHEMAS

KEPT_ENTRIES = 20


class Conflict(RuntimeError):
    """Another writer has added the entry that was to come next."""


@dataclass(frozen=True)
class Snapshot:
    """What an entry says. Version 0 is the empty log."""

    version: int = 0
    folders: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    state: Mapping[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class CommitLog:
    """Tables with the given schemas below ``path``, a folder that all executors can reach."""

    path: str
    schemas: Mapping[str, StructType]
    fmt: str = "parquet"
    merge_above: int = 32  # folders of a table

    def latest(self, spark: SparkSession) -> Snapshot:
        fs, path = _files(spark, f"{self.path}/log")
        names = sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []
        names = [n for n in names if n.endswith(".json") and not n.startswith(".")]
        if not names:
            return Snapshot()
        stream = fs.open(_files(spark, f"{self.path}/log/{names[-1]}")[1])
        try:
            entry = json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()
        folders = {table: tuple(names) for table, names in entry["folders"].items()}
        return Snapshot(entry["version"], folders, entry["state"])

    def read(self, spark: SparkSession, table: str, at: Snapshot | None = None) -> DataFrame:
        """The rows of a table, of the last commit or of an earlier snapshot."""
        folders = (at or self.latest(spark)).folders.get(table, ())
        if not folders:
            return spark.createDataFrame([], self.schemas[table])
        paths = [f"{self.path}/data/{f}" for f in folders]
        return spark.read.format(self.fmt).schema(self.schemas[table]).load(paths)

    def stage(self, rows: DataFrame, split_by: str | None = None) -> str:
        """Write rows that nobody sees yet; with ``split_by`` a folder for each of its values,
        see ``part_of``."""
        name = f"staged-{uuid.uuid4().hex}"
        writer = rows.write.format(self.fmt)
        if split_by:
            writer = writer.partitionBy(split_by)
        writer.save(f"{self.path}/data/{name}")
        return name

    @staticmethod
    def part_of(folder: str, split_by: str, value: str) -> str:
        return f"{folder}/{split_by}={value}"

    def publish(
        self,
        spark: SparkSession,
        base: Snapshot,
        added: Mapping[str, str | None],
        state: Mapping[str, object],
        replaced: tuple[str, ...] = (),
    ) -> Snapshot:
        """The next entry: ``added`` names a staged folder for tables that grow, the tables in
        ``replaced`` begin anew. Raises ``Conflict`` unless ``base`` is still the last entry."""
        folders = {t: () if t in replaced else base.folders.get(t, ()) for t in self.schemas}
        for table, folder in added.items():
            if folder is not None:
                folders[table] += (folder,)
        for table, names in folders.items():
            if len(names) > self.merge_above:
                merged = self.read(spark, table, Snapshot(0, {table: names}))
                folders[table] = (self.stage(merged),)
        new = Snapshot(base.version + 1, folders, {**base.state, **state})
        self._add(spark, new)
        return new

    def append(self, rows: DataFrame, table: str, **state: object) -> Snapshot:
        """Rows and state in one commit."""
        spark = rows.sparkSession
        base = self.latest(spark)
        return self.publish(spark, base, {table: self.stage(rows)}, state)

    def vacuum(self, spark: SparkSession) -> int:
        """Remove folders that the last entry does not name: those of merged tables and of jobs
        that died. Only while no job writes, and no reader uses an older snapshot."""
        fs, path = _files(spark, f"{self.path}/data")
        names = self.latest(spark).folders.values()
        used = {folder.split("/")[0] for table in names for folder in table}
        gone = [s.getPath() for s in fs.listStatus(path)] if fs.exists(path) else []
        gone = [p for p in gone if p.getName() not in used]
        for p in gone:
            fs.delete(p, True)
        return len(gone)

    def _add(self, spark: SparkSession, new: Snapshot) -> None:
        jvm = spark.sparkContext._jvm
        entry = {"version": new.version, "folders": new.folders, "state": new.state}
        log = f"{self.path}/log"
        fs, temporary = _files(spark, f"{log}/.{uuid.uuid4().hex}")
        out = fs.create(temporary)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        target = _files(spark, f"{log}/{new.version:020d}.json")[1]
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
        strict = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(fs.makeQualified(temporary), fs.makeQualified(target), strict)
        except Py4JJavaError as error:
            fs.delete(temporary, False)
            if "AlreadyExists" in error.java_exception.getClass().getName():
                raise Conflict(f"version {new.version} of {self.path} exists") from error
            raise
        old = _files(spark, f"{log}/{new.version - KEPT_ENTRIES:020d}.json")[1]
        fs.delete(old, False)


def _files(spark: SparkSession, path: str):
    """Hadoop's file system and path."""
    context = spark.sparkContext
    found = context._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(context._jsc.hadoopConfiguration()), found


@dataclass(frozen=True)
class LoggedSink(CommitLog):
    """The sink of the page loop: ``records``, ``rejects`` (means that can't be written),
    ``bad_cells`` and ``held`` (means whose date has not come). The state has ``position``, the
    key after which the next page begins, and the number of rejects."""

    schemas: Mapping[str, StructType] = field(default_factory=lambda: LOGGED_SCHEMAS)

    def records(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, "records")

    def high_water_ms(self, spark: SparkSession) -> int | None:
        row = self.records(spark).agg({"date": "max"}).toDF("date")
        return row.select(millis_of("date").alias("hwm")).first()["hwm"]
