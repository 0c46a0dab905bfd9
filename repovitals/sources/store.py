"""Tables of all layers as parquet directories, one directory per layer and table."""

from __future__ import annotations

import re
import time
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repovitals.schemas import TABLES, conform

#: Rows that were only ever added. Later versions are numbered by time.
VERSION_0 = "0" * 20
#: How Spark names the folder of the NULL source.
NULL_SOURCE = "__HIVE_DEFAULT_PARTITION__"
#: Rows of a row group at most, which a task reads whole: rows that compress well would all be in one.
GROUP_ROWS = {"parquet.block.row.count.limit": 1_000_000}
SAFE_SOURCE = re.compile(r"[A-Za-z0-9_\-]+")


def shared_folder(spark: SparkSession) -> str:
    """A new folder for tables that belong to this session, in the folder that the cluster shares."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return f"{shared.rstrip('/')}/repovitals/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


class LayerStore:
    """Read and write the tables below one root folder, partitioned by data source.

    A source's rows lie in a version folder. Replacing them writes another one, which counts from the
    moment Spark has committed it (its _SUCCESS file); until then, and if the write fails, readers see
    the version before. That one is kept, older ones are removed.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, key: str) -> str:
        table = TABLES[key]
        return f"{self.root}/{table.layer.lower()}/{table.label.lower()}"

    def create_tables(self) -> None:
        """Make every table that does not exist yet, empty, so that all can be read."""
        for key, table in TABLES.items():
            empty = self.spark.range(0, numPartitions=1).select(
                *(F.lit(None).cast(c.dataType).alias(c.name) for c in table.schema.fields)
            )
            writer = empty.write.mode("ignore")
            if _by_source(key):
                writer = writer.partitionBy("data_source")
            writer.parquet(self.path(key))

    def _folders(self, parent: str, prefix: str) -> list[str]:
        """Names of the folders below `parent` that begin with `prefix`, in order."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(parent)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return []
        names = [status.getPath().getName() for status in files.listStatus(path) if status.isDirectory()]
        return sorted(name for name in names if name.startswith(prefix))

    def _committed(self, folder: str) -> list[str]:
        """The versions of a folder that readers may see, oldest first; VERSION_0 is not written at once."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        files = path(folder).getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [
            name
            for name in self._folders(folder, "version=")
            if name == f"version={VERSION_0}" or files.exists(path(f"{folder}/{name}/_SUCCESS"))
        ]

    def committed_versions(self, folder: str) -> list[int]:
        """Numbers of the versions of any folder that readers may see, in order."""
        return [int(name.removeprefix("version=")) for name in self._committed(folder)]

    def current_versions(self, key: str) -> dict[str | None, int]:
        """The version that readers see of each source of a table; NULL and '' are one."""
        found = {}
        for name in self._folders(self.path(key), "data_source="):
            versions, source = self.committed_versions(f"{self.path(key)}/{name}"), unquote(name.partition("=")[2])
            if versions:
                found[None if source == NULL_SOURCE else source] = versions[-1]
        return found

    def drop_versions(self, folder: str, upto: int) -> None:
        """Remove the versions of a folder up to a number."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        files = path(folder).getFileSystem(self.spark._jsc.hadoopConfiguration())
        for name in self._folders(folder, "version="):
            if int(name.removeprefix("version=")) <= upto:
                files.delete(path(f"{folder}/{name}"), True)

    def _current(self, folder: str) -> str:
        return (self._committed(folder) or [f"version={VERSION_0}"])[-1]

    def read(self, key: str) -> DataFrame:
        """A table with its contract's columns. A filter on data_source prunes directories.

        The schema is given, not inferred: a source named "1" stays text. NULL and '' sources
        share a directory and come back as NULL.
        """
        table, path = TABLES[key], self.path(key)
        reader = self.spark.read.schema(table.schema)
        groups = [f"{path}/{name}" for name in self._folders(path, "data_source=")] if _by_source(key) else [path]
        shown = [f"{group}/{self._committed(group)[-1]}" for group in groups if self._committed(group)]
        frame = reader.option("basePath", path).parquet(*shown) if shown else reader.parquet(path)
        return frame.select(*table.schema.names)

    def read_layers(self) -> dict[str, DataFrame]:
        """All tables but the run log."""
        return {key: self.read(key) for key in TABLES if key != "run_log"}

    def _write_version(self, folder: str, frame: DataFrame) -> None:
        """Write the next version of a folder and remove all but the one before it."""
        older = self._committed(folder)
        last = int(older[-1].removeprefix("version=")) if older else 0
        version = max(time.time_ns(), last + 1)
        frame.write.parquet(f"{folder}/version={version:0{len(VERSION_0)}d}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        files = path(folder).getFileSystem(self.spark._jsc.hadoopConfiguration())
        for name in older[:-1]:
            files.delete(path(f"{folder}/{name}"), True)

    def replace_sources(self, key: str, frame: DataFrame, whole_table: bool = False) -> None:
        """Make `frame` the whole content of each source it has rows of; with whole_table, of all others too.

        The rows are written in one job. The new versions count once it has succeeded, one source after
        the other; if it fails, or before, readers see the rows they saw.
        """
        path, jvm_path = self.path(key), self.spark._jvm.org.apache.hadoop.fs.Path
        groups = {name: self._committed(f"{path}/{name}") for name in self._folders(path, "data_source=")}
        newest = max((int(names[-1].removeprefix("version=")) for names in groups.values() if names), default=0)
        version = f"{max(time.time_ns(), newest + 1):0{len(VERSION_0)}d}"
        rows = frame.select(*TABLES[key].schema.names).withColumn("version", F.lit(version))
        rows.write.options(**GROUP_ROWS).mode("append").partitionBy("data_source", "version").parquet(path)
        files = jvm_path(path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        for name in self._folders(path, "data_source="):
            folder = f"{path}/{name}"
            if whole_table or files.exists(jvm_path(f"{folder}/version={version}")):
                files.create(jvm_path(f"{folder}/version={version}/_SUCCESS"), True).close()
                for old in groups.get(name, [])[:-1]:
                    files.delete(jvm_path(f"{folder}/{old}"), True)

    def replace(self, key: str, frame: DataFrame, source: str) -> None:
        """Make `frame` the whole content of one source; other sources stay. Nothing changes if it fails."""
        if not SAFE_SOURCE.fullmatch(source):
            raise ValueError(f"not usable as a directory name: {source!r}")
        columns = [name for name in TABLES[key].schema.names if name != "data_source"]
        self._write_version(f"{self.path(key)}/data_source={source}", frame.select(*columns))

    def compact(self, key: str) -> None:
        """Rewrite a table without sources, such as the run log, as one file."""
        if _by_source(key):
            raise ValueError(f"{key} is kept by source")
        self._write_version(self.path(key), self.read(key).coalesce(1))

    def append(self, key: str, frame: DataFrame) -> None:
        """Add rows, of whatever sources they are, to what readers see now."""
        rows, path = frame.select(*TABLES[key].schema.names), self.path(key)
        if not _by_source(key):
            rows.write.mode("append").parquet(f"{path}/{self._current(path)}")
            return
        version = F.lit(VERSION_0)
        for name in self._folders(path, "data_source="):
            current = self._current(f"{path}/{name}").removeprefix("version=")
            if current != VERSION_0:
                version = F.when(F.col("data_source") == name.removeprefix("data_source="), current).otherwise(version)
        rows.withColumn("version", version).write.options(**GROUP_ROWS).mode("append").partitionBy("data_source", "version").parquet(path)


def _by_source(key: str) -> bool:
    return "data_source" in TABLES[key].schema.names


def write_raw(
    store: LayerStore, key: str, frame: DataFrame, as_of: Column, mode: str = "append"
) -> None:
    """Write a raw table: absent columns get their defaults.

    `overwrite` replaces the sources that `frame` contains; `truncate` replaces the whole table. Text is
    kept whole: cut names would be one join key. `fit_columns` cuts where that is wanted, and
    `too_wide` counts what it would cut.
    """
    if mode not in ("append", "overwrite", "truncate"):
        raise ValueError(f"unknown mode: {mode!r}")
    fitted = conform(frame, TABLES[key], as_of)
    if mode == "append":
        store.append(key, fitted)
        return
    store.replace_sources(key, fitted, whole_table=mode == "truncate")
