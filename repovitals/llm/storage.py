"""Tables that a job writes and reads again, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path
from zipfile import ZipFile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def workspace(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir.

    Where the setting is missing and Spark runs on this machine alone, as in tests, a folder is made
    for the session; on a cluster a missing setting is an error.
    """
    ship_package(spark)
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="repovitals-")
        spark.conf.set(CHECKPOINT_DIR, root)
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(frame: DataFrame, path: str) -> DataFrame:
    """Write a frame as Parquet and read it back: its lineage ends at the files."""
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application: their tasks import its functions."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = f"{tempfile.mkdtemp(prefix='repovitals-')}/{package.name}.zip"
    with ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)
