import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from repovitals.functions.times import ntz  # noqa: E402
from repovitals.schemas import TABLES  # noqa: E402
from repovitals.sources.store import LayerStore  # noqa: E402

NOW = datetime(2020, 6, 15, 12, 0, 0)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("repovitals tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "America/New_York")  # results must not depend on it
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def as_of(spark):
    return ntz(NOW)


@pytest.fixture(scope="session")
def frame(spark):
    """Rows of a table given as dicts; columns left out are NULL, the source is git_hub."""

    def make(key, rows):
        schema = TABLES[key].schema
        full = [{"data_source": "git_hub", **row} for row in rows]
        return spark.createDataFrame(
            [tuple(row.get(name) for name in schema.names) for row in full], schema
        )

    return make


@pytest.fixture
def store(spark, tmp_path):
    return LayerStore(spark, str(tmp_path / "store"))


def rows(df, *columns):
    """Rows as sorted tuples."""
    got = [tuple(row) for row in (df.select(*columns) if columns else df).collect()]
    return sorted(got, key=lambda row: tuple((v is not None, str(v)) for v in row))
