"""The status report from states kept with each load, without reading the tables.

The files of every table are a stream, as all loads write files: appended rows, a source's next snapshot,
a replaced raw table. A batch of new files is reduced to one row of figures per source and snapshot, and to
the distinct values that the counts of distinct names need. Figures merge exactly: totals and row
counts are added, spans are widened, and an average is divided only when it is asked for. A source counts with the
states of the snapshot that readers see now; those of earlier ones are left out, and go when states are folded.

What a report reads grows with loads and sources, not with rows. Counts of distinct names read the names.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from repovitals.functions.numbers import mean_of
from repovitals.plans.monitoring import MEASURE_TYPES, MEASURES, REPORTED, profile_rows, report_of, stats_of
from repovitals.schemas import TABLES
from repovitals.sources.store import LayerStore
from repovitals.streaming.kept_states import KeptStates

#: The part that holds the figures; every other part holds the distinct values of one measure.
FIGURES = "figures"
_KEYS = ("part", "data_source", "snapshot", "value")


class TableStates(KeptStates):
    """States of one table. A NULL or '' source is NULL, as in the table itself."""

    partition_by = ("part",)

    def __init__(self, store: LayerStore, key: str, name: str = "status"):
        super().__init__(store, f"{name}/{key}")
        self.key = key
        self.distinct = [name for name, measure in MEASURES[key].items() if measure.how == "distinct"]
        #: Columns of a state: how rows make them, how states merge, and their type.
        self.figures: dict[str, tuple[str, str, str]] = {"record_count": ("count(1)", "sum", "bigint")}
        for name, measure in MEASURES[key].items():
            if measure.how == "mean":
                self.figures[f"{name}_total"] = (f"sum({name})", "sum", "double")
                self.figures[f"{name}_rows"] = (f"count({name})", "sum", "bigint")
            elif measure.how in ("min", "max"):
                self.figures[name] = (f"{measure.how}({name})", measure.how, MEASURE_TYPES[name])
            elif measure.how != "distinct":
                self.figures[name] = (f"{measure.how}({name})", "sum", "bigint")

    def schema(self) -> str:
        columns = (f"{name} {kind}" for name, (_, _, kind) in self.figures.items())
        return f"data_source string, snapshot bigint, value string, {', '.join(columns)}, part string"

    def stream(self, landed: str) -> DataFrame:
        # A file of a snapshot that was replaced and removed before it was read does not matter any more.
        schema = StructType([*TABLES[self.key].schema.fields, StructField("version", LongType())])
        rows = self.spark.readStream.schema(schema).option("ignoreMissingFiles", True).parquet(landed)
        return rows.selectExpr(
            "nullif(data_source, '') as data_source",
            "version as snapshot",
            *(f"{measure.of} as {name}" for name, measure in MEASURES[self.key].items()),
        )

    def reduced(self, batch: DataFrame) -> DataFrame:
        made = [F.expr(f"cast({text} as {kind}) as {name}") for name, (text, _, kind) in self.figures.items()]
        parts = [batch.groupBy("data_source", "snapshot").agg(*made).withColumn("part", F.lit(FIGURES))]
        for name in self.distinct:
            values = batch.filter(F.col(name).isNotNull()).select("data_source", "snapshot", F.col(name).alias("value"))
            parts.append(values.distinct().withColumn("part", F.lit(name)))
        return self.merged(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts))

    def merged(self, states: DataFrame) -> DataFrame:
        states = states if "value" in states.columns else states.withColumn("value", F.lit(None).cast("string"))
        merged = states.groupBy(*_KEYS).agg(
            *(F.expr(f"{how}({name}) as {name}") for name, (_, how, _) in self.figures.items())
        )
        return merged.select("data_source", "snapshot", "value", *self.figures, "part")

    def _beside_current(self, states: DataFrame) -> DataFrame:
        """With the snapshot that readers see of the source; the sources are as few as folders of the table."""
        seen = [F.lit(item) for source, version in self.store.current_versions(self.key).items() for item in (source or "", version)]
        current = F.create_map(*seen)[F.coalesce("data_source", F.lit(""))] if seen else F.lit(None)
        return states.withColumn("current", current.cast("bigint"))

    def lasting(self, states: DataFrame) -> DataFrame:
        # A snapshot that is newer than the one seen may be about to be committed.
        return self._beside_current(states).filter("current is null or snapshot >= current").drop("current")

    def measured(self, distinct: bool) -> DataFrame:
        """The measures per source, of what readers see now."""
        states = self.states()
        if not distinct:
            states = states.filter(F.col("part") == FIGURES)
        shown = self._beside_current(states).filter("snapshot = current")
        columns = ["max(record_count) as record_count"]
        for name, measure in MEASURES[self.key].items():
            if measure.how == "mean":
                columns.append(f"{mean_of(f'max({name}_total)', f'max({name}_rows)')} as {name}")
            elif measure.how == "distinct":
                columns.append(f"count_if(part = '{name}') as {name}" if distinct else f"cast(null as bigint) as {name}")
            else:  # one row of figures a source; the rows of values have none
                columns.append(f"max({name}) as {name}")
        return shown.groupBy("data_source").agg(*map(F.expr, columns))


class StatusStates:
    """States of all tables of a store. They know the loads up to the last call of `absorb`."""

    def __init__(self, store: LayerStore, name: str = "status"):
        self.store = store
        self.tables = {key: TableStates(store, key, name) for key in REPORTED}

    def absorb(self, keys: Iterable[str] = REPORTED) -> int:
        """Take the files that loads have written since the last call, of all tables or of those a load wrote to;
        returns how many tables had some.

        A call that fails is completed by the next one; no file is taken twice.
        """
        self.store.create_tables()
        with ThreadPoolExecutor(len(self.tables)) as pool:
            taken = [pool.submit(self.tables[key].absorb, self.store.path(key)) for key in keys]
            return sum(task.result() > 0 for task in taken)

    def profile(self, keys: Iterable[str] = REPORTED, distinct: bool = False) -> DataFrame:
        """What `table_profile` gives; counts of distinct names are NULL unless asked for."""
        return reduce(DataFrame.union, (profile_rows(key, self.tables[key].measured(distinct)) for key in keys))

    def pipeline_status(self, sections: Iterable[str] | None = None) -> DataFrame:
        """What `pipeline_status` gives, or some of its sections."""
        return report_of(self.profile, sections)

    def table_stats(self) -> DataFrame:
        """What `status_table_stats` gives."""
        return stats_of(self.profile(distinct=True))
