"""Refresh of what changed: new raw rows touch names, and only these are made anew.

The layers are kept by buckets of repository names, as partition folders. New raw rows are cleansed; the
names they carry are recomputed through stage, enrich and product; and the buckets these names fall in
are rewritten, with the rows of other names as they were. What is read and written are those buckets and
the new files, so a small arrival costs its share of the tables, whatever their size.

A staged row is the latest of all raw rows of its name, so the latest of the staged row and the new ones
takes its place, valid or not, and a name whose row stays as it is counts as touched by its hubs only; a name whose latest row is not valid leaves enrich and product. Hub rows
are only added. A row without times has those of the load that brought it.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repovitals import fixed_values as fx
from repovitals.functions.times import now_utc, ntz
from repovitals.operators.enrich import enrich
from repovitals.operators.hubs import hub_commits, hub_contributors, hub_issues, hub_releases
from repovitals.operators.risk import risk_product
from repovitals.operators.stage import cleanse_repositories, is_later, latest_per_name
from repovitals.schemas import RAW_TABLES, TABLES
from repovitals.sources.store import LayerStore
from repovitals.streaming.run_log import entry, log_entries

#: Hubs: raw table, job, and the column that names the repository.
HUBS = {
    "hub_contributors": ("raw_contributors", hub_contributors, "repo_full_name"),
    "hub_commits": ("raw_commits", hub_commits, "repo"),
    "hub_issues": ("raw_issues", hub_issues, "repo"),
    "hub_releases": ("raw_releases", hub_releases, "repo"),
}
#: Tables of one row, or some rows, per name that are made anew.
BY_NAME = ("stg_repositories", "repo_entryline", "risk_product")
#: So many buckets are touched at most; a small arrival touches as many as it has names.
BUCKETS = 256


def merge_latest(staged: DataFrame, cleansed: DataFrame) -> DataFrame:
    """Of each name that `cleansed` carries, the row the staged table, of one row per name, is to have, and its kind.

    Each side is shuffled and sorted once: the new rows of a name are cut to their latest before they meet
    the staged one, so a join compares two rows a name. The staged row stays if both tie.
    """
    columns = TABLES["stg_repositories"].schema.names
    rest = [c for c in columns if c != "full_name"]
    before = staged.select("full_name", F.struct(*rest).alias("before"))
    both = latest_per_name(cleansed.select(*columns)).join(before.hint("merge"), "full_name", "left")
    new, later = F.col("before").isNull(), is_later(columns, "before")
    kind = F.when(new, "new").when(later, "changed").otherwise("unchanged")
    kept = (F.when(new | later, F.col(c)).otherwise(F.col(f"before.{c}")).alias(c) for c in rest)
    return both.select("full_name", *kept, kind.alias("kind"))


class DeltaLayers:
    """Stage, hubs, enrich and product of one source, by buckets of names, below a folder of a store."""

    def __init__(self, store: LayerStore, source: str = fx.SOURCE, buckets: int = BUCKETS, name: str = "delta"):
        self.store, self.spark, self.source, self.buckets = store, store.spark, source, buckets
        self.root = f"{store.root}/{name}/{source}"
        self.checkpoint = f"{self.root}/checkpoint"
        for key in (*BY_NAME, *HUBS):
            folders = ("bucket", "load") if key in HUBS else ("bucket",)
            self._empty(key).write.mode("ignore").partitionBy(*folders).parquet(self.path(key))

    def path(self, key: str) -> str:
        return f"{self.root}/{key}"

    def _schema(self, key: str) -> str:
        extra = "bucket int, load bigint" if key in HUBS else "bucket int"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in TABLES[key].schema.fields)
        return f"{columns}, {extra}"

    def _empty(self, key: str) -> DataFrame:
        return self.spark.createDataFrame([], self._schema(key))

    def _bucket(self, name: str) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(self.buckets)).cast("int")

    def _read(self, key: str, buckets: list[int] | None = None) -> DataFrame:
        rows = self.spark.read.schema(self._schema(key)).parquet(self.path(key))
        return rows if buckets is None else rows.filter(F.col("bucket").isin(buckets))

    def read(self, key: str) -> DataFrame:
        """A table as a refresh of everything would make it."""
        return self._read(key).select(*TABLES[key].schema.names)

    def _replace(self, key: str, rows: DataFrame, buckets: list[int], load: int) -> None:
        """Make `rows` the content of these buckets: written aside first, as they are made of them."""
        aside = f"{self.root}/aside/load={load}/{key}"
        rows.withColumn("bucket", self._bucket("full_name")).hint("rebalance", "bucket").write.mode("overwrite").partitionBy(
            "bucket"
        ).parquet(aside)
        written = self.spark.read.schema(self._schema(key)).parquet(aside)
        written.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.path(key))
        # A bucket that is left without rows has no file to be replaced by.
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        files = path(aside).getFileSystem(self.spark._jsc.hadoopConfiguration())
        for bucket in buckets:
            if not files.exists(path(f"{aside}/bucket={bucket}")):
                files.delete(path(f"{self.path(key)}/bucket={bucket}"), True)
        files.delete(path(aside), True)

    def upsert_stage(self, cleansed: DataFrame, load: int) -> DataFrame:
        """Take new cleansed rows into the staged table; returns, of each name they carry, the row it now has and
        its kind: new, changed or unchanged (but for its load time).

        Only the buckets of new and changed rows are rewritten. What a load changed is decided once: the same load
        tried again, after the table was written, would find nothing changed and leave out what comes after.
        """
        path, columns = f"{self.root}/upserts/load={load}", TABLES["stg_repositories"].schema.names
        schema = f"{self._schema('stg_repositories')}, kind string"
        done = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        if not done.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(done):
            bucket = self._bucket("full_name").alias("bucket")
            buckets = [row.bucket for row in cleansed.select(bucket).distinct().collect()]
            sorted_out = merge_latest(self._read("stg_repositories", buckets), cleansed)
            sorted_out.select(*columns, bucket, "kind").write.mode("overwrite").parquet(path)
        upserts = self.spark.read.schema(schema).parquet(path)
        changed = upserts.filter("kind <> 'unchanged'")
        buckets = [row.bucket for row in changed.select("bucket").distinct().collect()]
        if buckets:
            others = self._read("stg_repositories", buckets).select(*columns).join(changed.select("full_name").hint("merge"), "full_name", "left_anti")
            self._replace("stg_repositories", others.select(*columns).unionByName(changed.select(*columns)), buckets, load)
        return upserts

    def apply(self, news: dict[str, DataFrame], load: int, as_of: Column) -> None:
        """Take the new raw rows of one load, by raw table. The same load may be applied again: rows of
        hubs are kept by load, and what it changed in the staged table is kept too.
        """
        cleansed = cleanse_repositories(news["raw_repositories"], as_of, self.source)
        added = {key: job(news[raw], as_of, self.source) for key, (raw, job, _) in HUBS.items()}
        for key, rows in added.items():
            dealt = rows.withColumn("bucket", self._bucket(HUBS[key][2])).withColumn("load", F.lit(load).cast("bigint"))
            dealt.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                "bucket", "load"
            ).parquet(self.path(key))
        changed = self.upsert_stage(cleansed, load).filter("kind <> 'unchanged'").select("full_name")
        names = [changed, *(rows.select(F.col(HUBS[key][2]).alias("full_name")) for key, rows in added.items())]
        path = f"{self.root}/touched/load={load}"
        reduce(DataFrame.unionByName, names).distinct().write.mode("overwrite").parquet(path)
        touched = self.spark.read.schema("full_name string").parquet(path)
        buckets = [row.bucket for row in touched.select(self._bucket("full_name").alias("bucket")).distinct().collect()]
        if not buckets:
            return

        def of_touched(key: str, name: str = "full_name") -> DataFrame:
            rows = self._read(key, buckets).select(*TABLES[key].schema.names)
            return rows.join(touched.withColumnRenamed("full_name", name).hint("merge"), name, "left_semi").select(*rows.columns)

        def others(key: str) -> DataFrame:
            rows = self._read(key, buckets).select(*TABLES[key].schema.names)
            return rows.join(touched.hint("merge"), "full_name", "left_anti").select(*rows.columns)

        hubs = [of_touched(key, name) for key, (_, _, name) in HUBS.items()]
        enriched = enrich(of_touched("stg_repositories"), *hubs, as_of, self.source)
        self._replace("repo_entryline", others("repo_entryline").unionByName(enriched), buckets, load)
        product = risk_product(of_touched("repo_entryline"), as_of, self.source)
        self._replace("risk_product", others("risk_product").unionByName(product), buckets, load)


def _news(store: LayerStore) -> DataFrame:
    """New rows of all raw tables as one stream: the table's name, and its row in the column of that name."""
    streams = []
    for key in RAW_TABLES:
        rows = store.spark.readStream.schema(TABLES[key].schema).parquet(store.path(key))
        streams.append(rows.select(F.lit(key).alias("table"), F.struct(*TABLES[key].schema.names).alias(key)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), streams)


def refresh_changed(layers: DeltaLayers, as_of: datetime | str | None = None) -> int:
    """Take what arrived in any raw table since the last call; returns in how many loads (0: nothing new).

    Raw tables must only be added to: a table that was replaced is new as a whole, and its old rows stay.
    A load is named by the stream's batch and logged like a refresh. One that fails is tried again, as the
    same load, by the next call.
    """
    store, loads = layers.store, []

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        run = (batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"), batch_id)
        log_entries(store, [entry(run, layers.source, fx.STAGE_RUN, fx.STATUS_STARTED, fx.MESSAGE_STARTED)])
        try:
            # Written once: the batch is asked for each table.
            path = f"{layers.root}/news/load={batch_id}"
            batch.write.mode("overwrite").partitionBy("table").parquet(path)
            kept = batch.sparkSession.read.schema(batch.schema).parquet(path)
            news = {key: kept.filter(F.col("table") == key).select(f"{key}.*") for key in RAW_TABLES}
            layers.apply(news, batch_id, ntz(as_of or now_utc()))
        except Exception as error:
            message = f"{fx.MESSAGE_ERROR_PREFIX}{error}"
            log_entries(store, [entry(run, layers.source, fx.STAGE_RUN, fx.STATUS_ERROR, message)])
            raise
        log_entries(store, [entry(run, layers.source, fx.STAGE_RUN, fx.STATUS_COMPLETED, fx.MESSAGE_COMPLETED)])
        loads.append(batch_id)

    writer = _news(store).writeStream.foreachBatch(on_batch).option("checkpointLocation", layers.checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
    return len(loads)
