"""Stage and hubs as bucketed tables, so that enrich joins them without a shuffle.

The tables are bucketed and sorted by (full_name, salt) in one number of buckets; a join on both columns
then reads bucket beside bucket. The shuffle is paid once, when the tables are written, and not by each
run that reads them.

A name with more than its share of a hub's rows would be one bucket, so it gets several salts: the rows of
the hub where it has most are dealt over them, and its rows of the other tables are copied to each. A row of
that hub thus meets all its partners in its own bucket, and no pair twice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repovitals import fixed_values as fx
from repovitals.operators.enrich import PARTS_PER_PARTITION, contributors_agg, with_defaults
from repovitals.schemas import TABLES

#: The hubs of which a name may have several rows.
HUBS = ("hub_commits", "hub_issues", "hub_releases")
KEYS = ("full_name", "salt")


def salted_names(hubs: dict[str, DataFrame], buckets: int) -> DataFrame:
    """Rows (full_name, main, salts) of the names above their share of a hub: fewer than
    PARTS_PER_PARTITION x buckets of each hub. main is the hub with most rows of the name, which are dealt.
    """
    parts = PARTS_PER_PARTITION * buckets
    counted = []
    for key, hub in hubs.items():
        counts = hub.groupBy("full_name").agg(F.count(F.lit(1)).alias("n"))
        total = counts.agg(F.sum("n")).scalar()
        salts = F.ceil(F.col("n") * parts / total).cast("int")
        counted.append(counts.select("full_name", "n", salts.alias("salts"), F.lit(key).alias("hub")))
    of_name = reduce(DataFrame.unionByName, counted).groupBy("full_name")
    most = of_name.agg(F.max_by("hub", F.struct("n", "hub")).alias("main"), F.max("salts").alias("salts"))
    return most.filter("salts > 1")


def write_colocated(
    stage: DataFrame,
    contributors: DataFrame,
    commits: DataFrame,
    issues: DataFrame,
    releases: DataFrame,
    prefix: str,
    folder: str,
    buckets: int,
    source: str = fx.SOURCE,
) -> None:
    """Write the tables <prefix>_<key> of the catalog, with their files below `folder`."""
    of_source = F.col("data_source") == source
    valid = stage.filter(of_source & F.col("valid_flag")).drop("load_timestamp", "valid_flag", "invalid_reason")
    hubs = {
        key: hub.filter(of_source).drop("data_source", "load_timestamp").withColumnRenamed("repo", "full_name")
        for key, hub in zip(HUBS, (commits, issues, releases), strict=True)
    }
    names = valid.select("full_name").distinct().withColumn("wanted", F.lit(True)).hint("merge")
    salted = F.broadcast(salted_names(hubs, buckets).join(names, "full_name", "left"))

    def write(key: str, frame: DataFrame) -> None:
        # Dealt by the bucket columns, so that each bucket is one file.
        rows = frame.repartition(buckets, *KEYS).write.mode("overwrite").bucketBy(buckets, *KEYS).sortBy(*KEYS)
        rows.option("path", f"{folder}/{key}").saveAsTable(f"{prefix}_{key}")

    def copied(frame: DataFrame) -> DataFrame:
        known = frame.join(salted, "full_name", "left")
        return known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts", "wanted")

    write("stg_repositories", copied(valid))
    people = contributors_agg(contributors, source).withColumnRenamed("repo_full_name", "full_name")
    write("contributors", copied(people).drop("main"))
    for key, hub in hubs.items():
        # By their place in the stored hub, so that equal rows are spread and a task run again deals alike.
        # Frequent names that are not staged, such as the placeholder of unnamed rows, meet nothing.
        placed = hub.withColumn("place", F.monotonically_increasing_id()).join(salted, "full_name", "left")
        placed = placed.filter("salts is null or wanted")
        one = F.pmod(F.xxhash64("place"), F.col("salts")).cast("int")
        own = F.when(F.col("main").isNull(), F.array(F.lit(0))).when(F.col("main") == key, F.array(one))
        salts = own.otherwise(F.sequence(F.lit(0), F.col("salts") - 1))
        met = placed.withColumn("salt", F.explode(salts)).withColumn(f"met_{key}", F.lit(True))
        write(key, met.drop("place", "salts", "main", "wanted"))


def enrich_colocated(spark: SparkSession, prefix: str, as_of: Column) -> DataFrame:
    """`enrich` over tables of write_colocated: no shuffle between the scans and the result."""
    joined = spark.table(f"{prefix}_stg_repositories")
    for key in ("contributors", *HUBS):
        joined = joined.join(spark.table(f"{prefix}_{key}"), list(KEYS), "left")
    # A salt of a dealt hub may have got no row: the name has its rows under other salts.
    empty = [(F.col("main") == key) & F.col(f"met_{key}").isNull() for key in HUBS]
    hit = F.coalesce(reduce(Column.__or__, empty), F.lit(False))
    return with_defaults(joined.filter(F.col("main").isNull() | ~hit)).withColumn("enriched_at", as_of).select(
        *TABLES["repo_entryline"].schema.names
    )
