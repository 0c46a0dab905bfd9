"""Valid repositories with all their activity, one wide row each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repovitals import fixed_values as fx
from repovitals.schemas import TABLES

#: No salted part of a name holds more than about 1 / (this x partitions) of a hub's rows.
PARTS_PER_PARTITION = 4


def contributors_agg(contributors: DataFrame, source: str = fx.SOURCE) -> DataFrame:
    """Contributors and recently active contributors per repository.

    Two plain groupings in place of two DISTINCT counts: rows are not multiplied, and a repository
    with very many contributors is spread over all tasks until it is down to one row per task.
    """
    per_pair = (
        contributors.filter(F.col("data_source") == source)
        .groupBy("repo_full_name", "contributor")
        .agg(F.max(F.col("recent_90_days_commits") > 0).alias("active"))
    )
    return per_pair.groupBy("repo_full_name").agg(
        F.count("contributor").alias("total_contributors"),
        F.count(F.when(F.col("active"), F.col("contributor"))).alias("active_contributors_90d"),
    )


def frequent_names(hub: DataFrame) -> DataFrame:
    """Rows (full_name, salts) of the names that hold more than their share of a hub, counted exactly.

    salts says into how many parts such a name is cut. Rows are counted per name in the map tasks
    first; fewer names than PARTS_PER_PARTITION x partitions can be over that share of all rows, so
    the list is bounded whatever the hub holds.
    """
    parts = PARTS_PER_PARTITION * int(hub.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = hub.groupBy("full_name").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    salts = F.ceil(F.col("n") * parts / total).cast("int")
    return counts.select("full_name", salts.alias("salts")).filter("salts > 1")


def _left_join_salted(left: DataFrame, hub: DataFrame, names: DataFrame) -> DataFrame:
    """`left` with all rows of `hub` of its name, or one row of NULLs; no name is left to one task.

    names: all names of `left`, each once. A frequent name's hub rows are dealt over its salts and its
    left rows copied to each; frequent names that are not among `names`, such as the placeholder of
    unnamed rows, are dropped before the shuffle. A salt that got no row gives no result: the name has
    rows in the hub, under another salt. Rows are dealt by their place in the stored hub, so equal rows
    are spread and a task run again deals alike.
    """
    known = F.broadcast(
        frequent_names(hub).join(names.withColumn("wanted", F.lit(True)).hint("merge"), "full_name", "left")
    )
    dealt = (
        hub.withColumn("place", F.monotonically_increasing_id())
        .join(known, "full_name", "left")
        .filter("salts is null or wanted")
        .withColumn("salt", F.coalesce(F.pmod(F.xxhash64("place"), F.col("salts")).cast("int"), F.lit(0)))
        .withColumn("met", F.lit(True))
        .drop("place", "salts", "wanted")
    )
    copied = left.join(known, "full_name", "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))
    )
    joined = copied.join(dealt.hint("merge"), ["full_name", "salt"], "left")
    return joined.filter("salts is null or met").drop("salt", "salts", "wanted", "met")


def with_defaults(joined: DataFrame) -> DataFrame:
    """Joined rows with the counters of absent activity."""
    counters = {
        **dict.fromkeys(
            (
                "commits_30d", "commits_90d", "commits_180d",
                "total_contributors", "active_contributors_90d",
                "open_issues", "closed_issues", "issues_last_90d", "release_count",
            ),
            0,
        ),
        "days_since_last_release": fx.NO_RELEASE_AGE_DAYS,
    }
    return joined.fillna(counters, subset=list(counters))


def enrich(
    stage: DataFrame,
    contributors: DataFrame,
    commits: DataFrame,
    issues: DataFrame,
    releases: DataFrame,
    as_of: Column,
    source: str = fx.SOURCE,
) -> DataFrame:
    """Join the valid staged rows with the four hubs; absent activity counts as none.

    Several hub rows of one repository give several output rows. Contributors come as one row per
    repository; each hub is read for its counts of names and for its rows, and joined with frequent
    names salted. Both sides of these joins grow with the input, and their files are small for their rows:
    the merge hint keeps Spark from sending one whole through the driver for the size of its files.
    """
    of_source = F.col("data_source") == source
    valid = stage.filter(of_source & F.col("valid_flag")).drop(
        "load_timestamp", "valid_flag", "invalid_reason"
    )

    def activity(hub: DataFrame) -> DataFrame:
        return (
            hub.filter(of_source)
            .drop("data_source", "load_timestamp")
            .withColumnRenamed("repo", "full_name")
        )

    people = contributors_agg(contributors, source).withColumnRenamed("repo_full_name", "full_name")
    hubs = [activity(hub) for hub in (commits, issues, releases)]

    names = valid.select("full_name").distinct()
    joined = valid.join(people.hint("merge"), "full_name", "left")
    for hub in hubs:
        joined = _left_join_salted(joined, hub, names)

    return with_defaults(joined).withColumn("enriched_at", as_of).select(*TABLES["repo_entryline"].schema.names)
