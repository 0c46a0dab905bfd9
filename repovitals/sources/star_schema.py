"""Raw tables, event lines and search pages derived from a star schema of parts and orders.

A part stands for a repository, a supplier of its line items for a contributor, quantity shipped in
the trailing days for commits, order status for issues and returned lines for releases. Planted
defects (blanks, NULLs, negative and excessive counters, padded duplicates) exercise the cleansing;
they follow from the keys, so another engine can derive the same rows.

Line items are always reduced to one row per part (and supplier) before they meet another table, so
a part that holds a large share of all lines is combined in the map tasks. No table is broadcast: the merge
hints say so, as Spark would go by the size of the files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repovitals.functions.times import ntz

PAGE_SIZE = 50


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _every(key: Column, n: int, rest: int) -> Column:
    return key % n == rest


def _repository_name() -> Column:
    return F.concat("p_brand", F.lit("/repo-"), F.col("p_partkey").cast("string"))


def raw_repositories(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    key = F.col("p_partkey")
    text_key = key.cast("string")
    created = ntz("1994-01-01 00:00:00")
    spread = (key * 7919) % 12000
    url = F.concat(F.lit("https://example.org/"), text_key)
    size = F.col("p_size").cast("bigint")

    original = {
        "data_source": F.when(_every(key, 20, 7), "git_lab").otherwise("git_hub"),
        "id": F.when(_every(key, 41, 5), "").otherwise(text_key),
        "name": F.when(_every(key, 43, 6), "  ").otherwise(F.concat(F.lit(" "), "p_name")),
        "full_name": F.when(~_every(key, 47, 8), _repository_name()),
        "owner": F.when(_every(key, 19, 1), F.upper("p_brand"))
        .when(_every(key, 23, 1), "")
        .otherwise(F.col("p_brand")),
        "language": F.when(_every(key, 10, 9), "").when(~_every(key, 10, 8), F.col("p_type")),
        "stars": F.when(_every(key, 53, 4), F.lit(-1).cast("bigint"))
        .when(_every(key, 59, 3), F.lit(None).cast("bigint"))
        .when(_every(key, 3, 0), key % 15)
        .otherwise(spread),
        "forks": F.when(_every(key, 61, 2), F.lit(-5).cast("bigint")).otherwise(size),
        "html_url": F.when(~_every(key, 11, 0), url),
        "created_at": F.when(~_every(key, 67, 1), created),
        "updated_at": F.when(_every(key, 13, 1), F.lit(None).cast("timestamp_ntz"))
        .when(_every(key, 17, 2), created)
        .otherwise(ntz("2000-01-01 00:00:00")),
    }
    duplicate = {
        "data_source": F.lit("git_hub"),
        "id": F.concat(text_key, F.lit("_dup")),
        "name": F.col("p_name"),
        "full_name": F.concat(F.lit("  "), _repository_name(), F.lit(" ")),
        "owner": F.col("p_brand"),
        "language": F.col("p_type"),
        "stars": spread,
        "forks": size,
        "html_url": url,
        "created_at": ntz("1995-01-01 00:00:00"),
        "updated_at": ntz("2001-01-01 00:00:00"),
    }

    def rows(frame: DataFrame, columns: dict[str, Column]) -> DataFrame:
        return frame.select(*(column.alias(name) for name, column in columns.items()))

    return rows(part, original).unionByName(rows(part.filter(_every(key, 25, 3)), duplicate))


def _named(per_part: DataFrame, part: DataFrame) -> DataFrame:
    return per_part.join(
        part.select("p_partkey", _repository_name().alias("repository")).hint("merge"),
        F.col("l_partkey") == F.col("p_partkey"),
    )


def _newest_ship_date(lineitem: DataFrame) -> Column:
    return lineitem.agg(F.max("l_shipdate")).scalar()


def _shipped_since(newest: Column, days: int) -> Column:
    recent = F.col("l_shipdate") > newest - F.make_dt_interval(F.lit(days))
    return F.sum(F.when(recent, F.col("l_quantity")).otherwise(0.0))


def raw_contributors(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = table(spark, folder, "lineitem")
    newest = _newest_ship_date(lineitem)
    per_pair = lineitem.groupBy("l_partkey", "l_suppkey").agg(
        F.sum("l_quantity").alias("total"), _shipped_since(newest, 90).alias("recent")
    )
    supplier = F.col("l_suppkey")
    pair = F.col("p_partkey") + supplier
    return _named(per_pair, table(spark, folder, "part")).select(
        F.when(_every(supplier, 31, 4), "git_lab").otherwise("git_hub").alias("data_source"),
        F.col("repository").alias("repo_full_name"),
        F.when(_every(supplier, 29, 3), " ")
        .otherwise(F.concat(F.lit("contributor_"), supplier.cast("string")))
        .alias("contributor"),
        F.when(_every(pair, 97, 5), F.lit(-3).cast("bigint"))
        .otherwise(F.col("total").cast("bigint"))
        .alias("total_commits"),
        F.when(_every(pair, 89, 6), F.lit(100000).cast("bigint"))
        .when(_every(pair, 83, 2), F.lit(-1).cast("bigint"))
        .otherwise(F.col("recent").cast("bigint"))
        .alias("recent_90_days_commits"),
    )


def raw_commits(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = table(spark, folder, "lineitem")
    newest = _newest_ship_date(lineitem)
    per_part = lineitem.groupBy("l_partkey").agg(
        *(_shipped_since(newest, days).alias(f"last_{days}") for days in (30, 90, 180)),
        F.max("l_shipdate").alias("shipped"),
    )
    key = F.col("p_partkey")
    return _named(per_part, table(spark, folder, "part")).select(
        F.lit("git_hub").alias("data_source"),
        F.when(_every(key, 71, 3), "").otherwise(F.col("repository")).alias("repo"),
        F.when(_every(key, 41, 3), F.lit(5000).cast("bigint"))
        .otherwise(F.col("last_30").cast("bigint"))
        .alias("commits_30d"),
        F.when(_every(key, 37, 2), F.lit(-1).cast("bigint"))
        .otherwise(F.col("last_90").cast("bigint"))
        .alias("commits_90d"),
        F.col("last_180").cast("bigint").alias("commits_180d"),
        F.when(~_every(key, 29, 1), F.col("shipped")).alias("last_commit_date"),
    )


def raw_issues(spark: SparkSession, folder: str) -> DataFrame:
    status = F.col("o_orderstatus")
    per_part = (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "orders").hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_partkey")
        .agg(
            F.count_if(status == "O").alias("opened"),
            F.count_if(status == "F").alias("closed_issues"),
            F.count(F.lit(1)).alias("issues_last_90d"),
        )
    )
    key = F.col("p_partkey")
    return _named(per_part, table(spark, folder, "part")).select(
        F.lit("git_hub").alias("data_source"),
        F.col("repository").alias("repo"),
        F.when(_every(key, 43, 7), F.lit(-2).cast("bigint"))
        .when(_every(key, 5, 0), F.lit(0).cast("bigint"))
        .when(_every(key, 7, 0), F.lit(75).cast("bigint"))
        .otherwise(F.col("opened"))
        .alias("open_issues"),
        "closed_issues",
        "issues_last_90d",
    )


def raw_releases(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = table(spark, folder, "lineitem")
    newest = _newest_ship_date(lineitem)
    per_part = (
        lineitem.filter((F.col("l_returnflag") == "R") & ~_every(F.col("l_partkey"), 17, 0))
        .groupBy("l_partkey")
        .agg(F.count(F.lit(1)).alias("returns"), F.max("l_shipdate").alias("returned"))
    )
    key = F.col("p_partkey")
    return _named(per_part, table(spark, folder, "part")).select(
        F.lit("git_hub").alias("data_source"),
        F.col("repository").alias("repo"),
        F.when(_every(key, 73, 4), F.lit(-1).cast("bigint"))
        .otherwise(F.col("returns"))
        .alias("release_count"),
        F.when(~_every(key, 29, 2), F.col("returned")).alias("last_release_date"),
        F.when(_every(key, 31, 9), F.lit(-1).cast("bigint"))
        .otherwise(F.datediff("returned", newest.cast("date")).cast("bigint") * -1)
        .alias("days_since_last_release"),
    )


RAW_DERIVATIONS = {
    "raw_repositories": raw_repositories,
    "raw_contributors": raw_contributors,
    "raw_commits": raw_commits,
    "raw_issues": raw_issues,
    "raw_releases": raw_releases,
}


def event_lines(spark: SparkSession, folder: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Event log lines from the `events` table, in the nested form of a landed line.

    `keep` names columns of `events` to carry along.
    """
    event, slot, number = F.col("event_id"), F.col("slot"), F.col("slot").cast("bigint")
    plain = F.concat(F.lit("repo-"), slot)
    owned = F.concat(F.lit("org/repo-"), slot)
    name = (
        F.when(_every(event, 101, 0), F.lit(None).cast("string"))
        .when(_every(event, 103, 0), "")
        .when(_every(number, 9, 0), plain)
        .when(_every(number, 10, 3), F.concat(owned, F.lit("/sub")))
        .otherwise(owned)
    )
    login = F.when(~_every(event, 50, 7), F.concat(F.lit("u"), F.col("user_id").cast("string")))
    kinds = {
        "click": "PushEvent",
        "view": "WatchEvent",
        "error": "IssuesEvent",
        "signup": "ForkEvent",
        "purchase": "IssueCommentEvent",
    }
    kind = F.coalesce(*(F.when(F.col("event_type") == k, F.lit(v)) for k, v in kinds.items()))
    moment = F.when(_every(event, 211, 0), "not-a-date").otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    events = table(spark, folder, "events").withColumn("slot", F.get_json_object("props", "$.k"))
    return events.select(
        *keep,
        kind.alias("type"),
        moment.alias("created_at"),
        F.struct(name.alias("name")).alias("repo"),
        F.struct(login.alias("login")).alias("actor"),
    )


def search_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Search pages of fifty parts each, in the nested form of a landed page."""
    key = F.col("p_partkey")
    text_key = key.cast("string")

    def iso(moment: Column) -> Column:
        return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'")

    pushed = (
        ntz("2001-11-05 00:00:00")
        - F.make_dt_interval(days=(key % 200).cast("int"), hours=(key % 25).cast("int"))
    )
    item = F.struct(
        F.when(_every(key, 9, 0) & (key > 0), key - 1).otherwise(key).alias("id"),
        _repository_name().alias("full_name"),
        F.concat(F.lit("repo-"), text_key).alias("name"),
        F.struct(F.col("p_brand").alias("login")).alias("owner"),
        F.when(~_every(key, 8, 0), F.col("p_type")).alias("language"),
        ((key * 7919) % 12000).alias("stargazers_count"),
        F.col("p_size").cast("bigint").alias("forks_count"),
        F.concat(F.lit("https://example.org/"), text_key).alias("html_url"),
        iso(ntz("1994-01-01 00:00:00") + F.make_dt_interval((key % 365).cast("int"))).alias("created_at"),
        F.when(_every(key, 13, 1), "not-a-date")
        .otherwise(iso(ntz("2000-01-01 00:00:00") + F.make_dt_interval((key % 100).cast("int"))))
        .alias("updated_at"),
        (key % 60).alias("open_issues_count"),
        _every(key, 16, 3).alias("archived"),
        F.when(~_every(key, 7, 0), iso(pushed)).alias("pushed_at"),
    )
    in_order = F.array_sort(F.collect_list(F.struct(key.alias("key"), item.alias("item"))))
    return (
        table(spark, folder, "part")
        .groupBy(F.floor(key / PAGE_SIZE).alias("page"))
        .agg(in_order.alias("entries"))
        .select("page", F.col("entries.item").alias("items"))
    )
