"""Landed search pages to repositories, and the union of several repository sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repovitals.functions.times import parsed_iso, push_recency, whole_days


def _first_item_per_id(pages: DataFrame) -> DataFrame:
    """Items of all pages; of a repeated id the first in (page, position) order.

    "Row number = 1" becomes a group limit before the shuffle, so an id repeated on a third of all
    pages costs one row per map task.
    """
    items = pages.select("page", F.posexplode("items").alias("position", "item"))
    in_page_order = Window.partitionBy("item.id").orderBy("page", "position")
    return (
        items.select("*", F.row_number().over(in_page_order).alias("rank"))
        .filter("rank = 1")
        .select("item.*")
    )


def repos_from_search(pages: DataFrame) -> DataFrame:
    """Repositories from search pages (`page`, `items`)."""
    return repos_from_items(_first_item_per_id(pages))


def repos_from_items(items: DataFrame) -> DataFrame:
    """Repositories from search items, one row each."""
    return items.select(
        F.col("id").cast("string").alias("id"),
        "full_name",
        "name",
        F.col("owner.login").alias("owner"),
        "language",
        F.col("stargazers_count").alias("stars"),
        F.col("forks_count").alias("forks"),
        "html_url",
        parsed_iso(F.col("created_at")).alias("created_at"),
        parsed_iso(F.col("updated_at")).alias("updated_at"),
        F.col("open_issues_count").alias("open_issues"),
        "archived",
    )


def issues_from_search(pages: DataFrame) -> DataFrame:
    """Raw issues: the open issues that search says each repository has."""
    return _first_item_per_id(pages).select(
        F.col("full_name").alias("repo"), F.col("open_issues_count").alias("open_issues")
    )


def push_ages(pages: DataFrame, as_of: Column) -> DataFrame:
    """Full days since each repository's last push, and the recency band they fall in."""
    pushed = parsed_iso(F.col("pushed_at"))
    return (
        _first_item_per_id(pages)
        .select(
            F.col("id").cast("string").alias("id"),
            pushed.alias("pushed_at"),
            whole_days(pushed, as_of).alias("days_since_push"),
        )
        .withColumn("push_recency", push_recency(F.col("days_since_push")))
    )


def union_by_priority(frames: list[DataFrame]) -> DataFrame:
    """Repositories of several sources with the number of their source as `priority`, from 1. No row is
    dropped and nothing is sorted; columns a source lacks are NULL.
    """
    ranked = (
        frame.withColumn("priority", F.lit(position)) for position, frame in enumerate(frames, 1)
    )
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)
