"""Raw activity tables to hub tables: default names, plausible counters. No shuffle in any of them.

A counter is bounded by its neighbour's raw value, even a negative one; that is the contract.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repovitals import fixed_values as fx
from repovitals.functions.numbers import at_least_zero, within
from repovitals.functions.text import text_or
from repovitals.functions.times import ntz


def _hub(raw: DataFrame, source: str, as_of: Column, **columns: Column) -> DataFrame:
    return raw.filter(F.col("data_source") == source).select(
        "data_source",
        *(column.alias(name) for name, column in columns.items()),
        as_of.alias("load_timestamp"),
    )


def hub_contributors(raw: DataFrame, as_of: Column, source: str = fx.SOURCE) -> DataFrame:
    total = F.col("total_commits")
    return _hub(
        raw, source, as_of,
        repo_full_name=text_or(F.col("repo_full_name"), fx.NO_REPOSITORY),
        contributor=text_or(F.col("contributor"), fx.NO_CONTRIBUTOR),
        total_commits=at_least_zero(total),
        recent_90_days_commits=within(F.col("recent_90_days_commits"), total),
    )


def hub_commits(raw: DataFrame, as_of: Column, source: str = fx.SOURCE) -> DataFrame:
    last_90, last_180 = F.col("commits_90d"), F.col("commits_180d")
    return _hub(
        raw, source, as_of,
        repo=text_or(F.col("repo"), fx.NO_REPOSITORY),
        commits_30d=within(F.col("commits_30d"), last_90),
        commits_90d=within(last_90, last_180),
        commits_180d=at_least_zero(last_180),
        last_commit_date=F.coalesce(F.col("last_commit_date"), as_of),
    )


def hub_issues(raw: DataFrame, as_of: Column, source: str = fx.SOURCE) -> DataFrame:
    opened, closed = F.col("open_issues"), F.col("closed_issues")
    return _hub(
        raw, source, as_of,
        repo=text_or(F.col("repo"), fx.NO_REPOSITORY),
        open_issues=at_least_zero(opened),
        closed_issues=at_least_zero(closed),
        issues_last_90d=within(F.col("issues_last_90d"), opened + closed),
    )


def hub_releases(raw: DataFrame, as_of: Column, source: str = fx.SOURCE) -> DataFrame:
    age = F.col("days_since_last_release")
    return _hub(
        raw, source, as_of,
        repo=text_or(F.col("repo"), fx.NO_REPOSITORY),
        release_count=at_least_zero(F.col("release_count")),
        last_release_date=F.coalesce(F.col("last_release_date"), ntz(fx.NO_RELEASE_DATE)),
        days_since_last_release=F.when(
            age < 0, F.lit(fx.NO_RELEASE_AGE_DAYS).cast("bigint")
        ).otherwise(age),
    )
