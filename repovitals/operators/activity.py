"""Event log to per-repository activity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repovitals import fixed_values as fx
from repovitals.functions.text import name_of, owner_of, stable_id
from repovitals.functions.times import parsed_iso


def _named_events(events: DataFrame) -> DataFrame:
    """Events that name a repository; an event without an actor belongs to the actor ''."""
    return events.filter(F.col("repo.name") != "").select(
        F.col("repo.name").alias("full_name"),
        F.coalesce(F.col("actor.login"), F.lit("")).alias("login"),
        F.col("type").alias("event_type"),
        F.col("created_at"),
    )


def actor_states(events: DataFrame) -> DataFrame:
    """What the events of one (repository, actor) come to, one row each. Such rows can be merged later."""
    return (
        _named_events(events)
        .groupBy("full_name", "login")
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            F.max(parsed_iso(F.col("created_at"))).alias("last_event"),
            F.count_if(F.col("event_type") == fx.PUSH_EVENT).alias("push_events"),
            F.count_if(F.col("event_type").isin(*fx.ISSUE_EVENTS)).alias("issue_events"),
        )
    )


def merged_states(states: DataFrame) -> DataFrame:
    """States of several loads, of which one (repository, actor) may have several, as one row each."""
    counts = ("n_events", "push_events", "issue_events")
    merged = states.groupBy("full_name", "login").agg(
        F.max("last_event").alias("last_event"), *(F.sum(name).alias(name) for name in counts)
    )
    return merged.select("full_name", "login", "n_events", "last_event", "push_events", "issue_events")


def repos_from_states(per_actor: DataFrame, as_of: Column) -> DataFrame:
    """One row per repository, from one row per (repository, actor)."""
    per_repository = per_actor.groupBy("full_name").agg(
        F.max("last_event").alias("last_event"),
        F.sum("n_events").alias("n_events"),
        F.count("login").alias("total_contributors"),
        F.sum("push_events").alias("push_events"),
        F.sum("issue_events").alias("issue_events"),
    )
    full_name = F.col("full_name")
    return per_repository.select(
        stable_id(full_name).alias("id"),
        "full_name",
        name_of(full_name).alias("name"),
        owner_of(full_name).alias("owner"),
        F.concat(F.lit(fx.REPOSITORY_URL_PREFIX), full_name).alias("html_url"),
        F.coalesce("last_event", as_of).alias("updated_at"),
        "n_events",
        "total_contributors",
        "push_events",
        "issue_events",
    )


def repos_from_events(events: DataFrame, as_of: Column) -> DataFrame:
    """One row per repository seen in the log.

    Unreadable event times are left out of the maximum; a repository with none readable gets
    `as_of`. Events are first combined per (repository, actor), which also spreads a repository
    that holds a large share of the log over all tasks.
    """
    return repos_from_states(actor_states(events), as_of)


def _activity(events: DataFrame, as_of: Column, wanted: Column, days: tuple[int, ...]) -> DataFrame:
    """Per (repository, actor), of the events `wanted`: n, last, and n_<days> of the days before as_of.

    Grouped by actor first, so a repository with a large share of the log is spread over all tasks.
    """
    moment = parsed_iso(F.col("created_at"))

    def recent(n: int) -> Column:
        return F.count_if(wanted & (moment <= as_of) & (moment > as_of - F.make_dt_interval(days=F.lit(n))))

    return (
        _named_events(events)
        .groupBy("full_name", "login")
        .agg(
            F.count_if(wanted).alias("n"),
            F.max(F.when(wanted, moment)).alias("last"),
            *(recent(n).alias(f"n_{n}") for n in days),
        )
    )


def contributors_from_events(events: DataFrame, as_of: Column) -> DataFrame:
    """Raw contributors: the actors of each repository with their pushes, in all and in 90 days.

    Every actor seen counts; one without a push has none. Events without an actor belong to nobody.
    """
    per_actor = _activity(events, as_of, F.col("event_type") == fx.PUSH_EVENT, (90,))
    return per_actor.filter("login <> ''").select(
        F.col("full_name").alias("repo_full_name"),
        F.col("login").alias("contributor"),
        F.col("n").alias("total_commits"),
        F.col("n_90").alias("recent_90_days_commits"),
    )


def commits_from_events(events: DataFrame, as_of: Column) -> DataFrame:
    """Raw commits: pushes of each repository that has any, in 30, 90 and 180 days, and the last one."""
    days = (30, 90, 180)
    per_actor = _activity(events, as_of, F.col("event_type") == fx.PUSH_EVENT, days)
    return per_actor.filter("n > 0").groupBy(F.col("full_name").alias("repo")).agg(
        *(F.sum(f"n_{n}").alias(f"commits_{n}d") for n in days), F.max("last").alias("last_commit_date")
    )


def issues_from_events(events: DataFrame, as_of: Column) -> DataFrame:
    """Raw issues: issue events of each repository that has any, as open issues, and those of 90 days.

    The log does not say which of them closed an issue, so closed issues are left to the default.
    """
    per_actor = _activity(events, as_of, F.col("event_type").isin(*fx.ISSUE_EVENTS), (90,))
    return per_actor.filter("n > 0").groupBy(F.col("full_name").alias("repo")).agg(
        F.sum("n").alias("open_issues"), F.sum("n_90").alias("issues_last_90d")
    )


def event_type_counts(events: DataFrame) -> DataFrame:
    """One row per repository and event type, with the repository's number of types."""
    counts = _named_events(events).groupBy("full_name", "event_type").agg(F.count(F.lit(1)).alias("n"))
    # The log is read once; a repository's rows here are as many as it has types.
    n_types = F.count(F.lit(1)).over(Window.partitionBy("full_name"))
    return counts.withColumn("n_types", n_types).select("full_name", "event_type", "n", "n_types")


def event_type_maps(events: DataFrame) -> DataFrame:
    """The same in nested form: a map from type to count, and the sorted list of types.

    Events are counted before they are gathered, so a row holds one entry per distinct type.
    """
    counts = (
        _named_events(events)
        .filter(F.col("event_type").isNotNull())
        .groupBy("full_name", "event_type")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    entries = F.array_sort(F.collect_list(F.struct("event_type", "n")))
    return (
        counts.groupBy("full_name")
        .agg(entries.alias("entries"))
        .select(
            "full_name",
            F.map_from_entries("entries").alias("event_counts"),
            F.col("entries.event_type").alias("event_types"),
        )
    )
