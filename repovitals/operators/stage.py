"""Raw repositories to the staged table: cleansed, validated, one row per name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repovitals import fixed_values as fx
from repovitals.functions.numbers import at_least_zero
from repovitals.functions.text import is_blank, text_or
from repovitals.functions.times import days_before
from repovitals.schemas import TABLES

# The three rules below look alike but are separate on purpose: a NULL star count makes a row
# not valid, yet gives it no reason, and the invalid counter does not see it.


def is_valid() -> Column:
    """Flag of a raw row. NULL stars or forks make it False."""
    complete = ~is_blank(F.col("id")) & ~is_blank(F.col("name")) & ~is_blank(F.col("full_name"))
    return F.coalesce(complete & (F.col("stars") >= 0) & (F.col("forks") >= 0), F.lit(False))


def invalid_reason() -> Column:
    """First reason that applies to a raw row."""
    reasons = (
        (is_blank(F.col("id")), fx.REASON_NO_ID),
        (is_blank(F.col("name")), fx.REASON_NO_NAME),
        (is_blank(F.col("full_name")), fx.REASON_NO_FULL_NAME),
        (F.col("stars") < 0, fx.REASON_NEGATIVE_STARS),
        (F.col("forks") < 0, fx.REASON_NEGATIVE_FORKS),
    )
    return F.coalesce(*(F.when(hit, text) for hit, text in reasons), F.lit(fx.REASON_NONE))


def counts_as_invalid() -> Column:
    """What the load counter calls invalid; unlike the flag it also objects to no creation time."""
    return (
        is_blank(F.col("id"))
        | is_blank(F.col("name"))
        | is_blank(F.col("full_name"))
        | F.coalesce(F.col("stars") < 0, F.lit(False))
        | F.coalesce(F.col("forks") < 0, F.lit(False))
        | F.col("created_at").isNull()
    )


def cleanse_repositories(raw: DataFrame, as_of: Column, source: str = fx.SOURCE) -> DataFrame:
    """Every row of one source with defaults, clamps, flag and reason; nothing is removed yet.

    One `select`, so that each rule sees the raw values and not another rule's output.
    """
    created = F.col("created_at")
    return raw.filter(F.col("data_source") == source).select(
        "data_source",
        F.trim("id").alias("id"),
        text_or(F.col("name"), fx.NO_NAME).alias("name"),
        text_or(F.col("full_name"), fx.NO_REPOSITORY).alias("full_name"),
        text_or(F.col("owner"), fx.NO_OWNER).alias("owner"),
        text_or(F.col("language"), fx.NO_LANGUAGE).alias("language"),
        at_least_zero(F.col("stars")).alias("stars"),
        at_least_zero(F.col("forks")).alias("forks"),
        text_or(F.col("html_url"), fx.NO_URL).alias("html_url"),
        F.coalesce(created, days_before(as_of, fx.CREATED_BACKFILL_DAYS)).alias("created_at"),
        F.coalesce(F.col("updated_at"), created, as_of).alias("updated_at"),
        as_of.alias("load_timestamp"),
        is_valid().alias("valid_flag"),
        invalid_reason().alias("invalid_reason"),
    )


def _tie_breakers(columns: list[str]) -> list[str]:
    decided = {"data_source", "full_name", "updated_at", "id", "load_timestamp"}
    return ["id", *(c for c in columns if c not in decided)]


def latest_per_name(cleansed: DataFrame) -> DataFrame:
    """The most recently updated row of each repository name, valid or not.

    All remaining columns break ties, so a task that is run again picks the same row. Spark turns
    "row number = 1" into a group limit before the shuffle: of a name that holds a third of all
    rows (the placeholder, say) each map task ships one row.
    """
    ties = [F.col(c).asc_nulls_last() for c in _tie_breakers(cleansed.columns)]
    latest_first = Window.partitionBy("full_name").orderBy(F.desc("updated_at"), *ties)
    return (
        cleansed.select("*", F.row_number().over(latest_first).alias("rank"))
        .filter("rank = 1")
        .drop("rank")
    )


def is_later(columns: list[str], other: str) -> Column:
    """Whether a row comes before the row in the struct `other` in the order of `latest_per_name`; False if they tie."""
    mine, its = F.col("updated_at"), F.col(f"{other}.updated_at")

    def ties(prefix: str) -> Column:
        values = [F.col(f"{prefix}{c}") for c in _tie_breakers(columns)]
        return F.struct(*(part for value in values for part in (value.isNull(), value)))

    by_time = F.coalesce(mine > its, mine.isNotNull())
    return F.when(mine.eqNullSafe(its), ties("") < ties(f"{other}.")).otherwise(by_time)


def stage_repositories(raw: DataFrame, as_of: Column, source: str = fx.SOURCE) -> DataFrame:
    staged = latest_per_name(cleanse_repositories(raw, as_of, source))
    return staged.select(*TABLES["stg_repositories"].schema.names)
