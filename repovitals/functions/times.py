"""Time helpers. All times are TIMESTAMP_NTZ, so the session time zone does not matter."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from repovitals import fixed_values as fx

ISO_UTC = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"


def ntz(moment: datetime | str) -> Column:
    """A TIMESTAMP_NTZ literal. An aware datetime is taken to UTC first."""
    if isinstance(moment, datetime):
        if moment.tzinfo is not None:
            moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
        moment = moment.isoformat(sep=" ")
    return F.lit(moment).cast("timestamp_ntz")


def now_utc() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def parsed_iso(text: Column) -> Column:
    """ISO-8601 text ending in Z as TIMESTAMP_NTZ; NULL for anything else."""
    return F.when(text.rlike(ISO_UTC), text.try_cast("timestamp_ntz"))


def days_before(moment: Column, days: int) -> Column:
    return moment - F.make_dt_interval(F.lit(days))


def whole_days(start: Column, end: Column) -> Column:
    """Full days from `start` to `end`, rounded down, also when `end` is earlier.

    `datediff` counts midnights, so both times are first moved back by the time of day of `start`:
    from midnight on, midnights and full days are the same count.
    """
    time_of_day = start - F.to_date(start).cast("timestamp_ntz")
    return F.datediff(end - time_of_day, start).cast("bigint")


def push_recency(days: Column) -> Column:
    """Label for the age of the last push."""
    fresh, recent = fx.PUSH_RECENCY_DAYS
    return (
        F.when(days.isNull(), "none")
        .when(days < fresh, f"under_{fresh}_days")
        .when(days < recent, f"under_{recent}_days")
        .otherwise("older")
    )


def stamp(moment: str) -> str:
    """SQL text: the text form of a time in the status report."""
    return f"date_format({moment}, 'yyyy-MM-dd HH:mm:ss.SSS')"
