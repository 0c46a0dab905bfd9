"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from repovitals import fixed_values as fx


def is_blank(column: Column) -> Column:
    """True for NULL and for text made only of spaces; never NULL."""
    return F.coalesce(F.trim(column), F.lit("")) == ""


def blank(name: str) -> str:
    """`is_blank` as SQL text, for a column name."""
    return f"coalesce(trim({name}), '') = ''"


def text_or(column: Column, default: str) -> Column:
    """The trimmed text, or `default` when it is NULL or blank."""
    return F.coalesce(F.nullif(F.trim(column), F.lit("")), F.lit(default))


def clip(column: Column, width: int) -> Column:
    """The first `width` characters, as a text column of that width stores them."""
    return F.substring(column, 1, width)


def owner_of(full_name: Column) -> Column:
    """What stands before the first slash, or the fallback owner when there is no slash."""
    slash = F.instr(full_name, "/")
    return F.when(slash > 0, F.substring(full_name, F.lit(1), slash - 1)).otherwise(
        F.lit(fx.EVENT_OWNER_FALLBACK)
    )


def name_of(full_name: Column) -> Column:
    """What stands after the first slash; the whole text when there is none."""
    slash = F.instr(full_name, "/")
    return F.substring(full_name, slash + 1, F.length(full_name))


def stable_id(full_name: Column) -> Column:
    """A repeatable identifier made from the repository name, by its whole digest."""
    return F.concat(F.lit(fx.EVENT_ID_PREFIX), F.md5(full_name))


def shortened_name(full_name: Column) -> Column:
    """Names too long for a report line are cut and marked."""
    cut = F.concat(
        F.substring(full_name, 1, fx.NAME_DISPLAY_KEEP), F.lit(fx.NAME_DISPLAY_SUFFIX)
    )
    return F.when(F.length(full_name) > fx.NAME_DISPLAY_MAX, cut).otherwise(full_name)
