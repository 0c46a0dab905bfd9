"""Number helpers. Ratios are taken in DECIMAL so that halves round the same everywhere.

Helpers that reports use by the dozen give SQL text: one parsed expression costs the driver far less
than a tree of `Column` calls.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

WHOLE = "decimal(20,0)"


def at_least_zero(column: Column) -> Column:
    """Negative becomes 0; NULL stays NULL (which rules out `greatest`)."""
    return F.when(column < 0, F.lit(0).cast("bigint")).otherwise(column)


def within(column: Column, bound: Column) -> Column:
    """`at_least_zero`, and no more than `bound`, which may itself be negative or NULL."""
    return (
        F.when(column < 0, F.lit(0).cast("bigint"))
        .when(column > bound, bound)
        .otherwise(column)
    )


def banded(column: Column, bands: Sequence[tuple[int, str]], otherwise: str, *, rising: bool) -> Column:
    """Factor of the first band that holds `column`.

    `rising` bands are lower bounds (more is better); others are upper bounds. NULL fits no band.
    """
    result = None
    for threshold, factor in bands:
        hit = column >= threshold if rising else column <= threshold
        value = F.lit(Decimal(factor))
        result = F.when(hit, value) if result is None else result.when(hit, value)
    return result.otherwise(F.lit(Decimal(otherwise)))


def percentage(part: str, whole: str, digits: int = 2) -> str:
    """SQL text: `part` in percent of `whole` as an exact rounded decimal; NULL when `whole` is 0."""
    return f"round(cast({part} as {WHOLE}) * 100 / cast(nullif({whole}, 0) as {WHOLE}), {digits})"


def mean_of(total: str, rows: str, digits: int = 2) -> str:
    """SQL text: rounded average from a total and the number of rows in it."""
    return f"round(cast({total} as {WHOLE}) / cast(nullif({rows}, 0) as {WHOLE}), {digits})"


def mean(column: str, digits: int = 2) -> str:
    """SQL text: rounded average of a column of whole numbers, NULLs left out.

    The running total is a plain BIGINT or DOUBLE, which codegen keeps in registers; only the one
    division per group is decimal.
    """
    return mean_of(f"sum({column})", f"count({column})", digits)
