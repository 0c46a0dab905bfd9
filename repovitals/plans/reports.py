"""Reports over the risk product. Every ranking has the name as its last key, so it is repeatable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repovitals import fixed_values as fx
from repovitals.functions.numbers import mean, percentage
from repovitals.functions.text import shortened_name
from repovitals.schemas import TABLES

FIGURES = (
    "full_name",
    "language",
    "stars",
    "commits_90d",
    "active_contributors_90d",
    "days_since_last_release",
    "open_issues",
    "risk_score",
    "risk_category",
)


def of_source(product: DataFrame, source: str) -> DataFrame:
    return product.filter(F.col("data_source") == source)


def _in_category(name: str) -> Column:
    return F.count_if(F.col("risk_category") == name)


def _average_score() -> Column:
    return F.expr(mean("risk_score")).cast("double").alias("avg_risk_score")


def riskiest_first() -> list[Column]:
    return [F.col("risk_score").desc_nulls_first(), F.col("full_name").asc_nulls_last()]


def report_summary(product: DataFrame, source: str = fx.SOURCE) -> DataFrame:
    """Counts, average score and share per category in one row; shares are NULL without rows."""
    counted = of_source(product, source).agg(
        F.count(F.lit(1)).alias("total_repos"),
        _average_score(),
        _in_category(fx.HIGH).alias("high_risk_count"),
        _in_category(fx.MEDIUM).alias("medium_risk_count"),
        _in_category(fx.LOW).alias("low_risk_count"),
        F.max("last_updated").alias("last_updated"),
    )
    return counted.select(
        "*",
        *(
            F.expr(percentage(f"{level}_risk_count", "total_repos", 1))
            .cast("double")
            .alias(f"{level}_pct")
            for level in ("high", "medium", "low")
        ),
    )


def report_top(
    product: DataFrame, n: int = fx.TOP_N, *, risky: bool = True, source: str = fx.SOURCE
) -> DataFrame:
    """The `n` riskiest repositories, or with `risky=False` the healthiest."""
    healthiest_first = [F.col("risk_score").asc_nulls_last(), F.col("full_name").asc_nulls_last()]
    order = riskiest_first() if risky else healthiest_first
    return of_source(product, source).select(*FIGURES).orderBy(*order).limit(n)


def report_top_display(
    product: DataFrame, n: int = fx.TOP_N, *, risky: bool = True, source: str = fx.SOURCE
) -> DataFrame:
    """`report_top` as shown: long names shortened, a missing language named."""
    return report_top(product, n, risky=risky, source=source).withColumns(
        {
            "full_name": shortened_name(F.col("full_name")),
            "language": F.coalesce("language", F.lit(fx.LANGUAGE_DISPLAY_FALLBACK)),
        }
    )


def report_by_language(
    product: DataFrame, n: int = fx.TOP_LANGUAGES, source: str = fx.SOURCE
) -> DataFrame:
    """Counts and average score of the `n` most frequent languages.

    No language and the language 'Unknown' are separate groups of the same display name.
    """
    grouped = (
        of_source(product, source)
        .groupBy("language")
        .agg(
            F.count(F.lit(1)).alias("repo_count"),
            _average_score(),
            _in_category(fx.HIGH).alias("high_risk"),
            _in_category(fx.MEDIUM).alias("medium_risk"),
            _in_category(fx.LOW).alias("low_risk"),
        )
    )
    top = grouped.orderBy(F.desc("repo_count"), F.col("language").asc_nulls_last()).limit(n)
    return top.withColumn("language", F.coalesce("language", F.lit(fx.NO_LANGUAGE)))


def contains_term(name: Column, term: Column) -> Column:
    """Whether a name contains a term in any case, `%` and `_` being wildcards."""
    pattern = F.concat(F.lit("%"), F.replace(term, F.lit("\\"), F.lit("\\\\")), F.lit("%"))
    return F.like(F.upper(name), F.upper(pattern))


def report_search(
    product: DataFrame, term: str, n: int = fx.SEARCH_LIMIT, source: str = fx.SOURCE
) -> DataFrame:
    """The `n` riskiest repositories whose name contains `term` in any case.

    `%` and `_` in the term are wildcards; a backslash is an ordinary character.
    """
    return (
        of_source(product, source)
        .filter(contains_term(F.col("full_name"), F.lit(term)))
        .select(*FIGURES, "last_updated")
        .orderBy(*riskiest_first())
        .limit(n)
    )


def interpretation() -> Column:
    category = F.col("risk_category")
    return (
        F.when(category == fx.HIGH, fx.INTERPRETATION_HIGH)
        .when(category == fx.MEDIUM, fx.INTERPRETATION_MEDIUM)
        .otherwise(fx.INTERPRETATION_LOW)
    )


def report_repo(product: DataFrame, full_name: str | Column, source: str = fx.SOURCE) -> DataFrame:
    """One repository, its name matched in any case, with what its category means."""
    return (
        of_source(product, source)
        .filter(F.upper("full_name") == F.upper(F.lit(full_name)))
        .select(*FIGURES, "last_updated", interpretation().alias("interpretation"))
        .orderBy(*riskiest_first())
        .limit(1)
    )


def report_export(product: DataFrame, source: str = fx.SOURCE) -> DataFrame:
    """All rows, riskiest first.

    The sort is by ranges of its key. Scores take about a hundred values and a name may repeat, so
    the key goes on through all columns to a row number: no range has to hold a whole score or name.
    """
    columns = TABLES["risk_product"].schema.names
    ties = [F.col(name).asc_nulls_last() for name in columns if name not in ("risk_score", "full_name")]
    numbered = of_source(product, source).select(*columns, F.monotonically_increasing_id().alias("row_id"))
    return numbered.orderBy(*riskiest_first(), *ties, "row_id").select(*columns)


def export_csv(product: DataFrame, path: str, source: str = fx.SOURCE) -> DataFrame:
    """Write `report_export` as CSV with headers and return the summary of what was exported.

    The files of the folder, in name order, hold the rows in order.
    """
    report_export(product, source).write.mode("overwrite").option("header", True).csv(path)
    return report_summary(product, source)


def report_all(product: DataFrame, source: str = fx.SOURCE) -> dict[str, DataFrame]:
    """The standard set of reports by name."""
    n = fx.ALL_REPORTS_TOP_N
    return {
        "summary": report_summary(product, source),
        "by_language": report_by_language(product, source=source),
        "top_risky": report_top(product, n, source=source),
        "healthiest": report_top(product, n, risky=False, source=source),
    }
