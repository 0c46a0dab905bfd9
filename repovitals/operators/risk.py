"""Risk score and category per repository."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repovitals import fixed_values as fx
from repovitals.functions.numbers import banded
from repovitals.schemas import TABLES


def factor_columns() -> dict[str, Column]:
    """The five factors, 0 for no risk to 1, as exact decimals."""
    return {
        "stars_risk_factor": banded(
            F.col("stars"), fx.STAR_BANDS, fx.WORST_FACTOR, rising=True
        ),
        "commits_risk_factor": banded(
            F.col("commits_90d"), fx.COMMIT_BANDS, fx.WORST_FACTOR, rising=True
        ),
        "contributors_risk_factor": banded(
            F.col("active_contributors_90d"), fx.CONTRIBUTOR_BANDS, fx.WORST_FACTOR, rising=True
        ),
        "release_risk_factor": banded(
            F.col("days_since_last_release"), fx.RELEASE_AGE_BANDS, fx.WORST_FACTOR, rising=False
        ),
        # None open is a band of its own: a negative count falls to the next one.
        "issues_risk_factor": F.when(
            F.col("open_issues") == 0, F.lit(fx.NO_OPEN_ISSUES_FACTOR).cast("decimal(2,1)")
        ).otherwise(banded(F.col("open_issues"), fx.OPEN_ISSUE_BANDS, fx.WORST_FACTOR, rising=False)),
    }


def score_from_factors(**factors: Column) -> Column:
    """Weighted score from 0 to 100 as a decimal: halves of a point round up exactly."""
    weights = {
        "stars_risk_factor": fx.STAR_WEIGHT,
        "commits_risk_factor": fx.COMMIT_WEIGHT,
        "contributors_risk_factor": fx.CONTRIBUTOR_WEIGHT,
        "release_risk_factor": fx.RELEASE_WEIGHT,
        "issues_risk_factor": fx.ISSUE_WEIGHT,
    }
    weighted = sum(
        (factors[name] * F.lit(weight) for name, weight in weights.items()),
        start=F.lit(0).cast("decimal(4,3)"),
    )
    return F.round(weighted, 2) * 100


def category(score: Column) -> Column:
    return (
        F.when(score >= fx.HIGH_FROM, fx.HIGH)
        .when(score >= fx.MEDIUM_FROM, fx.MEDIUM)
        .otherwise(fx.LOW)
    )


def risk_factors(enriched: DataFrame, source: str = fx.SOURCE) -> DataFrame:
    """The five factors per repository, as DOUBLE for reading."""
    return enriched.filter(F.col("data_source") == source).select(
        "full_name", *(column.cast("double").alias(name) for name, column in factor_columns().items())
    )


def risk_product(enriched: DataFrame, as_of: Column, source: str = fx.SOURCE) -> DataFrame:
    """Score and category per enriched row. The category is read off the score before DOUBLE."""
    scored = enriched.filter(F.col("data_source") == source).withColumn(
        "exact_score", score_from_factors(**factor_columns())
    )
    return (
        scored.withColumn("risk_score", F.col("exact_score").cast("double"))
        .withColumn("risk_category", category(F.col("exact_score")))
        .withColumn("last_updated", as_of)
        .select(*TABLES["risk_product"].schema.names)
    )
