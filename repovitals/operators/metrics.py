"""What a load did, in numbers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repovitals import fixed_values as fx
from repovitals.functions.text import text_or
from repovitals.operators.stage import counts_as_invalid

METRICS = (
    "total_records",
    "valid_records",
    "invalid_records",
    "duplicates_removed",
    "final_records",
    "contributors_loaded",
    "commits_loaded",
    "issues_loaded",
    "releases_loaded",
    "enriched_records",
    "risk_records",
    "high_risk",
    "medium_risk",
    "low_risk",
)


#: Counters of rows written: the table each is about.
ROWS_OF = {
    "final_records": "stg_repositories",
    "contributors_loaded": "hub_contributors",
    "commits_loaded": "hub_commits",
    "issues_loaded": "hub_issues",
    "releases_loaded": "hub_releases",
    "enriched_records": "repo_entryline",
    "risk_records": "risk_product",
}


def risk_counts() -> list[Column]:
    """Products by category."""
    names = {"high_risk": fx.HIGH, "medium_risk": fx.MEDIUM, "low_risk": fx.LOW}
    return [F.count_if(F.col("risk_category") == category).alias(name) for name, category in names.items()]


def _of_raw(raw: DataFrame, source: str) -> DataFrame:
    """Valid is "total minus what the counter calls invalid"; that is not the number of rows flagged
    valid (see `operators.stage`).
    """
    rows = F.count(F.lit(1))
    names = F.count_distinct(text_or(F.col("full_name"), fx.NO_REPOSITORY))
    invalid = F.count_if(counts_as_invalid())
    return raw.filter(F.col("data_source") == source).agg(
        rows.alias("total_records"),
        (rows - invalid).alias("valid_records"),
        invalid.alias("invalid_records"),
        (rows - names).alias("duplicates_removed"),
    )


def run_metrics(raw: DataFrame, written: dict[str, dict[str, int]], source: str = fx.SOURCE) -> DataFrame:
    """One row with the counters of one run: of the raw repositories read, and of the rows it wrote.

    written: what was counted while each table was written, by table.
    """
    counts = {name: written[key]["rows"] for name, key in ROWS_OF.items()}
    counts |= {name: written["risk_product"][name] for name in ("high_risk", "medium_risk", "low_risk")}
    row = _of_raw(raw, source).withColumns({name: F.lit(n).cast("bigint") for name, n in counts.items()})
    return row.select(*METRICS)


def load_metrics(tables: dict[str, DataFrame], source: str = fx.SOURCE) -> DataFrame:
    """One row with the same counters of all that the tables hold, each table read once."""

    def of(key: str) -> DataFrame:
        return tables[key].filter(F.col("data_source") == source)

    parts = [_of_raw(tables["raw_repositories"], source)]
    for name, key in ROWS_OF.items():
        more = risk_counts() if key == "risk_product" else []
        parts.append(of(key).agg(F.count(F.lit(1)).alias(name), *more))
    # Each part is one row with its own columns; the maximum per column folds them into one row.
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*(F.max(name).alias(name) for name in METRICS))
