"""Dataset profile and data-quality findings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repovitals.functions.numbers import mean
from repovitals.functions.text import is_blank

#: A value is an outlier this many interquartile ranges above the upper quartile.
OUTLIER_RANGES = 3
#: Ranges into which the different values of a column are cut, and the accuracy of their bounds: that
#: many different values are told apart.
RANGES = 256
BOUND_ACCURACY = 4 * RANGES


def profile_repositories(repositories: DataFrame) -> DataFrame:
    """Size and health of a data set in one row. NULL counters are neither zero nor low."""
    return repositories.agg(
        F.count(F.lit(1)).alias("total_repositories"),
        F.count_distinct("language").alias("unique_languages"),
        F.count_if(F.col("language").isNull()).alias("missing_language"),
        F.expr(mean("stars", 1)).cast("double").alias("avg_stars"),
        F.count_if(F.col("commits_90d") == 0).alias("zero_commit_repos"),
        F.count_if(F.col("active_contributors_90d") <= 1).alias("single_maintainer_repos"),
    )


def exact_quantiles(frame: DataFrame, column: str, shares: list[float]) -> DataFrame:
    """Exact interpolated quantiles of a whole-number column, one row (`share`, `quantile`) each.

    Values are counted once, so a hot value is one row, and the counts are cut into RANGES ranges of
    about as many different values each. The ranges' totals are summed up in order, which says in which of
    them a wanted rank lies; only those are put in order inside. No range is more than its share of
    the different values, so no task sorts more than that, whatever the column holds.
    """
    values = frame.select(F.col(column).cast("bigint").alias("value")).filter("value is not null")
    per_value = values.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    # Where ranges begin decides how much a task sorts, not the result: approximate bounds do.
    shares_of_range = F.array(*(F.lit(i / RANGES) for i in range(1, RANGES)))
    bounds = per_value.agg(F.array_distinct(F.percentile_approx("value", shares_of_range, BOUND_ACCURACY)).alias("bounds"))
    number = F.size(F.filter("bounds", lambda bound: bound <= F.col("value")))
    ranged = per_value.crossJoin(F.broadcast(bounds)).select("value", "n", number.alias("range"))  # bounds: one row
    upwards = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        ranged.groupBy("range")
        .agg(F.sum("n").alias("n"))
        .select(
            "range", "n",
            F.coalesce(F.sum("n").over(upwards), F.lit(0)).alias("before"),
            F.sum("n").over(Window.partitionBy()).alias("total"),
        )
    )
    position = (F.col("total") - 1) * F.col("share")
    # At most two ranks for each share, each in one range.
    wanted = (
        totals.withColumn("share", F.explode(F.array(*(F.lit(float(share)) for share in shares))))
        .withColumn("position", position)
        .withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("position"), F.ceil("position")))))
        .filter((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n")))
        .select("range", "before", "share", "position", "rank")
    )
    by_range = wanted.groupBy("range").agg(
        F.first("before").alias("before"), F.collect_list(F.struct("share", "position", "rank")).alias("ranks")
    )
    in_order = Window.partitionBy("range").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.join(F.broadcast(by_range), "range").withColumn(
        "first", F.col("before") + F.coalesce(F.sum("n").over(in_order), F.lit(0))
    )
    hits = placed.select(
        "value",
        F.inline(F.filter("ranks", lambda x: (x["rank"] >= F.col("first")) & (x["rank"] < F.col("first") + F.col("n")))),
    )
    low, high = F.min("value"), F.max("value")
    fraction = F.max("position") - F.min("rank")
    return hits.groupBy("share").agg((low + (high - low) * fraction).alias("quantile"))


def _finding(name: str, rows: DataFrame) -> DataFrame:
    return rows.select(F.lit(name).alias("check_name"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def dq_findings(repositories: DataFrame) -> DataFrame:
    """How many rows show each of five known defects.

    - missing_language: no language;
    - created_not_before_updated: creation time at or after the update time;
    - duplicate_full_name: rows beyond the first of their (trimmed) name;
    - star_outliers: stars above the upper quartile by more than three interquartile ranges;
    - owner_casing_variants: rows of an owner that is spelled in more than one case.
    """
    quartiles = exact_quantiles(repositories, "stars", [0.25, 0.75])
    bound = quartiles.agg(
        (F.max("quantile") + OUTLIER_RANGES * (F.max("quantile") - F.min("quantile"))).alias("bound")
    ).scalar()
    row_checks = {
        "missing_language": is_blank(F.col("language")),
        "created_not_before_updated": F.col("created_at") >= F.col("updated_at"),
        "star_outliers": F.col("stars") > bound,
    }
    counted = repositories.agg(*(F.count_if(hit).alias(name) for name, hit in row_checks.items()))
    lines = [F.struct(F.lit(name).alias("check_name"), F.col(name).alias("n_rows")) for name in row_checks]

    per_name = (
        repositories.filter(~is_blank(F.col("full_name")))
        .groupBy(F.trim("full_name").alias("full_name"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    duplicates = per_name.agg(F.sum(F.col("n") - 1).alias("n_rows"))

    per_spelling = (
        repositories.filter(F.col("owner").isNotNull())
        .groupBy("owner")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    per_owner = per_spelling.groupBy(F.lower("owner").alias("owner")).agg(
        F.count(F.lit(1)).alias("spellings"), F.sum("n").alias("n")
    )
    variants = per_owner.filter("spellings > 1").agg(F.sum("n").alias("n_rows"))

    return reduce(
        DataFrame.unionByName,
        [
            counted.select(F.inline(F.array(*lines))),
            _finding("duplicate_full_name", duplicates),
            _finding("owner_casing_variants", variants),
        ],
    )
