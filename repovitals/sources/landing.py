"""Landed files: gzip event logs and search pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from repovitals import fixed_values as fx
from repovitals.functions.text import clip
from repovitals.schemas import EVENT_LINE, SEARCH_ITEM, TABLES

CORRUPT = "_corrupt"
_PAGE = StructType([StructField("items", ArrayType(SEARCH_ITEM))])
_NAMED_PAGE = StructType([StructField("page", StringType()), *_PAGE.fields])


def read_event_log(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Events of all landed JSON-lines files below `paths` (plain or gzip); bad lines are skipped.

    A gzip file cannot be split, so one task reads one file. The aggregation that follows combines
    events in that task before anything is shuffled; spreading the raw lines first would cost more.
    Paths may hold globs, and hours that never landed are simply not matched.
    """
    return known_events(_event_options(spark.read).json(paths))


def stream_event_log(spark: SparkSession, paths: str) -> DataFrame:
    """The same as a stream of the files that land below `paths` (which may hold globs).

    A file is known by its name: an hour that lands again, in whichever folder, is not read again.
    """
    return known_events(_event_options(spark.readStream).option("fileNameOnly", True).json(paths))


def _event_options(reader):
    return (
        reader.schema(StructType([*EVENT_LINE.fields, StructField(CORRUPT, StringType())]))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )


def known_events(lines: DataFrame) -> DataFrame:
    """Lines that are events, as read with CORRUPT beside the fields of an event."""
    # Naming every field keeps Spark from skipping some while parsing: which lines are bad must not
    # depend on the columns a query asks for. A line with none of the fields is no event.
    known = reduce(Column.__or__, (F.col(field.name).isNotNull() for field in EVENT_LINE.fields))
    return lines.filter(F.col(CORRUPT).isNull() & known).drop(CORRUPT)


def read_search_pages(spark: SparkSession, paths: str | list[str], packed: bool = False) -> DataFrame:
    """Landed search responses, one JSON document per file, ordered by path.

    Numbers in the path count as numbers: page_2 comes before page_10. Files of equal name in several
    folders are told apart, and ordered, by their whole paths.

    packed: files hold many pages, a JSON document in each line with the page's name in `page`. The name takes
    the place of the path; pages of equal name are ordered by path. So a large crawl is not as many files.
    """
    return _placed_pages(_page_options(spark.read, packed).json(paths), packed)


def stream_search_pages(spark: SparkSession, paths: str, packed: bool = False) -> DataFrame:
    """The same as a stream of the files that land below `paths`; a file is known by its whole path."""
    return _placed_pages(_page_options(spark.readStream, packed).json(paths), packed)


def _page_options(reader, packed: bool):
    return reader.schema(_NAMED_PAGE) if packed else reader.schema(_PAGE).option("multiLine", True)


def _placed_pages(pages: DataFrame, packed: bool) -> DataFrame:
    path = F.col("_metadata.file_path")
    return pages.select(_page_order(F.col("page") if packed else path, path).alias("page"), "items")


def _page_order(name: Column, path: Column) -> Column:
    """The name with each number behind its number of digits, so that text order is number order; then the path."""
    parts = F.regexp_extract_all(name, F.lit("[0-9]+|[^0-9]+"), F.lit(0))

    def sortable(part: Column) -> Column:
        digits = F.ltrim(part, F.lit("0"))
        return F.when(part.rlike("^[0-9]"), F.concat(F.lpad(F.length(digits).cast("string"), 5, "0"), digits)).otherwise(part)

    return F.struct(F.array_join(F.transform(parts, sortable), "").alias("order"), path.alias("path"))


def too_wide(frame: DataFrame, widths: dict[str, int]) -> DataFrame:
    """One row with the number of values of each column that are wider than the table they go to."""
    return frame.agg(
        *(F.count_if(F.length(name) > width).alias(name) for name, width in widths.items() if name in frame.columns)
    )


def named_language(language: Column) -> Column:
    """A missing language is named so."""
    return F.when(language.isNull() | (language == ""), fx.NO_LANGUAGE).otherwise(language)


def fit_columns(frame: DataFrame, widths: dict[str, int]) -> DataFrame:
    """Cut text columns to the widths of the table they go to; a missing language is named so."""
    columns = {name: clip(F.col(name), width) for name, width in widths.items()}
    if "language" in columns:
        columns["language"] = clip(named_language(F.col("language")), widths["language"])
    return frame.withColumns({name: columns[name] for name in frame.columns if name in columns})


def to_raw_repositories(repositories: DataFrame, source: str = fx.SOURCE) -> DataFrame:
    """Repositories from events or search pages in the form of the raw repositories table.

    What the input does not carry stays absent and takes the table's default when it is written;
    activity figures are never made up.
    """
    table = TABLES["raw_repositories"]
    frame = repositories.withColumn("data_source", F.lit(source))
    if "language" not in frame.columns:
        frame = frame.withColumn("language", F.lit(None).cast("string"))
    known = [name for name in table.schema.names if name in frame.columns]
    return frame.select(*known).withColumn("language", named_language(F.col("language")))
