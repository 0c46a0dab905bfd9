"""Table contracts of every layer, and `conform`, which fits a frame to one of them.

Count columns are BIGINT: the contract calls them INTEGER, but of a kind with no 32-bit limit, and
a commit total summed over a very large log would overflow 32 bits.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from repovitals import fixed_values as fx
from repovitals.functions.text import clip

TEXT, COUNT, TIME = StringType(), LongType(), TimestampNTZType()

#: Marks a default that stands for "the time of the load".
LOAD_TIME = "load time"


@dataclass(frozen=True)
class Table:
    """One table: where it lives, how reports call it, and what its columns are."""

    key: str
    layer: str
    label: str
    schema: StructType
    widths: dict[str, int] = field(default_factory=dict)
    defaults: dict[str, Any] = field(default_factory=dict)


def _columns(*fields: tuple[str, DataType]) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


def _texts(*names: str) -> tuple[tuple[str, DataType], ...]:
    return tuple((name, TEXT) for name in names)


def _counts(*names: str) -> tuple[tuple[str, DataType], ...]:
    return tuple((name, COUNT) for name in names)


_REPOSITORY = (
    *_texts("data_source", "id", "name", "full_name", "owner", "language"),
    *_counts("stars", "forks"),
    ("html_url", TEXT),
    ("created_at", TIME),
    ("updated_at", TIME),
)
_CONTRIBUTORS = (
    *_texts("data_source", "repo_full_name", "contributor"),
    *_counts("total_commits", "recent_90_days_commits"),
)
_COMMITS = (
    *_texts("data_source", "repo"),
    *_counts("commits_30d", "commits_90d", "commits_180d"),
    ("last_commit_date", TIME),
)
_ISSUES = (
    *_texts("data_source", "repo"),
    *_counts("open_issues", "closed_issues", "issues_last_90d"),
)
_RELEASES = (
    *_texts("data_source", "repo"),
    *_counts("release_count"),
    ("last_release_date", TIME),
    *_counts("days_since_last_release"),
)
_LOADED = (("load_timestamp", TIME),)

# Column widths and column defaults of the table contracts.
_REPOSITORY_WIDTHS = {
    "data_source": 200,
    "id": 100,
    "name": 200,
    "full_name": 400,
    "owner": 200,
    "language": 100,
    "html_url": 500,
}
_CONTRIBUTOR_WIDTHS = {"repo_full_name": 400, "contributor": 200}
_REPO_WIDTHS = {"data_source": 200, "repo": 400}


def _zero(*names: str) -> dict[str, Any]:
    return {name: 0 for name in names}


_REPOSITORY_DEFAULTS = {**_zero("stars", "forks"), "load_timestamp": LOAD_TIME}
_CONTRIBUTOR_DEFAULTS = {
    **_zero("total_commits", "recent_90_days_commits"),
    "load_timestamp": LOAD_TIME,
}
_COMMIT_DEFAULTS = {
    **_zero("commits_30d", "commits_90d", "commits_180d"),
    "load_timestamp": LOAD_TIME,
}
_ISSUE_DEFAULTS = {
    **_zero("open_issues", "closed_issues", "issues_last_90d"),
    "load_timestamp": LOAD_TIME,
}
_RELEASE_DEFAULTS = {
    **_zero("release_count"),
    "days_since_last_release": fx.NO_RELEASE_AGE_DAYS,
    "load_timestamp": LOAD_TIME,
}

_ENTRYLINE = (
    *_REPOSITORY,
    *_COMMITS[2:],
    *_counts("total_contributors", "active_contributors_90d"),
    *_ISSUES[2:],
    *_RELEASES[2:],
    ("enriched_at", TIME),
)
_PRODUCT = (
    *_texts("data_source", "full_name", "language"),
    *_counts(
        "stars",
        "commits_90d",
        "active_contributors_90d",
        "days_since_last_release",
        "open_issues",
    ),
    ("risk_score", DoubleType()),
    ("risk_category", TEXT),
    ("last_updated", TIME),
)
_RUN_LOG = (
    *_texts("stream"),
    ("run_id", COUNT),
    *_texts("source", "pipeline_name", "stage", "status", "message"),
    ("ts", TIME),
)

TABLES: dict[str, Table] = {
    table.key: table
    for table in (
        Table(
            "raw_repositories", "RAW", "SRC_GIT_REPOSITORIES",
            _columns(*_REPOSITORY, *_LOADED), _REPOSITORY_WIDTHS, _REPOSITORY_DEFAULTS,
        ),
        Table(
            "raw_contributors", "RAW", "SRC_GIT_REPO_CONTRIBUTORS",
            _columns(*_CONTRIBUTORS, *_LOADED),
            {"data_source": 400, **_CONTRIBUTOR_WIDTHS}, _CONTRIBUTOR_DEFAULTS,
        ),
        Table(
            "raw_commits", "RAW", "SRC_GIT_REPO_COMMITS",
            _columns(*_COMMITS, *_LOADED), _REPO_WIDTHS, _COMMIT_DEFAULTS,
        ),
        Table(
            "raw_issues", "RAW", "SRC_GIT_REPO_ISSUES",
            _columns(*_ISSUES, *_LOADED), _REPO_WIDTHS, _ISSUE_DEFAULTS,
        ),
        Table(
            "raw_releases", "RAW", "SRC_GIT_REPO_RELEASES",
            _columns(*_RELEASES, *_LOADED), _REPO_WIDTHS, _RELEASE_DEFAULTS,
        ),
        Table(
            "stg_repositories", "STAGE", "STG_REPOSITORIES",
            _columns(*_REPOSITORY, *_LOADED, ("valid_flag", BooleanType()), ("invalid_reason", TEXT)),
            {**_REPOSITORY_WIDTHS, "invalid_reason": 500}, _REPOSITORY_DEFAULTS,
        ),
        Table(
            "hub_contributors", "LINKMAP", "HUB_REPO_CONTRIBUTORS",
            _columns(*_CONTRIBUTORS, *_LOADED),
            {"data_source": 200, **_CONTRIBUTOR_WIDTHS}, _CONTRIBUTOR_DEFAULTS,
        ),
        Table(
            "hub_commits", "LINKMAP", "HUB_REPO_COMMITS",
            _columns(*_COMMITS, *_LOADED), _REPO_WIDTHS, _COMMIT_DEFAULTS,
        ),
        Table(
            "hub_issues", "LINKMAP", "HUB_REPO_ISSUES",
            _columns(*_ISSUES, *_LOADED), _REPO_WIDTHS, _ISSUE_DEFAULTS,
        ),
        Table(
            "hub_releases", "LINKMAP", "HUB_REPO_RELEASES",
            _columns(*_RELEASES, *_LOADED), _REPO_WIDTHS, _RELEASE_DEFAULTS,
        ),
        Table(
            "repo_entryline", "ENRICH", "REPO_ENTRYLINE",
            _columns(*_ENTRYLINE), _REPOSITORY_WIDTHS,
            {
                **_zero(*(name for name, kind in _ENTRYLINE if kind == COUNT)),
                "days_since_last_release": fx.NO_RELEASE_AGE_DAYS,
                "enriched_at": LOAD_TIME,
            },
        ),
        Table(
            "risk_product", "CURATE", "RISK_ANALYSIS_DATA_PRODUCT",
            _columns(*_PRODUCT),
            {"data_source": 200, "full_name": 400, "language": 100, "risk_category": 20},
            {
                **_zero(*(name for name, kind in _PRODUCT if kind == COUNT)),
                "days_since_last_release": fx.NO_RELEASE_AGE_DAYS,
                "risk_score": 0.0,
                "last_updated": LOAD_TIME,
            },
        ),
        Table(
            "run_log", "ORCHESTRATION", "PIPELINE_LOG",
            _columns(*_RUN_LOG), {"pipeline_name": 50, "stage": 50, "status": 20, "message": 500},
            {"ts": LOAD_TIME},
        ),
    )
}

RAW_TABLES = tuple(key for key, table in TABLES.items() if table.layer == "RAW")
HUB_TABLES = tuple(key for key, table in TABLES.items() if table.layer == "LINKMAP")

#: One line of a landed event log.
EVENT_LINE = StructType(
    [
        StructField("type", TEXT),
        StructField("created_at", TEXT),
        StructField("repo", StructType([StructField("name", TEXT)])),
        StructField("actor", StructType([StructField("login", TEXT)])),
    ]
)

#: One item of a landed search page.
SEARCH_ITEM = StructType(
    [
        StructField("id", LongType()),
        StructField("full_name", TEXT),
        StructField("name", TEXT),
        StructField("owner", StructType([StructField("login", TEXT)])),
        StructField("language", TEXT),
        StructField("stargazers_count", LongType()),
        StructField("forks_count", LongType()),
        StructField("html_url", TEXT),
        StructField("created_at", TEXT),
        StructField("updated_at", TEXT),
        StructField("open_issues_count", LongType()),
        StructField("archived", BooleanType()),
        StructField("pushed_at", TEXT),
    ]
)


def conform(frame: DataFrame, table: Table, as_of) -> DataFrame:
    """Fit `frame` to a table contract: add absent columns with their default, cast, and order.

    A default fills a column that is absent; it does not replace a NULL the frame brings along.
    """
    present = set(frame.columns)
    columns: Iterable = []
    for wanted in table.schema.fields:
        if wanted.name in present:
            column = F.col(wanted.name).cast(wanted.dataType)
        else:
            default = table.defaults.get(wanted.name)
            column = (as_of if default == LOAD_TIME else F.lit(default)).cast(wanted.dataType)
        columns = [*columns, column.alias(wanted.name)]
    return frame.select(*columns)
