"""Status report over all layers.

Every table is read once and reduced to one row per source, its profile. All sections are then lines
made from those few rows, so neither joins nor further scans are needed. Expressions are kept as SQL
text because there are some two hundred of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repovitals import fixed_values as fx
from repovitals.functions.numbers import mean, percentage
from repovitals.functions.text import blank
from repovitals.functions.times import stamp
from repovitals.schemas import TABLES

REPORTED = tuple(key for key in TABLES if key != "run_log")
TWO_DECIMALS = "decimal(18,2)"  # always two of them, also in text form


class Measure(NamedTuple):
    """One figure of a table: an aggregate (sum, count_if, min, max, distinct or mean) of an expression."""

    how: str
    of: str

    @property
    def sql(self) -> str:
        if self.how == "distinct":
            return f"count(distinct {self.of})"
        return mean(self.of) if self.how == "mean" else f"{self.how}({self.of})"


def _sum_if(condition: str) -> Measure:
    """Number of rows that meet the condition; NULL for no rows, unlike a count."""
    return Measure("sum", f"int({condition} is true)")


NONE = Measure("sum", "0")


def _in_category(name: str) -> str:
    return f"risk_category = '{name}'"


def _span(column: str) -> dict[str, Measure]:
    return {"oldest_record": Measure("min", column), "newest_record": Measure("max", column)}


#: What is measured per table and source beside the row count. `metric_1..3` are the table's own
#: figures, `last_load` its newest load, and the tallies and the average feed single sections.
MEASURES: dict[str, dict[str, Measure]] = {
    "raw_repositories": {
        **_span("created_at"),
        "metric_1": _sum_if(blank("id")),
        "metric_2": _sum_if("stars < 0"),
        "metric_3": _sum_if("forks < 0"),
    },
    "raw_contributors": {
        "metric_1": _sum_if(blank("contributor")),
        "metric_2": _sum_if("total_commits < 0"),
        "metric_3": _sum_if("recent_90_days_commits < 0"),
    },
    "raw_commits": {
        "metric_1": NONE,
        "metric_2": _sum_if("commits_30d < 0"),
        "metric_3": _sum_if("commits_90d < 0"),
    },
    "raw_issues": {
        "metric_1": NONE,
        "metric_2": _sum_if("open_issues < 0"),
        "metric_3": _sum_if("closed_issues < 0"),
    },
    "raw_releases": {
        "metric_1": NONE,
        "metric_2": _sum_if("release_count < 0"),
        "metric_3": _sum_if("days_since_last_release < 0"),
    },
    "stg_repositories": {
        **_span("created_at"),
        "metric_1": _sum_if("not valid_flag"),
        "metric_2": _sum_if("stars = 0"),
        "metric_3": _sum_if("forks = 0"),
        "last_load": Measure("max", "load_timestamp"),
        "tally_1": Measure("count_if", "valid_flag"),
        "tally_2": Measure("count_if", "not valid_flag"),
    },
    "hub_contributors": {
        "metric_1": Measure("distinct", "repo_full_name"),
        "metric_2": Measure("distinct", "contributor"),
        "metric_3": Measure("mean", "total_commits"),
        "last_load": Measure("max", "load_timestamp"),
    },
    "hub_commits": {
        **_span("last_commit_date"),
        "metric_1": Measure("distinct", "repo"),
        "metric_3": Measure("mean", "commits_90d"),
        "last_load": Measure("max", "load_timestamp"),
    },
    "hub_issues": {
        "metric_1": Measure("distinct", "repo"),
        "metric_3": Measure("mean", "open_issues + closed_issues"),
        "last_load": Measure("max", "load_timestamp"),
    },
    "hub_releases": {
        **_span("last_release_date"),
        "metric_1": Measure("distinct", "repo"),
        "metric_3": Measure("mean", "release_count"),
        "last_load": Measure("max", "load_timestamp"),
    },
    "repo_entryline": {
        **_span("created_at"),
        "metric_1": Measure("distinct", "language"),
        "metric_2": Measure("mean", "stars"),
        "metric_3": Measure("mean", "commits_90d"),
        "last_load": Measure("max", "enriched_at"),
        "tally_1": Measure("count_if", "commits_90d = 0"),
        "tally_2": Measure("count_if", "active_contributors_90d = 0"),
        "tally_3": Measure("count_if", "release_count = 0"),
    },
    "risk_product": {
        **_span("last_updated"),
        "metric_1": Measure("distinct", "risk_category"),
        "metric_2": Measure("mean", "risk_score"),
        "metric_3": _sum_if(_in_category(fx.HIGH)),
        "last_load": Measure("max", "last_updated"),
        "tally_1": Measure("count_if", _in_category(fx.HIGH)),
        "tally_2": Measure("count_if", _in_category(fx.MEDIUM)),
        "tally_3": Measure("count_if", _in_category(fx.LOW)),
        "average": Measure("mean", "risk_score"),
    },
}
MEASURE_TYPES = {
    "oldest_record": "timestamp_ntz",
    "newest_record": "timestamp_ntz",
    "metric_1": "double",
    "metric_2": "double",
    "metric_3": "double",
    "last_load": "timestamp_ntz",
    "tally_1": "bigint",
    "tally_2": "bigint",
    "tally_3": "bigint",
    "average": TWO_DECIMALS,
}


#: Tables whose row counts the flow section sets beside those of the layer before.
FLOW_TARGETS = {"stg_repositories": "staged", "repo_entryline": "enriched", "risk_product": "curated"}


def _measured(table: DataFrame, measures: dict[str, Measure], apart: bool) -> DataFrame:
    """The measures per source. apart: each DISTINCT count after the first is made by itself.

    Two of them together would multiply all rows before they are shuffled. A NULL source is a
    group like any other when the parts, one row per source each, are laid over one another.
    """
    distinct = [name for name, measure in measures.items() if measure.how == "distinct"][1:] if apart else []

    def grouped(names: list[str], *more: str) -> DataFrame:
        columns = [F.expr(text) for text in more] + [F.expr(f"{measures[name].sql} as {name}") for name in names]
        return table.groupBy("data_source").agg(*columns)

    parts = [grouped([name for name in measures if name not in distinct], "count(1) as record_count")]
    parts += [grouped([name]) for name in distinct]
    if len(parts) == 1:
        return parts[0]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.groupBy("data_source").agg(*(F.max(name).alias(name) for name in ["record_count", *measures]))


def profile_rows(key: str, counted: DataFrame) -> DataFrame:
    """A table's measures per source as rows of the profile."""
    return counted.selectExpr(
        f"'{key}' as table_key",
        f"'{TABLES[key].layer}' as layer",
        f"'{TABLES[key].label}' as table_name",
        "data_source",
        "record_count",
        *(
            f"cast({name if name in MEASURES[key] else 'null'} as {kind}) as {name}"
            for name, kind in MEASURE_TYPES.items()
        ),
    )


def table_profile(
    tables: dict[str, DataFrame], keys: Iterable[str] = REPORTED, apart: bool = False
) -> DataFrame:
    """One row per table and source with every measure; those a report does not use are pruned.

    apart: see `_measured`; for reports that use several DISTINCT counts of a table.
    """
    return reduce(DataFrame.union, (profile_rows(key, _measured(tables[key], MEASURES[key], apart)) for key in keys))


def status_table_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count, time span and three figures per table and source."""
    return stats_of(table_profile(tables, apart=True))


def stats_of(profile: DataFrame) -> DataFrame:
    return profile.select(
        "layer", "table_name", "data_source", "record_count",
        "oldest_record", "newest_record", "metric_1", "metric_2", "metric_3",
    )


# A section is a list of (table key, columns of a line): each profile row of that table gives one
# line with these columns.
Line = tuple[str, dict[str, str]]


#: Gives the profile of the tables that are asked for.
Profiles = Callable[[list[str]], DataFrame]


def _read_profile(tables: dict[str, DataFrame]) -> Profiles:
    return lambda keys: table_profile(tables, keys)


def _lines(profiles: Profiles, lines: list[Line], *, flow: bool = False) -> DataFrame:
    """The lines as rows. Only the tables they are made from are read."""
    needed = {key for key, _ in lines} | (set(FLOW_TARGETS) if flow else set())
    profile = profiles([key for key in REPORTED if key in needed])
    made = (
        f"case when table_key = '{key}' then struct("
        + ", ".join(f"{text} as {name}" for name, text in columns.items())
        + ") end"
        for key, columns in lines
    )
    line = f"inline(array_compact(array({', '.join(made)})))"
    return (_with_flow(profile) if flow else profile).selectExpr(line)


def _looked_up(count: str) -> str:
    """A NULL source equals no source, not even itself, so counts looked up for it are 0."""
    return f"if(data_source is null, 0, {count})"


def _with_flow(profile: DataFrame) -> DataFrame:
    """Add the row counts of the later layers to each row, 0 where they lack its source.

    The window holds the profile rows of one source, at most one per table.
    """
    return profile.selectExpr(
        "*",
        *(
            f"max(if(table_key = '{key}', record_count, 0)) over (partition by data_source) as {name}"
            for key, name in FLOW_TARGETS.items()
        ),
    )


def _flow_lines() -> list[Line]:
    def line(key: str, order: int, text: str, before: str, after: str) -> Line:
        source_value, target_value = _looked_up(before), _looked_up(after)
        return key, {
            "display_order": str(order),
            "data_source": "data_source",
            "description": f"'{text}'",
            "source_value": source_value,
            "target_value": target_value,
            "percent_complete": f"cast({percentage(target_value, source_value)} as {TWO_DECIMALS})",
        }

    return [
        line("raw_repositories", 1, fx.FLOW_RAW_TO_STAGE, "record_count", "staged"),
        line("stg_repositories", 2, fx.FLOW_STAGE_TO_ENRICH, "tally_1", "enriched"),
        line("repo_entryline", 3, fx.FLOW_ENRICH_TO_CURATE, "record_count", "curated"),
    ]


def _load_lines() -> list[Line]:
    return [
        (
            key,
            {
                "layer": "layer",
                "metric_name": f"'{label}'",
                "data_source": "data_source",
                "metric_value": "last_load",
                "record_count": "record_count",
            },
        )
        for key, label in fx.LAST_LOAD_LABELS.items()
    ]


def _share_line(key: str, name: str, hits: str, rows: str) -> Line:
    return key, {
        "metric_name": f"'{name}'",
        "data_source": "data_source",
        "metric_value": hits,
        "metric_percent": f"cast({percentage(hits, rows)} as {TWO_DECIMALS})",
    }


def _quality_lines() -> list[Line]:
    found = (
        ("stg_repositories", fx.QUALITY_INVALID, "tally_2"),
        ("repo_entryline", fx.QUALITY_NO_COMMITS, "tally_1"),
        ("repo_entryline", fx.QUALITY_NO_CONTRIBUTORS, "tally_2"),
        ("repo_entryline", fx.QUALITY_NO_RELEASES, "tally_3"),
    )
    return [
        _share_line(key, name, _looked_up(tally), _looked_up("record_count"))
        for key, name, tally in found
    ]


def _risk_lines() -> list[Line]:
    """Counts and the average share a column, so both are text: '12' and '57.47'."""
    categories = ((fx.RISK_HIGH, "tally_1"), (fx.RISK_MEDIUM, "tally_2"), (fx.RISK_LOW, "tally_3"))
    lines = [_share_line("risk_product", name, tally, "record_count") for name, tally in categories]
    average = _share_line("risk_product", fx.RISK_AVERAGE, "average", "record_count")
    average[1]["metric_percent"] = f"cast(null as {TWO_DECIMALS})"
    lines.append(average)
    return [
        (key, {**line, "metric_value": f"cast({line['metric_value']} as string)"})
        for key, line in lines
    ]


def _as_double(frame: DataFrame, column: str) -> DataFrame:
    return frame.withColumn(column, F.col(column).cast("double"))


def status_data_flow(tables: dict[str, DataFrame]) -> DataFrame:
    """How many rows each layer passed on to the next, per source of the earlier layer."""
    flow = _lines(_read_profile(tables), _flow_lines(), flow=True)
    return _as_double(flow, "percent_complete")


def status_last_loads(tables: dict[str, DataFrame]) -> DataFrame:
    """Newest load and row count per table and source."""
    return _lines(_read_profile(tables), _load_lines())


def status_quality(tables: dict[str, DataFrame]) -> DataFrame:
    """Invalid rows and inactive repositories per source."""
    return _as_double(_lines(_read_profile(tables), _quality_lines()), "metric_percent")


def status_risk(tables: dict[str, DataFrame]) -> DataFrame:
    """Category counts and average score per source."""
    return _as_double(_lines(_read_profile(tables), _risk_lines()), "metric_percent")


def _report_line(order: int, section: str, **columns: str) -> dict[str, str]:
    """A line of the whole report; columns that are not given are NULL."""
    return {
        "section_order": str(order),
        "section_name": f"'{section}'",
        "layer": "cast(null as string)",
        "table_name": "cast(null as string)",
        "data_source": "data_source",
        "metric_name": "",
        "metric_value": "",
        "metric_percent": "cast(null as string)",
        "oldest_record": "cast(null as timestamp_ntz)",
        "newest_record": "cast(null as timestamp_ntz)",
        **columns,
    }


def _percent(text: str) -> str:
    return f"concat(cast({text} as string), '%')"


def _report_sections() -> dict[str, list[Line]]:
    tables = [
        (
            key,
            _report_line(
                1, fx.SECTION_TABLES, layer="layer", table_name="table_name",
                metric_name=f"'{fx.METRIC_RECORD_COUNT}'",
                metric_value="cast(record_count as string)",
                oldest_record="oldest_record", newest_record="newest_record",
            ),
        )
        for key in REPORTED
    ]
    flow = [
        (
            key,
            _report_line(
                2, fx.SECTION_FLOW, metric_name=line["description"],
                metric_value=f"concat({line['source_value']}, ' → ', {line['target_value']})",
                metric_percent=_percent(line["percent_complete"]),
            ),
        )
        for key, line in _flow_lines()
    ]
    loads = [
        (
            key,
            _report_line(
                3, fx.SECTION_LOADS, layer="layer", metric_name=line["metric_name"],
                metric_value=stamp(line["metric_value"]),
                metric_percent=f"concat({line['record_count']}, ' records')",
            ),
        )
        for key, line in _load_lines()
    ]

    def shares(order: int, section: str, lines: list[Line]) -> list[Line]:
        return [
            (
                key,
                _report_line(
                    order, section, metric_name=line["metric_name"],
                    metric_value=f"cast({line['metric_value']} as string)",
                    metric_percent=_percent(line["metric_percent"]),
                ),
            )
            for key, line in lines
        ]

    return {
        fx.SECTION_TABLES: tables,
        fx.SECTION_FLOW: flow,
        fx.SECTION_LOADS: loads,
        fx.SECTION_QUALITY: shares(4, fx.SECTION_QUALITY, _quality_lines()),
        fx.SECTION_RISK: shares(5, fx.SECTION_RISK, _risk_lines()),
    }


def report_of(profiles: Profiles, sections: Iterable[str] | None = None) -> DataFrame:
    """The report, or some sections of it, from profiles of the tables."""
    made = _report_sections()
    sections = tuple(made if sections is None else sections)
    lines = [line for section in sections for line in made[section]]
    order = ("section_order", "data_source", "layer", "table_name", "metric_name")
    report = _lines(profiles, lines, flow=fx.SECTION_FLOW in sections)
    return report.orderBy(*(F.col(name).asc_nulls_last() for name in order))


def pipeline_status(tables: dict[str, DataFrame]) -> DataFrame:
    """The whole report: five sections as text, in one ten-column frame, sorted."""
    return report_of(_read_profile(tables))


def status_section(tables: dict[str, DataFrame], section: str) -> DataFrame:
    """One section of the report, made from the tables it is about only."""
    if section not in _report_sections():
        raise ValueError(f"unknown section: {section!r}")
    return report_of(_read_profile(tables), (section,))


def create_status_view(tables: dict[str, DataFrame], name: str = "pipeline_status") -> None:
    """Make the report available to SQL; it is computed anew for each query."""
    pipeline_status(tables).createOrReplaceTempView(name)
