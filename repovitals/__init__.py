"""Layered repository-health analytics on Spark: ingest, cleanse, enrich, score, monitor, report."""

from repovitals.operators.activity import (
    commits_from_events,
    contributors_from_events,
    event_type_counts,
    event_type_maps,
    issues_from_events,
    repos_from_events,
)
from repovitals.operators.enrich import contributors_agg, enrich, frequent_names
from repovitals.operators.hubs import hub_commits, hub_contributors, hub_issues, hub_releases
from repovitals.operators.metrics import load_metrics
from repovitals.operators.quality import dq_findings, profile_repositories
from repovitals.operators.risk import risk_factors, risk_product
from repovitals.operators.search import issues_from_search, push_ages, repos_from_search, union_by_priority
from repovitals.operators.stage import cleanse_repositories, stage_repositories
from repovitals.plans.delta import DeltaLayers, refresh_changed
from repovitals.plans.monitoring import pipeline_status, status_section
from repovitals.plans.name_search import NameSearch
from repovitals.plans.refresh import refresh
from repovitals.plans.reports import (
    export_csv,
    report_all,
    report_by_language,
    report_export,
    report_repo,
    report_search,
    report_summary,
    report_top,
    report_top_display,
)
from repovitals.sources.colocated import enrich_colocated, write_colocated
from repovitals.sources.landing import read_event_log, read_search_pages, to_raw_repositories
from repovitals.sources.store import LayerStore, write_raw
from repovitals.streaming.arrivals import refresh_if_new, refresh_periodically
from repovitals.streaming.event_hours import EventHours
from repovitals.streaming.run_log import run_log_latest
from repovitals.streaming.search_pages import SearchPages
from repovitals.streaming.status_states import StatusStates

__all__ = [
    "DeltaLayers",
    "EventHours",
    "LayerStore",
    "NameSearch",
    "SearchPages",
    "StatusStates",
    "cleanse_repositories",
    "commits_from_events",
    "contributors_agg",
    "contributors_from_events",
    "dq_findings",
    "enrich",
    "enrich_colocated",
    "event_type_counts",
    "event_type_maps",
    "export_csv",
    "frequent_names",
    "hub_commits",
    "hub_contributors",
    "hub_issues",
    "hub_releases",
    "issues_from_events",
    "issues_from_search",
    "load_metrics",
    "pipeline_status",
    "profile_repositories",
    "push_ages",
    "read_event_log",
    "read_search_pages",
    "refresh",
    "refresh_changed",
    "refresh_if_new",
    "refresh_periodically",
    "report_all",
    "report_by_language",
    "report_export",
    "report_repo",
    "report_search",
    "report_summary",
    "report_top",
    "report_top_display",
    "repos_from_events",
    "repos_from_search",
    "risk_factors",
    "risk_product",
    "run_log_latest",
    "stage_repositories",
    "status_section",
    "to_raw_repositories",
    "union_by_priority",
    "write_colocated",
    "write_raw",
]
