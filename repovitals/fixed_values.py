"""Constants that a result must carry unchanged.

Everything here is data, not logic. Defaults, thresholds, weights, table labels, report texts and
log texts are kept together so that the operators themselves hold no literals.
"""

from decimal import Decimal

# --- fixed values: source and placeholders -------------------------------------------------
SOURCE = "git_hub"
NO_NAME = "UNKNOWN"
NO_REPOSITORY = "UNKNOWN/UNKNOWN"
NO_OWNER = "UNKNOWN"
NO_LANGUAGE = "Unknown"
NO_CONTRIBUTOR = "unknown_contributor"
NO_URL = "https://github.com/UNKNOWN"
REPOSITORY_URL_PREFIX = "https://github.com/"
EVENT_OWNER_FALLBACK = "unknown"
EVENT_ID_PREFIX = "gh_"
LANGUAGE_DISPLAY_FALLBACK = "N/A"
NO_RELEASE_DATE = "1970-01-01 00:00:00"
NO_RELEASE_AGE_DAYS = 999
CREATED_BACKFILL_DAYS = 365

# --- fixed values: validity reasons, first match wins --------------------------------------
REASON_NO_ID = "Missing ID"
REASON_NO_NAME = "Missing Name"
REASON_NO_FULL_NAME = "Missing Full Name"
REASON_NEGATIVE_STARS = "Negative Stars Count"
REASON_NEGATIVE_FORKS = "Negative Forks Count"
REASON_NONE = "Valid"

# --- fixed values: risk bands as (threshold, factor), first match wins ---------------------
STAR_BANDS = ((10000, "0.0"), (1000, "0.2"), (100, "0.4"), (10, "0.6"), (1, "0.8"))
COMMIT_BANDS = ((100, "0.0"), (50, "0.2"), (20, "0.4"), (5, "0.6"), (1, "0.8"))
CONTRIBUTOR_BANDS = ((10, "0.0"), (5, "0.2"), (3, "0.4"), (1, "0.6"))
RELEASE_AGE_BANDS = ((30, "0.0"), (90, "0.3"), (180, "0.6"), (365, "0.8"))
OPEN_ISSUE_BANDS = ((5, "0.2"), (10, "0.4"), (20, "0.6"), (50, "0.8"))
NO_OPEN_ISSUES_FACTOR = "0.0"
WORST_FACTOR = "1.0"

# --- fixed values: weights and categories --------------------------------------------------
STAR_WEIGHT = Decimal("0.15")
COMMIT_WEIGHT = Decimal("0.25")
CONTRIBUTOR_WEIGHT = Decimal("0.20")
RELEASE_WEIGHT = Decimal("0.25")
ISSUE_WEIGHT = Decimal("0.15")
HIGH_FROM = 70
MEDIUM_FROM = 40
HIGH = "HIGH"
MEDIUM = "MEDIUM"
LOW = "LOW"

# --- fixed values: event types and push recency --------------------------------------------
PUSH_EVENT = "PushEvent"
ISSUE_EVENTS = ("IssuesEvent", "IssueCommentEvent")
PUSH_RECENCY_DAYS = (30, 90)

# --- fixed values: report sizes and texts --------------------------------------------------
TOP_N = 10
TOP_LANGUAGES = 15
SEARCH_LIMIT = 20
ALL_REPORTS_TOP_N = 15
NAME_DISPLAY_MAX = 40
NAME_DISPLAY_KEEP = 38
NAME_DISPLAY_SUFFIX = ".."
INTERPRETATION_HIGH = (
    "HIGH RISK: This repository shows significant risk factors. "
    "Consider finding alternatives or closely monitoring usage."
)
INTERPRETATION_MEDIUM = (
    "MEDIUM RISK: Some concerns identified. Monitor regularly and have contingency plans."
)
INTERPRETATION_LOW = (
    "LOW RISK: Repository appears healthy and well-maintained. "
    "Suitable for production use with standard monitoring."
)

# --- fixed values: status report labels ----------------------------------------------------
SECTION_TABLES = "Table Statistics"
SECTION_FLOW = "Data Pipeline Flow"
SECTION_LOADS = "Last Load Timestamps"
SECTION_QUALITY = "Data Quality"
SECTION_RISK = "Risk Analysis"
METRIC_RECORD_COUNT = "Record Count"
FLOW_RAW_TO_STAGE = "RAW to STAGE"
FLOW_STAGE_TO_ENRICH = "STAGE to ENRICH"
FLOW_ENRICH_TO_CURATE = "ENRICH to CURATE"
LAST_LOAD_LABELS = {
    "stg_repositories": "Last STG_REPOSITORIES Load",
    "hub_contributors": "Last HUB_REPO_CONTRIBUTORS Load",
    "hub_commits": "Last HUB_REPO_COMMITS Load",
    "hub_issues": "Last HUB_REPO_ISSUES Load",
    "hub_releases": "Last HUB_REPO_RELEASES Load",
    "repo_entryline": "Last ENRICH Load",
    "risk_product": "Last CURATE Load",
}
QUALITY_INVALID = "Invalid Records in Stage"
QUALITY_NO_COMMITS = "Repos with No Recent Commits"
QUALITY_NO_CONTRIBUTORS = "Repos with No Active Contributors"
QUALITY_NO_RELEASES = "Repos with No Releases"
RISK_HIGH = "High Risk Repositories"
RISK_MEDIUM = "Medium Risk Repositories"
RISK_LOW = "Low Risk Repositories"
RISK_AVERAGE = "Average Risk Score"

# --- fixed values: run log -----------------------------------------------------------------
PIPELINE = "GITHUB_RISK"
STAGE_CHECK = "CHECK_STREAM"
STAGE_RUN = "FULL_PIPELINE"
STATUS_SKIPPED = "SKIPPED"
STATUS_STARTED = "STARTED"
STATUS_COMPLETED = "COMPLETED"
STATUS_ERROR = "ERROR"
MESSAGE_SKIPPED = "No new data in stream, skipping pipeline execution"
MESSAGE_STARTED = "New data detected, starting pipeline execution"
MESSAGE_COMPLETED = "Pipeline completed successfully for new data"
MESSAGE_ERROR_PREFIX = "Pipeline failed: "
REFRESH_INTERVAL = "2 minutes"
