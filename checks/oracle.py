"""Independent SQL for every registered query, for DuckDB over the given parquet tables.

Written apart from the library and on other principles where that is possible: scores and
percentages are whole-number arithmetic here, sections of the status report are plain unions, and
nothing is shared with the package but the results.
"""

from __future__ import annotations

AS_OF = "timestamp '2001-11-05 00:00:00'"
EVENTS_AS_OF = "timestamp '2024-02-10 00:00:00'"


def _recent(days: int) -> str:
    return f"moment <= {EVENTS_AS_OF} and moment > {EVENTS_AS_OF} - interval {days} day"


CTES: dict[str, str] = {}

# ---- raw tables, derived from the given tables --------------------------------------------

CTES["newest"] = "select max(l_shipdate) as d from lineitem"

CTES["raw_repositories"] = f"""
select if(p_partkey % 20 = 7, 'git_lab', 'git_hub') as data_source,
  if(p_partkey % 41 = 5, '', p_partkey::varchar) as id,
  if(p_partkey % 43 = 6, '  ', ' ' || p_name) as name,
  if(p_partkey % 47 = 8, null, p_brand || '/repo-' || p_partkey) as full_name,
  case when p_partkey % 19 = 1 then upper(p_brand) when p_partkey % 23 = 1 then '' else p_brand end as owner,
  case p_partkey % 10 when 9 then '' when 8 then null else p_type end as language,
  (case when p_partkey % 53 = 4 then -1 when p_partkey % 59 = 3 then null
        when p_partkey % 3 = 0 then p_partkey % 15 else (p_partkey * 7919) % 12000 end)::bigint as stars,
  if(p_partkey % 61 = 2, -5, p_size)::bigint as forks,
  if(p_partkey % 11 = 0, null, 'https://example.org/' || p_partkey) as html_url,
  if(p_partkey % 67 = 1, null, timestamp '1994-01-01 00:00:00') as created_at,
  case when p_partkey % 13 = 1 then null when p_partkey % 17 = 2 then timestamp '1994-01-01 00:00:00'
       else timestamp '2000-01-01 00:00:00' end as updated_at,
  {AS_OF} as load_timestamp
from part
union all
select 'git_hub', p_partkey || '_dup', p_name, '  ' || p_brand || '/repo-' || p_partkey || ' ', p_brand, p_type,
  ((p_partkey * 7919) % 12000)::bigint, p_size::bigint, 'https://example.org/' || p_partkey,
  timestamp '1995-01-01 00:00:00', timestamp '2001-01-01 00:00:00', {AS_OF}
from part where p_partkey % 25 = 3"""

CTES["raw_contributors"] = f"""
select if(l_suppkey % 31 = 4, 'git_lab', 'git_hub') as data_source,
  p_brand || '/repo-' || p_partkey as repo_full_name,
  if(l_suppkey % 29 = 3, ' ', 'contributor_' || l_suppkey) as contributor,
  if((p_partkey + l_suppkey) % 97 = 5, -3, sum(l_quantity))::bigint as total_commits,
  (case when (p_partkey + l_suppkey) % 89 = 6 then 100000 when (p_partkey + l_suppkey) % 83 = 2 then -1
    else coalesce(sum(l_quantity) filter (l_shipdate > d - interval 90 day), 0) end)::bigint as recent_90_days_commits,
  {AS_OF} as load_timestamp
from lineitem join part on l_partkey = p_partkey, newest
group by p_brand, p_partkey, l_suppkey"""

CTES["raw_commits"] = f"""
select 'git_hub' as data_source,
  if(p_partkey % 71 = 3, '', p_brand || '/repo-' || p_partkey) as repo,
  if(p_partkey % 41 = 3, 5000, coalesce(sum(l_quantity) filter (l_shipdate > d - interval 30 day), 0))::bigint as commits_30d,
  if(p_partkey % 37 = 2, -1, coalesce(sum(l_quantity) filter (l_shipdate > d - interval 90 day), 0))::bigint as commits_90d,
  coalesce(sum(l_quantity) filter (l_shipdate > d - interval 180 day), 0)::bigint as commits_180d,
  if(p_partkey % 29 = 1, null, max(l_shipdate)) as last_commit_date,
  {AS_OF} as load_timestamp
from lineitem join part on l_partkey = p_partkey, newest
group by p_brand, p_partkey"""

CTES["raw_issues"] = f"""
select 'git_hub' as data_source, p_brand || '/repo-' || p_partkey as repo,
  (case when p_partkey % 43 = 7 then -2 when p_partkey % 5 = 0 then 0 when p_partkey % 7 = 0 then 75
    else count(*) filter (o_orderstatus = 'O') end)::bigint as open_issues,
  count(*) filter (o_orderstatus = 'F') as closed_issues,
  count(*) as issues_last_90d,
  {AS_OF} as load_timestamp
from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey
group by p_brand, p_partkey"""

CTES["raw_releases"] = f"""
select 'git_hub' as data_source, p_brand || '/repo-' || p_partkey as repo,
  if(p_partkey % 73 = 4, -1, count(*))::bigint as release_count,
  if(p_partkey % 29 = 2, null, max(l_shipdate)) as last_release_date,
  if(p_partkey % 31 = 9, -1, datediff('day', max(l_shipdate), max(d)))::bigint as days_since_last_release,
  {AS_OF} as load_timestamp
from lineitem join part on l_partkey = p_partkey, newest
where l_returnflag = 'R' and p_partkey % 17 <> 0
group by p_brand, p_partkey"""

# ---- stage and hubs -----------------------------------------------------------------------

CTES["cleansed"] = f"""
select data_source, trim(id) as id,
  coalesce(nullif(trim(name), ''), 'UNKNOWN') as name,
  coalesce(nullif(trim(full_name), ''), 'UNKNOWN/UNKNOWN') as full_name,
  coalesce(nullif(trim(owner), ''), 'UNKNOWN') as owner,
  coalesce(nullif(trim(language), ''), 'Unknown') as language,
  if(stars < 0, 0, stars) as stars, if(forks < 0, 0, forks) as forks,
  coalesce(nullif(trim(html_url), ''), 'https://github.com/UNKNOWN') as html_url,
  coalesce(created_at, {AS_OF} - interval 365 day) as created_at,
  coalesce(updated_at, created_at, {AS_OF}) as updated_at,
  {AS_OF} as load_timestamp,
  coalesce(trim(id) <> '', false) and coalesce(trim(name) <> '', false) and coalesce(trim(full_name) <> '', false)
    and coalesce(least(stars, forks) >= 0 and stars is not null and forks is not null, false) as valid_flag,
  case when coalesce(trim(id), '') = '' then 'Missing ID' when coalesce(trim(name), '') = '' then 'Missing Name'
       when coalesce(trim(full_name), '') = '' then 'Missing Full Name' when stars < 0 then 'Negative Stars Count'
       when forks < 0 then 'Negative Forks Count' else 'Valid' end as invalid_reason
from raw_repositories where data_source = 'git_hub'"""

CTES["stg_repositories"] = """
select * from cleansed
qualify row_number() over (partition by full_name order by updated_at desc, id nulls last, name, owner, language,
  stars nulls last, forks nulls last, html_url, created_at, valid_flag, invalid_reason) = 1"""

CTES["hub_contributors"] = f"""
select data_source, coalesce(nullif(trim(repo_full_name), ''), 'UNKNOWN/UNKNOWN') as repo_full_name,
  coalesce(nullif(trim(contributor), ''), 'unknown_contributor') as contributor,
  if(total_commits < 0, 0, total_commits) as total_commits,
  if(recent_90_days_commits < 0, 0, if(recent_90_days_commits > total_commits, total_commits, recent_90_days_commits))
    as recent_90_days_commits,
  {AS_OF} as load_timestamp
from raw_contributors where data_source = 'git_hub'"""

CTES["hub_commits"] = f"""
select data_source, coalesce(nullif(trim(repo), ''), 'UNKNOWN/UNKNOWN') as repo,
  if(commits_30d < 0, 0, if(commits_30d > commits_90d, commits_90d, commits_30d)) as commits_30d,
  if(commits_90d < 0, 0, if(commits_90d > commits_180d, commits_180d, commits_90d)) as commits_90d,
  if(commits_180d < 0, 0, commits_180d) as commits_180d,
  coalesce(last_commit_date, {AS_OF}) as last_commit_date,
  {AS_OF} as load_timestamp
from raw_commits where data_source = 'git_hub'"""

CTES["hub_issues"] = f"""
select data_source, coalesce(nullif(trim(repo), ''), 'UNKNOWN/UNKNOWN') as repo,
  if(open_issues < 0, 0, open_issues) as open_issues, if(closed_issues < 0, 0, closed_issues) as closed_issues,
  if(issues_last_90d < 0, 0, if(issues_last_90d > open_issues + closed_issues, open_issues + closed_issues, issues_last_90d))
    as issues_last_90d,
  {AS_OF} as load_timestamp
from raw_issues where data_source = 'git_hub'"""

CTES["hub_releases"] = f"""
select data_source, coalesce(nullif(trim(repo), ''), 'UNKNOWN/UNKNOWN') as repo,
  if(release_count < 0, 0, release_count) as release_count,
  coalesce(last_release_date, timestamp '1970-01-01 00:00:00') as last_release_date,
  if(days_since_last_release < 0, 999, days_since_last_release) as days_since_last_release,
  {AS_OF} as load_timestamp
from raw_releases where data_source = 'git_hub'"""

# ---- enrich and curate --------------------------------------------------------------------

CTES["contributors_agg"] = """
select repo_full_name, count(distinct contributor) as total_contributors,
  count(distinct contributor) filter (recent_90_days_commits > 0) as active_contributors_90d
from hub_contributors group by repo_full_name"""

CTES["repo_entryline"] = f"""
select s.data_source, s.id, s.name, s.full_name, s.owner, s.language, s.stars, s.forks, s.html_url, s.created_at, s.updated_at,
  coalesce(c.commits_30d, 0) as commits_30d, coalesce(c.commits_90d, 0) as commits_90d,
  coalesce(c.commits_180d, 0) as commits_180d, c.last_commit_date,
  coalesce(a.total_contributors, 0) as total_contributors, coalesce(a.active_contributors_90d, 0) as active_contributors_90d,
  coalesce(i.open_issues, 0) as open_issues, coalesce(i.closed_issues, 0) as closed_issues,
  coalesce(i.issues_last_90d, 0) as issues_last_90d,
  coalesce(r.release_count, 0) as release_count, r.last_release_date,
  coalesce(r.days_since_last_release, 999) as days_since_last_release,
  {AS_OF} as enriched_at
from stg_repositories s
left join contributors_agg a on a.repo_full_name = s.full_name
left join hub_commits c on c.repo = s.full_name
left join hub_issues i on i.repo = s.full_name
left join hub_releases r on r.repo = s.full_name
where s.valid_flag"""

# What a second appending run enriches: every table then holds two copies, and each meets each.
CTES["twice"] = """
select full_name, 2 * if(full_name in (select repo from hub_commits), 2, 1)
  * if(full_name in (select repo from hub_issues), 2, 1) * if(full_name in (select repo from hub_releases), 2, 1) as copies
from repo_entryline"""

# Factors in tenths: each threshold that is passed takes its share off the worst factor, 10.
CTES["factor_tenths"] = """
select *,
  10 - 2 * coalesce((stars >= 1)::int + (stars >= 10)::int + (stars >= 100)::int + (stars >= 1000)::int + (stars >= 10000)::int, 0) as f_stars,
  10 - 2 * coalesce((commits_90d >= 1)::int + (commits_90d >= 5)::int + (commits_90d >= 20)::int + (commits_90d >= 50)::int + (commits_90d >= 100)::int, 0) as f_commits,
  10 - coalesce(4 * (active_contributors_90d >= 1)::int + 2 * (active_contributors_90d >= 3)::int + 2 * (active_contributors_90d >= 5)::int + 2 * (active_contributors_90d >= 10)::int, 0) as f_contributors,
  10 - coalesce(2 * (days_since_last_release <= 365)::int + 2 * (days_since_last_release <= 180)::int + 3 * (days_since_last_release <= 90)::int + 3 * (days_since_last_release <= 30)::int, 0) as f_release,
  10 - 2 * coalesce((open_issues <= 50)::int + (open_issues <= 20)::int + (open_issues <= 10)::int + (open_issues <= 5)::int + (open_issues = 0)::int, 0) as f_issues
from repo_entryline"""

# Thousandths of the weighted sum; "+ 5, integer-divided by 10" rounds halves up to whole points.
CTES["risk_points"] = """
select *, (15 * f_stars + 25 * f_commits + 20 * f_contributors + 25 * f_release + 15 * f_issues + 5) // 10 as points
from factor_tenths"""

CTES["risk_product"] = f"""
select data_source, full_name, language, stars, commits_90d, active_contributors_90d, days_since_last_release, open_issues,
  points::double as risk_score,
  case when points >= 70 then 'HIGH' when points >= 40 then 'MEDIUM' else 'LOW' end as risk_category,
  {AS_OF} as last_updated
from risk_points"""


def pct(part: str, whole: str, digits: int = 2) -> str:
    """Percentage rounded half up, in whole numbers, as DOUBLE; NULL over zero."""
    scale = 10**digits
    return f"((({2 * 100 * scale}::hugeint * ({part}) + ({whole})) // nullif(2 * ({whole}), 0))::double / {scale})"


def mean(column: str, digits: int = 2) -> str:
    """Rounded mean of whole numbers (none negative), NULLs left out."""
    total, rows, scale = f"sum(({column})::hugeint)", f"count({column})", 10**digits
    return f"((({2 * scale}::hugeint * {total} + {rows}) // nullif(2 * {rows}, 0))::double / {scale})"


def money_text(value: str) -> str:
    return f"({value})::decimal(18,2)::varchar"


# ---- status report ------------------------------------------------------------------------


def _stats(layer: str, label: str, table: str, span: str | None, one: str, two: str, three: str, load: str | None) -> str:
    oldest = f"min({span})" if span else "null::timestamp"
    newest = f"max({span})" if span else "null::timestamp"
    return f"""select '{layer}' as layer, '{label}' as table_name, data_source, count(*) as record_count,
  {oldest} as oldest_record, {newest} as newest_record,
  ({one})::double as metric_1, ({two})::double as metric_2, ({three})::double as metric_3,
  {f"max({load})" if load else "null::timestamp"} as last_load
from {table} group by data_source"""


def _neg(column: str) -> str:
    return f"count(*) filter ({column} < 0)"


CTES["table_stats"] = "\nunion all\n".join(
    [
        _stats("RAW", "SRC_GIT_REPOSITORIES", "raw_repositories", "created_at",
               "count(*) filter (coalesce(trim(id), '') = '')", _neg("stars"), _neg("forks"), None),
        _stats("RAW", "SRC_GIT_REPO_CONTRIBUTORS", "raw_contributors", None,
               "count(*) filter (coalesce(trim(contributor), '') = '')", _neg("total_commits"),
               _neg("recent_90_days_commits"), None),
        _stats("RAW", "SRC_GIT_REPO_COMMITS", "raw_commits", None, "0", _neg("commits_30d"), _neg("commits_90d"), None),
        _stats("RAW", "SRC_GIT_REPO_ISSUES", "raw_issues", None, "0", _neg("open_issues"), _neg("closed_issues"), None),
        _stats("RAW", "SRC_GIT_REPO_RELEASES", "raw_releases", None, "0", _neg("release_count"),
               _neg("days_since_last_release"), None),
        _stats("STAGE", "STG_REPOSITORIES", "stg_repositories", "created_at", "count(*) filter (not valid_flag)",
               "count(*) filter (stars = 0)", "count(*) filter (forks = 0)", "load_timestamp"),
        _stats("LINKMAP", "HUB_REPO_CONTRIBUTORS", "hub_contributors", None, "count(distinct repo_full_name)",
               "count(distinct contributor)", mean("total_commits"), "load_timestamp"),
        _stats("LINKMAP", "HUB_REPO_COMMITS", "hub_commits", "last_commit_date", "count(distinct repo)", "null",
               mean("commits_90d"), "load_timestamp"),
        _stats("LINKMAP", "HUB_REPO_ISSUES", "hub_issues", None, "count(distinct repo)", "null",
               mean("open_issues + closed_issues"), "load_timestamp"),
        _stats("LINKMAP", "HUB_REPO_RELEASES", "hub_releases", "last_release_date", "count(distinct repo)", "null",
               mean("release_count"), "load_timestamp"),
        _stats("ENRICH", "REPO_ENTRYLINE", "repo_entryline", "created_at", "count(distinct language)", mean("stars"),
               mean("commits_90d"), "enriched_at"),
        _stats("CURATE", "RISK_ANALYSIS_DATA_PRODUCT", "risk_product", "last_updated", "count(distinct risk_category)",
               mean("risk_score"), "count(*) filter (risk_category = 'HIGH')", "last_updated"),
    ]
)


def _flow(order: int, text: str, source: str, source_where: str, target: str) -> str:
    n = f"(select count(*) from {source} x where x.data_source = k.data_source and {source_where})"
    m = f"(select count(*) from {target} x where x.data_source = k.data_source)"
    return f"""select {order} as display_order, data_source, '{text}' as description, n as source_value, m as target_value,
  {pct("m", "n")} as percent_complete
from (select data_source, {n} as n, {m} as m from (select distinct data_source from {source}) k)"""


CTES["data_flow"] = "\nunion all\n".join(
    [
        _flow(1, "RAW to STAGE", "raw_repositories", "true", "stg_repositories"),
        _flow(2, "STAGE to ENRICH", "stg_repositories", "valid_flag", "repo_entryline"),
        _flow(3, "ENRICH to CURATE", "repo_entryline", "true", "risk_product"),
    ]
)

CTES["last_loads"] = """
select layer, case layer when 'ENRICH' then 'Last ENRICH Load' when 'CURATE' then 'Last CURATE Load'
    else 'Last ' || table_name || ' Load' end as metric_name,
  data_source, last_load as metric_value, record_count
from table_stats where layer <> 'RAW'"""


def _quality(name: str, table: str, condition: str) -> str:
    return f"""select '{name}' as metric_name, data_source, count(*) filter ({condition}) as metric_value,
  {pct(f"count(*) filter ({condition})", "count(*)")} as metric_percent
from {table} group by data_source"""


CTES["quality"] = "\nunion all\n".join(
    [
        _quality("Invalid Records in Stage", "stg_repositories", "not valid_flag"),
        _quality("Repos with No Recent Commits", "repo_entryline", "commits_90d = 0"),
        _quality("Repos with No Active Contributors", "repo_entryline", "active_contributors_90d = 0"),
        _quality("Repos with No Releases", "repo_entryline", "release_count = 0"),
    ]
)


def _risk(name: str, category: str) -> str:
    hits = f"count(*) filter (risk_category = '{category}')"
    return f"""select '{name}' as metric_name, data_source, {hits}::varchar as metric_value,
  {pct(hits, "count(*)")} as metric_percent
from risk_product group by data_source"""


CTES["risk_summary"] = "\nunion all\n".join(
    [
        _risk("High Risk Repositories", "HIGH"),
        _risk("Medium Risk Repositories", "MEDIUM"),
        _risk("Low Risk Repositories", "LOW"),
        f"""select 'Average Risk Score', data_source, {money_text(mean("risk_score"))}, null::double
from risk_product group by data_source""",
    ]
)

CTES["status"] = f"""
select 1 as section_order, 'Table Statistics' as section_name, layer, table_name, data_source,
  'Record Count' as metric_name, record_count::varchar as metric_value, null::varchar as metric_percent,
  oldest_record, newest_record
from table_stats
union all
select 2, 'Data Pipeline Flow', null, null, data_source, description, source_value || ' → ' || target_value,
  {money_text("percent_complete")} || '%', null, null
from data_flow
union all
select 3, 'Last Load Timestamps', layer, null, data_source, metric_name,
  strftime(metric_value, '%Y-%m-%d %H:%M:%S.%g'), record_count || ' records', null, null
from last_loads
union all
select 4, 'Data Quality', null, null, data_source, metric_name, metric_value::varchar,
  {money_text("metric_percent")} || '%', null, null
from quality
union all
select 5, 'Risk Analysis', null, null, data_source, metric_name, metric_value,
  {money_text("metric_percent")} || '%', null, null
from risk_summary"""

# ---- events and search pages --------------------------------------------------------------

CTES["event_lines"] = """
select event_id,
  case event_type when 'click' then 'PushEvent' when 'view' then 'WatchEvent' when 'error' then 'IssuesEvent'
    when 'signup' then 'ForkEvent' when 'purchase' then 'IssueCommentEvent' end as type,
  if(event_id % 211 = 0, null, date_trunc('second', ts)) as moment,
  if(event_id % 50 = 7, '', 'u' || user_id) as login,
  case when event_id % 101 = 0 then null when event_id % 103 = 0 then '' when k % 9 = 0 then 'repo-' || k
    when k % 10 = 3 then 'org/repo-' || k || '/sub' else 'org/repo-' || k end as repo
from (select *, json_extract_string(props, '$.k')::bigint as k from events)"""


def event_repos(lines: str) -> str:
    return f"""select 'gh_' || md5(repo) as id, repo as full_name,
  if(contains(repo, '/'), substring(repo, strpos(repo, '/') + 1), repo) as name,
  if(contains(repo, '/'), split_part(repo, '/', 1), 'unknown') as owner,
  'https://github.com/' || repo as html_url,
  coalesce(max(moment), {AS_OF})::timestamp as updated_at,
  count(*) as n_events, count(distinct login) as total_contributors,
  count(*) filter (type = 'PushEvent') as push_events,
  count(*) filter (type in ('IssuesEvent', 'IssueCommentEvent')) as issue_events
from {lines} where repo <> '' group by repo"""


CTES["event_repos"] = event_repos("event_lines")

CTES["search_repos"] = """
select item::varchar as id, p_brand || '/repo-' || p_partkey as full_name, 'repo-' || p_partkey as name,
  p_brand as owner, if(p_partkey % 8 = 0, null, p_type) as language,
  (p_partkey * 7919) % 12000 as stars, p_size::bigint as forks, 'https://example.org/' || p_partkey as html_url,
  (timestamp '1994-01-01 00:00:00' + (p_partkey % 365) * interval 1 day)::timestamp as created_at,
  if(p_partkey % 13 = 1, null, timestamp '2000-01-01 00:00:00' + (p_partkey % 100) * interval 1 day)::timestamp as updated_at,
  p_partkey % 60 as open_issues, p_partkey % 16 = 3 as archived,
  if(p_partkey % 7 = 0, null, timestamp '2001-11-05 00:00:00' - (p_partkey % 200) * interval 1 day
     - (p_partkey % 25) * interval 1 hour)::timestamp as pushed_at
from (select *, if(p_partkey % 9 = 0 and p_partkey > 0, p_partkey - 1, p_partkey) as item from part)
qualify row_number() over (partition by item order by p_partkey // 50, p_partkey) = 1"""


def _query(final: str) -> str:
    """`final` with the tables it needs, and what those need, in front."""
    needed: set[str] = set()

    def collect(text: str) -> None:
        for name in CTES:
            if name not in needed and name in _words(text):
                needed.add(name)
                collect(CTES[name])

    collect(final)
    parts = ",\n".join(f"{name} as ({sql.strip()})" for name, sql in CTES.items() if name in needed)
    return f"with {parts}\n{final}" if parts else final


def _words(text: str) -> set[str]:
    return set("".join(ch if ch.isalnum() or ch == "_" else " " for ch in text).split())


_FIGURES = (
    "full_name, language, stars, commits_90d, active_contributors_90d, "
    "days_since_last_release, open_issues, risk_score, risk_category"
)
_RISKIEST = "order by risk_score desc, full_name"
_COUNTS = (
    "count(*) filter (risk_category = 'HIGH') as {0}, count(*) filter (risk_category = 'MEDIUM') as {1}, "
    "count(*) filter (risk_category = 'LOW') as {2}"
)
_SEARCH = "select * exclude (pushed_at) from search_repos"
_SUMMARY = f"""select count(*) as total_repos, {mean("risk_score")} as avg_risk_score,
  {_COUNTS.format("high_risk_count", "medium_risk_count", "low_risk_count")}, max(last_updated) as last_updated,
  {pct("count(*) filter (risk_category = 'HIGH')", "count(*)", 1)} as high_pct,
  {pct("count(*) filter (risk_category = 'MEDIUM')", "count(*)", 1)} as medium_pct,
  {pct("count(*) filter (risk_category = 'LOW')", "count(*)", 1)} as low_pct
from risk_product"""

# What the metrics call invalid, on raw rows.
_INVALID = """coalesce(trim(id), '') = '' or coalesce(trim(name), '') = '' or coalesce(trim(full_name), '') = ''
  or coalesce(stars < 0, false) or coalesce(forks < 0, false) or created_at is null"""

FINAL: dict[str, str] = {
    **{f"raw_{name}": f"select * from raw_{name}"
       for name in ("repositories", "contributors", "commits", "issues", "releases")},
    "stage_repositories": "select * from stg_repositories",
    "stage_upsert": "select * from stg_repositories",
    "hub_contributors": "select * from hub_contributors",
    "hub_commits": "select * from hub_commits",
    "hub_issues": "select * from hub_issues",
    "hub_releases": "select * from hub_releases",
    "contributors_agg": "select * from contributors_agg",
    "enrich_entryline": "select * from repo_entryline",
    "enrich_bucketed": "select * from repo_entryline",
    "enrich_fanout": """select s.full_name, sum(n)::bigint as n_rows, sum(n * commits_90d)::bigint as sum_commits_90d,
  sum(n * open_issues)::bigint as sum_open_issues, sum(n * release_count)::bigint as sum_release_count,
  sum(n * total_contributors)::bigint as sum_total_contributors
from (select *, if(full_name = max(full_name) over (), 40, 1) as k,
        if(full_name in (select repo from hub_commits), (length(full_name) % 2 + 1) * k, 1)
        * if(full_name in (select repo from hub_issues), (length(full_name) % 3 + 1) * k, 1)
        * if(full_name in (select repo from hub_releases), (length(full_name) % 4 + 1) * k, 1) as n
      from repo_entryline) s
group by s.full_name""",
    "risk_factors": """select full_name, f_stars / 10 as stars_risk_factor, f_commits / 10 as commits_risk_factor,
  f_contributors / 10 as contributors_risk_factor, f_release / 10 as release_risk_factor,
  f_issues / 10 as issues_risk_factor from factor_tenths""",
    "risk_product": "select * from risk_product",
    "pipeline_end_to_end": "select * from risk_product",
    "streaming_refresh": "select * from risk_product",
    "load_metrics": f"""select total_records, total_records - invalid_records as valid_records, invalid_records,
  duplicates_removed, (select count(*) from stg_repositories) as final_records,
  (select count(*) from hub_contributors) as contributors_loaded, (select count(*) from hub_commits) as commits_loaded,
  (select count(*) from hub_issues) as issues_loaded, (select count(*) from hub_releases) as releases_loaded,
  (select count(*) from repo_entryline) as enriched_records, c.*
from (select count(*) as total_records, count(*) filter ({_INVALID}) as invalid_records from raw_repositories
      where data_source = 'git_hub') r,
  (select count(*) - count(distinct full_name) as duplicates_removed from cleansed) d,
  (select count(*) as risk_records, {_COUNTS.format("high_risk", "medium_risk", "low_risk")} from risk_product) c""",
    "load_metrics_append": f"""select total_records, total_records - invalid_records as valid_records, invalid_records,
  duplicates_removed, (select count(*) from stg_repositories) as final_records,
  (select count(*) from hub_contributors) as contributors_loaded, (select count(*) from hub_commits) as commits_loaded,
  (select count(*) from hub_issues) as issues_loaded, (select count(*) from hub_releases) as releases_loaded,
  (select sum(copies)::bigint from twice) as enriched_records, c.*
from (select count(*) as total_records, count(*) filter ({_INVALID}) as invalid_records from raw_repositories
      where data_source = 'git_hub') r,
  (select count(*) - count(distinct full_name) as duplicates_removed from cleansed) d,
  (select sum(k)::bigint as risk_records, coalesce(sum(k) filter (risk_category = 'HIGH'), 0)::bigint as high_risk,
     coalesce(sum(k) filter (risk_category = 'MEDIUM'), 0)::bigint as medium_risk,
     coalesce(sum(k) filter (risk_category = 'LOW'), 0)::bigint as low_risk
   from (select p.risk_category, 1 + copies / times as k from risk_product p
         join (select *, count(*) over (partition by full_name) as times from twice) using (full_name))) c""",
    "status_table_stats": "select * exclude (last_load) from table_stats",
    "status_stats_incremental": "select * exclude (last_load) from table_stats",
    "status_incremental": "select * from status",
    "status_data_flow": "select * from data_flow",
    "status_last_loads": "select * from last_loads",
    "status_quality": "select * from quality",
    "status_risk": "select * from risk_summary",
    "pipeline_status": "select * from status",
    "pipeline_status_section": "select * from status where section_name = 'Data Quality'",
    "report_summary": _SUMMARY,
    "report_top_risky": f"select {_FIGURES} from risk_product {_RISKIEST} limit 10",
    "report_healthiest": f"select {_FIGURES} from risk_product order by risk_score, full_name limit 10",
    "report_top_display": f"""select if(length(full_name) > 40, full_name[1:38] || '..', full_name) as full_name,
  coalesce(language, 'N/A') as language, * exclude (full_name, language)
from (select {_FIGURES} from risk_product {_RISKIEST} limit 20)""",
    "report_by_language": f"""select coalesce(g, 'Unknown') as language, repo_count, avg_risk_score, high_risk, medium_risk, low_risk
from (select language as g, count(*) as repo_count, {mean("risk_score")} as avg_risk_score,
        {_COUNTS.format("high_risk", "medium_risk", "low_risk")} from risk_product group by language
      order by repo_count desc, g nulls last limit 15)""",
    "report_search": f"""select {_FIGURES}, last_updated from risk_product
where upper(full_name) like upper('%brand_1%') {_RISKIEST} limit 20""",
    "search_indexed": f"""select term, place, {_FIGURES}, last_updated
from (select t.term, row_number() over (partition by t.term {_RISKIEST}) as place, r.*
  from (select p_brand as term from part union select lower(replace(p_brand, '#', '_')) from part
    union select right(p_brand, 2) from part union select '-' || (p_partkey % 200) from part
    union select repeat('_', (p_partkey % 3)::int) from part) t
  join risk_product r on upper(r.full_name) like upper('%' || t.term || '%'))
where place <= 20""",
    "report_repo": f"""select {_FIGURES}, last_updated,
  case risk_category
    when 'HIGH' then 'HIGH RISK: This repository shows significant risk factors. Consider finding alternatives or closely monitoring usage.'
    when 'MEDIUM' then 'MEDIUM RISK: Some concerns identified. Monitor regularly and have contingency plans.'
    else 'LOW RISK: Repository appears healthy and well-maintained. Suitable for production use with standard monitoring.'
  end as interpretation
from risk_product where full_name = (select max(full_name) from risk_product) {_RISKIEST} limit 1""",
    "report_export": "select * from risk_product",
    "export_round_trip": "select * from risk_product",
    "dataset_profile": f"""select count(*) as total_repositories, count(distinct language) filter (language <> 'Unknown') as unique_languages,
  count(*) filter (language = 'Unknown') as missing_language, {mean("stars", 1)} as avg_stars,
  count(*) filter (commits_90d = 0) as zero_commit_repos,
  count(*) filter (active_contributors_90d <= 1) as single_maintainer_repos
from repo_entryline""",
    "dq_findings": """select 'missing_language' as check_name, count(*) as n_rows from raw_repositories where coalesce(trim(language), '') = ''
union all select 'created_not_before_updated', count(*) from raw_repositories where created_at >= updated_at
union all select 'duplicate_full_name', count(*) - count(distinct trim(full_name)) from raw_repositories where trim(full_name) <> ''
union all select 'star_outliers', count(*) from raw_repositories
  where stars > (select 4 * quantile_cont(stars, 0.75) - 3 * quantile_cont(stars, 0.25) from raw_repositories)
union all select 'owner_casing_variants', count(*) from raw_repositories where lower(owner) in
  (select lower(owner) from raw_repositories group by lower(owner) having count(distinct owner) > 1)""",
    "star_quantiles": """select share, q as quantile from (
  select 0.01::double as share, quantile_cont(stars, 0.01) as q from raw_repositories
  union all select 0.25, quantile_cont(stars, 0.25) from raw_repositories
  union all select 0.5, quantile_cont(stars, 0.5) from raw_repositories
  union all select 0.75, quantile_cont(stars, 0.75) from raw_repositories)""",
    "events_to_repos": "select * from event_repos",
    "events_incremental": "select * from event_repos",
    "event_log_scan": event_repos("(select * from event_lines where event_id % 97 <> 0)"),
    "events_to_contributors": f"""select repo as repo_full_name, login as contributor,
  count(*) filter (type = 'PushEvent') as total_commits,
  count(*) filter (type = 'PushEvent' and {_recent(90)}) as recent_90_days_commits
from event_lines where repo <> '' and login <> '' group by repo, login""",
    "events_to_commits": f"""select repo, count(*) filter ({_recent(30)}) as commits_30d, count(*) filter ({_recent(90)}) as commits_90d,
  count(*) filter ({_recent(180)}) as commits_180d, max(moment)::timestamp as last_commit_date
from event_lines where repo <> '' and type = 'PushEvent' group by repo""",
    "events_to_issues": f"""select repo, count(*) as open_issues, count(*) filter ({_recent(90)}) as issues_last_90d
from event_lines where repo <> '' and type in ('IssuesEvent', 'IssueCommentEvent') group by repo""",
    "search_to_issues": "select full_name as repo, open_issues from search_repos",
    "search_page_scan": _SEARCH,
    "search_stream": _SEARCH,
    "event_type_counts": """select repo as full_name, type as event_type, count(*) as n,
  count(*) over (partition by repo) as n_types
from event_lines where repo <> '' group by repo, type""",
    "event_type_sets": """select repo as full_name, string_agg(distinct type, ',' order by type) as event_types,
  coalesce(count(*) filter (type = 'PushEvent'), 0) as pushes, count(distinct type) as n_types
from event_lines where repo <> '' group by repo""",
    "search_to_repos": _SEARCH,
    "days_since": """select id, pushed_at, days_since_push,
  case when days_since_push is null then 'none' when days_since_push < 30 then 'under_30_days'
       when days_since_push < 90 then 'under_90_days' else 'older' end as push_recency
from (select id, pushed_at,
        floor((epoch_us(timestamp '2001-09-01 12:00:00') - epoch_us(pushed_at)) / 86400000000.0)::bigint as days_since_push
      from search_repos)""",
    "capped_union": f"""select 1 as priority, id, full_name, name, owner, html_url, updated_at from event_repos
  union all select 2, id, full_name, name, owner, html_url, updated_at from ({_SEARCH})""",
    "raw_from_sources": f"""select 'git_hub' as data_source, id, name, full_name, owner, 'Unknown' as language, 0::bigint as stars, 0::bigint as forks,
  html_url, null::timestamp as created_at, updated_at, {AS_OF} as load_timestamp from event_repos
union all select 'git_hub', id, name, full_name, owner, coalesce(language, 'Unknown'), stars, forks, html_url, created_at,
  updated_at, {AS_OF} from search_repos""",
    "truncate_columns": """select substring(doc_id::varchar, 1, 100) as id, substring(text, 1, 200) as name,
  substring(text, 1, 400) as full_name, substring(source, 1, 200) as owner,
  coalesce(nullif(lang, ''), 'Unknown') as language, substring(text, 1, 500) as html_url
from (select doc_id, text, source, if(doc_id % 5 = 0, null, lang) as lang from documents)""",
    "conform_schema": f"""select data_source, repo, release_count, last_release_date, 999::bigint as days_since_last_release,
  {AS_OF} as load_timestamp from raw_releases""",
    "run_log_latest": """select 'stream-' || o_orderkey % 4 as stream, o_orderkey // 4 as run_id, 'git_hub' as source, 'GITHUB_RISK' as pipeline_name,
  case o_orderstatus when 'F' then 'COMPLETED' when 'P' then 'ERROR' else 'STARTED' end as status,
  case o_orderstatus when 'F' then 'Pipeline completed successfully for new data'
    when 'P' then 'Pipeline failed: ' || o_orderpriority else 'New data detected, starting pipeline execution' end as message,
  o_orderdate as start_time,
  if(o_orderstatus in ('F', 'P'), o_orderdate + (o_custkey % 10) * interval 1 minute, null)::timestamp as end_time
from orders""",
}

SQL: dict[str, str] = {key: _query(final) for key, final in FINAL.items()}

# A second arrival adds rows to two raw tables; everything else is as after a load of all at once.
_ARRIVED = {
    "raw_repositories": f"""select 'git_hub', '', 'gone', p_brand || '/repo-' || p_partkey, p_brand, null, 1, 1, null, null,
  timestamp '2001-06-01 00:00:00', {AS_OF} from part where p_partkey % 29 = 5""",
    "raw_commits": f"""select 'git_hub', p_brand || '/repo-' || p_partkey, 1, 2, 3, null, {AS_OF} from part where p_partkey % 31 = 7""",
}
SQL["delta_refresh"] = SQL["risk_product"]
for _table, _rows in _ARRIVED.items():
    _before = f"{_table} as ({CTES[_table].strip()})"
    SQL["delta_refresh"] = SQL["delta_refresh"].replace(_before, f"{_before[:-1]} union all {_rows})")
