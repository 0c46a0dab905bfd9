"""What the physical plans must look like for the jobs to hold at scale."""

import pytest
from conftest import NOW

import repovitals as rv
from repovitals import fixed_values as fx
from repovitals.functions.times import ntz
from repovitals.plans import monitoring
from repovitals.schemas import TABLES
from repovitals.sources import star_schema


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def filled(spark, frame, tmp_path_factory):
    store = rv.LayerStore(spark, str(tmp_path_factory.mktemp("plans")))
    store.create_tables()
    for key in TABLES:
        if key != "run_log":
            store.append(key, frame(key, [{}, {"data_source": "git_lab"}]))
    return store


def test_source_filter_prunes_directories(filled, as_of):
    for job, key in ((rv.hub_commits, "raw_commits"), (rv.stage_repositories, "raw_repositories")):
        text = plan(job(filled.read(key), as_of))
        assert "PartitionFilters: [isnotnull(data_source" in text and "git_hub" in text


def test_hubs_do_not_shuffle(filled, as_of):
    jobs = {"raw_contributors": rv.hub_contributors, "raw_commits": rv.hub_commits, "raw_issues": rv.hub_issues,
            "raw_releases": rv.hub_releases, "repo_entryline": rv.risk_product}
    for key, job in jobs.items():
        assert "Exchange" not in plan(job(filled.read(key), as_of))


def test_deduplication_limits_groups_before_the_shuffle(filled, as_of):
    text = plan(rv.stage_repositories(filled.read("raw_repositories"), as_of))
    before = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in before and text.count("Exchange") == 1


def test_enrich_joins_without_cross_products(filled, as_of):
    keys = ("stg_repositories", "hub_contributors", "hub_commits", "hub_issues", "hub_releases")
    text = plan(rv.enrich(*map(filled.read, keys), as_of))
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "Expand" not in text


def test_status_reads_each_table_once(filled):
    text = plan(rv.pipeline_status(filled.read_layers()))
    assert text.count("FileScan") == 12 and "Join" not in text and "Expand" not in text


def test_a_section_reads_its_own_tables_only(filled):
    tables = filled.read_layers()
    scans = {fx.SECTION_TABLES: 12, fx.SECTION_FLOW: 4, fx.SECTION_LOADS: 7, fx.SECTION_QUALITY: 2, fx.SECTION_RISK: 1}
    for section, n in scans.items():
        assert plan(rv.status_section(tables, section)).count("FileScan") == n
    assert plan(monitoring.status_risk(tables)).count("FileScan") == 1


def test_table_figures_multiply_no_rows(filled):
    text = plan(monitoring.status_table_stats(filled.read_layers()))
    assert "Expand" not in text and text.count("FileScan") == 13  # contributors are counted by themselves


def test_event_types_are_counted_in_one_scan(spark, tmp_path):
    events = spark.read.schema("type string, created_at string, repo struct<name:string>, actor struct<login:string>")
    df = rv.event_type_counts(events.json(str(tmp_path)))
    assert plan(df).count("FileScan") == 1 and "Join" not in plan(df)


def test_rankings_take_ordered_rows_only(filled):
    product = filled.read("risk_product")
    for df in (rv.report_top(product), rv.report_search(product, "a"), rv.report_by_language(product), rv.report_repo(product, "a")):
        assert "TakeOrderedAndProject" in plan(df)


def test_summary_reads_three_columns(filled):
    text = plan(rv.report_summary(filled.read("risk_product")))
    assert "ReadSchema: struct<risk_score:double,risk_category:string,last_updated:timestamp_ntz>" in text


def test_no_python_in_any_plan(filled, as_of):
    for df in (rv.dq_findings(filled.read("raw_repositories")), rv.load_metrics(filled.read_layers())):
        assert "Python" not in plan(df) and "CartesianProduct" not in plan(df)


def test_as_of_takes_aware_times(spark):
    from datetime import timedelta, timezone

    aware = NOW.replace(tzinfo=timezone(timedelta(hours=2)))
    assert spark.range(1).select(ntz(aware).alias("t")).first().t == NOW - timedelta(hours=2)


def test_enrich_broadcasts_frequent_names_only(filled, as_of):
    keys = ("stg_repositories", "hub_contributors", "hub_commits", "hub_issues", "hub_releases")
    text = plan(rv.enrich(*map(filled.read, keys), as_of))
    # A hub's frequent names meet its rows and the staged side; nothing else is small at every size.
    assert text.count("BroadcastHashJoin") == 6 and text.count("SortMergeJoin") == 7


def test_raw_tables_are_derived_without_broadcasts(spark):
    for key in ("raw_contributors", "raw_commits", "raw_issues", "raw_releases"):
        text = plan(star_schema.RAW_DERIVATIONS[key](spark, "/root/testdata/sf0.001"))
        assert "Broadcast" not in text and "SortMergeJoin" in text
