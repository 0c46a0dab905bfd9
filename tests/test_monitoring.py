from datetime import datetime

import pytest
from conftest import NOW, rows

from repovitals import fixed_values as fx
from repovitals import pipeline_status, status_section
from repovitals.plans import monitoring
from repovitals.schemas import TABLES

LAYERS = [key for key in TABLES if key != "run_log"]


@pytest.fixture(scope="module")
def tables(frame):
    lab = {"data_source": "git_lab"}
    none = {"data_source": None}
    data = {
        "raw_repositories": [{"id": " ", "stars": -1, "created_at": datetime(2020, 1, 1)},
                             {"id": "2", "stars": None, "created_at": datetime(2020, 1, 2)}, {"id": "3"}, lab, none],
        "stg_repositories": [{"valid_flag": True, "load_timestamp": NOW}, {"valid_flag": False, "load_timestamp": NOW},
                             {**none, "valid_flag": False}],
        "hub_contributors": [{"repo_full_name": "r", "contributor": c, "total_commits": n, "load_timestamp": NOW}
                             for c, n in (("a", 1), ("b", 2), ("b", None))],
        "repo_entryline": [{"commits_90d": 0, "active_contributors_90d": 1, "release_count": 0, "stars": 1, "enriched_at": NOW}],
        "risk_product": [{"risk_category": c, "risk_score": s, "last_updated": NOW}
                         for c, s in (("HIGH", 80.0), ("LOW", 10.0), ("LOW", 11.0))],
    }
    return {key: frame(key, data.get(key, [])) for key in LAYERS}


def test_flow(tables):
    assert rows(monitoring.status_data_flow(tables)) == [
        (1, None, "RAW to STAGE", 0, 0, None),  # a NULL source equals nothing
        (1, "git_hub", "RAW to STAGE", 3, 2, 66.67),
        (1, "git_lab", "RAW to STAGE", 1, 0, 0.0),
        (2, None, "STAGE to ENRICH", 0, 0, None),
        (2, "git_hub", "STAGE to ENRICH", 1, 1, 100.0),
        (3, "git_hub", "ENRICH to CURATE", 1, 3, 300.0),
    ]


def test_quality(tables):
    assert rows(monitoring.status_quality(tables)) == [
        ("Invalid Records in Stage", None, 0, None),
        ("Invalid Records in Stage", "git_hub", 1, 50.0),
        ("Repos with No Active Contributors", "git_hub", 0, 0.0),
        ("Repos with No Recent Commits", "git_hub", 1, 100.0),
        ("Repos with No Releases", "git_hub", 1, 100.0),
    ]


def test_risk(tables):
    assert rows(monitoring.status_risk(tables)) == [
        ("Average Risk Score", "git_hub", "33.67", None),
        ("High Risk Repositories", "git_hub", "1", 33.33),
        ("Low Risk Repositories", "git_hub", "2", 66.67),
        ("Medium Risk Repositories", "git_hub", "0", 0.0),
    ]


def test_table_stats(tables):
    stats = {(r.table_name, r.data_source): r for r in monitoring.status_table_stats(tables).collect()}
    raw = stats["SRC_GIT_REPOSITORIES", "git_hub"]
    assert tuple(raw)[3:] == (3, datetime(2020, 1, 1), datetime(2020, 1, 2), 1.0, 1.0, 0.0)
    hub = stats["HUB_REPO_CONTRIBUTORS", "git_hub"]
    assert tuple(hub)[3:] == (3, None, None, 1.0, 2.0, 1.5)
    assert len(stats) == 8


def test_report_is_text_in_order(tables):
    report = pipeline_status(tables)
    lines = [tuple(r) for r in report.collect()]
    assert report.columns == ["section_order", "section_name", "layer", "table_name", "data_source", "metric_name",
                              "metric_value", "metric_percent", "oldest_record", "newest_record"]
    keys = [tuple((v is None, v) for v in (r[0], r[4], r[2], r[3], r[5])) for r in lines]
    assert keys == sorted(keys)
    by_metric = {(r[5], r[4]): r for r in lines if r[0] > 1}
    assert by_metric["RAW to STAGE", "git_hub"][6:8] == ("3 → 2", "66.67%")
    assert by_metric["RAW to STAGE", None][6:8] == ("0 → 0", None)
    assert by_metric["Last CURATE Load", "git_hub"][6:8] == ("2020-06-15 12:00:00.000", "3 records")
    assert by_metric["Low Risk Repositories", "git_hub"][6:8] == ("2", "66.67%")
    assert by_metric["Average Risk Score", "git_hub"][6:8] == ("33.67", None)
    assert by_metric["Repos with No Recent Commits", "git_hub"][6:8] == ("1", "100.00%")
    assert len(lines) == 8 + 6 + 5 + 5 + 4


def test_section_and_view(spark, tables):
    whole = rows(pipeline_status(tables))
    for section in (fx.SECTION_TABLES, fx.SECTION_FLOW, fx.SECTION_LOADS, fx.SECTION_QUALITY, fx.SECTION_RISK):
        assert rows(status_section(tables, section)) == [line for line in whole if line[1] == section]
    with pytest.raises(ValueError):
        status_section(tables, "No Such Section")
    monitoring.create_status_view(tables, "status_view")
    query = "select metric_value from status_view where section_name = 'Risk Analysis' and metric_name like 'High%'"
    assert rows(spark.sql(query)) == [("1",)]


def test_empty_tables(frame):
    assert pipeline_status({key: frame(key, []) for key in LAYERS}).count() == 0
