import numpy as np
import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from repovitals import dq_findings, load_metrics, profile_repositories
from repovitals.operators.quality import exact_quantiles
from repovitals.schemas import TABLES

SHARES = [0.0, 0.25, 0.5, 0.9, 1.0]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.integers(-5, 5), st.integers(-(2**31), 2**31), st.none()), max_size=40))
def test_quantiles_equal_sorting(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = {row.share: row["quantile"] for row in exact_quantiles(df, "v", SHARES).collect()}
    known = [v for v in values if v is not None]
    assert set(got) == (set(SHARES) if known else set())
    for share, quantile in got.items():
        assert quantile == pytest.approx(np.quantile(known, share), rel=1e-12, abs=1e-9)


def test_findings(frame):
    base = {"language": "Go", "owner": "o", "stars": 10}
    data = [{**base, "full_name": f"o/{i}"} for i in range(20)]
    data += [
        {**base, "full_name": " o/1 "}, {**base, "full_name": "o/1"},  # two beyond the first
        {**base, "full_name": " ", "language": " "}, {**base, "full_name": None, "language": None},
        {**base, "stars": 1000, "owner": "Big"}, {**base, "stars": None, "owner": "BIG"}, {**base, "owner": None},
    ]
    assert rows(dq_findings(frame("raw_repositories", data))) == [
        ("created_not_before_updated", 0), ("duplicate_full_name", 2), ("missing_language", 2),
        ("owner_casing_variants", 2), ("star_outliers", 1),
    ]


def test_findings_without_rows(frame):
    assert {row.n_rows for row in dq_findings(frame("raw_repositories", [])).collect()} == {0}


def test_profile(frame):
    df = frame(
        "repo_entryline",
        [{"language": "Go", "stars": 1, "commits_90d": 0, "active_contributors_90d": 0},
         {"language": "Go", "stars": 2, "commits_90d": 5, "active_contributors_90d": 1},
         {"language": None, "stars": None, "commits_90d": None, "active_contributors_90d": None}],
    )
    assert rows(profile_repositories(df)) == [(3, 1, 1, 1.5, 1, 2)]


def test_metrics(frame):
    data = {
        "raw_repositories": [
            {"id": "1", "name": "n", "full_name": "a", "stars": None, "forks": 1, "created_at": None},
            {"id": "2", "name": "n", "full_name": " a ", "stars": None, "forks": 1, "created_at": __import__("datetime").datetime(2020, 1, 1)},
            {"id": "3", "name": "n", "full_name": None}, {"id": "4", "data_source": "git_lab"},
        ],
        "stg_repositories": [{}, {}], "hub_commits": [{}], "risk_product": [{"risk_category": "HIGH"}],
    }
    row = load_metrics({key: frame(key, data.get(key, [])) for key in TABLES if key != "run_log"}).first()
    # NULL stars are not counted as invalid, a missing creation time is.
    assert (row.total_records, row.valid_records, row.invalid_records) == (3, 1, 2)
    assert (row.duplicates_removed, row.final_records, row.commits_loaded, row.issues_loaded) == (1, 2, 1, 0)
    assert (row.high_risk, row.medium_risk, row.low_risk) == (1, 0, 0)
