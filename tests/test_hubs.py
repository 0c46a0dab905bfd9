from datetime import datetime

import pytest
from conftest import NOW, rows

from repovitals import hub_commits, hub_contributors, hub_issues, hub_releases


@pytest.mark.parametrize(
    "raw, hub",
    [
        ((1, 2, 3), (1, 2, 3)),
        ((9, 5, 3), (5, 3, 3)),  # each bounded by its neighbour's raw value
        ((5, -1, 3), (-1, 0, 3)),  # also by a negative one
        ((-1, -1, -1), (0, 0, 0)),
        ((4, 2, -1), (2, -1, 0)),
        ((None, 2, 3), (None, 2, 3)),
        ((4, None, 3), (4, None, 3)),
        ((4, 4, None), (4, 4, None)),
    ],
)
def test_commit_counters(frame, as_of, raw, hub):
    names = ("commits_30d", "commits_90d", "commits_180d")
    df = hub_commits(frame("raw_commits", [{"repo": "o/n", **dict(zip(names, raw))}]), as_of)
    assert rows(df, *names) == [hub]


def test_commit_defaults(frame, as_of):
    raw = frame("raw_commits", [{"repo": " ", "commits_30d": 1}, {"repo": " r ", "last_commit_date": datetime(2020, 1, 1)}])
    assert rows(hub_commits(raw, as_of), "repo", "last_commit_date") == [
        ("UNKNOWN/UNKNOWN", NOW), ("r", datetime(2020, 1, 1)),
    ]


@pytest.mark.parametrize(
    "raw, hub",
    [
        ((2, 3, 4), (2, 3, 4)),
        ((2, 3, 9), (2, 3, 5)),
        ((-4, 1, 2), (0, 1, -3)),  # the bound is the sum of the raw values
        ((2, 3, -1), (2, 3, 0)),
        ((None, 3, 9), (None, 3, 9)),
        ((2**62, 2**61, 1), (2**62, 2**61, 1)),
    ],
)
def test_issue_counters(frame, as_of, raw, hub):
    names = ("open_issues", "closed_issues", "issues_last_90d")
    df = hub_issues(frame("raw_issues", [{"repo": "o/n", **dict(zip(names, raw))}]), as_of)
    assert rows(df, *names) == [hub]


@pytest.mark.parametrize(
    "raw, hub", [((5, 3), (5, 3)), ((5, 9), (5, 5)), ((-2, 1), (0, -2)), ((5, -1), (5, 0)), ((None, 9), (None, 9))]
)
def test_contributor_counters(frame, as_of, raw, hub):
    names = ("total_commits", "recent_90_days_commits")
    df = hub_contributors(frame("raw_contributors", [dict(zip(names, raw))]), as_of)
    assert rows(df, "repo_full_name", "contributor", *names) == [("UNKNOWN/UNKNOWN", "unknown_contributor", *hub)]


def test_release_defaults(frame, as_of):
    raw = frame(
        "raw_releases",
        [{"repo": "a", "release_count": -1, "days_since_last_release": -1},
         {"repo": "b", "release_count": 2, "days_since_last_release": None, "last_release_date": NOW}],
    )
    assert rows(hub_releases(raw, as_of), "repo", "release_count", "last_release_date", "days_since_last_release") == [
        ("a", 0, datetime(1970, 1, 1), 999), ("b", 2, NOW, None),
    ]


def test_other_sources_stay_out(frame, as_of):
    raw = frame("raw_issues", [{"repo": "a"}, {"repo": "b", "data_source": "git_lab"}, {"repo": "c", "data_source": None}])
    assert rows(hub_issues(raw, as_of), "repo") == [("a",)]
