from datetime import datetime

import pytest
from conftest import NOW, rows

from repovitals import event_type_counts, event_type_maps, repos_from_events
from repovitals.schemas import EVENT_LINE


@pytest.fixture(scope="module")
def events(spark):
    data = [
        ("PushEvent", "2020-01-01T10:00:00Z", ("org/a/b",), ("x",)),
        ("PushEvent", "2020-01-03T10:00:00Z", ("org/a/b",), ("x",)),
        ("IssuesEvent", "2020-01-02T10:00:00Z", ("org/a/b",), ("y",)),
        ("IssueCommentEvent", "zzz", ("org/a/b",), None),
        ("WatchEvent", None, ("org/a/b",), (None,)),
        (None, "2020-01-02", ("plain",), ("x",)),
        ("PushEvent", "2020-01-01T10:00:00Z", ("",), ("x",)),
        ("PushEvent", "2020-01-01T10:00:00Z", (None,), ("x",)),
        ("PushEvent", "2020-01-01T10:00:00Z", None, ("x",)),
    ]
    return spark.createDataFrame(data, EVENT_LINE)


def test_repositories(events, as_of):
    got = {row.full_name: row for row in repos_from_events(events, as_of).collect()}
    assert set(got) == {"org/a/b", "plain"}
    a = got["org/a/b"]
    assert (a.owner, a.name, a.html_url) == ("org", "a/b", "https://github.com/org/a/b")
    assert a.updated_at == datetime(2020, 1, 3, 10)  # junk does not count as a late time
    assert (a.n_events, a.total_contributors, a.push_events, a.issue_events) == (5, 3, 2, 2)
    assert a.id.startswith("gh_") and len(a.id) == 35
    plain = got["plain"]
    assert (plain.owner, plain.name, plain.updated_at) == ("unknown", "plain", NOW)


def test_event_types(events):
    assert rows(event_type_counts(events)) == [
        ("org/a/b", "IssueCommentEvent", 1, 4), ("org/a/b", "IssuesEvent", 1, 4), ("org/a/b", "PushEvent", 2, 4),
        ("org/a/b", "WatchEvent", 1, 4), ("plain", None, 1, 1),
    ]
    (row,) = event_type_maps(events).collect()
    assert row.event_counts == {"IssueCommentEvent": 1, "IssuesEvent": 1, "PushEvent": 2, "WatchEvent": 1}
    assert row.event_types == ["IssueCommentEvent", "IssuesEvent", "PushEvent", "WatchEvent"]
