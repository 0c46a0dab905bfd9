from conftest import rows
from pyspark.sql import functions as F

from repovitals import contributors_agg, enrich, frequent_names


def inputs(frame, **tables):
    empty = {"stg_repositories": [], "hub_contributors": [], "hub_commits": [], "hub_issues": [], "hub_releases": []}
    return [frame(key, tables.get(key, default)) for key, default in empty.items()]


def repository(name, **more):
    return {"full_name": name, "id": name, "valid_flag": True, "stars": 1, **more}


def test_contributors_are_counted_once_and_active_if_any_row_is(frame):
    hub = frame(
        "hub_contributors",
        [
            {"repo_full_name": "r", "contributor": "a", "recent_90_days_commits": 0},
            {"repo_full_name": "r", "contributor": "a", "recent_90_days_commits": 2},
            {"repo_full_name": "r", "contributor": "b", "recent_90_days_commits": -1},
            {"repo_full_name": "r", "contributor": "c", "recent_90_days_commits": None},
            {"repo_full_name": "q", "contributor": "a", "recent_90_days_commits": 1},
            {"repo_full_name": "q", "contributor": "a", "recent_90_days_commits": 1, "data_source": "git_lab"},
        ],
    )
    assert rows(contributors_agg(hub)) == [("q", 1, 1), ("r", 3, 1)]


def test_absent_activity_gets_defaults_and_null_activity_too(frame, as_of):
    df = enrich(
        *inputs(
            frame,
            stg_repositories=[repository("a"), repository("b"), repository("c", valid_flag=False)],
            hub_releases=[{"repo": "b"}],
        ),
        as_of,
    )
    counters = ("commits_30d", "commits_90d", "commits_180d", "total_contributors", "active_contributors_90d",
                "open_issues", "closed_issues", "issues_last_90d", "release_count", "days_since_last_release")
    assert rows(df, "full_name", *counters) == [(name, *[0] * 9, 999) for name in "ab"]
    assert rows(df, "last_commit_date", "last_release_date") == [(None, None)] * 2


def many(repo, n, **more):
    return [{"repo": repo, "commits_30d": i, "open_issues": i, "release_count": i, **more} for i in range(n)]


def test_several_hub_rows_give_several_rows(frame, as_of):
    df = enrich(
        *inputs(frame, stg_repositories=[repository("a")], hub_commits=many("a", 3), hub_issues=many("a", 2),
                hub_releases=many("a", 2), hub_contributors=[{"repo_full_name": "a", "contributor": "x"}] * 2),
        as_of,
    )
    assert df.count() == 12


def test_frequent_names_are_cut_and_give_the_same_rows(spark, frame, as_of):
    tables = inputs(
        frame,
        stg_repositories=[
            repository("hot"), repository("hot"),  # an appended stage holds copies
            repository("calm"), repository("lonely"), repository("hot2"), repository("bad", valid_flag=False),
        ],
        hub_contributors=[{"repo_full_name": "hot", "contributor": str(i), "recent_90_days_commits": i} for i in range(5)],
        hub_commits=[{"repo": "hot", "commits_30d": 1}] * 40 + many("calm", 2) + many("bad", 30) + many("UNKNOWN/UNKNOWN", 50),
        hub_issues=many("hot2", 25) + many("calm", 1),
        hub_releases=many("hot", 3) + many("hot2", 20),
    )
    hub = tables[2].withColumnRenamed("repo", "full_name")
    assert rows(frequent_names(hub)) == [("UNKNOWN/UNKNOWN", 7), ("bad", 4), ("hot", 6)]  # of 122 rows, 16 parts
    got = enrich(*tables, as_of)
    assert got.count() == 2 * 40 * 3 + 2 + 1 + 25 * 20
    by_name = {r.full_name: r.n for r in got.groupBy("full_name").agg(F.count("*").alias("n")).collect()}
    assert by_name == {"hot": 240, "calm": 2, "lonely": 1, "hot2": 500}
    hot = got.filter("full_name = 'hot2'")
    pairs = {tuple(r) for r in hot.select("open_issues", "release_count").collect()}
    assert pairs == {(i, r) for i in range(25) for r in range(20)}
    assert rows(hot.select("commits_30d").distinct()) == [(0,)]
    assert rows(got.filter("full_name = 'hot'").groupBy("release_count").count()) == [(0, 80), (1, 80), (2, 80)]
