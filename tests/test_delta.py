"""Refresh of what changed against a refresh of everything, event hours, and co-located enrich."""

import gzip
import json
import uuid
from datetime import datetime

import pytest
from conftest import NOW, rows
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

import repovitals as rv
from checks.oracle import SQL
from repovitals.plans import delta
from repovitals.schemas import RAW_TABLES
from repovitals.streaming import event_hours, kept_states

LAYERS = ("stg_repositories", "hub_contributors", "hub_commits", "hub_issues", "hub_releases", "repo_entryline", "risk_product")


def repository(name, day=1, **more):
    moment = datetime(2020, 1, day)
    return {"id": name, "name": name, "full_name": name, "stars": 5, "forks": 1, "created_at": moment, "updated_at": moment, **more}


@pytest.fixture
def land(store, frame, as_of):
    store.create_tables()

    def put(key, *data):
        rv.write_raw(store, key, frame(key, list(data)), as_of)

    return put


def same_as_everything(store, layers, as_of):
    rv.refresh(store, as_of)
    for key in LAYERS:
        assert rows(layers.read(key)) == rows(store.read(key)), key


def arrive(land):
    land("raw_repositories", *(repository(f"o/{i}") for i in range(12)), repository("o/1", 2, stars=7), {"full_name": None})
    land("raw_contributors", *({"repo_full_name": f"o/{i % 5}", "contributor": f"c{i}", "total_commits": i, "recent_90_days_commits": i} for i in range(9)))
    land("raw_commits", *({"repo": f"o/{i}", "commits_90d": i, "commits_180d": i} for i in range(8)), {"repo": ""})
    land("raw_issues", {"repo": "o/3", "open_issues": 4}, {"repo": "o/99", "open_issues": 4})
    land("raw_releases", {"repo": "o/4", "release_count": 2})


def test_several_arrivals_equal_one_refresh(store, land, as_of):
    layers = rv.DeltaLayers(store, buckets=8)
    assert rv.refresh_changed(layers, NOW) == 0
    arrive(land)
    assert rv.refresh_changed(layers, NOW) == 1
    same_as_everything(store, layers, as_of)
    # Updated, no longer valid, older than what is there, tied, new; more rows of hubs, one of a name unknown so far.
    land("raw_repositories", repository("o/2", 3, stars=900), repository("o/3", 3, stars=-1), repository("o/4", 1, stars=1),
         repository("o/5"), repository("o/5", id="a"), repository("o/50"))
    land("raw_commits", {"repo": "o/6", "commits_90d": 70, "commits_180d": 80}, {"repo": "o/6", "commits_90d": 1, "commits_180d": 2})
    land("raw_issues", {"repo": "o/50", "open_issues": 60})
    assert rv.refresh_changed(layers, NOW) == 1
    same_as_everything(store, layers, as_of)
    # Hubs alone start a load too; a name becomes valid again, and every name of its bucket leaves.
    land("raw_releases", {"repo": "o/6", "release_count": 1})
    land("raw_repositories", repository("o/3", 4), *(repository(f"o/{i}", 9, id="") for i in range(5, 12)))
    assert rv.refresh_changed(layers, NOW) == 1 and rv.refresh_changed(layers, NOW) == 0
    same_as_everything(store, layers, as_of)
    statuses = [r.status for r in store.read("run_log").orderBy("ts").collect()]
    assert statuses.count("STARTED") == statuses.count("COMPLETED") == 3


def test_a_failed_load_is_tried_again(store, land, as_of, monkeypatch):
    layers = rv.DeltaLayers(store, buckets=4)
    arrive(land)
    rv.refresh_changed(layers, NOW)
    land("raw_commits", {"repo": "o/6", "commits_90d": 70, "commits_180d": 80})
    land("raw_repositories", repository("o/2", 3, stars=900), repository("o/3", 3, id=""))
    product = delta.risk_product

    def fails(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(delta, "risk_product", fails)
    with pytest.raises(Exception, match="lost"):
        rv.refresh_changed(layers, NOW)
    monkeypatch.setattr(delta, "risk_product", product)
    assert rv.refresh_changed(layers, NOW) == 1
    same_as_everything(store, layers, as_of)
    assert rows(rv.run_log_latest(store.read("run_log")), "run_id", "status") == [(0, "COMPLETED"), (1, "COMPLETED")]


def test_only_the_buckets_of_touched_names_are_read_and_written(store, land, frame, as_of):
    layers = rv.DeltaLayers(store, buckets=64)
    arrive(land)
    rv.refresh_changed(layers, NOW)

    def files(key):
        return set(layers._read(key).inputFiles())

    before = {key: files(key) for key in LAYERS}
    news = {key: frame(key, []) for key in RAW_TABLES} | {"raw_repositories": frame("raw_repositories", [repository("o/2", 3)])}
    layers.apply(news, 7, as_of)
    bucket = store.spark.range(1).select(F.pmod(F.xxhash64(F.lit("o/2")), F.lit(64))).first()[0]
    for key in ("stg_repositories", "repo_entryline", "risk_product"):
        changed = before[key] ^ files(key)
        assert changed and all(f"/bucket={bucket}/" in path for path in changed), key
    assert all(before[key] == files(key) for key in delta.HUBS)
    text = layers._read("hub_commits", [3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in text


def test_rows_are_new_changed_or_unchanged(store, frame, as_of):
    layers = rv.DeltaLayers(store, buckets=64)

    def load(number, *data):
        cleansed = rv.cleanse_repositories(frame("raw_repositories", list(data)), as_of)
        before = set(layers._read("stg_repositories").inputFiles())
        kinds = rows(layers.upsert_stage(cleansed, number), "full_name", "kind")
        return kinds, before ^ set(layers._read("stg_repositories").inputFiles())

    first = [repository(f"o/{i}", 2) for i in range(6)]
    assert load(0, *first)[0] == [(f"o/{i}", "new") for i in range(6)]
    kinds, files = load(1, repository("o/0", 2), repository("o/1", 1, stars=9), repository("o/2", 2, id="z"))
    assert kinds == [("o/0", "unchanged"), ("o/1", "unchanged"), ("o/2", "unchanged")] and not files
    second = [repository("o/0", 3, stars=-4), repository("o/1", 2), repository("o/7"), repository("o/2", 2, id="a")]
    kinds, files = load(2, *second)
    assert kinds == [("o/0", "changed"), ("o/1", "unchanged"), ("o/2", "changed"), ("o/7", "new")]
    assert len({path.split("/bucket=")[1].split("/")[0] for path in files}) == 3
    everything = [*first, repository("o/1", 1, stars=9), repository("o/2", 2, id="z"), *second]
    assert rows(layers.read("stg_repositories")) == rows(rv.stage_repositories(frame("raw_repositories", everything), as_of))
    before = rows(layers.read("stg_repositories"))
    assert load(2, *second)[0] == kinds and rows(layers.read("stg_repositories")) == before  # the same load again


def test_an_upsert_shuffles_and_sorts_each_side_once(store, frame, as_of, monkeypatch):
    layers, plans, write = rv.DeltaLayers(store, buckets=4), {}, DataFrameWriter.parquet

    def seen(writer, path, *more, **options):
        plans[path] = writer._df._jdf.queryExecution().executedPlan().toString()
        return write(writer, path, *more, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", seen)
    layers.upsert_stage(rv.cleanse_repositories(frame("raw_repositories", [repository("o/1")]), as_of), 0)
    plan = plans[f"{layers.root}/upserts/load=0"]
    assert plan.count("Exchange hash") == 2 and plan.count("SortMergeJoin") == 1 and "Broadcast" not in plan
    # One sort of the new rows before the shuffle, for the group limit, and one of each side after it.
    assert plan.count("Sort [") == 3 and "WindowGroupLimit" in plan[plan.index("Exchange hash"):]


def test_ties_are_broken_alike_within_a_load_and_between_loads(store, frame, as_of):
    variants = [{}, {"id": None}, {"id": "z"}, {"stars": None}, {"stars": 9}, {"name": None}, {"language": "c"}, {"created_at": datetime(2019, 1, 1)},
                {"html_url": "u"}, {"forks": -1}, {"updated_at": datetime(2021, 1, 1)}]
    pairs = [(a, b) for a in range(len(variants)) for b in range(len(variants))]
    first, second = ([repository(f"o/{pair}") | {"id": "m"} | variants[pair[side]] for pair in pairs] for side in (0, 1))
    layers = rv.DeltaLayers(store, buckets=2)
    for number, data in enumerate((first, second)):
        kinds = dict(rows(layers.upsert_stage(rv.cleanse_repositories(frame("raw_repositories", data), as_of), number), "full_name", "kind"))
    assert rows(layers.read("stg_repositories")) == rows(rv.stage_repositories(frame("raw_repositories", first + second), as_of))
    changed = {pair: kinds[f"o/{pair}"] == "changed" for pair in pairs}
    assert set(kinds.values()) == {"changed", "unchanged"}
    assert all(changed[a, b] != changed[b, a] for a, b in pairs if a != b) and not any(changed[a, a] for a, _ in pairs)


def test_the_second_arrival_is_in_the_sql():
    assert SQL["delta_refresh"].count("union all select 'git_hub'") == 2


def hour_file(folder, hour, lines):
    folder.mkdir(parents=True, exist_ok=True)
    with gzip.open(folder / f"2020-01-01-{hour}.json.gz", "wt") as file:
        file.write("\n".join(lines))


def event(repo, login, minute, kind="PushEvent"):
    return json.dumps({"type": kind, "created_at": f"2020-01-01T00:{minute:02d}:00Z", "repo": {"name": repo}, "actor": {"login": login}})


def test_event_hours_count_once(spark, store, tmp_path, as_of):
    landed = tmp_path / "landed"
    hours = rv.EventHours(store)
    hour_file(landed / "a", 5, [event("o/a", "x", 9), event("o/b", "y", 1), "broken", event("", "x", 2)])
    assert hours.absorb(f"{landed}/*") == 1
    everything = lambda: rows(rv.repos_from_events(rv.read_event_log(spark, f"{landed}/a"), as_of))
    assert rows(hours.repositories(as_of)) == everything()
    hour_file(landed / "a", 3, [event("o/a", "x", 4, "IssuesEvent"), event("o/a", "z", 59), event("o/c", None, 1)])
    hour_file(landed / "b", 5, [event("o/a", "x", 9), event("o/b", "y", 1)])  # landed before
    assert hours.absorb(f"{landed}/*") == 1 and hours.absorb(f"{landed}/*") == 0
    assert rows(hours.repositories(as_of)) == everything()
    hours.fold()
    hours.fold()
    hour_file(landed / "a", 4, [event("o/c", "q", 1)])
    assert hours.absorb(f"{landed}/*") == 1
    assert rows(hours.repositories(as_of)) == everything()
    assert len(store.committed_versions(f"{hours.folder}/batches")) == 1


def test_a_failed_batch_of_hours_is_taken_once(spark, store, tmp_path, as_of, monkeypatch):
    landed = tmp_path / "landed"
    hours = rv.EventHours(store)
    hour_file(landed / "a", 1, [event("o/a", "x", 9)])
    hours.absorb(f"{landed}/*")
    hour_file(landed / "a", 2, [event("o/a", "x", 10), event("o/a", "y", 11)])
    states = event_hours.actor_states
    lost = lambda batch: states(batch).withColumn("push_events", F.raise_error(F.lit("lost")).cast("bigint"))
    monkeypatch.setattr(event_hours, "actor_states", lost)
    with pytest.raises(Exception, match="lost"):
        hours.absorb(f"{landed}/*")
    assert rows(hours.repositories(as_of), "n_events") == [(1,)]
    monkeypatch.setattr(event_hours, "actor_states", states)
    assert hours.absorb(f"{landed}/*") == 1
    assert rows(hours.repositories(as_of)) == rows(rv.repos_from_events(rv.read_event_log(spark, f"{landed}/a"), as_of))


def test_many_batches_are_folded(spark, store, tmp_path, as_of, monkeypatch):
    monkeypatch.setattr(kept_states, "FOLD_AFTER", 1)
    hours, landed = rv.EventHours(store), tmp_path / "landed"
    for hour in range(3):
        hour_file(landed / "a", hour, [event("o/a", f"u{hour}", hour)])
        hours.absorb(f"{landed}/*")
    assert len(store.committed_versions(f"{hours.folder}/folded")) == 1
    assert rows(hours.repositories(as_of)) == rows(rv.repos_from_events(rv.read_event_log(spark, f"{landed}/a"), as_of))


@pytest.fixture
def busy(frame):
    """A name with many rows in two hubs, one with some in each, one without; an unstaged busy name."""
    stage = frame("stg_repositories", [{"full_name": n, "valid_flag": True, "stars": 1} for n in ("hot", "b", "c")] + [{"full_name": "bad", "valid_flag": False}])
    people = frame("hub_contributors", [{"repo_full_name": "hot", "contributor": f"p{i}", "recent_90_days_commits": i % 2} for i in range(9)])
    commits = frame("hub_commits", [{"repo": "hot", "commits_90d": i} for i in range(40)] + [{"repo": "b", "commits_90d": 1}] * 2 + [{"repo": "bad"}] * 30)
    issues = frame("hub_issues", [{"repo": "hot", "open_issues": i} for i in range(12)] + [{"repo": "b", "open_issues": i} for i in range(3)])
    releases = frame("hub_releases", [{"repo": "b", "release_count": 2}, {"repo": "hot", "release_count": 3}, {"repo": "none"}])
    return stage, people, commits, issues, releases


@pytest.mark.parametrize("buckets", [2, 7])
def test_colocated_enrich_equals_enrich(spark, busy, as_of, tmp_path, buckets):
    prefix = f"t{uuid.uuid4().hex}"
    rv.write_colocated(*busy, prefix, str(tmp_path), buckets)
    got = rv.enrich_colocated(spark, prefix, as_of)
    assert rows(got) == rows(rv.enrich(*busy, as_of))
    salts = spark.table(f"{prefix}_hub_commits").filter("full_name = 'hot'").groupBy("salt").count().collect()
    assert len(salts) > 1 and sum(r["count"] for r in salts) == 40
    assert spark.table(f"{prefix}_hub_commits").filter("full_name = 'bad'").count() == 0


def test_colocated_enrich_does_not_shuffle(spark, busy, as_of, tmp_path):
    prefix = f"t{uuid.uuid4().hex}"
    rv.write_colocated(*busy, prefix, str(tmp_path), 4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = rv.enrich_colocated(spark, prefix, as_of)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert text.count("SortMergeJoin") == 4 and "Exchange" not in text


def test_search_pages_in_any_order(spark, store, tmp_path):
    def page(number, *items):
        (tmp_path / "pages").mkdir(exist_ok=True)
        body = {"items": [{"id": i, "full_name": name, "stargazers_count": n} for i, name, n in items]}
        (tmp_path / "pages" / f"page_{number}.json").write_text(json.dumps(body))

    pages, landed = rv.SearchPages(store), str(tmp_path / "pages")
    everything = lambda: rows(rv.repos_from_search(rv.read_search_pages(spark, landed)))
    page(10, (1, "o/a", 1), (2, "o/b", 1), (1, "o/a", 2))
    assert pages.absorb(landed) == 1 and rows(pages.repositories()) == everything()
    page(11, (1, "o/a", 3), (3, "o/c", 1), (None, "o/x", 1))
    page(2, (2, "o/b", 9))
    assert pages.absorb(landed) == 1 and rows(pages.repositories()) == everything()
    pages.fold()
    page(1, (2, "o/b", 10), (None, "o/y", 1))
    assert pages.absorb(landed) == 1 and pages.absorb(landed) == 0
    assert rows(pages.repositories()) == everything()
