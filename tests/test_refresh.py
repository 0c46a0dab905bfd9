import time
from datetime import datetime

import pytest
from conftest import NOW, rows
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryException

from repovitals import load_metrics, refresh, refresh_if_new, refresh_periodically, run_log_latest, write_raw
from repovitals import fixed_values as fx
from repovitals.plans import refresh as plan
from repovitals.schemas import TABLES
from repovitals.streaming import arrivals


def repository(name, **more):
    return {"id": name, "name": name, "full_name": name, "stars": 5, "forks": 1, "created_at": datetime(2019, 1, 1), **more}


@pytest.fixture
def landed(store, frame, as_of):
    store.create_tables()

    def land(*names):
        write_raw(store, "raw_repositories", frame("raw_repositories", [repository(n) for n in names]), as_of)

    land("a", "b")
    for key, name in (("raw_commits", "commits_90d"), ("raw_issues", "open_issues"), ("raw_releases", "release_count")):
        write_raw(store, key, frame(key, [{"repo": "a", name: 7}]), as_of)
    write_raw(store, "raw_contributors", frame("raw_contributors", [{"repo_full_name": "a", "contributor": "x"}]), as_of)
    store.land = land
    return store


def content(store):
    return {key: rows(store.read(key)) for key in TABLES if key != "run_log"}


def test_snapshot_refresh_can_be_repeated(landed, as_of):
    metrics = refresh(landed, as_of).first()
    assert (metrics.total_records, metrics.final_records, metrics.enriched_records, metrics.risk_records) == (2, 2, 2, 2)
    first = content(landed)
    refresh(landed, as_of)
    assert content(landed) == first


def test_refresh_leaves_other_sources_alone(landed, frame, as_of):
    landed.append("risk_product", frame("risk_product", [{"full_name": "z", "data_source": "git_lab"}]))
    refresh(landed, as_of)
    assert rows(landed.read("risk_product"), "data_source", "full_name") == [
        ("git_hub", "a"), ("git_hub", "b"), ("git_lab", "z"),
    ]


def test_append_refresh_joins_every_copy_with_every_copy(landed, as_of):
    refresh(landed, as_of, mode="append")
    assert landed.read("repo_entryline").filter("full_name = 'a'").count() == 1
    refresh(landed, as_of, mode="append")
    per_run = 1 + 2**4  # stage, commits, issues and releases hold two copies each
    assert landed.read("repo_entryline").filter("full_name = 'a'").count() == per_run
    with pytest.raises(ValueError):
        refresh(landed, as_of, mode="merge")


def log(store):
    return store.read("run_log")


def states(store):
    return [tuple(r) for r in log(store).orderBy("ts", "status").select("run_id", "stage", "status").collect()]


def test_counters_are_those_of_the_run(landed, as_of):
    first = refresh(landed, as_of, mode="append").first()
    second = refresh(landed, as_of, mode="append").first()
    assert (first.final_records, first.contributors_loaded, first.enriched_records, first.risk_records) == (2, 1, 2, 2)
    # The second run stages as much again; every copy of 'a' meets every copy, 'b' is there twice.
    assert (second.final_records, second.contributors_loaded, second.enriched_records) == (2, 1, 2**4 + 2)
    assert second.high_risk + second.medium_risk + second.low_risk == second.risk_records == 2 + 2**4 + 2
    assert load_metrics(landed.read_layers()).first().final_records == 4


def test_failed_refresh_leaves_the_old_layers(landed, as_of, monkeypatch):
    refresh(landed, as_of)
    before = content(landed)
    landed.land("c")

    def broken(*_):
        return landed.read("repo_entryline").withColumn("full_name", F.raise_error(F.lit("no")).cast("string"))

    monkeypatch.setattr(plan, "risk_product", broken)
    with pytest.raises(Exception, match="no"):
        refresh(landed, as_of)
    assert rows(landed.read("risk_product")) == before["risk_product"]


def test_runs_of_two_checkpoints_are_two(landed, tmp_path):
    for name in ("one", "two"):
        assert refresh_if_new(landed, str(tmp_path / name), NOW) is True
    latest = run_log_latest(log(landed)).collect()
    assert [(r.run_id, r.status, r.source) for r in latest] == [(0, "COMPLETED", "git_hub")] * 2
    assert len({r.stream for r in latest}) == 2


def test_one_run_per_arrival_and_none_when_idle(landed, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")
    assert refresh_if_new(landed, checkpoint, NOW) is True
    assert refresh_if_new(landed, checkpoint, NOW) is False
    assert landed.read("risk_product").count() == 2
    landed.land("c")
    assert refresh_if_new(landed, checkpoint, NOW) is True
    assert landed.read("risk_product").count() == 3  # the whole raw table is read again
    assert states(landed) == [
        (0, "FULL_PIPELINE", "STARTED"), (0, "FULL_PIPELINE", "COMPLETED"), (None, "CHECK_STREAM", "SKIPPED"),
        (1, "FULL_PIPELINE", "STARTED"), (1, "FULL_PIPELINE", "COMPLETED"),
    ]
    assert rows(run_log_latest(log(landed)), "run_id", "status") == [(0, "COMPLETED"), (1, "COMPLETED")]


def test_failed_run_is_logged_raised_and_tried_again(landed, tmp_path, monkeypatch):
    checkpoint = str(tmp_path / "checkpoint")

    def broken(*_):
        raise RuntimeError("x" * 600)

    with monkeypatch.context() as patch:
        patch.setattr(arrivals, "refresh", broken)
        with pytest.raises(StreamingQueryException):
            refresh_if_new(landed, checkpoint, NOW)
    (row,) = run_log_latest(log(landed)).collect()
    assert (row.run_id, row.status) == (0, "ERROR")
    assert row.message == f"Pipeline failed: {'x' * 600}"
    stream = row.stream
    assert refresh_if_new(landed, checkpoint, NOW) is True
    (row,) = run_log_latest(log(landed)).collect()
    assert (row.stream, row.run_id, row.status, row.message) == (stream, 0, "COMPLETED", fx.MESSAGE_COMPLETED)
    assert row.end_time >= row.start_time


def test_periodic_refresh(spark, landed, tmp_path):
    spark.conf.set("spark.sql.streaming.noDataProgressEventInterval", "1000")
    query = refresh_periodically(landed, str(tmp_path / "checkpoint"), "1 second", NOW)
    try:
        query.processAllAvailable()
        assert landed.read("risk_product").count() == 2
        landed.land("c", "d")
        query.processAllAvailable()
        assert landed.read("risk_product").count() == 4
        time.sleep(4)  # some idle intervals, which write nothing by themselves
        assert ("SKIPPED",) not in rows(log(landed), "status")
        listeners = spark._jsparkSession.streams().listListeners()
        query.stop()
        for _ in range(30):
            if ("SKIPPED",) in rows(log(landed), "status"):
                break
            time.sleep(1)
        assert (None, "CHECK_STREAM", "SKIPPED") in states(landed)
        assert len(spark._jsparkSession.streams().listListeners()) == len(listeners) - 1
    finally:
        query.stop()
        spark.conf.unset("spark.sql.streaming.noDataProgressEventInterval")


def test_latest_state_of_runs(spark):
    def entry(run, status, minute, stage="FULL_PIPELINE", stream="s"):
        return (stream, run, "git_hub", "GITHUB_RISK", stage, status, status.lower(), datetime(2020, 1, 1, 0, minute))

    df = spark.createDataFrame(
        [
            entry(1, "STARTED", 0), entry(1, "COMPLETED", 0),  # same time: the final one is later
            entry(2, "STARTED", 1), entry(2, "ERROR", 2), entry(2, "STARTED", 3),  # tried again
            entry(3, "STARTED", 4), entry(3, "COMPLETED", 5, stream="t"), entry(None, "SKIPPED", 9, "CHECK_STREAM"),
        ],
        TABLES["run_log"].schema,
    )
    start, end = F.minute("start_time"), F.minute("end_time")
    assert rows(run_log_latest(df).select("run_id", "status", start, end)) == [
        (1, "COMPLETED", 0, 0), (2, "STARTED", 1, None), (3, "COMPLETED", None, 5), (3, "STARTED", 4, None),
    ]
