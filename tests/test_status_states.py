from datetime import datetime

import pytest
from conftest import NOW, rows

from repovitals import StatusStates, pipeline_status, write_raw
from repovitals import fixed_values as fx
from repovitals.plans.monitoring import status_section, table_profile
from repovitals.streaming import kept_states
from repovitals.streaming.status_states import FIGURES


CHANGING = ("raw_repositories", "hub_contributors")


def _same(states, store):
    """The states know every figure of the changing tables as the tables do."""
    tables = {key: store.read(key) for key in CHANGING}
    assert rows(states.profile(CHANGING, distinct=True)) == rows(table_profile(tables, CHANGING, apart=True))


@pytest.fixture
def contributors(frame):
    def make(*found, source="git_hub"):
        return frame("hub_contributors", [
            {"data_source": source, "repo_full_name": repo, "contributor": name, "total_commits": n, "load_timestamp": NOW}
            for repo, name, n in found
        ])

    return make


def test_empty_store(store):
    states = StatusStates(store)
    assert states.absorb() == 0
    assert states.pipeline_status().count() == states.table_stats().count() == 0


def test_appended_replaced_and_folded(store, frame, as_of, contributors, monkeypatch):
    monkeypatch.setattr(kept_states, "FOLD_AFTER", 2)
    states = StatusStates(store)
    first = [{"id": " ", "stars": -1, "created_at": datetime(2020, 1, 1)}, {"id": "2", "created_at": datetime(2020, 1, 2)},
             {"data_source": None}, {"data_source": "", "forks": -3}, {"data_source": "a b/c", "stars": -2}]
    write_raw(store, "raw_repositories", frame("raw_repositories", first), as_of)
    store.append("hub_contributors", contributors(("r", "a", 1), ("r", "b", 2), ("r", None, None)))
    assert states.absorb() == 2
    assert states.absorb(CHANGING) == 0
    _same(states, store)
    # Values that were there, new ones, and another source.
    store.append("hub_contributors", contributors(("r", "a", 4), ("s", "c", 2)))
    store.append("hub_contributors", contributors(("r", "a", 4), source="git_lab"))
    assert states.absorb(CHANGING) == 1
    _same(states, store)
    # A replaced source loses its old rows, the other keeps them.
    store.replace("hub_contributors", contributors(("t", "z", 9)), "git_hub")
    states.absorb(CHANGING)
    _same(states, store)
    store.replace("hub_contributors", contributors(("t", "z", 9), ("t", "y", None)), "git_hub")
    write_raw(store, "raw_repositories", frame("raw_repositories", [{"data_source": "a b/c"}]), as_of, "truncate")
    states.absorb(CHANGING)
    _same(states, store)
    kept = states.tables["hub_contributors"]
    assert kept._folded_upto() > 0
    kept.fold()
    _same(states, store)
    assert rows(states.pipeline_status()) == rows(pipeline_status(store.read_layers()))
    assert kept.states().filter("data_source = 'git_hub' and value = 'a'").count() == 0  # of a snapshot that is gone


def test_new_snapshot_counts_once_committed(spark, store, contributors):
    states = StatusStates(store)
    store.append("hub_contributors", contributors(("r", "a", 1)))
    states.absorb(["hub_contributors"])
    # A snapshot whose files are there, but which has not been committed.
    folder = f"{store.path('hub_contributors')}/data_source=git_hub/version={7:020d}"
    new = contributors(("t", "z", 9), ("t", "y", 9)).drop("data_source")
    new.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(folder)
    assert states.absorb(["hub_contributors"]) == 1
    states.tables["hub_contributors"].fold()
    _same(states, store)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True).close()
    _same(states, store)
    assert rows(states.profile(CHANGING, distinct=True), "record_count", "metric_2") == [(2, 2.0)]


def test_sections_and_reads(store, contributors, frame):
    states = StatusStates(store)
    store.append("hub_contributors", contributors(("r", "a", 1)))
    store.append("risk_product", frame("risk_product", [{"risk_category": "HIGH", "risk_score": 80.0, "last_updated": NOW}]))
    states.absorb(["hub_contributors", "risk_product"])
    tables = store.read_layers()
    for section in (fx.SECTION_LOADS, fx.SECTION_RISK):
        assert rows(states.pipeline_status([section])) == rows(status_section(tables, section))
    plan = states.pipeline_status()._jdf.queryExecution().executedPlan().toString()
    assert store.path("hub_contributors") + "/" not in plan  # no table is read
    assert f"part#" in plan and f"= {FIGURES}" in plan  # nor are distinct values
