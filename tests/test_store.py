import gzip
import json
from pathlib import Path

import pytest
from conftest import NOW, rows
from pyarrow.parquet import ParquetFile
from pyspark.sql import functions as F

from repovitals import (
    LayerStore,
    SearchPages,
    read_event_log,
    read_search_pages,
    repos_from_search,
    to_raw_repositories,
    write_raw,
)
from repovitals.schemas import TABLES, conform
from repovitals.sources import store as store_module
from repovitals.sources.landing import too_wide
from repovitals.sources.store import shared_folder


def test_replace_touches_one_source_only_and_may_empty_it(store, frame):
    store.append("hub_issues", frame("hub_issues", [{"repo": "a"}, {"repo": "b", "data_source": "git_lab"}]))
    store.replace("hub_issues", frame("hub_issues", [{"repo": "c"}]), "git_hub")
    assert rows(store.read("hub_issues"), "data_source", "repo") == [("git_hub", "c"), ("git_lab", "b")]
    store.replace("hub_issues", frame("hub_issues", []), "git_hub")
    assert rows(store.read("hub_issues"), "repo") == [("b",)]


def test_source_names_are_text_and_safe(store, frame):
    store.append("hub_issues", frame("hub_issues", [{"repo": "a", "data_source": "007"}, {"repo": "b", "data_source": None}]))
    assert rows(store.read("hub_issues"), "data_source", "repo") == [(None, "b"), ("007", "a")]
    with pytest.raises(ValueError):
        store.replace("hub_issues", frame("hub_issues", []), "../x")


def test_created_tables_can_be_read_and_are_kept(store, frame):
    store.create_tables()
    assert all(store.read(key).count() == 0 for key in TABLES)
    store.append("hub_issues", frame("hub_issues", [{"repo": "a"}]))
    store.create_tables()
    assert store.read("hub_issues").count() == 1
    assert store.read("hub_issues").schema == TABLES["hub_issues"].schema


def test_raw_writes(store, spark, as_of):
    def one(source, repo):
        return spark.createDataFrame([(source, repo)], "data_source string, repo string")

    write_raw(store, "raw_releases", one("git_hub", "x" * 500), as_of)
    write_raw(store, "raw_releases", one("git_lab", "b"), as_of)
    table = store.read("raw_releases")
    assert rows(table, "repo", "release_count", "last_release_date", "days_since_last_release", "load_timestamp") == [
        ("b", 0, None, 999, NOW), ("x" * 500, 0, None, 999, NOW),
    ]
    write_raw(store, "raw_releases", one("git_hub", "c"), as_of, "overwrite")
    assert rows(store.read("raw_releases"), "repo") == [("b",), ("c",)]
    write_raw(store, "raw_releases", one("git_hub", "d"), as_of, "truncate")
    assert rows(store.read("raw_releases"), "repo") == [("d",)]
    with pytest.raises(ValueError):
        write_raw(store, "raw_releases", one("git_hub", "d"), as_of, "replace")


def test_default_fills_absent_columns_not_null_values(spark, as_of):
    df = spark.createDataFrame([("7", None)], "stars string, forks int")
    row = conform(df, TABLES["raw_repositories"], as_of).first()
    assert (row.stars, row.forks, row.id, row.load_timestamp) == (7, None, None, NOW)


def test_event_log_skips_bad_lines_in_all_matching_files(spark, tmp_path):
    def line(i):
        return json.dumps({"type": "PushEvent", "created_at": f"2020-01-0{i}T00:00:00Z", "repo": {"name": f"o/{i}", "id": 1},
                           "actor": {"login": "x"}, "payload": {"big": [1]}})

    for hour, lines in {12: [line(1), line(2)[:30], "", line(3)], 14: ["not json", line(4), '{"type": "PushEvent", "repo": "text"}', "{}"]}.items():
        with gzip.open(tmp_path / f"2020-01-01-{hour}.json.gz", "wt") as file:
            file.write("\n".join(lines))
    log = read_event_log(spark, str(tmp_path / "2020-01-01-*.json.gz"))
    assert rows(log, "repo.name") == [("o/1",), ("o/3",), ("o/4",)]
    assert log.columns == ["type", "created_at", "repo", "actor"]
    assert log.count() == 3 and len(rows(log, "type")) == 3  # whatever is asked for


def test_search_pages_are_ordered_by_file(spark, tmp_path, store, as_of):
    def item(key, name):
        return {"id": key, "full_name": name, "name": name, "owner": {"login": "o"}, "language": "", "stargazers_count": 1,
                "forks_count": 2, "html_url": "u", "created_at": "2020-01-01T00:00:00Z", "updated_at": None,
                "open_issues_count": 1, "archived": False, "extra": {"a": 1}}

    (tmp_path / "page-1.json").write_text(json.dumps({"total_count": 2, "items": [item(1, "a"), item(2, "b")]}, indent=1))
    (tmp_path / "page-2.json").write_text(json.dumps({"items": [item(2, "late"), item(3, "c" * 500)]}))
    found = repos_from_search(read_search_pages(spark, str(tmp_path / "page-*.json")))
    assert rows(found, "full_name") == [("a",), ("b",), ("c" * 500,)]
    write_raw(store, "raw_repositories", to_raw_repositories(found), as_of)
    assert rows(store.read("raw_repositories"), "full_name", "language", "forks") == [
        ("a", "Unknown", 2), ("b", "Unknown", 2), ("c" * 500, "Unknown", 2),
    ]


def test_long_names_stay_apart(store, spark, as_of):
    long = "x" * 400
    df = spark.createDataFrame([("git_hub", f"{long}{end}") for end in "ab"], "data_source string, repo string")
    write_raw(store, "raw_releases", df, as_of)
    assert rows(store.read("raw_releases"), "repo") == [(f"{long}a",), (f"{long}b",)]
    assert rows(too_wide(df, TABLES["raw_releases"].widths), "repo", "data_source") == [(2, 0)]


def test_failed_replacement_leaves_the_old_rows(store, frame):
    new = frame("hub_issues", [{"repo": "b"}])
    store.append("hub_issues", frame("hub_issues", [{"repo": "a"}]))
    for old in ([("a",)], [("b",)]):
        failing = new.withColumn("repo", F.raise_error(F.lit("no")).cast("string"))
        with pytest.raises(Exception, match="no"):
            store.replace("hub_issues", failing, "git_hub")
        assert rows(store.read("hub_issues"), "repo") == old
        store.replace("hub_issues", new, "git_hub")
        assert rows(store.read("hub_issues"), "repo") == [("b",)]
    store.append("hub_issues", frame("hub_issues", [{"repo": "c"}, {"repo": "d", "data_source": "git_lab"}]))
    assert rows(store.read("hub_issues"), "repo") == [("b",), ("c",), ("d",)]


def test_pages_come_in_the_order_of_their_numbers(spark, tmp_path):
    for folder, numbers in (("one", (10, 2, 1)), ("two", (1,))):
        (tmp_path / folder).mkdir()
        for number in numbers:
            items = [{"id": 7, "full_name": f"{folder}-{number}"}, {"id": 100 + number, "full_name": f"{folder}-{number}"}]
            (tmp_path / folder / f"page_{number}.json").write_text(json.dumps({"items": items}))
    found = repos_from_search(read_search_pages(spark, str(tmp_path / "*")))
    assert rows(found, "id", "full_name") == [("101", "one-1"), ("102", "one-2"), ("110", "one-10"), ("7", "one-1")]


def test_log_can_be_compacted(store, frame, spark):
    store.create_tables()
    for i in range(4):
        store.append("run_log", frame_of_log(spark, i))
    before = rows(store.read("run_log"))
    store.compact("run_log")
    assert rows(store.read("run_log")) == before and len(store.read("run_log").inputFiles()) == 1
    store.append("run_log", frame_of_log(spark, 9))
    assert store.read("run_log").count() == 5
    with pytest.raises(ValueError):
        store.compact("hub_issues")


def frame_of_log(spark, i):
    schema = TABLES["run_log"].schema
    return spark.createDataFrame([tuple(i if name == "run_id" else None for name in schema.names)], schema)


def test_shared_folder_lies_in_the_folder_of_the_session(spark):
    assert shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_folder(spark) != shared_folder(spark)


def test_root_may_end_in_a_slash(spark):
    assert LayerStore(spark, "/x/").path("hub_issues") == "/x/linkmap/hub_repo_issues"


def test_overwrite_counts_after_a_replacement(store, frame, as_of):
    def land(mode, *rows_):
        data = [{"repo": repo, "data_source": source} for source, repo in rows_]
        write_raw(store, "raw_issues", frame("raw_issues", data), as_of, mode)

    def seen():
        return rows(store.read("raw_issues"), "data_source", "repo")

    land("append", ("git_hub", "a"), ("git_lab", "b"), (None, "c"))
    store.replace("raw_issues", frame("raw_issues", [{"repo": "d"}]), "git_hub")
    land("overwrite", ("git_hub", "e"), (None, "f"))
    assert seen() == [(None, "f"), ("git_hub", "e"), ("git_lab", "b")]
    land("append", ("git_hub", "g"))
    assert seen() == [(None, "f"), ("git_hub", "e"), ("git_hub", "g"), ("git_lab", "b")]
    land("truncate", ("git_lab", "h"))
    assert seen() == [("git_lab", "h")]
    land("append", ("git_hub", "i"))
    assert seen() == [("git_hub", "i"), ("git_lab", "h")]
    land("truncate")
    assert seen() == []


@pytest.mark.parametrize("mode", ["overwrite", "truncate"])
def test_a_failed_overwrite_leaves_the_old_rows(store, frame, as_of, mode):
    write_raw(store, "raw_issues", frame("raw_issues", [{"repo": "a"}, {"repo": "b", "data_source": "git_lab"}]), as_of)
    rows_ = frame("raw_issues", [{"repo": str(i)} for i in range(40)]).repartition(4)
    broken = rows_.withColumn("open_issues", F.when(F.col("repo") == "7", F.raise_error(F.lit("no"))).otherwise(1))
    with pytest.raises(Exception):  # noqa: B017
        write_raw(store, "raw_issues", broken, as_of, mode)
    assert rows(store.read("raw_issues"), "data_source", "repo") == [("git_hub", "a"), ("git_lab", "b")]
    write_raw(store, "raw_issues", frame("raw_issues", [{"repo": "c"}]), as_of, mode)
    assert ("git_hub", "c") in rows(store.read("raw_issues"), "data_source", "repo")


def test_packed_pages_are_ordered_by_their_names(spark, tmp_path):
    def line(page, *ids):
        return json.dumps({"page": page, "items": [{"id": i, "full_name": f"{page}/{i}"} for i in ids]})

    (tmp_path / "b.json").write_text("\n".join([line("page_10", 1, 2), "no page", line("page_2", 2, 3)]) + "\n")
    (tmp_path / "a.json").write_text(line("page_10", 2, 4, 1) + "\n")
    found = repos_from_search(read_search_pages(spark, str(tmp_path), packed=True))
    assert rows(found, "id", "full_name") == [("1", "page_10/1"), ("2", "page_2/2"), ("3", "page_2/3"), ("4", "page_10/4")]
    pages = SearchPages(LayerStore(spark, str(tmp_path / "store")), packed=True)
    pages.absorb(str(tmp_path / "*.json"))
    assert rows(pages.repositories()) == rows(found)


@pytest.mark.parametrize("mode", ["append", "truncate"])
def test_row_groups_of_raw_tables_are_bounded(spark, store, as_of, monkeypatch, mode):
    monkeypatch.setattr(store_module, "GROUP_ROWS", {option: 100 for option in store_module.GROUP_ROWS})
    names = spark.range(0, 950, 1, 1).select(F.lit("git_hub").alias("data_source"), F.col("id").cast("string").alias("repo"))
    write_raw(store, "raw_releases", names, as_of, mode)
    (file,) = Path(store.path("raw_releases")).rglob("*.parquet")
    groups = ParquetFile(file).metadata
    assert [groups.row_group(i).num_rows for i in range(groups.num_row_groups)] == [100] * 9 + [50]
    assert store.read("raw_releases").count() == 950
