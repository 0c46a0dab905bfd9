import re
from pathlib import Path

import pytest
from conftest import NOW, rows

from repovitals import NameSearch, report_search
from repovitals.plans import name_search

NAMES = [
    "org/alpha", "org/beta", "org/50%_off", "org/b\\slash", "ORG/Gamma", "x" * 40, "none/score", "straße/ab", "a", "",
    "ab", "\U0001f600/é", "aaa/aaaa", None, *(f"brand{i % 4}/repo-{i}" for i in range(60)),
]
TERMS = [
    "ALP", "org/_eta", "b\\s", "%", "", "_", "__", "___", "nothing", "a", "AB", "ß", "SS", "repo-1", "brand1%5", "d_/r_p",
    "\U0001f600", "É", "aaaa", "%%a%", "x" * 41, "0%_", None, "a", "-59",
]


@pytest.fixture(scope="module")
def product(frame):
    data = [
        {"full_name": n, "risk_score": [None, 5.0, 90.0, 90.0][i % 4], "stars": i, "last_updated": NOW}
        for i, n in enumerate(NAMES)
    ]
    return frame("risk_product", [*data, *data[:3], {**data[0], "data_source": "git_lab"}])


def terms_of(spark, terms):
    return spark.createDataFrame([(t, 1) for t in terms], "term string, full_name int")


@pytest.fixture(scope="module")
def expected(product):
    """What a scan for each term gives."""
    return sorted(
        (term, place, row.full_name, row.stars)
        for term in set(TERMS) - {None}
        for place, row in enumerate(report_search(product, term, 100).collect(), 1)
    )


def test_equals_a_scan_for_each_term_whatever_the_additions(spark, store, product, expected):
    index = NameSearch(store, buckets=8)
    terms = terms_of(spark, TERMS)
    assert index.search(product, terms).collect() == []
    index.add(product.where("stars % 2 = 0"))
    NameSearch(store, buckets=8).add(product)  # goes on from what the folder holds
    index.add(product)
    postings = index.postings()
    assert postings.count() == postings.distinct().count()
    assert postings.where("gram = ''").count() == len(set(NAMES) - {None})
    for n in (3, 100):
        got = index.search(product, terms, n).select("term", "place", "full_name", "stars")
        assert sorted(map(tuple, got.collect())) == [e for e in expected if e[1] <= n]


def test_candidates_hold_all_grams(spark, store, product):
    index = NameSearch(store)
    index.add(product)
    assert rows(index.candidates(terms_of(spark, ["nothing", "alp", None]))) == [("alp", "org/alpha")]


def test_a_failed_addition_does_not_count_and_can_be_made_again(spark, store, product):
    index = NameSearch(store, buckets=4)
    index.add(product.where("stars < 20"))
    half = f"{index.folder}/added/version={2:020d}"
    index.postings().write.partitionBy("bucket").parquet(half)
    (Path(half) / "_SUCCESS").unlink()
    held = index.postings().count()
    index.add(product)
    assert index.postings().count() == index.postings().distinct().count() > held


def test_additions_are_folded(spark, store, product, expected, monkeypatch):
    monkeypatch.setattr(name_search, "FOLD_AFTER", 3)
    index = NameSearch(store, buckets=4)
    for i in range(4):
        index.add(product.where(f"stars % 4 = {i}"))
    folded, added = index._versions()
    assert (folded, added) == (3, [4])
    got = index.search(product, terms_of(spark, TERMS), 5).select("term", "place", "full_name", "stars")
    assert sorted(map(tuple, got.collect())) == [e for e in expected if e[1] <= 5]


def test_no_names_and_no_terms(spark, store, product):
    index = NameSearch(store)
    index.add(product.limit(0))
    assert index.search(product, terms_of(spark, TERMS)).collect() == []
    index.add(product)
    assert index.search(product, terms_of(spark, [])).collect() == []


def test_plan_prunes_files_and_has_no_pairs(spark, store, product):
    index = NameSearch(store)
    index.add(product)
    plan = index.search(product, terms_of(spark, ["alpha", "brand1"]))._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "WindowGroupLimit" in plan


def test_only_the_rarest_gram_of_a_term_is_looked_up(spark, store, product):
    index = NameSearch(store)
    index.add(product)
    found = index.candidates(terms_of(spark, ["repo-17"]))
    assert rows(found) == [("repo-17", "brand1/repo-17")]
    # REP, EPO, PO- and O-1 are in many names, -17 in one: names meet a term once, and are not grouped by it after.
    above = found._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")[0]
    assert "Aggregate" not in above


def test_names_of_an_addition_are_dealt_to_many_tasks(spark, store, monkeypatch):
    tasks = []
    monkeypatch.setattr(NameSearch, "_write", lambda self, postings, path: tasks.append(postings.rdd.getNumPartitions()))
    NameSearch(store).add(spark.range(1000).selectExpr("concat('r', id) as full_name"))
    assert tasks == [int(spark.conf.get("spark.sql.shuffle.partitions"))]


def test_terms_are_cut_into_grams_once_each_and_not_in_every_copy(spark, store, product):
    index = NameSearch(store)
    index.add(product)
    copies = spark.range(100).selectExpr("concat('term', id % 2) as term")
    text = index.candidates(copies)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in text.splitlines() if "Filter" in line and "split(" in line]
    assert not filters
