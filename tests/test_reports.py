import pytest
from conftest import NOW, rows

from repovitals import (
    export_csv,
    report_all,
    report_by_language,
    report_repo,
    report_search,
    report_summary,
    report_top,
    report_top_display,
)
from repovitals.schemas import TABLES


@pytest.fixture(scope="module")
def product(frame):
    data = [
        ("org/alpha", "Go", 90.0, "HIGH"), ("org/beta", None, 90.0, "HIGH"), ("org/50%_off", "Unknown", 50.0, "MEDIUM"),
        ("org/b\\slash", "Go", 45.0, "MEDIUM"), ("ORG/Gamma", "Go", 10.0, "LOW"), ("x" * 40, "C", 11.0, "LOW"),
        ("y" * 41, "C", 12.0, "LOW"), ("none/score", "C", None, "LOW"),
    ]
    made = [{"full_name": n, "language": g, "risk_score": s, "risk_category": c, "last_updated": NOW} for n, g, s, c in data]
    return frame("risk_product", [*made, {**made[0], "data_source": "git_lab"}])


def names(df):
    return [row.full_name for row in df.collect()]


def test_summary(product):
    assert rows(report_summary(product)) == [(8, 44.0, 2, 2, 4, NOW, 25.0, 25.0, 50.0)]


def test_summary_without_rows(frame):
    assert rows(report_summary(frame("risk_product", []))) == [(0, None, 0, 0, 0, None, None, None, None)]


def test_top_and_bottom_with_ties_and_missing_scores(product):
    assert names(report_top(product, 4)) == ["none/score", "org/alpha", "org/beta", "org/50%_off"]
    assert names(report_top(product, 3, risky=False)) == ["ORG/Gamma", "x" * 40, "y" * 41]
    assert names(report_top(product, 100, risky=False))[-1] == "none/score"


def test_display_shortens_names_and_names_missing_languages(product):
    shown = {row.full_name: row.language for row in report_top_display(product, 20).collect()}
    assert shown["x" * 40] == "C" and shown["y" * 38 + ".."] == "C" and shown["org/beta"] == "N/A"


def test_no_language_and_unknown_are_two_groups(product):
    got = [tuple(row) for row in report_by_language(product).collect()]
    assert got == [("C", 3, 11.5, 0, 0, 3), ("Go", 3, 48.33, 1, 1, 1), ("Unknown", 1, 50.0, 0, 1, 0), ("Unknown", 1, 90.0, 1, 0, 0)]
    assert len(report_by_language(product, 2).collect()) == 2


def test_search(product):
    assert names(report_search(product, "ALP")) == ["org/alpha"]
    assert names(report_search(product, "org/_eta")) == ["org/beta"]  # wildcards work
    assert names(report_search(product, "b\\s")) == ["org/b\\slash"]  # a backslash is one
    assert names(report_search(product, "%", 2)) == ["none/score", "org/alpha"]
    assert names(report_search(product, "nothing")) == []


def test_one_repository(product):
    row = report_repo(product, "org/GAMMA").first()
    assert (row.full_name, row.risk_score) == ("ORG/Gamma", 10.0)
    assert row.interpretation.startswith("LOW RISK: Repository appears healthy")
    assert report_repo(product, "org/alpha").first().interpretation.startswith("HIGH RISK:")
    assert report_repo(product, "org/50%_off").first().interpretation.startswith("MEDIUM RISK:")
    assert report_repo(product, "org/%").count() == 0


def test_export_has_headers_and_keeps_the_order(spark, product, tmp_path):
    summary = export_csv(product, str(tmp_path / "out"))
    assert summary.first().total_repos == 8
    files = sorted((tmp_path / "out").glob("part-*.csv"))
    texts = [file.read_text().splitlines() for file in files]
    assert all(text[0].startswith("data_source,full_name,language") for text in texts)
    exported = [line.split(",")[1] for text in texts for line in text[1:]]
    assert exported[:3] == ["none/score", "org/alpha", "org/beta"] and len(exported) == 8
    back = spark.read.schema(TABLES["risk_product"].schema).option("header", True).csv(str(tmp_path / "out"))
    assert rows(back) == rows(product.filter("data_source = 'git_hub'"))


def test_all_reports(product):
    reports = report_all(product)
    assert list(reports) == ["summary", "by_language", "top_risky", "healthiest"]
    assert reports["healthiest"].count() == 8
