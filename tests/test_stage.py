from datetime import datetime, timedelta

import pytest
from conftest import NOW, rows

from repovitals import cleanse_repositories, stage_repositories

GOOD = {
    "id": "1", "name": "n", "full_name": "o/n", "owner": "o", "language": "Go",
    "stars": 5, "forks": 6, "html_url": "u",
    "created_at": datetime(2019, 1, 1), "updated_at": datetime(2020, 1, 1),
}


def cleansed(frame, as_of, **changes):
    return cleanse_repositories(frame("raw_repositories", [{**GOOD, **changes}]), as_of).first()


def test_blank_text_gets_defaults_and_other_text_is_trimmed(frame, as_of):
    row = cleansed(frame, as_of, id=" 1 ", name="  ", full_name=None, owner="", language=" ", html_url=None)
    assert (row.id, row.name, row.full_name) == ("1", "UNKNOWN", "UNKNOWN/UNKNOWN")
    assert (row.owner, row.language, row.html_url) == ("UNKNOWN", "Unknown", "https://github.com/UNKNOWN")
    assert cleansed(frame, as_of, owner="  a b ").owner == "a b"


def test_only_spaces_are_trimmed(frame, as_of):
    row = cleansed(frame, as_of, name="\t", owner="\tx ")
    assert (row.name, row.owner, row.valid_flag) == ("\t", "\tx", True)


@pytest.mark.parametrize(
    "changes, flag, reason",
    [
        ({}, True, "Valid"),
        ({"id": " "}, False, "Missing ID"),
        ({"id": None, "name": None}, False, "Missing ID"),
        ({"name": ""}, False, "Missing Name"),
        ({"full_name": None}, False, "Missing Full Name"),
        ({"stars": -1, "forks": -1}, False, "Negative Stars Count"),
        ({"forks": -1}, False, "Negative Forks Count"),
        ({"stars": None}, False, "Valid"),
        ({"forks": None}, False, "Valid"),
        ({"created_at": None}, True, "Valid"),
        ({"stars": 0, "forks": 0}, True, "Valid"),
    ],
)
def test_flag_and_reason_are_separate_rules_on_raw_values(frame, as_of, changes, flag, reason):
    row = cleansed(frame, as_of, **changes)
    assert (row.valid_flag, row.invalid_reason) == (flag, reason)


def test_negative_counts_become_zero_and_null_stays(frame, as_of):
    assert cleansed(frame, as_of, stars=-3, forks=None)[6:8] == (0, None)


def test_time_defaults(frame, as_of):
    neither = cleansed(frame, as_of, created_at=None, updated_at=None)
    assert neither.created_at == NOW - timedelta(days=365)
    assert neither.updated_at == NOW
    assert cleansed(frame, as_of, updated_at=None).updated_at == GOOD["created_at"]
    assert neither.load_timestamp == NOW


def test_latest_row_wins_even_when_invalid(frame, as_of):
    raw = frame(
        "raw_repositories",
        [GOOD, {**GOOD, "id": "2", "full_name": " o/n ", "stars": -1, "updated_at": datetime(2020, 2, 1)}],
    )
    assert rows(stage_repositories(raw, as_of), "id", "valid_flag") == [("2", False)]


def test_ties_are_broken_by_id_then_by_the_other_columns(frame, as_of):
    raw = frame(
        "raw_repositories",
        [{**GOOD, "id": "2"}, {**GOOD, "id": "1", "language": "B"}, {**GOOD, "id": "1", "language": "A"},
         {**GOOD, "id": None}],
    )
    assert rows(stage_repositories(raw, as_of), "id", "language") == [("1", "A")]


def test_missing_names_collapse_and_other_sources_stay_out(frame, as_of):
    raw = frame(
        "raw_repositories",
        [{**GOOD, "full_name": None}, {**GOOD, "full_name": " "}, {**GOOD, "data_source": "git_lab"},
         {**GOOD, "data_source": None}],
    )
    assert rows(stage_repositories(raw, as_of), "full_name") == [("UNKNOWN/UNKNOWN",)]
    assert rows(stage_repositories(raw, as_of, "git_lab"), "full_name") == [("o/n",)]
