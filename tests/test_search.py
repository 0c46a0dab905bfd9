from datetime import datetime

import pytest
from conftest import NOW, rows
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from pyspark.sql import functions as F
from repovitals import union_by_priority, push_ages, repos_from_search
from repovitals.functions.times import ntz
from repovitals.schemas import SEARCH_ITEM


def item(key, name, pushed=None, owner=("o",)):
    return (key, name, name, owner, None, 1, 2, "u", "2020-01-01T00:00:00Z", "bad", 3, True, pushed)


@pytest.fixture(scope="module")
def pages(spark):
    schema = StructType([StructField("page", LongType()), StructField("items", ArrayType(SEARCH_ITEM))])
    data = [
        (2, [item(1, "late"), item(3, "c", "2020-06-14T12:00:01Z")]),
        (1, [item(2, "b", "2020-05-16T12:00:00Z"), item(1, "first", "2020-06-16T12:00:00Z"), item(1, "second")]),
        (3, []),
        (4, None),
        (5, [item(4, "d", None, None), item(5, "e", "2020-03-17T12:00:00Z"), item(6, "f", "2020-03-18T12:00:00Z")]),
    ]
    return spark.createDataFrame(data, schema)


def test_first_item_of_an_id_wins(pages):
    got = repos_from_search(pages)
    assert rows(got, "id", "full_name", "owner") == [
        ("1", "first", "o"), ("2", "b", "o"), ("3", "c", "o"), ("4", "d", None), ("5", "e", "o"), ("6", "f", "o"),
    ]
    assert rows(got.limit(1), "created_at", "updated_at", "archived") == [(datetime(2020, 1, 1), None, True)]


def test_push_ages_are_full_days(pages):
    assert rows(push_ages(pages, ntz(NOW)), "id", "days_since_push", "push_recency") == [
        ("1", -1, "under_30_days"), ("2", 30, "under_90_days"), ("3", 0, "under_30_days"), ("4", None, "none"),
        ("5", 90, "older"), ("6", 89, "under_90_days"),
    ]


def test_union_keeps_all_rows_with_their_priority(spark):
    first = spark.createDataFrame([("b", "x"), ("a", "y")], "id string, full_name string")
    second = spark.createDataFrame([("a", "z"), ("c", "w")], "id string, full_name string").withColumn("more", F.lit(1))
    assert rows(union_by_priority([first, second]), "priority", "full_name", "more") == [
        (1, "x", None), (1, "y", None), (2, "w", 1), (2, "z", 1),
    ]
