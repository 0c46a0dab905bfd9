"""The registered queries against their SQL, and the pipeline against plain loops, on the smallest tables."""

from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import differences, duck
from repovitals.llm.piece_nbest import decode, load_pieces
from repovitals.llm.queries import QUERIES, SQL

from .conftest import DATA
from .test_line_dedup import brute as plain_lines
from .test_set_join import brute as plain_groups

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="needs the given tables")


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, name):
    with duck(DATA) as connection:
        assert differences(QUERIES[name](spark, DATA).toPandas(), connection.sql(SQL[name]).df()) is None


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    rows = {r.doc_id: r for r in docs.collect()}

    known = stages["language"](spark, docs, DATA)
    kept = {r.doc_id for r in known.collect()}
    assert known.columns == docs.columns and kept <= set(rows) and len(kept) > 0.97 * len(rows)

    lines = stages["lines"](spark, docs, DATA)
    want = {i: text for i, n, gone, text in plain_lines([(i, r.text) for i, r in rows.items()]) if not n == gone > 0}
    assert {r.doc_id: r.text for r in lines.collect()} == want
    assert lines.where(F.length("text") != F.col("n_chars")).count() == 0 and lines.columns == docs.columns

    near = stages["near_duplicates"](spark, docs.union(docs.orderBy("doc_id").limit(5)), DATA)
    group = {i: root for i, _, root, _ in plain_groups([(i, r.text) for i, r in rows.items()], 5, 80)}
    assert Counter(r.doc_id for r in near.collect()) == Counter({i for i, root in group.items() if i == root})

    mixed = stages["mixture"](spark, docs, DATA).collect()
    tokens = {i: len((r.text or "").split()) for i, r in rows.items()}
    assert len({r.doc_id for r in mixed}) == len(mixed) < len(rows)
    assert abs(sum(tokens[r.doc_id] for r in mixed) / sum(tokens.values()) - 0.75) < 0.25

    pieces = load_pieces()
    for row in stages["pieces"](spark, docs.limit(20), DATA).collect():
        assert decode(pieces, row.piece_ids) == rows[row.doc_id].text


def test_near_duplicates_are_told_by_id_and_text(spark, texts):
    """Repeated and missing ids, against a plain loop over the rows."""
    words = [f"w{i}" for i in range(40)]
    near = " ".join([*words[:-1], "other"])
    rows = [
        (1, " ".join(words)), (2, near), (2, "a text of its own that nothing else is like"), (2, "a text of its own that nothing else is like"),
        (None, near), (None, "one two three four five six"), (None, "one two three four five six seven eight nine ten eleven"),
        (None, "ONE two three four five six"), (7, "one two three four five six"), (3, ""), (4, None), (4, None), (None, None),
    ]
    groups: dict = {}
    unique = list(dict.fromkeys(rows))
    numbered = plain_groups([(i, text) for i, (_, text) in enumerate(unique)], 5, 80)
    for i, _, group, _ in numbered:
        groups.setdefault(group, []).append(unique[i])
    least = lambda group: min(r[0] for r in group if r[0] is not None) if any(r[0] is not None for r in group) else None
    got = [(r.doc_id, r.text) for r in dict(corpus_pipeline.STAGES)["near_duplicates"](spark, texts(rows), DATA).collect()]
    assert len(got) == len(groups) and set(got) <= set(rows)
    for group in groups.values():
        assert [r for r in got if r in group][0][0] == least(group)
    assert (2, rows[2][1]) in got and (2, near) not in got and (None, near) not in got


def test_run_is_the_stages_in_order(spark):
    got = corpus_pipeline.run(spark, DATA).collect()
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA)
    key = lambda r: (r.doc_id, r.n_pieces)
    assert sorted(got, key=key) == sorted(docs.collect(), key=key)


def test_odd_rows_pass_all_stages(spark, odd, none):
    extra = ("score", "spans", "n_lines", "epoch")
    for frame in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, DATA)
            if name == "lines":
                assert {r.doc_id for r in out.collect()} >= {3, 5, 6, 7, None} if frame is odd else out.isEmpty()
            if name == "near_duplicates":
                left = Counter((r.doc_id, r.text) for r in out.collect())
                assert not left if frame is none else left[6, "a"] == left[1, None] == left[8, "one two three four five six seven"] == 1
                assert frame is none or {i for i, _ in left} == {1, 2, 3, 5, 6, 7, 8, None}
            out.collect()
            assert name == "pieces" or out.columns == [c for c in frame.columns if c not in extra]
