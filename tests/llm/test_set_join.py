from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from repovitals.llm import set_join
from repovitals.llm.components import connected_components
from repovitals.llm.set_join import jaccard_groups, overlap_links
from repovitals.llm.storage import workspace
from repovitals.llm.texthash import distinct, shingle_runs, shingle_set, word_hashes

from .conftest import DATA


def shingles(text, k):
    words = (text or "").encode().lower().split()
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def brute(rows, k, percent):
    sets = [shingles(text, k) for _, text in rows]
    where = defaultdict(list)
    for i, own in enumerate(sets):
        for shingle in own:
            where[shingle].append(i)
    group, links = list(range(len(rows))), Counter()
    for i, own in enumerate(sets):
        met = Counter(j for shingle in own for j in where[shingle] if j != i)
        for j, n in met.items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                links[i] += 1
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    least = {}
    for i, g in enumerate(group):
        if rows[i][0] is not None:
            least[g] = min(least.get(g, rows[i][0]), rows[i][0])
    key = lambda row: tuple((v is not None, v) for v in row)
    return sorted(((rows[i][0], len(sets[i]), least.get(group[i]), links[i]) for i in range(len(rows))), key=key)


def found(frame, k, percent):
    key = lambda row: tuple((v is not None, v) for v in row)
    return sorted(map(tuple, jaccard_groups(frame, k, percent).collect()), key=key)


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_equals_all_pairs(spark, k, percent):
    frame = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    assert found(frame, k, percent) == brute(rows, k, percent)


def test_families_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(set_join, "BLOCK_SHINGLES", 40)
    monkeypatch.setattr(set_join, "SHORT_LIST", 3)
    words = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(30):
        own = list(words)
        own[i] = f"x{i}"
        rows.append((i, " ".join(own[: 40 - i % 4])))
    rows += [(100 + i, rows[i % 7][1]) for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(frame, 3, 70) == brute(rows, 3, 70)


def test_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(odd, 3, 90) == brute(rows, 3, 90)
    assert jaccard_groups(none).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 12), min_size=1), min_size=1, max_size=14), st.integers(50, 100))
def test_overlaps_derived_from_similar_sets(sets, percent):
    arrays = [np.array(sorted(s), dtype=np.uint64) for s in sets]
    links = {i: set(o.tolist()) for i, o in overlap_links(arrays, percent)}
    for i, a in enumerate(sets):
        want = {j for j, b in enumerate(sets) if j != i and 100 * len(a & b) >= percent * len(a | b)}
        assert links[i] == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(0, 12), min_size=1), st.integers(0, 1)), min_size=1, max_size=9))
def test_links_across_sides_only(rows):
    arrays = [np.array(sorted(s), dtype=np.uint64) for s, _ in rows]
    sides = np.array([side for _, side in rows])
    for i, others in overlap_links(arrays, 60, sides):
        near = [100 * len(rows[i][0] & s) >= 60 * len(rows[i][0] | s) for s, _ in rows]
        assert others.tolist() == [j for j, (_, side) in enumerate(rows) if near[j] and side != sides[i]]


def test_counters_tell_rare_shingles_from_repeated_ones(spark):
    """Else prefixes take repeated shingles as the input grows, whose lists tie sets without relation together."""
    own = F.transform(F.sequence(F.lit(0), F.lit(19_999)), lambda i: F.concat("id", F.lit("x"), i))
    passage = " ".join(f"again{i}" for i in range(200))
    text = F.concat(F.array_join(own, " "), F.when(F.col("id") < 10, F.lit(" " + passage)).otherwise(F.lit("")))
    texts = spark.range(0, 160, 1, 8).select(text.cast("binary").alias("text"))
    counts = set_join.slot_counts(texts, 3)
    repeated, once = (
        counts[set_join._slot(shingle_set(next(word_hashes([t.encode()])), 3))]
        for t in (passage, " ".join(f"77x{i}" for i in range(20_000)))
    )
    assert repeated.min() > np.quantile(once, 0.999)


def test_shingles_of_a_run_of_texts():
    texts = [b"", b"one", b"a B c", b" \n", b"x" * 300_000 + b" tail end of it", b"a b C D e", b"ab " * 70_000, b"A b"]
    for k in (1, 3, 5):
        alone = [shingle_set(next(word_hashes([text])), k) for text in texts]
        for runs, words, want in zip(shingle_runs(texts, k), word_hashes(texts), alone, strict=True):
            assert distinct(runs).tolist() == shingle_set(words, k).tolist() == want.tolist()


def test_words_and_shingles():
    one, two, three = word_hashes([b"A b\tc\x0bD", b"", b"a B c d"])
    assert len(one) == 4 and len(two) == 0 and (one == three).all()
    assert len(shingle_set(one, 3)) == 2 and len(shingle_set(one[:2], 3)) == 1
    assert shingle_set(one[:3], 3)[0] in shingle_set(one, 3)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 100), (7, 7)]
    edges = spark.createDataFrame(chain, "a long, b long")
    got = {r.node: r.root for r in connected_components(edges, workspace(spark)).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 103: 100}
