import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from repovitals.llm.cuckoo import CuckooFilter
from repovitals.llm.line_dedup import LineIndex, dedup_lines, line_key
from repovitals.llm.storage import workspace

WHITE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def brute(rows):
    """rows (doc_id, text), ids that are there and differ."""
    first = {}
    for doc_id, text in sorted(rows):
        for line in (text or "").split("\n"):
            first.setdefault(key(line), doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if len(key(line)) < 10 or first[key(line)] == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def got(frame):
    return sorted(map(tuple, frame.select("doc_id", "n_lines", "n_dropped", "text").collect()))


LINES = ["a line of some length", " A LINE of some length\r", "short", "another long line", "ääääääääää", "äääääääää", ""]


def corpus():
    random = np.random.default_rng(3)
    return [(i, "\n".join(random.choice(LINES, random.integers(1, 6)))) for i in range(40)]


def test_equals_plain_rule(texts):
    rows = [*corpus(), (50, None), (51, "")]
    for batches in (1, 3):
        assert got(dedup_lines(texts(rows), batches)) == brute(rows)


def test_documents_come_and_go(spark, texts):
    rows = corpus()
    index = LineIndex(spark, workspace(spark), shards=3)
    index.add(texts(rows[10:25]))
    index.add(texts(rows[:15]))
    assert got(index.apply(texts(rows[:25]))) == brute(rows[:25])
    index.remove(texts(rows[:8]))
    assert got(index.apply(texts(rows[8:25]))) == brute(rows[8:25])
    index.add(texts(rows[25:]))
    index.add(texts(rows[:3]))
    now = rows[:3] + rows[8:]
    assert got(index.apply(texts(now))) == brute(now)
    index.remove(texts(now))
    assert index.counts().count() == 0 and index.postings().count() == 0
    index.add(texts(rows))
    assert got(index.apply(texts(rows))) == brute(rows)


def test_counts_are_exact(spark, texts):
    index = LineIndex(spark, workspace(spark), shards=2)
    index.add(texts([(5, "a long line here\na long line here"), (9, "A long line here"), (7, "something else")]))
    assert sorted((r.refs, r.keeper) for r in index.counts().collect()) == [(1, 7), (2, 5)]
    index.remove(texts([(5, "")]))
    assert sorted((r.refs, r.keeper) for r in index.counts().collect()) == [(1, 7), (1, 9)]


def test_odd_rows(odd, none):
    kept = {(r.doc_id, r.text): (r.n_lines, r.n_dropped) for r in dedup_lines(odd).collect()}
    assert kept[1, ""] == (1, 0) and kept[2, ""] == (1, 0) and kept[4, ""] == (1, 1)
    assert kept[None, "no number here at all"] == (1, 0)
    assert kept[9, ""] == (1, 1)  # as in document 8, but for case
    assert dedup_lines(odd).columns == [c for c in odd.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    assert dedup_lines(none).collect() == []


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=400, unique=True), st.integers(0, 400))
def test_filter_misses_nothing(values, cut):
    hashes = np.array(values, dtype=np.uint64)
    filters = CuckooFilter(16)
    filters.insert(hashes)
    filters = CuckooFilter.from_bytes(filters.to_bytes())
    assert filters.contains(hashes).all()
    filters.remove(hashes[:cut])
    assert filters.contains(hashes[cut:]).all()
    filters.remove(hashes[cut:])
    assert not filters.contains(hashes).any()


def test_filter_rarely_errs():
    random = np.random.default_rng(1)
    hashes = random.integers(0, 2**63, 60_000, dtype=np.uint64) * np.uint64(2)
    filters = CuckooFilter(20_000)
    filters.insert(hashes[:50_000])
    assert filters.contains(hashes[:50_000]).all()
    assert filters.contains(hashes[50_000:]).mean() < 0.002


def test_keys_of_equal_mark_come_and_go(spark, texts):
    """Two lines share a mark and its buckets in the smallest filter: when one goes, the other is still known."""
    met: dict = {}
    for i in range(50_000):
        line = f"line number {i} of many"
        own = int.from_bytes(line_key(line.encode())[:8], "little")
        first = met.setdefault((own >> 48, own & 15), line)
        if first != line:
            break
    index = LineIndex(spark, workspace(spark), shards=1)
    rows = [(1, first), (2, line), (3, line), (4, line)]
    index.add(texts(rows[:1]))
    index.add(texts(rows[1:3]))
    index.remove(texts(rows[:1]))
    index.add(texts(rows[3:]))
    assert [(r.refs, r.keeper) for r in index.counts().collect()] == [(3, 2)]


def test_an_index_is_found_again_in_its_folder(spark, texts, monkeypatch):
    rows, folder = corpus(), workspace(spark)
    LineIndex(spark, folder).add(texts(rows[:20]))
    again = LineIndex(spark, folder)
    assert again.version == 1 and again.shards == 4
    again.add(texts(rows[15:30]))
    assert got(LineIndex(spark, folder).apply(texts(rows[:30]))) == brute(rows[:30])
    third = LineIndex(spark, folder)
    third.remove(texts(rows[:9]))
    assert got(LineIndex(spark, folder).apply(texts(rows[9:30]))) == brute(rows[9:30])
    # A change that broke off before its filters were written does not count, and is overwritten.
    fails = LineIndex(spark, folder)
    monkeypatch.setattr(fails, "_filters", lambda: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        fails.add(texts(rows[30:]))
    last = LineIndex(spark, folder)
    assert last.version == 3
    last.add(texts(rows[30:]))
    assert got(LineIndex(spark, folder).apply(texts(rows[9:]))) == brute(rows[9:])
    with pytest.raises(ValueError):
        LineIndex(spark, folder, shards=7)


def test_shards_follow_the_keys(spark, texts, monkeypatch):
    monkeypatch.setattr("repovitals.llm.line_dedup.KEYS_PER_SHARD", 3)
    rows = [(i, "\n".join(f"line number {i} {j}" for j in range(5)) + "\nthe same long line") for i in range(20)]
    index = LineIndex(spark, workspace(spark))
    index.add(texts(rows))
    assert index.shards > 50 and got(index.apply(texts(rows))) == brute(rows)
    LineIndex(spark, workspace(spark)).remove(texts(rows))  # nothing there yet


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_filter_keeps_what_is_left(data):
    """Hashes with few different marks and buckets come and go; those that are left are always found."""
    some = st.lists(st.tuples(st.integers(1, 3), st.integers(0, 40)), max_size=120)
    held = []
    filters = CuckooFilter(16)
    for _ in range(3):
        come = [mark << 48 | low for mark, low in data.draw(some)]
        filters.insert(np.array(come, dtype=np.uint64))
        held += come
        gone = data.draw(st.integers(0, len(held)))
        filters.remove(np.array(held[:gone], dtype=np.uint64))
        held = held[gone:]
        assert filters.contains(np.array(held, dtype=np.uint64)).all()
    filters.remove(np.array(held, dtype=np.uint64))
    assert not len(filters.aside) and not any(table.any() for table in filters.tables)


def test_filter_removes_from_the_right_table():
    """Two hashes that share mark and bucket in the first, small table only."""
    old, new = np.array([3 << 48 | 1], dtype=np.uint64), np.array([3 << 48 | 1 | 1 << 10], dtype=np.uint64)
    filters = CuckooFilter(16)
    filters.insert(old)
    filters._grow(1 << 16)
    filters.insert(new)
    filters.remove(new)
    assert filters.contains(old).all()
