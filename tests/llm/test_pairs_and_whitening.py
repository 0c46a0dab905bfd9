"""Hard negatives, whitening and min-max groups against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from repovitals.llm import minmax_hash, multi_index
from repovitals.llm.minmax_hash import band_keys, estimate, linked, minmax_groups, rows_of, signatures
from repovitals.llm.multi_index import Index, fit_codes, mine_hard_negatives
from repovitals.llm.whitening import solved, triangular_factor, whiten

from .conftest import DATA
from .test_set_join import brute as all_pairs

KEY = lambda row: tuple((v is not None, v) for v in row)


def groups(frame, k, percent):
    return sorted(map(tuple, minmax_groups(frame, k, percent).collect()), key=KEY)


def plain_groups(rows, k, percent):
    return sorted(((i, n, c, i == c) for i, n, c, _ in all_pairs(rows, k, percent)), key=KEY)


@pytest.mark.parametrize(("k", "percent"), [(4, 80), (2, 60)])
def test_groups_equal_all_pairs(spark, k, percent):
    frame = spark.read.parquet(f"{DATA}/documents.parquet")
    assert groups(frame, k, percent) == plain_groups([tuple(r) for r in frame.select("doc_id", "text").collect()], k, percent)


def related_texts():
    """Families of texts from two bases, with from none to all of their words changed, and chains of links."""
    random = np.random.default_rng(8)
    rows = []
    for base in range(3):
        words = [f"w{base}x{i}" for i in range(90)]
        for i in range(60):
            some = list(words)
            for at in random.choice(90, random.integers(0, 14), replace=False):
                some[at] = f"n{random.integers(0, 40)}"
            rows.append((len(rows), " ".join(some[: random.integers(70, 91)])))
    chain = [f"c{i}" for i in range(60)]
    rows.extend((len(rows) + i, " ".join(chain[i : i + 50])) for i in range(10))
    return rows


@pytest.mark.parametrize("block", [400_000, 500])
def test_large_families_are_cut(spark, texts, monkeypatch, block):
    monkeypatch.setattr(minmax_hash, "BLOCK_SHINGLES", block)
    rows = related_texts()
    assert groups(texts(rows), 2, 80) == plain_groups(rows, 2, 80)


def test_components_of_one_bucket_are_compared(spark, texts):
    """The hub links with neither of two sets that link with each other."""
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(base[: 90 - i] + [f"v{i}x{j}" for j in range(10)] + [f"u{j}" for j in range(i)])) for i in range(12)]
    rows += [(20, " ".join(base[20:])), (21, " ".join(base[19:])), (22, " ".join(base[:81])), (23, " ".join(base[:80]))]
    assert groups(texts(rows), 1, 80) == plain_groups(rows, 1, 80)


def test_groups_of_odd_rows(odd, none, texts):
    assert groups(none, 4, 80) == []
    got = groups(odd, 4, 80)
    assert len(got) == odd.count()
    of = {}
    for row in got:
        of.setdefault(row[0], []).append(row[1:])
    assert of[1] == [(0, 1, True)] and of[2] == [(0, 2, True)] and of[5] == [(0, 5, True)]
    assert of[3][0][1:] == (3, True) and of[4][0][1:] == (3, False) and of[6] == [(1, 6, True)] * 2
    assert of[8] == [(4, 8, True)] and of[9] == [(4, 8, False)] and of[None] == [(2, None, True)]
    twice = texts([(5, "a b c d e f"), (5, "g h i j k l"), (2, "g h i j k l"), (None, "g h i j k l"), (None, "x y z")])
    assert groups(twice, 4, 80) == sorted(
        [(5, 3, 5, True), (5, 3, 2, False), (2, 3, 2, True), (None, 3, 2, False), (None, 1, None, True)], key=KEY
    )


def test_signatures_estimate_similarity():
    random = np.random.default_rng(2)
    pool = np.unique(random.integers(0, 2**63, 4_000, dtype=np.uint64))
    errors = []
    for both in (500, 1_000, 1_500):
        a, b = pool[: both + 300], np.concatenate((pool[:both], pool[2_000:2_300]))
        one, two = signatures([np.sort(a), np.sort(b)])
        errors.append(estimate(one, two) - both / (both + 600))
    assert np.abs(errors).max() < 0.15 and abs(np.mean(errors)) < 0.08
    assert (signatures([pool[:1], pool[:1]])[0] == signatures([pool[:1]])[0]).all()
    assert rows_of(80) == 4 and rows_of(95) == 8 and rows_of(50) == 2
    assert band_keys(signatures([pool]), 4).shape == (1, 32)
    assert linked(pool[:8], pool[:10], 80) and not linked(pool[:7], pool[:10], 80) and not linked(pool[:0], pool[:0], 80)


def vectors(n, size, seed, spread=0.125):
    return (np.random.default_rng(seed).standard_normal((n, size)) * spread).astype(np.float32)


def frame_of(spark, matrix, labels=None):
    labels = [i % 10 for i in range(len(matrix))] if labels is None else labels
    rows = [(i, v.tolist(), label) for i, (v, label) in enumerate(zip(matrix, labels, strict=True))]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def plain_negatives(rows, anchors, positives=5, negatives=10, low=30, high=90):
    """rows: (vec_id, whole entries, label); anchors: ids."""
    out = []
    for own, vector, label in rows:
        if own not in anchors:
            continue
        scored = sorted((-int(np.dot(vector.astype(object), v.astype(object))), i, of == label) for i, v, of in rows if i != own)
        for p, positive, _ in [s for s in scored if s[2]][:positives]:
            inside = [s for s in scored if not s[2] and low * -p <= 100 * -s[0] <= high * -p][:negatives]
            out.extend((own, positive, rank, i, -p, -s) for rank, (s, i, _) in enumerate(inside, 1))
    return sorted(out)


def whole(matrix):
    return np.floor(256 * matrix.astype(np.float64)).astype(np.int64)


@pytest.mark.parametrize(("wave", "block", "queries"), [(8_192, 8_192, 4_096), (40, 30, 2)])
def test_negatives_equal_all_pairs(spark, monkeypatch, wave, block, queries):
    for name, value in (("FIRST_WAVE", wave), ("BLOCK", block), ("QUERIES", queries), ("CELL", 8), ("FIT_VECTORS", 100)):
        monkeypatch.setattr(multi_index, name, value)
    matrix = vectors(300, 6, 4)
    matrix[100:200] = matrix[7]  # a third of all rows in one cell, all tied
    matrix[20] = 0
    got = mine_hard_negatives(frame_of(spark, matrix), F.col("vec_id") % 10 == 0)
    want = plain_negatives([(i, v, i % 10) for i, v in enumerate(whole(matrix))], set(range(0, 300, 10)))
    assert sorted(map(tuple, got.collect())) == want and want


def test_clusters_are_found_without_all_cells(spark, monkeypatch):
    """In well separated clusters the bounds end the search early, and what is found is exact."""
    monkeypatch.setattr(multi_index, "FIRST_WAVE", 60)
    centres = vectors(12, 8, 5, 4.0)
    matrix = np.concatenate([c + vectors(50, 8, i, 0.02) for i, c in enumerate(centres)])
    labels = [i // 50 // 2 for i in range(600)]
    asked = []
    visit = multi_index._visit
    monkeypatch.setattr(multi_index, "_visit", lambda index, budget: asked.append(budget) or visit(index, budget))
    got = mine_hard_negatives(frame_of(spark, matrix, labels), F.col("vec_id") % 50 == 0, negatives=3, high=100)
    rows = [(i, v, labels[i]) for i, v in enumerate(whole(matrix))]
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows, set(range(0, 600, 50)), negatives=3, high=100)
    assert asked[0] == 60


def test_cells_come_by_falling_bound():
    rows = vectors(400, 8, 6).astype(np.float64)
    index = Index(fit_codes(rows[:, :4], 9), fit_codes(rows[:, 4:], 9))
    own, away = index.assign(rows)
    cell = own[0] * len(index.codes[1]) + own[1]
    radii = [{int(c): float(away[h][own[h] == c].max()) for c in np.unique(own[h])} for h in (0, 1)]
    index.place(radii, dict(zip(*map(np.ndarray.tolist, np.unique(cell, return_counts=True)), strict=True)))
    for query in rows[:20]:
        found = list(index.cells(query))
        bounds = [b for b, _ in found]
        assert bounds == sorted(bounds, reverse=True) and sorted(c for _, c in found) == np.unique(cell).tolist()
        scores = rows @ query
        assert all(scores[cell == c].max() <= b + 1e-9 for b, c in found)


def test_negatives_of_odd_rows(spark):
    same = [1.0, 0.5]
    rows = [
        (0, same, 1), (1, same, 1), (2, same, 2), (2, same, 2), (3, [0.5, 0.25], 2), (4, None, 1), (5, [1.0, None], 1),
        (6, [float("nan"), 1.0], 1), (7, [float("inf"), 1.0], 2), (8, same, None), (None, same, 1), (9, [1.0], 1), (10, [], 1),
        (11, [0.0, 0.0], 2), (12, [3e38, 1.0], 2), (100, [-1.0, 0.0], 3), (200, same, 1), (200, same, 1),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("score", F.lit("own"))
    got = sorted(map(tuple, mine_hard_negatives(frame, F.col("vec_id") % 100 == 0, low=0, high=100).collect()))
    big, half = 256 * 256 + 128 * 128, 128 * 256 + 64 * 128
    lists = {0: (1, 200, 200), 200: (0, 1)}
    want = []
    for anchor, found in lists.items():
        for positive in found:
            for rank, (i, score) in enumerate(((2, big), (2, big), (3, half), (11, 0)), 1):
                want.append((anchor, positive, rank, i, big, score))
    assert got == sorted(want)
    assert mine_hard_negatives(frame.limit(0), F.col("vec_id") % 100 == 0).collect() == []
    assert mine_hard_negatives(frame.where("vec_id = 3"), F.col("vec_id") % 100 == 0).collect() == []


def plain_whitening(matrix, kept):
    x = np.floor(64 * matrix.astype(np.float64)).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    away = x - total / n
    values, axes = np.linalg.eigh(away.T @ away / n)
    order = np.argsort(-values)[:kept]
    axes = axes[:, order]
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(len(order))])
    return ((n * x - total) ** 2).sum(axis=1), away @ axes / np.sqrt(values[order]), values[order] / values.sum()


def whitened(frame, components=32):
    rows = whiten(frame, components).collect()
    ids, parts = sorted({r.vec_id for r in rows}), max(r.component for r in rows)
    out = np.full((len(ids), parts), np.nan)
    for r in rows:
        out[ids.index(r.vec_id), r.component - 1] = r.whitened
    return rows, out


@pytest.mark.parametrize("scale", [1.0, 1e-3])
def test_whitening_equals_eigenvectors(spark, scale):
    # 1e-3: some of the columns vary by ten thousand times as much as others.
    spread = np.geomspace(1, scale, 12)
    matrix = (np.random.default_rng(9).standard_normal((500, 12)) @ np.linalg.qr(vectors(12, 12, 1))[0] * spread * 30).astype(np.float32)
    rows, got = whitened(frame_of(spark, matrix), 8)
    deviation, want, explained = plain_whitening(matrix, 8)
    assert np.abs(got - want).max() < 1e-7 and not np.isnan(got).any()
    assert {r.vec_id: r.deviation for r in rows} == dict(enumerate(deviation.tolist()))
    assert {r.n for r in rows} == {500} and max(r.identity_error for r in rows) < 1e-9
    assert all(abs(r.explained / explained[r.component - 1] - 1) < 1e-9 for r in rows)


def test_whitening_of_the_given_table(spark):
    frame = spark.read.parquet(f"{DATA}/embeddings.parquet")
    matrix = np.array([r.embedding for r in frame.orderBy("vec_id").collect()], dtype=np.float32)
    rows, got = whitened(frame)
    deviation, want, _ = plain_whitening(matrix, 32)
    assert np.abs(got - want).max() < 1e-6 and len(rows) == 32 * len(matrix)
    assert {r.vec_id: r.deviation for r in rows} == dict(enumerate(deviation.tolist()))
    assert rows[0].identity_error < 1e-9


def test_whitening_of_dependent_columns(spark):
    base = vectors(100, 3, 3, 1.0)
    matrix = np.round(np.hstack((base, base[:, :1] + base[:, 1:2], np.zeros((100, 2)))) * 64).astype(np.float32) / 64
    matrix[:, 3] = matrix[:, 0] + matrix[:, 1]
    rows, got = whitened(frame_of(spark, matrix))
    assert got.shape == (100, 3) and rows[0].identity_error < 1e-8
    assert np.abs(got - plain_whitening(matrix, 3)[1]).max() < 1e-7


def test_whitening_of_odd_rows(spark):
    good = [[1.0, 2.0], [2.0, 1.0], [0.5, 0.25], [0.5, 0.25]]
    rows = [*((i, v) for i, v in enumerate(good)), (0, good[0]), (None, good[1]), (5, None), (6, [1.0, None]), (7, [float("nan"), 0.0]),
            (8, [float("-inf"), 0.0]), (9, [1.0]), (10, []), (11, [3e38, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("n", F.lit("own"))
    out = whiten(frame).collect()
    assert sorted((r.vec_id, r.component) for r in out if r.vec_id is not None) == sorted((i, c) for i in (0, 0, 1, 2, 3) for c in (1, 2))
    assert sum(r.vec_id is None for r in out) == 2 and {r.n for r in out} == {6}
    assert whiten(frame.limit(0)).collect() == []
    assert whiten(frame.where("vec_id in (2, 3)")).collect() == []  # without variance
    far = spark.createDataFrame([(1, [1e12]), (2, [-1e12])], "vec_id long, embedding array<double>")
    assert [(r.vec_id, r.deviation, round(abs(r.whitened), 12)) for r in whiten(far).orderBy("vec_id").collect()] == [(1, None, 1.0), (2, None, 1.0)]


def test_factors_of_ill_conditioned_rows():
    random = np.random.default_rng(4)
    rows = random.standard_normal((400, 6)) * np.geomspace(1, 1e-9, 6)

    def gram_of(factors):
        now = rows
        for factor in factors:
            now = solved(now, factor)
        return now.T @ now

    factor, _ = triangular_factor(gram_of, 400, 6)
    assert np.allclose(np.linalg.svd(factor)[1], np.linalg.svd(rows)[1], rtol=1e-6)
    assert np.abs(np.tril(factor, -1)).max() < 1e-12
