"""Hard negatives by an inverted multi-index.

Vectors are cut into two halves, each with a codebook of its own; a pair of codes is a cell, and cells
are the lists of the index. A query's inner product with any vector of a cell is at most the sum of two
half scores: that with the half's codeword, plus the query half's length times the code's radius (the
greatest distance of a vector from its codeword, over all vectors). A heap gives the cells of a query
in order of that sum without making all sums: the multi-sequence algorithm.

Queries go through their cells in waves, of four times as many vectors each. After a wave a query is
done when what it looks for is certain: as many rows found as wanted, the last of them above the bound
of the next cell, or that bound below the window looked in. The result is exact, whatever the bounds.

Cells are packed into blocks that a task can hold, and a cell of very many vectors is dealt over several
blocks; the queries that ask for a block are dealt over several tasks likewise.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .batches import release, sliced
from .storage import stored, workspace

#: An entry x becomes floor(SCALE * x).
SCALE = 256
#: Vectors that the codebooks are fitted to, at most; all are indexed.
FIT_VECTORS = 8_192
#: Codes of a half, at most, and the vectors of a cell that the number of codes aims at.
MOST_CODES = 512
CELL = 64
#: Vectors of a block, and queries that meet a block in one task.
BLOCK = 8_192
QUERIES = 4_096
#: Vectors that a query meets in its first wave, and the growth of the waves.
FIRST_WAVE = 8_192
GROWTH = 4
_ROUNDS = 12
_SEED = 20_240_611
_SLACK = 1e-9


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("embedding")
        entries = np.asarray(column.flatten(), dtype=np.float64)
        whole = np.floor(SCALE * entries).astype(np.int32).reshape(len(column), -1)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("label"), pa.array([row.tobytes() for row in whole], pa.binary())],
            names=["id", "label", "vector"],
        )


def _whole(vectors) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), dtype=np.int32).reshape(len(vectors), -1) if len(vectors) else np.empty((0, 1), np.int32)


def _nearest(rows: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return ((codes**2).sum(axis=1) - 2 * rows @ codes.T).argmin(axis=1)


def fit_codes(rows: np.ndarray, n: int) -> np.ndarray:
    """At most n codewords for the rows: k-means from a seeded choice of different rows."""
    different = np.unique(rows, axis=0)
    random = np.random.default_rng(_SEED)
    codes = different[random.permutation(len(different))[:n]]
    for _ in range(_ROUNDS):
        own = _nearest(rows, codes)
        sums = np.zeros_like(codes)
        np.add.at(sums, own, rows)
        members = np.bincount(own, minlength=len(codes))
        codes = np.where(members[:, None] > 0, sums / np.maximum(members, 1)[:, None], codes)
    return codes


class Index:
    """Codebooks, radii and cells: what the search has to know of the index. Its size is bounded by MOST_CODES."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.codes = (first, second)
        self.cut = first.shape[1]
        self.radii = (np.full(len(first), -np.inf), np.full(len(second), -np.inf))

    def halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        vectors = vectors.astype(np.float64)
        return vectors[:, : self.cut], vectors[:, self.cut :]

    def assign(self, vectors: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Codes of both halves, and the halves' distances from their codewords."""
        own, away = [], []
        for half, codes in zip(self.halves(vectors), self.codes, strict=True):
            own.append(_nearest(half, codes))
            away.append(np.sqrt(((half - codes[own[-1]]) ** 2).sum(axis=1)))
        return own, away

    def place(self, radii: list[dict[int, float]], counts: dict[int, int]) -> None:
        """Take the radii and the vectors of each cell, and deal the cells over blocks."""
        for own, found in zip(self.radii, radii, strict=True):
            for code, radius in found.items():
                own[code] = radius
        n = len(self.codes[0]) * len(self.codes[1])
        self.counts = np.zeros(n, dtype=np.int64)
        for cell, count in counts.items():
            self.counts[cell] = count
        self.parts = np.maximum(1, -(-self.counts // BLOCK)).astype(np.int32)
        self.block = np.zeros(n, dtype=np.int32)
        at, filled = 0, 0
        for cell in np.flatnonzero(self.counts):
            count = int(self.counts[cell])
            if filled and filled + count > BLOCK:
                at, filled = at + 1, 0
            self.block[cell] = at
            if self.parts[cell] > 1:
                at, filled = at + int(self.parts[cell]), 0
            else:
                filled += count

    def cells(self, query: np.ndarray) -> Iterator[tuple[float, int]]:
        """(bound, cell) of the cells that hold vectors, by falling bound: sums of two sorted lists, from a heap."""
        lists = []
        for half, codes, radii in zip(self.halves(query[None]), self.codes, self.radii, strict=True):
            bounds = codes @ half[0] + np.sqrt((half[0] ** 2).sum()) * radii
            order = np.argsort(-bounds, kind="stable")[: np.isfinite(radii).sum()]
            lists.append((bounds[order], order))
        (high, first), (low, second) = lists
        if not len(first):
            return
        waiting = [(-(high[0] + low[0]), 0, 0)]
        # A place is reached from the one before it in its row, and first places from the row above.
        while waiting:
            bound, i, j = heappop(waiting)
            if j == 0 and i + 1 < len(first):
                heappush(waiting, (-(high[i + 1] + low[0]), i + 1, 0))
            if j + 1 < len(second):
                heappush(waiting, (-(high[i] + low[j + 1]), i, j + 1))
            cell = int(first[i]) * len(self.codes[1]) + int(second[j])
            if self.counts[cell]:
                yield -bound, cell


def _assign_rows(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, away = index.value.assign(_whole(batch.column("vector").to_pylist()))
            columns = [pa.array(own[0], pa.int32()), pa.array(own[1], pa.int32()), *map(pa.array, away)]
            names = [*batch.schema.names, "code_1", "code_2", "away_1", "away_2"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=names)

    return run


def _visit(index, budget: int):
    """Per query: rows (key, block, cells) of the next cells, and one row (key, seen, bound) for where it stopped.

    seen cells are passed over; the visit ends below `floor`, or with as many vectors as the budget. bound is
    that of the next cell, NULL if there is none.
    """
    schema = pa.schema(
        [("key", pa.int64()), ("seen", pa.int32()), ("bound", pa.float64()), ("block", pa.int32()), ("cells", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = index.value
        for batch in batches:
            rows: list[dict] = []
            for key, vector, seen, floor in zip(
                *(batch.column(c).to_pylist() for c in ("key", "vector", "seen", "floor")), strict=True
            ):
                query = np.frombuffer(vector, dtype=np.int32)
                slack = _SLACK * (1 + float((query.astype(np.float64) ** 2).sum()))
                met, passed, bound = 0, 0, None
                asked: dict[int, list[int]] = {}
                for bound, cell in at.cells(query):
                    if passed < seen:
                        passed += 1
                        continue
                    bound += slack + _SLACK * abs(bound)
                    if met >= budget or (floor is not None and bound < floor):
                        break
                    passed, met = passed + 1, met + int(at.counts[cell])
                    for part in range(int(at.parts[cell])):
                        asked.setdefault(int(at.block[cell]) + part, []).append(cell)
                else:
                    bound = None
                rows.append({"key": key, "seen": passed, "bound": bound})
                rows.extend(
                    {"key": key, "block": block, "cells": np.array(cells, dtype=np.int32).tobytes()}
                    for block, cells in asked.items()
                )
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """All inner products, as whole numbers."""
    most = [int(np.abs(m.astype(np.int64)).max(initial=0)) for m in (queries, vectors)]
    if queries.shape[1] * most[0] * most[1] < 2**53:  # exact in doubles too
        return (queries.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    return queries.astype(np.int64) @ vectors.astype(np.int64).T


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: higher scores first, ties by smaller id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


def _meet(k: int, low: int | None, high: int):
    """Of a block, for each query: the best k rows of its label (low None), or of other labels by window.

    A query's windows are those of its positives: low * positive <= 100 * score <= high * positive.
    """

    def run(key, rows, queries):
        import pandas as pd

        vectors, ids = _whole(rows["vector"]), rows["id"].to_numpy()
        labels = rows["label"].to_numpy()
        cells, cell_of = np.unique(rows["cell"].to_numpy(), return_inverse=True)
        found = []
        for begin in range(0, len(queries), 256):
            some = queries.iloc[begin : begin + 256]
            scores = _products(_whole(some["vector"]), vectors) if len(rows) else np.empty((len(some), 0), np.int64)
            for i, (name, own, label, wanted, positives) in enumerate(
                zip(some["key"], some["id"], some["label"], some["cells"], some["positives"], strict=True)
            ):
                right = (labels == label) if low is None else (labels != label)
                asked = np.isin(cells, np.frombuffer(wanted, dtype=np.int32))[cell_of]
                met = np.flatnonzero(asked & right & (ids != own))
                own_scores, own_ids = scores[i, met], ids[met]
                for place, positive in enumerate((0,) if low is None else positives):
                    if low is not None:
                        inside = (100 * own_scores >= low * positive) & (100 * own_scores <= high * positive)
                        at = np.flatnonzero(inside)
                    else:
                        at = np.arange(len(met))
                    best = at[_best(own_scores[at], own_ids[at], k)]
                    found.extend((name, place, int(own_ids[j]), int(own_scores[j])) for j in best)
        release()
        return pd.DataFrame(found, columns=["key", "place", "id", "score"]).astype(
            {"key": "int64", "place": "int32", "id": "int64", "score": "int64"}
        )

    return run


def _search(index, rows: DataFrame, queries: DataFrame, k: int, low: int | None, high: int, folder: str) -> DataFrame:
    """Rows (key, place, rank, id, score): the best k of each query, or of each of its windows, exactly.

    rows: id, label, vector, cell, block. queries: key, id, label, vector, positives.
    """
    of_query = Window.partitionBy("key", "place").orderBy(F.desc("score"), "id")
    # Scores below which a query need not look: the last of each list that is full, else the end of its window.
    if low is None:
        ends = F.array(F.try_element_at("full", F.lit(0)))
        floor = F.when(F.exists(ends, lambda x: x.isNotNull()), F.array_min(ends))
    else:
        end = lambda p: F.when(p < 0, float("inf")).otherwise(p * F.lit(low / 100))
        floor = F.array_min(F.transform("positives", lambda p, i: F.coalesce(F.try_element_at("full", i), end(p))))
    nothing = queries.withColumn("seen", F.lit(0)).withColumn("full", F.lit(None).cast("map<int,double>"))
    waiting = stored(nothing.withColumn("floor", floor).drop("full"), f"{folder}/wave=0")
    found = None
    turn, budget = 0, FIRST_WAVE
    while True:
        turn += 1
        at = f"{folder}/wave={turn}"
        asked = stored(
            waiting.select("key", "vector", "seen", "floor").mapInArrow(
                sliced(_visit(index, budget)), "key long, seen int, bound double, block int, cells binary"
            ),
            f"{at}/asked",
        )
        wanted = asked.where("block is not null").select("key", "block", "cells")
        # A block that very many queries ask for meets them in several tasks.
        parts = stored(
            wanted.groupBy("block").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("parts")), f"{at}/parts"
        )
        part = F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")
        seekers = (
            wanted.join(queries, "key").join(parts, "block").withColumn("part", part)
            .select("block", "part", "key", "id", "label", "vector", "cells", "positives")
        )
        lists = (
            rows.join(parts.select("block", "parts"), "block")
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select("block", "part", "id", "label", "vector", "cell")
        )
        new = (
            lists.groupBy("block", "part")
            .cogroup(seekers.groupBy("block", "part"))
            .applyInPandas(_meet(k, low, high), "key long, place int, id long, score long")
        )
        new = new if found is None else new.unionByName(found.select("key", "place", "id", "score"))
        ranked = new.withColumn("rank", F.row_number().over(of_query)).where(F.col("rank") <= k)
        found = stored(ranked, f"{at}/found")
        lists_of = found.groupBy("key", "place").agg(F.count("*").alias("n"), F.min("score").alias("last"))
        full = F.map_from_entries(F.collect_list(F.struct("place", F.col("last").cast("double"))))
        full = lists_of.where(F.col("n") >= k).groupBy("key").agg(full.alias("full"))
        state = asked.where("block is null").select("key", "seen", "bound")
        waiting = stored(
            waiting.drop("seen", "floor").join(state, "key").join(full, "key", "left").withColumn("floor", floor)
            .where(F.col("bound").isNotNull() & (F.col("floor").isNull() | (F.col("bound") >= F.col("floor"))))
            .select("key", "id", "label", "vector", "positives", "seen", "floor"),
            f"{at}/waiting",
        )
        if waiting.isEmpty():
            return found
        budget *= GROWTH


def mine_hard_negatives(
    embeddings: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    embeddings: vec_id, embedding, label. Entries x become floor(256 * x); scores are inner products of
    these whole numbers. An anchor's positives are the `positives` best other rows of its label; for each of
    them the best `negatives` rows of other labels with low * positive_score <= 100 * negative_score <=
    high * positive_score. Higher scores come first, ties by smaller vec_id; fewer rows where there are
    fewer. is_anchor: an expression on vec_id; label: one on vec_id and label, in place of label.

    Rows without vec_id, with a NULL label (as it comes), a NULL vector, or a NULL or not finite entry take
    no part, nor do vectors of another length than most (of equally frequent lengths the least counts),
    or none, and those with entries so large that scores would not fit 64 bits. Rows of equal vec_id are rows
    of their own, but are not among each other's lists; anchors that agree in all columns answer once.
    Zero vectors take part; a positive of a negative score has no negatives. An empty table, or one without
    anchors, gives no rows. Columns other than the three are not read.
    """
    spark = embeddings.sparkSession
    folder = workspace(spark)
    schema = (
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    )
    rows = embeddings.where("label is not null and vec_id is not null and embedding is not null").select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding")
    )
    rows = rows.where(F.size("embedding") > 0).where(
        F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    lengths = rows.groupBy(F.size("embedding").alias("length")).count().orderBy(F.desc("count"), "length").first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    d = int(lengths["length"])
    limit = min(2.0**31, (2.0**63 / (128 * d)) ** 0.5) - 1
    usable = rows.where(F.size("embedding") == d).where(F.forall("embedding", lambda x: F.abs(F.lit(SCALE) * x) < limit))
    label = F.col("label") if label is None else label
    packed = stored(
        usable.select(F.col("vec_id").alias("id"), label.cast("long").alias("label"), "embedding")
        .where("label is not null")
        .mapInArrow(sliced(_packed), "id long, label long, vector binary"),
        f"{folder}/packed",
    )
    sample = packed.orderBy(F.xxhash64("vector", "id"), "id").limit(FIT_VECTORS).select("vector").collect()
    if not sample:
        return spark.createDataFrame([], schema)
    n = packed.count()
    fit = _whole([r.vector for r in sample]).astype(np.float64)
    cut = (d + 1) // 2
    codes = int(min(MOST_CODES, max(1, len(sample) // 4), max(1, round((n / CELL) ** 0.5))))
    made = Index(fit_codes(fit[:, :cut], codes), fit_codes(fit[:, cut:], codes))
    assigned = stored(
        packed.mapInArrow(
            sliced(_assign_rows(spark.sparkContext.broadcast(made))),
            "id long, label long, vector binary, code_1 int, code_2 int, away_1 double, away_2 double",
        ).withColumn("cell", F.col("code_1") * len(made.codes[1]) + F.col("code_2")),
        f"{folder}/assigned",
    )
    radii = [dict(assigned.groupBy(f"code_{i}").agg(F.max(f"away_{i}")).collect()) for i in (1, 2)]
    made.place(radii, dict(assigned.groupBy("cell").count().collect()))
    places = spark.createDataFrame(
        [(int(c), int(made.block[c]), int(made.parts[c])) for c in np.flatnonzero(made.counts)],
        "cell int, first int, over int",
    )
    block = F.col("first") + F.pmod(F.xxhash64("id", "vector"), F.col("over")).cast("int")
    lists = stored(
        assigned.join(F.broadcast(places), "cell").select("id", "label", "vector", "cell", block.alias("block")),
        f"{folder}/lists",
    )
    index = spark.sparkContext.broadcast(made)
    anchors = stored(
        packed.withColumn("vec_id", F.col("id")).where(is_anchor).drop("vec_id")
        .distinct()
        .withColumn("key", F.xxhash64("id", "label", "vector"))
        .withColumn("positives", F.array().cast("array<bigint>")),
        f"{folder}/anchors",
    )
    near = _search(index, lists, anchors, positives, None, 0, f"{folder}/positives")
    own = near.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("own"))
    paired = stored(
        anchors.drop("positives").join(own, "key").withColumn("positives", F.col("own.score")), f"{folder}/paired"
    )
    found = _search(index, lists, paired.drop("own"), negatives, low, high, f"{folder}/negatives")
    positive = paired.select("key", F.col("id").alias("anchor_id"), F.posexplode("own").alias("place", "positive"))
    return found.join(positive, ["key", "place"]).select(
        "anchor_id",
        F.col("positive.id").alias("positive_id"),
        "rank",
        F.col("id").alias("negative_id"),
        F.col("positive.score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
