"""Nearest neighbours by inner product from a forest of hash prefixes.

In each tree every vector has a long string of hash bits, one per hyperplane. A query descends to the
vectors that share the longest prefix with its own string; all trees then ascend together, one bit at
a time, until enough candidates are met, up to the roots if need be. How many are enough is found by
searching a bounded number of sample queries exactly. Candidates are scored on the original vectors in double precision.

Trees are cut into cells by their first bits, so a cell's part of a sorted array fits in one task; a
large cell is split into blocks, to all of which its queries go. Equal vectors are one class.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import stored, workspace

TREES = 32
BITS = 32
#: Bounds of what the driver sees: vectors that place the hyperplanes, and queries that set the goal.
FIT_VECTORS = 4_096
GOAL_QUERIES = 128
#: Share of the true neighbours that the sample queries have to find.
GOAL = 0.94
#: Vectors of one block of a cell.
BLOCK = 8_192
#: Bits by which the cells of queries without enough candidates are widened at a time.
ASCENT = 2
_SEED = 20_240_601


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float32).reshape(len(column), -1)


class Planes:
    """Hash strings of vectors: the signs of TREES * BITS projections, those of one tree as one number.

    To order by inner product, vectors get one more coordinate that makes all of one length, and are
    taken from their mean; queries get a zero there.
    """

    def __init__(self, sample: np.ndarray, longest: float):
        wide = np.random.default_rng(_SEED).standard_normal((sample.shape[1] + 1, TREES * BITS))
        self.longest = longest
        self.wide = wide.astype(np.float32)
        self.mean = np.zeros(sample.shape[1] + 1, dtype=np.float32)
        self.mean = self._lifted(sample).mean(axis=0)

    def _lifted(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0.0, self.longest**2 - (vectors.astype(np.float64) ** 2).sum(axis=1)))
        return np.hstack((vectors, rest[:, None].astype(np.float32))) - self.mean

    def _strings(self, lifted: np.ndarray) -> np.ndarray:
        bits = np.packbits((lifted @ self.wide > 0).reshape(-1, TREES, BITS), axis=2)
        return bits.view(">u4").reshape(-1, TREES).astype(np.int64)

    def of_points(self, vectors: np.ndarray) -> np.ndarray:
        return self._strings(self._lifted(vectors))

    def of_queries(self, vectors: np.ndarray) -> np.ndarray:
        return self._strings(np.hstack((vectors, np.zeros((len(vectors), 1), dtype=np.float32))))


def shared_prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many first bits two strings share."""
    return BITS - np.frexp((a ^ b).astype(np.float64))[1]


def _hash_rows(planes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("vector"))
            names = ("points", "queries")
            found = [planes.value.of_points(vectors), planes.value.of_queries(vectors)]
            ends = pa.array(np.arange(0, len(vectors) * TREES + 1, TREES, dtype=np.int32))
            strings = [pa.ListArray.from_arrays(ends, pa.array(f.reshape(-1))) for f in found]
            yield pa.RecordBatch.from_arrays([*batch.columns, *strings], names=[*batch.schema.names, *names])

    return run


def _exact_sample(goal: np.ndarray, strings: np.ndarray, k: int):
    """Of the sample queries the nearest of this part, and how many vectors share each prefix length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(goal), BITS + 1), dtype=np.int64)
        for batch in batches:
            vectors = _matrix(batch.column("vector")).astype(np.float64)
            ids = batch.column("class_id").to_numpy()
            own = np.array(batch.column("points").flatten()).reshape(-1, TREES)
            scores = goal @ vectors.T
            rows = []
            for i in range(len(goal)):
                shared = shared_prefix(strings[i], own)
                counts[i] += np.bincount(shared.reshape(-1), minlength=BITS + 1)
                top = np.lexsort((ids, -scores[i]))[: k + 1]
                rows.extend((i, int(ids[j]), float(scores[i, j]), int(shared[j].max())) for j in top)
            yield _sample_rows(rows)
        met = np.argwhere(counts)
        yield _sample_rows([(int(i), None, float(counts[i, level]), int(level)) for i, level in met])

    return run


def _sample_rows(rows) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
    types = (pa.int32(), pa.int64(), pa.float64(), pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["q", "class_id", "score", "level"]
    )


def _enough(classes: DataFrame, goal: np.ndarray, strings: np.ndarray, k: int) -> tuple[int, int]:
    """(candidates that reach the goal, shortest prefix that gives them) on the sample queries.

    A tree meets a class once, so TREES * (k + 1) candidates hold at least k + 1 different classes.
    """
    rows = classes.mapInArrow(_exact_sample(goal, strings, k), "q int, class_id long, score double, level int")
    rows = rows.cache()
    best = Window.partitionBy("q").orderBy(F.desc("score"), "class_id")
    nearest = (
        rows.where("class_id is not null").withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    ).collect()
    met = rows.where("class_id is null").groupBy("q", "level").agg(F.sum("score").alias("n")).collect()
    rows.unpersist()
    counts = np.zeros((len(goal), BITS + 1))
    for row in met:
        counts[row.q, row.level] = row.n
    at_least = counts[:, ::-1].cumsum(axis=1)[:, ::-1]
    true = [[row.level for row in nearest if row.q == i] for i in range(len(goal))]
    wanted = np.unique(at_least)
    low, high = 0, len(wanted) - 1
    while low < high:  # the more candidates, the higher the recall
        middle = (low + high) // 2
        levels = _levels(at_least, wanted[middle])
        recall = np.mean([np.mean(np.array(t) >= x) for t, x in zip(true, levels, strict=True)])
        low, high = (low, middle) if recall >= GOAL else (middle + 1, high)
    enough = max(int(wanted[low]), TREES * (k + 1))
    return enough, int(_levels(at_least, enough).min())


def _levels(at_least: np.ndarray, enough: float) -> np.ndarray:
    """The longest prefix length at which a query has enough candidates (0 if none has)."""
    return np.where(at_least >= enough, np.arange(at_least.shape[1]), 0).max(axis=1)


def _count_levels(depth: int, top: int):
    """For the queries of a block: how many of its points share each prefix length from depth to top."""

    def run(key, points, queries):
        import pandas as pd

        strings = np.sort(points["string"].to_numpy())
        own = queries["string"].to_numpy()
        out = []
        for level in range(depth, top + 1):
            width = BITS - level
            first = own >> width << width
            n = np.searchsorted(strings, first + (1 << width)) - np.searchsorted(strings, first)
            met = n > 0
            out.append(pd.DataFrame({"query": queries["class_id"].to_numpy()[met], "level": level, "n": n[met]}))
            if not met.any():
                break
        return pd.concat(out)

    return run


def _score_block(k: int):
    """For the queries of a block its k + 1 best points among those within the query's prefix."""

    def run(key, points, queries):
        import pandas as pd

        points = points.sort_values("string")
        strings = points["string"].to_numpy()
        ids = points["class_id"].to_numpy()
        vectors = _matrix(pa.array(points["vector"])).astype(np.float64) if len(points) else np.empty((0, 1))
        largest = float(np.abs(vectors).max(initial=0.0))
        found: list[tuple] = []
        for query, string, level, vector in zip(
            queries["class_id"], queries["string"], queries["level"], queries["vector"], strict=True
        ):
            width = BITS - level
            first = string >> width << width
            begin, end = np.searchsorted(strings, [first, first + (1 << width)])
            if begin < end:
                wanted = np.frombuffer(vector, dtype=np.float32).astype(np.float64)
                rough = vectors[begin:end] @ wanted
                keep = min(len(rough), k + 1)
                least = -np.partition(-rough, keep - 1)[keep - 1]
                # All that may be among the best in exact order: ties, and what rounding may have put behind them.
                margin = 1e-14 * len(wanted) * np.abs(wanted).max() * largest
                near = begin + np.flatnonzero(rough >= least - margin)
                # Summed row by row: the same number in whichever block the two vectors meet.
                scores = (vectors[near] * wanted).sum(axis=1)
                best = np.lexsort((ids[near], -scores))[: k + 1]
                found.extend(zip([query] * len(best), ids[near][best], scores[best], strict=True))
        return pd.DataFrame(found, columns=["query", "class_id", "score"]).astype(
            {"query": "int64", "class_id": "int64", "score": "float64"}
        )

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = [np.array(v, dtype=np.float32).tobytes() for v in batch.column("embedding").to_pylist()]
        rest = [batch.column(i) for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(vectors, pa.binary())], names=[*batch.schema.names[:-1], "vector"])


def _usable(embeddings: DataFrame) -> DataFrame:
    """Rows with a number and a finite vector other than zero, of the length most vectors have."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(
        finite & F.exists("embedding", lambda x: x != 0)
    )
    length = rows.groupBy(F.size("embedding").alias("length")).count().orderBy(F.desc("count"), "length")
    return rows.where(F.size("embedding") == length.select("length").limit(1).scalar())


def _ascend(
    spark: SparkSession, folder: str, pending: DataFrame, enough: int, shortest: int, k: int
) -> DataFrame:
    """Rows (query, class_id, score) of the classes (class_id) asked for, from the hashed classes in the folder.

    The first cells are cut just below the shortest prefix of the sample queries, where nearly all
    queries meet enough candidates. The others go on in larger and larger cells until they do too, or
    have met all points; only the cells that they are in are made.
    """
    # Read anew for each use, or Spark could not tell the columns of points and queries apart.
    hashed = spark.read.parquet(f"{folder}/hashed").schema

    def strings(kind: str, depth: int) -> DataFrame:
        rows = spark.read.schema(hashed).parquet(f"{folder}/hashed")
        rows = rows.select("class_id", "vector", F.posexplode(kind).alias("tree", "string"))
        return rows.withColumn("cell", F.shiftright("string", BITS - depth))

    block = ["tree", "cell", "block"]
    found = []
    depth, top = max(0, shortest - 1), BITS
    while True:
        at = f"{folder}/depth={depth}"
        wanted = strings("queries", depth).join(pending, "class_id", "left_semi")
        cells = strings("points", depth).join(wanted.select("tree", "cell").distinct(), ["tree", "cell"], "left_semi")
        sizes = cells.groupBy("tree", "cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        sizes = stored(sizes, f"{at}/cells")
        points = strings("points", depth).join(sizes, ["tree", "cell"]).withColumn(
            "block", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int")
        )
        sizes = spark.read.schema(sizes.schema).parquet(f"{at}/cells")
        queries = wanted.join(sizes, ["tree", "cell"]).withColumn(
            "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        )
        levels = (
            points.select(*block, "string").groupBy(*block)
            .cogroup(queries.select(*block, "class_id", "string").groupBy(*block))
            .applyInPandas(_count_levels(depth, top), "query long, level int, n long")
            .groupBy("query", "level")
            .agg(F.sum("n").alias("n"))
            .where(F.col("n") >= enough)
            .groupBy("query")
            .agg(F.max("level").alias("level"))
            .withColumnRenamed("query", "class_id")
        )
        if depth == 0:  # all points are met
            levels = pending.join(levels, "class_id", "left").withColumn("level", F.coalesce("level", F.lit(0)))
        levels = stored(levels, f"{at}/levels")
        # At level 0 every tree has all points: one of them is enough.
        ready = queries.join(levels, "class_id").where("level > 0 or tree = 0")
        scored = (
            points.select(*block, "class_id", "string", "vector").groupBy(*block)
            .cogroup(ready.select(*block, "class_id", "string", "level", "vector").groupBy(*block))
            .applyInPandas(_score_block(k), "query long, class_id long, score double")
        )
        found.append(stored(scored, f"{at}/scored"))
        if depth == 0:
            break
        pending = stored(pending.join(levels.select("class_id"), "class_id", "left_anti"), f"{at}/open")
        if pending.isEmpty():
            break
        depth, top = max(0, depth - ASCENT), depth - 1
    return reduce(DataFrame.unionByName, found).distinct()


def nearest_neighbours(embeddings: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): of each query its k nearest by inner product that were found.

    embeddings: vec_id, embedding. is_query: an expression on vec_id. All rows are candidates, but the
    query's own. Nearest first, equal scores by smaller vec_id; fewer rows only where there are fewer
    candidates. Vectors that are NULL or zero, hold NULL or a value that is not finite, or have another
    length than most, and rows without vec_id, take no part. Rows of equal vec_id are further vectors
    under that number. Every row is indexed; fitting uses at most FIT_VECTORS vectors, and GOAL_QUERIES
    queries searched exactly. Other columns are not read.
    """
    spark = embeddings.sparkSession
    folder = workspace(spark)
    # -0.0 and 0.0 are one value, so that equal vectors are one class.
    rows = _usable(embeddings).withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0).cast("float")))
    first = Window.partitionBy("embedding").orderBy("vec_id")
    # Of equal vectors only the k + 1 of least number can be among anyone's nearest.
    members = rows.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1)
    classes = stored(
        members.groupBy("embedding")
        .agg(F.min("vec_id").alias("class_id"), F.array_sort(F.collect_list("vec_id")).alias("ids"))
        .select("class_id", "ids", "embedding")
        .mapInArrow(_packed, "class_id long, ids array<long>, vector binary"),
        f"{folder}/classes",
    )
    asked = stored(
        rows.where(is_query).select("vec_id", "embedding")
        .mapInArrow(_packed, "vec_id long, vector binary")
        .join(classes.select("class_id", "vector"), "vector")
        .select("vec_id", "class_id"),
        f"{folder}/asked",
    )
    schema = "query_id long, rank int, vec_id long, score double"
    sample = classes.orderBy(F.xxhash64("class_id")).limit(FIT_VECTORS).select("vector").collect()
    goal = (
        classes.join(asked.select("class_id").distinct(), "class_id", "left_semi")
        .orderBy(F.xxhash64("class_id", F.lit(1)))
        .limit(GOAL_QUERIES)
        .select("vector")
        .collect()
    )
    if not goal:
        return spark.createDataFrame([], schema)
    squares = F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    longest = float(rows.agg(F.sqrt(F.max(squares))).first()[0])
    planes = Planes(np.stack([np.frombuffer(r.vector, np.float32) for r in sample]), longest)
    wanted = np.stack([np.frombuffer(r.vector, np.float32) for r in goal])
    hashed = stored(
        classes.select("class_id", "vector").mapInArrow(
            _hash_rows(spark.sparkContext.broadcast(planes)),
            "class_id long, vector binary, points array<long>, queries array<long>",
        ),
        f"{folder}/hashed",
    )
    enough, shortest = _enough(hashed, wanted.astype(np.float64), planes.of_queries(wanted), k)
    scored = _ascend(spark, folder, stored(asked.select("class_id").distinct(), f"{folder}/open"), enough, shortest, k)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "class_id")
    near = stored(
        scored.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1).drop("place"),
        f"{folder}/near",
    )
    # Classes back to rows: a class's best k + 1 members, less the query itself.
    members = near.join(classes.select("class_id", "ids"), "class_id").select(
        "query", "score", F.explode("ids").alias("vec_id")
    )
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    listed = members.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    lists = listed.groupBy("query").agg(
        F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("near")
    )
    ranked = asked.join(lists, F.col("class_id") == F.col("query")).select(
        F.col("vec_id").alias("query_id"),
        F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("vec_id")), 1, k).alias("near"),
    )
    return ranked.select("query_id", F.posexplode("near").alias("at", "one")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "one.vec_id", "one.score"
    )
