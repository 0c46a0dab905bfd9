"""Reversible line dedup: an index of lines to which documents are added and from which they go again.

Keys of lines are spread over shards. Each shard has a cuckoo filter over its keys, and behind the
filters stand exact tables: postings (key, doc_id) and reference counts (key, refs, keeper). What
arrives is held against the filters first; only keys that a filter may have seen are looked up in the
exact tables, all others (most lines occur once) are appended. Removing a document lowers the
counts, and a key nobody holds any more leaves its filter, so its lines come back elsewhere. Each key
that is held owns one mark of its filter, also one that the filter took for another.

The index is a folder of Parquet tables with one part per change. A change counts once all its parts
are written; one that failed is not read, and its parts are overwritten when it is run again.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .batches import sliced
from .cuckoo import CuckooFilter
from .storage import stored, workspace

WHITE = b" \t\n\x0b\x0c\r"
MIN_CHARS = 10
#: Keys of a shard, about: its filter and the keys that arrive for it at once are in one task.
KEYS_PER_SHARD = 1_000_000
_JUDGED = "shard int, key binary, refs long, keeper long, seen boolean, filter array<binary>"


def line_key(line: bytes) -> bytes | None:
    """The 128-bit key of a line, stripped and with A-Z lower-cased; None if it is too short to count."""
    bare = line.strip(WHITE)
    if len(bare) < MIN_CHARS or (len(bare) < 4 * MIN_CHARS and len(bare.decode()) < MIN_CHARS):
        return None
    return md5(bare.lower(), usedforsecurity=False).digest()


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys: list[bytes] = []
        counts = []
        for text in batch.column("text").to_pylist():
            own = {line_key(line) for line in (text or b"").split(b"\n")} - {None}
            keys.extend(own)
            counts.append(len(own))
        ids = np.repeat(batch.column("doc_id").to_numpy(), counts)
        for at in range(0, len(keys), 100_000):
            part = slice(at, at + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[part], pa.binary()), pa.array(ids[part], pa.int64())], names=["key", "doc_id"]
            )


def line_keys(documents: DataFrame) -> DataFrame:
    """Rows (key, doc_id): the distinct keys of each document's lines."""
    return (
        documents.where("doc_id is not null")
        .select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
        .mapInArrow(sliced(_keys), "key binary, doc_id long")
    )


def _hashes(keys) -> np.ndarray:
    return np.frombuffer(b"".join(key[:8] for key in keys), dtype=np.uint64)


def _frame(shard: int, keys, refs, keepers, seen, filters):
    """Rows for keys, then one for the shard's filter."""
    import pandas as pd

    n = len(keys)
    return pd.DataFrame(
        {
            "shard": [shard] * (n + 1),
            "key": [*keys, None],
            "refs": pd.array([*refs, None], dtype="Int64"),
            "keeper": pd.array([*keepers, None], dtype="Int64"),
            "seen": pd.array([*seen, None], dtype="boolean"),
            "filter": [*[None] * n, filters.to_bytes()],
        }
    )


def _load(old, expected: int) -> CuckooFilter:
    return CuckooFilter.from_bytes(list(old["filter"].iloc[0])) if len(old) else CuckooFilter(expected)


def _judge(key, fresh, old):
    """Hold a shard's keys against its filter; the new ones enter it."""
    filters = _load(old, len(fresh))
    hashes = _hashes(fresh["key"])
    seen = filters.contains(hashes)
    filters.insert(hashes[~seen])
    return _frame(int(key[0]), fresh["key"], fresh["refs"], fresh["keeper"], seen, filters)


def _enter(key, missed, old):
    """Give the keys that a shard's filter took for known ones a mark of their own."""
    filters = _load(old, 0)
    if len(missed):
        filters.insert(_hashes(missed["key"]))
    return _frame(int(key[0]), [], [], [], [], filters)


def _forget(key, gone, old):
    filters = _load(old, 0)
    if len(gone):
        filters.remove(_hashes(gone["key"]))
    return _frame(int(key[0]), [], [], [], [], filters)


class LineIndex:
    """The index in one folder, which may hold one already: then it goes on from its last complete change.

    shards is fixed with the first documents. Without it there is one for KEYS_PER_SHARD of their keys, times
    `growth` for what is to come, and as many as there are shuffle partitions at least. One process at a time
    may change an index.
    """

    def __init__(self, spark: SparkSession, folder: str, shards: int | None = None, growth: int = 2):
        self.spark, self.folder, self.growth = spark, folder, growth
        # The filters of a change are written last.
        self.version = 0
        while self._complete(self._path("filters", self.version + 1)):
            self.version += 1
        self.shards = shards
        if self._complete(f"{folder}/layout"):
            self.shards = spark.read.schema("shards int").parquet(f"{folder}/layout").first().shards
            if shards not in (None, self.shards):
                raise ValueError(f"the index has {self.shards} shards, not {shards}")

    def _complete(self, path: str) -> bool:
        done = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return done.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(done)

    def _lay_out(self, new: DataFrame) -> None:
        """Fix the number of shards by the first keys, unless it is."""
        if self._complete(f"{self.folder}/layout"):
            return
        if self.shards is None:
            keys = new.agg(F.approx_count_distinct("key")).first()[0] * self.growth
            self.shards = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-keys // KEYS_PER_SHARD))
        stored(self.spark.createDataFrame([(self.shards,)], "shards int"), f"{self.folder}/layout")

    def _path(self, table: str, version: int) -> str:
        return f"{self.folder}/{table}/change={version}"

    def _all(self, table: str, schema: str) -> DataFrame:
        """All parts of a table, with the number of the change that wrote each."""
        parts = [
            self.spark.read.schema(schema).parquet(self._path(table, v)).withColumn("change", F.lit(v))
            for v in range(1, self.version + 1)
        ]
        out = parts[0] if parts else self.spark.createDataFrame([], f"{schema}, change int")
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def _shard(self):
        return F.pmod(F.xxhash64("key"), F.lit(self.shards)).cast("int").alias("shard")

    def counts(self) -> DataFrame:
        """Rows (key, refs, keeper): how many documents hold each line, and the least of their ids."""
        latest = self._all("counts", "key binary, refs long, keeper long").groupBy("key").agg(
            F.max_by(F.struct("refs", "keeper"), "change").alias("last")
        )
        return latest.select("key", "last.refs", "last.keeper").where("refs > 0")

    def postings(self) -> DataFrame:
        """Rows (key, doc_id) of the documents now in the index."""
        signed = self._all("postings", "key binary, doc_id long, held boolean")
        # Dealt by both columns, else a join on the key would gather a frequent line before it is counted.
        latest = signed.repartition("key", "doc_id").groupBy("key", "doc_id").agg(F.max_by("held", "change").alias("held"))
        return latest.where("held").select("key", "doc_id")

    def _filters(self) -> DataFrame:
        if not self.version:
            return self.spark.createDataFrame([], "shard int, filter array<binary>")
        path = self._path("filters", self.version)
        return self.spark.read.schema("shard int, filter array<binary>").parquet(path)

    def _commit(self, postings: DataFrame, counts: DataFrame, changed_filters: DataFrame) -> None:
        version = self.version + 1
        stored(postings, self._path("postings", version))
        stored(counts, self._path("counts", version))
        kept = self._filters().join(changed_filters.select("shard"), "shard", "left_anti")
        stored(kept.unionByName(changed_filters), self._path("filters", version))
        self.version = version

    def add(self, documents: DataFrame) -> None:
        """Insert documents (doc_id, text). A document already in the index adds what it did not hold."""
        scratch = f"{self.folder}/scratch/change={self.version + 1}"
        new = stored(line_keys(documents).distinct(), f"{scratch}/new")
        self._lay_out(new)
        arriving = new.groupBy("key").agg(F.count("*").alias("refs"), F.min("doc_id").alias("keeper"))
        judged = stored(
            arriving.select(self._shard(), "key", "refs", "keeper")
            .groupBy("shard")
            .cogroup(self._filters().groupBy("shard"))
            .applyInPandas(_judge, _JUDGED),
            f"{scratch}/judged",
        )
        filters = judged.where("filter is not null").select("shard", "filter")
        first = judged.where("not seen").select("key", "refs", "keeper")
        if self.version:
            maybe = judged.where("seen").select("key")
            held = self.postings().join(maybe, "key", "left_semi")
            new = stored(new.join(held, ["key", "doc_id"], "left_anti"), f"{scratch}/added")
            more = new.join(maybe, "key", "left_semi").groupBy("key").agg(
                F.count("*").alias("more"), F.min("doc_id").alias("least")
            )
            again = more.join(self.counts(), "key", "left").select(
                "key",
                (F.col("more") + F.coalesce("refs", F.lit(0))).alias("refs"),
                F.least("least", "keeper").alias("keeper"),
                F.col("refs").isNull().alias("missed"),
            )
            again = stored(again, f"{scratch}/again")
            # A key that only seemed to be seen leans on another key's mark, which may go with that key.
            missed = again.where("missed").select(self._shard(), "key")
            filters = (
                missed.groupBy("shard").cogroup(filters.groupBy("shard")).applyInPandas(_enter, _JUDGED)
            ).select("shard", "filter")
            first = first.unionByName(again.select("key", "refs", "keeper"))
        self._commit(new.withColumn("held", F.lit(True)), first, filters)

    def remove(self, doc_ids: DataFrame) -> None:
        """Take documents (doc_id) out: counts go down, and keys nobody holds leave their filter."""
        scratch = f"{self.folder}/scratch/change={self.version + 1}"
        if not self.version:
            return
        wanted = doc_ids.select(F.col("doc_id").cast("long")).distinct()
        gone = stored(self.postings().join(wanted, "doc_id", "left_semi").select("key", "doc_id"), f"{scratch}/gone")
        touched = gone.select("key").distinct()
        left = (
            self.postings()
            .join(touched, "key", "left_semi")
            .join(gone, ["key", "doc_id"], "left_anti")
            .groupBy("key")
            .agg(F.count("*").alias("refs"), F.min("doc_id").alias("keeper"))
        )
        counts = stored(
            touched.join(left, "key", "left").select("key", F.coalesce("refs", F.lit(0)).alias("refs"), "keeper"),
            f"{scratch}/counts",
        )
        dead = counts.where("refs = 0").select(self._shard(), "key")
        filters = (
            dead.groupBy("shard").cogroup(self._filters().groupBy("shard")).applyInPandas(_forget, _JUDGED)
        )
        self._commit(gone.withColumn("held", F.lit(False)), counts, filters.select("shard", "filter"))

    def repeated(self) -> DataFrame:
        """Rows (doc_id, keys): the lines each document loses, because a document before it holds them."""
        # Written, so that both sides of the join are plain shuffles, which Spark splits at a frequent line.
        shared = stored(self.counts().where("refs > 1"), f"{self.folder}/scratch/shared={self.version}")
        lost = self.postings().join(shared, "key").where("doc_id <> keeper")
        return lost.groupBy("doc_id").agg(F.collect_list("key").alias("keys"))

    def apply(self, documents: DataFrame) -> DataFrame:
        """Documents with their repeated lines taken out of text; n_lines and n_dropped are added.

        n_lines counts lines before dropping. Columns of these two names are replaced.
        """
        columns = [c for c in documents.columns if c.lower() not in ("n_lines", "n_dropped")]
        lost = self.repeated().withColumnRenamed("doc_id", "_holder")
        met = documents.select(*(F.col(f"`{c}`") for c in columns)).join(
            lost, F.col("doc_id").cast("long") == F.col("_holder"), "left"
        )
        text = next(c for c in columns if c.lower() == "text")
        cut = F.struct(F.col(text).cast("binary").alias("text"), F.col("keys")).alias("_cut")
        rest = [F.col(f"`{c}`") for c in columns if c != text]
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*rest).schema)
        out = met.select(*rest, cut).mapInArrow(
            sliced(_cut_lines), f"{fields}{', ' if fields else ''}`{text}` string, n_lines long, n_dropped long"
        )
        return out.select(*(f"`{c}`" for c in columns), "n_lines", "n_dropped")


def _cut_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cut = batch.column("_cut")
        texts, lines, dropped = [], [], []
        for text, keys in zip(cut.field("text").to_pylist(), cut.field("keys").to_pylist(), strict=True):
            parts = (text or b"").split(b"\n")
            kept = parts
            if keys:
                lost = set(keys)
                kept = [line for line in parts if line_key(line) not in lost]
            texts.append(b"\n".join(kept))
            lines.append(len(parts))
            dropped.append(len(parts) - len(kept))
        rest = [batch.column(i) for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays(
            [*rest, pa.array(texts, pa.binary()).cast(pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
            names=[*batch.schema.names[:-1], "text", "n_lines", "n_dropped"],
        )


def dedup_lines(documents: DataFrame, batches: int = 2) -> DataFrame:
    """Documents without the lines that a document of smaller doc_id also holds.

    Lines are the text's parts between newlines; their keys are stripped of ASCII white space with A-Z
    lower-cased, and count from ten characters on. Within one document repeats stay. The documents
    enter a new index in so many arrivals, dealt by a hash of doc_id; the result does not depend on it.

    A NULL or empty text is one empty line. A NULL doc_id names no document: its lines neither count
    nor go. Rows of equal doc_id are one document. Columns n_lines and n_dropped are added (or
    replaced); all others are kept as they are, text apart.
    """
    spark = documents.sparkSession
    index = LineIndex(spark, workspace(spark), growth=2 * batches)
    for i in range(batches):
        index.add(documents.where(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == i))
    return index.apply(documents)
