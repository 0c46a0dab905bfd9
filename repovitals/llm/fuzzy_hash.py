"""Context-triggered piecewise hashes of texts, and their likeness.

A hash of the last seven bytes rolls over the text; where it hits a value that depends on the block
size, a chunk ends. Each chunk gives one character of the signature, so a change in the text changes
the characters of the chunks it touches and no others. The block size is chosen by length. A
fingerprint has signatures at two sizes, `size:signature:signature at twice the size`, so texts
whose sizes differ by a factor of two can still be compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .batches import sliced
from .storage import ship_package
from .texthash import mix

WINDOW = 7
SIGNATURE = 64
LEAST_SIZE = 3
#: Signatures are alike only if they share so many characters in a row (half of a shorter signature).
COMMON = 7
_ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", dtype=np.uint8)
_BYTE = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_BASE = np.uint32(0x9E3779B1)


def rolling_hashes(data: bytes) -> np.ndarray:
    """For each byte a hash of the seven that end there (before the start: nothing)."""
    values = np.concatenate((np.zeros(WINDOW - 1, np.uint32), _BYTE[np.frombuffer(data, dtype=np.uint8)]))
    n = len(data)
    out = values[:n].copy()
    for i in range(1, WINDOW):
        out *= _BASE
        out += values[i : i + n]
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x2C1B3C6D)
    out ^= out >> np.uint32(12)
    return out


def _signature(hashes: np.ndarray, ends: np.ndarray, limit: int) -> str:
    """One character a chunk; the chunks after the limit count as one."""
    starts = np.concatenate(([0], ends[: limit - 1] + 1))
    starts = starts[starts < len(hashes)]
    sums = mix(np.add.reduceat(hashes, starts, dtype=np.uint64) + np.uint64(1))
    return _ALPHABET[(sums >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def fingerprint(data: bytes) -> str:
    if not data:
        return f"{LEAST_SIZE}::"
    hashes = rolling_hashes(data)
    size = LEAST_SIZE
    while size * SIGNATURE < len(data):
        size *= 2
    while True:
        ends = np.flatnonzero(hashes % np.uint32(size) == size - 1)
        if size == LEAST_SIZE or len(ends) >= SIGNATURE // 2:
            break
        size //= 2
    wide = ends[hashes[ends] % np.uint32(2 * size) == 2 * size - 1]
    return f"{size}:{_signature(hashes, ends, SIGNATURE)}:{_signature(hashes, wide, SIGNATURE // 2)}"


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, all of a row of the table at once in one number."""
    places: dict[str, int] = {}
    for i, char in enumerate(a):
        places[char] = places.get(char, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for char in b:
        hit = row & places.get(char, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def _share_run(a: str, b: str) -> bool:
    shorter = min(len(a), len(b))
    if not shorter:
        return a == b
    run = min(COMMON, max(1, shorter // 2))
    runs = {a[i : i + run] for i in range(len(a) - run + 1)}
    return any(b[i : i + run] in runs for i in range(len(b) - run + 1))


def _likeness(a: str, b: str) -> float:
    """1 less the edit distance (insertions and deletions) as a share of both lengths."""
    if not _share_run(a, b):
        return 0.0
    return 2 * common_subsequence(a, b) / (len(a) + len(b)) if a or b else 1.0


def likeness(one: str, two: str) -> float:
    """From 0 to 1; 1 for equal fingerprints, 0 where block sizes are not compatible."""
    if one == two:
        return 1.0
    size_a, a, wide_a = one.split(":")
    size_b, b, wide_b = two.split(":")
    size_a, size_b = int(size_a), int(size_b)
    if size_a == size_b:
        return max(_likeness(a, b), _likeness(wide_a, wide_b))
    if size_a == 2 * size_b:
        return _likeness(a, wide_b)
    if size_b == 2 * size_a:
        return _likeness(wide_a, b)
    return 0.0


_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _row(doc_id, text: str, own: str, next_text: str, next_own: str):
    cut = len(text) // 3
    edited = (text[: len(text) - cut] + next_text[:cut]).encode("utf-8", "surrogatepass")
    other = fingerprint(edited)
    return (
        doc_id, len(text), sha256(edited).hexdigest(), own, other, likeness(own, other), likeness(own, next_own),
    )


def _against_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by bucket and in order; each is held until the next of its bucket is there."""
    held = None
    names = [field.split()[0] for field in _SCHEMA.split(", ")]
    for batch in batches:
        rows = []
        for bucket, guest, doc_id, text in zip(
            *(batch.column(c).to_pylist() for c in ("bucket", "guest", "doc_id", "text")), strict=True
        ):
            text = text or ""
            own = fingerprint(text.encode("utf-8", "surrogatepass"))
            if held is not None and held[0] == bucket:
                rows.append(_row(*held[1:], text, own))
            held = None if guest else (bucket, doc_id, text, own)
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def fingerprints(documents: DataFrame) -> DataFrame:
    """Each whole text's fingerprint, and how it compares with an edited text and with the next document.

    The next document is the one before in doc_id (after the least: the greatest); the edited text has
    its last third (rounded down, in characters) replaced by as many first characters of the next
    one's text, or all. n_chars counts the characters of the text.

    Documents are dealt to ranges of doc_id and sorted there; only the first row of each range goes to
    the range before it as well. A NULL text is empty. NULL ids come last, rows of equal id in the order
    of their texts. A single document is its own next. Other columns are not read.
    """
    spark = documents.sparkSession
    ship_package(spark)
    ranges = max(1, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    bounds = rows.where("doc_id is not null").stat.approxQuantile(
        "doc_id", [i / ranges for i in range(1, ranges)], 0.25 / ranges
    )
    bounds = sorted({int(b) for b in bounds})
    # Ranges are numbered from the greatest ids down; NULL ids are the last range.
    above = F.lit(0)
    if bounds:
        limits = F.array(*(F.lit(b).cast("long") for b in bounds))
        above = F.size(F.filter(limits, lambda b: b > F.col("doc_id")))
    bucket = F.when(F.col("doc_id").isNull(), len(bounds) + 1).otherwise(above)
    placed = rows.withColumn("bucket", bucket)
    place = F.struct((-F.col("doc_id")).alias("down"), "text", "doc_id")
    heads = placed.groupBy("bucket").agg(F.min(place).alias("head"))
    by_bucket = Window.orderBy("bucket")  # one row a range
    whole = by_bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    guests = heads.select(
        F.coalesce(F.lag("bucket").over(by_bucket), F.max("bucket").over(whole)).alias("bucket"),
        F.lit(1).alias("guest"),
        "head.doc_id",
        "head.text",
    )
    dealt = placed.select("bucket", F.lit(0).alias("guest"), "doc_id", "text").unionByName(guests)
    ordered = dealt.repartition("bucket").sortWithinPartitions("bucket", "guest", F.desc("doc_id"), "text")
    return ordered.mapInArrow(sliced(_against_next), _SCHEMA)
