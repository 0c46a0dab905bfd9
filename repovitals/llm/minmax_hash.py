"""Near duplicates by min-max hashing, banded, confirmed on full sets.

Each permutation of the shingles gives two values of a signature, its least and its greatest element:
64 permutations make 128 values. The share of equal values of two signatures is an unbiased estimate
of their sets' Jaccard similarity, with less variance than 128 minima, for half the hashing. A band is
a run of values of different permutations; sets that agree in a band meet in a bucket.

Within a bucket pairs are not listed. First every set is held against its bucket's hub, the smallest
set it can link with, and what links becomes a component. Only where a bucket still holds several
components its sets are sent to blocks of full sets, in which overlaps are counted through lists of
shingles, those within the bucket's largest component left out. Equal sets are one class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import release, sliced
from .components import connected_components
from .storage import stored, workspace
from .texthash import mix, shingle_set, word_hashes

PERMUTATIONS = 64
VALUES = 2 * PERMUTATIONS
#: Linked sets miss each other in all bands with at most this chance.
MISS = 1e-6
#: Shingles whose texts are sent to one task to be confirmed, or of each side of two blocks that meet.
BLOCK_SHINGLES = 400_000
#: Shingles hashed at a time.
_RUN = 1 << 17
_SEED = 20_240_613


def rows_of(percent: int) -> int:
    """The most values a band can have for sets of this similarity to miss all bands by MISS at most."""
    share = percent / 100
    return max((r for r in (1, 2, 4, 8) if (1 - share**r) ** (VALUES // r) <= MISS), default=1)


def estimate(a: np.ndarray, b: np.ndarray) -> float:
    """The similarity of two sets as their signatures show it: the share of equal values."""
    return float((a == b).mean())


def _factors() -> tuple[np.ndarray, np.ndarray]:
    numbers = mix(np.arange(_SEED, _SEED + 2 * PERMUTATIONS, dtype=np.uint64))
    return numbers[:PERMUTATIONS] | np.uint64(1), numbers[PERMUTATIONS:]


def _value_order() -> np.ndarray:
    """Four minima, then the maxima of the next four permutations: a band has no permutation twice."""
    groups = np.arange(PERMUTATIONS).reshape(-1, 4)
    greatest = PERMUTATIONS + np.roll(groups, -1, axis=0)
    return np.hstack((groups, greatest)).reshape(-1)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of VALUES per set (none empty), of 64 bits each, in the order in which bands are cut."""
    factors, terms = _factors()
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    out = np.empty((VALUES, len(sets)), dtype=np.uint64)
    ends = np.cumsum(sizes)
    begin = 0
    while begin < len(sets):
        before = ends[begin] - sizes[begin]
        end = max(begin + 1, int(np.searchsorted(ends, before + _RUN, side="right")))
        flat = np.concatenate(sets[begin:end])
        starts = ends[begin:end] - sizes[begin:end] - before
        for i in range(PERMUTATIONS):
            moved = flat * factors[i] + terms[i]
            out[i, begin:end] = np.minimum.reduceat(moved, starts)
            out[PERMUTATIONS + i, begin:end] = np.maximum.reduceat(moved, starts)
        begin = end
    return np.ascontiguousarray(out[_value_order()].T)


def band_keys(values: np.ndarray, rows: int) -> np.ndarray:
    """For each signature one key per band."""
    bands = values.reshape(len(values), VALUES // rows, rows)
    keys = np.broadcast_to(mix(np.arange(1, bands.shape[1] + 1, dtype=np.uint64)), bands.shape[:2]).copy()
    for i in range(rows):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, i])
    return keys


def _digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _sign_rows(k: int, rows: int):
    """Rows (doc_id, text_key, n, digest, bands): the set's size, its digest, and a key for each band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text or b"" for text in batch.column("text").to_pylist()]
            sets = [shingle_set(words, k) for words in word_hashes(texts)]
            some = [s for s in sets if len(s)]
            keys = iter(band_keys(signatures(some), rows).view(np.int64))
            bands = [next(keys) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_key", "n", "digest", "bands"],
            )

    return run


def _hub_pairs(percent: int):
    """Walk postings sorted by (key, n, sid) and give pairs (a, b): each set with the hub before it.

    A hub serves the sets after it up to the greatest size it can link with; the next one is a hub too,
    and is paired with the hub before, so that buckets stay together.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            key, n, sid = (batch.column(c).to_numpy() for c in ("key", "n", "sid"))
            if not len(key):
                continue
            if last is not None:
                key, n, sid = (np.concatenate(([x], y)) for x, y in zip(last, (key, n, sid), strict=True))
            fresh = np.concatenate(([True], key[1:] != key[:-1]))
            hub = np.maximum.accumulate(np.where(fresh, np.arange(len(key)), 0))
            chained: list[tuple[np.ndarray, np.ndarray]] = []
            while len(far := np.flatnonzero(100 * n[hub] < percent * n)):
                # In each bucket the first set out of its hub's reach is the hub of all from there on.
                heads = far[np.concatenate(([True], hub[far][1:] != hub[far][:-1]))]
                chained.append((hub[heads], heads))
                hub[far] = heads[np.searchsorted(heads, far, side="right") - 1]
            met = np.flatnonzero(hub != np.arange(len(key)))
            a = np.concatenate([hub[met], *(x for x, _ in chained)])
            b = np.concatenate([met, *(y for _, y in chained)])
            last = (key[-1], n[hub[-1]], sid[hub[-1]])
            yield pa.RecordBatch.from_pydict({"a": sid[a], "b": sid[b]})

    return run


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Do two sorted sets reach the similarity?"""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _root(of: dict, x: int) -> int:
    while of.setdefault(x, x) != x:
        of[x] = x = of[of[x]]
    return x


def _join(of: dict, x: int, y: int) -> None:
    """Join two components; a component's root is its least node."""
    one, two = _root(of, x), _root(of, y)
    of[max(one, two)] = min(one, two)


def _stars(of: dict) -> list[tuple[int, int]]:
    """An edge from every node to the root of its component: a graph that later steps find done."""
    return [(x, root) for x in list(of) if (root := _root(of, x)) != x]


def _sets(texts, k: int) -> list[np.ndarray]:
    return [shingle_set(words, k) for words in word_hashes([text or b"" for text in texts])]


def _confirm(k: int, percent: int):
    """Edges (a, b) from a block's sets to the least set they reach over those of its pairs that link on full sets."""

    def run(key, pairs, texts):
        import pandas as pd

        sets = dict(zip(texts["sid"], _sets(texts["text"], k), strict=True))
        root: dict[int, int] = {}
        for a, b in zip(pairs["a"].tolist(), pairs["b"].tolist(), strict=True):
            if _root(root, a) != _root(root, b) and a in sets and b in sets and linked(sets[a], sets[b], percent):
                _join(root, a, b)
        release()
        return pd.DataFrame(_stars(root), columns=["a", "b"], dtype="int64")

    return run


def _confirm_blocks(k: int, percent: int):
    """Edges (a, b) between the labels of components whose sets link in a block, or across two blocks.

    Every pair of different components has a member outside the one that is most frequent here, so only
    those count their overlaps with all others.
    """

    def run(key, frame):
        import pandas as pd

        sets = _sets(frame["text"], k)
        sizes = np.array([len(s) for s in sets])
        side = frame["block"].to_numpy()
        names, label = np.unique(frame["label"].to_numpy(), return_inverse=True)
        codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
        by_code = np.argsort(codes, kind="stable")
        owners = np.repeat(np.arange(len(sets)), sizes)[by_code]
        bounds = np.searchsorted(codes[by_code], np.arange(codes.max(initial=-1) + 2))
        own = np.split(codes, np.cumsum(sizes)[:-1])
        root: dict[int, int] = {}
        for i in np.flatnonzero(label != np.bincount(label).argmax()).tolist():
            shared = own[i][bounds[own[i] + 1] - bounds[own[i]] > 1].tolist()
            if not shared:
                continue
            overlap = np.bincount(np.concatenate([owners[bounds[t] : bounds[t + 1]] for t in shared]), minlength=len(sets))
            met = (100 * overlap >= percent * (sizes[i] + sizes - overlap)) & (label != label[i])
            if key[0] != key[1]:
                met &= side != side[i]
            for j in np.flatnonzero(met).tolist():
                _join(root, int(label[i]), int(label[j]))
        release()
        return pd.DataFrame([(names[x], names[y]) for x, y in _stars(root)], columns=["a", "b"], dtype="int64")

    return run


def minmax_groups(documents: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one per row of documents.

    Two documents link when 100 * |A and B| >= percent * |A or B| for their sets of k-word shingles
    (the whole sequence as one where there are fewer than k words). component_id is the least doc_id
    reachable by links, itself included; kept says whether that is the row's own.

    A NULL, empty or blank text has the empty set: no links, n_shingles 0, kept. Repeated rows are
    documents of their own that link with each other, and rows of one doc_id are kept alike. A NULL
    doc_id is no id: component_id is then the least id of the group, with kept false, or NULL where
    the group has none, with kept true. Ties do not arise. Columns other than doc_id and text are not
    read; an empty table gives no rows.
    """
    spark = documents.sparkSession
    folder = workspace(spark)
    rows = rows_of(percent)
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("binary").alias("text"),
        F.xxhash64(F.col("text").cast("binary")).alias("text_key"),
    )
    found = stored(
        texts.mapInArrow(
            sliced(_sign_rows(k, rows)),
            "doc_id long, text_key long, n long, digest binary, bands array<long>",
        ),
        f"{folder}/documents",
    )
    # Sets are compared by their shingles; sid only names a class in the graphs (64 bits of its digest).
    classes = stored(
        found.where("n > 0")
        .groupBy("digest")
        .agg(
            F.first("n").alias("n"), F.min("doc_id").alias("first_id"), F.min("text_key").alias("text_key"),
            F.first("bands").alias("bands"),
        )
        .withColumn("sid", F.xxhash64("digest")),
        f"{folder}/classes",
    )
    pairs = stored(
        classes.select("n", "sid", F.explode("bands").alias("key"))
        .repartitionByRange("key", "n", "sid")
        .sortWithinPartitions("key", "n", "sid")
        .mapInArrow(_hub_pairs(percent), "a long, b long")
        .distinct(),
        f"{folder}/hub_pairs",
    )
    families = connected_components(pairs, f"{folder}/families").select(
        F.col("node").alias("sid"), F.col("root").alias("family")
    )
    related = stored(classes.select("sid", "n", "text_key", "bands").join(families, "sid"), f"{folder}/related")
    # Sets of a family are confirmed together; a large family is dealt over blocks.
    sizes = related.groupBy("family").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("long").alias("blocks"))
    placed = related.join(stored(sizes, f"{folder}/sizes"), "family")
    block = F.xxhash64("family", F.pmod(F.xxhash64("sid"), F.col("blocks")))
    members = stored(placed.select("sid", "text_key", "bands", block.alias("block")), f"{folder}/members")
    # The same join for every size: beside all texts, those wanted may be few or most.
    wanted = members.select("sid", "text_key").hint("merge")
    sources = stored(
        texts.select("text_key", "text").join(wanted, "text_key").groupBy("sid").agg(F.first("text").alias("text")),
        f"{folder}/texts",
    )
    by_hub = _hub_links(pairs, members, sources, k, percent, folder)
    roots = connected_components(by_hub, f"{folder}/hub_components")
    across = _links_across(members, roots, sources, k, percent, folder)
    joined = connected_components(across, f"{folder}/components")
    joined = joined.select(F.col("node").alias("label"), F.col("root").alias("joined"))
    own = classes.select("digest", "sid", "first_id").join(roots, F.col("sid") == F.col("node"), "left")
    own = own.select("digest", "first_id", F.coalesce("root", "sid").alias("label")).join(joined, "label", "left")
    own = stored(own.select("digest", "first_id", F.coalesce("joined", "label").alias("root")), f"{folder}/rooted")
    least = stored(own.groupBy("root").agg(F.min("first_id").alias("component")), f"{folder}/least")
    answers = stored(own.join(least, "root").select("digest", "component"), f"{folder}/answers")
    component = F.coalesce("component", "doc_id")
    return (
        found.select("doc_id", "n", "digest")
        .join(answers, "digest", "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            component.alias("component_id"),
            F.col("doc_id").eqNullSafe(component).alias("kept"),
        )
    )


def _hub_links(pairs: DataFrame, members: DataFrame, sources: DataFrame, k: int, percent: int, folder: str) -> DataFrame:
    """Edges (a, b) that join the sets whose pairs link."""
    ends = [members.select(F.col("sid").alias(end), F.col("block").alias(f"block_{end}")) for end in ("a", "b")]
    blocks = F.least("block_a", "block_b").alias("low"), F.greatest("block_a", "block_b").alias("high")
    dealt = stored(pairs.join(ends[1], "b").join(ends[0], "a").select("a", "b", *blocks), f"{folder}/hub_dealt")
    # Read anew, or Spark could not tell the columns of the two sides apart.
    again = pairs.sparkSession.read.schema(dealt.schema).parquet(f"{folder}/hub_dealt")
    needed = again.select("low", "high", F.explode(F.array("a", "b")).alias("sid")).distinct()
    return stored(
        dealt.groupBy("low", "high")
        .cogroup(needed.join(sources, "sid").select("low", "high", "sid", "text").groupBy("low", "high"))
        .applyInPandas(_confirm(k, percent), "a long, b long"),
        f"{folder}/hub_links",
    )


def _links_across(
    members: DataFrame, roots: DataFrame, sources: DataFrame, k: int, percent: int, folder: str
) -> DataFrame:
    """Edges (a, b) between the labels of components of a bucket whose sets link.

    The sets of a bucket's largest component need not meet each other: they go only where the bucket's
    other sets are, and those go wherever it has any.
    """
    rooted = members.join(roots, F.col("sid") == F.col("node"), "left")
    rooted = stored(rooted.select("sid", "block", "bands", F.coalesce("root", "sid").alias("label")), f"{folder}/rooted_hubs")
    counts = stored(rooted.groupBy("label").agg(F.count("*").alias("size")), f"{folder}/label_sizes")
    labelled = stored(rooted.join(counts, "label"), f"{folder}/labelled")
    postings = labelled.select("sid", "block", "label", "size", F.explode("bands").alias("key"))
    mixed = stored(
        postings.groupBy("key")
        .agg(
            F.min("label").alias("first"), F.max("label").alias("last"),
            F.max_by("label", F.struct("size", "label")).alias("main"),
        )
        .where("first <> last")
        .select("key", "main"),
        f"{folder}/mixed",
    )
    met = stored(postings.select("sid", "block", "label", "key").join(mixed, "key"), f"{folder}/met")
    blocks = stored(
        met.groupBy("key").agg(
            F.collect_set("block").alias("all"),
            F.collect_set(F.when(F.col("label") != F.col("main"), F.col("block"))).alias("others"),
        ),
        f"{folder}/bucket_blocks",
    )
    goes = F.when(F.col("label") == F.col("main"), F.col("others")).otherwise(F.col("all"))
    dealt = (
        met.join(blocks, "key")
        .withColumn("other", F.explode(goes))
        .select("sid", "label", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
        .distinct()
    )
    return stored(
        dealt.join(sources, "sid")
        .groupBy("low", "high")
        .applyInPandas(_confirm_blocks(k, percent), "a long, b long"),
        f"{folder}/cross_links",
    )
