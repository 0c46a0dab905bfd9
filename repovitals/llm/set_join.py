"""Exact Jaccard join of documents as sets of word shingles, by the relations between the sets.

Two relations between sets save work, and both keep the result exact:

* In an index list the entries of one set size and prefix position form a block. Whether sets of two
  blocks can reach the threshold follows from sizes and positions alone, so blocks are skipped whole,
  and long lists give edges of a forest of possible relatives instead of pairs. Two sets that meet in
  short lists only must do so several times.
* Within relatives, the overlaps of a set with all others are derived from those of a highly similar
  set already computed: only the lists of the shingles in which the two differ are read.

Equal sets form one class from the start; copies never meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import release, sliced
from .components import connected_components
from .storage import stored, workspace
from .texthash import distinct, shingle_runs

#: Counters of the frequency sketch: a fixed number, whatever the input. They only decide the order
#: in which prefixes are cut, which has to be one for all sets, not exact. With too few, the shingles
#: that share a counter hide the frequent one among them: lists grow long, and sets without relation
#: end up in one family.
SLOT_BITS = 22
COUNTERS = 1 << SLOT_BITS
#: Rows in which the counters are added up.
COUNTER_PARTS = 256
#: Shingles of one block of relatives; a larger family is joined block by block.
BLOCK_SHINGLES = 2_000_000
#: Linked sets share at least so many shingles of their prefixes (or all that they need to share).
LEAST_SHARED = 3
#: Lists of up to so many sets give pairs, which must meet in LEAST_SHARED lists; longer ones give forests.
SHORT_LIST = 128
#: Up to so many sets are compared pair by pair.
FEW_SETS = 6
#: Similar sets whose overlaps are kept for deriving those of others.
LEADERS = 8


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [text or b"" for text in batch.column("text").to_pylist()]


def _slot(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _count_slots(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, dtype=np.uint32)
        for batch in batches:
            np.add.at(counts, _slot(np.concatenate(list(shingle_runs(_texts(batch), k)))), np.uint32(1))
        # 65,535 of one task are many enough; sums over tasks go on.
        parts = np.split(np.minimum(counts, 0xFFFF).astype(np.uint16), COUNTER_PARTS)
        rows = [(i, part.tobytes()) for i, part in enumerate(parts) if part.any()]
        if rows:
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([i for i, _ in rows], pa.int32()), "counts": [c for _, c in rows]}
            )

    return run


def _add_counts(frame):
    import pandas as pd

    total = np.zeros(COUNTERS // COUNTER_PARTS, dtype=np.int64)
    for counts in frame["counts"]:
        total += np.frombuffer(counts, dtype=np.uint16)
    total = np.minimum(total, 0xFFFFFFFF).astype(np.uint32)
    return pd.DataFrame({"part": [frame["part"].iloc[0]], "counts": [total.tobytes()]})


def slot_counts(texts: DataFrame, k: int) -> np.ndarray:
    """How often shingles of all texts fall on each counter: 256 rows of fixed size reach the driver."""
    parts = (
        texts.mapInArrow(sliced(_count_slots(k)), "part int, counts binary")
        .groupBy("part")
        .applyInPandas(_add_counts, "part int, counts binary")
        .collect()
    )
    counts = np.zeros((COUNTER_PARTS, COUNTERS // COUNTER_PARTS), dtype=np.uint32)
    for part, data in parts:
        counts[part] = np.frombuffer(data, dtype=np.uint32)
    return counts.reshape(-1)


def _digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def least_overlap(size_a, size_b, percent: int):
    """The least intersection with which sets of these sizes reach the threshold."""
    return -((-percent * (size_a + size_b)) // (100 + percent))


def _prefixes(k: int, percent: int, counts):
    """Rows (doc_id, n, digest, prefix): the shingles of which linked sets share at least one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = counts.value
        for batch in batches:
            sizes, digests, prefixes = [], [], []
            for runs in shingle_runs(_texts(batch), k):
                shingles = distinct(runs)
                n = len(shingles)
                length = min(n, n - ceil(percent * n / 100) + LEAST_SHARED)
                order = np.argsort(rank[_slot(shingles)], kind="stable")[:length]
                sizes.append(n)
                digests.append(_digest(shingles) if n else None)
                prefixes.append(shingles[order].view(np.int64))
            ends = np.cumsum([0, *map(len, prefixes)]).astype(np.int32)
            flat = np.concatenate([*prefixes, np.empty(0, dtype=np.int64)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                ],
                names=["doc_id", "n", "digest", "prefix"],
            )

    return run


def _fits(size_a, place_a, size_b, place_b, percent: int):
    """Can sets of these sizes, size_a not above size_b, that share a shingle at these places link?"""
    most = np.minimum(place_a, place_b) + np.minimum(size_a - place_a, size_b - place_b)
    return (100 * size_a >= percent * size_b) & (most >= least_overlap(size_a, size_b, percent))


def _list_edges(percent: int):
    """Walk index lists sorted by token, of columns token, place (n * 2^32 + pos) and sid, and give edges (a, b, need) of possible relatives.

    Entries of a short list give pairs, and `need` says in how many short lists a pair must meet.
    Of a long list, related blocks get an edge (need 0) between their first members, and the members
    of a block one to its first.
    """

    def short_pairs(n, pos, sid, lengths):
        rank = np.arange(len(n)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        left = np.repeat(np.where(lengths <= SHORT_LIST, lengths, 0), lengths) - rank
        low = np.flatnonzero(left > 1)
        for step in range(1, SHORT_LIST):
            low = low[left[low] > step]
            if not len(low):
                return
            high = low + step
            fits = _fits(n[low], pos[low], n[high], pos[high], percent)
            a, b = low[fits], high[fits]
            yield sid[a], sid[b], np.minimum(LEAST_SHARED, least_overlap(n[a], n[b], percent))

    def forest(size, place, ids):
        head = np.flatnonzero(
            np.concatenate(([True], (size[1:] != size[:-1]) | (place[1:] != place[:-1])))
        )
        members = np.diff(np.append(head, len(ids)))
        size, place, first = size[head], place[head], ids[head]
        yield np.repeat(first, members - 1), np.delete(ids, head)
        for i in range(1, len(head)):
            near = slice(np.searchsorted(size, ceil(size[i] * percent / 100)), i)
            others = first[near][_fits(size[near], place[near], size[i], place[i], percent)]
            yield others, np.full(len(others), first[i])

    def walk(token: np.ndarray, place: np.ndarray, sid: np.ndarray):
        # Most lists have one entry. The others are sorted here: Spark sorts fastest by one number.
        same = np.concatenate(([False], token[1:] == token[:-1], [False]))
        several = np.flatnonzero(same[1:] | same[:-1])
        token, place, sid = token[several], place[several], sid[several]
        order = np.lexsort((sid, place, token))
        token, place, sid = token[order], place[order], sid[order]
        n, pos = place >> 32, place & 0xFFFFFFFF
        starts = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1]))) if len(token) else token
        lengths = np.diff(np.append(starts, len(token)))
        parts = list(short_pairs(n, pos, sid, lengths))
        for start, length in zip(starts.tolist(), lengths.tolist(), strict=True):
            if length > SHORT_LIST:
                own = slice(start, start + length)
                parts.extend((a, b, np.zeros(len(a), np.int64)) for a, b in forest(n[own], pos[own], sid[own]))
        a, b, need = (np.concatenate([np.empty(0, np.int64), *column]) for column in zip(*parts, strict=True)) if parts else [np.empty(0, np.int64)] * 3
        return pa.RecordBatch.from_pydict(
            {"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b)), "need": pa.array(need)}
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            now = [batch.column(c).to_numpy() for c in ("token", "place", "sid")]
            if kept is not None:
                now = [np.concatenate(pair) for pair in zip(kept, now, strict=True)]
            cut = int(np.searchsorted(now[0], now[0][-1])) if len(now[0]) else 0
            kept = [column[cut:] for column in now]
            if cut:
                yield walk(*(column[:cut] for column in now))
        if kept is not None and len(kept[0]):
            yield walk(*kept)

    return run


def _few_links(sets: list[np.ndarray], sizes: np.ndarray, percent: int, sides: np.ndarray | None):
    linked: list[list[int]] = [[] for _ in sets]
    for i, one in enumerate(sets):
        for j in range(i):
            least, most = sorted((len(one), len(sets[j])))
            if 100 * least < percent * most or (sides is not None and sides[i] == sides[j]):
                continue
            both = np.sort(np.concatenate((one, sets[j])))
            overlap = np.count_nonzero(both[1:] == both[:-1])
            if 100 * overlap >= percent * (least + most - overlap):
                linked[i].append(j)
                linked[j].append(i)
    for i in np.argsort(sizes, kind="stable").tolist():
        yield i, np.array(sorted(linked[i]), dtype=np.int64)


def overlap_links(sets: list[np.ndarray], percent: int, sides: np.ndarray | None = None):
    """Yield (i, positions of the sets linked with set i) for each set, in order of size.

    sides: if given, one value per set; only pairs across them count then.
    """
    sizes = np.array([len(s) for s in sets])
    if len(sets) <= FEW_SETS:
        yield from _few_links(sets, sizes, percent, sides)
        return
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    owner = np.repeat(np.arange(len(sets)), sizes)
    by_code = np.argsort(codes, kind="stable")
    lists = owner[by_code]
    bounds = np.searchsorted(codes[by_code], np.arange(codes.max() + 2))
    ends = np.cumsum(sizes)
    own = [codes[e - s : e] for e, s in zip(ends, sizes, strict=True)]

    def count(tokens: np.ndarray) -> np.ndarray:
        if not len(tokens):
            return np.zeros(len(sets), dtype=np.int64)
        begin = bounds[tokens]
        lengths = bounds[tokens + 1] - begin
        ends = np.cumsum(lengths)
        met = lists[np.arange(ends[-1]) + np.repeat(begin - ends + lengths, lengths)]
        return np.bincount(met, minlength=len(sets))

    leaders: list[tuple[int, np.ndarray]] = []
    oldest = 0
    for i in np.argsort(sizes, kind="stable").tolist():
        apart, best = sizes[i], None
        for leader, overlap in leaders:
            differ = sizes[leader] + sizes[i] - 2 * overlap[i]
            if differ < apart:
                apart, best = differ, (leader, overlap)
        if best is None:
            overlap = count(own[i])
        else:
            gone = np.setdiff1d(own[best[0]], own[i], assume_unique=True)
            come = np.setdiff1d(own[i], own[best[0]], assume_unique=True)
            overlap = best[1] - count(gone) + count(come)
        if apart * 4 > sizes[i]:
            if len(leaders) < LEADERS:
                leaders.append((i, overlap))
            else:
                leaders[oldest] = (i, overlap)
                oldest = (oldest + 1) % LEADERS
        linked = 100 * overlap >= percent * (sizes[i] + sizes - overlap)
        linked[i] = False
        if sides is not None:
            linked &= sides != sides[i]
        yield i, np.flatnonzero(linked)


def _links_within(sets: list[np.ndarray], weights: np.ndarray, sides: np.ndarray | None, percent: int):
    """For each set the first one of its group here, and how many documents it links with."""
    label = np.arange(len(sets))
    links = np.zeros(len(sets), dtype=np.int64)
    for i, others in overlap_links(sets, percent, sides) if len(sets) > 1 else ():
        if len(others):
            links[i] += weights[others].sum()
            joined = np.unique(label[np.append(others, i)])
            if len(joined) > 1:
                label[np.isin(label, joined)] = joined[0]
    return label, links


#: What rows of one comparison have in common: a family, and the two blocks of it that meet.
MEETING = ("family", "low_band", "low_part", "high_band", "high_part")


def _join_families(k: int, percent: int):
    """Rows (sid, near, links) from rows dealt and sorted by MEETING, one comparison after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        sids, copies, blocks, sets, seen = [], [], [], [], set()
        out: list[list] = [[], [], []]

        def compare() -> None:
            within = at is not None and at[1:3] == at[3:]
            label, links = _links_within(sets, np.array(copies), None if within else np.array(blocks), percent)
            out[0].extend(sids)
            out[1].extend(sids[first] for first in label.tolist())
            out[2].extend(links.tolist())
            for kept in (sids, copies, blocks, sets, seen):
                kept.clear()

        def answers() -> pa.RecordBatch:
            found = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["sid", "near", "links"])
            for column in out:
                column.clear()
            return found

        for batch in batches:
            meetings = zip(*(batch.column(c).to_pylist() for c in MEETING), strict=True)
            rows = zip(*(batch.column(c).to_pylist() for c in ("sid", "copies", "block", "digest")), strict=True)
            for meeting, (sid, n_copies, block, digest), runs in zip(
                meetings, rows, shingle_runs(_texts(batch), k), strict=True
            ):
                if meeting != at:
                    compare()
                    at = meeting
                shingles = distinct(runs)
                # Rows of equal doc_id may have other texts: a class is represented by the text it came from.
                if (digest, block) not in seen and _digest(shingles) == digest:
                    seen.add((digest, block))
                    sids.append(sid)
                    copies.append(n_copies)
                    blocks.append(block)
                    sets.append(shingles)
            yield answers()
        compare()
        yield answers()

    return run


def jaccard_groups(documents: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, n_links), one per row of documents.

    Two documents link when 100 * |A and B| >= percent * |A or B| for their sets of k-word shingles
    (the whole sequence as one where there are fewer than k words). component_id is the least doc_id
    reachable by links, itself included; n_links counts the documents linked directly, copies too.

    A NULL, empty or blank text has the empty set: no links, n_shingles 0. Repeated rows are documents
    of their own that link with each other. A NULL doc_id counts as no id: component_id is then the
    least id of the group, or NULL. Ties do not arise. Columns other than doc_id and text are not read.
    """
    spark = documents.sparkSession
    folder = workspace(spark)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary"))
    counts = spark.sparkContext.broadcast(slot_counts(texts.select("text"), k))
    found = stored(
        texts.mapInArrow(
            sliced(_prefixes(k, percent, counts)), "doc_id long, n long, digest binary, prefix array<long>"
        ).withColumn("sid", F.xxhash64("digest")),
        f"{folder}/documents",
    )
    # Sets are compared by their shingles; sid only names a class in the graphs (64 bits of its digest).
    # Equal sets have one prefix: copies go before prefixes become rows.
    postings = (
        found.where("n > 0")
        .groupBy("digest", "sid", "n")
        .agg(F.first("prefix").alias("prefix"))
        .select("sid", "n", F.posexplode("prefix").alias("pos", "token"))
        .select("token", (F.col("n") * (1 << 32) + F.col("pos")).alias("place"), "sid")
    )
    edges = (
        postings.repartition("token")
        .sortWithinPartitions("token")
        .mapInArrow(_list_edges(percent), "a long, b long, need long")
        .groupBy("a", "b")
        .agg(F.count("*").alias("met"), F.max("need").alias("need"), F.min("need").alias("least"))
        .where("least = 0 or met >= need")
        .select("a", "b")
    )
    families = stored(
        connected_components(edges, f"{folder}/families").select(
            F.col("node").alias("sid"), F.col("root").alias("family")
        ),
        f"{folder}/family",
    )
    classes = found.where("n > 0").groupBy("digest", "sid", "n").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("first_id")
    )
    members = stored(classes.join(families, "sid"), f"{folder}/members")
    linked = _link(members, texts, k, percent, folder)
    near = connected_components(
        linked.where("sid <> near").select(F.col("sid").alias("a"), F.col("near").alias("b")),
        f"{folder}/links",
    )
    link_counts = linked.groupBy("sid").agg(F.sum("links").alias("links"))
    # One row per related class: its group's root and its links to other classes.
    related = (
        members.select("digest", "sid", "first_id")
        .join(near, F.col("sid") == F.col("node"), "left")
        .join(link_counts, "sid", "left")
        .select("digest", "first_id", F.coalesce("root", "sid").alias("root"), "links")
    )
    groups = related.groupBy("root").agg(F.min("first_id").alias("group_id"))
    related = stored(related.join(groups, "root").select("digest", "group_id", "links"), f"{folder}/related")
    own = classes.select("digest", "copies", "first_id")
    answers = own.join(related, "digest", "left").select(
        "digest",
        F.coalesce("group_id", "first_id").alias("component"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("class_links"),
    )
    return found.join(answers, "digest", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce("class_links", F.lit(0)).cast("long").alias("n_links"),
    )


def _link(members: DataFrame, texts: DataFrame, k: int, percent: int, folder: str) -> DataFrame:
    """Rows (sid, near, links): exact links within families, a large family block by block."""
    # A family of more than one block is cut by bands of sizes, of which only neighbours can link, and
    # a large band by a hash. Each of its blocks meets itself and those after it in its reach.
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)) + 1e-9)
    sizes = members.groupBy("family").agg(F.sum("n").alias("family_n"))
    banded = members.join(sizes, "family").withColumn(
        "band", F.when(F.col("family_n") > BLOCK_SHINGLES, band).otherwise(F.lit(0)).cast("long")
    )
    blocks = banded.groupBy("family", "band").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("blocks"))
    above = blocks.select("family", (F.col("band") - 1).alias("band"), F.col("blocks").alias("above"))
    below = blocks.select("family", (F.col("band") + 1).alias("band"), F.col("blocks").alias("below"))
    reach = blocks.join(above, ["family", "band"], "left").join(below, ["family", "band"], "left")

    def partners(shift: int, count: str):
        numbers = F.when(F.col(count) > 0, F.sequence(F.lit(0).cast("long"), F.col(count) - 1))
        partner = F.transform(
            F.coalesce(numbers, F.array().cast("array<bigint>")),
            lambda i: F.struct((F.col("band") + shift).alias("band"), i.alias("part")),
        )
        return partner

    me = F.struct("band", "part")
    placed = (
        banded.join(reach, ["family", "band"])
        .withColumn("part", F.pmod(F.xxhash64("digest"), F.col("blocks")))
        .withColumn(
            "other", F.explode(F.concat(partners(0, "blocks"), partners(1, "above"), partners(-1, "below")))
        )
        .withColumn("low", F.least(me, F.col("other")))
        .withColumn("high", F.greatest(me, F.col("other")))
        .select(
            "family", "low.band", "low.part", "high.band", "high.part",
            F.xxhash64("band", "part"), "sid", "copies", "digest", "first_id",
        )
        .toDF(*MEETING, "block", "sid", "copies", "digest", "first_id")
    )
    return stored(
        placed.join(texts, F.col("first_id").eqNullSafe(F.col("doc_id")))
        .select(*MEETING, "block", "sid", "copies", "digest", "text")
        .repartition(*MEETING)
        .sortWithinPartitions(*MEETING)
        .mapInArrow(sliced(_join_families(k, percent)), "sid long, near long, links long"),
        f"{folder}/linked",
    )
