"""N-best encoding with the pieces of a SentencePiece model, and decoding.

A text is a lattice whose edges are pieces; the best segmentation has the highest sum of piece scores.
Forward Viterbi scores give the best way from the start to every place. They are the exact remainder
for an A* search that walks backward from the end, which therefore meets segmentations in order.

No piece crosses the start of a word, so the lattice of a text is a chain of small ones. Viterbi
runs over the distinct words of a batch at once, on arrays; A* runs on those words of a text that can
have part in its n best, and the text's n best are put together from theirs.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import sliced
from .storage import ship_package
from .texthash import mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: How much worse than the rarest piece a character is that has to be spelt in bytes.
BYTES_PENALTY = 10.0
_WORDS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
_RAW_SPACE = ("the space mark itself, occurring in a text",)
_LONG_WORD = 48
_WORDS_AT_ONCE = 8_000
_KNOWN_WORDS = 150_000
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Pieces:
    """Pieces and scores of a model; byte_ids spell what no piece covers."""

    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: list[int]
    contents: list[bytes]

    def __post_init__(self):
        self.longest = max(map(len, self.ids), default=1)
        self.spelt = min(self.scores.values(), default=0.0) - BYTES_PENALTY
        by_length: dict[int, list[str]] = {}
        for piece in self.ids:
            by_length.setdefault(len(piece), []).append(piece)
        self.tables = {}
        for length, pieces in by_length.items():
            hashes = _rolled(np.array([[ord(c) for c in p] for p in pieces], dtype=np.uint64))
            order = np.argsort(hashes)
            self.tables[length] = (
                hashes[order],
                np.array([self.ids[p] for p in pieces], dtype=np.int32)[order],
                np.array([self.scores[p] for p in pieces])[order],
            )

        lengths = np.array([len(c) for c in self.contents], dtype=np.int64)
        table = np.frombuffer(b"".join(self.contents), dtype=np.uint8)
        self.spellings = table, np.cumsum(lengths) - lengths, lengths

    def spell(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")]


def _rolled(points: np.ndarray) -> np.ndarray:
    out = np.zeros(len(points), dtype=np.uint64)
    for column in points.T:
        out = out * _BASE + mix(column + np.uint64(1))
    return out


@cache
def load_pieces(path: str = MODEL) -> Pieces:
    """The model's pieces. Merge models carry ranks, not log probabilities; Zipf's law makes them such.

    A path on the executors' own disks, like that of any installed file.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    spelling = [i for i in range(size) if model.is_byte(i)]
    usual = [
        i for i in range(size)
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    ]
    usual.sort(key=lambda i: (-model.get_score(i), i))
    weights = 1.0 / (np.arange(len(usual)) + 2.7)
    logs = np.log(weights / weights.sum())
    contents = [b""] * size
    for i in usual:
        contents[i] = model.id_to_piece(i).replace(SPACE, " ").encode()
    for value, i in enumerate(spelling):
        contents[i] = bytes([value])
    ids = {model.id_to_piece(i): i for i in usual}
    return Pieces(ids, {model.id_to_piece(i): float(s) for i, s in zip(usual, logs, strict=True)}, spelling, contents)


def words_of(text: str) -> list:
    """The words of a text in order, each with the spaces before it; a space stands before the text."""
    if not text:
        return []
    words: list = []
    for i, part in enumerate(text.split(SPACE)):
        if i:
            words.append(_RAW_SPACE)
        words.extend(_WORDS.findall(part.replace(" ", SPACE) if i else SPACE + part.replace(" ", SPACE)))
    return words


def edges_to(pieces: Pieces, word: str, end: int) -> list[tuple[int, float]]:
    """(start, score) of all edges that end at a place, the longest first."""
    found = []
    for start in range(max(0, end - pieces.longest), end):
        score = pieces.scores.get(word[start:end])
        if score is not None:
            found.append((start, score))
    if word[end - 1] not in pieces.ids:
        found.append((end - 1, pieces.spelt))
    return found


def nbest_word(pieces: Pieces, word: str, n: int) -> list[tuple[float, list[int]]]:
    """The n best (score, ids) of one word, best first: forward Viterbi, then A* from the end."""
    incoming = [[]] + [edges_to(pieces, word, end) for end in range(1, len(word) + 1)]
    forward = [0.0] + [-np.inf] * len(word)
    for end in range(1, len(word) + 1):
        forward[end] = max(forward[start] + score for start, score in incoming[end])
    # (minus the best total, a serial number, place, score from here on, the cuts made so far)
    queue: list = [(-forward[-1], 0, len(word), 0.0, None)]
    serial, out = 0, []
    while queue and len(out) < n:
        _, _, place, behind, cuts = heapq.heappop(queue)
        if place == 0:
            ids: list[int] = []
            start = 0
            while cuts is not None:
                end, cuts = cuts
                part = word[start:end]
                ids.extend([pieces.ids[part]] if part in pieces.ids else pieces.spell(part))
                start = end
            out.append((behind, ids))
            continue
        for start, score in incoming[place]:
            serial += 1
            total = behind + score
            heapq.heappush(queue, (-(forward[start] + total), serial, start, total, (place, cuts)))
    return out


def _within(points: np.ndarray, place: np.ndarray, pieces: Pieces, length: int, rolled: np.ndarray):
    """Ids and scores of the pieces of so many characters that end at each place (-1: none)."""
    ids = np.full(len(points), -1, dtype=np.int32)
    scores = np.full(len(points), -np.inf)
    if length in pieces.tables:
        inside = np.flatnonzero(place >= length)
        keys, key_ids, key_scores = pieces.tables[length]
        wanted = rolled[inside]
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = keys[at] == wanted
        ids[inside[hit]] = key_ids[at[hit]]
        scores[inside[hit]] = key_scores[at[hit]]
    return ids, scores


def best_words(pieces: Pieces, words: list[str]):
    """Of many words the best score, the loss of the second best, and the best ids: counts and all ids.

    The second best path has an edge that is not on the best one, so its score is the best over such
    edges of the way to them, themselves, and the way from them to the end.
    """
    lengths = np.array([len(w) for w in words])
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    place = np.arange(len(points)) - np.repeat(starts, lengths) + 1
    marks = mix(points.astype(np.uint64) + np.uint64(1))
    longest = min(pieces.longest, int(lengths.max()))
    powers = np.cumprod(np.append(np.ones(1, np.uint64), np.full(longest, _BASE)), dtype=np.uint64)
    rolled = marks
    table = []
    for length in range(1, longest + 1):
        if length > 1:
            shifted = np.zeros_like(marks)
            shifted[length - 1 :] = marks[: len(marks) - length + 1]
            rolled = rolled + shifted * powers[length - 1]
        ids, scores = _within(points, place, pieces, length, rolled)
        if length == 1:
            scores[ids < 0] = pieces.spelt
        table.append((ids, scores))
    # Forward: one column per place, word by word; row 0 of a word is its start.
    order = np.argsort(-lengths, kind="stable")
    sorted_lengths = lengths[order]
    first = starts[order]
    widest = int(lengths.max())
    forward = np.full((widest + 1, len(words)), -np.inf)
    forward[0] = 0.0
    last = np.zeros((widest + 1, len(words)), dtype=np.int8)
    active = [int(np.searchsorted(-sorted_lengths, -t, side="right")) for t in range(widest + 1)]
    for t in range(1, widest + 1):
        a = active[t]
        at = first[:a] + t - 1
        best = np.full(a, -np.inf)
        how = np.zeros(a, dtype=np.int8)
        for length in range(min(t, longest), 0, -1):
            total = forward[t - length, :a] + table[length - 1][1][at]
            better = total > best
            best[better] = total[better]
            how[better] = length
        forward[t, :a], last[t, :a] = best, how
    backward = np.full((widest + 1, len(words)), -np.inf)
    column = np.arange(len(words))
    backward[sorted_lengths, column] = 0.0
    for t in range(widest, 0, -1):
        a = active[t]
        at = first[:a] + t - 1
        for length in range(1, min(t, longest) + 1):
            total = backward[t, :a] + table[length - 1][1][at]
            np.maximum(backward[t - length, :a], total, out=backward[t - length, :a])
    # The best path, from the end: on_path marks by how long a piece each place was reached.
    on_path = np.zeros_like(last)
    where = sorted_lengths.copy()
    steps = []
    walking = column
    while len(walking):
        how = last[where[walking], walking]
        on_path[where[walking], walking] = how
        steps.append((walking, where[walking], how))
        where[walking] -= how
        walking = walking[where[walking] > 0]
    best = forward[sorted_lengths, column]
    second = np.full(len(words), -np.inf)
    for t in range(1, widest + 1):
        a = active[t]
        at = first[:a] + t - 1
        for length in range(1, min(t, longest) + 1):
            total = forward[t - length, :a] + table[length - 1][1][at] + backward[t, :a]
            total[on_path[t, :a] == length] = -np.inf
            np.maximum(second[:a], total, out=second[:a])
    ids, owners = [], []
    for walking, t, how in reversed(steps):
        at = first[walking] + t - 1
        found = np.empty(len(walking), dtype=np.int64)
        for length in np.unique(how).tolist():
            own = how == length
            found[own] = table[length - 1][0][at[own]]
        spelt = found < 0
        found[spelt] = -1 - points[at[spelt]].astype(np.int64)
        ids.append(found)
        owners.append(order[walking])
    ids, owners = np.concatenate(ids), np.concatenate(owners)
    by_word = np.argsort(owners, kind="stable")
    ids, owners = ids[by_word], owners[by_word]
    counts = np.bincount(owners, minlength=len(words))
    if (ids < 0).any():
        ids, counts = _spell_out(pieces, ids, owners, counts)
    score, loss = np.empty(len(words)), np.empty(len(words))
    score[order], loss[order] = best, best - second
    return score, loss, counts, ids.astype(np.int32)


def _spell_out(pieces: Pieces, ids: np.ndarray, owners: np.ndarray, counts: np.ndarray):
    """Replace each -1 - code point by the ids of the character's bytes."""
    at = np.flatnonzero(ids < 0)
    chars, which = np.unique(-1 - ids[at], return_inverse=True)
    spelt = [pieces.spell(chr(c)) for c in chars.tolist()]
    lengths = np.ones(len(ids), dtype=np.int64)
    lengths[at] = np.array([len(s) for s in spelt])[which]
    out = np.repeat(ids, lengths)
    first = np.cumsum(lengths) - lengths
    for spot, char in zip(first[at].tolist(), which.tolist(), strict=True):
        out[spot : spot + len(spelt[char])] = spelt[char]
    return out, np.bincount(np.repeat(owners, lengths), minlength=len(counts))


class Encoder:
    """Encodes runs of texts. Words met stay known to it until they are more than _KNOWN_WORDS."""

    def __init__(self, pieces: Pieces, n: int):
        self.pieces, self.n = pieces, n
        self._forget()

    def _forget(self) -> None:
        self.index: dict = {}
        self.words: list = []
        self.nbest: dict = {}
        self.score, self.loss = np.empty(0), np.empty(0)
        self.starts, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)
        self.flat = np.empty(0, np.int32)

    def _alternatives(self, number: int) -> list[tuple[float, list[int]]]:
        found = self.nbest.get(number)
        if found is None:
            found = self.nbest[number] = nbest_word(self.pieces, self.words[number], self.n)
        return found

    def _learn(self, new: list) -> None:
        """Add words to the tables: score, loss of the second best, and where their ids stand."""
        score, loss = np.zeros(len(new)), np.full(len(new), np.inf)
        starts, counts = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
        parts, size = [self.flat], len(self.flat)
        usual = [i for i, w in enumerate(new) if w is not _RAW_SPACE and len(w) <= _LONG_WORD]
        for begin in range(0, len(usual), _WORDS_AT_ONCE):
            own = usual[begin : begin + _WORDS_AT_ONCE]
            score[own], loss[own], n, ids = best_words(self.pieces, [new[i] for i in own])
            starts[own], counts[own] = size + np.cumsum(n) - n, n
            parts.append(ids)
            size += len(ids)
        if len(usual) < len(new):
            for i in np.setdiff1d(np.arange(len(new)), usual).tolist():
                best = [(self.pieces.spelt, self.pieces.spell(SPACE))]
                if new[i] is not _RAW_SPACE:
                    best = nbest_word(self.pieces, new[i], 2)
                score[i], ids = best[0]
                loss[i] = best[0][0] - best[1][0] if len(best) > 1 else np.inf
                starts[i], counts[i] = size, len(ids)
                parts.append(np.array(ids, np.int32))
                size += len(ids)
        self.flat = np.concatenate(parts)
        for name, values in (("score", score), ("loss", loss), ("starts", starts), ("counts", counts)):
            setattr(self, name, np.append(getattr(self, name), values))
        self.words += new

    def encode(self, texts: list[str]):
        """For each text its ids, and its n best (score, changes); changes: (word number, ids) each."""
        if len(self.words) > _KNOWN_WORDS:
            self._forget()
        numbers = []
        index = self.index
        for text in texts:
            words = words_of(text)
            try:
                own = [*map(index.__getitem__, words)]
            except KeyError:
                own = [index.setdefault(word, len(index)) for word in words]
            numbers.append(own)
        if len(index) > len(self.words):
            self._learn([*islice(index, len(self.words), None)])
        out = []
        for own in numbers:
            own = np.array(own, dtype=np.int64)
            if not len(own):
                out.append((np.empty(0, np.int32), [(0.0, [])]))
                continue
            n = self.counts[own]
            ends = np.cumsum(n)
            spots = np.repeat(self.starts[own] - (ends - n), n) + np.arange(ends[-1])
            out.append((self.flat[spots], self._text_nbest(own)))
        return out

    def _text_nbest(self, own: np.ndarray):
        """The n best of a text: only its n - 1 words that lose least can differ from the best."""
        best = float(self.score[own].sum())
        results: list = [(0.0, [])]
        if self.n > 1:
            losses = self.loss[own]
            few = min(self.n - 1, len(own))
            limit = np.partition(losses, few - 1)[few - 1]
            sure = np.flatnonzero(losses < limit)
            spots = np.sort(np.append(sure, np.flatnonzero(losses == limit)[: few - len(sure)]))
            for spot in spots.tolist():
                if not np.isfinite(losses[spot]):
                    continue
                options = self._alternatives(int(own[spot]))
                top = options[0][0]
                results = heapq.nsmallest(
                    self.n,
                    (
                        (lost + top - option, changes + [(spot, ids)] if rank else changes)
                        for lost, changes in results
                        for rank, (option, ids) in enumerate(options)
                    ),
                    key=lambda r: r[0],
                )
        return [(best - lost, changes) for lost, changes in results]


def decode(pieces: Pieces, ids) -> str:
    """The text that was encoded: pieces and bytes joined, without the space put before it."""
    joined = b"".join([pieces.contents[i] for i in ids])
    return joined[1:].decode("utf-8", "surrogatepass") if joined[:1] == b" " else joined.decode("utf-8", "surrogatepass")


_RUN = 500_000
_SCHEMA = (
    "piece_ids array<int>, n_pieces long, scores array<double>, "
    "alternatives array<array<struct<word:int,piece_ids:array<int>>>>"
)
_ADDED = ("piece_ids", "n_pieces", "scores", "alternatives")
_ALTERNATIVES = pa.list_(pa.list_(pa.struct([("word", pa.int32()), ("piece_ids", pa.list_(pa.int32()))])))


def _runs(texts: list[str]):
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if i > begin and size + len(text) > _RUN:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def _encode(path: str, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(load_pieces(path), n)
        for batch in batches:
            texts = [text or "" for text in batch.column("_text").to_pylist()]
            for begin, end in _runs(texts):
                found = encoder.encode(texts[begin:end])
                rest = [batch.column(i).slice(begin, end - begin) for i in range(batch.num_columns - 1)]
                counts = [len(ids) for ids, _ in found]
                offsets = np.cumsum([0, *counts]).astype(np.int32)
                flat = np.concatenate([np.empty(0, np.int32), *(ids for ids, _ in found)])
                others = [
                    [[{"word": w, "piece_ids": list(ids)} for w, ids in changes] for _, changes in best]
                    for _, best in found
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        *rest,
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32())),
                        pa.array(counts, pa.int64()),
                        pa.array([[s for s, _ in best] for _, best in found], pa.list_(pa.float64())),
                        pa.array(others, _ALTERNATIVES),
                    ],
                    names=[*batch.schema.names[:-1], *_ADDED],
                )

    return run


def encode_nbest(documents: DataFrame, n: int = 4, model: str = MODEL) -> DataFrame:
    """documents with the n best segmentations of each whole text.

    piece_ids, n_pieces: the best one. scores: of the n best, best first (fewer where there are
    fewer). alternatives: for each of the n how it differs from the best, as words (numbered from 0
    in the text) with other pieces. Equal scores: the longer last piece is taken for the best one,
    further ties stand in an order that is always the same.

    A NULL or empty text has no pieces and one segmentation of score 0. Columns of these names are
    replaced, all others kept. A character without a piece is spelt in bytes, so any text decodes.
    """
    ship_package(documents.sparkSession)
    kept = [F.col(f"`{c}`") for c in documents.columns if c.lower() not in _ADDED]
    shown = documents.select(*kept, F.col("text").alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in shown.schema.fields[:-1])
    return shown.mapInArrow(sliced(_encode(model, n)), f"{fields}, {_SCHEMA}")


def decode_all(pieces: Pieces, ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """`decode` for many texts at once: ids of all of them, and how many each has."""
    table, starts, lengths = pieces.spellings
    n = lengths[ids]
    ends = np.cumsum(n)
    joined = table[np.repeat(starts[ids] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
    bounds = np.append(0, ends)[np.append(0, np.cumsum(counts))].tolist()
    data = joined.tobytes()
    out = []
    for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
        begin += data[begin : begin + 1] == b" " and begin < end
        out.append(data[begin:end].decode("utf-8", "surrogatepass"))
    return out


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load_pieces(path)
        for batch in batches:
            lists = batch.column("_ids")
            counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            texts = decode_all(pieces, lists.flatten().to_numpy(zero_copy_only=False), counts)
            rest = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(texts, pa.string())], names=[*batch.schema.names[:-1], "decoded"])

    return run


def decode_pieces(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """encoded with the text of piece_ids as `decoded` (empty for NULL or no pieces)."""
    ship_package(encoded.sparkSession)
    kept = [F.col(f"`{c}`") for c in encoded.columns if c.lower() != "decoded"]
    shown = encoded.select(*kept, F.col("piece_ids").alias("_ids"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in shown.schema.fields[:-1])
    return shown.mapInArrow(sliced(_decode(model)), f"{fields}, decoded string")
