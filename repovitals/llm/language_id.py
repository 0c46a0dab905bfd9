"""Language identification by character language models with interpolated Kneser-Ney smoothing.

Each language's model is an n-gram table in sorted hash arrays. A text gets the language under which
its cross-entropy per character is least. It is rejected when even that entropy is above what texts
of the language have, judged on labelled texts that the models have not seen.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .batches import sliced
from .storage import ship_package
from .texthash import mix

UNDETERMINED = "und"
ORDER = 4
#: Bounds of the labelled rows that are fitted on: ids of one language, and characters of their texts
#: together. They bound the models, not what is predicted on.
SAMPLE_TEXTS = 2_000
SAMPLE_CHARACTERS = 32_000_000
#: One labelled text in so many is kept from the models and calibrates rejection and score.
CALIBRATION_SHARE = 5
#: Allowance for short texts, in standard errors of their entropy, and beyond, in bits a character.
STANDARD_ERRORS = 3.0
SLACK_BITS = 1.0
#: Share of a language's calibration texts that must fit; the rest may be mislabelled.
FITTING_SHARE = 0.95
_OTHER, _FIRST = 1, 2
_CHUNK = 1 << 19
_CACHED = 1 << 18
#: A symbol has 16 bits, so all letters of a sample have one of their own unless it has over 65,534.
_BITS = np.uint64(16)
_LETTERS = (1 << 16) - _FIRST


def _mask(order: int) -> np.uint64:
    """The bits of the last `order` symbols of a code."""
    return np.uint64((1 << int(_BITS) * order) - 1)


@cache
def _letters() -> np.ndarray:
    """For each code point its lower-cased first letter, or 0 where there is no letter."""
    out = np.zeros(0x110000, dtype=np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            out[code] = ord(char.lower()[0])
    return out


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


class Symbols:
    """Code points as numbers of 16 bits: blank (all but letters), another letter, the known letters."""

    def __init__(self, known: np.ndarray):
        self.known = known
        letters = _letters()
        number = np.full(len(letters), _OTHER, dtype=np.uint16)
        number[known] = np.arange(_FIRST, _FIRST + len(known))
        self.table = np.where(letters > 0, number[letters], 0).astype(np.uint16)

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all texts, runs of blanks as one and one more at each end, and where each text ends."""
        points = _points("\n".join(texts) + "\n")
        ends = np.cumsum([len(t) + 1 for t in texts])
        found = self.table[points]
        keep = np.ones(len(found), dtype=bool)
        keep[1:] = (found[1:] > 0) | (found[:-1] > 0)
        if len(ends) > 1:  # a text's last blank is also the blank before the next
            keep[ends[:-1]] = found[ends[:-1]] > 0
        keep[ends - 1] = True
        kept = np.cumsum(keep)
        return found[keep], kept[ends - 1]


def _codes(symbols: np.ndarray, ends: np.ndarray, order: int) -> np.ndarray:
    """For each symbol the code of the n-gram that ends there, blanks standing before each text's first."""
    lengths = np.diff(ends, prepend=0)
    place = np.arange(len(symbols)) - np.repeat(ends - lengths, lengths)
    padded = np.concatenate((np.zeros(order - 1, dtype=np.uint64), symbols.astype(np.uint64)))
    out = np.zeros(len(symbols), dtype=np.uint64)
    for i in range(order):
        inside = place >= order - 1 - i
        out = (out << _BITS) | np.where(inside, padded[i : i + len(symbols)], np.uint64(0))
    return out


@dataclass
class Model:
    """Sorted hashes of n-grams of every order with log2 probabilities, and of contexts with weights."""

    hashes: list[np.ndarray]
    logs: list[np.ndarray]
    contexts: list[np.ndarray]
    weights: list[np.ndarray]
    floor: float

    @staticmethod
    def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
        return at, keys[at] == wanted if len(keys) else np.zeros(len(wanted), dtype=bool)

    def log2(self, codes: np.ndarray) -> np.ndarray:
        """log2 P(last symbol | those before it) for codes of the highest order."""
        out = np.zeros(len(codes))
        open_ = np.arange(len(codes))
        for order in range(len(self.hashes), 0, -1):
            own = codes[open_] & _mask(order)
            at, found = self._find(self.hashes[order - 1], mix(own))
            out[open_[found]] += self.logs[order - 1][at[found]]
            open_, own = open_[~found], own[~found]
            if not len(open_):
                return out
            if order > 1:
                at, found = self._find(self.contexts[order - 1], mix(own >> _BITS))
                out[open_[found]] += self.weights[order - 1][at[found]]
        out[open_] += self.floor
        return out


def kneser_ney(codes: np.ndarray, counts: np.ndarray, order: int, symbols: int) -> Model:
    """The interpolated model of the given n-gram counts. codes: distinct, of the highest order.

    Below the highest order an n-gram counts once for each symbol seen before it. The discount of an
    order is n1 / (n1 + 2 n2) of its counts of counts. A symbol never seen shares what the lowest
    order discounts, spread evenly over all symbols.
    """
    hashes: list = [None] * order
    logs: list = [None] * order
    contexts: list = [None] * order
    weights: list = [None] * order
    levels = []
    for n in range(order, 0, -1):
        levels.append((n, codes, counts))
        shorter = codes & _mask(n - 1)
        codes, counts = np.unique(shorter, return_counts=True)
    lower_codes, lower = np.zeros(1, dtype=np.uint64), np.array([1.0 / symbols])
    floor = 0.0
    for n, codes, counts in reversed(levels):
        ones, twos = np.count_nonzero(counts == 1), np.count_nonzero(counts == 2)
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        context, which = np.unique(codes >> _BITS, return_inverse=True)
        total = np.bincount(which, weights=counts)
        weight = discount * np.bincount(which) / total
        below = lower[np.searchsorted(lower_codes, codes & _mask(n - 1))] if n > 1 else lower[0]
        p = (counts - discount) / total[which] + weight[which] * below
        if n == 1:
            floor = float(np.log2(weight[0] / symbols))
        for keys, values, key_list, value_list in (
            (codes, p, hashes, logs),
            (context, weight, contexts, weights),
        ):
            hashed = mix(keys)
            by_hash = np.argsort(hashed)
            key_list[n - 1], value_list[n - 1] = hashed[by_hash], np.log2(values)[by_hash]
        lower_codes, lower = codes, p
    return Model(hashes, logs, contexts, weights, floor)


@dataclass
class Identifier:
    """Models of all languages, and what calibration has found."""

    languages: list[str]
    known: np.ndarray
    models: list[Model]
    limits: np.ndarray
    sharpness: float = 8.0

    def __post_init__(self):
        self._symbols = None

    def __getstate__(self):
        return self.__dict__ | {"_symbols": None}

    def _ready(self) -> None:
        if self._symbols is None:
            self._symbols = Symbols(self.known)
            self._cached = np.empty(0, dtype=np.uint64)
            self._logs = np.empty((0, len(self.models)))

    def _lookup(self, codes: np.ndarray) -> np.ndarray:
        """Which row of the cache each code has; new codes are scored and join the cache."""
        at = np.searchsorted(self._cached, codes)
        known = np.zeros(len(codes), dtype=bool)
        inside = at < len(self._cached)
        known[inside] = self._cached[at[inside]] == codes[inside]
        if not known.all():
            new = np.unique(codes[~known])
            logs = np.stack([model.log2(new) for model in self.models], axis=1)
            if len(self._cached) + len(new) > _CACHED:
                new = np.unique(codes)
                logs = np.stack([model.log2(new) for model in self.models], axis=1)
                self._cached, self._logs = new, logs
            else:
                places = np.searchsorted(self._cached, new)
                self._cached = np.insert(self._cached, places, new)
                self._logs = np.insert(self._logs, places, logs, axis=0)
            at = np.searchsorted(self._cached, codes)
        return at

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per text and language the bits a character and their standard error; lengths; has letters."""
        self._ready()
        bits = np.zeros((len(texts), len(self.models)))
        error = np.zeros_like(bits)
        length = np.zeros(len(texts), dtype=np.int64)
        letters = np.zeros(len(texts), dtype=bool)
        begin = 0
        while begin < len(texts):
            size, end = len(texts[begin]), begin + 1
            while end < len(texts) and size + len(texts[end]) < _CHUNK:
                size, end = size + len(texts[end]), end + 1
            symbols, ends = self._symbols.of(texts[begin:end])
            starts = np.concatenate(([0], ends[:-1]))
            at = self._lookup(_codes(symbols, ends, ORDER))
            n = ends - starts
            length[begin:end] = n
            letters[begin:end] = np.maximum.reduceat(symbols, starts) > 0
            for j in range(len(self.models)):
                scores = self._logs[:, j][at]
                mean = np.add.reduceat(scores, starts) / n
                square = np.add.reduceat(scores * scores, starts) / n
                bits[begin:end, j] = -mean
                error[begin:end, j] = np.sqrt(np.maximum(square - mean * mean, 0) / n)
            begin = end
        return bits, error, length, letters

    def predict(self, texts: list[str]):
        """(language, score from 0 to 1, accepted, bits a character) of each text."""
        if not self.models:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts), [False] * len(texts), [None] * len(texts)
        bits, error, _, letters = self.entropies(texts)
        best = bits.argmin(axis=1)
        rows = np.arange(len(texts))
        share = np.exp2(-self.sharpness * (bits - bits.min(axis=1, keepdims=True)))
        score = np.where(letters, 1 / share.sum(axis=1), 0.0)
        least = bits[rows, best] - STANDARD_ERRORS * error[rows, best]
        accepted = letters & (least <= self.limits[best])
        names = [self.languages[b] if ok else UNDETERMINED for b, ok in zip(best, letters, strict=True)]
        return names, score.tolist(), accepted.tolist(), bits[rows, best].tolist()


def _count_letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, int] = {}
    for batch in batches:
        for text in batch.column("text").to_pylist():
            found, counts = np.unique(_letters()[_points(text)], return_counts=True)
            for letter, count in zip(found.tolist(), counts.tolist(), strict=True):
                total[letter] = total.get(letter, 0) + count
    total.pop(0, None)
    yield pa.RecordBatch.from_pydict(
        {"letter": pa.array(total.keys(), pa.int64()), "n": pa.array(total.values(), pa.int64())}
    )


def _count_ngrams(known: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = Symbols(known)
        for batch in batches:
            languages = np.array(batch.column("lang").to_pylist())
            texts = batch.column("text").to_pylist()
            for language in np.unique(languages).tolist():
                own = [texts[i] for i in np.flatnonzero(languages == language)]
                codes, counts = np.unique(_codes(*symbols.of(own), ORDER), return_counts=True)
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([language] * len(codes), pa.string()),
                        "code": pa.array(codes.view(np.int64)),
                        "n": pa.array(counts, pa.int64()),
                    }
                )

    return run


def _calibration(identifier: Identifier):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, error, _, letters = identifier.entropies(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": batch.column("lang"),
                    "bits": pa.array(bits.tolist(), pa.list_(pa.float64())),
                    "error": pa.array(error.tolist(), pa.list_(pa.float64())),
                }
            ).filter(pa.array(letters))

    return run


def _labelled_sample(labelled: DataFrame) -> DataFrame:
    """Rows (text, lang, calibrate): per language the ids that hash least, within both bounds.

    An id's rows are taken together. An id with more characters than the bound is not learnt from.
    """
    usable = F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
    labelled = labelled.where(usable)
    ids = (
        labelled.groupBy("doc_id", "lang")
        .agg(F.sum(F.length("text")).alias("size"))
        .where(F.col("size") <= SAMPLE_CHARACTERS)
    )
    # Ids are thinned by their hash to about half as many again as wanted before they are put in order.
    counts = ids.groupBy("lang").agg(F.count("*").alias("n"))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) / float(1 << 32)
    order = Window.partitionBy("lang").orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)), "doc_id")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chosen = (
        ids.join(counts, "lang")
        .where((part * F.col("n") < 1.5 * SAMPLE_TEXTS) | (F.col("n") <= SAMPLE_TEXTS))
        .select("doc_id", "lang", F.row_number().over(order).alias("place"), F.sum("size").over(so_far).alias("sizes"))
        .where((F.col("place") <= SAMPLE_TEXTS) & (F.col("sizes") <= SAMPLE_CHARACTERS))
        .select("doc_id", "lang", (F.col("place") % CALIBRATION_SHARE == 0).alias("calibrate"))
    )
    # At most SAMPLE_TEXTS ids of a language, so small enough to send to every task.
    return labelled.join(F.broadcast(chosen), ["doc_id", "lang"]).select("text", "lang", "calibrate")


def _fit_model(symbols: int):
    def run(counts: pd.DataFrame) -> pd.DataFrame:
        counts = counts.assign(code=counts["code"].to_numpy().view(np.uint64)).sort_values("code")
        model = kneser_ney(counts["code"].to_numpy(), counts["n"].to_numpy(), ORDER, symbols)
        return pd.DataFrame({"lang": [counts["lang"].iloc[0]], "model": [pickle.dumps(model)]})

    return run


def fit_languages(labelled: DataFrame) -> Identifier:
    """Models of the languages in labelled (doc_id, text, lang), from a bounded sample of its rows.

    What reaches the driver is a model a language, made from at most SAMPLE_CHARACTERS characters of
    SAMPLE_TEXTS ids, the letters of the sample, and a row for each calibration text.
    """
    ship_package(labelled.sparkSession)
    sample = _labelled_sample(labelled).cache()
    fit = sample.where("not calibrate").select("text", "lang")
    letters = (
        fit.mapInArrow(sliced(_count_letters), "letter long, n long")
        .groupBy("letter")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "letter")
        .limit(_LETTERS)
        .collect()
    )
    known = np.array([row.letter for row in letters], dtype=np.uint32)
    rows = (
        fit.mapInArrow(sliced(_count_ngrams(known)), "lang string, code long, n long")
        .groupBy("lang", "code")
        .agg(F.sum("n").alias("n"))
        .groupBy("lang")
        .applyInPandas(_fit_model(len(known) + _FIRST), "lang string, model binary")
        .collect()
    )
    rows.sort(key=lambda row: row.lang)
    models = [pickle.loads(row.model) for row in rows]
    identifier = Identifier([row.lang for row in rows], known, models, np.full(len(models), np.inf))
    if models:
        _calibrate(identifier, sample.where("calibrate").select("text", "lang"))
    sample.unpersist()
    return identifier


def _calibrate(identifier: Identifier, texts: DataFrame) -> None:
    """Set each language's limit and the sharpness of the score from texts the models have not seen."""
    rows = texts.mapInArrow(
        sliced(_calibration(identifier)), "lang string, bits array<double>, error array<double>"
    ).collect()
    if not rows:
        return
    bits = np.array([row.bits for row in rows])
    least = bits - STANDARD_ERRORS * np.array([row.error for row in rows])
    truth = np.array([identifier.languages.index(row.lang) if row.lang in identifier.languages else -1 for row in rows])
    for j in range(len(identifier.models)):
        own = least[truth == j, j]
        if len(own):
            identifier.limits[j] = np.quantile(own, FITTING_SHARE, method="lower") + SLACK_BITS
    known = truth >= 0
    bits, truth = bits[known], truth[known]
    losses = {}
    for sharpness in (1.0, 2.0, 4.0, 8.0, 16.0, 32.0):
        share = np.exp2(-sharpness * (bits - bits.min(axis=1, keepdims=True)))
        own = share[np.arange(len(truth)), truth] / share.sum(axis=1)
        losses[sharpness] = -np.log(np.maximum(own, 1e-12)).mean()
    identifier.sharpness = min(losses, key=losses.get)


def _predict(identifier):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = identifier.value
        for batch in batches:
            texts = [text or "" for text in batch.column("_text").to_pylist()]
            names, score, accepted, bits = model.predict(texts)
            rest = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(accepted, pa.bool_()), pa.array(bits, pa.float64())],
                names=[*batch.schema.names[:-1], *_ADDED],
            )

    return run


_ADDED = ("lang_pred", "score", "accepted", "bits_per_char")


def identify(documents: DataFrame, identifier: Identifier, keep: list[Column] | None = None) -> DataFrame:
    """The columns `keep` of documents (default: all) with the language of each whole text.

    Added (or replaced): lang_pred, a learned language, or 'und' where the text is NULL or has no
    letter; score from 0 to 1 (0 for 'und'); accepted, false for 'und' and where even the best model
    fits worse than it fits texts of its language; bits_per_char under the best model. Ties go to the
    language that sorts first. Without any labelled text every document is 'und'.
    """
    spark = documents.sparkSession
    ship_package(spark)
    if keep is None:
        keep = [F.col(f"`{c}`") for c in documents.columns if c.lower() not in _ADDED]
    shown = documents.select(*keep, F.col("text").alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in shown.schema.fields[:-1])
    return shown.mapInArrow(
        sliced(_predict(spark.sparkContext.broadcast(identifier))),
        f"{fields}, lang_pred string, score double, accepted boolean, bits_per_char double",
    )


def held_out() -> Column:
    """Documents kept from fitting: a third, by a checksum of the id. One without id is not (nor fitted on)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
