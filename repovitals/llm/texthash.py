"""Hashes of words and word shingles of whole texts, computed on arrays of bytes.

Words are runs of bytes other than ASCII white space, with A-Z lower-cased. A 64-bit hash stands for
a word or a shingle; equality is only ever asked within a pair of documents, or is followed by an
exact check, so two unequal shingles count as one with a chance of about 2**-64 per pair of them.
"""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Each byte value gets a number of its own: the mixed value of its successor.
_CHUNK = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.empty(max(n, 1), dtype=np.uint64)
    out[0] = 1
    if n > 1:
        out[1:] = base
        np.multiply.accumulate(out, out=out)
    return out


#: Powers of the base and of its inverse modulo 2**64, for the places of a run of texts; longer texts make their own.
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_UP, _DOWN = _powers(_BASE, 2 * _CHUNK), _powers(_INVERSE, 2 * _CHUNK)


def _chunks(texts: list[bytes]):
    """Runs of texts of about 64 kB together, whose arrays stay in a core's cache; a longer text is a run of its own."""
    run: list[bytes] = []
    size = 0
    for text in texts:
        if run and size + len(text) > _CHUNK:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text) + 1
    if run:
        yield run


def _run_words(run: list[bytes]) -> tuple[np.ndarray, list[int]]:
    """The hashes of all words of these texts in order, and for each text where its words end."""
    joined = np.frombuffer(b"\n".join(run), dtype=np.uint8)
    space = np.ones(len(joined) + 2, dtype=bool)
    space[1:-1] = _SPACE[joined]
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[::2], edges[1::2]
    if len(starts):
        short = len(joined) <= len(_UP)
        up = _UP[: len(joined)] if short else _powers(_BASE, len(joined))
        down = _DOWN if short else _powers(_INVERSE, len(joined))
        # A word's letters times powers by place, from a sum over all places; then the power of its start goes.
        sums = np.zeros(len(joined) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[joined] * up, out=sums[1:])
        words = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    else:
        words = np.empty(0, dtype=np.uint64)
    text_ends = np.cumsum([len(text) + 1 for text in run])
    return words, np.searchsorted(starts, text_ends).tolist()


def word_hashes(texts: list[bytes]):
    """Yield for each text the hashes of its words in order."""
    for run in _chunks(texts):
        words, bounds = _run_words(run)
        begin = 0
        for end in bounds:
            yield words[begin:end]
            begin = end


def _rolled(words: np.ndarray, width: int) -> np.ndarray:
    rolled = words[: len(words) - width + 1].copy()
    for i in range(1, width):
        rolled *= _BASE
        rolled += words[i : len(words) - width + 1 + i]
    rolled += np.uint64(width)
    return mix(rolled)


def shingle_runs(texts: list[bytes], k: int):
    """Yield for each text the hashes of all its runs of k words, in order; of all words together if they are fewer."""
    for run in _chunks(texts):
        words, bounds = _run_words(run)
        rolled = _rolled(words, k) if len(words) >= k else words[:0]
        begin = 0
        for end in bounds:
            n = end - begin
            yield rolled[begin : end - k + 1] if n >= k else _rolled(words[begin:end], n) if n else words[:0]
            begin = end


def distinct(runs: np.ndarray) -> np.ndarray:
    """Sorted, each once."""
    if len(runs) < 2:
        return runs
    runs = np.sort(runs)
    return runs[np.concatenate(([True], runs[1:] != runs[:-1]))]


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """The sorted distinct hashes of all runs of k words; of all words together if they are fewer."""
    return distinct(_rolled(words, min(k, len(words)))) if len(words) else words
