"""Character models against a plain Kneser-Ney over dicts, many scripts, and rejection despite wrong labels."""

import random
from collections import Counter, defaultdict
from math import log2

import numpy as np
import pytest
from pyspark.sql import functions as F

from repovitals.llm import language_id
from repovitals.llm.language_id import ORDER, Symbols, _codes, fit_languages, held_out, identify, kneser_ney

ALPHABETS = {
    "many": [chr(c) for c in range(0x4E00, 0x4E00 + 400)],
    "ka": [chr(c) for c in range(0x10D0, 0x10F0)],
    "hy": [chr(c) for c in range(0x561, 0x580)],
}


def words(draw, alphabet, n):
    return " ".join("".join(draw.choices(alphabet, k=draw.randint(2, 7))) for _ in range(n))


def plain_sequence(text):
    """Lower-cased letters, each run of other characters as one blank, one blank at the end."""
    out = []
    for char in text:
        letter = char.lower()[0] if char.isalpha() else " "
        if letter != " " or (out and out[-1] != " "):
            out.append(letter)
    return out if out and out[-1] == " " else [*out, " "]


def plain_grams(text):
    padded = [" "] * (ORDER - 1) + plain_sequence(text)
    return [tuple(padded[i : i + ORDER]) for i in range(len(padded) - ORDER + 1)]


class PlainKneserNey:
    def __init__(self, texts, symbols):
        self.symbols = symbols
        self.counts = {ORDER: Counter(g for t in texts for g in plain_grams(t))}
        for n in range(ORDER - 1, 0, -1):
            self.counts[n] = Counter(g[1:] for g in self.counts[n + 1])
        self.discount, self.total, self.kinds = {}, {}, {}
        for n, counts in self.counts.items():
            of = Counter(counts.values())
            self.discount[n] = of[1] / (of[1] + 2 * of[2]) if of[1] and of[2] else 0.5
            self.total[n], self.kinds[n] = defaultdict(int), defaultdict(int)
            for gram, count in counts.items():
                self.total[n][gram[:-1]] += count
                self.kinds[n][gram[:-1]] += 1

    def p(self, gram):
        n = len(gram)
        below = self.p(gram[1:]) if n > 1 else 1 / self.symbols
        total = self.total[n].get(gram[:-1], 0)
        if not total:
            return below
        d = self.discount[n]
        return max(self.counts[n][gram] - d, 0) / total + d * self.kinds[n][gram[:-1]] / total * below

    def bits(self, text):
        grams = plain_grams(text)
        return -sum(log2(self.p(g)) for g in grams) / len(grams)


def test_kneser_ney_sums_to_one():
    rng = np.random.default_rng(0)
    symbols = rng.integers(0, 5, 400).astype(np.uint64)
    codes, counts = np.unique(_codes(symbols, np.array([400]), ORDER), return_counts=True)
    model = kneser_ney(codes, counts, ORDER, 7)
    for context in (codes[3] >> np.uint64(16), np.uint64(0x000600060006)):
        following = (context << np.uint64(16)) | np.arange(7, dtype=np.uint64)
        assert np.exp2(model.log2(following)).sum() == pytest.approx(1, abs=1e-9)


def test_codes_stop_at_the_ends_of_texts():
    texts = ["Ab, c", "", "x", " \n", "Öl 9 läuft", "ab"]
    known = np.array(sorted({ord(c) for t in texts for c in plain_sequence(t)} - {32}), dtype=np.uint32)
    symbols, ends = Symbols(known).of(texts)
    number = {" ": 0} | {chr(c): 2 + i for i, c in enumerate(known.tolist())}
    want = [sum(number[c] << 16 * (ORDER - 1 - i) for i, c in enumerate(g)) for t in texts for g in plain_grams(t)]
    assert _codes(symbols, ends, ORDER).tolist() == want


def test_bits_equal_a_plain_kneser_ney(spark, texts):
    draw = random.Random(7)
    vocabulary = {lang: words(draw, letters, 60).split() for lang, letters in ALPHABETS.items()}
    vocabulary["la"] = words(draw, list("abcdefghijklmnopqrstuvwxyzäöü"), 60).split()
    rows = [
        (i, ", ".join(draw.choices(vocabulary[lang], k=draw.randint(3, 25))), lang)
        for i, lang in enumerate(list(vocabulary) * 30)
    ]
    labelled = texts(rows)
    fitted = language_id._labelled_sample(labelled).where("not calibrate").collect()
    assert len(fitted) == 96
    letters = {c for r in fitted for c in plain_sequence(r.text)} - {" "}
    models = {
        lang: PlainKneserNey([r.text for r in fitted if r.lang == lang], len(letters) + 2) for lang in vocabulary
    }
    known_text = [r for r in rows if set(plain_sequence(r[1])) <= letters | {" "}]
    got = {r.doc_id: r for r in identify(labelled, fit_languages(labelled)).collect()}
    assert len(known_text) > 100
    for doc_id, text, lang in known_text:
        bits = {name: model.bits(text) for name, model in models.items()}
        assert got[doc_id].bits_per_char == pytest.approx(min(bits.values()), abs=1e-9)
        assert got[doc_id].lang_pred == min(bits, key=bits.get) == lang


def test_small_scripts_beside_a_large_one(texts):
    """No letter of the small scripts is among the 200 most frequent."""
    draw = random.Random(1)
    rows = []
    for i in range(450):
        lang = list(ALPHABETS)[i % 3]
        rows.append((i, words(draw, ALPHABETS[lang], 400 if lang == "many" else 12), lang))
    labelled = texts(rows)
    seen = identify(labelled.where(held_out()), fit_languages(labelled.where(~held_out())))
    assert seen.where("lang <> lang_pred").count() == 0
    assert seen.count() > 100


def test_a_wrong_label_does_not_stop_rejection(texts):
    draw = random.Random(2)
    vocabulary = words(draw, ALPHABETS["ka"], 50).split()
    rows = [(i, " ".join(draw.choices(vocabulary, k=20)), "ka") for i in range(600)]
    rows += [(1_000 + i, words(draw, list("abcdefgh"), 30), "ka") for i in range(6)]
    identifier = fit_languages(texts(rows))
    strange = texts([(1, words(draw, list("qrstuvwxyz"), 30)), (2, " ".join(draw.choices(vocabulary, k=20)))])
    assert {r.doc_id: r.accepted for r in identify(strange, identifier).collect()} == {1: False, 2: True}


def test_sample_keeps_within_its_bounds(texts, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE_CHARACTERS", 1_000)
    monkeypatch.setattr(language_id, "SAMPLE_TEXTS", 30)
    rows = [(i, "ab " * 10, "en") for i in range(200)] + [(i, "c" * 90, "de") for i in range(200, 400)]
    rows += [(500, "d" * 1_001, "fr"), *[(501, "e" * 10, "es")] * 101, (502, "f", "es"), (502, "f", "es")]
    sample = language_id._labelled_sample(texts(rows))
    got = {r.lang: (r.n, r.size) for r in sample.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("size")).collect()}
    assert got == {"en": (30, 900), "de": (11, 990), "es": (2, 2)}


def test_documents_without_id_are_not_held_out(odd):
    assert odd.where(held_out().isNull()).count() == 0
    assert odd.where("doc_id is null").select(held_out().alias("h")).first().h is False
