"""Language, fingerprints, personal data, mixture, pieces: against brute force and held-out texts."""

import itertools
import random
import re
from fractions import Fraction
from hashlib import md5, sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from repovitals.llm import fuzzy_hash, pii_crf
from repovitals.llm.fuzzy_hash import common_subsequence, fingerprint, fingerprints, likeness
from repovitals.llm.language_id import fit_languages, held_out, identify
from repovitals.llm.mixture import mix_to_weights
from repovitals.llm.piece_nbest import Encoder, best_words, decode, decode_pieces, encode_nbest, load_pieces, nbest_word

from .conftest import DATA

WORDS = {
    "en": "the cat and dog went over this hill with that long road home where they slept".split(),
    "de": "der hund und die katze gingen über diesen hügel nach hause wo sie schliefen".split(),
    "fr": "le chat et le chien sont allés vers cette colline où ils ont dormi très bien".split(),
}


@pytest.fixture(scope="module")
def labelled(texts):
    draw = random.Random(4)
    rows = []
    for i in range(180):
        lang = list(WORDS)[i % 3]
        rows.append((i, " ".join(draw.choices(WORDS[lang], k=draw.randint(8, 40))), lang))
    return texts(rows)


def test_language_on_held_out_texts(labelled, odd, none):
    identifier = fit_languages(labelled.where(~held_out()))
    seen = identify(labelled.where(held_out()), identifier).select("lang", "lang_pred", "accepted", "score").collect()
    assert len(seen) > 30
    assert np.mean([r.lang == r.lang_pred for r in seen]) > 0.95
    assert np.mean([r.accepted for r in seen]) > 0.95
    assert all(0 <= r.score <= 1 for r in seen)
    strange = identify(odd.limit(1).withColumn("text", F.lit("zxqj kvwq xzzk qqjx wvkz jqxk zzqx kkwv jxq")), identifier)
    assert not strange.first().accepted
    by_id = {r.doc_id: r for r in identify(odd, identifier).collect()}
    assert [by_id[i].lang_pred for i in (1, 2, 5)] == ["und"] * 3
    assert by_id[8].lang_pred in WORDS and by_id[6].lang_pred in WORDS
    assert identify(none, identifier).collect() == []
    assert {r.lang_pred for r in identify(odd, fit_languages(none)).collect()} == {"und"}


def test_fingerprints_equal_plain_loop(spark, odd, none):
    for frame in (spark.read.parquet(f"{DATA}/documents.parquet"), odd):
        rows = [(r.doc_id, r.text or "") for r in frame.collect()]
        rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
        want = []
        for i, (doc_id, text) in enumerate(rows):
            following = rows[(i + 1) % len(rows)][1]
            cut = len(text) // 3
            edited = (text[: len(text) - cut] + following[:cut]).encode()
            own, other = fingerprint(text.encode()), fingerprint(edited)
            near = (likeness(own, other), likeness(own, fingerprint(following.encode())))
            want.append((doc_id, len(text), sha256(edited).hexdigest(), own, other, *near))
        got = [tuple(r) for r in fingerprints(frame).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert fingerprints(none).collect() == []


def test_fingerprint_likeness():
    words = [f"word{i * 7919 % 1000}" for i in range(800)]
    text = " ".join(words)
    changed = " ".join([*words[:400], "another", *words[401:]])
    assert likeness(fingerprint(text.encode()), fingerprint(changed.encode())) > 0.9
    assert likeness(fingerprint(text.encode()), fingerprint(text[::-1].encode())) == 0
    assert likeness(fingerprint(b""), fingerprint(b"")) == 1
    assert fuzzy_hash.rolling_hashes(b"xxxxabcdefg")[-1] == fuzzy_hash.rolling_hashes(b"yyabcdefg")[-1]


def test_common_subsequence():
    draw = random.Random(2)
    for _ in range(100):
        a, b = ("".join(draw.choices("abc", k=draw.randint(0, 14))) for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in itertools.product(range(len(a)), range(len(b))):
            table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
        assert common_subsequence(a, b) == table[-1][-1]


def plain_patterns(text):
    digits = lambda found: re.sub("[^0-9]", "", found)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        out += [("ip", *m.span())] if max(map(int, m[0].split("."))) <= 255 else []
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        out += [("card", *m.span())] if 16 <= len(digits(m[0])) <= 19 and pii_crf.luhn(digits(m[0])) else []
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        out += [("phone", *m.span())] if 8 <= len(digits(m[0])) <= 15 else []
    return out


def test_base_patterns():
    draw = random.Random(1)
    for _ in range(5000):
        text = "".join(draw.choices("a@.1 +-2(4", k=draw.randint(0, 40)))
        assert pii_crf.base_spans(text) == plain_patterns(text)


def test_best_segmentation_and_marginals():
    rng = np.random.default_rng(5)
    for _ in range(60):
        spans = sorted({tuple(sorted(rng.choice(9, 2, replace=False).tolist())) for _ in range(7)}, key=lambda s: (s[1], s[0]))
        candidates = [("card", *s, []) for s in spans]
        scores = rng.normal(size=len(spans)).tolist()
        ways = [
            w for n in range(len(spans) + 1) for w in itertools.combinations(range(len(spans)), n)
            if all(spans[a][1] <= spans[b][0] or spans[b][1] <= spans[a][0] for a, b in itertools.combinations(w, 2))
        ]
        total = {w: sum(scores[i] for i in w) for w in ways}
        chosen = tuple(pii_crf.best_segmentation(candidates, scores))
        assert total[chosen] == pytest.approx(max(total.values()))
        probability, log_sum = pii_crf.marginals(candidates, scores)
        assert np.exp(log_sum) == pytest.approx(sum(np.exp(v) for v in total.values()))
        for i in range(len(spans)):
            assert probability[i] == pytest.approx(sum(np.exp(v) for w, v in total.items() if i in w) / np.exp(log_sum))


def test_field_adds_what_patterns_miss(texts, odd, none):
    rows = []
    for i in range(60):
        rows.append((i, f"words before 4111111111111111 and mail bob{i}@host{i}.example.com or 10.0.{i}.1 as well"))
        rows.append((100 + i, f"call +1 (415) 555-{2000 + i} soon, id {i * 37 + 123456789} is no number of anybody"))
    documents = texts(rows)
    weights = pii_crf.fit_field(documents)
    probe = texts([(1, "pay with 4111111111111111 4111111111111111 today"), (2, "on 2021-03-04 12:30 nothing"), (3, "clean words only")])
    found = {r.doc_id: r for r in pii_crf.find_personal_data(probe, weights).collect()}
    assert [tuple(s) for s in found[1].spans] == [("card", 9, 25), ("card", 26, 42)] and found[1].base_spans == []
    assert found[2].spans == [] and found[3].spans == []
    for row in pii_crf.find_personal_data(documents, weights).collect():
        assert sorted(map(tuple, row.base_spans)) == sorted(plain_patterns(row.text))
        assert set(map(tuple, row.base_spans)) <= set(map(tuple, row.spans))
    assert all(r.spans == [] for r in pii_crf.find_personal_data(odd, weights).collect())
    assert pii_crf.find_personal_data(none, pii_crf.fit_field(none)).collect() == []


def share_out(budget, nodes):
    """Exact water-filling: {name: share} of nodes {name: (capacity, weight)}."""
    got, rest = {}, dict(nodes)
    while rest:
        level = Fraction(budget) / sum(w for _, w in rest.values())
        full = {n: c for n, (c, w) in rest.items() if c <= level * w}
        if not full:
            return got | {n: level * w for n, (_, w) in rest.items()}
        got |= full
        budget -= sum(full.values())
        rest = {n: v for n, v in rest.items() if n not in full}
    return got


def test_mixture_budgets(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 9)), "en" if i % 3 else "de", f"s{i % 7 % 4}") for i in range(400)]
    rows += [(1000, "", "en", "s0"), (1001, None, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    weights = {"language": F.when(F.col("language") == "en", 1).otherwise(5), "origin": F.length("origin")}
    levels = {"language": F.col("lang"), "origin": F.col("source")}
    for percent, epochs in ((60, 1), (100, 2), (300, 2)):
        got = mix_to_weights(frame, levels, weights, percent, epochs).collect()
        tokens: dict = {}
        for _, text, lang, source in rows:
            leaf = (lang or "(none)", source or "(none)")
            tokens[leaf] = tokens.get(leaf, 0) + len((text or "").split())
        caps: dict = {}
        for (lang, source), n in tokens.items():
            caps.setdefault(lang, {})[source] = (n * epochs, len(source))
        tops = {lang: (sum(c for c, _ in own.values()), 1 if lang == "en" else 5) for lang, own in caps.items()}
        budget = min(sum(tokens.values()) * percent // 100, sum(c for c, _ in tops.values()))
        for lang, share in share_out(budget, tops).items():
            for source, want in share_out(share, caps[lang]).items():
                own = [r for r in got if (r.language, r.origin) == (lang, source)]
                used = sum(r.n_tokens for r in own)
                assert want - 2 <= used <= want + 10
                if own and max(r.epoch for r in own) < epochs:
                    last = max(r.epoch for r in own)
                    kept = {r.doc_id for r in own if r.epoch == last}
                    order = sorted(
                        (md5(f"42:{last}:{i}".encode()).hexdigest(), i)
                        for i, _, a, b in rows if (a or "(none)", b or "(none)") == (lang, source)
                    )
                    assert kept == {i for _, i in order[: len(kept)]}


def test_mixture_of_odd_rows(odd, none):
    levels, weights = {"origin": F.col("source")}, {"origin": F.lit(1)}
    got = mix_to_weights(odd, levels, weights)
    assert got.count() == odd.count() and "epoch" in got.columns
    assert mix_to_weights(none, levels, weights).collect() == []
    assert mix_to_weights(odd, levels, {"origin": F.lit(None)}).collect() == []


def all_segmentations(pieces, word):
    out = []

    def go(at, score, ids):
        if at == len(word):
            out.append((score, ids))
        for end in range(at + 1, min(len(word), at + pieces.longest) + 1):
            part = word[at:end]
            if part in pieces.ids:
                go(end, score + pieces.scores[part], [*ids, pieces.ids[part]])
            elif end == at + 1:
                go(end, score + pieces.spelt, ids + pieces.spell(part))

    go(0, 0.0, [])
    return sorted(out, key=lambda r: -r[0])


def test_pieces_equal_all_segmentations():
    pieces = load_pieces()
    words = ["▁there", "▁Éçe", "▁ha%%", "▁▁▁in", "x", "▁\U0001f600a", "\n", "▁ouier"]
    score, loss, counts, ids = best_words(pieces, words)
    begin = 0
    for word, s, lost, n in zip(words, score, loss, counts, strict=True):
        want = all_segmentations(pieces, word)
        got = nbest_word(pieces, word, 6)
        assert [g[0] for g in got] == pytest.approx([w[0] for w in want[:6]])
        assert len({tuple(g[1]) for g in got}) == len(got)
        assert s == pytest.approx(want[0][0]) and (ids[begin : begin + n].tolist(), s) == (got[0][1], pytest.approx(got[0][0]))
        assert lost == pytest.approx(want[0][0] - want[1][0] if len(want) > 1 else np.inf)
        begin += n
    text = "on in re"
    chains = itertools.product(*(all_segmentations(pieces, w) for w in ("▁on", "▁in", "▁re")))
    want = sorted((sum(p[0] for p in chain) for chain in chains), reverse=True)[:4]
    assert [s for s, _ in Encoder(pieces, 4).encode([text])[0][1]] == pytest.approx(want)


def test_pieces_round_trip(spark, odd, none):
    for frame in (spark.read.parquet(f"{DATA}/documents.parquet"), odd):
        decoded = decode_pieces(encode_nbest(frame, 3))
        assert decoded.where(F.col("decoded") != F.coalesce("text", F.lit(""))).count() == 0
        for row in decoded.collect():
            assert row.n_pieces == len(row.piece_ids) and row.scores == sorted(row.scores, reverse=True)
            assert row.alternatives[0] == [] and 1 <= len(row.scores) <= 3
    assert encode_nbest(none).collect() == []
    assert decode(load_pieces(), []) == ""
