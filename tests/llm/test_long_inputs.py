"""Long texts and deep pages in time that grows with their length."""

import time

import pytest

from repovitals.llm.html_paths import path_votes, read_blocks, text_at
from repovitals.llm.pii_crf import added_spans, base_spans, best_segmentation, train, zones_of

WEIGHTS = {"phone:": 3.0, "phone:plus=False": 0.5, "card:": -1.0, "ip:": 1.0, "phone:groups=3": 1.0}


@pytest.mark.parametrize(
    ("piece", "n"),
    [("123 4567 ", 40_000), ("+1 (555) 123-4567, ", 20_000), ("7", 400_000), ("1.2.3.4.5 ", 40_000), ("a@b.co ", 50_000), ("5 ", 150_000)],
)
def test_long_texts(piece, n):
    def took(text):
        began = time.process_time()
        base = base_spans(text)
        added = added_spans(text, base, WEIGHTS)
        return time.process_time() - began, base, added

    short, _, _ = took(piece * (n // 4))
    long, base, added = took(piece * n)
    assert long < 8 * short + 1, (short, long)  # quadratic time would be sixteen times as much
    places = sorted((s, e) for _, s, e in added)
    assert all(a[1] <= b[0] for a, b in zip(places, places[1:]))


def plain_best(candidates, scores):
    """All choices of candidates that do not overlap."""
    best = (0.0, [])
    for choice in range(1 << len(candidates)):
        own = [i for i in range(len(candidates)) if choice >> i & 1]
        spans = sorted(candidates[i][1:3] for i in own)
        if all(a[1] <= b[0] for a, b in zip(spans, spans[1:])):
            best = max(best, (sum(scores[i] for i in own), own), key=lambda x: x[0])
    return best[0]


def test_segmentation_equals_all_choices():
    text = "call 555 123 4567 or 10.1.2.3 and 4111 1111 1111 1111 now"
    for zone in zones_of(text):
        candidates = zone.candidates[:12]
        scores = [((i * 7919) % 13 - 5) / 3 for i in range(len(candidates))]
        got = best_segmentation(candidates, scores)
        assert sum(scores[i] for i in got) == pytest.approx(plain_best(candidates, scores))


def test_spans_beside_base_spans_only():
    text = "+1 555 123 4567 555 123 4567 555-123-4567 x 1.2.3.4 555 123 9999"
    base = base_spans(text)
    added = added_spans(text, base, WEIGHTS)
    assert added and all(e <= s or t <= b for _, b, e in base for _, s, t in added)
    assert train([]) == {}


@pytest.mark.parametrize(
    "html",
    [
        "<div>" * 50_000 + "<p>Some text that is there</p>",
        "<div class='a'>word " * 50_000 + "</div>" * 50_000,
        "<body>" + "<div class=x{}><p>Some text</p></div>" * 50_000,
        "".join(f"<div class='c{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}'><p>Some text {i}</p>" for i in range(20_000)),
        "<div class=sidebar>" * 20_000 + "text" + "</section>" * 20_000,
        "<main>" + "<div class='ad'>x<span class=ad>y</div>" * 30_000 + "<h1>Title</h1><p>text</p>",
    ],
)
def test_deep_and_wide_pages(html):
    began = time.process_time()
    page = read_blocks(html)
    votes = path_votes(page)
    text = text_at(page, page.key[max(votes, key=votes.get)] if votes else None)
    assert text and time.process_time() - began < 4
