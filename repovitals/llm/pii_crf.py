"""Personal data: fixed patterns, and a semi-Markov conditional random field for what they miss.

The field scores whole candidate spans (a type, its digits, groups, separators, checksum, what stands
around it) and chooses boundaries and types of all spans of a zone at once by dynamic programming over
the candidates; an entity has a bounded number of groups. Its weights are trained on zones of a bounded
sample of texts, in which the patterns' own finds, and finds written in other ways, are the truth.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import sliced
from .storage import ship_package

KINDS = ("email", "ip", "card", "phone")
#: Bounds of the training sample: texts, and zones of them.
SAMPLE_TEXTS = 3_000
SAMPLE_ZONES = 6_000
#: A zone of more candidates, such as a table of numbers, is searched but not learnt from.
ZONE_CANDIDATES = 400
#: Bounds of an entity: groups of digits, and digits.
MOST_GROUPS = 8
MOST_DIGITS, FEWEST_DIGITS = 19, 7
#: A span is added if its best segmentation beats the one without it by this much (log odds).
MARGIN = 2.0
_EPOCHS, _RATE, _DECAY = 12, 0.2, 1e-4

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Behind a digit no search need begin: it would find what began with the run of digits, or nothing.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT_ZONE = re.compile(r"\+?\(?[0-9]+(?:[\x20().\-/]{1,3}[0-9]+)*")
_GROUP = re.compile(r"[0-9]+")
_MAIL_ZONE = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}(?:\x20?[\[(]\x20?at\x20?[\])]\x20?|\x20at\x20|\x20@\x20?|@\x20)"
    r"[A-Za-z0-9-]{1,63}(?:(?:\x20?[\[(]\x20?dot\x20?[\])]\x20?|\x20dot\x20|\.)[A-Za-z0-9-]{1,63}){1,5}",
    re.IGNORECASE | re.ASCII,
)
_DOTTED_ZONE = re.compile(
    r"(?<![0-9])[0-9]{1,3}(?:(?:\x20?[\[(]\x20?(?:dot|\.)\x20?[\])]\x20?|\x20dot\x20|\x20\.\x20)[0-9]{1,3}){3}(?![0-9])",
    re.IGNORECASE,
)

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, char in enumerate(reversed(digits)):
        value = ord(char) - 48
        total += value if i % 2 == 0 else (2 * value - 9 if value > 4 else 2 * value)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_GROUP.findall(text))


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns, by kind and place."""
    found: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            done = match.end()
            found.append(("email", start, done))
        else:
            done = at + 1
        at = text.find("@", done)
    if not _GROUP.search(text):
        return found
    for match in _IP.finditer(text):
        parts = [part.lstrip("0") or "0" for part in match[0].split(".")]
        if all(len(part) <= 3 and int(part) <= 255 for part in parts):
            found.append(("ip", *match.span()))
    for match in _CARD.finditer(text):
        digits = _digits(match[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *match.span()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 8 <= len(_digits(match[0])) <= 15:
                found.append(("phone", *match.span()))
    return found


@dataclass
class Zone:
    """A stretch of a text in which spans may lie, and its candidates (type, start, end, features)."""

    start: int
    end: int
    candidates: list[tuple[str, int, int, list[str]]] = field(default_factory=list)


def _around(text: str, start: int, end: int) -> list[str]:
    def kind(char: str) -> str:
        return "none" if not char else "letter" if char.isalpha() else "digit" if char.isdigit() else "space" if char.isspace() else "quote" if char in "\"'=" else "mark"

    before = text[max(0, start - 24) : start]
    words = re.findall(r"[a-z]+", before.lower())
    word = words[-1] if words else ""
    cue = next((c for c in ("phone", "tel", "call", "fax", "card", "visa", "ip", "mail", "token", "key", "id", "isbn") if c in word), "none")
    return [f"before={kind(text[start - 1 : start])}", f"after={kind(text[end : end + 1])}", f"cue={cue}"]


def _digit_candidates(text: str, start: int, end: int) -> Iterator[tuple[str, int, int, list[str]]]:
    groups = [(m.start() + start, m.end() + start) for m in _GROUP.finditer(text[start:end])]
    for i in range(len(groups)):
        digits = ""
        for j in range(i, min(len(groups), i + MOST_GROUPS)):
            digits += text[groups[j][0] : groups[j][1]]
            if len(digits) > MOST_DIGITS:
                break
            first, last = groups[i][0], groups[j][1]
            while first > start and text[first - 1] in "(+":
                first -= 1
            sizes = [e - s for s, e in groups[i : j + 1]]
            dotted = len(sizes) == 4 and max(sizes) <= 3
            if len(digits) < FEWEST_DIGITS and not dotted:
                continue
            between = {text[groups[g][1] : groups[g + 1][0]] for g in range(i, j)}
            marks = "".join(sorted(set("".join(between)))).replace(" ", "_") or "none"
            shape = "-".join(map(str, sizes)) if len(sizes) <= 5 and max(sizes) <= 5 else f"long{len(sizes)}"
            common = [
                f"marks={marks}", f"shape={shape}", f"groups={len(sizes)}", f"digits={len(digits)}",
                f"plus={text[first] == '+'}", f"whole={i == 0 and j == len(groups) - 1}", *_around(text, first, last),
            ]
            card = [f"luhn={luhn(digits)}", f"issuer={digits[0]}", f"luhn16={luhn(digits) and len(digits) >= 16}"]
            if len(digits) >= 13:
                yield "card", first, last, [f"card:{f}" for f in common + card]
            if FEWEST_DIGITS <= len(digits) <= 15:
                yield "phone", first, last, [f"phone:{f}" for f in common]
            if dotted:
                small = all(int(text[s:e]) <= 255 for s, e in groups[i : j + 1])
                yield "ip", first, last, [f"ip:{f}" for f in [*common, f"small={small}"]]


def zones_of(text: str) -> list[Zone]:
    """Zones in order; zones that touch are one, so that overlapping candidates compete."""
    found = []
    if _GROUP.search(text):
        for match in _DIGIT_ZONE.finditer(text):
            if match.end() - match.start() >= FEWEST_DIGITS:
                found.append((*match.span(), list(_digit_candidates(text, *match.span()))))
        for match in _DOTTED_ZONE.finditer(text):
            small = all(int(g) <= 255 for g in _GROUP.findall(match[0]))
            features = [f"small={small}", "written", *_around(text, *match.span())]
            found.append((*match.span(), [("ip", *match.span(), [f"ip:{f}" for f in features])]))
    if "at" in text or "AT" in text or "@" in text or "At" in text:
        for match in _MAIL_ZONE.finditer(text):
            bracket = any(c in match[0] for c in "[(")
            dots = len(re.findall(r"dot|\.", match[0], re.IGNORECASE))
            last = re.split(r"[\s.\])]", match[0])[-1].lower()
            plain = " at " in match[0].lower() and not bracket
            if plain and " dot " not in match[0].lower():
                continue  # "look at example.com"
            features = [
                f"bracket={bracket}", f"dots={min(dots, 3)}", f"plain={plain}", f"sign={'@' in match[0]}",
                f"word_dot={' dot ' in match[0].lower()}", f"ending={last in ('com', 'org', 'net', 'edu', 'de', 'fr', 'es', 'io')}",
                *_around(text, *match.span()),
            ]
            found.append((*match.span(), [("email", *match.span(), [f"email:{f}" for f in features])]))
    found.sort(key=lambda z: z[:2])
    zones: list[Zone] = []
    for start, end, candidates in found:
        if zones and start < zones[-1].end:
            zones[-1].end = max(zones[-1].end, end)
            zones[-1].candidates += candidates
        elif candidates:
            zones.append(Zone(start, end, list(candidates)))
    for zone in zones:
        zone.candidates.sort(key=lambda c: (c[2], c[1], c[0]))
    return zones


def _score(weights: dict[str, float], candidate) -> float:
    return weights.get(f"{candidate[0]}:", 0.0) + sum(weights.get(f, 0.0) for f in candidate[3])


def best_segmentation(candidates: list, scores: list[float]) -> list[int]:
    """Indices of the non-overlapping candidates of highest total score (sorted by end)."""
    # The candidates before i that end where it starts or earlier are before it in order.
    places = np.searchsorted([c[2] for c in candidates], [c[1] for c in candidates], side="right").tolist()
    best = [0.0]
    came: list[tuple[int, bool]] = [(0, False)]
    for i, (before, score) in enumerate(zip(places, scores, strict=True)):
        take = best[before] + score
        best.append(max(best[i], take))
        came.append((before, True) if take > best[i] else (i, False))
    chosen, at = [], len(candidates)
    while at > 0:
        before, taken = came[at]
        if taken:
            chosen.append(at - 1)
        at = before
    return chosen[::-1]


def marginals(candidates: list, scores: list[float]) -> tuple[np.ndarray, float]:
    """(probability of each candidate, log of the sum over all segmentations): forward and backward."""
    n = len(candidates)
    ends = np.array([c[2] for c in candidates])
    starts = np.array([c[1] for c in candidates])
    before = np.searchsorted(ends, starts, side="right")
    forward = np.zeros(n + 1)
    for i in range(n):
        forward[i + 1] = np.logaddexp(forward[i], forward[before[i]] + scores[i])
    backward = np.zeros(n + 1)
    backward[:n] = -np.inf
    for i in range(n, 0, -1):
        backward[i - 1] = np.logaddexp(backward[i - 1], backward[i])
        spot = before[i - 1]
        backward[spot] = np.logaddexp(backward[spot], backward[i] + scores[i - 1])
    probability = np.array([np.exp(forward[before[i]] + scores[i] + backward[i + 1] - forward[n]) for i in range(n)])
    return probability, float(forward[n])


def train(zones: list[tuple[list, set[int]]]) -> dict[str, float]:
    """Weights from zones (candidates, indices of the true ones): gradient ascent on log likelihood."""
    weights: dict[str, float] = {}
    squares: dict[str, float] = {}
    random = np.random.default_rng(7)
    for _ in range(_EPOCHS):
        for z in random.permutation(len(zones)).tolist():
            candidates, true = zones[z]
            scores = [_score(weights, c) for c in candidates]
            probability, _total = marginals(candidates, scores)
            for i, candidate in enumerate(candidates):
                slope = (1.0 if i in true else 0.0) - probability[i]
                if abs(slope) < 1e-4:
                    continue
                for name in (f"{candidate[0]}:", *candidate[3]):
                    value = weights.get(name, 0.0)
                    step = slope - _DECAY * value
                    squares[name] = squares.get(name, 1e-2) + step * step
                    weights[name] = value + _RATE * step / squares[name] ** 0.5
    return weights


def _rewritten(kind: str, found: str, random) -> str:
    """A find written in another way, as people do to hide it or by habit."""
    if kind == "email":
        at = random.choice([" at ", " [at] ", "(at)", " (at) "])
        dot = " dot " if at == " at " else random.choice([" dot ", " [dot] ", "(dot)", "."])
        name, domain = found.split("@")
        return name + at + domain.replace(".", dot)
    if kind == "ip":
        return found.replace(".", random.choice([" dot ", "[.]", " . ", "(.)"]))
    if kind == "card":
        digits = _digits(found)
        mark = random.choice([".", "/", " - ", "  "])
        return mark.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    return found.replace("+1 ", "").lstrip("+")


def _date(random) -> str:
    """Digits in groups that are nobody's number."""
    year, month, day, hour, minute = (int(random.integers(a, b)) for a, b in ((1990, 2031), (1, 13), (1, 29), (0, 24), (0, 60)))
    return random.choice(
        [
            f"{year}-{month:02}-{day:02} {hour:02}:{minute:02}", f"{year}-{month:02}-{day:02}",
            f"{day:02}.{month:02}.{year}", f"{month:02}/{day:02}/{year} {hour:02}:{minute:02}",
            f"{year}-{year + 1} {month}", f"{year}{month:02}{day:02}",
        ]
    )


def examples(text: str, seed: int) -> list[tuple[list, set[int]]]:
    """Training zones of one text: as it stands, with finds written otherwise, twice in a row, or
    a date in their place."""
    base = base_spans(text)
    random = np.random.default_rng(seed)
    out = []

    def learn(piece: str, true: list[Span]) -> None:
        known, in_order = set(true), sorted(true, key=lambda s: s[1])
        starts = [s[1] for s in in_order]
        longest = max((s[2] - s[1] for s in true), default=0)

        def near(zone: Zone) -> list[Span]:
            return in_order[bisect_left(starts, zone.start - longest) : bisect_left(starts, zone.end)]

        for zone in zones_of(piece):
            wanted = {i for i, c in enumerate(zone.candidates) if c[:3] in known}
            touched = [s for s in near(zone) if s[1] < zone.end and zone.start < s[2]]
            if len(wanted) == len(touched) and len(zone.candidates) <= ZONE_CANDIDATES:
                out.append((zone.candidates, wanted))

    learn(text, base)
    for kind, start, end in base:
        before, after = text[max(0, start - 30) : start], text[end : end + 30]
        new = _rewritten(kind, text[start:end], random)
        learn(before + new + after, [(kind, len(before), len(before) + len(new))])
        learn(before + _date(random) + after, [])
        if kind in ("card", "phone"):
            twice = f"{text[start:end]} {text[start:end]}"
            middle = len(before) + end - start
            learn(before + twice + after, [(kind, len(before), middle), (kind, middle + 1, len(before) + len(twice))])
    return out


def added_spans(text: str, base: list[Span], weights: dict[str, float]) -> list[Span]:
    """What the field finds beside the base spans."""
    found = []
    in_order = sorted((start, end) for _, start, end in base)
    starts = [start for start, _ in in_order]
    reach = list(accumulate((end for _, end in in_order), max))  # where all spans up to one have ended
    for zone in zones_of(text):
        before = [bisect_left(starts, c[2]) for c in zone.candidates]
        free = [c for c, n in zip(zone.candidates, before, strict=True) if not n or reach[n - 1] <= c[1]]
        scores = [_score(weights, c) - MARGIN for c in free]
        found.extend(free[i][:3] for i in best_segmentation(free, scores))
    return found


def _ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("features", pa.list_(pa.string()))]
    )
    for batch in batches:
        zones, true, order = [], [], []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            for number, (candidates, wanted) in enumerate(examples(text, (doc_id or 0) & 0x7FFFFFFF)):
                order.append(xxhash.xxh64_intdigest(f"{doc_id}:{number}") >> 1)
                zones.append([dict(zip(("kind", "start", "end", "features"), c, strict=True)) for c in candidates])
                true.append(sorted(wanted))
        yield pa.RecordBatch.from_arrays(
            [pa.array(zones, pa.list_(kind)), pa.array(true, pa.list_(pa.int32())), pa.array(order, pa.int64())],
            names=["candidates", "true", "place"],
        )


def fit_field(documents: DataFrame) -> dict[str, float]:
    """The field's weights, from about SAMPLE_TEXTS texts that hold a digit or an @; without any: none."""
    ship_package(documents.sparkSession)
    usable = documents.where(F.col("text").rlike("[0-9@]")).select(F.col("doc_id").cast("long"), "text")
    n = usable.count()
    part = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 32)) / float(1 << 32)
    rows = (
        usable.where(part * n < SAMPLE_TEXTS)
        .mapInArrow(
            sliced(_examples),
            "candidates array<struct<kind:string,start:bigint,end:bigint,features:array<string>>>, true array<int>, place long",
        )
        .orderBy("place", F.xxhash64("candidates"))  # by a hash of (doc_id, zone): the same zones however files are laid out
        .limit(SAMPLE_ZONES)
        .collect()
    )
    return train([([(c.kind, c.start, c.end, c.features) for c in row.candidates], set(row.true)) for row in rows])


def _find(weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            base, spans = [], []
            for text in batch.column("_text").to_pylist():
                own = base_spans(text or "")
                more = added_spans(text, own, weights.value) if text else []
                base.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in _ordered(own)])
                spans.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in _ordered(own + more)])
            rest = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(base, kind), pa.array(spans, kind)], names=[*batch.schema.names[:-1], *_ADDED]
            )

    return run


_ADDED = ("base_spans", "spans")
_SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def find_personal_data(documents: DataFrame, weights: dict[str, float]) -> DataFrame:
    """documents with the personal data of each whole text: base_spans, and spans (with those added).

    Spans are (kind, start, end) in characters, end exclusive, by kind (email, ip, card, phone), then
    start. Base spans are those of the fixed patterns and always among the spans; added ones do not
    touch them. A NULL or empty text has none. Columns of these names are replaced, all others kept.
    """
    spark = documents.sparkSession
    ship_package(spark)
    kept = [F.col(f"`{c}`") for c in documents.columns if c.lower() not in _ADDED]
    shown = documents.select(*kept, F.col("text").alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in shown.schema.fields[:-1])
    return shown.mapInArrow(
        sliced(_find(spark.sparkContext.broadcast(weights))), f"{fields}, base_spans {_SPANS}, spans {_SPANS}"
    )


def span_text(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    def one(s: Column) -> Column:
        return F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))

    return F.array_join(F.transform(spans, one), ",")


def n_spans(spans: Column, kind: str) -> Column:
    """How many spans are of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
