"""Main text of web pages by consensus: the pages of a host vote on where their articles stand.

Every page scores its containers by the text that stands in them and names each by its path of tags and
classes, numbers left out. The best one is widened to the ancestor that holds the whole article, and
each path gets a vote by how well its text agrees with that. Votes are counted per host and path in
Spark. Each page is then read again at its host's winning path; a page without it is read at its own.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .batches import sliced
from .storage import ship_package, stored, workspace
from .url_reputation import url_host

#: Elements without text of their own, boilerplate elements, roles and words of names.
RAW = frozenset("script style title template noscript iframe textarea select object svg math audio video canvas".split())
DROPPED = frozenset("nav header footer aside form button dialog menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs header masthead footer sidebar aside widget cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended comment comments disqus reply replies respond pagination pager toolbar form search skip".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead tr ul button option".split()
)
CONTAINERS = BLOCKS - frozenset("html p h1 h2 h3 h4 h5 h6 hr head pre li dd dt address caption figcaption legend option summary".split())
#: Words of discussions, which may well be longer than the article; and first words of names that tell of a layout.
_COMMENTS = frozenset("comment comments disqus reply replies respond".split())
_LAYOUT = frozenset("with without has no not".split())
_HEADERS = frozenset(("header", "masthead"))
_NEVER_DROPPED = frozenset(("html", "body", "main", "article"))
#: A container counts this share of what the one below it counts of a block.
SHARE = 0.5
#: From this share of linked characters on, text beside the article is a list of links.
LINKED = 1 / 3
#: What a vote is worth for a path that misses some of the page's article, and for one above it.
PARTIAL, ABOVE = 0.5, 0.85

_TAG = re.compile(r"""<!--|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""")
_LOOSE_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.IGNORECASE)
_UNENDED = re.compile(r"<[A-Za-z/!][^<>]*\Z")
_MARK = "\0"
_WORD = re.compile(r"[a-z]+")
_NUMBER = re.compile(r"[0-9]+")
_ENDS = {name: re.compile(rf"</{name}(?=[\s>/])[^>]*(?:>|\Z)", re.IGNORECASE) for name in RAW}


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)} if "=" in text else {}


def _named(attributes: dict[str, str]) -> set[str]:
    """Boilerplate words that begin or end one of the element's names."""
    found = set()
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split():
        words = _WORD.findall(name)
        if words and words[0] not in _LAYOUT:
            found |= {words[0], words[-1]} & WORDS
    return found


def _drops(name: str, attributes: dict[str, str], inside: bool) -> tuple[bool, set[str]]:
    """Is the element something other than the article, by its tag or role, or by which words of its names?

    A header within (inside) an article belongs to it.
    """
    if name in _NEVER_DROPPED:
        return False, set()
    if name in DROPPED:
        return not (inside and name in _HEADERS), set()
    if attributes.get("role", "").lower() in ROLES:
        return True, set()
    return False, _named(attributes) - (_HEADERS if inside else frozenset())


def _step(name: str, attributes: dict[str, str]) -> str:
    names = sorted(_NUMBER.sub("#", c) for c in attributes.get("class", "").lower().replace("/", "|").split())
    return ".".join([name, *names])


def _tags(html: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, slash, name, attributes) of each tag; comments and the like have no name."""
    at = html.find("<")
    while at >= 0:
        match = _TAG.match(html, at)
        if not match and html[at + 1 : at + 2].isalpha() or not match and html.startswith("</", at):
            match = _LOOSE_TAG.match(html, at)
        if not match:
            at = html.find("<", at + 1)
            continue
        end = match.end()
        if match[0] == "<!--":
            end = html.find("-->", at + 4)
            end = len(html) if end < 0 else end + 3
            yield at, end, "", "", ""
        elif match.lastindex is None:
            yield at, end, "", "", ""
        else:
            name = match[2].lower()
            if name in RAW and not match[1] and not match[3].endswith("/"):
                closed = _ENDS[name].search(html, end)
                end = closed.end() if closed else len(html)
                yield at, end, "", "", ""
            else:
                yield at, end, match[1], name, match[3]
        at = html.find("<", end)


class Page:
    """The blocks of a page, in order, each (text, node of its container, linked characters).

    The containers of a page are a tree of nodes; 0 is the page. Containers of equal step below one node
    are one node, so that a node stands for a path of steps; a node's number is above its parent's.
    """

    def __init__(self):
        self.blocks: list[tuple[str, int, int]] = []
        self.parent, self.step, self.depth, self.inside, self.key = [0], [""], [0], [False], [0]
        self._node: dict[tuple[int, str], int] = {}

    def __iter__(self):
        return iter(self.blocks)

    def child(self, parent: int, step: str) -> int:
        node = self._node.get((parent, step))
        if node is None:
            node = self._node[parent, step] = len(self.parent)
            self.parent.append(parent)
            self.step.append(step)
            self.depth.append(self.depth[parent] + 1)
            self.inside.append(self.inside[parent] or step.partition(".")[0] in ("article", "main"))
            # A number for the whole path, the same on all pages.
            self.key.append(xxhash.xxh64_intdigest(step, seed=self.key[parent]))
        return node

    def totals(self, values: Iterable[float], share: float = 1) -> list[float]:
        """For each node the sum of its blocks' values, and of those further down, ever less by the share."""
        out = [0.0 if share != 1 else 0] * len(self.parent)
        for (_, node, _), value in zip(self.blocks, values, strict=True):
            out[node] += value
        for node in range(len(out) - 1, 0, -1):
            out[self.parent[node]] += share * out[node]
        return out

    def below(self, top: int) -> list[bool]:
        """Is a node the top or below it?"""
        out = [node == top for node in range(len(self.parent))]
        for node in range(top + 1, len(out)):
            out[node] = out[self.parent[node]]
        return out

    def path(self, node: int) -> str:
        steps = []
        while node:
            steps.append(self.step[node])
            node = self.parent[node]
        return "/".join(reversed(steps))


def read_blocks(html: str) -> Page:
    """The page with its blocks of text outside boilerplate.

    What its names call boilerplate is kept all the same if it holds most of the page's unlinked text, a
    main element or an unlinked h1, discussions apart; and if nothing would be left without it.
    """
    page, named = _blocks(html, frozenset())
    if named:
        marked, _ = _blocks(html, None)
        worth = [max(0, len(text) - linked) for text, _, linked in marked]
        sums, held = marked.totals(worth), marked.totals([1] * len(worth))
        n = len(marked.parent)
        titled, main = [False] * n, [False] * n
        for node in range(1, n):
            titled[node] = titled[marked.parent[node]] or marked.step[node] == "h1"
        heading = [titled[node] and 2 * own > len(text) for (text, node, _), own in zip(marked, worth, strict=True)]
        headings = marked.totals(map(int, heading))
        for node in range(n - 1, 0, -1):
            main[node] |= marked.step[node].partition(".")[0] == "main" and held[node] > 0
            main[marked.parent[node]] |= main[node]
        marks = {node: marked.step[node] for node in range(n) if marked.step[node].startswith(_MARK) and held[node]}
        total = sums[0]
        names = {
            m for node, m in marks.items()
            if not m.endswith(_MARK) and (headings[node] or main[node] or 2 * sums[node] > total)
        }
        if names:
            page = _blocks(html, frozenset(int(m.strip(_MARK)) for m in names))[0]
        if not page.blocks:
            page = _blocks(html, frozenset(int(m.strip(_MARK)) for m in marks.values()))[0]
    return page


def _blocks(html: str, kept: frozenset[int] | None) -> tuple[Page, bool]:
    """The page, and has it containers dropped by name? Those that start at the places in kept are not.

    With None no container is dropped by name: its step is its place between marks (two at the end for
    discussions), and h1 is a step.
    """
    unended = _UNENDED.search(html)
    if unended:  # the page breaks off within a tag
        html = html[: unended.start()]
    page = Page()
    named = False
    stack: list[tuple[str, int, bool]] = []  # name, node of what it is in, drops what is in it
    opened: Counter[str] = Counter()
    here = dropping = 0
    pieces: list[str] = []
    linked = in_link = 0

    def close() -> None:
        nonlocal pieces, linked
        text = "".join(pieces)
        if "&" in text:
            text = unescape(text)
        text = " ".join(text.split())
        if text:
            page.blocks.append((text, here, linked))
        pieces, linked = [], 0

    def push(name: str, step: str, drops: bool) -> None:
        nonlocal here, dropping
        stack.append((name, here, drops))
        opened[name] += 1
        dropping += drops
        here = page.child(here, step) if step else here

    def pop() -> str:
        nonlocal here, dropping
        name, here, drops = stack.pop()
        opened[name] -= 1
        dropping -= drops
        return name

    done = 0
    for start, end, slash, name, attributes in _tags(html):
        if start > done and not dropping:
            pieces.append(html[done:start])
            if in_link:
                linked += start - done
        done = end
        if not name:
            continue
        if name not in BLOCKS:
            if name == "br" and not dropping:
                pieces.append(" ")
            elif name == "a":
                in_link = 0 if slash else 1
            if name in DROPPED or "=" not in attributes and not (slash and dropping):
                continue
            # Inline elements matter only where their name says they are no part of the article.
            if slash:
                if stack and stack[-1][0] == name:
                    pop()
            elif not attributes.endswith("/") and name in ("span", "ins", "label", "a"):
                drops, words = _drops(name, _attributes(attributes), page.inside[here])
                if drops or words:
                    push(name, "", True)
            continue
        if not dropping:
            close()
        if slash:
            if opened[name]:
                while pop() != name:
                    pass
                in_link = 0
        elif not attributes.endswith("/") and (
            name in CONTAINERS or name in ("li", "p", "dd", "dt") or kept is None and name == "h1"
        ):
            known = _attributes(attributes)
            drops, words = _drops(name, known, page.inside[here])
            step = _step(name, known) if name in CONTAINERS else "h1" if name == "h1" else ""
            if words:
                named = True
                if kept is None:
                    step = f"{_MARK}{start}{_MARK if words & _COMMENTS else ''}"
                else:
                    drops = start not in kept
            if step or drops:
                if name in ("p", "li", "dd", "dt", "tr", "td", "th", "option") and stack and stack[-1][0] == name:
                    pop()
                push(name, step, drops)
            elif name in ("p", "li") and stack and stack[-1][0] == name and stack[-1][2]:
                pop()
    if done < len(html) and not dropping:
        pieces.append(html[done:])
    close()
    return page, named


def container_scores(page: Page) -> list[float]:
    """For each container the text in it: all of its own blocks, ever less of those further down.

    Linked text does not count, and what stands in no container but the page itself counts little.
    """
    return page.totals((float(max(0, len(text) - 2 * linked)) for text, _, linked in page), SHARE)


def article_node(page: Page) -> int:
    """The container that holds the whole article; 0 (the page) if none has text of its own.

    That is the best container, or the highest one above it that adds text to the article: all that
    an article element holds, and elsewhere the text beside it in which links are few. Where lists of links
    beside it are more than the text that would be won, it is not widened; a main element may hold
    as many of them as there is text in the article. Of equally good ones the deepest, then by path.
    """
    scores = container_scores(page)
    most = max(scores[1:], default=0)
    if most <= 0:
        return 0
    tied = [node for node in range(1, len(scores)) if scores[node] == most]
    deepest = max(page.depth[node] for node in tied)
    tied = [node for node in tied if page.depth[node] == deepest]
    best = tied[0] if len(tied) == 1 else min(tied, key=page.path)

    length = page.totals(len(text) for text, _, _ in page)
    links_in = page.totals(min(linked, len(text)) for text, _, linked in page)
    children: list[list[int]] = [[] for _ in length]
    for node in range(1, len(length)):
        children[page.parent[node]].append(node)
    child, above = best, page.parent[best]
    while above:
        # What is beside the article here, by the containers it is in; what is in none of them is one part too.
        beside = [(length[x], links_in[x]) for x in children[above] if x != child]
        beside.append((length[child] - length[best], links_in[child] - links_in[best]))
        beside.append(tuple(t[above] - sum(t[x] for x in children[above]) for t in (length, links_in)))
        won = sum(n for n, linked in beside if linked < LINKED * n)
        links = sum(n for n, linked in beside if linked >= LINKED * n)
        name = page.step[above].partition(".")[0]
        if name == "article" and won + links or won and (links <= won or name == "main" and links <= length[best]):
            best = above
        child, above = above, page.parent[above]
    return best


def path_votes(page: Page) -> dict[int, float]:
    """For each container that holds text of the page's article: how well the two agree (F1 of characters).

    One that misses some of the article counts less, as does one above it, so that single pages
    do not widen what most others agree on.
    """
    article = article_node(page)
    if not article:
        return {}
    length = page.totals(len(text) for text, _, _ in page)
    whole = length[article]
    both = [n if inside else 0 for n, inside in zip(length, page.below(article), strict=True)]
    above = page.parent[article]
    while above:
        both[above] = whole
        above = page.parent[above]
    return {
        node: 2 * own / (length[node] + whole) * (PARTIAL if own < whole else 1.0 if node == article else ABOVE)
        for node, own in enumerate(both)
        if own and node
    }


def text_at(page: Page, key: int | None) -> str:
    """The blocks in the containers of a path, given by its key; of a page that has none, those of its own article."""
    def within(top: int) -> list[str]:
        inside = page.below(top)
        return [text for text, node, _ in page if inside[node]]

    top = page.key.index(key) if key and key in page.key else 0
    return "\n".join(top and within(top) or within(article_node(page)))


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, keys, depths, votes = [], [], [], []
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            page = read_blocks(html or "")
            for node, share in path_votes(page).items():
                hosts.append(host)
                keys.append(page.key[node].to_bytes(8, "big"))
                depths.append(page.depth[node])
                votes.append(round(share * 1_000_000))
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(keys, pa.binary()), pa.array(depths, pa.int32()), pa.array(votes, pa.int64())],
            names=["host", "path", "depth", "votes"],
        )


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        html, path = batch.column("_html").to_pylist(), batch.column("_path").to_pylist()
        keys = [int.from_bytes(p, "big") if p else None for p in path]
        texts = [text_at(read_blocks(h or ""), key) for h, key in zip(html, keys, strict=True)]
        rest = [batch.column(i) for i in range(batch.num_columns - 2)]
        yield pa.RecordBatch.from_arrays(
            [*rest, pa.array(texts, pa.string())], names=[*batch.schema.names[:-2], "text"]
        )


def winning_paths(pages: DataFrame) -> DataFrame:
    """Rows (host, path): the path with most votes among the pages (url, html) of each host, as a 64-bit key
    of its steps: of deeply nested pages the names of all paths would be far longer than the pages.

    Votes are whole millionths of a page, so their sum does not depend on the order. Equal votes: the
    longer path, then the one whose key sorts first.
    """
    votes = (
        pages.select(url_host(F.col("url")).alias("host"), "html")
        .mapInArrow(sliced(_vote), "host string, path binary, depth int, votes long")
        .groupBy("host", "path", "depth")
        .agg(F.sum("votes").alias("votes"))
    )
    order = Window.partitionBy("host").orderBy(F.desc("votes"), F.desc("depth"), "path")
    return votes.withColumn("place", F.row_number().over(order)).where(F.col("place") == 1).select("host", "path")


def main_text(pages: DataFrame) -> DataFrame:
    """pages (url, html) with the main text of each whole page as `text` (replaced if there).

    The article without boilerplate, character references decoded; white space within a block is one
    space, blocks are trimmed and joined by a newline in page order. A NULL or empty page, and one
    without text, has an empty text. Pages without a host vote together. A page
    that breaks off is read as far as it goes. Rows may repeat; all other columns are kept.
    """
    spark = pages.sparkSession
    folder = workspace(spark)
    ship_package(spark)
    winners = stored(winning_paths(pages), f"{folder}/paths")
    kept = [c for c in pages.columns if c.lower() != "text"]
    winners = winners.select(F.col("host").alias("_host"), F.col("path").alias("_path"))
    met = pages.withColumn("_own", url_host(F.col("url"))).join(winners, F.col("_own") == F.col("_host"), "left")
    shown = met.select(*(F.col(f"`{c}`") for c in kept), F.col("html").alias("_html"), F.col("_path"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in shown.schema.fields[:-2])
    return shown.mapInArrow(sliced(_extract), f"{fields}, text string")
