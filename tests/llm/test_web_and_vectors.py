import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from repovitals.llm.html_paths import main_text, read_blocks
from repovitals.llm.lsh_forest import _score_block, nearest_neighbours, shared_prefix
from repovitals.llm.url_reputation import ALLOW, BLOCK, domain_of, judge_urls, suffix_of

RULES = [(ALLOW, "org", "/"), (BLOCK, "example.org", "/es/"), (BLOCK, "example.org", "/en/1")]


def test_rules_and_hosts(spark):
    urls = [
        "http://A.Example.ORG/es/1?q", "https://example.org/en/12#x", "https://example.org/en/2", "http://myexample.org?a=/",
        None, "no scheme", "ftp://h.net", "x://a://b/c", "", "http://EXAMPLE.net:8080/p/q?r#s",
    ]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("rule", F.lit("own"))
    labels = spark.createDataFrame([], "page_id long, bad int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, labels, RULES).collect()}
    assert got[0] == ("a.example.org", "/es/1", "example.org/es/", BLOCK)
    assert got[1] == ("example.org", "/en/12", "example.org/en/1", BLOCK)
    assert got[2] == ("example.org", "/en/2", "org/", ALLOW)
    assert got[3] == ("myexample.org", "", None, ALLOW)
    assert got[4] == got[5] == got[8] == ("", "", None, ALLOW)
    assert got[6] == ("h.net", "", None, ALLOW)
    assert got[7] == ("a:", "//b/c", None, ALLOW)
    assert got[9] == ("example.net:8080", "/p/q", None, ALLOW)
    assert judge_urls(pages.limit(0), labels, RULES).collect() == []


def test_reputation_is_shrunk(spark):
    rows, bad = [], []
    for host, n, share in (("bad.one.com", 40, 0.95), ("good.one.com", 40, 0.02), ("new.one.com", 1, 1), ("x.two.net", 50, 0.1)):
        for i in range(n):
            rows.append((len(rows), f"http://{host}/{i}"))
            bad.append((len(bad), int(i < share * n)))
    rows.append((len(rows), "http://unseen.two.net/"))
    pages = spark.createDataFrame([*rows, rows[0]], "page_id long, url string")
    labels = spark.createDataFrame([*bad, bad[0], (10**6, 1), (3, None)], "page_id long, bad int")
    judged = judge_urls(pages, labels, [])
    assert judged.count() == len(rows) + 1
    host = {r.host: r for r in judged.collect()}
    assert host["bad.one.com"].verdict == BLOCK and host["good.one.com"].verdict == ALLOW
    assert host["bad.one.com"].bad_share < 0.96 and host["new.one.com"].bad_share < 0.9
    assert host["new.one.com"].bad_share > host["unseen.two.net"].bad_share
    assert host["new.one.com"].bad_bound < host["new.one.com"].bad_share


def test_names(spark):
    frame = spark.createDataFrame([("a.b.co.uk",), ("b.com",), ("com",), ("",)], "h string")
    got = [tuple(r) for r in frame.select(domain_of(F.col("h")), suffix_of(F.col("h"))).collect()]
    assert got == [("b.co.uk", "co.uk"), ("b.com", "com"), ("com", "com"), ("", "")]


def test_addresses_share_no_domain(spark):
    frame = spark.createDataFrame([("10.0.0.1",), ("7.9.0.1",), ("[::1]",), ("1.example.com",), ("a.10",)], "h string")
    got = [tuple(r) for r in frame.select(domain_of(F.col("h")), suffix_of(F.col("h"))).collect()]
    assert got == [("10.0.0.1", "[]"), ("7.9.0.1", "[]"), ("[::1]", "[]"), ("example.com", "com"), ("a.10", "10")]
    rows = [(i, f"http://{('10.0.0.1', '7.9.0.1:80', 'u@[::1]:8080')[i % 3]}/{i}") for i in range(90)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)], "page_id long, bad int")
    judged = judge_urls(spark.createDataFrame(rows, "page_id long, url string"), labels, [])
    assert {(r.host, r.verdict) for r in judged.collect()} == {
        ("10.0.0.1", BLOCK), ("7.9.0.1:80", ALLOW), ("u@[::1]:8080", ALLOW)
    }


def vectors(n, size=16, seed=1):
    return np.random.default_rng(seed).standard_normal((n, size)).astype(np.float32)


def exact(ids, matrix, query, k):
    scores = matrix.astype(np.float64) @ matrix[query].astype(np.float64)
    order = [j for j in np.lexsort((ids, -scores)) if j != query][:k]
    return [int(ids[j]) for j in order], [scores[j] for j in order]


def test_recall_and_scores(spark):
    matrix = vectors(2000) * np.random.default_rng(2).uniform(0.5, 2, (2000, 1)).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(matrix)], "vec_id long, embedding array<float>")
    rows = nearest_neighbours(frame, F.col("vec_id") % 20 == 0, 20).collect()
    found: dict = {}
    for row in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(row.query_id, []).append((row.vec_id, row.score))
    assert sorted(found) == list(range(0, 2000, 20)) and {len(v) for v in found.values()} == {20}
    ids, hits = np.arange(2000), 0
    for query, near in found.items():
        hits += len(set(exact(ids, matrix, query, 20)[0]) & {i for i, _ in near})
        for i, score in near:
            assert score == pytest.approx(float(matrix[i].astype(np.float64) @ matrix[query].astype(np.float64)), rel=1e-12)
    assert hits / (20 * len(found)) >= 0.9


def test_equal_vectors_and_odd_rows(spark):
    same = [1.0, 0.0, 0.0]
    rows = [(i, same) for i in range(60)] + [
        (60, [0.9, 0.1, 0.0]), (61, None), (62, [0.0, 0.0, 0.0]), (63, [1.0, None, 0.0]), (64, [float("nan"), 1.0, 0.0]),
        (65, [float("inf"), 1.0, 0.0]), (None, same), (66, [1.0]), (80, [0.5, 0.5, 0.1]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("own"))
    got: dict = {}
    for row in sorted(nearest_neighbours(frame, F.col("vec_id") % 20 == 0, 20).collect()):
        got.setdefault(row.query_id, []).append(row.vec_id)
    assert set(got) == {0, 20, 40, 60, 80}
    for query in (0, 20, 40):
        assert got[query] == [i for i in range(60) if i != query][:20]
    assert got[60] == list(range(20)) and got[80] == [*range(19), 19] or got[80][0] == 0
    few = nearest_neighbours(frame.where("vec_id in (60, 80)"), F.col("vec_id") % 20 == 0, 20).collect()
    assert sorted((r.query_id, r.vec_id) for r in few) == [(60, 80), (80, 60)]
    assert nearest_neighbours(frame.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_shared_prefix():
    assert shared_prefix(np.array([0, 1, 2**31, 5]), np.array([0, 0, 0, 4])).tolist() == [32, 31, 0, 31]


PAGE = """<html><head><title>T</title></head><body class="home"><header><h1>Site</h1><nav><a href=x>x</a></nav></header>
<div id="cookie-notice">We use cookies</div><div class="layout"><div class="sidebar"><p>Side</p></div>
<div class="post-{n} content"><h2>Title &lt;x&gt;</h2><p>Some <i>text</i>&#32;here {n}  that is
long enough.<p>Second with <a href="q>r">link</a> &amp; more words.<ul><li>one<li>two</ul><div class="ad">buy</div>
<form><input><label>Name</label></form></div><div class="comments"><div class="comment"><p>I disagree with this very long
comment of mine.</p></div></div></div><footer>foot</footer><script>if(a<b){{}}</script></body></html>"""


def test_main_text(spark):
    want = "Title <x>\nSome text here {n} that is long enough.\nSecond with link & more words.\none\ntwo"
    short = '<body class="home"><div class="layout"><div class="post-9 content"><p>Hi</p></div><div class="links"><p>See this other longer thing</p></div></div>'
    html = [PAGE.format(n=i) for i in range(5)]
    rows = [(i, f"http://a.com/{i}", h) for i, h in enumerate(html)] + [
        (5, "http://a.com/5", None), (6, "http://a.com/6", ""), (7, "http://b.com/7", "just &eacute; text"),
        (8, None, "<p>no host</p>"), (9, "http://a.com/9", "<html><body class='home'><div class=layout><div class='content post-3'><p>cut off he<b"),
        (0, "http://a.com/0", html[0]), (10, "http://a.com/10", short),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("own"))
    got = [(r.page_id, r.text) for r in main_text(pages).collect()]
    assert len(got) == len(rows)
    text = dict(got)
    assert all(text[i] == want.format(n=i) for i in range(5))
    assert text[5] == text[6] == "" and text[7] == "just é text" and text[8] == "no host" and text[9] == "cut off he"
    assert text[10] == "Hi"  # its host's other pages say where its article stands
    assert main_text(pages.limit(0)).collect() == []


def test_blocks_of_broken_markup():
    texts = lambda html: [t for t, _, _ in read_blocks(html)]
    assert texts("<p>a<b>b<p>c</p></div>d") == ["ab", "c", "d"]
    assert texts("a <!-- x <p>y</p> --> b<br>c < d &amp") == ["a b c < d &"]
    assert texts("<script>var t='</p>'</script>x<style>p{}") == ["x"]
    assert texts("<article><header><h1>H</h1></header><p>x</p></article><header>y</header>") == ["H", "x"]
    assert texts("") == []


def test_sparse_regions_get_all_their_neighbours(spark, monkeypatch):
    """The goal sample came from a denser region: its shortest prefix is far too long for these vectors."""
    monkeypatch.setattr("repovitals.llm.lsh_forest._enough", lambda *_: (4_000, 6))
    matrix = vectors(60)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(matrix)], "vec_id long, embedding array<float>")
    found: dict = {}
    for row in nearest_neighbours(frame, F.col("vec_id") % 20 == 0, 20).collect():
        found.setdefault(row.query_id, set()).add(row.vec_id)
    assert found == {q: set(exact(np.arange(60), matrix, q, 20)[0]) for q in (0, 20, 40)}


LONG_TEXT = "<p>Here is a sentence of the body that goes on for a while.</p>"
SITE = '<body><div class="links"><a href=a>Some other page of this site</a> <a href=b>And one more of them</a></div>{}</body>'


@pytest.mark.parametrize(
    ("html", "n"),
    [
        (f"<article><h1>Title</h1><p>Lead</p><div class=body>{LONG_TEXT * 9}</div></article>", 11),
        (f"<div class=post><h1>Title</h1><div class=in><div class=body>{LONG_TEXT * 9}</div></div></div>", 10),
        (f"<div class=post><div class=a>{LONG_TEXT * 6}</div><div class=b>{LONG_TEXT * 4}</div></div>", 10),
        (f"<article><div class=a><div><div><div>{LONG_TEXT * 6}</div></div></div></div><div class=b>{LONG_TEXT}</div></article>", 7),
    ],
)
def test_articles_in_nested_and_split_containers(spark, html, n):
    pages = spark.createDataFrame([(f"http://a.com/{i}", SITE.format(html)) for i in range(3)], "url string, html string")
    for row in main_text(pages).collect():
        assert len(row.text.split("\n")) == n and "other page" not in row.text


@pytest.mark.parametrize(
    "wrapper", ["class='content with-sidebar'", "class='layout-sidebar-right'", "class=no-sidebar", "id=main-search", "class='sidebar-left'"]
)
def test_names_of_a_layout_do_not_drop_the_article(wrapper):
    html = f"<body><div {wrapper}><div class=sidebar>Aside</div><h2>Title</h2>{LONG_TEXT}<div class=comments>{LONG_TEXT * 9}</div></div></body>"
    assert [t for t, _, _ in read_blocks(html)] == ["Title", LONG_TEXT[3:-4]]
    plain = f"<body><div {wrapper}><div class='left-sidebar'>Aside</div><h2>Title</h2>{LONG_TEXT}</div><div class=site-header>Site</div></body>"
    assert [t for t, _, _ in read_blocks(plain)] == ["Title", LONG_TEXT[3:-4]]
    assert [t for t, _, _ in read_blocks("<div class=notice>All there is</div>")] == ["All there is"]


def test_ties_of_a_block_go_to_the_smaller_ids():
    random = np.random.default_rng(3)
    tied = np.hstack((np.ones((500, 1)), random.standard_normal((500, 7)))).astype(np.float32)
    tied[:, 1:] = np.where(tied[:, 1:] > 0, 0.5, -0.5) * np.arange(1, 501)[:, None].astype(np.float32)
    order = random.permutation(500)
    points = pd.DataFrame({"class_id": order + 1, "string": 0, "vector": [tied[i].tobytes() for i in order]})
    query = np.eye(8, dtype=np.float32)[0].tobytes()
    queries = pd.DataFrame({"class_id": [0], "string": [0], "level": [0], "vector": [query]})
    got = _score_block(20)((0, 0, 0), points, queries)
    assert got["class_id"].tolist() == list(range(1, 22)) and set(got["score"]) == {1.0}
