"""Operators on pages and vectors against brute force and on hard rows."""

import collections

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import check
from learnlake.llm import covertree, dom, onebit, urlfilter, wrapper
from learnlake.llm.queries import ORACLES, QUERIES, RULES

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_with_sql(spark, name):
    con = check.duck(FOLDER)
    df = QUERIES[name](spark, FOLDER)
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert check.rows_of(df.columns, [tuple(r) for r in df.collect()]) == check.rows_of(columns, cursor.fetchall())


# ---- URL filter


def plain_rule(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fit = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: len(r.key), default=None)
    return host, path, best and best.key, best.verdict if best else "allow"


def test_urls_of_all_shapes(spark):
    urls = [
        None, "", "no scheme", "://", "http://", "http://com", "http://COM/", "http://a.com/x", "http://xcom/", "ftp://www.Example.com/en/a?q#f",
        "http://example.com/en", "http://example.com/en/", "http://sub.example.com/en/x", "https://x.net/es/", "https://x.net/fr/?a/b",
        "https://net/es/1", "http://a://b.net/fr/", "http://h?x/y", "http://h#/es/", "http://.net/es/", "http://a\nb.net/es/x", "http://é.com/",
    ]
    rows = [(i, u, "x") for i, u in enumerate(urls)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    filters = urlfilter.fit(pages.select("url"), RULES)
    got = urlfilter.judge(pages.drop("host"), filters, ["page_id"]).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == plain_rule(urls[r.page_id])
    assert urlfilter.judge(pages.limit(0), filters, ["page_id"]).count() == 0


def test_cascade_is_exact_with_large_lists(spark, monkeypatch):
    keys = [f"h{i}.example/{i % 7}/" for i in range(30_000)]
    own = keys[::3] + ["not in the universe/"]
    universe = spark.createDataFrame([(k,) for k in keys], "key string")
    levels = urlfilter.cascade(universe, own, rate=0.5)
    assert len(levels) > 3
    assert urlfilter.listed(levels, urlfilter.hashes(keys)).tolist() == [i % 3 == 0 for i in range(len(keys))]
    assert not urlfilter.listed(urlfilter.cascade(universe, []), urlfilter.hashes(keys)).any()


# ---- HTML


def read(page):
    forest = dom.Forest()
    tree, runs = wrapper._read(page, forest)
    return forest, tree, runs


def test_reading_broken_markup():
    page = "<p>a <b>b<br><p>c &amp; d&nbsp;&eacute; <script>x='</p>'</script>e<ul><li>1<li>2</ul>text<!-- no --> more<td"
    runs = [r.text() for r in sorted((r for s in read(page)[2] for r in s), key=lambda r: r.order)]
    assert runs in (["a b", "c & d é", "e", "1", "2", "text more"], ["a b", "c & d é e", "1", "2", "text more"])
    forest, tree, runs = read(None)
    assert forest.labels[tree] == "html" and not forest.kids[tree] and runs == []
    assert read("<div>" * 50_000 + "deep" + "</p>" * 50_000)[2][0][0].text() == "deep"
    assert read("a < b <> c")[2][0][0].text().startswith("a < b")
    assert read("<p>x <math><mi>y</mi><mo>=</mo><mn>2</mn></math> z")[2][0][0].text() == "x y=2 z"


def tree_of(forest, nested):
    return 0 if nested == "#" else forest.node(nested[0], [tree_of(forest, k) for k in nested[1:]])


def test_matching_and_merging():
    forest = dom.Forest()
    a = tree_of(forest, ["html", ["div", "#"], ["p", "#"]])
    b = tree_of(forest, ["html", ["div", "#"], ["ul", "#"], ["p", "#"]])
    assert forest.score(a, b) == 5
    whole = forest.merged(a, b)
    assert [forest.labels[k] for k in forest.kids[whole]] == ["div", "ul", "p"]
    assert forest.places(a, whole) == [0, 2] and forest.places(b, whole) == [0, 1, 2]
    assert forest.places(tree_of(forest, ["html", ["table", "#"]]), whole) == [-1]
    assert forest.load(forest.dump(whole)) == whole and dom.Forest().load(forest.dump(0)) == 0


def plain_score(a, b):
    """Simple tree matching of nested lists, cell by cell."""
    if a == "#" or b == "#" or a[0] != b[0]:
        return int(a == b)
    best = [[0] * len(b) for _ in a]
    for i in range(1, len(a)):
        for j in range(1, len(b)):
            best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + plain_score(a[i], b[j]))
    return 1 + best[-1][-1]


@pytest.mark.parametrize("cells", [1, 4_000_000])
def test_matching_random_trees(monkeypatch, cells):
    monkeypatch.setattr(dom, "CELLS", cells)
    rng = np.random.default_rng(11)

    def grow(depth):
        return ["abc"[rng.integers(3)], *(grow(depth - 1) if depth and rng.random() < 0.7 else "#" for _ in range(rng.integers(0, 6)))]

    for _ in range(150):
        a, b = ["html", *grow(3)[1:]], ["html", *grow(3)[1:]]
        forest = dom.Forest()
        x, y = tree_of(forest, a), tree_of(forest, b)
        assert forest.score(x, y) == plain_score(a, b)
        pairs = forest.pairs(x, y)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert 1 + sum(plain_score(a[1 + i], b[1 + j]) for i, j in pairs) == plain_score(a, b)
        whole = forest.merged(x, y)
        assert forest.sizes[whole] == forest.sizes[x] + forest.sizes[y] - forest.score(x, y)
        for tree in (x, y):
            places = forest.places(tree, whole)
            assert len(places) == len(forest.paths(tree)) == forest.slots[tree]
            assert all(a < b for a, b in zip([-1, *places], places))


def test_long_pages_are_matched_in_seconds():
    import time

    blocks = lambda n, word: "".join(f"<h2>a</h2><p>b</p>{'<ul><li>c</ul>' if i % word == 0 else ''}" for i in range(n))
    start, forest = time.time(), dom.Forest()
    a, b = (forest.fold(dom.read(blocks(n, w)))[0] for n, w in ((10_000, 7), (9_000, 5)))
    whole = forest.merged(a, b)
    assert forest.slots[whole] >= forest.slots[a] and max(forest.places(b, whole)) < forest.slots[whole]
    assert time.time() - start < 60


def test_deep_menus_and_ids_of_headings(spark):
    menu = "<nav>" + "<ul><li>MENU" * 700 + "</li></ul>" * 700 + "</nav>"
    page = "<body>" + menu + "<article><h2 id='how-to-{0}'>Steps</h2><p>{1}</p><h2 id='what-{0}-{2}'>Parts</h2><p>{2}</p></article></body>"
    name = lambda i: "".join(chr(97 + int(d)) for d in str(i))
    rows = [(i, "http://h.example/", page.format(name(i), f"text {i}", f"more {i}")) for i in range(64)]
    pages = pages_of(spark, rows)
    for r in wrapper.extract(pages, ["page_id"]).collect():
        assert r.text == f"Steps\ntext {r.page_id}\nParts\nmore {r.page_id}"
    (template,) = wrapper.induce(pages).collect()
    forest = dom.Forest()
    assert forest.slots[forest.load(template.template)] == 704  # the menu's, and four of the article


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_extraction_query_on_article_pages(spark):
    """On pages with an article element the text is that of the element, block by block."""
    import re
    from html import unescape

    got = {r.page_id: r for r in QUERIES["op7_html_text"](spark, FOLDER).collect()}
    pages = duckdb.sql(f"SELECT * FROM '{FOLDER}/pages.parquet'").fetchall()
    assert len(got) == len(pages)
    for page_id, url, html in pages:
        inside = re.search(r"<article>(.*?)</article>", html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1|article)\b[^>]*>", inside)
        want = [" ".join(unescape(re.sub(r"<[^>]*>", " " if "br" in b else "", b)).split()) for b in blocks]
        text = "\n".join(w for w in want if w)
        assert got[page_id].text.replace(" ", "") == text.replace(" ", ""), page_id
        assert got[page_id].n_chars == len(got[page_id].text) and got[page_id].url == url


def test_template_and_varying_slots_without_article_elements(spark):
    page = """<body><div class="top"><a href=/>Home</a> <a href=/x>News</a></div>
      <div class="box"><h2>Title {0}</h2><div><p>{1} first words &lt;here&gt;</p><p>and {0} more text</p></div></div>
      <div class="c2">All rights by the same owner</div><div class="comments"><p>reader {0} says {1}</p></div></body>"""
    words = "alpha beta gamma delta epsilon zeta eta theta".split()
    rows = [(i, f"http://h.example/{i}", page.format(w, w * 3)) for i, w in enumerate(words)]
    got = {r.page_id: r.text for r in wrapper.extract(pages_of(spark, rows), ["page_id"]).collect()}
    for i, w in enumerate(words):
        assert got[i] == f"Title {w}\n{w * 3} first words <here>\nand {w} more text"


def test_extraction_of_hard_rows(spark):
    rows = [
        (1, None, None), (2, "http://a/", ""), (2, "http://a/", ""), (3, "x", "plain text"), (4, None, "<article>one</article>"),
        (5, "http://a/", "<main>" + "<p>w &copy;</p>" * 20_000 + "</main>"), (None, "http://b/", "<article><p>x<aside>no</aside><p>y"),
        (6, "http://c/", "<article><header><h1>T</h1><p>by me</p></header><p>t</p><section id=comments><article><p>c</p></article></section></article>"),
    ]
    df = pages_of(spark, rows).withColumn("text", F.lit("clash"))
    got = collections.defaultdict(list)
    for r in wrapper.extract(df, ["page_id", "url"]).collect():
        got[r.page_id].append(r.text)
    assert got[1] == [""] and got[2] == ["", ""] and got[4] == ["one"] and got[None] == ["x\ny"]
    assert got[5] == ["\n".join(["w ©"] * 20_000)] and got[6] == ["T\nt"]
    assert wrapper.extract(df.limit(0), ["page_id"]).count() == 0


def test_pages_without_article_on_a_host_with_articles(spark):
    post = '<body><div class=teaser><p>look at {0}</p></div><div class=post><p>{0} one</p><p>two{1}</p></div><div class=c2>by the same owner</div></body>'
    article = '<body><div class=teaser><p>{0} teases at great length {0} {0}</p></div><article><p>{0} text</p></article><div class=c2>by the same owner</div></body>'
    rows = [(i, f"http://h.example/{i}", (post if i % 3 else article).format(f"w{i}", f" w{i}" * 20)) for i in range(12)]
    rows += [(20, "x", "plain text"), (21, None, "<article>one</article>"), (22, "http://h.example/m", "<body><section><p>another layout</p></section></body>")]
    got = {r.page_id: r.text for r in wrapper.extract(pages_of(spark, rows), ["page_id"]).collect()}
    for i in range(12):
        assert got[i] == (f"w{i} one\ntwo" + f" w{i}" * 20 if i % 3 else f"w{i} text")
    assert got[20] == "plain text" and got[21] == "one" and got[22] == "another layout"


def test_words_of_class_and_id_do_not_drop_the_article(spark):
    bodies = {
        "a": "<div class=has-sidebar><div class=sidebar><p>x {0}</p></div><article><p>{0} text</p></article></div>",
        "b": "<div id=search-results><main class=with-comments><article class=news-alert><p>{0} text</p></article></main></div>",
        "c": "<article><h2 id=related-work>related {0}</h2><section id=discussion><p>{0} text</p></section><div class=share-box>tell {0}</div></article>",
        "d": "<article><div class='has-sidebar'><p>{0} text</p></div><div class='post-comments'><article class='comment even'>c {0}</article></div></article>",
        "e": "<div class=no-sidebar><p>{0} text</p><section id=discussion><p>more {0}</p></section></div><section class=comments><p>c {0}</p></section>",
        "f": "<div class=notice><h3 id=related-work>{0}</h3><p>{0} text</p></div><div class=footer>f {0}</div>",
    }
    rows = [(10 * n + i, f"http://{h}.example/{i}", f"<body>{b}</body>".format(f"w{i}")) for n, (h, b) in enumerate(bodies.items()) for i in range(6)]
    got = {r.page_id: r.text for r in wrapper.extract(pages_of(spark, rows), ["page_id"]).collect()}
    want = {"c": "related {0}\n{0} text", "e": "{0} text\nmore {0}", "f": "{0}\n{0} text"}
    for n, h in enumerate(bodies):
        for i in range(6):
            assert got[10 * n + i] == want.get(h, "{0} text").format(f"w{i}"), h
    for path in ("html article section.comments p", "html div.post.comments article p", "html body div.main.nav p", "html article nav p"):
        assert wrapper.beside(tuple(path.split()))


# ---- vectors


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


HARD = [
    (0, [1.0, 2.0], 0), (0, [1.0, 2.0], 0), (1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [float("nan"), 1.0], 0),
    (5, [float("inf"), 1.0], 0), (6, [None, 1.0], 0), (None, [1.0, 1.0], 0), (100, [1.0, 2.0], 0), (7, [1.0, 2.0], 0),
    (8, [5.0, -1.0], 0), (9, [1.0, 2.0, 3.0], 0), (200, [1.0, 1.0, 1.0], 0),
]


def test_nearest_recall(spark):
    got = QUERIES["op4_nearest"](spark, FOLDER).collect()
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{FOLDER}/embeddings.parquet'").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    hit = total = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((x - x[ids == q]) ** 2).sum(axis=1))
        d[ids == q] = np.inf
        best = np.lexsort((ids, d))[:10]
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 11))
        assert all(abs(r.score - d[ids == r.vec_id][0]) < 1e-12 for r in mine)
        hit += len({r.vec_id for r in mine} & set(ids[best].tolist()))
        total += 10
    assert hit / total >= 0.97


def test_nearest_of_hard_rows(spark):
    df = vectors_of(spark, HARD).withColumn("norm", F.lit("clash"))
    got = sorted(map(tuple, onebit.nearest(df, asks=100, top=3).collect()))
    assert got == [
        (0, 1, 7, 0.0), (0, 2, 100, 0.0), (0, 3, 8, 5.0), (100, 1, 0, 0.0), (100, 2, 0, 0.0), (100, 3, 7, 0.0),
        (200, 1, 9, pytest.approx(5**0.5)),
    ]
    assert onebit.nearest(df.limit(0), asks=100).count() == 0


@pytest.mark.parametrize("scale", [1, 1000])
def test_dual_tree_is_exact(scale):
    rng = np.random.default_rng(3)
    x = np.floor(rng.normal(size=(3000, 6)) * 20 * scale)
    x[:500] = x[0]
    q = x[::60].copy()
    ids = rng.permutation(3000)
    own = ids[::60]
    got = collections.defaultdict(list)
    for query, row, score in covertree.dual(x, ids, q, own, 5):
        got[query].append((-score, row))
    for query, v in zip(own, q):
        score = (x @ v).astype(int)
        want = sorted((-int(s), int(i)) for s, i in zip(score, ids) if i != query)[:5]
        assert sorted(got[query]) == want


def test_products_of_hard_rows(spark):
    df = vectors_of(spark, [*HARD, (50, [3e18, 1.0], 0), (10, [-0.001, 0.001], 0)]).withColumn("score", F.lit("clash"))
    got = sorted(map(tuple, covertree.largest(df, asks=50, top=2).collect()))
    assert [g[:3] for g in got if g[0] == 200] == [(200, 1, 9)]
    assert [g[2] for g in got if g[0] == 0] == [50, 7]
    assert [g for g in got if g[0] == 50][0][3] == (1 << 63) - 1
    assert covertree.largest(df.limit(0), asks=50).count() == 0


def test_constant_paragraphs_of_an_article_stay(spark):
    page = """<body><div class=top><p>Same on all pages</p></div><article><h1>Dish {0}</h1><p>Serves four people.</p><p>Take {0} spoons of salt.</p>
      <div class=share><p>Tell a friend</p></div></article><div class=c2>All rights</div></body>"""
    rows = [(i, "http://h.example/", page.format(i)) for i in range(12)]
    for r in wrapper.extract(pages_of(spark, rows), ["page_id"]).collect():
        assert r.text == f"Dish {r.page_id}\nServes four people.\nTake {r.page_id} spoons of salt."
