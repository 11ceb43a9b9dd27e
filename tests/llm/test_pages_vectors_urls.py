"""Operators on pages, vectors and URLs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewheel.llm import components, jaccard, pages, tables, urls, vectors


def page(body, head="<title>t</title>"):
    return f"<!DOCTYPE html><html><head>{head}<script>var a='</p>';</script></head><body>{body}</body></html>"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain  &amp; text", "plain & text"),
        (page("<nav>menu</nav><article><h1>A&nbsp;b</h1><p><b>one.<br><p>two\n three</p></article><footer>f</footer>"), "A b\none.\ntwo three"),
        (page("<div class='ad x'>buy</div><div>said <i>so</i>, yes</div><div id=comments><p>c</p></div>"), "said so, yes"),
        (page("<form><article><p>in a form</p></article><button>go</button></form>"), "in a form"),
        (page("<main><h1>T</h1><ul><li>a<li>b</ul><aside>s</aside><table><tr><td>1<td>2</table></main><p>out</p>"), "T\na\nb\n1\n2"),
        (page("<p>1 < 2 & 3 &lt; 4 &#x41;&#66;</p><!-- <p>no</p> --><style>p{}</style>"), "1 < 2 & 3 < 4 AB"),
        (page("<article><p>a</p><section class='reader-comments'><p>c</p></section><div class='share'>s</div></article>"), "a"),
        ("<p>open <b>never closed", "open never closed"),
        ("<p" * 3000 + "x", "<p" * 3000 + "x"),
    ],
)
def test_main_text(html, text):
    assert pages.main_text(html, {}) == text


@pytest.mark.parametrize(
    "tag", ['div class="content no-sidebar"', 'article class="post has-sidebar"', 'div class="article-with-comments"', 'main id="search-article"', 'div class="alert-story"', 'section class="widget"']
)
def test_a_word_in_a_class_does_not_drop_the_article(tag):
    name = tag.split()[0]
    text = "The story itself, which is longer than all around it."
    inner = f"<h1>Title</h1><p>{text}</p><div class='comments'><p>First!</p></div><p class=share-this>Share</p>"
    assert pages.main_text(page(f"<div class=ad>buy</div><{tag}>{inner}</{name}><div class='related-links'>more</div>"), {}) == f"Title\n{text}"


def test_a_page_that_is_only_an_advert_is_empty():
    assert pages.main_text(page("<div class=ad><p>Buy now</p></div>"), {}) == ""
    assert pages.main_text(page("<p>in a <b class=x>line</b> <span class=ad>buy</span> on</p><div role=banner>b</div>"), {}) == "in a line\non"


@pytest.mark.parametrize("tag", ["div", "font", "b", "section class=x1"])
def test_deep_pages(spark, tag):
    deep = page(f"<{tag}>" * 5000 + "<div>deep text</div>" + f"</{tag.split()[0]}>" * 20)
    rows = [(i, f"http://h.org/{i}", deep.replace("deep", f"deep {i}")) for i in range(3)] + [(9, "http://h.org/9", page("<p>plain</p>"))]
    got = {r.page_id: r.text for r in pages.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {0: "deep 0 text", 1: "deep 1 text", 2: "deep 2 text", 9: "plain"}


@pytest.mark.parametrize("broadcast", [True, False])
def test_the_template_alone_removes_what_no_tag_tells(spark, monkeypatch, broadcast):
    """A menu in a table and a footer in a list: with the template they go, without it they stay, whichever way it comes."""
    if not broadcast:
        monkeypatch.setattr(pages, "BROADCAST_PLACES", 0)
        monkeypatch.setattr(pages, "PART", 7)

    def html(i):
        own = " ".join(f"own{i}word{k}" for k in range(30))
        return page(f"<table><tr><td>Home<td>About us</table><div><p>{own}</p></div><ul><li>Imprint and contact</ul>"), own

    rows = [(i, f"http://{'a' if i % 3 else 'b'}.org/{i}", html(i)[0], "x") for i in range(40)] + [(99, None, html(99)[0], "y")]
    out = pages.extracted(spark.createDataFrame(rows, "page_id long, url string, html string, host string"))
    assert out.columns == ["page_id", "url", "host", "text", "n_chars"]
    got = {r.page_id: r.text for r in out.collect()}
    assert all(got[i] == html(i)[1] for i in range(40))
    assert got[99] == f"Home\nAbout us\n{html(99)[1]}\nImprint and contact"
    assert pages.main_text(html(1)[0], {}) == f"Home\nAbout us\n{html(1)[1]}\nImprint and contact"


def test_simple_tree_matching_against_all_matchings():
    def size(node):
        return 1 + sum(map(size, node[3]))

    def plain(a, b):
        if a[0] != b[0]:
            return 0

        def best(x, y):
            if not x or not y:
                return 0
            return max(best(x[1:], y), best(x, y[1:]), best(x[1:], y[1:]) + plain(x[0], y[0]))

        return 1 + best(a[3], b[3])

    rng = random.Random(4)

    def grow(depth):
        return (rng.choice("ab") if depth < 3 else "a", "", 0, [grow(depth - 1) for _ in range(rng.randint(0, 3))] if depth else [])

    for _ in range(60):
        a, b = grow(3), grow(3)
        n, pairs = pages.matching(a, b)
        assert n == plain(a, b) <= min(size(a), size(b)) and len(pairs) == n


def test_wrapper_leaves_out_what_a_host_repeats(spark):
    def html(i):
        return page(f"<div class=top>Our site since 1999</div><div class=text><p>own words {i}</p></div><div class=low>All rights</div>")

    rows = [(i, f"http://A.example.org/{i}", html(i), "e") for i in range(6)] + [(9, None, html(9), "e"), (10, "x", None, None), (9, None, html(9), "e")]
    out = pages.extracted(spark.createDataFrame(rows, "page_id long, url string, html string, n_chars string"))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = {r.page_id: (r.text, r.n_chars) for r in out.collect()}
    assert got[3] == ("own words 3", 11) and got[10] == ("", 0)
    assert got[9][0] == "Our site since 1999\nown words 9\nAll rights" and out.count() == 9
    assert pages.extracted(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("tag", ["article", "div"])
def test_near_copies_do_not_make_their_text_template(spark, tag):
    def html(i, title, text):
        return page(f"<div class=top>to {i} and {i * 7}</div><{tag}><h1>{title}</h1><p>{text}</p></{tag}><div class=low>All rights</div>")

    shared = "Shared words that all copies have. More of them in a second sentence."
    rows = [(i, f"http://a.org/{i}", html(i, "Shared", shared)) for i in range(20)] + [(20, "http://a.org/own", html(20, "Own title", "Quite another text, of this page alone."))]
    rows += [(30 + i, f"http://b.org/{i}", html(i, "Shared", shared)) for i in range(2)] + [(32, "http://b.org/own", html(9, "Own title", "Quite another text, of this page alone."))]
    got = {r.page_id: r.text for r in pages.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in (20, 32):
        assert "Own title\nQuite another text, of this page alone." in got[i]
    assert all(f"Shared\n{shared}" in got[i] for i in (*range(20), 30, 31))


def test_article_copies_on_many_pages_stay(spark):
    text = " ".join(f"Sentence {k} of the article." for k in range(30))
    rows = [(i, f"http://a.org/{i}", page(f"<div class=top>to {i}</div><article><h1>T</h1><p>{text} Copy {i}.</p></article>")) for i in range(300)]
    rows += [(1000 + i, f"http://a.org/o{i}", page(f"<div class=top>to {i}</div><article><h1>Own {i}</h1><p>{'own%d ' % i * 20}</p></article>")) for i in range(3)]
    got = {r.page_id: r.text for r in pages.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(f"T\n{text} Copy {i}." in got[i] for i in range(300)) and all(f"Own {i}\nown{i} own{i}" in got[1000 + i] for i in range(3))


def test_an_article_card_is_not_the_page(spark):
    def html(i):
        own = " ".join(f"word{i}x{k}" for k in range(40))
        return page(f"<div class=top>Our site</div><article class=card><h3>Card {i}</h3></article><div class=text><p>{own}</p></div><div class=low>All rights</div>"), own

    rows = [(i, f"http://{'a.org' if i < 6 else f'h{i}.org'}/{i}", html(i)[0]) for i in range(8)]
    got = {r.page_id: r.text for r in pages.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(6)] == [f"Card {i}\n{html(i)[1]}" for i in range(6)]
    assert all(html(i)[1] in got[i] for i in (6, 7))  # a host of one page


def links_of(x, threshold=0.95):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = unit @ unit.T >= threshold
    np.fill_diagonal(close, False)
    root = np.arange(len(x))
    for _ in range(len(x)):
        new = np.array([min([root[i], *root[close[i]]]) for i in range(len(x))])
        if (new == root).all():
            break
        root = new
    return close.sum(1), root


def test_vectors_recall_and_components(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(300, 32))
    near = base[rng.integers(0, 40, 300)] + 0.1 * rng.normal(size=(300, 32))
    hot = base[0] + 0.15 * rng.normal(size=(200, 32))
    x = np.vstack((base, near, hot, base[:20])).astype(np.float32).astype(np.float64)
    df = spark.createDataFrame([(i, v.tolist(), 3) for i, v in enumerate(x)], "vec_id long, embedding array<float>, node int").repartition(4)
    out = {r.vec_id: r for r in vectors.near_vectors(df, cell=16, block=32).collect()}
    n, root = links_of(x)
    found = sum(r.n_links for r in out.values())
    assert len(out) == len(x) and all(out[i].n_links <= n[i] for i in out)
    assert found >= 0.95 * n.sum() > 1000
    assert sum(out[i].component_id == root[i] for i in out) >= 0.95 * len(x)
    assert all(r.kept == (r.vec_id == r.component_id) for r in out.values())


def test_vectors_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, None]), (8, []), (9, [1.0, 0.0, 0.0]), (10, [3.0, 0.0, 0.1]), (None, [1.0, 0.0]), (1, [1.0, 0.0])]
    got = sorted(((r.vec_id or -1, r.n_links, r.component_id) for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (2, 2, 1), *((i, 0, i) for i in range(3, 9)), (9, 1, 9), (10, 1, 9), (-1, 0, None)], key=str)
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_two_equal_vectors_beside_longer_ones(spark):
    rows = [(i, [float(i), 1.0, -1.0]) for i in range(1, 6)] + [(20, [5.0, 1.0]), (21, [5.0, 1.0])]
    got = {r.vec_id: r.n_links for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got[20] == got[21] == 1 and len(got) == 7


def test_registered_recall_at_production_constants(spark):
    """The query's links of vectors whose id is divisible by 20, against brute force over the whole table."""
    from tidewheel.llm import catalog
    from tidewheel.llm.tables import read

    folder = "/root/testdata/sf0.01"
    got = {r.vec_id: r.n_links for r in catalog.QUERIES["op7_embedding_near_dedup"](spark, folder).collect()}
    table = read(spark, folder, "embeddings").where("embedding IS NOT NULL").orderBy("vec_id").collect()
    x = np.array([r.embedding for r in table], np.float64)
    n, _ = links_of(x)
    asked = [i for i, r in enumerate(table) if r.vec_id % 20 == 0]
    assert sum(got[table[i].vec_id] for i in asked) >= 0.9 * sum(n[i] for i in asked)
    assert all(got[table[i].vec_id] <= n[i] for i in range(len(table)))


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(160)] + [(i, i + 1) for i in range(400, 440)] + [(500, i) for i in range(501, 560)]
    n = 600
    root = list(range(n))
    for _ in range(n):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in components.smallest_reachable(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {v: root[v] for e in edges if e[0] != e[1] for v in e}


def test_hubs_are_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(components, "HUB", 3)
    edges = [(50, i) for i in range(400)] + [(1000, i) for i in range(400, 700)] + [(700, 3), (900, 901)]
    got = {r.node: r.root for r in components.smallest_reachable(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys([*range(400), 700], 0), **dict.fromkeys([*range(400, 700), 1000], 400), 900: 900, 901: 900}


def test_rows_with_facts_of_heavy_and_other_keys(spark):
    rows = spark.createDataFrame([(7, i) for i in range(500)] + [(8, i) for i in range(3)] + [(9, 0), (None, 1)], "k long, v long")
    facts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("k < 9")
    got = tables.with_fact(rows.repartition(4), facts, "k", "n", F.col("n") > 100, "v")
    assert sorted(got.collect()) == [(7, i, 500) for i in range(500)] + [(8, i, 3) for i in range(3)]
    assert got.columns == ["k", "v", "n"]
    # the rows of the heavy key reach the second join in more than one task
    tasks = got.withColumn("task", F.spark_partition_id()).where("k = 7").select("task").distinct()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert tasks.count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ranks_of_cells_are_those_of_the_visits():
    rng = np.random.default_rng(5)
    x = vectors.unit(rng.normal(size=(300, 8)))
    index = vectors.Index(x[:9, :4].copy(), x[9:20, 4:].copy())
    cells, _ = index.visited(x, 99)
    to = rng.integers(0, 99, len(x))
    assert (index.rank(x, to) == (cells == to[:, None]).argmax(1) + 1).all()


def test_common_counts(monkeypatch):
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 90, rng.integers(1, 60)).astype(np.uint32)) for _ in range(12)]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]
    assert jaccard.common_counts(sets).tolist() == want
    monkeypatch.setattr(jaccard, "CELLS", 12 * 7)
    assert jaccard.common_counts(sets).tolist() == want


RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def test_listed_rules(spark):
    rows = [
        (1, "http://M.Example.ORG/es/7?x#y"), (2, "https://example.org/en/1"), (3, "https://example.org"), (4, "http://notexample.org/es/"), (5, "http://a.com/de/"),
        (6, None), (7, "no scheme"), (8, "http://a.com?q=/de/"), (9, "x://b.com/fr/#://c.org/"), (1, "http://M.Example.ORG/es/7?x#y"),
    ]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, verdict string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = sorted((tuple(r) for r in urls.judged(df, labels, RULES).collect()), key=str)
    assert got == sorted(
        [
            (1, "m.example.org", "/es/7", "example.org/es/", "block"), (1, "m.example.org", "/es/7", "example.org/es/", "block"), (2, "example.org", "/en/1", "example.org/en/1", "block"),
            (3, "example.org", "", None, "allow"), (4, "notexample.org", "/es/", "org/", "allow"), (5, "a.com", "/de/", "com/de/", "block"), (6, "", "", None, "allow"),
            (7, "", "", None, "allow"), (8, "a.com", "", None, "allow"), (9, "b.com", "/fr/", "com/fr/", "allow"),
        ],
        key=str,
    )


def plain_rules(labelled, min_support, min_confidence):
    """All sets of tokens that say "block" often and surely enough."""
    from itertools import combinations

    sets = [(set(t), b) for t, b in labelled]
    every = sorted({x for t, _ in sets for x in t})
    out = []
    for size in range(1, 6):
        for some in combinations(every, size):
            have = [b for t, b in sets if set(some) <= t]
            if have and sum(have) / len(sets) >= min_support and sum(have) / len(have) >= min_confidence:
                out.append(set(some))
    return out


def test_mined_verdicts_are_those_of_all_rules(spark):
    rng = random.Random(6)

    def url(i):
        host = ".".join(rng.choice([["a", "b", "x", "net"], ["b", "x", "net"], ["c", "net"], ["d", "x", "com"]]))
        return f"http://{host}/" + "/".join(rng.sample(["p", "q", "r"], rng.randint(0, 2))) + rng.choice(["", "?k=1"])

    rows = [(i, url(i)) for i in range(300)]
    labels = [(i, int(rng.random() < (0.9 if "/q" in u and "net" in u else 0.1) or "d.x" in u and "k=" in u) ^ 1, 0) for i, u in rows if i < 200]
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = urls.judged(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), [], 0.05, 0.7)
    own = df.select("page_id", urls.tokens(df["url"], urls.host(df["url"]), urls.path(df["url"])).alias("t")).collect()
    own = {r.page_id: r.t for r in own}
    rules = plain_rules([(own[i], q == 0) for i, q, _ in labels], 0.05, 0.7)
    want = {i: "block" if any(r <= set(t) for r in rules) else "allow" for i, t in own.items()}
    assert {r.page_id: r.verdict for r in got.collect()} == want
    assert {"block", "allow"} == set(want.values())


def test_a_host_of_many_labels_gives_few_rules(spark):
    from pyspark.sql import functions as F

    host = ".".join(f"l{i}" for i in range(18))
    rows = [(i, f"http://{host}/page/{i}") for i in range(200)] + [(1000 + i, f"http://{host.split('.', i)[-1]}/page/{i}") for i in range(1, 17)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    tokens = urls.tokens(df["url"], urls.host(df["url"]), urls.path(df["url"]))
    labelled = df.select(tokens.alias("tokens"), F.lit(True).alias("block"), F.col("page_id").alias("row"))
    items = urls.items_of_tokens(labelled)
    assert urls.mined_rules(labelled, items).count() <= 18
    labels = spark.createDataFrame([(i, 0, 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    assert {r.verdict for r in urls.judged(df, labels, []).collect()} == {"block"}
    empty = spark.createDataFrame([], "page_id long, url string, host string")
    assert urls.judged(empty, labels, []).count() == 0


def test_mined_rules_block(spark):
    """casino under .net is bad, casino or .net alone are not: the rule needs both tokens."""
    rows, labels, n = [], [], 0
    for where, what, bad in (("net", "casino", 0), ("net", "news", 1), ("com", "casino", 1), ("com", "news", 1)):
        for i in range(40):
            rows.append((n, f"http://h{i % 3}.{where}/{what}/{i}?p={i}"))
            if i < 30:
                labels.append((n, bad, 0))
            n += 1
    got = urls.judged(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), RULES, 0.05, 0.9)
    assert {(r.verdict, ".net" in r.host and "casino" in r.path) for r in got.collect()} == {("block", True), ("allow", False)}
