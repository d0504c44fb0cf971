from strata.llm import html_extract as H

PAGES = [
    (1, "http://a.com/1", "<html><head><title>T</title><style>p{}</style></head><body><nav><a>Menu</a></nav>"
     "<article><h1>Head&amp;er</h1><p><b>One <i>two</i><br><p>Three&nbsp;four &#233;\n x</p><aside>side</aside></article>"
     "<footer>foot</footer></body></html>", "Head&er\nOne two\nThree four é x"),
    (2, "http://a.com/2", "<div class='x'>Join us now</div><div><p>Own text 2</p></div><!-- c --><script>var a='</p>';</script>",
     "Own text 2"),
    (3, "http://a.com/3", "<div class='x'>Join us  now</div><div><p>Own text 3</p><div id=comments><p>nice!</p></div></div>",
     "Own text 3"),
    (4, "http://a.com/4", "<DIV CLASS=x>Join us now</DIV><ul><li>Item 4<li>Item 44</ul><form>f</form>", "Item 4\nItem 44"),
    (5, "http://b.com/5", "<div class='x'>Join us now</div><p>B", "Join us now\nB"),
    (6, None, None, ""),
    (7, "http://c.com/", "", ""),
    (8, "http://c.com/8", "plain < text <b>bold</b> & more <!-- never closed <p>gone", "plain < text bold & more"),
    (9, "http://c.com/9", "<main><header>In</header><p>x<script>", "In\nx"),
    (10, "http://c.com/10", "<header>Out</header><p>" + "word " * 50_000, ("word " * 50_000).strip()),
    (11, "http://c.com/11", "<p title='a>b'>q</p></div></p><table><tr><td>1<td>2</table>", "q\n1\n2"),
]


def test_texts(spark):
    df = spark.createDataFrame([(p, u, h, "clash") for p, u, h, _ in PAGES], "page_id long, url string, html string, host string")
    df = df.unionByName(df.where("page_id = 1"))
    rows = H.extract(df).collect()
    assert len(rows) == len(PAGES) + 1
    want = {p: t for p, _, _, t in PAGES}
    assert {r["page_id"]: r["text"] for r in rows} == want


def test_article_copies_are_kept_and_template_goes(spark):
    page = "<div>Site line</div><article><p>The same story on every page</p></article><div>Last line</div>"
    other = "<div>Site line</div><p>Only page {0}</p><div>Last line</div>"
    rows = [(i, "http://h.org/x", page if i % 2 else other.format(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in H.extract(df).collect()}
    assert got == {i: "The same story on every page" if i % 2 else f"Only page {i}" for i in range(40)}


def markup(node):
    return node if isinstance(node, str) else f"<{node[0]}>{''.join(map(markup, node[1]))}</{node[0]}>"


def kept(node, gone):
    """Blocks of a tree of (tag, children) without the subtrees in ``gone``."""
    if isinstance(node, str):
        return [node]
    return [] if node in gone else [b for c in node[1] for b in kept(c, gone)]


def subtrees(node, inside=False):
    if not isinstance(node, str):
        yield node, inside
        for c in node[1]:
            yield from subtrees(c, inside or node[0] == "article")


def test_extract_against_brute_force(spark):
    """Pages built as trees of blocks, with and without an article; templates counted by comparing whole trees."""
    import random
    rng = random.Random(12)
    bars = [("div", (("p", (f"bar {k}",)),)) for k in range(6)]
    pages = []
    for i in range(160):
        story = tuple(("p", (f"story {rng.randrange(40)}",)) for _ in range(rng.randrange(1, 4)))
        box = (("div", ("share this",)),) if rng.random() < 0.8 else ()
        own = (("div", (("p", (f"own {i}",)), *box)),)
        top = tuple(rng.sample(bars, rng.randrange(3)))
        body = (*top, ("article", (*story, *own)), ("p", ("after",))) if i % 3 else (*top, *story, *own, ("p", ("after",)))
        pages.append((i, f"http://h{i % 2}.org/{i}", body))
    pages += [(160 + i, u, b) for i, (_, u, b) in enumerate(pages[:30])]  # copies count once

    def article(body):
        return next((n for n in body if n[0] == "article"), None)

    def texts_of(body):
        return "\n".join(b for n in ([article(body)] if article(body) else body) for b in kept(n, ()))

    counts, hosts = {}, {}
    for _, u, body in pages:
        hosts.setdefault(u[7:9], set()).add(texts_of(body))
        for n, inside in {x for top in body for x in subtrees(top)}:
            counts.setdefault((u[7:9], n, inside), set()).add(texts_of(body))
    want, changed = {}, 0
    for i, u, body in pages:
        few = {n for top in body for n, inside in subtrees(top) if not inside and n[0] != "article"
               and len(counts[u[7:9], n, False]) >= 3}
        many = {n for top in body for n, inside in subtrees(top) if inside and n[0] == "div"
                and len(counts[u[7:9], n, True]) >= max(H.INSIDE_PAGES, H.INSIDE_SHARE * len(hosts[u[7:9]]))}
        roots = [article(body)] if article(body) else body
        want[i] = "\n".join(b for n in roots for b in kept(n, many if article(body) else few))
        changed += want[i] != texts_of(body)
    df = spark.createDataFrame([(i, u, "".join(map(markup, b))) for i, u, b in pages],
                               "page_id long, url string, html string").repartition(4)
    assert {r["page_id"]: r["text"] for r in H.extract(df).collect()} == want
    assert changed > 100 and any("share this" in t for t in want.values()) is False


def test_passages_inside_articles_stay(spark):
    """Near copies of an article on a third of a host's pages, and boxes on less than half of them."""
    rows = [(i, "http://h.org/x", f"<article><p>{'the told story' if i % 3 == 0 else f'tale {i}'}</p>"
             f"<div>{'shared box' if i % 9 < 4 else f'box {i}'}</div><p>end {i}</p></article>") for i in range(90)]
    got = {r["page_id"]: r["text"] for r in H.extract(spark.createDataFrame(
        rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"{'the told story' if i % 3 == 0 else f'tale {i}'}\n"
                   f"{'shared box' if i % 9 < 4 else f'box {i}'}\nend {i}" for i in range(90)}


def test_ids_and_columns_stay(spark):
    rows = [(None, "http://a.org/1", "<p>a</p>", "h", 7), ((1 << 53) + 1, "http://a.org/2", "<p>b</p>", None, None),
            ((1 << 53) + 2, None, None, "h", 8), ((1 << 53) + 1, "http://a.org/2", "<p>b</p>", None, None)]
    got = H.extract(spark.createDataFrame(rows, "page_id long, url string, html string, host string, page long")
                    .selectExpr("*", "'t' AS template", "1 AS path", "'old' AS text"))
    assert got.columns == ["page_id", "url", "host", "page", "template", "path", "text"]
    assert sorted((r.page_id or 0, r.host, r.page, r.template, r.text) for r in got.collect()) == [
        (0, "h", 7, "t", "a"), ((1 << 53) + 1, None, None, "t", "b"), ((1 << 53) + 1, None, None, "t", "b"),
        ((1 << 53) + 2, "h", 8, "t", "")]


def test_empty(spark):
    assert H.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


NAMED = [
    ("<main class='has-sidebar'><p>a</p></main>", "a"),
    ("<div class='content-sidebar-wrap'><article class='post category-social'><header class='entry-header'><h1>T</h1>"
     "</header><p>a</p></article></div>", "T\na"),
    ("<div class='sidebar'><main><p>a</p></main></div>", "a"), ("<div id=header><main><p>a</p></main></div>", "a"),
    ("<article class='comments banner'><h2 id=comments>C</h2><div class=header>In</div><p>a</p></article>", "C\nIn\na"),
    ("<section class='related-work'><p>a</p></section><div class='share-price widget'>b</div><p class=notice>c</p>", "a\nb\nc"),
    ("<div class='x sidebar'>s</div><div id=AD>s</div><div class=header>out</div><header class=big>out</header><p>a</p>", "a"),
    ("<article><p>MAIN</p></article><div id='comments' class='comments-area'><article class='comment-body'>first</article>"
     "<article>second</article></div>", "MAIN"),
    ("<main><p>MAIN</p><section class='related-posts'><article>card</article></section></main>", "MAIN"),
    ("<main><p>MAIN</p><article class=comment><p>c</p></article></main>", "MAIN"),
    ("<div class='comments'><article>a longer one</article><article>short</article></div>", "a longer one\nshort"),
    ("<div id=responses><article class=comment>c</article></div><p>a</p>", "c"),
    ("<body hidden><p>h</p></body>", "h"), ("<article role=banner>b</article><p>a</p>", "a"),
]


def test_names_mark_only_what_they_name():
    for source, text in NAMED:
        assert H.Page(source).text() == text


def test_template_needs_few_pages_of_a_large_host_but_different_texts(spark):
    rows = [(i, "http://h.org/x", ("<div>Rare notice</div>" if i < 5 else "") + f"<p>Only page {i}</p>") for i in range(400)]
    rows += [(400 + i, "http://h.org/c", f"<div>Rare notice</div><p>The same story</p><!-- {i} -->") for i in range(9)]
    rows += [(500 + i, "http://twice.org/c", "<p>Told again</p>") for i in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = {r["page_id"]: r["text"] for r in H.extract(df).collect()}
    assert got == {**{i: f"Only page {i}" for i in range(400)}, **{400 + i: "The same story" for i in range(9)},
                   **{500 + i: "Told again" for i in range(9)}}
