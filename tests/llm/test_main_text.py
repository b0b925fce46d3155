"""Main text: tag soup, noise by name, templates by count."""

from __future__ import annotations

import html
import re

from ledgerlake.llm import main_text
from ledgerlake.llm.main_text import Page
from ledgerlake.llm.queries import QUERIES
from tests.llm.common import SF

PAGES = "page_id long, url string, html string"


def simple_truth(source: str) -> str:
    """For the generated pages: what stands in article, a block for each h1 and p."""
    article = re.search(r"<article>(.*?)(?:</article>|$)", source or "", re.S)
    parts = re.split(r"</?(?:p|h1)>", article[1]) if article else []
    blocks = [" ".join(html.unescape(re.sub("<[^>]*>?", " ", part)).split()) for part in parts]
    return "\n\n".join(block for block in blocks if block)


def test_query(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = QUERIES["op8_site_templates"](spark, SF).collect()
    assert len(rows) == len(pages)
    assert all(r.text == simple_truth(pages[r.page_id]) and r.n_chars == len(r.text) for r in rows)


def test_noise_by_element_class_id_and_role():
    page = Page(
        "<body><header>Site <b>X</b></header><div id='cookie-notice'>cookies</div><div role=navigation>nav</div>"
        "<article class='post'><header><h1>T &amp; t</h1></header><p>a<p>b <br>c<ul><li>x<li>y</ul><div class=adBox>buy</div>"
        "<section class='comments'><article class='comment'>nice</article></section></article>"
        "<aside>side</aside><form>f<input></form><footer>foot</footer><div>not in the article</div>"
    )
    assert page.text() == "T & t\n\na\n\nb c\n\nx\n\ny"


def test_tag_soup():
    assert Page("plain &amp <b>text").text() == "plain & text"
    assert Page("<div><p>a</div>b<p>c<table><tr><td>d<td>e</table><script>x</scr").text() == "a\n\nb\n\nc\n\nd\n\ne"
    assert Page("a<a href=\"x").text() == "a"
    assert Page("<script>var t='</p>';</script><style>p{}</style>x<!-- <p>y").text() == "x"
    assert Page("</div></p>a</b>   b<p>&lt;i&gt;").text() == "a b\n\n<i>"
    assert Page("").text() == "" and Page("<>").text() == "<>"
    assert Page("<div>" * 3000 + "deep" + "</p>" * 3000).text() == "deep"


def test_templates_are_counted_per_host(spark):
    """A line on all pages of one host goes there, and stays on a host where it is rare."""
    line = "<div>Read our great magazine every week</div>"
    rows = [(k, f"http://a.example/{k}", f"<body>{line}<p>story {k}</p><div>copied</div></body>") for k in range(12)]
    rows += [(100 + k, f"https://B.example:80/{k}", f"<body>{line if k == 0 else ''}<p>tale {k}</p></body>") for k in range(12)]
    rows += [(200 + k, None, f"<body>{line}</body>") for k in range(8)]
    rows += [(300 + k, f"http://a.example/x{k}", f"<article><p>{'same' if k < 6 else k}</p></article>") for k in range(12)]
    found = {r.page_id: r.text for r in main_text.extracted(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(found[k] == f"story {k}" for k in range(12))
    assert found[100] == "Read our great magazine every week\n\ntale 0" and found[101] == "tale 1"
    assert all(found[200 + k] == "Read our great magazine every week" for k in range(8))
    # Copied articles are no template: they recur on fewer than half of the host's pages.
    assert all(found[300 + k] == "same" for k in range(6))


def test_odd_rows(spark):
    rows = [(1, "http://h/x", None), (2, None, ""), (None, "no url", "<p>a"), (4, "http://h/x", "<p>" + "w " * 200_000), (4, "http://h/x", "<p>b")]
    pages = spark.createDataFrame([(*r, "t", 3) for r in rows], PAGES + ", text string, host int")
    found = main_text.extracted(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(r.n_chars for r in found.collect()) == [0, 0, 1, 1, 399_999]
    assert main_text.extracted(pages.where("false")).count() == 0


def test_article_within_noise():
    """A form or a noisy-named wrapper around the article is none; teasers and comments stay out."""
    assert Page("<body><form id=form1><div>menu</div><article><h1>T</h1><p>a</article></form>").text() == "T\n\na"
    for name in ("class='wrapper with-sidebar'", "class='site nav-open'", "id=has-header"):
        assert Page(f"<body><div {name}><nav>n</nav><article><p>a<div class=share>s</div></article></div>").text() == "a"
        assert Page(f"<main><div {name}><h1>T</h1><article><p>a long one</article></div></main>").text() == "T\n\na long one"
    assert Page("<div class=with-sidebar><div role=main><p>a</div><aside><article>x</article></aside></div>").text() == "a"
    assert Page("<article><p>story</article><div class=related><article>tip</article></div>").text() == "story"
    assert Page("<p>a story<aside><article>tip</article></aside>").text() == "a story"
    assert Page("<p>a<div class=comments><article>a long comment</article></div>").text() == "a"
    assert Page("<body><form id=form1><nav>menu</nav><p>no article element</p></form>").text() == "no article element"


def test_head_without_end_tag():
    assert Page("<html><head><title>t</title><body><p>x").text() == "x"
    assert Page("<html><head><meta charset=utf-8><link rel=x><p>x<div>y").text() == "x\n\ny"
    assert Page("<head><script>s</script><noscript><style>a</style><img></noscript> plain").text() == "plain"
    assert Page("<head><noscript><p>n<body><p>x").text() == "x"


def test_templates_of_a_large_host(spark, monkeypatch):
    """Below the share, what has many different surroundings goes, and copied articles stay."""
    monkeypatch.setattr(main_text, "MANY", 20)
    box, copy = "<div>Our magazine</div>", "<p>A copied story that is long</p><p>and ends</p>"
    rows = [(k, "http://h/", f"<body>{box if k < 30 else ''}<p>the story of number {k}</p><h2>So</h2></body>") for k in range(500)]
    rows += [(1000 + k, "http://h/", f"<body><div>on day {k}</div>{copy}</body>") for k in range(40)]
    rows += [(2000 + k, "http://h/", f"<article>{box if k < 99 else ''}<p>the tale of number {k}</article>") for k in range(200)]
    rows += [(3000 + k, "http://h/", f"<div>on day {k}</div><article>{copy}</article>") for k in range(40)]
    found = {r.page_id: r.text for r in main_text.extracted(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(found[k].split("\n\n")[0] == f"the story of number {k}" for k in range(500))
    assert all(found[1000 + k] == f"on day {k}\n\nA copied story that is long\n\nand ends" for k in range(40))
    assert all(found[2000 + k] == f"the tale of number {k}" for k in range(200))
    assert all(found[3000 + k] == "A copied story that is long\n\nand ends" for k in range(40))


def test_names_alone_take_nothing_from_an_article():
    for noisy in (
        "<div class='entry-header'><h1>x</h1></div>", "<h2 class='section-header'>x</h2>", "<section class=discussion><p>x</section>",
        "<p class='social-history'>x</p>", "<p id='form-of-government'>x</p>", "<p class='ad-hoc-notes'>x</p>", "<p class='menu-prices'>x</p>",
        "<fieldset>x</fieldset>", "<label>x</label>", "<dialog>x</dialog>", "<header>x</header>", "<code class='hljs-comment comment'>x</code>",
    ):
        assert Page(f"<article>{noisy}<p>a text</p></article>").text() == "x\n\na text"
    for noise in ("<div class='ad-box'>x</div>", "<div id=comments>x</div>", "<form>x</form>", "<div role=form>x</div>", "<div class=sidebarLeft>x</div>"):
        assert Page(f"<article>{noise}<p>a text</p></article>").text() == "a text"


def neutral(source: str) -> str:
    """The page with all block elements as plain divs and no names; links stay links.

    Paragraphs without an end tag get theirs first: a div has no other to end it.
    """
    body = re.sub(r"(?s).*<body>", "", source)
    body = re.sub(r"(?s)<p>((?:(?!</?p>|</article>).)*)(?=<p>|</article>)", r"<p>\1</p>", body)
    return "<body>" + re.sub(r"<(/?)(?:nav|ul|li|article|footer|h1|p|div)(?: class=\"[^\"]*\")?>", r"<\1div>", body)


def test_menus_and_footers_of_neutral_pages(spark):
    """Without tags and names, what recurs by shape goes, and shapes take no word of an article.

    Lines that stand on a tenth of these pages of one host go as they did before, by their words.
    """
    pages = [r for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect() if r.html and "<article>" in r.html]
    rows = [(r.page_id, "http://one.example/", neutral(r.html)) for r in pages]
    found = {r.page_id: r.text for r in main_text.extracted(spark.createDataFrame(rows, PAGES)).collect()}
    menus = footers = whole = 0
    (row,) = main_text.site_templates(spark.createDataFrame(rows, PAGES)).collect()
    shapes = frozenset((k % (1 << 64), kind) for k, kind in zip(row.subtrees, row.kinds) if kind in (main_text.SHAPE, main_text.NAMED))
    for r in pages:
        first = html.unescape(re.search(r"<nav>.*?>([^<>]+)</a>", r.html)[1])
        menus += not found[r.page_id].startswith(f"{first}\n\n")
        footers += "\u00a9 " not in found[r.page_id]
        whole += simple_truth(r.html) in Page(neutral(r.html)).text(shapes)
    assert menus >= 0.95 * len(pages) and footers >= 0.9 * len(pages) and whole == len(pages)


def test_lists_of_links_in_articles(spark):
    """A list of links on half of a host's pages goes, on a tenth if its name is noisy; a rare one stays."""

    def links(k, name):
        return f"<ul class='{name}{k}'>" + "".join(f"<li><a href=x>see {k} {j}</a></li>" for j in range(4)) + "</ul>"

    def page(k, extra):
        return f"<article><h1>Head {k}</h1><p>The long story of page number {k} as told</p>{extra}</article>"

    rows = [(k, "http://a/", page(k, links(k, "list") if k < 15 else "")) for k in range(20)]
    rows += [(100 + k, "http://b/", page(k, links(k, "related") if k < 6 else "")) for k in range(40)]
    rows += [(200 + k, "http://c/", page(k, links(k, "list") if k < 6 else "")) for k in range(40)]
    found = {r.page_id: r.text for r in main_text.extracted(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(found[k] == f"Head {k}\n\nThe long story of page number {k} as told" for k in range(20))
    assert all("see" not in found[100 + k] for k in range(40))
    assert all(found[200 + k].endswith("see %d 3" % k) for k in range(6))


def test_templates_equal_a_plain_count(spark):
    """Spark's templates are those of a count by dictionaries over the same subtrees."""
    rows = [r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    frame = spark.createDataFrame([(r.page_id, f"http://h{r.page_id % 3}/", neutral(r.html or "")) for r in rows], PAGES)
    counts, sizes, around = {}, {}, {}
    for r in rows:
        host = f"h{r.page_id % 3}"
        sizes[host] = sizes.get(host, 0) + 1
        page = Page(neutral(r.html or ""))
        beside = page.surroundings()
        for subtree in {(key, kind) for key, kind, _, _ in page.subtrees}:
            counts[host, subtree] = counts.get((host, subtree), 0) + 1
            around.setdefault((host, subtree), set()).add(beside[subtree])
    shares = [main_text.SHARE_OUTSIDE, main_text.SHARE_INSIDE, main_text.SHARE_SHAPE, main_text.SHARE_NAMED]
    expected = {}
    for (host, (key, kind)), n in counts.items():
        different = len(around[host, (key, kind)] - {0})
        if n >= main_text.LEAST_PAGES and (
            n >= shares[kind] * sizes[host] or different >= main_text.MANY and different >= main_text.DIFFERENT * n
        ):
            expected.setdefault(host, set()).add((key, kind))
    found = [set(zip((k % (1 << 64) for k in r.subtrees), r.kinds)) for r in main_text.site_templates(frame).collect()]
    assert sorted(map(sorted, found)) == sorted(map(sorted, expected.values()))
    assert expected


def test_many_elements_in_time():
    """Work grows with the page: 40,000 short elements, deep or beside each other, take seconds."""
    import time

    began = time.perf_counter()
    assert len(Page("<div>" + "<div>a</div>" * 40_000 + "</div><div>b</div>").text()) == 3 * 40_001 - 2
    assert Page("<div>x" * 40_000).text().count("x") == 40_000
    assert time.perf_counter() - began < 20
