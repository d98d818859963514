import pytest

from starbeam.llm import html_extract as H

PAGE = "page_id long, url string, html string"
FRAME = "<html><head><title>t</title><style>p{}</style><script>var x='</p>';</script></head><body><nav><ul><li><a href='/'>home</a></ul></nav><header><p>site</p></header><div class='sidebar'>side</div><div id='cookie-notice'>cookies</div><form><p>mail</p></form>%s<section class='comments'><p>first!</p></section><footer>&copy; us</footer></body></html>"


def texts(spark, rows, **kw):
    return {r.page_id: (r.text, r.n_chars) for r in H.extract(spark.createDataFrame(rows, PAGE), **kw).collect()}


@pytest.mark.parametrize("body,expected", [
    ("<article><h1>Title</h1><p>One &amp; two<br>three</p><p>four\n  five<p>six</article>", "Title\nOne & two three\nfour five\nsix"),
    ("<main><p>a</p><aside>no</aside><ul><li>b<li>c</ul></main>", "a\nb\nc"),
    ("<div><p>plain <b>bold</b> <i>text</i></p></div>", "plain bold text"),
    ("<article><header><h1>T</h1></header><p>x</p><div class='advert'>buy</div><section class='comment-list'><article class='comment'><p>troll</p></article></section></article>", "T\nx"),
    ("<article><p>nbsp&nbsp;here &#233;&#x4e2d; &unknown; &lt;b&gt;</p></article>", "nbsp here é中 &unknown; <b>"),
    ("<article><table><tr><td>1<td>2<tr><td>3</table></article>", "1\n2\n3"),
    ("<article><p>a</p><!-- <p>no</p> --><noscript><p>no</p></noscript><p hidden>no</p><p style='display: none'>no</p></article>", "a"),
    ("<article><a href=\"x>y\" title='a>b'>link</a> <img alt='>'>end</article>", "link end"),
])
def test_article_without_furniture(spark, body, expected):
    assert texts(spark, [(1, "https://a.example/x", FRAME % body)])[1] == (expected, len(expected))


def test_defined_cases(spark):
    rows = [(1, None, None), (2, "", ""), (3, "not a url", "no markup at all"), (4, "http://h/", "<article><p>cut <b>off</b> he"), (5, "http://h/", "<article><p>x</p><p clas"), (6, "http://h/", "<article><p>x</p><!-- open"), (None, "http://h/", "<p>y</p>"), (7, "http://h/", "<p>a</p>"), (7, "http://h/", "<p>a</p>")]
    found = H.extract(spark.createDataFrame(rows, PAGE)).collect()
    assert len(found) == len(rows)
    got = {r.page_id: r.text for r in found}
    assert got == {1: "", 2: "", 3: "no markup at all", 4: "cut off he", 5: "x", 6: "x", None: "y", 7: "a"}
    assert H.extract(spark.createDataFrame([], PAGE)).count() == 0


def test_text_that_a_host_repeats_is_cut_by_importance(spark):
    """Unnamed boxes: only the merged tree can tell the repeated box from the text."""
    rows = [(i, f"https://site.example/{i}", f"<body><div><div><p>All offers of the week</p><p>Call us</p></div><section><p>Story {i} goes here</p>{'<p>more %d</p>' % i * (i % 3)}</section></div></body>") for i in range(12)]
    got = texts(spark, rows)
    assert got[3][0] == "Story 3 goes here"
    assert got[4][0] == "Story 4 goes here\nmore 4"
    assert "offers" in texts(spark, rows[:2])[1][0]  # two pages are no evidence


def test_very_long_page_and_clashing_columns(spark):
    body = "".join(f"<p>para {i}</p>" for i in range(30000))
    df = spark.createDataFrame([(1, "https://a/b", f"<article>{body}</article>")], PAGE).selectExpr("*", "'x' AS host", "1 AS salt", "'y' AS low", "'z' AS text")
    r = H.extract(df).collect()[0]
    assert r.text.count("\n") == 29999


def test_extraction_on_test_pages(tables):
    import html
    import re

    pages = tables("pages")
    got = {r.page_id: r.text for r in H.extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)
        inside = re.sub(r"<[^>]*$", "", article.group(1)) if article else ""
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside))
        assert got[r.page_id] == "\n".join(b for b in blocks if b)


@pytest.mark.parametrize("body,expected", [
    ("<article><p>see <a href='/hidden-places'>the valley</a> and <a title='the hidden valley' href=\"?id=share\">more</a></p><p data-id='social'>x</p><p data-hidden=1 title=\"class='ad'\">y</p></article>", "see the valley and more\nx\ny"),
    ("<article><h2 id='social-costs'>Costs</h2><h3 class='share'>S</h3><section id='related-work'><h2 id=related-work>Work</h2><p>w</p></section><p>on <a id='cookie-law' class='tags'>law</a> here</p></article>", "Costs\nS\nWork\nw\non law here"),
    ("<article id='comment-on-budget'><p>a <span hidden>no</span> b<span style='display:none'><b>no</b></span></p><div id='share-buttons'>no</div><div class='related'>no</div><p id='comments'>no</p></article>", "a b"),
    ("<div><h2 id='social-costs'>Costs</h2><div>one <a class='skip'>no</a> two <span hidden>x<div>y</div></span> three</div></div>", "Costs\none two\nthree"),
    ("<article><p hidden>no</p><p class='lead' / hidden>no</p><p class=a HIDDEN=''>no</p><p class=\"x\"hidden>no</p><p>yes</article>", "yes"),
])
def test_attributes_are_read_one_by_one(spark, body, expected):
    assert texts(spark, [(1, "https://a.example/x", FRAME % body)])[1] == (expected, len(expected))


def test_importance_decides_inside_articles_and_on_the_zone(spark):
    def page(i, body):
        return (i, f"https://site.example/{i}", f"<body>{body}</body>")

    story = "Story {0} of the town and all that it saw in year {0}"
    boxed = [page(i, f"<article><h2>Facts</h2><p>{story.format(i)}</p><ul><li>Source</li><li>Place {i}</li></ul><div class='box'><h3>Sale</h3><p>Call us now</p></div></article>") for i in range(12)]
    assert texts(spark, boxed)[5][0] == f"Facts\n{story.format(5)}\nSource\nPlace 5"
    carded = [page(i, f"<div class='body'><p>{story.format(i)}</p></div><article class='card'><p>Try our app</p></article>") for i in range(12)]
    assert texts(spark, carded)[5][0] == story.format(5)
    assert texts(spark, carded[:1])[0][0] == story.format(0) + "\nTry our app"  # no evidence: nothing is lost


def test_copies_on_a_host_are_no_furniture(spark):
    """Two articles, five addresses each: a text on half of the pages stays, and a host of one page only keeps its text."""
    two = [(i, f"https://site.example/{i}", f"<article><h1>T{i % 2}</h1><p>text of {i % 2}</p><p>end of {i % 2}</p></article>") for i in range(10)]
    assert texts(spark, two)[3][0] == "T1\ntext of 1\nend of 1"
    assert texts(spark, two[1::2])[3][0] == "T1\ntext of 1\nend of 1"


@pytest.mark.parametrize("body,expected", [
    ("<div class='content has-sidebar'><article><p>story here</p></article></div>", "story here"),
    ("<div class='sidebar-left'><main><p>story here and on</p></main><div class='sidebar'>no</div></div>", "story here and on"),
    ("<article><div class='entry-header'><h1>T</h1></div><p class='social'>x</p><div class='share-prices'>up</div><p class='advert'>no</p><div class='ad-slot'>no</div></article>", "T\nx\nup"),
    ("<form id='aspnet'><div class='nav__item'>no</div><article><h1>T</h1><p>a story of some length, longer than all the furniture around it</p></article></form>", "T\na story of some length, longer than all the furniture around it"),
    ("<article><p>short</p></article><section class='reader-comments'><article><p>a comment that is longer than the article it stands under</p></article></section>", "short"),
    ("<div><p>AT&<b>amp;</b>T un<script>x</script>do<style>p{}</style>ing</p></div>", "AT&amp;T undoing"),
    ("<div><p>before<svg><text>no</text></svg>after</p></div>", "before after"),
])
def test_names_that_are_no_furniture(spark, body, expected):
    assert texts(spark, [(1, "https://a.example/x", FRAME % body)])[1] == (expected, len(expected))


def test_page_inside_a_form(spark):
    page = "<body><form><nav>n</nav><h1>T</h1><p>the story of this page</p><fieldset><label>mail</label></fieldset></form></body>"
    assert texts(spark, [(1, "https://a.example/x", page)])[1][0] == "T\nthe story of this page"
    assert texts(spark, [(1, "https://a.example/x", "<body><form><p>mail</p></form><p>text</p></body>")])[1][0] == "text"
