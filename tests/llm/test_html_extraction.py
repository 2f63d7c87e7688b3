import html
import json
import random
import re

import pytest

from cartspark.llm.html_extraction import Node, align, extract_text, infer_wrappers, main_text, mark, read_page, structure

SCHEMA = "page_id long, url string, html string"
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x="</p><article>";</script></head><body>
<header>Site</header><nav><ul><li><a href=/a>Menu</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<div class=sidebar><p>Side</p></div><aside>Aside</aside><form><p>Search</p><input name=q></form>
<main><article><h1>Head &amp; line</h1><p>One <b>bold</b>
  text&nbsp;here<br>next</p><div class="ad">Buy</div><p>Two <span class="ads">x</span>goes on<p>Three &lt;tag&gt; caf&eacute; &#8364;
<ul><li>first<li>second</ul><blockquote>quote</blockquote><pre>a   b</pre><!-- <p>gone</p> --><script>1</script>
<section id="comments"><p>Reader says</p></section></article></main><footer>&copy; me</footer></body></html>"""
TEXT = "Head & line\nOne bold text here next\nTwo goes on\nThree <tag> café €\nfirst\nsecond\nquote\na b"


def extracted(spark, rows):
    return {r.page_id: r.text for r in extract_text(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_main_text_of_a_page():
    assert main_text(PAGE) == TEXT


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""), ("plain", "plain"), ("<p>a<p>b", "a\nb"), ("<nav>x</nav>", ""), ("a<br>b", "a b"),
        ("<body><p>x</p><footer>y</footer>", "x"), ("<article></article><p>out</p>", ""), ("<article>unclosed <p>end", "unclosed\nend"),
        ("<div role=navigation>n</div><div role='main'>m</div>", "m"), ("1 < 2 &amp and &am", "1 < 2 & and &am"),
        ("<p title='a>b'>c</p>", "c"), ("<p title=\"a>c</p>", "c"), ("<table><tr><td>1<td>2</table>", "1\n2"),
        ("<p>x</i></div></p>y", "x\ny"), ("<!-- open <p>x", ""), ("<script>x", ""), ("<div hidden>h</div>s", "s"),
        ("<ARTICLE><P CLASS='x Ad'>no</P><P>yes</ARTICLE>", "yes"), ("<p>a\x00b</p>", "a\x00b"), ("<div>" * 3000 + "deep", "deep"),
    ],
)
def test_small_pages(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<body><div>Logo</div><nav>n</nav><div><article><p>a</p></article></div></body>", "a"),
        ("<article><div><p>a</p></div><h2>b</h2><div><ul><li>c</li></ul></div></article>", "a\nb\nc"),
        ("<body><section><p>a</p></section><h2>b</h2><section>c<table><tr><td>d</table></section><h2>e</h2><section><h3>f</h3></section></body>", "a\nb\nc\nd\ne\nf"),
        ("<body><div><div><p>a</p></div><p>b</p><div><ul><li>c</ul></div></div><p>d</p><div><div><h3>e</h3></div></div></body>", "a\nb\nc\nd\ne"),
    ],
)
def test_unlike_siblings_of_one_label(spark, page, text):
    assert main_text(page) == text
    rows = [(1, "http://h/1", page), (2, "http://h/2", page.replace("<p>a</p>", "<p>a</p><nav>x</nav>")), (3, "http://h/3", "<body><div>z</div></body>")]
    assert [extracted(spark, rows)[i] for i in (1, 2)] == [text, text]
    wrappers = infer_wrappers(spark.createDataFrame([("h", page)], "host string, html string"))
    longer = page.replace("<p>a</p>", "<p>a</p><blockquote>q</blockquote>")
    got = extract_text(spark.createDataFrame([(1, "http://h/1", longer)], SCHEMA), wrappers).first().text
    assert got == text.replace("a", "a\nq", 1)


def test_wrapper_is_a_union_free_expression():
    one = structure(read_page("<body><h1>a</h1><p>b</p><p>c</p><ul><li>x</ul></body>"))
    two = structure(read_page("<body><h1>a</h1><div>z</div><p>b</p></body>"))
    both = align(one, two)
    assert both.expression() == "(<page>(<body>(<h1>#</h1>)(<div>#</div>)?(<p>#</p>)+(<ul>(<li>#</li>)</ul>)?</body>)</page>)"
    assert Node.unpack(both.pack()).expression() == both.expression()
    assert align(both, one).expression() == both.expression()


def test_wrappers_of_a_host_come_from_all_its_pages(spark):
    pages = [("h", f"<body><p>{i}</p>" + "<div>x</div>" * (i % 2)) for i in range(40)] + [("other", ""), ("other", None)]
    frame = spark.createDataFrame(pages, "host string, html string").repartition(7)
    got = {r.host: r.expression for r in infer_wrappers(frame).collect()}
    assert got == {"h": "(<page>(<body>(<p>#</p>)(<div>#</div>)?</body>)</page>)", "other": "(<page></page>)"}


def test_many_pages_and_odd_rows(spark):
    rows = [(i, f"http://h{i % 3}.x/{i}", PAGE.replace("One", f"One{i}")) for i in range(30)]
    rows += [(100, None, PAGE), (101, "no host", None), (102, "http://h1.x/", ""), (102, "http://h1.x/", ""), (103, "http://h0.x/", "<p>only a block")]
    got = extracted(spark, rows)
    assert all(got[i] == TEXT.replace("One", f"One{i}") for i in range(30))
    assert (got[100], got[101], got[102], got[103]) == (TEXT, "", "", "only a block")
    frame = spark.createDataFrame([(*rows[0], "w", "t")], SCHEMA + ", wrapper string, text string")
    assert extract_text(frame).columns == ["page_id", "url", "text"]
    assert extract_text(frame.limit(0)).count() == 0


def test_given_pages_against_a_plain_reading(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in extract_text(pages).collect()}
    for page in pages.collect():
        article = re.search(r"<article>(.*?)</article>", page.html, re.S).group(1)
        blocks = re.split(r"</?(?:h1|p)>", re.sub(r"</?b>|<br>", " ", article))
        lines = [" ".join(html.unescape(b).split()) for b in blocks]
        assert got[page.page_id] == "\n".join(line for line in lines if line)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<div class="page has-sidebar"><article><p>a</p></article></div>', "a"),
        ('<article class="post no-comments"><p>a</p></article>', "a"),
        ('<div class="header-fixed"><main><p>a</p></main></div>', "a"),
        ('<article><p>a</p><div class="related-work"><p>b</p></div></article>', "a\nb"),
        ('<div id="sidebar"><article><p>a</p></article></div><p>x</p>', "a"),
        ('<article class="comment"><p>a</p></article>', "a"),
        ('<article><p>a</p><article class="comment"><p>c</p></article><div id="post-comments"><p>c</p></div></article>', "a"),
        ('<body><div class="top-ad-2">x</div><div class="cookie-bar">y</div><div class="adapter">z</div></body>', "z"),
        ('<article>a<my-banner class="banner">b</my-banner></article>', "ab"),
    ],
)
def test_words_of_a_class_drop_no_article(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("depth", [10, 191, 199, 200, 201, 206, 1000, 5000])
def test_any_depth(depth):
    deep = "<div>" * depth
    page = f"<body>{deep}<nav>MENU<p>x</p></nav><p>a</p>b<section>c<p>d</p>e</section><aside>f</aside>g"
    assert main_text(page) == "a\nb\nc\nd\ne\ng"
    assert main_text(f"<body>{deep}<p>out</p><article><p>a</p><footer>f</footer><div>b</div></article>") == "a\nb"


@pytest.mark.parametrize("tag", ["<article>", "<main>", "<div class=ad>", "<article class=comment>", "<ul><li>", "<my-x id=ad>"])
def test_any_number_of_nested_elements(spark, tag):
    page = tag * 3000 + "<p>a" + "<article><p>b"
    assert main_text(page).split("\n")[-1] == "b"
    wrapper = infer_wrappers(spark.createDataFrame([("h", page), ("h", page + "<p>c")], "host string, html string")).first()
    assert main_text(page, mark(Node.unpack(json.loads(wrapper.wrapper)))).split("\n")[-1] == "b"


def site(i, notice="<div>Shop closes at five</div>", body=None):
    body = body or f"<div><h1>Title {i}</h1><p>Words of page {i}</p></div>"
    return f"<body>{notice}{body}<div><ul><li>Home</li><li>Imprint</li></ul></div></body>"


def test_template_of_a_host_is_no_main_text(spark):
    rows = [(i, f"http://shop/{i}", site(i)) for i in range(9)] + [(20, "http://shop/x", site(0)), (21, "http://one/1", site(7))]
    # Pages that say what their article is, and equal pages, are as they are.
    rows += [(30 + i, f"http://news/{i}", f"<article><p>Same words</p><p>{i}</p></article>") for i in range(5)]
    rows += [(40 + i, f"http://copy/{i}", site(1)) for i in range(5)] + [(50 + i, f"http://two/{i}", site(i)) for i in range(2)]
    rows += [(60, "http://shop/empty", site(0, body="<p></p>"))]
    got = extracted(spark, rows)
    whole = "Shop closes at five\nTitle {0}\nWords of page {0}\nHome\nImprint"
    assert [got[i] for i in range(9)] == [f"Title {i}\nWords of page {i}" for i in range(9)]
    assert got[20] == got[0] and got[21] == whole.format(7)
    assert [got[30 + i] for i in range(5)] == [f"Same words\n{i}" for i in range(5)]
    assert {got[40 + i] for i in range(5)} == {whole.format(1)} and got[50] == whole.format(0)
    assert got[60] == "Shop closes at five\nHome\nImprint"


def test_many_sections_are_one_repeated_group():
    import time

    pages = [structure(read_page("<body>" + f"<h2>a</h2><p>b</p>{more}" * n + "</body>")) for n, more in ((2000, ""), (1999, "<ul><li>c</ul>"))]
    start = time.process_time()
    both = align(*pages)
    assert time.process_time() - start < 1
    assert pages[0].expression() == "(<page>(<body>((<h2>#</h2>)(<p>#</p>))+</body>)</page>)"
    assert Node.unpack(both.pack()).expression() == both.expression()
    assert main_text("<body><h2>a</h2><p>b</p><h2>c</h2><p>d</p>", mark(both)) == "a\nb\nc\nd"


def test_random_markup_never_fails():
    rng = random.Random(5)
    parts = ["<p>", "</p>", "<div class=ad>", "</div>", "<article>", "</article>", "text ", "<", ">", "&", "\"", "'", "<b", "<!--", "-->", "<script>", "</script>", "<li>", "<td>", "/"]
    for _ in range(2000):
        page = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        assert isinstance(main_text(page), str)
