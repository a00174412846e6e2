import html as references
import itertools
import random
import re

import numpy as np
import pytest

from sluiceworks.llm import html

NOTHING = np.zeros((len(html.FEATURES), html.BINS))


def article_of(source):
    """The article of the test tables' pages, by their known layout."""
    found = re.search(r"<article>(.*?)(</article>|<footer>|$)", source, re.S)
    blocks = []
    for part in re.split(r"</?(?:p|h1|br)>", found[1]):
        text = re.sub(r"\s+", " ", references.unescape(re.sub(r"<[^>]*>", "", part))).strip()
        if text:
            blocks.append(text)
    return "\n".join(blocks)


@pytest.fixture(scope="module")
def pages(spark, folder):
    return spark.read.parquet(f"{folder}/pages.parquet")


def test_articles(pages):
    got = {(r["page_id"], r["url"]): r for r in html.extract(pages.selectExpr("*", "1 AS text")).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        found = got[r["page_id"], r["url"]]
        assert found["text"] == article_of(r["html"])
        assert found["n_chars"] == len(found["text"])


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("", ""),
        ("<", ""),
        ("<p", ""),
        ("<script>x", ""),
        ("<article>a &lt; b &amp c &am", "a < b & c &am"),
        ("<article><p>one<p>two<br>three</article><footer>f</footer>", "one\ntwo\nthree"),
        ("<main><h1>T</h1><header><p>by me</p></header><p>q <a href=x>l</a>\n\t w</p><aside>no</aside></main>", "T\nby me\nq l w"),
        ("<article><p>x</p><div class='reader comments'><p>c</p></div><form>f<input></form></article>", "x"),
        ("<div class=cookie-notice>n</div><div id=content><p>body text</p></div><div class=sidebar>s</div>", "body text"),
        ("<article><style>p{}</style><p hidden>h</p><p style='display:none'>d</p><template>t</template><p>y</p></article>", "y"),
        ("<article><!-- <p>c</p> --><p>z</p></i></p></article>", "z"),
        ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a\nb\nc"),
        ("<article><p>a < b</p></article>", "a < b"),
        ("<nav><ul><li>m</li></ul></nav><article><ul><li>i<li>j</ul></article>", "i\nj"),
    ],
)
def test_small_pages(source, text):
    assert html.extract_text(source, NOTHING) == text


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<form><nav>n</nav><article><p>x</p><form>f</form></article><footer>f</footer></form>", "x"),
        ("<form><div id=content><p>x</p></div></form>", "x"),
        ("<div class=no-sidebar><article>x</article></div>", "x"),
        ("<div class='page has-sidebar with-header'><div class=content>x</div><div class=left-sidebar>s</div></div>", "x"),
        ("<div class=page-header-fixed><nav>n</nav><main>x</main></div>", "x"),
        ("<article><p>x</p><div class=comments><article>c</article></div></article><aside><article>t</article></aside>", "x"),
        ("<article><p>r <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math>.</p></article>", "r x=2."),
        ("<article><p>a <span hidden>h</span><object>o</object> b</p></article>", "a b"),
    ],
)
def test_articles_inside_what_looks_like_chrome(source, text):
    assert html.extract_text(source, NOTHING) == text


def test_the_classifier_may_overrule_elements():
    ratios = NOTHING.copy()
    ratios[2, 2:] = 9.0  # two sentences and more
    page = "<form><p>One. Two. Three.</p><p>One. Two.</p></form><div class=sidebar><article><p>One. Two. Three.</p></article></div><nav>menu</nav>"
    assert html.extract_text(page, ratios) == "One. Two. Three.\nOne. Two.\nOne. Two. Three."


def test_untold_blocks_follow_the_classifier_and_their_neighbours(spark):
    rows = [
        (i, "u", "<nav><ul>" + "<li><a href=x>menu</a></li>" * 6 + "</ul></nav><article>"
         + "<p>A long sentence with many words in it. And one more, to be sure.</p>" * 5 + "</article>")
        for i in range(30)
    ]
    ratios = html.fit(spark.createDataFrame(rows, "page_id long, url string, html string"))
    page = "<div><div>" + "<a href=x>menu</a><br>" * 6 + "</div><div>" + (
        "<p>A long sentence with quite a few words. And one more, to be sure.</p>" * 3 + "<p>Short.</p>"
    ) * 2 + "</div></div>"
    text = html.extract_text(page, ratios)
    assert "menu" not in text and text.count("A long") == 6 and text.count("Short.") == 2


def test_min_cut_is_minimal():
    draw = random.Random(5)
    for _ in range(60):
        n = draw.randint(1, 7)
        content, chrome = ([draw.choice([0, 0.5, 1, 3]) for _ in range(n)] for _ in range(2))
        edges = [(a, b, draw.choice([0.3, 1, 2])) for a, b in itertools.combinations(range(n), 2) if draw.random() < 0.5]

        def cost(side, content=content, chrome=chrome, edges=edges, n=n):
            unary = sum(chrome[i] if side[i] else content[i] for i in range(n))
            return unary + sum(w for a, b, w in edges if side[a] != side[b])

        best = min(cost(side) for side in itertools.product([False, True], repeat=n))
        assert cost(html.min_cut(n, content, chrome, edges)) == pytest.approx(best)


def test_odd_rows(spark):
    deep = "<div><p>a" * 3000
    rows = [(1, None, None), (None, "u", "<article>x</article>"), (2, "u", ""), (2, "u", ""), (3, "u", deep), (4, "u", "<article>" + "<p>w</p>" * 20_000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = html.extract(frame.selectExpr("*", "1 AS n_chars")).collect()
    assert sorted((str(r["page_id"]), r["n_chars"]) for r in got if r["page_id"] != 3) == [("1", 0), ("2", 0), ("2", 0), ("4", 39_999), ("None", 1)]
    assert html.extract(frame.limit(0)).collect() == []




@pytest.fixture(scope="module")
def fitted(spark, folder):
    return html.fit(spark.read.parquet(f"{folder}/pages.parquet"))


@pytest.mark.parametrize(
    "page, text",
    [
        (
            '<body class="home"><article class="post category-legal tag-search"><header><h1>The headline</h1></header>'
            "<p>Alpha words of the article are here.</p></article></body>",
            "The headline\nAlpha words of the article are here.",
        ),
        (
            "<article><h1>Head</h1><p>See these two pages, both of them are good.</p><ul><li><a href=1>One</a></li>"
            "<li><a href=2>Two</a></li></ul><p>The end of the article is here.</p></article>",
            "Head\nSee these two pages, both of them are good.\nOne\nTwo\nThe end of the article is here.",
        ),
        ('<article><p title="5" screen">Alpha words.</p><p>The end.</p></article>', "Alpha words.\nThe end."),
        (
            '<article><p title="5" screen">Alpha words.</p><p>It is 5" tall.</p><p>End.</p></article>',
            'Alpha words.\nIt is 5" tall.\nEnd.',
        ),
        ('<article><p title="hidden gems" data-x=style>Alpha words.</p><p title="a > b">Beta.</p></article>', "Alpha words.\nBeta."),
        ('<article><p title="never closed>Alpha words.</p><p>The end.</p></article>', "Alpha words.\nThe end."),
        (
            "<main><article class='post'><p>The text of the article is this one.</p></article>"
            "<article class='comment' id='comment-5'><p>First! I like this text a lot.</p></article></main>",
            "The text of the article is this one.",
        ),
    ],
)
def test_ordinary_pages(fitted, page, text):

    assert html.extract_text(page, fitted) == text
    assert html.extract_text(page, np.zeros_like(fitted)) == text


def test_long_attributes_are_read_in_line_time():
    import time


    page = "<article><p " + 'a="b\' c=' * 200_000 + ">Alpha.</p></article>"
    start = time.perf_counter()
    html.extract_text(page, np.zeros((len(html.FEATURES), html.BINS)))
    assert time.perf_counter() - start < 20
