import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from smogline.llm.style_tree import Page, _hash, extract, host_of, tree

PAGES = "page_id BIGINT, url STRING, html STRING"


def text(source):
    return Page(source).main_text(frozenset())


@pytest.mark.parametrize(
    ("source", "wanted"),
    [
        (None, ""),
        ("", ""),
        ("plain", "plain"),
        ("<p>a<p>b", "a\nb"),
        ("<p><b>a<br><p>c</p>", "a\nc"),
        ("<p>a <i>b</i>c\n  d&nbsp;&amp;&lt;e&gt; &#233;</p>", "a bc d &<e> é"),
        ("<nav>x</nav><header>h</header><article><header><h1>T</h1></header><p>a</p></article><footer>f</footer>", "T\na"),
        ("<div class='ad'>x</div><div class=\"side-bar sidebar\">y</div><main>z</main>", "z"),
        ("<div id=comments><p>first!</p></div><p>a", "a"),
        ("<script>var t='</p>';</script><style>p{}</style><p>a<!-- <p>no</p> -->b", "ab"),
        ("<form><p>x</p></form><p>a</p><div role=dialog>x</div><div hidden>x</div><div style='display: none'>x</div>", "a"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", "a\nb\nc\nd\ne"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
        ("<dl><dt>a<dd>b<dt>c</dl>", "a\nb\nc"),
        ("<p>a < b</p><p>cut <a hre", "a < b\ncut"),
        ("<p>1 &am", "1 &am"),
        ("<p title='a > b'>x</p>", "x"),
        ("<body class='has-sidebar menu'><p>x</p></body>", "x"),
        ("<p>x</p><!-- open", "x"),
        ("<p>a<span class='ad'>buy</span>b</p>", "a\nb"),
        ("<article><p>a</p></article></div></p>tail", "a\ntail"),
        ("<script>never closed <p>x", ""),
        ("<div id=header>x</div><div class=heading>T</div><p>a</p>", "T\na"),
        ("<article><div class='post-header'>T</div><p>a</p><div class=comments>c</div></article>", "T\na"),
    ],
)
def test_pages(source, wanted):
    assert text(source) == wanted


@pytest.mark.parametrize("wrapper", ["div class='content-sidebar-wrap'", "div id='page-with-nav'", "form id='aspnetForm'"])
def test_wrappers_do_not_take_the_article(wrapper):
    tag = wrapper.split()[0]
    inner = "<article><p>Story</p><div class=share>s</div></article><div class=sidebar>y</div>"
    assert text(f"<p>top</p><{wrapper}>{inner}</{tag}>") == "top\nStory"
    assert text(f"<{wrapper}><div role=main><p>Story</p></div></{tag}>") == "Story"
    # Nothing else is left, so the name is wrong; the bar within it is still one.
    assert text(f"<{wrapper}><div><p>A longer story</p></div><div class=sidebar>bar</div></{tag}>") == "A longer story"
    assert text(f"<p>a</p><{wrapper}><p>one two</p></{tag}>") == "a"
    assert text(f"<p>a</p><div id=comments><article>mine</article></div><aside><{wrapper}>b</{tag}></aside>") == "a"


def test_the_tree_overrules_a_wrapper(spark):
    page = "<p>Same top</p><div class='layout has-sidebar'><div><p>Story {0} is about {0}</p></div><div class=sidebar>{0}</div></div>"
    words = ["".join(chr(97 + int(c)) for c in str(i)) for i in range(20)]
    pages = [(i, f"http://site.example/{i}", page.format(word)) for i, word in enumerate(words)]
    found = {row.page_id: row.text for row in extract(spark.createDataFrame(pages, PAGES)).collect()}
    assert found == {i: f"Story {word} is about {word}" for i, word in enumerate(words)}


def test_very_long_and_deep_pages():
    assert text("<p>" + "word " * 200_000) == ("word " * 200_000).strip()
    assert text("<div>" * 3000 + "x" + "</div>" * 3000) == "x"
    assert text("<" * 20_000) == "<" * 20_000
    assert text("<a b='" * 3000) is not None


@pytest.mark.parametrize(
    ("url", "host"),
    [(None, ""), ("", ""), ("no url", ""), ("HTTP://User:pw@Example.COM:80/x", "example.com"), ("https://a.b?c", "a.b")],
)
def test_hosts(url, host):
    assert host_of(url) == host


def site(count, host="site.example"):
    """Pages whose boilerplate has no telling name."""
    page = "<div class=x1><p>Same words everywhere</p></div><div class=x2><p>Story {0} is about {0}</p><p>More on {0}</p></div>"
    return [(i, f"http://{host}/{i}", page.format("".join(chr(97 + int(c)) for c in str(i)))) for i in range(count)]


@pytest.mark.parametrize("max_broadcast", [1000, -1])
def test_entropy_cuts_what_pages_share(spark, max_broadcast):
    pages = site(20) + [(100, "http://other.example/", site(1)[0][2]), (101, None, site(1)[0][2]), (102, "http://site.example/n", None)]
    found = {row.page_id: row.text for row in extract(spark.createDataFrame(pages, PAGES), max_broadcast=max_broadcast).collect()}
    assert found[3] == "Story d is about d\nMore on d"
    # A host of one page, and pages without host, have nothing to compare.
    assert found[100] == found[101] == "Same words everywhere\nStory a is about a\nMore on a" and found[102] == ""


def test_articles_and_whole_pages_survive_entropy(spark):
    copies = [(i, "http://copies.example/", "<article><p>The same</p></article>") for i in range(20)]
    bare = [(100 + i, "http://bare.example/", "<div><p>The same</p></div>") for i in range(20)]
    rows = extract(spark.createDataFrame(copies + bare, PAGES)).collect()
    assert len(rows) == 40 and {row.text for row in rows} == {"The same"}


def test_boilerplate_without_a_name_goes_from_articles(spark):
    page = (
        "<article><h1>About {0}</h1><p>Story {0} is all about {0} and what {0} did</p><p>Share this story</p>"
        "<div class=x7><p>Jane Doe writes for us</p></div><table><tr><td>yes</table></article>"
    )
    words = ["".join(chr(97 + int(c)) for c in str(i)) for i in range(20)]
    pages = [(i, f"http://site.example/{i}", page.format(word)) for i, word in enumerate(words)]
    found = {row.page_id: row.text for row in extract(spark.createDataFrame(pages, PAGES)).collect()}
    for i, word in enumerate(words):
        assert found[i].split("\n")[:2] == [f"About {word}", f"Story {word} is all about {word} and what {word} did"]
        assert "Share" not in found[i] and "Jane" not in found[i]


def brute_tree(pages):
    """Importance and contents of every path, and what is cut, from whole pages held in one place."""
    by_host = {}
    for _, url, source in pages:
        if source and host_of(url):
            by_host.setdefault(host_of(url), []).append(Page(source))
    importance, cut = {}, {}
    for host, parsed in by_host.items():
        owners, styles, having, homes = Counter(), {}, {}, {}
        for page in parsed:
            paths = {block.path for block in page.blocks}
            owners.update(paths | set(page.homes.values()))
            homes.update(page.homes)
            for path, style in page.styles:
                styles.setdefault(path, Counter())[style] += 1
            for path, value in set(page.features):
                if path in paths:
                    having.setdefault(path, Counter())[value] += 1
        for path in having:
            m = owners[homes.get(path, path)]
            shares = np.array([*styles[path].values()]) / sum(styles[path].values())
            effective = math.exp(-(shares * np.log(shares)).sum())
            ks = np.array([*having[path].values()])
            content = 1 - ((ks * ks).sum() / ks.sum() - 1) / (m - 1) if m > 1 else 1.0
            presentation = 1 - 1 / effective if m > 1 else 1.0
            both = (1 - 0.9**effective) * presentation + 0.9**effective * content
            importance[host, path] = (owners[path], presentation, content, both)
            if owners[path] < 5:
                continue
            cut.setdefault(host, {0})
            if max(both, content) < 0.4:
                cut[host].add(_hash(path))
            else:
                cut[host].update(_hash(path) ^ _hash(v) for v, k in having[path].items() if v[0] == "t" and k >= 0.8 * m)
    return importance, cut


def test_tree_and_texts_equal_brute_force(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = [(row.page_id, row.url, row.html) for row in pages.collect()] + guide(12)
    frame = spark.createDataFrame(rows, PAGES).repartition(4)
    importance, cut = brute_tree(rows)
    found = {(row.host, row.path): row for row in tree(frame).collect()}
    assert len(found) == len(importance)
    for (host, path), expected in importance.items():
        row = found[host, _hash(path)]
        assert np.allclose((row.pages, row.presentation, row.content, row.importance), expected)
    texts = {row.page_id: row.text for row in extract(frame).collect()}
    assert texts == {i: Page(source).main_text(cut.get(host_of(url), frozenset())) for i, url, source in rows}


def letters(number):
    return "".join(chr(97 + int(c)) for c in str(number))


def guide(count, host="guide.example"):
    """Articles with sections of which a quarter, and nine tenths, of the pages have the same, and a box without a name."""
    pages = []
    for i in range(count):
        word = letters(i)
        parts = [f"<h1>All of {word}</h1><p>What {word} is, in {word}s</p>"]
        if i % 4 == 0:
            parts.append(f"<h2>Safety</h2><p>Mind the {word} {word}</p>")
        if i % 10:
            parts.append(f"<h2>Method</h2><p>Take {word} twice</p>")
        parts.append("".join(f"<h3>Step {n}</h3><p>Do {word} {letters(n)}</p>" for n in range(1, 4)))
        parts.append("<p>Thank you for reading our guides</p><div class=q4><p>Written by our editors</p></div>")
        pages.append((10_000 + i, f"http://{host}/{i}", f"<article>{''.join(parts)}</article><div class=z9>All rights are ours</div>"))
    return pages


def guide_text(i):
    word = letters(i)
    lines = [f"All of {word}", f"What {word} is, in {word}s"]
    lines += ["Safety", f"Mind the {word} {word}"] if i % 4 == 0 else []
    lines += ["Method", f"Take {word} twice"] if i % 10 else []
    return "\n".join(lines + [line for n in range(1, 4) for line in (f"Step {n}", f"Do {word} {letters(n)}")])


@pytest.mark.parametrize("count", [20, 2000])
def test_the_size_of_a_host_changes_nothing(spark, count):
    found = {row.page_id - 10_000: row.text for row in extract(spark.createDataFrame(guide(count), PAGES)).collect()}
    assert found == {i: guide_text(i) for i in range(count)}


def test_a_heading_on_a_quarter_of_the_pages_stays(spark):
    page = "<article><p>{0} {0}</p>{1}</article>"
    for count in (40, 2500):
        rows = [(i, f"http://h.example/{i}", page.format(letters(i), "<h2>Deep dive</h2>" if i % 4 == 0 else "")) for i in range(count)]
        found = extract(spark.createDataFrame(rows, PAGES)).collect()
        assert sum("Deep dive" in row.text for row in found) == count / 4


def test_border_of_small_hosts(spark):
    """Below LEAST_PAGES names decide alone; from there on the tree does, over wrappers' names, too."""
    page = "<p>Same top</p><div class='layout has-sidebar'><div><p>Story {0} is about {0}</p></div></div>"
    for count, wanted in ((4, "Same top"), (5, "Story {0} is about {0}")):
        rows = [(None, f"http://h.example/{i}", page.format(letters(i))) for i in range(count)]
        found = extract(spark.createDataFrame(rows, PAGES)).collect()
        assert sorted(row.text for row in found) == [wanted.format(letters(i)) for i in range(count)]
        assert all(row.page_id is None for row in found)


def test_formulas_stay():
    assert text("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> hold</p></article>").replace("\n", " ").split()[0] == "Let"
    assert "x" in text("<article><p>Let <math><mi>x</mi></math> hold</p></article>")


def test_importance(spark):
    rows = {(row.pages, round(row.content, 3)) for row in tree(spark.createDataFrame(site(16), PAGES)).collect()}
    assert (16, 0.0) in rows and max(content for _, content in rows) == 1.0
    one = tree(spark.createDataFrame(site(1), PAGES)).collect()
    assert {row.importance for row in one} == {1.0}


def test_repeated_rows_empty_table_and_other_columns(spark):
    pages = spark.createDataFrame(site(2) * 2, PAGES).withColumns({name: F.lit(1) for name in ("text", "host", "cut", "path")})
    assert extract(pages).count() == 4 and extract(pages.limit(0)).count() == 0
