import html
import re

import pytest
from tillflow.llm import html_text as op

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def extractor():
    return op.train()


def article(page):
    """The blocks of the article element, by another way: no tree, no model."""
    found = re.search(r"<article>(.*?)(?:</article>|$)", page, re.S)
    blocks = re.split(r"</?(?:p|h1)[^>]*>", found[1]) if found else []
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>?", " ", b)).split()) for b in blocks]
    return "\n\n".join(b for b in blocks if b)


def test_all_pages(spark, extractor):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    found = {r.page_id: r.text for r in op.extract(pages, extractor).collect()}
    assert found == {r.page_id: article(r.html) for r in pages.collect()}


def test_held_out_layouts(extractor):
    layouts, right, wrong, missed = op.Layouts(4242), 0, 0, 0
    for _ in range(200):
        page = layouts.page()
        nodes, pieces = op.parse(page)
        labels = [0] + [int(y) for tag, y in op.MARK.findall(page) if tag not in op.INLINE]
        wanted = {t for k, t in pieces if labels[k]}
        found = set(extractor.texts([page])[0].split("\n\n")) - {""}
        right, wrong, missed = right + len(wanted & found), wrong + len(found - wanted), missed + len(wanted - found)
    assert right / (right + wrong) > 0.98 and right / (right + missed) > 0.98


def test_nothing_is_kept_in_a_rejected_element(extractor):
    layouts = op.Layouts(7)
    for _ in range(50):
        nodes, _ = op.parse(layouts.page())
        odds = extractor.model.log_odds(op.np.array(op.features(nodes, extractor.weights)))
        accepted = op.decode(nodes, odds)
        assert all(accepted[n.parent] for n, y in zip(nodes[1:], accepted[1:]) if y)


PROSE = "Some plain sentence with enough words to be read, again and again. " * 6


@pytest.mark.parametrize("unwanted", [
    '<div class="cookie-notice"><p>We use cookies on this site.</p></div>',
    '<aside><h3>Related</h3><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></aside>',
    '<form action="/s"><label>Search</label><input name="q"><button>Go</button></form>',
    '<section id="comments"><div class="comment"><p>I liked it very much, thank you.</p></div></section>',
    '<script>var x = "<p>no</p>";</script><style>p { color: red }</style>',
    '<footer>&copy; 2024 Somebody</footer>',
])
def test_parts_that_go(extractor, unwanted):
    page = f"<html><body><nav><a href='/'>Home</a></nav><article><h1>Title</h1><p>{PROSE}</p></article>{unwanted}</body>"
    assert extractor.texts([page]) == ["Title\n\n" + PROSE.strip()]


def test_parsing_of_broken_markup():
    nodes, pieces = op.parse("<div><p>a<b>b <i>c</b> d<p>e &amp; f&nbsp;g<ul><li>h<li>i</ul>j</div>k<br>l<!-- x")
    assert [t for _, t in pieces] == ["ab c d", "e & f g", "h", "i", "j", "k l"]
    assert [n.tag for n in nodes] == ["body", "div", "p", "p", "ul", "li", "li"]


def test_odd_rows(spark, extractor, clash):
    rows = [(1, None, None), (1, None, None), (None, "u", ""), (2, "u", "plain text"), (3, "u", "<" * 5000),
            (4, "u", "<div>" * 3000), (5, "u", f"<article><p>{'long ' * 200_000}</p></article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = op.extract(clash(pages), extractor).collect()
    assert [(r.page_id, r.url) for r in found] == [r[:2] for r in rows]
    texts = [r.text for r in found]
    assert texts[:4] == ["", "", "", "plain text"] and len(texts[6]) == 5 * 200_000 - 1
    assert op.extract(pages.limit(0), extractor).collect() == []
