"""Operator 8: against the page template's own article, and hand-made pages."""

import html
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lexiflow.llm import dom_extract as D
from lexiflow.llm.boosting import BoostedTrees
from lexiflow.llm.queries import op8_dom_trees
from tests.conftest import SF_MID


@pytest.fixture(scope="module")
def model():
    return D.train([])


def article(page):
    """The article of the table's template, cut out plainly."""
    inner = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1|h2|div|ul|li)[^>]*>", inner)
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", re.sub(r"<br ?/?>", " ", b))).split()) for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_query_equals_the_articles(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_MID}/pages.parquet").collect()}
    rows = op8_dom_trees(spark, SF_MID).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


PAGES = [
    (
        "<html><body><article><h1>T</h1><p>One two three, four five.</p><div class='advert'>Buy now</div><aside><p>aside here</p></aside>"
        "<p>ok &amp;amp; fine&nbsp;now.</p><div class='comments'><p>I like it, very much so, really.</p></div><form><label>Name</label></form></article></body></html>",
        "T\nOne two three, four five.\nok &amp; fine now.",
    ),
    (
        "<body><div class=notice>We use cookies.</div><aside class=sidebar><ul><li>x</ul></aside><article><header><h1>In</h1></header><p>Body\n text  here.<p>next"
        "<ul><li>item one<li>item <b>two</b></ul><pre>code  x</pre></article><section class=comments><h3>Comments</h3><p>Nice one.</section><form><p>Search</form>",
        "In\nBody text here.\nnext\nitem one\nitem two\ncode x",
    ),
    ("<body><main><section><h2>Part</h2><p>Text of <a href=x>the</a> part.</p></section><table><tr><td>1<td>2</table></main></body>", "Part\nText of the part.\n1\n2"),
    ("<article><p>a<script>var t='</p>';</script>b<!-- c --><style>p{}</style> c<br>d</p>", "ab c d"),
    ("", ""),
    ("<", "<"),
    ("<div><p>just a paragraph of text, no article at all. It is long enough.</p></div>", "just a paragraph of text, no article at all. It is long enough."),
]


@pytest.mark.parametrize("page,text", PAGES)
def test_pages(model, page, text):
    assert D.extract_text([page], model) == [text]


LONG = "The long article text stands in this part of the page, as pages have it. It goes on for some time, with commas, and all. "


@pytest.mark.parametrize("page,text", [
    (f"<body><nav><a href=x>a</a></nav><div class='entry tags'><p>{LONG * 3}</p></div></body>", (LONG * 3).strip()),
    (f"<div class='post-comments-enabled'><article><h1>T</h1><p>{LONG}</p></article></div>", f"T\n{LONG.strip()}"),
    ("<article><p>Let <math><mi>x</mi></math> be a number, and so on.</p></article>", "Let x be a number, and so on."),
])
def test_single_words_do_not_veto(model, page, text):
    assert D.extract_text([page], model) == [text]


def renamed(page, k):
    """The page with every class and id replaced by a meaningless one, equal ones alike."""
    return re.sub(r"""(class|id)=(["']?)([\w -]+)""", lambda m: m[1] + "=" + m[2] + " ".join(f"q{zlib.crc32(f'{k}{w}'.encode()) % 10**6}" for w in m[3].split()), page)


def test_articles_without_telling_names(spark):
    """The rule of the weak labels needs the names; the trees know most of the text by its build."""
    pages = [r.html for r in spark.read.parquet(f"{SF_MID}/pages.parquet").collect()]
    model = D.train(pages[:150])
    plain = re.compile(r"<(/?)(?:article|main|aside|nav|footer|header|section)\b")
    changed = [plain.sub(r"<\1div", renamed(p, k)) for k, p in enumerate(pages[150:])]
    right = kept = found = 0
    differ = 0
    for page, was, text in zip(changed, pages[150:], D.extract_text(changed, model)):
        want, have = Counter(article(was).split("\n")), Counter(text.split("\n"))
        right += sum(len(b) * n for b, n in (want & have).items())
        kept += sum(len(b) * n for b, n in have.items())
        found += sum(len(b) * n for b, n in want.items())
        nodes = D.parse(page)
        rule = D.weak_labels(nodes)
        tree = D.decode(nodes, model.probability([nodes]))
        differ += any(r >= 0 and bool(r) != t for r, t in zip(rule, tree))
    assert right >= 0.9 * found and right >= 0.8 * kept
    assert differ >= 0.5 * len(changed)  # the rule, without names, keeps all


def test_features_hold_no_word_list(spark):
    nodes = D.parse("<div class='content'><p>a</p></div><div class='sidebar'><p>a</p></div>")
    x = D.node_features(nodes, {})
    one, two = (x[[n.tag == "div" for n in nodes]][k] for k in (0, 1))
    order = D.NUMBERS.index("order")
    assert (np.delete(one, order) == np.delete(two, order)).all()  # without what training said of the tokens they are alike


def test_decoding_is_consistent_and_optimal(model):
    nodes = D.parse(PAGES[0][0])
    random = np.random.default_rng(1)
    for _ in range(50):
        p = random.uniform(size=len(nodes))
        kept = D.decode(nodes, p)
        assert all(not kept[n.index] or kept[n.parent.index] for n in nodes[1:])
        free = [n for n in nodes if n.tag not in ("#root", "html", "body")]
        cost = lambda k: sum(-np.log(p[n.index]) if k[n.index] else -np.log1p(-p[n.index]) for n in free)
        best = min(
            cost(k)
            for bits in range(1 << len(free))
            for k in [dict({n.index: True for n in nodes}, **{n.index: bool(bits >> i & 1) for i, n in enumerate(free)})]
            if all(not k[n.index] or k[n.parent.index] for n in nodes[1:])
        ) if len(free) <= 9 else cost(kept)
        assert abs(cost(kept) - best) < 1e-9


def test_edges_through_spark(spark):
    deep = "<div>" * 3000 + "<article><p>deep</p></article>"
    rows = [(1, "u", None, "x"), (2, None, "", "y"), (3, "u", PAGES[0][0], None), (3, "u", PAGES[0][0], None), (4, "u", deep, "z"), (5, "u", "<article><p>" + "word " * 60000, "z")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = D.extract(df)
    assert sorted(got.columns) == sorted(df.columns)
    texts = sorted((r.page_id, r.text) for r in got.collect())
    assert texts[:4] == [(1, ""), (2, ""), (3, PAGES[0][1]), (3, PAGES[0][1])] and texts[4][1] == "deep" and len(texts[5][1]) == 5 * 60000 - 1
    assert D.extract(df.limit(0)).count() == 0


def test_boosted_trees_learn():
    random = np.random.default_rng(5)
    x = random.normal(size=(3000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    m = BoostedTrees().fit(x[:2000], y[:2000])
    assert ((m.probability(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.95
    assert (BoostedTrees().fit(x, np.ones(len(x))).probability(x) > 0.99).all()


def test_loose_text_beside_kept_blocks_is_a_block(model):
    long = "The long article text stands right in the body of the page, as old pages have it. It goes on for some time, with <b>marks</b> and all."
    plain = long.replace("<b>", "").replace("</b>", "")
    page = f"<html><body>\n<h1>Title</h1>{long}<br><br>And more of it, which is told here.\n<p>The last part of the text, said in a paragraph.</p> {long}</body></html>"
    assert D.extract_text([page], model) == [
        f"Title\n{plain} And more of it, which is told here.\nThe last part of the text, said in a paragraph.\n{plain}"
    ]
    nodes = D.parse(page)
    assert [n.tag for n in nodes] == ["#root", "html", "body", "h1", "p", "p", "p"] and [n.loose for n in nodes] == [False] * 4 + [True, False, True]
    links = "<a href=x>Home</a> <a href=y>News</a> <a href=z>Sport</a>"
    inside = D.extract_text([f"<body>{links}<article><h1>T</h1><p>{long}</p></article></body>"], model)[0]
    assert inside == f"T\n{plain}"


def test_share_of_equal_siblings_at_every_size():
    for n in (5, 198, 199, 200, 1000):
        nodes = D.parse("<body><nav>x</nav>" + "<p>text</p>" * n + "</body>")
        x = D.node_features(nodes, {})
        share = {node.tag: row[D.NUMBERS.index("equal_siblings")] for node, row in zip(nodes, x)}
        assert share["nav"] == pytest.approx(1 / (n + 1)) and share["p"] == pytest.approx(n / (n + 1))
