"""Main text of web pages by boosted trees over DOM nodes (operator 8).

A page becomes a tree of block elements.  Gradient-boosted trees give each node a
probability of belonging to the article from its features: text, link and mark
densities of its subtree, place and weight among its siblings, depth, its tag and its
ancestors' tags, and its own and its ancestors' attribute tokens (class, id, role),
by what such tokens said in training.  No list of words takes part in that.  Hierarchical decoding then picks the
most probable consistent labels: below a dropped node everything is dropped, below a
kept node each child is decided by its own subtree (a bottom-up minimum of summed log
costs).

The trees learn from weak labels: on a bounded sample of the pages, and on a small
set of seed pages made from the word lists below, nodes whose tag or attribute
tokens say what they are teach the rest.  Each page is learnt from as it is, with its
attribute tokens replaced by meaningless ones, and with its telling tags taken away as
well, so that the trees know articles by their build where nothing names them.  Every
page is then scored by Spark tasks, each on its own.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiflow.llm.boosting import BoostedTrees
from lexiflow.llm.common import bounded_sample, text_or_empty

#: The trees are trained on so many pages of at most so many characters (a bounded sample).
SAMPLE_PAGES, SAMPLE_CHARS = 400, 100_000

#: Elements by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noframes xmp".split())
NO_TEXT = RAW | frozenset("head svg object select button canvas audio video datalist".split())
INLINE = frozenset(
    "a math mrow mi mo mn msup msub mfrac msqrt mtext abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
#: A start tag ends these open elements, up to the nearest of the second set.
IMPLIED = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu", "dir"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "option": (frozenset({"option"}), frozenset({"select"})),
    "body": (frozenset({"head"}), frozenset({"html"})),
}
BOILER_TAGS = frozenset("nav footer aside form menu dialog".split())
MAIN_TAGS = frozenset("article main".split())
BOILER_WORDS = frozenset(
    "ad ads adv advert advertisement adverts banner sponsor sponsored promo promoted promotion outbrain taboola sidebar side aside rail widget menu "
    "nav navbar navigation breadcrumb breadcrumbs topbar toolbar header masthead footer foot colophon copyright legal cookie cookies consent gdpr "
    "notice notification alert popup modal overlay dialog newsletter subscribe subscription signup login register search share sharing social related "
    "recommend recommended recommendations more trending popular tags pagination pager comment comments commentlist disqus reply replies respond "
    "discussion form contact skip hidden paywall".split()
)
MAIN_WORDS = frozenset("article articlebody content entry main post story text body prose copy".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
MAIN_ROLES = frozenset("main article".split())
TAGS = "article main section div p h1 h2 h3 h4 ul ol li dl table tr td blockquote pre figure header footer nav aside form".split()
#: Buckets of hashed attribute tokens; a token is known from so many training nodes on.
BUCKETS, KNOWN_FROM = 1 << 20, 3
#: Weight of what is learnt from a page without its names, against the page as it is.
UNNAMED = 0.03
#: Elements of the page itself, always open; a run of loose text in them is a block of its own.
FRAME = frozenset(("#root", "html", "body"))

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|([^<]+)|(<)", re.S
)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


class Node:
    __slots__ = ("tag", "parent", "children", "words", "role", "hidden", "depth", "pieces", "linked", "index", "loose")

    def __init__(self, tag: str, parent: Node | None, attrs: str, loose: bool = False):
        self.tag, self.parent, self.loose = tag, parent, loose
        self.depth = parent.depth + 1 if parent else 0
        self.children: list[Node] = []
        self.pieces: list[str | Node] = []  # own inline text and child nodes, in page order
        self.linked = 0
        self.words, self.role, self.hidden = (), "", False
        if attrs and "=" in attrs or "hidden" in attrs:
            found = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(attrs)}
            self.words = tuple(w.lower() for k in ("class", "id") for w in _PART.findall(entities.unescape(found.get(k, ""))))
            self.role = found.get("role", "").strip().lower()
            style = found.get("style", "").replace(" ", "").lower()
            self.hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in style


def parse(page: str) -> list[Node]:
    """The block nodes of a page in document order; the first is the root.

    Inline elements are text of the block around them; a run of text that stands directly
    in the page's own elements is a paragraph without a tag (``loose``).  Missing end tags are implied
    as browsers do for paragraphs, list items, cells; what is still open at the end ends there.
    """
    root = Node("#root", None, "")
    nodes, here = [root], root
    stack: list[tuple[str, Node]] = [("#root", root)]  # open elements, inline ones too, each with its block
    links = silent = 0
    at, size = 0, len(page)
    match = _TOKEN.match

    def block(text: str) -> Node:
        if here.tag not in FRAME:
            return here
        if not (here.pieces and here.pieces[-1].loose):
            if not text.strip():
                return Node("p", here, "")  # space between blocks belongs to none
            node = Node("p", here, "", True)
            here.children.append(node)
            here.pieces.append(node)
            nodes.append(node)
        return here.pieces[-1]

    while at < size:
        m = match(page, at)
        if m is None:  # no token starts here: one character of text
            at += 1
            continue
        at = m.end()
        text = m[7] or m[8]
        if text is not None:
            if not silent:
                to = block(text)
                to.pieces.append(text)
                if links:
                    to.linked += len(text)
            continue
        tag = m[2] or m[5]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1] or m[4]:  # an end tag
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    for name, _ in stack[k:]:
                        links -= name == "a"
                        silent -= name in NO_TEXT
                    del stack[k:]
                    here = stack[-1][1]
                    break
            continue
        if tag in VOID:
            if not silent and tag in ("br", "wbr", "hr", "img"):
                block("").pieces.append(" " if tag != "wbr" else "")
            continue
        ends, limit = IMPLIED.get(tag, ((), ()))
        if tag in CLOSES_P:
            ends, limit = frozenset({"p"}), frozenset({"button", "table", "td", "th", "li", "body", "div", "article", "section"}) - {tag if tag == "p" else ""}
        if ends:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in ends:
                    for name, _ in stack[k:]:
                        links -= name == "a"
                        silent -= name in NO_TEXT
                    del stack[k:]
                    here = stack[-1][1]
                    break
                if stack[k][0] in limit:
                    break
        if tag in RAW:  # its content is no markup: go on behind its end tag
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag in NO_TEXT:
            silent += 1
            stack.append((tag, here))
        elif tag in INLINE:
            links += tag == "a"
            stack.append((tag, here))
        else:
            node = Node(tag, here, m[3] or m[6] or "")
            if not silent:
                here.children.append(node)
                here.pieces.append(node)
                nodes.append(node)
            stack.append((tag, node))
            here = node
    for i, node in enumerate(nodes):
        node.index = i
    return nodes


def _boiler(node: Node) -> bool:
    if node.tag in FRAME or node.tag in MAIN_TAGS:
        return node.hidden
    return node.hidden or node.tag in BOILER_TAGS or node.role in BOILER_ROLES or any(w in BOILER_WORDS for w in node.words)


def _main(node: Node) -> bool:
    return node.tag in MAIN_TAGS or node.role in MAIN_ROLES or any(w in MAIN_WORDS for w in node.words)


NUMBERS = (
    "own_text text text_per_tag link_density own_link_density mark_density depth siblings tags equal_siblings children hidden "
    "order largest_sibling parent_links mean_child named loose text_per_mark own_low own_high above_low above_high"
).split()
OWN_TAG = len(NUMBERS)
ABOVE_TAG = OWN_TAG + len(TAGS)
FEATURES = ABOVE_TAG + len(TAGS)
_SLOT = {t: k for k, t in enumerate(TAGS)}


def tokens(node: Node) -> list[int]:
    """Buckets of a node's tag and attribute tokens."""
    said = [f"<{node.tag}", *node.words, *([f"role={node.role}"] if node.role else [])]
    return [zlib.crc32(w.encode()) % BUCKETS for w in said]


def token_scores(pages: Iterable[tuple[list[Node], np.ndarray]]) -> dict[int, float]:
    """What a token (its bucket) says: the log odds of the labels of the training nodes that bear it."""
    counts: dict[int, list[int]] = {}
    for nodes, labels in pages:
        for node, y in zip(nodes, labels):
            if y >= 0 and not (_main(node) and _boiler(node)):  # of one named both ways it isn't known which name says it
                for t in set(tokens(node)):
                    counts.setdefault(t, [0, 0])[int(y)] += 1
    return {t: math.log((yes + 0.5) / (no + 0.5)) for t, (no, yes) in counts.items() if yes + no >= KNOWN_FROM}


def _totals(nodes: list[Node]) -> np.ndarray:
    """(characters, linked characters, marks, tags) of every subtree."""
    own = np.array([(sum(len(p) for p in n.pieces if type(p) is str), n.linked, sum(p.count(".") + p.count(",") for p in n.pieces if type(p) is str), 1) for n in nodes], float)
    for i in range(len(nodes) - 1, 0, -1):
        own[nodes[i].parent.index] += own[i]
    return own


def node_features(nodes: list[Node], scores: dict[int, float]) -> np.ndarray:
    """A row per node.  Numbers are densities of its subtree, its place and weight among its siblings, and
    the least and greatest of its own and of its ancestors' token scores; flags are its tag and its ancestors'."""
    n = len(nodes)
    x = np.zeros((n, FEATURES), np.float32)
    total = _totals(nodes)
    texts, links, marks, tags = total.T
    own = total[:, 0].copy()
    for node in nodes[1:]:
        own[node.parent.index] -= texts[node.index]
    same = [Counter(c.tag for c in node.children) for node in nodes]
    largest = [max((texts[c.index] for c in node.children), default=0.0) for node in nodes]
    order = np.zeros(n)
    for node in nodes:
        for k, c in enumerate(node.children):
            order[c.index] = k / len(node.children)
    named = any(node.tag in MAIN_TAGS for node in nodes)
    over = [(0.0, 0.0)] * n  # least and greatest token score above a node
    for i, node in enumerate(nodes):
        parent, row = node.parent, x[i]
        own_said = [scores[t] for t in tokens(node) if t in scores]
        least, most = min(own_said, default=0.0), max(own_said, default=0.0)
        j, siblings = 0, 1
        if parent:
            j, siblings = parent.index, len(parent.children)
            over[i] = over[j]
            row[ABOVE_TAG:] = x[j, ABOVE_TAG:]
            if parent.tag in _SLOT:
                row[ABOVE_TAG + _SLOT[parent.tag]] = 1
            before = [scores[t] for t in tokens(parent) if t in scores]
            if before:
                over[i] = min(over[j][0], *before), max(over[j][1], *before)
        if node.tag in _SLOT:
            row[OWN_TAG + _SLOT[node.tag]] = 1
        t = max(texts[i], 1.0)
        row[:OWN_TAG] = (
            math.log1p(own[i]), math.log1p(texts[i]), texts[i] / tags[i], links[i] / t, node.linked / max(own[i], 1.0), marks[i] / t,
            node.depth, siblings, tags[i], same[j][node.tag] / siblings if parent else 1.0, len(node.children), node.hidden,
            order[i], texts[i] / max(largest[j], 1.0), links[j] / max(texts[j], 1.0), math.log1p(texts[i] / max(len(node.children), 1)),
            named, node.loose, math.log1p(texts[i] / (marks[i] + 1)), least, most, *over[i],
        )
    return x


def weak_labels(nodes: list[Node]) -> np.ndarray:
    """1 article, 0 not, -1 unknown: by tags, roles and attribute words of a node and its ancestors.

    A node that is named both ways is what its build says: prose or not.  On a page that
    names no article, all that nothing marks as something else is one, but for loose runs
    of links."""
    texts, links, _, _ = _totals(nodes).T
    any_main = any(map(_main, nodes))
    y = np.full(len(nodes), -1)
    state = np.zeros(len(nodes), int)  # what holds below: 1 article, 2 something else, 3 a header outside
    for i, node in enumerate(nodes):
        above = state[node.parent.index] if node.parent else 0
        main, boiler = _main(node), _boiler(node)
        if main and boiler and not node.hidden and node.tag not in BOILER_TAGS and node.tag not in MAIN_TAGS:
            main = texts[i] >= 120 and links[i] < 0.3 * texts[i]
            boiler = not main
        if above == 2 or boiler:
            state[i] = 2
        elif main:
            state[i] = 1
        else:
            state[i] = 3 if node.tag == "header" and above != 1 else above
        if node.tag not in FRAME:
            if state[i] in (2, 3):
                y[i] = 0
            elif state[i] == 1 or not any_main:
                y[i] = 1
            if node.loose and node.linked > 0.5 * max(sum(len(p) for p in node.pieces if type(p) is str), 1):
                y[i] = 0  # a loose run of links
    return y


def seed_pages(each: int = 8) -> list[str]:
    """Pages made from the word lists, so that every listed word and element occurs in training.

    Articles and what stands around them are alike in length and build, but for links and
    single words: it is their names that tell them apart."""
    draw = random.Random(20)
    words = "stone river over garden while seven paper under light, morning between other winter. second little harbour could follow".split()
    tags, mains = sorted(BOILER_TAGS), sorted(MAIN_WORDS)
    shapes = ("p", "p", "p", "li", "td", "blockquote", "pre", "h2", "h3", "dd", "div", "figcaption", "section")
    around = {"li": "ul", "td": "table", "dd": "dl", "figcaption": "figure"}

    def said(n: int, ends: bool = True) -> str:
        return " ".join(draw.choice(words) for _ in range(n)) + ("." if ends and draw.random() < 0.7 else "")

    def block(sizes: tuple[int, ...], link: float) -> str:
        shape = draw.choice(shapes)
        one = "".join(f"<{shape}>{f'<a href=x>{text}</a>' if draw.random() < link else text}</{shape}>" for text in (said(draw.choice(sizes)) for _ in range(draw.choice((1, 1, 2, 4)))))
        one = f"<tr>{one}</tr>" if shape == "td" else one
        return f"<{around[shape]}>{one}</{around[shape]}>" if shape in around else one

    def article() -> str:
        head = f"<h1>{said(draw.randint(1, 6), False)}</h1>" if draw.random() < 0.6 else ""
        parts = [block((1, 3, 6, 12, 25, 50), 0.05) for _ in range(draw.randint(1, 6))]
        part = draw.choice(("section", "div", "div class=x"))
        return head + "".join(f"<{part}>{x}</{part.split()[0]}>" if draw.random() < 0.25 else x for x in parts)

    def other() -> str:
        return said(draw.randint(1, 9)) if draw.random() < 0.3 else "".join(block((1, 2, 3, 6, 12, 25), 0.4) for _ in range(draw.randint(1, 3)))

    def shell(word: str) -> tuple[str, str]:
        tag = draw.choice(("div", "div", "section", "ul", "p", "span div"))
        if tag == "span div":
            return f"<div role=region class='x {word}'>", "</div>"
        return f"<{tag} {draw.choice(('id', 'class'))}='{draw.choice(('', 'x-', 'site-'))}{word}'>", f"</{tag}>"

    def spread(parts: list[str]) -> str:
        draw.shuffle(parts)
        return "".join(parts)

    out = []
    for word in sorted(BOILER_WORDS) * each:
        opens, closes = shell(word)
        marked = opens + other() + closes
        tag, role = draw.choice(tags), draw.choice(sorted(BOILER_ROLES))
        extra = f"<{tag}>{other()}</{tag}>" if draw.random() < 0.7 else f"<div role={role}>{other()}</div>"
        begin, end = draw.choice((("<article>", "</article>"), ("<main>", "</main>"), (f"<div class='{draw.choice(mains)}'>", "</div>"), (f"<section id='{draw.choice(mains)}'>", "</section>"), ("", "")))
        head = f"<header>{other()}</header>" if draw.random() < 0.4 else ""
        inside = spread([x for x in (marked, extra) if draw.random() < 0.4] + [article(), article()] if draw.random() < 0.5 else [article()])
        top = f"<header><h1>{said(3, False)}</h1></header>" if begin and draw.random() < 0.2 else ""
        out.append(f"<html><body>{head}{spread([marked, extra, begin + top + inside + end])}</body></html>")
        kind = draw.random()
        if kind < 0.3:  # loose text and loose links beside blocks
            links = " | ".join(f"<a href=x>{said(draw.randint(1, 3), False)}</a>" for _ in range(draw.randint(2, 6)))
            told = f"<h2>{said(3, False)}</h2>{said(draw.randint(9, 60))}<br><br>{said(12)}" + (block((12, 25, 50), 0.05) if draw.random() < 0.5 else "")
            out.append(f"<html><body>{links if draw.random() < 0.5 else ''}{told}{links if draw.random() < 0.5 else ''}</body></html>")
        elif kind < 0.6:  # named both ways: what it holds decides
            both = draw.choice((f"{draw.choice(mains)} {word}", f"{draw.choice(mains)}-{word}-on"))
            prose = "".join(f"<p>{said(draw.randint(20, 60))}</p>" for _ in range(draw.randint(1, 4)))
            listed = "<ul>" + "".join(f"<li><a href=x>{said(draw.randint(1, 3), False)}</a></li>" for _ in range(draw.randint(2, 5))) + "</ul>"
            out.append(f"<html><body><nav>{other()}</nav><div class='{both}'>{prose if draw.random() < 0.7 else said(40)}</div>{marked}</body></html>")
            out.append(f"<html><body><article>{article()}</article><div class='{both}'>{listed}</div></body></html>")
            out.append(f"<html><body><div class='{both}'><article>{article()}</article></div><footer>{other()}</footer></body></html>")
        elif kind < 0.8:  # nothing but an article that nothing names
            one = "".join(f"<p>{said(draw.choice((8, 16, 30, 60)))}</p>" for _ in range(draw.randint(1, 3))) if draw.random() < 0.5 else article()
            out.append(draw.choice(("<html><body>{}</body></html>", "<div>{}</div>", "<body><div><div>{}</div></div></body>")).format(one))
    return out


@dataclass
class Extractor:
    """The trees and what attribute tokens say."""

    trees: BoostedTrees
    scores: dict[int, float]

    def probability(self, pages: list[list[Node]]) -> np.ndarray:
        return self.trees.probability(np.concatenate([node_features(nodes, self.scores) for nodes in pages]))


def _unnamed(nodes: list[Node], tags: bool) -> None:
    """Take the attribute tokens of a page away, and with ``tags`` its telling tags."""
    for node in nodes:
        node.words, node.role = (), ""
        if tags and (node.tag in BOILER_TAGS or node.tag in MAIN_TAGS or node.tag in ("header", "section")):
            node.tag = "div"


def train(pages: Iterable[str]) -> Extractor:
    parsed = [(nodes, weak_labels(nodes)) for nodes in map(parse, [*pages, *seed_pages()])]
    scores = token_scores(parsed)
    rows, labels, weights = [], [], []
    for nodes, y in parsed:
        some = y >= 0
        for weight, tags in ((1.0, None), (UNNAMED, False), (UNNAMED, True)):
            if tags is not None:
                _unnamed(nodes, tags)
            rows.append(node_features(nodes, scores)[some])
            labels.append(y[some])
            weights.append(np.full(some.sum(), weight))
    return Extractor(BoostedTrees(trees=120, depth=5, binary_from=OWN_TAG).fit(np.concatenate(rows), np.concatenate(labels).astype(float), np.concatenate(weights)), scores)


def decode(nodes: list[Node], p: np.ndarray) -> np.ndarray:
    """Kept nodes of the most probable consistent labelling; the page itself is always open."""
    p = np.clip(p, 1e-6, 1 - 1e-6)
    keep, drop = -np.log(p), -np.log1p(-p)
    for i, node in enumerate(nodes):
        if node.tag in FRAME:
            keep[i] = drop[i] = 0
    for i in range(len(nodes) - 1, 0, -1):  # children come after their parent
        j = nodes[i].parent.index
        keep[j] += min(keep[i], drop[i])
        drop[j] += drop[i]
    kept = np.zeros(len(nodes), bool)
    for i, node in enumerate(nodes):
        if node.tag in FRAME:
            kept[i] = True
        else:
            kept[i] = kept[node.parent.index] and keep[i] < drop[i]
    return kept


def main_text(nodes: list[Node], kept: np.ndarray, p: np.ndarray) -> str:
    """The blocks of the kept nodes in page order; where no node is kept, all loose text."""
    blocks: list[str] = []

    def walk(top: Node) -> None:
        stack = [(top, iter(top.pieces), [])]
        while stack:
            node, pieces, run = stack[-1]
            for piece in pieces:
                if type(piece) is str:
                    run.append(piece)
                else:
                    flush(run)
                    stack.append((piece, iter(piece.pieces), []))
                    break
            else:
                flush(run)
                stack.pop()
                continue
            if not kept[stack[-1][0].index]:
                stack.pop()

    def flush(run: list[str]) -> None:
        text = "".join(run)
        run.clear()
        if "&" in text:
            text = entities.unescape(text)
        text = " ".join(text.split())
        if text:
            blocks.append(text)

    if not any(k and n.tag not in FRAME for k, n in zip(kept, nodes)):
        kept = kept | np.array([n.loose for n in nodes])
    walk(nodes[0])
    return "\n".join(blocks)


def extract_text(pages: list[str], model: Extractor) -> list[str]:
    trees = [parse(page) for page in pages]
    if not trees:
        return []
    p = model.probability(trees)
    out, at = [], 0
    for nodes in trees:
        mine = p[at : at + len(nodes)]
        at += len(nodes)
        out.append(main_text(nodes, decode(nodes, mine), mine))
    return out


def extractor(pages: DataFrame, html_col: str = "html") -> Column:
    """Column of main texts, by trees that are trained on a bounded sample of ``pages``."""
    text = text_or_empty(html_col)
    some = pages.select(text.alias("h")).where(F.length("h").between(1, SAMPLE_CHARS))
    model = train(sorted(r.h for r in bounded_sample(some, SAMPLE_PAGES, F.col("h"))))

    @F.arrow_udf("string")
    def run(htmls: pa.Array) -> pa.Array:
        out: list[str] = []
        for start in range(0, len(htmls), 64):
            out += extract_text(htmls.slice(start, 64).to_pylist(), model)
        return pa.array(out, pa.string())

    return run(text)


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` with the main text of each page; other columns stay, ``text_col`` replaces one of its name.

    A null or empty page has an empty text; a page without markup is all text;
    repeated rows repeat; an empty table is trained on the seed pages alone.
    """
    return pages.withColumn(text_col, extractor(pages, html_col))
