"""Main text of web pages by gradient-boosted trees over DOM-node features.

A page becomes a tree of elements (a tolerant parser: unclosed paragraphs and list items end where
HTML says they do). Each element has features: its tag, the tokens of its class, id and role, its
depth, the text, links, punctuation and paragraphs in its subtree and their densities, its place
among its siblings and what its ancestors are. A token (its tag is one, too) counts by what it said of
the elements of generated pages that bore it: log odds, learned per hash bucket of the token. Boosted trees,
trained here in numpy on further generated pages whose main text is known, give the probability that
a subtree holds main text.

Decoding is hierarchical: an element is dropped with all that is in it or kept, and a kept element's
ancestors are kept; of all such choices the likeliest is found by one pass up and one down the
tree, so an ancestor and a descendant never contradict each other. Text is what kept elements
hold, in page order: one block per block element, white space as one space.

Defined results: a null or empty page, and a page without elements or with text alone, give the text
that is there. Never text, whatever the model says: comments, declarations, scripts, styles, titles,
frames' fallbacks and form fields (iframe, textarea, select), templates; all else, as math, svg, object
or noscript, is an element like any other. A script, style or such that is not closed goes on to the
page's end, as in a browser; `/>` closes only elements of svg and math. A very long page takes time
and memory in proportion to its length, however it is nested. Ties of the decoding keep an element;
repeated rows give repeated results; an empty table gives no rows; other columns are not read,
whatever their names.
"""

from __future__ import annotations

import functools
import random
import re
import zlib
from collections.abc import Iterable, Iterator
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm import _common as C

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What is in them is no markup, up to their end tag or the page's end.
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
#: What is in them is markup that is not shown, or a form's field.
HIDDEN = frozenset("template select".split())
FOREIGN = frozenset("svg math".split())
BLOCK = frozenset("html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption header footer nav aside form fieldset address details summary hr center dialog menu".split())
CLOSES_P = BLOCK - {"html", "body", "td", "th", "tr", "thead", "tbody", "tfoot", "caption"}
#: A start tag ends open elements of these kinds, up to the given borders.
SAME = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: Elements in which an outer paragraph stays open: for other elements, for a paragraph.
P_BORDERS = (("table", "td", "th", "button", "article", "section", "div", "body"), ("table", "td", "th", "article", "section", "div", "body", "blockquote", "li"))
TAGS = "body main article section div p h1 h2 h3 h4 h5 h6 ul ol li table td blockquote pre figure header footer nav aside form address a b span".split()
_TAG = {t: i + 1 for i, t in enumerate(TAGS)}
_TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</(?![a-zA-Z])[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"(class|id|role|aria-label)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_WORD = re.compile(r"[a-z]+")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for t in RAW}
#: Buckets of attribute tokens.
BUCKETS = 1 << 18


@functools.lru_cache(1 << 16)
def bucket(token: str) -> int:
    return zlib.crc32(token.encode()) % BUCKETS


class Node:
    __slots__ = ("tag", "attrs", "parent", "block", "depth", "kids", "own", "text", "link", "punct", "paras", "tags", "index", "n_links", "tokens")

    def __init__(self, tag: str, attrs: str, parent: Node | None) -> None:
        self.tag, self.attrs, self.parent = tag, attrs, parent
        #: The block element that its text belongs to.
        self.block: Node = self if parent is None or tag in BLOCK else parent.block
        self.depth = parent.depth + 1 if parent else 0
        self.kids: list[Node] = []
        self.own = self.text = self.link = self.punct = self.paras = self.tags = self.n_links = 0
        self.index = len(parent.kids) if parent else 0
        if parent:
            parent.kids.append(self)


def parse(html: str) -> tuple[list[Node], list[tuple[Node, str]]]:
    """(elements in page order, [(element, its text)] in page order); the root is the first element."""
    root = Node("#root", "", None)
    nodes, texts, stack = [root], [], [root]
    at, n = 0, len(html)
    # Places in the stack of the open elements of each tag: the innermost is found without a search.
    places: dict[str, list[int]] = {}

    def innermost(kinds: Iterable[str]) -> int:
        return max((p[-1] for t in kinds if (p := places.get(t))), default=0)

    def is_open(kinds: Iterable[str]) -> bool:
        return any(map(places.get, kinds))

    def add(text: str) -> None:
        if text and not is_open(HIDDEN):
            texts.append((stack[-1], " " if text.isspace() else unescape(text)))

    def close(kinds: Iterable[str], borders: Iterable[str] = ()) -> None:
        """End the innermost open element of these kinds, with what is open in it, unless a border or a template's begin is nearer."""
        k = innermost(kinds)
        if k > innermost(borders) and ("template" in kinds or k > innermost(("template",))):
            while len(stack) > k:
                places[stack.pop().tag].pop()

    while at < n:
        m = _TOKEN.search(html, at)
        if m is None:
            add(html[at:])
            break
        add(html[at : m.start()])
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:
            close((name,))
            continue
        foreign = name in FOREIGN or is_open(FOREIGN)
        ended = foreign and m[3].endswith("/")
        if name in RAW:
            end = None if ended else _RAW_END[name].search(html, at)
            at = at if ended else end.end() if end else n
            add(" ")
            continue
        if name == "head" or name in ("html", "body") and is_open((name,)):
            continue
        if name in CLOSES_P and not foreign:
            close(("p",), P_BORDERS[name == "p"])
        if name in SAME:
            close(*SAME[name])
        if name == "br" or name == "hr":
            texts.append((stack[-1], " " if name == "br" else "\n"))
        node = Node(name, m[3], stack[-1])
        nodes.append(node)
        if name not in VOID and not ended:
            places.setdefault(name, []).append(len(stack))
            stack.append(node)
    return nodes, texts


_PUNCT = re.compile(r"[.,;:!?]")


def measure(nodes: list[Node], texts: list[tuple[Node, str]]) -> None:
    """Sum text, links, punctuation, paragraphs and tags over subtrees; take the buckets of attribute tokens."""
    for node, text in texts:
        n = len(text.strip())
        node.own += n
        node.text += n
        node.punct += len(_PUNCT.findall(text)) if n else 0
    for node in nodes:
        node.tokens = [bucket(f"<{node.tag}")]
        if node.attrs and "=" in node.attrs:
            node.tokens += [bucket(w) for _, value in _ATTR.findall(node.attrs) for w in _WORD.findall(value.lower())]
    for node in reversed(nodes[1:]):
        p = node.parent
        if node.tag == "a":
            node.link = node.text
            node.n_links += 1
        p.text += node.text
        p.link += node.link
        p.punct += node.punct
        p.tags += node.tags + 1
        p.n_links += node.n_links
        p.paras += node.paras + (node.tag == "p" and node.text > 0)


FEATURES = ("tag", "depth", "text", "own", "link density", "text per tag", "punctuation", "paragraphs", "links", "children", "place", "siblings", "share of parent", "share of page", "sum of tokens", "least token", "most token", "tokens above", "least token above", "article above", "margin above", "largest sibling", "words per child", "place in page", "after last heading")
_MARGIN = frozenset("nav footer aside form header".split())


def token_odds(pages: Iterable[tuple[list[Node], list[bool]]]) -> np.ndarray:
    """For each bucket the log odds that an element with such a token holds main text, against those of all elements.

    One token of either class is added to each bucket, so a token that was not seen says nothing.
    """
    seen, total = np.ones((2, BUCKETS)), np.ones(2)
    for nodes, good in pages:
        for node, y in zip(nodes, good):
            total[int(y)] += 1
            for t in set(node.tokens):
                seen[int(y), t] += 1
    odds = np.log(seen[1] / seen[0])
    odds[seen.sum(0) > 2] -= np.log(total[1] / total[0])
    return np.clip(odds, -4, 4)


def features(nodes: list[Node], odds: np.ndarray) -> np.ndarray:
    """One row per element."""
    total = max(nodes[0].text, 1)
    above: dict[int, tuple[float, float, int, int]] = {id(nodes[0]): (0.0, 0.0, 0, 0)}
    largest: dict[int, int] = {}
    for node in nodes[1:]:
        k = id(node.parent)
        largest[k] = max(largest.get(k, 0), node.text)
    rows, before = [], 0
    for node in nodes:
        p = node.parent
        tokens, least, art, margin = above[id(p)] if p else (0.0, 0.0, 0, 0)
        text = node.text
        size = p.text if p else total
        n_sib = len(p.kids) if p else 1
        own = [float(odds[t]) for t in node.tokens]
        rows.append((
            _TAG.get(node.tag, 0), node.depth, min(text, 20000), min(node.own, 5000), node.link / text if text else 0.0, text / (node.tags + 1), node.punct / text if text else 0.0, min(node.paras, 50), min(node.n_links, 100), min(len(node.kids), 100),
            node.index / n_sib, min(n_sib, 100), text / size if size else 0.0, text / total, sum(own), min(own), max(own), tokens, least, art, margin, text / largest[id(p)] if p and largest[id(p)] else 0.0, text / (len(node.kids) + 1), before / total, p.index / max(len(p.parent.kids), 1) if p and p.parent else 0.0,
        ))
        before += node.own
        above[id(node)] = (tokens + sum(own), min(least, *own), art + (node.tag in ("article", "main")), margin + (node.tag in _MARGIN))
    return np.array(rows, np.float32)


class Trees:
    """Boosted regression trees of equal depth, for two classes: arrays of splits and leaves. Each tree sees a random share of the features."""

    def __init__(self, depth: int = 4, rounds: int = 80, rate: float = 0.2, bins: int = 32, share: float = 0.5, least: float = 2.0, ridge: float = 2.0) -> None:
        self.depth, self.rounds, self.rate, self.bins, self.share, self.least, self.ridge = depth, rounds, rate, bins, share, least, ridge

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
        rng = np.random.default_rng(0)
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], 1)
        n_nodes = (1 << self.depth) - 1
        self.feature, self.cut, self.leaf = np.zeros((self.rounds, n_nodes), np.int32), np.full((self.rounds, n_nodes), np.inf, np.float32), np.zeros((self.rounds, 1 << self.depth), np.float32)
        self.base = float(np.log((weight * y).sum() / (weight * (1 - y)).sum()))
        z = np.full(len(y), self.base)
        for t in range(self.rounds):
            p = 1 / (1 + np.exp(-z))
            g, h = weight * (y - p), weight * p * (1 - p)
            at = np.zeros(len(y), np.int64)
            seen = np.sort(rng.permutation(x.shape[1])[: max(1, int(self.share * x.shape[1]))])
            for level in range(self.depth):
                first, width = (1 << level) - 1, 1 << level
                best = np.full(width, 1e-6)
                for f in seen:
                    nb = len(cuts[f]) + 1
                    if nb < 2:
                        continue
                    key = at * nb + binned[:, f]
                    gs = np.bincount(key, weights=g, minlength=width * nb).reshape(width, nb).cumsum(1)
                    hs = np.bincount(key, weights=h, minlength=width * nb).reshape(width, nb).cumsum(1)
                    ga, ha = gs[:, -1:], hs[:, -1:]
                    gain = gs**2 / (hs + self.ridge) + (ga - gs) ** 2 / (ha - hs + self.ridge) - ga**2 / (ha + self.ridge)
                    gain[(hs < self.least) | (ha - hs < self.least)] = 0
                    k = gain[:, :-1].argmax(1)
                    value = gain[np.arange(width), k]
                    for i in np.flatnonzero(value > best):
                        best[i], self.feature[t, first + i], self.cut[t, first + i] = value[i], f, cuts[f][k[i]]
                node = first + at
                at = at * 2 + (x[np.arange(len(y)), self.feature[t, node]] > self.cut[t, node])
            gs, hs = (np.bincount(at, weights=v, minlength=1 << self.depth) for v in (g, h))
            self.leaf[t] = self.rate * gs / (hs + self.ridge)
            z += self.leaf[t][at]
        return self

    def logits(self, x: np.ndarray) -> np.ndarray:
        z, row = np.full(len(x), self.base), np.arange(len(x))
        for t in range(self.rounds):
            at = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                node = (1 << level) - 1 + at
                at = at * 2 + (x[row, self.feature[t, node]] > self.cut[t, node])
            z += self.leaf[t][at]
        return z


def decode(nodes: list[Node], logits: np.ndarray) -> list[bool]:
    """The likeliest choice in which a dropped element's descendants are dropped; the root is kept."""
    keep_log, drop_log = -np.logaddexp(0, -logits), -np.logaddexp(0, logits)
    number = {id(x): i for i, x in enumerate(nodes)}
    kept, dropped = keep_log.tolist(), drop_log.tolist()
    for i in range(len(nodes) - 1, 0, -1):
        p = number[id(nodes[i].parent)]
        kept[p] += max(kept[i], dropped[i])
        dropped[p] += dropped[i]
    out = [True] * len(nodes)
    for i in range(1, len(nodes)):
        out[i] = out[number[id(nodes[i].parent)]] and kept[i] >= dropped[i]
    return out


def text_of(nodes: list[Node], texts: list[tuple[Node, str]], keep: list[bool]) -> str:
    """Blocks of kept text, joined by line feeds. A block ends where another block element begins or ends."""
    kept = {id(x) for x, k in zip(nodes, keep) if k}
    blocks: list[str] = []
    now, parts = None, []
    for node, text in texts:
        b = node.block
        if b is not now or text == "\n":
            blocks.append("".join(parts))
            now, parts = b, []
        if id(node) in kept:
            parts.append(text)
    blocks.append("".join(parts))
    return "\n".join(x for x in (" ".join(b.split()) for b in blocks) if x)


# Generated training pages: the templates vary, the main text is known.


def _sentence(r: random.Random, words: tuple[int, int]) -> str:
    n = r.randint(*words)
    return " ".join("".join(r.choice("abcdefghilmnoprstuv") for _ in range(r.randint(2, 9))) + ("," if r.random() < 0.08 else "") for _ in range(n)).capitalize()


def _page(r: random.Random) -> str:
    """A page in which elements of the main text carry the attribute data-y."""
    style = r.choice([0, 0, 0, 0, 1, 2, 3])
    stop = " " if style == 1 else ". "

    def links(n: int) -> str:
        return "".join(f'<li><a href="/{k}">{_sentence(r, (1, 3))}</a></li>' for k in range(n))

    def cls(names: str, p: float = 0.6) -> str:
        return f' {r.choice(["class", "class", "id"])}="{r.choice(names.split())}"' if r.random() < p else ""

    def para(words: tuple[int, int] = (6, 80)) -> str:
        n = 1 if r.random() < 0.2 else max(1, r.randint(*words) // 10)
        body = stop.join(_sentence(r, (1, 20)) for _ in range(n)) + stop.rstrip()
        if style == 2:
            body = re.sub(r" ", lambda _: r.choice(["*** ", "| ", "$$$ ", "!! "]), body)
        if style == 3:
            body = " ".join([body.split()[0]] * r.randint(5, 400))
        if r.random() < 0.15:
            body = body.replace(" ", f' <a data-y href="/{r.random()}">{_sentence(r, (1, 3))}</a> ', 1)
        if r.random() < 0.2:  # inline elements, some of formulas and drawings
            t = r.choice("b i em strong code span sub sup q noscript object".split())
            body = body.replace(" ", r.choice([f" <{t} data-y>{_sentence(r, (1, 4))}</{t}> ", f" <math data-y><mi data-y>{r.choice('abxyz')}</mi><mo data-y>{r.choice('+=<')}</mo><mn data-y>{r.randint(0, 99)}</mn></math> ", f" <svg data-y><g data-y><text data-y>{_sentence(r, (1, 2))}</text></g></svg> "]), r.randint(1, 2))
        if r.random() < 0.1:
            body = f"<b data-y>{body}<br>"
        tag = r.choice(["p"] * 8 + ["div", "blockquote", "pre", "h2", "h3"])
        return f"<{tag} data-y>{body}</{tag}>" if tag != "ul" else body

    def junk() -> str:
        kind = r.randrange(11)
        if kind == 0:
            return f"<nav{cls('nav menu navbar navigation top-menu')}><ul>{links(r.randint(2, 12))}</ul></nav>"
        if kind == 1:
            return f"<div{cls('menu nav navigation breadcrumb breadcrumbs pager pagination links skip toolbar', 0.8)}><ul>{links(r.randint(2, 12))}</ul></div>"
        if kind == 2:
            return f"<aside{cls('sidebar related widget rss')}><h3>{_sentence(r, (1, 3))}</h3><ul>{links(r.randint(2, 9))}</ul><p>{_sentence(r, (4, 30))}.</p></aside>"
        if kind == 3:
            return f"<div{cls('ad ads advert advertisement sponsor sponsored promo banner', 0.95)}>{r.choice(['', '<p>'])}{_sentence(r, r.choice([(1, 4), (3, 30)]))}{r.choice('..!')}</div>"
        if kind == 4:
            return f"<div{cls('cookie cookies cookie-notice consent gdpr notice newsletter popup dialog modal', 0.95)}><p>{_sentence(r, (5, 40))}.</p><button>{_sentence(r, (1, 1))}</button></div>"
        if kind == 5:
            return f"<form{cls('search login signup subscribe form feedback')}><label>{_sentence(r, (1, 3))}</label><input><button>{_sentence(r, (1, 2))}</button></form>"
        if kind == 6:
            return f"<div{cls('share sharing social tags meta', 0.9)}>" + "".join(f'<a href="#">{_sentence(r, (1, 2))}</a> ' for _ in range(r.randint(2, 6))) + "</div>"
        if kind == 7:
            tag = r.choice(["section", "div", "ol"])
            item = "li" if tag == "ol" else "div"
            return f"<{tag}{cls('comments comment-list replies respond feedback disqus', 1)}><h3>{_sentence(r, (1, 2))}</h3>" + "".join(f"<{item}{cls('comment reply', 0.7)}><p>{_sentence(r, (3, 60))}.</p></{item}>" for _ in range(r.randint(1, 8))) + f"</{tag}>"
        if kind == 8:
            return f"<div{cls('related recommended promoted links', 0.9)}><h4>{_sentence(r, (1, 3))}</h4><ul>{links(r.randint(2, 6))}</ul></div>"
        if kind == 9:
            return f"<div{cls('sidebar widget')}><h3>{_sentence(r, (1, 3))}</h3><ul>{links(r.randint(2, 8))}</ul></div>"
        return f"<p{cls('copyright legal notice foot', 0.95)}>&copy; {_sentence(r, (2, 20))}.</p>"

    inner = [f"<h1 data-y>{_sentence(r, (1, 12))}</h1>"] * (r.random() < 0.8) + [para() for _ in range(r.choice([1, 1, 2, 3, 4, 6, 9, 14, 25]))]
    if r.random() < 0.15:  # next to nothing, and less than what is around it
        title = _sentence(r, (1, 8)) + "."
        inner = [f"<h1 data-y>{title}</h1>"] * (r.random() < 0.8) + [r.choice([f"<p data-y>{title}</p>", f"<p data-y><b data-y>{title}<br>", f"<div data-y>{title}</div>"])]
    if r.random() < 0.2:
        inner.append("<ul data-y>" + "".join(f"<li data-y>{_sentence(r, (3, 25))}.</li>" for _ in range(r.randint(2, 8))) + "</ul>")
    if r.random() < 0.1:
        inner.append("<table data-y>" + "".join(f"<tr data-y><td data-y>{_sentence(r, (1, 5))}</td><td data-y>{_sentence(r, (1, 5))}</td></tr>" for _ in range(r.randint(2, 6))) + "</table>")
    for _ in range(r.choice([0, 0, 0, 1, 1, 2])):
        inner.insert(r.randint(1, len(inner)), junk())
    tag = r.choice(["article"] * 4 + ["main", "div", "div", "section"])
    named = cls("article content post entry story main text article-body post-content", 0.4 if tag in ("article", "main") else 0.8)
    body = f"<{tag}{named}>{''.join(inner)}</{tag}>"
    for _ in range(r.randint(0, 2)):
        body = f"<{r.choice(['div', 'div', 'main', 'section'])}{cls('wrapper page container main content row')}>{body}"
    top = [junk() for _ in range(r.randint(0, 3))]
    if r.random() < 0.5:
        top.insert(0, f"<header{cls('header head masthead top')}><h1>{_sentence(r, (1, 4))}</h1><p>{_sentence(r, (2, 10))}</p></header>")
    end = [junk() for _ in range(r.randint(0, 3))]
    if r.random() < 0.8:
        t = r.choice(["footer", "footer", "div"])
        end.append(f"<{t}{cls('footer', 0.5 if t == 'footer' else 1)}>&copy; {_sentence(r, (2, 20))}{'.' if r.random() < 0.7 else ''}{'<ul>' + links(3) + '</ul>' if r.random() < 0.3 else ''}</{t}>")
    return f"<html><head><title>x</title></head><body>{''.join(top)}{body}{''.join(end)}</body></html>"


class Model(NamedTuple):
    trees: Trees
    odds: np.ndarray

    def logits(self, pages: list[list[Node]]) -> np.ndarray:
        """One number per element of all pages."""
        return self.trees.logits(np.concatenate([features(nodes, self.odds) for nodes in pages]))


def _labelled(r: random.Random, pages: int) -> Iterator[tuple[list[Node], list[bool]]]:
    """Measured elements of generated pages, and whether each holds main text."""
    for _ in range(pages):
        nodes, texts = parse(_page(r))
        measure(nodes, texts)
        y = {id(x): "data-y" in x.attrs for x in nodes}
        for x in reversed(nodes[1:]):
            y[id(x.parent)] |= y[id(x)]
        yield nodes, [y[id(x)] for x in nodes]


@functools.cache
def trained(pages: int = 2000, seed: int = 11) -> Model:
    """The model for the generated pages of a seed: the same everywhere. Tokens are learned from other pages than trees."""
    odds = token_odds(_labelled(random.Random(seed + 1), pages // 2))
    made = list(_labelled(random.Random(seed), pages))
    x, y = np.concatenate([features(nodes, odds) for nodes, _ in made]), np.array([v for _, good in made for v in good], float)
    return Model(Trees().fit(x, y, np.ones(len(y))), odds)


def extract_all(pages: list[str], model: Model) -> list[str]:
    """The main text of each page; all their elements are scored together."""
    parsed = [parse(html) for html in pages]
    for nodes, texts in parsed:
        measure(nodes, texts)
    z = model.logits([nodes for nodes, _ in parsed]) if parsed else np.empty(0)
    out, at = [], 0
    for nodes, texts in parsed:
        out.append(text_of(nodes, texts, decode(nodes, z[at : at + len(nodes)])))
        at += len(nodes)
    return out


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", model: Model | None = None) -> DataFrame:
    """One row per page: id, url, text, n_chars. Page by page: nothing is shuffled."""
    spark = df.sparkSession
    C.prepare(spark)
    shared = spark.sparkContext.broadcast(model or trained())
    src = df.select(F.col(id_col).alias("__id"), F.col(url_col).alias("__url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("__html"))
    schema = T.StructType([T.StructField(id_col, src.schema["__id"].dataType), T.StructField(url_col, src.schema["__url"].dataType), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            html, out = b["__html"].to_pylist(), []
            for lo in range(0, len(html), 64):
                out += extract_all(html[lo : lo + 64], m)
            yield pa.RecordBatch.from_arrays([b["__id"], b["__url"], pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    return src.mapInArrow(run, schema)
