"""HTML extraction by a tree-structured graphical model.

Every block element of a page is content or not.  An element's own features
give its unary potential, parent and child are tied by pair potentials, and
sum-product messages pass up and down the tree; the text of the elements whose
marginal exceeds one half is the page's main text.  The potentials are trained
by gradient ascent on the exact likelihood of labelled pages.
"""

from __future__ import annotations

import html as html_lib
import random
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import small_batches

CHUNK_CHARS = 1 << 20
#: Labelled pages that the potentials are trained on; they come from :func:`labelled_page`.
TRAINING_PAGES = 600
STEPS, RATE, RIDGE = 300, 0.1, 1e-4

# Element kinds of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe xmp noembed noframes svg math select button object canvas audio video".split())
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre search section summary table caption tbody td tfoot th thead tr ul head".split()
)
CLOSES_P = BLOCK - {"html", "body", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "li", "dd", "dt"}
#: An opening tag closes the nearest of these, unless one of the walls stands between.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead"}, {"table"}),
    "tfoot": ({"tbody", "thead"}, {"table"}),
}
TAGS = (
    "html", "body", "article", "main", "section", "div", "nav", "header", "footer", "aside", "form", "fieldset", "p", "h1",
    "h2", "h3", "ul", "ol", "li", "dl", "blockquote", "pre", "figure", "figcaption", "table", "td", "address", "details", "dialog", "menu", "head",
)
#: Words of class, id and role attributes, by what they tell.
HINTS = {
    "content": "article content main post entry body story text page prose",
    "menu": "nav menu navigation navbar breadcrumb breadcrumbs pagination pager tabs toc toolbar skip",
    "head": "header head masthead banner topbar logo branding",
    "foot": "footer foot contentinfo copyright legal bottom colophon",
    "side": "sidebar aside side rail complementary widget widgets",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion",
    "notice": "notice cookie cookies consent alert popup modal overlay dialog gdpr privacy warning message toast announcement",
    "comment": "comment comments reply replies respond discussion disqus reader readers",
    "share": "share sharing social related recommended recommendations more popular trending tags meta byline author",
    "form": "form login signin signup subscribe subscription newsletter search contact",
}
_HINT_OF = {w: i for i, words in enumerate(HINTS.values()) for w in words.split()}
_TAG_OF = {t: i for i, t in enumerate(TAGS)} | {"h4": TAGS.index("h3"), "h5": TAGS.index("h3"), "h6": TAGS.index("h3"), "th": TAGS.index("td"), "tr": TAGS.index("table"), "tbody": TAGS.index("table"), "thead": TAGS.index("table"), "tfoot": TAGS.index("table"), "dt": TAGS.index("dl"), "dd": TAGS.index("dl"), "caption": TAGS.index("figcaption"), "summary": TAGS.index("details"), "search": TAGS.index("form"), "legend": TAGS.index("fieldset"), "center": TAGS.index("div"), "hgroup": TAGS.index("section"), "dir": TAGS.index("ul")}
_TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre figure figcaption table caption tbody thead tfoot tr td th".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|</(?P<close>[a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"|<(?P<open>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<loose>[a-zA-Z][^\s/>]*+)(?P<rest>[^>]*+)(?:>|\Z)",
    re.S,
)
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_WORD = re.compile(r"[a-z]+")

LENGTHS, SHARES = (1, 12, 40, 120, 400), (0.001, 0.2, 0.5, 0.8)
N_UNARY = len(TAGS) + 1 + len(HINTS) + 1 + (len(LENGTHS) + 1) + 2 * (len(SHARES) + 1) + 2


class Page:
    """The block elements of a page, in page order, and the pieces of text that belong to each."""

    def __init__(self, source: str):
        self.parent, self.tag, self.hints, self.hidden = [-1], ["html"], [()], [False]
        self.pieces: list[tuple[int, int, str, bool]] = []  # element, block, text, within a link
        self._read(source)

    def _read(self, s: str) -> None:
        stack: list[tuple[str, int]] = [("html", 0)]  # tags and their block elements
        at, block, links, end = 0, 0, 0, len(s)
        while at < end:
            m = _TOKEN.search(s, at)
            if m is None:
                self._text(stack[-1][1], block, s[at:], links > 0)
                break
            if m.start() > at:
                self._text(stack[-1][1], block, s[at : m.start()], links > 0)
            at = m.end()
            name = m["open"] or m["loose"]
            if name:
                name = name.lower()
                attrs = m["attrs"] if m["open"] else m["rest"]
                if name in RAW:
                    if not attrs.endswith("/"):
                        stop = re.compile(rf"</{re.escape(name)}\b[^>]*+(?:>|\Z)", re.I).search(s, at)
                        at = stop.end() if stop else end
                    self.pieces.append((stack[-1][1], block, " ", False))
                elif name == "br" or name in VOID and name not in BLOCK:
                    self.pieces.append((stack[-1][1], block, " ", False))
                elif name == "hr":
                    block += 1
                elif name in ("html", "body") and any(t == name for t, _ in stack):
                    pass
                elif name in BLOCK:
                    block += 1
                    if name in CLOSES_P:
                        self._shut(stack, {"p"}, {"table", "td", "article", "section", "aside"})
                    if name in IMPLIED:
                        self._shut(stack, *IMPLIED[name])
                    links = sum(t == "a" for t, _ in stack)
                    words = {w for g in _NAMED.findall(attrs) for w in _WORD.findall("".join(g).lower())} if attrs else ()
                    self.parent.append(stack[-1][1])
                    self.tag.append(name)
                    self.hints.append(tuple({_HINT_OF[w] for w in words if w in _HINT_OF}))
                    self.hidden.append(bool(attrs and _HIDDEN.search(attrs)))
                    stack.append((name, len(self.tag) - 1))
                elif not attrs.endswith("/"):
                    links += name == "a"
                    stack.append((name, stack[-1][1]))
            elif m["close"]:
                name = m["close"].lower()
                if name in BLOCK:
                    block += 1
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == name:
                        if name not in ("html", "body"):
                            del stack[i:]
                        break
                    if name not in BLOCK and stack[i][0] in BLOCK:
                        break
                links = sum(t == "a" for t, _ in stack) if links else 0

    @staticmethod
    def _shut(stack: list, names: set, walls: set) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                del stack[i:]
                return
            if stack[i][0] in walls:
                return

    def _text(self, element: int, block: int, text: str, link: bool) -> None:
        self.pieces.append((element, block, html_lib.unescape(text) if "&" in text else text, link))

    def main_text(self, keep) -> str:
        """Blocks of the kept elements in page order, white space folded, joined by line feeds."""
        out, last, parts = [], None, []
        for element, block, text, _ in self.pieces:
            if keep[element]:
                if block != last and parts:
                    out.append("".join(parts))
                    parts = []
                last = block
                parts.append(text)
        out.append("".join(parts))
        folded = (" ".join(x.split()) for x in out)
        return "\n".join(x for x in folded if x)


def features(pages: list[Page]) -> dict[str, np.ndarray]:
    """Unary features of all elements (row, column, value), and the forest that they form.

    A textual element's features are divided by the number of its siblings, so
    many short paragraphs together say no more than one long one.
    """
    parent, kind, rows, cols, depth, values = [], [], [], [], [], []
    for page in pages:
        base, n = len(parent), len(page.tag)
        own, linked, stops = [0] * n, [0] * n, [0] * n
        for element, _, text, link in page.pieces:
            size = len(text.strip())
            own[element] += size
            linked[element] += size if link else 0
            stops[element] += text.count(".") if size else 0
        total, total_links = own[:], linked[:]
        for i in range(n - 1, 0, -1):
            total[page.parent[i]] += total[i]
            total_links[page.parent[i]] += total_links[i]
        whole = max(1, total[0])
        siblings = [0] * n
        for p in page.parent[1:]:
            siblings[p] += 1
        for i in range(n):
            p = page.parent[i]
            parent.append(base + p if p >= 0 else -1)
            depth.append(depth[base + p] + 1 if p >= 0 else 0)
            kind.append(int(page.tag[i] in _TEXTUAL))
            at = [_TAG_OF.get(page.tag[i], len(TAGS))]
            offset = len(TAGS) + 1
            at += [offset + h for h in page.hints[i]]
            offset += len(HINTS)
            if page.hidden[i]:
                at.append(offset)
            offset += 1
            at.append(offset + sum(own[i] >= x for x in LENGTHS))
            offset += len(LENGTHS) + 1
            density = total_links[i] / total[i] if total[i] else 0.0
            at.append(offset + sum(density >= x for x in SHARES))
            offset += len(SHARES) + 1
            at.append(offset + sum(total[i] / whole >= x for x in SHARES))
            offset += len(SHARES) + 1
            at.append(offset + (stops[i] > 0))
            rows += [base + i] * len(at)
            cols += at
            values += [1 / siblings[p] if kind[-1] and p >= 0 else 1.0] * len(at)
    return {"parent": np.array(parent), "kind": np.array(kind), "depth": np.array(depth), "rows": np.array(rows), "cols": np.array(cols), "values": np.array(values)}


def sum_product(unary: np.ndarray, tie: np.ndarray, x: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of content for all elements, and of (parent, child) label pairs for each child.

    ``unary`` is the log potential of content against the rest; ``tie[kind]`` holds
    the log pair potentials.  Messages pass up the levels of the forest, then down.
    """
    n = len(unary)
    up = np.zeros((n, 2))  # belief of the subtree below and at the element
    up[:, 1] = unary
    sent = np.zeros((n, 2))
    levels = [np.flatnonzero(x["depth"] == d) for d in range(int(x["depth"].max(initial=0)) + 1)]
    psi = tie[x["kind"]]  # element, parent label, own label
    for at in reversed(levels[1:]):
        joint = psi[at] + up[at][:, None, :]
        sent[at] = np.logaddexp(joint[:, :, 0], joint[:, :, 1])
        sent[at] -= sent[at].max(1, keepdims=True)
        np.add.at(up, x["parent"][at], sent[at])
    full = up.copy()
    pairs = np.zeros((n, 2, 2))
    for at in levels[1:]:
        outside = full[x["parent"][at]] - sent[at]
        joint = outside[:, :, None] + psi[at] + up[at][:, None, :]
        joint = np.exp(joint - joint.max((1, 2), keepdims=True))
        pairs[at] = joint / joint.sum((1, 2), keepdims=True)
        full[at] = np.log(np.maximum(pairs[at].sum(1), 1e-300))
    return 1 / (1 + np.exp(np.clip(full[:, 0] - full[:, 1], -40, 40))), pairs


class TreeField:
    """Trained potentials."""

    def __init__(self):
        self.weights, self.tie = np.zeros(N_UNARY), np.zeros((2, 2, 2))

    def marginals(self, pages: list[Page]) -> list[np.ndarray]:
        x = features(pages)
        content, _ = sum_product(np.bincount(x["rows"], self.weights[x["cols"]] * x["values"], len(x["parent"])), self.tie, x)
        return np.split(content, np.cumsum([len(p.tag) for p in pages])[:-1])

    def extract(self, sources: list[str]) -> list[str]:
        pages = [Page(s) for s in sources]
        return [p.main_text(m > 0.5) for p, m in zip(pages, self.marginals(pages), strict=True)] if pages else []


def fit(pages: list[Page], labels: list[list[bool]]) -> TreeField:
    """Gradient ascent (Adam) on the likelihood of the elements' labels."""
    model = TreeField()
    x = features(pages)
    gold = np.concatenate(labels).astype(float)
    child = x["parent"] >= 0
    gold_pairs = np.zeros((len(gold), 2, 2))
    gold_pairs[np.flatnonzero(child), gold[x["parent"][child]].astype(int), gold[child].astype(int)] = 1
    state = [np.zeros(N_UNARY + 8), np.zeros(N_UNARY + 8)]
    for step in range(1, STEPS + 1):
        content, pairs = sum_product(np.bincount(x["rows"], model.weights[x["cols"]] * x["values"], len(gold)), model.tie, x)
        slope = np.bincount(x["cols"], (gold - content)[x["rows"]] * x["values"], N_UNARY)
        ties = np.stack([(gold_pairs - pairs)[child & (x["kind"] == k)].sum(0) for k in (0, 1)])
        g = np.concatenate([slope, ties.ravel()]) / len(pages) - RIDGE * np.concatenate([model.weights, model.tie.ravel()])
        state[0] = 0.9 * state[0] + 0.1 * g
        state[1] = 0.99 * state[1] + 0.01 * g * g
        move = RATE * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-6)
        model.weights = model.weights + move[:N_UNARY]
        model.tie = model.tie + move[N_UNARY:].reshape(2, 2, 2)
    return model


def labelled_page(rng: random.Random) -> str:
    """A page drawn from a family of layouts.

    Elements of the article carry the attribute ``data-keep``, which the model
    does not read; :func:`labels_of` does.
    """
    syllables = "ka to mi re sol ven dar lu pe on tri na bel qu ist or".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    say = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))
    para = lambda: rng.choice((". ", ". ", ". ", " ")).join(say(1, 18).capitalize() for _ in range(rng.choice((1, 1, 2, 5)))) + rng.choice((".", ".", ".", "!", "?", ""))
    long_para = lambda: rng.choice((". ", ". ", " ", "; ")).join(say(1, 24).capitalize() for _ in range(rng.choice((1, 3, 8, 40)))) + rng.choice((".", ".", ""))
    link = lambda: f'<a href="/{word()}">{say(1, 3)}</a>'
    some = lambda p: rng.random() < p
    named = lambda *names: rng.choice(("class", "id", "class")) + f'="{rng.choice(names)}"'
    menu = lambda: "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(rng.randint(3, 8))) + "</ul>"
    k = " data-keep"
    extras = [
        lambda: f"<div {named('ad', 'advert', 'ads-box', 'sponsored', 'promo')}>{rng.choice((para, para, long_para, link))()}</div>",
        lambda: f"<div {named('share', 'social', 'related', 'more-stories')}>{rng.choice((menu, link))()}</div>",
        lambda: f"<aside{rng.choice(('', ' class=widget', ' class=sidebar'))}><h3>{say(1, 3)}</h3><p>{para()}</p>{menu() if some(0.5) else ''}</aside>",
        lambda: f"<div {named('notice', 'cookie-notice', 'alert', 'gdpr', 'popup')}><p>{para()}</p></div>",
        lambda: f"<form {named('subscribe', 'newsletter', 'search', 'login')}><p>{say(2, 8)}</p><label>{say(1, 2)}</label><input></form>",
        lambda: f"<form><label>{say(1, 2)}</label><input><p>{say(1, 6)}</p></form>",
        lambda: f"<div {named('sidebar', 'side-bar', 'widget')}>{rng.choice((menu(), f'<p>{para()}</p>'))}</div>",
    ]

    terse = some(0.2)  # a page of short lines without stops

    def body_block() -> str:
        roll = rng.random()
        if terse and roll < 0.9:
            return f"<p{k}>{say(1, rng.choice((2, 6, 30)))}</p>"
        if roll < 0.72:
            inner = rng.choice((para, long_para))()
            if some(0.15):
                inner += f" {link()} {say(2, 9)}."
            return f"<p{k}>{inner}" + rng.choice(("</p>", "</p>", "</p>", "<br></p>"))
        if roll < 0.8:
            return f"<h2{k}>{say(1, 6)}</h2>"
        if roll < 0.88:
            return f"<ul{k}>" + "".join(f"<li{k}>{say(1, 12)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>"
        if roll < 0.92:
            return f"<blockquote{k}><p{k}>{para()}</p></blockquote>"
        if roll < 0.95:
            return f"<pre{k}>{say(3, 20)}</pre>"
        if roll < 0.97:
            return f"<table{k}><tr{k}><td{k}>{say(1, 3)}</td><td{k}>{say(1, 3)}</td></tr></table>"
        return f"<figure{k}><img src=x><figcaption{k}>{say(2, 8)}</figcaption></figure>"

    def comments() -> str:
        one = lambda: rng.choice((f"<div class=comment><p>{para()}</p></div>", f"<article class=comment><p>{para()}</p></article>", f"<li class=comment><p>{para()}</p></li>", f"<p>{para()}</p>"))
        return f"<{(t := rng.choice(('section', 'div')))} {named('comments', 'reader-comments', 'replies', 'discussion')}><h3>{say(1, 2)}</h3>" + "".join(one() for _ in range(rng.randint(1, 5))) + f"</{t}>"

    blocks = [f"<h1{k}>{say(1, 9)}</h1>"] if some(0.85) else []
    blocks += [body_block() for _ in range(rng.choice((1, 1, 1, 2, 4, 8, 14, 30, 60 if terse else 14)))]
    for extra in extras:
        if some(0.1):
            blocks.insert(rng.randint(0, len(blocks)), extra())
    if some(0.15):
        blocks.append(comments())
    inner = "".join(blocks)
    wrap = rng.choice((f"<article{k}>", f"<article{k}>", f"<article{k} class=post>", f"<main{k}>", f"<div{k} class=content>", f"<div{k} id=main-content>", f"<div{k} class=article-body>", f"<section{k} class=story>"))
    inner = wrap + inner + f"</{wrap[1:].split(' ')[0]}>"
    top = []
    if some(0.5):
        top.append(f"<header{rng.choice(('', ' class=masthead'))}>{rng.choice((f'<p>{say(1, 5)}</p>', f'<h1>{say(1, 3)}</h1>', ''))}{f'<nav>{menu()}</nav>' if some(0.5) else ''}</header>")
    if some(0.7):
        top.append(rng.choice((f"<nav>{menu()}</nav>", f"<div {named('menu', 'nav', 'navbar', 'breadcrumbs')}>{menu()}</div>")))
    for extra in extras:
        if some(0.2):
            top.append(extra())
    after = [comments()] if some(0.25) else []
    after += [extra() for extra in extras if some(0.15)]
    if some(0.85):
        foot = f"&copy; {say(1, 10)}."
        after.append(rng.choice((f"<footer>{foot}</footer>", f"<footer><p>{foot}</p></footer>", f"<div {named('footer', 'copyright')}>{foot}{menu()}</div>")))
    if some(0.4):
        outer = rng.choice(("<div class=wrapper>", "<div>", "<div id=page>", "<main>", "<div class=container>")).replace(">", f"{k}>")
        inner = outer + inner + f"</{outer[1:].split(' ')[0].split('>')[0]}>"
    return f"<!DOCTYPE html><html><head><title>{say(2, 5)}</title></head><body{k}>{''.join(top)}{inner}{''.join(after)}</body></html>"


def labels_of(source: str) -> tuple[Page, list[bool]]:
    """A labelled page's elements and their labels."""
    page = Page(source)
    kept: list[bool] = [True]
    for m in _TOKEN.finditer(source):
        name = m["open"]
        if name and name.lower() in BLOCK and name.lower() not in ("html", "hr"):
            kept.append("data-keep" in m["attrs"])
    return page, kept


@cache
def trained(pages: int = TRAINING_PAGES, seed: int = 11) -> TreeField:
    """The field fitted on that many labelled pages; the same each time."""
    rng = random.Random(seed)
    found = [labels_of(labelled_page(rng)) for _ in range(pages)]
    return fit([p for p, _ in found], [k for _, k in found])


def _slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    sizes = np.nan_to_num(np.array(pa.compute.binary_length(batch.column(text)).to_numpy(zero_copy_only=False), float))
    ends = (np.cumsum(sizes) // CHUNK_CHARS).astype(int)
    cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(ends)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def extract_pages(pages: DataFrame, model: TreeField | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Main text of every page.

    Returns one row per input row: ``page_id``, ``url``, ``text`` (blocks joined
    by line feeds; empty if there is none) and ``n_chars`` (code points).  Null
    or empty html gives an empty text; broken or cut markup is read as far as
    it goes; null ids and repeated rows stay; other columns are not read.
    """
    field = model or trained()
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, 2):
                texts = field.extract([s or "" for s in part.column(2).to_pylist()])
                sizes = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
