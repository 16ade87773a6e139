"""Main-text extraction: gradient-boosted trees over DOM nodes, decoded over the tree.

A tolerant parser turns html into block nodes (inline markup is dissolved, void and
implicitly closed elements are known). Each node gets features: depth, text and link
density of its subtree, its share of the page, sibling statistics, and learned
log-odds of its tag and of its class and id tokens, its own and its ancestors'.
Boosted trees give each node the log-odds of holding main text. Decoding maximises
the sum over the page under the rule that a kept node has a kept parent, so no
dropped ancestor has a kept descendant.

The trees are trained on the driver from pages made by ``sample_pages``: a fixed seed
lays out articles with menus, headers, footers, sidebars, notices, adverts, forms
and comments in many shapes. No row of the input is learned from.

Defined results
* null or empty html, and html without kept text: the empty string;
* script, style, template, svg drawings, form controls and frames never give text, nor do comments; what other elements hold, formulas and fallbacks too, is scored like any text;
* character references are decoded; white space inside a block becomes one space;
  ``<br>`` is white space; blocks are joined by two line feeds in page order;
* unclosed, stray and unknown tags are accepted; repeated rows give equal texts;
* a head without end tag ends at text or at a tag that cannot stand in it; self-closed foreign elements are empty;
* text outside all blocks counts as the body's, which is implied if there is none;
* ids, urls and extra columns are carried as they are.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glosswork.llm.store import ship_package

# Kinds of elements in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style template iframe svg select textarea button title head".split())
RAW = frozenset("script style textarea title iframe template".split())
FOREIGN = frozenset("svg math".split())
METADATA = frozenset("base basefont bgsound link meta title script style template noscript noframes head".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that a start tag closes first, as far as they are open inside the named limits.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
NO_PARAGRAPH = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "li", "dd", "dt", "figcaption", "summary"} | {"p"}

TOKEN = re.compile(r"""<(?:(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|!--.*?(?:-->|\Z)|[!?/][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)([^>]*)>)""", re.S)
ATTRS = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: A slash that ends an unquoted value does not close the element.
UNQUOTED = re.compile(r"""=\s*[^\s"'=]+/\Z""")
STOPS = re.compile(r"[.,;:!?]")


class Page:
    """Block nodes in page order: parents come before children. Blocks are (node, text)."""

    __slots__ = ("attrs", "blocks", "depth", "link", "parent", "tags", "text", "tag")

    def __init__(self):
        self.tag, self.attrs, self.parent, self.depth = ["#root"], [()], [-1], [0]
        self.text, self.link, self.tags = [0], [0], [0]
        self.blocks: list[tuple[int, str]] = []


def parse(source: str) -> Page:
    page = Page()
    stack: list[tuple[str, int]] = [("#root", 0)]
    #: How often each name is open, and the places of blocks in the stack: no test walks the whole stack.
    open_: dict[str, int] = {}
    blocks: list[int] = []
    held: list[str] = []
    skip = links = 0
    node = at = 0

    def text(raw: str) -> None:
        if stack[-1][0] == "head" and raw.strip():
            pop()
        if skip or not raw:
            return
        if "&" in raw:
            raw = entities.unescape(raw)
        held.append(raw)
        n = len(raw) - raw.count(" ")
        page.text[node] += n
        if links:
            page.link[node] += n

    def flush() -> None:
        if held:
            joined = " ".join("".join(held).split())
            if joined:
                page.blocks.append((node, joined))
            held.clear()

    def pop() -> None:
        nonlocal skip, links, node
        name, where = stack.pop()
        open_[name] -= 1
        if where >= 0 and name != "#root":
            flush()
            blocks.pop()
            node = page.parent[where]
        if name in SKIPPED:
            skip -= 1
        if name == "a":
            links -= 1

    while True:
        m = TOKEN.search(source, at)
        if m is None:
            text(source[at:])
            break
        if m.start() > at:
            text(source[at : m.start()])
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            continue
        name = name.lower()
        if stack[-1][0] == "head" and not (m[1] or m[4]):
            if name == "head":
                continue
            if name not in METADATA:
                pop()
        if m[1] or m[4]:
            if open_.get(name):
                while stack[-1][0] != name:
                    pop()
                pop()
            elif name == "p":
                flush()
            continue
        page.tags[node] += 1
        own = m[3] or m[6] or ""
        if own.endswith("/") and (name in FOREIGN or any(open_.get(x) for x in FOREIGN)) and not UNQUOTED.search(own):
            continue
        if name in VOID:
            if name == "br":
                text(" ")
            elif name == "hr":
                flush()
            continue
        rule = CLOSES.get(name)
        if rule:
            if any(open_.get(x) for x in rule[0]):
                for k in reversed(blocks):
                    if stack[k][0] in rule[1]:
                        break
                    if stack[k][0] in rule[0]:
                        while len(stack) > k:
                            pop()
                        break
        elif name in NO_PARAGRAPH and blocks and stack[blocks[-1]][0] == "p":
            k = blocks[-1]
            while len(stack) > k:
                pop()
        if name in BLOCK:
            flush()
            words = tuple(w.lower() for a in ATTRS.findall(own) for w in PIECES.findall(a[0] or a[1] or a[2])) if "=" in own else ()
            page.tag.append(name)
            page.attrs.append(words)
            page.parent.append(node)
            page.depth.append(page.depth[node] + 1)
            page.text.append(0)
            page.link.append(0)
            page.tags.append(0)
            node = len(page.tag) - 1
            blocks.append(len(stack))
            stack.append((name, node))
        else:
            stack.append((name, -1))
        open_[name] = open_.get(name, 0) + 1
        if name in SKIPPED:
            skip += 1
        if name == "a":
            links += 1
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(source, at)
            at = end.start() if end else len(source)
    flush()
    return page


def rooted(page: Page) -> Page:
    """The page with the root's own blocks in its body, so that they are scored."""
    if all(v for v, _ in page.blocks):
        return page
    to = next((page.tag.index(x) for x in ("body", "html") if x in page.tag), 0)
    if not to:
        to = 2
        page.tag[1:1], page.attrs[1:1], page.depth[1:] = ["html", "body"], [(), ()], [1, 2, *(d + 2 for d in page.depth[1:])]
        page.parent[1:] = [0, 1, *(u + 2 for u in page.parent[1:])]
        for own in (page.text, page.link, page.tags):
            own[1:1] = [0, 0]
        page.blocks = [(v + 2 if v else 0, block) for v, block in page.blocks]
    for own in (page.text, page.link, page.tags):
        own[to] += own[0]
        own[0] = 0
    page.blocks = [(v or to, block) for v, block in page.blocks]
    return page


FEATURES = 22


def features(page: Page, odds: dict[str, float]) -> np.ndarray:
    """One row for each node."""
    n = len(page.tag)
    parent = page.parent
    text, link, tags = page.text[:], page.link[:], page.tags[:]
    stops, blocks, words, paragraphs = [0] * n, [0] * n, [0] * n, [0] * n
    for v, block in page.blocks:
        stops[v] += len(STOPS.findall(block))
        blocks[v] += 1
        words[v] += block.count(" ") + 1
    kids: list[list[int]] = [[] for _ in range(n)]
    for v in range(n - 1, 0, -1):
        u = parent[v]
        paragraphs[v] += page.tag[v] == "p"
        text[u] += text[v]
        link[u] += link[v]
        tags[u] += tags[v]
        stops[u] += stops[v]
        blocks[u] += blocks[v]
        words[u] += words[v]
        paragraphs[u] += paragraphs[v]
        kids[u].append(v)
    whole = max(1, text[0])
    out = np.zeros((n, FEATURES), np.float32)
    low, high = [0.0] * n, [0.0] * n
    log = math.log1p
    for u in range(n):
        mine = kids[u]
        mine.reverse()
        names: dict[str, int] = {}
        for v in mine:
            names[page.tag[v]] = names.get(page.tag[v], 0) + 1
        for i, v in enumerate(mine):
            tag = odds.get(page.tag[v], 0.0)
            own = [odds.get("." + w, 0.0) for w in page.attrs[v]]
            worst, best = (min(own), max(own)) if own else (0.0, 0.0)
            t = text[v]
            low[v] = min(low[u], tag, worst)
            high[v] = max(high[u], tag, best)
            out[v] = (
                page.depth[v],
                log(t),
                link[v] / t if t else 0.0,
                log(t / (tags[v] + 1)),
                t / whole,
                log(len(mine)),
                i / len(mine),
                names[page.tag[v]] / len(mine),
                stops[v] / t if t else 0.0,
                log(words[v] / blocks[v]) if blocks[v] else 0.0,
                page.text[v] / t if t else 0.0,
                tag,
                worst,
                best,
                low[u],
                high[u],
                log(text[mine[i - 1]]) if i else -1.0,
                log(text[mine[i + 1]]) if i + 1 < len(mine) else -1.0,
                link[u] / text[u] if text[u] else 0.0,
                paragraphs[v] / blocks[v] if blocks[v] else 0.0,
                min((odds.get(page.tag[c], 0.0) for c in kids[v]), default=0.0),
                max((odds.get(page.tag[c], 0.0) for c in kids[v]), default=0.0),
            )
    return out


@dataclass
class Boosted:
    """Trees of equal depth as arrays: at each inner node a feature and a cut, at each leaf a value."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    start: float
    odds: dict[str, float]

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            while at.size and at[0] < inner:
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            out += leaf[at - inner]
        return out


def boost(x: np.ndarray, y: np.ndarray, odds: dict[str, float], trees: int = 40, depth: int = 4, rate: float = 0.25, bins: int = 32) -> Boosted:
    """Logistic loss, second-order leaf values, cuts from quantile histograms."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)
    start = math.log(y.mean() / (1 - y.mean()))
    z = np.full(len(x), start)
    inner = 2**depth - 1
    feature, cut, leaf = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1))
    for t in range(trees):
        p = 1 / (1 + np.exp(-z))
        g, h = p - y, p * (1 - p)
        at = np.zeros(len(x), np.int64)
        for level in range(depth):
            base, count = 2**level - 1, 2**level
            slot = at - base
            best = np.zeros(count)
            for f in range(x.shape[1]):
                key = slot * bins + binned[:, f]
                sg = np.bincount(key, g, count * bins).reshape(count, bins)
                sh = np.bincount(key, h, count * bins).reshape(count, bins)
                lg, lh = np.cumsum(sg, 1), np.cumsum(sh, 1)
                tg, th = lg[:, -1:], lh[:, -1:]
                gain = lg**2 / (lh + 1) + (tg - lg) ** 2 / (th - lh + 1) - tg**2 / (th + 1)
                gain = gain[:, : len(cuts[f])]
                if gain.shape[1]:
                    k = gain.argmax(1)
                    top = gain[np.arange(count), k]
                    better = top > best + 1e-9
                    best = np.where(better, top, best)
                    feature[t, base : base + count][better] = f
                    cut[t, base : base + count][better] = cuts[f][k[better]]
            at = 2 * at + 1 + (x[np.arange(len(x)), feature[t][at]] > cut[t][at])
        slot = at - inner
        leaf[t] = -rate * np.bincount(slot, g, inner + 1) / (np.bincount(slot, h, inner + 1) + 1)
        z += leaf[t][slot]
    return Boosted(feature, cut, leaf, start, odds)


def decode(page: Page, logit: list[float]) -> list[bool]:
    """The most likely choice of nodes in which every kept node has a kept parent."""
    n = len(page.tag)
    gain = [0.0] * n
    for v in range(n - 1, 0, -1):
        gain[v] += logit[v]
        if gain[v] > 0:
            gain[page.parent[v]] += gain[v]
    keep = [False] * n
    keep[0] = True
    for v in range(1, n):
        keep[v] = keep[page.parent[v]] and gain[v] > 0
    return keep


#: Main text of sample pages starts with this private-use character.
MARK = ""
# Names in use for parts of pages, by what they hold.
MAIN_NAMES = "article content main post entry story body text".split()
WRAP_NAMES = "container wrapper page layout row grid site inner".split()
PARTS = {
    "nav": (("nav", "ul", "menu"), "nav menu navigation navbar breadcrumb breadcrumbs toc".split()),
    "header": (("header",), "header masthead topbar branding banner".split()),
    "footer": (("footer",), "footer copyright legal colophon bottom".split()),
    "aside": (("aside",), "sidebar aside widget related recommended trending popular".split()),
    "ad": (("aside",), "ad ads advert advertisement sponsor sponsored promo promotion".split()),
    "notice": (("dialog",), "notice cookie consent alert gdpr popup modal banner disclaimer".split()),
    "form": (("form",), "form newsletter subscribe signup search login contact".split()),
    "comments": (("section",), "comments comment replies responses discussion disqus reply".split()),
    "social": (("ul",), "share social sharing tags meta byline".split()),
}


class _Maker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def prose(self, low: int, high: int) -> str:
        r = self.r
        words = ["".join(r.choice("aeioulnrstmdpkh") for _ in range(r.randint(2, 9))) for _ in range(int(math.exp(r.uniform(math.log(low), math.log(high)))))]
        for k in range(r.randint(4, 15), len(words), r.randint(6, 18)):
            words[k] += r.choice(".,.;")
        return " ".join(words).capitalize() + r.choice([".", ".", "", "!"])

    def open(self, tag: str, names: list[str], named: float) -> str:
        r = self.r
        if r.random() < named and names:
            value = r.choice(names)
            if r.random() < 0.3:
                value += r.choice("-_ ") + r.choice(["box", "area", "list", "inner", "block", "wrap", "section", *names])
            return f'<{tag} {r.choice(["class", "class", "id"])}="{value}">'
        return f"<{tag}>"

    def items(self, count: int, long: bool = False) -> str:
        return "<ul>" + "".join(f'<li><a href="/{k}">{self.prose(1, 12 if long else 4)}</a></li>' for k in range(count)) + "</ul>"

    def part(self, kind: str) -> str:
        r = self.r
        tags, names = PARTS[kind]
        semantic = r.random() < 0.55
        tag = r.choice(tags) if semantic else r.choice(["div", "div", "section"])
        head = self.open(tag, names, 0.25 if semantic and kind not in ("ad", "comments", "social") else 1.0)
        if kind == "nav":
            inner = self.items(r.randint(2, 12)) if tag not in ("ul", "menu") else "".join(f'<li><a href="#">{self.prose(1, 4)}</a></li>' for _ in range(r.randint(2, 12)))
        elif kind == "header":
            inner = r.choice(["", f"<h1>{self.prose(1, 6)}</h1>", f'<div class="logo"><a href="/">{self.prose(1, 3)}</a></div>']) + r.choice(["", self.items(r.randint(2, 8)), f"<p>{self.prose(2, 14)}</p>"])
            inner = inner or self.prose(1, 12)
        elif kind == "footer":
            inner = r.choice([f"&copy; {self.prose(2, 30)}", f"<p>&copy; {self.prose(2, 30)}</p>", self.items(r.randint(2, 8)) + f"<p>{self.prose(2, 20)}</p>"])
        elif kind == "comments":
            inner = f"<h3>{self.prose(1, 4)}</h3>" * r.randint(0, 1) + "".join(self.open(r.choice(["div", "li", "article", "div"]), ["comment", "reply"], 0.7).replace("<", "<", 1) + f"<p>{self.prose(3, 90)}</p>" for _ in range(r.randint(1, 6)))
            inner = re.sub(r"<(div|li|article)( [^>]*)?>(<p>.*?</p>)", r"<\1\2>\3</\1>", inner)
        elif kind == "form":
            inner = f"<label>{self.prose(1, 8)}</label><input>" + r.choice(["", f"<p>{self.prose(3, 30)}</p>", "<button>Go</button>"])
        elif kind == "aside":
            inner = r.choice([self.items(r.randint(2, 8), True), f"<h3>{self.prose(1, 5)}</h3>" + self.items(r.randint(2, 8), True), f"<h3>{self.prose(1, 5)}</h3><p>{self.prose(4, 60)}</p>"])
        elif kind == "social":
            inner = "".join(r.choice([f'<li><a href="#">{self.prose(1, 2)}</a></li>', f"<span>{self.prose(1, 3)}</span>"]) for _ in range(r.randint(1, 5)))
        else:
            inner = r.choice([self.prose(2, 40), f"<p>{self.prose(2, 50)}</p>", f'<a href="#">{self.prose(2, 15)}</a>', f"<h4>{self.prose(1, 6)}</h4><p>{self.prose(3, 40)}</p>"])
        return f"{head}{inner}</{tag}>"

    def article(self) -> str:
        r = self.r
        if r.random() < 0.1:  # next to nothing
            return f"<h1>{MARK}{self.prose(1, 3)}</h1>" * (r.random() < 0.7) + f"<p>{MARK}{self.prose(1, 4)}</p>" * r.randint(1, 2)
        out = [f"<{r.choice(['h1', 'h1', 'h2'])}>{MARK}{self.prose(1, 14)}</h1>"] if r.random() < 0.85 else []
        if out and r.random() < 0.15:
            out = [f"<header>{out[0]}</header>"]
        for _ in range(r.choice([1, 1, 2, 3, 5, 8, 12, 20])):
            kind = r.random()
            if kind < 0.72:
                body = self.prose(1, 260)
                if r.random() < 0.25:
                    body += r.choice(["<br>", f" <a href='#'>{self.prose(1, 4)}</a> {self.prose(1, 20)}", f"<b>{self.prose(1, 6)}</b>"])
                out.append(f"<p>{'<b>' * (r.random() < 0.15)}{MARK}{body}" + ("</p>" if r.random() < 0.8 else ""))
            elif kind < 0.80:
                out.append(f"<h{r.randint(2, 4)}>{MARK}{self.prose(1, 8)}</h2>")
            elif kind < 0.87:
                out.append("<ul>" + "".join(f"<li>{MARK}{self.prose(1, 30)}</li>" for _ in range(r.randint(1, 6))) + "</ul>")
            elif kind < 0.91:
                out.append(f"<blockquote>{MARK}{self.prose(4, 60)}</blockquote>")
            elif kind < 0.94:
                out.append("<table>" + "".join(f"<tr><td>{MARK}{self.prose(1, 5)}</td><td>{MARK}{self.prose(1, 5)}</td></tr>" for _ in range(r.randint(1, 4))) + "</table>")
            else:
                out.append(self.part(r.choice(["ad", "form", "social", "aside", "notice", "nav"])))
        return "".join(out)

    def page(self) -> str:
        r = self.r
        main = self.article()
        if r.random() < 0.92:
            semantic = r.random() < 0.6
            tag = r.choice(["article", "article", "main", "section"]) if semantic else "div"
            main = self.open(tag, MAIN_NAMES, 0.2 if semantic and tag != "section" else 0.9) + main + r.choice(["", "", self.part("comments")]) + f"</{tag}>"
        parts = [main]
        for kind, before, after in (("ad", 0.3, 0.2), ("notice", 0.2, 0.1), ("nav", 0.7, 0.1), ("aside", 0.1, 0.3), ("form", 0.1, 0.15), ("social", 0.1, 0.15), ("comments", 0.0, 0.35)):
            if r.random() < before:
                parts.insert(r.randint(0, parts.index(main)), self.part(kind))
            if r.random() < after:
                parts.insert(r.randint(parts.index(main) + 1, len(parts)), self.part(kind))
        if r.random() < 0.35:
            at = r.randint(0, parts.index(main))
            upto = r.randint(parts.index(main) + 1, len(parts))
            tag = r.choice(["div", "div", "main", "section"])
            parts[at:upto] = [self.open(tag, WRAP_NAMES, 0.7) + "".join(parts[at:upto]) + f"</{tag}>"]
        if r.random() < 0.5:
            parts.insert(0, self.part("header"))
        if r.random() < 0.85:
            parts.append(self.part("footer"))
        return f"<!DOCTYPE html><html><head><title>{self.prose(1, 9)}</title></head><body>{''.join(parts)}</body></html>"


TRAINING_PAGES, SEED = 900, 11


def sample_pages(count: int = TRAINING_PAGES, seed: int = SEED) -> list[str]:
    maker = _Maker(seed)
    return [maker.page() for _ in range(count)]


def node_labels(page: Page) -> np.ndarray:
    """1 for nodes whose subtree holds marked text."""
    y = np.zeros(len(page.tag))
    for v, text in page.blocks:
        y[v] = max(y[v], float(MARK in text))
    for v in range(len(page.tag) - 1, 0, -1):
        y[page.parent[v]] = max(y[page.parent[v]], y[v])
    return y


def train(sources: list[str]) -> Boosted:
    pages = [parse(s) for s in sources]
    labels = [node_labels(p) for p in pages]
    kept: dict[str, float] = {}
    all_: dict[str, float] = {}
    for page, y in zip(pages, labels, strict=True):
        for v in range(1, len(y)):
            for token in {page.tag[v], *("." + w for w in page.attrs[v])}:
                kept[token] = kept.get(token, 0) + y[v]
                all_[token] = all_.get(token, 0) + 1
    odds = {t: math.log((kept[t] + 1) / (all_[t] - kept[t] + 1)) for t in sorted(all_) if all_[t] >= 5}
    x = np.concatenate([features(p, odds)[1:] for p in pages])
    return boost(x, np.concatenate([y[1:] for y in labels]), odds)


def main_texts(sources: list[str | None], model: Boosted) -> list[str]:
    pages = [rooted(parse(s or "")) for s in sources]
    rows = [features(p, model.odds) for p in pages]
    logits = model.logits(np.concatenate(rows)) if rows else np.zeros(0)
    out, at = [], 0
    for page, own in zip(pages, rows, strict=True):
        keep = decode(page, logits[at : at + len(own)].tolist())
        at += len(own)
        out.append("\n\n".join(text for v, text in page.blocks if keep[v]))
    return out


#: Pages whose nodes are scored at once, and characters of html in them at most (one page may exceed it).
PAGES_AT_ONCE, CHARS_AT_ONCE = 256, 4 << 20


def _extract(shared, at: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Boosted = shared.value
        for batch in batches:
            texts: list[str] = []
            waiting: list[str | None] = []
            chars = 0
            for source in batch.column(at):
                waiting.append(source.as_py())
                chars += len(waiting[-1] or "")
                if len(waiting) >= PAGES_AT_ONCE or chars >= CHARS_AT_ONCE:
                    texts += main_texts(waiting, model)
                    waiting, chars = [], 0
            texts += main_texts(waiting, model) if waiting else []
            cols = [batch.column(i) for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(texts, pa.string())], names=names)

    return run


def extract_text(pages: DataFrame, *, html_col: str = "html", output: str = "main_text", model: Boosted | None = None) -> DataFrame:
    """``pages`` with the html column replaced by the extracted text, named ``output``."""
    spark = pages.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model or train(sample_pages()))
    others = [f for f in pages.schema.fields if f.name != html_col]
    renamed = pages.select(*[F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(others)], F.col(f"`{html_col}`").alias("html"))
    schema = ", ".join([*(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(others)), "main string"])
    out = renamed.mapInArrow(_extract(shared, len(others), [*(f"c{i}" for i in range(len(others))), "main"]), schema)
    return out.select(*[F.col(f"c{i}").alias(f.name) for i, f in enumerate(others)], F.col("main").alias(output))
