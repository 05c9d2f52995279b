"""Main text of web pages: boosted trees over DOM nodes, decoded without contradictions in the tree.

Every element gets features of its subtree (text, link and tag density, sentence marks), of its place (depth,
siblings, share of and position in the page) and of the name tokens in tag, class, id and role of itself and
of its ancestors. Gradient-boosted trees give the probability that it belongs to the article. Decoding
chooses for the whole tree at once: either a node goes with all below it, or it stays and its children choose;
the cheapest choice by weighted log loss is found from the leaves up, so no kept node has a dropped ancestor.

Training. There are no labels, so a bounded sample of pages is labelled by its semantic names (an article
without the navigation, notices and so on inside it). Each is also rebuilt with other usual page
furniture around and inside its own paragraphs, and a part is learnt with all names hidden, so the densities
count where names say nothing. The trees are trained here, on at most ``SAMPLE`` pages.
"""

from __future__ import annotations

import html as entities
import random
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobmart.llm.common import add_columns

#: Pages in the fit, nodes of a page in it, name tokens, trees and their depth.
SAMPLE, NODES, TOKENS, TREES, DEPTH = 240, 400, 160, 56, 4

# Element names of HTML.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = set("script style template iframe".split())
MATH = set("""math mi mo mn ms mtext mspace mrow msup msub msubsup mfrac msqrt mroot mover munder munderover mfenced mstyle mpadded mphantom
menclose semantics annotation""".split())
PLAIN = set("""p ul ol li table thead tbody tr td th caption pre figure figcaption dl dt dd blockquote h1 h2 h3 h4 h5 h6 a b i code img div span form
input button label select option textarea noscript svg math""".split())
INLINE = MATH | set("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
CLOSES = {"li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
#: Names that label the sample: what is an article, and what is not part of it.
ARTICLE = set("article main content post entry story body-text articlebody maincontent".split())
FURNITURE = set("""nav menu navigation navbar header masthead topbar breadcrumb breadcrumbs footer foot copyright aside sidebar side
widget notice cookie cookies consent banner alert popup modal newsletter subscribe ad ads advert adverts advertisement sponsor sponsored promo
promotion form login search comment comments commentlist reply respond disqus related recommended share social tags pagination pager head title
script style button select""".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*+)((?:"[^"]*"|'[^']*'|[^"'>])*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_NAME = re.compile(r"[a-z]+")


class Page:
    """Elements in page order: parent, depth, names; text pieces with their element and block breaks."""

    def __init__(self, source: str):
        self.tags, self.parents, self.depths, self.names = ["#"], [-1], [0], [()]
        self.pieces: list[tuple[int, str] | None] = []  # None: a block begins or ends
        stack, at = [0], 0
        n = len(source)
        while at < n:
            found = _TAG.search(source, at)
            if found is None:
                self.text(stack[-1], source[at:])
                break
            if found.start() > at:
                self.text(stack[-1], source[at:found.start()])
            at = found.end()
            name = found[2]
            if name is None:
                continue
            name = name.lower()
            if found[1]:
                self.close(stack, name)
                continue
            self.imply(stack, name)
            if name not in INLINE and name != "br":
                self.pieces.append(None)
            elif name == "br":
                self.pieces.append((stack[-1], " "))
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
                at = end.end() if end else n
                continue
            if name in VOID or found[3].endswith("/") and name not in (INLINE - MATH) | {"p", "div"}:
                continue
            self.open(stack, name, found[3])
        self.pieces.append(None)

    def text(self, node: int, raw: str):
        if raw:
            self.pieces.append((node, entities.unescape(raw) if "&" in raw else raw))

    def open(self, stack: list[int], name: str, attributes: str):
        names = [name]
        if "=" in attributes:
            for a, b, c in _ATTRIBUTE.findall(attributes):
                value = (a or b or c).lower()
                names += _NAME.findall(value)
                names += [x for x in value.split() if "-" in x]
        self.tags.append(name)
        self.parents.append(stack[-1])
        self.depths.append(len(stack))
        self.names.append(tuple(names))
        stack.append(len(self.tags) - 1)

    def close(self, stack: list[int], name: str):
        if name not in INLINE:
            self.pieces.append(None)
        for i in range(len(stack) - 1, 0, -1):
            if self.tags[stack[i]] == name:
                del stack[i:]
                return
            if name in INLINE and self.tags[stack[i]] not in INLINE:
                return

    def imply(self, stack: list[int], name: str):
        """End tags that the new element implies."""
        if name not in INLINE and name not in VOID or name == "hr":
            for i in range(len(stack) - 1, 0, -1):
                tag = self.tags[stack[i]]
                if tag == "p":
                    del stack[i:]
                    break
                if tag not in INLINE:
                    break
        if closes := CLOSES.get(name):
            for i in range(len(stack) - 1, 0, -1):
                tag = self.tags[stack[i]]
                if tag in closes:
                    del stack[i:]
                    break
                if tag in ("ul", "ol", "table", "dl", "select"):
                    break

    def main_text(self, kept: np.ndarray) -> str:
        blocks, now = [], []
        for piece in self.pieces:
            if piece is not None:
                if kept[piece[0]]:
                    now.append(piece[1])
            elif now:
                if words := "".join(now).split():
                    blocks.append(" ".join(words))
                now = []
        return "\n".join(blocks)


def features(page: Page, vocabulary: dict[str, int]) -> np.ndarray:
    """One row for each element."""
    n = len(page.tags)
    parent = np.array(page.parents)
    own, words, marks, link, blocks = (np.zeros(n) for _ in range(5))
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = page.tags[i] == "a" or in_link[page.parents[i]]
    first = np.full(n, -1.0)
    seen = 0
    for piece in page.pieces:
        if piece is not None and (size := len(text := piece[1].strip())):
            k = piece[0]
            own[k] += size
            words[k] += text.count(" ") + 1
            marks[k] += text.count(".") + text.count(",")
            blocks[k] += 1
            link[k] += size * in_link[k]
            if first[k] < 0:
                first[k] = seen
            seen += size
    below = np.ones(n)
    total = np.stack([own, words, marks, link, blocks, below], 1)
    begin = np.where(first < 0, 1e18, first)
    children = np.zeros(n)
    for i in range(n - 1, 0, -1):
        p = page.parents[i]
        total[p] += total[i]
        children[p] += 1
        if begin[i] < begin[p]:
            begin[p] = begin[i]
    index, twins = np.zeros(n), np.zeros(n)
    next_child: dict[int, int] = {}
    same: dict[tuple[int, str], int] = {}
    for i in range(1, n):
        p = page.parents[i]
        index[i] = next_child[p] = next_child.get(p, -1) + 1
        same[p, page.tags[i]] = same.get((p, page.tags[i]), 0) + 1
    for i in range(1, n):
        twins[i] = same[page.parents[i], page.tags[i]]
    names, above = [0] * n, [0] * n
    for i in range(1, n):
        mask = 0
        for x in page.names[i]:
            k = vocabulary.get(x)
            if k is not None:
                mask |= 1 << k
        names[i] = mask
        above[i] = above[page.parents[i]] | names[page.parents[i]]
    size = -(-TOKENS // 8)
    bits = [np.unpackbits(np.frombuffer(b"".join(m.to_bytes(size, "little") for m in x), np.uint8).reshape(n, size), axis=1, bitorder="little") for x in (names, above)]
    text = total[:, 0]
    up = np.maximum(parent, 0)
    density = total[:, 3] / np.maximum(1, text)
    plain = np.stack([page.depths, np.log1p(text), np.log1p(own), density, total[:, 5] / (1 + text / 100), children, index, children[up], twins,
                      np.minimum(begin, seen) / max(1, seen), text / max(1, seen), total[:, 2] / np.maximum(1, total[:, 1]),
                      total[:, 1] / np.maximum(1, total[:, 4]), density[up], text[up] / max(1, seen), own / np.maximum(1, text)], 1)
    return np.concatenate([plain.astype(np.float32), bits[0].astype(np.float32), bits[1].astype(np.float32)], axis=1)


@dataclass
class Trees:
    """Boosted trees of one depth: feature and threshold for each inner node, value for each leaf."""

    start: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += v[at - len(f)]
        return out


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray, bins: int = 32, rate: float = 0.3) -> Trees:
    """Second-order boosting of the log loss on binned features."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    used = np.flatnonzero(binned.max(axis=0) > 0)
    mean = np.average(y, weights=weight)
    start = float(np.log(np.clip(mean, 1e-3, 1 - 1e-3) / (1 - np.clip(mean, 1e-3, 1 - 1e-3))))
    z = np.full(len(y), start)
    inner, leaves = 2 ** DEPTH - 1, 2 ** DEPTH
    features_, thresholds, values = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-z))
        g, h = weight * (p - y), weight * np.maximum(p * (1 - p), 1e-6)
        f, t = np.zeros(inner, np.int64), np.full(inner, np.inf, np.float32)
        at = np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            first, nodes = 2 ** level - 1, 2 ** level
            local = at - first
            best, where = np.full(nodes, 1e-3), np.full((nodes, 2), -1)
            for j in used:
                key = local * (bins + 1) + binned[:, j]
                gs = np.cumsum(np.bincount(key, g, nodes * (bins + 1)).reshape(nodes, -1), axis=1)
                hs = np.cumsum(np.bincount(key, h, nodes * (bins + 1)).reshape(nodes, -1), axis=1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs ** 2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt ** 2 / (ht + 1)
                k = gain.argmax(axis=1)
                better = gain[np.arange(nodes), k] > best
                best[better] = gain[np.arange(nodes), k][better]
                where[better, 0], where[better, 1] = j, k[better]
            for node in range(nodes):
                j, k = where[node]
                if j >= 0 and k < len(edges[j]):
                    f[first + node], t[first + node] = j, edges[j][k]
            at = 2 * at + 1 + (x[np.arange(len(y)), f[at]] > t[at])
        leaf = at - inner
        v = -rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + 1)
        z += v[leaf]
        features_.append(f)
        thresholds.append(t)
        values.append(v)
    return Trees(start, np.array(features_), np.array(thresholds), np.array(values))


def decode(page: Page, odds: np.ndarray) -> np.ndarray:
    """Which elements stay: the cheapest choice in which nothing below a dropped element stays."""
    n = len(page.tags)
    own = np.zeros(n)
    for piece in page.pieces:
        if piece is not None:
            own[piece[0]] += len(piece[1])
    weight = 1 + np.minimum(own, 400) / 40
    stay = (weight * np.logaddexp(0, -odds)).tolist()
    drop = (weight * np.logaddexp(0, odds)).tolist()
    for i in range(n - 1, 0, -1):
        p = page.parents[i]
        stay[p] += min(stay[i], drop[i])
        drop[p] += drop[i]
    kept = np.zeros(n, bool)
    kept[0] = True
    for i in range(1, n):
        kept[i] = kept[page.parents[i]] and stay[i] < drop[i]
    return kept


def labels(page: Page) -> np.ndarray:
    """1 for elements with article text below or in them, by their names."""
    n = len(page.tags)
    inside, out = [False] * n, [False] * n
    for i in range(1, n):
        p, names = page.parents[i], page.names[i]
        out[i] = out[p] or any(x in FURNITURE for x in names)
        inside[i] = inside[p] or any(x in ARTICLE for x in names)
    y = np.array([a and not b for a, b in zip(inside, out, strict=True)])
    for i in range(n - 1, 0, -1):
        if y[i]:
            y[page.parents[i]] = True
    return y.astype(float)


def rebuilt(source: str, rng: random.Random) -> str:
    """A page of other furniture around and inside the paragraphs of a given one."""
    page = Page(source)
    y = labels(page) > 0
    text = [x for x in page.main_text(y).split("\n") if x] or ["Text."]
    short = [x for x in page.main_text(~y).split("\n") if x] or ["Menu"]
    pick = lambda *x: rng.choice(x)

    def name(words: str) -> str:
        word = rng.choice(words.split())
        return pick(f' class="{word}"', f' id="{word}"', f' class="{word} box"', f' class="site-{word}"')

    def furniture() -> str:
        links = "".join(f'<li><a href="/x">{entities.escape(rng.choice(short)[:30])}</a></li>' for _ in range(rng.randint(2, 9)))
        some = entities.escape(" ".join(rng.choice(text + short)[:rng.randint(20, 400)] for _ in range(rng.randint(1, 2))))
        return pick(
            f"<{(t := pick('nav', 'header', 'aside', 'footer'))}><ul>{links}</ul></{t}>",
            f'<div{name("menu navbar sidebar breadcrumbs footer related share social tags")}><ul>{links}</ul></div>',
            f'<aside{name("sidebar widget related promo")}><h3>{some[:40]}</h3><p>{some}</p></aside>',
            f'<div{name("cookie notice consent banner alert popup newsletter")}><p>{some}</p><button>OK</button></div>',
            f'<div{name("ad ads advert advertisement sponsored promo")}>{some}</div>',
            f'<div class="{pick("ad", "ads", "advert", "sponsored", "promo")}">{entities.escape(rng.choice(text)[:rng.randint(40, 200)])}</div>',
            f'<form{name("search login subscribe newsletter")}><label>{some[:60]}</label><input name="q"><button>Go</button></form>',
            f"<header><h2>{some[:50]}</h2></header>", f"<footer><p>{some}</p></footer>",
            f'<div{name("widget related sidebar share footer")}><table><tr>' + "".join(f'<td><a href="/x">{entities.escape(rng.choice(short)[:20])}</a></td>' for _ in range(rng.randint(2, 6))) + "</tr></table></div>",
            f'<div{name("related recommended promo")}><figure><a href="/x"><img src="x"></a><figcaption><a href="/x">{some[:40]}</a></figcaption></figure></div>',
            f'<{(s := pick("section", "div"))}{name("comments comment commentlist respond")}>' + "".join(
                f'<div class="comment"><b>{entities.escape(rng.choice(short)[:12])}</b><p>{entities.escape(rng.choice(text)[:300])}</p></div>'
                for _ in range(rng.randint(1, 4))) + f"</{s}>")

    def cut(longest: int) -> str:
        """Some words of the article."""
        words = rng.choice(text).split()
        start = rng.randrange(len(words))
        return entities.escape(" ".join(words[start:start + rng.randint(1, longest)]))

    def many(form: str, longest: int) -> str:
        return "".join(form.format(cut(longest)) for _ in range(rng.randint(2, 7)))

    def structure() -> str:
        """A block of several items, as articles have them."""
        wide = rng.randint(2, 4)
        return pick(
            f"<{(u := pick('ul', 'ol'))}>{many('<li>{}</li>', 14)}</{u}>", "<dl>" + "".join(f"<dt>{cut(2)}</dt><dd>{cut(12)}</dd>" for _ in range(rng.randint(1, 4))) + "</dl>",
            "<table>" + pick("", f"<caption>{cut(6)}</caption>") + "".join(
                "<tr>" + "".join(f"<{pick('td', 'td', 'th')}>{cut(4)}</td>" for _ in range(wide)) + "</tr>" for _ in range(rng.randint(2, 6))) + "</table>",
            f'<figure><img src="x"><figcaption>{cut(10)}</figcaption></figure>', f"<pre>{cut(5)}\n{cut(5)}\n{cut(5)}</pre>",
            f"<p>{cut(12)} <math><mi>{cut(1)}</mi><mo>=</mo><mn>{cut(1)}</mn></math> {cut(8)}</p>",
            f"<{(q := pick('noscript', 'blockquote', 'svg'))}>{cut(12)}</{q}>", f"<div><p>{cut(20)}</p></div>")

    body = [f"<{pick('h1', 'h2')}>{entities.escape(text[0])}</h1>"]
    for x in text[1:]:
        x = entities.escape(x)
        body.append(pick(f"<p>{x}</p>", f"<p>{x}", f"<p><b>{x[:20]}</b>{x[20:]}</p>", f"<blockquote>{x}</blockquote>", f"<h3>{x[:60]}</h3><p>{x}</p>", f"<ul><li>{x}</li></ul>"))
        if rng.random() < 0.35:
            body.append(structure())
        if rng.random() < 0.08:
            body.append(furniture())
    if rng.random() < 0.3:
        body.append(furniture())
    t = pick("article", "main", "div", "section")
    content = f'<{t}{name("content post entry article story") if t in ("div", "section") or rng.random() < 0.5 else ""}>{"".join(body)}</{t}>'
    parts = [furniture() for _ in range(rng.randint(1, 4))] + [content] + [furniture() for _ in range(rng.randint(1, 4))]
    inner = "".join(parts)
    return "<html><head><title>" + entities.escape(text[0]) + "</title></head><body>" + (f'<div id="wrap">{inner}</div>' if rng.random() < 0.4 else inner) + "</body></html>"


@dataclass
class Model:
    vocabulary: dict[str, int]
    trees: Trees

    def texts(self, sources: list[str]) -> list[str]:
        pages = [Page(x) for x in sources]
        rows = [features(p, self.vocabulary) for p in pages]
        odds = self.trees.odds(np.concatenate(rows)) if rows else np.zeros(0)
        out, at = [], 0
        for p in pages:
            out.append(p.main_text(decode(p, odds[at:at + len(p.tags)])))
            at += len(p.tags)
        return out


def fit(pages: DataFrame, html: str = "html", sample: int = SAMPLE) -> Model:
    """Learn from the ``sample`` pages with the smallest hash of their source, and rebuilt forms of each.

    Sampled pages are read whole; of each, ``NODES`` elements drawn from all of it are learnt from. Without any page
    the model is learnt from a built-in one.
    """
    rows = pages.where(F.col(html).isNotNull()).select(F.col(html).cast("string").alias("html"), F.xxhash64(html).alias("h"))
    hashes = [r.h for r in rows.select("h").distinct().orderBy("h").limit(sample).collect()]  # of a page only its hash is compared
    chosen = rows.where(F.col("h") <= max(hashes)).dropDuplicates(["h"]).collect() if hashes else []
    return train([r.html for r in sorted(chosen, key=lambda r: (r.h, r.html))])


def train(sources: list[str]) -> Model:
    sources = sources or ["<body><nav><a>Menu</a></nav><article><h1>A title.</h1><p>A first sentence, and a second one.</p></article></body>"]
    built = []
    for x in sources:
        rng = random.Random(zlib.crc32(x.encode("utf-8", "surrogatepass")))
        built += [Page(x), Page(rebuilt(x, rng)), Page(rebuilt(x, rng))]
    counts: dict[str, int] = {}
    for p in built:
        for name in {x for names in p.names for x in names}:
            counts[name] = counts.get(name, 0) + 1
    known = sorted((x for x in counts if counts[x] >= min(3, len(built))), key=lambda x: (-counts[x], x))[:TOKENS]
    vocabulary = {x: i for i, x in enumerate(known)}
    x, y, w = [], [], []
    for k, p in enumerate(built):
        hidden = k % 7 == 3 or k % 6 == 5  # names hidden, all or those beyond plain elements: the other features must do
        seen = {} if k % 7 == 3 else {x: i for x, i in vocabulary.items() if x in PLAIN} if hidden else vocabulary
        rows, truth = features(p, seen), labels(p)
        keep = np.sort(np.random.default_rng(k).permutation(len(truth))[:NODES])
        x.append(rows[keep])
        y.append(truth[keep])
        w.append(np.full(len(keep), 0.25 if hidden else 1.0))
    return Model(vocabulary, boost(np.concatenate(x), np.concatenate(y), np.concatenate(w)))


def extract(pages: DataFrame, model: Model, html: str = "html") -> DataFrame:
    """Append text and n_chars (code points) of each whole page; a null or empty page has an empty text.

    Character references are decoded, white space inside a block becomes one blank, blocks are
    joined by one line end in page order. A column of ``pages`` named text or n_chars is replaced.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def make():
        def run(sources: pa.Array) -> list[pa.Array]:
            out: list[str] = []
            for i in range(0, len(sources), 256):
                out += shared.value.texts([x or "" for x in sources[i:i + 256].to_pylist()])
            return [pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())]
        return run

    return add_columns(pages, html, T.StructType().add("text", "string").add("n_chars", "long"), make)
