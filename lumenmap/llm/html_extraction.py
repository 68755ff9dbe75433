"""Main text of web pages by gradient-boosted trees over the nodes of the page.

A page is parsed into a tree of block elements; inline elements belong to the block around them. Each block
has features of its subtree (text length and its density over tags, share of link text, punctuation, form
controls), of its attribute tokens and those of its ancestors, of its depth and of its siblings. Boosted trees
give each block the probability that it holds main text. The blocks are then chosen together: the choice of
highest likelihood in which no block is kept below one that is dropped, found in one pass from the leaves up
and one down. What is kept is joined in page order.

The trees are trained here, on pages that are generated with their answers known: articles in varied markup
among menus, headers, footers, sidebars, notices, adverts, forms and reader comments.
"""

from __future__ import annotations

import html as html_module
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Element names by kind.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe object svg math canvas textarea select option".split())
UNSEEN = RAW | set("head title meta link base".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul figure details".split())
TAGS = "html body main article section div p h1 h2 h3 h4 h5 h6 header footer nav aside form ul ol li dl dt dd table tr td th blockquote pre figure figcaption address details".split()
CONTROLS = set("input button select textarea option".split())
# Words in class, id and role attributes, by what they speak of.
WORDS = {
    "content": "article articlebody post entry content story main maintext text body hentry prose page".split(),
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toc pagination pager tabs".split(),
    "frame": "header masthead footer foot copyright top bottom site logo topbar colophon".split(),
    "side": "sidebar side aside related widget more recommended trending popular links tags rail".split(),
    "advert": "ad ads advert advertisement sponsor sponsored promo banner adsense promoted".split(),
    "notice": "cookie cookies consent notice popup modal overlay alert gdpr newsletter subscribe signup paywall disclaimer".split(),
    "comment": "comment comments reply replies respond discussion disqus reader feedback thread".split(),
    "social": "share sharing social follow like tweet facebook twitter".split(),
    "form": "form login search contact register".split(),
}
KIND_OF = {w: k for k, words in enumerate(WORDS.values()) for w in words}

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*(?:\"|$)|=\s*'[^']*(?:'|$)|[^>])*+)(?:>|$)", re.S)  # a quote inside an unquoted value is part of it
# An option ends at its end tag, or else before the next option or the end of a block around it.
_OPTION_STOP = re.compile(r"(</option\s*>)|<(?:option|optgroup)(?=[\s/>])|</(?!(?:" + "|".join(sorted(INLINE)) + r")[\s>])[a-z]", re.I)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_PUNCTUATION = re.compile(r"[.,;:!?]")


@dataclass
class Block:
    tag: str
    parent: int
    depth: int
    kinds: int  # bits of WORDS
    order: int  # among its siblings
    children: list[int] = field(default_factory=list)
    chars: int = 0
    links: int = 0
    words: int = 0
    marks: int = 0
    tags: int = 1
    controls: int = 0


@lru_cache(maxsize=4096)
def attribute_kinds(raw: str) -> int:
    bits = 0
    for m in _ATTRIBUTE.finditer(raw):
        for part in _PARTS.findall(m[2] or m[3] or m[4] or ""):
            k = KIND_OF.get(part.lower())
            if k is not None:
                bits |= 1 << k
    return bits


def parse(page: str) -> tuple[list[Block], list[tuple[int, str]]]:
    """The blocks in page order, the root first, and the texts with the block that each belongs to."""
    blocks = [Block("#root", -1, 0, 0, 0)]
    texts: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = [("#root", 0)]  # open elements and the block that they are in
    opened: Counter[str] = Counter()  # of names on the stack, so that none is looked for in vain
    run: list[str] = []
    in_link = 0
    hidden = 0  # depth of the stack at which text is not shown

    def flush() -> None:
        if run:
            words = "".join(run).split()
            run.clear()
            if words:
                texts.append((stack[-1][1], " ".join(words)))

    def add_text(t: str) -> None:
        if hidden or not t:
            return
        t = html_module.unescape(t) if "&" in t else t
        run.append(t)
        b = blocks[stack[-1][1]]
        n = len(t.strip())
        if n:
            b.chars += n
            b.words += t.count(" ") + 1
            b.marks += len(_PUNCTUATION.findall(t))
            if in_link:
                b.links += n

    def close_to(depth: int) -> None:
        nonlocal hidden, in_link
        while len(stack) > depth:
            name, at = stack[-1]
            if name not in INLINE:
                flush()
            elif name == "a":
                in_link = max(0, in_link - 1)
            stack.pop()
            opened[name] -= 1
        if hidden and len(stack) < hidden:
            hidden = 0

    at, end = 0, len(page)
    find = _TOKEN.search
    while at < end:
        m = find(page, at)
        if m is None:
            add_text(page[at:])
            break
        add_text(page[at : m.start()])
        at = m.end()
        name = m[2]
        if not name:
            continue
        name = name.lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1) if opened[name] else ():
                if stack[i][0] == name:
                    close_to(i)
                    break
                if name in INLINE and stack[i][0] not in INLINE:
                    break  # an inline end does not close a block
            continue
        if name in CONTROLS:
            blocks[stack[-1][1]].controls += 1
        if name in RAW:
            if not m[3].rstrip().endswith("/"):
                if name == "option":
                    stop = _OPTION_STOP.search(page, at)
                    at = (stop.end() if stop[1] else stop.start()) if stop else end
                    continue
                stop = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = stop.end() if stop else end
            continue
        if name in VOID:
            blocks[stack[-1][1]].tags += 1
            if name == "br":
                run.append(" ")
            elif name == "hr":
                flush()
            continue
        if name in INLINE:
            blocks[stack[-1][1]].tags += 1
            if name == "a":
                in_link += 1
            stack.append((name, stack[-1][1]))
            opened[name] += 1
            continue
        if name in CLOSES_P or name in ("li", "dt", "dd", "tr", "td", "th"):
            bar = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}.get(name, ())
            same = ("p",) if name in CLOSES_P else ("dt", "dd") if name in ("dt", "dd") else ("td", "th") if name in ("td", "th") else (name,)
            for i in range(len(stack) - 1, 0, -1) if any(opened[x] for x in same) else ():
                open_name = stack[i][0]
                if open_name in same:
                    close_to(i)
                    break
                if open_name in bar or (open_name not in INLINE and (name in CLOSES_P or open_name in ("div", "section", "article", "table"))):
                    break
        flush()
        parent = stack[-1][1]
        p = blocks[parent]
        blocks.append(Block(name, parent, p.depth + 1, attribute_kinds(m[3]) if m[3] else 0, len(p.children)))
        p.children.append(len(blocks) - 1)
        stack.append((name, len(blocks) - 1))
        opened[name] += 1
        if name in UNSEEN and not hidden:
            hidden = len(stack)
        elif name == "body":
            hidden = 0
        if m[3].rstrip().endswith("/") and name not in TAGS:
            close_to(len(stack) - 1)
    close_to(1)
    flush()
    return blocks, texts


N_KINDS = len(WORDS)
_TAG_NUMBER = {t: i for i, t in enumerate(TAGS)}


def features(blocks: list[Block]) -> np.ndarray:
    """One row for each block."""
    n = len(blocks)
    chars, links, words, marks, tags, controls = (np.array([getattr(b, k) for b in blocks], dtype=np.float64) for k in ("chars", "links", "words", "marks", "tags", "controls"))
    own = chars.copy()
    parents = [b.parent for b in blocks]
    blocks_below = np.ones(n)
    for i in range(n - 1, 0, -1):  # children come after their parents
        p = parents[i]
        for v in (chars, links, words, marks, tags, controls, blocks_below):
            v[p] += v[i]
    total = max(1.0, chars[0])
    above = np.zeros(n, dtype=np.int64)
    inherited_tag = np.zeros(n, dtype=np.int64)
    frame = {t: 1 << i for i, t in enumerate(("nav", "header", "footer", "aside", "form", "article", "main", "ul"))}
    before = np.zeros(n)
    seen = 0.0
    for i, b in enumerate(blocks):
        if i:
            above[i] = above[b.parent] | blocks[b.parent].kinds
            inherited_tag[i] = inherited_tag[b.parent] | frame.get(blocks[b.parent].tag, 0)
        before[i] = seen / total
        seen += own[i]
    kinds = np.array([b.kinds for b in blocks])
    siblings = np.array([len(blocks[b.parent].children) if b.parent >= 0 else 1 for b in blocks], dtype=np.float64)
    order = np.array([b.order for b in blocks], dtype=np.float64)
    parent_chars = np.array([chars[p] if p >= 0 else total for p in parents])
    same = np.zeros(n)
    for b in blocks:
        counts = Counter(blocks[c].tag for c in b.children)
        for c in b.children:
            same[c] = counts[blocks[c].tag]
    cols = [
        np.array([_TAG_NUMBER.get(b.tag, len(TAGS)) for b in blocks], dtype=np.float64),
        np.array([b.depth for b in blocks], dtype=np.float64),
        np.log1p(chars), np.log1p(own), chars / total, links / np.maximum(chars, 1), chars / tags, own / np.maximum(chars, 1),
        words / np.maximum(blocks_below, 1), marks / np.maximum(words, 1), chars / np.maximum(words, 1), controls / np.maximum(tags, 1), np.log1p(controls), np.log1p(blocks_below),
        siblings, order, order / np.maximum(siblings, 1), same, chars / np.maximum(parent_chars, 1), before,
    ]
    cols += [(kinds >> k & 1).astype(np.float64) for k in range(N_KINDS)]
    cols += [(above >> k & 1).astype(np.float64) for k in range(N_KINDS)]
    cols += [(inherited_tag >> k & 1).astype(np.float64) for k in range(len(frame))]
    cols += [np.array([b.tag == t for b in blocks], dtype=np.float64) for t in ("nav", "header", "footer", "aside", "form", "article", "main", "p")]
    return np.column_stack(cols)


@dataclass(frozen=True)
class Trees:
    """Complete binary trees of one depth: feature and threshold of each inner node, value of each leaf."""

    feature: np.ndarray  # trees x (2 ** depth - 1)
    threshold: np.ndarray
    leaf: np.ndarray  # trees x 2 ** depth
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        depth = self.leaf.shape[1].bit_length() - 1
        for f, t, v in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            out += v[node - (len(v) - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 70, depth: int = 4, rate: float = 0.2, bins: int = 32, least: float = 5.0) -> Trees:
    """Second-order boosting of the logistic loss, with histograms of quantile bins."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)])
    n, m = x.shape
    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    z = np.full(n, start)
    feature = np.zeros((rounds, 2**depth - 1), dtype=np.int64)
    threshold = np.full((rounds, 2**depth - 1), np.inf)
    leaf = np.zeros((rounds, 2**depth))
    flat = binned + np.arange(m) * (bins + 1)
    for r in range(rounds):
        p = 1 / (1 + np.exp(-z))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first = 2**level - 1
            for k in range(first, 2 * first + 1):
                mine = np.flatnonzero(node == k)
                if len(mine) < 2 * least:
                    continue
                cell = flat[mine].ravel()
                gs = np.bincount(cell, weights=np.repeat(g[mine], m), minlength=m * (bins + 1)).reshape(m, -1).cumsum(1)
                hs = np.bincount(cell, weights=np.repeat(h[mine], m), minlength=m * (bins + 1)).reshape(m, -1).cumsum(1)
                cs = np.bincount(cell, minlength=m * (bins + 1)).reshape(m, -1).cumsum(1)
                total_g, total_h = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + 1) + (total_g - gs) ** 2 / (total_h - hs + 1) - total_g**2 / (total_h + 1)
                gain[(cs < least) | (len(mine) - cs < least)] = -1
                best = int(gain.argmax())
                f, b = divmod(best, bins + 1)
                if gain[f, b] > 1e-6 and b < len(edges[f]):
                    feature[r, k], threshold[r, k] = f, edges[f][b]
            at = node
            node = 2 * at + 1 + (x[np.arange(n), feature[r, at]] > threshold[r, at])
        slot = node - (2**depth - 1)
        value = -np.bincount(slot, weights=g, minlength=2**depth) / (np.bincount(slot, weights=h, minlength=2**depth) + 1)
        leaf[r] = rate * value
        z += leaf[r][slot]
    return Trees(feature, threshold, leaf, start)


def _words(r: random.Random, n: int) -> str:
    syllables = "ta re no li ver sa mon del qui est or an the ing sch une os".split()
    out = ["".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(n)]
    for i in range(len(out)):
        if r.random() < 0.12:
            out[i] += r.choice([".", ",", ".", ";", "?"])
    text = " ".join(out)
    return text.upper() if r.random() < 0.03 else text.capitalize()


def example_page(r: random.Random) -> tuple[str, list[bool]]:
    """A page and, for each of its blocks in page order, whether main text is in or below it. Main text is marked by U+E000 for that."""
    M = ""

    def name(kind: str) -> str:
        if r.random() < (0.35 if kind == "content" else 0.08):
            return r.choice(["", ' class="x%d"' % r.randint(1, 99), ' id="b%d"' % r.randint(1, 9), ' class="row col"'])
        w = r.choice(WORDS[kind])
        return f' {r.choice(["class", "id", "class"])}="{r.choice([w, w + "-" + r.choice(["box", "wrap", "1", "list"]), "js " + w])}"'

    def links(n: int, tag: str = "li") -> str:
        return "".join(f'<{tag}><a href="/{i}">{_words(r, r.randint(1, 3))}</a></{tag}>' for i in range(n))

    def menu() -> str:
        return r.choice([f"<nav{name('menu')}><ul>{links(r.randint(2, 9))}</ul></nav>", f"<div{name('menu')}><ul>{links(r.randint(3, 9))}</ul></div>", f"<nav>{links(r.randint(2, 6), 'div')}</nav>"])

    def advert() -> str:
        return f"<div{name('advert') if r.random() < 0.9 else ''}>{r.choice([_words(r, r.randint(3, 25)), f'<p>{_words(r, r.randint(4, 30))}</p>'])}</div>"

    def side() -> str:
        body = r.choice([f"<h3>{_words(r, 2)}</h3><ul>{links(r.randint(2, 6))}</ul>", f"<h4>{_words(r, 2)}</h4><p>{_words(r, r.randint(5, 40))}</p>", f"<p>{_words(r, r.randint(5, 25))} <a href='#'>{_words(r, 2)}</a></p>"])
        return r.choice([f"<aside{name('side')}>{body}</aside>", f"<div{name('side')}>{body}</div>", f"<aside>{body}</aside>"])

    def notice() -> str:
        return f"<{(t := r.choice(['div', 'section', 'aside']))}{' class=' + chr(34) + r.choice(WORDS['notice']) + chr(34)}><p>{_words(r, r.randint(5, 40))}</p>{r.choice(['<button>Ok</button>', ''])}</{t}>"

    def form() -> str:
        return f"<form{name('form')}><p>{_words(r, r.randint(1, 12))}</p><label>{_words(r, 1)}</label><input name=q><button>Go</button></form>"

    def comments() -> str:
        one = lambda: f"<{(t := r.choice(['div', 'li', 'article']))}{' class=' + chr(34) + r.choice(['comment', 'reply', 'comment-body']) + chr(34)}><p>{_words(r, 2)}</p><p>{_words(r, r.randint(4, 90))}</p></{t}>"
        body = "".join(one() for _ in range(r.randint(1, 6)))
        return f"<{(t := r.choice(['section', 'div', 'aside']))}{' ' + r.choice(['class', 'id']) + '=' + chr(34) + r.choice(WORDS['comment']) + chr(34)}><h3>{_words(r, 2)}</h3>{body}</{t}>"

    def header() -> str:
        return r.choice([f"<header{name('frame')}><h1>{_words(r, 2)}</h1>{menu()}</header>", f"<header><p>{_words(r, 4)}</p></header>", f"<div{name('frame')}><a href='/'>{_words(r, 2)}</a></div>"])

    def footer() -> str:
        return r.choice([f"<footer>&copy; {_words(r, r.randint(1, 30))}</footer>", f"<footer{name('frame')}><p>{_words(r, r.randint(3, 25))}</p><ul>{links(3)}</ul></footer>", f"<div{name('frame')}>{_words(r, r.randint(2, 12))} {links(2, 'span')}</div>"])

    def share() -> str:
        return f"<div{name('social')}>{links(r.randint(2, 4), 'span')}</div>"

    def paragraph() -> str:
        n = r.choice([3, 5, 8, 20, 40, 80, 150])
        t = M + _words(r, r.randint(max(1, n // 2), n))
        if r.random() < 0.2:
            t += f' <a href="/x">{_words(r, 2)}</a> ' + _words(r, 4)
        if r.random() < 0.1:
            return f"<ul>{''.join(f'<li>{M}{_words(r, r.randint(2, 15))}</li>' for _ in range(r.randint(2, 5)))}</ul>"
        if r.random() < 0.06:
            return f"<blockquote><p>{t}</p></blockquote>"
        if r.random() < 0.05:
            return f"<table><tr><td>{M}{_words(r, 3)}</td><td>{M}{_words(r, 3)}</td></tr></table>"
        if r.random() < 0.08:
            return f"<h{(k := r.randint(2, 4))}>{M}{_words(r, 4)}</h{k}>"
        return r.choice([f"<p>{t}</p>", f"<p>{t}", f"<p><b>{t}<br>", f"<p>{t}</p>", f"<div>{t}</div>" if r.random() < 0.3 else f"<p>{t}</p>"])

    inner = [paragraph() for _ in range(r.choice([0, 1, 1, 2, 2, 4, 8, 15]))]
    for make, chance in ((advert, 0.2), (share, 0.2), (side, 0.12), (notice, 0.08), (form, 0.08), (comments, 0.15)):
        if r.random() < chance:
            inner.insert(r.randint(0, len(inner)), make())
    title = f"<h1>{M}{_words(r, r.randint(2, 9))}</h1>"
    if r.random() < 0.15:
        title = f"<header>{title}</header>"
    shell = r.choice([("<article>", "</article>"), (f"<div{name('content')}>", "</div>"), ("<main><article>", "</article></main>"), (f"<main{name('content')}>", "</main>"), (f"<section{name('content')}>", "</section>"), (f"<article{name('content')}><div>", "</div></article>")])
    article = shell[0] + title + "".join(inner) + shell[1]
    top = [f() for f, c in ((header, 0.5), (menu, 0.7), (advert, 0.5), (notice, 0.3), (side, 0.2), (form, 0.15)) if r.random() < c]
    bottom = [f() for f, c in ((share, 0.2), (comments, 0.4), (side, 0.4), (form, 0.2), (advert, 0.2), (notice, 0.2), (footer, 0.8)) if r.random() < c]
    r.shuffle(top)
    body = "".join(top) + article + "".join(bottom)
    if r.random() < 0.3:
        body = f"<div{r.choice(['', ' id=wrap', ' class=container'])}>{body}</div>"
    page = f"<!DOCTYPE html><html><head><title>{_words(r, 4)}</title><style>p{{}}</style></head><body>{body}" + r.choice(["</body></html>", ""])
    blocks, texts = parse(page)
    holds = [False] * len(blocks)
    for b, t in texts:
        if M in t:
            while b >= 0:
                holds[b] = True
                b = blocks[b].parent
    return page.replace(M, ""), holds


@lru_cache(maxsize=4)
def trained(pages: int = 800, seed: int = 11) -> Trees:
    """The trees, trained on so many generated pages; the same for every call with the same numbers."""
    r = random.Random(seed)
    xs, ys = [], []
    for _ in range(pages):
        page, holds = example_page(r)
        blocks, _ = parse(page)
        xs.append(features(blocks)[1:])
        ys.append(np.array(holds[1:], dtype=np.float64))
    return boost(np.concatenate(xs), np.concatenate(ys))


def choose(blocks: list[Block], z: np.ndarray) -> list[bool]:
    """The likeliest choice in which nothing is kept below what is dropped. z: log-odds; the root is always kept."""
    keep = [float(-np.logaddexp(0, -s)) for s in z]
    drop = [float(-np.logaddexp(0, s)) for s in z]
    for i in range(len(blocks) - 1, 0, -1):
        p = blocks[i].parent
        keep[p] += max(keep[i], drop[i])
        drop[p] += drop[i]
    out = [False] * len(blocks)
    out[0] = True
    for i in range(1, len(blocks)):
        out[i] = out[blocks[i].parent] and keep[i] >= drop[i]
    return out


def extract_many(pages: list[str | None], trees: Trees) -> list[str]:
    """The main text of each page; the blocks of all pages are scored together."""
    parsed = [parse(p or "") for p in pages]
    rows = [features(b) for b, _ in parsed]
    z = trees.score(np.concatenate(rows)) if rows else np.zeros(0)
    out, at = [], 0
    for (blocks, texts), x in zip(parsed, rows):
        kept = choose(blocks, z[at : at + len(x)])
        at += len(x)
        out.append(" ".join(t for b, t in texts if kept[b]))
    return out


def text_column(page: str | Column = "html", trees: Trees | None = None) -> Column:
    """The main text of a column of pages; empty for null, empty and text-free ones."""
    trees = trees or trained()

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            values = s.tolist()
            yield pd.Series([t for k in range(0, len(values), 200) for t in extract_many(values[k : k + 200], trees)], dtype="object")

    return extract(F.col(page) if isinstance(page, str) else page)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of each row of pages, whole pages of any length.

    A map without a shuffle. A null or empty page, or one without text, gives an empty text; repeated rows are
    read each for itself; other columns are not read; an empty table gives an empty result.
    """
    return pages.select("page_id", "url", text_column().alias("text")).withColumn("n_chars", F.length("text").cast("long"))
