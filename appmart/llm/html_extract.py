"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded hierarchically.

Every element gets features: its tag, telling words of its class, id and role,
the same for its ancestors, the density of text, links and punctuation in its
subtree, depth, and how it stands among its siblings. Trees fitted on
generated pages with known answers (TRAINING_PAGES of them, layouts drawn by
rule) give the log odds that the element belongs to the article.

Decoding picks the likeliest consistent labelling of the whole tree: on every
path from the root the labels read outside, then inside, then cut out, each
part possibly empty. So an ancestor and a descendant can never contradict each
other: nothing inside a cut-out subtree comes back, and what is inside is so
up to one element.

Defined results: null or empty html gives an empty text; unclosed, misnested
and cut-off markup is read as far as it goes; a page without article has an
empty text; repeated pages give the same text; an empty table an empty result.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import gbt
from .dom import Page

TRAINING_PAGES = 400
TAGS = ("html head body main article section div p h1 h2 h3 h4 ul ol li dl dd dt table tr td th figure figcaption "
        "blockquote pre nav header footer aside form button a b i em strong span label select").split()
ARTICLE_WORDS = "article content post entry body main text story".split()
OTHER_WORDS = ("nav navigation menu header head footer foot sidebar side aside widget ad ads advert advertisement banner "
               "promo sponsor sponsored cookie notice consent popup modal alert comment comments reply respond discussion "
               "thread share social related recommended breadcrumb breadcrumbs newsletter subscribe search login "
               "pagination copyright").split()
OTHER_TAGS = "nav header footer aside form button label select".split()
_TAG = {t: k for k, t in enumerate(TAGS)}
_ARTICLE, _OTHER, _ASIDE = frozenset(ARTICLE_WORDS), frozenset(OTHER_WORDS), frozenset(OTHER_TAGS)
_STOPS = frozenset(".,;:!?")


def features(page: Page) -> np.ndarray:
    """One row per element."""
    n = len(page.tag)
    parent = np.array(page.parent)
    chars, words, stops, linked, below = (np.zeros(n) for _ in range(5))
    in_link = [False] * n
    for v in range(1, n):
        in_link[v] = in_link[page.parent[v]] or page.tag[v] == "a"
    for v, _, text in page.runs:
        bare = text.strip()
        if bare:
            chars[v] += len(bare)
            words[v] += bare.count(" ") + 1
            stops[v] += sum(map(bare.count, _STOPS))
            if in_link[v]:
                linked[v] += len(bare)
    own = chars.copy()
    children = np.bincount(parent[1:], minlength=n).astype(float)
    nth = np.zeros(n)
    count = [0] * n
    for v in range(1, n):
        nth[v] = count[parent[v]]
        count[parent[v]] += 1
    for v in range(n - 1, 0, -1):
        u = parent[v]
        for x in (chars, words, stops, linked):
            x[u] += x[v]
        below[u] += below[v] + 1
    up = np.maximum(parent, 0)
    siblings = np.maximum(children[up], 1)
    total = max(1.0, chars[0])
    numbers = np.stack([
        np.log1p(chars), np.log1p(words), chars / total, chars / np.maximum(1, chars[up]), linked / np.maximum(1, chars),
        stops / np.maximum(1, words), chars / (1 + below), np.log1p(below), own / np.maximum(1, chars), children,
        np.array(page.depth, dtype=float), nth, nth / siblings, siblings,
        chars / np.maximum(1, (chars[up] - own[up]) / siblings)], axis=1)
    tags = np.zeros((n, len(TAGS)))
    # Own words of an article, own words and tags of other parts; below, the same over all ancestors and, of the
    # latter, over those inside the nearest element that calls itself an article.
    named = np.zeros((n, 3))
    above = np.zeros((n, 4))
    for v in range(n):
        if (k := _TAG.get(page.tag[v])) is not None:
            tags[v, k] = 1
        words_of = page.tokens[v]
        named[v] = (len(words_of & _ARTICLE), len(words_of & _OTHER), page.tag[v] in _ASIDE)
        if v:
            u = parent[v]
            above[v, :3] = above[u, :3] + named[u]
            root = page.tag[u] in ("article", "main") or named[u, 0] > 0 and not named[u, 1]
            above[v, 3] = 1 if root else 0 if named[u, 1] or named[u, 2] else above[u, 3]
    return np.hstack([numbers, tags, named, above])


def decode(parent: list[int], odds: np.ndarray) -> list[int]:
    """Likeliest labels 0 outside, 1 inside, 2 cut out, with 0* 1* 2* on every path from the root."""
    n = len(parent)
    yes, no = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
    best = [[no[v], yes[v], no[v]] for v in range(n)]
    for v in range(n - 1, 0, -1):
        up, (out, inside, cut) = best[parent[v]], best[v]
        up[0] += max(out, inside)
        up[1] += max(inside, cut)
        up[2] += cut
    label = [0] * n
    label[0] = 0 if best[0][0] >= best[0][1] else 1
    for v in range(1, n):
        out, inside, cut = best[v]
        above = label[parent[v]]
        label[v] = 2 if above == 2 else (1 if inside >= cut else 2) if above == 1 else (1 if inside > out else 0)
    return label


def main_text(page: Page, label: list[int]) -> str:
    """The text of the inside elements, a line per block."""
    lines: list[str] = []
    block, parts = -1, []
    for v, b, text in [*page.runs, (0, -2, "")]:
        if b != block:
            line = " ".join("".join(parts).split())
            if line:
                lines.append(line)
            block, parts = b, []
        if b >= 0 and label[v] == 1:
            parts.append(text)
    return "\n".join(lines)


_NAMES = "river stone market window garden letter winter silver morning paper harbour forest bridge summer candle music " \
         "history science village machine doctor teacher captain island mountain valley engine painter kitchen".split()


def _prose(rng: random.Random, least: int, most: int) -> str:
    out, n = [], rng.randint(least, most)
    while len(out) < n:
        sentence = [rng.choice(_NAMES) for _ in range(rng.randint(3, 14))]
        sentence[0] = sentence[0].capitalize()
        out += [w + ("," if rng.random() < 0.08 else "") for w in sentence[:-1]] + [sentence[-1] + "."]
    return " ".join(out)


def _pick(rng: random.Random, *choices: str) -> str:
    return rng.choice(choices)


def _boilerplate(rng: random.Random, kind: str) -> str:
    """A subtree that is not part of the article; marked for training."""
    links = lambda k: "".join(f'<li><a href="/{rng.choice(_NAMES)}">{" ".join(rng.sample(_NAMES, rng.randint(1, 4)))}</a></li>'
                              for _ in range(k))
    named = lambda tag, *names: f'<{tag} {_pick(rng, "class", "id")}="{rng.choice(names)}" data-y="0">'
    if kind == "menu":
        a, z = (('<nav data-y="0">', "</nav>") if rng.random() < 0.6 else
                (named("div", "menu", "main-nav", "navigation menu", "nav", "breadcrumbs", "pagination"), "</div>"))
        return f"{a}<ul>{links(rng.randint(3, 9))}</ul>{z}"
    if kind == "header":
        a, z = ('<header data-y="0">', "</header>") if rng.random() < 0.6 else (named("div", "header", "site-header", "head banner"), "</div>")
        inner = _pick(rng, f"<h1>{rng.choice(_NAMES)}</h1>", f"<p>{_prose(rng, 2, 8)}</p>", f"<a href='/'>{rng.choice(_NAMES)}</a>")
        return a + inner + z
    if kind == "footer":
        a, z = ('<footer data-y="0">', "</footer>") if rng.random() < 0.6 else (named("div", "footer", "site-footer", "copyright"), "</div>")
        return f"{a}{_pick(rng, '&copy; ', '')}{rng.choice(_NAMES)}.example {_pick(rng, '&middot; ', '')}{_prose(rng, 2, 25)}{z}"
    if kind == "side":
        a, z = ('<aside data-y="0">', "</aside>") if rng.random() < 0.5 else (named("div", "sidebar", "side", "widget", "related", "recommended", "share social"), "</div>")
        return a + _pick(rng, f"<h3>{rng.choice(_NAMES)}</h3><ul>{links(4)}</ul>", f"<p>{_prose(rng, 5, 40)}</p>",
                         f"<h2>{rng.choice(_NAMES)}</h2><p>{_prose(rng, 5, 30)}</p><p>{_prose(rng, 5, 30)}</p>") + z
    if kind == "notice":
        tag = _pick(rng, "div", "section")
        return named(tag, "cookie-notice", "cookie", "notice", "consent", "popup", "alert", "modal") + _pick(
            rng, _prose(rng, 4, 30), f"<p>{_prose(rng, 4, 30)}</p><button>{rng.choice(_NAMES)}</button>") + f"</{tag}>"
    if kind == "advert":
        return named("div", "ad", "ads", "advert", "advertisement", "banner", "promo", "sponsored") + _pick(
            rng, _prose(rng, 3, 40), f"<p>{_prose(rng, 3, 30)}</p>", f"<a href='/x'>{_prose(rng, 3, 10)}</a>") + "</div>"
    if kind == "form":
        a = '<form data-y="0">' if rng.random() < 0.6 else '<form class="newsletter subscribe" data-y="0">'
        return f"{a}<label>{_prose(rng, 2, 10)}</label><input name='q'><button>{rng.choice(_NAMES)}</button></form>"
    tag = _pick(rng, "section", "div", "ol")
    item = "li" if tag == "ol" else "div"
    posts = "".join(f'<{item} class="{_pick(rng, "comment", "reply", "comment-body")}"><b>{rng.choice(_NAMES)}</b>'
                    f"<p>{_prose(rng, 4, 60)}</p></{item}>" for _ in range(rng.randint(1, 5)))
    return f'<{tag} {_pick(rng, "class", "id")}="{_pick(rng, "comments", "discussion", "respond comments")}" data-y="0">{posts}</{tag}>'


def training_page(seed: int) -> str:
    """A generated page whose article root carries data-y="1" and whose other parts carry data-y="0"."""
    rng = random.Random(seed)
    body = []
    if rng.random() < 0.9:
        body.append(f"<h1>{_prose(rng, 3, 10)}</h1>")
    for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 14])):
        body.append(_pick(
            rng, f"<p>{_prose(rng, 3, 20)}</p>", f"<p>{_prose(rng, 20, 90)}</p>", f"<p>{_prose(rng, 40, 200)}",
            f"<p><b>{_prose(rng, 3, 30)}<br>", f"<h2>{_prose(rng, 2, 6)}</h2>",
            f"<ul><li>{_prose(rng, 2, 9)}</li><li>{_prose(rng, 2, 9)}</li></ul>", f"<blockquote><p>{_prose(rng, 6, 40)}</p></blockquote>",
            f"<p>{_prose(rng, 5, 40)} <a href='/y'>{rng.choice(_NAMES)}</a> {_prose(rng, 3, 30)}</p>",
            f"<table><tr><td>{_prose(rng, 1, 4)}</td><td>{_prose(rng, 1, 4)}</td></tr></table>",
            f"<figure><figcaption>{_prose(rng, 3, 12)}</figcaption></figure>", f"<div><p>{_prose(rng, 10, 60)}</p></div>"))
    if not body:
        body.append(f"<p>{_prose(rng, 1, 6)}</p>")
    for _ in range(rng.choice([0, 0, 1, 2])):
        body.insert(rng.randint(0, len(body)), _boilerplate(rng, rng.choice(["advert", "side", "form", "notice", "comments"])))
    root, end = _pick(
        rng, "<article>|</article>", "<article>|</article>", '<article class="post">|</article>', "<main>|</main>",
        '<div class="content">|</div>', '<div class="article-body">|</div>', '<div id="main-content">|</div>',
        '<div class="entry post-text">|</div>', '<section class="story">|</section>').split("|")
    main = root[:-1] + ' data-y="1">' + "".join(body) + end
    if rng.random() < 0.4:
        main = _pick(rng, "<div>", '<div class="wrapper">', '<div id="page" class="container">', "<main>") + main + "</div>"
    before = "".join(_boilerplate(rng, k) for k in rng.sample(["menu", "header", "notice", "advert", "side", "form"], rng.randint(0, 4)))
    after = "".join(_boilerplate(rng, k) for k in rng.sample(["comments", "footer", "side", "advert", "form", "menu", "notice"], rng.randint(0, 4)))
    page = f"<!DOCTYPE html><html><head><title>{rng.choice(_NAMES)}</title><style>p{{}}</style></head><body>{before}{main}{after}</body></html>"
    return page[:rng.randint(len(page) * 2 // 3, len(page))] if rng.random() < 0.15 else page


def labels_of(page: Page) -> np.ndarray:
    """1 for elements whose nearest marked ancestor-or-self is marked 1."""
    y = np.zeros(len(page.tag))
    for v in range(1, len(y)):
        y[v] = float(page.marked[v]) if page.marked[v] in ("0", "1") else y[page.parent[v]]
    return y


def train(pages: int = TRAINING_PAGES) -> tuple[np.ndarray, ...]:
    """Fit the trees on ``pages`` generated pages."""
    made = [Page(training_page(seed)) for seed in range(pages)]
    return gbt.fit(np.vstack([features(p) for p in made]), np.concatenate([labels_of(p) for p in made]))


def extract(model: tuple[np.ndarray, ...], sources: list[str]) -> list[str]:
    """Main texts of a few pages; their elements are scored together."""
    pages = [Page(s) for s in sources]
    if not pages:
        return []
    odds = gbt.margins(model, np.vstack([features(p) for p in pages]))
    ends = np.cumsum([len(p.tag) for p in pages])
    return [main_text(p, decode(p.parent, o)) for p, o in zip(pages, np.split(odds, ends[:-1]))]


def extract_pages(pages: DataFrame, model: tuple[np.ndarray, ...] | None = None, at_once: int = 64) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages`` (page_id, url, html)."""
    shared = pages.sparkSession.sparkContext.broadcast(train() if model is None else model)
    columns = pages.select("page_id", "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, at_once):
                part = batch.slice(a, at_once)
                texts = extract(shared.value, [h or "" for h in part.column(2).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])
    schema = columns.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")
    return columns.mapInArrow(run, schema)
