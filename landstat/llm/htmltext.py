"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the DOM.

A page is cut into leaf blocks, runs of text between the borders of block-level elements. Each block has features of its
ancestors (tags, and words in their class, id and role) and of its text; each two neighbours have one of their two labels.
Weights are trained here on labelled pages, by the gradient of the likelihood; Viterbi finds the best labels of a page.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landstat.llm.common import table

#: Elements that do not end a block, elements without an end tag, elements whose content is not markup, and
#: elements whose text is never shown.
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript".split())
UNSEEN = set("script style title iframe noembed noframes noscript head template svg math object canvas audio video map datalist textarea select".split())
#: Words in class, id or role that speak for boilerplate, and for main text.
AGAINST = {
    "nav": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc tabs",
    "edge": "header footer masthead banner colophon copyright contentinfo topbar bottom",
    "side": "sidebar aside side widget widgets complementary rail related recommended recommendations popular trending more",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner-ad dfp outbrain taboola",
    "talk": "comment comments commentlist reply replies respond disqus discussion reader-comments feedback reviews",
    "ask": "form login signin signup subscribe subscription newsletter search share social sharing follow register",
    "note": "cookie cookies consent gdpr notice notices alert popup modal overlay disclaimer warning toast hidden",
}
FOR = "article content main post entry story body text articlebody post-content entry-content article-body prose"
WORD_KIND = {w: k for k, ws in AGAINST.items() for w in ws.split()} | {w: "main" for w in FOR.split()}
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)>", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)


@lru_cache(maxsize=20_000)
def kinds_of(attributes: str) -> tuple[str, ...]:
    """What the attributes of an element say about it: a kind for a whole word of them, a kind with - after it for the last part
    of a compound word (content-ad) and with - before it for another part (hidden-gem)."""
    out = set()
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            out.add("unseen")
        elif name in ("class", "id", "role"):
            for word in value.split():
                if word in WORD_KIND:
                    out.add(WORD_KIND[word])
                    continue
                *before, last = re.split(r"[-_\d]+|:", word.strip("-_0123456789:")) or [""]
                if last in WORD_KIND:
                    out.add(WORD_KIND[last] + ("-" if before else ""))
                out.update(f"-{WORD_KIND[w]}" for w in before if w in WORD_KIND)
    return tuple(sorted(out))


@dataclass
class Block:
    path: tuple  # ancestors, outermost first: (tag, kinds)
    text: str
    linked: int  # characters inside links


def decode(text: str) -> str:
    """Character references decoded, white space turned into single spaces, trimmed."""
    if "&" in text:
        text = "&".join(entities.unescape(x) if "&" in x else x for x in text.split("&amp;"))
    return " ".join(text.split())


def blocks_of(html: str) -> list[Block]:
    """The leaf blocks of a page in page order, without empty ones; markup that is not closed, or closed twice, is borne."""
    out: list[Block] = []
    stack: list[tuple] = []
    parts: list[str] = []
    links, linked, unseen, at, n = 0, 0, 0, 0, len(html)

    def flush() -> None:
        nonlocal linked
        if parts:
            if text := decode("".join(parts)):
                out.append(Block(tuple(stack), text, linked))
            parts.clear()
        linked = 0

    def close(k: int) -> None:
        nonlocal unseen
        while len(stack) > k:
            unseen -= stack.pop()[0] in UNSEEN

    while at < n:
        m = TOKEN.search(html, at)
        end = m.start() if m else n
        if end > at and not unseen:
            piece = html[at:end]
            parts.append(piece)
            if links:
                linked += len(piece)
        if not m:
            break
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag in INLINE:
                links = max(0, links - (tag == "a"))
                continue
            flush()
            links = 0
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    close(k)
                    break
            continue
        if tag in INLINE:
            links += tag == "a"
            if tag == "br":
                parts.append(" ")
            continue
        flush()
        links = 0
        if tag in RAW and not m[3].endswith("/"):
            found = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at)
            if tag not in UNSEEN and not unseen:
                stack.append((tag, kinds_of(m[3])))
                parts.append(html[at : found.start() if found else n])
                flush()
                stack.pop()
            at = found.end() if found else n
            continue
        if tag in VOID:
            continue
        if tag == "body":
            close(0)
        elif stack and stack[-1][0] == "head" and tag != "template":  # a head that is not closed ends at the first element that it can't hold
            close(len(stack) - 1)
        if stack and (stack[-1][0] == "p" or tag in ("li", "option", "dt", "dd", "tr", "td", "th") and stack[-1][0] == tag):
            close(len(stack) - 1)
        stack.append((tag, kinds_of(m[3])))
        unseen += tag in UNSEEN
    flush()
    return out


#: Elements that hold a page's text or large parts of it, so that their class words say less.
LARGE = set("html body main article".split())


@lru_cache(maxsize=20_000)
def path_features(path: tuple) -> tuple[str, ...]:
    tags = [t for t, _ in path]
    out = {f"in:{t}" for t in tags if t not in ("html", "body", "div", "section")}
    out.add(f"parent:{tags[-1] if tags else '-'}")
    said = [(f"{k}@" if t in LARGE else k) for t, ks in path for k in ks]
    out |= {f"kind:{k}" for k in said}
    if not said:
        out.add("kind:-")
    out.add(f"near:{said[-1] if said else '-'}")
    return tuple(sorted(out))


def text_features(block: Block) -> tuple[str, ...]:
    n = len(block.text)
    words = block.text.count(" ") + 1
    share = block.linked / max(1, n)
    ends = block.text[-1] in ".!?:;…\"'”)"
    return (
        "bias",
        f"words:{min(6, words.bit_length())}",
        f"linked:{0 if share == 0 else 1 if share < 0.5 else 2}",
        f"ends:{int(ends)}",
        f"sign:{int(block.text[0] in '©®')}",
    )


@dataclass
class Crf:
    weights: dict[str, np.ndarray]  # feature: weight of labels 0 (boilerplate) and 1 (main text)
    first: np.ndarray
    step: np.ndarray  # [label before, label]

    def __post_init__(self):
        self.of_path: dict[tuple, np.ndarray] = {}

    def emissions(self, blocks: list[Block]) -> np.ndarray:
        none = np.zeros(2)
        if len(self.of_path) > 20_000:
            self.of_path = {}
        out = np.empty((len(blocks), 2))
        for i, b in enumerate(blocks):
            if (path := self.of_path.get(b.path)) is None:
                path = self.of_path[b.path] = sum((self.weights.get(f, none) for f in path_features(b.path)), none)
            out[i] = path
            for f in text_features(b):
                out[i] += self.weights.get(f, none)
        return out

    def labels(self, blocks: list[Block]) -> list[int]:
        """The likeliest labels of a page's blocks together (Viterbi)."""
        if not blocks:
            return []
        scores = self.emissions(blocks).tolist()
        (s00, s01), (s10, s11) = self.step.tolist()
        a, b = scores[0][0] + self.first[0], scores[0][1] + self.first[1]
        back = []
        for x, y in scores[1:]:
            from0, from1 = a + s00 < b + s10, a + s01 < b + s11
            back.append((int(from0), int(from1)))
            a, b = (b + s10 if from0 else a + s00) + x, (b + s11 if from1 else a + s01) + y
        label = int(b > a)
        out = [label]
        for pair in reversed(back):
            label = pair[label]
            out.append(label)
        return out[::-1]


def train(pages: list[tuple[list[Block], list[int]]], steps: int = 150, rate: float = 0.1, decay: float = 0.01) -> Crf:
    """Weights under which the labels of the pages are likeliest (less a penalty on large weights), by forward-backward and Adam."""
    rows = [[(*path_features(b.path), *text_features(b)) for b in blocks] for blocks, _ in pages if blocks]
    labels = [ls for blocks, ls in pages if blocks]
    names = {f: i for i, f in enumerate(sorted({f for page in rows for fs in page for f in fs}))}
    n, longest = len(rows), max(map(len, rows))
    x = np.zeros((n, longest, len(names)))
    y = np.zeros((n, longest), dtype=int)
    live = np.zeros((n, longest), dtype=bool)
    for p, (page, ls) in enumerate(zip(rows, labels)):
        live[p, : len(page)] = True
        y[p, : len(page)] = ls
        for t, fs in enumerate(page):
            x[p, t, [names[f] for f in fs]] = 1.0
    one = np.eye(2)[y] * live[..., None]
    pairs = np.einsum("pti,ptj->ij", one[:, :-1], one[:, 1:])
    params = [np.zeros((len(names), 2)), np.zeros(2), np.zeros((2, 2))]
    m, v = [np.zeros_like(w) for w in params], [np.zeros_like(w) for w in params]
    lse = lambda a, axis: np.logaddexp.reduce(a, axis=axis)
    for k in range(1, steps + 1):
        w, first, step = params
        e = x @ w
        forward, backward = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        forward[:, 0] = e[:, 0] + first
        for t in range(1, longest):
            forward[:, t] = np.where(live[:, t, None], lse(forward[:, t - 1, :, None] + step, 1) + e[:, t], forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            backward[:, t] = np.where(live[:, t + 1, None], lse(step + (e[:, t + 1] + backward[:, t + 1])[:, None, :], 2), 0.0)
        z = lse(forward[:, -1], 1)
        own = np.exp(forward + backward - z[:, None, None]) * live[..., None]
        both = np.exp(forward[:, :-1, :, None] + step + (e + backward)[:, 1:, None, :] - z[:, None, None, None]) * live[:, 1:, None, None]
        grads = [np.einsum("ptf,pti->fi", x, own - one) / n + decay * w, (own - one)[:, 0].sum(0) / n, (both.sum((0, 1)) - pairs) / n + decay * step]
        for j, g in enumerate(grads):
            m[j] = 0.9 * m[j] + 0.1 * g
            v[j] = 0.999 * v[j] + 0.001 * g * g
            params[j] = params[j] - rate * (m[j] / (1 - 0.9**k)) / (np.sqrt(v[j] / (1 - 0.999**k)) + 1e-8)
    return Crf({f: params[0][i] for f, i in names.items()}, params[1], params[2])


#: Labelled pages: layouts in which {M} stands for paragraphs of main text, {H} for a heading of it, {L} for a main list, {B} for
#: boilerplate lines, {N} for items of linked navigation, {C} for reader comments.
LAYOUTS = (
    "<html><body><nav><ul>{N}</ul></nav><div class='ad'>{b}</div><article><h1>{H}</h1>{M}</article><footer>{b}</footer></body></html>",
    "<html><body><header><h1>{b}</h1><nav>{N}</nav></header><main><article><h1>{H}</h1>{M}<h2>{H}</h2>{M}</article></main><aside>{B}</aside><footer><p>{b}</p></footer></body></html>",
    "<html><body><div id='header'>{b}<ul class='menu'>{N}</ul></div><div id='content'><h2>{H}</h2>{M}</div><div id='sidebar'>{B}<ul>{N}</ul></div><div id='footer'>{b}</div></body></html>",
    "<html><body><div class='cookie-notice'><p>{b}</p></div><header>{b}</header><article><header><h1>{H}</h1></header><div class='entry-content'>{M}</div></article><section class='comments'><h3>{b}</h3>{C}<form><label>{b}</label></form></section><footer>{b}</footer></body></html>",
    "<html><body><table class='nav'><tr><td>{N}</td></tr></table><div class='post'><h1>{H}</h1>{M}{L}{M}</div><div id='comments'>{C}</div><div class='related'>{N}</div></body></html>",
    "<html><body><div class='topbar'>{b}</div><main><h1>{H}</h1>{M}<div class='advert'>{B}</div>{M}<div class='share'>{N}</div></main><form class='newsletter'><p>{b}</p>{B}</form><footer>{B}</footer></body></html>",
    "<html><body><nav>{N}</nav><div><div class='story-body'>{M}{M}</div></div><aside class='promo'>{B}</aside><div class='comment'>{C}</div><footer>{N}{b}</footer></body></html>",
    "<html><body><article><h1>{H}</h1><p class='notice'>{b}</p>{M}<aside>{B}</aside>{M}<blockquote>{M}</blockquote><footer>{b}</footer></article><section id='respond'><form>{B}</form></section></body></html>",
    "<html><body><header><p>{b}</p></header><article>{M}<table>{T}</table>{M}<div class='comments'>{C}</div></article><div class='sidebar'>{B}</div></body></html>",
    "<html><body><nav><ul>{N}</ul></nav><article>{M}<section><h2>{H}</h2>{M}{L}</section><form><p>{b}</p></form><nav>{N}</nav></article><footer>{b}</footer></body></html>",
    "<html><body><div role='navigation'>{N}</div><div role='main'><h1>{H}</h1>{M}<pre>{H}</pre></div><div role='complementary'>{B}</div><div role='contentinfo'>{b}</div></body></html>",
    "<html><body><div class='banner'>{b}</div><div class='article-body'>{M}<figure><figcaption>{H}</figcaption></figure>{M}</div><div class='popup'>{b}</div><ul class='social'>{N}</ul></body></html>",
    "<article>{M}</article>",
    "<article><h1>{H}</h1>{M}<div class='comments'>{C}</div><div>{M}</div></article>",
    "<html><body><h1>{H}</h1>{M}{L}</body></html>",
    "<html><body><div>{M}</div></body></html>",
    "{M}",
    "<html><body><div><ul>{N}</ul></div><div><h1>{H}</h1>{M}</div><div><ul>{N}</ul></div></body></html>",
    "<div class='content'>{M}<div class='note comment-list'>{C}</div></div>",
    "<html><body><main>{M}{L}{M}</main><aside>{B}</aside></body></html>",
    "<html><body class='has-sidebar with-comments'><div class='main-nav'><ul>{N}</ul></div><article class='post hidden-gem promo-series'><h1>{H}</h1>{M}<div class='post-footer'>{b}</div></article><div class='site-footer'>{B}</div></body></html>",
    "<html><body class='nav-open'><main class='content-area no-sidebar'><h1>{H}</h1>{M}<div class='content-ad'>{B}</div>{M}<div class='in-article-promo'>{b}</div>{M}</main><div class='sidebar-left'>{B}</div></body></html>",
    "<html><body><div class='site-header'>{b}</div><div class='post-body story-content'><h2>{H}</h2>{M}<div class='ad-slot'>{B}</div>{M}</div><div class='comment-list'>{C}</div><div class='widget-area'>{N}</div><div class='footer-links'>{N}</div></body></html>",
    "<html><body><div class='cookie-banner'>{B}</div><div class='main-content'><div class='article-header'><h1>{H}</h1></div>{M}{L}{M}<div class='social-share'>{N}</div><div class='newsletter-signup'><p>{b}</p><button>{b}</button></div></div><div class='related-posts'>{N}</div></body></html>",
    "<html><body><article class='ad-free premium-article comment-enabled'>{M}{M}<div class='story-ad'>{b}</div>{M}<div class='user-comments'>{C}</div></article><div class='bottom-bar'>{b}</div></body></html>",
    "<html><body><article><h1>{H}</h1>{M}<form><label>{b}</label><button>{b}</button></form>{M}</article><footer>{b}</footer></body></html>",
    "<html><body><main>{M}<form class='poll'><fieldset><legend>{b}</legend><label>{b}</label></fieldset><button>{b}</button></form>{M}</main></body></html>",
    "<html><body><div class='site-header'><p>{b}</p></div><main class='site-main'><article class='post type-post'><header class='entry-header'><h1>{H}</h1></header><div class='entry-content'>{M}</div><footer class='entry-footer'>{b}</footer></article><div id='comments' class='comments-area'><ol class='comment-list'><li>{C}</li><li><p>{b}</p></li></ol></div></main><aside class='widget-area'>{B}</aside></body></html>",
    "<html><body><main><article>{M}{L}<footer><p>{b}</p></footer></article><section class='reader-comments'>{C}</section></main></body></html>",
    "<html><body class='single-post'><div id='page' class='site'><header class='site-header'><p>{b}</p></header><div id='content' class='site-content'><main id='main' class='site-main'><article class='post'><header class='entry-header'><h1 class='entry-title'>{H}</h1></header><div class='entry-content'>{M}</div><footer class='entry-footer'>{b}</footer></article><div id='comments' class='comments-area'><ol class='comment-list'><li>{C}</li></ol></div></main></div><footer id='colophon'>{b}</footer></div></body></html>",
    "<html><body><div id='content'><div class='content-inner'><div class='article-text'>{M}<p>{H}</p></div><div class='content-comments'><p>{b}</p>{C}</div><div class='content-share'>{N}</div></div></div></body></html>",
    "<html><body><div class='notice-board-story'>{M}</div><div class='site-notice'>{B}</div><div class='search-box'><form>{b}<button>{b}</button></form></div></body></html>",
)


def labelled_pages(per_layout: int = 5, seed: int = 0) -> list[tuple[list[Block], list[int]]]:
    """Pages from the layouts with drawn texts, and the labels of their blocks; main text carries a mark until blocks are cut."""
    rng = random.Random(seed)
    mark = "\ue000"

    def sentence(low: int, high: int) -> str:
        words = ["".join(rng.choice("aeiounrstlmdhc") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(low, high))]
        if rng.random() < 0.1:
            words = [w.upper() + rng.choice(["!!", "", "***"]) for w in words]
        return " ".join(words).capitalize() + rng.choice([".", ".", ".", "", "!", "..."])

    def line(low: int = 1, high: int = 12) -> str:
        return rng.choice(["&copy; ", "", "", ""]) + sentence(low, high)

    def paragraphs() -> str:
        def one() -> str:
            text = " ".join(sentence(1, 25) for _ in range(rng.choice([1, 1, 1, 2, 4, 9])))
            if rng.random() < 0.15:
                text += f" <a href='#'>{sentence(1, 3)}</a>"
            return f"<p>{rng.choice(['', '<b>'])}{mark}{text}{rng.choice(['</p>', '</p>', '<br>'])}"

        return "".join(one() for _ in range(rng.choice([1, 2, 3, 6])))

    makers = {
        "{M}": paragraphs,
        "{H}": lambda: mark + sentence(1, 12),
        "{L}": lambda: "<ul>" + "".join(f"<li>{mark}{sentence(1, 12)}</li>" for _ in range(rng.randint(1, 5))) + "</ul>",
        "{T}": lambda: "".join(f"<tr><td>{mark}{sentence(1, 4)}</td></tr>" for _ in range(rng.randint(1, 4))),
        "{b}": line,
        "{B}": lambda: "".join(f"<p>{line(1, 30)}</p>" for _ in range(rng.randint(1, 3))),
        "{N}": lambda: "".join(f"<li><a href='/{i}'>{sentence(1, 3)}</a></li>" for i in range(rng.randint(2, 7))),
        "{C}": lambda: "".join(f"<div class='reply'><p>{sentence(2, 40)}</p></div>" for _ in range(rng.randint(1, 3))),
    }
    out = []
    for layout in LAYOUTS:
        for _ in range(per_layout):
            page = re.sub(r"\{\w\}", lambda m: makers[m[0]](), layout)
            blocks = blocks_of(page)
            labels = [int(mark in b.text) for b in blocks]
            for b in blocks:
                b.text = b.text.replace(mark, "") or "-"
            out.append((blocks, labels))
    return out


def main_text(html: str, crf: Crf) -> str:
    """The blocks that the field takes for main text, joined in page order by line feeds."""
    blocks = blocks_of(html)
    return "\n".join(b.text for b, label in zip(blocks, crf.labels(blocks)) if label)


def extract(pages: DataFrame, crf: Crf | None = None, html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` and a column ``text`` (a column of this name is replaced): the main text of the whole html, empty if none.

    A null or empty html has no text. Repeated rows get equal texts. ``crf`` is trained on the labelled pages of this module
    unless given; its size does not depend on the data.
    """
    shared = pages.sparkSession.sparkContext.broadcast(crf or train(labelled_pages()))
    columns = [c for c in pages.columns if c.lower() != text.lower()]
    schema = pages.select(*columns).withColumn(text, F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 128):
                batch = whole.slice(start, 128)
                texts = [main_text(h or "", shared.value) for h in batch.column(html).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(texts, pa.string())], names=[*columns, text])

    return pages.mapInArrow(run, schema)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page of ``pages``."""
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
