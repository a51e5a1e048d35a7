"""The main text of web pages, by a linear-chain conditional random field over leaf blocks.

A page is read once, tag by tag, into its leaf blocks: runs of text between block-level tags, in
page order. Each block has features of its ancestors (tags, and what their class and id say), of
its own tag and of its text. The field scores each block and each pair of neighbours; Viterbi's
algorithm finds the best labelling of a page, and the blocks labelled as main text are joined.

The field is trained on labelled pages that a seeded generator writes: sites of several layouts
with menus, headers, sidebars, notices, adverts, forms, comments and footers around articles, in
semantic tags or plain divisions, some with unclosed tags or cut short.

Defined results: a null or empty page has the empty text; character references are decoded,
unknown ones stay; white space in a block becomes one space, also at <br>; repeated rows give
equal results; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import use_worker

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<svg(?=[\s/])(?:\"[^\"]*\"|'[^']*'|[^'\">])*(?<=/)>"
    r"|<(script|style|noscript|template|svg|iframe)(?=[\s/>]|\Z).*?(?:</\1\s*>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)|([^<]+|<)",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html label legend li main menu nav ol optgroup option p pre section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
#: Tags that end an open element of the first kind that lies above all of the second kind.
_ENDS = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)), "td": ("td th", ("tr",)), "th": ("td th", ("tr",)), "option": ("option", ("select",))}
_TAGS = "article aside body button figcaption figure footer form head header h1 h2 h3 label li main nav ol option p section select table td textarea title ul div blockquote pre dl".split()
#: What class, id and role names say: feature, pattern of a name's part.
_SAYS = {
    "menu": r"nav|menu|breadcrumb|topbar|toolbar|pagination|pager",
    "head": r"header|masthead|branding|logo",
    "foot": r"foot|copyright|legal|colophon|imprint",
    "side": r"side|widget|rail|related|recommend|popular|trending|tags?$",
    "ad": r"^ads?$|^ad[-_]|advert|sponsor|promo|banner|teaser",
    "notice": r"cookie|consent|notice|alert|popup|modal|gdpr|paywall|newsletter|subscri|signup",
    "talk": r"comment|reply|replies|discuss|disqus|respond",
    "share": r"share|social|follow",
    "form": r"form|search|login|contact",
    "main": r"content|article|post|entry|story|main|text|body|prose",
}
_SAYS_RE = [(k, re.compile(p)) for k, p in _SAYS.items()]
FEATURES = (
    [f"in:{t}" for t in _TAGS] + [f"own:{t}" for t in _TAGS] + [f"says:{k}" for k in _SAYS] + [f"words:{i}" for i in range(7)] + [f"links:{i}" for i in range(4)]
    + ["stop", "commas", "copyright", "first", "last", "bias", "upper"]
)
_ID = {name: i for i, name in enumerate(FEATURES)}


@lru_cache(4096)
def _said(tag: str, attributes: str) -> frozenset[int]:
    out = {_ID[f"in:{tag}"]} if f"in:{tag}" in _ID else set()
    for m in _NAMES.finditer(attributes):
        for part in re.split(r"\s+", (m[1] or m[2] or m[3] or "").lower()):
            out.update(_ID[f"says:{k}"] for k, p in _SAYS_RE if p.search(part))
    return frozenset(out)


def blocks(html: str) -> list[tuple[str, frozenset[int], str, int]]:
    """(text, features of the ancestors, own tag, characters inside links) of each leaf block."""
    out: list[tuple[str, frozenset[int], str, int]] = []
    stack: list[tuple[str, frozenset[int]]] = [("", frozenset())]
    parts: list[str] = []
    linked = depth = 0

    def flush():
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                tag, said = stack[-1]
                out.append((text, said, tag, linked))
            parts.clear()
        linked = 0

    for m in _TOKEN.finditer(html):
        text = m[5]
        if text is not None:
            if "&" in text:
                text = unescape(text)
            parts.append(text)
            if depth:
                linked += len(text)
            continue
        tag = m[3]
        if tag is None:  # a comment, a script, a declaration
            continue
        tag = tag.lower()
        if tag == "a":
            depth = 0 if m[2] else 1
        elif tag == "br":
            parts.append(" ")
        elif tag in _BLOCKS:
            flush()
            if m[2]:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        del stack[i:]
                        break
                continue
            if stack[-1][0] == "p":  # any block ends an open paragraph
                stack.pop()
            if tag in _ENDS:
                kinds, above = _ENDS[tag]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in above:
                        break
                    if stack[i][0] in kinds.split():
                        del stack[i:]
                        break
            if tag not in _VOID and not m[4].endswith("/"):
                stack.append((tag, stack[-1][1] | _said(tag, m[4])))
    flush()
    return out


def features(page: list[tuple[str, frozenset[int], str, int]]) -> list[list[int]]:
    """Active features of each block."""
    out = []
    for i, (text, said, tag, linked) in enumerate(page):
        f = list(said)
        if (own := _ID.get(f"own:{tag}")) is not None:
            f.append(own)
        n = text.count(" ") + 1
        f.append(_ID["words:0"] + min(6, n.bit_length() - 1))
        f.append(_ID["links:0"] + min(3, 4 * linked // (len(text) + 1)))
        if text[-1] in ".!?…\"”»":
            f.append(_ID["stop"])
        if "," in text:
            f.append(_ID["commas"])
        if "©" in text or "All rights reserved" in text and n < 12:
            f.append(_ID["copyright"])
        if i == 0:
            f.append(_ID["first"])
        if i == len(page) - 1:
            f.append(_ID["last"])
        if text.isupper():
            f.append(_ID["upper"])
        f.append(_ID["bias"])
        out.append(f)
    return out


class Field:
    """A linear chain with two labels; label 1 is main text. emit: by feature and label."""

    def __init__(self, emit: np.ndarray, move: np.ndarray):
        self.emit, self.move = emit, move
        self._gain = (emit[:, 1] - emit[:, 0]).tolist()

    def decode(self, page: list[list[int]]) -> list[int]:
        """Viterbi's best labelling; only the difference of a block's two scores matters."""
        gain, ((m00, m01), (m10, m11)) = self._gain, self.move.tolist()
        a, b, back = 0.0, 0.0, []
        for t, f in enumerate(page):
            g = sum([gain[i] for i in f])
            if t:
                zero, one = a + m00 >= b + m10, a + m01 > b + m11
                back.append((not zero, not one))
                a, b = (a + m00 if zero else b + m10), (a + m01 if one else b + m11) + g
            else:
                b = g
        if not page:
            return []
        out = [int(b > a)]
        for from0, from1 in reversed(back):
            out.append(int(from1 if out[-1] else from0))
        return out[::-1]


def train(pages: list[list[list[int]]], labels: list[list[int]], epochs: int = 60, rate: float = 0.2, decay: float = 1e-3) -> Field:
    """The conditional log-likelihood's maximum, by Adam; forward and backward sums over all pages at once."""
    n, longest = len(pages), max(map(len, pages))
    x = np.zeros((n, longest, len(FEATURES)), np.float32)
    y, there = np.zeros((n, longest), int), np.zeros((n, longest), bool)
    for i, (p, own) in enumerate(zip(pages, labels)):
        for t, f in enumerate(p):
            x[i, t, f] = 1
        y[i, : len(p)], there[i, : len(p)] = own, True
    theta = np.zeros(2 * len(FEATURES) + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    onehot = np.eye(2)[y] * there[..., None]
    both = there[:, 1:] & there[:, :-1]
    seen = np.einsum("ita,itb->ab", onehot[:, :-1] * both[..., None], onehot[:, 1:])
    lse = lambda z, axis: np.logaddexp.reduce(z, axis=axis)
    for step in range(1, epochs + 1):
        emit, move = theta[:-4].reshape(-1, 2), theta[-4:].reshape(2, 2)
        e = (x @ emit) * there[..., None]
        fwd, bwd = np.zeros_like(e), np.zeros_like(e)
        fwd[:, 0] = e[:, 0]
        for t in range(1, longest):
            fwd[:, t] = np.where(there[:, t, None], lse(fwd[:, t - 1, :, None] + move, 1) + e[:, t], fwd[:, t - 1])
        for t in range(longest - 2, -1, -1):
            bwd[:, t] = np.where(there[:, t + 1, None], lse(move + (bwd[:, t + 1] + e[:, t + 1])[:, None, :], 2), 0)
        z = lse(fwd[:, -1], 1)
        p = np.exp(fwd + bwd - z[:, None, None]) * there[..., None]
        pair = np.exp(fwd[:, :-1, :, None] + move + (bwd[:, 1:] + e[:, 1:])[:, :, None, :] - z[:, None, None, None]) * both[..., None, None]
        g = np.concatenate((np.einsum("itf,ita->fa", x, p - onehot).ravel(), (pair.sum(axis=(0, 1)) - seen).ravel())) / n + decay * theta
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(theta[:-4].reshape(-1, 2), theta[-4:].reshape(2, 2))


def labelled_pages(n: int = 360, seed: int = 5) -> Iterator[tuple[str, list[str]]]:
    """(html, main blocks) of pages of many layouts."""
    rng = np.random.default_rng(seed)
    pick = lambda *xs: xs[int(rng.integers(len(xs)))]
    chance = lambda p: rng.random() < p
    syllables = "an er the on is re ti le ou ent lo ra mi sto ver gen ha".split()
    word = lambda: "".join(pick(*syllables) for _ in range(int(rng.integers(1, 4))))

    def sentence(low=4, high=24):
        out = [word() for _ in range(int(rng.integers(low, high)))]
        out = [w + "," if chance(0.08) else w for w in out]
        return " ".join(out).rstrip(",").capitalize() + "."

    def paragraph(odd):
        p = " ".join(sentence() for _ in range(int(rng.integers(1, 7))))
        if odd == "symbols":
            return " ".join(w + pick("###", "***", "%%%", "$$$") for w in p.split())
        if odd == "columns":
            return p.replace(" ", " | ")
        if odd == "bare":
            return p.rstrip(".")
        return p.upper() + "!!" if odd == "loud" else p

    def links(k):
        return "".join(f'<li><a href="/{word()}">{word()}</a></li>' for _ in range(k))

    def box(names, inner, tags=("div", "section", "aside")):
        return f'<{(t := pick(*tags))} {pick("class", "id")}="{pick(*names)}">{inner}</{t}>'

    for at in range(n):
        icons = "<svg class='i'/><svg-icon></svg-icon>" if at % 3 == 0 else ""
        title, main = sentence(2, 9), []
        body = []
        odd = pick("", "", "", "", "symbols", "columns", "bare", "loud")
        if chance(0.8):
            body.append(pick(f"<nav><ul>{links(6)}</ul></nav>", f'<div class="menu"><ul>{links(5)}</ul></div>', f"<header><a href='/'>{word()}</a><nav><ul>{links(4)}</ul></nav></header>", f'<div id="header"><p>{sentence(2, 6)}</p><ul class="nav">{links(4)}</ul></div>'))
        if chance(0.4):
            body.append(box(("cookie-notice", "consent", "notice", "alert", "gdpr-banner"), f"<p>{sentence()}</p><button>{word()}</button>", ("div", "aside", "section")))
        if chance(0.6):
            body.append(box(("ad", "ads", "advert", "ad-banner", "sponsored", "promo"), pick(sentence(), f"<p>{sentence()}</p>")))
        parts = []
        if chance(0.85):
            h = pick("h1", "h1", "h2")
            parts.append(pick(f"<{h}>{title}</{h}>", f"<header><{h}>{title}</{h}></header>" if chance(0.3) else f"<{h}>{title}</{h}>"))
            main.append(title)
        for _ in range(int(rng.integers(1, 12))):
            p = paragraph(odd) if chance(0.85) else sentence(1, 3)
            kind = rng.random()
            if kind < 0.75:
                parts.append(pick(f"<p>{p}</p>", f"<p>{p}</p>", f"<p><b>{p}<br>", f"<div>{p}</div>" if chance(0.2) else f"<p>{p}</p>", f"<p>{p}"))
            elif kind < 0.85:
                parts.append(f"<h2>{p}</h2>")
            elif kind < 0.93:
                parts.append(f"<ul><li>{p}</li></ul>")
            else:
                parts.append(f"<blockquote>{p}</blockquote>")
            main.append(p)
            if chance(0.08):
                parts.append(box(("ad", "advert", "related", "newsletter-signup", "share"), f"<p>{sentence()}</p>", ("div", "aside")))
        shell = pick(("<article>", "</article>"), ("<article>", "</article>"), ("<main><article>", "</article></main>"), ('<div class="content">', "</div>"), ('<div id="article-body">', "</div>"), ("<main>", "</main>"), ('<div class="post-entry">', "</div>"))
        if chance(0.15):  # cut short
            parts.append("<p>" + main[-1][: len(main[-1]) * 2 // 3].rstrip())
            main.append(parts[-1][3:])
            yield f"<html><head><title>{title}</title></head><body>" + "".join([*body, shell[0], *parts]), [" ".join(x.split()) for x in main]
            continue
        body.append(shell[0] + "".join(parts) + shell[1])
        if chance(0.4):
            body.append(box(("sidebar", "widget", "related", "popular"), f"<h3>{word()}</h3>" + pick(f"<ul>{links(4)}</ul>", f"<p>{sentence()}</p>"), ("aside", "div")))
        if chance(0.35):
            body.append(box(("comments", "comment-list", "discussion", "replies"), "".join(f"<div class='comment'><p>{sentence(3, 30)}</p></div>" for _ in range(int(rng.integers(1, 5)))), ("section", "div")))
        if chance(0.35):
            body.append(f"<form action='/'><label>{word()}</label><input name='q'><button>{word()}</button><p>{sentence()}</p></form>")
        if chance(0.85):
            body.append(pick(f"<footer>&copy; {word()}.example &middot; {sentence()}</footer>", f'<div class="footer"><p>{sentence()}</p><p>&copy; {word()}</p></div>', f"<footer><p>{sentence()}</p><ul>{links(3)}</ul></footer>"))
        if chance(0.15):
            body.insert(0, body.pop(int(rng.integers(len(body)))) if chance(0.2) else "")
        page = f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head><body>" + icons.join(body)
        yield page + ("</body></html>" if chance(0.9) else ""), main


@lru_cache(1)
def field() -> Field:
    pages, labels = [], []
    for html, main in labelled_pages():
        page, left, own = blocks(html), list(main), []
        for text, said, _, _ in page:
            hit = text in left and _ID["in:head"] not in said
            own.append(int(hit))
            if hit:
                left.remove(text)
        pages.append(features(page))
        labels.append(own)
    return train(pages, labels)


def main_text(html: str, crf: Field) -> str:
    page = blocks(html)
    return "\n".join([b[0] for b, label in zip(page, crf.decode(features(page))) if label])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each row of pages(page_id, url, html)."""
    crf = pages.sparkSession.sparkContext.broadcast(field())  # some kB
    rows = pages.select("page_id", "url", "html")

    def run(batches):
        use_worker("pages")
        for b in batches:
            text = [main_text(h, crf.value) if (h := x.as_py()) else "" for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string()), pa.array(list(map(len, text)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")
