"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is cut into leaf blocks, the runs of text between block elements, each with its ancestors' tags and names and with
features of its text. The field scores the sequence of labels (boilerplate, main text) by the features of each block and the
labels of neighbours, is trained on labelled pages by the gradient of its log-likelihood, and is decoded by Viterbi.

Labelled pages are made by `labelled_pages`: layouts with the main text in varying containers, among menus, headers, footers,
sidebars, notices, adverts, forms and comments, with unclosed elements now and then. Their words mean nothing, so the field
learns from structure and form, and a caller can train on pages of their own instead. A part of the pages says nothing by
names: their elements are plain and their classes made up, some in a table layout. There the field goes by the share of the
page's running text that stands in a block's container and by the neighbours.
"""

from __future__ import annotations

import html
import random
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGES = 400  # labelled pages for training
STEPS = 200
SEED = 20

# fixed values of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe".split())
UNSEEN = frozenset("template noscript svg math object canvas".split())  # what they hold is left out if they are closed
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot"
    " th thead tr ul".split()
)
ENDS_P = BLOCK - {"button", "option", "legend", "caption", "td", "th", "tr", "tbody", "thead", "tfoot"}
# an element that opens ends an open one of these, up to the nearest of the second set
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
_BOUNDS_P = {"table", "td", "th", "button", "div", "section", "article", "li", "body", "blockquote", "main", "aside", "footer", "header", "nav", "form"}
TAG = re.compile(r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*>|(/?)([a-zA-Z][a-zA-Z0-9:-]*+))", re.S)
# the rest of a tag: a quote opens a value after an equals sign only, and one without a partner is a plain character
ATTRIBUTES = re.compile(r"""((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>""")
UNQUOTED = re.compile(r"([^>]*+)>")
NAMES = re.compile(r"""(?:class|id|role|aria-label|itemprop|data-role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""display\s*:\s*none|visibility\s*:\s*hidden|(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true""", re.I)
PART = re.compile(r"[a-z]+")

# groups of parts of names, by what such elements usually are
GROUPS = {
    "ad": "ad ads adv advert adverts advertisement sponsor sponsored promo promotion promoted adsense dfp",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toc pager pagination tabs skip sitemap",
    "comment": "comment comments commentlist disqus reply replies respond discussion thread response responses",
    "side": "sidebar side aside widget widgets rail related recommended popular trending also",
    "foot": "footer foot copyright legal colophon bottom",
    "head": "header masthead topbar branding logo site",
    "notice": "cookie cookies consent gdpr notice alert notification modal popup overlay newsletter subscribe signup paywall banner message",
    "share": "share sharing social follow tags tag meta byline",
    "form": "form search login contact input field",
    "main": "content article post entry story main body text prose page",
}
_GROUP = {word: group for group, words in GROUPS.items() for word in words.split()}
# what holds parts of a page; lists, rows and inline elements belong to the one around them
CONTAINERS = frozenset("article aside body center dialog div footer form header main nav section td".split())
_ANCESTORS = "nav header footer aside form article main section ul ol table blockquote figure dialog menu button select details pre dl".split()


class Block(NamedTuple):
    text: str
    tag: str
    ancestors: frozenset  # those of `_ANCESTORS`
    groups: frozenset  # of names of ancestors
    own: frozenset  # of names of the nearest two named ancestors
    linked: int  # characters inside links
    hidden: bool
    container: int = 0  # number of the element that holds the block's own element


def _groups(attributes: str) -> frozenset:
    if "=" not in attributes:
        return frozenset()
    parts = (p for m in NAMES.finditer(attributes) for p in PART.findall((m[1] or m[2] or m[3] or "").lower()))
    return frozenset(_GROUP[p] for p in parts if p in _GROUP)


class _Open:
    """Open elements, with what blocks ask of them counted as they come and go, so that depth costs nothing."""

    def __init__(self):
        self.stack: list[tuple[str, frozenset, bool, tuple | None]] = []  # name, groups, hidden, what to go back to
        self.places: dict[str, list[int]] = {}  # in the stack, by name
        self.blocks: list[int] = []
        self.unseen: list[int] = []
        self.named: list[frozenset] = []
        self.groups = dict.fromkeys(GROUPS, 0)
        self.hidden = 0
        self.containers: list[tuple[int, int]] = []  # place and number
        self.number = 0

    def push(self, name: str, groups: frozenset, hidden: bool, before: tuple | None) -> None:
        at = len(self.stack)
        self.stack.append((name, groups, hidden, before))
        self.places.setdefault(name, []).append(at)
        if name in BLOCK:
            self.blocks.append(at)
        if name in CONTAINERS:
            self.number += 1
            self.containers.append((at, self.number))
        if name in UNSEEN:
            self.unseen.append(at)
        if groups:
            self.named.append(groups)
            for g in groups:
                self.groups[g] += 1
        self.hidden += hidden

    def cut(self, at: int) -> None:
        """Closes the element at a place and all inside it."""
        while len(self.stack) > at:
            name, groups, hidden, _ = self.stack.pop()
            self.places[name].pop()
            if name in BLOCK:
                self.blocks.pop()
            if name in CONTAINERS:
                self.containers.pop()
            if name in UNSEEN:
                self.unseen.pop()
            if groups:
                self.named.pop()
                for g in groups:
                    self.groups[g] -= 1
            self.hidden -= hidden

    def last(self, name: str) -> int:
        places = self.places.get(name)
        return places[-1] if places else -1

    def end(self, names: set, within: set) -> None:
        """Closes the open elements of some names, up to the nearest one that bounds them."""
        at = max(map(self.last, names))
        if at >= 0:
            bound = max(self.unseen[-1] if self.unseen else -1, *map(self.last, within))
            while at > bound:
                self.cut(at)
                at = max(map(self.last, names))

    def block(self, text: str, linked: int) -> Block:
        tag = self.stack[self.blocks[-1]][0] if self.blocks else ""
        ancestors = frozenset(t for t in _ANCESTORS if self.places.get(t))
        groups = frozenset(g for g, n in self.groups.items() if n)
        own = self.blocks[-1] if self.blocks else -1
        container = next((number for at, number in reversed(self.containers[-2:]) if at < own), 0)
        return Block(text, tag, ancestors, groups, frozenset().union(*self.named[-2:]), min(linked, len(text)), self.hidden > 0, container)


def blocks_of(page: str) -> list[Block]:
    """Leaf blocks in page order. What has no end tag ends with its parent; an end tag without a start is passed over."""
    out: list[Block] = []
    opened = _Open()
    parts: list[str] = []
    linked, links, at = 0, 0, 0
    rest_of_tag = ATTRIBUTES

    def flush() -> None:
        nonlocal linked, parts
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(opened.block(text, linked))
            parts = []  # an open element may hold the list it began in
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            text = html.unescape(text) if "&" in text else text
            parts.append(text)
            if links:
                linked += len(text.strip())

    while m := TAG.search(page, at):
        add(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        found = rest_of_tag.match(page, at)
        if not found and rest_of_tag is ATTRIBUTES:  # quotes hide each end up to the last: from here on they are plain
            rest_of_tag = UNQUOTED
            found = rest_of_tag.match(page, at)
        if not found:
            at = m.start()
            break
        attributes, at = found[1], found.end()
        name = m[2].lower()
        if name in BLOCK:
            flush()
            links = 0 if name != "a" else links
        if m[1]:
            if name == "a":
                links = 0
            place = opened.last(name)
            inline = name not in BLOCK and name not in UNSEEN
            if place >= 0 and not (inline and opened.blocks and opened.blocks[-1] > place):  # an inline end tag does not end a block
                if before := opened.stack[place][3]:
                    n_out, parts, n_parts, linked, links = before
                    del out[n_out:], parts[n_parts:]
                opened.cut(place)
            continue
        if name in RAW:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{name}\s*[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if name in VOID:
            if name == "br":
                parts.append(" ")
            continue
        if name in ENDS_P:
            opened.end({"p"}, _BOUNDS_P)
        if name in ENDS:
            opened.end(*ENDS[name])
        if name == "a":
            links = 1
        if not attributes.endswith("/") or (name not in BLOCK and name not in UNSEEN):
            before = (len(out), parts, len(parts), linked, links) if name in UNSEEN else None
            opened.push(name, _groups(attributes), bool(attributes) and bool(HIDDEN.search(attributes)), before)
    add(page[at:])
    flush()
    return out


_CUES = {
    "copyright": re.compile(r"[©®]|copyright|all rights reserved", re.I),
    "ask": re.compile(r"\b(?:cookies?|subscribe|sign (?:in|up)|log ?in|newsletter|advertisement|sponsored|privacy policy|terms of)\b", re.I),
    "talk": re.compile(r"\b(?:repl(?:y|ies)|comments?|posted by|says?:|likes?)\b", re.I),
}
_LAST = re.compile(r"""[.!?…]["'”’)]*$""")


def features_of(blocks: list[Block]) -> list[list[str]]:
    """Names of the features that each block has: its own, those of its place in the page, and its neighbours' size and links."""
    out = []
    counts = [b.text.count(" ") + 1 for b in blocks]
    size = [0 if n < 3 else 1 if n < 6 else 2 if n < 12 else 3 if n < 30 else 4 for n in counts]
    shares = [b.linked / len(b.text) for b in blocks]
    link = [0 if s == 0 else 1 if s < 0.3 else 2 if s < 0.7 else 3 for s in shares]
    running = [n if n >= 6 and s < 0.3 and b.tag not in ("footer", "form", "button", "option") else 0 for b, n, s in zip(blocks, counts, shares)]
    total = sum(running) or 1
    held: dict[int, int] = {}
    for b, n in zip(blocks, running):
        held[b.container] = held.get(b.container, 0) + n
    most = max(held.values(), default=0)
    seen = talked = False
    for i, b in enumerate(blocks):
        f = ["any", f"tag {b.tag}"]
        f += [f"in {t}" for t in _ANCESTORS if t in b.ancestors]
        f += [f"named {g}" for g in b.groups] + [f"near {g}" for g in b.own]
        f += [f"words {size[i]}", f"links {link[i]}"]
        f += [f"prev {size[i - 1]} {link[i - 1]}"] if i else []
        f += [f"next {size[i + 1]} {link[i + 1]}"] if i + 1 < len(blocks) else []
        own = held[b.container]
        f.append(f"holds {min(4, 5 * own // total)}")
        if own and own == most:
            f.append("holds most")
        f.append(f"place {min(2, i)}")
        f.append(f"left {min(2, len(blocks) - 1 - i)}")
        if _LAST.search(b.text):
            f.append("sentence")
        cues = [name for name, cue in _CUES.items() if counts[i] < 40 and cue.search(b.text)]
        f += [f"cue {name}" for name in cues]
        talked = talked or ("talk" in cues and counts[i] < 6)
        if talked:
            f.append("after talk")
        if b.hidden:
            f.append("hidden")
        seen = seen or b.tag == "h1"
        f.append("after h1" if seen else "before h1")
        out.append(f)
    return out


class Field(NamedTuple):
    """Weights of a trained field; a few hundred numbers."""

    names: dict[str, int]
    weight: np.ndarray  # feature x label
    step: np.ndarray  # label x next label

    def decode(self, blocks: list[Block]) -> list[int]:
        """The best labels by Viterbi; of equal ones the smaller label."""
        if not blocks:
            return []
        rows = [[self.names[f] for f in fs if f in self.names] for fs in features_of(blocks)]
        best, back = self.weight[rows[0]].sum(axis=0), []
        for r in rows[1:]:
            ways = best[:, None] + self.step
            back.append(ways.argmax(axis=0))
            best = ways.max(axis=0) + self.weight[r].sum(axis=0)
        label = int(best.argmax())
        out = [label]
        for b in reversed(back):
            label = int(b[label])
            out.append(label)
        return out[::-1]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(pages: list[tuple[list[Block], list[int]]], steps: int = STEPS, ridge: float = 0.02) -> Field:
    """Maximum likelihood with a ridge penalty, by Adam over all pages at once."""
    pages = sorted((p for p in pages if p[0]), key=lambda p: -len(p[0]))
    named = [features_of(blocks) for blocks, _ in pages]
    names = {f: i for i, f in enumerate(sorted({f for page in named for fs in page for f in fs}))}
    longest, n = max((len(p) for p in named), default=0), len(pages)
    x = np.zeros((longest, n, len(names)), np.float32)
    y, on = np.zeros((longest, n), int), np.zeros((longest, n), bool)
    for p, (page, (_, labels)) in enumerate(zip(named, pages)):
        for t, fs in enumerate(page):
            x[t, p, [names[f] for f in fs]] = 1
        y[: len(page), p], on[: len(page), p] = labels, True
    flat, eye = x.reshape(-1, len(names)), np.eye(2)
    theta = np.zeros(len(names) * 2 + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    gold = np.where(on[..., None], eye[y], 0)
    gold_step = sum((gold[t].T @ gold[t + 1] for t in range(longest - 1)), np.zeros((2, 2)))
    gold_weight = flat.T @ gold.reshape(-1, 2)
    for k in range(1, steps + 1 if n else 1):
        weight, step = theta[:-4].reshape(-1, 2), theta[-4:].reshape(2, 2)
        score = (flat @ weight.astype(np.float32)).reshape(longest, n, 2)
        forward = [score[0]]
        for t in range(1, longest):
            new = _log_sum(forward[-1][:, :, None] + step, 1) + score[t]
            forward.append(np.where(on[t][:, None], new, forward[-1]))
        total = _log_sum(forward[-1], 1)
        backward = [np.zeros((n, 2))]
        for t in range(longest - 2, -1, -1):
            new = _log_sum(step + (score[t + 1] + backward[-1])[:, None, :], 2)
            backward.append(np.where(on[t + 1][:, None], new, 0))
        backward = backward[::-1]
        want_step = np.zeros((2, 2))
        chance = np.zeros((longest, n, 2))
        for t in range(longest):
            chance[t] = np.exp(forward[t] + backward[t] - total[:, None]) * on[t][:, None]
            if t + 1 < longest:
                pair = forward[t][:, :, None] + step + (score[t + 1] + backward[t + 1])[:, None, :] - total[:, None, None]
                want_step += (np.exp(pair) * on[t + 1][:, None, None]).sum(axis=0)
        slope = np.concatenate(((gold_weight - flat.T @ chance.reshape(-1, 2).astype(np.float32)).ravel(), (gold_step - want_step).ravel())) - ridge * n / 10 * theta
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        theta += 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return Field(names, theta[:-4].reshape(-1, 2), theta[-4:].reshape(2, 2))


MARK = "\x02"  # starts the main text's blocks in a labelled page; taken out when labels are read


def labelled_pages(n: int = PAGES, seed: int = SEED) -> list[tuple[list[Block], list[int]]]:
    """Pages of random layout with the label of each leaf block."""
    r = random.Random(seed)
    syllables = "ra lo mi ten sor ba ke un vi dal por eth ing sa no ster qui le an to".split()

    def words(low: int, high: int) -> list[str]:
        return ["".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(r.randint(low, high))]

    def sentence(low: int = 1, high: int = 60) -> str:
        w = words(low, high)
        return " ".join(w).capitalize() + r.choice([".", ".", ".", "", "!", "?", ","])

    def links(low: int, high: int, item: str = "li") -> str:
        return "".join(f'<{item}><a href="/x">{" ".join(words(1, 3))}</a></{item}>' for _ in range(r.randint(low, high)))

    def boxed(inner: str, tags: str, names: str) -> str:
        tag, kind = r.choice(tags.split()), r.choice(["class", "id"])
        return f'<{tag} {kind}="{r.choice(names.split())}">{inner}</{tag}>'

    def menu() -> str:
        inner = f"<ul>{links(2, 9)}</ul>" if r.random() < 0.7 else links(2, 9, "span")
        return f"<nav>{inner}</nav>" if r.random() < 0.6 else boxed(inner, "div nav ul", "menu main-nav navbar breadcrumb site-navigation top-menu")

    def header() -> str:
        inner = r.choice([f"<h1>{' '.join(words(1, 4))}</h1>", f"<p>{sentence(2, 8)}</p>", f'<a href="/">{" ".join(words(1, 2))}</a>']) + (menu() if r.random() < 0.5 else "")
        return f"<header>{inner}</header>" if r.random() < 0.6 else boxed(inner, "div", "header masthead site-header topbar branding")

    def footer() -> str:
        inner = r.choice(["&copy; ", "Copyright 2020 ", "", "&#169; "]) + sentence(1, 25) + (f"<p>{sentence(3, 30)}</p>" if r.random() < 0.3 else "") + (f"<ul>{links(1, 4)}</ul>" if r.random() < 0.3 else "")
        return f"<footer>{inner}</footer>" if r.random() < 0.65 else boxed(inner, "div section", "footer site-footer copyright legal bottom")

    def advert() -> str:
        return boxed(r.choice([sentence(2, 30), f"<p>{sentence(3, 40)}</p>", f'<a href="/b">{sentence(2, 12)}</a>']), "div div p aside section", "ad ads advert ad-slot sponsored promo advertisement ad_top")

    def notice() -> str:
        text = r.choice([sentence(3, 30), "We use cookies. " + sentence(2, 15), "Subscribe to our newsletter " + sentence(1, 6)])
        return boxed(f"{text}<button>{' '.join(words(1, 2))}</button>" if r.random() < 0.5 else f"<p>{text}</p>", "div section aside dialog", "cookie-notice consent alert notice popup newsletter banner gdpr modal")

    def form() -> str:
        return f'<form action="/s"><label>{" ".join(words(1, 3))}</label><input name="q"><button>{" ".join(words(1, 2))}</button>{f"<p>{sentence(3, 15)}</p>" if r.random() < 0.4 else ""}</form>'

    def side() -> str:
        inner = f"<h3>{' '.join(words(1, 4))}</h3>" + r.choice([f"<ul>{links(2, 6)}</ul>", f"<p>{sentence(4, 40)}</p>", f"<div>{sentence(4, 30)}</div>"])
        return f"<aside>{inner}</aside>" if r.random() < 0.5 else boxed(inner, "div section", "sidebar related widget side-rail popular recommended share social")

    def comments() -> str:
        one = [f"<p>{sentence(3, 60)}</p>", f"<li>{sentence(3, 40)}</li>", f"<div><b>{words(1, 1)[0]}</b> {sentence(3, 40)}</div>", f'<article class="comment"><p>{sentence(3, 40)}</p></article>']
        inner = (f"<h3>{r.randint(1, 40)} comments</h3>" if r.random() < 0.5 else "") + "".join(r.choice(one) for _ in range(r.randint(1, 5)))
        return boxed(inner, "div section ol", "comments comment-list discussion responses disqus_thread replies")

    def main() -> str:
        out = [f"<h1>{MARK}{' '.join(words(2, 14))}</h1>"] if r.random() < 0.85 else []
        for _ in range(r.choice([1, 1, 2, 3, 4, 6, 9, 14])):
            text = MARK + (sentence(1, 4) if r.random() < 0.25 else sentence(4, 90))
            if r.random() < 0.15:
                text += f' <a href="/l">{" ".join(words(1, 5))}</a> {sentence(1, 20)}'
            kind = r.random()
            if kind < 0.62:
                out.append(f"<p>{text}</p>" if r.random() < 0.8 else f"<p><b>{text}<br>" if r.random() < 0.5 else f"<p>{text}")
            elif kind < 0.7:
                out.append(f"<h{r.randint(2, 4)}>{MARK}{' '.join(words(1, 8))}</h{2}>".replace("</h2>", "") + f"<p>{text}</p>")
            elif kind < 0.78:
                out.append(f"<ul>{''.join(f'<li>{MARK}{sentence(1, 25)}</li>' for _ in range(r.randint(1, 5)))}</ul>")
            elif kind < 0.84:
                out.append(f"<blockquote>{text}</blockquote>")
            elif kind < 0.88:
                out.append(f"<table>{''.join(f'<tr><td>{MARK}{sentence(1, 4)}</td><td>{MARK}{sentence(1, 9)}</td></tr>' for _ in range(r.randint(1, 4)))}</table>")
            elif kind < 0.92:
                out.append(f"<pre>{text}</pre>")
            else:
                out.append(f"<div>{text}</div>")
            if r.random() < 0.06:
                out.append(r.choice([advert, form, notice, side])())
        body = "".join(out)
        kind = r.random()
        if kind < 0.55:
            return f"<article>{body}</article>"
        if kind < 0.7:
            return f"<main>{body}</main>"
        if kind < 0.95:
            return boxed(body, "div div section", "content post entry-content article-body story main-text page-body")
        return f"<div>{body}</div>"

    def unnamed(page: str) -> str:
        """The page with plain elements, and with names that mean nothing or none."""
        known: dict[str, str] = {}
        drop = r.random() < 0.3

        def name(m: re.Match) -> str:
            return "" if drop else f' {m[1]}="{known.setdefault(m[2], "".join(r.choice("bcdfgkmqrvxz") for _ in range(6)))}"'

        page = re.sub(r"<(/?)(?:article|main|nav|aside|header|footer|section|dialog)\b", r"<\1div", page)
        return re.sub(r' (class|id)="([^"]*)"', name, page)

    pages = []
    for _ in range(n):
        top = [f() for f, chance in ((notice, 0.2), (header, 0.5), (menu, 0.7), (form, 0.15), (advert, 0.5), (side, 0.15)) if r.random() < chance]
        end = [f() for f, chance in ((advert, 0.2), (comments, 0.35), (side, 0.3), (form, 0.15), (notice, 0.1), (footer, 0.85)) if r.random() < chance]
        body = f"{''.join(top)}{main()}{''.join(end)}"
        if r.random() < 0.3:
            cells = r.random() < 0.25
            body = unnamed(f"<table><tr><td>{''.join(top)}</td><td>{main()}</td></tr><tr><td>{''.join(end)}</td></tr></table>" if cells else body)
        page = f"<html><head><title>{sentence(2, 8)}</title></head><body>{body}" + ("</body></html>" if r.random() < 0.8 else "")
        blocks = blocks_of(page)
        pages.append(([b._replace(text=b.text.replace(MARK, "")) for b in blocks], [int(MARK in b.text) for b in blocks]))
    return pages


def main_text(field: Field, page: str) -> str:
    """Blocks of the main text, joined by a line end."""
    blocks = blocks_of(page)
    return "\n".join(b.text for b, label in zip(blocks, field.decode(blocks)) if label)


def extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every page row; a null or empty page has an empty text.

    Row by row without an exchange, so repeated rows and ties have no effect; other columns are not read.
    """
    field = field or train(labelled_pages())
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches):
        for batch in batches:
            texts = [main_text(field, p) if p else "" for p in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=schema)

    read = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return read.mapInArrow(run, "page_id long, url string, text string, n_chars long")
