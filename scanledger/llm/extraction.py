"""The main text of web pages, by a recurrent labeller of their blocks.

Every leaf block of a page becomes a vector: the mean vector of the hashed
elements around it, the mean vector of its hashed words, and its shape.  A
bidirectional LSTM reads the sequence of blocks both ways, so each block is
judged with all of the page before and behind it, and a logistic unit says
whether it belongs to the article.

The labeller is fitted to a bounded sample of the given pages.  Their blocks
are laid out anew in many designs whose regions are known by construction; pages
of the sample with a single ``article`` element count with their own layout, too.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanledger.llm.common import narrow, text_slices
from scanledger.llm.pages import PATHS, WORDS, path_ids, read_blocks, shape, word_ids

#: Pages of the sample, blocks and words of each that may come into new designs, and how many of these are made.
MOST_PAGES, MOST_BLOCKS, MOST_WORDS, DESIGNS = 200, 60, 60, 1500
#: Sizes of the path and word vectors, of the shape, and of the state in each direction.
PATH_SIZE, WORD_SIZE, SHAPE_SIZE, STATE = 24, 8, 6, 24
STEPS, BATCH, RATE = 600, 32, 0.01
#: While it is fitted, the parts of blocks that show their words, and of elements that are seen.
SEEN_WORDS, SEEN_PATHS = 0.5, 0.9
#: A block from this probability on is part of the article.
LIKELY = 0.5

#: Names of regions, by what they hold: element, class or id words.
ARTICLE = [
    "article", "article class=post", "main", "div class=content", "div id=content", "div class=post-content", "div class=entry-content", "div class=article-body",
    "section class=story", "div id=main", "div class=main-content", "div class=text", "td class=content", "div class=page-body", "section class=article", "div role=main",
    "div class=post", "div id=article", "div class=body", "article itemprop=articleBody", "div class=story-body", "div class=prose",
]
INNER = ["div", "section", "div class=wrapper", "div class=inner", "div class=row", "div class=col", "section class=part", "div class=paragraph", "div class=container"]
MENU = ["nav", "div class=nav", "div id=menu", "div class=menu", "div class=navbar", "div id=navigation", "div class=breadcrumb", "div class=breadcrumbs", "div class=pagination", "div class=toc", "nav class=pager", "div class=tabs", "menu", "div class=skip-links", "div class=site-nav", "ul class=main-menu"]
HEADER = ["header", "div id=header", "div class=header", "div class=masthead", "header class=site-header", "div class=topbar", "div class=logo", "div class=banner"]
FOOTER = ["footer", "div id=footer", "div class=footer", "div class=copyright", "footer class=site-footer", "div class=colophon", "div class=legal", "div class=bottom"]
SIDEBAR = ["aside", "div class=sidebar", "div id=sidebar", "aside class=sidebar", "div class=related", "section class=related-posts", "div class=recommended", "div class=widget", "div class=popular", "div class=trending", "div class=right-column", "div class=side", "div class=tags", "div class=teaser", "div class=more-stories"]
NOTICE = ["div class=notice", "div class=cookie-banner", "div class=cookie-notice", "div id=cookies", "div class=alert", "div role=alert", "div class=consent", "div class=gdpr", "div class=popup", "div class=modal", "div class=message", "noscript", "p class=notice", "div class=warning", "div class=disclaimer", "div class=paywall", "section class=notice", "div class=notification", "dialog", "div class=privacy", "div role=dialog", "div class=toast", "div class=cookie-bar", "div class=infobox"]
ADVERT = ["div class=ad", "div class=ads", "div class=advert", "div class=advertisement", "div class=sponsored", "div class=promo", "aside class=ad", "div class=ad-slot", "div id=ad", "section class=sponsor", "p class=ad", "div class=adsbox", "div class=promotion", "div class=commercial", "div class=adbox", "div class=sponsored-content"]
FORM = ["form", "form class=search", "form class=newsletter", "div class=search", "div class=login", "div class=newsletter", "div class=subscribe", "form id=signup", "form class=contact", "fieldset"]
COMMENTS = ["section class=comments", "div id=comments", "div class=comments", "ol class=commentlist", "div class=comment-list", "div class=replies", "div class=discussion", "div class=reader-comments", "section id=comments", "div class=responses", "div id=disqus-thread", "ul class=comments", "div class=reviews", "div class=user-comments", "section class=comment-thread", "div id=respond"]
COMMENT = ["div class=comment", "article class=comment", "li class=comment", "div class=comment-body", "div class=reply", "p", "div", "li", "blockquote class=comment"]
SHARE = ["div class=share", "ul class=social", "div class=social-links", "div class=sharing", "div class=buttons", "div class=follow"]
#: Words that names of classes have besides.
EXTRA = ["box", "wrap", "area", "block", "list", "inner", "container", "section", "unit", "top", "bottom", "left", "right", "new", "v"]
#: What such regions say besides the prose of the pages.
SAYINGS = {
    "menu": ["Home", "About", "Contact", "News", "Sport", "Start", "Accueil", "Inicio", "Next page", "Back", "Login"],
    "notice": ["We use cookies.", "Please enable JavaScript.", "Accept all", "This site uses cookies to improve your experience.", "Sign in to read on"],
    "advert": ["Advertisement", "Sponsored", "Buy now", "Special offer!", "Anzeige", "Publicité"],
    "form": ["Search", "Subscribe", "Your e-mail", "Name", "Send", "Password", "Submit"],
    "footer": ["© 2024 All rights reserved.", "Imprint", "Privacy policy", "Terms of use"],
    "sidebar": ["Related articles", "Most read", "Popular", "Latest", "See also", "Tags"],
    "comments": ["Comments", "3 comments", "Reply", "Leave a comment", "Posted by anna", "2 days ago", "Like"],
    "share": ["Share", "Tweet", "Follow us", "Print", "E-mail this"],
}


class Example(NamedTuple):
    """A page's blocks as features, and the label of each."""

    paths: list[list[int]]
    words: list[list[int]]
    shapes: list[list[float]]
    labels: list[bool]


def features(page: str | None) -> tuple[list[str], Example]:
    """Texts and features of a page's blocks, without labels."""
    blocks = read_blocks(page)
    return [b.text for b in blocks], Example([path_ids(b.path) for b in blocks], [word_ids(b.text) for b in blocks], [shape(b, i, len(blocks)) for i, b in enumerate(blocks)], [])


class Designer:
    """Lays given prose out as pages whose regions are known."""

    def __init__(self, prose: list[str], seed: int = 1):
        self.random = np.random.default_rng(seed)
        self.prose = prose or ["word and word", "some more words, for once.", "nothing here"]

    def chance(self, p: float) -> bool:
        return bool(self.random.random() < p)

    def one(self, names: list[str]) -> str:
        return names[int(self.random.integers(len(names)))]

    def words(self, most: int) -> str:
        found = self.one(self.prose).split()
        return " ".join(found[: int(self.random.integers(1, most + 1))])

    def tag(self, name: str, inside: str) -> str:
        element, *attributes = name.split()
        if element == "p" and BLOCKS_INSIDE.search(inside):
            # A paragraph ends where a block begins.
            element = "div"
        more = f"-{self.one(EXTRA)}" if self.chance(0.25) else ""
        listed = " ".join('{}="{}{}"'.format(*a.split("="), more if a[:2] in ("cl", "id") else "") for a in attributes)
        if self.chance(0.1):
            listed += f' data-x="{self.random.integers(99)}"'
        return f"<{element}{' ' + listed if listed else ''}>{inside}</{element}>"

    def say(self, kind: str, most: int) -> str:
        return html.escape(self.one(SAYINGS[kind]) if self.chance(0.35) else self.words(most))

    def line(self, text: str, label: bool) -> str:
        # The label stands in the text, in characters that no page has there, until the page is read.
        return f"{YES if label else NO}{text}"

    def links(self, kind: str) -> str:
        count = int(self.random.integers(1, 9))
        items = [f'<a href="/{i}">{self.line(self.say(kind, 3), False)}</a>' for i in range(count)]
        if self.chance(0.7):
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return "".join(f"<{e}>{x}</{e}>" for e in [self.one(["div", "p", "span"])] for x in items)

    def lines(self, kind: str, most: int, count: int) -> str:
        element = self.one(["p", "p", "div", "li", ""])
        said = [self.line(self.say(kind, most), False) for _ in range(count if element else 1)]
        if self.chance(0.2):
            said[0] = self.line(self.say(kind, 6), False)
            return f"<h3>{said[0]}</h3>" + "".join(f"<p>{x}</p>" for x in said[1:])
        return "".join(f"<{element}>{x}</{element}>" if element else x for x in said)

    def region(self, kind: str) -> str:
        count = int(self.random.integers(1, 4))
        if kind == "menu":
            return self.tag(self.one(MENU), self.links("menu"))
        if kind == "header":
            name = self.line(self.say("menu", 4), False)
            return self.tag(self.one(HEADER), self.one([f"<h1>{name}</h1>", f"<p>{name}</p>", f'<a href="/">{name}</a>', name]) + (self.links("menu") if self.chance(0.3) else ""))
        if kind == "footer":
            return self.tag(self.one(FOOTER), self.lines("footer", 25, count) if self.chance(0.7) else self.links("footer"))
        if kind == "sidebar":
            head = f"<h3>{self.line(self.say('sidebar', 4), False)}</h3>" if self.chance(0.5) else ""
            return self.tag(self.one(SIDEBAR), head + (self.links("sidebar") if self.chance(0.5) else self.lines("sidebar", 30, count)))
        if kind == "notice":
            return self.tag(self.one(NOTICE), self.lines("notice", 30, count if self.chance(0.3) else 1) + (f"<button>{self.line('OK', False)}</button>" if self.chance(0.3) else ""))
        if kind == "advert":
            return ("<!-- ad -->" if self.chance(0.3) else "") + self.tag(self.one(ADVERT), self.lines("advert", 30, 1))
        if kind == "form":
            label, send = self.line(self.say("form", 4), False), self.line(self.say("form", 2), False)
            return self.tag(self.one(FORM), self.one([f"<label>{label}</label><input><button>{send}</button>", f"<p>{label}</p><input>", f"{label}<input>", f"<select><option>{label}<option>{send}</select>", self.lines("form", 15, 2)]))
        if kind == "share":
            return self.tag(self.one(SHARE), self.links("share"))
        comment = self.one(COMMENT)
        said = []
        for _ in range(int(self.random.integers(1, 6))):
            by = f"<h4>{self.line(self.say('comments', 3), False)}</h4>" if self.chance(0.4) else ""
            said.append(self.tag(comment, by + (f"<p>{self.line(self.say('comments', 60), False)}</p>" if self.chance(0.6) else self.line(self.say("comments", 60), False))))
        head = f"<h2>{self.line(self.say('comments', 3), False)}</h2>" if self.chance(0.5) else ""
        return self.tag(self.one(COMMENTS), head + "".join(said))

    def own(self, most: int = MOST_WORDS) -> str:
        text = html.escape(self.words(most))
        if self.chance(0.15):
            first, *rest = text.split()
            text = self.one([f"<b>{first}</b>", f'<a href="#">{first}</a>', f"<em>{first}</em>"]) + " " + " ".join(rest)
        return self.line(text, True)

    def paragraph(self, style: str) -> str:
        kind = self.random.random()
        if style == "div":
            return f"<div>{self.own()}</div>"
        if kind < 0.72:
            if self.chance(0.15):
                return f"<p><b>{self.own()}.<br>"
            return f"<p>{self.own()}</p>" if self.chance(0.9) else f"<p>{self.own()}"
        if kind < 0.8:
            return f"<h2>{self.own(8)}</h2>"
        if kind < 0.88:
            items = "".join(f"<li>{self.own(12)}</li>" for _ in range(int(self.random.integers(1, 6))))
            return self.one([f"<ul>{items}</ul>", f"<ol>{items}</ol>"])
        if kind < 0.93:
            return self.one([f"<blockquote><p>{self.own()}</p></blockquote>", f"<blockquote>{self.own()}</blockquote>"])
        if kind < 0.96:
            return "<table>" + "".join(f"<tr><td>{self.own(6)}</td><td>{self.own(6)}</td></tr>" for _ in range(int(self.random.integers(1, 4)))) + "</table>"
        return self.one([f"<pre>{self.own(20)}</pre>", f"<figure><img><figcaption>{self.own(15)}</figcaption></figure>", f"<dl><dt>{self.own(4)}<dd>{self.own(20)}</dl>", f"<h3>{self.own(8)}</h3>"])

    def article(self) -> str:
        count = int(1 + self.random.integers(0, 1 + int(self.random.integers(1, 25))))
        style = "div" if self.chance(0.1) else ""
        body = [self.paragraph(style) for _ in range(count)]
        if self.chance(0.35):
            for kind in self.random.choice(["advert", "notice", "sidebar", "share", "form", "menu"], size=int(self.random.integers(1, 3))):
                body.insert(int(self.random.integers(len(body) + 1)), self.region(str(kind)))
        if self.chance(0.7):
            title = f"<h1>{self.own(12)}</h1>"
            body.insert(0, f"<header>{title}</header>" if self.chance(0.15) else title)
        inside = "".join(body)
        if self.chance(0.25):
            inside = self.tag(self.one(INNER), inside)
        if self.chance(0.12):
            inside += self.region("comments")
        return self.tag(self.one(ARTICLE) if self.chance(0.93) else "div", inside)

    def page(self) -> str:
        before = [k for k, p in [("notice", 0.25), ("header", 0.4), ("menu", 0.7), ("form", 0.15), ("advert", 0.5), ("notice", 0.2), ("sidebar", 0.2)] if self.chance(p)]
        after = [k for k, p in [("share", 0.2), ("advert", 0.25), ("sidebar", 0.35), ("comments", 0.4), ("form", 0.2), ("notice", 0.15), ("menu", 0.1), ("footer", 0.75), ("notice", 0.1)] if self.chance(p)]
        if self.chance(0.3):
            self.random.shuffle(before)
        middle = [self.article(), *map(self.region, after)]
        if self.chance(0.2):
            middle = [self.tag(self.one(INNER), "".join(middle))]
        return f"<!DOCTYPE html><html><head><title>{self.words(8)}</title><style>p{{}}</style></head><body>" + "".join([*map(self.region, before), *middle]) + "</body></html>"


BLOCKS_INSIDE = re.compile("<(p|div|li|ul|h[1-6])[ >]")
#: Private characters that carry the label of a designed block.
YES, NO = "\ue000", "\ue001"


def designed_example(page: str) -> Example:
    """Features and labels of a page whose blocks begin with their label."""
    kept, labels = [], []
    for block in read_blocks(page):
        text = " ".join(block.text.replace(YES, "").replace(NO, "").split())
        if text:
            kept.append(block._replace(text=text, linked=min(len(text), max(0, block.linked - 1))))
            labels.append(YES in block.text)
    return Example([path_ids(b.path) for b in kept], [word_ids(b.text) for b in kept], [shape(b, i, len(kept)) for i, b in enumerate(kept)], labels)


def _positions(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all rows behind each other, the row of each, and one over the size of its row."""
    sizes = np.array([len(r) for r in rows], dtype=np.int64)
    row = np.repeat(np.arange(len(rows)), sizes)
    flat = np.fromiter((i for r in rows for i in r), np.int64, int(sizes.sum()))
    return flat, row, (1 / np.maximum(sizes, 1)).astype(np.float32)[row]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """A bidirectional LSTM over block vectors with a logistic unit, in numpy."""

    def __init__(self, seed: int = 1):
        random = np.random.default_rng(seed)
        size = PATH_SIZE + WORD_SIZE + SHAPE_SIZE
        normal = lambda *shape_, scale: (random.normal(size=shape_) * scale).astype(np.float32)
        self.weights = {
            "path": normal(PATHS, PATH_SIZE, scale=0.5),
            "word": normal(WORDS, WORD_SIZE, scale=0.2),
            "input": normal(2, size, 4 * STATE, scale=1 / np.sqrt(size)),
            "state": normal(2, STATE, 4 * STATE, scale=1 / np.sqrt(STATE)),
            "bias": np.zeros((2, 1, 4 * STATE), np.float32),
            "out": normal(2 * STATE + size, scale=0.1),
            "base": np.zeros(1, np.float32),
        }
        self.weights["bias"][:, :, STATE : 2 * STATE] = 1.0

    def vectors(self, pages: list[Example]) -> tuple[np.ndarray, tuple]:
        """One vector for each block of all pages, and what its gradient needs."""
        paths = _positions([p for e in pages for p in e.paths])
        words = _positions([w for e in pages for w in e.words])
        shapes = np.array([s for e in pages for s in e.shapes], dtype=np.float32).reshape(-1, SHAPE_SIZE)
        x = np.zeros((len(shapes), PATH_SIZE + WORD_SIZE + SHAPE_SIZE), np.float32)
        for (flat, row, part), name, at in ((paths, "path", 0), (words, "word", PATH_SIZE)):
            table = self.weights[name]
            if len(flat):
                first = np.flatnonzero(np.concatenate([[True], np.diff(row) != 0]))
                x[row[first], at : at + table.shape[1]] = np.add.reduceat(table[flat] * part[:, None], first)
        x[:, PATH_SIZE + WORD_SIZE :] = shapes
        return x, (paths, words)

    def forward(self, x: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, dict]:
        """The logit of each block; pages of ``sizes`` blocks lie behind each other in ``x``."""
        w = self.weights
        count, longest = len(sizes), int(sizes.max())
        page = np.repeat(np.arange(count), sizes)
        place = np.arange(len(x)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        # The second direction reads each page from its last block on; both are padded behind their end.
        places = np.stack([place, sizes[page] - 1 - place])
        inputs = np.zeros((longest, 2, count, x.shape[1]), np.float32)
        for d in (0, 1):
            inputs[places[d], d, page] = x
        gates = np.empty((longest, 2, count, 4 * STATE), np.float32)
        cells, states = (np.zeros((longest + 1, 2, count, STATE), np.float32) for _ in range(2))
        for t in range(longest):
            g = np.matmul(inputs[t], w["input"]) + np.matmul(states[t], w["state"]) + w["bias"]
            g[..., : 3 * STATE] = _sigmoid(g[..., : 3 * STATE])
            g[..., 3 * STATE :] = np.tanh(g[..., 3 * STATE :])
            gates[t] = g
            cells[t + 1] = g[..., STATE : 2 * STATE] * cells[t] + g[..., :STATE] * g[..., 3 * STATE :]
            states[t + 1] = g[..., 2 * STATE : 3 * STATE] * np.tanh(cells[t + 1])
        seen = np.concatenate([states[places[0] + 1, 0, page], states[places[1] + 1, 1, page], x], axis=1)
        return seen @ w["out"] + w["base"][0], {"inputs": inputs, "gates": gates, "cells": cells, "states": states, "places": places, "page": page, "seen": seen}

    def gradients(self, x: np.ndarray, found: tuple, kept: dict, error: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of all weights, given the derivative of the loss by each logit."""
        w, out = self.weights, {}
        places, page = kept["places"], kept["page"]
        out["out"], out["base"] = kept["seen"].T @ error, error.sum(keepdims=True)
        back = error[:, None] * w["out"]
        by_x = back[:, 2 * STATE :].copy()
        inputs, gates, cells, states = (kept[k] for k in ("inputs", "gates", "cells", "states"))
        longest = len(inputs)
        by_state = np.zeros_like(states)
        for d in (0, 1):
            by_state[places[d] + 1, d, page] = back[:, d * STATE : (d + 1) * STATE]
        by_gates = np.zeros_like(gates)
        by_cell = np.zeros_like(cells[0])
        carried = np.zeros_like(cells[0])
        turned = w["state"].transpose(0, 2, 1)
        for t in range(longest - 1, -1, -1):
            g = gates[t]
            i, f, o, c = (g[..., k * STATE : (k + 1) * STATE] for k in range(4))
            bent = np.tanh(cells[t + 1])
            by_h = by_state[t + 1] + carried
            by_cell = by_cell + by_h * o * (1 - bent * bent)
            b = by_gates[t]
            b[..., :STATE] = by_cell * c * i * (1 - i)
            b[..., STATE : 2 * STATE] = by_cell * cells[t] * f * (1 - f)
            b[..., 2 * STATE : 3 * STATE] = by_h * bent * o * (1 - o)
            b[..., 3 * STATE :] = by_cell * i * (1 - c * c)
            carried = np.matmul(b, turned)
            by_cell = by_cell * f
        flat = lambda a, d: a[:, d].reshape(-1, a.shape[-1])
        out["input"] = np.stack([flat(inputs, d).T @ flat(by_gates, d) for d in (0, 1)])
        out["state"] = np.stack([flat(states[:-1], d).T @ flat(by_gates, d) for d in (0, 1)])
        out["bias"] = by_gates.sum(axis=(0, 2))[:, None, :]
        for d in (0, 1):
            by_x += by_gates[places[d], d, page] @ w["input"][d].T
        for (rows, row, part), name, at in ((found[0], "path", 0), (found[1], "word", PATH_SIZE)):
            out[name] = np.zeros_like(w[name])
            np.add.at(out[name], rows, by_x[row, at : at + w[name].shape[1]] * part[:, None])
        return out

    def fit(self, pages: list[Example], steps: int = STEPS, seed: int = 1) -> Labeller:
        """Weights by Adam steps on the cross entropy of the labels."""
        pages = [e for e in pages if e.labels]
        if not pages:
            return self
        random = np.random.default_rng(seed)
        mean, square = ({k: np.zeros_like(v) for k, v in self.weights.items()} for _ in range(2))
        for step in range(1, steps + 1):
            chosen = [pages[i] for i in random.integers(len(pages), size=BATCH)]
            # Prose differs from corpus to corpus: words are hidden from half of the blocks, and some of the elements from all.
            shown = [e._replace(words=[w if random.random() < SEEN_WORDS else [] for w in e.words], paths=[[i for i in p if random.random() < SEEN_PATHS] for p in e.paths]) for e in chosen]
            x, found = self.vectors(shown)
            logits, kept = self.forward(x, np.array([len(e.labels) for e in chosen]))
            labels = np.array([y for e in chosen for y in e.labels], dtype=np.float32)
            error = ((_sigmoid(logits) - labels) / len(labels)).astype(np.float32)
            rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
            for name, g in self.gradients(x, found, kept, error).items():
                mean[name] = 0.9 * mean[name] + 0.1 * g
                square[name] = 0.99 * square[name] + 0.01 * g * g
                self.weights[name] = self.weights[name] - rate * (mean[name] / (1 - 0.9**step)) / (np.sqrt(square[name] / (1 - 0.99**step)) + 1e-8)
        return self

    def probabilities(self, pages: list[Example]) -> list[np.ndarray]:
        """How likely each block belongs to the article, page by page; pages of like length are read together."""
        sizes = np.array([len(e.paths) for e in pages], dtype=np.int64)
        out = [np.zeros(0, np.float32) for _ in pages]
        order = np.argsort(sizes, kind="stable")
        order = order[sizes[order] > 0]
        start = 0
        while start < len(order):
            stop = start + 1
            while stop < len(order) and stop - start < 256 and (stop - start + 1) * sizes[order[stop]] <= 1 << 13:
                stop += 1
            group = order[start:stop]
            x, _ = self.vectors([pages[i] for i in group])
            found = _sigmoid(self.forward(x, sizes[group])[0])
            for i, part in zip(group, np.split(found, np.cumsum(sizes[group])[:-1]), strict=True):
                out[i] = part
            start = stop
        return out


SAMPLE = "texts array<string>, paths array<array<int>>, words array<array<int>>, shapes array<array<float>>, labels array<boolean>"


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each page its first blocks, cut to some words, and the features of all blocks if one ``article`` tells their labels."""
    schema = pa.schema([("texts", pa.list_(pa.string())), *((n, pa.list_(pa.list_(pa.int32()))) for n in ("paths", "words")), ("shapes", pa.list_(pa.list_(pa.float32()))), ("labels", pa.list_(pa.bool_()))])
    for batch in batches:
        rows = []
        for page in batch.column("html").to_pylist():
            blocks = read_blocks(page)
            texts = [" ".join(b.text.split()[:MOST_WORDS]) for b in blocks[:MOST_BLOCKS]]
            row = {"texts": texts, "paths": [], "words": [], "shapes": [], "labels": []}
            if (page or "").lower().count("<article") == 1 and len(blocks) <= 10 * MOST_BLOCKS:
                _, e = features(page)
                apart = {"nav", "aside", "form", "footer"}
                labels = [any(x.split()[0] == "article" for x in b.path) and not any(x.split()[0] in apart for x in b.path) for b in blocks]
                row |= {"paths": e.paths, "words": e.words, "shapes": e.shapes, "labels": labels}
            rows.append(row)
        yield pa.RecordBatch.from_pylist(rows, schema)


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", most: int = MOST_PAGES) -> Labeller:
    """A labeller from at most ``most`` pages, those with the smallest hashes of their ids.

    Of each page at most ``MOST_BLOCKS`` blocks of ``MOST_WORDS`` words come to
    the driver, and features of at most ten times as many.  Pages without an id
    are not looked at, of a repeated id one is; an empty table gives a labeller
    of the designs alone.
    """
    known = narrow(pages, page_id=id_col, html=html_col).where("page_id IS NOT NULL")
    chosen = known.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(most)
    sample = known.join(F.broadcast(chosen), "page_id").groupBy("page_id").agg(F.min("html").alias("html")).orderBy("page_id")
    rows = sample.select("html").mapInArrow(_sampled, SAMPLE).collect()
    prose = [t for r in rows for t in r.texts]
    designer = Designer(prose)
    designed = [designed_example(designer.page()) for _ in range(DESIGNS)]
    own = [Example(r.paths, r.words, r.shapes, list(r.labels)) for r in rows if r.labels]
    return Labeller().fit(designed + own)


EXTRACTED = "page_id long, url string, text string, n_chars long"


def extract_text(pages: DataFrame, labeller: Labeller, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The main text of every whole page: page_id, url, text, n_chars.

    One row for each row of ``pages``, repeated rows and null ids and urls
    included.  A page without an article, an empty or a null one has an empty
    text.  Blocks stand in page order, one a line; other columns are not looked at.
    """
    sent = pages.sparkSession.sparkContext.broadcast(labeller)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "html"):
            read = [features(page) for page in batch.column("html").to_pylist()]
            likely = sent.value.probabilities([e for _, e in read])
            texts = ["\n".join(t for t, p in zip(blocks, ps.tolist(), strict=True) if p >= LIKELY) for (blocks, _), ps in zip(read, likely, strict=True)]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("page_id").cast(pa.int64()), batch.column("url"), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])

    return narrow(pages, page_id=id_col, url=url_col, html=html_col).mapInArrow(run, EXTRACTED)
