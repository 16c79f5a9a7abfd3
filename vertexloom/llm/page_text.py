"""Main text of web pages: a recurrent labeller over the leaf blocks of a page.

A page becomes the sequence of its leaf blocks, each with the path of tags it stands in
and its words. Both are hashed into learned vectors, a bidirectional LSTM reads the whole
sequence, and each block is kept or not with the page around it in view. The labeller is
trained once, on a bounded sample of pages whose own tags tell article from surroundings,
and on rewrites of these pages in other layouts.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vertexloom.llm.common import small_batches

SAMPLE_PAGES, SAMPLE_CHARS, REWRITES = 60, 40_000, 6
TAG_SLOTS, WORD_SLOTS, DEPTH, HIDDEN, NUMBERS = 1_024, 512, 20, 16, 5
EPOCHS, TRAIN_BLOCKS = 6, 80
PAGES_AT_ONCE, BLOCKS_AT_ONCE, STEPS_AT_ONCE = 128, 16_384, 2_048

# Fixed values of the language: what starts a block, what has no content, what holds no text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p "
    "pre section select summary table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
TEXTLESS_TAGS = frozenset("script style title textarea noscript template iframe svg object".split())
CLOSED_BY_ITS_LIKE = frozenset("li p dt dd tr td th option".split())
# What marks surroundings, by tag or by a word of class, id or role.
OUTSIDE_TAGS = frozenset("nav header footer aside form dialog menu select button".split())
OUTSIDE_WORDS = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie disqus footer header "
    "login masthead menu modal nav navbar navigation newsletter notice popup promo related reply respond search "
    "share sidebar social sponsor sponsored subscribe widget".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:\"[^\"]*+\"|'[^']*+'|[^>\"']++)*+)(?:>|\Z|[\"'][^>]*+>?)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"(class|id|role|data-keep|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


@dataclass
class Element:
    tag: str
    words: tuple[str, ...] = ()
    keep: str | None = None


@dataclass
class Leaf:
    text: str
    path: tuple[Element, ...]
    linked: float = 0.0
    keep: bool | None = None
    features: tuple = field(default=())


def _element(tag: str, attributes: str) -> Element:
    words, keep = [], None
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
        if name == "data-keep":
            keep = value
        elif name in ("hidden", "aria-hidden"):
            words += ["hidden"] if value.lower() != "false" else []
        else:
            words += [w.lower() for w in _WORD.findall(value)]
    return Element(tag, tuple(words), keep)


def leaves(page: str | None) -> list[Leaf]:
    """Leaf blocks in page order: text with white space as single spaces, and its path of elements."""
    source = page or ""
    stack: list[Element] = []
    found: list[Leaf] = []
    parts: list[str] = []
    linked, spoken = 0, False
    place: tuple[Element, ...] = ()

    def flush() -> None:
        nonlocal linked, spoken
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            marks = [e.keep for e in place if e.keep is not None]
            found.append(Leaf(text, place, min(1.0, linked / len(text)), marks[-1] == "1" if marks else None))
        parts.clear()
        linked, spoken = 0, False

    def say(text: str) -> None:
        nonlocal place, linked, spoken
        if text:
            if not spoken:
                place = tuple(stack)
            own = len(text.strip())
            spoken = spoken or own > 0
            parts.append(text)
            if any(e.tag == "a" for e in stack):
                linked += own

    at = 0
    while at < len(source):
        m = _TOKEN.search(source, at)
        if m is None:
            say(source[at:])
            break
        say(source[at : m.start()])
        at = m.end()
        if m.group(2) is None:
            continue
        tag = m.group(2).lower()
        if m.group(1):
            if tag in BLOCK_TAGS:
                flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if tag not in BLOCK_TAGS and stack[i].tag in BLOCK_TAGS:
                    break
        elif tag in TEXTLESS_TAGS:
            # An element of another language may close itself; one of those that hold
            # elements and never ends hides nothing behind it.
            if tag == "svg" and m.group(3).endswith("/"):
                continue
            close = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(source, at)
            at = close.end() if close else at if tag in ("svg", "object") else len(source)
        elif tag == "br":
            say(" ")
        elif tag in VOID_TAGS:
            if tag in BLOCK_TAGS:
                flush()
        else:
            if tag in BLOCK_TAGS:
                flush()
                # An inline element left open ends with the block that holds it.
                while stack and (stack[-1].tag not in BLOCK_TAGS or stack[-1].tag == "p"):
                    stack.pop()
                if tag in CLOSED_BY_ITS_LIKE and stack and stack[-1].tag == tag:
                    stack.pop()
            if not m.group(3).endswith("/"):
                stack.append(_element(tag, m.group(3)))
    flush()
    return found


def features(blocks: list[Leaf]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Hashed path tokens, hashed words and a few numbers of every block."""
    tags, words = [], []
    numbers = np.zeros((len(blocks), NUMBERS), np.float32)
    for i, b in enumerate(blocks):
        names = [f"in {e.tag}" for e in b.path] + [f"at {e.tag}" for e in b.path[-1:]]
        names += [f"word {w}" for e in b.path for w in e.words]
        tags.append(np.array([zlib.crc32(n.encode()) % TAG_SLOTS for n in dict.fromkeys(names)], np.int64))
        text = b.text.encode("utf-8", "replace").lower().split()
        words.append(np.array([zlib.crc32(w) % WORD_SLOTS for w in text], np.int64))
        ends = sum(b.text.count(c) for c in ".,;:!?")
        numbers[i] = (np.log1p(len(text)) / 4, b.linked, min(1, ends / (1 + len(text))), i / len(blocks), np.log1p(len(b.path)) / 3)
    return tags, words, numbers


class Labeller:
    """Block vectors, a bidirectional LSTM and a logistic output; trained by Adam."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        norm = lambda *shape, scale=0.1: rng.normal(0, scale, shape).astype(np.float32)
        self.weights = {
            "tags": norm(TAG_SLOTS, DEPTH, scale=0.3),
            "words": norm(WORD_SLOTS, DEPTH),
            "numbers": norm(NUMBERS, DEPTH),
            "out": norm(2 * HIDDEN),
            "bias": np.zeros(1, np.float32),
        }
        for side in "fb":
            self.weights[f"{side}x"] = norm(DEPTH, 4 * HIDDEN, scale=0.25)
            self.weights[f"{side}h"] = norm(HIDDEN, 4 * HIDDEN, scale=0.25)
            self.weights[f"{side}c"] = np.repeat(np.array([0, 1, 0, 0], np.float32), HIDDEN)

    def vectors(self, page: tuple) -> np.ndarray:
        tags, words, numbers = page
        out = numbers @ self.weights["numbers"]
        for i, (t, w) in enumerate(zip(tags, words, strict=True)):
            if len(t):
                out[i] += self.weights["tags"][t].sum(axis=0)
            if len(w):
                out[i] += self.weights["words"][w].mean(axis=0)
        return np.tanh(out)

    def _run(self, side: str, x: np.ndarray, mask: np.ndarray, keep: list | None):
        w, steps, pages = self.weights, x.shape[0], x.shape[1]
        h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
        out = np.zeros((steps, pages, HIDDEN), np.float32)
        into, stretch = None, -1
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            if t // STEPS_AT_ONCE != stretch:
                stretch = t // STEPS_AT_ONCE
                into = x[stretch * STEPS_AT_ONCE : (stretch + 1) * STEPS_AT_ONCE] @ w[f"{side}x"] + w[f"{side}c"]
            z = into[t % STEPS_AT_ONCE] + h @ w[f"{side}h"]
            gates = 1 / (1 + np.exp(-z[:, : 3 * HIDDEN]))
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g, m = np.tanh(z[:, 3 * HIDDEN :]), mask[t][:, None]
            before_h, before_c = h, c
            c = m * (f * c + i * g)
            tc = np.tanh(c)
            h = m * (o * tc)
            out[t] = h
            if keep is not None:
                keep.append((t, i, f, o, g, tc, before_h, before_c, m))
        return out

    def _padded(self, pages: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        steps = max(len(p[0]) for p in pages)
        x, mask = np.zeros((steps, len(pages), DEPTH), np.float32), np.zeros((steps, len(pages)), np.float32)
        for k, p in enumerate(pages):
            x[: len(p[0]), k] = self.vectors(p)
            mask[: len(p[0]), k] = 1
        return x, mask

    def scores(self, pages: list[tuple]) -> list[np.ndarray]:
        """Probability of every block, by page."""
        if not pages:
            return []
        x, mask = self._padded(pages)
        h = np.concatenate([self._run("f", x, mask, None), self._run("b", x, mask, None)], axis=2)
        p = 1 / (1 + np.exp(-(h @ self.weights["out"] + self.weights["bias"][0])))
        return [p[: len(page[0]), k] for k, page in enumerate(pages)]

    def gradients(self, pages: list[tuple], labels: list[np.ndarray]) -> dict[str, np.ndarray]:
        w = self.weights
        x, mask = self._padded(pages)
        saved: dict[str, list] = {"f": [], "b": []}
        h = np.concatenate([self._run(s, x, mask, saved[s]) for s in "fb"], axis=2)
        y = np.zeros(mask.shape, np.float32)
        for k, label in enumerate(labels):
            y[: len(label), k] = label
        error = mask * (1 / (1 + np.exp(-(h @ w["out"] + w["bias"][0]))) - y) / mask.sum()
        grads = {k: np.zeros_like(v) for k, v in w.items()}
        grads["out"], grads["bias"] = np.einsum("tp,tph->h", error, h), np.array([error.sum()], np.float32)
        to_x = np.zeros_like(x)
        for s, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
            later_h, later_c = np.zeros((x.shape[1], HIDDEN), np.float32), np.zeros((x.shape[1], HIDDEN), np.float32)
            for t, i, f, o, g, tc, before_h, before_c, m in reversed(saved[s]):
                dh = m * (error[t][:, None] * w["out"][part] + later_h)
                dc = m * (dh * o * (1 - tc**2) + later_c)
                dz = np.concatenate(
                    [dc * g * i * (1 - i), dc * before_c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g**2)], axis=1
                )
                grads[f"{s}x"] += x[t].T @ dz
                grads[f"{s}h"] += before_h.T @ dz
                grads[f"{s}c"] += dz.sum(axis=0)
                to_x[t] += dz @ w[f"{s}x"].T
                later_h, later_c = dz @ w[f"{s}h"].T, dc * f
        to_x *= 1 - x**2
        for k, (tags, words, numbers) in enumerate(pages):
            back = to_x[: len(tags), k]
            grads["numbers"] += numbers.T @ back
            for i, (t, v) in enumerate(zip(tags, words, strict=True)):
                np.add.at(grads["tags"], t, back[i])
                if len(v):
                    np.add.at(grads["words"], v, back[i] / len(v))
        return grads

    def fit(self, pages: list[tuple], labels: list[np.ndarray], epochs: int = EPOCHS, seed: int = 3) -> Labeller:
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(pages))
            for start in range(0, len(order), 16):
                picked = order[start : start + 16]
                step += 1
                grads = self.gradients([pages[i] for i in picked], [labels[i] for i in picked])
                for k, g in grads.items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
                    self.weights[k] = self.weights[k] - (0.02 * (1 - epoch / epochs) * move).astype(np.float32)
        return self


def tags_say(block: Leaf) -> bool | None:
    """Whether the page's own tags put a block in the article; None if they name no article."""
    if block.keep is not None:
        return block.keep
    outside = any(e.tag in OUTSIDE_TAGS or OUTSIDE_WORDS & {*e.words} or "hidden" in e.words for e in block.path)
    return not outside and any(e.tag in ("article", "main") or "main" in e.words for e in block.path)


_ARTICLES = ("article", "main", 'div class="content"', 'div class="post-body"', 'section id="main-content"', 'div class="entry-content"', 'div class="article story"', 'div id="article-body"')
_AROUND = {
    "menu": ("nav", 'div class="menu"', 'div id="navbar"', 'ul class="nav"', 'div class="breadcrumbs"', "menu"),
    "header": ("header", 'div id="header"', 'div class="masthead"', 'div class="site-header"'),
    "footer": ("footer", 'div id="footer"', 'div class="site-footer"'),
    "side": ("aside", 'div class="sidebar"', 'div class="related"', 'section class="widget"', 'div id="side-bar"'),
    "notice": ('div class="notice"', 'div class="cookie-banner"', 'div id="consent"', "dialog", 'div class="popup"', 'p class="notice"'),
    "advert": ('div class="ad"', 'div class="ads"', 'div class="advert"', 'section class="sponsored"', 'div class="promo"', 'p class="ad"'),
    "form": ("form", 'form class="search"', 'form id="newsletter"', 'div class="login"'),
    "comments": ('section class="comments"', 'div id="comments"', 'div class="comment"', 'ul class="comment-list"', 'div class="disqus"'),
}


def rewritten(sentences: list[str], rng: np.random.Generator) -> str:
    """A page in a random layout with random sentences; ``data-keep`` tells what is article."""

    def some(low: int, high: int) -> list[str]:
        return [html.escape(sentences[i]) for i in rng.integers(0, len(sentences), rng.integers(low, high + 1))]

    def block(opening: str, inner: str, keep: int) -> str:
        return f'<{opening} data-keep="{keep}">{inner}</{opening.split()[0]}>'

    def around(kind: str) -> str:
        opening = _AROUND[kind][rng.integers(len(_AROUND[kind]))]
        if kind == "menu":
            inner = "".join(f'<li><a href="/">{t[:14]}</a></li>' for t in some(3, 7))
        elif kind == "form":
            inner = "".join(f"<label>{t[:20]}</label><input>" for t in some(1, 3)) + f"<button>{some(1, 1)[0][:10]}</button>"
        elif kind == "comments" and opening.startswith(("section", "ul")):
            inner = "".join(f'<div class="comment"><p>{t}</p></div>' for t in some(1, 4))
        elif opening.startswith("p "):
            inner = some(1, 1)[0]
        else:
            inner = "".join(f"<p>{t}</p>" for t in some(1, 3)) if rng.random() < 0.6 else some(1, 1)[0]
        return block(opening, inner, 0)

    body = [f"<h1>{some(1, 1)[0]}</h1>"]
    for t in some(2, 16):
        shape = rng.random()
        body.append(f"<p>{t}</p>" if shape < 0.75 else f"<h2>{t[:40]}</h2>" if shape < 0.85 else f"<ul><li>{t}</li></ul>" if shape < 0.95 else f"<blockquote>{t}</blockquote>")
    for kind in ("advert", "notice", "side", "form"):
        if rng.random() < 0.2:
            body.insert(int(rng.integers(1, len(body) + 1)), around(kind))
    if rng.random() < 0.2:
        body.append(around("comments"))
    article = block(_ARTICLES[rng.integers(len(_ARTICLES))], "".join(body), 1)
    before = [around(k) for k in ("menu", "header", "notice", "advert", "side", "form") if rng.random() < 0.5]
    after = [around(k) for k in ("side", "comments", "advert", "form", "footer") if rng.random() < 0.5]
    inner = "".join([*before, article, *after])
    wrap = rng.random()
    return f'<body>{inner}</body>' if wrap < 0.5 else f'<body><div id="page"><div class="container">{inner}</div></div></body>'


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Labeller:
    """A labeller from at most ``sample_pages`` pages of up to ``SAMPLE_CHARS`` code points.

    They are those with the smallest hashes that name their article by a tag. Texts of
    rewrites come from them; without any, from made-up words, so that there always is a
    trained labeller.
    """
    fit = F.col("html").isNotNull() & (F.char_length("html") <= SAMPLE_CHARS) & F.lower("html").rlike("<(article|main)\\b")
    # A thin pass picks them by hash, then only those are fetched.
    able = pages.where(fit).select(F.xxhash64("html").alias("h"), "html")
    picked = [r["h"] for r in able.select("h").distinct().orderBy("h").limit(sample_pages).collect()]
    rows = able.where(F.col("h").isin(picked)).groupBy("h").agg(F.min("html").alias("html")).collect() if picked else []
    rows.sort(key=lambda r: r["h"])
    rng = np.random.default_rng(5)
    parsed = [leaves(r["html"]) for r in rows]
    sentences = [b.text for p in parsed for b in p][:2_000]
    syllables = "ka to re mi su no la ven dor thi est al".split()
    while len(sentences) < 50:
        words = ["".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(rng.integers(3, 25))]
        sentences.append(" ".join(words).capitalize() + ".")
    for _ in range(max(REWRITES * len(parsed), 240)):
        parsed.append(leaves(rewritten(sentences, rng)))
    parsed = [p[:TRAIN_BLOCKS] for p in parsed if p]
    labels = [np.array([float(bool(tags_say(b))) for b in p], np.float32) for p in parsed]
    return Labeller().fit([features(p) for p in parsed], labels)


def main_text(labeller: Labeller, pages: list[str | None]) -> list[str]:
    """Kept blocks of each page, one per line."""
    parsed = [leaves(p) for p in pages]
    order = sorted((i for i, p in enumerate(parsed) if p), key=lambda i: len(parsed[i]))
    texts = [""] * len(pages)
    start = 0
    while start < len(order):
        # Pages of a group are padded to its longest, so a long page goes with few others or alone.
        stop = start + 1
        while stop < min(len(order), start + PAGES_AT_ONCE) and (stop + 1 - start) * len(parsed[order[stop]]) <= BLOCKS_AT_ONCE:
            stop += 1
        picked, start = order[start:stop], stop
        for i, score in zip(picked, labeller.scores([features(parsed[i]) for i in picked]), strict=True):
            texts[i] = "\n".join(b.text for b, s in zip(parsed[i], score, strict=True) if s >= 0.5)
    return texts


def extract(pages: DataFrame, labeller: Labeller | None = None) -> DataFrame:
    """``row`` (the page without its html) and the ``text`` of every row of ``pages``.

    A page without blocks to keep, null or empty, has the empty text. Repeated rows are
    worked out one by one; extra columns travel inside ``row``.
    """
    small_batches(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast((labeller or train(pages)).weights)

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Labeller()
        own.weights = shared.value
        for batch in batches:
            yield pd.Series(main_text(own, batch.tolist()), dtype=object)

    rest = F.struct(*[pages[c] for c in pages.columns if c.lower() != "html"])
    return pages.select(rest.alias("row"), text(F.col("html")).alias("text"))
