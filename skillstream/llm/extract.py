"""Operator 8: the main text of web pages by boosted trees over DOM nodes.

Every block element and run of text gets features (subtree density, names in
its attributes and its ancestors', depth, siblings). Gradient-boosted trees,
trained in numpy, give the chance that a node holds article text. Decoding
takes the most likely labelling of the whole tree in which no node below a
rejected one is kept, so ancestors and descendants never contradict.

There are no labelled pages, so the trees learn from layouts: paragraphs of a
bounded sample of the pages, of any length, are laid out in varied ways, with
menus, notices, adverts, side bars, forms, footers and reader comments around
and inside them, and labels known by construction. Built-in words take their
place if the sampled pages hold no text.

Edge cases: null or empty html has no text; broken markup is read as browsers
do, near enough; repeated rows give equal results; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship
from .dom import Page, features

#: Pages whose paragraphs are laid out for training, the most characters of text from one of them, and of a piece of a longer text.
SAMPLE, SAMPLE_CHARS, PIECE_CHARS = 60, 50_000, 2_000
#: Words to lay out if the sampled pages hold none.
PLAIN = ("the a of and to in on for with from by at as it is was that this one two many new first last old small large day year city river "
         "house people work water light market school story road garden paper winter number music letter morning office friend report").split()
LAYOUTS = 900
TREES, DEPTH, RATE, BINS = 80, 4, 0.25, 32


# --- layouts to learn from -------------------------------------------------------------------------------------------

def _layout(rng: random.Random, pool: list[str]) -> tuple[str, set[str]]:
    """A page, and the marks of its article runs: every run of text begins with a mark of its own."""
    kept: set[str] = set()
    n = [0]

    def say(article: bool, low: int = 3, high: int = 60, link: bool = False) -> str:
        n[0] += 1
        mark = f"q{n[0]}z"
        if article:
            kept.add(mark)
        words = rng.choice(pool).split()
        size = min(len(words), rng.randint(low, high))
        at = rng.randint(0, len(words) - size)
        text = html.escape(" ".join(words[at:at + size]))
        return f'<a href="/x">{mark} {text}</a>' if link else f"{mark} {text}"

    def named(tag: str, inside: str, *names: str) -> str:
        name = rng.choice(names) if names else ""
        attr = "" if not name else f' class="{name}"' if rng.random() < 0.7 else f' id="{name}"'
        return f"<{tag}{attr}>{inside}</{tag}>"

    def items(count: int, tag: str = "ul") -> str:
        return f"<{tag}>" + "".join(f"<li>{say(False, 1, 5, True)}</li>" for _ in range(count)) + f"</{tag}>"

    def paragraph() -> str:
        r = rng.random()
        if r < 0.1:
            return f"<p><b>{say(True, 2, 70)}</b></p>"
        if r < 0.2:
            return f"<p><b>{say(True, 1, 70)}<br>"  # never closed
        if r < 0.3:
            return f"<p>{say(True, 1, 6)}"
        if r < 0.4:
            return f"<p>{say(True, 1, 5)}</p>"
        return f"<p>{say(True, 2, 120)}</p>"

    def inner() -> str:
        r = rng.random()
        if r < 0.62:
            return paragraph()
        if r < 0.68:
            return f"<h{(k := rng.randint(2, 4))}>{say(True, 1, 9)}</h{k}>"
        if r < 0.73:
            tag = rng.choice(["ul", "ol"])
            return f"<{tag}>" + "".join(f"<li>{say(True, 2, 20)}</li>" for _ in range(rng.randint(1, 6))) + f"</{tag}>"
        if r < 0.76:
            return f"<blockquote>{paragraph() if rng.random() < .5 else say(True)}</blockquote>"
        if r < 0.78:
            return "<table>" + "".join("<tr>" + "".join(f"<td>{say(True, 1, 4)}</td>" for _ in range(3)) + "</tr>" for _ in range(3)) + "</table>"
        if r < 0.80:
            return f"<pre>{say(True, 3, 30)}</pre>"
        if r < 0.82:
            return f"<figure><img src=x><figcaption>{say(True, 2, 12)}</figcaption></figure>"
        if r < 0.88:
            return advert()
        if r < 0.91:
            return named(rng.choice(["div", "aside"]), items(rng.randint(1, 4)), "related", "related-posts", "more-stories", "recommended", "share", "social-share")
        if r < 0.93:
            return named("div", say(False, 1, 8), "share-buttons", "social", "post-tags", "tools")
        if r < 0.95:
            return form()
        if r < 0.96:
            return notice()
        return f"<div>{say(True, 3, 60)}</div>"

    def advert() -> str:
        text = say(False, 2, 25) if rng.random() < 0.6 else say(False, 2, 10, True) + say(False, 2, 10)
        return named(rng.choice(["div", "div", "aside", "section", "p"]), text, "ad", "ads", "advert", "ad-slot", "advertisement", "sponsored", "promo", "banner-ad")

    def notice() -> str:
        inside = rng.choice([say(False, 4, 40), f"<p>{say(False, 4, 40)}</p><button>{say(False, 1, 2)}</button>", f"<p>{say(False, 4, 30)}</p>"])
        return named(rng.choice(["div", "section", "aside"]), inside, "cookie-notice", "cookie-banner", "consent", "notice", "gdpr", "alert", "notification", "popup")

    def form() -> str:
        inside = f"<label>{say(False, 1, 4)}</label><input name=a><button>{say(False, 1, 2)}</button>"
        if rng.random() < 0.4:
            inside = f"<p>{say(False, 3, 25)}</p>" + inside
        if rng.random() < 0.2:
            inside += "<select>" + "".join(f"<option>{say(False, 1, 2)}</option>" for _ in range(3)) + "</select>"
        return named("form", inside, "", "newsletter", "search", "login", "subscribe", "contact") if rng.random() < 0.8 else named("div", f"<p>{say(False, 3, 20)}</p>", "newsletter", "subscribe", "signup")

    def comments() -> str:
        body = ""
        for _ in range(rng.randint(1, 6)):
            one = (f"<b>{say(False, 1, 2)}</b>" if rng.random() < 0.5 else "") + (f"<p>{say(False, 3, 90)}</p>" if rng.random() < 0.8 else say(False, 3, 40))
            body += named(rng.choice(["div", "li", "article", "section"]), one, "comment", "comment-body", "reply", "comment", "")
        if rng.random() < 0.6:
            body = f"<h{(k := rng.randint(2, 4))}>{say(False, 1, 3)}</h{k}>" + body
        if rng.random() < 0.3:
            body += form()
        return named(rng.choice(["section", "div", "aside", "ol"]), body, "comments", "comment-list", "disqus_thread", "reader-comments", "discussion", "responses comments", "replies")

    def side() -> str:
        body = rng.choice([items(rng.randint(2, 8)), f"<h3>{say(False, 1, 4)}</h3>{items(rng.randint(2, 6))}", f"<h3>{say(False, 1, 4)}</h3><p>{say(False, 3, 50)}</p>", f"<p>{say(False, 3, 50)}</p>", say(False, 3, 30)])
        return named("aside", body, "", "sidebar", "related") if rng.random() < 0.5 else named("div", body, "sidebar", "side-bar", "widget", "widget-area", "right-rail")

    def top() -> str:
        out = ""
        if rng.random() < 0.5:
            inside = rng.choice([say(False, 1, 5), f"<h1>{say(False, 1, 4)}</h1>", f"<h1>{say(False, 1, 4)}</h1><p>{say(False, 2, 15)}</p>", f"<p>{say(False, 2, 20)}</p>"])
            if rng.random() < 0.4:
                inside += "<nav>" + items(rng.randint(2, 8)) + "</nav>"
            out += named("header", inside, "", "site-header", "masthead") if rng.random() < 0.7 else named("div", inside, "header", "masthead", "site-header", "topbar")
        if rng.random() < 0.75:
            inside = items(rng.randint(2, 10)) if rng.random() < 0.7 else "".join(say(False, 1, 3, True) for _ in range(rng.randint(2, 8)))
            out += named("nav", inside, "", "", "main-nav") if rng.random() < 0.7 else named(rng.choice(["div", "ul"]), inside, "menu", "nav", "navbar", "navigation", "breadcrumb")
        return out

    def bottom() -> str:
        inside = rng.choice([f"&copy; {say(False, 2, 15)}", f"<p>{say(False, 2, 20)}</p>", items(rng.randint(1, 6)), f"<p>{say(False, 2, 30)}</p>{items(3)}"])
        return named("footer", inside, "", "", "site-footer") if rng.random() < 0.75 else named("div", inside, "footer", "site-footer", "copyright", "legal")

    story = (f"<h1>{say(True, 1, 10)}</h1>" if rng.random() < 0.8 else "") + "".join(inner() for _ in range(rng.choice([1, 2, 4, 8, 14, 22])))
    if rng.random() < 0.15:
        story = named("header", f"<h1>{say(True, 2, 10)}</h1>") + story
    if rng.random() < 0.25:
        story += comments()
    kind = rng.random()
    if kind < 0.5:
        story = named("article", story, "", "", "post", "story")
    elif kind < 0.65:
        story = named("main", story, "", "content")
    elif kind < 0.9:
        story = named(rng.choice(["div", "section"]), story, "content", "post-content", "article-body", "entry-content", "story", "main-content", "article", "text")
    if rng.random() < 0.3:
        story = named(rng.choice(["main", "div", "section"]), story, "", "wrapper", "container", "main", "page")
    parts = [top()]
    around = [notice] * (rng.random() < 0.35) + [advert] * rng.choice([0, 1, 1, 2]) + [form] * (rng.random() < 0.2) + [side] * (rng.random() < 0.4)
    rng.shuffle(around)
    half = rng.randint(0, len(around))
    parts += [f() for f in around[:half]] + [story] + ([comments()] if rng.random() < 0.3 else []) + [f() for f in around[half:]]
    if rng.random() < 0.85:
        parts.append(bottom())
    if rng.random() < 0.2:
        parts.append(notice())
    return "<html><head><title>t</title></head><body>" + "".join(parts) + ("</body></html>" if rng.random() < 0.8 else ""), kept


def _labels(page: Page, kept: set[str]) -> np.ndarray:
    """1 for article runs and for all nodes that hold one."""
    y = np.zeros(len(page.name))
    for i, t in page.text.items():
        if t.split(" ", 1)[0] in kept:
            while i >= 0 and not y[i]:
                y[i] = 1
                i = page.parent[i]
    return y


# --- boosted trees ---------------------------------------------------------------------------------------------------

class Trees:
    """Gradient-boosted trees of logistic loss over binned features; every tree is complete to its depth."""

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        b = self._bins(x)
        n, width = b.shape
        p = np.average(y, weights=weight)
        self.base = float(np.log(p / (1 - p)))
        z = np.full(n, self.base)
        self.feature, self.cut, self.value = [], [], []
        offset = np.arange(width) * BINS
        for _ in range(TREES):
            q = 1 / (1 + np.exp(-z))
            g, h = weight * (q - y), weight * np.maximum(q * (1 - q), 1e-6)
            node = np.zeros(n, np.int64)
            features, cuts = [], []
            for level in range(DEPTH):
                nodes = 1 << level
                flat = (node[:, None] * (width * BINS) + offset[None, :] + b).ravel()
                size = nodes * width * BINS
                left_g = np.bincount(flat, np.repeat(g, width), size).reshape(nodes, width, BINS).cumsum(axis=2)
                left_h = np.bincount(flat, np.repeat(h, width), size).reshape(nodes, width, BINS).cumsum(axis=2)
                all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
                gain = left_g**2 / (left_h + 1) + (all_g - left_g) ** 2 / (all_h - left_h + 1) - all_g**2 / (all_h + 1)
                best = gain.reshape(nodes, -1).argmax(axis=1)
                f, c = best // BINS, best % BINS
                features.append(f)
                cuts.append(c)
                node = node * 2 + (b[np.arange(n), f[node]] > c[node])
            leaves = 1 << DEPTH
            value = -RATE * np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + 1)
            z += value[node]
            self.feature.append(features)
            self.cut.append(cuts)
            self.value.append(value)
        return self

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)], axis=1).astype(np.uint8)

    def logits(self, x: np.ndarray) -> np.ndarray:
        b = self._bins(x)
        z, rows = np.full(len(x), self.base), np.arange(len(x))
        for features, cuts, value in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for f, c in zip(features, cuts, strict=True):
                node = node * 2 + (b[rows, f[node]] > c[node])
            z += value[node]
        return z


def _plain_pool() -> list[str]:
    rng = random.Random(80)
    return [" ".join(rng.choice(PLAIN) for _ in range(rng.randint(1, 120))) for _ in range(200)]


def train(pool: list[str], seed: int = 8) -> Trees:
    """Trees from layouts of the paragraphs in pool, or of built-in words if it has none."""
    pool = [p for p in pool if p.split()] or _plain_pool()
    rng = random.Random(seed)
    made = [_layout(rng, pool) for _ in range(LAYOUTS)]
    pages = [Page(source) for source, _ in made]
    x, _, _ = features(pages)
    y = np.concatenate([_labels(p, kept) for p, (_, kept) in zip(pages, made, strict=True)])
    # Elements that stand for many runs count more.
    return Trees().fit(x, y, 1 + np.log1p(x[:, 9]))


def decode(z: np.ndarray, parent: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The most likely labels of trees in which a kept node has a kept parent."""
    yes, no = -np.logaddexp(0, -z), -np.logaddexp(0, z)
    none = no.copy()  # the best score of a subtree that is left out
    some = yes.copy()  # of one whose root is kept
    order = np.argsort(depth, kind="stable")
    cuts = np.searchsorted(depth[order], np.arange(int(depth.max()) + 2)) if len(z) else np.zeros(1, np.int64)
    levels = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    for level in reversed(levels[1:]):
        np.add.at(none, parent[level], none[level])
        np.add.at(some, parent[level], np.maximum(some[level], none[level]))
    keep = some > none
    for level in levels[1:]:
        keep[level] &= keep[parent[level]]
    return keep


def main_texts(trees: Trees, sources: list[str | None]) -> list[str]:
    pages = [Page(s or "") for s in sources]
    x, parent, first = features(pages)
    keep = decode(trees.logits(x), parent, x[:, 2].astype(np.int64)) if len(x) else np.zeros(0, bool)
    return [" ".join(t for i, t in p.text.items() if keep[f + i]) for p, f in zip(pages, first, strict=True)]


# --- on Spark --------------------------------------------------------------------------------------------------------

def sampled_runs(source: str, seed: int) -> list[str]:
    """The runs of text of a page; random pieces of them, SAMPLE_CHARS characters together at most, if it has more."""
    runs = list(Page(source).text.values())
    if sum(map(len, runs)) <= SAMPLE_CHARS:
        return runs
    pieces = [r[i:i + PIECE_CHARS] for r in runs for i in range(0, len(r), PIECE_CHARS)]
    random.Random(seed).shuffle(pieces)
    ends = np.cumsum([len(p) for p in pieces])
    return pieces[:int(np.searchsorted(ends, SAMPLE_CHARS, side="right"))]


def learn(pages: DataFrame) -> Trees | None:
    """Trees from the paragraphs of a bounded sample of pages; None if no page has html."""
    marked = pages.where(F.length("html") > 0).select("html", F.xxhash64("page_id", "html", F.lit("layout")).alias("mark"))
    # The least mark of each bucket first, combined on the executors: the driver sees 4 * SAMPLE numbers, then text of SAMPLE pages.
    least = marked.groupBy(F.pmod("mark", F.lit(4 * SAMPLE)).alias("bucket")).agg(F.min("mark").alias("mark")).collect()
    marks = sorted(r["mark"] for r in least)[:SAMPLE]
    if not marks:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for source, mark in zip(b.column("html").to_pylist(), b.column("mark").to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array([sampled_runs(source, mark)], pa.list_(pa.string()))], ["runs"])

    rows = marked.where(F.col("mark").isin(marks)).distinct().mapInArrow(run, "runs array<string>").collect()
    return train(sorted(t for r in rows for t in r["runs"]))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every page."""
    spark = pages.sparkSession
    ship(spark)
    trees = learn(pages)
    pages = pages.select("page_id", "url", "html")
    if trees is None:  # nothing to read
        return pages.select("page_id", "url", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars"))
    shared = spark.sparkContext.broadcast(trees)  # TREES trees of DEPTH levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 250):
                part = b.slice(k, 250)
                texts = main_texts(shared.value, part.column("html").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                                 ["page_id", "url", "text", "n_chars"])

    return pages.mapInArrow(run, "page_id long, url string, text string, n_chars long")
