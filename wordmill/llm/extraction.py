"""HTML extraction by a recurrent block labeller (operator 8).

Each page is a sequence of leaf blocks (:mod:`.html_blocks`). A bidirectional
LSTM in numpy reads their vectors and gives each block the probability of
being main text, so a block is judged with the whole page before and after it.

The model is trained where the query runs, on a bounded sample of pages
(:data:`TRAIN_PAGES`). Pages with semantic elements (``article``, ``main``)
label their own blocks; each of them is also shown in invented layouts
(``div`` soup, other class names, side bars, forms, notices, reader comments),
so the model does not rest on one element name. Fixed seeds: the same sample
gives the same model.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, text_or_empty
from .html_blocks import DIMS, Block, blocks, vectors

#: Pages that the model is trained on at most (chosen by a hash of the page).
TRAIN_PAGES = 200
HIDDEN = 16
_EPOCHS = 10
_BATCH = 24
_RATE = 0.01
#: Blocks of all pages that are labelled at once.
_AT_ONCE = 8192

# Names by which layouts mark their parts.
_MAIN = [("article",), ("main",), ("main", "article"), ("div", ".content"), ("div", ".post", ".body"),
         ("div", ".article"), ("section", ".story"), ("div", ".entry", ".content"), ("div", ".main"),
         ("div", ".text"), ("td", ".content"), ("div", ".page", ".article", ".body")]
_REST = {
    "menu": [("nav", "ul", "li"), ("div", ".menu", "ul", "li"), ("ul", ".nav", "li"), ("div", ".navbar"),
             ("div", ".breadcrumb"), ("nav", ".toc", "li")],
    "header": [("header",), ("div", ".header"), ("div", ".top", ".banner"), ("header", ".site", "h1"), ("head", "title")],
    "footer": [("footer",), ("div", ".footer"), ("div", ".bottom", ".copyright"), ("footer", "p"), ("div", ".legal")],
    "side": [("aside",), ("div", ".sidebar"), ("aside", ".related", "li"), ("div", ".widget"), ("div", ".recommended")],
    "notice": [("div", ".cookie", ".notice"), ("div", ".consent"), ("div", ".alert"), ("div", ".newsletter"),
               ("dialog",), ("div", ".modal"), ("div", ".popup"), ("noscript",), ("div", ".cookie", "p")],
    "advert": [("div", ".ad"), ("div", ".ads"), ("div", ".advert"), ("div", ".sponsored"), ("div", ".promo"),
               ("iframe", ".ad"), ("div", ".advertisement", "p")],
    "form": [("form",), ("form", "p"), ("form", ".search", "button"), ("div", ".login", "form"), ("form", "select", "option"),
             ("form", "fieldset", "legend")],
    "comments": [("div", ".comments", "div", ".comment", "p"), ("section", ".comments", "p"), ("ol", ".comment", ".list", "li"),
                 ("div", ".disqus"), ("div", ".responses", "p"), ("section", ".replies", "div", ".reply")],
}
_LEAVES = [("p",), ("p",), ("p",), ("p",), ("h2",), ("h3",), ("ul", "li"), ("ol", "li"), ("blockquote", "p"), ("blockquote",),
           ("pre",), ("table", "tr", "td"), ("figure", "figcaption"), ("section", "p"), ("div",), (), ("dl", "dd")]
_BOILER = frozenset("nav aside footer form header head title menu select option button noscript dialog iframe".split())
_BOILER |= frozenset(n for kinds in _REST.values() for path in kinds for n in path if n[0] == ".") - {
    ".top", ".bottom", ".site", ".list", ".search", ".banner"}


# -- training pages --------------------------------------------------------

def own_labels(page: list[Block]) -> list[int] | None:
    """Labels that the page's semantic elements give; None without such."""
    if not any({"article", "main"} & set(b.path) for b in page):
        return None
    out = []
    for b in page:
        start = max((i for i, n in enumerate(b.path) if n in ("article", "main")), default=None)
        out.append(int(start is not None and not _BOILER & set(b.path[start:]) and not _BOILER & {
            n for n in b.path[:start] if n[0] != "."}))
    return out


def invented(rng: random.Random, good: list[str], spare: list[str]) -> tuple[list[Block], list[int]]:
    """The main text ``good`` in an invented layout, with other texts around it."""
    outer = ("html", "body") + rng.choice([(), (), ("div", ".wrapper"), ("div", ".container", "div", ".row"),
                                            ("table", "tr")])
    main = outer + rng.choice(_MAIN)
    title = rng.choice(["h1", "h1", "h2", "header"]) if good else "h1"

    def rest(kinds, inside=()):
        out = []
        for kind in kinds:
            base = inside or outer
            path = rng.choice(_REST[kind])
            if path[0] == "head":
                base = ("html",)
            # Reader comments, adverts and notices may be as long as the text itself.
            long = kind in ("comments", "advert", "notice", "side") and rng.random() < 0.6
            link = kind in ("menu", "side", "footer") and rng.random() < 0.7
            for _ in range(rng.randint(1, 6 if kind in ("menu", "comments", "side") else 2)):
                text = rng.choice(spare)
                words = text.split()
                if not long:
                    at = rng.randrange(len(words))
                    text = " ".join(words[at:at + rng.randint(1, 8)])
                if kind == "footer" and rng.random() < 0.5:
                    text = "© " + text
                out.append((Block(base + path, text, len(text) if link else 0), 0))
        return out

    parts = rest(k for k in ("header", "menu", "notice", "advert", "form") if rng.random() < 0.5)
    for i, text in enumerate(good):
        leaf = (title,) if i == 0 and title != "header" else ("p",) if rng.random() < 0.7 else rng.choice(_LEAVES)
        parts.append((Block(main + leaf, text, 0 if rng.random() < 0.9 else len(text) // 4), 1))
        if rng.random() < 0.12:
            parts += rest([rng.choice(["advert", "notice", "side", "form", "menu"])], main)
    if rng.random() < 0.3:
        parts += rest(["comments"], main)
    parts += rest(k for k in ("comments", "side", "advert", "form", "menu", "footer", "notice") if rng.random() < 0.5)
    return [b for b, _ in parts], [y for _, y in parts]


def training_set(pages: list[str], seed: int = 7) -> list[tuple[np.ndarray, np.ndarray]]:
    """Vectors and labels of the pages as they are and in invented layouts."""
    rng = random.Random(seed)
    read = [b for b in map(blocks, pages) if b]
    known = [(b, y) for b in read if (y := own_labels(b)) is not None]
    spare = [b.text for page in read for b in page] or ["more about this"]
    out = list(known)
    if known:
        stories = [[b.text for b, y in zip(page, labels) if y] for page, labels in known]
    else:  # nothing labels itself: long blocks stand in for main text
        stories = [[b.text for b in page if len(b.text) > 80] for page in read]
    for story in stories or [["Some words to begin with, and then some more."]]:
        out += [invented(rng, story, spare) for _ in range(2)]
    rng.shuffle(out)
    return [(vectors(page), np.array(labels, np.float32)) for page, labels in out if page]


# -- model -----------------------------------------------------------------

def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BlockLabeller:
    """A bidirectional LSTM with one sigmoid output per block."""

    def __init__(self, dims: int = DIMS, hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        scale = 1 / np.sqrt(dims + hidden)
        self.hidden = hidden
        self.p = {}
        for d in "fb":
            self.p[f"x{d}"] = rng.normal(0, scale, (dims, 4 * hidden)).astype(np.float32)
            self.p[f"h{d}"] = rng.normal(0, scale, (hidden, 4 * hidden)).astype(np.float32)
            self.p[f"c{d}"] = np.zeros(4 * hidden, np.float32)
            self.p[f"c{d}"][hidden:2 * hidden] = 1  # remember at first
        self.p["o"] = rng.normal(0, scale, 2 * hidden).astype(np.float32)
        self.p["s"] = np.zeros(1, np.float32)

    @staticmethod
    def pad(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """``x[time, page, dim]`` and ``mask[time, page]``."""
        steps = max(map(len, pages))
        x = np.zeros((steps, len(pages), pages[0].shape[1]), np.float32)
        mask = np.zeros((steps, len(pages)), np.float32)
        for i, page in enumerate(pages):
            x[:len(page), i] = page
            mask[:len(page), i] = 1
        return x, mask

    def _run(self, x, mask, d: str, keep: bool):
        """Hidden states of one direction; padding leaves the state as it is."""
        n, h = self.hidden, np.zeros((x.shape[1], self.hidden), np.float32)
        c = np.zeros_like(h)
        a = x @ self.p[f"x{d}"] + self.p[f"c{d}"]
        out = np.zeros((*mask.shape, n), np.float32)
        saved = {}
        for t in range(len(x)) if d == "f" else reversed(range(len(x))):
            z = a[t] + h @ self.p[f"h{d}"]
            i, f, o = _sigmoid(z[:, :n]), _sigmoid(z[:, n:2 * n]), _sigmoid(z[:, 2 * n:3 * n])
            g, m = np.tanh(z[:, 3 * n:]), mask[t][:, None]
            c2 = f * c + i * g
            tc = np.tanh(c2)
            if keep:
                saved[t] = (i, f, o, g, c, h, tc)
            h, c = m * o * tc + (1 - m) * h, m * c2 + (1 - m) * c
            out[t] = h
        return out, saved

    def scores(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """The probability of main text for each block of each page."""
        x, mask = self.pad(pages)
        both = np.concatenate([self._run(x, mask, d, False)[0] for d in "fb"], axis=2)
        y = _sigmoid(both @ self.p["o"] + self.p["s"])
        return [y[:len(page), i] for i, page in enumerate(pages)]

    def _gradients(self, x, mask, y):
        n, grads = self.hidden, {}
        runs = {d: self._run(x, mask, d, True) for d in "fb"}
        both = np.concatenate([runs[d][0] for d in "fb"], axis=2)
        dy = (_sigmoid(both @ self.p["o"] + self.p["s"]) - y) * mask / mask.sum()
        grads["o"], grads["s"] = np.einsum("tb,tbh->h", dy, both), np.array([dy.sum()])
        for k, d in enumerate("fb"):
            saved, dout = runs[d][1], dy[:, :, None] * self.p["o"][k * n:(k + 1) * n]
            dz_all = np.zeros((*mask.shape, 4 * n), np.float32)
            dh, dc = np.zeros(dout.shape[1:], np.float32), np.zeros(dout.shape[1:], np.float32)
            gh = np.zeros_like(self.p[f"h{d}"])
            for t in reversed(range(len(x))) if d == "f" else range(len(x)):
                i, f, o, g, c, h, tc = saved[t]
                m = mask[t][:, None]
                dh = dh + dout[t]
                d_out = m * dh
                dc2 = m * dc + d_out * o * (1 - tc * tc)
                dz = np.concatenate([dc2 * g * i * (1 - i), dc2 * c * f * (1 - f), d_out * tc * o * (1 - o),
                                     dc2 * i * (1 - g * g)], axis=1)
                dz_all[t] = dz
                gh += h.T @ dz
                dh = (1 - m) * dh + dz @ self.p[f"h{d}"].T
                dc = (1 - m) * dc + dc2 * f
            grads[f"h{d}"] = gh
            grads[f"x{d}"] = np.einsum("tbi,tbj->ij", x, dz_all, optimize=True)
            grads[f"c{d}"] = dz_all.sum(axis=(0, 1))
        return grads

    def fit(self, data: list[tuple], epochs: int = _EPOCHS, rate: float = _RATE, seed: int = 7) -> BlockLabeller:
        """Adam on the cross entropy of all blocks, in batches of like length."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        data, step = sorted(data, key=lambda d: len(d[1])), 0
        batches = [data[i:i + _BATCH] for i in range(0, len(data), _BATCH)]
        padded = []
        for batch in batches:
            x, mask = self.pad([v for v, _ in batch])
            padded.append((x, mask, self.pad([y[:, None] for _, y in batch])[0][:, :, 0]))
        for epoch in range(epochs):
            for b in rng.permutation(len(padded)):
                step += 1
                for k, g in self._gradients(*padded[b]).items():
                    g = np.clip(g, -1, 1)
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    slower = rate * (1 - 0.9 * epoch / epochs)
                    self.p[k] = (self.p[k] - slower * (first[k] / (1 - 0.9 ** step))
                                 / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
        return self

    def texts(self, pages: list[str]) -> list[str]:
        """The main text of each page."""
        read = [blocks(p) for p in pages]
        chosen: dict[int, str] = {}
        order = sorted((i for i, b in enumerate(read) if b), key=lambda i: len(read[i]))
        while order:
            longest = len(read[order[-1]])
            batch = [order.pop() for _ in range(min(len(order), max(1, _AT_ONCE // longest)))]
            for i, score in zip(batch, self.scores([vectors(read[i]) for i in batch])):
                chosen[i] = "\n\n".join(b.text for b, s in zip(read[i], score) if s > 0.5)
        return [chosen.get(i, "") for i in range(len(pages))]


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
          train_pages: int = TRAIN_PAGES) -> BlockLabeller:
    """A model from ``train_pages`` pages at most.

    A hash picks about twice as many, wherever they are, so what the tasks send
    for the last choice (the least hashes) does not grow with the table.
    """
    every = max(1, pages.count() // (2 * train_pages))
    keyed = pages.select(F.col(id_col).alias("i"), text_or_empty(html_col).alias("html"))
    rows = (keyed.withColumn("h", F.xxhash64("i", "html")).where(F.pmod("h", F.lit(every)) == 0)
            .orderBy("h", "i", "html").limit(train_pages).collect())
    return BlockLabeller().fit(training_set([r.html for r in rows]))


def extract(pages: DataFrame, model: BlockLabeller, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """One row per input row: ``id, url, text, n_chars``.

    ``text`` holds the blocks labelled as main text in page order, joined by
    two line feeds (empty if none, or if the page is null, empty or has no
    text); ``n_chars`` its code points. Repeated rows are each returned.
    """
    names = ["id", "url", "text", "n_chars"]

    def start():
        def work(ids, texts):
            out = model.texts(texts)
            return {"id": pa.array([i["id"] for i in ids], pa.int64()),
                    "url": pa.array([i["url"] for i in ids], pa.string()),
                    "text": pa.array(out, pa.string()), "n_chars": pa.array(list(map(len, out)), pa.int64())}
        return work
    keyed = pages.select(F.struct(F.col(id_col).alias("id"), F.col(url_col).alias("url")).alias("key"),
                         F.col(html_col).alias("html"))
    out = map_texts(keyed, "key", "html", "id long, url string, text string, n_chars long", start)
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), *names[2:])
