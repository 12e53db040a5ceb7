"""Main text of web pages: a bidirectional LSTM labels every block of a page.

A block is read as a vector of its tag path (hashed marks of tags, classes, ids
and roles), a vector of its words (hashed) and a few numbers. Two LSTMs in numpy
run over a page's blocks, one from each end, so that each decision sees the
whole page. They are trained here on a bounded sample of pages: blocks inside
HTML's own elements for main content are main text, blocks inside those for
navigation, forms and the like are not; each page is also dressed in other
layouts (plain containers with usual class names, side bars, notices, adverts,
forms, reader comments), so that the labeller learns paths of many kinds.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tillroll.llm.common import add_columns, learn_in_task, texts_of
from tillroll.llm.html_blocks import Block, blocks_of

PATH_SIZE, WORD_SIZE, NUMBERS = 64, 32, 5
HIDDEN = 16
#: Pages of the training sample at most about (chosen by a hash), and what is taken of each.
SAMPLE_PAGES = 200
SAMPLE_BLOCKS = 60
SAMPLE_WORDS = 60
#: Elements for main content and for what surrounds it (fixed values).
MAIN = frozenset(("article", "main"))
OTHER = frozenset("nav aside footer form header head title button select option iframe noscript menu".split())
_NOT_MAIN_MARKS = frozenset(
    ".ad .ads .advert .adverts .advertisement .banner .comment .comments .cookie .menu .nav .newsletter .notice "
    ".promo .related .share .sidebar .sponsored .subscribe .widget".split()
)
_KNOWN_WORDS = 300_000
_ENDS = frozenset(".!?…:;\"”»")


class _Hashed(dict):
    """Place of a mark or word, remembered up to a bound; the upper half of the places stands for minus."""

    def __init__(self, size: int):
        super().__init__()
        self.size = size

    def __missing__(self, name: str) -> int:
        found = zlib.crc32(name.encode("utf-8", "replace")) % (2 * self.size)
        if len(name) <= 48:
            self[name] = found
        return found


_PATHS = _Hashed(PATH_SIZE)
_WORDS = _Hashed(WORD_SIZE)
_PATH_VECTORS: dict[tuple[str, ...], np.ndarray] = {}


def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    found = _PATH_VECTORS.get(path)
    if found is None:
        found = np.zeros(PATH_SIZE, np.float32)
        # The innermost tag counts once more, under a name of its own.
        inner = [f">{m}" for m in path if m[0] != "."][-1:]
        for mark in [*set(path), *inner]:
            place = _PATHS[mark]
            found[place % PATH_SIZE] += 1.0 if place < PATH_SIZE else -1.0
        if len(_PATH_VECTORS) > 20_000:
            _PATH_VECTORS.clear()
        _PATH_VECTORS[path] = found
    return found


def vectors(pages: list[list[Block]]) -> list[np.ndarray]:
    """For each page, one row per block."""
    blocks = [b for page in pages for b in page]
    out = np.zeros((len(blocks), PATH_SIZE + WORD_SIZE + NUMBERS), np.float32)
    if blocks:
        if len(_WORDS) > _KNOWN_WORDS:
            _WORDS.clear()
        words = [b.text.split(" ") for b in blocks]
        sizes = np.array([len(w) for w in words])
        places = np.fromiter(map(_WORDS.__getitem__, chain.from_iterable(words)), np.int64, int(sizes.sum()))
        places += np.repeat(np.arange(len(blocks)) * 2 * WORD_SIZE, sizes)
        counts = np.bincount(places, minlength=len(blocks) * 2 * WORD_SIZE).reshape(len(blocks), 2, WORD_SIZE)
        out[:, :PATH_SIZE] = [_path_vector(b.path) for b in blocks]
        means = (counts[:, 0] - counts[:, 1]) / sizes[:, None]
        # A block of one repeated word weighs no more than others.
        out[:, PATH_SIZE : PATH_SIZE + WORD_SIZE] = np.clip(2 * means, -0.5, 0.5)
        out[:, -5] = np.log1p([len(b.text) for b in blocks]) / 8
        out[:, -4] = [b.link_share for b in blocks]
        out[:, -3] = [b.text[-1] in _ENDS for b in blocks]
        out[:, -1] = 1.0
    found, at = [], 0
    for page in pages:
        rows = out[at : at + len(page)]
        rows[:, -2] = np.linspace(0, 1, len(page)) if len(page) > 1 else 0
        found.append(rows)
        at += len(page)
    return found


class Lstm:
    """One direction: input and recurrent weights of the four gates side by side (in, forget, out, new)."""

    def __init__(self, size: int, hidden: int, rng: np.random.Generator):
        self.wx = (rng.normal(size=(size, 4 * hidden)) / np.sqrt(size)).astype(np.float32)
        self.wh = (rng.normal(size=(hidden, 4 * hidden)) / np.sqrt(hidden)).astype(np.float32)
        self.b = np.zeros(4 * hidden, np.float32)
        self.b[hidden : 2 * hidden] = 1.0

    def parameters(self) -> list[np.ndarray]:
        return [self.wx, self.wh, self.b]

    def forward(self, x: np.ndarray, keep: bool = False):
        """Hidden states (steps, pages, hidden) of inputs (steps, pages, size)."""
        steps, pages, _ = x.shape
        n = self.wh.shape[0]
        mixed = (x.reshape(steps * pages, -1) @ self.wx + self.b).reshape(steps, pages, 4 * n)
        h, c = np.zeros((pages, n), np.float32), np.zeros((pages, n), np.float32)
        states = np.empty((steps, pages, n), np.float32)
        cells, gates = [], []
        for t in range(steps):
            z = mixed[t] + h @ self.wh
            s = 1 / (1 + np.exp(-np.clip(z[:, : 3 * n], -30, 30)))
            g = np.tanh(z[:, 3 * n :])
            before = c
            c = s[:, n : 2 * n] * c + s[:, :n] * g
            h = s[:, 2 * n :] * np.tanh(c)
            states[t] = h
            if keep:
                cells.append((before, c))
                gates.append((s, g))
        return (states, cells, gates) if keep else states

    def backward(self, x, states, cells, gates, dstates) -> list[np.ndarray]:
        """Gradients of the parameters for gradients of all hidden states."""
        steps, pages, _ = x.shape
        n = self.wh.shape[0]
        dz_all = np.empty((steps, pages, 4 * n), np.float32)
        dwh = np.zeros_like(self.wh)
        dh, dc = np.zeros((pages, n), np.float32), np.zeros((pages, n), np.float32)
        for t in range(steps - 1, -1, -1):
            (before, c), (s, g) = cells[t], gates[t]
            i, f, o = s[:, :n], s[:, n : 2 * n], s[:, 2 * n :]
            dh = dh + dstates[t]
            th = np.tanh(c)
            dc = dc + dh * o * (1 - th**2)
            dz = np.concatenate(
                (dc * g * i * (1 - i), dc * before * f * (1 - f), dh * th * o * (1 - o), dc * i * (1 - g**2)), axis=1
            )
            dz_all[t] = dz
            if t:
                dwh += states[t - 1].T @ dz
            dh = dz @ self.wh.T
            dc = dc * f
        flat = dz_all.reshape(steps * pages, -1)
        return [x.reshape(steps * pages, -1).T @ flat, dwh, flat.sum(axis=0)]


def _flipped(x: np.ndarray, lengths: list[int]) -> np.ndarray:
    """Each page's steps in reverse; padding stays at the end."""
    out = np.zeros_like(x)
    for page, n in enumerate(lengths):
        out[:n, page] = x[:n, page][::-1]
    return out


def _padded(rows: list[np.ndarray]) -> tuple[np.ndarray, list[int]]:
    lengths = [len(r) for r in rows]
    x = np.zeros((max(lengths), len(rows), rows[0].shape[1]), np.float32)
    for page, r in enumerate(rows):
        x[: len(r), page] = r
    return x, lengths


@dataclass
class Labeller:
    """Both directions and the output layer."""

    ahead: Lstm
    back: Lstm
    out: np.ndarray
    bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [*self.ahead.parameters(), *self.back.parameters(), self.out, self.bias]

    def probabilities(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        """For each page, the probability of each block to be main text."""
        found: list[np.ndarray] = [np.zeros(0)] * len(rows)
        order = sorted((i for i in range(len(rows)) if len(rows[i])), key=lambda i: len(rows[i]))
        at = 0
        while at < len(order):
            # Pages of like length run together, as many as fit into 32,768 steps.
            end = at + 1
            while end < len(order) and end - at < 256 and (end - at + 1) * len(rows[order[end]]) <= 32_768:
                end += 1
            some = order[at:end]
            x, lengths = _padded([rows[i] for i in some])
            both = np.concatenate(
                (self.ahead.forward(x), _flipped(self.back.forward(_flipped(x, lengths)), lengths)), axis=2
            )
            p = 1 / (1 + np.exp(-np.clip(both @ self.out + self.bias, -30, 30)))
            for page, i in enumerate(some):
                found[i] = p[: lengths[page], page]
            at = end
        return found

    def gradients(self, rows: list[np.ndarray], labels: list[np.ndarray]) -> list[np.ndarray]:
        x, lengths = _padded(rows)
        turned = _flipped(x, lengths)
        hf, cf, gf = self.ahead.forward(x, keep=True)
        hb, cb, gb = self.back.forward(turned, keep=True)
        both = np.concatenate((hf, _flipped(hb, lengths)), axis=2)
        p = 1 / (1 + np.exp(-np.clip(both @ self.out + self.bias, -30, 30)))
        d = np.zeros_like(p)
        for page, y in enumerate(labels):
            d[: len(y), page] = p[: len(y), page] - y
        d = (d / sum(lengths)).astype(np.float32)
        n = hf.shape[2]
        dboth = d[:, :, None] * self.out
        dout = np.einsum("tb,tbh->h", d, both)
        first = self.ahead.backward(x, hf, cf, gf, np.ascontiguousarray(dboth[:, :, :n]))
        second = self.back.backward(turned, hb, cb, gb, _flipped(dboth[:, :, n:], lengths))
        return [*first, *second, dout, np.array([d.sum()], np.float32)]


def train(pages: list[tuple[list[Block], list[int]]], epochs: int = 20, batch: int = 16, rate: float = 0.01, seed: int = 17) -> Labeller:
    """Fit by Adam on pages of blocks with labels."""
    rng = np.random.default_rng(seed)
    size = PATH_SIZE + WORD_SIZE + NUMBERS
    model = Labeller(
        Lstm(size, HIDDEN, rng),
        Lstm(size, HIDDEN, rng),
        (rng.normal(size=2 * HIDDEN) / np.sqrt(2 * HIDDEN)).astype(np.float32),
        np.zeros(1, np.float32),
    )
    pages = [(b, y) for b, y in pages if b]
    rows = vectors([b for b, _ in pages])
    data = [(x, np.array(y, np.float32)) for x, (_, y) in zip(rows, pages)]
    first = [np.zeros_like(p) for p in model.parameters()]
    second = [np.zeros_like(p) for p in model.parameters()]
    step = 0
    for epoch in range(epochs):
        # Pages of like length share a batch; the batches come in random order.
        order = sorted(rng.permutation(len(data)).tolist(), key=lambda i: len(data[i][0]) // 8)
        batches = [order[at : at + batch] for at in range(0, len(order), batch)]
        for b in rng.permutation(len(batches)).tolist():
            grads = model.gradients([data[i][0] for i in batches[b]], [data[i][1] for i in batches[b]])
            step += 1
            norm = float(np.sqrt(sum((g.astype(np.float64) ** 2).sum() for g in grads)))
            for p, g, m, v in zip(model.parameters(), grads, first, second):
                g = g * min(1.0, 1.0 / (norm + 1e-12))
                m += 0.1 * (g - m)
                v += 0.001 * (g**2 - v)
                fresh = rate * (1 - 0.8 * epoch / epochs) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
                p -= fresh.astype(np.float32)
    return model


# --- training pages ------------------------------------------------------------------------


def weak_labels(blocks: list[Block]) -> list[int] | None:
    """Labels by HTML's own elements, or None for a page without a main element."""
    if not any(m in MAIN for b in blocks for m in b.path):
        return None
    labels = []
    for b in blocks:
        inside = any(m in MAIN for m in b.path)
        other = any(m in OTHER or m in _NOT_MAIN_MARKS for m in b.path)
        labels.append(int(inside and not other))
    return labels


_SHELLS = (
    ("article",), ("main",), ("main", "article"), ("div", ".content"), ("div", ".main", ".content"),
    ("div", ".post", ".body"), ("div", ".entry", ".content"), ("div", ".article", ".body"), ("section", ".story"),
    ("div", ".page", "div", ".text"), ("main", ".main", "div", ".article"), ("div", ".wrapper", "article", ".post"),
    ("section", "article"), ("div", ".container", "main", "div"), ("td", ".content"), ("div", ".story", ".text"),
)
_INNER = (("p",), ("p",), ("p",), ("p",), ("ul", "li"), ("ol", "li"), ("blockquote", "p"), ("h2",), ("h3",), ("pre",), ("table", "tr", "td"), ("figure", "figcaption"), ("div",), ("section", "p"))
_AROUND = {
    "nav": (("nav", "ul", "li"), ("div", ".menu", "ul", "li"), ("header", "nav", "a"), ("div", ".navbar", "ul", "li"), ("ul", ".nav", "li"), ("header", ".site", ".header", "nav", "ul", "li"), ("menu", "li")),
    "header": (("header", "div"), ("header", ".site", ".header", "p"), ("div", ".header", "h1"), ("div", ".topbar"), ("div", ".breadcrumb"), ("div", ".masthead", "p")),
    "footer": (("footer",), ("footer", "p"), ("div", ".footer"), ("div", ".site", ".footer", "p"), ("div", ".copyright")),
    "side": (("aside", "p"), ("aside", ".sidebar", "ul", "li"), ("div", ".sidebar", "p"), ("div", ".widget", "h3"), ("div", ".related", "ul", "li"), ("section", ".related", "p"), ("aside", "h2"), ("aside", "div"), ("div", ".share")),
    "notice": (("div", ".notice"), ("div", ".cookie", ".notice", "p"), ("div", ".cookie"), ("div", ".banner", "p"), ("div", ".alert"), ("div", ".consent", "p"), ("div", ".newsletter", "p"), ("div", ".subscribe"), ("div", ".popup", "p"), ("div", ".cookies", "p"), ("noscript",), ("dialog", "p")),
    "ad": (("div", ".ad"), ("div", ".ads"), ("div", ".advert", "p"), ("div", ".sponsored", "p"), ("aside", ".ad"), ("div", ".promo"), ("div", ".advertisement"), ("ins", ".ad"), ("section", ".promo", "p")),
    "form": (("form", "label"), ("form", "p"), ("form", "button"), ("form", "div"), ("div", ".search", "form", "label"), ("form", "select", "option"), ("fieldset", "legend")),
    "comment": (("div", ".comments", "div", ".comment", "p"), ("section", ".comments", "p"), ("ol", ".comment", ".list", "li", "p"), ("div", ".comments", "h3"), ("div", ".comment"), ("section", ".comments", "div", ".comment", "p"), ("ul", ".comments", "li"), ("div", ".replies", "p"), ("section", ".comments", "article", ".comment", "p"), ("div", ".responses", "div", ".response", "p")),
}


def _dress(main: list[str], other: list[str], rng: np.random.Generator) -> tuple[list[Block], list[int]]:
    """Main and other texts in a random layout."""
    blocks: list[Block] = []
    labels: list[int] = []

    def pick(options):
        return options[int(rng.integers(len(options)))]

    def words(kind: str) -> str:
        long = kind == "comment" or rng.random() < 0.25
        return pick(main if long and main else other or main)

    def around(kind: str, lead: tuple[str, ...] = ()) -> None:
        path = pick(_AROUND[kind])
        many = int(rng.integers(2, 8)) if "li" in path or kind == "comment" else int(rng.integers(1, 3))
        for _ in range(many):
            text = words(kind)
            if "li" in path and kind == "nav":
                text = " ".join(text.split()[: int(rng.integers(1, 4))])
            blocks.append(Block(("html", "body", *lead, *path), text, 0.9 if "li" in path and rng.random() < 0.7 else 0.0))
            labels.append(0)

    if rng.random() < 0.6:
        blocks.append(Block(("html", "head", "title"), pick(main)[:60]))
        labels.append(0)
    outer = pick(((), (), ("div", ".page"), ("div", ".wrapper"), ("div", ".container")))
    for kind in ("notice", "header", "nav", "ad", "side"):
        if rng.random() < (0.8 if kind == "nav" else 0.35):
            around(kind, outer)
    shell = (*outer, *pick(_SHELLS))
    inside_shell = rng.random() < 0.5
    blocks.append(Block(("html", "body", *shell, "h1"), pick(main)[:60]))
    labels.append(1)
    for text in main:
        if inside_shell and rng.random() < 0.12:
            around(pick(("ad", "side", "notice", "form")), shell)
        # Short, repeated and odd paragraphs are main text too: the path should tell, not the words.
        chance, again = rng.random(), 1
        if chance < 0.2:
            text = pick(other or main)
        elif chance < 0.35:
            text = " ".join(text.split()[: int(rng.integers(1, 5))])
            again = int(rng.integers(1, 12)) if rng.random() < 0.3 else 1
        path = ("html", "body", *shell, *pick(_INNER))
        blocks += [Block(path, text)] * again
        labels += [1] * again
    if inside_shell and rng.random() < 0.4:
        around("comment", shell)
    for kind in ("side", "ad", "form", "comment", "notice", "nav", "footer"):
        if rng.random() < (0.8 if kind == "footer" else 0.35):
            around(kind, outer)
    return blocks, labels


def training_pages(pages: list[list[Block]], variants: int = 3, seed: int = 19) -> list[tuple[list[Block], list[int]]]:
    """Weakly labelled pages and their dressed variants.

    Without any page that has a main element, blocks of twelve words or more
    serve as main texts of the variants.
    """
    rng = np.random.default_rng(seed)
    found: list[tuple[list[Block], list[int]]] = []
    for blocks in pages:
        labels = weak_labels(blocks)
        if labels is not None:
            found += [(blocks, labels)] * 2
        else:
            labels = [int(len(b.text.split()) >= 12) for b in blocks]
        main = [b.text for b, y in zip(blocks, labels) if y]
        other = [b.text for b, y in zip(blocks, labels) if not y]
        if main:
            found += [_dress(main, other, rng) for _ in range(variants)]
    return found


def fit(pages: DataFrame, key: str = "page_id", page: str = "html", sample_pages: int = SAMPLE_PAGES) -> Labeller:
    """Train on about ``sample_pages`` pages, of each up to SAMPLE_BLOCKS blocks and SAMPLE_WORDS words a block.

    The bound holds for training alone: extraction reads whole pages.
    """
    rows = pages.where(F.col(page).isNotNull())
    n = rows.count()
    place = F.pmod(F.xxhash64(key, F.lit("pages")), F.lit(1 << 30))
    chosen = rows.where(place < int((1 << 30) * min(1.0, sample_pages / max(1, n)))).select(F.col(page).alias("page"))

    def cut(batches):
        for batch in batches:
            paths, texts, links = [], [], []
            for whole in texts_of(batch):
                blocks = blocks_of(whole)[:SAMPLE_BLOCKS]
                paths.append([" ".join(b.path) for b in blocks])
                texts.append([" ".join(b.text.split()[:SAMPLE_WORDS]) for b in blocks])
                links.append([b.link_share for b in blocks])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(paths, pa.list_(pa.string())),
                    pa.array(texts, pa.list_(pa.string())),
                    pa.array(links, pa.list_(pa.float64())),
                ],
                names=["paths", "texts", "links"],
            )


    def learn(got: pa.Table) -> Labeller:
        pages_of = sorted(got.to_pylist(), key=lambda r: (r["texts"], r["paths"]))
        found = [
            [Block(tuple(p.split(" ")) if p else (), t, a) for p, t, a in zip(r["paths"], r["texts"], r["links"])]
            for r in pages_of
        ]
        return train(training_pages(found))

    leaves = chosen.mapInArrow(cut, "paths array<string>, texts array<string>, links array<double>")
    return learn_in_task(leaves, learn)


def main_texts(model: Labeller, pages: list[str]) -> list[str]:
    """Main text of each page: its blocks of main text joined by line ends."""
    blocks = [blocks_of(p) if p else [] for p in pages]
    found = model.probabilities(vectors(blocks))
    return ["\n".join(b.text for b, y in zip(bs, p.tolist()) if y >= 0.5) for bs, p in zip(blocks, found)]


def extract(pages: DataFrame, model: Labeller, page: str = "html", name: str = "text") -> DataFrame:
    """Append the main text of each whole page (null or empty page: the empty text).

    Other columns stay; of a clashing name the new column stays. Repeated rows get equal texts.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def compute(batch: pa.RecordBatch) -> list:
        whole = texts_of(batch)
        found: list[str] = []
        for at in range(0, len(whole), 256):
            found += main_texts(shared.value, whole[at : at + 256])
        return [pa.array(found, pa.string())]

    return add_columns(pages, [page], [(name, StringType())], compute)
