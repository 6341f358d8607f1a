"""The main text of web pages by a recurrent block labeller.

A page is a sequence of leaves (see ``layout``). A leaf's vector is the sum of learnt vectors of the elements above it, of those
of its innermost element, the mean of learnt vectors of its hashed words, all of them, and four plain measures. A
bidirectional LSTM in numpy reads the whole sequence both ways, so each leaf is judged with the rest of its document before and behind; a
logistic layer says whether it belongs to the article.

*Training.* The weights are learnt on ``PAGES`` invented pages of mixed layouts, with a fixed seed, so they are the same
for every table and of fixed size. Accuracy is measured on pages invented from another seed (``accuracy``).

*Extraction* runs in the page's own row: no shuffle. Sequences of similar length go through the network together, in pieces of
``STEPS`` leaves, so memory follows the longest page alone. No leaf is left out before it is judged.

Defined results: a null or empty page has no leaves and an empty text; a page whose leaves all are judged boilerplate has an empty text;
repeated rows are judged alike; text outside any element counts as a leaf.
"""

from __future__ import annotations

import random
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotloom.llm.layout import MARK, PATHS, codes, invented, leaves
from slotloom.llm.words import slices

WORDS, PATH_WIDTH, OWN_WIDTH, WORD_WIDTH, PLAIN, HIDDEN = 16384, 20, 12, 8, 4, 20
WIDTH = PATH_WIDTH + OWN_WIDTH + WORD_WIDTH + PLAIN
PAGES, EPOCHS, BATCH, RATE = 900, 8, 24, 0.012
# Leaves of a batch at once, and of a sequence in one piece.
CELLS, STEPS, PAGE_BYTES = 40_000, 4096, 2 << 20


@dataclass
class Sequences:
    """Leaves of some pages, one after another; ``first`` says where each page's leaves start, and the end."""

    first: np.ndarray
    path: np.ndarray  # a number per leaf into ``paths``
    paths: list[tuple]
    words: np.ndarray  # buckets of all words
    word_first: np.ndarray
    plain: np.ndarray


def sequences(pages: list[list[tuple]]) -> Sequences:
    """From the leaves of each page."""
    flat = [leaf for page in pages for leaf in page]
    known: dict[tuple, int] = {}
    path = np.array([known.setdefault(p, len(known)) for p, _, _ in flat], np.int64)
    words, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    marks = np.array([t.count(".") + t.count(",") for _, t, _ in flat], float)
    size = np.array([len(t) for _, t, _ in flat], float)
    link = np.array([share for _, _, share in flat], float)
    for part in slices(pa.array([t.replace(MARK, "") for _, t, _ in flat], pa.large_string())):
        words.append((part.hashes() % np.uint64(WORDS)).astype(np.int64))
        sizes.append(np.diff(part.first))
    sizes = np.concatenate(sizes)
    plain = np.stack([np.log1p(sizes) / 4, np.log1p(size) / 6, link, marks / (1 + sizes)], 1) if flat else np.zeros((0, PLAIN))
    return Sequences(np.cumsum([0, *map(len, pages)]), path, list(known), np.concatenate(words), np.cumsum([0, *sizes]), plain)


def _bags(held: Sequences) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(path, code) pairs of all elements above a leaf, and of its innermost element."""
    above = [np.unique(np.concatenate([codes(e) for e in p])) if p else np.zeros(0, np.int64) for p in held.paths]
    own = [codes(p[-1]) if p else np.zeros(0, np.int64) for p in held.paths]
    place = lambda bags: np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    join = lambda bags: np.concatenate([np.zeros(0, np.int64), *bags])
    return place(above), join(above), place(own), join(own)


class Labeller:
    """Weights by name: E (elements above), O (innermost), W (words), and per direction A (input), R (recurrent), B; D, d the last layer."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @staticmethod
    def fresh(seed: int) -> Labeller:
        rng = np.random.default_rng(seed)
        w = {"E": rng.normal(0, 0.1, (PATHS, PATH_WIDTH)), "O": rng.normal(0, 0.1, (PATHS, OWN_WIDTH)), "W": rng.normal(0, 0.05, (WORDS, WORD_WIDTH))}
        for way in "fb":
            w["A" + way] = rng.normal(0, WIDTH ** -0.5, (WIDTH, 4 * HIDDEN))
            w["R" + way] = rng.normal(0, HIDDEN ** -0.5, (HIDDEN, 4 * HIDDEN))
            w["B" + way] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])  # forget gates start open
        w["D"], w["d"] = rng.normal(0, HIDDEN ** -0.5, 2 * HIDDEN), np.zeros(1)
        return Labeller(w)

    def inputs(self, held: Sequences) -> np.ndarray:
        """A vector per leaf."""
        at, code, own_at, own = _bags(held)
        above, inner = np.zeros((len(held.paths), PATH_WIDTH)), np.zeros((len(held.paths), OWN_WIDTH))
        np.add.at(above, at, self.w["E"][code])
        np.add.at(inner, own_at, self.w["O"][own])
        n = len(held.path)
        sums = np.empty((n, WORD_WIDTH))
        leaf = np.repeat(np.arange(n), np.diff(held.word_first))
        for c in range(WORD_WIDTH):
            sums[:, c] = np.bincount(leaf, weights=self.w["W"][held.words, c], minlength=n)
        means = sums / np.maximum(1, np.diff(held.word_first))[:, None]
        return np.concatenate([above[held.path], inner[held.path], means, held.plain], 1)

    def probabilities(self, held: Sequences) -> np.ndarray:
        """Of each leaf to be of the article."""
        light = {k: v.astype(np.float32) for k, v in self.w.items()}
        x, out = self.inputs(held).astype(np.float32), np.zeros(len(held.path))
        sizes = np.diff(held.first)
        order = np.argsort(sizes, kind="stable")
        order = order[sizes[order] > 0]
        low = 0
        while low < len(order):
            high = low + 1
            while high < len(order) and sizes[order[high]] * (high - low + 1) <= CELLS:
                high += 1
            pages = order[low:high]
            n, longest = sizes[pages], int(sizes[pages[-1]])
            score = np.full((longest, len(pages)), self.w["d"][0])
            for way, half in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, 2 * HIDDEN))):
                h, c = np.zeros((2, len(pages), HIDDEN), np.float32)
                for start in range(0, longest, STEPS):
                    t = np.arange(start, min(longest, start + STEPS))
                    real = t[:, None] < n[None]
                    place = t[:, None] if way == "f" else np.maximum(n[None] - 1 - t[:, None], 0)
                    place = np.where(real, place, 0)
                    rows = held.first[pages][None] + place
                    z = x[rows] @ light["A" + way] + light["B" + way]
                    for i in range(len(t)):
                        h, c, _ = _step(z[i] + h @ light["R" + way], c)
                        live = np.flatnonzero(real[i])
                        score[place[i, live], live] += h[live] @ light["D"][half]
            for i, page in enumerate(pages.tolist()):
                out[held.first[page]:held.first[page + 1]] = 1 / (1 + np.exp(-score[:n[i], i]))
            low = high
        return out

    def learn(self, held: Sequences, truth: np.ndarray, state: dict, rate: float) -> float:
        """One step of Adam on a batch of pages; the mean loss before it."""
        n, pages = np.diff(held.first), len(held.first) - 1
        longest = int(n.max())
        x = self.inputs(held)
        t = np.arange(longest)[:, None]
        real = t < n[None]
        grads = {k: np.zeros_like(v) for k, v in self.w.items()}
        runs, score = {}, np.full((longest, pages), self.w["d"][0])
        for way, half in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, 2 * HIDDEN))):
            place = np.where(real, t if way == "f" else n[None] - 1 - t, 0)
            rows = held.first[:-1][None] + place
            z = x[rows] @ self.w["A" + way] + self.w["B" + way]
            h, c = np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN))
            steps = []
            for i in range(longest):
                before = h, c
                h, c, gates = _step(z[i] + h @ self.w["R" + way], c)
                steps.append((before, c, gates, h))
                live = np.flatnonzero(real[i])
                score[place[i, live], live] += h[live] @ self.w["D"][half]
            runs[way] = place, rows, steps, half
        goal = np.zeros((longest, pages))
        for page in range(pages):
            goal[:n[page], page] = truth[held.first[page]:held.first[page + 1]]
        p = 1 / (1 + np.exp(-score))
        wrong = np.where(real, p - goal, 0) / real.sum()
        loss = -np.where(real, np.log(np.where(goal > 0, p, 1 - p) + 1e-12), 0).sum() / real.sum()
        dx = np.zeros_like(x)
        grads["d"][0] = wrong.sum()
        for way, (place, rows, steps, half) in runs.items():
            dh, dc = np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN))
            dz = np.zeros((longest, pages, 4 * HIDDEN))
            for i in range(longest - 1, -1, -1):
                (h0, c0), c, (a, f, o, g), h = steps[i]
                e = wrong[place[i], np.arange(pages)] * real[i]
                grads["D"][half] += e @ h
                dh = dh + e[:, None] * self.w["D"][half][None]
                tc = np.tanh(c)
                dc = dc + dh * o * (1 - tc * tc)
                d = np.concatenate([dc * g * a * (1 - a), dc * c0 * f * (1 - f), dh * tc * o * (1 - o), dc * a * (1 - g * g)], 1)
                dz[i] = d
                grads["R" + way] += h0.T @ d
                dh, dc = d @ self.w["R" + way].T, dc * f
            live = real.reshape(-1)
            flat, row = dz.reshape(-1, 4 * HIDDEN)[live], rows.reshape(-1)[live]
            grads["A" + way] = x[row].T @ flat
            grads["B" + way] = flat.sum(0)
            dx[row] += flat @ self.w["A" + way].T  # each leaf once a direction
        at, code, own_at, own = _bags(held)
        per_path = np.zeros((len(held.paths), PATH_WIDTH + OWN_WIDTH))
        np.add.at(per_path, held.path, dx[:, :PATH_WIDTH + OWN_WIDTH])
        np.add.at(grads["E"], code, per_path[at, :PATH_WIDTH])
        np.add.at(grads["O"], own, per_path[own_at, PATH_WIDTH:])
        per_word = dx[:, PATH_WIDTH + OWN_WIDTH:-PLAIN] / np.maximum(1, np.diff(held.word_first))[:, None]
        leaf = np.repeat(np.arange(len(held.path)), np.diff(held.word_first))
        for c in range(WORD_WIDTH):
            grads["W"][:, c] = np.bincount(held.words, weights=per_word[leaf, c], minlength=WORDS)
        state["turn"] = turn = state.get("turn", 0) + 1
        for k, g in grads.items():
            m, v = state.setdefault(k, (np.zeros_like(g), np.zeros_like(g)))
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            state[k] = m, v
            self.w[k] = self.w[k] - rate * (m / (1 - 0.9 ** turn)) / (np.sqrt(v / (1 - 0.999 ** turn)) + 1e-8)
        return float(loss)


def _step(z: np.ndarray, c: np.ndarray):
    """(h, c, gates) behind one leaf; gates are input, forget, output and the candidate."""
    gates = 1 / (1 + np.exp(-z[:, :3 * HIDDEN]))
    a, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
    g = np.tanh(z[:, 3 * HIDDEN:])
    c = f * c + a * g
    return o * np.tanh(c), c, (a, f, o, g)


def examples(n: int, seed: int) -> list[tuple[list[tuple], np.ndarray]]:
    """(leaves, which are of the article) of invented pages."""
    rng, out = random.Random(seed), []
    for _ in range(n):
        found = list(leaves(invented(rng)))
        out.append(([(p, t.removeprefix(MARK), s) for p, t, s in found], np.array([t.startswith(MARK) for _, t, _ in found], float)))
    return out


@lru_cache(maxsize=2)
def fit(pages: int = PAGES, epochs: int = EPOCHS, seed: int = 1) -> Labeller:
    """A labeller learnt from invented pages."""
    given, rng, out, state = examples(pages, seed), np.random.default_rng(seed), Labeller.fresh(seed), {}
    for epoch in range(epochs):
        # pages of similar length share a batch
        order = np.argsort([len(p) + rng.random() * 8 for p, _ in given], kind="stable")
        starts = np.arange(0, len(order), BATCH)
        for low in rng.permutation(starts).tolist():
            some = [given[i] for i in order[low:low + BATCH]]
            out.learn(sequences([p for p, _ in some]), np.concatenate([t for _, t in some]), state, RATE * (1 - epoch / epochs))
    return Labeller({k: v.astype(np.float64) for k, v in out.w.items()})


def accuracy(model: Labeller, pages: int = 200, seed: int = 2) -> float:
    """The share of leaves judged rightly on invented pages."""
    held = examples(pages, seed)
    return float(((model.probabilities(sequences([p for p, _ in held])) > 0.5) == (np.concatenate([t for _, t in held]) > 0.5)).mean())


def _judged(model: Labeller, pages: pa.Array):
    """For each page of a column, its leaves and the probability of each."""
    texts, low = pages.to_pylist(), 0
    while low < len(texts):
        high, size = low, 0
        while high < len(texts) and (high == low or size + len(texts[high] or "") <= PAGE_BYTES):
            size += len(texts[high] or "")
            high += 1
        found = [list(leaves(t)) if t else [] for t in texts[low:high]]
        held = sequences(found)
        p = model.probabilities(held)
        for i, page in enumerate(found):
            yield page, p[held.first[i]:held.first[i + 1]]
        low = high


def _rows(pages: DataFrame, html: str) -> tuple[DataFrame, str]:
    others = [F.col(f"`{c}`") for c in pages.columns if c != html]
    rows = pages.select(F.struct(*(others or [F.lit(0).alias("_")])).alias("row"), F.col(f"`{html}`").cast("string").alias("html"))
    return rows, rows.schema["row"].dataType.simpleString()


def extract(pages: DataFrame, html: str = "html", model: Labeller | None = None) -> DataFrame:
    """Each row of ``pages`` as ``row`` (its other columns), with the article's text and n_chars, its code points."""
    model = model or fit()

    def run(batches):
        for batch in batches:
            text = [" ".join(leaf[1] for leaf, p in zip(page, chance.tolist()) if p > 0.5) for page, chance in _judged(model, batch.column("html"))]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], ["row", "text", "n_chars"])

    rows, kind = _rows(pages, html)
    return rows.mapInArrow(run, f"row {kind}, text string, n_chars long")


def label(pages: DataFrame, html: str = "html", model: Labeller | None = None) -> DataFrame:
    """Every block: row, block (from 0), path, text, article (its probability)."""
    model = model or fit()

    def run(batches):
        for batch in batches:
            for i, (page, chance) in enumerate(_judged(model, batch.column("html"))):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").take(pa.array([i] * len(page), pa.int64())), pa.array(range(len(page)), pa.int32()),
                     pa.array(["/".join("".join(e) for e in p) for p, _, _ in page], pa.string()), pa.array([t for _, t, _ in page], pa.string()), pa.array(chance)],
                    ["row", "block", "path", "text", "article"])

    rows, kind = _rows(pages, html)
    return rows.mapInArrow(run, f"row {kind}, block int, path string, text string, article double")
