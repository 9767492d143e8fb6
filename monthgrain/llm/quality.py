"""Quality scores by a generalised additive model with pairwise interactions.

A text is measured by a dozen numbers (FEATURES). Each is cut into bins at quantiles, and the model is
a sum of one lookup table per number and one per interacting pair, put through the logistic function.
Tables are learned by cyclic boosting: in turn, each number gets a small step towards the current
errors, as a tree of at most three leaves over its bins; when that no longer helps on rows set aside,
the pairs whose four-leaf trees explain most of what is left are boosted the same way. So each
number's part in a score can be read off, and a score is a few table lookups.

Labels are read from at most MAX_LABELLED rows, those of the least hash of doc_id.

Defined cases: null and empty texts have all measures 0; very long texts are measured whole; without
labelled rows every score is 0.5; a doc_id labelled more than once is good if one label says so, and of
several rows with a labelled id the one of the least hash teaches; of equally good splits the first is
taken; repeated ids and rows are scored each, and an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map
from .toxicity import labelled_sample

MAX_LABELLED = 20_000
THRESHOLD = 0.3
BINS, PAIRS, ROUNDS, PATIENCE, RATE, RIDGE = 32, 6, 300, 25, 0.15, 1.0
FEATURES = (
    "log_words", "mean_word", "capitals", "digits", "signs", "stops", "repeated_words", "top_word",
    "echoes", "repeated_triples", "repeated_lines", "line_words", "one_letter", "packed",
)

_UPPER, _LOWER, _DIGIT = (np.array([chr(i) in s for i in range(256)]) for s in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"))
_STOP = np.array([chr(i) in ".,;:?" for i in range(256)])
_SIGN = np.array([33 <= i < 127 for i in range(256)]) & ~_UPPER & ~_LOWER & ~_DIGIT & ~_STOP


def measure(text: str | None) -> tuple[float, ...]:
    """The numbers of FEATURES, over the whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return (0.0,) * len(FEATURES)
    chars = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [x for x in raw.split(b"\n") if x.strip()]
    triples = max(n - 2, 1)
    return (
        float(np.log1p(n)),
        sum(map(len, words)) / n,
        chars[_UPPER].sum() / max(1, chars[_UPPER].sum() + chars[_LOWER].sum()),
        chars[_DIGIT].sum() / len(raw),
        chars[_SIGN].sum() / n,
        chars[_STOP].sum() / n,
        1 - len(counts) / n,
        max(counts.values()) / n,
        sum(map(eq, words, words[1:])) / n,
        1 - len(set(zip(words, words[1:], words[2:]))) / triples if n > 2 else 0.0,
        1 - len(set(lines)) / len(lines),
        n / len(lines),
        sum(1 for w in words if len(w) == 1) / n,
        len(zlib.compress(raw, 1)) / len(raw),
    )


@dataclass
class Model:
    edges: list[np.ndarray]
    base: float
    single: np.ndarray
    pairs: list[tuple[int, int, np.ndarray]]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)], 1)

    def raw(self, binned: np.ndarray) -> np.ndarray:
        out = self.base + self.single[np.arange(binned.shape[1]), binned].sum(1)
        for i, j, table in self.pairs:
            out += table[binned[:, i], binned[:, j]]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(self.bins(x)), -30, 30)))


def _gain(g, h):
    return g * g / (h + RIDGE)


def _three_leaves(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A step per bin: the best cut of the bins, then the best further cut of either side."""
    cuts: list[int] = []
    for _ in range(2):
        best = (1e-9, None)
        edges = [0, *sorted(cuts), len(g)]
        for a, b in zip(edges, edges[1:]):
            if b - a > 1:
                cg, ch = np.cumsum(g[a:b]), np.cumsum(h[a:b])
                gains = _gain(cg[:-1], ch[:-1]) + _gain(cg[-1] - cg[:-1], ch[-1] - ch[:-1]) - _gain(cg[-1], ch[-1])
                k = int(np.argmax(gains))
                best = max(best, (float(gains[k]), a + k + 1), key=lambda x: x[0])
        if best[1] is None:
            break
        cuts.append(best[1])
    out, edges = np.zeros(len(g)), [0, *sorted(cuts), len(g)]
    for a, b in zip(edges, edges[1:]):
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def _four_leaves(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and step per cell of the best cut of the rows followed by a cut of the columns on each side."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)

    def side(tg, th):  # rows x column cuts, with all columns last
        left, right = _gain(tg[:, :-1], th[:, :-1]), _gain(tg[:, -1:] - tg[:, :-1], th[:, -1:] - th[:, :-1])
        return left + right

    upper = side(cg[:-1], ch[:-1])
    lower = side(cg[-1] - cg[:-1], ch[-1] - ch[:-1])
    total = upper.max(1) + lower.max(1)
    r = int(np.argmax(total))
    step = np.zeros_like(g)
    for rows, c in ((slice(0, r + 1), int(np.argmax(upper[r])) + 1), (slice(r + 1, None), int(np.argmax(lower[r])) + 1)):
        for cols in (slice(0, c), slice(c, None)):
            step[rows, cols] = g[rows, cols].sum() / (h[rows, cols].sum() + RIDGE)
    return float(total[r] - _gain(cg[-1, -1], ch[-1, -1])), step


def fit_table(x: np.ndarray, y: np.ndarray) -> Model:
    """The model of measured rows x and their labels y."""
    n, d = x.shape if x.size else (0, len(FEATURES))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) if n else np.zeros(0) for j in range(d)]
    model = Model(edges, 0.0, np.zeros((d, BINS)), [])
    if not n:
        return model
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model.base = float(np.log(rate / (1 - rate)))
    binned = model.bins(x)
    aside = np.arange(n) % 6 == 5 if n >= 60 else np.zeros(n, bool)
    own, test = np.flatnonzero(~aside), np.flatnonzero(aside) if aside.any() else np.arange(n)

    def loss(f):
        return float(np.mean(np.logaddexp(0, f[test]) - y[test] * f[test]))

    def boost(tables: list[tuple[np.ndarray, np.ndarray, callable]]) -> None:
        """tables: each a table, the cell of every row in it, and the tree that gives its step."""
        nonlocal f
        best, kept, since = loss(f), [t.copy() for t, _, _ in tables], 0
        for _ in range(ROUNDS):
            for table, cell, tree in tables:
                p = 1 / (1 + np.exp(-f[own]))
                g = np.bincount(cell[own], y[own] - p, table.size).reshape(table.shape)
                h = np.bincount(cell[own], p * (1 - p), table.size).reshape(table.shape)
                step = RATE * tree(g, h)
                table += step
                f = f + step.ravel()[cell]
            now, since = loss(f), since + 1
            if now < best - 1e-6:
                best, kept, since = now, [t.copy() for t, _, _ in tables], 0
            if since >= PATIENCE:
                break
        for (table, _, _), old in zip(tables, kept, strict=True):
            table[...] = old
        f = model.raw(binned)

    f = model.raw(binned)
    boost([(model.single[j], binned[:, j], _three_leaves) for j in range(d)])
    p = 1 / (1 + np.exp(-f[own]))
    gains = []
    for i in range(d):
        for j in range(i + 1, d):
            cell = binned[own, i] * BINS + binned[own, j]
            g, h = (np.bincount(cell, w, BINS * BINS).reshape(BINS, BINS) for w in (y[own] - p, p * (1 - p)))
            gains.append((max(_four_leaves(g, h)[0], _four_leaves(g.T, h.T)[0]), i, j))
    chosen = [(i, j) for _, i, j in sorted(gains, reverse=True)[:PAIRS]]
    model.pairs = [(i, j, np.zeros((BINS, BINS))) for i, j in chosen]
    boost([(t, binned[:, i] * BINS + binned[:, j], lambda g, h: _four_leaves(g, h)[1]) for i, j, t in model.pairs])
    return model


def _measured(texts: pa.Array) -> np.ndarray:
    return np.array([measure(t) for t in texts.to_pylist()]).reshape(-1, len(FEATURES))


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0, most: int = MAX_LABELLED) -> Model:
    sample = labelled_sample(docs, labels, "quality", modulus, held, most)
    names = ["label", *FEATURES]
    rows = arrow_map(sample, lambda: lambda label, texts: [label, *_measured(texts).T], ", ".join(["label int", *(f"{f} double" for f in FEATURES)]), ["label", "text"]).toArrow()
    table = np.stack([rows[c].to_numpy().astype(float) for c in names], 1)
    table = table[np.lexsort(table.T)]  # the same order on every run
    table = table[np.random.default_rng(7).permutation(len(table))]
    return fit_table(table[:, 1:], table[:, 0])


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of each row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return arrow_map(rows, lambda: lambda ids, texts: [ids, model.scores(_measured(texts))], "doc_id long, score double", ["doc_id", "text"])
