"""Language identification by nearest centroids.

A text is a vector of its letter n-grams (one to three letters, each word framed by spaces, hashed to
DIMENSIONS cells), weighed by log counts and inverse document frequency, and normalised. Each
language has several centroids, from spherical k-means over its labelled texts, so that a language
of several styles isn't held to their average. The language of the nearest centroid by cosine wins.
The score is that cosine against the best of any other language. A text farther from its centroid
than nearly all (1 - REJECTED) labelled texts of the language is marked as rejected.

Document frequencies count all labelled texts; centroids are fitted on at most MAX_LABELLED of them: of
each language those of the least hash, and all languages get their first one before any gets another,
so that rare ones are learned too.

Defined cases: null texts and texts without a letter get `und` and score 0, and are marked rejected;
so do all where nothing could be learned (an empty table, say); very long texts are counted whole; of
equally near languages the first by name wins; rows with null lang or id teach nothing, and rows equal in
id, language and text teach once; repeated ids and rows are predicted each; other columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, cut, look_up, remainder
from .toxicity import codes_of

MAX_LABELLED = 4_000
DIMENSIONS = 4096
CENTROIDS = 4
REJECTED = 0.002
UNKNOWN = "und"
_letters = np.array([chr(i).isalpha() for i in range(0x3000)])
_LOWER = np.array([ord(chr(i).lower()[0]) for i in range(0x3000)], np.uint32)


def gram_cells(text: str) -> np.ndarray | None:
    """The cells of all n-grams of a text; None if it has no letter."""
    codes = codes_of(text)
    inside = codes < 0x3000
    letter = _letters[np.where(inside, codes, 0)]
    if not inside.all():  # letters beyond the table, one by one
        letter[~inside] = [chr(c).isalpha() for c in codes[~inside].tolist()]
    if not letter.any():
        return None
    low = np.where(inside, _LOWER[np.where(inside, codes, 0)], codes).astype(np.uint64)
    c = np.where(letter, low, np.uint64(32))
    keep = np.ones(len(c), bool)
    keep[1:] = letter[1:] | letter[:-1]  # a run of other signs is one space
    c = np.concatenate([[np.uint64(32)], c[keep], [np.uint64(32)]])
    a, b = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
    one = (c + np.uint64(1)) * a
    two = (one[:-1] ^ (one[:-1] >> np.uint64(29))) * b + one[1:]
    three = (two[:-1] ^ (two[:-1] >> np.uint64(31))) * b + one[2:]
    grams = np.concatenate([one[1:-1], two, three])
    return ((grams ^ (grams >> np.uint64(32))) * b >> np.uint64(52)).astype(np.int64) % DIMENSIONS


def counts_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of log-scaled n-gram counts, and which texts have a letter."""
    out, has = np.zeros((len(texts), DIMENSIONS), np.float32), np.zeros(len(texts), bool)
    for i, t in enumerate(texts):
        if t and (cells := gram_cells(t)) is not None:
            out[i], has[i] = np.bincount(cells, minlength=DIMENSIONS), True
    return np.log1p(out, out=out), has


def normalised(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def spherical_means(x: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """Up to k unit centroids of unit rows; each first one is the row farthest from those before."""
    chosen = [int(np.argmin(x @ normalised(x.mean(0, keepdims=True))[0]))]
    while len(chosen) < min(k, len(x)):
        chosen.append(int(np.argmin((x @ x[chosen].T).max(1))))
    centroids = x[chosen]
    for _ in range(rounds):
        own = np.argmax(x @ centroids.T, 1)
        sums = np.stack([x[own == c].sum(0) if (own == c).any() else centroids[c] for c in range(len(centroids))])
        centroids = normalised(sums)
    return centroids


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    least: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether rejected, of each text."""
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        langs, scores, rejected = [], [], []
        for at in range(0, len(texts), 256):
            counts, has = counts_of(texts[at : at + 256])
            close = normalised(counts * self.idf) @ self.centroids.T
            by_lang = np.stack([close[:, self.owner == k].max(1) for k in range(len(self.langs))], 1)
            best = by_lang.argmax(1)
            top = by_lang[np.arange(len(best)), best]
            rest = np.where(np.arange(len(self.langs)) == best[:, None], 0, by_lang).max(1)
            langs += [self.langs[b] if h else UNKNOWN for b, h in zip(best.tolist(), has.tolist(), strict=True)]
            scores.append(np.where(has, np.clip(top / np.maximum(top + rest, 1e-9), 0, 1), 0.0))
            rejected.append(~has | (top < self.least[best]))
        return langs, np.concatenate(scores or [np.zeros(0)]).astype(float), np.concatenate(rejected or [np.zeros(0, bool)])


def sampled(taught: DataFrame, most: int) -> DataFrame:
    """lang and text of at most `most` rows of taught (doc_id, lang, text), as even over the languages as it
    goes. Languages are thinned by hash before their rows are ranked, so that none is ranked whole."""
    text_hash, draw = F.xxhash64("text"), F.xxhash64("doc_id", "lang", "text")
    narrow = taught.select("doc_id", "lang", text_hash.alias("text_hash"), draw.alias("draw"))
    counts = narrow.groupBy("lang").agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count")).first()[0] or 0
    rates = cut(counts.select("lang", "count", F.least(F.lit(1.0), F.lit(4.0 * most) / F.col("count")).alias("rate")))
    thinned = look_up(narrow, "lang", rates, "count", total, ["draw"]).filter(F.pmod("draw", F.lit(1 << 30)) < F.col("rate") * (1 << 30))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id"))
    chosen = cut(thinned.dropDuplicates(["doc_id", "lang", "text_hash"]).withColumn("rank", rank).filter(F.col("rank") <= most).orderBy("rank", "draw", "lang").limit(most).select("doc_id", "lang", "text_hash"))
    rows = taught.withColumn("text_hash", text_hash).join(F.broadcast(chosen), ["doc_id", "lang", "text_hash"])
    return rows.groupBy("doc_id", "lang", "text_hash").agg(F.min("text").alias("text")).select("lang", "text")


def fit(docs: DataFrame, modulus: int = 5, held: int = 0, most: int = MAX_LABELLED) -> Model:
    taught = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang")).filter("lang IS NOT NULL").filter(remainder("doc_id", modulus) != held)

    def frequencies(batches):
        total, n = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if t and (cells := gram_cells(t)) is not None:
                    total[np.unique(cells)] += 1
                    n += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMENSIONS + 1)), pa.array(np.append(total, n))], names=["cell", "n"])

    df = np.zeros(DIMENSIONS + 1)
    for cell, n in taught.select("text").mapInArrow(frequencies, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect():
        df[cell] = n
    idf = np.log((1 + df[-1]) / (1 + df[:-1])).astype(np.float32) + 1

    def make():
        def step(langs: pa.Array, texts: pa.Array):
            return [langs, [None if c is None else zlib.compress(np.bincount(c, minlength=DIMENSIONS).astype("<u4").tobytes(), 1) for c in (gram_cells(t) if t else None for t in texts.to_pylist())]]

        return step

    table = arrow_map(sampled(taught, most), make, "lang string, cells binary", ["lang", "text"]).filter("cells IS NOT NULL").toArrow()
    by_lang: dict[str, list[bytes]] = {}
    for lang, cells in zip(table["lang"].to_pylist(), table["cells"].to_pylist(), strict=True):
        by_lang.setdefault(lang, []).append(zlib.decompress(cells))
    langs = sorted(by_lang)
    centroids, owner, least = [], [], []
    for k, lang in enumerate(langs):
        x = normalised(np.log1p(np.frombuffer(b"".join(sorted(by_lang[lang])), "<u4").reshape(-1, DIMENSIONS).astype(np.float32)) * idf)
        own = spherical_means(x, CENTROIDS)
        centroids.append(own)
        owner += [k] * len(own)
        least.append(float(np.quantile((x @ own.T).max(1), REJECTED)))
    return Model(langs, idf, np.concatenate(centroids) if langs else np.zeros((0, DIMENSIONS)), np.array(owner), np.array(least))


def predictions(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and rejected of each row."""

    def make():
        def step(ids: pa.Array, texts: pa.Array):
            return [ids, *model.predict(texts.to_pylist())]

        return step

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return arrow_map(rows, make, "doc_id long, lang_pred string, score double, rejected boolean", ["doc_id", "text"])
