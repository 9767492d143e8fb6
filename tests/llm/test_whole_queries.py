"""The learned queries' whole results against plain loops over the collected tables."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from monthgrain.llm import language, quality, toxicity
from monthgrain.llm.queries import QUERIES, labels

from .test_hidden_words import _found

SAMPLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SAMPLE}/documents.parquet").collect()]
    return docs, {r.doc_id: r for r in spark.read.parquet(f"{SAMPLE}/labels.parquet").collect()}


def _crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def test_op3(spark, tables):
    docs, marks = tables
    model = toxicity.fit(spark.read.parquet(f"{SAMPLE}/documents.parquet"), labels(spark, SAMPLE))
    restorer, letters = toxicity.Restorer(model.logp), re.compile(r"[^\W\d_]+")
    full = {d: " ".join([(t or "").lower(), *restorer.restored([(t or "").lower()])[0]]) for d, t, _ in docs}
    taught = {d: int(marks[d].toxic) for d, _, _ in docs if d in marks and marks[d].toxic is not None and _crc(d) % 3 != 1}

    def features(text):
        out, words = {}, letters.findall(text)
        for i, w in enumerate(words):
            around = (words[i - 1] if i else "", words[i + 1] if i + 1 < len(words) else "")
            for f in ["=" + w, *(w[:k] + "*" for k in (4, 5, 6) if len(w) > k)]:
                out.setdefault(f, around)
        return out

    toxic, clean = defaultdict(set), Counter()
    for d, bad in taught.items():
        for f, around in features(full[d]).items():
            toxic[f].add(around) if bad else clean.update([f])
    share = sum(taught.values()) / len(taught)
    least, tested = toxicity.frequent_enough(dict(Counter(map(len, toxic.values()))), share)
    weights = {}
    for f, arounds in toxic.items():
        k = len(arounds)
        n = k + clean[f]
        p = (k + 0.5) / (n + 1)
        if k >= least and p > max(0.9, share) and k * math.log(p / share) + (n - k) * math.log((1 - p) / (1 - share)) > math.log(tested):
            weights[f] = p
    assert weights and weights.keys() == model.weights.keys() and all(model.weights[f] == pytest.approx(p) for f, p in weights.items())

    hidden, written = toxicity.Hidden([f[1:] for f in weights if f[0] == "="]), defaultdict(list)
    found = {d: _found(hidden, (t or "").lower()) for d, t, _ in docs}
    for d, bad in taught.items():
        for w in {w for _, w in found[d]}:
            written[w].append(bad)
    ordinary = {w for w, b in written.items() if sum(b) < len(b) and (sum(b) + 0.5) / (len(b) + 1) <= 0.9}
    want = {}
    for d, t, _ in docs:
        there = set()
        for w in letters.findall(full[d]):
            there |= {"=" + w, *(w[:k] + "*" for k in (4, 5, 6) if len(w) >= k)}
        for word, how in found[d]:
            if how not in ordinary:
                there |= features(word).keys()
        clean_chance = 1 - 0.5 * share / (1 + sum(taught.values()))
        for f in there & weights.keys():
            clean_chance *= 1 - weights[f]
        want[d] = 1 - clean_chance
    got = {r.doc_id: r for r in QUERIES["op3_toxicity"](spark, SAMPLE).collect()}
    assert got.keys() == want.keys()
    for d, score in want.items():
        assert got[d].score == pytest.approx(score, abs=1e-9) and got[d].predicted == (score >= 0.7) and got[d].held_out == (_crc(d) % 3 == 1)


def test_op5(spark, tables):
    docs, marks = tables
    rows = [[float(marks[d].quality), *quality.measure(t)] for d, t, _ in docs if d in marks and marks[d].quality is not None and _crc(d) % 5 != 0]
    table = np.array(rows)
    table = table[np.lexsort(table.T)]
    table = table[np.random.default_rng(7).permutation(len(table))]
    model = quality.fit_table(table[:, 1:], table[:, 0])
    got = {r.doc_id: r for r in QUERIES["op5_quality"](spark, SAMPLE).collect()}
    assert len(got) == len(docs)
    for d, t, _ in docs:
        bins = [sum(e <= x for e in edges) for x, edges in zip(quality.measure(t), model.edges)]
        total = model.base + sum(model.single[j][b] for j, b in enumerate(bins)) + sum(pair[bins[i]][bins[j]] for i, j, pair in model.pairs)
        score = 1 / (1 + math.exp(-max(-30, min(30, total))))
        assert got[d].score == pytest.approx(score, abs=1e-9) and got[d].predicted == (score >= 0.3) and got[d].held_out == (_crc(d) % 5 == 0)


def _cells(text):
    """Cells of the n-grams of a text, character by character."""
    signs = [c.lower()[0] if c.isalpha() and ord(c) < 0x3000 else c if c.isalpha() else None for c in text or ""]
    if not any(signs):
        return None
    framed = re.sub(" +", " ", "".join(c or " " for c in signs))
    codes = [32, *map(ord, framed), 32]
    a, b, m = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, (1 << 64) - 1
    one = [(c + 1) * a & m for c in codes]
    two = [((x ^ x >> 29) * b + y) & m for x, y in zip(one, one[1:])]
    three = [((x ^ x >> 31) * b + y) & m for x, y in zip(two, one[2:])]
    return Counter(((g ^ g >> 32) * b & m) >> 52 for g in [*one[1:-1], *two, *three])


def test_op8(spark, tables):
    docs, _ = tables
    counts = {d: _cells(t) for d, t, _ in docs}
    taught = [(d, lang) for d, _, lang in docs if lang is not None and _crc(d) % 5 != 0 and counts[d]]
    frequency = Counter(c for d, _ in taught for c in counts[d])
    idf = np.array([math.log((1 + len(taught)) / (1 + frequency[c])) + 1 for c in range(language.DIMENSIONS)], np.float32)

    def vector(cells):
        v = np.zeros(language.DIMENSIONS, np.float32)
        for c, n in cells.items():
            v[c] = math.log1p(n)
        return v * idf / np.linalg.norm(v * idf)

    centroids = {}
    for lang in sorted({x for _, x in taught}):
        own = sorted((np.array([counts[d][c] for c in range(language.DIMENSIONS)], "<u4").tobytes(), d) for d, x in taught if x == lang)
        centroids[lang] = language.spherical_means(np.stack([vector(counts[d]) for _, d in own]), language.CENTROIDS)
    got = {r.doc_id: r for r in QUERIES["op8_language"](spark, SAMPLE).collect()}
    assert len(got) == len(docs)
    apart = 0
    for d, _, _ in docs:
        assert got[d].held_out == (_crc(d) % 5 == 0)
        if counts[d] is None:
            assert (got[d].lang_pred, got[d].score) == ("und", 0)
            continue
        close = sorted(((max(float(c @ vector(counts[d])) for c in cs), lang) for lang, cs in centroids.items()), reverse=True)
        (top, lang), (second, _) = close[:2]
        if top - second > 1e-4:
            apart += 1
            assert got[d].lang_pred == lang and got[d].score == pytest.approx(top / (top + max(second, 0)), abs=1e-4)
    assert apart > 0.9 * len(docs)


def test_every_language_is_learned(spark):
    """Of a table much larger than the sample a rare language still gets its centroids."""
    rows = [(i, f"word number {i} of the common tongue", "com") for i in range(3000)] + [(5000 + i, f"raro idioma ñandú {i}", "rar") for i in range(6)] + [(None, "x", "non"), (1, "word", None)]
    taught = spark.createDataFrame(rows, "doc_id long, text string, lang string").filter("lang IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "lang", "text")
    chosen = Counter(r.lang for r in language.sampled(taught, 100).collect())
    assert chosen == {"com": 94, "rar": 6}
    copies = spark.createDataFrame([(7, "xx", f"same text {i % 2}") for i in range(500)], "doc_id long, lang string, text string")
    assert sorted(r.text for r in language.sampled(copies, 100).collect()) == ["same text 0", "same text 1"]
