"""Toxicity, quality and language: parts by brute force, wholes by held-out accuracy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from monthgrain.llm import language, quality, toxicity
from monthgrain.llm.queries import QUERIES


@pytest.fixture(scope="module")
def sample():
    from pathlib import Path

    return str(Path("/root/testdata/sf0.01"))


def _restorer():
    words = "idiot clown trash loser worthless the a a a are you here and with from that this there stupid moron".split()
    rng = random.Random(1)
    counts = np.zeros((toxicity.LETTER_CLASSES,) * 3)
    for _ in range(4000):
        c = toxicity.classes_of(toxicity.codes_of("  " + " ".join(rng.choice(words) for _ in range(4)) + " "))
        np.add.at(counts, (c[:-2], c[1:-1], c[2:]), 1)
    return toxicity.Restorer(toxicity.log_model(counts))


def test_model_rows_are_distributions():
    logp = _restorer().logp
    assert np.allclose(np.exp(logp.astype(float)).sum(2), 1, atol=1e-3)


def test_viterbi_finds_the_best_path():
    from itertools import product

    r = _restorer()
    for raw in ("1d10t", "cl0wn", "tr@sh", "l0ooser", "m.o.r.o.n", "s t u p i d", "a11"):
        best = (float("inf"), "")
        for path in product(*r.readings(raw), [(" ", 0.0)]):
            a = b = 0
            cost = 0.0
            for text, price in path:
                cost += price
                if text:
                    c = int(toxicity.CLASSES[ord(text)])
                    cost -= float(r.logp[a, b, c])
                    a, b = b, c
            best = min(best, (cost, "".join(t for t, _ in path).strip()))
        assert r.decode(raw) == best[1]
    assert [r.decode(x) for x in ("cl0wn", "tr@sh", "looooser", "m o r o n")] == ["clown", "trash", "loser", "moron"]


def test_stretches_and_what_is_left_alone():
    r = _restorer()
    texts = ["a plain text, with 42 and 3.5 and no. 7.", "he is a w0rthless cl0wn", "you are a l o s e r here", "looooser", "", "x", "1d10t"]
    got = r.restored(texts)
    assert got[0] == [] and got[1] == ["worthless", "clown"] and "loser" in " ".join(got[2]).split() and got[3] == ["loser"] and got[4:6] == [[], []] and got[6]


def test_obfuscated_words_score_like_plain_ones(spark):
    rng = random.Random(5)
    clean = "the river ran under an old bridge while people from there were walking along with their bags".split()
    bad = "idiot moron worthless".split()

    def text(toxic):
        words = [rng.choice(clean) + rng.choice(["", "s", "ing", "ed"]) for _ in range(40)]
        if toxic:
            for w in rng.sample(bad, 2):
                words.insert(rng.randrange(len(words)), w)
        return " ".join(words)

    rows = [(i, text(i % 5 == 0), int(i % 5 == 0)) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    scorer = toxicity.Scorer(toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic")))
    plain, hidden, spaced, fine = scorer.scores(["what an idiot he is", "what an 1di0t he is, w0rthless", "such a m o r o n he is", "what a bridge there is 2 walk"])
    assert min(plain, hidden, spaced) >= 0.7 > fine


def _accuracy(spark, sf_dir, name, label):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", label)
    rows = QUERIES[name](spark, sf_dir).join(labels, "doc_id").filter("held_out").toPandas()
    assert rows.score.between(0, 1).all()
    return (rows.predicted == rows[label]).mean(), QUERIES[name]


def test_op3_held_out(spark, sample):
    assert _accuracy(spark, sample, "op3_toxicity", "toxic")[0] >= 0.93


def test_op5_held_out(spark, sample):
    assert _accuracy(spark, sample, "op5_quality", "quality")[0] >= 0.95


def test_op8_held_out(spark, sample):
    docs = spark.read.parquet(f"{sample}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op8_language"](spark, sample).join(docs, "doc_id").filter("held_out").toPandas()
    assert (rows.lang_pred == rows.lang).mean() >= 0.98 and rows.score.between(0, 1).all()


def test_held_out_labels_are_not_used(spark):
    """Turning the labels of held-out rows changes no score."""
    docs = spark.createDataFrame([(i, ("good words here " if i % 2 else "vile slur there ") * (i % 7 + 3)) for i in range(300)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"), (F.col("doc_id") % 2).cast("int").alias("quality"))
    turned = lambda m, r: labels.select("doc_id", *(F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % m == r, 1 - F.col(c)).otherwise(F.col(c)).alias(c) for c in ("toxic", "quality")))
    for module, m, r in ((toxicity, 3, 1), (quality, 5, 0)):
        a, b = (sorted(module.scores(docs, module.fit(docs, x)).collect()) for x in (labels, turned(m, r)))
        assert a == b


def test_trees_by_brute_force():
    rng = np.random.default_rng(4)
    g, h = rng.normal(size=(5, 6)), rng.random((5, 6)) + 0.1
    gain = lambda *s: sum(quality._gain(g[x].sum(), h[x].sum()) for x in s)
    best = max(
        gain((slice(0, r), slice(0, a)), (slice(0, r), slice(a, None)), (slice(r, None), slice(0, b)), (slice(r, None), slice(b, None)))
        for r in range(1, 5) for a in range(1, 6) for b in range(1, 6)
    ) - gain((slice(None), slice(None)))
    assert abs(quality._four_leaves(g, h)[0] - best) < 1e-9
    step = quality._three_leaves(g[0], h[0])
    assert len(np.unique(step)) == 3


def test_pairs_are_learned():
    """A label that only an interaction of two measures explains."""
    rng = np.random.default_rng(2)
    x = rng.random((3000, len(quality.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit_table(x[:2000], y[:2000])
    assert ((model.scores(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.95


def test_measures():
    assert quality.measure("") == quality.measure(None) == quality.measure(" \n ") == (0.0,) * len(quality.FEATURES)
    m = dict(zip(quality.FEATURES, quality.measure("A b b\nA b b\nC1 !!")))
    assert m["repeated_words"] == pytest.approx(1 - 4 / 8) and m["repeated_lines"] == pytest.approx(1 / 3) and m["echoes"] == pytest.approx(2 / 8) and m["signs"] == pytest.approx(2 / 8)


def test_language_cells():
    assert language.gram_cells("12 .. 34") is None and language.gram_cells("") is None
    assert np.array_equal(np.sort(language.gram_cells("Ab, c")), np.sort(language.gram_cells("aB--c")))
    assert len(language.gram_cells("abc")) == 3 + 4 + 3
    assert language.gram_cells("漢字") is not None


def test_far_texts_are_rejected(spark):
    rng = random.Random(3)
    make = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(30))
    rows = [(i, make("abcd" if i % 2 else "efgh"), "x" if i % 2 else "y") for i in range(400)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    langs, scores, rejected = model.predict([make("abcd"), make("efgh"), make("uvwz"), None, "123"])
    assert langs[:2] == ["x", "y"] and langs[3:] == ["und", "und"] and list(rejected) == [False, False, True, True, True] and list(scores[3:]) == [0, 0]
    assert len(model.centroids) == 2 * language.CENTROIDS


def test_edges(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (1, None, 1), (None, 1, 1), (2, 0, 1), (3, 1, 0), (5, 1, 0), (6, 0, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    for docs in (odd, none):
        for lab in (labels, labels.limit(0)):
            assert toxicity.scores(docs, model := toxicity.fit(docs, lab)).count() == docs.count()
            kept = toxicity.keep_clean(docs, model)
            assert kept.columns == docs.columns
            assert quality.scores(docs, quality.fit(docs, lab)).count() == docs.count()
        got = language.predictions(docs, language.fit(docs)).collect()
        assert len(got) == docs.count() and all(r.lang_pred == "und" for r in got if r.doc_id in (2, 3, 4))
