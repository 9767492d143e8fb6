"""The pipeline's near-copy stage against all pairs of whole shingle sets."""

import random

import pytest
from pyspark.sql import functions as F

from monthgrain.llm import simhash


def _firsts(docs):
    """Least id of each group, all against all; docs are (id, text)."""
    sets = []
    for _, text in docs:
        w = (text or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return {min(docs[i][0] for i in range(len(docs)) if root(i) == r) for r in {root(i) for i in range(len(docs))}}


def _edited(rng, words, n):
    words = list(words)
    for at in rng.sample(range(len(words)), n):
        words[at] = f"new{rng.random()}"
    return words


@pytest.mark.parametrize("run", [4, simhash.SET_RUN])
def test_pipeline_stage_by_brute_force(spark, run, monkeypatch):
    """Copies about as alike as the limit, chains of them and groups with many members that aren't alike."""
    import corpus_pipeline

    monkeypatch.setattr(simhash.set_groups, "__defaults__", (*simhash.set_groups.__defaults__[:-1], run))
    rng = random.Random(2)
    docs = []
    for g in range(30):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.choice([4, 12, 60, 300]))]
        docs.append(" ".join(words))
        for _ in range(rng.randrange(12)):
            copy = _edited(rng, words, rng.randrange(max(2, len(words) // 30)))
            words = copy if g % 3 == 0 else words
            docs.append(" ".join(copy))
    docs += ["", None, " \n", "Two Words", "two  words"]
    rng.shuffle(docs)
    docs = list(enumerate(docs))
    kept = dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, spark.createDataFrame(docs, "doc_id long, text string"), "")
    assert {r.doc_id for r in kept.collect()} == _firsts(docs)


def test_pipeline_stage_on_documents(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, docs, "")
    assert {r.doc_id for r in kept.select(F.col("doc_id")).collect()} == _firsts([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("two", [False, True])
@pytest.mark.parametrize("few", [simhash.FEW_KEYS, 0])
def test_hot_signatures_lose_no_link(spark, monkeypatch, two, few):
    """Runs of more than three: groups around a middle, chains away from it, and rows that only share bits. Components are those of all pairs."""
    monkeypatch.setattr(simhash, "FEW_KEYS", few)
    rng = random.Random(8)
    flip = lambda x, k: x ^ sum(1 << b for b in rng.sample(range(64), k))
    rows = set()
    for g in range(6):
        fp, other = rng.getrandbits(64), rng.getrandbits(64)
        for i in range(40 if g < 2 else 12):
            rows.add((flip(fp, rng.randrange(6)), flip(other, rng.randrange(9) if g % 2 else rng.randrange(30))))
            if g % 3 == 0 and i % 5 == 0:
                fp = flip(fp, 3)
    rows |= {(x ^ (1 << 63 if i % 2 else 0), rng.getrandbits(64)) for i, x in enumerate(rng.sample(sorted(r[0] for r in rows), 20))}
    rows = sorted({fp: other for fp, other in rows}.items())
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    nodes = [(signed(fp) if not two else i, signed(fp), signed(other)) for i, (fp, other) in enumerate(rows)]
    tau, other_tau = 5, 12 if two else None
    parent = {n[0]: n[0] for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    linked = 0
    for i, (a, fp, other) in enumerate(nodes):
        for b, fq, oq in nodes[:i]:
            if bin((fp ^ fq) & (2**64 - 1)).count("1") <= tau and (not two or bin((other ^ oq) & (2**64 - 1)).count("1") <= other_tau):
                linked += 1
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    frame = spark.createDataFrame(nodes, "node long, fp long, other long")
    found = simhash.links(frame if two else frame.select("fp"), tau, run=3, other_tau=other_tau).collect()
    for a, b in found:
        assert root(a) == root(b) and a > b
    got = {x: x for x in parent}

    def top(x):
        while got[x] != x:
            x = got[x]
        return x

    for a, b in found:
        ra, rb = top(a), top(b)
        got[max(ra, rb)] = min(ra, rb)
    assert linked > 200 and all(top(x) == root(x) for x in parent)


def test_few_or_many_sets(spark, monkeypatch):
    """Where sets and hashes are too many to be broadcast, the same groups are found."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    few = {r.doc_id for r in simhash.drop_near_copies(docs).select("doc_id").collect()}
    for name in ("FEW_KEYS", "FEW_NODES", "FEW_BYTES"):
        monkeypatch.setattr(simhash, name, 0)
    assert {r.doc_id for r in simhash.drop_near_copies(docs).select("doc_id").collect()} == few and 0 < len(few) < docs.count()
