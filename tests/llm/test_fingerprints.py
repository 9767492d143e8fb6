import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from monthgrain.llm import simhash, winnowing
from monthgrain.llm.queries import QUERIES


def _gram_hashes(text, gram):
    """By definition, with Python's numbers."""
    c, inverse = [ord(x) for x in text], pow(winnowing.BASE, -1, 1 << 64)
    gram, out = min(gram, len(c)), []
    for i in range(len(c) - gram + 1 if c else 0):
        v = sum((x + 1) * pow(inverse, j, 1 << 64) for j, x in enumerate(c[i : i + gram])) % (1 << 64)
        v = (v ^ v >> 30) * 0xBF58476D1CE4E5B9 % (1 << 64)
        v = (v ^ v >> 27) * 0x94D049BB133111EB % (1 << 64)
        out.append(v ^ v >> 31)
    return out


def test_winnowing_by_definition():
    rng = random.Random(1)
    for n in (0, 1, 5, 11, 12, 13, 63, 64, 200):
        text = "".join(rng.choice("ab😀") for _ in range(n))
        hashes = _gram_hashes(text, 12)
        assert winnowing.gram_hashes(winnowing.np.frombuffer(text.encode("utf-32-le"), np.uint32), 12).tolist() == hashes
        w = min(52, len(hashes))
        chosen = sorted({max(j for j in range(i, i + w) if hashes[j] == min(hashes[i : i + w])) for i in range(len(hashes) - w + 1)}) if hashes else []
        got, at = winnowing.winnow(text)
        assert at.tolist() == chosen and got.tolist() == [hashes[i] for i in chosen]


def test_shared_runs_share_a_hash():
    rng = random.Random(2)
    for _ in range(50):
        shared = "".join(rng.choice("abcdef ") for _ in range(winnowing.GRAM + winnowing.WINDOW - 1))
        a, b = ("".join(rng.choice("abcdef ") for _ in range(rng.randrange(200))) + shared + "".join(rng.choice("xyz") for _ in range(99)) for _ in range(2))
        assert set(winnowing.winnow(a)[0].tolist()) & set(winnowing.winnow(b)[0].tolist())


def _edited_by_definition(rows):
    out = {}
    for k, (i, text) in enumerate(rows):
        following, half = rows[(k + 1) % len(rows)][1], len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        out[i] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), winnowing.printed(*winnowing.winnow(text)), winnowing.printed(*winnowing.winnow(edited)))
    return out


def test_op1_on_whole_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").orderBy(F.desc("doc_id")).collect()
    want = _edited_by_definition([(r.doc_id, r.text or "") for r in docs])
    got = QUERIES["op1_winnowing"](spark, small).collect()
    assert len(got) == len(want)
    for r in got:
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == want[r.doc_id]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_op1_likenesses_by_definition(spark, small):
    """The share of chosen hashes that both texts have, as sets."""
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{small}/documents.parquet").orderBy(F.desc("doc_id")).collect()]
    chosen = lambda text: set(winnowing.winnow(text)[0].tolist())
    share = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    want = {}
    for k, (i, text) in enumerate(rows):
        following, half = rows[(k + 1) % len(rows)][1], len(text) // 2
        want[i] = share(chosen(text), chosen(text[: len(text) - half] + following[:half])), share(chosen(text), chosen(following))
    got = {r.doc_id: (r.near_edited, r.near_next) for r in QUERIES["op1_winnowing"](spark, small).collect()}
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i], abs=1e-12) for i in want)


def test_op1_over_many_ranges(spark, odd, none):
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        rows = [(i * 3, f"text {i} " + "abc" * i) for i in range(60)]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        got = {r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) for r in winnowing.edited_fingerprints(docs).collect()}
        assert got == _edited_by_definition(sorted(rows, reverse=True))
        one = spark.createDataFrame([(9, "alone in the world")], "doc_id long, text string")
        assert winnowing.edited_fingerprints(one).first().near_next == 1.0
        edges = winnowing.edited_fingerprints(odd).collect()
        assert len(edges) == odd.count() and {r.n_chars for r in edges if r.doc_id == 2} == {0}
        assert winnowing.edited_fingerprints(none).isEmpty() and winnowing.fingerprints(none).isEmpty()
        assert winnowing.fingerprints(odd).count() == odd.count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def _simhash(text):
    import re

    import xxhash

    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _classes(pairs, tau):
    """Component of each (id, fingerprint), all against all."""
    parent = {i: i for i, _ in pairs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, fa in pairs:
        for b, fb in pairs:
            if (fa ^ fb).bit_count() <= tau and root(a) != root(b):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {i: root(i) for i, _ in pairs}


def test_op2_on_whole_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    prints = {r.doc_id: _simhash(r.text) for r in docs}
    classes = _classes(list(prints.items()), 4)
    got = QUERIES["op2_simhash"](spark, small).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{p:016x}", classes[i]) for i, p in prints.items()}


def test_all_links_are_found(spark):
    """Dense clusters, chains and runs larger than a chunk, in every plan the thresholds can take."""
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(40)]
    prints = {rng.getrandbits(64) for _ in range(300)}
    for c in centres:
        x = c
        for _ in range(rng.randrange(20)):
            for _ in range(rng.randrange(6)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    pairs = [(i, p) for i, p in enumerate(sorted(prints))]
    want = _classes(pairs, 4)
    nodes = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for _, p in pairs], "fp long")
    for run in (8, 2048):
        edges = simhash.links(nodes, 4, run)
        stars = {r.node: r.root for r in simhash.components(edges).collect()}
        named = {p: stars.get(s := p - (1 << 64) if p >> 63 else p, s) for _, p in pairs}
        groups = {}
        for i, p in pairs:
            groups.setdefault(named[p], set()).add(want[i])
        assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want.values()))


@pytest.mark.parametrize("hub", [simhash.HUB, 3])
def test_components_by_brute_force(spark, hub, monkeypatch):
    """Chains, hubs that are least, greatest and in between, and edges between hubs; keys of many rows broadcast or not."""
    monkeypatch.setattr(simhash, "HUB", hub)
    rng = random.Random(6)
    edges = [(i + 1, i) for i in range(100, 130)] + [(i, 200) for i in range(201, 1900, 2)] + [(5000, i) for i in range(2000, 3500)] + [(6000 + i, 6500) if i > 500 else (6500, 6000 + i) for i in range(900) if i != 500]
    edges += [(rng.randrange(7001, 7400), rng.randrange(7000, 7001 + i)) for i in range(300)] + [(2500, 205)]
    edges = [(max(e), min(e)) for e in edges if e[0] != e[1]]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in list(parent) if root(x) != x}


def test_plans_are_complete():
    """Thresholds plus one add up to tau plus one, and correlated bits share a group."""
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2, (4000, 64))
    bits[:, 40] = bits[:, 3]
    both = bits.T @ bits
    for n in (10, 10**5, 10**8, 10**11):
        groups = simhash.plan(n, both * (n / 4000), 4)
        assert sum(t + 1 for _, t in groups) == 5 and len({b for g, _ in groups for b in g}) == sum(len(g) for g, _ in groups)
        groups = simhash.plan(n, both * (n / 4000), 13)  # thresholds that leave bits to agree, in every group
        assert sum(t + 1 for _, t in groups) == 14 and all(t < len(g) for g, t in groups)
    assert any({3, 40} <= set(g) for g in simhash.group_bits(4000, both, 4))


def test_near_duplicate_edges(spark, odd, none):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    assert {r.component_id for r in got if r.doc_id in (2, 3, 4)} == {2} and {r.fp for r in got if r.doc_id in (2, 3, 4)} == {0}
    assert simhash.near_duplicates(none).isEmpty()
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id or -1, (r.text or "")[:7]) for r in kept.collect()) == sorted([(1, "the qui"), (1, "another"), (2, ""), (5, "word wo"), (-1, "a text "), (6, "ñandú ç"), (7, "line on")])
    assert simhash.drop_near_duplicates(none).isEmpty()
