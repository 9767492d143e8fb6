"""Mixing, line dedup and decontamination against brute force and SQL."""

import random
import re

import pytest
from pyspark.sql import functions as F

from monthgrain.llm import decontamination, line_chunks, mixing
from monthgrain.llm.queries import ORACLES, QUERIES

from ..conftest import same_rows


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_the_rows_of_its_sql(spark, small, duck, name):
    same_rows(QUERIES[name](spark, small).toPandas(), duck.execute(ORACLES[name]).fetchdf())


def test_native_queries_run_no_python(spark, small):
    for name in ("op4_mixing", "op10_line_chunks"):
        plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def _filled(sizes, weights, cap):
    """Targets by pouring: what a full source can't take goes to the others by weight."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, rest, open_ = dict.fromkeys(sizes, 0.0), float(sum(sizes.values())), set(sizes)
    while open_ and rest > 1e-9:
        total, poured = sum(weight[s] for s in open_), 0.0
        for s in list(open_):
            add = min(rest * weight[s] / total, cap * sizes[s] - target[s])
            target[s] += add
            poured += add
        rest -= poured
        open_ = {s for s in open_ if target[s] < cap * sizes[s] - 1e-9}
    return target


def test_targets_by_pouring(spark):
    rng = random.Random(1)
    for n in (1, 2, 3, 7, 12):
        sizes = {(f"s{i:02d}" if i else None): rng.choice([0, 1, 10, 100, 5000]) for i in range(n)}
        got = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
        want = _filled(sizes, mixing.WEIGHTS, 3)
        assert {r.source: pytest.approx(r.target, abs=1e-3) for r in got} == want


def test_mix_meets_its_targets(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(1, 60), rng.choice("aaaaaabcd")) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    size = mixing.word_count(F.col("text"))
    decided = mixing.decide(docs, size).collect()
    for s in "abcd":
        own = [r for r in decided if r.source == s]
        assert abs(sum(r.copies * r.size for r in own) - own[0].target) <= 60 and max(r.copies for r in own) <= 3
    again = mixing.decide(docs.repartition(7), size).collect()
    assert sorted(again) == sorted(decided)
    mixed = mixing.mix(docs, size)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in decided)
    weighted = {r.doc_id: r for r in mixing.decide(docs, size, weight=F.when(F.col("doc_id") % 2 == 0, 3.0).otherwise(1.0)).collect()}
    for s in "abcd":
        own = [r for r in weighted.values() if r.source == s]
        rate = [sum(r.copies for r in own if r.doc_id % 2 == k) / sum(1 for r in own if r.doc_id % 2 == k) for k in (0, 1)]
        assert rate[0] > 1.3 * rate[1]
        if own[0].target < 1.8 * own[0].source_size:  # no document is expected over the cap
            assert abs(sum(r.copies * r.size for r in own) - own[0].target) <= 60


def test_inclusion_is_fair(spark):
    """Over many seeds every document is taken about as often as its expectation."""
    docs = spark.createDataFrame([(i, "w " * (i % 5 + 1), "a" if i < 30 else "b") for i in range(60)], "doc_id long, text string, source string")
    taken = {}
    for seed in range(12):
        for r in mixing.decide(docs, mixing.word_count(F.col("text")), seed=f"s{seed}").collect():
            taken.setdefault(r.source, []).append((r.copies, r.target / r.source_size))
    for pairs in taken.values():
        assert sum(c for c, _ in pairs) / len(pairs) == pytest.approx(pairs[0][1], rel=0.1)


def test_inclusion_follows_weights(spark):
    """Over many seeds each weight class is taken about as often as its pi says."""
    docs = spark.createDataFrame([(i, "w w w", "a" if i < 300 else "b", float(i % 4 + 1)) for i in range(400)], "doc_id long, text string, source string, importance double").cache()
    taken, want = {}, {}
    for seed in range(16):
        rows = mixing.decide(docs, mixing.word_count(F.col("text")), weight=F.col("importance"), seed=f"s{seed}").collect()
        for r in rows:
            taken.setdefault((r.source, r.doc_id % 4), []).append(r.copies)
            if r.source == "a":
                want[r.source, r.doc_id % 4] = min(3.0, (r.doc_id % 4 + 1) * r.target / (3 * sum(i % 4 + 1 for i in range(300))))
    for key, expected in want.items():
        got = taken[key]
        assert sum(got) / len(got) == pytest.approx(expected, abs=0.05), (key, expected)


def test_mix_with_equal_documents(spark):
    """Where the last one that is taken has its equals, as many of them are taken as fit."""
    docs = spark.createDataFrame([(None, "w w", "a")] * 50 + [(i, "w w", "b") for i in range(50)], "doc_id long, text string, source string")
    size = mixing.word_count(F.col("text"))
    decided = mixing.decide(docs, size)
    for s in "ab":
        assert mixing.mix(docs, size).filter(F.col("source") == s).count() == decided.filter(F.col("source") == s).agg(F.sum("copies")).first()[0]


def test_mixing_edges(spark, odd, none):
    size = mixing.word_count(F.col("text"))
    decided = mixing.decide(odd, size)
    assert decided.count() == odd.count() and decided.filter("size = 0 AND copies > 0").isEmpty()
    assert mixing.mix(odd, size).columns == odd.columns
    assert mixing.decide(none, size).isEmpty() and mixing.mix(none, size).isEmpty()


def _lines(text):
    """Lines by a walk over the words: a line ends after a line break, a sentence, or so many words."""
    out, line, words = [], "", 0
    for word in re.findall(r"[^ \n]*[ \n]?", text):
        line, words = line + word, words + 1
        if not word:
            break
        if word[-1] == "\n" or words == line_chunks.LINE_WORDS or (word[-1] == " " and len(word) > 1 and word[-2] in ".!?"):
            out.append(line)
            line, words = "", 0
    return out + [line] * (line != "")


def _dedup(docs):
    """Line dedup by definition: (id, text, lines removed) of each row."""
    import hashlib
    from collections import Counter

    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    split = [None if t is None else _lines(t) for _, t in docs]
    times = Counter(x for lines in split if lines for x in lines)
    chunks = []
    for row, lines in enumerate(split):
        n = [times[x] for x in lines or []]
        stretch = []
        for i, x in enumerate(lines or []):
            if n[i] < 2:
                stretch = []
                continue
            changes = i > 1 and i + 1 < len(n) and n[i - 2] == n[i - 1] != n[i] == n[i + 1] and n[i - 1] > 1
            if not stretch or changes:
                stretch = []
                chunks.append((row, stretch))
            stretch.append(i)
    pieces = []
    for row, stretch in chunks:
        h = [int(md5(split[row][i])[:15], 16) % line_chunks.MODULUS for i in stretch]
        r = [sum(h[p - k] * (line_chunks.BASE**k % line_chunks.MODULUS) for k in range(line_chunks.WINDOW) if p >= k) % line_chunks.MODULUS for p in range(len(h))]
        cut = [p + 1 for p in range(1, len(r) - 2) if r[p - 1] > r[p] < r[p + 1]]
        for a, b in zip([0, *cut], [*cut, len(stretch)]):
            if b - a > 1:
                pieces.append((row, stretch[a:b], "".join(split[row][i] for i in stretch[a:b])))
    place = lambda row, own: (docs[row][0] is None, docs[row][0] or 0, md5(docs[row][1]), own[0])
    first = {}
    for row, own, content in pieces:
        first[content] = min(first.get(content, place(row, own)), place(row, own))
    gone = {(row, i) for row, own, content in pieces if place(row, own) != first[content] for i in own}
    return [(i, t if t is None else "".join(x for k, x in enumerate(split[row]) if (row, k) not in gone), sum(r == row for r, _ in gone)) for row, (i, t) in enumerate(docs)]


def test_line_dedup_by_definition(spark, odd, none):
    rng = random.Random(4)
    pool = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 5) for _ in range(rng.choice([2, 6, 9, 45]))) + rng.choice(["", ".", "!", ". "]) for _ in range(30)]
    passage = [pool[i] for i in range(1, 13)]
    docs = []
    for i in range(200):
        lines = [" ".join(rng.choice(pool).split()[:1]) + str(rng.random()) for _ in range(rng.randrange(6))]
        at = rng.randrange(len(lines) + 1)
        lines[at:at] = passage[rng.randrange(4) :] if i % 3 == 0 else [rng.choice(pool) for _ in range(rng.randrange(4))] if i % 3 == 1 else []
        docs.append((i // 2 if i % 10 == 0 else i, rng.choice("\n  ").join(lines)))
    docs += [(None, docs[0][1]), (900, None), (901, ""), (7, docs[7][1]), (902, "\n\n"), (903, "\t. ? \n.\n\r\n ."), (904, "same. " * 50 + "x" * 5000), (905, "same. " * 50), (906, "a." * 50_000 + "\n" + "b! c" * 9000), (907, "x" * 300_000 + " " + "." * 99_999)]
    got = line_chunks.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"))
    key = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")
    assert sorted(((r.doc_id, r.text, r.removed_lines) for r in got.collect()), key=key) == sorted(_dedup(docs), key=key)
    assert got.agg(F.sum("removed_lines")).first()[0] > 100
    assert line_chunks.dedup_lines(odd).count() == odd.count() and line_chunks.dedup_lines(none).isEmpty()


def test_hash_of_several_lines(spark, monkeypatch):
    """Where a hash stands for several lines, none of them is taken for another: they are left alone."""
    plain = line_chunks._line_hash
    monkeypatch.setattr(line_chunks, "_line_hash", lambda line: F.when(line.startswith("one") | line.startswith("other"), F.lit(7).cast("long")).otherwise(plain(line)))
    docs = [(i, f"begin{i} here.\n" + ("one line\ntwo lines\nthree\n" if i % 2 else "other line\ntwo lines\nthree\n") + f"end {i}") for i in range(6)]
    got = line_chunks.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    want = {i: t if i == 0 else t.replace("two lines\nthree\n", "") for i, t in docs}
    assert {r.doc_id: r.text for r in got} == want


def test_repeated_passages_go(spark):
    """0.9 or more of the words of passages of over 50 words go from all but their first document, in every form
    of several lines or sentences, next to other text and to other repeated passages."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 8)))
    for lines, words, mark in ((25, 8, "\n"), (12, 5, "\n"), (8, 8, "\n"), (6, 12, ". "), (5, 15, "\n"), (4, 19, ". "), (3, 22, "\n"), (1, 90, "\n")):
        docs, inside = [], 0
        for p in range(40):
            passage = "".join(" ".join(word() for _ in range(words)) + mark for _ in range(lines))
            for copy in range(3):
                before, after = ("".join(" ".join(word() for _ in range(9)) + "\n" for _ in range(rng.randrange(1, 5))) for _ in range(2))
                docs.append((len(docs), before + passage + after))
                inside += copy > 0
        got = line_chunks.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"))
        removed = sum(len(t.split()) for _, t in docs) - sum(len(r.text.split()) for r in got.collect())
        assert removed >= 0.9 * inside * lines * words, (lines, words, removed / (inside * lines * words))


def test_distance_by_definition():
    def plain(p, t):
        row = [0] * (len(t) + 1)
        for i, x in enumerate(p):
            new = [i + 1]
            for j, y in enumerate(t):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
            row = new
        return min(row)

    rng = random.Random(3)
    for _ in range(400):
        p, t = ([rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(a, 14))] for a in (1, 0))
        assert decontamination.distance_within(p, t)[0] == plain(p, t)


def test_recall_of_edited_items(spark, small):
    """At least 0.99 of items with up to a fifth of their words edited are found, and nothing in clean texts."""
    rng = random.Random(7)
    items = [r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    other = [w for r in spark.read.parquet(f"{small}/documents.parquet").limit(40).collect() for w in r.text.split()]
    index = decontamination.Index(list(range(len(items))), items)
    texts, want = [], []
    for k in range(600):
        words = items[k % len(items)].split()
        n = len(decontamination.words_of(items[k % len(items)]))
        for _ in range(rng.randrange(int(0.2 * n) + 1)):
            at, how = rng.randrange(len(words)), rng.randrange(3)
            words[at : at + (how != 1)] = [] if how == 2 else [rng.choice(other)]
        a = rng.randrange(len(other) - 400)
        texts.append(" ".join(other[a : a + rng.randrange(99)] + words + other[a + 200 : a + 200 + rng.randrange(99)]))
        want.append(k % len(items))
    found = index.matches(texts)
    exact = [decontamination.distance_within(index.words[w], decontamination.words_of(t))[0] <= int(0.2 * len(index.words[w])) for w, t in zip(want, texts, strict=True)]
    hits = sum(w in f for w, f, e in zip(want, found, exact, strict=True) if e)
    assert hits / sum(exact) >= 0.99
    assert not any(index.matches([" ".join(rng.choice(other) for _ in range(300)) for _ in range(50)]))


def test_op7_finds_every_verbatim_item(spark, small):
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    want = {(d, i) for d, t in docs for i, x in items if x in t}
    got = QUERIES["op7_decontamination"](spark, small).collect()
    assert want and want <= {(r.doc_id, r.item_id) for r in got}
    words = {d: decontamination.words_of(t) for d, t in docs}
    for r in got:
        item = decontamination.words_of(dict(items)[r.item_id])
        assert decontamination.distance_within(item, words[r.doc_id])[0] <= r.distance <= 0.2 * len(item)


def test_decontamination_edges(spark, odd, none):
    items = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog"), (2, None), (3, ""), (4, "too short"), (None, "quick brown fox jumps over the lazy dog"), (6, "word " * 500)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.matches(odd, items).collect()}
    assert got == {(1, 1), (1, None), (5, 6)}  # (4, "too short") is in no text
    kept = decontamination.keep_clean(odd, items)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 3
    assert decontamination.matches(none, items).isEmpty() and decontamination.matches(odd, items.limit(0)).isEmpty()
    assert decontamination.keep_clean(odd, items.limit(0)).count() == odd.count()
    slices = list(decontamination.item_slices(items, 10))
    assert len(slices) > 1 and sum(len(i) for i, _ in slices) == 6
    several = {(r.doc_id, r.item_id) for r in decontamination.matches(odd, items, most=10).collect()}
    assert several == got and sorted(map(str, decontamination.keep_clean(odd, items, most=10).collect())) == sorted(map(str, kept.collect()))


def test_short_items_are_found_word_for_word(spark):
    rng = random.Random(11)
    items = [(n, " ".join(rng.choice("abc") for _ in range(n % 4 + 1))) for n in range(12)] + [(20, "Left, right!"), (21, "?!")]
    docs = [(i, " ".join(rng.choice("abcde") for _ in range(rng.randrange(12)))) for i in range(60)] + [(60, "to the left right"), (61, None)]
    got = {(r.doc_id, r.item_id, r.distance, r.item_words) for r in decontamination.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    clean = {i: f" {re.sub('[^a-z]+', ' ', t.lower()).strip()} " for i, t in items}
    assert got == {(d, i, 0, len(x.split())) for d, t in docs for i, x in clean.items() if x.strip() and x in f" {t} "}


def test_very_long_items():
    """An item of 20,000 words with 5,000 different ones needs little memory, and is found with edits all over."""
    import tracemalloc

    rng = random.Random(12)
    long = [f"w{rng.randrange(5000)}" for _ in range(20_000)]
    tracemalloc.start()
    index = decontamination.Index([1, 2], [" ".join(long), " ".join(long[:300])])
    assert tracemalloc.get_traced_memory()[1] < 40_000_000
    tracemalloc.stop()
    copy = [f"new{i}" if rng.random() < 0.1 else w for i, w in enumerate(long)]
    found = index.matches([" ".join(["x"] * 50 + copy + ["y"] * 50), " ".join(long[5000:9000])])
    assert set(found[0]) == {0, 1} and not found[1] and found[0][0][0] == sum(w[0] == "n" for w in copy)
