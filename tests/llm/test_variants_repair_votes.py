"""Spelling variants, conversation repair and quality votes against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from monthgrain.llm import conversations, quality_votes, spelling
from monthgrain.llm.queries import ORACLES, QUERIES

from ..conftest import same_rows


@pytest.mark.parametrize("name", ["op11_spelling", "op12_conversations", "op13_quality_votes"])
def test_query_gives_the_rows_of_its_sql(spark, small, duck, name):
    same_rows(QUERIES[name](spark, small).toPandas(), duck.execute(ORACLES[name]).fetchdf())


# --- spelling ----------------------------------------------------------------------------------------


def _near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_variants_are_all_pairs_within_one_edit(spark):
    """Words made to be near each other in all ways: any letter, repeated letters, long ones, two-byte ones, ties in count."""
    rng = random.Random(5)
    words = {"abcdefg", "abcdefgh", "bcdefgh", "aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "ababababab", "babababab", "éèàçùñü", "éèàçùñ" + "üü", "x" * 5000, "x" * 5001, "x" * 4999 + "yx"}
    for _ in range(60):
        base = "".join(rng.choice("abé") for _ in range(rng.randrange(7, 14)))
        for _ in range(6):
            i = rng.randrange(len(base) + 1)
            words.add(rng.choice([base[:i] + base[i + 1 :], base[:i] + rng.choice("abéz") + base[i:], base[:i] + rng.choice("abéz") + base[i + 1 :], base]))
    counts = {w: rng.choice([2, 2, 3, 19, 20, 21, 199, 200, 2500]) for w in words if len(w) >= 7}
    got = {r.word: r for r in spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}
    assert got.keys() == counts.keys()
    near = {w: [v for v in counts if _near(w, v)] for w in counts}
    forms = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v.encode()), default=None)
        forms[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    assert sum(map(bool, near.values())) > 200 and sum(map(bool, forms.values())) > 50
    chains = Counter()
    for w in counts:
        root, steps = w, 0
        while forms[root]:
            root, steps = forms[root], steps + 1
        chains[steps] += 1
        assert (got[w].n, got[w].n_near, got[w].form, got[w].form_n, got[w].root) == (counts[w], len(near[w]), forms[w], counts.get(forms[w]), root)
    assert len(chains) > 2


def test_words_of_odd_documents(spark, odd, none):
    """Nulls, long runs, capital letters beyond ASCII (which stay), and damage by id and run."""
    rows = [(1, "ÀBCDEFGH abcdefg abcdefg"), (None, "z" * 100_000 + " abc"), (2, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("clash"))
    want = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]{7,}", t or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            at = h % len(run)
            want[run[:at] + run[at + 1 :] if h % 31 == 0 else run] += 1
    assert Counter(r.word for r in spelling.damaged(docs).collect()) == want
    assert spelling.variants(spelling.vocabulary(spelling.damaged(none))).collect() == []
    assert "another" in {r.word for r in spelling.variants(spelling.vocabulary(spelling.damaged(odd.union(odd)))).collect()}
    once = spelling.variants(spelling.vocabulary(spelling.damaged(docs.union(docs))))
    assert once.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_a_hot_half_is_split(spark):
    """All words share their first half and end, so that a chunk alone would bring all pairs together: what is looked at stays few."""
    rng = random.Random(2)
    words = sorted({"common" + "".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(4000)})
    keyed = spelling._keyed(spark.createDataFrame([(w, 2) for w in words], "word string, n long"), True)
    pairs = sum(r["count"] ** 2 for r in keyed.groupBy("key").count().collect())
    assert pairs < len(words) ** 2 / 20


# --- conversations -----------------------------------------------------------------------------------


def _plain(rows):
    """Cheapest edits, least initials: a table of whole initials by state."""
    best = {0: (0, "")}
    for row in rows:
        after = {}
        for state, (cost, audit) in best.items():
            for price, letters, to in conversations.moves(state, row):
                found = (cost + price, audit + letters)
                after[to] = min(after.get(to, found), found)
        best = after
    return min((c + 3 * len(conversations.CLOSING[s]), a + conversations.CLOSING[s]) for s, (c, a) in best.items())


def _all_edits(rows):
    """The same by trying every string of edits up to a length, from the definition alone."""
    best = None
    stack = [(0, 0, "", "")]
    while stack:
        at, cost, audit, roles = stack.pop()
        if best is not None and (cost > best[0] or len(audit) > 2 * len(rows) + 3):
            continue
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            best = min(best or (cost, audit), (cost, audit))
        for role in "ua":
            if cost < 3 * (len(rows) + 2) and len(audit) < 2 * len(rows) + 3 and re.fullmatch("s?(ua)*u?", roles + role):
                stack.append((at, cost + 3, audit + "I", roles + role))
        if at < len(rows):
            row = rows[at]
            stack.append((at + 1, cost + 4, audit + "D", roles))
            if row != "x":
                late = 3 if row.isupper() else 0
                for edit, role, price in [("K", row.lower(), 0), ("R", "u", 3), ("R", "a", 3)]:
                    if re.fullmatch("s?(ua)*u?", roles + role):
                        stack.append((at + 1, cost + price + late, audit + edit, roles + role))
    return best


def test_edits_are_the_cheapest_and_least():
    rng = random.Random(3)
    for i in range(1500):
        rows = bytes(rng.choice(b"xsuaoSUAO" if i % 2 else b"uauaxsUA") for _ in range(rng.randrange(40)))
        assert conversations.solve(rows) == _plain(rows)
    for _ in range(60):
        text = "".join(rng.choice("xsuaoUA") for _ in range(rng.randrange(5)))
        assert conversations.solve(text.encode()) == _all_edits(text)
    long = bytes(rng.choice(b"uauauauaxsUAo") for _ in range(4000))
    assert conversations.solve(long) == _plain(long)


def test_what_is_held_is_a_vector_a_level(monkeypatch):
    """Both vectors meet in the middle at each level: steps are n log n, depth is log n."""
    depth, deepest = 0, 0
    inner = conversations.edits_of

    def counted(*args):
        nonlocal depth, deepest
        depth += 1
        deepest = max(deepest, depth)
        out = inner(*args)
        depth -= 1
        return out

    monkeypatch.setattr(conversations, "edits_of", counted)
    conversations.solve(b"ua" * 2000)
    assert deepest <= 13


def _repair(rows):
    """rows (turn, role, text) in order -> what the query gives, one row at a time."""
    seen, codes, faults = set(), "", Counter()
    for _, role, text in rows:
        body = text.strip(" \t\n\v\f\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        faults[fault] += 1
        code = role[:1] if role[:1] and role[:1] in "sua" else "o"
        codes += "x" if fault in ("blank", "duplicate") else code.upper() if fault else code
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    cost, audit = _plain(codes.encode())
    out, state, at = [], 0, 0
    for edit in audit:
        if edit in "IR":
            state = conversations.ASKED[state]
        if edit == "K":
            state = 1 if rows[at][1][:1] == "s" else conversations.ASKED[state]
        if edit in "KRI":
            out.append((edit, rows[at][1] if edit == "K" else conversations.ROLES[state], "" if edit == "I" else rows[at][2]))
        at += edit != "I"
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults["blank"], faults["duplicate"], faults["truncated"], sum(p not in ("su", "ua", "au") for p in pairs), cost, audit), out


ODD = [
    (1, 0, "user", "Hello."), (1, 1, "assistant", "Hi!"), (1, 1, "assistant", "Hi!"), (1, 4, "user", "cut off"), (1, None, "system", "Be kind."), (1, None, None, "who?"),
    (2, 5, None, None), (2, 6, "user", " \n\t "), (3, 1, "assistant", "First."), (3, 2, "tool", "x"), (3, 2, "", "No role."), (3, 3, "assistant", "First."), (3, 9, "user", "Last?"),
    (None, 1, "user", "Null id."), (None, 2, "assistant", "Yes. \n "), (4, 1, "user", "a" * 200_000), (4, 2, "assistant", "é" * 1000 + "!"), (5, None, "user", "Only."), (6, 1, "user", "A."), (6, 2, "user", "A."), (6, 3, "user", "B."),
]


@pytest.fixture(scope="module")
def talks(spark):
    return spark.createDataFrame(ODD, "conv_id long, turn long, role string, text string").withColumn("key", F.lit("clash")).withColumn("part", F.lit(7))


def test_repair_of_odd_conversations(spark, talks):
    by = defaultdict(list)
    for conv, turn, role, text in ODD:
        by[conv].append((turn, role if role is not None else " ", text if text is not None else " "))
    want = {}
    for conv, rows in by.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        numbers, out = _repair(rows)
        want[conv] = (*numbers, out)
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    got = {r.conv_id: tuple(r[n] for n in names) for r in conversations.structure(talks).collect()}
    assert got == {c: w[:-1] for c, w in want.items()}
    turns = defaultdict(list)
    for r in sorted(conversations.repaired(talks).collect(), key=lambda r: r.place):
        turns[r.conv_id].append((r.edit, r.role, r.text))
    assert {c: turns[c] for c in want} == {c: w[-1] for c, w in want.items()}
    hashes = {r.conv_id: r.repaired_sha256 for r in conversations.digests(talks).collect()}
    assert hashes == {c: hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in w[-1]).encode()).hexdigest() for c, w in want.items()}


def test_conversations_that_lose_all_rows_are_there(spark, talks):
    rows = [(i, 0, "user", "Hi.") for i in range(60)] + [(None, None, "user", "x")]
    one = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in conversations.repair_digests(one).collect()}
    gone = [i for i in range(60) if zlib.crc32(f"{i}:0".encode()) % 20 == 0]
    assert len(got) == 61 and gone
    for i in gone:
        assert tuple(got[i])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    empty = talks.limit(0)
    assert conversations.repair_digests(empty).collect() == [] and conversations.repaired(empty).collect() == []


def test_a_very_long_conversation_streams(spark):
    """One conversation of most rows: the same edits as by the plain table."""
    rng = random.Random(9)
    rows = [(1, i, rng.choice(["user", "assistant", "user", "assistant", "system"]), rng.choice(["Yes.", "No", f"Number {i}.", ""])) for i in range(3000)]
    talk = spark.createDataFrame(rows + [(2, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in conversations.structure(talk).collect()}
    assert (got[1].cost, got[1].audit) == _repair([r[1:] for r in rows])[0][-2:]


# --- quality votes -----------------------------------------------------------------------------------


def slow_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup, n_lines, ended = set(), 0, 0, 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            n_lines += 1
            dup += line in seen
            seen.add(line)
            ended += line.rstrip(" \t\n\v\f\r")[-1] in '.!?:"'
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered |= set(range(i, i + 8))
    letters = [c for c in text if c.isalpha()]
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), n_lines, sum(any(c.isalpha() for c in w) for w in words), ended, sum(c.isupper() for c in letters), len(letters)]


def test_counts_by_definition(spark, odd):
    phrase = "a b c d e f g h "
    texts = ["", None, " \n\t ", phrase * 5, "x", "\n\n.\n.\n", "é è b", "\x1c a b", phrase + "i " + phrase, "𝔸 b ℵ", phrase[:-2] + " z " + phrase, "a " * 30, "#$ <a> |\n#$ <a> |\r\nB!"]
    assert quality_votes.counts_of([t or "" for t in texts]) == [slow_counts(t) for t in texts]
    docs = {i: t for i, t in enumerate(texts)}
    got = quality_votes.counted(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: list(r)[1:] for r in got} == {i: slow_counts(t) for i, t in docs.items()}
    assert sorted(map(str, quality_votes.counted(odd).collect())) == sorted(map(str, quality_votes.counted(odd.select("text", "doc_id")).collect()))


def slow_votes(counts):
    x = dict(zip(quality_votes.COUNTS, counts, strict=True)) | {"one": 1}
    out = []
    for r in quality_votes.RULES:
        part, of = x[r.part], x[r.of]
        if of == 0 or x["n_words"] == 0:
            out.append(-1)
        elif r.good < r.bad:
            out.append(0 if part * 1000 >= of * round(r.bad * 1000) else 1 if part * 1000 <= of * round(r.good * 1000) else -1)
        else:
            out.append(0 if part * 1000 <= of * round(r.bad * 1000) else 1 if part * 1000 >= of * round(r.good * 1000) else -1)
    return out


def slow_fit(rows):
    """Expectation-maximisation document by document, in plain loops."""
    sure = [0.1 if 0 in v else 0.9 if 1 in v else 0.5 for v in rows]
    for _ in range(quality_votes.STEPS):
        prior = (sum(sure) + 1) / (len(rows) + 2)
        a, b = [], []
        for j in range(len(rows[0])):
            up = sum(p for p, v in zip(sure, rows, strict=True) if v[j] == 1)
            down = sum(1 - p for p, v in zip(sure, rows, strict=True) if v[j] == 0)
            a.append((up + 8) / (sum(p for p, v in zip(sure, rows, strict=True) if v[j] >= 0) + 10))
            b.append((down + 8) / (sum(1 - p for p, v in zip(sure, rows, strict=True) if v[j] >= 0) + 10))
        after = []
        for v in rows:
            good, bad = prior, 1 - prior
            for x, p, q in zip(v, a, b, strict=True):
                good, bad = (good * p, bad * (1 - q)) if x == 1 else (good * (1 - p), bad * q) if x == 0 else (good, bad)
            after.append(good / (good + bad))
        moved, sure = max(abs(x - y) for x, y in zip(sure, after, strict=True)), after
        if moved < 1e-9:
            break
    return sure


def test_op13_by_plain_loops(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    counts = {r.doc_id: slow_counts(r.text) for r in docs}
    ids = sorted(counts)
    sure = dict(zip(ids, slow_fit([slow_votes(counts[i]) for i in ids]), strict=True))
    got = {r.doc_id: r for r in QUERIES["op13_quality_votes"](spark, small).collect()}
    assert got.keys() == counts.keys()
    for i in ids:
        r, c = got[i], counts[i]
        failed = c[0] < 20 or 100 * c[4] > 30 * c[0]
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] == c[:5] and r.base_failed == failed
        assert r.probability == pytest.approx(sure[i], abs=1e-5)
        if abs(sure[i] - 0.5) > 1e-6:
            assert r.kept == (not failed and sure[i] >= 0.5)


def test_votes_against_labels_that_no_rule_has_seen(spark):
    """Of labelled documents that the base doesn't reject, nearly all good ones are kept and nearly all bad ones are not."""
    data = "/root/testdata/sf0.01"
    judged = quality_votes.judged(spark.read.parquet(f"{data}/documents.parquet")).filter("NOT base_failed")
    rows = judged.join(spark.read.parquet(f"{data}/labels.parquet").filter("quality IS NOT NULL"), "doc_id").select("quality", "kept").collect()
    good, bad = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1


def test_loose_rules_are_found_out():
    """Votes of rules of known accuracy: they are estimated, and the posterior errs less than the rules' majority."""
    rng = np.random.default_rng(1)
    n, truth_good, truth_bad = 20_000, [0.95, 0.9, 0.9, 0.6, 0.6, 0.6], [0.9, 0.85, 0.8, 0.55, 0.55, 0.55]
    is_good = rng.random(n) < 0.8
    votes = []
    for a, b in zip(truth_good, truth_bad, strict=True):
        right = np.where(is_good, rng.random(n) < a, rng.random(n) < b)
        votes.append(np.where(rng.random(n) < 0.2, -1, np.where(right, is_good, ~is_good).astype(int)))
    rows = np.stack(votes, 1)
    patterns = Counter(map(tuple, rows.tolist()))
    model = quality_votes.fit([(list(v), c) for v, c in patterns.items()])
    assert np.abs(np.array(model.on_good) - truth_good).max() < 0.04 and np.abs(np.array(model.on_bad) - truth_bad).max() < 0.06 and abs(model.prior - 0.8) < 0.03
    sure = {v: model.probability(list(v)) for v in patterns}
    by_model = np.mean([(sure[tuple(v)] >= 0.5) == g for v, g in zip(rows.tolist(), is_good, strict=True)])
    majority = np.mean([((v == 1).sum() >= (v == 0).sum()) == g for v, g in zip(rows, is_good, strict=True)])
    assert by_model > majority + 0.01


def test_votes_on_nothing(spark, odd, none):
    assert quality_votes.judged(none).collect() == []
    got = quality_votes.judged(odd)
    assert got.count() == odd.count() and got.filter("kept AND n_words < 20").count() == 0
    assert all(v == -1 for r in got.filter("n_words = 0").collect() for v in r.votes)
    assert quality_votes.fit([]).prior == 0.5
