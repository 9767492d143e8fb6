"""Toxicity of deobfuscated text.

Writing meant to slip past word lists is taken as the output of a noisy channel: letters swapped for
look-alike signs, letters spaced out, letters repeated. Stretches of text that may be so written span
a lattice of readings (a sign may stand for letters or for itself, a repeated letter for one or two,
a gap between single letters for a gap or nothing); Viterbi decoding under a character trigram model
of the corpus picks the likeliest one. All other text has a single reading, itself.

Learned words are also looked for in every reading, whatever the model thinks of it: of any word with a
sign or a letter twice in a row, and of any run of pieces of one to three letters with gaps of any
length between. A writing that the labelled rows show to be an ordinary one ("looser") is left out.

What is scored is the text with its restored stretches. Evidence are words and word beginnings that
labelled rows show to go with the label: in how many toxic texts one occurs, where texts in which it
first occurs between the same two words count once (so copies do), against how many clean texts have
it. A feature is kept if that is far from chance (a likelihood ratio beyond what as many random
features would reach, counting those that are frequent enough to reach it at all) and nearly all of its
occurrences are toxic. Features are counted, joined and tested as a table; only kept ones are collected. A text's score is the chance that
at least one of the features found in it is right, on top of the rate among texts without any.

Labels are read from at most MAX_LABELLED rows, those of the least hash of doc_id; the character
model counts all texts.

Defined cases: null and empty texts get the base rate; very long texts are read whole; labels of null
rows are not used; a doc_id labelled more than once is toxic if one label says so, and of several rows
with a labelled id the one of the least hash teaches; equally likely readings give the one found first;
if there are no labelled rows (an empty table, say), or none is toxic, the base rate is 0 and all scores
are; repeated ids and rows are scored each; other columns pass through `keep_clean` and are ignored by
`scores`.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, cut, remainder, sliced

MAX_LABELLED = 10_000
THRESHOLD = 0.7
#: A feature is kept if chance would give less than 1 / MARGIN features like it.
MARGIN = 1.0
MIN_PRECISION = 0.9
#: What signs commonly stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e"}
GAPS = " .-_*"
#: Log costs of a sign read as a letter, as itself, of a repeat or gap left out, and of one kept.
SIGN_AS_LETTER, SIGN_AS_SIGN, SKIP, KEEP = 0.7, 3.0, 0.1, 1.0
LETTER_CLASSES = 64
WORDS = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6)
_MARK = f"(?:[^\\W\\d_]|[{re.escape(''.join(LEET))}])"
TOKENS = re.compile(_MARK + "+")
ODD = re.compile(rf"[{re.escape(''.join(LEET))}]|(.)\1")


def _class_table() -> np.ndarray:
    """Classes of the character model: 0 for all that is no letter, a-z, Latin-1 letters, other letters."""
    table = np.zeros(0x110000 >> 4, np.uint8)  # letters beyond are all `other`
    for i, c in enumerate("abcdefghijklmnopqrstuvwxyz"):
        table[ord(c)] = i + 1
    for i in range(0xDF, 0x100):
        if i != 0xF7:
            table[i] = 27 + i - 0xDF
    for i in range(0x100, 0x3000):
        if chr(i).isalpha():
            table[i] = 61
    return table


CLASSES = _class_table()
_SIGN, _GAP = np.zeros(256, bool), np.zeros(256, bool)
_SIGN[[ord(c) for c in LEET if ord(c) < 256]] = True
_GAP[[ord(c) for c in GAPS]] = True


def _mark_table() -> np.ndarray:
    """Which characters can be part of a word: letters and look-alikes."""
    table = np.zeros(0x110000, bool)
    table[[ord(c) for c in re.findall(_MARK, "".join(map(chr, range(0x110000))))]] = True
    return table


def _alike_table() -> np.ndarray:
    """Each character as one of those that it may be read as, or be confused with by way of a sign."""
    table = np.arange(0x110000, dtype=np.uint32)
    for sign, letters in LEET.items():
        for c in letters:
            low, high = sorted((table[ord(letters[0])], table[ord(c)]))
            table[table == high] = low
        table[ord(sign)] = table[ord(letters[0])]
    return table


MARKS, ALIKE = _mark_table(), _alike_table()


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def classes_of(codes: np.ndarray) -> np.ndarray:
    return CLASSES[np.minimum(codes, len(CLASSES) - 1)]


def trigram_counts(texts: DataFrame) -> np.ndarray:
    """Counts of class trigrams in the lower-cased texts (column text), over all rows."""
    cells = LETTER_CLASSES**3

    def run(batches):
        total = np.zeros(cells, np.int64)
        for batch in batches:
            for rows in sliced(batch.column(0)):
                for at in range(0, len(rows), 128):
                    c = classes_of(codes_of(" " + " ".join([t for t in rows[at : at + 128] if t]).lower() + " ")).astype(np.int32)
                    if len(c) > 2:
                        total += np.bincount((c[:-2] * LETTER_CLASSES + c[1:-1]) * LETTER_CLASSES + c[2:], minlength=cells)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])

    rows = texts.select("text").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(cells)
    counts[rows["cell"].to_numpy()] = rows["n"].to_numpy()
    return counts.reshape((LETTER_CLASSES,) * 3)


def log_model(counts: np.ndarray) -> np.ndarray:
    """Trigram log probabilities, each order smoothed by the one below (Witten-Bell)."""
    one = counts.sum((0, 1)) + 0.5
    one = one / one.sum()
    pairs = counts.sum(0)
    kinds = (pairs > 0).sum(1, keepdims=True) + 1
    two = (pairs + kinds * one) / (pairs.sum(1, keepdims=True) + kinds)
    kinds = (counts > 0).sum(2, keepdims=True) + 1
    return np.log((counts + kinds * two) / (counts.sum(2, keepdims=True) + kinds)).astype(np.float32)


@dataclass
class Restorer:
    """Finds and decodes obfuscated stretches of lower-cased text."""

    logp: np.ndarray
    known: dict[str, str] = field(default_factory=dict)

    def readings(self, raw: str) -> list[list[tuple[str, float]]]:
        """For each character what it may be read as, with the log cost."""
        out = []
        for i, c in enumerate(raw):
            if i and c == raw[i - 1] and c.isalpha():
                out.append([("", SKIP), (c, KEEP if raw[i - 2 : i] == c * 2 or raw[i + 1 : i + 2] == c else SKIP)])
            elif c in LEET:
                out.append([*((x, SIGN_AS_LETTER) for x in LEET[c]), (" ", SIGN_AS_SIGN)])
            elif c in GAPS:
                out.append([("", SKIP), (" ", KEEP)])
            else:
                out.append([(c, 0.0)])
        return out

    def decode(self, raw: str) -> str:
        """The likeliest reading; states of the Viterbi pass are the last two classes."""
        if raw in self.known:
            return self.known[raw]
        logp, best = self.logp, {(0, 0): (0.0, None)}
        for options in [*self.readings(raw), [(" ", 0.0)]]:
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (cost, path) in best.items():
                for text, price in options:
                    if text:
                        c = int(CLASSES[ord(text)]) if ord(text) < len(CLASSES) else 61
                        state, total, way = (b, c), cost + price - float(logp[a, b, c]), (path, text)
                    else:
                        state, total, way = (a, b), cost + price, path
                    if state not in after or total < after[state][0]:
                        after[state] = (total, way)
            best = after
        way, letters = min(best.values(), key=lambda x: x[0])[1], []
        while way:
            way, letter = way
            letters.append(letter)
        if len(self.known) > 100_000:
            self.known.clear()
        self.known[raw] = out = "".join(reversed(letters)).strip()
        return out

    def stretches(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of what may be obfuscated: words with a sign before a letter or a letter
        thrice in a row; four or more single letters (or signs) with gaps between."""
        n = len(codes)
        if n < 3:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        low = np.minimum(codes, 255).astype(np.uint8)
        letter, narrow = classes_of(codes) > 0, codes < 255
        sign, gap = _SIGN[low] & narrow, _GAP[low] & narrow
        odd = np.zeros(n, bool)
        odd[:-1] = sign[:-1] & letter[1:]
        odd[2:] |= letter[2:] & (codes[2:] == codes[1:-1]) & (codes[2:] == codes[:-2])
        found_a, found_b = [], []
        if odd.any():
            outside = np.flatnonzero(~(letter | sign))
            at = np.unique(np.searchsorted(outside, np.flatnonzero(odd)))
            found_a.append(np.where(at > 0, outside[np.maximum(at - 1, 0)] + 1, 0) if len(outside) else np.zeros(len(at), np.int64))
            found_b.append(np.where(at < len(outside), outside[np.minimum(at, len(outside) - 1)], n) if len(outside) else np.full(len(at), n))
        mark = letter | sign
        alone = mark.copy()
        alone[1:] &= ~mark[:-1]
        alone[:-1] &= ~mark[1:]
        chain = np.zeros(n, bool)  # a single letter, a gap, a single letter
        chain[:-2] = alone[:-2] & gap[1:-1] & alone[2:]
        if n > 6:
            first = chain[:-4] & chain[2:-2]
            first = np.flatnonzero(first[: n - 6] & chain[4 : n - 2])
            if len(first):
                spans, last = [], -1
                for i in first.tolist():
                    if i < last:
                        continue
                    j = i
                    while j < n and chain[j]:
                        j += 2
                    spans.append((i, j + 1))
                    last = j + 1
                found_a.append(np.array([a for a, _ in spans]))
                found_b.append(np.array([b for _, b in spans]))
        if not found_a:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found_a), np.concatenate(found_b)

    def restored(self, texts: list[str]) -> list[list[str]]:
        """The changed readings of stretches of each lower-cased text."""
        out: list[list[str]] = [[] for _ in texts]
        whole = "\n".join(texts)
        a, b = self.stretches(codes_of(whole))
        if len(a):
            ends = np.cumsum([len(t) + 1 for t in texts])
            for k, i, j in zip(np.searchsorted(ends, a, "right").tolist(), a.tolist(), b.tolist(), strict=True):
                raw = whole[i:j]
                chain = len(raw) > 6 and raw[1] in GAPS
                # spaced letters may begin or end with a word of one letter
                for part in (raw, raw[2:], raw[:-2]) if chain else (raw,):
                    read = self.decode(part)
                    if read != part:
                        out[k].append(read)
        return out


class Hidden:
    """Finds words of a list in all readings of lower-cased text.

    What may hold one is found by its letters, look-alikes taken for one and repeats left out; only there
    are readings followed."""

    def __init__(self, words: Iterable[str], ordinary: frozenset[str] = frozenset()):
        import ahocorasick

        self.top: dict = {}
        self.shapes = ahocorasick.Automaton()
        for word in words:
            node = self.top
            for c in word:
                node = node.setdefault(c, {})
            node[""] = word
            shape = ALIKE[codes_of(word)]
            shape = shape[np.concatenate([[True], shape[1:] != shape[:-1]])].tobytes().decode("utf-32-le", "surrogatepass")
            self.shapes.add_word(shape, len(shape))
        if self.top:
            self.shapes.make_automaton()
        self.ordinary, self.known = ordinary, {}

    def _step(self, states: list[tuple[dict, str]], c: str, repeats: bool) -> list[tuple[dict, str]]:
        """Where the words can be after one more character: nodes with the last letter read."""
        after = {}
        for node, last in states:
            for x in LEET.get(c, c):
                if x in node:
                    after[id(node[x]), x] = (node[x], x)
                if repeats and x == last:
                    after[id(node), x] = (node, x)
        return list(after.values())

    def of_token(self, token: str) -> tuple[str, ...]:
        """Words in the readings of letters and signs without a gap; a sign may also end or begin a word."""
        if token in self.known:
            return self.known[token]
        found, states = set(), [(self.top, "")]
        if ODD.search(token):
            for c in token:
                if c in LEET:
                    found.update(node[""] for node, _ in states if "" in node)
                states = self._step(states, c, True)
                if c in LEET:
                    states.append((self.top, ""))
            found.update(node[""] for node, _ in states if "" in node)
        if len(self.known) > 100_000:
            self.known.clear()
        self.known[token] = out = tuple(found)
        return out

    def of_pieces(self, run: str) -> list[tuple[str, str]]:
        """Words that two or more pieces of a run give together, with the pieces."""
        pieces, found = TOKENS.findall(run), []
        for i in range(len(pieces) - 1):
            states, alone = [(self.top, "")], True
            for j in range(i, len(pieces)):
                alone = alone and len(pieces[j]) == 1
                for c in pieces[j]:
                    states = self._step(states, c, alone)
                if not states:
                    break
                if j > i and (alone or sum(map(len, pieces[i : j + 1])) > 3):
                    found += [(node[""], " ".join(pieces[i : j + 1])) for node, _ in states if "" in node]
        return found

    def _may_hold(self, codes: np.ndarray, marks: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[int]:
        """Which of the spans from a to b (one after the other) hold the shape of a word."""
        if not len(a):
            return []
        inside = np.zeros(len(codes) + 1, np.int8)
        inside[a] += 1
        inside[b] -= 1
        at = np.flatnonzero(marks & (np.cumsum(inside[:-1]) > 0))
        span, shape = np.searchsorted(b, at, "right"), ALIKE[codes[at]]
        new = np.concatenate([[True], span[1:] != span[:-1]])
        keep = new | np.concatenate([[True], shape[1:] != shape[:-1]])
        span, shape, new = span[keep], shape[keep], new[keep]
        starts = np.flatnonzero(new)
        text = np.insert(shape, starts, 10).tobytes().decode("utf-32-le", "surrogatepass")
        ends = np.array([end for end, _ in self.shapes.iter(text)], np.int64)
        if not len(ends):
            return []
        return sorted(set(span[starts[np.searchsorted(starts + np.arange(len(starts)), ends, "right") - 1]].tolist()))

    def found(self, texts: list[str]) -> list[set[tuple[str, str]]]:
        """Of each text the words and how they are written, but for ordinary writings."""
        out: list[set[tuple[str, str]]] = [set() for _ in texts]
        if not self.top or not texts:
            return out
        whole = "\n".join(texts)
        codes = codes_of(whole)
        marks = MARKS[codes]
        edge = np.diff(np.concatenate([[0], marks.astype(np.int8), [0]]))
        a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), a, "right")
        twice = np.concatenate([[0], np.cumsum(np.concatenate([[False], codes[1:] == codes[:-1]])[: len(codes)])])
        signs = np.concatenate([[0], np.cumsum(_SIGN[np.minimum(codes, 255)] & (codes < 256) | (codes == ord("€")))])
        odd = np.flatnonzero((signs[b] > signs[a]) | (twice[b] > twice[np.minimum(a + 1, b)]))
        for k in self._may_hold(codes, marks, a[odd], b[odd]):
            token = whole[a[odd[k]] : b[odd[k]]]
            out[text[odd[k]]].update((word, token) for word in self.of_token(token))
        short = b - a <= 3
        goes_on = np.zeros(len(a), bool)  # with the piece before
        goes_on[1:] = short[1:] & short[:-1] & (text[1:] == text[:-1])
        first = np.flatnonzero(~goes_on & np.concatenate([goes_on[1:], [False]]))
        last = np.flatnonzero(goes_on & ~np.concatenate([goes_on[1:], [False]]))
        for k in self._may_hold(codes, marks, a[first], b[last]):
            out[text[first[k]]].update(self.of_pieces(whole[a[first[k]] : b[last[k]]]))
        return [{x for x in found if x[0] != x[1] and x[1] not in self.ordinary} for found in out]


def features_of(text: str) -> dict[str, int]:
    """`=word` and `beginning*` of the words of a text, with the surroundings each first occurs in."""
    words = ["", *WORDS.findall(text), ""]
    found: dict[str, int] = {}
    for i in range(1, len(words) - 1):
        w = words[i]
        around = zlib.crc32(f"{words[i - 1]} {words[i + 1]}".encode())
        found.setdefault("=" + w, around)
        for k in PREFIXES:
            if len(w) > k:
                found.setdefault(w[:k] + "*", around)
    return found


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int, most: int) -> DataFrame:
    """text and label (0 or 1) of at most `most` labelled documents outside the held-out ones, a row an id."""
    by_id = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col(label).cast("int").alias("label")).filter("_id IS NOT NULL AND label IS NOT NULL").groupBy("_id").agg(F.max("label").alias("label"))
    chosen = cut(by_id.filter(remainder("_id", modulus) != held).orderBy(F.xxhash64("_id"), "_id").limit(most))  # 16 bytes a row
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "_id")
    one = rows.groupBy("_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "label")).alias("one"))
    return one.select("one.text", "one.label")


@dataclass
class Model:
    logp: np.ndarray
    weights: dict[str, float]
    base: float
    ordinary: frozenset[str] = frozenset()


def frequent_enough(counts: dict[int, int], share: float) -> tuple[int, int]:
    """The least frequency at which a feature could pass the test, and how many features have it or a
    greater one; counts says how many features have each frequency. Rarer ones could not pass if they were
    in toxic texts alone, and don't count among those that chance might let pass."""
    at_least = 0
    best = (max(counts, default=0) + 1, 0)
    for k in sorted(counts, reverse=True):
        at_least += counts[k]
        if k * math.log((k + 0.5) / (k + 1) / share) <= math.log(MARGIN * at_least):
            break
        best = (k, at_least)
    return best


def _words_of(weights: dict[str, float]) -> list[str]:
    return [f[1:] for f in weights if f[0] == "="]


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1, most: int = MAX_LABELLED) -> Model:
    logp = log_model(trigram_counts(docs))
    sample = cut(labelled_sample(docs, labels, "toxic", modulus, held, most))
    n_toxic, n_clean = (int(x or 0) for x in sample.agg(F.sum("label"), F.sum(1 - F.col("label"))).first())
    if not n_toxic:
        return Model(logp, {}, 0.0)

    def full(texts):
        lower = [(t or "").lower() for t in texts]
        return [t + " " + " ".join(r) for t, r in zip(lower, Restorer(logp).restored(lower), strict=True)]

    def make_toxic():
        def step(texts: pa.Array):
            out: dict[str, set[int]] = defaultdict(set)
            for text in full(texts.to_pylist()):
                for f, around in features_of(text).items():
                    out[f].add(around)
            return [[f for f, s in out.items() for _ in s], [x for s in out.values() for x in s]]

        return step

    def make_clean():
        def step(texts: pa.Array):
            out: dict[str, int] = defaultdict(int)
            for text in full(texts.to_pylist()):
                for f in features_of(text):
                    out[f] += 1
            return [list(out), list(out.values())]

        return step

    seen = arrow_map(sample.filter("label = 1"), make_toxic, "feature string, around long", ["text"])
    toxic = cut(seen.distinct().groupBy("feature").agg(F.count("*").alias("k")))
    clean = arrow_map(sample.filter("label = 0"), make_clean, "feature string, n long", ["text"]).groupBy("feature").agg(F.sum("n").alias("n"))
    share = n_toxic / (n_toxic + n_clean)
    least, tested = frequent_enough({r["k"]: r["n"] for r in toxic.groupBy("k").agg(F.count("*").alias("n")).collect()}, share)
    k, n = F.col("k"), F.coalesce("n", F.lit(0)) + F.col("k")
    p = (k + 0.5) / (n + 1)
    ratio = k * F.log(p / share) + (n - k) * F.log((1 - p) / (1 - share)) if share < 1 else F.lit(0.0)
    kept = toxic.filter(k >= least).join(clean, "feature", "left").select("feature", p.alias("p"), ratio.alias("ratio"))
    kept = kept.filter((F.col("p") > max(MIN_PRECISION, share)) & (F.col("ratio") > math.log(MARGIN * max(tested, 1))))
    weights = {r["feature"]: r["p"] for r in kept.orderBy("feature").collect()}

    def make_written():
        hidden = Hidden(_words_of(weights))

        def step(texts: pa.Array, labels: pa.Array):
            found = hidden.found([(t or "").lower() for t in texts.to_pylist()])
            rows = [(w, y) for ws, y in zip(found, labels.to_pylist(), strict=True) for w in {w for _, w in ws}]
            return [[w for w, _ in rows], [y for _, y in rows]]

        return step

    written = arrow_map(sample, make_written, "written string, label int", ["text", "label"]).groupBy("written").agg(F.sum("label").alias("k"), F.count("*").alias("n")).filter("n > k").collect()
    ordinary = frozenset(r["written"] for r in written if (r["k"] + 0.5) / (r["n"] + 1) <= MIN_PRECISION)
    return Model(logp, weights, 0.5 * share / (1 + n_toxic), ordinary)


class Scorer:
    """Applies a model to texts; one per task."""

    def __init__(self, model: Model):
        import ahocorasick

        self.model, self.restorer = model, Restorer(model.logp)
        self.hidden = Hidden(_words_of(model.weights), model.ordinary)
        found: dict[str, list[tuple[bool, float]]] = defaultdict(list)
        for f, p in model.weights.items():
            found[f.strip("=*")].append((f[0] == "=", p))
        self.automaton = ahocorasick.Automaton()
        for word, kinds in found.items():
            self.automaton.add_word(word, (len(word), kinds))
        if found:
            self.automaton.make_automaton()

    def score(self, text: str, hidden: Iterable[str] = ()) -> float:
        if not self.model.weights:
            return self.model.base
        clean, seen = 1.0 - self.model.base, set()
        for end, (n, kinds) in self.automaton.iter(text):
            start = end - n + 1
            if start and text[start - 1].isalpha():
                continue
            whole = end + 1 == len(text) or not text[end + 1].isalpha()
            for exact, p in kinds:
                if exact <= whole and (text[start : end + 1], exact) not in seen:
                    seen.add((text[start : end + 1], exact))
                    clean *= 1.0 - p
        for word in hidden:
            for f in features_of(word):
                if f in self.model.weights and (key := (f.strip("=*"), f[0] == "=")) not in seen:
                    seen.add(key)
                    clean *= 1.0 - self.model.weights[f]
        return 1.0 - clean

    def scores(self, texts: list[str | None]) -> list[float]:
        out = []
        for at in range(0, len(texts), 128):
            lower = [(t or "").lower() for t in texts[at : at + 128]]
            hidden = [sorted({word for word, _ in found}) for found in self.hidden.found(lower)]
            out += [self.score(t + " " + " ".join(r) if r else t, h) for t, r, h in zip(lower, self.restorer.restored(lower), hidden, strict=True)]
        return out


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of each row."""

    def make():
        scorer = Scorer(model)
        return lambda ids, texts: [ids, scorer.scores(texts.to_pylist())]

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return arrow_map(rows, make, "doc_id long, score double", ["doc_id", "text"])


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that score under threshold, all columns."""
    scorers: list[Scorer] = []

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        if not scorers:
            scorers.append(Scorer(model))
        return pa.array([x for part in sliced(texts) for x in scorers[0].scores(part)], pa.float64())

    return docs.filter(score(F.col("text").cast("string")) < threshold)
