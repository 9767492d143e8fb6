"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

Texts are sequences of words (lower case, signs stripped). The CGK embedding walks along a sequence: at
step j it writes down the word under it, and moves on by one if a random bit of (j, word) is set. Two
windows a few edits apart fall into step again after each edit, so that most steps of both write down
the same: edit distance has become Hamming distance. Bit-sampling LSH then takes a few random steps of
a walk as a key. WALKS independent walks with TABLES keys each reach the target recall (see the tests).

Items are handled by size class. From each text, item-sized windows start at every stride-th word; an
item has a window at each of its first stride words, so one of them is aligned to one of the text's.
Items of over LONGEST_WINDOW words are looked for by windows of that size, one after the other: of those,
one has no greater share of the edits than the item. A window with more words that
no item has than an item's edits allow can't hold one, and isn't walked. Windows that share a key with
an item are verified exactly: the least edit distance of the whole item to any stretch of the text
around the window (bit-parallel, over words). A document is contaminated by an item if that is at most
(1 - SIMILARITY) of the item's words. Of items of under MIN_WORDS words that allows no edit: they are
found by the hash of their words at every word of a text, and compared.

The items' index goes to every task, in slices of at most MAX_ITEM_WORDS words, each of which is one
more pass over the documents. So what the driver, a message to tasks and a task hold is bounded
whatever their number: some 500 bytes a word of a slice (or of a single longer item).

Defined cases: null and empty texts are clean; items that are null or have no word match nothing; equal
items each match, and of equally close stretches the first is given; very long texts and items are
read whole; repeated ids and rows of documents are rows like others (in `matches` they add to one row
for an id and item: the closest); without documents or items there are no matches; other columns pass
through `keep_clean`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, own_name, scratch_path, sliced

SIMILARITY = 0.8
MIN_WORDS = 5
LONGEST_WINDOW = 64
WALKS, TABLES, STEPS = 7, 10, 4
MAX_ITEM_WORDS = 100_000
SEED = 20
_STRIP = bytes(32 if chr(i) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else i for i in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_STRIP).split()


def distance_within(pattern: list[bytes], text: list[bytes]) -> tuple[int, int]:
    """The least edit distance of pattern to any stretch of text, and where the first such one ends.

    Bit-parallel: the bits of vp and vn are the steps up and down of a column of distances."""
    m = len(pattern)
    where: dict[bytes, int] = {}
    for i, w in enumerate(pattern):
        where[w] = where.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    vp, vn, score, best = full, 0, m, (m, 0)
    for at, w in enumerate(text):
        eq = where.get(w, 0)
        d0 = (((eq & vp) + vp) ^ vp) | eq | vn
        hp, hn = vn | (full & ~(d0 | vp)), vp & d0
        score += (hp & top > 0) - (hn & top > 0)
        hp, hn = hp << 1, hn << 1
        vp, vn = (hn | ~(d0 | hp)) & full, hp & d0 & full
        if score < best[0]:
            best = score, at + 1
    return best


def _sample(rng: np.random.Generator, steps: int) -> np.ndarray:
    """STEPS different steps, early ones rather than late ones, as walks drift apart."""
    odds = 1 / np.sqrt(np.arange(1, steps + 1))
    return np.sort(rng.choice(steps, min(STEPS, steps), replace=False, p=odds / odds.sum()))


@dataclass
class SizeClass:
    """Items of `size` words up to half as many again; the last class has no upper bound."""

    size: int
    stride: int
    steps: int
    strange: int  # words that no item has, at most, in a window that may hold one
    samples: list[list[np.ndarray]]  # by walk and table: the sampled steps
    keys: list[list[np.ndarray]]  # sorted
    items: list[list[np.ndarray]]  # the item of each key, and its offset
    offsets: list[list[np.ndarray]]
    filters: list[list[np.ndarray]]  # which remainders of keys there are


def _bits(hashes: np.ndarray, walk: int, step: int) -> np.ndarray:
    """The random bits of a step of a walk for words with these hashes."""
    salt = np.uint64((walk * 0xD1B54A32D192ED03 + step * 0x8CB92BA72F3D8DD7 + SEED) & (1 << 64) - 1)
    mixed = (hashes ^ salt) * np.uint64(0xFF51AFD7ED558CCD)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xC4CEB9FE1A85EC53)
    return (mixed >> np.uint64(63)).astype(np.int64)


class Index:
    """Keys of all windows of some items."""

    def __init__(self, ids: list[int | None], texts: list[str | None], similarity: float = SIMILARITY):
        self.similarity = similarity
        pairs = [(i, w) for i, t in zip(ids, texts, strict=True) if (w := words_of(t))]
        self.ids, self.words = [i for i, _ in pairs], [w for _, w in pairs]
        self.sets = [frozenset(w) for w in self.words]
        vocabulary = sorted({w for words in self.words for w in words})
        self.number = {w: k + 1 for k, w in enumerate(vocabulary)}  # 0: any other word
        rng = np.random.default_rng(SEED)
        self.hashes = rng.integers(0, 2**64, len(vocabulary) + 1, np.uint64)
        self.classes: list[SizeClass] = []
        longest = max(map(len, self.words), default=0)
        size, by_size = MIN_WORDS, {}
        while size <= longest:
            upper = min(max(size + 1, size * 3 // 2), LONGEST_WINDOW) if size < LONGEST_WINDOW else longest + 1
            if members := [k for k, w in enumerate(self.words) if size <= len(w) < upper]:
                by_size[size] = members
            size = upper
        for size, members in by_size.items():
            stride = max(1, size // 3)
            steps = max(STEPS, int(1.6 * (size - stride)))
            samples = [[_sample(rng, steps) for _ in range(TABLES)] for _ in range(WALKS)]
            starts = [(k, a + o) for k in members for a in range(0, len(self.words[k]) - size + 1 if size == LONGEST_WINDOW else 1, size) for o in range(stride)]
            flat = [self.number[w] for k in members for w in self.words[k]]
            base = dict(zip(members, np.cumsum([0, *(len(self.words[k]) for k in members)]).tolist()))
            hashes = self.hashes[np.array([*flat, *[0] * (steps + 1)], np.int32)]
            at = np.array([base[k] + o for k, o in starts])
            ends = np.array([base[k] + len(self.words[k]) for k, _ in starts])
            allowed = int((1 - similarity) * size) + 1 if size == LONGEST_WINDOW else max(int((1 - similarity) * len(self.words[k]) + 1e-9) for k in members)
            cls = SizeClass(size, stride, steps, allowed, samples, [], [], [], [])
            item, offset = (np.array(x, np.int32) for x in zip(*starts))
            slots = 1 << max(10, (32 * len(starts)).bit_length())
            for walk in range(WALKS):
                rows = [[], [], [], []]
                for keys in self._keys(cls, walk, hashes, at, ends):
                    order = np.argsort(keys, kind="stable")
                    seen = np.zeros(slots, bool)
                    seen[keys & np.uint64(slots - 1)] = True
                    for row, x in zip(rows, (keys[order], item[order], offset[order], seen), strict=True):
                        row.append(x)
                for own, row in zip((cls.keys, cls.items, cls.offsets, cls.filters), rows, strict=True):
                    own.append(row)
            self.classes.append(cls)
        self.short: dict[int, dict[int, list[int]]] = {}  # by length: items of the hash of their words
        for k, w in enumerate(self.words):
            if len(w) < MIN_WORDS:
                run = self._runs(self.hashes[[self.number[x] for x in w]], len(w))
                self.short.setdefault(len(w), {}).setdefault(int(run[0]), []).append(k)

    @staticmethod
    def _runs(hashes: np.ndarray, n: int) -> np.ndarray:
        """A hash of each n words in a row."""
        total = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
        for k in range(n):
            total = (total ^ hashes[k : k + len(total)]) * np.uint64(0x9E3779B97F4A7C15)
        return total

    def _keys(self, cls: SizeClass, walk: int, hashes: np.ndarray, at: np.ndarray, ends: np.ndarray | None = None) -> list[np.ndarray]:
        """The keys of each table for the walks from each start; hashes must go on for cls.steps + 1."""
        keys = [np.zeros(len(at), np.uint64) for _ in range(TABLES)]
        by_step: dict[int, list[int]] = {}
        for t, sampled in enumerate(cls.samples[walk]):
            for j in sampled.tolist():
                by_step.setdefault(j, []).append(t)
        last, at = max(by_step, default=-1), at.copy()
        for j in range(last + 1):
            under = hashes[at] if ends is None else np.where(at < ends, hashes[np.minimum(at, len(hashes) - 1)], self.hashes[0])
            for t in by_step.get(j, ()):
                keys[t] = (keys[t] ^ under) * np.uint64(0x9E3779B97F4A7C15)
                keys[t] ^= keys[t] >> np.uint64(29)
            at += _bits(under, walk, j)
        return keys

    def candidates(self, codes: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(text, item, place where the item would start) from the joined codes of texts, which end at ends."""
        starts = np.concatenate([[0], ends[:-1]])
        strange = np.concatenate([[0], np.cumsum(codes == 0)])
        for cls in self.classes:
            at = np.concatenate([np.arange(a, b, cls.stride) for a, b in zip(starts.tolist(), ends.tolist())]) if len(ends) else np.zeros(0, np.int64)
            at = at[strange[np.minimum(at + cls.size - cls.stride, len(codes))] - strange[at] <= cls.strange]
            hashes = self.hashes[np.concatenate([codes, np.zeros(cls.steps + 1, np.int32)])]
            for walk in range(WALKS):
                for t, keys in enumerate(self._keys(cls, walk, hashes, at)):
                    seen = cls.filters[walk][t]
                    near = np.flatnonzero(seen[keys & np.uint64(len(seen) - 1)])
                    if not len(near):
                        continue
                    known, got = cls.keys[walk][t], keys[near]
                    low, high = np.searchsorted(known, got, "left"), np.searchsorted(known, got, "right")
                    for i in np.flatnonzero(high > low).tolist():
                        place = int(at[near[i]])
                        text = int(np.searchsorted(ends, place, "right"))
                        for k in range(low[i], high[i]):
                            yield text, int(cls.items[walk][t][k]), place - int(cls.offsets[walk][t][k])

    def short_matches(self, words: list[list[bytes]], codes: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(text, item, first word) of items of under MIN_WORDS words, word for word."""
        hashes = self.hashes[codes]
        for n, items in self.short.items():
            runs, known = self._runs(hashes, n), np.array(sorted(items), np.uint64)
            found = np.searchsorted(known, runs)
            for at in np.flatnonzero(known[np.minimum(found, len(known) - 1)] == runs).tolist():
                text = int(np.searchsorted(ends, at, "right"))
                first = at - (int(ends[text]) - len(words[text]))
                for k in items[int(runs[at])]:
                    if words[text][first : first + n] == self.words[k]:
                        yield text, k, first

    def matches(self, texts: list[str | None]) -> list[dict[int, tuple[int, int, int]]]:
        """For each text by item: distance in words, and the first and end word of the item's stretch."""
        out: list[dict[int, tuple[int, int, int]]] = []
        for at in range(0, len(texts), 1024):
            words = [words_of(t) for t in texts[at : at + 1024]]
            get, found = self.number.get, [{} for _ in words]
            codes = np.concatenate([np.fromiter(map(get, w, repeat(0)), np.int32, len(w)) for w in words]) if words else np.zeros(0, np.int32)
            ends = np.cumsum([len(w) for w in words])
            for text, item, place in sorted(set(self.candidates(codes, ends))):
                pattern, begin = self.words[item], int(ends[text]) - len(words[text])
                allowed = int((1 - self.similarity) * len(pattern) + 1e-9)
                first = max(0, place - begin - allowed - 1)
                part = words[text][first : place - begin + len(pattern) + 2 * allowed + 1]
                known = found[text].get(item)
                if known and known[0] == 0:
                    continue
                if sum(map(self.sets[item].__contains__, part)) < len(pattern) - allowed:
                    continue  # each word of the item that isn't there costs an edit
                distance, end = distance_within(pattern, part)
                if distance <= allowed and (known is None or distance < known[0]):
                    found[text][item] = (distance, max(0, first + end - len(pattern)), first + end)
            for text, item, first in self.short_matches(words, codes, ends) if self.short else ():
                found[text].setdefault(item, (0, first, first + len(self.words[item])))
            out += found
        return out


def item_slices(items: DataFrame, most: int = MAX_ITEM_WORDS) -> Iterator[tuple[list, list]]:
    """(ids, texts) of the items, in slices of at most `most` words (or a single longer item). They are read
    one after the other; one is at the driver at a time."""
    ids, texts, size = [], [], 0
    for row in items.select(F.col("item_id").cast("long").alias("i"), F.col("text").cast("string").alias("t")).orderBy("i", "t").toLocalIterator():
        n = len(words_of(row.t))
        if ids and size + n > most:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(row.i)
        texts.append(row.t)
        size += n
    if ids:
        yield ids, texts


_held: list[tuple[tuple, Index]] = []


def _index(ids: list, texts: list, similarity: float) -> Index:
    """The index of a slice; a worker keeps the last one for its next tasks."""
    key = (hash((tuple(ids), tuple(texts))), similarity)
    if not _held or _held[0][0] != key:
        _held[:] = [(key, Index(ids, texts, similarity))]
    return _held[0][1]


def matches(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, most: int = MAX_ITEM_WORDS) -> DataFrame:
    """A row per document and item it holds: doc_id, item_id, distance (words), item_words, and the words
    from first_word up to end_word of the document's text that hold it."""
    schema = "doc_id long, item_id long, distance long, item_words long, first_word long, end_word long"
    spark = docs.sparkSession

    def passed(ids, texts):
        def make():
            index = _index(ids, texts, similarity)

            def step(doc_ids: pa.Array, texts: pa.Array):
                rows = [(d, index.ids[k], n, len(index.words[k]), a, b) for d, found in zip(doc_ids.to_pylist(), index.matches(texts.to_pylist()), strict=True) for k, (n, a, b) in sorted(found.items())]
                return [list(c) for c in zip(*rows)] if rows else None

            return step

        return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), make, schema, ["doc_id", "text"])

    out = _each_slice(item_slices(items, most), passed, scratch_path(spark, "matches"))
    if out is None:
        return spark.createDataFrame([], schema)
    rest = F.struct("distance", "item_words", "first_word", "end_word")
    return out.groupBy("doc_id", "item_id").agg(F.min(rest).alias("best")).select("doc_id", "item_id", "best.*")


def _each_slice(slices: Iterator[tuple[list, list]], passed: Callable[[list, list], DataFrame], path: str) -> DataFrame | None:
    """The rows that passed gives for all slices, None if there is no slice. One slice is part of the plan;
    of several, each one's rows are written under path before the next is read."""
    first, second = next(slices, None), next(slices, None)
    if first is None:
        return None
    if second is None:
        return passed(*first)
    for s in chain([first, second], slices):
        rows = passed(*s)
        rows.write.mode("append").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def keep_clean(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, most: int = MAX_ITEM_WORDS) -> DataFrame:
    """The rows of docs that hold no item, all columns. Where the items need several passes, the hashes of
    the texts that hold one are collected in a table first."""
    text = F.col("text").cast("string")

    def holds(ids: list, texts: list):
        @F.arrow_udf("boolean")
        def found(column: pa.Array) -> pa.Array:
            index = _index(ids, texts, similarity)
            return pa.array([bool(f) for part in sliced(column) for f in index.matches(part)], pa.bool_())

        return found(text)

    slices = item_slices(items, most)
    first, second = next(slices, None), next(slices, None)
    if first is None:
        return docs
    if second is None:
        return docs.filter(~holds(*first))
    held = own_name(docs, "held_text")
    found = _each_slice(chain([first, second], slices), lambda *s: docs.filter(holds(*s)).select(F.md5(text.cast("binary")).alias(held)), scratch_path(docs.sparkSession, "held"))
    return docs.join(found.distinct(), F.md5(text.cast("binary")) == F.col(held), "left_anti")
