"""Document fingerprints by winnowing.

The hash of every run of `gram` code points is rolled over the text (differences of prefix sums of a
polynomial modulo 2**64, then mixed). Of every `window` successive hashes the least is chosen, the
rightmost of equal ones; a text's fingerprint is the chosen hashes with their positions. Whatever
two texts share of gram + window - 1 code points or more, they share a chosen hash of it; and no
shared run under gram code points is ever reported.

Defined cases: null text is the empty text, whose fingerprint is empty; a text shorter than gram is
one gram, one with fewer than window grams is one window; equal texts have equal fingerprints, and
likeness 1 (two empty ones too); very long texts are read whole; `neighbours` orders repeated ids by a
hash of the text, then the text, with null ids last; a single document is its own neighbour, and an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, n_tasks

GRAM = 12
WINDOW = 52
#: An odd number, so that it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
#: Text in characters that one task of `neighbours` should sort at most.
TASK_CHARS = 24_000_000
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n at least; they grow by doubling."""
    global _powers, _inverses
    while len(_powers) < n:
        m = len(_powers)
        up, down = (np.uint64(pow(b, m, 1 << 64)) for b in (BASE, pow(BASE, -1, 1 << 64)))
        _powers, _inverses = np.concatenate([_powers, _powers * up]), np.concatenate([_inverses, _inverses * down])
    return _powers, _inverses


def gram_hashes(codes: np.ndarray, gram: int) -> np.ndarray:
    """The hash of codes[i:i+gram] for each i; of all codes if they are fewer."""
    n = len(codes)
    if n == 0:
        return np.zeros(0, np.uint64)
    gram = min(gram, n)
    up, down = _power_tables(n + 1)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * down[:n], out=sums[1:])
    h = (sums[gram:] - sums[: n - gram + 1]) * up[: n - gram + 1]
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def winnow(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """The chosen hashes and their positions in code points, by position."""
    least = gram_hashes(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), gram)
    hashes, n = least, len(least)
    if n == 0:
        return least, np.zeros(0, np.int64)
    window = min(window, n)
    at, span = np.arange(n), 1
    while span < window:  # least[i] and at[i] stand for hashes[i:i+span]
        step = min(span, window - span)
        right = least[step:] <= least[:-step]
        least, at, span = np.where(right, least[step:], least[:-step]), np.where(right, at[step:], at[:-step]), span + step
    at = at[np.concatenate([[True], at[1:] != at[:-1]])]
    return hashes[at], at


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard likeness of two sets of chosen hashes."""
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - both
    return both / union if union else 1.0


def printed(hashes: np.ndarray, at: np.ndarray) -> str:
    """`position:hash` of every chosen hash, in order."""
    return " ".join([f"{p}:{h:016x}" for p, h in zip(at.tolist(), hashes.tolist(), strict=True)])


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """doc_id, hashes and positions (arrays of equal length; hashes as signed 64-bit numbers)."""

    def make():
        def step(ids: pa.Array, texts: pa.Array):
            found = [winnow(t or "", gram, window) for t in texts.to_pylist()]
            return [ids, [h.view(np.int64) for h, _ in found], [p for _, p in found]]

        return step

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return arrow_map(rows, make, "doc_id long, hashes array<long>, positions array<long>", ["doc_id", "text"])


def neighbours(docs: DataFrame) -> DataFrame:
    """Deals doc_id and text out so that each document and the next one, in descending order of id
    (after the last comes the first), are neighbours in one partition.

    Ranges are cut at documents that exist (by id and hash of the text, so that rows of one id or without
    any are dealt out too); each range also gets, as carried rows, the highest document of the range below
    it (the lowest range that of the highest). Within a partition rows descend by (range, id), carried ones
    last in their range. Text is shuffled once."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0]
    n = n_tasks(rows, chars, TASK_CHARS)
    up = F.struct("doc_id", F.bitwise_not("tie").alias("t"))  # equal ids descend as their ties ascend
    spread = rows.select(up.alias("up")).repartitionByRange(n, "up").select(F.spark_partition_id().alias("p"), "up")
    lowest = -(1 << 64)
    cuts = sorted({(lowest if r.i is None else r.i, r.t) for r in spread.groupBy("p").agg(F.max("up").alias("m")).select("m.doc_id", "m.t").toDF("i", "t").collect()})
    last = len(cuts) - 1  # range i holds what is over cuts[i-1], up to cuts[i]

    @F.arrow_udf("array<int>")
    def ranges(ids: pa.Array, ties: pa.Array) -> pa.Array:
        """The range of a document, and ~range for the one that carries it."""
        out = []
        for key in zip((lowest if i is None else i for i in ids.to_pylist()), (~t for t in ties.to_pylist()), strict=True):
            at = bisect_left(cuts, key)
            out.append([at, ~(at + 1 if at < last else 0)] if cuts[at] == key else [at])
        return pa.array(out, pa.list_(pa.int32()))

    dealt = rows.select("doc_id", "text", "tie", F.explode(ranges(F.col("doc_id"), F.col("tie"))).alias("dealt"))
    dealt = dealt.select("doc_id", "text", F.when(F.col("dealt") < 0, -F.col("dealt") - 1).otherwise(F.col("dealt")).alias("part"), (F.col("dealt") < 0).alias("carried"), "tie")
    return dealt.repartitionById(n, F.col("part").cast("int")).sortWithinPartitions("part", "carried", F.col("doc_id").desc_nulls_last(), "tie", "text")


def edited_fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """For each document: its fingerprint, that of its edited text (the last half of the code points
    replaced by as many of the next document), and their likenesses."""

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
        held = None  # a document whose next one is still to come: part, id, text, hashes, positions
        for batch in batches:
            out = []
            for part, carried, i, text in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                got = winnow(text, gram, window)
                if held is not None and held[0] == part:
                    _, ident, own, hashes, at = held
                    half = len(own) // 2
                    edited = own[: len(own) - half] + text[:half]
                    e_hashes, e_at = winnow(edited, gram, window)
                    out.append((ident, len(own), hashlib.sha256(edited.encode()).hexdigest(), printed(hashes, at), printed(e_hashes, e_at), likeness(hashes, e_hashes), likeness(hashes, got[0])))
                held = None if carried else (part, i, text, *got)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)

    kind = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return neighbours(docs).select("part", "carried", "doc_id", "text").mapInArrow(run, kind)
