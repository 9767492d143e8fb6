"""Quality rules by weak supervision: rules vote or abstain, and what their votes are worth is estimated.

Each rule looks at a few counts of a text and votes good, bad, or not at all. How often a rule is right on good
and on bad documents is not known; expectation-maximisation finds it from how the rules agree, without labels:
given the rules' accuracies, Bayes' rule tells how probable it is that a document with certain votes is
good, and given these probabilities, the accuracies are shares of votes. So one firm rule may outvote several
loose ones, and a document that fails one rule of many is kept if the others speak for it.

Only patterns of votes and how many documents have each go into the estimate: at most 3 to the number of rules, however large the
corpus, added up over all documents before they are shuffled. A pattern's probability comes back to the documents as
a table of that size. Texts are read once: counts are written to the shared folder and serve both passes.

Words in repeated windows are found exactly: texts with two windows of one hash are looked at again, where words are
numbered, then pairs of them, pairs of pairs, and windows of eight; equal numbers are equal windows.

Defined cases: null text is the empty text, and has no words, no votes, and the prior's probability; very long texts are
read whole by one task; ties don't occur, as a document's verdict depends on its own votes and all documents' counts;
repeated rows count each time; an empty table gives an empty result; other columns are ignored, and null ids stay null.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, sliced

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
#: Words of a window, and code points of several texts that are looked at together.
WINDOW, TOGETHER = 8, 1 << 18
#: Least words of a document, and percent of its words in repeated windows, for any verdict but no.
LEAST_WORDS, MOST_REPEATED = 20, 30
#: A document is kept from this probability of being good.
KEPT_FROM = 0.5

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letter_words", "n_ended_lines", "n_capitals", "n_letters"]
_SYMBOL, _SPACE, _LETTER, _CAPITAL = 1, 2, 4, 8
LINE_ENDS = (b".", b"!", b"?", b":", b'"')


@lru_cache(maxsize=1)
def _signs() -> np.ndarray:
    """What each code point is, as bits."""
    kinds = np.zeros(sys.maxunicode + 1, np.uint8)
    for i in range(sys.maxunicode + 1):
        c = chr(i)
        if c.isalpha():
            kinds[i] = _LETTER | (_CAPITAL if c.isupper() else 0)
    kinds[[ord(c) for c in SYMBOLS]] = _SYMBOL
    kinds[[ord(c) for c in SPACES]] = _SPACE
    return kinds


def repeated_words(numbers: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of texts, one after the other as their words' numbers, how many words of each lie in a window of WINDOW words that the text has
    twice or more. Windows are told apart by a hash first: only texts where two are the same are looked at."""
    out = np.zeros(len(sizes), np.int64)
    if not len(sizes) or sizes.max() <= WINDOW:
        return out
    of = np.repeat(np.arange(len(sizes)), sizes)
    n = len(numbers) - WINDOW + 1
    mixed = (numbers + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    rolled = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        rolled = rolled * np.uint64(0xD6E8FEB86659FD93) + mixed[k : k + n]
    inside = np.flatnonzero(of[:n] == of[WINDOW - 1 :])
    keys = rolled[inside] ^ (of[inside].astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    order = np.argsort(keys)
    same = np.flatnonzero(keys[order][1:] == keys[order][:-1])
    ends = np.cumsum(sizes)
    for text in np.unique(np.concatenate([of[inside[order[same]]], of[inside[order[same + 1]]]])):
        out[text] = _repeated_in(numbers[ends[text] - sizes[text] : ends[text]])
    return out


def _repeated_in(ids: np.ndarray) -> int:
    """The same of one text, exactly: pairs of words get numbers, then pairs of pairs, then windows."""
    total, reach = len(ids), 1
    while reach < WINDOW:
        ids = np.unique(ids[:-reach] * (int(ids.max()) + 1) + ids[reach:], return_inverse=True)[1]
        reach *= 2
    _, same, count = np.unique(ids, return_inverse=True, return_counts=True)
    again = np.flatnonzero(count[same] > 1)
    steps = np.zeros(total + 1, np.int64)
    np.add.at(steps, again, 1)
    np.add.at(steps, again + WINDOW, -1)
    return int((np.cumsum(steps)[:-1] > 0).sum())


def counts_of(texts: list[str]) -> list[list[int]]:
    """The COUNTS of each text."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
    kinds = _signs()[points]
    ends = np.cumsum([len(t) for t in texts])
    begins = ends - [len(t) for t in texts]

    def within(marks: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        added = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
        return added[high] - added[low]

    by_text = lambda bit: within((kinds & bit) != 0, begins, ends)
    word = (kinds & _SPACE) == 0
    first = word.copy()
    first[1:] &= ~word[:-1]
    edges = begins[begins < ends]
    first[edges] = word[edges]
    last = word.copy()
    last[:-1] &= first[1:] | ~word[1:]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    with_letter = within((kinds & _LETTER) != 0, starts, stops) > 0
    low, high = np.searchsorted(starts, begins), np.searchsorted(starts, ends)
    known: dict[bytes, int] = {}
    split, by_line = [], []
    for text in texts:
        data = text.encode()
        split += data.split()  # of bytes: at the six ASCII spaces alone
        lines = [line for line in data.split(b"\n") if line.strip()]
        by_line.append((len(lines) - len(set(lines)), len(lines), sum(line.rstrip().endswith(LINE_ENDS) for line in lines)))
    numbers = np.fromiter((known.setdefault(w, len(known)) for w in split), np.int64, len(split))
    again = repeated_words(numbers, high - low)
    dup, n_lines, ended = zip(*by_line, strict=True) if by_line else ((), (), ())
    columns = [high - low, (ends - begins) - by_text(_SPACE), by_text(_SYMBOL), dup, again, n_lines, within(with_letter, low, high), ended, by_text(_CAPITAL), by_text(_LETTER)]
    return [list(map(int, row)) for row in zip(*columns, strict=True)]


def counted(docs: DataFrame) -> DataFrame:
    """doc_id and the COUNTS of each text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            id_type = batch.schema.field(0).type
            for ids, texts in zip(sliced(batch.column(0)), sliced(batch.column(1)), strict=True):
                rows = list(_counted_together(texts))
                columns = [pa.array(ids, id_type), *(pa.array(c, pa.int64()) for c in zip(*rows, strict=True))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *COUNTS])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS))


def _counted_together(texts: Iterable[str | None]) -> Iterator[list[int]]:
    held: list[str] = []
    size = 0
    for text in texts:
        held.append(text or "")
        size += len(held[-1])
        if size >= TOGETHER:
            yield from counts_of(held)
            held, size = [], 0
    if held:
        yield from counts_of(held)


# --- rules -------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """Votes bad from one bound of a share on, good from the other, and abstains between them and where there is nothing to share."""

    name: str
    part: str
    of: str
    good: float
    bad: float

    def vote(self) -> Column:
        """1 good, 0 bad, -1 abstains. Shares are compared as products of whole numbers with the bound, which is in thousandths."""
        part, of = F.col(self.part) * 1000, F.col(self.of)
        good, bad = round(self.good * 1000), round(self.bad * 1000)
        low_is_good = good < bad
        is_good = part <= of * good if low_is_good else part >= of * good
        is_bad = part >= of * bad if low_is_good else part <= of * bad
        return F.when(of == 0, -1).when(is_bad, 0).when(is_good, 1).otherwise(-1)


#: Part, whole, and the shares from which a rule votes.
RULES = [
    Rule("enough_words", "n_words", "one", 60, 30),
    Rule("words_not_long", "word_chars", "n_words", 8, 11),
    Rule("words_not_short", "word_chars", "n_words", 3.5, 2.5),
    Rule("few_symbols", "n_symbols", "n_words", 0.02, 0.1),
    Rule("few_repeated_lines", "n_dup_lines", "n_lines", 0.1, 0.3),
    Rule("few_repeated_words", "n_repeat_words", "n_words", 0.1, 0.3),
    Rule("words_of_letters", "n_letter_words", "n_words", 0.95, 0.8),
    Rule("signs_are_letters", "n_letters", "word_chars", 0.9, 0.75),
    Rule("lines_that_end", "n_ended_lines", "n_lines", 0.5, 0.1),
    Rule("few_capitals", "n_capitals", "n_letters", 0.15, 0.4),
]


def voted(counts: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """counts with votes: a list, a vote a rule."""
    with_one = counts.withColumn("one", F.lit(1))
    return with_one.withColumn("votes", F.when(F.col("n_words") == 0, F.array_repeat(F.lit(-1), len(rules))).otherwise(F.array(*(r.vote() for r in rules)))).drop("one")


@dataclass
class Model:
    """The share of good documents, and each rule's accuracy on good and on bad ones."""

    prior: float
    on_good: list[float]
    on_bad: list[float]

    def probability(self, votes: list[int]) -> float:
        odds = math.log(self.prior / (1 - self.prior))
        for v, a, b in zip(votes, self.on_good, self.on_bad, strict=True):
            odds += 0 if v < 0 else math.log(a / (1 - b)) if v == 1 else math.log((1 - a) / b)
        return 1 / (1 + math.exp(-odds)) if odds > -700 else 0.0


#: A rule is thought to have been right so often and wrong so often before any document is seen, in votes on each kind
#: of document; with that no accuracy is 0 or 1. The share of good documents starts from as many of each kind.
RIGHT, WRONG = 8.0, 2.0
STEPS = 500
#: How sure the all-must-pass filter is held to be to begin with.
AT_FIRST = 0.9


def fit(patterns: list[tuple[list[int], int]], n_rules: int = len(RULES), steps: int = STEPS) -> Model:
    """Expectation-maximisation over patterns of votes with their numbers of documents. It begins with the filter
    that it replaces, where one bad vote is enough (so that `good` is what passes all rules, whichever rules agree
    most often), and ends when nothing moves by a billionth, or after `steps`."""
    if not patterns:
        return Model(0.5, [RIGHT / (RIGHT + WRONG)] * n_rules, [RIGHT / (RIGHT + WRONG)] * n_rules)
    patterns = sorted(patterns)
    votes = np.array([p for p, _ in patterns], np.int64)
    n = np.array([c for _, c in patterns], float)
    good, bad = votes == 1, votes == 0
    p = np.where(bad.any(1), 1 - AT_FIRST, np.where(good.any(1), AT_FIRST, 0.5))
    for _ in range(steps):
        w, v = n * p, n * (1 - p)
        prior = (w.sum() + 1) / (n.sum() + 2)
        a = (w @ good + RIGHT) / (w @ (good | bad) + RIGHT + WRONG)
        b = (v @ bad + RIGHT) / (v @ (good | bad) + RIGHT + WRONG)
        model = Model(float(prior), a.tolist(), b.tolist())
        odds = math.log(prior / (1 - prior)) + good @ np.log(a / (1 - b)) + bad @ np.log((1 - a) / b)
        after = 1 / (1 + np.exp(-odds))
        moved, p = np.abs(after - p).max(), after
        if moved < 1e-9:
            break
    return model


def judged(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """doc_id, COUNTS, votes, probability (that it is good), base_failed, kept."""
    counts = cut(voted(counted(docs), rules))
    patterns = [(r.votes, r.n) for r in counts.groupBy("votes").agg(F.count("*").alias("n")).collect()]  # 3 ** rules at most
    model = fit(patterns, len(rules))
    # log odds are added up as the model does, from constants; the table of patterns needs no join
    odds = F.lit(math.log(model.prior / (1 - model.prior)))
    for i, (a, b) in enumerate(zip(model.on_good, model.on_bad, strict=True)):
        vote = F.col("votes")[i]
        odds = odds + F.when(vote == 1, math.log(a / (1 - b))).when(vote == 0, math.log((1 - a) / b)).otherwise(0.0)
    probability = F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    out = counts.withColumn("probability", probability).withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= KEPT_FROM))


# --- the query in SQL --------------------------------------------------------------------------------


def _vote_sql(r: Rule) -> str:
    good, bad = round(r.good * 1000), round(r.bad * 1000)
    low, high = ("<=", ">=") if good < bad else (">=", "<=")
    return f"CASE WHEN n_words = 0 OR {r.of} = 0 THEN -1 WHEN {r.part} * 1000 {high} {r.of} * {bad} THEN 0 WHEN {r.part} * 1000 {low} {r.of} * {good} THEN 1 ELSE -1 END"


def _total(what: str) -> str:
    return f"list_sum(list_transform(range(1, len(n) + 1), lambda i: {what}))"


_J = f"range(1, {len(RULES)} + 1)"
SQL = rf"""WITH RECURSIVE
texts AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS d, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
          list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM documents),
windows AS (SELECT d, i, array_to_string(w[i : i + {WINDOW - 1}], ' ') AS g FROM (SELECT d, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM texts)),
again AS (SELECT d, i FROM (SELECT d, i, count(*) OVER (PARTITION BY d, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT d, count(DISTINCT place) AS n FROM (SELECT d, unnest(range(i, i + {WINDOW})) AS place FROM again) GROUP BY d),
counts AS MATERIALIZED (SELECT doc_id, d, 1 AS one, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars, length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols,
          len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, len(lines) AS n_lines, len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letter_words,
          len(list_filter(lines, lambda l: regexp_matches(l, '[.!?:"][\x20\x09-\x0D]*$'))) AS n_ended_lines, length(regexp_replace(t, '[^\p{{Lu}}]', '', 'g')) AS n_capitals, length(regexp_replace(t, '[^\p{{L}}]', '', 'g')) AS n_letters
          FROM texts LEFT JOIN covered c USING (d)),
voted AS MATERIALIZED (SELECT *, [{", ".join(map(_vote_sql, RULES))}] AS votes FROM counts),
patterns AS (SELECT votes, count(*) AS c FROM voted GROUP BY votes),
listed AS MATERIALIZED (SELECT list(votes ORDER BY votes) AS v, list(CAST(c AS DOUBLE) ORDER BY votes) AS n FROM patterns),
steps AS (
  SELECT v, n, list_transform(v, lambda x: CASE WHEN list_contains(x, 0) THEN {1 - AT_FIRST:.1f} WHEN list_contains(x, 1) THEN {AT_FIRST} ELSE 0.5 END::DOUBLE) AS p, 1.0::DOUBLE AS moved, 0 AS step FROM listed
  UNION ALL
  SELECT v, n, after, list_max(list_transform(range(1, len(n) + 1), lambda i: abs(after[i] - p[i]))), step + 1 FROM (
    SELECT v, n, p, step, list_transform(v, lambda x: 1 / (1 + exp(-(ln(prior / (1 - prior)) + list_sum(list_transform({_J}, lambda j: CASE x[j] WHEN 1 THEN ln(a[j] / (1 - b[j])) WHEN 0 THEN ln((1 - a[j]) / b[j]) ELSE 0.0::DOUBLE END)))))) AS after FROM (
      SELECT v, n, p, step, ({_total("n[i] * p[i]")} + 1) / (list_sum(n) + 2) AS prior,
        list_transform({_J}, lambda j: ({_total("CASE WHEN v[i][j] = 1 THEN n[i] * p[i] ELSE 0.0::DOUBLE END")} + {RIGHT}) / ({_total("CASE WHEN v[i][j] >= 0 THEN n[i] * p[i] ELSE 0.0::DOUBLE END")} + {RIGHT + WRONG})) AS a,
        list_transform({_J}, lambda j: ({_total("CASE WHEN v[i][j] = 0 THEN n[i] * (1 - p[i]) ELSE 0.0::DOUBLE END")} + {RIGHT}) / ({_total("CASE WHEN v[i][j] >= 0 THEN n[i] * (1 - p[i]) ELSE 0.0::DOUBLE END")} + {RIGHT + WRONG})) AS b
      FROM steps WHERE step < {STEPS} AND moved >= 1e-9))),
final AS (SELECT unnest(v) AS votes, unnest(p) AS p FROM (SELECT * FROM steps ORDER BY step DESC LIMIT 1))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words) AS base_failed,
       NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words) AND p >= {KEPT_FROM} AS kept, round(p, 6) AS probability
FROM voted JOIN final USING (votes)"""
