"""Every form of writing meant to slip past word lists, with all learned words."""

import math
import random

import pytest

from monthgrain.llm import toxicity
from monthgrain.llm.queries import labels

SIGNS = {"o": "0", "i": "1", "z": "2", "e": "3", "a": "4", "s": "5", "g": "6", "t": "7", "b": "8", "l": "1"}
FORMS = {
    "signs": lambda w: "".join(SIGNS.get(c, c) for c in w),
    "last sign": lambda w: next((w[:i] + SIGNS[w[i]] + w[i + 1 :] for i in reversed(range(len(w))) if w[i] in SIGNS), None),
    "first doubled": lambda w: w[0] + w,
    "all doubled": lambda w: "".join(c * 2 for c in w),
    "last doubled": lambda w: w + w[-1],
    "thrice": lambda w: "".join(c * 3 for c in w),
    "spaced": " ".join,
    "double blanks": "  ".join,
    "slashes": "/".join,
    "mixed gaps": " - ".join,
    "halves": lambda w: f"{w[: len(w) // 2]} {w[len(w) // 2 :]}" if 4 <= len(w) <= 6 else None,
    "twos": lambda w: "-".join(w[i : i + 2] for i in range(0, len(w), 2)) if len(w) > 3 else None,
    "threes": lambda w: "_".join(w[i : i + 3] for i in range(0, len(w), 3)) if len(w) > 3 else None,
}


@pytest.fixture(scope="module")
def scorer(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return toxicity.Scorer(toxicity.fit(docs, labels(spark, "/root/testdata/sf0.01")))


@pytest.mark.parametrize("form", FORMS)
def test_every_learned_word_in_every_form(scorer, form):
    words = toxicity._words_of(scorer.model.weights)
    assert words
    tried = [(w, x) for w in words if (x := FORMS[form](w)) and x != w and any(c.isalpha() for c in x)]
    texts = [f"there was one {x}, wherever they went" for _, x in tried]
    plain = scorer.scores([f"there was one {w}, wherever they went" for w, _ in tried])
    missed = [x for (_, x), a, b in zip(tried, plain, scorer.scores(texts), strict=True) if b < a - 1e-9]
    assert tried and not missed


def test_short_words_and_what_is_left_alone():
    hidden = toxicity.Hidden(["ass", "die", "kill", "stupid", "loser"], frozenset({"looser"}))
    for text, word in {"a55": "ass", "a$$!": "ass", "d13": "die", "k111 him": "kill", "s  t  u p/i--d": "stupid", "st-up-id": "stupid", "l0os3rr": "loser"}.items():
        assert word in {w for w, _ in hidden.found([text])[0]}, text
    assert hidden.found(["looser, in 1955 as so on a die, killer 42 and 3.5, no. 7"]) == [set()]


def _found(hidden, text):
    """As by `found`, but following the readings of every token and of every run of short pieces."""
    out = {(w, t) for t in toxicity.TOKENS.findall(text) for w in hidden.of_token(t)}
    spans = [m.span() for m in toxicity.TOKENS.finditer(text)]
    run = []
    for a, b in [*spans, (len(text), len(text) + 9)]:
        if b - a > 3:
            if len(run) > 1:
                out.update(hidden.of_pieces(text[run[0][0] : run[-1][1]]))
            run = []
        else:
            run.append((a, b))
    return {x for x in out if x[0] != x[1] and x[1] not in hidden.ordinary}


def test_nothing_is_overlooked():
    """What may hold a word is found in any text: all readings everywhere give no more."""
    rng = random.Random(8)
    hidden = toxicity.Hidden(["ass", "kill", "stupid", "loser", "idiot", "ill", "bb", "zoo", "naïve"], frozenset({"looser"}))
    pieces = [*"asidtlkoeubpr1!|05$34@7+€9zï _-.,\n²½৩Ω漢", "ass", "kil", "stu", "pid", "los", "er", "1d10t", "zo", "na", "ïv"]
    texts = ["".join(rng.choice(pieces) + rng.choice(["", "", " ", "  ", "-"]) for _ in range(rng.randrange(60))) for _ in range(3000)]
    want = [_found(hidden, t) for t in texts]
    assert hidden.found(texts) == want and sum(map(bool, want)) > 500
    assert hidden.found([]) == [] and toxicity.Hidden([]).found(["ass"]) == [set()]


def test_how_frequent_a_feature_must_be():
    """As by trying every frequency: the least one whose best ratio passes among those that have it or more."""
    rng = random.Random(9)
    for _ in range(200):
        counts = {rng.randrange(1, 40): rng.randrange(1, 5000) for _ in range(rng.randrange(1, 12))}
        share = rng.choice([0.01, 0.2, 0.7, 1.0])
        passing = [k for k in counts if k * math.log((k + 0.5) / (k + 1) / share) > math.log(toxicity.MARGIN * sum(n for j, n in counts.items() if j >= k))]
        rarest = min((k for k in passing if all(j in passing for j in counts if j >= k)), default=max(counts) + 1)
        assert toxicity.frequent_enough(counts, share) == (rarest, sum(n for j, n in counts.items() if j >= rarest))
