"""Columns of the documents that are named like anything the operators use inside, and of any type."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from monthgrain.llm import decontamination, language, line_chunks, mixing, pseudonyms, quality, simhash, toxicity, winnowing
from monthgrain.llm.queries import EXAMPLE_KEY, labels, tokenizer_path
from monthgrain.llm.token_records import token_records

#: Every string in the operators' code that could be a column's name.
NAMES = sorted({n for f in Path(simhash.__file__).parent.glob("*.py") for n in re.findall(r'"([A-Za-z_][A-Za-z_0-9]{0,24})"', f.read_text())} - {"doc_id", "text", "lang", "source", "n_chars"})


@pytest.fixture(scope="module")
def named(spark):
    rows = [(i, f"some words of text {i % 3} and of others", "en", "ab"[i % 2], 9) for i in range(8)] + [(None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").coalesce(1)
    kinds = [F.lit("x"), F.create_map(F.lit("k"), F.lit(1)), F.array(F.lit(1)), F.struct(F.lit(1).alias("f")), F.lit(None).cast("string")]
    once = {n.lower(): n for n in NAMES}.values()
    return docs.select("*", *(kinds[k % 5].alias(n) for k, n in enumerate(once)), F.lit(1).alias("a.b"))


def test_names_are_many():
    assert len(NAMES) > 200 and {"_salt", "row_hash", "chosen_id", "pseudonyms", "hot", "gone"} <= set(NAMES)


KEEPING = {
    "near_duplicates": lambda d: simhash.drop_near_duplicates(d),
    "near_copies": lambda d: simhash.drop_near_copies(d),
    "decontamination": lambda d: decontamination.keep_clean(d, d.sparkSession.createDataFrame([(1, "no such words as these anywhere")], "item_id long, text string")),
    "decontamination_slices": lambda d: decontamination.keep_clean(d, d.sparkSession.createDataFrame([(i, f"no such words as {i}") for i in range(3)], "item_id long, text string"), most=5),
    "mix": lambda d: mixing.mix(d, mixing.word_count(F.col("text"))),
    "toxicity": lambda d: toxicity.keep_clean(d, toxicity.fit(d, labels(d.sparkSession, "/root/testdata/sf0.001"))),
}


@pytest.mark.parametrize("name", KEEPING)
def test_columns_pass_through(named, name):
    kept = KEEPING[name](named)
    assert kept.columns == named.columns and kept.schema == named.schema
    assert {str(r) for r in kept.collect()} <= {str(r) for r in named.collect()} and kept.count() > 0


@pytest.mark.parametrize("name,made", [("line_chunks", ["n_lines", "removed_lines"]), ("pseudonyms", ["pii"])])
def test_columns_pass_beside_new_ones(named, name, made):
    out = line_chunks.dedup_lines(named) if name == "line_chunks" else pseudonyms.pseudonyms(named, EXAMPLE_KEY)
    rest = [c for c in named.columns if c not in made]
    assert out.columns == rest + made
    names = [f"`{c}`" for c in rest if c != "text"]
    assert sorted(map(str, out.select(*names).collect())) == sorted(map(str, named.select(*names).collect()))


def test_columns_are_ignored(spark, named):
    size = mixing.word_count(F.col("text"))
    some = labels(spark, "/root/testdata/sf0.001")
    for rows in (
        winnowing.fingerprints(named), winnowing.edited_fingerprints(named), simhash.near_duplicates(named), mixing.decide(named, size), quality.scores(named, quality.fit(named, some)),
        toxicity.scores(named, toxicity.fit(named, some)), token_records(named, tokenizer_path()), language.predictions(named, language.fit(named)),
    ):
        assert rows.count() == named.count()
