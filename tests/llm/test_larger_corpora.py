"""What must not grow with the corpus: bytes sent through the driver, texts that are shuffled, memory that workers keep."""

import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from monthgrain.llm import common, line_chunks, simhash


def test_many_bytes_of_sets_are_not_broadcast_whole(spark, monkeypatch):
    calls, plain = [], simhash.look_up
    monkeypatch.setattr(simhash, "look_up", lambda *a: calls.append(a[1]) or plain(*a))
    base = np.arange(60_000, dtype=np.uint64)
    sets = spark.createDataFrame([(k, bytearray((base + (k % 3) * 30_000).tobytes())) for k in range(12)], "node long, set binary")
    pairs = spark.createDataFrame([(a, b) for b in range(12) for a in range(b + 1, 12)] + [(1, 0)], "a long, b long")
    found = {tuple(r) for r in simhash._verified(pairs, sets).collect()}
    assert found == {(a, b) for b in range(12) for a in range(b + 1, 12) if a % 3 == b % 3} and calls == ["b"]


def test_near_copies_broadcast_only_what_is_bounded(spark, monkeypatch):
    for name in ("FEW_KEYS", "FEW_NODES", "FEW_BYTES"):
        monkeypatch.setattr(simhash, name, 0)
    words = [f"w{i}" for i in range(300)]
    docs = spark.createDataFrame([(i, " ".join(words[i // 4 * 9 :][:60] + [str(i % 4)])) for i in range(40)], "doc_id long, text string")
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    assert simhash.drop_near_copies(docs).count() == 10
    ran = store.executionsList(before, 1000)
    plans = [ran.apply(i).physicalPlanDescription() for i in range(ran.size())]
    keys = [k for p in plans for k in re.findall(r"BroadcastHashJoin.*\nLeft keys.*\nRight keys \[\d+\]: \[(\w+)", p)]
    assert keys and set(keys) == {"_hot_key"}


def test_no_text_of_a_line_is_shuffled_to_count_it(spark):
    docs = spark.createDataFrame([(1, "one line\ntwo lines\n"), (2, "two lines\nthree\n")], "doc_id long, text string")
    repeated = line_chunks.repeated_lines(docs)
    plan = repeated._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and [r["count"] for r in repeated.collect()] == [2]


def test_lines_of_one_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(line_chunks, "_line_hash", lambda line: F.length(line).cast("long"))
    docs = spark.createDataFrame([(1, "abc\nde\n"), (2, "abd\nde\n")], "doc_id long, text string")
    assert [(r.h, r["count"]) for r in line_chunks.repeated_lines(docs).collect()] == [(3, 2)]


@pytest.mark.parametrize("few", [line_chunks.FEW_CLASHES, 0])
def test_lines_of_one_hash_are_deduped_like_others(spark, monkeypatch, few):
    """By the SQL, which knows of no hashes of lines, where most hashes stand for several lines."""
    monkeypatch.setattr(line_chunks, "_line_hash", lambda line: F.length(line).cast("long"))
    monkeypatch.setattr(line_chunks, "FEW_CLASHES", few)
    passages = ["one line\ntwo more\nnow three\n", "own line\ntwo more\nnew three\n", "a\nbc\ndef\nghij\n", "x\nyz\ndef\nklmn\nopqrs\n"]
    rows = [(i, f"begin {i * 7}.\n{passages[i % 4]}{passages[i % 3]}end {i}") for i in range(24)]
    rows += [rows[3], (None, rows[5][1]), (30, None), (31, ""), (4, rows[8][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    documents = docs.toPandas().astype({"doc_id": "Int64"})  # which DuckDB finds by its name
    want = duckdb.sql(line_chunks.SQL).fetchall()
    got = [tuple(r) for r in line_chunks.dedup_lines(docs).select("doc_id", "text", "n_lines", "removed_lines").collect()]
    assert len(documents) == len(got) and sorted(got, key=repr) == sorted(want, key=repr) and sum(r[3] for r in got) > 100


class _Captured:
    def select(self, *_):
        return self

    def mapInArrow(self, run, _):  # noqa: N802
        return run


def test_workers_give_memory_back_after_a_task(monkeypatch):
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    run = common.arrow_map(_Captured(), lambda: lambda x: [x], "x long", ["x"])
    batches = list(run(iter([pa.RecordBatch.from_arrays([pa.array([1, 2])], ["x"])])))
    assert batches[0].column(0).to_pylist() == [1, 2] and given == [1]


def test_giving_back_is_harmless():
    common.give_back()
