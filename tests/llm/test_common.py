"""What the corpus operators share."""

import random

import pytest
from pyspark.sql import functions as F

from monthgrain.llm import common


@pytest.mark.parametrize("hot_keys", [5, 1000])
def test_look_up_is_a_left_join(spark, monkeypatch, hot_keys):
    """With keys that hold a third of all rows, keys of text and of numbers, null keys, and keys without a row."""
    monkeypatch.setattr(common, "HOT_KEYS", hot_keys)
    rng = random.Random(1)
    keys = [1] * 300 + [2] * 200 + [rng.randrange(3, 90) for _ in range(400)] + [None] * 30
    for as_text in (False, True):
        key = F.col("k").cast("string") if as_text else F.col("k")
        rows = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i long, k long").select("i", key.alias("k"))
        table = spark.createDataFrame([(k, keys.count(k), f"v{k}", None if k % 3 else k) for k in set(keys) - {None, 5, 6}], "k long, n long, v string, w long").select(key.alias("k"), "n", "v", "w")
        got = common.look_up(rows, "k", table, "n", len(keys), ["i"])
        want = rows.join(table.drop("n"), "k", "left").select("i", "k", "v", "w")
        assert got.columns == ["i", "k", "v", "w"] and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        broadcast = table.filter(F.col("n") * hot_keys > len(keys)).count()
        assert broadcast <= hot_keys


def test_rows_of_any_type_have_a_hash(spark):
    rows = spark.createDataFrame([({"a": 1}, [{"b": 2}], "x"), ({"a": 1}, [{"b": 2}], "x"), ({"a": 2}, [{"b": 2}], "x"), (None, None, None)], "m map<string,int>, l array<map<string,int>>, `a.b` string")
    hashes = [r[0] for r in rows.select(common.row_hash(rows)).collect()]
    assert hashes[0] == hashes[1] and len(set(hashes)) == 3
    assert common.own_name(rows, "M") == "_M" and common.own_name(rows, "n") == "n"


def test_scratch_is_where_all_executors_see_it(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert common.scratch_path(spark, "x").startswith(named.rstrip("/") + "/x-")
    path = common.scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    common.discard(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
