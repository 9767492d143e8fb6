"""Invariants of the panel, its views and seasonality."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from monthgrain import functions as fn
from monthgrain import schema
from monthgrain.operators import catalog, export, facts, families, season, series
from monthgrain.plans import Store
from monthgrain.sources import literals, raw


@pytest.fixture(scope="module")
def store(spark, small):
    return Store.of(spark, small)


def test_tables_have_their_declared_columns(store):
    for name, df in {"observations_5y": store.observations_5y, "observations_1y": store.observations_1y, "areas": store.areas}.items():
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema.TABLES[name]]


def test_leaves_add_up_to_published_totals(spark, small):
    from monthgrain.queries import QUERIES

    rows = QUERIES["reconcile_totals"](spark, small)
    assert rows.count() > 100 and rows.filter("difference <> 0").isEmpty()


def test_sums_over_views_never_count_totals(store):
    raw_sum = store.observations_5y.filter("measure = 'population'").agg(F.sum("value")).first()[0]
    leaf_sum = store.views["v_population_5y"].agg(F.sum("value")).first()[0]
    assert raw_sum == 2 * leaf_sum


def _months(spark, values, missing=()):
    rows = [("k", "k", f"{2000 + i // 12}-{i % 12 + 1:02d}-01", v) for i, v in enumerate(values) if i not in missing]
    return season.month_panel(spark.createDataFrame(rows, "key_code string, area_name string, reference_date string, value long"), "value", "0000")


def test_a_missing_month_empties_its_windows(spark):
    panel = _months(spark, [100 + i for i in range(40)], missing={20})
    kept = {r.month_index - 24001 for r in season.ratios(panel, ("key_code",)).collect()}
    assert kept == set(range(6, 14)) | set(range(27, 34))
    by_rows = Window.partitionBy("key_code").orderBy("month_index").rowsBetween(-6, 6)  # what must not be done
    assert panel.withColumn("n", F.count("*").over(by_rows)).filter("n = 13").count() == 39 - 12


def test_index_averages_one(spark):
    index = season.seasonal_index(_months(spark, [100 + (i * 7) % 12 for i in range(72)]))
    assert abs(index.agg(F.avg("seasonal_index")).first()[0] - 1) < 1e-5 and index.count() == 12


def test_of_equal_months_the_earliest_is_meant(spark):
    rows = [("k", "k", f"{m:02d}", 2.5 if m in (4, 9) else -1.0 if m in (2, 11) else 0.0) for m in range(1, 13)]
    got = season.strength(spark.createDataFrame(rows, "key_code string, area_name string, month string, pct_vs_trend double")).first()
    assert (got.peak_month, got.trough_month, got.amplitude_pct) == ("04", "02", 3.5)


def test_zero_trend_is_left_out(spark):
    assert season.seasonal_index(_months(spark, [0] * 40)).isEmpty()
    assert season.ratios(_months(spark, [19] * 40), ("key_code",), 20, strict=False).isEmpty()
    assert not season.ratios(_months(spark, [20] * 40), ("key_code",), 20, strict=False).isEmpty()


def test_one_shuffle_for_all_frames(spark):
    plan = season.ratios(_months(spark, [1] * 40), ("key_code",))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Window ") == 1


@pytest.mark.parametrize("call", [
    lambda: schema.a_date("2020-1-01"), lambda: schema.a_month("13"), lambda: schema.a_key("12345"), lambda: schema.a_year_month("2020-00"),
    lambda: schema.a_sha("x"), lambda: schema.a_dataset("A b"), lambda: schema.a_period("2020-02-01", "2020-01-01"), lambda: schema.a_period("2020-01-01", "2020-01-01", strict=True),
    lambda: schema.area_keys("123456,x", 20), lambda: schema.area_keys([f"{i:06d}" for i in range(21)], 20), lambda: schema.resolve_measure("1y", "households"), lambda: schema.resolve_measure("5y", "cats"),
])
def test_bad_parameters_are_errors(call):
    with pytest.raises(ValueError):
        call()


def test_month_arithmetic():
    assert schema.months_between("1999-11", "2001-02") == 16
    assert schema.add_months("1999-11", 23) == "2001-10"
    assert schema.area_keys(" 123456 ,1234567", 20) == ["123456", "1234567"]


def test_families_refuse_and_explain(store):
    store.register()
    s = store.spark
    with pytest.raises(ValueError):
        families.trend(s, "asia5", "1996-01-01", "1997-01-01")
    with pytest.raises(ValueError):
        families.ranking(s, "pop5", "1997-01-01", "1997-01-01")
    with pytest.raises(ValueError):
        families.seasonality(s, "pop5", "profile")
    r = families.trend(s, "pop5", "1996-01-01", "1997-01-01", ["00000001"])
    assert s.sql(r.sql, args=r.params).collect() == r.df.collect() and "areas: 1" in r.notes and r.notes[0].startswith("view: v_population_5y")
    assert families.seasonality(s, "pop5", "age", "00000001", measure="households").df.isEmpty()
    ranked = families.ranking(s, "pop5", "1996-01-01", "2000-06-01")
    assert ranked.extra["safe_from"].first()[0] == "1997-07-01" and s.sql(ranked.sql, args=ranked.params).collect() == ranked.df.collect()


def test_growth_from_nothing(spark):
    rows = spark.createDataFrame([("a", "2000-01-01", 0), ("a", "2000-02-01", 5), ("b", "2000-01-01", None), ("b", "2000-02-01", 4)], "key_code string, reference_date string, value long")
    assert {r.key_code: r.rate for r in series.endpoints(rows).collect()} == {"a": 0.0, "b": 0.0}
    got = {(r.key_code, r.reference_date): r.index_value for r in series.rebased(rows).collect()}
    assert got["a", "2000-02-01"] is None and got["b", "2000-02-01"] == 100.0


def test_column_functions(spark):
    df = spark.createDataFrame([('a"b', "5-9", "unknown", "本町3丁目", 1234.0), ("x,y", "85+", "", "plain", -5.0), (None, "total", None, None, None)], "t string, a string, u string, n string, v double")
    got = df.select(fn.csv_cell(F.col("t")), fn.age_order(F.col("a")), fn.display_age_order(F.col("u")), fn.town_of(F.col("n")), fn.shown_change(F.col("v")), fn.shown_kilobytes(F.col("v"))).collect()
    assert [tuple(r) for r in got[:2]] == [('"a""b"', 5, 9999, "本町", "+1,234", "1 KB"), ('"x,y"', 85, 9998, "plain", "-5", "0 KB")]
    assert got[2][0] == "" and got[2][1] == 999
    labels = spark.createDataFrame([(9, 10), (1, 10), (3, 4), (1, 4), (1, 2), (0, 0)], "a long, y long").select(fn.consistency(F.col("a"), F.col("y")))
    assert [r[0] for r in labels.collect()] == ["above every year", "below every year", "above most years", "below most years", "differs by year", None]


def test_exports(store, tmp_path):
    store.register()
    s = store.spark
    with pytest.raises(ValueError, match="try 1996-01 to 1997-12"):
        export.export_rows(s, "pop5", "population", "1996-01", "1998-01")
    with pytest.raises(ValueError):
        export.export_rows(s, "pop1", "households", "1996-01", "1996-02")
    r = export.export_rows(s, "pop5", "published_totals", "1996-01", "1997-12")
    chunks = list(export.csv_chunks(r.df, 50))
    text = "".join(chunks)
    assert text.startswith("﻿muni_code,key_code") and len(text.splitlines()) == r.df.count() + 1 and len(chunks) > 2
    dates = [x.split(",")[3] for x in text.splitlines()[1:]]
    assert dates == sorted(dates)
    export.write_csv(r.df, str(tmp_path / "csv"))
    parts = sorted((tmp_path / "csv").glob("part-*"))
    lines = [p.read_text(encoding="utf-8").splitlines() for p in parts]
    assert all(x[0] == "\ufeffmuni_code,key_code,area_name,reference_date,measure,value" for x in lines)
    assert [y for x in lines for y in x[1:]] == text.splitlines()[1:]
    pages = [export.page(r.df, 100, n).collect() for n in range(9)]
    assert [x for p in pages for x in p] == r.df.collect() and pages[-1] == []


def test_raw_files(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "2").write_bytes(b"bytes")
    files, sources, datasets = (literals.frame(spark, t) for t in ("source_files", "dataset_sources", "datasets"))

    def status(i):
        try:
            return bytes(raw.read_raw_file(spark, raw.raw_file_entry(files, sources, datasets, literals.SHA[i]), str(tmp_path)).head().content)
        except raw.NotAvailable as e:
            return e.status

    assert [status(i) for i in (1, 2, 3, 5, 6)] == [b"bytes", 403, 502, 404, 404]


def test_number_checks(spark):
    texts = spark.createDataFrame([("12.35 and 12 and 12.4 and 24",), ("12.36",), ("-3.1 not 3.1",), ("",)], "text string")
    got = facts.verify_numbers(texts, F.lit(literals.FACTS)).collect()
    assert [r.ok for r in got] == [True, False, False, True] and got[1].bad == [12.36]


def test_insight_retries_once_and_rejects(spark):
    rows = spark.createDataFrame([("x", 12.5)], "area string, pct double")
    asked = []

    def writer(told, wrong):
        asked.append(wrong)
        return "up 12.5" if wrong else "up 99.9"

    assert facts.insight(rows, writer)["ok"] and asked == [[], ["99.9"]]
    assert facts.insight(rows, lambda told, wrong: "up 99.9")["text"] is None


def test_caveats(spark):
    got = facts.caveats(literals.frame(spark, "dataset_gaps").filter("dataset_key = 'pop5'"), literals.frame(spark, "known_issues"), ["fixed"]).first().caveats
    assert got[0] == "fixed" and len(got) == 7 and not any("1994" in c for c in got)


def test_numbers_of_caveats_may_be_used(spark):
    texts = spark.createDataFrame([("since 1995 and 12.5",), ("since 1995 and 77.7",)], "text string")
    told = F.array(F.lit("only months from 1995-01 on"))
    assert [r.ok for r in facts.verify_numbers(texts, F.lit('{"pct": 12.5}'), told).collect()] == [True, False]
    assert [r.ok for r in facts.verify_numbers(texts, F.lit('{"pct": 12.5}')).collect()] == [False, False]


def test_coverage_with_holes(spark):
    """Months within the span without rows are missing, or not loaded if there are files; outside only the latter count."""
    periods = spark.createDataFrame([("pop5", f"1998-{m:02d}-01", f, n) for m, f, n in ((1, 1, 0), (2, 1, 5), (3, 0, 0), (5, 2, 0), (6, 0, 7), (9, 0, 0))], "dataset_key string, reference_date string, file_count long, obs_rows long")
    gaps = spark.createDataFrame([("pop5", "1998-04-01", "upstream_missing", "x", "t")], literals.frame(spark, "dataset_gaps").schema)
    covered = catalog.coverage(periods, gaps, literals.frame(spark, "datasets"))
    assert [(r.ym, r.state, r.files, r.gap_kind) for r in covered.orderBy("ym").collect()] == [
        ("1998-01", "not_loaded", 1, None), ("1998-02", "ok", 1, None), ("1998-03", "missing", 0, None),
        ("1998-04", "missing", 0, "upstream_missing"), ("1998-05", "not_loaded", 2, None), ("1998-06", "ok", 0, None),
    ]


def test_dense_rows_and_places_of_notes(spark):
    split = spark.createDataFrame([("2000-01-01", "a", "A", 1), ("2000-03-01", "a", "A", None), ("2000-03-01", "b", "B", 4)], "reference_date string, key_code string, area_name string, value long")
    assert sorted((r.key_code, r.reference_date, r.value) for r in series.aligned(split).collect()) == [("a", "2000-01-01", 1), ("a", "2000-03-01", None), ("b", "2000-01-01", None), ("b", "2000-03-01", 4)]
    notes = spark.createDataFrame([("1999-12-01", "k"), ("2000-02-01", "k"), ("2000-03-01", "k"), ("2000-04-01", "k")], "reference_date string, kind string")
    got = {r.gap_date: (r.before_date, r.after_date, r.on_month) for r in series.placed_gaps(notes, split).collect()}
    assert got == {"2000-02-01": ("2000-01-01", "2000-03-01", False), "2000-03-01": ("2000-03-01", "2000-03-01", True), "2000-04-01": ("2000-03-01", None, False)}


def test_stores_see_new_files_and_are_closed(spark, small, tmp_path):
    import shutil

    for t in ("lineitem", "orders", "customer", "part", "nation", "region"):
        shutil.copy(f"{small}/{t}.parquet", tmp_path / f"{t}.parquet")
    total = lambda: Store.of(spark, str(tmp_path)).views["v_population_5y"].agg(F.sum("value")).first()[0]
    before, first = total(), Store.of(spark, str(tmp_path))
    assert first.panel.lines.is_cached and Store.of(spark, str(tmp_path)) is first
    half = spark.read.parquet(f"{small}/lineitem.parquet").filter("l_orderkey % 2 = 0").toPandas()
    (tmp_path / "lineitem.parquet").unlink()
    half.to_parquet(tmp_path / "lineitem.parquet", coerce_timestamps="us")
    assert total() < before and "lines" not in first.panel.__dict__
    for i in range(Store.KEPT + 1):
        Store.of(spark, small if i % 2 else str(tmp_path))
    assert len(Store._open) <= Store.KEPT


def test_changes_to_catalog_tables(spark):
    runs = literals.frame(spark, "sync_runs")
    with pytest.raises(ValueError):
        catalog.add_column(runs, "Status", "string")
    assert catalog.add_column(runs, "note", "string").filter("note IS NULL").count() == runs.count()


def test_refresh_is_idempotent(store):
    def periods():
        return catalog.refresh_periods(store.literal("source_files"), store.literal("dataset_sources"), store.literal("datasets"), store.observations_5y, store.observations_1y)

    again = catalog.merge_upsert(periods(), periods(), ["dataset_key", "reference_date"], {"file_count": 0, "obs_rows": 0})
    assert sorted(again.collect()) == sorted(periods().collect())


def test_late_files_replace_their_months(spark, tmp_path):
    from monthgrain import streaming

    kind = "muni_code string, reference_date string, value long"
    source, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    for rows in ([("m", "2000-01-01", 1), ("m", "2000-02-01", 2)], [("m", "2000-02-01", 5)]):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(source)
        streaming.replace_months(spark.readStream.schema(kind).parquet(source), target, check).awaitTermination()
    assert sorted((r.reference_date, r.value) for r in streaming.current(spark, target).collect()) == [("2000-01-01", 1), ("2000-02-01", 5)]


def test_seasonal_views_can_be_kept(store, tmp_path):
    season.materialise({"s": store.seasonal_views["v_nl_seasonality"]}, str(tmp_path))
    assert store.spark.read.parquet(str(tmp_path / "s")).count() == store.seasonal_views["v_nl_seasonality"].count()
    kept = store.kept("v_nl_seasonality_age")
    assert kept.schema.names == store.seasonal_views["v_nl_seasonality_age"].schema.names and sorted(kept.collect()) == sorted(store.seasonal_views["v_nl_seasonality_age"].collect())
    rows = store.spark.createDataFrame([("k", "A", "0-4", 0, f"{m:02d}", 1.0, 0.5, 1, 2) for m in range(1, 13)], kept.schema)
    season.materialise({"v_nl_seasonality_age": rows}, str(tmp_path))
    one = season.kept_view(store.spark, str(tmp_path), "v_nl_seasonality_age", kept.schema).filter("month = '09'")
    assert "PartitionFilters: [isnotnull(month" in one._jdf.queryExecution().executedPlan().toString() and one.count() == 1 and one.first().month == "09"
