"""Operators on rows made for a case each, with their SQL; and notes and texts."""

import pytest
from pyspark.sql import functions as F

from monthgrain import functions as fn
from monthgrain.operators import catalog, facts, families, season, series
from monthgrain.plans import RecordStore, Store
from monthgrain.queries import _PANEL, _catalog_sql, _season_sql, _strength_sql
from monthgrain.plans import BREAK_DATE
from monthgrain.schema import TABLES
from monthgrain.sources import literals, records

from .conftest import same_rows

_SERIES = "panel0(key_code, month_index, value) AS (VALUES " + ", ".join(map(str, literals.SERIES)) + "), series AS (SELECT key_code, key_code AS area_name, lpad(CAST((month_index - 1) // 12 AS VARCHAR), 4, '0') || '-' || lpad(CAST((month_index - 1) % 12 + 1 AS VARCHAR), 2, '0') || '-01' AS reference_date, value FROM panel0)"
_TOWNS = "named(key_code, area_name) AS (VALUES " + ", ".join(map(str, literals.TOWNS)) + "), parted AS (SELECT *, CASE WHEN regexp_extract(area_name, '^(.+?)(\\d+)丁目$', 1) = '' THEN area_name ELSE regexp_extract(area_name, '^(.+?)(\\d+)丁目$', 1) END AS town, coalesce(TRY_CAST(regexp_extract(area_name, '(\\d+)丁目$', 1) AS INTEGER), 0) AS block FROM named)"
_SHOWN = "shown(id, v) AS (VALUES " + ", ".join(f"({i}, {'NULL' if v is None else v})" for i, v in literals.SHOWN) + ")"
_REPLIES = "replies(id, reply) AS (VALUES " + ", ".join(f"({i}, '{t}')" for i, t in literals.REPLIES) + "), found AS (SELECT *, regexp_extract(reply, '(?s)\\{.*\\}') AS o FROM replies)"
_TEXTS = "texts(id, text) AS (VALUES " + ", ".join(f"({i}, '{t}')" for i, t in literals.TEXTS) + f"), allowed AS (SELECT CAST(unnest(regexp_extract_all('{literals.FACTS}', '-?[0-9]+(?:\\.[0-9]+)?')) AS DOUBLE) AS f UNION ALL SELECT CAST(unnest(generate_series(0, 24)) AS DOUBLE)), found AS (SELECT id, CAST(unnest(regexp_extract_all(text, '-?[0-9]+(?:\\.[0-9]+)?')) AS DOUBLE) AS n FROM texts)"


def check(duck, df, sql):
    same_rows(df.toPandas(), duck.execute(f"WITH {sql}").fetchdf())


def test_a_missing_month_and_ties(spark, duck):
    rows = spark.createDataFrame(literals.SERIES, "key_code string, i int, value long")
    date = F.format_string("%04d-%02d-01", ((F.col("i") - 1) / 12).cast("int"), (F.col("i") - 1) % 12 + 1)
    panel = season.month_panel(rows.select("key_code", F.col("key_code").alias("area_name"), date.alias("reference_date"), "value"), "value", "1900-01-01")
    check(duck, season.strength(season.seasonal_index(panel)), f"{_SERIES},{_season_sql('gapped', 'series', 'value').replace(BREAK_DATE, '1900-01-01')},{_strength_sql('gapped_strength', 'gapped')} SELECT * FROM gapped_strength")


def test_towns(spark, duck):
    named = spark.createDataFrame(literals.TOWNS, "key_code string, area_name string")
    check(duck, series.towns(named).withColumn("areas", F.array_join("areas", ",")), f"{_TOWNS} SELECT town, string_agg(area_name, ',' ORDER BY block, key_code) AS areas, count(*) AS n_areas FROM parted GROUP BY town")


def test_shown_numbers(spark, duck):
    rows = spark.createDataFrame(literals.SHOWN, "id long, v long")
    out = rows.select("id", fn.shown_number(F.col("v")).alias("number"), fn.shown_change(F.col("v")).alias("change"), fn.shown_kilobytes(F.col("v")).alias("kilobytes"))
    check(duck, out, f"{_SHOWN} SELECT CAST(id AS BIGINT) AS id, format('{{:,}}', v) AS number, CASE WHEN v > 0 THEN '+' ELSE '' END || format('{{:,}}', v) AS change, CASE WHEN v IS NULL OR v = 0 THEN '—' ELSE CAST(CAST(floor(v / 1024.0 + 0.5) AS BIGINT) AS VARCHAR) || ' KB' END AS kilobytes FROM shown")


def test_objects_in_texts(spark, duck):
    rows = spark.createDataFrame(literals.REPLIES, "id long, reply string")
    out = rows.withColumn("o", fn.first_object(F.col("reply"), "limits string, n long")).select("id", "o.limits", "o.n")
    check(duck, out, f"{_REPLIES} SELECT CAST(id AS BIGINT) AS id, CASE WHEN o <> '' THEN o->>'limits' END AS limits, CASE WHEN o <> '' THEN CAST(o->>'n' AS BIGINT) END AS n FROM found")


def test_numbers_of_texts(spark, duck):
    checked = facts.verify_numbers(spark.createDataFrame(literals.TEXTS, "id long, text string"), F.lit(literals.FACTS))
    out = checked.select("id", F.array_join(F.transform(F.sort_array("bad"), lambda x: x.cast("string")), ",").alias("bad"), "ok")
    check(duck, out, f"{_TEXTS} SELECT CAST(id AS BIGINT) AS id, coalesce(string_agg(CAST(n AS VARCHAR), ',' ORDER BY n) FILTER (n IS NOT NULL), '') AS bad, count(n) = 0 AS ok FROM texts LEFT JOIN (SELECT DISTINCT id, n FROM found WHERE NOT EXISTS (SELECT 1 FROM allowed WHERE abs(n - f) < 0.005 OR n = floor(f + 0.5) OR abs(n - round(f, 1)) < 0.005)) USING (id) GROUP BY id")


def test_literal_catalog(spark, small, duck):
    """Health, history, upsert and versions over the literal tables, where each case is one row."""
    s = Store.of(spark, small)
    needs = _catalog_sql(_PANEL)
    joined = s.literal("datasets").select("dataset_key").join(catalog.file_health(s.literal("source_files"), s.literal("dataset_sources")), "dataset_key", "left").join(catalog.run_health(s.literal("sync_runs")), "dataset_key", "left")
    check(duck, joined, f"{needs} SELECT d.dataset_key, last_ingested_at, files_total, files_skipped, last_run_at, last_ok_at FROM datasets d LEFT JOIN file_health USING (dataset_key) LEFT JOIN run_health USING (dataset_key)")
    current = {r.sha256[-1]: r.is_current for r in catalog.mark_current(s.literal("source_files")).collect()}
    assert current["1"] == 0 and current["2"] == 1
    offered = {r.sha256[-1]: r.offered for r in catalog.file_history(s.literal("source_files"), s.literal("dataset_sources"), s.literal("datasets")).collect()}
    assert offered == {"1": 0, "2": 1, "3": 0, "4": 1, "5": 1}
    counts = catalog.mapped_files(s.literal("source_files"), s.literal("dataset_sources")).filter("status = 'ingested'").groupBy("dataset_key", "reference_date").agg(F.count("*").alias("file_count"))
    merged = {(r.dataset_key, r.reference_date): (r.file_count, r.obs_rows) for r in catalog.merge_upsert(s.literal("dataset_periods"), counts, ["dataset_key", "reference_date"], {"file_count": 0, "obs_rows": 0}).collect()}
    assert merged["pop5", "1995-01-01"] == (2, 0) and merged["pop5", "2003-01-01"] == (1, 0) and merged["asia5", "1995-01-01"] == (1, 5) and merged["asia5", "1995-04-01"] == (1, 0)


@pytest.mark.parametrize("table", sorted(records.MAKERS))
def test_drawn_tables_are_as_by_sql(spark, small, duck, table):
    df = RecordStore.of(spark, small).literal(table)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in TABLES[table]]
    count = duck.execute(f"SELECT count(*) FROM ({records.SQL[table]})").fetchone()[0]
    assert df.count() == count > 0


# --- notes and texts ---------------------------------------------------------------------------------


def test_notes_are_what_the_plan_does(spark, small):
    Store.of(spark, small).register()
    r = families.trend(spark, "pop5", "1996-01-01", "1997-01-01")
    notes = r.plan_notes()
    assert notes[0] == "view: v_population_5y" and "where: muni_code = '000001'" in notes and "by: reference_date" in notes and any(n.startswith("within: ") and "'total'" in n for n in notes)
    other = families.trend(spark, "pop5", "1996-02-01", "1997-01-01", ["00000001"]).plan_notes()
    assert any("1996-02-01" in n for n in other) and not any("1996-02-01" in n for n in notes) and any("key_code" in n and n.startswith("where") for n in other)
    ranked = families.ranking(spark, "pop5", "1996-01-01", "2000-06-01").plan_notes()
    assert "where: v_from > CAST(0 AS BIGINT)" in ranked and "where: v_to > CAST(0 AS BIGINT)" in ranked
    assert any(n.startswith("order: rate DESC") for n in ranked) and "by: key_code" in ranked
    swing = families.seasonality(spark, "pop5").plan_notes()
    assert "limit: 20" in swing and "view: v_nl_seasonality_strength" in swing and any("win_n = " in n for n in swing) and any("RANGE BETWEEN" in n for n in swing)
    by_age = families.seasonality(spark, "pop5", "age", "00000001").plan_notes()
    assert any("trend >= " in n for n in by_age) and any("unknown" in n for n in by_age) and not any("trend >= " in n for n in swing)
    assert families.pyramid(spark, "pop5", "1996-01-01").plan_notes() != families.pyramid(spark, "pop5", "1996-02-01").plan_notes()


def test_texts_of_many_rows_at_once(spark):
    rows = spark.createDataFrame([(i, f"area {i}", i * 1.5) for i in range(30)], "k long, name string, pct double")

    def writer(told, wrong):
        import json

        f = json.loads(told)
        return f"{f['name']}: {f['pct']}" + (" or 777" if f["k"] % 3 == 1 and not wrong else " or 888" if f["k"] % 5 == 4 else "")

    got = {r.k: r for r in facts.insights(rows, writer).collect()}
    assert len(got) == 30
    for k, r in got.items():
        first, always = k % 3 == 1, k % 5 == 4
        assert r.ok == (not always) and (r.text is None) == always and r.tries == (2 if first or always else 1) and list(r.bad) == ([888.0] if always else [])
    assert facts.insights(rows.limit(0), writer).collect() == []


def test_a_pass_asks_for_rejected_rows_only(spark, tmp_path):
    """Each call of the writer leaves a line: all rows once, rejected ones once more."""
    folder = str(tmp_path)
    rows = spark.createDataFrame([(i, i * 1.5) for i in range(12)], "k long, pct double").coalesce(1)

    def writer(told, wrong):
        import json
        import uuid

        k = json.loads(told)["k"]
        with open(f"{folder}/{k}-{uuid.uuid4().hex}", "w") as out:
            out.write(str(wrong))
        return "5000" if k < 4 and not wrong else "1"

    facts.insights(rows, writer).collect()
    calls = [f.name.partition("-")[0] for f in tmp_path.iterdir()]
    assert sorted(calls, key=int) == sorted([str(k) for k in range(12)] + [str(k) for k in range(4)], key=int)


def test_caveats_follow_the_query(spark, small):
    from monthgrain.schema import resolve_measure

    five = resolve_measure("5y", "population")
    assert facts.stated(five, "age")[:-1] == facts.stated(five, "profile") and facts.stated(five, "profile", "2001-02-01")[0].startswith("months: 2001-02 ")
    assert "households" in facts.stated(resolve_measure("5y", "households"), "profile")[1]
    Store.of(spark, small).register()
    told = facts.insight_facts(spark, "pop5", "strength").first()
    assert told is None or not any("age classes" in c for c in told.caveats)
