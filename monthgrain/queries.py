"""Every operator as a query over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import functions as fn
from .operators import catalog, export, facts, families, season, series
from .plans import BREAK_DATE, RecordStore, Store
from .schema import resolve_measure
from .sources import literals, raw, records

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

FROM, TO, LATE = "1996-01-01", "1999-12-01", "2000-06-01"
KEYS = ["00000001", "00000002", "00000003"]

def _panel_sql(tables: dict[str, str]) -> str:
    """The panel, its views and the given catalog tables in DuckDB's SQL."""
    return f"""
nations AS (SELECT n_nationkey, lpad(CAST(r_regionkey AS VARCHAR), 6, '0') AS muni_code, lpad(CAST(n_nationkey AS VARCHAR), 8, '0') AS key_code, n_name AS area_name
            FROM nation JOIN region ON n_regionkey = r_regionkey),
cells AS (SELECT muni_code, key_code, area_name, strftime(o_orderdate, '%Y-%m-01') AS reference_date, p_size AS age,
                 CASE WHEN l_linestatus = 'F' THEN 'female' ELSE 'male' END AS sex, l_quantity AS q, CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END AS r
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nations ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey),
houses AS (SELECT muni_code, key_code, area_name, strftime(o_orderdate, '%Y-%m-01') AS reference_date FROM orders JOIN customer ON o_custkey = c_custkey JOIN nations ON c_nationkey = n_nationkey),
observations_5y AS (
  SELECT muni_code, key_code, reference_date, measure, age_class, sex, value, sha256(reference_date || ':5y') AS source_sha256 FROM (
    SELECT muni_code, key_code, reference_date, 'population' AS measure, CASE WHEN age >= 50 THEN '50+' ELSE CAST(age // 5 * 5 AS VARCHAR) || '-' || CAST(age // 5 * 5 + 4 AS VARCHAR) END AS age_class, sex, CAST(sum(q) AS BIGINT) AS value FROM cells GROUP BY ALL
    UNION ALL SELECT muni_code, key_code, reference_date, 'population', 'total', 'total', CAST(sum(q) AS BIGINT) FROM cells GROUP BY ALL
    UNION ALL SELECT muni_code, key_code, reference_date, 'foreign_population', 'total', sex, CAST(sum(r) AS BIGINT) FROM cells GROUP BY ALL
    UNION ALL SELECT muni_code, key_code, reference_date, 'foreign_population', 'total', 'total', CAST(sum(r) AS BIGINT) FROM cells GROUP BY ALL
    UNION ALL SELECT muni_code, key_code, reference_date, 'households', 'total', 'total', count(*) FROM houses GROUP BY ALL)),
observations_1y AS (
  SELECT muni_code, key_code, reference_date, CAST(age AS VARCHAR) AS age_class, sex, CAST(sum(q) AS BIGINT) AS value, sha256(reference_date || ':1y') AS source_sha256 FROM cells GROUP BY ALL
  UNION ALL SELECT muni_code, key_code, reference_date, 'total', 'total', CAST(sum(q) AS BIGINT), sha256(reference_date || ':1y') FROM cells GROUP BY ALL),
areas AS (SELECT key_code, muni_code, area_name, min(reference_date) AS first_seen, max(reference_date) AS last_seen FROM houses GROUP BY ALL),
{", ".join(f"{t} AS ({sql})" for t, sql in tables.items())},
v_population_5y AS (SELECT o.muni_code, o.key_code, a.area_name, o.reference_date, age_class, sex, value, source_sha256 FROM observations_5y o LEFT JOIN areas a USING (key_code) WHERE measure = 'population' AND age_class <> 'total' AND sex <> 'total'),
v_population_1y AS (SELECT o.muni_code, o.key_code, a.area_name, o.reference_date, age_class, sex, value, source_sha256 FROM observations_1y o LEFT JOIN areas a USING (key_code) WHERE age_class <> 'total' AND sex <> 'total'),
v_households_5y AS (SELECT o.muni_code, o.key_code, a.area_name, o.reference_date, value, source_sha256 FROM observations_5y o LEFT JOIN areas a USING (key_code) WHERE measure = 'households'),
v_foreign_population_5y AS (SELECT o.muni_code, o.key_code, a.area_name, o.reference_date, sex, value, source_sha256 FROM observations_5y o LEFT JOIN areas a USING (key_code) WHERE measure = 'foreign_population' AND sex <> 'total'),
v_published_totals_5y AS (SELECT o.muni_code, o.key_code, a.area_name, o.reference_date, measure, value FROM observations_5y o LEFT JOIN areas a USING (key_code) WHERE age_class = 'total' AND sex = 'total'),
v_nl_population AS (SELECT muni_code, key_code, area_name, reference_date, CAST(sum(value) AS BIGINT) AS population FROM v_population_5y GROUP BY ALL),
v_nl_population_by_sex AS (SELECT muni_code, key_code, area_name, reference_date, sex, CAST(sum(value) AS BIGINT) AS population FROM v_population_5y GROUP BY ALL),
v_nl_population_by_age AS (SELECT muni_code, key_code, area_name, reference_date, age_class, CAST(regexp_extract(age_class, '^[0-9]+') AS INTEGER) AS age_order, CAST(sum(value) AS BIGINT) AS population FROM v_population_5y GROUP BY ALL),
v_nl_foreign_population AS (SELECT muni_code, key_code, area_name, reference_date, CAST(sum(value) AS BIGINT) AS foreign_population FROM v_foreign_population_5y GROUP BY ALL),
v_nl_households AS (SELECT muni_code, key_code, area_name, reference_date, CAST(sum(value) AS BIGINT) AS households FROM v_households_5y GROUP BY ALL),
v_nl_areas AS (SELECT a.key_code, a.muni_code, area_name, first_seen, last_seen, alias_name FROM areas a LEFT JOIN area_aliases USING (key_code)),
v_nl_gaps AS (SELECT g.dataset_key, muni_name, grain_label, reference_date, kind, reason FROM dataset_gaps g LEFT JOIN datasets d USING (dataset_key))
"""


#: With literal catalog tables, and with those drawn from the test tables.
_PANEL, _RECORDED = _panel_sql({t: literals.values_sql(t) for t in literals.ROWS}), _panel_sql(records.SQL)


def _season_sql(name: str, source: str, value: str, keys: str = "key_code, area_name", gate: str = "trend > 0", where: str = "TRUE") -> str:
    """CTEs name_ratio and name (the index) for one view."""
    return f"""
{name}_panel AS (SELECT {keys}, reference_date, CAST(substr(reference_date, 1, 4) AS INTEGER) * 12 + CAST(substr(reference_date, 6, 2) AS INTEGER) AS month_index, substr(reference_date, 6, 2) AS month, {value} AS value
                 FROM {source} WHERE reference_date >= '{BREAK_DATE}' AND {where}),
{name}_windows AS (SELECT *, (avg(value) OVER (PARTITION BY {keys} ORDER BY month_index RANGE BETWEEN 6 PRECEDING AND 5 FOLLOWING) + avg(value) OVER (PARTITION BY {keys} ORDER BY month_index RANGE BETWEEN 5 PRECEDING AND 6 FOLLOWING)) / 2.0 AS trend,
                   count(*) OVER (PARTITION BY {keys} ORDER BY month_index RANGE BETWEEN 6 PRECEDING AND 6 FOLLOWING) AS win_n FROM {name}_panel),
{name}_ratio AS (SELECT *, value / trend AS ratio FROM {name}_windows WHERE win_n = 13 AND {gate}),
{name}_raw AS (SELECT {keys}, month, avg(ratio) AS raw_index, count(*) AS n_years, count(*) FILTER (ratio > 1.0) AS n_above FROM {name}_ratio GROUP BY ALL),
{name} AS (SELECT {keys}, month, round(raw_index / avg(raw_index) OVER (PARTITION BY {keys}), 5) AS seasonal_index, round((raw_index / avg(raw_index) OVER (PARTITION BY {keys}) - 1) * 100, 2) AS pct_vs_trend, n_above, n_years FROM {name}_raw)"""


def _strength_sql(name: str, source: str) -> str:
    return f"""
{name} AS (SELECT key_code, area_name, round(max(p) - min(p), 2) AS amplitude_pct, max(CASE WHEN hi = 1 THEN month END) AS peak_month, max(p) AS peak_pct, max(CASE WHEN lo = 1 THEN month END) AS trough_month, min(p) AS trough_pct
  FROM (SELECT *, pct_vs_trend AS p, row_number() OVER (PARTITION BY key_code ORDER BY pct_vs_trend DESC, month) AS hi, row_number() OVER (PARTITION BY key_code ORDER BY pct_vs_trend, month) AS lo FROM {source}) GROUP BY ALL)"""


_SEASON = ",".join([
    _season_sql("v_nl_seasonality", "v_nl_population", "population"),
    _season_sql("v_nl_seasonality_hh", "v_households_5y", "value"),
    _season_sql("v_nl_seasonality_age", "v_nl_population_by_age", "population", "key_code, area_name, age_class, age_order", "trend >= 20", "age_class <> 'unknown'"),
    _strength_sql("v_nl_seasonality_strength", "v_nl_seasonality"), _strength_sql("v_nl_seasonality_hh_strength", "v_nl_seasonality_hh"),
])


def query(sql: str | None = None, needs: str = _PANEL):
    """Registers a function of a Store as a query, with its SQL over the CTEs in needs."""
    def register(f: Callable[[Store], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Store.of(spark, sf_dir))
        if sql is not None:
            ORACLES[f.__name__] = f"WITH {needs} {sql}"
        return f

    return register


def recorded(sql: str, needs: str = _RECORDED):
    """Registers a function of a RecordStore."""

    def register(f: Callable[[Store], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(RecordStore.of(spark, sf_dir))
        ORACLES[f.__name__] = f"WITH {needs} {sql}"
        return f

    return register


def seasonal(sql: str):
    return query(sql, f"{_PANEL},{_SEASON}")


def _registered(s: Store) -> SparkSession:
    s.register()
    return s.spark


# --- views -----------------------------------------------------------------------------------------

for _name in ("v_population_5y", "v_population_1y", "v_households_5y", "v_foreign_population_5y", "v_published_totals_5y", "v_nl_population", "v_nl_population_by_sex", "v_nl_population_by_age", "v_nl_foreign_population", "v_nl_households", "v_nl_areas", "v_nl_gaps"):
    QUERIES[_name.replace("v_", "view_", 1)] = lambda spark, sf_dir, n=_name: Store.of(spark, sf_dir).views[n]
    ORACLES[_name.replace("v_", "view_", 1)] = f"WITH {_PANEL} SELECT * FROM {_name}"
QUERIES["view_nl_gaps"] = lambda spark, sf_dir: RecordStore.of(spark, sf_dir).views["v_nl_gaps"]
ORACLES["view_nl_gaps"] = f"WITH {_RECORDED} SELECT * FROM v_nl_gaps"
for _name in ("v_nl_seasonality", "v_nl_seasonality_strength", "v_nl_seasonality_age", "v_nl_seasonality_hh", "v_nl_seasonality_hh_strength"):
    QUERIES[_name.replace("v_", "view_", 1)] = lambda spark, sf_dir, n=_name: Store.of(spark, sf_dir).seasonal_views[n]
    ORACLES[_name.replace("v_", "view_", 1)] = f"WITH {_PANEL},{_SEASON} SELECT * FROM {_name}"


@query("SELECT muni_code, key_code, reference_date, measure, age_class, sex, value, source_sha256 FROM observations_5y")
def scan_observations_5y(s: Store) -> DataFrame:
    return s.observations_5y


@query("SELECT * FROM observations_1y")
def scan_observations_1y(s: Store) -> DataFrame:
    return s.observations_1y


@query("SELECT * FROM areas")
def scan_areas(s: Store) -> DataFrame:
    return s.areas


@query("""SELECT l.key_code, l.reference_date, l.leaf_sum, t.value AS published, l.leaf_sum - t.value AS difference
          FROM (SELECT key_code, reference_date, CAST(sum(value) AS BIGINT) AS leaf_sum FROM v_population_5y GROUP BY ALL) l
          JOIN (SELECT * FROM v_published_totals_5y WHERE measure = 'population') t USING (key_code, reference_date)""")
def reconcile_totals(s: Store) -> DataFrame:
    """Leaf sums against published totals: the difference is 0 everywhere."""
    leaves = s.views["v_population_5y"].groupBy("key_code", "reference_date").agg(F.sum("value").alias("leaf_sum"))
    totals = s.views["v_published_totals_5y"].filter("measure = 'population'").select("key_code", "reference_date", F.col("value").alias("published"))
    return leaves.join(totals, ["key_code", "reference_date"]).withColumn("difference", F.col("leaf_sum") - F.col("published"))


# --- query families --------------------------------------------------------------------------------


@query("SELECT reference_date, count(*) AS obs_rows FROM v_population_5y WHERE muni_code = '000001' GROUP BY ALL")
def meta_months(s: Store) -> DataFrame:
    return families.meta(_registered(s), "pop5")["months"]


@query("SELECT DISTINCT key_code, area_name FROM v_population_5y WHERE muni_code = '000001' AND reference_date = (SELECT max(reference_date) FROM v_population_5y WHERE muni_code = '000001')")
def meta_areas_latest(s: Store) -> DataFrame:
    return families.meta(_registered(s), "pop5")["areas"]


@recorded("SELECT reference_date, kind, reason FROM dataset_gaps WHERE dataset_key = 'r1_5y'")
def meta_gaps(s: Store) -> DataFrame:
    return families.meta(_registered(s), "r1_5y")["gaps"]


@query(f"SELECT reference_date, CAST(sum(value) AS BIGINT) AS value, count(DISTINCT key_code) AS areas FROM v_population_5y WHERE muni_code = '000001' AND reference_date BETWEEN '{FROM}' AND '{TO}' GROUP BY ALL")
def trend_sum(s: Store) -> DataFrame:
    return families.trend(_registered(s), "pop5", FROM, TO).df


@query(f"SELECT reference_date, key_code, max(area_name) AS area_name, CAST(sum(value) AS BIGINT) AS value FROM v_population_5y WHERE muni_code = '000001' AND reference_date BETWEEN '{FROM}' AND '{TO}' GROUP BY reference_date, key_code")
def trend_split(s: Store) -> DataFrame:
    return families.trend(_registered(s), "pop5", FROM, TO, split=True).df


@query(f"SELECT reference_date, CAST(sum(value) AS BIGINT) AS value, count(DISTINCT key_code) AS areas FROM v_population_5y WHERE muni_code = '000001' AND key_code IN ('00000001', '00000002', '00000003') AND reference_date BETWEEN '{FROM}' AND '{TO}' GROUP BY ALL")
def trend_keys(s: Store) -> DataFrame:
    return families.trend(_registered(s), "pop5", FROM, TO, KEYS).df


@query(f"SELECT reference_date, CAST(sum(value) AS BIGINT) AS value, count(DISTINCT key_code) AS areas FROM v_households_5y WHERE muni_code = '000001' AND reference_date BETWEEN '{FROM}' AND '{TO}' GROUP BY ALL")
def trend_households(s: Store) -> DataFrame:
    return families.trend(_registered(s), "pop5", FROM, TO, measure="households").df


@query(f"SELECT reference_date, CAST(sum(value) AS BIGINT) AS value, count(DISTINCT key_code) AS areas FROM v_foreign_population_5y WHERE muni_code = '000001' AND reference_date BETWEEN '{FROM}' AND '{TO}' GROUP BY ALL")
def trend_foreign(s: Store) -> DataFrame:
    return families.trend(_registered(s), "pop5", FROM, TO, measure="foreign_population").df


@query(f"SELECT reference_date, CAST(sum(value) AS BIGINT) AS value, count(DISTINCT key_code) AS areas FROM v_population_1y WHERE muni_code = '000001' AND reference_date BETWEEN '{FROM}' AND '{TO}' GROUP BY ALL")
def trend_single_years(s: Store) -> DataFrame:
    return families.trend(_registered(s), "pop1", FROM, TO).df


@recorded(f"SELECT reference_date, kind, reason FROM dataset_gaps WHERE dataset_key = 'r1_5y' AND reference_date BETWEEN '1996-03-01' AND '{TO}'")
def trend_annotations(s: Store) -> DataFrame:
    """Gaps of a trend's period, its first month included."""
    return families.trend(_registered(s), "r1_5y", "1996-03-01", TO).annotations


@query(f"SELECT age_class, sex, CAST(sum(value) AS BIGINT) AS value FROM v_population_5y WHERE muni_code = '000001' AND reference_date = '{FROM}' GROUP BY ALL")
def pyramid(s: Store) -> DataFrame:
    return families.pyramid(_registered(s), "pop5", FROM).df


@query(f"SELECT age_class, sex, CAST(sum(value) AS BIGINT) AS value FROM v_population_5y WHERE muni_code = '000001' AND key_code = '00000001' AND reference_date = '{FROM}' GROUP BY ALL")
def pyramid_area(s: Store) -> DataFrame:
    return families.pyramid(_registered(s), "pop5", FROM, "00000001").df


@query(f"SELECT age_class, CAST(sum(value) FILTER (sex = 'male') AS BIGINT) AS male, CAST(sum(value) FILTER (sex = 'female') AS BIGINT) AS female FROM v_population_5y WHERE muni_code = '000001' AND reference_date = '{FROM}' GROUP BY ALL")
def pyramid_pivot(s: Store) -> DataFrame:
    rows = families.age_by_sex(families.pyramid(_registered(s), "pop5", FROM).df)
    return rows.orderBy(fn.display_age_order(F.col("age_class")))


@query(f"SELECT CAST(sum(value) FILTER (sex = 'male') AS BIGINT) AS male, CAST(sum(value) FILTER (sex = 'female') AS BIGINT) AS female, CAST(sum(value) AS BIGINT) AS total, max(value) AS widest FROM (SELECT age_class, sex, CAST(sum(value) AS BIGINT) AS value FROM v_population_5y WHERE muni_code = '000001' AND reference_date = '{FROM}' GROUP BY ALL)")
def pyramid_totals(s: Store) -> DataFrame:
    rows = families.age_by_sex(families.pyramid(_registered(s), "pop5", FROM).df)
    return rows.agg(F.sum("male").alias("male"), F.sum("female").alias("female"), (F.sum("male") + F.sum("female")).alias("total"), F.max(F.greatest("male", "female")).alias("widest"))


_RANKED = f"""SELECT a.key_code, a.area_name, a.value AS v_from, b.value AS v_to, b.value - a.value AS diff, (b.value - a.value) / CAST(a.value AS DOUBLE) * 100 AS rate
  FROM (SELECT key_code, area_name, CAST(sum(value) AS BIGINT) AS value FROM {{0}} WHERE muni_code = '000001' AND reference_date = '{FROM}' GROUP BY ALL) a
  JOIN (SELECT key_code, CAST(sum(value) AS BIGINT) AS value FROM {{0}} WHERE muni_code = '000001' AND reference_date = '{LATE}' GROUP BY ALL) b USING (key_code) WHERE a.value > 0 AND b.value > 0"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("rate", F.round("rate", 6))


@query(f"SELECT * REPLACE (round(rate, 6) AS rate) FROM ({_RANKED.format('v_population_5y')})")
def ranking(s: Store) -> DataFrame:
    return _rounded(families.ranking(_registered(s), "pop5", FROM, LATE).df)


@query(f"SELECT * REPLACE (round(rate, 6) AS rate) FROM ({_RANKED.format('v_households_5y')})")
def ranking_households(s: Store) -> DataFrame:
    return _rounded(families.ranking(_registered(s), "pop5", FROM, LATE, "households").df)


@query(f"""SELECT * REPLACE (round(rate, 6) AS rate), 'top' AS part FROM (SELECT * FROM ({_RANKED.format('v_population_5y')}) ORDER BY rate DESC, key_code LIMIT 3)
  UNION ALL SELECT * REPLACE (round(rate, 6) AS rate), 'bottom' FROM (SELECT * FROM ({_RANKED.format('v_population_5y')}) ORDER BY rate, key_code DESC LIMIT 3)""")
def ranking_top_bottom(s: Store) -> DataFrame:
    return _rounded(families.top_and_bottom(families.ranking(_registered(s), "pop5", FROM, LATE).df, 3))


@query(f"SELECT count(*) AS n_areas, count(*) FILTER (diff > 0) AS n_up, count(*) FILTER (diff <= 0) AS n_down FROM ({_RANKED.format('v_population_5y')})")
def ranking_summary(s: Store) -> DataFrame:
    return series.ranking_summary(families.ranking(_registered(s), "pop5", FROM, LATE).df)


@recorded(f"SELECT reference_date, kind, reason FROM dataset_gaps WHERE dataset_key = 'r1_5y' AND reference_date > '1996-03-01' AND reference_date <= '{LATE}'")
def ranking_annotations(s: Store) -> DataFrame:
    """Gaps of a ranking's period, its first month not included."""
    return families.ranking(_registered(s), "r1_5y", "1996-03-01", LATE).annotations


@recorded(f"SELECT max(reference_date) AS safe_from FROM dataset_gaps WHERE dataset_key = 'r1_5y' AND kind = 'series_break' AND reference_date > '{FROM}' AND reference_date <= '{LATE}'")
def safe_from(s: Store) -> DataFrame:
    return families.safe_from(families.gaps_between(s.literal("dataset_gaps"), "r1_5y", FROM, LATE, after_start=True))


# --- seasonality -----------------------------------------------------------------------------------


@query(f"SELECT key_code, area_name, reference_date, CAST(substr(reference_date, 1, 4) AS INTEGER) * 12 + CAST(substr(reference_date, 6, 2) AS INTEGER) AS month_index, substr(reference_date, 6, 2) AS month, population AS value FROM v_nl_population WHERE reference_date >= '{BREAK_DATE}'")
def season_month_panel(s: Store) -> DataFrame:
    return season.month_panel(s.views["v_nl_population"], "population", BREAK_DATE)


@seasonal("SELECT key_code, month_index, month, value, round(trend, 4) AS trend, win_n, round(ratio, 6) AS ratio FROM v_nl_seasonality_ratio")
def season_ratio(s: Store) -> DataFrame:
    rows = season.ratios(season.month_panel(s.views["v_nl_population"], "population", BREAK_DATE), season.AREA)
    return rows.select("key_code", "month_index", "month", "value", F.round("trend", 4).alias("trend"), "win_n", F.round("ratio", 6).alias("ratio"))


_REGION = _season_sql("regional", "(SELECT lpad(CAST(CAST(muni_code AS BIGINT) AS VARCHAR), 8, '0') AS key_code, r_name AS area_name, reference_date, sum(value) AS population FROM v_population_5y JOIN region ON CAST(muni_code AS BIGINT) = r_regionkey GROUP BY ALL)", "population")


@query("SELECT * FROM regional", f"{_PANEL},{_REGION}")
def season_index_region(s: Store) -> DataFrame:
    """The flagship: the index at region grain."""
    return Store.of(s.spark, s.sf_dir, "region").seasonal_views["v_nl_seasonality"]


@query("SELECT * FROM strict", f"{_PANEL},{_season_sql('strict', 'v_nl_population_by_age', 'population', 'key_code, area_name, age_class, age_order', 'trend >= 100', 'TRUE')}")
def season_index_age_high_gate(s: Store) -> DataFrame:
    return season.age_index(s.views, BREAK_DATE, min_trend=100)


@seasonal("SELECT s.* FROM v_nl_seasonality_strength s JOIN areas a USING (key_code) WHERE a.muni_code = '000001' ORDER BY amplitude_pct DESC, key_code LIMIT 20")
def season_strength(s: Store) -> DataFrame:
    return families.seasonality(_registered(s), "pop5").df


@seasonal("SELECT s.* FROM v_nl_seasonality_hh_strength s JOIN areas a USING (key_code) WHERE a.muni_code = '000001' ORDER BY amplitude_pct DESC, key_code LIMIT 20")
def season_strength_households(s: Store) -> DataFrame:
    return families.seasonality(_registered(s), "pop5", measure="households").df


@seasonal("SELECT month, seasonal_index, pct_vs_trend, n_above, n_years FROM v_nl_seasonality WHERE key_code = '00000001'")
def season_profile(s: Store) -> DataFrame:
    return families.seasonality(_registered(s), "pop5", "profile", "00000001").df


@seasonal("SELECT age_class, age_order, pct_vs_trend, n_above, n_years FROM v_nl_seasonality_age WHERE key_code = '00000001' AND month = '09'")
def season_month_by_age(s: Store) -> DataFrame:
    return families.seasonality(_registered(s), "pop5", "age", "00000001").df


@recorded(f"SELECT reference_date, kind, reason FROM dataset_gaps WHERE dataset_key = 'r1_5y' AND kind <> 'series_break' AND reference_date >= '{BREAK_DATE}'")
def season_annotations(s: Store) -> DataFrame:
    return families.seasonality(_registered(s), "r1_5y").annotations


@recorded("SELECT title, detail, severity FROM known_issues WHERE dataset_key = 'r1_5y' AND resolved_at IS NULL")
def season_issues(s: Store) -> DataFrame:
    return families.seasonality(_registered(s), "r1_5y").extra["issues"]


@seasonal("SELECT p.key_code, p.area_name, p.amplitude_pct AS population_pct, h.amplitude_pct AS household_pct FROM v_nl_seasonality_strength p JOIN v_nl_seasonality_hh_strength h USING (key_code)")
def season_population_against_households(s: Store) -> DataFrame:
    p, h = (s.seasonal_views[v] for v in ("v_nl_seasonality_strength", "v_nl_seasonality_hh_strength"))
    return p.select("key_code", "area_name", F.col("amplitude_pct").alias("population_pct")).join(h.select("key_code", F.col("amplitude_pct").alias("household_pct")), "key_code")


@seasonal("SELECT a.key_code, a.age_class, a.pct_vs_trend AS march_pct, b.pct_vs_trend AS april_pct FROM v_nl_seasonality_age a JOIN v_nl_seasonality_age b USING (key_code, age_class) WHERE a.month = '03' AND b.month = '04'")
def season_months_side_by_side(s: Store) -> DataFrame:
    """One aggregation instead of a self-join."""
    at = lambda m: F.max(F.when(F.col("month") == m, F.col("pct_vs_trend")))
    rows = s.seasonal_views["v_nl_seasonality_age"].filter(F.col("month").isin("03", "04")).groupBy("key_code", "age_class")
    return rows.agg(at("03").alias("march_pct"), at("04").alias("april_pct")).filter("march_pct IS NOT NULL AND april_pct IS NOT NULL")


_SERIES = "series AS (SELECT c_nationkey || '-' || left(o_orderpriority, 1) AS key_code, c_nationkey || '-' || left(o_orderpriority, 1) AS area_name, strftime(o_orderdate, '%Y-%m-01') AS reference_date, count(*) AS value FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"


@query("SELECT * FROM gapped_strength", f"{_SERIES},{_season_sql('gapped', 'series', 'value').replace(BREAK_DATE, '1900-01-01')},{_strength_sql('gapped_strength', 'gapped')}")
def season_gap_and_ties(s: Store) -> DataFrame:
    """Orders by nation and priority: small counts with missing months and equal greatest months, of which the earliest is meant."""
    orders = s.panel.read("orders").join(s.panel.read("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    key = F.concat(F.col("c_nationkey").cast("string"), F.lit("-"), F.left("o_orderpriority", F.lit(1)))
    rows = orders.groupBy(key.alias("key_code"), key.alias("area_name"), F.date_format("o_orderdate", "yyyy-MM-01").alias("reference_date")).agg(F.count("*").alias("value"))
    return season.strength(season.seasonal_index(season.month_panel(rows, "value", "1900-01-01")))


# --- catalog ---------------------------------------------------------------------------------------

def _catalog_sql(panel: str) -> str:
    return f"""{panel},
mapped AS (SELECT f.*, s.dataset_key FROM source_files f JOIN dataset_sources s ON s.dataset = f.dataset AND s.granularity = f.granularity),
counted AS (SELECT dataset_key, reference_date, count(*) AS file_count FROM mapped WHERE status = 'ingested' AND reference_date IS NOT NULL GROUP BY ALL),
observed AS (SELECT dataset_key, reference_date, count(*) AS obs_rows FROM observations_5y o JOIN datasets d ON d.muni_code = o.muni_code AND d.granularity = '5y' GROUP BY ALL
             UNION ALL SELECT dataset_key, reference_date, count(*) FROM observations_1y o JOIN datasets d ON d.muni_code = o.muni_code AND d.granularity = '1y' GROUP BY ALL),
periods AS (SELECT dataset_key, reference_date, coalesce(file_count, 0) AS file_count, coalesce(obs_rows, 0) AS obs_rows FROM counted FULL JOIN observed USING (dataset_key, reference_date)),
own AS (SELECT p.*, substr(reference_date, 1, 7) AS ym FROM periods p JOIN datasets d USING (dataset_key) WHERE is_public = 1),
span AS (SELECT dataset_key, min(ym) AS a, max(ym) AS b FROM own WHERE obs_rows > 0 GROUP BY ALL),
calendar AS (SELECT dataset_key, strftime(unnest(generate_series(CAST(a || '-01' AS DATE), CAST(b || '-01' AS DATE), INTERVAL 1 MONTH)), '%Y-%m') AS ym FROM span),
unlabelled AS (SELECT dataset_key, ym, coalesce(obs_rows, 0) AS obs_rows, coalesce(file_count, 0) AS files FROM calendar LEFT JOIN own USING (dataset_key, ym)
               UNION ALL SELECT dataset_key, ym, obs_rows, file_count FROM own WHERE obs_rows = 0 AND file_count > 0 AND (dataset_key, ym) NOT IN (SELECT (dataset_key, ym) FROM calendar)),
covered AS (SELECT u.dataset_key, u.ym, u.obs_rows, u.files, CASE WHEN obs_rows > 0 THEN 'ok' WHEN files > 0 THEN 'not_loaded' ELSE 'missing' END AS state, g.kind AS gap_kind, g.reason AS gap_reason
            FROM unlabelled u LEFT JOIN dataset_gaps g ON g.dataset_key = u.dataset_key AND substr(g.reference_date, 1, 7) = u.ym),
summary AS (SELECT dataset_key, min(ym) FILTER (state = 'ok') AS period_from, max(ym) FILTER (state = 'ok') AS period_to, count(*) AS months_expected, count(*) FILTER (state = 'ok') AS months_present, count(*) FILTER (state <> 'ok') AS anomalies FROM covered GROUP BY ALL),
file_health AS (SELECT dataset_key, max(ingested_at) AS last_ingested_at, count(*) AS files_total, count(*) FILTER (status = 'skipped') AS files_skipped FROM mapped GROUP BY ALL),
run_health AS (SELECT dataset_key, max(started_at) AS last_run_at, max(started_at) FILTER (status IN ('ok', 'no_change')) AS last_ok_at FROM sync_runs GROUP BY ALL),
entries AS (SELECT d.dataset_key, d.muni_code, d.muni_name, d.domain, d.title, d.granularity, d.grain_label, d.source_site, d.source_url, d.license, d.attribution, d.notes, period_from, period_to, coalesce(months_expected, 0) AS months_expected, coalesce(months_present, 0) AS months_present, coalesce(anomalies, 0) AS anomalies,
                   CAST(coalesce(o.n, 0) AS BIGINT) AS obs_rows, coalesce(files_total, 0) AS files_total, coalesce(files_skipped, 0) AS files_skipped, last_ingested_at, last_run_at, last_ok_at
            FROM datasets d LEFT JOIN summary USING (dataset_key) LEFT JOIN (SELECT dataset_key, sum(obs_rows) AS n FROM periods GROUP BY ALL) o USING (dataset_key) LEFT JOIN file_health USING (dataset_key) LEFT JOIN run_health USING (dataset_key) WHERE is_public = 1)
"""


_CATALOG, _RECORDED_CATALOG = _catalog_sql(_PANEL), _catalog_sql(_RECORDED)


def _periods(s: Store) -> DataFrame:
    return catalog.refresh_periods(s.literal("source_files"), s.literal("dataset_sources"), s.literal("datasets"), s.observations_5y, s.observations_1y)


def _covered(s: Store) -> DataFrame:
    return catalog.coverage(s.periods, s.literal("dataset_gaps"), s.literal("datasets"))


def _entries(s: Store) -> DataFrame:
    return catalog.catalog(s.literal("datasets"), s.periods, s.literal("dataset_gaps"), s.literal("source_files"), s.literal("dataset_sources"), s.literal("sync_runs"))


@query("SELECT * FROM periods", _CATALOG)
def catalog_periods(s: Store) -> DataFrame:
    return _periods(s)


@query("SELECT * FROM periods", _CATALOG)
def catalog_periods_rebuilt(s: Store) -> DataFrame:
    """The table of periods, written anew over an older one and read again."""
    s.rebuilt_periods()
    return s.rebuilt_periods()


@recorded("SELECT dataset_key, reference_date, coalesce(n.file_count, o.file_count, 0) AS file_count, coalesce(o.obs_rows, 0) AS obs_rows FROM dataset_periods o FULL JOIN counted n USING (dataset_key, reference_date)", _RECORDED_CATALOG)
def catalog_upsert(s: Store) -> DataFrame:
    """New file counts merged into known periods; their row counts stay."""
    files = catalog.mapped_files(s.literal("source_files"), s.literal("dataset_sources")).filter("status = 'ingested'")
    counts = files.groupBy("dataset_key", "reference_date").agg(F.count("*").alias("file_count"))
    return catalog.merge_upsert(s.literal("dataset_periods"), counts, ["dataset_key", "reference_date"], {"file_count": 0, "obs_rows": 0})


@recorded(f"""SELECT dataset_key, reference_date, kind, reason, noted_at FROM dataset_gaps WHERE kind <> 'upstream_missing'
  UNION ALL SELECT dataset_key, reference_date, 'pending_fix', 'found since', '2021-01-01' FROM dataset_gaps WHERE kind = 'upstream_missing'
  UNION ALL SELECT dataset_key, reference_date, 'pending_fix', 'found since', '2021-01-01' FROM dataset_periods p WHERE obs_rows = 0 AND NOT EXISTS (SELECT 1 FROM dataset_gaps g WHERE g.dataset_key = p.dataset_key AND g.reference_date = p.reference_date)""")
def catalog_insert_or_replace(s: Store) -> DataFrame:
    """Gaps of one kind and months without rows, noted anew: those that are known are replaced, the others put in."""
    gaps, keys = s.literal("dataset_gaps"), ["dataset_key", "reference_date"]
    found = gaps.filter("kind = 'upstream_missing'").select(*keys).unionByName(s.literal("dataset_periods").filter("obs_rows = 0").select(*keys).join(gaps.filter("kind <> 'upstream_missing'"), keys, "left_anti")).distinct()
    return catalog.insert_or_replace(gaps, found.select(*keys, F.lit("pending_fix").alias("kind"), F.lit("found since").alias("reason"), F.lit("2021-01-01").alias("noted_at")), keys)


@recorded("SELECT d.dataset_key, last_ingested_at, files_total, files_skipped, last_run_at, last_ok_at FROM datasets d LEFT JOIN file_health USING (dataset_key) LEFT JOIN run_health USING (dataset_key)", _RECORDED_CATALOG)
def catalog_health(s: Store) -> DataFrame:
    joined = s.literal("datasets").select("dataset_key").join(catalog.file_health(s.literal("source_files"), s.literal("dataset_sources")), "dataset_key", "left")
    return joined.join(catalog.run_health(s.literal("sync_runs")), "dataset_key", "left")


@query("SELECT * FROM entries", _CATALOG)
def catalog_entries(s: Store) -> DataFrame:
    return _entries(s)


@query("SELECT (SELECT count(*) FROM entries WHERE license IS NULL) AS no_license, (SELECT count(*) FROM entries WHERE attribution IS NULL) AS no_attribution, (SELECT count(*) FROM entries WHERE last_run_at IS NULL) AS no_runs, (SELECT count(*) FROM known_issues WHERE resolved_at IS NULL) AS open_issues", _CATALOG)
def catalog_warnings(s: Store) -> DataFrame:
    return catalog.catalog_warnings(_entries(s), s.literal("known_issues"))


@query("SELECT * FROM covered", _CATALOG)
def coverage_calendar(s: Store) -> DataFrame:
    return _covered(s)


@query("SELECT * FROM covered WHERE state <> 'ok'", _CATALOG)
def coverage_anomalies(s: Store) -> DataFrame:
    return _covered(s).filter("state <> 'ok'")


@query("SELECT summary.*, CAST(o.n AS BIGINT) AS obs_rows FROM summary LEFT JOIN (SELECT dataset_key, sum(obs_rows) AS n FROM periods GROUP BY ALL) o USING (dataset_key)", _CATALOG)
def coverage_summary(s: Store) -> DataFrame:
    return catalog.coverage_summary(s.periods, s.literal("datasets"))


@query("SELECT dataset_key, substr(ym, 1, 4) AS year, " + ", ".join(f"max(state) FILTER (substr(ym, 6, 2) = '{m:02d}') AS m{m:02d}" for m in range(1, 13)) + " FROM covered GROUP BY ALL", _CATALOG)
def coverage_grid(s: Store) -> DataFrame:
    return catalog.coverage_grid(_covered(s))


@query("SELECT dataset_key, greatest(period_from, strftime(CAST(period_to || '-01' AS DATE) - INTERVAL 11 MONTH, '%Y-%m')) AS export_from, period_to AS export_to FROM summary WHERE period_to IS NOT NULL", _CATALOG)
def export_default_window(s: Store) -> DataFrame:
    return catalog.default_export_window(catalog.coverage_summary(s.periods, s.literal("datasets")))


@recorded("SELECT sha256, dataset, reference_date, CAST(row_number() OVER (PARTITION BY dataset, granularity, reference_date ORDER BY source_last_modified DESC NULLS LAST, ingested_at DESC NULLS LAST, sha256) = 1 AS INTEGER) AS is_current FROM source_files")
def file_current_version(s: Store) -> DataFrame:
    return catalog.mark_current(s.literal("source_files")).select("sha256", "dataset", "reference_date", "is_current")


@recorded("""SELECT dataset_key, substr(reference_date, 1, 7) AS ym, sha256, status, d AS distributable, c AS is_current, CAST(row_number() OVER (PARTITION BY dataset_key, reference_date ORDER BY d DESC, c DESC, ingested_at, sha256) = 1 AND d = 1 AS INTEGER) AS offered
          FROM (SELECT m.*, CAST(coalesce(distributable, 1) AS INTEGER) AS d, CAST(coalesce(is_current, 1) AS INTEGER) AS c FROM mapped m JOIN datasets USING (dataset_key) WHERE is_public = 1)""", _RECORDED_CATALOG)
def file_history(s: Store) -> DataFrame:
    return catalog.file_history(s.literal("source_files"), s.literal("dataset_sources"), s.literal("datasets"))


#: A file that is there at all sizes.
_SHA = hashlib.sha256(b"file:1:1996-01-01:1-URGENT").hexdigest()


@recorded(f"SELECT sha256, m.dataset_key, r2_key, source_file, license, attribution, CAST(coalesce(distributable, 1) AS INTEGER) AS distributable, hold_reason FROM mapped m JOIN datasets d USING (dataset_key) WHERE is_public = 1 AND sha256 = '{_SHA}'", _RECORDED_CATALOG)
def raw_file_entry(s: Store) -> DataFrame:
    return raw.raw_file_entry(s.literal("source_files"), s.literal("dataset_sources"), s.literal("datasets"), _SHA)


@recorded("SELECT issue_id, dataset_key, title, severity, CAST(CASE severity WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END AS INTEGER) AS severity_rank FROM known_issues WHERE resolved_at IS NULL")
def issues_by_severity(s: Store) -> DataFrame:
    return catalog.open_issues_by_severity(s.literal("known_issues"))


_NOTE = "the name says another month"


@recorded(f"SELECT sha256, status, CASE WHEN row_count % 10 = 1 THEN coalesce(skip_reason || ' / ', '') || '{_NOTE}' ELSE skip_reason END AS skip_reason, CAST(CASE WHEN row_count % 10 = 1 THEN 0 ELSE is_current END AS BIGINT) AS is_current FROM source_files")
def files_with_note(s: Store) -> DataFrame:
    """Files marked as not current, with a note behind the reasons they have."""
    changes = {"skip_reason": catalog.with_note(F.col("skip_reason"), _NOTE), "is_current": F.lit(0)}
    return catalog.update_where(s.literal("source_files"), F.col("row_count") % 10 == 1, changes).select("sha256", "status", "skip_reason", F.col("is_current").cast("long").alias("is_current"))


@recorded("SELECT issue_id, title, CASE WHEN title LIKE '%a%e%s' THEN 'resolved' ELSE severity END AS severity, CASE WHEN title LIKE '%a%e%s' THEN detail || ' [checked]' ELSE detail END AS detail FROM known_issues")
def issues_resolved_by_pattern(s: Store) -> DataFrame:
    changes = {"severity": F.lit("resolved"), "detail": F.concat("detail", F.lit(" [checked]"))}
    return catalog.update_where(s.literal("known_issues"), F.col("title").like("%a%e%s"), changes).select("issue_id", "title", "severity", "detail")


@recorded("SELECT run_id, status, CAST(1 AS BIGINT) AS attempts FROM sync_runs")
def runs_with_new_column(s: Store) -> DataFrame:
    return catalog.add_column(s.literal("sync_runs"), "attempts", "long", 1).select("run_id", "status", "attempts")


@query("SELECT dataset_key, (CAST(substr(period_to, 1, 4) AS INTEGER) - CAST(substr(period_from, 1, 4) AS INTEGER)) * 12 + CAST(substr(period_to, 6, 2) AS INTEGER) - CAST(substr(period_from, 6, 2) AS INTEGER) + 1 AS months FROM summary", _CATALOG)
def coverage_length(s: Store) -> DataFrame:
    summary = catalog.coverage_summary(s.periods, s.literal("datasets"))
    return summary.select("dataset_key", catalog.month_distance(F.col("period_from"), F.col("period_to")).alias("months"))


_NESTED = f"""{_CATALOG}, history AS (
  SELECT dataset_key, substr(reference_date, 1, 7) AS ym, sha256, status, CAST(row_number() OVER (PARTITION BY dataset_key, reference_date ORDER BY d DESC, c DESC, ingested_at, sha256) = 1 AND d = 1 AS INTEGER) AS offered
  FROM (SELECT m.*, coalesce(distributable, 1) AS d, coalesce(is_current, 1) AS c FROM mapped m JOIN datasets USING (dataset_key) WHERE is_public = 1)),
month_files AS (SELECT dataset_key, ym, string_agg(substr(sha256, 64) || '=' || status || offered, '+' ORDER BY sha256) AS file_list FROM history GROUP BY ALL),
listed AS (SELECT dataset_key, ym, state, ym || ':' || state || ':' || obs_rows || ':' || coalesce(gap_kind, '') || ':' || coalesce(file_list, '') AS line FROM covered LEFT JOIN month_files USING (dataset_key, ym)),
gap_list AS (SELECT dataset_key, string_agg(reference_date || ':' || kind, ';' ORDER BY reference_date) AS gaps FROM dataset_gaps GROUP BY ALL)"""


@query("SELECT e.dataset_key, string_agg(line, ';' ORDER BY ym) AS months, string_agg(ym, ';' ORDER BY ym) FILTER (state <> 'ok') AS anomalous, any_value(g.gaps) AS gaps FROM entries e LEFT JOIN listed USING (dataset_key) LEFT JOIN gap_list g USING (dataset_key) GROUP BY e.dataset_key", _NESTED)
def catalog_nested(s: Store) -> DataFrame:
    """Each public dataset with its months (and their files), anomalies and gaps as lists, here put into texts."""
    history = catalog.file_history(s.literal("source_files"), s.literal("dataset_sources"), s.literal("datasets"))
    nested = catalog.catalog_nested(_entries(s), _covered(s), s.literal("dataset_gaps"), history)
    file = lambda f: F.concat(F.substring(f["sha256"], 64, 1), F.lit("="), f["status"], f["offered"].cast("string"))
    month = lambda m: F.concat(m["ym"], F.lit(":"), m["state"], F.lit(":"), m["obs_rows"].cast("string"), F.lit(":"), F.coalesce(m["gap_kind"], F.lit("")), F.lit(":"), F.array_join(F.transform(m["files"], file), "+"))
    anomalous = F.array_join(F.transform("anomalous", lambda m: m["ym"]), ";")
    gaps = F.array_join(F.transform("gaps", lambda g: F.concat(g["reference_date"], F.lit(":"), g["kind"])), ";")
    return nested.select("dataset_key", F.array_join(F.transform("months", month), ";").alias("months"), F.nullif(anomalous, F.lit("")).alias("anomalous"), gaps.alias("gaps"))


# --- exports and display ---------------------------------------------------------------------------

_EXPORTED = "muni_code = '000001' AND reference_date BETWEEN '1996-01-01' AND '1997-12-01'"


@query(f"SELECT * FROM v_population_5y WHERE {_EXPORTED}")
def export_population(s: Store) -> DataFrame:
    return export.export_rows(_registered(s), "pop5", "population", "1996-01", "1997-12").df


@query(f"SELECT * FROM v_published_totals_5y WHERE {_EXPORTED}")
def export_published_totals(s: Store) -> DataFrame:
    return export.export_rows(_registered(s), "pop5", "published_totals", "1996-01", "1997-12").df


@query(f"SELECT muni_code || ',' || key_code || ',' || CASE WHEN contains(area_name, ',') THEN '\"' || area_name || '\"' ELSE area_name END || ',' || reference_date || ',' || CAST(value AS VARCHAR) || ',' || source_sha256 AS line FROM v_households_5y WHERE {_EXPORTED}")
def export_csv_lines(s: Store) -> DataFrame:
    return export.csv_lines(export.export_rows(_registered(s), "pop5", "households", "1996-01", "1997-12").df)


@query(f"SELECT '{{\"muni_code\":\"' || muni_code || '\",\"key_code\":\"' || key_code || '\",\"area_name\":\"' || area_name || '\",\"reference_date\":\"' || reference_date || '\",\"measure\":\"' || measure || '\",\"value\":' || CAST(value AS VARCHAR) || '}}' AS json FROM v_published_totals_5y WHERE {_EXPORTED}")
def export_json_rows(s: Store) -> DataFrame:
    return export.json_rows(export.export_rows(_registered(s), "pop5", "published_totals", "1996-01", "1997-12").df)


_SPLIT = f"{_PANEL}, split AS (SELECT reference_date, key_code, max(area_name) AS area_name, CAST(sum(value) AS BIGINT) AS value FROM v_population_5y WHERE muni_code = '000001' AND reference_date BETWEEN '{FROM}' AND '{TO}' GROUP BY reference_date, key_code), dense AS (SELECT d.reference_date, k.key_code, k.area_name, s.value FROM (SELECT DISTINCT reference_date FROM split) d CROSS JOIN (SELECT DISTINCT key_code, area_name FROM split) k LEFT JOIN split s USING (reference_date, key_code))"


def _split(s: Store) -> DataFrame:
    return families.trend(_registered(s), "pop5", FROM, TO, split=True).df


@query("SELECT * FROM dense", _SPLIT)
def trend_aligned(s: Store) -> DataFrame:
    return series.aligned(_split(s))


@query("SELECT *, round(value / CAST(nullif(first_value(value IGNORE NULLS) OVER (PARTITION BY key_code ORDER BY reference_date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 0) AS DOUBLE) * 100, 4) AS index_value FROM dense", _SPLIT)
def trend_rebased(s: Store) -> DataFrame:
    return series.rebased(series.aligned(_split(s)))


@query("SELECT key_code, a AS first_value, b AS last_value, b - a AS diff, round(coalesce((b - a) / CAST(nullif(a, 0) AS DOUBLE) * 100, 0), 4) AS rate, n AS n_months FROM (SELECT key_code, arg_min(value, reference_date) AS a, arg_max(value, reference_date) AS b, count(*) AS n FROM split GROUP BY key_code)", _SPLIT)
def trend_endpoints(s: Store) -> DataFrame:
    return series.endpoints(_split(s))


@query("SELECT key_code, round(min(value) - CASE WHEN max(value) > min(value) THEN (max(value) - min(value)) * 0.05 ELSE 1.0 END, 4) AS low, round(max(value) + CASE WHEN max(value) > min(value) THEN (max(value) - min(value)) * 0.05 ELSE 1.0 END, 4) AS high FROM split GROUP BY key_code", _SPLIT)
def trend_value_range(s: Store) -> DataFrame:
    return series.value_range(_split(s))


@query("""SELECT g.reference_date AS gap_date, kind, (SELECT max(reference_date) FROM dates d WHERE d.reference_date <= g.reference_date) AS before_date, (SELECT min(reference_date) FROM dates d WHERE d.reference_date >= g.reference_date) AS after_date,
          g.reference_date IN (SELECT reference_date FROM dates) AS on_month FROM dataset_gaps g WHERE g.reference_date >= (SELECT min(reference_date) FROM dates)""",
       f"{_PANEL}, dates AS (SELECT DISTINCT reference_date FROM v_nl_population)")
def gap_placement(s: Store) -> DataFrame:
    return series.placed_gaps(s.literal("dataset_gaps"), s.views["v_nl_population"])


@query("SELECT round(min(value) - CASE WHEN max(value) > min(value) THEN (max(value) - min(value)) * 0.12 ELSE 10.0 END, 4) AS low, round(max(value) + CASE WHEN max(value) > min(value) THEN (max(value) - min(value)) * 0.12 ELSE 10.0 END, 4) AS high FROM split", _SPLIT)
def trend_global_range(s: Store) -> DataFrame:
    return series.global_range(_split(s))


@seasonal("SELECT key_code, max(abs(pct_vs_trend)) AS max_abs_pct_vs_trend FROM v_nl_seasonality GROUP BY key_code")
def season_greatest_distance(s: Store) -> DataFrame:
    return series.greatest_distance(s.seasonal_views["v_nl_seasonality"], "pct_vs_trend", "key_code")


_TOWNS = """named AS (SELECT DISTINCT c_mktsegment || c_nationkey || '.' || CASE WHEN c_custkey % 7 = 0 THEN 'x' ELSE CAST(c_custkey % 40 AS VARCHAR) END AS key_code,
  c_mktsegment || CASE WHEN c_custkey % 7 = 0 THEN '' ELSE (c_custkey % 40) || '丁目' END AS area_name FROM customer WHERE c_nationkey = 3 OR c_custkey % 7 <> 0),
parted AS (SELECT *, CASE WHEN regexp_extract(area_name, '^(.+?)(\\d+)丁目$', 1) = '' THEN area_name ELSE regexp_extract(area_name, '^(.+?)(\\d+)丁目$', 1) END AS town, coalesce(TRY_CAST(regexp_extract(area_name, '(\\d+)丁目$', 1) AS INTEGER), 0) AS block FROM named)"""


@query("SELECT town, string_agg(area_name, ',' ORDER BY block, key_code) AS areas, count(*) AS n_areas FROM parted GROUP BY town", _TOWNS)
def town_groups(s: Store) -> DataFrame:
    """Customers' segments as towns, with blocks by number; some areas have none."""
    no_block = F.col("c_custkey") % 7 == 0
    block = (F.col("c_custkey") % 40).cast("string")
    named = s.panel.read("customer").filter((F.col("c_nationkey") == 3) | ~no_block).select(
        F.concat("c_mktsegment", F.col("c_nationkey").cast("string"), F.lit("."), F.when(no_block, "x").otherwise(block)).alias("key_code"),
        F.concat("c_mktsegment", F.when(no_block, "").otherwise(F.concat(block, F.lit("丁目")))).alias("area_name"),
    )
    return series.towns(named).withColumn("areas", F.array_join("areas", ","))


@query(f"SELECT * FROM v_population_5y WHERE {_EXPORTED} ORDER BY reference_date, key_code, age_class, sex LIMIT 200 OFFSET 400")
def export_third_page(s: Store) -> DataFrame:
    return export.page(export.export_rows(_registered(s), "pop5", "population", "1996-01", "1997-12").df, 200, 2)


_SHOWN = "shown AS (SELECT c_nationkey || ' ' || strftime(o_orderdate, '%Y-%m') AS id, CASE WHEN count(*) % 5 = 0 THEN NULL ELSE (count(*) - 8) * 777 END AS v FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey, strftime(o_orderdate, '%Y-%m'))"


@query("SELECT id, format('{:,}', v) AS number, CASE WHEN v > 0 THEN '+' ELSE '' END || format('{:,}', v) AS change, CASE WHEN v IS NULL OR v = 0 THEN '—' ELSE CAST(CAST(floor(v / 1024.0 + 0.5) AS BIGINT) AS VARCHAR) || ' KB' END AS kilobytes FROM shown", _SHOWN)
def shown_numbers(s: Store) -> DataFrame:
    """Numbers of orders by nation and month, less and more than nothing, as they are shown."""
    v = F.when(F.col("value") % 5 == 0, F.lit(None).cast("long")).otherwise((F.col("value") - 8) * 777)
    rows = s.panel.orders.select(F.concat_ws(" ", F.col("c_nationkey").cast("string"), F.substring("reference_date", 1, 7)).alias("id"), v.alias("v"))
    return rows.select("id", fn.shown_number(F.col("v")).alias("number"), fn.shown_change(F.col("v")).alias("change"), fn.shown_kilobytes(F.col("v")).alias("kilobytes"))


_REPLIES = "replies AS (SELECT event_id AS id, CASE event_id % 4 WHEN 0 THEN 'Here it is: ' || props || ' as asked.' WHEN 1 THEN 'no object' WHEN 2 THEN left(props, 4) ELSE '```' || chr(10) || props || chr(10) || '```' END AS reply FROM events), found AS (SELECT *, regexp_extract(reply, '(?s)\\{.*\\}') AS o FROM replies)"


@query("SELECT id, CASE WHEN o <> '' THEN CAST(o->>'k' AS BIGINT) END AS k FROM found", _REPLIES)
def object_in_text(s: Store) -> DataFrame:
    """The object in texts around events' properties: whole, absent, or cut off."""
    rows = s.panel.read("events").select(F.col("event_id").alias("id"), "props", (F.col("event_id") % 4).alias("way"))
    whole, fenced = F.concat(F.lit("Here it is: "), "props", F.lit(" as asked.")), F.concat(F.lit("```\n"), "props", F.lit("\n```"))
    reply = F.when(F.col("way") == 0, whole).when(F.col("way") == 1, "no object").when(F.col("way") == 2, F.left("props", F.lit(4))).otherwise(fenced)
    return rows.select("id", fn.first_object(reply, "k long")["k"].alias("k"))


# --- facts -----------------------------------------------------------------------------------------

_ALIKE = "CASE WHEN n_years = 0 THEN NULL WHEN n_above / n_years >= 0.9 THEN 'above every year' WHEN n_above / n_years <= 0.1 THEN 'below every year' WHEN n_above / n_years >= 0.75 THEN 'above most years' WHEN n_above / n_years <= 0.25 THEN 'below most years' ELSE 'differs by year' END"


@seasonal(f"SELECT *, {_ALIKE} AS consistency FROM v_nl_seasonality")
def consistency_label(s: Store) -> DataFrame:
    return facts.with_consistency(s.seasonal_views["v_nl_seasonality"])


@seasonal("SELECT max(area_name) FILTER (p = 1) AS top_area, max(amplitude_pct) FILTER (p = 1) AS top_pct, max(area_name) FILTER (p = 2) AS second_area, max(amplitude_pct) FILTER (p = 2) AS second_pct, count(*) AS n_listed FROM (SELECT *, row_number() OVER (ORDER BY amplitude_pct DESC, key_code) AS p FROM v_nl_seasonality_strength) WHERE p <= 20")
def facts_strength(s: Store) -> DataFrame:
    return facts.strength_facts(s.seasonal_views["v_nl_seasonality_strength"])


@seasonal("""SELECT key_code, max(m) FILTER (hi = 1) AS high_month, max(pct_vs_trend) AS high_pct, max(m) FILTER (lo = 1) AS low_month, min(pct_vs_trend) AS low_pct, round(max(pct_vs_trend) - min(pct_vs_trend), 2) AS amplitude_pct,
             coalesce(string_agg(CAST(m AS VARCHAR), ',' ORDER BY m) FILTER (n_above = 0 OR n_above = n_years), '') AS firm_months
             FROM (SELECT *, CAST(month AS INTEGER) AS m, row_number() OVER (PARTITION BY key_code ORDER BY pct_vs_trend DESC, month) AS hi, row_number() OVER (PARTITION BY key_code ORDER BY pct_vs_trend, month DESC) AS lo FROM v_nl_seasonality) GROUP BY key_code""")
def facts_profile(s: Store) -> DataFrame:
    return facts.profile_facts(s.seasonal_views["v_nl_seasonality"], "key_code")


@seasonal("""SELECT key_code, month, arg_min(age_class, pct_vs_trend * 100000 + age_order) AS worst_class, min(pct_vs_trend) AS worst_pct, coalesce(string_agg(age_class, ',' ORDER BY age_order) FILTER (abs(pct_vs_trend) >= 5), '') AS big_classes,
             count(*) FILTER (abs(pct_vs_trend) < 1) AS n_flat, count(*) AS n_classes, coalesce(string_agg(age_class, ',' ORDER BY age_order) FILTER (n_above = 0 OR n_above = n_years), '') AS firm_classes FROM v_nl_seasonality_age GROUP BY ALL""")
def facts_age(s: Store) -> DataFrame:
    return facts.age_facts(s.seasonal_views["v_nl_seasonality_age"], "key_code", "month")


@seasonal("SELECT * FROM v_nl_seasonality_age WHERE month = '09'")
def season_kept_view(s: Store) -> DataFrame:
    """A view that was written by month and read again: of its files only those of the month are read."""
    return s.kept("v_nl_seasonality_age").filter(F.col("month") == "09")


def _caveats_sql(mode: str) -> str:
    fixed = ", ".join(f"'{c}'" for c in facts.stated(resolve_measure("5y", "population"), mode))
    return f"""told AS (SELECT list_concat([{fixed}], (SELECT list(c ORDER BY c) FROM (
    SELECT 'gap ' || substr(reference_date, 1, 7) || ' (' || kind || '): ' || reason AS c FROM dataset_gaps WHERE dataset_key = 'pop5' AND kind <> 'series_break' AND reference_date >= '{BREAK_DATE}'
    UNION ALL SELECT 'open issue, ' || severity || ': ' || title FROM known_issues WHERE dataset_key = 'pop5' AND resolved_at IS NULL))) AS caveats)"""


@recorded("SELECT array_to_string(caveats, '|') AS caveats FROM told", f"{_RECORDED},{_caveats_sql('profile').replace('pop5', 'r1_5y')}")
def caveats(s: Store) -> DataFrame:
    rows = lambda t: s.literal(t).filter("dataset_key = 'r1_5y'")
    return facts.caveats(rows("dataset_gaps"), rows("known_issues"), facts.stated(resolve_measure("5y", "population"), "profile")).select(F.array_join("caveats", "|").alias("caveats"))


def insight_query(sql: str, mode: str):
    return query(sql, f"{_PANEL},{_SEASON},{_caveats_sql(mode)}")


def _insight(s: Store, mode: str, fields: list[str], *of: str) -> DataFrame:
    """The facts of one query, with the fields of its listed rows put into a text."""
    row = facts.insight_facts(_registered(s), "pop5", mode, *of)
    lines = F.transform("rows", lambda r: F.concat_ws(":", *(r[f].cast("string") for f in fields)))
    return row.select("mode", "scope", "month", F.array_join(lines, ";").alias("rows"), "derived.*", F.array_join("caveats", "|").alias("caveats"))


@insight_query("""SELECT 'strength' AS mode, 'America all areas' AS scope, CAST(NULL AS VARCHAR) AS month, string_agg(concat_ws(':', p, area_name, amplitude_pct, peak_month, trough_month), ';' ORDER BY p) AS rows,
  max(area_name) FILTER (p = 1) AS top_area, max(amplitude_pct) FILTER (p = 1) AS top_pct, max(area_name) FILTER (p = 2) AS second_area, max(amplitude_pct) FILTER (p = 2) AS second_pct, count(*) AS n_listed,
  (SELECT array_to_string(caveats, '|') FROM told) AS caveats
  FROM (SELECT s.*, row_number() OVER (ORDER BY amplitude_pct DESC, s.key_code) AS p FROM v_nl_seasonality_strength s JOIN areas a ON a.key_code = s.key_code WHERE a.muni_code = '000001') WHERE p <= 20 HAVING count(*) > 0""", "strength")
def insight_strength(s: Store) -> DataFrame:
    return _insight(s, "strength", ["place", "area_name", "amplitude_pct", "peak_month", "trough_month"])


@insight_query(f"""SELECT 'profile' AS mode, 'America ' || (SELECT max(area_name) FROM areas WHERE key_code = '00000001') AS scope, CAST(NULL AS VARCHAR) AS month, string_agg(concat_ws(':', m, pct_vs_trend, n_above, n_years, {_ALIKE}), ';' ORDER BY m) AS rows,
  max(m) FILTER (hi = 1) AS high_month, max(pct_vs_trend) AS high_pct, max(m) FILTER (lo = 1) AS low_month, min(pct_vs_trend) AS low_pct, round(max(pct_vs_trend) - min(pct_vs_trend), 2) AS amplitude_pct,
  coalesce(string_agg(CAST(m AS VARCHAR), ',' ORDER BY m) FILTER (n_above = 0 OR n_above = n_years), '') AS firm_months, (SELECT array_to_string(caveats, '|') FROM told) AS caveats
  FROM (SELECT *, CAST(month AS INTEGER) AS m, row_number() OVER (ORDER BY pct_vs_trend DESC, month) AS hi, row_number() OVER (ORDER BY pct_vs_trend, month DESC) AS lo FROM v_nl_seasonality WHERE key_code = '00000001') HAVING count(*) > 0""", "profile")
def insight_profile(s: Store) -> DataFrame:
    return _insight(s, "profile", ["month", "pct_vs_trend", "n_above", "n_years", "consistency"], "00000001")


@insight_query(f"""SELECT 'age' AS mode, 'America ' || (SELECT max(area_name) FROM areas WHERE key_code = '00000001') AS scope, '09' AS month, string_agg(concat_ws(':', age_class, pct_vs_trend, n_above, n_years, {_ALIKE}), ';' ORDER BY age_order) AS rows,
  arg_min(age_class, pct_vs_trend * 100000 + age_order) AS worst_class, min(pct_vs_trend) AS worst_pct, coalesce(string_agg(age_class, ',' ORDER BY age_order) FILTER (abs(pct_vs_trend) >= 5), '') AS big_classes,
  count(*) FILTER (abs(pct_vs_trend) < 1) AS n_flat, count(*) AS n_classes, coalesce(string_agg(age_class, ',' ORDER BY age_order) FILTER (n_above = 0 OR n_above = n_years), '') AS firm_classes, (SELECT array_to_string(caveats, '|') FROM told) AS caveats
  FROM v_nl_seasonality_age WHERE key_code = '00000001' AND month = '09' HAVING count(*) > 0""", "age")
def insight_age(s: Store) -> DataFrame:
    return _insight(s, "age", ["age_class", "pct_vs_trend", "n_above", "n_years", "consistency"], "00000001")


_TEXTS = """told AS (SELECT event_id AS id, '{"value":' || value || ',"user":' || user_id || '}' AS facts, 'The value is ' || CASE event_id % 3 WHEN 0 THEN CAST(value AS VARCHAR) WHEN 1 THEN CAST(floor(value + 0.5) AS VARCHAR) ELSE CAST(value AS VARCHAR) || '1' END || ' for user ' || (user_id + event_id % 2) AS text FROM events),
allowed AS (SELECT id, CAST(unnest(regexp_extract_all(facts, '-?[0-9]+(?:\\.[0-9]+)?')) AS DOUBLE) AS f FROM told UNION ALL SELECT id, CAST(unnest(generate_series(0, 24)) AS DOUBLE) FROM told),
found AS (SELECT id, CAST(unnest(regexp_extract_all(text, '-?[0-9]+(?:\\.[0-9]+)?')) AS DOUBLE) AS n FROM told),
wrong AS (SELECT DISTINCT id, n FROM found q WHERE NOT EXISTS (SELECT 1 FROM allowed a WHERE a.id = q.id AND (abs(n - f) < 0.005 OR n = floor(f + 0.5) OR abs(n - round(f, 1)) < 0.005)))"""


@query("SELECT id, coalesce(string_agg(CAST(n AS VARCHAR), ',' ORDER BY n) FILTER (n IS NOT NULL), '') AS bad, count(n) = 0 AS ok FROM told LEFT JOIN wrong USING (id) GROUP BY id", _TEXTS)
def verify_numbers(s: Store) -> DataFrame:
    """Texts on events held against each event's own facts: with its value, a rounding of it, or one that it hasn't."""
    value, way = F.col("value").cast("string"), F.col("event_id") % 3
    shown = F.when(way == 0, value).when(way == 1, F.floor(F.col("value") + 0.5).cast("double").cast("string")).otherwise(F.concat(value, F.lit("1")))
    text = F.concat(F.lit("The value is "), shown, F.lit(" for user "), (F.col("user_id") + F.col("event_id") % 2).cast("string"))
    texts = s.panel.read("events").select(F.col("event_id").alias("id"), text.alias("text"), F.to_json(F.struct("value", F.col("user_id").alias("user"))).alias("facts"))
    checked = facts.verify_numbers(texts, F.col("facts"))
    return checked.select("id", F.array_join(F.transform(F.sort_array("bad"), lambda x: x.cast("string")), ",").alias("bad"), "ok")


# --- the catalog as drawn from the test tables -------------------------------------------------------


@recorded("SELECT * FROM entries", _RECORDED_CATALOG)
def recorded_catalog_entries(s: Store) -> DataFrame:
    return _entries(s)


@recorded("SELECT * FROM covered", _RECORDED_CATALOG)
def recorded_coverage(s: Store) -> DataFrame:
    return _covered(s)


@recorded("SELECT summary.*, CAST(o.n AS BIGINT) AS obs_rows FROM summary LEFT JOIN (SELECT dataset_key, sum(obs_rows) AS n FROM periods GROUP BY ALL) o USING (dataset_key)", _RECORDED_CATALOG)
def recorded_coverage_summary(s: Store) -> DataFrame:
    return catalog.coverage_summary(s.periods, s.literal("datasets"))


@recorded("SELECT (SELECT count(*) FROM entries WHERE license IS NULL) AS no_license, (SELECT count(*) FROM entries WHERE attribution IS NULL) AS no_attribution, (SELECT count(*) FROM entries WHERE last_run_at IS NULL) AS no_runs, (SELECT count(*) FROM known_issues WHERE resolved_at IS NULL) AS open_issues", _RECORDED_CATALOG)
def recorded_warnings(s: Store) -> DataFrame:
    return catalog.catalog_warnings(_entries(s), s.literal("known_issues"))


from . import written_queries  # noqa: E402, F401  registers its own
