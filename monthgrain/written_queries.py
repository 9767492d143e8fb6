"""Queries over written tables: bucketed facts, months as partitions, kept sums, versions, pages and parts."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import export, facts, families, season, series
from .plans import BREAK_DATE, Store
from .plans.incremental import SeasonState
from .plans.versions import VersionedTable
from .plans.warehouse import GRAINS, WrittenStore, grain_name
from .queries import _EXPORTED, _PANEL, _RANKED, FROM, KEYS, LATE, ORACLES, QUERIES, TO, _rounded, _season_sql, query, seasonal
from .schema import EXPORT_ORDER, TABLES, resolve_measure
from .sources.csv_parts import BYTE_ORDER_MARK, CsvParts


def written(sql: str, needs: str = _PANEL):
    """Registers a function of a WrittenStore as a query, with its SQL."""

    def register(f: Callable[[WrittenStore], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(WrittenStore.of(spark, sf_dir))
        ORACLES[f.__name__] = f"WITH {needs} {sql}"
        return f

    return register


def _spark(s: Store) -> SparkSession:
    s.register()
    return s.spark


# --- facts by order, months as partitions, kept sums ------------------------------------------------


@written("""SELECT c_nationkey, strftime(o_orderdate, '%Y-%m-01') AS reference_date, p_size AS age, CASE WHEN l_linestatus = 'F' THEN 'female' ELSE 'male' END AS sex, CAST(sum(l_quantity) AS BIGINT) AS value,
  CAST(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS BIGINT) AS foreign_value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey GROUP BY ALL""")
def panel_cells_by_buckets(s: WrittenStore) -> DataFrame:
    """The panel's one pass over the facts: a merge join of bucketed lines and orders that moves no row of either."""
    return s.panel.cells()


@written("SELECT * FROM observations_5y")
def observations_by_month(s: WrittenStore) -> DataFrame:
    return s.observations_5y


@written("SELECT * FROM observations_1y")
def observations_1y_by_month(s: WrittenStore) -> DataFrame:
    return s.observations_1y


_TREND = f"SELECT reference_date, CAST(sum(value) AS BIGINT) AS value, count(DISTINCT key_code) AS areas FROM {{0}} WHERE muni_code = '000001' AND reference_date BETWEEN '{FROM}' AND '{TO}' {{1}} GROUP BY ALL"


@written(_TREND.format("v_population_5y", ""))
def trend_sum_kept(s: WrittenStore) -> DataFrame:
    """From the sums by area and month rather than from leaves."""
    return families.trend(_spark(s), "pop5", FROM, TO, routes=s.routes).df


@written(_TREND.format("v_population_5y", "AND key_code IN ('00000001', '00000002', '00000003')"))
def trend_keys_kept(s: WrittenStore) -> DataFrame:
    return families.trend(_spark(s), "pop5", FROM, TO, KEYS, routes=s.routes).df


@written(_TREND.format("v_population_1y", ""))
def trend_single_years_kept(s: WrittenStore) -> DataFrame:
    return families.trend(_spark(s), "pop1", FROM, TO, routes=s.routes).df


@written(_TREND.format("v_foreign_population_5y", ""))
def trend_foreign_kept(s: WrittenStore) -> DataFrame:
    return families.trend(_spark(s), "pop5", FROM, TO, measure="foreign_population", routes=s.routes).df


@written(f"SELECT reference_date, key_code, max(area_name) AS area_name, CAST(sum(value) AS BIGINT) AS value FROM v_population_5y WHERE muni_code = '000001' AND reference_date BETWEEN '{FROM}' AND '{TO}' GROUP BY reference_date, key_code")
def trend_split_kept(s: WrittenStore) -> DataFrame:
    return families.trend(_spark(s), "pop5", FROM, TO, split=True, routes=s.routes).df


@written(f"SELECT age_class, sex, CAST(sum(value) AS BIGINT) AS value FROM v_population_5y WHERE muni_code = '000001' AND reference_date = '{FROM}' GROUP BY ALL")
def pyramid_kept(s: WrittenStore) -> DataFrame:
    return families.pyramid(_spark(s), "pop5", FROM, routes=s.routes).df


@written(f"SELECT age_class, sex, CAST(sum(value) AS BIGINT) AS value FROM v_population_5y WHERE muni_code = '000001' AND key_code = '00000001' AND reference_date = '{FROM}' GROUP BY ALL")
def pyramid_area_kept(s: WrittenStore) -> DataFrame:
    """No kept sum has both areas and ages: this one reads leaves, of one month's folder."""
    return families.pyramid(_spark(s), "pop5", FROM, "00000001", routes=s.routes).df


@written(f"SELECT * REPLACE (round(rate, 6) AS rate) FROM ({_RANKED.format('v_population_5y')})")
def ranking_kept(s: WrittenStore) -> DataFrame:
    return _rounded(families.ranking(_spark(s), "pop5", FROM, LATE, routes=s.routes).df)


@written(" UNION ALL ".join(f"SELECT '{grain_name(v, c)}' AS grain, reference_date, CAST(sum(value) AS BIGINT) AS value, count(*) AS n_rows FROM {v} GROUP BY reference_date" for v, cs in GRAINS.items() for c in cs))
def kept_sums(s: WrittenStore) -> DataFrame:
    """What each kept sum holds by month: all of its view, and how many of its rows."""
    parts = [s.routes.frames[g.name].groupBy("reference_date").agg(F.sum("value").alias("value"), F.sum("n_rows").alias("n_rows")).select(F.lit(g.name).alias("grain"), "*") for g in s.routes.grains]
    return reduce(DataFrame.unionByName, parts)


def _delivered(s: WrittenStore) -> WrittenStore:
    """A written store of its own that has taken a late delivery, of one municipality's month with other values."""
    if "delivered" not in s.__dict__:
        own = WrittenStore(s.spark, s.sf_dir, s.grain, s.panel)
        s._written["delivered"] = own._root  # goes with s
        own.routes  # made before the delivery, so that it has to be brought up to date
        late = own.observations_5y.filter((F.col("reference_date") == _LATE_MONTH) & (F.col("muni_code") == _LATE_MUNI))
        own.deliver(late.withColumn("value", F.col("value") * 2 + 1))
        s.__dict__["delivered"] = own
    return s.__dict__["delivered"]


_LATE_MONTH, _LATE_MUNI = "1998-05-01", "000001"
_DELIVERED = f"CASE WHEN reference_date = '{_LATE_MONTH}' AND muni_code = '{_LATE_MUNI}' THEN value * 2 + 1 ELSE value END"


@written(f"SELECT reference_date, CAST(sum({_DELIVERED}) AS BIGINT) AS value, count(DISTINCT key_code) AS areas FROM v_population_5y WHERE muni_code = '000001' AND reference_date BETWEEN '{FROM}' AND '{TO}' GROUP BY ALL")
def trend_after_delivery(s: WrittenStore) -> DataFrame:
    """Kept sums are brought up to date by a delivery, of its month alone."""
    own = _delivered(s)
    return families.trend(_spark(own), "pop5", FROM, TO, routes=own.routes).df


@written(" UNION ALL ".join(f"SELECT '{grain_name(v, c)}' AS grain, reference_date, CAST(sum({_DELIVERED if v != 'v_population_1y' else 'value'}) AS BIGINT) AS value FROM {v} GROUP BY reference_date" for v, cs in GRAINS.items() for c in cs))
def kept_sums_after_delivery(s: WrittenStore) -> DataFrame:
    routes = _delivered(s).routes
    return reduce(DataFrame.unionByName, [routes.frames[g.name].groupBy("reference_date").agg(F.sum("value").alias("value")).select(F.lit(g.name).alias("grain"), "*") for g in routes.grains])


# --- late months -------------------------------------------------------------------------------------

_OBS_KEYS = ("muni_code", "key_code", "reference_date", "measure", "age_class", "sex")


def _late(s: Store) -> VersionedTable:
    """Observations of which one municipality's month first had other values; its corrected rows are merged."""
    table = lambda path: VersionedTable(s.spark, path, TABLES["observations_5y"], "reference_date", _OBS_KEYS)

    def write(path: str) -> None:
        late = (F.col("reference_date") == _LATE_MONTH) & (F.col("muni_code") == _LATE_MUNI)
        table(path).replace(s.observations_5y.withColumn("value", F.when(late, F.col("value") * 2 + 1).otherwise(F.col("value"))), note="first load")
        table(path).merge(s.observations_5y.filter(late), note="corrected")

    return table(s.once("late-month", write))


@query("SELECT muni_code, key_code, reference_date, measure, age_class, sex, value, source_sha256 FROM observations_5y")
def late_month_merged(s: Store) -> DataFrame:
    return _late(s).read()


@query(f"SELECT DISTINCT reference_date, CASE WHEN reference_date = '{_LATE_MONTH}' THEN 2 ELSE 1 END AS version FROM observations_5y")
def late_month_versions(s: Store) -> DataFrame:
    """Which version holds each month: the merge has written that of its own month alone."""
    held = _late(s).manifest()["partitions"]
    return s.spark.createDataFrame([(k.partition("=")[2], int(v.partition("-")[0])) for k, v in held.items()], "reference_date string, version int")


@query(f"SELECT muni_code, key_code, reference_date, measure, age_class, sex, CASE WHEN reference_date = '{_LATE_MONTH}' AND muni_code = '{_LATE_MUNI}' THEN value * 2 + 1 ELSE value END AS value, source_sha256 FROM observations_5y")
def late_month_as_it_was(s: Store) -> DataFrame:
    """The version before the merge can still be read."""
    return _late(s).read(1)


def _updated_season(s: Store) -> SeasonState:
    """Seasonality of a panel that lacked a month of two areas, and had another value in one, before it was updated."""

    def write(path: str) -> None:
        panel = season.month_panel(s.views["v_nl_population"], "population", BREAK_DATE)
        late, wrong = F.col("key_code").isin("00000001", "00000007") & (F.col("reference_date") == _LATE_MONTH), (F.col("key_code") == "00000012") & (F.col("reference_date") == "2000-02-01")
        state = SeasonState(s.spark, path)
        state.load(panel.filter(~late).withColumn("value", F.when(wrong, F.col("value") + 1000).otherwise(F.col("value"))))
        state.update(panel.filter(late | wrong))

    return SeasonState(s.spark, s.once("season-state", write))


@seasonal("SELECT * FROM v_nl_seasonality")
def season_updated(s: Store) -> DataFrame:
    """After an update, the index is that of a full run."""
    return _updated_season(s).index.read().drop("bucket")


@seasonal("SELECT key_code, month_index, month, round(ratio, 6) AS ratio FROM v_nl_seasonality_ratio")
def season_updated_ratios(s: Store) -> DataFrame:
    return _updated_season(s).ratios.read().select("key_code", "month_index", "month", F.round("ratio", 6).alias("ratio"))


_LATER = "1997-07-01"


@query("SELECT * FROM later", f"{_PANEL},{_season_sql('later', 'v_nl_population', 'population').replace(BREAK_DATE, _LATER)}")
def season_since_a_later_break(s: Store) -> DataFrame:
    """Months before the break are there, and left out."""
    return season.population_index(s.views, _LATER)


# --- notes as of, pages, parts -----------------------------------------------------------------------


@query("""SELECT event_id, user_id, strftime(before, '%Y-%m-%d %H:%M:%S.%f') AS before, strftime(after, '%Y-%m-%d %H:%M:%S.%f') AS after FROM (
  SELECT event_id, user_id, max(CASE WHEN event_type = 'purchase' THEN ts END) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS before,
         min(CASE WHEN event_type = 'purchase' THEN ts END) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after FROM events)""", "unused AS (SELECT 1)")
def as_of_purchases(s: Store) -> DataFrame:
    """For each event the user's last purchase up to it and next one from it on."""
    events = s.spark.read.parquet(f"{s.sf_dir}/events.parquet")
    near = series.as_of(events.select("event_id", "user_id", "ts"), events.filter("event_type = 'purchase'"), "ts", ("user_id",), F.substring(F.col("_at").cast("string"), 1, 10))
    shown = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)
    return near.select("event_id", "user_id", shown("before"), shown("after"))


_ORDERED = "reference_date, key_code, age_class, sex"


def _pages(s: Store) -> export.PageIndex:
    result = export.export_rows(_spark(s), "pop5", "population", "1996-01", "1997-12")
    return export.PageIndex.of(result.df, [c for c in EXPORT_ORDER if c in result.df.columns], 500)


@query(f"SELECT * FROM v_population_5y WHERE {_EXPORTED} ORDER BY {_ORDERED} LIMIT 500 OFFSET 500")
def export_page_by_keys(s: Store) -> DataFrame:
    """The second page, read from its first key to the third page's."""
    return _pages(s).page(1)


@query(f"SELECT CAST((row_number() OVER (ORDER BY {_ORDERED}) - 1) // 500 AS BIGINT) AS page, * FROM v_population_5y WHERE {_EXPORTED}")
def export_pages_by_keys(s: Store) -> DataFrame:
    """All pages, each read by its own keys, one after the other."""
    index = _pages(s)
    pages = [r.page for r in index.starts.select("page").orderBy("page").collect()]  # a row a page of 24 months at most
    return reduce(DataFrame.unionByName, [index.page(n).select(F.lit(n).cast("long").alias("page"), "*") for n in pages])


@query(f"SELECT page, {_ORDERED} FROM (SELECT CAST((row_number() OVER (ORDER BY {_ORDERED}) - 1) // 500 AS BIGINT) AS page, (row_number() OVER (ORDER BY {_ORDERED}) - 1) % 500 AS place, {_ORDERED} FROM v_population_5y WHERE {_EXPORTED}) WHERE place = 0")
def export_page_starts(s: Store) -> DataFrame:
    return _pages(s).starts


def _parts(s: Store) -> str:
    """A dataset's export, written as CSV parts."""

    def write(path: str) -> None:
        s.spark.dataSource.register(CsvParts)
        export.export_rows(_spark(s), "pop5", "population", "1996-01", "1997-12").df.write.format("csv_parts").mode("append").save(path)

    s.spark.dataSource.register(CsvParts)
    return s.once("csv-parts", write)


@query(f"SELECT * FROM v_population_5y WHERE {_EXPORTED}")
def export_parts_read_back(s: Store) -> DataFrame:
    kinds = "muni_code string, key_code string, area_name string, reference_date string, age_class string, sex string, value long, source_sha256 string"
    return s.spark.read.format("csv_parts").schema(kinds).load(_parts(s))


@query(f"SELECT concat_ws(',', muni_code, key_code, area_name, reference_date, age_class, sex, value, source_sha256) AS line FROM v_population_5y WHERE {_EXPORTED}")
def raw_objects_by_hash(s: Store) -> DataFrame:
    """The written parts as raw objects: each is found by the hash of its bytes, and its lines are read from these."""
    objects = s.spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(_parts(s)).select(F.sha2("content", 256).alias("sha256"), "length", "content")
    listed = objects.select("sha256", "length").distinct()
    found = objects.join(listed.filter("length > 0"), ["sha256", "length"], "left_semi")
    lines = found.select(F.explode(F.split(F.decode("content", "UTF-8"), "\n")).alias("line"))
    return lines.filter((F.col("line") != "") & ~F.col("line").startswith(BYTE_ORDER_MARK))


# --- texts on all areas ------------------------------------------------------------------------------


def stand_in_writer(told: str, wrong: list[str]) -> str:
    """Stands in for a text model, with its faults: of some areas it first says a number of its own, of some it always does."""
    f = json.loads(told)
    text = f"{f['area_name']} is highest in month {f['high_month']} at {f['high_pct']} percent and lowest in month {f['low_month']} at {f['low_pct']}."
    stubborn, hasty = f["low_month"] % 4 == 1, f["high_month"] % 2 == 1 and not wrong
    return text + (" That is 999.5 more." if stubborn or hasty else "")


@seasonal("""SELECT key_code, CASE WHEN l % 4 <> 1 THEN area_name || ' is highest in month ' || h || ' at ' || hp || ' percent and lowest in month ' || l || ' at ' || lp || '.' END AS text, l % 4 <> 1 AS ok,
  CASE WHEN l % 4 = 1 OR h % 2 = 1 THEN 2 ELSE 1 END AS tries, CASE WHEN l % 4 = 1 THEN '999.5' ELSE '' END AS bad
  FROM (SELECT key_code, any_value(area_name) AS area_name, max(m) FILTER (hi = 1) AS h, max(pct_vs_trend) AS hp, max(m) FILTER (lo = 1) AS l, min(pct_vs_trend) AS lp FROM (
    SELECT *, CAST(month AS INTEGER) AS m, row_number() OVER (PARTITION BY key_code ORDER BY pct_vs_trend DESC, month) AS hi, row_number() OVER (PARTITION BY key_code ORDER BY pct_vs_trend, month DESC) AS lo FROM v_nl_seasonality) GROUP BY key_code)""")
def insight_all_areas(s: Store) -> DataFrame:
    """A text an area, written in tasks and checked; rejected ones are written once more."""
    told = facts.caveats(s.literal("dataset_gaps").filter("dataset_key = 'pop5'"), s.literal("known_issues").filter("dataset_key = 'pop5'"), facts.stated(resolve_measure("5y", "population"), "profile"))
    rows = facts.area_facts(s.seasonal_views["v_nl_seasonality"], told, "key_code", "area_name")
    texts = facts.insights(rows, stand_in_writer)
    return texts.select("key_code", "text", "ok", "tries", F.array_join(F.transform("bad", lambda x: x.cast("string")), ",").alias("bad"))
