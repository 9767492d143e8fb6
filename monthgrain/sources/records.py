"""The catalog's tables as drawn from the test tables, so that they grow with them, each beside its SQL.

A region is a municipality with a dataset at each grain. Its orders of a month and priority came as one file; months
with certain counts are gaps; each order is an issue, each event a run; suppliers are other names of their nation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import TABLES
from .panel import Panel


def _month(ts: str):
    return F.date_format(ts, "yyyy-MM-01")


def _day(ts: str):
    return F.date_format(ts, "yyyy-MM-dd")


def _regional(panel: Panel) -> DataFrame:
    """Orders with their region and segment."""
    customers = panel.read("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    nations = panel.read("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("region"))
    return panel.read("orders").join(customers, "o_custkey").join(nations, "c_nationkey")


def _key(region, granularity: str):
    return F.concat(F.lit("r"), region.cast("string"), F.lit(f"_{granularity}"))


def _months(panel: Panel) -> DataFrame:
    return _regional(panel).groupBy("region", _month("o_orderdate").alias("reference_date")).agg(F.count("*").alias("n"))


def datasets(panel: Panel) -> DataFrame:
    grain = F.explode(F.array(F.lit("5y"), F.lit("1y"))).alias("granularity")
    rows = panel.read("region").select(F.col("r_regionkey").alias("region"), "r_name", grain)
    five, odd = F.col("granularity") == "5y", F.col("region") % 2 == 1
    return rows.select(
        F.concat(F.lit("r"), F.col("region").cast("string"), F.lit("_"), "granularity").alias("dataset_key"), F.lpad(F.col("region").cast("string"), 6, "0").alias("muni_code"), F.col("r_name").alias("muni_name"), F.lit("population").alias("domain"),
        F.concat("r_name", F.when(five, " in five-year classes").otherwise(" by single years")).alias("title"), "granularity", F.when(five, "5-year").otherwise("1-year").alias("grain_label"), F.lit("site").alias("source_site"),
        F.concat(F.lit("https://data.example/"), F.col("region").cast("string")).alias("source_url"), F.when(odd, "CC BY 4.0").alias("license"), F.when(~odd, F.col("r_name")).alias("attribution"), (F.col("region") != 4).cast("int").alias("is_public"), F.lit(None).cast("string").alias("notes"),
    )


def dataset_sources(panel: Panel) -> DataFrame:
    """Files of the first three priorities are of five-year classes, those of the fourth of single years; the fifth isn't mapped."""
    regions = panel.read("region").select(F.col("r_regionkey").alias("region"), F.explode(F.array(*map(F.lit, "1234"))).alias("p"))
    five = F.col("p") != "4"
    return regions.select(F.when(five, _key(F.col("region"), "5y")).otherwise(_key(F.col("region"), "1y")).alias("dataset_key"), F.concat(F.lit("src-"), F.col("region").cast("string"), F.lit("-"), "p").alias("dataset"), F.when(five, "5y").otherwise("1y").alias("granularity"), F.when(F.col("p") == "1", "archive").otherwise("latest").alias("role"))


def source_files(panel: Panel) -> DataFrame:
    months = _regional(panel).groupBy("region", _month("o_orderdate").alias("reference_date"), "o_orderpriority").agg(
        F.count("*").alias("n"), F.sum("o_orderkey").alias("content_bytes"), F.max(_day("o_orderdate")).alias("ingested_at"), F.min(_day("o_orderdate")).alias("source_last_modified"))
    n, p, text, number = F.col("n"), F.left("o_orderpriority", F.lit(1)), F.lit(None).cast("string"), F.lit(None).cast("int")
    held = n % 5 == 1
    skipped = n % 7 == 0
    return months.select(
        F.sha2(F.concat_ws(":", F.lit("file"), F.col("region").cast("string"), "reference_date", "o_orderpriority"), 256).alias("sha256"), F.concat(F.lit("src-"), F.col("region").cast("string"), F.lit("-"), p).alias("dataset"),
        F.when(p < "4", "5y").otherwise("1y").alias("granularity"), "reference_date", F.concat_ws("/", F.lit("raw"), F.col("region").cast("string"), "reference_date", p).alias("r2_key"), F.concat("reference_date", F.lit(".csv")).alias("source_file"), "content_bytes",
        F.when(skipped, "skipped").otherwise("ingested").alias("status"), n.alias("row_count"), F.when(skipped, "not a table").alias("skip_reason"), "ingested_at", F.when(n % 3 == 0, number).otherwise(F.when(held, 0).otherwise(1)).alias("distributable"),
        F.when((n % 3 != 0) & held, "under review").alias("hold_reason"), text.alias("resource_id"), "source_last_modified", text.alias("supersedes"), F.when(n % 4 == 0, number).otherwise((n % 4 != 1).cast("int")).alias("is_current"), text.alias("filename_date"), F.lit("name").alias("date_source"),
    )


#: Kinds of a gap by the remainder of a month's orders.
KINDS = ("upstream_missing", "ingest_failed", "pending_fix", "series_break")


def dataset_gaps(panel: Panel) -> DataFrame:
    kind = F.element_at(F.array(*map(F.lit, KINDS)), (F.col("n") % 4 + 1).cast("int"))
    return _months(panel).filter("n % 11 = 3").select(_key(F.col("region"), "5y").alias("dataset_key"), "reference_date", kind.alias("kind"), F.concat(F.col("n").cast("string"), F.lit(" orders")).alias("reason"), F.lit("2020-01-01").alias("noted_at"))


def sync_runs(panel: Panel) -> DataFrame:
    e, error = panel.read("events"), F.col("event_type") == "error"
    granularity = F.when(F.col("event_id") % 2 == 0, "_5y").otherwise("_1y")
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return e.select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("run_id"), F.concat(F.lit("r"), (F.col("user_id") % 5).cast("string"), granularity).alias("dataset_key"), at.alias("started_at"), F.when(~error, at).alias("finished_at"),
        F.when(error, "error").when(F.col("event_type") == "view", "no_change").otherwise("ok").alias("status"), (F.col("event_id") % 3).cast("int").alias("new_files"), F.when(error, "timeout").alias("error"),
    )


def dataset_periods(panel: Panel) -> DataFrame:
    """What was known before a refresh: files of months with an even count, and no rows yet in some."""
    return _months(panel).filter("n % 2 = 0").select(_key(F.col("region"), "5y").alias("dataset_key"), "reference_date", F.lit(9).cast("long").alias("file_count"), F.when(F.col("n") % 3 == 0, F.lit(0).cast("long")).otherwise(F.col("n")).alias("obs_rows"))


def known_issues(panel: Panel) -> DataFrame:
    severity = F.when(F.col("o_orderpriority") == "1-URGENT", "high").when(F.col("o_orderpriority") == "2-HIGH", "medium").otherwise("low")
    return _regional(panel).select(
        F.col("o_orderkey").alias("issue_id"), _key(F.col("region"), "5y").alias("dataset_key"), F.concat(F.lower("c_mktsegment"), F.lit(" orders")).alias("title"), F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("detail"),
        severity.alias("severity"), F.when(F.col("o_orderstatus") == "F", _day("o_orderdate")).alias("resolved_at"),
    )


def area_aliases(panel: Panel) -> DataFrame:
    return panel.read("supplier").select(F.lpad(F.col("s_nationkey").cast("string"), 8, "0").alias("key_code"), F.col("s_name").alias("alias_name"))


MAKERS: dict[str, Callable[[Panel], DataFrame]] = {f.__name__: f for f in (datasets, dataset_sources, dataset_gaps, sync_runs, source_files, known_issues, area_aliases, dataset_periods)}


def frame(panel: Panel, table: str) -> DataFrame:
    schema = TABLES[table]
    return MAKERS[table](panel).select(*(F.col(f.name).cast(f.dataType) for f in schema))


_REGIONAL = "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
_MONTH, _DAY = "strftime(o_orderdate, '%Y-%m-01')", "strftime(o_orderdate, '%Y-%m-%d')"
_MONTHS = f"(SELECT n_regionkey AS region, {_MONTH} AS reference_date, count(*) AS n FROM {_REGIONAL} GROUP BY ALL)"
#: The same tables as SQL relations, by DuckDB.
SQL: dict[str, str] = {
    "datasets": """SELECT 'r' || r_regionkey || '_' || granularity AS dataset_key, lpad(CAST(r_regionkey AS VARCHAR), 6, '0') AS muni_code, r_name AS muni_name, 'population' AS domain, r_name || CASE granularity WHEN '5y' THEN ' in five-year classes' ELSE ' by single years' END AS title,
        granularity, CASE granularity WHEN '5y' THEN '5-year' ELSE '1-year' END AS grain_label, 'site' AS source_site, 'https://data.example/' || r_regionkey AS source_url, CASE WHEN r_regionkey % 2 = 1 THEN 'CC BY 4.0' END AS license, CASE WHEN r_regionkey % 2 = 0 THEN r_name END AS attribution,
        CAST(r_regionkey <> 4 AS INTEGER) AS is_public, CAST(NULL AS VARCHAR) AS notes FROM region, (VALUES ('5y'), ('1y')) g(granularity)""",
    "dataset_sources": "SELECT 'r' || r_regionkey || CASE WHEN p = '4' THEN '_1y' ELSE '_5y' END AS dataset_key, 'src-' || r_regionkey || '-' || p AS dataset, CASE WHEN p = '4' THEN '1y' ELSE '5y' END AS granularity, CASE WHEN p = '1' THEN 'archive' ELSE 'latest' END AS role FROM region, (VALUES ('1'), ('2'), ('3'), ('4')) x(p)",
    "dataset_gaps": f"SELECT 'r' || region || '_5y' AS dataset_key, reference_date, [{', '.join(f"'{k}'" for k in KINDS)}][n % 4 + 1] AS kind, n || ' orders' AS reason, '2020-01-01' AS noted_at FROM {_MONTHS} WHERE n % 11 = 3",
    "sync_runs": """SELECT 'e' || event_id AS run_id, 'r' || (user_id % 5) || CASE WHEN event_id % 2 = 0 THEN '_5y' ELSE '_1y' END AS dataset_key, strftime(ts, '%Y-%m-%d %H:%M:%S') AS started_at, CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS finished_at,
        CASE event_type WHEN 'error' THEN 'error' WHEN 'view' THEN 'no_change' ELSE 'ok' END AS status, CAST(event_id % 3 AS INTEGER) AS new_files, CASE event_type WHEN 'error' THEN 'timeout' END AS error FROM events""",
    "source_files": f"""SELECT sha256('file:' || region || ':' || reference_date || ':' || o_orderpriority) AS sha256, 'src-' || region || '-' || p AS dataset, CASE WHEN p < '4' THEN '5y' ELSE '1y' END AS granularity, reference_date, 'raw/' || region || '/' || reference_date || '/' || p AS r2_key, reference_date || '.csv' AS source_file,
        CAST(content_bytes AS BIGINT) AS content_bytes, CASE WHEN n % 7 = 0 THEN 'skipped' ELSE 'ingested' END AS status, n AS row_count, CASE WHEN n % 7 = 0 THEN 'not a table' END AS skip_reason, ingested_at, CASE WHEN n % 3 = 0 THEN NULL WHEN n % 5 = 1 THEN 0 ELSE 1 END AS distributable,
        CASE WHEN n % 3 <> 0 AND n % 5 = 1 THEN 'under review' END AS hold_reason, CAST(NULL AS VARCHAR) AS resource_id, source_last_modified, CAST(NULL AS VARCHAR) AS supersedes, CASE WHEN n % 4 = 0 THEN NULL ELSE CAST(n % 4 <> 1 AS INTEGER) END AS is_current, CAST(NULL AS VARCHAR) AS filename_date, 'name' AS date_source
        FROM (SELECT n_regionkey AS region, {_MONTH} AS reference_date, o_orderpriority, left(o_orderpriority, 1) AS p, count(*) AS n, sum(o_orderkey) AS content_bytes, max({_DAY}) AS ingested_at, min({_DAY}) AS source_last_modified FROM {_REGIONAL} GROUP BY ALL)""",
    "known_issues": f"""SELECT o_orderkey AS issue_id, 'r' || n_regionkey || '_5y' AS dataset_key, lower(c_mktsegment) || ' orders' AS title, 'order ' || o_orderkey AS detail, CASE o_orderpriority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'medium' ELSE 'low' END AS severity,
        CASE WHEN o_orderstatus = 'F' THEN {_DAY} END AS resolved_at FROM {_REGIONAL}""",
    "area_aliases": "SELECT lpad(CAST(s_nationkey AS VARCHAR), 8, '0') AS key_code, s_name AS alias_name FROM supplier",
    "dataset_periods": f"SELECT 'r' || region || '_5y' AS dataset_key, reference_date, CAST(9 AS BIGINT) AS file_count, CASE WHEN n % 3 = 0 THEN 0 ELSE n END AS obs_rows FROM {_MONTHS} WHERE n % 2 = 0",
}
