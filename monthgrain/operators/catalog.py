"""The catalog: what each dataset holds, which months are missing, and which files stand behind them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import month_index, severity_rank, year_month


def merge_upsert(target: DataFrame, changes: DataFrame, keys: list[str], defaults: dict[str, int]) -> DataFrame:
    """target with changes: columns that changes has win, the others keep their value or get a default."""
    t, c = target.alias("t"), changes.alias("c")
    joined = t.join(c, keys, "full_outer")
    pick = [F.coalesce(*([F.col(f"c.{n}")] if n in changes.columns else []), F.col(f"t.{n}"), *([F.lit(defaults[n])] if n in defaults else [])).alias(n) for n in target.columns if n not in keys]
    return joined.select(*keys, *pick)


def insert_or_replace(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    return target.join(rows.select(*keys), keys, "left_anti").unionByName(rows)


def mapped_files(files: DataFrame, sources: DataFrame) -> DataFrame:
    """Files with the dataset they belong to; files of sources that aren't mapped are left out."""
    return files.join(sources.select("dataset_key", "dataset", "granularity"), ["dataset", "granularity"])


def rows_by_month(observations: DataFrame) -> DataFrame:
    """How many observation rows a municipality has in a month, total rows too."""
    return observations.groupBy("muni_code", "reference_date").agg(F.count("*").alias("n"))


def refresh_periods(files: DataFrame, sources: DataFrame, datasets: DataFrame, obs5: DataFrame, obs1: DataFrame) -> DataFrame:
    """dataset_periods from scratch: ingested files by month, then observation rows by month.

    Rows count for every dataset of their municipality and granularity, total rows too."""
    rows = [rows_by_month(obs).withColumn("granularity", F.lit(g)) for obs, g in ((obs5, "5y"), (obs1, "1y"))]
    return periods_of(files, sources, datasets, rows[0].unionByName(rows[1]))


def periods_of(files: DataFrame, sources: DataFrame, datasets: DataFrame, rows: DataFrame) -> DataFrame:
    """`refresh_periods` of rows that are counted already (muni_code, granularity, reference_date, n)."""
    counted = mapped_files(files, sources).filter("status = 'ingested' AND reference_date IS NOT NULL").groupBy("dataset_key", "reference_date").agg(F.count("*").alias("file_count"))

    owned = rows.join(datasets.select("dataset_key", "muni_code", "granularity"), ["muni_code", "granularity"]).groupBy("dataset_key", "reference_date").agg(F.sum("n").alias("obs_rows"))
    keys = ["dataset_key", "reference_date"]
    base = counted.withColumn("obs_rows", F.lit(0).cast("long"))
    return merge_upsert(base, owned, keys, {"file_count": 0, "obs_rows": 0})


def file_health(files: DataFrame, sources: DataFrame) -> DataFrame:
    return mapped_files(files, sources).groupBy("dataset_key").agg(F.max("ingested_at").alias("last_ingested_at"), F.count("*").alias("files_total"), F.count_if(F.col("status") == "skipped").alias("files_skipped"))


def run_health(runs: DataFrame) -> DataFrame:
    return runs.groupBy("dataset_key").agg(F.max("started_at").alias("last_run_at"), F.max(F.when(F.col("status").isin("ok", "no_change"), F.col("started_at"))).alias("last_ok_at"))


def _has(bits: Column, month: Column) -> Column:
    """Whether a bitmap of month indices has a month."""
    at = F.bitmap_bit_position(month)
    byte = F.conv(F.hex(F.substring(bits, (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1)) == 1


def month_sets(periods: DataFrame, datasets: DataFrame) -> DataFrame:
    """By public dataset: its loaded months and those with files alone as bitmaps of month indices (32,768 bits, so
    up to the year 2730), the first and the last loaded one, and what is known of each month as a map. One aggregation."""
    public = datasets.filter("is_public = 1").select("dataset_key")
    month = month_index(F.col("reference_date"))
    own = periods.join(public, "dataset_key").select("dataset_key", month.alias("m"), "obs_rows", F.col("file_count").alias("files"))
    by_month = own.groupBy("dataset_key", "m").agg(F.sum("obs_rows").alias("obs_rows"), F.sum("files").alias("files"))
    bits = lambda which: F.bitmap_construct_agg(F.when(which, F.bitmap_bit_position("m")))
    loaded, filed = F.col("obs_rows") > 0, (F.col("obs_rows") == 0) & (F.col("files") > 0)
    return by_month.groupBy("dataset_key").agg(
        bits(loaded).alias("loaded"), bits(filed).alias("filed"), F.min(F.when(loaded, F.col("m"))).alias("first"), F.max(F.when(loaded, F.col("m"))).alias("last"),
        F.min(F.when(filed, F.col("m"))).alias("first_filed"), F.max(F.when(filed, F.col("m"))).alias("last_filed"),
        F.map_from_entries(F.collect_list(F.struct("m", F.struct("obs_rows", "files")))).alias("known"), F.sum("obs_rows").alias("all_rows"),
    )


def _outside(sets: DataFrame) -> Column:
    """Months with files alone that lie outside the first and last loaded month."""
    span = F.sequence("first_filed", "last_filed")
    out = F.filter(span, lambda m: _has(F.col("filed"), m) & (F.col("first").isNull() | (m < F.col("first")) | (m > F.col("last"))))
    return F.when(F.col("first_filed").isNull(), F.array().cast("array<int>")).otherwise(out)


def _expected(sets: DataFrame) -> Column:
    inside = F.when(F.col("first").isNull(), F.array().cast("array<int>")).otherwise(F.sequence("first", "last"))
    return F.concat(inside, _outside(sets))


def _ym(m: Column) -> Column:
    """YYYY-MM of a month index."""
    month = (m - 1) % 12 + 1
    return F.concat(F.lpad(((m - month) / 12).cast("int").cast("string"), 4, "0"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


def coverage(periods: DataFrame, gaps: DataFrame, datasets: DataFrame) -> DataFrame:
    """A row per dataset and month: from its first to its last month with rows, each month is ok,
    not_loaded (files but no rows) or missing; months outside with files but no rows are not_loaded.

    States are bits of a dataset's month sets, so months are neither joined nor grouped again; only gaps are joined."""
    sets = month_sets(periods, datasets)
    months = sets.select("dataset_key", "loaded", "filed", "known", F.explode(_expected(sets)).alias("m"))
    found = F.try_element_at("known", F.col("m"))
    state = F.when(_has(F.col("loaded"), F.col("m")), "ok").when(_has(F.col("filed"), F.col("m")), "not_loaded").otherwise("missing")
    zero = F.lit(0).cast("long")
    known = months.select("dataset_key", _ym(F.col("m")).alias("ym"), F.coalesce(found["obs_rows"], zero).alias("obs_rows"), F.coalesce(found["files"], zero).alias("files"), state.alias("state"))
    noted = gaps.select("dataset_key", year_month(F.col("reference_date")).alias("ym"), F.col("kind").alias("gap_kind"), F.col("reason").alias("gap_reason"))
    return known.join(noted, ["dataset_key", "ym"], "left")


def coverage_summary(periods: DataFrame, datasets: DataFrame) -> DataFrame:
    """By public dataset with rows or files: its period, months expected and present, anomalies and rows; counted in the sets."""
    sets = month_sets(periods, datasets)
    expected = F.coalesce((F.col("last") - F.col("first") + 1).cast("long"), F.lit(0).cast("long")) + F.size(_outside(sets))
    present = F.bitmap_count("loaded")
    counted = sets.select("dataset_key", _ym(F.col("first")).alias("period_from"), _ym(F.col("last")).alias("period_to"), expected.alias("months_expected"), present.alias("months_present"), (expected - present).alias("anomalies"), F.col("all_rows").alias("obs_rows"))
    return counted.filter("months_expected > 0")


def coverage_grid(covered: DataFrame) -> DataFrame:
    """A row per dataset and year, a column per month with its state."""
    months = ["%02d" % m for m in range(1, 13)]
    grid = covered.withColumn("year", F.substring("ym", 1, 4)).withColumn("m", F.substring("ym", 6, 2)).groupBy("dataset_key", "year").pivot("m", months).agg(F.max("state"))
    return grid.select("dataset_key", "year", *(F.col(f"`{m}`").alias(f"m{m}") for m in months))


def catalog(datasets: DataFrame, periods: DataFrame, gaps: DataFrame, files: DataFrame, sources: DataFrame, runs: DataFrame) -> DataFrame:
    """A row per public dataset: coverage, file and run health. One plan; months stay in `coverage`."""
    summary = coverage_summary(periods, datasets)
    joined = datasets.filter("is_public = 1").join(summary, "dataset_key", "left").join(file_health(files, sources), "dataset_key", "left").join(run_health(runs), "dataset_key", "left")
    zero = ("months_expected", "months_present", "anomalies", "obs_rows", "files_total", "files_skipped")
    return joined.select(
        "dataset_key", "muni_code", "muni_name", "domain", "title", "granularity", "grain_label", "source_site", "source_url", "license", "attribution", "notes", "period_from", "period_to",
        *(F.coalesce(z, F.lit(0)).alias(z) for z in zero), "last_ingested_at", "last_run_at", "last_ok_at",
    ).orderBy("muni_code", "granularity")


def catalog_nested(entries: DataFrame, covered: DataFrame, gaps: DataFrame, history: DataFrame) -> DataFrame:
    """entries with lists of a dataset's months (each with its files), anomalies and gaps, all in order of
    time. A list is no longer than a dataset has months, gaps or files."""
    files = history.groupBy("dataset_key", "ym").agg(F.sort_array(F.collect_list(F.struct("sha256", "status", "offered"))).alias("files"))
    month = F.struct("ym", "state", "obs_rows", "gap_kind", F.coalesce("files", F.array().cast("array<struct<sha256: string, status: string, offered: int>>")).alias("files"))
    months = covered.drop("files").join(files, ["dataset_key", "ym"], "left").groupBy("dataset_key").agg(F.sort_array(F.collect_list(month)).alias("months"))
    noted = gaps.groupBy("dataset_key").agg(F.sort_array(F.collect_list(F.struct("reference_date", "kind", "reason"))).alias("gaps"))
    nested = entries.join(months, "dataset_key", "left").join(noted, "dataset_key", "left")
    return nested.withColumn("anomalous", F.filter("months", lambda m: m["state"] != "ok"))


def catalog_warnings(entries: DataFrame, issues: DataFrame) -> DataFrame:
    """One row: public datasets without licence, attribution or a run, and open issues."""
    without = [F.count_if(F.col(c).isNull()).alias(n) for c, n in (("license", "no_license"), ("attribution", "no_attribution"), ("last_run_at", "no_runs"))]
    counted = entries.agg(*without).withColumn("open_issues", F.lit(0).cast("long"))
    open_issues = issues.agg(F.count_if(F.col("resolved_at").isNull()).alias("open_issues"))
    names = counted.columns
    both = counted.unionByName(open_issues.select(*(F.lit(0).cast("long").alias(n) for n in names[:-1]), "open_issues"))
    return both.agg(*(F.sum(n).alias(n) for n in names))


def update_where(table: DataFrame, which: Column, changes: dict[str, Column]) -> DataFrame:
    """table with columns of the rows that `which` holds for changed; all changes see the old values."""
    return table.select(*(F.when(which, changes[c]).otherwise(F.col(c)).cast(table.schema[c].dataType).alias(c) if c in changes else F.col(c) for c in table.columns))


def with_note(old: Column, note: str, between: str = " / ") -> Column:
    """A note put behind what is noted already, if anything."""
    return F.concat(F.coalesce(F.concat(old, F.lit(between)), F.lit("")), F.lit(note))


def add_column(table: DataFrame, name: str, kind: str, default: object = None) -> DataFrame:
    """table with one more column, which has the default in all rows so far. A name it has is an error."""
    if name.lower() in map(str.lower, table.columns):
        raise ValueError(f"the table has a column {name!r}")
    return table.withColumn(name, F.lit(default).cast(kind))


def open_issues_by_severity(issues: DataFrame) -> DataFrame:
    return issues.filter(F.col("resolved_at").isNull()).select("issue_id", "dataset_key", "title", "severity", severity_rank(F.col("severity")).alias("severity_rank")).orderBy("severity_rank", "issue_id")


def mark_current(files: DataFrame) -> DataFrame:
    """is_current anew: of the files of a source, granularity and month, the last modified (then ingested) one."""
    w = Window.partitionBy("dataset", "granularity", "reference_date").orderBy(F.desc_nulls_last("source_last_modified"), F.desc_nulls_last("ingested_at"), "sha256")
    return files.withColumn("is_current", (F.row_number().over(w) == 1).cast("int"))


def file_history(files: DataFrame, sources: DataFrame, datasets: DataFrame) -> DataFrame:
    """Files of public datasets, whether current, whether they may be handed out, and the one offered for
    the month: one that may be, the current one if there is a choice."""
    rows = mapped_files(files, sources).join(datasets.filter("is_public = 1").select("dataset_key"), "dataset_key")
    rows = rows.withColumn("distributable", F.coalesce("distributable", F.lit(1))).withColumn("is_current", F.coalesce("is_current", F.lit(1)))
    w = Window.partitionBy("dataset_key", "reference_date").orderBy(F.desc("distributable"), F.desc("is_current"), "ingested_at", "sha256")
    offered = (F.row_number().over(w) == 1) & (F.col("distributable") == 1)
    return rows.select("dataset_key", year_month(F.col("reference_date")).alias("ym"), "sha256", "status", "distributable", "is_current", offered.cast("int").alias("offered"))


def default_export_window(months: DataFrame) -> DataFrame:
    """By dataset: the last twelve months of its coverage, but not from before it begins."""
    first = F.greatest("period_from", F.date_format(F.add_months(F.to_date(F.concat("period_to", F.lit("-01"))), -11), "yyyy-MM"))
    return months.filter("period_to IS NOT NULL").select("dataset_key", first.alias("export_from"), F.col("period_to").alias("export_to"))


def month_distance(start, end):
    """Months from start to end, both counted."""
    return month_index(end) - month_index(start) + 1
