"""Facts drawn from seasonal rows, the text made of them, and the check of that text's numbers."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import all_years_alike, consistency, numbers_in
from ..schema import BREAK_DATE, Measure
from . import families, season


def strength_facts(strength: DataFrame, top: int = 20) -> DataFrame:
    """One row: the areas of the greatest and second greatest amplitude among the top, and how many are listed."""
    listed = strength.orderBy(F.desc("amplitude_pct"), "key_code").limit(top)
    place = F.row_number().over(Window.orderBy(F.desc("amplitude_pct"), "key_code"))  # of `top` rows at most
    at = lambda n, c: F.max(F.when(F.col("place") == n, F.col(c)))
    return listed.withColumn("place", place).agg(
        at(1, "area_name").alias("top_area"), at(1, "amplitude_pct").alias("top_pct"), at(2, "area_name").alias("second_area"), at(2, "amplitude_pct").alias("second_pct"), F.count("*").alias("n_listed")
    )


def profile_facts(profile: DataFrame, *keys: str) -> DataFrame:
    """By key: highest and lowest month with their percentages, amplitude, and the months that were on one side in all years."""
    month = F.col("month").cast("int")
    high, low = F.max(F.struct("pct_vs_trend", (-month).alias("m"))), F.min(F.struct(F.col("pct_vs_trend"), (-month).alias("m")))
    firm = F.sort_array(F.collect_list(F.when(all_years_alike(F.col("n_above"), F.col("n_years")), month)))
    out = profile.groupBy(*keys).agg(high.alias("h"), low.alias("l"), firm.alias("firm_months"))
    return out.select(*keys, (-F.col("h.m")).alias("high_month"), F.col("h.pct_vs_trend").alias("high_pct"), (-F.col("l.m")).alias("low_month"), F.col("l.pct_vs_trend").alias("low_pct"), F.round(F.col("h.pct_vs_trend") - F.col("l.pct_vs_trend"), 2).alias("amplitude_pct"), F.array_join(F.transform("firm_months", lambda m: m.cast("string")), ",").alias("firm_months"))


def age_facts(rows: DataFrame, *keys: str) -> DataFrame:
    """By key: the class that fell most, classes that moved by 5 % or more, how many by under 1 %, and those on one side in all years."""
    pct, order = F.col("pct_vs_trend"), F.col("age_order")
    worst = F.min(F.struct(pct, order, F.col("age_class")))

    def listed(which: Column) -> Column:
        return F.array_join(F.transform(F.sort_array(F.collect_list(F.when(which, F.struct(order, F.col("age_class"))))), lambda x: x["age_class"]), ",")

    return rows.groupBy(*keys).agg(
        worst["age_class"].alias("worst_class"), worst["pct_vs_trend"].alias("worst_pct"), listed(F.abs(pct) >= 5).alias("big_classes"),
        F.count_if(F.abs(pct) < 1).alias("n_flat"), F.count("*").alias("n_classes"), listed(all_years_alike(F.col("n_above"), F.col("n_years"))).alias("firm_classes"),
    )


def with_consistency(rows: DataFrame) -> DataFrame:
    return rows.withColumn("consistency", consistency(F.col("n_above"), F.col("n_years")))


def facts_json(facts: DataFrame) -> DataFrame:
    return facts.select(F.to_json(F.struct(*facts.columns)).alias("facts"))


def stated(measure: Measure, mode: str, since: str = BREAK_DATE) -> list[str]:
    """What a query's own terms leave open, as `name: value`: its months, its measure, and what ages are of."""
    lines = [f"months: {since[:7]} and later, each with all {season.FULL_WINDOW} months around it", f"measure: {measure.unit} by area of registration"]
    return lines + ([f"age classes: of {measure.key}; other measures have none"] if mode == "age" else [])


def caveats(gaps: DataFrame, issues: DataFrame, fixed: Sequence[str] = (), since: str = BREAK_DATE) -> DataFrame:
    """One row with the list of caveats: those given, then months without data since the break and open issues, in order."""
    missing = gaps.filter((F.col("kind") != "series_break") & (F.col("reference_date") >= since))
    gap = F.concat(F.lit("gap "), F.substring("reference_date", 1, 7), F.lit(" ("), "kind", F.lit("): "), "reason")
    issue = F.concat(F.lit("open issue, "), "severity", F.lit(": "), "title")
    lines = missing.select(gap.alias("c")).unionByName(issues.filter(F.col("resolved_at").isNull()).select(issue.alias("c")))
    return lines.agg(F.concat(F.array(*(F.lit(x) for x in fixed)).cast("array<string>"), F.sort_array(F.collect_list("c"))).alias("caveats"))


def listed(rows: DataFrame, mode: str) -> DataFrame:
    """One row: the rows of a seasonal query as a list of structs, in the order in which they are shown."""
    pct, label = F.col("pct_vs_trend"), consistency(F.col("n_above"), F.col("n_years"))
    if mode == "strength":
        rank = F.row_number().over(Window.orderBy(F.desc("amplitude_pct"), "key_code"))  # of `top` rows at most
        each = rows.select(F.struct(rank.alias("place"), "area_name", "amplitude_pct", "peak_month", "peak_pct", "trough_month", "trough_pct").alias("x"))
    elif mode == "profile":
        each = rows.select(F.struct(F.col("month").cast("int").alias("month"), pct, "n_above", "n_years", label.alias("consistency")).alias("x"))
    else:
        each = rows.select(F.struct("age_order", "age_class", pct, "n_above", "n_years", label.alias("consistency")).alias("x"))
    return each.agg(F.sort_array(F.collect_list("x")).alias("rows"))


def insight_facts(spark: SparkSession, dataset: str, mode: str = "strength", key: str | None = None, month: str = "09") -> DataFrame:
    """One row with all that a text on a seasonal query may say: what it is about, the listed rows, what is
    derived from them, and the caveats. No row where the query has none."""
    result = families.seasonality(spark, dataset, mode, key, month)
    issues = spark.table("known_issues").filter(F.col("dataset_key") == dataset)
    area = spark.table("areas").filter(F.col("key_code") == key).agg(F.max("area_name")).scalar() if mode != "strength" else F.lit("all areas")
    name = spark.table("datasets").filter(F.col("dataset_key") == dataset).agg(F.max("muni_name")).scalar()
    derived = {"strength": strength_facts, "profile": profile_facts, "age": age_facts}[mode](result.df)
    scope = F.concat_ws(" ", name, F.coalesce(area, F.lit(key)))
    told = caveats(spark.table("dataset_gaps").filter(F.col("dataset_key") == dataset), issues, stated(result.extra["measure"], mode))
    out = listed(result.df, mode).select(F.lit(mode).alias("mode"), scope.alias("scope"), F.lit(month if mode == "age" else None).cast("string").alias("month"), "rows", derived.select(F.struct("*")).scalar().alias("derived"), told.scalar().alias("caveats"))
    return out.filter(F.size("rows") > 0)


def bad_numbers(text: Column, facts: Column, caveats: Column | None = None) -> Column:
    """Numbers of text that the facts (text or JSON, keys too) and the caveats (a list of texts) don't bear
    out: neither given there, nor a rounding of one given to a whole number or one decimal, nor from 0 to 24."""
    told = facts if caveats is None else F.concat_ws("\n", facts, caveats)
    allowed = F.concat(numbers_in(told), F.sequence(F.lit(0), F.lit(24)).cast("array<double>"))

    def borne_out(n: Column) -> Column:
        near = lambda a: F.abs(n - a) < 0.005
        return F.exists(allowed, lambda a: near(a) | (n == F.floor(a + 0.5)) | near(F.round(a, 1)))

    return F.array_distinct(F.filter(numbers_in(text), lambda n: ~borne_out(n)))


def verify_numbers(texts: DataFrame, facts: Column, caveats: Column | None = None) -> DataFrame:
    """texts (with a column text) and bad, ok."""
    bad = texts.withColumn("bad", bad_numbers(F.col("text"), facts, caveats))
    return bad.withColumn("ok", F.size("bad") == 0)


def insight(facts: DataFrame, writer: Callable[[str, list[str]], str], tries: int = 2) -> dict:
    """A text of one row of facts (with its caveats, if it has any) by writer(facts, numbers that were wrong
    before), checked; rejected if its numbers are still wrong after `tries`. writer is any callable, such as
    a language model; without facts it isn't asked."""
    row = facts_json(facts).head()
    if row is None:
        return {"facts": None, "text": None, "ok": False, "bad": []}
    wrong: list[str] = []
    for _ in range(tries):
        text = writer(row.facts, wrong)
        frame = facts.sparkSession.createDataFrame([(text,)], "text string")
        checked = verify_numbers(frame, F.lit(row.facts)).head()
        if checked.ok:
            return {"facts": row.facts, "text": text, "ok": True, "bad": []}
        wrong = [f"{x:g}" for x in checked.bad]
    return {"facts": row.facts, "text": None, "ok": False, "bad": wrong}


def area_facts(profile: DataFrame, told: DataFrame, *keys: str) -> DataFrame:
    """A row a key with all that a text on it may say: its months in order, what follows from them, and the caveats (a
    row with a list, for all)."""
    label = consistency(F.col("n_above"), F.col("n_years"))
    month = F.struct(F.col("month").cast("int").alias("month"), "pct_vs_trend", "n_above", "n_years", label.alias("consistency"))
    rows = profile.groupBy(*keys).agg(F.sort_array(F.collect_list(month)).alias("rows"))  # twelve at most
    derived = profile_facts(profile, *keys)
    return derived.join(rows, list(keys)).withColumn("caveats", told.scalar())


def insights(facts: DataFrame, writer: Callable[[str, list[str]], str], tries: int = 2) -> DataFrame:
    """facts with told (their JSON), text, ok, bad and tries: for each row a text by writer(told, numbers that were wrong
    before). A text is kept if its numbers are borne out, and else written again, `tries` times in all; then it's null.

    writer runs in tasks, on a batch of rows at a time; each pass works on the rows that the one before it rejected. What a pass
    has written is checkpointed, since a text model may write something else if it is asked again."""
    spark = facts.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch")

    @F.pandas_udf("string")
    def written(told: pd.Series, wrong: pd.Series) -> pd.Series:
        return pd.Series([writer(t, [f"{x:g}" for x in w]) for t, w in zip(told, wrong, strict=True)], dtype=object)

    columns = facts.columns
    left = facts.withColumn("told", F.to_json(F.struct(*columns))).withColumn("bad", F.array().cast("array<double>"))
    done: list[DataFrame] = []
    for n in range(1, tries + 1):
        texts = left.withColumn("text", written("told", "bad"))
        checked = texts.withColumn("bad", bad_numbers(F.col("text"), F.col("told"))).withColumn("tries", F.lit(n)).checkpoint(eager=True)
        ok = F.size("bad") == 0
        done.append(checked.filter(ok))
        left = checked.filter(~ok).drop("text", "tries")
    done.append(left.withColumns({"text": F.lit(None).cast("string"), "tries": F.lit(tries)}))
    out = reduce(DataFrame.unionByName, done)
    return out.select(*columns, "told", "text", F.col("text").isNotNull().alias("ok"), "bad", "tries")
