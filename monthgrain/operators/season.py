"""Seasonal index by ratio to a centred 2x12 moving average.

The frames range over a month index, not over rows: where a month is missing, the window has fewer
months and fails the full-window gate, rather than reaching further into the past. All three frames
share one partitioning and order, so Spark shuffles and sorts once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import month_index

UNKNOWN_AGE = "unknown"
MIN_AGE_TREND = 20
#: Months that a trend takes in: six on each side and its own.
FULL_WINDOW = 13


def month_panel(view: DataFrame, value: str, since: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """key_code, area_name, keys, month_index, month and value of each month since a date."""
    rows = view.filter(F.col("reference_date") >= since)
    return rows.select("key_code", "area_name", *keys, "reference_date", month_index(F.col("reference_date")).alias("month_index"), F.substring("reference_date", 6, 2).alias("month"), F.col(value).alias("value"))


def ratios(panel: DataFrame, keys: tuple[str, ...], min_trend: float = 0.0, strict: bool = True) -> DataFrame:
    """Adds trend, win_n and ratio; only months with a full window and a trend over (or from) min_trend."""
    w = Window.partitionBy(*keys).orderBy("month_index")
    trend = (F.avg("value").over(w.rangeBetween(-6, 5)) + F.avg("value").over(w.rangeBetween(-5, 6))) / 2.0
    rows = panel.withColumn("trend", trend).withColumn("win_n", F.count("*").over(w.rangeBetween(-6, 6)))
    enough = F.col("trend") > min_trend if strict else F.col("trend") >= min_trend
    return rows.filter((F.col("win_n") == FULL_WINDOW) & enough).withColumn("ratio", F.col("value") / F.col("trend"))


def raw_index(ratio_rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """By key and month: mean ratio, years, and years above trend."""
    return ratio_rows.groupBy(*keys, "month").agg(F.avg("ratio").alias("raw_index"), F.count("*").alias("n_years"), F.count_if(F.col("ratio") > 1.0).alias("n_above"))


def seasonal_index(panel: DataFrame, keys: tuple[str, ...] = ("key_code", "area_name"), min_trend: float = 0.0, strict: bool = True) -> DataFrame:
    """The index, normalised to a mean of 1 over each key's months."""
    return index_of(ratios(panel, keys, min_trend, strict), keys)


def index_of(ratio_rows: DataFrame, keys: tuple[str, ...] = ("key_code", "area_name")) -> DataFrame:
    """The index of ratios that are known."""
    raw = raw_index(ratio_rows, keys)
    mean = F.avg("raw_index").over(Window.partitionBy(*keys))
    return raw.select(*keys, "month", F.round(F.col("raw_index") / mean, 5).alias("seasonal_index"), F.round((F.col("raw_index") / mean - 1) * 100, 2).alias("pct_vs_trend"), "n_above", "n_years")


def strength(index: DataFrame, keys: tuple[str, ...] = ("key_code", "area_name")) -> DataFrame:
    """Peak, trough and amplitude of each key's rounded percentages, in one aggregation. Of equal months
    the earliest is meant."""
    early = -F.col("month").cast("int")
    peak, trough = F.max(F.struct("pct_vs_trend", early.alias("early"))), F.min(F.struct(F.col("pct_vs_trend"), F.col("month").cast("int").alias("late")))
    both = index.groupBy(*keys).agg(peak.alias("p"), trough.alias("t"))
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return both.select(
        *keys, F.round(F.col("p.pct_vs_trend") - F.col("t.pct_vs_trend"), 2).alias("amplitude_pct"),
        two(-F.col("p.early")).alias("peak_month"), F.col("p.pct_vs_trend").alias("peak_pct"),
        two(F.col("t.late")).alias("trough_month"), F.col("t.pct_vs_trend").alias("trough_pct"),
    )


AREA = ("key_code", "area_name")
AREA_AGE = ("key_code", "area_name", "age_class", "age_order")


def population_index(views: Mapping[str, DataFrame], since: str) -> DataFrame:
    return seasonal_index(month_panel(views["v_nl_population"], "population", since))


def household_index(views: Mapping[str, DataFrame], since: str) -> DataFrame:
    """Households have one row an area and month: nothing to sum before."""
    return seasonal_index(month_panel(views["v_households_5y"], "value", since))


def age_index(views: Mapping[str, DataFrame], since: str, min_trend: float = MIN_AGE_TREND) -> DataFrame:
    known = views["v_nl_population_by_age"].filter(F.col("age_class") != UNKNOWN_AGE)
    return seasonal_index(month_panel(known, "population", since, ("age_class", "age_order")), AREA_AGE, min_trend, strict=False)


def makers(views: Mapping[str, DataFrame], since: str) -> dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]]:
    """How each seasonal view is made of the views, or of another seasonal one."""
    return {
        "v_nl_seasonality": lambda own: population_index(views, since),
        "v_nl_seasonality_strength": lambda own: strength(own["v_nl_seasonality"]),
        "v_nl_seasonality_age": lambda own: age_index(views, since),
        "v_nl_seasonality_hh": lambda own: household_index(views, since),
        "v_nl_seasonality_hh_strength": lambda own: strength(own["v_nl_seasonality_hh"]),
    }


#: Columns by which each kept view is mostly asked for, where there is one: its files are dealt out and sorted by it,
#: so that a query for an area or month reads few of them.
ACCESS = {"v_nl_seasonality": "key_code", "v_nl_seasonality_hh": "key_code", "v_nl_seasonality_age": "month"}


def materialise(views: Mapping[str, DataFrame], path: str) -> None:
    """Writes the seasonal views anew as Parquet, to be read many times: partitioned by month where queries ask
    for a month, else sorted by area."""
    for name, df in views.items():
        by = ACCESS.get(name)
        writer = df.write if by != "month" else df.repartition("month").write.partitionBy("month")
        if by == "key_code":
            writer = df.repartition(by).sortWithinPartitions(by).write
        writer.mode("overwrite").parquet(f"{path}/{name}")


def kept_view(spark: SparkSession, path: str, name: str, schema: StructType) -> DataFrame:
    """A view that `materialise` has written, with the columns it had; empty ones have no files."""
    return spark.read.schema(schema).parquet(f"{path}/{name}").select(*schema.names)
