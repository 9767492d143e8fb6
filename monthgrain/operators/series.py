"""Preparation of trend rows for display: dense alignment, rebasing, end points, placing of notes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import block_of, growth_rate, town_of


def _dates(rows: DataFrame) -> Column:
    """All dates of rows in order, as one value: as many as there are months, whatever the rows behind them."""
    return rows.agg(F.sort_array(F.collect_set("reference_date"))).scalar()


def aligned(split: DataFrame) -> DataFrame:
    """A row for each date and area of a split trend, null where the area has none: every area is given all
    dates, and what it has is matched to them."""
    known = F.map_from_entries(F.collect_list(F.struct("reference_date", "value")))
    areas = split.groupBy("key_code").agg(F.max("area_name").alias("area_name"), known.alias("known"))
    dense = areas.select("key_code", "area_name", "known", F.explode(_dates(split)).alias("reference_date"))
    return dense.select("reference_date", "key_code", "area_name", F.try_element_at("known", F.col("reference_date")).alias("value"))


def rebased(rows: DataFrame) -> DataFrame:
    """Adds index_value: the area's first value is 100; null if that is 0 or there is none."""
    w = Window.partitionBy("key_code").orderBy("reference_date").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    base = F.first("value", ignorenulls=True).over(w)
    return rows.withColumn("index_value", F.round(F.try_divide(F.col("value").cast("double"), base.cast("double")) * 100, 4))


def endpoints(rows: DataFrame) -> DataFrame:
    """By area: first and last value, their difference and rate (0 if the first is 0), and months."""
    at = lambda f: f(F.col("value"), F.col("reference_date"))
    known = rows.filter("value IS NOT NULL").groupBy("key_code").agg(at(F.min_by).alias("first_value"), at(F.max_by).alias("last_value"), F.count("*").alias("n_months"))
    rate = F.round(F.coalesce(growth_rate(F.col("first_value"), F.col("last_value")), F.lit(0.0)), 4)
    return known.select("key_code", "first_value", "last_value", (F.col("last_value") - F.col("first_value")).alias("diff"), rate.alias("rate"), "n_months")


def value_range(rows: DataFrame, pad: float = 0.05) -> DataFrame:
    """By area: least and greatest value, widened by a share of their distance (or 1 if there is none)."""
    lo, hi = F.min("value"), F.max("value")
    room = F.when(hi > lo, (hi - lo) * pad).otherwise(1.0)
    return rows.groupBy("key_code").agg(F.round(lo - room, 4).alias("low"), F.round(hi + room, 4).alias("high"))


def global_range(rows: DataFrame, pad: float = 0.12) -> DataFrame:
    """One row: the range of all areas together, widened by a share of it (or 10 if there is none)."""
    lo, hi = F.min("value"), F.max("value")
    room = F.when(hi > lo, (hi - lo) * pad).otherwise(10.0)
    return rows.agg(F.round(lo - room, 4).alias("low"), F.round(hi + room, 4).alias("high"))


def greatest_distance(rows: DataFrame, column: str, *keys: str) -> DataFrame:
    """By key the greatest distance of a column from 0, and 0 where it has no value."""
    return rows.groupBy(*keys).agg(F.coalesce(F.max(F.abs(F.col(column))), F.lit(0)).alias(f"max_abs_{column}"))


def towns(rows: DataFrame) -> DataFrame:
    """By town its areas, in order of their block number, and how many they are."""
    named = rows.select("key_code", "area_name").distinct().select(town_of(F.col("area_name")).alias("town"), block_of(F.col("area_name")).alias("block"), "key_code", "area_name")
    listed = F.sort_array(F.collect_list(F.struct("block", "key_code", "area_name")))
    return named.groupBy("town").agg(F.transform(listed, lambda a: a["area_name"]).alias("areas"), F.count("*").alias("n_areas"))


def as_of(notes: DataFrame, dates: DataFrame, time: str, by: tuple[str, ...] = (), stretch: Column | None = None) -> DataFrame:
    """notes with before and after: of the times that dates has for the same keys, the nearest at or before a note's and the
    nearest at or after it; null where there is none. A note without a time has neither.

    Notes and times are put in one order and read once in each direction, so the work grows with both, not with their product.
    stretch (by default the year of the time) parts the order, so that neither a key with most of the rows nor
    having no keys at all puts it in one task; what a stretch gets from those before and after it is one time
    each, carried over a table with a row a stretch."""
    own, of = [F.col(k).alias(f"_by{i}") for i, k in enumerate(by)], [f"_by{i}" for i in range(len(by))]
    part = F.substring(F.col("_at").cast("string"), 1, 4) if stretch is None else stretch
    kind = dates.schema[time].dataType
    axis = dates.select(*own, F.col(time).alias("_at")).filter("_at IS NOT NULL").distinct().withColumn("_part", part)
    told = notes.select(*own, F.col(time).cast(kind).alias("_at"), F.struct(*(F.col(f"`{c}`") for c in notes.columns)).alias("_note")).withColumn("_part", part)
    ends = axis.groupBy(*of, "_part").agg(F.min("_at").alias("lo"), F.max("_at").alias("hi"))
    noted = told.select(*of, "_part").distinct().withColumns({"lo": F.lit(None).cast(kind), "hi": F.lit(None).cast(kind)})
    stretches = ends.unionByName(noted).groupBy(*of, "_part").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    earlier = Window.partitionBy(*of).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*of).orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1)
    carried = stretches.select(*of, "_part", F.max("hi").over(earlier).alias("_before"), F.min("lo").over(later).alias("_after"))
    both = axis.withColumn("_known", F.col("_at")).unionByName(told.withColumn("_known", F.lit(None).cast(kind)), allowMissingColumns=True)
    up = Window.partitionBy(*of, "_part").orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy(*of, "_part").orderBy(F.desc("_at")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    near = both.withColumn("_up", F.max("_known").over(up)).withColumn("_down", F.min("_known").over(down)).filter("_note IS NOT NULL")
    same = F.lit(True)
    for k in [*of, "_part"]:
        same = same & near[k].eqNullSafe(carried[k])
    joined = near.join(carried, same, "left")
    known = F.col("_at").isNotNull()
    return joined.select("_note.*", F.when(known, F.coalesce("_up", "_before")).alias("before"), F.when(known, F.coalesce("_down", "_after")).alias("after"))


def placed_gaps(gaps: DataFrame, dates: DataFrame) -> DataFrame:
    """Where notes go on an axis of dates: on their own month if it has data, else between its neighbours;
    notes before the first month are left out. before and after are the neighbouring dates."""
    placed = as_of(gaps.select("reference_date", "kind"), dates.select("reference_date"), "reference_date")
    out = placed.filter("before IS NOT NULL").select(F.col("reference_date").alias("gap_date"), "kind", F.col("before").alias("before_date"), F.col("after").alias("after_date"))
    return out.withColumn("on_month", F.col("before_date") == F.col("gap_date"))


def ranking_summary(ranked: DataFrame) -> DataFrame:
    """Areas, how many grew, and how many did not (no change counts there)."""
    return ranked.agg(F.count("*").alias("n_areas"), F.count_if(F.col("diff") > 0).alias("n_up"), (F.count("*") - F.count_if(F.col("diff") > 0)).alias("n_down"))
