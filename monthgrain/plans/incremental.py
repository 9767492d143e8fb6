"""Seasonality kept up to date: what a changed month bears on is made anew, and nothing else.

A month's trend takes in the months up to six away, so a changed month changes the ratios of its area's months up to
six away, which need the months up to twelve away. An area's index takes in all its ratios. So a change
reads the area's months near it and the area's ratios, and makes the index of the areas that changed. Values,
ratios and index are three VersionedTables, partitioned by a hash of the area, of which only partitions with changed
areas are read and written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import season
from .versions import VersionedTable

#: Months on each side of a month that its trend takes in.
REACH = 6

_KEYS = "bucket int, key_code string, area_name string"


class SeasonState:
    """Monthly values of areas with their ratios and seasonal index, in root. An area keeps its name."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 32, min_trend: float = 0.0):
        self.spark, self.buckets, self.min_trend = spark, buckets, min_trend

        def table(name: str, columns: str, *keys: str) -> VersionedTable:
            return VersionedTable(spark, f"{root}/{name}", StructType.fromDDL(f"{_KEYS}, {columns}"), "bucket", ["key_code", *keys])

        self.values = table("values", "reference_date string, month_index int, month string, value long", "month_index")
        self.ratios = table("ratios", "month_index int, month string, ratio double", "month_index")
        self.index = table("index", "month string, seasonal_index double, pct_vs_trend double, n_above long, n_years long", "month")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("key_code"), F.lit(self.buckets)).cast("int").alias("bucket")

    def load(self, panel: DataFrame) -> None:
        """All rows of a month panel (season.month_panel) for the first time."""
        self.values.replace(panel.select(self._bucket(), "*"))
        self.ratios.replace(season.ratios(self.values.read(), ("bucket", *season.AREA), self.min_trend))
        self.index.replace(season.index_of(self.ratios.read(), ("bucket", *season.AREA)))

    def near(self, changes: DataFrame, reach: int) -> DataFrame:
        """bucket, key_code and month_index of all months up to so many away from changed ones."""
        around = F.explode(F.sequence(F.col("month_index") - reach, F.col("month_index") + reach)).alias("month_index")
        return changes.select("bucket", "key_code", around).distinct()

    def needed(self, changes: DataFrame) -> DataFrame:
        """The values that ratios near changed months are made of: at most 25 months for each of them."""
        return self.values.read().join(self.near(changes, 2 * REACH), ["bucket", "key_code", "month_index"], "left_semi")

    def update(self, panel: DataFrame) -> list[int]:
        """Takes rows of a month panel, new ones or other values; the partitions that were touched."""
        changes = panel.select(self._bucket(), "*")
        touched = sorted(r.bucket for r in changes.select("bucket").distinct().collect())  # at most `buckets`
        if not touched:
            return []
        self.values.merge(changes)
        near = self.near(changes, REACH)
        here = F.col("bucket").isin(touched)
        month = ["bucket", "key_code", "month_index"]
        made = season.ratios(self.needed(changes).filter(here), ("bucket", *season.AREA), self.min_trend).join(near, month, "left_semi")
        kept = self.ratios.read().filter(here).join(near, month, "left_anti")
        columns = self.ratios.schema.names
        self.ratios.replace(kept.select(*columns).unionByName(made.select(*columns)), partitions=touched)
        areas = changes.select("bucket", "key_code").distinct()
        index = season.index_of(self.ratios.read().filter(here).join(areas, ["bucket", "key_code"], "left_semi"), ("bucket", *season.AREA))
        others = self.index.read().filter(here).join(areas, ["bucket", "key_code"], "left_anti")
        self.index.replace(others.select(*self.index.schema.names).unionByName(index.select(*self.index.schema.names)), partitions=touched)
        return touched
