"""Written tables with access paths: facts by order, observations by month, and sums kept at several grains.

* Lines and orders are bucketed and sorted by the order key. Lines carry the part's size and orders the customer's nation, which
  are looked up once, when the tables are written. So the join under the panel's aggregation moves no rows: the only
  shuffle is that of the cells which each task has added up.
* Observations are partitioned by month (VersionedTable): a query for a period reads its folders only, and a
  late month replaces its own.
* Of each view that is summed, sums at coarser grains are kept (`Routes`), each made from the smallest finer one. A query is answered
  from the smallest that has all columns it groups by or filters on.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import TABLES
from ..sources import panel
from . import Store
from .versions import Folder, VersionedTable


#: Bytes of the lines' files that a bucket is made for; a task sorts a bucket of lines, of some ten times as many bytes.
BUCKET_BYTES = 32 << 20


class BucketedPanel(panel.Panel):
    """A panel whose lines and orders are bucketed tables, written when they are first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, root: str, buckets: int | None = None):
        super().__init__(spark, sf_dir)
        size = sum(length for path, length, _ in panel.stamp(spark, sf_dir) if "lineitem" in path)
        self.root, self.buckets = root, buckets or max(8, -(-size // BUCKET_BYTES))
        self._tag = uuid.uuid4().hex[:12]
        self._tables: list[str] = []

    def _bucketed(self, name: str, rows: DataFrame, key: str) -> str:
        table = f"bucketed_{name}_{self._tag}"
        rows.repartition(self.buckets, key).write.bucketBy(self.buckets, key).sortBy(key).option("path", f"{self.root}/{name}").saveAsTable(table)
        self._tables.append(table)
        return table

    @cached_property
    def bucketed_lines(self) -> str:
        sizes = self.dimension("part", F.col("p_partkey").alias("l_partkey"), F.col("p_size").alias("age"))
        lines = self.read("lineitem").join(sizes, "l_partkey")
        returned = F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0)
        sex = F.when(F.col("l_linestatus") == "F", "female").otherwise("male")
        return self._bucketed("lines", lines.select(F.col("l_orderkey").alias("o_orderkey"), "age", sex.alias("sex"), "l_quantity", returned.alias("returned")), "o_orderkey")

    @cached_property
    def bucketed_orders(self) -> str:
        customers = self.dimension("customer", F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey"))
        orders = self.read("orders").join(customers, "o_custkey")
        return self._bucketed("orders", orders.select("o_orderkey", "c_nationkey", F.date_format("o_orderdate", "yyyy-MM-01").alias("reference_date")), "o_orderkey")

    def cells(self) -> DataFrame:
        """Quantities by nation, month, size and line status; no row of lines or orders is moved before they are added up."""
        joined = self.spark.table(self.bucketed_lines).hint("merge").join(self.spark.table(self.bucketed_orders), "o_orderkey")
        summed = joined.groupBy("c_nationkey", "reference_date", "age", "sex").agg(F.sum("l_quantity").alias("q"), F.sum("returned").alias("r"))
        return summed.select("c_nationkey", "reference_date", "age", "sex", F.col("q").cast("long").alias("value"), F.col("r").cast("long").alias("foreign_value"))

    @cached_property
    def lines(self) -> DataFrame:
        return self.cells().repartition(panel.CELL_PARTS).persist()

    @cached_property
    def orders(self) -> DataFrame:
        return self.spark.table(self.bucketed_orders).groupBy("c_nationkey", "reference_date").agg(F.count("*").alias("value")).repartition(panel.CELL_PARTS).persist()

    def close(self) -> None:
        super().close()
        for table in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self._tables.clear()


@dataclass(frozen=True)
class Grain:
    """A kept sum of a view: the columns it is grouped by, its name, its rows when it was first made, and what it is made from."""

    view: str
    columns: tuple[str, ...]
    name: str
    n_rows: int
    source: str

    def covers(self, view: str, columns: set[str]) -> bool:
        return self.view == view and columns <= set(self.columns)


_AREA = ("muni_code", "key_code", "area_name", "reference_date")
#: By view the grains that are kept beside the view itself, finer ones first.
GRAINS = {
    "v_population_5y": [_AREA + ("sex",), _AREA, ("muni_code", "reference_date", "age_class", "sex"), ("muni_code", "reference_date")],
    "v_population_1y": [_AREA, ("muni_code", "reference_date", "age_class", "sex"), ("muni_code", "reference_date")],
    "v_foreign_population_5y": [_AREA, ("muni_code", "reference_date")],
    "v_households_5y": [("muni_code", "reference_date")],
}


def grain_name(view: str, columns: tuple[str, ...]) -> str:
    return f"{view}_by_" + "_".join(c.removesuffix("_code").removesuffix("_date") for c in columns if c != "area_name")


def _summed(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return rows.groupBy(*columns).agg(F.sum("value").alias("value"), F.sum("n_rows").alias("n_rows"))


@dataclass
class Routes:
    """Which relation answers a query. Grains are VersionedTables, partitioned by month."""

    spark: SparkSession
    views: Mapping[str, DataFrame]
    root: str
    grains: list[Grain] = field(default_factory=list)
    frames: dict[str, DataFrame] = field(default_factory=dict)
    tables: dict[str, VersionedTable] = field(default_factory=dict)

    def build(self) -> Routes:
        for view, wanted in GRAINS.items():
            for columns in wanted:
                self._keep(view, columns)
        return self

    def refresh(self, months: Sequence[str]) -> None:
        """Makes the months of every grain anew, each grain from the one that it was made from; other months aren't read."""
        for grain in self.grains:
            table, source = self.tables[grain.name], self._frame(grain.source).filter(F.col("reference_date").isin(*months))
            table.replace(_summed(source, grain.columns), partitions=months)
            self.frames[grain.name] = table.read()

    def _keep(self, view: str, columns: tuple[str, ...]) -> None:
        name, source = grain_name(view, columns), self.smallest(view, set(columns))
        summed = _summed(self._frame(source), columns)
        table = VersionedTable(self.spark, f"{self.root}/{name}", summed.schema, "reference_date", columns)
        table.replace(summed)
        self.tables[name], self.frames[name] = table, table.read()
        self.grains.append(Grain(view, columns, name, self.frames[name].count(), source))

    def _frame(self, name: str) -> DataFrame:
        return self.frames[name] if name in self.frames else self.views[name].withColumn("n_rows", F.lit(1).cast("long"))

    def covering(self, view: str, columns: set[str]) -> list[Grain]:
        return sorted((g for g in self.grains if g.covers(view, columns)), key=lambda g: (g.n_rows, g.name))

    def smallest(self, view: str, columns: set[str]) -> str:
        """The name of the smallest kept grain that has the columns, or the view's own."""
        found = self.covering(view, columns)
        return found[0].name if found else view

    def register(self) -> None:
        for name, frame in self.frames.items():
            frame.createOrReplaceTempView(name)


class WrittenStore(Store):
    """A Store whose observations are tables partitioned by month, made from bucketed facts."""

    _open = OrderedDict()

    @classmethod
    def _panel(cls, spark: SparkSession, sf_dir: str) -> panel.Panel:
        return BucketedPanel(spark, sf_dir, cls._new_folder(spark, "facts"))

    def __post_init__(self) -> None:
        self.panel = self.panel or self._panel(self.spark, self.sf_dir)
        self._root = self._folder("observations")

    def table(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self._root}/{name}", TABLES[name], "reference_date", [c for c in TABLES[name].names if c not in ("value", "source_sha256")])

    def _table(self, name: str, make) -> DataFrame:
        table = self.table(name)
        if not table.versions():
            table.replace(make(self.panel, self.grain), note="first load")
        return table.read()

    def deliver(self, rows: DataFrame, name: str = "observations_5y", slices: Sequence[str] = ("muni_code", "reference_date")) -> list[str]:
        """Takes a late delivery: its rows stand for all that an observation table has of their slices. That table's months, and
        these months of every kept sum, are made anew; the months. Views are read anew after that."""
        getattr(self, name)
        months = sorted(r[0] for r in rows.select("reference_date").distinct().collect())  # a row a month
        self.table(name).replace(rows, slices, note="delivered")
        for made in (name, "views", "seasonal_views", "area_months"):
            self.__dict__.pop(made, None)
        if "routes" in self.__dict__:
            self.routes.views = self.views
            self.routes.refresh(months)
        if Store._registered is self:
            Store._registered = None
        return months

    @cached_property
    def observations_5y(self) -> DataFrame:
        return self._table("observations_5y", panel.observations_5y)

    @cached_property
    def observations_1y(self) -> DataFrame:
        return self._table("observations_1y", panel.observations_1y)

    @cached_property
    def areas(self) -> DataFrame:
        """Kept with the observations: a row an area."""
        path = f"{self._root}/areas"
        panel.areas(self.panel, self.grain).write.mode("overwrite").parquet(path)
        return self.spark.read.schema(TABLES["areas"]).parquet(path)

    @cached_property
    def area_months(self) -> DataFrame:
        return self.routes.frames[grain_name("v_population_5y", _AREA)].select(*_AREA, F.col("value").alias("population"))

    @cached_property
    def routes(self) -> Routes:
        return Routes(self.spark, self.views, f"{self._root}/grains").build()

    def register(self) -> None:
        super().register()
        self.routes.register()

    def close(self) -> None:
        super().close()
        Folder(self.spark, self._root).delete()
        if isinstance(self.panel, BucketedPanel):
            Folder(self.spark, self.panel.root).delete()
