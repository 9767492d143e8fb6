"""The monthly panel, aggregated from order lines.

An area is a nation, its municipality a region; a month is that of the order; the year of age is the
part's size, sex the line's status, and the value the quantity. Published total rows are planted next
to the leaf rows, as publishers do, for the views to keep out of sums.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("lineitem", "orders", "customer", "part", "nation", "region")

#: Rows of a dimension that may be sent to all tasks through the driver.
FEW_ROWS = 200_000
#: Partitions in which cells are kept: there are no more of them than nations x months x sizes x 2, however many lines.
CELL_PARTS = 8


def stamp(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the files behind the panel: another stamp means other rows."""
    conf, found = spark.sparkContext._jsc.hadoopConfiguration(), []
    for table in TABLES:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{table}.parquet")
        found += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in path.getFileSystem(conf).listStatus(path)]
    return tuple(sorted(found))


@dataclass
class Panel:
    """The tables aggregated to cells, of which all grains are made: at most nations x months x sizes x 2 rows
    of lines, and nations x months of orders. They are kept by Spark until `close`."""

    spark: SparkSession
    sf_dir: str

    _frames: dict[str, DataFrame] = field(default_factory=dict, repr=False)

    def read(self, table: str) -> DataFrame:
        """A table; its footers are read once."""
        if table not in self._frames:
            self._frames[table] = self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")
        return self._frames[table]

    def dimension(self, table: str, *columns: Column) -> DataFrame:
        """Columns of a table to be joined by its key. Spark judges by the size of its files, which says little of its rows;
        these are counted from the footers, and a table of more than FEW_ROWS is shuffled rather than broadcast."""
        rows = self.read(table).select(*columns)
        return rows if self.read(table).count() <= FEW_ROWS else rows.hint("merge")

    @cached_property
    def lines(self) -> DataFrame:
        """Quantity by nation, month, size and line status, in one pass over the lines."""
        orders = (
            self.read("orders").select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM-01").alias("reference_date"))
            .join(self.dimension("customer", F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey")), "o_custkey")
            .select("o_orderkey", "reference_date", "c_nationkey")
        )
        lines = self.read("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_quantity", "l_linestatus", "l_returnflag")
        sizes = self.dimension("part", F.col("p_partkey").alias("l_partkey"), F.col("p_size"))
        cells = (
            lines.join(sizes, "l_partkey").join(orders, "o_orderkey")
            .groupBy("c_nationkey", "reference_date", F.col("p_size").alias("age"), F.when(F.col("l_linestatus") == "F", "female").otherwise("male").alias("sex"))
            .agg(F.sum("l_quantity").alias("quantity"), F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0)).alias("returned"))
        )
        return cells.select("c_nationkey", "reference_date", "age", "sex", F.col("quantity").cast("long").alias("value"), F.col("returned").cast("long").alias("foreign_value")).repartition(CELL_PARTS).persist()

    @cached_property
    def orders(self) -> DataFrame:
        """Orders by nation and month: the households of the panel."""
        customers = self.dimension("customer", F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey"))
        orders = self.read("orders").select("o_custkey", F.date_format("o_orderdate", "yyyy-MM-01").alias("reference_date"))
        return orders.join(customers, "o_custkey").groupBy("c_nationkey", "reference_date").agg(F.count("*").alias("value")).repartition(CELL_PARTS).persist()

    def close(self) -> None:
        for name in ("lines", "orders"):
            if name in self.__dict__:
                self.__dict__.pop(name).unpersist()


def nations(panel: Panel, grain: str = "nation") -> DataFrame:
    """c_nationkey with its municipality, area and name; at region grain the area is the region too."""
    joined = panel.read("nation").join(panel.read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    area, name = (F.col("n_nationkey"), F.col("n_name")) if grain == "nation" else (F.col("r_regionkey"), F.col("r_name"))
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    return joined.select(F.col("n_nationkey").alias("c_nationkey"), pad(F.col("r_regionkey"), 6).alias("muni_code"), pad(area, 8).alias("key_code"), name.alias("area_name"))


def five_year_class(age: Column) -> Column:
    low = (F.floor(age / 5) * 5).cast("int")
    return F.when(age >= 50, "50+").otherwise(F.concat(low.cast("string"), F.lit("-"), (low + 4).cast("string")))


def _file_of(granularity: str) -> Column:
    return F.sha2(F.concat(F.col("reference_date"), F.lit(f":{granularity}")), 256)


def observations_5y(panel: Panel, grain: str = "nation") -> DataFrame:
    areas = nations(panel, grain)
    keys = ["muni_code", "key_code", "reference_date"]
    cells = panel.lines.join(areas, "c_nationkey")
    by = lambda measure, age, sex, value, rows=cells: (
        rows.groupBy(*keys, age.alias("age_class"), sex.alias("sex")).agg(F.sum(value).alias("value")).withColumn("measure", F.lit(measure))
    )
    total, households = F.lit("total"), panel.orders.join(areas, "c_nationkey")
    parts = [
        by("population", five_year_class(F.col("age")), F.col("sex"), "value"),
        by("population", total, total, "value"),
        by("foreign_population", total, F.col("sex"), "foreign_value"),
        by("foreign_population", total, total, "foreign_value"),
        by("households", total, total, "value", households),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*keys, "measure", "age_class", "sex", "value", _file_of("5y").alias("source_sha256"))


def observations_1y(panel: Panel, grain: str = "nation") -> DataFrame:
    cells = panel.lines.join(nations(panel, grain), "c_nationkey")
    keys = ["muni_code", "key_code", "reference_date"]
    leaves = cells.groupBy(*keys, F.col("age").cast("string").alias("age_class"), "sex").agg(F.sum("value").alias("value"))
    totals = cells.groupBy(*keys).agg(F.sum("value").alias("value")).select(*keys, F.lit("total").alias("age_class"), F.lit("total").alias("sex"), "value")
    return leaves.unionByName(totals).select(*keys, "age_class", "sex", "value", _file_of("1y").alias("source_sha256"))


def area_months(panel: Panel, grain: str = "nation") -> DataFrame:
    """Population by area and month: what the leaf rows of the five-year table add up to, from the cells in one aggregation."""
    cells = panel.lines.join(nations(panel, grain), "c_nationkey")
    return cells.groupBy("muni_code", "key_code", "area_name", "reference_date").agg(F.sum("value").alias("population"))


def row_counts(panel: Panel, grain: str = "nation") -> DataFrame:
    """muni_code, reference_date, granularity, n: how many rows the two observation tables have, without making them. Which age
    classes and sexes an area has in a month is a set of bits."""
    keys = ["muni_code", "key_code", "reference_date"]
    joined = panel.lines.join(nations(panel, grain), "c_nationkey")
    sex = F.when(F.col("sex") == "female", 1).otherwise(0)
    band = F.least(F.floor(F.col("age") / 5), F.lit(10)).cast("int")
    one = F.lit(1).cast("long")
    leaf = F.bit_or(F.call_function("shiftleft", one, band * 2 + sex))
    sexes = F.bit_or(F.call_function("shiftleft", one, sex))
    cells = joined.groupBy(*keys).agg(leaf.alias("leaves"), sexes.alias("sexes"), F.count_distinct("age", "sex").alias("ages"))
    # beside the leaves a total of the population, one row of foreign population a sex and a total; single years have a total
    of_lines = cells.select(*keys, (F.bit_count("leaves") + F.bit_count("sexes") + 2).cast("long").alias("n5"), (F.col("ages") + 1).alias("n1"))
    of_orders = panel.orders.join(nations(panel, grain), "c_nationkey").select(*keys).distinct().select(*keys, one.alias("n5"), F.lit(0).cast("long").alias("n1"))
    both = of_lines.unionByName(of_orders).groupBy("muni_code", "reference_date").agg(F.sum("n5").alias("n5"), F.sum("n1").alias("n1"))
    each = F.explode(F.array(*(F.struct(F.lit(g).alias("granularity"), F.col(n).alias("n")) for g, n in (("5y", "n5"), ("1y", "n1"))))).alias("each")
    return both.select("muni_code", "reference_date", each).select("muni_code", "reference_date", "each.*").filter("n > 0")


def areas(panel: Panel, grain: str = "nation") -> DataFrame:
    seen = panel.orders.join(nations(panel, grain), "c_nationkey")
    return seen.groupBy("key_code", "muni_code", "area_name").agg(F.min("reference_date").alias("first_seen"), F.max("reference_date").alias("last_seen"))
