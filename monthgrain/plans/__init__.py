"""The tables and views of one store, under one name each."""

from __future__ import annotations

import re
import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import catalog, season, views
from ..schema import BREAK_DATE
from ..sources import literals, panel, records
from .versions import Folder

__all__ = ["BREAK_DATE", "RecordStore", "Store", "Views"]


class Views(Mapping):
    """Relations by name, each built when it is first asked for."""

    def __init__(self, makers: dict[str, Callable[[Mapping], DataFrame]]):
        self._makers, self._made = makers, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name](self)
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


@dataclass
class Store:
    """Lazily built tables over the test tables in sf_dir. grain: the area is a nation or a region."""

    spark: SparkSession
    sf_dir: str
    grain: str = "nation"
    panel: panel.Panel | None = None
    _literals: dict[str, DataFrame] = field(default_factory=dict, repr=False)
    _written: dict[str, str] = field(default_factory=dict, repr=False)

    #: Stores that `of` keeps open at most, and those it has, by application and folder: stamp, panel, stores by grain.
    KEPT = 4
    _open = OrderedDict()

    def __post_init__(self) -> None:
        self.panel = self.panel or panel.Panel(self.spark, self.sf_dir)

    @classmethod
    def _panel(cls, spark: SparkSession, sf_dir: str) -> panel.Panel:
        return panel.Panel(spark, sf_dir)

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str, grain: str = "nation") -> Store:
        """One store per application, folder and grain, so that plans over its views are analysed once. It is
        made anew when the files in the folder have changed, and closed when KEPT others were used since."""
        key, stamp = (spark.sparkContext.applicationId, sf_dir), panel.stamp(spark, sf_dir)
        if key in cls._open and cls._open[key][0] != stamp:
            cls._close(key)
        if key not in cls._open:
            cls._open[key] = (stamp, cls._panel(spark, sf_dir), {})
        cls._open.move_to_end(key)
        while len(cls._open) > cls.KEPT:
            cls._close(next(iter(cls._open)))
        _, shared, stores = cls._open[key]
        if grain not in stores:
            stores[grain] = cls(spark, sf_dir, grain, shared)
        return stores[grain]

    @classmethod
    def _close(cls, key: tuple[str, str]) -> None:
        _, shared, stores = cls._open.pop(key)
        if key[0] == shared.spark.sparkContext.applicationId:  # else what Spark kept is gone with its application
            for store in stores.values():
                store.close()
            shared.close()

    @classmethod
    def close_all(cls) -> None:
        for key in list(cls._open):
            cls._close(key)

    def close(self) -> None:
        """Lets Spark drop what this store has kept; the panel's cells are dropped by their owner."""
        self.__dict__.pop("periods", None)
        if "area_months" in self.__dict__:
            self.__dict__.pop("area_months").unpersist()
        for path in self._written.values():
            Folder(self.spark, path).delete()
        self._written.clear()
        if Store._registered is self:
            Store._registered = None

    @cached_property
    def observations_5y(self) -> DataFrame:
        return panel.observations_5y(self.panel, self.grain)

    @cached_property
    def observations_1y(self) -> DataFrame:
        return panel.observations_1y(self.panel, self.grain)

    @cached_property
    def areas(self) -> DataFrame:
        return panel.areas(self.panel, self.grain)

    @cached_property
    def area_months(self) -> DataFrame:
        """Sums of the population by area and month, kept until `close`: what seasonality starts from."""
        return panel.area_months(self.panel, self.grain).persist()

    def literal(self, table: str) -> DataFrame:
        if table not in self._literals:
            self._literals[table] = literals.frame(self.spark, table)
        return self._literals[table]

    @cached_property
    def periods(self) -> DataFrame:
        """dataset_periods as `refresh_periods` makes it: a row per dataset and month, written once and read until `close`."""

        def write(path: str) -> None:
            made.write.parquet(path)

        made = catalog.periods_of(self.literal("source_files"), self.literal("dataset_sources"), self.literal("datasets"), panel.row_counts(self.panel, self.grain))
        return self.spark.read.schema(made.schema).parquet(self.once("periods", write))

    @cached_property
    def views(self) -> Views:
        return Views(views.makers(self))

    @cached_property
    def seasonal_views(self) -> Views:
        return Views(season.makers(self.views, BREAK_DATE))

    @staticmethod
    def _new_folder(spark: SparkSession, name: str) -> str:
        """A new folder in the one that the cluster shares. A cluster that names none is an error: a folder on
        the driver's machine would be of no use to the others."""
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None and not re.match(r"local(\[|$)", spark.sparkContext.master) and "spark.sql.warehouse.dir" not in dict(spark.sparkContext.getConf().getAll()):
            raise ValueError("set spark.checkpoint.dir (or spark.sql.warehouse.dir) to a folder that all machines see")
        return f"{(shared or spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def _folder(self, name: str) -> str:
        return self._new_folder(self.spark, name)

    def kept(self, name: str) -> DataFrame:
        """A seasonal view as written by `season.materialise` and read again; written when it is first asked for."""
        if name not in self._written:
            self._written[name] = self._folder("season")
            season.materialise({name: self.seasonal_views[name]}, self._written[name])
        return season.kept_view(self.spark, self._written[name], name, self.seasonal_views[name].schema)

    def rebuilt_periods(self) -> DataFrame:
        """dataset_periods as a table: all rows of the one before go, and the refreshed ones are written."""
        path = self._written.setdefault("dataset_periods", self._folder("dataset-periods"))
        self.periods.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(self.periods.schema).parquet(path)

    def once(self, name: str, write: Callable[[str], None]) -> str:
        """A folder that write has filled, the first time it is asked for; it goes with the store."""
        if name not in self._written:
            path = self._folder(name)
            write(path)
            self._written[name] = path
        return self._written[name]

    def register(self) -> None:
        """Every table and view as a temporary view, for SQL over them; nothing to do if they are already."""
        if Store._registered is self and Store._registered_in is self.spark:
            return
        for name, df in {"observations_5y": self.observations_5y, "observations_1y": self.observations_1y, "areas": self.areas, **self.views, **self.seasonal_views}.items():
            df.createOrReplaceTempView(name)
        for name in literals.ROWS:
            self.literal(name).createOrReplaceTempView(name)
        Store._registered, Store._registered_in = self, self.spark

    _registered = None
    _registered_in = None


class RecordStore(Store):
    """A Store whose catalog tables are drawn from the test tables rather than literal."""

    _open = OrderedDict()

    def literal(self, table: str) -> DataFrame:
        if table not in self._literals:
            self._literals[table] = records.frame(self.panel, table)
        return self._literals[table]
