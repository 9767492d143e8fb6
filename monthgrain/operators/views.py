"""The relations that queries start from. They leave published total rows out, so that a sum over a view
never counts anyone twice: total = sum over age classes (not total) and sexes (not total)."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import age_order

_BASE = ["muni_code", "key_code", "area_name", "reference_date"]


def _named(observations: DataFrame, areas: DataFrame) -> DataFrame:
    """Adds area_name. Areas are a small dimension; Spark broadcasts them while they stay under its limit."""
    return observations.join(areas.select("key_code", "area_name"), "key_code", "left")


def population_5y(observations: DataFrame, areas: DataFrame) -> DataFrame:
    rows = observations.filter("measure = 'population' AND age_class <> 'total' AND sex <> 'total'")
    return _named(rows, areas).select(*_BASE, "age_class", "sex", "value", "source_sha256")


def population_1y(observations: DataFrame, areas: DataFrame) -> DataFrame:
    """The single-year table holds population alone, and has no measure to filter by."""
    rows = observations.filter("age_class <> 'total' AND sex <> 'total'")
    return _named(rows, areas).select(*_BASE, "age_class", "sex", "value", "source_sha256")


def households_5y(observations: DataFrame, areas: DataFrame) -> DataFrame:
    return _named(observations.filter("measure = 'households'"), areas).select(*_BASE, "value", "source_sha256")


def foreign_population_5y(observations: DataFrame, areas: DataFrame) -> DataFrame:
    return _named(observations.filter("measure = 'foreign_population' AND sex <> 'total'"), areas).select(*_BASE, "sex", "value", "source_sha256")


def published_totals_5y(observations: DataFrame, areas: DataFrame) -> DataFrame:
    return _named(observations.filter("age_class = 'total' AND sex = 'total'"), areas).select(*_BASE, "measure", "value")


def summed(view: DataFrame, *by: str | Column, value: str = "value", alias: str = "population") -> DataFrame:
    return view.groupBy(*_BASE, *by).agg(F.sum(value).alias(alias))


def areas_with_alias(areas: DataFrame, aliases: DataFrame) -> DataFrame:
    """A row per alias of an area; one with null for an area without any."""
    return areas.join(aliases, "key_code", "left").select("key_code", "muni_code", "area_name", "first_seen", "last_seen", "alias_name")


def gaps_labelled(gaps: DataFrame, datasets: DataFrame) -> DataFrame:
    named = datasets.select("dataset_key", "muni_name", "grain_label")
    return gaps.join(named, "dataset_key", "left").select("dataset_key", "muni_name", "grain_label", "reference_date", "kind", "reason")


def makers(store) -> dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]]:
    """How each view is made of the store's tables, or of another view."""
    return {
        "v_population_5y": lambda own: population_5y(store.observations_5y, store.areas),
        "v_population_1y": lambda own: population_1y(store.observations_1y, store.areas),
        "v_households_5y": lambda own: households_5y(store.observations_5y, store.areas),
        "v_foreign_population_5y": lambda own: foreign_population_5y(store.observations_5y, store.areas),
        "v_published_totals_5y": lambda own: published_totals_5y(store.observations_5y, store.areas),
        "v_nl_population": lambda own: store.area_months.select(*_BASE, "population"),
        "v_nl_population_by_sex": lambda own: summed(own["v_population_5y"], "sex"),
        "v_nl_population_by_age": lambda own: summed(own["v_population_5y"], "age_class", age_order(F.col("age_class")).alias("age_order")),
        "v_nl_foreign_population": lambda own: summed(own["v_foreign_population_5y"], alias="foreign_population"),
        "v_nl_households": lambda own: summed(own["v_households_5y"], alias="households"),
        "v_nl_areas": lambda own: areas_with_alias(store.areas, store.literal("area_aliases")),
        "v_nl_gaps": lambda own: gaps_labelled(store.literal("dataset_gaps"), store.literal("datasets")),
    }
