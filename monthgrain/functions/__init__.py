"""Column expressions that the operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_month(date: Column) -> Column:
    return F.substring(date, 1, 7)


def month_index(date: Column) -> Column:
    """year * 12 + month of a YYYY-MM-DD string: consecutive months differ by one."""
    return (F.substring(date, 1, 4).try_cast("int") * 12 + F.substring(date, 6, 2).try_cast("int")).cast("int")


def age_order(age_class: Column) -> Column:
    """Sort key of an age class: its first year; 999 for unknown, and for what can't be read."""
    first = F.regexp_extract(age_class, r"^(\d+)", 1).try_cast("int")
    return F.when(age_class == "unknown", 999).otherwise(F.coalesce(first, F.lit(999))).cast("int")


def display_age_order(age_class: Column) -> Column:
    """Sort key for charts: unknown last, what can't be read just before it."""
    first = F.regexp_extract(age_class, r"^(\d+)", 1).try_cast("int")
    return F.when(age_class == "unknown", 9999).otherwise(F.coalesce(first, F.lit(9998))).cast("int")


def growth_rate(start: Column, end: Column) -> Column:
    """Percent; null if there is nothing to start from."""
    return F.try_divide((end - start).cast("double"), start.cast("double")) * 100


def consistency(above: Column, years: Column) -> Column:
    """How alike the years are, from the share of them above trend."""
    share = F.try_divide(above.cast("double"), years.cast("double"))
    return (
        F.when(years.isNull() | (years == 0), F.lit(None).cast("string"))
        .when(share >= 0.9, "above every year")
        .when(share <= 0.1, "below every year")
        .when(share >= 0.75, "above most years")
        .when(share <= 0.25, "below most years")
        .otherwise("differs by year")
    )


def all_years_alike(above: Column, years: Column) -> Column:
    return (above == 0) | (above == years)


def severity_rank(severity: Column) -> Column:
    return F.when(severity == "high", 0).when(severity == "medium", 1).otherwise(2)


def town_of(area_name: Column) -> Column:
    """The town of an area named town, number, block sign; the whole name if it isn't so named."""
    town = F.regexp_extract(area_name, r"^(.*?)(\d+)丁目$", 1)
    return F.when(town == "", area_name).otherwise(town)


def block_of(area_name: Column) -> Column:
    """The block number of an area named so; 0 if it isn't."""
    return F.coalesce(F.regexp_extract(area_name, r"(\d+)丁目$", 1).try_cast("int"), F.lit(0))


def first_object(text: Column, kind: str) -> Column:
    """The JSON object in a text, from its first to its last brace, parsed; null if there is none or it can't be."""
    found = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    return F.when(found != "", F.from_json(found, kind))


def csv_cell(value: Column) -> Column:
    """A CSV cell: empty for null, quoted if it holds a quote, comma or line end."""
    text = value.cast("string")
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.isNull(), "").when(text.rlike('[",\r\n]'), quoted).otherwise(text)


def shown_number(value: Column, digits: int = 0) -> Column:
    """With thousands separators."""
    return F.format_number(value, digits)


def shown_change(value: Column) -> Column:
    """With thousands separators and its sign."""
    return F.concat(F.when(value > 0, "+").otherwise(""), F.format_number(value, 0))


def shown_kilobytes(value: Column) -> Column:
    return F.when(value.isNull() | (value == 0), F.lit("—")).otherwise(F.concat(F.format_string("%d", F.floor(value / 1024 + 0.5)), F.lit(" KB")))


def numbers_in(text: Column) -> Column:
    """All numbers written in a text, as doubles."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"(-?\d+(?:\.\d+)?)")), lambda x: x.cast("double"))
