"""Tables, value domains, and the checks that request parameters must pass."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType


def _table(text: str) -> StructType:
    kinds = {"s": StringType(), "l": LongType(), "i": IntegerType()}
    return StructType([StructField(n, kinds[k]) for n, _, k in (x.partition(":") for x in text.split())])


TABLES = {
    "observations_5y": _table("muni_code:s key_code:s reference_date:s measure:s age_class:s sex:s value:l source_sha256:s"),
    "observations_1y": _table("muni_code:s key_code:s reference_date:s age_class:s sex:s value:l source_sha256:s"),
    "areas": _table("key_code:s muni_code:s area_name:s first_seen:s last_seen:s"),
    "area_aliases": _table("key_code:s alias_name:s"),
    "datasets": _table("dataset_key:s muni_code:s muni_name:s domain:s title:s granularity:s grain_label:s source_site:s source_url:s license:s attribution:s is_public:i notes:s"),
    "dataset_sources": _table("dataset_key:s dataset:s granularity:s role:s"),
    "dataset_gaps": _table("dataset_key:s reference_date:s kind:s reason:s noted_at:s"),
    "sync_runs": _table("run_id:s dataset_key:s started_at:s finished_at:s status:s new_files:i error:s"),
    "dataset_periods": _table("dataset_key:s reference_date:s file_count:l obs_rows:l"),
    "source_files": _table(
        "sha256:s dataset:s granularity:s reference_date:s r2_key:s source_file:s content_bytes:l status:s row_count:l skip_reason:s "
        "ingested_at:s distributable:i hold_reason:s resource_id:s source_last_modified:s supersedes:s is_current:i filename_date:s date_source:s"
    ),
    "known_issues": _table("issue_id:l dataset_key:s title:s detail:s severity:s resolved_at:s"),
}

#: Month of the break in the series: seasonality, and the gaps that bear on it, start there.
BREAK_DATE = "1995-01-01"
GAP_KINDS = ("upstream_missing", "ingest_failed", "pending_fix", "series_break")
RUN_STATUSES = ("ok", "no_change", "error")
FILE_STATUSES = ("ingested", "skipped")
SEXES = ("male", "female", "total")


@dataclass(frozen=True)
class Measure:
    """What a request may ask for, and the view that answers it."""

    key: str
    label: str
    unit: str
    view: str
    why: str
    has_age: bool = False
    has_sex: bool = False


_MEASURES = {
    "5y": {
        "population": Measure("population", "population", "persons", "v_population_5y", "leaf rows by age class and sex", True, True),
        "households": Measure("households", "households", "households", "v_households_5y", "one row per area and month"),
        "foreign_population": Measure("foreign_population", "foreign population", "persons", "v_foreign_population_5y", "leaf rows by sex, no age classes", has_sex=True),
    },
    "1y": {"population": Measure("population", "population", "persons", "v_population_1y", "leaf rows by year of age and sex", True, True)},
}

#: Columns and view of each export by granularity and measure.
_AGE_COLUMNS = ["muni_code", "key_code", "area_name", "reference_date", "age_class", "sex", "value", "source_sha256"]
EXPORTS = {
    ("5y", "population"): ("v_population_5y", _AGE_COLUMNS),
    ("5y", "households"): ("v_households_5y", [c for c in _AGE_COLUMNS if c not in ("age_class", "sex")]),
    ("5y", "foreign_population"): ("v_foreign_population_5y", [c for c in _AGE_COLUMNS if c != "age_class"]),
    ("5y", "published_totals"): ("v_published_totals_5y", ["muni_code", "key_code", "area_name", "reference_date", "measure", "value"]),
    ("1y", "population"): ("v_population_1y", _AGE_COLUMNS),
}
EXPORT_ORDER = ("reference_date", "key_code", "measure", "age_class", "sex")
EXPORT_MONTHS = 24
KEYS_SUMMED, KEYS_SPLIT = 20, 120


@dataclass
class Result:
    """Rows with what made them: the SQL text and its parameters (run them again to get the same
    rows), the rules that were followed, and the gaps and breaks that bear on the rows."""

    df: DataFrame
    sql: str
    params: dict
    notes: list[str]
    annotations: DataFrame | None = None
    extra: dict = field(default_factory=dict)

    def plan_notes(self) -> list[str]:
        """What the rows' own plan reads, filters, groups and gates, as `name: value`."""
        from .operators.explain import plan_notes

        return plan_notes(self.df, [t.name for t in self.df.sparkSession.catalog.listTables() if t.isTemporary])


def _match(pattern: str, text: str | None, what: str) -> str:
    if not re.fullmatch(pattern, text or ""):
        raise ValueError(f"{what} is not valid: {text!r}")
    return text


def a_date(text: str | None) -> str:
    return _match(r"\d{4}-\d{2}-\d{2}", text, "date")


def a_month(text: str | None) -> str:
    return _match(r"0[1-9]|1[0-2]", text, "month")


def a_year_month(text: str | None) -> str:
    return _match(r"\d{4}-(0[1-9]|1[0-2])", text, "year and month")


def a_key(text: str | None) -> str:
    return _match(r"\d{6,13}", text, "area key")


def a_dataset(text: str | None) -> str:
    return _match(r"[a-z0-9_]{1,64}", text, "dataset")


def a_sha(text: str | None) -> str:
    return _match(r"[0-9a-f]{64}", text, "sha256")


def a_period(start: str | None, end: str | None, strict: bool = False) -> tuple[str, str]:
    a, b = a_date(start), a_date(end)
    if a > b or (strict and a == b):
        raise ValueError(f"the period must {'end after it begins' if strict else 'not end before it begins'}: {a} to {b}")
    return a, b


def area_keys(text: str | list[str] | None, most: int) -> list[str]:
    """Checked keys. Bad keys and too many are errors: leaving some out would answer another question."""
    keys = text.split(",") if isinstance(text, str) else list(text or [])
    keys = [a_key(k.strip()) for k in keys if k.strip()]
    if len(keys) > most:
        raise ValueError(f"{len(keys)} areas asked for; at most {most} are allowed")
    return keys


def resolve_measure(granularity: str, measure: str | None) -> Measure:
    found = _MEASURES.get(granularity, {}).get(measure or "population")
    if found is None:
        raise ValueError(f"measure {measure!r} is not available at granularity {granularity!r}")
    return found


def months_between(start: str, end: str) -> int:
    """Months from start to end, both YYYY-MM, both counted."""
    (y1, m1), (y2, m2) = (map(int, x.split("-")[:2]) for x in (start, end))
    return (y2 - y1) * 12 + m2 - m1 + 1


def add_months(month: str, n: int) -> str:
    y, m = map(int, month.split("-")[:2])
    y, m = divmod(y * 12 + m - 1 + n, 12)
    return f"{y:04d}-{m + 1:02d}"
