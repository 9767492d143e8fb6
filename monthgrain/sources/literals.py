"""Small literal catalog tables, as rows that both engines can be given."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType

from ..schema import TABLES

SHA = ["%064x" % i for i in range(1, 9)]
#: Two datasets of region 1 and one of region 2 that isn't public.
ROWS: dict[str, list[tuple]] = {
    "datasets": [
        ("pop5", "000001", "America", "population", "Five-year classes", "5y", "5-year", "site", "https://data.example/5", "CC BY 4.0", "Example", 1, None),
        ("pop1", "000001", "America", "population", "Single years", "1y", "1-year", "site", "https://data.example/1", None, None, 1, "new"),
        ("asia5", "000002", "Asia", "population", "Not public", "5y", "5-year", "site", "https://data.example/a", None, "Example", 0, None),
    ],
    "dataset_sources": [("pop5", "reg-archive", "5y", "archive"), ("pop5", "reg-latest", "5y", "latest"), ("pop1", "reg-single", "1y", "latest"), ("asia5", "asia", "5y", "latest")],
    "dataset_gaps": [
        ("pop5", "1994-06-01", "upstream_missing", "before the break", "2020-01-01"),
        ("pop5", "1996-03-01", "upstream_missing", "never published", "2020-01-01"),
        ("pop5", "1997-07-01", "series_break", "definition changed", "2020-01-01"),
        ("pop5", "1999-11-01", "ingest_failed", "file damaged", "2020-01-02"),
        ("pop1", "1998-05-01", "pending_fix", "to be loaded again", "2020-01-03"),
    ],
    "sync_runs": [
        ("r1", "pop5", "2020-01-01T00:00", "2020-01-01T00:05", "ok", 3, None),
        ("r2", "pop5", "2020-01-02T00:00", "2020-01-02T00:01", "no_change", 0, None),
        ("r3", "pop5", "2020-01-03T00:00", None, "error", 0, "timeout"),
        ("r4", "asia5", "2020-01-03T00:00", None, "error", 0, "timeout"),
    ],
    "source_files": [
        (SHA[0], "reg-archive", "5y", "1995-01-01", "raw/1", "a.csv", 2048, "ingested", 10, None, "2020-01-01", 1, None, "x1", "2019-01-01", None, 0, None, "name"),
        (SHA[1], "reg-archive", "5y", "1995-01-01", "raw/2", "a2.csv", 4096, "ingested", 12, None, "2020-01-02", None, None, "x1", "2019-02-01", SHA[0], 1, None, "name"),
        (SHA[2], "reg-latest", "5y", "1995-02-01", "raw/3", "b.csv", 100, "ingested", 7, None, "2020-01-03", 0, "under review", "x2", "2019-01-01", None, None, None, "name"),
        (SHA[3], "reg-latest", "5y", "2002-12-01", "raw/4", "c.csv", None, "ingested", 9, None, "2020-01-04", 1, None, "x3", "2019-01-01", None, 1, None, "name"),
        (SHA[4], "reg-single", "1y", "1995-03-01", "raw/5", "d.csv", 512, "skipped", None, "not a table", "2020-01-05", 1, None, "x4", "2019-01-01", None, 1, None, "name"),
        (SHA[5], "unmapped", "5y", "1995-04-01", "raw/6", "e.csv", 512, "ingested", 3, None, "2020-01-06", 1, None, "x5", "2019-01-01", None, 1, None, "name"),
        (SHA[6], "asia", "5y", "1995-04-01", "raw/7", "f.csv", 512, "ingested", 3, None, "2020-01-07", 1, None, "x6", "2019-01-01", None, 1, None, "name"),
    ],
    "known_issues": [
        (1, "pop5", "rounding", "small areas are rounded", "low", None),
        (2, "pop5", "boundary", "areas changed", "high", None),
        (3, "pop5", "labels", "names differ", "medium", None),
        (4, "pop5", "old", "fixed", "high", "2020-02-01"),
        (5, "pop1", "ages", "ages over 100 folded", "medium", None),
    ],
    "area_aliases": [("00000001", "The Argentine"), ("00000001", "Rio de la Plata"), ("00000002", "Brasil")],
    # periods known before a refresh, with files that have no rows yet and a month outside
    "dataset_periods": [("pop5", "1995-01-01", 9, 0), ("pop5", "2003-01-01", 1, 0), ("asia5", "1995-01-01", 1, 5)],
}
#: Texts whose numbers are checked against facts, and a series with a missing month, ties and zeros.
TEXTS = [
    (1, "The peak is 12.35% in month 9, and the trough is -3.1%."),
    (2, "Growth reached 47.9 percent over 17 years."),
    (3, "About 12% above trend, with 1234 persons."),
    (4, "No figures here."),
]
FACTS = '{"peak": 12.35, "trough": -3.1, "label": "seen 1234 times"}'
#: Areas named by town and block; texts with and without an object; numbers to be shown.
TOWNS = [("101", "本町2丁目"), ("102", "本町10丁目"), ("103", "本町1丁目"), ("104", "港"), ("105", "3丁目"), ("106", "東町1丁目")]
REPLIES = [(1, 'Here it is: {"limits": "few years", "n": 3} as asked.'), (2, "no object"), (3, '{"limits": "cut off'), (4, '```\n{"n": 5}\n```')]
SHOWN = [(1, 1234567), (2, -1500), (3, 0), (4, None), (5, 900)]
SERIES = [("a", 1990 * 12 + 1 + i, 100 + (i * 7) % 12 + i) for i in range(60) if i != 20] + [("tie", 1990 * 12 + 1 + i, 100 + (5 if i % 12 in (3, 8) else 0)) for i in range(60)]


def frame(spark: SparkSession, table: str) -> DataFrame:
    """As a local relation, which Spark filters and counts without a job."""
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c) for c in zip(*ROWS[table], strict=True)], names=TABLES[table].names), TABLES[table])


def values_sql(table: str) -> str:
    """The same rows as a SQL relation."""
    def cell(v) -> str:
        return "NULL" if v is None else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"

    schema = TABLES[table]
    cast = ", ".join(f"CAST({f.name} AS {'VARCHAR' if isinstance(f.dataType, StringType) else 'BIGINT'}) AS {f.name}" for f in schema)
    rows = ", ".join("(" + ", ".join(map(cell, r)) + ")" for r in ROWS[table])
    return f"SELECT {cast} FROM (VALUES {rows}) v({', '.join(schema.names)})"
