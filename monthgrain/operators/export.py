"""Ordered exports of one dataset's rows as CSV or JSON."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import csv_cell
from ..schema import EXPORT_MONTHS, EXPORT_ORDER, EXPORTS, Result, a_year_month, add_months, months_between
from .families import _dataset

BYTE_ORDER_MARK = "\ufeff"


def export_rows(spark: SparkSession, dataset: str, measure: str, start: str, end: str) -> Result:
    """The rows of start to end (YYYY-MM), in order. Over EXPORT_MONTHS months is an error that names the
    month to end at: a file that was cut short would open as if it were whole."""
    a, b = a_year_month(start), a_year_month(end)
    if a > b:
        raise ValueError("the period must not end before it begins")
    ds = _dataset(spark, dataset)
    if (ds.granularity, measure) not in EXPORTS:
        raise ValueError(f"{measure!r} is not exported at granularity {ds.granularity!r}")
    n = months_between(a, b)
    if n > EXPORT_MONTHS:
        raise ValueError(f"{n} months asked for, at most {EXPORT_MONTHS} are allowed; try {a} to {add_months(a, EXPORT_MONTHS - 1)}")
    view, columns = EXPORTS[ds.granularity, measure]
    order = [c for c in EXPORT_ORDER if c in columns]
    sql = f"SELECT {', '.join(columns)} FROM {view} WHERE muni_code = :muni AND reference_date BETWEEN :start AND :end ORDER BY {', '.join(order)}"
    params = {"muni": ds.muni_code, "start": f"{a}-01", "end": f"{b}-01"}
    name = f"{dataset}_{measure}_{a}_{b}.csv"
    return Result(spark.sql(sql, args=params), sql, params, [f"license: {ds.license or 'unspecified'}", f"attribution: {ds.attribution or 'unspecified'}"], None, {"file_name": name, "view": view})


def csv_lines(df: DataFrame) -> DataFrame:
    """Each row as one CSV line, in the order of df."""
    return df.select(F.concat_ws(",", *(csv_cell(F.col(c)) for c in df.columns)).alias("line"))


def csv_chunks(df: DataFrame, chunk: int = 5000) -> Iterator[str]:
    """The file as text, chunk by chunk, with a byte order mark and header: for a client that reads as it
    goes. One partition at a time is at the driver."""
    yield BYTE_ORDER_MARK + ",".join(df.columns) + "\n"
    held: list[str] = []
    for row in csv_lines(df).toLocalIterator():
        held.append(row.line)
        if len(held) == chunk:
            yield "\n".join(held) + "\n"
            held = []
    if held:
        yield "\n".join(held) + "\n"


def page(ordered: DataFrame, chunk: int, number: int) -> DataFrame:
    """The rows of one page of an ordered export, from 0; an empty page follows the last."""
    return ordered.offset(chunk * number).limit(chunk)


@dataclass
class PageIndex:
    """Where the pages of an ordered export begin: the keys of each page's first row, a row a page."""

    rows: DataFrame
    order: list[str]
    starts: DataFrame

    @classmethod
    def of(cls, rows: DataFrame, order: list[str], chunk: int = 5000) -> PageIndex:
        """order: columns by which the rows are ordered, without nulls; rows that are equal in all of them come on one page.

        Keys are dealt out in ranges and sorted there, and written once to the shared folder; a range's rows are
        counted, and so each key's place is known without a sort of all in one task."""
        spark = rows.sparkSession
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch")
        keys = rows.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
        placed = keys.withColumn("_id", F.monotonically_increasing_id()).checkpoint(eager=True)
        part, at = F.call_function("shiftright", F.col("_id"), F.lit(33)), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
        sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
        before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # a row a range
        offsets = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))
        numbered = placed.withColumn("part", part).join(F.broadcast(offsets), "part").withColumn("place", F.col("before") + at)
        starts = numbered.filter(F.col("place") % chunk == 0).select((F.col("place") / chunk).cast("long").alias("page"), *order)
        return cls(rows, order, starts)

    def page(self, number: int) -> DataFrame:
        """The rows of one page, from 0, in order: those from its first key to the next page's. An empty page follows the last."""
        found = {r.page: r for r in self.starts.filter(F.col("page").isin(number, number + 1)).collect()}
        if number not in found:
            return self.rows.limit(0)
        within = self._from(found[number])
        if number + 1 in found:
            within = within & ~self._from(found[number + 1])
            within = within & (F.col(self.order[0]) <= found[number + 1][self.order[0]])
        return self.rows.filter(within).orderBy(*self.order)

    def _from(self, row) -> Column:
        """Keys at or after a row's. The first key's bound stands alone too, so that it reaches the scan."""
        after = F.lit(True)
        for c in reversed(self.order):
            after = (F.col(c) > row[c]) | ((F.col(c) == row[c]) & after)
        return (F.col(self.order[0]) >= row[self.order[0]]) & after


def write_csv(df: DataFrame, path: str) -> None:
    """As part files in order, each with a byte order mark and a header, in the cells of `csv_lines`."""
    head = BYTE_ORDER_MARK + ",".join(df.columns)

    def headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = pa.RecordBatch.from_pydict({"line": [head]})
        for k, batch in enumerate(batches):
            if k == 0:
                yield mark.cast(batch.schema)
                mark = None
            yield batch
        if mark is not None:
            yield mark

    csv_lines(df).mapInArrow(headed, "line string").write.mode("overwrite").text(path)


def json_rows(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))
