"""CSV part files as a Spark data source: ordered parts with a byte order mark and a header, seen all at once.

Tasks write parts under a name of their own attempt; when all have, the driver gives them their places in a list, and only
what is in the list is the table. A failed job leaves no list, and its parts are deleted; a task that ran twice
leaves a part that no list names. Reading is a task a part, or only the parts from a place on, in the order
of the rows that were written. Paths are of any store that pyarrow opens (file:, s3:, gs:, hdfs:).
"""

from __future__ import annotations

import csv
import io
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import DoubleType, IntegerType, LongType, Row, StructType

BYTE_ORDER_MARK = "﻿"
LIST = "parts.json"
_READ = {LongType: int, IntegerType: int, DoubleType: float}


def store_of(path: str):
    """The file system of a path, and the path within it."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))


def cell(value) -> str:
    """As `functions.csv_cell`: empty for null, quoted if it holds a quote, comma or line end."""
    if value is None:
        return ""
    text = str(value)
    return '"' + text.replace('"', '""') + '"' if any(c in text for c in '",\r\n') else text


@dataclass
class Part(WriterCommitMessage):
    place: int
    name: str
    n_rows: int


@dataclass
class Piece(InputPartition):
    name: str


class CsvParts(DataSource):
    """Format csv_parts. Options: path; when reading, first and count choose parts by their place."""

    @classmethod
    def name(cls) -> str:
        return "csv_parts"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"], schema, overwrite)

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options["path"], schema, int(self.options.get("first", 0)), int(self.options.get("count", -1)))

    def schema(self) -> str:
        fs, path = store_of(self.options["path"])
        listed = json.loads(fs.open_input_stream(f"{path}/{LIST}").read())
        return ", ".join(f"`{c}` string" for c in listed["columns"])


class _Writer(DataSourceWriter):
    def __init__(self, path: str, schema: StructType, overwrite: bool):
        self.path, self.columns, self.overwrite, self.job = path, schema.names, overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator[Row]) -> Part:
        fs, path = store_of(self.path)
        context = TaskContext.get()
        place = context.partitionId()
        name = f"part-{place:05d}-{self.job[:8]}-{context.taskAttemptId()}.csv"
        fs.create_dir(path, recursive=True)
        n = 0
        with fs.open_output_stream(f"{path}/{name}") as out:
            out.write((BYTE_ORDER_MARK + ",".join(map(cell, self.columns)) + "\n").encode())
            for row in iterator:
                out.write((",".join(map(cell, row)) + "\n").encode())
                n += 1
        return Part(place, name, n)

    def commit(self, messages: list[Part | None]) -> None:
        fs, path = store_of(self.path)
        before = self._listed(fs, path)
        if before and not self.overwrite:
            old = before["parts"]
        else:
            old = []
        parts = old + [{"name": m.name, "rows": m.n_rows} for m in sorted((m for m in messages if m is not None), key=lambda m: m.place)]
        with fs.open_output_stream(f"{path}/{LIST}.{self.job}") as out:
            out.write(json.dumps({"columns": self.columns, "parts": parts}).encode())
        fs.move(f"{path}/{LIST}.{self.job}", f"{path}/{LIST}")
        named = {p["name"] for p in parts}
        for p in before["parts"] if before else []:
            if p["name"] not in named:
                fs.delete_file(f"{path}/{p['name']}")

    def abort(self, messages: list[Part | None]) -> None:
        fs, path = store_of(self.path)
        for m in messages:
            if m is not None:
                fs.delete_file(f"{path}/{m.name}")

    @staticmethod
    def _listed(fs, path: str) -> dict | None:
        try:
            return json.loads(fs.open_input_stream(f"{path}/{LIST}").read())
        except FileNotFoundError:
            return None


class _Reader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, first: int, count: int):
        self.path, self.kinds, self.first, self.count = path, [_READ.get(type(f.dataType), str) for f in schema], first, count

    def partitions(self) -> list[Piece]:
        fs, path = store_of(self.path)
        parts = json.loads(fs.open_input_stream(f"{path}/{LIST}").read())["parts"]
        return [Piece(p["name"]) for p in (parts[self.first :] if self.count < 0 else parts[self.first : self.first + self.count])]

    def read(self, partition: Piece) -> Iterator[tuple]:
        fs, path = store_of(self.path)
        with fs.open_input_stream(f"{path}/{partition.name}") as raw:
            lines = csv.reader(io.TextIOWrapper(raw, encoding="utf-8-sig", newline=""))
            next(lines)
            for row in lines:
                yield tuple(None if x == "" else k(x) for k, x in zip(self.kinds, row, strict=True))
