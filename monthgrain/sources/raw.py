"""Raw files by their hash: looked up in source_files, read with Spark's binary file source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import a_sha


class NotAvailable(Exception):
    """status: 403 if the file is held back, 404 if there is none, 502 if it is listed but can't be found."""

    def __init__(self, status: int, reason: str):
        super().__init__(f"{status}: {reason}")
        self.status = status


def raw_file_entry(files: DataFrame, sources: DataFrame, datasets: DataFrame, sha256: str) -> DataFrame:
    """The entry of a file that belongs to a public dataset; at most one row."""
    public = datasets.filter("is_public = 1").select("dataset_key", "title", "license", "attribution")
    mapped = files.filter(F.col("sha256") == a_sha(sha256)).join(sources, ["dataset", "granularity"]).join(public, "dataset_key")
    return mapped.select("sha256", "dataset_key", "r2_key", "source_file", "license", "attribution", F.coalesce("distributable", F.lit(1)).alias("distributable"), "hold_reason").limit(1)


def read_raw_file(spark: SparkSession, entry: DataFrame, root: str) -> DataFrame:
    """path, length and content of the file in the entry, below the folder root."""
    row = entry.head()
    if row is None:
        raise NotAvailable(404, "no such file")
    if not row.distributable:
        raise NotAvailable(403, row.hold_reason or "held back")
    try:
        return spark.read.format("binaryFile").load(f"{root}/{row.r2_key}").select("path", "length", "content")
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            raise NotAvailable(502, "listed, but not in the store") from e
        raise
