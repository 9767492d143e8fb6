"""Late files: the reference data has no streams, but files arrive late, and what they touch is rebuilt."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.versions import VersionedTable


def replace_months(stream: DataFrame, target: str, checkpoint: str, keys: tuple[str, ...] = ("muni_code", "reference_date"), by: str = "reference_date", keep: int = 2) -> StreamingQuery:
    """Takes observation rows as they arrive; each batch replaces all of the (municipality, month) slices
    it holds rows of, in the VersionedTable target, which is partitioned by month.

    Only partitions that a batch has rows of are read and written, and a batch is seen whole or not at all. Its number is noted in the
    manifest, so a batch that is repeated after a failure changes nothing more. Versions before the last `keep` are deleted."""
    spark = stream.sparkSession
    table = VersionedTable(spark, target, stream.schema, by)

    def apply(batch: DataFrame, number: int) -> None:
        done = table.manifest()["note"]
        if (done is not None and int(done) >= number) or batch.isEmpty():
            return
        table.replace(batch, list(keys), note=str(number))
        table.vacuum(keep)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, target: str, by: str = "reference_date") -> DataFrame:
    """The latest version of a table kept by replace_months."""
    return VersionedTable.open(spark, target, by).read()
