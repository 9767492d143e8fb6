"""What the corpus operators share: shared folders, checkpoints, splits and Arrow helpers."""

from __future__ import annotations

import ctypes
import sys
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows of an Arrow batch that are Python objects at one time.
ROWS_AT_ONCE = 1024


def sliced(column: pa.Array) -> Iterator[list]:
    """A column's values as lists of at most ROWS_AT_ONCE."""
    for at in range(0, len(column), ROWS_AT_ONCE):
        yield column.slice(at, ROWS_AT_ONCE).to_pylist()


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: the one the cluster names, else one in the
    warehouse, which they share too."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a folder that scratch_path named, wherever Spark keeps it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def cut(df: DataFrame) -> DataFrame:
    """Materialises df in the shared folder, so that later jobs and lost executors don't redo it."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def own_name(df: DataFrame, name: str) -> str:
    """name, or with underscores before it, so that no column of df is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns of a row. Maps have no hash of their own; their text does."""
    return F.xxhash64(*(F.col(f"`{f.name}`").cast("string") if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in df.schema))


#: Keys that may be looked up by broadcast: those with over 1 / HOT_KEYS of all rows, so no more than this.
HOT_KEYS = 1000


def not_sent(df: DataFrame) -> DataFrame:
    """df, for a join that is to shuffle it however small it is found to be: what is broadcast passes through the driver,
    several times as large there, and of a table that grows with the corpus many are just under Spark's limit."""
    return df.hint("merge")


def look_up(rows: DataFrame, key: str, table: DataFrame, count: str, total: int, spread: list[str]) -> DataFrame:
    """rows with the columns of table (a row per key; null where it has none), but for its count.

    count says how many rows have the key, of total. Keys with over 1 / HOT_KEYS of the rows, which are
    HOT_KEYS at most, are broadcast, and their rows dealt out by a hash of the columns in spread; all
    others are joined by shuffle."""
    names = [c for c in table.columns if c not in (key, count)]
    hot = F.col(count) * HOT_KEYS > total
    found, rest = (table.filter(which).select(F.col(key).alias(f"_{side}_key"), F.struct(*names).alias(f"_{side}")) for side, which in (("hot", hot), ("rest", ~hot)))
    salted = rows.join(F.broadcast(found), F.col(key) == F.col("_hot_key"), "left").withColumn("_salt", F.when(F.col("_hot_key").isNull(), 0).otherwise(1 + F.pmod(F.xxhash64(*spread), F.lit(1 << 16))))
    joined = salted.join(not_sent(rest.withColumn("_rest_salt", F.lit(0).cast("long"))), (F.col(key) == F.col("_rest_key")) & (F.col("_salt") == F.col("_rest_salt")), "left")
    return joined.select(*rows.columns, *(F.coalesce(F.col(f"_hot.{n}"), F.col(f"_rest.{n}")).alias(n) for n in names))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def remainder(column: str, modulus: int) -> Column:
    """crc32 of an id as text, modulo modulus; null ids give null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(modulus)


def n_tasks(df: DataFrame, amount: int, per_task: int) -> int:
    """Partitions for a shuffle of so much data: as configured, more where a task would get too much."""
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, configured, -(-int(amount or 0) // per_task))


def give_back() -> None:
    """Returns freed memory to the machine: a worker goes on to other stages, and would else keep the most it ever had."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):  # glibc's alone
        libc.malloc_trim(0)


def arrow_map(df: DataFrame, make: Callable[[], Callable[..., Iterable[tuple]]], schema: str, names: list[str]) -> DataFrame:
    """mapInArrow for a function of one batch's columns (as Python lists) to rows as column lists.

    make() runs once a task and may load models; what it freed is given back when the task ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, types = None, None
        for batch in batches:
            if step is None:
                step = make()
            types = types or arrow_schema(schema)
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                columns = step(*(part.column(i) for i in range(part.num_columns)))
                if columns is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=t.type) if not isinstance(c, pa.Array) else c for c, t in zip(columns, types, strict=True)], schema=types)
        step = batch = part = columns = None
        give_back()

    return df.select(*names).mapInArrow(run, schema)


_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}


def arrow_schema(ddl: str) -> pa.Schema:
    """Of a flat DDL string such as 'doc_id long, text string, parts array<long>'."""
    fields = []
    for part in ddl.split(","):
        name, kind = part.split()
        inner = kind.removeprefix("array<").removesuffix(">")
        fields.append(pa.field(name, pa.list_(_ARROW[inner]) if inner != kind else _ARROW[kind]))
    return pa.schema(fields)
