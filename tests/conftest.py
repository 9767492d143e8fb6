import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints"))).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small() -> str:
    return str(DATA / "sf0.001")


@pytest.fixture(scope="session")
def duck(small):
    import duckdb

    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return c


def same_rows(spark_frame, duck_frame):
    """Both as sorted tuples, columns by name."""
    cols = sorted(duck_frame.columns)
    assert cols == sorted(spark_frame.columns)
    rows = [sorted(map(tuple, x[cols].astype(object).where(x[cols].notna(), None).values.tolist()), key=repr) for x in (spark_frame, duck_frame)]
    assert rows[0] == rows[1]
