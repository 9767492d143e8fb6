"""Every panel query against its SQL."""

import pytest

from monthgrain.queries import ORACLES, QUERIES

from .conftest import same_rows


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_gives_the_rows_of_its_sql(spark, small, duck, name):
    same_rows(QUERIES[name](spark, small).toPandas(), duck.execute(ORACLES[name]).fetchdf())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 60
