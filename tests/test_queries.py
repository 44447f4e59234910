"""Every registered query against DuckDB on the whole tables."""

import __spark_entry__ as entry
import pytest
from compare import connect, differences
from freightflow.catalog import ORACLE, QUERIES
from pyspark.sql import types as T

SF_DIR = "/root/testdata/sf0.001"

DUCK_TYPES = {
    T.StringType: {"VARCHAR"},
    T.LongType: {"BIGINT"},
    T.IntegerType: {"INTEGER"},
    T.DoubleType: {"DOUBLE"},
    T.BooleanType: {"BOOLEAN"},
}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    assert differences(df, duck, ORACLE[name]) is None
    described = duck.execute(f"DESCRIBE {ORACLE[name]}").fetchall()
    duck_types = {row[0]: row[1] for row in described}
    for field in df.schema:
        assert duck_types[field.name] in DUCK_TYPES[type(field.dataType)], field.name


def test_entry(spark):
    assert entry.entry(spark).count() > 0
