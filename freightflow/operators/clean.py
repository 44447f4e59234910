"""Filters that every consumer of the change log starts with."""

from pyspark.sql import functions as F

from ..functions import is_blank
from ..schemas import BOOTSTRAP_PREFIX, BUSINESS_DATABASE, CHANGE_TYPES


def clean(changes, database=BUSINESS_DATABASE):
    """Changes of the business database with a known type, a table, a time and some data."""
    return changes.where(
        (F.col("database") == database)
        & F.col("type").isin(*CHANGE_TYPES)
        & F.col("ts").isNotNull()
        & ~is_blank(F.col("table"))
        & (F.size("data") > 0)
    )


def _plain_type():
    return F.replace(F.col("type"), F.lit(BOOTSTRAP_PREFIX), F.lit(""))


def normalise_type(changes):
    """Initial-load types become ordinary ones."""
    return changes.withColumn("type", _plain_type())


def count_types(changes):
    return normalise_type(changes).groupBy("table", "type").agg(F.count("*").alias("changes"))


def of_table(changes, name, database=BUSINESS_DATABASE, inserts_only=False):
    """Changes of one business table."""
    rows = changes.where((F.col("database") == database) & (F.col("table") == name))
    return rows.where(_plain_type() == "insert") if inserts_only else rows


def of_tables(changes, *names, types, database=BUSINESS_DATABASE):
    """Changes of some business tables, of `types` as they come."""
    return changes.where(
        (F.col("database") == database) & F.col("table").isin(*names) & F.col("type").isin(*types)
    )
