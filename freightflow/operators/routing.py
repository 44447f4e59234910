"""Sending changes to the dimensions that the configuration names."""

from pyspark.sql import functions as F

from ..schemas import BOOTSTRAP_PREFIX


def route(changes, config):
    """Cleaned changes joined with the configuration of their source table.

    Unconfigured tables are dropped. The row image gains `ts`, `type` and `table`.
    """
    plain = F.replace(F.col("type"), F.lit(BOOTSTRAP_PREFIX), F.lit(""))
    routes = config.drop("op")
    return (
        changes.join(routes, F.col("table") == F.col("source_table"))
        .withColumn("type", plain)
        .select("source_table", "sink_table", "sink_columns", "sink_row_key",
                "type", "ts", "offset", "data")
    )


def project_columns(routed):
    """Keep the configured columns plus `type` and `ts`; a missing column becomes null."""
    names = F.split(F.concat("sink_columns", F.lit(",type,ts")), ",")
    stamped = F.map_concat(
        F.map_filter("data", lambda k, _: ~k.isin("type", "ts")),
        F.create_map(F.lit("type"), F.col("type"), F.lit("ts"), F.col("ts").cast("string")),
    )
    image = F.map_from_arrays(
        names, F.transform(names, lambda c: F.try_element_at(F.col("stamped"), c))
    )
    return (
        routed.withColumn("stamped", stamped)
        .withColumn("row_key", F.try_element_at(F.col("data"), F.col("sink_row_key")))
        .select("source_table", "sink_table", "row_key", "type", "ts", "offset",
                image.alias("image"))
    )
