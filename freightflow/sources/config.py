"""The table that says which source tables are dimensions and how they are kept."""

from pyspark.sql import functions as F

from ..schemas import CONFIG_COLUMNS, CONFIG_ROW


def read_jdbc_config(spark, url, table="table_process", **options):
    """The configuration table over JDBC; the filter on `sink_type` runs in the database."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    return config_snapshot(reader.options(**options).load())


def config_snapshot(rows):
    """Dimension rows of the configuration table, marked as read (`op` r)."""
    return rows.where("sink_type = 'DIM'").select(*CONFIG_COLUMNS, F.lit("r").alias("op"))


def snapshot_events(rows, ts_ms=0):
    """The configuration table as the events that a feed begins with, at feed position 0."""
    nothing = F.lit(None).cast(CONFIG_ROW)
    return rows.select(
        F.lit("r").alias("op"), F.lit(ts_ms).cast("bigint").alias("ts_ms"),
        nothing.alias("before"), F.struct(*CONFIG_COLUMNS).alias("after"),
        F.lit(0).cast("bigint").alias("seq"),
    )


def config_images(events):
    """One row per configuration event: the image that counts, its `op` and its feed position.

    A delete counts with its old image, everything else with its new one. A rename of the
    source table also deletes the route of the old name.
    """
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    renamed = (F.col("op") == "u") & (
        F.col("before.source_table") != F.col("after.source_table")
    )
    effects = F.array(
        F.struct(F.col("op").alias("op"), image.alias("image")),
        F.when(renamed, F.struct(F.lit("d").alias("op"), F.col("before").alias("image"))),
    )
    return (
        events.select("seq", F.explode(effects).alias("e"))
        .select("e.image.*", "e.op", "seq")
        .where("sink_type = 'DIM'")
    )


def config_feed(events):
    """The routes in force after all events: the latest one per source table, unless deleted.

    Events are ordered by their position in the feed (`seq`), as several may share a time.
    """
    rest = [c for c in CONFIG_COLUMNS if c != "source_table"]
    latest = F.max_by(F.struct("op", *rest), F.struct("seq", F.col("op") != "d"))
    return (
        config_images(events)
        .groupBy("source_table")
        .agg(latest.alias("c"))
        .where("c.op <> 'd'")
        .select("source_table", "c.*")
        .select(*CONFIG_COLUMNS, "op")
    )


def config_epochs(events):
    """The feed position `since` which each source table's dimension begins at.

    A `u` empties a dimension and a `d` drops it, so it begins at the last of these, or at -1 when
    there was none: `r` and `c` only announce a table and never cut its history. Source tables
    whose last event is a delete are absent.
    """
    restarts = F.col("op").isin("u", "d")
    order = F.struct("seq", F.col("op") != "d")
    return (
        config_images(events)
        .groupBy("source_table")
        .agg(F.max_by("op", order).alias("last"), F.max(F.when(restarts, F.col("seq"))).alias("at"))
        .where("last <> 'd'")
        .select("source_table", F.coalesce("at", F.lit(-1)).alias("since"))
    )
