"""Keeping dimension tables current from routed changes."""

from pyspark.sql import functions as F

from .dedupe import latest_per_key

CHANGE_ORDER = ("ts", "offset")


def key_changes(projected):
    """The last change of every row key, by time and then by offset. Null keys are left out."""
    keyed = projected.where("row_key IS NOT NULL")
    return latest_per_key(keyed, ["sink_table", "row_key"], CHANGE_ORDER)


def versions(changes, table, columns, key="id"):
    """The history of a dimension from its cleaned changes, for `lookup_as_of`: id, since, seq, gone and
    the columns. Versions of one moment are ordered by `seq`, the position of the change."""
    rows = changes.where(F.col("table") == table)
    return rows.select(
        F.col("data")[key].alias("id"), F.col("ts").alias("since"), F.col("offset").alias("seq"),
        (F.col("type") == "delete").alias("gone"), *[F.col("data")[c].alias(c) for c in columns],
    )


def keep_current_epoch(changes, epochs):
    """Drop changes of dimensions that were emptied or dropped after the change had come.

    `config_seq` of a change is the last configuration event seen when it came, null before the
    first. Times play no part.
    """
    joined = changes.join(epochs, F.col("table") == F.col("source_table"))
    current = F.coalesce("config_seq", F.lit(-1)) >= F.col("since")
    return joined.where(current).drop("since", "source_table", "config_seq")


def apply_changes(snapshot, last_changes, key):
    """The snapshot after the last change of every key: a delete removes, all else replaces.

    Both inputs hold each key at most once; `last_changes` also has a `type`. Where both have a
    column `ts`, a change that is older than the row it meets does nothing. Null keys of changes
    are left out, as they name no row.
    """
    columns = snapshot.columns
    dated = "ts" in columns and "ts" in last_changes.columns
    changed = last_changes.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"),
        (F.col("type") == "delete").alias("_gone"),
        F.struct(*columns).alias("_new"),
    )
    merged = snapshot.join(changed, F.col(key) == F.col("_key"), "full")
    wins = F.col("_key").isNotNull()
    if dated:
        newer = F.col("_new.ts").cast("bigint") >= F.col("ts").cast("bigint")
        wins = wins & (F.col(key).isNull() | F.coalesce(newer, F.lit(True)))
    rows = merged.withColumn("_wins", wins).where("NOT _wins OR NOT _gone")
    return rows.select(
        *[F.when(F.col("_wins"), F.col("_new")[c]).otherwise(F.col(c)).alias(c) for c in columns]
    )
