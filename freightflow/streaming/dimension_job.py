"""Dimension sync, upserts and lookups of the newest dimension, one micro-batch at a time."""

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from ..operators.clean import clean
from ..operators.dedupe import latest_per_key
from ..operators.dimension import key_changes
from ..operators.lookup import lookup_join
from ..operators.routing import project_columns, route
from ..sources.changelog import parse_changes
from ..sources.config import config_epochs, config_feed
from .sinks import batch_path, run_of

MERGES_AT_ONCE = 8
_DROPPED = -2  # `reset` of a dimension whose configuration was deleted


class DimensionJob:
    """Applies the change log to a `DimensionStore` as the configuration says.

    `events` is called for every micro-batch and gives the configuration events so far. A
    configured dimension is created when missing. An update or a delete of its configuration
    empties it once, when the job first sees it; after that the changes of the batch apply, and
    no change is left out for its time. Dimensions that a batch does not touch keep their
    snapshot. `rejected` counts changes without a row key, which name no row.

    The rows of the configuration are collected: it has one per dimension table.
    """

    def __init__(self, store, events, ts_unit="ms"):
        self.store, self.events, self.ts_unit = store, events, ts_unit
        self.rejected = 0

    @staticmethod
    def columns(sink_columns):
        """Columns of a dimension table: the configured ones, then `type` and `ts`."""
        return [*sink_columns.split(","), "type", "ts"]

    @staticmethod
    def schema(sink_columns):
        return ", ".join(f"`{c}` string" for c in DimensionJob.columns(sink_columns))

    def sink(self, writer):
        return writer.outputMode("append").foreachBatch(self.apply)

    def apply(self, raw, batch_id):
        run, events = run_of(raw), self.events()
        state = config_feed(events).join(config_epochs(events), "source_table").persist()
        rows = {r["sink_table"]: r for r in state.collect()}
        pointers = self.store.pointers()
        routed, last, touched = None, None, set()
        try:
            if rows:
                sources = [r["source_table"] for r in rows.values()]
                changes = clean(parse_changes(raw, sources, self.ts_unit))
                routed = project_columns(route(changes, state.drop("since"))).persist()
                without_key = F.count_if(F.col("row_key").isNull())
                found = routed.groupBy("sink_table").agg(without_key.alias("n")).collect()
                touched = {r["sink_table"] for r in found}
                self.rejected += sum(r["n"] for r in found)
                last = key_changes(routed)
            stale = [
                row for table, row in rows.items()
                if table in touched or table not in pointers
                or pointers[table]["reset"] != row["since"]
            ]
            with ThreadPoolExecutor(MERGES_AT_ONCE) as pool:
                list(pool.map(lambda row: self._merge(last, row, batch_id, run), stale))
            for table, pointer in pointers.items():
                if table not in rows and pointer["reset"] != _DROPPED:
                    nothing = self.store.spark.createDataFrame([], "id string")
                    self.store.write(table, nothing, batch_id, run, _DROPPED)
        finally:
            if routed is not None:
                routed.unpersist()
            state.unpersist()

    def _merge(self, last, row, batch_id, run):
        image = [F.col("image")[c].alias(c) for c in self.columns(row["sink_columns"])]
        mine = last.where(F.col("sink_table") == row["sink_table"]).select(
            *image, F.col("ts").alias("_ts"), F.col("offset").alias("_offset"),
            (F.col("type") == "delete").alias("_gone"),
        )
        self.store.merge(
            row["sink_table"], self.schema(row["sink_columns"]), row["sink_row_key"], mine,
            batch_id, run, row["since"],
        )


def upsert_sink(store, table, schema, key, order=("ts",)):
    """Keep the latest row per key in a store. A row of `type` delete removes its key.

    The streamed rows have the columns of `schema`, those of `order` (a time, and optionally a
    position that decides between equal times) and `type`. Rows without a key are left out.
    """

    def write(df, batch_id):
        keyed = df.where(F.col(key).isNotNull())
        last = latest_per_key(keyed, [key], order)
        place = F.col(order[1]) if len(order) > 1 else F.lit(None)
        stamped = last.select(
            "*", F.col(order[0]).cast("long").alias("_ts"), place.cast("long").alias("_offset"),
            (F.col("type") == "delete").alias("_gone"),
        )
        names = store.spark.createDataFrame([], schema).columns
        rows = stamped.select(*names, "_ts", "_offset", "_gone").persist()
        try:
            store.merge(table, schema, key, rows, batch_id, run_of(df))
        finally:
            rows.unpersist()

    return lambda writer: writer.outputMode("append").foreachBatch(write)


def enrich_latest(transform, store, tables, path, derived=None):
    """A sink that hands every micro-batch to `transform` together with the dimensions as they are
    at that moment.

    `tables` maps names to (table, schema); `transform` takes the rows and a frame per name. `derived`
    maps names to what is made of a dimension first, as `flatten_regions` makes a flat table of the
    tree: that is done once for each version of the dimension and kept until there is a newer one.
    """
    made = {}

    def write(df, batch_id):
        pointers = store.pointers()
        dims = {n: store.open(pointers.get(t), schema) for n, (t, schema) in tables.items()}
        for name, build in (derived or {}).items():
            pointer = pointers.get(tables[name][0])
            version = pointer and pointer["version"]
            if name not in made or made[name][0] != version:
                made[name] = version, build(dims[name])
            dims[name] = made[name][1]
        out = transform(df, **dims)
        out.write.mode("overwrite").parquet(batch_path(path, df, batch_id))

    return lambda writer: writer.outputMode("append").foreachBatch(write)


def lookup_latest(transform, store, table, schema, key, columns, path):
    """`enrich_latest` with one lookup of `columns` by `key`."""
    return enrich_latest(
        lambda df, dim: lookup_join(transform(df), dim, key, columns),
        store, {"dim": (table, schema)}, path,
    )
