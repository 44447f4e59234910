"""Event-time windows whose state is a table, with late rows kept and silent sources left out.

Spark's own windows drop a late row unseen, and its watermark waits for the slowest of several sources,
however long that is silent. Here a micro-batch adds its sums to those of the windows that are still
open, and everything that decides is a small table: the clock of each source and the watermark.
"""

import time

from pyspark.sql import functions as F

from ..operators.rollup import finished_rollup, merged_rollup, partial_rollup
from .pairing import State, put


def wall_clock():
    """Milliseconds since 1970."""
    return time.time_ns() // 1_000_000


class _Clocks:
    """The latest event time of every source and when it last gave rows, and the watermark."""

    SCHEMA = "source string, ts long, seen long, mark long"

    def __init__(self, rows, sources, now):
        self.mark = max((r["mark"] for r in rows if r["mark"] is not None), default=None)
        self.of = {s: (None, now) for s in sources} | {r["source"]: (r["ts"], r["seen"]) for r in rows}

    def advance(self, latest, now, delay_ms, idle_after_ms):
        """Take in the latest times of a batch; the watermark follows the slowest source that is not idle."""
        for source, ts in latest.items():
            old = self.of.get(source, (None, now))[0]
            self.of[source] = (ts if old is None else max(old, ts), now)
        active = [ts for ts, seen in self.of.values() if idle_after_ms is None or now - seen < idle_after_ms]
        if active and None not in active:
            mark = min(active) - delay_ms
            self.mark = mark if self.mark is None else max(self.mark, mark)

    def rows(self):
        return [(s, ts, seen, self.mark) for s, (ts, seen) in self.of.items()]


def windows_to(path, now=wall_clock):
    """A sink for closed windows that may come again, as after a restart without its checkpoint: every
    batch is stamped with the time of its writing, and `read_windows` takes the last of each."""

    def write(df, batch_id):
        put(df.withColumn("_written", F.lit(now())), path, df, batch_id)

    return lambda writer: writer.outputMode("append").foreachBatch(write)


def read_windows(spark, path, keys):
    """The windows of `windows_to`, the one that was written last for every `stt` and keys."""
    rows = spark.read.parquet(path).drop("run", "batch_id")
    names = [c for c in rows.columns if c != "_written"]
    rest = [c for c in names if c not in ("stt", *keys)]
    last = F.max_by(F.struct(*rest), "_written").alias("_last")
    return rows.groupBy("stt", *keys).agg(last).select("stt", *keys, "_last.*").select(*names)


def window_sink(root, keys=(), count=None, sums=None, firsts=(), window="5 seconds", delay_ms=5000,
                source=None, sources=(), idle_after_ms=None, now=wall_clock):
    """Roll rows with `ts` up in windows, as `operators.window_rollup` does.

    Writes the windows that a batch closes to `root`/out, and to `root`/late the rows whose window the
    watermark had passed before the batch came, whole. The watermark is `delay_ms` behind the latest
    `ts`; with `source`, a column that names where a row comes from, behind the slowest of them. A source
    that has given no rows for `idle_after_ms` by the clock `now` does not hold the watermark back until
    it gives some again; if all are idle the watermark stays. `sources` names those that count before
    they have given any. A watermark never falls. Rows without `ts` are left out, a null source is one of
    its own. A repeated batch starts from the state before it and replaces what it had written.
    """
    sums = sums or {}
    measures = [*([count] if count else []), *sums]

    def write(df, batch_id):
        spark, at = df.sparkSession, now()
        rows = df.where("ts IS NOT NULL")
        rows = rows.withColumn("_w", F.window(F.timestamp_millis("ts"), window)).persist()
        state, table = State(f"{root}/clocks"), spark.createDataFrame([], _Clocks.SCHEMA)
        clocks = _Clocks(state.before(table, batch_id, df).collect(), sources, at)
        try:
            late = F.lit(False)
            if clocks.mark is not None:
                late = F.unix_millis("_w.end") <= clocks.mark
                put(rows.where(late).drop("_w"), f"{root}/late", df, batch_id)
            name = F.col(source).cast("string") if source else F.lit("all")
            latest = rows.groupBy(name.alias("source")).agg(F.max("ts").alias("ts")).collect()
            clocks.advance({r["source"]: r["ts"] for r in latest}, at, delay_ms, idle_after_ms)
            fresh = partial_rollup(rows.where(~late), keys, count, sums, firsts)
            waiting = State(f"{root}/open")
            both = waiting.before(fresh, batch_id, df).unionByName(fresh)
            windows = merged_rollup(both, keys, measures, firsts).persist()
            try:
                done = F.unix_millis("w.end") <= clocks.mark if clocks.mark is not None else F.lit(False)
                put(finished_rollup(windows.where(done), keys, measures, firsts), f"{root}/out", df, batch_id)
                waiting.replace(df, windows.where(~done), batch_id)
            finally:
                windows.unpersist()
            state.replace(df, spark.createDataFrame(clocks.rows(), _Clocks.SCHEMA).coalesce(1), batch_id)
        finally:
            rows.unpersist()

    return lambda writer: writer.outputMode("append").foreachBatch(write)
