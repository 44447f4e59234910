"""Tumbling event-time windows."""

from pyspark.sql import functions as F

from ..functions.time import DATE, DATETIME

STAMPS = ("stt", "edt", "cur_date")


def partial_rollup(facts, keys=(), count=None, sums=None, firsts=()):
    """Sums of rows that have their window in `_w`, in a form that `merged_rollup` adds up: w, the keys,
    the measures and `first`, the attributes of the earliest row with its time."""
    measures = {n: F.sum(e if not isinstance(e, str) else F.col(e)) for n, e in (sums or {}).items()}
    if count:
        measures = {count: F.count("*"), **measures}
    first = F.min(F.struct("ts", *firsts)).alias("first")
    by = [F.col("_w").alias("w"), *keys]
    return facts.groupBy(*by).agg(*[e.alias(n) for n, e in measures.items()], first)


def merged_rollup(partials, keys, measures, firsts):
    """One row per window and keys from several partial ones."""
    again = [F.sum(n).alias(n) for n in measures]
    return partials.groupBy("w", *keys).agg(*again, F.min("first").alias("first"))


def finished_rollup(merged, keys, measures, firsts):
    """Merged windows in the columns of `window_rollup`."""
    return merged.select(
        F.date_format("w.start", DATETIME).alias("stt"),
        F.date_format("w.end", DATETIME).alias("edt"),
        F.date_format("w.start", DATE).alias("cur_date"),
        *keys, *[F.col("first")[c].alias(c) for c in firsts], *measures,
    )


def window_rollup(facts, keys=(), count=None, sums=None, firsts=(), dependent=False,
                  window="5 seconds", delay="5 seconds"):
    """Aggregate per key and window of `ts`, stamped with start, end and date of the window.

    `count` names a row count, `sums` maps output names to expressions and `firsts` are
    attributes taken from the earliest row. Rows without `ts` are left out. Streams emit a
    window once the watermark, `delay` behind the latest `ts`, has passed its end.

    `dependent` says that the attributes seldom differ within a key, as a name does within
    its id. A batch then aggregates with them as further keys first, which hashing does,
    while a struct minimum has to sort its input; only the few combinations are sorted.
    """
    rows = facts.withColumn("et", F.timestamp_millis("ts")).withWatermark("et", delay)
    by = [F.window("et", window).alias("w"), *keys]
    sums = sums or {}
    measures = {n: F.sum(e if not isinstance(e, str) else F.col(e)) for n, e in sums.items()}
    if count:
        measures = {count: F.count("*"), **measures}
    aggs = [e.alias(n) for n, e in measures.items()]

    if not firsts:
        out = rows.groupBy(*by).agg(*aggs)
    elif facts.isStreaming or not dependent:
        first = F.min(F.struct("ts", *firsts)).alias("first")
        out = rows.groupBy(*by).agg(*aggs, first)
    else:
        fine = rows.groupBy(*by, *firsts).agg(*aggs, F.min("ts").alias("ts"))
        again = [F.sum(n).alias(n) for n in measures]
        first = F.min(F.struct("ts", *firsts)).alias("first")
        out = fine.groupBy("w", *keys).agg(*again, first)

    return out.select(
        F.date_format("w.start", DATETIME).alias("stt"),
        F.date_format("w.end", DATETIME).alias("edt"),
        F.date_format("w.start", DATE).alias("cur_date"),
        *keys,
        *[F.col("first")[c].alias(c) for c in firsts],
        *measures,
    )
