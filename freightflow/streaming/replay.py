"""Feeding a table to a stream in arrival batches.

Every batch is landed by a distributed write and then read by a run of the query that stops
when it is done, so each batch also proves that the query resumes from its checkpoint.
"""

from pyspark.sql import functions as F

from .sinks import remove

#: Lines of a landed file. One task reads a compressed file whole.
LINES = 500_000
#: How lines are compressed: in the least time, or to two thirds of that size.
FAST, SMALL = {"compression": "lz4"}, {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def land(rows, folder, options=FAST):
    """Append JSON lines, given as one `value` column; compressed, for they repeat every name."""
    rows.write.mode("append").option("maxRecordsPerFile", LINES).options(**options).text(folder)


def replay(arrivals, folder, start, keep=True):
    """Land each batch and run `start()`, which returns a query that stops by itself.

    Without `keep` the lines of a batch go once its run has ended without an error, so that the disk
    holds those of one batch at a time, compressed to a smaller size; the checkpoint never asks for
    them again.
    """
    for rows in arrivals:
        land(rows, folder, FAST if keep else SMALL)
        start().awaitTermination()
        if not keep:
            remove(rows.sparkSession, folder)


def time_slices(rows, count, ts="ts", late=None):
    """`rows` cut at even times into `count` DataFrames; `late` rows move one slice on."""
    low, high = rows.agg(F.min(ts), F.max(ts)).first()
    if low is None:
        return [rows]
    step = max(1, -(-(high - low + 1) // count))
    n = F.floor((F.col(ts) - low) / step)
    if late is not None:
        n = n + F.when(late, 1).otherwise(0)
    number = F.least(n, F.lit(count - 1))
    return [rows.where(number == i) for i in range(count)]
