"""Starting a streaming job from a source, a transformation and a sink."""

import time
from contextlib import contextmanager

from pyspark.errors import StreamingQueryException
from pyspark.sql.streaming import StreamingQueryListener


@contextmanager
def _shuffle_partitions(spark, count):
    """The number of state partitions, which a stream fixes when it first starts."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    if count:
        spark.conf.set(key, str(count))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def run_stream(name, source, transform, sink, checkpoint, every="5 seconds",
               available_now=False, state_partitions=None):
    """Start `sink(transform(source))` and return the running query.

    `transform` takes and gives a DataFrame, so the same one serves batch jobs. `sink`
    configures the writer, see `sinks`. Starting again with the same `checkpoint` resumes.
    With `available_now` the query stops once it has read everything there is.
    """
    spark = source.sparkSession
    writer = sink(transform(source).writeStream)
    writer = writer.queryName(name).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    with _shuffle_partitions(spark, state_partitions):
        return writer.trigger(**trigger).start()


class Progress(StreamingQueryListener):
    """Keeps the last `limit` batches of every query by name: (batch, rows read), and its failures. Add it
    with `spark.streams.addListener`."""

    def __init__(self, limit=1000):
        self.limit, self.batches, self.failures, self._names = limit, {}, {}, {}

    def onQueryStarted(self, event):
        self._names[str(event.id)] = event.name

    def onQueryProgress(self, event):
        p = event.progress
        seen = self.batches.setdefault(p.name, [])
        seen.append((p.batchId, p.numInputRows))
        del seen[: -self.limit]

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.exception:
            self.failures.setdefault(self._names.get(str(event.id)), []).append(event.exception)


def run_supervised(start, restarts=3, pause=10.0):
    """Keep the query of `start()` running: after a failure it is started again from its checkpoint, at
    most `restarts` times, `pause` seconds later; the failure after these is raised. Returns the number
    of restarts once the query ends by itself or is stopped."""
    failed = 0
    while True:
        query = start()
        try:
            query.awaitTermination()
            return failed
        except StreamingQueryException:
            if failed == restarts:
                raise
            failed += 1
            time.sleep(pause)


def run_sql_stream(name, tables, query, sink, checkpoint, **options):
    """Start a SQL query over streaming or static tables, given as {view name: DataFrame}."""
    for view, df in tables.items():
        df.createOrReplaceTempView(view)
    spark = next(iter(tables.values())).sparkSession
    return run_stream(name, spark.sql(query), lambda df: df, sink, checkpoint, **options)
