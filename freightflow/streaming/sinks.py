"""Sinks for `run_stream`: functions that finish a DataStreamWriter, and row shapes."""

from pyspark.sql import functions as F

from ..functions import json_row
from ..operators.dedupe import latest_per_key
from ..session import work_folder


def file_sink(path, fmt="parquet", partition_by=()):
    """Append to files, each row exactly once."""

    def finish(writer):
        writer = writer.outputMode("append").format(fmt).option("path", path)
        return writer.partitionBy(*partition_by) if partition_by else writer

    return finish


def kafka_rows(df, key=None, identity=None):
    """JSON messages. Kafka delivery is at least once: `record_id` lets readers drop repeats.

    `identity` names the columns that say which source records a row came from (see
    `sources.POSITION`); the id is their hash, so it is equal only for a message sent again. They
    are not part of the value. Without them a message has no id.
    """
    names = [c for c in df.columns if c not in (identity or ())]
    picked_key = F.col(key).cast("string") if key else F.lit(None).cast("string")
    out = [picked_key.alias("key"), json_row(names).alias("value")]
    if identity:
        place = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in identity])
        record_id = F.sha2(place, 256).cast("binary")
        header = F.struct(F.lit("record_id").alias("key"), record_id.alias("value"))
        out.append(F.array(header).alias("headers"))
    return df.select(*out)


def kafka_sink(servers, topic, **options):
    """Write `kafka_rows` to a topic. Needs the spark-sql-kafka package."""
    return lambda writer: (
        writer.outputMode("append")
        .format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("includeHeaders", "true")
        .options(**options)
    )


def run_of(df):
    """The streaming query that a micro-batch belongs to, the same for every restart from its
    checkpoint and another one for a new checkpoint; `none` outside a query."""
    return df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def batch_path(path, df, batch_id):
    """The folder of a micro-batch below `path`. A new checkpoint numbers its batches from 0 again,
    so the query is part of it."""
    return f"{path}/run={run_of(df)}/batch_id={batch_id}"


def batch_folders(path, fmt="parquet", shape=None):
    """Write each micro-batch to its own folder; a repeated batch replaces its folder."""

    def write(df, batch_id):
        out = shape(df) if shape else df
        out.write.mode("overwrite").format(fmt).save(batch_path(path, df, batch_id))

    return lambda writer: writer.outputMode("append").foreachBatch(write)


def enrich_once(transform, tables, path):
    """A sink for the first of two chained streams: each micro-batch goes to `transform` together with the
    tables that `tables` ({name: function without arguments}) gives at that moment, and the result to
    a folder of its own, from which `read_batches` streams on.

    A folder that is complete stays as it is when its batch is repeated, so the second stream, which
    may have read it already, sees every row once.
    """

    def write(df, batch_id):
        folder = batch_path(path, df, batch_id)
        if not exists(df.sparkSession, f"{folder}/_SUCCESS"):
            out = transform(df, **{name: table() for name, table in tables.items()})
            out.write.mode("overwrite").parquet(folder)

    return lambda writer: writer.outputMode("append").foreachBatch(write)


def read_batches(spark, path, schema):
    """The batches of `enrich_once` below `path` as a stream with the columns of `schema`, a StructType."""
    return spark.readStream.schema(schema).parquet(path).select(*schema.names)


def exists(spark, path):
    """Whether there is a file or folder, on whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def remove(spark, path):
    """Remove a file or folder, on whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def fan_out(branches):
    """Several outputs from one pass over each micro-batch.

    `branches` maps folders to transformations; a repeated batch replaces its folders. The batch is
    written once to the work folder and read by every branch, for a cache of it would take memory of the
    executors in proportion to the batch; what was written goes when the branches are done.
    """

    def write(df, batch_id):
        spark, folder = df.sparkSession, work_folder(df.sparkSession, "fan-out")
        try:
            df.write.parquet(folder)
            once = spark.read.schema(df.schema).parquet(folder)
            for path, transform in branches.items():
                out = transform(once)
                out.write.mode("overwrite").parquet(batch_path(path, df, batch_id))
        finally:
            remove(spark, folder)

    return lambda writer: writer.outputMode("append").foreachBatch(write)


def upsert_rows(changes, key, columns):
    """Keyed JSON with the latest image of each key; the value of a deleted key is null."""
    rows = changes.select(
        F.col("data")[key].alias("key"),
        *[F.col("data")[c].alias(c) for c in columns],
        "type", "ts", "offset",
    )
    last = latest_per_key(rows, ["key"], ("ts", "offset"))
    return last.select(
        "key", F.when(F.col("type") != "delete", json_row(columns)).alias("value")
    )
