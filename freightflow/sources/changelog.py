"""Reading the change log: from Kafka or files to typed envelopes."""

from pyspark.sql import functions as F

from ..functions import is_blank
from ..schemas import BUSINESS_DATABASE, CHANGE_TYPES, ENVELOPE

_BAD = "_bad"
#: Key in `data` that `parse_changes` puts the record's place in the source under.
POSITION = "_position"


def read_kafka(spark, servers, topic, **options):
    """A topic as (value, topic, partition, offset), from its start, committed records only.

    Needs the spark-sql-kafka package on the class path.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("kafka.isolation.level", "read_committed")
    )
    return (
        reader.options(**options)
        .load()
        .where("value IS NOT NULL")
        .select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset")
    )


def read_files(spark, path, streaming=True, **options):
    """Landed JSON lines as (value), as a stream or as a batch."""
    reader = spark.readStream if streaming else spark.read
    return reader.options(**options).text(path)


def _parsed(schema, options=None):
    """The fields of the JSON text as columns.

    A generator rather than a struct, because Catalyst would copy the parser into every
    expression that reads a field of the struct.
    """
    return F.inline(F.array(F.from_json("value", schema, options)))


def _envelope(raw, ts_unit="ms"):
    """Parsed fields with `ts` in milliseconds. Numbers in quotes count as numbers."""
    kinds = {f.name: f.dataType.simpleString() for f in ENVELOPE} | {"ts": "string", _BAD: "string"}
    schema = ", ".join(f"`{name}` {kind}" for name, kind in kinds.items())
    fields = _parsed(schema, {"columnNameOfCorruptRecord": _BAD})
    places = {c: f"_source_{c}" for c in ("topic", "partition", "offset") if c in raw.columns}
    rows = raw.select("value", *[F.col(c).alias(n) for c, n in places.items()], fields)
    if "offset" in places:
        rows = rows.withColumn("offset", F.coalesce(places["offset"], "offset"))
    scale = 1000 if ts_unit == "s" else 1
    stamp = F.col("ts").try_cast("bigint") * scale
    place = F.concat_ws(":", *[F.col(places[c]) for c in ("topic", "partition") if c in places], "offset")
    return rows.withColumns({"ts": stamp, "_place": place}).drop(*places.values())


def parse_changes(raw, tables=None, ts_unit="ms", positions=False):
    """Typed change envelopes; null, malformed and unnamed records are dropped.

    `ts_unit` is the unit of `ts` in the source, ms or s; envelopes have milliseconds. With `tables`, only
    changes of these. With `positions`, `data` also has the record's place in the source under
    POSITION, which a builder passes on when it is named among its columns.
    """
    parsed = _envelope(raw.where("value IS NOT NULL"), ts_unit).where(
        f"{_BAD} IS NULL AND `database` IS NOT NULL AND `table` IS NOT NULL"
    )
    if positions:
        own = F.create_map(F.lit(POSITION), F.col("_place"))
        rest = F.map_filter(F.coalesce("data", F.create_map().cast("map<string,string>")),
                            lambda k, _: k != POSITION)
        parsed = parsed.withColumn("data", F.map_concat(rest, own))
    parsed = parsed.select(*ENVELOPE.fieldNames())
    return parsed.where(F.col("table").isin(*tables)) if tables else parsed


def reject_reason(raw, database=BUSINESS_DATABASE):
    """Every record with the reason for which cleaning drops it, or null when it is kept."""
    reason = (
        F.when(F.col("value").isNull(), "null_value")
        .when(F.col(_BAD).isNotNull(), "malformed")
        .when(~F.col("database").eqNullSafe(database), "other_database")
        .when(~F.coalesce(F.col("type").isin(*CHANGE_TYPES), F.lit(False)), "unsupported_type")
        .when(is_blank(F.col("table")) | F.col("ts").isNull(), "blank_field")
        .when(F.coalesce(F.size("data") <= 0, F.lit(True)), "empty_data")
    )
    return _envelope(raw).select("value", reason.alias("reason"))


def ods_table(raw, view=None, ts_unit="ms"):
    """Change envelopes with processing time `pt` and watermarked event time `et`.

    With `view` the result is also registered for SQL jobs.
    """
    df = (
        parse_changes(raw, ts_unit=ts_unit)
        .withColumn("pt", F.current_timestamp())
        .withColumn("et", F.timestamp_millis("ts"))
        .withWatermark("et", "1 millisecond")
    )
    if view:
        df.createOrReplaceTempView(view)
    return df


def read_once(messages, schema, within="1 day"):
    """Facts of messages that may come again, each once: `messages` are as `streaming.kafka_rows` made them,
    (key, value, headers). Repeats of a record id are dropped on a stream `within` that time after the first
    came, which bounds the state; the time of the facts plays no part, so none comes too late. A message
    without an id cannot be told from others and is kept."""
    named = F.filter("headers", lambda h: h["key"] == "record_id")
    ids = F.hex(F.get(named, 0)["value"])
    facts = messages.select(ids.alias("_id"), _parsed(schema)).where("ts IS NOT NULL")
    if not messages.isStreaming:
        names = [c for c in facts.columns if c != "_id"]
        once = facts.where("_id IS NOT NULL").groupBy("_id").agg(F.min(F.struct(*names)).alias("f")).select("f.*")
        return once.unionByName(facts.where("_id IS NULL").drop("_id"))
    own = F.coalesce("_id", F.uuid())
    timed = facts.withColumns({"_id": own, "_came": F.current_timestamp()}).withWatermark("_came", within)
    return timed.dropDuplicatesWithinWatermark(["_id"]).drop("_id", "_came")


def parse_facts(raw, schema):
    """JSON facts as typed rows; records that do not parse or have no `ts` are dropped."""
    return raw.select(_parsed(schema)).where("ts IS NOT NULL")
