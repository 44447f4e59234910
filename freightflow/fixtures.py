"""Change log, dimensions and configuration derived from the star-schema tables.

Every builder is one projection per source table (the only join is orders with the 25-row
nation table), so a test query costs one scan of the columns it needs.
"""

from functools import reduce

from pyspark.sql import functions as F

from .functions import json_row, whole_div
from .functions.time import DATETIME
from .schemas import BUSINESS_DATABASE, CONFIG_COLUMNS, CONFIG_EVENT, CONFIG_ROW, ENVELOPE

EPOCH = 1704067200  # 2024-01-01 00:00:00 UTC

PHASE_SECONDS = 86_400  # between the three phases of the dimension feed
LOAD_SECONDS = 30 * 86_400  # between old bounds and the initial load that brings them


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def big_table(spark, sf_dir, name):
    """A table that is spread over the cores when its files have fewer splits than that."""
    df = table(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _text(prefix, c):
    return F.concat(F.lit(prefix), F.col(c).cast("string"))


def _at(seconds):
    return F.date_format(F.timestamp_seconds(seconds), DATETIME)


def _compressed(key, per_second=10):
    return F.lit(EPOCH) + whole_div(key, per_second)


def _union(frames):
    return reduce(lambda a, b: a.unionByName(b), frames)


def _changes(df, name, kind, seconds, offset, data):
    pairs = [x for k, v in data.items() for x in (F.lit(k), v.cast("string"))]
    return df.select(
        F.lit(BUSINESS_DATABASE).alias("database"),
        F.lit(name).alias("table"),
        (kind if not isinstance(kind, str) else F.lit(kind)).alias("type"),
        (seconds * 1000).cast("bigint").alias("ts"),
        offset.cast("bigint").alias("offset"),
        F.create_map(*pairs).alias("data"),
        F.lit(None).cast("map<string,string>").alias("old"),
    )


def _lines(df, name, kind, seconds, offset, data):
    """(offset, value): the rows of `_changes` as the JSON text that `raw` makes of them, without a map
    in between, whose keys would be looked up and copied for every row."""
    fields = {"ts": (seconds * 1000).cast("bigint"), "offset": offset.cast("bigint")}
    numbers = [F.coalesce(F.concat(F.lit(f',"{k}":'), v.cast("string")), F.lit("")) for k, v in fields.items()]
    kind = kind if not isinstance(kind, str) else F.lit(kind)
    image = F.struct(*[v.cast("string").alias(k) for k, v in data.items()])
    # Of the envelope nulls are left out, of the row image they are written.
    text = F.concat(
        F.lit(f'{{"database":"{BUSINESS_DATABASE}","table":"{name}","type":"'), kind, F.lit('"'), *numbers,
        F.lit(',"data":'), F.to_json(image, {"ignoreNullFields": "false"}), F.lit("}"),
    )
    return df.select(fields["offset"].alias("offset"), F.explode(F.array(text)).alias("value"))


# ---------------------------------------------------------------- business tables


def _order_info(spark, sf, form=_changes):
    nation = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    df = big_table(spark, sf, "orders").join(
        nation, F.col("o_custkey") % 25 == F.col("n_nationkey"), "left"
    )
    created = _compressed("o_orderkey")
    status = (
        F.when(F.col("o_orderstatus") == "F", "60030")
        .when(F.col("o_orderstatus") == "O", "60050")
        .when(F.col("o_orderstatus") == "P", "60060")
    )
    kind = F.when(F.col("o_orderkey") % 5 == 0, "bootstrap-insert").otherwise("insert")
    return form(
        df, "order_info", kind, created, F.col("o_orderkey"),
        {
            "id": F.col("o_orderkey"),
            "order_no": _text("NO", "o_orderkey"),
            "status": status,
            "amount": F.col("o_totalprice"),
            "cargo_num": F.lit(1),
            "sender_city_id": F.concat(F.lit("C"), (F.col("o_custkey") % 25).cast("string")),
            "sender_province_id": _text("P", "n_regionkey"),
            "create_time": _at(created),
            "update_time": _at(created + 60),
        },
    )


def _order_cargo(spark, sf, form=_changes):
    created = _compressed("l_orderkey")
    return form(
        big_table(spark, sf, "lineitem"), "order_cargo", "insert", created, F.col("l_linenumber"),
        {
            "id": F.concat_ws("-", F.col("l_orderkey").cast("string"),
                              F.col("l_linenumber").cast("string")),
            "order_id": F.col("l_orderkey"),
            "cargo_type": F.concat(F.lit("K"), (F.col("l_partkey") % 6).cast("string")),
            "weight": F.col("l_quantity"),
            "volume_length": F.col("l_extendedprice"),
            "create_time": _at(created),
        },
    )


def _order_org_bound(spark, sf, form=_changes):
    moment = _compressed("l_orderkey") + F.col("l_linenumber")
    # Every fifth order's bounds are loaded a month after they were made.
    loaded = F.col("l_orderkey") % 5 == 0
    kind = F.when(loaded, "bootstrap-insert").otherwise("insert")
    arrived = moment + F.when(loaded, LOAD_SECONDS).otherwise(0)
    return form(
        big_table(spark, sf, "lineitem"), "order_org_bound", kind, arrived, F.col("l_orderkey"),
        {
            "id": F.concat_ws("-", F.col("l_orderkey").cast("string"),
                              F.col("l_linenumber").cast("string")),
            "order_id": F.col("l_orderkey"),
            "org_id": F.col("l_suppkey"),
            "status": F.when(F.col("l_linestatus") == "F", "64003").otherwise("64002"),
            "sort_time": _at(moment),
            "create_time": _at(moment),
            "outbound_emp_id": F.col("l_partkey") % 97,
            "inbound_emp_id": F.lit("7"),
            "inbound_time": _at(moment),
            "is_deleted": F.lit("0"),
        },
    )


def _transport_task(spark, sf, form=_changes):
    start = _compressed("o_orderkey")
    end = start + 600 + F.col("o_orderkey") % 600
    status = (
        F.when(F.col("o_orderstatus") == "F", "67004")
        .when(F.col("o_orderstatus") == "O", "67003")
        .when(F.col("o_orderstatus") == "P", "67001")
    )
    finished = F.col("o_orderstatus") != "P"
    org = F.col("o_custkey") % 10
    return form(
        big_table(spark, sf, "orders"), "transport_task", "update",
        F.when(finished, end).otherwise(start), F.col("o_orderkey"),
        {
            "id": _text("T", "o_orderkey"),
            "shift_id": F.col("o_orderkey") % 3,
            "line_id": F.col("o_orderkey") % 7,
            "status": status,
            "order_num": F.col("o_orderkey") % 4,
            "truck_id": F.col("o_custkey"),
            "start_org_id": org,
            "start_org_name": F.concat(F.lit("ORG"), org.cast("string")),
            "end_org_id": (F.col("o_custkey") + 1) % 10,
            "end_org_name": F.concat(F.lit("ORG"), ((F.col("o_custkey") + 1) % 10).cast("string")),
            "actual_distance": F.floor(F.col("o_totalprice") / 10) / 100,
            "actual_start_time": _at(start),
            "actual_end_time": F.when(finished, _at(end)),
            "update_time": _at(F.when(finished, end).otherwise(start)),
        },
    )


def _transport_task_detail(spark, sf, form=_changes):
    moment = _compressed("l_orderkey") + F.col("l_linenumber")
    kind = F.when(F.col("l_returnflag") == "N", "insert").otherwise("update")
    return form(
        big_table(spark, sf, "lineitem"), "transport_task_detail", kind, moment, F.col("l_orderkey"),
        {
            "id": F.concat_ws("-", F.col("l_orderkey").cast("string"),
                              F.col("l_linenumber").cast("string")),
            "order_id": F.col("l_orderkey"),
            "transport_task_id": _text("T", "l_orderkey"),
            "create_time": _at(moment),
            "operate_time": _at(moment + 30),
        },
    )


def _express(spark, sf, form, name, time_column, done, other, extra=()):
    """`done` and `other` are (event type, status) pairs."""
    df = big_table(spark, sf, "events").where(F.col("event_type").isin(done[0], other[0]))
    moment = _compressed("event_id")
    data = {
        "id": F.col("event_id"),
        "org_id": F.col("user_id") % 10,
        "order_id": F.col("event_id") * 3,
        "courier_id": F.col("user_id"),
        "status": F.when(F.col("event_type") == done[0], done[1]).otherwise(other[1]),
        time_column: _at(moment),
    }
    data.update({c: _at(moment) for c in extra})
    return form(df, name, "update", moment, F.col("event_id"), data)


def _express_task_collect(spark, sf, form=_changes):
    return _express(
        spark, sf, form, "express_task_collect", "actual_collected_time",
        ("click", "63003"), ("view", "63001"),
        ("create_time", "update_time", "estimated_commit_time", "estimated_collected_time"),
    )


def _express_task_delivery(spark, sf, form=_changes):
    return _express(
        spark, sf, form, "express_task_delivery", "delivered_time",
        ("purchase", "68003"), ("signup", "68001"),
    )


BUSINESS_TABLES = {
    "order_info": _order_info,
    "order_cargo": _order_cargo,
    "order_org_bound": _order_org_bound,
    "transport_task": _transport_task,
    "transport_task_detail": _transport_task_detail,
    "express_task_collect": _express_task_collect,
    "express_task_delivery": _express_task_delivery,
}


def changelog(spark, sf_dir, names=tuple(BUSINESS_TABLES)):
    """Parsed change log. A filter on `table` prunes the branches it excludes."""
    return _union([BUSINESS_TABLES[n](spark, sf_dir) for n in names])


def raw(changes, *columns):
    """The change log as JSON text, the way it arrives from the source topic; `columns` are kept besides.

    From a generator, so that filters on the text do not write it a second time.
    """
    return changes.select(*columns, F.explode(F.array(json_row(ENVELOPE.fieldNames()))).alias("value"))


def last_change(spark):
    """One change of the far future, an order without cargos or bounds, which moves every clock on."""
    far = F.lit(4102444800)
    data = {"id": F.lit("last"), "amount": F.lit("0"), "cargo_num": F.lit("0"), "create_time": _at(far)}
    return _changes(spark.range(1), "order_info", "insert", far, F.lit(0), data)


def changelog_lines(spark, sf_dir, names=tuple(BUSINESS_TABLES)):
    """`raw` of `changelog` with the offsets: (offset, value), written table by table."""
    return _union([BUSINESS_TABLES[n](spark, sf_dir, _lines) for n in names])


def dirty_raw(changes):
    """JSON text in which fixed residues of `offset` are spoiled, to exercise rejection."""
    return dirty_lines(raw(changes, "offset"))


def dirty_lines(lines):
    """`dirty_raw` of lines that are written already, (offset, value)."""
    text, database = F.col("value"), F.lit(f'"{BUSINESS_DATABASE}"')
    spoiled = {
        13: F.substring(text, 1, 20),
        17: F.lit("[]"),
        19: F.replace(text, database, F.lit('"other"')),
        23: F.regexp_replace(text, '"data":[{][^}]*[}]', '"data":{}'),
        29: F.replace(text, F.lit('"type":"'), F.lit('"type":"x-')),
        31: F.regexp_replace(text, '"table":"[a-z_]*",', ""),
        37: F.lit(None).cast("string"),
    }
    value = F
    for residue, bad in spoiled.items():
        value = value.when(F.col("offset") % residue == residue - 1, bad)
    return lines.select(F.explode(F.array(value.otherwise(text))).alias("value"))


# ---------------------------------------------------------------- dimensions


def base_region_info(spark, sf):
    region, nation = table(spark, sf, "region"), table(spark, sf, "nation")

    def level(df, id_, parent, name, code):
        return df.select(
            id_.alias("id"), parent.alias("parent_id"), name.alias("name"),
            F.lit(code).alias("dict_code"),
        )

    return _union([
        level(region, _text("P", "r_regionkey"), F.lit("86"), F.col("r_name"), "Province"),
        level(nation, _text("C", "n_nationkey"), _text("P", "n_regionkey"),
              F.col("n_name"), "City"),
        *[level(nation, _text(here, "n_nationkey"), _text(above, "n_nationkey"),
                F.concat("n_name", F.lit(f"_{here}")), "District" if here == "D" else "Street")
          for above, here in zip("CDEFG", "DEFGH")],
    ])


def base_organ(spark, sf):
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id"),
        F.col("s_name").alias("org_name"),
        _text("H", "s_nationkey").alias("region_id"),
    )


def base_dic(spark, sf):
    kinds = table(spark, sf, "part").select((F.col("p_partkey") % 6).alias("k")).distinct()
    return kinds.select(_text("K", "k").alias("id"), _text("cargo ", "k").alias("name"))


def truck_info(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.when(F.col("p_partkey") % 50 != 7, F.col("p_brand")).alias("truck_model_id"),
    )


def truck_model(spark, sf):
    return table(spark, sf, "part").select("p_brand").distinct().select(
        F.col("p_brand").alias("id"),
        F.when(F.col("p_brand") < "Brand#2", "S").otherwise("L").alias("model_type"),
        F.col("p_brand").alias("model_name"),
    )


DIMENSIONS = {
    "base_region_info": (base_region_info, "name"),
    "base_organ": (base_organ, "org_name"),
    "base_dic": (base_dic, "name"),
    "truck_info": (truck_info, "truck_model_id"),
    "truck_model": (truck_model, "model_name"),
}


def dimension_changes(spark, sf_dir, names=tuple(DIMENSIONS)):
    """Change feed of the dimensions, in three phases: load, rename, delete.

    The number inside a row's id says which phases it takes part in (7 renames, 11 deletes).
    """
    feeds = []
    for name in names:
        build, label = DIMENSIONS[name]
        df = build(spark, sf_dir)
        number = F.regexp_extract(F.col("id"), "([0-9]+)$", 1).cast("bigint")
        phases = F.filter(
            F.array(
                F.struct(F.lit(0).alias("phase"), F.lit("bootstrap-insert").alias("kind")),
                F.when(F.col("n") % 7 == 0,
                       F.struct(F.lit(1).alias("phase"), F.lit("update").alias("kind"))),
                F.when(F.col("n") % 11 == 0,
                       F.struct(F.lit(2).alias("phase"), F.lit("delete").alias("kind"))),
            ),
            lambda p: p.isNotNull(),
        )
        rows = df.withColumn("n", number).withColumn("p", F.explode(phases))
        renamed = F.when(F.col("p.phase") >= 1, F.concat(F.col(label), F.lit("_v2")))
        data = {c: F.col(c) for c in df.columns}
        data[label] = F.coalesce(renamed, F.col(label))
        moment = F.lit(EPOCH) + F.col("n") + F.col("p.phase") * PHASE_SECONDS
        offset = F.col("n") * 3 + F.col("p.phase")
        feeds.append(_changes(rows, name, F.col("p.kind"), moment, offset, data))
    return _union(feeds)


def truck_changes(spark, sf_dir, renamed, deleted):
    """The change feed of the trucks: all are loaded, then every seventh gets another model at `renamed`
    and every eleventh is deleted at `deleted`, both in seconds."""
    phases = F.filter(
        F.array(
            F.struct(F.lit(EPOCH).cast("bigint").alias("at"), F.lit("bootstrap-insert").alias("kind")),
            F.when(F.col("p_partkey") % 7 == 0,
                   F.struct(F.lit(renamed).cast("bigint").alias("at"), F.lit("update").alias("kind"))),
            F.when(F.col("p_partkey") % 11 == 0,
                   F.struct(F.lit(deleted).cast("bigint").alias("at"), F.lit("delete").alias("kind"))),
        ),
        lambda p: p.isNotNull(),
    )
    rows = table(spark, sf_dir, "part").withColumn("p", F.explode(phases))
    model = F.when(F.col("p_partkey") % 50 != 7, F.col("p_brand"))
    later = F.when((F.col("p_partkey") % 7 == 0) & (F.col("p.kind") != "bootstrap-insert"), "_v2").otherwise("")
    return _changes(
        rows, "truck_info", F.col("p.kind"), F.col("p.at"), F.col("p_partkey"),
        {"id": F.col("p_partkey"), "truck_model_id": F.concat(model, later)},
    )


# ---------------------------------------------------------------- configuration

# Which columns of each dimension are kept.
_KEPT = {
    "base_region_info": "id,parent_id,name,dict_code",
    "base_organ": "id,org_name,region_id",
    "base_dic": "id,name",
    "truck_info": "id,truck_model_id,truck_no",
    "truck_model": "id,model_type,model_name",
}


def _config_row(name):
    return (name, "ALL", f"dim_{name}", "DIM", "info", _KEPT[name], "id")


def dimension_config(spark):
    """One configuration row per dimension of the fixture change feed."""
    return spark.createDataFrame([_config_row(t) for t in _KEPT], CONFIG_ROW)


def _image(source_table, kind, columns):
    values = {
        "source_table": source_table,
        "source_type": F.lit("ALL"),
        "sink_table": F.concat(F.lit("dim_"), source_table),
        "sink_type": kind,
        "sink_family": F.lit("info"),
        "sink_columns": columns,
        "sink_row_key": F.lit("id"),
    }
    return F.struct(*[values[c].alias(c) for c in CONFIG_COLUMNS])


def config_snapshot_table(spark, sf_dir):
    """A configuration table with one row per supplier; a third of them is not for DIM."""
    kind = F.when(F.col("s_suppkey") % 3 == 0, "FACT").otherwise("DIM")
    row = _image(_text("table_", "s_suppkey"), kind, F.lit("id,name"))
    return table(spark, sf_dir, "supplier").select(row.alias("r")).select("r.*")


def config_events(spark, sf_dir):
    """A configuration feed with one change event per row of `events`."""
    op = (
        F.when(F.col("event_type") == "signup", "c")
        .when(F.col("event_type") == "view", "r")
        .when(F.col("event_type") == "purchase", "d")
        .otherwise("u")
    )
    kind = F.when(F.col("event_id") % 4 == 3, "FACT").otherwise("DIM")
    columns = F.concat(F.lit("id,c"), F.col("event_id").cast("string"))
    here = _text("table_", "user_id")
    moved = F.concat(F.lit("table_"), (F.col("user_id") + 1).cast("string"))
    origin = F.when(F.col("event_id") % 10 == 0, moved).otherwise(here)
    df = big_table(spark, sf_dir, "events").withColumn("op", op)
    return df.select(
        "op",
        (F.lit(EPOCH * 1000) + F.col("event_id")).alias("ts_ms"),
        F.when(F.col("op").isin("u", "d"),
               _image(F.when(F.col("op") == "u", origin).otherwise(here), kind, columns)
               ).alias("before"),
        F.when(F.col("op") != "d", _image(here, kind, columns)).alias("after"),
        F.col("event_id").cast("bigint").alias("seq"),
    )


def lifecycle_events(spark):
    """Configuration events, all of one moment a year after the load and ordered by their position
    only: five tables are announced, one is emptied, one dropped, one dropped and made again."""
    config = {t: _config_row(t) for t in _KEPT}
    later = (EPOCH + 365 * 86_400) * 1000
    events = [("r", None, row) for row in config.values()]
    events.append(("u", config["base_organ"], config["base_organ"]))
    events.append(("d", config["truck_model"], None))
    events.append(("d", config["truck_info"], None))
    events.append(("c", None, config["truck_info"]))
    rows = [(op, later, before, after, seq) for seq, (op, before, after) in enumerate(events)]
    return spark.createDataFrame(rows, CONFIG_EVENT)


def lifecycle_changes(spark, sf_dir):
    """The dimension feed with the position in the configuration feed at which a change came: the
    load before or after the tables were announced, all later changes after all events."""
    feed = dimension_changes(spark, sf_dir)
    announced = F.when(F.col("offset") % 2 == 1, len(_KEPT) - 1)
    seen = F.when(F.col("type") == "bootstrap-insert", announced).otherwise(len(_KEPT) + 3)
    return feed.withColumn("config_seq", seen)
