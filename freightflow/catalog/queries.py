"""Registered queries: each takes a session and the folder of the tables."""

from functools import reduce

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixtures as fx
from .. import functions as fn
from ..functions.time import DATETIME
from ..operators import (
    apply_changes,
    clean,
    count_types,
    first_per_key,
    flatten_regions,
    join_region,
    keep_current_epoch,
    key_changes,
    project_columns,
    route,
    versions,
    window_rollup,
)
from ..operators.rollup import STAMPS
from ..plans import facts, rollups
from ..schemas import CARGO_COLUMNS, FACTS, REGION_ATTRIBUTES, ROLLUP_COLUMNS
from ..session import work_folder
from ..sources import (
    DimensionStore,
    config_epochs,
    config_feed,
    config_snapshot,
    dic_lookup,
    ods_table,
    parse_changes,
    parse_facts,
    POSITION,
    read_files,
    read_once,
    reject_reason,
)
from ..streaming import (
    DimensionJob,
    enrich_latest,
    fan_out,
    file_sink,
    join_sink,
    lookup_latest,
    replay,
    run_stream,
    upsert_rows,
    upsert_sink,
)
from ..streaming import (
    attach_sink,
    enrich_once,
    kafka_rows,
    pair_sink,
    read_batches,
    read_open,
    read_windows,
    run_sql_stream,
    run_supervised,
    window_sink,
    windows_to,
)
from ..streaming.pairing import put
from ..streaming.replay import land, time_slices

QUERIES = {}

# Session settings that the results or the plans depend on.
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A write by table or arrival keeps its few files open rather than sort the rows for them.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def query(build):
    """Register `build`, to run in a copy of the caller's session that has the settings."""

    def run(spark, sf_dir):
        own = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
        for key, value in _SETTINGS.items():
            own.conf.set(key, value)
        return build(own, sf_dir)

    QUERIES[build.__name__.removesuffix("_query")] = run
    return run


def _data(*names):
    return [F.col("data")[n].alias(n) for n in names]


def _rounded(df, *names):
    """Sums of doubles depend on their order in the last digits; two decimals do not."""
    return df.withColumns({n: F.round(n, 2) for n in names})


# ---------------------------------------------------------------- change log


@query
def ods_change_table(spark, sf):
    ods = ods_table(fx.changelog_lines(spark, sf).select("value"))
    return ods.select(
        "database", "table", "type", "ts", "offset",
        F.date_format("et", DATETIME).alias("et"),
        F.col("pt").isNotNull().alias("has_pt"),
        *_data("id", "status", "create_time"),
        F.size("data").cast("bigint").alias("fields"),
    )


@query
def change_type_counts(spark, sf):
    return count_types(fx.changelog(spark, sf))


@query
def rejected_rows(spark, sf):
    dirty = fx.dirty_lines(fx.changelog_lines(spark, sf))
    reasons = reject_reason(dirty).where("reason IS NOT NULL")
    return reasons.groupBy("reason").agg(F.count("*").alias("rejected"))


@query
def dim_clean(spark, sf):
    dirty = fx.dirty_lines(fx.changelog_lines(spark, sf))
    return clean(parse_changes(dirty)).select("table", "type", "ts", "offset", *_data("id"))


@query
def split_cargo_and_info(spark, sf):
    changes = fx.changelog(spark, sf, ["order_info", "order_cargo"])
    cargo, orders = facts.split_cargo_and_info(changes)
    return cargo.withColumn("branch", F.lit("order_cargo")).unionByName(
        orders.withColumn("branch", F.lit("order_info")), allowMissingColumns=True
    )


@query
def split_bound_and_info(spark, sf):
    changes = fx.changelog(spark, sf, ["order_info", "order_org_bound"])
    bounds, orders = facts.split_bound_and_info(changes)
    return bounds.withColumn("branch", F.lit("order_org_bound")).unionByName(
        orders.withColumn("branch", F.lit("order_info")), allowMissingColumns=True
    )


@query
def fn_time(spark, sf):
    """All time functions over the change times of the orders."""
    orders = fx.changelog(spark, sf, ["order_info"]).select("ts", *_data("create_time"))
    day, moment = fn.ms_to_date("ts"), fn.ms_to_datetime("ts")
    clock = fn.number_to_clock(F.col("ts") % 200_000_000, "milliseconds")
    return orders.select(
        "ts",
        day.alias("day"),
        moment.alias("moment"),
        fn.date_to_ms(day).alias("day_ms"),
        fn.datetime_to_ms("create_time").alias("moment_ms"),
        clock.alias("clock"),
        fn.number_to_clock(F.col("ts") % 200_000).alias("clock_s"),
        fn.clock_to_number(clock).alias("clock_seconds"),
        fn.clock_to_number(clock, "milliseconds").alias("clock_ms"),
        fn.clock_to_number(day).isNull().alias("day_is_no_clock"),
    )


# ---------------------------------------------------------------- dimensions


@query
def dim_config_feed(spark, sf):
    return config_feed(fx.config_events(spark, sf))


@query
def dim_config_snapshot(spark, sf):
    return config_snapshot(fx.config_snapshot_table(spark, sf))


def _routed(spark, sf):
    changes = fx.dimension_changes(spark, sf).unionByName(
        fx.changelog(spark, sf, ["order_info"])
    )
    return route(clean(changes), config_snapshot(fx.dimension_config(spark)))


@query
def dim_route(spark, sf):
    return _routed(spark, sf).select(
        "source_table", "sink_table", "type", "ts", "offset", *_data("id")
    )


def _flat_image(df):
    """The row image as text, because maps have no order to compare by."""
    values = F.transform(F.map_values("image"), lambda v: F.coalesce(v, F.lit("~")))
    return df.select(
        "sink_table", "row_key",
        F.array_join(F.map_keys("image"), ",").alias("columns"),
        F.array_join(values, "|").alias("values"),
    )


@query
def dim_project_columns(spark, sf):
    return _flat_image(project_columns(_routed(spark, sf)))


@query
def dim_apply_changes(spark, sf):
    """The organisations after the load, then all later changes in one batch."""
    feed = fx.dimension_changes(spark, sf, ["base_organ"])
    config = config_snapshot(fx.dimension_config(spark))
    names = ["id", "org_name", "region_id", "ts"]

    def last(rows):
        projected = project_columns(route(clean(rows), config))
        columns = [F.col("image")[n].alias(n) for n in names]
        return key_changes(projected).select(*columns, F.col("image")["type"].alias("type"))

    loaded = last(feed.where("type = 'bootstrap-insert'")).select(*names)
    return apply_changes(loaded, last(feed.where("type <> 'bootstrap-insert'")), "id")


@query
def dim_table_lifecycle(spark, sf):
    """All five dimensions after their configuration changed, with a log that also has other tables."""
    events = fx.lifecycle_events(spark)
    changes = fx.lifecycle_changes(spark, sf).unionByName(
        fx.changelog(spark, sf, ["order_info"]), allowMissingColumns=True
    )
    current = keep_current_epoch(clean(changes), config_epochs(events))
    projected = project_columns(route(current, config_feed(events)))
    return _flat_image(key_changes(projected).where("type <> 'delete'"))


@query
def dim_snapshot(spark, sf):
    """Organisations written to the dimension store in two versions and read back."""
    store = DimensionStore(spark, work_folder(spark, "dim_snapshot"))
    organ = fx.base_organ(spark, sf)
    schema = organ.schema.simpleString()[7:-1].replace(":", " ")
    store.write("dim_base_organ", organ, 0)
    newer = store.read("dim_base_organ", schema).withColumn(
        "org_name", F.concat("org_name", F.lit("_v2"))
    )
    store.write("dim_base_organ", newer, 1)
    return store.read("dim_base_organ", schema)


@query
def upsert_latest_by_key(spark, sf):
    changes = fx.dimension_changes(spark, sf, ["truck_info"])
    return upsert_rows(changes, "id", ["id", "truck_model_id"])


@query
def dic_lookup_table(spark, sf):
    """SQL join with the nested dictionary, per cargo."""
    dic_lookup(fx.base_dic(spark, sf), "dim_dic")
    facts.cargo_inserts(fx.changelog(spark, sf, ["order_cargo"])).createOrReplaceTempView("cargo")
    return spark.sql(
        "SELECT order_id, cargo_type, d.info.dic_name AS dic_name "
        "FROM cargo LEFT JOIN dim_dic d ON cargo.cargo_type = d.id"
    )


@query
def dim_region_flat(spark, sf):
    return flatten_regions(fx.base_region_info(spark, sf))


@query
def join_region_query(spark, sf):
    return join_region(fx.base_organ(spark, sf), fx.base_region_info(spark, sf))


# ---------------------------------------------------------------- facts


def _log(spark, sf, *names):
    return fx.changelog(spark, sf, names)


def _organ(spark, sf):
    return fx.base_organ(spark, sf), fx.base_region_info(spark, sf)


@query
def dwd_order_status(spark, sf):
    return facts.order_status(_log(spark, sf, "order_info"))


@query
def dwd_express_pickup(spark, sf):
    return facts.express_pickup(_log(spark, sf, "express_task_collect"), *_organ(spark, sf))


@query
def dwd_express_deliver(spark, sf):
    return facts.express_deliver(_log(spark, sf, "express_task_delivery"), *_organ(spark, sf))


@query
def dwd_express_sorting(spark, sf):
    return facts.express_sorting(_log(spark, sf, "order_org_bound"), *_organ(spark, sf))


@query
def dwd_truck_task(spark, sf):
    return facts.truck_task(_log(spark, sf, "transport_task"))


@query
def dwd_trade_order_cargo(spark, sf):
    return facts.trade_order_cargo(_log(spark, sf, "order_info", "order_cargo"))


@query
def dwd_trade_order_org(spark, sf):
    return facts.trade_order_org(_log(spark, sf, "order_info", "order_org_bound"))


@query
def transport_task_finished(spark, sf):
    return facts.transport_task_finished(_log(spark, sf, "transport_task"))


@query
def transport_task_detail_updates(spark, sf):
    return facts.transport_task_detail_updates(_log(spark, sf, "transport_task_detail"))


@query
def dwd_transport_task_detail(spark, sf):
    return facts.transport_task_detail(
        _log(spark, sf, "transport_task", "transport_task_detail")
    )


# ---------------------------------------------------------------- rollups


@query
def window_rollup_generic(spark, sf):
    """Bounds by status in one-minute windows with the organisation that came first."""
    bounds = facts.bound_inserts(_log(spark, sf, "order_org_bound"))
    return window_rollup(
        bounds, ["status"], count="bounds", sums={"org_sum": fn.as_long("org_id")},
        firsts=["org_id", "order_id"], window="1 minute",
    )


@query
def dws_order_status(spark, sf):
    return rollups.order_status_count(dwd_order_status(spark, sf))


@query
def dws_transport_total(spark, sf):
    return _rounded(rollups.transport_total(dwd_truck_task(spark, sf)), "trans_distance")


@query
def dws_transport_org(spark, sf):
    out = rollups.transport_org(dwd_truck_task(spark, sf), *_organ(spark, sf))
    return _rounded(out, "trans_distance")


@query
def dws_transport_truck(spark, sf):
    out = rollups.transport_truck(
        dwd_truck_task(spark, sf), fx.truck_info(spark, sf), fx.truck_model(spark, sf)
    )
    return _rounded(out, "trans_distance")


@query
def dws_trade_order_cargo(spark, sf):
    out = rollups.trade_order_cargo(dwd_trade_order_cargo(spark, sf), fx.base_dic(spark, sf))
    return _rounded(out, "total_amount")


@query
def dws_trade_order_city(spark, sf):
    out = rollups.trade_order_city(
        dwd_trade_order_cargo(spark, sf), fx.base_region_info(spark, sf)
    )
    return _rounded(out, "total_amount")


@query
def dws_trade_order_org(spark, sf):
    out = rollups.trade_order_org(dwd_trade_order_org(spark, sf), fx.base_organ(spark, sf))
    return _rounded(out, "amount")


@query
def dws_express_pickup(spark, sf):
    return rollups.express(dwd_express_pickup(spark, sf), "pickup")


@query
def dws_express_sorting(spark, sf):
    return rollups.express(dwd_express_sorting(spark, sf), "sorting")


@query
def dws_express_deliver(spark, sf):
    return rollups.express(dwd_express_deliver(spark, sf), "deliver")


@query
def dws_json_rows(spark, sf):
    return rollups.json_rows(dws_express_pickup(spark, sf))


# ---------------------------------------------------------------- streams


def _partitions(spark):
    """Streams do not merge small shuffle partitions, so they start with one per core."""
    return min(
        int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    )


def _replay(spark, name, arrivals, transform, sink=None, keep=True):
    """Run `transform` over raw arrivals and give what its sink wrote."""
    root = work_folder(spark, name)
    source, out = f"{root}/in", f"{root}/out"

    def start():
        return run_stream(
            name, read_files(spark, source), transform, sink(out) if sink else file_sink(out),
            f"{root}/checkpoint", available_now=True,
            state_partitions=_partitions(spark),
        )

    replay(arrivals, source, start, keep)
    return spark.read.parquet(out)


def _raw_slices(changes, count, late=None):
    return [fx.raw(s) for s in time_slices(changes, count, late=late)]


def _fact_lines(rows):
    return rows.select(fn.json_row(rows.columns).alias("value"))


def _picked(fact, *names):
    """The columns of a fact that a rollup needs; the parser skips the others in the text."""
    return T.StructType([FACTS[fact][n] for n in names])


def _stored(spark, name, df):
    """The table between two layers."""
    path = f"{work_folder(spark, name)}/table"
    df.write.parquet(path)
    return spark.read.parquet(path)


def _with_sentinel(spark, slices):
    """The last arrival also has a row of the far future, which closes all other windows."""
    lines = [_fact_lines(s) for s in slices]
    far = spark.range(1).select(F.lit('{"ts":4102444800000}').alias("value"))
    return [*lines[:-1], lines[-1].unionByName(far)]


@query
def ods_change_stream(spark, sf):
    """Landing the parsed log by table, so that later jobs read only the tables they need."""
    changes = fx.changelog(spark, sf)
    return _replay(
        spark, "ods_change_stream", _raw_slices(changes, 2),
        lambda raw: parse_changes(raw).select(
            "database", "table", "type", "ts", "offset", *_data("id", "status")
        ),
        lambda out: file_sink(out, partition_by=["table"]), keep=False,
    )


@query
def stream_fact_sink(spark, sf):
    """Truck tasks written as JSON lines, then read back as typed rows."""
    root = work_folder(spark, "stream_fact_sink")

    def start():
        return run_stream(
            "stream_fact_sink", read_files(spark, f"{root}/in"),
            lambda raw: _fact_lines(facts.truck_task(parse_changes(raw, ["transport_task"]))),
            file_sink(f"{root}/out", "text"), f"{root}/checkpoint", available_now=True,
            state_partitions=_partitions(spark),
        )

    replay(_raw_slices(_log(spark, sf, "transport_task"), 2), f"{root}/in", start)
    lines = read_files(spark, f"{root}/out", streaming=False)
    return parse_facts(lines, FACTS["dwd_transport_truck_task"])


@query
def stream_split(spark, sf):
    """One pass over the change log into two outputs."""
    root = work_folder(spark, "stream_split")
    sink = fan_out({
        f"{root}/cargo": lambda c: facts.split_cargo_and_info(c)[0],
        f"{root}/orders": lambda c: facts.split_cargo_and_info(c)[1],
    })
    changes = _log(spark, sf, "order_info", "order_cargo")

    def start():
        return run_stream(
            "stream_split", read_files(spark, f"{root}/in"), parse_changes, sink,
            f"{root}/checkpoint", available_now=True,
            state_partitions=_partitions(spark),
        )

    replay(_raw_slices(changes, 2), f"{root}/in", start, keep=False)
    cargo = spark.read.parquet(f"{root}/cargo").drop("run", "batch_id")
    orders = spark.read.parquet(f"{root}/orders").drop("run", "batch_id")
    return cargo.withColumn("branch", F.lit("order_cargo")).unionByName(
        orders.withColumn("branch", F.lit("order_info")), allowMissingColumns=True
    )


def _stream_rollup(spark, name, rows, fact, windows, named=None, dims=None, derived=None, picked=None):
    """A rollup of facts that arrive in two slices. The windows that a micro-batch closes get their
    names from the dimension store as it is then; the store is replaced between the arrivals, so a
    reader that held on to old files would fail. `picked` names the fields of the fact that the rollup
    reads, and alone are parsed; without it, all are."""
    root = work_folder(spark, name)
    store = DimensionStore(spark, f"{root}/store", keep_seconds=0)
    dims = dims or {}
    schemas = {n: d.schema.simpleString()[7:-1].replace(":", " ") for n, d in dims.items()}
    schema = _picked(fact, *picked) if picked else FACTS[fact]
    sink = enrich_latest(
        named or (lambda df: df), store, {n: (f"dim_{n}", schemas[n]) for n in dims}, f"{root}/out",
        derived,
    )

    def start():
        return run_stream(
            name, read_files(spark, f"{root}/in"), lambda raw: windows(parse_facts(raw, schema)),
            sink, f"{root}/checkpoint", available_now=True, state_partitions=_partitions(spark),
        )

    stored = _stored(spark, fact, rows)
    for lines in _with_sentinel(spark, time_slices(stored, 2)):
        for n, dim in dims.items():
            store.write(f"dim_{n}", dim)
        replay([lines], f"{root}/in", start)
    out = spark.read.parquet(f"{root}/out").drop("run", "batch_id")
    return out.where("stt < '2100-01-01'")  # without the window of the sentinel


@query
def stream_dws_order_status(spark, sf):
    return _stream_rollup(
        spark, "stream_dws_order_status", dwd_order_status(spark, sf), "dwd_order_status_count",
        rollups.order_status_count,
    )


@query
def stream_dws_transport_total(spark, sf):
    out = _stream_rollup(
        spark, "stream_dws_transport_total", dwd_truck_task(spark, sf), "dwd_transport_truck_task",
        rollups.transport_total,
    )
    return _rounded(out, "trans_distance")


@query
def stream_dws_transport_org(spark, sf):
    organ, regions = _organ(spark, sf)
    out = _stream_rollup(
        spark, "stream_dws_transport_org", dwd_truck_task(spark, sf), "dwd_transport_truck_task",
        rollups.transport_org_windows, rollups.transport_org_named,
        {"organ": organ, "regions": regions}, {"regions": flatten_regions},
    )
    return _rounded(out, "trans_distance")


@query
def stream_dws_transport_truck(spark, sf):
    """Trucks get another model, or are deleted, between two arrivals of their transports. The log of the
    trucks is landed, a first job gives each fact the model of its time, a second one has the windows.
    """
    root = work_folder(spark, "stream_dws_transport_truck")
    facts_ = _stored(spark, "dwd_truck_task", dwd_truck_task(spark, sf))
    low, high = facts_.agg(F.min("ts"), F.max("ts")).first()
    if low is None:
        return dws_transport_truck(spark, sf)
    renamed, deleted = (low + high) // 2000, (low + 3 * high) // 4000
    log = fx.truck_changes(spark, sf, renamed, deleted)
    loaded = F.col("type") == "bootstrap-insert"
    schema = FACTS["dwd_transport_truck_task"]
    models = fx.truck_model(spark, sf)
    store = DimensionStore(spark, f"{root}/store")
    store.write("dim_truck_model", models)
    names = {"truck_model": ("dim_truck_model", models.schema.simpleString()[7:-1].replace(":", " "))}
    keyed_schema = T.StructType([*schema.fields, T.StructField("truck_mode_id", T.StringType())])

    def trucks():
        return versions(clean(spark.read.parquet(f"{root}/log")), "truck_info", ["truck_model_id"])

    def start(name, source, transform, sink):
        return run_stream(
            name, source, transform, sink, f"{root}/{name}-checkpoint", available_now=True,
            state_partitions=_partitions(spark),
        )

    def landing():
        return start("truck_log", read_files(spark, f"{root}/trucks"), parse_changes, file_sink(f"{root}/log"))

    def keying():
        return start(
            "truck_keys", read_files(spark, f"{root}/in"), lambda raw: raw,
            enrich_once(
                lambda raw, history: rollups.transport_truck_keyed(parse_facts(raw, schema), history),
                {"history": trucks}, f"{root}/keyed",
            ),
        )

    def windows():
        return start(
            "truck_windows", read_batches(spark, f"{root}/keyed", keyed_schema),
            rollups.transport_truck_windows,
            enrich_latest(rollups.transport_truck_named, store, names, f"{root}/out"),
        )

    # Cut where the models change, so that no fact comes before the change that it falls under.
    before = F.col("ts") < renamed * 1000
    cut = [facts_.where(before), facts_.where(~before)]
    arrivals = zip((log.where(loaded), log.where(~loaded)), _with_sentinel(spark, cut), strict=True)
    for changes, lines in arrivals:
        replay([fx.raw(changes)], f"{root}/trucks", landing)
        replay([lines], f"{root}/in", keying)
        windows().awaitTermination()
    out = spark.read.parquet(f"{root}/out").drop("run", "batch_id").where("stt < '2100-01-01'")
    return _rounded(out, "trans_distance")


@query
def stream_dws_trade_order_cargo(spark, sf):
    out = _stream_rollup(
        spark, "stream_dws_trade_order_cargo", dwd_trade_order_cargo(spark, sf),
        "dwd_trade_order_cargo", rollups.trade_order_cargo_windows, rollups.trade_order_cargo_named,
        {"dic": fx.base_dic(spark, sf)},
    )
    return _rounded(out, "total_amount")


@query
def stream_dws_trade_order_city(spark, sf):
    # Of every fact, the fields that the rollup reads; the others would be sorted, stored and parsed in vain.
    names = ("ts", "sender_city_id", "sender_province_id", "amount")
    orders = facts.trade_order_cargo(
        _log(spark, sf, "order_info", "order_cargo"), columns=("order_id", "create_time"), order_columns=names[1:]
    )
    out = _stream_rollup(
        spark, "stream_dws_trade_order_city", orders.select(*names), "dwd_trade_order_cargo",
        rollups.trade_order_city_windows, rollups.trade_order_city_named,
        {"regions": fx.base_region_info(spark, sf)}, picked=names,
    )
    return _rounded(out, "total_amount")


@query
def stream_dws_trade_order_org(spark, sf):
    out = _stream_rollup(
        spark, "stream_dws_trade_order_org", dwd_trade_order_org(spark, sf), "dwd_trade_order_org",
        rollups.trade_order_org_windows, rollups.trade_order_org_named,
        {"organ": fx.base_organ(spark, sf)},
    )
    return _rounded(out, "amount")


@query
def stream_dws_express_pickup(spark, sf):
    return _stream_rollup(
        spark, "stream_dws_express_pickup", dwd_express_pickup(spark, sf), "dwd_express_pickup",
        lambda facts: rollups.express(facts, "pickup"),
    )


@query
def stream_dws_express_deliver(spark, sf):
    return _stream_rollup(
        spark, "stream_dws_express_deliver", dwd_express_deliver(spark, sf), "dwd_express_deliver",
        lambda facts: rollups.express(facts, "deliver"),
    )


@query
def stream_restart(spark, sf):
    """Sorting rollup over three runs that resume one another, with the open windows in a table: there are
    almost as many windows as rows, too many to pass each through a state store."""
    root = work_folder(spark, "stream_restart")
    firsts = ["org_name", *REGION_ATTRIBUTES]
    schema = _picked("dwd_express_sorting", "ts", "org_id", *firsts)

    def start():
        return run_stream(
            "stream_restart", read_files(spark, f"{root}/in"), lambda raw: parse_facts(raw, schema),
            window_sink(root, ["org_id"], count="count", firsts=firsts), f"{root}/checkpoint",
            available_now=True, state_partitions=_partitions(spark),
        )

    stored = _stored(spark, "dwd_express_sorting", dwd_express_sorting(spark, sf))
    replay(_with_sentinel(spark, time_slices(stored, 3)), f"{root}/in", start)
    columns = ROLLUP_COLUMNS["dws_express_sorting_view_window"]
    return spark.read.parquet(f"{root}/out").select(*STAMPS, *columns)


@query
def stream_late_rows(spark, sf):
    """Per window, the rows a stream counted and those it dropped because they came late."""
    rows = dwd_order_status(spark, sf)
    number = F.substring("order_no", 3, 20).cast("bigint")
    slices = time_slices(rows, 3, late=number % 17 == 0)
    counted = _replay(
        spark, "stream_late_rows", _with_sentinel(spark, slices),
        lambda raw: window_rollup(
            parse_facts(raw, FACTS["dwd_order_status_count"]), count="counted"
        ),
    ).select("stt", "counted")
    total = window_rollup(rows, count="total").select("stt", "total")
    counted_here = F.coalesce("counted", F.lit(0))
    return total.join(counted, "stt", "left").select(
        "stt", counted_here.alias("counted"), (F.col("total") - counted_here).alias("late")
    )


@query
def stream_late_rows_caught(spark, sf):
    """The rows that came after their window, themselves."""
    rows = dwd_order_status(spark, sf)
    number = F.substring("order_no", 3, 20).cast("bigint")
    root = work_folder(spark, "stream_late_rows_caught")

    def start():
        return run_stream(
            "stream_late_rows_caught", read_files(spark, f"{root}/in"),
            lambda raw: parse_facts(raw, FACTS["dwd_order_status_count"]),
            window_sink(root, ["status"], count="orders"), f"{root}/checkpoint", available_now=True,
            state_partitions=_partitions(spark),
        )

    slices = time_slices(_stored(spark, "dwd_order_status", rows), 3, late=number % 17 == 0)
    replay([_fact_lines(s) for s in slices], f"{root}/in", start)
    return spark.read.parquet(f"{root}/late").select("order_no", "ts")


@query
def stream_dws_json_rows(spark, sf):
    """Pickups by organisation as they are loaded. The job loses its checkpoint after the first arrival and
    begins anew, so the windows it had written come again, and a batch of the second run fails once
    after it has written."""
    root = work_folder(spark, "stream_dws_json_rows")
    stored = _stored(spark, "dwd_express_pickup", dwd_express_pickup(spark, sf))
    failed = []

    def sink(writer):
        def once(write):
            def run(df, batch_id):
                write(df, batch_id)
                if len(failed) == 1:
                    failed.append(batch_id)
                    raise RuntimeError("after the write")

            return run

        class Failing:
            def outputMode(self, mode):
                return self

            def foreachBatch(self, write):
                return writer.outputMode("append").foreachBatch(once(write))

        return windows_to(f"{root}/out")(Failing())

    def start(checkpoint):
        return lambda: run_stream(
            "stream_dws_json_rows", read_files(spark, f"{root}/in"),
            lambda raw: rollups.express(parse_facts(raw, FACTS["dwd_express_pickup"]), "pickup"), sink,
            f"{root}/{checkpoint}", available_now=True, state_partitions=_partitions(spark),
        )

    for lines, checkpoint in zip(_with_sentinel(spark, time_slices(stored, 2)), ("lost", "second"), strict=True):
        land(lines, f"{root}/in")
        run_supervised(start(checkpoint), pause=0)
        failed.append("next run")
    windows = read_windows(spark, f"{root}/out", ["org_id"]).where("stt < '2100-01-01'")
    return rollups.json_rows(windows)


@query
def stream_idle_source(spark, sf):
    """Changes of two tables by window. The deliveries fall silent after half of the time, and the windows
    of the pickups close all the same."""
    changes = _log(spark, sf, "express_task_collect", "express_task_delivery")
    root = work_folder(spark, "stream_idle_source")

    def start():
        return run_stream(
            "stream_idle_source", read_files(spark, f"{root}/in"), parse_changes,
            window_sink(root, ["table"], count="changes", source="table", idle_after_ms=1),
            f"{root}/checkpoint", available_now=True, state_partitions=_partitions(spark),
        )

    slices = time_slices(changes, 2)
    slices[1:] = [s.where("table = 'express_task_collect'") for s in slices[1:]]
    replay([fx.raw(s) for s in slices], f"{root}/in", start)
    return spark.read.parquet(f"{root}/out").select("stt", "edt", "table", "changes")


@query
def stream_sql_window(spark, sf):
    """Changes by table and window, by SQL over the view of the change log."""
    root = work_folder(spark, "stream_sql_window")
    changes = _log(spark, sf, "order_info", "transport_task")

    def start():
        view = ods_table(read_files(spark, f"{root}/in"))
        return run_sql_stream(
            "stream_sql_window", {"ods_db": view},
            "SELECT date_format(window.start, 'yyyy-MM-dd HH:mm:ss') AS stt, `table`, count(*) AS changes"
            " FROM ods_db GROUP BY window(et, '1 minute'), `table`",
            file_sink(f"{root}/out"), f"{root}/checkpoint", available_now=True,
            state_partitions=_partitions(spark),
        )

    slices = _raw_slices(changes, 2)
    replay([*slices[:-1], slices[-1].unionByName(fx.raw(fx.last_change(spark)))], f"{root}/in", start)
    return spark.read.parquet(f"{root}/out").where("stt < '2100-01-01'")


@query
def stream_supervised(spark, sf):
    """Truck tasks through a job whose second batch fails twice, once before and once after it has
    written, and is started again."""
    root = work_folder(spark, "stream_supervised")
    tries = {}

    def sink(writer):
        def write(df, batch_id):
            tries[batch_id] = tries.get(batch_id, 0) + 1
            if batch_id == 1 and tries[1] == 1:
                raise RuntimeError("before the write")
            put(df, f"{root}/out", df, batch_id)
            if batch_id == 1 and tries[1] == 2:
                raise RuntimeError("after the write")

        return writer.outputMode("append").foreachBatch(write)

    def start():
        return run_stream(
            "stream_supervised", read_files(spark, f"{root}/in"),
            lambda raw: facts.truck_task(parse_changes(raw, ["transport_task"])), sink,
            f"{root}/checkpoint", available_now=True, state_partitions=_partitions(spark),
        )

    for rows in _raw_slices(_log(spark, sf, "transport_task"), 2):
        land(rows, f"{root}/in")
        run_supervised(start, pause=0)
    return spark.read.parquet(f"{root}/out").drop("run", "batch_id")


@query
def stream_read_once(spark, sf):
    """Truck tasks from messages of which the first half is delivered twice."""
    root = work_folder(spark, "stream_read_once")
    log = fx.raw(_log(spark, sf, "transport_task")).withColumns({
        "topic": F.lit("ods"), "partition": F.lit(0), "offset": F.monotonically_increasing_id(),
    })
    changes = parse_changes(_stored(spark, "ods_messages", log), ["transport_task"], positions=True)
    columns = [POSITION, *FACTS["dwd_transport_truck_task"].names]
    rows = facts.truck_task(changes, columns=[POSITION])
    messages = _stored(spark, "fact_messages", kafka_rows(rows.select(*columns), identity=[POSITION]))

    def start():
        source = spark.readStream.schema(messages.schema).parquet(f"{root}/in")
        return run_stream(
            "stream_read_once", source, lambda m: read_once(m, FACTS["dwd_transport_truck_task"]),
            file_sink(f"{root}/out"), f"{root}/checkpoint", available_now=True,
            state_partitions=_partitions(spark),
        )

    first = F.pmod(F.hash("value"), F.lit(2)) == 0
    for part in (messages.where(first), messages):
        part.write.mode("append").parquet(f"{root}/in")
        start().awaitTermination()
    return spark.read.parquet(f"{root}/out")


def _odd_key(*names):
    """Changes that arrive one slice late in the join streams."""
    key = F.coalesce(*[F.col("data")[n] for n in names])
    return F.regexp_replace(key, "[^0-9]", "").cast("bigint") % 2 == 1


def _cargo_arrivals(spark, changes):
    """The whole log of orders and cargos in three arrivals. Every order's first cargo comes before
    its others, as a stream keeps the one it sees first, and after its order if that is odd."""
    orders, cargos = (changes.where(F.col("table") == t) for t in ("order_info", "order_cargo"))
    order, data = F.col("data")["order_id"], [F.col("data")[c] for c in CARGO_COLUMNS]
    first = Window.partitionBy(order).orderBy("ts", "offset", *data)
    late = F.when(F.row_number().over(first) > 1, 1).otherwise(0)
    odd = F.when(order.cast("bigint") % 2 == 1, 1).otherwise(0)
    numbered = cargos.withColumn("arrival", late + odd).unionByName(orders.withColumn("arrival", F.lit(0)))
    path = f"{work_folder(spark, 'cargo_arrivals')}/lines"
    lines = fx.raw(numbered, "arrival")  # written once, for the three arrivals to be read from
    lines.write.partitionBy("arrival").text(path, compression="lz4")
    written = spark.read.schema("value string, arrival int").text(path)
    return [written.where(F.col("arrival") == i).select("value") for i in range(3)]


def _cargo_pairs(spark, name, changes):
    """The folder that the pairs of orders and cargos, and what waits, were written to."""
    root = work_folder(spark, name)

    def start():
        return run_stream(
            name, read_files(spark, f"{root}/in"),
            lambda raw: facts.cargo_sides(parse_changes(raw, ["order_info", "order_cargo"])),
            pair_sink(root), f"{root}/checkpoint", available_now=True,
            state_partitions=_partitions(spark),
        )

    replay(_cargo_arrivals(spark, changes), f"{root}/in", start)
    return root


@query
def stream_trade_order_cargo(spark, sf):
    """Cargos of odd orders arrive after their order, in a later run."""
    changes = _log(spark, sf, "order_info", "order_cargo")
    root = _cargo_pairs(spark, "stream_trade_order_cargo", changes)
    return spark.read.parquet(f"{root}/out").drop("run", "batch_id")


def _order_number():
    """The number of the order that a change belongs to."""
    return F.coalesce(F.col("data")["order_id"], F.col("data")["id"]).cast("bigint")


@query
def stream_trade_order_cargo_open(spark, sf):
    """What waits at the end when some orders and the cargos of others never come: nothing else."""
    changes = _log(spark, sf, "order_info", "order_cargo")
    lost = F.when(F.col("table") == "order_info", 3).otherwise(7)
    root = _cargo_pairs(spark, "stream_trade_order_cargo_open", changes.where(_order_number() % 10 != lost))
    waiting = read_open(spark, root)
    side = F.when(F.col("one").isNull(), "order_cargo").otherwise("order_info")
    return waiting.select(side.alias("side"), F.col("key").alias("order_id"))


def _bound_pairs(spark, name, arrivals, keep_ms=None):
    """The folder that bounds with their orders, and what waits or expired, were written to."""
    root = work_folder(spark, name)

    def start():
        return run_stream(
            name, read_files(spark, f"{root}/in"),
            lambda raw: facts.org_sides(parse_changes(raw, ["order_info", "order_org_bound"])),
            attach_sink(root, keep_ms, compact=2), f"{root}/checkpoint", available_now=True,
            state_partitions=_partitions(spark),
        )

    replay(arrivals, f"{root}/in", start)
    return root


@query
def stream_trade_order_org(spark, sf):
    """Odd orders arrive after some of their bounds, in a later run."""
    changes = _log(spark, sf, "order_info", "order_org_bound")
    late = (F.col("table") == "order_info") & _odd_key("order_no")
    root = _bound_pairs(spark, "stream_trade_order_org", _raw_slices(changes, 2, late))
    return spark.read.parquet(f"{root}/out").drop("run", "batch_id")


@query
def stream_trade_order_org_expired(spark, sf):
    """Bounds given up, by order: every tenth order never comes, and its bounds wait for a year."""
    changes = _log(spark, sf, "order_info", "order_org_bound")
    lost = (F.col("table") == "order_info") & (_order_number() % 10 == 3)
    end = fx.raw(fx.last_change(spark))
    slices = _raw_slices(changes.where(~lost), 2)
    year = 365 * 86_400_000
    root = _bound_pairs(spark, "stream_trade_order_org_expired", [*slices, end], year)
    given_up = spark.read.parquet(f"{root}/expired").groupBy(F.col("key").alias("order_id"))
    return given_up.agg(F.count("*").alias("bounds"))


def _detail_pairs(spark, name, arrivals, shape, fmt="parquet"):
    """The folder that the details with their tasks were written to, as `shape` makes them."""
    root = work_folder(spark, name)

    def start():
        return run_stream(
            name, read_files(spark, f"{root}/in"),
            lambda raw: facts.detail_sides(parse_changes(raw, ["transport_task", "transport_task_detail"])),
            join_sink(root, shape=shape, fmt=fmt), f"{root}/checkpoint", available_now=True,
            state_partitions=_partitions(spark),
        )

    replay(arrivals, f"{root}/in", start)
    return f"{root}/out"


def _in_order(details):
    return details.select(*FACTS["dwd_transport_task_detail"].names)


@query
def stream_transport_task_detail(spark, sf):
    changes = _log(spark, sf, "transport_task", "transport_task_detail")
    late = (F.col("table") == "transport_task") & _odd_key("id")
    out = _detail_pairs(spark, "stream_transport_task_detail", _raw_slices(changes, 2, late), _in_order)
    return spark.read.parquet(out).drop("run", "batch_id")


@query
def stream_task_detail_sink(spark, sf):
    """The details written as JSON lines of thirteen columns, then read back as typed rows."""
    changes = _log(spark, sf, "transport_task", "transport_task_detail")
    out = _detail_pairs(
        spark, "stream_task_detail_sink", _raw_slices(changes, 2), lambda d: _fact_lines(_in_order(d)), "text"
    )
    lines = read_files(spark, out, streaming=False).select("value")
    return parse_facts(lines, FACTS["dwd_transport_task_detail"])


def _phases(feed):
    """The dimension feed as it arrives: load, renames, deletes."""
    kinds = [["bootstrap-insert"], ["update"], ["delete"]]
    return [fx.raw(feed.where(F.col("type").isin(k))) for k in kinds]


@query
def stream_dim_apply_changes(spark, sf):
    """All five dimensions; their configuration changes after the load has come."""
    root = work_folder(spark, "stream_dim_apply_changes")
    events, config = fx.lifecycle_events(spark), fx.dimension_config(spark)
    seen = {"events": events.where("op = 'r'")}
    job = DimensionJob(DimensionStore(spark, f"{root}/store"), lambda: seen["events"])

    def start():
        return run_stream(
            "stream_dim_apply_changes", read_files(spark, f"{root}/in"), lambda raw: raw,
            job.sink, f"{root}/checkpoint", available_now=True,
            state_partitions=_partitions(spark),
        )

    for rows in _phases(fx.dimension_changes(spark, sf)):
        replay([rows], f"{root}/in", start)
        seen["events"] = events
    return reduce(
        lambda a, b: a.unionByName(b),
        [
            job.store.read(r["sink_table"], job.schema(r["sink_columns"])).select(
                F.lit(r["source_table"]).alias("dim"), "id",
                F.col(fx.DIMENSIONS[r["source_table"]][1]).alias("label"), "type", "ts",
            )
            for r in config.collect()
        ],
    )


@query
def stream_upsert_latest(spark, sf):
    """The newest state of every truck's transports, deleted when its last one has no end."""
    root = work_folder(spark, "stream_upsert_latest")
    store, schema = DimensionStore(spark, f"{root}/store"), "truck_id string, id string"

    def rows(raw):
        tasks = clean(parse_changes(raw, ["transport_task"]))
        gone = F.when(F.col("data")["actual_end_time"].isNull(), "delete").otherwise("update")
        return tasks.select(*_data("truck_id", "id"), "ts", "offset", gone.alias("type"))

    sink = upsert_sink(store, "last_task", schema, "truck_id", ("ts", "offset"))

    def start():
        return run_stream(
            "stream_upsert_latest", read_files(spark, f"{root}/in"), rows, sink,
            f"{root}/checkpoint", available_now=True,
            state_partitions=_partitions(spark),
        )

    replay(_raw_slices(_log(spark, sf, "transport_task"), 2), f"{root}/in", start)
    return store.read("last_task", schema)


@query
def stream_lookup_latest(spark, sf):
    """Pickups joined with the organisation names of their time of arrival."""
    root = work_folder(spark, "stream_lookup_latest")
    store, schema = DimensionStore(spark, f"{root}/store"), "id string, org_name string"
    organ = fx.base_organ(spark, sf).select("id", "org_name")
    renamed = organ.withColumn("org_name", F.concat("org_name", F.lit("_v2")))
    changes = _log(spark, sf, "express_task_collect")
    sink = lookup_latest(
        lambda raw: clean(parse_changes(raw)).select(*_data("id", "org_id")),
        store, "dim_base_organ", schema, "org_id", {"org_name": "org_name"}, f"{root}/out",
    )

    def start():
        return run_stream(
            "stream_lookup_latest", read_files(spark, f"{root}/in"), lambda raw: raw, sink,
            f"{root}/checkpoint", available_now=True,
            state_partitions=_partitions(spark),
        )

    versions = [organ, renamed]
    slices = _raw_slices(changes, 2)
    for version, (names, rows) in enumerate(zip(versions, slices)):
        store.write("dim_base_organ", names, version)
        replay([rows], f"{root}/in", start)
    return spark.read.parquet(f"{root}/out").drop("run", "batch_id")


def _enriched(spark, sf, name, table, build):
    """Facts of a stream whose organisations are renamed between two arrivals."""
    root = work_folder(spark, name)
    store = DimensionStore(spark, f"{root}/store")
    organ, regions = _organ(spark, sf)
    renamed = organ.withColumn("org_name", F.concat("org_name", F.lit("_v2")))
    tables = {
        "organ": ("dim_base_organ", organ.schema.simpleString()[7:-1].replace(":", " ")),
        "regions": ("dim_base_region_info", regions.schema.simpleString()[7:-1].replace(":", " ")),
    }
    store.write("dim_base_region_info", regions)
    sink = enrich_latest(
        lambda raw, organ, regions: build(parse_changes(raw, [table]), organ, regions),
        store, tables, f"{root}/out", {"regions": flatten_regions},
    )

    def start():
        return run_stream(
            name, read_files(spark, f"{root}/in"), lambda raw: raw, sink, f"{root}/checkpoint",
            available_now=True, state_partitions=_partitions(spark),
        )

    for names, rows in zip((organ, renamed), _raw_slices(_log(spark, sf, table), 2)):
        store.write("dim_base_organ", names)
        replay([rows], f"{root}/in", start)
    return spark.read.parquet(f"{root}/out").drop("run", "batch_id")


@query
def stream_express_pickup(spark, sf):
    return _enriched(spark, sf, "stream_express_pickup", "express_task_collect", facts.express_pickup)


@query
def stream_express_deliver(spark, sf):
    return _enriched(
        spark, sf, "stream_express_deliver", "express_task_delivery", facts.express_deliver
    )


@query
def stream_express_sorting(spark, sf):
    return _enriched(spark, sf, "stream_express_sorting", "order_org_bound", facts.express_sorting)
