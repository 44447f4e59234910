"""Eight fact tables from the change log.

Each builder takes parsed changes, as a batch or as a stream, and gives the columns listed in
`schemas.FACTS`. A row whose time does not parse is dropped.
"""

from pyspark.sql import functions as F

from ..functions import as_double, datetime_to_ms
from ..operators.clean import of_table, of_tables
from ..operators.dedupe import first_per_key
from ..operators.lookup import join_region, lookup_join
from ..schemas import (
    BOUND_COLUMNS,
    CARGO_COLUMNS,
    COLLECTED,
    DELIVER_COLUMNS,
    DELIVERED,
    FACTS,
    IN_TRANSIT,
    OUT_FOR_DELIVERY,
    PICKED_UP,
    PICKUP_COLUMNS,
    SORTED,
    SORTING_COLUMNS,
    TRANSPORT_FINISHED,
)


def _fields(*names):
    return [F.col("data")[n].alias(n) for n in names]


def _timed(rows, text, *columns):
    """`columns` and `ts`, the time that column `text` spells; rows without one are dropped.

    The time comes from a generator. A filter on a plain expression would be pushed down with
    a copy of the parser in it, and once more for the window's own filter.
    """
    return rows.select(
        *columns, F.explode(F.array(datetime_to_ms(text))).alias("ts")
    ).where("ts IS NOT NULL")


# ---------------------------------------------------------------- one table


def order_status(changes):
    """Orders that reached one of the three counted states."""
    names = ("status", "order_no", "update_time", "create_time")
    rows = of_table(changes, "order_info").select(*_fields(*names))
    counted = rows.where(F.col("status").isin(PICKED_UP, IN_TRANSIT, OUT_FOR_DELIVERY))
    return _timed(counted, "update_time", *names).select("ts", *names)


def truck_task(changes, columns=()):
    """Finished transport tasks with their duration in milliseconds; `columns` are kept besides."""
    names = [n for n in FACTS["dwd_transport_truck_task"].names if n not in ("ts", "diff_time")]
    names += columns
    rows = of_table(changes, "transport_task").select(*_fields(*names, "status", "update_time"))
    start, end = datetime_to_ms("actual_start_time"), datetime_to_ms("actual_end_time")
    finished = rows.where(F.col("status") == TRANSPORT_FINISHED)
    return (
        _timed(finished, "update_time", *names)
        .select(*names, "ts", F.explode(F.array(end - start)).alias("diff_time"))
        .where("diff_time IS NOT NULL")
    )


def _express(changes, table, status, time_column, columns, organ, regions):
    rows = of_table(changes, table).select(
        *_fields(*columns, time_column), F.col("data")["status"].alias("_status")
    )
    facts = _timed(rows.where(F.col("_status") == status), time_column, *columns, time_column)
    known = lookup_join(
        facts, organ, "org_id", {"region_id": "region_id", "org_name": "org_name"}
    )
    return join_region(known, regions)


def express_pickup(changes, organ, regions, columns=PICKUP_COLUMNS):
    """Collected parcels with the organisation's region; `columns` are kept from the source."""
    return _express(
        changes, "express_task_collect", COLLECTED, "actual_collected_time", columns,
        organ, regions,
    )


def express_deliver(changes, organ, regions, columns=DELIVER_COLUMNS):
    """Delivered parcels with the organisation's region."""
    return _express(
        changes, "express_task_delivery", DELIVERED, "delivered_time", columns, organ, regions
    )


def express_sorting(changes, organ, regions, columns=SORTING_COLUMNS):
    """Sorted parcels with the organisation's region."""
    return _express(
        changes, "order_org_bound", SORTED, "sort_time", columns, organ, regions
    )


def once_per_state(facts, keys, within="1 day"):
    """Optionally, count a row only the first time that it reaches a state.

    Without it every later change of a finished row is a fact again. `keys` are its id and
    its status. On a stream repeats are found `within` that time of the first.
    """
    if not facts.isStreaming:
        return first_per_key(facts, keys, ("ts",))
    timed = facts.withColumn("_et", F.timestamp_millis("ts")).withWatermark("_et", within)
    return timed.dropDuplicatesWithinWatermark(list(keys)).drop("_et")


# ---------------------------------------------------------------- two tables


def cargo_inserts(changes, columns=CARGO_COLUMNS):
    """Inserted cargos; `arrived` and `offset` order copies of one cargo. `columns` are kept from
    the source and must have order_id and create_time."""
    rows = of_table(changes, "order_cargo", inserts_only=True)
    rows = rows.select(*_fields(*columns), F.col("ts").alias("arrived"), "offset")
    return _timed(
        rows.where("order_id IS NOT NULL"), "create_time", *columns, "arrived", "offset"
    ).select(*columns, "ts", "arrived", "offset")


def order_inserts(changes, *columns):
    """Inserted orders; `arrived` and `offset` order copies of one order."""
    return (
        of_table(changes, "order_info", inserts_only=True)
        .select(*_fields("id", *columns), F.col("ts").alias("arrived"), "offset")
        .where("id IS NOT NULL")
    )


def bound_inserts(changes, columns=BOUND_COLUMNS):
    """Inserted arrivals of orders at organisations; `arrived` is when the change was made."""
    rows = of_table(changes, "order_org_bound", inserts_only=True)
    rows = rows.select(*_fields(*columns, "create_time"), F.col("ts").alias("arrived"))
    return _timed(rows.where("order_id IS NOT NULL"), "create_time", *columns, "arrived").select(
        *columns, "ts", "arrived"
    )


CARGO_ORDER = ("amount", "cargo_num", "sender_city_id", "sender_province_id")
ORG_ORDER = ("amount", "cargo_num")


def _watermarked(df, clock, within):
    """The time of the change as an event-time column, the clock of both sides of every join."""
    return df.withColumn(clock, F.timestamp_millis("arrived")).withWatermark(clock, within)


def _once(df, key, clock, within, salts):
    """One row per key: the first by arrival, on a stream the first seen, forgotten after `within`
    if that is given.

    A stream drops the copies in two steps, first within `salts` parts of each key, so that
    the copies of one key do not all go to one task.
    """
    if not df.isStreaming:
        return first_per_key(df, [key], ("arrived", "offset"))
    timed = _watermarked(df, clock, within) if within else df

    def distinct(rows, keys):
        return rows.dropDuplicatesWithinWatermark(keys) if within else rows.dropDuplicates(keys)

    if salts > 1:
        part = F.pmod(F.hash("offset", "arrived"), F.lit(salts))
        timed = distinct(timed.withColumn("_part", part), [key, "_part"])
    return distinct(timed, [key]).drop("_part")


def _joined(many, one, matches, clocks, within):
    """Pairs of two streams. Without `within` both sides are remembered for good, and none is lost.
    With it, state is bounded, and a row of `many` whose partner did not come in time is given
    without one, so that nothing vanishes unseen."""
    if not within:
        return many.join(one, matches)
    left, right = clocks
    near = F.expr(f"{left} BETWEEN {right} - INTERVAL {within} AND {right} + INTERVAL {within}")
    return many.join(one, matches & near, "left")


def trade_order_cargo(changes, within=None, salts=4, order_changes=None, columns=CARGO_COLUMNS,
                      order_columns=CARGO_ORDER):
    """Each order with its first cargo.

    On a stream, `within` bounds the state: changes of a pair that were made further apart do not
    meet, and the cargo is given with a null id (see `_joined`). `order_changes` hold the orders
    when they are parsed apart from the cargos.
    """
    cargo = _once(cargo_inserts(changes, columns), "order_id", "cargo_et", within, salts)
    orders = order_inserts(changes if order_changes is None else order_changes, *order_columns)
    orders = _once(orders, "id", "order_et", within, salts).drop("arrived", "offset")
    cargo, matches = cargo.drop("arrived", "offset"), F.col("order_id") == F.col("id")
    names = (*columns, "ts", "id", *order_columns)
    if not changes.isStreaming:
        return cargo.join(orders, matches).select(*names)
    return _joined(cargo, orders, matches, ("cargo_et", "order_et"), within).select(*names)


def trade_order_org(changes, within=None, salts=4, order_changes=None, columns=BOUND_COLUMNS,
                    order_columns=ORG_ORDER):
    """Every arrival of an order at an organisation, with the order's amount.

    `within` and `order_changes` as in `trade_order_cargo`.

    One order may have very many arrivals. In a batch, adaptive execution splits its join
    partition; the orders are deduplicated by (id, shard) so that the join exchanges them
    again, which the split needs. That second exchange of the orders is the price. On a stream,
    which has no such split, the arrivals of an order are spread over `salts` tasks and the orders
    are repeated for each.
    """
    bounds = bound_inserts(changes, columns)
    orders = order_inserts(changes if order_changes is None else order_changes, *order_columns)
    names = (*columns, "ts", "id", *order_columns)
    if not changes.isStreaming:
        shard = F.pmod(F.hash("id"), F.lit(1024)).alias("shard")
        rest = ("arrived", "offset", *order_columns)
        orders = (
            orders.groupBy("id", shard)
            .agg(F.min(F.struct(*rest)).alias("first"))
            .select("id", *[F.col("first")[c].alias(c) for c in order_columns])
        )
        return bounds.join(orders, F.col("order_id") == F.col("id")).select(*names)

    bounds = _watermarked(bounds, "bound_et", within) if within else bounds
    bounds = bounds.withColumn("salt", F.pmod(F.hash("org_id", "ts"), F.lit(salts)))
    orders = _once(orders, "id", "order_et", within, salts).withColumn(
        "order_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    ).drop("arrived", "offset")
    matches = (F.col("order_id") == F.col("id")) & (F.col("salt") == F.col("order_salt"))
    return _joined(bounds, orders, matches, ("bound_et", "order_et"), within).select(*names)


def _sides(rows, is_many, key, many_columns, one_columns):
    """Both inputs of a join as one table, from one pass over `rows`, which have `arrived` and the columns
    of both: key, arrived, and a struct for either side, of which one is null."""
    return rows.select(
        key.alias("key"), "arrived",
        F.when(is_many, F.struct(*many_columns)).alias("many"),
        F.when(~is_many, F.struct(*one_columns)).alias("one"),
    )


def _inserted_sides(changes, table, columns, order_columns):
    """Inserts of `table` with the time that their create_time spells, and of their orders; as in
    `cargo_inserts`, `bound_inserts` and `order_inserts`, which each parse the change log for themselves."""
    is_many = F.col("_table") == table
    key = F.when(is_many, F.col("order_id")).otherwise(F.col("id"))
    names = dict.fromkeys((*columns, "order_id", "create_time", "id", *order_columns))
    rows = of_tables(changes, table, "order_info", types=("insert", "bootstrap-insert")).select(
        F.col("table").alias("_table"), *_fields(*names), F.col("ts").alias("arrived")
    ).where(key.isNotNull())
    timed = rows.select("*", F.explode(F.array(F.when(is_many, datetime_to_ms("create_time")))).alias("ts"))
    timed = timed.where(~is_many | F.col("ts").isNotNull())
    return _sides(timed, is_many, key, (*columns, "ts"), ("id", *order_columns))


def cargo_sides(changes, columns=CARGO_COLUMNS, order_columns=CARGO_ORDER):
    """The cargos and orders of `trade_order_cargo` as rows for `streaming.pair_sink`."""
    return _inserted_sides(changes, "order_cargo", columns, order_columns)


def org_sides(changes, columns=BOUND_COLUMNS, order_columns=ORG_ORDER):
    """The bounds and orders of `trade_order_org` as rows for `streaming.attach_sink`."""
    return _inserted_sides(changes, "order_org_bound", columns, order_columns)


def split_cargo_and_info(changes):
    """The two inputs of `trade_order_cargo`."""
    return (
        cargo_inserts(changes).drop("arrived", "offset"),
        order_inserts(changes, *CARGO_ORDER).drop("arrived", "offset"),
    )


def split_bound_and_info(changes):
    """The two inputs of `trade_order_org`."""
    return (
        bound_inserts(changes).drop("arrived"),
        order_inserts(changes, *ORG_ORDER).drop("arrived", "offset"),
    )


# ---------------------------------------------------------------- transport task details


def _updates(changes, table):
    return of_table(changes, table).where("type = 'update'")


def transport_task_finished(changes):
    """Updates of transport tasks that carry orders and have ended."""
    names = [n for n in FACTS["dwd_transport_task_detail"].names if n not in ("order_id", "ts")]
    rows = _updates(changes, "transport_task").select(*_fields(*names), "ts")
    return rows.where((as_double("order_num") > 0) & F.col("actual_end_time").isNotNull())


def transport_task_detail_updates(changes):
    """Updates of the details of transport tasks."""
    names = ("id", "order_id", "transport_task_id", "create_time", "operate_time")
    return _updates(changes, "transport_task_detail").select("type", *_fields(*names))


def detail_sides(changes):
    """The details and finished tasks of `transport_task_detail` as rows for `streaming.join_sink`."""
    is_many = F.col("_table") == "transport_task_detail"
    names = [n for n in FACTS["dwd_transport_task_detail"].names if n not in ("order_id", "ts")]
    rows = of_tables(changes, "transport_task_detail", "transport_task", types=("update",)).select(
        F.col("table").alias("_table"), *_fields(*dict.fromkeys((*names, "order_id", "transport_task_id"))),
        "ts", F.col("ts").alias("arrived"),
    )
    ended = (as_double("order_num") > 0) & F.col("actual_end_time").isNotNull()
    key = F.when(is_many, F.col("transport_task_id")).otherwise(F.col("id"))
    return _sides(rows.where(is_many | ended), is_many, key, ("order_id",), (*names, "ts"))


def transport_task_detail(changes, within=None, salts=4, detail_changes=None):
    """Finished tasks joined with the updates of their details, many to many.

    `detail_changes` hold the details when they are parsed apart from the tasks. `within` as in
    `trade_order_cargo`: a detail whose task did not come in time is given with a null id. On a
    stream the details of a task are spread over `salts` tasks as in `trade_order_org`; in a batch
    adaptive execution splits a hot task.
    """
    names = FACTS["dwd_transport_task_detail"].names
    tasks = transport_task_finished(changes)
    details = _updates(
        changes if detail_changes is None else detail_changes, "transport_task_detail"
    ).select(
        *_fields("order_id", "transport_task_id"), F.col("data")["id"].alias("detail_id"),
        F.col("ts").alias("arrived"),
    )
    matches = F.col("id") == F.col("transport_task_id")
    if not changes.isStreaming:
        return details.join(tasks, matches).select(*names)
    tasks = tasks.withColumn("task_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salt = F.pmod(F.hash("detail_id", "arrived"), F.lit(salts))
    details = details.withColumn("salt", salt)
    if within:
        tasks = tasks.withColumn("task_et", F.timestamp_millis("ts")).withWatermark("task_et", within)
        details = _watermarked(details, "detail_et", within)
    matches = matches & (F.col("task_salt") == F.col("salt"))
    return _joined(details, tasks, matches, ("detail_et", "task_et"), within).select(*names)
