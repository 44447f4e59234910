"""Ten window tables from the facts.

Each builder gives the columns of `schemas.ROLLUP_COLUMNS` after stt, edt and cur_date. All
aggregate first and look attributes up afterwards, except by truck model, where the lookup
gives the key: a stream looks that up in the history of the trucks, in a job of its own before the
windows. The two halves of those with lookups are functions of their own (`*_windows`,
`*_named`), so that a stream can aggregate and then name each micro-batch of closed windows by the
newest dimensions (`streaming.enrich_latest`).
"""

from pyspark.sql import functions as F

from ..functions import as_double, as_long, json_row, whole_div
from ..operators.lookup import join_region, lookup_as_of, lookup_join
from ..operators.rollup import STAMPS, window_rollup
from ..schemas import (
    IN_TRANSIT,
    OUT_FOR_DELIVERY,
    PICKED_UP,
    REGION_ATTRIBUTES,
    ROLLUP_COLUMNS,
)


def _shape(df, table):
    return df.select(*STAMPS, *ROLLUP_COLUMNS[table])


def order_status_count(facts):
    """Orders picked up, in transit and out for delivery."""

    def flag(code):
        return F.when(F.col("status") == code, 1).otherwise(0).cast("bigint")

    out = window_rollup(
        facts,
        sums={
            "tack_count": flag(PICKED_UP),
            "send_count": flag(IN_TRANSIT),
            "tc_count": flag(OUT_FOR_DELIVERY),
        },
    )
    return _shape(out, "dws_order_status_count_view_window")


def _transport(facts, keys=(), firsts=(), in_seconds=True):
    duration = as_long("diff_time")
    return window_rollup(
        facts,
        keys,
        count="trans_count",
        sums={
            "trans_distance": as_double("actual_distance"),
            "trans_time": whole_div(duration, 1000) if in_seconds else duration,
        },
        firsts=firsts,
        dependent=True,
    )


def transport_total(facts):
    """All finished transports; durations in seconds."""
    return _shape(_transport(facts), "dws_transport_total_count_view_window")


def transport_org_windows(facts):
    named = facts.withColumnsRenamed(
        {"start_org_id": "org_id", "start_org_name": "org_name"}
    )
    return _transport(named, ["org_id"], ["org_name"])


def transport_org_named(windows, organ, regions):
    out = lookup_join(windows, organ, "org_id", {"region_id": "region_id"})
    return _shape(join_region(out, regions), "dws_transport_city_org_view_window")


def transport_org(facts, organ, regions):
    """Finished transports by start organisation; durations in seconds."""
    return transport_org_named(transport_org_windows(facts), organ, regions)


def transport_truck_keyed(facts, truck_history):
    """Facts with the model that their truck had at the time; see `operators.lookup_as_of`."""
    return lookup_as_of(facts, truck_history, "truck_id", {"truck_mode_id": "truck_model_id"})


def transport_truck_windows(keyed):
    return _transport(keyed, ["truck_mode_id"], in_seconds=False)


def transport_truck_named(windows, truck_model):
    out = lookup_join(
        windows, truck_model, "truck_mode_id",
        {"truck_mode_type": "model_type", "truck_mode_name": "model_name"},
    )
    return _shape(out, "dws_transport_truck_view_window")


def transport_truck(facts, truck_info, truck_model):
    """Finished transports by truck model; durations in milliseconds."""
    keyed = lookup_join(facts, truck_info, "truck_id", {"truck_mode_id": "truck_model_id"})
    return transport_truck_named(transport_truck_windows(keyed), truck_model)


def trade_order_cargo_windows(facts):
    return window_rollup(
        facts, ["cargo_type"], count="order_count", sums={"total_amount": as_double("amount")}
    )


def trade_order_cargo_named(windows, dic):
    out = lookup_join(windows, dic, "cargo_type", {"cargo_name": "name"})
    return _shape(out, "dws_trade_order_cargo_view_window")


def trade_order_cargo(facts, dic):
    """Orders by cargo type."""
    return trade_order_cargo_named(trade_order_cargo_windows(facts), dic)


def trade_order_city_windows(facts):
    named = facts.withColumnsRenamed(
        {"sender_city_id": "city_id", "sender_province_id": "province_id"}
    )
    return window_rollup(
        named, ["city_id"], count="order_count", sums={"total_amount": as_double("amount")},
        firsts=["province_id"], dependent=True,
    )


def trade_order_city_named(windows, regions):
    regions = regions.select("id", "name")
    out = lookup_join(windows, regions, "city_id", {"city_name": "name"})
    out = lookup_join(out, regions, "province_id", {"province_name": "name"})
    return _shape(out, "dws_trade_order_city_view_window")


def trade_order_city(facts, regions):
    """Orders by the sender's city."""
    return trade_order_city_named(trade_order_city_windows(facts), regions)


def trade_order_org_windows(facts):
    return window_rollup(
        facts.withColumn("order_amount", as_double("amount")).drop("amount"),
        ["org_id"], count="count", sums={"amount": "order_amount"},
    )


def trade_order_org_named(windows, organ):
    out = lookup_join(windows, organ, "org_id", {"org_name": "org_name"})
    return _shape(out, "dws_trade_order_org_view_window")


def trade_order_org(facts, organ):
    """Orders by organisation."""
    return trade_order_org_named(trade_order_org_windows(facts), organ)


def express(facts, kind):
    """Parcels by organisation; `kind` is pickup, sorting or deliver."""
    out = window_rollup(
        facts, ["org_id"], count="count", firsts=["org_name", *REGION_ATTRIBUTES],
        dependent=True,
    )
    return _shape(out, f"dws_express_{kind}_view_window")


def json_rows(rollup):
    """The form in which a rollup is loaded: one JSON object per row."""
    return rollup.select(json_row(rollup.columns).alias("value"))
