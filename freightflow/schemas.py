"""Column layouts shared by every layer."""

from pyspark.sql import types as T

# Names, codes and column lists that the data itself uses.
BUSINESS_DATABASE = "tms"
CHANGE_TYPES = ("delete", "insert", "update", "bootstrap-insert")
BOOTSTRAP_PREFIX = "bootstrap-"
REGION_ROOT = "86"

PICKED_UP, IN_TRANSIT, OUT_FOR_DELIVERY = "60030", "60050", "60060"
COLLECTED = "63003"
SORTED = "64003"
TRANSPORT_FINISHED = "67004"
DELIVERED = "68003"

_STRING_MAP = T.MapType(T.StringType(), T.StringType())

ENVELOPE = T.StructType(
    [
        T.StructField("database", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("ts", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("data", _STRING_MAP),
        T.StructField("old", _STRING_MAP),
    ]
)

CONFIG_COLUMNS = (
    "source_table",
    "source_type",
    "sink_table",
    "sink_type",
    "sink_family",
    "sink_columns",
    "sink_row_key",
)
CONFIG_ROW = T.StructType([T.StructField(c, T.StringType()) for c in CONFIG_COLUMNS])
CONFIG_EVENT = T.StructType(
    [
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("before", CONFIG_ROW),
        T.StructField("after", CONFIG_ROW),
        T.StructField("seq", T.LongType()),
    ]
)


def _strings(*names):
    return [T.StructField(n, T.StringType()) for n in names]


REGION_ATTRIBUTES = ("city_id", "city_name", "province_id", "province_name")

#: Columns that a fact keeps from its source table: all but those it drops. A source with more
#: columns names them in the builder's `columns`.
PICKUP_COLUMNS = ("id", "org_id", "status", "order_id", "courier_id")
DELIVER_COLUMNS = PICKUP_COLUMNS
SORTING_COLUMNS = ("id", "org_id", "status", "order_id", "outbound_emp_id")
CARGO_COLUMNS = ("order_id", "cargo_type", "weight", "volume_length", "create_time")
BOUND_COLUMNS = ("order_id", "org_id", "status", "sort_time", "outbound_emp_id")

_ENRICHED = _strings("region_id", "org_name", *REGION_ATTRIBUTES)
_TS = [T.StructField("ts", T.LongType())]

FACTS = {
    "dwd_order_status_count": T.StructType(
        _TS + _strings("status", "order_no", "update_time", "create_time")
    ),
    "dwd_express_pickup": T.StructType(
        _strings(*PICKUP_COLUMNS, "actual_collected_time") + _TS + _ENRICHED
    ),
    "dwd_express_deliver": T.StructType(
        _strings(*DELIVER_COLUMNS, "delivered_time") + _TS + _ENRICHED
    ),
    "dwd_express_sorting": T.StructType(
        _strings(*SORTING_COLUMNS, "sort_time") + _TS + _ENRICHED
    ),
    "dwd_trade_order_cargo": T.StructType(
        _strings(*CARGO_COLUMNS)
        + _TS
        + _strings("id", "amount", "cargo_num", "sender_city_id", "sender_province_id")
    ),
    "dwd_trade_order_org": T.StructType(
        _strings(*BOUND_COLUMNS)
        + _TS
        + _strings("id", "amount", "cargo_num")
    ),
    "dwd_transport_truck_task": T.StructType(
        _strings(
            "actual_distance",
            "actual_end_time",
            "actual_start_time",
            "start_org_id",
            "start_org_name",
            "truck_id",
            "order_num",
            "end_org_id",
            "end_org_name",
        )
        + _TS
        + [T.StructField("diff_time", T.LongType())]
    ),
    "dwd_transport_task_detail": T.StructType(
        _strings(
            "id",
            "shift_id",
            "line_id",
            "order_id",
            "status",
            "order_num",
            "truck_id",
            "start_org_id",
            "start_org_name",
            "actual_start_time",
            "actual_end_time",
            "actual_distance",
        )
        + _TS
    ),
}

ROLLUP_COLUMNS = {
    "dws_order_status_count_view_window": ("tack_count", "send_count", "tc_count"),
    "dws_transport_total_count_view_window": ("trans_count", "trans_distance", "trans_time"),
    "dws_trade_order_cargo_view_window": (
        "cargo_type", "cargo_name", "order_count", "total_amount",
    ),
    "dws_trade_order_city_view_window": (
        "city_id", "city_name", "province_id", "province_name", "order_count", "total_amount",
    ),
    "dws_trade_order_org_view_window": ("org_id", "org_name", "count", "amount"),
    "dws_transport_city_org_view_window": (
        "province_id", "province_name", "city_id", "city_name", "org_id", "org_name",
        "trans_count", "trans_distance", "trans_time",
    ),
    "dws_transport_truck_view_window": (
        "truck_mode_id", "truck_mode_type", "truck_mode_name",
        "trans_count", "trans_distance", "trans_time",
    ),
    "dws_express_pickup_view_window": (
        "province_id", "province_name", "city_id", "city_name", "org_id", "org_name", "count",
    ),
    "dws_express_sorting_view_window": (
        "province_id", "province_name", "city_id", "city_name", "org_id", "org_name", "count",
    ),
    "dws_express_deliver_view_window": (
        "province_id", "province_name", "city_id", "city_name", "org_id", "org_name", "count",
    ),
}
