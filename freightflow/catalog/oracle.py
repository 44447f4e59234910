"""The registered queries in DuckDB SQL, written against the star-schema tables."""

S = 1704067200  # 2024-01-01 00:00:00 UTC


def _t(seconds):
    """Epoch seconds as text."""
    return f"strftime(make_timestamp(CAST(({seconds}) AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S')"


def _window(ms, length=5000):
    """stt, edt and cur_date of the window of a millisecond expression."""
    start = f"(({ms}) // {length} * {length})"
    return (
        f"{_t(f'{start} // 1000')} AS stt, {_t(f'{start} // 1000 + {length // 1000}')} AS edt, "
        f"substr({_t(f'{start} // 1000')}, 1, 10) AS cur_date"
    )


# Times in seconds: creation of an order, arrival of a bound, end of a transport, parcel event.
ORDER_AT = f"({S} + o_orderkey // 10)"
CARGO_AT = f"({S} + l_orderkey // 10)"
BOUND_AT = f"({S} + l_orderkey // 10 + l_linenumber)"
TASK_END = f"({S} + o_orderkey // 10 + 600 + o_orderkey % 600)"
TASK_AT = f"(CASE WHEN o_orderstatus = 'P' THEN {ORDER_AT} ELSE {TASK_END} END)"
EVENT_AT = f"({S} + event_id // 10)"

ORDER_STATUS = (
    "CASE o_orderstatus WHEN 'F' THEN '60030' WHEN 'O' THEN '60050' WHEN 'P' THEN '60060' END"
)
TASK_STATUS = (
    "CASE o_orderstatus WHEN 'F' THEN '67004' WHEN 'O' THEN '67003' WHEN 'P' THEN '67001' END"
)
BOUND_STATUS = "CASE l_linestatus WHEN 'F' THEN '64003' ELSE '64002' END"

REGION_OF_ORGAN = """
    SELECT CAST(s_suppkey AS VARCHAR) AS org_id, s_name AS org_name,
           'H' || s_nationkey AS region_id,
           'C' || n_nationkey AS city_id, n_name AS city_name,
           'P' || r_regionkey AS province_id, r_name AS province_name
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
                  LEFT JOIN region ON n_regionkey = r_regionkey
"""

ORDER_ROW = """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_totalprice AS VARCHAR) AS amount,
           o_totalprice, '1' AS cargo_num, 'C' || (o_custkey % 25) AS sender_city_id,
           'P' || n_regionkey AS sender_province_id, o_orderkey
    FROM orders LEFT JOIN nation ON o_custkey % 25 = n_nationkey
"""

# The first cargo of an order: all have the same time, so the lowest line number, then the
# other columns.
FIRST_CARGO = f"""
    SELECT * EXCLUDE (n) FROM (
        SELECT l_orderkey, CAST(l_orderkey AS VARCHAR) AS order_id,
               'K' || (l_partkey % 6) AS cargo_type, {_t(CARGO_AT)} AS create_time,
               CAST(l_quantity AS VARCHAR) AS weight,
               CAST(l_extendedprice AS VARCHAR) AS volume_length,
               {CARGO_AT} * 1000 AS ts,
               row_number() OVER (PARTITION BY l_orderkey
                                  ORDER BY l_linenumber, 'K' || (l_partkey % 6),
                                           CAST(l_quantity AS VARCHAR),
                                           CAST(l_extendedprice AS VARCHAR)) AS n
        FROM lineitem) WHERE n = 1
"""

CARGO_FACT = f"""
    SELECT c.order_id, c.cargo_type, c.weight, c.volume_length, c.create_time, c.ts, o.id, o.amount, o.o_totalprice,
           o.cargo_num, o.sender_city_id, o.sender_province_id
    FROM ({FIRST_CARGO}) c JOIN ({ORDER_ROW}) o ON c.l_orderkey = o.o_orderkey
"""

ORG_FACT = f"""
    SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_suppkey AS VARCHAR) AS org_id,
           {BOUND_STATUS} AS status, {_t(BOUND_AT)} AS sort_time,
           CAST(l_partkey % 97 AS VARCHAR) AS outbound_emp_id, {BOUND_AT} * 1000 AS ts,
           o.id, o.amount, o.o_totalprice, o.cargo_num
    FROM lineitem JOIN ({ORDER_ROW}) o ON l_orderkey = o.o_orderkey
"""

TRUCK_FACT = f"""
    SELECT floor(o_totalprice / 10) / 100 AS distance,
           {_t(TASK_END)} AS actual_end_time, {_t(ORDER_AT)} AS actual_start_time,
           CAST(o_custkey % 10 AS VARCHAR) AS start_org_id,
           'ORG' || (o_custkey % 10) AS start_org_name,
           CAST(o_custkey AS VARCHAR) AS truck_id, CAST(o_orderkey % 4 AS VARCHAR) AS order_num,
           CAST((o_custkey + 1) % 10 AS VARCHAR) AS end_org_id,
           'ORG' || ((o_custkey + 1) % 10) AS end_org_name,
           {TASK_END} * 1000 AS ts, ({TASK_END} - {ORDER_AT}) * 1000 AS diff_time
    FROM orders WHERE o_orderstatus = 'F'
"""

TRUCK_FACT_COLUMNS = """
    CAST(distance AS VARCHAR) AS actual_distance, actual_end_time, actual_start_time,
    start_org_id, start_org_name, truck_id, order_num, end_org_id, end_org_name, ts, diff_time
"""


def _express_fact(event_type, status, time_column):
    return f"""
        SELECT CAST(event_id AS VARCHAR) AS id, org_id, '{status}' AS status,
               CAST(event_id * 3 AS VARCHAR) AS order_id, courier_id,
               {_t(EVENT_AT)} AS {time_column}, {EVENT_AT} * 1000 AS ts, region_id, org_name,
               city_id, city_name, province_id, province_name
        FROM (SELECT event_id, CAST(user_id % 10 AS VARCHAR) AS org_id,
                     CAST(user_id AS VARCHAR) AS courier_id
              FROM events WHERE event_type = '{event_type}') e
        LEFT JOIN ({REGION_OF_ORGAN}) r USING (org_id)
    """


PICKUP_FACT = _express_fact("click", "63003", "actual_collected_time")
DELIVER_FACT = _express_fact("purchase", "68003", "delivered_time")

SORTING_FACT = f"""
    SELECT l_orderkey || '-' || l_linenumber AS id, org_id, '64003' AS status,
           CAST(l_orderkey AS VARCHAR) AS order_id, {_t(BOUND_AT)} AS sort_time,
           CAST(l_partkey % 97 AS VARCHAR) AS outbound_emp_id,
           {BOUND_AT} * 1000 AS ts, region_id, org_name, city_id, city_name, province_id,
           province_name
    FROM (SELECT *, CAST(l_suppkey AS VARCHAR) AS org_id FROM lineitem
          WHERE l_linestatus = 'F') l
    LEFT JOIN ({REGION_OF_ORGAN}) r USING (org_id)
"""


def _express_rollup(fact):
    return f"""
        SELECT {_window("ts")}, min(province_id) AS province_id,
               min(province_name) AS province_name, min(city_id) AS city_id,
               min(city_name) AS city_name, org_id, min(org_name) AS org_name,
               count(*) AS "count"
        FROM ({fact}) GROUP BY ts // 5000, stt, edt, cur_date, org_id
    """


def _renamed(fact, arrivals, arrival="ts"):
    """A fact whose organisations have new names for rows of the second half of the time span."""
    return f"""
        WITH span AS (SELECT min(moment) AS low, (max(moment) - min(moment) + 2) // 2 AS step FROM ({arrivals}))
        SELECT * EXCLUDE (low, step)
               REPLACE (CASE WHEN least(1, ({arrival} - low) // step) = 0 THEN org_name
                             ELSE org_name || '_v2' END AS org_name)
        FROM ({fact}) CROSS JOIN span
    """


# When the change of a bound was made, from lineitem and from the fact.
BOUND_ARRIVAL = (
    f"(({BOUND_AT}) + CASE WHEN l_orderkey % 5 = 0 THEN 30 * 86400 ELSE 0 END) * 1000"
)
BOUND_ARRIVED = "ts + CASE WHEN CAST(order_id AS BIGINT) % 5 = 0 THEN 2592000000 ELSE 0 END"


def _rows_of_change_log(tables):
    """(table, type, id text, created seconds, offset, status, fields) of business tables."""
    parts = {
        "order_info": f"""
            SELECT 'order_info' AS "table",
                   CASE WHEN o_orderkey % 5 = 0 THEN 'bootstrap-insert' ELSE 'insert' END AS type,
                   CAST(o_orderkey AS VARCHAR) AS id, {ORDER_AT} AS at, o_orderkey AS "offset",
                   {ORDER_STATUS} AS status, {_t(ORDER_AT)} AS create_time, 9 AS fields
            FROM orders""",
        "order_cargo": f"""
            SELECT 'order_cargo', 'insert', l_orderkey || '-' || l_linenumber, {CARGO_AT},
                   l_linenumber, NULL, {_t(CARGO_AT)}, 6
            FROM lineitem""",
        "order_org_bound": f"""
            SELECT 'order_org_bound',
                   CASE WHEN l_orderkey % 5 = 0 THEN 'bootstrap-insert' ELSE 'insert' END,
                   l_orderkey || '-' || l_linenumber,
                   {BOUND_AT} + CASE WHEN l_orderkey % 5 = 0 THEN 30 * 86400 ELSE 0 END,
                   l_orderkey, {BOUND_STATUS}, {_t(BOUND_AT)}, 10
            FROM lineitem""",
        "transport_task": f"""
            SELECT 'transport_task', 'update', 'T' || o_orderkey, {TASK_AT}, o_orderkey,
                   {TASK_STATUS}, NULL, 14
            FROM orders""",
        "transport_task_detail": f"""
            SELECT 'transport_task_detail',
                   CASE WHEN l_returnflag = 'N' THEN 'insert' ELSE 'update' END,
                   l_orderkey || '-' || l_linenumber, {BOUND_AT}, l_orderkey, NULL,
                   {_t(BOUND_AT)}, 5
            FROM lineitem""",
        "express_task_collect": f"""
            SELECT 'express_task_collect', 'update', CAST(event_id AS VARCHAR), {EVENT_AT},
                   event_id, CASE event_type WHEN 'click' THEN '63003' ELSE '63001' END,
                   {_t(EVENT_AT)}, 10
            FROM events WHERE event_type IN ('click', 'view')""",
        "express_task_delivery": f"""
            SELECT 'express_task_delivery', 'update', CAST(event_id AS VARCHAR), {EVENT_AT},
                   event_id, CASE event_type WHEN 'purchase' THEN '68003' ELSE '68001' END,
                   NULL, 6
            FROM events WHERE event_type IN ('purchase', 'signup')""",
    }
    names = '"table", type, id, sec, "offset", status, create_time, fields'
    body = " UNION ALL ".join(parts[t] for t in tables)
    return f"SELECT * FROM ({body}) AS log({names})"


ALL_TABLES = (
    "order_info", "order_cargo", "order_org_bound", "transport_task", "transport_task_detail",
    "express_task_collect", "express_task_delivery",
)

# Which spoiled form a record of the dirty log has; the first residue that applies decides.
DIRTY = f"""
    SELECT *, CASE WHEN "offset" % 13 = 12 THEN 'malformed'
                   WHEN "offset" % 17 = 16 THEN 'malformed'
                   WHEN "offset" % 19 = 18 THEN 'other_database'
                   WHEN "offset" % 23 = 22 THEN 'empty_data'
                   WHEN "offset" % 29 = 28 THEN 'unsupported_type'
                   WHEN "offset" % 31 = 30 THEN 'blank_field'
                   WHEN "offset" % 37 = 36 THEN 'null_value' END AS reason
    FROM ({_rows_of_change_log(ALL_TABLES)})
"""

# ---------------------------------------------------------------- dimensions

# id, number inside the id, and the image as three texts; the third column is '~' if unused.
DIM_ROWS = """
    SELECT 'base_region_info' AS dim, 'P' || r_regionkey AS id, CAST(r_regionkey AS BIGINT) AS n,
           'id,parent_id,name,dict_code,type,ts' AS cols, r_name AS label,
           'P' || r_regionkey || '|86|' AS before_label, '|Province' AS after_label
    FROM region
    UNION ALL
    SELECT 'base_region_info', 'C' || n_nationkey, n_nationkey,
           'id,parent_id,name,dict_code,type,ts', n_name,
           'C' || n_nationkey || '|P' || n_regionkey || '|', '|City'
    FROM nation
    UNION ALL
    SELECT 'base_region_info', here || n_nationkey, n_nationkey,
           'id,parent_id,name,dict_code,type,ts', n_name || '_' || here,
           here || n_nationkey || '|' || above || n_nationkey || '|',
           CASE here WHEN 'D' THEN '|District' ELSE '|Street' END
    FROM nation CROSS JOIN (VALUES ('C', 'D'), ('D', 'E'), ('E', 'F'), ('F', 'G'), ('G', 'H'))
         AS v(above, here)
    UNION ALL
    SELECT 'base_organ', CAST(s_suppkey AS VARCHAR), s_suppkey,
           'id,org_name,region_id,type,ts', s_name, s_suppkey || '|', '|H' || s_nationkey
    FROM supplier
    UNION ALL
    SELECT DISTINCT 'base_dic', 'K' || (p_partkey % 6), p_partkey % 6,
           'id,name,type,ts', 'cargo ' || (p_partkey % 6), 'K' || (p_partkey % 6) || '|', ''
    FROM part
    UNION ALL
    SELECT 'truck_info', CAST(p_partkey AS VARCHAR), p_partkey,
           'id,truck_model_id,truck_no,type,ts',
           CASE WHEN p_partkey % 50 <> 7 THEN p_brand END, p_partkey || '|', '|~'
    FROM part
    UNION ALL
    SELECT DISTINCT 'truck_model', p_brand, CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS BIGINT),
           'id,model_type,model_name,type,ts', p_brand,
           p_brand || '|' || CASE WHEN p_brand < 'Brand#2' THEN 'S' ELSE 'L' END || '|', ''
    FROM part
"""

DIM_FEED = f"""
    SELECT dim, id, n, cols, phase,
           CASE phase WHEN 0 THEN 'insert' WHEN 1 THEN 'update' ELSE 'delete' END AS type,
           ({S} + n + phase * 86400) * 1000 AS ts, n * 3 + phase AS "offset",
           CASE WHEN phase = 0 THEN label ELSE label || '_v2' END AS label,
           before_label, after_label
    FROM ({DIM_ROWS}) CROSS JOIN (VALUES (0), (1), (2)) AS p(phase)
    WHERE phase = 0 OR (phase = 1 AND n % 7 = 0) OR (phase = 2 AND n % 11 = 0)
"""

DIM_IMAGE = "before_label || coalesce(label, '~') || after_label || '|' || type || '|' || ts"

LAST_OF_FEED = f"""
    SELECT * FROM ({DIM_FEED})
    QUALIFY row_number() OVER (PARTITION BY dim, id ORDER BY ts DESC, "offset" DESC) = 1
"""

# A dimension that was emptied or dropped keeps the changes that came afterwards.
LIFECYCLE = f"""
    SELECT * FROM ({DIM_FEED})
    WHERE dim <> 'truck_model' AND (dim NOT IN ('base_organ', 'truck_info') OR phase > 0)
    QUALIFY row_number() OVER (PARTITION BY dim, id ORDER BY ts DESC, "offset" DESC) = 1
"""

CONFIG_IMAGES = f"""
    SELECT event_id, op, 'table_' || user_id AS source_table, event_id % 4 <> 3 AS is_dim,
           'id,c' || event_id AS sink_columns
    FROM (SELECT *, CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r'
                                    WHEN 'purchase' THEN 'd' ELSE 'u' END AS op FROM events)
"""

TASKS = f"""
    SELECT 'T' || o_orderkey AS id, CAST(o_orderkey % 3 AS VARCHAR) AS shift_id,
           CAST(o_orderkey % 7 AS VARCHAR) AS line_id, {TASK_STATUS} AS status,
           CAST(o_orderkey % 4 AS VARCHAR) AS order_num, CAST(o_custkey AS VARCHAR) AS truck_id,
           CAST(o_custkey % 10 AS VARCHAR) AS start_org_id,
           'ORG' || (o_custkey % 10) AS start_org_name,
           {_t(ORDER_AT)} AS actual_start_time, {_t(TASK_END)} AS actual_end_time,
           CAST(floor(o_totalprice / 10) / 100 AS VARCHAR) AS actual_distance,
           {TASK_END} * 1000 AS ts
    FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 4 > 0
"""

TASK_DETAIL = f"""
    SELECT t.id, shift_id, line_id, CAST(l_orderkey AS VARCHAR) AS order_id, status, order_num,
           truck_id, start_org_id, start_org_name, actual_start_time, actual_end_time,
           actual_distance, ts
    FROM ({TASKS}) t JOIN lineitem ON t.id = 'T' || l_orderkey WHERE l_returnflag <> 'N'
"""

SPLIT_CARGO = f"""
    SELECT CAST(l_orderkey AS VARCHAR) AS order_id, 'K' || (l_partkey % 6) AS cargo_type,
           CAST(l_quantity AS VARCHAR) AS weight,
           CAST(l_extendedprice AS VARCHAR) AS volume_length,
           {_t(CARGO_AT)} AS create_time, {CARGO_AT} * 1000 AS ts, 'order_cargo' AS branch,
           NULL AS id, NULL AS amount, NULL AS cargo_num, NULL AS sender_city_id,
           NULL AS sender_province_id
    FROM lineitem
    UNION ALL
    SELECT NULL, NULL, NULL, NULL, NULL, NULL, 'order_info', id, amount, cargo_num, sender_city_id,
           sender_province_id
    FROM ({ORDER_ROW})
"""

CITY_ROLLUP = f"""
    SELECT stt, edt, cur_date, city_id, n_name AS city_name, province_id,
           r_name AS province_name, order_count, total_amount
    FROM (SELECT {_window("ts")}, sender_city_id AS city_id,
                 min(sender_province_id) AS province_id, count(*) AS order_count,
                 round(sum(o_totalprice), 2) AS total_amount
          FROM ({CARGO_FACT}) GROUP BY stt, edt, cur_date, sender_city_id)
    LEFT JOIN nation ON city_id = 'C' || n_nationkey
    LEFT JOIN region ON province_id = 'P' || r_regionkey
"""

# Arrival slices of `stream_late_rows`: three equal spans, every 17th order one slice late.
_LATE_ROWS = f"""
    WITH rows AS (SELECT o_orderkey, ({ORDER_AT} + 60) * 1000 AS ts FROM orders),
    span AS (SELECT min(ts) AS low, (max(ts) - min(ts) + 1 + 2) // 3 AS step FROM rows),
    arrived AS (
        SELECT o_orderkey, ts, least(2, (ts - low) // step
                            + CASE WHEN o_orderkey % 17 = 0 THEN 1 ELSE 0 END) AS slice
        FROM rows, span),
    latest AS (SELECT slice, max(ts) AS high FROM arrived GROUP BY slice),
    before AS (
        SELECT l.slice, (SELECT max(high) FROM latest e WHERE e.slice < l.slice) AS seen
        FROM latest l)
"""
LATE = f"""{_LATE_ROWS}
    SELECT {_t("ts // 5000 * 5")} AS stt,
           count(*) FILTER (WHERE seen IS NULL OR ts // 5000 * 5000 + 5000 > seen - 5000) AS counted,
           count(*) FILTER (WHERE ts // 5000 * 5000 + 5000 <= seen - 5000) AS late
    FROM arrived JOIN before USING (slice) GROUP BY ts // 5000
"""


def _clock(seconds):
    return f"printf('%02d:%02d:%02d', ({seconds}) // 3600, ({seconds}) % 3600 // 60, ({seconds}) % 60)"


ORACLE = {
    "ods_change_table": f"""
        SELECT 'tms' AS "database", "table", type, sec * 1000 AS ts, "offset",
               {_t("sec")} AS et, true AS has_pt, id, status, create_time,
               CAST(fields AS BIGINT) AS fields
        FROM ({_rows_of_change_log(ALL_TABLES)})""",
    "change_type_counts": f"""
        SELECT "table", replace(type, 'bootstrap-', '') AS type, count(*) AS changes
        FROM ({_rows_of_change_log(ALL_TABLES)}) GROUP BY 1, 2""",
    "rejected_rows": f"""
        SELECT reason, count(*) AS rejected FROM ({DIRTY})
        WHERE reason IS NOT NULL GROUP BY reason""",
    "dim_clean": f"""
        SELECT "table", type, sec * 1000 AS ts, "offset", id FROM ({DIRTY}) WHERE reason IS NULL""",
    "split_cargo_and_info": SPLIT_CARGO,
    "split_bound_and_info": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_suppkey AS VARCHAR) AS org_id,
               {BOUND_STATUS} AS status, {_t(BOUND_AT)} AS sort_time,
               CAST(l_partkey % 97 AS VARCHAR) AS outbound_emp_id, {BOUND_AT} * 1000 AS ts,
               'order_org_bound' AS branch, NULL AS id, NULL AS amount, NULL AS cargo_num
        FROM lineitem
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, NULL, NULL, 'order_info', id, amount, cargo_num
        FROM ({ORDER_ROW})""",
    "fn_time": f"""
        SELECT {ORDER_AT} * 1000 AS ts, substr({_t(ORDER_AT)}, 1, 10) AS day,
               {_t(ORDER_AT)} AS moment, {ORDER_AT} // 86400 * 86400000 AS day_ms,
               {ORDER_AT} * 1000 AS moment_ms,
               {_clock(f"{ORDER_AT} % 200000")} AS clock,
               {_clock(f"{ORDER_AT} * 1000 % 200000")} AS clock_s,
               {ORDER_AT} % 200000 AS clock_seconds,
               {ORDER_AT} % 200000 * 1000 AS clock_ms,
               true AS day_is_no_clock
        FROM orders""",
    "dim_config_feed": f"""
        WITH images AS ({CONFIG_IMAGES}),
        effects AS (
            SELECT event_id, op, source_table, sink_columns, 1 AS rank FROM images WHERE is_dim
            UNION ALL
            SELECT i.event_id, 'd', 'table_' || (e.user_id + 1), i.sink_columns, 0
            FROM images i JOIN events e USING (event_id)
            WHERE is_dim AND op = 'u' AND event_id % 10 = 0)
        SELECT source_table, 'ALL' AS source_type, 'dim_' || source_table AS sink_table,
               'DIM' AS sink_type, 'info' AS sink_family, sink_columns, 'id' AS sink_row_key, op
        FROM (SELECT *, row_number() OVER (PARTITION BY source_table
                                           ORDER BY event_id DESC, rank DESC) AS n FROM effects)
        WHERE n = 1 AND op <> 'd'""",
    "dim_config_snapshot": """
        SELECT 'table_' || s_suppkey AS source_table, 'ALL' AS source_type,
               'dim_table_' || s_suppkey AS sink_table, 'DIM' AS sink_type,
               'info' AS sink_family, 'id,name' AS sink_columns, 'id' AS sink_row_key, 'r' AS op
        FROM supplier WHERE s_suppkey % 3 <> 0""",
    "dim_route": f"""
        SELECT dim AS source_table, 'dim_' || dim AS sink_table, type, ts, "offset", id
        FROM ({DIM_FEED})""",
    "dim_project_columns": f"""
        SELECT 'dim_' || dim AS sink_table, id AS row_key, cols AS "columns",
               {DIM_IMAGE} AS "values"
        FROM ({DIM_FEED})""",
    "dim_apply_changes": f"""
        SELECT id, label AS org_name, ltrim(after_label, '|') AS region_id,
               CAST(ts AS VARCHAR) AS ts
        FROM ({LAST_OF_FEED}) WHERE dim = 'base_organ' AND type <> 'delete'""",
    "dim_table_lifecycle": f"""
        SELECT 'dim_' || dim AS sink_table, id AS row_key, cols AS "columns",
               {DIM_IMAGE} AS "values"
        FROM ({LIFECYCLE}) WHERE type <> 'delete'""",
    "dim_snapshot": """
        SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name || '_v2' AS org_name,
               'H' || s_nationkey AS region_id FROM supplier""",
    "upsert_latest_by_key": f"""
        SELECT id AS key,
               CASE WHEN type = 'delete' THEN NULL
                    ELSE '{{"id":"' || id || '"'
                         || coalesce(',"truck_model_id":"' || label || '"', '') || '}}' END AS value
        FROM ({LAST_OF_FEED}) WHERE dim = 'truck_info'""",
    "dic_lookup_table": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, 'K' || (l_partkey % 6) AS cargo_type,
               d.name AS dic_name
        FROM lineitem LEFT JOIN (SELECT DISTINCT p_partkey % 6 AS k,
                                        'cargo ' || (p_partkey % 6) AS name FROM part) d
             ON l_partkey % 6 = d.k""",
    "dim_region_flat": """
        SELECT 'P' || r_regionkey AS region_id, NULL AS city_id, NULL AS city_name,
               'P' || r_regionkey AS province_id, r_name AS province_name FROM region
        UNION ALL
        SELECT level || n_nationkey, 'C' || n_nationkey, n_name, 'P' || r_regionkey, r_name
        FROM nation JOIN region ON n_regionkey = r_regionkey
             CROSS JOIN (VALUES ('C'), ('D'), ('E'), ('F'), ('G'), ('H')) AS v(level)""",
    "join_region": f"""
        SELECT org_id AS id, org_name, region_id, city_id, city_name, province_id, province_name
        FROM ({REGION_OF_ORGAN})""",
    "dwd_order_status": f"""
        SELECT ({ORDER_AT} + 60) * 1000 AS ts, {ORDER_STATUS} AS status,
               'NO' || o_orderkey AS order_no, {_t(f"{ORDER_AT} + 60")} AS update_time,
               {_t(ORDER_AT)} AS create_time
        FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')""",
    "dwd_express_pickup": PICKUP_FACT,
    "dwd_express_deliver": DELIVER_FACT,
    "dwd_express_sorting": SORTING_FACT,
    "dwd_truck_task": f"SELECT {TRUCK_FACT_COLUMNS} FROM ({TRUCK_FACT})",
    "dwd_trade_order_cargo": f"SELECT * EXCLUDE (o_totalprice) FROM ({CARGO_FACT})",
    "dwd_trade_order_org": f"SELECT * EXCLUDE (o_totalprice) FROM ({ORG_FACT})",
    "transport_task_finished": TASKS,
    "transport_task_detail_updates": f"""
        SELECT 'update' AS type, l_orderkey || '-' || l_linenumber AS id,
               CAST(l_orderkey AS VARCHAR) AS order_id, 'T' || l_orderkey AS transport_task_id,
               {_t(BOUND_AT)} AS create_time, {_t(f"{BOUND_AT} + 30")} AS operate_time
        FROM lineitem WHERE l_returnflag <> 'N'""",
    "dwd_transport_task_detail": TASK_DETAIL,
    "window_rollup_generic": f"""
        SELECT stt, edt, cur_date, status, org_id, order_id, bounds, org_sum
        FROM (SELECT *, count(*) OVER g AS bounds, CAST(sum(supp) OVER g AS BIGINT) AS org_sum,
                     row_number() OVER (PARTITION BY stt, status
                                        ORDER BY ts, org_id, order_id) AS n
              FROM (SELECT {_window(f"{BOUND_AT} * 1000", 60000)}, {BOUND_STATUS} AS status,
                           CAST(l_suppkey AS VARCHAR) AS org_id, l_suppkey AS supp,
                           CAST(l_orderkey AS VARCHAR) AS order_id, {BOUND_AT} AS ts
                    FROM lineitem)
              WINDOW g AS (PARTITION BY stt, status))
        WHERE n = 1""",
    "dws_order_status": f"""
        SELECT {_window(f"({ORDER_AT} + 60) * 1000")},
               count(*) FILTER (WHERE o_orderstatus = 'F') AS tack_count,
               count(*) FILTER (WHERE o_orderstatus = 'O') AS send_count,
               count(*) FILTER (WHERE o_orderstatus = 'P') AS tc_count
        FROM orders GROUP BY stt, edt, cur_date""",
    "dws_transport_total": f"""
        SELECT {_window("ts")}, count(*) AS trans_count,
               round(sum(distance), 2) AS trans_distance,
               CAST(sum(diff_time // 1000) AS BIGINT) AS trans_time
        FROM ({TRUCK_FACT}) GROUP BY stt, edt, cur_date""",
    "dws_transport_org": f"""
        SELECT a.*, province_id, province_name, city_id, city_name
        FROM (SELECT {_window("ts")}, start_org_id AS org_id, min(start_org_name) AS org_name,
                     count(*) AS trans_count, round(sum(distance), 2) AS trans_distance,
                     CAST(sum(diff_time // 1000) AS BIGINT) AS trans_time
              FROM ({TRUCK_FACT}) GROUP BY stt, edt, cur_date, start_org_id) a
        LEFT JOIN (SELECT * EXCLUDE (org_name) FROM ({REGION_OF_ORGAN})) r USING (org_id)""",
    "dws_transport_truck": f"""
        SELECT {_window("ts")}, truck_mode_id,
               CASE WHEN truck_mode_id < 'Brand#2' THEN 'S' WHEN truck_mode_id IS NOT NULL
                    THEN 'L' END AS truck_mode_type,
               truck_mode_id AS truck_mode_name, count(*) AS trans_count,
               round(sum(distance), 2) AS trans_distance,
               CAST(sum(diff_time) AS BIGINT) AS trans_time
        FROM (SELECT t.*, CASE WHEN p_partkey % 50 <> 7 THEN p_brand END AS truck_mode_id
              FROM ({TRUCK_FACT}) t LEFT JOIN part ON t.truck_id = CAST(p_partkey AS VARCHAR))
        GROUP BY stt, edt, cur_date, truck_mode_id""",
    "dws_trade_order_cargo": f"""
        SELECT {_window("ts")}, cargo_type, 'cargo ' || substr(cargo_type, 2) AS cargo_name,
               count(*) AS order_count, round(sum(o_totalprice), 2) AS total_amount
        FROM ({CARGO_FACT}) GROUP BY stt, edt, cur_date, cargo_type""",
    "dws_trade_order_city": CITY_ROLLUP,
    "dws_trade_order_org": f"""
        SELECT stt, edt, cur_date, org_id, s_name AS org_name, "count", amount
        FROM (SELECT {_window("ts")}, org_id, count(*) AS "count",
                     round(sum(o_totalprice), 2) AS amount
              FROM ({ORG_FACT}) GROUP BY stt, edt, cur_date, org_id)
        LEFT JOIN supplier ON org_id = CAST(s_suppkey AS VARCHAR)""",
    "dws_express_pickup": _express_rollup(PICKUP_FACT),
    "dws_express_sorting": _express_rollup(SORTING_FACT),
    "dws_express_deliver": _express_rollup(DELIVER_FACT),
    "dws_json_rows": f"""
        SELECT '{{"stt":"' || stt || '","edt":"' || edt || '","cur_date":"' || cur_date || '"'
               || coalesce(',"province_id":"' || province_id || '"', '')
               || coalesce(',"province_name":"' || province_name || '"', '')
               || coalesce(',"city_id":"' || city_id || '"', '')
               || coalesce(',"city_name":"' || city_name || '"', '')
               || ',"org_id":"' || org_id || '"'
               || coalesce(',"org_name":"' || org_name || '"', '')
               || ',"count":' || "count" || '}}' AS value
        FROM ({_express_rollup(PICKUP_FACT)})""",
    "ods_change_stream": f"""
        SELECT 'tms' AS "database", "table", type, sec * 1000 AS ts, "offset", id, status
        FROM ({_rows_of_change_log(ALL_TABLES)})""",
    "stream_fact_sink": f"SELECT {TRUCK_FACT_COLUMNS} FROM ({TRUCK_FACT})",
    "stream_split": SPLIT_CARGO,
    "stream_dws_trade_order_city": CITY_ROLLUP,
    "stream_restart": _express_rollup(SORTING_FACT),
    "stream_late_rows": LATE,
    "stream_trade_order_cargo": f"SELECT * EXCLUDE (o_totalprice) FROM ({CARGO_FACT})",
    "stream_trade_order_org": f"SELECT * EXCLUDE (o_totalprice) FROM ({ORG_FACT})",
    "stream_late_rows_caught": _LATE_ROWS + """
        SELECT 'NO' || o_orderkey AS order_no, ts
        FROM arrived JOIN before USING (slice) WHERE ts // 5000 * 5000 + 5000 <= seen - 5000""",
    "stream_idle_source": f"""
        WITH rows AS (
            SELECT CASE WHEN event_type IN ('click', 'view') THEN 'express_task_collect'
                        ELSE 'express_task_delivery' END AS "table", {EVENT_AT} * 1000 AS ts
            FROM events WHERE event_type IN ('click', 'view', 'purchase', 'signup')),
        span AS (SELECT min(ts) AS low, (max(ts) - min(ts) + 2) // 2 AS step,
                        max(ts) FILTER (WHERE "table" = 'express_task_collect') AS high FROM rows)
        SELECT {_t("ts // 5000 * 5")} AS stt, {_t("ts // 5000 * 5 + 5")} AS edt, "table", count(*) AS changes
        FROM rows, span
        WHERE ("table" = 'express_task_collect' OR (ts - low) // step = 0)
          AND ts // 5000 * 5000 + 5000 <= high - 5000
        GROUP BY "table", ts // 5000""",
    "stream_sql_window": f"""
        SELECT {_t("sec // 60 * 60")} AS stt, "table", count(*) AS changes
        FROM ({_rows_of_change_log(ALL_TABLES)}) WHERE "table" IN ('order_info', 'transport_task')
        GROUP BY "table", sec // 60""",
    "stream_supervised": f"SELECT {TRUCK_FACT_COLUMNS} FROM ({TRUCK_FACT})",
    "stream_read_once": f"SELECT {TRUCK_FACT_COLUMNS} FROM ({TRUCK_FACT})",
    "stream_trade_order_cargo_open": """
        SELECT 'order_cargo' AS side, CAST(l_orderkey AS VARCHAR) AS order_id
        FROM lineitem WHERE l_orderkey % 10 = 3 GROUP BY l_orderkey
        UNION ALL
        SELECT 'order_info', CAST(o_orderkey AS VARCHAR)
        FROM orders WHERE o_orderkey % 10 <> 3
          AND (o_orderkey % 10 = 7 OR NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey))""",
    "stream_trade_order_org_expired": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, count(*) AS bounds FROM lineitem
        WHERE l_orderkey % 10 = 3 OR l_orderkey NOT IN (SELECT o_orderkey FROM orders) GROUP BY l_orderkey""",
    "stream_dws_transport_truck": f"""
        WITH fact AS (SELECT * FROM ({TRUCK_FACT})),
        span AS (SELECT (min(ts) + max(ts)) // 2000 * 1000 AS renamed,
                        (min(ts) + 3 * max(ts)) // 4000 * 1000 AS deleted FROM fact),
        keyed AS (
            SELECT f.*, CASE WHEN p_partkey % 11 = 0 AND ts >= deleted THEN NULL
                             WHEN p_partkey % 50 <> 7
                             THEN p_brand || CASE WHEN p_partkey % 7 = 0 AND ts >= renamed THEN '_v2' ELSE '' END
                        END AS model
            FROM fact f CROSS JOIN span LEFT JOIN part ON truck_id = CAST(p_partkey AS VARCHAR))
        SELECT {_window("ts")}, model AS truck_mode_id,
               CASE WHEN model LIKE '%_v2' THEN NULL WHEN model < 'Brand#2' THEN 'S'
                    WHEN model IS NOT NULL THEN 'L' END AS truck_mode_type,
               CASE WHEN model NOT LIKE '%_v2' THEN model END AS truck_mode_name,
               count(*) AS trans_count, round(sum(distance), 2) AS trans_distance,
               CAST(sum(diff_time) AS BIGINT) AS trans_time
        FROM keyed GROUP BY stt, edt, cur_date, model""",
    "stream_transport_task_detail": TASK_DETAIL,
    "stream_dim_apply_changes": f"""
        SELECT dim, id, label, type, CAST(ts AS VARCHAR) AS ts
        FROM ({LIFECYCLE}) WHERE type <> 'delete'""",
    "stream_upsert_latest": f"""
        SELECT CAST(o_custkey AS VARCHAR) AS truck_id, 'T' || o_orderkey AS id
        FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
                                           ORDER BY {TASK_AT} DESC, o_orderkey DESC) AS n
              FROM orders)
        WHERE n = 1 AND o_orderstatus <> 'P'""",
    "stream_lookup_latest": f"""
        WITH parcels AS (
            SELECT event_id, CAST(user_id % 10 AS VARCHAR) AS org_id, {EVENT_AT} * 1000 AS ts
            FROM events WHERE event_type IN ('click', 'view')),
        span AS (SELECT min(ts) AS low, (max(ts) - min(ts) + 2) // 2 AS step FROM parcels)
        SELECT CAST(event_id AS VARCHAR) AS id, org_id,
               CASE WHEN least(1, (ts - low) // step) = 0 THEN s_name
                    ELSE s_name || '_v2' END AS org_name
        FROM parcels CROSS JOIN span LEFT JOIN supplier ON org_id = CAST(s_suppkey AS VARCHAR)""",
    "stream_task_detail_sink": TASK_DETAIL,
    "stream_express_pickup": _renamed(PICKUP_FACT, f"""
        SELECT {EVENT_AT} * 1000 AS moment FROM events WHERE event_type IN ('click', 'view')"""),
    "stream_express_deliver": _renamed(DELIVER_FACT, f"""
        SELECT {EVENT_AT} * 1000 AS moment FROM events WHERE event_type IN ('purchase', 'signup')"""),
    "stream_express_sorting": _renamed(SORTING_FACT, f"SELECT {BOUND_ARRIVAL} AS moment FROM lineitem",
                                       f"({BOUND_ARRIVED})"),
}
ORACLE["stream_dws_json_rows"] = ORACLE["dws_json_rows"]
# A stream gives what a batch gives.
for _name in (
    "order_status", "transport_total", "transport_org", "trade_order_cargo", "trade_order_org",
    "express_pickup", "express_deliver",
):
    ORACLE[f"stream_dws_{_name}"] = ORACLE[f"dws_{_name}"]
