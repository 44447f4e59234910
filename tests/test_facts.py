from freightflow.plans import facts
from freightflow.schemas import ENVELOPE, FACTS

T0, T1 = "2024-01-01 00:00:00", "2024-01-01 00:10:00"


def log(spark, *rows):
    """Rows are (table, type, ts, data)."""
    changes = [
        ("tms", table, kind, ts, n, {k: None if v is None else str(v) for k, v in data.items()},
         None)
        for n, (table, kind, ts, data) in enumerate(rows)
    ]
    return spark.createDataFrame(changes, ENVELOPE)


def cargo(order_id, kind="insert", ts=1, **more):
    data = {"id": 1, "order_id": order_id, "cargo_type": "a", "create_time": T0, **more}
    return ("order_cargo", kind, ts, data)


def order(id_, kind="insert", ts=1, **more):
    data = {"id": id_, "amount": "5", "cargo_num": 1, "sender_city_id": "c",
            "sender_province_id": "p", "status": "60030", "update_time": T1,
            "create_time": T0, "order_no": f"n{id_}", **more}
    return ("order_info", kind, ts, data)


def bound(order_id, org, kind="insert", **more):
    data = {"id": 1, "order_id": order_id, "org_id": org, "status": "64003",
            "sort_time": T0, "create_time": T1, **more}
    return ("order_org_bound", kind, 1, data)


def task(**more):
    data = {"id": "t1", "status": "67004", "order_num": 2, "truck_id": 3, "actual_distance": "1.5",
            "actual_start_time": T0, "actual_end_time": T1, "update_time": T1, **more}
    return ("transport_task", "update", 1, data)


def test_columns_are_the_declared_ones(spark):
    changes = log(spark, cargo(1), order(1), bound(1, 2), task())
    organ = spark.createDataFrame([("2", "o", "r")], "id string, org_name string, region_id string")
    tree = spark.createDataFrame(
        [("r", "86", "x", "City")], "id string, parent_id string, name string, dict_code string"
    )
    built = {
        "dwd_order_status_count": facts.order_status(changes),
        "dwd_express_pickup": facts.express_pickup(changes, organ, tree),
        "dwd_express_deliver": facts.express_deliver(changes, organ, tree),
        "dwd_express_sorting": facts.express_sorting(changes, organ, tree),
        "dwd_trade_order_cargo": facts.trade_order_cargo(changes),
        "dwd_trade_order_org": facts.trade_order_org(changes),
        "dwd_transport_truck_task": facts.truck_task(changes),
        "dwd_transport_task_detail": facts.transport_task_detail(changes),
    }
    for name, df in built.items():
        declared = {f.name: f.dataType for f in FACTS[name]}
        assert {f.name: f.dataType for f in df.schema} == declared, name


def test_order_status(spark):
    changes = log(
        spark, order(1), order(1, "update", status="60050"), order(2, status="60010"),
        order(3, update_time="soon"), order(4, status=None),
        ("other_table", "insert", 1, {"status": "60030", "update_time": T0}),
    )
    rows = facts.order_status(changes).collect()
    assert sorted((r["order_no"], r["status"]) for r in rows) == [("n1", "60030"), ("n1", "60050")]
    assert rows[0]["ts"] == 1704067800000


def test_truck_task_needs_all_times(spark):
    changes = log(
        spark, task(), task(actual_start_time=None), task(actual_end_time="x"),
        task(update_time=None), task(status="67003"),
    )
    rows = facts.truck_task(changes).collect()
    assert [(r["diff_time"], r["actual_distance"]) for r in rows] == [(600000, "1.5")]


def test_cargo_pairs_once(spark):
    changes = log(
        spark, cargo(1, ts=3, cargo_type="late"), cargo(1, ts=2, cargo_type="first"),
        order(1), order(1, "bootstrap-insert"), cargo(2), order(3), cargo(4, "update"), order(4),
        cargo(5, create_time="?"), order(5),
    )
    rows = facts.trade_order_cargo(changes).collect()
    assert [(r["order_id"], r["cargo_type"], r["amount"]) for r in rows] == [("1", "first", "5")]


def test_every_bound_meets_its_order(spark):
    changes = log(
        spark, bound(1, 7), bound(1, 8), order(1, ts=2, amount="first"),
        order(1, ts=3, amount="second"), bound(1, 9), bound(2, 7), order(3),
    )
    rows = facts.trade_order_org(changes).collect()
    assert sorted((r["org_id"], r["amount"]) for r in rows) == [
        ("7", "first"), ("8", "first"), ("9", "first"),
    ]


def test_task_details_many_to_many(spark):
    def detail(task_id, order_id, kind="update"):
        return ("transport_task_detail", kind, 1, {"transport_task_id": task_id,
                                                   "order_id": order_id})

    changes = log(
        spark, task(), task(status="67005"), task(id="t2", order_num="0"),
        task(id="t3", order_num="x"), task(id="t4", order_num=None),
        task(id="t5", actual_end_time=None), detail("t1", 1), detail("t1", 2),
        detail("t1", 3, "insert"), *[detail(f"t{n}", n) for n in range(2, 6)],
    )
    rows = facts.transport_task_detail(changes).collect()
    assert sorted((r["id"], r["status"], r["order_id"]) for r in rows) == [
        ("t1", "67004", "1"), ("t1", "67004", "2"), ("t1", "67005", "1"), ("t1", "67005", "2"),
    ]


def test_other_databases_do_not_count(spark):
    changes = log(spark, order(1)).replace("tms", "other", "database")
    assert facts.order_status(changes).count() == 0


def test_once_per_state(spark):
    changes = log(spark, order(1), order(1, "update", update_time=T0), order(1, status="60050"))
    rows = facts.once_per_state(facts.order_status(changes), ["order_no", "status"]).collect()
    assert sorted((r["status"], r["update_time"]) for r in rows) == [
        ("60030", T0), ("60050", T1),
    ]
