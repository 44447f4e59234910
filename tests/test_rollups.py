import pytest
from freightflow.operators import window_rollup
from freightflow.plans import rollups
from freightflow.schemas import FACTS, ROLLUP_COLUMNS
from freightflow.operators.rollup import STAMPS

S = 1704067200000


def frame(spark, rows):
    return spark.createDataFrame(
        [(S + ms, k, v, a) for ms, k, v, a in rows], "ts long, k string, v double, a string"
    )


def test_window_edges_and_stamps(spark):
    df = frame(spark, [(0, "x", 1.0, ""), (4999, "x", 2.0, ""), (5000, "x", 4.0, ""),
                       (9999, "x", 8.0, ""), (10000, "x", 16.0, "")])
    out = window_rollup(df, ["k"], count="n", sums={"total": "v"}).orderBy("stt").collect()
    assert [tuple(r) for r in out] == [
        ("2024-01-01 00:00:00", "2024-01-01 00:00:05", "2024-01-01", "x", 2, 3.0),
        ("2024-01-01 00:00:05", "2024-01-01 00:00:10", "2024-01-01", "x", 2, 12.0),
        ("2024-01-01 00:00:10", "2024-01-01 00:00:15", "2024-01-01", "x", 1, 16.0),
    ]


@pytest.mark.parametrize("dependent", [True, False])
def test_first_attributes_come_from_the_earliest_row(spark, dependent):
    df = frame(spark, [(30, "x", 1.0, "b"), (10, "x", 1.0, "c"), (20, "x", 1.0, "a"),
                       (40, "y", 1.0, None), (41, "y", 1.0, "z")])
    out = window_rollup(df, ["k"], count="n", sums={"v": "v"}, firsts=["a"], dependent=dependent)
    assert {r["k"]: (r["a"], r["n"], r["v"]) for r in out.collect()} == {
        "x": ("c", 3, 3.0), "y": (None, 2, 2.0),
    }


def test_nulls(spark):
    df = frame(spark, [(0, None, 1.0, ""), (1, None, None, ""), (2, "x", None, "")])
    df = df.unionByName(df.limit(1).selectExpr("cast(null as long) ts", "k", "v", "a"))
    out = window_rollup(df, ["k"], count="n", sums={"total": "v"}).collect()
    assert {r["k"]: (r["n"], r["total"]) for r in out} == {None: (2, 1.0), "x": (1, None)}


def test_counts_add_up_to_the_rows(spark):
    df = spark.range(1000).selectExpr(
        f"{S} + id * id % 60000 AS ts", "cast(id % 7 as string) AS k", "id * 1.0D AS v",
        "cast(id % 3 as string) AS a",
    )
    for dependent in (True, False):
        out = window_rollup(df, ["k"], count="n", firsts=["a"], dependent=dependent)
        assert out.selectExpr("sum(n)").first()[0] == 1000


def test_shapes_and_units(spark):
    task = ("12.5", "e", "s", "1", "ORG", "9", "2", "2", "END", S, 61999)
    trucks = spark.createDataFrame([task, task], FACTS["dwd_transport_truck_task"])
    organ = spark.createDataFrame([("1", "o", "r")], "id string, org_name string, region_id string")
    tree = spark.createDataFrame(
        [("r", "86", "x", "City")], "id string, parent_id string, name string, dict_code string"
    )
    info = spark.createDataFrame([("9", "m")], "id string, truck_model_id string")
    model = spark.createDataFrame(
        [("m", "big", "Big")], "id string, model_type string, model_name string"
    )
    total = rollups.transport_total(trucks).first()
    assert (total["trans_count"], total["trans_distance"], total["trans_time"]) == (2, 25.0, 122)
    org = rollups.transport_org(trucks, organ, tree)
    assert org.columns == [*STAMPS, *ROLLUP_COLUMNS["dws_transport_city_org_view_window"]]
    assert org.first()["trans_time"] == 122 and org.first()["org_name"] == "ORG"
    truck = rollups.transport_truck(trucks, info, model).first()
    assert (truck["trans_time"], truck["truck_mode_name"]) == (123998, "Big")


def test_json_rows_leave_nulls_out(spark):
    df = spark.createDataFrame([("a", None, 1)], "stt string, org_name string, n long")
    assert rollups.json_rows(df).first()["value"] == '{"stt":"a","n":1}'
