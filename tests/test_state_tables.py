"""Streams whose state is a table: pairs, windows, lookups as of a time, supervised jobs."""

import glob
import json

import duckdb
import pytest
from compare import differences
from freightflow import session
from freightflow.catalog import ORACLE, QUERIES
from freightflow.operators import flatten_regions, join_region, lookup_as_of, window_rollup
from freightflow.plans import facts
from freightflow.session import work_folder
from freightflow.sources import DimensionStore, parse_changes, parse_facts, read_files, read_once
from freightflow.streaming import (
    Progress,
    attach_sink,
    batch_folders,
    enrich_latest,
    enrich_once,
    file_sink,
    join_sink,
    kafka_rows,
    pair_sink,
    read_batches,
    read_open,
    read_windows,
    replay,
    run_stream,
    run_supervised,
    window_sink,
    windows_to,
)
from pyspark.errors import StreamingQueryException
from pyspark.sql import types as T

S = 1704067200000


def lines(spark, records):
    return spark.createDataFrame([(json.dumps(r),) for r in records], "value string")


def change(table, ts, **data):
    return {"database": "tms", "table": table, "type": "insert", "ts": ts, "offset": ts, "data": data}


def moment(second):
    return f"2024-01-01 00:00:{second:02d}"


def run(spark, batches, transform, sink):
    root = work_folder(spark, "test-state")

    def start():
        return run_stream(
            "test", read_files(spark, f"{root}/in"), transform, sink(root), f"{root}/checkpoint",
            available_now=True, state_partitions=2,
        )

    replay([lines(spark, b) for b in batches], f"{root}/in", start)
    return root


def cargo(o, kind="k", at=S):
    return change("order_cargo", at, order_id=o, cargo_type=kind, create_time=moment(0))


def order(o, at=S):
    return change("order_info", at, id=o, amount="1", cargo_num="1")


def left(spark, root):
    return read_open(spark, root).collect()


def pairs(raw):
    return facts.cargo_sides(parse_changes(raw, ["order_info", "order_cargo"]))


def test_a_pair_leaves_the_state(spark):
    root = run(spark, [
        [cargo("1"), cargo("1", "later", S + 1), order("2"), cargo("3")],
        [order("1"), order("1"), cargo("2"), cargo("4")],
        [cargo("1", "again"), order("1"), order("2"), order("5"), cargo(None), order(None)],
    ], pairs, pair_sink)
    out = spark.read.parquet(f"{root}/out").collect()
    assert sorted((r["order_id"], r["id"], r["cargo_type"]) for r in out) == [("1", "1", "k"), ("2", "2", "k")]
    assert sorted((r["key"], r["many"] is None) for r in left(spark, root)) == [
        ("3", False), ("4", False), ("5", True)
    ]


@pytest.mark.parametrize("compact", [2, 64])
def test_waiting_rows_expire_into_a_table(spark, compact):
    root = run(spark, [
        [cargo("1"), order("2")], [cargo("9", at=S + 70_000)], [order("1", S + 120_000)],
        [order("9", S + 90_000), cargo("2", at=S + 121_000), cargo("9", at=S + 95_000)], [cargo("9", "new", S + 500_000)],
    ], pairs, lambda root: pair_sink(root, keep_ms=60_000, compact=compact))
    out = [r["order_id"] for r in spark.read.parquet(f"{root}/out").collect()]
    gone = [(r["key"], r["many"] is None) for r in spark.read.parquet(f"{root}/expired").collect()]
    # 1 and the order 2 had waited too long when 9 came, so their partners come too late for them
    assert out == ["9"] and sorted(gone) == [("1", False), ("1", True), ("2", False), ("2", True)]
    assert [r["key"] for r in left(spark, root)] == []


def bound(o, org, at=S):
    return change("order_org_bound", at, order_id=o, org_id=org, status="1", create_time=moment(1), sort_time=moment(1))


@pytest.mark.parametrize("compact", [2, 64])
def test_bounds_meet_their_order_whenever_they_come(spark, compact):
    root = run(spark, [
        [bound("1", "a"), bound("1", "b"), bound("2", "x")],
        [order("1"), order("1"), bound("1", "c"), bound("9", "late")],
        [bound("1", "d"), order("1"), bound(None, "n")], [bound("1", "e")], [order("2"), bound("1", "f")],
        [order("far", S + 10_000_000), bound("1", "g", S + 9_999_000)],
    ], lambda raw: facts.org_sides(parse_changes(raw, ["order_info", "order_org_bound"])),
        lambda root: attach_sink(root, keep_ms=1_000_000, compact=compact))
    out = [(r["order_id"], r["org_id"], r["id"]) for r in spark.read.parquet(f"{root}/out").collect()]
    assert sorted(out) == [*(("1", c, "1") for c in "abcdefg"), ("2", "x", "2")]
    assert [r["key"] for r in spark.read.parquet(f"{root}/expired").collect()] == ["9"]
    assert left(spark, root) == []


def test_a_repeated_batch_gives_the_same(spark):
    """Every batch is handled twice, as after a failure between its writes and its commit."""
    written = []

    def twice(root):
        class Writer:
            def outputMode(self, _):
                return self

            def foreachBatch(self, write):
                written.append(write)
                return self

        def sink(writer):
            attach_sink(root, compact=2)(Writer())
            window_sink(f"{root}/w", ["key"], count="n")(Writer())

            def both(df, batch_id):
                rows = df.persist()
                for _ in range(2):
                    written[-2](rows, batch_id)
                    written[-1](rows.selectExpr("key", "arrived AS ts"), batch_id)

            return writer.outputMode("append").foreachBatch(both)

        return sink

    root = run(spark, [[bound("1", "a"), order("2")], [order("1"), bound("2", "b")], [bound("1", "c", S + 60_000)]],
               lambda raw: facts.org_sides(parse_changes(raw)), twice)
    out = [(r["org_id"], r["id"]) for r in spark.read.parquet(f"{root}/out").collect()]
    assert sorted(out) == [("a", "1"), ("b", "2"), ("c", "1")]
    windows = spark.read.parquet(f"{root}/w/out").collect()
    assert sorted((r["key"], r["n"]) for r in windows) == [("1", 2), ("2", 2)]


def test_windows_late_rows_and_restarts(spark):
    def rows(*items):
        return [{"ts": S + ts, "k": k, "v": v, "a": a} for ts, k, v, a in items]

    batches = [
        rows((0, "x", 1, "b"), (4_999, "x", 2, "c"), (100, None, 4, None)) + [{"k": "no time"}],
        rows((9_000, "x", 1, "a"), (12_000, "y", 1, "d")),
        rows((4_998, "x", 8, "late"), (7_000, "x", 2, "e"), (60_000, "z", 1, "f")),
    ]
    schema = "ts long, k string, v long, a string"
    root = run(spark, batches, lambda raw: parse_facts(raw, schema),
               lambda root: window_sink(root, ["k"], count="n", sums={"total": "v"}, firsts=["a"]))
    out = spark.read.parquet(f"{root}/out").drop("run", "batch_id")
    caught = spark.read.parquet(f"{root}/late").collect()
    assert [(r["ts"] - S, r["a"]) for r in caught] == [(4_998, "late")]
    kept = [r for b in batches for r in b if r.get("a") not in ("late", "f") and "ts" in r]
    plain = window_rollup(spark.createDataFrame([(r["ts"], r["k"], r["v"], r["a"]) for r in kept], schema),
                          ["k"], count="n", sums={"total": "v"}, firsts=["a"])
    assert out.columns == plain.columns and sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))


def test_a_silent_source_holds_windows_back_until_it_is_idle(spark):
    batches = [[{"ts": S, "src": "a"}, {"ts": S, "src": "b"}], [{"ts": S + 60_000, "src": "a"}], [{"ts": S + 61_000, "src": "a"}],
               [{"ts": S + 1_000, "src": "b"}]]
    for idle, out_rows, late_rows in ((None, 0, 0), (15, 2, 1)):
        clock = iter(range(0, 1000, 10))
        root = run(spark, batches, lambda raw: parse_facts(raw, "ts long, src string"), lambda root: window_sink(
            root, ["src"], count="n", source="src", sources=["a", "b"], idle_after_ms=idle, now=lambda: next(clock)))
        assert spark.read.parquet(f"{root}/out").count() == out_rows
        late = spark.read.parquet(f"{root}/late").count() if late_rows else 0
        assert late == late_rows


def test_lookup_as_of(spark):
    history = spark.createDataFrame([
        ("t", 100, 1, False, "m1"), ("t", 200, 2, False, "m2"), ("t", 200, 3, False, "m3"), ("t", 300, 4, True, "m3"),
        ("t", 400, 5, False, "m4"), ("gone", 50, 6, True, "x"), (None, 1, 7, False, "null"), ("one", 500, 8, False, None),
    ], "id string, since long, seq long, gone boolean, model string")
    rows = [("t", 50), ("t", 100), ("t", 199), ("t", 200), ("t", 299), ("t", 300), ("t", 400), ("t", None), ("gone", 60),
            (None, 10), ("one", 1), ("other", 1), ("t", 200)]
    found = lookup_as_of(spark.createDataFrame(rows, "k string, ts long"), history, "k", {"m": "model"})
    want = ["m1", "m1", "m1", "m3", "m3", None, "m4", None, None, None, None, None, "m3"]
    assert sorted(map(str, found.collect())) == sorted(str(T.Row(k=k, ts=t, m=m)) for (k, t), m in zip(rows, want))
    assert found.columns == ["k", "ts", "m"]


def test_a_complete_batch_is_not_written_again(spark):
    root, tables = work_folder(spark, "test-once"), []
    schema = T.StructType([T.StructField("ts", T.LongType()), T.StructField("name", T.StringType())])

    def names():
        tables.append(1)
        return spark.createDataFrame([(f"v{len(tables)}",)], "name string")

    sink = enrich_once(lambda df, names: parse_facts(df, "ts long").join(names), {"names": names}, f"{root}/out")

    class Writer:
        def outputMode(self, _):
            return self

        def foreachBatch(self, write):
            self.write = write
            return self

    writer = sink(Writer())
    for _ in range(2):
        writer.write(lines(spark, [{"ts": 1}, {"ts": 2}]), 0)
    run_stream("once", read_batches(spark, f"{root}/out", schema), lambda df: df, batch_folders(f"{root}/read"),
               f"{root}/checkpoint", available_now=True).awaitTermination()
    assert sorted((r["ts"], r["name"]) for r in spark.read.parquet(f"{root}/read").collect()) == [(1, "v1"), (2, "v1")]
    assert len(tables) == 1


def test_supervisor_gives_up_after_its_restarts(spark):
    root, tries, seen = work_folder(spark, "test-supervisor"), [], Progress()
    lines(spark, [{"ts": 1}]).write.text(f"{root}/in")

    def start(fail):
        def write(df, batch_id):
            tries.append(batch_id)
            df.count()
            if len(tries) <= fail:
                raise RuntimeError("no")

        return lambda: run_stream("supervised", read_files(spark, f"{root}/in"), lambda df: df,
                                  lambda w: w.foreachBatch(write), f"{root}/checkpoint-{fail}", available_now=True)

    spark.streams.addListener(seen)
    try:
        assert run_supervised(start(2), pause=0) == 2
        tries.clear()
        with pytest.raises(StreamingQueryException):
            run_supervised(start(9), restarts=1, pause=0)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.streams.removeListener(seen)
    assert len(tries) == 2 and (0, 1) in seen.batches["supervised"]
    assert len(seen.failures["supervised"]) == 4 and "no" in seen.failures["supervised"][0]


def test_messages_are_read_once(spark):
    rows = spark.createDataFrame([(1, "a", "p1"), (1, "a", "p2"), (1, "a", "p1")], "ts long, k string, place string")
    messages = kafka_rows(rows, identity=["place"])
    assert read_once(messages, "ts long, k string").collect() == [(1, "a"), (1, "a")]
    assert read_once(kafka_rows(rows).selectExpr("*", "cast(null AS array<struct<key: string, value: binary>>) AS headers"),
                     "ts long, k string").count() == 3


def test_a_tree_is_flattened_once_for_each_version(spark):
    """Three batches and two versions of the regions: two flattenings, and names of the newest version."""
    root, flattened = work_folder(spark, "test-derived"), []
    store, schema = DimensionStore(spark, f"{root}/store"), "id string, parent_id string, name string, dict_code string"
    tree = [("1", "86", "north", "Province"), ("2", "1", "town", "City"), ("3", "2", "street", "Street")]

    def flat(regions):
        flattened.append(1)
        return flatten_regions(regions)

    derived = {"regions": flat}
    store.write("regions", spark.createDataFrame(tree, schema))
    query_batches = [[{"ts": 1, "region": "3"}], [{"ts": 2, "region": "2"}]]
    sink = enrich_latest(lambda df, regions: join_region(df, regions, "region"), store,
                         {"regions": ("regions", schema)}, f"{root}/out", derived=derived)

    class Writer:
        def outputMode(self, _):
            return self

        def foreachBatch(self, write):
            self.write = write
            return self

    writer = sink(Writer())
    for i, b in enumerate(query_batches):
        writer.write(parse_facts(lines(spark, b), "ts long, region string"), i)
    assert len(flattened) == 1
    store.write("regions", spark.createDataFrame([(i, p, n + "_v2", c) for i, p, n, c in tree], schema), 1)
    for i in (2, 3):
        writer.write(parse_facts(lines(spark, [{"ts": i + 1, "region": "3"}]), "ts long, region string"), i)
    assert len(flattened) == 2
    rows = {r["ts"]: r["city_name"] for r in spark.read.parquet(f"{root}/out").collect()}
    assert rows == {1: "town", 2: "town", 3: "town_v2", 4: "town_v2"}


def test_windows_that_come_again_replace_the_first(spark):
    root = work_folder(spark, "test-again")

    class Writer:
        def outputMode(self, _):
            return self

        def foreachBatch(self, write):
            self.write = write
            return self

    clock = iter(range(100))
    writer = windows_to(f"{root}/out", now=lambda: next(clock))(Writer())
    for batch, rows in ((0, [("w1", "a", 1), ("w1", None, 2)]), (1, [("w2", "a", 3)]), (1, [("w2", "a", 4)]),
                        (2, [("w1", "a", 5)])):
        writer.write(spark.createDataFrame(rows, "stt string, k string, n long"), batch)
    got = read_windows(spark, f"{root}/out", ["k"])
    assert got.columns == ["stt", "k", "n"]
    assert sorted(map(tuple, got.collect()), key=str) == [("w1", "a", 5), ("w1", None, 2), ("w2", "a", 4)]


def test_a_fact_at_the_moment_of_the_rename_has_the_new_model(spark, tmp_path):
    """Three transports of one truck; the second ends at the very moment at which its model changes."""
    orders = [(n, 14, "F", 100.0) for n in (0, 100, 200)]
    tables = {
        "orders": spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double"),
        "part": spark.createDataFrame([(14, "Brand#11")], "p_partkey long, p_brand string"),
    }
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    got = QUERIES["stream_dws_transport_truck"](spark, str(tmp_path))
    assert sorted(r["truck_mode_id"] for r in got.collect()) == ["Brand#11", "Brand#11_v2", "Brand#11_v2"]
    assert differences(got, con, ORACLE["stream_dws_transport_truck"]) is None


def test_messages_with_old_facts_are_read_too(spark):
    """The second run brings a repeat, and a fact that is ten days older than those of the first."""
    root, schema = work_folder(spark, "test-once"), "ts long, k string, place string"
    day = 86_400_000
    for rows in ([(S, "new", "p1")], [(S, "new", "p1"), (S - 10 * day, "old", "p2"), (S + 10 * day, "last", "p3")]):
        messages = kafka_rows(spark.createDataFrame(rows, schema), identity=["place"])
        messages.write.mode("append").parquet(f"{root}/in")
        run_stream(
            "test-once", spark.readStream.schema(messages.schema).parquet(f"{root}/in"),
            lambda m: read_once(m, "ts long, k string"), file_sink(f"{root}/out"), f"{root}/checkpoint",
            available_now=True, state_partitions=2,
        ).awaitTermination()
    assert sorted(r["k"] for r in spark.read.parquet(f"{root}/out").collect()) == ["last", "new", "old"]


def test_details_meet_all_tasks_whichever_come_first(spark):
    """Three batches; a detail before its two tasks, one after them, and one whose task never comes."""

    def updated(table, ts, **data):
        return {**change(table, ts, **data), "type": "update"}

    def detail(task, order):
        return updated("transport_task_detail", S, id=f"d{order}", order_id=order, transport_task_id=task)

    def task(id, ts):
        return updated("transport_task", ts, id=id, order_num="2", actual_end_time=moment(1))

    batches = [
        [detail("T1", "1"), detail("T9", "9"), detail(None, "8"), task("T2", S)],
        [task("T1", S + 1), task("T1", S + 2), detail("T2", "2"), updated("transport_task", S, id="T9", order_num="0")],
        [detail("T1", "3"), task(None, S)],
    ]
    root = run(spark, batches, lambda raw: facts.detail_sides(parse_changes(raw)), join_sink)
    got = spark.read.parquet(f"{root}/out")
    rows = sorted((r["order_id"], r["id"], r["ts"] - S) for r in got.collect())
    assert rows == [("1", "T1", 1), ("1", "T1", 2), ("2", "T2", 0), ("3", "T1", 1), ("3", "T1", 2)]
    changes = parse_changes(lines(spark, [r for b in batches for r in b]))
    want = facts.transport_task_detail(changes)
    assert sorted(got.select(*want.columns).collect()) == sorted(want.collect())


def test_both_sides_are_read_in_one_pass(spark):
    """The log is parsed once, and the sides are those of the builders that parse it for themselves."""
    order = {"id": "1", "amount": "5", "cargo_num": "1", "sender_city_id": "C", "sender_province_id": "P"}
    bound = {"id": "b", "order_id": "1", "org_id": "7"}
    records = [
        change("order_info", S, **order), change("order_info", S, amount="5"),
        cargo("1"), {**cargo("2"), "type": "update"}, {**cargo("3"), "type": "bootstrap-insert"}, cargo(None),
        change("order_cargo", S, order_id="4", create_time="never"), {**cargo("5"), "database": "other"},
        change("order_org_bound", S, create_time=moment(3), **bound), change("order_org_bound", S, **bound),
        change("transport_task", S, id="1", order_id="1", create_time=moment(0)),
    ]
    changes = parse_changes(lines(spark, records))
    for sides, many in (
        (facts.cargo_sides(changes), facts.cargo_inserts(changes).drop("arrived", "offset")),
        (facts.org_sides(changes), facts.bound_inserts(changes).drop("arrived")),
    ):
        assert "Union" not in sides._jdf.queryExecution().optimizedPlan().toString()
        ones = facts.order_inserts(changes, *(c for c in sides.schema["one"].dataType.names if c != "id"))
        assert sorted(sides.where("many IS NOT NULL").select("many.*").collect(), key=str) == sorted(many.collect(), key=str)
        assert sides.where("one IS NOT NULL").select("one.*").collect() == ones.drop("arrived", "offset").collect()
        assert sides.where("(many IS NULL) = (one IS NULL) OR key IS NULL").count() == 0


def test_the_sorting_windows_pass_no_state_store(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or session._local_base()
    found = lambda: set(glob.glob(f"{base.removeprefix('file:')}/freightflow/stream_restart-*/checkpoint"))
    before = found()
    rows = QUERIES["stream_restart"](spark, "/root/testdata/sf0.001")
    (checkpoint,) = found() - before
    assert glob.glob(f"{checkpoint}/commits/*") and not glob.glob(f"{checkpoint}/state")
    expected = QUERIES["dws_express_sorting"](spark, "/root/testdata/sf0.001")
    assert rows.columns == expected.columns and rows.exceptAll(expected).isEmpty()
    assert rows.count() == expected.count() > 0
