import json
from importlib import import_module

from freightflow.catalog import queries
from freightflow.operators import window_rollup
from freightflow.plans import facts
from freightflow.session import work_folder
from freightflow.sources import POSITION, parse_changes, parse_facts, read_files
from freightflow.streaming import (
    batch_folders,
    fan_out,
    file_sink,
    kafka_rows,
    land,
    replay,
    run_sql_stream,
    run_stream,
)
from freightflow.streaming.sinks import exists

SF = "/root/testdata/sf0.001"
S = 1704067200000
FAR = 4102444800000


def lines(spark, records):
    return spark.createDataFrame([(json.dumps(r),) for r in records], "value string")


def run(spark, batches, transform, sink=file_sink):
    root = work_folder(spark, "test")

    def start():
        return run_stream(
            "test", read_files(spark, f"{root}/in"), transform, sink(f"{root}/out"),
            f"{root}/checkpoint", available_now=True, state_partitions=2,
        )

    replay([lines(spark, b) for b in batches], f"{root}/in", start)
    return spark.read.parquet(f"{root}/out")


def counts(raw):
    return window_rollup(parse_facts(raw, "ts long, k string"), ["k"], count="n")


def test_late_rows_vanish_once_their_window_closed(spark):
    out = run(spark, [
        [{"ts": S, "k": "a"}, {"ts": S + 10_000, "k": "a"}],
        # Seen: 10 s, so windows that end by 5 s are closed. Same-batch disorder is fine.
        [{"ts": S + 4_999, "k": "late"}, {"ts": S + 5_000, "k": "kept"}, {"ts": FAR, "k": "z"}],
    ], counts)
    assert sorted((r["stt"][-2:], r["k"], r["n"]) for r in out.collect()) == [
        ("00", "a", 1), ("05", "kept", 1), ("10", "a", 1),
    ]


def test_restart_neither_loses_nor_repeats(spark):
    batches = [[{"ts": S + i * 1000 + n, "k": "a"} for n in range(3)] for i in range(0, 20, 5)]
    out = run(spark, [*batches, [{"ts": FAR, "k": "z"}]], counts)
    assert sorted((r["stt"][-2:], r["n"]) for r in out.collect()) == [
        ("00", 3), ("05", 3), ("10", 3), ("15", 3),
    ]


def change(table, ts, **data):
    return {"database": "tms", "table": table, "type": "insert", "ts": ts, "offset": ts, "data": data}


def moment(second):
    return f"2024-01-01 00:00:{second:02d}"


def test_cargo_and_order_pair_in_either_order(spark):
    def cargo(o):
        return change("order_cargo", S, order_id=o, cargo_type="k", create_time=moment(0))

    def order(o):
        return change("order_info", S + 1, id=o, amount="1", cargo_num="1")

    out = run(spark, [
        [cargo("1"), cargo("1"), order("2")],
        [order("1"), order("1"), cargo("2"), cargo("3")],
        [cargo("1"), order("1"), order("2")],
    ], lambda raw: facts.trade_order_cargo(parse_changes(raw)))
    assert sorted(r["order_id"] for r in out.collect()) == ["1", "2"]


def test_bounds_before_and_after_their_order(spark):
    def bound(o, org, second):
        return change("order_org_bound", S, order_id=o, org_id=org, status="1",
                      create_time=moment(second), sort_time=moment(second))

    def order(o):
        return change("order_info", S, id=o, amount="1", cargo_num="1")

    out = run(spark, [
        [bound("1", "a", 0), bound("1", "b", 1)],
        [order("1"), order("1"), bound("1", "c", 2), bound("9", "x", 2)],
        [bound("1", "d", 3), order("1")],
    ], lambda raw: facts.trade_order_org(parse_changes(raw)))
    assert sorted(r["org_id"] for r in out.collect()) == ["a", "b", "c", "d"]


def test_fan_out_and_batch_folders(spark):
    root = work_folder(spark, "test_fan_out")
    sink = fan_out({f"{root}/a": lambda df: df.where("k = 'a'"),
                    f"{root}/b": lambda df: df.where("k <> 'a'")})

    def start():
        return run_stream("test", read_files(spark, f"{root}/in"),
                          lambda raw: parse_facts(raw, "ts long, k string"), sink,
                          f"{root}/checkpoint", available_now=True)

    batches = [[{"ts": 1, "k": "a"}, {"ts": 2, "k": "b"}], [{"ts": 3, "k": "a"}]]
    replay([lines(spark, b) for b in batches], f"{root}/in", start)
    assert sorted(r["ts"] for r in spark.read.parquet(f"{root}/a").collect()) == [1, 3]
    assert [r["ts"] for r in spark.read.parquet(f"{root}/b").collect()] == [2]


def test_repeated_batch_replaces_its_folder(spark):
    path = work_folder(spark, "test_repeat")
    written = []

    class Writer:
        def outputMode(self, _):
            return self

        def foreachBatch(self, write):
            written.append(write)
            return self

    batch_folders(path)(Writer())
    for _ in range(2):
        written[0](spark.range(3), 0)
    written[0](spark.range(2), 1)
    assert spark.read.parquet(path).count() == 5


def test_always_on_trigger_and_sql_job(spark):
    root = work_folder(spark, "test_sql")
    lines(spark, [{"ts": 1, "k": "a"}, {"ts": 2, "k": "b"}]).write.text(f"{root}/in")
    facts_ = parse_facts(read_files(spark, f"{root}/in"), "ts long, k string")
    names = spark.createDataFrame([("a", "first")], "k string, name string")
    query = run_sql_stream(
        "test_sql", {"facts": facts_, "names": names},
        "SELECT ts, name FROM facts LEFT JOIN names USING (k)",
        file_sink(f"{root}/out"), f"{root}/checkpoint", every="1 second",
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert sorted(spark.read.parquet(f"{root}/out").collect()) == [(1, "first"), (2, None)]


def test_a_bound_shows_what_expired(spark):
    """Pairs apart by more than the bound are given without a partner; without a bound they meet."""
    def cargo(o, second):
        return change("order_cargo", S + second * 1000, order_id=o, cargo_type="k", create_time=moment(0))

    def order(o, second):
        return change("order_info", S + second * 1000, id=o, amount="1", cargo_num="1")

    batches = [
        [cargo("1", 0), cargo("2", 0)], [order("1", 5)],
        [order("3", 9_000), cargo("3", 9_000)], [order("2", 9_001), order("4", 20_000), cargo("5", 20_000)], [],
    ]
    bounded = run(spark, batches, lambda raw: facts.trade_order_cargo(parse_changes(raw), "60 seconds"))
    got = {r["order_id"]: r["id"] for r in bounded.collect()}
    assert got["1"] == "1" and got["3"] == "3" and got["2"] is None
    free = run(spark, batches, lambda raw: facts.trade_order_cargo(parse_changes(raw)))
    assert {r["order_id"]: r["id"] for r in free.collect()} == {"1": "1", "2": "2", "3": "3"}


def test_bounds_meet_orders_by_the_time_of_the_change(spark):
    """A bound made long before the change that brings it, and a log in seconds."""
    bound = change("order_org_bound", S // 1000, order_id="1", org_id="a", status="1",
                   create_time="2023-11-01 00:00:00", sort_time=moment(0))
    order = change("order_info", str(S // 1000), id="1", amount="1", cargo_num="1") | {"offset": 1}
    out = run(spark, [[bound, order]],
              lambda raw: facts.trade_order_org(parse_changes(raw, ts_unit="s"), "1 minute"))
    assert [(r["org_id"], r["id"]) for r in out.collect()] == [("a", "1")]


def test_kafka_messages_carry_the_place_of_their_source(spark):
    """Equal values of different records get different ids, the same record always the same."""
    columns = "value string, topic string, partition int, offset long"
    text = json.dumps(change("transport_task", 1, id="1", status="67004"))
    rows = spark.createDataFrame([(text, "t", 0, 7), (text, "t", 1, 7), (text, "t", 0, 7)], columns)
    changes = parse_changes(rows, positions=True)
    out = changes.selectExpr("data['id'] AS k", f"data['{POSITION}'] AS {POSITION}")
    messages = kafka_rows(out, "k", [POSITION]).collect()
    assert {(m["value"], m["key"]) for m in messages} == {('{"k":"1"}', "1")}
    ids = [m["headers"][0]["value"] for m in messages]
    assert ids[0] != ids[1] and ids[0] == ids[2] and messages[0]["headers"][0]["key"] == "record_id"
    assert kafka_rows(out).columns == ["key", "value"]


def test_a_new_checkpoint_does_not_replace_old_batches(spark):
    root = work_folder(spark, "test_runs")
    for name in ("first", "second"):
        lines(spark, [{"ts": 1, "k": name}]).write.text(f"{root}/{name}")
        run_stream("test", read_files(spark, f"{root}/{name}"), lambda raw: parse_facts(raw, "ts long, k string"),
                   batch_folders(f"{root}/out"), f"{root}/checkpoint-{name}", available_now=True).awaitTermination()
    assert sorted(r["k"] for r in spark.read.parquet(f"{root}/out").collect()) == ["first", "second"]


def test_landed_lines_are_compressed_in_files_of_bounded_length(spark, monkeypatch):
    monkeypatch.setattr(import_module("freightflow.streaming.replay"), "LINES", 400)
    folder = work_folder(spark, "test-landed")
    rows = spark.range(1000).selectExpr("to_json(named_struct('a_name_that_repeats', id)) AS value").coalesce(1)
    land(rows, folder)
    files = [(f["path"], f["length"]) for f in spark.read.format("binaryFile").load(folder).collect()]
    assert len(files) == 3 and all(path.endswith(".lz4") for path, _ in files)
    plain = rows.selectExpr("sum(length(value) + 1)").first()[0]
    assert sum(size for _, size in files) * 2 < plain
    assert sorted(spark.read.text(folder).collect()) == sorted(rows.collect())


def test_city_stream_stores_what_its_rollup_reads(spark, monkeypatch):
    seen, plain = [], queries._stored
    monkeypatch.setattr(queries, "_stored", lambda s, name, df: seen.append(df.columns) or plain(s, name, df))
    got = queries.QUERIES["stream_dws_trade_order_city"](spark, SF)
    want = queries.QUERIES["dws_trade_order_city"](spark, SF)
    assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect())
    assert seen == [["ts", "sender_city_id", "sender_province_id", "amount"]]


def test_fan_out_holds_no_batch_in_memory(spark):
    root, seen = work_folder(spark, "test_fan_out_memory"), []

    def branch(df):
        seen.append((df.storageLevel.useMemory, sorted(df.inputFiles())))
        return df

    def start():
        return run_stream("test", read_files(spark, f"{root}/in"), lambda raw: parse_facts(raw, "ts long, k string"),
                          fan_out({f"{root}/a": branch, f"{root}/b": branch}), f"{root}/checkpoint",
                          available_now=True)

    replay([lines(spark, [{"ts": 1, "k": "a"}, {"ts": 2, "k": None}])], f"{root}/in", start)
    (memory, files), again = seen
    assert not memory and files and again == (memory, files)  # both branches read what was written once
    assert not any(exists(spark, f) for f in files)
    for name in "ab":
        assert sorted(r["ts"] for r in spark.read.parquet(f"{root}/{name}").collect()) == [1, 2]


def test_replay_lets_go_of_lines_that_were_read(spark):
    root, landed = work_folder(spark, "test_replay_keep"), []

    def start():
        landed.append(spark.read.text(f"{root}/in").count())
        return run_stream("test", read_files(spark, f"{root}/in"), lambda raw: parse_facts(raw, "ts long"),
                          file_sink(f"{root}/out"), f"{root}/checkpoint", available_now=True)

    batches = [[{"ts": i} for i in range(3)], [{"ts": 3}], [{"ts": 4}, {"ts": 5}]]
    replay([lines(spark, b) for b in batches], f"{root}/in", start, keep=False)
    assert landed == [3, 1, 2] and not exists(spark, f"{root}/in")
    assert sorted(r["ts"] for r in spark.read.parquet(f"{root}/out").collect()) == list(range(6))


def test_ods_change_stream_keeps_no_landed_lines(spark, monkeypatch):
    from freightflow.catalog import queries

    roots = []

    def folder(*args):
        roots.append(work_folder(*args))
        return roots[-1]

    monkeypatch.setattr(queries, "work_folder", folder)
    rows = queries.QUERIES["ods_change_stream"](spark, SF)
    assert len(roots) == 1 and exists(spark, f"{roots[0]}/out") and not exists(spark, f"{roots[0]}/in")
    assert rows.count() == queries.QUERIES["change_type_counts"](spark, SF).selectExpr("sum(changes)").first()[0]
