import json
import random

import pytest
from freightflow import fixtures as fx
from freightflow.operators import (
    apply_changes,
    clean,
    flatten_regions,
    join_region,
    keep_current_epoch,
    key_changes,
    latest_per_key,
    lookup_join,
    project_columns,
    route,
)
from freightflow.schemas import CONFIG_EVENT, CONFIG_ROW, ENVELOPE
from freightflow.session import work_folder
from freightflow.sources import DimensionStore, config_feed, config_snapshot
from freightflow.sources.config import config_epochs
from freightflow.streaming import DimensionJob
from pyspark.sql import types as T


def config_row(source, sink_type="DIM", columns="id,name"):
    return (source, "ALL", f"dim_{source}", sink_type, "info", columns, "id")


def events(spark, *rows):
    return spark.createDataFrame(
        [(op, 7, before, after, seq) for seq, (op, before, after) in enumerate(rows)], CONFIG_EVENT
    )


def change(kind, moment, **data):
    return ("tms", "t", kind, moment, moment, {k: str(v) for k, v in data.items()}, None)


def test_config_feed(spark):
    a, b, c = config_row("a"), config_row("b"), config_row("c")
    feed = events(
        spark,
        ("c", None, a), ("r", None, b), ("u", a, config_row("a", columns="id")),
        ("d", b, None), ("c", None, config_row("f", "FACT")),
        ("c", None, c), ("u", c, config_row("d")),
    )
    rows = {r["source_table"]: (r["op"], r["sink_columns"]) for r in config_feed(feed).collect()}
    assert rows == {"a": ("u", "id"), "d": ("u", "id,name")}


def test_config_epochs(spark):
    a, b, c, d = (config_row(x) for x in "abcd")
    feed = events(
        spark,
        ("r", None, a), ("r", None, b), ("r", None, c), ("r", None, d),
        ("u", a, a), ("d", b, None), ("d", c, None), ("c", None, c), ("c", None, d),
    )
    rows = {r["source_table"]: r["since"] for r in config_epochs(feed).collect()}
    assert rows == {"a": 4, "c": 6, "d": -1}


def test_only_restarts_cut_history_and_times_do_not(spark):
    feed = events(spark, ("r", None, config_row("t")), ("u", config_row("t"), config_row("t")))
    rows = [(*change("insert", 10 - n, id=n), seen) for n, seen in enumerate([None, 0, 1, 1])]
    changes = spark.createDataFrame(rows, T.StructType([*ENVELOPE, T.StructField("config_seq", T.IntegerType())]))

    def kept(of):
        return sorted(r["data"]["id"] for r in keep_current_epoch(changes, config_epochs(of)).collect())

    assert kept(feed) == ["2", "3"]
    assert kept(feed.where("op = 'r'")) == ["0", "1", "2", "3"]


def test_route_and_project(spark):
    config = config_snapshot(spark.createDataFrame(
        [config_row("t", columns="id,name,extra"), config_row("f", "FACT")], CONFIG_ROW
    ))
    rows = [change("bootstrap-insert", 5, id=1, name="x", other=2, ts="z")]
    rows.append(("tms", "f", "insert", 1, 1, {"id": "1"}, None))
    out = project_columns(route(clean(spark.createDataFrame(rows, ENVELOPE)), config)).collect()
    assert len(out) == 1
    assert out[0]["image"] == {
        "id": "1", "name": "x", "extra": None, "type": "insert", "ts": "5",
    }
    assert (out[0]["sink_table"], out[0]["row_key"]) == ("dim_t", "1")


def image_rows(spark, changes):
    config = config_snapshot(spark.createDataFrame([config_row("t")], CONFIG_ROW))
    projected = project_columns(route(clean(spark.createDataFrame(changes, ENVELOPE)), config))
    last = key_changes(projected)
    return last.selectExpr("image['id'] AS id", "image['name'] AS name", "type")


def test_one_batch_equals_change_by_change(spark):
    rng = random.Random(7)
    changes = [
        change(rng.choice(["insert", "update", "delete"]), t, id=rng.randrange(6), name=t)
        for t in range(40)
    ]
    kept = {"1": "old", "9": "old"}
    start = spark.createDataFrame(list(kept.items()), "id string, name string")
    for row in changes:
        data = row[5]
        if row[2] == "delete":
            kept.pop(data["id"], None)
        else:
            kept[data["id"]] = data["name"]
    shuffled = changes[:]
    rng.shuffle(shuffled)
    out = apply_changes(start, image_rows(spark, shuffled), "id")
    assert {r["id"]: r["name"] for r in out.collect()} == kept


def test_null_keys_name_no_row_and_older_changes_do_nothing(spark):
    start = spark.createDataFrame([("a", "old", "200"), (None, "x", "1")], "id string, name string, ts string")
    late = spark.createDataFrame(
        [("a", "older", "100", "update"), (None, "y", "300", "insert"), ("b", "new", "100", "insert")],
        "id string, name string, ts string, type string",
    )
    out = apply_changes(start, late, "id").collect()
    assert sorted(map(tuple, out), key=str) == [("a", "old", "200"), ("b", "new", "100"), (None, "x", "1")]


def test_latest_row_does_not_depend_on_the_partitioning(spark):
    rows = [(1, 5, {"v": str(n)}, n) for n in range(20)]
    df = spark.createDataFrame(rows, "k int, ts long, data map<string,string>, n int")
    got = {tuple(latest_per_key(df.repartition(p), ["k"], ("ts",)).collect()[0][2:])[1] for p in (1, 2, 3, 7)}
    assert len(got) == 1


SCHEMA = "id string, name string"


def stamped(spark, *rows):
    """(id, name, ts, gone) as changes of a store."""
    return spark.createDataFrame(
        [(i, n, ts, None, gone) for i, n, ts, gone in rows], f"{SCHEMA}, _ts long, _offset long, _gone boolean"
    )


def names(store, table="t"):
    return {r["id"]: r["name"] for r in store.read(table, SCHEMA).collect()}


def test_store_orders_by_time_across_batches(spark):
    store = DimensionStore(spark, work_folder(spark, "test_store"), compact=5)
    assert names(store) == {}
    store.merge("t", SCHEMA, "id", stamped(spark, ("a", "1", 200, False), ("b", "1", 200, False)), 0, "run")
    held = store.read("t", SCHEMA)
    store.merge("t", SCHEMA, "id", stamped(spark, ("a", "0", 100, False), ("b", None, 300, True)), 1, "run")
    assert names(store) == {"a": "1"}
    store.merge("t", SCHEMA, "id", stamped(spark, ("b", "2", 250, False), ("c", "1", 1, False)), 2, "run")
    assert names(store) == {"a": "1", "c": "1"}
    # A repeat replaces what it wrote before; a new checkpoint goes on from the newest rows.
    store.merge("t", SCHEMA, "id", stamped(spark, ("d", "1", 1, False)), 2, "run")
    assert names(store) == {"a": "1", "d": "1"}
    store.merge("t", SCHEMA, "id", stamped(spark, ("e", "1", 1, False)), 0, "other run")
    assert names(store) == {"a": "1", "d": "1", "e": "1"}
    for batch in range(12):
        store.merge("t", SCHEMA, "id", stamped(spark, ("f", str(batch), batch, False)), batch, "third")
    assert held.count() == 2 and names(store)["f"] == "11"
    store.merge("t", SCHEMA, "id", stamped(spark), 13, "third", reset=5)
    assert names(store) == {}


def test_one_row_writes_one_small_file(spark):
    store = DimensionStore(spark, work_folder(spark, "test_append"), compact=4)
    store.merge("t", SCHEMA, "id", stamped(spark, *[(str(i), "x", 1, False) for i in range(100)]), 0)
    before = set(store.pointers()["t"]["paths"])
    store.merge("t", SCHEMA, "id", stamped(spark, ("5", "y", 2, False)).coalesce(1), 1)
    added = set(store.pointers()["t"]["paths"]) - before
    assert len(added) == 1 and spark.read.parquet(*added).count() == 1
    assert len(spark.read.parquet(*added).inputFiles()) == 1
    assert names(store)["5"] == "y" and len(names(store)) == 100


def test_folders_do_not_grow_with_time(spark):
    store = DimensionStore(spark, work_folder(spark, "test_compact"), compact=3, keep_seconds=0)
    for n in range(11):
        rows = stamped(spark, (str(n % 4), f"v{n}", n, n == 9), ("all", f"v{n}", -n, False))
        store.merge("t", SCHEMA, "id", rows, n, "run")
        assert len(store.pointers()["t"]["paths"]) <= 3
    assert names(store) == {"0": "v8", "2": "v10", "3": "v7", "all": "v0"}
    assert len(store._generations()["t"]) == 1
    version = store.pointers()["t"]["version"]
    store.merge("t", SCHEMA, "id", stamped(spark), 11, "run")
    assert store.pointers()["t"]["version"] == version


def test_replaced_versions_are_removed_by_age(spark):
    store = DimensionStore(spark, work_folder(spark, "test_age"), keep_seconds=0)
    for n in range(4):
        store.write("t", spark.createDataFrame([("a", str(n)), ("b", "x")], SCHEMA), n)
    store.merge("t", SCHEMA, "id", stamped(spark, ("a", "9", 1, False)), 5)
    assert names(store) == {"a": "9", "b": "x"}
    assert len(store._generations()["t"]) == 1
    kept = DimensionStore(spark, store.root)
    kept.write("t", spark.createDataFrame([("c", "1")], SCHEMA))
    assert names(kept) == {"c": "1"} and len(kept._generations()["t"]) == 2


def test_broken_pointers_are_no_empty_dimension(spark):
    store = DimensionStore(spark, "nosuchscheme://x/y")
    with pytest.raises(Exception, match="nosuchscheme"):
        store.read("t", SCHEMA)


@pytest.mark.parametrize("unit, scale", [("ms", 1), ("s", 1000)])
def test_configuration_drives_the_dimension_tables(spark, unit, scale):
    t = config_row("t")
    store = DimensionStore(spark, work_folder(spark, "test_lifecycle"))
    feed = [("c", 10**15, None, t, 0)]
    job = DimensionJob(store, lambda: spark.createDataFrame(feed, CONFIG_EVENT), unit)
    schema = job.schema("id,name")

    def apply(batch, *changes):
        lines = spark.createDataFrame([(json.dumps(c),) for c in changes], "value string")
        job.apply(lines, batch)
        return sorted(r["id"] for r in store.read("dim_t", schema).collect())

    def insert(ts, id_, **more):
        return {"database": "tms", "table": "t", "type": "insert", "ts": ts, "offset": ts,
                "data": {"id": id_, "name": "n"}} | more

    assert apply(0) == [] and store.pointers()["dim_t"]["reset"] == -1
    assert apply(1, insert(5, "a"), insert(6, "b")) == ["a", "b"]
    assert apply(1, insert(5, "a"), insert(6, "b")) == ["a", "b"]
    assert {r["ts"] for r in store.read("dim_t", schema).collect()} == {str(5 * scale), str(6 * scale)}
    feed.append(("u", 0, t, t, 1))
    assert apply(2) == []
    assert apply(3, insert(9, "old"), insert(11, "c"), insert(12, None)) == ["c", "old"]
    assert job.rejected == 1
    feed.append(("d", 0, t, None, 2))
    assert apply(4, insert(21, "d")) == []
    feed.append(("c", 0, None, t, 3))
    assert apply(5, insert(3, "e"), insert(31, "f")) == ["e", "f"]


REGIONS = [
    ("86", "0", "Land", "Country"), ("P", "86", "Prov", "Province"), ("C", "P", "City", "City"),
    ("D", "C", "Dist", "District"), ("X", "none", "Orphan", "City"),
]


def regions(spark, rows=REGIONS):
    return spark.createDataFrame(rows, "id string, parent_id string, name string, dict_code string")


def test_region_levels(spark):
    ids = spark.createDataFrame([(i,) for i in ["D", "C", "P", "86", "?", None, "X"]], "r string")
    out = {r["r"]: tuple(r)[1:] for r in join_region(ids, regions(spark), "r").collect()}
    assert out == {
        "D": ("C", "City", "P", "Prov"), "C": ("C", "City", "P", "Prov"),
        "P": (None, None, "P", "Prov"), "86": (None,) * 4, "?": (None,) * 4, None: (None,) * 4,
        "X": ("X", "Orphan", None, None),
    }


def test_topmost_city_wins_however_deep_and_cycles_fail(spark):
    deep = [(f"L{n}", f"L{n - 1}" if n else "D", "x", "x") for n in range(150)]
    nested = regions(spark, REGIONS + [("CC", "D", "Inner", "City"), ("E", "CC", "End", "x")] + deep)
    flat = {r["region_id"]: (r["city_id"], r["province_id"]) for r in flatten_regions(nested).collect()}
    assert flat["E"] == flat["L149"] == ("C", "P")
    with pytest.raises(ValueError, match="cycle"):
        flatten_regions(regions(spark, [("a", "b", "", ""), ("b", "a", "", "")]))
    assert flatten_regions(regions(spark, [])).count() == 0


def test_lookup_keeps_rows_without_a_match(spark):
    facts = spark.createDataFrame([("1",), ("2",), (None,)], "k string")
    dim = spark.createDataFrame([("1", "one")], "id string, name string")
    out = lookup_join(facts, dim, "k", {"label": "name"}).collect()
    assert sorted(out, key=str) == [("1", "one"), ("2", None), (None, None)]


def test_fixture_feed_has_three_phases(spark):
    kinds = fx.dimension_changes(spark, "/root/testdata/sf0.001", ["base_organ"])
    assert {r["type"] for r in kinds.collect()} == {"bootstrap-insert", "update", "delete"}
