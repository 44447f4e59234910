import json

from freightflow.operators import clean, count_types, normalise_type
from freightflow.sources import ods_table, parse_changes, parse_facts, reject_reason


def line(**changes):
    record = {
        "database": "tms", "table": "order_info", "type": "insert", "ts": 5,
        "data": {"id": 1, "note": {"a": 2}, "gone": None},
    }
    record.update(changes)
    return json.dumps({k: v for k, v in record.items() if v is not ...})


LINES = {
    line(): None,
    line(type="bootstrap-insert"): None,
    line(type="delete"): None,
    "bad": "malformed",
    "[]": "malformed",
    None: "null_value",
    line(data={}): "empty_data",
    line(data=...): "empty_data",
    line(database="other"): "other_database",
    '{"data":{}}': "other_database",
    line(type="bootstrap-start"): "unsupported_type",
    line(table="  "): "blank_field",
    line(ts=...): "blank_field",
}


def raw(spark, lines):
    return spark.createDataFrame([(v,) for v in lines], "value string")


def test_reasons_match_what_cleaning_keeps(spark):
    rows = reject_reason(raw(spark, LINES)).collect()
    assert {r["value"]: r["reason"] for r in rows} == LINES
    kept = clean(parse_changes(raw(spark, LINES))).collect()
    assert sorted(r["type"] for r in kept) == ["bootstrap-insert", "delete", "insert"]


def test_values_become_text(spark):
    row = parse_changes(raw(spark, [line()])).first()
    assert row["data"] == {"id": "1", "note": '{"a":2}', "gone": None}
    assert (row["ts"], row["offset"], row["old"]) == (5, None, None)


def test_offset_of_the_source_wins(spark):
    df = spark.createDataFrame([(line(offset=3), 9), (line(offset=4), None)],
                               "value string, offset long")
    assert sorted(r["offset"] for r in parse_changes(df).collect()) == [4, 9]


def test_only_named_tables(spark):
    lines = [line(), line(table="order_cargo"), line(data={"x": "order_info"}, table="other")]
    rows = parse_changes(raw(spark, lines), ["order_info"]).collect()
    assert [r["table"] for r in rows] == ["order_info"]


def test_types(spark):
    changes = parse_changes(raw(spark, [line(), line(type="bootstrap-insert")]))
    assert {r["type"] for r in normalise_type(changes).collect()} == {"insert"}
    assert count_types(changes).collect() == [("order_info", "insert", 2)]


def test_ods_view_and_second_times(spark):
    ods_table(raw(spark, [line()]), view="ods_db", ts_unit="s")
    row = spark.sql("SELECT unix_seconds(et) AS et, pt FROM ods_db WHERE data['id'] > 0").first()
    assert row["et"] == 5 and row["pt"] is not None


def test_facts_without_time_are_dropped(spark):
    lines = raw(spark, ['{"ts":1,"k":"a"}', '{"k":"b"}', "bad", None])
    assert parse_facts(lines, "ts long, k string").collect() == [(1, "a")]
