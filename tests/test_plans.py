"""What the plans must look like for large and skewed inputs."""

import contextlib
import io

import pytest
from freightflow import fixtures as fx
from freightflow.catalog import QUERIES
from freightflow.operators import lookup_join, window_rollup
from freightflow.plans import facts
from freightflow.schemas import ENVELOPE
from freightflow.sources import parse_changes
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
SPLIT_EARLY = {
    **NO_BROADCAST,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


@pytest.fixture
def settings(spark):
    @contextlib.contextmanager
    def use(values):
        before = {k: spark.conf.get(k, None) for k in values}
        for k, v in values.items():
            spark.conf.set(k, v)
        try:
            yield
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)

    return use


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def final_plan(df):
    df.collect()
    return plan(df).split("Initial Plan")[0]


def hot_log(spark, table, data):
    """20,000 changes of one table, of which a third has the same key 0; four input tasks, as
    splitting needs several map outputs."""
    rows = spark.range(0, 20_000, 1, 4).selectExpr("if(id % 3 = 0, 0, id) AS k", "id AS n")
    pairs = ", ".join(f"'{k}', cast({v} as string)" for k, v in data.items())
    return rows.selectExpr(
        "'tms' AS database", f"'{table}' AS `table`", "'insert' AS type", "n AS ts",
        "n AS offset", f"map({pairs}) AS data", "cast(null as map<string,string>) AS old",
    )


TIME = "date_format(timestamp_seconds(1704067200 + n div 10), 'yyyy-MM-dd HH:mm:ss')"


def test_hot_order_is_split(spark, settings):
    bounds = hot_log(spark, "order_org_bound", {
        "order_id": "k", "org_id": "n", "status": "'64003'", "create_time": TIME,
        "sort_time": TIME,
    })
    orders = hot_log(spark, "order_info", {"id": "n", "amount": "n", "cargo_num": "1"})
    with settings(SPLIT_EARLY):
        df = facts.trade_order_org(bounds.unionByName(orders))
        assert "SortMergeJoin(skew=true)" in final_plan(df)
        assert df.count() == 20_000


def test_hot_organisation_is_split_before_its_rollup(spark, settings):
    bounds = hot_log(spark, "order_org_bound", {
        "id": "n", "order_id": "n", "org_id": "k", "status": "'64003'", "sort_time": TIME,
    })
    organ = spark.range(20_000).selectExpr(
        "cast(id as string) AS id", "concat('o', id) AS org_name", "'r' AS region_id"
    )
    tree = spark.createDataFrame(
        [("r", "86", "x", "City")], "id string, parent_id string, name string, dict_code string"
    )
    with settings(SPLIT_EARLY):
        sorted_ = facts.express_sorting(bounds, organ, tree)
        df = window_rollup(sorted_, ["org_id"], count="n", firsts=["org_name"], dependent=True)
        assert "skew=true" in final_plan(df)
        assert df.selectExpr("sum(n)").first()[0] == 20_000


def test_copies_of_a_cargo_collapse_before_the_shuffle(spark, settings):
    with settings(NO_BROADCAST):
        text = plan(QUERIES["dwd_trade_order_cargo"](spark, SF_DIR))
    below = text[text.index("SortMergeJoin"):]
    assert below.count("partial_min") == 2
    # One exchange per side: the join reuses the partitioning of the aggregates.
    assert below.count("Exchange hashpartitioning(order_id") == 1
    assert below.count("Exchange hashpartitioning(id") == 1


def test_rollups_aggregate_before_the_shuffle(spark):
    text = plan(QUERIES["dws_order_status"](spark, SF_DIR))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_sum" in text
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_hot_task_is_split(spark, settings):
    details = hot_log(spark, "transport_task_detail", {
        "id": "n", "order_id": "n", "transport_task_id": "k",
    }).withColumn("type", F.lit("update"))
    tasks = hot_log(spark, "transport_task", {
        "id": "n", "order_num": "1", "actual_end_time": TIME, "status": "'67004'",
    }).withColumn("type", F.lit("update"))
    with settings(SPLIT_EARLY):
        df = facts.transport_task_detail(details.unionByName(tasks))
        assert "SortMergeJoin(skew=true)" in final_plan(df)
        assert df.count() == 20_000


def test_broadcasts_follow_the_size_found_at_run_time(spark, settings):
    derived = spark.range(3_000).selectExpr("cast(id % 1000 as string) AS id", "'x' AS name").distinct()
    df = spark.range(3_000).selectExpr("cast(id as string) AS k").repartition(4, "k")
    adaptive = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    for limit, join in (("10m", "BroadcastHashJoin"), ("1k", "SortMergeJoin")):
        with settings({**adaptive, "spark.sql.adaptive.autoBroadcastJoinThreshold": limit}):
            joined = lookup_join(df, derived, "k", {"n": "name"})
            assert "hint" not in joined._jdf.queryExecution().optimizedPlan().toString().lower()
            assert join in final_plan(joined)


def test_json_is_parsed_once(spark):
    lines = fx.raw(fx.changelog(spark, SF_DIR, ["order_info"]))
    text = plan(facts.order_status(parse_changes(lines)))
    assert text.count("from_json(") == 1
    assert text.count("gettimestamp(") == 1


def test_only_needed_tables_and_columns_are_scanned(spark):
    text = plan(facts.order_status(fx.changelog(spark, SF_DIR)))
    assert text.count("FileScan parquet") <= 2
    assert "lineitem.parquet" not in text and "events.parquet" not in text


def test_no_python_in_any_batch_plan(spark):
    for name, build in QUERIES.items():
        if name.startswith(("dwd_", "dws_", "window_")):
            text = plan(build(spark, SF_DIR))
            assert "Python" not in text and "Pandas" not in text, name


def test_envelope_is_what_the_fixtures_build(spark):
    df = fx.changelog(spark, SF_DIR)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in ENVELOPE]


def test_log_lines_are_written_without_maps_and_equal_those_of_the_parsed_log(spark):
    written = fx.raw(fx.changelog(spark, SF_DIR), "offset")
    lines = fx.changelog_lines(spark, SF_DIR)
    assert lines.exceptAll(written).isEmpty() and written.exceptAll(lines).isEmpty()
    for name in ("ods_change_table", "rejected_rows", "dim_clean"):
        plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "to_json" in plan.lower() or "structstojson" in plan.lower(), name
        assert "map(id," not in plan, name
